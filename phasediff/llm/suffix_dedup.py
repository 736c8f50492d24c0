"""Removal of repeated passages with suffix arrays made by the difference-cover algorithm.

A byte goes if a string of LENGTH bytes that covers it also starts earlier. Every such window has an anchor:
of its runs of GRAM bytes the one with the smallest hash, the leftmost of equals. Equal windows have equal
anchors, so windows can be dealt out by the hash of their anchor and no group of equal windows is split.
Anchors are counted first; only windows of anchors that occur again (told by a Bloom filter of bounded size,
which may let others through) are sent on, as stretches: neighbouring windows with one anchor. A task sends
each distinct stretch once, with its earliest place; all its other places repeat that one.

The suffixes of the stretches that share an anchor are sorted by the difference cover of period 3: triples
at two thirds of the places are sorted and named, the names' own suffixes by recursion, the remaining
suffixes by a byte and a rank, and both are merged. Neighbours in that order whose first LENGTH bytes are
equal are the same window; all but its earliest place are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasediff.llm.lm_score import Filter, built, distinct, parts_of
from phasediff.llm.store import dropped, freeing, repeatable, written
from phasediff.llm.text import _BACK, _BASE, _VALUE, mixed, slices

LENGTH = 100
GRAM = 40
FILTER_BYTES = 64 << 20

_PIECE = 1 << 19
_INDEX = np.uint64(28)
_HELD = 100_000
_SORTED_BYTES = 1 << 20


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of s (integers of 1 or more) in order, by the difference cover of period 3."""
    n = len(s)
    if n < 4:
        return np.array(sorted(range(n), key=lambda k: s[k:].tolist()), np.int64)
    t = np.zeros(n + 3, np.int32)
    t[:n] = s
    sample = np.concatenate([np.arange(1, n + (n % 3 == 1), 3, dtype=np.int32), np.arange(2, n, 3, dtype=np.int32)])
    if t.max() < 1 << 21:
        keys = t[sample].astype(np.int64) << 42
        keys |= t[sample + 1].astype(np.int64) << 21
        keys |= t[sample + 2]
        order = np.argsort(keys, kind="stable").astype(np.int32)
        keys = keys[order]
        new = keys[1:] != keys[:-1]
        del keys
    else:
        order = np.lexsort((t[sample + 2], t[sample + 1], t[sample])).astype(np.int32)
        o = sample[order]
        new = (t[o[1:]] != t[o[:-1]]) | (t[o[1:] + 1] != t[o[:-1] + 1]) | (t[o[1:] + 2] != t[o[:-1] + 2])
    if not new.all():
        names = np.empty(len(sample), np.int32)
        names[order[:1]] = 1
        names[order[1:]] = 1 + np.cumsum(new)
        del order, new
        order = suffix_array(names)
        del names
    rank = np.zeros(n + 3, np.int32)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    sorted_sample = sample[order][sample[order] < n]
    width = np.int64(n + 4)
    del sample, order
    zeros = np.arange(0, n, 3, dtype=np.int32)
    keys = t[zeros] * width + rank[zeros + 1]
    by = np.argsort(keys, kind="stable")
    zeros, keys = zeros[by], keys[by]
    # how many sampled suffixes of each kind come before each of the others
    first = sorted_sample[sorted_sample % 3 == 1]
    second = sorted_sample[sorted_sample % 3 == 2]
    before = np.searchsorted(t[first] * width + rank[first + 1], keys)
    letters = np.int64(t.max()) + 1
    both = np.concatenate([second, zeros])
    inverse = np.unique(t[both] * letters + t[both + 1], return_inverse=True)[1]
    del both
    before += np.searchsorted(inverse[: len(second)] * width + rank[second + 2], inverse[len(second) :] * width + rank[zeros + 2])
    out = np.empty(n, np.int32)
    at = np.arange(len(zeros)) + before
    free = np.ones(n, bool)
    free[at] = False
    out[at] = zeros
    out[free] = sorted_sample
    return out


def anchored(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(starts of stretches in data, numbers of windows, hashes of anchors), piece by piece."""
    power, back = np.full(_PIECE + LENGTH, _BASE), np.full(_PIECE + LENGTH, _BACK)
    power[0] = back[0] = 1
    np.cumprod(power, out=power)
    np.cumprod(back, out=back)
    for at in range(0, max(0, len(data) - LENGTH + 1), _PIECE):
        piece = data[at : at + _PIECE + LENGTH - 1]
        windows = len(piece) - LENGTH + 1
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_VALUE[piece] * power[: len(piece)], out=sums[1:])
        grams = mixed((sums[GRAM:] - sums[:-GRAM]) * back[: len(piece) - GRAM + 1])
        low = (grams >> _INDEX << _INDEX) | np.arange(len(grams), dtype=np.uint64)
        need, span = LENGTH - GRAM + 1, 1
        while 2 * span <= need:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < need:
            low = np.minimum(low[: windows], low[need - span : need - span + windows])
        anchor = (low & np.uint64((1 << 28) - 1)).astype(np.int64)
        # windows must lie in one document
        inside = np.zeros(windows + 1, np.int64)
        begin = np.clip(offsets[:-1] - at, 0, windows)
        end = np.clip(np.maximum(offsets[1:] - LENGTH + 1, offsets[:-1]) - at, 0, windows)
        np.add.at(inside, begin, 1)
        np.add.at(inside, end, -1)
        inside = np.cumsum(inside)[:-1] > 0
        new = np.ones(windows, bool)
        new[1:] = anchor[1:] != anchor[:-1]
        new[begin[begin < windows]] = True
        new[1:] |= inside[1:] != inside[:-1]
        starts = np.flatnonzero(new)
        counts = np.diff(np.append(starts, windows))
        good = inside[starts]
        starts, counts = starts[good], counts[good]
        # smallest hashes are small numbers; mixed again they fill all parts alike
        yield starts + at, counts, mixed(grams[anchor[starts]])


def _counted(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Anchor hashes of the task by part, each once, and whether it was there twice."""
    held: list[np.ndarray] = []
    many = 0

    def out() -> Iterator[pa.RecordBatch]:
        keys = np.concatenate(held)
        held.clear()
        for some, counts in distinct(keys):
            part = parts_of(some, bits)
            order = np.argsort(part, kind="stable")
            part, some, twice = part[order], some[order], counts[order] > 1
            cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
            rows = [(int(part[a]), some[a:b].tobytes(), np.packbits(twice[a:b]).tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], ["part", "keys", "twice"]
            )

    for batch in batches:
        for _, _, data, offsets in slices(batch.column(0)):
            for _, _, hashes in anchored(data, offsets):
                held.append(hashes)
                many += len(hashes)
            if many > 3_000_000:
                yield from out()
                many = 0
    if many:
        yield from out()


def _repeated(batches: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part: a Bloom filter of the anchors that occur twice, of most_bytes at most."""
    part, found = None, []

    def out() -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate([k for k, _ in found]), return_counts=True)
        twice = np.unique(np.concatenate([k[t] for k, t in found]))
        keys = np.unique(np.concatenate([keys[counts > 1], twice]))
        bits = bounded(keys, most_bytes)
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([bits.tobytes()], pa.binary())], ["part", "bits"])

    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] != part:
                if found:
                    yield out()
                part, found = row["part"], []
            keys = np.frombuffer(row["keys"], np.uint64)
            found.append((keys, np.unpackbits(np.frombuffer(row["twice"], np.uint8), count=len(keys)) > 0))
    if found:
        yield out()


def bounded(keys: np.ndarray, most_bytes: int) -> np.ndarray:
    """The filter of the keys; one that would be too large is replaced by one that lets everything through."""
    bits = built(keys, np.ones(len(keys), np.int64))
    return bits if len(bits) <= most_bytes else np.full(64, 255, np.uint8)


_STRETCH = pa.schema(
    [("part", pa.int32()), ("row", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())]
    + [(n, pa.binary()) for n in ("anchors", "docs", "rows", "places", "windows", "text")]
)


def _stretches(batches: Iterator[pa.RecordBatch], repeated: Filter) -> Iterator[pa.RecordBatch]:
    """Two kinds of rows: packed distinct stretches of a part, and removed bytes of a row (start to stop)."""
    held: dict[tuple[int, bytes], tuple[int, int, int]] = {}
    gone: list[tuple[int, int, int]] = []

    def removed() -> pa.RecordBatch:
        merged: list[list[int]] = []
        for row, start, stop in sorted(gone):
            if merged and merged[-1][0] == row and start <= merged[-1][2]:
                merged[-1][2] = max(stop, merged[-1][2])
            else:
                merged.append([row, start, stop])
        gone.clear()
        columns = list(zip(*merged))
        arrays = [pa.nulls(len(merged), pa.int32()), *(pa.array(c, pa.int64()) for c in columns)]
        return pa.RecordBatch.from_arrays(arrays + [pa.nulls(len(merged), pa.binary())] * 6, schema=_STRETCH)

    def packed() -> pa.RecordBatch:
        keys = np.array([a for a, _ in held], np.uint64)
        part = parts_of(keys, repeated.bits)
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.concatenate([[True], part[order][1:] != part[order][:-1], [True]]))
        texts, places = [t for _, t in held], np.array(list(held.values()), np.int64)
        windows = np.array([len(t) - LENGTH + 1 for t in texts], np.int64)
        rows = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            o = order[a:b]
            text = b"".join([texts[k] for k in o])
            rows.append((int(part[o[0]]), None, None, None, keys[o].tobytes(), *(places[o, c].tobytes() for c in range(3)), windows[o].tobytes(), text))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _STRETCH)], schema=_STRETCH)

    for batch in batches:
        rows, docs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for first, _, data, offsets in slices(batch.column(2)):
            whole = data.tobytes()
            for starts, counts, hashes in anchored(data, offsets):
                some = np.flatnonzero(repeated.levels(hashes, 1) > 0) if len(hashes) else np.zeros(0, int)
                starts, counts, hashes = starts[some], counts[some], hashes[some]
                at = np.searchsorted(offsets, starts, "right") - 1
                # empty texts share an offset; the last of them is the one with bytes
                for start, count, anchor, k, base in zip(
                    starts.tolist(), counts.tolist(), hashes.tolist(), at.tolist(), offsets[at].tolist()
                ):
                    key = (anchor, whole[start : start + count + LENGTH - 1])
                    doc = docs[first + k]
                    place = (2**63 - 1 if doc is None else doc, rows[first + k], start - base)
                    known = held.get(key)
                    if known is None or place < known:
                        held[key] = place
                        place, known = known, place
                    if place is not None:
                        gone.append((place[1], place[2], place[2] + count + LENGTH - 1))
                if len(held) > _HELD:
                    yield packed()
                if len(gone) > _HELD:
                    yield removed()
    if held:
        yield packed()
    if gone:
        yield removed()


def first_places(texts: list[bytes], windows: list[int], order: list[tuple]) -> list[np.ndarray]:
    """For each stretch whether each of its windows is the earliest of its kind; order: place of the stretch."""
    sizes = np.array([len(t) + 1 for t in texts])
    begin = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int32) + 1
    data[begin + sizes - 1] = 257
    suffixes = suffix_array(data)
    stretch = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    inside = (np.arange(len(data)) - begin[stretch]).astype(np.int32)
    is_window = inside < np.array(windows, np.int32)[stretch]
    suffixes = suffixes[is_window[suffixes]]
    same = np.zeros(len(suffixes), bool)
    width = np.arange(LENGTH)
    for at in range(1, len(suffixes), 8_000):
        a, b = suffixes[at - 1 : at + 7_999], suffixes[at : at + 8_000]
        a = a[: len(b)]
        same[at : at + len(b)] = (data[a[:, None] + width] == data[b[:, None] + width]).all(1)
    group = np.cumsum(~same)
    by = sorted(range(len(texts)), key=order.__getitem__)
    turn = np.empty(len(texts), np.int64)
    turn[by] = np.arange(len(texts))
    when = turn[stretch[suffixes]] * (sizes.max() + 1) + inside[suffixes]
    least = np.full(group[-1] + 1 if len(group) else 0, np.iinfo(np.int64).max)
    np.minimum.at(least, group, when)
    earliest = np.zeros(len(data), bool)
    earliest[suffixes[when == least[group]]] = True
    return [earliest[b : b + w] for b, w in zip(begin.tolist(), windows)]


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part: removed bytes of rows, as (row, start, stop)."""
    part, found = None, []

    def out() -> Iterator[pa.RecordBatch]:
        gone: list[tuple[int, int, int]] = []
        anchors = np.concatenate([np.frombuffer(r["anchors"], np.uint64) for r in found])
        places = np.stack([np.concatenate([np.frombuffer(r[c], np.int64) for r in found]) for c in ("docs", "rows", "places")], 1)
        windows = np.concatenate([np.frombuffer(r["windows"], np.int64) for r in found])
        text = b"".join([r["text"] for r in found])
        stops = np.cumsum(windows + LENGTH - 1)
        order = np.argsort(anchors, kind="stable")
        cuts = np.flatnonzero(np.concatenate([[True], anchors[order][1:] != anchors[order][:-1], [True]]))
        waiting: list[tuple] = []
        held = 0

        def settled() -> None:
            texts, counts, at = [w[0] for w in waiting], [w[1] for w in waiting], [w[2] for w in waiting]
            for first, count, place in zip(first_places(texts, counts, at), counts, at):
                gone.extend((place[1], place[2] + a, place[2] + b + LENGTH - 1) for a, b in _runs(~first))
            waiting.clear()

        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if b - a == 1:
                continue
            distinct: dict[bytes, tuple] = {}
            for k in order[a:b].tolist():
                count = int(windows[k])
                own = text[int(stops[k]) - count - LENGTH + 1 : int(stops[k])]
                place = tuple(places[k].tolist())
                known = distinct.get(own)
                if known is None or place < known:
                    distinct[own] = place
                    place = known
                if place is not None:
                    gone.append((place[1], place[2], place[2] + count + LENGTH - 1))
            if len(distinct) > 1:
                waiting.extend((t, len(t) - LENGTH + 1, p) for t, p in distinct.items())
                held += sum(map(len, distinct))
                if held > _SORTED_BYTES:
                    settled()
                    held = 0
        if waiting:
            settled()
        for at in range(0, len(gone), 100_000):
            columns = list(zip(*gone[at : at + 100_000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["row", "start", "stop"])

    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] != part:
                if found:
                    yield from out()
                part, found = row["part"], []
            found.append(row)
    if found:
        yield from out()


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])
    for batch in batches:
        rows, held = [], 0
        for doc, text, ranges in zip(*(batch.column(k) for k in range(3))):
            data = (text.as_py() or "").encode()
            spans: list[list[int]] = []
            for r in sorted((r["start"], r["stop"]) for r in ranges.as_py() or ()):
                if spans and r[0] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], r[1])
                else:
                    spans.append(list(r))
            cuts = [0, *(x for s in spans for x in s), len(data)]
            kept = b"".join([data[a:b] for a, b in zip(cuts[::2], cuts[1::2])])
            rows.append((doc.as_py(), len(data), len(data) - len(kept), len(spans), kept))
            held += len(kept) + 64
            if held > 8 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """For each row of docs: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes).

    Earlier means a smaller doc_id, then an earlier row (repeated rows; those without doc_id come last),
    then an earlier start. Null texts are empty; texts of under LENGTH bytes stay whole.
    """
    spark = docs.sparkSession
    docs = repeatable(docs.select("doc_id", "text"))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text"))
    tasks = max(1, rows.rdd.getNumPartitions())
    bits = min(12, max(2, (tasks - 1).bit_length()))
    counted = rows.select("text").mapInArrow(freeing(lambda b: _counted(b, bits)), "part int, keys binary, twice binary")
    most = FILTER_BYTES // (16 << bits)
    filters = counted.repartition("part").sortWithinPartitions("part").mapInArrow(freeing(lambda b: _repeated(b, most)), "part int, bits binary")
    filters = written(filters, "repeated")
    table = filters.toArrow()
    shared = spark.sparkContext.broadcast(list(zip(table.column(0).to_pylist(), table.column(1).to_pylist())))
    dropped(filters)

    schema = "part int, row long, start long, stop long, anchors binary, docs binary, rows binary, places binary, windows binary, text binary"
    sent = written(rows.mapInArrow(freeing(lambda b: _stretches(b, Filter(shared.value, bits))), schema), "stretches")
    resolved = (
        sent.filter("part is not null").select("part", "anchors", "docs", "rows", "places", "windows", "text")
        .repartition("part").sortWithinPartitions("part").mapInArrow(freeing(_resolved), "row long, start long, stop long")
    )
    resolved = written(resolved, "removed")
    gone = resolved.unionByName(sent.filter("part is null").select("row", "start", "stop"))
    gone = gone.groupBy("row").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    both = rows.join(gone, "row", "left").select("doc_id", "text", "ranges")
    return both.mapInArrow(freeing(_kept), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
