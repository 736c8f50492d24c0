"""Language-model scores from a log-frequency Bloom filter.

Training counts every word and every pair of neighbours. A count c is quantised to 1 + floor(log2 c) levels
and an n-gram is entered into the filter once for each level up to its own, so the level of an n-gram is
read back by probing level after level until a probe fails. Pairs lie in the same part of the filter as
their first word. The filter is broadcast in segments of at most SEGMENT_BYTES; with more than one segment,
documents are scored once for each and every position counts in the segment of its first word.

log10 p(w | h) with k = BACKING, c1 and c2 the counts read back for h and hw, s(h) = SHARE * c1 / (c1 + k):
a pair in the filter has s(h) * c2 / c1 + (1 - s(h)) * p(w), all others have (1 - s(h)) * p(w), where p(w) is
the exact (c(w) + 1) / (N + V + 1). c1 and c2 are at most the exact counts of h and w, so a pair counts only if
its words do. Exact counts of the TABLE most frequent words are broadcast; those of all other words reach the
documents by joins, for w and for every h that the filter knows. A score depends neither on TABLE nor on the
number of tasks or segments: the filter has the same parts for any input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasediff.llm.quality_classifier import held_out
from phasediff.llm.store import dropped, freeing, repeatable, written
from phasediff.llm.text import LOWER, NOT_SPACE, bounds, hashes, mixed, slices

#: Words whose exact counts are broadcast (16 bytes each). It divides the work; the scores are the same.
TABLE = 1_000_000
#: Words whose exact count bounds that of a context: all of them. A smaller number is another, coarser model.
FREQUENT = 1 << 62
#: The filter has _SPLITS << PART_BITS parts.
PART_BITS = 8
#: Tokens whose words and pairs a task holds before it counts them.
HELD_TOKENS = 1_500_000
SEGMENT_BYTES = 96 << 20
STEP_BYTES = 16 << 20
SHARE = 0.8
BACKING = 4.0

END = np.uint64(0x5851F42D4C957F2D)
START = np.uint64(0x14057B7EF767814F)
HASHES = 7
LINE_BITS = 512
BITS_PER_ENTRY = 12.0
_SPLITS = 16
_PAIR = np.uint64(0xA0761D6478BD642F)
_CONTEXTS = np.uint64(16)
_LEVELS = np.exp2(np.arange(64)) * 1.5 - 0.5
_LEVELS[0] = 1.0


def tokens(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, tokens, offsets of rows in the tokens): words, then END, of each row."""
    for first, last, data, offsets in slices(texts):
        data = LOWER[data]
        starts, ends, firsts = bounds(data, offsets, NOT_SPACE)
        rows = np.arange(last - first)
        out = np.full(len(starts) + len(rows), END)
        word_row = np.repeat(rows, np.diff(firsts))
        out[np.arange(len(starts)) + word_row] = hashes(data, starts, ends)
        yield first, last, out, firsts + np.arange(len(firsts))


def contexts(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[offsets[:-1]] = START
    return before


def pair_keys(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hash of the pair; the high 16 bits are those of its first word."""
    low = mixed(mixed(before ^ _PAIR) + words)
    return ((before >> np.uint64(48)) << np.uint64(48)) | (low >> _CONTEXTS)


def parts_of(keys: np.ndarray, bits: int) -> np.ndarray:
    """The part of the filter: some bits of the first word, then four of the n-gram itself."""
    spread = (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(60)
    return ((keys >> np.uint64(64 - bits)) * np.uint64(_SPLITS) + spread).astype(np.int64)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts


def distinct(keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The different keys, in order, and how often each is there, by their high four bits; sorts keys in place.

    What a task makes from its keys is made for a sixteenth of them at a time. From four bits on, no part of the
    filter is divided by that.
    """
    keys.sort()
    cuts = np.searchsorted(keys, np.arange(1, 16, dtype=np.uint64) << np.uint64(60))
    for some in np.split(keys, cuts):
        if len(some):
            at = np.flatnonzero(np.concatenate([[True], some[1:] != some[:-1]]))
            yield some[at], np.diff(np.append(at, len(some)))


def _counted(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Counts of the task's words (size 1) and pairs (size 2), packed for each part of the filter."""
    held: dict[int, list[np.ndarray]] = {1: [], 2: []}
    many = 0

    def packed() -> Iterator[pa.RecordBatch]:
        for size, found in held.items():
            keys = np.concatenate(found)
            found.clear()
            for some, counts in distinct(keys):
                part = parts_of(some, bits)
                order = np.argsort(part, kind="stable")
                some, counts, part = some[order], counts[order].astype(np.uint32), part[order]
                cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
                small = counts < 255
                rows = []
                for a, b in zip(cuts[:-1], cuts[1:]):
                    large = counts[a:b][~small[a:b]]
                    rows.append((int(part[a]), size, some[a:b].tobytes(), np.minimum(counts[a:b], 255).astype(np.uint8).tobytes(), large.tobytes()))
                columns = list(zip(*rows))
                types = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["part", "size", "keys", "counts", "large"])

    for batch in batches:
        for _, _, words, offsets in tokens(batch.column(0)):
            held[1].append(words)
            held[2].append(pair_keys(contexts(words, offsets), words))
            # a text begins after a context of its own
            held[1].append(np.full(len(offsets) - 1, START))
            many += len(words)
            if many > HELD_TOKENS:
                yield from packed()
                many = 0
    if many:
        yield from packed()


def _entries(keys: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each level of each n-gram."""
    key = np.repeat(keys, levels)
    level = np.arange(len(key)) - np.repeat(np.cumsum(levels) - levels, levels)
    return key, level


def _hashed(keys: np.ndarray, level: np.ndarray | int) -> np.ndarray:
    return mixed(keys ^ mixed(np.atleast_1d(np.asarray(level, np.uint64)) + np.uint64(1)))


def _bits_of(h: np.ndarray) -> Iterator[np.ndarray]:
    """The bits of an entry within its line, from other bits of its hash than the line."""
    h = mixed(h)
    for k in range(HASHES):
        yield (h >> np.uint64(9 * k)) & np.uint64(LINE_BITS - 1)


def built(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The filter of one part as bytes: lines of LINE_BITS bits; all bits of an entry lie in one line."""
    levels = np.floor(np.log2(counts)).astype(np.int64) + 1
    key, level = _entries(keys, levels)
    lines = max(1, int(np.ceil(len(key) * BITS_PER_ENTRY / LINE_BITS)))
    bits = np.zeros(lines * LINE_BITS, bool)
    h = _hashed(key, level)
    line = (h >> np.uint64(32)) % np.uint64(lines) * np.uint64(LINE_BITS)
    for bit in _bits_of(h):
        bits[line + bit] = True
    return np.packbits(bits, bitorder="little")


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part: the filter of each part and the exact counts of its words."""
    schema = pa.schema([("part", pa.int32()), ("bits", pa.binary()), ("keys", pa.binary()), ("counts", pa.binary())])
    part, found = None, []

    def out() -> pa.RecordBatch:
        each: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in (1, 2):
            keys = [k for s, k, _ in found if s == size]
            counts = [c for s, _, c in found if s == size]
            each[size] = _summed(np.concatenate(keys), np.concatenate(counts)) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        bits = built(np.concatenate([each[1][0], each[2][0]]), np.concatenate([each[1][1], each[2][1]]))
        keys, counts = each[1]
        real = keys != START
        row = ([part], [bits.tobytes()], [keys[real].tobytes()], [counts[real].tobytes()])
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, schema)], schema=schema)

    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] != part:
                if found:
                    yield out()
                part, found = row["part"], []
            counts = np.frombuffer(row["counts"], np.uint8).astype(np.int64)
            counts[counts == 255] = np.frombuffer(row["large"], np.uint32)
            found.append((row["size"], np.frombuffer(row["keys"], np.uint64), counts))
    if found:
        yield out()


def _packed(column: pa.ChunkedArray) -> tuple[np.ndarray, bytes]:
    """Sizes of the values of a binary column and all their bytes in one."""
    sizes, pieces = [np.zeros(0, np.int64)], []
    for chunk in column.chunks:
        if len(chunk):
            chunk = chunk.cast(pa.large_binary())
            offsets = np.frombuffer(chunk.buffers()[1], np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
            sizes.append(np.diff(offsets))
            pieces.append(memoryview(chunk.buffers()[2])[offsets[0] : offsets[-1]])
    return np.concatenate(sizes), b"".join(pieces)


class Filter:
    """Some parts of the filter: offsets (in bytes) and lines of each part, -1 where it has none."""

    def __init__(self, parts: list[tuple[int, bytes]], bits: int):
        self._set([part for part, _ in parts], [len(data) for _, data in parts], b"".join(data for _, data in parts), bits)

    @classmethod
    def of(cls, parts: np.ndarray, sizes: np.ndarray, data: bytes, bits: int) -> Filter:
        """The filter over data as it is: a worker holds the broadcast bytes once."""
        made = cls.__new__(cls)
        made._set(parts, sizes, data, bits)
        return made

    def _set(self, parts, sizes, data: bytes, bits: int) -> None:
        self.bits = bits
        self.data = np.frombuffer(data, np.uint8)
        self.lines = np.zeros(_SPLITS << bits, np.uint64)
        self.start = np.zeros(_SPLITS << bits, np.uint64)
        at = 0
        for part, size in zip(parts, sizes):
            self.lines[part], self.start[part] = int(size) * 8 // LINE_BITS, at * 8
            at += int(size)

    def levels(self, keys: np.ndarray, most: int = len(_LEVELS)) -> np.ndarray:
        """Levels of distinct n-grams up to most, 0 for one that is not in the filter."""
        part = parts_of(keys, self.bits)
        level = np.zeros(len(keys), np.int64)
        open_ = np.flatnonzero(self.lines[part] > 0)
        step = 0
        while len(open_) and step < most:
            h = _hashed(keys[open_], step)
            p = part[open_]
            line = self.start[p] + (h >> np.uint64(32)) % self.lines[p] * np.uint64(LINE_BITS)
            hit = np.ones(len(open_), bool)
            for inside in _bits_of(h):
                bit = line + inside
                hit &= (self.data[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0
            open_ = open_[hit]
            step += 1
            level[open_] = step
        return level


def _looked_up(keys: np.ndarray, table: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, values[at], 0)


def _scored(
    batches, part_filter: Filter, here: range, words_of: np.ndarray, counts_of: np.ndarray, total: int, vocabulary: int, least: int = 1
):
    """Of each row: tokens, and for words of the broadcast table known tokens, base and model scores of the
    positions of this segment; other words with their places and the places that back off to them, and apart
    from these (times and backed 0) with c1 and c2 of each place whose pair is in the filter. A place whose
    context is in the filter but not in the table waits for the count of both: its context is in heads, and
    counts has that of its word where the table has it. Contexts of fewer than least are not bounded."""
    schema = pa.schema(
        [("row", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())]
        + [(name, pa.list_(pa.int64())) for name in ("keys", "heads", "counts", "times")]
        + [(name, pa.list_(pa.float64())) for name in ("backed", "c1", "c2")]
    )
    complete = len(words_of) == vocabulary
    all_of = total + vocabulary + 1
    for batch in batches:
        for first, last, words, offsets in tokens(batch.column(1)):
            rows = last - first
            row = np.repeat(np.arange(rows), np.diff(offsets))
            before = contexts(words, offsets)
            context = parts_of(before, part_filter.bits) // _SPLITS
            mine = (context >= here.start) & (context < here.stop)
            unique, back = np.unique(words, return_inverse=True)
            count = _looked_up(unique, words_of, counts_of)[back]
            heads, at_head = np.unique(before, return_inverse=True)
            pairs, at_pair = np.unique(pair_keys(before, words), return_inverse=True)
            head = part_filter.levels(heads)[at_head]
            pair = part_filter.levels(pairs)[at_pair]
            c1 = np.where(head > 0, _LEVELS[np.maximum(head, 1) - 1], 0.0)
            known = count > 0
            # the exact count of the word before; a text's start is in the filter only
            exact = np.where(before == START, 0, np.append(0, count[:-1]))
            # a complete table tells that a word outside has the count 0, as the join would
            told = (before != START) & (complete | (exact > 0))
            c1 = np.where(told & (exact >= (0 if least == 1 else least)), np.minimum(c1, exact), c1)
            c2 = np.where(pair > 0, np.minimum(_LEVELS[np.maximum(pair, 1) - 1], c1), 0.0)
            c2 = np.where(known | complete, np.minimum(c2, count), c2)
            share = SHARE * c1 / (c1 + BACKING)
            found = share * c2 / np.maximum(c1, 1)
            open_ = mine & ~told & (before != START) & (c1 > 0)
            settled = mine & ~open_
            direct = settled & known
            score = np.where(direct, np.log10(found + (1 - share) * (count + 1) / all_of), 0.0)
            # pairs of words outside the table wait for the word's count as well
            paired = np.flatnonzero(settled & ~known & (c2 > 0))
            waiting = settled & ~known & (c2 == 0)
            score += np.where(waiting, np.log10(1 - share), 0.0)
            base = np.where(mine & known, np.log10((count + 1) / all_of), 0.0)
            sums = [np.bincount(row, w, rows) for w in (mine, mine & known, base, score)]
            rest = np.flatnonzero(mine & ~known)
            order = rest[np.lexsort((words[rest], row[rest]))]
            new = np.ones(len(order), bool)
            new[1:] = (words[order][1:] != words[order][:-1]) | (row[order][1:] != row[order][:-1])
            at = np.flatnonzero(new)
            times = np.diff(np.append(at, len(order)))
            backed = np.add.reduceat(waiting[order].astype(float), at) if len(at) else np.zeros(0)
            later = np.flatnonzero(open_)
            places = np.concatenate([paired, later])
            none, zeros = np.zeros(len(at)), np.zeros(len(places), np.int64)
            is_later = np.arange(len(places)) >= len(paired)
            # a place whose word needs no join has its context as key: any spread of keys will do
            key = np.where(known[places], before[places], words[places])
            items = [
                np.concatenate([row[order[at]], row[places]]),
                np.concatenate([words[order[at]], key]).view(np.int64),
                np.concatenate([words[order[at]], before[places]]).view(np.int64),
                np.concatenate([np.zeros(len(at), np.int64), count[places]]),
                np.concatenate([times, zeros]),
                np.concatenate([backed, zeros]),
                np.concatenate([none, c1[places]]),
                np.concatenate([none, c2[places]]),
                np.concatenate([np.zeros(len(at), bool), is_later]),
            ]
            by_row = np.argsort(items[0], kind="stable")
            items = [v[by_row] for v in items]
            is_later = items.pop()
            lists = np.searchsorted(items[0], np.arange(rows + 1)).astype(np.int32)
            values = [pa.array(v) for v in items[1:]]
            values[1] = pa.array(items[2], mask=~is_later)
            values[2] = pa.array(items[3], mask=items[3] == 0)
            columns = [
                batch.column(0).slice(first, rows), pa.array(sums[0].astype(np.int64)), pa.array(sums[1].astype(np.int64)),
                pa.array(sums[2]), pa.array(sums[3]),
                *(pa.ListArray.from_arrays(lists, v) for v in values),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _steps(here: range, sizes: dict[int, int]) -> Iterator[range]:
    """Stretches of contexts with about STEP_BYTES of the filter each: the driver fetches one at a time."""
    start, held = here.start, 0
    for context in here:
        held += sizes.get(context, 0)
        if held >= STEP_BYTES:
            yield range(start, context + 1)
            start, held = context + 1, 0
    if start < here.stop:
        yield range(start, here.stop)


def lm_scores(docs: DataFrame) -> DataFrame:
    """For each row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows whose crc32(doc_id as text) mod 7 is not 2 (rows without doc_id teach too), scores
    all. A null or empty text has the token of its end only. Repeated rows are counted and scored each.
    Counts cover all training tokens; words and pairs are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    docs = repeatable(docs.select("doc_id", "text"))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long"),
        held_out(F.col("doc_id"), 7, 2).alias("held_out"),
        "text",
    )
    bits = PART_BITS
    counted = rows.filter("not held_out").select("text").mapInArrow(
        freeing(lambda b: _counted(b, bits)), "part int, size int, keys binary, counts binary, large binary"
    )
    merged = counted.repartition("part").sortWithinPartitions("part").mapInArrow(
        freeing(_merged), "part int, bits binary, keys binary, counts binary"
    )
    parts = written(merged, "filter")

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(keys, np.int64)), pa.array(np.frombuffer(counts, np.int64))], ["key", "count"]
                )

    counts = written(parts.select("keys", "counts").mapInArrow(freeing(unpacked), "key long, count long"), "words")
    sums = counts.agg(F.sum("count").alias("n"), F.count("*").alias("v")).first()
    total, vocabulary = int(sums.n or 0), int(sums.v)
    # counts from the limit on have TABLE words at most, whatever the vocabulary
    ladder = [2**k for k in range(48)]
    above = counts.agg(*[F.count(F.when(F.col("count") >= k, 1)).alias(f"k{i}") for i, k in enumerate(ladder)]).first()
    limit = next(k for i, k in enumerate(ladder) if above[i] <= TABLE)
    least = next(k for i, k in enumerate(ladder) if above[i] <= FREQUENT)
    top = counts.filter(F.col("count") >= limit).toArrow()
    order = np.argsort(top.column(0).to_numpy().view(np.uint64))
    words_of = top.column(0).to_numpy().view(np.uint64)[order]
    counts_of = top.column(1).to_numpy()[order]
    shared_words = spark.sparkContext.broadcast((words_of, counts_of))
    rare = counts.filter(F.col("count") < limit)

    sizes = parts.groupBy(F.expr(f"part div {_SPLITS}").alias("context")).agg(F.sum(F.octet_length("bits")).alias("size"))
    segments, start, held = [], 0, 0
    by_context = {r.context: r["size"] for r in sizes.collect()}
    for context, size in sorted(by_context.items()):
        if held and held + size > SEGMENT_BYTES:
            segments.append(range(start, context))
            start, held = context, 0
        held += size
    segments.append(range(start, 1 << bits))
    passes = []
    for here in segments:
        numbers, lengths, data = [], [], bytearray()
        for some in _steps(here, by_context):
            inside = parts.filter(F.col("part").between(some.start * _SPLITS, some.stop * _SPLITS - 1))
            found = inside.select("part", "bits").toArrow()
            size, more = _packed(found.column(1))
            numbers.append(found.column(0).to_numpy())
            lengths.append(size)
            data += more
            del found, more
        shared = spark.sparkContext.broadcast((np.concatenate(numbers), np.concatenate(lengths), data))
        del data

        def score(batches, shared=shared, here=here):
            return _scored(batches, Filter.of(*shared.value, bits), here, *shared_words.value, total, vocabulary, least)

        schema = (
            "row long, n_tokens long, n_known long, base double, score double, keys array<long>, heads array<long>, "
            "counts array<long>, times array<long>, backed array<double>, c1 array<double>, c2 array<double>"
        )
        passes.append(written(rows.select("row", "text").mapInArrow(freeing(score), schema), "scores"))
        shared.unpersist()
    dropped(parts)
    scored = passes[0]
    for one in passes[1:]:
        scored = scored.unionByName(one)

    count, c1 = F.coalesce("count", F.lit(0)), F.col("c1")
    single = (count + 1) / F.lit(float(total + vocabulary + 1))
    share = SHARE * c1 / (c1 + BACKING)
    pair = F.log10(share * F.least(F.col("c2"), count.cast("double")) / c1 + (1 - share) * single)
    items = scored.select("row", F.inline(F.arrays_zip("keys", "heads", "counts", "times", "backed", "c1", "c2")))
    others = items.filter("heads is null").join(rare, items["keys"] == rare["key"], "left").select(
        "row",
        F.lit(0).cast("long").alias("n_tokens"),
        F.when(F.col("count") > 0, F.col("times")).otherwise(F.lit(0)).alias("n_known"),
        (F.col("times") * F.log10(single)).alias("base"),
        F.when(F.col("c2") > 0, pair).otherwise(F.col("backed") * F.log10(single)).alias("score"),
    )
    # places whose context is outside the table: c1 and c2 as in the tasks, once both counts are there
    of_heads = rare.select(F.col("key").alias("head_key"), F.col("count").alias("head_count"))
    later = items.filter("heads is not null").join(rare, F.col("keys") == rare["key"], "left")
    later = later.join(of_heads, F.col("heads") == of_heads["head_key"], "left")
    word, head = F.coalesce("counts", "count", F.lit(0)), F.coalesce("head_count", F.lit(0))
    bound = F.when(head >= (0 if least == 1 else least), F.least("c1", head.cast("double"))).otherwise(F.col("c1"))
    later = later.select("row", word.alias("word"), bound.alias("c1"), F.least("c2", bound, word.cast("double")).alias("c2"))
    after = share * F.col("c2") / F.greatest("c1", F.lit(1.0)) + (1 - share) * (F.col("word") + 1) / F.lit(float(total + vocabulary + 1))
    none = [F.lit(0).cast("long").alias(c) for c in ("n_tokens", "n_known")]
    others = others.unionByName(later.select("row", *none, F.lit(0.0).alias("base"), F.log10(after).alias("score")))
    both = others.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score")])
    both = scored.select("row", "n_tokens", "n_known", "base", "score").unionByName(both)
    both = both.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score")])
    return rows.select("row", "doc_id", "held_out").join(both, "row").select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
    )
