"""Similarity join of documents on word shingles by signatures of token combinations.

All shingles have one global order: rare ones first, then those of the table of frequent shingles, by hash
within each class. A document with n shingles can lack e = n - ceil(percent * n / 100) of those of a partner.
Its signatures come from a prefix of that order. A rare shingle is a signature by itself, so e + 1 of them
would do for one signature in common, and e + 2 give two, which keeps chance pairs out. Frequent shingles are dealt into groups by hash and count as pairs of one group: a group with b
shingles in the prefix yields its pairs, survives the loss of b - 1 of them, and the prefix is extended
until what all groups and the rare shingles survive is e + 2. Linked documents then share two signatures.

Equal sets become one node first. Documents of a signature are compared with the one that has the fewest
shingles before it, so a group of copies costs its size and not its square. Where a signature still has
several components after that, and a few documents, those of different components are compared with each
other; where it has many, those of neighbouring size classes are. Where a class has many as well, one of them is
their hub, and only documents are compared that have rare ones of the shingles in common in which they differ
from the hub. A pair leaves the join at its first two signatures in common and at few others, not at each of
hundreds. Of the pairs only those are compared in full whose parity maps differ in no more bits than linked sets
may in shingles; a map has as many bits as its set has shingles or more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phasediff.llm.components import components
from phasediff.llm.lm_score import Filter, parts_of
from phasediff.llm.store import dropped, freeing, repeatable, written
from phasediff.llm.suffix_dedup import FILTER_BYTES, bounded
from phasediff.llm.text import LOWER, NOT_SPACE, bounds, hashes, joined, mixed, slices

#: The table of frequent shingles has so many rows at most (8 bytes each). It orders the work; whatever it
#: holds, the links are the same.
FREQUENT = 200_000
FREQUENT_LEAST = 12

_SECOND = np.uint64(0xD6E8FEB86659FD93)
_CHUNK = 1 << 20
FILTER_BITS = 4

#: Words of 64 bits that a parity map has at least: bit h is set where an odd number of its set's shingles has it.
#: Two maps differ in no more bits than their sets do in shingles. Larger sets have larger maps, in powers of two;
#: a map folded to half its words is the smaller map of its set.
MAP_WORDS = 16
MAP = [f"m{k}" for k in range(MAP_WORDS)]

#: Linked documents share so many signatures at least; those of fewer than SMALL shingles one.
SHARED = 2
SMALL = 4

#: A set's row of a signature has so many signatures before it: where two sets have two of them in common, they met.
RECENT = 4

#: Documents of a signature that so few have are compared with each other. Larger groups are cut by size class;
#: where one is still larger, only documents are compared that have in common where they differ from the hub of
#: the class. The links are the same.
DIRECT = 200
#: A hub's shingles are sent once for so many of its sets.
HUB_ROWS = 1_000


@dataclass(frozen=True)
class Join:
    """Documents link where 100 * shared >= percent * (shingles of either); percent from 60 to 99."""

    shingle: int = 3
    percent: int = 90

    def __post_init__(self) -> None:
        if not 60 <= self.percent <= 99:
            raise ValueError("percent must be from 60 to 99")


def shingle_sets(texts: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row in the batch, sorted distinct shingle hashes); a shorter text is one shingle, an empty one has none."""
    for first, last, data, offsets in slices(texts):
        data = LOWER[data]
        starts, ends, firsts = bounds(data, offsets, NOT_SPACE)
        words = hashes(data, starts, ends)
        runs = joined(words, size)
        for k in range(last - first):
            at, to = firsts[k], firsts[k + 1]
            if to - at >= size:
                yield first + k, np.unique(runs[at : to - size + 1])
            else:
                yield first + k, joined(words[at:to], int(to - at)) if to > at else words[:0]


def set_id(shingles: np.ndarray) -> int:
    """64-bit fingerprint of a set (its size and the sum of remixed hashes)."""
    total = int(mixed(shingles ^ _SECOND).sum(dtype=np.uint64)) + len(shingles) * int(_SECOND)
    return int(mixed(np.array([total % 2**64], np.uint64)).view(np.int64)[0])


def parity_map(shingles: np.ndarray) -> np.ndarray:
    size = 64 * max(MAP_WORDS, (1 << max(0, len(shingles) - 1).bit_length()) // 64)
    bits = np.bincount((mixed(shingles ^ _SECOND) % np.uint64(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def folded(maps: DataFrame) -> DataFrame:
    """set and its map in MAP_WORDS columns."""
    turns = f"sequence(0, CAST(size(map) div {MAP_WORDS} AS int) - 1)"
    return maps.select("set", *[F.expr(f"aggregate({turns}, 0L, (x, j) -> x ^ map[{MAP_WORDS} * j + {k}])").alias(m) for k, m in enumerate(MAP)])


def _most(percent: int) -> str:
    """SQL: in how many shingles two linked sets of n and n_2 may differ."""
    return f"(n + n_2 - 2 * (({percent}L * (n + n_2) + {99 + percent}L) div {100 + percent}L))"


def _alike(percent: int) -> str:
    """SQL: the folded maps of two sets (n, n_2, m0 and so on) do not rule out that the sets link."""
    return f"{' + '.join(f'bit_count({m} ^ {m}_2)' for m in MAP)} <= {_most(percent)}"


def alike(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose maps (set, n, map) do not rule out that they link; their sizes do not."""

    def as_small(own: str, other: str) -> str:
        return f"IF(size({own}) > size({other}), transform({other}, (x, k) -> {own}[k] ^ {own}[k + size({other})]), {own})"

    differ = f"zip_with({as_small('map', 'map_2')}, {as_small('map_2', 'map')}, (x, y) -> bit_count(x ^ y))"
    left = maps.select(F.col("set").alias("a"), "n", "map")
    right = maps.select(F.col("set").alias("b"), F.col("n").alias("n_2"), F.col("map").alias("map_2"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    return both.filter(f"aggregate({differ}, 0, (s, x) -> s + x) <= {_most(percent)}").select("a", "b")


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """row, doc_id, set, n of each document, and at the end the shingles that this task saw often."""
    seen: set[int] = set()
    pending: list[np.ndarray] = []
    held = 0
    often: dict[int, int] = {}

    def count() -> None:
        if pending:
            values, counts = np.unique(np.concatenate(pending), return_counts=True)
            for v, c in zip(values[counts > 2].view(np.int64).tolist(), counts[counts > 2].tolist()):
                often[v] = often.get(v, 0) + c
            if len(often) > 2 * FREQUENT:
                for v in sorted(often, key=often.get)[: len(often) - FREQUENT]:
                    del often[v]
            pending.clear()

    for batch in batches:
        rows, docs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        out = []
        for k, shingles in shingle_sets(batch.column(2), size):
            node = set_id(shingles) if len(shingles) else None
            new = node is not None and node not in seen
            out.append((rows[k], docs[k], node, len(shingles), None, parity_map(shingles).tolist() if new else None))
            if new:
                seen.add(node)
                pending.append(shingles)
                held += len(shingles)
                if held > _CHUNK:
                    count()
                    held = 0
        yield _rows(out)
    count()
    if often:
        yield _rows([(None, None, None, None, [x for pair in often.items() for x in pair], None)])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ("row", "doc_id", "set", "n")
    columns = list(zip(*rows)) if rows else [()] * 6
    arrays = [pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(c, pa.list_(pa.int64())) for c in columns[4:]]
    return pa.RecordBatch.from_arrays(arrays, names=[*names, "often", "map"])


def groups_of(size_class: int) -> int:
    """Groups of frequent shingles for documents of 2 ** size_class shingles or more."""
    return max(1, (1 << size_class) // 30)


def signatures(shingles: np.ndarray, frequent: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(signatures, at most so many shared shingles may be before each), see the module text."""
    n = len(shingles)
    least = -(-percent * n // 100)
    need = n - least + SHARED
    place = np.searchsorted(frequent, shingles)
    common = frequent[np.minimum(place, len(frequent) - 1)] == shingles if len(frequent) else np.zeros(n, bool)
    rare = shingles[~common]
    singles = rare[:need]
    if len(rare) >= need:
        return singles, np.arange(len(singles))
    rest = shingles[common]
    spread = mixed(rest ^ _SECOND)
    found, places = [singles], [np.arange(len(singles))]
    for size_class in {n.bit_length() - 1, least.bit_length() - 1}:
        groups = groups_of(size_class)
        group = (spread % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        in_group = group[order]
        start = np.searchsorted(in_group, in_group)
        rank = np.empty(len(rest), np.int64)
        rank[order] = np.arange(len(rest)) - start
        enough = np.flatnonzero(np.cumsum(rank > 0) >= need - len(rare))
        end = int(enough[0]) + 1 if len(enough) else len(rest)
        order = order[order < end]
        in_group = group[order]
        salt = np.uint64(2 * size_class + 1)
        for back in range(1, int(rank[:end].max(initial=0)) + 1):
            same = in_group[back:] == in_group[:-back]
            first, second = order[:-back][same], order[back:][same]
            found.append(mixed(rest[first] * salt + mixed(rest[second] ^ salt)))
            places.append(np.maximum(len(rare) + second - groups, 0))
    return np.concatenate(found), np.concatenate(places)


def _signatures(batches: Iterator[pa.RecordBatch], join: Join, frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    names = ["sig", "set", "n", "place"]
    for batch in batches:
        parts: list[tuple] = []
        held = 0
        for _, shingles in shingle_sets(batch.column(0), join.shingle):
            node = set_id(shingles) if len(shingles) else None
            if node is None or node in seen:
                continue
            seen.add(node)
            sigs, places = signatures(shingles, frequent, join.percent)
            parts.append((sigs, places, node, len(shingles)))
            held += len(sigs)
            if held > _CHUNK:
                yield _signature_rows(parts, names)
                parts, held = [], 0
        if parts:
            yield _signature_rows(parts, names)


def _signature_rows(parts: list[tuple], names: list[str]) -> pa.RecordBatch:
    counts = [len(p[0]) for p in parts]
    columns = [
        np.concatenate([p[0] for p in parts]).view(np.int64),
        np.repeat(np.array([p[2] for p in parts], np.int64), counts),
        np.repeat(np.array([p[3] for p in parts], np.int32), counts),
        np.concatenate([p[1] for p in parts]).astype(np.int32),
    ]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def repeated(sigs: DataFrame) -> DataFrame:
    """sig, set, n, place of the signatures that several sets have, a row for each set.

    Each task with a copy of a set sends its signatures. Only one of these rows may stay: the others would make
    pairs of copies at every signature, and one signature in common would count as several.
    """
    twice = sigs.groupBy("sig").agg(F.min("set").alias("low"), F.max("set").alias("high")).filter("low <> high").select("sig")
    return sigs.join(twice, "sig").groupBy("sig", "set").agg(F.min("n").alias("n"), F.min("place").alias("place"))


def _parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = mixed(batch.column(0).to_numpy().view(np.uint64))
        part = parts_of(keys, FILTER_BITS)
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.concatenate([[True], np.diff(part[order]) > 0, [True]])) if len(keys) else [0]
        found = [(int(part[order[x]]), keys[order[x:y]].tobytes()) for x, y in zip(cuts[:-1], cuts[1:])]
        columns = list(zip(*found)) if found else ([], [])
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary())], ["part", "keys"])


def _filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part: one filter for each part."""
    part, found = None, []

    def out() -> pa.RecordBatch:
        keys = np.unique(np.frombuffer(b"".join(found), np.uint64))
        bits = bounded(keys, FILTER_BYTES // (16 << FILTER_BITS)).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([bits], pa.binary())], ["part", "bits"])

    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] != part:
                if found:
                    yield out()
                part, found = row["part"], []
            found.append(row["keys"])
    if found:
        yield out()


def row_filter(rows: DataFrame) -> Broadcast:
    """A Bloom filter of row numbers, of FILTER_BYTES at most; parts that would be larger let every row through."""
    parts = rows.mapInArrow(freeing(_parted), "part int, keys binary").repartition("part").sortWithinPartitions("part")
    found = parts.mapInArrow(freeing(_filters), "part int, bits binary").toArrow()
    return rows.sparkSession.sparkContext.broadcast(list(zip(found.column(0).to_pylist(), found.column(1).to_pylist())))


def _full_sets(batches: Iterator[pa.RecordBatch], size: int, wanted: Broadcast) -> Iterator[pa.RecordBatch]:
    inside = Filter(wanted.value, FILTER_BITS)
    for batch in batches:
        chosen = inside.levels(mixed(batch.column(0).to_numpy().view(np.uint64)), 1) > 0
        batch = batch.filter(pa.array(chosen))
        ids, values, held = [], [], 0
        for k, shingles in shingle_sets(batch.column(1), size):
            ids.append(set_id(shingles) if len(shingles) else None)
            values.append(shingles.tobytes())
            held += len(values[-1])
            if held > 8 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(values, pa.binary())], ["set", "shingles"])
                ids, values, held = [], [], 0
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(values, pa.binary())], ["set", "shingles"])


def _linked(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for left, right in zip(batch.column(2), batch.column(3)):
            a, b = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
            if len(a) > len(b):
                a, b = b, a
            shared = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
            keep.append(100 * shared >= percent * (len(a) + len(b) - shared))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _possible(percent: int, n: str, place: str, other_n: str, other_place: str) -> str:
    """SQL: sizes fit, and enough shingles are left after the places if none before them is shared."""
    most = f"least({n} - {place}, {other_n} - {other_place})"
    return f"100L * {most} >= {percent} * ({n} + {other_n} - {most})"


def candidates(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b) of pairs (set, n, place, set_2, n_2, place_2) that may link.

    There is a row for the first SHARED signatures in common at least. The smallest places are those of the first.
    """
    fits = f"100L * least(n, n_2) >= {percent}L * greatest(n, n_2)"
    pairs = pairs.filter("set <> set_2").filter(fits)
    own = F.col("set") < F.col("set_2")
    sides = [F.when(own, F.col(c)).otherwise(F.col(f"{c}_2")).alias(f"{c}_a") for c in ("n", "place")]
    sides += [F.when(own, F.col(f"{c}_2")).otherwise(F.col(c)).alias(f"{c}_b") for c in ("n", "place")]
    pairs = pairs.select(F.least("set", "set_2").alias("a"), F.greatest("set", "set_2").alias("b"), *sides)
    pairs = pairs.groupBy("a", "b", "n_a", "n_b").agg(
        F.count("*").alias("shared"), F.min("place_a").alias("place_a"), F.min("place_b").alias("place_b")
    )
    enough = (F.col("shared") >= SHARED) | (F.least("n_a", "n_b") < SMALL)
    return pairs.filter(enough).filter(_possible(percent, "n_a", "place_a", "n_b", "place_b")).select("a", "b")


def _most_apart(percent: int, n: np.ndarray, other: np.ndarray) -> np.ndarray:
    """In how many shingles two linked sets of these sizes may differ."""
    return n + other - 2 * -(-percent * (n + other) // (100 + percent))


def prefixes(n: int, hub: int, differ: int, percent: int) -> tuple[bool, int, int]:
    """For a set of n shingles that differs from its hub's in so many: does it link with the hub, and how many of
    the first differing shingles must hold one in common with a linked set that does not link with the hub, and
    with one that does. A prefix of more than differ shingles tells that there may be none in common.

    Of two sets that differ from the hub in d and e shingles and from each other in t at most, (d + e - t) / 2
    of these shingles are the same.
    """
    sizes = np.arange(max(1, -(-percent * n // 100)), 100 * n // percent + 1)
    apart = _most_apart(percent, np.int64(n), sizes)
    links_hub = _most_apart(percent, sizes, np.int64(hub))
    nearest = np.maximum(np.maximum(differ - apart, np.abs(sizes - hub)), 1)
    linked = bool(differ <= _most_apart(percent, np.int64(n), np.int64(hub)))

    def prefix(least: np.ndarray, possible: np.ndarray) -> int:
        common = np.maximum(-(-(differ + least - apart) // 2), 0)
        return differ - int(common[possible].min()) + 1 if possible.any() else 0

    outer = prefix(np.maximum(nearest, links_hub + 1), apart >= 0)
    inner = 0 if linked else prefix(nearest, (apart >= 0) & (nearest <= links_hub))
    return linked, outer, inner


def _differences(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """hub, set, n, label and both sets' shingles to the shingles in which they differ and the prefixes of them."""
    names = ["hub", "set", "n", "label", "linked", "outer", "inner", "differ"]
    for batch in batches:
        rows, held = [], 0
        for hub, node, n, label, left, right in zip(*batch.columns):
            center, own = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
            differ = np.setxor1d(center, own, assume_unique=True)
            found = prefixes(len(own), len(center), len(differ), percent)
            rows.append((hub.as_py(), node.as_py(), n.as_py(), label.as_py(), *found, differ.view(np.int64)))
            held += len(differ)
            if held > _CHUNK:
                yield _difference_rows(rows, names)
                rows, held = [], 0
        if rows:
            yield _difference_rows(rows, names)


def _difference_rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def around_hubs(hubs: DataFrame, full: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """(a, b) that may link, of sets with a common hub and different labels.

    hubs: (hub, hub_label, set, n, label); full: (set, shingles). Sets that link with the hub itself are told with
    it, unless they have its label. Many sets that are close to a hub but do not link with
    it share nearly everything, so what tells which of them link is where they differ from the hub: linked ones
    have differing shingles in common, the fewer sets have these the better. Shingles in which one set alone
    differs need no row.
    """
    crowd = hubs.groupBy("hub").agg(F.count("*").alias("crowd"))
    dealt = hubs.join(crowd, "hub").withColumn("salt", F.expr(f"pmod(xxhash64(set), 1 + crowd div {HUB_ROWS})")).drop("crowd")
    centers = dealt.select("hub", "salt").distinct().join(full.toDF("hub", "center"), "hub")
    members = dealt.join(full, "set")
    both = members.join(centers, ["hub", "salt"]).select("hub", "set", "n", "label", "center", "shingles")
    schema = "hub long, set long, n int, label long, linked boolean, outer int, inner int, differ array<long>"
    apart = written(both.mapInArrow(freeing(lambda b: _differences(b, percent)), schema), "differences")
    each = apart.select("hub", "set", F.explode("differ").alias("shingle"))
    shared = each.groupBy("hub", "shingle").agg(F.count("*").alias("times")).filter("times > 1")
    in_order = Window.partitionBy("hub", "set").orderBy("times", "shingle")
    among = Window.partitionBy("hub", "set")
    own = apart.select("hub", "set", "n", "label", "linked", "outer", "inner", F.size("differ").alias("d"))
    ranked = each.join(shared, ["hub", "shingle"]).select(
        "hub", "set", "shingle", (F.row_number().over(in_order) - 1).alias("turn"), F.count("*").over(among).alias("repeated")
    )
    ranked = ranked.join(own, ["hub", "set"]).withColumn("at", F.col("d") - F.col("repeated") + F.col("turn"))
    ranked = ranked.filter("at < greatest(outer, inner)").drop("turn", "repeated")
    # sets that need have no differing shingle in common meet at none
    free = own.filter("greatest(outer, inner) > d").withColumns({"shingle": F.lit(None).cast("long"), "at": F.lit(0)})
    keyed = written(ranked.unionByName(free.select(ranked.columns)).join(maps, "set"), "hub-signatures")
    other = keyed.select("hub", "shingle", *[F.col(c).alias(f"{c}_2") for c in keyed.columns if c not in ("hub", "shingle")])
    pairs = keyed.join(other, (keyed["hub"] == other["hub"]) & keyed["shingle"].eqNullSafe(other["shingle"]))
    pairs = pairs.filter("label <> label_2 and not linked_2").filter(
        "CASE WHEN linked THEN at < outer AND at_2 < inner_2 ELSE set < set_2 AND at < outer AND at_2 < outer_2 END"
    )
    pairs = pairs.filter(f"2 * least(d - at, d_2 - at_2) >= d + d_2 - {_most(percent)}").filter(_alike(percent))
    beside_hub = apart.filter("linked").join(hubs.select("hub", "hub_label").distinct(), "hub").filter("label <> hub_label")
    pairs = pairs.select("set", "set_2").union(beside_hub.select("set", "hub"))
    return pairs.select(F.least("set", "set_2").alias("a"), F.greatest("set", "set_2").alias("b")).distinct()


def ngram_join(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """For each row of docs: row, doc_id, n_shingles, component_id, component_row.

    component_id: the smallest doc_id reachable by links, the row's own included; component_row: the row
    (monotonically_increasing_id() of docs) that has it. Rows without doc_id come last in that order, so
    component_id is null only where all linked rows have none. Null and empty texts have no shingles and
    link with nothing. Repeated rows have equal sets and so one component. Only doc_id and text are read.
    Shingles are compared by 64-bit hashes.
    """
    docs = repeatable(docs)
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text"))
    sets = written(
        numbered.mapInArrow(freeing(lambda b: _sets(b, join.shingle)), "row long, doc_id long, set long, n long, often array<long>, map array<long>"),
        "sets",
    )
    pairs = F.expr("transform(sequence(0, size(often) - 2, 2), i -> struct(often[i] AS shingle, often[i + 1] AS times))")
    often = sets.filter("row is null and often is not null").select(F.inline(pairs))
    often = often.groupBy("shingle").agg(F.sum("times").alias("times")).filter(F.col("times") >= FREQUENT_LEAST)
    top = often.orderBy(F.desc("times"), "shingle").limit(FREQUENT).select("shingle").collect()
    frequent = np.sort(np.array([r[0] for r in top], np.int64).view(np.uint64))
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    maps = sets.filter("map is not null").groupBy("set").agg(F.first("n").alias("n"), F.first("map").alias("map"))
    sets = sets.filter("row is not null").drop("often", "map")

    sigs = written(
        docs.select("text").mapInArrow(freeing(lambda b: _signatures(b, join, shared.value)), "sig long, set long, n int, place int"),
        "signatures",
    )
    many = written(repeated(sigs), "repeated-signatures")
    dropped(sigs)
    heads = many.groupBy("sig").agg(F.min(F.struct("place", "set", "n")).alias("head"))
    beside = many.join(heads, "sig").select(
        "set", "n", "place", F.col("head.set").alias("set_2"), F.col("head.n").alias("n_2"), F.col("head.place").alias("place_2")
    )
    star = written(alike(candidates(beside, join.percent), maps, join.percent), "star")
    first = sets.filter("set is not null").groupBy("set").agg(F.min("row").alias("row"))

    def shingles_of(nodes: DataFrame) -> DataFrame:
        """set, shingles of the nodes and perhaps of others; they come from the first row of each node."""
        wanted = row_filter(nodes.join(first, "set").select("row"))
        return numbered.select("row", "text").mapInArrow(freeing(lambda b: _full_sets(b, join.shingle, wanted)), "set long, shingles binary")

    def linked(found: DataFrame) -> DataFrame:
        """The pairs that link."""
        full = written(shingles_of(found.select(F.explode(F.array("a", "b")).alias("set")).distinct()), "shingles")
        left = full.select(F.col("set").alias("a"), F.col("shingles").alias("left"))
        right = full.select(F.col("set").alias("b"), F.col("shingles").alias("right"))
        both = found.join(left, "a").join(right, "b").select("a", "b", "left", "right")
        return both.mapInArrow(freeing(lambda b: _linked(b, join.percent)), "a long, b long")

    links = written(linked(star), "links-1")
    labels = components(links)
    label = F.coalesce("label", "set").alias("label")
    marked = many.join(labels.withColumnRenamed("node", "set"), "set", "left").select("sig", "set", "n", "place", label)
    mixed_sigs = marked.groupBy("sig").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("members"))
    marked = marked.join(mixed_sigs.filter("low <> high").select("sig", "members"), "sig")
    in_order = Window.partitionBy("set").orderBy("place", "sig")
    recent = [F.lag("sig", k).over(in_order) for k in range(1, RECENT + 1)]
    marked = marked.withColumn("recent", F.array_compact(F.array(*recent)))
    # linked sets are of one size class or of neighbouring ones: in large groups only these meet
    size_class = F.floor(F.log("n") / F.log(F.lit(100 / join.percent)) + 1e-9).cast("int")
    cells = F.when(F.col("members") > DIRECT, F.array("class", F.col("class") + 1)).otherwise(F.array(F.lit(-1)))
    marked = marked.withColumn("class", size_class).withColumn("cell", F.explode(cells)).drop("members")
    marked = written(marked, "marked")
    mixed_cells = marked.groupBy("sig", "cell").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.min(F.struct("place", "set", "label")).alias("head"),
        F.count("*").alias("members"), F.min(F.struct("set", "label")).alias("hub"),
    )
    mixed_cells = mixed_cells.filter("low <> high").select(
        "sig", "cell", "members", F.col("hub.set").alias("hub"), F.col("hub.label").alias("hub_label"), F.col("head.label").alias("main")
    )
    marked = marked.join(mixed_cells, ["sig", "cell"])
    few = marked.filter(F.col("members") <= DIRECT)
    second = [F.col(c).alias(f"{c}_2") for c in ("set", "n", "place", "label", "class", "recent")]
    strays = few.filter("label <> main").select("sig", "cell", *second)
    across = strays.join(few, ["sig", "cell"]).filter("label <> label_2 and (label = main or set > set_2)")
    across = across.filter("cell = -1 or class <> class_2 or cell = class")
    across = across.filter(f"100L * least(n, n_2) >= {join.percent}L * greatest(n, n_2)")
    # two sets with SHARED recent signatures in common meet at these already, or at some before them
    across = across.filter(F.size(F.array_intersect("recent", "recent_2")) < SHARED)
    rest = candidates(across.select("set", "n", "place", "set_2", "n_2", "place_2"), join.percent)
    hubs = marked.filter((F.col("members") > DIRECT) & (F.col("set") != F.col("hub")))
    hubs = written(hubs.select("hub", "hub_label", "set", "n", "label").distinct(), "hubs")
    if not hubs.isEmpty():
        ends = hubs.select("set").union(hubs.select("hub")).distinct()
        full = written(shingles_of(ends), "hub-shingles")
        rest = rest.union(around_hubs(hubs, full, folded(maps), join.percent)).distinct()
    rest = written(alike(rest.join(star, ["a", "b"], "left_anti"), maps, join.percent), "rest")
    if not rest.isEmpty():
        labels = components(links.union(written(linked(rest), "links-2")))

    rows = sets.join(labels.withColumnRenamed("node", "set"), "set", "left").withColumn("label", F.coalesce("label", "set"))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    whole = rows.filter("label is not null").groupBy("label").agg(F.min(order).alias("first"))
    joined_rows = rows.join(whole, "label", "left")
    return joined_rows.select(
        "row",
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        F.coalesce("first.row", "row").alias("component_row"),
    )
