"""Alignment of two tokenizers over a corpus, with corpus-wide counts of the token pairs they link.

Texts are encoded once and stored as ids. A first pass aligns the stored documents and writes each task's pair
counts; the distinct pairs get a minimal perfect hash, part by part of their hash space. Every task's counts then
become dense vectors indexed by that hash, which are added up in a tree of groups of FAN. A second pass aligns
the documents again and looks each link up: a slot counts only if its stored key is the pair.

The table of pairs is sent to the workers in segments of SEGMENT_BYTES; beyond the first, every segment costs a
pass over the stored ids. How many there can be is bounded by the two vocabularies, not by the corpus.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasediff.llm.store import dropped, freeing, written
from phasediff.llm.text import mixed

SLICE_BYTES = 1 << 20
PARTS = 256
FAN = 64
SEGMENT_BYTES = 64 << 20

#: Pairs that a task holds before it writes them, and slots of a dense vector.
HELD = 1 << 20
VECTOR = 1 << 15
#: Rows of a batch of pairs.
_ROWS = 1 << 16

_LOAD = 1.5
_LEVELS = 40
_SEEDS = np.random.default_rng(20240812).integers(1, 2**64, _LEVELS + 1, dtype=np.uint64)


# ---------------------------------------------------------------- tokens and their bytes


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it is visible in Latin-1,
    otherwise the next unused one from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Pieces:
    """The bytes of every token of a vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def are(self, ids: np.ndarray, data: np.ndarray) -> bool:
        """Whether the bytes of these tokens are data."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        if not len(ids) or ends[-1] != len(data):
            return not len(ids) and not len(data)
        return bool((self.flat[np.repeat(self.starts[ids] - ends + lengths, lengths) + np.arange(len(data))] == data).all())


class ByteLevel:
    """Ids of the byte-level tokenizer.

    Most texts go through a faster library that merges by the rank of the joined bytes, not by a list of pairs.
    Both make the same merges if the list is in the order of ids and every token, taken alone, is merged into
    itself: were two parts of a token next to each other without being its listed pair, the token alone would end
    in these two parts. That is checked when the vocabulary is loaded. The classes of letters in both libraries may
    come from different versions of Unicode, so only texts below U+0250 take that way.
    """

    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    _OLD_LETTERS = re.compile("[\x00-\u024f]*").fullmatch

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        letters = byte_letters()
        texts = [self.library.id_to_token(k) for k in range(self.library.get_vocab_size())]
        self.pieces = Pieces([bytes(letters[c] for c in t) if t and all(c in letters for c in t) else (t or "").encode() for t in texts])
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        self.fast = self._fast(given) if self._same_merges(given, texts) else None

    def _same_merges(self, given: dict, texts: list[str]) -> bool:
        model, cut = given["model"], given["pre_tokenizer"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        vocabulary = model["vocab"]
        ordered = [vocabulary.get(x + y) for x, y in merges]
        plain = cut["type"] == "ByteLevel" and not cut["add_prefix_space"] and cut.get("use_regex", True) and given["normalizer"] is None
        bytes_first = all(vocabulary.get(c, 256) < 256 for c in byte_letters()) and ordered == list(range(256, 256 + len(merges)))
        return plain and bytes_first and all([x.id for x in self.library.model.tokenize(t)] == [k] for t, k in vocabulary.items() if k < 256 + len(merges))

    def _fast(self, given: dict):
        import tiktoken

        ranks = {self.pieces.tokens[k]: k for k in range(256 + len(given["model"]["merges"]))}
        return tiktoken.Encoding("byte-level", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        quick = [self.fast is not None and self._OLD_LETTERS(t) is not None for t in texts]
        others = self.library.encode_batch_fast([t for t, q in zip(texts, quick) if not q], add_special_tokens=False)
        rest = iter(others)
        return [np.array(self.fast.encode_ordinary(t) if q else next(rest).ids, np.int64) for t, q in zip(texts, quick)]


@lru_cache(2)
def tokenizers_of(a_path: str, b_path: str) -> tuple:
    """Both tokenizers with the bytes of their tokens."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece

    a = ByteLevel(a_path)
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    pieces = [(k, b.id_to_piece(k)) for k in range(b.get_piece_size())]
    b_pieces = Pieces([bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode() for k, p in pieces])
    return a, a.pieces, b, b_pieces


def _sizes(a_path: str, b_path: str) -> tuple[int, int]:
    _, a, _, b = tokenizers_of(a_path, b_path)
    return len(a.tokens), len(b.tokens)


def _encoded(texts: list[str], paths: tuple[str, str]) -> Iterator[tuple[bytes, bytes]]:
    """Ids of both tokenizers for each text; none where the joined bytes of either are not a space and the text."""
    a, a_pieces, b, b_pieces = tokenizers_of(*paths)
    for text, x, y in zip(texts, a.encode([" " + t for t in texts]), b.encode(texts, num_threads=1)):
        data, y = np.frombuffer((" " + text).encode(), np.uint8), np.array(y, np.int64)
        same = text and a_pieces.are(x, data) and b_pieces.are(y, data)
        yield (x.astype("<u4").tobytes(), y.astype("<u4").tobytes()) if same else (b"", b"")


def encoded(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id and the ids a and b (little-endian unsigned 32-bit) of each row of docs."""
    schema = pa.schema([("doc_id", pa.int64()), ("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            first = 0
            while first < len(texts):
                taken, last, size = [], first, 0
                while last < len(texts) and (last == first or size < SLICE_BYTES):
                    taken.append(texts[last].as_py() or "")
                    size += len(taken[-1])
                    last += 1
                pairs = list(_encoded(taken, (a_path, b_path)))
                columns = [ids.slice(first, last - first), pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
                first = last

    given = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return given.mapInArrow(freeing(run), "doc_id long, a binary, b binary")


# ---------------------------------------------------------------- alignment


@dataclass
class Aligned:
    """The tokens of some documents, one after the other, and where their bytes overlap."""

    a: np.ndarray
    b: np.ndarray
    a_rows: np.ndarray  # the first token of each document, and the number of all
    b_rows: np.ndarray
    link_rows: np.ndarray
    group_rows: np.ndarray
    pairs: np.ndarray  # of each link: id of a times the size of b's vocabulary, plus id of b
    a_ends: np.ndarray  # the token after the last of each group
    b_ends: np.ndarray


def aligned(a: list[bytes], b: list[bytes], a_pieces: Pieces, b_pieces: Pieces) -> Aligned:
    """Between two neighbouring token ends lies a stretch of exactly one token of each side: a link."""

    def tokens(parts: list[bytes], pieces: Pieces):
        rows = np.cumsum([0, *(len(p) // 4 for p in parts)])
        ids = np.frombuffer(b"".join(parts), "<u4").astype(np.int64)
        return ids, rows, np.cumsum(pieces.lengths[ids])

    x, x_rows, x_ends = tokens(a, a_pieces)
    y, y_rows, y_ends = tokens(b, b_pieces)
    both = np.concatenate([x_ends, y_ends])
    both.sort(kind="stable")
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    ends = both[new]
    of_a, of_b = np.searchsorted(x_ends, ends), np.searchsorted(y_ends, ends)
    groups = both[1:][~new[1:]]
    done = np.concatenate([[0], x_ends])[x_rows]
    return Aligned(
        x,
        y,
        x_rows,
        y_rows,
        np.searchsorted(ends, done, "right"),
        np.searchsorted(groups, done, "right"),
        (x[of_a] * len(b_pieces.tokens) + y[of_b]).astype(np.uint64),
        np.searchsorted(x_ends, groups, "right"),
        np.searchsorted(y_ends, groups, "right"),
    )


@lru_cache(2)
def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    texts = [str(k).encode() for k in range(size)]
    lengths = np.array([len(t) for t in texts])
    table = np.zeros((size, int(lengths.max()) + 1), np.uint8)
    for k, t in enumerate(texts):
        table[k, : len(t)] = np.frombuffer(t, np.uint8)
    return table, lengths


def group_texts(of: Aligned, size: int) -> list[bytes]:
    """`a1,a2|b1;a3|b2,b3` for each document: the ids of a and b in each group."""
    counts = np.diff(of.a_ends, prepend=0), np.diff(of.b_ends, prepend=0)
    before_a, before_b = np.repeat(of.b_ends - counts[1], counts[0]), np.repeat(of.a_ends, counts[1])
    at_a, at_b = np.arange(len(of.a)) + before_a, np.arange(len(of.b)) + before_b
    ids, mark = np.empty(len(at_a) + len(at_b), np.int64), np.full(len(at_a) + len(at_b), ord(","), np.uint8)
    ids[at_a], ids[at_b] = of.a, of.b
    mark[at_a[of.a_ends - 1]] = ord("|")
    mark[at_b[of.b_ends - 1]] = ord(";")
    table, lengths = _digits(size)
    cells, width = table[ids], lengths[ids]
    cells[np.arange(len(ids)), width] = mark
    flat = cells[np.arange(table.shape[1]) <= width[:, None]]
    ends = np.concatenate([[0], np.cumsum(width + 1)])[of.a_rows + of.b_rows]
    return [flat[s : max(s, e - 1)].tobytes() for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _slices(batch: pa.RecordBatch, a: int, b: int) -> Iterator[tuple[int, list[bytes], list[bytes]]]:
    """(first row, a, b) of stretches of rows with SLICE_BYTES of ids at most (a longer document is one of its own)."""
    xs, ys = batch.column(a).to_pylist(), batch.column(b).to_pylist()
    first, size = 0, 0
    for k, (x, y) in enumerate(zip(xs, ys)):
        if k > first and size + len(x) + len(y) > SLICE_BYTES:
            yield first, xs[first:k], ys[first:k]
            first, size = k, 0
        size += len(x) + len(y)
    if xs:
        yield first, xs[first:], ys[first:]


# ---------------------------------------------------------------- first pass: pairs of every task


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else order
    return keys[new], np.add.reduceat(counts, new) if len(keys) else counts


def task_pairs(ids: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """task, key and n: how often each pair is linked in what a task has read; a pair may come more than once."""
    schema = pa.schema([("task", pa.int64()), ("key", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, a_pieces, _, b_pieces = tokenizers_of(*paths)
        task = TaskContext.get().partitionId()
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def out() -> Iterator[pa.RecordBatch]:
            for at in range(0, len(keys), _ROWS):
                some = keys[at : at + _ROWS].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), task)), pa.array(some), pa.array(counts[at : at + _ROWS])], schema=schema)

        for batch in batches:
            for _, x, y in _slices(batch, 0, 1):
                own = np.unique(aligned(x, y, a_pieces, b_pieces).pairs, return_counts=True)
                keys, counts = _summed(np.concatenate([keys, own[0]]), np.concatenate([counts, own[1]]))
                if len(keys) > HELD:
                    yield from out()
                    keys, counts = keys[:0].copy(), counts[:0].copy()
        yield from out()

    return ids.select("a", "b").mapInArrow(freeing(run), "task long, key long, n long")


# ---------------------------------------------------------------- minimal perfect hash


def part_of(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys ^ _SEEDS[_LEVELS]) >> np.uint64(32)).astype(np.int64) % PARTS


class PerfectHash:
    """A slot from 0 to n - 1 for each of n different keys.

    On each level the keys that are left fall into _LOAD cells a key; those alone in their cell get it, the
    others go on. A key's slot is the number of taken cells before its own, over all levels. Keys left after the
    last level, if any, are kept in a list.
    """

    def __init__(self, sizes: list[int], bits: list[np.ndarray], rest: np.ndarray):
        self.sizes, self.bits, self.rest = sizes, bits, rest

    @staticmethod
    def of(keys: np.ndarray) -> PerfectHash:
        sizes, bits, left = [], [], np.sort(keys)
        for level in range(_LEVELS):
            if not len(left):
                break
            size = max(8, int(_LOAD * len(left)))
            cell = (mixed(left ^ _SEEDS[level]) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(cell, minlength=size) == 1
            sizes.append(size)
            bits.append(np.packbits(alone))
            left = left[~alone[cell]]
        return PerfectHash(sizes, bits, left)

    def tables(self) -> list[np.ndarray]:
        """The slot of each cell of each level, -1 for free ones."""
        out, taken = [], 0
        for size, bits in zip(self.sizes, self.bits):
            cells = np.unpackbits(bits, count=size).astype(bool)
            out.append(np.where(cells, np.cumsum(cells) - 1 + taken, -1).astype(np.int32))
            taken += int(cells.sum())
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slots of keys; any slot, or -1, for a key that is none of them."""
        return _Lookup([self]).slots(keys, np.zeros(len(keys), np.int64))

    def dump(self) -> bytes:
        head = json.dumps([self.sizes, len(self.rest)]).encode()
        return len(head).to_bytes(4, "little") + head + b"".join(b.tobytes() for b in self.bits) + self.rest.tobytes()

    @staticmethod
    def load(data: bytes) -> PerfectHash:
        at = 4 + int.from_bytes(data[:4], "little")
        sizes, rest = json.loads(data[4:at])
        bits = []
        for size in sizes:
            bits.append(np.frombuffer(data, np.uint8, (size + 7) // 8, at))
            at += (size + 7) // 8
        return PerfectHash(sizes, bits, np.frombuffer(data[at : at + 8 * rest], np.uint64))


class _Lookup:
    """Several perfect hashes at once: each level's tables lie one after the other."""

    def __init__(self, hashes: list[PerfectHash]):
        tables = [h.tables() for h in hashes]
        self.levels = []
        for level in range(max((len(t) for t in tables), default=0)):
            own = [t[level] if level < len(t) else np.full(1, -1, np.int32) for t in tables]
            sizes = np.array([len(t) for t in own], np.uint64)
            self.levels.append((np.concatenate(own), sizes, np.cumsum([0, *sizes[:-1].tolist()]).astype(np.int64)))
        self.rest = [(h.rest, sum(int((t >= 0).sum()) for t in own)) for h, own in zip(hashes, tables)]

    def slots(self, keys: np.ndarray, which: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (table, sizes, firsts) in enumerate(self.levels):
            k, w = keys[left], which[left]
            found = table[firsts[w] + (mixed(k ^ _SEEDS[level]) % sizes[w]).astype(np.int64)]
            here = found >= 0
            out[left[here]] = found[here]
            left = left[~here]
            if not len(left):
                return out
        for k in left.tolist():
            rest, taken = self.rest[int(which[k])]
            at = int(np.searchsorted(rest, keys[k]))
            if at < len(rest) and rest[at] == keys[k]:
                out[k] = taken + at
        return out


def _runs(batches: Iterator[pa.RecordBatch], keys: tuple[int, ...]) -> Iterator[tuple[tuple, Iterator[pa.RecordBatch]]]:
    """Stretches of rows with equal values in these columns, of rows sorted by them."""
    for batch in batches:
        values = [batch.column(k).to_numpy() for k in keys]
        new = np.zeros(max(0, batch.num_rows - 1), bool)
        for v in values:
            new |= v[1:] != v[:-1]
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for s, e in zip(cuts, cuts[1:]):
            if e > s:
                yield tuple(int(v[s]) for v in values), batch.slice(s, e - s)


def perfect_hashes(pairs: DataFrame) -> DataFrame:
    """part, n, hash and keys (uint64, by slot) for each part of the distinct keys of pairs."""
    schema = pa.schema([("part", pa.int64()), ("n", pa.int64()), ("hash", pa.binary()), ("keys", pa.binary())])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(part_of(keys.astype(np.uint64))), batch.column(0)], ["part", "key"])

    def built(part: int, found: list[np.ndarray]) -> pa.RecordBatch:
        keys = np.concatenate(found).astype(np.uint64)
        own = PerfectHash.of(keys)
        by_slot = np.empty_like(keys)
        by_slot[own.slots(keys)] = keys
        columns = [pa.array([part]), pa.array([len(keys)]), pa.array([own.dump()], pa.binary()), pa.array([by_slot.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, found = None, []
        for (part,), rows in _runs(batches, (0,)):
            if part != now and found:
                yield built(now, found)
                found = []
            now = part
            found.append(rows.column(1).to_numpy())
        if found:
            yield built(now, found)

    keys = pairs.select("key").distinct().mapInArrow(freeing(numbered), "part long, key long")
    return keys.repartition("part").sortWithinPartitions("part").mapInArrow(freeing(run), "part long, n long, hash binary, keys binary")


# ---------------------------------------------------------------- dense vectors, added up in a tree


_VECTORS = "part long, chunk long, grp long, counts binary"
_VECTOR_SCHEMA = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), ("grp", pa.int64()), ("counts", pa.binary())])


def _vector_rows(part: int, grp: int, counts: np.ndarray) -> pa.RecordBatch:
    chunks = [counts[k : k + VECTOR] for k in range(0, len(counts), VECTOR)]
    columns = [[part] * len(chunks), list(range(len(chunks))), [grp] * len(chunks), [c.tobytes() for c in chunks]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _VECTOR_SCHEMA)], schema=_VECTOR_SCHEMA)


def vectors(pairs: DataFrame, hashes: DataFrame) -> DataFrame:
    """part, chunk, grp and counts (int64 for each slot): the counts of FAN tasks each."""

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = own = counts = None
        for (part, grp, kind), rows in _runs(batches, (0, 1, 2)):
            if kind == 0:
                if now is not None and counts is not None:
                    yield _vector_rows(*now, counts)
                own, n = PerfectHash.load(rows.column(5)[0].as_py()), rows.column(4)[0].as_py()
                lookup = _Lookup([own])
                now, counts = (part, grp), np.zeros(n, np.int64)
            else:
                keys = rows.column(3).to_numpy().astype(np.uint64)
                np.add.at(counts, lookup.slots(keys, np.zeros(len(keys), np.int64)), rows.column(4).to_numpy())
        if now is not None:
            yield _vector_rows(*now, counts)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(1).to_numpy().astype(np.uint64)
            grp = batch.column(0).to_numpy() // FAN
            yield pa.RecordBatch.from_arrays(
                [pa.array(part_of(keys)), pa.array(grp), batch.column(1), batch.column(2)], ["part", "grp", "key", "n"]
            )

    none = F.lit(None).cast("binary").alias("hash")
    counted = pairs.mapInArrow(freeing(placed), "part long, grp long, key long, n long").select(
        "part", "grp", F.lit(1).cast("long").alias("kind"), "key", "n", none
    )
    groups = (pairs.agg(F.max("task")).first()[0] or 0) // FAN + 1
    all_groups = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
    given = hashes.select("part", all_groups.alias("grp"), F.lit(0).cast("long").alias("kind"), F.lit(0).cast("long").alias("key"), "n", "hash")
    rows = given.unionByName(counted).repartition("part", "grp").sortWithinPartitions("part", "grp", "kind")
    first = rows.mapInArrow(freeing(dense), _VECTORS)
    return first if groups == 1 else _tree(written(first, "pair-vectors"), groups)


def _tree(rows: DataFrame, groups: int) -> DataFrame:
    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = total = None
        for key, found in _runs(batches, (0, 1, 2)):
            if key != now and now is not None:
                yield row(now, total)
                total = None
            now = key
            for data in found.column(3).to_pylist():
                own = np.frombuffer(data, np.int64)
                total = own.copy() if total is None else total + own
        if now is not None:
            yield row(now, total)

    def row(key: tuple[int, int, int], total: np.ndarray) -> pa.RecordBatch:
        values = [*key, total.tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _VECTOR_SCHEMA)], schema=_VECTOR_SCHEMA)

    while groups > 1:
        groups = (groups + FAN - 1) // FAN
        higher = rows.withColumn("grp", F.expr(f"grp div {FAN}")).repartition("part", "chunk", "grp")
        rows = higher.sortWithinPartitions("part", "chunk", "grp").mapInArrow(freeing(added), _VECTORS)
        rows = written(rows, "pair-vectors") if groups > 1 else rows
    return rows


# ---------------------------------------------------------------- second pass: look the links up


class PairCounts:
    """Counts of the pairs of some parts, from rows of perfect_hashes() and vectors()."""

    def __init__(self, hashes: list[tuple[int, bytes, bytes]], counts: dict[int, bytes]):
        self.place = np.full(PARTS, -1, np.int64)
        self.place[[part for part, _, _ in hashes]] = np.arange(len(hashes))
        self.lookup = _Lookup([PerfectHash.load(h) for _, h, _ in hashes])
        keys = [np.frombuffer(k, np.uint64) for _, _, k in hashes]
        self.firsts = np.cumsum([0, *(len(k) for k in keys)])
        self.keys = np.concatenate([*keys, np.zeros(0, np.uint64)])
        self.counts = np.concatenate([*(np.frombuffer(counts[part], np.int64) for part, _, _ in hashes), np.zeros(0, np.int64)])

    def of(self, keys: np.ndarray) -> np.ndarray:
        """How often each pair is linked; 0 for pairs of other parts."""
        which = self.place[part_of(keys)]
        here = np.flatnonzero(which >= 0)
        slots = self.lookup.slots(keys[here], which[here])
        out = np.zeros(len(keys), np.int64)
        here, at = here[slots >= 0], (self.firsts[which[here]] + slots)[slots >= 0]
        same = self.keys[at] == keys[here]
        out[here[same]] = self.counts[at[same]]
        return out


@lru_cache(1)
def _loaded(number: int, holder) -> tuple[PairCounts, np.ndarray]:
    hashes, counts, best = holder.value
    return PairCounts(hashes, counts), best


_DONE = "doc_id long, a binary, b binary, n_found long, n_best long, count_sum long"
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, n_found long, groups binary"


def _looked_up(rows: DataFrame, paths: tuple[str, str], holder, number: int, last: bool) -> DataFrame:
    kinds = _RESULT if last else _DONE
    names = [k.split()[0] for k in kinds.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, a_pieces, _, b_pieces = tokenizers_of(*paths)
        size = max(len(a_pieces.tokens), len(b_pieces.tokens))
        table, best = _loaded(number, holder)
        for batch in batches:
            for first, x, y in _slices(batch, 1, 2):
                of = aligned(x, y, a_pieces, b_pieces)
                counts = table.of(of.pairs)
                found = counts > 0
                top = found & (counts == best[(of.pairs % np.uint64(len(b_pieces.tokens))).astype(np.int64)])
                sums = [np.diff(np.concatenate([[0], np.cumsum(v, dtype=np.int64)])[of.link_rows]) for v in (found, top, counts)]
                before = [c.to_numpy() for c in batch.slice(first, len(x)).columns[3:]]
                n_found, n_best, count_sum = (s + b for s, b in zip(sums, before))
                own = {"doc_id": batch.column(0).slice(first, len(x)), "n_found": n_found, "n_best": n_best, "count_sum": count_sum}
                if last:
                    own |= {"n_a": np.diff(of.a_rows), "n_b": np.diff(of.b_rows), "n_groups": np.diff(of.group_rows), "n_links": np.diff(of.link_rows)}
                    own["groups"] = pa.array(group_texts(of, size), pa.binary())
                else:
                    own |= {"a": pa.array(x, pa.binary()), "b": pa.array(y, pa.binary())}
                columns = [own[n] if isinstance(own[n], pa.Array) else pa.array(own[n].astype(np.int64)) for n in names]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(freeing(run), kinds)


def best_counts(hashes: DataFrame, counted: DataFrame, size: int) -> np.ndarray:
    """The highest count among the pairs of each id of b; the driver gets one number for each id."""
    schema = pa.schema([("b", pa.int64()), ("n", pa.int64())])

    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, keys, counts in zip(*(batch.column(k).to_pylist() for k in range(3))):
                own = np.frombuffer(counts, np.int64)
                b = (np.frombuffer(keys, np.uint64)[first : first + len(own)] % np.uint64(size)).astype(np.int64)
                top = np.zeros(size, np.int64)
                np.maximum.at(top, b, own)
                here = np.flatnonzero(top)
                yield pa.RecordBatch.from_arrays([pa.array(here), pa.array(top[here])], schema=schema)

    joined = counted.join(hashes.select("part", "keys"), "part").select(F.expr(f"chunk * {VECTOR}").alias("first"), "keys", "counts")
    best = np.zeros(size, np.int64)
    for b, n in joined.mapInArrow(freeing(highest), "b long, n long").groupBy("b").agg(F.max("n")).collect():
        best[b] = n
    return best


def aligned_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups (text) of each row of docs.

    Tokenizer a (a file of the tokenizers library) encodes a space and the text, b (a sentencepiece model that
    adds the space itself) the text. Offsets where both end a token cut the text into groups; every pair of
    tokens whose bytes overlap is a link. A pair's count is the number of its links in all of docs; count_sum adds
    the counts of a row's links, n_best is the number of links whose count is the highest of their id of b.
    A null or empty text, and one that either tokenizer does not give back, has no tokens: zeros and an empty
    groups text. Repeated rows count each time; an empty table gives an empty result; other columns are not
    read. Texts may have any length: one text's tokens are held at a time.
    """
    paths = (a_path, b_path)
    a_size, b_size = _sizes(*paths)
    if a_size * b_size >= 2**63:
        raise ValueError("pairs of these vocabularies do not fit into 64 bits")
    spark = docs.sparkSession
    ids = written(encoded(docs, *paths), "token-ids")
    pairs = written(task_pairs(ids, paths), "task-pairs")
    hashes = written(perfect_hashes(pairs), "pair-hashes")
    counted = written(vectors(pairs, hashes), "pair-counts")
    dropped(pairs)
    best = best_counts(hashes, counted, b_size)

    segments: list[list[int]] = [[]]
    room = 0
    for part, n in sorted(hashes.select("part", "n").collect()):  # PARTS rows at most
        if segments[-1] and room + 16 * n > SEGMENT_BYTES:
            segments.append([])
            room = 0
        segments[-1].append(part)
        room += 16 * n
    rows = ids.selectExpr("*", "0L AS n_found", "0L AS n_best", "0L AS count_sum")
    for k, parts in enumerate(segments):
        chosen = F.col("part").isin(parts) if parts else F.lit(False)
        own = sorted((r.part, bytes(r.hash), bytes(r["keys"])) for r in hashes.filter(chosen).toLocalIterator())
        counts: dict[int, list[tuple[int, bytes]]] = {}
        for r in counted.filter(chosen).toLocalIterator():
            counts.setdefault(r.part, []).append((r.chunk, bytes(r.counts)))
        joined = {part: b"".join(c for _, c in sorted(chunks)) for part, chunks in counts.items()}
        holder = spark.sparkContext.broadcast((own, joined, best))
        last = k == len(segments) - 1
        rows = _looked_up(rows, paths, holder, k, last)
        rows = rows if last else written(rows, f"looked-up-{k}")
    whole = F.expr("IF(n_found = n_links, n_best, raise_error('a pair has no count'))")
    return rows.withColumns({"n_best": whole.cast("long"), "groups": F.col("groups").cast("string")}).drop("n_found")
