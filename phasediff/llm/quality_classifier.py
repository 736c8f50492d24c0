"""Quality classifier: gradient-boosted trees over histograms of document statistics.

Statistics of whole texts are taken once in numpy and stored. Trees are fitted to a bounded sample of the
labelled rows and kept as flat arrays of complete binary trees, which a batch of rows walks down level by
level with vectorised indexing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phasediff.llm.store import written
from phasediff.llm.text import LOWER, NOT_SPACE, bounds, hashes, joined, slices

_CLASSES = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "symbol": b"#*$%&|<>{}[]=~^_\\/@+",
    "stop": b".!?",
    "exclaim": b"!",
    "pause": b",;:",
    "bar": b"|",
    "space": b" \t\n\v\f\r",
    "line": b"\n",
    "wide": range(128, 256),
    "lead": range(192, 256),
}
FEATURES = (
    *_CLASSES, "log_words", "word_bytes", "distinct_words", "most_common", "distinct_pairs", "repeated_runs", "distinct_lines", "line_bytes",
)


@dataclass(frozen=True)
class Boosting:
    """train_rows bounds the labelled rows that trees are fitted to (those of the smallest hashes)."""

    train_rows: int = 20_000
    trees: int = 60
    depth: int = 4
    bins: int = 64
    rate: float = 0.15
    least_weight: float = 2.0
    ridge: float = 1.0


def _distinct(values: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, times of the most frequent one) of each row; rows are firsts[k] to firsts[k + 1]."""
    rows = len(firsts) - 1
    row = np.repeat(np.arange(rows), np.diff(firsts))
    order = np.lexsort((values, row))
    value, row = values[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    most = np.zeros(rows)
    np.maximum.at(most, row[at], np.diff(np.append(at, len(value))))
    return np.bincount(row[at], minlength=rows), most


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text; null and empty texts have zeros."""
    out = []
    for first, last, data, offsets in slices(texts):
        rows = last - first
        size = np.maximum(np.diff(offsets), 1)
        columns = []
        for members in _CLASSES.values():
            inside = np.zeros(256, np.uint8)
            inside[list(members)] = 1
            sums = np.concatenate([[0], np.cumsum(inside[data], dtype=np.int64)])
            columns.append((sums[offsets[1:]] - sums[offsets[:-1]]) / size)
        lower = LOWER[data]
        starts, ends, firsts = bounds(lower, offsets, NOT_SPACE)
        words = hashes(lower, starts, ends)
        counts = np.diff(firsts)
        some = np.maximum(counts, 1)
        total = np.concatenate([[0], np.cumsum(ends - starts)])
        distinct, most = _distinct(words, firsts)
        columns += [np.log1p(counts), (total[firsts[1:]] - total[firsts[:-1]]) / some, distinct / some, most / some]
        for length in (2, 6):
            runs = joined(words, length)
            row = np.repeat(np.arange(rows), counts)[: len(runs)]
            inside = np.arange(len(runs)) + length <= firsts[1:][row]
            n = np.bincount(row[inside], minlength=rows)
            d, _ = _distinct(runs[inside], np.concatenate([[0], np.cumsum(n)]))
            columns.append(d / np.maximum(n, 1))
        text_line = np.ones(256, bool)
        text_line[10] = False
        starts, ends, firsts = bounds(data, offsets, text_line)
        lines = np.maximum(np.diff(firsts), 1)
        distinct, _ = _distinct(hashes(data, starts, ends), firsts)
        columns += [distinct / lines, np.diff(offsets) / lines]
        out.append(np.stack(columns, 1))
    return np.concatenate(out).astype(np.float32) if out else np.zeros((0, len(FEATURES)), np.float32)


class Trees:
    """Complete binary trees as arrays: feature and limit of the inner nodes, value of the leaves."""

    def __init__(self, prior: float, feature: np.ndarray, limit: np.ndarray, value: np.ndarray):
        self.prior, self.feature, self.limit, self.value = prior, feature, limit, value

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for feature, limit, value in zip(self.feature, self.limit, self.value):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < len(feature):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            total += value[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def fitted(x: np.ndarray, y: np.ndarray, how: Boosting) -> Trees:
    """Trees for y (0 or 1); without rows of both kinds they give the smoothed share of 1."""
    share = (y.sum() + 1) / (len(y) + 2)
    prior = float(np.log(share / (1 - share)))
    inner, leaves = 2**how.depth - 1, 2**how.depth
    if len(y) == 0 or y.min() == y.max():
        return Trees(prior, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, how.bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    features, limits, values = [], [], []
    total = np.full(len(y), prior)
    for _ in range(how.trees):
        p = 1 / (1 + np.exp(-total))
        slope, weight = y - p, p * (1 - p)
        feature, limit = np.zeros(inner, int), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(how.depth):
            width, start = 2**level, 2**level - 1
            best = np.full(width, 1e-6)
            at_bin = np.full(width, how.bins)
            for f in range(x.shape[1]):
                key = (node - start) * how.bins + binned[:, f]
                s = np.bincount(key, slope, width * how.bins).reshape(width, -1).cumsum(1)
                w = np.bincount(key, weight, width * how.bins).reshape(width, -1).cumsum(1)
                s_all, w_all = s[:, -1:], w[:, -1:]
                gain = s**2 / (w + how.ridge) + (s_all - s) ** 2 / (w_all - w + how.ridge) - s_all**2 / (w_all + how.ridge)
                gain[(w < how.least_weight) | (w_all - w < how.least_weight)] = -1
                gain[:, len(edges[f]) :] = -1
                top = gain.argmax(1)
                better = gain[np.arange(width), top] > best
                best[better] = gain[np.arange(width), top][better]
                at_bin[better] = top[better]
                feature[start : start + width][better] = f
                limit[start : start + width][better] = edges[f][top[better]] if len(edges[f]) else np.inf
            node = 2 * node + 1 + (binned[np.arange(len(y)), feature[node]] > at_bin[node - start])
        leaf = node - inner
        s, w = np.bincount(leaf, slope, leaves), np.bincount(leaf, weight, leaves)
        value = how.rate * s / (w + how.ridge)
        total += value[leaf]
        features.append(feature)
        limits.append(limit)
        values.append(value)
    return Trees(prior, np.array(features), np.array(limits), np.array(values))


def held_out(doc_id: Column, parts: int = 3, part: int = 1) -> Column:
    """crc32 of doc_id as text leaves this remainder; false without doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, how: Boosting = Boosting()) -> DataFrame:
    """For each row of docs: doc_id, held_out, score (0 to 1, likelihood of quality 1), predicted.

    Trees learn from labels (doc_id, quality) of rows that are not held out, at most train_rows of them,
    and see statistics of the text only. Rows with null labels teach nothing; repeated labels each count.
    Null and empty texts are scored by their zeros. Without labels all rows get the same score.
    """
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = statistics(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v.tobytes() for v in values], pa.binary())], ["doc_id", "x"])

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(measure, "doc_id long, x binary")
    rows = written(rows, "statistics")
    known = labels.filter("quality is not null and doc_id is not null").select(F.col("doc_id").cast("long"), "quality")
    known = known.filter(~held_out(F.col("doc_id"))).join(rows, "doc_id")
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "x").limit(how.train_rows).select("x", "quality").collect()
    x = np.frombuffer(b"".join(r.x for r in sample), np.float32).reshape(-1, len(FEATURES))
    trees = fitted(x, np.array([float(r.quality) for r in sample]), how)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float32).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(trees.score(x))], ["doc_id", "score"])

    scores = rows.mapInArrow(judge, "doc_id long, score double")
    return scores.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
