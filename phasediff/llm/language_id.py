"""Language identification by a small bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on a bounded sample. Whole texts are cut
into stretches of bytes which are read side by side; every byte gets language probabilities from what was
read before and after it in its stretch, and a document's probabilities are the mean over all its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phasediff.llm.quality_classifier import held_out
from phasediff.llm.store import written
from phasediff.llm.text import slices

UNKNOWN = "und"
PAD = 256


@dataclass(frozen=True)
class Training:
    """train_rows bounds the labelled rows read for training: those of the smallest hashes of each language, the
    languages in turn. With more languages than that, each has one row."""

    train_rows: int = 3_000
    hidden: int = 8
    stretch: int = 64
    batch: int = 256
    steps: int = 500
    rate: float = 0.02
    seed: int = 5


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """table[d]: inputs of update gate, reset gate and candidate for each byte; u[d]: their recurrent weights."""

    def __init__(self, labels: list[str], hidden: int, seed: int):
        rng = np.random.default_rng(seed)
        self.labels, self.hidden = labels, hidden
        self.table = rng.normal(0, 0.3, (2, 257, 3 * hidden)).astype(np.float32)
        self.u = rng.normal(0, 0.3, (2, hidden, 3 * hidden)).astype(np.float32)
        self.out = rng.normal(0, 0.3, (2 * hidden, len(labels))).astype(np.float32)
        self.bias = np.zeros(len(labels), np.float32)

    def _run(self, x: np.ndarray, way: int, keep: list | None = None) -> np.ndarray:
        """States after each byte; x: bytes by time and stretch, PAD leaves a state as it is."""
        h = self.hidden
        state = np.zeros((x.shape[1], h), np.float32)
        out = np.empty((len(x), x.shape[1], h), np.float32)
        for t in range(len(x)) if way == 0 else range(len(x) - 1, -1, -1):
            inner = self.table[way][x[t]]
            gates = _sigmoid(inner[:, : 2 * h] + state @ self.u[way][:, : 2 * h])
            update, reset = gates[:, :h] * (x[t] != PAD)[:, None], gates[:, h:]
            held = reset * state
            candidate = np.tanh(inner[:, 2 * h :] + held @ self.u[way][:, 2 * h :])
            if keep is not None:
                keep.append((t, state, gates, update, held, candidate))
            state = state + update * (candidate - state)
            out[t] = state
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        states = np.concatenate([self._run(x, 0), self._run(x, 1)], 2)
        scores = states @ self.out + self.bias
        np.exp(scores - scores.max(2, keepdims=True), out=scores)
        return scores / scores.sum(2, keepdims=True)

    def gradients(self, x: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross entropy over all bytes, by backpropagation through time in both directions."""
        h = self.hidden
        kept: tuple[list, list] = ([], [])
        states = np.concatenate([self._run(x, 0, kept[0]), self._run(x, 1, kept[1])], 2)
        scores = states @ self.out + self.bias
        np.exp(scores - scores.max(2, keepdims=True), out=scores)
        slope = scores / scores.sum(2, keepdims=True)
        slope[:, np.arange(x.shape[1]), label] -= 1
        slope *= (x != PAD)[:, :, None] / max(1, (x != PAD).sum())
        flat = slope.reshape(-1, slope.shape[2])
        d_out, d_bias = states.reshape(-1, 2 * h).T @ flat, flat.sum(0)
        from_above = slope @ self.out.T
        d_table, d_u = np.zeros_like(self.table), np.zeros_like(self.u)
        for way in (0, 1):
            d_state = np.zeros((x.shape[1], h), np.float32)
            u = self.u[way]
            for t, before, gates, update, held, candidate in reversed(kept[way]):
                d_state = d_state + from_above[t][:, way * h : (way + 1) * h]
                d_candidate = d_state * update * (1 - candidate**2)
                d_update = d_state * (candidate - before) * (x[t] != PAD)[:, None]
                d_held = d_candidate @ u[:, 2 * h :].T
                d_gates = np.concatenate([d_update, d_held * before], 1) * gates * (1 - gates)
                d_inner = np.concatenate([d_gates, d_candidate], 1)
                np.add.at(d_table[way], x[t], d_inner)
                d_u[way][:, : 2 * h] += before.T @ d_gates
                d_u[way][:, 2 * h :] += held.T @ d_candidate
                d_state = d_state * (1 - update) + d_held * gates[:, h:] + d_gates @ u[:, : 2 * h].T
        return [d_table, d_u, d_out, d_bias]


def trained(texts: list[str], labels: list[str], how: Training) -> Network:
    """Adam on random stretches; every language is drawn equally often."""
    names = sorted(set(labels))
    network = Network(names, how.hidden, how.seed)
    rng = np.random.default_rng(how.seed)
    data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    by_label = [[d for d, label in zip(data, labels) if label == name and len(d)] for name in names]
    if len(names) < 2 or not all(by_label):
        return network
    weights = [network.table, network.u, network.out, network.bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, how.steps + 1):
        label = rng.integers(0, len(names), how.batch)
        x = np.full((how.stretch, how.batch), PAD, np.int64)
        for k, name in enumerate(label):
            text = by_label[name][rng.integers(len(by_label[name]))]
            at = rng.integers(max(1, len(text) - how.stretch + 1))
            piece = text[at : at + how.stretch]
            x[: len(piece), k] = piece
        rate = how.rate * min(1, 2 * (1 - step / (how.steps + 1)))
        for w, g, m, v in zip(weights, network.gradients(x, label), first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g**2 - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return network


def pooled(network: Network, texts: pa.Array, stretch: int) -> np.ndarray:
    """Mean probabilities over all bytes of each text; zeros for an empty one."""
    out = []
    for _, _, data, offsets in slices(texts):
        sizes = np.diff(offsets)
        counts = -(-sizes // stretch)
        row = np.repeat(np.arange(len(sizes)), counts)
        first = np.concatenate([[0], np.cumsum(counts)])
        start = offsets[:-1][row] + (np.arange(len(row)) - first[row]) * stretch
        length = np.minimum(stretch, offsets[1:][row] - start)
        sums = np.zeros((len(sizes), len(network.labels)))
        order = np.argsort(-length, kind="stable")
        for at in range(0, len(order), 4096):
            some = order[at : at + 4096]
            steps = np.arange(int(length[some].max()))[:, None]
            inside = steps < length[some]
            x = np.where(inside, data[np.minimum(start[some] + steps, len(data) - 1)], PAD)
            p = network.probabilities(x) * inside[:, :, None]
            total = p.sum(0)
            for k in range(total.shape[1]):
                sums[:, k] += np.bincount(row[some], total[:, k], len(sizes))
        out.append(sums / np.maximum(sizes, 1)[:, None])
    return np.concatenate(out) if out else np.zeros((0, len(network.labels)))


def language(docs: DataFrame, how: Training = Training()) -> DataFrame:
    """For each row of docs: doc_id, held_out, lang_pred, score (its mean probability over all bytes).

    The network learns from text and lang of at most train_rows rows that are not held out and have both; every
    language among these has a row.
    lang_pred is und with score 0 where the text is null or has no letter, and everywhere if no language
    can be learned. Every whole text is read; repeated rows get equal answers.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.col("text").rlike(r"\p{L}").alias("readable"), "lang")
    known = rows.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("readable"))
    # the smallest hashes of each language, then of all languages in turn: every language has its first row
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ranked = known.select("doc_id", "lang", F.row_number().over(order).alias("place")).filter(F.col("place") <= how.train_rows)
    ranked = written(ranked, "sample")
    most = max(how.train_rows, ranked.filter("place = 1").count())
    chosen = ranked.orderBy("place", F.xxhash64("doc_id"), "doc_id", "lang").limit(most).select("doc_id", "lang").distinct()
    # a training row needs a few stretches: of longer texts, pieces from all over
    piece = F.expr(
        "array_join(transform(sequence(0, 7), i -> substr(text, cast(1 + i * greatest(length(text) - 256, 0) / 7 as int), 256)), '')"
    )
    taken = known.join(chosen, ["doc_id", "lang"]).select("doc_id", "lang", F.when(F.length("text") <= 2048, F.col("text")).otherwise(piece).alias("text"))
    # of repeated keys one text, so that none of them takes the place of a language
    sample = sorted(taken.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect())
    network = trained([r.text for r in sample], [r.lang for r in sample], how) if sample else None

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if network is None:
                names, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            else:
                p = pooled(network, batch.column(1), 256)
                known = np.array(batch.column(2).fill_null(False).to_pylist(), bool)
                names = np.where(known, np.array(network.labels)[p.argmax(1)] if len(p) else [], UNKNOWN).tolist()
                scores = np.where(known, p.max(1), 0.0) if len(p) else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    out = rows.select("doc_id", "text", "readable").mapInArrow(judge, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
