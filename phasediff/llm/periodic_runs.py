"""Maximal periodic runs of words, found with a dictionary of basic factors.

A basic factor is a stretch of m = 1, 2, 4, ... words. Each level names the factors of the level before in pairs,
so equal names mean equal stretches; a factor that a text has once is dropped, and with it all longer ones. At
level m, occurrences of one factor at most m / 2 apart form an arithmetic progression; occurrences and
progressions within 2 m words of each other propose the periods from m to 2 m - 1. Proposals are extended both
ways by the names, and equal stretches keep their smallest period.

Words of many documents are named at once, each document apart, so no run crosses into another.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasediff.llm.text import NOT_SPACE, bounds, hashes, slices

LEAST_WORDS = 12


@dataclass(frozen=True)
class Level:
    """Names of the factors of one length that occur twice or more, by their first word."""

    length: int
    places: np.ndarray
    names: np.ndarray
    order: np.ndarray  # of the places, by name and then by place

    def names_at(self, places: np.ndarray) -> np.ndarray:
        """-1 where no repeated factor starts."""
        if not len(self.places):
            return np.full(len(places), -1)
        at = np.minimum(np.searchsorted(self.places, places), len(self.places) - 1)
        return np.where(self.places[at] == places, self.names[at], -1)


def _level(length: int, places: np.ndarray, keys: np.ndarray) -> Level:
    """The level of factors with these keys, without those that stand alone."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    name = np.cumsum(new) - 1
    repeated = np.bincount(name, minlength=1)[name] > 1 if len(name) else name > 0
    names = np.full(len(keys), -1)
    names[order[repeated]] = np.cumsum(new & repeated)[repeated] - 1
    kept = np.flatnonzero(names >= 0)
    place_of = np.cumsum(names >= 0) - 1
    return Level(length, places[kept], names[kept], place_of[order[repeated]])


def basic_factors(words: np.ndarray) -> list[Level]:
    """Levels of length 1, 2, 4, ... up to the longest one that has a repeated factor; words: a number for each word."""
    levels = [_level(1, np.arange(len(words)), words)]
    while len(levels[-1].places):
        last = levels[-1]
        after = last.names_at(last.places + last.length)
        whole = after >= 0
        keys = last.names[whole].astype(np.int64) * (int(last.names.max()) + 1) + after[whole]
        levels.append(_level(2 * last.length, last.places[whole], keys))
    return levels[:-1]


def proposals(level: Level) -> tuple[np.ndarray, np.ndarray]:
    """(first word, period) pairs to extend: two occurrences that lie from one to two lengths apart."""
    m = level.length
    place, name = level.places[level.order], level.names[level.order]
    if len(place) < 2:
        return place[:0], place[:0]
    linked = (name[1:] == name[:-1]) & (place[1:] - place[:-1] <= m // 2)
    chain = np.concatenate([[0], np.cumsum(~linked)])
    first = np.flatnonzero(np.concatenate([[True], ~linked]))
    last = np.append(first[1:], len(place)) - 1
    found = []
    # between two chains lies more than m / 2, so the fourth next one is beyond 2 m
    for step in (1, 2, 3) if m > 1 else (1,):
        for own, other in ((chain - step, last), (chain + step, first)):
            here = np.flatnonzero((own >= 0) & (own < len(first)))
            there = other[own[here]]
            x, y = (there, here) if other is last else (here, there)
            d = place[y] - place[x]
            good = (name[x] == name[y]) & (d >= m) & (d < 2 * m)
            found.append((place[x[good]], d[good]))
    at, period = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    # matches of one period that touch belong to one stretch
    apart = np.ones(len(at), bool)
    apart[1:] = (period[1:] != period[:-1]) | (at[1:] - at[:-1] > m)
    return at[apart], period[apart]


def runs(words: np.ndarray, least: int = LEAST_WORDS) -> np.ndarray:
    """Rows (start, length, period) of all maximal runs with at least so many words and two periods, in order."""
    levels = basic_factors(words)
    pairs = [proposals(level) for level in levels]
    if not pairs:
        return np.zeros((0, 3), np.int64)
    at, period = (np.concatenate(c) for c in zip(*pairs))
    right, left = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    for level in reversed(levels):
        a, b = level.names_at(at + right), level.names_at(at + period + right)
        right += np.where((a >= 0) & (a == b), level.length, 0)
        start = at - left - level.length
        a, b = level.names_at(start), level.names_at(start + period)
        left += np.where((a >= 0) & (a == b), level.length, 0)
    start, length = at - left, left + period + right
    long = length >= np.maximum(least, 2 * period)
    start, length, period = start[long], length[long], period[long]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    smallest = np.ones(len(start), bool)
    smallest[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    found = np.stack([start, length, period], axis=1)[smallest]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def kept_words(n: int, found: np.ndarray) -> np.ndarray:
    """False for words that lie in a run after its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, found[:, 0] + found[:, 2], 1)
    np.add.at(depth, found[:, 0] + found[:, 1], -1)
    return np.cumsum(depth[:-1]) == 0


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _rows(texts: pa.Array, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]]:
    """(number of words, number of runs, runs, text without repeats) for the documents of a slice."""
    for _, _, data, offsets in slices(texts):
        starts, ends, firsts = bounds(data, offsets, NOT_SPACE)
        n_words = np.diff(firsts)
        row = np.repeat(np.arange(len(n_words)), n_words)
        words = hashes(data, starts, ends)
        ids = np.unique(words, return_inverse=True)[1].astype(np.int64)
        found = runs(ids * len(n_words) + row, least)
        of_row = np.searchsorted(firsts, found[:, 0], "right") - 1
        kept = kept_words(len(words), found)
        bounds_of = np.searchsorted(of_row, np.arange(len(n_words) + 1))
        collapsed = []
        for k in range(len(n_words)):
            own = data[offsets[k] : offsets[k + 1]].tobytes().split()
            if bounds_of[k] < bounds_of[k + 1]:
                own = compress(own, kept[firsts[k] : firsts[k + 1]].tolist())
            collapsed.append(b" ".join(own))
        found[:, 0] -= firsts[of_row]
        yield n_words, np.diff(bounds_of), found, collapsed


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period) and collapsed (text) of each row of docs.

    A run is a stretch of words in which words one period apart are equal, with at least two periods and `least`
    words, which no neighbouring word prolongs; period is its smallest one. Runs are sorted by start and period.
    collapsed has the words joined by one space, without those in a run after its first period. Words are runs of
    other characters than white space and are compared by 64-bit hashes. Null and empty texts have no words, no
    runs and an empty collapsed text; repeated rows are judged one by one, an empty table gives an empty result,
    other columns are not read. A text longer than a slice is read as one piece: memory is in proportion to the
    longest text, times the number of levels in which it still has repeated factors.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for n_words, n_runs, found, collapsed in _rows(batch.column(1), least):
                ids = batch.column(0).slice(done, len(n_words))
                done += len(n_words)
                entries = pa.StructArray.from_arrays([pa.array(found[:, k]) for k in range(3)], fields=list(_RUN))
                ends = pa.array(np.concatenate([[0], np.cumsum(n_runs)]).astype(np.int32))
                columns = [ids, pa.array(n_words), pa.ListArray.from_arrays(ends, entries), pa.array(collapsed, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    given = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    kinds = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return given.mapInArrow(run, kinds)
