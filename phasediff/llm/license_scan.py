"""Licence scan: matching statistics of texts against a generalised suffix automaton of licence templates.

The automaton holds every run of consecutive words of every template. Reading a text word by word gives,
for each place, the longest run of template words that ends there, and with it the places of each template
where a match ends. Long matches of one template whose places increase in both text and template are chained
over the whole document, across at most most_gap other words; what a chain covers of its template is its score.
A stretch of text that several templates nearly have counts for the one that covers most of it.
A match consists of short runs that some template has, so only stretches of such runs are read by the automaton.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasediff.llm import licences
from phasediff.llm.text import ALPHANUMERIC, LOWER, bounds, hashes, slices

#: Phrases whose places are counted, with their labels (fixed values).
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Scan:
    least_match: int = 3
    most_gap: int = 4
    least_cover: float = 0.8
    #: Of templates up to so many words, every number has to be matched: it tells versions apart.
    notice_words: int = 64


class SuffixAutomaton:
    """All runs of the given sequences; ends[s]: (sequence, place of the last item) of each occurrence."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for number, sequence in enumerate(sequences):
            last = 0
            for place, item in enumerate(sequence):
                last = self._added(last, item)
                self.ends[last].add((number, place))
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                self.ends[self.link[state]] |= self.ends[state]

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.ends.append(set())
        return len(self.next) - 1

    def _split(self, state: int, item: int) -> int:
        """The state of exactly the run of state and item, which a longer run's state may have to give up."""
        to = self.next[state][item]
        if self.length[to] == self.length[state] + 1:
            return to
        own = self._state(self.length[state] + 1, dict(self.next[to]), self.link[to])
        self.link[to] = own
        while state >= 0 and self.next[state].get(item) == to:
            self.next[state][item] = own
            state = self.link[state]
        return own

    def _added(self, last: int, item: int) -> int:
        if item in self.next[last]:
            return self._split(last, item)
        new = self._state(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and item not in self.next[state]:
            self.next[state][item] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, item)
        return new

    def matches(self, items: list[int]) -> list[tuple[int, int, int]]:
        """(last place, length, state) of every match that the next item does not lengthen."""
        found, state, length = [], 0, 0
        for place, item in enumerate(items):
            if item not in self.next[state] and length:
                found.append((place - 1, length, state))
            while state and item not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if item in self.next[state]:
                state, length = self.next[state][item], length + 1
        if length:
            found.append((len(items) - 1, length, state))
        return found

    def occurrences(self, items: list[int], least: int) -> Iterator[tuple[int, int, int, int]]:
        """(last place, length, sequence, place of the last item in it) of every match of at least so many
        items with a place of a sequence that can be lengthened on neither side."""
        state, length = 0, 0
        open_: dict[tuple[int, int], int] = {}
        for place, item in enumerate(items):
            while state and item not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if item in self.next[state]:
                state, length = self.next[state][item], length + 1
            now = {}
            if length >= least:
                top = state  # holds the last least items, and with them all their places
                while self.length[self.link[top]] >= least:
                    top = self.link[top]
                for sequence, end in self.ends[top]:
                    now[sequence, end] = open_.pop((sequence, end - 1), least - 1) + 1
            for (sequence, end), matched in open_.items():
                yield place - 1, matched, sequence, end
            open_ = now
        for (sequence, end), matched in open_.items():
            yield len(items) - 1, matched, sequence, end


@cache
def _scanner(templates: tuple[tuple[str, tuple[str, ...]], ...], phrases: tuple[tuple[str, str], ...], scan: Scan) -> Scanner:
    """Built once in each Python worker."""
    return Scanner(dict(templates), dict(phrases), scan)


class Scanner:
    def __init__(self, templates: Mapping[str, tuple[str, ...]], phrases: Mapping[str, str], scan: Scan):
        self.scan = scan
        texts = [(label, text.split()) for label, all_of in templates.items() for text in all_of]
        words = sorted({w for _, t in texts for w in t} | {w for p in phrases for w in p.split()})
        data = np.frombuffer(" ".join(words).encode(), np.uint8)
        starts, ends, _ = bounds(data, np.array([0, len(data)]), ALPHANUMERIC)
        keys = hashes(data, starts, ends)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], order + 1
        number = {w: k + 1 for k, w in enumerate(words)}
        self.labels = [label for label, _ in texts]
        self.sizes = [len(t) for _, t in texts]
        self.numbered = [
            [k for k, w in enumerate(t) if any(c.isdigit() for c in w)] if len(t) <= scan.notice_words else [] for _, t in texts
        ]
        sequences = [[number[w] for w in t] for _, t in texts]
        self.automaton = SuffixAutomaton(sequences)
        self.least = min(scan.least_match, *self.sizes)
        self.run = min(self.least, 3)
        self.runs = np.unique(np.concatenate([self.joined(np.array(t)) for t in sequences]))
        self.phrases = [([number[w] for w in p.split()], label) for p, label in phrases.items()]

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """The number of each template word, 0 for all others."""
        at = np.minimum(np.searchsorted(self.keys, words), len(self.keys) - 1)
        return np.where(self.keys[at] == words, self.ids[at], 0)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """One number for each run of self.run words."""
        n = max(0, len(ids) - self.run + 1)
        out = np.zeros(n, np.int64)
        for k in range(self.run):
            out = out * (len(self.keys) + 1) + ids[k : n + k]
        return out

    def stretches(self, ids: np.ndarray, firsts: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(row, first word, word after the last) of words in runs that some template has."""
        n = max(0, len(ids) - self.run + 1)
        whole = np.ones(n, bool)
        for k in range(self.run):
            whole &= ids[k : n + k] > 0
        at = np.flatnonzero(whole)
        joined = np.zeros(len(at), np.int64)
        for k in range(self.run):
            joined = joined * (len(self.keys) + 1) + ids[at + k]
        place = np.minimum(np.searchsorted(self.runs, joined), len(self.runs) - 1)
        at = at[self.runs[place] == joined]
        row = np.searchsorted(firsts, at, "right") - 1
        inside = at + self.run <= firsts[row + 1]
        at, row = at[inside], row[inside]
        new = np.flatnonzero(np.concatenate([[True], (at[1:] > at[:-1] + self.run) | (row[1:] != row[:-1])])) if len(at) else at
        lasts = np.append(new[1:], len(at)) - 1 if len(at) else at
        return zip(row[new].tolist(), at[new].tolist(), (at[lasts] + self.run).tolist())

    def chains(self, sequence: int, found: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int, float, int]]:
        """(label, first word, word after the last, share of the template, its covered words or 0 if a number is
        missing) of the chains of one template's matches (first word, place in the template, length); each match
        belongs to one chain, best chains first."""
        found = sorted(found, key=lambda m: (m[0] + m[2], m[0], m[1]))
        best: list[tuple[int, int, int]] = []  # covered words of the best chain to each match, what it adds, the match before
        for k, (start, inside, length) in enumerate(found):
            top = (length, length, -1)
            for j in range(k - 1, -1, -1):
                before, inside_before, length_before = found[j]
                gap = start - before - length_before
                if gap > self.scan.most_gap:
                    break
                # words that both matches have count once
                both = max(0, -gap, inside_before + length_before - inside)
                if before < start and inside_before < inside and both < length and gap + both <= self.scan.most_gap:
                    if best[j][0] + length - both > top[0]:
                        top = (best[j][0] + length - both, length - both, j)
            best.append(top)
        used = [False] * len(found)
        for k in sorted(range(len(found)), key=lambda k: (-best[k][0], k)):
            if used[k]:
                continue
            covered, j, first = 0, k, k
            missing = set(self.numbered[sequence])
            while j >= 0 and not used[j]:
                used[j], first = True, j
                missing.difference_update(range(found[j][1], found[j][1] + found[j][2]))
                covered += best[j][1] if best[j][2] >= 0 and not used[best[j][2]] else found[j][2]
                j = best[j][2]
            yield self.labels[sequence], found[first][0], found[k][0] + found[k][2], covered / self.sizes[sequence], 0 if missing else covered

    def strong(self, chains: list[tuple[str, int, int, float, int]]) -> list[tuple[str, int, int, float, int]]:
        """Chains that have their template nearly whole, without those that lie for more than half in a better one."""
        whole = [c for c in chains if c[4] and c[3] >= self.scan.least_cover]
        kept: list[tuple[str, int, int, float, int]] = []
        taken: dict[int, list[int]] = {}  # kept chains by the blocks of 64 words that they touch
        for c in sorted(whole, key=lambda c: (-c[4], -c[3], c[1], c[0])):
            blocks = range(c[1] // 64, (c[2] - 1) // 64 + 1)
            near = {k for b in blocks for k in taken.get(b, ())}
            if all(2 * (min(c[2], kept[k][2]) - max(c[1], kept[k][1])) <= c[2] - c[1] for k in near):
                for b in blocks:
                    taken.setdefault(b, []).append(len(kept))
                kept.append(c)
        return sorted(kept, key=lambda c: c[1])

    def rows(self, texts: pa.Array) -> Iterator[tuple]:
        """n_words, n_base, first_word, last_word, base_labels, labels, score, spans of each text."""
        for first, last, data, offsets in slices(texts):
            data = LOWER[data]
            starts, ends, firsts = bounds(data, offsets, ALPHANUMERIC)
            ids = self.numbers(hashes(data, starts, ends))
            base: dict[int, list[tuple[int, str]]] = {}
            for phrase, label in self.phrases:
                here = np.flatnonzero(ids[: max(0, len(ids) - len(phrase) + 1)] == phrase[0])
                for k, word in enumerate(phrase[1:], 1):
                    here = here[ids[here + k] == word]
                row = np.searchsorted(firsts, here, "right") - 1
                inside = here + len(phrase) <= firsts[row + 1]
                for r, place in zip(row[inside].tolist(), (here - firsts[row])[inside].tolist()):
                    base.setdefault(r, []).append((place, label))
            matches: dict[int, dict[int, list[tuple[int, int, int]]]] = {}
            for row, begin, stop in self.stretches(ids, firsts):
                at = begin - int(firsts[row])
                for place, length, sequence, end in self.automaton.occurrences(ids[begin:stop].tolist(), self.least):
                    if length >= min(self.scan.least_match, self.sizes[sequence]):
                        of_row = matches.setdefault(row, {})
                        of_row.setdefault(sequence, []).append((at + place - length + 1, end - length + 1, length))
            spans = {row: sorted((c for s, m in of_row.items() for c in self.chains(s, m)), key=lambda c: c[1]) for row, of_row in matches.items()}
            for k in range(last - first):
                places = [p for p, _ in base.get(k, [])]
                labels = {label for _, label in base.get(k, [])}
                own = spans.get(k, [])
                strong = self.strong(own)
                yield (
                    int(firsts[k + 1] - firsts[k]),
                    len(places),
                    min(places, default=None),
                    max(places, default=None),
                    ",".join(sorted(labels)),
                    ",".join(sorted(labels | {s[0] for s in strong})),
                    max([1.0 if places else 0.0, *(s[3] for s in own)]),
                    [dict(zip(("label", "first_word", "end_word", "cover"), s)) for s in strong],
                )


_SPANS = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("cover", pa.float64())]))
_SCHEMA = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "n_words", "n_base", "first_word", "last_word")]
    + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", _SPANS)]
)


def license_scan(
    docs: DataFrame,
    templates: Mapping[str, tuple[str, ...]] | None = None,
    phrases: Mapping[str, str] = PHRASES,
    scan: Scan = Scan(),
) -> DataFrame:
    """For each row of docs, templates being those of licences unless given: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    spans: label, first word, word after the last and covered share of each template that the text has
    whole or nearly so; score: the largest share of any template, 1 where a phrase stands. Null and empty
    texts have no words, no labels and score 0. Every row is read by itself; its chains reach across stretches.
    """
    templates = licences.templates() if templates is None else templates
    given = tuple((label, tuple(texts)) for label, texts in templates.items()), tuple(phrases.items()), scan

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(*given)
        for batch in batches:
            rows = [(d, *r) for d, r in zip(batch.column(0).to_pylist(), scanner.rows(batch.column(1)))]
            columns = list(zip(*rows)) if rows else [()] * len(_SCHEMA)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)

    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, spans array<struct<label: string, first_word: long, end_word: long, cover: double>>"
    )
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
