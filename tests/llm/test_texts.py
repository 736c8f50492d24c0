"""Join, passages, subwords, licences and scores against plain versions and public libraries."""

import base64
import hashlib
import math
import pathlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from phasediff.llm import byte_bpe, language_id, licences, license_scan, lm_score, ngram_join, quality_classifier, suffix_dedup
from phasediff.llm.queries import bpe_digests, registered
from phasediff.llm.store import freeing, shipped, written
from tests.conftest import DATA
from tests.llm import brute


@pytest.fixture(scope="module")
def odd(spark):
    return shipped(spark).createDataFrame(brute.ODD, brute.DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return shipped(spark).read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def none(spark):
    return shipped(spark).createDataFrame([], brute.DOCS)


def similar_texts(seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(12)]
    bases = [[rng.choice(words) for _ in range(rng.choice([2, 3, 12, 40, 90]))] for _ in range(10)]
    rows = []
    for k in range(250):
        text = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            text[rng.randrange(len(text))] = rng.choice([*words, f"u{k}"])
        rows.append((k, " ".join(text)))
    return rows


@pytest.mark.parametrize("size, percent", [(3, 90), (1, 80)])
def test_join_of_similar_texts(spark, monkeypatch, size, percent):
    """Few words in many texts: most shingles are frequent, so most signatures are combinations."""
    monkeypatch.setattr(ngram_join, "FREQUENT_LEAST", 3)
    rows = similar_texts(size)
    df = shipped(spark).createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = ngram_join.ngram_join(df, ngram_join.Join(size, percent)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute.components(rows, size, percent)


@pytest.mark.parametrize("seed, sizes, direct", [(5, [4, 12], 3), (3, [16, 24, 30], 12)])
def test_join_of_crowds_around_a_text(spark, monkeypatch, seed, sizes, direct):
    """Texts that link with the hub of a signature alone, or whose two signatures in common are of different kinds."""
    monkeypatch.setattr(ngram_join, "DIRECT", direct)
    rng, rows = random.Random(seed), []
    for g in range(40):
        n = rng.choice([20, 40, 60, 100])
        base, spread = [f"g{g}w{k}" for k in range(n)], rng.choice([0.08, 0.12, 0.2])
        for _ in range(rng.choice(sizes)):
            text = list(base)
            for k in rng.sample(range(n), min(n, int(rng.random() * spread * 2 * n))):
                text[k] = rng.choice([f"u{len(rows)}x{k}", f"g{g}alt{k}a", f"g{g}alt{k}b"])
            rows.append((len(rows), " ".join(text)))
    df = shipped(spark).createDataFrame(rows, "doc_id long, text string").coalesce(2)
    found = ngram_join.ngram_join(df, ngram_join.Join(1, 80)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute.components(rows, 1, 80)


def test_join_of_odd_rows(odd):
    found = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_join(odd).collect()]
    assert brute.by_text(found) == brute.by_text(brute.components([r[:2] for r in brute.ODD], 3, 90))


def test_join_of_documents(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = [tuple(r) for r in registered()["op7_ngram_join"](spark, DATA).collect()]
    assert sorted(found) == sorted(brute.components(rows, 3, 90))


def test_parity_maps_rule_no_link_out():
    """The difference of two maps is a lower bound of the difference of the sets, whatever their sizes."""
    rng = np.random.default_rng(3)
    for n in (1, 5, 60, 700, 4000):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.93], rng.integers(0, 2**63, n // 15 + 1, dtype=np.uint64)]))
        differ = sum(int(x ^ y).bit_count() for x, y in zip(*(ngram_join.parity_map(s).view(np.uint64) for s in (a, b))))
        assert differ <= len(np.setxor1d(a, b))


def test_copies_of_a_set_count_once_at_a_signature(spark):
    """Tasks that each hold a copy of a set send its signatures again; a signature of one set alone goes."""
    rows = [(7, 1, 50, 3), (7, 1, 50, 3), (7, 2, 52, 4), (8, 1, 50, 5), (8, 1, 50, 5), (9, 2, 52, 6), (9, 3, 51, 0)]
    sigs = spark.createDataFrame(rows, "sig long, set long, n int, place int").repartition(3)
    kept = sorted(tuple(r) for r in ngram_join.repeated(sigs).select("sig", "set", "n", "place").collect())
    assert kept == [(7, 1, 50, 3), (7, 2, 52, 4), (9, 2, 52, 6), (9, 3, 51, 0)]


def test_maps_tell_long_sets_apart(spark):
    """Also where one of the two sets has a map of twice the size; a linked pair is never ruled out."""
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(0, 2**63, 8300, dtype=np.uint64))
    far = np.concatenate([base[:4000], np.unique(rng.integers(0, 2**63, 4300, dtype=np.uint64))])
    sets = {1: base, 2: far, 3: base[:8000], 4: far[:8000]}
    rows = [(k, len(v), ngram_join.parity_map(v).tolist()) for k, v in sets.items()]
    maps = spark.createDataFrame(rows, "set long, n long, map array<long>")
    pairs = spark.createDataFrame([(a, b) for a in sets for b in sets if a < b], "a long, b long")
    kept = sorted(tuple(r) for r in ngram_join.alike(pairs, maps, 90).collect())
    assert kept == [(1, 3), (2, 4)]


def test_rows_behind_a_shuffle_keep_their_results(spark, docs):
    """The same rows, once from a file and once from a frame that a round-robin shuffle orders anew for each scan."""
    moved = docs.repartition(7)

    def plain(df):
        return sorted(map(str, df.collect()))

    found = [plain(ngram_join.ngram_join(df).select("doc_id", "n_shingles", "component_id")) for df in (docs, moved)]
    assert found[0] == found[1]
    assert removed(docs) and sorted(removed(docs)) == sorted(removed(moved))
    counted = [plain(lm_score.lm_scores(df).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6))) for df in (docs, moved)]
    assert counted[0] == counted[1]


def test_suffix_array():
    rng = random.Random(2)
    for size in [0, 1, 2, 3, 4, 5, *(rng.randrange(6, 70) for _ in range(150))]:
        values = [rng.randrange(1, rng.choice([2, 3, 300, 1 << 22])) for _ in range(size)]
        expected = sorted(range(size), key=lambda k: values[k:])
        assert suffix_dedup.suffix_array(np.array(values, np.int64)).tolist() == expected


def removed(df):
    return [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in suffix_dedup.suffix_dedup(df).collect()]


def test_passages_of_odd_rows(odd):
    assert brute.by_text(removed(odd)) == brute.by_text(brute.passages([r[:2] for r in brute.ODD]))


@pytest.mark.parametrize("most", [suffix_dedup.FILTER_BYTES, 64])
def test_passages_with_shared_parts(spark, monkeypatch, most):
    """Also with a filter so small that it lets every anchor through."""
    monkeypatch.setattr(suffix_dedup, "FILTER_BYTES", most)
    rng = random.Random(4)
    parts = ["".join(rng.choice("abc é") for _ in range(rng.choice([60, 100, 130, 300]))) for _ in range(12)]
    rows = []
    for k in range(120):
        pieces = [rng.choice(parts)[rng.randrange(20) :] if rng.random() < 0.7 else str(rng.random()) for _ in range(rng.randrange(1, 6))]
        rows.append((k, "a" * rng.randrange(90, 400) if k % 9 == 0 else "".join(pieces)))
    df = shipped(spark).createDataFrame(rng.sample(rows, len(rows)), "doc_id long, text string").repartition(3)
    assert sorted(removed(df)) == sorted(brute.passages(rows))


def test_bpe_equals_the_library(odd, docs):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def expected(text):
        ids = np.array(library.encode_ordinary(text or ""), np.uint32)
        return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    for df in (odd, docs):
        rows = [(r.doc_id, *expected(r.text)) for r in df.collect()]
        assert brute.by_text(tuple(r) for r in bpe_digests(df).collect()) == brute.by_text(rows)


def test_counts_leave_a_task_in_pieces():
    """A task's counts were one batch of each size; they are the same in several."""
    words = [f"w{k % 700}" for k in range(3000)]
    batch = pa.RecordBatch.from_arrays([pa.array([" ".join(words)] * 2)], ["text"])
    out = list(lm_score._counted(iter([batch]), 8))
    rows = [r for b in out for r in b.to_pylist()]
    assert len(out) > 20 and len({(r["part"], r["size"]) for r in rows}) == len(rows)
    tokens = np.concatenate([w for _, _, w, _ in lm_score.tokens(batch.column(0))])
    expected = Counter(tokens.tolist()) + Counter({int(lm_score.START): 2})
    found = {}
    for r in rows:
        if r["size"] == 1:
            found |= dict(zip(np.frombuffer(r["keys"], np.uint64).tolist(), np.frombuffer(r["counts"], np.uint8).tolist()))
    assert found == dict(expected)


@pytest.mark.parametrize("bits", [2, 8])
def test_anchors_leave_a_task_in_pieces(bits):
    rng = np.random.default_rng(3)
    text = bytes(rng.integers(97, 123, 30_000, dtype=np.uint8)).decode()
    out = list(suffix_dedup._counted(iter([pa.RecordBatch.from_arrays([pa.array([text, text[:9000], "x"])], ["text"])]), bits))
    data = np.frombuffer((text + text[:9000] + "x").encode(), np.uint8)
    hashes = np.concatenate([h for _, _, h in suffix_dedup.anchored(data, np.array([0, 30_000, 39_000, 39_001]))])
    found = {}
    for row in (r for b in out for r in b.to_pylist()):
        keys = np.frombuffer(row["keys"], np.uint64)
        assert (lm_score.parts_of(keys, bits) == row["part"]).all()
        found |= dict(zip(keys.tolist(), (np.unpackbits(np.frombuffer(row["twice"], np.uint8), count=len(keys)) > 0).tolist()))
    assert len(out) > 8 and found == {k: n > 1 for k, n in Counter(hashes.tolist()).items()}
    # most anchors were in the first parts, as their hashes are the smallest of their windows
    shares = np.bincount(lm_score.parts_of(hashes, 2) // 16, minlength=4) / len(hashes)
    assert shares.max() < 0.35


def test_bpe_has_one_worker_a_task(odd):
    """Of two in a row, each worker came to hold an encoder; one gives the same rows."""
    plan = bpe_digests(odd)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    apart = byte_bpe.decode(byte_bpe.encode(odd, ranks, public_tokenizers.PATTERN), ranks)
    both = byte_bpe.round_trip(odd, ranks, public_tokenizers.PATTERN)
    assert brute.by_text(tuple(r) for r in both.collect()) == brute.by_text(tuple(r) for r in apart.collect())


def test_tasks_get_small_batches_and_give_memory_back(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    texts = shipped(spark).range(0, 4000, 1, 1).selectExpr("repeat(cast(id % 10 as string), 3000) as text")
    assert max(r.n for r in texts.mapInArrow(freeing(sizes), "n long").collect()) < 5 << 20


@pytest.mark.parametrize("limit", [10, 60_000])
def test_bpe_of_random_texts(monkeypatch, limit):
    monkeypatch.setattr(byte_bpe, "STATES", limit)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoder = byte_bpe.Encoder(byte_bpe.read_ranks(path), public_tokenizers.PATTERN)
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    pool = [" ", "  ", "\n", " \n", "\t", "\x1c", "\x85", "é", "日本", "🙂", "a", "the", "ing", "'s", " 's", "1", "!!", "aaaa", "<|endoftext|>", "\r\n"]
    for _ in range(1500):
        text = "".join(rng.choice(pool) if rng.random() < 0.7 else chr(rng.randrange(32, 127)) for _ in range(rng.randrange(25)))
        assert np.frombuffer(encoder.encode(text), np.uint32).tolist() == library.encode_ordinary(text)


def test_decoding_in_pieces():
    text = "aé日🙂" * 3
    for size in (1, 2, 3, 5):
        stream, data = byte_bpe.Utf8Stream(), text.encode()
        out = [stream.feed(data[k : k + size]) for k in range(0, len(data), size)]
        assert "".join(out) + stream.end() == text
    assert byte_bpe.Utf8Stream().feed(b"a\xff\xf0b") == "a��b"


def test_licences_of_odd_rows(odd):
    rows = {r.doc_id: r for r in license_scan.license_scan(odd).collect()}
    row = rows[11]
    assert (row.n_words, row.n_base, row.first_word, row.last_word) == (13, 3, 0, 10)
    assert row.base_labels == "cc-by,reserved" and row.labels == "cc-by,cc-by-nc,reserved" and row.score == 1.0
    assert (rows[1].n_words, rows[1].n_base, rows[1].first_word, rows[1].labels, rows[1].score) == (0, 0, None, "", 0.0)


def scanned(*texts):
    scanner = license_scan.Scanner(licences.templates(), license_scan.PHRASES, license_scan.Scan())
    return [(r[5], r[6], r[7]) for r in scanner.rows(pa.array(texts))]


MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in the Software without restriction"
)


def test_chains_reach_across_foreign_words():
    words = MIT.split()
    lines = "\n".join("REM " + " ".join(words[k : k + 6]) for k in range(0, len(words), 6))
    far = " ".join(words[:14] + ["xyzzy"] * 5 + words[14:])
    found = scanned("Licensed under the new Apache License, Version 2.0", " ".join(words[:14] + ["xyzzy"] + words[14:]), lines, far)
    assert [labels for labels, *_ in found] == ["apache-2.0", "mit", "mit", ""]
    assert [score for _, score, _ in found[:3]] == [1.0, 1.0, 1.0] and found[3][1] < 0.8
    (span,) = found[0][2]
    assert (span["first_word"], span["end_word"]) == (0, 9)


def test_a_row_ends_every_chain():
    assert [r[0] for r in scanned("Licensed under the", "Apache License, Version 2.0")] == ["", ""]
    twice = "Released under the MIT License. " * 2
    assert [(s["first_word"], s["end_word"]) for s in scanned(twice)[0][2]] == [(0, 5), (5, 10)]


GPL_NOTICE = (
    "This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published "
    "by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
)


def own_labels(*texts):
    return [",".join(sorted({s["label"] for s in spans})) for _, _, spans in scanned(*texts)]


def test_usual_notices_have_labels_with_versions():
    notices = {
        GPL_NOTICE.format(what="program", name="General Public License", version="3"): "gpl-3.0",
        GPL_NOTICE.format(what="program", name="General Public License", version="2"): "gpl-2.0",
        GPL_NOTICE.format(what="program", name="General Public License", version="4"): "",
        GPL_NOTICE.format(what="library", name="Lesser General Public License", version="2.1"): "lgpl-2.1",
        GPL_NOTICE.format(what="program", name="Affero General Public License", version="3"): "agpl-3.0",
        "Licensed under the GNU General Public License version 3": "gpl-3.0",
        "Licensed under the GNU General Public License, version 2.0": "gpl-2.0",
        "Licensed under the GNU General Public License": "",
        "under the terms of the GPLv3": "gpl-3.0",
        "Distributed under the MIT License.": "mit",
        "Available under the ISC License.": "isc",
        "Licensed under CC BY-SA 4.0": "cc-by-sa-4.0",
        "a Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc",
        "a Creative Commons Attribution-ShareAlike 3.0 Unported License": "cc-by-sa-3.0",
        "SPDX-License-Identifier: LGPL-2.1-or-later": "lgpl-2.1",
        "SPDX-License-Identifier: MIT": "mit",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.": "mpl-2.0",
        "Under the MIT License. Other parts: licensed under the Apache License, Version 2.0": "apache-2.0,mit",
        "we sat under the old tree of the public park": "",
    }
    assert dict(zip(notices, own_labels(*notices))) == notices


def test_full_texts_have_their_own_labels():
    texts = {f.stem: f.read_text() for f in pathlib.Path(licences.__file__).parent.glob("*.txt")}
    assert len(texts) >= 18 and {"gpl-2.0", "gpl-3.0", "lgpl-2.1", "agpl-3.0", "apache-2.0", "mpl-2.0", "isc", "cc0-1.0"} <= set(texts)
    edited = {k: " ".join("# " + w if n % 9 else "dnl " + w for n, w in enumerate(t.split())) for k, t in texts.items()}
    assert dict(zip(texts, own_labels(*texts.values()))) == {k: k for k in texts}
    assert dict(zip(edited, own_labels(*edited.values()))) == {k: k for k in edited}


def test_automaton_finds_every_occurrence():
    rng = random.Random(9)
    sequences = [[rng.randrange(1, 4) for _ in range(rng.randrange(3, 12))] for _ in range(5)]
    automaton = license_scan.SuffixAutomaton(sequences)
    for _ in range(100):
        items = [rng.randrange(1, 5) for _ in range(20)]
        expected = set()
        for s, t in enumerate(sequences):
            for a in range(20):
                for b in range(len(t)):
                    n = 0
                    while a + n < 20 and b + n < len(t) and items[a + n] == t[b + n]:
                        n += 1
                    if n >= 2 and (a == 0 or b == 0 or items[a - 1] != t[b - 1]):
                        expected.add((a + n - 1, n, s, b + n - 1))
        found = list(automaton.occurrences(items, 2))
        assert len(found) == len(set(found)) and set(found) == expected


def test_automaton_finds_longest_matches():
    rng = random.Random(8)
    sequences = [[rng.randrange(1, 4) for _ in range(rng.randrange(3, 12))] for _ in range(5)]
    runs = {tuple(s[a:b]): 1 for s in sequences for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
    automaton = license_scan.SuffixAutomaton(sequences)
    for _ in range(200):
        items = [rng.randrange(1, 5) for _ in range(20)]
        longest = [max([n for n in range(k + 2) if tuple(items[k + 1 - n : k + 1]) in runs], default=0) for k in range(20)]
        ends = [(k, n) for k, n in enumerate(longest) if n and (k == 19 or longest[k + 1] <= n)]
        found = automaton.matches(items)
        assert [(k, n) for k, n, _ in found] == [e for e in ends if e in {(k, n) for k, n, _ in found}]
        for place, length, state in found:
            run = items[place - length + 1 : place + 1]
            assert {(s, e) for s, t in enumerate(sequences) for e in range(len(t)) if t[max(0, e - length + 1) : e + 1] == run} == automaton.ends[state]


@pytest.mark.parametrize("frequent, segment", [(lm_score.FREQUENT, lm_score.SEGMENT_BYTES), (50, 60_000)])
def test_language_model(spark, docs, monkeypatch, frequent, segment):
    """Also with a small table of frequent words and a filter in several segments."""
    monkeypatch.setattr(lm_score, "FREQUENT", frequent)
    monkeypatch.setattr(lm_score, "SEGMENT_BYTES", segment)
    texts = {r.doc_id: ["w" + w for w in brute.words(brute.lower(r.text))] + ["end"] for r in docs.collect()}
    counts = Counter(t for d, all_of in texts.items() if zlib.crc32(str(d).encode()) % 7 != 2 for t in all_of)
    total, kinds = sum(counts.values()), len(counts)
    rows = registered()["op2_lm_scoring"](spark, DATA).collect()
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[r.doc_id]
        assert r.base_score == pytest.approx(sum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in t))
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(counts[x] > 0 for x in t), total)
    held = [r for r in rows if r.held_out]
    assert sum(r.base_score for r in held) < sum(r.score for r in held) < 0


def test_filter_never_underestimates():
    keys = lm_score.mixed(np.arange(5000, dtype=np.uint64))
    counts = np.arange(1, 5001)
    table = lm_score.Filter([(int(p), b"") for p in ()], 2)
    parts = lm_score.parts_of(keys, 2)
    table = lm_score.Filter([(int(p), lm_score.built(keys[parts == p], counts[parts == p]).tobytes()) for p in np.unique(parts)], 2)
    levels, true = table.levels(keys), np.floor(np.log2(counts)) + 1
    assert (levels >= true).all() and (levels == true).mean() > 0.85
    assert (table.levels(lm_score.mixed(np.arange(9000, 14000, dtype=np.uint64))) == 0).mean() > 0.85


def test_steps_of_the_driver_hold_every_context_once(monkeypatch):
    monkeypatch.setattr(lm_score, "STEP_BYTES", 10)
    found = list(lm_score._steps(range(2, 9), {2: 4, 3: 7, 5: 30, 8: 1}))
    assert found == [range(2, 4), range(4, 6), range(6, 9)]
    assert list(lm_score._steps(range(0, 2), {1: 10})) == [range(0, 2)]


def test_filter_has_few_false_hits():
    keys = lm_score.mixed(np.arange(40_000, dtype=np.uint64))
    parts = lm_score.parts_of(keys, 2)
    ones = np.ones(len(keys), int)
    table = lm_score.Filter([(int(p), lm_score.built(keys[parts == p], ones[parts == p]).tobytes()) for p in np.unique(parts)], 2)
    assert (table.levels(lm_score.mixed(np.arange(90_000, 190_000, dtype=np.uint64))) > 0).mean() < 0.005


def test_false_hits_are_bounded_by_the_counts_of_words():
    """A filter that has every n-gram at a high level."""

    class Full:
        bits = 2

        def levels(self, keys):
            return np.full(len(keys), 9)

    (texts,) = [pa.array(["seen new seen", "new new"])]
    words = np.concatenate([w for _, _, w, _ in lm_score.tokens(pa.array(["seen"]))])
    order = np.argsort(words)
    counts = np.array([5, 2])[order]
    batch = pa.RecordBatch.from_arrays([pa.array([0, 1]), texts], ["row", "text"])
    (out,) = lm_score._scored([batch], Full(), range(4), words[order], counts, 7, 2)
    start = 1.5 * 2**8 - 0.5

    def one(c1, c, most):
        share = 0.8 * c1 / (c1 + 4)
        return math.log10(share * min(most, c1, c) / max(c1, 1) + (1 - share) * (c + 1) / 10)

    first = one(start, 5, 999) + math.log10(1 - 0.8 * 5 / 9) + one(0, 5, 999) + one(5, 2, 999)
    second = math.log10(1 - 0.8 * start / (start + 4)) + one(0, 2, 999)
    assert out.column("score").to_pylist() == pytest.approx([first, second])
    assert not any(any(c2) for c2 in out.column("c2").to_pylist())


@pytest.mark.parametrize("frequent", [1_000_000, 2])
def test_language_model_by_hand(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm_score, "FREQUENT", frequent)
    rows = [(k, text) for k, text in enumerate(["a b a b c", "a b a a d", "x a c b", "b a unknown a", "c c d x", "a a a b", ""] * 3)]
    texts = {d: [*t.split(), "END"] for d, t in rows}
    train = [t for d, t in texts.items() if zlib.crc32(str(d).encode()) % 7 != 2]
    single = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip(["START", *t], t))
    total, kinds = sum(single.values()), len(single)
    limit = next(2**k for k in range(48) if sum(c >= 2**k for c in single.values()) <= frequent)

    def level(c):
        return 1.0 if c == 1 else 1.5 * 2 ** (c.bit_length() - 1) - 0.5 if c else 0.0

    def score(h, w):
        c1 = level(len(train) if h == "START" else single[h])
        if h != "START" and single[h] >= limit:
            c1 = min(c1, single[h])
        c2 = min(level(pairs[h, w]), c1, single[w])
        share = 0.8 * c1 / (c1 + 4)
        return math.log10(share * c2 / max(c1, 1) + (1 - share) * (single[w] + 1) / (total + kinds + 1))

    found = lm_score.lm_scores(shipped(spark).createDataFrame(rows, "doc_id long, text string")).collect()
    for r in found:
        t = texts[r.doc_id]
        assert r.score == pytest.approx(sum(score(h, w) for h, w in zip(["START", *t], t)))


def test_scores_depend_on_no_table_and_no_task(spark, docs, monkeypatch):
    """The same scores from a table of all words and from one of few, from one task and from many."""

    def scores(df):
        return {r.doc_id: r.score for r in lm_score.lm_scores(df).collect()}

    shipped(spark)
    stored = [written(docs.select("doc_id", "text").repartition(n, "doc_id"), "documents") for n in (1, 5)]
    whole = scores(stored[0])
    for df, table in ((stored[1], lm_score.TABLE), (stored[0], 50), (stored[1], 3)):
        monkeypatch.setattr(lm_score, "TABLE", table)
        assert scores(df) == pytest.approx(whole, rel=1e-9)


def test_quality_on_held_out_rows(spark, docs):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = {r.doc_id: r for r in registered()["op5_quality_classifier"](spark, DATA).collect()}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows.values())
    held = [(rows[r.doc_id].predicted, r.quality) for r in labels.collect() if rows[r.doc_id].held_out]
    assert sum(p == q for p, q in held) >= 0.9 * len(held)


def test_trees_split_what_can_be_split():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = quality_classifier.fitted(x, y, quality_classifier.Boosting())
    assert ((trees.score(x) > 0.5) == y).mean() > 0.97


def test_gradients_of_the_network():
    network = language_id.Network(["a", "b", "c"], 3, 1)
    for name in ("table", "u", "out", "bias"):
        setattr(network, name, getattr(network, name).astype(np.float64))
    x = np.random.default_rng(0).integers(0, 4, (6, 5))
    x[4:, 1] = language_id.PAD
    label = np.array([0, 1, 2, 1, 0])

    def loss():
        p, inside = network.probabilities(x), x != language_id.PAD
        return -(np.log(p[:, np.arange(5), label]) * inside).sum() / inside.sum()

    for weights, slope in zip((network.table, network.u, network.out, network.bias), network.gradients(x, label)):
        for at in zip(*[k[:5] for k in np.nonzero(slope)]):
            old = weights[at]
            weights[at] = old + 1e-4
            above = loss()
            weights[at] = old - 1e-4
            below = loss()
            weights[at] = old
            assert slope[at] == pytest.approx((above - below) / 2e-4, rel=2e-2, abs=3e-6)


def test_language_on_held_out_rows(spark, docs):
    rows = {r.doc_id: r for r in registered()["op10_language_id"](spark, DATA).collect()}
    held = [(rows[r.doc_id].lang_pred, r.lang) for r in docs.collect() if rows[r.doc_id].held_out]
    assert sum(p == q for p, q in held) >= 0.9 * len(held)


def test_rare_languages_have_a_training_row(spark, monkeypatch):
    seen = []

    def keep(texts, labels, how):
        seen.append(Counter(labels))
        return language_id.Network(sorted(set(labels)), how.hidden, how.seed)

    monkeypatch.setattr(language_id, "trained", keep)
    rows = [(k, f"text {k}", "en") for k in range(600)] + [(1000 + k, f"teksti {k}", "fi") for k in range(4)]
    rows += [(2000, "repeated", "sv")] * 100 + [(3000 + k, "x", f"l{k}") for k in range(8)]
    docs = shipped(spark).createDataFrame(rows, "doc_id long, text string, lang string")
    learned = {r.lang for r in docs.filter(~language_id.held_out(F.col("doc_id"))).select("lang").distinct().collect()}
    for most in (40, 3):
        language_id.language(docs, language_id.Training(train_rows=most, steps=0))
        assert set(seen[-1]) == learned and sum(seen[-1].values()) <= max(most, len(learned))


def test_scores_of_odd_and_empty_tables(spark, odd, none):
    how = language_id.Training(steps=3)
    found = [(r.lang_pred, r.score) for r in language_id.language(odd, how).collect()]
    assert len(found) == len(brute.ODD) and found.count(("und", 0.0)) == 5
    labels = spark.createDataFrame([(4, 1), (6, None), (None, 0), (9, 0)], "doc_id long, quality int")
    assert quality_classifier.quality_scores(odd, labels).count() == len(brute.ODD)
    assert {r.score for r in quality_classifier.quality_scores(odd, labels.limit(0)).collect()} == {0.5}
    assert lm_score.lm_scores(odd).count() == len(brute.ODD)
    for made in (
        ngram_join.ngram_join(none), suffix_dedup.suffix_dedup(none), bpe_digests(none), license_scan.license_scan(none),
        lm_score.lm_scores(none), quality_classifier.quality_scores(none, labels), language_id.language(none, how),
    ):
        assert made.count() == 0


def test_words_match_the_pattern():
    from phasediff.llm.text import LOWER, NOT_SPACE, bounds, slices

    texts = [t for _, t, *_ in brute.ODD]
    found = []
    for _, _, data, offsets in slices(pa.array(texts)):
        starts, ends, firsts = bounds(LOWER[data], offsets, NOT_SPACE)
        whole = LOWER[data].tobytes()
        found += [[whole[s:e].decode() for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(firsts[:-1], firsts[1:])]
    assert found == [brute.words(brute.lower(t)) for t in texts]
