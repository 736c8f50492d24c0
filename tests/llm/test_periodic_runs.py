"""Periodic runs of words against a comparison of all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from phasediff.llm import periodic_runs
from phasediff.llm.queries import registered
from phasediff.llm.store import shipped
from tests.conftest import DATA
from tests.llm import brute


def plain_runs(words, least=12):
    """{(start, length): period} by trying every period."""
    ids = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True)[1] if len(words) else np.zeros(0, int)
    found = {}
    for q in range(1, len(ids) // 2 + 1):
        same = np.concatenate([[0], (ids[q:] == ids[:-q]).astype(np.int8), [0]])
        edges = np.flatnonzero(np.diff(same))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a >= q and b - a + q >= least:
                found.setdefault((a, b - a + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_row(doc, text, changed=True):
    words = brute.words(text)
    n = len(words)
    h = zlib.crc32(str(doc).encode())
    if changed and doc is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (
        doc,
        len(found),
        *best,
        None if best[0] is None else 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest(),
    )


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def sequences():
    rng = random.Random(11)
    yield from ("", "a", "ab" * 30, "a" * 100, fibonacci(400), "".join("ab"[bin(k).count("1") % 2] for k in range(256)))
    for k in range(1, 9):
        yield ("ab" * k + "a") * 2 + "b" + ("ab" * k + "a") * 3
        yield "b" + ("a" * k + "b") * 5 + "a" * (k + 2) + "b" + ("a" * k + "b") * 2
    for _ in range(400):
        letters = "ab" if rng.random() < 0.6 else "abc"
        parts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) for _ in range(3)]
        yield "".join(rng.choice(parts) * rng.randrange(1, 5) for _ in range(rng.randrange(1, 12)))


@pytest.mark.parametrize("least", [2, 12])
def test_runs_of_sequences(least):
    for text in sequences():
        found = periodic_runs.runs(np.array([ord(c) for c in text], np.int64), least)
        assert sorted(map(tuple, found.tolist())) == plain_runs(list(text), least), text


def test_odd_rows(spark):
    rows = [*brute.ODD, (20, "a b c " * 9, "x", "y", 0), (21, "x y\tz \n" * 3 + "q q q q q q q q q q q q q", "x", "y", 0)]
    df = shipped(spark).createDataFrame(rows, brute.DOCS).selectExpr("*", "1 AS runs", "'x' AS collapsed").repartition(3)
    found = periodic_runs.periodic_runs(df).collect()
    expected = [(r[0], len(brute.words(r[1])), plain_runs(brute.words(r[1]))) for r in rows]
    assert brute.by_text((r.doc_id, r.n_words, [tuple(x) for x in r.runs]) for r in found) == brute.by_text(expected)
    texts = {r.doc_id: r.collapsed for r in found}
    assert (texts[20], texts[21], texts[2], texts[3]) == ("a b c", "x y z x y z x y z q", "", "")
    assert periodic_runs.periodic_runs(df.limit(0)).count() == 0


def test_slices_do_not_matter(spark, monkeypatch):
    docs = [(k, brute.COMMON + " a b" * k) for k in range(40)]
    df = shipped(spark).createDataFrame(docs, "doc_id long, text string")
    whole = sorted(periodic_runs.periodic_runs(df).collect())
    assert [(r.doc_id, [tuple(x) for x in r.runs]) for r in whole] == [(d, plain_runs(brute.words(t))) for d, t in docs]


def test_query(spark):
    df = registered()["op11_periodic_runs"](shipped(spark), DATA)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    found = [tuple(r[n] for n in names) for r in df.collect()]
    assert sorted(found) == sorted(plain_row(r.doc_id, r.text) for r in docs)
    assert sum(r[1] > 0 for r in found) > len(found) // 20


def test_query_takes_odd_rows(spark, tmp_path):
    path = f"{tmp_path}/documents.parquet"
    shipped(spark).createDataFrame([*brute.ODD, *((k, brute.COMMON, None, None, None) for k in range(100, 160))], brute.DOCS).write.parquet(path)
    rows = [tuple(r)[:8] for r in registered()["op11_periodic_runs"](spark, str(tmp_path)).collect()]
    expected = [plain_row(r[0], r[1]) for r in brute.ODD] + [plain_row(k, brute.COMMON) for k in range(100, 160)]
    assert brute.by_text(rows) == brute.by_text(expected)
