"""Alignment of two tokenizers and pair counts against a plain count."""

import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from phasediff.llm import token_alignment
from phasediff.llm.queries import registered
from phasediff.llm.store import shipped
from tests.conftest import DATA
from tests.llm import brute

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def plain(rows):
    """[(the columns of NAMES, groups)] of (id, text) rows, token by token."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = {}
    spare = 256
    for k in range(256):
        if chr(k).isprintable() and k not in (0x20, 0xA0, 0xAD):
            letters[chr(k)] = k
        else:
            letters[chr(spare)] = k
            spare += 1

    def a_bytes(k):
        return bytes(letters[c] for c in a.id_to_token(k))

    def b_bytes(k):
        p = b.id_to_piece(k)
        return bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode()

    done = []
    for _, text in rows:
        whole = (" " + (text or "")).encode()
        x = a.encode(whole.decode(), add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        if b"".join(map(a_bytes, x)) != whole or b"".join(map(b_bytes, y)) != whole:
            x, y = [], []
        spans = []
        for ids, size in ((x, a_bytes), (y, b_bytes)):
            ends = np.cumsum([len(size(k)) for k in ids]).astype(int).tolist()
            spans.append(list(zip([0, *ends[:-1]], ends, ids)))
        links, j = [], 0
        for s, e, k in spans[0]:
            while j < len(spans[1]) and spans[1][j][1] <= s:
                j += 1
            links += [(k, q) for u, v, q in spans[1][j : j + e - s] if u < e and v > s]
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        sides = [[[] for _ in cuts] for _ in spans]
        for side, tokens in zip(sides, spans):
            for s, _, k in tokens:
                side[bisect.bisect_right(cuts, s)].append(str(k))
        groups = [f"{','.join(x)}|{','.join(y)}" for x, y in zip(*sides)]
        done.append((len(x), len(y), links, groups))
    counts = Counter(p for _, _, links, _ in done for p in links)
    top = {}
    for (_, q), n in counts.items():
        top[q] = max(top.get(q, 0), n)
    return [
        (doc, n_a, n_b, len(g), len(links), sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links), ";".join(g))
        for (doc, _), (n_a, n_b, links, g) in zip(rows, done)
    ]


def found(df):
    return [(*(r[n] for n in NAMES), r.groups) for r in df.collect()]


def test_perfect_hash():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 7, 1000, 50_000):
        keys = np.unique(rng.integers(0, 2**40, n, dtype=np.uint64))
        own = token_alignment.PerfectHash.load(token_alignment.PerfectHash.of(keys).dump())
        assert sorted(own.slots(keys).tolist()) == list(range(len(keys)))


def test_perfect_hash_with_a_rest(monkeypatch):
    """Keys that no level places come from the list."""
    monkeypatch.setattr(token_alignment, "_LEVELS", 1)
    keys = np.arange(500, dtype=np.uint64) ** np.uint64(2)
    own = token_alignment.PerfectHash.load(token_alignment.PerfectHash.of(keys).dump())
    assert len(own.rest) and sorted(own.slots(keys).tolist()) == list(range(500))
    assert own.slots(np.array([3], np.uint64)).tolist() in ([-1], *[[k] for k in range(500)])


def test_faster_way_gives_the_same_ids():
    own, library = token_alignment.ByteLevel(A), Tokenizer.from_file(A)
    library.encode_special_tokens = True
    assert own.fast is not None
    rng = random.Random(8)
    pool = ["the", "Thess", "é", "日本", "🙂", "12", "'s", "x\n", "\t", " ", "  ", "\u00a0", "\u3000", "\u0301e", "<s>", "!!", "<|endoftext|>", "ß", "\x1c", "\x85", "²"]
    texts = ["".join(rng.choice(pool) if rng.random() < 0.7 else chr(rng.randrange(1, 0x250)) for _ in range(rng.randrange(25))) for _ in range(4000)]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in own.encode(texts)] == expected


ROWS = [*(r[:2] for r in brute.ODD), (30, "<|endoftext|> <s> a"), (31, "▁x"), (32, "a  b   c "), (33, " "), (34, "\x00ﬁ x"), (35, "café")]


def test_odd_rows(spark):
    df = shipped(spark).createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "'x' AS a", "1 AS groups", "2 AS part")
    rows = found(token_alignment.aligned_documents(df.repartition(3), A, B))
    assert brute.by_text(rows) == brute.by_text(plain(ROWS))
    assert token_alignment.aligned_documents(df.limit(0), A, B).count() == 0


@pytest.mark.parametrize("name, value", [("FAN", 2), ("HELD", 10), ("SEGMENT_BYTES", 4000), ("VECTOR", 3), ("SLICE_BYTES", 50)])
def test_sizes_do_not_matter(spark, monkeypatch, name, value):
    """A tree of several levels, tasks that write often, several segments, short vectors and slices."""
    monkeypatch.setattr(token_alignment, name, value)
    rng = random.Random(3)
    pool = ["the", "tion", "é", "日本", "🙂", "12", "abra", " ", "cad", "\n"]
    rows = [(k, "".join(rng.choice(pool) for _ in range(rng.randrange(40)))) for k in range(90)]
    df = shipped(spark).createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert sorted(found(token_alignment.aligned_documents(df, A, B))) == sorted(plain(rows))


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    got = registered()["op12_cross_tokenizer_alignment"](shipped(spark), DATA)
    own = [(*(r[n] for n in NAMES), r.groups_sha256) for r in got.collect()]
    digest = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    assert sorted(own) == sorted((*r[:-1], digest(r[-1])) for r in plain(rows))
    assert got.filter(F.col("n_links") > 0).count() > 0


def test_a_stretch_of_documents_is_bounded():
    """A task aligns SLICE_BYTES of ids at a time, whatever it is given; a longer document is one of its own."""
    ids = [b"\1\0\0\0" * n for n in (30_000, 90_000, 60_000, 300_000, 1)] * 4
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())] * 2, ["a", "b"])
    found = list(token_alignment._slices(batch, 0, 1))
    assert [x for _, xs, _ in found for x in xs] == ids
    assert all(2 * sum(map(len, xs)) <= token_alignment.SLICE_BYTES or len(xs) == 1 for _, xs, _ in found)
