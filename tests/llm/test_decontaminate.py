"""Benchmark windows in documents against a plain scan."""

import random
import re

import pytest
from pyspark.sql import functions as F

from phasediff.llm import decontaminate
from phasediff.llm.oracle import OP13
from phasediff.llm.queries import registered
from phasediff.llm.store import shipped
from phasediff.verify.compare import differences, oracle_connection
from tests.conftest import DATA
from tests.llm import brute

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
BENCH = "item_id long, text string"


def plain(docs, bench, size=10):
    """[(id, words, hit words, sorted items)]"""
    known = {}
    for item, text in bench:
        w = WORD.findall(brute.lower(text))
        for window in [w] if 0 < len(w) < size else [w[k : k + size] for k in range(len(w) - size + 1)]:
            known.setdefault(tuple(window), set()).update(() if item is None else (str(item),))
    out = []
    for doc, text in docs:
        w = WORD.findall(brute.lower(text))
        hit, items = set(), set()
        for n in {len(k) for k in known}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in known:
                    hit.update(range(k, k + n))
                    items |= known[tuple(w[k : k + n])]
        out.append((doc, len(w), len(hit), sorted(items)))
    return out


def found(df):
    return [(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in df.collect()]


def random_case(seed):
    rng = random.Random(seed)
    some = [f"W{k}é" if k % 5 == 0 else f"w{k}" for k in range(9)]
    bench = [(rng.choice([None, *range(30)]), rng.choice([" ", "-", "\n"]).join(rng.choice(some) for _ in range(rng.choice([0, 1, 3, 4, 6, 9])))) for _ in range(25)]
    docs = [(k, ", ".join(rng.choice(some) for _ in range(rng.choice([0, 1, 5, 40, 90])))) for k in range(120)]
    return docs, [*bench, (77, None), *bench[:3]]


@pytest.mark.parametrize("chunk, most", [(2048, 64 << 20), (3, 64 << 20), (7, 0)])
def test_windows_of_all_sizes(spark, monkeypatch, chunk, most):
    """Short items too, texts in small chunks, and a set that is too large to be broadcast."""
    monkeypatch.setattr(decontaminate, "CHUNK", chunk)
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", most)
    docs, bench = random_case(chunk)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = decontaminate.contamination(df, spark.createDataFrame(bench, BENCH), 4)
    assert ("_salt" in rows._jdf.queryExecution().executedPlan().toString()) == (most == 0)
    assert sorted(found(rows)) == sorted(plain(docs, bench, 4))


def test_odd_rows(spark):
    docs = spark.createDataFrame(brute.ODD, brute.DOCS).withColumns({"row": F.lit("x"), "window": F.lit(1), "carried": F.lit(2)})
    bench = [(3, " ".join(brute.COMMON.upper().split()[4:15])), (3, brute.COMMON), (None, brute.LONG[-200:]), (9, None), (8, ""), (5, "日本語の文")]
    given = spark.createDataFrame(bench, BENCH).withColumn("window", F.lit("clash"))
    rows = decontaminate.contamination(docs, given)
    expected = plain([r[:2] for r in brute.ODD], bench)
    assert brute.by_text(found(rows)) == brute.by_text(expected)
    for remove in ("spans", "documents"):
        kept = decontaminate.decontaminated(docs, given, remove)
        assert kept.columns == docs.columns
        hit = sum(1 for r in expected if r[2])
        assert kept.count() == len(expected) - (hit if remove == "documents" else 0)
        assert decontaminate.contamination(kept, given).filter("contaminated").count() == 0


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame(brute.ODD, brute.DOCS), spark.createDataFrame([(1, brute.COMMON)], BENCH)
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    rows = decontaminate.contamination(docs, bench.limit(0)).collect()
    assert len(rows) == len(brute.ODD) and not any(r.contaminated for r in rows)


def test_removed_spans(spark):
    text = "Keep this: ONE two, three four! Then five. One two three four"
    docs = spark.createDataFrame([(1, text), (2, "one two"), (3, None), (4, "(one) two three four")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two three four")], BENCH)
    rows = {r.doc_id: r.text for r in decontaminate.decontaminated(docs, bench, "spans", 4).collect()}
    assert rows == {1: "Keep this: Then five. ", 2: "one two", 3: None, 4: "("}


def test_documents_against_sql(spark):
    con = oracle_connection(DATA)
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM read_parquet('{DATA}/{name}.parquet')")
    df = registered()["op13_benchmark_decontamination"](shipped(spark), DATA)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop") if word in plan]
    assert differences(df, con, OP13) == []
    assert df.filter("contaminated").count() > 0
