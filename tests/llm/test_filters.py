"""Quality rules, exact dedup, mixing and the pipeline against plain versions."""

import hashlib

import pytest

import corpus_pipeline
from phasediff.llm import exact_dedup, mixing, quality_rules
from phasediff.llm.oracle import ORACLES
from phasediff.llm.queries import registered
from phasediff.llm.store import shipped
from phasediff.verify.compare import differences, oracle_connection
from tests.conftest import DATA
from tests.llm import brute


@pytest.fixture(scope="module")
def odd(spark):
    return shipped(spark).createDataFrame(brute.ODD, brute.DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], brute.DOCS)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_oracle(spark, name):
    con = oracle_connection(DATA)
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM read_parquet('{DATA}/{table}.parquet')")
    assert differences(registered()[name](spark, DATA), con, ORACLES[name]) == []


def test_measures_of_odd_rows(odd):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = quality_rules.quality_rules(odd).collect()
    found = [(r.doc_id, *(r[n] for n in names)) for r in rows]
    assert brute.by_text(found) == brute.by_text([(d, *brute.base_measures(t)) for d, t, *_ in brute.ODD])
    assert all(not r.kept for r in rows if r.text in (None, "", " \t\n"))


def test_repeated_windows_overlap_and_touch(spark):
    texts = ["a b c d e f g h " * 3, "a " * 30, " ".join(map(str, range(40))), "a b c d e f g h i a b c d e f g h"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.n_repeat_words for r in quality_rules.quality_rules(df).collect()}
    assert found == {k: brute.base_measures(t)[4] for k, t in enumerate(texts)}


def test_rules_use_no_python(odd):
    plan = quality_rules.quality_rules(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_clashing_columns_are_replaced(spark):
    df = spark.createDataFrame([(1, brute.COMMON, -1, "x")], "doc_id long, text string, n_words long, extra string")
    row = quality_rules.quality_rules(df).first()
    assert (row.n_words, row.extra, row.kept) == (20, "x", True)


@pytest.mark.parametrize("size", [64, 4096])
def test_exact_dedup_of_odd_rows(odd, size):
    rows = exact_dedup.exact_dedup(odd, size).collect()
    groups: dict[str, list] = {}
    for doc, text, *_ in brute.ODD:
        groups.setdefault(brute.normal(text), []).append(doc)
    assert len(rows) == len(brute.ODD)
    for r in rows:
        text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        ids = [d for d in groups[text] if d is not None]
        assert r.group_size == len(groups[text]) and r.keep_id == min(ids, default=None)
    assert sum(r.kept for r in rows) == len(groups)
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_exact_dedup_tells_long_texts_apart(spark):
    texts = ["ab" * 50, "ab" * 50 + "c", "ab" * 51, "c" + "ab" * 50, "ab" * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.keep_id for r in exact_dedup.exact_dedup(df, 4).collect()} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 0}


def test_mixing_redistributes_among_siblings_first(spark):
    leaves = [("a", "en", "s1", 10), ("a", "en", "s2", 500), ("a", "de", "s3", 1000), ("b", "en", "s4", 1000)]
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
    mix = mixing.Mix(budget_percent=20, max_epochs=1)
    budgets = {r.source: r.budget for r in mixing.leaf_budgets(df, mix).collect()}
    # 502 tokens: 251 a domain, of a's 125 a language; s1 has only 10, so its sibling s2 takes the rest of en
    assert budgets == {"s1": 10, "s2": 115, "s3": 125, "s4": 251}


def test_mixing_of_odd_rows(odd):
    rows = mixing.mixed_sources(odd, mixing.Mix(budget_percent=70, max_epochs=2)).collect()
    assert brute.by_text([(r.doc_id, r.n_tokens) for r in rows]) == brute.by_text([(d, len(brute.words(t))) for d, t, *_ in brute.ODD])
    total = sum(r.n_tokens for r in rows)
    taken = sum(r.take_tokens for r in rows)
    assert 0.69 * total <= taken <= 0.7 * total
    assert all(r.take_tokens <= 2 * r.n_tokens for r in rows)
    for leaf in {(r.domain, r.lang, r.source) for r in rows}:
        own = [r for r in rows if (r.domain, r.lang, r.source) == leaf]
        assert len({r.epochs for r in own}) == 1 and sum(0 < r.part_tokens < r.n_tokens for r in own) <= 1


def test_empty_tables(spark, none):
    shipped(spark)
    assert quality_rules.quality_rules(none).count() == 0
    assert exact_dedup.exact_dedup(none).count() == 0
    assert mixing.mixed_sources(none, mixing.Mix()).count() == 0


def test_pipeline_equals_plain_version(spark):
    """Every stage on what the one before kept."""
    shipped(spark)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [tuple(r) for r in docs.collect()]
        docs = corpus_pipeline.written(stage(spark, docs, DATA), "test")
        after = {r.doc_id for r in docs.collect()}
        if name == "quality rules":
            judged = {d for d, t, *_ in before if (m := brute.base_measures(t))[0] < 20 or 100 * m[4] > 30 * m[0]}
            assert not judged & after
        elif name == "exact dedup":
            first: dict[str, int] = {}
            for d, t, *_ in sorted(before):
                first.setdefault(brute.normal(t), d)
            assert after == set(first.values())
        elif name == "n-gram Jaccard join":
            assert after == {c for _, _, c in brute.components([(d, t) for d, t, *_ in before], 5, 80)}
        else:
            assert after and after <= {r[0] for r in before}
        assert docs.columns == list(corpus_pipeline.COLUMNS)
    out = corpus_pipeline.run(spark, DATA).collect()
    assert {r.doc_id for r in out} == after


def test_pipeline_stages_take_odd_rows(spark, odd, none):
    shipped(spark)
    for start in (odd, none):
        docs = corpus_pipeline.written(start.withColumnRenamed("n_chars", "n_chars"), "odd")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            stored = corpus_pipeline.written(stage(spark, docs, DATA), "stage")
            assert stored.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).count() == docs.count()
