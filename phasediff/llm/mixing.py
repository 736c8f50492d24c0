"""Mixing sources to target weights: a token budget flows down a tree of domains, languages and sources.

Among siblings a child without enough tokens is served in full, and what it leaves goes to its siblings
by their weights; only what a whole family cannot take is left to the families next to it. Each leaf then
takes a prefix of its seeded epochs: whole passes first, then the first tokens of one more permutation.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phasediff.llm.store import written

LEVELS = ("domain", "lang", "source")
WORDS = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """Positive integer weights by name and level (others weigh 1), budget as percent of all tokens."""

    weights: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    budget_percent: int = 50
    max_epochs: int = 4
    seed: int = 17


def source_domain(source: Column) -> Column:
    """The default domain of a source: the last digit of its name modulo 3; other names are web."""
    digit = F.regexp_extract(source, "([0-9])$", 1)
    return (
        F.when(digit.isin("0", "3", "6", "9"), "web").when(digit.isin("1", "4", "7"), "books")
        .when(digit.isin("2", "5", "8"), "code").otherwise("web")
    )


def _weight(weights: Mapping[str, int], name: str) -> Column:
    out = F.lit(1)
    for value, weight in weights.items():
        out = F.when(F.col(name) == value, weight).otherwise(out)
    return out.cast("long")


def served(children: DataFrame, parents: list[str], name: str, weights: Mapping[str, int]) -> DataFrame:
    """Divides budget (of the parent, on every row) among children with capacity; adds the child's own budget."""
    family = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    ordered = family.orderBy("ratio", name)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    after = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = children.withColumn("weight", _weight(weights, name)).withColumn("ratio", F.col("capacity") / F.col("weight"))
    rows = rows.withColumn("left", F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0)))
    rows = rows.withColumn("open", F.sum("weight").over(after))
    rows = rows.withColumn("full", F.col("capacity") * F.col("open") <= F.col("left") * F.col("weight"))
    first = F.min(F.when(~F.col("full"), F.struct("ratio", name, "left", "open"))).over(family)
    rows = rows.withColumn("first", first)
    share = F.expr("(greatest(first.left, 0L) * weight) div first.open")
    budget = F.when(F.col("full"), F.col("capacity")).otherwise(share)
    return rows.withColumn("budget", budget).drop("weight", "ratio", "left", "open", "full", "first")


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """leaves: domain, lang, source, tokens. Adds budget, at most max_epochs times the tokens.

    The tables here have a row for each node of the tree, so their windows are small.
    """
    tree = leaves.withColumn("capacity", F.col("tokens") * mix.max_epochs)
    domains = tree.groupBy("domain").agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
    all_tokens = F.sum("tokens").over(Window.partitionBy(F.lit(0)))
    all_capacity = F.sum("capacity").over(Window.partitionBy(F.lit(0)))
    wanted = F.least((all_tokens * mix.budget_percent / 100).cast("long"), all_capacity)
    domains = served(domains.withColumn("budget", wanted), [], "domain", mix.weights.get("domain", {}))
    langs = tree.groupBy("domain", "lang").agg(F.sum("capacity").alias("capacity"))
    langs = langs.join(domains.select("domain", "budget"), "domain")
    langs = served(langs, ["domain"], "lang", mix.weights.get("lang", {}))
    sources = tree.join(langs.select("domain", "lang", "budget"), ["domain", "lang"])
    return served(sources, ["domain", "lang"], "source", mix.weights.get("source", {})).select(*LEVELS, "tokens", "budget")


def mixed_sources(docs: DataFrame, mix: Mix, domain: Column | None = None) -> DataFrame:
    """For each row of docs: row, doc_id, domain, lang, source, n_tokens, epochs, part_tokens, take_tokens.

    epochs: whole passes of the row's leaf; part_tokens: what the prefix of the next pass takes of the row
    (the row that the prefix ends in gives its first tokens only); take_tokens: both together, 0 where the
    row is not chosen. Tokens are runs of other characters than white space; null and empty texts have
    none. Null names of lang or source stand as ''. The order of a pass is the MD5 of seed, pass and
    doc_id, then doc_id and row (monotonically_increasing_id() of docs), so repeated rows keep an order.
    A leaf with a third of all rows is summed by 4,096 parts of that order; only the part that the prefix
    ends in is sorted.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.size(F.array_remove(F.split(text, SPACES), ""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long"),
        F.coalesce(domain if domain is not None else source_domain(F.col("source")), F.lit("")).alias("domain"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"),
        words.cast("long").alias("n_tokens"),
    )
    rows = written(rows, "counted")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    budgets = leaf_budgets(leaves, mix).select(
        *LEVELS,
        F.expr("coalesce(budget div nullif(tokens, 0L), 0L)").alias("epochs"),
        F.expr("coalesce(budget % nullif(tokens, 0L), 0L)").alias("rest"),
    )
    budgets = written(budgets, "budgets")
    key = F.md5(F.concat_ws(":", F.lit(mix.seed), "epochs", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    rows = rows.join(budgets, list(LEVELS)).withColumn("key", key).withColumn("part", F.substring("key", 1, 3))
    parts = rows.groupBy(*LEVELS, "rest", "part").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.partitionBy(*LEVELS).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    parts = parts.select(*LEVELS, "part", "before", (F.col("before") + F.col("tokens") <= F.col("rest")).alias("inside"))
    parts = written(parts, "parts")
    rows = rows.join(parts, [*LEVELS, "part"])
    ends = rows.filter("not inside and before < rest")
    earlier = Window.partitionBy(*LEVELS, "part").orderBy("key", "doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("before", F.col("before") + F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))
    ends = ends.withColumn("part_tokens", F.greatest(F.least("n_tokens", F.col("rest") - F.col("before")), F.lit(0)))
    others = rows.filter("inside or before >= rest")
    others = others.withColumn("part_tokens", F.when(F.col("inside"), F.col("n_tokens")).otherwise(F.lit(0)))
    columns = ["row", "doc_id", *LEVELS, "n_tokens", "epochs", F.col("part_tokens").cast("long").alias("part_tokens")]
    out = ends.select(*columns).unionByName(others.select(*columns))
    return out.withColumn("take_tokens", F.col("epochs") * F.col("n_tokens") + F.col("part_tokens"))
