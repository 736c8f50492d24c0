"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
NO_SPACE = r"[^\x20\x09-\x0D]"
SYMBOL = "[#*$%&|<>]"
WINDOW = 8

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for on as with be by this are was or at from "
    "der die das und den von zu mit sich des auf für ist im dem nicht ein eine als "
    "le la les et des en un une du que qui dans par pour au sur pas il elle "
    "el los las y del se por con para su al lo de"
).split()


@dataclass(frozen=True)
class Rule:
    """measure (a column of measured()) divided by per, from least to most; a rule without words never fails."""

    name: str
    measure: str
    per: str | None
    least: float | None = None
    most: float | None = None


RULES = (
    Rule("length", "n_words", None, least=20),
    Rule("word_length", "word_chars", "n_words", least=2, most=20),
    Rule("symbols", "n_symbols", "n_words", most=0.3),
    Rule("stop_words", "n_stop_words", "n_words", least=0.05),
    Rule("line_copies", "n_dup_lines", "n_lines", most=0.3),
    Rule("repeats", "n_repeat_words", "n_words", most=0.3),
)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value evaluated once for a row, also where use reads it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a + b.cast("long"))


def repeated_words(words: Column) -> Column:
    """Words that stand in a window of WINDOW words which the text has twice or more."""

    def covered(places: Column) -> Column:
        return total(
            F.transform(places, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW))))
        )

    def repeats(windows: Column) -> Column:
        def twice(x: Column, k: Column) -> Column:
            before = F.get(windows, F.greatest(k - 1, F.lit(0)))["h"]
            return ((k > 0) & (before == x["h"])) | F.coalesce(F.get(windows, k + 1)["h"] == x["h"], F.lit(False))

        return bound(F.sort_array(F.transform(F.filter(windows, twice), lambda x: x["p"])), covered)

    def from_hashes(hashes: Column) -> Column:
        windows = F.sort_array(F.transform(hashes, lambda h, k: F.struct(h.alias("h"), k.alias("p"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            bound(windows, repeats)
        )

    def paired(hashes: Column, distance: int) -> Column:
        return F.zip_with(hashes, F.slice(hashes, distance + 1, F.size(hashes)), lambda a, b: F.xxhash64(a, b))

    def from_words(w: Column) -> Column:
        # of runs of 2, 4 and 8 words, each from two of half the length; the last ones are incomplete
        hashes = bound(paired(w, 1), lambda two: bound(paired(two, 2), lambda four: paired(four, 4)))
        whole = F.slice(hashes, 1, F.size(w) - (WINDOW - 1))
        return F.when(F.size(w) < WINDOW, F.lit(0).cast("long")).otherwise(bound(whole, from_hashes))

    return bound(words, from_words)


def measured(docs: DataFrame) -> DataFrame:
    """docs with the measures that rules may use; columns of docs that have the name of a measure are replaced."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(text, SPACE + "+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(NO_SPACE))
    split = docs.withColumns({"_words": words, "_lines": lines})
    measures = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": F.length(text) - F.length(F.regexp_replace(text, SYMBOL, "")),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": repeated_words(F.col("_words")),
        "n_stop_words": F.size(F.filter("_words", lambda w: F.lower(w).isin(*STOP_WORDS))),
        "n_lines": F.size("_lines"),
    }
    return split.withColumns({k: v.cast("long") for k, v in measures.items()}).drop("_words", "_lines")


def passes(rule: Rule) -> Column:
    value = F.col(rule.measure) / F.nullif(F.col(rule.per), F.lit(0)) if rule.per else F.col(rule.measure)
    least = value >= rule.least if rule.least is not None else F.lit(True)
    most = value <= rule.most if rule.most is not None else F.lit(True)
    return F.coalesce(least & most, F.lit(True))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with the measures, base_failed, a boolean column rule_<name> for each rule, and kept.

    One projection of built-in functions: no shuffle, whatever the length of a text. Words are runs of
    other characters than white space. A null or empty text has no words: it fails the base and goes.
    Repeated rows each get their own verdict; an empty table gives an empty result; other columns pass
    through. Windows of words are compared by 64-bit hashes within one text.
    """
    judged = measured(docs).withColumn("base_failed", base_failed())
    judged = judged.withColumns({f"rule_{r.name}": passes(r) for r in rules})
    return judged.withColumn("kept", reduce(lambda a, b: a & b, (F.col(f"rule_{r.name}") for r in rules), ~F.col("base_failed")))
