"""Sentences about position changes and the notes built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phasediff import constants as K
from phasediff.functions.columns import drop_last, sql_literal, sum0, upper_first
from phasediff.operators.ordinals import numbered_within
from phasediff.plans.positions import (
    COSTS,
    KINDS,
    MERGED_KINDS,
    as_text_ids,
    changed_jobs,
    changes_of_jobs,
    job_diff,
    position_pairs,
    positions_fund_moves,
    positions_fund_non_gf,
)

NOTE_SEPARATOR = " \n"
# Kinds that stand on the end service, fund and class: the only ones that can share a sentence.
SHARED_SENTENCE = ("service_from", "fund_from", "reclass_to")


def _sentence_columns() -> dict[str, str]:
    """SQL of the number of changes told together, their sentence and the place of each in it.

    Changes are told together when they stand on the same agency, service, fund, class and
    indicator. For one job only the inbound kinds can do that, so the group is known from the
    joined row and nothing has to be collected.
    """
    told, parts, places = "0", [], {}
    for name in SHARED_SENTENCE:
        kind = KINDS[name]
        places[f"_at_{name}"] = f"{told} + 1"
        wording = f"IF({told} = 0, {kind.single}, {kind.multiple})"
        parts.append(f"IF({kind.applies}, {wording}, NULL)")
        told = f"{told} + IF({kind.applies}, 1, 0)"
    return {"_told": told, "_parts": f"array_compact(array({', '.join(parts)}))", **places}


# Joins the parts of a sentence: "a", "a and b", "a, b, and c".
_JOINED = """
    IF(_told <= 2, array_join(_parts, ' and '),
       concat(array_join(slice(_parts, 1, _told - 1), ', '), ', and ', element_at(_parts, -1)))"""


def _sentence_rows(jobs: DataFrame, *kinds: str) -> DataFrame:
    """Changes of the given kinds with their sentence, still with the wordings they are built from."""
    helpers = _sentence_columns()
    told = changed_jobs(jobs, *kinds).withColumns({c: F.expr(sql) for c, sql in helpers.items()})
    rows = changes_of_jobs(told, *kinds)
    shared = f"change_type IN ({', '.join(sql_literal(k) for k in SHARED_SENTENCE)})"
    places = " ".join(f"WHEN '{k}' THEN _at_{k}" for k in SHARED_SENTENCE)
    text = upper_first(F.expr(f"IF({shared}, {_JOINED}, change_single)"))
    numbered = rows.withColumns(
        {
            "change_num": F.expr(f"IF({shared}, _told, 1)"),
            "change_order": F.expr(f"CASE change_type {places} ELSE 1 END"),
            "change": text,
        }
    )
    shorter = F.when(F.col("change_num") > 1, drop_last(F.col("change"), "transfer"))
    return numbered.withColumn("change", shorter.otherwise(F.col("change"))).drop(*helpers)


def position_sentences(start: DataFrame, end: DataFrame) -> DataFrame:
    """Every change with the sentence it belongs to and its place in it."""
    return _sentence_rows(job_diff(start, end), *MERGED_KINDS).drop("change_single", "change_multiple")


def fund_moves_elsewhere(start: DataFrame, end: DataFrame) -> DataFrame:
    """Moves between two funds other than the general fund, in the layout of the detail."""
    all_moves = positions_fund_moves(position_pairs(start, end))
    moves = as_text_ids(positions_fund_non_gf(all_moves))
    return moves.withColumn(
        "change", F.replace(F.col("change_multiple"), F.lit("transfer"), F.lit("Transfer"))
    ).drop("change_single", "change_multiple", "change_net")


def position_detail(sentences: DataFrame, elsewhere: DataFrame) -> DataFrame:
    """One row per job and sentence, then the moves between other funds.

    A sentence about several changes keeps the row of its first change.
    """
    order = F.lit(K.CHANGE_TYPES.index("fund_non_gf") + 1)
    told = sentences.filter(F.col("change_order") == 1).drop("change_order")
    both = told.unionByName(elsewhere.withColumn("type_order", order), allowMissingColumns=True)
    return both.withColumn("service_id", F.col("service_id").cast("bigint"))


def full_position_detail(start: DataFrame, end: DataFrame) -> DataFrame:
    """`position_detail` of two snapshots from one join of them.

    The joined row of a job expands into its rows of all eight kinds; a move between other funds has its
    own wording, and neither a count nor a difference.
    """
    rows = _sentence_rows(job_diff(start, end), *K.CHANGE_TYPES).filter("change_order = 1")
    elsewhere = F.col("change_type") == "fund_non_gf"
    own = F.replace(F.col("change_multiple"), F.lit("transfer"), F.lit("Transfer"))
    absent = ["change_num", "change_net", *[f"{n}_diff" for n in COSTS]]
    return rows.withColumns(
        {
            "change": F.when(elsewhere, own).otherwise(F.col("change")),
            "service_id": F.col("service_id").cast("bigint"),
            **{c: F.when(~elsewhere, F.col(c)) for c in absent},
        }
    ).drop("change_single", "change_multiple", "change_order")


SUMMARY_KEYS = [
    "agency_id",
    "agency_name",
    "service_id",
    "service_name",
    "fund_name",
    "class_id",
    "class_name",
    "si_id",
    "change",
    "change_num",
]
COUNT_KEYS = ["service_id", "fund_name", "class_id", "si_id", "change"]


def position_summary(sentences: DataFrame) -> DataFrame:
    """Equal sentences merged, with the number of jobs written into them.

    The number counts jobs, not changes: each job has exactly one row with `change_order` 1 per
    sentence. `sentence` keeps the wording with the placeholder, the sort key of the notes.
    """
    costs = [f"{n}_{when}" for n in COSTS for when in ("start", "end", "diff")]
    merged = sentences.groupBy(*SUMMARY_KEYS).agg(
        sum0("change_net").alias("change_net"),
        *[sum0(c).alias(c) for c in costs if c != "salary_start"],
        F.count_if(F.col("change_order") == 1).alias("_jobs"),
    )
    jobs = F.sum("_jobs").over(Window.partitionBy(*COUNT_KEYS))
    n = F.col("num_positions")
    counted = F.replace(
        F.col("sentence"), F.lit(" XX "), F.concat(F.lit(" "), n.cast("string"), F.lit(" "))
    )
    text = F.when(n == 1, F.replace(F.col("sentence"), F.lit(" XX"), F.lit(""))).otherwise(
        F.replace(counted, F.lit(" position"), F.lit(" positions"))
    )
    return (
        merged.withColumn("num_positions", jobs)
        .filter(F.col("agency_name").isNotNull())
        .withColumnRenamed("change", "sentence")
        .withColumn("change", text)
        .withColumn("service_id", F.col("service_id").cast("bigint"))
        .drop("_jobs")
    )


NOTE_ORDER = [
    "agency_id",
    "agency_name",
    "service_name",
    "class_id",
    "class_name",
    "si_id",
    "sentence",
    "change_num",
]


def position_note(summary: DataFrame) -> DataFrame:
    """The general-fund sentences of each service, one row each, numbered in NOTE_ORDER.

    A service may own a large share of all sentences, so they are never collected into one text. The
    lines of a note in the order of `note_no`, with NOTE_SEPARATOR between them, are that text. The
    summary is evaluated once, when this is called: the numbered lines are stored.
    """
    general = summary.filter(F.col("fund_name") == K.GENERAL_FUND_NAME).select(
        "service_id", *NOTE_ORDER, "change", "total_cost_diff"
    )
    return numbered_within(general, ["service_id"], NOTE_ORDER, "note_no").select(
        "service_id",
        F.lit(K.EMPLOYEE_OBJECT_ID).alias("object_id"),
        "note_no",
        F.col("change").alias("position_note"),
        "total_cost_diff",
    )
