"""Diff of two position snapshots: which jobs were created, dropped, moved or reclassified.

One full outer join on the job number feeds every kind of change. What happened to a job is known
from its joined row alone, so neither the kinds nor the sentences need another shuffle.

Where a row stands: outbound rows (`eliminate`, `service_to`) describe the job as it was at the
start, all others as it is at the end. `fund_to` stands on the end service but keeps the fund,
class and indicator it leaves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasediff import constants as K
from phasediff.functions.columns import lookup, numeric_columns, sql_literal, zero_filled

JOB = "job_number"
PLACE = ["agency_id", "agency_name", "service_id", "service_name"]
KIND = ["fund_id", "fund_name", "class_id", "class_name", "si_id"]
COSTS = ["salary", "opcs", "total_cost"]
INBOUND = ("service_from", "fund_from")
OUTBOUND = ("service_to", "fund_to")


def position_clean(positions: DataFrame) -> DataFrame:
    """Drop single cost-code columns, fill missing numbers with 0, derive other personnel costs."""
    kept = positions.select(*[c for c in positions.columns if not c.lower().startswith("oso")])
    filled = zero_filled(kept, numeric_columns(kept, exclude=[JOB]))
    return filled.withColumn("opcs", F.expr("total_cost - salary"))


def _side(positions: DataFrame, prefix: str) -> DataFrame:
    """The jobs of a snapshot; hand-made total rows have neither job number nor agency."""
    clean = position_clean(positions.filter("job_number IS NOT NULL OR agency_id IS NOT NULL"))
    return clean.selectExpr(*[f"{c} AS {prefix}{c}" for c in (JOB, *PLACE, *KIND, *COSTS)])


def _checked_side(positions: DataFrame, prefix: str) -> DataFrame:
    """One side of the join; fails on a missing or repeated job number.

    The count runs over the partitioning and order the join needs anyway.
    """
    key = prefix + JOB
    message = "'job_number must be present and unique in a snapshot'"
    return (
        _side(positions, prefix)
        .withColumn("_n", F.expr(f"count(1) OVER (PARTITION BY {key})"))
        .filter(f"IF({key} IS NULL OR _n > 1, CAST(raise_error({message}) AS BOOLEAN), TRUE)")
        .drop("_n")
    )


def job_diff(start: DataFrame, end: DataFrame) -> DataFrame:
    """Both snapshots side by side, one row per job of either (`s_` and `e_` columns)."""
    s, e = _checked_side(start, "s_"), _checked_side(end, "e_")
    return s.join(e, s[f"s_{JOB}"] == e[f"e_{JOB}"], "full_outer")


def position_pairs(start: DataFrame, end: DataFrame) -> DataFrame:
    """Jobs that are in both snapshots."""
    s, e = _checked_side(start, "s_"), _checked_side(end, "e_")
    return s.join(e, s[f"s_{JOB}"] == e[f"e_{JOB}"], "inner")


def _text(*parts: str) -> str:
    """SQL of a joined text in which a missing value reads "NA".

    A part that names a column of either side stands for its value, any other part for itself.
    """
    values = [
        f"coalesce(CAST({p} AS STRING), 'NA')" if p[:2] in ("s_", "e_") else sql_literal(p)
        for p in parts
    ]
    return f"concat({', '.join(values)})"


@dataclass(frozen=True)
class Change:
    """One kind of change, in SQL over a joined row: when it applies, what it says, its net count.

    `place` is the side (`s_` or `e_`) its agency and service come from, `kind` the side of its
    fund, class and indicator.
    """

    applies: str
    net: int | None
    single: str
    multiple: str = "CAST(NULL AS STRING)"
    place: str = "e_"
    kind: str = "e_"


_BOTH = f"s_{JOB} IS NOT NULL AND e_{JOB} IS NOT NULL"
_MOVED_SERVICE = f"{_BOTH} AND s_service_id <> e_service_id"
_MOVED_FUND = f"{_BOTH} AND s_fund_id <> e_fund_id"


def _transfer(*detail: str, lead: str = "transfer ") -> dict[str, str]:
    return {
        "single": _text("transfer XX ", "s_class_name", " position ", *detail),
        "multiple": _text(lead, *detail),
    }


KINDS: dict[str, Change] = {
    "create": Change(
        f"s_{JOB} IS NULL AND e_fund_name = '{K.GENERAL_FUND_NAME}'",
        1,
        _text("create XX ", "e_class_name", " position"),
    ),
    "service_to": Change(
        _MOVED_SERVICE,
        -1,
        **_transfer("to Service ", "e_service_id", ": ", "e_service_name"),
        place="s_",
        kind="s_",
    ),
    "service_from": Change(
        _MOVED_SERVICE,
        1,
        **_transfer("from Service ", "s_service_id", ": ", "s_service_name"),
    ),
    "fund_to": Change(
        f"{_MOVED_FUND} AND s_fund_id = {K.GENERAL_FUND_ID}",
        -1,
        **_transfer("to ", "e_fund_name", " Fund from General Fund"),
        kind="s_",
    ),
    "fund_from": Change(
        f"{_MOVED_FUND} AND e_fund_id = {K.GENERAL_FUND_ID}",
        1,
        **_transfer("from ", "s_fund_name", " Fund to General Fund"),
    ),
    "eliminate": Change(
        f"e_{JOB} IS NULL",
        -1,
        _text("eliminate XX ", "s_class_name", " position"),
        place="s_",
        kind="s_",
    ),
    "reclass_to": Change(
        f"{_BOTH} AND s_class_id <> e_class_id",
        0,
        _text("reclassify XX ", "s_class_name", " position to ", "e_class_name"),
        _text("reclassify to ", "e_class_name"),
    ),
    "fund_non_gf": Change(
        f"{_MOVED_FUND} AND {K.GENERAL_FUND_ID} NOT IN (s_fund_id, e_fund_id)",
        None,
        **_transfer("from ", "s_fund_name", " Fund to ", "e_fund_name", " Fund", lead=" transfer "),
    ),
}


def changed_jobs(jobs: DataFrame, *kinds: str) -> DataFrame:
    """Only the jobs something happened to, before any text is built for them."""
    return jobs.filter(" OR ".join(f"({KINDS[k].applies})" for k in kinds))


def _changes_of_kind(jobs: DataFrame, *kinds: str) -> DataFrame:
    """Rows of the given kinds, stacked, with the costs of both snapshots as they were."""
    tags = ", ".join(f"IF({KINDS[k].applies}, '{k}', NULL)" for k in kinds)

    def by_kind(value) -> str:
        """CASE over the kinds, those with equal results in one branch."""
        results: dict[str, list[str]] = {}
        for k in kinds:
            results.setdefault(value(KINDS[k]), []).append(f"'{k}'")
        if len(results) == 1:
            return next(iter(results))
        branches = [f"WHEN change_type IN ({', '.join(ks)}) THEN {r}" for r, ks in results.items()]
        return f"CASE {' '.join(branches)} END"

    columns = {JOB: f"coalesce(e_{JOB}, s_{JOB})"}
    columns |= {n: by_kind(lambda c, n=n: c.place + n) for n in PLACE}
    columns |= {n: by_kind(lambda c, n=n: c.kind + n) for n in KIND}
    columns |= {
        "change_single": by_kind(lambda c: c.single),
        "change_multiple": by_kind(lambda c: c.multiple),
        "change_net": by_kind(lambda c: "CAST(NULL AS INT)" if c.net is None else str(c.net)),
    }
    for n in COSTS:
        columns |= {f"{n}_start": f"s_{n}", f"{n}_end": f"e_{n}"}
    helpers = [c for c in jobs.columns if c.startswith("_")]
    return changed_jobs(jobs, *kinds).withColumn(
        "change_type", F.expr(f"explode(array_compact(array({tags})))")
    ).selectExpr("change_type", *[f"{v} AS {n}" for n, v in columns.items()], *helpers)


def _absent(side: DataFrame, prefix: str) -> DataFrame:
    """Give a one-sided frame the columns of the other side, all NULL."""
    nulls = [
        f"CAST(NULL AS {f.dataType.simpleString()}) AS {prefix}{f.name[2:]}"
        for f in side.schema.fields
    ]
    return side.selectExpr("*", *nulls)


def positions_created(start: DataFrame, end: DataFrame) -> DataFrame:
    """Jobs only in the end snapshot, general fund only."""
    s, e = _side(start, "s_"), _side(end, "e_")
    only = e.join(s.select(f"s_{JOB}"), e[f"e_{JOB}"].eqNullSafe(s[f"s_{JOB}"]), "left_anti")
    return _changes_of_kind(_absent(only, "s_"), "create")


def positions_eliminated(start: DataFrame, end: DataFrame) -> DataFrame:
    """Jobs only in the start snapshot, whatever their fund."""
    s, e = _side(start, "s_"), _side(end, "e_")
    only = s.join(e.select(f"e_{JOB}"), s[f"s_{JOB}"].eqNullSafe(e[f"e_{JOB}"]), "left_anti")
    return _changes_of_kind(_absent(only, "e_"), "eliminate")


def positions_service_in(pairs: DataFrame) -> DataFrame:
    return _changes_of_kind(pairs, "service_from")


def positions_service_out(pairs: DataFrame) -> DataFrame:
    return _changes_of_kind(pairs, "service_to")


def positions_reclassified(pairs: DataFrame) -> DataFrame:
    return _changes_of_kind(pairs, "reclass_to")


def positions_fund_moves(pairs: DataFrame) -> DataFrame:
    """Every job whose fund changed; the three kinds differ in wording."""
    return _changes_of_kind(pairs, "fund_to", "fund_from", "fund_non_gf")


def positions_fund_out(fund_moves: DataFrame) -> DataFrame:
    return fund_moves.filter("change_type = 'fund_to'")


def positions_fund_in(fund_moves: DataFrame) -> DataFrame:
    return fund_moves.filter("change_type = 'fund_from'")


def positions_fund_non_gf(fund_moves: DataFrame) -> DataFrame:
    return fund_moves.filter("change_type = 'fund_non_gf'")


def as_text_ids(changes: DataFrame) -> DataFrame:
    ids = ["agency_id", "service_id", "fund_id", JOB, "class_id", "si_id"]
    return changes.withColumns({c: F.expr(f"CAST({c} AS STRING)") for c in ids})


def _kind_list(kinds: tuple[str, ...]) -> str:
    return ", ".join(f"'{k}'" for k in kinds)


def attribute_costs(changes: DataFrame) -> DataFrame:
    """A moved job counts in full: nothing before on its new place, nothing after on its old."""
    moved = {"start": _kind_list(INBOUND), "end": _kind_list(OUTBOUND)}
    attributed = changes.withColumns(
        {
            f"{n}_{when}": F.expr(
                f"IF(change_type IN ({kinds}), 0, coalesce({n}_{when}, 0))"
            )
            for n in COSTS
            for when, kinds in moved.items()
        }
    )
    return attributed.withColumns({f"{n}_diff": F.expr(f"{n}_end - {n}_start") for n in COSTS})


MERGED_KINDS = tuple(k for k in K.CHANGE_TYPES if k != "fund_non_gf")


def changes_of_jobs(jobs: DataFrame, *kinds: str) -> DataFrame:
    """Changes with attributed costs; `type_order` is the display order of the kinds."""
    rows = attribute_costs(_changes_of_kind(jobs, *kinds))
    order = {k: i for i, k in enumerate(K.CHANGE_TYPES, start=1)}
    return as_text_ids(rows).withColumn("type_order", lookup("change_type", order))


def position_changes(start: DataFrame, end: DataFrame) -> DataFrame:
    """All changes except moves between two other funds.

    Display order: agency name, service, fund name, class name, `type_order`.
    """
    return changes_of_jobs(job_diff(start, end), *MERGED_KINDS)
