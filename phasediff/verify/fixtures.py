"""Budget-shaped views over the star-schema tables.

Services are suppliers, agencies nations, pillars regions; line items are budget lines and orders
positions. Code tables are expressions, so only the service dimension is joined.
"""

from __future__ import annotations

from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phasediff import constants as K
from phasediff.functions.columns import case_sql, sql_literal
from phasediff.operators.joins import estimated_bytes, lookup_join
from phasediff.operators.scratch import materialize
from phasediff.plans.finance import line_summary_wide

# Code tables of the fixtures.
LINE_FUNDS = {
    1: (1001, "General"),
    2: (1001, "General"),
    3: (2000, "Internal Service"),
    4: (4000, "Federal"),
    5: (5000, "State"),
    6: (6000, "Special Revenue"),
    7: (7000, "Special Grant"),
}
OBJECTS = {
    0: "Transfers",
    1: "Salaries",
    2: "Other Personnel Costs",
    3: "Contractual Services",
    4: "Materials and Supplies",
    5: "Equipment < $5K",
    6: "Equipment > $5K",
    7: "Grants, Subsidies and Contributions",
    8: "Debt Service",
    9: "Capital Improvements",
}
SUBOBJECTS = ("101", "162", "202", "279", "205", "285", "335", "401", "396", "318")
CLASSES = {1: "Analyst", 2: "Engineer", 3: "Inspector", 4: "Manager, Senior", 5: "Clerk"}
POSITION_FUNDS = {0: (1001, "General"), 1: (1001, "General"), 2: (4000, "Federal"), 3: (5000, "State")}
SHEET_ROWS = (
    (1, "Adjustments", "Amount", "Tollgate Decision", None, None, None, None),
    (2, "FY2023 Adopted", "NUM", None, "Technical Adjustments", None, None, None),
    (3, "CLS Adjustments", "NUM", None, "Item", "Object", "Subobject", "Amount"),
    (4, "Pension", "NUM", None, "x", "3", "318", "500"),
    (5, None, None, None, "Enter item here", None, None, None),
    (6, "TLS Adjustments", "NUM", None, None, None, None, None),
    (7, "FinRec Adjustments", "Pending", None, "Total", None, None, None),
    (8, None, None, None, "Savings Ideas", None, None, None),
    (9, None, None, None, "Item", "Object", "Subobject", "Amount"),
    (10, "Request Adjustments", "NUM", "ok", "y", "4", "401", "-75"),
    (11, None, None, None, "Total", None, None, None),
    (12, None, None, None, "Tollgate Notes", None, None, None),
    (99, "Adjustments", "NUM", None, "x", None, None, None),
)

#: Rows that some sheets lack: the title, the total of the first block, the total of the second, an entry.
SHEET_GAPS = (
    "row_no = 2 AND service_id % 13 = 4",
    "row_no = 7 AND service_id % 11 = 5",
    "row_no = 11 AND service_id % 5 = 2",
    "row_no = 4 AND service_id % 7 = 3",
)


def _fund_columns(code: str, table: dict[int, tuple[int, str]]) -> list[str]:
    ids, names = {k: v[0] for k, v in table.items()}, {k: v[1] for k, v in table.items()}
    return [f"{case_sql(code, ids)} AS fund_id", f"{case_sql(code, names)} AS fund_name"]


def _tab(service: str = "service_id") -> str:
    """Tab name of a service: its number with at least three digits."""
    text = f"CAST({service} AS STRING)"
    return f"IF(length({text}) < 3, lpad({text}, 3, '0'), {text})"


@cache
def _table_schema(path: str) -> T.StructType:
    """Schema of a test table, read from its footer once per process."""
    return SparkSession.active().read.parquet(path).schema


class Fixtures:
    """The views of one data folder; each is built at most once and nothing runs until used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        return self.spark.read.schema(_table_schema(path)).parquet(path)

    @cached_property
    def _dims(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.table("supplier"), self.table("nation"), self.table("region")

    @cached_property
    def service_bytes(self) -> int | None:
        """Size bound of the service dimension: it has the rows of the supplier table."""
        sizes = [estimated_bytes(d) for d in self._dims]
        return None if None in sizes else sum(sizes)

    @cached_property
    def service_agency(self) -> DataFrame:
        supplier, nation, _ = self._dims
        return lookup_join(
            supplier.selectExpr(
                "CAST(s_suppkey AS BIGINT) AS service_id",
                "s_name AS service_name",
                "CAST(s_nationkey AS INT) AS agency_id",
            ),
            nation.selectExpr(
                "CAST(n_nationkey AS INT) AS agency_id",
                "n_name AS agency_name",
                "n_regionkey AS region_id",
            ),
            ["agency_id"],
        )

    @cached_property
    def service(self) -> DataFrame:
        pillars = self._dims[2].selectExpr("r_regionkey AS region_id", "r_name AS objective_name")
        return lookup_join(self.service_agency, pillars, ["region_id"]).select(
            "service_id", "service_name", "agency_id", "agency_name", "objective_name"
        )

    def with_service(self, fact: DataFrame, services: DataFrame) -> DataFrame:
        return lookup_join(fact, services, ["service_id"], dim_bytes=self.service_bytes)

    @cached_property
    def budget_line(self) -> DataFrame:
        return self._budget_lines()

    @cached_property
    def general_line(self) -> DataFrame:
        """Lines of the general fund, chosen before the service names are attached."""
        return self._budget_lines(f"fund_id = {K.GENERAL_FUND_ID}")

    def _budget_lines(self, kept: str = "TRUE") -> DataFrame:
        end = "CASE l_orderkey % 3 WHEN 0 THEN price - qty WHEN 1 THEN price ELSE price + qty END"
        shifted = "IF((l_suppkey + l_partkey % 10) % 9 = 0, l_partkey + 2, l_partkey)"
        object_id = f"CAST({shifted} % 10 AS INT)"

        def amount(value: str, missing: int) -> str:
            case = f"CASE WHEN l_suppkey % 20 = 7 THEN 0 WHEN l_orderkey % {missing} = 0 THEN NULL"
            return f"CAST({case} ELSE {value} END AS DECIMAL(18,2))"

        priced = self.table("lineitem").selectExpr(
            "*",
            "CAST(l_extendedprice AS DECIMAL(18,2)) AS price",
            "CAST(l_quantity AS DECIMAL(18,2)) AS qty",
        )
        fact = priced.selectExpr(
            "CAST(l_suppkey AS BIGINT) AS service_id",
            *_fund_columns("l_linenumber", LINE_FUNDS),
            f"{object_id} AS object_id",
            f"{case_sql(object_id, OBJECTS)} AS object_name",
            f"{case_sql('l_orderkey % 10', dict(enumerate(SUBOBJECTS)))} AS subobject_id",
            "IF(l_quantity > 45, 'policy', NULL) AS justification",
            f"{amount('price', 17)} AS amount_start",
            f"{amount(end, 19)} AS amount_end",
        )
        return self.with_service(fact.filter(kept), self.service).select(
            "agency_id",
            "agency_name",
            "service_id",
            "service_name",
            "fund_id",
            "fund_name",
            "object_id",
            "object_name",
            "subobject_id",
            "objective_name",
            "justification",
            "amount_start",
            "amount_end",
        )

    def _positions(self, kept: str, moved: bool) -> DataFrame:
        def shift(every: int) -> str:
            return f"IF(o_orderkey % {every} = 0, 1, 0)" if moved else "0"

        class_id = (
            f"CAST((CAST(substr(o_orderpriority, 1, 1) AS INT) - 1 + {shift(11)}) % 5 + 1 AS INT)"
        )
        salary = f"CAST(o_totalprice AS DECIMAL(18,2)) + {500 if moved else 0}"
        services = self._dims[0].agg(F.count(F.lit(1))).scalar()
        fact = self.table("orders").filter(kept).selectExpr(
            "o_orderkey AS job_number",
            f"o_custkey + {shift(7)} AS _customer",
            *_fund_columns(f"(o_orderkey + {shift(13)}) % 4", POSITION_FUNDS),
            f"{class_id} AS class_id",
            f"{case_sql(class_id, CLASSES)} AS class_name",
            "o_orderstatus AS si_id",
            f"CAST({salary} AS DECIMAL(18,2)) AS salary",
            f"CAST({salary} + CAST(o_orderkey % 1000 AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS total_cost",
        )
        placed = fact.withColumn("service_id", F.col("_customer") % services)
        return self.with_service(placed, self.service_agency).selectExpr(
            "job_number",
            "IF(job_number % 997 = 0, NULL, agency_id) AS agency_id",
            "IF(job_number % 997 = 0, NULL, agency_name) AS agency_name",
            "service_id",
            "service_name",
            "fund_id",
            "fund_name",
            "class_id",
            "class_name",
            "si_id",
            "salary",
            "total_cost",
        )

    @cached_property
    def pos_start(self) -> DataFrame:
        return self._positions("o_orderkey % 10 <> 0", moved=False)

    @cached_property
    def pos_end(self) -> DataFrame:
        return self._positions("o_orderkey % 10 <> 1", moved=True)

    @cached_property
    def pos_all_start(self) -> DataFrame:
        """Every order as a job of the start snapshot, for operators on a single snapshot."""
        return self._positions("TRUE", moved=False)

    @cached_property
    def pos_all_end(self) -> DataFrame:
        return self._positions("TRUE", moved=True)

    @cached_property
    def pos_with_cost_codes(self) -> DataFrame:
        """A snapshot as delivered, with a column for each single cost code."""
        codes = {f"OSO {c}": F.expr(f"total_cost - salary + {i}") for i, c in enumerate(K.OPC_CODES)}
        return self.pos_all_end.withColumns(codes)

    @cached_property
    def pos_phases(self) -> dict[str, DataFrame]:
        return {
            "planning": self.pos_end,
            "cls": self.pos_end.filter("job_number % 50 <> 3"),
            "projection": self.pos_start,
            "prior": self.pos_start.filter("job_number % 25 <> 2"),
        }

    _EXPEND_DIMS = [
        "agency_id",
        "agency_name",
        "service_id",
        "service_name",
        "fund_id",
        "fund_name",
        "subobject_id",
        "objective_name",
    ]

    @cached_property
    def expend_cls(self) -> DataFrame:
        return self.budget_line.filter("service_id % 13 <> 5").selectExpr(
            *self._EXPEND_DIMS, "amount_end AS cls_amount"
        )

    @cached_property
    def expend_prop(self) -> DataFrame:
        return self.budget_line.filter("service_id % 13 <> 6").selectExpr(
            *self._EXPEND_DIMS,
            "amount_start - 100 AS prior_actual",
            "amount_start AS adopted",
            "IF(object_id = 3, amount_end + 250, amount_end) AS request",
        )

    @cached_property
    def assignment(self) -> DataFrame:
        return (
            self.service.select("agency_id", "agency_name")
            .distinct()
            .selectExpr(
                "agency_id",
                "agency_name",
                "concat('Clean ', agency_name) AS agency_clean",
                "concat('A', agency_id) AS agency_short",
                "IF(agency_id % 9 = 4, NULL, concat('analyst_', agency_id % 5)) AS analyst",
                "agency_id % 8 <> 7 AS operational",
            )
        )

    @cached_property
    def sheet_row(self) -> DataFrame:
        """Sheets of which some lack rows, for the operators that find blocks in them."""
        return self._sheet_rows(f"NOT ({' OR '.join(SHEET_GAPS)})")

    @cached_property
    def whole_sheet_row(self) -> DataFrame:
        """Every row of every sheet."""
        return self._sheet_rows("TRUE")

    def _sheet_rows(self, kept: str) -> DataFrame:
        names = ("row_no", "change_label", "c12", "c13", "rec", "c16", "c17", "c18")

        def cell(name: str, value) -> str:
            text = "CAST(NULL AS STRING)" if value is None else sql_literal(value)
            return f"{text} AS {name}"

        structs = [
            f"struct({', '.join(cell(n, v) for n, v in zip(names, row, strict=True))})"
            for row in SHEET_ROWS
        ]
        rows = self.service.selectExpr("*", f"inline(array({', '.join(structs)}))")
        return rows.filter(kept).selectExpr(
            "concat('/in/FY24 Change Table ', agency_name, '.xlsx') AS file_path",
            f"IF(row_no = 99, 'Agency Summary', {_tab()}) AS sheet",
            "row_no",
            "change_label",
            "IF(c12 = 'NUM', CAST(service_id * 1000 - row_no AS STRING), c12) AS c12",
            "c13",
            "CASE WHEN rec = 'x' THEN concat('adj ', service_name) "
            "WHEN rec = 'y' THEN IF(service_id % 2 = 0, 'idea', NULL) ELSE rec END AS recommendation",
            "c16",
            "c17",
            "c18",
        )

    @cached_property
    def note_row(self) -> DataFrame:
        """Earlier sheets; objects whose budget grew have an analyst note."""
        keyed = self.budget_line.groupBy("agency_name", "service_id", "object_id").agg(
            F.expr("sum(amount_end) > sum(amount_start) AS grew")
        )
        return keyed.selectExpr(
            "concat('/notes/Change Table_', agency_name, '.xlsx') AS file_path",
            f"{_tab()} AS sheet",
            "IF(object_id = 1, '1, 2', CAST(object_id AS STRING)) AS object_id",
            "IF(grew, concat('note ', object_id), NULL) AS analyst_notes",
        )

    @cached_property
    def flat_adjustment(self) -> DataFrame:
        """Hand-made adjustments: one candidate per budget line."""
        return self.budget_line.selectExpr(
            "service_id",
            "object_id",
            "concat('item ', subobject_id) AS note",
            "IF(subobject_id IN ('101', '205', '401'), 'Yes', 'No') AS include",
            "amount_end - amount_start AS amount",
        )

    @cached_property
    def measure(self) -> DataFrame:
        """Performance measures of services, some of them in no known pillar."""
        return self.table("part").selectExpr(
            "p_name AS measure",
            "p_partkey % 120 AS service_id",
            "concat('Clean ', p_brand) AS agency_clean",
            "p_type AS extra_pm_table",
        )

    @cached_property
    def line_item_detail(self) -> DataFrame:
        """Line items with every level of the chart of accounts and five phases."""
        activity, sub = "object_id % 3", "CAST(subobject_id AS INT) % 2"
        return self.budget_line.selectExpr(
            "agency_id",
            "agency_name",
            "service_id AS program_id",
            "service_name AS program_name",
            f"{activity} AS activity_id",
            f"concat('Activity ', {activity}) AS activity_name",
            f"{sub} AS subactivity_id",
            f"concat('Subactivity ', {sub}) AS subactivity_name",
            "fund_id",
            "fund_name",
            f"fund_id * 10 + {sub} AS detailed_fund_id",
            "concat(fund_name, ' detail') AS detailed_fund_name",
            "object_id",
            "object_name",
            "subobject_id",
            "concat('Subobject ', subobject_id) AS subobject_name",
            "length(objective_name) AS objective_id",
            "objective_name",
            "amount_start AS current_adopted",
            "amount_end AS cls_request",
            "amount_end + 10 AS proposal1",
            "amount_end + 20 AS tls_request",
            "amount_end + 30 AS finance_recommendation",
            "amount_end - amount_start AS change_vs_adopted",
            "try_divide(CAST(amount_end - amount_start AS DOUBLE), CAST(amount_start AS DOUBLE)) "
            "AS perc_change_vs_adopted",
            "justification",
        )

    @cached_property
    def _expenditure_sums(self) -> DataFrame:
        """The sums of the expenditures; names that follow from a code are added after them."""
        return (
            self.budget_line.withColumnsRenamed({"service_id": "program_id", "service_name": "program_name"})
            .groupBy("agency_id", "agency_name", "program_id", "program_name", "fund_id", "object_id", "subobject_id")
            .agg(
                F.sum("amount_start").alias("curr_adopted"),
                F.sum("amount_end").alias("tot_budget"),
                F.expr("sum(amount_start - 10) AS ytd_exp"),
            )
        )

    @staticmethod
    def _expenditures(sums: DataFrame) -> DataFrame:
        coded = sums.selectExpr(
            "agency_id",
            "agency_name",
            "program_id",
            "program_name",
            "object_id % 3 AS activity_id",
            "fund_id",
            f"{case_sql('fund_id', dict(LINE_FUNDS.values()))} AS fund_name",
            "object_id",
            f"{case_sql('object_id', OBJECTS)} AS object_name",
            "subobject_id",
            "curr_adopted",
            "tot_budget",
            "ytd_exp",
        )
        return coded.selectExpr(
            "*",
            "concat('Activity ', activity_id) AS activity_name",
            "concat('Subobject ', subobject_id) AS subobject_name",
            "curr_adopted - 1 AS prior_adopted",
            "curr_adopted - 2 AS prior_actual",
            "curr_adopted - 3 AS prior_ytd_actual",
            "tot_budget - curr_adopted AS carry_fwd_a",
            "CAST(5 AS DECIMAL(18,2)) AS carry_fwd_b",
            "tot_budget - curr_adopted + 5 AS carry_fwd_total",
            "CAST(7 AS DECIMAL(18,2)) AS app_adj",
            *[f"ytd_exp + {i} AS {m}" for i, m in enumerate(K.MONTHS, start=1)],
            "ytd_exp - 4 AS tot_enc",
            "ytd_exp - 6 AS cur_acc",
            "ytd_exp + 8 AS total_spent",
            "tot_budget - ytd_exp - 8 AS surp_def",
        )

    @cached_property
    def cur_expend(self) -> DataFrame:
        return self._expenditures(self._expenditure_sums)

    @cached_property
    def cur_expend_table(self) -> DataFrame:
        """The sums are stored once: three inputs of the expenditure detail derive from them."""
        return self._expenditures(materialize(self._expenditure_sums, "cur_expend"))

    @cached_property
    def line_item_report(self) -> DataFrame:
        return (
            self.cur_expend_table.filter("program_id % 4 <> 1")
            .groupBy("agency_id", "program_id", "activity_id", "fund_id", "subobject_id")
            .agg(F.expr("max(concat('why ', object_name)) AS justification"))
        )

    @cached_property
    def carry_fwd(self) -> DataFrame:
        return self.cur_expend_table.filter("object_id = 6").selectExpr(
            "agency_id",
            "program_id",
            "activity_id",
            "fund_id",
            "object_id",
            "subobject_id",
            "'carry' AS text",
        )

    @cached_property
    def line_item_summary(self) -> DataFrame:
        """Wide fund columns; a fund the data knows is NULL for programs without it."""
        known = {i for i, _ in LINE_FUNDS.values()}
        columns = [
            f"sum(IF(fund_id = {i}, tot_budget, NULL)) AS fund_{i}"
            if i in known
            else f"CAST(0 AS DECIMAL(18,2)) AS fund_{i}"
            for i in K.SUMMARY_FUNDS
        ]
        return self.cur_expend.groupBy(
            "agency_id", "agency_name", "program_id", "program_name"
        ).agg(*[F.expr(c) for c in columns])

    @cached_property
    def line_item_summary_long(self) -> DataFrame:
        return line_summary_wide(self.cur_expend, "tot_budget")

    @cached_property
    def all_opcs(self) -> DataFrame:
        return self.pos_all_end.selectExpr(
            "job_number",
            "class_id",
            "class_id % 3 AS union_code",
            "agency_id AS agency",
            "service_id AS program",
            "service_id % 3 AS activity",
            "fund_id AS fund",
            "fund_id * 10 AS detailed_fund",
            "si_id AS special_indicator",
            "1 AS adopted_position",
            "total_cost",
            *[f"total_cost - salary + {i} AS opc_{c}" for i, c in enumerate(K.OPC_CODES)],
        )
