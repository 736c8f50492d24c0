"""SQL oracles: what each registered query must return, as plain SQL over the same tables.

The statements share named terms; a statement gets the terms it uses as a WITH list. They follow
the definitions step by step (groups, windows, joins) and not the plans of the Spark side.
"""

from __future__ import annotations

import re

from phasediff import constants as K

MONTH_COLUMNS = ", ".join(f"ytd_exp + {i} AS {m}" for i, m in enumerate(K.MONTHS, start=1))

TERMS: dict[str, str] = {
    # ------------------------------------------------------------ fixtures
    "fx_service": """
        SELECT CAST(s.s_suppkey AS BIGINT) AS service_id, s.s_name AS service_name,
               CAST(n.n_nationkey AS INT) AS agency_id, n.n_name AS agency_name,
               r.r_name AS objective_name
        FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "fx_fund": """
        SELECT * FROM (VALUES (1,1001,'General'),(2,1001,'General'),(3,2000,'Internal Service'),
        (4,4000,'Federal'),(5,5000,'State'),(6,6000,'Special Revenue'),(7,7000,'Special Grant'))
        AS t(k, fund_id, fund_name)""",
    "fx_object": """
        SELECT * FROM (VALUES (0,'Transfers'),(1,'Salaries'),(2,'Other Personnel Costs'),
        (3,'Contractual Services'),(4,'Materials and Supplies'),(5,'Equipment < $5K'),
        (6,'Equipment > $5K'),(7,'Grants, Subsidies and Contributions'),(8,'Debt Service'),
        (9,'Capital Improvements')) AS t(object_id, object_name)""",
    "fx_subobject": """
        SELECT * FROM (VALUES (0,'101'),(1,'162'),(2,'202'),(3,'279'),(4,'205'),(5,'285'),
        (6,'335'),(7,'401'),(8,'396'),(9,'318')) AS t(k, subobject_id)""",
    "fx_budget_line": """
        SELECT v.agency_id, v.agency_name, v.service_id, v.service_name, f.fund_id, f.fund_name,
               o.object_id, o.object_name, b.subobject_id, v.objective_name,
               CASE WHEN l.l_quantity > 45 THEN 'policy' ELSE NULL END AS justification,
               CAST(CASE WHEN l.l_suppkey % 20 = 7 THEN CAST(0 AS DECIMAL(18,2))
                    WHEN l.l_orderkey % 17 = 0 THEN NULL
                    ELSE CAST(l.l_extendedprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS amount_start,
               CAST(CASE WHEN l.l_suppkey % 20 = 7 THEN CAST(0 AS DECIMAL(18,2))
                    WHEN l.l_orderkey % 19 = 0 THEN NULL
                    ELSE CAST(l.l_extendedprice AS DECIMAL(18,2)) + CAST(l.l_quantity AS DECIMAL(18,2))
                         * CAST(l.l_orderkey % 3 - 1 AS DECIMAL(2,0)) END AS DECIMAL(18,2)) AS amount_end
        FROM lineitem l JOIN fx_service v ON v.service_id = l.l_suppkey
        JOIN fx_fund f ON f.k = l.l_linenumber
        JOIN fx_object o ON o.object_id = (l.l_partkey + CASE WHEN (l.l_suppkey + l.l_partkey % 10) % 9 = 0 THEN 2 ELSE 0 END) % 10
        JOIN fx_subobject b ON b.k = CAST(l.l_orderkey % 10 AS INT)""",
    "fx_class": """
        SELECT * FROM (VALUES (1,'Analyst'),(2,'Engineer'),(3,'Inspector'),(4,'Manager, Senior'),
        (5,'Clerk')) AS t(class_id, class_name)""",
    "fx_pos_fund": """
        SELECT * FROM (VALUES (0,1001,'General'),(1,1001,'General'),(2,4000,'Federal'),
        (3,5000,'State')) AS t(k, fund_id, fund_name)""",
    "fx_pos_start": """
        SELECT o.o_orderkey AS job_number,
               CASE WHEN o.o_orderkey % 997 = 0 THEN NULL ELSE v.agency_id END AS agency_id,
               CASE WHEN o.o_orderkey % 997 = 0 THEN NULL ELSE v.agency_name END AS agency_name,
               v.service_id, v.service_name, f.fund_id, f.fund_name, c.class_id, c.class_name,
               o.o_orderstatus AS si_id, CAST(o.o_totalprice AS DECIMAL(18,2)) AS salary,
               CAST(o.o_totalprice AS DECIMAL(18,2)) + CAST(o.o_orderkey % 1000 AS DECIMAL(18,2)) AS total_cost
        FROM orders o CROSS JOIN (SELECT COUNT(*) AS n FROM supplier) k
        JOIN fx_service v ON v.service_id = o.o_custkey % k.n
        JOIN fx_pos_fund f ON f.k = o.o_orderkey % 4
        JOIN fx_class c ON c.class_id = CAST(SUBSTR(o.o_orderpriority,1,1) AS INT)
        WHERE o.o_orderkey % 10 <> 0""",
    "fx_pos_end": """
        SELECT o.o_orderkey AS job_number,
               CASE WHEN o.o_orderkey % 997 = 0 THEN NULL ELSE v.agency_id END AS agency_id,
               CASE WHEN o.o_orderkey % 997 = 0 THEN NULL ELSE v.agency_name END AS agency_name,
               v.service_id, v.service_name, f.fund_id, f.fund_name, c.class_id, c.class_name,
               o.o_orderstatus AS si_id, CAST(o.o_totalprice AS DECIMAL(18,2)) + 500 AS salary,
               CAST(o.o_totalprice AS DECIMAL(18,2)) + 500 + CAST(o.o_orderkey % 1000 AS DECIMAL(18,2)) AS total_cost
        FROM orders o CROSS JOIN (SELECT COUNT(*) AS n FROM supplier) k
        JOIN fx_service v
          ON v.service_id = (o.o_custkey + CASE WHEN o.o_orderkey % 7 = 0 THEN 1 ELSE 0 END) % k.n
        JOIN fx_pos_fund f
          ON f.k = (o.o_orderkey + CASE WHEN o.o_orderkey % 13 = 0 THEN 1 ELSE 0 END) % 4
        JOIN fx_class c
          ON c.class_id = (CAST(SUBSTR(o.o_orderpriority,1,1) AS INT) - 1
                           + CASE WHEN o.o_orderkey % 11 = 0 THEN 1 ELSE 0 END) % 5 + 1
        WHERE o.o_orderkey % 10 <> 1""",
    "fx_expend_cls": """
        SELECT agency_id, agency_name, service_id, service_name, fund_id, fund_name, subobject_id,
               objective_name, amount_end AS cls_amount
        FROM fx_budget_line WHERE service_id % 13 <> 5""",
    "fx_expend_prop": """
        SELECT agency_id, agency_name, service_id, service_name, fund_id, fund_name, subobject_id,
               objective_name, amount_start - 100 AS prior_actual, amount_start AS adopted,
               CASE WHEN object_id = 3 THEN amount_end + 250 ELSE amount_end END AS request
        FROM fx_budget_line WHERE service_id % 13 <> 6""",
    "fx_pos_phase": """
        SELECT 'planning' AS phase, agency_name, service_id, service_name, fund_name FROM fx_pos_end
        UNION ALL SELECT 'cls', agency_name, service_id, service_name, fund_name FROM fx_pos_end
          WHERE job_number % 50 <> 3
        UNION ALL SELECT 'projection', agency_name, service_id, service_name, fund_name FROM fx_pos_start
        UNION ALL SELECT 'prior', agency_name, service_id, service_name, fund_name FROM fx_pos_start
          WHERE job_number % 25 <> 2""",
    "fx_assignment": """
        SELECT agency_id, agency_name, CONCAT('Clean ', agency_name) AS agency_clean,
               CONCAT('A', CAST(agency_id AS VARCHAR)) AS agency_short,
               CASE WHEN agency_id % 9 = 4 THEN NULL
                    ELSE CONCAT('analyst_', CAST(agency_id % 5 AS VARCHAR)) END AS analyst,
               agency_id % 8 <> 7 AS operational
        FROM (SELECT DISTINCT agency_id, agency_name FROM fx_service) d""",
    "fx_sheet_row": """
        SELECT CONCAT('/in/FY24 Change Table ', v.agency_name, '.xlsx') AS file_path,
               CASE WHEN r.row_no = 99 THEN 'Agency Summary'
                    WHEN v.service_id > 99 THEN CAST(v.service_id AS VARCHAR)
                    ELSE LPAD(CAST(v.service_id AS VARCHAR), 3, '0') END AS sheet,
               r.row_no, r.change_label,
               CASE WHEN r.c12 = 'NUM' THEN CAST(v.service_id * 1000 - r.row_no AS VARCHAR)
                    ELSE r.c12 END AS c12, r.c13,
               CASE WHEN r.rec = 'x' THEN CONCAT('adj ', v.service_name)
                    WHEN r.rec = 'y' AND v.service_id % 2 = 0 THEN 'idea'
                    WHEN r.rec = 'y' THEN NULL ELSE r.rec END AS recommendation,
               r.c16, r.c17, r.c18
        FROM fx_service v CROSS JOIN (SELECT * FROM (VALUES
         (1,'Adjustments','Amount','Tollgate Decision',NULL,NULL,NULL,NULL),
         (2,'FY2023 Adopted','NUM',NULL,'Technical Adjustments',NULL,NULL,NULL),
         (3,'CLS Adjustments','NUM',NULL,'Item','Object','Subobject','Amount'),
         (4,'Pension','NUM',NULL,'x','3','318','500'),
         (5,NULL,NULL,NULL,'Enter item here',NULL,NULL,NULL),
         (6,'TLS Adjustments','NUM',NULL,NULL,NULL,NULL,NULL),
         (7,'FinRec Adjustments','Pending',NULL,'Total',NULL,NULL,NULL),
         (8,NULL,NULL,NULL,'Savings Ideas',NULL,NULL,NULL),
         (9,NULL,NULL,NULL,'Item','Object','Subobject','Amount'),
         (10,'Request Adjustments','NUM','ok','y','4','401','-75'),
         (11,NULL,NULL,NULL,'Total',NULL,NULL,NULL),
         (12,NULL,NULL,NULL,'Tollgate Notes',NULL,NULL,NULL),
         (99,'Adjustments','NUM',NULL,'x',NULL,NULL,NULL))
         AS t(row_no, change_label, c12, c13, rec, c16, c17, c18)) r
        WHERE NOT (r.row_no = 2 AND v.service_id % 13 = 4) AND NOT (r.row_no = 7 AND v.service_id % 11 = 5)
          AND NOT (r.row_no = 11 AND v.service_id % 5 = 2) AND NOT (r.row_no = 4 AND v.service_id % 7 = 3)""",
    "fx_whole_sheet_row": """
        SELECT CONCAT('/in/FY24 Change Table ', v.agency_name, '.xlsx') AS file_path,
               CASE WHEN r.row_no = 99 THEN 'Agency Summary'
                    WHEN v.service_id > 99 THEN CAST(v.service_id AS VARCHAR)
                    ELSE LPAD(CAST(v.service_id AS VARCHAR), 3, '0') END AS sheet,
               r.row_no, r.change_label,
               CASE WHEN r.c12 = 'NUM' THEN CAST(v.service_id * 1000 - r.row_no AS VARCHAR)
                    ELSE r.c12 END AS c12, r.c13,
               CASE WHEN r.rec = 'x' THEN CONCAT('adj ', v.service_name)
                    WHEN r.rec = 'y' AND v.service_id % 2 = 0 THEN 'idea'
                    WHEN r.rec = 'y' THEN NULL ELSE r.rec END AS recommendation,
               r.c16, r.c17, r.c18
        FROM fx_service v CROSS JOIN (SELECT * FROM (VALUES
         (1,'Adjustments','Amount','Tollgate Decision',NULL,NULL,NULL,NULL),
         (2,'FY2023 Adopted','NUM',NULL,'Technical Adjustments',NULL,NULL,NULL),
         (3,'CLS Adjustments','NUM',NULL,'Item','Object','Subobject','Amount'),
         (4,'Pension','NUM',NULL,'x','3','318','500'),
         (5,NULL,NULL,NULL,'Enter item here',NULL,NULL,NULL),
         (6,'TLS Adjustments','NUM',NULL,NULL,NULL,NULL,NULL),
         (7,'FinRec Adjustments','Pending',NULL,'Total',NULL,NULL,NULL),
         (8,NULL,NULL,NULL,'Savings Ideas',NULL,NULL,NULL),
         (9,NULL,NULL,NULL,'Item','Object','Subobject','Amount'),
         (10,'Request Adjustments','NUM','ok','y','4','401','-75'),
         (11,NULL,NULL,NULL,'Total',NULL,NULL,NULL),
         (12,NULL,NULL,NULL,'Tollgate Notes',NULL,NULL,NULL),
         (99,'Adjustments','NUM',NULL,'x',NULL,NULL,NULL))
         AS t(row_no, change_label, c12, c13, rec, c16, c17, c18)) r""",
    "fx_note_row": """
        SELECT CONCAT('/notes/Change Table_', agency_name, '.xlsx') AS file_path,
               CASE WHEN service_id > 99 THEN CAST(service_id AS VARCHAR)
                    ELSE LPAD(CAST(service_id AS VARCHAR), 3, '0') END AS sheet,
               CASE WHEN object_id = 1 THEN '1, 2' ELSE CAST(object_id AS VARCHAR) END AS object_id,
               CASE WHEN SUM(amount_end) > SUM(amount_start)
                    THEN CONCAT('note ', CAST(object_id AS VARCHAR)) END AS analyst_notes
        FROM fx_budget_line GROUP BY agency_name, service_id, object_id""",
    "fx_flat": """
        SELECT service_id, object_id, CONCAT('item ', subobject_id) AS note,
               CASE WHEN subobject_id IN ('101','205','401') THEN 'Yes' ELSE 'No' END AS include,
               amount_end - amount_start AS amount FROM fx_budget_line""",
    "fx_measure": """
        SELECT p_name AS measure, p_partkey % 120 AS service_id,
               CONCAT('Clean ', p_brand) AS agency_clean, p_type AS extra_pm_table FROM part""",
    "fx_line_detail": """
        SELECT agency_id, agency_name, service_id AS program_id, service_name AS program_name,
               object_id % 3 AS activity_id, CONCAT('Activity ', CAST(object_id % 3 AS VARCHAR)) AS activity_name,
               CAST(subobject_id AS INT) % 2 AS subactivity_id,
               CONCAT('Subactivity ', CAST(CAST(subobject_id AS INT) % 2 AS VARCHAR)) AS subactivity_name,
               fund_id, fund_name, fund_id * 10 + CAST(subobject_id AS INT) % 2 AS detailed_fund_id,
               CONCAT(fund_name, ' detail') AS detailed_fund_name, object_id, object_name,
               subobject_id, CONCAT('Subobject ', subobject_id) AS subobject_name,
               CAST(LENGTH(objective_name) AS INT) AS objective_id, objective_name,
               amount_start AS current_adopted, amount_end AS cls_request,
               amount_end + 10 AS proposal1, amount_end + 20 AS tls_request,
               amount_end + 30 AS finance_recommendation,
               amount_end - amount_start AS change_vs_adopted,
               CASE WHEN amount_start <> 0 THEN CAST(amount_end - amount_start AS DOUBLE)
                    / CAST(amount_start AS DOUBLE) END AS perc_change_vs_adopted,
               justification
        FROM fx_budget_line""",
    "fx_cur_sums": """
        SELECT agency_id, agency_name, service_id AS program_id, service_name AS program_name,
               object_id % 3 AS activity_id, fund_id, fund_name, object_id, object_name, subobject_id,
               SUM(amount_start) AS curr_adopted, SUM(amount_end) AS tot_budget,
               SUM(amount_start - 10) AS ytd_exp
        FROM fx_budget_line GROUP BY agency_id, agency_name, service_id, service_name, object_id,
             object_name, fund_id, fund_name, subobject_id""",
    "fx_cur_expend": f"""
        SELECT *, CONCAT('Activity ', CAST(activity_id AS VARCHAR)) AS activity_name,
               CONCAT('Subobject ', subobject_id) AS subobject_name, curr_adopted - 1 AS prior_adopted,
               curr_adopted - 2 AS prior_actual, curr_adopted - 3 AS prior_ytd_actual,
               tot_budget - curr_adopted AS carry_fwd_a, 5 AS carry_fwd_b,
               tot_budget - curr_adopted + 5 AS carry_fwd_total, 7 AS app_adj, {MONTH_COLUMNS},
               ytd_exp - 4 AS tot_enc, ytd_exp - 6 AS cur_acc, ytd_exp + 8 AS total_spent,
               tot_budget - ytd_exp - 8 AS surp_def
        FROM fx_cur_sums""",
    "fx_line_item_report": """
        SELECT agency_id, program_id, activity_id, fund_id, subobject_id,
               MAX(CONCAT('why ', object_name)) AS justification
        FROM fx_cur_expend WHERE program_id % 4 <> 1
        GROUP BY agency_id, program_id, activity_id, fund_id, subobject_id""",
    "fx_carry_fwd": """
        SELECT agency_id, program_id, activity_id, fund_id, object_id, subobject_id, 'carry' AS text
        FROM fx_cur_expend WHERE object_id = 6""",
    "fx_opcs": """
        SELECT job_number, class_id, class_id % 3 AS union_code, agency_id AS agency,
               service_id AS program, service_id % 3 AS activity, fund_id AS fund,
               fund_id * 10 AS detailed_fund, si_id AS special_indicator, 1 AS adopted_position,
               total_cost, total_cost - salary AS opcs FROM fx_pos_all_end""",
    # ------------------------------------------------------------ line items
    "gf": """
        SELECT agency_id, agency_name, service_id, service_name, fund_id, fund_name, object_id,
               object_name, subobject_id, amount_start, amount_end, justification
        FROM fx_budget_line WHERE fund_id = 1001 AND agency_id IS NOT NULL""",
    "detail": """
        SELECT agency_id, agency_name, service_id, service_name, object_id, object_name, justification,
               COALESCE(SUM(amount_start), 0) AS amount_start, COALESCE(SUM(amount_end), 0) AS amount_end,
               COALESCE(SUM(amount_end), 0) - COALESCE(SUM(amount_start), 0) AS diff
        FROM gf GROUP BY agency_id, agency_name, service_id, service_name, object_id, object_name, justification""",
    "summary": """
        SELECT agency_id, agency_name, service_id, service_name,
               CASE WHEN object_id IN (1, 2) THEN 1 ELSE object_id END AS object_id,
               CASE WHEN object_name IN ('Salaries', 'Other Personnel Costs') THEN 'All Employee Costs'
                    ELSE object_name END AS object_name,
               SUM(amount_start) AS amount_start, SUM(amount_end) AS amount_end, SUM(diff) AS diff
        FROM detail GROUP BY ALL""",
    "bookends": """
        SELECT agency_id, agency_name, service_id, service_name, 'FY23 Adopted Budget' AS change_label,
               COALESCE(SUM(amount_start), 0) AS amount FROM gf GROUP BY ALL
        UNION ALL
        SELECT agency_id, agency_name, service_id, service_name, 'FY24 CLS Budget' AS change_label,
               COALESCE(SUM(amount_end), 0) AS amount FROM gf GROUP BY ALL""",
    "grid": """
        SELECT s.service_id, o.object_id
        FROM (SELECT DISTINCT service_id FROM gf) s
        CROSS JOIN (SELECT DISTINCT object_id FROM gf WHERE object_id <> 2) o""",
    # ------------------------------------------------------------ positions
    "pos_s": "SELECT *, total_cost - salary AS opcs FROM (SELECT * REPLACE (COALESCE(agency_id, 0) AS agency_id) FROM fx_pos_start)",
    "pos_all_e": "SELECT *, total_cost - salary AS opcs FROM (SELECT * REPLACE (COALESCE(agency_id, 0) AS agency_id) FROM fx_pos_all_end)",
    "pos_e": "SELECT *, total_cost - salary AS opcs FROM (SELECT * REPLACE (COALESCE(agency_id, 0) AS agency_id) FROM fx_pos_end)",
    "created": """
        SELECT 'create' AS change_type, e.job_number, e.agency_id, e.agency_name, e.service_id,
               e.service_name, e.fund_id, e.fund_name, e.class_id, e.class_name, e.si_id,
               'create XX ' || e.class_name || ' position' AS change_single,
               CAST(NULL AS VARCHAR) AS change_multiple, 1 AS change_net,
               CAST(NULL AS DECIMAL(18,2)) AS salary_start, e.salary AS salary_end,
               CAST(NULL AS DECIMAL(18,2)) AS opcs_start, e.opcs AS opcs_end,
               CAST(NULL AS DECIMAL(18,2)) AS total_cost_start, e.total_cost AS total_cost_end
        FROM pos_e e WHERE e.fund_name = 'General'
          AND NOT EXISTS (SELECT 1 FROM pos_s s WHERE s.job_number = e.job_number)""",
    "eliminated": """
        SELECT 'eliminate' AS change_type, s.job_number, s.agency_id, s.agency_name, s.service_id,
               s.service_name, s.fund_id, s.fund_name, s.class_id, s.class_name, s.si_id,
               'eliminate XX ' || s.class_name || ' position' AS change_single,
               CAST(NULL AS VARCHAR) AS change_multiple, -1 AS change_net,
               s.salary AS salary_start, CAST(NULL AS DECIMAL(18,2)) AS salary_end,
               s.opcs AS opcs_start, CAST(NULL AS DECIMAL(18,2)) AS opcs_end,
               s.total_cost AS total_cost_start, CAST(NULL AS DECIMAL(18,2)) AS total_cost_end
        FROM pos_s s WHERE NOT EXISTS (SELECT 1 FROM pos_e e WHERE e.job_number = s.job_number)""",
}

def _of_all_orders(terms: dict[str, str]) -> dict[str, str]:
    """The terms with snapshots that have every order, after those that leave some out."""
    out = {}
    for name, sql in terms.items():
        out[name] = sql
        if name in ("fx_pos_start", "fx_pos_end"):
            out[name.replace("pos", "pos_all")] = sql.rpartition("WHERE")[0]
    return out


TERMS = _of_all_orders(TERMS)


def _moved(kind: str, place: str, fund: str, single: str, multiple: str, net: str, where: str) -> str:
    return f"""
        SELECT '{kind}' AS change_type, s.job_number, {place}.agency_id, {place}.agency_name,
               {place}.service_id, {place}.service_name, {fund}.fund_id, {fund}.fund_name,
               {fund}.class_id, {fund}.class_name, {fund}.si_id,
               {single} AS change_single, {multiple} AS change_multiple, {net} AS change_net,
               s.salary AS salary_start, e.salary AS salary_end, s.opcs AS opcs_start,
               e.opcs AS opcs_end, s.total_cost AS total_cost_start, e.total_cost AS total_cost_end
        FROM pos_s s JOIN pos_e e ON s.job_number = e.job_number WHERE {where}"""


_TO_SERVICE = "'to Service ' || e.service_id || ': ' || e.service_name"
_FROM_SERVICE = "'from Service ' || s.service_id || ': ' || s.service_name"
_TO_FUND = "'to ' || e.fund_name || ' Fund from General Fund'"
_FROM_FUND = "'from ' || s.fund_name || ' Fund to General Fund'"
_OTHER_FUND = "'from ' || s.fund_name || ' Fund to ' || e.fund_name || ' Fund'"
_LONG = "'transfer XX ' || s.class_name || ' position ' || "
_SHORT = "'transfer ' || "
_FUND_CHANGED = "s.fund_id <> e.fund_id"

_COST_NAMES = ("salary", "opcs", "total_cost")


def _attributed() -> str:
    columns = []
    for n in _COST_NAMES:
        start = f"CASE WHEN change_type IN ('service_from', 'fund_from') THEN 0 ELSE COALESCE({n}_start, 0) END"
        end = f"CASE WHEN change_type IN ('service_to', 'fund_to') THEN 0 ELSE COALESCE({n}_end, 0) END"
        columns.append(f"{start} AS {n}_start, {end} AS {n}_end, {end} - {start} AS {n}_diff")
    return ", ".join(columns)


TERMS |= {
    "service_out": _moved(
        "service_to", "s", "s", _LONG + _TO_SERVICE, _SHORT + _TO_SERVICE, "-1", "s.service_id <> e.service_id"
    ),
    "service_in": _moved(
        "service_from", "e", "e", _LONG + _FROM_SERVICE, _SHORT + _FROM_SERVICE, "1", "s.service_id <> e.service_id"
    ),
    "reclassified": _moved(
        "reclass_to",
        "e",
        "e",
        "'reclassify XX ' || s.class_name || ' position to ' || e.class_name",
        "'reclassify to ' || e.class_name",
        "0",
        "s.class_id <> e.class_id",
    ),
    "fund_out": _moved(
        "fund_to", "e", "s", _LONG + _TO_FUND, _SHORT + _TO_FUND, "-1", f"{_FUND_CHANGED} AND s.fund_id = 1001"
    ),
    "fund_in": _moved(
        "fund_from", "e", "e", _LONG + _FROM_FUND, _SHORT + _FROM_FUND, "1", f"{_FUND_CHANGED} AND e.fund_id = 1001"
    ),
    "fund_non_gf": _moved(
        "fund_non_gf",
        "e",
        "e",
        _LONG + _OTHER_FUND,
        "' transfer ' || " + _OTHER_FUND,
        "CAST(NULL AS INT)",
        f"{_FUND_CHANGED} AND s.fund_id <> 1001 AND e.fund_id <> 1001",
    ),
    "raw_changes": """
        SELECT * FROM created UNION ALL SELECT * FROM service_out UNION ALL SELECT * FROM service_in
        UNION ALL SELECT * FROM fund_out UNION ALL SELECT * FROM fund_in
        UNION ALL SELECT * FROM eliminated UNION ALL SELECT * FROM reclassified""",
    "changes": f"""
        SELECT change_type, CAST(job_number AS VARCHAR) AS job_number,
               CAST(agency_id AS VARCHAR) AS agency_id, agency_name,
               CAST(service_id AS VARCHAR) AS service_id, service_name,
               CAST(fund_id AS VARCHAR) AS fund_id, fund_name,
               CAST(class_id AS VARCHAR) AS class_id, class_name, si_id, change_single,
               change_multiple, change_net, {_attributed()},
               CASE change_type WHEN 'create' THEN 1 WHEN 'service_to' THEN 2 WHEN 'service_from' THEN 3
                    WHEN 'fund_to' THEN 4 WHEN 'fund_from' THEN 5 WHEN 'eliminate' THEN 6
                    WHEN 'reclass_to' THEN 7 END AS type_order
        FROM raw_changes""",
    "numbered": """
        SELECT *, CAST(COUNT(*) OVER w AS INT) AS change_num,
               CAST(ROW_NUMBER() OVER (w ORDER BY type_order) AS INT) AS change_order
        FROM changes
        WINDOW w AS (PARTITION BY agency_id, service_id, fund_id, job_number, class_id, si_id)""",
    "group_text": """
        SELECT agency_id, service_id, fund_id, job_number, class_id, si_id,
               CASE WHEN MAX(change_num) <= 2
                    THEN STRING_AGG(part, ' and ' ORDER BY change_order)
                    ELSE STRING_AGG(part, ', ' ORDER BY change_order) FILTER (WHERE change_order < change_num)
                         || ', and ' || MAX(CASE WHEN change_order = change_num THEN part END) END AS joined
        FROM (SELECT *, CASE WHEN change_order > 1 THEN COALESCE(change_multiple, change_single)
                             ELSE change_single END AS part FROM numbered) p
        GROUP BY agency_id, service_id, fund_id, job_number, class_id, si_id""",
    "sentences": """
        SELECT n.* EXCLUDE (change_single, change_multiple),
               CASE WHEN n.change_num > 1
                    THEN REGEXP_REPLACE(UPPER(SUBSTR(g.joined, 1, 1)) || SUBSTR(g.joined, 2),
                                        '^(.*)transfer', '\\1', 's')
                    ELSE UPPER(SUBSTR(g.joined, 1, 1)) || SUBSTR(g.joined, 2) END AS change
        FROM numbered n JOIN group_text g
          ON n.agency_id IS NOT DISTINCT FROM g.agency_id AND n.service_id = g.service_id
         AND n.fund_id = g.fund_id AND n.job_number = g.job_number AND n.class_id = g.class_id
         AND n.si_id IS NOT DISTINCT FROM g.si_id""",
    "pos_summary": """
        SELECT m.* EXCLUDE (change), m.change AS sentence, CAST(c.jobs AS BIGINT) AS num_positions,
               CASE WHEN c.jobs = 1 THEN REPLACE(m.change, ' XX', '')
                    ELSE REPLACE(REPLACE(m.change, ' XX ', ' ' || c.jobs || ' '), ' position', ' positions')
               END AS change
        FROM (SELECT agency_id, agency_name, service_id, service_name, fund_name, class_id, class_name,
                     si_id, change, change_num, SUM(change_net) AS change_net,
                     SUM(salary_end) AS salary_end, SUM(salary_diff) AS salary_diff,
                     SUM(opcs_start) AS opcs_start, SUM(opcs_end) AS opcs_end, SUM(opcs_diff) AS opcs_diff,
                     SUM(total_cost_start) AS total_cost_start, SUM(total_cost_end) AS total_cost_end,
                     SUM(total_cost_diff) AS total_cost_diff
              FROM sentences GROUP BY agency_id, agency_name, service_id, service_name, fund_name,
                     class_id, class_name, si_id, change, change_num) m
        JOIN (SELECT service_id, fund_name, class_id, si_id, change, COUNT(DISTINCT job_number) AS jobs
              FROM sentences GROUP BY service_id, fund_name, class_id, si_id, change) c
          ON m.service_id = c.service_id AND m.fund_name = c.fund_name AND m.class_id = c.class_id
         AND m.si_id IS NOT DISTINCT FROM c.si_id AND m.change = c.change
        WHERE m.agency_name IS NOT NULL""",
    "note": """
        SELECT CAST(service_id AS BIGINT) AS service_id, 1 AS object_id,
               ROW_NUMBER() OVER (PARTITION BY service_id ORDER BY agency_id, agency_name, service_name,
                          class_id, class_name, si_id, sentence, change_num) AS note_no,
               change AS position_note, total_cost_diff
        FROM pos_summary WHERE fund_name = 'General'""",
    "note_total": """
        SELECT service_id, object_id, MAX(note_no) AS note_lines, SUM(total_cost_diff) AS note_cost
        FROM note GROUP BY service_id, object_id""",
    "note_line": """
        SELECT n.service_id, n.object_id, n.note_no,
               CASE WHEN n.note_no = t.note_lines
                    THEN n.position_note || ' at a cost of ' || CAST(t.note_cost AS VARCHAR)
                    ELSE n.position_note END AS position_note
        FROM note n JOIN note_total t ON n.service_id = t.service_id AND n.object_id = t.object_id
        WHERE EXISTS (SELECT 1 FROM summary s WHERE s.service_id = n.service_id AND s.object_id = n.object_id)""",
    "object_row": """
        SELECT x.service_id, x.object_id, 0 AS note_no, x.change_label, '' AS position_note, x.difference,
               t.note_cost, '' AS analyst_notes
        FROM (SELECT service_id, object_id,
                     CASE WHEN diff > 0 THEN 'Increase in ' || object_name
                          WHEN diff < 0 THEN 'Decrease in ' || object_name
                          WHEN diff = 0 THEN 'No change in ' || object_name
                          ELSE object_name END AS change_label, COALESCE(SUM(diff), 0) AS difference
              FROM summary GROUP BY service_id, object_id, change_label) x
        LEFT JOIN note_total t ON x.service_id = t.service_id AND x.object_id = t.object_id""",
    "change_rows": """
        SELECT * FROM object_row
        UNION ALL BY NAME SELECT * FROM note_line""",
    "flat": """
        SELECT service_id, object_id, note, amount,
               'Flat adjustment: ' || note || ' at a cost of ' || CAST(amount AS VARCHAR) AS change_table_note
        FROM (SELECT service_id, object_id, note,
                     CAST(COALESCE(SUM(amount), 0) AS DECIMAL(38,2)) AS amount
              FROM fx_flat WHERE include = 'Yes' GROUP BY service_id, object_id, note) f""",
    "flat_line": """
        SELECT f.service_id, f.object_id, COALESCE(t.note_lines, 0)
                 + ROW_NUMBER() OVER (PARTITION BY f.service_id, f.object_id ORDER BY f.note) AS note_no,
               f.change_table_note AS automated_notes
        FROM flat f LEFT JOIN note_total t ON f.service_id = t.service_id AND f.object_id = t.object_id
        WHERE EXISTS (SELECT 1 FROM summary s WHERE s.service_id = f.service_id AND s.object_id = f.object_id)""",
    "dense": """
        SELECT COALESCE(g.service_id, r.service_id) AS service_id,
               COALESCE(g.object_id, r.object_id) AS object_id, r.note_no, r.change_label,
               r.position_note, r.difference, r.note_cost, r.analyst_notes
        FROM grid g FULL JOIN change_rows r ON g.service_id = r.service_id AND g.object_id = r.object_id""",
    "sheet": """
        SELECT service_id, 0 AS section, CAST(NULL AS INT) AS object_id, 0 AS note_no, change_label,
               amount, NULL AS note_cost, CAST(NULL AS VARCHAR) AS automated_notes,
               CAST(NULL AS VARCHAR) AS analyst_notes
        FROM bookends WHERE change_label = 'FY23 Adopted Budget'
        UNION ALL
        SELECT service_id, 1, object_id, COALESCE(note_no, 0),
               CASE WHEN COALESCE(note_no, 0) = 0 THEN COALESCE(change_label, CASE object_id WHEN 0 THEN 'No Transfers' WHEN 1 THEN 'No Employee Costs'
                 WHEN 3 THEN 'No Contractual Services' WHEN 4 THEN 'No Materials and Supplies'
                 WHEN 5 THEN 'No Equipment < $5K' WHEN 6 THEN 'No Equipment > $5K'
                 WHEN 7 THEN 'No Grants, Subsidies or Contributions' WHEN 8 THEN 'No Debt Service'
                 WHEN 9 THEN 'No Capital Improvements' END) END,
               difference, note_cost, position_note, analyst_notes FROM dense
        UNION ALL
        SELECT service_id, 2, NULL, 0, change_label, amount, NULL, NULL, NULL
        FROM bookends WHERE change_label = 'FY24 CLS Budget'""",
    "agency_sheet": """
        SELECT s.service_id, a.agency_name, s.section, s.object_id AS object_order,
               CASE WHEN s.object_id = 1 THEN '1, 2' ELSE CAST(s.object_id AS VARCHAR) END AS object_id,
               s.note_no, s.change_label, s.amount, s.note_cost, s.automated_notes, s.analyst_notes
        FROM sheet s LEFT JOIN (SELECT DISTINCT agency_name, service_id FROM gf) a
          ON s.service_id = a.service_id""",
    # ------------------------------------------------------------ services and agencies
    "chosen_agencies": """
        SELECT DISTINCT CAST(agency_id AS VARCHAR) AS agency_id, agency_name, agency_clean,
               agency_short, analyst, operational
        FROM fx_assignment WHERE operational AND analyst IS NOT NULL""",
    "phase_lines": """
        SELECT p.agency_name, p.service_id, p.service_name, p.fund_id, p.fund_name, p.objective_name,
               p.prior_actual, p.adopted, c.cls, p.request
        FROM (SELECT agency_name, service_id, service_name, fund_id, fund_name, objective_name,
                     COALESCE(SUM(prior_actual), 0) AS prior_actual, COALESCE(SUM(adopted), 0) AS adopted,
                     COALESCE(SUM(request), 0) AS request
              FROM fx_expend_prop GROUP BY ALL) p
        LEFT JOIN (SELECT service_id, fund_id, objective_name, COALESCE(SUM(cls_amount), 0) AS cls
                   FROM fx_expend_cls GROUP BY ALL) c
          ON p.service_id = c.service_id AND p.fund_id = c.fund_id AND p.objective_name = c.objective_name""",
    "phase_count": """
        SELECT phase, agency_name, service_name, service_id, fund_name, COUNT(*) AS n
        FROM fx_pos_phase GROUP BY phase, agency_name, service_name, service_id, fund_name""",
    "phase_counts": """
        SELECT p.agency_name, p.service_name, p.service_id, p.fund_name, z.n AS prior_actual,
               a.n AS adopted, c.n AS cls, p.n AS request, '' AS objective_name, 'Positions' AS type
        FROM (SELECT * FROM phase_count WHERE phase = 'planning') p
        LEFT JOIN (SELECT * FROM phase_count WHERE phase = 'cls') c
          ON p.agency_name IS NOT DISTINCT FROM c.agency_name AND p.service_id = c.service_id AND p.fund_name = c.fund_name
        LEFT JOIN (SELECT * FROM phase_count WHERE phase = 'projection') a
          ON p.agency_name IS NOT DISTINCT FROM a.agency_name AND p.service_id = a.service_id AND p.fund_name = a.fund_name
        LEFT JOIN (SELECT * FROM phase_count WHERE phase = 'prior') z
          ON p.agency_name IS NOT DISTINCT FROM z.agency_name AND p.service_id = z.service_id AND p.fund_name = z.fund_name""",
    "svc_summary": """
        SELECT agency_name, service_name, service_id, type, fund_name, objective_name,
               SUM(COALESCE(prior_actual, 0)) AS prior_actual, SUM(COALESCE(adopted, 0)) AS adopted,
               SUM(COALESCE(cls, 0)) AS cls, SUM(COALESCE(request, 0)) AS request
        FROM (SELECT agency_name, service_name, service_id, 'Expenditures' AS type, fund_name, objective_name,
                     prior_actual, adopted, cls, request FROM phase_lines
              UNION ALL
              SELECT agency_name, service_name, service_id, type, fund_name, objective_name,
                     prior_actual, adopted, cls, request FROM phase_counts) u
        GROUP BY agency_name, service_name, service_id, type, fund_name, objective_name""",
    "drivers": """
        SELECT agency_name, service_id, service_name, fund_name, bucket,
               COALESCE(SUM(adopted), 0) AS adopted, COALESCE(SUM(cls), 0) AS cls,
               COALESCE(SUM(request), 0) AS request, COALESCE(SUM(cls - adopted), 0) AS diff
        FROM (SELECT p.*, c.cls,
                     CASE WHEN p.subobject_id IN ('101', '161', '162') THEN 'Permanent Wages Adjustment'
                          WHEN p.subobject_id IN ('204', '202', '203', '279') THEN 'Pension Adjustment'
                          WHEN p.subobject_id IN ('205', '285') THEN 'Healthcare Adjustment'
                          WHEN p.subobject_id IN ('335', '401', '331') THEN 'Fleet Adjustment'
                          WHEN p.subobject_id = '396' THEN 'Building Maintenance and Rental Charge Adjustment'
                          ELSE 'Other' END AS bucket
              FROM (SELECT agency_name, service_id, service_name, fund_id, fund_name, subobject_id,
                           COALESCE(SUM(adopted), 0) AS adopted, COALESCE(SUM(request), 0) AS request
                    FROM fx_expend_prop GROUP BY ALL) p
              LEFT JOIN (SELECT service_id, fund_id, subobject_id, COALESCE(SUM(cls_amount), 0) AS cls
                         FROM fx_expend_cls GROUP BY ALL) c
                ON p.service_id = c.service_id AND p.fund_id = c.fund_id AND p.subobject_id = c.subobject_id
              WHERE p.fund_name = 'General') j
        GROUP BY agency_name, service_id, service_name, fund_name, bucket
        HAVING COALESCE(SUM(cls - adopted), 0) <> 0""",
    "general_totals": """
        SELECT agency_name, service_id,
               COALESCE(SUM(adopted) FILTER (WHERE type = 'Expenditures' AND fund_name = 'General'), 0) AS adopted,
               COALESCE(SUM(cls) FILTER (WHERE type = 'Expenditures' AND fund_name = 'General'), 0) AS cls,
               COALESCE(SUM(request) FILTER (WHERE type = 'Expenditures' AND fund_name = 'General'), 0) AS request
        FROM svc_summary GROUP BY agency_name, service_id""",
    "driver_sums": "SELECT service_id, bucket, SUM(diff) AS diff FROM drivers GROUP BY service_id, bucket",
    "ladder_layout": """
        SELECT * FROM (VALUES (1,'FY2023 Adopted','adopted'),(2,'CLS Adjustments','cls'),
        (3,'Permanent Wages Adjustment','Permanent Wages Adjustment'),
        (4,'Updated Pension costs based on projected rate','Pension Adjustment'),
        (5,'Updated healthcare costs based on projected rate','Healthcare Adjustment'),
        (6,'All other benefit updates',''),(7,'Updated Fleet rate','Fleet Adjustment'),
        (8,'Updated Building/Maintenance/Rental Charges','Building Maintenance and Rental Charge Adjustment'),
        (9,'All other updates','Other'),(10,'Build-ins/Build-outs (please list)',''),(11,'',''),
        (12,'Request Adjustments','request'),(13,'',''),(14,'',''),(15,'TLS Adjustments','tls'),
        (16,'',''),(17,'',''),(18,'FinRec Adjustments','Pending'),(19,'',''),(20,'',''),
        (21,'BoE Adjustments','Pending'),(22,'',''),(23,'',''),(24,'Council Adjustments','Pending'),
        (25,'',''),(26,'',''),(27,'FY2024 Budget','Pending')) AS t(ladder_row, change_label, content)""",
    "ladder": """
        SELECT g.agency_name, g.service_id, l.ladder_row, l.change_label,
               CASE l.content WHEN 'adopted' THEN g.adopted WHEN 'cls' THEN g.cls
                    WHEN 'request' THEN g.request WHEN 'tls' THEN 0 WHEN '' THEN NULL
                    WHEN 'Pending' THEN NULL ELSE COALESCE(d.diff, 0) END AS amount,
               CASE WHEN l.content = 'Pending' THEN 'Pending' ELSE '' END AS status, '' AS decision
        FROM general_totals g CROSS JOIN ladder_layout l
        LEFT JOIN driver_sums d ON d.service_id = g.service_id AND d.bucket = l.content""",
    # ------------------------------------------------------------ completed sheets
    "keyed": """
        SELECT *, REGEXP_EXTRACT(file_path, '/FY24 Change Table (.+)\\.xlsx$', 1) AS agency,
               REGEXP_EXTRACT(sheet, '([0-9]{3,})', 1) AS service_id
        FROM fx_sheet_row WHERE REGEXP_MATCHES(sheet, '[0-9]{3}')
          AND REGEXP_MATCHES(file_path, '/FY24 Change Table .+\\.xlsx$')""",
    "whole_keyed": """
        SELECT *, REGEXP_EXTRACT(file_path, '/FY24 Change Table (.+)\\.xlsx$', 1) AS agency,
               REGEXP_EXTRACT(sheet, '([0-9]{3,})', 1) AS service_id
        FROM fx_whole_sheet_row WHERE REGEXP_MATCHES(sheet, '[0-9]{3}')
          AND REGEXP_MATCHES(file_path, '/FY24 Change Table .+\\.xlsx$')""",
    "sheet_totals": """
        SELECT file_path, sheet, row_no,
               ROW_NUMBER() OVER (PARTITION BY file_path, sheet ORDER BY row_no) AS nth
        FROM keyed WHERE recommendation = 'Total'""",
    "tech_block": """
        SELECT k.* FROM keyed k
        JOIN (SELECT file_path, sheet, MIN(row_no) AS lo FROM keyed
              WHERE recommendation = 'Technical Adjustments' GROUP BY file_path, sheet) a USING (file_path, sheet)
        JOIN (SELECT file_path, sheet, row_no AS hi FROM sheet_totals WHERE nth = 1) b USING (file_path, sheet)
        WHERE k.row_no BETWEEN a.lo AND b.hi""",
    "save_block": """
        SELECT k.* FROM keyed k
        JOIN (SELECT file_path, sheet, MIN(row_no) AS lo FROM keyed
              WHERE recommendation = 'Savings Ideas' GROUP BY file_path, sheet) a USING (file_path, sheet)
        JOIN (SELECT file_path, sheet, row_no AS hi FROM sheet_totals WHERE nth = 2) b USING (file_path, sheet)
        WHERE k.row_no BETWEEN a.lo AND b.hi""",
    "tech_entries": """
        SELECT service_id, agency, recommendation AS adjustment, c16 AS object, c17 AS subobject, c18 AS amount
        FROM tech_block WHERE recommendation IS NOT NULL
          AND recommendation NOT IN ('Enter item here', 'Technical Adjustments', 'Item', 'Total')""",
    "save_entries": """
        SELECT service_id, agency, recommendation AS adjustment, c16 AS object, c17 AS subobject, c18 AS amount
        FROM save_block WHERE recommendation IS NOT NULL
          AND recommendation NOT IN ('Enter item here', 'Savings Ideas', 'Item', 'Total')""",
    "lrows": """
        SELECT agency, service_id, row_no, change_label, c12 AS amount, c13 AS decision
        FROM keyed WHERE change_label IS NOT NULL""",
    "pillars": "SELECT DISTINCT service_id, service_name, objective_name FROM fx_expend_prop",
    "lpillar": """
        SELECT l.*, p.objective_name AS pillar, p.service_name AS service
        FROM lrows l LEFT JOIN pillars p ON CAST(l.service_id AS BIGINT) = p.service_id""",
    "book": """
        SELECT pillar, agency, service_id, row_no, change_label, TRY_CAST(amount AS DOUBLE) AS amount, decision
        FROM lpillar WHERE pillar IS NOT NULL AND amount <> 'Pending' AND change_label <> 'TLS Adjustments'""",
    "measures": """
        SELECT m.agency_clean, m.service_id, m.measure, p.service_name, p.objective_name
        FROM fx_measure m JOIN pillars p ON m.service_id = p.service_id""",
    # ------------------------------------------------------------ notes
    "notes": """
        SELECT REGEXP_EXTRACT(file_path, '/Change Table_(.+)\\.xlsx$', 1) AS agency_name,
               CAST(REGEXP_EXTRACT(sheet, '([0-9]{3,})', 1) AS BIGINT) AS service_id, object_id, analyst_notes
        FROM fx_note_row""",
}

_DOUBLE = {
    "gf": "amount_start amount_end",
    "detail": "amount_start amount_end diff",
    "summary": "amount_start amount_end diff",
    "bookends": "amount",
    "dense": "difference note_cost",
    "change_rows": "difference note_cost",
    "sheet": "amount note_cost",
    "agency_sheet": "amount note_cost",
    "note": "total_cost_diff",
    "pos_all_e": "salary total_cost opcs",
    "phase_lines": "prior_actual adopted cls request",
    "svc_summary": "prior_actual adopted cls request",
    "drivers": "adopted cls request diff",
    "ladder": "amount",
}
_RAW_COSTS = [f"{n}_{w}" for n in _COST_NAMES for w in ("start", "end")]
_ALL_COSTS = [f"{n}_{w}" for n in _COST_NAMES for w in ("start", "end", "diff")]
_RAW_TERMS = "created eliminated service_in service_out reclassified fund_out fund_in fund_non_gf"


def _as_doubles(columns: list[str]) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


def _all_of(term: str, columns: str | list[str] | None = None) -> str:
    names = _DOUBLE.get(term, "").split() if columns is None else columns
    replaced = f" REPLACE ({_as_doubles(list(names))})" if names else ""
    return f"SELECT *{replaced} FROM {term}"


def _rollup(type_: str, label: str, name: str) -> str:
    sums = ", ".join(
        f"CAST(SUM({c}) AS DOUBLE) AS {c}" for c in ("prior_actual", "adopted", "cls", "request")
    )
    return f"""
        SELECT agency_name, CASE WHEN GROUPING(label) = 1 THEN 'Total' ELSE label END AS {name},
               CAST(GROUPING(label) AS INT) AS is_total, {sums},
               CAST(SUM(request) - SUM(cls) AS DOUBLE) AS change
        FROM (SELECT *, {label} AS label FROM svc_summary WHERE type = '{type_}') x
        GROUP BY agency_name, ROLLUP(label)"""


_SERVICE_LABEL = "CAST(service_id AS VARCHAR) || ': ' || service_name"
_FUND_ORDER = (
    "CASE "
    + " ".join(f"WHEN fund_name = '{f}' THEN {i}" for i, f in enumerate(K.FUND_ORDER, start=1))
    + f" WHEN fund_name IS NULL THEN {len(K.FUND_ORDER) + 1} ELSE {len(K.FUND_ORDER) + 2} END"
)


def _heads(pairs: dict[str, str], cast: bool = False) -> str:
    if cast:
        return ", ".join(f'CAST({c} AS DOUBLE) AS "{h}"' for c, h in pairs.items())
    return ", ".join(f'{c} AS "{h}"' for c, h in pairs.items())


_LINE_DIMS = {
    "agency_id": "Agency ID", "agency_name": "Agency Name", "program_id": "Program ID",
    "program_name": "Program Name", "activity_id": "Activity ID", "activity_name": "Activity Name",
    "subactivity_id": "Subactivity ID", "subactivity_name": "Subactivity Name", "fund_id": "Fund ID",
    "fund_name": "Fund Name", "detailed_fund_id": "Detail Fund ID",
    "detailed_fund_name": "Detail Fund Name", "object_id": "Object ID", "object_name": "Object Name",
    "subobject_id": "Subobject ID", "subobject_name": "Subobject Name",
    "objective_id": "Objective ID", "objective_name": "Objective Name",
}
_LINE_PHASES = {
    "current_adopted": "FY22 Adopted", "cls_request": "FY23 CLS", "proposal1": "FY23 Proposal",
    "tls_request": "FY23 TLS", "finance_recommendation": "FY23 FinRec",
}
_EXP_DIMS = {
    c: "Agency" if c == "agency_name" else _LINE_DIMS[c]
    for c in ("agency_id", "agency_name", "program_id", "program_name", "activity_id", "activity_name",
              "fund_id", "fund_name", "object_id", "object_name", "subobject_id", "subobject_name")
}
_EXP_AMOUNTS = {
    "prior_adopted": "FY21 Adopted", "prior_actual": "FY21 Actual",
    "prior_ytd_actual": "FY21 YTD Actual", "curr_adopted": "FY22 Adopted",
    "carry_fwd_a": "Carry Forward - A", "carry_fwd_b": "Carry Forward - B",
    "carry_fwd_total": "Carry Forward - Total", "app_adj": "Appropriations Adjustments",
    "tot_budget": "Total Budget", **K.MONTHS, "ytd_exp": "YTD Exp",
    "tot_enc": "Total Encumbrance", "cur_acc": "Current Accrual",
}
_EXP_SUMS = {
    "prior_adopted": "FY21 Adopted", "prior_actual": "FY21 Actual",
    "prior_ytd_actual": "FY21 YTD Actual", "curr_adopted": "FY22 Adopted",
    "carry_fwd_a": "Carry Forward - A", "carry_fwd_b": "Carry Forward - B",
    "carry_fwd_total": "Carry Forward - Total", "app_adj": "AAO", "tot_budget": "Total Budget",
    "ytd_exp": "YTD Exp", "tot_enc": "Encumbrances", "total_spent": "Total Spent",
    "surp_def": "Surplus/Deficit",
}


def _sums(pairs: dict[str, str]) -> str:
    return ", ".join(f'CAST(SUM({c}) AS DOUBLE) AS "{h}"' for c, h in pairs.items())


def _wide_summary(fill: str) -> str:
    known = (1001, 2000, 4000, 5000, 6000, 7000)
    columns = ", ".join(
        (
            f"{fill}(SUM(CASE WHEN fund_id = {i} THEN tot_budget END){', 0' if fill else ''}) AS fund_{i}"
            if i in known
            else f"0 AS fund_{i}"
        )
        for i in K.SUMMARY_FUNDS
    )
    total = " + ".join(f"fund_{i}" for i in K.SUMMARY_FUNDS)
    heads = _heads({f"fund_{i}": h for i, h in K.SUMMARY_FUNDS.items()}, cast=True)
    return f"""
        SELECT agency_id AS "Agency ID", agency_name AS "Agency Name", program_id AS "Program ID",
               program_name AS "Program Name", {heads}, CAST({total} AS DOUBLE) AS "Total"
        FROM (SELECT agency_id, agency_name, program_id, program_name, {columns}
              FROM fx_cur_expend GROUP BY agency_id, agency_name, program_id, program_name) w
        WHERE {total} > 0"""


_PCT = "CASE WHEN amount_start <> 0 THEN CAST(diff AS DOUBLE) / CAST(amount_start AS DOUBLE) END"
_DETAIL = f"""
    SELECT * REPLACE ({_as_doubles("amount_start amount_end diff".split())}), {_PCT} AS pct_change,
           FORMAT('{{:,.1f}}', ({_PCT}) * 100) || '%' AS pct_change_text FROM detail"""


def _select_costs(term: str, columns: list[str]) -> str:
    return f"SELECT * REPLACE ({_as_doubles(columns)}) FROM {term}"


QUERIES: dict[str, str] = {
    "service_allow_list": """
        SELECT CAST(service_id AS VARCHAR) AS service_id
        FROM (SELECT DISTINCT agency_name, service_id FROM fx_budget_line)
        UNION ALL SELECT * FROM (VALUES ('833'), ('619'), ('168')) AS t(service_id)""",
    "general_fund_lines": _all_of("gf"),
    "object_detail": _DETAIL,
    "object_summary": _all_of("summary"),
    "significant_change": f"""
        SELECT *, CASE WHEN ABS(diff) > 5000 AND ABS(pct_change) >= 0.2 THEN 'Yes' ELSE 'No' END AS significant
        FROM ({_DETAIL}) d""",
    "budget_bookends": _all_of("bookends"),
    "object_service_grid": _all_of("grid"),
    "change_rows": _all_of("change_rows"),
    "change_rows_dense": _all_of("dense"),
    "change_sheet": _all_of("sheet"),
    "change_sheet_by_agency": _all_of("agency_sheet"),
    "active_services": "SELECT DISTINCT agency_name, service_id FROM agency_sheet WHERE amount <> 0",
    "position_clean": _all_of("pos_all_e"),
    "positions_created": _select_costs("created", _RAW_COSTS),
    "positions_eliminated": _select_costs("eliminated", _RAW_COSTS),
    "positions_service_in": _select_costs("service_in", _RAW_COSTS),
    "positions_service_out": _select_costs("service_out", _RAW_COSTS),
    "positions_reclassified": _select_costs("reclassified", _RAW_COSTS),
    "positions_fund_moves": _select_costs(
        "(SELECT * FROM fund_out UNION ALL SELECT * FROM fund_in UNION ALL SELECT * FROM fund_non_gf) f",
        _RAW_COSTS,
    ),
    "positions_fund_out": _select_costs("fund_out", _RAW_COSTS),
    "positions_fund_in": _select_costs("fund_in", _RAW_COSTS),
    "positions_fund_non_gf": _select_costs("fund_non_gf", _RAW_COSTS),
    "position_changes": _select_costs("changes", _ALL_COSTS),
    "position_sentences": _select_costs("sentences", _ALL_COSTS),
    "position_detail": f"""
        SELECT * EXCLUDE (rn, change_order) REPLACE (CAST(service_id AS BIGINT) AS service_id,
               {_as_doubles(_ALL_COSTS)})
        FROM (SELECT *, CASE WHEN change_num = 1 THEN 1 ELSE ROW_NUMBER() OVER (
                     PARTITION BY service_id, job_number, change, change_num = 1
                     ORDER BY change_order, agency_name, fund_name, class_name, type_order) END AS rn
              FROM sentences) t
        WHERE rn = 1
        UNION ALL BY NAME
        SELECT change_type, CAST(job_number AS VARCHAR) AS job_number, CAST(agency_id AS VARCHAR) AS agency_id,
               agency_name, service_id, service_name, CAST(fund_id AS VARCHAR) AS fund_id, fund_name,
               CAST(class_id AS VARCHAR) AS class_id, class_name, si_id, {_as_doubles(_RAW_COSTS)},
               8 AS type_order, REPLACE(change_multiple, 'transfer', 'Transfer') AS change
        FROM fund_non_gf""",
    "position_summary": f"""
        SELECT * REPLACE (CAST(service_id AS BIGINT) AS service_id, CAST(change_net AS BIGINT) AS change_net,
               {_as_doubles([c for c in _ALL_COSTS if c != "salary_start"])}) FROM pos_summary""",
    "position_note": _all_of("note"),
    "operational_agencies": _all_of("chosen_agencies"),
    "sheet_agencies": """
        SELECT DISTINCT CAST(agency_id AS VARCHAR) AS agency_id, agency_name, agency_clean, agency_short,
               analyst, operational FROM fx_assignment WHERE operational""",
    "phase_line_items": _all_of("phase_lines"),
    "phase_position_counts": _all_of("phase_counts"),
    "service_summary": _all_of("svc_summary"),
    "service_row_counts": """
        SELECT agency_name, service_id, COUNT(*) AS row_count FROM svc_summary GROUP BY agency_name, service_id""",
    "cost_drivers": _all_of("drivers"),
    "service_budget_table": f"""
        SELECT agency_name, service_id, service_name, type, fund_name, objective_name,
               {_as_doubles("prior_actual adopted cls request".split())}, 0 AS tls,
               CAST(request - cls AS DOUBLE) AS change,
               CASE WHEN request = 0 OR cls = 0 THEN NULL
                    ELSE ROUND_EVEN(CAST(request - cls AS DOUBLE) / CAST(cls AS DOUBLE) * 100, 1) END AS change_pct,
               {_FUND_ORDER} AS fund_order
        FROM svc_summary""",
    "general_fund_ladder": _all_of("ladder"),
    "agency_dollars_by_service": _rollup("Expenditures", _SERVICE_LABEL, "service"),
    "agency_positions_by_service": _rollup("Positions", _SERVICE_LABEL, "service"),
    "agency_dollars_by_fund": _rollup("Expenditures", "fund_name", "fund_name"),
    "service_cost_drivers": f"""
        SELECT agency_name, service_id, service_name, bucket,
               {", ".join(f"CAST(SUM({c}) AS DOUBLE) AS {c}" for c in "adopted cls request diff".split())}
        FROM drivers GROUP BY agency_name, service_id, service_name, bucket""",
    "sheet_keys": _all_of("whole_keyed"),
    "technical_block": _all_of("tech_block"),
    "savings_block": _all_of("save_block"),
    "technical_adjustments": _all_of("tech_entries"),
    "savings_ideas": _all_of("save_entries"),
    "service_coverage": "SELECT COUNT(DISTINCT service_id) AS services FROM save_entries",
    "ladder_rows": _all_of("lrows"),
    "pillar_map": _all_of("pillars"),
    "ladder_with_pillar": _all_of("lpillar"),
    "pillar_list": "SELECT DISTINCT pillar FROM lpillar WHERE pillar IS NOT NULL ORDER BY pillar",
    "pillar_book": _all_of("book"),
    "measures_by_pillar": _all_of("measures"),
    "line_detail": f"""
        SELECT {_heads(_LINE_DIMS)}, {_heads(_LINE_PHASES, cast=True)},
               CAST(change_vs_adopted AS DOUBLE) AS "$ - Change vs Adopted",
               FORMAT('{{:,.2f}}', perc_change_vs_adopted * 100) AS "% - Change vs Adopted", justification
        FROM fx_line_detail""",
    "line_summary": _wide_summary(""),
    "line_summary_from_lines": _wide_summary("COALESCE"),
    "opc_report": f"""
        SELECT job_number AS "JOB NUMBER", class_id AS "CLASSIFICATION ID", union_code AS "UNION ID",
               agency AS "AGENCY ID", program AS "PROGRAM ID", activity AS "ACTIVITY ID", fund AS "FUND ID",
               detailed_fund AS "DETAILED FUND ID", special_indicator AS "SI ID",
               adopted_position AS "ADOPTED", CAST(total_cost AS DOUBLE) AS "SALARY",
               {", ".join(f'CAST(opcs + {i} AS DOUBLE) AS "OSO {code}"' for i, code in enumerate(K.OPC_CODES))},
               CAST(total_cost AS DOUBLE) AS "TOTAL COST"
        FROM fx_opcs""",
    "expenditure_detail": f"""
        SELECT {_heads({f"a.{c}": h for c, h in _EXP_DIMS.items()})},
               {_heads({f"a.{c}": h for c, h in _EXP_AMOUNTS.items()}, cast=True)},
               c.text AS "Carry Forward Purpose", j.justification AS "Justification"
        FROM fx_cur_expend a
        LEFT JOIN fx_line_item_report j
          ON j.agency_id = a.agency_id AND j.program_id = a.program_id AND j.activity_id = a.activity_id
         AND j.fund_id = a.fund_id AND j.subobject_id = a.subobject_id
        LEFT JOIN fx_carry_fwd c
          ON a.agency_id = c.agency_id AND a.program_id = c.program_id AND a.activity_id = c.activity_id
         AND a.fund_id = c.fund_id AND a.object_id = c.object_id AND a.subobject_id = c.subobject_id""",
    "expenditure_by_agency_fund": f"""
        SELECT agency_id AS "Agency ID", agency_name AS "Agency Name", fund_id AS "Fund ID",
               fund_name AS "Fund Name", {_sums({
                   "current_adopted": "Total FY22 Adopted", "cls_request": "Total FY23 CLS",
                   "proposal1": "Total FY23 Proposal", "tls_request": "Total FY23 TLS"})}
        FROM fx_line_detail GROUP BY agency_id, agency_name, fund_id, fund_name""",
    "expenditure_summary": f"""
        SELECT agency_name AS "Agency", {_sums(_EXP_SUMS)},
               CAST(SUM(tot_budget - ytd_exp) AS DOUBLE) AS "Net Sur/Def"
        FROM fx_cur_expend GROUP BY agency_name""",
    "multi_phase_gf": f"""
        SELECT {", ".join(c for c in _LINE_DIMS if not c.startswith("objective"))},
               {_heads(_LINE_PHASES, cast=True)}, justification
        FROM fx_line_detail WHERE fund_id = 1001""",
    "analyst_notes": _all_of("notes"),
    "notes_gaps": """
        SELECT service_id, 'not in general fund' AS gap FROM (SELECT DISTINCT service_id FROM notes) n
        WHERE service_id NOT IN (SELECT service_id FROM gf WHERE amount_start > 0)
        UNION ALL
        SELECT service_id, 'missing from notes' AS gap FROM (SELECT DISTINCT service_id FROM notes) n
        WHERE service_id NOT IN (SELECT service_id FROM notes WHERE analyst_notes IS NOT NULL)""",
    "change_sheet_with_adjustments": """
        SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount, CAST(note_cost AS DOUBLE) AS note_cost) FROM agency_sheet
        UNION ALL BY NAME
        SELECT f.*  REPLACE (CASE WHEN f.object_id = 1 THEN '1, 2' ELSE CAST(f.object_id AS VARCHAR) END AS object_id),
               a.agency_name, 1 AS section, f.object_id AS object_order
        FROM flat_line f LEFT JOIN (SELECT DISTINCT agency_name, service_id FROM gf) a
          ON f.service_id = a.service_id""",
    "services_with_amounts": "SELECT DISTINCT agency_name, service_id FROM agency_sheet WHERE amount <> 0",
    "carry_forward_notes": """
        SELECT s.* REPLACE (CAST(s.amount AS DOUBLE) AS amount, CAST(s.note_cost AS DOUBLE) AS note_cost,
               COALESCE(n.note, s.analyst_notes) AS analyst_notes)
        FROM agency_sheet s
        LEFT JOIN (SELECT DISTINCT agency_name, service_id, object_id, analyst_notes AS note
                   FROM notes WHERE object_id IS NOT NULL AND analyst_notes IS NOT NULL) n
          ON s.agency_name = n.agency_name AND s.service_id = n.service_id AND s.object_id = n.object_id
         AND s.note_no = 0""",
    "flat_adjustments": "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM flat",
    "export_change_sheets": """
        SELECT s.* REPLACE (CAST(s.amount AS DOUBLE) AS amount, CAST(s.note_cost AS DOUBLE) AS note_cost), a.agency_short,
               REPLACE(s.agency_name, '&', 'and') AS agency
        FROM agency_sheet s
        JOIN (SELECT DISTINCT agency_name, agency_short FROM fx_assignment WHERE operational) a
          ON s.agency_name = a.agency_name
        WHERE EXISTS (SELECT 1 FROM agency_sheet t WHERE t.agency_name = s.agency_name
                      AND t.service_id = s.service_id AND t.amount <> 0)""",
    "export_service_ladders": """
        SELECT l.* REPLACE (CAST(l.amount AS DOUBLE) AS amount), a.agency_clean,
               REPLACE(l.agency_name, '&', 'and') AS agency
        FROM ladder l JOIN (SELECT DISTINCT agency_name, agency_clean FROM chosen_agencies) a
          ON l.agency_name = a.agency_name""",
    "export_pillar_book": _all_of("book"),
    "export_measures": "SELECT *, objective_name AS pillar FROM measures",
    "export_technical_adjustments": _all_of("tech_entries"),
    "prim_anti_join": """
        SELECT e.job_number, e.service_id FROM fx_pos_end e
        WHERE NOT EXISTS (SELECT 1 FROM fx_pos_start s WHERE s.job_number = e.job_number)""",
    "prim_full_outer": """
        SELECT COALESCE(c.service_id, p.service_id) AS service_id, c.cls_lines, p.request_lines
        FROM (SELECT service_id, COUNT(*) AS cls_lines FROM fx_expend_cls GROUP BY service_id) c
        FULL JOIN (SELECT service_id, COUNT(*) AS request_lines FROM fx_expend_prop GROUP BY service_id) p
          ON c.service_id = p.service_id""",
    "prim_unpivot": """
        SELECT service_id, object_id, 'amount_start' AS phase, CAST(amount_start AS DOUBLE) AS amount FROM fx_budget_line
        UNION ALL
        SELECT service_id, object_id, 'amount_end', CAST(amount_end AS DOUBLE) FROM fx_budget_line""",
    "prim_rollup": """
        SELECT CASE WHEN GROUPING(agency_name) = 1 THEN 'Total' ELSE agency_name END AS agency_name,
               CAST(COALESCE(SUM(amount_end), 0) AS DOUBLE) AS amount_end
        FROM fx_budget_line GROUP BY ROLLUP(agency_name)""",
    "prim_ordered_listagg": """
        SELECT service_id, STRING_AGG(object_name, '; ' ORDER BY object_name) AS objects
        FROM (SELECT DISTINCT service_id, object_name FROM fx_budget_line) d GROUP BY service_id""",
    "prim_first_per_key": """
        SELECT service_id, job_number, class_name, CAST(salary AS DOUBLE) AS salary FROM fx_pos_all_end
        QUALIFY ROW_NUMBER() OVER (PARTITION BY service_id ORDER BY salary DESC NULLS LAST, job_number) = 1""",
    "prim_bool_or": """
        SELECT service_id, COALESCE(BOOL_OR(amount_end <> 0), FALSE) AS has_budget
        FROM fx_budget_line GROUP BY service_id""",
    "prim_conditional_sum": """
        SELECT agency_name, CAST(SUM(amount_end) FILTER (WHERE fund_id = 1001) AS DOUBLE) AS general,
               CAST(SUM(amount_end) FILTER (WHERE fund_id <> 1001) AS DOUBLE) AS other
        FROM fx_budget_line GROUP BY agency_name""",
    "prim_null_safe_join": """
        SELECT s.agency_name, s.start_jobs, e.end_jobs
        FROM (SELECT agency_name, COUNT(*) AS start_jobs FROM fx_pos_all_start GROUP BY agency_name) s
        LEFT JOIN (SELECT agency_name, COUNT(*) AS end_jobs FROM fx_pos_all_end GROUP BY agency_name) e
          ON s.agency_name IS NOT DISTINCT FROM e.agency_name""",
    "prim_ordinal_sort": f"""
        SELECT fund_name, COUNT(*) AS lines, {_FUND_ORDER} AS fund_order
        FROM fx_budget_line GROUP BY fund_name ORDER BY fund_order, fund_name""",
    "prim_regexp_extract": """
        SELECT file_path, sheet, row_no, REGEXP_EXTRACT(file_path, 'Table (.+)\\.xlsx$', 1) AS agency,
               REGEXP_EXTRACT(sheet, '([0-9]{3,})', 1) AS service_id FROM fx_sheet_row""",
}


def _of_chosen_agencies(name: str) -> str:
    """A report of all agencies as it is written for those that get one."""
    return f"""
        SELECT l.*, a.agency_clean, REPLACE(l.agency_name, '&', 'and') AS agency
        FROM ({QUERIES[name]}) l JOIN (SELECT DISTINCT agency_name, agency_clean FROM chosen_agencies) a
          ON l.agency_name = a.agency_name"""


def _phase_sums(phases: dict[str, str]) -> str:
    return ", ".join(f'CAST(SUM({c}) AS DOUBLE) AS "{name}"' for c, name in phases.items())


QUERIES |= {
    "service_allow_list_from_files": QUERIES["service_allow_list"],
    "phase_amounts": f"""
        SELECT agency_name, program_id AS service_id, fund_name,
               {_phase_sums({"tls_request": "FY23 TLS", "current_adopted": "FY22 Adopted"})},
               CAST(COALESCE(SUM(tls_request), 0) - COALESCE(SUM(current_adopted), 0) AS DOUBLE) AS change
        FROM fx_line_detail GROUP BY agency_name, program_id, fund_name""",
    "phase_job_counts": """
        SELECT agency_name, service_id, fund_name, NULLIF(COUNT(*) FILTER (WHERE phase = 'prior'), 0) AS prior,
               COUNT(*) FILTER (WHERE phase = 'planning') AS planning
        FROM fx_pos_phase GROUP BY agency_name, service_id, fund_name
        HAVING COUNT(*) FILTER (WHERE phase = 'planning') > 0""",
    "phase_sequence_amounts": f"""
        SELECT fund_name, {_phase_sums({"cls_request": "FY23 CLS", "proposal1": "FY23 Proposal", "tls_request": "FY23 TLS"})}
        FROM fx_line_detail GROUP BY fund_name""",
    "export_change_sheets_by_service": QUERIES["export_change_sheets"],
    "export_full_change_sheet": QUERIES["change_sheet_by_agency"],
    "export_budget_tables": _of_chosen_agencies("service_budget_table"),
    "export_dollars_by_service": _of_chosen_agencies("agency_dollars_by_service"),
    "export_positions_by_service": _of_chosen_agencies("agency_positions_by_service"),
    "export_dollars_by_fund": _of_chosen_agencies("agency_dollars_by_fund"),
    "export_savings_ideas": _all_of("save_entries"),
    "line_summary_by_phase": f"""
        SELECT 'CLS' AS phase, * FROM ({QUERIES["line_summary"]}) c WHERE "Agency ID" <= 20
        UNION ALL
        SELECT 'TLS' AS phase, * REPLACE ({", ".join(f'"{n}" * 2 AS "{n}"' for n in [*K.SUMMARY_FUNDS.values(), "Total"])})
        FROM ({QUERIES["line_summary"]}) t WHERE "Agency ID" <= 20""",
    "expenditure_by_bound_table": QUERIES["expenditure_by_agency_fund"],
    "sheet_keys_from_files": """
        SELECT agency, service_id, COUNT(*) AS sheet_rows FROM keyed GROUP BY agency, service_id""",
    "sheet_rejects": """
        SELECT CONCAT('FY24 Change Table ', agency_name, '.xlsx') AS file_name, 'Agency Summary' AS sheet,
               'tab without a service number' AS reject, COUNT(*) AS skipped_rows FROM fx_service GROUP BY agency_name
        UNION ALL
        SELECT CONCAT('~$FY24 Change Table ', agency_name, '.xlsx'), s.sheet, 'lock file', COUNT(*)
        FROM fx_sheet_row s JOIN fx_service v ON s.file_path = CONCAT('/in/FY24 Change Table ', v.agency_name, '.xlsx')
         AND s.sheet = CASE WHEN v.service_id > 99 THEN CAST(v.service_id AS VARCHAR) ELSE LPAD(CAST(v.service_id AS VARCHAR), 3, '0') END
        WHERE v.service_id % 10 = 3 GROUP BY agency_name, s.sheet
        UNION ALL
        SELECT CONCAT('Notes ', agency_name, '.xlsx'), s.sheet, 'not a sheet file', COUNT(*)
        FROM fx_sheet_row s JOIN fx_service v ON s.file_path = CONCAT('/in/FY24 Change Table ', v.agency_name, '.xlsx')
         AND s.sheet = CASE WHEN v.service_id > 99 THEN CAST(v.service_id AS VARCHAR) ELSE LPAD(CAST(v.service_id AS VARCHAR), 3, '0') END
        WHERE v.service_id % 10 = 4 GROUP BY agency_name, s.sheet""",
    "snapshot_with_clashing_headers": """
        SELECT job_number, agency_id, UPPER(class_name) AS class_name, CAST(total_cost AS DOUBLE) AS total_cost
        FROM fx_pos_all_end""",
}


def with_terms(statement: str) -> str:
    """Prefix a statement with the terms it uses, directly or through other terms."""
    needed: set[str] = set()
    pending = [statement]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in TERMS.keys() & words - needed:
            needed.add(name)
            pending.append(TERMS[name])
    terms = ",\n".join(f"{name} AS ({TERMS[name]})" for name in TERMS if name in needed)
    return f"WITH {terms}\n{statement}" if terms else statement


def oracles() -> dict[str, str]:
    return {name: with_terms(sql) for name, sql in QUERIES.items()}
