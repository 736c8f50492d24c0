from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from phasediff.plans import narrative as N
from phasediff.plans import positions as P
from phasediff.schema import POSITION

FUNDS = {1001: "General", 4000: "Federal", 5000: "State"}


def job(number, service=1, fund=1001, cls=(5, "Clerk"), agency=(1, "Parks"), salary=100, total=120):
    return (
        number, agency[0], agency[1], service, f"S{service}", fund, FUNDS[fund], cls[0], cls[1], "0",
        None if salary is None else D(salary), None if total is None else D(total),
    )


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), POSITION)


ANALYST, SENIOR = (1, "Analyst"), (4, "Manager, Senior")


def sentences(spark, start, end):
    return N.position_sentences(frame(spark, *start), frame(spark, *end))


def told(spark, start, end):
    rows = sentences(spark, start, end).orderBy("job_number", "type_order").collect()
    return [(r.change_type, r.change_num, r.change_order, r.change) for r in rows]


def test_clean_fills_numbers_and_drops_cost_codes(spark):
    df = frame(spark, job(1, salary=None, agency=(None, None))).withColumn("oso_201", F.lit(1))
    row = P.position_clean(df).first()
    assert "oso_201" not in row.asDict()
    assert (row.agency_id, row.agency_name, row.salary, row.opcs) == (0, None, 0, 120)


def test_unchanged_job_has_no_change(spark):
    assert told(spark, [job(1)], [job(1, salary=999)]) == []


def test_create_is_general_only_and_eliminate_is_not(spark):
    start, end = [job(1, fund=4000), job(2)], [job(3, fund=4000), job(4)]
    assert told(spark, start, end) == [
        ("eliminate", 1, 1, "Eliminate XX Clerk position"),
        ("eliminate", 1, 1, "Eliminate XX Clerk position"),
        ("create", 1, 1, "Create XX Clerk position"),
    ]


def test_service_move_lands_on_both_services(spark):
    rows = sentences(spark, [job(1, service=5)], [job(1, service=6)]).collect()
    by_type = {r.change_type: r for r in rows}
    inbound, outbound = by_type["service_from"], by_type["service_to"]
    assert inbound.service_id == "6" and outbound.service_id == "5"
    assert inbound.change == "Transfer XX Clerk position from Service 5: S5"
    assert outbound.change == "Transfer XX Clerk position to Service 6: S6"
    assert (inbound.total_cost_start, inbound.total_cost_diff) == (0, 120)
    assert (outbound.total_cost_end, outbound.total_cost_diff) == (0, -120)


def test_service_move_with_reclassification(spark):
    found = told(spark, [job(1, service=5)], [job(1, service=6, cls=ANALYST)])
    text = "Transfer XX Clerk position from Service 5: S5 and reclassify to Analyst"
    assert ("service_from", 2, 1, text) in found and ("reclass_to", 2, 2, text) in found


def test_second_transfer_is_not_repeated(spark):
    found = told(spark, [job(1, service=5, fund=4000)], [job(1, service=6)])
    text = "Transfer XX Clerk position from Service 5: S5 and  from Federal Fund to General Fund"
    assert ("fund_from", 2, 2, text) in found


def test_three_changes_in_one_sentence(spark):
    found = told(spark, [job(1, service=5, fund=4000)], [job(1, service=6, cls=ANALYST)])
    text = (
        "Transfer XX Clerk position from Service 5: S5,  from Federal Fund to General Fund, "
        "and reclassify to Analyst"
    )
    assert [f for f in found if f[1] == 3] == [
        ("service_from", 3, 1, text),
        ("fund_from", 3, 2, text),
        ("reclass_to", 3, 3, text),
    ]


def test_service_and_fund_move_has_two_outflows(spark):
    rows = sentences(spark, [job(1, service=5)], [job(1, service=6, fund=4000)]).collect()
    assert sorted(r.change_type for r in rows if r.change_net == -1) == ["fund_to", "service_to"]
    out = next(r for r in rows if r.change_type == "fund_to")
    assert (out.service_id, out.fund_id) == ("6", "1001")
    assert out.change == "Transfer XX Clerk position to Federal Fund from General Fund"


def test_comma_in_a_class_name_stays(spark):
    assert told(spark, [], [job(1, cls=SENIOR)])[0][3] == "Create XX Manager, Senior position"


def test_move_between_other_funds_only_shows_in_the_detail(spark):
    start, end = frame(spark, job(1, fund=4000)), frame(spark, job(1, fund=5000))
    changes = N.position_sentences(start, end)
    detail = N.position_detail(changes, N.fund_moves_elsewhere(start, end))
    assert changes.count() == 0
    row = detail.first()
    assert (row.change_type, row.change) == ("fund_non_gf", " Transfer from Federal Fund to State Fund")
    assert row.change_num is None and row.total_cost_diff is None and row.service_id == 1


def test_detail_of_one_join_equals_the_two_parts(fx):
    parts = N.position_detail(
        N.position_sentences(fx.pos_start, fx.pos_end), N.fund_moves_elsewhere(fx.pos_start, fx.pos_end)
    )
    whole = N.full_position_detail(fx.pos_start, fx.pos_end).select(*parts.columns)
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))


def test_detail_keeps_one_row_per_sentence(spark):
    start, end = frame(spark, job(1, service=5)), frame(spark, job(1, service=6, cls=ANALYST))
    detail = N.position_detail(
        N.position_sentences(start, end), N.fund_moves_elsewhere(start, end)
    ).collect()
    assert sorted(r.change_type for r in detail) == ["service_from", "service_to"]


def test_summary_counts_jobs_and_spells_plurals(spark):
    end = [job(1), job(2), job(3), job(4, cls=ANALYST)]
    rows = N.position_summary(sentences(spark, [], end)).collect()
    assert {(r.change, r.num_positions, r.change_net) for r in rows} == {
        ("Create 3 Clerk positions", 3, 3),
        ("Create Analyst position", 1, 1),
    }


def test_merged_changes_count_the_job_once(spark):
    rows = N.position_summary(
        sentences(spark, [job(1, service=5)], [job(1, service=6, cls=ANALYST)])
    ).collect()
    merged = next(r for r in rows if r.change_num == 2)
    assert merged.num_positions == 1 and merged.change.startswith("Transfer Clerk position")


def test_summary_drops_rows_without_an_agency_but_counts_them(spark):
    rows = N.position_summary(sentences(spark, [], [job(1), job(2, agency=(None, None))])).collect()
    assert [(r.agency_name, r.change) for r in rows] == [("Parks", "Create 2 Clerk positions")]


def test_note_has_the_general_sentences_in_key_order(spark):
    start = [job(9, fund=4000)]
    end = [job(1), job(2, cls=ANALYST), job(3, cls=ANALYST)]
    rows = N.position_note(N.position_summary(sentences(spark, start, end))).orderBy("note_no").collect()
    assert [(r.note_no, r.position_note, r.object_id, r.total_cost_diff) for r in rows] == [
        (1, "Create 2 Analyst positions", 1, 240),
        (2, "Create Clerk position", 1, 120),
    ]


def test_long_note_does_not_depend_on_partitions(spark):
    """One service with a note of over a million characters and nearly all sentences of the table."""
    n, word = 8000, "x" * 150
    summary = spark.range(n).selectExpr(
        f"IF(id % 20 = 0, id, 1) AS service_id", "'General' AS fund_name", "'1' AS agency_id", "'Parks' AS agency_name",
        "'S' AS service_name", "CAST(id % 7 AS STRING) AS class_id", "'c' AS class_name", "CAST(NULL AS STRING) AS si_id",
        f"concat('{word}', lpad(pmod(id * 7919, {n}), 5, '0')) AS sentence", "1 AS change_num", "concat('say ', sentence) AS change",
        "CAST(1 AS DECIMAL(38,2)) AS total_cost_diff",
    )
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": None}
    before = {k: spark.conf.get(k) for k in conf}
    found = []
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for partitions in (1, 200):
            spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
            found.append(sorted(N.position_note(summary.repartition(5)).collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found[0] == found[1] and len(found[0]) == n
    hot = [r for r in found[0] if r.service_id == 1]
    assert [r.note_no for r in hot] == list(range(1, len(hot) + 1))
    keys = summary.filter("service_id = 1").orderBy("class_id", "sentence").select("change").collect()
    assert [r.position_note for r in hot] == [k.change for k in keys]
    assert sum(len(r.position_note) for r in hot) > 1_000_000


@pytest.mark.parametrize("bad", [[job(1), job(1)], [job(None)]])
def test_missing_or_repeated_job_number_fails(spark, bad):
    with pytest.raises(Exception, match="job_number must be present and unique"):
        P.position_changes(frame(spark, *bad), frame(spark, job(2))).collect()


def test_every_job_is_in_exactly_one_set(fx):
    jobs = P.job_diff(fx.pos_start, fx.pos_end).selectExpr(
        "count(1) AS n",
        "count_if(s_job_number IS NULL) AS only_end",
        "count_if(e_job_number IS NULL) AS only_start",
        "count_if(s_job_number = e_job_number) AS in_both",
    ).first()
    assert jobs.n == jobs.only_end + jobs.only_start + jobs.in_both
    assert jobs.only_start + jobs.in_both == fx.pos_start.count()


def test_single_operators_stack_up_to_all_changes(fx):
    pairs = P.position_pairs(fx.pos_start, fx.pos_end)
    moves = P.positions_fund_moves(pairs)
    stacked = [
        P.positions_created(fx.pos_start, fx.pos_end),
        P.positions_eliminated(fx.pos_start, fx.pos_end),
        P.positions_service_in(pairs),
        P.positions_service_out(pairs),
        P.positions_reclassified(pairs),
        P.positions_fund_out(moves),
        P.positions_fund_in(moves),
    ]
    whole = P.position_changes(fx.pos_start, fx.pos_end)
    columns = ["change_type", "job_number", "service_name", "fund_name", "change_single"]
    expected = sorted(
        str(tuple(r)) for df in stacked for r in df.selectExpr(*columns).collect()
    )
    found = whole.selectExpr(*[c if c != "job_number" else "CAST(job_number AS BIGINT)" for c in columns])
    assert sorted(str(tuple(r)) for r in found.collect()) == expected
