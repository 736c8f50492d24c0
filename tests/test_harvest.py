from phasediff.plans import harvest, notes

ROWS = (
    "file_path string, sheet string, row_no int, change_label string, c12 string, c13 string, "
    "recommendation string, c16 string, c17 string, c18 string"
)
PARKS = "/in/FY24 Change Table Parks & Rec.xlsx"


def sheet(spark, *texts, tab="012", path=PARKS):
    rows = [(path, tab, i, None, None, None, t, "3", "318", "500") for i, t in enumerate(texts, 1)]
    return spark.createDataFrame(rows, ROWS)


FULL = ("Technical Adjustments", "Item", "a", None, "Total", "Savings Ideas", "Item", "b", "Total", "Total")


def test_keys_come_from_path_and_tab(spark):
    df = sheet(spark, "x").union(sheet(spark, "x", tab="Agency Summary")).union(
        sheet(spark, "x", path="/in/~$FY24 Notes.xlsx")
    )
    rows = harvest.sheet_keys(df).collect()
    assert [(r.agency, r.service_id) for r in rows] == [("Parks & Rec", "012")]


def test_blocks_end_at_their_total(spark):
    df = sheet(spark, *FULL)
    assert [r.row_no for r in harvest.technical_block(df).orderBy("row_no").collect()] == [1, 2, 3, 4, 5]
    assert [r.row_no for r in harvest.savings_block(df).orderBy("row_no").collect()] == [6, 7, 8, 9]
    adjusted = harvest.technical_adjustments(harvest.technical_block(df)).collect()
    assert [(r.service_id, r.agency, r.adjustment) for r in adjusted] == [("012", "Parks & Rec", "a")]


def test_sheet_with_one_total_has_no_savings(spark):
    df = sheet(spark, "Technical Adjustments", "a", "Total", "Savings Ideas", "b")
    assert harvest.savings_block(df).count() == 0
    assert harvest.technical_block(df).count() == 3


def test_one_source_with_most_rows_stays_whole(spark):
    """A sheet of many rows and many totals: the block ends at the right one, with all rows."""
    big = ["Technical Adjustments", *["entry"] * 2000, "Total", *["Total"] * 500]
    df = sheet(spark, *big).union(sheet(spark, *FULL, tab="013"))
    entries = harvest.technical_adjustments(harvest.technical_block(df))
    counts = {r.service_id: r["count"] for r in entries.groupBy("service_id").count().collect()}
    assert counts == {"012": 2000, "013": 1}


def test_pillar_book_drops_pending_and_keeps_text_rows_without_number(spark):
    df = spark.createDataFrame(
        [
            ("Youth", "Parks", "012", 1, "Adjustments", "Amount", None),
            ("Youth", "Parks", "012", 2, "CLS Adjustments", "1200.5", None),
            ("Youth", "Parks", "012", 3, "TLS Adjustments", "7", None),
            ("Youth", "Parks", "012", 4, "FinRec Adjustments", "Pending", None),
            ("Youth", "Parks", "012", 5, "Blank", None, None),
            (None, "Parks", "013", 1, "CLS Adjustments", "3", None),
        ],
        "pillar string, agency string, service_id string, row_no int, change_label string, "
        "amount string, decision string",
    )
    rows = {r.row_no: r.amount for r in harvest.pillar_book(df).collect()}
    assert rows == {1: None, 2: 1200.5}
    assert [r.pillar for r in harvest.pillar_list(df).collect()] == ["Youth"]


def test_measures_without_pillar_drop_and_agency_comes_first(spark):
    measures = spark.createDataFrame(
        [("m1", 1, "Parks", "x"), ("m2", 9, "Parks", "x")],
        "measure string, service_id bigint, agency_clean string, extra_pm_table string",
    )
    pillars = spark.createDataFrame(
        [(1, "S1", "Youth")], "service_id bigint, service_name string, objective_name string"
    )
    df = harvest.measures_by_pillar(measures, pillars)
    assert df.columns[:2] == ["agency_clean", "service_id"] and "extra_pm_table" not in df.columns
    assert [r.measure for r in df.collect()] == ["m1"]


def test_every_different_earlier_note_has_a_row(spark):
    sheet_rows = spark.createDataFrame(
        [("Parks", 1, "3", ""), ("Parks", 1, None, None), ("Parks", 2, "3", "own")],
        "agency_name string, service_id bigint, object_id string, analyst_notes string",
    )
    earlier = spark.createDataFrame(
        [("Parks", 1, "3", "a"), ("Parks", 1, "3", "b"), ("Parks", 1, "3", "b"), ("Parks", 1, None, "x"), ("Parks", 2, "3", None)],
        "agency_name string, service_id bigint, object_id string, analyst_notes string",
    )
    found = sorted(map(tuple, notes.carry_forward_notes(sheet_rows, earlier).collect()), key=str)
    assert found == sorted(
        [("Parks", 1, "3", "a"), ("Parks", 1, "3", "b"), ("Parks", 1, None, None), ("Parks", 2, "3", "own")], key=str
    )


def test_flat_adjustment_sentence(spark):
    df = spark.createDataFrame(
        [(1, 3, "Yes", "lease", 100), (1, 3, "Yes", "lease", 50), (1, 3, "No", "lease", 9)],
        "service_id bigint, object_id int, include string, note string, amount int",
    ).selectExpr("service_id", "object_id", "include", "note", "CAST(amount AS DECIMAL(18,2)) AS amount")
    rows = notes.flat_adjustments(df).collect()
    assert [r.change_table_note for r in rows] == ["Flat adjustment: lease at a cost of 150.00"]


def test_notes_gaps(spark):
    def services(*ids):
        return spark.createDataFrame([(i,) for i in ids], "service_id bigint")

    gaps = notes.notes_gaps(services(1), services(1, 2, 3), services(1, 2))
    assert sorted(map(tuple, gaps.collect())) == [
        (2, "missing from notes"), (3, "missing from notes"), (3, "not in general fund"),
    ]


def test_phase_sequence():
    assert notes.phase_sequence((24, "TLS"), (24, "BoE")) == ["FY24 TLS", "FY24 FinRec", "FY24 BoE"]
