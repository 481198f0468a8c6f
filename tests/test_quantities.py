"""Units and figures, the classifier on rows whose unit was hidden, pairs of agreeing facts."""

import pytest
from pyspark.sql import functions as F

from docquarry.operators import pairs, quantities

SF = "/root/testdata/sf0.01"
FACT = "fact_id bigint, firm string, year int, indicator_id string, value double, currency string, unit string, evidence string, extraction_method string"


@pytest.fixture(scope="module")
def book(spark):
    rows = [("CASH", "Tiền mặt", ["Tiền mặt", "cash held"], ["VND", "triệu đồng", "USD"], True), ("WATER", "Nước", ["water"], ["m3", "ML"], False), ("SH", "x", ["held shares"], ["shares", "million shares"], False)]
    ind = spark.createDataFrame(rows, "indicator_id string, label_vi string, aliases array<string>, unit_candidates array<string>, convert_to_vnd boolean")
    return ind, spark.createDataFrame([("USD", 2020, 20000.0)], "currency string, year int, vnd_per_unit double")


def amounts(spark, book, rows):
    df = spark.createDataFrame(rows, FACT).withColumn("amount_note", F.lit("kept"))
    return {r["fact_id"]: (r["amount"], r["unit_from"], r["status"]) for r in quantities.normalise_facts(df, *book).collect()}


def test_figures(spark):
    cases = {"1.234,56": 1234.56, "1,234.56": 1234.56, "12.345": 12345, "0.541": 0.541, "9.7103": 9.7103, "1.234.567": 1234567, "(2,5)": -2.5, "": None, "x": None, "12": 12}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r["t"]: r["v"] for r in df.select("t", quantities.parse_figure(F.col("t")).alias("v")).collect()} == cases


def test_units_and_defined_results(spark, book):
    rows = [
        (1, "A", 2020, "CASH", 5.0, "VND", "VND", "Tiền mặt: 5 triệu đồng", "text"),  # evidence prevails
        (2, "A", 2020, "CASH", 5.0, "VND", " TRIỆU ĐỒNG.", "cash held 5", "text"),
        (3, "A", 2020, "CASH", None, "VND", None, "(trieu dong) cash held (1.234,5)", "text"),
        (4, "A", 2020, "CASH", 2.0, "USD", "USD", "", "text"), (5, "A", 2019, "CASH", 2.0, "USD", "USD", "", "text"),  # no rate
        (6, "A", None, "WATER", 3.0, None, "ML", None, "table"), (7, "A", 2020, "WATER", None, None, "m3", "none", "table"),
        (8, "A", 2020, "SH", 7.0, None, "million shares", "held shares 7", "table"), (9, None, 2020, "OTHER", 1.0, None, "m3", "1 m3", None),
    ]
    got = amounts(spark, book, rows)
    assert got[1] == (5e6, "evidence", "converted") and got[2] == (5e6, "column", "converted") and got[3] == (-1234.5e6, "evidence", "converted")
    assert got[4][0] == 40000 and got[5][2] == "review" and got[6][0] == 3000 and got[7][2] == "review" and got[8] == (7e6, "column", "converted") and got[9][2] == "review"
    assert amounts(spark, book, []) == {}


def test_agreeing_pairs(spark, book):
    base = [(1, 100.0), (2, 100.9), (3, 102.0), (4, -100.0), (5, 0.0), (6, 0.0), (7, 100.0)]
    rows = [(i, "A", 2020, "CASH", v, "VND", "VND", "", "text") for i, v in base] + [(8, "A", None, "CASH", 100.0, "VND", "VND", "", "t"), (9, "B", 2020, "CASH", 100.0, "VND", "VND", "", "t")]
    got = quantities.agreeing_facts(spark.createDataFrame(rows, FACT), *book)
    assert {tuple(r) for r in got.collect()} == {(1, 2), (1, 7), (2, 7), (5, 6)}


def test_hidden_units_are_predicted(spark):
    f, ind, fx = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("financial_facts", "financial_indicators", "fx_rates"))
    gone = F.pmod(F.xxhash64("fact_id", F.lit(3)), F.lit(8)) == 0
    hidden = f.withColumns({"unit": F.when(~gone, F.col("unit")), "evidence": F.when(~gone, F.col("evidence")).otherwise("")})
    truth = quantities.normalise_facts(f, ind, fx).select("fact_id", F.col("amount").alias("true"))
    got = quantities.normalise_facts(hidden, ind, fx).where("unit_from = 'predicted'").join(truth, "fact_id").where("true IS NOT NULL").toPandas()
    right = (abs(got["amount"] - got["true"]) <= 0.01 * abs(got["true"])).mean()
    assert len(got) >= 10 and right >= 0.8


def test_expansion_keeps_large_classes_small(spark):
    members = spark.createDataFrame([(1, i) for i in range(1, 101)] + [(200, 200), (201, 201), (201, 202)], "cls bigint, id bigint")
    links = spark.createDataFrame([(1, 200), (200, 201)], "a bigint, b bigint")
    got = {tuple(r) for r in pairs.expand_pairs(links, members).collect()}
    assert {(1, i) for i in range(2, 101)} | {(1, 200), (200, 201), (200, 202), (201, 202)} == got


def test_only_true_copies_become_a_star(spark):
    members = spark.createDataFrame([(0, str(i), i) for i in range(70)] + [(100, "x", 100 + i) for i in range(70)], "cls bigint, copy string, id bigint")
    links = spark.createDataFrame([(0, 100)], "a bigint, b bigint")
    got = {tuple(r) for r in pairs.expand_pairs(links, members).collect()}
    differing = {(i, j) for i in range(70) for j in range(i + 1, 70)}
    assert got == differing | {(i, 100) for i in range(70)} | {(100, 100 + i) for i in range(1, 70)}
