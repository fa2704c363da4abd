from datetime import date

import pytest
from pyspark.sql import functions as F

from vintagewise.functions import calendar as K
from vintagewise.functions import clean as C
from vintagewise.functions import derive as D
from vintagewise.functions import loans as L
from vintagewise.plans import silver


def one(spark, value, kind, expr):
    return [r[0] for r in spark.createDataFrame([(v,) for v in value], f"x {kind}").select(expr).collect()]


def test_limits_are_inclusive_and_keep_nulls(spark):
    assert one(spark, [-1, 0, 10, 11, None], "int", C.keep_between("x", 0, 10)) == [None, 0, 10, None, None]
    assert one(spark, [-5, 10, 11], "int", C.keep_between("x", None, 10)) == [-5, 10, None]
    assert one(spark, [-1, 99], "int", C.keep_between("x", 0, None)) == [None, 99]


def test_age_takes_first_two_digits(spark):
    assert one(spark, ["23", "-500", "100_", "", None], "string", C.leading_digits("x")) == [23, 50, 10, None, None]


def test_stripping(spark):
    assert one(spark, ["12_3_", "abc", "3.0", "3.7", None], "string", C.to_int(C.strip_all("x"))) == [123, None, 3, 3, None]
    edge = F.round(C.to_double(C.strip_edges("x")), 2)
    assert one(spark, ["__45.678__", " _1_2_ ", "5"], "string", edge) == [45.68, None, 5.0]


def test_int_out_of_range_is_null(spark):
    assert one(spark, ["3000000000", "-1"], "string", C.to_int("x")) == [None, -1]


def test_durations(spark):
    assert one(spark, ["7 Years and 3 Months", "7 Years", None, "NA"], "string", C.duration_months("x")) == [87, None, None, None]


def test_sentinels_lists_and_patterns(spark):
    assert one(spark, ["_", "a", None], "string", C.null_sentinels("x", "_")) == [None, "a", None]
    assert one(spark, ["Yes", "NM", None], "string", C.keep_listed("x", "Yes", "No")) == ["Yes", None, None]
    assert one(spark, ["123-45-6789", "123-45-67890", "x"], "string", C.keep_matching("x", r"^\d{3}-\d{2}-\d{4}$")) == [
        "123-45-6789", None, None]


def test_valid_scores_and_labels(spark):
    scores = [0.0, 1.0, 1.5, -0.1, float("nan"), float("inf"), None]
    assert one(spark, scores, "double", C.valid_score("x")) == [0.0, 1.0, None, None, None, None, None]
    assert one(spark, [0.0, 1.0, 2.0, float("nan")], "double", C.valid_label("x")) == [0, 1, None, None]
    assert one(spark, [float("inf"), float("nan"), 2.0], "double", C.finite("x")) == [None, None, 2.0]
    assert one(spark, [-3.0, 0.5, 9.0, None], "double", C.clip("x", F.lit(0.0), F.lit(1.0))) == [0.0, 0.5, 1.0, None]


@pytest.mark.parametrize("overdue, due, missed, dpd, label", [
    (0.0, 100.0, 0, 0, 0), (50.0, 100.0, 1, 29, 0), (100.0, 100.0, 1, 29, 0), (101.0, 100.0, 2, 60, 1),
    (10.0, 0.0, 0, None, 0), (10.0, None, 0, None, 0)])
def test_days_past_due(spark, overdue, due, missed, dpd, label):
    raw = spark.createDataFrame(
        [("l", "c", "2023-09-01", "10", "6", 1000.0, due, 0.0, overdue, 0.0, "2024-03-01")],
        "loan_id string, Customer_ID string, loan_start_date string, tenure string, installment_num string, loan_amt double,"
        "due_amt double, paid_amt double, overdue_amt double, balance double, snapshot_date string")
    row = silver.loans(raw).withColumn("label", L.delinquency_flag("dpd", 30)).first()
    assert (row.installments_missed, row.dpd, row.label, row.mob) == (missed, dpd, label, 6)
    assert row.due_amt == (due or 0.0)
    if missed == 0:
        assert row.first_missed_date is None


def test_exact_multiples_do_not_round_up(spark):
    pairs = [(d * k / 100, d / 100, k) for d in (3333, 1999, 10001, 7) for k in range(1, 13)]
    df = spark.createDataFrame([(o, d, k) for o, d, k in pairs], "o double, d double, k int")
    assert df.where(L.installments_missed("o", "d") != F.col("k")).count() == 0


def test_bands_groups_and_flags(spark):
    cuts = ([(30, "Low"), (40, "Medium")], "High")
    assert one(spark, [29.99, 30.0, 39.99, 40.0, None], "double", D.band("x", *cuts)) == ["Low", "Medium", "Medium", "High", None]
    groups = {"A": ["a"], "B": ["b", "c"]}
    assert one(spark, ["a", "c", "z", None], "string", D.grouped("x", groups, "Unknown")) == ["A", "B", "Unknown", "Unknown"]
    assert one(spark, [1.0, 0.0, None], "double", D.positive_flag("x")) == [1, 0, 0]


def test_ratio_needs_positive_denominator(spark):
    assert one(spark, [2.0, 0.0, -1.0, None], "double", D.ratio(F.lit(1.0), "x")) == [0.5, None, None, None]


def test_row_vector(spark):
    df = spark.createDataFrame([(3.0, 4.0), (3.0, None)], "a double, b double")
    assert [tuple(r) for r in df.select(D.row_mean(["a", "b"]), D.row_norm(["a", "b"])).collect()] == [(3.5, 5.0), (None, None)]


def test_distinct_items(spark):
    values = ["Auto Loan, Personal Loan, and Auto Loan", "No Loan", "Home Loan", None, "", " a ,, and b,a,", "a and b"]
    assert one(spark, values, "string", D.distinct_items("x")) == [2, 0, 1, None, 0, 2, 1]


def test_loan_id_parts_and_run_id(spark):
    assert one(spark, ["7_CUS_0x1f_2024_03_01", "x"], "string", D.loan_customer("x")) == ["CUS_0x1f", None]
    assert one(spark, ["7_CUS_0x1f_2024_03_01", "x"], "string", D.loan_date("x")) == [date(2024, 3, 1), None]
    assert one(spark, ["/a/metrics_2024_03_01_run_7.parquet"], "string", D.run_id("x")) == ["run_7"]


def test_calendar(spark):
    windows = K.training_windows("2024-09-01")
    row = spark.range(1).select([c.alias(n) for n, c in windows.items()]).first().asDict()
    assert row == {"train_start": date(2023, 7, 1), "train_end": date(2024, 6, 30),
                   "oot_start": date(2024, 7, 1), "oot_end": date(2024, 8, 31)}
    cohort = spark.range(1).select(
        K.performance_cohort("2024-09-01", "2024-09-01"), K.performance_cohort("2024-08-01", "2024-09-01"),
        K.calendar_months(K.date_lit("2024-03-01"), K.date_lit("2023-12-31")), K.origination_month(K.date_lit("2024-03-01"), 6))
    assert tuple(cohort.first()) == (date(2024, 3, 1), None, 3, "2023-09")
    names = one(spark, ["credit_model_2024_09_01", "other"], "string", K.train_date_of("x", fallback=K.date_lit("2020-01-01")))
    assert names == [date(2024, 9, 1), date(2020, 1, 1)]


def test_attributes_and_clicks(spark):
    raw = spark.createDataFrame([("c", "n", "-500", "123-45-6789", "_______", "2024-01-01")],
                                "Customer_ID string, Name string, Age string, SSN string, Occupation string, snapshot_date string")
    row = silver.attributes(raw).first()
    assert (row.Age, row.SSN, row.Occupation, row.snapshot_date) == (50, "123-45-6789", None, date(2024, 1, 1))
    clicks = spark.createDataFrame([("3.0", "x", "c", "2024-01-01")], "fe_1 string, fe_2 string, Customer_ID string, snapshot_date string")
    assert tuple(silver.clickstream(clicks).first()) == (3, None, "c", date(2024, 1, 1))
