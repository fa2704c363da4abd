"""Guards and runs: month replacement on ingest, dirty rows, training reads, scoring runs, null keys."""

import datetime

import pytest
from pyspark.sql import functions as F

from test_training import SETTINGS, build
from vintagewise import schemas as S
from vintagewise.functions import loans
from vintagewise.operators import history, joins, profile, splits
from vintagewise.operators.guards import ContractError
from vintagewise.plans import backfill, training
from vintagewise.streaming.ingest import ingest_available


def csv(folder, name, rows):
    folder.mkdir(exist_ok=True)
    head = ",".join(S.RAW_COLUMNS["clickstream"])
    body = [",".join([*["1"] * 20, customer, month]) for customer, month in rows]
    (folder / name).write_text("\n".join([head, *body]) + "\n")


def test_batch_and_stream_and_a_month_sent_again(spark, tmp_path):
    root, inbox = str(tmp_path / "mart"), tmp_path / "inbox"
    csv(tmp_path / "batch", "a.csv", [("A", "2024-01-01"), ("B", "2024-02-01")])
    backfill.build_bronze(spark, "clickstream", str(tmp_path / "batch"), root)
    csv(inbox, "b.csv", [("C", "2024-02-01"), ("D", "2024-03-01"), ("X", "not a date")])
    csv(inbox, "c.csv", [("E", "2024-03-01")])
    ingest_available(spark, "clickstream", str(inbox), root)
    ingest_available(spark, "clickstream", str(inbox), root)
    csv(tmp_path / "batch2", "d.csv", [("F", "2024-04-01")])
    backfill.build_bronze(spark, "clickstream", str(tmp_path / "batch2"), root)
    rows = backfill.read_bronze(spark, "clickstream", root).select("Customer_ID", F.col("snapshot_date").cast("string")).collect()
    assert sorted(map(tuple, rows)) == [("A", "2024-01-01"), ("C", "2024-02-01"), ("D", "2024-03-01"), ("E", "2024-03-01"), ("F", "2024-04-01")]
    assert spark.read.option("header", True).csv(f"{root}/bronze_violations/clickstream").count() == 1
    with pytest.raises(ContractError):
        backfill.build_silver(spark, "clickstream", root, "2024-03-01", "2024-05-01")


def test_huge_arrears_stay_bad_loans(spark):
    df = spark.createDataFrame([(9e6, 1e-4), (1e5, 1.0), (250.0, 100.0), (-9e6, 1e-4)], "o double, d double")
    rows = df.select("o", loans.installments_missed("o", "d").alias("m"), F.lit(datetime.date(2024, 3, 1)).alias("s"))
    dated = rows.withColumn("first", loans.first_missed_date("s", "m"))
    found = dated.withColumn("label", loans.delinquency_flag(loans.days_past_due("s", "first", "o"), 30))
    assert [tuple(r) for r in found.select("m", "first", "label").collect()] == [
        (2**31 - 1, datetime.date(124, 3, 1), 1), (100_000, datetime.date(124, 3, 1), 1),
        (3, datetime.date(2023, 12, 1), 1), (1 - 2**31, None, 0)]


def test_null_keys_and_groups(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    right = spark.createDataFrame([("a", 5), (None, 6), (None, 7)], "k string, w int")
    assert joins.left_join_unique(left, right, ["k"], "test").count() == 2
    df = spark.createDataFrame([(None, "x"), (None, "x"), (None, "y"), ("g", "x")], "g string, v string")
    assert {(r.g, r.v): r.share for r in profile.shares(df, "v", ["g"]).collect()} == {
        (None, "x"): pytest.approx(2 / 3), (None, "y"): pytest.approx(1 / 3), ("g", "x"): 1.0}
    figures = history.group_figures(left.unionByName(left), "k", "v")
    assert figures.count() == 4 and {r["size"] for r in figures.collect()} == {2}
    folded = splits.group_folds(left.withColumn("label", F.lit(1)), "k", "label", 2)
    assert folded.count() == 2


def test_latest_run_settles_ties(spark):
    df = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("a", "2", 2), (None, "1", 3)], "k string, inference_id string, v int")
    assert sorted(((r.k, r.v) for r in history.latest_run(df, ["k"]).collect()), key=str) == [("a", 2), (None, 3)]


def test_training_read_is_guarded(spark):
    labels, features = build(spark)
    with pytest.raises(ContractError, match="two feature rows"):
        training.training_rows(labels, features.union(features.where("loan_id = 'L5'")), "2024-03-01")
    with pytest.raises(ContractError, match="label months"):
        training.training_rows(labels.where("snapshot_date <> '2023-05-01'"), features, "2024-03-01")
    with pytest.raises(ContractError, match="feature months"):
        training.training_rows(labels, features.where("snapshot_date <> '2022-11-01'"), "2024-03-01")
    assert training.training_rows(labels, features, "2024-03-01").count() == labels.where("snapshot_date < '2024-03-01'").count()


def test_scoring_run_from_the_bank(spark, tmp_path):
    labels, features = build(spark)
    training.save_model(training.train(labels, features, "2024-03-01", SETTINGS), str(tmp_path / "bank"))
    later = features.withColumn("snapshot_date", F.to_date(F.lit("2024-04-01")))
    for _ in range(2):
        out = training.score_run(str(tmp_path / "bank"), later, "2024-04-01", str(tmp_path / "mart"))
    assert out.count() == 3000 and spark.read.parquet(str(tmp_path / "mart/predictions")).count() == 3000
    with pytest.raises(ContractError, match="no loans"):
        training.score_run(str(tmp_path / "bank"), later, "2024-05-01", str(tmp_path / "mart"))
    with pytest.raises(ContractError, match="no model"):
        training.score_run(str(tmp_path / "bank"), features, "2022-09-01", str(tmp_path / "mart"))
