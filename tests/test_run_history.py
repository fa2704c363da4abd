"""Saved monitoring runs read back: newest run per model and month, whatever else is there."""

import re

from pyspark.sql import functions as F

from vintagewise.operators import history
from vintagewise.plans import run_history
from vintagewise.sources import store


def save(spark, root, table, rows, schema):
    store.write_months(spark.createDataFrame(rows, schema).withColumn("snapshot_date", F.to_date("snapshot_date")), f"{root}/{table}", *run_history.RUN_KEYS)


METRICS = "model_name string, inference_id string, snapshot_date string, auc double, score_psi double, score_psi_vs_prev_month double, max_feature_psi double"
COVARIATES = "model_name string, inference_id string, snapshot_date string, feature string, psi double"


def test_newest_runs(spark, tmp_path, rows):
    root = str(tmp_path)
    save(spark, root, "metrics", [
        ("a", "run_9", "2024-01-01", 0.7, 0.1, None, 0.3), ("a", "run_10", "2024-01-01", None, 0.2, None, 0.4),
        ("a", "run_9", "2024-02-01", 0.8, 0.3, 0.1, 0.5), ("b", "x", "2024-01-01", float("nan"), 0.4, None, 0.6)], METRICS)
    assert rows(run_history.newest_runs(spark, f"{root}/metrics").withColumn("snapshot_date", F.col("snapshot_date").cast("string"))) == [
        ("a", "2024-01-01", "run_10"), ("a", "2024-02-01", "run_9"), ("b", "2024-01-01", "x")]
    assert rows(run_history.psi_history(spark, root), "model_name", "score_psi") == [("a", 0.2), ("a", 0.3), ("b", 0.4)]
    # the newest run that has an AUC counts, and a model never measured keeps its baseline
    registry = spark.createDataFrame([("a", 0.75), ("b", 0.6), ("c", None)], "model_name string, auc_oot double")
    found = run_history.auc_history(spark, root, registry).withColumn("snapshot_date", F.col("snapshot_date").cast("string"))
    assert rows(found) == [("a", "2024-01-01", 0.7, 0.75), ("a", "2024-02-01", 0.8, 0.75), ("b", None, None, 0.6), ("c", None, None, None)]


def test_a_rerun_hides_the_rows_it_no_longer_has(spark, tmp_path, rows):
    root = str(tmp_path)
    old = [("a", "r1", f"2024-0{m}-01", f, m * w) for m in (1, 2) for f, w in (("x", 0.1), ("y", 0.2), ("z", 0.01))]
    save(spark, root, "covariates", old, COVARIATES)
    save(spark, root, "covariates", [("a", "r2", "2024-02-01", "x", 0.05)], COVARIATES)
    newest = run_history.read_newest(spark, f"{root}/covariates")
    assert rows(newest, "inference_id", "feature") == [("r1", "x"), ("r1", "y"), ("r1", "z"), ("r2", "x")]
    assert rows(run_history.top_feature_psi(spark, root, 2), "feature", "psi") == [("x", 0.05), ("x", 0.1), ("y", 0.2)]


def test_runs_are_found_without_reading_columns_and_pruned(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    save(spark, root, "covariates", [("a", f"r{i}", "2024-01-01", "x", 0.1) for i in range(5)], COVARIATES)
    text = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in text(run_history.saved_runs(spark, f"{root}/covariates"))
    newest = run_history.read_newest(spark, f"{root}/covariates")
    assert re.search(r"PartitionFilters: \[\(?concat_ws", text(newest)) and [r.inference_id for r in newest.collect()] == ["r4"]
    monkeypatch.setattr(run_history, "LISTED_RUNS", 0)
    assert [r.inference_id for r in run_history.read_newest(spark, f"{root}/covariates").collect()] == ["r4"]


def test_newest_rows_hash_and_take_nulls(spark, rows):
    df = spark.createDataFrame(
        [("a", "2024-01-09T00:00:00", 1), ("a", "2024-01-10T00:00:00", 2), ("a", "2024-01-10T00:00:00", 3), (None, "none", 4), (None, None, 5),
         ("b", "none", 6)], "k string, inference_id string, v int")
    newest = history.newest_rows(df, ["k"])
    assert rows(newest, "v") == [(2,), (3,), (4,), (5,), (6,)]
    assert "SortAggregate" not in newest._jdf.queryExecution().executedPlan().toString()


def test_pivot_has_all_days(spark):
    df = spark.createDataFrame([("f", "2024-02-01", 1.0), ("f", "2024-02-29", 2.0), ("f", "2024-03-31", 3.0)], "feature string, d string, psi double")
    out = {str(r.month): r.asDict() for r in history.pivot_days(df.withColumn("d", F.to_date("d")), "feature", "d", "psi").collect()}
    assert len(out["2024-02-01"]) == 33 and out["2024-02-01"]["d29"] == 2.0 and out["2024-02-01"]["d30"] is None and out["2024-03-01"]["d31"] == 3.0
