import math

import pytest
from pyspark.sql import functions as F

from vintagewise.operators import drift, history, joins, redundancy, splits
from vintagewise.operators.guards import ContractError
from vintagewise.sources import store


def long(spark, **features):
    data = [(name, v) for name, values in features.items() for v in values]
    return spark.createDataFrame(data, "feature string, value double")


def one_run(df):
    return df.withColumn("run", F.lit(1))


def test_psi_of_equal_and_empty_bins(spark):
    arrays = spark.createDataFrame([([0.5, 0.5], [0.5, 0.5]), ([0.5, 0.5], [1.0, 0.0]), ([0.5], [0.5, 0.5])],
                                   "e array<double>, a array<double>")
    same, empty, uneven = [r[0] for r in arrays.select(drift.psi_arrays("e", "a")).collect()]
    assert same == 0 and uneven is None
    assert empty == pytest.approx(0.5 * math.log(2) + (1e-6 - 0.5) * math.log(1e-6 / 0.5))


def test_psi_against_base_equals_full_pairs(spark):
    base = spark.createDataFrame([("a", 0.5), ("b", 0.3), ("c", 0.2)], "k string, share double")
    actual = spark.createDataFrame([(1, "a", 0.6), (1, "d", 0.4), (2, "a", 0.5), (2, "b", 0.3), (2, "c", 0.2)],
                                   "g int, k string, share double")
    got = {r.g: r.psi for r in drift.psi_against_base(base, actual, ["k"], ["g"]).collect()}
    spread = base.withColumn("g", F.explode(F.array(F.lit(1), F.lit(2))))
    full = {r.g: r.psi for r in drift.psi_of_shares(spread, actual, ["k"], ["g"]).collect()}
    assert got[1] == pytest.approx(full[1]) and got[2] == pytest.approx(0, abs=1e-12) and full[2] == pytest.approx(0)


def test_numeric_statuses_and_figures(spark):
    train = long(spark, x=[1.0, 2.0, 3.0, 4.0], gone=[1.0, 2.0], empty=[1.0, 2.0], flat=[5.0, 5.0, 5.0])
    now = one_run(long(spark, x=[2.0, 2.0, 4.0, None], empty=[None, float("nan")], flat=[5.0, 5.0]))
    now = now.withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    reference = drift.numeric_reference(train)
    out = {r.feature: r for r in drift.numeric_drift(now, reference, now.select("run").distinct(), ["run"]).collect()}
    assert out["x"].status == "ok" and out["x"].n == 3 and out["x"].missing_rate_act == 0.25
    assert out["x"].median_ref == 2.5 and out["x"].median_act == 2.0
    assert out["x"].smd_median == pytest.approx(-0.5 / math.sqrt(5 / 3))
    assert (out["gone"].status, out["gone"].psi, out["gone"].n) == ("feature_not_in_feature_store", 10.0, 0)
    assert (out["empty"].status, out["empty"].psi) == ("all_values_missing", 10.0)
    assert out["flat"].psi == pytest.approx(0) and out["flat"].smd_mean is None and out["flat"].var_ratio is None
    summary = drift.drift_summary(spark.createDataFrame(list(out.values())), ["run"]).first()
    assert summary.n_features_monitored == 4 and summary.n_features_psi_high >= 2
    assert summary.data_quality_status == "feature_availability_failure"
    assert summary.n_features_all_missing == 1 and summary.n_features_missing_shift == 1


def test_invalid_references(spark):
    reference = drift.numeric_reference(long(spark, x=[1.0, 2.0])).withColumn("pct", F.array(F.lit(0.1), F.lit(0.9), F.lit(0.0)))
    now = one_run(long(spark, x=[1.0]))
    row = drift.numeric_drift(now, reference, now.select("run").distinct(), ["run"]).first()
    assert row.status == "invalid_numeric_reference" and row.psi is None


def test_single_value_has_no_variance(spark):
    row = drift.numeric_reference(long(spark, x=[3.0])).first()
    assert row["var"] is None and row["std"] is None and row.edges == [3.0, 3.0] and row.pct == [1.0]


def texts(spark, values):
    return spark.createDataFrame([("c", v) for v in values], "feature string, value string")


def test_categorical_reference_and_drift(spark):
    reference = drift.categorical_reference(texts(spark, ["a"] * 5 + ["b"] * 3 + [None] * 2 + ["z"]), k=3)
    row = reference.first()
    assert row.categories == ["a", "b", "__MISSING__"] and row.other_pct == pytest.approx(1 / 11)
    same = one_run(texts(spark, ["a"] * 5 + ["b"] * 3 + [None] * 2 + ["new"]))
    got = drift.categorical_drift(same, reference, same.select("run").distinct(), ["run"]).first()
    assert got.psi == pytest.approx(0, abs=1e-9) and got.n == 9 and got.status == "ok"
    # missing was not kept as a category, so it counts as other
    plain = drift.categorical_reference(texts(spark, ["a", "a", "b"]), k=1)
    now = one_run(texts(spark, ["a", None, "a"]))
    assert drift.categorical_drift(now, plain, now.select("run").distinct(), ["run"]).first().psi == pytest.approx(0, abs=1e-9)


def test_previous_month_must_exist(spark, rows):
    shares = spark.createDataFrame([("m", "2024-01-01", [1.0]), ("m", "2024-03-01", [1.0]), ("m", "2024-04-01", [1.0])],
                                   "model string, snapshot_date string, shares array<double>").withColumn(
        "snapshot_date", F.to_date("snapshot_date"))
    assert [str(r.snapshot_date) for r in drift.previous_month_psi(shares, ["model", "snapshot_date"]).collect()] == ["2024-04-01"]


def test_history(spark, rows):
    df = spark.createDataFrame([("s1", "r1", 1.0), ("s1", "r2", 2.0), ("s2", "r1", 5.0)], "s string, run string, v double")
    assert rows(history.latest_run(df, ["s"], "run")) == [("s1", "r2", 2.0), ("s2", "r1", 5.0)]
    top = history.top_groups(df, "s", "v", 1)
    assert rows(top) == [("s2", "r1", 5.0)]
    out = {r.s: (r.place, r.cumulative_share) for r in history.cumulative_share(
        spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 1.0)], "s string, v double"), "s", "v").collect()}
    assert out["b"] == (1, 0.6) and out["a"] == (2, 0.8) and out["c"] == (3, 1.0)
    assert history.months_of(df, "s") == ["s1", "s2"]


def test_connected_groups_and_pruning(spark):
    links = spark.createDataFrame([("a", "b", 0.99), ("b", "c", -0.97), ("d", "e", 0.5), ("f", "g", None)],
                                  "left string, right string, rho double")
    signal = spark.createDataFrame([(n, i / 10) for i, n in enumerate("abcdefg")], "feature string, gini double")
    out = {r.feature: (r.cluster, r["size"], r.keep) for r in redundancy.prune_features(links, signal).collect()}
    assert out["c"] == ("a", 3, True) and out["a"] == ("a", 3, False) and out["d"] == ("d", 1, True) and len(out) == 7


def test_folds_keep_groups_whole_and_balanced(spark):
    df = spark.range(6000).select((F.col("id") % 1500).alias("customer"), ((F.col("id") % 1500) % 5 == 0).cast("int").alias("label"))
    out = splits.group_folds(df, "customer", "label", 5)
    assert out.count() == 6000
    assert out.groupBy("customer").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0
    sizes = out.groupBy("fold").agg(F.countDistinct("customer").alias("n"), F.avg("label").alias("rate")).collect()
    assert sorted(r.n for r in sizes) == [300] * 5 and all(r.rate == 0.2 for r in sizes)


def test_splits(spark, rows):
    labels = spark.createDataFrame([("2023-06-30", 0), ("2023-07-01", 1), ("2024-06-30", 0), ("2024-07-01", 0), ("2024-08-31", 1),
                                    ("2024-09-01", 1)], "d string, label int").select(F.to_date("d").alias("snapshot_date"), "label")
    out = splits.time_split(labels, "2024-09-01")
    assert rows(out.groupBy("split").count()) == [("oot", 2), ("train_test", 2)]
    splits.require_two_classes(out)
    with pytest.raises(ContractError):
        splits.require_two_classes(out.where("split = 'oot'"))


def test_joins_and_coverage(spark, rows):
    right = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    left = spark.createDataFrame([(1,), (2,)], "k int")
    with pytest.raises(ContractError, match="fan-out"):
        joins.left_join_unique(left, right, ["k"], "right")
    matched = joins.with_match(left, right.limit(1), ["k"])
    assert rows(joins.match_counts(matched)) == [(1, 1)]
    labels = spark.range(20).select(F.col("id").cast("string").alias("loan_id"), F.to_date(F.lit("2024-07-01")).alias("snapshot_date"))
    coverage = joins.label_coverage(labels.union(labels), labels.limit(18), 6)
    assert rows(coverage) == [("2024-01", 20, 18, 0.9)]
    assert joins.coverage_violations(coverage, store.month_spine(spark, "2024-01-01", "2024-03-01"), 0.95).count() == 1
    assert joins.coverage_outside(coverage, store.month_spine(spark, "2024-02-01", "2024-03-01")).count() == 1
    features = labels.withColumn("Customer_ID", F.lit("c")).where("loan_id < '5'")
    joined = joins.attach_features(labels.withColumn("Customer_ID", F.lit("c")), features)
    assert joins.unmatched_labels(joined).first().n_unmatched == 20 - features.count()
