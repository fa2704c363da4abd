"""Steps that read value counts several times go through the rows once."""

import math

from pyspark.sql import functions as F

from vintagewise.operators import drift, performance, profile

ODD = [("x", 1.0), ("x", 2.0), ("x", 2.0), ("x", None), ("flat", 0.1), ("flat", 0.1), ("flat", 0.1), ("one", 7.0), ("never", None),
       ("far", 1e9), ("far", 1e9 + 1), ("far", 1e9 + 2), ("open", float("inf")), ("open", 1.0), (None, 3.0), (None, 5.0)]


def kept(spark, tmp_path, rows, schema):
    path = str(tmp_path / "the_rows")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def reads_rows(df):
    return any("the_rows" in name for name in df.inputFiles())


def test_moments_of_counts_equal_those_of_rows(spark):
    long = spark.createDataFrame([("m", *row) for row in ODD], "model string, feature string, value double")
    counts = long.groupBy("model", "feature", "value").agg(F.count("*").alias("n"))
    want = {r.feature: r for r in profile.moments(long, ["model"]).collect()}
    have = {r.feature: r for r in profile.moments_of_counts(counts, ["model"]).collect()}
    assert have.keys() == want.keys()
    for name, row in want.items():
        assert (have[name].n, have[name].missing_rate) == (row.n, row.missing_rate)
        for c in ("mean", "var", "std"):
            x, y = row[c], have[name][c]
            assert (x is None) == (y is None), (name, c)
            assert x is None or (math.isnan(x) and math.isnan(y)) or x == y or math.isclose(x, y, rel_tol=1e-12, abs_tol=1e-30), (name, c)
    assert have["flat"]["var"] == 0 and have["far"]["var"] == 1


def test_drift_goes_through_the_rows_once(spark, tmp_path):
    rows = [("r", "x", float(i % 7)) for i in range(50)] + [("r", "x", None)]
    long = kept(spark, tmp_path, rows, "run string, feature string, value double")
    reference = drift.numeric_reference(long.drop("run"))
    assert not reads_rows(reference)
    out = drift.numeric_drift(long, reference, spark.createDataFrame([("r",)], "run string"), ["run"])
    assert not reads_rows(out)
    row = out.first()
    assert (row.n, row.status, row.psi) == (50, "ok", 0.0) and math.isclose(row.missing_rate_act, 1 / 51)
    assert math.isclose(row.mean_act, sum(i % 7 for i in range(50)) / 50) and row.smd_mean == 0


def test_signal_goes_through_the_rows_once(spark, tmp_path):
    rows = [("x", 1.0, 0), ("x", 2.0, 0), ("x", 3.0, 1), ("x", None, 1), ("y", 1.0, None), ("y", 1.0, 1), ("y", 1.0, 0)]
    out = performance.feature_signal(kept(spark, tmp_path, rows, "feature string, value double, label int"), "label")
    assert not reads_rows(out)
    assert {tuple(r) for r in out.collect()} == {("x", 1, 2, 1.0), ("y", 1, 1, 0.0)}
