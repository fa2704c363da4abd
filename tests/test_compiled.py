"""Compiled models against Spark ML's own transform, against another engine, and in one scan."""

import duckdb
import pytest
from pyspark.sql import functions as F
from test_training import SETTINGS, build

from vintagewise.plans import compiled, training
from vintagewise.session import stored


@pytest.fixture(scope="module")
def model(spark):
    labels, features = build(spark)
    # noise, and a part for the category and the missing numbers, so that trees differ and use every kind of input
    mixed = features.select("loan_id", (F.col("x") + F.coalesce(5 * F.col("z"), F.lit(40)) + F.when(F.col("g") == "g1", 30).otherwise(0)
                                        + F.abs(F.xxhash64("loan_id")) % 40 > 75).cast("int").alias("label"))
    labels = labels.drop("label").join(mixed, "loan_id")
    # category names that need quoting in either dialect
    odd = F.when(F.col("g") == "g1", "it's").when(F.col("g") == "g2", "a\\b").otherwise(F.col("g"))
    features = features.withColumn("g", odd).withColumn("flat", F.lit(3.0))
    return training.train(labels, features, "2024-03-01", {**SETTINGS, "maxIter": 8, "maxDepth": 3}), features


@pytest.fixture(scope="module")
def probes(spark, model):
    """Loans as they are, and with unseen categories, nulls, NaN and infinite numbers."""
    rows = model[1].where("loan_id rlike '[05]$'")
    changed = [rows, rows.withColumn("g", F.lit("never seen")), rows.withColumn("x", F.lit(None).cast("double")),
               rows.withColumn("z", F.lit(float("nan"))), rows.withColumn("x", F.lit(float("-inf"))), rows.withColumn("g", F.lit(None).cast("string"))]
    out = changed[0].withColumn("probe", F.lit(0))
    for i, part in enumerate(changed[1:], 1):
        out = out.unionByName(part.withColumn("probe", F.lit(i)))
    return stored(out, "probes")


def test_equals_the_pipeline(model, probes):
    spec = training.compiled(model[0])
    both = training.with_score(model[0].pipeline, probes).withColumn("own", spec.column())
    found = both.agg(F.count("*").alias("n"), F.max(F.abs(F.col("own") - F.col("model_predictions"))).alias("off"),
                     F.count_distinct("own").alias("different"), F.count("own").alias("known")).first()
    assert found.n == found.known == probes.count() and found.off < 1e-12 and found.different > 20


def test_another_engine_agrees(model, probes):
    spec = training.compiled(model[0])
    table = probes.toArrow()
    con = duckdb.connect()
    con.register("probes", table)
    theirs = con.execute(f"select loan_id, probe, {spec.sql()} as p from probes").fetchall()
    ours = {(r.loan_id, r.probe): r.p for r in probes.select("loan_id", "probe", spec.column().alias("p")).collect()}
    assert len(theirs) == len(ours) and all(abs(ours[i, k] - p) < 1e-12 for i, k, p in theirs)


def test_survives_json(model):
    spec = training.compiled(model[0])
    again = compiled.CompiledModel.from_json(spec.to_json())
    assert again.sql() == spec.sql() and again.sql(compiled.SPARK) == spec.sql(compiled.SPARK)


def test_three_models_share_one_scan(model, probes):
    spec = training.compiled(model[0])
    models = [compiled.CompiledModel(f"m{i}", d, spec.inputs, spec.trees[i:]) for i, d in enumerate(["2022-01-01", "2023-01-01", "2023-06-01"])]
    scored = compiled.score_models(probes, models)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Python" not in plan and "Exchange" not in plan
    for m in models:
        want = probes.where(F.col("snapshot_date") > F.lit(m.train_date).cast("date")).count()
        assert scored.where(F.col("model_name") == m.name).count() == want > 0
    many = compiled.score_models(probes, [compiled.CompiledModel(f"m{i}", "2022-01-01", spec.inputs, spec.trees[:1]) for i in range(40)])
    assert many.count() == 40 * probes.count()
    with pytest.raises(ValueError, match="no models"):
        compiled.score_models(probes, [])


def test_stumps_of_missing_and_constant_features(spark):
    rows = spark.createDataFrame(
        [("m", 1, 1.0, None, 5.0), ("m", 0, 2.0, None, 5.0), ("m", 1, 3.0, None, float("nan")), ("m", 0, None, None, 5.0)],
        "model_name string, label int, a double, never double, flat double")
    table = {r.feature: r for r in compiled.fit_stumps(rows, ["a", "never", "flat"], "model_name", "label", 3).collect()}
    assert table["a"].threshold == 2.0 and table["never"].threshold is None and table["flat"].threshold == 5.0
    assert table["a"].low == pytest.approx(0.0) and table["a"].high > 0 > table["a"].missing
    spec = compiled.from_stumps("m", "2020-01-01", list(table.values()))
    scores = [r.p for r in rows.select(spec.column().alias("p")).collect()]
    assert scores[2] > scores[0] == scores[1] > scores[3]
