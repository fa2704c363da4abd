import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from vintagewise.operators import drift
from vintagewise.operators.guards import ContractError
from vintagewise.operators.profile import long_numbers, long_texts
from vintagewise.plans import monitoring, schedule, training
from vintagewise.sources import store

SETTINGS = {"maxIter": 3, "maxDepth": 2}


def build(spark):
    """3000 loans over 16 label months; x carries the signal, g is a category, z is often missing."""
    ids = spark.range(3000).select("id", (F.col("id") % 16).cast("int").alias("m"), (F.xxhash64("id") % 100).alias("h"))
    base = ids.select(
        F.concat(F.lit("L"), "id").alias("loan_id"), F.concat(F.lit("C"), F.col("id") % 900).alias("Customer_ID"),
        F.add_months(F.to_date(F.lit("2023-01-01")), F.col("m")).alias("snapshot_date"),
        F.col("h").cast("double").alias("x"), F.when(F.col("id") % 3 > 0, F.col("id") % 7).cast("double").alias("z"),
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("g"), F.col("id") % 4)).alias("g"), (F.col("h") > 30).cast("int").alias("label"))
    labels = base.select("loan_id", "Customer_ID", "label", F.lit("30dpd_6mob").alias("label_def"), "snapshot_date")
    features = base.select("loan_id", "Customer_ID", F.add_months("snapshot_date", -6).alias("snapshot_date"), "x", "z", "g")
    return labels, features


@pytest.fixture(scope="module")
def trained(spark):
    labels, features = build(spark)
    return training.train(labels, features, "2024-03-01", SETTINGS), labels, features


def test_columns_and_model(trained):
    model, *_ = trained
    assert (model.numeric, model.categorical, model.name) == (["x", "z"], ["g"], "credit_model_2024_03_01")
    out = {r.split: r for r in training.split_performance(model).collect()}
    assert set(out) == {"train", "test", "oot"} and all(r.auc > 0.9 for r in out.values())
    assert model.rows.where("split = 'test'").join(model.rows.where("split = 'train'"), "Customer_ID", "left_semi").count() == 0


def test_importance_shares(trained):
    table = {r.feature: r for r in training.importance(trained[0]).collect()}
    assert set(table) == {"x", "z", "g"} and table["x"].place == 1
    assert max(r.cumulative_share for r in table.values()) == pytest.approx(1)


def test_save_load_and_unseen_values(spark, trained, tmp_path):
    model, _, features = trained
    training.save_model(model, str(tmp_path))
    registry = store.read_table(spark, f"{tmp_path}/registry").first()
    assert (registry.model_name, str(registry.train_date)) == (model.name, "2024-03-01") and registry.auc_oot > 0.9
    again = training.load_pipeline(str(tmp_path), model.name)
    changed = features.withColumn("g", F.lit("never seen")).withColumn("z", F.lit(None).cast("double"))
    scores = training.score(changed, again, model.name)
    assert scores.count() == 3000 and scores.where("model_predictions between 0 and 1").count() == 3000
    assert store.read_table(spark, f"{tmp_path}/{model.name}/reference/roc").count() == 101
    later = training.score_all(features, {model.name: again}, {model.name: "2023-06-01"})
    assert later.agg(F.min("snapshot_date")).first()[0].isoformat() == "2023-07-01"


def test_small_search(trained):
    model, *_ = trained
    prepared = training.preprocessing(model.numeric, model.categorical).fit(model.rows)
    rows = prepared.transform(model.rows.where("split = 'train'")).select("Customer_ID", "label", "features")
    best, settings, mean_auc = training.random_search(rows, space={"maxIter": [2], "maxDepth": [1, 2]}, draws=2, folds=2)
    assert mean_auc > 0.9 and settings["maxIter"] == 2 and best.getMaxDepth() == settings["maxDepth"]


def test_search_fits_on_few_parts(spark, monkeypatch):
    """A fold of few rows is few tasks to every job of a fit, however many parts a shuffle has."""
    seen = []

    def fit(validator, dataset):
        fold = dataset.where("fold = 0").cache()
        seen.append((fold.rdd.getNumPartitions(), dataset.count()))
        fold.unpersist()
        raise InterruptedError

    monkeypatch.setattr(training.CrossValidator, "fit", fit)
    train = spark.range(400).select(F.concat(F.lit("C"), F.col("id") % 90).alias("Customer_ID"), (F.col("id") % 3 == 0).cast("int").alias("label"),
                                    array_to_vector(F.array(F.col("id").cast("double"))).alias("features"))
    kept = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.shuffle.partitions", 60)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        with pytest.raises(InterruptedError):
            training.random_search(train)
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    assert seen[0][0] <= 8 and seen[0][1] == 400


def test_labels_without_features_fail(spark):
    labels, features = build(spark)
    with pytest.raises(ContractError, match="without features"):
        training.training_rows(labels, features.where("loan_id <> 'L5' and loan_id <> 'L6'"), "2024-03-01")
    with pytest.raises(ContractError):
        training.training_rows(labels, features, "2030-01-01")


def test_search_draws_are_distinct_and_repeatable():
    draws = training.search_draws({"a": [1, 2], "b": [1, 2, 3]}, 5, 42)
    assert len({tuple(d.items()) for d in draws}) == 5 and draws == training.search_draws({"a": [1, 2], "b": [1, 2, 3]}, 5, 42)


def test_monitoring_statuses(spark, trained, tmp_path):
    model, labels, features = trained
    numeric = drift.numeric_reference(long_numbers(model.rows, ["x", "z"])).withColumn("model_name", F.lit(model.name))
    categorical = drift.categorical_reference(long_texts(model.rows, ["g"])).withColumn("model_name", F.lit(model.name))
    scores = model.scored().select(F.lit(model.name).alias("model_name"), F.col("model_predictions").alias("value"))
    ref = monitoring.References(numeric, categorical, drift.score_reference(scores, ["model_name"]), ["x", "z"], ["g"], 1)
    predictions = training.score(features.where("snapshot_date >= '2023-09-01'"), model.pipeline, model.name)
    registry = spark.createDataFrame([(model.name, "2024-03-01", 0.9)], "model_name string, d string, auc_oot double").select(
        "model_name", F.to_date("d").alias("train_date"), "auc_oot")
    snapshots = store.month_spine(spark, "2023-08-01", "2024-06-01")
    result = monitoring.monitor(registry, snapshots, predictions, features.drop("z"), labels, ref, "run_1")
    out = {r.snapshot_date.isoformat()[:7]: r for r in result.metrics.collect()}
    # nothing before the first unseen cohort is monitored
    assert min(out) == "2023-09"
    assert (out["2023-09"].drift_status, out["2023-09"].performance_status) == ("ok", "cohort_in_training")
    assert out["2023-09"].data_quality_status == "feature_availability_failure"  # z left the store
    assert out["2023-09"].score_psi_vs_prev_month is None and out["2023-10"].score_psi_vs_prev_month is not None
    assert (out["2024-03"].drift_status, out["2024-03"].performance_status) == ("predictions_missing", "ok")
    assert out["2024-03"].auc > 0.9 and out["2024-03"].n_labels_unmatched == 0
    assert out["2024-05"].performance_status == "labels_missing"
    assert out["2024-03"].performance_prediction_date.isoformat() == "2023-09-01"
    statuses = {(r.feature, r.status) for r in result.covariates.collect()}
    assert statuses == {("x", "ok"), ("g", "ok"), ("z", "feature_not_in_feature_store")}
    assert result.roc.groupBy("label_observation_date").count().where("count <> 101").count() == 0
    monitoring.save_monitoring(result, str(tmp_path))
    monitoring.save_monitoring(result, str(tmp_path))
    assert store.read_table(spark, f"{tmp_path}/metrics").count() == len(out)


def test_registry_dates(spark):
    registry = spark.createDataFrame([("m_2024_03_01", "2024-03-01")], "model_name string, d string").select(
        "model_name", F.to_date("d").alias("train_date"))
    spine = store.month_spine(spark, "2023-08-01", "2024-04-01")
    assert schedule.scoring_models(registry, spine).count() == 1
    assert schedule.monitored_models(registry, spine).count() == 8
    assert schedule.monitored_models(registry, spine, deployed_only=True).count() == 2
