from datetime import date

from pyspark.sql import functions as F

from vintagewise.catalog import QUERIES, layers, modelling


def test_training_alone_keeps_its_windows_only(spark, monkeypatch):
    months = spark.sql("select explode(sequence(date '1996-01-01', date '1999-12-01', interval 1 month)) as snapshot_date")
    frame = months.withColumn("loan_id", F.col("snapshot_date").cast("string"))
    for name in ("labels", "features", "stored_labels", "stored_features"):
        monkeypatch.setattr(layers, name, lambda t: frame)
    held = {}
    monkeypatch.setattr(modelling.training, "train", lambda labels, features, *_, **__: held.update(labels=labels, features=features))
    monkeypatch.setattr(modelling.training, "importance", lambda model: model)
    QUERIES["feature_importance"].build(None)
    spans = {name: df.agg(F.min("snapshot_date"), F.max("snapshot_date"), F.count("*")).first() for name, df in held.items()}
    assert tuple(spans["labels"]) == (date(1997, 1, 1), date(1998, 2, 1), 14)
    assert tuple(spans["features"]) == (date(1996, 7, 1), date(1997, 8, 1), 14)
