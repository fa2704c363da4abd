"""Train a boosted-tree pipeline on Spark ML, search its settings, score cohorts and keep its reference."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import product
from random import Random

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, functions as F

from .. import schemas as S
from ..functions.calendar import date_lit, training_windows
from ..functions.derive import gini_of
from ..operators import drift, performance, splits
from ..operators.guards import ContractError, repeated_keys, require_empty, require_rows
from ..operators.history import cumulative_share
from ..operators.joins import attach_features, unmatched_labels
from ..operators.profile import long_numbers, long_texts, numeric_columns, other_columns
from ..session import cut_lineage, stored
from ..sources.store import missing_months, month_spine, write_months, write_partitions
from .compiled import CompiledModel, from_pipeline, score_models


def feature_columns(df: DataFrame, exclude: Sequence[str] = S.NOT_FEATURES) -> tuple[list[str], list[str]]:
    """Numeric and categorical model inputs: every column that is not listed as excluded."""
    skip = [*exclude, "split", "fold"]
    return numeric_columns(df, skip), other_columns(df, skip)


def window_inputs(labels: DataFrame, features: DataFrame, train_date, train_months: int = S.TRAIN_MONTHS,
                  oot_months: int = S.OOT_MONTHS, mob: int = S.LABEL_MOB) -> tuple[DataFrame, DataFrame]:
    """Labels of the two windows, and the features of the months `mob` earlier: all that training reads of both stores."""
    bounds = training_windows(train_date, train_months, oot_months)
    first, last = bounds["train_start"], bounds["oot_end"]
    month = F.col("snapshot_date")
    earlier = month.between(F.trunc(F.add_months(first, -mob), "MM"), F.last_day(F.add_months(last, -mob)))
    return labels.where(month.between(first, last)), features.where(earlier)


def training_rows(labels: DataFrame, features: DataFrame, train_date, check: bool = True,
                  train_months: int = S.TRAIN_MONTHS, oot_months: int = S.OOT_MONTHS, mob: int = S.LABEL_MOB) -> DataFrame:
    """Labels of the two windows with their features.

    Only the windows' label months are read, and the feature months `mob` earlier. With `check`, no month of either may
    be missing, no loan may have two feature rows, and every label must have one.
    """
    bounds = training_windows(train_date, train_months, oot_months)
    first, last = bounds["train_start"], bounds["oot_end"]
    earlier = [F.trunc(F.add_months(first, -mob), "MM"), F.last_day(F.add_months(last, -mob))]
    inside, known = window_inputs(labels, features, train_date, train_months, oot_months, mob)
    windowed = splits.time_split(inside, train_date, train_months, oot_months)
    if check:
        spark = labels.sparkSession
        require_rows(windowed, f"no labels in the windows of {train_date}")
        require_empty(missing_months(inside, month_spine(spark, first, last)), "label months missing")
        require_empty(missing_months(known, month_spine(spark, *earlier)), "feature months missing")
        require_empty(repeated_keys(known.where("loan_id is not null"), ["loan_id"]), "loans with two feature rows")
    rows = attach_features(windowed, known)
    if check:
        require_empty(unmatched_labels(rows).where("n_unmatched > 0"), "labels without features")
        splits.require_two_classes(windowed)
    return rows


def preprocessing(numeric: Sequence[str], categorical: Sequence[str]) -> Pipeline:
    """Median imputation with missing flags and scaling for numbers, one-hot for the rest.

    An unseen or null category becomes the all-zero vector.
    """
    flags = [f"{c}_missing" for c in numeric]
    casts = ", ".join(f"CAST(`{c}` AS DOUBLE) AS `{c}_num`, CAST(`{c}` IS NULL AS DOUBLE) AS `{c}_missing`" for c in numeric)
    filled = [f"{c}_filled" for c in numeric]
    stages = [
        SQLTransformer(statement=f"SELECT *, {casts} FROM __THIS__"),
        Imputer(strategy="median", inputCols=[f"{c}_num" for c in numeric], outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="_numbers"),
        StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True),
    ]
    parts = ["_scaled", *flags]
    if categorical:
        codes, hots = [f"{c}_code" for c in categorical], [f"{c}_hot" for c in categorical]
        stages += [
            StringIndexer(inputCols=list(categorical), outputCols=codes, handleInvalid="keep"),
            OneHotEncoder(inputCols=codes, outputCols=hots, dropLast=True),
        ]
        parts += hots
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return Pipeline(stages=stages)


def classifier(**settings) -> GBTClassifier:
    return GBTClassifier(featuresCol="features", labelCol="label", seed=S.SPLIT_SEED, **settings)


def search_draws(space: Mapping[str, Sequence], draws: int, seed: int) -> list[dict]:
    """Different random settings from a grid of lists."""
    grid = [dict(zip(space, values)) for values in product(*space.values())]
    return Random(seed).sample(grid, min(draws, len(grid)))


def random_search(train: DataFrame, group: str = "Customer_ID", space: Mapping[str, Sequence] = S.SEARCH_SPACE,
                  draws: int = S.SEARCH_DRAWS, folds: int = S.SEARCH_FOLDS, seed: int = S.SEARCH_SEED,
                  parallelism: int = 4):
    """Best classifier by mean AUC over customer-grouped folds; returns (model, settings, mean AUC).

    The folds are written first: every tree level of every fit is a job over its fold, which would otherwise have a task
    for each shuffle partition however few rows there are. Read back, its parts grow with its size.
    """
    gbt = classifier()
    settings = search_draws(space, draws, seed)
    grid = [{gbt.getParam(name): value for name, value in chosen.items()} for chosen in settings]
    validator = CrossValidator(
        estimator=gbt, estimatorParamMaps=grid, numFolds=folds, foldCol="fold", parallelism=parallelism,
        evaluator=BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC", numBins=0))
    folded = stored(splits.group_folds(train.select(group, "label", "features"), group, "label", folds), "folds")
    fitted = validator.fit(folded)
    best = max(range(len(grid)), key=lambda i: fitted.avgMetrics[i])
    return fitted.bestModel, settings[best], fitted.avgMetrics[best]


@dataclass
class TrainedModel:
    name: str
    pipeline: PipelineModel
    settings: dict
    numeric: list[str]
    categorical: list[str]
    rows: DataFrame

    def scored(self) -> DataFrame:
        return with_score(self.pipeline, self.rows)


def model_name(train_date) -> str:
    return "credit_model_" + str(train_date).replace("-", "_")


def train(labels: DataFrame, features: DataFrame, train_date, settings: Mapping | None = None, check: bool = True,
          **search) -> TrainedModel:
    """Fit on the training part only. Fixed `settings` skip the search.

    The prepared rows are written once to the shared checkpoint folder: fitting reads them many times.
    """
    rows = splits.train_test_split(training_rows(labels, features, train_date, check))
    rows = cut_lineage(rows)
    numeric, categorical = feature_columns(rows)
    train_part = rows.where("split = 'train'")
    prepared = preprocessing(numeric, categorical).fit(train_part)
    vectors = cut_lineage(prepared.transform(train_part).select("Customer_ID", "label", "features"))
    if settings is None:
        model, settings, _ = random_search(vectors, **search)
    else:
        model = classifier(**settings).fit(vectors)
    pipeline = PipelineModel(stages=[*prepared.stages, model])
    return TrainedModel(model_name(train_date), pipeline, dict(settings), numeric, categorical, rows)


def with_score(pipeline: PipelineModel, rows: DataFrame) -> DataFrame:
    scored = pipeline.transform(rows)
    chance = vector_to_array("probability")[1]
    return scored.select(*rows.columns, chance.alias("model_predictions"))


def split_performance(model: TrainedModel) -> DataFrame:
    """Rows, bad rate, AUC and Gini on train, test and out-of-time rows."""
    scored = model.scored()
    areas = performance.auc(scored, "model_predictions", "label", ["split"], groups=3)
    out = splits.split_stats(scored).select("split", "n_rows", F.round("bad_rate", 2).alias("bad_rate")).join(areas, "split")
    return out.select("split", "n_rows", "bad_rate", "auc", F.round(gini_of("auc"), 3).alias("gini"))


def reference_tables(model: TrainedModel) -> dict[str, DataFrame]:
    """Feature distributions of the training part; score distribution and ROC of the out-of-time part."""
    part = model.rows.where("split = 'train'")
    oot = model.scored().where("split = 'oot'")
    named = F.lit(model.name).alias("model_name")
    ranked = performance.ranked_scores(oot, "model_predictions", "label")
    scores = oot.select(F.col("model_predictions").alias("value"))
    tables = {
        "numeric": drift.numeric_reference(long_numbers(part, model.numeric), groups=len(model.numeric)),
        "categorical": drift.categorical_reference(long_texts(part, model.categorical)),
        "scores": drift.score_reference(scores.withColumn("_all", F.lit(1)), ["_all"], groups=1).drop("_all"),
        "roc": performance.roc_grid(performance.roc_points(ranked, "model_predictions")),
    }
    return {name: table.select(named, "*") for name, table in tables.items()}


def importance(model: TrainedModel) -> DataFrame:
    """Importance per input column (one-hot parts summed), with its place and cumulative share.

    Only the model's own vector comes to the driver: one figure per assembled input.
    """
    weights = model.pipeline.stages[-1].featureImportances.toArray()
    totals = {c: 0.0 for c in [*model.numeric, *model.categorical]}
    at = 0
    for c in model.numeric:
        totals[c] += float(weights[at])
        at += 1
    for c in model.numeric:
        totals[c] += float(weights[at])
        at += 1
    if model.categorical:
        widths = next(s for s in model.pipeline.stages if type(s).__name__ == "OneHotEncoderModel").categorySizes
        for c, width in zip(model.categorical, widths):
            # the encoder keeps one slot per known category and drops the one for unseen values
            size = width - 1
            totals[c] += float(sum(weights[at:at + size]))
            at += size
    spark = model.rows.sparkSession
    table = spark.createDataFrame(list(totals.items()), "feature string, importance double")
    return cumulative_share(table, "feature", "importance")


def compiled(model: TrainedModel) -> CompiledModel:
    return from_pipeline(model.name, model.name[-10:].replace("_", "-"), model.pipeline, model.numeric, model.categorical)


def save_model(model: TrainedModel, bank: str) -> None:
    """Pipeline, its compiled form, reference tables and a registry row; the row comes last, so a listed model is complete."""
    root = f"{bank}/{model.name}"
    model.pipeline.write().overwrite().save(f"{root}/pipeline")
    lines = model.rows.sparkSession.createDataFrame([(model.name, compiled(model).to_json())], "model_name string, spec string")
    write_partitions(lines, f"{bank}/compiled", "model_name")
    for name, table in reference_tables(model).items():
        table.write.mode("overwrite").parquet(f"{root}/reference/{name}")
    results = split_performance(model).groupBy().pivot("split", ["train", "test", "oot"]).agg(F.first("auc"))
    row = results.select(
        F.lit(model.name).alias("model_name"), F.lit(model.name[-10:].replace("_", "-")).cast("date").alias("train_date"),
        F.lit(repr(sorted(model.settings.items()))).alias("settings"),
        *[F.col(c).alias(f"auc_{c}") for c in ("train", "test", "oot")])
    write_partitions(row, f"{bank}/registry", "model_name")


def load_compiled(bank: str, models: DataFrame) -> list[CompiledModel]:
    """The compiled forms of the models named in `models`; one line of JSON each reaches the driver."""
    specs = models.sparkSession.read.parquet(f"{bank}/compiled").join(models.select("model_name"), "model_name")
    return [CompiledModel.from_json(r.spec) for r in specs.orderBy("model_name").collect()]


def load_pipeline(bank: str, name: str) -> PipelineModel:
    return PipelineModel.load(f"{bank}/{name}/pipeline")


def score(features: DataFrame, pipeline: PipelineModel, name: str) -> DataFrame:
    """Predictions for all feature rows given; restrict the months before calling."""
    scored = with_score(pipeline, features)
    return scored.select("loan_id", "Customer_ID", "snapshot_date", F.lit(name).alias("model_name"), "model_predictions")


def score_all(features: DataFrame, pipelines: Mapping[str, PipelineModel], dates: Mapping[str, object]) -> DataFrame:
    """Each loan scored by every model trained strictly before its snapshot."""
    parts = [score(features.where(F.col("snapshot_date") > F.lit(str(dates[name])).cast("date")), pipeline, name)
             for name, pipeline in pipelines.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def score_run(bank: str, features: DataFrame, snapshot, root: str) -> DataFrame:
    """Scores one cohort, in one scan, with every model of the bank trained strictly before it and writes the predictions by model and
    month; a rerun replaces them. Returns what was written."""
    spark = features.sparkSession
    at = date_lit(snapshot)
    cohort = require_rows(features.where(F.col("snapshot_date") == at), f"no loans to score at {snapshot}")
    eligible = spark.read.parquet(f"{bank}/registry").where(F.col("train_date") < at).select("model_name", "train_date")
    models = load_compiled(bank, eligible)
    if not models:
        raise ContractError(f"no model was trained before {snapshot}")
    scored = score_models(cohort, models)
    path = f"{root}/predictions"
    write_months(scored, path, "model_name")
    return spark.read.parquet(path).where((F.col("snapshot_date") == at) & F.col("model_name").isin(*[m.name for m in models]))
