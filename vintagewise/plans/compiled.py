"""Fitted models as plain expressions: one scan of the loans scores every model.

A model is a list of prepared inputs (filled and scaled numbers, missing flags, category tests) and weighted trees over
them. It prints as one SQL expression, for Spark or for any engine with ANSI quoting, and is kept as a line of JSON.
"""

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import small_side
from ..operators.ordering import quantile_points, value_counts
from ..operators.profile import long_numbers

# models whose expressions share one projection; more go through in further scans, so that a plan stays of bounded size
MODELS_A_SCAN = 32

SPARK, ANSI = "spark", "ansi"


def _name(column: str, dialect: str) -> str:
    return f"`{column.replace('`', '``')}`" if dialect == SPARK else '"' + column.replace('"', '""') + '"'


def _text(value: str, dialect: str) -> str:
    if dialect == SPARK:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return "'" + value.replace("'", "''") + "'"


def _number(value: float) -> str:
    text = repr(float(value))
    return text if "e" in text else text + "e0"


@dataclass(frozen=True)
class CompiledModel:
    """`inputs`: one entry per prepared input; `trees`: (weight, tree). A tree is a number, or a test of an input.

    A test is {"input", "at_most" or "among", "then", "else"}; a missing input goes to "else".
    """

    name: str
    train_date: str
    inputs: list[dict]
    trees: list[tuple[float, object]] = field(default_factory=list)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> "CompiledModel":
        return cls(**json.loads(text))

    def _input(self, at: int, dialect: str) -> str:
        spec = self.inputs[at]
        column = _name(spec["column"], dialect)
        if spec["kind"] == "equals":
            kind = "string" if dialect == SPARK else "varchar"
            return f"(case when cast({column} as {kind}) = {_text(spec['value'], dialect)} then 1e0 else 0e0 end)"
        value = f"cast({column} as double)"
        if spec["kind"] == "missing":
            missing = f"{column} is null or isnan({value})" if spec["nan"] else f"{column} is null"
            return f"(case when {missing} then 1e0 else 0e0 end)"
        fill = "null" if spec["fill"] is None else _number(spec["fill"])
        out = f"(case when {column} is null or isnan({value}) then {fill} else {value} end)"
        return out if spec["mean"] is None else f"(({out} - {_number(spec['mean'])}) * {_number(spec['scale'])})"

    def _tree(self, tree, dialect: str) -> str:
        if not isinstance(tree, dict):
            return _number(tree)
        value = self._input(tree["input"], dialect)
        test = f"{value} <= {_number(tree['at_most'])}" if "at_most" in tree else (
            f"{value} in ({', '.join(map(_number, tree['among']))})" if tree["among"] else "false")
        return f"(case when {test} then {self._tree(tree['then'], dialect)} else {self._tree(tree['else'], dialect)} end)"

    def sql(self, dialect: str = ANSI) -> str:
        """The chance of class 1 as an expression over the feature columns."""
        margin = " + ".join(f"{_number(weight)} * {self._tree(tree, dialect)}" for weight, tree in self.trees) or "0e0"
        return f"1e0 / (1e0 + exp(-2e0 * ({margin})))"

    def column(self) -> Column:
        return F.expr(self.sql(SPARK))


def from_pipeline(name: str, train_date, pipeline: PipelineModel, numeric: Sequence[str], categorical: Sequence[str]) -> CompiledModel:
    """The pipeline of `training.train` in this form. What the driver reads is the model alone."""
    stage = {type(s).__name__: s for s in pipeline.stages}
    fills = stage["ImputerModel"].surrogateDF.first()
    mean, std = stage["StandardScalerModel"].mean.toArray(), stage["StandardScalerModel"].std.toArray()
    # the scaler maps a column without spread to zero
    inputs = [{"kind": "number", "column": c, "fill": float(fills[f"{c}_num"]), "mean": float(m), "scale": 1.0 / float(s) if s else 0.0}
              for c, m, s in zip(numeric, mean, std, strict=True)]
    inputs += [{"kind": "missing", "column": c, "nan": False} for c in numeric]
    if categorical:
        for c, values in zip(categorical, stage["StringIndexerModel"].labelsArray, strict=True):
            inputs += [{"kind": "equals", "column": c, "value": v} for v in values]
    model = pipeline.stages[-1]
    trees = [(float(w), _read(t._java_obj.rootNode())) for w, t in zip(model.treeWeights, model.trees, strict=True)]
    return CompiledModel(name, str(train_date), inputs, trees)


def _read(node):
    if node.getClass().getSimpleName() == "LeafNode":
        return float(node.prediction())
    split = node.split()
    test = {"input": int(split.featureIndex())}
    if split.getClass().getSimpleName() == "ContinuousSplit":
        test["at_most"] = float(split.threshold())
    else:
        test["among"] = [float(c) for c in split.leftCategories()]
    return {**test, "then": _read(node.leftChild()), "else": _read(node.rightChild())}


def fit_stumps(rows: DataFrame, columns: Sequence[str], by: str, label: str, groups: int) -> DataFrame:
    """One-split trees for all models at once: (by, feature, threshold, low, high, missing).

    The split is at the feature's median; a side's value is half its smoothed log odds of class 1, shared out over the
    features. `groups` bounds the number of (by, feature) combinations.
    """
    keys = [by, "feature"]
    long = long_numbers(rows, columns, [by, label])
    counts = long.groupBy(*keys, "value").agg(F.count("*").alias("n"), F.sum(label).alias("bad"))
    medians = quantile_points(value_counts(long, "value", keys), "value", keys, 2, groups=groups).select(
        *keys, F.get("points", F.lit(1)).alias("threshold"))
    placed = counts.join(small_side(medians, groups), keys, "left")
    sides = {"low": F.col("value") <= F.col("threshold"), "high": F.col("value") > F.col("threshold"), "missing": F.col("value").isNull()}

    def leaf(inside: Column) -> Column:
        n, bad = (F.coalesce(F.sum(F.when(inside, F.col(c))), F.lit(0)) for c in ("n", "bad"))
        return F.ln((bad + 0.5) / (n - bad + 0.5)) / (2 * len(columns))

    return placed.groupBy(*keys, "threshold").agg(*[leaf(inside).alias(side) for side, inside in sides.items()])


def from_stumps(name: str, train_date, stumps: Sequence) -> CompiledModel:
    """A model from the rows of `fit_stumps`, one per feature. A feature never seen has its missing side only."""
    inputs, trees = [], []
    for row in sorted(stumps, key=lambda r: r["feature"]):
        inputs += [{"kind": "missing", "column": row["feature"], "nan": True},
                   {"kind": "number", "column": row["feature"], "fill": None, "mean": None, "scale": None}]
        tree = row["missing"]
        if row["threshold"] is not None:
            known = {"input": len(inputs) - 1, "at_most": row["threshold"], "then": row["low"], "else": row["high"]}
            tree = {"input": len(inputs) - 2, "at_most": 0.5, "then": known, "else": row["missing"]}
        trees.append((1.0, tree))
    return CompiledModel(name, str(train_date), inputs, trees)


def score_models(features: DataFrame, models: Sequence[CompiledModel],
                 keep: Sequence[str] = ("loan_id", "Customer_ID", "snapshot_date"), month: str = "snapshot_date") -> DataFrame:
    """Each row scored by every model trained strictly before its month, in one scan per `MODELS_A_SCAN` models."""
    if not models:
        raise ValueError("no models to score with")
    models, out = list(models), None
    for start in range(0, len(models), MODELS_A_SCAN):
        each = [F.when(F.col(month) > F.lit(m.train_date).cast("date"),
                       F.struct(F.lit(m.name).alias("model_name"), m.column().alias("model_predictions")))
                for m in models[start:start + MODELS_A_SCAN]]
        part = features.select(*keep, F.inline(F.array_compact(F.array(*each))))
        out = part if out is None else out.union(part)
    return out
