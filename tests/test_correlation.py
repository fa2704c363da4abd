import numpy as np
import pandas as pd
import pytest

from vintagewise.operators import correlation


def pairs(df):
    return {(r.left, r.right): r.rho for r in df.collect()}


def expected(pdf, method):
    whole = pdf.corr(method=method, min_periods=2)
    return {(a, b): whole.loc[a, b] for i, a in enumerate(pdf) for b in list(pdf)[i + 1:]}


def agree(got, want):
    assert set(got) == set(want)
    for pair, rho in want.items():
        assert got[pair] is None if np.isnan(rho) else got[pair] == pytest.approx(rho, abs=1e-9), pair


def frame(spark, pdf):
    data = [tuple(None if v is None or np.isnan(v) else float(v) for v in row) for row in pdf.itertuples(index=False)]
    return spark.createDataFrame(data, ", ".join(f"`{c}` double" for c in pdf))


def test_equal_rows_and_equal_keys_stay_rows(spark):
    rows = [(1, 1.0, 1.0), (1, 2.0, 3.0), (1, 3.0, 2.0), (1, 4.0, 4.0)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    assert pairs(correlation.spearman_matrix(df, ["a", "b"]))[("a", "b")] == pytest.approx(0.8)
    twice = df.union(df).union(df.where("a = 2"))
    agree(pairs(correlation.spearman_matrix(twice, ["a", "b"])), expected(twice.select("a", "b").toPandas(), "spearman"))


def test_every_column_with_its_own_nulls(spark, monkeypatch):
    """More classes than a row carries at once, so pairs meet in several turns."""
    monkeypatch.setattr(correlation, "CLASSES", 3)
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({f"x{i}": np.where(rng.random(120) < 0.2, np.nan, rng.integers(0, 4 + i, 120)) for i in range(8)})
    pdf["x7"] = pdf["x0"] * 2
    df = frame(spark, pdf)
    rows = df.toDF(*[f"c{i}" for i in range(8)])
    assert len(set(correlation.presence_classes(rows))) == 7
    agree(pairs(correlation.spearman_matrix(df, list(pdf))), expected(pdf, "spearman"))
    agree(pairs(correlation.pearson_matrix(df, list(pdf))), expected(pdf, "pearson"))


def test_hot_values_and_clashing_names(spark):
    rng = np.random.default_rng(12)
    pdf = pd.DataFrame({name: np.where(rng.random(300) < 0.6, 0.0, rng.random(300)) for name in
                        ["feature", "value", "h1", "n", "turn"]})
    pdf.loc[::7, "n"] = np.nan
    agree(pairs(correlation.spearman_matrix(frame(spark, pdf), list(pdf))), expected(pdf, "spearman"))
    agree(pairs(correlation.pearson_matrix(frame(spark, pdf), list(pdf))), expected(pdf, "pearson"))


def test_only_rare_values_are_dealt_by_value(spark, monkeypatch):
    monkeypatch.setattr(correlation, "BROADCAST_ROW_LIMIT", 4)
    rng = np.random.default_rng(13)
    pdf = pd.DataFrame({"a": np.where(rng.random(200) < 0.7, 0.0, rng.integers(0, 50, 200)), "b": rng.integers(0, 30, 200)})
    agree(pairs(correlation.spearman_matrix(frame(spark, pdf), ["a", "b"])), expected(pdf, "spearman"))


@pytest.mark.parametrize("rows", [[], [(None, None, None)], [(1.0, 2.0, None)], [(1.0, 5.0, 2.0), (2.0, 5.0, float("nan"))]])
def test_too_little_gives_null(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double, c double")
    none = {("a", "b"): None, ("a", "c"): None, ("b", "c"): None}
    assert pairs(correlation.spearman_matrix(df, ["a", "b", "c"])) == none
    assert pairs(correlation.pearson_matrix(df, ["a", "b", "c"])) == none


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0)], "a double, b double")
    for matrix in (correlation.spearman_matrix, correlation.pearson_matrix):
        plan = matrix(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "InPandas" not in plan and "SortAggregate" not in plan


def aggregates(plan):
    """Number of functions of every aggregate of a plan."""
    found = [plan.aggregateExpressions().size()] if plan.nodeName() == "Aggregate" else []
    children = plan.children()
    return sum((aggregates(children.apply(i)) for i in range(children.size())), found)


def test_no_table_is_as_wide_as_columns_times_classes(spark):
    """One aggregate per column and class made every cell that was shuffled as wide as the whole row."""
    rng = np.random.default_rng(14)
    pdf = pd.DataFrame({f"x{i}": np.where(rng.random(60) < 0.3, np.nan, rng.integers(0, 9, 60)) for i in range(9)})
    matrix = correlation.spearman_matrix(frame(spark, pdf), list(pdf))
    # a column's own sums: two for each of the nine classes, and its name
    assert max(aggregates(matrix._jdf.queryExecution().optimizedPlan())) <= 2 * 9 + 1
    agree(pairs(matrix), expected(pdf, "spearman"))


def test_ranks_of_frequent_values_are_not_sent(spark):
    """A row is sent the value where its ranks can be looked up, and ranks for other values only."""
    ranks = spark.createDataFrame([(0, 1.0, 900, 1000, [7, 8]), (0, 2.0, 1, 1000, [9, 10])], "place int, value double, n long, n_total long, ranks array<int>")
    long = spark.createDataFrame([(5, 0, 1.0), (6, 0, 2.0)], "row long, place int, value double")
    heavy = ranks.where("n * 10 > n_total")
    sent = correlation._sent_cells(long, ranks, heavy, 10)
    assert sorted(map(tuple, sent.select("row", "place", "value", "ranks").collect())) == [(5, 0, 1.0, None), (6, 0, None, [9, 10])]


def test_broadcast_ranks_are_bounded():
    for columns, classes in [(2, 1), (47, 25), (47, 1000), (500, 500), (10_000, 10_000)]:
        share = correlation._looked_up(columns, classes)
        assert share == 1 or (share * columns <= 13 * 20_000 and share * columns * classes <= 1 << 23)
