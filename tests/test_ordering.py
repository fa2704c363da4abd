import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from vintagewise.operators import correlation, distribution, history, ordering, performance

numbers = st.lists(st.integers(-50, 50).map(lambda i: i / 4), min_size=2, max_size=60)


def frame(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"value {kind}")


@settings(max_examples=8, deadline=None)
@given(values=numbers)
def test_quantiles_match_linear_interpolation(spark, values):
    counts = ordering.value_counts(frame(spark, values), "value")
    points = ordering.quantile_points(counts, "value").first().points
    assert np.allclose(points, np.quantile(values, np.linspace(0, 1, 11)), atol=1e-12)


def test_running_counts_over_many_values_and_a_hot_group(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("g"),
        ((F.col("id") * 7919) % 5003).cast("double").alias("value"))
    counts = ordering.value_counts(df, "value", ["g"])
    out = ordering.running_counts(counts, "value", ["n"], ["g"]).toPandas()
    for _, part in out.groupby("g"):
        part = part.sort_values("value")
        assert (part.n_before.to_numpy() == part.n.cumsum().to_numpy() - part.n.to_numpy()).all()
        assert (part.n_total == part.n.sum()).all()
    assert len(out) == counts.count()


def test_spark_percentile_agrees(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 1009).cast("double").alias("value"))
    mine = ordering.quantile_points(ordering.value_counts(df, "value"), "value", parts=20).first().points
    theirs = df.agg(F.percentile("value", [i / 20 for i in range(21)])).first()[0]
    assert np.allclose(mine, theirs)


def test_average_ranks(spark, rows):
    counts = ordering.value_counts(frame(spark, [1.0, 2.0, 2.0, 5.0]), "value")
    assert rows(ordering.average_ranks(counts, "value"), "value", "rank") == [(1.0, 1.0), (2.0, 2.5), (5.0, 4.0)]


def test_histogram_edges_and_clipping(spark):
    df = spark.createDataFrame([(v, [0.0, 1.0, 2.0]) for v in (-5.0, 0.0, 1.0, 2.0, 9.0)], "value double, edges array<double>")
    assert [r[0] for r in df.select(distribution.bin_index("value", "edges")).collect()] == [0, 0, 1, 1, 1]
    flat = spark.createDataFrame([(5.0, [5.0, 5.0])], "value double, edges array<double>")
    assert flat.select(distribution.bin_index("value", "edges")).first()[0] == 0
    right = df.select(distribution.upper_bin_index("value", "edges"))
    assert [r[0] for r in right.collect()] == [0, 0, 0, 1, 2]


@settings(max_examples=6, deadline=None)
@given(values=numbers, others=numbers)
def test_bin_shares_match_numpy(spark, values, others):
    counts = ordering.value_counts(frame(spark, values).withColumn("k", F.lit(1)), "value", ["k"])
    edges = distribution.quantile_edges(counts, ["k"])
    actual = ordering.value_counts(frame(spark, others).withColumn("k", F.lit(1)), "value", ["k"])
    got = distribution.bin_totals(actual, edges, ["k"], ["k"]).first()
    bounds = np.unique(np.quantile(values, np.linspace(0, 1, 11)))
    # positions come from whole-number arithmetic here; drop examples where rounding moves numpy's edges
    if len(bounds) == len(set(got.edges)) and np.allclose(bounds, sorted(set(got.edges)), rtol=0, atol=0) and len(bounds) > 1:
        expected = np.histogram(np.clip(others, bounds[0], bounds[-1]), bins=bounds)[0]
        assert list(got.bin_rows) == list(expected)
    assert sum(got.shares) == pytest.approx(1)


@settings(max_examples=8, deadline=None)
@given(pairs=st.lists(st.tuples(st.integers(0, 6), st.integers(0, 1)), min_size=2, max_size=40))
def test_auc_matches_pair_counting(spark, pairs):
    df = spark.createDataFrame([(s / 10, y) for s, y in pairs], "s double, y int")
    got = performance.auc(df, "s", "y").first()
    bad, good = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    if not bad or not good:
        assert got.auc is None
        return
    wins = sum((b > g) + (b == g) / 2 for b in bad for g in good)
    assert got.auc == pytest.approx(wins / (len(bad) * len(good)))
    mirrored = performance.auc(df.withColumn("s", -F.col("s")), "s", "y").first()
    assert got.auc + mirrored.auc == pytest.approx(1)


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 1), (0.2, 0), (0.9, 1), (0.9, 1), (0.3, 0)], "s double, y int")
    assert performance.auc(df, "s", "y").first().auc == pytest.approx(7.5 / 9)


def test_roc_grid_takes_the_top_of_a_step(spark):
    points = spark.createDataFrame([(0, 0), (0, 4), (5, 4), (5, 8), (10, 10)], "false_pos long, true_pos long").select(
        "*", F.lit(10).alias("good_total"), F.lit(10).alias("bad_total"), (F.col("false_pos") / 10).alias("fpr"),
        (F.col("true_pos") / 10).alias("tpr"))
    got = {r.cell: r.tpr for r in performance.roc_grid(points).collect()}
    assert len(got) == 101
    assert (got[0], got[50], got[100]) == (0.4, 0.8, 1.0)
    assert got[75] == pytest.approx(0.9) and got[25] == pytest.approx(0.4)


def test_roc_grid_matches_numpy(spark):
    rng = np.random.default_rng(5)
    data = [(float(rng.integers(0, 40)) / 40, int(rng.integers(0, 2))) for _ in range(300)]
    df = spark.createDataFrame(data, "s double, y int")
    points = performance.roc_points(performance.ranked_scores(df, "s", "y"), "s")
    curve = sorted((r.fpr, r.tpr) for r in points.collect())
    expected = np.interp(np.linspace(0, 1, 101), [p[0] for p in curve], [p[1] for p in curve])
    got = [r.tpr for r in performance.roc_grid(points).orderBy("cell").collect()]
    assert np.allclose(got, expected, atol=1e-9)


def test_correlations_match_pandas(spark):
    rng = np.random.default_rng(3)
    data = [(i, float(rng.integers(0, 9)), float(rng.integers(0, 9)) if rng.random() > .2 else None,
             float(rng.random()) if rng.random() > .3 else None, 7.0) for i in range(200)]
    df = spark.createDataFrame(data, "id int, a double, b double, c double, flat double")
    pdf, columns = df.toPandas(), ["a", "b", "c", "flat"]
    spearman = {(r.left, r.right): r.rho for r in correlation.spearman_matrix(df, columns).collect()}
    pearson = {(r.left, r.right): r.rho for r in correlation.pearson_matrix(df, columns).collect()}
    for a, b in [("a", "b"), ("a", "c"), ("b", "c")]:
        both = pdf[[a, b]].dropna()
        assert spearman[(a, b)] == pytest.approx(both[a].rank().corr(both[b].rank()))
        assert pearson[(a, b)] == pytest.approx(both[a].corr(both[b]))
    assert spearman[("a", "flat")] is None and pearson[("a", "flat")] is None


def test_ranges_grow_with_the_number_of_values(spark):
    counts = spark.range(10_000_000).select(F.col("id").cast("double").alias("value"), F.lit(1).alias("n"))
    ranges = ordering.value_ranges(counts, "value", ["n"]).groupBy("_range").agg(
        F.count("*").alias("rows"), F.min("value").alias("low"), F.max("value").alias("high")).orderBy("_range").collect()
    assert len(ranges) > 10_000_000 / ordering.RANGE_VALUES / 2
    assert max(r["rows"] for r in ranges) < 40 * ordering.RANGE_VALUES and sum(r["rows"] for r in ranges) == 10_000_000
    assert all(a.high < b.low for a, b in zip(ranges, ranges[1:], strict=False))


@pytest.mark.parametrize("most", [3, 1 << 16])
def test_running_counts_in_many_ranges(spark, monkeypatch, most):
    monkeypatch.setattr(ordering, "RANGE_VALUES", 8)
    monkeypatch.setattr(ordering, "MOST_CUTS", most)
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), ((F.col("id") * 7919) % 1201).alias("value"))
    for by in (["g"], []):
        counts = ordering.value_counts(df, "value", by)
        out = ordering.running_counts(counts, "value", ["n"], by).toPandas()
        assert len(out) == counts.count()
        for _, part in out.groupby(by) if by else [(0, out)]:
            part = part.sort_values("value")
            assert (part.n_before == part.n.cumsum() - part.n).all() and (part.n_total == part.n.sum()).all()


def test_order_statistics_need_no_sorting_aggregate_and_no_nested_loop(spark):
    df = spark.range(5000).select(
        (F.col("id") % 97).cast("double").alias("value"), (F.col("id") % 2).alias("flag"), F.col("id").cast("string").alias("name"))
    for out in (history.cumulative_share(df, "name", "value"), distribution.quantile_bin_rates(df, "value", "flag")):
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_order_statistics_of_nothing(spark):
    empty = frame(spark, [])
    assert ordering.running_counts(ordering.value_counts(empty, "value"), "value", ["n"]).count() == 0
    assert ordering.quantile_points(ordering.value_counts(empty, "value"), "value").first().points == []
