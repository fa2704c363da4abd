"""Exact order statistics that never gather one group in one task.

Rows are first counted per distinct value, which combines before the shuffle. Each group is then cut into ranges at the
values whose hash falls below a threshold, one in RANGE_VALUES: a group gets as many ranges as its own number of values
asks for, without being counted first. The draw is a pure function of the data, so it comes out the same whenever Spark
recomputes it, and it only balances the work, never the result. A range longer than 40 * RANGE_VALUES has a chance of
e^-40 per value. Running counts are taken inside a range and shifted by the totals of the ranges below. Rows whose
group key is null drop out.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import stored
from .joins import one_value, small_side

RANGE_VALUES = 1 << 11  # distinct values of a range, on average
MOST_CUTS = 1 << 16  # of one group; beyond it every second, third, ... cut is taken, and ranges grow


def value_counts(df: DataFrame, value: str, by: Sequence[str] = (), **weights) -> DataFrame:
    """One row per group and distinct non-null value, with a summed column per weight (default: n = rows)."""
    sums = {name: F.sum(expr) for name, expr in weights.items()} or {"n": F.count("*")}
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value)
    return counted.agg(*[total.alias(name) for name, total in sums.items()])


def stored_counts(df: DataFrame, value: str, by: Sequence[str] = (), **weights) -> DataFrame:
    """`value_counts` of all rows, a missing value among them, as a table.

    For counts that several steps read: rows are spread and counted once, not once more for every step.
    """
    sums = {name: F.sum(expr) for name, expr in weights.items()} or {"n": F.count("*")}
    return stored(df.groupBy(*by, value).agg(*[total.alias(name) for name, total in sums.items()]), "value_counts")


def value_ranges(counts: DataFrame, value: str, weights: Sequence[str], by: Sequence[str] = (),
                 groups: int | None = None) -> DataFrame:
    """Adds `_range`, which rises with the value in each group, and `_group`, a struct with the group's sum of each weight."""
    # drawn values stand for themselves and all others fall together, so few short rows are left of a group
    drawn = F.pmod(F.xxhash64(value), F.lit(RANGE_VALUES)) == 0
    sums = [F.sum(w).alias(w) for w in weights]
    few = counts.groupBy(*by, F.when(drawn, F.col(value)).alias("_cut")).agg(*sums)
    folded = few.groupBy(*by).agg(F.array_sort(F.collect_list("_cut")).alias("cuts"), *sums)
    every = F.ceil(F.greatest(F.size("cuts"), F.lit(1)) / MOST_CUTS)
    folded = folded.withColumn("cuts", F.filter("cuts", lambda _, i: i % every == 0))
    step = F.ceil(F.sqrt(F.greatest(F.size("cuts"), F.lit(1)))).cast("int")
    folded = folded.withColumn("step", step).withColumn("coarse", F.filter("cuts", lambda _, i: i % F.col("step") == 0))
    group = F.struct("cuts", "step", "coarse", *weights)
    if by:
        marked = counts.join(small_side(folded.select(*by, group.alias("_group")), groups), list(by))
    else:
        marked = counts.withColumn("_group", one_value(folded, group))
    # every step-th cut first, then the cuts from there
    here, step = F.col(value), F.col("_group.step")
    block = F.greatest(F.size(F.filter("_group.coarse", lambda cut: cut <= here)) - 1, F.lit(0)) * step
    nearby = F.slice("_group.cuts", block + 1, step)
    # never null, and said so: else the check for it is pushed below the counts and done for every row
    return marked.withColumn("_range", F.coalesce(block + F.size(F.filter(nearby, lambda cut: cut <= here)), F.lit(0)))


def running_counts(counts: DataFrame, value: str, weights: Sequence[str], by: Sequence[str] = (),
                   groups: int | None = None) -> DataFrame:
    """Adds `<w>_before` (sum over smaller values) and `<w>_total` (sum over the group) per weight.

    `counts` has one row per group and value. `groups` is a proven bound on the number of groups, if known.
    """
    columns = counts.columns
    marked = value_ranges(counts, value, weights, by, groups)
    # a range starts at the group's total less everything from it upwards; both branches of the plan then
    # need the same columns of `counts`, so its shuffle is done once and reused
    upwards = Window.partitionBy(*by).orderBy("_range").rowsBetween(0, Window.unboundedFollowing)
    totals = marked.groupBy(*by, "_range").agg(
        *[F.sum(w).alias(f"_sum_{w}") for w in weights], *[F.max(f"_group.{w}").alias(f"_all_{w}") for w in weights])
    shifts = totals.select(
        *by, "_range", *[(F.col(f"_all_{w}") - F.sum(f"_sum_{w}").over(upwards)).alias(f"_shift_{w}") for w in weights]
    )
    inside = Window.partitionBy(*by, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = marked.withColumns({f"_in_{w}": F.coalesce(F.sum(w).over(inside), F.lit(0)) for w in weights})
    joined = ranked.join(shifts, [*by, "_range"])
    return joined.select(
        *columns,
        *[(F.col(f"_shift_{w}") + F.col(f"_in_{w}")).alias(f"{w}_before") for w in weights],
        *[F.col(f"_group.{w}").alias(f"{w}_total") for w in weights],
    )


def average_ranks(counts: DataFrame, value: str, by: Sequence[str] = (), n: str = "n") -> DataFrame:
    """Rank of each value, ties sharing their mean rank, from 1."""
    ranked = running_counts(counts, value, [n], by)
    return ranked.withColumn("rank", F.col(f"{n}_before") + (F.col(n) + 1) / 2)


def quantile_points(counts: DataFrame, value: str, by: Sequence[str] = (), parts: int = 10, n: str = "n",
                    groups: int | None = None) -> DataFrame:
    """Array of the `parts + 1` evenly spaced quantiles per group, by linear interpolation.

    Position i sits at i * (total - 1) / parts. Whole-number arithmetic finds its neighbours, and only the
    few values that are neighbours of some position are kept.
    """
    ranked = running_counts(counts, value, [n], by, groups)
    last = F.col(f"{n}_total") - 1
    first_rank, next_rank = F.col(f"{n}_before"), F.col(f"{n}_before") + F.col(n)

    def holds(rank):
        return (rank >= first_rank) & (rank < next_rank)

    def lower(i):
        return F.floor(i * last / parts)

    hits = F.filter(
        F.sequence(F.lit(0).cast("bigint"), F.lit(parts).cast("bigint")),
        lambda i: holds(lower(i)) | holds(F.least(lower(i) + 1, last)),
    )
    # most values are near no position: a plain comparison, wide enough for rounding, sorts them out first
    scale = parts / F.greatest(last, F.lit(1))
    near = ranked.where(F.floor(next_rank * scale + 1e-6) >= F.ceil((first_rank - 1) * scale - 1e-6))
    near = near.withColumn("_hits", hits).where(F.size("_hits") > 0)
    near = near.select(*by, value, n, f"{n}_before", f"{n}_total", F.explode("_hits").alias("_i"))
    i = F.col("_i")
    ends = near.groupBy(*by, "_i").agg(
        F.max(F.when(holds(lower(i)), F.col(value))).alias("_lo"),
        F.max(F.when(holds(F.least(lower(i) + 1, last)), F.col(value))).alias("_hi"),
        F.max((i * last - lower(i) * parts) / parts).alias("_part"),
    )
    point = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_part")
    ordered = F.array_sort(F.collect_list(F.struct("_i", point.alias("point"))))
    return ends.groupBy(*by).agg(F.transform(ordered, lambda e: e["point"]).alias("points"))
