"""Pearson and Spearman correlations of all column pairs, by built-in functions only.

A row is kept as one array of numbers and meets a fixed list of pairs: (left, right, place of the left number, place of
the right number). Sums per pair combine before the shuffle, so one row per pair leaves a task, and the plan has the
same size for ten columns and for a hundred.
"""

import json
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.clean import no_nan
from ..session import BROADCAST_ROW_LIMIT, stored
from .joins import small_side
from .ordering import running_counts

# presence classes whose ranks a row carries at once; further classes take turns
CLASSES = 64
# ranks that are broadcast: of so many times the usual limit of values, and so many numbers over all classes
LOOKED_UP, LOOKED_UP_RANKS = 13, 1 << 23
PAIR = "struct<left:int,right:int,at_left:int,at_right:int>"


def _fixed(value, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)


def _pair_sums(rows: DataFrame, pairs: Column) -> DataFrame:
    """Sums per pair over the rows where both numbers are present; `rows` has the array `numbers` and a weight `n`."""
    met = rows.select("numbers", "n", F.inline(pairs))
    x, y = F.get("numbers", F.col("at_left")), F.get("numbers", F.col("at_right"))
    both = met.select("left", "right", "n", x.alias("x"), y.alias("y")).where("x is not null and y is not null")
    return both.groupBy("left", "right").agg(
        F.sum("n").alias("n"), *[F.sum(F.expr(f"n * {term}")).alias(f"s{name}") for name, term in
                                 [("x", "x"), ("y", "y"), ("xx", "x * x"), ("yy", "y * y"), ("xy", "x * y")]])


def _coefficients(sums: DataFrame, columns: Sequence[str], sizes=None) -> DataFrame:
    """One row for every pair; null without two common rows and where a side does not vary.

    `sizes` is an array column with the largest magnitude per column before centring: variation below its rounding
    error is none.
    """
    every = [{"left": i, "right": j} for i, j in combinations(range(len(columns)), 2)]
    listed = sums.sparkSession.range(1).select(F.inline(_fixed(every, "array<struct<left:int,right:int>>")))
    total = listed.join(sums, ["left", "right"], "left")
    vx, vy = F.expr("sxx - sx * sx / n"), F.expr("syy - sy * sy / n")
    limit_x, limit_y = [F.lit(0.0) if sizes is None else 1e-12 * F.get(sizes, F.col(c)) for c in ("left", "right")]
    varies = (vx > F.col("n") * limit_x * limit_x) & (vy > F.col("n") * limit_y * limit_y)
    rho = F.when(F.col("n") > 1, F.when(varies, F.expr("sxy - sx * sy / n") / (F.sqrt(vx) * F.sqrt(vy))))
    names = F.array(*[F.lit(c) for c in columns])
    return total.select(F.get(names, F.col("left")).alias("left"), F.get(names, F.col("right")).alias("right"), rho.alias("rho"))


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles named by place, NaN as null and one zero."""
    return df.select(*[(no_nan(F.col(c).cast("double")) + 0.0).alias(f"c{i}") for i, c in enumerate(columns)])


def pearson_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation of every column pair over the rows where both are present, on values less their column's mean."""
    numbers = _numbers(df, columns)
    facts = numbers.agg(F.array(*[F.avg(c) for c in numbers.columns]).alias("means"),
                        F.array(*[F.max(F.abs(c)) for c in numbers.columns]).alias("sizes"))
    fact = facts.select(F.struct("means", "sizes")).scalar()
    centred = F.array(*[F.col(c) - F.get(fact["means"], F.lit(i)) for i, c in enumerate(numbers.columns)])
    pairs = [{"left": i, "right": j, "at_left": i, "at_right": j} for i, j in combinations(range(len(columns)), 2)]
    sums = _pair_sums(numbers.select(centred.alias("numbers"), F.lit(1.0).alias("n")), _fixed(pairs, f"array<{PAIR}>"))
    return _coefficients(sums, columns, fact["sizes"])


def presence_classes(rows: DataFrame) -> list[int]:
    """Class number per column: columns of one class are present in exactly the same rows.

    The patterns of nulls that occur are counted apart first. Two columns are of one class when they are present in the
    same set of patterns, told by the exclusive or of two 64-bit hashes per pattern; one row reaches the driver.
    """
    pattern = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in rows.columns])
    patterns = rows.select(pattern.alias("pattern")).distinct()
    marks = [F.bit_xor(F.when(F.substring("pattern", i + 1, 1) == "1", F.xxhash64(F.lit(seed), "pattern"))).alias(f"m{i}_{seed}")
             for i in range(len(rows.columns)) for seed in (1, 2)]
    found = patterns.agg(*marks).first()
    numbers: dict = {}
    return [numbers.setdefault(found[2 * i:2 * i + 2], len(numbers)) for i in range(len(rows.columns))]


def _looked_up(columns: int, classes: int) -> int:
    """The share of a column's rows, as one in so many, from which on a value's ranks are broadcast and not sent with its
    rows: fewer values than that a column can have so many rows, so the broadcast table is bounded."""
    return max(1, min(LOOKED_UP * BROADCAST_ROW_LIMIT // columns, LOOKED_UP_RANKS // (columns * classes)))


def _sent_cells(long: DataFrame, ranks: DataFrame, heavy: DataFrame, share: int) -> DataFrame:
    """What goes to a row: the ranks of a cell's value, or the value itself where its ranks can be looked up there.

    Values that hold many rows would be hot keys of the join, and their ranks many copies of the same; only the others are
    dealt by value.
    """
    key = ["place", "value"]
    light = ranks.where(F.col("n") * share <= F.col("n_total")).select(*key, "ranks")
    known = F.broadcast(heavy.select(*key))
    values = long.join(known, key, "left_semi").select("row", *key, F.lit(None).cast(ranks.schema["ranks"].dataType).alias("ranks"))
    joined = long.join(known, key, "left_anti").join(light, key)
    return values.unionByName(joined.select("row", "place", F.lit(None).cast("double").alias("value"), "ranks"))


def spearman_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rank correlation of every column pair over the rows where both are present; ties share their mean rank.

    A value's rank depends on which rows the other column has, so it is taken once per class of columns that are present
    together: usually a handful. All classes' ranks come from one ordering of the distinct values, centred on their exact
    means, so that their sums of squares are known per column and class and only the products are summed over rows. The
    ranks return by (column, value) and are gathered by a number given to the row when it was stored, as a list of
    the cells it has; no table is as wide as columns times classes. A row carries at most CLASSES ranks a column at a time,
    and those of frequent values are looked up where the row is, so that they are never shuffled.
    """
    width = len(columns)
    values = _numbers(df, columns)
    rows = stored(values.withColumn("row", F.monotonically_increasing_id()), "correlated")
    classes = presence_classes(rows.select(*values.columns))
    firsts = [classes.index(k) for k in range(max(classes) + 1)]
    flags = [f"with_{k}" for k in range(len(firsts))]
    cell = F.posexplode(F.array(*values.columns)).alias("place", "value")

    # ranks per column and distinct value
    flagged = [F.col(f"c{i}").isNotNull().cast("long").alias(flag) for i, flag in zip(firsts, flags)]
    counted = rows.select(*flagged, cell).where("value is not null")
    # written once: ranking reads the counts three times, and each time the rows would be spread and counted anew
    counts = stored(counted.groupBy("place", "value").agg(F.count("*").alias("n"), *[F.sum(f).alias(f) for f in flags]), "rank_counts")
    ranked = running_counts(counts, "value", ["n", *flags], ["place"], width)
    # twice the rank from 1 less its mean (total + 1) / 2: whole numbers up to the number of rows
    kind = "int" if rows.count() < 1 << 31 else "bigint"
    centred = F.array(*[(2 * F.col(f"{f}_before") + F.col(f) - F.col(f"{f}_total")).cast(kind) for f in flags])
    ranks = stored(ranked.select("place", "value", "n", "n_total", F.array(*flags).alias("met"), centred.alias("ranks")), "ranks")

    # turns: one for every two groups of classes, and in each the ranks of a column for the other group's classes
    groups = range((len(firsts) - 1) // CLASSES + 1)
    turns = {pair: n for n, pair in enumerate((g, h) for g in groups for h in groups if g <= h)}
    own = [k // CLASSES for k in classes]
    parts = [[{"turn": turns[min(g, h), max(g, h)], "low": h * CLASSES} for h in groups] for g in own]
    meets = [[turns[min(own[i], own[j]), max(own[i], own[j])] for j in range(width)] for i in range(width)]
    slot = _fixed([k % CLASSES for k in classes], "array<int>")

    long = rows.select("row", cell).where("value is not null")
    share = _looked_up(width, len(firsts))
    heavy = ranks.where(F.col("n") * share > F.col("n_total")).select("place", "value", F.col("ranks").alias("known"))
    placed = _sent_cells(long, ranks, heavy, share)
    dealt = placed.select("*", F.inline(F.get(_fixed(parts, "array<array<struct<turn:int,low:int>>>"), F.col("place"))))
    dealt = dealt.withColumn("ranks", F.slice("ranks", F.col("low") + 1, CLASSES))
    # dealt by row first: a list begun before the shuffle would hold one cell, and ranks looked up would travel
    there = dealt.repartition("row", "turn").join(F.broadcast(heavy), ["place", "value"], "left")
    found = F.coalesce("ranks", F.slice("known", F.col("low") + 1, CLASSES))
    gathered = there.groupBy("row", "turn").agg(F.collect_list(F.struct("place", found.alias("ranks"))).alias("cells"))
    one = gathered.select("turn", "cells", F.posexplode("cells").alias("at", "a"))
    two = one.select("turn", "a", F.explode(F.slice("cells", F.col("at") + 2, width)).alias("b"))
    if len(turns) > 1:
        two = two.where(F.get(F.get(_fixed(meets, "array<array<int>>"), F.col("a.place")), F.col("b.place")) == F.col("turn"))
    product = F.get("a.ranks", F.get(slot, F.col("b.place"))).cast("double") * F.get("b.ranks", F.get(slot, F.col("a.place")))
    products = two.groupBy(F.least("a.place", "b.place").alias("left"), F.greatest("a.place", "b.place").alias("right"))
    products = products.agg(F.sum(product).alias("sxy"))

    # sums over the rows two columns share, from the counts of a column's values in the rows of the other's class
    facts = ranks.groupBy("place").agg(*[F.sum(F.get("met", F.lit(k))).alias(f"n{k}") for k in range(len(firsts))], *[
        F.sum(F.get("met", F.lit(k)) * F.pow(F.get("ranks", F.lit(k)), 2)).alias(f"s{k}") for k in range(len(firsts))])
    facts = facts.select("place", *[F.array(*[f"{s}{k}" for k in range(len(firsts))]).alias(s) for s in ("n", "s")])
    left = small_side(facts.select(F.col("place").alias("left"), F.col("n").alias("ns"), F.col("s").alias("sl")), width)
    right = small_side(facts.select(F.col("place").alias("right"), F.col("s").alias("sr")), width)
    of = _fixed(classes, "array<int>")
    at_left, at_right = F.get(of, F.col("right")), F.get(of, F.col("left"))
    sums = products.join(left, "left").join(right, "right").select(
        "left", "right", F.get("ns", at_left).alias("n"), F.lit(0.0).alias("sx"), F.lit(0.0).alias("sy"),
        F.get("sl", at_left).alias("sxx"), F.get("sr", at_right).alias("syy"), "sxy")
    return _coefficients(sums, columns)
