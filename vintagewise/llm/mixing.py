"""Mixing sources to target weights by systematic sampling.

Each source is lined up by size, then by a hash of the id, so that every stretch of the line holds all sizes alike. A
document expects target / source size copies; the running sum of expected copies plus one random offset per source is
laid against the integers, and the document is emitted once per integer its stretch crosses. A document is taken
floor or ceiling of its expected copies, and a source's total differs from its target by about one long document.

The running sum needs each document's place in its source. It is summed from counts per (source, size), counts per
hash cell inside those, and a row number inside a cell, so that a source or size holding most rows is never in one task.

Defined results: a null source is a source of its own, last in order; a null or empty text has size 0 and is taken like
the others, adding nothing; repeated rows count as documents of their own; an empty table gives an empty mix; further
columns are kept as they are.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import words

WEIGHTS = (5, 2, 1)
MOST = 3  # a target is at most this many times its source's size
CELL_DIGITS = 4  # hash cells per source and size: 16 to this power
OFFSET_DIGITS = 5  # 20 bits: offset plus place stays exact in a double for 2**33 documents


def _number(hexadecimal: Column, digits: int) -> Column:
    return F.conv(F.substring(hexadecimal, 1, digits), 16, 10).cast("long")


def source_targets(totals: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """`totals` (`_no_source`, `_source`, `source_size`; one row per source) with `target`.

    The sources share the sum of all sizes by weight; one that would exceed `most` times its own size stops there.
    Sources are visited by the share at which they stop: from the first that does not stop, all have one rate per weight.
    """
    place = F.row_number().over(Window.orderBy("_no_source", "_source"))
    turn = F.element_at(F.array(*map(F.lit, weights)), ((place - 1) % len(weights) + 1).cast("int"))
    weighed = totals.withColumn("_w", turn.cast("long")).withColumn("_cap", most * F.col("source_size"))
    line = Window.orderBy(F.col("_cap") / F.col("_w"), "_no_source", "_source")
    whole = Window.orderBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = weighed.withColumns({
        "_place": F.row_number().over(line),
        "_left": F.sum("source_size").over(whole)
        - F.coalesce(F.sum("_cap").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_weights": F.sum("_w").over(line.rowsBetween(0, Window.unboundedFollowing)),
    })
    free = F.col("_left") * F.col("_w") <= F.col("_cap") * F.col("_weights")
    first = F.min_by(F.struct("_place", "_left", "_weights"), F.when(free, F.col("_place"))).over(whole)
    found = filled.withColumn("_first", first)
    shared = (F.col("_first._left") * F.col("_w")).cast("double") / F.col("_first._weights").cast("double")
    stopped = F.col("_place") < F.col("_first._place")
    return found.select("_no_source", "_source", "source_size",
                        F.when(stopped, F.col("_cap").cast("double")).otherwise(shared).alias("target"))


def mix(docs: DataFrame, seed: str = "mix", weights: Sequence[int] = WEIGHTS, most: int = MOST,
        doc_id: str = "doc_id", text: str = "text", source: str = "source", keep: Sequence[str] | None = None) -> DataFrame:
    """`keep` (default: every column of the input) as struct `row`, with size, source_size, target and copies."""
    keep = docs.columns if keep is None else keep
    drawn = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.size(words(text)).cast("long").alias("size"),
        F.col(source).isNull().alias("_no_source"), F.coalesce(F.col(source), F.lit("")).alias("_source"),
        drawn.alias("_draw"),
    ).withColumn("_cell", _number(F.col("_draw"), CELL_DIGITS))
    by_source, by_size, by_cell = ["_no_source", "_source"], ["_no_source", "_source", "size"], ["_no_source", "_source", "size", "_cell"]

    before = Window.unboundedPreceding
    cells = keyed.groupBy(*by_cell).agg(F.count("*").alias("_n"))
    lengths = cells.groupBy(*by_size).agg(F.sum("_n").alias("_n"))
    shorter = lengths.withColumn("_shorter", F.sum("_n").over(
        Window.partitionBy(*by_source).orderBy("size").rowsBetween(before, 0)) - F.col("_n")).drop("_n")
    totals = lengths.groupBy(*by_source).agg(F.sum(F.col("_n") * F.col("size")).alias("source_size"))
    targets = source_targets(totals, weights, most)
    places = cells.withColumn("_ahead", F.sum("_n").over(
        Window.partitionBy(*by_size).orderBy("_cell").rowsBetween(before, 0)) - F.col("_n"))
    offsets = places.join(shorter, by_size).join(targets, by_source).select(
        *by_cell, (F.col("_shorter") + F.col("_ahead")).alias("_before"), "source_size", "target")

    inside = F.row_number().over(Window.partitionBy(*by_cell).orderBy("_draw"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    start = _number(F.md5(F.concat(F.lit(f"{seed}/"), F.when(F.col("_no_source"), F.lit("-")).otherwise(
        F.concat(F.lit("+"), "_source"))).cast("binary")), OFFSET_DIGITS) / F.lit(float(16 ** OFFSET_DIGITS))
    reached = lambda place: F.floor(start + place * F.col("_rate"))
    ranked = keyed.join(offsets, by_cell).withColumns({"_place": F.col("_before") + inside, "_rate": rate})
    copies = reached(F.col("_place")) - reached(F.col("_place") - 1)
    return ranked.select("row", "size", "source_size", "target", copies.alias("copies"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix itself: each input row as often as it is taken."""
    taken = mix(docs, **options).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
