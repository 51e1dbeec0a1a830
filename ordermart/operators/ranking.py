"""ROW_NUMBER() OVER (PARTITION BY g ORDER BY slices..., k...) in pieces.

A plain window sorts a whole group in one task. That is right for groups of up
to ``most`` rows. Of larger ones the leading order columns (``slices``, each of
few values within a group) cut the group into pieces:

1. rows per piece, counted map side;
2. the rows before each piece: a running sum over the piece counts, one level
   of slices at a time, so that a window sees at most the values of one column;
3. ``row_number`` inside each piece, plus the rows before it.

A small group is one piece with nothing before it, so the counts and sums are of
the large groups alone. The same plan at every size, and none of it where only
other columns are read. With line number and part number modulo 1000 as slices,
an order that held a third of all lines would be thousands of pieces. Ties on
the whole order are numbered arbitrarily, as ROW_NUMBER does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def row_number_by(df: DataFrame, group: str, slices: list[str], order: list[str], out: str = "row_number",
                  most: int = 10_000) -> DataFrame:
    """``df`` with ``out``: the 1-based place of the row in its group, by
    ``slices`` and then ``order``, nulls first; groups of over ``most`` rows are cut."""
    # a struct is one key of which NULL fields are equal: the window and the join share one exchange of the rows
    keyed = df.withColumn("_group", F.struct(group))
    # one row of ``most`` at the most, so it is sent to every task
    large = keyed.groupBy("_group").agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > most)
    rows = keyed.join(F.broadcast(large), "_group", "left")
    cut = F.col("_size").isNotNull()
    rows = rows.withColumn("_piece", F.struct(group, *[F.when(cut, F.col(c)).alias(c) for c in slices], cut.alias("_cut")))
    counts = rows.where(cut).groupBy("_piece").agg(F.count(F.lit(1)).alias("_n"))
    inside = Window.partitionBy("_piece").orderBy(*slices, *order)
    numbered = rows.withColumn("_in_piece", F.row_number().over(inside))
    # left joins on unique keys: Spark leaves them out with the window wherever the number is not read
    return numbered.join(_before(counts, [group, *slices]), "_piece", "left").select(
        *df.columns, (F.coalesce(F.col("_before"), F.lit(0)) + F.col("_in_piece")).alias(out))


def _before(counts: DataFrame, keys: list[str]) -> DataFrame:
    """(_piece, _before): rows of the group in earlier pieces, from (_piece, _n)."""
    within = counts.withColumn("_outer", F.struct(*[F.col(f"_piece.{k}").alias(k) for k in keys[:-1]]))
    running = F.sum("_n").over(Window.partitionBy("_outer").orderBy(F.col(f"_piece.{keys[-1]}")))
    placed = within.withColumn("_earlier", running - F.col("_n"))
    if len(keys) == 2:  # the outer piece is the whole group
        return placed.select("_piece", F.col("_earlier").alias("_before"))
    outer = within.groupBy(F.col("_outer").alias("_piece")).agg(F.sum("_n").alias("_n"))
    sums = _before(outer, keys[:-1]).select(F.col("_piece").alias("_outer"), "_before")
    return placed.join(sums, "_outer").select("_piece", (F.col("_earlier") + F.col("_before")).alias("_before"))
