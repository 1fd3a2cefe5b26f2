"""Overviews of a cell table, all levels from one scan: each level is added up from the level below it.

A level carries what the next one needs: counts by value for the mode, sums and counts for averages, the
least value, or the upper left cell. Levels are written tables of a quarter of the rows of the one below
at most for a filled raster, so the whole pyramid costs about a third more than its base, and the plan of
the result reads small tables only. Level k equals the overview of the full table at that level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.sources.scratch import written

WAYS = ("mode", "average", "least", "nearest")


def _halved(name: str) -> Column:
    return F.shiftright(F.col(name), 1).alias(name)


def _step(below: DataFrame, by: list[str], how: str) -> DataFrame:
    """The carried columns of the next level; rows and columns are halved, so a block's cells meet."""
    if how == "nearest":
        return below.where((F.col("r") % 2 == 0) & (F.col("c") % 2 == 0)).select(*by, _halved("r"), _halved("c"), "v")
    halved = below.select(*by, _halved("r"), _halved("c"), *[x for x in below.columns if x not in (*by, "r", "c")])
    if how == "mode":
        return halved.groupBy(*by, "r", "c", "v").agg(F.sum("n").alias("n"))
    if how == "average":
        return halved.groupBy(*by, "r", "c").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    return halved.groupBy(*by, "r", "c").agg(F.min("v").alias("v"))


def _shown(carried: DataFrame, by: list[str], how: str) -> DataFrame:
    """r, c, v of a level: of the values that are as frequent as any the smallest one, or the average to six places."""
    if how == "mode":
        return carried.groupBy(*by, "r", "c").agg(F.max_by("v", F.struct("n", -F.col("v"))).alias("v"))
    if how == "average":
        return carried.select(*by, "r", "c", F.round(F.col("s") / F.col("n"), 6).alias("v"))
    return carried.select(*by, "r", "c", "v")


def pyramid(cells: DataFrame, levels: int, how: str, by: Sequence[str] = ()) -> DataFrame:
    """by, level (from 1), r, c, v: overviews of cells (by, r, c, v; r and c from 0) at 1 / 2^level; cells is read once."""
    if how not in WAYS:
        raise ValueError(f"unknown overview {how}; known are {', '.join(WAYS)}")
    by = list(by)
    base = [*by, "r", "c"]
    below = {
        "mode": cells.select(*base, "v", F.lit(1).cast("long").alias("n")),
        "average": cells.select(*base, F.col("v").cast("double").alias("s"), F.lit(1).cast("long").alias("n"))}.get(how, cells.select(*base, "v"))
    out = None
    for level in range(1, levels + 1):
        below = written(_step(below, by, how), f"level-{level}")
        one = _shown(below, by, how).select(*by, F.lit(level).alias("level"), "r", "c", "v")
        out = one if out is None else out.union(one)
    if out is None:
        raise ValueError("a pyramid has one level at least")
    return out
