"""Products on an equal-area grid, brought to cells in degrees: the merge and the values know each product's no-data code.

A target cell's centre is projected and finds its source cells by key, the one that holds it or the four
round it; nothing is interpolated into or from no-data. The way back gives the degrees of source cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.functions.grid import PIXEL, TEST_LAT, TEST_LON, laea, laea_inverse, lat_of, lon_of
from terrafold.operators.cells import KEY


def merged(pieces: DataFrame, nodata: int) -> DataFrame:
    """r, c, v of pieces (piece, r, c, v): where pieces overlap, the first one's value that is data stands."""
    return pieces.where(F.col("v") != nodata).groupBy(*KEY).agg(F.min_by("v", "piece").alias("v"))


def on_grid(target: DataFrame, source: DataFrame, nodata: int, x0: float, y0: float, metres: float, how: str = "nearest", px: float = PIXEL, north: float = TEST_LAT, west: float = TEST_LON) -> DataFrame:
    """r, c, v of every target cell (r, c), from source cells (r, c, v; the upper left corner at x0, y0).

    nearest: the value of the source cell that holds the centre. bilinear: the mean of the four cells whose
    centres lie round it, by nearness and over those that are data (3 places). Without any, the value is
    nodata.
    """
    if how not in ("nearest", "bilinear"):
        raise ValueError(f"unknown resampling {how}")
    cells = target.select(*KEY).distinct()
    x, y = laea(lon_of(F.col("c"), west, px), lat_of(F.col("r"), north, px))
    at = cells.select(*KEY, ((x - x0) / metres).alias("fx"), ((F.lit(y0) - y) / metres).alias("fy"))
    data = source.where(F.col("v") != nodata).select(F.col("r").alias("sr"), F.col("c").alias("sc"), F.col("v").alias("sv"))
    if how == "nearest":
        placed = at.select(*KEY, F.floor("fy").cast("int").alias("sr"), F.floor("fx").cast("int").alias("sc"))
        return placed.join(data, ["sr", "sc"], "left").select(*KEY, F.coalesce("sv", F.lit(nodata)).alias("v"))
    base = at.withColumns({"r0": F.floor(F.col("fy") - 0.5).cast("int"), "c0": F.floor(F.col("fx") - 0.5).cast("int")})
    corner = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])).alias("k")
    each = base.select("*", corner).select(
        *KEY, (F.col("r0") + F.col("k.i")).alias("sr"), (F.col("c0") + F.col("k.j")).alias("sc"),
        ((1 - F.abs(F.col("fy") - 0.5 - F.col("r0") - F.col("k.i"))) * (1 - F.abs(F.col("fx") - 0.5 - F.col("c0") - F.col("k.j")))).alias("w"))
    sums = each.join(data, ["sr", "sc"]).where("w > 0").groupBy(*KEY).agg(F.round(F.sum(F.col("sv") * F.col("w")) / F.sum("w"), 3).alias("v"))
    return cells.join(sums, KEY, "left").select(*KEY, F.coalesce("v", F.lit(float(nodata))).alias("v"))


def degrees(cells: DataFrame, x0: float, y0: float, metres: float) -> DataFrame:
    """r, c, lon, lat of the centres of source cells."""
    lon, lat = laea_inverse((F.col("c") + 0.5) * metres + x0, F.lit(y0) - (F.col("r") + 0.5) * metres)
    return cells.select(*KEY, lon.alias("lon"), lat.alias("lat"))
