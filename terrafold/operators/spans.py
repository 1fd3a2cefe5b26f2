"""Polygons as row spans: scanline crossings instead of point-in-polygon tests per pixel.

A polygon covers the pixels whose centres it contains (even-odd rule, so holes and multipolygons need
nothing special). For each row the edges that cross the row's centre line are found with sequence()
per edge, crossings are paired in order of x, and each pair is a span of columns. A zone's area comes
from its spans and never from pixels; cells meet spans by row and a range of columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrafold.functions.grid import km2, row_area


def edges(vertices: DataFrame) -> DataFrame:
    """zone, x1, y1, x2, y2 from vertices (zone, ring, seq, x, y); each ring is closed."""
    ring = Window.partitionBy("zone", "ring").orderBy("seq")
    first = Window.partitionBy("zone", "ring").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return vertices.select(
        "zone", F.col("x").alias("x1"), F.col("y").alias("y1"),
        F.coalesce(F.lead("x").over(ring), F.first("x").over(first)).alias("x2"),
        F.coalesce(F.lead("y").over(ring), F.first("y").over(first)).alias("y2"))


def spans(vertices: DataFrame) -> DataFrame:
    """zone, r, c0, c1 (inclusive), in pixel coordinates. Polygons that cover no pixel centre yield no row."""
    lo, hi = F.least("y1", "y2"), F.greatest("y1", "y2")
    # Rows whose centre r + 0.5 lies in [lo, hi).
    rows = F.sequence(F.ceil(lo - 0.5).cast("int"), F.ceil(hi - 0.5).cast("int") - 1)
    some = edges(vertices).where(F.ceil(hi - 0.5) > F.ceil(lo - 0.5))
    crossed = some.withColumn("r", F.explode(rows)).withColumn(
        "x", F.col("x1") + (F.col("r") + 0.5 - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1")))
    order = Window.partitionBy("zone", "r").orderBy("x")
    paired = crossed.withColumn("k", F.row_number().over(order)).withColumn("to", F.lead("x").over(order)).where("k % 2 = 1")
    out = paired.select("zone", "r", F.ceil(F.col("x") - 0.5).cast("int").alias("c0"), (F.ceil(F.col("to") - 0.5) - 1).cast("int").alias("c1"))
    return out.where("c1 >= c0")


#: Columns of a tile, the second key of the join of cells and spans.
TILE = 256


def inside(cells: DataFrame, over: DataFrame) -> DataFrame:
    """Cells with the zone of each span that holds them; they meet by row and column tile, so no row is one key."""
    tile = lambda c: F.floor(F.col(c) / TILE).cast("int")
    s = over.select("zone", F.col("r").alias("sr"), "c0", "c1", F.explode(F.sequence(tile("c0"), tile("c1"))).alias("st"))
    placed = cells.withColumn("ct", tile("c"))
    return placed.join(s, (placed["r"] == s["sr"]) & (placed["ct"] == s["st"]) & placed["c"].between(s["c0"], s["c1"])).drop("sr", "st", "ct", "c0", "c1")


def zone_areas(over: DataFrame) -> DataFrame:
    return over.groupBy("zone").agg(F.sum((F.col("c1") - F.col("c0") + 1) * row_area(F.col("r"))).alias("zone_m2"))


KINDS = ("binary", "fraction", "amount")


def zonal(cells: DataFrame, vertices: DataFrame, kind: str = "binary", scale: float = 1.0, label: str = "built") -> DataFrame:
    """zone, {label}_km2, zone_km2, share_pct, measure. Extents and surfaces are named apart and never mixed.

    binary: area of the cells; fraction: v * scale of each cell's area; amount: v is square metres already.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind}")
    over = spans(vertices)
    weight = {"binary": row_area(F.col("r")), "fraction": F.col("v") * scale * row_area(F.col("r")), "amount": F.col("v") * scale}[kind]
    sums = inside(cells, over).groupBy("zone").agg(F.sum(weight).alias("m2"))
    joined = zone_areas(over).join(sums, "zone", "left").withColumn("m2", F.coalesce("m2", F.lit(0.0)))
    return joined.select(
        "zone", km2(F.col("m2")).alias(f"{label}_km2"), km2(F.col("zone_m2")).alias("zone_km2"),
        F.round(100 * F.col("m2") / F.col("zone_m2"), 4).alias("share_pct"), F.lit("extent" if kind == "binary" else "surface").alias("measure"))


def rasterise(vertices: DataFrame) -> DataFrame:
    """r, c, zone of all covered pixels."""
    return spans(vertices).select("zone", "r", F.explode(F.sequence("c0", "c1")).alias("c"))


def year_first_built(buildings: DataFrame, shapes: DataFrame) -> DataFrame:
    """Oldest year per pixel over buildings (zone, v); the undated code is the largest, so dates win."""
    return rasterise(shapes).join(buildings, "zone").groupBy("r", "c").agg(F.min("v").alias("v"))
