"""Sparse cell relations (r, c, v): masks, unions, mosaics, resampling, overviews, filters.

A raster is the relation of its non-zero cells, so masks are semi and anti joins, unions are
aggregations by cell, and coarser grids are aggregations by integer division. Nothing here needs a
window over a whole raster, and every shuffle is on the cell key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrafold.functions.encoding import UNDATED, encode_year, oldest
from terrafold.functions.grid import km2, row_area

KEY = ["r", "c"]


def both(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.join(b, KEY, "left_semi")


def only(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.join(b, KEY, "left_anti")


def either(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select(*KEY).union(b.select(*KEY)).distinct()


def area_km2(cells: DataFrame) -> Column:
    return km2(F.coalesce(F.sum(row_area(F.col("r"))), F.lit(0.0)))


def sides(a: DataFrame, b: DataFrame) -> DataFrame:
    """r, c, in_a, in_b by one aggregation: a full outer join without a join."""
    tagged = a.select(*KEY, F.lit(1).alias("a"), F.lit(0).alias("b")).union(b.select(*KEY, F.lit(0), F.lit(1)))
    return tagged.groupBy(*KEY).agg(F.max("a").alias("in_a"), F.max("b").alias("in_b"))


def iou(a: DataFrame, b: DataFrame) -> DataFrame:
    """Intersection over union in cells; null for an empty union."""
    return sides(a, b).agg(
        F.coalesce(F.sum(F.col("in_a") * F.col("in_b")), F.lit(0)).alias("both"), F.count("*").alias("any"),
    ).select("both", "any", F.round(F.col("both") / F.nullif(F.col("any"), F.lit(0)), 6).alias("iou"))


def merge_oldest(a: DataFrame, b: DataFrame) -> DataFrame:
    """Cell by cell the older state; the undated code is the largest, so any date goes before it."""
    return a.select(*KEY, "v").union(b.select(*KEY, "v")).where("v > 0").groupBy(*KEY).agg(F.min("v").alias("v"))


def merge_oldest_columns(a: DataFrame, b: DataFrame) -> DataFrame:
    joined = a.withColumnRenamed("v", "x").join(b.withColumnRenamed("v", "y"), KEY, "full_outer")
    return joined.select(*KEY, oldest(F.col("x"), F.col("y")).alias("v"))


def mosaic(pieces: DataFrame, last: bool) -> DataFrame:
    """Union of pieces (piece, r, c, v): the first (read order) or the last (write order) non-zero value stands."""
    pick = F.max_by if last else F.min_by
    return pieces.where("v != 0").groupBy(*KEY).agg(pick("v", "piece").alias("v"))


def highest(pieces: DataFrame) -> DataFrame:
    return pieces.groupBy(*KEY).agg(F.max("v").alias("v"))


def fraction_grid(cells: DataFrame, k: int, height: int, width: int) -> DataFrame:
    """Built share of complete k x k blocks; ragged edges are dropped."""
    blocks = cells.withColumns({"br": F.floor(F.col("r") / k).cast("int"), "bc": F.floor(F.col("c") / k).cast("int")})
    whole = blocks.where((F.col("br") < height // k) & (F.col("bc") < width // k))
    return whole.groupBy("br", "bc").agg(F.round(F.count("*") / (k * k), 6).alias("fraction"))


def coarsen(cells: DataFrame, land: DataFrame, k: int) -> DataFrame:
    """Oldest date of a k x k block, else undated; the block is land if more than half of it is. Edges are padded."""
    key = [F.floor(F.col("r") / k).cast("int").alias("br"), F.floor(F.col("c") / k).cast("int").alias("bc")]
    tagged = cells.select(*key, "v", F.lit(0).alias("land")).union(land.select(*key, F.lit(0), F.lit(1)))
    dated = F.min(F.when((F.col("v") > 0) & (F.col("v") != UNDATED), F.col("v")))
    undated = F.max(F.when(F.col("v") == UNDATED, UNDATED))
    return tagged.groupBy("br", "bc").agg(
        F.coalesce(dated, undated, F.lit(0)).alias("v"), (F.sum("land") / (k * k) > 0.5).alias("land"))


def overview(cells: DataFrame, level: int, how: str) -> DataFrame:
    """One pyramid level: mode (ties to the smaller value), average of non-zero cells, least, or nearest (upper left)."""
    step = 1 << level
    key = [F.floor(F.col("r") / step).cast("int").alias("br"), F.floor(F.col("c") / step).cast("int").alias("bc")]
    if how == "mode":
        counts = cells.groupBy(*key, "v").agg(F.count("*").alias("n"))
        return counts.groupBy("br", "bc").agg(F.max_by("v", F.struct("n", -F.col("v"))).alias("v"))
    if how == "nearest":
        return cells.where((F.col("r") % step == 0) & (F.col("c") % step == 0)).select(*key, "v")
    agg = F.round(F.avg("v"), 6) if how == "average" else F.min("v")
    return cells.groupBy(*key).agg(agg.alias("v"))


def nearest(target: DataFrame, source: DataFrame, row: Column, col: Column, default: int = 0) -> DataFrame:
    """The source's value at each target cell's centre; row and col say where that is."""
    found = source.select(F.col("r").alias("sr"), F.col("c").alias("sc"), F.col("v").alias("sv"))
    placed = target.select(*KEY).withColumns({"sr": row, "sc": col})
    return placed.join(found, ["sr", "sc"], "left").select(*KEY, F.coalesce("sv", F.lit(default)).alias("v"))


def drape(footprint: DataFrame, years: DataFrame, k: int) -> DataFrame:
    """Coarse years on a fine footprint: the footprint is never altered, cells without a year are undated."""
    found = years.select(F.col("r").alias("sr"), F.col("c").alias("sc"), F.col("year"))
    placed = footprint.select(*KEY).withColumns({"sr": F.floor(F.col("r") / k).cast("int"), "sc": F.floor(F.col("c") / k).cast("int")})
    v = F.when(F.col("year") > 0, encode_year(F.col("year"))).otherwise(UNDATED)
    return placed.join(found, ["sr", "sc"], "left").select(*KEY, v.alias("v"))


def average(cells: DataFrame, k: int) -> DataFrame:
    """Area-weighted mean of the cells present, per k x k block."""
    key = [F.floor(F.col("r") / k).cast("int").alias("br"), F.floor(F.col("c") / k).cast("int").alias("bc")]
    a = row_area(F.col("r"))
    return cells.groupBy(*key).agg(F.round(F.sum(F.col("v") * a) / F.sum(a), 6).alias("mean"))


def bilinear(cells: DataFrame, points: DataFrame) -> DataFrame:
    """Values at fractional positions (y, x) of points: four neighbours by distance, over those present."""
    base = points.withColumns({"r0": F.floor(F.col("y") - 0.5).cast("int"), "c0": F.floor(F.col("x") - 0.5).cast("int")})
    base = base.withColumns({"fy": F.col("y") - 0.5 - F.col("r0"), "fx": F.col("x") - 0.5 - F.col("c0")})
    corners = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])
    each = base.withColumn("k", F.explode(corners)).withColumns({
        "r": F.col("r0") + F.col("k.i"), "c": F.col("c0") + F.col("k.j"),
        "w": F.abs(1 - F.col("k.i") - F.col("fy")) * F.abs(1 - F.col("k.j") - F.col("fx"))})
    seen = each.join(cells.select(*KEY, "v"), KEY)
    return seen.groupBy("id").agg(F.round(F.sum(F.col("v") * F.col("w")) / F.nullif(F.sum("w"), F.lit(0.0)), 6).alias("v"))


def _around(cells: DataFrame, reach: int) -> DataFrame:
    steps = F.sequence(F.lit(-reach), F.lit(reach))
    return cells.select(*KEY).withColumn("dr", F.explode(steps)).withColumn("dc", F.explode(steps)).select(
        (F.col("r") + F.col("dr")).alias("r"), (F.col("c") + F.col("dc")).alias("c"))


def mean_filter(cells: DataFrame, reach: int = 3) -> DataFrame:
    """Share of built cells in the square frame round every cell that has any; outside counts as not built. Rows are added up before columns."""
    side = 2 * reach + 1
    steps = F.sequence(F.lit(-reach), F.lit(reach))
    rows = cells.select(*KEY, F.explode(steps).alias("d")).groupBy((F.col("r") + F.col("d")).alias("r"), "c").agg(F.count("*").alias("n"))
    both_ways = rows.select(*KEY, "n", F.explode(steps).alias("d")).groupBy("r", (F.col("c") + F.col("d")).alias("c")).agg(F.sum("n").alias("n"))
    return both_ways.select(*KEY, F.round(F.col("n") / float(side * side), 6).alias("density"))


def erode(cells: DataFrame) -> DataFrame:
    """Cells whose 3 x 3 frame is built throughout."""
    full = _around(cells, 1).groupBy(*KEY).agg(F.count("*").alias("n")).where("n = 9")
    return full.select(*KEY)


#: Columns that are searched together for a nearest cell.
BAND = 4096


def nearest_distance(points: DataFrame, cells: DataFrame, reach: int, north_m: float, east_m: float) -> DataFrame:
    """Metres from each point cell (id, r, c; unique ids) to the nearest built cell within reach rows and columns; null beyond.

    The distance is separable: a point asks each of the rows within reach for the nearest built column on
    either side, which running windows over the row's cells and questions answer, so a point costs a row
    per row of reach and cells are never paired with points.
    """
    band = lambda x: F.floor(x / BAND)
    c = F.col("c")
    asked = points.select("id", "c", F.explode(F.sequence(F.lit(-reach), F.lit(reach))).alias("d"), "r")
    asked = asked.select("id", "d", (F.col("r") + F.col("d")).alias("r"), "c", band(c).alias("band"), F.lit(None).cast("int").alias("built"))
    # A cell near the edge of a band answers questions of the next one too.
    built = cells.select(*KEY).distinct().withColumn("band", F.explode(F.sequence(band(c - reach), band(c + reach))))
    held = built.select(F.lit(None).cast(points.schema["id"].dataType).alias("id"), F.lit(None).cast("int").alias("d"), "r", "c", "band", F.col("c").cast("int").alias("built"))
    rows = asked.union(held)
    so_far = lambda *order: Window.partitionBy("r", "band").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = F.col("built").isNull().cast("int")  # cells before the questions of their column
    seen = rows.withColumn("left", F.last("built", True).over(so_far("c", here))).withColumn("right", F.last("built", True).over(so_far(F.desc("c"), here)))
    across = F.least(F.when(c - F.col("left") <= reach, c - F.col("left")), F.when(F.col("right") - c <= reach, F.col("right") - c))
    best = seen.where("d is not null").select("id", F.hypot(F.col("d") * north_m, across * east_m).alias("m")).groupBy("id").agg(F.min("m").alias("metres"))
    return best.select("id", F.round("metres", 6).alias("metres"))


def near_cells(cells: DataFrame, metres: float, north_m: float, east_m: float) -> DataFrame:
    """r, c of the cells whose centre lies within so many metres of a cell's centre."""
    rows, cols = (F.sequence(F.lit(-int(metres // m)), F.lit(int(metres // m))) for m in (north_m, east_m))
    spread = cells.select(*KEY).distinct().withColumn("i", F.explode(rows)).withColumn("j", F.explode(cols))
    held = spread.where(F.hypot(F.col("i") * north_m, F.col("j") * east_m) <= metres)
    return held.select((F.col("r") + F.col("i")).alias("r"), (F.col("c") + F.col("j")).alias("c")).distinct()


def least_year(cells: DataFrame, k: int, missing: int = 9999) -> DataFrame:
    """br, bc, v: the earliest year of each k x k block; missing (also where all of it is) for none."""
    key = [F.floor(F.col("r") / k).cast("int").alias("br"), F.floor(F.col("c") / k).cast("int").alias("bc")]
    return cells.groupBy(*key).agg(F.coalesce(F.min(F.when(F.col("v") > 0, F.col("v"))), F.lit(missing)).alias("v"))


def shared_grid(grids: DataFrame) -> DataFrame:
    """island, row, col (whole-pixel offsets in the grid that covers all), height, width (of that grid).

    grids: island, a, c, e, f, height, width. Islands of another pixel size (1e-12) raise, and so do offsets
    that are over 0.01 pixel off a whole number, as a mosaic of them would resample.
    """
    all_grids = grids.agg(F.min("a").alias("a0"), F.max("a").alias("a1"), F.min(-F.col("e")).alias("e0"), F.max(-F.col("e")).alias("e1"), F.min("c").alias("x0"), F.max("f").alias("y0"))
    g = grids.crossJoin(F.broadcast(all_grids))  # one row
    fcol, frow = (F.col("c") - F.col("x0")) / F.col("a0"), (F.col("y0") - F.col("f")) / F.col("e0")
    off = (F.abs(fcol - F.round(fcol)) > 0.01) | (F.abs(frow - F.round(frow)) > 0.01)
    sizes = (F.col("a1") - F.col("a0") > 1e-12) | (F.col("e1") - F.col("e0") > 1e-12)
    fail = lambda text: F.raise_error(F.lit(text)).cast("int")
    placed = lambda x: F.when(sizes, fail("islands differ in pixel size")).when(off, fail("island is not on the shared grid")).otherwise(F.round(x).cast("int"))
    p = g.select("island", placed(frow).alias("row"), placed(fcol).alias("col"), "height", "width")
    size = p.agg(F.max(F.col("row") + F.col("height")).alias("height"), F.max(F.col("col") + F.col("width")).alias("width"))
    return p.select("island", "row", "col").crossJoin(F.broadcast(size))


def placed_mosaic(pieces: DataFrame, offsets: DataFrame, kind: str = "int") -> DataFrame:
    """Pieces (island, piece, r, c, v) moved to their offsets; later non-zero values overwrite earlier ones. Values of another type raise."""
    found = dict(pieces.dtypes)["v"]
    if found != kind:
        raise ValueError(f"values are {found}, not {kind}")
    moved = pieces.join(offsets.select("island", "row", "col"), "island").select("piece", (F.col("r") + F.col("row")).alias("r"), (F.col("c") + F.col("col")).alias("c"), "v")
    return mosaic(moved, last=True)
