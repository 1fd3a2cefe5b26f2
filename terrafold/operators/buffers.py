"""Ground within a distance of lines as row spans: no cell is tested against a line.

All points within a distance of a segment are convex: two discs and a rectangle. So each row's centre
line meets them in one interval, from the least left end to the greatest right end of the three parts'
intervals, and that is a span of columns. Spans of all segments are united row by row with one sweep; a
span is cut at tiles of columns first, so that no long row is one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrafold.operators.spans import inside, spans

#: Columns of a tile in which spans are united.
TILE = 4096


def _interval(a: Column, b: Column, far: Column) -> tuple[Column, Column, Column]:
    """Where a * x lies between b and far (b <= far), as lowest x, highest x and whether there is any; all x are allowed if a is 0 and 0 lies between."""
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    p, q = b / F.nullif(a, F.lit(0.0)), far / F.nullif(a, F.lit(0.0))
    return F.when(a == 0, low).otherwise(F.least(p, q)), F.when(a == 0, high).otherwise(F.greatest(p, q)), (a != 0) | ((b <= 0) & (far >= 0))


def buffer_spans(segments: DataFrame, metres: float, north_m: float, east_m: float) -> DataFrame:
    """r, c0, c1 (inclusive, not overlapping): the cells whose centre lies within so many metres of a segment (x1, y1, x2, y2 in pixels of north_m x east_m metres). A segment of no length is a disc; nulls have none."""
    c = F.col
    s = segments.where("x1 is not null and y1 is not null and x2 is not null and y2 is not null").select(
        (c("x1") * east_m).alias("ax"), (c("y1") * north_m).alias("ay"), ((c("x2") - c("x1")) * east_m).alias("dx"), ((c("y2") - c("y1")) * north_m).alias("dy"))
    first = F.ceil((F.least(c("ay"), c("ay") + c("dy")) - metres) / north_m - 0.5).cast("int")
    last = F.floor((F.greatest(c("ay"), c("ay") + c("dy")) + metres) / north_m - 0.5).cast("int")
    rows = s.withColumns({"first": first, "last": last}).where(c("last") >= c("first")).withColumn("r", F.explode(F.sequence("first", "last")))
    # From here on x is measured from the segment's first point, and h is how far the row's centre line lies below it.
    rows = rows.withColumns({"h": (c("r") + 0.5) * north_m - c("ay"), "length": F.hypot("dx", "dy")})
    reach = lambda off: F.sqrt(F.greatest(F.lit(metres * metres) - off * off, F.lit(0.0)))
    disc = lambda off, at: (F.abs(off) <= metres, at - reach(off), at + reach(off))
    # Across: |x dy - h dx| <= metres * length; along: 0 <= x dx + h dy <= length^2.
    band = metres * c("length")
    lo1, hi1, any1 = _interval(c("dy"), c("h") * c("dx") - band, c("h") * c("dx") + band)
    lo2, hi2, any2 = _interval(c("dx"), -c("h") * c("dy"), c("length") * c("length") - c("h") * c("dy"))
    low, high = F.greatest(lo1, lo2), F.least(hi1, hi2)
    parts = [disc(c("h"), F.lit(0.0)), disc(c("h") - c("dy"), c("dx")), (any1 & any2 & (low <= high) & (c("length") > 0), low, high)]
    left = F.least(*[F.when(there, lo) for there, lo, _ in parts])
    right = F.greatest(*[F.when(there, hi) for there, _, hi in parts])
    found = rows.select("r", F.ceil((c("ax") + left) / east_m - 0.5).cast("int").alias("c0"), F.floor((c("ax") + right) / east_m - 0.5).cast("int").alias("c1"))
    return united(found.where("c1 >= c0"))


def united(over: DataFrame) -> DataFrame:
    """r, c0, c1 of spans that overlap or touch, in one sweep per row and tile of columns; spans end at tiles."""
    c = F.col
    tile = lambda x: F.floor(c(x) / TILE).cast("int")
    cut = over.select("r", "c0", "c1", F.explode(F.sequence(tile("c0"), tile("c1"))).alias("tile"))
    cut = cut.select("r", "tile", F.greatest(c("c0"), c("tile") * TILE).alias("c0"), F.least(c("c1"), c("tile") * TILE + TILE - 1).alias("c1"))
    order = Window.partitionBy("r", "tile").orderBy("c0", "c1")
    before = F.max("c1").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = cut.withColumn("start", F.when(before.isNull() | (c("c0") > before + 1), 1).otherwise(0))
    grouped = starts.withColumn("island", F.sum("start").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return grouped.groupBy("r", "tile", "island").agg(F.min("c0").alias("c0"), F.max("c1").alias("c1")).select("r", "c0", "c1")


def infrastructure(segments: DataFrame, polygons: DataFrame, metres: float, north_m: float, east_m: float) -> DataFrame:
    """r, c0, c1: within so many metres of lines, or of polygons (vertices zone, ring, seq, x, y, whose edges are among the segments) and inside them."""
    return united(buffer_spans(segments, metres, north_m, east_m).union(spans(polygons).select("r", "c0", "c1")))


def outside(cells: DataFrame, over: DataFrame) -> DataFrame:
    """cells (distinct by r, c) that no span holds; they meet by row and column tile."""
    held = inside(cells, over.select(F.lit(0).alias("zone"), "r", "c0", "c1")).select("r", "c").distinct()
    return cells.join(held, ["r", "c"], "left_anti")


def control_tiers(areas: DataFrame, islands: DataFrame, excluded: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """island, label, zone: the protected areas (island, zone, tier) that serve as control: those of tier 1, or of tiers 1 and 2 where an island has none.

    Areas of tier 3 and up never serve. An island without any, or one that is excluded, has a row of nulls;
    with strict it raises.
    """
    usable = areas.where(F.col("tier").isin(1, 2) & ~F.col("island").isin(*excluded) if excluded else F.col("tier").isin(1, 2))
    best = usable.groupBy("island").agg(F.min("tier").alias("best"))
    chosen = usable.join(best, "island").where((F.col("best") == 2) | (F.col("tier") == 1))
    rows = islands.select("island").distinct().join(chosen.select("island", "zone", F.when(F.col("best") == 1, "tier 1").otherwise("tier 1+2").alias("label")), "island", "left")
    fail = F.raise_error(F.concat(F.lit("no protected area qualifies as a control on "), F.col("island"))).cast("string")
    return rows.select("island", F.when(F.col("label").isNull(), fail).otherwise(F.col("label")).alias("label") if strict else F.col("label"), "zone")
