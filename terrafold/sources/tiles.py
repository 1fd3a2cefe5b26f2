"""Layers on disk with their overviews, read back by window, zoom and zone.

A table is partitioned by layer, level, island and strip (a band of rows) and sorted by tile, so that a
window reads the folders of its strips and skips row groups by tile, and a join with spans prunes strips
while it runs: the strips that the spans have are known before the cells are listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.functions.grid import km2, row_area
from terrafold.operators.pyramid import pyramid
from terrafold.operators.spans import spans, zone_areas

TILE = 256
#: Rows of a strip: sixteen tiles.
STRIP = 4096


def placed(cells: DataFrame, strip: int = STRIP) -> DataFrame:
    """cells with their strip and tile."""
    return cells.withColumns({"strip": F.floor(F.col("r") / strip).cast("int"), "tile": F.floor(F.col("r") / TILE) * 1_000_000 + F.floor(F.col("c") / TILE)})


def write_layers(cells: DataFrame, path: str, levels: int = 0, how: str = "nearest", strip: int = STRIP) -> None:
    """Cells (layer, island, r, c, v) and their overviews up to a level, in place of what the path held."""
    base = cells.select("layer", "island", "r", "c", F.col("v").cast("double").alias("v"))
    every = base.withColumn("level", F.lit(0))
    if levels:
        every = every.unionByName(pyramid(base, levels, how, ["layer", "island"]).withColumn("v", F.col("v").cast("double")))
    keys = ["layer", "level", "island", "strip"]
    placed(every, strip).repartition(*keys, "tile").sortWithinPartitions(*keys, "tile", "r", "c").write.mode("overwrite").partitionBy(*keys).parquet(path)


def layer(spark: SparkSession, path: str, name: str, level: int = 0, island: str | None = None) -> DataFrame:
    """Cells of one layer and level, of one island or of all; only their folders are read."""
    table = spark.read.parquet(path).where((F.col("layer") == name) & (F.col("level") == level))
    return table if island is None else table.where(F.col("island") == island)


def window(spark: SparkSession, path: str, name: str, island: str, rows: tuple[int, int], cols: tuple[int, int], level: int = 0, strip: int = STRIP) -> DataFrame:
    """r, c, v of an inclusive window, in pixels of the level."""
    tiles = [r * 1_000_000 + c for r in range(rows[0] // TILE, rows[1] // TILE + 1) for c in range(cols[0] // TILE, cols[1] // TILE + 1)]
    held = layer(spark, path, name, level, island).where(F.col("strip").between(rows[0] // strip, rows[1] // strip) & F.col("tile").isin(tiles))
    return held.where(F.col("r").between(*rows) & F.col("c").between(*cols)).select("r", "c", "v")


def zonal_stored(spark: SparkSession, path: str, name: str, vertices: DataFrame, island: str | None = None, label: str = "built", strip: int = STRIP) -> DataFrame:
    """zone, {label}_km2, zone_km2, share_pct of a stored layer's cells, read by strips that the zones touch.

    Spans meet cells by strip, tile and row; long spans are cut at tiles first.
    """
    over = spans(vertices)
    tile = lambda c: F.floor(F.col(c) / TILE).cast("int")
    cut = over.select("zone", F.col("r").alias("sr"), "c0", "c1", F.floor(F.col("r") / strip).cast("int").alias("strip"), F.explode(F.sequence(tile("c0"), tile("c1"))).alias("st"))
    cut = cut.withColumn("tile", F.floor(F.col("sr") / TILE) * 1_000_000 + F.col("st"))
    # One number per strip of the grid, so it is broadcast whatever the zones, and prunes the folders of the others.
    strips = F.broadcast(cut.select("strip").where("strip >= 0").distinct())
    cells = layer(spark, path, name, 0, island).join(strips, "strip", "left_semi")
    held = cells.join(cut, ["strip", "tile"]).where((F.col("r") == F.col("sr")) & F.col("c").between(F.col("c0"), F.col("c1")))
    sums = held.groupBy("zone").agg(F.sum(row_area(F.col("r"))).alias("m2"))
    both = zone_areas(over).join(sums, "zone", "left").withColumn("m2", F.coalesce("m2", F.lit(0.0)))
    return both.select("zone", km2(F.col("m2")).alias(f"{label}_km2"), km2(F.col("zone_m2")).alias("zone_km2"), F.round(100 * F.col("m2") / F.col("zone_m2"), 4).alias("share_pct"))
