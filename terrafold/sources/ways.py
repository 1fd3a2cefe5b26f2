"""Infrastructure from map extracts: JSON elements with tags and geometry become segments and building polygons."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ELEMENTS = "elements array<struct<type: string, id: bigint, tags: map<string, string>, geometry: array<struct<lat: double, lon: double>>>>"


def read_ways(spark: SparkSession, path: str) -> DataFrame:
    """id, closed, points (x, y: longitude and latitude, in order) of every element of the extracts below path that has two points or more.

    closed: a tagged building whose first and last of four points or more are the same; anything else is a
    line. Extracts are one document each and files of one request, so a file is one record; elements are
    dealt afterwards.
    """
    found = spark.read.schema(ELEMENTS).option("multiLine", "true").option("mode", "FAILFAST").json(path).select(F.explode("elements").alias("e"))
    points = F.transform(F.filter("e.geometry", lambda p: p["lat"].isNotNull() & p["lon"].isNotNull()), lambda p: F.struct(p["lon"].alias("x"), p["lat"].alias("y")))
    rows = found.select(F.col("e.id").alias("id"), F.col("e.tags")["building"].isNotNull().alias("building"), points.alias("points")).where(F.size("points") >= 2)
    ring = F.col("building") & (F.size("points") >= 4) & (F.element_at("points", 1) == F.element_at("points", -1))
    return rows.select("id", ring.alias("closed"), "points")


def segments(ways: DataFrame) -> DataFrame:
    """id, x1, y1, x2, y2: the ways' pieces between neighbouring points, of lines and polygons alike."""
    pairs = F.zip_with(F.slice("points", F.lit(1), F.size("points") - 1), F.slice("points", F.lit(2), F.size("points") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    each = ways.select("id", F.explode(pairs).alias("s"))
    return each.select("id", F.col("s.a.x").alias("x1"), F.col("s.a.y").alias("y1"), F.col("s.b.x").alias("x2"), F.col("s.b.y").alias("y2"))


def rings(ways: DataFrame) -> DataFrame:
    """zone (the id as text), ring, seq, x, y of the polygons, without their closing points."""
    open_ = ways.where("closed").select(F.col("id").cast("string").alias("zone"), F.lit(0).alias("ring"), F.posexplode(F.slice("points", F.lit(1), F.size("points") - 1)).alias("seq", "p"))
    return open_.select("zone", "ring", "seq", "p.x", "p.y")
