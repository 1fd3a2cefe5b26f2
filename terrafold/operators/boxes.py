"""Boxes that overlap, by tiles; a full tile is shared out in pairs of blocks, so that no task grows with the fullest tile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 2048


def overlapping(boxes: DataFrame, size: float, block: int = BLOCK) -> DataFrame:
    """a, b, strict of the pairs a < b of boxes (unique id, x0, x1, y0, y1) that share a point; strict: an inner one.

    A box is in every tile that it meets, and a pair counts in the tile of the first corner of what it shares.
    A tile's boxes are dealt to blocks of about block boxes, and each pair of blocks is a cell of its own, of
    bounded work; what the boxes have in pairs is the square of their number where they lie on each other.
    """
    lo = lambda c: F.floor(F.col(c) / size)
    tile = ["bx", "by"]
    each = boxes.select("id", "x0", "x1", "y0", "y1", F.explode(F.sequence(lo("x0"), lo("x1"))).alias("bx"), F.sequence(lo("y0"), lo("y1")).alias("ys")).withColumn("by", F.explode("ys")).drop("ys")
    blocks = each.groupBy(*tile).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = each.join(blocks, tile).withColumn("k", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # Cells are many and small in bytes: a fixed number of partitions keeps them from being put together by size.
    parts, cell = int(boxes.sparkSession.conf.get("spark.sql.shuffle.partitions")), [*tile, "i", "j"]
    p = dealt.select("*", F.col("k").alias("i"), F.explode(F.sequence("k", F.col("blocks") - 1)).alias("j")).repartition(parts, *cell).alias("p")
    q = dealt.select("*", F.explode(F.sequence(F.lit(0), "k")).alias("i"), F.col("k").alias("j")).repartition(parts, *cell).alias("q")
    own = (F.col("p.i") < F.col("p.j")) | (F.col("p.id") < F.col("q.id"))
    touch = (F.col("p.x0") <= F.col("q.x1")) & (F.col("q.x0") <= F.col("p.x1")) & (F.col("p.y0") <= F.col("q.y1")) & (F.col("q.y0") <= F.col("p.y1"))
    first = (F.col("p.bx") == F.floor(F.greatest("p.x0", "q.x0") / size)) & (F.col("p.by") == F.floor(F.greatest("p.y0", "q.y0") / size))
    strict = (F.col("p.x0") < F.col("q.x1")) & (F.col("q.x0") < F.col("p.x1")) & (F.col("p.y0") < F.col("q.y1")) & (F.col("q.y0") < F.col("p.y1"))
    met = [F.col(f"p.{c}") == F.col(f"q.{c}") for c in cell] + [touch, first, own]
    return p.join(q.hint("merge"), met).select(F.least("p.id", "q.id").alias("a"), F.greatest("p.id", "q.id").alias("b"), strict.alias("strict"))
