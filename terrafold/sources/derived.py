"""Relations derived from the star-schema tables, so that an SQL engine can check every operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: zone, ring, seq, x, y in pixel coordinates: a triangle, a box, a box with a hole.
VERTICES = [
    ("tri", 0, 0, 10.0, 10.0), ("tri", 0, 1, 190.0, 40.0), ("tri", 0, 2, 60.0, 180.0),
    ("box", 0, 0, 100.0, 100.0), ("box", 0, 1, 180.0, 100.0), ("box", 0, 2, 180.0, 160.0), ("box", 0, 3, 100.0, 160.0),
    ("ring", 0, 0, 20.0, 120.0), ("ring", 0, 1, 80.0, 120.0), ("ring", 0, 2, 80.0, 190.0), ("ring", 0, 3, 20.0, 190.0),
    ("ring", 1, 0, 40.0, 140.0), ("ring", 1, 1, 60.0, 140.0), ("ring", 1, 2, 60.0, 170.0), ("ring", 1, 3, 40.0, 170.0),
]
HEIGHT = WIDTH = 200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vertices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(VERTICES, "zone string, ring int, seq int, x double, y double")


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """zone, ring, seq, x, y: one four-sided polygon per supplier, its left edge slanted."""
    k = F.col("s_suppkey")
    x0, y0, h, w, lean = (k * 53) % 170, (k * 37) % 180, 4 + k % 9, 6 + k % 11, k % 5
    corners = F.array(*[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in ((x0, y0), (x0 + lean, y0 + h), (x0 + w, y0 + h), (x0 + w, y0))])
    each = table(spark, sf_dir, "supplier").select(F.concat(F.lit("p"), k.cast("string")).alias("zone"), F.lit(0).alias("ring"), F.posexplode(corners).alias("seq", "p"))
    return each.select("zone", "ring", "seq", "p.x", "p.y")


def _state() -> F.Column:
    return F.when(F.col("l_returnflag") == "R", 255).otherwise(F.year("l_shipdate") - 1899).cast("int")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """r, c, v: year first built, 255 for undated."""
    return table(spark, sf_dir, "lineitem").groupBy(
        ((F.col("l_orderkey") * 7919) % HEIGHT).cast("int").alias("r"), ((F.col("l_partkey") * 104729) % WIDTH).cast("int").alias("c"),
    ).agg(F.min(_state()).alias("v"))


def cells2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """r, c, v of a second product on the same grid."""
    return table(spark, sf_dir, "lineitem").groupBy(
        ((F.col("l_suppkey") * 7919 + F.col("l_orderkey")) % HEIGHT).cast("int").alias("r"),
        ((F.col("l_linenumber") * 31 + F.col("l_partkey")) % WIDTH).cast("int").alias("c"),
    ).agg(F.min(_state()).alias("v"))


def percents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """r, c, v: a percentage with codes above 100."""
    return table(spark, sf_dir, "lineitem").groupBy(
        ((F.col("l_orderkey") * 7919) % HEIGHT).cast("int").alias("r"), ((F.col("l_partkey") * 104729) % WIDTH).cast("int").alias("c"),
    ).agg(F.max(((F.col("l_quantity") * 5) % 120).cast("int")).alias("v"))


def confidences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """r, c, v: a confidence in per cent, with codes above 100, on the second product's cells."""
    return table(spark, sf_dir, "lineitem").groupBy(
        ((F.col("l_suppkey") * 7919 + F.col("l_orderkey")) % HEIGHT).cast("int").alias("r"),
        ((F.col("l_linenumber") * 31 + F.col("l_partkey")) % WIDTH).cast("int").alias("c"),
    ).agg(F.min(((F.col("l_quantity") * 3 + F.col("l_linenumber")) % 130).cast("int")).alias("v"))


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """grp, key, total: cumulative order values per priority and year, with gaps and uneven ends."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("grp"), F.year("o_orderdate").alias("key"), "o_totalprice")
    from pyspark.sql import Window

    sums = o.groupBy("grp", "key").agg(F.sum("o_totalprice").alias("s"))
    run = F.sum("s").over(Window.partitionBy("grp").orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    return sums.select("grp", "key", F.round(run, 2).alias("total")).where("(key + length(grp)) % 3 != 0")


def epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, epoch: first epoch (1..20) in which a user is seen."""
    epoch = (F.floor((F.dayofmonth("ts") - 1) / 1.5) + 1).cast("int")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.min(epoch).alias("epoch"))


_V = "min(CASE WHEN l_returnflag='R' THEN 255 ELSE CAST(year(l_shipdate) AS INT)-1899 END)"
PX = "8.983152841195216e-05::DOUBLE"

#: The same relations in SQL.
SQL = {
    "cell": f"cell AS (SELECT CAST((l_orderkey*7919)%200 AS INT) AS r, CAST((l_partkey*104729)%200 AS INT) AS c, {_V} AS v FROM lineitem GROUP BY 1,2)",
    "cell2": f"cell2 AS (SELECT CAST((l_suppkey*7919+l_orderkey)%200 AS INT) AS r, CAST((l_linenumber*31+l_partkey)%200 AS INT) AS c, {_V} AS v FROM lineitem GROUP BY 1,2)",
    "pct": "pct AS (SELECT CAST((l_orderkey*7919)%200 AS INT) AS r, CAST((l_partkey*104729)%200 AS INT) AS c, max(CAST(trunc((l_quantity*5)%120) AS INT)) AS v FROM lineitem GROUP BY 1,2)",
    "conf": "conf AS (SELECT CAST((l_suppkey*7919+l_orderkey)%200 AS INT) AS r, CAST((l_linenumber*31+l_partkey)%200 AS INT) AS c, min(CAST(trunc((l_quantity*3+l_linenumber)%130) AS INT)) AS v FROM lineitem GROUP BY 1,2)",
    "vert": "vert AS (SELECT * FROM (VALUES " + ",".join(f"('{z}',{k},{s},{x},{y})" for z, k, s, x, y in VERTICES) + ") AS t(zone, ring, seq, x, y))",
    "plot": "plot AS (SELECT s_suppkey AS k, 'p' || s_suppkey AS zone, (s_suppkey*53)%170 AS x0, (s_suppkey*37)%180 AS y0, 4+s_suppkey%9 AS h, 6+s_suppkey%11 AS w, s_suppkey%5 AS lean FROM supplier)",
    "parcel": "parcel AS (SELECT k, zone, CAST(r AS INT) AS r, CAST(c AS INT) AS c FROM (SELECT *, unnest(range(CAST(ceil(x0+(r+0.5::DOUBLE-y0)*lean/h-0.5::DOUBLE) AS BIGINT), x0+w)) AS c FROM (SELECT *, unnest(range(y0, y0+h)) AS r FROM plot)))",
    "edge": "edge AS (SELECT zone, x::DOUBLE x1, y::DOUBLE y1, coalesce(lead(x) OVER w, first_value(x) OVER w)::DOUBLE x2, coalesce(lead(y) OVER w, first_value(y) OVER w)::DOUBLE y2 FROM vert WINDOW w AS (PARTITION BY zone, ring ORDER BY seq))",
    "series": "series AS (SELECT * FROM (SELECT grp, key, round(sum(s) OVER (PARTITION BY grp ORDER BY key), 2) AS total FROM (SELECT o_orderpriority AS grp, CAST(year(o_orderdate) AS INT) AS key, sum(o_totalprice) AS s FROM orders GROUP BY 1,2)) WHERE (key + length(grp)) % 3 != 0)",
    "epoch": "epoch AS (SELECT user_id, CAST(min(floor((day(ts)-1)/1.5)+1) AS INT) AS epoch FROM events GROUP BY 1)",
    "grid": "grid AS (SELECT CAST(r AS INT) AS r, CAST(c AS INT) AS c FROM range(200) a(r), range(200) b(c))",
}


def area(row: str = "r") -> str:
    return f"({PX}*111132*{PX}*111320*cos(radians(28.1 - {PX}*({row}+0.5))))"


#: Even-odd ray casting of pixel centres: an independent way to what the spans give.
INSIDE = """(SELECT count(*) FROM edge e WHERE e.zone = z.zone AND least(e.y1,e.y2) <= g.r+0.5 AND greatest(e.y1,e.y2) > g.r+0.5
 AND e.x1 + (g.r+0.5-e.y1)*(e.x2-e.x1)/(e.y2-e.y1) <= g.c+0.5) % 2 = 1"""
SQL["zone"] = f"zone AS (SELECT z.zone, g.r, g.c FROM (SELECT DISTINCT zone FROM vert) z, grid g WHERE {INSIDE})"
_NEEDS = {"parcel": ["plot"], "edge": ["vert"], "zone": ["vert", "edge", "grid"]}


def sql(names: str, body: str) -> str:
    """WITH the named relations and what they need, then the body."""
    order: list[str] = []
    for n in names.split():
        for m in [*_NEEDS.get(n, []), n]:
            if m not in order:
                order.append(m)
    return "WITH " + ",\n".join(SQL[n] for n in order) + "\n" + body
