"""Scratch tables in the folder that driver and executors share, rows chosen by key, and bounded Arrow batches."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

KEY = "spark.checkpoint.dir"
#: Rows and bytes of an Arrow batch, for sessions that do not set them.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "16777216"}


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under spark.checkpoint.dir. Where that is unset, a local session (tests) gets a local folder; a cluster raises."""
    root = spark.conf.get(KEY, None) or spark.sparkContext.getConf().get(KEY)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"{KEY} must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="terrafold-")
        spark.conf.set(KEY, root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write the table to the shared folder and read it again."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete scratch tables that nothing reads any more."""
    for df in tables:
        path = getattr(df, "scratch_path", None)
        if path:
            where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def bounded(docs: DataFrame) -> DataFrame:
    """docs, after holding the session's Arrow batches to BATCH, so that long texts do not add up; a user's own settings stay."""
    conf = docs.sparkSession.conf
    for key, value in BATCH.items():
        if conf.get(key, None) is None:
            conf.set(key, value)
    return docs


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def row_key(doc_id: Column, text: Column) -> dict[str, Column]:
    """What names a row of documents: its doc_id (null apart) and a hash of its text."""
    return {"none": doc_id.isNull(), "own": F.coalesce(doc_id.cast("long"), F.lit(0).cast("long")), "raw": F.xxhash64(F.coalesce(text, F.lit("")))}


def ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows with a rank from 1 among the rows of equal keys, in no order; rows must be a written table.

    Counts by key and input partition come first, so that no task ranks all rows of a hot key.
    """
    rows = rows.withColumn("id", F.monotonically_increasing_id())
    rows = rows.withColumn("part", F.shiftright("id", 33))
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy(*keys, "part").agg(F.count("*").alias("n")).select(*keys, "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy(*keys, "part").orderBy("id"))
    return rows.withColumn("within", within).join(base, [*keys, "part"]).withColumn("rank", F.col("base") + F.col("within")).drop("id", "part", "within", "base")


def repeated(docs: DataFrame, keys: dict[str, Column], chosen: DataFrame) -> DataFrame:
    """The rows of docs, each as often as chosen says, with all their columns whatever their names.

    chosen has the columns of keys, unique, and copies (rows of that key), high, most, rest: high of those
    rows stand most times, the others rest times. The narrow side is hashed, so texts are dealt once and
    not sorted; only keys of several rows are ranked.
    """
    names = list(keys)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(k) for k, c in keys.items()])
    chosen = written(chosen.where((F.col("most") > 0) | (F.col("rest") > 0)), "chosen")
    alike = F.col("high") == F.col("copies")
    found = rows.join(chosen.where(alike).select(*names, F.col("most").alias("n")).hint("shuffle_hash"), names).select("row", "n")
    if chosen.where(~alike).head(1):
        held = written(rows.join(chosen.where(~alike).hint("shuffle_hash"), names), "held")
        times = F.when(F.col("rank") <= F.col("high"), F.col("most")).otherwise(F.col("rest"))
        found = found.union(ranked(held, names).select("row", times.alias("n")))
    return found.where("n > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy")).select("row.*")
