"""Published statistics, merged on disk: a run replaces what it computed and leaves the rest.

Records are partitioned by what names them; a commit overwrites only the partitions that it holds rows
of, through a staging folder, so a partial run deletes nothing, a repeated one changes nothing, and one
that fails leaves the old values. Two commits at a time must not hold the same partition; the later one
stands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("layer", "island")


def commit(records: DataFrame, path: str, keys: tuple[str, ...] = KEYS) -> None:
    """Put records in place of those of the same keys. A null key raises, since a folder cannot name it."""
    named = records
    for k in keys:
        named = named.withColumn(k, F.when(F.col(k).isNull(), F.raise_error(F.lit(f"a record without {k}")).cast(records.schema[k].dataType)).otherwise(F.col(k)))
    named.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def published(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All records under the given schema, its columns in order."""
    return spark.read.schema(schema).parquet(path)


def document(records: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """layer, json: one document per first key, its records by the second one, in order."""
    first, second = keys
    rest = [c for c in records.columns if c not in keys]
    listed = records.groupBy(first).agg(F.sort_array(F.collect_list(F.struct(F.col(second).cast("string").alias("k"), F.struct(*rest).alias("v")))).alias("all"))
    return listed.select(first, F.to_json(F.map_from_entries("all")).alias("json"))
