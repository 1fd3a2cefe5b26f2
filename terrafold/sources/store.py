"""Cell tables on disk: partitioned by layer and island, sorted by tile; windows, upserts and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.functions.encoding import is_published

TILE = 256


def tile_id(df: DataFrame) -> DataFrame:
    return df.withColumn("tile_id", F.floor(F.col("r") / TILE) * 1_000_000 + F.floor(F.col("c") / TILE))


def write_cells(cells: DataFrame, path: str) -> None:
    """Parquet by layer and island, rows sorted by tile, so that a window prunes folders and row groups."""
    tiled = tile_id(cells)
    tiled.repartition("layer", "island", "tile_id").sortWithinPartitions("layer", "island", "tile_id", "r", "c").write.mode(
        "overwrite").partitionBy("layer", "island").parquet(path)


def read_window(spark: SparkSession, path: str, layer: str, island: str, rows: tuple[int, int], cols: tuple[int, int]) -> DataFrame:
    """Cells of an inclusive window; the tiles that it meets are part of the pushed-down filter."""
    tiles = [r * 1_000_000 + c for r in range(rows[0] // TILE, rows[1] // TILE + 1) for c in range(cols[0] // TILE, cols[1] // TILE + 1)]
    table = spark.read.parquet(path).where((F.col("layer") == layer) & (F.col("island") == island))
    return table.where(F.col("tile_id").isin(tiles) & F.col("r").between(*rows) & F.col("c").between(*cols)).drop("tile_id")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new, and the rows of old whose keys new does not have."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def merged(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Merge, not replace: per key and column the new value, or the old one where new has none."""
    values = [c for c in old.columns if c not in keys]
    renamed = new.select(*keys, *[F.col(c).alias(f"new_{c}") for c in values])
    joined = old.join(renamed, keys, "full_outer")
    return joined.select(*keys, *[F.coalesce(f"new_{c}", c).alias(c) for c in values])


def changed(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose key or digest the manifest does not have: what an incremental upload sends."""
    return files.join(manifest.select("key", "digest"), ["key", "digest"], "left_anti")


def files_with_digest(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes, sha256 of the files below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(
        "path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def sizes_by_segment(files: DataFrame, segment: int) -> DataFrame:
    """MiB by the n-th part of the path."""
    return files.groupBy(F.get(F.split("path", "/"), F.lit(segment)).alias("part")).agg(F.round(F.sum("bytes") / 1048576.0, 6).alias("mib"))


def write_json(df: DataFrame, path: str) -> None:
    """A small evidence table as JSON lines in one file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A small evidence table as CSV with a header in one file."""
    df.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def item_documents(items: DataFrame) -> DataFrame:
    """path, json of catalogue items (collection, id, x0, y0, x1, y1, properties); links are relative to the item."""
    link = lambda rel, href: F.struct(F.lit(rel).alias("rel"), href.alias("href"))
    body = F.struct(
        F.lit("Feature").alias("type"), F.col("id"), F.array("x0", "y0", "x1", "y1").alias("bbox"), F.col("properties"),
        F.array(link("parent", F.lit("../collection.json")), link("root", F.lit("../../catalog.json"))).alias("links"))
    return items.select(F.concat_ws("/", "collection", "id", F.concat("id", F.lit(".json"))).alias("path"), F.to_json(body).alias("json"))


def runtime_index(items: DataFrame) -> DataFrame:
    """json: one flat document of all items (collection, id, href): a catalogue's worth of rows, by collection."""
    per = items.groupBy("collection").agg(F.sort_array(F.collect_list(F.struct("id", "href"))).alias("items"))
    return per.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("collection", "items"))))).alias("json"))


def facts_module(facts: DataFrame) -> DataFrame:
    """text: a generated module of constants of facts (name, value), by name."""
    line = F.concat(F.lit("export const "), "name", F.lit(" = "), F.format_string("%.3f", "value"), F.lit(";"))
    lines = facts.agg(F.sort_array(F.collect_list(F.struct("name", line.alias("line")))).alias("all"))
    return lines.select(F.array_join(F.transform("all", lambda x: x["line"]), "\n").alias("text"))


def published_size(files: DataFrame) -> DataFrame:
    """mib of what is served (path, bytes): build intermediates do not count."""
    return files.where(is_published(F.element_at(F.split("path", "/"), -1))).agg(F.round(F.coalesce(F.sum("bytes"), F.lit(0)) / 1048576.0, 6).alias("mib"))


def data_version(files: DataFrame) -> DataFrame:
    """version: a digest of the files' paths and digests (path, sha256), whatever their order; sums of hashes, so nothing is collected."""
    pair = [F.xxhash64(F.lit(k), "path", "sha256").cast("decimal(20,0)") for k in (1, 2)]
    sums = files.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(p), F.lit(0)).cast("string").alias(f"s{k}") for k, p in enumerate(pair)])
    return sums.select(F.sha2(F.concat_ws("|", "n", "s0", "s1"), 256).alias("version"))
