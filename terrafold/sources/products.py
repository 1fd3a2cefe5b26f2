"""Source products: registries, tiles, discovery, windows, records; and the readers of tables that feed them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrafold.functions.encoding import observation_kind
from terrafold.functions.grid import laea

# The published built-surface epochs and the origin of their tile grid.
EPOCHS = [1975, 1980, 1985, 1990, 1995, 2000, 2005, 2010, 2015, 2020, 2025, 2030]
TILE_LON0, TILE_LAT0, TILE_DEG = -180.00791656502537, 89.09958341912107, 10
# Fixed values of the land-cover products: no data, resolution in metres, kind, measure.
PRODUCTS = {
    "ibu_2018": (240, 10, "status", "extent"),
    "ibu_2021": (255, 10, "status", "extent"),
    "ibu_2024": (255, 10, "status", "extent"),
    "ibuc_2018_2021": (255, 20, "change", "change"),
    "ibuc_2021_2024": (255, 20, "change", "change"),
    "imd_2024": (255, 10, "density", "surface"),
    "imdcl_2024": (255, 10, "confidence", "confidence"),
}
#: How each encoding is summed over zones.
ZONAL_KIND = {"year first built": "binary", "epoch first built": "binary", "binary": "binary", "percent": "fraction", "amount": "amount"}


def product(name: str) -> tuple[int, int, str, str]:
    if name not in PRODUCTS:
        raise ValueError(f"unknown product {name}; expected one of {sorted(PRODUCTS)}")
    return PRODUCTS[name]


def registry(spark: SparkSession) -> DataFrame:
    """name, nodata, resolution_m, kind, measure of all products."""
    return spark.createDataFrame([(k, *v) for k, v in PRODUCTS.items()], "name string, nodata int, resolution_m int, kind string, measure string")


def zonal_kind(encoding: str) -> str:
    if encoding not in ZONAL_KIND:
        raise ValueError(f"no zonal sum for {encoding}")
    return ZONAL_KIND[encoding]


def built_mask(cells: DataFrame, name: str, year: int | None = None, built: int = 1) -> DataFrame:
    """Built cells of a status product (value built), or of a year product up to a year; other kinds raise."""
    if name == "years":
        return cells.where((F.col("v") > 0) & (F.lit(year is None) | (F.col("v") <= F.lit(year))))
    if product(name)[2] != "status":
        raise ValueError(f"{name} is no status product")
    return cells.where(F.col("v") == built)


def distinct_files(paths: DataFrame) -> DataFrame:
    """name, path: each file name once, by its last path, as copies of a tile have the same name."""
    named = paths.withColumn("name", F.element_at(F.split("path", "/"), -1))
    return named.groupBy("name").agg(F.max("path").alias("path"))


def epoch_tiles(boxes: DataFrame, epoch: int) -> DataFrame:
    """id, epoch, row, col, kind of the tiles that boxes (id, x0, y0, x1, y1; degrees) meet; an unpublished epoch raises."""
    if epoch not in EPOCHS:
        raise ValueError(f"epoch {epoch} is not published; choose from {EPOCHS}")
    row = lambda lat: (F.floor((F.lit(TILE_LAT0) - F.col(lat)) / TILE_DEG) + 1).cast("int")
    col = lambda lon: (F.floor((F.col(lon) - TILE_LON0) / TILE_DEG) + 1).cast("int")
    each = boxes.select("id", F.explode(F.sequence(row("y1"), row("y0"))).alias("row"), "x0", "x1").select("id", "row", F.explode(F.sequence(col("x0"), col("x1"))).alias("col"))
    return each.select("id", F.lit(epoch).alias("epoch"), "row", "col", observation_kind(F.lit(epoch)).alias("kind"))


def tile_box(row: Column, col: Column) -> list[Column]:
    """lon_min, lat_min, lon_max, lat_max of a tile."""
    lon, lat = TILE_LON0 + TILE_DEG * (col - 1), TILE_LAT0 - TILE_DEG * (row - 1)
    return [lon.alias("lon_min"), (lat - TILE_DEG).alias("lat_min"), (lon + TILE_DEG).alias("lon_max"), lat.alias("lat_max")]


def existing(tiles: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    """Tiles that the list of files has."""
    return tiles.join(files.select(*keys).distinct(), keys, "left_semi")


def describe(cells: DataFrame) -> DataFrame:
    """columns, rows, cells, least, most of a cell relation."""
    shape = F.max("r") - F.min("r") + 1, F.max("c") - F.min("c") + 1
    return cells.agg(shape[0].alias("rows"), shape[1].alias("columns"), F.count("*").alias("cells"), F.min("v").alias("least"), F.max("v").alias("most"))


def projected_window(boxes: DataFrame, points: int = 21) -> DataFrame:
    """id and the bounds in European equal-area metres of boxes in degrees, each edge cut into so many points."""
    steps = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda k: k / float(points - 1))
    across = lambda t: F.col("x0") + (F.col("x1") - F.col("x0")) * t
    along = lambda t: F.col("y0") + (F.col("y1") - F.col("y0")) * t
    edges = F.flatten(F.transform(steps, lambda t: F.array(
        *[F.struct(x.alias("lon"), y.alias("lat")) for x, y in ((across(t), F.col("y0")), (across(t), F.col("y1")), (F.col("x0"), along(t)), (F.col("x1"), along(t)))])))
    p = boxes.select("id", F.explode(edges).alias("p"))
    x, y = laea(F.col("p.lon"), F.col("p.lat"))
    return p.groupBy("id").agg(*[F.round(f(v), 3).alias(n) for f, v, n in ((F.min, x, "x_min"), (F.min, y, "y_min"), (F.max, x, "x_max"), (F.max, y, "y_max"))])


def without_nodata(cells: DataFrame, name: str) -> DataFrame:
    return cells.where(F.col("v") != product(name)[0])


def greenhouses(parcels: DataFrame, field: str = "technique", value: str = "Invernadero") -> DataFrame:
    """Parcels grown under cover; a table without the field raises."""
    if field not in parcels.columns:
        raise ValueError(f"no field {field}; the table has {parcels.columns}")
    return parcels.where(F.col(field) == value)


def complete_zones(zones: DataFrame, expected: list[str]) -> DataFrame:
    """zones, if it has all expected names; a missing one raises. The list is short, the zones are counted by name."""
    names = {r.name for r in zones.where(F.col("name").isin(expected)).select("name").distinct().collect()}
    missing = sorted(set(expected) - names)
    if missing:
        raise ValueError(f"zones missing: {missing}")
    return zones


def extents(vertices: DataFrame, given: DataFrame) -> DataFrame:
    """code, box: the given extent (code, x0, y0, x1, y1), else that of the vertices (code, x, y), to six places."""
    own = vertices.groupBy("code").agg(F.min("x").alias("vx0"), F.min("y").alias("vy0"), F.max("x").alias("vx1"), F.max("y").alias("vy1"))
    held = own.join(given, "code", "left")
    return held.select("code", *[F.round(F.coalesce(n, f"v{n}"), 6).alias(n) for n in ("x0", "y0", "x1", "y1")])


def near_ways(cells: DataFrame, ways: DataFrame, metres: float, north_m: float, east_m: float) -> DataFrame:
    """r, c of cells within so many metres of a way's segment (x1, y1, x2, y2; pixel coordinates): a distance test instead of a buffer.

    A segment meets the cells of its box, grown by the reach; a long one is cut first, so boxes stay small.
    """
    long = F.greatest(F.lit(1), F.ceil(F.greatest(F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1"))) / 8)).cast("int")
    cut = ways.withColumn("n", long).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    at = lambda a, b, k: F.col(a) + (F.col(b) - F.col(a)) * k / F.col("n")
    part = cut.select(at("x1", "x2", F.col("k")).alias("x1"), at("y1", "y2", F.col("k")).alias("y1"), at("x1", "x2", F.col("k") + 1).alias("x2"), at("y1", "y2", F.col("k") + 1).alias("y2"))
    span = lambda a, b, reach: F.sequence((F.floor(F.least(a, b) - reach)).cast("int"), (F.floor(F.greatest(a, b) + reach)).cast("int"))
    boxed = part.withColumn("r", F.explode(span("y1", "y2", metres / north_m))).withColumn("c", F.explode(span("x1", "x2", metres / east_m)))
    px, py = (F.col("c") + 0.5 - F.col("x1")) * east_m, (F.col("r") + 0.5 - F.col("y1")) * north_m
    dx, dy = (F.col("x2") - F.col("x1")) * east_m, (F.col("y2") - F.col("y1")) * north_m
    t = F.least(F.greatest(F.coalesce((px * dx + py * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    near = boxed.where(F.hypot(px - t * dx, py - t * dy) <= metres).select("r", "c").distinct()
    return cells.join(near, ["r", "c"], "left_semi")


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header, or JSON documents (.json), under a schema; a column that the schema does not name raises for CSV."""
    if path.endswith(".json"):
        return spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(path)
    return spark.read.schema(schema).option("header", "true").option("enforceSchema", "false").option("mode", "FAILFAST").csv(path)


def cells_of_year(spark: SparkSession, path: str, name: str, year: int | None = None) -> DataFrame:
    """Cells of one raster of a table partitioned by name and year; only its folders are read."""
    table = spark.read.parquet(path).where(F.col("name") == name)
    return (table if year is None else table.where(F.col("year") == year)).drop("name", "year")


def flat_index(index: DataFrame | None, links: DataFrame, root: str) -> DataFrame:
    """item, href of a catalogue: from its flat index, or, without one, by two joins of its links (src, rel, href) from the root."""
    if index is not None:
        return index.select("item", "href")
    children = links.where((F.col("src") == root) & (F.col("rel") == "child")).select(F.col("href").alias("src"))
    items = links.where("rel = 'item'").join(children, "src", "left_semi").select(F.col("href").alias("src"))
    return links.where("rel = 'asset'").join(items, "src").select(F.col("src").alias("item"), "href")


def zone_counts(features: DataFrame) -> DataFrame:
    """file, features: how many a hand-made zone file has."""
    return features.groupBy("file").agg(F.count("*").alias("features"))


def presence(keys: DataFrame, listing: DataFrame) -> DataFrame:
    """key, state: present, absent, or unknown where the listing (key, found; null: not asked) does not tell. Absence is never inferred."""
    seen = keys.join(listing, "key", "left")
    return seen.select("key", F.when(F.col("found"), "present").when(~F.col("found"), "absent").otherwise("unknown").alias("state"))


def all_of(frames: list[DataFrame]) -> DataFrame:
    """One table of many, by column names; what a table lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def schema_problems(df: DataFrame, required: dict[str, str]) -> list[str]:
    """What a table lacks of the required columns and types."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [f"{name}: {have.get(name, 'missing')}, not {kind}" for name, kind in required.items() if have.get(name) != T._parse_datatype_string(kind).simpleString()]
