"""Geography markup by element: files are split at the end of an element, and each element is parsed under a schema.

A reader that takes a file as one string cannot be split; here the closing tag separates records of
Spark's text source, so a file of any size is read by many tasks, and from_xml binds each record to the
schema, by name and without namespaces. What cannot be parsed, or is not closed, is a row of its own with
its text in malformed and nulls elsewhere; nothing is dropped.

Defined cases: an element that a schema field does not have is null; elements without the tag's start
(headers, trailers) are no rows; entities are resolved; repeated fields need an array in the schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.sources.feeds import year_of

# The building element and its fields, without namespaces.
BUILDING = "bu-ext2d:Building"
_RING = "struct<LinearRing: struct<posList: struct<_VALUE: string>>>"
BUILDING_SCHEMA = (
    "_id string, beginLifespanVersion string, conditionOfConstruction string, currentUse string, "
    "dateOfConstruction struct<DateOfEvent: struct<beginning: string, `end`: string>>, "
    "officialArea struct<OfficialArea: struct<value: struct<_VALUE: string, _uom: string>>>, "
    f"geometry struct<Surface: struct<patches: struct<PolygonPatch: array<struct<exterior: {_RING}, interior: array<{_RING}>>>>>>")


def elements(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """file, malformed and the fields of schema of every element with that (prefixed) tag below path."""
    close, start = f"</{tag}>", f"<{tag}[ >/\\t\\r\\n]"
    records = spark.read.option("lineSep", close).text(path).select(F.col("_metadata.file_path").alias("file"), F.split("value", f"(?={start})", -1).alias("parts"))
    each = records.select("file", F.size("parts").alias("n"), F.posexplode("parts").alias("k", "body")).where(F.col("body").rlike(f"^{start}"))
    # Only the last start of a record is closed by its end, unless the file ends there.
    closed = F.concat("body", F.lit(close))
    options = {"rowTag": tag, "ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"}
    parsed = F.from_xml(F.when(F.col("k") == F.col("n") - 1, closed).otherwise(F.col("body")), f"{schema}, malformed string", options)
    return each.select("file", parsed.alias("e")).select("file", "e.*")


def _first_digits(text: Column, n: int) -> Column:
    return F.nullif(F.regexp_extract(text, rf"^(\d{{{n}}})", 1), F.lit("")).cast("int")


def building_records(found: DataFrame) -> DataFrame:
    """id, year (0 without a date, held to the first year of the encoding), begun, ended, begun_year, life, condition, use, area_m2, municipality, malformed.

    begun and ended are dates only if both are (a two-digit year is none); the area counts in m2 only.
    municipality is the last five-digit code in the file's path that stands between dots, slashes or "=".
    """
    begin, end = F.col("dateOfConstruction.DateOfEvent.beginning"), F.col("dateOfConstruction.DateOfEvent.end")
    day = lambda x: F.regexp_extract(x, r"^\d{4}-\d{2}-\d{2}", 0)
    dated = (day(begin) != "") & (day(end) != "")
    value = F.col("officialArea.OfficialArea.value")
    return found.select(
        F.col("_id").alias("id"), year_of(F.coalesce(begin, F.lit(""))).alias("year"), F.when(dated, day(begin)).alias("begun"), F.when(dated, day(end)).alias("ended"),
        F.when(dated, _first_digits(begin, 4)).alias("begun_year"), _first_digits(F.col("beginLifespanVersion"), 4).alias("life"),
        F.col("conditionOfConstruction").alias("condition"), F.col("currentUse").alias("use"), F.when(value["_uom"] == "m2", F.regexp_extract(value["_VALUE"], r"^\d+", 0).try_cast("bigint")).alias("area_m2"),
        F.regexp_extract("file", r".*[./=](\d{5})(?=[./]|$)", 1).alias("municipality"), F.col("malformed").isNotNull().alias("malformed"))


def building_vertices(found: DataFrame) -> DataFrame:
    """id, ring (from 0, outer and inner ones alike), seq, x, y of the elements' polygons, each ring without its closing vertex; cells are inside by the even-odd rule."""
    patches = F.col("geometry.Surface.patches.PolygonPatch")
    one = lambda r: r["LinearRing"]["posList"]["_VALUE"]
    of = F.flatten(F.transform(patches, lambda p: F.concat(F.array(one(p["exterior"])), F.coalesce(F.transform(p["interior"], one), F.array().cast("array<string>")))))
    # The condition stands in what is exploded: a filter would be pushed below the parser, and every element parsed twice.
    sound = F.when(F.col("malformed").isNull(), of)
    rings = found.select(F.col("_id").alias("id"), F.posexplode(sound).alias("ring", "text")).where("text is not null")
    numbers = F.transform(F.split(F.trim("text"), r"\s+"), lambda x: x.cast("double"))
    n = F.floor(F.size("numbers") / 2)
    rings = rings.withColumn("numbers", numbers).withColumn("points", F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
        F.get("numbers", (2 * i).cast("int")).alias("x"), F.get("numbers", (2 * i + 1).cast("int")).alias("y"))))
    closed = (F.size("points") > 1) & F.get("points", 0).eqNullSafe(F.element_at("points", -1))
    open_ = F.when(closed, F.slice("points", F.lit(1), F.size("points") - 1)).otherwise(F.col("points"))
    return rings.select("id", "ring", F.posexplode(open_).alias("seq", "p")).select("id", "ring", "seq", "p.x", "p.y")


def write_buildings(rows: DataFrame, path: str, files: str) -> None:
    """A feed of building elements from rows (id, beginning, ending, life, condition, use, area, uom, positions, broken and the column files): one folder per file name, for tests and queries.

    broken (null: none) takes the place of the closing tag's line.
    """
    field = lambda name, value: F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"<{name}>"), F.replace(value.cast("string"), F.lit("&"), F.lit("&amp;")), F.lit(f"</{name}>\n")))
    c = F.col
    inner = field("bu-core2d:beginning", c("beginning")), field("bu-core2d:end", c("ending"))
    ring = F.concat(F.lit('<gml:exterior><gml:LinearRing><gml:posList srsDimension="2">'), c("positions"), F.lit("</gml:posList></gml:LinearRing></gml:exterior>"))
    body = F.concat(
        F.lit('<gml:featureMember>\n<bu-ext2d:Building gml:id="'), c("id"), F.lit('">\n'), field("bu-core2d:beginLifespanVersion", c("life")), field("bu-core2d:conditionOfConstruction", c("condition")),
        F.lit("<bu-core2d:dateOfConstruction><bu-core2d:DateOfEvent>\n"), *inner, F.lit("</bu-core2d:DateOfEvent></bu-core2d:dateOfConstruction>\n"), field("bu-ext2d:currentUse", c("use")),
        F.lit('<bu-ext2d:officialArea><bu-ext2d:OfficialArea><bu-ext2d:value uom="'), c("uom"), F.lit('">'), c("area").cast("string"), F.lit("</bu-ext2d:value></bu-ext2d:OfficialArea></bu-ext2d:officialArea>\n"),
        F.lit("<bu-core2d:geometry><gml:Surface><gml:patches><gml:PolygonPatch>"), ring, F.lit("</gml:PolygonPatch></gml:patches></gml:Surface></bu-core2d:geometry>\n"),
        F.coalesce("broken", F.lit("</bu-ext2d:Building>\n</gml:featureMember>")))
    rows.select(c(files).alias("file"), body.alias("value")).write.mode("overwrite").partitionBy("file").text(path)
