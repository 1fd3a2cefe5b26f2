"""Readers of the text and XML sources: feeds, legends, building records, nested JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def feed_links(text: DataFrame) -> DataFrame:
    """code, url from feed documents (text): the first link per five-digit code, by code."""
    links = text.select(F.posexplode(F.regexp_extract_all("text", F.lit('href="([^"]*)"'), 1)).alias("pos", "url"))
    coded = links.withColumn("code", F.regexp_extract("url", r"(\d{5})", 1)).where("code != ''")
    return coded.groupBy("code").agg(F.min_by("url", "pos").alias("url")).orderBy("code")


def legend_entries(text: DataFrame) -> DataFrame:
    """quantity, label of the entries of a style legend, whatever the order of attributes; the label is what follows ':'."""
    entries = text.select(F.explode(F.regexp_extract_all("text", F.lit(r"(<(?:\w+:)?ColorMapEntry[^>]*>)"), 1)).alias("e"))
    label = F.regexp_extract("e", r'label="([^"]*)"', 1)
    return entries.select(
        F.regexp_extract("e", r'quantity="(-?[\d.]+)"', 1).cast("double").cast("int").alias("quantity"),
        F.trim(F.when(label.contains(":"), F.regexp_extract(label, r":(.*)$", 1)).otherwise(label)).alias("label"),
    ).where("quantity is not null and label != cast(quantity as string)")


def special_codes(entries: DataFrame) -> DataFrame:
    return entries.where(~F.col("label").rlike(r"^\d+\s*%"))


def year_of(beginning: Column) -> Column:
    """The first four characters as a year, held to 1900..2099; 0 if they are not four digits."""
    y = F.coalesce(F.nullif(F.regexp_extract(F.substring(beginning, 1, 4), r"^(\d{4})$", 1), F.lit("")).cast("int"), F.lit(0))
    return F.when(y == 0, 0).otherwise(F.least(F.greatest(y, F.lit(1900)), F.lit(2099)))


def survey_year(name: Column) -> Column:
    """The year in a file name; a name without one raises."""
    y = F.regexp_extract(name, r"((?:19|20)\d{2})", 1)
    return F.when(y == "", F.raise_error(F.concat(F.lit("no survey year in "), name)).cast("int")).otherwise(y.cast("int"))


def tiles_below(lon_min: Column, lat_min: Column, lon_max: Column, lat_max: Column, size: int) -> Column:
    """Lower-left corners of the size x size degree tiles that a box meets."""
    lons = F.sequence(F.floor(lon_min / size) * size, F.floor(lon_max / size) * size, F.lit(size).cast("long"))
    lats = F.sequence(F.floor(lat_min / size) * size, F.floor(lat_max / size) * size, F.lit(size).cast("long"))
    return F.flatten(F.transform(lons, lambda x: F.transform(lats, lambda y: F.struct(x.alias("lon"), y.alias("lat")))))


def offset_tile(lon: Column, lat: Column, lon0: float, lat0: float, size: float) -> tuple[Column, Column]:
    """1-based row and column of a tile grid that starts at (lon0, lat0), rows going south."""
    return (F.floor((lat0 - lat) / size) + 1).cast("int"), (F.floor((lon - lon0) / size) + 1).cast("int")


def preferred_boundary(found: DataFrame, want: str) -> DataFrame:
    """Per name the first row of the wanted type, else the first polygon; found: name, type, is_polygon, ordinal."""
    usable = found.where(F.col("is_polygon"))
    return usable.groupBy("name").agg(F.min_by("ordinal", F.struct(F.col("type") != want, F.col("ordinal"))).alias("ordinal"))


def way_kind(points: Column, tags: Column) -> Column:
    """polygon for a closed way of four points or more, else line; with the kind by precedence of its tags."""
    closed = (F.size(points) >= 4) & (F.get(points, 0) == F.element_at(points, -1))
    kind = F.coalesce(tags["landuse"], tags["aeroway"], tags["industrial"], F.lit("area"))
    return F.struct(F.when(closed, "polygon").otherwise("line").alias("shape"), kind.alias("kind"))
