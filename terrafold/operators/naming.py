"""Which texts name which of many names, and figures that a registry and live values share.

A name stands in a text as a substring. Texts and names meet by the name's rarest run of GRAM characters,
looked up in an index of the runs that any name has, and the whole name is verified in the texts that are
left; no text is compared with all names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrafold.functions import figures as Z
from terrafold.sources.scratch import written

GRAM = 4


@F.pandas_udf(T.ArrayType(T.LongType(), False))
def _grams(texts: pd.Series) -> pd.Series:
    """Hashes of the distinct runs of GRAM characters of a text; none for a shorter one, or null.

    Work in proportion to the text's length, where a substring per place counts characters from the start
    again. Runs that share a hash only bring texts that the whole name is then not found in.
    """

    def runs(text: str | None) -> np.ndarray:
        codes = np.frombuffer((text or "").encode("utf-32-le"), "<u4").astype(np.uint64)
        n = max(len(codes) - GRAM + 1, 0)
        h = np.zeros(n, np.uint64)
        for k in range(GRAM):
            h = h * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + n]
        return np.unique(h).view(np.int64)

    return texts.map(runs)


def naming(texts: DataFrame, names: DataFrame) -> DataFrame:
    """path, name of the texts (path, text; unique paths) that hold a name (name) anywhere. A name of fewer than GRAM characters raises; nulls name nothing."""
    short = F.when(F.length("name") < GRAM, F.raise_error(F.concat(F.lit("too short a name: "), F.col("name"))).cast("string")).otherwise(F.col("name"))
    listed = names.where("name is not null").select(short.alias("name")).distinct()
    wanted = written(listed.select("name", F.explode(_grams(F.col("name"))).alias("gram")), "grams")
    held = texts.where("text is not null").select("path", F.explode(_grams(F.col("text"))).alias("gram"))
    index = written(held.join(wanted.select("gram").distinct(), "gram", "left_semi"), "index")
    often = index.groupBy("gram").agg(F.count("*").alias("n"))
    # A run that no text has rules its name out, so it is the rarest of all.
    rarest = wanted.join(often, "gram", "left").groupBy("name").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("gram").alias("gram"))).alias("r"))
    found = index.join(rarest.where("r.n > 0").select("name", F.col("r.gram").alias("gram")), "gram").groupBy("path").agg(F.collect_list("name").alias("names"))
    both = texts.join(found, "path").select("path", F.explode(F.filter("names", lambda x: F.col("text").contains(x))).alias("name"))
    return both


def surface_figures(texts: DataFrame, key: str, html: bool = False) -> DataFrame:
    """key, figures (how many distinct ones) and the count of every exemption, one row per surface; null text has none."""
    return Z.surfaces(texts.select(key, F.coalesce("text", F.lit("")).alias("text")), "text", html)


# Units of live values as they are written.
UNITS = {"km2": "km²", "mib": "MiB", "pct": "%", "x": "×"}


def coincidences(registry: DataFrame, live: DataFrame) -> DataFrame:
    """figure, name of registered figures (figure) that a live value (name, value, unit) would be written as, with 0, 1 or 2 places.

    A figure without a unit can be anything; with one the units agree. Values meet figures by the text that
    they round to (ties to even), so there are three rows per value and no pairs.
    """
    unit = F.create_map(*[F.lit(x) for pair in UNITS.items() for x in pair])
    shown = live.select("name", F.get(F.transform(F.array("unit"), lambda u: unit[u]), F.lit(0)).alias("unit"), F.explode(F.array_distinct(F.array(*[F.format_number("value", p) for p in (0, 1, 2)]))).alias("number"))
    mark = r"^(.+?)\s?(km²|%|×|MiB)?$"
    known = registry.where("figure is not null").distinct().select("figure", F.regexp_extract("figure", Z.unicode(mark), 1).alias("number"), F.nullif(F.regexp_extract("figure", Z.unicode(mark), 2), F.lit("")).alias("own"))
    return known.join(shown, "number").where(F.col("own").isNull() | (F.col("own") == F.col("unit"))).select("figure", "name").distinct()


def perturbed(source: DataFrame, figures: dict[str, Column], changes: dict[str, Column]) -> DataFrame:
    """figure, before, after, moved: every figure (an aggregate) over the source and over a copy with changed columns, in one scan.

    A figure that does not move does not depend on what was changed: it is constant, cached or read elsewhere.
    """
    copies = source.withColumn("__copy", F.explode(F.array(F.lit(0), F.lit(1))))
    for name, value in changes.items():
        copies = copies.withColumn(name, F.when(F.col("__copy") == 1, value.cast(source.schema[name].dataType)).otherwise(F.col(name)))
    both = copies.groupBy("__copy").agg(*[f.cast("string").alias(name) for name, f in figures.items()])
    side = lambda k: both.where(F.col("__copy") == k).select(F.explode(F.create_map(*[x for name in figures for x in (F.lit(name), F.col(name))])).alias("figure", "value"))
    before, after = side(0).withColumnRenamed("value", "before"), side(1).withColumnRenamed("value", "after")
    return before.join(after, "figure").select("figure", "before", "after", (~F.col("before").eqNullSafe(F.col("after"))).alias("moved"))
