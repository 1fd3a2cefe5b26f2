"""Quality gates: assertion rows, with a skipped check kept apart from a passed one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.functions.grid import same_grid

COLUMNS = ["gate", "layer", "island", "passed", "value", "expected", "skipped", "detail"]


def gate(df: DataFrame, name: str, layer: Column, island: Column, value: Column, passed: Column, expected: str, skipped: Column) -> DataFrame:
    """One gate row per row of df; a skipped gate passes nothing (passed is null)."""
    return df.select(
        F.lit(name).alias("gate"), layer.alias("layer"), island.alias("island"), F.when(~skipped, passed).alias("passed"),
        F.round(value, 6).alias("value"), F.lit(expected).alias("expected"), skipped.alias("skipped"),
        F.when(skipped, "not applicable").when(passed, "ok").otherwise("outside").alias("detail"))


def totals(df: DataFrame, low: float, high: float) -> DataFrame:
    """Ratio to a reference area inside a band; no reference, or less than 1 km2 of it: skipped."""
    skip = F.col("reference_km2").isNull() | (F.col("reference_km2") < 1)
    ratio = F.when(~skip, F.col("built_km2") / F.col("reference_km2"))
    return gate(df, "totals", F.col("layer"), F.col("island"), ratio, ratio.between(low, high), f"{low}..{high}", skip)


def negative_control(df: DataFrame, most_pct: float = 0.1) -> DataFrame:
    """Built share of a control area; none defined: skipped; defined but unavailable or without area: failed."""
    skip = ~F.col("has_control")
    share = 100 * F.col("built_km2") / F.nullif(F.col("control_km2"), F.lit(0.0))
    return gate(df, "negative-control", F.col("layer"), F.col("island"), share, F.coalesce(share <= most_pct, F.lit(False)), f"<= {most_pct} %", skip)


def growth_only(df: DataFrame) -> DataFrame:
    """Dated years lie in 1900..2099; nothing dated: skipped, value 0."""
    skip = F.col("first_year").isNull()
    ok = (F.col("first_year") >= 1900) & (F.col("last_year") <= 2099)
    return gate(df, "growth-only", F.col("layer"), F.col("island"), F.coalesce(F.col("first_year").cast("double"), F.lit(0.0)), ok, "1900..2099", skip)


def loss_rate(df: DataFrame, most_pct: float = 0.2, excused: tuple = ()) -> DataFrame:
    """Yearly loss of built land; excused islands pass; nothing built: skipped."""
    skip = F.coalesce(F.col("built_km2"), F.lit(0.0)) <= 0
    rate = F.when(~skip, 100 * F.col("lost_km2") / F.col("built_km2") / F.col("years"))
    ok = (rate <= most_pct) | F.col("island").isin(*excused) if excused else rate <= most_pct
    return gate(df, "loss-rate", F.col("layer"), F.col("island"), rate, ok, f"<= {most_pct} %/yr", skip)


def agreement(df: DataFrame, least: float = 0.3) -> DataFrame:
    skip = F.col("iou").isNull()
    return gate(df, "agreement", F.col("layer"), F.col("island"), F.col("iou"), F.col("iou") >= least, f">= {least}", skip)


def size_budget(files: DataFrame, most: int = 100 * 1024 * 1024) -> DataFrame:
    total = files.agg(F.coalesce(F.sum("length"), F.lit(0)).cast("double").alias("bytes"))
    return gate(total, "size-budget", F.lit("all"), F.lit("all"), F.col("bytes"), F.col("bytes") <= most, f"<= {most}", F.lit(False))


def resolves(links: DataFrame, files: DataFrame) -> DataFrame:
    """Links whose target is missing or leaves the tree."""
    clean = links.withColumn("inside", ~F.col("href").startswith("..") & ~F.col("href").startswith("/"))
    found = files.select(F.col("path").alias("href"), F.lit(True).alias("there")).distinct()
    return clean.join(found, "href", "left").where(~F.col("inside") | F.col("there").isNull()).select("href", "inside")


def summary(gates: DataFrame) -> DataFrame:
    """gate, passed, measured, skipped: skipped checks are in neither of the first two."""
    return gates.groupBy("gate").agg(
        F.count_if(F.coalesce("passed", F.lit(False)) & ~F.col("skipped")).alias("passed"),
        F.count_if(~F.col("skipped")).alias("measured"), F.count_if("skipped").alias("skipped"))


def grid_alignment(grids: DataFrame) -> DataFrame:
    """Each layer's grid (island, layer, ordinal, coefficients) against the first one of its island; a lone layer has no gate."""
    first = grids.groupBy("island").agg(F.min_by(F.struct("layer", "coefficients"), "ordinal").alias("first"))
    others = grids.join(first, "island").where(F.col("layer") != F.col("first.layer"))
    return gate(others, "grid-alignment", F.col("layer"), F.col("island"), F.lit(None).cast("double"), same_grid(F.col("coefficients"), F.col("first.coefficients")), "identical", F.lit(False))


def table_valid(cells: DataFrame, layer: str, height: int, width: int) -> DataFrame:
    """Whether a layer's cells lie in its grid, once each: what a raster file's validation is to a table."""
    inside = F.col("r").between(0, height - 1) & F.col("c").between(0, width - 1)
    seen = cells.groupBy("r", "c").agg(F.count("*").alias("n")).agg(F.sum(F.when(inside & (F.col("n") == 1), 0).otherwise(1)).cast("double").alias("bad"))
    bad = F.coalesce("bad", F.lit(0.0))
    return gate(seen, "table-valid", F.lit(layer), F.lit("all"), bad, bad == 0, "0 cells outside or repeated", F.lit(False))


def catalogue_valid(items: DataFrame, required: list[str]) -> DataFrame:
    """Whether every item (id, json) has the required fields; the value is the number of items."""
    lacks = [F.get_json_object("json", f"$.{name}").isNull() for name in required]
    bad = lacks[0]
    for one in lacks[1:]:
        bad = bad | one
    n = items.agg(F.count("*").cast("double").alias("n"), F.count_if(bad).alias("bad"))
    return gate(n, "catalogue-valid", F.lit("catalogue"), F.lit("all"), F.col("n"), F.col("bad") == 0, "every item complete", F.lit(False))


def acceptance(measured: DataFrame, goldens: DataFrame, tolerance: float) -> DataFrame:
    """Measured figures (name, value) against goldens (name, value): a golden without a measurement fails."""
    both = goldens.withColumnRenamed("value", "golden").join(measured, "name", "left")
    ok = F.coalesce(F.abs(F.col("value") - F.col("golden")) <= tolerance, F.lit(False))
    return gate(both, "acceptance", F.col("name"), F.lit("all"), F.col("value"), ok, f"within {tolerance}", F.lit(False))


def unmoved(before: DataFrame, after: DataFrame) -> DataFrame:
    """Figures (name, value) that a perturbed build leaves as they were; a page whose figures are generated has none."""
    return before.join(after.withColumnRenamed("value", "changed"), "name").where(F.col("value").eqNullSafe(F.col("changed"))).select("name", "value")
