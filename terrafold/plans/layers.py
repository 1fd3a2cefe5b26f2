"""The seven layers as compositions of operators, and their registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.functions.encoding import UNDATED, clean_percent
from terrafold.functions.grid import km2, ratio, row_area
from terrafold.operators import cells as C
from terrafold.operators.spans import inside, year_first_built


@dataclass(frozen=True)
class Layer:
    name: str
    measure: str
    encoding: str
    resolution: str
    build: Callable[..., DataFrame]


def buildings_dated(buildings: DataFrame, shapes: DataFrame, land: DataFrame) -> DataFrame:
    """Year first built of building polygons, on land."""
    return C.both(year_first_built(buildings, shapes), land)


def settlement_a(years: DataFrame, recent: DataFrame, greenhouse: DataFrame, land: DataFrame, k: int = 1, last: int = 2015) -> DataFrame:
    """A recent footprint without greenhouses, dated by coarse years up to last; years after it do not date."""
    footprint = C.both(C.only(recent, greenhouse), land)
    return C.drape(footprint, years.withColumn("year", F.when(F.col("year") <= last, F.col("year")).otherwise(0)), k)


def settlement_b(epochs: DataFrame, greenhouse: DataFrame, land: DataFrame) -> DataFrame:
    """First epoch, held to 0..20, without greenhouses, on land."""
    held = epochs.withColumn("v", F.least(F.greatest("v", F.lit(0)), F.lit(20))).where("v > 0")
    return C.both(C.only(held, greenhouse), land)


def covered_agriculture(greenhouse: DataFrame, land: DataFrame) -> DataFrame:
    return C.both(greenhouse, land)


def density_current(percent: DataFrame, land: DataFrame, least: int = 1) -> DataFrame:
    """Percentages of least or more on land."""
    return C.both(percent.withColumn("v", clean_percent(F.col("v"))).where(F.col("v") >= least), land)


def density_trend(bands: DataFrame, land: DataFrame) -> DataFrame:
    """r, c, band, v (square metres) on land; one row per band and cell."""
    return bands.join(land.select("r", "c"), ["r", "c"], "left_semi")


def trend_km2(bands: DataFrame) -> DataFrame:
    return bands.groupBy("band").agg((F.round(F.sum("v") / 1e6, 6) + 0.0).alias("surface_km2"))


def loss_events(changes: DataFrame) -> DataFrame:
    """period, class, km2 of change cells (period, r, c, v)."""
    return changes.groupBy("period", "v").agg(km2(F.sum(row_area(F.col("r")))).alias("km2"))


def headline(layer: DataFrame, encoding: str) -> DataFrame:
    """One figure per layer: area of what is built, or of the percentage, or the amount itself; 0 if the layer has no cell."""
    a = row_area(F.col("r"))
    total = {"year": F.sum(a), "epoch": F.sum(a), "binary": F.sum(a), "percent": F.sum(F.col("v") / 100 * a), "amount": F.sum(F.col("v").cast("double"))}[encoding]
    return layer.agg(km2(F.coalesce(total, F.lit(0.0))).alias("km2"))


def dated_share(layer: DataFrame) -> DataFrame:
    """dated_km2, undated_km2 (3 places; 0 where a class has no cell), and the dated share of these rounded areas (1 place; NaN if both are 0)."""
    a = row_area(F.col("r"))
    part = lambda dated: F.round(F.coalesce(F.sum(F.when((F.col("v") != UNDATED) == dated, a)), F.lit(0.0)) / 1e6, 3)
    areas = layer.where("v > 0").agg(part(True).alias("dated_km2"), part(False).alias("undated_km2"))
    share = ratio(100 * F.col("dated_km2"), F.col("dated_km2") + F.col("undated_km2"))
    return areas.select("dated_km2", "undated_km2", F.round(share, 1).alias("dated_share_pct"))


LAYERS = {x.name: x for x in (
    Layer("buildings-dated", "extent", "year", "10 m", buildings_dated),
    Layer("settlement-era-a", "extent", "year", "10 m", settlement_a),
    Layer("settlement-era-b", "extent", "epoch", "10 m", settlement_b),
    Layer("covered-agriculture", "extent", "binary", "10 m", covered_agriculture),
    Layer("density-current", "surface", "percent", "10 m", density_current),
    Layer("density-trend", "surface", "amount", "100 m", density_trend),
    Layer("loss-events", "extent", "class", "20 m", loss_events),
)}


def build(name: str, **sources: DataFrame) -> DataFrame:
    if name not in LAYERS:
        raise KeyError(f"unknown layer {name}")
    return LAYERS[name].build(**sources)


def land_spans(cells: DataFrame, spans: DataFrame) -> DataFrame:
    """Cells on land, where land is spans."""
    return inside(cells, spans).select(*cells.columns).distinct()
