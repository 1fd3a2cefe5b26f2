"""Time series: weighted histograms, running sums, forward fill, roll-ups.

One aggregation by value answers every year: a slider position is a prefix sum, so no year scans the
cells again. Running sums are over years (a few hundred rows), and rounding comes after them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrafold.functions.encoding import OFFSET, UNDATED
from terrafold.functions.grid import row_area


def histogram(cells: DataFrame) -> DataFrame:
    """v, m2: area per stored value."""
    return cells.groupBy("v").agg(F.sum(row_area(F.col("r"))).alias("m2"))


def dense(rows: DataFrame, key: str, group: list[str]) -> DataFrame:
    """Every key between a group's first and last."""
    ends = rows.groupBy(*group).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    return ends.where("lo is not null").select(*group, F.explode(F.sequence("lo", "hi")).alias(key))


def cumulative(hist: DataFrame, offset: int = OFFSET, undated: int | None = UNDATED) -> DataFrame:
    """key, added_km2, total_km2 for contiguous keys; nothing for a histogram without dates."""
    dated = hist.where(F.col("v") > 0)
    if undated is not None:
        dated = dated.where(F.col("v") != undated)
    keyed = dated.select((F.col("v") + offset).cast("int").alias("key"), "m2")
    full = dense(keyed, "key", []).join(keyed, "key", "left")
    total = F.sum(F.coalesce("m2", F.lit(0.0))).over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    return full.select("key", F.round(F.coalesce("m2", F.lit(0.0)) / 1e6, 6).alias("added_km2"), F.round(total / 1e6, 6).alias("total_km2"))


def filled(series: DataFrame, value: str = "total") -> DataFrame:
    """grp, key, value on every key that any group has: the last value so far, 0 before the first."""
    keys = series.select("key").distinct()
    every = series.select("grp").distinct().crossJoin(keys)
    so_far = Window.partitionBy("grp").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    joined = every.join(series, ["grp", "key"], "left")
    return joined.select("grp", "key", F.coalesce(F.last(value, ignorenulls=True).over(so_far), F.lit(0.0)).alias(value))


def added_since(series: DataFrame, start: int, value: str = "total") -> DataFrame:
    """grp, added: last value less the value at or before start (else the first one); never below 0."""
    last, first = F.max_by(value, "key"), F.min_by(value, "key")
    at = F.max_by(F.when(F.col("key") <= start, F.col(value)), F.when(F.col("key") <= start, F.col("key")))
    return series.groupBy("grp").agg(F.greatest(F.lit(0.0), last - F.coalesce(at, first)).alias("added"))


def neighbours(counts: DataFrame, factor: float = 3.0) -> DataFrame:
    """key, n, neighbour_mean, is_spike against the six keys around; absent keys count as 0, a zero mean is a spike."""
    offsets = [-3, -2, -1, 1, 2, 3]
    spread = counts.withColumn("o", F.explode(F.array(*[F.lit(o) for o in offsets]))).select((F.col("key") + F.col("o")).alias("key"), F.lit(0).alias("n"), F.col("n").alias("near"))
    both = counts.select("key", "n", F.lit(0).alias("near")).union(spread).groupBy("key").agg(F.sum("n").alias("n"), F.sum("near").alias("near"))
    mean = F.col("near") / 6
    return both.where("n > 0").select("key", "n", F.round(mean, 6).alias("neighbour_mean"), (F.col("n") >= factor * mean).alias("is_spike"))


def growth_pct(series: DataFrame, start: int, end: int, value: str = "total") -> DataFrame:
    """grp, growth_pct between two years that the series has; null where it has not both."""
    at = lambda y: F.max(F.when(F.col("key") == y, F.col(value)))
    return series.groupBy("grp").agg(F.round(100 * (at(end) / F.nullif(at(start), F.lit(0.0)) - 1), 6).alias("growth_pct"))
