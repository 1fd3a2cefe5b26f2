"""Accuracy assessment: sample design, draws, confusion matrix, area-weighted estimates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


FLOORED = ("new_2015_2024", "undated", "built_before_2015", "not_built")


def design(strata: DataFrame, target_pct: float = 1.0, floor: int = 100, unsure: float = 0.2, not_built_usable: int = 0, floored: Iterable[str] = FLOORED) -> DataFrame:
    """stratum, km2, expected -> n_formula, usable, draw: points for a target 95 % interval on overall accuracy.

    n = (sum of w * sqrt(p * (1 - p)) / (target / 1.96))**2, shared by area (half-even, at least 1); the
    floored strata (the four claims) get the floor, "not_built" may be given more; draws are inflated for unsure labels.
    """
    every = Window.partitionBy()
    w = F.col("km2") / F.sum("km2").over(every)
    spread = strata.withColumn("w", w).withColumn("s", F.sqrt(F.col("expected") * (1 - F.col("expected"))))
    n = F.ceil(F.pow(F.sum(F.col("w") * F.col("s")).over(every) / (target_pct / 100 / 1.96), 2))
    usable = F.greatest(F.lit(1), F.bround(n * F.col("w")), F.when(F.col("stratum").isin(*floored), floor).otherwise(0))
    usable = F.greatest(usable, F.when(F.col("stratum") == "not_built", not_built_usable).otherwise(0))
    return spread.withColumn("n_formula", n.cast("long")).withColumn("usable", usable.cast("long")).select(
        "stratum", "km2", "n_formula", "usable", F.ceil(F.col("usable") / (1 - unsure)).cast("long").alias("draw"))


def draw(pool: DataFrame, sizes: DataFrame, key: str, seed: int = 1) -> DataFrame:
    """A fixed number of rows per stratum, without replacement, by the order of a seeded hash.

    The hash threshold that surely holds enough rows is applied before the sort, so a stratum is never
    sorted whole.
    """
    counts = pool.groupBy("stratum").agg(F.count("*").alias("have"))
    need = counts.join(sizes.select("stratum", "draw"), "stratum").select(
        "stratum", "draw", F.least(F.lit(1.0), (F.col("draw") + 10 * F.sqrt(F.col("draw")) + 50) / F.col("have")).alias("share"))
    u = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) / float(1 << 30)
    some = pool.join(F.broadcast(need), "stratum").withColumn("u", u).where(F.col("u") <= F.col("share"))
    order = Window.partitionBy("stratum").orderBy("u", key)
    return some.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= F.col("draw")).select("stratum", key, "rank")


def confusion(points: DataFrame) -> DataFrame:
    """map, ref, n."""
    return points.where("ref is not null").groupBy("map", "ref").agg(F.count("*").alias("n"))


def accuracy(points: DataFrame, areas: DataFrame) -> DataFrame:
    """Per class of the reference: users, users_ci, producers, producers_ci, mapped_km2, adjusted_km2, adjusted_ci (95 %).

    points: map, ref; areas: map, km2 (a small table of strata). Estimators weigh a stratum's shares by its
    mapped area; a class that only the reference has is kept, mapped as 0; strata of one point add no variance.
    """
    n = confusion(points)
    total = n.groupBy("map").agg(F.sum("n").alias("n_map"))
    weights = areas.withColumn("w", F.col("km2") / F.sum("km2").over(Window.partitionBy()))
    classes = n.select(F.col("ref").alias("class")).distinct()
    # Every stratum with every class of the reference, so that classes without hits have their zeros.
    cell = weights.join(total, "map", "left").crossJoin(F.broadcast(classes)).join(n.withColumnRenamed("ref", "class"), ["map", "class"], "left")
    p = F.coalesce(F.col("n") / F.col("n_map"), F.lit(0.0))
    cell = cell.withColumn("p", p).withColumn("var", F.when(F.col("n_map") >= 2, F.col("p") * (1 - F.col("p")) / (F.col("n_map") - 1)).otherwise(0.0))
    own = F.col("map") == F.col("class")
    sums = cell.groupBy("class").agg(
        F.sum(F.col("w") * F.col("p")).alias("share"), F.sum(F.col("w") * F.col("w") * F.col("var")).alias("var"), F.max(F.when(own, F.col("p"))).alias("users"),
        F.max(F.when(own, F.col("var"))).alias("own_var"), F.max(F.when(own & (F.col("n_map") > 1), F.col("n_map"))).alias("many"),
        F.coalesce(F.max(F.when(own & F.col("n_map").isNotNull(), F.col("w"))), F.lit(0.0)).alias("w"), F.coalesce(F.max(F.when(own, F.col("km2"))), F.lit(0.0)).alias("mapped"),
        F.sum(F.when(~own, F.col("km2") * F.col("km2") * F.col("var")).otherwise(0.0)).alias("others"), F.sum("km2").alias("all_km2"))
    users = F.when(F.col("w") > 0, F.col("users"))
    producers = F.when(F.col("w") > 0, F.col("w") * F.col("users") / F.nullif(F.col("share"), F.lit(0.0)))
    term = F.pow("mapped", F.lit(2)) * F.pow(1 - producers, F.lit(2)) * F.col("own_var") + F.pow(producers, F.lit(2)) * F.col("others")
    adjusted = F.col("share") * F.col("all_km2")
    return sums.select(
        "class", F.round(users, 6).alias("users"), F.round(F.when(F.col("many").isNotNull(), 1.96 * F.sqrt("own_var")), 6).alias("users_ci"), F.round(producers, 6).alias("producers"),
        F.round(F.when(F.col("many").isNotNull(), 1.96 * F.sqrt(term) / F.nullif(adjusted, F.lit(0.0))), 6).alias("producers_ci"), F.round("mapped", 6).alias("mapped_km2"),
        F.round(adjusted, 6).alias("adjusted_km2"), F.round(1.96 * F.sqrt("var") * F.col("all_km2"), 6).alias("adjusted_ci"))


def overall(points: DataFrame, areas: DataFrame) -> DataFrame:
    n = confusion(points)
    right = n.groupBy("map").agg((F.sum(F.when(F.col("map") == F.col("ref"), F.col("n")).otherwise(0)) / F.sum("n")).alias("p"))
    joined = right.join(areas, "map")
    return joined.agg(F.round(F.sum(F.col("p") * F.col("km2")) / F.sum("km2"), 6).alias("overall"))


def ratio(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0))
