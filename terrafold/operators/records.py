"""Records of a build: the seam between two eras, statuses and their loss, verdicts with tolerance, changes between passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.functions.encoding import OFFSET, UNDATED, is_dated
from terrafold.functions.grid import ratio, row_area
from terrafold.operators.cells import KEY

NAN = float("nan")


def _places(num: Column, den: Column, places: int = 2) -> Column:
    return F.round(F.when(den == 0, F.lit(NAN)).otherwise(num / F.nullif(den, F.lit(0.0))), places)


def seam_record(years: DataFrame, base: DataFrame, tracker: DataFrame, greenhouse: DataFrame, zones: DataFrame, surveys: DataFrame, last: int = 2015) -> DataFrame:
    """One row per island: four extents, three factors between them and the net one, what greenhouses take away and the year of their survey.

    years: cells dated by the first era (up to last), base: the same producer's finer map of that year,
    tracker: the second era, of which epoch 1 counts, zones: island and its cells, surveys: island, year.
    Factors are ratios of the rounded extents (2 places), NaN over 0. Everything is one aggregation of the
    three products by island; greenhouses meet the tracker's cells only.
    """
    v = F.col("v")
    epoch = tracker.where(v == 1).join(greenhouse.select(*KEY, F.lit(True).alias("green")).distinct(), KEY, "left")
    tagged = years.where(is_dated(v) & (v + OFFSET <= last)).select(*KEY, F.lit("evo30").alias("k")).union(base.where(v > 0).select(*KEY, F.lit("wsf15"))).union(
        epoch.select(*KEY, F.when(F.col("green"), "green").otherwise("free")))
    seen = zones.select("island", *KEY).distinct().join(tagged, KEY, "left")
    km2 = lambda *kinds: F.round(F.coalesce(F.sum(F.when(F.col("k").isin(*kinds), row_area(F.col("r")))), F.lit(0.0)) / 1e6, 2)
    t = seen.groupBy("island").agg(km2("evo30").alias("evo30"), km2("wsf15").alias("wsf15"), km2("green", "free").alias("trk_e1"), km2("free").alias("trk_e1_nogh"))
    c = F.col
    return t.join(surveys.select("island", c("year").alias("greenhouse_survey_year")), "island", "left").select(
        "island", "evo30", "wsf15", "trk_e1", "trk_e1_nogh", _places(c("evo30"), c("wsf15")).alias("resolution_factor"), _places(c("trk_e1"), c("wsf15")).alias("definition_factor_raw"),
        _places(c("trk_e1_nogh"), c("wsf15")).alias("definition_factor_masked"), F.round(c("trk_e1") - c("trk_e1_nogh"), 2).alias("greenhouse_removed_km2"),
        _places(c("trk_e1_nogh"), c("evo30")).alias("net_evo_to_tracker_masked"), "greenhouse_survey_year")


def status_report(statuses: DataFrame, changes: DataFrame, pixel_km2: float, change_km2: float, years: int) -> DataFrame:
    """island (null: all together), km2_first, km2_middle, km2_last (2 places), new_km2, lost_km2 (3 places), loss_pct_year of the middle extent (3 places, NaN over 0).

    statuses: island, status (first, middle, last), one row per built pixel; changes: island, v (1 new, 2
    lost). The total adds the islands' rounded figures, and its rate is that of the sums.
    """
    n = lambda kind: F.count_if(F.col("status") == kind) * F.lit(pixel_km2)
    built = statuses.groupBy("island").agg(*[n(k).alias(k) for k in ("first", "middle", "last")])
    moved = changes.groupBy("island").agg(*[(F.count_if(F.col("v") == code) * F.lit(change_km2)).alias(k) for k, code in (("new", 1), ("lost", 2))])
    each = built.join(moved, "island", "full_outer").na.fill(0.0, ["first", "middle", "last", "new", "lost"])
    names = {"first": 2, "middle": 2, "last": 2, "new": 3, "lost": 3}
    shown = [F.round(k, p).alias(k) for k, p in names.items()]
    one = each.select("island", *shown, _places(100 * F.col("lost"), F.col("middle") * years, 3).alias("rate"))
    total = one.agg(*[F.round(F.sum(k), p).alias(k) for k, p in names.items()]).select(F.lit(None).cast(each.schema["island"].dataType).alias("island"), *names, _places(100 * F.col("lost"), F.col("middle") * years, 3).alias("rate"))
    rows = one.union(total.where("middle is not null"))
    return rows.select("island", F.col("first").alias("km2_first"), F.col("middle").alias("km2_middle"), F.col("last").alias("km2_last"), F.col("new").alias("new_km2"), F.col("lost").alias("lost_km2"), F.col("rate").alias("loss_pct_year"))


# What a map claims of a cell; the first three can be seen on a photograph.
OBSERVABLE = ("built_before_2015", "new_2015_2024", "not_built")


def claim(v: Column, last: int = 2015) -> Column:
    """What a state says; null and 0 are not built."""
    return F.when(F.coalesce(v, F.lit(0)) == 0, "not_built").when(v == UNDATED, "undated").when(v + OFFSET <= last, "built_before_2015").otherwise("new_2015_2024")


def verdicts(points: DataFrame, cells: DataFrame, reach: int, last: int = 2015) -> DataFrame:
    """id, stratum, reference, tolerated: the reference class, and the stratum in its place where the map has the reference class within reach cells.

    points: id, r, c, stratum, reference (null: not settled, left out). A window that is not built
    throughout has "not_built" too. An undated point is never rescued: that class is no observation. The
    strict verdict is a lower bound of agreement, the tolerant one an upper bound.
    """
    side = 2 * reach + 1
    steps = F.sequence(F.lit(-reach), F.lit(reach))
    judged = points.where("reference is not null")
    open_ = judged.where((F.col("reference") != F.col("stratum")) & F.col("stratum").isin(*OBSERVABLE))
    spread = open_.select("id", "reference", "r", "c", F.explode(steps).alias("i")).select("id", "reference", (F.col("r") + F.col("i")).alias("r"), "c", F.explode(steps).alias("j"))
    spread = spread.select("id", "reference", "r", (F.col("c") + F.col("j")).alias("c"))
    near = spread.join(cells.where("v > 0").select(*KEY, "v"), KEY)
    met = near.groupBy("id", "reference").agg(F.count("*").alias("n"), F.max((claim(F.col("v"), last) == F.col("reference")).cast("int")).alias("hit"))
    seen = judged.join(met.select("id", "n", "hit"), "id", "left")
    hit = (F.coalesce("hit", F.lit(0)) == 1) | ((F.col("reference") == "not_built") & (F.coalesce("n", F.lit(0)) < side * side))
    rescued = (F.col("reference") != F.col("stratum")) & F.col("stratum").isin(*OBSERVABLE) & hit
    return seen.select("id", "stratum", "reference", F.when(rescued, F.col("stratum")).otherwise(F.col("reference")).alias("tolerated"))


def label_changes(first: DataFrame, second: DataFrame, strata: DataFrame) -> DataFrame:
    """stratum (null: unknown), n, changed, changed_pct (1 place), toward, away: points that both passes judged (id, early, late), by what the map claims (id, stratum).

    A point is judged if either of its labels is given. toward: the second pass agrees with the claim that
    something stood early on, and the first did not; away: the other way round. A blind pass is about even.
    """
    judged = lambda t, x: t.where("early is not null or late is not null").select("id", F.col("early").alias(f"{x}e"), F.col("late").alias(f"{x}l"))
    both = judged(first, "a").join(judged(second, "b"), "id").join(strata.select("id", "stratum"), "id", "left")
    changed = ~(F.col("ae").eqNullSafe(F.col("be")) & F.col("al").eqNullSafe(F.col("bl")))
    stood = F.coalesce(F.col("stratum").isin("built_before_2015", "undated"), F.lit(False))
    right = lambda x: F.coalesce(F.col(x) == "built", F.lit(False)) == stood
    t = both.groupBy("stratum").agg(
        F.count("*").alias("n"), F.count_if(changed).alias("changed"), F.count_if(changed & right("be") & ~right("ae")).alias("toward"), F.count_if(changed & right("ae") & ~right("be")).alias("away"))
    return t.select("stratum", "n", "changed", F.round(ratio(100.0 * F.col("changed"), F.col("n")), 1).alias("changed_pct"), "toward", "away")
