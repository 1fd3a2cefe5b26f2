"""State encodings as column expressions: year first built, epoch first seen, percent, provenance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the encodings.
OFFSET, FIRST_YEAR, LAST_YEAR, UNDATED = 1899, 1900, 2099, 255
EPOCHS = 20


def encode_year(year: Column) -> Column:
    """0 for no year, otherwise the year held to 1900..2099, less 1899; never the undated code."""
    held = F.least(F.greatest(year, F.lit(FIRST_YEAR)), F.lit(LAST_YEAR))
    return F.when(year <= 0, 0).otherwise(held - OFFSET).cast("int")


def decode_year(v: Column) -> Column:
    """0 stays 0, undated is -1, anything else is a year."""
    return F.when(v == 0, 0).when(v == UNDATED, -1).otherwise(v + OFFSET).cast("int")


def is_dated(v: Column) -> Column:
    return (v > 0) & (v != UNDATED)


def built_by(v: Column, year: Column | int | None = None) -> Column:
    """Built at all, or dated no later than a year; undated counts as built but never as dated."""
    if year is None:
        return v > 0
    return is_dated(v) & (v <= (F.lit(year) if isinstance(year, int) else year) - OFFSET)


def oldest(a: Column, b: Column) -> Column:
    """The older of two states, where 0 and null mean absent."""
    return F.coalesce(F.least(F.nullif(a, F.lit(0)), F.nullif(b, F.lit(0))), F.lit(0))


def provenance(v: Column) -> Column:
    """0 not built, 1 dated by the source, 2 built without a date."""
    return F.when(v == 0, 0).when(v == UNDATED, 2).otherwise(1)


def epoch_decimal_year(epoch: Column) -> Column:
    """Epoch 1 is mid 2016; each later epoch half a year on."""
    return F.lit(2016.5) + (epoch - 1) * 0.5


def epoch_label(epoch: Column) -> Column:
    year = (F.lit(2016) + F.floor(epoch / 2)).cast("int")
    return F.concat_ws("-", year.cast("string"), F.when(epoch % 2 == 1, "07").otherwise("01"))


def epochs_up_to(year: Column) -> Column:
    """Number of epochs at or before a decimal year: truncated towards zero, held to 0..20."""
    return F.least(F.greatest(((year - 2016.5) * 2 + 1).cast("int"), F.lit(0)), F.lit(EPOCHS))


def slider_epoch(year: Column) -> Column:
    """The epoch a slider position shows: rounded half up, held to 1..20."""
    return F.least(F.lit(EPOCHS), F.greatest(F.lit(1), F.floor((year - 2016.5) * 2 + 1 + 0.5).cast("int")))


def clean_percent(v: Column) -> Column:
    """Codes above 100 are not measurements and become 0."""
    return F.when(v > 100, 0).otherwise(v)


def control_verdict(share_pct: Column, role: Column | None = None, year: Column | None = None) -> Column:
    """Of a negative control by its built share; of a loss test case by whether the loss shows from 2022 on."""
    control = F.when(share_pct < 1, "PASS").when(share_pct < 5, "SUSPECT").otherwise("FAIL")
    if role is None:
        return control
    lost = F.when(year < 2022, "BASELINE").when(share_pct < 1, "PASS").otherwise("FAIL")
    return F.when(role == "negative control", control).otherwise(lost)


def stratum(v: Column) -> Column:
    """What the map claims of a land cell; null for a date after 2024."""
    year = v + OFFSET
    return F.when(v == 0, "not_built").when(v == UNDATED, "undated").when(year <= 2015, "built_before_2015").when(year <= 2024, "new_2015_2024")


def reference_class(first: Column, second: Column) -> Column:
    """Class of two photo labels; null leaves the point out."""
    return (
        F.when((first == "built") & (second == "built"), "before_2015")
        .when((first == "not") & (second == "built"), "new_2015_2024")
        .when((first == "built") & (second == "not"), "lost_2015_2024")
        .when((first == "not") & (second == "not"), "not_built")
    )


def coarse_reference_class(first: Column, second: Column) -> Column:
    """As reference_class, without a class for losses: what stands now decides."""
    return F.when(second == "not", "not_built").when((second == "built") & (first == "built"), "before_2015").when((second == "built") & (first == "not"), "new_2015_2024")


def observation_kind(epoch: Column) -> Column:
    """How a built-surface epoch came about: imagery of its own year, of a year close by, or a model."""
    return (
        F.when(epoch.isin(2025, 2030), "projected").when(epoch.isin(1975, 1990, 2000), "observed")
        .when(epoch.isin(2015, 2020), "near-observed").otherwise("interpolated"))


def label_done(first: Column, second: Column) -> Column:
    """Whether a point has been judged on both dates."""
    return F.coalesce(first != "", F.lit(False)) & F.coalesce(second != "", F.lit(False))


def demolished(first: Column, second: Column) -> Column:
    """Whether a label says built, then not: rare, and flagged."""
    return F.coalesce((first == "built") & (second == "not"), F.lit(False))


def is_published(name: Column) -> Column:
    """Whether a built file is served: rasters of single islands are not, the mosaic and the confidence layers are."""
    return ~name.endswith(".tif") | (name == "archipelago.tif") | name.endswith(".confidence.tif")


def slug(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), " ", "-")


def class_key(name: Column) -> Column:
    """Letters and digits, runs of anything else as one underscore; never empty."""
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_"), F.lit("_")), F.lit("")), F.lit("unnamed"))
