"""Global order without a single task: contiguous ranges of a numeric column, numbered in order.

The limits come from a sample of the column's distinct values, chosen by their hash, about PER_RANGE for
each range, so a repeated task sees the same limits and ranges hold about equally many distinct values.
Up to MAX_RANGES ranges their limits are sorted on the driver (MAX_RANGES * PER_RANGE values at most).
A table that needs more gets levels: every range of a level is cut into FAN at most by limits of its own,
which are found by the executors and kept in a table that the rows meet by their range so far. So ranges
keep their size however large the table is. All rows of one value are in one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrafold.llm.store import written

MAX_RANGES, PER_RANGE, FAN = 16384, 16, 128
#: Numbers of ranges that are added up together, before their sums are.
BLOCK = 4096


def _sampled(df: DataFrame, column: str, share: float) -> DataFrame:
    """x: values of the column, chosen by hash with about that probability; a value may come several times."""
    value = F.col(f"`{column}`")
    return df.select(value.alias("x")).where(value.isNotNull() & (F.pmod(F.xxhash64(F.lit(3), value), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30)) + 1))


def limits(df: DataFrame, column: str, rows_per_range: int) -> list:
    """Ascending first values of the ranges 1, 2, ..., MAX_RANGES - 1 at most; range 0 holds what is below them, and nulls.

    Every limit is a value of the column. The list is empty for a table of one range.
    """
    return _limits(df, column, df.count(), rows_per_range)


def _limits(df: DataFrame, column: str, n: int, rows_per_range: int) -> list:
    k = min(MAX_RANGES, -(-n // rows_per_range))
    if k < 2:
        return []
    found = sorted(r.x for r in _sampled(df, column, k * PER_RANGE / n).groupBy("x").agg(F.lit(1).alias("one")).select("x").collect())
    step = max(1, round(len(found) / k))
    return found[step::step]


def _place(value: Column, array: Column, size: Column, steps: Column) -> Column:
    """How many of the ascending values in array are at or below value, by binary search."""
    start = F.struct(F.lit(0).alias("lo"), size.cast("int").alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        mid = F.shiftright(s["lo"] + s["hi"], 1)
        right = F.struct((mid + 1).alias("lo"), s["hi"].alias("hi"))
        left = F.struct(s["lo"].alias("lo"), mid.alias("hi"))
        return F.when(s["lo"] >= s["hi"], s).when(F.get(array, mid) <= value, right).otherwise(left)

    return F.aggregate(F.sequence(F.lit(1), steps), start, halve, lambda s: s["lo"])


def range_of(value: Column, bounds: list, kind: str = "bigint") -> Column:
    """The number of limits at or below the value; 0 for null."""
    if not bounds:
        return F.lit(0)
    suffix = "L" if kind == "bigint" else "D"
    array = F.expr(f"array({','.join(f'{x!r}{suffix}' for x in bounds)})")
    return F.when(value.isNull(), F.lit(0)).otherwise(_place(value, array, F.lit(len(bounds)), F.lit(len(bounds).bit_length())))


class Ranges:
    """Ranges of a column, numbered in its order; numbers have gaps where there are several levels."""

    def __init__(self, first: list, kind: str) -> None:
        self.first, self.kind, self.deeper = first, kind, []

    def place(self, df: DataFrame, column: str, name: str = "part") -> DataFrame:
        """df with the number of each row's range; null is in the first one. Levels past the first are joined by the range so far."""
        value = F.col(f"`{column}`")
        df = df.withColumn(name, range_of(value, self.first, self.kind).cast("long"))
        for level, table in enumerate(self.deeper):
            # The first such table has MAX_RANGES rows of FAN numbers at most and is broadcast; later ones are joined as they are.
            bounds = (F.broadcast(table) if level == 0 else table).withColumnRenamed("up", "__up")
            below = F.when(value.isNull() | F.col("__bounds").isNull(), 0).otherwise(_place(value, F.col("__bounds"), F.size("__bounds"), F.lit(FAN.bit_length())))
            df = df.join(bounds, F.col(name) == F.col("__up"), "left").withColumn(name, F.col(name) * FAN + below).drop("__up", "__bounds")
        return df


def ranges(df: DataFrame, column: str, rows_per_range: int, kind: str = "bigint") -> Ranges:
    """Ranges of about rows_per_range rows, however many that makes."""
    n = df.count()
    k = -(-n // rows_per_range)
    out = Ranges(_limits(df, column, n, rows_per_range), kind)
    made = MAX_RANGES
    while out.first and made < k:
        fan = min(FAN, -(-k // made))
        placed = out.place(_sampled(df, column, made * fan * PER_RANGE / n), "x", "up")
        values = placed.groupBy("up").agg(F.sort_array(F.collect_set("x")).alias("xs"))
        picks = F.transform(F.sequence(F.lit(1), F.lit(fan - 1)), lambda i: F.get("xs", F.floor(i * F.size("xs") / fan).cast("int")))
        bounds = F.array_distinct(F.filter(picks, lambda x: x.isNotNull() & (x > F.get("xs", F.lit(0)))))
        out.deeper.append(written(values.select("up", bounds.alias("__bounds")), "limits"))
        made *= FAN
    return out


def before(parts: DataFrame, value: str, name: str) -> DataFrame:
    """parts (part, value, ...; one row per part) with the sum of value over all smaller parts; sums of BLOCK numbers of parts first."""
    rows = parts.withColumn("__block", F.floor(F.col("part") / BLOCK))
    sums = rows.groupBy("__block").agg(F.sum(value).alias("s"))
    earlier = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)  # one row per BLOCK parts
    sums = sums.select("__block", F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("__block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("__in", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(sums, "__block").withColumn(name, F.col("__base") + F.col("__in")).drop("__block", "__base", "__in")


def following(parts: DataFrame, columns: list[str]) -> DataFrame:
    """part, next_<column>...: for each part but the last, the columns of the part that comes next; parts has one row per part."""
    rows = parts.select("part", F.struct(*columns).alias("s"), F.floor(F.col("part") / BLOCK).alias("block"))
    firsts = rows.groupBy("block").agg(F.min(F.struct("part", "s")).alias("f"))
    later = firsts.select("block", F.lead("f.s").over(Window.orderBy("block")).alias("later"))  # one row per BLOCK parts
    inside = F.lead("s").over(Window.partitionBy("block").orderBy("part"))
    both = rows.withColumn("n", inside).join(later, "block").select("part", F.coalesce("n", "later").alias("n")).where("n is not null")
    return both.select("part", *[F.col(f"n.{c}").alias(f"next_{c}") for c in columns])
