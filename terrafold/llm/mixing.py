"""Mixing sources to target weights by Efraimidis-Spirakis sampling, with built-in functions only.

A source's target is its weight's share of all words, at most CAP times its own words; what is cut
off goes to the other sources by weight. Complete epochs come first; the rest is drawn without
replacement: each document has the exponential key -ln(u) / weight (u from a hash of the row), keys
are sorted within the source, and documents are taken while the running sum of words stays within the
rest. A second pass fills what is left with documents that fit into it, and a last document of any size is
taken if its source comes nearer to the target by it, the next one in the order of the keys.

Running sums go by ranges of the key: sums of (source, range) first, then within one range, so no
source is sorted in one task.

Defined cases: null text has size 0; null sources are one source, the last; null weights count as 1;
fully repeated rows are drawn as rows of their own; an empty table gives no row; a source without
words has target 0; reruns agree, since u depends on the row alone; extra columns pass through
mixed_documents whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrafold.llm.ordering import ranges
from terrafold.llm.store import repeated, written

CAP = 3
WEIGHTS = (1, 2, 3)
ROWS_PER_RANGE = 256
SEED = 20
PASSES = 2


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def targets(sources: DataFrame, weights: tuple = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size, target. sources: source, source_size; one row each.

    With capped sources first (ascending cap * size / weight), a source is capped when the level that
    the words left give per weight left is above its own ratio; the others get weight * level.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    rows = sources.withColumn("w", w).withColumn("most", cap * F.col("source_size").cast("double"))
    every = Window.partitionBy()
    before = Window.orderBy((F.col("most") / F.col("w")), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    level = left / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    rows = rows.withColumn("level", level).withColumn("capped", F.col("level") > F.col("most") / F.col("w"))
    final = F.min(F.when(~F.col("capped"), F.struct(F.col("most") / F.col("w"), F.col("source").isNull(), F.col("source"), F.col("level").alias("level")))).over(every)
    return rows.select("source", "source_size", F.when(F.col("capped"), F.col("most")).otherwise(F.least("most", F.col("w") * F.coalesce(final["level"], F.lit(0.0)))).alias("target"))


SAME = ["src", "doc_id", "size", "e"]


def _running(rows: DataFrame) -> DataFrame:
    """rows (SAME, copies, ...; distinct by SAME) with before: the words of the source's rows with smaller keys, all copies of them."""
    rows = ranges(rows, "e", ROWS_PER_RANGE, "double").place(rows, "e").withColumn("words", F.col("size") * F.col("copies"))
    sums = rows.groupBy("src", "part").agg(F.sum("words").alias("sum"))
    earlier = Window.partitionBy("src").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("src", "part", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("src", "part").orderBy("e", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum("words").over(inside), F.lit(0)))
    return rows.join(sums, ["src", "part"]).withColumn("before", F.col("base") + F.col("inner")).drop("part", "base", "inner", "words")


def draw(rows: DataFrame, weights: tuple = WEIGHTS, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, times, taken. rows: doc_id, source, size, weight.

    Equal rows differ in nothing but their number, so they are counted first, taken by number, and given
    out again at the end.
    """
    name = F.struct(F.col("source").isNull(), F.coalesce("source", F.lit("")))
    u = (F.shiftright(F.xxhash64(F.lit(seed), "doc_id", "source", "size"), 12) + F.lit(2.0**51) + 0.5) / F.lit(2.0**52)
    keys = rows.select("doc_id", "source", "size", F.xxhash64(name).alias("src"), (-F.log(u) / F.coalesce("weight", F.lit(1.0))).alias("e"))
    each = written(keys.groupBy(*SAME).agg(F.first("source").alias("source"), F.count("*").alias("copies")), "keys")
    sizes = each.groupBy("src").agg(F.first("source").alias("source"), F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    plan = targets(sizes.select("source", "source_size"), weights, cap)
    plan = written(plan.withColumn("src", F.xxhash64(name)).withColumn(
        "epochs", F.when(F.col("source_size") == 0, 0).otherwise(F.floor(F.col("target") / F.col("source_size")))).withColumn(
        "rest", F.col("target") - F.col("epochs") * F.col("source_size")), "targets")
    taken, left = None, each.select(*SAME, "copies").where("size > 0")
    room = plan.select("src", F.col("rest").alias("room"))
    for k in range(PASSES):
        fits = left.join(room, "src").where(F.col("room") > 0)
        if k:
            fits = fits.where(F.col("size") <= F.col("room"))
        n = F.floor((F.col("room") - F.col("before")) / F.col("size"))
        step = written(_running(fits).withColumn("got", F.greatest(F.lit(0), F.least(F.col("copies"), n)).cast("long")), f"pass-{k}").select(*SAME, "got")
        got = step.where("got > 0")
        taken = got if taken is None else taken.union(got)
        # What is not taken stays, whether it was looked at or not.
        both = left.select(*SAME, "copies").union(got.select(*SAME, -F.col("got")))
        left = written(both.groupBy(*SAME).agg(F.sum("copies").alias("copies")).where("copies > 0"), f"left-{k}")
        used = got.groupBy("src").agg(F.sum(F.col("size") * F.col("got")).alias("used"))
        # Written: a table of one small row per source, whose size Spark knows when it plans the join.
        room = written(room.join(used, "src", "left").select("src", (F.col("room") - F.coalesce("used", F.lit(0))).alias("room")), "room")
    # One more of any size, if its source comes nearer to the target by it: the next one in the order of the keys.
    nearer = left.join(room, "src").where(F.col("size") < 2 * F.col("room"))
    last = nearer.groupBy("src").agg(F.min(F.struct("e", "doc_id", "size")).alias("next")).select("src", "next.doc_id", "next.size", "next.e", F.lit(1).cast("long"))
    both = each.select(*SAME, "copies", F.lit(0).cast("long").alias("chosen")).union(taken.union(last).select(*SAME, F.lit(0).cast("long"), "got"))
    counts = both.groupBy(*SAME).agg(F.sum("copies").alias("copies"), F.sum("chosen").alias("chosen"))
    joined = counts.join(plan, "src").withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    times = F.col("epochs") + F.when(F.col("k") <= F.col("chosen"), 1).otherwise(0)
    return joined.select("doc_id", "source", "size", "source_size", "target", times.cast("int").alias("times"), (times * F.col("size")).cast("long").alias("taken"))


def quality_weights(labels: DataFrame) -> DataFrame:
    """doc_id, weight: 2 for a document labelled good, 1/2 for one labelled bad; unlabelled ones have none."""
    return labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("q")).select(
        "doc_id", F.when(F.col("q") == 1, 2.0).when(F.col("q") == 0, 0.5).alias("weight"))


def mix(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, times, taken of every row."""
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", n_words(F.col("text")).alias("size"))
    return draw(sized.join(quality_weights(labels), "doc_id", "left"))


def mixed_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of the mix, each as often as it is taken, with their columns as they were.

    Rows that agree on doc_id, source and size share what mix() gives them: so many of them are taken once
    more than the others.
    """
    keys = {
        "none": F.col("doc_id").isNull(), "own": F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")),
        "of": F.coalesce(F.concat(F.lit("="), "source"), F.lit("")), "size": n_words(F.col("text"))}
    named = mix(docs, labels).select(*[(c if k != "size" else F.col("size")).alias(k) for k, c in keys.items()], "times")
    chosen = named.groupBy(*keys).agg(F.count("*").alias("copies"), F.max("times").alias("most"), F.min("times").alias("rest"), F.sum("times").alias("sum"))
    high = F.when(F.col("most") == F.col("rest"), F.col("copies")).otherwise(F.col("sum") - F.col("rest") * F.col("copies"))
    return repeated(docs, keys, chosen.withColumn("high", high).drop("sum"))
