"""Importance resampling towards a target distribution: hashed n-gram weights, Gumbel scores, exact ranks.

Features are all runs of one and two words, each counted in one of BUCKETS counters by the crc32 of its
bytes. The counters of the corpus and of the target give every bucket a gain, the log of the ratio of
its smoothed shares in thousandths; a document weighs the floored mean of its features' gains, and its
score adds Gumbel noise drawn from its doc_id. The gains are an array of BUCKETS numbers whatever the
corpus, so they travel with the tasks.

The highest scores are found without a global sort: scores are integers, so a histogram of them is
small (a weight lies between two logs of counts, noise between -3.1 and 22.6 thousand; below 200,000
values for any corpus that fits in 64-bit counters). Its counts summed from the top give each score the
rank at which it begins and tell where the draw stops; within a surviving score rows are numbered by
doc_id, range by range of doc_id, so that no score is sorted in one task.

Defined cases: null text has no words, no features and weight 0; of a null doc_id the noise is drawn
from "7:" alone, and it comes after all others of its score; rows of one doc_id and score come in order of
n_features and weight; fully repeated rows are drawn as rows of their own, counted first and given out
again at the end; documents of fewer than least_words words are never drawn; an empty table or an empty
target gives a result like any other; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain, repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrafold.llm.ordering import ranges
from terrafold.llm.shingles import blocks
from terrafold.llm.store import bounded, written

BUCKETS = 10000
LEAST_WORDS, PER_CENT, SEED = 20, 25, 7
ROWS_PER_RANGE = 65536
_WORD, _GAP = re.compile(rb"[0-9a-z\x80-\xff]+"), re.compile(rb"[^0-9a-z\x80-\xff]")


def features(data: bytes, n_buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """Buckets of all words and pairs of neighbouring words, block by block: words first, then as many pairs as there are.

    A checksum goes on where another ended, so a pair takes its first word's checksum, a space and the second word.
    """
    last: bytes | None = None
    for block in blocks(data.lower(), _GAP):
        words = _WORD.findall(block)
        if not words:
            continue
        ones = [crc32(w) for w in words]
        left = map(crc32, repeat(b" "), ones if last is None else chain([crc32(last)], ones))
        pairs = map(crc32, words[1:] if last is None else words, left)
        yield np.fromiter(chain(ones, pairs), np.int64) % n_buckets
        last = words[-1]


def _counts(n_buckets: int):
    kind = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches):
        total = np.zeros(n_buckets, np.int64)
        for b in batches:
            for text in b.column(0).cast(pa.binary()):
                for found in features(text.as_py() or b"", n_buckets):
                    total += np.bincount(found, minlength=n_buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], schema=kind)

    return run


def counters(texts: DataFrame, n_buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in the column text; summed on the executors, n_buckets numbers reach the driver."""
    rows = bounded(texts).select(F.col("text").cast("string")).mapInArrow(_counts(n_buckets), "bucket int, n long")
    out = np.zeros(n_buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of every bucket, in doubles."""
    b = len(corpus)
    all_s, all_t = float(int(corpus.sum()) + b), float(int(target.sum()) + b)
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def _weights(table: np.ndarray, least_words: int):
    kind = pa.schema([("doc_id", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64()), ("fit", pa.bool_())])

    def run(batches):
        for b in batches:
            n, total = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            for k, text in enumerate(b.column(1).cast(pa.binary())):
                for found in features(text.as_py() or b"", len(table)):
                    n[k] += len(found)
                    total[k] += table[found].sum()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(total // np.maximum(n, 1)), pa.array((n + 1) // 2 >= least_words)], schema=kind)

    return run


def weighed(docs: DataFrame, table: np.ndarray, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_features, weight, fit (it has least_words words) of every row: array-scored, no row is shuffled."""
    slim = bounded(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(_weights(table, least_words), "doc_id long, n_features long, weight long, fit boolean")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)), u from the first 32 bits of a digest of seed and doc_id."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8)
    u = (F.conv(head, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


def draw(scored: DataFrame, per_cent: int = PER_CENT, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """scored (doc_id, n_features, weight, score, fit; a written table) with rank: 1, 2, ... of the drawn rows, else null."""
    same = ["score", "doc_id", "n_features", "weight"]
    fit = scored.where("fit")
    histogram = written(fit.groupBy("score").agg(F.count("*").alias("n")), "histogram")
    k = per_cent * (histogram.agg(F.sum("n")).first()[0] or 0) // 100
    above = F.coalesce(F.sum("n").over(Window.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = histogram.withColumn("above", above).where(F.col("above") < k).select("score", "above")
    cutoff = offsets.agg(F.min("score")).first()[0]
    null = F.lit(None).cast("long").alias("rank")
    if cutoff is None:
        return scored.select(*same, null)
    chosen = fit.where(F.col("score") >= cutoff)
    each = ranges(chosen, "doc_id", rows_per_range).place(chosen.groupBy(*same).agg(F.count("*").alias("copies")), "doc_id")
    each = written(each.withColumn("part", F.when(F.col("doc_id").isNull(), F.lit(1 << 62)).otherwise(F.col("part"))), "drawn")
    earlier = Window.partitionBy("score").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = each.groupBy("score", "part").agg(F.sum("copies").alias("n")).select("score", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    starts = parts.join(F.broadcast(offsets), "score").select("score", "part", (F.col("above") + F.col("base")).alias("start"))  # offsets: distinct integer scores only
    inside = Window.partitionBy("score", "part").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight").rowsBetween(Window.unboundedPreceding, -1)
    placed = each.withColumn("inner", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(starts, ["score", "part"])
    first = F.col("start") + F.col("inner")
    ranks = placed.select(*same, F.explode(F.sequence(first + 1, first + F.col("copies"))).alias("rank"))
    drawn = ranks.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    return drawn.union(scored.where(~F.col("fit") | (F.col("score") < cutoff)).select(*same, null))


def resample(docs: DataFrame, target: DataFrame, per_cent: int = PER_CENT, least_words: int = LEAST_WORDS, seed: int = SEED, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of docs; target holds the texts to come close to (column text)."""
    table = gains(counters(docs), counters(target))
    rows = weighed(docs, table, least_words).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    drawn = draw(written(rows, "scored"), per_cent, rows_per_range)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def resampled_documents(docs: DataFrame, target: DataFrame, **choices) -> DataFrame:
    """The drawn rows with all their columns; rows of one doc_id come together, as soon as one of them is drawn."""
    ids = resample(docs, target, **choices).where("rank is not null").select("doc_id").distinct()
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("own"))
    return held.join(ids, F.col("own").eqNullSafe(F.col("doc_id")), "left_semi").select("row.*")
