"""Document fingerprints: bottom-k sketches of word-shingle hashes, with built-in functions only.

A sketch is the ascending list of the K smallest distinct 64-bit hashes of a text's shingles of five
words (lower case, split at white space; a text of fewer words has one shingle of all of them). The
sketch of a union is the bottom k of the two lists, so parts merge in any order. Resemblance,
containment and the number of distinct shingles are estimated from sketches alone, and are exact for
texts of fewer than K shingles.

Defined cases: null counts as empty and has an empty sketch; two empty sketches resemble each other
fully (1), an empty and a non-empty one not at all (0); rows are ordered by doc_id (nulls first), rows
that repeat a doc_id by text; a table of one row is its own next document; an empty table gives no
row; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrafold.llm.ordering import following, ranges
from terrafold.llm.store import written

K = 128
WORDS = 5
ROWS_PER_RANGE = 64


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def sketch(text: Column, k: int = K, words: int = WORDS) -> Column:
    """array<bigint>: the k smallest distinct shingle hashes. Each word is hashed once, and a shingle from its words' hashes."""

    def of(h: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.greatest(F.size(h) - words, F.lit(0))), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(words)]))
        return F.slice(F.sort_array(F.array_distinct(each)), 1, k)

    clean = F.trim(F.lower(F.coalesce(text, F.lit(""))), F.lit(" \t\n\x0b\x0c\r"))
    hashes = F.transform(F.split(clean, "[ \\t-\\r]+"), lambda w: F.xxhash64(w))
    return F.when(clean == "", F.array().cast("array<bigint>")).otherwise(bound(hashes, of))


def merge(a: Column, b: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of two texts."""
    both = F.size(F.array_intersect(a, b))
    share = bound(merge(a, b, k), lambda u: F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u))
    return F.when(F.size(a) + F.size(b) == 0, 1.0).when(both == 0, 0.0).otherwise(share)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    largest = (F.element_at(a, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / largest)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too; 1 for an empty a."""
    union = distinct_shingles(merge(a, b, k), k)
    share = resemblance(a, b, k) * union / distinct_shingles(a, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), share))


def packed(a: Column) -> Column:
    """The sketch as a string of 16 hex digits per hash."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, part, ghost of every row and, after each range, the row that follows it (ghost).

    Ranges are contiguous in doc_id and hold about ROWS_PER_RANGE rows, so that a window over a range
    sees each row's successor, whatever the table's size. The last range is followed by the first row.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    made = ranges(slim, "doc_id", ROWS_PER_RANGE)
    placed = made.place(slim, "doc_id")
    low = slim.agg(F.min("doc_id").alias("low"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).first()
    starts = slim.where(F.col("doc_id").isNull() if low.nulls else F.col("doc_id") == F.lit(low.low))
    own = placed.select("doc_id", "text", "part", F.lit(0).alias("ghost"))
    if not made.first:
        return own.union(starts.select("doc_id", "text", F.lit(0).cast("long").alias("part"), F.lit(2).alias("ghost")))
    parts = written(placed.groupBy("part").agg(F.min("doc_id").alias("least")), "parts")
    last = parts.agg(F.max("part")).first()[0]
    links = written(following(parts, ["least"]).select("part", F.col("next_least").alias("doc_id")), "following")
    if not made.deeper:
        links = F.broadcast(links)  # MAX_RANGES rows of two numbers at most
    followers = slim.join(links, "doc_id").select("doc_id", "text", "part", F.lit(1).alias("ghost"))
    return own.union(followers).union(starts.select("doc_id", "text", F.lit(last).cast("long").alias("part"), F.lit(2).alias("ghost")))


def edited_fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """Per row: its fingerprint, and that of its text with the last quarter replaced from the next row's text."""
    order = Window.partitionBy("part").orderBy("ghost", "doc_id", "text")
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter))
    rows = with_next(docs).withColumn("own", sketch(F.col("text"), k))
    rows = rows.withColumns({"next_text": F.lead("text").over(order), "after": F.lead("own").over(order)}).where("ghost = 0")
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "own", "after")
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "own", "after", sketch(F.col("edited"), k).alias("changed"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", packed(F.col("own")).alias("fingerprint"), packed(F.col("changed")).alias("edited_fingerprint"),
        resemblance(F.col("own"), F.col("changed"), k).alias("near_edited"), resemblance(F.col("own"), F.col("after"), k).alias("near_next"),
        distinct_shingles(F.col("own"), k).alias("n_shingles"), containment(F.col("own"), F.col("changed"), k).alias("contained_in_edited"))
