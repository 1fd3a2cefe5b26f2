"""Exact dedup: content-defined chunk recipes.

Each text is read once. Its white space ([\\x20\\x09-\\x0D]) is deleted, the UTF-8 bytes are cut
where a hash of the last eight bytes has COARSE zero bits, and every chunk becomes an identifier of
16 bytes. A dictionary of all chunks verifies the identifiers: if any of them stands for two lengths
or two values of an independent 64-bit hash, all identifiers are lengthened by both. Documents are
equal when their ordered identifier lists are, so only lists move between machines, not texts.

Defined cases: null counts as empty; empty texts are equal to one another; of equal texts the row
with most code points, then the smallest doc_id, stays (a null doc_id comes last); of rows of one doc_id
with equal texts exactly one is kept (where their white space differs, one of the least text hash); extra
columns pass through whatever their names. "Verified" means by length and a second hash, not by bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.store import bounded, repeated, row_key, written

SPACE = b" \t\n\x0b\x0c\r"
LEAST, MOST, COARSE = 1024, 16384, 12
_BLOCK = 1 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: The same white space, as a pattern of Java and of DuckDB.
SPACE_PATTERN = "[ \\t-\\r]"


def cut_points(data: bytes) -> list[int]:
    """Ends of the chunks; each depends on the bytes since the cut before it only."""
    n, ends, last = len(data), [], 0
    for at in range(0, max(0, n - 7), _BLOCK):
        m = min(_BLOCK, n - 7 - at)
        windows = np.ndarray((m,), "<u8", data, at, (1,))
        for p in (np.flatnonzero((windows * _MULTIPLIER) >> np.uint64(64 - COARSE) == 0) + (at + 8)).tolist():
            while p - last > MOST:
                last += MOST
                ends.append(last)
            if p - last >= LEAST:
                last = p
                ends.append(p)
    while n - last > MOST:
        last += MOST
        ends.append(last)
    if last < n or not ends:
        ends.append(n)
    return ends


_ROW = pa.schema([
    ("doc_id", pa.int64()), ("raw", pa.int64()), ("n_chars", pa.int64()), ("text_sha256", pa.string()),
    ("chunks", pa.list_(pa.struct([("id", pa.binary()), ("length", pa.int64()), ("check", pa.int64())])))])


def _recipe(data: bytes) -> list[dict]:
    start, out = 0, []
    for end in cut_points(data):
        chunk = data[start:end]
        out.append({"id": hashlib.blake2b(chunk, digest_size=16).digest(), "length": end - start,
                    "check": xxhash.xxh64_intdigest(chunk) - (1 << 63)})
        start = end
    return out


def _recipes(batches):
    for b in batches:
        for k in range(0, b.num_rows, 256):
            sub, out = b.slice(k, 256), []
            texts = sub.column("text").cast(pa.binary())
            for doc, raw, n, text in zip(*(sub.column(c).to_pylist() for c in ("doc_id", "raw", "n")), texts, strict=True):
                data = (text.as_py() or b"").translate(None, SPACE)
                out.append({"doc_id": doc, "raw": raw, "n_chars": n, "text_sha256": hashlib.sha256(data).hexdigest(), "chunks": _recipe(data)})
            yield pa.RecordBatch.from_pylist(out, schema=_ROW)


def recipes(docs: DataFrame) -> DataFrame:
    """doc_id, raw (a hash of the text as it stands), n_chars, text_sha256 and the ordered chunks of every row, written to the shared folder."""
    slim = bounded(docs).select(F.col("doc_id").cast("long"), row_key(F.col("doc_id"), F.col("text"))["raw"].alias("raw"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n"), "text")
    kind = "doc_id long, raw long, n_chars long, text_sha256 string, chunks array<struct<id: binary, length: long, check: long>>"
    return written(slim.mapInArrow(_recipes, kind), "recipes")


def dictionary(made: DataFrame) -> DataFrame:
    """One row per identifier: length, references, and whether one content stands behind it."""
    return (
        made.select(F.explode("chunks").alias("c")).groupBy("c.id")
        .agg(F.count("*").alias("refs"), F.min("c.length").alias("length"), F.max("c.length").alias("most"),
             F.min("c.check").alias("low"), F.max("c.check").alias("high"))
        .select("id", "length", "refs", ((F.col("length") == F.col("most")) & (F.col("low") == F.col("high"))).alias("verified"))
    )


def _decided(docs: DataFrame) -> DataFrame:
    """One row for each doc_id, content and length: copies (rows), raw (the least text hash), raws (rows with it), stays, and its group."""
    made = recipes(docs)
    clean = not dictionary(made).where(~F.col("verified")).head(1)
    ids = F.col("chunks.id") if clean else F.transform(
        "chunks", lambda c: F.concat(c["id"], c["length"].cast("binary"), c["check"].cast("binary")))
    rows = made.groupBy(ids.alias("recipe"), "text_sha256", "doc_id", "n_chars", "raw").agg(F.count("*").alias("raws"))
    rows = rows.groupBy("recipe", "text_sha256", "doc_id", "n_chars").agg(F.sum("raws").alias("copies"), F.min(F.struct("raw", "raws")).alias("least"))
    order = F.struct((-F.col("n_chars")).alias("size"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    # Written, so that the join reads both sides from plain exchanges and a hot recipe can be split.
    groups = written(rows.groupBy("recipe").agg(F.min(order).alias("first"), F.sum("copies").alias("group_size")), "groups")
    stays = F.col("doc_id").eqNullSafe(F.col("first.id")) & (F.col("n_chars") == -F.col("first.size"))
    return rows.join(groups, "recipe").select(
        "doc_id", F.col("first.id").alias("keep_id"), "group_size", stays.alias("stays"), "text_sha256", "copies", "least.raw", "least.raws")


def decide(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for every row of docs."""
    each = _decided(docs).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return each.select("doc_id", "keep_id", "group_size", (F.col("stays") & (F.col("copy") == 1)).alias("kept"), "text_sha256")


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns; texts are dealt once, to meet the narrow list of what stays."""
    keys = row_key(F.col("doc_id"), F.col("text"))
    kept = _decided(docs).where("stays")
    chosen = kept.select(keys["none"].alias("none"), keys["own"].alias("own"), "raw", F.col("raws").alias("copies"), F.lit(1).cast("long").alias("high"), F.lit(1).alias("most"), F.lit(0).alias("rest"))
    return repeated(docs, keys, chosen)


ORACLE = """
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[ \\t-\\r]', '', 'g') AS k FROM documents),
r AS (SELECT doc_id, sha256(k) AS text_sha256, first_value(doc_id) OVER (PARTITION BY k ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY k) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""
