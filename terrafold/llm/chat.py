"""Chat formatting: cumulative-snapshot collapse and rendering, with built-in functions only.

A log may hold a conversation several times, each time with a few more turns. A turn's hash binds its
position to the exact sums of two 64-bit hashes of its rows' role and text, and the prefix hash of a turn
is the exact sum of the turns' hashes up to it; a conversation whose last prefix hash is an inner prefix
hash of another one is a snapshot of it and is dropped by an anti-join, and of equal conversations the
smallest conv_id stays. What remains is rendered in segments of SEGMENT turns.

Rows are added up by turn before anything else, so a turn of very many rows is one row of the sums;
prefix sums go by segments first and over the segments of a conversation then. A turn of more than
SEGMENT rows is rendered in parts of its own, dealt by hash, and the segment's other turns before and
after it are parts as well, so no task and no string holds a large share of the rows.

Defined cases: positions are turn minus the conversation's smallest turn (null turns come first, as
position -1); rows of one turn are ordered by role and text and belong together, in a turn of more than
SEGMENT rows by hash, SEGMENT copies of a repeated row at a time; null role or text counts as empty; rows of a
null conv_id are one conversation; an empty table gives no row; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrafold.llm.store import written

SEGMENT = 64
SEEDS = (11, 12)
HEAD, TAIL = "<|im_start|>", "<|im_end|>\n"
CONV = ["conv", "none"]
TURN = [*CONV, "turn", "bare"]
_HASHES = [f"h{k}" for k in range(len(SEEDS))]
_EXACT = "decimal(38,0)"


def _lines(turns: DataFrame) -> DataFrame:
    """TURN, role, text, copies: the distinct rows, null ids and turns apart from 0."""
    zero = F.lit(0).cast("long")
    rows = turns.select(
        F.coalesce(F.col("conv_id").cast("long"), zero).alias("conv"), F.col("conv_id").isNull().alias("none"), F.coalesce(F.col("turn").cast("long"), zero).alias("turn"),
        F.col("turn").isNull().alias("bare"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.groupBy(*TURN, "role", "text").agg(F.count("*").alias("copies"))


def _prefixes(lines: DataFrame) -> DataFrame:
    """TURN, at, segment, rows (of the turn), group (of turns rendered together) and the running sums n, h0, h1 up to the turn; written."""
    each = [F.sum(F.xxhash64(F.lit(seed), "role", "text").cast("decimal(20,0)") * F.col("copies")).cast(_EXACT).alias(f"t{k}") for k, seed in enumerate(SEEDS)]
    turns = written(lines.groupBy(*TURN).agg(F.sum("copies").alias("rows"), *each), "turns")
    least = written(turns.groupBy(*CONV).agg(F.coalesce(F.min(F.when(~F.col("bare"), F.col("turn"))), F.lit(0)).alias("least")), "least")
    at = F.when(F.col("bare"), F.lit(-1)).otherwise(F.col("turn") - F.col("least"))
    turns = turns.join(least, CONV).withColumn("at", at.cast("long"))
    turns = turns.withColumn("segment", F.floor(F.greatest("at", F.lit(0)) / SEGMENT))
    for k, seed in enumerate(SEEDS):
        turns = turns.withColumn(f"h{k}", F.xxhash64(F.lit(seed), "at", "rows", "t0", "t1").cast("decimal(20,0)"))
    sums = turns.groupBy(*CONV, "segment").agg(F.sum("rows").alias("sn"), *[F.sum(h).alias(f"s_{h}") for h in _HASHES])
    earlier = Window.partitionBy(*CONV).orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    base = lambda c, kind: F.coalesce(F.sum(F.col(c).cast(kind)).over(earlier), F.lit(0).cast(kind)).alias(c)
    sums = sums.select(*CONV, "segment", base("sn", "long"), *[base(f"s_{h}", _EXACT) for h in _HASHES])
    inside = Window.partitionBy(*CONV, "segment").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    large = F.col("rows") > SEGMENT
    # Large turns stand alone: each one, and what follows it, begins a group.
    starts = large | F.coalesce(F.lag(large).over(Window.partitionBy(*CONV, "segment").orderBy("at")), F.lit(False))
    placed = turns.withColumns({"starts": starts.cast("int"), "n": F.sum("rows").over(inside), **{h: F.sum(h).over(inside) for h in _HASHES}})
    placed = placed.withColumn("group", F.sum("starts").over(inside)).join(sums, [*CONV, "segment"])
    return written(placed.select(*TURN, "at", "segment", "rows", "group", (F.col("n") + F.col("sn")).alias("n"), *[(F.col(h) + F.col(f"s_{h}")).cast(_EXACT).alias(h) for h in _HASHES]), "prefixes")


def maximal(prefixes: DataFrame) -> DataFrame:
    """conv, none of the conversations that prefix no other and, of equal ones, come first."""
    keys = ["n", *_HASHES]
    whole = prefixes.groupBy(*CONV).agg(F.max(F.struct("at", *keys)).alias("last"))
    inner = prefixes.join(whole.select(*CONV, F.col("last.at").alias("end")), CONV).where(F.col("at") < F.col("end")).select(*keys).distinct()
    first = whole.groupBy(*[F.col(f"last.{c}").alias(c) for c in keys]).agg(F.min(F.struct("none", "conv")).alias("c"))
    return first.join(inner, keys, "left_anti").select(F.col("c.conv").alias("conv"), F.col("c.none").alias("none"))


def collapse(turns: DataFrame) -> DataFrame:
    """conv_id, segment, first_turn, part, n_rows, rendered: the maximal conversations, in segments of SEGMENT turns.

    A segment is one row unless it has a turn of more than SEGMENT rows; then its rows are in order of
    first_turn (a position) and part (0 but for parts of a large turn).
    """
    lines = written(_lines(turns), "lines")
    prefixes = _prefixes(lines)
    kept = prefixes.join(maximal(prefixes), CONV, "left_semi").select(*TURN, "at", "segment", "rows", "group")
    each = lines.join(kept, TURN).withColumn("hash", F.when(F.col("rows") > SEGMENT, F.xxhash64("role", "text")).otherwise(F.lit(0).cast("long")))
    # A large turn is cut by hash into parts of about SEGMENT distinct rows, and again where a row has more copies than that.
    pieces = F.ceil(F.col("rows") / SEGMENT)
    bucket = F.when(F.col("rows") > SEGMENT, F.floor((F.shiftright("hash", 1).cast("double") / 2.0**63 + 0.5) * pieces)).otherwise(0)
    chunks = F.when(F.col("rows") > SEGMENT, F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / SEGMENT))).otherwise(F.array(F.lit(0).cast("long")))
    each = each.withColumns({"bucket": bucket.cast("long"), "chunk": F.explode(chunks)})
    copies = F.when(F.col("rows") > SEGMENT, F.least(F.lit(SEGMENT), F.col("copies") - SEGMENT * F.col("chunk"))).otherwise(F.col("copies"))
    each = each.withColumns({"copies": copies, "part": F.when(F.col("rows") > SEGMENT, F.shiftleft("bucket", 32) + F.col("chunk") + 1).otherwise(0)})
    line = F.repeat(F.concat(F.lit(HEAD), F.col("role"), F.lit("\n"), F.col("text"), F.lit(TAIL)), F.col("copies").cast("int"))
    listed = F.sort_array(F.collect_list(F.struct("at", "hash", "role", "text", line.alias("line"))))
    out = each.groupBy(*CONV, "segment", "group", "part").agg(
        F.min("at").alias("first_turn"), F.sum("copies").alias("n_rows"), F.array_join(F.transform(listed, lambda x: x["line"]), "").alias("rendered"))
    return out.select(F.when(~F.col("none"), F.col("conv")).alias("conv_id"), "segment", "first_turn", "part", "n_rows", "rendered")


ORACLE = """
WITH c AS (SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn, role, text) AS l FROM conversations GROUP BY conv_id),
o AS (SELECT conv_id, l, to_json(l) AS j, len(l) AS n FROM c),
p AS (SELECT DISTINCT to_json(l[1:k]) AS j FROM o, unnest(range(1, n)) AS u(k)),
f AS (SELECT min(conv_id) AS conv_id, j FROM o GROUP BY j),
m AS (SELECT conv_id FROM f WHERE j NOT IN (SELECT j FROM p)),
b AS (SELECT conv_id, min(turn) AS least FROM conversations GROUP BY conv_id)
SELECT x.conv_id, (x.turn - b.least) // 64 AS segment, min(x.turn - b.least) AS first_turn, CAST(0 AS BIGINT) AS part, count(*) AS n_rows,
       string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY x.turn, role, text) AS rendered
FROM conversations x JOIN m USING (conv_id) JOIN b USING (conv_id) GROUP BY 1, 2
"""
