"""Substring dedup by compacting a De Bruijn graph of word windows.

An edge is a window of WINDOW consecutive words, from its first to its last WINDOW - 1 words. Edges are
kept together as in compaction of sequence graphs: each window has a minimiser (the least hash of its runs
of GRAM words), and a run is a stretch of windows of one document with the same minimiser. Equal windows
have equal minimisers, so only runs whose minimiser stands in two runs or more can repeat anything; they
are found by counting narrow rows, and texts stay where they are.

If all runs of a minimiser have the same words, they are one nonbranching path of repeated edges. If not,
their distinct runs are spelled out as edges, counted, and joined back as masks of repeated windows. A path
is joined to the next one where every place of it goes on alike and every place of the next one comes
from it (degrees by aggregation, then a join); the compacted paths carry their source coordinates. Places
of one path must agree on length and digest, else the paths are taken uncompacted. All words under a
repeated window are repeated spans.

Runs hold at most PIECE windows, and a run that holds a window twice is cut into single windows, so that
its windows meet like those of different runs. Edges and paths are told apart by 128 bits of hashes.

Defined cases: null text has no words; texts of fewer than WINDOW words have no window; a passage that
repeats within one document is removed at all its places; of fully repeated rows each is a place of its
own, so all their windows repeat; rows of a null doc_id are told apart by their texts; an empty table
gives no row; extra columns pass through removed_documents whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrafold.llm.shingles import blocks, mixed, word_hashes
from terrafold.llm.store import bounded, drop, written

WINDOW, GRAM, PIECE = 35, 8, 32
LONG_WORD = 1 << 19
_SPACE = b" \t\n\x0b\x0c\r"
_GAP = re.compile(rb"[ \t-\r]")
_IS_WORD = np.ones(256, np.int8)
_IS_WORD[list(_SPACE)] = 0
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_RUN = pa.schema([(c, pa.int64()) for c in ("own", "raw", "at", "n", "m", "c")])
_EDGE = pa.schema([(c, pa.int64()) for c in ("h1", "h2", "m", "c", "d", "places")])
_powers: dict[tuple[int, bool], np.ndarray] = {}


def _power(base: int, inverse: bool, n: int) -> np.ndarray:
    """1, b, b^2, ... or their inverses modulo 2^64, at least n of them."""
    held = _powers.get((base, inverse))
    if held is None or len(held) < n:
        held = np.full(max(n, 1 << 16), np.uint64(pow(base, -1, 1 << 64) if inverse else base))
        held[0] = 1
        held = _powers[base, inverse] = np.cumprod(held, dtype=np.uint64)
    return held[:n]


def _of_runs(h: np.ndarray, k: int, base: int) -> np.ndarray:
    """A hash of every k consecutive values: differences of a running polynomial sum, scaled back."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * _power(base, False, len(h)), out=sums[1:])
    return mixed((sums[k:] - sums[:-k]) * _power(base, True, n))


def hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word; a word that is longer than a block is hashed by itself."""
    out = []
    for block in blocks(data, _GAP):
        last = max(block.rfind(bytes([x])) for x in _SPACE) + 1
        if len(block) - last > LONG_WORD:
            out += [word_hashes(block[:last], _IS_WORD, False), np.array([xxhash.xxh64_intdigest(block[last:])], np.uint64)]
        else:
            out.append(word_hashes(block, _IS_WORD, False))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def windows(data: bytes, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two 64-bit hashes and the minimiser of each window of a text's words."""
    h = hashes(data)
    if len(h) < window:
        return (np.zeros(0, np.uint64),) * 3
    gram = min(GRAM, window)
    least, size, wide = _of_runs(h, gram, _BASES[0]), 1, window - gram + 1
    while size * 2 <= wide:
        least, size = np.minimum(least[:-size], least[size:]), size * 2
    if size < wide:
        least = np.minimum(least[: size - wide], least[wide - size :])
    return _of_runs(h, window, _BASES[0]), _of_runs(mixed(h), window, _BASES[1]), least


def runs(w1: np.ndarray, w2: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """at, n, content of the runs of a document's windows."""
    cut = np.ones(len(w1), bool)
    cut[1:] = least[1:] != least[:-1]
    starts = np.flatnonzero(cut)
    of = np.cumsum(cut) - 1
    if len(np.unique(w1)) < len(w1):  # windows that repeat in their own run stand alone
        order = np.lexsort((w1, of))
        same = (w1[order][1:] == w1[order][:-1]) & (of[order][1:] == of[order][:-1])
        single = np.zeros(len(starts), bool)
        single[of[order][1:][same]] = True
        cut |= single[of]
    at = np.flatnonzero(cut | ((np.arange(len(w1)) - starts[of]) % PIECE == 0))
    n = np.diff(at, append=len(w1))
    return at, n, mixed(w1[at] ^ mixed(w2[at + n - 1] + n.astype(np.uint64)))


def _arrays(columns: list[np.ndarray], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of at most 65,536 rows."""
    columns = [x.view(np.int64) if x.dtype == np.uint64 else x for x in columns]
    for k in range(0, len(columns[0]), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(x[k : k + (1 << 16)]) for x in columns], schema=schema)


def _find_runs(window: int):
    def run(batches):
        for b in batches:
            parts = []
            for own, raw, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()), strict=True):
                w1, w2, least = windows(text.as_py(), window)
                if len(w1):
                    at, n, c = runs(w1, w2, least)
                    parts.append([np.full(len(at), own), np.full(len(at), raw), at, n, least[at], c])
            if parts:
                yield from _arrays([np.concatenate(x) for x in zip(*parts, strict=True)], _RUN)

    return run


def _find_edges(window: int):
    def run(batches):
        for b in batches:
            for text, listed in zip(b.column(0).cast(pa.binary()), b.column(1), strict=True):
                w1, w2, _ = windows(text.as_py(), window)
                at, n, m, c, places = (np.array(x, np.int64) for x in zip(*[r.values() for r in listed.as_py()], strict=True))
                d = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                where = np.repeat(at, n) + d
                yield from _arrays([w1[where], w2[where], np.repeat(m, n), np.repeat(c, n), d, np.repeat(places, n)], _EDGE)

    return run


def covered(spans: list[dict], n_words: int, window: int) -> np.ndarray:
    """Which words stand under a repeated window; spans: at, n and the mask of repeated windows (below 0: all n)."""
    edge = np.zeros(n_words + 1, np.int64)
    for s in spans:
        if s["mask"] < 0:
            edge[s["at"]] += 1
            edge[s["at"] + s["n"] + window - 1] -= 1
        else:
            at = s["at"] + np.array([d for d in range(s["n"]) if s["mask"] >> d & 1], np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + window, -1)
    return np.cumsum(edge[:-1]) > 0


def kept_words(data: bytes, spans: list[dict] | None, window: int) -> Iterator[tuple[list[bytes], int]]:
    """Block by block: the words that no span covers, and how many words the block has."""
    gone = covered(spans, len(hashes(data)), window) if spans else None
    at = 0
    for block in blocks(data, _GAP):
        words = block.split()
        if gone is not None:
            keep = ~gone[at : at + len(words)]
            at += len(words)
            yield [w for w, k in zip(words, keep.tolist(), strict=True) if k], len(words)
        else:
            yield words, len(words)


def _digests(window: int):
    kind = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches):
        for b in batches:
            out = []
            for doc, text, spans in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()), b.column(2), strict=True):
                digest, n, left = hashlib.sha256(), 0, 0
                for words, all_words in kept_words(text.as_py(), spans.as_py(), window):
                    if words:
                        digest.update((b" " if left else b"") + b" ".join(words))
                    left, n = left + len(words), n + all_words
                out.append({"doc_id": doc, "n_words": n, "n_removed": n - left, "kept_sha256": digest.hexdigest()})
            yield pa.RecordBatch.from_pylist(out, schema=kind)

    return run


def keyed(docs: DataFrame, *more) -> DataFrame:
    """more, text, own, raw: rows of equal own and raw have the same text, as far as 64 bits and a doc_id tell."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return bounded(docs).select(*more, text.alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("own"), F.xxhash64(text).alias("raw"))


def candidates(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """own, raw, at, n, m, c, pure: the runs whose minimiser m stands in two runs or more; pure where those have the same words. Written."""
    rows = keyed(docs).select("own", "raw", "text").mapInArrow(_find_runs(window), "own long, raw long, at long, n long, m long, c long")
    rows = written(rows, "runs")
    found = rows.groupBy("m").agg(F.count("*").alias("k"), F.min("c").alias("low"), F.max("c").alias("high")).where("k > 1")
    # Written, so that the join reads both sides from plain exchanges and a hot minimiser can be split.
    shared = written(found.select("m", (F.col("low") == F.col("high")).alias("pure")), "shared")
    out = written(rows.join(shared, "m").select("own", "raw", "at", "n", "m", "c", "pure"), "candidates")
    drop(rows, shared)
    return out


def branching(docs: DataFrame, runs_of: DataFrame, window: int = WINDOW) -> DataFrame:
    """m, c, mask: the repeated windows of every distinct run whose minimiser has several; written."""
    several = runs_of.where(~F.col("pure")).groupBy("m", "c").agg(F.count("*").alias("places"), F.min(F.struct("own", "raw", "at", "n")).alias("one"))
    spelled = several.groupBy(F.col("one.own").alias("own"), F.col("one.raw").alias("raw")).agg(
        F.collect_list(F.struct(F.col("one.at").alias("at"), F.col("one.n").alias("n"), "m", "c", "places")).alias("runs"))
    spelled = written(spelled, "spelled")  # one row of each text; its copies among repeated rows add nothing that does not repeat
    texts = keyed(docs).join(spelled.hint("shuffle_hash"), ["own", "raw"]).select("text", "runs")
    edges = written(texts.mapInArrow(_find_edges(window), "h1 long, h2 long, m long, c long, d long, places long"), "edges")
    twice = written(edges.groupBy("h1", "h2").agg(F.sum("places").alias("k")).where("k > 1").select("h1", "h2"), "twice")
    masks = edges.join(twice, ["h1", "h2"]).groupBy("m", "c").agg(F.bit_or(F.expr("shiftleft(1L, cast(d as int))")).alias("mask"))
    out = written(masks, "masks")
    drop(spelled, edges, twice)
    return out


def compacted(pieces: DataFrame) -> DataFrame:
    """own, raw, at, n, m, c: paths in place of pure pieces (own, raw, at, n, m, c; distinct by own, raw, at).

    A piece ends its path unless all places of it are followed by the same piece; it begins one unless all
    places of it follow the same piece. Where the one is joined to the other in one document, it is in all.
    """
    order = Window.partitionBy("own", "raw").orderBy("at")
    name = F.xxhash64("m", "c")
    after = F.when(F.lead("at").over(order) == F.col("at") + F.col("n"), F.lead(name).over(order))
    before = F.when(F.lag(F.col("at") + F.col("n")).over(order) == F.col("at"), F.lag(name).over(order))
    arcs = pieces.select("m", "c", after.alias("after"), before.alias("before"))
    one = lambda x: (F.count(x) == F.count("*")) & (F.min(x) == F.max(x))
    degrees = written(arcs.groupBy("m", "c").agg(one("after").alias("onward"), one("before").alias("back")), "degrees")
    joined = pieces.join(degrees, ["m", "c"])
    on = (F.lag(F.col("at") + F.col("n")).over(order) == F.col("at")) & F.lag("onward").over(order) & F.coalesce("back", F.lit(False))
    numbered = joined.withColumn("head", F.when(F.coalesce(on, F.lit(False)), 0).otherwise(1)).withColumn("path", F.sum("head").over(order))
    paths = numbered.groupBy("own", "raw", "path").agg(
        F.min("at").alias("at"), F.sum("n").alias("n"), F.min_by(F.struct("m", "c"), "at").alias("first"), F.bit_xor(name).alias("digest"))
    paths = written(paths.select("own", "raw", "at", "n", "first.m", "first.c", "digest"), "paths")
    drop(degrees)
    return paths


def verified(paths: DataFrame) -> bool:
    """Whether all source coordinates of each path agree on its length and digest."""
    each = paths.groupBy("m", "c").agg(F.min("n").alias("a"), F.max("n").alias("b"), F.min("digest").alias("x"), F.max("digest").alias("y"))
    return not each.where("a != b or x != y").head(1)


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """own, raw, spans (at, n, mask): where the repeated windows of each text with any lie; written."""
    found = candidates(docs, window)
    masks = branching(docs, found, window)
    each = written(found.dropDuplicates(["own", "raw", "at"]), "placed")
    pure = each.where("pure").drop("pure")
    paths = compacted(pure)
    whole = paths if verified(paths) else pure
    span = lambda mask: F.struct("at", "n", mask.cast("long").alias("mask")).alias("span")
    parts = each.where(~F.col("pure")).join(masks, ["m", "c"])
    every = whole.select("own", "raw", span(F.lit(-1))).union(parts.select("own", "raw", span(F.col("mask"))))
    out = written(every.groupBy("own", "raw").agg(F.collect_list("span").alias("spans")), "spans")
    drop(found, masks, each, paths)
    return out


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row: the kept words joined by one space."""
    spans = repeated_spans(docs, window)
    rows = keyed(docs, F.col("doc_id").cast("long").alias("doc_id")).join(spans.hint("shuffle_hash"), ["own", "raw"], "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(_digests(window), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def removed_documents(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with the kept words as text, and all other columns as they were."""
    spans = repeated_spans(docs, window)

    @F.pandas_udf("string")
    def kept(texts: pd.Series, spans: pd.Series) -> pd.Series:
        of = [b" ".join(w for words, _ in kept_words(t.encode(), None if s is None else list(s), window) for w in words) for t, s in zip(texts, spans, strict=True)]
        return pd.Series([x.decode() for x in of], dtype=object)

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = keyed(docs, row).join(spans.hint("shuffle_hash"), ["own", "raw"], "left")
    text = F.when(F.col("row.text").isNotNull(), kept("text", "spans"))
    return rows.withColumn("kept", text).select(*[F.col("kept").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


ORACLE = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS l FROM documents),
s AS (SELECT doc_id, i, array_to_string(l[i : i + 34], ' ') AS k FROM w, unnest(range(1, len(l) - 33)) AS u(i)),
r AS (SELECT doc_id, i FROM s WHERE k IN (SELECT k FROM s GROUP BY k HAVING count(*) > 1)),
g AS (SELECT DISTINCT doc_id, i + o AS i FROM r, range(0, 35) AS u(o)),
a AS (SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id),
e AS (SELECT w.doc_id, unnest(l) AS word, unnest(range(1, len(l) + 1)) AS i FROM w),
k AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.i) AS t FROM e LEFT JOIN g ON g.doc_id = e.doc_id AND g.i = e.i WHERE g.i IS NULL GROUP BY e.doc_id)
SELECT w.doc_id, len(l) AS n_words, coalesce(len(a.gone), 0) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM w LEFT JOIN a USING (doc_id) LEFT JOIN k USING (doc_id)
"""
