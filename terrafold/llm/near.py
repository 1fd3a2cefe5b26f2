"""Near-duplicate classes: improved consistent weighted sampling over TF-IDF shingles.

1. Document frequencies of all shingles of all documents, in a sketch of 2**DF_BITS counters (fixed
   size, so it can be broadcast): a counter's excess over the mean and three deviations estimates the
   frequency of a shingle that stands out.
2. A shingle's weight is its count in the text times 1 - DAMPING * log_N(df). The damping keeps large
   groups of near copies together: with plain ln(N / df) the shingles that a group shares would weigh
   far less than each copy's own edits.
3. ROWS x BANDS consistent weighted samples of each text (Ioffe's scheme); texts that agree on all
   samples of a band share a bucket. Texts with equal shingles are one node from here on.
4. Each bucket names a hub, the member that meets most others in all its buckets, and members are
   compared with their hubs: agreement of the samples below LEAST_AGREEMENT rules a pair out (6 deviations
   from 0.8); the rest are verified by exact weighted Jaccard similarity, THRESHOLD or more. Links give
   connected components, the classes.
5. Buckets that hold several classes beside their hub, whose pairs have all been tried, are compared in
   full, in cells of two blocks of members. What a text alone has of all texts in such buckets is common to no pair, so its partners weigh no more than its
   reach, (1 + t) / t times its shared weight less its weight. Members whose bucket has no weight within
   their reach are left out (no pair of theirs can link), and so are pairs beyond it. A cell computes the
   common weights of all its other pairs by a matrix product over the shingles that two or more of them
   have, and returns one verified link for each two classes that meet. So pairs are never rows of a table,
   and pairs are left out only if they cannot link or their classes are joined: the classes are those of
   all pairs of all buckets. Nothing is capped.

Defined cases: null counts as empty; a text without words is alone in its class; class_id is the
smallest doc_id of a class (null only if it has no other), whose row of the least text hash stays; rows
that repeat a doc_id count as rows of that document; an empty table gives no row; extra columns pass
through keep_representatives whatever their names.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.llm.shingles import shingles
from terrafold.llm.store import bounded, drop, repeated, row_key, written

THRESHOLD = 0.8
BANDS, ROWS = 14, 4
SAMPLES = BANDS * ROWS
LEAST_AGREEMENT = 0.5
DAMPING = 0.25
DF_BITS, SLICE_BITS = 20, 14
#: Members of a block in which the classes of a bucket are compared.
SIDE = 512
#: Bytes of shingles in a block; shingles of one matrix product; how near to the threshold products are checked again.
BLOCK_BYTES, SLICE, DOUBT = 16 << 20, 4096, 1e-3
_BLOCK = 1024


def _bucket(s: np.ndarray) -> np.ndarray:
    return (s * np.uint32(0x9E3779B1)) >> np.uint32(32 - DF_BITS)


def document_weights(docs: DataFrame) -> np.ndarray:
    """The weight 1 - DAMPING * log_N(df) of each of the 2**DF_BITS buckets of shingles."""
    size, part = 1 << DF_BITS, 1 << SLICE_BITS

    def count(batches):
        sums, held, n, rows = np.zeros(size, np.uint32), [], 0, 0
        for b in batches:
            rows += b.num_rows
            for text in b.column("text").cast(pa.binary()):
                own = _bucket(np.unique(shingles(text.as_py())))
                held.append(own)
                n += len(own)
                if n > size:
                    sums += np.bincount(np.concatenate(held), minlength=size).astype(np.uint32)
                    held, n = [], 0
        if held:
            sums += np.bincount(np.concatenate(held), minlength=size).astype(np.uint32)
        pack = zstandard.ZstdCompressor(level=1)
        yield pa.RecordBatch.from_pydict({
            "slice": pa.array(range(size // part), pa.int32()), "rows": pa.array([rows] + [0] * (size // part - 1), pa.int64()),
            "counts": [pack.compress(sums[k : k + part].tobytes()) for k in range(0, size, part)]})

    def add(batches):
        sums: dict[int, list] = {}
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            for k, rows, data in zip(*(b.column(c).to_pylist() for c in ("slice", "rows", "counts")), strict=True):
                into = sums.setdefault(k, [0, np.zeros(part, np.int64)])
                into[0] += rows
                into[1] += np.frombuffer(unpack.decompress(data), np.uint32)
        yield pa.RecordBatch.from_pydict({
            "slice": pa.array(list(sums), pa.int32()), "rows": pa.array([x[0] for x in sums.values()], pa.int64()),
            "counts": pa.array([x[1].tobytes() for x in sums.values()], pa.binary())})

    kind = "slice int, rows long, counts binary"
    parts = docs.select("text").mapInArrow(count, kind).repartition(size // part, "slice").mapInArrow(add, kind).collect()
    sums, n = np.zeros(size, np.float64), 0
    for p in parts:
        sums[p.slice * part : (p.slice + 1) * part] = np.frombuffer(p.counts, np.int64)
        n += p.rows
    usual = np.median(sums)
    excess = sums - usual - 3 * math.sqrt(usual)
    df = np.clip(excess, 1, max(n, 2))
    return (1 - DAMPING * np.log(df) / math.log(max(n, 2))).astype(np.float32)


class Sampler:
    """Consistent weighted samples; r and c are Gamma(2, 1), beta is uniform, all from hashes of (shingle, sample)."""

    def __init__(self, weights: np.ndarray) -> None:
        rng = np.random.default_rng(7)
        self.weights = weights
        self.odd = rng.integers(1, 1 << 32, (SAMPLES, 1), dtype=np.uint32) | np.uint32(1)
        n = 1 << 16
        self.r = rng.gamma(2, 1, n).astype(np.float32)
        self.inverse = (1 / self.r).astype(np.float32)
        self.log_c = np.log(rng.gamma(2, 1, n)).astype(np.float32)
        self.beta = rng.random(n, dtype=np.float32)

    def weigh(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        unique, counts = np.unique(s, return_counts=True)
        return unique, counts * self.weights[_bucket(unique)]

    def samples(self, s: np.ndarray) -> np.ndarray:
        """SAMPLES hashes of (shingle, level) for the sorted shingles of a text."""
        unique, w = self.weigh(s)
        log_w = np.log(w).astype(np.float32)
        best, found = None, None
        each = np.arange(SAMPLES)
        for at in range(0, len(unique), _BLOCK):
            u = unique[at : at + _BLOCK]
            k = ((u * self.odd) ^ (u >> np.uint32(16))) >> np.uint32(16)
            r, beta = self.r[k], self.beta[k]
            level = np.floor(log_w[at : at + _BLOCK] * self.inverse[k] + beta)
            log_a = self.log_c[k] - r * (level - beta + 1)
            first = np.argmin(log_a, axis=1)
            low, what = log_a[each, first], u[first] * np.uint32(0x85EBCA77) + level[each, first].astype(np.int32).astype(np.uint32) * np.uint32(0xC2B2AE3D)
            if best is None:
                best, found = low, what
            else:
                found = np.where(low < best, what, found)
                best = np.minimum(low, best)
        return found

    def similarity(self, a: np.ndarray, b: np.ndarray) -> float:
        """Weighted Jaccard similarity of two sorted shingle lists."""
        ua, wa = self.weigh(a)
        ub, wb = self.weigh(b)
        both, i, j = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
        common = float(np.minimum(wa[i], wb[j]).sum())
        total = float(wa.sum() + wb.sum()) - common
        return common / total if total else 0.0


def sketches(docs: DataFrame, shared) -> DataFrame:
    """row (unique), doc_id, raw (hash of the text), digest (the node), weight, samples, shingles of every row, written to the shared folder."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("raw", pa.int64()), ("digest", pa.binary()), ("weight", pa.float64()), ("samples", pa.list_(pa.int32())), ("shingles", pa.binary())])

    def make(batches):
        sampler = Sampler(shared.value)
        for b in batches:
            for k in range(0, b.num_rows, 256):
                sub, out = b.slice(k, 256), []
                for row, doc, raw, text in zip(sub.column("row").to_pylist(), sub.column("doc_id").to_pylist(), sub.column("raw").to_pylist(), sub.column("text").cast(pa.binary()), strict=True):
                    s = shingles(text.as_py())
                    own = s.tobytes()
                    digest = hashlib.blake2b(own or b"no words in %d" % (-1 if doc is None else doc), digest_size=16).digest()
                    out.append((row, doc, raw, digest, float(sampler.weigh(s)[1].sum(dtype=np.float64)), sampler.samples(s).view(np.int32) if len(s) else [], own))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    slim = bounded(docs).select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), row_key(F.col("doc_id"), F.col("text"))["raw"].alias("raw"), "text")
    return written(slim.mapInArrow(make, "row long, doc_id long, raw long, digest binary, weight double, samples array<int>, shingles binary"), "sketches")


def components(edges: DataFrame) -> DataFrame:
    """node, class (the smallest node that links reach); edges: a, b. Only nodes with links.

    Labels spread to neighbours and jump to their label's label until nothing changes; each round is
    written, so a lost executor repeats one round at most.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("class")), "labels")
    held = labels
    while True:
        spread = (
            both.join(labels.select(F.col("node").alias("b"), "class"), "b").groupBy(F.col("a").alias("node")).agg(F.min("class").alias("near"))
            .join(labels, "node").select("node", F.least("near", "class").alias("class"), F.col("class").alias("old"))
        )
        spread = written(spread, "labels")
        jumped = spread.join(spread.select(F.col("node").alias("class"), F.col("class").alias("far")), "class").select(
            "node", F.least("class", "far").alias("class"), "old")
        jumped = written(jumped, "labels")
        changed = bool(jumped.where(F.col("class") != F.col("old")).head(1))
        drop(spread, held)
        held, labels = jumped, jumped.select("node", "class")
        if not changed:
            drop(both)
            return labels


def _agreement(a: Column, b: Column) -> Column:
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return same / SAMPLES


def _led(members: DataFrame) -> DataFrame:
    """members (a, band, key, score) of buckets of two or more, with the bucket's hub b: the highest score, then the smallest digest."""
    hubs = members.groupBy("key").agg(F.min(F.struct((-F.col("score")).alias("score"), "a")).alias("h"), F.count("*").alias("n"))
    hubs = written(hubs.where("n > 1").select("key", F.col("h.a").alias("b")), "hubs")
    return written(members.join(hubs, "key"), "buckets")


def _reaching(members: DataFrame, texts: DataFrame, shared, threshold: float) -> DataFrame:
    """members (a, key, class) that some other class of their bucket may link with, with weight and reach. texts: digest, weight, shingles."""

    def spread(batches):
        sampler = Sampler(shared.value)
        for b in batches:
            for digest, data in zip(b.column("digest").to_pylist(), b.column("shingles").to_pylist(), strict=True):
                s, w = sampler.weigh(np.frombuffer(data, np.uint32))
                for k in range(0, len(s), 1 << 16):
                    some = s[k : k + (1 << 16)].view(np.int32)
                    yield pa.RecordBatch.from_pydict({
                        "shingle": some, "a": pa.array([digest] * len(some), pa.binary()), "w": w[k : k + (1 << 16)].astype(np.float64)})

    held = texts.join(members.select(F.col("a").alias("digest")).distinct(), "digest", "left_semi")
    each = held.select("digest", "shingles").mapInArrow(spread, "shingle int, a binary, w double")
    single = each.groupBy("shingle").agg(F.min("a").alias("a"), F.max("a").alias("other"), F.max("w").alias("w")).where("a = other")
    alone = single.groupBy("a").agg(F.sum("w").alias("alone"))
    reach = (F.col("weight") - F.coalesce("alone", F.lit(0.0))) * ((1 + threshold) / threshold) - F.col("weight")
    known = written(held.select(F.col("digest").alias("a"), "weight").join(alone, "a", "left").select("a", "weight", (reach * (1 + 1e-6) + 1e-6).alias("reach")), "reach")
    placed = written(members.join(known, "a"), "members")
    ends = placed.groupBy("key").agg(F.min("weight").alias("lightest"), F.max("reach").alias("farthest"))
    near = placed.join(ends, "key").where("reach >= lightest and weight <= farthest").drop("lightest", "farthest")
    mixed = near.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo != hi").select("key")
    return written(near.join(mixed, "key", "left_semi"), "members")


def _linked(cell: dict[str, np.ndarray], sampler: Sampler, threshold: float) -> list[tuple[bytes, bytes]]:
    """One link for each two classes of a cell that meet: of side 0 with side 1, and of side 0 with itself if inner."""
    of, side, s, w, reach = (cell[c] for c in ("of", "side", "samples", "weight", "reach"))
    one = np.flatnonzero(side == 0)
    other = np.arange(len(side)) if cell["inner"][0] else np.flatnonzero(side == 1)
    same = np.zeros((len(one), len(other)), np.uint8)
    for k in range(SAMPLES):
        same += s[one, k, None] == s[None, other, k]
    # Pairs within side 0 count once.
    may = (same >= LEAST_AGREEMENT * SAMPLES) & (of[one, None] != of[None, other]) & ((side[other] == 1) | (one[:, None] < other))
    may &= (reach[one, None] >= w[None, other]) & (reach[None, other] >= w[one, None])
    if not may.any():
        return []
    left, right = np.flatnonzero(may.any(1)), np.flatnonzero(may.any(0))
    lists = {k: np.frombuffer(cell["shingles"][k], np.uint32) for k in {*one[left].tolist(), *other[right].tolist()}}
    common = _common([lists[k] for k in one[left].tolist()], [lists[k] for k in other[right].tolist()], sampler)
    score = common / (w[one[left], None] + w[None, other[right]] - common)
    score = np.where(may[np.ix_(left, right)], score, 0.0)
    found: dict[tuple[int, int], tuple[bytes, bytes]] = {}
    i, j = np.nonzero(score >= threshold - DOUBT)
    for at in np.argsort(-score[i, j], kind="stable").tolist():
        x, y = int(one[left[i[at]]]), int(other[right[j[at]]])
        pair = (min(of[x], of[y]), max(of[x], of[y]))
        if pair not in found and (score[i[at], j[at]] >= threshold + DOUBT or sampler.similarity(lists[x], lists[y]) >= threshold):
            found[pair] = (cell["a"][x], cell["a"][y])
    return list(found.values())


def _common(a: list[np.ndarray], b: list[np.ndarray], sampler: Sampler) -> np.ndarray:
    """The weight that each text of a (sorted shingles) has in common with each of b; the k-th occurrence of a shingle is a shingle of its own."""

    def numbered(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        rows = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        s = np.concatenate(texts).astype(np.uint64) if texts else np.zeros(0, np.uint64)
        fresh = np.append(True, (s[1:] != s[:-1]) | (rows[1:] != rows[:-1]))[: len(s)]
        start = np.maximum.accumulate(np.where(fresh, np.arange(len(s)), 0)) if len(s) else np.zeros(0, np.int64)
        return rows, s << np.uint64(32) | (np.arange(len(s)) - start).astype(np.uint64)

    (ra, fa), (rb, fb) = numbered(a), numbered(b)
    features = np.intersect1d(fa, fb)
    root = np.sqrt(sampler.weights[_bucket((features >> np.uint64(32)).astype(np.uint32))])
    out = np.zeros((len(a), len(b)), np.float64)
    for at in range(0, len(features), SLICE):
        some = features[at : at + SLICE]
        sides = []
        for rows, own, n in ((ra, fa, len(a)), (rb, fb, len(b))):
            place = np.searchsorted(some, own)
            has = place < len(some)
            has[has] = some[place[has]] == own[has]
            x = np.zeros((n, len(some)), np.float32)
            x[rows[has], place[has]] = root[at + place[has]]
            sides.append(x)
        out += sides[0] @ sides[1].T
    return out


def _across(members: DataFrame, texts: DataFrame, shared, threshold: float) -> DataFrame:
    """Verified links (a, b) between the classes of each bucket. members: a, key, class, weight, reach; texts: digest, samples, shingles.

    The largest class of a bucket is never compared with itself. Both it and the rest are dealt over
    blocks of about SIDE members, or BLOCK_BYTES of shingles, and each pair of blocks is a cell, so hot
    buckets become many tasks.
    """
    sized = members.join(texts.select(F.col("digest").alias("a"), F.octet_length("shingles").alias("bytes")), "a")
    parts = sized.groupBy("key", "class").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    mixed = parts.groupBy("key").agg(F.max(F.struct("n", "class", "bytes")).alias("top"), F.sum("n").alias("all"), F.sum("bytes").alias("bytes"))
    blocks = lambda n, size: F.ceil(F.greatest(n / SIDE, size / BLOCK_BYTES)).cast("int")
    mixed = written(mixed.where(F.col("all") > F.col("top.n")).select(
        "key", F.col("top.class").alias("main"), blocks(F.col("top.n"), F.col("top.bytes")).alias("mains"),
        blocks(F.col("all") - F.col("top.n"), F.col("bytes") - F.col("top.bytes")).alias("rests")), "mixed")
    # A hash of its own for the blocks: rows of a task agree on the one that dealt them.
    at = members.join(mixed, "key").withColumn("is_main", F.col("class") == F.col("main")).withColumn(
        "block", F.pmod(F.xxhash64("a", F.lit("block")), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("rests"))).cast("int"))
    each = lambda n: F.sequence(F.lit(0), n - 1)
    cell = lambda i, j, kind, side, inner: F.struct(i.alias("i"), j.alias("j"), F.lit(kind).alias("kind"), side.cast("int").alias("side"), inner.alias("inner"))
    block = F.col("block")
    with_rest = F.transform(each(F.col("rests")), lambda i: cell(i, block, 1, F.lit(1), block == 0))
    with_main = F.transform(each(F.col("mains")), lambda j: cell(block, j, 1, F.lit(0), j == 0))
    with_other = F.transform(F.filter(each(F.col("rests")), lambda k: k != block), lambda k: cell(
        F.least(k, block), F.greatest(k, block), 0, k < block, F.lit(False)))
    cells = at.withColumn("cell", F.explode(F.when(F.col("is_main"), with_rest).otherwise(F.concat(with_main, with_other))))
    cells = cells.select(
        "a", F.xxhash64("class").alias("of"), "cell.side", "cell.inner", F.xxhash64("key", "cell.i", "cell.j", "cell.kind").alias("cell"), "weight", "reach")
    # Only cells of both sides are dealt: a side alone has no pair, unless it meets itself.
    dealt = written(cells, "cells").join(texts.select(F.col("digest").alias("a"), "samples", "shingles"), "a").repartition("cell").sortWithinPartitions("cell")
    plain = ("cell", "of", "side", "inner", "weight", "reach")

    def meet(batches):
        sampler = Sampler(shared.value)

        def links(held):
            cut = np.flatnonzero(np.append(True, np.diff(held["cell"]) != 0))
            out = []
            for lo, hi in zip(cut, np.append(cut[1:], len(held["cell"])), strict=True):
                out += _linked({c: x[lo:hi] for c, x in held.items()}, sampler, threshold)
            if out:
                yield pa.RecordBatch.from_pydict({"a": pa.array([min(p) for p in out], pa.binary()), "b": pa.array([max(p) for p in out], pa.binary())})

        held = None
        for b in batches:
            if not b.num_rows:
                continue
            new = {c: b.column(c).to_numpy(zero_copy_only=False) for c in plain}
            new |= {c: np.array(b.column(c).to_pylist(), object) for c in ("a", "shingles")}
            new["samples"] = b.column("samples").flatten().to_numpy().reshape(-1, SAMPLES)
            held = new if held is None else {c: np.concatenate([held[c], x]) for c, x in new.items()}
            last = int(np.searchsorted(held["cell"], held["cell"][-1]))  # the last cell may go on in the next batch
            if last:
                yield from links({c: x[:last] for c, x in held.items()})
                held = {c: x[last:] for c, x in held.items()}
        if held is not None:
            yield from links(held)

    return dealt.select("a", *plain, "samples", "shingles").mapInArrow(meet, "a binary, b binary")


def link(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Sketches, and the classes (node, class) of the nodes that have links."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(document_weights(bounded(docs)))
    made = sketches(docs, shared)
    nodes = written(made.where(F.size("samples") > 0).groupBy("digest").agg(F.first("samples").alias("samples"), F.min("row").alias("row")), "nodes")
    keys = F.array(*[F.struct(F.lit(k).alias("band"), F.xxhash64(F.lit(k), *[F.get("samples", k * ROWS + r) for r in range(ROWS)]).alias("key")) for k in range(BANDS)])
    members = nodes.select("digest", F.explode(keys).alias("k")).select("digest", "k.band", "k.key")
    sizes = written(members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    crowded = written(members.withColumnRenamed("digest", "a").join(sizes, "key"), "buckets")
    # The text that meets most others leads its buckets: of copies that were each edited apart, their common source.
    scores = written(crowded.groupBy("a").agg(F.sum("n").alias("score")), "scores")
    active = _led(written(crowded.drop("n").join(scores, "a"), "members"))
    samples = nodes.select("digest", "samples")
    # Tables that joins with hot hubs read are written: their exchanges are plain, and a hot key can be split.
    some = active.select(F.col("a").alias("digest")).distinct()
    # One row of each node is taken by its own number, so the copies of a text are not dealt by what they share.
    chosen = written(nodes.join(some, "digest", "left_semi").select("row"), "chosen")
    vectors = written(made.join(chosen.hint("shuffle_hash"), "row").select("digest", "weight", "samples", "shingles"), "vectors")
    drop(sizes, crowded, scores, chosen)

    @F.pandas_udf("double")
    def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
        sampler = Sampler(shared.value)
        return pd.Series([sampler.similarity(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)) for x, y in zip(a, b, strict=True)], dtype="float64")

    def named(df: DataFrame, node: str, value: str, column: str) -> DataFrame:
        return df.select(F.col("digest").alias(node), F.col(column).alias(value))

    def likely(pairs: DataFrame) -> DataFrame:
        both = pairs.join(named(samples, "a", "sa", "samples"), "a").join(named(samples, "b", "sb", "samples"), "b")
        return written(both.where(_agreement(F.col("sa"), F.col("sb")) >= LEAST_AGREEMENT).select("a", "b"), "pairs")

    def exact(pairs: DataFrame) -> DataFrame:
        full = pairs.join(named(vectors, "a", "va", "shingles"), "a").join(named(vectors, "b", "vb", "shingles"), "b")
        return written(full.where(similarity("va", "vb") >= threshold).select("a", "b"), "links")

    links = exact(likely(active.where("a != b").select("a", "b").distinct()))
    classes = components(links)
    # Pairs with a hub have been tried, so what is left to compare is a bucket without its hub.
    members = active.where("a != b").select("a", "key").join(classes.select(F.col("node").alias("a"), "class"), "a", "left")
    members = written(members.select("a", "key", F.coalesce("class", "a").alias("class")), "members")
    mixed = members.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo != hi").select("key")
    several = written(members.join(mixed, "key", "left_semi"), "several")
    drop(active, members, nodes)
    if several.head(1):
        near = _reaching(several, vectors, shared, threshold)
        fresh = written(_across(near, vectors, shared, threshold), "links")
        if fresh.head(1):
            classes = components(written(links.union(fresh), "links"))
    return made, classes


def _classified(docs: DataFrame, threshold: float) -> DataFrame:
    """One row for each doc_id, text and node: doc_id, raw, copies (rows), class_id, class_size, stays.

    The classes of nodes are few beside rows, and a node of many rows is one key: rows are counted by
    doc_id and text first, and the join reads written tables, so that a hot node can be split.
    """
    made, classes = link(docs, threshold)
    counted = written(made.groupBy("digest", "doc_id", "raw").agg(F.count("*").alias("copies")), "rows")
    rows = counted.join(classes.withColumnRenamed("node", "digest"), "digest", "left").select(
        "doc_id", "raw", "copies", F.coalesce("class", "digest").alias("class"))
    rows = written(rows, "classed")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("raw").alias("raw"))
    sizes = written(rows.groupBy("class").agg(F.min(order).alias("first"), F.sum("copies").alias("class_size")), "sizes")
    stays = F.col("doc_id").eqNullSafe(F.col("first.id")) & (F.col("raw") == F.col("first.raw"))
    return rows.join(sizes, "class").select("doc_id", "raw", "copies", F.col("first.id").alias("class_id"), "class_size", stays.alias("stays"))


def classify(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, class_size, kept: one row for every row of docs; one row of each class is kept."""
    each = _classified(docs, threshold).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return each.select("doc_id", "class_id", "class_size", (F.col("stays") & (F.col("copy") == 1)).alias("kept"))


def keep_representatives(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class, with all its columns."""
    keys = row_key(F.col("doc_id"), F.col("text"))
    kept = _classified(docs, threshold).where("stays")
    return repeated(docs, keys, kept.select(keys["none"].alias("none"), keys["own"].alias("own"), "raw", "copies", F.lit(1).cast("long").alias("high"), F.lit(1).alias("most"), F.lit(0).alias("rest")))
