"""Importance resampling and the source divergence audit against brute force, and on the awkward inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terrafold.llm import divergence, queries, resample
from terrafold.llm.store import written

SF = "/root/testdata/sf0.001"
KIND = "doc_id long, text string, lang string, source string, n_chars long, score int, rank string, part string, weight double"
LONG = "Alpha beta gamma. " * 70000


def awkward(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    rows = [
        (1, None, "en", "a"), (2, "", None, None), (3, " \t\n", "en", "a"), (4, LONG, "en", "a"), (5, "one two", "en", "b"), (5, "one two", "en", "b"), (5, "two three one", "en", "b"),
        (6, "Ünïcödé wörds für all rights reserved, cc by 4.0", "de", "b"), (7, "o n e alpha BETA", "fr", "c"), (None, "no id here at all", "en", None), (None, "no id here at all", "en", None),
        (8, "!!! ???", "en", "c"), (9, "x" * 2_500_000, "en", "c"), (10, "alpha one two alpha", "en", "c"), (11, "alpha two ONE", "en", None), (12, "4.0 9", "xx", "a")]
    return spark.createDataFrame([(*r, 0, 1, "x", "y", 0.5) for r in rows], KIND)


def empty(spark):
    return spark.createDataFrame([], KIND)


def tuples(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


# -- op12 -----------------------------------------------------------------------------------------

def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_resample(docs, target, per_cent=25, least=20, seed=7):
    """doc_id, n_features, weight, score, rank by the definition."""
    def grams(text):
        w = words(text)
        return [zlib.crc32(x.encode()) % 10000 for x in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]]

    found = [(d, len(words(t)), grams(t)) for d, t in docs]
    s, t = Counter(), Counter()
    for _, _, g in found:
        s.update(g)
    for x in target:
        t.update(grams(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in s}
    out, eligible = [], []
    for d, n, g in found:
        weight = sum(gain[b] for b in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(g), weight, score, None])
        if n >= least:
            eligible.append(out[-1])
    eligible.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for k, r in enumerate(eligible[: per_cent * len(eligible) // 100]):
        r[4] = k + 1
    return sorted(map(str, map(tuple, out)))


def test_resampling_equals_brute_force(spark):
    docs = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    target = [x for (x,) in duckdb.sql(f"select text from '{SF}/benchmark.parquet'").fetchall()]
    assert tuples(queries.op12_importance_resampling(spark, SF)) == brute_resample(docs, target)


@pytest.mark.parametrize("least", [0, 2])
def test_resampling_of_awkward_rows(spark, least):
    df = awkward(spark)
    target = spark.createDataFrame([("one two alpha",), (None,)], "text string")
    docs = [(r.doc_id, r.text) for r in df.collect()]
    got = resample.resample(df, target, per_cent=60, least_words=least, rows_per_range=3)
    assert tuples(got) == brute_resample(docs, ["one two alpha", None], 60, least)
    assert resample.resample(empty(spark), target).collect() == []
    assert resample.resample(df, target.limit(0), per_cent=100, least_words=100).where("rank is not null").count() == 1
    kept = resample.resampled_documents(df, target, per_cent=60, least_words=least)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in got.where("rank is not null").collect()}


def test_features_of_blocks_are_those_of_the_whole_text():
    text = ("Häuser und Bäume 12 ab " * 120_000).encode()
    got = np.bincount(np.concatenate(list(resample.features(text))), minlength=10000)
    w = words(text.decode())
    pairs = [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]
    want = np.zeros(10000, np.int64)
    for x, n in Counter(w + pairs).items():
        want[zlib.crc32(x.encode()) % 10000] += n
    assert len(list(resample.features(text))) > 2 and (got == want).all()


def test_ranks_split_a_hot_score_and_repeated_rows(spark):
    rows = spark.range(20000).select((F.col("id") % 9000).alias("doc_id"), F.lit(3).cast("long").alias("n_features"), F.lit(1).cast("long").alias("weight"), F.lit(5).cast("long").alias("score"), F.lit(True).alias("fit"))
    one = spark.range(5000).select(F.lit(-1).cast("long").alias("doc_id"), F.lit(3).cast("long"), F.lit(1).cast("long"), F.lit(5).cast("long"), F.lit(True))
    got = resample.draw(written(rows.union(one), "scored"), 50, 500).collect()
    ranks = sorted((r["rank"], r.doc_id) for r in got if r["rank"] is not None)
    assert len(got) == 25000 and [x for x, _ in ranks] == list(range(1, 12501)) and [d for _, d in ranks] == sorted(d for _, d in ranks)
    assert sum(d == -1 for _, d in ranks) == 5000


# -- op13 -----------------------------------------------------------------------------------------

def brute_audit(rows, least=3, top=200):
    """lang, source, part, item, value, rank by the definition; rows: text, lang, source."""
    df, n, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        df[lang].update(set(found))
        n[lang, source].update(found)
        sources[lang].add(source)
    out = []
    for lang, names in sources.items():
        kept = [t for t, k in df[lang].items() if k >= least]
        v, p = len(kept), {}
        total = {s: sum(n[lang, s][t] for t in kept) for s in names}
        for s in names:
            p[s] = {t: 1 + 10**9 * (n[lang, s][t] + 1) // (total[s] + v) for t in kept}
        whole = {t: 1 + 10**9 * (sum(n[lang, s][t] for s in names) + 1) // (sum(total.values()) + v) for t in kept}
        for g in names:
            pair = [(sum((p[g][t] - p[h][t]) ** 2 // p[h][t] for t in kept), h) for h in names if h != g]
            term = [((p[g][t] - whole[t]) ** 2 // whole[t], t) for t in kept if n[lang, g][t] > 0 and p[g][t] > whole[t]]
            for part, found, most in (("pair", pair, len(pair)), ("term", term, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, g, part, item, value, k + 1) for k, (value, item) in enumerate(found[:most])]
    return sorted(map(str, out))


def test_audit_equals_brute_force(spark):
    rows = duckdb.sql(f"select text, lang, source from '{SF}/documents.parquet'").fetchall()
    assert tuples(queries.op13_divergence_audit(spark, SF)) == brute_audit(rows)


@pytest.mark.parametrize("least", [1, 2, 3])
def test_audit_of_awkward_rows(spark, least, monkeypatch):
    df = awkward(spark)
    rows = [(r.text, r.lang, r.source) for r in df.collect()]
    assert tuples(divergence.audit(df, least, 2)) == brute_audit(rows, least, 2)
    assert divergence.audit(empty(spark)).collect() == []


def test_audit_in_small_steps(spark, monkeypatch):
    """Blocks of a document, scans of a few rows, squares in strips and pair sums let go at once give the same result."""
    rows = [(f"alpha beta {'gamma ' * (k % 7)} w{k % 5} {'xyz'[k % 3]}", "en" if k % 11 else "fr", f"s{k % 13}") for k in range(200)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, text string, lang string, source string").repartition(3)
    docs = [r.asDict() for r in df.collect()]
    batches = pa.Table.from_pylist(docs).select(["doc_id", "lang", "source", "text"]).to_batches()
    monkeypatch.setattr(divergence, "HELD", 5)
    partial = pa.Table.from_batches(divergence._partials(batches)).sort_by([(c, "ascending") for c in ("term", "lang", "source", "document")])
    monkeypatch.setattr(divergence, "ROWS", 7)
    kept = pa.Table.from_batches(divergence._kept(3)(partial.to_batches(max_chunksize=3)))
    assert kept.num_rows and sorted(map(str, kept.to_pylist())) == sorted(str(r.asDict()) for r in divergence.kept_counts(df).collect())
    names, group = [("en", c) for c in "xyz"], np.array([0, 1, 2, 0, 2])
    p, a, at = np.array([5, 9, 1, 4, 7], np.int64), np.array([1, 2, 1, 1, 1], np.int64), np.array([0, 3])
    whole = divergence._Pairs()
    assert list(whole.add(names, group, at, p, a)) == []
    want = {tuple(list(r.values())[:3]): r["value"] for r in whole.close().to_pylist()}
    for cells in (1, 2, 5, 100):
        monkeypatch.setattr(divergence, "CELLS", cells)
        pairs, found = divergence._Pairs(), Counter()
        for b in [*pairs.add(names, group, at, p, a), pairs.close()]:
            for r in b.to_pylist():
                found[tuple(list(r.values())[:3])] += r["value"]
        assert {k: v for k, v in found.items() if v} == {k: v for k, v in want.items() if v}
    assert tuples(divergence.audit(df)) == brute_audit(rows)


def test_shares_of_huge_counts():
    n, total = np.array([0, 10**12, 9 * 10**14, 7], np.int64), np.array([3, 10**13 + 7, 9 * 10**14 + 1, 9], np.int64)
    assert divergence._share(n, total).tolist() == [1 + 10**9 * (x + 1) // y for x, y in zip(n.tolist(), total.tolist(), strict=True)]
