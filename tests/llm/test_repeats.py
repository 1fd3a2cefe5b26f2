"""Substring dedup against brute force over all windows, and on the awkward inputs."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafold.llm import queries, repeats

SF = "/root/testdata/sf0.001"


def brute(docs, window=35):
    """doc_id, n_words, n_removed, kept_sha256 by the definition; docs: doc_id, text."""
    listed = [(d, re.findall("[^ \t-\r]+", t or "")) for d, t in docs]
    seen = Counter(tuple(w[i : i + window]) for _, w in listed for i in range(len(w) - window + 1))
    out = []
    for d, w in listed:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(map(str, out))


def got(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def test_equals_brute_force(spark):
    docs = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    assert got(queries.op11_substring_dedup(spark, SF)) == brute(docs)


def passages(seed, n):
    """Texts with shared passages, passages within passages, copies, edits, periods and repeated rows."""
    r = random.Random(seed)
    new = lambda k: [f"w{r.randrange(60)}" for _ in range(k)]
    shared = [new(k) for k in (6, 11, 40, 90)] + [["a"] * 50, ["a", "b"] * 40, ["a", "b", "c"] * 3]
    docs = []
    for k in range(n):
        w = new(r.randrange(30))
        for _ in range(r.randrange(4)):
            p = r.choice(shared)
            i, j = sorted((r.randrange(len(p) + 1), r.randrange(len(p) + 1)))
            w += (p if r.random() < 0.5 else p[i:j]) + new(r.randrange(12))
        if docs and r.random() < 0.2:
            w = docs[r.randrange(len(docs))][1].split()
            if w and r.random() < 0.5:
                w[r.randrange(len(w))] = "edit"
        docs.append((k, r.choice([" ", "\n", "\t "]).join(w)))
    return docs + docs[: n // 10] + [(None, docs[3][1]), (None, docs[3][1]), (0, docs[4][1])]


@pytest.mark.parametrize(("window", "seed"), [(35, 1), (9, 2), (12, 3), (3, 4)])
def test_windows_of_all_kinds(spark, window, seed):
    docs = passages(seed, 120)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert got(repeats.dedup(df, window)) == brute(docs, window)


def test_compaction_joins_what_goes_on_alike(spark):
    """One passage of 200 words in three texts is one path of 166 windows at three places; one that branches is not joined across the branch."""
    same, left, right = [f"p{k}" for k in range(200)], [f"l{k}" for k in range(60)], [f"r{k}" for k in range(60)]
    texts = [[f"x{d}"] * 3 + same + [f"y{d}"] * 2 for d in range(3)] + [left + [f"u{d}"] + right for d in range(2)] + [left, right]
    df = spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(texts)], "doc_id long, text string")
    found = repeats.candidates(df)
    paths = repeats.compacted(found.where("pure").drop("pure"))
    assert repeats.verified(paths)
    rows = paths.where("own < 3").groupBy("own").agg(F.count("*").alias("k"), F.sum("n").alias("n")).collect()
    assert {r.own for r in rows} == {0, 1, 2} and all(r.k == 1 and 100 < r.n <= 166 for r in rows)
    assert {r.a for r in paths.where("own < 3").groupBy("m", "c").agg(F.count("*").alias("a")).collect()} == {3}
    assert not repeats.verified(paths.union(paths.withColumn("n", F.col("n") + 1)))
    assert got(repeats.dedup(df)) == brute([(d, " ".join(t)) for d, t in enumerate(texts)])


def test_awkward_rows(spark):
    long = " ".join(f"v{k % 977} x{k % 1013}" for k in range(60_000))
    kind = "doc_id long, text string, lang string, source string, own int, raw string, at int, spans string"
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "x" * 2_500_000 + " " + long), (5, "y" + long), (6, "one two"), (6, "one two"), (None, long), (7, "z" * 1_200_000), (8, "Ünï cödé wörd")]
    df = spark.createDataFrame([(d, t, "en", None, 1, "r", 2, "s") for d, t in docs], kind)
    assert got(repeats.dedup(df)) == brute(docs)
    kept = repeats.removed_documents(df)
    assert kept.columns == df.columns and kept.count() == len(docs)
    texts = {r.doc_id: r.text for r in kept.where("doc_id is not null").collect()}
    assert texts[1] is None and texts[2] == "" and texts[8] == "Ünï cödé wörd" and texts[7] == "z" * 1_200_000
    assert hashlib.sha256(texts[4].encode()).hexdigest() == dict((r.doc_id, r.kept_sha256) for r in repeats.dedup(df).collect())[4]
    nothing = spark.createDataFrame([], kind)
    assert repeats.dedup(nothing).collect() == [] and repeats.removed_documents(nothing).columns == df.columns
    assert len(repeats.hashes(("q" * 3_000_000 + " a b " + "r" * 3_000_000 + "\n" + "c " * 600_000).encode())) == 600_004


def test_a_hot_passage_and_hot_rows(spark):
    """A passage in 3,000 texts with their own surroundings, and one row 2,000 times."""
    words = [f"h{k}" for k in range(50)]
    docs = [(k, f"a{k} b{k} " + " ".join(words) + f" c{k} d{k}") for k in range(3000)] + [(9999, " ".join(words[:40]))] * 2000
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    r = {(x.n_words, x.n_removed): x.k for x in repeats.dedup(df).groupBy("n_words", "n_removed").agg(F.count("*").alias("k")).collect()}
    assert r == {(54, 50): 3000, (40, 40): 2000}


def test_runs_cut_repeats_of_their_own():
    w1, w2, least = repeats.windows(b"a b " * 60)
    at, n, _ = repeats.runs(w1, w2, least)
    assert n.sum() == len(w1) and set(n.tolist()) == {1}
    w1, w2, least = repeats.windows(" ".join(f"k{i}" for i in range(500)).encode())
    at, n, _ = repeats.runs(w1, w2, least)
    assert n.sum() == len(w1) == 466 and n.max() <= repeats.PIECE and (np.cumsum(n)[:-1] == at[1:]).all()
