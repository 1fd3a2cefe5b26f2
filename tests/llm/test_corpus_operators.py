"""Each operator against brute force, a round trip or held-out accuracy, and on the awkward inputs."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from terrafold.llm import binary, chat, counts, exact, fingerprints, language, licenses, mixing, near, ordering, packing, queries
from terrafold.llm.encode import Encoder, vocabulary
from terrafold.llm.ordering import limits, range_of
from terrafold.llm.shingles import shingles, word_hashes
from terrafold.llm.store import scratch

SF = "/root/testdata/sf0.001"
KIND = "doc_id long, text string, lang string, source string, n_chars long, part int, digest string, size long"
LONG = "Alpha beta gamma. " * 30000


def awkward(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    rows = [
        (1, None, "en", "a", 0, 1, "x", 1), (2, "", None, None, 0, 1, "x", 1), (3, " \t\n", "en", "a", 3, 1, "x", 1),
        (4, LONG, "en", "a", len(LONG), 1, "x", 1), (5, "one", "en", "b", 3, 1, "x", 1), (5, "one", "en", "b", 3, 1, "x", 1),
        (6, "Ünïcödé wörds für all rights reserved, cc by 4.0", "de", "b", 40, 1, "x", 1), (7, "o n e", "fr", "c", 5, 1, "x", 1),
        (None, "no id here at all", "en", None, 17, 1, "x", 1), (8, "!!! ???", "en", "c", 7, 1, "x", 1), (9, "x" * 200000, "en", "c", 200000, 1, "x", 1)]
    return spark.createDataFrame(rows, KIND)


def empty(spark):
    return spark.createDataFrame([], KIND)


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"select * from '{SF}/documents.parquet' order by doc_id").df()


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_ranges_hold_all_rows_in_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * F.col("id")).alias("k"))
    b = limits(df, "k", 100)
    parts = df.withColumn("p", range_of(F.col("k"), b)).groupBy("p").agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("*").alias("n")).orderBy("p").collect()
    assert [r.p for r in parts] == list(range(len(b) + 1)) and sum(r.n for r in parts) == 5000
    assert all(x.hi < y.lo for x, y in zip(parts, parts[1:], strict=False)) and max(r.n for r in parts) < 250
    assert limits(df.where("k < 0"), "k", 10) == []


@pytest.fixture
def three_levels(monkeypatch):
    """Ranges in levels on small tables."""
    monkeypatch.setattr(ordering, "MAX_RANGES", 3)
    monkeypatch.setattr(ordering, "FAN", 4)
    monkeypatch.setattr(ordering, "BLOCK", 5)


def test_ranges_in_three_levels(spark, three_levels):
    df = spark.range(0, 5000).select((F.col("id") * F.col("id") - 1000).alias("k")).union(spark.range(7).select(F.lit(None).cast("long")))
    made = ordering.ranges(df, "k", 100)
    assert len(made.deeper) == 3 and len(made.first) == 2
    parts = made.place(df, "k").groupBy("part").agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("*").alias("n"))
    listed = parts.orderBy("part").collect()
    assert sum(r.n for r in listed) == 5007 and 30 < len(listed) <= 3 * 4**3 and max(r.n for r in listed) < 300
    assert all(x.hi < y.lo for x, y in zip(listed, listed[1:], strict=False)) and made.place(df.where("k is null"), "k").first().part == 0
    sums = {r.part: r.b for r in ordering.before(parts, "n", "b").collect()}
    want, total = {}, 0
    for r in listed:
        want[r.part], total = total, total + r.n
    assert sums == want
    after = {r.part: r.next_lo for r in ordering.following(parts, ["lo"]).collect()}
    assert after == {x.part: y.lo for x, y in zip(listed, listed[1:], strict=False)}
    doubles = df.select((F.col("k") / 7).alias("k"))
    assert ordering.ranges(doubles, "k", 100, "double").place(doubles, "k").select("part").distinct().count() > 30


def test_operators_over_ranges_in_levels(spark, docs, three_levels, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROWS_PER_RANGE", 5)
    monkeypatch.setattr(binary, "ROWS_PER_FILE", 5)
    monkeypatch.setattr(mixing, "ROWS_PER_RANGE", 5)
    texts = docs.text.tolist()
    got = {r["doc_id"]: r for r in rows(queries.op2_fingerprints(spark, SF))}
    changed = edited_texts(texts)
    assert all(got[d]["edited_sha256"] == hashlib.sha256(changed[i].encode()).hexdigest() for i, d in enumerate(docs.doc_id)) and len(got) == len(texts)
    back = sorted(rows(queries.op8_token_binary(spark, SF)), key=lambda r: r["doc_id"])
    at = 0
    for r in back:
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in back] == docs.doc_id.tolist()
    check_mix(rows(queries.op10_mixing(spark, SF)))


# -- op1 ------------------------------------------------------------------------------------------

WORDS = {"words": counts.pattern_counter("[^\\x20\\x09-\\x0D]+")}


def test_rollup_is_idempotent_and_signed(spark):
    store = counts.Rollup(spark, scratch(spark, "t"))
    df = awkward(spark)
    made = counts.counted(df, WORDS)
    one = F.col("words")
    assert store.totals().count() == 0 and store.compact() == 0
    assert store.commit(1, counts.signed(made, one, "words", 1))
    assert not store.commit(1, counts.signed(made, one, "words", 1))
    total = store.totals().agg(F.sum("docs"), F.sum("tokens")).first()
    words = sum(len(re.findall(r"[^ \t-\r]+", r.text or "")) for r in df.collect())
    assert tuple(total) == (df.count(), words)
    store.commit(2, counts.revised(made.where("doc_id = 6"), one, one + 5, "words"))
    assert store.totals().agg(F.sum("tokens")).first()[0] == words + 5
    assert store.compact() == 2 and store.compact() == 0 and not store._folders("batch")
    assert store.totals().agg(F.sum("tokens")).first()[0] == words + 5
    assert store.committed(1) and not store.commit(2, counts.revised(made, one, one + 5, "words"))
    store.commit(3, counts.signed(made.where("source = 'c'"), one, "words", -1))
    assert store.totals().where("source = 'c'").count() == 0
    store.commit(4, counts.signed(counts.counted(empty(spark), WORDS), one, "words", 1))
    assert store.totals().where("source is null").count() == 2
    before = sorted(map(str, store.totals().collect()))
    assert store.compact() == 2 and list(store._folders("folded")) == [2] and sorted(map(str, store.totals().collect())) == before


def test_attempts_that_lose_or_stop_do_not_count(spark):
    """Two commits of one batch, of which the second finds the name taken when it is done; an attempt without a name; a compaction that stops before it deletes."""
    store = counts.Rollup(spark, scratch(spark, "t"))
    made = counts.counted(awkward(spark), WORDS)
    add = counts.signed(made, F.col("words"), "words", 1)
    add.write.parquet(f"{store.root}/.attempt-stopped")
    assert store.totals().count() == 0 and not store.committed(7)
    add.write.parquet(f"{store.root}/.attempt-late")
    assert store.commit(7, add)
    want = sorted(map(str, store.totals().collect()))
    assert not store._named(".attempt-late", "batch=000000000007") and not store.fs.exists(store.path(f"{store.root}/.attempt-late"))
    kept = spark.read.parquet(f"{store.root}/batch=000000000007").count()
    assert sorted(map(str, store.totals().collect())) == want and kept > 0
    real = store.fs

    class Stopped:
        """A file system on which nothing is deleted."""

        def __getattr__(self, name):
            return getattr(real, name)

        def delete(self, *path):
            return False

    store.fs = Stopped()
    assert store.compact() == 1 and store._folders("batch")
    store.fs = real
    assert sorted(map(str, store.totals().collect())) == want
    assert store.compact() == 0 and not store._folders("batch") and sorted(map(str, store.totals().collect())) == want


def test_token_counts_equal_brute_force(spark):
    """All documents by both vocabularies, toxic ones gone, bad ones recounted by the other vocabulary; encoded one by one."""
    found = duckdb.sql(f"select doc_id, source, lang, coalesce(text, '') from '{SF}/documents.parquet'").fetchall()
    marks = defaultdict(lambda: (None, None)) | {d: (t, q) for d, t, q in duckdb.sql(f"select doc_id, max(toxic), min(quality) from '{SF}/labels.parquet' group by doc_id").fetchall()}
    encoders = {name: Encoder(vocabulary(f)).tokenizer for name, f in (("byte-bpe-50k", "byte_bpe_50k.json"), ("word-bpe-49k", "word_bpe_49k.json"))}
    docs, tokens = Counter(), Counter()
    for doc, source, lang, text in found:
        toxic, quality = marks[doc]
        if toxic == 1:
            continue
        n = {name: len(e.encode(text, add_special_tokens=False).ids) for name, e in encoders.items()}
        if quality == 0:
            n["byte-bpe-50k"] = n["word-bpe-49k"]
        for name, k in n.items():
            docs[source, lang, name] += 1
            tokens[source, lang, name] += k
    got = {(r["source"], r["lang"], r["tokenizer"]): (r["docs"], r["tokens"]) for r in rows(queries.op1_token_counts(spark, SF))}
    assert got == {k: (docs[k], tokens[k]) for k in docs}
    made = counts.counted(awkward(spark), counts.vocabularies())
    assert made.agg(F.sum("`byte-bpe-50k`")).first()[0] == sum(len(encoders["byte-bpe-50k"].encode(r.text or "", add_special_tokens=False).ids) for r in awkward(spark).collect())


# -- op2 ------------------------------------------------------------------------------------------

def edited_texts(texts):
    out = []
    for i, t in enumerate(texts):
        q = len(t) // 4
        out.append(t[: len(t) - q] + texts[(i + 1) % len(texts)][:q])
    return out


def grams(t):
    w = t.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_estimate_resemblance(spark, docs):
    got = {r["doc_id"]: r for r in rows(queries.op2_fingerprints(spark, SF))}
    texts = docs.text.tolist()
    changed = edited_texts(texts)
    assert len(got) == len(texts)
    errors = []
    for i, (doc, t) in enumerate(zip(docs.doc_id, texts, strict=True)):
        r = got[doc]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(changed[i].encode()).hexdigest()
        errors.append(abs(r["near_edited"] - jaccard(grams(t), grams(changed[i]))))
        assert abs(r["near_next"] - jaccard(grams(t), grams(texts[(i + 1) % len(texts)]))) < 0.2
    assert max(errors) < 0.2 and sum(errors) / len(errors) < 0.04
    same = defaultdict(set)
    for doc, t in zip(docs.doc_id, texts, strict=True):
        same[t].add(got[doc]["fingerprint"])
    assert all(len(x) == 1 for x in same.values())


def test_sketches_merge_and_count(spark):
    a, b = [" ".join(f"w{i}" for i in range(lo, lo + 900)) for lo in (0, 600)]
    s = spark.createDataFrame([(a, b, a + " " + b)], "a string, b string, ab string").select(
        *[fingerprints.sketch(F.col(c)).alias(c) for c in ("a", "b", "ab")])
    r = s.select(
        fingerprints.distinct_shingles(F.col("a")).alias("n"), fingerprints.resemblance(F.col("a"), F.col("b")).alias("j"),
        fingerprints.containment(F.col("a"), F.col("b")).alias("c"),
        (F.size(F.array_intersect(fingerprints.merge(F.col("a"), F.col("b")), "ab")) / fingerprints.K).alias("merged")).first()
    assert abs(r.n - 896) < 250 and abs(r.j - 296 / 1496) < 0.12 and abs(r.c - 296 / 896) < 0.2 and r.merged > 0.95


def test_fingerprints_of_awkward_rows(spark):
    got = rows(fingerprints.edited_fingerprints(awkward(spark)))
    assert len(got) == 11 and {r["near_edited"] for r in got if r["n_chars"] == 0} == {1.0}
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert rows(fingerprints.edited_fingerprints(empty(spark))) == []
    assert rows(fingerprints.edited_fingerprints(awkward(spark).where("doc_id = 6")))[0]["near_next"] == 1.0


# -- op3 ------------------------------------------------------------------------------------------

def brute_scan(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    starts, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_license_base_matches_brute_force(spark, docs):
    got = {r["doc_id"]: r for r in rows(queries.op3_license_scans(spark, "/root/testdata/sf0.01"))}
    big = duckdb.sql("select doc_id, text from '/root/testdata/sf0.01/documents.parquet'").fetchall()
    hits = 0
    for doc, text in big:
        r = got[doc]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_scan(text)
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        for line, label in (("the Apache License, Version 2.0", "apache-2.0"), ("General Public License, version 3", "gpl-3.0"), ("the MIT License", "mit"), ("CC BY-NC 4.0", "cc-by-nc-4.0")):
            if line in text:
                hits += 1
                assert label in r["labels"].split(",") and r["score"] > 0.7
    assert hits > 5 and sum(r["score"] > 0 for r in got.values()) < len(got) / 4


def brute_labels(text, idf):
    """Labels and score by trying every template at every place."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    whole, has = f" {' '.join(w)} ", set(w)
    labels, score = set(), 0.0
    for phrase, label in licenses.BASE.items():
        if f" {phrase} " in whole:
            labels.add(label)
            score = 0.5
    for label, (notice, phrases) in licenses.TEMPLATES.items():
        if not all(f" {p} " in whole for p in phrases):
            continue
        own = notice.split()
        rare = sorted(set(own) & has, key=lambda x: (-idf[x], x))[: licenses.RARE]
        for at in range(-len(own) + 1, len(w)):
            same = [x for k, x in enumerate(own) if 0 <= at + k < len(w) and w[at + k] == x]
            window = f" {' '.join(w[max(0, at - licenses.SLACK) : max(0, at + len(own) + licenses.SLACK)])} "
            if len(set(same) & set(rare)) >= 2 and all(f" {p} " in window for p in phrases):
                labels.add(label)
                score = max(score, len(same) / len(own))
    return ",".join(sorted(labels)), score


def test_license_labels_match_brute_force(spark):
    texts = [r[0] for r in duckdb.sql(f"select text from '{SF}/documents.parquet'").fetchall()]
    notices = [t for t, _ in licenses.TEMPLATES.values()]
    texts += [f"Intro {t.title()} and more" for t in notices] + [" ".join(notices), "all rights All Rights reserved reserved", "reserved all rights", "cc0", "by cc by 4 0 cc by"]
    texts += [n.replace("licensed ", "").replace("the ", "") for n in notices] + [" ".join(n.split()[2:]) for n in notices] + ["public license " * 500 + "mit license"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lists = [set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())) for t in texts]
    idf = {w.decode(): math.log((len(texts) + 1) / (sum(w.decode() in x for x in lists) + 1)) for w in licenses.licence_words()}
    got = {r["doc_id"]: r for r in rows(licenses.scan(df))}
    for doc, text in enumerate(texts):
        r = got[doc]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_scan(text)
        labels, score = brute_labels(text, idf)
        assert r["labels"] == labels and r["score"] == pytest.approx(score, abs=1e-12)
    assert {label for r in got.values() for label in r["labels"].split(",")} >= set(licenses.TEMPLATES) | set(licenses.BASE.values())


def test_license_scan_of_awkward_rows(spark):
    got = rows(licenses.scan(awkward(spark)))
    assert len(got) == 11 and sorted(r["n_base"] for r in got)[-1] == 2
    six = next(r for r in got if r["doc_id"] == 6)
    assert six["base_labels"] == "cc-by,reserved" and "cc-by-4.0" in six["labels"]
    assert rows(licenses.scan(empty(spark))) == []


# -- op4 ------------------------------------------------------------------------------------------

def test_snapshots_collapse(spark):
    def conv(i, *texts, start=0):
        return [(i, start + k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(texts)]

    log = conv(1, "a") + conv(2, "a", "b") + conv(3, "a", "b", "c") + conv(4, "a", "x") + conv(5, "a", "b", "c") + conv(6, "b", start=7) + conv(7, *map(str, range(200))) + conv(8, *map(str, range(150)))
    log += [(None, 0, "user", None), (9, None, None, None), (9, 1, "user", "q"), (9, 1, "user", "q")]
    df = spark.createDataFrame(log, "conv_id long, turn long, role string, text string")
    got = rows(chat.collapse(df.withColumn("segment", F.lit(1))))
    assert {r["conv_id"] for r in got} == {None, 3, 4, 6, 7, 9}
    seven = "".join(r["rendered"] for r in sorted((r for r in got if r["conv_id"] == 7), key=lambda r: r["segment"]))
    assert seven == "".join(f"<|im_start|>{'user' if k % 2 == 0 else 'assistant'}\n{k}<|im_end|>\n" for k in range(200))
    assert rows(chat.collapse(df.limit(0))) == []


def test_turns_of_very_many_rows_are_split(spark):
    """100,000 rows without conversation and turn, 20,000 equal ones among them, and a large turn between small ones."""
    bare = spark.range(100_000).select(F.lit(None).cast("long").alias("conv_id"), F.lit(None).cast("long").alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("text "), F.greatest("id", F.lit(20_000))).alias("text"))
    some = spark.createDataFrame([(1, 0, "user", "a"), (1, 2, "user", "z"), *((1, 1, "user", f"m{k}") for k in range(300))], "conv_id long, turn long, role string, text string")
    got = rows(chat.collapse(bare.union(some)))
    assert max(r["n_rows"] for r in got) < 8 * chat.SEGMENT and sum(r["n_rows"] for r in got) == 100_302
    lines = Counter(x for r in got if r["conv_id"] is None for x in r["rendered"].split("<|im_end|>\n") if x)
    assert sum(lines.values()) == 100_000 and lines["<|im_start|>user\ntext 20000"] == 20_001 and len(lines) == 80_000 - 0
    one = sorted((r for r in got if r["conv_id"] == 1), key=lambda r: (r["segment"], r["first_turn"], r["part"]))
    texts = [x.split("\n")[1] for r in one for x in r["rendered"].split("<|im_end|>\n") if x]
    assert texts[0] == "a" and texts[-1] == "z" and sorted(texts[1:-1]) == sorted(f"m{k}" for k in range(300))
    again = rows(chat.collapse(bare.union(some).repartition(7)))
    assert sorted(map(str, got)) == sorted(map(str, again))
    long = spark.createDataFrame([(5, 0, "user", LONG), (5, 1, "assistant", "y" * 1_000_000), (6, 0, "user", LONG)], "conv_id long, turn long, role string, text string")
    assert [len(r["rendered"]) for r in rows(chat.collapse(long))] == [len(LONG) + 1_000_000 + len("<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n")]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "conversations"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(queries.ORACLES[name]).df()
    got = queries.QUERIES[name](spark, SF).toPandas()[list(want.columns)]

    def listed(df):
        return sorted(map(str, df.astype(object).to_dict("records")))

    assert len(got) == len(want) and listed(got) == listed(want)


# -- op5 ------------------------------------------------------------------------------------------

def check_pieces(got, texts, path, size=packing.SIZE, slack=0.03):
    """texts: doc_id -> text, ids unique."""
    enc = Encoder(path)
    ids = {d: [*enc.tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for d, t in texts.items()}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids)
    for d, own in by_doc.items():
        own.sort(key=lambda r: r["start"])
        at = 0
        for r in own:
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids[d])
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[d][at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids[d])
    padding = total = 0
    for own in by_seq.values():
        own.sort(key=lambda r: r["offset"])
        n = 0
        for r in own:
            assert r["offset"] == n
            n += r["length"]
        assert n <= size
        total += n
        padding += 0 if n & (n - 1) == 0 else size - n
    assert padding <= slack * total


def test_packing_keeps_every_id(spark, docs):
    check_pieces(rows(queries.op5_packing(spark, SF)), dict(zip(docs.doc_id, docs.text, strict=True)), vocabulary("word_bpe_49k.json"))
    odd = awkward(spark).dropDuplicates(["doc_id", "text"]).where("doc_id is not null")
    check_pieces(rows(packing.pack(odd, vocabulary("word_bpe_49k.json"), 2)), {r.doc_id: r.text for r in odd.collect()}, vocabulary("word_bpe_49k.json"), slack=0.05)
    assert len({(r["doc_id"], r["sequence_id"], r["offset"]) for r in rows(packing.pack(awkward(spark), vocabulary("word_bpe_49k.json"), 2))}) >= 11
    assert rows(packing.pack(empty(spark), vocabulary("word_bpe_49k.json"), 2)) == []


def test_cuts_are_optimal():
    rng = np.random.default_rng(3)
    for _ in range(50):
        gaps = rng.integers(1, 9, 12)
        at = [0, *np.cumsum(gaps).tolist()]
        pen = [0.0, *rng.integers(0, 5, 12).astype(float)]
        cuts = packing.best_cuts(at, pen, 10)
        cost = dict(zip(at, pen, strict=True))
        best = [0.0] + [math.inf] * 12
        for j in range(1, 13):
            best[j] = min(best[i] + 10 - (at[j] - at[i]) for i in range(j) if at[j] - at[i] <= 10) + pen[j]
        took = sum(10 - (b - a) + cost[b] for a, b in zip([0, *cuts], cuts, strict=False))
        assert took == best[-1] and cuts[-1] == at[-1]
    assert packing.binary_lengths(1500, 4096) == [1024, 256, 128, 64, 16, 8, 4] and packing.binary_lengths(0, 4) == []


# -- op6 ------------------------------------------------------------------------------------------

def test_exact_groups_of_awkward_rows(spark):
    got = rows(exact.decide(awkward(spark)))
    assert len(got) == 11
    ones = [r for r in got if r["keep_id"] == 7]
    assert sorted(r["doc_id"] for r in ones) == [5, 5, 7] and {r["group_size"] for r in ones} == {3} and [r["doc_id"] for r in ones if r["kept"]] == [7]
    blank = [r for r in got if r["keep_id"] == 3]
    assert sorted(r["doc_id"] for r in blank) == [1, 2, 3]
    assert sum(r["kept"] for r in got) == len({r["text_sha256"] for r in got})
    kept = exact.keep_first(awkward(spark))
    assert kept.columns == awkward(spark).columns and kept.count() == len({r["text_sha256"] for r in got})
    names = awkward(spark).withColumnRenamed("part", "__of").withColumn("__own", F.lit("mine"))
    assert {r["__own"] for r in rows(exact.keep_first(names))} == {"mine"} and exact.keep_first(names).count() == kept.count()
    assert rows(exact.decide(empty(spark))) == []


def test_chunks_shift_with_their_content():
    rng = np.random.default_rng(5)
    data = rng.bytes(300000)
    a, b = ({data2[i:j] for i, j in zip([0, *ends], ends, strict=False)} for data2 in (data, b"inserted" + data) for ends in [exact.cut_points(data2)])
    assert len(a & b) >= len(a) - 2 and all(len(x) <= exact.MOST for x in a) and exact.cut_points(b"") == [0]
    assert b"".join(data[i:j] for i, j in zip([0, *exact.cut_points(data)], exact.cut_points(data), strict=False)) == data


# -- op7 ------------------------------------------------------------------------------------------

def test_near_duplicates_match_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in rows(queries.op7_minhash_near_dedup(spark, sf))}
    texts = dict(duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall())
    lists = {d: shingles(t.encode()) for d, t in texts.items()}
    weights = near.document_weights(queries.documents(spark, sf))
    sampler = near.Sampler(weights)
    index = defaultdict(set)
    for d, s in lists.items():
        for h in set(s.tolist()):
            index[h].add(d)
    pairs = Counter()
    for own in index.values():
        own = sorted(own)
        pairs.update((a, b) for i, a in enumerate(own) for b in own[i + 1 :])
    parent = {d: d for d in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x] = parent[parent[x]]
        return x

    for (a, b), n in pairs.items():
        if n >= 0.5 * min(len(set(lists[a].tolist())), len(set(lists[b].tolist()))) and sampler.similarity(lists[a], lists[b]) >= 0.8:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    want = {d: find(d) for d in texts}
    wrong = [d for d in texts if got[d]["class_id"] != want[d]]
    assert len(got) == len(texts) and len(wrong) <= 2, wrong
    assert sum(r["kept"] for r in got.values()) == len({r["class_id"] for r in got.values()})
    assert len({r["class_id"] for r in got.values()}) < len(texts)


def test_near_dedup_of_awkward_rows(spark):
    base = " ".join(f"word{i}" for i in range(400))
    more = spark.createDataFrame([(20 + k, base.replace(f"word{k * 7}", f"edit{k}"), "en", "a", 1, 1, "x", 1) for k in range(12)], KIND)
    got = rows(near.classify(awkward(spark).union(more)))
    assert len(got) == 23
    assert {r["class_id"] for r in got if (r["doc_id"] or 0) >= 20} == {20} and {r["class_size"] for r in got if (r["doc_id"] or 0) >= 20} == {12}
    assert sum(r["class_size"] == 1 for r in got) >= 8
    kept = near.keep_representatives(awkward(spark).union(more))
    assert kept.columns == more.columns and kept.where("doc_id >= 20").count() == 1
    twice = spark.createDataFrame([(1, base), (2, base.replace("word9 ", "edit ")), (2, "quite another text of its own")], "doc_id long, __own string").withColumnRenamed("__own", "text").withColumn("__own", F.lit("mine"))
    left = rows(near.keep_representatives(twice))
    assert sorted((r["doc_id"], r["text"] == base, r["__own"]) for r in left) == [(1, True, "mine"), (2, False, "mine")] and len(left) == 2
    assert rows(near.classify(empty(spark))) == []


def derived(n, words, edits, recent=None):
    """n texts, each a random earlier one (of the recent ones, if given) with some words replaced."""
    rng = np.random.default_rng(3)
    texts = [[f"w{x}" for x in rng.integers(0, 10**6, words)]]
    while len(texts) < n:
        own = list(texts[rng.integers(max(0, len(texts) - recent) if recent else 0, len(texts))])
        for at in rng.integers(0, words, edits):
            own[at] = f"w{rng.integers(0, 10**6)}"
        texts.append(own)
    return [" ".join(t) for t in texts]


def classes_of_buckets(lists, sampler):
    """The least member of each text's class, from all pairs that share any bucket."""
    s = np.array([sampler.samples(x) for x in lists])
    parent = list(range(len(lists)))

    def find(x):
        while parent[x] != x:
            x = parent[x] = parent[parent[x]]
        return x

    for a in range(len(lists)):
        same = s[a] == s[a + 1 :]
        bucket = same.reshape(len(same), near.BANDS, near.ROWS).all(2).any(1)
        for b in a + 1 + np.flatnonzero(bucket & (same.sum(1) >= near.LEAST_AGREEMENT * near.SAMPLES)):
            if find(a) != find(b) and sampler.similarity(lists[a], lists[b]) >= near.THRESHOLD:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(len(lists))]


@pytest.mark.parametrize("recent", [None, 3], ids=["tree", "chain"])
def test_near_dedup_of_derived_copies(spark, recent):
    texts = derived(600, 300, 3, recent)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lists = [shingles(t.encode()) for t in texts]
    want = classes_of_buckets(lists, near.Sampler(near.document_weights(df)))
    got = {r["doc_id"]: r["class_id"] for r in rows(near.classify(df))}
    assert [got[k] for k in range(len(texts))] == want


def test_near_dedup_links_through_the_rim(spark):
    """Hubs with copies, and a text beyond each rim: it meets 0.8 with a copy, not with the hub, often in a bucket that the hub leads."""
    rng = np.random.default_rng(5)
    texts = []
    for g in range(40):
        hub = [f"g{g}w{k}" for k in range(400)]
        edit = lambda own, at, g=g: [f"g{g}e{rng.integers(0, 10**9)}" if k in at else w for k, w in enumerate(own)]
        rim = edit(hub, range(0, 60, 8))
        texts += [hub, *[edit(hub, [int(rng.integers(100, 400))]) for _ in range(6)], rim, edit(rim, range(200, 264, 8))]
    texts = [" ".join(t) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lists = [shingles(t.encode()) for t in texts]
    sampler = near.Sampler(near.document_weights(df))
    assert all(sampler.similarity(lists[9 * g + 7], lists[9 * g + k]) >= 0.8 for g in range(40) for k in (0, 8))
    assert all(sampler.similarity(lists[9 * g], lists[9 * g + 8]) < 0.8 for g in range(40))
    got = {r["doc_id"]: r["class_id"] for r in rows(near.classify(df))}
    assert [got[k] for k in range(len(texts))] == classes_of_buckets(lists, sampler)


def test_word_hashes_depend_on_the_word_alone():
    a, b = word_hashes(b"Hello, brave new World"), word_hashes(b"x " * 600000 + b"world hello")
    assert a[0] == b[-1] and a[3] == b[-2] and len(set(a.tolist())) == 4 and len(b) == 600002
    assert len(shingles(b"")) == 0 and len(shingles(b"a b")) == 1 and len(shingles(b"a b c d e f")) == 2


# -- op8 ------------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_units_give_the_librarys_ids(name, docs):
    e = Encoder(vocabulary(name))
    odd = ["", " ", "a  b", "a\n\nb \n c", "tab\tx  \t y ", "it's we'll  don't", "\x1cx \x1d y", "ÉÀ É ΣΑΣ İ", "<|endoftext|> x", "3 123 1,000.5 %%% $$$", " lead", "trail ", "nbsp x y 　z", "x" * 500, "é á", "日本語 テキスト 🎉 🎉"]
    texts = odd + docs.text.tolist()[:100]
    want = [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in e.encode(texts)] == want
    assert [x.tolist() for x in e.encode(texts)] == want


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_units_of_awkward_texts(name, monkeypatch):
    """Random strings of difficult parts, with a cache that turns over many times."""
    monkeypatch.setattr("terrafold.llm.encode.MOST_UNITS", 300)
    parts = [" ", " ", "\n", "\r\n", "\t", "\u00a0", "\u3000", "\x85", "\x1c", "\x01", "a", "The", "foo", "b\u00e9", "E\u0301", "\u03a3", "\u03c3", "\u0130", "\u00df",
             "\u01c5", "\u00aa", "\u4e2d", "1", "\u00b2", "\u2163", ".", ",", "...", "'", "'s", "-", "_", "!", "<|endoftext|>", "\u200b"]
    draw = np.random.default_rng(7)
    texts = ["".join(parts[k] for k in draw.integers(0, len(parts), draw.integers(0, 25))) for _ in range(3000)]
    texts += ["", " ", "\n", "\n\n", "foo ", "foo\n", " foo", "\nfoo", "x" * 5000, "." * 300, "foo" + "." * 300, "a" * 60 + "."]
    e = Encoder(vocabulary(name))
    for at in range(0, len(texts), 100):
        some = texts[at : at + 100]
        assert [x.tolist() for x in e.encode(some)] == [e.tokenizer.encode(t, add_special_tokens=False).ids for t in some]


def test_files_round_trip_and_read_only_what_is_asked(tmp_path):
    rng = np.random.default_rng(1)
    docs = [(k if k != 3 else None, rng.integers(0, 50000, n, dtype=np.uint32)) for k, n in enumerate([10, 0, 70000, 5, 2_500_000, 1, 65536])]
    with open(tmp_path / "f", "wb") as out:
        w = binary.Writer(out)
        for d, ids in docs:
            w.add(d, ids)
        w.close()
    with open(tmp_path / "f", "rb") as f:
        r = binary.Reader(f, (tmp_path / "f").stat().st_size)
        got = r.read([0, 5])
        assert r.opened <= 2 and got[0].tolist() == docs[0][1].tolist() and got[5].tolist() == docs[5][1].tolist()
        got = r.read([d for d, _ in docs])
        assert all((got[d] == ids).all() and len(got[d]) == len(ids) for d, ids in docs)
    import zstandard

    whole = zstandard.ZstdDecompressor().stream_reader(open(tmp_path / "f", "rb"), read_across_frames=True).read()
    assert whole == b"".join(ids.astype("<u4").tobytes() for _, ids in docs)
    data = bytearray((tmp_path / "f").read_bytes())
    data[20] ^= 1
    (tmp_path / "g").write_bytes(data)
    with open(tmp_path / "g", "rb") as f, pytest.raises(Exception):  # noqa: B017
        binary.Reader(f, len(data)).read([0])


def test_token_files_match_the_tokenizer(spark, docs):
    got = sorted(rows(queries.op8_token_binary(spark, SF)), key=lambda r: r["start"])
    enc = Encoder(vocabulary("byte_bpe_50k.json"))
    at = 0
    for r, doc, text in zip(got, docs.doc_id, docs.text, strict=True):
        ids = [*enc.tokenizer.encode(text, add_special_tokens=False).ids, 2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert len(rows(binary.round_trip(awkward(spark), vocabulary("byte_bpe_50k.json"), 2))) == 11
    assert rows(binary.round_trip(empty(spark), vocabulary("byte_bpe_50k.json"), 2)) == []


# -- op9 ------------------------------------------------------------------------------------------

def test_language_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    lang = dict(duckdb.sql(f"select doc_id, lang from '{sf}/documents.parquet'").fetchall())
    got = rows(queries.op9_language_id(spark, sf))
    assert len(got) == len(lang) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) > 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_of_awkward_rows(spark):
    got = rows(language.identify(awkward(spark)))
    assert len(got) == 11 and {r["doc_id"] for r in got if r["lang_pred"] == "und"} == {1, 2, 3, 8}
    assert {r["lang_pred"] for r in rows(language.identify(awkward(spark).withColumn("lang", F.lit(None).cast("string"))))} == {"und"}
    assert rows(language.identify(empty(spark))) == []
    odd = spark.createDataFrame([(1, "\u00b2\u00bd \u00b3", "en"), (2, "\u2163", "en"), (3, "\u4e2d", "en")], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in sorted(rows(language.identify(odd)), key=lambda r: r["doc_id"])] == ["und", "und", "en"]
    names = awkward(spark).withColumnRenamed("size", "row").withColumnRenamed("digest", "p").withColumn("__language", F.lit("mine"))
    kept = language.keep_identified(names, 0.0)
    assert kept.columns == names.columns and {r["__language"] for r in rows(kept)} == {"mine"}


def test_ngrams_stand_in_one_block_each(monkeypatch):
    texts = ["ab" * 40, "", "Xyz \u00e9", "q"]

    def counted():
        found = Counter()
        for row, bucket in language.hashed_ngrams(texts, 12):
            found.update(zip(row.tolist(), bucket.tolist(), strict=True))
        return found

    whole = counted()
    padded = [f" {t.lower()} " for t in texts]
    assert [sum(n for (row, _), n in whole.items() if row == k) for k in range(4)] == [max(0, len(p) - 1) + max(0, len(p) - 2) for p in padded]
    for block in (1, 2, 7, 16):
        monkeypatch.setattr(language, "BLOCK", block)
        assert counted() == whole


def test_language_matches_plain_bayes(spark):
    """Every prediction and score against naive Bayes in plain Python."""
    bits = language.BITS
    data = duckdb.sql(f"select doc_id, text, lang from '{SF}/documents.parquet'").fetchall()

    def grams(text):
        t, m = f" {text.lower()} ", 0xFFFFFFFF
        for i in range(len(t) - 1):
            pair = (ord(t[i]) * 0x9E3779B1 & m) ^ (ord(t[i + 1]) * 0x85EBCA77 & m)
            each = [pair] if i + 2 >= len(t) else [pair, (pair * 0xC2B2AE3D & m) ^ (ord(t[i + 2]) * 0x27D4EB2F & m)]
            for h in each:
                yield ((h ^ (h >> 15)) * 0x2C1B3C6D & m) >> (32 - bits)

    counts, n_docs = defaultdict(Counter), Counter()
    for doc, text, lang in data:
        if lang is not None and text is not None and zlib.crc32(str(doc).encode()) % 4 != 2:
            counts[lang].update(grams(text))
            n_docs[lang] += 1
    langs = sorted(counts)
    size = {k: sum(counts[k].values()) + language.SMOOTHING * (1 << bits) for k in langs}
    got = {r["doc_id"]: r for r in rows(queries.op9_language_id(spark, SF))}
    for doc, text, _ in data:
        r = got[doc]
        if not text or not any(c.isalpha() for c in text):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        own = Counter(grams(text))
        n = sum(own.values())
        mean = [(math.log(n_docs[k] / sum(n_docs.values())) + sum(c * (math.log(counts[k][h] + language.SMOOTHING) - math.log(size[k])) for h, c in own.items())) / n for k in langs]
        e = [math.exp((x - max(mean)) * min(n, language.EFFECTIVE)) for x in mean]
        assert r["lang_pred"] == langs[mean.index(max(mean))] and r["score"] == pytest.approx(max(e) / sum(e), abs=1e-9)


# -- op10 -----------------------------------------------------------------------------------------

def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        if not free:
            return fixed
        level = (total - sum(fixed.values())) / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] > cap * sizes[s]]
        if not over:
            return fixed | {s: level * w[s] for s in free}
        fixed |= {s: cap * sizes[s] for s in over}


def check_mix(got):
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
    want = brute_targets(sizes)
    for s in sizes:
        assert math.isclose(target[s], want[s], rel_tol=1e-9, abs_tol=1e-6)
    return sizes, taken, target


def test_mix_meets_its_targets(spark, docs):
    got = rows(queries.op10_mixing(spark, "/root/testdata/sf0.01"))
    sizes, taken, target = check_mix(got)
    assert all(abs(taken[s] - target[s]) < 0.03 * target[s] + 50 for s in sizes)
    again = rows(queries.op10_mixing(spark, "/root/testdata/sf0.01"))
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mix_of_awkward_rows(spark):
    labels = spark.createDataFrame([(5, 1, 0), (6, 0, 0), (5, None, None)], "doc_id long, quality int, toxic int")
    got = rows(mixing.mix(awkward(spark), labels))
    assert len(got) == 11
    check_mix(got)
    assert rows(mixing.mix(empty(spark), labels)) == []
    names = awkward(spark).withColumnRenamed("part", "__own").withColumnRenamed("digest", "row")
    out = mixing.mixed_documents(names, labels)
    assert out.columns == names.columns and out.where("row = 'x'").count() == out.count()


def test_repeated_rows_are_mixed_one_by_one(spark):
    docs = spark.createDataFrame([(1, "w " * 10, "a")] * 20 + [(2, "w " * 10, "b")] * 20 + [(k, "w " * 7, None) for k in range(3, 40)], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    want = Counter()
    for r in rows(mixing.mix(docs, labels)):
        want[r["doc_id"]] += r["times"]
    out = Counter(r["doc_id"] for r in rows(mixing.mixed_documents(docs, labels)))
    assert out == Counter({k: n for k, n in want.items() if n}) and 0 < want[1] % 20


def spark_hash(*values):
    """Spark's xxhash64 of columns: each value's bytes are hashed with the hash so far as seed, nulls change nothing."""
    h = 42
    for v, form in values:
        if v is not None:
            h = xxhash.xxh64_intdigest(v.encode() if form == "s" else struct.pack(form, v), seed=h)
    return h - (1 << 64) if h >> 63 else h


def brute_draw(docs, weight):
    """(doc_id, source, size) -> times, by the definition: keys, order and prefix sums in plain Python; docs: doc_id, text, source."""
    listed = [(d, s, len(re.findall("[^ \\t-\\r]+", t or ""))) for d, t, s in docs]
    sizes = Counter()
    for d, s, n in listed:
        sizes[s] += n
    target, out = brute_targets(sizes), Counter()
    for s in sizes:
        epochs = math.floor(target[s] / sizes[s]) if sizes[s] else 0
        room = target[s] - epochs * sizes[s]
        key = lambda d, s, n: -math.log(((spark_hash((20, "<i"), (d, "<q"), (s, "s"), (n, "<q")) >> 12) + 2.0**51 + 0.5) / 2.0**52) / weight.get(d, 1.0)
        own = sorted((key(*x), x[0] is not None, x[0] or 0, x[2], x) for x in listed if x[1] == s)
        left, taken = [r for r in own if r[3]], []
        for fits in (lambda n, room: True, lambda n, room: n <= room):
            before, rest = 0, []
            for r in left:
                if not fits(r[3], room):
                    rest.append(r)
                    continue
                (taken if room > 0 and before + r[3] <= room else rest).append(r)
                before += r[3]
            room -= sum(r[3] for r in left) - sum(r[3] for r in rest)
            left = rest
        taken += next(([r] for r in left if r[3] < 2 * room), [])
        for r in own:
            out[r[4]] += epochs
        for r in taken:
            out[r[4]] += 1
    return out


def test_mix_equals_a_brute_force_draw(spark):
    at = "/root/testdata/sf0.01"
    docs = duckdb.sql(f"select doc_id, text, source from '{at}/documents.parquet'").fetchall()
    labels = duckdb.sql(f"select doc_id, max(quality) as q from '{at}/labels.parquet' group by doc_id").fetchall()
    want = brute_draw(docs, {d: {1: 2.0, 0: 0.5}.get(q, 1.0) for d, q in labels})
    got = Counter()
    for r in rows(queries.op10_mixing(spark, at)):
        got[r["doc_id"], r["source"], r["size"]] += r["taken"] // max(1, r["size"]) if r["size"] else 0
    assert {k: n for k, n in got.items() if n} == {k: n for k, n in want.items() if n and k[2]}


def test_a_last_document_brings_the_sum_nearer(spark):
    """One document of 100 words against a target of 66.7: taken once (33.3 off), not left out (66.7 off)."""
    words = lambda n: "w " * n
    docs = spark.createDataFrame([(1, words(100), "a")] + [(k, words(50), "b") for k in range(2, 4)], "doc_id long, text string, source string")
    got = rows(mixing.mix(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")))
    one = next(r for r in got if r["doc_id"] == 1)
    assert one["target"] == pytest.approx(200 / 3) and one["taken"] == 100
    assert queries.op10_mixing(spark, SF).columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]


def test_very_many_equal_rows_are_mixed(spark):
    docs = spark.range(100_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one two three").alias("text"), F.lit("a").alias("source")).union(spark.createDataFrame([(1, "x " * 90_000, "b")], "doc_id long, text string, source string"))
    got = mixing.mix(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    sums = {r.source: r for r in got.groupBy("source").agg(F.count("*").alias("n"), F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()}
    assert sums["a"].n == 100_000 and abs(sums["a"].taken - sums["a"].target) <= 1.5 and sums["a"].target == 130_000


def test_better_documents_are_drawn_more_often(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.lit(1).cast("long").alias("size"), F.when(F.col("id") % 2 == 0, 2.0).otherwise(0.5).alias("weight"))
    df = df.union(spark.range(4000, 4100).select("id", F.lit("b"), F.lit(100).cast("long"), F.lit(1.0)))
    got = [r for r in rows(mixing.draw(df, weights=(1, 4))) if r["source"] == "a"]
    good, bad = (sum(r["times"] for r in got if r["doc_id"] % 2 == k) for k in (0, 1))
    assert good > 1.5 * bad > 0


# -- pipeline -------------------------------------------------------------------------------------

def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline

    base = spark.read.parquet(f"{SF}/documents.parquet").unionByName(awkward(spark).select("doc_id", "text", "lang", "source", "n_chars").withColumn("doc_id", F.col("doc_id") + 100000))
    docs, seen = base, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SF), name)
        assert docs.columns == base.columns
        seen.append(docs.count())
    assert seen[0] > 0.95 * 200 and seen[0] < base.count() and seen[1] < seen[0] and seen[2] < seen[1]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.agg(F.sum("length")).first()[0] > 0
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert {r.doc_id for r in out.select("doc_id").collect()} == ids
