"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams (orders 2 and 3, lower case, padded with one space) in 2**bits buckets per
language; the log-probability matrix is broadcast (languages x 2**bits floats). A batch of whole texts is a
sparse matrix, one entry per n-gram, whose product with it is a gather and a sum by row in numpy, in blocks
of BLOCK characters, so memory does not follow the text's length.

Defined cases: null text or a text without a letter gives ``und`` with score 0; no labelled row at
all gives ``und`` for every row; ties go to the first language by code point; repeated rows are
predicted alike; extra columns pass through untouched, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.llm.store import bounded

BITS = 15
#: Training uses about this many labelled rows at most, chosen by a hash of doc_id.
MAX_TRAINING_ROWS = 50_000
BLOCK = 1 << 17
SMOOTHING = 0.5
#: The score is the posterior of a text of so many n-grams with the text's mean log-probabilities.
EFFECTIVE = 12.0
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    """Whether any character is a letter to Unicode (category L); numerals such as superscripts are none."""
    return bool(text) and any(m[0].isalpha() for m in _LETTER.finditer(text))


def hashed_ngrams(texts: list[str], bits: int):
    """The texts as sparse rows: blocks of (row, bucket), one entry per 2-gram and 3-gram of each text.

    N-grams start at every character of the padded text and never reach into the next text; a block covers
    the n-grams that start at BLOCK characters, so each stands in one block, however long a text is.
    """
    padded = [f" {t.lower()} " for t in texts]
    ends = np.cumsum([len(t) for t in padded])
    c = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    for at in range(0, len(c), BLOCK):
        some = c[at : at + BLOCK + 2]
        pairs = some[:-1] * np.uint32(0x9E3779B1) ^ some[1:] * np.uint32(0x85EBCA77)
        triples = pairs[:-1] * np.uint32(0xC2B2AE3D) ^ some[2:] * np.uint32(0x27D4EB2F)
        for size, grams in ((2, pairs[:BLOCK]), (3, triples[:BLOCK])):
            start = at + np.arange(len(grams))
            row = np.searchsorted(ends, start, "right")
            inside = start + size <= ends[row]
            h = grams[inside]
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            yield row[inside], h >> np.uint32(32 - bits)


@dataclass
class Model:
    langs: list[str]
    logp: np.ndarray
    prior: np.ndarray
    bits: int

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text: the product of the sparse matrix of n-grams with the log-probabilities, by blocks."""
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        at = [k for k, t in enumerate(texts) if self.langs and has_letter(t)]
        total, n = np.zeros((len(self.langs), len(at))), np.zeros(len(at))
        for row, bucket in hashed_ngrams([texts[k] for k in at], self.bits):
            if not len(row):
                continue
            first, past = int(row[0]), int(row[-1]) + 1  # rows of a block are in order
            n[first:past] += np.bincount(row - first)
            for j in range(len(self.langs)):
                total[j, first:past] += np.bincount(row - first, weights=self.logp[j, bucket])
        if at:
            mean = (total + self.prior[:, None]) / n
            e = np.exp((mean - mean.max(axis=0)) * np.minimum(n, EFFECTIVE))
            best = np.argmax(mean, axis=0)
            scores[at] = e[best, np.arange(len(at))] / e.sum(axis=0)
            for k, j in zip(at, best.tolist(), strict=True):
                langs[k] = self.langs[j]
        return langs, scores


def fit(docs: DataFrame, bits: int = BITS, max_rows: int = MAX_TRAINING_ROWS) -> Model:
    """Learn from the rows with a label. docs: doc_id, text, lang.

    Counts are summed by language and bucket in Spark; languages x 2**bits sums reach the driver.
    """
    rows = bounded(docs).select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    n = rows.count()
    if n > max_rows:
        rows = rows.where(F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(1_000_000)) < int(1e6 * max_rows / n))
    size = 1 << bits

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        seen: dict[str, int] = {}
        for b in batches:
            own = np.array(b.column("lang").to_pylist(), object)
            for lang in set(own):
                texts = b.column("text").filter(pa.array(own == lang)).to_pylist()
                into = sums.setdefault(lang, np.zeros(size, np.int64))
                seen[lang] = seen.get(lang, 0) + len(texts)
                for _, bucket in hashed_ngrams(texts, bits):
                    into += np.bincount(bucket, minlength=size)
        for lang, into in sums.items():
            at = np.flatnonzero(into)
            yield pa.RecordBatch.from_pydict({
                "lang": [lang] * (len(at) + 1), "bucket": np.append(at, -1), "n": np.append(into[at], seen[lang])})

    sums = rows.select("lang", "text").mapInArrow(count, "lang string, bucket long, n long")
    found = sums.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(found["lang"]))
    counts, docs_of = np.zeros((size, len(langs))), np.ones(len(langs))
    for j, lang in enumerate(langs):
        own = found[found["lang"] == lang]
        grams = own[own["bucket"] >= 0]
        counts[grams["bucket"].to_numpy(), j] = grams["n"].to_numpy()
        docs_of[j] = own.loc[own["bucket"] < 0, "n"].sum()
    logp = np.log(counts + SMOOTHING) - np.log(counts.sum(axis=0) + SMOOTHING * size)
    return Model(langs, np.ascontiguousarray(logp.T), np.log(docs_of / docs_of.sum()), bits)


def predictor(spark: SparkSession, model: Model):
    """A function from a text column to struct<lang_pred, score>."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        found, scores = shared.value.score(texts.tolist())
        return pd.DataFrame({"lang_pred": found, "score": scores})

    return predict


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; learns from the rows that are not held out."""
    spark = docs.sparkSession
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    predict = predictor(spark, model)
    return docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("p")
    ).select("doc_id", "held_out", "p.lang_pred", "p.score")


def keep_identified(docs: DataFrame, least_score: float = 0.4) -> DataFrame:
    """Rows whose language is recognised, with the columns as they were."""
    predict = predictor(docs.sparkSession, fit(docs.where(~held_out(F.col("doc_id")))))
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), predict("text").alias("p"))
    return marked.where((F.col("p.lang_pred") != UNKNOWN) & (F.col("p.score") >= least_score)).select("row.*")
