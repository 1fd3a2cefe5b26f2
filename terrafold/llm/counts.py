"""Token counts: delta-maintained rollups.

The store is a folder of additive deltas, one sub-folder per batch: a batch's signed changes are summed
by source, language and tokenizer version and written once. Totals are sums over what is committed. A
version counts the tokens of a vocabulary (vocabulary_counter), or words by a pattern.

A commit writes to a folder of its own attempt and then gives it the batch's name, which fails if the
name is taken. So a batch that is committed is never applied again, one that failed half-way has no name
and does not count, and of two commits of one batch at the same time one stands and the other returns
False (on a file system whose rename is atomic; elsewhere let one writer commit). compact() adds the
committed batches to the folded sums, in the same way: the folder of the new sums also lists the batches
that are in them, and totals leave those out, so it does not matter where a compaction stops.

Defined cases: null source or language is a group of its own; null text has 0 tokens and counts as a
document; a group whose documents are all gone does not appear; repeated rows count as often as they
stand; an empty batch commits nothing but its id; extra columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.llm.encode import encoder, vocabulary
from terrafold.llm.store import bounded, scratch, written

GROUP = ["source", "lang", "tokenizer"]
_SUMS = "source string, lang string, tokenizer string, docs long, tokens long"


def vocabulary_counter(path: str) -> Callable[[Column], Column]:
    """A tokenizer version that counts the tokens of a vocabulary file (JSON of the tokenizers library); null text has none."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([len(ids) for ids in encoder(path).encode([t or "" for t in texts])], dtype="int64")

    return count


def pattern_counter(pattern: str) -> Callable[[Column], Column]:
    """A version that counts the matches of a Java pattern."""
    return lambda text: F.regexp_count(F.coalesce(text, F.lit("")), F.lit(pattern)).cast("long")


def vocabularies() -> dict[str, Callable[[Column], Column]]:
    """The two public vocabularies as tokenizer versions, by name."""
    return {"byte-bpe-50k": vocabulary_counter(vocabulary("byte_bpe_50k.json")), "word-bpe-49k": vocabulary_counter(vocabulary("word_bpe_49k.json"))}


class Rollup:
    """Totals by source, language and tokenizer version, kept under one folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _named(self, attempt: str, name: str) -> bool:
        """Give an attempt's folder its name; False, and the attempt is gone, if the name is taken."""
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        where = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.spark._jsc.hadoopConfiguration())
        plain = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        source, target = self.path(f"{self.root}/{attempt}"), self.path(f"{self.root}/{name}")
        if not self.fs.exists(target):
            try:
                where.rename(source, target, plain)
                return True
            except Exception:
                if not self.fs.exists(target):
                    raise
        self.fs.delete(source, True)
        return False

    def _folders(self, kind: str) -> dict[int, str]:
        """Committed folders of a kind by number."""
        found = self.fs.globStatus(self.path(f"{self.root}/{kind}=*")) or []
        names = [x.getPath().getName() for x in found]
        return {int(n.partition("=")[2]): f"{self.root}/{n}" for n in names}

    def _folded(self) -> tuple[int, DataFrame | None, set[int]]:
        """The newest folded sums: their number, rows and batches (one number each)."""
        made = self._folders("folded")
        if not made:
            return 0, None, set()
        last = max(made)
        ids = {r.batch for r in self.spark.read.schema("batch long").parquet(f"{made[last]}/batches").collect()}
        return last, self.spark.read.schema(_SUMS).parquet(f"{made[last]}/sums"), ids

    def committed(self, batch: int) -> bool:
        return batch in self._folders("batch") or batch in self._folded()[2]

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Apply signed changes (source, lang, tokenizer, docs, tokens); False if the batch was applied before."""
        if self.committed(batch):
            return False
        attempt = f".attempt-{uuid.uuid4().hex}"
        sums = changes.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        sums.write.parquet(f"{self.root}/{attempt}")
        return self._named(attempt, f"batch={batch:012d}")

    def _sums(self, paths: list[str], folded: DataFrame | None) -> DataFrame:
        deltas = self.spark.read.schema(_SUMS).parquet(*paths) if paths else self.spark.createDataFrame([], _SUMS)
        deltas = deltas if folded is None else deltas.union(folded)
        return deltas.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))

    def totals(self) -> DataFrame:
        """Sums over what is committed; what an unfinished attempt has left behind does not count."""
        _, folded, ids = self._folded()
        paths = [p for k, p in sorted(self._folders("batch").items()) if k not in ids]
        return self._sums(paths, folded).where("docs != 0 or tokens != 0")

    def compact(self) -> int:
        """Add all committed batches to the folded sums; how many were added. Their folders, and older sums, are deleted last."""
        number, folded, ids = self._folded()
        batches = {k: p for k, p in self._folders("batch").items() if k not in ids}
        if batches:
            attempt = f".attempt-{uuid.uuid4().hex}"
            self._sums(sorted(batches.values()), folded).write.parquet(f"{self.root}/{attempt}/sums")
            self.spark.createDataFrame([(k,) for k in sorted({*ids, *batches})], "batch long").coalesce(1).write.parquet(f"{self.root}/{attempt}/batches")
            if not self._named(attempt, f"folded={number + 1:06d}"):
                return 0
        number, _, ids = self._folded()
        for kind, gone in (("batch", lambda k: k in ids), ("folded", lambda k: k < number)):
            for k, path in self._folders(kind).items():
                if gone(k):
                    self.fs.delete(self.path(path), True)
        return len(batches)


def signed(rows: DataFrame, tokens: Column, tokenizer: str, sign: int) -> DataFrame:
    """Changes that add (1) or take back (-1) rows with their counts."""
    return rows.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(sign).cast("long").alias("docs"), (tokens * sign).alias("tokens"))


def revised(rows: DataFrame, old: Column, new: Column, tokenizer: str) -> DataFrame:
    """Changes that replace a count: the document stays, the difference is added."""
    return rows.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(0).cast("long").alias("docs"), (new - old).alias("tokens"))


def counted(docs: DataFrame, tokenizers: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """doc_id, source, lang and one count per tokenizer version; each text is read once."""
    return written(bounded(docs).select("doc_id", "source", "lang", *[f(F.col("text")).alias(name) for name, f in tokenizers.items()]), "counts")


def maintain(docs: DataFrame, labels: DataFrame, tokenizers: dict[str, Callable[[Column], Column]], root: str | None = None) -> DataFrame:
    """Totals after a history in four batches, folded half-way: all documents by every version, toxic ones deleted, bad ones recounted by the first version as the last one counts them, the first batch again (which changes nothing)."""
    spark = docs.sparkSession
    store, rows = Rollup(spark, root or scratch(spark, "rollup")), counted(docs, tokenizers)
    names = list(tokenizers)

    def every(some: DataFrame, sign: int) -> DataFrame:
        # One row of a document stands for all its versions, so the counts are read once.
        pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("tokenizer"), F.col(f"`{n}`").alias("tokens")) for n in names])).alias("v")
        return some.select("source", "lang", pairs).select("source", "lang", "v.tokenizer", F.lit(sign).cast("long").alias("docs"), (F.col("v.tokens") * sign).alias("tokens"))

    store.commit(1, every(rows, 1))
    marks = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    marked = rows.join(marks, "doc_id")
    store.commit(2, every(marked.where("toxic = 1"), -1))
    store.compact()
    store.commit(3, revised(marked.where("quality = 0 and coalesce(toxic, 0) != 1"), F.col(f"`{names[0]}`"), F.col(f"`{names[-1]}`"), names[0]))
    store.commit(1, every(rows, 1))
    return store.totals()
