"""Source divergence audit: how far each source's words lie from those of other sources of its language.

Sort-based streaming. A task counts terms over blocks of its documents; the partial counts are dealt by
(lang, term), sorted by term, lang, source and document (a block's first one; a term's first bytes tell
rows apart sooner than a language does) and read as runs. The first scan keeps the terms of enough
documents; their counts give each group (lang, source) its size N and each language its number of terms V.
The second scan reads the kept counts as runs of (lang, term) and emits partial sums of pairs of sources
and the terms that a source uses more than its language does.

p of a group and term is 1 + floor(10^9 (count + 1) / (N + V)), in integers, and pair (g, h) sums
floor((p - q)^2 / q) over all V terms. Most counts are 0, so with p(0) of a group written a and
f(p, q) for a term of the sum, the sum is taken apart without visiting zeros:
    V f(a_g, a_h) + sum over g's terms of f(p_g, a_h) - f(a_g, a_h) + the same over h's terms
    + sum over terms of both of f(p_g, p_h) - f(p_g, a_h) - f(a_g, p_h) + f(a_g, a_h).
The one-sided sums depend on a count only, so they come from a histogram of each group's counts; runs
emit the last sum, the square of the sources that have the term. Everything is exact: sums are at most
some 10^18 while V is below 8 * 10^9.

Defined cases: null text, lang and source are ''; every row is a document of its own, whatever its doc_id,
so repeated rows count as often as they stand; a group without terms has N = 0; a language without kept
terms has V = 0 and pairs of value 0; a language of one source has no pair; an empty table gives no row;
extra columns are not read. Ties go by the item's UTF-8 bytes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrafold.llm.shingles import blocks
from terrafold.llm.store import bounded, written

SCALE = 1_000_000_000
LEAST_DOCS, TOP = 3, 200
#: Counts that a task holds before it lets them go; a pair table's cells; rows that a scan takes at once.
HELD, CELLS, ROWS = 400_000, 1 << 20, 1 << 16
_TERM, _GAP = re.compile(rb"[a-z\x80-\xff]+"), re.compile(rb"[^a-z\x80-\xff]")
_PARTIAL = pa.schema([("lang", pa.string()), ("term", pa.string()), ("source", pa.string()), ("document", pa.int64()), ("df", pa.int64()), ("n", pa.int64())])
_KEPT = pa.schema([("lang", pa.string()), ("term", pa.string()), ("source", pa.string()), ("n", pa.int64()), ("head", pa.int64())])
_FOUND = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("pair", pa.bool_()), ("value", pa.int64())])


def _partials(batches) -> Iterator[pa.RecordBatch]:
    """Counts by group and term over blocks of documents; a block ends once it holds HELD counts."""
    held, size, first = {}, 0, None

    def let_go() -> Iterator[pa.RecordBatch]:
        for (lang, source), (df, n) in held.items():
            names = list(n)
            for k in range(0, len(names), 20_000):
                some = names[k : k + 20_000]
                yield pa.RecordBatch.from_arrays([
                    _same(lang, len(some)), pa.array(some, pa.binary()).cast(pa.string()), _same(source, len(some)), pa.array(np.full(len(some), first)),
                    pa.array([df[t] for t in some], pa.int64()), pa.array([n[t] for t in some], pa.int64())], schema=_PARTIAL)

    for b in batches:
        for doc, lang, source, text in zip(*(b.column(k).to_pylist() for k in range(3)), b.column(3).cast(pa.binary()), strict=True):
            first = doc if first is None else first
            df, n = held.setdefault((lang, source), (Counter(), Counter()))
            seen, before = set(), len(n)
            for block in blocks(text.as_py().lower(), _GAP):
                found = _TERM.findall(block)
                n.update(found)
                seen.update(found)
            df.update(seen)
            size += len(n) - before
            if size > HELD:
                yield from let_go()
                held, size, first = {}, 0, None
    yield from let_go()


def _same(value: str, n: int) -> pa.Array:
    return pa.repeat(pa.scalar(value, pa.string()), n)


def _changes(t: pa.Table, keys: tuple[str, ...]) -> np.ndarray:
    """Where rows differ from the row before them in one of the columns; the first row does."""
    out = np.ones(t.num_rows, bool)
    for c in keys:
        column = t[c].combine_chunks()
        part = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
        out[1:] = part if c == keys[0] else out[1:] | part
    return np.flatnonzero(out)


def _runs(batches, columns: list[str], shorten: Callable[[pa.Table], pa.Table]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole runs of (term, lang), and where the runs begin, from sorted batches.

    The last run of a table waits for the next batches, shortened, so that a long run takes no more room
    than it has sources.
    """
    held, size, rest = [], 0, None

    def whole() -> pa.Table:
        now = pa.Table.from_batches(held).select(columns)
        return shorten(now if rest is None else pa.concat_tables([rest, now]))

    for b in batches:
        held.append(b)
        size += b.num_rows
        if size >= ROWS:
            t = whole()
            at = _changes(t, ("term", "lang"))
            if at[-1]:
                yield t.slice(0, at[-1]), at[:-1]
            held, size, rest = [], 0, t.slice(at[-1])
    if size or rest is not None:
        t = whole() if held else rest
        if t.num_rows:
            yield t, _changes(t, ("term", "lang"))


def _by_source(t: pa.Table) -> pa.Table:
    """Sums of df and n over rows of the same term, language and source."""
    if not t.num_rows:
        return t
    at = _changes(t, ("term", "lang", "source"))
    sums = [pa.array(np.add.reduceat(t[c].to_numpy(), at)) for c in ("df", "n")]
    return pa.table([*(t[c].take(pa.array(at)) for c in ("lang", "term", "source")), *sums], names=["lang", "term", "source", "df", "n"])


def _kept(least: int):
    """Sorted partial counts in, the counts by source of every term of at least that many documents out."""

    def run(batches):
        for t, at in _runs(batches, ["lang", "term", "source", "df", "n"], _by_source):
            enough = np.repeat(np.add.reduceat(t["df"].to_numpy(), at) >= least, np.diff(at, append=t.num_rows))
            head = np.zeros(t.num_rows, np.int64)
            head[at] = 1
            yield from t.drop_columns("df").append_column("head", pa.array(head)).filter(pa.array(enough)).cast(_KEPT).to_batches()

    return run


def kept_counts(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, term, source, n (above 0), head of the terms that at least least_docs documents of the language hold; written.

    head is 1 in one row of each term, so that terms can be counted by a sum.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    slim = bounded(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text("lang").alias("lang"), text("source").alias("source"), text("text").alias("text"))
    partial = slim.mapInArrow(_partials, "lang string, term string, source string, document long, df long, n long")
    dealt = partial.repartition("lang", "term").sortWithinPartitions("term", "lang", "source", "document")
    return written(dealt.mapInArrow(_kept(least_docs), "lang string, term string, source string, n long, head long"), "terms")


def share(n: str, total: str, v: str) -> Column:
    """1 + floor(10^9 (n + 1) / (total + v)), in integers; null where total + v is 0."""
    return F.expr(f"cast(cast({n} + 1 as decimal(20,0)) * cast({SCALE} as decimal(10,0)) div nullif(cast({total} + {v} as decimal(20,0)), 0) as bigint) + 1")


def apart(p: str, q: str) -> str:
    """floor((p - q)^2 / q) as SQL."""
    return f"((({p}) - ({q})) * (({p}) - ({q})) div ({q}))"


def groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, size (N), v (V of the language), lang_size, a (the share of a count of 0) of every occurring group; written."""
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.sum("head").alias("heads"))
    rows = named.join(own, ["lang", "source"], "left").na.fill(0, ["size", "heads"])
    of = Window.partitionBy("lang")
    rows = rows.withColumns({"v": F.sum("heads").over(of), "lang_size": F.sum("size").over(of)}).drop("heads")
    return written(rows.withColumn("a", share("0", "size", "v")), "groups")


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // q


def _share(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (n + 1) / total) by long division in base 1000, so that no product leaves 64 bits."""
    out, rest = np.zeros(len(n), np.int64), n + 1
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return out + 1


def _squares(at: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows within each run that begins at at and has n rows, as two index arrays of about CELLS pairs."""
    ends = np.cumsum(n * n)
    lo = 0
    while lo < len(at):
        hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CELLS, "right"))
        if hi > lo:
            k = n[lo:hi]
            square = k * k
            within = np.arange(square.sum()) - np.repeat(np.cumsum(square) - square, square)
            wide, begin = np.repeat(k, square), np.repeat(at[lo:hi], square)
            yield begin + within // wide, begin + within % wide
            lo = hi
        else:  # the square of one large run comes in strips
            rows, step = at[lo] + np.arange(n[lo]), max(1, CELLS // int(n[lo]))
            for k in range(0, len(rows), step):
                strip = rows[k : k + step]
                yield np.repeat(strip, len(rows)), np.tile(rows, len(strip))
            lo += 1


class _Pairs:
    """Sums of pairs of groups that share terms; they are let go once there are more than CELLS."""

    def __init__(self) -> None:
        self.sums: Counter = Counter()

    def add(self, names: list[tuple[str, str]], group: np.ndarray, at: np.ndarray, p: np.ndarray, a: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Rows by runs that begin at at; group: the index in names of each row's (lang, source)."""
        n, m = np.diff(at, append=len(p)), len(names)
        for x, y in _squares(at[n > 1], n[n > 1]):
            value = _apart(p[x], p[y]) - _apart(p[x], a[y]) - _apart(a[x], p[y]) + _apart(a[x], a[y])
            code = group[x] * m + group[y]
            if m * m > CELLS:
                found, code = np.unique(code, return_inverse=True)
                sums = np.zeros(len(found), np.int64)
            else:
                found, sums = None, np.zeros(m * m, np.int64)
            np.add.at(sums, code, value)
            some = np.flatnonzero(sums)
            for pair, value in zip((some if found is None else found[some]).tolist(), sums[some].tolist(), strict=True):
                if pair // m != pair % m:
                    self.sums[(*names[pair // m], names[pair % m][1])] += value
            if len(self.sums) > CELLS:
                yield self.close()

    def close(self) -> pa.RecordBatch:
        keys, values = list(self.sums), list(self.sums.values())
        self.sums.clear()
        names = [pa.array([x[k] for x in keys], pa.string()) for k in range(3)]
        return pa.RecordBatch.from_arrays([*names, pa.array([True] * len(keys), pa.bool_()), pa.array(values, pa.int64())], schema=_FOUND)


def _found(batches) -> Iterator[pa.RecordBatch]:
    """Runs of (term, lang) over sorted rows lang, term, source, n, p, a, lang_size, v: partial pair sums, and terms above the language's share."""
    pairs = _Pairs()
    for t, at in _runs(batches, ["lang", "term", "source", "n", "p", "a", "lang_size", "v"], lambda t: t):
        n, p, a = (t[c].to_numpy() for c in ("n", "p", "a"))
        total = t["lang_size"].to_numpy()[at] + t["v"].to_numpy()[at]
        q = np.repeat(_share(np.add.reduceat(n, at), total), np.diff(at, append=len(n)))
        above = np.flatnonzero(p > q)
        some = t.select(["lang", "source", "term"]).take(pa.array(above))
        value = pa.array(_apart(p[above], q[above]))
        yield from pa.table([some["lang"], some["source"], some["term"], pa.array(np.zeros(len(above), bool)), value], schema=_FOUND).to_batches()
        named = pa.table([t["lang"], t["source"]], names=["lang", "source"])
        codes = [named[c].combine_chunks().dictionary_encode() for c in ("lang", "source")]
        both = codes[0].indices.to_numpy().astype(np.int64) * len(codes[1].dictionary) + codes[1].indices.to_numpy()
        groups_in, group = np.unique(both, return_inverse=True)
        langs, sources = (c.dictionary.to_pylist() for c in codes)
        names = [(langs[x // len(sources)], sources[x % len(sources)]) for x in groups_in.tolist()]
        yield from pairs.add(names, group, at, p, a)
    yield pairs.close()


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: every other source of the language by divergence, and the terms used above the language's share."""
    kept = kept_counts(docs, least_docs)
    of = groups(docs, kept)
    each = kept.drop("head").join(of, ["lang", "source"]).withColumn("p", share("n", "size", "v")).select("lang", "term", "source", "n", "p", "a", "lang_size", "v")
    runs = each.repartition("lang", "term").sortWithinPartitions("term", "lang", "source")
    found = written(runs.mapInArrow(_found, "lang string, source string, item string, pair boolean, value long"), "found")
    # One-sided sums: x has the counts, y is another source; (x, y) and (y, x) both need them.
    wide = "decimal(38,0)"
    histogram = kept.groupBy("lang", "source", "n").agg(F.count("*").alias("m")).join(of, ["lang", "source"])
    histogram = histogram.select("lang", F.col("source").alias("x"), "m", share("n", "size", "v").alias("px"), F.col("a").alias("ax"))
    other = of.select("lang", F.col("source").alias("y"), F.col("a").alias("ay"), "v")
    sided = histogram.join(other, "lang").where("x != y").groupBy("lang", "x", "y").agg(
        F.sum(F.expr(f"cast(m as {wide}) * ({apart('px', 'ay')} - {apart('ax', 'ay')})")).alias("one"),
        F.sum(F.expr(f"cast(m as {wide}) * ({apart('ay', 'px')} - {apart('ay', 'ax')})")).alias("two"))
    base = of.select("lang", F.col("source").alias("x"), F.col("a").alias("ax")).join(other, "lang").where("x != y")
    zero = base.select("lang", "x", "y", F.when(F.col("v") > 0, F.expr(f"cast(v as {wide}) * {apart('ax', 'ay')}")).otherwise(0).cast(wide).alias("value"))
    value = F.col("value").cast(wide).alias("value")
    sums = zero.union(sided.select("lang", "x", "y", F.col("one").cast(wide))).union(sided.select("lang", F.col("y"), F.col("x"), F.col("two").cast(wide))).union(
        found.where("pair").select("lang", "source", "item", value))
    pairs = sums.groupBy("lang", F.col("x").alias("source"), F.col("y").alias("item")).agg(F.sum("value").cast("long").alias("value"))
    order = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    listed = pairs.withColumn("part", F.lit("pair")).withColumn("rank", order).select(*columns)
    above = found.where("not pair").withColumn("part", F.lit("term")).withColumn("rank", order).where(F.col("rank") <= top)
    return listed.union(above.select(*columns))


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS l FROM documents),
t AS (SELECT doc_id, lang, source, unnest(l) AS term FROM d),
k AS (SELECT lang, term, count(*) AS c FROM t GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 3),
v AS (SELECT lang, count(*) AS v, sum(c) AS n FROM k GROUP BY lang),
c AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
g AS (SELECT x.lang, x.source, coalesce(s.n, 0) AS n FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN s USING (lang, source)),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, CAST(1 + (1000000000 * CAST(coalesce(c.n, 0) + 1 AS HUGEINT)) // (g.n + v.v) AS HUGEINT) AS p,
             CAST(1 + (1000000000 * CAST(k.c + 1 AS HUGEINT)) // (v.n + v.v) AS HUGEINT) AS q
      FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source != y.source GROUP BY ALL),
pairs AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
          FROM g JOIN g h ON g.lang = h.lang AND g.source != h.source LEFT JOIN f ON f.lang = g.lang AND f.source = g.source AND f.item = h.source),
u AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
      UNION ALL
      SELECT *, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) FROM (
          SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q) e(lang, source, part, item, value))
SELECT lang, source, part, item, value, rank FROM u WHERE part = 'pair' OR rank <= 200
"""
