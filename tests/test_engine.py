"""Fixtures by hand, properties, and every query against its SQL."""

import math
import re
from collections import Counter
from statistics import median

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrafold.functions import encoding as E
from terrafold.functions import figures as Z
from terrafold.functions import grid as G
from terrafold.functions import text as X
from terrafold.operators import assess, cells, closure, components, gates, series, spans
from terrafold.plans import layers, q_cells
from terrafold.plans.registry import all_oracles, all_queries
from terrafold.sources import derived, feeds, store

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def frame(spark, rows, kind="r int, c int, v int"):
    return spark.createDataFrame(rows, kind)


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_sql(spark, con, name):
    got = all_queries()[name](spark, SF).toPandas()
    assert len(got.columns)
    if name in all_oracles():
        want = con.sql(all_oracles()[name]).df()
        assert sorted(got.columns) == sorted(want.columns)

        def norm(df):
            df = df[sorted(df.columns)]
            plain = df.astype(object).where(df.notna(), None).to_numpy().tolist()
            return sorted(str([float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in row]) for row in plain)

        assert norm(got) == norm(want)


def test_encoding_holds_and_never_wraps(spark):
    y = lambda v: E.encode_year(F.lit(v))
    assert one(spark, y(1850), y(2200), y(0), y(-5), E.decode_year(F.lit(255)), E.decode_year(F.lit(91)), E.decode_year(F.lit(0))) == (1, 200, 0, 0, -1, 1990, 0)
    assert one(spark, E.built_by(F.lit(255)), E.built_by(F.lit(255), 2050), E.built_by(F.lit(91), 1990), E.built_by(F.lit(91), 1989)) == (True, False, True, False)
    assert one(spark, E.clean_percent(F.lit(101)), E.clean_percent(F.lit(100)), E.epoch_label(F.lit(1)), E.epoch_label(F.lit(2))) == (0, 100, "2016-07", "2017-01")
    assert one(spark, E.oldest(F.lit(2000), F.lit(1980)), E.oldest(F.lit(0), F.lit(1995)), E.oldest(F.lit(1990), F.lit(0)), E.oldest(F.lit(0), F.lit(0))) == (1980, 1995, 1990, 0)


def test_area_follows_latitude(spark):
    a, b = one(spark, G.pixel_area(F.lit(28.0)), G.pixel_area(F.lit(29.0)))
    assert a > b and 85 < b < 90
    x, y = one(spark, *G.utm(F.lit(-15.0), F.lit(28.0)))
    assert abs(x - 500000) < 1e-6 and abs(y - 3097000) < 500
    with pytest.raises(Exception, match="not finite"):
        spark.createDataFrame([(float("nan"),)], "x double").select(G.interpolated([1, 2], 0.0, 1.0, F.col("x"))).collect()


def test_iou_of_two_squares(spark):
    a = frame(spark, [(r, c, 1) for r in range(4) for c in range(4)])
    b = frame(spark, [(r, c, 1) for r in range(2, 6) for c in range(2, 6)])
    assert tuple(cells.iou(a, b).first()) == (4, 28, round(4 / 28, 6))
    assert cells.iou(a.limit(0), a.limit(0)).first().iou is None


def test_mosaic_precedence(spark):
    p = frame(spark, [(0, 0, 0, 5), (1, 0, 0, 0), (2, 0, 0, 7), (1, 1, 1, 0)], "piece int, r int, c int, v int")
    assert [tuple(r) for r in cells.mosaic(p, True).collect()] == [(0, 0, 7)] and [tuple(r) for r in cells.mosaic(p, False).collect()] == [(0, 0, 5)]


def test_drape_never_invents_footprint(spark):
    foot = frame(spark, [(r, c, 1) for r in range(12) for c in range(12)])
    years = frame(spark, [(r, c, 1990) for r in range(4) for c in range(2)], "r int, c int, year int")
    out = cells.drape(foot, years, 3)
    assert out.count() == 144 and out.where("v = 91").count() == 72 and out.where("v = 255").count() == 72
    share = layers.dated_share(out).first()
    assert share.dated_share_pct == 50.0 and math.isnan(layers.dated_share(out.limit(0)).first().dated_share_pct)  # a share of nothing


def test_zone_series_counts_undated_never(spark):
    c = frame(spark, [(0, 0, 86), (0, 1, 106), (0, 2, 255)])
    s = {r.key: r.total_km2 for r in series.cumulative(series.histogram(c)).collect()}
    assert min(s) == 1985 and max(s) == 2005 and s[2005] == pytest.approx(2 * s[1985], rel=1e-3) and s[1990] == s[1985]
    assert series.cumulative(series.histogram(frame(spark, [(0, 0, 255)]))).count() == 0


def test_fill_carries_forward(spark):
    s = frame(spark, [("a", 2024, 1.0), ("b", 2024, 10.0), ("b", 2025, 11.0), ("c", 2024, 100.0), ("c", 2026, 111.0)], "grp string, key int, total double")
    out = {r.key: r.t for r in series.filled(s).groupBy("key").agg(F.sum("total").alias("t")).collect()}
    assert out == {2024: 111.0, 2025: 112.0, 2026: 123.0}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 20)), min_size=3, max_size=7, unique=True))
def test_spans_are_the_even_odd_rule(spark, ring):
    v = spark.createDataFrame([("z", 0, k, float(x), float(y)) for k, (x, y) in enumerate(ring)], "zone string, ring int, seq int, x double, y double")
    got = {(r.r, r.c) for r in spans.rasterise(v).collect()}
    want = set()
    for r in range(21):
        for c in range(21):
            py, px, n = r + 0.5, c + 0.5, 0
            for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
                if min(y1, y2) <= py < max(y1, y2) and x1 + (py - y1) * (x2 - x1) / (y2 - y1) <= px:
                    n += 1
            if n % 2:
                want.add((r, c))
    assert got == want


def test_unknown_kind_raises(spark):
    with pytest.raises(ValueError):
        spans.zonal(frame(spark, []), None, "median")


def test_patches_and_compact(spark):
    block = [(r, c, 1) for r in range(3) for c in range(3)]
    df = frame(spark, [*block, (3, 3, 1), (8, 8, 1)])
    assert sorted(r.size for r in components.patches(df).collect()) == [1, 10]
    assert sorted(r.size for r in components.patches(df, diagonal=False).collect()) == [1, 1, 9]
    assert components.compact_only(df.select("r", "c")).count() == 9 and components.compact_only(df.limit(0).select("r", "c")).count() == 0


def flood_fill(cells):
    """Sizes of the 8-connected patches of a set of cells."""
    left, sizes = set(cells), []
    while left:
        todo, size = [left.pop()], 0
        while todo:
            r, c = todo.pop()
            size += 1
            near = {(r + i, c + j) for i in (-1, 0, 1) for j in (-1, 0, 1)} & left
            left -= near
            todo.extend(near)
        sizes.append(size)
    return sizes


def test_patches_of_the_whole_mask(spark):
    sizes = flood_fill((r.r, r.c) for r in derived.cells(spark, SF).select("r", "c").collect())
    assert {r.size: r.patches for r in all_queries()["patch_sizes"](spark, SF).collect()} == Counter(sizes)
    small = round(100 * sum(n <= 4 for n in sizes) / len(sizes), 4)
    got = all_queries()["patch_summary"](spark, SF).first()
    second, large = sorted(sizes)[-2], round(100 * sum(n for n in sizes if n >= 100) / sum(sizes), 4)
    assert tuple(got) == (len(sizes), max(sizes), second, median(sizes), small, large)


def test_nearest_of_all_built_cells(spark):
    built = [(r.r, r.c) for r in derived.cells(spark, SF).select("r", "c").collect()]
    want = {}
    for p in q_cells.points(spark, SF).collect():
        near = [math.hypot((r - p.r) * 9.93, (c - p.c) * 8.82) for r, c in built if abs(r - p.r) <= 20 and abs(c - p.c) <= 20]
        want[p.id] = round(min(near), 6) if near else None
    got = {r.id: r.metres for r in all_queries()["nearest_built"](spark, SF).collect()}
    assert got.keys() == want.keys() and all(got[k] == (None if m is None else pytest.approx(m, abs=2e-6)) for k, m in want.items())


def test_trend_has_every_band(spark, con):
    vectors = [r[0] for r in con.sql("select embedding from embeddings").fetchall()]
    want = {k: sum(v[k] for v in vectors) / 1e6 for k in range(max(map(len, vectors)))}
    assert {r.band: r.surface_km2 for r in all_queries()["layer_trend"](spark, SF).collect()} == pytest.approx(want, abs=1e-6)


def test_islands_are_all_placed(spark):
    want = sorted((r.x0, r.id) for r in q_cells.boxes(spark, SF).collect())
    got = all_queries()["islands_by_longitude"](spark, SF).collect()
    assert [(r.x0, r.id, r.place) for r in got] == [(x, i, k) for k, (x, i) in enumerate(want, 1)]
    many = spark.range(500).select((F.col("id") + 1).alias("s_suppkey"))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(q_cells.D, "table", lambda *_: many)
        want = sorted((r.x0, r.id) for r in q_cells.boxes(spark, SF).collect())
        got = q_cells.islands_by_longitude(spark, SF).collect()
    assert [(r.x0, r.id, r.place) for r in got] == [(x, i, k) for k, (x, i) in enumerate(want, 1)]


def test_skipped_is_not_passed(spark):
    df = spark.createDataFrame([("x", "a", 10.0, 10.0), ("x", "b", 10.0, None), ("x", "c", 90.0, 10.0)], "layer string, island string, built_km2 double, reference_km2 double")
    g = gates.totals(df, 0.5, 2.0)
    assert {r.island: (r.passed, r.skipped) for r in g.collect()} == {"a": (True, False), "b": (None, True), "c": (False, False)}
    assert tuple(gates.summary(g).first()) == ("totals", 1, 2, 1)
    loss = spark.createDataFrame([("x", "a", 0.0, 1.0, 4), ("x", "b", 100.0, 9.0, 4), ("x", "p", 100.0, 9.0, 4)], "layer string, island string, built_km2 double, lost_km2 double, years int")
    assert {r.island: r.passed for r in gates.loss_rate(loss, excused=("p",)).collect()} == {"a": None, "b": False, "p": True}
    ctl = spark.createDataFrame([("x", "a", False, None, None), ("x", "b", True, None, 0.0), ("x", "c", True, 0.0, 5.0)], "layer string, island string, has_control boolean, built_km2 double, control_km2 double")
    assert {r.island: r.passed for r in gates.negative_control(ctl).collect()} == {"a": None, "b": False, "c": True}


def test_draw_sizes_and_uniqueness(spark):
    pool = spark.range(5000).select(F.when(F.col("id") % 10 == 0, "a").otherwise("b").alias("stratum"), "id")
    got = assess.draw(pool, spark.createDataFrame([("a", 40), ("b", 70)], "stratum string, draw int"), "id").collect()
    assert sum(r.stratum == "a" for r in got) == 40 and len({r.id for r in got}) == 110


def test_store_windows_and_upserts(spark, tmp_path):
    df = frame(spark, [("l", "i", r, c, 1) for r in range(0, 600, 50) for c in range(0, 600, 50)], "layer string, island string, r int, c int, v int")
    store.write_cells(df, str(tmp_path / "cells"))
    w = store.read_window(spark, str(tmp_path / "cells"), "l", "i", (100, 300), (0, 99))
    assert w.count() == 10
    old, new = frame(spark, [(1, 1, 1), (2, 2, 2)]), frame(spark, [(2, 2, 9)])
    assert sorted(r.v for r in store.upsert(old, new, ["r"]).collect()) == [1, 9]
    files = store.files_with_digest(spark, str(tmp_path / "cells"))
    assert files.where("length(sha256) = 64").count() == files.count() > 0


def test_feeds(spark):
    t = spark.createDataFrame([('<link href="a/38001.zip"/><link href="b/38001.zip"/><link href="c/35002.zip"/><link href="x"/>',)], "text string")
    assert [tuple(r) for r in feeds.feed_links(t).collect()] == [("35002", "c/35002.zip"), ("38001", "a/38001.zip")]
    s = spark.createDataFrame([('<ColorMapEntry quantity="254" label="254: outside"/><sld:ColorMapEntry label="10%" color="x" quantity="10"/>',)], "text string")
    got = feeds.legend_entries(s)
    assert {(r.quantity, r.label) for r in got.collect()} == {(254, "outside"), (10, "10%")} and feeds.special_codes(got).count() == 1
    assert one(spark, feeds.year_of(F.lit("--01-01")), feeds.year_of(F.lit("1850-01-01")), feeds.year_of(F.lit("2001"))) == (0, 1900, 2001)
    with pytest.raises(Exception, match="no survey year"):
        t.select(feeds.survey_year(F.lit("nothing"))).collect()


def test_figures_of_prose(spark):
    text = "Of it, 98 times in 100, 463 ± 83 km², 26–52 %, 12 ha and 30-metre cells; 1,027 km2 by 2015, section 4, epoch 11.\n12. Listed\n[[[cog x 77 [[[end]]] <!-- 88 --> M3 EPSG:4326 https://x.y/9 v1.2.3"
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(Z.figures(F.col("text"))).first()[0] == ["98 times in 100", "463 ± 83 km²", "26–52 %", "12 ha", "30 m", "1,027 km2"]
    counts = {c: n for c, n in df.select(*Z.exemptions(F.col("text"))).first().asDict().items() if n}
    assert counts == {"generated": 1, "url": 1, "version": 1, "comment": 1, "reference": 3, "year": 1, "list_marker": 1}
    html = spark.createDataFrame([("<h1>1. x</h1><td>5 m</td><sup>3</sup>",)], "text string")
    assert html.select(Z.figures(F.col("text"), html=True)).first()[0] == ["1.", "5 m"]


CASES = [
    ("as section 9 tells, epoch 3 and EPSG:32628 under SHA-1", []), ("M7 and km2 and doi:10.1/ab.12 or rgb(1,2,3) at 45deg", []), ("CC BY-SA 4.0, #12, Directive 2007/2/EC, v2.0.1", []),
    ("a 20-metre cell is 20 metres wide", ["20 m"]), ("right 3 to 4 times in 5", ["3 to 4 times in 5"]), ("71 ± 9 km² or 12–19 %", ["71 ± 9 km²", "12–19 %"]), ("1990-2004, 2011 and 2020-01-31.", []),
    ("71\u00a0±\u00a09\u00a0km² and 26\u202f%", ["71 ± 9 km²", "26 %"]), ("1. first\n## 2. second\n   3. third", []), ("1. - 5 items", []), ("it rose to 12.\nthen 4 –\n2. next", ["12.", "4 – 2."]),
    ("<!-- figures: a_1.csv @ 2024-02-03 --> 12 km²", ["12 km²"]), ("5\ue0006", ["5", "6"]), ("", []), (None, None)]


def test_figures_by_case(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(CASES)], "k int, text string")
    got = [r.f for r in df.select("k", Z.figures(F.col("text")).alias("f")).orderBy("k").collect()]
    assert got == [f for _, f in CASES]
    marks = df.where("text like '%next'").select(*Z.exemptions(F.col("text"))).first()
    assert marks.list_marker == 0  # the marker's number belongs to a range that begins before it


def plain_tokens(body, html=False):
    """Tokens of scrubbed text with what they are, by Python's engine on the definition: a marker exempts the token that begins at it."""
    spots = set() if html else {m.start(2) for m in re.finditer(Z.LIST_MARKER, body)}
    for m in re.finditer(Z.FIGURE, body):
        token = re.sub(r"\s?-?metres?$", " m", re.sub(r"\s+", " ", m[0].strip()))
        yield token, bool(re.match(Z.YEAR, token)), m.start() in spots


def test_figures_match_a_plain_scan(spark, con):
    def plain(text):
        for r in Z.rules():
            text = re.sub(r.pattern, r.put, text)
        return sorted({t for t, year, mark in plain_tokens(text) if not year and not mark})

    want = {d: plain(t) for d, t in con.sql("select doc_id, coalesce(text, '') from documents").fetchall()}
    assert {r.doc_id: r.figures for r in all_queries()["figure_tokens"](spark, SF).collect()} == want and sum(map(len, want.values())) > 0


def test_quantity_words_match_a_plain_scan(spark, con):
    """Every word is looked at in its own paragraph by a plain scan; generated output counts as text."""
    tens = [t + s + o for t in Z.TENS for o in ["", *Z.ONES] for s in ("", "-")]
    word = re.compile(rf"\b(?:{Z.FRACTIONS}|(?:{'|'.join(sorted({*tens, *Z.ONES, *Z.TEENS, *Z.SCALES}, key=len, reverse=True))})fold)\b", re.I)

    def plain(text, html):
        out, body = [], re.sub(Z.GENERATED, lambda m: re.sub(r"(?s)^\[\[\[cog.*?\]\]\](?:-->)?|(?:<!--)?\s*\[\[\[end\]\]\]$", "", m[0]), text)
        for k, par in enumerate((re.sub(Z.TAG, " ", body) if html else body).split("\n\n")):
            par = re.sub(Z.MENTION, lambda m: " " * len(m[0]), par)
            idioms = [m.span() for m in re.finditer(Z.IDIOMS, par)]
            for m in word.finditer(par):
                near = par[max(0, m.start() - 60) : m.end() + 60]
                if not any(a < m.end() and m.start() < b for a, b in idioms) and all(year for _, year, _ in plain_tokens(near, True)):
                    out.append((k, m.start(), m[0].lower()))
        return out

    texts = ["A third of it, <!-- [[[cog f() ]]] -->12 km²<!-- [[[end]]] --> lies here.", "A third party, a third surface; as a third it is a third.", "Seventy-twofold in 1985, ninetyfold and manifold, a ten-fold, twenty-fold \"a fifth\"",
             "two in five\n\n12 % far from two-thirds", "two thirds " + "x" * 52 + " 12", "two thirds " + "x" * 40 + " 12", "a quarter " + "y" * 46 + " 1985", "", None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id int, text string")
    got = {(r.doc_id, r.paragraph, r.start, r.word) for r in Z.bare_quantities(df).collect()}
    assert got == {(k, *x) for k, t in enumerate(texts) for x in plain(t or "", False)}
    assert not any(r[0] == 0 for r in got) and {r[3] for r in got if r[0] == 2} == {"seventy-twofold", "ninetyfold", "ten-fold", "twenty-fold"}
    pages = con.sql("select page_id, html from pages").fetchall()
    assert {tuple(r) for r in all_queries()["bare_quantity_words"](spark, SF).collect()} == {(p, *x) for p, t in pages for x in plain(t or "", True)}


def test_forward_phrases_match_a_plain_scan(spark, con):
    """A plain scan that keeps the open headings of each level."""
    def plain(text):
        out, open_, title, code = [], {}, "(preamble)", False
        for n, line in enumerate((text or "").splitlines(), 1):
            if line.strip().startswith("```"):
                code = not code
                continue
            if code:
                continue
            if m := re.match(r"(#{1,4})\s+(.*)$", line):
                open_ = {k: v for k, v in open_.items() if k < len(m[1])} | {len(m[1]): bool(re.search(Z.SETTLED, line))}
                title = re.sub(r"[*`]", "", m[2])[:58]
            if tells := [name for name, p in Z.TELLS.items() if re.search(p, line, re.I)]:
                out.append((n, title, any(open_.values()), tells))
        return out

    texts = ["TODO\n## **Work** DONE\n### Next\nThis will be `1 %`, not yet.\n```\nTBD\n```\n# Open\nTODO", "## A ✅\n#### B\n### C\npending\r\n# D\n## E\nblocked\n# F CLOSED\nTBD\u2028is next", "#### x DONE\n## y\nnot yet\n##### z\nTODO", "no tells", "", None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id int, text string")
    assert sorted(tuple(r) for r in Z.forward_phrases(df).collect()) == sorted((k, *x) for k, t in enumerate(texts) for x in plain(t))
    docs = con.sql("select doc_id, coalesce(text, '') from documents").fetchall()
    head = lambda d: "#" * (d % 5 % 3 + 1) + (" Work DONE" if d % 5 == 0 else " Plan")
    want = sorted((d, *x) for d, t in docs for x in plain(f"{head(d)}\n{t}\n#### Next\nThis is pending."))
    assert sorted(tuple(r) for r in all_queries()["forward_phrases"](spark, SF).collect()) == want and any(r[3] for r in want)


def test_closure_to_its_fixed_point(spark):
    chain = [(f"n{k}", f"n{k + 1}") for k in range(100)] + [("n7", "n3"), ("n99", "n50"), ("x", "y"), ("n4", None), (None, "z")]
    links = spark.createDataFrame(chain, "path string, target string")
    assert {r.path for r in closure.import_closure(links, "n0").collect()} == {f"n{k}" for k in range(101)}
    assert [r.path for r in closure.import_closure(links, "alone").collect()] == ["alone"]
    assert {r.path for r in closure.reachable(links, spark.createDataFrame([("x",), ("n98",), ("n98",), (None,)], "path string"), 1).collect()} == {"x", "y", *(f"n{k}" for k in range(50, 101))}
    assert closure.reachable(links.limit(0), links.limit(0).select("path")).collect() == []


def test_text_rules(spark):
    text = "Text.\n\n```\n99 km²\n```\n## Work DONE\nThis will be `1 %`, not yet."
    r = spark.createDataFrame([(text,)], "text string").select(X.masked_code("text").alias("m")).first()
    assert "99" not in r.m and "1 %" not in r.m and len(r.m) == len(text)
    names = lambda *n: F.array(*[F.lit(x) for x in n])
    assert one(spark, X.joined_names(names("a", "b", "c")), X.joined_names(names(*"abcd")), X.joined_names(names(*"abcdefgh"), F.lit(8)), X.joined_names(F.array())) == (
        "a, b and c", "4 islands", "all eight islands", "no island in view")
    assert one(spark, X.km2_text(F.lit(3.14159)), X.km2_text(F.lit(9999.5), 1), X.km2_text(F.lit(12345.678))) == ("3.14", "9999.5", "12,345.68")

    def hashed(text):
        h = 0
        for k in range(0, len(b := text.encode("utf-16-be")), 2):
            h = (31 * h + b[k] * 256 + b[k + 1]) & 0xFFFFFFFF
        out = ""
        while h or not out:
            h, d = divmod(h, 36)
            out = "0123456789abcdefghijklmnopqrstuvwxyz"[d] + out
        return out

    samples = ["", "a", "p1,p2,p3", "Ünïcode 🎉 long enough to wrap", "zzzzzzzzzzzz"]
    got = [r[0] for r in spark.createDataFrame([(k, x) for k, x in enumerate(samples)], "k int, t string").orderBy("k").select(X.key31(F.col("t"))).collect()]
    assert got == [hashed(x) for x in samples]
    assert one(spark, X.normal_path(F.lit("a/./b/../c")), X.normal_path(F.lit("../a"))) == ("a/c", "../a")
    with pytest.raises(Exception, match="unfilled"):
        spark.range(1).select(X.filled_template("{a} {b}", {"a": F.lit("x")})).collect()


def test_claims_and_verdicts(spark):
    claims = [0, 116, 117, 125, 126, 255]
    assert [one(spark, E.stratum(F.lit(v)))[0] for v in claims] == ["not_built", "built_before_2015", "new_2015_2024", "new_2015_2024", None, "undated"]
    kinds = {1975: "observed", 1990: "observed", 2000: "observed", 2015: "near-observed", 2020: "near-observed", 2025: "projected", 2030: "projected", 1980: "interpolated", 2010: "interpolated"}
    assert {e: one(spark, E.observation_kind(F.lit(e)))[0] for e in kinds} == kinds
    v = lambda share, role, year: E.control_verdict(F.lit(share), F.lit(role), F.lit(year))
    assert one(spark, v(0.5, "negative control", 2020), v(3.0, "negative control", 2020), v(7.0, "negative control", 2020), v(7.0, "loss", 2020), v(0.5, "loss", 2022), v(7.0, "loss", 2023)) == (
        "PASS", "SUSPECT", "FAIL", "BASELINE", "PASS", "FAIL")
    assert one(spark, *[E.is_published(F.lit(n)) for n in ("tenerife.tif", "archipelago.tif", "x.confidence.tif", "catalog.json")]) == (False, True, True, True)


def test_accuracy_keeps_lost_classes(spark):
    points = spark.createDataFrame([("a", "a")] * 8 + [("a", "b")] * 2 + [("b", "b")] * 9 + [("b", "lost")] * 1 + [("b", None)], "map string, ref string")
    got = {r["class"]: r for r in assess.accuracy(points, spark.createDataFrame([("a", 10.0), ("b", 90.0)], "map string, km2 double")).collect()}
    assert set(got) == {"a", "b", "lost"} and got["lost"].mapped_km2 == 0 and got["lost"].users is None and got["lost"].adjusted_km2 == 9
    assert got["a"].users == 0.8 and got["a"].producers == 1.0 and got["b"].adjusted_km2 == 83 and got["b"].producers == round(81 / 83, 6)
    term = 90**2 * (1 - 81 / 83) ** 2 * 0.9 * 0.1 / 9 + (81 / 83) ** 2 * 10**2 * 0.2 * 0.8 / 9
    assert got["b"].producers_ci == pytest.approx(1.96 * math.sqrt(term) / 83, abs=1e-6) and got["b"].users_ci == pytest.approx(1.96 * math.sqrt(0.09 / 9), abs=1e-6)
