"""Names in texts, figures by surface, coincidences of figures and acceptance by perturbation, against plain scans."""

import re
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from terrafold.functions import figures as Z
from terrafold.operators import naming
from terrafold.plans.registry import all_queries

SF = "/root/testdata/sf0.001"


def test_names_are_substrings_wherever_they_stand(spark):
    texts = {"a": "read('data/x_1.csv') and xdata.json", "b": "x_1.csvy", "c": "", "d": None, "e": "data" * 50, "f": "ümläut.csv"}
    names = ["x_1.csv", "data.json", "data", "ümläut", "nowhere.csv", "data", None, "datadata"]
    df = spark.createDataFrame(list(texts.items()), "path string, text string")
    got = naming.naming(df, spark.createDataFrame([(n,) for n in names], "name string"))
    assert sorted(map(tuple, got.collect())) == sorted((p, n) for p, t in texts.items() for n in {*names} - {None} if n in (t or ""))
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString() and "Cartesian" not in got._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="too short a name"):
        naming.naming(df, spark.createDataFrame([("abc",)], "name string")).collect()
    assert naming.naming(df.limit(0), spark.createDataFrame([("abcd",)], "name string")).collect() == []


def test_runs_of_a_text_are_found_in_proportion_to_its_length(spark):
    """A long text takes no longer than as many characters in short ones, but for a fixed time; with a substring per place it took minutes."""
    short = [("a\U0001f600b\nc\U0001f600b\n",), ("\U0001f600b\nc",), ("abc",), ("",), (None,)]
    grams = [r.g for r in spark.createDataFrame(short, "t string").select(naming._grams("t").alias("g")).collect()]
    assert [len({*g}) for g in grams] == [5, 1, 0, 0, 0] and {*grams[1]} < {*grams[0]}
    pieces = [(str(k), "".join(f"{k * 100 + i:x} " for i in range(100))) for k in range(1000)]
    names = spark.createDataFrame([("1869f ",), ("fff ",), ("nowhere",)], "name string")

    def took(rows):
        began = time.monotonic()
        found = naming.naming(spark.createDataFrame(rows, "path string, text string").repartition(1), names).collect()
        return time.monotonic() - began, {tuple(r) for r in found}

    took(pieces[:1])
    (short, parts), (long, whole) = took(pieces), took([("all", "".join(t for _, t in pieces))])
    assert whole == {("all", n) for _, n in parts} and {n for _, n in parts} == {"1869f ", "fff "}
    assert long < 3 * short + 20


def test_figures_by_surface_match_a_plain_scan(spark):
    def plain(text):
        counts = {}
        for r in Z.rules(True):
            hits = [m[0] for m in re.finditer(r.pattern, text)]
            counts[r.name] = sum(bool(re.search(r"\d", h)) or not r.digits for h in hits)
            text = re.sub(r.pattern, r.put, text)
        tokens = [re.sub(r"\s?-?metres?$", " m", re.sub(r"\s+", " ", m[0].strip())) for m in re.finditer(Z.FIGURE, text)]
        years = [t for t in tokens if re.match(Z.YEAR, t)]
        return {"figures": len({*tokens} - {*years}), "year": len(years), "list_marker": 0} | {k: n for k, n in counts.items() if k != "tag"}

    pages = duckdb.sql(f"select page_id, html from '{SF}/pages.parquet'").fetchall()
    got = {r["page_id"]: {k: v for k, v in r.asDict().items() if k != "page_id"} for r in all_queries()["surface_figures"](spark, SF).collect()}
    assert got == {p: plain(t or "") for p, t in pages} and any(r["figures"] for r in got.values())


def test_coincidences_equal_the_pairwise_test(spark):
    """Ties at a half included: 0.125, 2.5 and 1234.5 round to even, 2.675 is below its half."""
    values = [("a", 0.125, "km2"), ("b", 2.5, "pct"), ("c", 1234.5, "mib"), ("d", 2.675, "x"), ("e", 10000.0, "km2"), ("f", -3.45, "pct"), ("g", 0.0, "km2"), ("h", 7.0, "other")]
    keys = ["0.12 km²", "0.13 km²", "0.1", "2", "3 %", "2.5 %", "2.50 ×", "1,234", "1,235 MiB", "1,234.5MiB", "2.67 ×", "2.68", "10,000.00 km²", "-3.5 %", "-3.4 %", "-3", "0", "7 km²", "7", None]
    want = set()
    for k in [k for k in keys if k]:
        m = re.fullmatch(r"(.+?)\s?(km²|%|×|MiB)?", k)
        want |= {(k, n) for n, v, u in values if m[1] in {f"{v:,.0f}", f"{v:,.1f}", f"{v:,.2f}"} and m[2] in (None, naming.UNITS.get(u))}
    got = naming.coincidences(spark.createDataFrame([(k,) for k in keys], "figure string"), spark.createDataFrame(values, "name string, value double, unit string"))
    assert {tuple(r) for r in got.collect()} == want and len(want) > 10


def test_figures_that_do_not_move_are_named(spark):
    df = spark.createDataFrame([(k, float(k), None) for k in range(10)], "k int, v double, w int")
    figures = {"sum": F.sum("v"), "n": F.count("*"), "fixed": F.max(F.lit(3)), "empty": F.sum("w"), "filled": F.count("w")}
    got = {r.figure: (r.before, r.after, r.moved) for r in naming.perturbed(df, figures, {"v": F.col("v") * 2, "w": F.lit(1)}).collect()}
    assert got == {"sum": ("45.0", "90.0", True), "n": ("10", "10", False), "fixed": ("3", "3", False), "empty": (None, "10", True), "filled": ("0", "10", True)}
