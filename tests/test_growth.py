"""Work that grows with its input: strata, boxes, rings and rules against plain computations."""

import random

import duckdb
from pyspark.sql import functions as F

from terrafold.functions import figures as Z
from terrafold.operators import boxes, naming
from terrafold.plans.registry import all_oracles, all_queries
from terrafold.sources import gml

SF = "/root/testdata/sf0.001"


def test_small_strata_get_the_floor(spark, tmp_path):
    """One new cell among 200 old ones: a share of one point, raised to the floor as in the SQL."""
    table = tmp_path / "lineitem.parquet"
    duckdb.sql(f"COPY (SELECT k AS l_orderkey, 1 AS l_partkey, 1 AS l_suppkey, 1 AS l_linenumber, 1.0 AS l_quantity, 'N' AS l_returnflag, make_date(CASE WHEN k = 7 THEN 1997 ELSE 1993 END, 5, 1) AS l_shipdate FROM range(200) t(k)) TO '{table}'")
    got = sorted(tuple(r) for r in all_queries()["sample_design"](spark, str(tmp_path)).collect())
    lineitem = duckdb.read_parquet(str(table))  # noqa: F841
    assert got == sorted(duckdb.sql(all_oracles()["sample_design"]).fetchall())
    assert [(r[0], r[3], r[4]) for r in got if r[0] == "new"] == [("new", 100, 125)]


def test_overlaps_of_crowded_tiles_are_shared_out(spark, tmp_path):
    """All boxes lie in 16 tiles; no partition makes most of the pairs."""
    table = tmp_path / "supplier.parquet"
    duckdb.sql(f"COPY (SELECT k AS s_suppkey FROM range(3000) t(k)) TO '{table}'")
    df = all_queries()["boxes_overlap"](spark, str(tmp_path))
    supplier = duckdb.read_parquet(str(table))  # noqa: F841
    n, digest = duckdb.sql(f"SELECT count(*), sum(a * 31 + b * 7 + strict::int)::bigint FROM ({all_oracles()['boxes_overlap']})").fetchall()[0]
    parts = df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.sum(F.col("a") * 31 + F.col("b") * 7 + F.col("strict").cast("int")).alias("digest")).collect()
    assert (sum(r.n for r in parts), sum(r.digest for r in parts)) == (n, digest) and max(r.n for r in parts) < 0.6 * n


def test_overlaps_equal_all_pairs_whatever_the_blocks(spark):
    rng = random.Random(5)
    corner = [(k, rng.randint(-20, 20), rng.randint(-8, 8)) for k in range(90)]
    rows = [(k, x, x + rng.randint(0, 25), y, y + rng.randint(0, 9)) for k, x, y in corner]
    want = {(a[0], b[0], a[1] < b[2] and b[1] < a[2] and a[3] < b[4] and b[3] < a[4]) for a in rows for b in rows if a[0] < b[0] and a[1] <= b[2] and b[1] <= a[2] and a[3] <= b[4] and b[3] <= a[4]}
    df = spark.createDataFrame(rows, "id long, x0 long, x1 long, y0 long, y1 long")
    for block in (7, 1000):
        got = [tuple(r) for r in boxes.overlapping(df, 10, block).collect()]
        assert len(got) == len(want) and {*got} == want


def test_rings_are_closed_by_element_after_one_parse(spark, tmp_path):
    """Two elements share an id; neither's last vertex is looked for in the other, nothing is shuffled, and a broken one has no rings."""
    one = "<bu-ext2d:Building gml:id='x'><g><gml:Surface><gml:patches><gml:PolygonPatch><gml:exterior><gml:LinearRing><gml:posList>{}</gml:posList></gml:LinearRing></gml:exterior></gml:PolygonPatch></gml:patches></gml:Surface></g>{}</bu-ext2d:Building>"
    one = one.replace("<g>", "<bu-core2d:geometry>").replace("</g>", "</bu-core2d:geometry>")
    (tmp_path / "a.gml").write_text(one.format("0 0 1 0 1 1 0 0", "") + one.format("5 5 6 5 6 6 5 6 5 5", "") + one.format("7 7 8 8", "<open>") + one.format("3 4", ""))
    found = gml.building_vertices(gml.elements(spark, str(tmp_path), gml.BUILDING, gml.BUILDING_SCHEMA))
    assert sorted(tuple(r)[1:] for r in found.collect()) == [(0, 0, 0, 0), (0, 0, 3, 4), (0, 0, 5, 5), (0, 1, 1, 0), (0, 1, 6, 5), (0, 2, 1, 1), (0, 2, 6, 6), (0, 3, 5, 6)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_xml(") == 1 and "Exchange" not in plan


def test_each_rule_runs_over_a_surface_once(spark):
    """The counts equal those of nested columns, and the plan holds each rule's pattern twice at most: counted and taken out."""
    texts = ["<p>1.5 km² in 2019, v1.2.3 and 12 ha</p> &#160; rgba(1,2,3,0.5) CC BY 4.0 #12 doi:10.1/x https://a.b/1 <!-- 3 -->", None, "", "2. one\n3. two 98 times in 100 Section 4", "a<sup>2</sup> [[[cog x 7 [[[end]]] 5 m", "2020 none"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    for html in (True, False):
        text = F.coalesce("text", F.lit(""))
        want = df.select("k", F.size(Z.figures(text, html)).alias("figures"), *Z.exemptions(text, html))
        got = naming.surface_figures(df, "k", html)
        assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert 0 < plan.count(Z.STRUCTURE["doi"]) <= 2 and 0 < plan.count(Z.STRUCTURE["comment"]) <= 2
    for name in ("surface_figures", "exempt_counts"):
        plan = all_queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert 0 < plan.count(Z.STRUCTURE["doi"]) <= 2
