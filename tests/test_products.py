"""Sources, projections, sinks and reports that SQL does not check, against fixtures by hand."""

import json
import math

import pytest
from pyspark.sql import functions as F

from terrafold.functions import figures as Z
from terrafold.functions import grid as G
from terrafold.functions import text as X
from terrafold.operators import analyses, cells, components, gates
from terrafold.plans import q_products
from terrafold.plans.registry import all_queries
from terrafold.sources import derived, products, store

SF = "/root/testdata/sf0.001"


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_equal_area_projection_at_a_published_point(spark):
    x, y = one(spark, *G.laea(F.lit(5.0), F.lit(50.0)))
    assert abs(x - 3962799.45) < 0.02 and abs(y - 2999718.85) < 0.02
    assert one(spark, *G.laea(F.lit(10.0), F.lit(52.0))) == pytest.approx((4321000, 3210000))
    w = {r.id: r for r in all_queries()["s10_projected_windows"](spark, SF).collect()}
    corners = {r.id: r for r in all_queries()["m19_equal_area_points"](spark, SF).collect()}
    assert w.keys() == corners.keys() and all(w[k].x_min <= corners[k].x <= w[k].x_max and w[k].y_min <= corners[k].y <= w[k].y_max for k in w)


def test_mercator_cells_and_grids(spark):
    x, y = G.mercator(F.lit(-15.4999), F.lit(28.0999))
    assert one(spark, *G.mercator_cell(x, y)) == one(spark, G.row_of(F.lit(28.0999)), G.col_of(F.lit(-15.4999)))
    g = G.grid_for(F.lit(-15.8), F.lit(27.7), F.lit(-15.3), F.lit(28.2))
    west, south, east, north = one(spark, *G.grid_box(g))
    assert west <= -15.8 < west + G.PIXEL and east >= -15.3 > east - G.PIXEL and south <= 27.7 < south + G.PIXEL and north >= 28.2 > north - G.PIXEL
    box = one(spark, *G.chip_box(F.lit(0.0), F.lit(60.0), 222264))
    assert box[0] == pytest.approx(59) and box[2] == pytest.approx(61) and box[3] - box[1] == pytest.approx(222264 / 111320 / 0.5)


def test_islands_must_share_a_grid(spark):
    kind = "island string, a double, c double, e double, f double, height int, width int"
    noise = spark.createDataFrame([("a", 1.0, 0.0, -1.0, 50.0, 10, 10), ("b", 1.0, 5.00001, -1.0, 45.0, 10, 10)], kind)
    assert {r.island: (r.row, r.col, r.height, r.width) for r in cells.shared_grid(noise).collect()} == {"a": (0, 0, 15, 15), "b": (5, 5, 15, 15)}
    half = spark.createDataFrame([("a", 1.0, 0.0, -1.0, 50.0, 10, 10), ("b", 1.0, 5.5, -1.0, 45.0, 10, 10)], kind)
    with pytest.raises(Exception, match="not on the shared grid"):
        cells.shared_grid(half).collect()
    other = spark.createDataFrame([("a", 1.0, 0.0, -1.0, 50.0, 10, 10), ("b", 1.1, 5.0, -1.0, 45.0, 10, 10)], kind)
    with pytest.raises(Exception, match="pixel size"):
        cells.shared_grid(other).collect()
    pieces = spark.createDataFrame([("a", 1, 0, 0, 5), ("b", 2, 0, 0, 7), ("a", 1, 5, 5, 3)], "island string, piece int, r int, c int, v int")
    assert {(r.r, r.c): r.v for r in cells.placed_mosaic(pieces, cells.shared_grid(noise)).collect()} == {(0, 0): 5, (5, 5): 7}
    with pytest.raises(ValueError, match="not double"):
        cells.placed_mosaic(pieces, cells.shared_grid(noise), "double")


def test_products_and_zones_refuse_what_they_do_not_know(spark):
    boxes = q_products.boxes(spark, SF)
    with pytest.raises(ValueError, match="not published"):
        products.epoch_tiles(boxes, 1999)
    with pytest.raises(ValueError, match="unknown product"):
        products.without_nodata(boxes, "nothing")
    with pytest.raises(ValueError, match="no status product"):
        products.built_mask(boxes, "imd_2024")
    with pytest.raises(ValueError, match="no field"):
        products.greenhouses(boxes)
    zones = spark.createDataFrame([("a",), ("b",)], "name string")
    assert products.complete_zones(zones, ["a"]).count() == 2
    with pytest.raises(ValueError, match="missing"):
        products.complete_zones(zones, ["a", "c"])
    with pytest.raises(ValueError, match="no zonal sum"):
        products.zonal_kind("classes")
    assert products.schema_problems(zones, {"name": "string", "km2": "double"}) == ["km2: missing, not double"]
    v = spark.createDataFrame([(0, 0, 240), (0, 1, 1)], "r int, c int, v int")
    assert products.without_nodata(v, "ibu_2018").count() == 1 and products.built_mask(v, "ibu_2018").count() == 1


def test_tables_are_read_under_a_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text("island,km2\nx,1.5\ny,2\n")
    (tmp_path / "b.json").write_text(json.dumps([{"id": "p1", "label": {"2015": "built"}}, {"id": "p2"}]))
    assert [tuple(r) for r in products.read_table(spark, str(tmp_path / "a.csv"), "island string, km2 double").collect()] == [("x", 1.5), ("y", 2.0)]
    got = products.read_table(spark, str(tmp_path / "b.json"), "id string, label map<string, string>").collect()
    assert [(r.id, r.label) for r in got] == [("p1", {"2015": "built"}), ("p2", None)]
    with pytest.raises(Exception):  # noqa: B017
        products.read_table(spark, str(tmp_path / "a.csv"), "island string, area double").collect()
    spark.createDataFrame([(0, 0, 1900, "mincoy", 0), (0, 1, 5, "bufa", 2000), (0, 1, 6, "bufa", 2001)], "r int, c int, v int, name string, year int").write.partitionBy("name", "year").parquet(str(tmp_path / "cells"))
    assert [tuple(r) for r in products.cells_of_year(spark, str(tmp_path / "cells"), "bufa", 2001).collect()] == [(0, 1, 6)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "island string, km2 double")
    store.write_json(df, str(tmp_path / "j"))
    store.write_csv(df, str(tmp_path / "c"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2 and products.read_table(spark, str(tmp_path / "c"), "island string, km2 double").count() == 2
    files = spark.createDataFrame([("x/tenerife.tif", 1 << 20), ("x/archipelago.tif", 2 << 20), ("x/t.confidence.tif", 1 << 19)], "path string, bytes long")
    assert store.published_size(files).first().mib == 2.5
    digests = spark.createDataFrame([("a", "1"), ("b", "2")], "path string, sha256 string")
    version = store.data_version(digests).first().version
    assert version == store.data_version(digests.orderBy(F.desc("path"))).first().version != store.data_version(digests.limit(1)).first().version
    doc = json.loads(store.item_documents(q_products._items(spark, SF)).where("path like 'c1/1/%'").first().json)
    assert doc["type"] == "Feature" and len(doc["bbox"]) == 4 and {x["rel"] for x in doc["links"]} == {"parent", "root"}


def test_ways_are_met_by_distance(spark):
    grid = spark.range(900).select(F.floor(F.col("id") / 30).cast("int").alias("r"), (F.col("id") % 30).cast("int").alias("c"))
    ways = [(2.0, 3.0, 27.0, 20.5), (15.0, 15.0, 15.0, 15.0)]
    got = {(r.r, r.c) for r in products.near_ways(grid, spark.createDataFrame(ways, "x1 double, y1 double, x2 double, y2 double"), 30, 9.93, 8.82).collect()}

    def metres(px, py, x1, y1, x2, y2):
        dx, dy, ax, ay = (x2 - x1) * 8.82, (y2 - y1) * 9.93, (px - x1) * 8.82, (py - y1) * 9.93
        t = min(1, max(0, (ax * dx + ay * dy) / (dx * dx + dy * dy))) if dx or dy else 0
        return math.hypot(ax - t * dx, ay - t * dy)

    assert got == {(r, c) for r in range(30) for c in range(30) if min(metres(c + 0.5, r + 0.5, *w) for w in ways) <= 30}


def test_reports(spark):
    block = [(r, c, 96) for r in range(10) for c in range(4)] + [(20, 20, 96)]
    before = spark.createDataFrame(block, "r int, c int, v int")
    got = analyses.compact_loss(before, before.where("r < 5")).first()
    assert got.lost_km2 > got.compact_km2 > 0 and got.isolated_pct == pytest.approx(100 / 21, abs=0.1)
    assert analyses.compact_loss(before, before).first().lost_km2 == 0
    points = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0)], "class string, metres double")
    assert tuple(analyses.diagnosis(points).first()) == ("a", 3, 2.0, 1)
    seam = spark.createDataFrame([("x", 20.0, 0.6), ("y", 12.0, 0.74), ("z", 3.0, 1.2)], "island string, baseline_km2 double, ratio double")
    assert tuple(analyses.drop_range(seam).first()) == (26.0, 40.0, 2)
    m = spark.createDataFrame([("a", "km2", "sum", 0, 1.0, None), ("b", "km2", "sum", 0, 2.0, None), ("a", "s", "cumulative", 2024, 1.0, None), ("a", "s", "cumulative", 2026, 3.0, None), ("b", "s", "cumulative", 2025, 10.0, None), ("a", "x_pct", "sum", 0, 9.0, None)], "island string, name string, kind string, key int, number double, label string")
    assert {(r["name"], r.key): r.number for r in analyses.rolled_up(m).collect()} == {("km2", 0): 3.0, ("s", 2024): 1.0, ("s", 2025): 11.0, ("s", 2026): 13.0}
    one_layer = spark.createDataFrame([("i", "l", 0, [1.0])], "island string, layer string, ordinal int, coefficients array<double>")
    assert gates.grid_alignment(one_layer).count() == 0
    moved = gates.unmoved(spark.createDataFrame([("a", 1.0), ("b", 2.0)], "name string, value double"), spark.createDataFrame([("a", 1.5), ("b", 2.0)], "name string, value double"))
    assert [r["name"] for r in moved.collect()] == ["b"]


def test_compact_cells_match_a_flood_fill(spark):
    built = {(r.r, r.c) for r in derived.cells(spark, "/root/testdata/sf0.01").select("r", "c").collect()}
    seeds = {(r, c) for r, c in built if all((r + i, c + j) in built for i in (-1, 0, 1) for j in (-1, 0, 1))}
    todo, want = list(seeds), set(seeds)
    while todo:
        r, c = todo.pop()
        for n in ((r - 1, c), (r + 1, c), (r, c - 1), (r, c + 1)):
            if n in built and n not in want:
                want.add(n)
                todo.append(n)
    assert want and {(r.r, r.c) for r in all_queries()["compact_only"](spark, "/root/testdata/sf0.01").collect()} == want
    whole = components.patch_summary(derived.cells(spark, "/root/testdata/sf0.01")).first()
    assert whole.largest > 1000


def test_declarations_and_values(spark):
    md = "# T\n\n## A\nIt has 12 km².\n<!-- figures: data/a.csv; external: a paper @ 2024-01-02 -->\n## B\nIt has 13 km².\n## C\nNone.\n## D\n`<!-- figures: x @ 2024-01-02 -->` 14 km²\n## E\n5 ha <!-- figures: gone.csv @ 2024-01-02 -->"
    parts = X.sections(spark.createDataFrame([(1, md)], "doc_id int, text string"))
    files = spark.createDataFrame([("data/a.csv",)], "path string")
    titles = {r.section: r.title for r in parts.collect()}
    assert sorted((titles[r.section], r.problem) for r in X.declaration_problems(parts, files).collect()) == [("B", "1 undeclared figures"), ("D", "1 undeclared figures"), ("E", "no source gone.csv")]
    want = {(d, f"{d % 9 + 0.5} km²") for d in [r.doc_id for r in derived.table(spark, SF, "documents").select("doc_id").collect()] if d % 9 == 3}
    got = {(r.doc_id, r.figure) for r in all_queries()["f10_typed_values"](spark, SF).collect()}
    assert want <= got and all(f == "3.5 km²" for _, f in got)
    js = spark.createDataFrame([("// 'no'\nconst a = 'x 5'; /* \"no\" */ b = `y`; [[[cog 'g' [[[end]]]",)], "t string")
    assert js.select(Z.quoted_strings(F.col("t"))).first()[0] == ["'x 5'", "`y`"]
    pair = spark.createDataFrame([("<!-- [[[cog out(1) ]]] -->\n7 km²\n<!-- [[[end]]] -->",)], "t string").select(Z.generated_pairs(F.col("t"))).first()[0][0]
    assert pair.code == "out(1)" and "7 km²" in pair.output and "end" not in pair.output


def test_draws_are_orders(spark):
    placed = all_queries()["o6_blind_order"](spark, SF).orderBy("place").collect()
    assert [r.place for r in placed] == list(range(1, len(placed) + 1)) and [r.doc_id for r in placed] != sorted(r.doc_id for r in placed)
    draw = all_queries()["stratified_draw"](spark, SF).collect()
    assert {r.stratum for r in draw} == {"built_before_2015", "undated"} and len({r.id for r in draw}) == len(draw) == 80
