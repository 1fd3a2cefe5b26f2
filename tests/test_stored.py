"""What is written and read back: elements of feeds, overviews, windows and zones of stored layers, merged statistics."""

import re
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from terrafold.operators import cells as C
from terrafold.operators import pyramid, spans
from terrafold.plans import q_stored
from terrafold.plans.registry import all_queries
from terrafold.sources import derived, gml, statistics, tiles

SF = "/root/testdata/sf0.001"
HEAD = '<?xml version="1.0" encoding="UTF-8"?>\n<gml:FeatureCollection xmlns:gml="http://g" xmlns:bu-ext2d="http://e" xmlns:bu-core2d="http://c">\n'
NS = {"e": "http://e", "c": "http://c", "g": "http://g"}


def plain_records(text):
    """Records by a tree parser, element by element; None for one that does not parse."""
    for body in re.split(r"(?=<bu-ext2d:Building[ >])", text)[1:]:
        cut = body.find("</bu-ext2d:Building>")
        try:
            root = ET.fromstring(HEAD + body[: cut + 20] + "</gml:FeatureCollection>")[0]
            if cut < 0:
                raise ET.ParseError
        except ET.ParseError:
            yield None
            continue
        get = lambda path: (lambda x: None if x is None else x.text)(root.find(path, NS))  # noqa: B023, E731
        begin, end, value = get("c:dateOfConstruction/c:DateOfEvent/c:beginning"), get("c:dateOfConstruction/c:DateOfEvent/c:end"), root.find("e:officialArea/e:OfficialArea/e:value", NS)
        both = all(re.match(r"\d{4}-\d\d-\d\d", x or "") for x in (begin, end))
        year = int(begin[:4]) if re.match(r"\d{4}", begin or "") else 0
        yield (root.get("{http://g}id"), min(max(year, 1900), 2099) if year else 0, begin[:10] if both else None, end[:10] if both else None, int(begin[:4]) if both else None,
               int(get("c:beginLifespanVersion")[:4]) if get("c:beginLifespanVersion") else None, get("c:conditionOfConstruction"), get("e:currentUse"), int(value.text) if value.get("uom") == "m2" else None)


def test_elements_equal_a_plain_parser(spark, tmp_path):
    """Files of many elements, read by several tasks each, whatever is broken in them."""
    rows = q_stored._feed(spark, SF).where("file in ('38001', '38002')").orderBy("id").collect()
    for name in ("38001", "38002"):
        df = spark.createDataFrame([r for r in rows if r.file == name], q_stored._feed(spark, SF).schema)
        gml.write_buildings(df.coalesce(1), str(tmp_path / "raw" / name), "file")
        text = "".join(p.read_text() for p in sorted((tmp_path / "raw" / name).rglob("*.txt")))
        (tmp_path / "feed").mkdir(exist_ok=True)
        (tmp_path / "feed" / f"A.ES.SDGC.BU.{name}.building.gml").write_text(HEAD + text + "</gml:FeatureCollection>\n")
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = gml.elements(spark, str(tmp_path / "feed"), gml.BUILDING, gml.BUILDING_SCHEMA)
        assert found.rdd.getNumPartitions() > 3
        got = gml.building_records(found).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = [(name, r) for name in ("38001", "38002") for r in plain_records((tmp_path / "feed" / f"A.ES.SDGC.BU.{name}.building.gml").read_text())]
    assert len(got) == len(want) == len(rows) and sum(r.malformed for r in got) == sum(r is None for _, r in want) > 10
    assert sorted(str((r.municipality, *r[:9])) for r in got if not r.malformed) == sorted(str((m, *r)) for m, r in want if r)


def test_elements_by_case(spark, tmp_path):
    ring = '<gml:LinearRing><gml:posList srsDimension="2">{}</gml:posList></gml:LinearRing>'
    inner = f"<gml:interior>{ring.format('1 1 2 1 2 2 1 1')}</gml:interior>"
    shape = f"<bu-core2d:geometry><gml:Surface><gml:patches><gml:PolygonPatch><gml:exterior>{ring.format('0 0 9 0 9 9 0 9 0 0')}</gml:exterior>{inner}</gml:PolygonPatch></gml:patches></gml:Surface></bu-core2d:geometry>"
    body = f"<bu-ext2d:Building gml:id='x'>{shape}</bu-ext2d:Building><bu-ext2d:Building gml:id='y'/></bu-ext2d:Building><bu-ext2d:BuildingPart/>"
    (tmp_path / "a.gml").write_text(HEAD + body + "<bu-ext2d:Building gml:id='z'><bu-core2d:x>")
    found = gml.elements(spark, str(tmp_path), gml.BUILDING, gml.BUILDING_SCHEMA)
    got = {r.id: r for r in gml.building_records(found).collect()}
    assert got["x"][1:9] == (0, None, None, None, None, None, None, None) and not got["x"].malformed and any(r.malformed for r in got.values())
    points = [(r.ring, r.x, r.y) for r in gml.building_vertices(found).orderBy("ring", "seq").collect()]
    assert points == [(0, 0, 0), (0, 9, 0), (0, 9, 9), (0, 0, 9), (1, 1, 1), (1, 2, 1), (1, 2, 2)]
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "b.gml").write_text("")
    assert gml.elements(spark, str(tmp_path / "none"), gml.BUILDING, gml.BUILDING_SCHEMA).collect() == []


@pytest.mark.parametrize("how", pyramid.WAYS)
def test_every_level_is_the_overview_of_the_full_table(spark, how):
    cells = derived.cells(spark, SF)
    made = pyramid.pyramid(cells, 5, how)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan  # the base was read when the first level was written, and never since
    for level in range(1, 6):
        want = sorted(map(tuple, C.overview(cells, level, how).collect()))
        assert sorted(map(tuple, made.where(F.col("level") == level).select("r", "c", "v").collect())) == want and want
    with pytest.raises(ValueError, match="unknown overview"):
        pyramid.pyramid(cells, 1, "cubic")


def test_each_level_is_read_once(spark):
    """Rows that the base gives, counted as they pass: one scan, whatever the number of levels."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    cells = derived.cells(spark, SF)
    pyramid.pyramid(cells.mapInArrow(count, cells.schema), 6, "mode").count()
    assert seen.value == cells.count()


def files_read(df):
    """Files that the scans of an executed query listed or read."""
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if node.metrics().contains("numFiles"):
            total += node.metrics().apply("numFiles").value()
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return total


def test_windows_and_zones_read_their_strips_only(spark, tmp_path):
    path, strip = str(tmp_path / "layers"), 16
    base = q_stored._layers(spark, SF)
    tiles.write_layers(base, path, 2, "mode", strip)
    every = tiles.layer(spark, path, "first")
    every.collect()
    all_files = files_read(every)
    near = tiles.window(spark, path, "first", "nw", (5, 20), (7, 60), 0, strip)
    got = {(r.r, r.c, int(r.v)) for r in near.collect()}
    assert got == {(r.r, r.c, r.v) for r in base.where("layer = 'first' and island = 'nw' and r between 5 and 20 and c between 7 and 60").collect()} and got
    assert files_read(near) <= 2 < all_files
    low = tiles.window(spark, path, "first", "nw", (0, 99), (0, 99), 2, strip)
    want = C.overview(base.where("layer = 'first' and island = 'nw'"), 2, "mode")
    assert {(r.r, r.c, int(r.v)) for r in low.collect()} == {tuple(r) for r in want.collect()}
    box = [("box", 0, k, float(x), float(y)) for k, (x, y) in enumerate([(20, 40), (170, 40), (170, 60), (20, 60)])]
    zone = spark.createDataFrame(box, "zone string, ring int, seq int, x double, y double").where("zone = 'box'")
    zonal = tiles.zonal_stored(spark, path, "first", zone, strip=strip)
    row = zonal.collect()[0]
    assert tuple(row)[1:] == tuple(spans.zonal(base.where("layer = 'first'"), zone).select("built_km2", "zone_km2", "share_pct").first()) and row.built_km2 > 0
    text = zonal._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text.lower() and files_read(zonal) < all_files / 2


def test_statistics_are_merged_not_replaced(spark, tmp_path):
    path, kind = str(tmp_path / "stats"), "layer string, island string, km2 double"
    of = lambda *rows: spark.createDataFrame(list(rows), kind)
    held = lambda: {(r.layer, r.island, r.km2) for r in statistics.published(spark, path, kind).collect()}
    statistics.commit(of(("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 3.0)), path)
    statistics.commit(of(("a", "z", 4.0)), path)
    assert held() == {("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 3.0), ("a", "z", 4.0)}
    for _ in range(2):
        statistics.commit(of(("a", "x", 9.0)), path)
    now = {("a", "x", 9.0), ("a", "y", 2.0), ("b", "x", 3.0), ("a", "z", 4.0)}
    assert held() == now
    broken = of(("a", "y", 7.0), ("b", "x", 8.0)).withColumn("km2", F.when(F.col("layer") == "b", F.raise_error(F.lit("stop")).cast("double")).otherwise(F.col("km2")))
    with pytest.raises(Exception, match="stop"):
        statistics.commit(broken, path)
    with pytest.raises(Exception, match="a record without island"):
        statistics.commit(of(("a", None, 7.0)), path)
    statistics.commit(of(), path)
    assert held() == now
    texts = {r.layer: r.json for r in statistics.document(statistics.published(spark, path, kind)).collect()}
    assert texts == {"a": '{"x":{"km2":9.0},"y":{"km2":2.0},"z":{"km2":4.0}}', "b": '{"x":{"km2":3.0}}'}


def test_stored_queries_have_rows(spark):
    for name in ("building_elements", "building_rings", "stored_window", "stored_zonal", "merged_on_disk"):
        assert all_queries()[name](spark, SF).head(1)
