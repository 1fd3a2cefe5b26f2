"""Queries on source products, projections, reports, roll-ups, gates and sinks; named by the inventory's numbers."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from terrafold.functions import encoding as E
from terrafold.functions import grid as G
from terrafold.functions import text as X
from terrafold.operators import analyses as N
from terrafold.operators import cells as C
from terrafold.operators import gates as Q
from terrafold.operators import spans as P
from terrafold.plans.registry import register
from terrafold.sources import derived as D
from terrafold.sources import products as R
from terrafold.sources import store
from terrafold.sources.derived import area, sql

A = area()
_BOX = "b AS (SELECT s_suppkey AS id, -18.2::DOUBLE+(s_suppkey%50)/10.0::DOUBLE AS x0, 27.5::DOUBLE+(s_suppkey%25)/10.0::DOUBLE AS y0, -18.2::DOUBLE+(s_suppkey%50)/10.0::DOUBLE+0.73::DOUBLE AS x1, 27.5::DOUBLE+(s_suppkey%25)/10.0::DOUBLE+0.41::DOUBLE AS y1 FROM supplier)"
_SIDE = "CASE WHEN r<100 THEN 'north' ELSE 'south' END"
#: Cells of epochs, from the years of the derived ones.
_EP = "ep AS (SELECT r, c, CASE WHEN v=255 THEN 1 ELSE v-94 END AS v FROM cell)"


def boxes(spark, d):
    k = F.col("s_suppkey")
    x, y = F.lit(-18.2) + (k % 50) / F.lit(10.0), F.lit(27.5) + (k % 25) / F.lit(10.0)
    return D.table(spark, d, "supplier").select(k.alias("id"), x.alias("x0"), y.alias("y0"), (x + 0.73).alias("x1"), (y + 0.41).alias("y1"))


def side():
    return F.when(F.col("r") < 100, "north").otherwise("south")


def epochs(spark, d):
    return D.cells(spark, d).withColumn("v", F.when(F.col("v") == 255, 1).otherwise(F.col("v") - 94))


def land(spark):
    return P.rasterise(D.vertices(spark)).select("r", "c").distinct()




# -- sources ----------------------------------------------------------------------------------------

@register("s3_existing_tiles", f"WITH {_BOX}, t AS (SELECT id, x AS lon, y AS lat FROM b, range(-20,-8,2) u(x), range(26,32,2) w(y) WHERE x BETWEEN floor(x0/2)*2 AND floor(x1/2)*2 AND y BETWEEN floor(y0/2)*2 AND floor(y1/2)*2) SELECT id, lon, lat FROM t WHERE (lon+lat)%4=0")
def existing_tiles(spark, d):
    from terrafold.sources.feeds import tiles_below

    tiles = boxes(spark, d).select("id", F.explode(tiles_below(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), 2)).alias("t")).select("id", "t.lon", "t.lat")
    return R.existing(tiles, tiles.where("(lon + lat) % 4 = 0"), ["lon", "lat"])


@register("s5_epoch_tiles", f"WITH {_BOX}, t AS (SELECT id, CAST(floor((89.09958341912107::DOUBLE-y1)/10)+1 AS INT) AS r0, CAST(floor((89.09958341912107::DOUBLE-y0)/10)+1 AS INT) AS r1, CAST(floor((x0+180.00791656502537::DOUBLE)/10)+1 AS INT) AS c0, CAST(floor((x1+180.00791656502537::DOUBLE)/10)+1 AS INT) AS c1 FROM b) SELECT id, e AS epoch, CAST(r AS INT) AS row, CAST(c AS INT) AS col, CASE WHEN e>2020 THEN 'projected' WHEN e IN (1975,1990,2000) THEN 'observed' WHEN e IN (2015,2020) THEN 'near-observed' ELSE 'interpolated' END AS kind FROM t, (SELECT CAST(x AS INT) FROM range(1975,2031,5) u(x)) w(e), range(1,10) a(r), range(1,37) k(c) WHERE r BETWEEN r0 AND r1 AND c BETWEEN c0 AND c1")
def epoch_tiles(spark, d):
    return R.all_of([R.epoch_tiles(boxes(spark, d), e) for e in R.EPOCHS])


@register("s4_tile_boxes", "SELECT r AS row, c AS col, n, round(-180.00791656502537::DOUBLE+10*(c-1),9) AS lon_min, round(89.09958341912107::DOUBLE-10*(r-1)-10,9) AS lat_min, round(-180.00791656502537::DOUBLE+10*c,9) AS lon_max, round(89.09958341912107::DOUBLE-10*(r-1),9) AS lat_max FROM (SELECT CAST(1 + c_custkey % 18 AS INT) AS r, CAST(1 + c_nationkey % 36 AS INT) AS c, count(*) AS n FROM customer GROUP BY 1, 2)")
def tile_boxes(spark, d):
    """The boxes of all tiles that hold a customer."""
    t = D.table(spark, d, "customer").groupBy((1 + F.col("c_custkey") % 18).cast("int").alias("row"), (1 + F.col("c_nationkey") % 36).cast("int").alias("col")).agg(F.count("*").alias("n"))
    box = t.select("row", "col", "n", *R.tile_box(F.col("row"), F.col("col")))
    return box.select("row", "col", "n", *[F.round(n, 9).alias(n) for n in ("lon_min", "lat_min", "lon_max", "lat_max")])


@register("s8_described", sql("cell", "SELECT max(r)-min(r)+1 AS rows, max(c)-min(c)+1 AS columns, count(*) AS cells, min(v) AS least, max(v) AS most FROM cell"))
def described(spark, d):
    return R.describe(D.cells(spark, d))


@register("s9_distinct_files", "SELECT n_name || '.tif' AS name, max('order' || (s_suppkey%3) || '/' || n_name || '.tif') AS path FROM supplier JOIN nation ON s_nationkey=n_nationkey GROUP BY 1")
def distinct_files(spark, d):
    s = D.table(spark, d, "supplier").join(D.table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return R.distinct_files(s.select(F.concat(F.lit("order"), F.col("s_suppkey") % 3, F.lit("/"), "n_name", F.lit(".tif")).alias("path")))


@register("s9_products", sql("pct", ", p AS (SELECT * FROM (VALUES " + ",".join(f"('{k}',{v[0]},{v[1]},'{v[2]}','{v[3]}')" for k, v in R.PRODUCTS.items()) + ") t(name, nodata, resolution_m, kind, measure)), h AS (SELECT v, count(*) AS n FROM pct GROUP BY 1) SELECT p.*, CAST(sum(n) FILTER (WHERE v <> nodata) AS BIGINT) AS valid FROM p, h GROUP BY ALL"))
def products(spark, d):
    """The registry, and how many cells of a table are data under each product's no-data code; values meet products by their counts."""
    counts = F.broadcast(D.percents(spark, d).groupBy("v").agg(F.count("*").alias("n")))  # one row per code
    registry = R.registry(spark)
    return registry.join(counts, F.col("v") != F.col("nodata"), "left").groupBy(*registry.columns).agg(F.sum("n").alias("valid"))


@register("s10_projected_windows")
def projected_windows(spark, d):
    """Bounds of boxes in equal-area metres; the projection is tested at a published point."""
    return R.projected_window(boxes(spark, d))


@register("s19_greenhouses", "SELECT p_partkey, p_type AS technique FROM part WHERE p_type=(SELECT min(p_type) FROM part)")
def greenhouse_parcels(spark, d):
    parts = D.table(spark, d, "part").select("p_partkey", F.col("p_type").alias("technique"))
    return R.greenhouses(parts, "technique", parts.agg(F.min("technique")).first()[0])


@register("s22_complete_zones", "SELECT n_name AS name, n_regionkey FROM nation")
def complete_zones(spark, d):
    zones = D.table(spark, d, "nation").select(F.col("n_name").alias("name"), "n_regionkey")
    return R.complete_zones(zones, [r.name for r in zones.orderBy("name").limit(8).collect()])


@register("s18_extents", """SELECT 'p' || s_suppkey AS code, CASE WHEN s_suppkey%4=0 THEN s_suppkey/8.0::DOUBLE ELSE (s_suppkey*53)%170 END::DOUBLE AS x0, CASE WHEN s_suppkey%4=0 THEN 1.5 ELSE (s_suppkey*37)%180 END::DOUBLE AS y0,
CASE WHEN s_suppkey%4=0 THEN s_suppkey/4.0::DOUBLE ELSE (s_suppkey*53)%170+6+s_suppkey%11 END::DOUBLE AS x1, CASE WHEN s_suppkey%4=0 THEN 2.5 ELSE (s_suppkey*37)%180+4+s_suppkey%9 END::DOUBLE AS y1 FROM supplier""")
def extents(spark, d):
    """Every parcel's box, a fourth of them from a table of given extents."""
    k = F.col("s_suppkey")
    given = D.table(spark, d, "supplier").where(k % 4 == 0).select(F.concat(F.lit("p"), k.cast("string")).alias("code"), (k / 8.0).alias("x0"), F.lit(1.5).alias("y0"), (k / 4.0).alias("x1"), F.lit(2.5).alias("y1"))
    return R.extents(D.parcels(spark, d).select(F.col("zone").alias("code"), "x", "y"), given)


@register("s27_json_properties", "SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events")
def json_properties(spark, d):
    return D.table(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@register("s31_flat_index", "SELECT 'item' || s_suppkey AS item, 'file' || s_suppkey || '.tif' AS href FROM supplier WHERE s_nationkey < 12")
def flat_index(spark, d):
    """Assets by the links of a catalogue: nations below 12 are children of the root, suppliers their items."""
    s = D.table(spark, d, "supplier")
    link = lambda rows, src, rel, href: rows.select(src.alias("src"), F.lit(rel).alias("rel"), href.alias("href"))
    item, group = F.concat(F.lit("item"), "s_suppkey"), F.concat(F.lit("c"), "s_nationkey")
    children = link(s.where("s_nationkey < 12"), F.lit("root"), "child", group).distinct()
    links = R.all_of([children, link(s, group, "item", item), link(s, item, "asset", F.concat(F.lit("file"), "s_suppkey", F.lit(".tif")))])
    return R.flat_index(None, links, "root")


# -- projections ------------------------------------------------------------------------------------

@register("p7_built_masks", sql("cell", "SELECT r, c, v FROM cell WHERE v>0 AND v<=97"))
def built_masks(spark, d):
    return R.built_mask(D.cells(spark, d), "years", 97)


@register("p10_held_epochs", sql("cell cell2 zone", f", {_EP} SELECT ep.r, ep.c, least(ep.v,20) AS v FROM ep SEMI JOIN zone USING (r,c) ANTI JOIN cell2 USING (r,c) WHERE v>0"))
def held_epochs(spark, d):
    from terrafold.plans.layers import settlement_b

    return settlement_b(epochs(spark, d), D.cells2(spark, d), land(spark))


@register("p15_label_states", "SELECT doc_id, quality IS NOT NULL AND toxic IS NOT NULL AS done, coalesce(quality=1 AND toxic=0, false) AS demolished FROM labels")
def label_states(spark, d):
    word = lambda c: F.when(F.col(c) == 1, "built").when(F.col(c) == 0, "not")
    x = D.table(spark, d, "labels").select("doc_id", word("quality").alias("a"), word("toxic").alias("b"))
    return x.select("doc_id", E.label_done(F.col("a"), F.col("b")).alias("done"), E.demolished(F.col("a"), F.col("b")).alias("demolished"))


@register("p23_published_files", "SELECT name, (name NOT LIKE '%.tif' OR name='archipelago.tif' OR name LIKE '%.confidence.tif') AS published FROM (SELECT CASE s_suppkey%4 WHEN 0 THEN s_name || '.tif' WHEN 1 THEN s_name || '.confidence.tif' WHEN 2 THEN s_name || '.json' ELSE 'archipelago.tif' END AS name FROM supplier)")
def published_files(spark, d):
    k, n = F.col("s_suppkey") % 4, F.col("s_name")
    name = F.when(k == 0, F.concat(n, F.lit(".tif"))).when(k == 1, F.concat(n, F.lit(".confidence.tif"))).when(k == 2, F.concat(n, F.lit(".json"))).otherwise("archipelago.tif")
    return D.table(spark, d, "supplier").select(name.alias("name")).select("name", E.is_published(F.col("name")).alias("published"))


# -- grids ------------------------------------------------------------------------------------------

_PX = D.PX


@register("m6_grids", f"WITH {_BOX}, s AS (SELECT id, floor((x0+180.00001488697754::DOUBLE)/{_PX}) AS c0, ceil((x1+180.00001488697754::DOUBLE)/{_PX}) AS c1, floor((78.0100585990529::DOUBLE-y1)/{_PX}) AS r0, ceil((78.0100585990529::DOUBLE-y0)/{_PX}) AS r1 FROM b) SELECT id, CAST(r1-r0 AS INT) AS height, CAST(c1-c0 AS INT) AS width, round(-180.00001488697754::DOUBLE+c0*{_PX},9) AS west, round(78.0100585990529::DOUBLE-r0*{_PX},9) AS north FROM s")
def grids(spark, d):
    g = boxes(spark, d).select("id", G.grid_for(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).alias("g"))
    west, _, _, north = G.grid_box(F.col("g"))
    return g.select("id", "g.height", "g.width", F.round(west, 9).alias("west"), F.round(north, 9).alias("north"))


@register("m9_mercator_nearest", sql("cell", f", p AS (SELECT s_suppkey AS id, (-15.5::DOUBLE+(s_suppkey%170)*0.0001::DOUBLE+0.00003::DOUBLE) AS lon, (28.1::DOUBLE-(s_suppkey%160)*0.0001::DOUBLE-0.00004::DOUBLE) AS lat FROM supplier) SELECT id, coalesce(v,0) AS v FROM p LEFT JOIN cell ON r=CAST(floor((28.1-lat)/{_PX}) AS INT) AND c=CAST(floor((lon+15.5)/{_PX}) AS INT)"))
def mercator_nearest(spark, d):
    """Values under points of a web map, by way of its metres."""
    k = F.col("s_suppkey")
    lon, lat = F.lit(-15.5) + (k % 170) * 0.0001 + 0.00003, F.lit(28.1) - (k % 160) * 0.0001 - 0.00004
    x, y = G.mercator(lon, lat)
    p = D.table(spark, d, "supplier").select(k.alias("id"), x.alias("x"), y.alias("y"))
    row, col = G.mercator_cell(F.col("x"), F.col("y"))
    return p.select("id", row.alias("r"), col.alias("c")).join(D.cells(spark, d), ["r", "c"], "left").select("id", F.coalesce("v", F.lit(0)).alias("v"))


@register("m12_least_years", sql("cell", "SELECT CAST(r//6 AS INT) AS br, CAST(c//6 AS INT) AS bc, coalesce(min(v) FILTER (WHERE v<>255), 9999) AS v FROM cell GROUP BY 1,2"))
def least_years(spark, d):
    return C.least_year(D.cells(spark, d).withColumn("v", F.when(F.col("v") == 255, 0).otherwise(F.col("v"))), 6)


@register("m16_chip_boxes", f"WITH {_BOX} SELECT id, round(y0-60/111132.0::DOUBLE,9) AS south, round(x0-60/(111320*cos(radians(y0))),9) AS west, round(y0+60/111132.0::DOUBLE,9) AS north, round(x0+60/(111320*cos(radians(y0))),9) AS east FROM b")
def chip_boxes(spark, d):
    b = boxes(spark, d)
    return b.select("id", *G.chip_box(F.col("x0"), F.col("y0"), 120)).select("id", *[F.round(n, 9).alias(n) for n in ("south", "west", "north", "east")])


@register("m20_projected_areas", sql("cell", f"SELECT {_SIDE} AS island, round(count(*)*0.0004::DOUBLE,6) AS km2 FROM cell GROUP BY 1"))
def projected_areas(spark, d):
    return D.cells(spark, d).groupBy(side().alias("island")).agg(F.round(G.projected_km2(F.count("*"), 20), 6).alias("km2"))


@register("m19_equal_area_points")
def equal_area_points(spark, d):
    """Corners of boxes in European equal-area metres."""
    x, y = G.laea(F.col("x0"), F.col("y0"))
    return boxes(spark, d).select("id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


# -- joins, aggregations ----------------------------------------------------------------------------

@register("j17_reference_lookup", "SELECT s_suppkey, s_acctbal, CASE WHEN n_nationkey%2=0 THEN n_regionkey*10.0 END AS reference FROM supplier JOIN nation ON s_nationkey=n_nationkey")
def reference_lookup(spark, d):
    ref = D.table(spark, d, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("s_nationkey"), (F.col("n_regionkey") * F.lit(10.0)).alias("reference"))
    return D.table(spark, d, "supplier").join(F.broadcast(ref), "s_nationkey", "left").select("s_suppkey", "s_acctbal", "reference")  # a dimension of one row per island


@register("a12_growth_report", sql("cell", f"""SELECT {_SIDE} AS "group", """ + ", ".join(f"round(coalesce(sum({A}) FILTER (WHERE v BETWEEN 1 AND {y - 1899}),0)/1e6,2) AS km2_{y}" for y in (1995, 1997, 1999)) + f", round(100*(round(coalesce(sum({A}) FILTER (WHERE v BETWEEN 1 AND 100),0)/1e6,2)/nullif(round(coalesce(sum({A}) FILTER (WHERE v BETWEEN 1 AND 96),0)/1e6,2),0)-1),1) AS growth_pct FROM cell GROUP BY 1"))
def growth_report(spark, d):
    return N.growth_report(D.cells(spark, d).withColumn("group", side()), [1995, 1997, 1999])


_CH = "ch AS (SELECT CASE WHEN r<100 THEN 'north' ELSE 'south' END AS g, list_extract([0,1,2,10,11,12], CAST(v%6+1 AS INT)) AS v FROM cell)"


_FIRST = "(count(*) FILTER (WHERE v IN (10,2,11,12))*0.0004::DOUBLE)"
_RATE = lambda code: f"round(CASE WHEN {_FIRST}=0 THEN 'NaN'::DOUBLE ELSE 100*(count(*) FILTER (WHERE v={code})*0.0004::DOUBLE)/{_FIRST}/3 END,3)"


@register("a14_change_areas", sql("cell", f""", {_CH} SELECT g AS "group", """ + ", ".join(f"round(count(*) FILTER (WHERE v={k})*0.0004::DOUBLE,3) AS {n}_km2" for k, n in N.CHANGES.items()) + f""", round({_FIRST},2) AS built_first_km2, round(count(*) FILTER (WHERE v IN (10,1,11,12))*0.0004::DOUBLE,2) AS built_last_km2,
{_RATE(2)} AS loss_pct_year, {_RATE(1)} AS gain_pct_year FROM ch GROUP BY 1"""))
def change_areas(spark, d):
    code = F.element_at(F.array(*[F.lit(k) for k in N.CHANGES]), (F.col("v") % 6 + 1).cast("int"))
    return N.change_areas(D.cells(spark, d).select(side().alias("group"), code.alias("v")), 0.0004, 3)


@register("a17_density_properties", sql("pct cell2 conf zone", f""", land AS (SELECT DISTINCT r, c FROM zone),
t AS (SELECT z.r, coalesce(p.v,0) AS v, g.v AS green, s.v AS sure FROM land z LEFT JOIN pct p ON p.r=z.r AND p.c=z.c AND p.v<=100 LEFT JOIN cell2 g ON g.r=z.r AND g.c=z.c LEFT JOIN conf s ON s.r=z.r AND s.c=z.c AND s.v BETWEEN 1 AND 100)
SELECT round(coalesce(sum(v/100.0::DOUBLE*{A}),0)/1e6,3) AS sealed_with_km2, round(coalesce(sum(v/100.0::DOUBLE*{A}) FILTER (WHERE green IS NULL),0)/1e6,3) AS sealed_km2,
round(avg(sure),1) AS mean_confidence, round(100.0*count(*) FILTER (WHERE sure<80)/greatest(count(*),1),2) AS low_pct FROM t"""))
def density_properties(spark, d):
    """The second product's cells stand for greenhouses."""
    return N.density_properties(D.percents(spark, d), D.cells2(spark, d), D.confidences(spark, d), P.rasterise(D.vertices(spark)))


@register("a22_with_building", sql("cell cell2", "SELECT CASE WHEN cell.v=255 THEN 'undated' ELSE 'dated' END AS kind, count(*) AS n, round(100.0*count(cell2.v)/count(*),4) AS with_pct FROM cell LEFT JOIN cell2 USING (r,c) GROUP BY 1"))
def with_building(spark, d):
    return N.with_building(*[f(spark, d) for f in (D.cells, D.cells2)])


@register("a24_epoch_report", sql("cell", f""", {_EP}, t AS (SELECT {_SIDE} AS g, sum({A})/1e6 AS t, coalesce(sum({A}) FILTER (WHERE v=1),0)/1e6 AS b, """ + ", ".join(f"round(coalesce(sum({A}) FILTER (WHERE v={e}),0)/1e6,4) AS epoch_{e:02d}_km2" for e in range(1, 21)) + """ FROM ep GROUP BY 1)
SELECT g AS "group", round(t,3) AS total_km2, round(b,3) AS baseline_km2, round(100*b/t,1) AS baseline_share_pct, round(t-b,3) AS added_km2, round(100*(t-b)/nullif(b,0)/9.5,2) AS growth_pct_year, """ + ", ".join(f"epoch_{e:02d}_km2" for e in range(1, 21)) + " FROM t"))
def epoch_report(spark, d):
    return N.epoch_report(epochs(spark, d).withColumn("group", side()))


@register("a25_event_split", sql("cell zone", f""", {_EP}, z AS (SELECT DISTINCT r, c FROM zone), s AS (SELECT sum({A})/1e6 AS zk FROM z), m AS (SELECT coalesce(sum({A}) FILTER (WHERE v<=3),0)/1e6 AS b, coalesce(sum({A}) FILTER (WHERE v>3),0)/1e6 AS a FROM ep SEMI JOIN z USING (r,c))
SELECT round(zk,6) AS zone_km2, round(b,6) AS before_km2, round(a,6) AS after_km2, round(100*(b+a)/zk,2) AS share_pct FROM s, m"""))
def event_split(spark, d):
    return N.event_split(epochs(spark, d), land(spark), 3)


@register("a33_dating_agreement", """WITH h AS (SELECT l_linenumber AS year, 250 AS buildings, CAST(l_quantity AS INT)%9 AS seen FROM lineitem), k AS (SELECT 2 AS year, 'spike' AS kind UNION ALL SELECT 5, 'spike' UNION ALL SELECT * FROM (VALUES (1,'control'),(3,'control'),(4,'control'),(6,'control')) t(a,b))
SELECT kind, year, count(*) AS pixels, CAST(floor(median(seen)) AS INT) AS median_year, round(100.0*count(*) FILTER (WHERE abs(seen-year)<=3)/count(*),1) AS within_3_pct, CAST(floor(median(seen)) AS INT)-year AS "offset" FROM h JOIN k USING (year) WHERE seen>0 GROUP BY 1,2 HAVING count(*)>=100""")
def dating_agreement(spark, d):
    hits = D.table(spark, d, "lineitem").select(F.col("l_linenumber").alias("year"), F.lit(250).alias("buildings"), (F.col("l_quantity").cast("int") % 9).alias("seen"))
    return N.dating_agreement(hits, spark.createDataFrame([(2,), (5,)], "year int"))


@register("a39_unsure", "WITH p AS (SELECT 's' || doc_id%4 AS stratum, quality AS ref FROM labels), n AS (SELECT stratum, count(ref) AS usable, count(*)-count(ref) AS unsure FROM p GROUP BY 1) SELECT stratum, usable, unsure, round(100.0*unsure/(usable+unsure),1) AS unsure_pct, CASE WHEN usable>=CASE stratum WHEN 's0' THEN 5 WHEN 's1' THEN 100000 ELSE 0 END THEN 'fine' WHEN usable>=30 THEN 'usable' ELSE 'too few' END AS status FROM n")
def unsure(spark, d):
    points = D.table(spark, d, "labels").select(F.concat(F.lit("s"), F.col("doc_id") % 4).alias("stratum"), F.col("quality").cast("string").alias("ref"))
    return N.unsure_by_stratum(points, spark.createDataFrame([("s0", 5), ("s1", 100000)], "stratum string, planned int"))


@register("a42_diagnosis", sql("cell", ", p AS (SELECT s_suppkey AS id, CAST((s_suppkey*61)%400 AS INT) AS r, CAST((s_suppkey*29)%400 AS INT) AS c FROM supplier), m AS (SELECT id, round(min(sqrt(pow((cell.r-p.r)*9.93,2)+pow((cell.c-p.c)*8.82,2))),6) AS metres FROM p LEFT JOIN cell ON abs(cell.r-p.r)<=20 AND abs(cell.c-p.c)<=20 GROUP BY 1) SELECT CAST(id%3 AS VARCHAR) AS class, count(*) AS n, round(median(metres),6) AS median_m, count(*)-count(metres) AS censored FROM m GROUP BY 1"))
def diagnosis(spark, d):
    """Points on a grid twice as wide as the cells, so that some have nothing built in reach."""
    k = F.col("s_suppkey")
    points = D.table(spark, d, "supplier").select(k.alias("id"), (k * 61 % 400).cast("int").alias("r"), (k * 29 % 400).cast("int").alias("c"))
    near = C.nearest_distance(points, D.cells(spark, d), 20, 9.93, 8.82)
    return N.diagnosis(near.select((F.col("id") % 3).cast("string").alias("class"), "metres"))


@register("a43_rolled_up", sql("series", """, k AS (SELECT DISTINCT key FROM series), g AS (SELECT DISTINCT grp FROM series), f AS (SELECT grp, key, last_value(total IGNORE NULLS) OVER (PARTITION BY grp ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total FROM g CROSS JOIN k LEFT JOIN series USING (grp, key))
SELECT 'extent_by_year' AS name, key, round(coalesce(sum(total),0),6) AS number, NULL::VARCHAR AS label FROM f GROUP BY key UNION ALL SELECT 'loss', key, round(sum(total),6), NULL FROM series GROUP BY key UNION ALL SELECT 'source', 0, NULL, 'survey'"""))
def rolled_up(spark, d):
    s = D.series(spark, d).withColumnRenamed("grp", "island")
    kind = lambda name, kind, key, number, label: s.select("island", F.lit(name).alias("name"), F.lit(kind).alias("kind"), key.alias("key"), number.alias("number"), label.alias("label"))
    none, key, total = F.lit(None).cast("string"), F.col("key"), F.col("total")
    return N.rolled_up(R.all_of([
        kind("extent_by_year", "cumulative", key, total, none), kind("loss", "sum", key, total, none), kind("dated_share", "sum", key, total, none), kind("loss_pct", "sum", key, total, none),
        kind("source", "label", F.lit(0), F.lit(None).cast("double"), F.lit("survey")).distinct()]))


@register("a44_collection_totals", f"WITH {_BOX} SELECT id%4 AS collection, count(*) AS items, round(sum((x1-x0)*(y1-y0)),6) AS km2, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM b GROUP BY 1")
def collection_totals(spark, d):
    b = boxes(spark, d)
    return N.collection_totals(b.select((F.col("id") % 4).alias("collection"), ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).alias("km2"), "x0", "y0", "x1", "y1"))


@register("a45_rate_change", sql("series", """, t AS (SELECT key, sum(total) AS total FROM series GROUP BY 1), a AS (SELECT key, sum(x) AS added FROM (SELECT key, total AS x FROM t UNION ALL SELECT key+1, -total FROM t) GROUP BY 1)
SELECT round(100*(sum(added) FILTER (WHERE key BETWEEN 1998 AND 2000)/3)/nullif(sum(added) FILTER (WHERE key BETWEEN 1995 AND 1997)/3,0),6) AS pct FROM a"""))
def rate_change(spark, d):
    return N.rate_change(D.series(spark, d).withColumnRenamed("grp", "island"), (1995, 1997), (1998, 2000))


@register("a46_drop_range", "SELECT round(min(100*(1-r)),6) AS smallest, round(max(100*(1-r)),6) AS largest, count(*) AS islands FROM (SELECT s_nationkey AS island, sum(s_acctbal)/1000 AS b, avg(s_suppkey%10)/20.0 AS r FROM supplier GROUP BY 1) WHERE b>=10")
def drop_range(spark, d):
    s = D.table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("island")).agg((F.sum("s_acctbal") / 1000).alias("baseline_km2"), (F.avg(F.col("s_suppkey") % 10) / 20.0).alias("ratio"))
    return N.drop_range(s)


_TOT = f"tot AS (SELECT {_SIDE} AS island, ds AS dataset, y AS year, round(coalesce(sum({A}) FILTER (WHERE v<=y-1899),0)/1e6,6) AS built_km2, 2.0::DOUBLE AS island_km2 FROM (SELECT *, 'A' AS ds FROM cell UNION ALL SELECT *, 'B' FROM cell2), (VALUES (1996),(1999)) w(y) GROUP BY 1,2,3)"


def _totals(spark, d):
    years = F.explode(F.array(F.lit(1996), F.lit(1999))).alias("year")
    both = R.all_of([f(spark, d).withColumn("dataset", F.lit(n)) for f, n in ((D.cells, "A"), (D.cells2, "B"))]).select("r", "v", "dataset", years)
    km2 = G.km2(F.coalesce(F.sum(F.when(F.col("v") <= F.col("year") - 1899, G.row_area(F.col("r")))), F.lit(0.0)))
    return both.groupBy(side().alias("island"), "dataset", "year").agg(km2.alias("built_km2")).withColumn("island_km2", F.lit(2.0))


@register("a29_totals", sql("cell cell2", f", {_TOT} SELECT *, round(100*built_km2/island_km2,2) AS share_pct FROM tot"))
def totals(spark, d):
    return _totals(spark, d).withColumn("share_pct", F.round(100 * F.col("built_km2") / F.col("island_km2"), 2))


@register("a30_snapshot", sql("cell cell2", f""", {_TOT}, s AS (SELECT island, max(island_km2) AS own, sum(built_km2) FILTER (WHERE dataset='A' AND year=1999) AS a99, sum(built_km2) FILTER (WHERE dataset='B' AND year=1996) AS b96 FROM tot GROUP BY ROLLUP(island))
SELECT island, round(a99,4) AS a99, round(b96,4) AS b96, round(100*a99/CASE WHEN island IS NULL THEN 4.0 ELSE own END,2) AS a99_pct, round(100*b96/CASE WHEN island IS NULL THEN 4.0 ELSE own END,2) AS b96_pct FROM s"""))
def snapshot(spark, d):
    return N.snapshot(_totals(spark, d), {"a99": ("A", 1999), "b96": ("B", 1996)}, 4.0)


@register("j18_continuity", sql("cell cell2", f", {_TOT}, p AS (SELECT island, max(built_km2) FILTER (WHERE dataset='A' AND year=1999) AS a, max(built_km2) FILTER (WHERE dataset='B' AND year=1996) AS b FROM tot GROUP BY 1) SELECT island, round(a,2) AS a, round(b,2) AS b, round(b/a,2) AS ratio FROM p"))
def continuity(spark, d):
    at = lambda ds, y: F.max(F.when((F.col("dataset") == ds) & (F.col("year") == y), F.col("built_km2")))
    p = _totals(spark, d).groupBy("island").agg(at("A", 1999).alias("a"), at("B", 1996).alias("b"))
    return p.select("island", F.round("a", 2).alias("a"), F.round("b", 2).alias("b"), F.round(F.col("b") / F.col("a"), 2).alias("ratio"))


@register("a51_stack_summary", """WITH s AS (SELECT l_linenumber AS layer, CAST(l_orderkey%60 AS INT) AS r, CAST(l_partkey%60 AS INT) AS c, CAST(l_quantity AS INT)%7 AS v FROM lineitem), n AS (SELECT r, c, v, count(*) AS n FROM s GROUP BY 1,2,3)
SELECT r, c, median(v)::DOUBLE AS median, round(avg(v),6) AS mean, (SELECT arg_max(v, n*1000-v) FROM n WHERE n.r=s.r AND n.c=s.c) AS mode FROM s GROUP BY 1,2""")
def stack_summary(spark, d):
    s = D.table(spark, d, "lineitem").select(F.col("l_linenumber").alias("layer"), (F.col("l_orderkey") % 60).cast("int").alias("r"), (F.col("l_partkey") % 60).cast("int").alias("c"), (F.col("l_quantity").cast("int") % 7).alias("v"))
    return N.stack_summary(s)


@register("a51_normalised_difference", "SELECT p_partkey, round((p_size-p_retailprice)/nullif(p_size+p_retailprice,0),6) AS nd FROM part")
def normalised_difference(spark, d):
    return D.table(spark, d, "part").select("p_partkey", F.round(N.normalised_difference(F.col("p_size"), F.col("p_retailprice")), 6).alias("nd"))


# -- samples, unions --------------------------------------------------------------------------------

@register("o6_blind_order")
def blind_order(spark, d):
    """All points in the order of a seeded hash, numbered by bucket and place, so no task holds them all."""
    p = D.table(spark, d, "documents").select("doc_id", F.xxhash64(F.lit(7), "doc_id").alias("h")).withColumn("bucket", F.shiftright("h", 60))
    before = F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    base = p.groupBy("bucket").agg(F.count("*").alias("n")).select("bucket", F.coalesce(before, F.lit(0)).alias("base"))  # sixteen rows
    place = F.col("base") + F.row_number().over(Window.partitionBy("bucket").orderBy("h", "doc_id"))
    return p.join(F.broadcast(base), "bucket").select("doc_id", place.alias("place"))


@register("o7_every_seventh", "SELECT n_name FROM (SELECT n_name, row_number() OVER (ORDER BY n_name) AS k FROM nation) WHERE (k-1)%7=0 AND (k-1)//7<3")
def every_seventh(spark, d):
    """Every seventh feed by name, three at most: a systematic sample of a small table."""
    k = F.row_number().over(Window.orderBy("n_name")) - 1
    return D.table(spark, d, "nation").select("n_name", k.alias("k")).where("k % 7 = 0 and k div 7 < 3").select("n_name")


@register("u1_all_frames", "SELECT s_suppkey AS id, 'supplier' AS kind, s_acctbal AS balance, NULL AS segment FROM supplier UNION ALL SELECT c_custkey, 'customer', c_acctbal, c_mktsegment FROM customer")
def all_frames(spark, d):
    s = D.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("balance"))
    c = D.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.lit("customer").alias("kind"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return R.all_of([s, c])


_GRIDS = [("west", 0.25, 10.0, -0.25, 40.0, 20, 30), ("east", 0.25, 17.5, -0.25, 38.0, 24, 28), ("mid", 0.25, 12.0, -0.25, 41.0, 10, 10)]


def _grids(spark):
    return spark.createDataFrame(_GRIDS, "island string, a double, c double, e double, f double, height int, width int")


@register("u3_shared_grid", "WITH g AS (SELECT 'i' || s_suppkey AS island, CAST(s_suppkey % 97 AS INT) AS x, CAST(s_suppkey * 7 % 89 AS INT) AS y, CAST(5 + s_suppkey % 6 AS INT) AS h, CAST(4 + s_suppkey % 8 AS INT) AS w FROM supplier), p AS (SELECT island, CAST(y - min(y) OVER () AS INT) AS row, CAST(x - min(x) OVER () AS INT) AS col, h, w FROM g) SELECT island, row, col, CAST(max(row+h) OVER () AS INT) AS height, CAST(max(col+w) OVER () AS INT) AS width FROM p")
def shared_grid(spark, d):
    """A grid per supplier, all on one lattice of quarter degrees."""
    k = F.col("s_suppkey")
    grids = D.table(spark, d, "supplier").select(
        F.concat(F.lit("i"), k.cast("string")).alias("island"), F.lit(0.25).alias("a"), (-18.0 + 0.25 * (k % 97)).alias("c"), F.lit(-0.25).alias("e"), (29.0 - 0.25 * (k * 7 % 89)).alias("f"),
        (5 + k % 6).cast("int").alias("height"), (4 + k % 8).cast("int").alias("width"))
    return C.shared_grid(grids)


@register("k2_placed_mosaic", """WITH p AS (SELECT l_linenumber AS piece, CASE l_linenumber%3 WHEN 0 THEN 'west' WHEN 1 THEN 'east' ELSE 'mid' END AS island, CAST(l_orderkey%30 AS INT) AS r, CAST(l_partkey%30 AS INT) AS c, max(CAST(trunc(l_quantity) AS INT)) AS v FROM lineitem GROUP BY 1,2,3,4),
o AS (SELECT * FROM (VALUES ('west',4,0),('east',12,30),('mid',0,8)) t(island,row,col)) SELECT r+row AS r, c+col AS c, max_by(v,piece) AS v FROM p JOIN o USING (island) WHERE v<>0 GROUP BY 1,2""")
def placed_mosaic(spark, d):
    from terrafold.plans.q_cells import pieces

    lines = D.table(spark, d, "lineitem").withColumns({"l_orderkey": F.col("l_orderkey") % 30, "l_partkey": F.col("l_partkey") % 30})
    p = lines.groupBy(F.col("l_linenumber").alias("piece"), F.col("l_orderkey").cast("int").alias("r"), F.col("l_partkey").cast("int").alias("c")).agg(F.max(F.col("l_quantity").cast("int")).alias("v"))
    assert set(p.columns) == set(pieces(spark, d).columns)
    k = F.col("piece") % 3
    return C.placed_mosaic(p.withColumn("island", F.when(k == 0, "west").when(k == 1, "east").otherwise("mid")), C.shared_grid(_grids(spark)))


# -- text, gates, sinks -----------------------------------------------------------------------------

@register("f10_typed_values")
def typed_values(spark, d):
    """Live values that stand in documents with their unit; a plain scan checks it."""
    docs = D.table(spark, d, "documents").select("doc_id", F.concat_ws(" ", "text", F.lit("It covers"), F.format_string("%.1f", (F.col("doc_id") % 9 + 0.5)), F.lit("km².")).alias("text"))
    values = spark.createDataFrame([("area(a)", 3.5, "km²"), ("area(b)", 8.5, "km²"), ("size", 3.5, "MiB"), ("small", 0.5, "km²")], "name string, value double, unit string")
    return X.typed_values(docs, values, spark.createDataFrame([("8.5 km²",)], "figure string"))


@register("f13_attestation_changes", "SELECT CAST(s_nationkey AS VARCHAR) AS surface, s_name AS figure, CASE WHEN s_suppkey%3=0 THEN 'new' ELSE 'gone' END AS change FROM supplier WHERE s_suppkey%3<>1")
def attestation_changes(spark, d):
    s = D.table(spark, d, "supplier").select(F.col("s_nationkey").cast("string").alias("surface"), F.col("s_name").alias("figure"), (F.col("s_suppkey") % 3).alias("k"))
    return X.attestation_changes(s.where("k != 2"), s.where("k != 0"))


@register("f18_json_rows", """SELECT n_nationkey, '{"name":"' || n_name || '","region":' || n_regionkey || '}' AS json FROM nation""")
def json_rows(spark, d):
    return D.table(spark, d, "nation").select("n_nationkey", F.to_json(F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))).alias("json"))


@register("g6_grid_alignment", "SELECT 'grid-alignment' AS gate, 'l' || s_suppkey AS layer, CAST(s_nationkey AS VARCHAR) AS island, s_suppkey%5<>2 AND f%5<>2 OR s_suppkey%5=2 AND f%5=2 AS passed, NULL::DOUBLE AS value, 'identical' AS expected, false AS skipped, CASE WHEN (s_suppkey%5=2)=(f%5=2) THEN 'ok' ELSE 'outside' END AS detail FROM (SELECT *, min(s_suppkey) OVER (PARTITION BY s_nationkey) AS f FROM supplier) WHERE s_suppkey<>f")
def grid_alignment(spark, d):
    k = F.col("s_suppkey")
    co = F.array(F.lit(0.1), F.when(k % 5 == 2, 10.5).otherwise(10.0))
    g = D.table(spark, d, "supplier").select(F.col("s_nationkey").cast("string").alias("island"), F.concat(F.lit("l"), k).alias("layer"), k.alias("ordinal"), co.alias("coefficients"))
    return Q.grid_alignment(g)


@register("g7_table_valid", sql("cell", "SELECT 'table-valid' AS gate, 'x' AS layer, 'all' AS island, n=0 AS passed, n::DOUBLE AS value, '0 cells outside or repeated' AS expected, false AS skipped, CASE WHEN n=0 THEN 'ok' ELSE 'outside' END AS detail FROM (SELECT count(*) FILTER (WHERE r>=150) AS n FROM cell)"))
def table_valid(spark, d):
    return Q.table_valid(D.cells(spark, d), "x", 150, 200)


@register("g8_catalogue_valid", "SELECT 'catalogue-valid' AS gate, 'catalogue' AS layer, 'all' AS island, true AS passed, count(*)::DOUBLE AS value, 'every item complete' AS expected, false AS skipped, 'ok' AS detail FROM supplier")
def catalogue_valid(spark, d):
    return Q.catalogue_valid(store.item_documents(_items(spark, d)), ["type", "id", "bbox", "links"])


def _items(spark, d):
    return boxes(spark, d).select(F.concat(F.lit("c"), F.col("id") % 3).alias("collection"), F.col("id").cast("string").alias("id"), "x0", "y0", "x1", "y1", F.create_map(F.lit("k"), F.col("id").cast("string")).alias("properties"))


@register("k6_item_paths", "SELECT 'c' || s_suppkey%3 || '/' || s_suppkey || '/' || s_suppkey || '.json' AS path FROM supplier")
def item_paths(spark, d):
    return store.item_documents(_items(spark, d)).select("path")


@register("k7_runtime_index", """WITH t AS (SELECT 'c' || n_regionkey AS collection, '{"id":"' || n_nationkey || '","href":"' || n_name || '.tif"}' AS j, CAST(n_nationkey AS VARCHAR) AS id FROM nation), c AS (SELECT collection, '[' || string_agg(j, ',' ORDER BY id) || ']' AS l FROM t GROUP BY 1)
SELECT '{' || string_agg('"' || collection || '":' || l, ',' ORDER BY collection) || '}' AS json FROM c""")
def runtime_index(spark, d):
    n = D.table(spark, d, "nation")
    return store.runtime_index(n.select(F.concat(F.lit("c"), "n_regionkey").alias("collection"), F.col("n_nationkey").cast("string").alias("id"), F.concat("n_name", F.lit(".tif")).alias("href")))


@register("k8_facts_module", "SELECT string_agg('export const ' || n_name || ' = ' || n_nationkey || '.500;', chr(10) ORDER BY n_name) AS text FROM nation")
def facts_module(spark, d):
    return store.facts_module(D.table(spark, d, "nation").select(F.col("n_name").alias("name"), (F.col("n_nationkey") + F.lit(0.5)).alias("value")))


@register("g12_acceptance", sql("cell", f"SELECT 'acceptance' AS gate, name AS layer, 'all' AS island, coalesce(abs(v-g)<=0.5,false) AS passed, round(v,6) AS value, 'within 0.5' AS expected, false AS skipped, CASE WHEN coalesce(abs(v-g)<=0.5,false) THEN 'ok' ELSE 'outside' END AS detail FROM (SELECT 'built' AS name, 2.5::DOUBLE AS g, (SELECT sum({A})/1e6 FROM cell) AS v UNION ALL SELECT 'far', 99.0, (SELECT sum({A})/1e6 FROM cell) UNION ALL SELECT 'none', 1.0, NULL)"))
def acceptance(spark, d):
    built = D.cells(spark, d).agg((F.sum(G.row_area(F.col("r"))) / 1e6).alias("value"))
    measured = built.select(F.explode(F.array(F.lit("built"), F.lit("far"))).alias("name"), "value")
    return Q.acceptance(measured, spark.createDataFrame([("built", 2.5), ("far", 99.0), ("none", 1.0)], "name string, value double"), 0.5)


# -- secondary --------------------------------------------------------------------------------------

@register("h1_raw_years", sql("cell", "SELECT r, c FROM cell WHERE v<>255 AND v+1899<=1997"))
def raw_years(spark, d):
    raw = D.cells(spark, d).where("v != 255").withColumn("v", F.col("v") + 1899)
    return R.built_mask(raw, "years", 1997).select("r", "c")


@register("h4_change_by_years", sql("cell", "SELECT CASE WHEN v=255 THEN 'undated' WHEN v+1899<=1995 THEN 'before' WHEN v+1899<=1998 THEN 'between' ELSE 'after' END AS class, count(*) AS n FROM cell GROUP BY 1"))
def change_by_years(spark, d):
    y = F.col("v") + 1899
    kind = F.when(F.col("v") == 255, "undated").when(y <= 1995, "before").when(y <= 1998, "between").otherwise("after")
    return D.cells(spark, d).groupBy(kind.alias("class")).agg(F.count("*").alias("n"))


@register("h8_epoch_sums", sql("cell", f", {_EP} SELECT v AS epoch, round(sum({A})/1e6,6) AS km2 FROM ep GROUP BY 1"))
def epoch_sums(spark, d):
    return epochs(spark, d).groupBy(F.col("v").alias("epoch")).agg(G.km2(F.sum(G.row_area(F.col("r")))).alias("km2"))


@register("h10_unexplained", sql("cell cell2 zone pct", "SELECT r, c FROM cell SEMI JOIN zone USING (r,c) ANTI JOIN cell2 USING (r,c) ANTI JOIN (SELECT r, c FROM pct WHERE v>60) p USING (r,c) WHERE v=96"))
def unexplained(spark, d):
    target = C.both(D.cells(spark, d).where("v = 96"), land(spark))
    return C.only(C.only(target, D.cells2(spark, d)), D.percents(spark, d).where("v > 60")).select("r", "c")


@register("h11_cross_iou", sql("cell cell2 pct", """, t AS (SELECT r, c, 1 AS k FROM cell UNION ALL SELECT r, c, 2 FROM cell2 UNION ALL SELECT r, c, 3 FROM pct WHERE v>60), m AS (SELECT r, c, bool_or(k=1) AS a, bool_or(k=2) AS b, bool_or(k=3) AS x FROM t GROUP BY 1,2)
SELECT 'a-b' AS pair, round(count(*) FILTER (WHERE a AND b)/count(*) FILTER (WHERE a OR b)::DOUBLE,6) AS iou, count(*) FILTER (WHERE a AND NOT b) AS only_first FROM m UNION ALL SELECT 'a-x', round(count(*) FILTER (WHERE a AND x)/count(*) FILTER (WHERE a OR x)::DOUBLE,6), count(*) FILTER (WHERE a AND NOT x) FROM m UNION ALL SELECT 'b-x', round(count(*) FILTER (WHERE b AND x)/count(*) FILTER (WHERE b OR x)::DOUBLE,6), count(*) FILTER (WHERE b AND NOT x) FROM m"""))
def cross_iou(spark, d):
    """All pairs of three products by one aggregation over their cells."""
    sources = {"a": D.cells(spark, d), "b": D.cells2(spark, d), "x": D.percents(spark, d).where("v > 60")}
    tagged = R.all_of([df.select("r", "c", F.lit(k).alias("k")) for k, df in sources.items()])
    m = tagged.groupBy("r", "c").agg(*[F.max(F.col("k") == k).alias(k) for k in sources])
    pairs = F.explode(F.array(*[F.struct(F.lit(f"{p}-{q}").alias("pair"), F.col(p).alias("p"), F.col(q).alias("q")) for p, q in (("a", "b"), ("a", "x"), ("b", "x"))])).alias("x")
    both = m.select(pairs).groupBy("x.pair")
    p, q = F.col("x.p"), F.col("x.q")
    return both.agg(F.round(F.count_if(p & q) / F.nullif(F.count_if(p | q), F.lit(0)), 6).alias("iou"), F.count_if(p & ~q).alias("only_first"))


@register("h12_flagged_greenhouses", sql("cell cell2 pct", f"SELECT round(100.0*sum({area('a.r')}) FILTER (WHERE b.v IS NOT NULL)/sum({area('a.r')}),4) AS flagged_pct, round(avg(p.v) FILTER (WHERE p.v<=100),6) AS mean_sealing, round(100.0*count(*) FILTER (WHERE p.v BETWEEN 30 AND 100)/count(*),4) AS ge30_pct FROM cell a LEFT JOIN cell2 b USING (r,c) LEFT JOIN pct p ON p.r=a.r AND p.c=a.c WHERE a.v=97"))
def flagged_greenhouses(spark, d):
    """How a second product and sealing read greenhouse cells (those of one year)."""
    a = G.row_area(F.col("r"))
    g = D.cells(spark, d).where("v = 97").select("r", "c").join(D.cells2(spark, d).select("r", "c", F.lit(1).alias("b")), ["r", "c"], "left").join(D.percents(spark, d).withColumnRenamed("v", "p"), ["r", "c"], "left")
    return g.agg(
        F.round(100.0 * F.sum(F.when(F.col("b") == 1, a)) / F.sum(a), 4).alias("flagged_pct"), F.round(F.avg(F.when(F.col("p") <= 100, F.col("p"))), 6).alias("mean_sealing"),
        F.round(G.ratio(100.0 * F.count_if(F.col("p").between(30, 100)), F.count("*")), 4).alias("ge30_pct"))


@register("h13_any_overlap", sql("cell cell2", ", a AS (SELECT DISTINCT r//9 AS r, c//9 AS c FROM cell WHERE v<=96), b AS (SELECT DISTINCT r//9 AS r, c//9 AS c FROM cell2 WHERE v<=96) SELECT count(*) FILTER (WHERE a.r IS NOT NULL AND b.r IS NOT NULL) AS both, count(a.r) AS cells, count(b.r) AS flagged FROM a FULL JOIN b ON a.r=b.r AND a.c=b.c"))
def any_overlap(spark, d):
    coarse = lambda df: df.where("v <= 96").select(F.floor(F.col("r") / 9).alias("r"), F.floor(F.col("c") / 9).alias("c")).distinct()
    s = C.sides(coarse(D.cells(spark, d)), coarse(D.cells2(spark, d)))
    return s.agg(F.sum(F.col("in_a") * F.col("in_b")).alias("both"), F.sum("in_a").alias("cells"), F.sum("in_b").alias("flagged"))


@register("h14_zone_changes", sql("cell zone", "SELECT zone, count(*) FILTER (WHERE v<=96) AS n96, count(*) FILTER (WHERE v<=99) AS n99 FROM cell JOIN zone USING (r,c) GROUP BY 1"))
def zone_changes(spark, d):
    hits = P.inside(D.cells(spark, d), P.spans(D.vertices(spark)))
    return hits.groupBy("zone").agg(F.count_if(F.col("v") <= 96).alias("n96"), F.count_if(F.col("v") <= 99).alias("n99"))


@register("h23_series_keys", sql("series", "SELECT grp, string_agg(key, ',' ORDER BY key) AS keys, min(key)<=1996 AS bucketed FROM series GROUP BY 1"))
def series_keys(spark, d):
    return D.series(spark, d).groupBy("grp").agg(F.array_join(F.sort_array(F.collect_list("key")), ",").alias("keys"), (F.min("key") <= 1996).alias("bucketed"))


@register("h25_presence", "SELECT s_name AS key, CASE s_suppkey%3 WHEN 0 THEN 'present' WHEN 1 THEN 'absent' ELSE 'unknown' END AS state FROM supplier")
def presence(spark, d):
    s = D.table(spark, d, "supplier").select(F.col("s_name").alias("key"), (F.col("s_suppkey") % 3).alias("k"))
    return R.presence(s.select("key"), s.where("k < 2").select("key", (F.col("k") == 0).alias("found")))


@register("h26_zone_counts", "SELECT 'zones-' || s_nationkey AS file, count(*) AS features FROM supplier GROUP BY 1")
def zone_counts(spark, d):
    """Parcels by the file that they would be in, one per nation."""
    files = D.table(spark, d, "supplier").select(F.concat(F.lit("p"), F.col("s_suppkey").cast("string")).alias("zone"), F.concat(F.lit("zones-"), F.col("s_nationkey").cast("string")).alias("file"))
    return R.zone_counts(D.parcels(spark, d).select("zone").distinct().join(files, "zone"))
