"""Queries over what has been written first: feeds of building elements, layers with overviews, merged statistics."""

from pyspark.sql import functions as F

from terrafold.functions import grid as G
from terrafold.operators import buffers as U
from terrafold.operators import pyramid as Y
from terrafold.operators import reproject as W
from terrafold.operators import spans as P
from terrafold.plans.registry import register
from terrafold.sources import derived as D
from terrafold.sources import gml, statistics, tiles
from terrafold.sources.derived import area, sql
from terrafold.sources.scratch import scratch

A = area()

_ORDERS = """o AS (SELECT o_orderkey AS k, o_custkey % 5 AS m, CAST(o_orderdate AS DATE) AS d, o_orderstatus AS s, o_orderpriority AS p, CAST(floor(o_totalprice) AS BIGINT) AS a FROM orders),
f AS (SELECT *, k % 41 = 3 OR k % 43 = 5 AS bad, CASE k % 17 WHEN 0 THEN '--01-01T00:00:00' WHEN 1 THEN '88-01-01T00:00:00' WHEN 2 THEN '1850-' || strftime(d, '%m-%d') || 'T00:00:00' ELSE strftime(d, '%Y-%m-%d') || 'T00:00:00' END AS b FROM o)"""


def _feed(spark, d):
    """A feed of one building per order: dates of two digits or none, entities, areas in another unit, elements that break off or nest wrongly."""
    o = D.table(spark, d, "orders")
    k, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    begin = F.when(k % 17 == 0, "--01-01T00:00:00").when(k % 17 == 1, "88-01-01T00:00:00").when(k % 17 == 2, F.concat(F.lit("1850-"), F.date_format(day, "MM-dd"), F.lit("T00:00:00"))).otherwise(F.concat(day.cast("string"), F.lit("T00:00:00")))
    x = k % 1000
    return o.select(
        F.concat(F.lit("B."), k).alias("id"), begin.alias("beginning"), F.when(k % 7 != 0, F.concat(F.date_add(day, 30).cast("string"), F.lit("T00:00:00"))).alias("ending"), F.when(k % 9 != 0, F.concat(F.year(day), F.lit("-05-01T00:00:00"))).alias("life"),
        F.col("o_orderstatus").alias("condition"), F.concat_ws(" & ", "o_orderpriority", "o_orderstatus").alias("use"), F.floor("o_totalprice").alias("area"), F.when(k % 11 == 0, "ha").otherwise("m2").alias("uom"),
        F.concat_ws(" ", x, F.lit(0), x + 2, F.lit(0), x + 2, F.lit(3), x, F.lit(0)).alias("positions"),
        F.when(k % 41 == 3, "<bu-ext2d:open>\n</bu-ext2d:Building>").when(k % 43 == 5, "</gml:featureMember>").alias("broken"), F.concat(F.lit("3800"), F.col("o_custkey") % 5).alias("file"))


def _elements(spark, d):
    path = scratch(spark, "feed")
    gml.write_buildings(_feed(spark, d), path, "file")
    return gml.elements(spark, path, gml.BUILDING, gml.BUILDING_SCHEMA)


@register("building_elements", f"""WITH {_ORDERS},
r AS (SELECT *, regexp_matches(b, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND k % 7 <> 0 AS dated FROM f WHERE NOT bad)
SELECT 'B.' || k AS id, CASE WHEN k % 17 IN (0, 1) THEN 0 ELSE greatest(CAST(b[1:4] AS INT), 1900) END AS year, CASE WHEN dated THEN b[1:10] END AS begun, CASE WHEN dated THEN strftime(d + 30, '%Y-%m-%d') END AS ended,
CASE WHEN dated THEN CAST(b[1:4] AS INT) END AS begun_year, CASE WHEN k % 9 <> 0 THEN CAST(year(d) AS INT) END AS life, s AS condition, p || ' & ' || s AS use, CASE WHEN k % 11 <> 0 THEN a END AS area_m2, '3800' || m AS municipality, false AS malformed FROM r
UNION ALL SELECT NULL, 0, NULL, NULL, NULL, NULL, NULL, NULL, NULL, '3800' || m, true FROM f WHERE bad""")
def building_elements(spark, d):
    return gml.building_records(_elements(spark, d))


@register("building_rings", """SELECT 'B.' || o_orderkey AS id, CAST(0 AS INT) AS ring, CAST(s AS INT) AS seq, (o_orderkey % 1000 + CASE WHEN s > 0 THEN 2 ELSE 0 END)::DOUBLE AS x, (CASE WHEN s = 2 THEN 3 ELSE 0 END)::DOUBLE AS y
FROM orders, range(3) t(s) WHERE o_orderkey % 41 <> 3 AND o_orderkey % 43 <> 5""")
def building_rings(spark, d):
    return gml.building_vertices(_elements(spark, d))


def _layers(spark, d):
    """layer, island, r, c, v: two products on islands that are quarters of the grid."""
    island = F.concat(F.when(F.col("r") < 100, "n").otherwise("s"), F.when(F.col("c") < 100, "w").otherwise("e"))
    one = lambda cells, name: cells.select(F.lit(name).alias("layer"), island.alias("island"), "r", "c", "v")
    return one(D.cells(spark, d), "first").union(one(D.cells2(spark, d), "second"))


@register("pyramid_mode", sql("cell", " UNION ALL ".join(
    f"SELECT {k} AS level, CAST(r AS INT) AS r, CAST(c AS INT) AS c, arg_max(v, n*1000-v) AS v FROM (SELECT r//{1 << k} AS r, c//{1 << k} AS c, v, count(*) AS n FROM cell GROUP BY 1,2,3) GROUP BY 2,3" for k in range(1, 7))))
def pyramid_mode(spark, d):
    return Y.pyramid(D.cells(spark, d), 6, "mode")


@register("pyramid_average", sql("pct", " UNION ALL ".join(
    f"SELECT {k} AS level, CAST(r//{1 << k} AS INT) AS r, CAST(c//{1 << k} AS INT) AS c, round(avg(v),6) AS v FROM pct GROUP BY 2,3" for k in range(1, 5))))
def pyramid_average(spark, d):
    return Y.pyramid(D.percents(spark, d), 4, "average")


@register("stored_window", sql("cell2", "SELECT CAST(r//4 AS INT) AS r, CAST(c//4 AS INT) AS c, min(v)::DOUBLE AS v FROM cell2 WHERE r<100 AND c>=100 GROUP BY 1,2 HAVING r BETWEEN 3 AND 19 AND c BETWEEN 28 AND 40"))
def stored_window(spark, d):
    """A window of the second overview of one island, as it was written."""
    path = scratch(spark, "layers")
    tiles.write_layers(_layers(spark, d), path, 3, "least", 64)
    return tiles.window(spark, path, "second", "ne", (3, 19), (28, 40), 2, 64)


@register("stored_zonal", sql("cell zone", f"""SELECT z.zone, round(coalesce(sum({area('z.r')}) FILTER (WHERE k.v IS NOT NULL),0)/1e6,6) AS built_km2, round(sum({area('z.r')})/1e6,6) AS zone_km2,
round(100*coalesce(sum({area('z.r')}) FILTER (WHERE k.v IS NOT NULL),0)/sum({area('z.r')}),4) AS share_pct FROM zone z LEFT JOIN cell k ON k.r=z.r AND k.c=z.c WHERE z.zone<>'ring' GROUP BY 1"""))
def stored_zonal(spark, d):
    """Zones over a layer on disk; the strips of other zones are not read."""
    path = scratch(spark, "layers")
    tiles.write_layers(_layers(spark, d), path, strip=64)
    return tiles.zonal_stored(spark, path, "first", D.vertices(spark).where("zone != 'ring'"), strip=64)


_STATS = """SELECT l_returnflag AS layer, CAST(l_suppkey % 7 AS VARCHAR) AS island, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS total FROM lineitem"""


@register("merged_on_disk", f"""SELECT * FROM ({_STATS} GROUP BY 1,2) WHERE island NOT IN ('2', '3') OR layer <> 'R' UNION ALL SELECT layer, island, -n, 0.5 FROM ({_STATS} GROUP BY 1,2) WHERE island IN ('2', '3') AND layer = 'R'""")
def merged_on_disk(spark, d):
    """A full run, one of two islands of one layer, the same again: what the later ones did not compute stays."""
    path = scratch(spark, "statistics")
    rows = D.table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("layer"), (F.col("l_suppkey") % 7).cast("string").alias("island")).agg(F.count("*").alias("n"), F.sum("l_quantity").cast("double").alias("total"))
    statistics.commit(rows, path)
    part = rows.where("layer = 'R' and island in ('2', '3')").withColumns({"n": -F.col("n"), "total": F.lit(0.5)})
    statistics.commit(part, path)
    statistics.commit(part, path)
    return statistics.published(spark, path, "layer string, island string, n long, total double")


_LINE = "SELECT (s_suppkey*53)%190 + (s_suppkey%2)*0.5::DOUBLE AS x1, (s_suppkey*37)%190 + (s_suppkey%3)*0.25::DOUBLE AS y1, (s_suppkey*53)%190 + (s_suppkey%2)*0.5::DOUBLE + s_suppkey%21 - 10 AS x2, (s_suppkey*37)%190 + (s_suppkey%3)*0.25::DOUBLE + s_suppkey%17 - 8 AS y2 FROM supplier"


@register("buffered_ground", sql("zone cell2", f""", l AS ({_LINE}), m AS (SELECT x1*8.82 AS ax, y1*9.93 AS ay, (x2-x1)*8.82 AS dx, (y2-y1)*9.93 AS dy FROM l),
land AS (SELECT DISTINCT z.zone, z.r, z.c, (z.c+0.5)*8.82::DOUBLE AS px, (z.r+0.5)*9.93::DOUBLE AS py FROM zone z SEMI JOIN cell2 USING (r,c)),
t AS (SELECT zone, r, c, px-ax AS qx, py-ay AS qy, dx, dy, CASE WHEN dx*dx+dy*dy=0 THEN 0 ELSE least(greatest(((px-ax)*dx+(py-ay)*dy)/(dx*dx+dy*dy),0),1) END AS t FROM land, m WHERE px BETWEEN least(ax,ax+dx)-31 AND greatest(ax,ax+dx)+31 AND py BETWEEN least(ay,ay+dy)-31 AND greatest(ay,ay+dy)+31),
near AS (SELECT DISTINCT zone, r, c FROM t WHERE sqrt(pow(qx-t*dx,2)+pow(qy-t*dy,2))<=30)
SELECT zone, count(*) AS pixels, round(sum({A})/1e6,6) AS km2 FROM land ANTI JOIN near USING (zone, r, c) GROUP BY 1"""))
def buffered_ground(spark, d):
    """Ground of each zone that the second product holds and that lies farther than 30 m from a line, one line per supplier."""
    from terrafold.functions.grid import km2, row_area

    k = F.col("s_suppkey")
    x, y = (k * 53) % 190 + (k % 2) * 0.5, (k * 37) % 190 + (k % 3) * 0.25
    lines = D.table(spark, d, "supplier").select(x.alias("x1"), y.alias("y1"), (x + k % 21 - 10).alias("x2"), (y + k % 17 - 8).alias("y2"))
    free = U.outside(D.cells2(spark, d), U.buffer_spans(lines, 30.0, 9.93, 8.82))
    held = P.inside(free, P.spans(D.vertices(spark)))
    return held.groupBy("zone").agg(F.count("*").alias("pixels"), km2(F.sum(row_area(F.col("r")))).alias("km2"))


@register("control_tiers", """WITH a AS (SELECT s_nationkey AS island, 'p' || s_suppkey AS zone, 1 + s_suppkey % 4 AS tier FROM supplier), u AS (SELECT * FROM a WHERE tier <= 2 AND island <> 7), b AS (SELECT island, min(tier) AS best FROM u GROUP BY 1),
c AS (SELECT u.island, u.zone, CASE WHEN best = 1 THEN 'tier 1' ELSE 'tier 1+2' END AS label FROM u JOIN b USING (island) WHERE best = 2 OR tier = 1)
SELECT CAST(n_nationkey AS VARCHAR) AS island, label, zone FROM nation LEFT JOIN c ON island = n_nationkey""")
def control_tiers(spark, d):
    areas = D.table(spark, d, "supplier").select(F.col("s_nationkey").cast("string").alias("island"), F.concat(F.lit("p"), F.col("s_suppkey").cast("string")).alias("zone"), (1 + F.col("s_suppkey") % 4).alias("tier"))
    return U.control_tiers(areas, D.table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("island")), ("7",))


#: Where the source grid of the test products begins, in equal-area metres: about where the test cells lie.
X0, Y0 = 1_809_000.0, 984_500.0


def _laea_sql(lon: str, lat: str, table: str, keep: str) -> str:
    """Columns keep, x, y of a table by the projection's formulas, step by step."""
    k = {n: f"{v!r}::DOUBLE" for n, v in G.laea_constants().items()}
    return f"""(SELECT {keep}, {G.LAEA_X}+b*{k['d']}*cos(beta)*sin(dl) AS x, {G.LAEA_Y}+b/{k['d']}*(cos({k['b1']})*sin(beta)-sin({k['b1']})*cos(beta)*cos(dl)) AS y FROM (
SELECT *, sqrt(2/(1+sin({k['b1']})*sin(beta)+cos({k['b1']})*cos(beta)*cos(dl)))*{k['rq']} AS b FROM (
SELECT *, asin(least((1-{k['e2']})*(s/(1-{k['e2']}*s*s)-ln((1-{k['e']}*s)/(1+{k['e']}*s))/(2*{k['e']}))/{k['qp']},1)) AS beta, radians(({lon})-{G.LAEA_LON}) AS dl FROM (SELECT *, sin(radians({lat})) AS s FROM {table}))))"""


_AT = _laea_sql(f"{G.TEST_LON}+{G.PIXEL}*(c+0.5)", f"{G.TEST_LAT}-{G.PIXEL}*(r+0.5)", "cell", "r, c")
_PIECES = "m AS (SELECT r, c, arg_min(v, k) AS v FROM (SELECT r, c, v, 1 AS k FROM pct UNION ALL SELECT r, c, v, 2 FROM conf) WHERE v <> 110 GROUP BY 1, 2)"


def _source(spark, d):
    """Two overlapping pieces of a product of percentages on the equal-area grid; 110 stands for no data."""
    piece = lambda t, k: t.select(F.lit(k).alias("piece"), "r", "c", "v")
    return W.merged(piece(D.percents(spark, d), 1).union(piece(D.confidences(spark, d), 2)), 110)


@register("reprojected_nearest", sql("cell pct conf", f""", {_PIECES}, t AS (SELECT r, c, CAST(floor((x-{X0})/10) AS INT) AS sc, CAST(floor(({Y0}-y)/10) AS INT) AS sr FROM {_AT})
SELECT t.r, t.c, coalesce(m.v, 110) AS v FROM t LEFT JOIN m ON m.r=t.sr AND m.c=t.sc"""))
def reprojected_nearest(spark, d):
    return W.on_grid(D.cells(spark, d), _source(spark, d), 110, X0, Y0, 10.0)


@register("reprojected_bilinear", sql("cell pct conf", f""", {_PIECES}, t AS (SELECT r, c, (x-{X0})/10-0.5 AS fx, ({Y0}-y)/10-0.5 AS fy FROM {_AT}),
w AS (SELECT t.r, t.c, CAST(floor(fy) AS INT)+i AS sr, CAST(floor(fx) AS INT)+j AS sc, (1-abs(fy-floor(fy)-i))*(1-abs(fx-floor(fx)-j)) AS w FROM t, range(2) a(i), range(2) b(j)),
s AS (SELECT w.r, w.c, round(sum(m.v*w)/sum(w),3) AS v FROM w JOIN m ON m.r=w.sr AND m.c=w.sc WHERE w>0 GROUP BY 1,2)
SELECT t.r, t.c, coalesce(s.v, 110) AS v FROM t LEFT JOIN s ON s.r=t.r AND s.c=t.c"""))
def reprojected_bilinear(spark, d):
    return W.on_grid(D.cells(spark, d), _source(spark, d), 110, X0, Y0, 10.0, "bilinear")


@register("equal_area_and_back", sql("cell", f"SELECT r, c, round({G.TEST_LON}+{G.PIXEL}*(c+0.5),8) AS lon, round({G.TEST_LAT}-{G.PIXEL}*(r+0.5),8) AS lat, round(x,3) AS x, round(y,3) AS y FROM {_AT}"))
def equal_area_and_back(spark, d):
    """Cells' centres in equal-area metres, and back from those to the degrees that they came from."""
    x, y = G.laea(G.lon_of(F.col("c")), G.lat_of(F.col("r")))
    p = D.cells(spark, d).select("r", "c", x.alias("x"), y.alias("y"))
    lon, lat = G.laea_inverse(F.col("x"), F.col("y"))
    return p.select("r", "c", F.round(lon, 8).alias("lon"), F.round(lat, 8).alias("lat"), F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))
