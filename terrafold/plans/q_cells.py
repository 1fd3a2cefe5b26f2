"""Queries on masks, mosaics, resampling, neighbourhoods, components, polygons."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from terrafold.functions import grid as G
from terrafold.operators import analyses as N
from terrafold.operators import boxes as B
from terrafold.operators import cells as C
from terrafold.operators import components as K
from terrafold.operators import records as V
from terrafold.operators import spans as P
from terrafold.plans.registry import register
from terrafold.sources import derived as D
from terrafold.sources import feeds
from terrafold.sources.derived import area, sql

A = area()


def two(spark, d):
    return D.cells(spark, d), D.cells2(spark, d)


@register("mask_and", sql("cell cell2", "SELECT r, c FROM cell INTERSECT SELECT r, c FROM cell2"))
def mask_and(spark, d):
    a, b = two(spark, d)
    return C.both(a, b).select("r", "c")


@register("mask_not", sql("cell cell2", "SELECT r, c FROM cell EXCEPT SELECT r, c FROM cell2"))
def mask_not(spark, d):
    a, b = two(spark, d)
    return C.only(a, b).select("r", "c")


@register("mask_or", sql("cell cell2", "SELECT r, c FROM cell UNION SELECT r, c FROM cell2"))
def mask_or(spark, d):
    return C.either(*two(spark, d))


@register("mask_area", sql("cell", f"SELECT round(sum({A})/1e6,6) km2, round(sum(v*{A})/1e6,6) weighted FROM cell"))
def mask_area(spark, d):
    a = G.row_area(F.col("r"))
    return D.cells(spark, d).agg(G.km2(F.sum(a)).alias("km2"), G.km2(F.sum(F.col("v") * a)).alias("weighted"))


@register("iou", sql("cell cell2", """, b AS (SELECT count(*) n FROM cell JOIN cell2 USING (r,c)), u AS (SELECT count(*) n FROM (SELECT r,c FROM cell UNION SELECT r,c FROM cell2))
SELECT b.n AS both, u.n AS "any", round(b.n/u.n::DOUBLE,6) AS iou FROM b, u"""))
def iou(spark, d):
    return C.iou(*two(spark, d))


@register("merge_oldest", sql("cell cell2", "SELECT r, c, min(v) AS v FROM (SELECT * FROM cell UNION ALL SELECT * FROM cell2) GROUP BY 1,2"))
def merge_oldest(spark, d):
    return C.merge_oldest(*two(spark, d))


@register("merge_oldest_join", sql("cell cell2", "SELECT r, c, coalesce(least(cell.v,cell2.v),cell.v,cell2.v) AS v FROM cell FULL JOIN cell2 USING (r,c)"))
def merge_oldest_join(spark, d):
    return C.merge_oldest_columns(*two(spark, d))


@register("change_classes", sql("cell cell2", f"SELECT CASE WHEN cell.v IS NULL THEN 'new' WHEN cell2.v IS NULL THEN 'removed' ELSE 'stable' END AS class, count(*) n, round(sum({A})/1e6,6) km2 FROM cell FULL JOIN cell2 USING (r,c) GROUP BY 1"))
def change_classes(spark, d):
    s = C.sides(*two(spark, d))
    kind = F.when(F.col("in_a") == 0, "new").when(F.col("in_b") == 0, "removed").otherwise("stable")
    return s.groupBy(kind.alias("class")).agg(F.count("*").alias("n"), G.km2(F.sum(G.row_area(F.col("r")))).alias("km2"))


def pieces(spark, d):
    return D.table(spark, d, "lineitem").select(F.col("l_linenumber").alias("piece"), (F.col("l_orderkey") % 90).cast("int").alias("r"), (F.col("l_partkey") % 90).cast("int").alias("c"), F.col("l_quantity").cast("int").alias("v")).groupBy("piece", "r", "c").agg(F.max("v").alias("v"))


_P = "WITH p AS (SELECT l_linenumber AS piece, CAST(l_orderkey%90 AS INT) AS r, CAST(l_partkey%90 AS INT) AS c, max(CAST(trunc(l_quantity) AS INT)) AS v FROM lineitem GROUP BY 1,2,3)\n"


@register("mosaic_last_wins", _P + "SELECT r, c, max_by(v, piece) AS v FROM p WHERE v<>0 GROUP BY 1,2")
def mosaic_last_wins(spark, d):
    return C.mosaic(pieces(spark, d), last=True)


@register("mosaic_first_wins", _P + "SELECT r, c, min_by(v, piece) AS v FROM p WHERE v<>0 GROUP BY 1,2")
def mosaic_first_wins(spark, d):
    return C.mosaic(pieces(spark, d), last=False)


@register("mosaic_highest", _P + "SELECT r, c, max(v) AS v FROM p GROUP BY 1,2")
def mosaic_highest(spark, d):
    return C.highest(pieces(spark, d))


@register("fraction_grid", sql("cell", "SELECT CAST(r//7 AS INT) AS br, CAST(c//7 AS INT) AS bc, round(count(*)/49.0::DOUBLE,6) AS fraction FROM cell WHERE r//7 < 28 AND c//7 < 28 GROUP BY 1,2"))
def fraction_grid(spark, d):
    return C.fraction_grid(D.cells(spark, d), 7, D.HEIGHT, D.WIDTH)


@register("coarsen", sql("cell cell2", """, t AS (SELECT r, c, v, 0 AS land FROM cell UNION ALL SELECT r, c, 0, 1 FROM cell2)
SELECT CAST(r//3 AS INT) AS br, CAST(c//3 AS INT) AS bc, coalesce(min(v) FILTER (WHERE v>0 AND v<>255), max(v) FILTER (WHERE v=255), 0) AS v, sum(land)/9.0 > 0.5 AS land FROM t GROUP BY 1,2"""))
def coarsen(spark, d):
    a, b = two(spark, d)
    return C.coarsen(a, b, 3)


@register("overview_mode", sql("cell", """, n AS (SELECT r//4 AS br, c//4 AS bc, v, count(*) n FROM cell GROUP BY 1,2,3)
SELECT CAST(br AS INT) AS br, CAST(bc AS INT) AS bc, arg_max(v, n*1000-v) AS v FROM n GROUP BY 1,2"""))
def overview_mode(spark, d):
    return C.overview(D.cells(spark, d), 2, "mode")


@register("overview_average", sql("cell", "SELECT CAST(r//4 AS INT) AS br, CAST(c//4 AS INT) AS bc, round(avg(v),6) AS v FROM cell GROUP BY 1,2"))
def overview_average(spark, d):
    return C.overview(D.cells(spark, d), 2, "average")


@register("overview_least", sql("cell", "SELECT CAST(r//8 AS INT) AS br, CAST(c//8 AS INT) AS bc, min(v) AS v FROM cell GROUP BY 1,2"))
def overview_least(spark, d):
    return C.overview(D.cells(spark, d), 3, "least")


@register("overview_nearest", sql("cell", "SELECT CAST(r//2 AS INT) AS br, CAST(c//2 AS INT) AS bc, v FROM cell WHERE r%2=0 AND c%2=0"))
def overview_nearest(spark, d):
    return C.overview(D.cells(spark, d), 1, "nearest")


@register("average_resample", sql("pct", f"SELECT CAST(r//5 AS INT) AS br, CAST(c//5 AS INT) AS bc, round(sum(v*{A})/sum({A}),6) AS mean FROM pct GROUP BY 1,2"))
def average_resample(spark, d):
    return C.average(D.percents(spark, d), 5)


@register("nearest_resample", sql("cell cell2", "SELECT a.r, a.c, coalesce(b.v,0) AS v FROM cell a LEFT JOIN cell2 b ON b.r = CAST(floor((a.r+0.5)/2) AS INT) AND b.c = CAST(floor((a.c+0.5)/2) AS INT)"))
def nearest_resample(spark, d):
    a, b = two(spark, d)
    return C.nearest(a, b, F.floor((F.col("r") + 0.5) / 2).cast("int"), F.floor((F.col("c") + 0.5) / 2).cast("int"))


@register("drape", sql("cell cell2", """SELECT a.r, a.c, CAST(CASE WHEN b.v IS NOT NULL AND b.v<>255 THEN least(greatest(b.v+1899,1900),2099)-1899 ELSE 255 END AS INT) AS v FROM cell a LEFT JOIN cell2 b ON b.r = a.r//3 AND b.c = a.c//3"""))
def drape(spark, d):
    a, b = two(spark, d)
    years = b.withColumn("year", F.when(F.col("v") == 255, 0).otherwise(F.col("v") + 1899))
    return C.drape(a, years, 3)


@register("bilinear", sql("pct", """, p AS (SELECT p_partkey AS id, (p_partkey*37%19000)/100.0::DOUBLE+2 AS y, (p_partkey*91%19000)/100.0::DOUBLE+2 AS x FROM part),
k AS (SELECT id, CAST(floor(y-0.5) AS INT)+i AS r, CAST(floor(x-0.5) AS INT)+j AS c, abs(1-i-(y-0.5-floor(y-0.5)))*abs(1-j-(x-0.5-floor(x-0.5))) AS w FROM p, (VALUES (0),(1)) a(i), (VALUES (0),(1)) b(j))
SELECT id, round(sum(v*w)/nullif(sum(w),0),6) AS v FROM k JOIN pct USING (r,c) GROUP BY 1"""))
def bilinear(spark, d):
    p = D.table(spark, d, "part").select(F.col("p_partkey").alias("id"), ((F.col("p_partkey") * 37 % 19000) / F.lit(100.0) + 2).alias("y"), ((F.col("p_partkey") * 91 % 19000) / F.lit(100.0) + 2).alias("x"))
    return C.bilinear(D.percents(spark, d), p)


@register("point_sample", sql("cell", f"""SELECT s_suppkey, coalesce(v,0) AS v FROM (SELECT s_suppkey, CAST(floor((28.1-(28.1-(s_suppkey%20)*0.0009-0.00003))/{D.PX}) AS INT) AS r, CAST(floor((-15.5+(s_suppkey%17)*0.001+0.00004+15.5)/{D.PX}) AS INT) AS c FROM supplier) LEFT JOIN cell USING (r,c)"""))
def point_sample(spark, d):
    lat = F.lit(28.1) - (F.col("s_suppkey") % 20) * 0.0009 - 0.00003
    lon = F.lit(-15.5) + (F.col("s_suppkey") % 17) * 0.001 + 0.00004
    p = D.table(spark, d, "supplier").select("s_suppkey", G.row_of(lat).alias("r"), G.col_of(lon).alias("c"))
    return p.join(D.cells(spark, d), ["r", "c"], "left").select("s_suppkey", F.coalesce("v", F.lit(0)).alias("v"))


@register("mean_filter", sql("cell", """SELECT CAST(a.r+i AS INT) AS r, CAST(a.c+j AS INT) AS c, round(count(*)/49.0::DOUBLE,6) AS density FROM cell a, range(-3,4) x(i), range(-3,4) y(j) WHERE v<=96 GROUP BY 1,2"""))
def mean_filter(spark, d):
    return C.mean_filter(D.cells(spark, d).where("v <= 96"), 3)


@register("erode", sql("cell", """SELECT a.r, a.c FROM cell a JOIN cell b ON b.r BETWEEN a.r-1 AND a.r+1 AND b.c BETWEEN a.c-1 AND a.c+1 GROUP BY 1,2 HAVING count(*)=9"""))
def erode(spark, d):
    return C.erode(D.cells(spark, d))


@register("patch_sizes")
def patch_sizes(spark, d):
    """Patches of all cells; an all-pairs closure in SQL is too slow for them, so a flood fill checks it."""
    return K.patches(D.cells(spark, d)).groupBy("size").agg(F.count("*").alias("patches"))


@register("patch_summary")
def patch_summary(spark, d):
    """Patches of all cells: number, median, largest two, share of small ones, share of the cells that large ones hold."""
    return K.patch_summary(D.cells(spark, d))


@register("compact_only")
def compact_only(spark, d):
    return K.compact_only(D.cells(spark, d).select("r", "c"))


@register("rasterise_oldest", sql("parcel", "SELECT r, c, CAST(min(CASE WHEN k%7=0 THEN 255 ELSE 80+k%20 END) AS INT) AS v FROM parcel GROUP BY 1,2"))
def rasterise_oldest(spark, d):
    """A polygon per supplier, some undated; where they overlap the oldest date stands."""
    k = F.col("s_suppkey")
    years = D.table(spark, d, "supplier").select(F.concat(F.lit("p"), k.cast("string")).alias("zone"), F.when(k % 7 == 0, 255).otherwise(80 + k % 20).cast("int").alias("v"))
    return P.year_first_built(years, D.parcels(spark, d))


@register("rasterise_binary", sql("parcel", "SELECT DISTINCT r, c FROM parcel"))
def rasterise_binary(spark, d):
    return P.rasterise(D.parcels(spark, d)).select("r", "c").distinct()


_BOX = "SELECT s_suppkey AS id, (s_suppkey*37)%100 AS x0, (s_suppkey*37)%100+(s_suppkey%5) AS x1, (s_suppkey*53)%100 AS y0, (s_suppkey*53)%100+(s_suppkey%7) AS y1 FROM supplier"
# Boxes that overlap at every scale: a third of the first ones' spread.
_CLOSE = "SELECT s_suppkey AS id, (s_suppkey*7)%30 AS x0, (s_suppkey*7)%30+(s_suppkey%5) AS x1, (s_suppkey*11)%30 AS y0, (s_suppkey*11)%30+(s_suppkey%7) AS y1 FROM supplier"


def boxes(spark, d):
    k = F.col("s_suppkey")
    return D.table(spark, d, "supplier").select(k.alias("id"), (k * 37 % 100).alias("x0"), (k * 37 % 100 + k % 5).alias("x1"), (k * 53 % 100).alias("y0"), (k * 53 % 100 + k % 7).alias("y1"))


@register("boxes_overlap", f"WITH b AS ({_CLOSE}) SELECT a.id AS a, b.id AS b, (a.x0<b.x1 AND b.x0<a.x1 AND a.y0<b.y1 AND b.y0<a.y1) AS strict FROM b a JOIN b ON a.id<b.id AND a.x0<=b.x1 AND b.x0<=a.x1 AND a.y0<=b.y1 AND b.y0<=a.y1")
def boxes_overlap(spark, d):
    """Inclusive overlap by tiles of 10 units (boxes are at most 6 wide), and whether more than borders meet."""
    k = F.col("s_suppkey")
    b = D.table(spark, d, "supplier").select(k.alias("id"), (k * 7 % 30).alias("x0"), (k * 7 % 30 + k % 5).alias("x1"), (k * 11 % 30).alias("y0"), (k * 11 % 30 + k % 7).alias("y1"))
    return B.overlapping(b, 10)


_ISLES = "isle AS (SELECT * FROM (VALUES (0,'west',0,0,40,100),(1,'mid',30,0,70,100),(2,'east',60,0,101,60)) t(k,name,x0,y0,x1,y1))"


@register("centre_in_box", f"WITH b AS ({_BOX}), {_ISLES} SELECT b.id, min_by(isle.name, isle.k) AS island FROM b LEFT JOIN isle ON (b.x0+b.x1)/2.0 BETWEEN isle.x0 AND isle.x1 AND (b.y0+b.y1)/2.0 BETWEEN isle.y0 AND isle.y1 GROUP BY 1")
def centre_in_box(spark, d):
    """The first box (in order) that holds a centre; null outside all of them."""
    isles = spark.createDataFrame([(0, "west", 0, 0, 40, 100), (1, "mid", 30, 0, 70, 100), (2, "east", 60, 0, 101, 60)], "k int, name string, u0 int, w0 int, u1 int, w1 int")
    cx, cy = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    held = boxes(spark, d).join(F.broadcast(isles), cx.between(F.col("u0"), F.col("u1")) & cy.between(F.col("w0"), F.col("w1")), "left")
    return held.groupBy("id").agg(F.min_by("name", "k").alias("island"))


_PTS = "p AS (SELECT s_suppkey AS id, CAST((s_suppkey*61)%200 AS INT) AS r, CAST((s_suppkey*29)%200 AS INT) AS c FROM supplier)"


def points(spark, d):
    k = F.col("s_suppkey")
    return D.table(spark, d, "supplier").select(k.alias("id"), (k * 61 % 200).cast("int").alias("r"), (k * 29 % 200).cast("int").alias("c"))


@register("nearest_built", sql("cell", f", {_PTS} SELECT id, round(min(sqrt(pow((cell.r-p.r)*9.93,2)+pow((cell.c-p.c)*8.82,2))),6) AS metres FROM p LEFT JOIN cell ON abs(cell.r-p.r)<=20 AND abs(cell.c-p.c)<=20 GROUP BY 1"))
def nearest_built(spark, d):
    """To the nearest of all built cells in a window of 41 x 41."""
    return C.nearest_distance(points(spark, d), D.cells(spark, d), 20, 9.93, 8.82)


@register("classes_around", sql("cell", f", {_PTS} SELECT id, count(DISTINCT v) AS classes, min(v) AS oldest FROM p JOIN cell ON abs(cell.r-p.r)<=2 AND abs(cell.c-p.c)<=2 GROUP BY 1"))
def classes_around(spark, d):
    step = F.sequence(F.lit(-2), F.lit(2))
    near = points(spark, d).withColumn("i", F.explode(step)).withColumn("j", F.explode(step)).select("id", (F.col("r") + F.col("i")).alias("r"), (F.col("c") + F.col("j")).alias("c"))
    return near.join(D.cells(spark, d), ["r", "c"]).groupBy("id").agg(F.countDistinct("v").alias("classes"), F.min("v").alias("oldest"))


_CLAIM = lambda v: f"CASE WHEN {v} IS NULL THEN 'not_built' WHEN {v}=255 THEN 'undated' WHEN {v}<=97 THEN 'built_before_2015' ELSE 'new_2015_2024' END"


@register("tolerance_verdicts", sql("cell cell2", f""", {_PTS}, q AS (SELECT p.id, p.r, p.c, {_CLAIM('a.v')} AS stratum, CASE WHEN b.v=255 THEN NULL ELSE {_CLAIM('b.v')} END AS reference FROM p LEFT JOIN cell a ON a.r=p.r AND a.c=p.c LEFT JOIN cell2 b ON b.r=p.r AND b.c=p.c),
w AS (SELECT id, count(*) AS n, max(CASE WHEN {_CLAIM('v')}=reference THEN 1 ELSE 0 END) AS hit FROM q JOIN cell ON abs(cell.r-q.r)<=1 AND abs(cell.c-q.c)<=1 GROUP BY 1)
SELECT id, stratum, reference, CASE WHEN stratum<>'undated' AND reference<>stratum AND (coalesce(hit,0)=1 OR reference='not_built' AND coalesce(n,0)<9) THEN stratum ELSE reference END AS tolerated FROM q LEFT JOIN w USING (id) WHERE reference IS NOT NULL"""))
def tolerance_verdicts(spark, d):
    """The first product is the map, the second what the points were found to be; undated there is not settled."""
    a, b = two(spark, d)
    p = points(spark, d).select("id", "r", "c").join(a, ["r", "c"], "left").select("id", "r", "c", V.claim(F.col("v"), 1996).alias("stratum"))
    found = p.join(b, ["r", "c"], "left").select("id", "r", "c", "stratum", F.when(F.coalesce("v", F.lit(0)) != 255, V.claim(F.col("v"), 1996)).alias("reference"))
    return V.verdicts(found, a, 1, 1996)


_LABEL = lambda k: f"CASE ({k})%4 WHEN 0 THEN 'built' WHEN 1 THEN 'empty' WHEN 2 THEN 'unsure' END"


@register("label_changes", f"""WITH x AS (SELECT o_orderkey AS id, {_LABEL('o_orderkey')} AS ae, {_LABEL('o_orderkey//4')} AS al, {_LABEL('o_orderkey + o_custkey%2')} AS be, {_LABEL('o_orderkey//4')} AS bl,
CASE o_orderkey%5 WHEN 0 THEN 'built_before_2015' WHEN 1 THEN 'undated' WHEN 2 THEN 'new_2015_2024' WHEN 3 THEN 'not_built' END AS stratum FROM orders),
y AS (SELECT *, ae IS DISTINCT FROM be OR al IS DISTINCT FROM bl AS ch, coalesce(ae='built',false) = coalesce(stratum IN ('built_before_2015','undated'),false) AS ra, coalesce(be='built',false) = coalesce(stratum IN ('built_before_2015','undated'),false) AS rb
FROM x WHERE (ae IS NOT NULL OR al IS NOT NULL) AND (be IS NOT NULL OR bl IS NOT NULL))
SELECT stratum, count(*) AS n, count(*) FILTER (WHERE ch) AS changed, round(100.0::DOUBLE*count(*) FILTER (WHERE ch)/count(*),1) AS changed_pct, count(*) FILTER (WHERE ch AND rb AND NOT ra) AS toward, count(*) FILTER (WHERE ch AND ra AND NOT rb) AS away FROM y GROUP BY 1""")
def label_changes(spark, d):
    o = D.table(spark, d, "orders")
    k = F.col("o_orderkey")
    label = lambda n: F.when(n % 4 == 0, "built").when(n % 4 == 1, "empty").when(n % 4 == 2, "unsure")
    late = label(F.floor(k / 4))
    stratum = F.when(k % 5 == 0, "built_before_2015").when(k % 5 == 1, "undated").when(k % 5 == 2, "new_2015_2024").when(k % 5 == 3, "not_built")
    return V.label_changes(o.select(k.alias("id"), label(k).alias("early"), late.alias("late")), o.select(k.alias("id"), label(k + F.col("o_custkey") % 2).alias("early"), late.alias("late")), o.select(k.alias("id"), stratum.alias("stratum")))


@register("control_area", sql("zone cell cell2", f""", road AS (SELECT r, c FROM cell WHERE v=96), near AS (SELECT DISTINCT g.r, g.c FROM grid g JOIN road ON abs(g.r-road.r)<=3 AND abs(g.c-road.c)<=3 AND sqrt(pow((g.r-road.r)*9.93,2)+pow((g.c-road.c)*8.82,2))<=30)
SELECT zone, count(*) AS pixels, round(sum({A})/1e6,6) AS km2 FROM zone SEMI JOIN cell2 USING (r,c) ANTI JOIN near USING (r,c) GROUP BY 1"""))
def control_area(spark, d):
    """Zones on land without what lies within 30 m of a road: distance tests instead of buffered polygons."""
    step = F.sequence(F.lit(-3), F.lit(3))
    near = D.cells(spark, d).where("v = 96").withColumn("i", F.explode(step)).withColumn("j", F.explode(step)).where(F.hypot(F.col("i") * 9.93, F.col("j") * 8.82) <= 30).select((F.col("r") + F.col("i")).alias("r"), (F.col("c") + F.col("j")).alias("c")).distinct()
    on_land = C.both(P.rasterise(D.vertices(spark)), D.cells2(spark, d))
    return C.only(on_land, near).groupBy("zone").agg(F.count("*").alias("pixels"), G.km2(F.sum(G.row_area(F.col("r")))).alias("km2"))


@register("tier_fallback", "WITH t AS (SELECT s_nationkey AS island, CAST(s_suppkey%3 AS INT) AS tier, s_suppkey AS id FROM supplier), m AS (SELECT island, min(tier) AS best FROM t GROUP BY 1) SELECT island, tier, count(*) AS n FROM t JOIN m USING (island) WHERE tier=best GROUP BY 1,2")
def tier_fallback(spark, d):
    t = D.table(spark, d, "supplier").select(F.col("s_nationkey").alias("island"), (F.col("s_suppkey") % 3).cast("int").alias("tier"))
    best = t.groupBy("island").agg(F.min("tier").alias("tier"))
    return t.join(best, ["island", "tier"], "left_semi").groupBy("island", "tier").agg(F.count("*").alias("n"))


@register("tiles_for_box", f"WITH b AS ({_BOX}) SELECT id, CAST(x AS BIGINT) AS lon, CAST(y AS BIGINT) AS lat FROM b, range(0,120,2) u(x), range(0,120,2) w(y) WHERE x BETWEEN floor(x0/2.0)*2 AND floor(x1/2.0)*2 AND y BETWEEN floor(y0/2.0)*2 AND floor(y1/2.0)*2")
def tiles_for_box(spark, d):
    tiles = feeds.tiles_below(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), 2)
    return boxes(spark, d).select("id", F.explode(tiles).alias("t")).select("id", "t.lon", "t.lat")


@register("offset_tiles", f"WITH b AS ({_BOX}) SELECT id, CAST(floor((89.1-y0)/10)+1 AS INT) AS row, CAST(floor((x0+180.01)/10)+1 AS INT) AS col FROM b")
def offset_tiles(spark, d):
    row, col = feeds.offset_tile(F.col("x0"), F.col("y0"), -180.01, 89.1, 10.0)
    return boxes(spark, d).select("id", row.alias("row"), col.alias("col"))


@register("touched_cells", f"WITH b AS ({_BOX}), c AS (SELECT DISTINCT id, x, y FROM b, range(0,12) u(x), range(0,12) w(y) WHERE x BETWEEN x0//10 AND (x1)//10 AND y BETWEEN y0//10 AND (y1)//10) SELECT count(*) AS touched, count(DISTINCT (x,y)) AS cells, (SELECT CAST(sum((x1-x0+1)*(y1-y0+1)) AS BIGINT) FROM b) AS surface FROM c")
def touched_cells(spark, d):
    """Extent by the touched rule against surface: the two are different quantities."""
    b = boxes(spark, d)
    lo = lambda c: F.floor(F.col(c) / 10)
    t = b.select("id", F.explode(F.sequence(lo("x0"), lo("x1"))).alias("x"), "y0", "y1").select("id", "x", F.explode(F.sequence(lo("y0"), lo("y1"))).alias("y"))
    s = b.agg(F.sum((F.col("x1") - F.col("x0") + 1) * (F.col("y1") - F.col("y0") + 1)).alias("surface"))
    return t.agg(F.count("*").alias("touched"), F.countDistinct("x", "y").alias("cells")).crossJoin(F.broadcast(s))


@register("near_share", sql("cell cell2 grid", """, road AS (SELECT r, c, v FROM cell2 WHERE v=96), near AS (SELECT DISTINCT g.r, g.c FROM grid g JOIN road ON abs(g.r-road.r)<=3 AND abs(g.c-road.c)<=3 AND sqrt(pow((g.r-road.r)*9.93,2)+pow((g.c-road.c)*8.82,2))<=30),
k AS (SELECT g.r, g.c, CASE WHEN cell.v IS NULL THEN 'background' WHEN cell.v=255 THEN 'undated' ELSE 'dated' END AS kind FROM grid g LEFT JOIN cell USING (r,c))
SELECT kind, count(*) AS n, round(100.0*count(*) FILTER (WHERE (r,c) IN (SELECT (r,c) FROM near))/count(*),4) AS near_pct FROM k GROUP BY 1"""))
def near_share(spark, d):
    """Share within 30 m of a road of dated, undated and unbuilt land; cells of one year of the second product stand for roads."""
    land = spark.range(D.HEIGHT * D.WIDTH).select(F.floor(F.col("id") / D.WIDTH).cast("int").alias("r"), (F.col("id") % D.WIDTH).cast("int").alias("c"))
    return N.near_shares(D.cells(spark, d), D.cells2(spark, d).where("v = 96"), land, 30, 9.93, 8.82)


@register("loss_rate", sql("cell cell2", f""", b AS (SELECT sum({A}) m FROM cell), l AS (SELECT sum({A}) m FROM cell ANTI JOIN cell2 USING (r,c)), g AS (SELECT sum({A}) m FROM cell2 ANTI JOIN cell USING (r,c))
SELECT round(b.m/1e6,6) AS built_km2, round(l.m/1e6,6) AS lost_km2, round(g.m/1e6,6) AS gained_km2, round(100*l.m/b.m/4,6) AS loss_pct_year FROM b,l,g"""))
def loss_rate(spark, d):
    return N.loss_rate(*two(spark, d), 4)


@register("a20_compact_loss")
def compact_loss(spark, d):
    """Loss in compact cores and the isolated share of it."""
    return N.compact_loss(*two(spark, d))


_SHARES = {"base": ("v=93", {"upto": "w<=93", "after": "w>93", "none": "w IS NULL"}), "later": ("v>93", {"agree": "abs(w-v)<=5", "earlier": "w<v-5", "later": "w>v+5", "none": "w IS NULL"})}
_WITHIN = lambda cond: f"coalesce(sum({A}) FILTER (WHERE {cond}),0)/1e6"


@register("product_agreement", sql("cell cell2", """, t AS (SELECT r, c, a.v, b.v AS w FROM (SELECT * FROM cell WHERE v<>255) a FULL JOIN (SELECT * FROM cell2 WHERE v<>255) b USING (r,c)) SELECT """ + ", ".join(
    f"round({_WITHIN(g)},2) AS {n}_km2, " + ", ".join(f"round(CASE WHEN count(*) FILTER (WHERE {g})=0 THEN 'NaN'::DOUBLE ELSE 100*{_WITHIN(f'{g} AND {c}')}/({_WITHIN(g)}) END,1) AS {n}_{k}_pct" for k, c in kinds.items()) for n, (g, kinds) in _SHARES.items())
    + f", round({_WITHIN('v IS NULL AND w<=93')},2) AS never_km2 FROM t"))
def product_agreement(spark, d):
    """The first year of the test tables stands for the baseline."""
    return N.product_agreement(*two(spark, d), 93, 5)


@register("cell_test", sql("cell cell2", """, t AS (SELECT coalesce(a.v,0) AS ref, coalesce(b.v,0) AS v FROM cell a FULL JOIN cell2 b USING (r,c)),
f AS (SELECT count(*) FILTER (WHERE ref BETWEEN 1 AND 98) AS n, count(*) FILTER (WHERE ref BETWEEN 1 AND 98 AND v BETWEEN 1 AND 98) AS hit, count(*) FILTER (WHERE ref BETWEEN 1 AND 98 AND v=0) AS never, count(*) FILTER (WHERE v BETWEEN 1 AND 98) AS flagged, count(*) FILTER (WHERE v BETWEEN 1 AND 98 AND ref>0) AS hits FROM t)
SELECT n AS cells, round(100.0*hit/nullif(n,0),1) AS recall_pct, round(100.0*never/nullif(n,0),1) AS never_flagged_pct, round(100.0*hits/greatest(flagged,1),1) AS precision_pct, flagged FROM f"""))
def cell_test(spark, d):
    a, b = two(spark, d)
    return N.cell_test(a, b, 98)


@register("fraction_correlation", sql("cell cell2 zone", """, land AS (SELECT DISTINCT r, c FROM zone), own AS (SELECT r//10 AS br, c//10 AS bc FROM land WHERE r%10=5 AND c%10=5),
p AS (SELECT r//10 AS br, c//10 AS bc, count(*) FILTER (WHERE k=1)/100.0::DOUBLE AS x, count(*) FILTER (WHERE k=2)/100.0::DOUBLE AS y FROM (SELECT r,c,1 AS k FROM cell UNION ALL SELECT r,c,2 FROM cell2) SEMI JOIN land USING (r,c) GROUP BY 1,2),
f AS (SELECT coalesce(x,0) AS x, coalesce(y,0) AS y FROM own LEFT JOIN p USING (br,bc)), s AS (SELECT count(*) FILTER (WHERE x>=0.1 AND y>=0.1) AS b, count(*) FILTER (WHERE x>=0.1 OR y>=0.1) AS e,
CASE WHEN count(*)=0 OR min(x)=max(x) OR min(y)=max(y) THEN 'NaN'::DOUBLE ELSE corr(x,y) END AS r FROM f)
SELECT round(r,3) AS r, round(CASE WHEN e=0 THEN 'NaN'::DOUBLE ELSE b/e::DOUBLE END,3) AS jaccard FROM s"""))
def fraction_correlation(spark, d):
    a, b = two(spark, d)
    return N.grid_agreement(a, b, P.rasterise(D.vertices(spark)), 10)


@register("waterfall", sql("cell cell2 pct", f""", t AS (SELECT a.r, a.c, CASE WHEN b.v=255 THEN 1 WHEN b.v IS NOT NULL THEN 2 WHEN p.v>=60 THEN 3 END AS k FROM cell a LEFT JOIN cell2 b USING (r,c) LEFT JOIN pct p ON p.r=a.r AND p.c=a.c)
SELECT coalesce(k,9) AS reason, count(*) AS n, round(sum({A})/1e6,6) AS km2 FROM t GROUP BY 1"""))
def waterfall(spark, d):
    """Each cell under its first explanation; 9 for none."""
    a, b = two(spark, d)
    reasons = b.select("r", "c", F.when(F.col("v") == 255, 1).otherwise(2).alias("k")).union(D.percents(spark, d).where("v >= 60").select("r", "c", F.lit(3))).groupBy("r", "c").agg(F.min("k").alias("k"))
    return a.join(reasons, ["r", "c"], "left").groupBy(F.coalesce("k", F.lit(9)).alias("reason")).agg(F.count("*").alias("n"), G.km2(F.sum(G.row_area(F.col("r")))).alias("km2"))


_DIV = lambda n, d: f"round(CASE WHEN {d}=0 THEN 'NaN'::DOUBLE ELSE {n}/{d} END,2)"


@register("seam_record", sql("cell cell2 pct zone parcel", f""", green AS (SELECT DISTINCT r, c FROM parcel),
t AS (SELECT r, c, 'e' AS k FROM cell WHERE v<>255 AND v<=97 UNION ALL SELECT r, c, 'w' FROM cell2 UNION ALL SELECT r, c, CASE WHEN (r,c) IN (SELECT (r,c) FROM green) THEN 'g' ELSE 'f' END FROM pct WHERE v>=60),
x AS (SELECT zone AS island, round(coalesce(sum({A}) FILTER (WHERE k='e'),0)/1e6,2) AS evo30, round(coalesce(sum({A}) FILTER (WHERE k='w'),0)/1e6,2) AS wsf15, round(coalesce(sum({A}) FILTER (WHERE k IN ('g','f')),0)/1e6,2) AS trk_e1, round(coalesce(sum({A}) FILTER (WHERE k='f'),0)/1e6,2) AS trk_e1_nogh FROM zone LEFT JOIN t USING (r,c) GROUP BY 1)
SELECT *, {_DIV('evo30', 'wsf15')} AS resolution_factor, {_DIV('trk_e1', 'wsf15')} AS definition_factor_raw, {_DIV('trk_e1_nogh', 'wsf15')} AS definition_factor_masked, round(trk_e1-trk_e1_nogh,2) AS greenhouse_removed_km2,
{_DIV('trk_e1_nogh', 'evo30')} AS net_evo_to_tracker_masked, CAST(CASE island WHEN 'box' THEN 2019 WHEN 'tri' THEN 2021 END AS INT) AS greenhouse_survey_year FROM x"""))
def seam_record(spark, d):
    """The first product up to 1996 is the older era, the second product its finer map, high percentages the newer era, parcels its greenhouses."""
    a, b = two(spark, d)
    tracker = D.percents(spark, d).withColumn("v", F.when(F.col("v") >= 60, 1).otherwise(0))
    surveys = spark.createDataFrame([("box", 2019), ("tri", 2021)], "island string, year int")
    zones = P.rasterise(D.vertices(spark)).withColumnRenamed("zone", "island")
    return V.seam_record(a, b, tracker, P.rasterise(D.parcels(spark, d)), zones, surveys, 1996)


@register("status_rollup", sql("cell cell2", """, s AS (SELECT CASE WHEN r<100 THEN 'north' ELSE 'south' END AS island, * FROM (SELECT r, c, 'first' AS k FROM cell WHERE v<=94 UNION ALL SELECT r, c, 'middle' FROM cell WHERE v<=97 UNION ALL SELECT r, c, 'last' FROM cell2 UNION ALL SELECT r, c, CASE v%6 WHEN 1 THEN 'new' WHEN 2 THEN 'lost' END FROM cell WHERE v%6 IN (1,2))),
u AS (SELECT island, round(count(*) FILTER (WHERE k='first')*0.0001::DOUBLE,2) AS km2_first, round(count(*) FILTER (WHERE k='middle')*0.0001::DOUBLE,2) AS km2_middle, round(count(*) FILTER (WHERE k='last')*0.0001::DOUBLE,2) AS km2_last,
round(count(*) FILTER (WHERE k='new')*0.0004::DOUBLE,3) AS new_km2, round(count(*) FILTER (WHERE k='lost')*0.0004::DOUBLE,3) AS lost_km2, round(100*(count(*) FILTER (WHERE k='lost')*0.0004::DOUBLE)/(count(*) FILTER (WHERE k='middle')*0.0001::DOUBLE*3),3) AS loss_pct_year FROM s GROUP BY 1)
SELECT * FROM u UNION ALL SELECT NULL, round(sum(km2_first),2), round(sum(km2_middle),2), round(sum(km2_last),2), round(sum(new_km2),3), round(sum(lost_km2),3), round(100*round(sum(lost_km2),3)/(round(sum(km2_middle),2)*3),3) FROM u"""))
def status_rollup(spark, d):
    a, b = two(spark, d)
    island = F.when(F.col("r") < 100, "north").otherwise("south").alias("island")
    of = lambda t, kind: t.select(island, F.lit(kind).alias("status"))
    return V.status_report(of(a.where("v <= 94"), "first").union(of(a.where("v <= 97"), "middle")).union(of(b, "last")), a.select(island, (F.col("v") % 6).alias("v")), 0.0001, 0.0004, 3)


@register("footprint_pivot", sql("cell", "SELECT CASE WHEN r<100 THEN 'north' ELSE 'south' END AS island, " + ", ".join(f"count(*) FILTER (WHERE v={v}) AS y{v + 1899}" for v in range(96, 103)) + " FROM cell GROUP BY 1"))
def footprint_pivot(spark, d):
    t = D.cells(spark, d).select(F.when(F.col("r") < 100, "north").otherwise("south").alias("island"), F.concat(F.lit("y"), F.col("v") + 1899).alias("y"))
    return t.groupBy("island").pivot("y", [f"y{v + 1899}" for v in range(96, 103)]).count().na.fill(0)


@register("islands_by_longitude", f"WITH b AS ({_BOX}) SELECT id, x0, CAST(row_number() OVER (ORDER BY x0, id) AS INT) AS place FROM b")
def islands_by_longitude(spark, d):
    """All boxes from west to east; places run on over longitudes, so no task holds all rows."""
    b = boxes(spark, d).select("id", "x0")
    before = F.sum("n").over(Window.orderBy("x0").rowsBetween(Window.unboundedPreceding, -1))
    west = b.groupBy("x0").agg(F.count("*").alias("n")).select("x0", F.coalesce(before, F.lit(0)).alias("before"))
    placed = b.withColumn("within", F.row_number().over(Window.partitionBy("x0").orderBy("id"))).join(F.broadcast(west), "x0")
    return placed.select("id", "x0", (F.col("before") + F.col("within")).cast("int").alias("place")).orderBy("x0", "id")
