"""The equal-area projection there and back, and products brought to cells in degrees, against plain arithmetic."""

import math

import pytest
from pyspark.sql import functions as F

from terrafold.functions import grid as G
from terrafold.operators import reproject


def test_projection_there_and_back(spark):
    points = [(lon + 0.37, lat + 0.11) for lon in range(-30, 41, 5) for lat in range(20, 76, 5)] + [(10.0, 52.0), (10.0, 20.0), (-17.9, 28.6)]
    df = spark.createDataFrame(points, "lon double, lat double")
    x, y = G.laea(F.col("lon"), F.col("lat"))
    there = df.select("lon", "lat", x.alias("x"), y.alias("y"))
    lon, lat = G.laea_inverse(F.col("x"), F.col("y"))
    back = there.select("lon", "lat", "x", "y", lon.alias("lon2"), lat.alias("lat2")).collect()
    assert max(abs(r.lon - r.lon2) for r in back) < 1e-9 and max(abs(r.lat - r.lat2) for r in back) < 1e-9
    centre = next(r for r in back if (r.lon, r.lat) == (10.0, 52.0))
    assert (centre.x, centre.y) == pytest.approx((4321000.0, 3210000.0), abs=1e-6)
    # Areas are kept: a small box measures in metres what it measures on the ellipsoid.
    a, e2, d = 6378137.0, G.laea_constants()["e2"], 1e-4
    for lon0, lat0 in ((-15.5, 28.1), (25.0, 65.0)):
        corners = spark.createDataFrame([(lon0 + i * d, lat0 + j * d) for i, j in ((0, 0), (1, 0), (1, 1), (0, 1))], "lon double, lat double")
        p = [(r.x, r.y) for r in corners.select(*[v.alias(n) for v, n in zip(G.laea(F.col("lon"), F.col("lat")), "xy", strict=True)]).collect()]
        p = [(u - p[0][0], v - p[0][1]) for u, v in p]
        area = abs(sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(p, [*p[1:], p[0]], strict=True))) / 2
        s = math.sin(math.radians(lat0 + d / 2))
        true = math.radians(d) ** 2 * a * a * (1 - e2) * math.cos(math.radians(lat0 + d / 2)) / (1 - e2 * s * s) ** 2
        assert area == pytest.approx(true, rel=1e-5)


def test_merge_takes_the_first_data(spark):
    pieces = spark.createDataFrame([(2, 0, 0, 5), (1, 0, 0, 240), (1, 0, 1, 7), (2, 0, 1, 8), (1, 1, 1, 240), (3, 2, 2, 255)], "piece int, r int, c int, v int")
    assert sorted(map(tuple, reproject.merged(pieces, 240).collect())) == [(0, 0, 5), (0, 1, 7), (2, 2, 255)]


@pytest.mark.parametrize("how", ["nearest", "bilinear"])
def test_values_on_the_grid(spark, how):
    x0, y0, m, nodata = 1_809_400.0, 984_125.0, 10.0, 255
    source = {(r, c): (nodata if (r + c) % 5 == 0 else (r * 7 + c * 3) % 100) for r in range(12) for c in range(12)}
    target = [(r, c) for r in range(14) for c in range(14)]
    df = spark.createDataFrame(target, "r int, c int")
    x, y = G.laea(G.lon_of(F.col("c")), G.lat_of(F.col("r")))
    at = {(r.r, r.c): ((r.x - x0) / m, (y0 - r.y) / m) for r in df.select("r", "c", x.alias("x"), y.alias("y")).collect()}
    want = {}
    for cell, (fx, fy) in at.items():
        if how == "nearest":
            want[cell] = source.get((math.floor(fy), math.floor(fx)), nodata)
            continue
        r0, c0 = math.floor(fy - 0.5), math.floor(fx - 0.5)
        near = [(source.get((r0 + i, c0 + j), nodata), (1 - abs(fy - 0.5 - r0 - i)) * (1 - abs(fx - 0.5 - c0 - j))) for i in (0, 1) for j in (0, 1)]
        near = [(v, w) for v, w in near if v != nodata and w > 0]
        want[cell] = round(sum(v * w for v, w in near) / sum(w for _, w in near), 3) if near else float(nodata)
    held = spark.createDataFrame([(*k, v) for k, v in source.items()], "r int, c int, v int")
    got = {(r.r, r.c): r.v for r in reproject.on_grid(df, held, nodata, x0, y0, m, how).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 2e-3 for k in want) and len(set(want.values())) > 20
    lon = {(r.r, r.c): r for r in reproject.degrees(held, x0, y0, m).collect()}
    ax, ay = G.laea(F.lit(lon[3, 4].lon), F.lit(lon[3, 4].lat))
    assert tuple(spark.range(1).select(ax, ay).first()) == pytest.approx((x0 + 45.0, y0 - 35.0), abs=1e-4)
    with pytest.raises(ValueError, match="unknown resampling"):
        reproject.on_grid(df, held, nodata, x0, y0, m, "cubic")
