"""Seam, status, tolerance and direction records, against figures worked out by hand."""

import math

from terrafold.operators import records


def km2(spark, r, n):
    """n cells of row r."""
    from pyspark.sql import functions as F

    from terrafold.functions.grid import row_area

    return n * spark.range(1).select(row_area(F.lit(r))).first()[0] / 1e6


def test_seam_record(spark):
    of = lambda cells, kind="r int, c int, v int": spark.createDataFrame(cells, kind)
    block = [(0, c) for c in range(400)]
    zones = of([("x", *k) for k in block] + [("y", 1, c) for c in range(400)], "island string, r int, c int")
    years = of([(0, c, 80) for c in range(300)] + [(0, c, 118) for c in range(300, 310)] + [(0, 310, 255)])
    base = of([(0, c, 1) for c in range(150)])
    tracker = of([(0, c, 1) for c in range(200)] + [(0, c, 2) for c in range(200, 300)])
    green = of([(0, c) for c in range(50)] * 2, "r int, c int")
    got = {r.island: r for r in records.seam_record(years, base, tracker, green, zones, of([("x", 2019)], "island string, year int")).collect()}
    evo, wsf, trk, free = (round(km2(spark, 0, n), 2) for n in (300, 150, 200, 150))
    x = got["x"]
    assert (x.evo30, x.wsf15, x.trk_e1, x.trk_e1_nogh, x.greenhouse_survey_year) == (evo, wsf, trk, free, 2019)
    assert (x.resolution_factor, x.definition_factor_raw, x.definition_factor_masked, x.net_evo_to_tracker_masked) == tuple(round(a / b, 2) for a, b in ((evo, wsf), (trk, wsf), (free, wsf), (free, evo)))
    assert x.greenhouse_removed_km2 == round(trk - free, 2)
    y = got["y"]
    assert (y.evo30, y.greenhouse_survey_year) == (0.0, None) and all(math.isnan(v) for v in (y.resolution_factor, y.definition_factor_raw, y.net_evo_to_tracker_masked))


def test_status_report(spark):
    of = lambda rows, kind: spark.createDataFrame(rows, kind)
    s = [("a", "first")] * 130 + [("a", "middle")] * 200 + [("a", "last")] * 251 + [("b", "last")] * 60
    c = [("a", 1)] * 3 + [("a", 2)] * 2 + [("a", 0)] * 9 + [("c", 2)]
    got = {r.island: tuple(r)[1:] for r in records.status_report(of(s, "island string, status string"), of(c, "island string, v int"), 0.01, 0.04, 3).collect()}
    assert got["a"] == (1.3, 2.0, 2.51, 0.12, 0.08, round(100 * 0.08 / 2 / 3, 3))
    assert got["b"][:5] == (0.0, 0.0, 0.6, 0.0, 0.0) and math.isnan(got["b"][5]) and math.isnan(got["c"][5])
    assert got[None] == (1.3, 2.0, 3.11, 0.12, 0.12, round(100 * 0.12 / 2 / 3, 3))
    assert records.status_report(of([], "island string, status string"), of([], "island string, v int"), 0.01, 0.04, 3).collect() == []


def test_verdicts_with_tolerance(spark):
    cells = spark.createDataFrame([(5, 5, 100), (5, 6, 118), (20, 20, 255)] + [(r, c, 90) for r in range(40, 43) for c in range(40, 43)], "r int, c int, v int")
    before, new, none = records.OBSERVABLE
    points = [(1, 5, 5, before, before), (2, 5, 5, before, new), (3, 5, 7, none, new), (4, 5, 8, none, new), (5, 20, 20, "undated", before), (6, 5, 5, before, none), (7, 41, 41, before, none), (8, 5, 5, before, None), (9, 20, 21, none, before)]
    got = {r.id: r.tolerated for r in records.verdicts(spark.createDataFrame(points, "id int, r int, c int, stratum string, reference string"), cells, 1).collect()}
    assert got == {1: before, 2: before, 3: none, 4: new, 5: before, 6: before, 7: none, 9: before}
    strict = {r.id: r.tolerated for r in records.verdicts(spark.createDataFrame(points, "id int, r int, c int, stratum string, reference string"), cells, 0).collect()}
    assert strict == {p[0]: p[4] for p in points if p[4]}


def test_label_changes(spark):
    a = [(1, "built", "built"), (2, "empty", "built"), (3, "built", None), (4, None, None), (5, "empty", "empty"), (6, None, "built"), (7, "built", "x")]
    b = [(1, "built", "built"), (2, "built", "built"), (3, "empty", None), (4, "built", "built"), (5, "built", "empty"), (6, None, None), (7, "built", "y"), (8, "built", "z")]
    strata = [(1, "undated"), (2, "built_before_2015"), (3, "undated"), (5, "not_built"), (7, "not_built")]
    of = lambda t: spark.createDataFrame(t, "id int, early string, late string")
    got = {r.stratum: tuple(r)[1:] for r in records.label_changes(of(a), of(b), spark.createDataFrame(strata, "id int, stratum string")).collect()}
    assert got == {"undated": (2, 1, 50.0, 0, 1), "built_before_2015": (1, 1, 100.0, 1, 0), "not_built": (2, 2, 100.0, 0, 1)}
