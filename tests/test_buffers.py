"""Buffers of lines against the distance test of every cell, extracts of infrastructure, and tiers of control areas."""

import json
import math
import random

import pytest

from terrafold.operators import buffers, spans
from terrafold.sources import ways


def distance(px, py, ax, ay, bx, by):
    dx, dy = bx - ax, by - ay
    t = 0.0 if dx == dy == 0 else min(1.0, max(0.0, ((px - ax) * dx + (py - ay) * dy) / (dx * dx + dy * dy)))
    return math.hypot(px - ax - t * dx, py - ay - t * dy)


@pytest.mark.parametrize(("metres", "north", "east"), [(30.0, 9.93, 8.82), (5.0, 10.0, 10.0), (80.0, 3.0, 7.0)])
def test_buffers_equal_the_distance_test(spark, metres, north, east):
    r = random.Random(int(metres))
    lines = [tuple(r.uniform(-5, 65) for _ in range(4)) for _ in range(40)]
    lines += [(10, 10, 10, 10), (20.5, 5, 20.5, 40), (5, 30.5, 50, 30.5), (1.25, 1.25, 1.25, 1.75), (30, 30, 20, 20)]
    df = spark.createDataFrame([*[tuple(map(float, x)) for x in lines], (None, 1.0, 2.0, 3.0)], "x1 double, y1 double, x2 double, y2 double")
    found = [tuple(x) for x in buffers.buffer_spans(df, metres, north, east).collect()]
    got = [(row, c) for row, c0, c1 in found for c in range(c0, c1 + 1)]
    assert len(got) == len(set(got))  # united: no cell twice
    reach = [int(metres // m) + 2 for m in (north, east)]
    want, doubt = set(), set()
    for row in range(-6 - reach[0], 67 + reach[0]):
        for c in range(-6 - reach[1], 67 + reach[1]):
            near = min(distance((c + 0.5) * east, (row + 0.5) * north, x1 * east, y1 * north, x2 * east, y2 * north) for x1, y1, x2, y2 in lines)
            if near <= metres:
                want.add((row, c))
            if abs(near - metres) < 1e-9:
                doubt.add((row, c))
    assert (set(got) ^ want) <= doubt and len(want) > 500


def test_spans_are_united_within_tiles(spark):
    t = buffers.TILE
    df = spark.createDataFrame([(0, 5, 9), (0, 0, 6), (0, 10, 12), (0, 14, 14), (0, t - 2, t + 1), (1, 0, 3), (0, 2, 3)], "r int, c0 int, c1 int")
    assert sorted(map(tuple, buffers.united(df).collect())) == [(0, 0, 12), (0, 14, 14), (0, t - 2, t - 1), (0, t, t + 1), (1, 0, 3)]


def test_extracts_become_lines_and_polygons(spark, tmp_path):
    at = lambda *p: [{"lat": y, "lon": x} for x, y in p]
    box = at((10, 10), (20, 10), (20, 20), (10, 20), (10, 10))
    elements = [
        {"type": "way", "id": 1, "tags": {"building": "yes", "name": "x"}, "geometry": box}, {"type": "way", "id": 2, "tags": {"highway": "track"}, "geometry": at((0, 0), (5, 0), (5, 5))},
        {"type": "way", "id": 3, "tags": {"building": "yes"}, "geometry": at((30, 30), (31, 30), (30, 30))}, {"type": "way", "id": 4, "geometry": at((1, 1))}, {"type": "node", "id": 5}, {"type": "way", "id": 6, "tags": {"highway": "road"}, "geometry": box}]
    (tmp_path / "a.json").write_text(json.dumps({"version": 0.6, "elements": elements}, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"elements": []}))
    found = ways.read_ways(spark, str(tmp_path))
    assert sorted((r.id, r.closed, len(r.points)) for r in found.collect()) == [(1, True, 5), (2, False, 3), (3, False, 3), (6, False, 5)]
    lines, polygons = ways.segments(found), ways.rings(found)
    assert lines.count() == 4 + 2 + 2 + 4 and [(r.x, r.y) for r in polygons.orderBy("seq").collect()] == [(10, 10), (20, 10), (20, 20), (10, 20)]
    near = buffers.infrastructure(lines.where("id = 1"), polygons, 1.0, 1.0, 1.0)
    cells = spark.createDataFrame([(r, c, 1) for r in range(40) for c in range(40)], "r int, c int, v int")
    kept = {(x.r, x.c) for x in buffers.outside(cells, near).collect()}
    inner = {(r, c) for r in range(40) for c in range(40) if 10 <= r + 0.5 < 20 and 10 <= c + 0.5 < 20}
    edge = {(r, c) for r in range(40) for c in range(40) if any(distance(c + 0.5, r + 0.5, *a, *b) <= 1 for a, b in zip([(10, 10), (20, 10), (20, 20), (10, 20)], [(20, 10), (20, 20), (10, 20), (10, 10)], strict=True))}
    assert kept == {(r, c) for r in range(40) for c in range(40)} - inner - edge and spans.spans(polygons).count() == 10


def test_tiers_fall_back_and_raise(spark):
    areas = spark.createDataFrame([("a", "p", 1), ("a", "q", 2), ("b", "r", 2), ("b", "s", 2), ("c", "t", 3), ("d", "u", 1)], "island string, zone string, tier int")
    islands = spark.createDataFrame([(x,) for x in "abcde"], "island string")
    got = sorted((r.island, r.label or "", r.zone or "") for r in buffers.control_tiers(areas, islands, ("d",)).collect())
    assert got == [("a", "tier 1", "p"), ("b", "tier 1+2", "r"), ("b", "tier 1+2", "s"), ("c", "", ""), ("d", "", ""), ("e", "", "")]
    with pytest.raises(Exception, match="no protected area qualifies as a control on c"):
        buffers.control_tiers(areas, islands.where("island = 'c'"), strict=True).collect()
