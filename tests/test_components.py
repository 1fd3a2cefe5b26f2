"""Components and nearest cells over many small tiles, against a flood fill and a scan of all cells."""

import math
import random

import numpy as np
import pytest

from terrafold.operators import cells as C
from terrafold.operators import components


def flood(cells, diagonal):
    """cell -> the component's first cell in order of rows and columns."""
    steps = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) != (0, 0) and (diagonal or i == 0 or j == 0)]
    out, left = {}, set(cells)
    for start in sorted(cells):
        if start in left:
            todo = [start]
            left.discard(start)
            while todo:
                r, c = todo.pop()
                out[r, c] = start
                for i, j in steps:
                    if (r + i, c + j) in left:
                        left.discard((r + i, c + j))
                        todo.append((r + i, c + j))
    return out


def spiral(n):
    """One path of cells that winds inwards with a gap between its turns."""
    grid, r, c, d = np.zeros((n, n), bool), 0, 0, 0
    moves, top, left, bottom, right = [], 0, 0, n - 1, n - 1
    while top <= bottom and left <= right:
        moves += [(top, k) for k in range(max(0, left - 1), right + 1)] + [(k, right) for k in range(top, bottom + 1)] + [(bottom, k) for k in range(right, left - 1, -1)] + [(k, left) for k in range(bottom, top + 1, -1)]
        top, left, bottom, right = top + 2, left + 2, bottom - 2, right - 2
    return sorted(set(moves))


@pytest.mark.parametrize("diagonal", [True, False])
@pytest.mark.parametrize("side", [4, 7, 256])
def test_labels_equal_a_flood_fill(spark, monkeypatch, diagonal, side):
    monkeypatch.setattr(components, "SIDE", side)
    r = random.Random(side)
    masks = [[(i, j) for i in range(40) for j in range(40) if r.random() < p] for p in (0.35, 0.55)] + [spiral(31), [(0, 0)], []]
    for mask in masks:
        df = spark.createDataFrame([*mask, *mask[:3]], "r int, c int")
        runs = components.label_runs(df, diagonal).collect()
        got = {(x.r, c): (x.label.r, x.label.c0) for x in runs for c in range(x.c0, x.c1 + 1)}
        assert got == flood(mask, diagonal)


def test_large_spiral_in_one_tile():
    r, c = (np.array(x) for x in zip(*spiral(101), strict=True))
    label = components.labelled_runs(r, c, False)[3]
    assert set(label.tolist()) == {0}


@pytest.mark.parametrize("band", [5, 64, 4096])
def test_nearest_cells_equal_a_scan(spark, monkeypatch, band):
    monkeypatch.setattr(C, "BAND", band)
    r = random.Random(band)
    cells = list({(r.randrange(60), r.randrange(60)) for _ in range(60)})
    points = [(k, r.randrange(60), r.randrange(60)) for k in range(80)] + [(80, *cells[0]), (81, 500, 500), (82, -3, -3)]
    got = {x.id: x.metres for x in C.nearest_distance(spark.createDataFrame(points, "id int, r int, c int"), spark.createDataFrame([*cells, cells[0]], "r int, c int"), 9, 9.93, 8.82).collect()}
    for k, pr, pc in points:
        near = [math.hypot((a - pr) * 9.93, (b - pc) * 8.82) for a, b in cells if abs(a - pr) <= 9 and abs(b - pc) <= 9]
        assert got[k] == (pytest.approx(min(near), abs=1e-6) if near else None)
    assert len(got) == len(points)
