"""Queries over selections that are empty or constant, against figures worked out by hand and their SQL, null and NaN told apart."""

import math
from datetime import datetime

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from terrafold.operators import analyses
from terrafold.plans import layers
from terrafold.plans.registry import all_oracles, all_queries

COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
NAN = "nan"


@pytest.fixture
def both(spark, tmp_path):
    """A query's rows as text, after its SQL gave the same, over line items (order, part, supplier, line, quantity, flag, year)."""

    def rows(name, items):
        folder = tmp_path / str(len(list(tmp_path.iterdir())))
        folder.mkdir()
        plain = [(o, p, s, n, float(q), f, datetime(y, 6, 1)) for o, p, s, n, q, f, y in items]
        pq.write_table(pa.table(dict(zip(COLUMNS, zip(*plain, strict=True), strict=True))), folder / "lineitem.parquet")
        con = duckdb.connect()
        con.execute(f"create view lineitem as select * from '{folder}/lineitem.parquet'")
        got = all_queries()[name](spark, str(folder))
        want = con.sql(all_oracles()[name])
        assert got.columns == want.columns
        got, want = (sorted(tuple(str(v) for v in r) for r in t) for t in (got.collect(), want.fetchall()))
        assert got == want
        return got

    return rows


def test_flagged_greenhouses_without_a_greenhouse(both):
    assert both("h12_flagged_greenhouses", [(1, 1, 1, 1, 10, "N", 1992)]) == [("None", "None", NAN)]
    assert both("h12_flagged_greenhouses", [(1, 1, 1, 1, 10, "N", 1996)])[0][1:] == ("50.0", "100.0")


def items(cells, quantity, year=1992, flag="N", supplier=1, line=1):
    """Line items whose cells of the first grid are cells (row, column)."""
    row, column = ({k * m % 200: k for k in range(200)} for m in (7919, 104729))
    return [(row[r], column[c], supplier, line, quantity, flag, year) for r, c in cells]


BOX = [(r, c) for r in range(110, 130) for c in range(120, 150)]
AREA = 8.983152841195216e-05**2 * 111132 * 111320 * math.cos(math.radians(28.09)) / 1e6  # km2 of a cell, to 4 digits


def test_percent_report_by_hand(both):
    """600 cells of the box at 50 %, confidence on the second grid; zones without confidence have NaN, and no zone is left out."""
    got = {r[0]: r[1:] for r in both("percent_histogram", items(BOX, 10))}
    assert got["box"][:3] == (str(round(300 * AREA, 2)), str(round(600 * AREA, 2)), str(round(600 * AREA, 2)))
    assert set(got) == {"box", "ring", "tri"} and got["ring"][:3] == ("0.0", "0.0", "0.0")
    sure = (10 * 3 + 1) % 130  # every confidence of these items
    assert got["box"][3:] in ((str(float(sure)), "100.0"), (NAN, NAN))
    codes = {r[0]: r[1:] for r in both("percent_histogram", items(BOX, 22))}  # 110 %: codes, which leave the box's other cells
    assert codes["box"][:3] == ("0.0", "0.0", "0.0")


def test_confidence_zeros_count_in_the_report_only(spark):
    """By hand: confidences 0, 50, 90, 120 and none on five cells of land, percentages on two of them."""
    land = spark.createDataFrame([("z", 0, c) for c in range(5)], "zone string, r int, c int")
    sure = spark.createDataFrame([(0, 0, 0), (0, 1, 50), (0, 2, 90), (0, 3, 120)], "r int, c int, v int")
    percent = spark.createDataFrame([(0, 1, 100), (0, 4, 101)], "r int, c int, v int")
    green = spark.createDataFrame([(0, 1)], "r int, c int")
    report = analyses.percent_report(percent, sure, land).first()
    assert (report.mean_confidence, report.low_pct) == (round(140 / 3, 1), round(200 / 3, 1))
    found = analyses.density_properties(percent, green, sure, land).first()
    assert (found.mean_confidence, found.low_pct, found.sealed_km2) == (70.0, 20.0, 0.0)
    assert analyses.density_properties(percent, green, sure.where("v > 200"), land).first()[2:] == (None, 0.0)
    nothing = analyses.density_properties(percent, green, sure, land.where("c > 9")).first()
    assert tuple(nothing) == (0.0, 0.0, None, 0.0)


def test_correlation_over_all_blocks_of_the_zone(both, spark):
    full = [(r, c) for r in range(200) for c in range(200)]
    assert both("fraction_correlation", items(full, 10)) == [("1.0", "1.0")]  # both fill the zone: shares are those of its border
    zone = spark.createDataFrame([(r, c) for r in range(4) for c in range(8)], "r int, c int")
    of = lambda *cells: spark.createDataFrame(list(cells), "r int, c int")
    # Eight blocks of 2 x 2: shares 1/2, 1/4 and zeros against 1/4, 0, 1/4 and zeros.
    a, b = of((0, 0), (0, 1), (0, 2)), of((0, 0), (2, 0), (50, 50))
    x, y = np.zeros(8), np.zeros(8)
    x[:2], y[0], y[4] = (0.5, 0.25), 0.25, 0.25
    got = analyses.grid_agreement(a, b, zone, 2).first()
    assert tuple(got) == (round(float(np.corrcoef(x, y)[0, 1]), 3), round(1 / 3, 3))
    none = analyses.grid_agreement(of((90, 90)), of((91, 91)), zone, 2).first()
    assert math.isnan(none.r) and math.isnan(none.jaccard)
    assert all(math.isnan(v) for v in analyses.grid_agreement(a, b, zone.where("r > 90"), 2).first())


def test_agreement_of_baseline_and_later_dates(both, spark):
    """By hand, one row of cells: shares are of the baseline's four and of the later three cells."""
    of = lambda *rows: spark.createDataFrame([(0, c, v) for c, v in rows], "r int, c int, v int")
    product = of((0, 10), (1, 10), (2, 10), (3, 10), (4, 20), (5, 20), (6, 20), (7, 255))
    register = of((0, 3), (1, 12), (2, 10), (4, 25), (5, 14), (8, 9), (9, 11), (3, 255))
    got = analyses.product_agreement(product, register, 10, 5).first().asDict()
    shares = {k: v for k, v in got.items() if k.endswith("pct")}
    assert shares == {"base_upto_pct": 50.0, "base_after_pct": 25.0, "base_none_pct": 25.0, "later_agree_pct": 33.3, "later_earlier_pct": 33.3, "later_later_pct": 0.0, "later_none_pct": 33.3}
    empty = analyses.product_agreement(product.where("v = 10"), register, 10).first().asDict()
    assert empty["later_km2"] == 0.0 and math.isnan(empty["later_agree_pct"])
    assert both("product_agreement", items(BOX, 10, 1996))[0][0] == "0.0"


def test_provenance_without_one_of_the_classes(both, spark):
    dated, undated = items(BOX, 10), items([(r, c - 60) for r, c in BOX], 10, flag="R")
    km2 = str(round(600 * AREA, 3))
    assert both("provenance_summary", dated) == [(km2, "0.0", "100.0")]
    assert both("provenance_summary", undated) == [("0.0", km2, "0.0")]
    assert both("provenance_summary", dated + undated)[0][2] == "50.0"
    assert both("provenance_summary", [dated[0], undated[0]]) == [("0.0", "0.0", NAN)]  # each rounds to 0
    assert str(layers.dated_share(spark.createDataFrame([], "r int, c int, v int")).first()[2]) == NAN


def test_change_areas_of_groups_that_were_not_built(both):
    # 93 % 6 = 3, 96 % 6 = 0 and 97 % 6 = 1 stand for unchanged_built, unchanged_non_built and new_built.
    south = next(o for o in range(200) if o * 7919 % 200 >= 100)
    rates = lambda *years: [r[-2:] for r in both("a14_change_areas", [(0, p, 1, 1, 10, "N", y) for p, y in enumerate(years)])]
    assert rates(1995) == [(NAN, NAN)]
    assert rates(1995, 1996) == [(NAN, NAN)]  # a rate of nothing, whatever was gained
    assert rates(1992, 1996) == [("0.0", "33.333")]
    assert len(both("a14_change_areas", [(0, 0, 1, 1, 10, "N", 1995), (south, 0, 1, 1, 10, "N", 1996)])) == 2


def test_layer_density_without_a_percentage_on_land(both):
    assert both("layer_density", items(BOX, 22)) == [("0.0",)]  # 110
    assert both("layer_density", items(BOX, 24)) == [("0.0",)]  # 0
    assert float(both("layer_density", items(BOX, 20))[0][0]) > 0.04
    assert both("layer_density", items([(0, 0)], 10)) == [("0.0",)]


def test_density_properties_of_codes_alone(both):
    assert both("a17_density_properties", items(BOX, 22))[0][:2] == ("0.0", "0.0")
    assert both("a17_density_properties", items([(0, 0)], 10))[0][:2] == ("0.0", "0.0")
