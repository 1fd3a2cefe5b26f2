"""Connected components of a mask: within tiles first, then between tiles over their borders only.

A tile of SIDE x SIDE cells is labelled by one task as runs of cells in rows (a group of 65,536 cells at
most). Components that touch a border are linked to those of the next tile, and labels spread over these
links alone, to the neighbours and to their label's label, until nothing changes: rounds and rows are those
of the borders, not of the cells. Each round is a written table, so a lost executor repeats one round.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.operators.cells import KEY, both, erode
from terrafold.sources.scratch import drop, written

SIDE = 256
#: Longer than any row of cells, so that a row and a column are one number.
_ROW = 1 << 31
_RUNS = "r int, c0 int, c1 int, lr int, lc int"


def labelled_runs(r: np.ndarray, c: np.ndarray, diagonal: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """r, c0, c1 of the runs of some cells, and for each run the index of the first run of its component."""
    key = np.unique(r.astype(np.int64) * _ROW + c)
    starts = np.flatnonzero(np.diff(key, prepend=key[0] - 2) != 1)
    first, last = key[starts], key[np.append(starts[1:], len(key)) - 1]
    reach = 1 if diagonal else 0
    # Runs of the row above that a run touches are neighbours in the order of runs.
    lo, hi = np.searchsorted(last, first - _ROW - reach), np.searchsorted(first, last - _ROW + reach, "right")
    n = np.maximum(hi - lo, 0)
    below = np.repeat(np.arange(len(first)), n)
    above = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    label = np.arange(len(first))
    while True:
        least = np.minimum(label[below], label[above])
        spread = label.copy()
        np.minimum.at(spread, label[below], least)
        np.minimum.at(spread, label[above], least)
        while True:
            further = spread[spread]
            if (further == spread).all():
                break
            spread = further
        spread = spread[label]
        if (spread == label).all():
            return first // _ROW, first % _ROW, last % _ROW, label
        label = spread


def _tile_runs(cells: DataFrame, diagonal: bool) -> DataFrame:
    """r, c0, c1 of the runs within each tile, and lr, lc: where the first run of their component in the tile begins."""
    def label(tile: pd.DataFrame) -> pd.DataFrame:
        r, c0, c1, first = labelled_runs(tile["r"].to_numpy(), tile["c"].to_numpy(), diagonal)
        return pd.DataFrame({"r": r, "c0": c0, "c1": c1, "lr": r[first], "lc": c0[first]}).astype("int32")

    tile = lambda x: F.floor(F.col(x) / SIDE).alias(f"t{x}")
    return cells.select(F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c")).groupBy(tile("r"), tile("c")).applyInPandas(label, _RUNS)


def _links(runs: DataFrame, diagonal: bool) -> DataFrame:
    """a, b: components of neighbouring tiles that touch, both ways; only runs on a border are looked at."""
    c = F.col
    border = runs.where((c("c0") % SIDE == 0) | ((c("c1") + 1) % SIDE == 0) | (c("r") % SIDE == 0) | ((c("r") + 1) % SIDE == 0)).withColumn("id", F.struct("lr", "lc"))
    tile = lambda x: F.floor(x / SIDE)
    side = border.where((c("c1") + 1) % SIDE == 0).select(c("id").alias("a"), c("r").alias("row"), (c("c1") + 1).alias("lo"), (c("c1") + 1).alias("hi"))
    reach = 1 if diagonal else 0
    down = border.select(c("id").alias("a"), (c("r") + 1).alias("row"), (c("c0") - reach).alias("lo"), (c("c1") + reach).alias("hi"))
    asked = side.union(down).withColumn("tile", F.explode(F.sequence(tile(c("lo")), tile(c("hi")))))
    held = border.select(c("id").alias("b"), c("r").alias("row"), "c0", "c1", tile(c("c0")).alias("tile"))
    met = asked.join(held, ["row", "tile"]).where((c("c0") <= c("hi")) & (c("c1") >= c("lo")) & (c("a") != c("b"))).select("a", "b")
    return met.union(met.select("b", "a")).distinct()


def _spread(links: DataFrame) -> DataFrame:
    """id, label: the least component that each one is linked to over any number of links."""
    labels = links.select(F.col("a").alias("id")).distinct().select("id", F.col("id").alias("label"))
    last: tuple[DataFrame, ...] = ()
    while True:
        near = links.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        spread = written(labels.join(near, "id").select("id", F.least("label", "near").alias("label"), F.col("label").alias("old")), "spread")
        far = spread.select(F.col("id").alias("label"), F.col("label").alias("far"))
        fresh = written(spread.join(far, "label").select("id", F.least("label", "far").alias("label"), "old"), "labels")
        drop(spread, *last)
        labels, last = fresh.select("id", "label"), (fresh,)
        if not fresh.where(F.col("label") != F.col("old")).head(1):
            return labels


def label_runs(cells: DataFrame, diagonal: bool = True) -> DataFrame:
    """r, c0, c1, label: runs of cells in a row, cut at tiles; the label (r, c0) is where the component's first run begins."""
    runs = written(_tile_runs(cells, diagonal), "runs")
    links = written(_links(runs, diagonal), "links")
    own = F.struct(F.col("lr").alias("r"), F.col("lc").alias("c0"))
    if not links.head(1):
        return runs.select("r", "c0", "c1", own.alias("label"))
    labels = _spread(links).select(F.col("id.lr").alias("lr"), F.col("id.lc").alias("lc"), F.struct(F.col("label.lr").alias("r"), F.col("label.lc").alias("c0")).alias("far"))
    return runs.join(labels, ["lr", "lc"], "left").select("r", "c0", "c1", F.coalesce("far", own).alias("label"))


def patches(cells: DataFrame, diagonal: bool = True) -> DataFrame:
    """label, size: cells of each connected patch."""
    return label_runs(cells, diagonal).groupBy("label").agg(F.sum(F.col("c1") - F.col("c0") + 1).alias("size"))


def patch_summary(cells: DataFrame, small: int = 4, large: int = 100) -> DataFrame:
    """patches, largest, second, median_size, small_pct (patches of small cells or fewer), large_area_pct (cells in patches of large or more)."""
    sizes = patches(cells).groupBy("size").agg(F.count("*").alias("n"))
    all_patches, size, n = F.sum("n"), F.col("size"), F.col("n")
    # One row per size: a handful, whatever the number of patches.
    top = F.slice(F.sort_array(F.flatten(F.collect_list(F.array_repeat("size", F.least(n, F.lit(2)).cast("int")))), False), 1, 2)
    return sizes.agg(
        all_patches.alias("patches"), F.get(top, F.lit(0)).alias("largest"), F.get(top, F.lit(1)).alias("second"), F.expr("percentile(size, 0.5D, n)").alias("median_size"),
        F.round(100.0 * F.sum(F.when(size <= small, n).otherwise(0)) / F.nullif(all_patches, F.lit(0)), 4).alias("small_pct"),
        F.round(100.0 * F.sum(F.when(size >= large, n * size).otherwise(0)) / F.nullif(F.sum(n * size), F.lit(0)), 4).alias("large_area_pct"))


def propagate(seeds: DataFrame, mask: DataFrame) -> DataFrame:
    """Cells of the mask whose 4-connected component holds a seed."""
    labelled = label_runs(mask, diagonal=False)
    cells = labelled.select("r", F.explode(F.sequence("c0", "c1")).alias("c"), "label")
    hit = cells.join(seeds.select(*KEY), KEY, "left_semi").select("label").distinct()
    return cells.join(hit, "label", "left_semi").select(*KEY)


def compact_only(cells: DataFrame) -> DataFrame:
    """Components that keep a core when eroded; an empty mask stays empty."""
    return propagate(both(cells.select(*KEY), erode(cells)), cells)
