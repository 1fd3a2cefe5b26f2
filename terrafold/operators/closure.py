"""What can be reached over links: a semi-naive closure to its fixed point, however long the chains are.

Each round follows the frontier over HOPS links in one job and keeps what was not reached before; the
frontier and what has been reached are written tables, so plans do not grow with the rounds. Rounds are
the longest shortest path over HOPS; cycles end because nothing new is found.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.sources.scratch import drop, written

HOPS = 4


def reachable(links: DataFrame, roots: DataFrame, hops: int = HOPS) -> DataFrame:
    """path: the roots (path) and everything they reach over links (path, target); null paths and targets lead nowhere."""
    edges = written(links.select("path", F.col("target").alias("to")).where("path is not null and `to` is not null").distinct(), "links")
    seen = written(roots.select("path").where("path is not null").distinct(), "reached")
    front = seen
    while True:
        steps, ahead = None, front
        for _ in range(hops):
            ahead = edges.join(ahead, "path", "left_semi").select(F.col("to").alias("path")).distinct()
            steps = ahead if steps is None else steps.union(ahead)
        fresh = written(steps.distinct().join(seen, "path", "left_anti"), "front")
        if not fresh.head(1):
            drop(edges, front, fresh)  # the last frontier is all of seen only if nothing was reached
            return seen if front is not seen else roots.select("path").where("path is not null").distinct()
        grown = written(seen.union(fresh), "reached")
        drop(*{id(t): t for t in (seen, front)}.values())
        seen, front = grown, fresh


def import_closure(imports: DataFrame, root: str) -> DataFrame:
    """path: what the root reaches over imports (path, target), the root included."""
    return reachable(imports, imports.sparkSession.createDataFrame([(root,)], "path string"))
