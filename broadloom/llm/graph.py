"""Connected components of a graph given as edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadloom.llm.common import forget, stored


#: Edges a task takes at least: a small graph isn't spread over hundreds of tasks.
TASK_EDGES = 100_000


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    star = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return star.where("a > b").coalesce(tasks).distinct().coalesce(tasks)


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    onto = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    star = onto.union(least.select("a", F.col("m").alias("b")))
    return star.where("a > b").coalesce(tasks).distinct().coalesce(tasks)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b), the component being its smallest node.

    Each round writes its edges to the shared folder.  Grouping combines before
    the shuffle and joins on a hub are split at run time, so a node with a third
    of all edges is no single task.  Self-links, repeated and null ends are left out.
    """
    now = stored(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")

    def measured(rows: DataFrame) -> tuple:
        return tuple(rows.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())

    mark = measured(now)
    for _ in range(most_rounds):
        tasks = 1 + mark[0] // TASK_EDGES
        before, now = now, stored(_small_star(_large_star(now, tasks), tasks), "edges")
        forget(before)
        seen, mark = mark, measured(now)
        if seen == mark:
            break
    else:
        raise RuntimeError("components did not settle")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = stars.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
    out.parts = [now]  # what it reads, for ``forget``
    return out
