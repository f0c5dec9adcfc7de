"""Connected components by joins: least labels, hooked and shortened each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.llm.common import materialize


def components(edges: DataFrame, start: DataFrame | None = None, rounds: int | None = None) -> DataFrame:
    """edges: a, b (long). One row per vertex of an edge: v, c, the least vertex of its component.

    Per round every vertex takes the least label around it, labels that met pass
    the least on to all their vertices, and labels are followed one step, so
    long chains shrink by a factor each round. A vertex with very many edges is
    a hot key on the large side of a join, or is summed before the shuffle.
    start: labels (v, c) from a part of the edges. rounds: stop after so many;
    vertices with one label are connected then, but not all that are have one.
    """
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("c"))
    if start is not None:
        known = start.select("v", F.col("c").alias("known"))
        labels = labels.join(known, "v", "left").select("v", F.least("c", "known").alias("c"))
    labels = materialize(labels, "labels")
    done = 0
    while True:
        near = both.join(labels, both["b"] == labels["v"]).groupBy("a").agg(F.min("c").alias("m"))
        met = labels.join(near, labels["v"] == near["a"]).select("v", "c", F.least("c", "m").alias("c1"))
        hook = met.groupBy("c").agg(F.min("c1").alias("h")).select(F.col("c").alias("r"), "h")
        new = met.join(hook, F.col("c") == F.col("r"), "left").select("v", F.col("c").alias("old"), F.least("c1", F.coalesce("h", "c1")).alias("c"))
        step = new.select(F.col("v").alias("r"), F.col("c").alias("h"))
        new = new.join(step, F.col("c") == F.col("r"), "left").select("v", "old", F.least("c", F.coalesce("h", "c")).alias("c"))
        new = materialize(new, "labels")
        done += 1
        if done == rounds or new.filter("c != old").isEmpty():
            return new.select("v", "c")
        labels = new.select("v", "c")
