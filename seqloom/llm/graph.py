"""Connected components of a graph given by its edges, as DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, store


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(v, root) for every vertex of ``edges`` (a, b: long): the least vertex that it reaches.

    Each round gives a vertex the least label among its neighbours' and then its label's label. Labels reach a
    component's members in rounds that grow with the logarithm of its diameter for hubs and chains alike. Minima are
    combined in each task before they are shuffled, so a hub's many edges don't meet in one.
    """
    both = store(edges.select("a", "b").where("a <> b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")).where("a <> b")).distinct(), f"{name}-edges")
    label = store(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("root")), name)
    while True:
        near = both.join(label.select(F.col("v").alias("b"), "root"), "b").groupBy(F.col("a").alias("v")).agg(F.min("root").alias("m"))
        step = label.join(near, "v").select("v", F.least("root", "m").alias("n"), F.col("root").alias("was"))
        up = label.select(F.col("v").alias("n"), F.col("root").alias("up"))
        after = store(step.join(up, "n").select("v", F.least("n", "up").alias("root"), "was"), name)
        changed = after.where("root <> was").limit(1).count()
        discard(label)
        label = after
        if not changed:
            discard(both)
            return label.select("v", "root")
