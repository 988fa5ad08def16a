"""Empirical variant scores: features, forests of decision trees, and their training."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric

#: Germline SNV features by name, as Columns of a call's row.
GERMLINE_SNV = {
    "genotype_category": lambda: F.when(F.size(F.array_distinct(F.split("gt", "[/|]"))) == 1, 1).when(F.array_contains(F.split("gt", "[/|]"), "0"), 0).otherwise(2).cast("double"),
    "mapq_rms": lambda: F.col("mapq_rms").cast("double"),
    "homopolymer": lambda: F.col("hpol").cast("double"),
    "strand_bias": lambda: F.col("strand_bias").cast("double"),
    "mapq_rank_sum": lambda: F.col("mapq_rank_sum").cast("double"),
    "read_pos_rank_sum": lambda: F.col("read_pos_rank_sum").cast("double"),
    "depth_norm": lambda: F.when(F.col("chrom_depth") > 0, (F.col("dp") + F.col("dpf")) / F.col("chrom_depth")).otherwise(1.0),
    "used_fraction": lambda: numeric.safe_frac(F.col("dp"), F.col("dp") + F.col("dpf")),
    "gqx": lambda: F.col("gqx").cast("double"),
    "alt_haplotype_ratio": lambda: F.coalesce(F.col("alt_haplotype_ratio").cast("double"), F.lit(-1.0)),
}


def features(calls: DataFrame, table: dict = GERMLINE_SNV) -> DataFrame:
    """Calls with ``features``, an array in the table's order."""
    return calls.withColumn("features", F.array(*(f() for f in table.values())))


def parse_forest(text: str) -> list[list[tuple]]:
    """Trees from JSON: each a list of nodes (left, right, feature, threshold, share of false votes); leaves have left -1."""
    trees = []
    for t in json.loads(text)["trees"]:
        trees.append([(n.get("left", -1), n.get("right", -1), n.get("feature", -1), n.get("threshold", 0.0), n["votes"][0] / max(1, sum(n["votes"])) if n.get("votes") else 0.0) for n in t])
    return trees


def forest_probability(trees: list[list[tuple]], x: np.ndarray) -> np.ndarray:
    """The mean over trees of the leaves' shares of false votes, for each row of ``x``; all rows go down a tree together."""
    total = np.zeros(len(x))
    for tree in trees:
        left, right, feature, threshold, share = (np.array(c) for c in zip(*tree, strict=True))
        at = np.zeros(len(x), np.int64)
        while (inner := left[at] >= 0).any():
            i = np.flatnonzero(inner)
            n = at[i]
            at[i] = np.where(x[i, feature[n]] <= threshold[n], left[n], right[n])
        total += share[at]
    return total / max(1, len(trees))


def forest_score(rows: DataFrame, trees: list[list[tuple]], power: float = 1.0, scale: float = 1.0, most: int = 60) -> DataFrame:
    """Rows (features) with ``evs``, the calibrated chance of a false call as a phred score."""
    sent = rows.sparkSession.sparkContext.broadcast(trees)  # a model's size doesn't follow the data's

    def go(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            p = forest_probability(sent.value, np.array(pdf.features.tolist(), float)) if len(pdf) else np.empty(0)
            p = np.clip(scale * p**power, 0, 1)
            yield pdf.assign(evs=np.minimum(most, np.floor(-10 * np.log10(np.maximum(p, 1e-300)) + 0.5)).astype("int64"))

    return rows.mapInPandas(go, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", evs long")


def train_forest(rows: DataFrame, label: str = "label", trees: int = 50, depth: int = 12, least: int = 50, seed: int = 1):
    """A forest fitted by Spark ML to rows (features array, label 1 for false calls)."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    data = rows.select(array_to_vector(F.col("features")).alias("features"), F.col(label).cast("double").alias("label"))
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=least, seed=seed).fit(data)


def forest_trees(model) -> list[list[tuple]]:
    """A fitted forest's trees in the form of ``parse_forest``."""

    def walk(node, out: list) -> int:
        at = len(out)
        out.append(None)
        stats = list(node.impurityStats().stats())
        share = stats[1] / max(1e-12, sum(stats)) if len(stats) > 1 else 0.0
        if node.subtreeDepth() == 0:
            out[at] = (-1, -1, -1, 0.0, share)
        else:
            l, r = walk(node.leftChild(), out), walk(node.rightChild(), out)
            out[at] = (l, r, node.split().featureIndex(), node.split().threshold(), share)
        return at

    result = []
    for t in model.trees:
        nodes: list = []
        walk(t._java_obj.rootNode(), nodes)
        result.append(nodes)
    return result


def allele_bias(alt: int, ref: int) -> tuple[float, float]:
    """-ln of both tails of a fair binomial, with a little added so that none is infinite."""
    from ..functions.stats import binom_upper

    n = alt + ref
    low, high = 1 - binom_upper(n, alt + 1, 0.5), binom_upper(n, alt, 0.5)
    return -math.log(low + 1e-30), -math.log(high + 1e-30)
