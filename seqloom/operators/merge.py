"""Merging and ordering call sets, and dividing contigs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def priority_merge(first: DataFrame, second: DataFrame, key: list[str], order: list[str], passes: Column) -> DataFrame:
    """One row a key: ``first``'s first row that passes, else ``second``'s first row. Rows of ``first`` that don't pass never come out."""
    w = Window.partitionBy(*key).orderBy(*order)
    a = first.where(passes).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    b = second.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n").join(a, key, "left_anti")
    return a.withColumn("source", F.lit(1)).unionByName(b.withColumn("source", F.lit(2)), allowMissingColumns=True)


def best_of_equal(rows: DataFrame, key: list[str], better: list[Column]) -> DataFrame:
    """Of rows with equal keys the one that comes first by ``better``."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*better))).where("_n = 1").drop("_n")


def call_order(calls: DataFrame, contigs: DataFrame, chrom: str = "chrom", pos: str = "pos") -> DataFrame:
    """Calls in the order of the contig table (contig_id, name), then position; contigs that it lacks come last, by name. The table is one of contigs: small."""
    c = F.broadcast(contigs.select(F.col("name").alias(chrom), F.col("contig_id").alias("_o")))
    return calls.join(c, chrom, "left").orderBy(F.col("_o").asc_nulls_last(), chrom, pos).drop("_o")


def ordered_union(parts: list[DataFrame], partition: list[str], order: list[str]) -> DataFrame:
    """Streams merged by position; at ties the earlier stream comes first (``_stream``). Sorted within ranges of the partition."""
    tagged = [p.withColumn("_stream", F.lit(i)) for i, p in enumerate(parts)]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return both.repartition(*partition).sortWithinPartitions(*partition, *order, "_stream")


def sorted_segments(alignments: DataFrame, chunk: int, contig: str = "contig_id", pos: str = "pos", ties: tuple[str, ...] = ("src_rank", "src_ord")) -> DataFrame:
    """Alignments with their segment, sorted by position within it; equal positions keep the producers' order."""
    s = alignments.withColumn("segment_id", F.floor((F.col(pos) - 1) / chunk).cast("int"))
    return s.repartition(contig, "segment_id").sortWithinPartitions(contig, "segment_id", pos, *ties)


def chunk_size(lengths: list[int], wanted: int) -> tuple[int, int, int]:
    """(chunks, most chunks of a contig, size): the size is halved from the longest contig until there are ``wanted`` chunks, then doubled if it was halved."""
    size = longest = max(lengths)
    while sum(-(-n // size) for n in lengths) < wanted and size > 1:
        size //= 2
    if size < longest:
        size *= 2
    return sum(-(-n // size) for n in lengths), max(-(-n // size) for n in lengths), size


def equal_segments(length: int, size: int) -> list[tuple[int, int]]:
    """[begin, end) pieces of nearly equal length, none longer than ``size``; the longer ones come first."""
    n = max(1, -(-length // size))
    base, more = divmod(length, n)
    out, at = [], 0
    for i in range(n):
        step = base + (i < more)
        out.append((at, at + step))
        at += step
    return out


def group_small(contigs: DataFrame, most: int = 200_000) -> DataFrame:
    """Contigs with ``bin``: in their order, those that fit together up to ``most`` bases share one. A row for each contig."""
    w = Window.orderBy("contig_id").rowsBetween(Window.unboundedPreceding, -1)
    return contigs.withColumn("bin", F.floor(F.coalesce(F.sum("length").over(w), F.lit(0)) / most).cast("int"))


def check_contigs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Contigs (name, length) that the two tables don't agree on."""
    x, y = a.select("name", "length"), b.select("name", "length")
    return x.exceptAll(y).withColumn("only_in", F.lit(1)).unionByName(y.exceptAll(x).withColumn("only_in", F.lit(2)))
