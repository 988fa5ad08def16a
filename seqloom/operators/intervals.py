"""Intervals and ordered keys: overlap joins, coalescing, islands, depth, as-of joins. All are compositions of DataFrame operators.

Intervals are half-open [start, end) on a contig (any partitioning key) unless a function says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: How many tolerances a stretch of a key is long in ``asof_forward``.
SPREAD = 64


def _bins(start: Column, end: Column, width: int) -> Column:
    return F.explode(F.sequence(F.floor(start / width).cast("long"), F.floor((F.greatest(end, start + 1) - 1) / width).cast("long")))


def interval_join(left: DataFrame, right: DataFrame, on: list[str] | None = None, l_start: str = "start", l_end: str = "end", r_start: str = "r_start", r_end: str = "r_end", width: int = 1000, how: str = "inner") -> DataFrame:
    """Pairs of rows that overlap: an equi-join on (key, bin), then the exact predicate. ``how``: inner, left_semi or left_anti.

    A pair that shares several bins comes out in one of them: that of the later start. ``width`` should be near the
    usual length, so that a row has a few bins and a bin a few rows; keys that many rows share are split by their bins.
    """
    on = on or []
    if how in ("left_semi", "left_anti"):
        # told by the interval, not by the row, so that equal rows stay as many as they are
        l, r = left.select(*on, l_start, l_end).distinct().withColumn("_bin", _bins(F.col(l_start), F.col(l_end), width)), right.select(*on, r_start, r_end).withColumn("_bin", _bins(F.col(r_start), F.col(r_end), width))
        hits = l.join(r, [l[k] == r[k] for k in (*on, "_bin")] + [l[l_start] < r[r_end], r[r_start] < l[l_end]], "left_semi").select(*on, l_start, l_end).distinct()
        return left.join(hits, [left[k].eqNullSafe(hits[k]) for k in (*on, l_start, l_end)], how)
    r = right.withColumn("_bin", _bins(F.col(r_start), F.col(r_end), width))
    l = left.withColumn("_bin", _bins(F.col(l_start), F.col(l_end), width))
    out = l.join(r, [*on, "_bin"]).where((F.col(l_start) < F.col(r_end)) & (F.col(r_start) < F.col(l_end)))
    return out.where(F.floor(F.greatest(l_start, r_start) / width) == F.col("_bin")).drop("_bin")


def point_in_intervals(points: DataFrame, intervals: DataFrame, on: list[str], pos: str = "pos", start: str = "begin", end: str = "end", closed_1based: bool = True, inside: bool = True) -> DataFrame:
    """Rows whose position is in some interval (or, with ``inside`` false, in none).

    ``closed_1based`` tests start <= pos <= end; otherwise intervals are half-open from 0 and positions count from 1.
    The intervals are coalesced first, so a point meets at most one of them.
    """
    shift = F.lit(0) if closed_1based else F.lit(1)
    spans = coalesce(intervals.select(*on, (F.col(start) + shift).alias("_s"), (F.col(end) + 1).alias("_e")), on, "_s", "_e")
    w = Window.partitionBy(*on).orderBy("_p", "_k").rowsBetween(Window.unboundedPreceding, 0)
    marks = spans.select(*on, F.col("_s").alias("_p"), F.lit(0).alias("_k"), F.col("_e").alias("_until"))
    cols = points.columns
    tagged = points.select(*on, F.col(pos).alias("_p"), F.lit(1).alias("_k"), F.struct(*cols).alias("_row"))
    both = tagged.unionByName(marks, allowMissingColumns=True).withColumn("_until", F.last("_until", True).over(w))
    hit = F.coalesce(F.col("_p") < F.col("_until"), F.lit(False))
    return both.where((F.col("_k") == 1) & (hit if inside else ~hit)).select("_row.*")


def coalesce(intervals: DataFrame, on: list[str], start: str = "start", end: str = "end", gap: int = 0) -> DataFrame:
    """(on, start, end, n): intervals that overlap, touch, or are at most ``gap`` apart, as one, with how many they were."""
    return _coalesced(intervals, on, start, end, gap).groupBy(*on, "_island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n")).drop("_island")


def _coalesced(intervals: DataFrame, on: list[str], start: str, end: str, gap: int) -> DataFrame:
    """``intervals`` with ``_island``, which those share that ``coalesce`` makes one."""
    w = Window.partitionBy(*on).orderBy(start, end)
    seen = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return intervals.withColumn("_new", F.when(seen.isNull() | (F.col(start) > seen + F.lit(gap)), 1).otherwise(0)).withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))


def islands(rows: DataFrame, on: list[str], pos: str = "pos") -> DataFrame:
    """(on, first, last, n): runs of consecutive whole numbers; repeated ones count once."""
    w = Window.partitionBy(*on).orderBy(pos)
    one = rows.select(*on, F.col(pos).cast("long").alias(pos)).distinct()
    return one.withColumn("_g", F.col(pos) - F.row_number().over(w)).groupBy(*on, "_g").agg(F.min(pos).alias("first"), F.max(pos).alias("last"), F.count("*").alias("n")).drop("_g")


def sessions(rows: DataFrame, on: list[str], at: str, gap: float) -> DataFrame:
    """``rows`` with ``session``, counted from 1: a new one starts where the step from the previous row exceeds ``gap``."""
    w = Window.partitionBy(*on).orderBy(at)
    new = F.when(F.col(at) - F.lag(at).over(w) > gap, 1).otherwise(0)
    return rows.withColumn("_new", new).withColumn("session", F.sum("_new").over(w.rangeBetween(Window.unboundedPreceding, 0)) + 1).drop("_new")


def depth(intervals: DataFrame, on: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """(on, start, end, depth): how many intervals cover each stretch, where any does.

    Starts add one and ends take one; equal positions are summed before the running sum, so its input is no longer
    than the number of different ends.
    """
    edges = intervals.select(*on, F.explode(F.array(F.struct(F.col(start).alias("p"), F.lit(1).alias("d")), F.struct(F.col(end).alias("p"), F.lit(-1).alias("d")))).alias("e"))
    steps = edges.groupBy(*on, F.col("e.p").alias("p")).agg(F.sum("e.d").alias("d"))
    w = Window.partitionBy(*on).orderBy("p")
    run = steps.withColumn("depth", F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_end", F.lead("p").over(w))
    return run.where("depth > 0").select(*on, F.col("p").alias("start"), F.col("_end").alias("end"), "depth")


def depth_per_position(intervals: DataFrame, on: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """(on, pos, depth) for every position that is covered."""
    return depth(intervals, on, start, end).select(*on, F.explode(F.sequence(F.col("start"), F.col("end") - 1)).alias("pos"), "depth")


def asof_forward(left: DataFrame, right: DataFrame, on: list[str], at: str, tolerance: float, right_at: str | None = None, name: str = "next_at") -> DataFrame:
    """``left`` rows with the least of ``right``'s values that isn't less than their own, kept if it is less than ``tolerance`` away.

    A key is cut into stretches of SPREAD tolerances. A value within a tolerance of a stretch's begin also counts in the
    stretch before, so each stretch is worked on alone, however many rows a key has. Within one, both sides are sorted
    once, backwards, and the last value seen is carried: time grows with the rows, not with their square.
    """
    width = F.lit(SPREAD * tolerance)
    cell = F.floor(F.col(at) / width).cast("long")
    r = right.select(*on, F.col(right_at or at).alias(at)).distinct().withColumn("_q", F.col(at)).withColumn("_side", F.lit(1))
    before = F.when(F.col(at) - cell * width < tolerance, F.array(cell, cell - 1)).otherwise(F.array(cell))
    r = r.withColumn("_cell", F.explode(before))
    l = left.select(*on, F.col(at), F.struct(*left.columns).alias("_row")).withColumn("_side", F.lit(0)).withColumn("_cell", cell)
    w = Window.partitionBy(*on, "_cell").orderBy(F.desc(at), F.desc("_side")).rowsBetween(Window.unboundedPreceding, 0)
    both = l.unionByName(r, allowMissingColumns=True).withColumn(name, F.last("_q", True).over(w))
    return both.where((F.col("_side") == 0) & (F.col(name) - F.col(at) < tolerance)).select("_row.*", name)


def mean_span_depth(reads: DataFrame, on: list[str], start: str = "start", end: str = "end", gap: int = 1000) -> DataFrame:
    """(on, depth): bases over covered span, where a step of more than ``gap`` between reads is not covered. A null key is one, too."""
    island = _coalesced(reads, on, start, end, gap).groupBy(*on, "_island").agg((F.max(end) - F.min(start)).alias("_span"), F.sum(F.col(end) - F.col(start)).alias("_bases"))
    return island.groupBy(*on).agg(F.try_divide(F.sum("_bases").cast("double"), F.sum("_span")).alias("depth"))


def fill_gaps(sites: DataFrame, on: list[str], pos: str = "pos") -> DataFrame:
    """(on, pos): the positions between the first and the last of each key that have no row."""
    w = Window.partitionBy(*on).orderBy(pos)
    step = sites.select(*on, pos).distinct().withColumn("_n", F.lead(pos).over(w)).where(F.col("_n") > F.col(pos) + 1)
    return step.select(*on, F.explode(F.sequence(F.col(pos) + 1, F.col("_n") - 1)).alias(pos))
