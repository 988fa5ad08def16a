"""Windows, ranks and robust statistics over ordered keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import log_compress


def moving_average(rows: DataFrame, on: list[str], at: list[str], value: str, size: int, name: str = "avg") -> DataFrame:
    """The mean of the last ``size`` rows' values, nulls left out; and how many values there were (``<name>_n``)."""
    w = Window.partitionBy(*on).orderBy(*at).rowsBetween(1 - size, 0)
    return rows.withColumn(name, F.avg(value).over(w)).withColumn(f"{name}_n", F.count(value).over(w))


def recent_true(rows: DataFrame, on: list[str], at: list[str], flag: Column, size: int, name: str = "recent") -> DataFrame:
    """How many of the last ``size`` rows satisfy ``flag``."""
    return rows.withColumn(name, F.count_if(flag).over(Window.partitionBy(*on).orderBy(*at).rowsBetween(1 - size, 0)))


def cluster_flag(rows: DataFrame, on: list[str], at: str, within: float, name: str = "cls") -> DataFrame:
    """1 where the previous row is less than ``within`` away, else 0."""
    before = F.lag(at).over(Window.partitionBy(*on).orderBy(at))
    return rows.withColumn(name, F.when(F.col(at) - before < within, 1).otherwise(0))


def median_nonzero(rows: DataFrame, on: list[str], value: str, name: str = "median") -> DataFrame:
    """(on, median of the values that aren't 0): the mean of the middle two if they are even in number."""
    return rows.where(F.col(value) != 0).groupBy(*on).agg(F.percentile(value, 0.5).alias(name))


def summary(rows: DataFrame, on: list[str], value: str) -> DataFrame:
    """Count, mean, variance, deviation, standard error, extremes, root mean square and share of zeros."""
    v = F.col(value)
    return rows.groupBy(*on).agg(
        F.count(v).alias("n"),
        F.avg(v).alias("mean"),
        F.var_samp(v).alias("variance"),
        F.stddev_samp(v).alias("sd"),
        F.try_divide(F.stddev_samp(v), F.sqrt(F.count(v))).alias("stderr"),
        F.min(v).alias("least"),
        F.max(v).alias("most"),
        F.sqrt(F.avg(v * v)).alias("rms"),
        F.avg((v == 0).cast("int")).alias("zero_fraction"),
    )


def rank_sum(rows: DataFrame, on: list[str], value: str, second: Column) -> DataFrame:
    """(on, n1, n2, z): Wilcoxon's rank-sum statistic with mid-ranks, of the category with the smaller rank sum.

    Values are counted first, so the window runs over distinct values, not rows. z is 0 where a category is empty.
    """
    by = rows.where(F.col(value).isNotNull()).groupBy(*on, value).agg(F.count_if(~second).alias("_a"), F.count_if(second).alias("_b"))
    before = F.coalesce(F.sum(F.col("_a") + F.col("_b")).over(Window.partitionBy(*on).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    mid = by.withColumn("_r", before + (F.col("_a") + F.col("_b") + 1) / 2.0)
    s = mid.groupBy(*on).agg(F.sum("_a").alias("n1"), F.sum("_b").alias("n2"), F.sum(F.col("_a") * F.col("_r")).alias("_ra"), F.sum(F.col("_b") * F.col("_r")).alias("_rb"))
    n = F.col("n1") + F.col("n2") + 1
    sigma = F.sqrt(F.col("n1") * F.col("n2") * n / 12.0)
    z = F.when(F.col("_ra") < F.col("_rb"), F.try_divide(F.col("_ra") - F.col("n1") * n / 2.0, sigma)).otherwise(F.try_divide(F.col("_rb") - F.col("n2") * n / 2.0, sigma))
    return s.select(*on, "n1", "n2", F.coalesce(z, F.lit(0.0)).alias("z"))


def equi_depth_cuts(rows: DataFrame, on: list[str], at: str, every: int) -> DataFrame:
    """(on, cut, upto): the keys at which the running count of rows exceeds the next multiple of ``every``.

    Equal keys are counted first; the running sum is over distinct keys.
    """
    counted = rows.groupBy(*on, at).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*on).orderBy(at)
    upto = F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0))
    c = counted.withColumn("upto", upto)
    step = lambda x: F.floor((x - 1) / every)
    return c.where((step(F.col("upto")) > step(F.greatest(F.col("upto") - F.col("_n"), F.lit(1)))) & (F.col("upto") > every)).select(*on, F.col(at).alias("cut"), "upto")


def compressed_histogram(rows: DataFrame, value: str, bits: int = 3) -> DataFrame:
    """(value, n) with values in nearly log-spaced classes."""
    return rows.groupBy(log_compress(F.col(value), bits).alias("value")).agg(F.count("*").alias("n"))


def precision_recall(rows: DataFrame, score: str, truth: Column) -> DataFrame:
    """(score, tp, fp, precision, recall) for each threshold score >= s. The window runs over distinct scores."""
    by = rows.groupBy(score).agg(F.count_if(truth).alias("_t"), F.count_if(~truth).alias("_f"))
    w = Window.orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0)
    all_ = by.agg(F.sum("_t").alias("_all"))
    c = by.withColumn("tp", F.sum("_t").over(w)).withColumn("fp", F.sum("_f").over(w))
    return c.crossJoin(F.broadcast(all_)).select(score, "tp", "fp", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), F.try_divide(F.col("tp").cast("double"), "_all").alias("recall"))


def calibration(rows: DataFrame, score: str, truth: Column, bins: int = 10) -> DataFrame:
    """(bin, n, mean_score, observed): scores from 0 to 1 in ``bins`` against what came true."""
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).alias("bin")
    return rows.groupBy(b).agg(F.count("*").alias("n"), F.avg(score).alias("mean_score"), F.avg(truth.cast("int")).alias("observed"))


def top_by_ratio(rows: DataFrame, on: list[str], score: str, k: int, ratio: float, ties: list[str]) -> DataFrame:
    """The best row of each key and up to ``k`` in all that have at least ``ratio`` of its score."""
    w = Window.partitionBy(*on).orderBy(F.desc(score), *ties)
    best = F.max(score).over(Window.partitionBy(*on))
    return rows.withColumn("rank", F.row_number().over(w)).withColumn("_best", best).where((F.col("rank") == 1) | ((F.col("rank") <= k) & (F.col(score) >= F.col("_best") * ratio))).drop("_best")


def most_frequent(rows: DataFrame, on: list[str], value: str) -> DataFrame:
    """(on, value, n): the commonest value; the least of equally common ones."""
    c = rows.groupBy(*on, value).agg(F.count("*").alias("n"))
    return c.groupBy(*on).agg(F.min(F.struct((-F.col("n")).alias("m"), F.col(value).alias("v"))).alias("x")).select(*on, F.col("x.v").alias(value), (-F.col("x.m")).alias("n"))


def adaptive_take(rows: DataFrame, at: list[str], evidence: str, target: float) -> DataFrame:
    """Rows in order until the evidence of those before reaches ``target``.

    The running sum is over the first key's values, then within each: no task sees more than one value's rows.
    """
    head = at[0]
    step = rows.groupBy(head).agg(F.sum(evidence).alias("_e"))
    step = step.select(F.col(head).alias("_h"), F.coalesce(F.sum("_e").over(Window.orderBy(head).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_a"))
    inside = F.coalesce(F.sum(evidence).over(Window.partitionBy(head).orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    near = step.where(F.col("_a") < target)
    return rows.withColumn("_i", inside).join(near, F.col(head).eqNullSafe(F.col("_h"))).where(F.col("_a") + F.col("_i") < target).drop("_h", "_a", "_i")


def sequential_ids(rows: DataFrame, value: str, name: str = "id") -> DataFrame:
    """(value, id): distinct values numbered from 0 in their order."""
    return rows.select(value).distinct().withColumn(name, F.row_number().over(Window.orderBy(value)) - 1)
