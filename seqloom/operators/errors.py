"""Sequencing errors counted by context, and their rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def snv_error_counts(calls: DataFrame, reference: DataFrame, most_filtered: float = 0.05, least_q: int = 25) -> DataFrame:
    """(q, ref_n, alt_n) over base calls (contig_id, pos, base, q, filtered), both strands alike: sites with few filtered calls, qualities from ``least_q``."""
    site = calls.groupBy("contig_id", "pos").agg(F.avg(F.col("filtered").cast("int")).alias("_f")).where(F.col("_f") < most_filtered).select("contig_id", "pos")
    j = calls.where(~F.col("filtered") & (F.col("q") >= least_q)).join(site, ["contig_id", "pos"]).join(reference.select("contig_id", "pos", F.col("base").alias("ref")), ["contig_id", "pos"])
    same = F.col("base") == F.col("ref")
    return j.groupBy("q").agg(F.count_if(same).alias("ref_n"), F.count_if(~same).alias("alt_n"))


def indel_error_counts(sites: DataFrame, most_repeats: int = 20) -> DataFrame:
    """(unit, repeats, kind, alt_reads, ref_reads, loci) from loci (unit, repeats, kind, alt_reads, ref_reads): unit sizes 1 and 2, longer repeats as one."""
    return sites.where("unit in (1, 2)").groupBy("unit", F.least("repeats", F.lit(most_repeats)).alias("repeats"), "kind", "alt_reads", "ref_reads").agg(F.count("*").alias("loci"))


def skipped(sites: DataFrame, **reasons) -> DataFrame:
    """(reason, n): the first reason that holds for each site; null for those that are counted."""
    out = F.when(F.lit(False), F.lit(""))
    for name, cond in reasons.items():
        out = out.when(cond, name)
    return sites.groupBy(out.alias("reason")).agg(F.count("*").alias("n"))


def error_rates(counts: DataFrame, on: list[str], events: str = "alt_n", rest: str = "ref_n") -> DataFrame:
    """(on, rate): the pooled maximum-likelihood rate."""
    return counts.groupBy(*on).agg(F.try_divide(F.sum(events).cast("double"), F.sum(F.col(events) + F.col(rest))).alias("rate"))


def mixture_rates(counts: DataFrame, on: list[str], rounds: int = 50) -> DataFrame:
    """(on, clean_rate, noisy_rate, noisy_share): two kinds of loci, each with its own error rate, by expectation-maximisation on a table of (alt_reads, ref_reads, loci), which is small for each context."""
    import numpy as np
    import pandas as pd

    def go(pdf: pd.DataFrame) -> pd.DataFrame:
        a, r, n = (pdf[c].to_numpy(float) for c in ("alt_reads", "ref_reads", "loci"))
        base = max(1e-9, (a * n).sum() / max(1.0, ((a + r) * n).sum()))
        p, q, s = base / 2, min(0.5, base * 10), 0.1
        for _ in range(rounds):
            x = np.log1p(-s) + a * np.log(p) + r * np.log1p(-p)
            y = np.log(s) + a * np.log(q) + r * np.log1p(-q)
            w = 1 / (1 + np.exp(np.clip(x - y, -700, 700)))
            s = min(0.999, max(1e-6, (w * n).sum() / n.sum()))
            p = min(0.5, max(1e-9, ((1 - w) * n * a).sum() / max(1e-9, ((1 - w) * n * (a + r)).sum())))
            q = min(0.9, max(1e-9, (w * n * a).sum() / max(1e-9, (w * n * (a + r)).sum())))
        return pd.DataFrame([(*pdf[on].iloc[0], p, q, s)], columns=[*on, "clean_rate", "noisy_rate", "noisy_share"])

    keys = ", ".join(f"{c} {counts.schema[c].dataType.simpleString()}" for c in on)
    return counts.groupBy(*on, "alt_reads", "ref_reads").agg(F.sum("loci").alias("loci")).groupBy(*on).applyInPandas(go, f"{keys}, clean_rate double, noisy_rate double, noisy_share double")
