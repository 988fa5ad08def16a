"""Single-site tests that the callers' older modes use: likelihood ratios, ploidies, strands."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric, stats

BASES = "ACGT"


def _terms(bases: str, quals: list[int], ref: str) -> tuple[np.ndarray, np.ndarray]:
    """Whether each call is the reference's, and its error."""
    return np.array([b == ref for b in bases]), np.array([10 ** (-q / 10) for q in quals])


def ln_mixture(same: np.ndarray, e: np.ndarray, r: float) -> float:
    """The log likelihood of calls if a share ``r`` of the sample isn't the reference."""
    p = np.where(same, (1 - r) * (1 - e) + r * e / 3, r * (1 - e) / 1.0 + (1 - r) * e / 3)
    return float(np.log(np.maximum(p, 1e-300)).sum())


def best_fraction(same: np.ndarray, e: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """(fraction, log likelihood) of the likeliest share, by golden sections: the likelihood has one maximum."""
    lo, hi, g = 0.0, 1.0, (math.sqrt(5) - 1) / 2
    a, b = hi - g * (hi - lo), lo + g * (hi - lo)
    fa, fb = ln_mixture(same, e, a), ln_mixture(same, e, b)
    for _ in range(steps):
        if fa < fb:
            lo, a, fa = a, b, fb
            b = lo + g * (hi - lo)
            fb = ln_mixture(same, e, b)
        else:
            hi, b, fb = b, a, fa
            a = hi - g * (hi - lo)
            fa = ln_mixture(same, e, a)
    return max(((r, ln_mixture(same, e, r)) for r in (0.0, (lo + hi) / 2, 1.0)), key=lambda x: x[1])


def likelihood_ratio(sites: DataFrame, alpha: float = 1e-6) -> DataFrame:
    """(contig_id, pos, fraction, statistic, is_snp) from (contig_id, pos, ref, bases string, quals array): is a share other than 0 much likelier?"""

    def go(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for b, q, r in zip(pdf.bases, pdf.quals, pdf.ref, strict=True):
                same, e = _terms(b, list(q), r)
                f, best = best_fraction(same, e)
                null = ln_mixture(same, e, 0.0)
                out.append((f, 2 * (best - null), stats.likelihood_ratio_reject(alpha, null, best)))
            yield pdf[["contig_id", "pos"]].assign(fraction=[o[0] for o in out], statistic=[o[1] for o in out], is_snp=[o[2] for o in out])

    return sites.select("contig_id", "pos", "ref", "bases", "quals").mapInPandas(go, f"contig_id {sites.schema['contig_id'].dataType.simpleString()}, pos {sites.schema['pos'].dataType.simpleString()}, fraction double, statistic double, is_snp boolean")


def collect_sites(calls: DataFrame, most: int = 10_000) -> DataFrame:
    """(contig_id, pos, ref, bases, quals) from base calls. Sites deeper than ``most`` are an error: their reads are to be capped first."""
    g = calls.groupBy("contig_id", "pos", "ref").agg(F.count("*").alias("_n"), F.array_sort(F.collect_list(F.struct("base", "q"))).alias("_c"))
    ok = F.when(F.col("_n") > most, F.raise_error("site too deep")).otherwise(F.col("_n"))
    return g.withColumn("_n", ok.cast("long")).select("contig_id", "pos", "ref", F.array_join(F.transform("_c", lambda x: x["base"]), "").alias("bases"), F.transform("_c", lambda x: x["q"]).alias("quals"))


def monoploid(calls: DataFrame, site: list[str], theta: float = 0.001) -> DataFrame:
    """(site, base, q): the likeliest single base and the quality of its being another, from base calls (site, base, q, ref)."""
    e = numeric.error_prob(F.col("q"))
    sums = [F.sum(F.when(F.col("base") == b, F.log1p(-e)).otherwise(F.ln(e / 3))).alias(f"_{b}") for b in BASES]
    s = calls.groupBy(*site).agg(F.first("ref").alias("_ref"), *sums)
    prior = [F.when(F.col("_ref") == b, math.log(1 - theta)).otherwise(math.log(theta / 3)) for b in BASES]
    post = numeric.normalize_log(F.array(*(F.round(F.col(f"_{b}"), 9) + p for b, p in zip(BASES, prior, strict=True))))
    s = s.withColumn("_p", post).withColumn("_i", numeric.argmax(F.col("_p")))
    rest = F.aggregate(F.transform("_p", lambda x, i: F.when(i == F.col("_i"), 0.0).otherwise(x)), F.lit(0.0), lambda a, x: a + x)
    return s.select(*site, F.get(F.array(*(F.lit(b) for b in BASES)), F.col("_i").cast("int")).alias("base"), numeric.phred_int(rest).alias("q"))


def n_ploid(counts: list[tuple[int, int]], error: float, ploidy: int, theta: float = 0.001) -> list[float]:
    """The posterior of 0..ploidy alternate copies from (reference, alternate) counts of one site's samples."""
    ln = []
    for k in range(ploidy + 1):
        r = k / ploidy
        p = min(1 - error / 3, max(error / 3, r * (1 - error) + (1 - r) * error / 3))
        prior = math.log(1 - theta) if k == 0 else math.log(theta / ploidy)
        ln.append(prior + sum(a * math.log1p(-p) + b * math.log(p) for a, b in counts))
    top = max(ln)
    w = [math.exp(x - top) for x in ln]
    return [x / sum(w) for x in w]


def strand_anomaly(counts: DataFrame, alpha: float = 1e-6) -> DataFrame:
    """Sites (fwd_ref, fwd_alt, rev_ref, rev_alt) with ``p_strand``, Fisher's exact test of alleles against strands, and ``is_anomaly``."""
    p = stats.fisher_col(F.col("fwd_ref"), F.col("fwd_alt"), F.col("rev_ref"), F.col("rev_alt"))
    return counts.withColumn("p_strand", p).withColumn("is_anomaly", F.col("p_strand") < alpha)


def strand_coverage_anomaly(counts: DataFrame, alpha: float = 1e-6) -> DataFrame:
    """Sites (fwd, rev) with ``p_coverage``, a fair binomial's two tails, and ``is_anomaly``."""
    p = stats.binom_two_sided_col(F.col("fwd") + F.col("rev"), F.col("fwd"), F.lit(0.5))
    return counts.withColumn("p_coverage", p).withColumn("is_anomaly", F.col("p_coverage") < alpha)


def nonref_test(counts: DataFrame, error: float = 0.01, alpha: float = 1e-6) -> DataFrame:
    """Sites (ref_n, alt_n) with ``p_error``, the chance of so many alternates from errors, and ``is_nonref``."""
    p = stats.binom_upper_col(F.col("ref_n") + F.col("alt_n"), F.col("alt_n"), F.lit(error))
    return counts.withColumn("p_error", p).withColumn("is_nonref", F.col("p_error") < alpha)


def haplotype_score(rows: list[tuple[str, list[int]]], top: int = 2) -> float:
    """How badly reads over a window fit its ``top`` haplotypes: the mean over reads of the least summed quality of mismatches."""
    from collections import Counter

    if not rows:
        return 0.0
    haps = [h for h, _ in Counter(b for b, _ in rows if "N" not in b).most_common(top)]
    if not haps:
        return 0.0
    cost = lambda b, q, h: sum(x for c, x, y in zip(b, q, h, strict=True) if c not in ("N", y))
    return sum(min(cost(b, q, h) for h in haps) for b, q in rows) / len(rows)
