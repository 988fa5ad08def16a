"""Somatic variants of a tumour and its normal: allele-fraction grids, quality scores over two tiers, indel features."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric, stats

#: Allele fractions: reference, heterozygote, homozygote, then the grid between.
FRACTIONS = (0.0, 0.5, 1.0, *(round(0.05 * i, 2) for i in range(1, 20) if i != 10))
NORMAL = ("ref", "het", "hom")


def fraction_likelihoods(calls: DataFrame, site: list[str], alt: str = "alt") -> DataFrame:
    """(site, sample, lhood): the log likelihood of each of FRACTIONS from base calls (site, sample, base, q, alt): sums by group, in Spark."""
    e = numeric.error_prob(F.col("q"))
    hit = F.col("base") == F.col(alt)

    def term(r: float):
        yes, no = F.ln((1 - e) * r + e / 3 * (1 - r)), F.ln((1 - e) * (1 - r) + e / 3 * r)
        return F.sum(F.when(hit, yes).otherwise(no))

    return calls.groupBy(*site, "sample").agg(*(F.round(term(r), 9).alias(f"_{i}") for i, r in enumerate(FRACTIONS)), F.count("*").alias("n")).select(*site, "sample", "n", F.array(*(f"_{i}" for i in range(len(FRACTIONS)))).alias("lhood"))


def somatic_quality(normal: np.ndarray, tumour: np.ndarray, somatic_rate: float = 1e-7, theta: float = 1e-3, contamination: float = 0.15) -> tuple[int, int, str]:
    """(QSS, QSS_NT, NT): how sure the fractions differ, and that they do with the normal's likeliest genotype.

    Without a somatic change both samples have one fraction; with one, a normal that isn't the reference keeps its own and
    the tumour may have any other; a reference normal may also have a little of the tumour.
    """
    germline = np.log([1 - 1.5 * theta, theta, theta / 2])
    k = len(FRACTIONS)
    same = np.array([normal[g] + tumour[g] for g in range(3)]) + germline + math.log1p(-somatic_rate)
    changed = np.empty(3)
    for g in range(3):
        others = [i for i in range(k) if i != g]
        terms = [normal[g] + tumour[i] - math.log(len(others)) for i in others]
        if g == 0:
            # fractions of which the contamination brings the grid's least into the normal
            low = FRACTIONS.index(0.05)
            terms = [float(np.logaddexp(t, normal[low] + tumour[i] - math.log(len(others)))) - math.log(2) if contamination * FRACTIONS[i] >= 0.05 else t for t, i in zip(terms, others, strict=True)]
        changed[g] = np.logaddexp.reduce(terms) + germline[g] + math.log(somatic_rate)
    total = np.logaddexp.reduce(np.concatenate([same, changed]))
    nonsomatic = math.exp(min(0.0, float(np.logaddexp.reduce(same) - total)))
    q = lambda p: int(-10 * math.log10(max(p, 1e-307)) + 0.5)
    g = int(np.argmax(np.logaddexp(same, changed)))
    with_g = -math.expm1(min(0.0, float(changed[g] - total)))
    return q(nonsomatic), q(with_g), NORMAL[g]


def score_sites(lhoods: DataFrame, site: list[str]) -> DataFrame:
    """(site, qss, qss_nt, nt) from (site, tier, normal array, tumour array): the tier of lower quality counts; tiers that differ in the genotype conflict."""

    def go(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            got = [somatic_quality(np.array(n), np.array(t)) for n, t in zip(pdf.normal, pdf.tumour, strict=True)]
            yield pdf[[*site, "tier"]].assign(qss=[g[0] for g in got], qss_nt=[g[1] for g in got], nt=[g[2] for g in got])

    rows = lhoods.select(*site, "tier", "normal", "tumour")
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in (*site, "tier")) + ", qss int, qss_nt int, nt string"
    by = rows.mapInPandas(go, schema).groupBy(*site).agg(F.min("qss").alias("qss"), F.min("qss_nt").alias("qss_nt"), F.collect_set("nt").alias("_nt"))
    clash = F.size("_nt") > 1
    return by.select(*site, F.when(clash, 0).otherwise(F.col("qss")).alias("qss"), F.when(clash, 0).otherwise(F.col("qss_nt")).alias("qss_nt"), F.when(clash, "conflict").otherwise(F.get("_nt", 0)).alias("nt"))


def pair_samples(lhoods: DataFrame, site: list[str], normal: str = "normal", tumour: str = "tumour") -> DataFrame:
    """(site, tier, normal, tumour): both samples' likelihoods side by side, in one aggregation."""
    keys = [*site, "tier"] if "tier" in lhoods.columns else site
    pick = lambda s: F.max(F.when(F.col("sample") == s, F.col("lhood")))
    got = lhoods.groupBy(*keys).agg(pick(normal).alias("normal"), pick(tumour).alias("tumour")).where("normal is not null and tumour is not null")
    return got if "tier" in keys else got.withColumn("tier", F.lit(1))


def indel_features(counts: DataFrame) -> DataFrame:
    """Somatic indels' counts (ref_fwd, ref_rev, alt_fwd, alt_rev, other, filtered, used, normal_ref, normal_alt) with their scoring features."""
    c = F.col
    ref, alt = c("ref_fwd") + c("ref_rev"), c("alt_fwd") + c("alt_rev")
    sor = F.ln(((c("ref_fwd") + 0.5) * (c("alt_rev") + 0.5)) / ((c("ref_rev") + 0.5) * (c("alt_fwd") + 0.5)))
    f = lambda a, b, least: F.greatest(numeric.safe_frac(a, a + b), F.lit(least))
    odds = lambda p: F.ln(p / F.greatest(1 - p, F.lit(1e-4)))
    return counts.withColumns(
        {
            "af": numeric.safe_frac(alt, ref + alt + c("other")),
            "sor": sor,
            "fs": stats.fisher_col(c("ref_fwd"), c("ref_rev"), c("alt_fwd"), c("alt_rev")),
            "bsa": stats.binom_two_sided_col(alt, c("alt_fwd"), F.lit(0.5)),
            "bcn": numeric.safe_frac(c("filtered"), c("filtered") + c("used")),
            "lodds": odds(f(alt, ref, 1e-4)) - odds(f(c("normal_alt"), c("normal_ref"), 1e-4)),
            "aclodds": F.ln(((alt + 0.5) * (c("normal_ref") + 0.5)) / ((ref + 0.5) * (c("normal_alt") + 0.5))),
        }
    )


def window_noise(sites: DataFrame, flank: int = 50) -> DataFrame:
    """Sites (contig_id, pos, filtered, used) with ``noise``: filtered over all calls, of the window's means cut to whole numbers."""
    from pyspark.sql import Window

    w = Window.partitionBy("contig_id").orderBy("pos").rangeBetween(-flank, flank)
    a, b = F.floor(F.avg("filtered").over(w)), F.floor(F.avg("used").over(w))
    return sites.withColumn("noise", numeric.safe_frac(a, a + b))


def noise_sites(counts: DataFrame, least: int = 12, most: float = 0.2) -> DataFrame:
    """(contig_id, pos, dp, ad) of sites with enough calls and few alternates (counts: contig_id, pos, ref_n, alt_n)."""
    n = F.col("ref_n") + F.col("alt_n")
    return counts.where((n >= least) & (numeric.safe_frac(F.col("alt_n"), n) <= most)).select("contig_id", "pos", n.alias("dp"), F.array("ref_n", "alt_n").alias("ad"))


def callable_regions(sites: DataFrame, least: int = 10) -> DataFrame:
    """(contig_id, begin, end): runs of positions that are deep enough, from 0 and half-open."""
    from .intervals import islands

    return islands(sites.where(F.col("used") >= least), ["contig_id"]).select("contig_id", (F.col("first") - 1).alias("begin"), F.col("last").alias("end"))


def header(contigs: list[tuple[str, int]], kind: str = "SNV") -> list[str]:
    """A somatic call set's header lines."""
    q = "QSS" if kind == "SNV" else "QSI"
    out = ["##fileformat=VCFv4.1", *(f"##contig=<ID={n},length={size}>" for n, size in contigs)]
    out += [f'##INFO=<ID={q},Number=1,Type=Integer,Description="Quality of any somatic variant">', f'##INFO=<ID={q}_NT,Number=1,Type=Integer,Description="Quality with the normal genotype">', '##INFO=<ID=NT,Number=1,Type=String,Description="Normal genotype">', '##INFO=<ID=SOMATIC,Number=0,Type=Flag,Description="Somatic variant">']
    out += [f'##FILTER=<ID={i},Description="{d}">' for i, d in (("HighDepth", "Normal depth is high for the chromosome"), ("BCNoise", "Many base calls are filtered"), ("SpanDel", "Many reads span the site with a deletion"), (f"{q}_ref", "Normal is not the reference, or the quality is low"), ("LowDepth", "Depth is low"))]
    out += ['##FORMAT=<ID=DP,Number=1,Type=Integer,Description="Used depth">', '##FORMAT=<ID=AD,Number=.,Type=Integer,Description="Allele depths">']
    return [*out, "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tNORMAL\tTUMOR"]


def lines(calls: DataFrame, chrom, kind: str = "SNV") -> DataFrame:
    """(contig_id, pos, line) from (contig_id, pos, ref, alt, filters, qss, qss_nt, nt, normal_ad array, tumour_ad array)."""
    c, q = F.col, "QSS" if kind == "SNV" else "QSI"
    total = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda a, v: a + v).cast("string")
    sample = lambda x: F.concat(total(x), F.lit(":"), F.array_join(F.transform(x, lambda v: v.cast("string")), ","))
    info = F.concat(F.lit(f"SOMATIC;{q}="), c("qss").cast("string"), F.lit(f";{q}_NT="), c("qss_nt").cast("string"), F.lit(";NT="), c("nt"))
    line = F.concat_ws("\t", chrom, c("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), F.when(F.size("filters") == 0, "PASS").otherwise(F.array_join("filters", ";")), info, F.lit("DP:AD"), sample(c("normal_ad")), sample(c("tumour_ad")))
    return calls.select("contig_id", "pos", line.alias("line"))
