"""Diploid site genotypes from base calls, haploid and continuous variants, and the ranking of alternate alleles."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric

BASES = "ACGT"
GENOTYPES = tuple(a + b for i, a in enumerate(BASES) for b in BASES[i:])
HAPLOID = tuple(BASES)


def dependent_errors(calls: DataFrame, site: list[str], no_mismatch: float = 0.35, one_mismatch: float = 0.6, floor: float = 0.25) -> DataFrame:
    """Calls (site, strand, base, q[, neighbour_mismatch]) counted, with ``e``, their error, ``vexp``, the exponent it gets as errors come together, and ``e_adj``, the error given that; ``n`` is how many calls a row stands for.

    Within a strand and base, from the best quality down, an error's exponent falls by a factor at each call, to ``floor``
    at least. The factor mixes the two dependence rates by the weight of calls that have a mismatch near them. Equal
    qualities have equal errors, so they are counted before the window, which runs over distinct qualities, not calls;
    a call before the floor is a row of its own, and all of a quality that are at the floor are one.
    """
    rows = calls if "neighbour_mismatch" in calls.columns else calls.withColumn("neighbour_mismatch", F.lit(False))
    rows = rows.where(F.col("q") >= 3).groupBy(*site, "strand", "base", "q").agg(F.count("*").alias("n"), F.count_if("neighbour_mismatch").alias("_near")).withColumn("e", numeric.error_prob(F.col("q")))
    group = Window.partitionBy(*site, "strand", "base")
    weight = math.log(0.75) - F.ln("e")
    share = F.try_divide(F.sum(F.col("_near") * weight).over(group), F.sum(F.col("n") * weight).over(group))
    factor = 1 - F.coalesce((1 - share) * no_mismatch + share * one_mismatch, F.lit(no_mismatch))
    before = F.coalesce(F.sum("n").over(group.orderBy(F.desc("q")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # the slowest factor reaches the floor after this many calls
    steps = math.ceil(math.log(floor) / math.log(1 - min(no_mismatch, one_mismatch)))
    rows = rows.withColumn("_f", factor).withColumn("_nth", before)
    alone = F.least(F.col("n"), F.greatest(steps - F.col("_nth"), F.lit(0)))
    each = F.transform(F.when(alone > 0, F.sequence(F.lit(0), (alone - 1).cast("int"))).otherwise(F.expr("cast(array() as array<int>)")), lambda i: F.struct((F.col("_nth") + i).alias("nth"), F.lit(1).cast("long").alias("n")))
    last = F.when(F.col("n") > alone, F.array(F.struct((F.col("_nth") + alone).alias("nth"), (F.col("n") - alone).alias("n")))).otherwise(F.expr("cast(array() as array<struct<nth:bigint,n:bigint>>)"))
    rows = rows.select(*site, "strand", "base", "q", "e", "_f", F.explode(F.concat(each, last)).alias("_c")).select("*", F.col("_c.n").alias("n"))
    v = F.greatest(F.lit(floor), F.pow(F.col("_f"), F.col("_c.nth")))
    power = F.pow(F.col("e"), v)
    g = (1 - power) / (1 - F.col("e"))
    return rows.select(*site, "strand", "base", "q", "e", "n", v.alias("vexp"), F.greatest(F.col("e"), g * power + (1 - g) * 0.75).alias("e_adj"))


def _term(genotype: str, base: Column, e: Column, adj: Column) -> Column:
    """ln P(base | genotype): both alleles, one, or none of them; the adjusted error stands where the base is an error only."""
    third = math.log(1 / 3)
    if len(set(genotype)) == 1:
        return F.when(base == genotype[0], F.log1p(-e)).otherwise(F.ln(adj) + third)
    return F.when(base.isin(*genotype), F.ln((1 - e) + e / 3) + math.log(0.5)).otherwise(F.ln(adj) + third)


def likelihoods(calls: DataFrame, site: list[str], genotypes: tuple[str, ...] = GENOTYPES) -> DataFrame:
    """(site, n_calls, lhood): the log likelihood of each genotype, in order, of calls or of counted calls (``n``); sums of each task are combined before the shuffle."""
    e, adj = F.col("e"), F.col("e_adj") if "e_adj" in calls.columns else F.col("e")
    n = F.col("n") if "n" in calls.columns else F.lit(1)
    # rounded, as sums in another order differ in their last digits, and equal genotypes must tie
    sums = [F.round(F.sum(n * _term(g, F.col("base"), e, adj)), 9).alias(f"_{i}") for i, g in enumerate(genotypes)]
    return calls.where(F.col("base").isin(*BASES)).groupBy(*site).agg(*sums, F.sum(n).alias("n_calls")).select(*site, "n_calls", F.array(*(f"_{i}" for i in range(len(genotypes)))).alias("lhood"))


def _priors(ref: Column, table: dict[str, dict[str, float]], genotypes: tuple[str, ...]) -> Column:
    arrays = {r: F.array(*(F.lit(math.log(table[r][g])) for g in genotypes)) for r in table}
    out = F.when(ref == "A", arrays["A"])
    for r in "CGT":
        out = out.when(ref == r, arrays[r])
    return out.otherwise(arrays["N"])


def genotypes(lhoods: DataFrame, theta: float = 0.001, ref: str = "ref") -> DataFrame:
    """Sites (ref, lhood) with the posterior, gt, snp_q, gq, gqx and pl.

    GQX is the smaller of the qualities under the genome's and the polymorphic prior if both have the same best genotype, else 0.
    """
    c = F.col
    names = F.array(*(F.lit(g) for g in GENOTYPES))
    rows = lhoods
    for kind, table in (("genome", numeric.genotype_priors(theta)), ("poly", numeric.polymorphic_priors(theta))):
        post = numeric.normalize_log(F.zip_with("lhood", _priors(c(ref), table, GENOTYPES), lambda a, b: a + b))
        rows = rows.withColumn(f"_{kind}", post).withColumn(f"_{kind}_best", numeric.argmax(c(f"_{kind}")))
    # 1 - P(best), summed from the others, so that small ones aren't lost
    rest = lambda kind: F.aggregate(F.transform(c(f"_{kind}"), lambda x, i: F.when(i == c(f"_{kind}_best"), 0.0).otherwise(x)), F.lit(0.0), lambda a, x: a + x)
    p_ref = F.coalesce(F.get("_genome", F.array_position(names, F.concat(c(ref), c(ref))).cast("int") - 1), F.lit(0.0))
    top = F.array_max("lhood")
    return rows.select(
        *lhoods.columns,
        c("_genome").alias("posterior"),
        F.get(names, c("_genome_best").cast("int")).alias("gt"),
        numeric.phred_int(p_ref).alias("snp_q"),
        numeric.phred_int(rest("genome")).alias("gq"),
        F.when(c("_genome_best") == c("_poly_best"), F.least(numeric.phred_int(rest("genome")), numeric.phred_int(rest("poly")))).otherwise(0).alias("gqx"),
        F.transform("lhood", lambda x: F.floor((top - x) * (10 / math.log(10)) + 0.5).cast("int")).alias("pl"),
    )


def strand_bias(calls: DataFrame, site: list[str], ref: str, best: DataFrame) -> DataFrame:
    """(site, strand_bias): how much better the best genotype fits one strand, the other being the reference's, than both."""
    c = F.col
    j = calls.where(c("base").isin(*BASES)).join(best.select(*site, c(ref).alias("_ref"), c("gt").alias("_gt")), site)
    adj = c("e_adj") if "e_adj" in calls.columns else c("e")
    n = c("n") if "n" in calls.columns else F.lit(1)
    a, b = F.substring("_gt", 1, 1), F.substring("_gt", 2, 1)
    fit = lambda x, y: F.when((x == y) & (c("base") == x), F.log1p(-c("e"))).when((x != y) & ((c("base") == x) | (c("base") == y)), F.ln(1 - c("e") + c("e") / 3) + math.log(0.5)).otherwise(F.ln(adj) + math.log(1 / 3))
    gt, hom = fit(a, b), fit(c("_ref"), c("_ref"))
    fwd = c("strand") == "+"
    s = j.groupBy(*site).agg(F.sum(n * gt).alias("_all"), F.sum(n * F.when(fwd, gt).otherwise(hom)).alias("_f"), F.sum(n * F.when(fwd, hom).otherwise(gt)).alias("_r"))
    return s.select(*site, (F.greatest("_f", "_r") - c("_all")).alias("strand_bias"))


def site_quality(samples: DataFrame, site: list[str], p_ref: str = "p_ref") -> DataFrame:
    """(site, qual): the phred score of all samples' being the reference's."""
    return samples.groupBy(*site).agg(F.floor(F.sum(numeric.phred(F.col(p_ref))) + 0.5).cast("int").alias("qual"))


def alt_ranking(counts: DataFrame, site: list[str], sample: str = "sample", base: str = "base", n: str = "n", ref: str = "ref", ploidy: int = 2, least: float = 0.1) -> DataFrame:
    """(site, base, score, rank): each sample's ``ploidy`` commonest bases with at least a tenth of its calls score ploidy, ploidy - 1, …; alternates rank by their sum."""
    w = Window.partitionBy(*site, sample)
    ranked = counts.withColumn("_r", F.row_number().over(w.orderBy(F.desc(n), base))).withColumn("_all", F.sum(n).over(w))
    scored = ranked.where((F.col("_r") <= ploidy) & (F.col(n) >= least * F.col("_all")) & (F.col(base) != F.col(ref)))
    total = scored.groupBy(*site, base).agg(F.sum(ploidy + 1 - F.col("_r")).alias("score"))
    return total.withColumn("rank", F.row_number().over(Window.partitionBy(*site).orderBy(F.desc("score"), base)))


def allele_support(calls: DataFrame, site: list[str]) -> DataFrame:
    """(site, ad, adf, adr): calls of each base, in all and by strand."""
    n = lambda cond, b: F.count_if(cond & (F.col("base") == b))
    fwd = F.col("strand") == "+"
    return calls.groupBy(*site).agg(F.array(*(n(F.lit(True), b) for b in BASES)).alias("ad"), F.array(*(n(fwd, b) for b in BASES)).alias("adf"), F.array(*(n(~fwd, b) for b in BASES)).alias("adr"))


def continuous_sites(counts: DataFrame, site: list[str], least: float = 0.01) -> DataFrame:
    """Alleles (site, base, n, fwd, rev, total, fwd_total, rev_total) of a pool of unknown ploidy: frequency, quality, strand bias."""
    from ..functions.stats import _each, continuous_quality, continuous_strand_bias

    rows = counts.where(F.col("n") >= least * F.col("total"))
    q = _each(lambda n, k: float(continuous_quality(int(n), int(k))), "double", F.col("total"), F.col("n"))
    sb = _each(lambda a, b, c, d: continuous_strand_bias(int(a), int(b), int(c), int(d)), "double", F.col("fwd"), F.col("rev"), F.col("fwd_total") - F.col("fwd"), F.col("rev_total") - F.col("rev"))
    return rows.withColumn("vf", numeric.safe_frac(F.col("n"), F.col("total"))).withColumn("qual", q.cast("int")).withColumn("sb", sb)
