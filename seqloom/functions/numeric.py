"""Scalar functions on numbers, as Column expressions: phred scores, log sums, medians, codes, hashes, mapping quality."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def best_alt(ref: Column, a: Column, c: Column, t: Column, g: Column) -> Column:
    """The alternate base with most reads. Of the three that aren't the reference, taken in the order A, C, T, G with G
    before T unless the reference is T, a later one wins only if it has strictly more, except that of the first two the
    second wins ties. Another reference has none."""

    def of(first, second, third):
        (n1, c1), (n2, c2), (n3, c3) = first, second, third
        lead = F.when(c1 > c2, F.lit(n1)).otherwise(F.lit(n2))
        return F.when(c3 > F.greatest(c1, c2), F.lit(n3)).otherwise(lead)

    x = {"A": ("A", a), "C": ("C", c), "G": ("G", g), "T": ("T", t)}
    return (
        F.when(ref == "A", of(x["C"], x["G"], x["T"]))
        .when(ref == "C", of(x["A"], x["G"], x["T"]))
        .when(ref == "T", of(x["A"], x["C"], x["G"]))
        .when(ref == "G", of(x["A"], x["C"], x["T"]))
    )


def percent_of(part: Column, whole: Column) -> Column:
    """100 * part / whole; null where the whole is 0."""
    return F.try_divide(part * F.lit(100.0), whole)


def simple_genotype(aaf: Column, hom_above: float = 80) -> Column:
    return F.when(aaf > hom_above, "1/1").otherwise("0/1")


def strand_ratio(fwd_alt: Column, rev_alt: Column, fwd: Column, rev: Column) -> tuple[Column, Column, Column]:
    """(alt ratio, total ratio, total of the strand with fewer alts); the ratios have the strand with fewer alts on top."""
    fewer = fwd_alt < rev_alt
    over = lambda x, y: F.try_divide(x.cast("double"), y)
    return F.when(fewer, over(fwd_alt, rev_alt)).otherwise(over(rev_alt, fwd_alt)), F.when(fewer, over(fwd, rev)).otherwise(over(rev, fwd)), F.when(fewer, fwd).otherwise(rev)


def phred(p: Column) -> Column:
    """-10 log10 p, with p no less than the smallest double of normal size."""
    return -10 * F.log10(F.greatest(p, F.lit(1e-307)))


def phred_int(p: Column) -> Column:
    return F.floor(phred(p) + 0.5).cast("int")


def error_prob(q: Column) -> Column:
    return F.pow(F.lit(10.0), -q / 10.0)


def ln_one_minus_error(q: Column) -> Column:
    return F.log1p(-error_prob(q))


def mapping_adjusted_error(base_error: Column, mapq: Column, floor: int = 5, until: int = 80) -> Column:
    """The chance that a base is wrong or its read elsewhere; mapping qualities above ``until`` adjust nothing."""
    me = error_prob(F.greatest(mapq, F.lit(floor)))
    return F.when(mapq <= until, (1 - me) * base_error + 0.75 * me).otherwise(base_error)


def log_sum(a: Column, b: Column) -> Column:
    """ln(e^a + e^b)."""
    return F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b)))


def safe_frac(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def median_upper(xs: Column) -> Column:
    """The middle element of an array, of an even number the upper one."""
    return F.try_element_at(F.array_sort(xs), (F.size(xs) / 2).cast("int") + 1)


def normalize_log(xs: Column) -> Column:
    """Log weights to probabilities."""
    top = F.array_max(xs)
    w = F.transform(xs, lambda x: F.exp(x - top))
    return F.transform(w, lambda x: x / F.aggregate(w, F.lit(0.0), lambda a, y: a + y))


def argmax(xs: Column) -> Column:
    """The place, from 0, of the largest element; the first of equals."""
    return F.array_position(xs, F.array_max(xs)) - 1


def scale_clamp(x: Column, low: float, high: float) -> Column:
    """0 up to ``low``, 1 from ``high``, linear between."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), (x - low) / (high - low)))


def log_compress(x: Column, bits: int) -> Column:
    """Whole numbers rounded to their ``bits`` leading binary digits and half of what that leaves open: nearly log-spaced classes."""
    drop = F.greatest(F.length(F.bin(x)) - bits, F.lit(0))
    # 2**drop and not a shift, whose number of places can't be a column
    unit = F.pow(F.lit(2.0), drop).cast("long")
    return F.when(drop > 0, F.floor(x / unit) * unit + F.floor(unit / 2)).otherwise(x.cast("long"))


def hash64(key: Column, mask_bits: int = 56) -> Column:
    """An invertible mix of a ``mask_bits``-bit integer, by shifts and sums; wraps as unsigned arithmetic does."""
    mask = (1 << mask_bits) - 1
    m = lambda x: x.bitwiseAND(F.lit(mask))
    up = lambda x, n: m(F.shiftleft(x, n))
    fold = lambda x, n: x.bitwiseXOR(F.shiftrightunsigned(x, n))
    # each term is masked before the sum, so that no sum reaches 63 bits
    x = fold(m(m(F.bitwise_not(key)) + up(key, 21)), 24)
    x = fold(m(x + up(x, 3) + up(x, 8)), 14)
    x = fold(m(x + up(x, 2) + up(x, 4)), 28)
    return m(x + up(x, 31))


def mapping_quality(identity: Column, penalty: Column, second_ratio: Column, dp_max: Column, match_score: int, n_sub: Column) -> Column:
    """0..60 from a hit's identity, the ratio of the second-best score, its own score and the number of rivals."""
    raw = identity * penalty * 40 * (1 - second_ratio * second_ratio) * F.ln(dp_max / match_score) - 4.343 * F.ln(n_sub + 1)
    return F.least(F.lit(60), F.greatest(F.lit(0), F.floor(raw + 0.499).cast("int")))


def paired_mapping_quality(own: Column, pair: Column) -> Column:
    return F.when(pair > own, F.floor(0.2 * own + 0.8 * pair + 0.499).cast("int")).otherwise(own)


def homopolymer_indel_error(length: Column, low: float = 5e-5, high: float = 3e-4, longest: int = 16) -> Column:
    """The indel error rate of a run of equal bases: log-linear from length 1 to ``longest``, level beyond."""
    at = (F.least(length, F.lit(longest)) - 1) / (longest - 1)
    return F.exp((1 - at) * math.log(low) + at * math.log(high))


def genotype_priors(theta: float = 0.001) -> dict[str, dict[str, float]]:
    """For each reference base, the prior of the ten unordered genotypes: alternate homozygotes theta/6, heterozygotes with the
    reference theta/3, without it theta²/3, the reference homozygote what is left; N has the mean of the four."""
    bases = "ACGT"
    genotypes = [a + b for i, a in enumerate(bases) for b in bases[i:]]
    out = {}
    for r in bases:
        p = {g: theta / 6 if g[0] == g[1] else theta / 3 if r in g else theta * theta / 3 for g in genotypes}
        p[r + r] = 1 - sum(v for g, v in p.items() if g != r + r)
        out[r] = p
    out["N"] = {g: sum(out[r][g] for r in bases) / 4 for g in genotypes}
    return out


def polymorphic_priors(theta: float = 0.001) -> dict[str, dict[str, float]]:
    """As ``genotype_priors``, for a site that is known to vary."""
    bases = "ACGT"
    genotypes = [a + b for i, a in enumerate(bases) for b in bases[i:]]
    out = {}
    for r in bases:
        out[r] = {g: 0.25 * (1 - theta) if g == r + r else (1 - theta) / 12 if g[0] == g[1] else (1 - theta) / 6 if r in g else theta / 3 for g in genotypes}
    out["N"] = {g: sum(out[r][g] for r in bases) / 4 for g in genotypes}
    return out


def parse_suffixed(s: Column) -> Column:
    """``10k``, ``2M``, ``1g`` as numbers; null where the text is no number."""
    unit = F.lower(F.regexp_extract(s, "([kKmMgG])$", 1))
    return F.regexp_replace(s, "[kKmMgG]$", "").try_cast("double") * F.when(unit == "k", 1e3).when(unit == "m", 1e6).when(unit == "g", 1e9).otherwise(1.0)
