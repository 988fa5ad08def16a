"""Filters of reads, base calls and variants. A variant's filters are an array of labels; PASS is the empty one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import seq

# Bits of an alignment's flag, in the order in which reads are refused.
REFUSED = (("qc_fail", 0x200), ("duplicate", 0x400), ("unmapped", 0x4), ("secondary", 0x100), ("supplementary", 0x800))


def refusal(flag: Column) -> Column:
    """Why a read isn't taken in, the first reason that holds; null if it is."""
    out = F.when(F.lit(False), F.lit(""))
    for name, bit in REFUSED:
        out = out.when(flag.bitwiseAND(bit) != 0, name)
    return out


def mapping_tier(flag: Column, mapq: Column, tier1: int = 20, tier2: int = 0) -> Column:
    """1, 2, or 0 for reads mapped too badly for either; a pair must be mapped properly for tier 1."""
    paired = flag.bitwiseAND(0x1) != 0
    proper = (flag.bitwiseAND(0x2) != 0) & (flag.bitwiseAND(0x8) == 0)
    return F.when((mapq >= tier1) & (~paired | proper), 1).when(mapq >= tier2, 2).otherwise(0)


def read_problem(seq_: Column, quals: Column, cigar: Column, longest: int = 10_000) -> Column:
    """What makes a record unusable, or null."""
    return (
        F.when(F.length(seq_) == 0, "empty")
        .when(F.length(seq_) > longest, "too_long")
        .when(seq_.rlike("[^ACGTNacgtn]"), "bad_base")
        .when(F.exists(quals, lambda q: (q == 255) | (q == -1)), "no_quality")
        .when(F.exists(quals, lambda q: q > 70), "high_quality")
        .when(~seq.has_match(cigar), "floating")
    )


def mismatch_density(bases: DataFrame, read: list[str], offset: str, mismatch: Column, flank: int = 20, most: int = 2, length: str = "read_length") -> DataFrame:
    """Bases with ``near``, the mismatches in the window of 2 * flank + 1 places around each, and ``dense`` where there are more than ``most``.

    The window's centre is kept ``flank`` from the read's ends. Positions without a row count nothing.
    """
    w = Window.partitionBy(*read).orderBy(offset)
    centre = F.greatest(F.lit(flank), F.least(F.col(offset), F.col(length) - flank - 1))
    run = bases.withColumn("_m", mismatch.cast("int"))
    # around a row, a range; at the ends, the sum over the first or last places of the read
    mid = F.sum("_m").over(w.rangeBetween(-flank, flank))
    first = F.sum(F.when(F.col(offset) <= 2 * flank, F.col("_m"))).over(Window.partitionBy(*read))
    last = F.sum(F.when(F.col(offset) >= F.col(length) - 2 * flank - 1, F.col("_m"))).over(Window.partitionBy(*read))
    near = F.when(centre == F.col(offset), mid).when(centre > F.col(offset), first).otherwise(last)
    out = run.withColumn("near", F.coalesce(near, F.lit(0)))
    return out.withColumn("dense", F.col("near") > most).withColumn("neighbour_mismatch", F.col("near") - F.col("_m") > 0).drop("_m")


def usable_call(base: Column, q: Column, dense: Column | None = None, min_q: int = 17) -> Column:
    ok = base.isin("A", "C", "G", "T") & (q >= min_q)
    return ok if dense is None else ok & ~dense


def away_from_edges(offset: Column, length: Column, distance: int) -> Column:
    return offset.between(distance, length - distance - 1)


def cap_depth(alignments: DataFrame, most: int = 1000, contig: str = "contig_id", segment: str = "segment_id") -> DataFrame:
    """Reads in order of position; one that would be beyond ``most`` over any of its places is dropped. Order matters, so segments are worked through one by one."""
    import numpy as np

    def go(pdf):
        if pdf.empty:
            return pdf
        pdf = pdf.sort_values(["pos", "read_id"], kind="stable")
        base = int(pdf.pos.min())
        depth = np.zeros(int(pdf.end.max()) - base + 1, np.int64)
        keep = np.zeros(len(pdf), bool)
        for i, (a, b) in enumerate(zip(pdf.pos.to_numpy() - base, pdf.end.to_numpy() - base, strict=True)):
            if a < b and depth[a:b].max() >= most:
                continue
            depth[a:b] += 1
            keep[i] = True
        return pdf[keep]

    light = alignments.select("read_id", contig, segment, "pos", (F.col("pos") + seq.ref_length(F.col("cigar"))).alias("end"))
    kept = light.groupBy(contig, segment).applyInPandas(go, light.schema).select("read_id")
    return alignments.join(kept, "read_id", "left_semi")


def labels(**conditions: Column) -> Column:
    """The names of the conditions that hold, in order; unknown ones don't."""
    return F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in conditions.items())))


def filter_text(filters: Column) -> Column:
    return F.when(F.size(filters) == 0, "PASS").otherwise(F.array_join(filters, ";"))


def germline_filters(variant: Column, gqx: Column, dp: Column, dpf: Column, chrom_depth: Column, snv_sb: Column, ploidy_conflict: Column, hpol: Column | None = None, ref_rep: Column | None = None, min_gqx: int = 15, min_homref_gqx: int = 15, depth_factor: float = 3, max_dpf_ratio: float = 0.4, max_sb: float = 10, min_depth: int = 3, max_hpol: int | None = None, max_ref_rep: int | None = None) -> Column:
    """Labels of a germline site or indel; a limit of None is off."""
    found = {
        "LowGQX": gqx < F.when(variant, min_gqx).otherwise(min_homref_gqx),
        "HighDepth": dp > depth_factor * chrom_depth,
        "HighDPFRatio": F.try_divide(dpf.cast("double"), dp + dpf) > max_dpf_ratio,
        "HighSNVSB": snv_sb > max_sb,
        "LowDepth": dp + dpf < min_depth,
        "PloidyConflict": ploidy_conflict,
    }
    if max_hpol is not None and hpol is not None:
        found["HighSNVHPOL"] = hpol > max_hpol
    if max_ref_rep is not None and ref_rep is not None:
        found["HighREFREP"] = ref_rep > max_ref_rep
    return labels(**found)


def somatic_snv_filters(depth: Column, normal_depth: Column, chrom_depth: Column, filtered_fraction: Column, spanning_deletions: Column, qss_nt: Column, nt: Column, depth_factor: float = 3) -> Column:
    return labels(HighDepth=normal_depth > depth_factor * chrom_depth, BCNoise=filtered_fraction >= 0.4, SpanDel=spanning_deletions > 0.75, QSS_ref=(nt != "ref") | (qss_nt < 15), LowDepth=depth < 2)


def somatic_indel_filters(depth: Column, normal_depth: Column, chrom_depth: Column, window_noise: Column, qsi_nt: Column, nt: Column, depth_factor: float = 3) -> Column:
    return labels(HighDepth=normal_depth > depth_factor * chrom_depth, BCNoise=window_noise >= 0.3, QSI_ref=(nt != "ref") | (qsi_nt < 40), LowDepth=depth < 2)


def union_filters(*filters: Column) -> Column:
    return reduce(F.array_union, filters)


def shared_filters(samples: DataFrame, locus: list[str], filters: str = "filters") -> DataFrame:
    """(locus, filters): those that every sample of the locus has."""
    n = samples.groupBy(*locus).agg(F.count("*").alias("_n"))
    each = samples.select(*locus, F.explode(F.array_distinct(filters)).alias("_f")).groupBy(*locus, "_f").agg(F.count("*").alias("_k"))
    return n.join(each, locus, "left").groupBy(*locus).agg(F.array_sort(F.collect_set(F.when(F.col("_k") == F.col("_n"), F.col("_f")))).alias(filters))


def small_variants(calls: DataFrame, most: int = 50) -> DataFrame:
    """Without symbolic alleles, breakends and alleles longer than ``most``."""
    return calls.where(~F.exists("alt", lambda a: a.rlike(r"[<>\[\]:]")) & (F.length("ref") <= most + 1) & F.forall("alt", lambda a: F.length(a) <= most + 1))
