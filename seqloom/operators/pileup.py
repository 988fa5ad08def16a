"""Pileups of aligned reads, simple SNP calls from them, and complex positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numeric, seq
from .intervals import asof_forward
from .ordered import cluster_flag

REVERSE = 0x10


def base_calls(alignments: DataFrame) -> DataFrame:
    """A row for each aligned base and each deleted position: contig_id, segment_id, pos, op, base, q, mapq, reverse, off, ungapped.

    M, = and X consume read and reference, D and N the reference, I and S the read; only M-like operations and D come out.
    Two explodes (of the outer kind, for which no filter is inferred that would make the arrays twice): operations of a read, each with its own stretch of bases and qualities, then the places of a stretch; the
    rows of the second carry one base, not the read.
    """
    ops = alignments.select("read_id", "contig_id", "segment_id", "pos", "mapq", "seq", "quals", (F.col("flag").bitwiseAND(REVERSE) != 0).alias("reverse"), seq.is_ungapped(F.col("cigar")).alias("ungapped"), F.explode(seq.op_offsets(F.col("cigar"))).alias("o"))
    ops = ops.where(F.col("o.op").isin("M", "=", "X", "D") & (F.col("o.len") > 0))
    match = F.col("o.op") != "D"
    bases = F.split(F.upper(F.substr("seq", F.col("o.q") + 1, F.col("o.len"))), "")
    calls = F.arrays_zip(bases.alias("b"), F.slice("quals", F.col("o.q") + 1, F.col("o.len")).alias("q"))
    none = F.array_repeat(F.lit(None).cast("struct<b:string,q:tinyint>"), F.col("o.len"))
    kept = ops.select("read_id", "contig_id", "segment_id", "mapq", "reverse", "ungapped", (F.col("pos") + F.col("o.r")).alias("at"), F.when(match, F.col("o.q")).alias("first"), F.when(match, calls).otherwise(none).alias("calls"))
    each = kept.select("read_id", "contig_id", "segment_id", "mapq", "reverse", "ungapped", "at", "first", F.posexplode_outer("calls").alias("j", "c"))
    return each.select(
        "read_id",
        "contig_id",
        "segment_id",
        (F.col("at") + F.col("j")).alias("pos"),
        F.when(F.col("first").isNotNull(), "M").otherwise("D").alias("op"),
        F.col("c.b").alias("base"),
        F.col("c.q").cast("int").alias("q"),
        "mapq",
        "reverse",
        (F.col("first") + F.col("j")).alias("off"),
        "ungapped",
    )


def inserted_positions(alignments: DataFrame) -> DataFrame:
    """(contig_id, segment_id, pos): where a read has an insertion or starts a deletion."""
    ops = alignments.select("contig_id", "segment_id", "pos", F.explode(seq.op_offsets(F.col("cigar"))).alias("o"))
    return ops.where(F.col("o.op").isin("I", "D")).select("contig_id", "segment_id", (F.col("pos") + F.col("o.r")).alias("pos")).distinct()


def pileup(alignments: DataFrame, reference: DataFrame) -> DataFrame:
    """Counts by position. ``reference``: (contig_id, pos, base).

    Bases are summed by (position, base) before the reference is joined, so the join sees a few rows a position, not the reads'.
    A base counts if its read's mapping quality and its own quality are above 0; depth counts such A, C, G and T, of gapped
    reads any base, and deletions with a mapping quality above 0. Strand totals and mismatches count all of A, C, G and T.
    """
    b = base_calls(alignments)
    usable = (F.col("mapq") > 0) & (F.col("q") > 0)
    acgt = F.col("base").isin("A", "C", "G", "T")
    deleted = F.col("op") == "D"
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    by = b.groupBy("contig_id", "segment_id", "pos", F.coalesce("base", F.lit("-")).alias("base")).agg(
        one(~deleted & acgt & usable).alias("n"),
        one(F.when(deleted, F.col("mapq") > 0).otherwise(usable & (acgt | ~F.col("ungapped")))).alias("depth"),
        one(~deleted & acgt & ~F.col("reverse")).alias("fwd"),
        one(~deleted & acgt & F.col("reverse")).alias("rev"),
        F.sum(F.when(acgt, F.col("mapq")).otherwise(0)).alias("mq"),
        F.sum(F.when(acgt, F.col("q")).otherwise(0)).alias("bq"),
        F.sum(F.when(acgt & usable, F.col("off")).otherwise(0)).alias("offs"),
    )
    ref = reference.select("contig_id", "pos", F.upper("base").alias("ref"))
    j = by.join(ref, ["contig_id", "pos"])
    alt = F.col("base").isin("A", "C", "G", "T") & (F.col("base") != F.col("ref"))
    pick = lambda c, v: F.sum(F.when(c, F.col(v)).otherwise(0))
    return j.groupBy("contig_id", "segment_id", "pos", "ref").agg(
        *(pick(F.col("base") == x.upper(), "n").alias(f"c_{x}") for x in "actg"),
        F.sum("depth").alias("depth"),
        pick(alt, "fwd").alias("fwd_alt"),
        F.sum("fwd").alias("fwd_total"),
        pick(alt, "rev").alias("rev_alt"),
        F.sum("rev").alias("rev_total"),
        pick(alt, "mq").alias("mapq_sum"),
        pick(alt, "bq").alias("bq_alt_sum"),
    )


def assess(pile: DataFrame, aaf: float = 20, min_alt: int = 1, min_depth: int = 1, min_mapq: int = 20, min_bq: int = 10, sb_tenths: int = 1) -> DataFrame:
    """The pileup with alt, its share, strand ratios, mean qualities and the verdicts ``is_call`` and ``is_complex``.

    The strand ratio is compared in whole numbers: above a tenth if ten times the fewer exceed the more.
    """
    c = F.col
    count = lambda base: F.when(base == "A", c("c_a")).when(base == "C", c("c_c")).when(base == "T", c("c_t")).when(base == "G", c("c_g")).otherwise(0)
    p = pile.withColumn("alt", numeric.best_alt(c("ref"), c("c_a"), c("c_c"), c("c_t"), c("c_g"))).withColumn("alt_n", count(c("alt"))).withColumn("ref_n", count(c("ref")))
    r1, r2, low = numeric.strand_ratio(c("fwd_alt"), c("rev_alt"), c("fwd_total"), c("rev_total"))
    p = p.withColumns({"aaf": numeric.percent_of(c("alt_n"), c("depth")), "sb": r1, "sbt": r2, "sb_low": low})
    lo, hi = F.least("fwd_alt", "rev_alt"), F.greatest("fwd_alt", "rev_alt")
    one_sided, balanced = (c("fwd_total") == 0) | (c("rev_total") == 0), 10 * lo > sb_tenths * hi
    whole = lambda a, b: F.floor(F.try_divide(a.cast("double"), b)).cast("long")
    p = p.withColumns({"avg_mapq": whole(c("mapq_sum"), c("depth") - c("ref_n")), "avg_bq": whole(c("bq_alt_sum"), c("fwd_alt") + c("rev_alt"))})
    cand = (c("aaf") > aaf) & (c("alt") != c("ref")) & (c("alt_n") > min_alt) & (c("depth") > min_depth)
    good = F.coalesce(c("avg_mapq") >= min_mapq, F.lit(False))
    return p.withColumns(
        {
            "gt": numeric.simple_genotype(c("aaf")),
            "is_complex": F.coalesce(cand & good & ~balanced & ~one_sided, F.lit(False)),
            "is_call": F.coalesce(cand & (balanced | ((lo == 0) & one_sided)) & good & (c("avg_bq") >= min_bq), F.lit(False)),
        }
    )


def snp_calls(assessed: DataFrame, within: int = 10, by_segment: bool = True) -> DataFrame:
    """Called positions with their cluster flag; segments (or contigs) are separate."""
    keys = ["contig_id", "segment_id"] if by_segment else ["contig_id"]
    return cluster_flag(assessed.where("is_call"), keys, "pos", within)


def complex_positions(assessed: DataFrame, alignments: DataFrame) -> DataFrame:
    """(contig_id, pos): insertions, deletions, and candidates whose strands disagree."""
    return assessed.where("is_complex").select("contig_id", "pos").unionByName(inserted_positions(alignments).select("contig_id", "pos")).distinct()


def reads_near(alignments: DataFrame, positions: DataFrame, tolerance: int = 220) -> DataFrame:
    """Reads that start less than ``tolerance`` before the next listed position."""
    return asof_forward(alignments, positions, ["contig_id"], "pos", tolerance, name="near_pos")


def vcf_lines(calls: DataFrame, chrom: Column) -> DataFrame:
    """(contig_id, pos, line): one tab-separated line for each call."""
    c = F.col
    info = F.format_string(
        "DP=%d;ACTG=%d,%d,%d,%d;FC=%d;RC=%d;FT=%d;RT=%d;SB=%.2f;SBT=%.3f;SBLow=%d;AAF=%.2f;CLS=%d",
        *(c(x) for x in ("depth", "c_a", "c_c", "c_t", "c_g", "fwd_alt", "rev_alt", "fwd_total", "rev_total")), F.coalesce("sb", F.lit(0.0)), F.coalesce("sbt", F.lit(0.0)), "sb_low", "aaf", "cls",
    )
    return calls.select("contig_id", "pos", F.concat_ws("\t", chrom, c("pos").cast("string"), F.lit("."), "ref", "alt", c("avg_mapq").cast("string"), F.lit("."), info, F.lit("GT"), "gt").alias("line"))
