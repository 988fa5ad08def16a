"""gVCF: which sites may be compressed, blocks of similar sites, and lines."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What the sites of a block have in common.
SAME = ("filters", "gt", "ploidy", "covered", "used_covered")


def compressible(variant: Column, forced: Column, alt_fraction: Column, most: float = 0.2) -> Column:
    return ~variant & ~forced & (F.coalesce(alt_fraction, F.lit(0.0)) < most)


def within(lo: float, hi: float, fraction: float = 0.3, absolute: int = 3, divisor: float = 2.0) -> bool:
    """Whether values from ``lo`` to ``hi`` may share a block: the tolerance is absolute, or a share of the least where that is more."""
    m = int(lo + 0.5)
    if m + absolute >= hi / divisor:
        return True
    t = int(m * fraction)
    return t > absolute and m + t >= hi / divisor


def blocks(sites: DataFrame, contig: str = "contig_id", segment: str = "segment_id", fraction: float = 0.3, absolute: int = 3, divisor: float = 2.0) -> DataFrame:
    """(contig, segment, begin, end, n, filters, gt, ploidy, min_dp, min_dpf, min_gqx) from compressible sites (pos, dp, dpf, gqx and the columns of SAME).

    Sites go in order of position and join the open block if they follow it, have what its sites have in common, and
    leave its depths and GQX in tolerance; a site with a GQX and one without don't share a block. So the result depends on order, and segments are worked through one by one, of bounded size each.
    """
    cols = [contig, segment, "pos", "dp", "dpf", "gqx", *SAME]
    schema = f"{contig} int, {segment} int, begin long, end long, n long, filters string, gt string, ploidy int, min_dp long, min_dpf long, min_gqx double"

    def go(pdf: pd.DataFrame) -> pd.DataFrame:
        out, open_ = [], None
        for r in pdf.sort_values("pos", kind="stable").itertuples(index=False):
            same = tuple(getattr(r, c) for c in SAME)
            gqx = None if r.gqx is None or r.gqx != r.gqx else float(r.gqx)
            if open_ and r.pos == open_["end"] + 1 and same == open_["same"] and (gqx is None) == (open_["gqx"] is None):
                ranges = [(min(a, v), max(b, v)) for (a, b), v in zip(open_["ranges"], (r.dp, r.dpf), strict=True)]
                g = None if gqx is None else (min(open_["gqx"][0], gqx), max(open_["gqx"][1], gqx))
                if all(within(a, b, fraction, absolute, divisor) for a, b in [*ranges, *([g] if g else [])]):
                    open_.update(end=r.pos, ranges=ranges, gqx=g)
                    continue
            if open_:
                out.append(open_)
            open_ = {"begin": r.pos, "end": r.pos, "same": same, "ranges": [(r.dp, r.dp), (r.dpf, r.dpf)], "gqx": None if gqx is None else (gqx, gqx), "key": (getattr(r, contig), getattr(r, segment))}
        if open_:
            out.append(open_)
        rows = [(*b["key"], b["begin"], b["end"], b["end"] - b["begin"] + 1, b["same"][0], b["same"][1], b["same"][2], b["ranges"][0][0], b["ranges"][1][0], b["gqx"][0] if b["gqx"] else None) for b in out]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    return sites.select(*cols).groupBy(contig, segment).applyInPandas(go, schema)


def site_lines(sites: DataFrame, chrom: Column) -> DataFrame:
    """(contig_id, pos, line) of variant sites (pos, ref, alt, qual, filters array, gt, gq, gqx, dp, dpf, ad array, pl array)."""
    c = F.col
    text = lambda x: F.coalesce(x.cast("string"), F.lit("."))
    sample = F.concat_ws(":", "gt", text(c("gq")), text(c("gqx")), text(c("dp")), text(c("dpf")), F.array_join("ad", ","), F.array_join("pl", ","))
    line = F.concat_ws("\t", chrom, c("pos").cast("string"), F.lit("."), "ref", F.coalesce("alt", F.lit(".")), text(c("qual")), F.when(F.size("filters") == 0, "PASS").otherwise(F.array_join("filters", ";")), F.lit("."), F.lit("GT:GQ:GQX:DP:DPF:AD:PL"), sample)
    return sites.select("contig_id", "pos", line.alias("line"))


def block_lines(blocks_: DataFrame, chrom: Column, ref: Column) -> DataFrame:
    """(contig_id, pos, line) of blocks."""
    c = F.col
    sample = F.concat_ws(":", "gt", F.coalesce(c("min_gqx").cast("int").cast("string"), F.lit(".")), c("min_dp").cast("string"), c("min_dpf").cast("string"))
    line = F.concat_ws("\t", chrom, c("begin").cast("string"), F.lit("."), ref, F.lit("."), F.lit("."), F.when(c("filters") == "", "PASS").otherwise(c("filters")), F.concat(F.lit("END="), c("end").cast("string")), F.lit("GT:GQX:DP:DPF"), sample)
    return blocks_.select("contig_id", c("begin").alias("pos"), line.alias("line"))


def header(contigs: Iterator[tuple[str, int]], sample: str, depths: dict[str, float] | None = None) -> list[str]:
    """A gVCF's header lines."""
    out = ["##fileformat=VCFv4.1"]
    out += [f"##contig=<ID={n},length={size}>" for n, size in contigs]
    out += [f"##Depth_{n}={d:.2f}" for n, d in sorted((depths or {}).items())]
    out += ['##INFO=<ID=END,Number=1,Type=Integer,Description="End position of the block">']
    out += [f'##FORMAT=<ID={i},Number={n},Type={t},Description="{d}">' for i, n, t, d in (("GT", "1", "String", "Genotype"), ("GQ", "1", "Integer", "Genotype quality"), ("GQX", "1", "Integer", "Lesser of the genotype qualities under two priors"), ("DP", "1", "Integer", "Used depth"), ("DPF", "1", "Integer", "Filtered depth"), ("AD", ".", "Integer", "Allele depths"), ("PL", "G", "Integer", "Phred-scaled likelihoods"))]
    out += [f'##FILTER=<ID={i},Description="{d}">' for i, d in (("LowGQX", "GQX is low"), ("HighDepth", "Depth is high for the chromosome"), ("HighDPFRatio", "Many base calls are filtered"), ("HighSNVSB", "Strand bias is high"), ("LowDepth", "Depth is low"), ("PloidyConflict", "Genotype and ploidy disagree"), ("IndelConflict", "Indels overlap"), ("SiteConflict", "Site is in a filtered or conflicting indel"))]
    return [*out, "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t" + sample]
