"""Active regions, their haplotypes, local assembly, phasing, and runs of the reference."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import seq
from .align import global_align


def active_regions(sites: DataFrame, gap: int = 13, least: float = 9, low: float = 0.2, high: float = 0.35, least_sites: int = 2) -> DataFrame:
    """(contig_id, begin, end, sites) from (contig_id, pos, variants, depth): places with many variant reads, chained while within ``gap``."""
    v, d = F.col("variants"), F.col("depth")
    cand = sites.where(((v >= least) & (v >= low * d)) | (v >= high * d)).where("variants > 0")
    w = Window.partitionBy("contig_id").orderBy("pos")
    new = F.when(F.lag("pos").over(w).isNull() | (F.col("pos") - F.lag("pos").over(w) > gap), 1).otherwise(0)
    run = cand.withColumn("_new", new).withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return run.groupBy("contig_id", "_g").agg(F.min("pos").alias("begin"), F.max("pos").alias("end"), F.count("*").alias("sites")).where(F.col("sites") >= least_sites).drop("_g")


def extend_to_anchors(regions: DataFrame, anchors: DataFrame) -> DataFrame:
    """Regions widened to the nearest anchor (contig_id, pos) at or before their begin and at or after their end."""
    tag = lambda c, k: regions.select("contig_id", F.col(c).alias("_p"), F.lit(k).alias("_k"), F.struct("begin", "end", "sites").alias("_r"))
    marks = anchors.select("contig_id", F.col("pos").alias("_p"), F.lit(1).alias("_k"), F.col("pos").alias("_a"))
    back = Window.partitionBy("contig_id").orderBy("_p", "_k").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("contig_id").orderBy(F.desc("_p"), F.desc("_k")).rowsBetween(Window.unboundedPreceding, 0)
    left = tag("begin", 2).unionByName(marks, allowMissingColumns=True).withColumn("_l", F.last("_a", True).over(back)).where("_k = 2").select("contig_id", "_r", "_l")
    right = tag("end", 0).unionByName(marks, allowMissingColumns=True).withColumn("_e", F.last("_a", True).over(ahead)).where("_k = 0").select("contig_id", "_r", "_e")
    return left.join(right, ["contig_id", "_r"]).select("contig_id", F.coalesce("_l", "_r.begin").alias("begin"), F.coalesce("_e", "_r.end").alias("end"), "_r.sites")


def haplotypes(segments: DataFrame, least: int = 3, most: int = 2) -> DataFrame:
    """(region, hap, reads, rank) from segments (region, read_id, hap) that span their region: those with ``least`` reads, the best ``most``."""
    c = segments.groupBy("region", "hap").agg(F.count_distinct("read_id").alias("reads")).where(F.col("reads") >= least)
    return c.withColumn("rank", F.row_number().over(Window.partitionBy("region").orderBy(F.desc("reads"), "hap"))).where(F.col("rank") <= most)


def assemble(reads: list[str], least_word: int = 20, most_word: int = 76, step: int = 5, least_count: int = 2, most_contigs: int = 10) -> list[str]:
    """Contigs of a de Bruijn graph, from the shortest word size whose graph has no cycle; the best supported come first."""
    for k in range(least_word, most_word + 1, step):
        words = Counter(r[i : i + k] for r in reads for i in range(len(r) - k + 1))
        good = {w for w, n in words.items() if n >= least_count}
        if not good:
            return []
        after: dict[str, list[str]] = {}
        before: Counter = Counter()
        for w in sorted(good):
            after[w] = [w[1:] + b for b in "ACGT" if w[1:] + b in good]
            before.update(after[w])
        if _cyclic(after):
            continue
        found = []
        for start in sorted(w for w in good if before[w] != 1 or len(after.get(_only_before(w, good), ())) > 1):
            w, contig, support = start, start, words[start]
            while len(after[w]) == 1 and before[after[w][0]] == 1:
                w = after[w][0]
                contig, support = contig + w[-1], support + words[w]
            found.append((support / (len(contig) - k + 1), contig))
        return [c for _, c in sorted(found, key=lambda x: (-len(x[1]), -x[0], x[1]))[:most_contigs]]
    return []


def _only_before(w: str, good: set[str]) -> str:
    return next((b + w[:-1] for b in "ACGT" if b + w[:-1] in good), "")


def _cyclic(after: dict[str, list[str]]) -> bool:
    into = Counter(b for bs in after.values() for b in bs)
    ready = [w for w in after if not into[w]]
    seen = 0
    while ready:
        w = ready.pop()
        seen += 1
        for b in after[w]:
            into[b] -= 1
            if not into[b]:
                ready.append(b)
    return seen < len(after)


def assemble_regions(segments: DataFrame, most_reads: int = 1000, **how) -> DataFrame:
    """(region, contig, rank) from segments (region, read_id, hap). A region with more reads than ``most_reads`` is bypassed: it is not assembled, and says so with a null contig."""

    def go(pdf: pd.DataFrame) -> pd.DataFrame:
        region = pdf.region.iloc[0]
        found = assemble(sorted(pdf.hap), **how)
        return pd.DataFrame({"region": [region] * len(found), "contig": found, "rank": range(1, len(found) + 1)})

    size = segments.groupBy("region").agg(F.count("*").alias("_n"))
    kind = segments.schema["region"].dataType.simpleString()
    small = segments.join(size.where(F.col("_n") <= most_reads), "region").select("region", "read_id", "hap")
    over = size.where(F.col("_n") > most_reads).select("region", F.lit(None).cast("string").alias("contig"), F.lit(0).alias("rank"))
    return small.groupBy("region").applyInPandas(go, f"region {kind}, contig string, rank int").unionByName(over)


def haplotype_variants(haps: DataFrame, references: DataFrame) -> DataFrame:
    """(region, hap, offset, ref, alt): primitive variants of haplotypes (region, hap) against the regions' references (region, reference), indels left-shifted."""

    def go(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = [(g, h, *v) for g, h, r in zip(pdf.region, pdf.hap, pdf.reference, strict=True) for v in primitive_variants(r, h)]
            yield pd.DataFrame(rows, columns=["region", "hap", "offset", "ref", "alt"])

    j = haps.join(references, "region").select("region", "hap", "reference")
    return j.mapInPandas(go, f"region {j.schema['region'].dataType.simpleString()}, hap string, offset int, ref string, alt string")


def primitive_variants(reference: str, hap: str) -> list[tuple[int, str, str]]:
    """(offset, reference's bases, haplotype's bases) of each difference in the best alignment."""
    _, ops = global_align(reference, hap, 1, -4, -5, -1)
    out, r, q = [], 0, 0
    for n, op in ops:
        if op == "M":
            out += [(r + i, reference[r + i], hap[q + i]) for i in range(n) if reference[r + i] != hap[q + i]]
        elif op == "I":
            at, _, ins = seq.left_shift(reference, r, 0, hap[q : q + n])
            out.append((at, "", ins))
        else:
            at, size, _ = seq.left_shift(reference, r, n, "")
            out.append((at, reference[at : at + size], ""))
        r, q = r + n * (op in "MD"), q + n * (op in "MI")
    return out


def phase(loci: DataFrame) -> DataFrame:
    """Loci (sample, region, pos, gt as ``a|b`` by haplotype) with ``phase_set`` and ``phased``: in a region with two or more heterozygous loci the first one's position, turned so that it reads 0|1."""
    w = Window.partitionBy("sample", "region")
    het = F.get(F.split("gt", r"\|"), 0) != F.get(F.split("gt", r"\|"), 1)
    n, first = F.count_if(het).over(w), F.min(F.when(het, F.struct("pos", "gt"))).over(w)
    turn = F.get(F.split(first["gt"], r"\|"), 0) > F.get(F.split(first["gt"], r"\|"), 1)
    flipped = F.concat_ws("|", F.get(F.split("gt", r"\|"), 1), F.get(F.split("gt", r"\|"), 0))
    on = (n >= 2) & het & F.col("region").isNotNull()
    return loci.withColumn("phase_set", F.when(on, first["pos"])).withColumn("phased", F.when(on, F.when(turn, flipped).otherwise(F.col("gt"))).otherwise(F.replace("gt", F.lit("|"), F.lit("/"))))


def homopolymers(bases: DataFrame) -> DataFrame:
    """(contig_id, begin, end, base, length): runs of equal bases of (contig_id, pos, base)."""
    g = bases.withColumn("_g", F.col("pos") - F.row_number().over(Window.partitionBy("contig_id", "base").orderBy("pos")))
    return g.groupBy("contig_id", "base", "_g").agg(F.min("pos").alias("begin"), F.max("pos").alias("end"), F.count("*").alias("length")).drop("_g")


def context_compressibility(text: str, keys: int) -> int:
    """How far from the start a greedy dictionary coder gets with ``keys`` phrases: the length of what they cover."""
    seen: set[str] = set()
    at = 0
    for _ in range(keys):
        end = at + 1
        while end <= len(text) and text[at:end] in seen:
            end += 1
        seen.add(text[at:end])
        at = min(len(text), end)
    return at
