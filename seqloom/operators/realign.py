"""Realignment of reads to candidate indels, and each read's likelihoods under them."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Indel = tuple[int, int, str]  # begin from 0, deleted length, inserted sequence
MAX_TOGGLES, MAX_CANDIDATES = 5, 5000


def conflict(a: Indel, b: Indel) -> bool:
    """Whether two indels cannot be on one haplotype: they overlap or touch."""
    return a[0] <= b[0] + b[1] and b[0] <= a[0] + a[1]


def haplotype(reference: str, indels: tuple[Indel, ...]) -> tuple[str, list[int]]:
    """The reference with these indels, and for each of its bases the reference's position (inserted bases: the next one's)."""
    out, at, pos = [], [], 0
    for begin, deleted, inserted in sorted(indels):
        out.append(reference[pos:begin] + inserted)
        at += [*range(pos, begin), *[begin] * len(inserted)]
        pos = begin + deleted
    return "".join(out) + reference[pos:], at + list(range(pos, len(reference)))


def score(read: str, quals: list[int], hap: str, start: int) -> float:
    """The log likelihood of a read at a place of a haplotype; what hangs over counts as background."""
    total = 0.0
    for i, (b, q) in enumerate(zip(read, quals, strict=True)):
        e = 10 ** (-max(2, q) / 10)
        j = start + i
        total += math.log(0.25) if not 0 <= j < len(hap) or b == "N" else math.log1p(-e) if hap[j] == b else math.log(e / 3)
    return total


def candidates(indels: list[Indel], most: int = MAX_TOGGLES) -> Iterator[tuple[Indel, ...]]:
    """Sets of indels that go together, small ones first, up to ``most`` in a set."""
    n = 0
    for k in range(min(most, len(indels)) + 1):
        for c in combinations(sorted(indels), k):
            if not any(conflict(a, b) for a, b in combinations(c, 2)):
                yield c
                n += 1
                if n >= MAX_CANDIDATES:
                    return


def realign(reference: str, read: str, quals: list[int], start: int, indels: list[Indel]) -> tuple[float, int, tuple[Indel, ...]]:
    """(log likelihood, start, indels) of the best placement: the read's first or last base stays where it was aligned, or near; fewer indels win ties."""
    near = [x for x in indels if start - 50 <= x[0] <= start + len(read) + 50]
    best = (-math.inf, start, ())
    for c in candidates(near):
        hap, at = haplotype(reference, c)
        shift = sum(len(s) - d for p, d, s in c if p <= start)
        tail = sum(len(s) - d for p, d, s in c)
        for s in {start + shift, start + tail, start}:
            v = score(read, quals, hap, s)
            if v > best[0] + 1e-9:
                best = (v, at[s] if 0 <= s < len(at) else s, c)
    return best


def read_scores(reference: str, read: str, quals: list[int], start: int, indels: list[Indel]) -> dict[Indel, tuple[float, float]]:
    """For each indel in reach the best log likelihoods without it and with it."""
    near = [x for x in indels if x[0] - len(read) < start <= x[0]]
    out = {}
    for x in near:
        without = max(_best(reference, read, quals, start, c) for c in candidates([y for y in near if y != x]))
        rest = [y for y in near if y != x and not conflict(x, y)]
        with_ = max(_best(reference, read, quals, start, (*c, x)) for c in candidates(rest))
        out[x] = (without, with_)
    return out


def _best(reference: str, read: str, quals: list[int], start: int, c: tuple[Indel, ...]) -> float:
    hap, _ = haplotype(reference, c)
    return max(score(read, quals, hap, s) for s in {start, start + sum(len(s) - d for _, d, s in c)})


def score_reads(alignments: DataFrame, indels: dict[int, list[Indel]], reference: dict[int, str]) -> DataFrame:
    """(read_id, contig_id, pos, del_len, ins_seq, lnp_ref, lnp_indel) for alignments (read_id, contig_id, pos from 1, seq, quals).

    The candidates and the reference of a run are broadcast: one region's at a time, within fifty million bases (checked).
    """
    if sum(map(len, reference.values())) > 50_000_000 or sum(map(len, indels.values())) > 1_000_000:
        raise ValueError("too large to broadcast: run region by region")
    sent = alignments.sparkSession.sparkContext.broadcast((indels, reference))

    def go(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        indels_, reference_ = sent.value
        for pdf in it:
            rows = [
                (i, c, x[0] + 1, x[1], x[2], a, b)
                for i, c, p, s, q in zip(pdf.read_id, pdf.contig_id, pdf.pos, pdf.seq, pdf.quals, strict=True)
                for x, (a, b) in read_scores(reference_[c], s, list(q), p - 1, indels_.get(c, [])).items()
            ]
            yield pd.DataFrame(rows, columns=["read_id", "contig_id", "pos", "del_len", "ins_seq", "lnp_ref", "lnp_indel"])

    return alignments.select("read_id", "contig_id", "pos", "seq", "quals").mapInPandas(go, "read_id long, contig_id int, pos int, del_len int, ins_seq string, lnp_ref double, lnp_indel double")


def support_summary(scores: DataFrame, confident: float = 0.51) -> DataFrame:
    """(contig_id, pos, del_len, ins_seq, ref, indel, unsure): reads by the posterior of either side, with equal priors."""
    m = F.greatest("lnp_ref", "lnp_indel")
    a, b = F.exp(F.col("lnp_ref") - m), F.exp(F.col("lnp_indel") - m)
    p = b / (a + b)
    return scores.groupBy("contig_id", "pos", "del_len", "ins_seq").agg(F.count_if(1 - p >= confident).alias("ref"), F.count_if(p >= confident).alias("indel"), F.count_if((p < confident) & (1 - p < confident)).alias("unsure"))
