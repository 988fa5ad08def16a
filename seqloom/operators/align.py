"""Aligning short reads: chaining of seeds, banded affine extension, hit selection and pairing, in Arrow batches by read."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sketch import minimizers

_COMPLEMENT = str.maketrans("ACGTacgt", "TGCAtgca")


@dataclass(frozen=True)
class Params:
    """A mapping preset; the default is for short reads."""

    k: int = 21
    w: int = 11
    match: int = 2
    mismatch: int = 8
    gap_open: int = 12
    gap_extend: int = 2
    zdrop: int = 100
    end_bonus: int = 10
    max_gap: int = 100
    bandwidth: int = 100
    max_fragment: int = 800
    min_count: int = 2
    min_chain_score: int = 25
    min_dp: int = 40
    best_n: int = 20
    pri_ratio: float = 0.5
    mid_occ: int = 1000
    max_occ: int = 5000


# Presets by name, where they differ from the defaults.
PRESETS = {
    "sr": Params(),
    "map-ont": Params(k=15, w=10, mismatch=4, gap_open=4, max_gap=5000, bandwidth=500, min_count=3, min_chain_score=40, min_dp=80, best_n=5, pri_ratio=0.8, zdrop=400, end_bonus=0),
    "map-pb": Params(k=19, w=10, mismatch=4, gap_open=4, max_gap=5000, bandwidth=500, min_count=3, min_chain_score=40, min_dp=80, best_n=5, pri_ratio=0.8, zdrop=400, end_bonus=0),
    "asm5": Params(k=19, w=19, match=1, mismatch=19, gap_open=39, gap_extend=3, max_gap=5000, bandwidth=500, min_count=3, min_chain_score=40, min_dp=200, best_n=50, pri_ratio=0.8, zdrop=200, end_bonus=0),
}


def chain(ref: np.ndarray, query: np.ndarray, span: int, p: Params) -> list[tuple[float, list[int]]]:
    """Collinear chains of anchors (ends in reference and query, sorted by reference): (score, anchors), best first.

    An anchor adds the bases it doesn't share with the one before, less a cost of the gap's length and its logarithm;
    only anchors within ``max_gap`` and ``bandwidth`` follow one another. Each anchor is in one chain.
    """
    n = len(ref)
    score, back = np.full(n, float(span)), np.full(n, -1)
    first = 0
    for i in range(n):
        while ref[i] - ref[first] > p.max_gap:
            first += 1
        if first < i:
            dr, dq = ref[i] - ref[first:i], query[i] - query[first:i]
            gap = np.abs(dr - dq)
            ok = (dr > 0) & (dq > 0) & (dq <= p.max_gap) & (gap <= p.bandwidth)
            if ok.any():
                cost = np.where(gap > 0, 0.01 * span * gap + 0.5 * np.log2(np.maximum(gap, 1)), 0.0)
                s = np.where(ok, score[first:i] + np.minimum(np.minimum(dr, dq), span) - cost, -np.inf)
                j = len(s) - 1 - int(np.argmax(s[::-1]))
                if s[j] > score[i]:
                    score[i], back[i] = s[j], first + j
    out, used = [], np.zeros(n, bool)
    for i in np.lexsort((np.arange(n), -score)):
        path, j = [], i
        while j >= 0 and not used[j]:
            path.append(int(j))
            used[j] = True
            j = back[j]
        gained = score[i] - (score[j] if j >= 0 else 0)
        if len(path) >= p.min_count and gained >= p.min_chain_score:
            out.append((float(gained), path[::-1]))
    return sorted(out, key=lambda c: (-c[0], c[1]))


def global_align(a: str, b: str, match: int = 1, mismatch: int = -4, gap_open: int = -5, gap_extend: int = -1, free_ends: bool = False) -> tuple[int, list[tuple[int, str]]]:
    """(score, operations) of the best affine alignment of all of ``b`` (read) to ``a`` (reference).

    ``free_ends`` lets the reference hang over at both ends at no cost. Insertions consume ``b``, deletions ``a``.
    """
    n, m = len(a), len(b)
    low = -(10**9)
    x, y = np.frombuffer(a.encode(), np.uint8), np.frombuffer(b.encode(), np.uint8)
    h, e, f = (np.full((m + 1, n + 1), low) for _ in range(3))
    h[0, 0] = 0
    if free_ends:
        h[0] = 0
    else:
        e[0, 1:] = gap_open + gap_extend * np.arange(1, n + 1)
    for i in range(1, m + 1):
        best_up = np.maximum(np.maximum(h[i - 1], e[i - 1]) + gap_open, f[i - 1]) + gap_extend
        f[i] = best_up
        s = np.where(x == y[i - 1], match, mismatch)
        h[i, 1:] = np.maximum(np.maximum(h[i - 1, :-1], e[i - 1, :-1]), f[i - 1, :-1]) + s
        # a running maximum gives the deletions of a row at once
        start = np.maximum(h[i], f[i]) + gap_open - gap_extend * np.arange(n + 1)
        e[i, 1:] = np.maximum.accumulate(start)[:-1] + gap_extend * np.arange(1, n + 1)
    last = np.maximum(np.maximum(h[m], e[m]), f[m])
    j = int(np.argmax(last)) if free_ends else n
    i, ops, total = m, [], int(last[j])
    state = int(np.argmax([h[i, j], e[i, j], f[i, j]]))
    while i > 0 or (j > 0 and not free_ends):
        if state == 0:
            if i == 0 and j == 0:
                break
            ops.append("M")
            i, j = i - 1, j - 1
            state = int(np.argmax([h[i, j], e[i, j], f[i, j]]))
        elif state == 1:
            ops.append("D")
            here = e[i, j]
            j -= 1
            state = 1 if e[i, j] + gap_extend == here else (0 if h[i, j] + gap_open + gap_extend == here else 2)
        else:
            ops.append("I")
            here = f[i, j]
            i -= 1
            state = 2 if f[i, j] + gap_extend == here else (0 if h[i, j] + gap_open + gap_extend == here else 1)
    runs: list[tuple[int, str]] = []
    for op in reversed(ops):
        runs = [*runs[:-1], (runs[-1][0] + 1, op)] if runs and runs[-1][1] == op else [*runs, (1, op)]
    return total, runs


def extend(reference: str, read: str, at: int, p: Params) -> tuple[int, int, list[tuple[int, str]]]:
    """(score, start, operations) of a read placed near ``at``: within a band, ends clipped where they cost more than they bring."""
    pad = min(p.bandwidth, 20)
    lo, hi = max(0, at - pad), min(len(reference), at + len(read) + pad)
    window = reference[lo:hi]
    score, ops = global_align(window, read, p.match, -p.mismatch, -p.gap_open, -p.gap_extend, True)
    used = sum(n for n, op in ops if op in "MD")
    end = _end_of(window, read, ops, score, p)
    start = lo + end - used
    return _clip(reference, read, start, ops, p)


def _end_of(window: str, read: str, ops: list[tuple[int, str]], score: int, p: Params) -> int:
    """Where in the window the alignment ends: the place whose score is the alignment's."""
    used = sum(n for n, op in ops if op in "MD")
    for end in range(used, len(window) + 1):
        r, q, total = end - used, 0, 0
        for n, op in ops:
            if op == "M":
                total += sum(p.match if window[r + i] == read[q + i] else -p.mismatch for i in range(n))
                r, q = r + n, q + n
            elif op == "D":
                total -= p.gap_open + n * p.gap_extend
                r += n
            else:
                total -= p.gap_open + n * p.gap_extend
                q += n
        if total == score:
            return end
    return used


def _clip(reference: str, read: str, start: int, ops: list[tuple[int, str]], p: Params) -> tuple[int, int, list[tuple[int, str]]]:
    """The stretch of highest score, the rest soft-clipped; reaching an end of the read is worth ``end_bonus``."""
    steps, r, q = [], start, 0
    for n, op in ops:
        if op == "M":
            for _ in range(n):
                steps.append((p.match if reference[r] == read[q] else -p.mismatch, 1, 1, "M"))
                r, q = r + 1, q + 1
        else:
            steps += [(-(p.gap_open if i == 0 else 0) - p.gap_extend, int(op == "D"), int(op == "I"), op) for i in range(n)]
            r, q = r + n * (op == "D"), q + n * (op == "I")
    gain = np.concatenate([[0], np.cumsum([s[0] for s in steps])])
    best, cut = -math.inf, (0, len(steps))
    low, low_at = gain[0] - p.end_bonus, 0
    for j in range(1, len(gain)):
        value = gain[j] - low + (p.end_bonus if j == len(steps) else 0)
        if value > best:
            best, cut = value, (low_at, j)
        if gain[j] < low:
            low, low_at = gain[j], j
    a, b = cut
    out: list[tuple[int, str]] = []
    lead, tail = sum(s[2] for s in steps[:a]), sum(s[2] for s in steps[b:])
    for op in ["S"] * lead + [s[3] for s in steps[a:b]] + ["S"] * tail:
        out = [*out[:-1], (out[-1][0] + 1, op)] if out and out[-1][1] == op else [*out, (1, op)]
    return int(gain[b] - gain[a]), start + sum(s[1] for s in steps[:a]), out


def select_hits(hits: list[dict], p: Params) -> list[dict]:
    """Hits by score with their parents: one whose query range is mostly another's is secondary, kept if its score is near enough; mapping quality for the rest."""
    hits = sorted(hits, key=lambda h: (-h["score"], h["contig_id"], h["pos"], h["reverse"]))
    primary: list[dict] = []
    for h in hits:
        parent = next((x for x in primary if min(h["qe"], x["qe"]) - max(h["qs"], x["qs"]) > 0.5 * min(h["qe"] - h["qs"], x["qe"] - x["qs"])), None)
        h["primary"] = parent is None
        if parent is None:
            h.update(second=0, rivals=0)
            primary.append(h)
        else:
            parent["second"] = max(parent["second"], h["score"])
            parent["rivals"] += 1
            h.update(parent=parent, second=0, rivals=0)
    kept = [h for h in hits if h["primary"]] + [h for h in hits if not h["primary"] and h["score"] >= p.pri_ratio * h["parent"]["score"]][: p.best_n]
    for h in kept:
        x = h["second"] / h["score"] if h["score"] > 0 else 1.0
        raw = 40 * h["identity"] * (1 - x * x) * math.log(max(1.0, h["score"] / p.match)) - 4.343 * math.log(h["rivals"] + 1) if h["primary"] else 0
        h["mapq"] = int(min(60, max(0, raw + 0.499)))
    return kept


def map_reads(reads: DataFrame, contigs: dict[int, str], preset: str = "sr", most_bases: int = 50_000_000) -> DataFrame:
    """(read_id, contig_id, pos, reverse, score, mapq, primary, cigar) for reads (read_id, seq).

    The reference's bases and minimizers are broadcast, within ``most_bases``; beyond that, seeds are to be joined as a
    table (``sketch`` and ``seed_join``). Reads are mapped in batches, each by itself.
    """
    if sum(map(len, contigs.values())) > most_bases:
        raise ValueError("the reference is too large to broadcast: join its sketch instead")
    p = PRESETS[preset]
    index: dict[int, list[tuple[int, int, int]]] = {}
    for c, s in contigs.items():
        for h, end, strand in minimizers(s, p.k, p.w):
            index.setdefault(h, []).append((c, end, strand))
    sent = reads.sparkSession.sparkContext.broadcast((contigs, index))
    schema = "read_id long, contig_id int, pos int, reverse boolean, score int, mapq int, primary boolean, cigar string"

    def go(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        contigs, index = sent.value
        for pdf in it:
            out = [(i, h["contig_id"], h["pos"] + 1, h["reverse"], h["score"], h["mapq"], h["primary"], h["cigar"]) for i, s in zip(pdf.read_id, pdf.seq, strict=True) for h in map_one(s or "", contigs, index, p)]
            yield pd.DataFrame(out, columns=["read_id", "contig_id", "pos", "reverse", "score", "mapq", "primary", "cigar"]).astype({"read_id": "int64"}) if out else pd.DataFrame({c.split()[0]: pd.Series(dtype=t) for c, t in zip(schema.split(", "), ("int64", "int32", "int32", "bool", "int32", "int32", "bool", "str"), strict=True)})

    return reads.select("read_id", "seq").mapInPandas(go, schema)


def map_one(seq: str, contigs: dict[int, str], index: dict, p: Params) -> list[dict]:
    """A read's hits. Seeds that occur too often are tried only if the others give no chain."""
    mine = minimizers(seq, p.k, p.w)
    for cap in (p.mid_occ, p.max_occ):
        anchors: dict[tuple[int, bool], list[tuple[int, int]]] = {}
        for h, end, strand in mine:
            found = index.get(h, ())
            if len(found) <= cap:
                for c, ref_end, ref_strand in found:
                    rev = strand != ref_strand
                    anchors.setdefault((c, rev), []).append((ref_end, len(seq) - 1 - (end - p.k + 1) if rev else end))
        hits = []
        for (c, rev), pts in anchors.items():
            pts.sort()
            r, q = np.array([x for x, _ in pts]), np.array([x for _, x in pts])
            read = seq.translate(_COMPLEMENT)[::-1] if rev else seq
            seen = set()
            for _, path in chain(r, q, p.k, p):
                at = int(r[path[0]] - q[path[0]])
                if at in seen:
                    continue
                seen.add(at)
                score, start, ops = extend(contigs[c], read, at, p)
                if score >= p.min_dp:
                    qs = ops[0][0] if ops[0][1] == "S" else 0
                    qe = len(read) - (ops[-1][0] if ops[-1][1] == "S" else 0)
                    bases = sum(n for n, op in ops if op == "M")
                    hits.append({"contig_id": c, "pos": start, "reverse": rev, "score": score, "qs": len(read) - qe if rev else qs, "qe": len(read) - qs if rev else qe, "identity": min(1.0, max(0.0, (score / p.match) / max(1, bases))), "cigar": "".join(f"{n}{op}" for n, op in ops)})
        if hits:
            return select_hits(hits, p)
    return []


def pair_hits(hits: DataFrame, p: Params = PRESETS["sr"]) -> DataFrame:
    """Primary hits (pair_id, mate, contig_id, pos, reverse, score, mapq, length) of both mates, opposite strands and near enough: the best such pair of each, its insert size and adjusted mapping qualities."""
    from pyspark.sql import Window

    a, b = (hits.where(F.col("mate") == m).select("pair_id", *(F.col(c).alias(f"{c}{m}") for c in ("contig_id", "pos", "reverse", "score", "mapq", "length"))) for m in (1, 2))
    near = (F.col("contig_id1") == F.col("contig_id2")) & (F.col("reverse1") != F.col("reverse2"))
    begin, end = F.least("pos1", "pos2"), F.greatest(F.col("pos1") + F.col("length1"), F.col("pos2") + F.col("length2"))
    # hits of a pair only, so within the bound of hits kept for each read
    j = a.join(b, "pair_id").where(near & (end - begin <= p.max_fragment)).withColumn("insert_size", end - begin)
    w = Window.partitionBy("pair_id").orderBy((F.col("score1") + F.col("score2")).desc(), "insert_size", "pos1", "pos2")
    best = j.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    pair_q = F.floor((F.col("mapq1") + F.col("mapq2")) / 2).cast("int")
    from ..functions.numeric import paired_mapping_quality

    return best.withColumns({"mapq1": paired_mapping_quality(F.col("mapq1"), pair_q), "mapq2": paired_mapping_quality(F.col("mapq2"), pair_q)})


def sam_flags(mate, paired, proper, unmapped, mate_unmapped, reverse, mate_reverse, secondary, supplementary):
    """A SAM flag from its parts, all Columns."""
    bit = lambda c, b: F.when(c, b).otherwise(0)
    return bit(paired, 0x1) + bit(proper, 0x2) + bit(unmapped, 0x4) + bit(mate_unmapped, 0x8) + bit(reverse, 0x10) + bit(mate_reverse, 0x20) + bit(paired & (mate == 1), 0x40) + bit(paired & (mate == 2), 0x80) + bit(secondary, 0x100) + bit(supplementary, 0x800)


def divergence(matches: int, total: int, mean_k: float) -> float:
    """Sequence divergence from how many seeds of all match."""
    return math.log(total / matches) / mean_k if matches else 1.0
