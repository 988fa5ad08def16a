"""Sequences, CIGARs, variant keys and text of variant files: Column expressions, and plain functions for Arrow UDFs."""

from __future__ import annotations

import re
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

# The orders of bases that file formats and models use.
PILEUP_ORDER, CALL_ORDER, NIBBLES = "ACTG", "ACGT", "=ACMGRSVTWYHKDBN"
CIGAR_TYPE = "array<struct<op:string,len:int>>"


def revcomp(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTUacgtu", "TGCAAtgcaa"))


def mask_ambiguous(seq: Column) -> Column:
    """Upper case, with the ambiguity codes as N."""
    return F.translate(F.upper(seq), "RYKMSWBDHV", "NNNNNNNNNN")


def base_id(base: Column, order: str = CALL_ORDER) -> Column:
    """A base's place in ``order``, from 0; others get its length."""
    at = F.instr(F.lit(order), F.upper(base))
    return F.when((at > 0) & (F.length(base) == 1), at - 1).otherwise(len(order))


def unpack_nibbles(packed: Column, length: Column) -> Column:
    """Two bases a byte, the first in the high half."""
    hexed = F.lower(F.hex(packed))
    return F.substr(F.translate(hexed, "0123456789abcdef", NIBBLES), F.lit(1), length)


def pack_nibbles(seq: Column) -> Column:
    hexed = F.translate(F.upper(seq), NIBBLES, "0123456789abcdef")
    return F.unhex(F.concat(hexed, F.when(F.length(hexed) % 2 == 1, "0").otherwise("")))


def phred33(qual: Column) -> Column:
    """A quality string as an array of numbers."""
    return F.transform(F.split(qual, ""), lambda c: (F.ascii(c) - 33).cast("tinyint"))


def read_pair_name(name: Column) -> Column:
    """Without the mate's number."""
    return F.regexp_replace(name, "/[0-9]$", "")


def safe_id(s: Column) -> Column:
    return F.regexp_replace(s, "[^A-Za-z0-9_-]", "_")


def rtrim_n(seq: Column, reverse: Column) -> Column:
    """How many bases are left, and how many were cut, of the N at the end at which sequencing ended."""
    return F.when(reverse, F.length(F.regexp_replace(seq, "^N+", ""))).otherwise(F.length(F.regexp_replace(seq, "N+$", "")))


# CIGAR


def parse_cigar(cigar: Column) -> Column:
    parts = F.regexp_extract_all(cigar, F.lit("([0-9]+[MIDNSHPX=])"), 1)
    return F.transform(parts, lambda p: F.struct(F.right(p, F.lit(1)).alias("op"), F.regexp_extract(p, "^([0-9]+)", 1).cast("int").alias("len")))


def format_cigar(cigar: Column) -> Column:
    return F.array_join(F.transform(cigar, lambda x: F.concat(x["len"].cast("string"), x["op"])), "")


def _length(cigar: Column, ops: str) -> Column:
    return F.aggregate(cigar, F.lit(0), lambda a, x: a + F.when(x["op"].isin(*ops), x["len"]).otherwise(0))


def read_length(cigar: Column) -> Column:
    return _length(cigar, "MIS=X")


def ref_length(cigar: Column) -> Column:
    return _length(cigar, "MDN=X")


def matched_length(cigar: Column) -> Column:
    return _length(cigar, "M=X")


def spliced_length(cigar: Column) -> Column:
    return _length(cigar, "N")


def indel_count(cigar: Column) -> Column:
    return F.size(F.filter(cigar, lambda x: x["op"].isin("I", "D")))


def exon_count(cigar: Column) -> Column:
    return F.size(F.filter(cigar, lambda x: x["op"] == "N")) + 1


def clip_lengths(cigar: Column) -> tuple[Column, Column]:
    """Soft-clipped bases at the start and the end; hard clips outside them don't matter."""
    inner = F.filter(cigar, lambda x: x["op"] != "H")
    end = lambda x: F.when(x["op"] == "S", x["len"]).otherwise(0)
    return F.coalesce(end(F.get(inner, 0)), F.lit(0)), F.coalesce(F.when(F.size(inner) > 1, end(F.try_element_at(inner, F.lit(-1)))), F.lit(0))


def is_ungapped(cigar: Column) -> Column:
    """One M over the whole read."""
    return (F.size(cigar) == 1) & (cigar[0]["op"] == "M")


def has_match(cigar: Column) -> Column:
    return F.exists(cigar, lambda x: x["op"].isin("M", "=", "X"))


def cigar_problem(cigar: Column, seq_length: Column) -> Column:
    """What is wrong with an alignment path, or null."""
    inner = F.filter(cigar, lambda x: x["op"] != "H")
    clipped = F.filter(F.slice(inner, 2, F.greatest(F.size(inner) - 2, F.lit(0))), lambda x: x["op"] == "S")
    return (
        F.when(F.size(cigar) == 0, "empty")
        .when(F.exists(cigar, lambda x: x["len"] <= 0), "zero_length")
        .when(F.size(clipped) > 0, "clip_inside")
        .when(~has_match(cigar), "floating")
        .when(read_length(cigar) != seq_length, "length")
    )


def op_offsets(cigar: Column) -> Column:
    """array of (op, len, q, r): each operation with the read's and the reference's offsets at its start, from 0."""
    start = F.struct(F.lit(0).alias("q"), F.lit(0).alias("r"), F.expr("cast(array() as array<struct<op:string,len:int,q:int,r:int>>)").alias("out"))
    return F.aggregate(
        cigar,
        start,
        lambda a, x: F.struct(
            (a["q"] + F.when(x["op"].isin(*"MIS=X"), x["len"]).otherwise(0)).alias("q"),
            (a["r"] + F.when(x["op"].isin(*"MDN=X"), x["len"]).otherwise(0)).alias("r"),
            F.concat(a["out"], F.array(F.struct(x["op"].alias("op"), x["len"].alias("len"), a["q"].alias("q"), a["r"].alias("r")))).alias("out"),
        ),
        lambda a: a["out"],
    )


# Variant files


def info_value(info: Column, key: str) -> Column:
    """The value of a key of an INFO text; a flag gives an empty text, a key that isn't there null."""
    return F.try_element_at(F.str_to_map(F.regexp_replace(info, "(^|;)([^=;]+)(?=;|$)", "$1$2="), F.lit(";"), F.lit("=")), F.lit(key))


def format_value(fmt: Column, sample: Column, key: str) -> Column:
    """A sample's value of a FORMAT key."""
    return F.when(F.array_position(F.split(fmt, ":"), key) > 0, F.try_element_at(F.split(sample, ":"), F.array_position(F.split(fmt, ":"), key).cast("int")))


def genotype_index(i: Column, j: Column) -> Column:
    """The place of genotype i/j in the order of likelihoods."""
    lo, hi = F.least(i, j), F.greatest(i, j)
    return (hi * (hi + 1) / 2).cast("int") + lo


def parse_genotype(gt: Column) -> Column:
    """Allele numbers; a missing one is null."""
    return F.transform(F.split(gt, "[/|]"), lambda x: x.try_cast("int"))


def variant_class(ref: Column, alt: Column) -> Column:
    """``snv``, ``indel``, ``ref`` or ``other`` (symbolic, breakends, or sequences of equal length beyond one base)."""
    plain = ~alt.rlike(r"[<>\[\]:*]")
    return F.when((alt == ".") | (alt == ref), "ref").when(~plain, "other").when((F.length(ref) == 1) & (F.length(alt) == 1), "snv").when(F.length(ref) != F.length(alt), "indel").otherwise("other")


def parse_region(region: Column) -> Column:
    """``chr:begin-end`` or ``chr:begin`` or ``chr`` as (chrom, begin, end); commas in numbers are allowed."""
    number = lambda g: F.regexp_replace(F.regexp_extract(region, r"^(.+?)(?::([0-9,]+)(?:-([0-9,]+))?)?$", g), ",", "").try_cast("long")
    return F.struct(F.regexp_extract(region, r"^(.+?)(?::([0-9,]+)(?:-([0-9,]+))?)?$", 1).alias("chrom"), number(2).alias("begin"), number(3).alias("end"))


# Plain functions


def common_affixes(a: str, b: str, suffix_first: bool = True) -> tuple[int, int]:
    """Lengths of the common beginning and end; they don't overlap, and the end has priority if asked for."""

    def run(x: str, y: str, most: int) -> int:
        n = 0
        while n < most and x[n] == y[n]:
            n += 1
        return n

    most = min(len(a), len(b))
    if suffix_first:
        s = run(a[::-1], b[::-1], most)
        return run(a, b, most - s), s
    p = run(a, b, most)
    return p, run(a[::-1], b[::-1], most - p)


def simple_indel(pos: int, ref: str, alt: str) -> tuple[int, int, str]:
    """(position of the first base after the common beginning, deleted length, inserted sequence) of a variant at ``pos``."""
    p, s = common_affixes(ref, alt)
    return pos + p, len(ref) - p - s, alt[p : len(alt) - s]


def left_shift(reference: str, begin: int, deleted: int, inserted: str) -> tuple[int, int, str]:
    """The same indel as far left as it goes; ``begin`` counts from 0 in ``reference``."""
    while begin > 0:
        before = reference[begin - 1]
        if deleted and not inserted and before == reference[begin + deleted - 1]:
            begin -= 1
        elif inserted and not deleted and before == inserted[-1]:
            begin, inserted = begin - 1, before + inserted[:-1]
        else:
            break
    return begin, deleted, inserted


def collapse_cigar(ops: list[tuple[int, str]], reference: str, read: str, pos: int = 0) -> list[tuple[int, str]]:
    """Neighbouring insertions and deletions as one of each; what they have in common becomes a match, and equal neighbours merge."""
    out: list[tuple[int, str]] = []
    r, q = pos, 0
    i = 0
    while i < len(ops):
        n, op = ops[i]
        if op in "ID":
            ins = dele = 0
            while i < len(ops) and ops[i][1] in "ID":
                ins += ops[i][0] * (ops[i][1] == "I")
                dele += ops[i][0] * (ops[i][1] == "D")
                i += 1
            a, b = reference[r : r + dele], read[q : q + ins]
            p, s = common_affixes(a, b, False) if ins and dele else (0, 0)
            out += [x for x in ((p, "M"), (ins - p - s, "I"), (dele - p - s, "D"), (s, "M")) if x[0]]
            r, q = r + dele, q + ins
            continue
        out.append((n, op))
        r += n * (op in "MDN=X")
        q += n * (op in "MIS=X")
        i += 1
    return [(sum(n for n, _ in g), op) for op, g in ((op, list(g)) for op, g in groupby(out, key=lambda x: x[1]))]


def repeat_unit(seq: str) -> tuple[str, int]:
    """The shortest unit that ``seq`` repeats, and how often."""
    for n in range(1, len(seq) + 1):
        if len(seq) % n == 0 and seq[:n] * (len(seq) // n) == seq:
            return seq[:n], len(seq) // n
    return seq, 1


def repeat_count(reference: str, at: int, unit: str) -> int:
    """How often ``unit`` stands in a row in ``reference`` around ``at``."""
    n, k, u = 0, at, len(unit)
    while u and reference[k : k + u] == unit:
        n, k = n + 1, k + u
    k = at - u
    while u and k >= 0 and reference[k : k + u] == unit:
        n, k = n + 1, k - u
    return n


def compress_homopolymers(seq: str) -> str:
    return "".join(k for k, _ in groupby(seq))


def homopolymer_lengths(seq: str) -> list[int]:
    """For each base, the length of the run of equal bases it is in."""
    return [n for n in (len(list(g)) for _, g in groupby(seq)) for _ in range(n)]


def difference_string(reference: str, read: str, ops: list[tuple[int, str]]) -> str:
    """An alignment as ``:n`` equal bases, ``*ra`` a substitution, ``+ins`` and ``-del``."""
    out, r, q = [], 0, 0
    for n, op in ops:
        if op in "M=X":
            run = 0
            for a, b in zip(reference[r : r + n].lower(), read[q : q + n].lower(), strict=True):
                if a == b:
                    run += 1
                else:
                    out += [f":{run}"] * (run > 0) + [f"*{a}{b}"]
                    run = 0
            out += [f":{run}"] * (run > 0)
        elif op == "I":
            out.append("+" + read[q : q + n].lower())
        elif op == "D":
            out.append("-" + reference[r : r + n].lower())
        r += n * (op in "MDN=X")
        q += n * (op in "MIS=X")
    return "".join(out)


def match_descriptor(reference: str, read: str, ops: list[tuple[int, str]]) -> str:
    """Numbers of equal bases, mismatched reference bases and ``^`` deleted ones, as the MD tag has them."""
    out, run, r, q = [], 0, 0, 0
    for n, op in ops:
        if op in "M=X":
            for a, b in zip(reference[r : r + n], read[q : q + n], strict=True):
                if a == b:
                    run += 1
                else:
                    out.append(f"{run}{a}")
                    run = 0
        elif op == "D":
            out.append(f"{run}^{reference[r : r + n]}")
            run = 0
        r += n * (op in "MDN=X")
        q += n * (op in "MIS=X")
    return "".join(out) + str(run)


def parse_ops(cigar: str) -> list[tuple[int, str]]:
    return [(int(n), op) for n, op in re.findall("([0-9]+)([MIDNSHPX=])", cigar)]


def low_complexity(seq: str, threshold: int = 20, window: int = 64) -> list[tuple[int, int]]:
    """Intervals in which some stretch of at most ``window`` bases repeats its triplets: ten times the number of pairs of
    equal triplets exceeds ``threshold`` times the number of triplets less one. Overlapping ones are merged. Letters other
    than A, C, G and T end a stretch; what is on their other side starts anew."""
    runs = re.finditer("[ACGT]+", seq.upper())
    return [(m.start() + a, m.start() + b) for m in runs for a, b in _repetitive(m[0], threshold, window)]


def _repetitive(seq: str, threshold: int, window: int) -> list[tuple[int, int]]:
    found: list[list[int]] = []
    for end in range(3, len(seq) + 1):
        seen: dict[str, int] = {}
        pairs = 0
        best = None
        for start in range(end - 3, max(-1, end - window - 1), -1):
            t = seq[start : start + 3]
            pairs += seen.get(t, 0)
            seen[t] = seen.get(t, 0) + 1
            n = end - start - 2
            if n > 1 and 10 * pairs > threshold * (n - 1):
                best = start
        if best is not None:
            while found and found[-1][1] >= best:
                best = min(best, found.pop()[0])
            found.append([best, end])
    return [(a, b) for a, b in found]
