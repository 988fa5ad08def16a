import math
import random

import pytest
from pyspark.sql import functions as F

from seqloom.functions import numeric, seq, stats
from seqloom.functions import sql as sqlfuncs


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()[0]


@pytest.mark.parametrize(("alpha", "n", "p", "k", "no"), [(1e-9, 10000, 1e-4, 12, 11), (1e-3, 100000, 1e-4, 50, 11)])
def test_one_sided_binomial(alpha, n, p, k, no):
    assert stats.binom_gte_reject(alpha, n, k, p) and not stats.binom_gte_reject(alpha, n, no, p)
    least = stats.min_count(alpha, n, p)
    assert stats.binom_gte_reject(alpha, n, least, p) and not stats.binom_gte_reject(alpha, n, least - 1, p)


def test_binomial_tail_against_sums():
    for n, k, p in ((10, 3, 0.2), (50, 20, 0.5), (7, 7, 0.9)):
        assert math.isclose(stats.binom_upper(n, k, p), sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k, n + 1)), rel_tol=1e-10)


@pytest.mark.parametrize(("n", "k", "q"), [(100, 0, 0), (100, 1, 2), (100, 5, 24), (200, 10, 43), (500, 25, 98), (5000, 250, 100)])
def test_continuous_quality(n, k, q):
    assert stats.continuous_quality(n, k) == q


@pytest.mark.parametrize(("x", "want"), [((4769, 4058, 2, 4), -100), ((0, 62, 190, 8), 116.9888344), ((379, 0, 4940, 5601), 251.724361), ((379, 400, 4940, 5601), -100)])
def test_continuous_strand_bias(x, want):
    assert math.isclose(stats.continuous_strand_bias(*x), want, rel_tol=1e-6)


def test_fisher():
    assert math.isclose(stats.fisher(3, 1, 1, 3), 0.4857142857, rel_tol=1e-9)
    assert math.isclose(stats.fisher(3, 1, 1, 3, "greater"), 0.2428571429, rel_tol=1e-9)


def test_gamma_against_poisson():
    for k, lam in ((1, 0.5), (5, 3.0), (20, 30.0)):
        assert math.isclose(stats.gamma_p(k, lam), 1 - sum(math.exp(-lam) * lam**i / math.factorial(i) for i in range(k)), rel_tol=1e-9)


def test_log_compress(spark):
    assert one(spark, numeric.log_compress(F.lit(67).cast("long"), 3)) == 72
    assert [r.x for r in spark.range(8).select(numeric.log_compress(F.col("id"), 3).alias("x")).collect()] == list(range(8))


def test_numeric(spark):
    assert one(spark, numeric.phred_int(F.lit(0.001))) == 30
    assert math.isclose(one(spark, numeric.log_sum(F.lit(-1.0), F.lit(-2.0))), math.log(math.exp(-1) + math.exp(-2)))
    assert one(spark, numeric.median_upper(F.array(F.lit(4), F.lit(1), F.lit(3), F.lit(2)))) == 3
    assert one(spark, numeric.safe_frac(F.lit(1), F.lit(0))) == 0
    assert one(spark, numeric.argmax(F.array(F.lit(1.0), F.lit(3.0), F.lit(3.0)))) == 1
    assert one(spark, numeric.parse_suffixed(F.lit("2.5k"))) == 2500
    assert one(spark, numeric.parse_suffixed(F.lit("x"))) is None
    assert math.isclose(one(spark, numeric.homopolymer_indel_error(F.lit(16))), 3e-4)
    for table in (numeric.genotype_priors(), numeric.polymorphic_priors()):
        assert all(math.isclose(sum(p.values()), 1, abs_tol=1e-3) for p in table.values())


def test_best_alt_ties(spark):
    counts = [(a, c, t, g) for a in range(3) for c in range(3) for t in range(3) for g in range(3)]

    def want(ref, n):
        x = dict(zip("ACTG", n, strict=True))
        first, second, third = {"A": "CGT", "C": "AGT", "T": "ACG", "G": "ACT"}[ref]
        lead = first if x[first] > x[second] else second
        return third if x[third] > x[lead] else lead

    rows = [(r, *n) for r in "ACGT" for n in counts]
    df = spark.createDataFrame(rows, "r string, a long, c long, t long, g long")
    got = df.withColumn("x", numeric.best_alt(*(F.col(k) for k in "ractg"[:1] + "actg"))).collect()
    assert all(r.x == want(r.r, (r.a, r.c, r.t, r.g)) for r in got)


def test_hash_is_invertible_and_agrees_with_arrays(spark):
    import numpy as np

    from seqloom.operators.sketch import _hash

    got = [r.x for r in spark.range(1000).select(numeric.hash64(F.col("id") * 7919, 42).alias("x")).collect()]
    assert len(set(got)) == 1000
    assert got == _hash(np.arange(1000, dtype=np.uint64) * np.uint64(7919), 42).tolist()


def test_sequences(spark):
    assert one(spark, seq.revcomp(F.lit("ACGTN"))) == "NACGT"
    assert one(spark, seq.mask_ambiguous(F.lit("acRyN"))) == "ACNNN"
    assert one(spark, seq.unpack_nibbles(seq.pack_nibbles(F.lit("ACGTN")), F.lit(5))) == "ACGTN"
    assert one(spark, seq.rtrim_n(F.lit("NACNN"), F.lit(False))) == 3 and one(spark, seq.rtrim_n(F.lit("NACNN"), F.lit(True))) == 4
    c = seq.parse_cigar(F.lit("3S10M2I5M4D6M1S"))
    assert one(spark, seq.format_cigar(c)) == "3S10M2I5M4D6M1S"
    assert [one(spark, f(c)) for f in (seq.read_length, seq.ref_length, seq.matched_length, seq.indel_count)] == [27, 25, 21, 2]
    assert [one(spark, x) for x in seq.clip_lengths(c)] == [3, 1]
    assert one(spark, seq.cigar_problem(c, F.lit(27))) is None and one(spark, seq.cigar_problem(seq.parse_cigar(F.lit("5S")), F.lit(5))) == "floating"
    assert one(spark, seq.info_value(F.lit("DP=3;CLS;AF=0.5"), "AF")) == "0.5" and one(spark, seq.info_value(F.lit("DP=3;CLS"), "CLS")) == ""
    assert one(spark, seq.format_value(F.lit("GT:CN"), F.lit("0/1:3"), "CN")) == "3"
    assert one(spark, seq.genotype_index(F.lit(2), F.lit(1))) == 4
    r = one(spark, seq.parse_region(F.lit("chr1:1,000-2000")))
    assert (r.chrom, r.begin, r.end) == ("chr1", 1000, 2000)
    assert one(spark, seq.variant_class(F.lit("A"), F.lit("<DEL>"))) == "other"


def test_plain_sequence_functions():
    assert seq.collapse_cigar(seq.parse_ops("2M1I2D1M"), "ACTGC", "ACGC") == [(2, "M"), (1, "D"), (2, "M")]
    assert seq.simple_indel(10, "ACC", "AC") == (11, 1, "")
    assert seq.left_shift("GCAAAT", 4, 1, "") == (2, 1, "")
    assert seq.left_shift("GCAAAT", 5, 0, "A") == (2, 0, "A")
    assert seq.repeat_unit("ATATAT") == ("AT", 3) and seq.repeat_count("GGATATATC", 4, "AT") == 3
    assert seq.compress_homopolymers("AACCCT") == "ACT" and seq.homopolymer_lengths("AACT") == [2, 2, 1, 1]
    assert seq.difference_string("ACGT", "ACTT", [(4, "M")]) == ":2*gt:1"
    assert seq.match_descriptor("ACGT", "ACTT", [(4, "M")]) == "2G1"
    assert seq.low_complexity("ACGTTGCATG" * 2) == [] and seq.low_complexity("A" * 40)


def test_left_shift_keeps_the_sequence():
    rng = random.Random(4)
    for _ in range(200):
        ref = "".join(rng.choice("AC") for _ in range(30))
        at, size = rng.randrange(5, 20), rng.randrange(1, 4)
        b, d, s = seq.left_shift(ref, at, size, "")
        assert b <= at and ref[:at] + ref[at + size :] == ref[:b] + s + ref[b + d :]
        ins = "".join(rng.choice("AC") for _ in range(size))
        b, d, s = seq.left_shift(ref, at, 0, ins)
        assert b <= at and ref[:at] + ins + ref[at:] == ref[:b] + s + ref[b:]


def test_sql_functions(spark):
    names = sqlfuncs.register(spark)
    r = spark.sql("SELECT phred(0.1D) a, revcomp('AAC') b, genotype_index(1, 2) c, best_alt('A', 0, 2, 1, 3) d, fisher_exact(3, 1, 1, 3) e, safe_frac(1, 0) f").first()
    assert (r.a, r.b, r.c, r.d, r.f) == (10, "GTT", 4, "G", 0) and math.isclose(r.e, 0.4857142857, rel_tol=1e-9)
    assert "binom_upper" in names


def test_low_complexity_breaks_at_other_letters():
    plain = "ACGTTGCATCAG"
    assert seq.low_complexity(plain + "N" * 30 + plain) == []
    poly = seq.low_complexity("A" * 40)
    assert poly == [(0, 40)] and seq.low_complexity("A" * 40 + "N" + "A" * 40) == [(0, 40), (41, 81)]
