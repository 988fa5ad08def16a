import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from seqloom.operators import align, errors, filters, genotype, gvcf, indels, intervals, merge, ordered, pileup, regions, score, sketch, somatic

ALN = "read_id long, contig_id int, segment_id int, pos int, flag int, mapq int, cigar array<struct<op:string,len:int>>, seq string, quals array<tinyint>, src_rank int, src_ord long"


def make_reads(n=50, seed=3, length=20):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        kind = rng.randrange(4)
        s = "".join(rng.choice("ACGTN" if rng.random() < 0.1 else "ACGT") for _ in range(length))
        cigar = {0: [("M", length)], 1: [("M", 8), ("I", 2), ("M", length - 10)], 2: [("M", 9), ("D", 3), ("M", length - 9)], 3: [("S", 4), ("M", length - 4)]}[kind]
        rows.append((i, rng.randrange(2), 0, rng.randrange(1, 40), rng.choice([0, 16]), rng.choice([0, 10, 30, 60]), cigar, s, [rng.choice([0, 5, 20, 40]) for _ in s], 0, i))
    return rows


def brute_pileup(rows, ref):
    out = defaultdict(Counter)
    for _, contig, seg, pos, flag, mapq, cigar, s, quals, *_ in rows:
        ungapped, r, q = len(cigar) == 1 and cigar[0][0] == "M", pos, 0
        for op, n in cigar:
            if op == "M":
                for _ in range(n):
                    b, x, c = s[q], quals[q], out[contig, seg, r]
                    usable = mapq > 0 and x > 0
                    c["depth"] += usable and (b in "ACGT" or not ungapped)
                    if b in "ACGT":
                        c["c_" + b.lower()] += usable
                        side = "rev" if flag & 16 else "fwd"
                        c[side + "_total"] += 1
                        if b != ref[contig, r]:
                            c[side + "_alt"] += 1
                            c["mapq_sum"] += mapq
                            c["bq_alt_sum"] += x
                    r, q = r + 1, q + 1
            elif op == "D":
                for _ in range(n):
                    out[contig, seg, r]["depth"] += mapq > 0
                    r += 1
            else:
                q += n
    return out


def ref_frame(spark, length=100):
    return spark.createDataFrame([(c, p, "ACGT"[(p * 7 + c) % 4]) for c in range(2) for p in range(1, length)], "contig_id int, pos int, base string")


def test_pileup_against_brute_force(spark):
    rows = make_reads()
    ref = {(c, p): "ACGT"[(p * 7 + c) % 4] for c in range(2) for p in range(1, 100)}
    got = pileup.pileup(spark.createDataFrame(rows, ALN), ref_frame(spark)).collect()
    want = brute_pileup(rows, ref)
    assert {(r.contig_id, r.segment_id, r.pos) for r in got} == set(want)
    for r in got:
        w = want[r.contig_id, r.segment_id, r.pos]
        assert all(r[k] == w[k] for k in ("c_a", "c_c", "c_t", "c_g", "depth", "fwd_alt", "fwd_total", "rev_alt", "rev_total", "mapq_sum", "bq_alt_sum")), (r, w)


def test_pileup_does_not_depend_on_segments(spark):
    rows = make_reads(seed=9)
    base = spark.createDataFrame(rows, ALN)
    results = []
    for size in (1000, 10, 3):
        a = base.withColumn("segment_id", F.floor((F.col("pos") - 1) / size).cast("int"))
        p = pileup.pileup(a, ref_frame(spark)).groupBy("contig_id", "pos").agg(F.sum("depth").alias("d"), F.sum("c_a").alias("a"))
        results.append(sorted(map(tuple, p.collect())))
    assert results[0] == results[1] == results[2]


def test_median_and_ranks(spark):
    df = spark.createDataFrame([(0,), (2,), (1,), (3,)], "v long")
    assert ordered.median_nonzero(df, [], "v").first().median == 2
    assert ordered.median_nonzero(df.union(spark.createDataFrame([(4,)], "v long")), [], "v").first().median == 2.5
    ref, alt = [44, 45, 52, 53, 56, 58, 58, 65, 79], [45, 50, 61, 63, 75, 85, 93]
    r = spark.createDataFrame([("k", float(v), False) for v in ref] + [("k", float(v), True) for v in alt], "k string, v double, b boolean")
    z = ordered.rank_sum(r, ["k"], "v", F.col("b")).first().z
    assert math.isclose(z, -1.27021, rel_tol=1e-4)


def test_window_average(spark):
    values = [0, 1, 2, 3, None, None, None, 0, 1, 2, 3]
    df = spark.createDataFrame([(0, i, None if v is None else float(v)) for i, v in enumerate(values)], "k int, i int, v double")
    got = [(r.avg, r.avg_n) for r in ordered.moving_average(df, ["k"], ["i"], "v", 3).orderBy("i").collect()]
    assert got[:7] == [(0, 1), (0.5, 2), (1, 3), (2, 3), (2.5, 2), (3, 1), (None, 0)]


def test_intervals_against_brute_force(spark):
    rng = random.Random(5)
    a = [(i, rng.choice("xy"), s := rng.randrange(200), s + rng.randrange(1, 30)) for i in range(60)]
    b = [(i, rng.choice("xy"), s := rng.randrange(200), s + rng.randrange(1, 30)) for i in range(60)]
    l = spark.createDataFrame(a, "i int, k string, start long, end long")
    r = spark.createDataFrame(b, "j int, k string, r_start long, r_end long")
    want = sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] < y[3] and y[2] < x[3])
    for width in (1, 7, 1000):
        assert sorted((x.i, x.j) for x in intervals.interval_join(l, r, ["k"], width=width).collect()) == want
    hit = {i for i, _ in want}
    assert sorted(x.i for x in intervals.interval_join(l, r, ["k"], width=7, how="left_semi").collect()) == sorted(hit)
    assert sorted(x.i for x in intervals.interval_join(l, r, ["k"], width=7, how="left_anti").collect()) == sorted(set(range(60)) - hit)
    depth = Counter(p for x in a for p in range(x[2], x[3]))
    assert {x.pos: x.depth for x in intervals.depth_per_position(l, [], "start", "end").collect()} == dict(depth)


def test_asof_and_merge(spark):
    l = spark.createDataFrame([("a", 1), ("a", 5), ("a", 9)], "k string, t long")
    r = spark.createDataFrame([("a", 5), ("a", 30)], "k string, t long")
    assert sorted((x.t, x.next_at) for x in intervals.asof_forward(l, r, ["k"], "t", 10).collect()) == [(1, 5), (5, 5)]
    calls = lambda rows: spark.createDataFrame(rows, "pos int, f string, q int")
    got = merge.priority_merge(calls([(1, "PASS", 3), (1, "PASS", 4), (2, "x", 1)]), calls([(1, "PASS", 9), (2, "PASS", 8), (3, ".", 7)]), ["pos"], ["q"], F.col("f") == "PASS")
    assert sorted((x.pos, x.q, x.source) for x in got.collect()) == [(1, 3, 1), (2, 8, 2), (3, 7, 2)]


def test_partitioning():
    chunks, most, size = merge.chunk_size([1000, 500], 10)
    assert (chunks, most, size) == (sum(-(-n // size) for n in (1000, 500)), -(-1000 // size), size)
    pieces = merge.equal_segments(103, 25)
    assert pieces[0][0] == 0 and pieces[-1][1] == 103 and {b - a for a, b in pieces} == {20, 21}


def test_genotype_of_clear_sites(spark):
    rows = [(1, b, 30, s) for b in "A" * 20 for s in "+-"] + [(2, b, 30, s) for b in "AC" * 10 for s in "+-"]
    calls = spark.createDataFrame([(p, b, q, s) for p, b, q, s in rows], "pos int, base string, q int, strand string")
    lh = genotype.likelihoods(genotype.dependent_errors(calls, ["pos"]), ["pos"]).withColumn("ref", F.lit("A"))
    got = {r.pos: r for r in genotype.genotypes(lh).collect()}
    assert got[1].gt == "AA" and got[2].gt == "AC" and got[2].gqx > 0 and min(got[2].pl) == 0
    assert genotype.alt_ranking(spark.createDataFrame([(2, "s", "A", 10), (2, "s", "C", 9), (2, "s", "G", 1)], "pos int, sample string, base string, n int").withColumn("ref", F.lit("A")), ["pos"]).first().base == "C"
    sb = genotype.strand_bias(calls.withColumn("e", F.lit(0.001)), ["pos"], "ref", genotype.genotypes(lh)).collect()
    assert all(r.strand_bias <= 1e-9 or r.pos == 1 for r in sb)


def test_filters(spark):
    df = spark.createDataFrame([(0x200 | 0x4, 60), (0x100, 60), (0x1, 60), (0x3, 60), (0, 10)], "flag int, mapq int")
    got = [(r.r, r.t) for r in df.select(filters.refusal(F.col("flag")).alias("r"), filters.mapping_tier(F.col("flag"), F.col("mapq")).alias("t")).collect()]
    assert got == [("qc_fail", 1), ("secondary", 1), (None, 2), (None, 1), (None, 2)]
    rows = make_reads(40, length=20)
    capped = filters.cap_depth(spark.createDataFrame(rows, ALN), 3).collect()
    depth = Counter((r.contig_id, r.pos + i) for r in capped for i in range(sum(x.len for x in r.cigar if x.op in "MD")))
    assert max(depth.values()) == 3


def test_gvcf_blocks(spark):
    dp = [10, 11, 12, 40, 41, 41, 10]
    rows = [(0, 0, i + 1 + (i > 5), d, 0, 30.0, "", "0/0", 2, True, True) for i, d in enumerate(dp)]
    s = spark.createDataFrame(rows, "contig_id int, segment_id int, pos long, dp long, dpf long, gqx double, filters string, gt string, ploidy int, covered boolean, used_covered boolean")
    got = sorted((r.begin, r.end, r.min_dp) for r in gvcf.blocks(s).collect())
    assert got == [(1, 3, 10), (4, 6, 40), (8, 8, 10)]
    assert gvcf.within(10, 26) and not gvcf.within(10, 28)
    lines = gvcf.block_lines(gvcf.blocks(s), F.lit("c1"), F.lit("A")).orderBy("pos").collect()
    assert lines[0].line.startswith("c1\t1\t.\tA\t.\t.\tPASS\tEND=3")
    assert gvcf.header([("c1", 10)], "s")[-1].endswith("\ts")


def test_minimizers_against_brute_force():
    rng = random.Random(2)
    s = "".join(rng.choice("ACGT") for _ in range(300))
    k, w = 11, 5
    h, end, _ = sketch.kmers(s, k)
    h, end = h.tolist(), end.tolist()
    want = {end[i] for a in range(len(h) - w + 1) for i in range(a, a + w) if h[i] == min(h[a : a + w])}
    assert {e for _, e, _ in sketch.minimizers(s, k, w)} == want
    rc = s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    assert {x for x, _, _ in sketch.minimizers(s, k, w)} == {x for x, _, _ in sketch.minimizers(rc, k, w)}


def test_alignment():
    assert align.global_align("ACGT", "ACGT")[1] == [(4, "M")]
    score_, ops = align.global_align("ACGTACGT", "ACGTCGT")
    assert score_ == 7 - 5 - 1 and sorted(ops) == [(1, "D"), (3, "M"), (4, "M")] or sum(n for n, o in ops if o == "D") == 1
    assert align.global_align("TTACGTTT", "ACGT", free_ends=True) == (4, [(4, "M")])


def test_map_reads(spark):
    rng = random.Random(8)
    ref = {0: "".join(rng.choice("ACGT") for _ in range(3000)), 1: "".join(rng.choice("ACGT") for _ in range(2000))}
    comp = str.maketrans("ACGT", "TGCA")
    reads, truth = [], {}
    for i in range(30):
        c, p, rev = rng.randrange(2), rng.randrange(1500), rng.random() < 0.5
        s = ref[c][p : p + 100]
        if i % 3 == 0:
            s = s[:50] + ("A" if s[50] != "A" else "C") + s[51:]
        reads.append((i, s.translate(comp)[::-1] if rev else s))
        truth[i] = (c, p + 1, rev)
    got = [r for r in align.map_reads(spark.createDataFrame(reads, "read_id long, seq string"), ref).collect() if r.primary]
    assert {r.read_id: (r.contig_id, r.pos, r.reverse) for r in got} == truth and all(r.mapq > 20 for r in got)
    hits = [(p, m, 0, pos, m == 2, 180, 60, 100) for p in range(2) for m, pos in ((1, 100), (2, 300 if p == 0 else 5000))]
    pairs = align.pair_hits(spark.createDataFrame(hits, "pair_id int, mate int, contig_id int, pos int, reverse boolean, score int, mapq int, length int")).collect()
    assert [(r.pair_id, r.insert_size) for r in pairs] == [(0, 300)]


def test_indels(spark):
    obs = indels.observations(spark.createDataFrame(make_reads(20), ALN))
    assert {r.kind for r in obs.collect()} <= {"insertion", "deletion", "swap", "edge"}
    sup = spark.createDataFrame([(0, 5, 0, "A", 12), (0, 6, 0, "A", 1)], "contig_id int, pos int, del_len int, ins_seq string, reads long")
    dep = spark.createDataFrame([(0, 5, 40), (0, 6, 40)], "contig_id int, pos int, depth long")
    assert {r.pos: r.is_candidate for r in indels.candidates(sup, dep).collect()} == {5: True, 6: False}
    ctx = indels.repeat_context(sup, {0: "GCAAAATC"}).orderBy("pos").first()
    assert (ctx.unit, ctx.ref_repeats, ctx.alt_repeats) == ("A", 4, 5)
    sc = spark.createDataFrame([(1, -1.0, -20.0)] * 10 + [(2, -20.0, -1.0)] * 10 + [(3, -1.0, -20.0), (3, -20.0, -1.0)] * 8, "site int, lnp_ref double, lnp_indel double")
    assert {r.site: r.gt for r in indels.genotype(sc, ["site"]).collect()} == {1: "0/0", 2: "1/1", 3: "0/1"}
    ind = spark.createDataFrame([(0, 10, 15, [], 50, 40), (0, 14, 20, [], 30, 20), (0, 40, 45, ["LowGQX"], 9, 8)], "contig_id int, begin int, end int, filters array<string>, qual int, gqx int")
    sites = spark.createDataFrame([(0, 12, [], 99, 99), (0, 42, [], 99, 99), (0, 60, [], 99, 99)], "contig_id int, pos int, filters array<string>, qual int, gqx int")
    a, b = indels.resolve_overlaps(ind, sites)
    assert sorted(r.begin for r in a.collect() if "IndelConflict" in r.filters) == [10, 14]
    assert {r.pos: (r.filters, r.qual) for r in b.collect()} == {12: (["IndelConflict"], 99), 42: (["SiteConflict"], 9), 60: ([], 99)}


def test_somatic(spark):
    import numpy as np

    def lh(alt, ref, e=0.001):
        return np.array([alt * math.log((1 - e) * r + e / 3 * (1 - r)) + ref * math.log((1 - e) * (1 - r) + e / 3 * r) for r in somatic.FRACTIONS])

    qss, nt, kind = somatic.somatic_quality(lh(0, 40), lh(15, 25))
    assert qss > 15 and nt > 15 and kind == "ref"
    assert somatic.somatic_quality(lh(20, 20), lh(20, 20))[0] == 0
    f = somatic.indel_features(spark.createDataFrame([(10, 10, 5, 5, 0, 1, 9, 20, 0)], "ref_fwd int, ref_rev int, alt_fwd int, alt_rev int, other int, filtered int, used int, normal_ref int, normal_alt int")).first()
    assert math.isclose(f.af, 1 / 3) and f.sor == 0 and math.isclose(f.fs, 1.0) and math.isclose(f.bcn, 0.1)


def test_regions(spark):
    s = spark.createDataFrame([(0, p, 10, 20) for p in (5, 10, 22, 60, 61)] + [(0, 100, 12, 20)], "contig_id int, pos int, variants int, depth int")
    got = sorted((r.begin, r.end, r.sites) for r in regions.active_regions(s).collect())
    assert got == [(5, 22, 3), (60, 61, 2)]
    a = spark.createDataFrame([(0, 1), (0, 30), (0, 55), (0, 90)], "contig_id int, pos int")
    assert sorted((r.begin, r.end) for r in regions.extend_to_anchors(regions.active_regions(s), a).collect()) == [(1, 30), (55, 90)]
    rng = random.Random(1)
    g = "".join(rng.choice("ACGT") for _ in range(200))
    assert g[30:170] in regions.assemble([g[i : i + 60] for i in range(0, 141, 5)] * 3)[0]
    assert regions.primitive_variants("ACGTTTGA", "ACGATTGA") == [(3, "T", "A")]
    assert regions.primitive_variants("ACGTTTGAC", "ACGTTGAC") == [(3, "T", "")]
    p = spark.createDataFrame([("s", 1, 5, "1|0"), ("s", 1, 9, "0|1"), ("s", 1, 11, "1|1"), ("s", 2, 40, "0|1")], "sample string, region int, pos int, gt string")
    assert {r.pos: (r.phase_set, r.phased) for r in regions.phase(p).collect()} == {5: (5, "0|1"), 9: (5, "1|0"), 11: (None, "1/1"), 40: (None, "0/1")}
    h = spark.createDataFrame([(1, i, "AAA" if i < 5 else "CCC" if i < 8 else "G") for i in range(10)], "region int, read_id int, hap string")
    assert sorted((r.hap, r["rank"]) for r in regions.haplotypes(h).collect()) == [("AAA", 1), ("CCC", 2)]
    runs = regions.homopolymers(spark.createDataFrame([(0, i, b) for i, b in enumerate("AACCC")], "contig_id int, pos int, base string"))
    assert sorted((r.base, r.length) for r in runs.collect()) == [("A", 2), ("C", 3)]


def test_forest(spark):
    text = '{"trees": [[{"left": 1, "right": 2, "feature": 0, "threshold": 0.5}, {"votes": [9, 1]}, {"votes": [1, 9]}]]}'
    trees = score.parse_forest(text)
    df = spark.createDataFrame([(1, [0.1]), (2, [0.9])], "id int, features array<double>")
    assert {r.id: r.evs for r in score.forest_score(df, trees).collect()} == {1: 0, 2: 10}


def test_trained_forest_agrees_with_its_own_trees(spark):
    rng = random.Random(3)
    rows = [([x := rng.random(), rng.random()], float(x > 0.5)) for _ in range(300)]
    df = spark.createDataFrame(rows, "features array<double>, label double")
    model = score.train_forest(df, trees=5, depth=3, least=5)
    import numpy as np
    from pyspark.ml.functions import array_to_vector, vector_to_array

    x = np.array([r[0] for r in rows])
    want = [r.p[1] for r in model.transform(df.select(array_to_vector("features").alias("features"))).select(vector_to_array("probability").alias("p")).collect()]
    assert np.allclose(score.forest_probability(score.forest_trees(model), x), want, atol=0.05)


def test_errors(spark):
    sites = spark.createDataFrame([(1, 5, "ins", 0, 30)] * 50 + [(1, 5, "ins", 9, 21)] * 5, "unit int, repeats int, kind string, alt_reads int, ref_reads int")
    counts = errors.indel_error_counts(sites)
    assert counts.agg(F.sum("loci")).first()[0] == 55
    m = errors.mixture_rates(counts, ["unit", "repeats"]).first()
    assert m.clean_rate < 0.01 and 0.2 < m.noisy_rate < 0.4 and 0.05 < m.noisy_share < 0.15


@pytest.mark.parametrize("empty", [True])
def test_empty_tables(spark, empty):
    l = spark.createDataFrame([], "k string, start long, end long")
    r = spark.createDataFrame([], "k string, r_start long, r_end long")
    assert intervals.interval_join(l, r, ["k"]).count() == 0 and intervals.coalesce(l, ["k"]).count() == 0 and intervals.depth(l, ["k"]).count() == 0
    assert pileup.pileup(spark.createDataFrame([], ALN), ref_frame(spark)).count() == 0


def test_realignment(spark):
    from seqloom.operators import realign

    rng = random.Random(12)
    ref = "".join(rng.choice("ACGT") for _ in range(300))
    deletion, insertion = (150, 4, ""), (150, 0, "ACGGT")
    carrier, plain = ref[100:150] + ref[154:190], ref[100:186]
    q = [30] * 86
    assert realign.realign(ref, carrier, q, 100, [deletion, insertion])[2] == (deletion,)
    assert realign.realign(ref, plain, q, 100, [deletion, insertion])[2] == ()
    df = spark.createDataFrame([(1, 0, 101, carrier, q), (2, 0, 101, plain, q)], "read_id long, contig_id int, pos int, seq string, quals array<int>")
    got = {(r.read_id, r.del_len): r.lnp_indel > r.lnp_ref for r in realign.score_reads(df, {0: [deletion]}, {0: ref}).collect()}
    assert got == {(1, 4): True, (2, 4): False}
    s = realign.support_summary(realign.score_reads(df, {0: [deletion]}, {0: ref})).first()
    assert (s.ref, s.indel, s.unsure) == (1, 1, 0)


def test_older_tests(spark):
    from seqloom.operators import legacy

    calls = [(0, 1, "A", b, 30) for b in "A" * 20] + [(0, 2, "A", b, 30) for b in "AC" * 10]
    df = spark.createDataFrame(calls, "contig_id int, pos int, ref string, base string, q int")
    got = {r.pos: r for r in legacy.likelihood_ratio(legacy.collect_sites(df)).collect()}
    assert not got[1].is_snp and got[2].is_snp and abs(got[2].fraction - 0.5) < 0.05
    assert {r.pos: r.base for r in legacy.monoploid(df, ["contig_id", "pos"]).where("pos = 1").collect()} == {1: "A"}
    post = legacy.n_ploid([(10, 10)], 0.01, 4)
    assert max(range(5), key=post.__getitem__) == 2 and math.isclose(sum(post), 1)
    s = legacy.strand_anomaly(spark.createDataFrame([(30, 0, 0, 30), (15, 15, 15, 15)], "fwd_ref int, fwd_alt int, rev_ref int, rev_alt int")).collect()
    assert [r.is_anomaly for r in s] == [True, False]
    assert legacy.nonref_test(spark.createDataFrame([(50, 20)], "ref_n int, alt_n int")).first().is_nonref
    assert legacy.strand_coverage_anomaly(spark.createDataFrame([(60, 0)], "fwd int, rev int")).first().is_anomaly
    assert legacy.haplotype_score([("AC", [30, 30])] * 3 + [("AG", [30, 20])] * 3) == 0


def test_somatic_lines_and_rates_by_context(spark):
    calls = spark.createDataFrame([(0, 5, "A", "C", [], 40, 30, "ref", [20, 0], [10, 9])], "contig_id int, pos int, ref string, alt string, filters array<string>, qss int, qss_nt int, nt string, normal_ad array<int>, tumour_ad array<int>")
    line = somatic.lines(calls, F.lit("c1")).first().line
    assert line == "c1\t5\t.\tA\tC\t.\tPASS\tSOMATIC;QSS=40;QSS_NT=30;NT=ref\tDP:AD\t20:20,0\t19:10,9"
    assert somatic.header([("c1", 9)])[-1].count("\t") == line.count("\t")
    sc = spark.createDataFrame([(1, -3.0, -1.0, 1e-4)] * 3 + [(2, -3.0, -1.0, 0.2)] * 3, "site int, lnp_ref double, lnp_indel double, rate double")
    assert {r.site: r.gt for r in indels.genotype(sc, ["site"], "rate").collect()} == {1: "0/0", 2: "1/1"}
