"""The operators on aligned reads, as derived in ``reads``."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import errors, filters, genotype, gvcf, indels, intervals, pileup, regions, sketch, somatic
from .reads import SQL, reads, reference
from .registry import query

_COUNTS = "contig_id, segment_id, pos, ref, c_a, c_c, c_t, c_g, depth, fwd_alt, fwd_total, rev_alt, rev_total, mapq_sum, bq_alt_sum"


def _pile(spark, d):
    return pileup.pileup(reads(spark, d), reference(spark))


def _judged(spark, d):
    return pileup.assess(_pile(spark, d))


@query("pileup_counts", f"WITH {SQL} SELECT {_COUNTS} FROM pile")
def pileup_counts(spark, d):
    return _pile(spark, d)


_CLS = "CASE WHEN pos - lag(pos) OVER (PARTITION BY contig_id, segment_id ORDER BY pos) < 10 THEN 1 ELSE 0 END AS cls"


@query("snp_calls", f"WITH {SQL} SELECT contig_id, segment_id, pos, ref, alt, alt_n, depth, round(aaf, 6) AS aaf, CASE WHEN aaf > 80 THEN '1/1' ELSE '0/1' END AS gt, avg_mapq, avg_bq, {_CLS} FROM judged WHERE is_call")
def snp_calls(spark, d):
    c = pileup.snp_calls(_judged(spark, d))
    return c.select("contig_id", "segment_id", "pos", "ref", "alt", "alt_n", "depth", F.round("aaf", 6).alias("aaf"), "gt", "avg_mapq", "avg_bq", "cls")


_COMPLEX = "cx AS (SELECT contig_id, pos FROM judged WHERE is_complex UNION SELECT contig_id, pos FROM ins)"


@query("complex_positions", f"WITH {SQL}, {_COMPLEX} SELECT * FROM cx")
def complex_positions(spark, d):
    return pileup.complex_positions(_judged(spark, d), reads(spark, d))


@query(
    "reads_near_complex",
    f"""WITH {SQL}, m AS (SELECT contig_id, pos FROM judged WHERE is_complex),
j AS (SELECT r.doc_id * 100000 + r.i AS read_id, r.contig_id, r.pos, min(m.pos) AS near_pos FROM reads r JOIN m ON r.contig_id = m.contig_id AND m.pos >= r.pos GROUP BY ALL)
SELECT * FROM j WHERE near_pos - pos < 220""",
)
def reads_near_complex(spark, d):
    marks = _judged(spark, d).where("is_complex").select("contig_id", "pos")
    return pileup.reads_near(reads(spark, d).select("read_id", "contig_id", "pos"), marks)


@query(
    "vcf_lines",
    f"""WITH {SQL}, c AS (SELECT *, {_CLS}, CASE WHEN fwd_alt < rev_alt THEN fwd_alt / nullif(rev_alt, 0)::DOUBLE ELSE rev_alt / nullif(fwd_alt, 0)::DOUBLE END AS sb,
  CASE WHEN fwd_alt < rev_alt THEN fwd_total / nullif(rev_total, 0)::DOUBLE ELSE rev_total / nullif(fwd_total, 0)::DOUBLE END AS sbt, CASE WHEN fwd_alt < rev_alt THEN fwd_total ELSE rev_total END AS low FROM judged WHERE is_call)
SELECT contig_id, pos, concat_ws(chr(9), 'c' || contig_id, pos, '.', ref, alt, avg_mapq, '.', format('DP={{}};ACTG={{}},{{}},{{}},{{}};FC={{}};RC={{}};FT={{}};RT={{}};SBLow={{}};CLS={{}}', depth, c_a, c_c, c_t, c_g, fwd_alt, rev_alt, fwd_total, rev_total, low, cls), 'GT', CASE WHEN aaf > 80 THEN '1/1' ELSE '0/1' END) AS line FROM c""",
)
def vcf_lines(spark, d):
    lines = pileup.vcf_lines(pileup.snp_calls(_judged(spark, d)), F.concat(F.lit("c"), F.col("contig_id").cast("string")))
    # two engines round printed halves differently: the three ratios are compared in snp_calls, as numbers
    return lines.select("contig_id", "pos", F.regexp_replace(F.regexp_replace("line", ";SB=[^;]*;SBT=[^;]*", ""), ";AAF=[^;]*", "").alias("line"))


@query(
    "segment_sort",
    f"WITH {SQL} SELECT contig_id, (pos - 1) // 5000 AS segment_id, doc_id * 100000 + i AS read_id, pos, row_number() OVER (PARTITION BY contig_id, (pos - 1) // 5000 ORDER BY pos, i, doc_id) AS place FROM reads",
)
def segment_sort(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("contig_id", "segment_id").orderBy("pos", "src_rank", "src_ord", "read_id")
    return reads(spark, d).select("contig_id", "segment_id", "read_id", "pos", F.row_number().over(w).alias("place"))


@query(
    "read_filters",
    f"WITH {SQL} SELECT CASE WHEN h % 7 = 0 THEN 'qc_fail' WHEN h % 5 = 0 THEN 'duplicate' WHEN h % 3 = 0 THEN 'unmapped' END AS reason, CASE WHEN mapq >= 20 AND (h % 2 = 0 OR h % 4 = 1) THEN 1 ELSE 2 END AS tier, count(*) AS n FROM reads GROUP BY 1, 2",
)
def read_filters(spark, d):
    h = F.floor(F.col("read_id") / 100_000) * 1009 + F.col("src_ord") * 31
    bit = lambda m, b: F.when(h % m == 0, b).otherwise(0)
    pair = F.when(h % 2 == 1, 1).otherwise(0) + F.when(h % 4 == 1, 2).otherwise(0)
    r = reads(spark, d).withColumn("f", (bit(7, 0x200) + bit(5, 0x400) + bit(3, 0x4) + pair).cast("int"))
    return r.groupBy(filters.refusal(F.col("f")).alias("reason"), filters.mapping_tier(F.col("f"), F.col("mapq")).alias("tier")).agg(F.count("*").alias("n"))


@query("depth_by_contig", f"WITH {SQL}, e AS (SELECT contig_id, p, count(*) AS n FROM (SELECT contig_id, unnest(range(pos, pos + CASE kind WHEN 0 THEN 98 WHEN 1 THEN 103 WHEN 2 THEN 90 ELSE n END)) AS p FROM reads) GROUP BY 1, 2) SELECT contig_id, median(n) AS median FROM e GROUP BY 1")
def depth_by_contig(spark, d):
    from ..functions import seq
    from ..operators.ordered import median_nonzero

    spans = reads(spark, d).select("contig_id", F.col("pos").alias("start"), (F.col("pos") + seq.ref_length(F.col("cigar"))).alias("end"))
    return median_nonzero(intervals.depth_per_position(spans, ["contig_id"]), ["contig_id"], "depth")


def _calls(spark, d, min_q: int = 17):
    b = pileup.base_calls(reads(spark, d)).where("op = 'M'")
    return b.where(filters.usable_call(F.col("base"), F.col("q"), min_q=min_q)).select("contig_id", "pos", "base", "q", F.when(F.col("reverse"), "-").otherwise("+").alias("strand"))


_DEP = """calls AS (SELECT contig_id, p AS pos, base, q, CASE WHEN rev THEN '-' ELSE '+' END AS strand FROM bases WHERE q >= 17),
v AS (SELECT *, pow(10, -q / 10.0) AS e, greatest(0.25, pow(0.65, row_number() OVER (PARTITION BY contig_id, pos, strand, base ORDER BY q DESC) - 1)) AS v FROM calls),
dep AS (SELECT *, greatest(e, (1 - pow(e, v)) / (1 - e) * pow(e, v) + (1 - (1 - pow(e, v)) / (1 - e)) * 0.75) AS e_adj FROM v)"""


@query("dependent_errors", f"WITH {SQL}, {_DEP} SELECT contig_id, pos, count(*) AS n, round(sum(v), 6) AS vexp, round(sum(e_adj), 6) AS e_adj FROM dep GROUP BY 1, 2")
def dependent_errors(spark, d):
    dep = genotype.dependent_errors(_calls(spark, d), ["contig_id", "pos"])
    return dep.groupBy("contig_id", "pos").agg(F.sum("n").alias("n"), F.round(F.sum(F.col("n") * F.col("vexp")), 6).alias("vexp"), F.round(F.sum(F.col("n") * F.col("e_adj")), 6).alias("e_adj"))


def _sql_term(g: str) -> str:
    if g[0] == g[1]:
        return f"round(sum(CASE WHEN base = '{g[0]}' THEN ln(1 - e) ELSE ln(e_adj) + ln(1/3.0) END), 9)"
    return f"round(sum(CASE WHEN base IN ('{g[0]}', '{g[1]}') THEN ln((1 - e) + e / 3) + ln(0.5) ELSE ln(e_adj) + ln(1/3.0) END), 9)"


_LH = "lh AS (SELECT contig_id, pos, [" + ", ".join(map(_sql_term, genotype.GENOTYPES)) + "] AS l FROM dep GROUP BY 1, 2)"


def _sql_priors() -> str:
    from ..functions.numeric import genotype_priors

    table = genotype_priors()
    return "CASE ref " + " ".join(f"WHEN '{r}' THEN [{', '.join(repr(math.log(table[r][g])) for g in genotype.GENOTYPES)}]" for r in "ACGT") + " END"


@query(
    "site_genotypes",
    f"""WITH {SQL}, {_DEP}, {_LH},
s AS (SELECT lh.contig_id, lh.pos, ref, list_transform(range(1, 11), lambda i: l[i] + ({_sql_priors()})[i]) AS w, l FROM lh JOIN ref ON lh.contig_id = ref.contig_id AND lh.pos = ref.pos),
n AS (SELECT *, list_transform(w, lambda x: exp(x - list_max(w))) AS x FROM s)
SELECT contig_id, pos, ref, {genotype.GENOTYPES!r}[list_position(w, list_max(w))] AS gt, round(list_max(x) / list_sum(x), 6) AS p FROM n""".replace("('AA'", "['AA'").replace("'TT')", "'TT']"),
)
def site_genotypes(spark, d):
    sites = ["contig_id", "pos"]
    lh = genotype.likelihoods(genotype.dependent_errors(_calls(spark, d), sites), sites).join(reference(spark).withColumnRenamed("base", "ref"), sites)
    return genotype.genotypes(lh).select("contig_id", "pos", "ref", "gt", F.round(F.array_max("posterior"), 6).alias("p"))


@query(
    "allele_support",
    f"WITH {SQL} SELECT contig_id, p AS pos, count(*) FILTER (base = 'A') AS a, count(*) FILTER (base = 'C' AND NOT rev) AS c_fwd, count(*) FILTER (base = 'T' AND rev) AS t_rev FROM bases WHERE q >= 17 GROUP BY 1, 2",
)
def allele_support(spark, d):
    s = genotype.allele_support(_calls(spark, d), ["contig_id", "pos"])
    return s.select("contig_id", "pos", F.col("ad")[0].alias("a"), F.col("adf")[1].alias("c_fwd"), F.col("adr")[3].alias("t_rev"))


@query(
    "mismatch_density",
    f"""WITH {SQL}, b AS (SELECT b.read_id, b.o, CAST(b.base <> ref.ref AND b.q > 30 AS INT) AS m FROM bases b JOIN ref ON b.contig_id = ref.contig_id AND b.p = ref.pos JOIN reads r ON r.doc_id * 100000 + r.i = b.read_id WHERE r.n = 100 AND r.kind = 9),
w AS (SELECT read_id, o, m, coalesce(sum(m) OVER (PARTITION BY read_id ORDER BY o RANGE BETWEEN 20 PRECEDING AND 20 FOLLOWING), 0) AS mid, sum(m) FILTER (o <= 40) OVER (PARTITION BY read_id) AS f, sum(m) FILTER (o >= 59) OVER (PARTITION BY read_id) AS l FROM b),
x AS (SELECT read_id, CASE WHEN o < 20 THEN f WHEN o > 79 THEN l ELSE mid END AS near, m FROM w)
SELECT read_id, CAST(sum(near) AS BIGINT) AS near, count(*) FILTER (near > 2) AS dense, count(*) FILTER (near - m > 0) AS neighbours FROM x GROUP BY 1""",
)
def mismatch_density(spark, d):
    r = reads(spark, d).where((F.length("seq") == 100) & (F.size("cigar") == 1))
    b = pileup.base_calls(r).join(reference(spark).withColumnRenamed("base", "ref"), ["contig_id", "pos"]).withColumn("read_length", F.lit(100))
    m = filters.mismatch_density(b, ["read_id"], "off", (F.col("base") != F.col("ref")) & (F.col("q") > 30))
    return m.groupBy("read_id").agg(F.sum("near").alias("near"), F.count_if("dense").alias("dense"), F.count_if("neighbour_mismatch").alias("neighbours"))


@query(
    "gvcf_runs_exact",
    f"""WITH {SQL}, d AS (SELECT contig_id, pos, least(CAST(sum(depth) AS BIGINT) // 8, 3) AS level FROM pile GROUP BY 1, 2),
g AS (SELECT *, pos - row_number() OVER (PARTITION BY contig_id, level ORDER BY pos) AS g FROM d)
SELECT contig_id, level, min(pos) AS "first", max(pos) AS "last", count(*) AS n FROM g GROUP BY contig_id, level, g""",
)
def gvcf_runs_exact(spark, d):
    depth = _pile(spark, d).groupBy("contig_id", "pos").agg(F.sum("depth").alias("depth"))
    return intervals.islands(depth.withColumn("level", F.least(F.floor(F.col("depth") / 8), F.lit(3))), ["contig_id", "level"])



@query(
    "indel_support",
    f"""WITH {SQL}, o AS (SELECT contig_id, pos + 40 AS pos, 0 AS del_len, substr(seq, 41, 2) AS ins_seq, doc_id * 100000 + i AS read_id FROM reads WHERE kind = 0
UNION ALL SELECT contig_id, pos + 50, 3, '', doc_id * 100000 + i FROM reads WHERE kind = 1)
SELECT contig_id, pos, del_len, ins_seq, count(DISTINCT read_id) AS reads FROM o GROUP BY 1, 2, 3, 4""",
)
def indel_support(spark, d):
    return indels.support(indels.observations(reads(spark, d)))


@query(
    "active_regions",
    f"""WITH {SQL}, s AS (SELECT contig_id, pos, CAST(sum(fwd_alt + rev_alt) AS BIGINT) AS v, CAST(sum(depth) AS BIGINT) AS d FROM pile GROUP BY 1, 2),
c AS (SELECT * FROM s WHERE v > 0 AND ((v >= 9 AND v >= 1.15 * d) OR v >= 1.3 * d)),
n AS (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY contig_id ORDER BY pos) <= 13 THEN 0 ELSE 1 END AS n FROM c),
g AS (SELECT *, sum(n) OVER (PARTITION BY contig_id ORDER BY pos) AS g FROM n)
SELECT contig_id, min(pos) AS "begin", max(pos) AS "end", count(*) AS sites FROM g GROUP BY contig_id, g HAVING count(*) >= 2""",
)
def active_regions(spark, d):
    s = _pile(spark, d).groupBy("contig_id", "pos").agg(F.sum(F.col("fwd_alt") + F.col("rev_alt")).alias("variants"), F.sum("depth").alias("depth"))
    return regions.active_regions(s, low=1.15, high=1.3)


@query(
    "window_noise",
    f"""WITH {SQL}, s AS (SELECT contig_id, p AS pos, count(*) FILTER (q < 17) AS f, count(*) FILTER (q >= 17) AS u FROM bases GROUP BY 1, 2),
w AS (SELECT contig_id, pos, floor(avg(f) OVER x) AS f, floor(avg(u) OVER x) AS u FROM s WINDOW x AS (PARTITION BY contig_id ORDER BY pos RANGE BETWEEN 50 PRECEDING AND 50 FOLLOWING))
SELECT contig_id, pos, round(coalesce(f / nullif(f + u, 0), 0), 9) AS noise FROM w""",
)
def window_noise(spark, d):
    b = pileup.base_calls(reads(spark, d)).where("op = 'M'")
    s = b.groupBy("contig_id", "pos").agg(F.count_if(F.col("q") < 17).alias("filtered"), F.count_if(F.col("q") >= 17).alias("used"))
    return somatic.window_noise(s).select("contig_id", "pos", F.round("noise", 9).alias("noise"))


@query(
    "callable_regions",
    f"""WITH {SQL}, s AS (SELECT contig_id, p AS pos, count(*) FILTER (q >= 17) AS u FROM bases GROUP BY 1, 2),
g AS (SELECT contig_id, pos, pos - row_number() OVER (PARTITION BY contig_id ORDER BY pos) AS g FROM s WHERE u >= 15)
SELECT contig_id, min(pos) - 1 AS "begin", max(pos) AS "end" FROM g GROUP BY contig_id, g""",
)
def callable_regions(spark, d):
    b = pileup.base_calls(reads(spark, d)).where("op = 'M'")
    return somatic.callable_regions(b.groupBy("contig_id", "pos").agg(F.count_if(F.col("q") >= 17).alias("used")), 15)


def _fraction_sql(r: float) -> str:
    return f"round(sum(CASE WHEN base = 'A' THEN ln((1 - e) * {r} + e / 3 * {1 - r}) ELSE ln((1 - e) * {1 - r} + e / 3 * {r}) END), 9)"


@query(
    "fraction_likelihoods",
    f"WITH {SQL}, c AS (SELECT contig_id, p AS pos, CASE WHEN read_id // 100000 % 2 = 0 THEN 'normal' ELSE 'tumour' END AS sample, base, pow(10, -q / 10.0) AS e FROM bases WHERE q >= 17) "
    f"SELECT contig_id, pos, sample, count(*) AS n, round({_fraction_sql(0.5)}, 3) AS het, round({_fraction_sql(0.05)}, 3) AS low FROM c GROUP BY 1, 2, 3",
)
def fraction_likelihoods(spark, d):
    b = pileup.base_calls(reads(spark, d)).where("op = 'M' and q >= 17").withColumn("alt", F.lit("A"))
    b = b.withColumn("sample", F.when(F.floor(F.col("read_id") / 100_000) % 2 == 0, "normal").otherwise("tumour"))
    l = somatic.fraction_likelihoods(b, ["contig_id", "pos"])
    at = somatic.FRACTIONS.index
    return l.select("contig_id", "pos", "sample", "n", F.round(F.get("lhood", at(0.5)), 3).alias("het"), F.round(F.get("lhood", at(0.05)), 3).alias("low"))


@query("somatic_sites")
def somatic_sites(spark, d):
    """Scores of every site at which both samples have calls; the posterior is numeric code, tested by itself."""
    b = pileup.base_calls(reads(spark, d)).where("op = 'M' and q >= 17").withColumn("alt", F.lit("A"))
    b = b.withColumn("sample", F.when(F.floor(F.col("read_id") / 100_000) % 2 == 0, "normal").otherwise("tumour"))
    return somatic.score_sites(somatic.pair_samples(somatic.fraction_likelihoods(b, ["contig_id", "pos"]), ["contig_id", "pos"]), ["contig_id", "pos"])


@query(
    "snv_error_counts",
    f"""WITH {SQL}, c AS (SELECT b.contig_id, b.p AS pos, base, q, q < 6 AS f FROM bases b), s AS (SELECT contig_id, pos FROM c GROUP BY 1, 2 HAVING avg(CAST(f AS INT)) < 0.05)
SELECT q, count(*) FILTER (base = ref) AS ref_n, count(*) FILTER (base <> ref) AS alt_n FROM c JOIN s USING (contig_id, pos) JOIN ref USING (contig_id, pos) WHERE NOT f AND q >= 25 GROUP BY q""",
)
def snv_error_counts(spark, d):
    b = pileup.base_calls(reads(spark, d)).where("op = 'M'").withColumn("filtered", F.col("q") < 6)
    return errors.snv_error_counts(b, reference(spark))


@query(
    "homopolymer_runs",
    "WITH r AS (SELECT doc_id AS contig_id, unnest(range(1, length(s) + 1)) AS pos, s FROM (SELECT doc_id, translate(regexp_replace(lower(coalesce(text, '')), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS s FROM documents)), "
    "b AS (SELECT contig_id, pos, substr(s, CAST(pos AS INT), 1) AS base FROM r), g AS (SELECT *, pos - row_number() OVER (PARTITION BY contig_id, base ORDER BY pos) AS g FROM b), "
    "h AS (SELECT contig_id, base, count(*) AS length FROM g GROUP BY contig_id, base, g) SELECT base, length, count(*) AS n FROM h GROUP BY 1, 2",
)
def homopolymer_runs(spark, d):
    from .reads import BASES, LETTERS
    from .registry import table

    s = F.translate(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), "[^a-z]", ""), LETTERS, BASES)
    bases = table(spark, d, "documents").select(F.col("doc_id").alias("contig_id"), F.posexplode(F.split(s, "")).alias("pos", "base")).where("base <> ''")
    return regions.homopolymers(bases).groupBy("base", "length").agg(F.count("*").alias("n"))


@query(
    "gram_seed_join",
    """WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM benchmark),
q AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS gram FROM w WHERE len(w) >= 5),
x AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS gram FROM b WHERE len(w) >= 5),
k AS (SELECT gram FROM x GROUP BY gram HAVING count(*) <= 3)
SELECT doc_id, item_id, count(*) AS shared FROM q JOIN x USING (gram) JOIN k USING (gram) GROUP BY 1, 2""",
)
def gram_seed_join(spark, d):
    from .registry import table

    q = sketch.word_ngrams(table(spark, d, "documents"), "doc_id", "text", 5).withColumnRenamed("id", "doc_id")
    x = sketch.word_ngrams(table(spark, d, "benchmark"), "item_id", "text", 5).withColumnRenamed("id", "item_id")
    return sketch.seed_join(q, x, "gram", 3).groupBy("doc_id", "item_id").agg(F.count("*").alias("shared"))


@query("occurrence_threshold", "WITH w AS (SELECT l_partkey AS k, count(*) AS n FROM lineitem GROUP BY 1) SELECT CAST(quantile_disc(n, 0.98) + 1 AS BIGINT) AS \"limit\" FROM w")
def occurrence_threshold(spark, d):
    from .registry import table

    return sketch.occurrence_threshold(table(spark, d, "lineitem"), 0.02, "l_partkey")


@query("minimizer_sketch")
def minimizer_sketch(spark, d):
    """Minimizers of all derived reads, with the statistics of their index; tested against brute force."""
    return sketch.index_stats(sketch.sketch(reads(spark, d), "read_id", "seq", 15, 10), "hash")


@query("gvcf_blocks")
def gvcf_blocks(spark, d):
    """Blocks of similar sites with tolerance: order-dependent, tested against a sequential form."""
    p = _pile(spark, d)
    s = p.groupBy("contig_id", "segment_id", "pos").agg(F.sum("depth").alias("dp"), F.sum(F.col("fwd_total") + F.col("rev_total") - F.col("depth")).alias("dpf"))
    s = s.withColumns({"gqx": F.lit(None).cast("double"), "filters": F.lit(""), "gt": F.lit("0/0"), "ploidy": F.lit(2), "covered": F.col("dp") + F.col("dpf") > 0, "used_covered": F.col("dp") > 0})
    return gvcf.blocks(s)


@query(
    "session_windows",
    """WITH e AS (SELECT user_id, ts, value, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) < 10800000000 THEN 0 ELSE 1 END AS n FROM events),
s AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM e)
SELECT min(ts) AS start, max(ts) + INTERVAL '3 hours' AS "end", user_id, count(*) AS n, round(sum(value), 4) AS value FROM s GROUP BY user_id, s""",
)
def session_windows(spark, d):
    """The batch form of the streaming sessions."""
    from ..streaming import streams
    from .registry import table

    w = streams.sessions(table(spark, d, "events"), "ts", "3 hours", ["user_id"], [F.count("*").alias("n"), F.sum("value").alias("value")])
    return w.withColumns({"start": F.col("start").cast("timestamp_ntz"), "end": F.col("end").cast("timestamp_ntz"), "value": F.round("value", 4)})


@query("tumbling_windows", "SELECT time_bucket(INTERVAL '1 day', ts) AS start, time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS \"end\", event_type, count(*) AS n FROM events GROUP BY 1, 2, 3")
def tumbling_windows(spark, d):
    from ..streaming import streams
    from .registry import table

    w = streams.tumbling(table(spark, d, "events"), "ts", "1 day", ["event_type"], [F.count("*").alias("n")])
    return w.withColumns({"start": F.col("start").cast("timestamp_ntz"), "end": F.col("end").cast("timestamp_ntz")})
