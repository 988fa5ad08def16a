"""Further operators as queries: on derived reads, line items, orders and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numeric, seq
from ..operators import filters, genotype, indels, merge, ordered, pileup, regions, score, somatic
from ..sources import files
from .reads import SQL, reads, reference
from .registry import query, table

D_DAY = "date_diff('day', DATE '1970-01-01', CAST({} AS DATE))"


@query(
    "cigar_lengths",
    f"WITH {SQL} SELECT doc_id * 100000 + i AS read_id, n AS read_length, CASE kind WHEN 0 THEN 98 WHEN 1 THEN 103 WHEN 2 THEN 90 ELSE n END AS ref_length, CASE kind WHEN 0 THEN 98 WHEN 2 THEN 90 ELSE n END AS matched, CAST(kind IN (0, 1) AS INT) AS indels, CASE kind WHEN 2 THEN 10 ELSE 0 END AS lead_clip, CASE kind WHEN 0 THEN '40M2I58M' WHEN 1 THEN '50M3D50M' WHEN 2 THEN '10S90M' ELSE n || 'M' END AS cigar FROM reads",
)
def cigar_lengths(spark, d):
    c = F.col("cigar")
    return reads(spark, d).select("read_id", seq.read_length(c).alias("read_length"), seq.ref_length(c).alias("ref_length"), seq.matched_length(c).alias("matched"), seq.indel_count(c).alias("indels"), seq.clip_lengths(c)[0].alias("lead_clip"), seq.format_cigar(c).alias("cigar"))


@query("reverse_complement", f"WITH {SQL} SELECT doc_id * 100000 + i AS read_id, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc, length(seq) - length(regexp_replace(seq, '[^GC]', '', 'g')) AS at FROM reads")
def reverse_complement(spark, d):
    return reads(spark, d).select("read_id", seq.revcomp(F.col("seq")).alias("rc"), F.length(F.regexp_replace("seq", "[GC]", "")).alias("at"))


def _shl(x: str, n: int) -> str:
    return f"(({x} & {(1 << (42 - n)) - 1}) << {n})"


_M = (1 << 42) - 1


@query(
    "kmer_hash",
    f"""WITH a AS (SELECT l_orderkey * 7 + l_linenumber AS key FROM lineitem), b AS (SELECT key, (xor(key, {_M}) + {_shl('key', 21)}) & {_M} AS x FROM a),
c AS (SELECT key, xor(x, x >> 24) AS x FROM b), d AS (SELECT key, (x + {_shl('x', 3)} + {_shl('x', 8)}) & {_M} AS x FROM c), e AS (SELECT key, xor(x, x >> 14) AS x FROM d),
f AS (SELECT key, (x + {_shl('x', 2)} + {_shl('x', 4)}) & {_M} AS x FROM e), g AS (SELECT key, xor(x, x >> 28) AS x FROM f) SELECT key, (x + {_shl('x', 31)}) & {_M} AS hash FROM g""",
)
def kmer_hash(spark, d):
    key = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    return table(spark, d, "lineitem").select(key.alias("key"), numeric.hash64(key, 42).alias("hash"))


@query(
    "call_counts",
    f"WITH {SQL} SELECT contig_id, p AS pos, count(*) FILTER (q >= 17 AND mapq >= 20) AS used, count(*) FILTER (q < 17 AND mapq >= 20) AS unused, count(*) FILTER (mapq < 20) AS tier2 FROM bases GROUP BY 1, 2",
)
def call_counts(spark, d):
    b = pileup.base_calls(reads(spark, d)).where("op = 'M'")
    ok, tier = filters.usable_call(F.col("base"), F.col("q")), F.col("mapq") >= 20
    return b.groupBy("contig_id", "pos").agg(F.count_if(ok & tier).alias("used"), F.count_if(~ok & tier).alias("unused"), F.count_if(~tier).alias("tier2"))


@query(
    "alt_ranking",
    f"""WITH {SQL}, c AS (SELECT contig_id, p AS pos, read_id // 100000 % 3 AS sample, base, count(*) AS n FROM bases WHERE q >= 17 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY contig_id, pos, sample ORDER BY n DESC, base) AS r, sum(n) OVER (PARTITION BY contig_id, pos, sample) AS t FROM c),
s AS (SELECT r.contig_id, r.pos, base, CAST(sum(3 - r) AS BIGINT) AS score FROM r JOIN ref ON r.contig_id = ref.contig_id AND r.pos = ref.pos WHERE r <= 2 AND n >= 0.1 * t AND base <> ref GROUP BY ALL)
SELECT contig_id, pos, base, score, row_number() OVER (PARTITION BY contig_id, pos ORDER BY score DESC, base) AS rank FROM s""",
)
def alt_ranking(spark, d):
    b = pileup.base_calls(reads(spark, d)).where("op = 'M' and q >= 17")
    c = b.groupBy("contig_id", "pos", (F.floor(F.col("read_id") / 100_000) % 3).alias("sample"), "base").agg(F.count("*").alias("n"))
    return genotype.alt_ranking(c.join(reference(spark).withColumnRenamed("base", "ref"), ["contig_id", "pos"]), ["contig_id", "pos"])


@query("noise_sites", f"WITH {SQL}, s AS (SELECT b.contig_id, b.p AS pos, count(*) FILTER (base = ref) AS r, count(*) FILTER (base <> ref) AS a FROM bases b JOIN ref ON ref.contig_id = b.contig_id AND ref.pos = b.p GROUP BY ALL) SELECT contig_id, pos, r + a AS dp, a AS alt FROM s WHERE r + a >= 12 AND a / (r + a) <= 0.6")
def noise_sites(spark, d):
    j = pileup.base_calls(reads(spark, d)).where("op = 'M'").join(reference(spark).withColumnRenamed("base", "ref"), ["contig_id", "pos"])
    same = F.col("base") == F.col("ref")
    s = j.groupBy("contig_id", "pos").agg(F.count_if(same).alias("ref_n"), F.count_if(~same).alias("alt_n"))
    return somatic.noise_sites(s, 12, 0.6).select("contig_id", "pos", "dp", F.get("ad", 1).alias("alt"))


@query(
    "insert_consensus",
    f"WITH {SQL}, o AS (SELECT contig_id, pos // 50 AS pos, substr(seq, 41, 2) AS ins_seq, count(*) AS reads FROM reads WHERE kind = 0 GROUP BY ALL) SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY contig_id, pos ORDER BY reads DESC, ins_seq) = 1".replace("pos // 50 AS pos", "(pos + 40) // 50 AS pos"),
)
def insert_consensus(spark, d):
    o = indels.observations(reads(spark, d)).where("kind = 'insertion'").withColumn("pos", F.floor(F.col("pos") / 50))
    return indels.mode_insert(o)


@query("edge_distance", f"WITH {SQL} SELECT contig_id, count(*) AS n, count(*) FILTER (o BETWEEN 10 AND 89) AS inside FROM bases GROUP BY 1")
def edge_distance(spark, d):
    b = pileup.base_calls(reads(spark, d)).where("op = 'M'")
    return b.groupBy("contig_id").agg(F.count("*").alias("n"), F.count_if(filters.away_from_edges(F.col("off"), F.lit(100), 10)).alias("inside"))


@query(
    "sam_lines",
    f"WITH {SQL}, q AS (SELECT doc_id, i, string_agg(chr(CAST(33 + 2 + (ascii(substr(seq, CAST(o + 1 AS INT), 1)) * 7 + o + 1 + doc_id) % 39 AS INT)), '' ORDER BY o) AS qual FROM offs GROUP BY 1, 2) "
    "SELECT concat_ws(chr(9), 'r' || (doc_id * 100000 + i), CASE WHEN rev THEN 16 ELSE 0 END, 'c' || contig_id, pos, mapq, CASE kind WHEN 0 THEN '40M2I58M' WHEN 1 THEN '50M3D50M' WHEN 2 THEN '10S90M' ELSE n || 'M' END, '*', 0, 0, seq, qual) AS line FROM reads JOIN q USING (doc_id, i)",
)
def sam_lines(spark, d):
    r = reads(spark, d).withColumns({"name": F.concat(F.lit("r"), F.col("read_id").cast("string")), "chrom": F.concat(F.lit("c"), F.col("contig_id").cast("string"))})
    return files.sam_lines(r)


_GROUPS = f"""o AS (SELECT o_orderkey, o_custkey AS k, {D_DAY.format('o_orderdate')} AS b, {D_DAY.format('o_orderdate')} + 4 AS e FROM orders),
m AS (SELECT *, max(e) OVER (PARTITION BY k ORDER BY b, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM o)"""


@query("overlap_groups", f"WITH {_GROUPS}, g AS (SELECT o_orderkey, k, b, e, CAST(sum(CASE WHEN seen IS NULL OR b > seen THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY b, e ROWS UNBOUNDED PRECEDING) AS BIGINT) AS g FROM m) SELECT k, g AS \"group\", count(*) AS n, min(b) AS \"begin\", max(e) AS \"end\" FROM g GROUP BY 1, 2")
def overlap_groups(spark, d):
    o = table(spark, d, "orders").withColumn("begin", F.datediff("o_orderdate", F.lit("1970-01-01")).cast("long")).select(F.col("o_custkey").alias("k"), "begin", (F.col("begin") + 4).alias("end"))
    return indels.overlap_groups(o, "k").groupBy("k", "group").agg(F.count("*").alias("n"), F.min("begin").alias("begin"), F.max("end").alias("end"))


@query("haplotype_counts", "WITH c AS (SELECT user_id AS region, event_type AS hap, count(DISTINCT event_id) AS reads FROM events GROUP BY 1, 2 HAVING count(DISTINCT event_id) >= 3) SELECT region, hap, reads, row_number() OVER (PARTITION BY region ORDER BY reads DESC, hap) AS rank FROM c QUALIFY rank <= 2")
def haplotype_counts(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("region"), F.col("event_id").alias("read_id"), F.col("event_type").alias("hap"))
    return regions.haplotypes(e)


@query(
    "phasing",
    """WITH l AS (SELECT l_suppkey % 3 AS sample, l_orderkey AS region, l_linenumber AS pos, l_partkey AS k, CASE WHEN l_partkey % 4 = 0 THEN '0|1' WHEN l_partkey % 4 = 1 THEN '1|0' WHEN l_partkey % 4 = 2 THEN '1|1' ELSE '1|2' END AS gt FROM lineitem),
h AS (SELECT *, split_part(gt, '|', 1) <> split_part(gt, '|', 2) AS het FROM l),
w AS (SELECT *, count(*) FILTER (het) OVER p AS n, min(pos::BIGINT * 1000 + CASE gt WHEN '0|1' THEN 1 WHEN '1|0' THEN 2 WHEN '1|2' THEN 4 END) FILTER (het) OVER p AS f FROM h WINDOW p AS (PARTITION BY sample, region))
SELECT sample, region, pos, k, CASE WHEN n >= 2 AND het THEN f // 1000 END AS phase_set, CASE WHEN n >= 2 AND het THEN CASE WHEN f % 1000 = 2 THEN split_part(gt, '|', 2) || '|' || split_part(gt, '|', 1) ELSE gt END ELSE replace(gt, '|', '/') END AS phased FROM w""",
)
def phasing(spark, d):
    m = F.col("l_partkey") % 4
    l = table(spark, d, "lineitem").select((F.col("l_suppkey") % 3).alias("sample"), F.col("l_orderkey").alias("region"), F.col("l_linenumber").cast("long").alias("pos"), F.col("l_partkey").alias("k"), F.when(m == 0, "0|1").when(m == 1, "1|0").when(m == 2, "1|1").otherwise("1|2").alias("gt"))
    return regions.phase(l).select("sample", "region", F.col("pos").cast("int").alias("pos"), "k", "phase_set", "phased")


@query(
    "forest_scores",
    """WITH f AS (SELECT l_orderkey, l_linenumber, (CASE WHEN l_quantity <= 25 THEN CASE WHEN l_discount <= 0.05 THEN 0.25 ELSE 0.5 END ELSE 0.75 END + CASE WHEN l_tax <= 0.04 THEN 0.125 ELSE 0.5 END) / 2 AS p FROM lineitem)
SELECT l_orderkey, l_linenumber, least(60, CAST(floor(-10 * log10(p) + 0.5) AS BIGINT)) AS evs FROM f""",
)
def forest_scores(spark, d):
    trees = [[(1, 4, 0, 25.0, 0.0), (2, 3, 1, 0.05, 0.0), (-1, -1, -1, 0.0, 0.25), (-1, -1, -1, 0.0, 0.5), (-1, -1, -1, 0.0, 0.75)], [(1, 2, 2, 0.04, 0.0), (-1, -1, -1, 0.0, 0.125), (-1, -1, -1, 0.0, 0.5)]]
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.array("l_quantity", "l_discount", "l_tax").alias("features"))
    return score.forest_score(rows, trees).select("l_orderkey", "l_linenumber", "evs")


@query(
    "indel_genotypes",
    """WITH s AS (SELECT l_suppkey AS site, -l_discount * 40 - 0.01 AS r, -l_tax * 60 - 0.01 AS a FROM lineitem),
g AS (SELECT site, count(*) AS reads, round(sum(r), 6) AS hom_ref, round(sum(greatest(r, a) + ln(0.5) + ln(1 + exp(-abs(r - a)))), 6) AS het, round(sum(a), 6) AS hom_alt FROM s GROUP BY site)
SELECT site, reads, CASE WHEN w0 >= w1 AND w0 >= w2 THEN '0/0' WHEN w1 >= w2 THEN '0/1' ELSE '1/1' END AS gt FROM (SELECT *, hom_ref + ln(1 - 1.5e-4) AS w0, het + ln(1e-4) AS w1, hom_alt + ln(5e-5) AS w2 FROM g)""",
)
def indel_genotypes(spark, d):
    s = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("site"), (-F.col("l_discount") * 40 - 0.01).alias("lnp_ref"), (-F.col("l_tax") * 60 - 0.01).alias("lnp_indel"))
    return indels.genotype(s, ["site"]).select("site", "reads", "gt")


@query(
    "top_alleles",
    """WITH l AS (SELECT o_custkey % 50 AS site, o_orderkey AS read_id, CAST(x AS INT) AS allele, -((o_orderkey * (x + 1) * 13) % 17) / 3.0 AS lnp FROM orders, range(3) r(x)),
p AS (SELECT site, allele, exp(lnp - max(lnp) OVER w) AS e, sum(exp(lnp)) OVER w AS t, max(lnp) OVER w AS m FROM l WINDOW w AS (PARTITION BY site, read_id)),
s AS (SELECT site, allele, round(sum(e / (t / exp(m))), 6) AS support FROM p GROUP BY 1, 2)
SELECT site, allele, support, row_number() OVER (PARTITION BY site ORDER BY support DESC, allele) AS rank FROM s QUALIFY rank <= 2""",
)
def top_alleles(spark, d):
    o = table(spark, d, "orders").select((F.col("o_custkey") % 50).alias("site"), F.col("o_orderkey").alias("read_id"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("allele"))
    s = o.withColumn("lnp", -((F.col("read_id") * (F.col("allele") + 1) * 13) % 17) / 3.0)
    return indels.top_alleles(s, ["site"], "allele").withColumn("support", F.round("support", 6))


@query("germline_filters", "WITH f AS (SELECT l_orderkey, l_linenumber, list_filter([CASE WHEN l_quantity < CASE WHEN l_returnflag = 'R' THEN 15 ELSE 5 END THEN 'LowGQX' END, CASE WHEN l_partkey % 50 > 3 * 15 THEN 'HighDepth' END, CASE WHEN (l_suppkey % 20) / nullif(l_partkey % 50 + l_suppkey % 20, 0) > 0.4 THEN 'HighDPFRatio' END, CASE WHEN l_discount * 200 > 10 THEN 'HighSNVSB' END, CASE WHEN l_partkey % 50 + l_suppkey % 20 < 3 THEN 'LowDepth' END], lambda x: x IS NOT NULL) AS f FROM lineitem) SELECT l_orderkey, l_linenumber, CASE WHEN len(f) = 0 THEN 'PASS' ELSE array_to_string(f, ';') END AS filter FROM f")
def germline_filters(spark, d):
    c = F.col
    f = filters.germline_filters(c("l_returnflag") == "R", c("l_quantity"), c("l_partkey") % 50, (c("l_suppkey") % 20).cast("long"), F.lit(15), c("l_discount") * 200, F.lit(False), min_gqx=15, min_homref_gqx=5)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", filters.filter_text(f).alias("filter"))


@query("somatic_filters", "WITH f AS (SELECT l_orderkey, l_linenumber, list_filter([CASE WHEN l_suppkey % 80 > 60 THEN 'HighDepth' END, CASE WHEN l_discount * 8 >= 0.4 THEN 'BCNoise' END, CASE WHEN l_tax * 10 > 0.75 THEN 'SpanDel' END, CASE WHEN l_returnflag <> 'R' OR l_quantity < 15 THEN 'QSS_ref' END, CASE WHEN l_partkey % 30 < 2 THEN 'LowDepth' END], lambda x: x IS NOT NULL) AS f FROM lineitem) SELECT l_orderkey, l_linenumber, CASE WHEN len(f) = 0 THEN 'PASS' ELSE array_to_string(f, ';') END AS filter FROM f")
def somatic_filters(spark, d):
    c = F.col
    f = filters.somatic_snv_filters(c("l_partkey") % 30, c("l_suppkey") % 80, F.lit(20), c("l_discount") * 8, c("l_tax") * 10, c("l_quantity"), F.when(c("l_returnflag") == "R", "ref").otherwise("het"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", filters.filter_text(f).alias("filter"))


@query("contig_bins", "WITH c AS (SELECT p_partkey, p_size, coalesce(sum(p_size) OVER (ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM part) SELECT p_partkey AS contig_id, CAST(b // 500 AS INT) AS bin FROM c")
def contig_bins(spark, d):
    c = table(spark, d, "part").select(F.col("p_partkey").alias("contig_id"), F.col("p_size").cast("long").alias("length"))
    return merge.group_small(c, 500).select("contig_id", "bin")


@query("call_order", "SELECT o_orderkey, row_number() OVER (ORDER BY CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'F' THEN 1 ELSE 2 END, o_orderkey) AS place FROM orders")
def call_order(spark, d):
    from pyspark.sql import Window

    contigs = spark.createDataFrame([(0, "P"), (1, "F"), (2, "O")], "contig_id int, name string")
    calls = table(spark, d, "orders").select(F.col("o_orderstatus").alias("chrom"), F.col("o_orderkey").alias("pos"), "o_orderkey")
    done = merge.call_order(calls, contigs).join(F.broadcast(contigs.withColumnRenamed("name", "chrom")), "chrom")
    return done.select("o_orderkey", F.row_number().over(Window.orderBy("contig_id", "pos")).alias("place"))


@query("contig_check", "SELECT o_orderstatus AS name, count(*) AS length, 1 AS only_in FROM orders GROUP BY 1 EXCEPT ALL SELECT l_linestatus, count(DISTINCT l_orderkey), 1 FROM lineitem GROUP BY 1 UNION ALL (SELECT l_linestatus, count(DISTINCT l_orderkey), 2 FROM lineitem GROUP BY 1 EXCEPT ALL SELECT o_orderstatus, count(*), 2 FROM orders GROUP BY 1)")
def contig_check(spark, d):
    a = table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("name")).agg(F.count("*").alias("length"))
    b = table(spark, d, "lineitem").groupBy(F.col("l_linestatus").alias("name")).agg(F.count_distinct("l_orderkey").alias("length"))
    return merge.check_contigs(a, b)


@query("merged_counts", "SELECT k, sum(n) AS n FROM (SELECT o_orderstatus AS k, count(*) AS n FROM orders GROUP BY 1 UNION ALL SELECT l_linestatus, count(*) FROM lineitem GROUP BY 1) GROUP BY k")
def merged_counts(spark, d):
    a = table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("k")).agg(F.count("*").alias("n"))
    b = table(spark, d, "lineitem").groupBy(F.col("l_linestatus").alias("k")).agg(F.count("*").alias("n"))
    return files.merge_counts([a, b], ["k"], ["n"])


@query("depth_cap")
def depth_cap(spark, d):
    """Reads kept under a depth cap: by order of arrival, tested on small input."""
    return filters.cap_depth(reads(spark, d), 20).select("read_id", "contig_id", "pos")


@query("continuous_calls")
def continuous_calls(spark, d):
    """Alleles of a pool with their quality and strand bias."""
    b = pileup.base_calls(reads(spark, d)).where("op = 'M' and q >= 17 and base in ('A', 'C', 'G', 'T')")
    c = b.groupBy("contig_id", "pos", "base").agg(F.count("*").alias("n"), F.count_if(~F.col("reverse")).alias("fwd"), F.count_if("reverse").alias("rev"))
    t = b.groupBy("contig_id", "pos").agg(F.count("*").alias("total"), F.count_if(~F.col("reverse")).alias("fwd_total"), F.count_if("reverse").alias("rev_total"))
    return genotype.continuous_sites(c.join(t, ["contig_id", "pos"]), ["contig_id", "pos"])


@query("candidate_indels")
def candidate_indels(spark, d):
    """Indels too frequent for errors, by the exact binomial tail."""
    r = reads(spark, d)
    depth = pileup.base_calls(r).groupBy("contig_id", "pos").agg(F.count("*").alias("depth"))
    return indels.candidates(indels.support(indels.observations(r)), depth)


@query("sliding_windows", "WITH w AS (SELECT time_bucket(INTERVAL '6 hours', ts) - to_hours(6 * k::INT) AS s, event_type FROM events, range(2) r(k)) SELECT s AS start, s + INTERVAL '12 hours' AS \"end\", event_type, count(*) AS n FROM w GROUP BY ALL")
def sliding_windows(spark, d):
    from ..streaming import streams

    w = streams.sliding(table(spark, d, "events"), "ts", "12 hours", "6 hours", ["event_type"], [F.count("*").alias("n")])
    return w.withColumns({"start": F.col("start").cast("timestamp_ntz"), "end": F.col("end").cast("timestamp_ntz")})


@query("compressed_depth", f"WITH {SQL}, d AS (SELECT contig_id, p, count(*) AS n FROM bases GROUP BY 1, 2) SELECT CASE WHEN n < 8 THEN n ELSE n // CAST(pow(2, length(bin(n)) - 3) AS BIGINT) * CAST(pow(2, length(bin(n)) - 3) AS BIGINT) + CAST(pow(2, length(bin(n)) - 3) AS BIGINT) // 2 END AS value, count(*) AS n FROM d GROUP BY 1")
def compressed_depth(spark, d):
    depth = pileup.base_calls(reads(spark, d)).where("op = 'M'").groupBy("contig_id", "pos").agg(F.count("*").alias("depth"))
    return ordered.compressed_histogram(depth, "depth", 3)


_PART_BASES = "translate(regexp_replace(upper(p_name), '[^A-Z]', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'ACGTNACGTNACGTNACGTNACGTNN')"


def _part_bases():
    return F.translate(F.regexp_replace(F.upper("p_name"), "[^A-Z]", ""), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ACGTNACGTNACGTNACGTNACGTNN")


@query(
    "base_codes",
    f"WITH s AS (SELECT p_partkey, {_PART_BASES} AS s FROM part) SELECT p_partkey, s, instr('ACGT', substr(s, 1, 1)) AS first_place, length(regexp_replace(s, 'N+$', '')) AS forward_left, length(regexp_replace(s, '^N+', '')) AS reverse_left FROM s",
)
def base_codes(spark, d):
    """Places of bases, and what trimming trailing N leaves of either strand."""
    s = table(spark, d, "part").select("p_partkey", _part_bases().alias("s"))
    first = seq.base_id(F.substring("s", 1, 1), "ACGT")
    return s.select("p_partkey", "s", F.when(first == 4, 0).otherwise(first + 1).cast("long").alias("first_place"), seq.rtrim_n(F.col("s"), F.lit(False)).cast("long").alias("forward_left"), seq.rtrim_n(F.col("s"), F.lit(True)).cast("long").alias("reverse_left"))


@query(
    "packed_bases",
    f"SELECT p_partkey, {_PART_BASES} AS bases FROM part",
)
def packed_bases(spark, d):
    """Bases packed two to a byte and back: a round trip."""
    s = table(spark, d, "part").select("p_partkey", _part_bases().alias("s"))
    return s.select("p_partkey", seq.unpack_nibbles(seq.pack_nibbles(F.col("s")), F.length("s")).alias("bases"))


@query(
    "names_and_ids",
    "SELECT c_custkey, regexp_replace(c_name || '/' || CAST(c_custkey % 3 AS VARCHAR), '/[0-9]$', '') AS pair, regexp_replace(c_name || ' & ' || c_mktsegment, '[^A-Za-z0-9_-]', '_', 'g') AS id FROM customer",
)
def names_and_ids(spark, d):
    """Mates' common names, and texts made safe as identifiers."""
    c = table(spark, d, "customer")
    return c.select("c_custkey", seq.read_pair_name(F.concat("c_name", F.lit("/"), (F.col("c_custkey") % 3).cast("string"))).alias("pair"), seq.safe_id(F.concat("c_name", F.lit(" & "), "c_mktsegment")).alias("id"))


_ALT = "CASE l_linenumber % 5 WHEN 0 THEN '.' WHEN 1 THEN 'C' WHEN 2 THEN 'AC' WHEN 3 THEN '<DEL>' ELSE 'GT' END"


@query(
    "variant_classes",
    f"""WITH v AS (SELECT l_orderkey, l_linenumber, CASE l_suppkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'C' ELSE 'AC' END AS ref, {_ALT} AS alt FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN alt = '.' OR alt = ref THEN 'ref' WHEN alt = '<DEL>' THEN 'other' WHEN length(ref) = 1 AND length(alt) = 1 THEN 'snv' WHEN length(ref) <> length(alt) THEN 'indel' ELSE 'other' END AS class FROM v""",
)
def variant_classes(spark, d):
    n = F.col("l_linenumber") % 5
    alt = F.when(n == 0, ".").when(n == 1, "C").when(n == 2, "AC").when(n == 3, "<DEL>").otherwise("GT")
    ref = F.when(F.col("l_suppkey") % 3 == 0, "A").when(F.col("l_suppkey") % 3 == 1, "C").otherwise("AC")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", seq.variant_class(ref, alt).alias("class"))


@query(
    "shares_and_middles",
    """SELECT o_orderkey, round(coalesce(o_totalprice / nullif(o_custkey % 4, 0), 0), 6) AS share, round(least(1.0, greatest(0.0, (o_totalprice - 50000) / 200000)), 9) AS scaled,
  list_sort([o_orderkey % 7, o_custkey % 11, o_orderkey % 5, o_custkey % 3])[3] AS middle FROM orders""",
)
def shares_and_middles(spark, d):
    """Safe ratios, values scaled into 0 to 1, upper medians."""
    c = F.col
    xs = F.array(c("o_orderkey") % 7, c("o_custkey") % 11, c("o_orderkey") % 5, c("o_custkey") % 3)
    return table(spark, d, "orders").select("o_orderkey", F.round(numeric.safe_frac(c("o_totalprice"), c("o_custkey") % 4), 6).alias("share"), F.round(numeric.scale_clamp(c("o_totalprice"), 50000.0, 250000.0), 9).alias("scaled"), numeric.median_upper(xs).alias("middle"))


@query(
    "region_strings",
    "SELECT s_suppkey, 'c' || s_nationkey AS chrom, CASE WHEN s_suppkey % 3 > 0 THEN s_suppkey * 1000 END AS \"begin\", CASE WHEN s_suppkey % 3 = 2 THEN s_suppkey * 2000 END AS \"end\" FROM supplier",
)
def region_strings(spark, d):
    """Regions written with commas, with and without begin and end, and parsed."""
    k = F.col("s_suppkey")
    text = F.concat(F.lit("c"), F.col("s_nationkey").cast("string"), F.when(k % 3 > 0, F.concat(F.lit(":"), F.format_number(k * 1000, 0))).otherwise(""), F.when(k % 3 == 2, F.concat(F.lit("-"), F.format_number(k * 2000, 0))).otherwise(""))
    return table(spark, d, "supplier").select("s_suppkey", seq.parse_region(text).alias("r")).select("s_suppkey", "r.chrom", "r.begin", "r.end")
