"""Aligned reads and a reference, derived from the texts of ``documents`` by rule: the same in Spark and in SQL.

A text's letters, lower-cased, become bases; each run of 100 of them is a read (the last of a text may be shorter). Place,
strand, mapping quality and alignment follow from the document's number and the run's: one read in ten has an
insertion, one a deletion, one a clipped start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import table

LETTERS, BASES = "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC"
LENGTH, CONTIGS, SIZE, SEGMENT = 100, 4, 20_000, 5_000


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(read_id, contig_id, segment_id, pos, flag, mapq, cigar, seq, quals, src_rank, src_ord) over all texts."""
    letters = F.translate(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), "[^a-z]", ""), LETTERS, BASES)
    runs = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.regexp_extract_all(letters, F.lit(f".{{1,{LENGTH}}}"), 0)).alias("i", "seq"))
    # a file of one row group is one task's, however many runs its texts have
    cores = spark.sparkContext.defaultParallelism
    if runs.rdd.getNumPartitions() < 2 * cores:
        runs = runs.repartition(2 * cores, "doc_id", "i")
    h = F.col("doc_id") * 1009 + F.col("i") * 31
    r = runs.select("doc_id", "i", "seq", h.alias("h"), F.length("seq").alias("n"))
    c = F.col
    op = lambda n, o: F.struct(F.lit(o).alias("op"), (F.lit(n) if isinstance(n, int) else n).cast("int").alias("len"))
    whole = c("n") == LENGTH
    cigar = (
        F.when(whole & (c("h") % 10 == 0), F.array(op(40, "M"), op(2, "I"), op(58, "M")))
        .when(whole & (c("h") % 10 == 1), F.array(op(50, "M"), op(3, "D"), op(50, "M")))
        .when(whole & (c("h") % 10 == 2), F.array(op(10, "S"), op(90, "M")))
        .otherwise(F.array(op(c("n"), "M")))
    )
    quals = F.transform(F.split("seq", ""), lambda b, k: (2 + (F.ascii(b) * 7 + k + 1 + c("doc_id")) % 39).cast("tinyint"))
    pos = (1 + (c("h") * 37) % SIZE).cast("int")
    return r.select(
        (c("doc_id") * 100_000 + c("i")).alias("read_id"),
        (c("h") % CONTIGS).cast("int").alias("contig_id"),
        F.floor((pos - 1) / SEGMENT).cast("int").alias("segment_id"),
        pos.alias("pos"),
        F.when(F.floor(c("h") / 4) % 2 == 1, 16).otherwise(0).alias("flag"),
        ((c("h") * 13) % 61).cast("int").alias("mapq"),
        cigar.alias("cigar"),
        "seq",
        quals.alias("quals"),
        F.lit(0).alias("src_rank"),
        c("i").cast("long").alias("src_ord"),
    )


def reference(spark: SparkSession) -> DataFrame:
    """(contig_id, pos, base): a fixed rule over all positions that reads can reach."""
    last = SIZE + LENGTH + 10
    at = spark.range(CONTIGS * last).select((F.col("id") % CONTIGS).cast("int").alias("contig_id"), (F.floor(F.col("id") / CONTIGS) + 1).cast("int").alias("pos"))
    return at.select("contig_id", "pos", F.substr(F.lit("ACGT"), (1 + (F.col("pos") * 7 + F.col("contig_id") * 3) % 4).cast("int"), F.lit(1)).alias("base"))


#: The same in DuckDB: ``reads``, then ``bases`` with a row for each aligned base, ``dels`` for each deleted position.
SQL = f"""
runs AS (
  SELECT doc_id, unnest(range(len(r))) AS i, unnest(r) AS seq
  FROM (SELECT doc_id, regexp_extract_all(translate(regexp_replace(lower(coalesce(text, '')), '[^a-z]', '', 'g'), '{LETTERS}', '{BASES}'), '.{{1,{LENGTH}}}') AS r FROM documents)
), reads AS (
  SELECT *, CASE WHEN n = {LENGTH} AND h % 10 < 3 THEN h % 10 ELSE 9 END AS kind, h % {CONTIGS} AS contig_id, 1 + (h * 37) % {SIZE} AS pos, ((h // 4) % 2) = 1 AS rev, (h * 13) % 61 AS mapq
  FROM (SELECT doc_id, i, seq, doc_id * 1009 + i * 31 AS h, length(seq) AS n FROM runs)
), offs AS (
  SELECT *, unnest(range(n)) AS o FROM reads
), bases AS (
  SELECT doc_id * 100000 + i AS read_id, contig_id, (pos - 1) // {SEGMENT} AS segment_id, o, rev, mapq, kind = 9 AS ungapped,
    substr(seq, CAST(o + 1 AS INT), 1) AS base, 2 + (ascii(substr(seq, CAST(o + 1 AS INT), 1)) * 7 + o + 1 + doc_id) % 39 AS q,
    pos + CASE kind WHEN 0 THEN CASE WHEN o < 40 THEN o ELSE o - 2 END WHEN 1 THEN CASE WHEN o < 50 THEN o ELSE o + 3 END WHEN 2 THEN o - 10 ELSE o END AS p
  FROM offs WHERE NOT (kind = 0 AND o IN (40, 41)) AND NOT (kind = 2 AND o < 10)
), dels AS (
  SELECT contig_id, (pos - 1) // {SEGMENT} AS segment_id, pos + 50 + unnest([0, 1, 2]) AS p, mapq FROM reads WHERE kind = 1
), ins AS (
  SELECT DISTINCT contig_id, CASE kind WHEN 0 THEN pos + 40 ELSE pos + 50 END AS pos FROM reads WHERE kind IN (0, 1)
), ref AS (
  SELECT c AS contig_id, p AS pos, substr('ACGT', CAST(1 + (p * 7 + c * 3) % 4 AS INT), 1) AS ref FROM range({CONTIGS}) t(c), range(1, {SIZE + LENGTH + 11}) u(p)
), pile AS (
  SELECT b.contig_id, segment_id, p AS pos, ref,
    count(*) FILTER (base = 'A' AND ok) AS c_a, count(*) FILTER (base = 'C' AND ok) AS c_c, count(*) FILTER (base = 'T' AND ok) AS c_t, count(*) FILTER (base = 'G' AND ok) AS c_g,
    count(*) FILTER (CASE WHEN base IS NULL THEN mapq > 0 ELSE ok END) AS depth,
    count(*) FILTER (NOT rev AND base <> ref) AS fwd_alt, count(*) FILTER (NOT rev AND base IS NOT NULL) AS fwd_total, count(*) FILTER (rev AND base <> ref) AS rev_alt, count(*) FILTER (rev AND base IS NOT NULL) AS rev_total,
    CAST(coalesce(sum(mapq) FILTER (base <> ref), 0) AS BIGINT) AS mapq_sum, CAST(coalesce(sum(q) FILTER (base <> ref), 0) AS BIGINT) AS bq_alt_sum
  FROM (SELECT contig_id, segment_id, p, base, q, mapq, rev, mapq > 0 AND q > 0 AS ok FROM bases UNION ALL SELECT contig_id, segment_id, p, NULL, NULL, mapq, NULL, false FROM dels) b
  JOIN ref ON ref.contig_id = b.contig_id AND ref.pos = b.p
  GROUP BY ALL
), alts AS (
  SELECT *, CASE ref
    WHEN 'A' THEN CASE WHEN c_t > greatest(c_c, c_g) THEN 'T' WHEN c_c > c_g THEN 'C' ELSE 'G' END
    WHEN 'C' THEN CASE WHEN c_t > greatest(c_a, c_g) THEN 'T' WHEN c_a > c_g THEN 'A' ELSE 'G' END
    WHEN 'T' THEN CASE WHEN c_g > greatest(c_a, c_c) THEN 'G' WHEN c_a > c_c THEN 'A' ELSE 'C' END
    ELSE CASE WHEN c_t > greatest(c_a, c_c) THEN 'T' WHEN c_a > c_c THEN 'A' ELSE 'C' END END AS alt
  FROM pile
), shares AS (
  SELECT *, CASE alt WHEN 'A' THEN c_a WHEN 'C' THEN c_c WHEN 'T' THEN c_t ELSE c_g END AS alt_n, CASE ref WHEN 'A' THEN c_a WHEN 'C' THEN c_c WHEN 'T' THEN c_t ELSE c_g END AS ref_n FROM alts
), verdicts AS (
  SELECT *, 100.0 * alt_n / nullif(depth, 0) AS aaf, least(fwd_alt, rev_alt) AS lo, greatest(fwd_alt, rev_alt) AS hi, fwd_total = 0 OR rev_total = 0 AS one_sided,
    mapq_sum // nullif(depth - ref_n, 0) AS avg_mapq, bq_alt_sum // nullif(fwd_alt + rev_alt, 0) AS avg_bq
  FROM shares
), judged AS (
  SELECT *, coalesce(aaf > 20 AND alt_n > 1 AND depth > 1 AND avg_mapq >= 20 AND NOT 10 * lo > hi AND NOT one_sided, false) AS is_complex,
    coalesce(aaf > 20 AND alt_n > 1 AND depth > 1 AND avg_mapq >= 20 AND (10 * lo > hi OR (lo = 0 AND one_sided)) AND avg_bq >= 10, false) AS is_call
  FROM verdicts
)"""
