"""Readers and writers of text formats, as DataFrames over Spark's own file sources: any store that Spark reads will do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import seq


def read_fai(spark: SparkSession, path: str) -> DataFrame:
    """(contig_id, name, length, ref_start): a reference's index; contigs are numbered in the file's order."""
    rows = spark.read.csv(path, sep="\t", schema="name string, length long, offset long, line_bases int, line_width int")
    from pyspark.sql import Window

    w = Window.orderBy("offset")  # one row for each contig
    return rows.select((F.row_number().over(w) - 1).alias("contig_id"), "name", "length", F.coalesce(F.sum("length").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ref_start"))


def read_fasta(spark: SparkSession, path: str, mask: bool = False) -> DataFrame:
    """(name, seq): records split by Spark at ``>``, so that a file of many contigs is read in parts; upper case."""
    rows = spark.read.option("lineSep", ">").text(path).where(F.trim("value") != "")
    head = F.regexp_extract("value", r"^([^\s]*)", 1)
    body = F.upper(F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s", ""))
    return rows.select(head.alias("name"), (seq.mask_ambiguous(body) if mask else body).alias("seq"))


def reference_chunks(fasta: DataFrame, contigs: DataFrame, size: int = 10_000) -> DataFrame:
    """(contig_id, chunk_start, seq), starts counted from 0."""
    ids = F.broadcast(contigs.select("name", "contig_id"))  # one row for each contig
    parts = F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{size}}}"), 0)
    return fasta.join(ids, "name").select("contig_id", F.posexplode(parts).alias("i", "seq")).select("contig_id", (F.col("i") * size).alias("chunk_start"), "seq")


def reference_bases(chunks: DataFrame) -> DataFrame:
    """(contig_id, pos, base), positions counted from 1."""
    return chunks.select("contig_id", "chunk_start", F.posexplode(F.split("seq", "")).alias("i", "base")).select("contig_id", (F.col("chunk_start") + F.col("i") + 1).alias("pos"), "base")


def region_sequence(chunks: DataFrame, contig_id: int, begin: int, end: int, border: int = 0) -> Column | DataFrame:
    """(seq) of [begin - border, end + border), counted from 0; ambiguous codes as N."""
    lo, hi = max(0, begin - border), end + border
    here = chunks.where((F.col("contig_id") == contig_id) & (F.col("chunk_start") < hi) & (F.col("chunk_start") + F.length("seq") > lo))
    part = F.substr("seq", F.greatest(F.lit(lo) - F.col("chunk_start"), F.lit(0)) + 1, F.least(F.col("chunk_start") + F.length("seq"), F.lit(hi)) - F.greatest(F.col("chunk_start"), F.lit(lo)))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_start", part.alias("s")))), lambda x: x["s"]), "")
    return here.agg(seq.mask_ambiguous(joined).alias("seq"))


def count_bases(fasta: DataFrame) -> DataFrame:
    """(name, known, total)."""
    return fasta.select("name", F.length(F.regexp_replace("seq", "[^ACGTacgt]", "")).alias("known"), F.length("seq").alias("total"))


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, begin, end, name): comments, headers and records that end before they begin are left out."""
    rows = spark.read.csv(path, sep="\t", comment="#", schema="chrom string, begin long, end long, name string", mode="DROPMALFORMED")
    return rows.where("begin is not null and end is not null and begin <= end")


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, pos, id, ref, alt array, qual, filter array, info, format, samples array); ``.`` is null."""
    f = F.split("value", "\t")
    dot = lambda i: F.nullif(F.get(f, i), F.lit("."))
    lines = spark.read.text(path).where(~F.col("value").startswith("#") & (F.col("value") != ""))
    return lines.select(
        F.get(f, 0).alias("chrom"),
        F.get(f, 1).cast("long").alias("pos"),
        dot(2).alias("id"),
        F.get(f, 3).alias("ref"),
        F.split(F.get(f, 4), ",").alias("alt"),
        dot(5).try_cast("double").alias("qual"),
        F.when(F.get(f, 6) == "PASS", F.expr("cast(array() as array<string>)")).otherwise(F.split(dot(6), ";")).alias("filter"),
        dot(7).alias("info"),
        dot(8).alias("format"),
        F.when(F.size(f) > 9, F.slice(f, 10, F.greatest(F.size(f) - 9, F.lit(1)))).otherwise(F.expr("cast(array() as array<string>)")).alias("samples"),
    )


def vcf_header(spark: SparkSession, path: str) -> DataFrame:
    """(value): header lines, the first file's of each."""
    return spark.read.text(path).where(F.col("value").startswith("#")).dropDuplicates()


def check_reference(calls: DataFrame, bases: DataFrame, contigs: DataFrame) -> DataFrame:
    """Calls (chrom, pos, ref) with ``ref_ok``: whether REF's first base is the reference's."""
    named = bases.join(F.broadcast(contigs.select("contig_id", F.col("name").alias("chrom"))), "contig_id").select("chrom", "pos", F.col("base").alias("_base"))
    return calls.join(named, ["chrom", "pos"], "left").withColumn("ref_ok", F.coalesce(F.upper(F.substring("ref", 1, 1)) == F.col("_base"), F.lit(False))).drop("_base")


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """(name, flag, chrom, pos, mapq, cigar array, seq, quals, mate_chrom, mate_pos, tlen)."""
    f = F.split("value", "\t")
    lines = spark.read.text(path).where(~F.col("value").startswith("@") & (F.col("value") != ""))
    return lines.select(
        F.get(f, 0).alias("name"),
        F.get(f, 1).cast("int").alias("flag"),
        F.nullif(F.get(f, 2), F.lit("*")).alias("chrom"),
        F.get(f, 3).cast("int").alias("pos"),
        F.get(f, 4).cast("int").alias("mapq"),
        seq.parse_cigar(F.get(f, 5)).alias("cigar"),
        F.get(f, 9).alias("seq"),
        seq.phred33(F.get(f, 10)).alias("quals"),
        F.nullif(F.get(f, 6), F.lit("*")).alias("mate_chrom"),
        F.get(f, 7).cast("int").alias("mate_pos"),
        F.get(f, 8).cast("int").alias("tlen"),
    )


def sam_lines(reads: DataFrame) -> DataFrame:
    """(line) from (name, flag, chrom, pos, mapq, cigar array, seq, quals); tags of a ``tags`` column follow."""
    qual = F.array_join(F.transform("quals", lambda q: F.char(q + 33)), "")
    rest = [F.col("tags")] if "tags" in reads.columns else []
    return reads.select(F.concat_ws("\t", "name", F.col("flag").cast("string"), F.coalesce("chrom", F.lit("*")), F.col("pos").cast("string"), F.col("mapq").cast("string"), F.when(F.size("cigar") > 0, seq.format_cigar(F.col("cigar"))).otherwise("*"), F.lit("*"), F.lit("0"), F.lit("0"), "seq", qual, *rest).alias("line"))


def paf_lines(hits: DataFrame) -> DataFrame:
    """(line) from (name, length, qs, qe, reverse, chrom, chrom_length, rs, re, matches, block, mapq, cigar array)."""
    n = lambda c: F.col(c).cast("string")
    return hits.select(F.concat_ws("\t", "name", n("length"), n("qs"), n("qe"), F.when(F.col("reverse"), "-").otherwise("+"), "chrom", n("chrom_length"), n("rs"), n("re"), n("matches"), n("block"), n("mapq"), F.concat(F.lit("cg:Z:"), seq.format_cigar(F.col("cigar")))).alias("line"))


def read_chrom_depth(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, depth); a malformed line, or a chromosome that comes twice, is an error."""
    rows = spark.read.csv(path, sep="\t", schema="chrom string, depth double", mode="FAILFAST")
    return rows.groupBy("chrom").agg(F.when(F.count("*") > 1, F.raise_error(F.concat(F.lit("chromosome twice: "), "chrom")).cast("double")).otherwise(F.max("depth")).alias("depth"))


def sum_chrom_depths(depths: list[DataFrame]) -> DataFrame:
    """(chrom, depth) summed over samples; all must have the same chromosomes."""
    from functools import reduce

    n = len(depths)
    both = reduce(DataFrame.unionByName, depths).groupBy("chrom").agg(F.sum("depth").alias("depth"), F.count("*").alias("_n"))
    return both.select("chrom", F.when(F.col("_n") != n, F.raise_error(F.concat(F.lit("not in all samples: "), "chrom")).cast("double")).otherwise(F.col("depth")).alias("depth"))


def ploidy_intervals(vcf: DataFrame, samples: list[str]) -> DataFrame:
    """(chrom, begin, end, sample, ploidy) from ``<CNV>`` records with INFO/END and FORMAT/CN; begin from 0, end exclusive."""
    each = vcf.where(F.array_contains("alt", "<CNV>")).select("*", F.posexplode("samples").alias("_i", "_s"))
    return each.select("chrom", F.col("pos").alias("begin"), seq.info_value(F.col("info"), "END").cast("long").alias("end"), F.get(F.array(*(F.lit(s) for s in samples)), "_i").alias("sample"), seq.format_value(F.col("format"), F.col("_s"), "CN").try_cast("int").alias("ploidy"))


def noise_panel(vcf: DataFrame) -> DataFrame:
    """(chrom, pos, alt, total, noise, noise2): samples with calls, with any alternate read, and with at least two."""
    ad = F.transform("samples", lambda s: F.split(seq.format_value(F.col("format"), s, "AD"), ","))
    alt = F.transform(ad, lambda a: F.coalesce(F.try_element_at(a, F.lit(2)).try_cast("int"), F.lit(0)))
    return vcf.select("chrom", "pos", F.get("alt", 0).alias("alt"), F.size(F.filter(ad, lambda a: a.isNotNull())).alias("total"), F.size(F.filter(alt, lambda x: x > 0)).alias("noise"), F.size(F.filter(alt, lambda x: x > 1)).alias("noise2"))


def indel_error_rates(spark: SparkSession, path: str) -> DataFrame:
    """(sample, unit, repeats, rate, noisy_locus_rate) from an indel error model."""
    rows = spark.read.json(path, multiLine=True).select(F.explode("sample").alias("s")).select("s.sampleName", F.explode("s.motif").alias("m"))
    return rows.select(F.col("sampleName").alias("sample"), F.col("m.repeatPatternSize").alias("unit"), F.col("m.repeatCount").alias("repeats"), F.col("m.indelRate").alias("rate"), F.col("m.noisyLocusRate").alias("noisy_locus_rate"))


def theta_table(spark: SparkSession, path: str) -> DataFrame:
    """(unit, repeats, theta)."""
    rows = spark.read.json(path, multiLine=True).select(F.explode("thetas").alias("t"))
    return rows.select(F.col("t.repeatPatternSize").alias("unit"), F.posexplode("t.theta").alias("i", "theta")).select("unit", (F.col("i") + 1).alias("repeats"), "theta")


def write_segments(alignments: DataFrame, path: str, mode: str = "append") -> None:
    """Alignments by contig and segment, sorted within each; a segment's rows go to one task, its files to one folder."""
    from ..operators.merge import sorted_segments

    rows = alignments if "segment_id" in alignments.columns else sorted_segments(alignments, 1_000_000)
    rows.repartition("contig_id", "segment_id").sortWithinPartitions("contig_id", "segment_id", "pos").write.mode(mode).partitionBy("contig_id", "segment_id").parquet(path)


def scan_segments(spark: SparkSession, path: str, contig_id: int, begin: int, end: int) -> DataFrame:
    """Alignments that start in [begin, end): whole segments, then row groups, are skipped by their bounds."""
    return spark.read.parquet(path).where((F.col("contig_id") == contig_id) & (F.col("pos") >= begin) & (F.col("pos") < end)).sort("pos")


def write_lines(header: list[str], lines: DataFrame, order: list[str], path: str, line: str = "line") -> None:
    """A header and ordered lines as text, in parts that follow one another."""
    spark = lines.sparkSession
    head = spark.createDataFrame([(i, h) for i, h in enumerate(header)], "_i int, value string")
    body = lines.orderBy(*order).select(F.col(line).alias("value"))
    head.orderBy("_i").select("value").coalesce(1).write.mode("overwrite").text(path)
    body.write.mode("append").text(path)


def merge_counts(tables: list[DataFrame], keys: list[str], counts: list[str]) -> DataFrame:
    """Counts of several runs, summed."""
    from functools import reduce

    return reduce(DataFrame.unionByName, tables).groupBy(*keys).agg(*(F.sum(c).alias(c) for c in counts))
