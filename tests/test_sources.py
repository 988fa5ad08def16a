from pyspark.sql import functions as F

from seqloom.sources import fastq, files


def test_fasta_and_index(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">c1 first\nACGTN\nacg\n>c2\nRRAA\n")
    (tmp_path / "a.fa.fai").write_text("c1\t8\t10\t5\t6\nc2\t4\t26\t4\t5\n")
    fa, fai = files.read_fasta(spark, str(tmp_path / "a.fa")), files.read_fai(spark, str(tmp_path / "a.fa.fai"))
    assert {r.name: r.seq for r in fa.collect()} == {"c1": "ACGTNACG", "c2": "RRAA"}
    assert [(r.contig_id, r.ref_start) for r in fai.orderBy("contig_id").collect()] == [(0, 0), (1, 8)]
    assert {(r.name, r.known, r.total) for r in files.count_bases(fa).collect()} == {("c1", 7, 8), ("c2", 2, 4)}
    chunks = files.reference_chunks(fa, fai, 3)
    assert "".join(r.seq for r in chunks.where("contig_id = 0").orderBy("chunk_start").collect()) == "ACGTNACG"
    assert files.region_sequence(chunks, 0, 2, 6, 1).first().seq == "CGTNAC"
    assert files.region_sequence(chunks, 1, 0, 4).first().seq == "NNAA"
    assert files.reference_bases(chunks).where("contig_id = 0 and pos = 4").first().base == "T"


def test_fastq_ranges(spark, tmp_path):
    names = [f"r{i}/{1 + i % 2}" for i in range(40)]
    text = "".join(f"@{n} x\n{'ACGU'[i % 4] * (5 + i % 7)}\n+\n{'@' * (5 + i % 7)}\n" for i, n in enumerate(names))
    p = tmp_path / "x.fastq"
    p.write_text(text)
    whole = [r[1] for r in fastq.records(str(p), 0, len(text))]
    assert whole == names
    for size in (7, 50, 333):
        got = fastq.read_fastq(spark, str(p), size) if size == 50 else None
        parts = [r[1] for a in range(0, len(text), size) for r in fastq.records(str(p), a, min(len(text), a + size))]
        assert parts == names
        if got is not None:
            assert [r.name for r in got.orderBy("start").collect()] == names and got.where(F.col("seq").contains("U")).count() == 0
            first, second = fastq.deinterleave(got)
            assert first.count() == second.count() == 20


def test_pairing(spark):
    a = spark.createDataFrame([("q/1", "A", "I"), ("z/1", "C", "I")], "name string, seq string, qual string")
    b = spark.createDataFrame([("q/2", "G", "I")], "name string, seq string, qual string")
    assert [tuple(r) for r in fastq.pair(a, b).collect()] == [("q", "A", "I", "G", "I")]


def test_vcf_bed_depth(spark, tmp_path):
    (tmp_path / "a.vcf").write_text("##x\n#CHROM\tPOS\nc1\t5\t.\tA\tC,<DEL>\t.\tPASS\tDP=3;END=9\tGT:CN:AD\t0/1:3:4,2\t0/0:2:6,0\nc2\t7\tid\tG\tT\t30.5\tLowGQX;x\t.\n")
    v = {r.pos: r for r in files.read_vcf(spark, str(tmp_path / "a.vcf")).collect()}
    assert v[5]["filter"] == [] and v[5].qual is None and v[5].alt == ["C", "<DEL>"] and len(v[5].samples) == 2
    assert v[7]["filter"] == ["LowGQX", "x"] and v[7].qual == 30.5 and v[7].samples == []
    assert files.vcf_header(spark, str(tmp_path / "a.vcf")).count() == 2
    n = files.noise_panel(files.read_vcf(spark, str(tmp_path / "a.vcf")).where("pos = 5")).first()
    assert (n.total, n.noise, n.noise2) == (2, 1, 1)
    (tmp_path / "p.vcf").write_text("c1\t5\t.\tN\t<CNV>\t.\tPASS\tEND=9\tCN\t1\t2\n")
    pl = files.ploidy_intervals(files.read_vcf(spark, str(tmp_path / "p.vcf")), ["s1", "s2"]).collect()
    assert {(r.begin, r.end, r["sample"], r.ploidy) for r in pl} == {(5, 9, "s1", 1), (5, 9, "s2", 2)}
    (tmp_path / "a.bed").write_text("#x\nc1\t1\t5\tn\nc1\t9\t3\n")
    assert [(r.begin, r.end) for r in files.read_bed(spark, str(tmp_path / "a.bed")).collect()] == [(1, 5)]
    (tmp_path / "d.txt").write_text("c1\t30.5\nc2\t7\n")
    d = files.read_chrom_depth(spark, str(tmp_path / "d.txt"))
    assert {r.chrom: r.depth for r in files.sum_chrom_depths([d, d]).collect()} == {"c1": 61.0, "c2": 14.0}


def test_sam_round_trip(spark, tmp_path):
    line = "r1\t16\tc1\t7\t60\t3S5M\t*\t0\t0\tACGTACGT\tIIIIIII!"
    (tmp_path / "a.sam").write_text("@HD\tVN:1\n" + line + "\n")
    s = files.read_sam(spark, str(tmp_path / "a.sam"))
    assert files.sam_lines(s).first().line == line


def test_segments_and_lines(spark, tmp_path):
    rows = [(i, 0, 1 + i * 37 % 100, 0, i) for i in range(20)]
    a = spark.createDataFrame(rows, "read_id long, contig_id int, pos int, src_rank int, src_ord long").withColumn("segment_id", F.floor((F.col("pos") - 1) / 50).cast("int"))
    files.write_segments(a, str(tmp_path / "seg"))
    got = [r.pos for r in files.scan_segments(spark, str(tmp_path / "seg"), 0, 20, 70).collect()]
    assert got == sorted(r[2] for r in rows if 20 <= r[2] < 70)
    files.write_lines(["#h1", "#h2"], spark.createDataFrame([(2, "b"), (1, "a")], "pos int, line string"), ["pos"], str(tmp_path / "out"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ["#h1", "#h2", "a", "b"]


def test_models(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"sample": [{"sampleName": "s", "isStatic": true, "motif": [{"repeatPatternSize": 1, "repeatCount": 4, "indelRate": 0.1, "noisyLocusRate": 0.2}]}]}')
    (tmp_path / "t.json").write_text('{"thetas": [{"repeatPatternSize": 1, "theta": [0.5, 0.25]}]}')
    assert tuple(files.indel_error_rates(spark, str(tmp_path / "m.json")).first()) == ("s", 1, 4, 0.1, 0.2)
    assert [(r.repeats, r.theta) for r in files.theta_table(spark, str(tmp_path / "t.json")).orderBy("repeats").collect()] == [(1, 0.5), (2, 0.25)]
