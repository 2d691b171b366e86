from helixframe.sources import formats as R


def put(folder, name, text):
    (folder / name).write_text(text)
    return f"file://{folder}/{name}"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_fasta_and_chunks(spark, tmp_path):
    got = R.read_fasta(spark, put(tmp_path, "a.fa", ">one first\nACG\nTT\n>two\nG\n>empty\n"))
    assert rows(got) == [("empty", ""), ("one", "ACGTT"), ("two", "G")]
    assert rows(R.chunks(got.where("name = 'one'"), 2, 1)) == [("one", 1, 0, "ACG"), ("one", 2, 2, "GTT"), ("one", 3, 4, "T")]
    hits = spark.createDataFrame([("one", 2, 0, 3)], "name string, chunk long, start long, end long")
    assert rows(R.unchunked(hits, 2)) == [("one", 2, 5)]
    R.write_fasta(got, f"file://{tmp_path}/out")
    assert rows(R.read_fasta(spark, f"file://{tmp_path}/out")) == rows(got)


def test_fastq_over_many_ranges(spark, tmp_path):
    path = put(tmp_path, "a.fq", "".join(f"@r{i} x\n{'ACGT' * (i % 5)}\n+\n{'@III' * (i % 5)}\n" for i in range(500)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = R.read_fastq(spark, path).select("read_no", "name", "seq", "qual").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(tuple(r) for r in got) == [(i, f"r{i}", "ACGT" * (i % 5), "@III" * (i % 5)) for i in range(500)]


def test_fastq_written_by_haplotype(spark, tmp_path):
    reads = spark.createDataFrame([("a", "ACG", "hp1"), ("b", "T", "hp2")], "name string, seq string, hap string")
    R.write_fastq(reads, f"file://{tmp_path}/out", "hap")
    assert rows(R.read_fastq(spark, f"file://{tmp_path}/out/hap=hp1").select("name", "seq", "qual")) == [("a", "ACG", "!!!")]


def test_vcf(spark, tmp_path):
    path = put(tmp_path, "a.vcf", "##fileformat=VCFv4.2\n##contig=<ID=chr1,length=9>\n##INFO=<ID=X,Number=1>\n#CHROM\tPOS\nchr1\t5\ts1\tA\tAT\t.\tPASS\tSVTYPE=INS;X=3;FLAG\tGT\t0/1\n")
    got = R.read_vcf(spark, path)
    row = got.first()
    assert (row.chrom, row.pos, row.info_map, row.sample) == ("chr1", 5, {"SVTYPE": "INS", "X": "3", "FLAG": None}, "0/1")
    R.write_vcf(got, ["##fileformat=VCFv4.2"], f"file://{tmp_path}/out")
    assert rows(R.read_vcf(spark, f"file://{tmp_path}/out/*").drop("info_map")) == rows(got.drop("info_map"))


def test_headers_merge(spark, tmp_path):
    put(tmp_path, "a.vcf", "##fileformat=VCFv4.2\n##INFO=<ID=X,d=a>\n##contig=<ID=chr1>\n##other=1\n")
    put(tmp_path, "b.vcf", "##fileformat=VCFv4.1\n##INFO=<ID=X,d=b>\n##INFO=<ID=Y>\n##contig=<ID=chr2>\n##contig=<ID=chr1>\n")
    lines = [r[1] for r in rows(R.merge_headers(R.read_vcf_headers(spark, f"file://{tmp_path}/*.vcf")))]
    assert lines == ["##fileformat=VCFv4.2", "##contig=<ID=chr2>", "##contig=<ID=chr1>", "##INFO=<ID=X,d=a>", "##INFO=<ID=Y>"]


def test_alignments(spark, tmp_path):
    sam = R.read_sam(spark, put(tmp_path, "a.sam", "@HD\tVN:1\nr1\t16\tchr1\t7\t60\t3M\t*\t0\t0\tACG\tIII\tSA:Z:chr2,1,+,3M,60,0;\n")).first()
    assert (sam.qname, sam.pos, sam.is_reverse, sam.sa) == ("r1", 7, True, "chr2,1,+,3M,60,0;")
    paf = R.read_paf(spark, put(tmp_path, "a.paf", "q\t9\t0\t9\t+\tt\t20\t5\t14\t9\t9\t60\ttp:A:P\tNM:i:2\tcg:Z:9M\n")).first()
    assert (paf.q_name, paf.t_end, paf.kind, paf.cigar, paf.edits) == ("q", 14, "P", "9M", 2)


def test_small_tables(spark, tmp_path):
    assert rows(R.read_bed(spark, put(tmp_path, "a.bed", "track x\nchr1\t1\t5\tn\nchr2\t0\t2\n"))) == [("chr1", 1, 5, "n"), ("chr2", 0, 2, None)]
    assert rows(R.read_fai(spark, put(tmp_path, "a.fai", "chr1\t100\t6\t60\t61\n"))) == [("chr1", 100)]
    assert rows(R.read_cov(spark, put(tmp_path, "a.cov", ">c1 10\n1 4 3\n5 10 0\n>c2 2\n1 2 7\n"))) == [("c1", 10, 1, 4, 3), ("c1", 10, 5, 10, 0), ("c2", 2, 1, 2, 7)]
    assert rows(R.read_sigs(spark, put(tmp_path, "a.sigs", "DEL chr1 10.5 30 r1\nINS chr1 9 40 r2 ACGT\n"))) == [("DEL", "chr1", 10, 30, ["r1"]), ("INS", "chr1", 9, 40, ["r2", "ACGT"])]
    assert {r.name: r.value for r in R.read_parameters(spark, put(tmp_path, "a.txt", "\ufeffsmall:0.6\nlarge:nan\n")).collect()} == {"small": 0.6, "large": None}
    assert rows(R.read_gfa_sequences(spark, put(tmp_path, "a.gfa", "H\tVN\nS\tu1\tACG\nL\tu1\n"))) == [("u1", "ACG")]
    assert R.read_bed(spark, put(tmp_path, "none.bed", "")).count() == 0
