"""Further queries of the catalogue: linkage, models, pileups, choices, sets, windows on event time, and formats written and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.operators import calling, linkage, models, pileup, splits
from helixframe.plans.adapters import ctes, frame
from helixframe.plans.registry import query
from helixframe.sources import formats
from helixframe.streaming import sessions


def table(spark, d: str, sql: str, name: str) -> DataFrame:
    return spark.sql(sql.replace(f"FROM {name}", "FROM {t}"), t=spark.read.parquet(f"{d}/{name}.parquet"))


_COV = ctes("calls", "sigs") + """, v AS (SELECT c.svid, CAST(coalesce(sum(g.svlen), 0) AS BIGINT) AS cov, max(c.svlen) AS len FROM calls c LEFT JOIN sigs g ON g.svtype = 'DEL' AND g.chrom = c.chrom AND g.pos <= c.pos + c.svlen + 100 AND g.pos + g.svlen >= c.pos - 100 WHERE c.svtype = 'DEL' GROUP BY c.svid),
  r AS (SELECT *, cov / len AS ratio FROM v), m AS (SELECT quantile_cont(ratio, 0.5) AS median FROM r)"""


@query("cov_filter", _COV + " SELECT svid, cov, round(ratio, 6) AS ratio FROM r, m WHERE ratio >= 0.5 * median AND ratio <= 2 * median")
def _(spark, d):
    calls = frame(spark, d, "calls")
    rows = calling.deletion_cover(calls, frame(spark, d, "sigs")).join(calls.select("svid", "svlen"), "svid").withColumn("ratio", F.col("cov") / F.col("svlen")).withColumn("svtype", F.lit("DEL"))
    return calling.median_ratio_filter(rows, "svtype", "ratio", 0.5, 2.0).select("svid", "cov", F.round("ratio", 6).alias("ratio"))


def haplotype_calls(spark, d: str) -> tuple[DataFrame, DataFrame]:
    """Calls of both haplotypes in the first letters of reads, taken as reference sequences; an adapter for the linkage queries."""
    refs = frame(spark, d, "reads").where("length(seq) >= 2000").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("chrom"), F.substring("seq", 1, 2000).alias("seq"))
    i = F.explode(F.sequence(F.lit(0), F.lit(5))).alias("i")
    n = F.regexp_extract("chrom", r"(\d+)", 1).cast("long")
    rows = refs.select("chrom", "seq", i).withColumn("n", n)
    start = (200 + (F.floor(F.col("i") / 2) * 500) + (F.col("n") * (F.col("i") + 1)) % 40).cast("long")
    kind = F.element_at(F.array(*[F.lit(x) for x in ("DEL", "INS", "INV", "DUP")]), (F.col("n") % 4 + 1).cast("int"))
    size = 40 + (F.col("n") * 7 + F.floor(F.col("i") / 2)) % 60 + (F.col("n") * F.col("i")) % 3
    calls = rows.select(F.concat_ws("-", "chrom", F.col("i").cast("string")).alias("svid"), (F.col("i") % 2 + 1).alias("hap"), "chrom", kind.alias("svtype"), start.alias("start"), (start + F.when(kind == "INS", 0).otherwise(size)).cast("long").alias("end"), F.upper(F.substring(F.col("seq"), F.lit(1500), size.cast("int"))).alias("alt"), F.lit(1).alias("copies"))
    return calls, refs


@query("complete_linkage")
def _(spark, d):
    return linkage.pair_by_sequence(*haplotype_calls(spark, d)).select("svid", "chrom", "svtype", "part", "cluster")


@query("pair_genotypes")
def _(spark, d):
    return linkage.genotypes(linkage.pair_by_sequence(*haplotype_calls(spark, d)), ["chrom", "svtype", "part"])


def breakend_pairs(spark, d: str) -> DataFrame:
    b = splits.classify_segments(frame(spark, d, "segs")).where("kind = 'BND'")
    way = F.split("detail", "-")
    return b.select(F.concat_ws("-", "qname", "q_start").alias("svid"), (F.col("q_start") % 2 + 1).alias("hap"), "chrom", "chrom2", F.floor(F.col("start") / 40).alias("place"), F.col("start").alias("pos1"), way[0].alias("dir1"), F.col("end").alias("pos2"), way[1].alias("dir2"))


@query("breakend_linkage")
def _(spark, d):
    return linkage.pair_breakends(breakend_pairs(spark, d), ["chrom", "chrom2", "place"]).select("svid", "cluster")


@query("inversion_sweep")
def _(spark, d):
    v = splits.classify_segments(frame(spark, d, "segs")).where("kind = 'INV'")
    return linkage.swept_inversions(v.select("qname", "chrom", "start", "end", F.col("detail").alias("side"))).withColumnsRenamed({"start": "v_start", "end": "v_end"})


@query("tandem_runs")
def _(spark, d):
    v = splits.classify_segments(frame(spark, d, "segs")).where("kind = 'DUP'")
    idx = F.row_number().over(W.partitionBy("qname").orderBy("q_start"))
    dups = v.select("qname", idx.alias("idx"), "chrom", "start", "end", (F.col("detail") == "full").alias("full"), (F.col("q_start") % 2 == 0).alias("forward"))
    return linkage.tandem_runs(dups).withColumnsRenamed({"start": "v_start", "end": "v_end"})


def ploidy_histogram(spark, d):
    """(win, coverage, freq) with errors and two ploidies."""
    return table(spark, d, "SELECT o_orderpriority AS win, CAST(12 + (o_orderkey * 7 % 5 + o_custkey % 5) + CASE WHEN o_orderkey % 7 = 0 THEN 16 ELSE 0 END - CASE WHEN o_orderkey % 11 = 0 THEN 12 ELSE 0 END AS bigint) AS coverage, count(*) AS freq FROM orders GROUP BY 1, 2", "orders")


@query("mixture_fit")
def _(spark, d):
    """The maximum of the likelihood has no closed form; the tests recover known mixtures."""
    h = ploidy_histogram(spark, d)
    out = models.fit_windows(h, "win", 2)
    return out.select("win", *[F.round(c, 4).alias(c) for c in out.columns if c != "win"])


HMM = {"means": [5.0, 20.0, 40.0], "variances": [9.0, 25.0, 60.0], "transition": [[0.9, 0.08, 0.02], [0.05, 0.9, 0.05], [0.02, 0.08, 0.9]], "start": [0.2, 0.6, 0.2]}


@query("hmm_labels")
def _(spark, d):
    """A recursion over positions; the tests sum over all paths."""
    cover = frame(spark, d, "cover").select(F.concat_ws(":", "chrom", F.floor(F.col("pos") / 500).cast("string")).alias("chunk"), F.col("pos").cast("long").alias("pos"), "depth")
    return models.hmm_labels(cover, HMM).withColumn("probability", F.round("probability", 6))


_PILE = "SELECT concat('read', CAST(l_partkey % 50 AS string)) AS read, concat('chr', CAST(l_suppkey % 3 + 1 AS string)) AS chrom, l_orderkey % 400 AS pos, 'A' AS ref, substr('ACGTAA', CAST(l_linenumber % 6 + 1 AS int), 1) AS allele, concat('s', CAST(l_partkey % 2 AS string)) AS sample, l_linenumber % 2 = 0 AS is_reverse, l_suppkey % 40 AS quality, l_linenumber % 3 = 0 AS is_alt FROM lineitem"


@query("read_bases", f"WITH p AS ({_PILE}), u AS (SELECT read, l AS pos, min(allele) AS base FROM (SELECT *, pos AS l FROM p) GROUP BY ALL) SELECT read, min(pos) AS first, string_agg(base, '' ORDER BY pos) AS seq FROM u GROUP BY read")
def _(spark, d):
    return pileup.read_bases(table(spark, d, _PILE, "lineitem").groupBy("read", "pos").agg(F.min("allele").alias("base")))


@query("allele_counts", f"WITH p AS ({_PILE}) SELECT chrom, pos, allele, count(*) FILTER (WHERE sample = 's0' AND NOT is_reverse) AS s0_fwd, count(*) FILTER (WHERE sample = 's0' AND is_reverse) AS s0_rev, count(*) FILTER (WHERE sample = 's1' AND NOT is_reverse) AS s1_fwd, count(*) FILTER (WHERE sample = 's1' AND is_reverse) AS s1_rev FROM p GROUP BY ALL")
def _(spark, d):
    return pileup.allele_depths(table(spark, d, _PILE, "lineitem"), ["s0", "s1"])


@query("pileup_variants", f"""WITH p AS ({_PILE}), n AS (SELECT chrom, pos, ref, allele, count(*) AS n FROM p GROUP BY ALL), m AS (SELECT chrom, pos, ref, first(allele ORDER BY n DESC, allele <> ref, allele) AS majority FROM n GROUP BY ALL)
  SELECT n.chrom, n.pos, n.ref, string_agg(allele, ',' ORDER BY n DESC, allele) AS alts, string_agg(CAST(n AS string), ',' ORDER BY n DESC, allele) AS depths, max(majority) AS majority FROM n JOIN m USING (chrom, pos, ref) WHERE allele <> n.ref AND n >= 2 GROUP BY ALL""")
def _(spark, d):
    return pileup.pileup_variants(table(spark, d, _PILE, "lineitem"), 2)


@query("snp_cluster_filter", f"""WITH p AS ({_PILE}), s AS (SELECT DISTINCT concat(read, '-', pos % 7) AS read, chrom, pos, is_alt, quality FROM p), q AS (SELECT *, CASE WHEN pos - lag(pos) OVER w <= 40 THEN 0 ELSE 1 END AS n FROM s WHERE quality >= 10 WINDOW w AS (PARTITION BY read, chrom ORDER BY pos)),
  g AS (SELECT *, sum(n) OVER (PARTITION BY read, chrom ORDER BY pos RANGE UNBOUNDED PRECEDING) AS part FROM q), b AS (SELECT DISTINCT read FROM g GROUP BY read, chrom, part HAVING avg(CAST(is_alt AS INT)) >= 0.3) SELECT DISTINCT read FROM s WHERE read NOT IN (SELECT read FROM b)""")
def _(spark, d):
    p = table(spark, d, _PILE, "lineitem").select(F.concat_ws("-", "read", (F.col("pos") % 7).cast("string")).alias("read"), "chrom", "pos", "is_alt", "quality").distinct()
    return pileup.reads_without_snp_clusters(p, 40)


@query("homozygous_runs", ctes("cigar") + """, m AS (SELECT *, coalesce(sum(CASE WHEN op IN (0,2,3,7,8) THEN len ELSE 0 END) OVER w, 0) AS r, coalesce(sum(CASE WHEN op IN (0,1,4,7,8) THEN len ELSE 0 END) OVER w, 0) AS q FROM cigar WINDOW w AS (PARTITION BY aln ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
  SELECT aln, CAST(r AS BIGINT) AS r_start, CAST(r + len AS BIGINT) AS r_end, CAST(q AS BIGINT) AS q_start, CAST(q + len AS BIGINT) AS q_end FROM m WHERE op = 7 AND len >= 25""")
def _(spark, d):
    return pileup.homozygous_runs(frame(spark, d, "cigar"), 25)


_MARK = "SELECT concat('r', CAST(l_orderkey AS string)) AS read, CAST(l_linenumber % 3 AS BIGINT) AS aln, l_partkey % 4 AS read_pos, 15 + min(l_suppkey % 30) AS quality, min(l_suppkey % 2) = 0 AS is_match FROM lineitem GROUP BY 1, 2, 3"
_MARKS = f"WITH m AS ({_MARK}), t AS (SELECT read, read_pos FROM m WHERE quality >= 20 GROUP BY ALL HAVING min(is_match) <> max(is_match)), s AS (SELECT read, aln, round(sum(CASE WHEN is_match THEN 10 * log10(1 - pow(10.0, -quality / 10)) ELSE -quality - 10 * ln(3) END), 6) AS score, count(*) AS n FROM m SEMI JOIN t USING (read, read_pos) WHERE quality >= 20 GROUP BY ALL)"


@query("marker_scores", _MARKS + " SELECT * FROM s")
def _(spark, d):
    return pileup.marker_scores(table(spark, d, _MARK, "lineitem"))


@query("better_alignments", _MARKS + ", a AS (SELECT read, max(aln) FILTER (WHERE aln = 0) AS p, max(score) FILTER (WHERE aln = 0) AS ps, first(aln ORDER BY score DESC, aln) FILTER (WHERE aln <> 0) AS c, max(score) FILTER (WHERE aln <> 0) AS cs FROM s GROUP BY read) SELECT read, p AS \"primary\", c AS chosen FROM a WHERE cs > ps + 5 AND cs >= -50")
def _(spark, d):
    s = pileup.marker_scores(table(spark, d, _MARK, "lineitem")).withColumn("is_primary", F.col("aln") == 0)
    return pileup.better_alignments(s, 5, -50)


_ALN = "SELECT concat('r', CAST(l_orderkey AS string)) AS read, concat(CAST(l_orderkey AS string), '-', CAST(l_linenumber AS string)) AS aln, l_linenumber = 1 AS is_primary, l_partkey % 60 AS mapq, l_partkey % 500 + 100 AS read_len, l_partkey % 90 AS block, l_suppkey % 20 / 100 AS divergence FROM lineitem"


@query("correct_bam", f"""WITH a AS ({_ALN}), b AS (SELECT read, concat(substr(read, 2), '-1') AS p, concat(substr(read, 2), '-2') AS c FROM a GROUP BY read HAVING count(*) > 2), m AS (SELECT aln, 33 AS nm FROM a WHERE mapq % 7 = 0)
  SELECT read, aln, CASE WHEN c IS NULL THEN is_primary ELSE aln = c OR (is_primary AND aln <> p) END AS is_primary, CAST(coalesce(nm, mapq) AS BIGINT) AS mapq FROM a LEFT JOIN b USING (read) LEFT JOIN m USING (aln) WHERE read_len >= 150 AND block >= 10 AND divergence <= 0.12""")
def _(spark, d):
    a = table(spark, d, _ALN, "lineitem").withColumn("divergence", F.col("divergence").cast("double"))
    many = a.groupBy("read").agg(F.count(F.lit(1)).alias("n")).where("n > 2")
    better = many.select("read", F.concat(F.expr("substr(read, 2)"), F.lit("-1")).alias("primary"), F.concat(F.expr("substr(read, 2)"), F.lit("-2")).alias("chosen"))
    return pileup.corrected_alignments(a, better, a.where("mapq % 7 = 0").select("aln", F.lit(33).cast("long").alias("new_mapq")), 150, 10, 0.12)


_LINES = "SELECT l_orderkey * 10 + l_linenumber AS line_no, CASE l_linenumber WHEN 1 THEN concat('$', chr(9), 'r', CAST(l_orderkey AS string)) WHEN 2 THEN concat('*', chr(9), 'from', CAST(l_partkey AS string)) WHEN 4 THEN concat('@', chr(9), 'to', CAST(l_suppkey AS string)) ELSE concat('!', chr(9), 'x') END AS value FROM lineitem"


@query("control_break", f"""WITH l AS ({_LINES}), g AS (SELECT *, sum(CASE WHEN value[1] = '$' THEN 1 ELSE 0 END) OVER (ORDER BY line_no) AS record, string_split(value, chr(9)) AS f FROM l) SELECT CAST(record AS BIGINT) AS record, max(CASE WHEN f[1] = '$' THEN f[2] END) AS read, max(CASE WHEN f[1] = '*' THEN f[2] END) AS source, max(CASE WHEN f[1] = '@' THEN f[2] END) AS target
  FROM g WHERE record > 0 GROUP BY record HAVING max(CASE WHEN f[1] = '@' THEN f[2] END) IS NOT NULL""")
def _(spark, d):
    return pileup.control_break_records(table(spark, d, _LINES, "lineitem"))


_NEAR = ctes("calls") + ", b AS (SELECT concat('chr', CAST(c AS string)) AS chrom, c * 100 + i AS block, i * 25000 + (c * 37 + i * 911) % 9000 AS b_start, i * 25000 + (c * 37 + i * 911) % 9000 + 12000 AS b_end FROM (SELECT unnest(range(1, 23)) AS c), (SELECT unnest(range(0, 40)) AS i))"


@query("nearest_blocks", _NEAR + ", x AS (SELECT svid AS read, block, greatest(pos, b_start) - least(pos + svlen, b_end) AS dist FROM calls JOIN b USING (chrom)), r AS (SELECT *, row_number() OVER (PARTITION BY read ORDER BY dist, block) AS rk FROM x) SELECT * FROM r WHERE rk <= 2")
def _(spark, d):
    c, i = F.col("c"), F.col("i")
    b = spark.range(1, 23).select(F.col("id").alias("c"), F.explode(F.sequence(F.lit(0), F.lit(39))).alias("i"))
    start = (i * 25000 + (c * 37 + i * 911) % 9000).cast("long")
    b = b.select(F.concat(F.lit("chr"), c.cast("string")).alias("chrom"), (c * 100 + i).alias("block"), start.alias("b_start"), (start + 12000).alias("b_end"))
    reads = frame(spark, d, "calls").select(F.col("svid").alias("read"), "chrom", F.col("pos").alias("start"), (F.col("pos") + F.col("svlen")).alias("end"))
    return pileup.nearest_blocks(reads, b)


@query("shared_names", ctes("alns", "sigs") + "SELECT qname FROM alns WHERE is_reverse = 0 INTERSECT SELECT qname FROM sigs WHERE svtype = 'INS'")
def _(spark, d):
    return frame(spark, d, "alns").where("is_reverse = 0").select("qname").intersect(frame(spark, d, "sigs").where("svtype = 'INS'").select("qname"))


@query("pending", ctes("calls", "sigs") + "SELECT svid FROM calls WHERE svid NOT IN (SELECT concat('sv', substr(qname, 5)) FROM sigs)")
def _(spark, d):
    done = frame(spark, d, "sigs").select(F.concat(F.lit("sv"), F.expr("substr(qname, 5)")).alias("svid"))
    return frame(spark, d, "calls").select("svid").join(done, "svid", "left_anti")


@query("distinct_sorted", ctes("sigs") + "SELECT DISTINCT chrom, pos, svlen, svtype FROM sigs ORDER BY chrom, pos, svlen, svtype")
def _(spark, d):
    return frame(spark, d, "sigs").select("chrom", "pos", "svlen", "svtype").distinct().orderBy("chrom", "pos", "svlen", "svtype")


@query("label_colours", ctes("calls") + ", c AS (SELECT * FROM (VALUES ('INS', '162,0,37'), ('DEL', '250,104,0')) v(svtype, rgb)) SELECT svid, svtype, rgb FROM calls JOIN c USING (svtype)")
def _(spark, d):
    colours = spark.createDataFrame([("INS", "162,0,37"), ("DEL", "250,104,0")], "svtype string, rgb string")
    return frame(spark, d, "calls").join(F.broadcast(colours), "svtype").select("svid", "svtype", "rgb")


@query("event_windows", "SELECT event_type, time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01') AS w_start, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL")
def _(spark, d):
    return sessions.tumbling(spark.read.parquet(f"{d}/events.parquet"), ["event_type"], "1 day", "value")


@query("event_sessions", "WITH l AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL '6 hours' THEN 0 ELSE 1 END AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), g AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS s FROM l) SELECT user_id, min(ts) AS s_start, max(ts) + INTERVAL '6 hours' AS s_end, count(*) AS n FROM g GROUP BY user_id, s")
def _(spark, d):
    return sessions.sessions(spark.read.parquet(f"{d}/events.parquet"), ["user_id"], "6 hours")


def _folder(spark, name: str) -> str:
    there = spark.conf.get("spark.checkpoint.dir", None)
    if not there:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        import tempfile

        there = f"file://{tempfile.mkdtemp(prefix='helixframe-')}"
    return f"{there}/{name}-{uuid.uuid4().hex}"


@query("vcf_round_trip", ctes("calls") + "SELECT svid AS id, chrom, pos, concat('SVTYPE=', svtype, ';SVLEN=', CAST(svlen AS string)) AS info, svtype, gt AS sample FROM calls")
def _(spark, d):
    c = frame(spark, d, "calls")
    records = c.select("chrom", "pos", F.col("svid").alias("id"), F.lit("N").alias("ref"), F.concat(F.lit("<"), "svtype", F.lit(">")).alias("alt"), F.lit(".").alias("qual"), F.lit("PASS").alias("filter"), F.concat(F.lit("SVTYPE="), "svtype", F.lit(";SVLEN="), F.col("svlen").cast("string")).alias("info"), F.lit("GT").alias("format"), F.col("gt").alias("sample"))
    path = _folder(spark, "vcf")
    formats.write_vcf(records, ["##fileformat=VCFv4.2"], path)
    return formats.read_vcf(spark, f"{path}/*").select("id", "chrom", "pos", "info", F.col("info_map")["SVTYPE"].alias("svtype"), "sample")


@query("bed_round_trip", ctes("sigs") + "SELECT chrom, pos AS b_start, pos + svlen AS b_end FROM sigs")
def _(spark, d):
    path = _folder(spark, "bed")
    formats.write_bed(frame(spark, d, "sigs").select("chrom", F.col("pos").alias("start"), (F.col("pos") + F.col("svlen")).alias("end")), path)
    return formats.read_bed(spark, path).select("chrom", F.col("start").alias("b_start"), F.col("end").alias("b_end"))


@query("fasta_round_trip", ctes("reads") + "SELECT CAST(doc_id AS string) AS name, seq FROM reads WHERE length(seq) > 0")
def _(spark, d):
    path = _folder(spark, "fasta")
    formats.write_fasta(frame(spark, d, "reads").where("length(seq) > 0").select(F.col("doc_id").cast("string").alias("name"), "seq"), path)
    return formats.read_fasta(spark, path).select("name", "seq")


@query("fastq_round_trip", ctes("reads") + "SELECT CAST(doc_id AS string) AS name, seq, repeat('!', length(seq)) AS qual, lang FROM reads WHERE length(seq) > 0")
def _(spark, d):
    path = _folder(spark, "fastq")
    formats.write_fastq(frame(spark, d, "reads").where("length(seq) > 0").select(F.col("doc_id").cast("string").alias("name"), "seq", "lang"), path, by="lang")
    return formats.read_fastq(spark, f"{path}/*/").select("name", "seq", "qual", F.regexp_extract("file", r"lang=([^/]*)", 1).alias("lang"))


@query("sam_round_trip", ctes("alns") + "SELECT qname, CAST(is_reverse * 16 AS BIGINT) AS flag, chrom AS rname, ref_start + 1 AS pos, mapq, is_reverse = 1 AS is_reverse FROM alns")
def _(spark, d):
    path = _folder(spark, "sam")
    a = frame(spark, d, "alns")
    line = F.concat_ws("\t", "qname", (F.col("is_reverse") * 16).cast("string"), "chrom", (F.col("ref_start") + 1).cast("string"), F.col("mapq").cast("string"), F.concat((F.col("ref_end") - F.col("ref_start")).cast("string"), F.lit("M")), F.lit("*"), F.lit("0"), F.lit("0"), F.lit("*"), F.lit("*"))
    a.select(line.alias("value")).write.text(path)
    return formats.read_sam(spark, path).select("qname", "flag", "rname", "pos", "mapq", "is_reverse")


@query("cov_round_trip", ctes("cover") + "SELECT chrom, pos * 10 + 1 AS b_start, pos * 10 + 10 AS b_end, depth FROM cover")
def _(spark, d):
    path = _folder(spark, "cov")
    c = frame(spark, d, "cover")
    # Within each contig's file the header comes first.
    head = c.select("chrom").distinct().select("chrom", F.lit(-1).cast("long").alias("at"), F.concat(F.lit(">"), "chrom", F.lit(" 100000000")).alias("value"))
    body = c.select("chrom", F.col("pos").cast("long").alias("at"), F.concat_ws("\t", (F.col("pos") * 10 + 1).cast("string"), (F.col("pos") * 10 + 10).cast("string"), F.col("depth").cast("string")).alias("value"))
    head.unionByName(body).repartition("chrom").sortWithinPartitions("chrom", "at").select("value").write.text(path)
    return formats.read_cov(spark, path).select("chrom", F.col("start").alias("b_start"), F.col("end").alias("b_end"), "depth")
