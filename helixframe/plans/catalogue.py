"""All queries over the test tables, by name, and the SQL each is checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.operators import calling, cigar, greedy, intervals, marks, sequence
from helixframe.plans.adapters import ctes, frame
from helixframe.plans.registry import QUERIES, SQL, query  # noqa: F401
from helixframe.sources import formats

K = 12


def _blocks(df: DataFrame, *more: str) -> DataFrame:
    return df.select(*more, "chrom", F.col("pos").alias("start"), (F.col("pos") + F.col("svlen")).alias("end"))


def _named(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("start", "b_start").withColumnRenamed("end", "b_end")


#: Thresholds as in the HiFi parameter files of deletions and insertions.
GT = ctes("calls", "sigs", "alns") + """, p AS (SELECT svid, chrom, pos - 100 AS s, pos + 100 AS e, 1 AS n FROM calls WHERE svtype = 'INS' UNION ALL SELECT svid, chrom, pos, pos + svlen, 1 FROM calls WHERE svtype = 'DEL' AND svlen <= 1000
    UNION ALL SELECT svid, chrom, pos - 150, pos - 50, 2 FROM calls WHERE svtype = 'DEL' AND svlen > 1000 UNION ALL SELECT svid, chrom, pos + svlen + 150, pos + svlen + 250, 2 FROM calls WHERE svtype = 'DEL' AND svlen > 1000)
, d AS (SELECT svid, CAST(count(*) AS DOUBLE) / max(n) AS n_cov FROM p JOIN alns a ON a.chrom = p.chrom AND a.ref_start < s AND a.ref_end > e GROUP BY svid)
, g AS (SELECT chrom, svtype, pos, svlen, count(*) AS n FROM sigs GROUP BY ALL)
, u AS (SELECT c.svid, CAST(sum(g.n) AS BIGINT) AS n_support FROM calls c JOIN g ON c.chrom = g.chrom AND c.svtype = g.svtype AND abs(c.pos - g.pos) <= greatest(500, CAST(floor(c.svlen * 2.3) AS BIGINT))
    AND least(c.svlen, g.svlen) * 10 >= greatest(c.svlen, g.svlen) * 6 GROUP BY c.svid)
, j AS (SELECT c.*, coalesce(n_support, 0) AS n_support, coalesce(n_cov, 0.0) AS n_cov, CASE WHEN coalesce(n_cov, 0) = 0 THEN 1.0 ELSE coalesce(n_support, 0) / n_cov END AS n_ratio FROM calls c LEFT JOIN u USING (svid) LEFT JOIN d USING (svid))
, t AS (SELECT *, CASE WHEN svtype = 'DEL' THEN CASE WHEN svlen <= 1000 THEN CASE gt WHEN '1/1' THEN 0.69 WHEN '0/1' THEN 0.91 END ELSE CASE gt WHEN '1/1' THEN 0.60 WHEN '0/1' THEN 0.71 END END
    ELSE CASE WHEN svlen <= 1000 THEN CASE gt WHEN '1/1' THEN 0.59 WHEN '0/1' THEN 0.79 END ELSE CASE gt WHEN '0/1' THEN 0.63 END END END AS limit_ FROM j)
"""  # fmt: skip


@query("gt_support", GT + "SELECT svid, n_support FROM j")
def _(spark: SparkSession, d: str) -> DataFrame:
    return calling.support(frame(spark, d, "calls"), frame(spark, d, "sigs")).select("svid", "n_support")

@query("span_depth", GT + "SELECT svid, CAST(n_cov AS DOUBLE) AS n_cov FROM j")
def _(spark, d):
    return calling.spanning_depth(frame(spark, d, "calls"), frame(spark, d, "alns")).select("svid", "n_cov")


_NEW_GT = "CASE WHEN limit_ IS NULL THEN gt WHEN n_ratio > limit_ THEN '1/1' ELSE '0/1' END AS new_gt"


def _corrected(spark, d) -> DataFrame:
    return calling.correct_genotypes(frame(spark, d, "calls"), frame(spark, d, "sigs"), frame(spark, d, "alns"))


@query("gt_correct", GT + f"SELECT svid, chrom, svtype, pos, svlen, gt, n_support, CAST(n_cov AS DOUBLE) AS n_cov, CAST(round(n_ratio, 6) AS DOUBLE) AS n_ratio, {_NEW_GT} FROM t")
def _(spark, d):
    return _corrected(spark, d).select("svid", "chrom", "svtype", "pos", "svlen", "gt", "n_support", "n_cov", F.round("n_ratio", 6).alias("n_ratio"), "new_gt")


@query("eval_metrics", GT + f""", y AS (SELECT svtype, gt, {_NEW_GT} FROM t), x AS (SELECT svtype, count(*) FILTER (WHERE new_gt = '1/1' AND gt = '1/1') AS tp, count(*) FILTER (WHERE new_gt = '1/1' AND gt <> '1/1') AS fp, count(*) FILTER (WHERE new_gt <> '1/1' AND gt = '1/1') AS fn FROM y GROUP BY svtype)
  SELECT svtype, tp, fp, fn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM x""")
def _(spark, d):
    return calling.evaluation(_corrected(spark, d), "svtype", F.col("gt") == "1/1", F.col("new_gt") == "1/1")


@query("inv_support", ctes("calls", "alns") + """, e AS (SELECT svid, chrom, true AS first_, pos AS at_ FROM calls UNION ALL SELECT svid, chrom, false, pos + svlen FROM calls),
  r AS (SELECT e.svid, first_, a.qname FROM e JOIN alns a ON a.chrom = e.chrom AND a.ref_start < at_ + 1000 AND a.ref_end > at_ - 1000 GROUP BY ALL HAVING min(is_reverse) < max(is_reverse)),
  n AS (SELECT svid, count(*) FILTER (WHERE first_) AS n_start, count(*) FILTER (WHERE NOT first_) AS n_end FROM r GROUP BY svid) SELECT * FROM n WHERE n_start >= 1 AND n_end >= 1""")
def _(spark, d):
    return calling.inversion_support(frame(spark, d, "calls"), frame(spark, d, "alns"))


@query("fp_filter", ctes("calls", "sigs") + """SELECT svid, chrom, pos, svlen FROM calls c WHERE svlen > 250 OR EXISTS (SELECT 1 FROM sigs g WHERE g.chrom = c.chrom AND abs(g.pos - c.pos) <= 500
  AND least(c.svlen, g.svlen) * 2 >= greatest(c.svlen, g.svlen))""")
def _(spark, d):
    return calling.read_supported(frame(spark, d, "calls"), frame(spark, d, "sigs")).select("svid", "chrom", "pos", "svlen")


@query("ins_cov", ctes("calls", "sigs") + """SELECT c.svid, CAST(coalesce(sum(g.svlen), 0) AS BIGINT) AS cov FROM calls c LEFT JOIN sigs g ON g.svtype = 'INS' AND g.chrom = c.chrom AND abs(g.pos - c.pos) <= 1000 WHERE c.svtype = 'INS' GROUP BY c.svid""")
def _(spark, d):
    return calling.insertion_cover(frame(spark, d, "calls"), frame(spark, d, "sigs"))


@query("del_cov", ctes("calls", "sigs") + """SELECT c.svid, CAST(coalesce(sum(g.svlen), 0) AS BIGINT) AS cov FROM calls c LEFT JOIN sigs g ON g.svtype = 'DEL' AND g.chrom = c.chrom
  AND g.pos <= c.pos + c.svlen + 100 AND g.pos + g.svlen >= c.pos - 100 WHERE c.svtype = 'DEL' GROUP BY c.svid""")
def _(spark, d):
    return calling.deletion_cover(frame(spark, d, "calls"), frame(spark, d, "sigs"))


@query("sig_dedup", ctes("sigs") + "SELECT chrom, svtype, pos, svlen, count(*) AS n FROM sigs GROUP BY ALL")
def _(spark, d):
    return calling.dedup_signatures(frame(spark, d, "sigs"))


@query("pass_ids", ctes("calls", "sigs") + "SELECT svid, chrom, pos FROM calls c WHERE EXISTS (SELECT 1 FROM sigs g WHERE g.chrom = c.chrom AND g.pos = c.pos)")
def _(spark, d):
    return frame(spark, d, "calls").join(frame(spark, d, "sigs").select("chrom", "pos"), ["chrom", "pos"], "left_semi").select("svid", "chrom", "pos")


@query("anti_contigs", ctes("calls", "contigs") + "SELECT chrom, length FROM contigs c WHERE NOT EXISTS (SELECT 1 FROM calls s WHERE s.chrom = c.chrom AND s.svlen > 990) UNION ALL SELECT concat(chrom, '_new'), length FROM contigs WHERE length > 1200000")
def _(spark, d):
    c = frame(spark, d, "contigs")
    listed = frame(spark, d, "calls").where("svlen > 990").select("chrom")
    return c.join(listed, "chrom", "left_anti").unionByName(c.where("length > 1200000").withColumn("chrom", F.concat("chrom", F.lit("_new"))))


@query("revcomp", ctes("reads") + "SELECT doc_id, reverse(translate(upper(seq), 'ACGT', 'TGCA')) AS rc FROM reads")
def _(spark, d):
    return frame(spark, d, "reads").select("doc_id", sequence.reverse_complement(F.col("seq")).alias("rc"))


@query("read_filter", ctes("reads") + "SELECT doc_id, length(seq) AS len FROM reads WHERE length(seq) >= 100")
def _(spark, d):
    return frame(spark, d, "reads").where(F.length("seq") >= 100).select("doc_id", F.length("seq").cast("long").alias("len"))


def _kmer_ctes(k: int) -> str:
    """CTE k: the k-mers of all reads, with their positions from 0."""
    letters = ", ".join(["c", *[f"lead(c, {i}) OVER w" for i in range(1, k)]])
    return ctes("reads") + f""", l AS (SELECT doc_id, lang, unnest(string_split(seq, '')) AS c, generate_subscripts(string_split(seq, ''), 1) AS pos FROM reads),
  x AS (SELECT doc_id, lang, pos - 1 AS pos, concat({letters}) AS kmer FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY pos)), k AS (SELECT * FROM x WHERE length(kmer) = {k})"""


_KMERS = _kmer_ctes(K)


@query("kmer_count", _KMERS + " SELECT lang, kmer, count(*) AS cnt FROM k GROUP BY ALL")
def _(spark, d):
    return sequence.count_kmers(frame(spark, d, "reads"), K, "lang")


@query("kmer_pack", _KMERS + """, u AS (SELECT DISTINCT kmer FROM k) SELECT kmer, CAST(list_sum([strpos('acgt', substr(kmer, i, 1)) - 1 << (2 * (12 - i)) FOR i IN range(1, 13)]) AS BIGINT) AS packed FROM u""".replace("strpos('acgt', substr(kmer, i, 1)) - 1 <<", "(strpos('acgt', substr(kmer, i, 1)) - 1) <<"))
def _(spark, d):
    reads = frame(spark, d, "reads")
    return reads.select(F.explode(sequence.kmers(F.col("seq"), K)).alias("kmer")).distinct().select("kmer", sequence.pack(F.col("kmer")).alias("packed"))


@query("unique_kmers", _KMERS + ", n AS (SELECT lang, kmer, count(*) AS cnt FROM k GROUP BY ALL) SELECT lang, kmer, cnt FROM n WHERE kmer IN (SELECT kmer FROM n GROUP BY kmer HAVING count(*) = 1)")
def _(spark, d):
    return sequence.unique_kmers(sequence.count_kmers(frame(spark, d, "reads"), K, "lang"), "lang")


@query("kmer_overlap", _KMERS + """, n AS (SELECT lang, kmer, count(*) AS cnt FROM k GROUP BY ALL), u AS (SELECT lang, kmer, cnt FROM n WHERE kmer IN (SELECT kmer FROM n GROUP BY kmer HAVING count(*) = 1)),
  r AS (SELECT doc_id, kmer, count(*) AS c FROM k GROUP BY ALL) SELECT doc_id, lang, CAST(sum(c + cnt) AS BIGINT) AS score FROM r JOIN u USING (kmer) GROUP BY ALL""")
def _(spark, d):
    return marks.mark_scores(frame(spark, d, "reads"), K, "lang")


@query("minimizers", _kmer_ctes(15) + """, m AS (SELECT doc_id, min(concat(kmer, lpad(CAST(pos AS string), 9, '0'))) OVER w AS m, count(*) OVER w AS n FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING))
  SELECT DISTINCT doc_id, CAST(substr(m, 16) AS BIGINT) AS pos, substr(m, 1, 15) AS kmer FROM m WHERE n = 10""")
def _(spark, d):
    return sequence.minimizers(frame(spark, d, "reads"), 15, 10)


@query("edit_sim", "SELECT a.n_nationkey AS a, b.n_nationkey AS b, round((length(a.n_name) + length(b.n_name) - levenshtein(a.n_name, b.n_name)) / (length(a.n_name) + length(b.n_name)), 6) AS sim FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def _(spark, d):
    n = spark.read.parquet(f"{d}/nation.parquet")
    x, y = n.alias("x"), n.alias("y")
    return x.join(y, F.expr("x.n_regionkey = y.n_regionkey AND x.n_nationkey < y.n_nationkey")).select(F.col("x.n_nationkey").alias("a"), F.col("y.n_nationkey").alias("b"), F.round(sequence.edit_similarity(F.col("x.n_name"), F.col("y.n_name")), 6).alias("sim"))


@query("cigar_indels", ctes("cigar") + """, o AS (SELECT *, coalesce(sum(CASE WHEN op IN (0,2,3,7,8) THEN len ELSE 0 END) OVER w, 0) AS r, coalesce(sum(CASE WHEN op IN (0,1,4,7,8) THEN len ELSE 0 END) OVER w, 0) AS q
  FROM cigar WINDOW w AS (PARTITION BY aln ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) SELECT aln, CAST(r AS BIGINT) AS ref_offset, CAST(q AS BIGINT) AS query_offset, len, CASE op WHEN 1 THEN 'INS' ELSE 'DEL' END AS svtype FROM o WHERE op IN (1, 2) AND len >= 30""")
def _(spark, d):
    return cigar.indels(frame(spark, d, "cigar"), 30)


@query("query_span", ctes("cigar") + "SELECT aln, CAST(sum(CASE WHEN op IN (0,1,4,5) THEN len ELSE 0 END) AS BIGINT) AS read_len, CAST(sum(CASE WHEN op IN (0,2) THEN len ELSE 0 END) AS BIGINT) AS ref_len, count(*) AS n_ops FROM cigar GROUP BY aln")
def _(spark, d):
    return cigar.query_span(frame(spark, d, "cigar"))


_IV = ctes("calls", "sigs", "contigs") + ", a AS (SELECT svid, chrom, pos AS s, pos + svlen AS e FROM calls), b AS (SELECT chrom, pos AS s, pos + svlen AS e FROM sigs)"
_MERGED = """, mo AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS n FROM b),
  mi AS (SELECT *, sum(n) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM mo), m AS (SELECT chrom, min(s) AS s, max(e) AS e FROM mi GROUP BY chrom, g)"""


@query("interval_intersect", _IV + " SELECT svid, greatest(a.s, b.s) AS i_start, least(a.e, b.e) AS i_end FROM a JOIN b ON a.chrom = b.chrom AND a.s < b.e AND b.s < a.e")
def _(spark, d):
    return intervals.intersect(_blocks(frame(spark, d, "calls"), "svid"), _named(_blocks(frame(spark, d, "sigs")))).select("svid", "i_start", "i_end")


@query("overlay", _IV + " SELECT a.svid, g.qname, g.hp FROM a JOIN sigs g ON a.chrom = g.chrom AND a.s < g.pos + g.svlen AND g.pos < a.e")
def _(spark, d):
    return intervals.ordered_overlaps(_blocks(frame(spark, d, "calls"), "svid"), _named(_blocks(frame(spark, d, "sigs"), "qname", "hp"))).select("svid", "qname", "hp")


@query("bed_semi", _IV + " SELECT svid FROM a WHERE EXISTS (SELECT 1 FROM b WHERE a.chrom = b.chrom AND a.s < b.e AND b.s < a.e)")
def _(spark, d):
    return intervals.overlap_join(_blocks(frame(spark, d, "calls"), "svid"), _named(_blocks(frame(spark, d, "sigs")))).select("svid").distinct()


@query("merge_blocks", _IV + _MERGED + " SELECT chrom, s AS block_start, e AS block_end FROM m")
def _(spark, d):
    return intervals.merge_blocks(_blocks(frame(spark, d, "sigs"))).select("chrom", F.col("start").alias("block_start"), F.col("end").alias("block_end"))


_CUT = """, h AS (SELECT svid, a.chrom, a.s, a.e, m.s AS bs, m.e AS be FROM a JOIN m ON a.chrom = m.chrom AND a.s < m.e AND m.s < a.e),
  w AS (SELECT *, coalesce(lag(be) OVER (PARTITION BY svid ORDER BY bs), s) AS f, lead(bs) OVER (PARTITION BY svid ORDER BY bs) AS nx FROM h),
  p AS (SELECT svid, chrom, f AS s, bs AS e FROM w UNION ALL SELECT svid, chrom, be, e FROM w WHERE nx IS NULL)
  SELECT svid, chrom, s AS piece_start, e AS piece_end FROM p WHERE s < e UNION ALL SELECT svid, chrom, s, e FROM a WHERE svid NOT IN (SELECT svid FROM h)"""


@query("interval_subtract", _IV + _MERGED + _CUT)
def _(spark, d):
    out = intervals.subtract(_blocks(frame(spark, d, "calls"), "svid"), _blocks(frame(spark, d, "sigs")), "svid")
    return out.select("svid", "chrom", F.col("start").alias("piece_start"), F.col("end").alias("piece_end"))


@query("interval_complement", (_IV.replace("a AS (SELECT svid, chrom, pos AS s, pos + svlen AS e FROM calls)", "a AS (SELECT chrom AS svid, chrom, CAST(0 AS BIGINT) AS s, length AS e FROM contigs)") + _MERGED + _CUT).replace("SELECT svid, chrom, s AS piece_start", "SELECT chrom, s AS piece_start").replace("UNION ALL SELECT svid, chrom, s, e FROM a", "UNION ALL SELECT chrom, s, e FROM a"))
def _(spark, d):
    out = intervals.complement(_blocks(frame(spark, d, "sigs")), frame(spark, d, "contigs"))
    return out.select("chrom", F.col("start").alias("piece_start"), F.col("end").alias("piece_end"))


@query("multi_intersect", _IV + """, ev AS (SELECT chrom, s AS p, 1 AS d FROM b UNION ALL SELECT chrom, e, -1 FROM b), st AS (SELECT chrom, p, sum(d) AS d FROM ev GROUP BY ALL HAVING sum(d) <> 0),
  r AS (SELECT chrom, p AS s, lead(p) OVER (PARTITION BY chrom ORDER BY p) AS e, sum(d) OVER (PARTITION BY chrom ORDER BY p ROWS UNBOUNDED PRECEDING) AS depth FROM st) SELECT chrom, s AS block_start, e AS block_end, CAST(depth AS BIGINT) AS depth FROM r WHERE depth > 0""")
def _(spark, d):
    return intervals.depth(_blocks(frame(spark, d, "sigs"))).select("chrom", F.col("start").alias("block_start"), F.col("end").alias("block_end"), "depth")


@query("depth_rle", ctes("cover") + ", i AS (SELECT *, pos - row_number() OVER (PARTITION BY chrom, depth ORDER BY pos) AS g FROM cover) SELECT chrom, depth, min(pos) AS run_start, max(pos) AS run_end FROM i GROUP BY chrom, depth, g")
def _(spark, d):
    return intervals.run_lengths(frame(spark, d, "cover"), ["chrom"], "pos", "depth").select("chrom", "depth", F.col("start").cast("long").alias("run_start"), F.col("end").cast("long").alias("run_end"))


@query("gap_partitions", ctes("sigs") + """, u AS (SELECT DISTINCT * FROM sigs), p AS (SELECT *, CASE WHEN pos - lag(pos) OVER w <= 100 THEN 0 ELSE 1 END AS n FROM u WINDOW w AS (PARTITION BY chrom, svtype, hp ORDER BY pos, svlen, qname)),
  q AS (SELECT *, sum(n) OVER (PARTITION BY chrom, svtype, hp ORDER BY pos, svlen, qname ROWS UNBOUNDED PRECEDING) AS part FROM p) SELECT chrom, svtype, hp, CAST(part AS BIGINT) AS part, min(pos) AS first_pos, max(pos) AS last_pos, count(*) AS n FROM q GROUP BY ALL""")
def _(spark, d):
    parts = calling.gap_partitions(frame(spark, d, "sigs").distinct(), ["chrom", "svtype", "hp"], 100)
    return parts.groupBy("chrom", "svtype", "hp", "part").agg(F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"), F.count(F.lit(1)).alias("n"))


@query("split_pairs", ctes("sigs") + """, u AS (SELECT DISTINCT * FROM sigs), l AS (SELECT *, lead(pos) OVER w AS np, lead(svlen) OVER w AS nl FROM u WINDOW w AS (PARTITION BY hp, chrom, qname ORDER BY pos, svlen, svtype)) SELECT hp, chrom, qname, pos, np AS next_pos, np - pos - svlen AS gap FROM l WHERE np IS NOT NULL""")
def _(spark, d):
    w = W.partitionBy("hp", "chrom", "qname").orderBy("pos", "svlen", "svtype")
    rows = frame(spark, d, "sigs").distinct().withColumn("next_pos", F.lead("pos").over(w)).where("next_pos IS NOT NULL")
    return rows.select("hp", "chrom", "qname", "pos", "next_pos", (F.col("next_pos") - F.col("pos") - F.col("svlen")).alias("gap"))


@query("phase_extent", ctes("reads") + "SELECT source, min(length(seq)) AS low, max(length(seq)) AS high, count(*) AS n FROM reads GROUP BY source")
def _(spark, d):
    r = frame(spark, d, "reads").withColumn("len", F.length("seq").cast("long"))
    return r.groupBy("source").agg(F.min("len").alias("low"), F.max("len").alias("high"), F.count(F.lit(1)).alias("n"))


@query("cov_hist", ctes("cover") + "SELECT depth, count(*) AS freq FROM cover GROUP BY depth")
def _(spark, d):
    return frame(spark, d, "cover").groupBy("depth").agg(F.count(F.lit(1)).alias("freq"))


@query("mean_sd", ctes("cover") + """, h AS (SELECT chrom, depth, count(*) AS n FROM cover GROUP BY ALL), m AS (SELECT chrom, sum(depth * n) / sum(n) AS mean, sum(n) AS total FROM h GROUP BY chrom)
  SELECT chrom, round(mean, 6) AS mean, round(sqrt(sum(CASE WHEN depth < 2.5 * mean THEN n * (depth - mean) * (depth - mean) ELSE 0 END) / max(total)), 6) AS sd FROM h JOIN m USING (chrom) GROUP BY chrom, mean""")
def _(spark, d):
    h = frame(spark, d, "cover").groupBy("chrom", "depth").agg(F.count(F.lit(1)).alias("n"))
    m = h.groupBy("chrom").agg((F.sum(F.col("depth") * F.col("n")) / F.sum("n")).alias("mean"), F.sum("n").alias("total"))
    far = F.col("depth") - F.col("mean")
    sd = F.sqrt(F.sum(F.when(F.col("depth") < 2.5 * F.col("mean"), F.col("n") * far * far).otherwise(0)) / F.max("total"))
    return h.join(m, "chrom").groupBy("chrom", "mean").agg(F.round(sd, 6).alias("sd")).select("chrom", F.round("mean", 6).alias("mean"), "sd")


@query("label_stats", ctes("sigs") + ", t AS (SELECT coalesce(svtype, 'Total') AS label, CAST(sum(svlen) AS BIGINT) AS size FROM sigs GROUP BY ROLLUP(svtype)) SELECT label, size, round(100.0 * size / max(size) OVER (), 6) AS percent FROM t")
def _(spark, d):
    t = frame(spark, d, "sigs").rollup("svtype").agg(F.sum("svlen").alias("size")).select(F.coalesce("svtype", F.lit("Total")).alias("label"), "size")
    return t.withColumn("percent", F.round(100.0 * F.col("size") / F.max("size").over(W.partitionBy(F.lit(1))), 6))


_LEN = ctes("reads") + ", h AS (SELECT length(seq) AS len, count(*) AS n FROM reads GROUP BY ALL), c AS (SELECT *, sum(n) OVER (ORDER BY len) AS cn, sum(len * n) OVER (ORDER BY len DESC) AS cb, sum(n) OVER () AS tn, sum(len * n) OVER () AS tb FROM h)"


@query("read_stats", _LEN + " SELECT CAST(max(tn) AS BIGINT) AS n, CAST(max(tb) AS BIGINT) AS total_bp, min(len) AS min_len, max(len) AS max_len, CAST(floor(max(tb) / max(tn)) AS BIGINT) AS mean_len, min(CASE WHEN cn >= 0.25 * tn THEN len END) AS q1, min(CASE WHEN cn >= 0.5 * tn THEN len END) AS q2, min(CASE WHEN cn >= 0.75 * tn THEN len END) AS q3 FROM c")
def _(spark, d):
    h = frame(spark, d, "reads").groupBy(F.length("seq").cast("long").alias("len")).agg(F.count(F.lit(1)).alias("n"))
    one = W.partitionBy(F.lit(1))
    c = h.withColumn("cn", F.sum("n").over(one.orderBy("len"))).withColumn("tn", F.sum("n").over(one)).withColumn("tb", F.sum(F.col("len") * F.col("n")).over(one))
    at = lambda q: F.min(F.when(F.col("cn") >= q * F.col("tn"), F.col("len")))
    return c.agg(F.max("tn").alias("n"), F.max("tb").alias("total_bp"), F.min("len").alias("min_len"), F.max("len").alias("max_len"), F.floor(F.max("tb") / F.max("tn")).alias("mean_len"), at(0.25).alias("q1"), at(0.5).alias("q2"), at(0.75).alias("q3"))


@query("n50", _LEN + " SELECT x AS nx, max(CASE WHEN cb * 100 >= x * tb THEN len END) AS length FROM c, (SELECT unnest([10, 20, 30, 40, 50, 60, 70, 80, 90]) AS x) GROUP BY x")
def _(spark, d):
    h = frame(spark, d, "reads").groupBy(F.length("seq").cast("long").alias("len")).agg(F.count(F.lit(1)).alias("n"))
    one = W.partitionBy(F.lit(1))
    c = h.withColumn("cb", F.sum(F.col("len") * F.col("n")).over(one.orderBy(F.desc("len")))).withColumn("tb", F.sum(F.col("len") * F.col("n")).over(one))
    c = c.withColumn("nx", F.explode(F.array(*[F.lit(x) for x in range(10, 100, 10)])))
    return c.groupBy("nx").agg(F.max(F.when(F.col("cb") * 100 >= F.col("nx") * F.col("tb"), F.col("len"))).alias("length"))


@query("fixed_histogram", ctes("calls") + "SELECT CASE WHEN svlen = 1000 THEN 9 ELSE CAST(floor(svlen / 100.0) AS INT) END AS bin, count(*) AS n FROM calls WHERE svlen BETWEEN 0 AND 1000 GROUP BY ALL")
def _(spark, d):
    b = F.when(F.col("svlen") == 1000, 9).otherwise(F.floor(F.col("svlen") / 100.0)).cast("int")
    return frame(spark, d, "calls").where("svlen BETWEEN 0 AND 1000").groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("dedup_names", "SELECT conv_id, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn, text) AS rk FROM conversations) WHERE rk = 1")
def _(spark, d):
    t = spark.read.parquet(f"{d}/conversations.parquet")
    return t.withColumn("rk", F.row_number().over(W.partitionBy("conv_id", "role").orderBy("turn", "text"))).where("rk = 1").select("conv_id", "role", "text")


@query("seed_clusters")
def _(spark, d):
    return greedy.seed_clusters(frame(spark, d, "sigs"))


@query("hap_pair")
def _(spark, d):
    """Haplotype pairing of the clustered signatures of both haplotypes; SQL has no greedy matching."""
    clusters = greedy.seed_clusters(frame(spark, d, "sigs"))
    return greedy.pair_haplotypes(clusters.where("hp = 'hp1'"), clusters.where("hp = 'hp2'"))


_SEGMENTS = ctes("cigar") + """, m AS (SELECT *, coalesce(sum(CASE WHEN op IN (0,2,3,7,8) THEN len ELSE 0 END) OVER w, 0) AS r, coalesce(sum(CASE WHEN op IN (0,1,4,7,8) THEN len ELSE 0 END) OVER w, 0) AS q
  FROM cigar WINDOW w AS (PARTITION BY aln ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), seg AS (SELECT aln, op, r AS r_start, r + len AS r_end, q AS q_start, q + len AS q_end FROM m WHERE op IN (0, 7, 8) AND len > 0)"""


@query("cigar_segments", _SEGMENTS + " SELECT aln, CAST(r_start AS BIGINT) AS r_start, CAST(r_end AS BIGINT) AS r_end, CAST(q_start AS BIGINT) AS q_start, CAST(q_end AS BIGINT) AS q_end FROM seg")
def _(spark, d):
    return cigar.segments(frame(spark, d, "cigar")).drop("op")


@query("liftover", _SEGMENTS + """, b AS (SELECT DISTINCT aln, aln % 40 AS s, aln % 40 + 30 AS e FROM cigar)
  SELECT b.aln AS aln, CAST(min(greatest(s, r_start)) AS BIGINT) AS from_start, CAST(max(least(e, r_end)) AS BIGINT) AS from_end, CAST(min(greatest(s, r_start) + q_start - r_start) AS BIGINT) AS to_start,
  CAST(max(least(e, r_end) + q_start - r_start) AS BIGINT) AS to_end, CAST(sum(least(e, r_end) - greatest(s, r_start)) AS BIGINT) AS n_aligned FROM b JOIN seg ON b.aln = seg.aln AND s < r_end AND r_start < e GROUP BY b.aln""")
def _(spark, d):
    ops = frame(spark, d, "cigar")
    blocks = ops.select("aln", F.col("aln").alias("block"), (F.col("aln") % 40).alias("start"), (F.col("aln") % 40 + 30).alias("end")).distinct()
    return cigar.lift(blocks, cigar.segments(ops), "block").drop("block")


@query("chunk_sequences", ctes("reads") + """, c AS (SELECT doc_id, seq, unnest(range(1, CAST(greatest(ceil(length(seq) / 1000), 1) AS BIGINT) + 1)) AS chunk FROM reads)
  SELECT doc_id, chunk, substr(seq, (chunk - 1) * 1000 + 1, 1010) AS seq FROM c""")
def _(spark, d):
    reads = frame(spark, d, "reads").select(F.col("doc_id").alias("name"), "seq")
    return formats.chunks(reads, 1000, 10).select(F.col("name").alias("doc_id"), "chunk", "seq")


@query("contig_header", ctes("contigs") + "SELECT chrom, concat('##contig=<ID=', chrom, ',length=', length, '>') AS line FROM contigs WHERE regexp_full_match(chrom, 'chr[0-9]')")
def _(spark, d):
    return formats.contig_header(frame(spark, d, "contigs"), "chr[0-9]")


_REDUNDANT = ctes("calls", "alts").replace("WITH ", "WITH RECURSIVE ", 1) + """, v AS (SELECT * FROM calls JOIN alts USING (svid)),
  e AS (SELECT a.svid AS a, b.svid AS b FROM v a JOIN v b ON a.chrom = b.chrom AND a.svtype = b.svtype AND a.svid <> b.svid AND CASE WHEN a.svtype = 'DEL'
    THEN abs(a.pos - b.pos) <= 3000 AND least(a.svlen, b.svlen) * 10 >= greatest(a.svlen, b.svlen) AND least(a.pos + a.svlen, b.pos + b.svlen) >= greatest(a.pos, b.pos)
    ELSE abs(a.pos - b.pos) <= 500 AND least(a.svlen, b.svlen) * 2 >= greatest(a.svlen, b.svlen) AND (length(a.alt) + length(b.alt) - levenshtein(a.alt, b.alt)) / (length(a.alt) + length(b.alt)) >= 0.5 END),
  r AS (SELECT DISTINCT a AS node, a AS seen FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a), l AS (SELECT node AS svid, min(seen) AS label FROM r GROUP BY node)"""


@query("redundancy_components", _REDUNDANT + " SELECT svid AS node, label FROM l")
def _(spark, d):
    calls = frame(spark, d, "calls").join(frame(spark, d, "alts"), "svid")
    return calling.redundancy_labels(calls)


@query("redundancy_collapse", _REDUNDANT + """ SELECT svid, CASE WHEN label IS NOT NULL THEN concat(svtype, ':', label) END AS collapse_id, label IS NULL OR row_number() OVER (PARTITION BY label ORDER BY svlen DESC, svid) = 1 AS kept FROM v LEFT JOIN l USING (svid)""")
def _(spark, d):
    calls = frame(spark, d, "calls").join(frame(spark, d, "alts"), "svid")
    return calling.collapse_redundant(calls).select("svid", "collapse_id", "kept")


from helixframe.plans import clusters, more, wider  # noqa: E402, F401
