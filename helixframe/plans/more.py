"""Further queries of the catalogue: split alignments, variant records, scalar functions, coverage tables and k-mer evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.functions import scores
from helixframe.operators import assignment, coverage, sequence, splits, variants
from helixframe.plans.adapters import ctes, frame
from helixframe.plans.registry import query


def longs(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("long") for n in names})


_RB = "CASE WHEN arg_{0}(op, idx) IN ({1}) THEN arg_{0}(len, idx) ELSE 0 END"


@query("read_bounds", ctes("cigar") + f"""SELECT aln, CAST({_RB.format('min', '5')} AS BIGINT) AS head_hard, CAST(sum(CASE WHEN op IN (0, 1, 4, 5) THEN len ELSE 0 END) AS BIGINT) AS read_len, CAST({_RB.format('min', '4, 5')} AS BIGINT) AS q_start,
  CAST(sum(CASE WHEN op IN (0, 1, 4, 5) THEN len ELSE 0 END) - {_RB.format('max', '4, 5')} AS BIGINT) AS q_end FROM cigar GROUP BY aln""")
def _(spark, d):
    return splits.read_bounds(frame(spark, d, "cigar"))


@query("noisy_read_filter", ctes("cigar") + """, s AS (SELECT aln, sum(CASE WHEN op = 1 THEN len ELSE 0 END) AS i, sum(CASE WHEN op = 0 THEN len ELSE 0 END) AS m, count(*) FILTER (WHERE op = 0) AS n FROM cigar GROUP BY aln)
  SELECT aln, round(i / (m + i), 6) AS ins_share, round(m / n, 6) AS mean_run FROM s WHERE (m + i > 0 AND i / (m + i) <= 0.13) OR (n > 0 AND m / n >= 20)""")
def _(spark, d):
    return splits.noisy_read_filter(frame(spark, d, "cigar"), least_run=20).select("aln", F.round("ins_share", 6).alias("ins_share"), F.round("mean_run", 6).alias("mean_run"))


_SAM = "SELECT DISTINCT aln, CAST(CASE aln % 5 WHEN 0 THEN 0 WHEN 1 THEN 16 WHEN 2 THEN 256 WHEN 3 THEN 2064 ELSE 2048 END AS BIGINT) AS flag, aln % 61 AS mapq FROM cigar"


def _sam(spark, d) -> DataFrame:
    return spark.sql(_SAM.replace("FROM cigar", "FROM {c}"), c=frame(spark, d, "cigar"))


@query("assembly_aln_filter", ctes("cigar") + f", s AS ({_SAM}), b AS (SELECT aln, CAST(sum(len) AS BIGINT) AS block FROM cigar WHERE op IN (0, 1, 2) GROUP BY aln) SELECT s.aln, flag, mapq, block FROM s JOIN b USING (aln) WHERE flag & 256 = 0 AND mapq >= 5 AND block >= 60")
def _(spark, d):
    return splits.assembly_alignment_filter(_sam(spark, d), frame(spark, d, "cigar"), least_block=60)


@query("flag_decode", ctes("cigar") + f", s AS ({_SAM}) SELECT aln, CAST(CASE flag WHEN 0 THEN 1 WHEN 16 THEN 2 WHEN 2048 THEN 3 WHEN 2064 THEN 4 ELSE 0 END AS BIGINT) AS kind FROM s")
def _(spark, d):
    return _sam(spark, d).select("aln", splits.flag_class(F.col("flag")).cast("long").alias("kind"))


@query("aln_filter", ctes("alns", "calls") + """, a AS (SELECT *, concat(chrom, '_hp', CAST(is_reverse + 1 AS string)) AS hp FROM alns), r AS (SELECT chrom, greatest(pos - 1000, 0) AS s, pos + svlen + 1000 AS e FROM calls WHERE svlen > 900)
  SELECT chrom, ref_start, ref_end, qname FROM a WHERE mapq >= 20 AND ref_end - ref_start >= 1000 AND hp LIKE '%hp1%' AND EXISTS (SELECT 1 FROM r WHERE r.chrom = a.chrom AND a.ref_start < r.e AND r.s < a.ref_end)""")
def _(spark, d):
    alns = frame(spark, d, "alns").withColumn("hp", F.concat("chrom", F.lit("_hp"), (F.col("is_reverse") + 1).cast("string")))
    regions = frame(spark, d, "calls").where("svlen > 900").select("chrom", F.col("pos").alias("start"), (F.col("pos") + F.col("svlen")).alias("end"))
    return splits.filter_alignments(alns, regions, 20, 1000, "hp1").select("chrom", "ref_start", "ref_end", "qname")


_CS = "SELECT p_partkey AS k, concat(':', CAST(p_size AS string), '*ac', '+', substr('gattaca', 1, CAST(p_partkey % 7 + 1 AS int)), ':', CAST(p_partkey % 50 + 1 AS string), '-', substr('acgtacgt', 1, CAST(p_size % 8 + 1 AS int)), '*gt') AS cs FROM part"


@query("cs_operations", f"""WITH c AS ({_CS}), x AS (SELECT k, unnest(regexp_extract_all(cs, '(:[0-9]+|\\*[a-zA-Z][a-zA-Z]|[=+-][A-Za-z]+)')) AS p, generate_subscripts(regexp_extract_all(cs, '(:[0-9]+|\\*[a-zA-Z][a-zA-Z]|[=+-][A-Za-z]+)'), 1) - 1 AS idx FROM c)
  SELECT k, idx, p[1] AS op, CAST(CASE p[1] WHEN ':' THEN CAST(p[2:] AS BIGINT) WHEN '*' THEN 1 ELSE length(p) - 1 END AS BIGINT) AS letters FROM x""")
def _(spark, d):
    return longs(splits.difference_operations(spark.sql(_CS.replace("FROM part", "FROM {p}"), p=spark.read.parquet(f"{d}/part.parquet")), "k"), "idx")


_SA = """SELECT p_partkey AS k, concat('chr', CAST(p_size % 22 + 1 AS string), ',', CAST(p_partkey * 10 AS string), ',', CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END, ',', CAST(p_size AS string), 'S100M,', CAST(p_size % 30 - 5 AS string), ',3;bad,1,2;chrX,',
  CAST(p_partkey AS string), ',-,50M7S,60,0;') AS sa FROM part"""


@query("sa_tag_explode", f"""WITH s AS ({_SA}), x AS (SELECT k, unnest(string_split(sa, ';')) AS e, generate_subscripts(string_split(sa, ';'), 1) - 1 AS idx FROM s), f AS (SELECT k, idx, string_split(e, ',') AS f FROM x)
  SELECT k, idx, f[1] AS chrom, CAST(f[2] AS BIGINT) AS pos, CAST(CASE f[3] WHEN '-' THEN 2064 ELSE 2048 END AS BIGINT) AS flag, f[4] AS cigar, CAST(greatest(CAST(f[5] AS INT), 0) AS BIGINT) AS mapq, CAST(f[6] AS BIGINT) AS edits FROM f WHERE len(f) = 6""")
def _(spark, d):
    return longs(splits.supplementary_alignments(spark.sql(_SA.replace("FROM part", "FROM {p}"), p=spark.read.parquet(f"{d}/part.parquet")), "k"), "idx", "flag", "mapq", "edits")


#: Written from the case tree of four orientations; the operator works with exit and entry ends instead.
_SPLIT = ctes("segs") + """, n AS (SELECT *, lead(q_start) OVER w AS nq, lead(chrom) OVER w AS nc, lead(ref_start) OVER w AS ns, lead(ref_end) OVER w AS ne, lead(is_reverse) OVER w AS nr FROM segs WINDOW w AS (PARTITION BY qname ORDER BY q_start, q_end, chrom, ref_start, ref_end, is_reverse)),
  g AS (SELECT *, nq - q_end AS gap, CASE WHEN NOT is_reverse AND NOT nr THEN ns - ref_end WHEN is_reverse AND nr THEN ref_start - ne WHEN NOT is_reverse THEN ne - ref_end ELSE ns - ref_start END AS dist FROM n WHERE nq IS NOT NULL),
  v AS (SELECT *, gap - dist AS dev, ns - ref_end >= -50 AS ahead, ref_start - ne >= -50 AS behind FROM g),
  c AS (SELECT *, CASE WHEN chrom <> nc THEN CASE WHEN gap BETWEEN -50 AND 50 THEN 'BND' END
    WHEN is_reverse = nr THEN CASE WHEN gap < -50 THEN NULL WHEN dist >= -50 THEN CASE WHEN dev >= 40 THEN CASE WHEN dist <= 50 THEN 'INS' END WHEN dev <= -40 AND dev >= -100000 THEN CASE WHEN gap <= 50 THEN 'DEL' END WHEN dev < -100000 AND gap <= 50 THEN 'BND' END
      WHEN gap <= 50 AND dev >= 40 THEN CASE WHEN (NOT is_reverse AND ne > ref_start) OR (is_reverse AND ns < ref_end) THEN 'DUPf' WHEN dist >= -100000 THEN 'DUPp' ELSE 'BND' END END
    WHEN gap BETWEEN -50 AND 50 THEN CASE WHEN ahead THEN CASE WHEN -dev BETWEEN 40 AND 100000 THEN 'INVa' ELSE 'BND' END WHEN behind THEN CASE WHEN dev BETWEEN 40 AND 100000 THEN 'INVb' ELSE 'BND' END END END AS k FROM v)
  SELECT qname, q_start, CASE WHEN k LIKE 'DUP%' THEN 'DUP' WHEN k LIKE 'INV%' THEN 'INV' ELSE k END AS kind, chrom,
    CASE k WHEN 'INS' THEN CASE WHEN is_reverse THEN ref_start ELSE ref_end END WHEN 'DEL' THEN CASE WHEN is_reverse THEN ne ELSE ref_end END WHEN 'BND' THEN CASE WHEN is_reverse THEN ref_start ELSE ref_end - 1 END
      WHEN 'INVa' THEN CASE WHEN is_reverse THEN ref_start ELSE ref_end END WHEN 'INVb' THEN CASE WHEN is_reverse THEN ns ELSE ne END ELSE CASE WHEN is_reverse THEN ref_start ELSE ns END END AS v_start,
    CASE WHEN k = 'BND' THEN nc ELSE chrom END AS chrom2,
    CASE k WHEN 'INS' THEN CASE WHEN is_reverse THEN ref_start ELSE ref_end END + dev WHEN 'DEL' THEN CASE WHEN is_reverse THEN ne ELSE ref_end END - dev WHEN 'BND' THEN CASE WHEN nr THEN ne - 1 ELSE ns END
      WHEN 'INVa' THEN CASE WHEN is_reverse THEN ref_start ELSE ref_end END - dev WHEN 'INVb' THEN CASE WHEN is_reverse THEN ns ELSE ne END + dev ELSE CASE WHEN is_reverse THEN ref_start ELSE ns END + dev END AS v_end,
    CASE k WHEN 'DUPf' THEN 'full' WHEN 'DUPp' THEN 'partial' WHEN 'INVa' THEN CASE WHEN is_reverse THEN 'right_fwd' ELSE 'left_fwd' END WHEN 'INVb' THEN CASE WHEN is_reverse THEN 'right_rev' ELSE 'left_rev' END
      WHEN 'BND' THEN concat(CASE WHEN is_reverse THEN 'rev' ELSE 'fwd' END, '-', CASE WHEN nr THEN 'rev' ELSE 'fwd' END) ELSE '' END AS detail FROM c WHERE k IS NOT NULL"""


@query("split_classify", _SPLIT)
def _(spark, d):
    return splits.classify_segments(frame(spark, d, "segs")).withColumnsRenamed({"start": "v_start", "end": "v_end"})


_SP = ctes("segs") + ", p AS (SELECT qname, ref_end AS r1, lead(ref_start) OVER w AS r2, q_end AS a, lead(q_start) OVER w AS b FROM segs WINDOW w AS (PARTITION BY qname, chrom ORDER BY ref_start, q_start, ref_end)), x AS (SELECT *, (r2 - r1) - (b - a) AS dd, r1 - r2 AS ro, a - b AS qo FROM p WHERE r2 IS NOT NULL)"


def _split_pairs(spark, d) -> DataFrame:
    # The SQL's order leaves segments that differ only in q_end tied; q_end settles them, so that runs agree.
    rows = splits.adjacent(frame(spark, d, "segs"), ["qname", "chrom"], ["ref_start", "q_start", "ref_end", "q_end"], ["ref_start", "q_start"])
    return rows.select("qname", F.col("ref_end").alias("ref1_end"), F.col("n_ref_start").alias("ref2_start"), F.col("q_end").alias("read1_end"), F.col("n_q_start").alias("read2_start"))


@query("contig_split_hifi", _SP + """ SELECT qname, 'DEL' AS svtype, r1 - CAST(trunc(qo / 2) AS BIGINT) AS pos, dd AS svlen FROM x WHERE dd >= 30 AND dd <= 50000 AND abs(qo) <= 3000
  UNION ALL SELECT qname, 'INS', CASE WHEN abs(ro) > 400 THEN CAST(floor((r1 + r2) / 2) AS BIGINT) ELSE r2 END, abs(b - a + ro) FROM x WHERE dd <= -30 AND dd >= -50000 AND ro < 3000""")
def _(spark, d):
    return splits.contig_split_indels(_split_pairs(spark, d))


@query("contig_split_clr", _SP + """ SELECT qname, 'DEL' AS svtype, r1 AS pos, dd AS svlen FROM x WHERE dd >= 30 AND dd <= 50000 AND abs(qo) <= 0.3 * dd
  UNION ALL SELECT qname, 'INS', CASE WHEN abs(ro) > 400 THEN CAST(floor((r1 + r2) / 2) AS BIGINT) ELSE r2 END, abs(b - a + ro) FROM x WHERE dd <= -30 AND dd >= -50000 AND abs(ro) <= 0.3 * abs(dd)""")
def _(spark, d):
    return splits.contig_split_indels(_split_pairs(spark, d), "CLR")


@query("read_split_indels", _SP + " SELECT qname, CASE WHEN dd > 0 THEN 'DEL' ELSE 'INS' END AS svtype, CASE WHEN dd > 0 THEN r1 ELSE CAST(floor((r1 + r2) / 2) AS BIGINT) END AS pos, abs(dd) AS svlen FROM x WHERE abs(dd) BETWEEN 30 AND 50000 AND ro < 30")
def _(spark, d):
    return splits.read_split_indels(_split_pairs(spark, d))


@query("combine_sigs", ctes("sigs") + """, t AS (SELECT DISTINCT concat('q', CAST(pos % 40 AS string)) AS qname, chrom, pos, svlen FROM sigs WHERE svtype = 'DEL'), l AS (SELECT *, lag(pos + svlen) OVER w AS e FROM t WINDOW w AS (PARTITION BY qname, chrom ORDER BY pos, svlen)),
  i AS (SELECT *, sum(CASE WHEN pos - e <= 500 THEN 0 ELSE 1 END) OVER (PARTITION BY qname, chrom ORDER BY pos, svlen ROWS UNBOUNDED PRECEDING) AS part FROM l) SELECT qname, chrom, 'DEL' AS svtype, min(pos) AS pos, CAST(sum(svlen) AS BIGINT) AS svlen, count(*) AS n FROM i GROUP BY qname, chrom, part""")
def _(spark, d):
    sigs = frame(spark, d, "sigs").where("svtype = 'DEL'").select(F.concat(F.lit("q"), (F.col("pos") % 40).cast("string")).alias("qname"), "chrom", "pos", "svlen").distinct()
    return splits.combine_signatures(sigs, "DEL", 500)


@query("split_reads", ctes("alns") + "SELECT chrom, qname, count(*) AS n FROM alns GROUP BY ALL HAVING count(*) > 1")
def _(spark, d):
    return splits.split_reads(frame(spark, d, "alns"))


@query("size_filter", ctes("records") + "SELECT id, abs(length(alt) - length(ref)) AS size FROM records WHERE abs(length(alt) - length(ref)) BETWEEN 2 AND 50")
def _(spark, d):
    r = frame(spark, d, "records").where(variants.size_between(F.col("ref"), F.col("alt")))
    return r.select("id", F.abs(F.length("alt") - F.length("ref")).cast("long").alias("size"))


_MULTI = """SELECT concat('chr', CAST(p_partkey % 5 + 1 AS string)) AS chrom, p_partkey * 37 % 100000 AS pos, CASE p_size % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'AC,*' ELSE 'T,GG,C' END AS alt,
  CASE p_size % 3 WHEN 0 THEN 'SVTYPE=INS' WHEN 1 THEN 'SVTYPE=DEL,x' ELSE 'a,SVTYPE=INS,b' END AS info FROM part"""


@query("split_multiallelic", f"""WITH r AS ({_MULTI}), x AS (SELECT chrom, pos, info, unnest(string_split(alt, ',')) AS a, generate_subscripts(string_split(alt, ','), 1) AS i FROM r), y AS (SELECT chrom, pos, i - 1 AS allele_no, a AS alt, CASE WHEN contains(info, ',') THEN string_split(info, ',')[i] ELSE info END AS info FROM x WHERE a <> '*'),
  z AS (SELECT *, CASE WHEN contains(info, 'SVTYPE=INS') THEN 'INS' WHEN contains(info, 'SVTYPE=DEL') THEN 'DEL' ELSE 'SNP' END AS t FROM y) SELECT chrom, pos, allele_no, alt, info, concat(chrom, '-', t, '-', row_number() OVER (PARTITION BY chrom, t ORDER BY pos, allele_no, alt), '-', pos) AS id FROM z""")
def _(spark, d):
    return longs(variants.split_alleles(spark.sql(_MULTI.replace("FROM part", "FROM {p}"), p=spark.read.parquet(f"{d}/part.parquet"))), "allele_no")


@query("phase_gt", ctes("records") + "SELECT id, CASE WHEN gt = '1/1' THEN '1|1' WHEN contains(tig, 'hp1') THEN '1|0' ELSE '0|1' END AS phased, regexp_extract(tig, '^PS([0-9]+)_', 1) AS ps FROM records")
def _(spark, d):
    gt, ps = variants.phase_by_contig(F.col("gt"), F.col("tig"))
    return frame(spark, d, "records").select("id", gt.alias("phased"), ps.alias("ps"))


@query("phase_complex", ctes("records") + "SELECT id, replace(gt, '/', '|') AS phased, regexp_extract(tig, 'PS([0-9]+)', 1) AS ps, concat('END=', CAST(pos AS string), ';PS=', regexp_extract(tig, 'PS([0-9]+)', 1)) AS info FROM records")
def _(spark, d):
    gt, ps = variants.phase_complex(F.col("gt"), F.col("tig"))
    return frame(spark, d, "records").select("id", gt.alias("phased"), ps.alias("ps"), variants.with_info(F.concat(F.lit("END="), F.col("pos").cast("string")), "PS", ps).alias("info"))


@query("record_names", ctes("records") + """SELECT id, regexp_replace(tig, '_[^_]*$', '') AS hap, CAST(regexp_extract(chrom, '([0-9]+)', 1) AS BIGINT) AS ord, concat('ctg', CAST(id % 7 AS string)) AS contig, CAST(pos + id % 1000 AS BIGINT) AS w_start, CAST(pos + 50 + id % 1000 AS BIGINT) AS w_end,
  concat(gt, ':', CAST(id % 9 AS string)) AS sample, concat(CAST(greatest(CAST(round_even((pos + 500) / 1000, 0) AS BIGINT), 10) AS string), 'k') AS gsize FROM records""")
def _(spark, d):
    r = frame(spark, d, "records")
    name, start, end = variants.window_coordinates(F.concat(F.lit("ctg"), (F.col("id") % 7).cast("string"), F.lit(":"), (F.col("id") % 1000).cast("string"), F.lit("-5000")), F.col("pos"), F.col("pos") + 50)
    sample = variants.phase_set_genotype(F.concat_ws(":", "gt", F.lit("12"), F.lit("0,3"), (F.col("id") % 9).cast("string")))
    return r.select("id", variants.contig_haplotype(F.col("tig")).alias("hap"), variants.contig_order(F.col("chrom")).cast("long").alias("ord"), name.alias("contig"), start.alias("w_start"), end.alias("w_end"), sample.alias("sample"), scores.genome_size_label(F.lit(0), F.col("pos") + 500).alias("gsize"))


@query("bnd_alt", ctes("records") + """, a AS (SELECT id, concat(CASE WHEN id % 4 IN (0, 1) THEN 'N' ELSE '' END, CASE WHEN id % 2 = 0 THEN '[' ELSE ']' END, chrom, ':', CAST(pos AS string), CASE WHEN id % 2 = 0 THEN '[' ELSE ']' END, CASE WHEN id % 4 IN (0, 1) THEN '' ELSE 'N' END) AS alt, chrom, pos FROM records)
  SELECT id, alt, chrom, pos, CASE WHEN contains(alt, '[') THEN '[' ELSE ']' END AS bracket, alt[1] = 'N' AS first FROM a""")
def _(spark, d):
    alt = variants.breakend_alt(F.col("chrom"), F.col("pos"), F.col("id") % 4 < 2, F.col("id") % 2 == 0)
    r = frame(spark, d, "records").select("id", alt.alias("alt"))
    return r.select("id", "alt", *[c.alias(n) for n, c in variants.parse_breakend(F.col("alt")).items()])


@query("allele_slice", ctes("reads") + """, c AS (SELECT doc_id, seq, doc_id % 20 AS s, CAST(10 + doc_id % 15 AS BIGINT) AS n, doc_id % 2 = 0 AS ins, doc_id % 4 = 0 AS neg FROM reads WHERE length(seq) > 100),
  p AS (SELECT *, CASE WHEN neg THEN reverse(translate(upper(substr(seq, length(seq) - s - n + 1, n)), 'ACGT', 'TGCA')) ELSE upper(substr(seq, s + 1, n)) END AS part, upper(substr(seq, greatest(s, 1), 1)) AS anchor FROM c)
  SELECT doc_id AS svid, CASE WHEN ins THEN anchor ELSE concat(anchor, part) END AS ref, CASE WHEN ins THEN concat(anchor, part) ELSE anchor END AS alt FROM p""")
def _(spark, d):
    reads = frame(spark, d, "reads").where("length(seq) > 100").select(F.col("doc_id").alias("contig"), "seq")
    calls = reads.select(F.col("contig").alias("svid"), "contig", (F.col("contig") % 20).alias("start"), (10 + F.col("contig") % 15).alias("svlen"), F.when(F.col("contig") % 2 == 0, "INS").otherwise("DEL").alias("svtype"), F.when(F.col("contig") % 4 == 0, "-").otherwise("+").alias("strand"))
    return variants.allele_sequences(calls, reads)


@query("pair_scores", ctes("pairs") + """, o AS (SELECT *, least(e1, e2) - greatest(s1, s2) AS ov FROM pairs) SELECT k, i, round(ov / greatest(e1 - s1, e2 - s2), 6) AS by_longer, round(ov / least(e1 - s1, e2 - s2), 6) AS by_shorter,
  round(CASE WHEN w1 = w2 OR ov <= 0 THEN 1.0 ELSE 1 - least(ov / (e1 - s1), ov / (e2 - s2)) END, 6) AS inv_distance, CAST(least(abs(s1 - s2), abs(e1 - e2), abs((s1 + e1) // 2 - (s2 + e2) // 2)) AS BIGINT) AS pos_distance,
  abs(s1 - s2) < 20 AND abs(e1 - e2) < 20 AS similar, round(least(e1 - s1, e2 - s2) / greatest(e1 - s1, e2 - s2), 6) AS size_sim FROM o""")
def _(spark, d):
    a, b = (F.col("s1"), F.col("e1")), (F.col("s2"), F.col("e2"))
    r6 = lambda c: F.round(c, 6)
    return frame(spark, d, "pairs").select("k", "i", r6(scores.overlap_ratio(*a, *b)).alias("by_longer"), r6(scores.overlap_ratio(*a, *b, of="shorter")).alias("by_shorter"), r6(scores.reciprocal_overlap_distance(*a, F.col("w1"), *b, F.col("w2"))).alias("inv_distance"),
        scores.position_distance(*a, *b).alias("pos_distance"), scores.is_similar(*a, *b).alias("similar"), r6(sequence.size_similarity(a[1] - a[0], b[1] - b[0])).alias("size_sim"))


@query("jaro_sim", "SELECT a.n_nationkey AS a, b.n_nationkey AS b, round(jaro_similarity(a.n_name, b.n_name), 6) AS sim FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def _(spark, d):
    n = spark.read.parquet(f"{d}/nation.parquet")
    x, y = n.alias("x"), n.alias("y")
    pairs = x.join(y, F.expr("x.n_regionkey = y.n_regionkey AND x.n_nationkey < y.n_nationkey")).select(F.col("x.n_nationkey").alias("a"), F.col("y.n_nationkey").alias("b"), F.col("x.n_name").alias("p"), F.col("y.n_name").alias("q"))
    return pairs.select("a", "b", F.round(scores.jaro_similarity(F.col("p"), F.col("q")), 6).alias("sim"))


@query("densities", """WITH x AS (SELECT p_partkey AS k, p_size AS n FROM part) SELECT k, round(exp(-(n - 20.0) * (n - 20.0) / 50) / (5 * sqrt(2 * pi())), 9) AS normal, round(CASE WHEN n <= 30 THEN 0.1 * exp(-0.1 * n) / (1 - exp(-3.0)) ELSE 0 END, 9) AS exponential,
  round(exp(n * ln(12.0) - 12 - lgamma(n + 1)), 9) AS poisson FROM x""")
def _(spark, d):
    x = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("n"))
    r9 = lambda c, n: F.round(c, 9).alias(n)
    return x.select("k", r9(scores.normal_density(F.col("n"), 20.0, 5.0), "normal"), r9(scores.truncated_exponential_density(F.col("n"), 0.1, 30.0), "exponential"), r9(scores.poisson_density(F.col("n"), 12.0), "poisson"))


@query("divergence_mapq", """WITH x AS (SELECT p_partkey AS k, p_size AS e, p_partkey % 1000 + 200 AS n FROM part), t AS (SELECT k, e, n * 0.02 AS m, list_sum([exp(i * ln(n * 0.02) - n * 0.02 - lgamma(i + 1)) FOR i IN range(0, greatest(e, 1))]) AS below FROM x)
  SELECT k, CAST(greatest(60 - CASE WHEN e > m THEN round(-10 * log10(greatest(1 - below, 1e-12)), 0) ELSE 0 END, 0) AS BIGINT) AS mapq FROM t""")
def _(spark, d):
    x = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("k"), scores.divergence_mapq(F.lit(60), F.col("p_size"), F.col("p_partkey") % 1000 + 200, 0.02).alias("mapq"))
    return longs(x, "mapq")


_CL = ", c AS (SELECT svid, chrom, pos AS s, pos + svlen AS e, gt FROM calls), l AS (SELECT *, CASE WHEN abs(s - lag(s) OVER w) <= 5000 AND abs(e - lag(e) OVER w) <= 5000 THEN 0 ELSE 1 END AS n FROM c WINDOW w AS (PARTITION BY chrom ORDER BY s, e)), k AS (SELECT *, sum(n) OVER (PARTITION BY chrom ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS cl FROM l)"


@query("consecutive_clusters", ctes("calls") + _CL + " SELECT chrom, CAST(cl AS BIGINT) AS cluster, min(s) AS first_start, count(*) AS n, concat(max(CAST(gt[1] AS INT)), '/', max(CAST(gt[3] AS INT))) AS gt FROM k GROUP BY chrom, cl")
def _(spark, d):
    c = frame(spark, d, "calls").select("svid", "chrom", F.col("pos").alias("start"), (F.col("pos") + F.col("svlen")).alias("end"), "gt")
    return variants.vote_genotypes(variants.consecutive_clusters(c, ["chrom"], ["start", "end"], 5000), ["chrom"]).withColumnRenamed("start", "first_start")


_HITS = "SELECT svid, chrom AS h_chrom, pos + (svlen * 7) % 400 - 150 AS h_start, pos + (svlen * 7) % 400 - 150 + svlen AS h_end, 60 AS mapq FROM calls UNION ALL SELECT svid, chrom, pos + 30, pos + 30 + CAST(floor(svlen * 0.9) AS BIGINT), 55 FROM calls UNION ALL SELECT svid, 'chr1', pos + 5, pos + 5 + svlen, CAST(svlen % 60 AS INT) FROM calls"


@query("realign_dups", ctes("calls") + f""", h AS ({_HITS}), j AS (SELECT c.svid, h_start, h_end, c.svlen, least(h_end - h_start, c.svlen) / greatest(h_end - h_start, c.svlen) AS sim, least(abs(h_start - c.pos), abs(h_end - c.pos)) AS shift FROM calls c JOIN h ON h.svid = c.svid AND c.chrom = h.h_chrom AND mapq >= 50 AND h_end > h_start WHERE svtype = 'INS'),
  f AS (SELECT *, shift / svlen AS share FROM j WHERE sim >= 0.7 AND shift <= 300 AND shift / svlen <= 0.3), z AS (SELECT *, round((sim - avg(sim) OVER w) / (stddev_pop(sim) OVER w + 0.0001) + (avg(shift) OVER w - shift) / (stddev_pop(shift) OVER w + 0.0001) + (avg(share) OVER w - share) / (stddev_pop(share) OVER w + 0.0001), 6) AS score FROM f WINDOW w AS (PARTITION BY svid))
  SELECT svid, h_start, h_end, shift, round(sim, 6) AS similar FROM z QUALIFY row_number() OVER (PARTITION BY svid ORDER BY score DESC, h_start, h_end DESC) = 1""")
def _(spark, d):
    calls = frame(spark, d, "calls")
    return variants.realigned_duplications(calls.where("svtype = 'INS'"), spark.sql(_HITS.replace("FROM calls", "FROM {c}"), c=calls))


@query("dipsum", ctes("records", "contigs") + """, b AS (SELECT DISTINCT chrom, CAST(floor(pos / 20000) AS BIGINT) * 20000 AS s, CAST(floor(pos / 20000) AS BIGINT) * 20000 + 9000 AS e FROM records), v AS (SELECT r.* FROM records r JOIN b ON r.chrom = b.chrom AND r.pos >= b.s AND r.pos < b.e),
  k AS (SELECT CASE WHEN contains(alt, ',') THEN 'MIXED' WHEN length(alt) > length(ref) THEN 'INS' WHEN length(alt) < length(ref) THEN 'DEL' ELSE 'SNP' END AS kind, CAST(gt[1] = gt[3] AS INT) AS hom FROM v), t AS (SELECT CAST(sum(e - s) AS BIGINT) AS confident FROM b)
  SELECT kind, CAST(sum(hom) AS BIGINT) AS n_hom, CAST(sum(1 - hom) AS BIGINT) AS n_het, max(confident) AS confident, round(sum(1 - hom) / max(confident), 9) AS heterozygosity FROM k, t GROUP BY kind""")
def _(spark, d):
    r = frame(spark, d, "records")
    low = F.floor(F.col("pos") / 20000) * 20000
    return variants.diploid_summary(r, r.select("chrom", low.alias("start"), (low + 9000).alias("end")).distinct())


_HAP = "SELECT concat('chr', CAST(l_suppkey % 22 + 1 AS string)) AS chrom, l_partkey AS pos, 'A' AS ref, CAST(max(l_linenumber % 3) AS BIGINT) AS allele, count(*) AS depth FROM lineitem WHERE l_linenumber % 2 = {0} GROUP BY 1, 2"


@query("vcfpair", f"""WITH x AS ({_HAP.format(0)}), y AS ({_HAP.format(1)}) SELECT chrom, pos, ref, concat(coalesce(CAST(x.allele AS string), '.'), '|', coalesce(CAST(y.allele AS string), '.')) AS gt, CASE WHEN x.allele IS NULL OR y.allele IS NULL THEN 'GAP' WHEN x.allele <> y.allele THEN 'HET' ELSE 'PASS' END AS filter,
  coalesce(x.depth, 0) + coalesce(y.depth, 0) AS ad FROM x FULL JOIN y USING (chrom, pos, ref) WHERE NOT (coalesce(x.allele, 0) = 0 AND coalesce(y.allele, 0) = 0)""")
def _(spark, d):
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    a, b = (spark.sql(_HAP.format(i).replace("FROM lineitem", "FROM {li}"), li=li) for i in (0, 1))
    return variants.pair_haploid_calls(a, b)


_FIT = "SELECT CAST(l_linenumber AS BIGINT) AS src, CAST(l_quantity AS BIGINT) AS coverage, CAST(count(*) AS DOUBLE) AS freq, CAST(sum(l_suppkey % 7) AS DOUBLE) AS fit, 0.1 AS error, 0.2 + (CAST(l_quantity AS BIGINT) % 5) / 20 AS duplicated, 0.4 AS haploid, 0.3 - (CAST(l_quantity AS BIGINT) % 5) / 20 AS collapsed FROM lineitem GROUP BY l_linenumber, CAST(l_quantity AS BIGINT)"


def _fit(spark, d) -> DataFrame:
    return spark.sql(_FIT.replace("FROM lineitem", "FROM {li}"), li=spark.read.parquet(f"{d}/lineitem.parquet")).withColumns({c: F.col(c).cast("double") for c in ("error", "duplicated", "haploid", "collapsed")})


@query("table_merge", f"""WITH t AS ({_FIT}), s AS (SELECT coverage, sum(freq) AS freq, sum(fit) AS fit, sum(error * fit) AS a, sum(duplicated * fit) AS b, sum(haploid * fit) AS c, sum(collapsed * fit) AS e FROM t GROUP BY coverage)
  SELECT coverage, freq, fit, round(a / (a + b + c + e), 6) AS error, round(b / (a + b + c + e), 6) AS duplicated, round(c / (a + b + c + e), 6) AS haploid, round(e / (a + b + c + e), 6) AS collapsed FROM s""")
def _(spark, d):
    return coverage.merge_fit_tables(_fit(spark, d)).withColumns({c: F.round(c, 6) for c in ("error", "duplicated", "haploid", "collapsed")})


@query("outlier_rows", f"WITH t AS ({_FIT}), l AS (SELECT src, freq, lag(freq) OVER w AS p, lead(freq) OVER w AS q FROM t WINDOW w AS (PARTITION BY src ORDER BY coverage)) SELECT src, coalesce(bool_or(freq > 1.2 * p AND freq > 1.2 * q), false) AS bad FROM l GROUP BY src")
def _(spark, d):
    return coverage.tables_with_outliers(_fit(spark, d), "src", "coverage", "freq", 1.2)


_BLOCKS = "SELECT chrom, pos AS start, pos + svlen AS \"end\", CASE CAST(floor(pos / 1000) AS BIGINT) % 4 WHEN 0 THEN 'Err' WHEN 1 THEN 'Dup' WHEN 2 THEN 'Hap' ELSE 'Col' END AS label FROM calls"


def _labelled(spark, d) -> DataFrame:
    return spark.sql(_BLOCKS.replace('"end"', "`end`").replace("FROM calls", "FROM {c}"), c=frame(spark, d, "calls"))


@query("flagger_stats", ctes("calls", "contigs") + f""", b AS ({_BLOCKS}), s AS (SELECT chrom, CAST(i * 50000 AS BIGINT) AS s, CAST(i * 50000 + 30000 AS BIGINT) AS e, CASE WHEN i % 2 = 0 THEN 'easy' ELSE 'hard' END AS stratum FROM contigs, (SELECT unnest(range(0, 20)) AS i)),
  h AS (SELECT stratum, label, CAST(sum(least("end", e) - greatest(start, s)) AS BIGINT) AS size FROM b JOIN s ON b.chrom = s.chrom AND start < e AND s < "end" GROUP BY ALL)
  SELECT stratum, label, round(size / 1e6, 6) AS megabases, round(100 * sum(CASE WHEN label IN ('Err', 'Dup', 'Col') THEN size ELSE 0 END) OVER (PARTITION BY stratum) / sum(size) OVER (PARTITION BY stratum), 6) AS unreliable_percent FROM h""")
def _(spark, d):
    strata = frame(spark, d, "contigs").select("chrom", F.explode(F.sequence(F.lit(0), F.lit(19))).alias("i")).select("chrom", (F.col("i") * 50000).cast("long").alias("start"), (F.col("i") * 50000 + 30000).cast("long").alias("end"), F.when(F.col("i") % 2 == 0, "easy").otherwise("hard").alias("stratum"))
    return coverage.label_sizes_by_stratum(_labelled(spark, d), strata, ("Err", "Dup", "Col"))


@query("argmax_label", f"WITH t AS ({_FIT}) SELECT src, coverage, CASE WHEN error >= duplicated AND error >= haploid AND error >= collapsed THEN 'error' WHEN duplicated >= haploid AND duplicated >= collapsed THEN 'duplicated' WHEN haploid >= collapsed THEN 'haploid' ELSE 'collapsed' END AS label FROM t")
def _(spark, d):
    names = ["error", "duplicated", "haploid", "collapsed"]
    return _fit(spark, d).select("src", "coverage", coverage.best_label([F.col(n) for n in names], names).alias("label"))


@query("label_runs", ctes("cover") + ", b AS (SELECT chrom, pos * 10 AS s, pos * 10 + CASE WHEN pos % 7 = 0 THEN 8 ELSE 9 END AS e, depth % 3 AS label FROM cover), l AS (SELECT *, CASE WHEN lag(label) OVER w = label AND lag(e) OVER w + 1 = s THEN 0 ELSE 1 END AS n FROM b WINDOW w AS (PARTITION BY chrom ORDER BY s)), r AS (SELECT *, sum(n) OVER (PARTITION BY chrom ORDER BY s ROWS UNBOUNDED PRECEDING) AS g FROM l) SELECT chrom, label, min(s) AS run_start, max(e) AS run_end FROM r GROUP BY chrom, label, g")
def _(spark, d):
    b = frame(spark, d, "cover").select("chrom", (F.col("pos") * 10).cast("long").alias("start"), (F.col("pos") * 10 + F.when(F.col("pos") % 7 == 0, 8).otherwise(9)).cast("long").alias("end"), (F.col("depth") % 3).alias("label"))
    return coverage.label_runs(b, ["chrom"], "label").withColumnsRenamed({"start": "run_start", "end": "run_end"})


_COVERED = ctes("sigs") + """, b AS (SELECT chrom, pos AS s, pos + svlen AS e FROM sigs), mo AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS n FROM b), mi AS (SELECT *, sum(n) OVER (PARTITION BY chrom ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM mo),
  m AS (SELECT chrom, min(s) AS s, max(e) AS e FROM mi GROUP BY chrom, g)"""


def _covered(spark, d) -> DataFrame:
    from helixframe.operators.intervals import merge_blocks

    return merge_blocks(frame(spark, d, "sigs").select("chrom", F.col("pos").alias("start"), (F.col("pos") + F.col("svlen")).alias("end")))


@query("cov_windows", _COVERED + """, u AS (SELECT *, sum(e - s) OVER (PARTITION BY chrom ORDER BY s) AS upto, greatest(sum(e - s) OVER (PARTITION BY chrom) // 20000, 1) AS nw FROM m), x AS (SELECT *, upto - (e - s) AS low FROM u), w AS (SELECT *, unnest(range(CAST(least(low // 20000, nw - 1) AS BIGINT), CAST(least((upto - 1) // 20000, nw - 1) + 1 AS BIGINT))) AS k FROM x)
  SELECT chrom, k AS win, CAST(s + greatest(low, k * 20000) - low AS BIGINT) AS w_start, CAST(s + CASE WHEN k = nw - 1 THEN upto ELSE least(upto, (k + 1) * 20000) END - low AS BIGINT) AS w_end FROM w""")
def _(spark, d):
    return coverage.covered_windows(_covered(spark, d), 20000).withColumnsRenamed({"window": "win", "start": "w_start", "end": "w_end"})


@query("split_bed", _COVERED + """, u AS (SELECT *, sum(e - s) OVER (ORDER BY chrom, s) AS upto, sum(e - s) OVER () // 8 + 1 AS size FROM m), x AS (SELECT *, upto - (e - s) AS low FROM u), w AS (SELECT *, unnest(range(CAST(low // size AS BIGINT), CAST((upto - 1) // size + 1 AS BIGINT))) AS k FROM x)
  SELECT k + 1 AS part, chrom, CAST(s + greatest(low, k * size) - low AS BIGINT) AS p_start, CAST(s + least(upto, (k + 1) * size) - low AS BIGINT) AS p_end FROM w""")
def _(spark, d):
    return coverage.balanced_parts(_covered(spark, d), 8).withColumnsRenamed({"start": "p_start", "end": "p_end"})


@query("gap_assign", _COVERED + """, t AS (SELECT m.chrom, s, e, s % 3 AS k, c.length FROM m JOIN (SELECT concat('chr', CAST(n_nationkey + 1 AS string)) AS chrom, 1100000 AS length FROM nation) c USING (chrom)), l AS (SELECT *, lag(s) OVER w AS ps, lag(e) OVER w AS pe, lag(k) OVER w AS pk, lead(s) OVER w IS NULL AS last FROM t WINDOW w AS (PARTITION BY chrom ORDER BY s)),
  c AS (SELECT *, CAST(floor((s - pe) * ((pe - ps) / ((pe - ps) + (e - s)))) AS BIGINT) + pe AS cut FROM l), r AS (SELECT chrom, pe AS a, s AS b, k FROM c WHERE pk = k UNION ALL SELECT chrom, pe, cut, pk FROM c WHERE pk <> k UNION ALL SELECT chrom, cut, s, k FROM c WHERE pk <> k UNION ALL SELECT chrom, 0, s, k FROM c WHERE pk IS NULL UNION ALL SELECT chrom, e, length, k FROM c WHERE last)
  SELECT chrom, a AS gap_start, b AS gap_end, k AS kind FROM r WHERE a < b""")
def _(spark, d):
    contigs = frame(spark, d, "contigs").select("chrom", F.lit(1100000).alias("length"))
    blocks = _covered(spark, d).withColumn("kind", F.col("start") % 3)
    return coverage.proportional_gaps(blocks, contigs).withColumnsRenamed({"start": "gap_start", "end": "gap_end"})


@query("contam_cov", _COVERED + """, d AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 50 THEN 0 ELSE 1 END AS n FROM b), i AS (SELECT *, sum(n) OVER (PARTITION BY chrom ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM d), j AS (SELECT chrom, max(e) - min(s) AS size FROM i GROUP BY chrom, g),
  c AS (SELECT chrom, CAST(sum(size) AS BIGINT) AS covered FROM j GROUP BY chrom), q AS (SELECT chrom, count(DISTINCT hp || svtype) AS n_sources FROM sigs GROUP BY chrom), l AS (SELECT concat('chr', CAST(n_nationkey + 1 AS string)) AS chrom, 1000000 + CAST(n_nationkey AS BIGINT) * 10000 AS length FROM nation)
  SELECT chrom, covered, round(covered / length, 6) AS fraction, n_sources FROM c JOIN q USING (chrom) JOIN l USING (chrom) WHERE round(covered / length, 6) >= 0.05""")
def _(spark, d):
    hits = frame(spark, d, "sigs").select("chrom", F.col("pos").alias("start"), (F.col("pos") + F.col("svlen")).alias("end"), F.concat("hp", "svtype").alias("source"))
    return coverage.uncovered_fraction_by_source(hits, frame(spark, d, "contigs"), 50, 0.05)


@query("genome_coverage", ctes("reads", "contigs") + "SELECT CAST(bases AS BIGINT) AS bases, CAST(genome AS BIGINT) AS genome, round(bases / genome, 6) AS coverage FROM (SELECT sum(length(seq)) AS bases FROM reads), (SELECT sum(length) AS genome FROM contigs)")
def _(spark, d):
    return coverage.genome_coverage(frame(spark, d, "reads").select(F.length("seq").alias("len")), frame(spark, d, "contigs"))


@query("chrom_complete", ctes("alns", "contigs") + "SELECT a.chrom, CAST(sum(ref_end - ref_start) AS BIGINT) AS total, max(ref_end - ref_start) AS longest, count(*) AS n, max(ref_end - ref_start) >= 0.0045 * max(length) AS complete FROM alns a JOIN contigs c ON a.chrom = c.chrom GROUP BY a.chrom")
def _(spark, d):
    hits = frame(spark, d, "alns").select("chrom", F.col("ref_start").alias("start"), F.col("ref_end").alias("end"))
    return coverage.chromosome_completeness(hits, frame(spark, d, "contigs"), 0.0045)


@query("flagger_beds")
def _(spark, d):
    """Interval claims over whole contigs; compared with per-letter counting in the tests."""
    return coverage.final_labels(_labelled(spark, d), frame(spark, d, "contigs"), 100, 300)


@query("collapsed_cand")
def _(spark, d):
    dels = frame(spark, d, "calls").where("svtype = 'DEL'").select("chrom", F.col("pos").alias("start"), (F.col("pos") + F.col("svlen")).alias("end"))
    hits = frame(spark, d, "alns").select("chrom", F.col("ref_start").alias("start"), F.col("ref_end").alias("end"))
    return coverage.collapsed_candidates(hits, dels, frame(spark, d, "contigs"), 500)


@query("hist_peaks", ctes("cigar") + ", h AS (SELECT len AS v, count(*) AS n FROM cigar GROUP BY len), l AS (SELECT *, max(n) OVER (ORDER BY v ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS a, max(n) OVER (ORDER BY v ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS b FROM h) SELECT v, n FROM l WHERE n > a AND n >= b")
def _(spark, d):
    return coverage.histogram_peaks(frame(spark, d, "cigar").groupBy(F.col("len").alias("v")).agg(F.count(F.lit(1)).alias("n")), "v", "n")


_SCORE = "SELECT l_orderkey AS k, CAST(max(l_partkey % 97) AS DOUBLE) AS a, CAST(max(l_suppkey % 89) AS DOUBLE) AS b, CAST(max(l_linenumber * 13 % 83) AS DOUBLE) AS c, CAST(min(l_partkey % 79) AS DOUBLE) AS e FROM lineitem GROUP BY l_orderkey"
_UNIT = f"WITH s AS ({_SCORE}), u AS (SELECT k, sqrt(a * a + b * b + c * c + e * e) AS z, a, b, c, e FROM s), x AS (SELECT k, CASE WHEN z = 0 THEN [0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE] ELSE [a / z, b / z, c / z, e / z] END AS v FROM u), q AS (SELECT quantile_cont(y, 0.9) AS cutoff FROM (SELECT unnest(v) AS y FROM x))"


def _scores(spark, d) -> DataFrame:
    return spark.sql(_SCORE.replace("FROM lineitem", "FROM {li}"), li=spark.read.parquet(f"{d}/lineitem.parquet"))


@query("norm_cutoff", _UNIT + " SELECT round(cutoff, 6) AS cutoff FROM q")
def _(spark, d):
    names = ["a", "b", "c", "e"]
    return assignment.global_cutoff(_scores(spark, d).select("k", *assignment.normalised(names)), names, 0.1).select(F.round("cutoff", 6).alias("cutoff"))


@query("kmer_assign", _UNIT + ", m AS (SELECT k, list_max(v) AS top, list_position(v, list_max(v)) - 1 AS best, cutoff FROM x, q) SELECT k, CAST(unnest(CASE WHEN top >= cutoff THEN [best] WHEN best < 2 THEN [0, 1] ELSE [2, 3] END) AS BIGINT) AS place FROM m")
def _(spark, d):
    return longs(assignment.assign_haplotypes(_scores(spark, d), "k", ["a", "b", "c", "e"], 0.1), "place")


_OWN = "SELECT doc_id, lang AS owner, unnest([substr(seq, i, 6) FOR i IN range(1, length(seq) - 4)]) AS kmer, generate_subscripts([substr(seq, i, 6) FOR i IN range(1, length(seq) - 4)], 1) AS idx FROM reads WHERE length(seq) >= 6"


def _six(spark, d) -> DataFrame:
    return frame(spark, d, "reads").where("length(seq) >= 6").select("doc_id", F.col("lang").alias("owner"), F.posexplode(sequence.kmers(F.col("seq"), 6)).alias("idx", "kmer"))


@query("bad_kmer", ctes("reads") + f""", k AS ({_OWN}), c AS (SELECT doc_id, idx, kmer, row_number() OVER (PARTITION BY doc_id ORDER BY idx) AS nth, count(*) OVER (PARTITION BY doc_id) AS n FROM k WHERE idx <= 90), r AS (SELECT kmer, count(*) AS cnt FROM k WHERE owner = 'en' GROUP BY kmer)
  SELECT doc_id AS svid, count(*) AS n, round(avg(CASE WHEN coalesce(cnt, 0) <= 40 THEN 1.0 ELSE 0.0 END), 6) AS ratio FROM c LEFT JOIN r USING (kmer) WHERE n < 40 OR (nth > 7 AND nth <= n - 7) GROUP BY doc_id""")
def _(spark, d):
    k = _six(spark, d)
    return assignment.bad_kmer_ratio(k.where("idx < 90").select(F.col("doc_id").alias("svid"), "idx", "kmer"), k.where("owner = 'en'").groupBy("kmer").agg(F.count(F.lit(1)).alias("cnt")), 40)


@query("hapmers", ctes("reads") + f", k AS ({_OWN}), o AS (SELECT owner, kmer, count(*) AS cnt FROM k GROUP BY ALL) SELECT kmer, cnt FROM o WHERE owner = 'en' AND kmer IN (SELECT kmer FROM o WHERE owner = 'de') AND kmer NOT IN (SELECT kmer FROM o WHERE owner = 'es')")
def _(spark, d):
    k = _six(spark, d).groupBy("owner", "kmer").agg(F.count(F.lit(1)).alias("cnt"))
    return assignment.haplotype_markers(k, "en", "de", "es")


@query("kmer_qv", ctes("reads") + f", k AS ({_OWN}), a AS (SELECT DISTINCT kmer FROM k WHERE owner = 'fr'), r AS (SELECT DISTINCT kmer FROM k WHERE owner = 'es'), x AS (SELECT count(*) AS n, CAST(sum(CASE WHEN r.kmer IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing FROM a LEFT JOIN r USING (kmer)) SELECT n, missing, CASE WHEN missing > 0 THEN round(-10 * log10(1 - pow(1 - missing / n, 1.0 / 6)), 6) END AS qv FROM x")
def _(spark, d):
    k = _six(spark, d)
    return assignment.consensus_quality(k.where("owner = 'fr'"), k.where("owner = 'es'"), 6)


_TRIO = "SELECT l_orderkey AS read, CAST(sum(l_partkey % 11) AS BIGINT) AS father, CAST(sum(l_suppkey % 13) AS BIGINT) AS mother FROM lineitem GROUP BY l_orderkey"


@query("trio_bins", f"WITH t AS ({_TRIO}) SELECT read, CASE WHEN father < 12 AND mother < 12 THEN '0' WHEN father >= 12 AND father >= 1.5 * mother THEN 'p' WHEN mother >= 12 AND mother >= 1.5 * father THEN 'm' ELSE 'a' END AS bin FROM t")
def _(spark, d):
    return assignment.trio_bins(spark.sql(_TRIO.replace("FROM lineitem", "FROM {li}"), li=spark.read.parquet(f"{d}/lineitem.parquet")), 12, 1.5)


@query("minhash", ctes("reads") + f""", k AS (SELECT DISTINCT owner, md5(kmer) AS h FROM ({_OWN})), r AS (SELECT owner, h, row_number() OVER (PARTITION BY owner ORDER BY h) AS rk FROM k), s AS (SELECT owner, list(h ORDER BY h) AS sk FROM r WHERE rk <= 64 GROUP BY owner), p AS (SELECT a.owner AS a, b.owner AS b, list_sort(list_distinct(list_concat(a.sk, b.sk)))[1:64] AS u, a.sk AS x, b.sk AS y FROM s a JOIN s b ON a.owner < b.owner)
  SELECT a, b, round(len(list_intersect(list_intersect(u, x), y)) / len(u), 6) AS similarity FROM p""")
def _(spark, d):
    s = assignment.sketches(_six(spark, d), "owner", 64, F.md5("kmer"))
    x, y = s.alias("x"), s.alias("y")
    pairs = x.join(y, F.expr("x.owner < y.owner"))
    return pairs.select(F.col("x.owner").alias("a"), F.col("y.owner").alias("b"), F.round(assignment.sketch_similarity(F.col("x.sketch"), F.col("y.sketch"), 64), 6).alias("similarity"))


@query("interspersed_dups")
def _(spark, d):
    return splits.interspersed_duplications(_breakends(spark, d))


def _breakends(spark, d) -> DataFrame:
    from pyspark.sql import Window as W

    b = splits.classify_segments(frame(spark, d, "segs")).where("kind = 'BND'")
    way = F.split("detail", "-")
    idx = F.row_number().over(W.partitionBy("qname").orderBy("q_start"))
    return b.select("qname", idx.alias("idx"), way[0].alias("dir1"), way[1].alias("dir2"), F.col("chrom").alias("chrom1"), F.col("start").alias("pos1"), F.col("chrom2"), F.col("end").alias("pos2"))


@query("chain_merge")
def _(spark, d):
    """Fold over a read's signatures; compared with a plain loop in the tests."""
    return splits.merge_chains(_chains(spark, d, "INS"), "INS")


def _chains(spark, d, svtype: str) -> DataFrame:
    s = frame(spark, d, "sigs").where(F.col("svtype") == svtype)
    return s.select(F.concat(F.lit("q"), (F.col("pos") % 30).cast("string")).alias("qname"), "chrom", "pos", "svlen", (F.col("pos") * 2).alias("q_start"), (F.col("pos") * 2 + F.col("svlen")).alias("q_end")).distinct()


@query("read_hap_join", ctes("alns", "sigs") + ", h AS (SELECT qname, min(hp) AS hp FROM sigs GROUP BY qname) SELECT a.chrom, ref_start, ref_end, qname, hp FROM alns a JOIN h USING (qname)")
def _(spark, d):
    return frame(spark, d, "alns").join(frame(spark, d, "sigs").groupBy("qname").agg(F.min("hp").alias("hp")), "qname").select("chrom", "ref_start", "ref_end", "qname", "hp")


@query("weighted_histogram", ctes("sigs") + "SELECT chrom, pos, CAST(sum(svlen) AS BIGINT) AS weight FROM sigs GROUP BY ALL")
def _(spark, d):
    return frame(spark, d, "sigs").groupBy("chrom", "pos").agg(F.sum("svlen").alias("weight"))


_PAIR = "SELECT doc_id AS read, doc_id % 5 AS block1, doc_id % 5 + 1 AS block2 FROM reads WHERE doc_id % 3 = 0"


@query("kmer_read_assign", ctes("reads") + f""", k AS ({_OWN}), rk AS (SELECT doc_id AS read, kmer, count(*) AS cnt FROM k WHERE doc_id % 3 = 0 GROUP BY ALL), hk AS (SELECT doc_id % 6 AS block, doc_id % 2 + 1 AS hp, kmer, count(*) AS cnt FROM k WHERE doc_id % 3 = 1 AND doc_id % 7 = 0 GROUP BY ALL), p AS ({_PAIR}),
  q AS (SELECT read, 0 AS side, block1 AS block FROM p UNION ALL SELECT read, 1, block2 FROM p), j AS (SELECT q.read, rk.kmer, side * 2 + hp - 1 AS place, rk.cnt + hk.cnt AS s FROM q JOIN rk USING (read) JOIN hk ON hk.block = q.block AND hk.kmer = rk.kmer), u AS (SELECT read, kmer, max(place) AS place, max(s) AS s FROM j GROUP BY ALL HAVING count(*) = 1),
  t AS (SELECT p.read, [CAST(coalesce(sum(CASE WHEN place = 0 THEN s END), 0) AS DOUBLE), CAST(coalesce(sum(CASE WHEN place = 1 THEN s END), 0) AS DOUBLE), CAST(coalesce(sum(CASE WHEN place = 2 THEN s END), 0) AS DOUBLE), CAST(coalesce(sum(CASE WHEN place = 3 THEN s END), 0) AS DOUBLE)] AS v FROM p LEFT JOIN u USING (read) GROUP BY p.read),
  z AS (SELECT read, CASE WHEN list_sum(v) = 0 THEN v ELSE [v[1] / l, v[2] / l, v[3] / l, v[4] / l] END AS v FROM (SELECT read, v, sqrt(v[1] * v[1] + v[2] * v[2] + v[3] * v[3] + v[4] * v[4]) AS l FROM t)), c AS (SELECT quantile_cont(y, 0.9) AS cutoff FROM (SELECT unnest(v) AS y FROM z)),
  m AS (SELECT read, list_max(v) AS top, list_position(v, list_max(v)) - 1 AS best, cutoff FROM z, c) SELECT read, CAST(unnest(CASE WHEN top >= cutoff THEN [best] WHEN best < 2 THEN [0, 1] ELSE [2, 3] END) AS BIGINT) AS place FROM m""")
def _(spark, d):
    reads = frame(spark, d, "reads")
    mine = reads.where("doc_id % 3 = 0").withColumnRenamed("doc_id", "read")
    haps = reads.where("doc_id % 3 = 1 AND doc_id % 7 = 0").select((F.col("doc_id") % 6).alias("block"), (F.col("doc_id") % 2 + 1).alias("hp"), "seq")
    pairs = spark.sql(_PAIR.replace("FROM reads", "FROM {r}"), r=reads)
    scored = assignment.pair_scores(pairs, sequence.count_kmers(mine, 6, "read"), sequence.count_kmers(haps, 6, "block", "hp"))
    return longs(assignment.assign_haplotypes(scored, "read", ["a", "b", "c", "e"], 0.1), "place")
