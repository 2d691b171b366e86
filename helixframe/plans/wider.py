"""Queries on projected blocks, chains, split reads, memberships, merged calls and statistics of assemblies."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.operators import chains, intervals, models, projection, sequence, splits, variants
from helixframe.plans import clusters
from helixframe.plans.adapters import ctes, frame
from helixframe.plans.registry import query

_ALIGNMENTS = """SELECT aln, concat('chr', CAST(aln % 5 + 1 AS string)) AS chrom, aln % 1000 AS r_start, CAST(aln % 1000 + sum(CASE WHEN op IN (0, 2, 3, 7, 8) THEN len ELSE 0 END) AS bigint) AS r_end,
  concat('ctg', CAST(aln AS string)) AS contig, CAST(50 AS bigint) AS q_start, CAST(50 + sum(CASE WHEN op IN (0, 1, 7, 8) THEN len ELSE 0 END) AS bigint) AS q_end, aln % 2 = 1 AS is_reverse FROM cigar GROUP BY aln"""  # fmt: skip
# Letter by letter: every aligned letter with its place on both sides.
_LETTERS = ctes("cigar") + f""", a AS ({_ALIGNMENTS}), o AS (SELECT aln, op, len, coalesce(sum(CASE WHEN op IN (0, 2, 3, 7, 8) THEN len ELSE 0 END) OVER w, 0) AS ro, coalesce(sum(CASE WHEN op IN (0, 1, 7, 8) THEN len ELSE 0 END) OVER w, 0) AS qo
    FROM cigar WHERE op NOT IN (4, 5, 6) WINDOW w AS (PARTITION BY aln ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  l AS (SELECT aln, chrom, contig, op, r_start + ro + j AS r, CASE WHEN is_reverse THEN q_end - 1 - qo - j ELSE q_start + qo + j END AS q FROM (SELECT *, unnest(range(CAST(len AS BIGINT))) AS j FROM o JOIN a USING (aln) WHERE op IN (0, 7, 8))),
  g AS (SELECT aln, op, len, chrom, contig, r_start + ro AS r0, r_start + ro + CASE WHEN op = 2 THEN len ELSE 0 END AS r1, CASE WHEN is_reverse THEN q_end - qo - CASE WHEN op = 1 THEN len ELSE 0 END ELSE q_start + qo END AS q0,
    CASE WHEN op = 1 THEN len ELSE 0 END AS qn FROM o JOIN a USING (aln) WHERE op IN (1, 2))"""  # fmt: skip
_CONTIG_BLOCKS = "SELECT DISTINCT concat('ctg', CAST(aln AS string)) AS chrom, aln * 10 + k AS block, 40 + aln % 40 + k * 50 AS start, 100 + aln % 40 + k * 50 AS {e} FROM cigar, (SELECT CAST(0 AS bigint) AS k UNION ALL SELECT CAST(1 AS bigint))"
_CHROM_BLOCKS = "SELECT DISTINCT concat('chr', CAST(aln % 5 + 1 AS string)) AS chrom, (aln % 5) * 100 + aln % 12 AS block, (aln % 12) * 90 AS start, (aln % 12) * 90 + 70 AS {e} FROM cigar"


def _projected(blocks: str, here: str, name: str, there: str, target: str) -> str:
    inside = "start < r0 AND r1 < e" if here == "r" else "start < q0 AND q0 + qn < e"
    return f""", b AS ({blocks.format(e='e')}), x AS (SELECT block, aln, l.{target} AS target, min({here}) AS from_start, max({here}) + 1 AS from_end, min({there}) AS to_start, max({there}) + 1 AS to_end, count(*) FILTER (WHERE op = 8) AS n
    FROM b JOIN l ON l.{name} = b.chrom AND {here} >= start AND {here} < e GROUP BY ALL), y AS (SELECT block, aln, sum(len) AS n_gap FROM b JOIN g ON g.{name} = b.chrom AND {inside} GROUP BY ALL)
  SELECT block, aln, CAST(from_start AS BIGINT) AS from_start, CAST(from_end AS BIGINT) AS from_end, target, CAST(to_start AS BIGINT) AS to_start, CAST(to_end AS BIGINT) AS to_end, round(100 * (n + coalesce(n_gap, 0)) / (to_end - to_start), 6) AS percent FROM x LEFT JOIN y USING (block, aln)"""


def _alignments(spark, d):
    """The alignments of the test table and their operations without clipped letters."""
    ops = frame(spark, d, "cigar")
    return spark.sql(_ALIGNMENTS.replace("FROM cigar", "FROM {c}"), c=ops), ops.where("op NOT IN (4, 5, 6)")


def _project(spark, d, blocks: str, to_contig: bool):
    alns, ops = _alignments(spark, d)
    b = spark.sql(blocks.format(e="`end`").replace("FROM cigar", "FROM {c}"), c=frame(spark, d, "cigar"))
    return projection.project(b, projection.elements(ops, alns), "block", to_contig).withColumn("percent", F.round("percent", 6))


@query("project_asm2ref", _LETTERS + _projected(_CONTIG_BLOCKS, "q", "contig", "r", "chrom"))
def _(spark, d):
    return _project(spark, d, _CONTIG_BLOCKS, False)


@query("project_ref2asm", _LETTERS + _projected(_CHROM_BLOCKS, "r", "chrom", "q", "contig"))
def _(spark, d):
    return _project(spark, d, _CHROM_BLOCKS, True)


@query("duplicated_cand", _LETTERS + """, s AS (SELECT *, lag(aln) OVER w AS two, least(r_end, lag(r_end) OVER w) AS e FROM a WINDOW w AS (PARTITION BY chrom ORDER BY r_start, r_end, aln)),
  t AS (SELECT aln AS one, r_start AS s0, e FROM s WHERE two IS NOT NULL AND r_start < e UNION ALL SELECT two, r_start, e FROM s WHERE two IS NOT NULL AND r_start < e),
  c AS (SELECT contig, CAST(0 AS BIGINT) AS s, q_start AS e FROM a UNION ALL SELECT contig, q_end, q_end + aln % 30 FROM a WHERE aln % 30 > 0 UNION ALL SELECT contig, q0, q0 + qn FROM g WHERE op = 1 AND len > 30
    UNION ALL SELECT contig, min(q), max(q) + 1 FROM t JOIN l ON l.aln = t.one AND r >= s0 AND r < e GROUP BY contig, one, s0, e),
  m AS (SELECT *, max(e) OVER (PARTITION BY contig ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM c), i AS (SELECT *, sum(CASE WHEN s <= far THEN 0 ELSE 1 END) OVER (PARTITION BY contig ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM m)
  SELECT contig, CAST(min(s) AS BIGINT) AS block_start, CAST(max(e) AS BIGINT) AS block_end FROM i GROUP BY contig, k""")  # fmt: skip
def _(spark, d):
    alns, ops = _alignments(spark, d)
    contigs = alns.select(F.col("contig").alias("chrom"), (F.col("q_end") + F.col("aln") % 30).alias("length"))
    return projection.duplicated_candidates(alns, ops, contigs, 30).select(F.col("chrom").alias("contig"), F.col("start").alias("block_start"), F.col("end").alias("block_end"))


_MATCHES = """SELECT l_orderkey % 50 AS pair, l_partkey % 2 = 0 AS is_reverse, (l_orderkey * 31 + l_linenumber * 977) % 20000 AS q, (l_orderkey * 31 + l_linenumber * 977) % 20000 + l_suppkey % 300 AS t, CAST(15 + l_linenumber AS bigint) AS n FROM {t}"""


@query("collinear_chains")
def _(spark, d):
    matches = spark.sql(_MATCHES, t=spark.read.parquet(f"{d}/lineitem.parquet"))
    return chains.chains(matches, ["pair", "is_reverse"]).withColumn("score", F.round("score", 6))


@query("read_split_types", ctes("segs") + """, s AS (SELECT *, row_number() OVER (PARTITION BY qname ORDER BY q_start, q_end, chrom, ref_start, ref_end, is_reverse) AS i, count(*) OVER (PARTITION BY qname) AS n FROM segs),
  p AS (SELECT x.qname, x.i, x.n, x.chrom AS c1, y.chrom AS c2, x.is_reverse AS r1, y.is_reverse AS r2, y.q_start - x.q_end AS gap, CASE WHEN x.is_reverse THEN y.ref_end ELSE x.ref_end END AS le, CASE WHEN x.is_reverse THEN x.ref_start ELSE y.ref_start END AS rs,
    CASE WHEN x.is_reverse THEN x.ref_start ELSE x.ref_end END AS o, CASE WHEN y.is_reverse THEN y.ref_end ELSE y.ref_start END AS en FROM s x JOIN s y ON y.qname = x.qname AND y.i = x.i + 1),
  k AS (SELECT *, CASE WHEN le - rs < 30 AND gap <= 100 AND rs - le - gap BETWEEN 30 AND 50000 THEN 'DEL' WHEN le - rs < 30 AND rs - le <= 100 AND gap - rs + le BETWEEN 30 AND 50000 THEN 'INS' END AS kind FROM p WHERE c1 = c2 AND r1 = r2),
  t AS (SELECT a.qname, a.i, a.n, CAST(a.is_reverse AS INT) AS r, CASE WHEN a.is_reverse THEN a.ref_start >= b.ref_end ELSE c.ref_start >= b.ref_end END AS ok FROM s a JOIN s b ON b.qname = a.qname AND b.i = a.i + 1 JOIN s c ON c.qname = a.qname AND c.i = a.i + 2
    WHERE a.chrom = b.chrom AND b.chrom = c.chrom AND a.is_reverse = b.is_reverse AND b.is_reverse = c.is_reverse),
  u AS (SELECT qname, 1 AS i FROM s WHERE n = 2 AND i = 1 UNION ALL SELECT qname, i + r FROM t WHERE ok UNION ALL SELECT qname, i + 1 - r FROM t WHERE i = n - 2),
  b AS (SELECT p.* FROM p LEFT JOIN p z ON z.qname = p.qname AND z.i = p.i - 1 WHERE p.c1 <> p.c2 AND p.gap <= 100 AND (p.n = 2 OR p.i <= p.n - 2 OR z.c1 <> z.c2)),
  f AS (SELECT x.qname, x.chrom, y.q_start - x.q_end AS gap, CASE WHEN x.is_reverse THEN y.ref_end ELSE x.ref_end END AS le, CASE WHEN x.is_reverse THEN x.ref_start ELSE y.ref_start END AS rs FROM s x JOIN s y ON y.qname = x.qname AND x.i = 1 AND y.i = y.n
    WHERE x.n >= 3 AND x.chrom = y.chrom AND x.is_reverse = y.is_reverse AND x.qname IN (SELECT qname FROM p WHERE i <= n - 2 AND c1 <> c2))
  SELECT qname, kind, c1 AS chrom, CASE WHEN kind = 'INS' THEN (rs + le) / 2 ELSE le END AS pos, CAST(abs(rs - le - gap) AS BIGINT) AS svlen, '' AS chrom2, CAST(0 AS BIGINT) AS pos2 FROM u JOIN k USING (qname, i) WHERE kind IS NOT NULL
  UNION ALL SELECT qname, CASE WHEN r1 <> r2 THEN CASE WHEN r1 THEN 'C' ELSE 'B' END WHEN (c1 < c2) <> r1 THEN 'A' ELSE 'D' END, least(c1, c2), CASE WHEN c1 < c2 THEN o ELSE en END, 0, greatest(c1, c2), CASE WHEN c1 < c2 THEN en ELSE o END FROM b
  UNION ALL SELECT qname, 'INS', chrom, least(le, rs), gap - (rs - le), '', 0 FROM f WHERE rs - le < 100 AND gap - (rs - le) BETWEEN 30 AND 50000""")  # fmt: skip
def _(spark, d):
    return splits.read_split_variants(frame(spark, d, "segs")).fillna({"svlen": 0, "chrom2": "", "pos2": 0})


_TRACKS = {"first": "l_partkey % 3 = 0", "second": "l_partkey % 3 = 1", "third": "l_partkey % 3 = 2 AND l_suppkey % 2 = 0"}
_TRACK = "SELECT concat('chr', CAST(l_suppkey % 22 + 1 AS string)) AS chrom, (l_orderkey * 7919 + l_linenumber * 104729) % 1000000 AS start, (l_orderkey * 7919 + l_linenumber * 104729) % 1000000 + CAST(round(l_quantity) AS bigint) * 40 + 1 AS {e} FROM {t} WHERE {w}"


@query("track_membership", "WITH " + ", ".join(f"t{i} AS ({_TRACK.format(e='e', t='lineitem', w=w)})" for i, w in enumerate(_TRACKS.values())) + """, ev AS (""" + " UNION ALL ".join(
    f"SELECT chrom, start AS p, {', '.join('1' if j == i else '0' for j in range(3))} FROM t{i} UNION ALL SELECT chrom, e, {', '.join('-1' if j == i else '0' for j in range(3))} FROM t{i}" for i in range(3)) + """),
  st AS (SELECT chrom, p, sum(x) AS x, sum(y) AS y, sum(z) AS z FROM (SELECT * FROM ev) AS v(chrom, p, x, y, z) GROUP BY chrom, p),
  d AS (SELECT chrom, p, sum(x) OVER w > 0 AS x, sum(y) OVER w > 0 AS y, sum(z) OVER w > 0 AS z FROM st WINDOW w AS (PARTITION BY chrom ORDER BY p)),
  ch AS (SELECT *, CASE WHEN x = lag(x) OVER w AND y = lag(y) OVER w AND z = lag(z) OVER w THEN 0 ELSE 1 END AS n FROM d WINDOW w AS (PARTITION BY chrom ORDER BY p)),
  r AS (SELECT *, lead(p) OVER (PARTITION BY chrom ORDER BY p) AS e FROM ch WHERE n = 1)
  SELECT chrom, p AS block_start, e AS block_end, x::INT + y::INT + z::INT AS n_tracks, concat_ws(',', CASE WHEN x THEN 'first' END, CASE WHEN y THEN 'second' END, CASE WHEN z THEN 'third' END) AS tracks FROM r WHERE x OR y OR z""")  # fmt: skip
def _(spark, d):
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    tracks = {t: spark.sql(_TRACK.format(e="`end`", t="{t}", w=w), t=lines) for t, w in _TRACKS.items()}
    return intervals.memberships(tracks).select("chrom", F.col("start").alias("block_start"), F.col("end").alias("block_end"), "n_tracks", "tracks")


_INV = """, c AS (SELECT *, pos + svlen AS e FROM calls), n AS (SELECT *, CASE WHEN abs(pos - lag(pos) OVER w) <= 5000 AND abs(e - lag(e) OVER w) <= 5000 THEN 0 ELSE 1 END AS f FROM c WINDOW w AS (PARTITION BY chrom ORDER BY pos, e)),
  k AS (SELECT *, sum(f) OVER (PARTITION BY chrom ORDER BY pos, e ROWS UNBOUNDED PRECEDING) AS cl FROM n),
  m AS (SELECT chrom, cl, min(struct_pack(a := pos, b := e, i := svid)) AS x, concat(max(CAST(gt[1] AS INT)), '/', max(CAST(gt[3] AS INT))) AS gt, count(*) AS n FROM k GROUP BY chrom, cl),
  u AS (SELECT x.i AS svid, chrom, x.a AS start, x.b AS e, gt, n FROM m), h AS (SELECT svid, chrom, 0 AS side, start AS pt FROM u UNION ALL SELECT svid, chrom, 1, e FROM u),
  q AS (SELECT svid, side FROM h JOIN alns a ON a.chrom = h.chrom AND a.ref_start < pt + 300 AND a.ref_end > pt - 300 GROUP BY svid, side, qname HAVING min(is_reverse) < max(is_reverse))"""


@query("merged_inversions", ctes("calls", "alns") + _INV + " SELECT svid, chrom, start AS block_start, e AS block_end, gt, n FROM u WHERE svid IN (SELECT svid FROM q GROUP BY svid HAVING count(DISTINCT side) = 2)")
def _(spark, d):
    calls = frame(spark, d, "calls").select("svid", "chrom", F.col("pos").alias("start"), (F.col("pos") + F.col("svlen")).alias("end"), "gt")
    return variants.merged_inversions(calls, frame(spark, d, "alns"), 5000, 300).withColumnsRenamed({"start": "block_start", "end": "block_end"})


_BREAKENDS = """SELECT concat('bnd', CAST(l_orderkey * 10 + l_linenumber AS string)) AS svid, concat('chr', CAST(l_suppkey % 4 + 1 AS string)) AS chrom, (l_orderkey * 7919) % 200000 AS pos, concat('chr', CAST(l_partkey % 4 + 5 AS string)) AS chrom2,
  (l_orderkey * 7919) % 200000 + (l_partkey * 37) % 900 AS pos2, CASE WHEN l_linenumber % 2 = 0 THEN '[' ELSE ']' END AS bracket, CASE WHEN l_returnflag = 'R' THEN '1/0' ELSE '0/1' END AS gt FROM lineitem"""  # fmt: skip


@query("merged_translocations", f"""WITH b AS ({_BREAKENDS}), n AS (SELECT *, CASE WHEN pos - lag(pos) OVER w <= 400 AND pos2 - lag(pos2) OVER w <= 400 THEN 0 ELSE 1 END AS f FROM b WINDOW w AS (PARTITION BY chrom, chrom2, bracket ORDER BY pos, pos2, svid)),
  k AS (SELECT *, sum(f) OVER (PARTITION BY chrom, chrom2, bracket ORDER BY pos, pos2, svid ROWS UNBOUNDED PRECEDING) AS cl FROM n)
  SELECT svid, chrom, pos, chrom2, pos2, bracket, CASE WHEN count(*) OVER w > 1 THEN '1/1' ELSE gt END AS gt, count(*) OVER w AS n FROM k WINDOW w AS (PARTITION BY chrom, chrom2, bracket, cl) QUALIFY row_number() OVER (PARTITION BY chrom, chrom2, bracket, cl ORDER BY pos, pos2, svid) = 1""")  # fmt: skip
def _(spark, d):
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    return variants.merged_translocations(spark.sql(_BREAKENDS.replace("FROM lineitem", "FROM {t}"), t=lines), 400)


@query("assembly_stats", ctes("reads") + """, j AS (SELECT length(seq) AS l, row_number() OVER (ORDER BY length(seq) DESC, doc_id) AS j FROM reads), c AS (SELECT *, sum(l) OVER (ORDER BY j) AS s, sum(l) OVER () AS t FROM j)
  SELECT concat('N', k * 10) AS name, max(l) AS length, min(j) AS n FROM c, unnest(range(1, 10)) AS x(k) WHERE s * 10 >= t * k GROUP BY k UNION ALL
  SELECT unnest(['min', 'max', 'mean', 'total']), unnest([min(l), max(l), CAST(floor(sum(l) / count(*)) AS BIGINT), CAST(sum(l) AS BIGINT)]), count(*) FROM j""")  # fmt: skip
def _(spark, d):
    return sequence.assembly_statistics(frame(spark, d, "reads").select(F.length("seq").alias("len")), "len")


_MARKED = "SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN concat(seq, 'N') ELSE seq END AS seq FROM reads"


@query("read_rejects", ctes("reads") + f", m AS ({_MARKED}) SELECT doc_id, coalesce(seq NOT LIKE '%N%' AND length(seq) >= 100, false) AS passes FROM m")
def _(spark, d):
    kept, rest = sequence.parted_reads(spark.sql(_MARKED.replace("FROM reads", "FROM {r}"), r=frame(spark, d, "reads")), 100)
    return kept.select("doc_id", F.lit(True).alias("passes")).unionByName(rest.select("doc_id", F.lit(False).alias("passes")))


@query("nb_mixture")
def _(spark, d):
    h = clusters.ploidy_histogram(spark, d)
    fits = models.fit_negative_binomial_windows(h, "win", 2)
    return fits.select("win", *[F.round(c, 4).alias(c) for c in fits.columns if c != "win"])
