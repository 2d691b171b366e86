"""The test tables seen as genomic tables. The expressions mean the same in Spark SQL and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SQL = {
    "calls": ("orders", """SELECT concat('sv', CAST(o_orderkey AS string)) AS svid, concat('chr', CAST(o_custkey % 22 + 1 AS string)) AS chrom,
      CASE WHEN o_orderkey % 2 = 0 THEN 'INS' ELSE 'DEL' END AS svtype, (o_orderkey * 7919 + 104729) % 1000000 AS pos, o_orderkey % 971 + 30 AS svlen,
      CASE WHEN o_orderstatus = 'F' THEN '1/1' ELSE '0/1' END AS gt FROM orders"""),
    "alts": ("orders", """SELECT concat('sv', CAST(o_orderkey AS string)) AS svid, substr(md5(CAST(o_custkey AS string)), 1, CAST(o_orderkey % 24 + 8 AS int)) AS alt FROM orders"""),
    "sigs": ("lineitem", """SELECT concat('chr', CAST(l_suppkey % 22 + 1 AS string)) AS chrom, CASE WHEN l_returnflag = 'R' THEN 'INS' ELSE 'DEL' END AS svtype,
      (l_orderkey * 7919 + l_linenumber * 104729) % 1000000 AS pos, CAST(round(l_quantity) AS bigint) * 10 + 20 AS svlen,
      concat('read', CAST(l_partkey AS string)) AS qname, concat('hp', CAST(l_partkey % 2 + 1 AS string)) AS hp FROM lineitem"""),
    "alns": ("lineitem", """SELECT concat('chr', CAST(l_suppkey % 22 + 1 AS string)) AS chrom, (l_orderkey * 6007 + l_linenumber * 15485863) % 1000000 AS ref_start,
      (l_orderkey * 6007 + l_linenumber * 15485863) % 1000000 + CAST(round(l_quantity) AS bigint) * 100 AS ref_end,
      CAST(round(l_tax * 100) AS bigint) * 10 AS mapq, concat('read', CAST(l_partkey AS string)) AS qname, l_linenumber % 2 AS is_reverse FROM lineitem"""),
    "cigar": ("lineitem", """SELECT l_orderkey AS aln, l_linenumber AS idx, CAST((l_orderkey * 5 + l_linenumber * 4) % 9 AS int) AS op,
      CAST(sum(CAST(round(l_quantity) AS bigint)) AS bigint) AS len FROM lineitem GROUP BY l_orderkey, l_linenumber"""),
    "segs": ("lineitem", """SELECT concat('r', CAST(l_orderkey AS string)) AS qname, CAST(l_linenumber AS bigint) * 1000 + l_partkey % 121 - 60 AS q_start, CAST(l_linenumber AS bigint) * 1000 + 980 + l_suppkey % 41 AS q_end,
      CASE WHEN l_partkey % 11 = 0 THEN 'chr2' ELSE 'chr1' END AS chrom, l_partkey % 4 = 0 AS is_reverse,
      500000 + CAST(l_linenumber AS bigint) * (CASE WHEN l_partkey % 4 = 0 THEN -1000 ELSE 1000 END) + (CASE l_suppkey % 6 WHEN 0 THEN 0 WHEN 1 THEN 300 WHEN 2 THEN -700 WHEN 3 THEN 250000 WHEN 4 THEN -2500 ELSE 40 END) + l_partkey % 90 AS ref_start,
      500000 + CAST(l_linenumber AS bigint) * (CASE WHEN l_partkey % 4 = 0 THEN -1000 ELSE 1000 END) + (CASE l_suppkey % 6 WHEN 0 THEN 0 WHEN 1 THEN 300 WHEN 2 THEN -700 WHEN 3 THEN 250000 WHEN 4 THEN -2500 ELSE 40 END) + l_partkey % 90 + 1000 AS ref_end FROM lineitem"""),
    "pairs": ("lineitem", """SELECT l_orderkey AS k, CAST(l_linenumber AS bigint) AS i, l_partkey * 7 % 1000 AS s1, l_partkey * 7 % 1000 + l_suppkey % 300 + 20 AS e1, l_suppkey * 13 % 1000 AS s2, l_suppkey * 13 % 1000 + l_partkey % 350 + 20 AS e2,
      CASE WHEN l_partkey % 2 = 0 THEN 'left' ELSE 'right' END AS w1, CASE WHEN l_suppkey % 3 = 0 THEN 'left' ELSE 'right' END AS w2 FROM lineitem"""),
    "records": ("part", """SELECT concat('chr', CAST(p_partkey % 22 + 1 AS string)) AS chrom, p_partkey * 37 % 100000 AS pos, substr(concat(md5(p_name), md5(p_type)), 1, CAST(p_partkey % 30 + 1 AS int)) AS ref,
      substr(concat(md5(p_type), md5(p_brand)), 1, CAST(p_size AS int)) AS alt, CASE WHEN p_partkey % 3 = 0 THEN '1/1' WHEN p_partkey % 3 = 1 THEN '0/1' ELSE '1/0' END AS gt,
      concat('PS', CAST(p_partkey % 40 AS string), '_', CASE WHEN p_size % 2 = 0 THEN 'hp1' ELSE 'hp2' END, '_', CAST(p_size AS string)) AS tig, p_partkey AS id FROM part"""),
    "contigs": ("nation", """SELECT concat('chr', CAST(n_nationkey + 1 AS string)) AS chrom, 1000000 + CAST(n_nationkey AS bigint) * 10000 AS length FROM nation"""),
    "cover": ("events", """SELECT event_type AS chrom, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS pos, CAST(floor(value / 100) AS bigint) AS depth FROM events"""),
    "reads": ("documents", """SELECT doc_id, lang, source, translate(lower(regexp_replace(text, '[^A-Za-z]', ''{g})), 'abcdefghijklmnopqrstuvwxyz', 'acgtacgtacgtacgtacgtacgtac') AS seq FROM documents"""),
}


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, sql = SQL[name]
    return spark.sql(sql.format(g="").replace(f"FROM {table}", "FROM {t}"), t=spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def ctes(*names: str) -> str:
    """WITH clause for DuckDB; more CTEs may follow after a comma."""
    return "WITH " + ", ".join(f"{n} AS ({SQL[n][1].format(g=', ' + chr(39) + 'g' + chr(39))})" for n in names)
