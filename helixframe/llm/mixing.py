"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A source's target is filled by complete epochs first: every document as often as
the target holds the whole source.  What remains is a fraction of an epoch, taken
in the order of exponential keys -ln(u) / w, where u comes from the id's hash and w is the
document's quality weight: a weighted sample without replacement.  The first
documents of that order are taken whole until the budget ends; the one that
crosses it gives its first words up to the budget, so that every source meets
its target to the word.

The order is never sorted as a whole: sums per (source, key bucket) say in which
bucket a source's budget ends, and only that bucket's rows are ordered one by one.  A source may hold any share of
all rows.  All of it is DataFrame code.

Edge cases: a null or blank text has size 0 and is taken 0 times; a null source is
a source, after all others; rows that repeat an id share its key and are ordered
by size, and rows alike in both share what the budget leaves them evenly; an empty table gives an empty result;
further columns, whatever their names, are kept by mix() and dropped by allocate().
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.llm import selection as S
from helixframe.llm.common import documents, importable, written

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order, repeating; share of all words that is mixed; most epochs of a source.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
SEED = "mix-1"
#: A table of up to so many sources (some 100 bytes each) is broadcast; beyond it the join is salted.
MOST_BROADCAST = 10_000
SALTS = 64


def quality_weight(text):
    """0.05 to 1.05, without steps: the fourth power of the share of letters (and all beyond ASCII) among code points that are no white space."""
    letters = F.length(F.regexp_replace(text, r"[^A-Za-z\x{80}-\x{10FFFF}]", ""))
    share = F.try_divide(letters.cast("double"), F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]", "")).cast("double"))
    return F.coalesce(share * share * share * share, F.lit(0.0)) + F.lit(0.05)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, target) of a table (source, source_size) with one row per source.

    The targets are a water level: source_size * most where that is reached, else weight times a common
    level.  Sources fill up in the order of capacity over weight, so the level follows
    from running sums over the sources alone.
    """
    one = F.lit(1)
    rank = F.row_number().over(W.partitionBy(one).orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    order = W.partitionBy(one).orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    rows = rows.withColumn("full", F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.withColumn("open", F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)))
    rows = rows.withColumn("total", F.sum("source_size").over(W.partitionBy(one)) * share)
    rows = rows.withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    # The level of the first source that does not fill up holds for it and all after it.
    rows = rows.withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("full"), F.col("level")))).over(W.partitionBy(one))["level"])
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap").cast("double")))
    return rows.select("source", "source_size", F.round(target, 3).alias("target"))


def _sized(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.floor((1 - F.exp(F.log(S.uniform_key(F.lit(SEED), F.col("doc_id"))) / quality_weight(text))) * float(1 << 46)).cast("long")
    return docs.select(*keep, "doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.shiftleft(key, S.KEY_BITS - 46).alias("key"))


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Join each row to its source's plan: by broadcast of up to MOST_BROADCAST sources, else with salted keys."""
    plan = plan.withColumnRenamed("source", "_source")
    if plan.count() <= MOST_BROADCAST:
        return rows.join(F.broadcast(plan), F.expr("source <=> _source"), "left").drop("_source")
    plan = plan.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    rows = rows.withColumn("_dealt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    return rows.join(plan, F.expr("source <=> _source AND _dealt = _salt"), "left").drop("_source", "_salt", "_dealt")


def source_plan(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS) -> DataFrame:
    """One row per source: source_size, target, whole epochs, and where in the order the rest of the budget ends.

    Rows of the order before (edge_key, edge_id, edge_size) are taken once more, rows equal to it
    give `room` words each, rows after it none.
    """
    starts = written(S.bucket_starts(sized, "source", "key", "size"), "mix-buckets")
    targets = source_targets(starts.groupBy("source").agg(F.sum("within").alias("source_size")), weights, share, most)
    targets = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    targets = targets.withColumn("budget", F.round(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size"))
    ends = starts.alias("s").join(targets.select("source", "budget").alias("t"), F.expr("s.source <=> t.source AND s.before <= t.budget"))
    ends = ends.groupBy("t.source").agg(F.max(F.struct("bucket", "before")).alias("end"), F.first("budget").alias("budget"))
    near = _with_plan(sized, ends.select("source", F.col("end.bucket").alias("end_bucket"), F.col("end.before").alias("before"), "budget"))
    near = near.where(S.bucket_of("key") == F.col("end_bucket")).groupBy("source", "key", "doc_id", "size", "before", "budget").agg(F.count(F.lit(1)).alias("alike"))
    order = W.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    room = F.col("budget") - F.col("before") - F.coalesce(F.sum(F.col("size") * F.col("alike")).over(order), F.lit(0))
    near = near.withColumn("room", F.least(F.col("size"), F.floor(room / F.col("alike")))).where(F.col("room") >= 0)
    edge = near.groupBy("source").agg(F.max(F.struct("key", "doc_id", "size", "room")).alias("edge"))
    plan = targets.alias("t").join(edge.alias("e"), F.expr("t.source <=> e.source"), "left")
    plan = plan.select("t.source", "source_size", "target", "epochs", F.col("edge.key").alias("edge_key"), F.col("edge.doc_id").alias("edge_id"), F.col("edge.size").alias("edge_size"), F.coalesce("edge.room", F.lit(0)).alias("room"))
    return written(plan, "mix-plan")


def _taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    rows = _with_plan(rows, plan)
    here, edge = F.struct(F.col("key"), F.col("doc_id"), F.col("size")), F.struct(F.col("edge_key").alias("key"), F.col("edge_id").alias("doc_id"), F.col("edge_size").alias("size"))
    part = F.when(F.col("edge_key").isNull() | (here > edge), F.lit(0)).when(here < edge, F.col("size")).otherwise(F.col("room"))
    return rows.withColumn("taken", (F.col("epochs") * F.col("size") + part).cast("long")).drop("key", "epochs", "edge_key", "edge_id", "edge_size", "room")


def allocate(docs: DataFrame, **how) -> DataFrame:
    """One row per row of docs: doc_id, source, size, source_size, target, taken (words, repeats counted)."""
    sized = written(_sized(docs), "mix-sizes")
    return _taken(sized, source_plan(sized, **how))


def first_words(text, n):
    """The text up to the end of its n-th word (n >= 1)."""
    words = F.regexp_extract_all(text, F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    return F.concat_ws("", F.slice(words, F.lit(1), n))


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mixed corpus, with the columns of docs: each document once per epoch, the last perhaps cut at the budget."""
    names = docs.columns
    rows = docs.select("doc_id", "source", "text", F.struct(*[F.col(c) for c in names]).alias("_row"))
    plan = source_plan(written(_sized(docs), "mix-sizes"), **how)
    taken = _taken(_sized(rows, ("_row",)), plan).where(F.col("taken") > 0)
    copies = F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))
    taken = taken.withColumn("_copy", F.explode(copies)).withColumn("_n", F.least(F.col("size"), F.col("taken") - (F.col("_copy") - 1) * F.col("size")).cast("int"))
    cut = F.when(F.col("_n") < F.col("size"), first_words(F.col("_row.text"), F.col("_n"))).otherwise(F.col("_row.text"))
    return taken.select(*[cut.alias("text") if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in names])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allocate(documents(spark, sf_dir)).select("doc_id", "source", "size", "source_size", "target", "taken")


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return mix(docs)


#: The same mix in DuckDB's SQL.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         length(regexp_replace(coalesce(text, ''), '[^A-Za-z\x{80}-\x{10FFFF}]', '', 'g')) AS letters,
         length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS solid,
         (('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS varchar), '')), 1, 13))::BIGINT + 0.5) / 4503599627370496.0 AS u
  FROM documents
), q AS (
  SELECT *, CASE WHEN solid > 0 THEN letters::DOUBLE / solid::DOUBLE END AS share FROM d
), k AS (
  SELECT doc_id, source, size, CAST(floor((1 - exp(ln(u) / (CASE WHEN solid > 0 THEN share * share * share * share ELSE 0.0::DOUBLE END + 0.05::DOUBLE))) * 70368744177664.0) AS BIGINT) AS key FROM q
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM k GROUP BY source
), w AS (
  SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS weight, 2 * source_size AS cap FROM s
), o AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
         sum(weight) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
         1.5 * sum(source_size) OVER () AS total FROM w
), v AS (
  SELECT *, (total - filled) / open AS level FROM o
), l AS (
  SELECT arg_min(level, filled) AS level FROM v WHERE level * weight <= cap
), t AS (
  SELECT source, source_size, round(least(CAST(cap AS DOUBLE), coalesce(l.level * weight, CAST(cap AS DOUBLE))), 3) AS target FROM v, l
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t
), r AS (
  SELECT k.doc_id, k.source, k.size, e.source_size, e.target, e.epochs, CAST(round(e.target) AS BIGINT) - e.epochs * e.source_size AS budget,
         sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id NULLS FIRST, size) AS upto,
         count(*) OVER (PARTITION BY k.source, key, doc_id, size) AS alike
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, source, size, source_size, target, CAST(epochs * size + greatest(0, least(size, floor((budget - (upto - size * alike)) / alike))) AS BIGINT) AS taken FROM r
"""
