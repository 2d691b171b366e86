"""Quality classifier: importance resampling of the raw corpus towards a trusted target.

A document's log importance weight is the log ratio of the two hashed n-gram
generative models: the plain sum over its n-grams.  Gumbel top-k samples without
replacement in proportion to the weights: of all documents the k with the
largest log weight plus Gumbel noise are kept.  The noise is drawn from the id,
so that reruns agree.  k is a number, or a share of the documents, or by default the sum of
min(1, weight) over all documents: as many as rejection sampling would accept on average that accepts a
document of the target's kind always and any other in proportion to its weight.

Keys are written once.  The k-th largest is found by counting keys per bucket, down to the single key;
no document is gathered or sorted in one place for it.

Edge cases: null, empty and very short texts have weight 1 (log 0); rows that
repeat an id share its noise; at equal keys the order of (doc_id, n-grams) decides and
rows alike in all of these are kept alike, so that k may then be passed by their
number; a null doc_id draws noise as the empty id; empty tables give empty results; columns of any
name are kept by keep().
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm import ngram_models as M
from helixframe.llm.common import documents, importable, labels, removed, written

SEED = 7
#: Keys are ordered as integers in these steps.
STEPS_PER_NAT = 1 << 20


def gumbel(column: pa.Array, seed: int = SEED) -> np.ndarray:
    """Standard Gumbel noise from the 64-bit hash of an integer column."""
    from helixframe.llm.kernels import mix

    ids = column.fill_null(-(1 << 62)).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    h = mix(mix(ids + np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64((seed * 0xD1B54A32D192ED03) & ((1 << 64) - 1)))
    u = ((h >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
    return -np.log(-np.log(u))


def _keys(ratios: np.ndarray, ids: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sums, counts = M.column_scores(ratios, texts)
    weights = np.round(sums, 6)
    return weights, counts, np.floor((weights + gumbel(ids)) * STEPS_PER_NAT).astype(np.int64)


def importance_keys(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """(doc_id, log_weight, n_grams, key) of every row; key orders log weight plus noise."""
    importable(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights, counts, keys = _keys(ratios, batch.column(0), batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(weights), pa.array(counts), pa.array(keys)], ["doc_id", "log_weight", "n_grams", "key"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(score, "doc_id long, log_weight double, n_grams long, key long")


#: Below every key: all rows are kept.
NO_KEY = -(1 << 62)
#: In the order of ties a null doc_id comes first.
NO_ID = -(1 << 63)


#: Expected acceptances are added up as whole numbers of this many a document, so that their sum is the same in any order.
ACCEPT_STEPS = 1 << 30
#: Keys below -FLOOR nats are counted as one bucket first: the table of buckets has fewer than 2 * FLOOR rows.
FLOOR = 100_000


def budget(keys: DataFrame, share: float | None = None) -> int:
    """k: the given share of the documents, or the expected number that rejection sampling accepts."""
    if share is not None:
        return math.floor(share * keys.count())
    accepted = F.floor(F.exp(F.least(F.col("log_weight"), F.lit(0.0))) * ACCEPT_STEPS).cast("decimal(38,0)")
    total = keys.agg(F.sum(accepted).alias("n")).first().n
    return round(int(total or 0) / ACCEPT_STEPS)


def _kth(keys: DataFrame, k: int) -> tuple[int, int] | None:
    """The k-th largest key, and how many of the rows that have it are among the k; None if there is no row.

    Three counting passes: over buckets of keys 2**20 steps (one nat) wide, over buckets of
    256 steps in the one that holds the k-th, and over the single keys of that. All are counted before the shuffle.
    """
    lowest, highest = -FLOOR, FLOOR
    bucket_of = F.greatest(F.least(F.shiftright("key", 20), F.lit(highest)), F.lit(lowest))
    keys = keys.withColumn("bucket", bucket_of)
    table = sorted(((r.bucket, r["count"]) for r in keys.groupBy("bucket").count().collect()), reverse=True)
    if not table or k <= 0:
        return None
    if sum(t[1] for t in table) <= k:
        return NO_KEY, 0
    above = 0
    for bucket, n in table:
        if above + n >= k:
            break
        above += n
    inside = keys.where(F.col("bucket") == bucket)
    # The outermost buckets stand for all beyond them and are halved bit by bit; each of the others is one nat.
    bits = list(range(60, 16, -8)) if bucket in (lowest, highest) else []
    for shift in [*bits, 8, 0]:
        counts = inside.groupBy(F.shiftright("key", shift).alias("part")).count()
        for row in sorted(counts.collect(), reverse=True):
            if above + row["count"] >= k:
                break
            above += row["count"]
        inside = inside.where(F.shiftright("key", shift) == row["part"])
    return int(row["part"]), k - above


def top_key(keys: DataFrame, k: int) -> int | None:
    """The k-th largest key; None if there is no row."""
    found = _kth(keys, k)
    return found and found[0]


def cut(keys: DataFrame, k: int) -> tuple[int, int, int] | None:
    """(key, doc_id, n_grams) of the last row that is kept, where smaller ids and then n-grams go first among equal keys; None if none is."""
    found = _kth(keys, k)
    if found is None:
        return None
    key, room = found
    ties = keys.where(F.col("key") == key).groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "n_grams").count().orderBy("id", "n_grams")
    last = (NO_ID, 0)
    for row in ties.limit(max(room, 0)).collect():
        last = (row["id"], row["n_grams"])
        room -= row["count"]
        if room <= 0:
            break
    return key, *last


def _scored(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, DataFrame]:
    ratios = M.fit(docs, labels)
    return ratios, written(importance_keys(docs, ratios), "quality-keys")


def classify(docs: DataFrame, labels: DataFrame, k: int | None = None, share: float | None = None) -> DataFrame:
    """One row per document: doc_id, log_weight, n_grams, gumbel_key, kept boolean."""
    _, keys = _scored(docs, labels)
    last = cut(keys, budget(keys, share) if k is None else k)
    if last is None:
        kept = F.lit(False)
    else:
        key, at, n = last
        of = F.coalesce("doc_id", F.lit(NO_ID))
        kept = (F.col("key") > key) | ((F.col("key") == key) & ((of < at) | ((of == at) & (F.col("n_grams") <= n))))
    return keys.select("doc_id", "log_weight", "n_grams", (F.col("key") / STEPS_PER_NAT).alias("gumbel_key"), kept.alias("kept"))


def keep(docs: DataFrame, labels: DataFrame, k: int | None = None, share: float | None = None) -> DataFrame:
    """The rows of docs that are kept, with all their columns."""
    ratios, keys = _scored(docs, labels)
    last = cut(keys, budget(keys, share) if k is None else k)
    removed(keys)
    if last is None:
        return docs.limit(0)
    at_id, at_text = docs.columns.index("doc_id"), docs.columns.index("text")

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, counts, keys = _keys(ratios, batch.column(at_id), batch.column(at_text))
            of = batch.column(at_id).cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            key, at, n = last
            yield batch.filter(pa.array((keys > key) | ((keys == key) & ((of < at) | ((of == at) & (counts <= n))))))

    return docs.mapInArrow(chosen, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(documents(spark, sf_dir), labels(spark, sf_dir))


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return keep(docs, labels(spark, sf_dir))
