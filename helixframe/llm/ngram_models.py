"""Hashed n-gram multinomials of a trusted target and of the raw corpus.

Two operators use them: quality rules (length-normalised log-likelihood ratio
with one fixed threshold) and the quality classifier (importance resampling by
Gumbel top-k).  The model is two vectors of BUCKETS counts, so that what reaches
the driver and goes back to the workers does not grow with the corpus, while the
counts themselves cover every n-gram of every document.

The trusted rows' mix of languages differs from the corpus's by chance, and that difference would
count in every n-gram of a text. So raw counts are weighted by language (a column of
the corpus that only the fit reads) to the target's mix; a language without trusted rows has weight 0,
and n-grams that only it has say nothing.

Edge cases: a null or empty text, or one of fewer bytes than an n-gram, has no
n-grams and a log-likelihood ratio of 0; repeated rows are counted and scored
each; without any trusted row both models are the raw one and every ratio is 0;
empty tables give empty results; further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm import kernels as K
from helixframe.llm.common import importable

#: n-grams are N bytes of UTF-8, hashed to BUCKETS buckets.
N = 4
BUCKETS = 1 << 16
#: Added to every bucket of both models, which have the same total: a bucket of which either model has seen little says little.
SMOOTHING = 10.0
#: Languages are told apart by this many hash values; a raw weight is held in steps of 2**-20.
STRATA = 4096
WEIGHT_STEPS = 1 << 20
#: Up to so many ids of trusted rows are broadcast; more are joined by a shuffle. All of them count either way.
MOST_BROADCAST = 2_000_000


def hashed_grams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each n-gram, and the n-grams in each row."""
    if len(data) < N:
        return np.zeros(0, np.uint32), np.zeros(len(at) - 1, np.int64)
    x = data.astype(np.uint32)
    h = x[: len(x) - N + 1].copy()
    for i in range(1, N):
        h *= np.uint32(257)
        h += x[i : len(x) - N + 1 + i]
    h *= np.uint32(2654435769)
    h >>= np.uint32(32 - (BUCKETS.bit_length() - 1))
    crosses = np.zeros(len(h), bool)
    for i in range(1, N):
        inner = at[1:-1] - i
        crosses[inner[(inner >= 0) & (inner < len(h))]] = True
    counts = np.maximum(np.diff(at) - N + 1, 0)
    return h[~crosses], counts


def count_grams(docs: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """(bucket, n_target, n_raw) over all rows of docs (text, is_target, stratum).

    An n-gram counts 1 for the target, where is_target, and its stratum's weight, a whole number (1 if none is given), for raw.
    """
    importable(docs.sparkSession)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            chosen = batch.column(1).fill_null(False).to_numpy(zero_copy_only=False).astype(bool)
            each = None if weights is None else weights[batch.column(2).to_numpy()]
            for low, high, data, at in K.text_slices(batch.column(0)):
                grams, counts = hashed_grams(data, at)
                # Sums of whole numbers below 2**53: exact, whatever their order.
                total[1] += np.bincount(grams, None if each is None else np.repeat(each[low:high], counts), minlength=BUCKETS).astype(np.int64)
                if chosen[low:high].any():
                    total[0] += np.bincount(grams[np.repeat(chosen[low:high], counts)], minlength=BUCKETS)
        seen = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[0][seen]), pa.array(total[1][seen])], ["bucket", "n_target", "n_raw"])

    parts = docs.select(F.col("text").cast("string"), F.col("is_target").cast("boolean"), F.col("stratum").cast("int")).mapInArrow(partial, "bucket int, n_target long, n_raw long")
    return parts.groupBy("bucket").agg(F.sum("n_target").alias("n_target"), F.sum("n_raw").alias("n_raw"))


def raw_weights(marked: DataFrame) -> np.ndarray:
    """By stratum, the share of its n-grams that are the target's, in steps: so weighted, the raw counts have the target's mix of languages and its size."""
    grams = F.greatest(F.octet_length(F.coalesce(F.col("text"), F.lit(""))) - (N - 1), F.lit(0)).cast("long")
    sums = marked.groupBy("stratum").agg(F.sum(F.when(F.col("is_target"), grams).otherwise(0)).alias("target"), F.sum(grams).alias("raw"))
    weights = np.zeros(STRATA)
    for r in sums.collect():
        weights[r.stratum] = round(WEIGHT_STEPS * r.target / r.raw) if r.raw else 0
    return weights


def log_ratios(n_target: np.ndarray, n_raw: np.ndarray) -> np.ndarray:
    """Per bucket, log p(target) - log p(raw), of counts that have about the same total."""
    return np.log(n_target + SMOOTHING) - np.log(n_raw + SMOOTHING)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> np.ndarray:
    """The log ratios by bucket. Trusted are all rows of docs whose label is 1; lang, where docs have it, serves to weight the raw counts only."""
    trusted = labels.where((F.col(label) == 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("_trusted")).distinct()
    trusted = F.broadcast(trusted) if trusted.count() <= MOST_BROADCAST else trusted
    stratum = F.pmod(F.xxhash64(F.col("lang").cast("string")), F.lit(STRATA)).cast("int") if "lang" in docs.columns else F.lit(0)
    marked = docs.select(F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("text"), stratum.alias("stratum"))
    marked = marked.join(trusted, F.col("_id") == F.col("_trusted"), "left").withColumn("is_target", F.col("_trusted").isNotNull())
    weights = raw_weights(marked)
    if not weights.any():
        return np.zeros(BUCKETS)
    counts = np.zeros((2, BUCKETS))
    for row in count_grams(marked, weights).toPandas().itertuples(index=False):
        counts[:, row.bucket] = row.n_target, row.n_raw / WEIGHT_STEPS
    return log_ratios(*counts)


def gram_scores(ratios: np.ndarray, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The summed log ratio of each row, and its number of n-grams."""
    grams, counts = hashed_grams(data, at)
    return np.bincount(K.rows_of(counts), ratios[grams], minlength=len(counts)).astype(float), counts


def column_scores(ratios: np.ndarray, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    parts = [gram_scores(ratios, data, at) for _, _, data, at in K.text_slices(column)]
    if not parts:
        return np.zeros(0), np.zeros(0, np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
