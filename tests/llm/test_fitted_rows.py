"""Cases in which the form before counted fewer rows."""

import numpy as np
from pyspark.sql import functions as F

from helixframe.llm import ngram_models


def test_all_trusted_rows_are_fitted(spark):
    docs = spark.range(200_020).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id").cast("string")).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    # If every row is trusted, target and raw counts are the same.
    assert not ngram_models.fit(docs, labels).any()


def test_many_trusted_rows_are_joined_without_a_broadcast(spark, monkeypatch):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.md5(F.col("id").cast("string")).alias("text"))
    labels = docs.where("doc_id % 3 = 0").select("doc_id", F.lit(1).alias("quality"))
    wanted = ngram_models.fit(docs, labels)
    monkeypatch.setattr(ngram_models, "MOST_BROADCAST", 10)
    assert wanted.any() and np.array_equal(ngram_models.fit(docs, labels), wanted)
