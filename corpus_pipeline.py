"""A corpus pipeline of five stages; each is one corpus operator applied to all that the stage before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes as
Parquet to the folder that driver and executors share and reads again for the next one:
lineage is short, and a lost executor costs the tasks it ran.

1. quality classifier: documents that it rejects go.
2. n-gram Jaccard join: the document of the least id of each near-duplicate group stays.
3. secret scan: secrets in the texts are replaced.
4. mixing: each source's documents are repeated or sampled to its target.
5. best-fit packing: one row per piece, with its place in a sequence.

All stages but the last keep the columns of documents. Edge cases are those of the operators;
an empty table passes through all stages as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from helixframe.llm import common, mixing, ngram_join, packing, quality_classifier, secrets


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_classifier.pipeline_stage(spark, docs, sf_dir)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.pipeline_stage(spark, docs, sf_dir)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.pipeline_stage(spark, docs, sf_dir)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.pipeline_stage(spark, docs, sf_dir)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pipeline_stage(spark, docs, sf_dir)


STAGES = [
    ("quality_classifier", quality),
    ("ngram_join", near_duplicates),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack),
]

#: SQL can express neither the importance weights nor best-fit packing; tests compare the stages with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
