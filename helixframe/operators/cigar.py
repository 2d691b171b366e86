"""CIGAR operators on arrays or exploded tables of (op, len)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.operators.intervals import overlap_join

M, I, D, N, S, H, EQ, X = 0, 1, 2, 3, 4, 5, 7, 8  # noqa: E741
OF_REFERENCE = (M, D, N, EQ, X)
OF_QUERY = (M, I, S, EQ, X)
LETTERS = "MIDNSHP=X"


def parse(text: Column) -> Column:
    """A CIGAR string as an array of (op, len)."""
    pattern = F.lit(r"(\d+)([MIDNSHP=X])")
    pairs = F.arrays_zip(F.regexp_extract_all(text, pattern, F.lit(2)).alias("o"), F.regexp_extract_all(text, pattern, F.lit(1)).alias("l"))
    return F.transform(pairs, lambda x: F.struct((F.position(x["o"], F.lit(LETTERS)) - 1).alias("op"), x["l"].cast("int").alias("len")))


def indels(ops: DataFrame, least: int, key: str = "aln") -> DataFrame:
    """Insertions and deletions of at least so many letters, with reference and query offsets, of a table (key, idx, op, len)."""
    before = W.partitionBy(key).orderBy("idx").rowsBetween(W.unboundedPreceding, -1)
    moved = lambda kinds: F.coalesce(F.sum(F.when(F.col("op").isin(*kinds), F.col("len")).otherwise(0)).over(before), F.lit(0))
    rows = ops.withColumn("ref_offset", moved(OF_REFERENCE)).withColumn("query_offset", moved(OF_QUERY))
    rows = rows.where(F.col("op").isin(I, D) & (F.col("len") >= least))
    return rows.select(key, "ref_offset", "query_offset", "len", F.when(F.col("op") == I, "INS").otherwise("DEL").alias("svtype"))


def query_span(ops: DataFrame, key: str = "aln") -> DataFrame:
    """Letters of the read, and those the alignment covers on the reference."""
    part = lambda kinds: F.sum(F.when(F.col("op").isin(*kinds), F.col("len")).otherwise(0))
    return ops.groupBy(key).agg(part((M, I, S, H)).alias("read_len"), part((M, D)).alias("ref_len"), F.count(F.lit(1)).alias("n_ops"))


def segments(ops: DataFrame, key: str = "aln") -> DataFrame:
    """The stretches that stand on both sides (M, =, X) of a table (key, idx, op, len): r_start, r_end, q_start, q_end from 0."""
    before = W.partitionBy(key).orderBy("idx").rowsBetween(W.unboundedPreceding, -1)
    moved = lambda kinds: F.coalesce(F.sum(F.when(F.col("op").isin(*kinds), F.col("len")).otherwise(0)).over(before), F.lit(0))
    rows = ops.withColumn("r_start", moved(OF_REFERENCE)).withColumn("q_start", moved(OF_QUERY)).where(F.col("op").isin(M, EQ, X) & (F.col("len") > 0))
    return rows.select(key, "op", "r_start", (F.col("r_start") + F.col("len")).alias("r_end"), "q_start", (F.col("q_start") + F.col("len")).alias("q_end"))


def lift(blocks: DataFrame, segs: DataFrame, block: str, key: str = "aln", to_query: bool = True) -> DataFrame:
    """Project blocks (block, key, start, end) through alignments: the part that can be projected and its projection.

    A block is cut to the aligned letters it covers; one that covers none gives no row. With to_query=False
    blocks are on the query and go to the reference. Negative strands: turn blocks (length - end, length - start) first.
    """
    here, there = ("r", "q") if to_query else ("q", "r")
    side = segs.select(F.col(key).alias("chrom"), F.col(f"{here}_start").alias("b_start"), F.col(f"{here}_end").alias("b_end"), F.col(f"{there}_start").alias("t_start"))
    hits = overlap_join(blocks.select(block, F.col(key).alias("chrom"), "start", "end"), side, 1000)
    low, high = F.greatest("start", "b_start"), F.least("end", "b_end")
    shift = F.col("t_start") - F.col("b_start")
    out = hits.groupBy(block, F.col("chrom").alias(key)).agg(F.min(low).alias("from_start"), F.max(high).alias("from_end"), F.min(low + shift).alias("to_start"), F.max(high + shift).alias("to_end"), F.sum(high - low).alias("n_aligned"))
    return out
