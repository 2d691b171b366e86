"""Projection of blocks through alignments of assembled contigs, on both strands and in both directions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.operators.cigar import EQ, D, I, M, N, X
from helixframe.operators.intervals import complement, merge_blocks, overlap_join

_ON_REFERENCE, _ON_CONTIG = (M, D, N, EQ, X), (M, I, EQ, X)


def elements(ops: DataFrame, alignments: DataFrame, key: str = "aln") -> DataFrame:
    """The operations of alignments (key, chrom, r_start, contig, q_start, q_end, is_reverse) with their place on both forward strands.

    ops (key, idx, op, len) hold no clipped letters. On a reverse strand operations run from the contig's q_end to its q_start. One side
    of an insertion or deletion is empty.
    """
    before = W.partitionBy(key).orderBy("idx").rowsBetween(W.unboundedPreceding, -1)
    size = lambda kinds: F.when(F.col("op").isin(*kinds), F.col("len")).otherwise(0).cast("long")
    moved = lambda kinds: F.coalesce(F.sum(size(kinds)).over(before), F.lit(0))
    rows = ops.withColumn("_r", moved(_ON_REFERENCE)).withColumn("_q", moved(_ON_CONTIG)).join(alignments, key)
    q = F.when(F.col("is_reverse"), F.col("q_end") - F.col("_q") - size(_ON_CONTIG)).otherwise(F.col("q_start") + F.col("_q"))
    r = F.col("r_start") + F.col("_r")
    return rows.select(key, "op", "len", "is_reverse", "chrom", "contig", r.alias("r_start"), (r + size(_ON_REFERENCE)).alias("r_end"), q.alias("q_start"), (q + size(_ON_CONTIG)).alias("q_end"))


def project(blocks: DataFrame, parts: DataFrame, block: str, to_contig: bool = False, key: str = "aln") -> DataFrame:
    """Project blocks (block, chrom, start, end) through the elements of alignments, from contigs to the reference or back.

    (block, key, from_start, from_end, target, to_start, to_end, percent): a block is cut to the aligned letters that it covers, so that it neither begins nor
    ends in a gap; one that covers none has no row. percent is the share of the projection's length that mismatches and the gaps
    strictly inside of the block amount to.
    """
    name, here, other, there = ("chrom", "r", "contig", "q") if to_contig else ("contig", "q", "chrom", "r")
    side = parts.select(F.col(name).alias("chrom"), F.col(f"{here}_start").alias("b_start"), F.col(f"{here}_end").alias("b_end"), F.col(other).alias("target"), F.col(f"{there}_start").alias("t_start"),
                        F.col(f"{there}_end").alias("t_end"), key, "op", "len", "is_reverse")
    hits = overlap_join(blocks.select(block, "chrom", "start", "end"), side, 1000)
    low, high = F.greatest("start", "b_start"), F.least("end", "b_end")
    aligned, gap = F.col("op").isin(M, EQ, X), F.col("op").isin(I, D)
    inside = (F.col("start") < F.col("b_start")) & (F.col("b_end") < F.col("end"))
    differ = F.when(F.col("op") == X, high - low).when(gap & inside, F.col("len")).otherwise(0)
    to_low = F.when(F.col("is_reverse"), F.col("t_start") + F.col("b_end") - high).otherwise(F.col("t_start") + low - F.col("b_start"))
    to_high = F.when(F.col("is_reverse"), F.col("t_end") - (low - F.col("b_start"))).otherwise(F.col("t_end") - (F.col("b_end") - high))
    out = hits.groupBy(block, key, "target").agg(
        F.min(F.when(aligned, low)).alias("from_start"), F.max(F.when(aligned, high)).alias("from_end"), F.min(F.when(aligned, to_low)).alias("to_start"),
        F.max(F.when(aligned, to_high)).alias("to_end"), F.sum(differ).alias("_differ"),
    ).where("from_start is not null")
    return out.select(block, key, "from_start", "from_end", "target", "to_start", "to_end", (100 * F.col("_differ") / (F.col("to_end") - F.col("to_start"))).alias("percent"))


def duplicated_candidates(alignments: DataFrame, ops: DataFrame, contigs: DataFrame, longer: int, key: str = "aln") -> DataFrame:
    """Merged blocks (chrom, start, end) of contigs (chrom, length) that may be falsely duplicated.

    These are what no primary alignment (as for elements, with r_end) covers, insertions of more than `longer` letters, and the projections of the stretch
    of the reference that an alignment shares with the one before it, in the order of (chrom, r_start, r_end, key), through both.
    """
    parts = elements(ops, alignments, key)
    bare = complement(alignments.select(F.col("contig").alias("chrom"), F.col("q_start").alias("start"), F.col("q_end").alias("end")), contigs).select("chrom", "start", "end")
    inserted = parts.where((F.col("op") == I) & (F.col("len") > longer)).select(F.col("contig").alias("chrom"), F.col("q_start").alias("start"), F.col("q_end").alias("end"))
    w = W.partitionBy("chrom").orderBy("r_start", "r_end", key)
    shared = alignments.select(F.col(key).alias("_one"), F.lag(key).over(w).alias("_two"), F.col("r_start").alias("start"), F.least("r_end", F.lag("r_end").over(w)).alias("end")).where("_two IS NOT NULL AND start < end")
    # Each of both alignments is a sequence of its own here: the stretch goes through no third one.
    shared = shared.select("start", "end", F.explode(F.array("_one", "_two")).alias("chrom")).withColumn("block", F.struct("chrom", "start"))
    both = project(shared, parts.withColumn("chrom", F.col(key)), "block", True, key)
    both = both.select(F.col("target").alias("chrom"), F.col("to_start").alias("start"), F.col("to_end").alias("end"))
    return merge_blocks(bare.unionByName(inserted).unionByName(both))
