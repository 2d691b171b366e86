"""Pileups, markers and choices among alignments."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.operators import cigar
from helixframe.operators.intervals import TILE, joined_tiles


def read_bases(pileup: DataFrame) -> DataFrame:
    """(read, first, seq): a read's bases (read, pos, base) in the order of position, as one text."""
    rows = pileup.groupBy("read").agg(F.array_sort(F.collect_list(F.struct("pos", "base"))).alias("b"))
    return rows.select("read", F.col("b")[0]["pos"].alias("first"), F.array_join(F.transform("b", lambda x: x["base"]), "").alias("seq"))


def allele_depths(pileup: DataFrame, samples: list[str]) -> DataFrame:
    """(chrom, pos, allele, and per sample its forward and reverse depth): counts before the shuffle, then one column per sample and strand."""
    n = lambda s, r: F.sum(((F.col("sample") == s) & (F.col("is_reverse") == F.lit(r))).cast("long")).alias(f"{s}_{'rev' if r else 'fwd'}")
    return pileup.groupBy("chrom", "pos", "allele").agg(*[n(s, r) for s in samples for r in (False, True)])


def pileup_variants(pileup: DataFrame, least: int) -> DataFrame:
    """(chrom, pos, ref, alts, depths, majority) of sites (chrom, pos, ref, allele) where an allele other than the reference has that depth.

    Alleles by falling depth, then name; majority is the deepest of all alleles, the reference first among equals.
    """
    depth = pileup.groupBy("chrom", "pos", "ref", "allele").agg(F.count(F.lit(1)).alias("n"))
    site = depth.groupBy("chrom", "pos", "ref").agg(
        F.array_sort(F.collect_list(F.when((F.col("allele") != F.col("ref")) & (F.col("n") >= least), F.struct((-F.col("n")).alias("d"), F.col("allele").alias("a"))))).alias("v"),
        F.min(F.struct((-F.col("n")).alias("d"), (F.col("allele") != F.col("ref")).alias("o"), F.col("allele").alias("a"))).alias("m"))
    site = site.where(F.size("v") > 0)
    return site.select("chrom", "pos", "ref", F.array_join(F.transform("v", lambda x: x["a"]), ",").alias("alts"), F.array_join(F.transform("v", lambda x: (-x["d"]).cast("string")), ",").alias("depths"), F.col("m.a").alias("majority"))


def reads_without_snp_clusters(sites: DataFrame, gap: int = 1000, most: float = 0.3, least_quality: int = 10) -> DataFrame:
    """Reads of sites (read, chrom, pos, is_alt, quality) of which no cluster (sites at most `gap` apart) has a share of `most` or more alternative alleles;
    sites of lower quality are not looked at."""
    w = W.partitionBy("read", "chrom").orderBy("pos")
    rows = sites.where(F.col("quality") >= least_quality).withColumn("_new", F.when(F.col("pos") - F.lag("pos").over(w) <= gap, 0).otherwise(1)).withColumn("_part", F.sum("_new").over(w))
    bad = rows.groupBy("read", "chrom", "_part").agg(F.avg(F.col("is_alt").cast("double")).alias("share")).where(F.col("share") >= most).select("read").distinct()
    return sites.select("read").distinct().join(bad, "read", "left_anti")


def homozygous_runs(ops: DataFrame, least: int, key: str = "aln") -> DataFrame:
    """(key, r_start, r_end, q_start, q_end): single = operations of at least so many letters, in both coordinates."""
    return cigar.segments(ops, key).where((F.col("op") == cigar.EQ) & (F.col("r_end") - F.col("r_start") >= least)).drop("op")


def marker_scores(markers: DataFrame, least_quality: int = 20) -> DataFrame:
    """(read, aln, score, n) of markers (read, aln, read_pos, quality, is_match): a mismatch adds -q - 10 ln 3, a match 10 log10(1 - 10 ** (-q / 10)).

    A read position counts only if its quality suffices and alignments disagree there.
    """
    rows = markers.where(F.col("quality") >= least_quality)
    told = rows.groupBy("read", "read_pos").agg(F.min("is_match").alias("lo"), F.max("is_match").alias("hi")).where("lo <> hi").select("read", "read_pos")
    rows = rows.join(told, ["read", "read_pos"], "left_semi")
    q = F.col("quality").cast("double")
    value = F.when(F.col("is_match"), 10 * F.log10(1 - F.pow(F.lit(10.0), -q / 10))).otherwise(-q - 10 * math.log(3))
    return rows.groupBy("read", "aln").agg(F.round(F.sum(value), 6).alias("score"), F.count(F.lit(1)).alias("n"))


def better_alignments(scores: DataFrame, margin: float, least: float) -> DataFrame:
    """(read, primary, chosen): reads of (read, aln, is_primary, score) whose best secondary passes the primary's score by the margin and reaches `least`.
    Of equal secondaries the one of the least aln."""
    rows = scores.groupBy("read").agg(F.max(F.when(F.col("is_primary"), F.struct("score", "aln"))).alias("p"), F.min(F.when(~F.col("is_primary"), F.struct((-F.col("score")).alias("score"), F.col("aln").alias("aln")))).alias("s"))
    rows = rows.where((-F.col("s.score") > F.col("p.score") + margin) & (-F.col("s.score") >= least))
    return rows.select("read", F.col("p.aln").alias("primary"), F.col("s.aln").alias("chosen"))


def corrected_alignments(alns: DataFrame, better: DataFrame, mapq: DataFrame, least_read: int, least_block: int, most_divergence: float) -> DataFrame:
    """Alignments (read, aln, is_primary, mapq, read_len, block, divergence) with primaries swapped as `better` says, qualities from mapq (aln, new_mapq) where given,
    and short, small or diverged ones left out."""
    rows = alns.join(better.select("read", "primary", "chosen"), "read", "left").join(mapq, "aln", "left")
    primary = F.when(F.col("chosen").isNull(), F.col("is_primary")).otherwise((F.col("aln") == F.col("chosen")) | (F.col("is_primary") & (F.col("aln") != F.col("primary"))))
    rows = rows.withColumn("is_primary", primary).withColumn("mapq", F.coalesce("new_mapq", "mapq"))
    return rows.where((F.col("read_len") >= least_read) & (F.col("block") >= least_block) & (F.col("divergence") <= most_divergence)).select("read", "aln", "is_primary", "mapq")


def control_break_records(lines: DataFrame) -> DataFrame:
    """(record, read, source, target) of lines (line_no, value) in which a $ line names a read, a * line below it its primary and an @ line the better place."""
    rows = lines.withColumn("record", F.sum(F.col("value").startswith("$").cast("long")).over(W.orderBy("line_no"))).withColumn("f", F.split("value", "\t"))
    pick = lambda mark: F.max(F.when(F.col("f")[0] == mark, F.try_element_at("f", F.lit(2))))
    out = rows.where("record > 0").groupBy("record").agg(pick("$").alias("read"), pick("*").alias("source"), pick("@").alias("target"))
    return out.where("target is not null")


def nearest_blocks(reads: DataFrame, blocks: DataFrame, n: int = 2, tile: int = TILE) -> DataFrame:
    """(read, block, dist, rk): the n blocks (block, chrom, b_start, b_end) nearest to each read (read, chrom, start, end), by max(starts) - min(ends),
    which is negative where they overlap; of equal ones the least block.

    Blocks may not overlap each other. Then the n nearest are among the n that begin before the read's start or at it and the n that begin after it, which two
    passes in the order of starts carry along within tiles: no read meets all blocks.
    """
    cell = F.struct("b_start", "b_end", "block")
    w = W.partitionBy("chrom").orderBy("b_start")
    # Each block knows the n - 1 before it and after it.
    around = blocks.withColumn("_back", F.array(*[F.lag(cell, i).over(w) for i in range(n)])).withColumn("_on", F.array(*[F.lead(cell, i).over(w) for i in range(n)]))
    points = reads.select("chrom", F.col("start").alias("at"), F.struct("read", "start", "end").alias("r"), F.lit(None).cast(around.schema["_back"].dataType).alias("_back"), F.lit(None).cast(around.schema["_on"].dataType).alias("_on"))
    marks = around.select("chrom", F.col("b_start").alias("at"), F.lit(None).cast(points.schema["r"].dataType).alias("r"), "_back", "_on")
    both = points.unionByName(marks).withColumn("_tile", F.floor(F.col("at") / tile))
    # Within a tile; both frames end at the row, as one that ends with the partition would be gone through anew for each row. At equal places blocks (no read) come first.
    w = W.partitionBy("chrom", "_tile")
    sofar = lambda *order: w.orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    rows = both.withColumn("_b", F.last("_back", True).over(sofar("at", F.col("r").isNotNull()))).withColumn("_o", F.last("_on", True).over(sofar(F.desc("at"), F.col("r").isNull()))).where("r is not null")
    # A read without a block before or after it in its tile takes the nearest one of the tiles beyond.
    tiles = both.groupBy("chrom", "_tile").agg(F.max_by("_back", F.when(F.col("r").isNull(), F.col("at"))).alias("_b"), F.min_by("_on", F.when(F.col("r").isNull(), F.col("at"))).alias("_o"))
    beyond = lambda c, order: F.last(c, True).over(W.partitionBy("chrom").orderBy(order).rowsBetween(W.unboundedPreceding, -1))
    tiles = tiles.select("chrom", "_tile", beyond("_b", F.col("_tile")).alias("_earlier"), beyond("_o", F.desc("_tile")).alias("_later"))
    rows = joined_tiles(rows, tiles, ["chrom"]).withColumn("_b", F.coalesce("_b", "_earlier")).withColumn("_o", F.coalesce("_o", "_later"))
    near = rows.select("r.*", F.explode(F.concat(F.coalesce("_b", F.array().cast(around.schema["_back"].dataType)), F.coalesce("_o", F.array().cast(around.schema["_on"].dataType)))).alias("c")).where("c is not null")
    near = near.withColumn("dist", F.greatest("start", "c.b_start") - F.least("end", "c.b_end"))
    near = near.withColumn("rk", F.row_number().over(W.partitionBy("read").orderBy("dist", "c.block"))).where(F.col("rk") <= n)
    return near.select("read", F.col("c.block").alias("block"), "dist", F.col("rk").cast("long").alias("rk"))
