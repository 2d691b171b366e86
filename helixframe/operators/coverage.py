"""Coverage tables, labels and windows along contigs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def merge_fit_tables(tables: DataFrame, parts: tuple[str, ...] = ("error", "duplicated", "haploid", "collapsed")) -> DataFrame:
    """One row per coverage of several fitted tables (coverage, freq, fit, and a share per part): freq and fit add up, shares are averaged with
    weight fit and scaled to add up to 1; null where no table fits."""
    sums = tables.groupBy("coverage").agg(F.sum("freq").alias("freq"), F.sum("fit").alias("fit"), *[F.sum(F.col(p) * F.col("fit")).alias(p) for p in parts])
    total = sum((F.col(p) for p in parts), F.lit(0.0))
    return sums.withColumn("_total", total).select("coverage", "freq", "fit", *[F.try_divide(F.col(p), F.col("_total")).alias(p) for p in parts])


def tables_with_outliers(tables: DataFrame, key: str, order: str, value: str, factor: float = 3) -> DataFrame:
    """(key, bad): whether any inner value is more than `factor` times both of its neighbours."""
    w = W.partitionBy(key).orderBy(order)
    rows = tables.withColumn("_p", F.lag(value).over(w)).withColumn("_n", F.lead(value).over(w))
    return rows.groupBy(key).agg(F.coalesce(F.bool_or((F.col(value) > factor * F.col("_p")) & (F.col(value) > factor * F.col("_n"))), F.lit(False)).alias("bad"))


def label_sizes_by_stratum(labels: DataFrame, strata: DataFrame, unreliable: tuple[str, ...]) -> DataFrame:
    """(stratum, label, megabases, unreliable_percent) of labelled blocks (chrom, start, end, label) within strata (chrom, start, end, stratum)."""
    from helixframe.operators.intervals import overlap_join

    hits = overlap_join(labels, strata.withColumnRenamed("start", "b_start").withColumnRenamed("end", "b_end"))
    size = F.least("end", "b_end") - F.greatest("start", "b_start")
    sums = hits.groupBy("stratum", "label").agg(F.sum(size).alias("size"))
    w = W.partitionBy("stratum")
    bad = F.sum(F.when(F.col("label").isin(*unreliable), F.col("size")).otherwise(0)).over(w)
    return sums.select("stratum", "label", F.round(F.col("size") / 1e6, 6).alias("megabases"), F.round(100 * bad / F.sum("size").over(w), 6).alias("unreliable_percent"))


def best_label(probabilities: list[Column], names: list[str]) -> Column:
    """The name of the largest probability; of equal ones the first."""
    values = F.array(*probabilities)
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.array_position(values, F.array_max(values)).cast("int"))


def label_runs(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Merge blocks (start, end closed) of one label that follow each other without a gap."""
    w = W.partitionBy(*keys).orderBy("start")
    same = (F.lag(label).over(w) == F.col(label)) & (F.lag("end").over(w) + 1 == F.col("start"))
    rows = df.withColumn("_run", F.sum(F.when(same, 0).otherwise(1)).over(w))
    return rows.groupBy(*keys, label, "_run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_run")


def covered_windows(blocks: DataFrame, width: int) -> DataFrame:
    """Cut blocks (chrom, start, end) into windows of `width` covered letters each; a contig has floor(covered / width) of them (1 at least), the last takes the rest.

    (chrom, window from 0, start, end): a block that crosses a border is cut there. Blocks may not overlap.
    """
    w = W.partitionBy("chrom").orderBy("start")
    rows = blocks.withColumn("_upto", F.sum(F.col("end") - F.col("start")).over(w)).withColumn("_from", F.col("_upto") - (F.col("end") - F.col("start")))
    totals = blocks.groupBy("chrom").agg(F.greatest(F.floor(F.sum(F.col("end") - F.col("start")) / width), F.lit(1)).alias("_windows"))
    rows = rows.join(totals, "chrom")
    number = lambda at: F.least(F.floor(at / width), F.col("_windows") - 1)
    rows = rows.withColumn("window", F.explode(F.sequence(number(F.col("_from")), number(F.col("_upto") - 1))))
    low = F.greatest(F.col("_from"), F.col("window") * width)
    high = F.when(F.col("window") == F.col("_windows") - 1, F.col("_upto")).otherwise(F.least(F.col("_upto"), (F.col("window") + 1) * width))
    return rows.select("chrom", "window", (F.col("start") + low - F.col("_from")).alias("start"), (F.col("start") + high - F.col("_from")).alias("end"))


def balanced_parts(blocks: DataFrame, n: int) -> DataFrame:
    """Deal blocks (chrom, start, end) in order to n parts of equal size (the last may be smaller), cutting them at the borders: (part from 1, chrom, start, end)."""
    sizes = blocks.groupBy("chrom").agg(F.sum(F.col("end") - F.col("start")).alias("_size"))
    # Contigs are few: their starts are running sums over one row each, blocks are summed within their contig.
    before = F.coalesce(F.sum("_size").over(W.orderBy("chrom").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    contigs = sizes.select("chrom", before.alias("_before"), F.floor(F.sum("_size").over(W.partitionBy(F.lit(1))) / n).alias("_w")).withColumn("_w", F.col("_w") + 1)
    rows = blocks.join(contigs, "chrom")
    size = F.col("end") - F.col("start")
    rows = rows.withColumn("_upto", F.col("_before") + F.sum(size).over(W.partitionBy("chrom").orderBy("start"))).withColumn("_from", F.col("_upto") - size)
    rows = rows.withColumn("part", F.explode(F.sequence(F.floor(F.col("_from") / F.col("_w")), F.floor((F.col("_upto") - 1) / F.col("_w")))))
    low, high = F.greatest(F.col("_from"), F.col("part") * F.col("_w")), F.least(F.col("_upto"), (F.col("part") + 1) * F.col("_w"))
    return rows.select((F.col("part") + 1).alias("part"), "chrom", (F.col("start") + low - F.col("_from")).alias("start"), (F.col("start") + high - F.col("_from")).alias("end"))


def proportional_gaps(blocks: DataFrame, contigs: DataFrame) -> DataFrame:
    """Fill the gaps of contigs (chrom, length) between typed blocks (chrom, start, end, kind): between equal kinds with that kind, else cut so that
    the longer block gets the larger part; ends of contigs go to the block beside them. (chrom, start, end, kind)."""
    w = W.partitionBy("chrom").orderBy("start", "end", "kind")
    rows = blocks.withColumn("_p", F.lag(F.struct("start", "end", "kind")).over(w)).withColumn("_last", F.lead("start").over(w).isNull()).join(contigs, "chrom")
    part = lambda s, e, k: F.struct(s.cast("long").alias("start"), e.cast("long").alias("end"), k.alias("kind"))
    size, before = F.col("end") - F.col("start"), F.col("_p.end") - F.col("_p.start")
    cut = F.floor((F.col("start") - F.col("_p.end")) * (before / (before + size))) + F.col("_p.end")
    inner = F.when(F.col("_p.kind") == F.col("kind"), F.array(part(F.col("_p.end"), F.col("start"), F.col("kind")))).otherwise(F.array(part(F.col("_p.end"), cut, F.col("_p.kind")), part(cut, F.col("start"), F.col("kind"))))
    head = F.when(F.col("_p").isNull(), F.array(part(F.lit(0), F.col("start"), F.col("kind")))).otherwise(inner)
    tail = F.when(F.col("_last"), F.array(part(F.col("end"), F.col("length"), F.col("kind")))).otherwise(F.slice(head, 1, 0))
    return rows.select("chrom", F.explode(F.concat(head, tail)).alias("g")).select("chrom", "g.*").where("start < end")


def uncovered_fraction_by_source(hits: DataFrame, contigs: DataFrame, distance: int, least: float) -> DataFrame:
    """Contigs (chrom, length) of which hits (chrom, start, end, source), merged where they are at most `distance` apart, cover a share of `least`
    or more: (chrom, covered, fraction, n_sources)."""
    from helixframe.operators.intervals import merge_blocks

    covered = merge_blocks(hits, distance).groupBy("chrom").agg(F.sum(F.col("end") - F.col("start")).alias("covered"))
    sources = hits.select("chrom", "source").distinct().groupBy("chrom").agg(F.count(F.lit(1)).alias("n_sources"))
    rows = contigs.join(covered, "chrom").join(sources, "chrom").withColumn("fraction", F.round(F.col("covered") / F.col("length"), 6))
    return rows.where(F.col("fraction") >= least).select("chrom", "covered", "fraction", "n_sources")


def genome_coverage(reads: DataFrame, contigs: DataFrame, length: str = "len") -> DataFrame:
    """One row (bases, genome, coverage)."""
    return reads.agg(F.sum(length).alias("bases")).join(F.broadcast(contigs.agg(F.sum("length").alias("genome")))).withColumn("coverage", F.round(F.col("bases") / F.col("genome"), 6))


def chromosome_completeness(hits: DataFrame, contigs: DataFrame, least: float) -> DataFrame:
    """(chrom, total, longest, n, complete) of alignments (chrom, start, end): whether the longest covers that share of the chromosome."""
    size = F.col("end") - F.col("start")
    x = hits.groupBy("chrom").agg(F.sum(size).alias("total"), F.max(size).alias("longest"), F.count(F.lit(1)).alias("n"))
    return x.join(contigs, "chrom").select("chrom", "total", "longest", "n", (F.col("longest") >= least * F.col("length")).alias("complete"))


def final_labels(tracks: DataFrame, contigs: DataFrame, distance: int = 100, least: int = 1000) -> DataFrame:
    """Labelled blocks of whole contigs: blocks (chrom, start, end, label) of one label at most `distance` apart become one, shorter ones than `least` go,
    what two labels claim is Amb, and what none does is Unk."""
    from helixframe.operators.intervals import complement, depth, islands, overlap_join

    merged = islands(tracks, ["chrom", "label"], distance).where(F.col("end") - F.col("start") >= least)
    # Of a stretch of constant depth 1 exactly one block holds the whole; deeper ones are claimed by several.
    cover = depth(merged.select("chrom", "start", "end"))
    single = overlap_join(cover.where("depth = 1"), merged.select("chrom", F.col("start").alias("b_start"), F.col("end").alias("b_end"), "label"))
    out = single.select("chrom", "start", "end", "label").unionByName(cover.where("depth > 1").select("chrom", "start", "end", F.lit("Amb").alias("label")))
    return islands(out, ["chrom", "label"]).unionByName(complement(merged.select("chrom", "start", "end"), contigs).select("chrom", F.lit("Unk").alias("label"), "start", "end"))


def histogram_peaks(histogram: DataFrame, value: str, n: str, reach: int = 3) -> DataFrame:
    """Values of a histogram whose count is the largest within `reach` values on both sides (the first of equal ones), and more than its direct neighbours' least."""
    w = W.orderBy(value)
    rows = histogram.withColumn("_left", F.max(n).over(w.rowsBetween(-reach, -1))).withColumn("_right", F.max(n).over(w.rowsBetween(1, reach)))
    return rows.where((F.col(n) > F.col("_left")) & (F.col(n) >= F.col("_right"))).select(value, n)


def collapsed_candidates(contig_hits: DataFrame, deletions: DataFrame, contigs: DataFrame, least: int) -> DataFrame:
    """Blocks (chrom, start, end) that assembled contigs do not cover, and long deletions, merged."""
    from helixframe.operators.intervals import complement, merge_blocks

    bare = complement(contig_hits, contigs).select("chrom", "start", "end")
    return merge_blocks(bare.unionByName(deletions.where(F.col("end") - F.col("start") >= least).select("chrom", "start", "end")))
