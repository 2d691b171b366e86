"""Variant records: sizes, multi-allelic records, phasing, allele sequences, breakends, merging and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def size_between(ref: Column, alt: Column, least: int = 2, most: int = 50) -> Column:
    """Whether the alleles' lengths differ by that many letters."""
    return F.abs(F.length(alt) - F.length(ref)).between(least, most)


def split_alleles(records: DataFrame) -> DataFrame:
    """(chrom, pos, allele_no, alt, info, id) of records (chrom, pos, alt, info) with comma-separated lists of alleles and their infos.

    The allele * gives no row. Ids are chrom-type-n-pos, where n counts a contig's records of the type in the order of position and allele.
    """
    rows = records.withColumn("alts", F.split("alt", ",")).withColumn("infos", F.split("info", ","))
    rows = rows.select("chrom", "pos", "infos", F.col("info").alias("_info"), F.posexplode("alts").alias("allele_no", "alt"))
    info = F.when(F.size("infos") > 1, F.try_element_at("infos", F.col("allele_no") + 1)).otherwise(F.col("_info"))
    rows = rows.withColumn("info", info).where("alt <> '*'")
    kind = F.when(F.col("info").contains("SVTYPE=INS"), "INS").when(F.col("info").contains("SVTYPE=DEL"), "DEL").otherwise("SNP")
    rows = rows.withColumn("_kind", kind).withColumn("_n", F.row_number().over(W.partitionBy("chrom", "_kind").orderBy("pos", "allele_no", "alt")))
    return rows.select("chrom", "pos", "allele_no", "alt", "info", F.concat_ws("-", "chrom", "_kind", "_n", "pos").alias("id"))


def phase_by_contig(gt: Column, contig: Column) -> tuple[Column, Column]:
    """(phased genotype, phase set): het calls go to the haplotype of their contig PS<n>_..._hp<h>; all others are on both."""
    het = gt.isin("0/1", "1/0")
    phased = F.when(het & contig.contains("hp1"), "1|0").when(het, "0|1").otherwise("1|1")
    number = F.regexp_extract(contig, r"^PS(\d+)_", 1)
    return phased, F.when(number != "", number)


def phase_complex(gt: Column, reads: Column) -> tuple[Column, Column]:
    """(genotype with | for /, phase set named by the first read)."""
    number = F.regexp_extract(reads, r"PS(\d+)", 1)
    return F.regexp_replace(gt, "/", "|"), F.when(number != "", number)


def with_info(info: Column, key: str, value: Column) -> Column:
    """The info text with a key appended; null values append nothing."""
    return F.when(value.isNull(), info).otherwise(F.concat(info, F.lit(f";{key}="), value.cast("string")))


def contig_haplotype(contig: Column) -> Column:
    """A contig's name without its last part."""
    return F.regexp_replace(contig, r"_[^_]*$", "")


def window_coordinates(name: Column, start: Column, end: Column) -> tuple[Column, Column, Column]:
    """(contig, start, end) of a block on a window named contig:from-to."""
    offset = F.regexp_extract(name, r":(\d+)-\d+$", 1).try_cast("long")
    return F.regexp_replace(name, r":\d+-\d+$", ""), start + offset, end + offset


def breakend_alt(chrom: Column, pos: Column, forward: Column, n_forward: Column) -> Column:
    """The ALT text of a breakend: N[c:p[, N]c:p], ]c:p]N or [c:p[N, by the directions of this end and its mate."""
    there = F.concat_ws(":", chrom, pos)
    return F.when(forward & n_forward, F.concat(F.lit("N["), there, F.lit("["))).when(forward, F.concat(F.lit("N]"), there, F.lit("]"))).when(n_forward, F.concat(F.lit("["), there, F.lit("[N"))).otherwise(F.concat(F.lit("]"), there, F.lit("]N")))


def parse_breakend(alt: Column) -> dict[str, Column]:
    """chrom, pos, bracket and whether this end comes first, of an ALT text."""
    inner = r"[\[\]]([^\[\]]+):(\d+)[\[\]]"
    return {"chrom": F.regexp_extract(alt, inner, 1), "pos": F.regexp_extract(alt, inner, 2).try_cast("long"), "bracket": F.when(alt.contains("["), "[").otherwise("]"), "first": ~F.substring(alt, 1, 1).isin("[", "]")}


def contig_order(chrom: Column) -> Column:
    """A key that sorts chr10 after chr2; names without a number come last."""
    return F.coalesce(F.regexp_extract(chrom, r"(\d+)", 1).try_cast("int"), F.lit(1 << 30))


def phase_set_genotype(sample: Column) -> Column:
    """GT:PS of a sample column whose last field is the phase set."""
    parts = F.split(sample, ":")
    return F.concat_ws(":", parts[0], F.element_at(parts, -1))


def allele_sequences(calls: DataFrame, seqs: DataFrame) -> DataFrame:
    """(svid, ref, alt) of calls (svid, contig, start, svlen, svtype, strand) on sequences (contig, seq): the inserted letters, of the reverse strand where
    it is -, or the deleted ones, after one letter of the reference, as start is 0-based. Reverse starts count from the sequence's other end."""
    from helixframe.operators.sequence import reverse_complement

    rows = calls.join(seqs, "contig")
    here = F.when(F.col("strand") == "-", F.length("seq") - F.col("start") - F.col("svlen")).otherwise(F.col("start"))
    part = F.upper(F.substring(F.col("seq"), (here + 1).cast("int"), F.col("svlen").cast("int")))
    part = F.when(F.col("strand") == "-", reverse_complement(part)).otherwise(part)
    anchor = F.upper(F.substring(F.col("seq"), F.greatest(F.col("start"), F.lit(1)).cast("int"), F.lit(1)))
    ins = F.col("svtype") == "INS"
    return rows.select("svid", F.when(ins, anchor).otherwise(F.concat(anchor, part)).alias("ref"), F.when(ins, F.concat(anchor, part)).otherwise(anchor).alias("alt"))


def consecutive_clusters(df: DataFrame, keys: list[str], ends: list[str], most: int) -> DataFrame:
    """Rows with `cluster`, a number from 1 per key: a row joins the one before it (in the order of the ends) if each end is at most so far from that one's."""
    w = W.partitionBy(*keys).orderBy(*ends)
    close = F.lit(True)
    for e in ends:
        close = close & (F.abs(F.col(e) - F.lag(e).over(w)) <= most)
    return df.withColumn("_new", F.when(close, 0).otherwise(1)).withColumn("cluster", F.sum("_new").over(w.rangeBetween(W.unboundedPreceding, 0) if len(ends) == 1 else w.rowsBetween(W.unboundedPreceding, 0))).drop("_new")


def vote_genotypes(clustered: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, cluster, start, n, gt): per cluster, the first start and the haplotypes that any member has (gt: a/b)."""
    bits = F.split("gt", "/")
    bit = lambda i: F.max(bits[i].cast("int")).cast("string")
    return clustered.groupBy(*keys, "cluster").agg(F.min("start").alias("start"), F.count(F.lit(1)).alias("n"), F.concat_ws("/", bit(0), bit(1)).alias("gt"))


def realigned_duplications(calls: DataFrame, hits: DataFrame, least_mapq: int = 50, least_similar: float = 0.7, most_shift: int = 300, most_share: float = 0.3) -> DataFrame:
    """The best alignment of each inserted sequence next to its call, which makes it a duplication.

    calls (svid, chrom, pos, svlen), hits (svid, h_chrom, h_start, h_end, mapq). Of several hits that pass, the one of the largest sum of
    standardised similarity, -shift and -shift / svlen; at equal sums the leftmost, longest.
    """
    rows = calls.join(hits, "svid").where((F.col("chrom") == F.col("h_chrom")) & (F.col("mapq") >= least_mapq) & (F.col("h_end") > F.col("h_start")))
    size = F.col("h_end") - F.col("h_start")
    rows = rows.withColumn("similar", F.least(size, "svlen") / F.greatest(size, "svlen")).withColumn("shift", F.least(F.abs(F.col("h_start") - F.col("pos")), F.abs(F.col("h_end") - F.col("pos"))))
    rows = rows.withColumn("share", F.col("shift") / F.col("svlen")).where((F.col("similar") >= least_similar) & (F.col("shift") <= most_shift) & (F.col("share") <= most_share))
    w = W.partitionBy("svid")
    score = lambda c: (c - F.avg(c).over(w)) / (F.stddev_pop(c).over(w) + 0.0001)
    rows = rows.withColumn("score", F.round(score(F.col("similar")) + score(-F.col("shift")) + score(-F.col("share")), 6))
    best = rows.withColumn("_rank", F.row_number().over(w.orderBy(F.desc("score"), "h_start", F.desc("h_end")))).where("_rank = 1")
    return best.select("svid", "h_start", "h_end", "shift", F.round("similar", 6).alias("similar"))


def diploid_summary(variants: DataFrame, confident: DataFrame) -> DataFrame:
    """(kind, n_hom, n_het) of variants (chrom, pos, ref, alt, gt) inside confident blocks (chrom, start, end), with heterozygosity per confident letter.

    kind: SNP (one letter for one), INS, DEL, or MIXED (several alleles).
    """
    from helixframe.operators.intervals import merge_blocks, overlap_join

    merged = merge_blocks(confident)
    points = variants.select("*", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"))
    inside = overlap_join(points, merged.select("chrom", F.col("start").alias("b_start"), F.col("end").alias("b_end")))
    kind = F.when(F.col("alt").contains(","), "MIXED").when(F.length("alt") > F.length("ref"), "INS").when(F.length("alt") < F.length("ref"), "DEL").otherwise("SNP")
    hom = (F.split("gt", "[/|]")[0] == F.split("gt", "[/|]")[1]).cast("long")
    counts = inside.groupBy(kind.alias("kind")).agg(F.sum(hom).alias("n_hom"), F.sum(1 - hom).alias("n_het"))
    total = merged.agg(F.sum(F.col("end") - F.col("start")).alias("confident"))
    return counts.join(F.broadcast(total)).select("kind", "n_hom", "n_het", "confident", F.round(F.col("n_het") / F.col("confident"), 9).alias("heterozygosity"))


def pair_haploid_calls(a: DataFrame, b: DataFrame) -> DataFrame:
    """Phased genotypes of two haploid call sets (chrom, pos, ref, allele, depth): allele 0 is the reference, a missing row a gap.

    filter: GAP where one side is missing, HET where alleles differ, PASS else; ad adds both depths. Sites with the reference on both sides give no row.
    """
    x = a.select("chrom", "pos", "ref", F.col("allele").alias("a"), F.col("depth").alias("da"))
    y = b.select("chrom", "pos", "ref", F.col("allele").alias("b"), F.col("depth").alias("db"))
    rows = x.join(y, ["chrom", "pos", "ref"], "full").where("not (coalesce(a, 0) = 0 and coalesce(b, 0) = 0)")
    gt = F.concat_ws("|", F.coalesce(F.col("a").cast("string"), F.lit(".")), F.coalesce(F.col("b").cast("string"), F.lit(".")))
    kind = F.when(F.col("a").isNull() | F.col("b").isNull(), "GAP").when(F.col("a") != F.col("b"), "HET").otherwise("PASS")
    return rows.select("chrom", "pos", "ref", gt.alias("gt"), kind.alias("filter"), (F.coalesce("da", F.lit(0)) + F.coalesce("db", F.lit(0))).alias("ad"))


def merged_inversions(calls: DataFrame, alns: DataFrame, apart: int, flank: int = 1000, least: int = 1, mapq: int = 0) -> DataFrame:
    """(svid, chrom, start, end, gt, n) of inversions (svid, chrom, start, end, gt): neighbours of a chromosome whose ends are near are one call, the first, with
    the haplotypes that any of them has; it stays if reads of both directions lie at both of its ends (see calling.inversion_support)."""
    from helixframe.operators.calling import inversion_support

    bits = F.split("gt", "/")
    bit = lambda i: F.max(bits[i].cast("int")).cast("string")
    first = F.min(F.struct("start", "end", "svid")).alias("f")
    one = consecutive_clusters(calls, ["chrom"], ["start", "end"], apart).groupBy("chrom", "cluster").agg(first, F.concat_ws("/", bit(0), bit(1)).alias("gt"), F.count(F.lit(1)).alias("n"))
    one = one.select("f.svid", "chrom", "f.start", "f.end", "gt", "n")
    ends = one.select("svid", "chrom", F.col("start").alias("pos"), (F.col("end") - F.col("start")).alias("svlen"))
    return one.join(inversion_support(ends, alns, flank, least, mapq).select("svid"), "svid")


def merged_translocations(breakends: DataFrame, apart: int) -> DataFrame:
    """(svid, chrom, pos, chrom2, pos2, bracket, gt, n) of breakends (svid, chrom, pos, chrom2, pos2, bracket, gt): one per cluster, its first; 1/1 if it has several.

    In the order of (chrom, chrom2, bracket, pos, pos2, svid), one joins the cluster of the one before it if neither position is
    more than `apart` past that one's.
    """
    w = W.partitionBy("chrom", "chrom2", "bracket").orderBy("pos", "pos2", "svid")
    near = (F.col("pos") - F.lag("pos").over(w) <= apart) & (F.col("pos2") - F.lag("pos2").over(w) <= apart)
    rows = breakends.withColumn("_new", F.when(near, 0).otherwise(1)).withColumn("_cluster", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    first = F.min(F.struct("pos", "pos2", "svid", "gt")).alias("f")
    out = rows.groupBy("chrom", "chrom2", "bracket", "_cluster").agg(first, F.count(F.lit(1)).alias("n"))
    return out.select("f.svid", "chrom", "f.pos", "chrom2", "f.pos2", "bracket", F.when(F.col("n") > 1, "1/1").otherwise(F.col("f.gt")).alias("gt"), "n")
