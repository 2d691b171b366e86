"""k-mer evidence: support of calls by reads, assignment of reads to haplotypes, trio binning, sketches and k-mer spectra."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def bad_kmer_ratio(call_kmers: DataFrame, read_counts: DataFrame, least_support: int, trim: int = 7, trim_from: int = 40) -> DataFrame:
    """(svid, n, ratio): the share of a call's k-mers (svid, idx, kmer) that reads (kmer, cnt) support at most so often; of calls of many
    k-mers the outermost ones are left out."""
    rows = call_kmers.join(read_counts, "kmer", "left").withColumn("cnt", F.coalesce("cnt", F.lit(0)))
    w = W.partitionBy("svid")
    rows = rows.withColumn("_n", F.count(F.lit(1)).over(w)).withColumn("_at", F.row_number().over(w.orderBy("idx")))
    rows = rows.where((F.col("_n") < trim_from) | ((F.col("_at") > trim) & (F.col("_at") <= F.col("_n") - trim)))
    return rows.groupBy("svid").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col("cnt") <= least_support).cast("double")), 6).alias("ratio"))


def normalised(scores: list[str]) -> list[Column]:
    """The scores over their Euclidean length; rows of zeros stay."""
    length = F.sqrt(sum((F.col(s).cast("double") * F.col(s) for s in scores), F.lit(0.0)))
    return [F.when(length == 0, F.lit(0.0)).otherwise(F.col(s) / length).alias(s) for s in scores]


def global_cutoff(rows: DataFrame, scores: list[str], alpha: float, steps: int = 1 << 16) -> DataFrame:
    """One row (cutoff): the interpolated 1 - alpha quantile of all scores (0 to 1) of all rows.

    Two passes over a histogram, so that no task holds all values: the buckets that hold the two order statistics are found first, and
    only their distinct values are gathered, with their counts.
    """
    values = rows.select(F.explode(F.array(*[F.col(s).cast("double") for s in scores])).alias("x")).where("x is not null")
    bucket = F.floor(F.col("x") * steps)
    counts = values.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    w = W.orderBy("b")
    total = counts.agg(F.sum("n").alias("total"))
    # At most steps + 1 rows in one task.
    table = counts.withColumn("upto", F.sum("n").over(w)).join(F.broadcast(total))
    place = (F.col("total") - 1) * F.lit(1 - alpha)
    low, high = F.floor(place), F.ceil(place)
    hold = table.where(((F.col("upto") > low) & (F.col("upto") - F.col("n") <= low)) | ((F.col("upto") > high) & (F.col("upto") - F.col("n") <= high)))
    hold = hold.select(F.col("b").alias("_b"), (F.col("upto") - F.col("n")).alias("before"), place.alias("place"), low.alias("low"), high.alias("high"))
    inside = values.groupBy("x").agg(F.count(F.lit(1)).alias("n")).withColumn("_b", F.floor(F.col("x") * steps)).join(F.broadcast(hold), "_b")
    inside = inside.withColumn("upto", F.col("before") + F.sum("n").over(W.partitionBy("_b").orderBy("x")))
    at = lambda i: F.min(F.when((F.col("upto") > F.col(i)), F.col("x")))
    return inside.agg(at("low").alias("lo"), at("high").alias("hi"), F.first("place").alias("place"), F.first("low").alias("low")).select((F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("place") - F.col("low"))).alias("cutoff"))


def assign_haplotypes(rows: DataFrame, key: str, scores: list[str], alpha: float) -> DataFrame:
    """(key, place from 0): reads go to the haplotype of the largest normalised score, where that reaches the cutoff over all reads,
    else to both haplotypes of its block; places 0 and 1 are those of the first block, 2 and 3 of the second. Of equal scores the first counts."""
    unit = rows.select(key, *normalised(scores))
    unit = unit.join(F.broadcast(global_cutoff(unit, scores, alpha)))
    array = F.array(*[F.col(s) for s in scores])
    best = (F.array_position(array, F.array_max(array)) - 1).cast("int")
    both = F.when(best < 2, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(2), F.lit(3)))
    return unit.select(key, F.explode(F.when(F.array_max(array) >= F.col("cutoff"), F.array(best)).otherwise(both)).alias("place"))


def trio_bins(scores: DataFrame, least: int, ratio: float) -> DataFrame:
    """(read, bin) of reads (read, father, mother: numbers of k-mers that only that parent has): p or m where one has at least `least` and
    `ratio` times the other's, a (ambiguous) where both have that many, 0 where neither."""
    f, m = F.col("father"), F.col("mother")
    return scores.select("read", F.when((f < least) & (m < least), "0").when((f >= least) & (f >= ratio * m), "p").when((m >= least) & (m >= ratio * f), "m").otherwise("a").alias("bin"))


def haplotype_markers(kmers: DataFrame, child: str, parent: str, other: str) -> DataFrame:
    """(kmer, cnt): the child's k-mers (owner, kmer, cnt) that one parent has and the other has not; counted once per owner before they meet."""
    has = lambda who: F.max((F.col("owner") == who).cast("int"))
    rows = kmers.where(F.col("owner").isin(child, parent, other)).groupBy("kmer").agg(has(child).alias("c"), has(parent).alias("p"), has(other).alias("o"), F.sum(F.when(F.col("owner") == child, F.col("cnt"))).alias("cnt"))
    return rows.where("c = 1 and p = 1 and o = 0").select("kmer", "cnt")


def consensus_quality(assembly_kmers: DataFrame, read_kmers: DataFrame, k: int) -> DataFrame:
    """One row (n, missing, qv): distinct assembly k-mers, those that no read has, and the Phred quality of a letter that they imply (null if none is missing)."""
    marked = assembly_kmers.select("kmer").distinct().join(read_kmers.select("kmer").distinct().withColumn("_seen", F.lit(1)), "kmer", "left")
    x = marked.agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("_seen").isNull(), 1).otherwise(0)).alias("missing"))
    wrong = 1 - F.pow(1 - F.col("missing") / F.col("n"), F.lit(1.0 / k))
    return x.select("n", "missing", F.when(F.col("missing") > 0, F.round(-10 * F.log10(wrong), 6)).alias("qv"))


def sketches(kmers: DataFrame, key: str, size: int, hashed: Column) -> DataFrame:
    """(key, sketch): the `size` smallest hash values of each key's distinct k-mers, in order. Ranks within a key come from one sort, without an array of all."""
    rows = kmers.select(key, hashed.alias("h")).distinct()
    rows = rows.withColumn("_rank", F.row_number().over(W.partitionBy(key).orderBy("h"))).where(F.col("_rank") <= size)
    return rows.groupBy(key).agg(F.array_sort(F.collect_list("h")).alias("sketch"))


def sketch_similarity(a: Column, b: Column, size: int) -> Column:
    """Jaccard similarity by the `size` smallest values of both sketches together."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, size)
    return F.size(F.array_intersect(F.array_intersect(union, a), b)) / F.size(union)


def pair_scores(reads: DataFrame, read_kmers: DataFrame, hap_kmers: DataFrame) -> DataFrame:
    """(read, a, b, c, e): scores of reads (read, block1, block2) for the four haplotypes of their two blocks.

    A k-mer of a read (read, kmer, cnt) counts for a haplotype (block, hp 1 or 2, kmer, cnt) if it has it alone among the four; then both counts are added.
    """
    places = reads.select("read", F.posexplode(F.array("block1", "block2")).alias("side", "block"))
    rows = places.join(read_kmers.withColumnRenamed("cnt", "_r"), "read").join(hap_kmers.withColumnRenamed("cnt", "_h"), ["block", "kmer"])
    alone = rows.groupBy("read", "kmer").agg(F.count(F.lit(1)).alias("_n"), F.first(F.col("side") * 2 + F.col("hp") - 1).alias("place"), F.first(F.col("_r") + F.col("_h")).alias("s")).where("_n = 1")
    at = lambda i: F.coalesce(F.sum(F.when(F.col("place") == i, F.col("s"))), F.lit(0)).cast("double")
    scored = alone.groupBy("read").agg(*[at(i).alias(n) for i, n in enumerate("abce")])
    return reads.select("read").join(scored, "read", "left").na.fill(0.0, list("abce"))
