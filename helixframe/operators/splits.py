"""Split alignments: SA tags, flags, read filters, and the classification of adjacent alignments of a read into variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.operators import cigar

#: Sizes and tolerances of the classifier (fixed values).
MIN_SIZE, MAX_SIZE, TOLERANCE = 40, 100_000, 50


def supplementary_alignments(df: DataFrame, key: str, sa: str = "sa") -> DataFrame:
    """(key, idx, chrom, pos, flag, cigar, mapq, edits): the entries of an SA tag, one row each; entries of other than six fields are
    left out, a mapping quality below 0 counts as 0, and the flag is 2048, or 2064 on the reverse strand."""
    rows = df.select(key, F.posexplode(F.split(sa, ";")).alias("idx", "entry")).withColumn("f", F.split("entry", ",")).where(F.size("f") == 6)
    f = lambda i: F.col("f")[i]
    flag = F.when(f(2) == "-", 2064).otherwise(2048)
    return rows.select(key, "idx", f(0).alias("chrom"), f(1).try_cast("long").alias("pos"), flag.alias("flag"), f(3).alias("cigar"), F.greatest(f(4).try_cast("int"), F.lit(0)).alias("mapq"), f(5).try_cast("int").alias("edits"))


def flag_class(flag: Column) -> Column:
    """1 primary, 2 primary reverse, 3 supplementary, 4 supplementary reverse; 0 for all other flags."""
    codes = F.create_map(*[F.lit(x) for x in (0, 1, 16, 2, 2048, 3, 2064, 4)])
    return F.coalesce(F.try_element_at(codes, flag.cast("int")), F.lit(0))


def filter_alignments(alns: DataFrame, regions: DataFrame, least_mapq: int, least_length: int, hap: str, pad: int = 1000) -> DataFrame:
    """Alignments (chrom, ref_start, ref_end, mapq, hp) of the haplotype, of that quality and length, that overlap a padded region (chrom, start, end)."""
    from helixframe.operators.intervals import merge_blocks, overlap_join

    padded = merge_blocks(regions.select("chrom", F.greatest(F.col("start") - pad, F.lit(0)).alias("start"), (F.col("end") + pad).alias("end")))
    rows = alns.where((F.col("mapq") >= least_mapq) & (F.col("ref_end") - F.col("ref_start") >= least_length) & F.col("hp").contains(hap))
    rows = rows.withColumn("start", F.col("ref_start")).withColumn("end", F.col("ref_end")).withColumn("_row", F.monotonically_increasing_id())
    hits = overlap_join(rows, padded.withColumnRenamed("start", "b_start").withColumnRenamed("end", "b_end"))
    # Merged regions are apart, so an alignment that meets two of them is counted once by its row.
    return hits.dropDuplicates(["_row"]).drop("_row", "start", "end", "b_start", "b_end")


def _sum(kinds, what="len") -> Column:
    return F.sum(F.when(F.col("op").isin(*kinds), F.col(what)).otherwise(0))


def read_bounds(ops: DataFrame, key: str = "aln") -> DataFrame:
    """(key, head_hard, read_len, q_start, q_end): the leading hard clip, the whole read's letters, and where the alignment starts and ends in it."""
    ends = lambda f: f(F.struct("op", "len"), F.col("idx"))
    x = ops.groupBy(key).agg(_sum((cigar.M, cigar.I, cigar.S, cigar.H)).alias("read_len"), ends(F.min_by).alias("first"), ends(F.max_by).alias("last"))
    clip = lambda side, kinds: F.when(F.col(f"{side}.op").isin(*kinds), F.col(f"{side}.len")).otherwise(F.lit(0))
    clips = (cigar.S, cigar.H)
    return x.select(key, clip("first", (cigar.H,)).alias("head_hard"), "read_len", clip("first", clips).alias("q_start"), (F.col("read_len") - clip("last", clips)).alias("q_end"))


def noisy_read_filter(ops: DataFrame, most_inserted: float = 0.13, least_run: float = 200, key: str = "aln") -> DataFrame:
    """(key, ins_share, mean_run) of alignments with few inserted letters, or long matches on average."""
    m, i = _sum((cigar.M,)), _sum((cigar.I,))
    n = F.sum((F.col("op") == cigar.M).cast("long"))
    x = ops.groupBy(key).agg(F.try_divide(i.cast("double"), m + i).alias("ins_share"), F.try_divide(m.cast("double"), n).alias("mean_run"))
    return x.where((F.col("ins_share") <= most_inserted) | (F.col("mean_run") >= least_run))


def assembly_alignment_filter(alns: DataFrame, ops: DataFrame, least_mapq: int = 5, least_block: int = 50_000, key: str = "aln") -> DataFrame:
    """Alignments (key, flag, mapq) that are not secondary, of that quality, whose M, I and D add up to that many letters."""
    blocks = ops.groupBy(key).agg(_sum((cigar.M, cigar.I, cigar.D)).alias("block"))
    return alns.where((F.col("flag").bitwiseAND(256) == 0) & (F.col("mapq") >= least_mapq)).join(blocks.where(F.col("block") >= least_block), key)


def difference_operations(df: DataFrame, key: str, cs: str = "cs") -> DataFrame:
    """(key, idx, op, letters): the operations of a cs tag in order; letters is the length of a match, insertion or deletion and 1 for a substitution."""
    pattern = F.lit(r"(:[0-9]+|\*[a-zA-Z][a-zA-Z]|[=+-][A-Za-z]+)")
    rows = df.select(key, F.posexplode(F.regexp_extract_all(cs, pattern, F.lit(1))).alias("idx", "piece"))
    op, rest = F.substring("piece", 1, 1), F.expr("substring(piece, 2)")
    letters = F.when(op == ":", rest.try_cast("long")).when(op == "*", F.lit(1)).otherwise(F.length(rest))
    return rows.select(key, "idx", op.alias("op"), letters.cast("long").alias("letters"))


def adjacent(segments: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Each row with the columns n_* of the next one of its keys, where there is one."""
    w = W.partitionBy(*keys).orderBy(*order)
    rows = segments.withColumn("_next", F.lead(F.struct(*columns)).over(w)).where("_next is not null")
    return rows.select("*", *[F.col(f"_next.{c}").alias(f"n_{c}") for c in columns]).drop("_next")


def classify_segments(segments: DataFrame, least: int = MIN_SIZE, most: int = MAX_SIZE, slack: int = TOLERANCE) -> DataFrame:
    """Variants between neighbours on a read, of segments (qname, q_start, q_end, chrom, ref_start, ref_end, is_reverse).

    A read leaves a segment at its exit and enters the next one at its entry: the reference ends that face each other in reading direction.
    kind is INS, DEL, DUP (detail: full or partial), INV (detail: which adjacency) or BND (detail: both directions);
    (chrom, start) and (chrom2, end) are its ends. What lies beyond the tolerances is no variant and gives no row.
    """
    columns = ["q_start", "q_end", "chrom", "ref_start", "ref_end", "is_reverse"]
    rows = adjacent(segments, ["qname"], ["q_start", "q_end", "chrom", "ref_start", "ref_end", "is_reverse"], columns)
    rev, n_rev = F.col("is_reverse"), F.col("n_is_reverse")
    exit_, entry = F.when(rev, F.col("ref_start")).otherwise(F.col("ref_end")), F.when(n_rev, F.col("n_ref_end")).otherwise(F.col("n_ref_start"))
    rows = rows.withColumn("exit", exit_).withColumn("entry", entry).withColumn("gap", F.col("n_q_start") - F.col("q_end"))
    # Along the read, the reference goes on by so much between the two.
    rows = rows.withColumn("dist", F.when(rev & n_rev, F.col("exit") - F.col("entry")).otherwise(F.col("entry") - F.col("exit"))).withColumn("dev", F.col("gap") - F.col("dist"))
    gap, dist, dev = F.col("gap"), F.col("dist"), F.col("dev")
    near, close = gap >= -slack, gap <= slack
    one, same = F.col("chrom") == F.col("n_chrom"), rev == n_rev
    apart = one & same & near & (dist >= -slack)
    doubled = one & same & near & close & (dist < -slack) & (dev >= least)
    met = F.when(rev, F.col("n_ref_start") < F.col("ref_end")).otherwise(F.col("n_ref_end") > F.col("ref_start"))
    turned = one & ~same & near & close
    ahead, behind = F.col("n_ref_start") - F.col("ref_end") >= -slack, F.col("ref_start") - F.col("n_ref_end") >= -slack
    size = F.when(ahead, -dev).otherwise(dev)
    low = F.when(ahead, F.col("exit")).otherwise(F.col("entry"))
    side = F.concat(F.when(rev, "right").otherwise("left"), F.when(ahead, F.lit("_fwd")).otherwise(F.lit("_rev")))
    way = lambda r: F.when(r, "rev").otherwise("fwd")
    bnd_start, bnd_end = F.when(rev, F.col("exit")).otherwise(F.col("exit") - 1), F.when(n_rev, F.col("entry") - 1).otherwise(F.col("entry"))
    variant = lambda kind, start, end, detail: F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), detail.alias("detail"))
    none = F.lit("")
    bnd = variant("BND", bnd_start, bnd_end, F.concat_ws("-", way(rev), way(n_rev)))
    left = F.when(rev, F.col("n_ref_end")).otherwise(F.col("ref_end"))
    first = F.when(rev, F.col("ref_start")).otherwise(F.col("n_ref_start"))
    found = (
        F.when(apart & (dev >= least) & (dist <= slack), variant("INS", F.col("exit"), F.col("exit") + dev, none))
        .when(apart & close & dev.between(-most, -least), variant("DEL", left, left - dev, none))
        .when(apart & close & (dev < -most), bnd)
        .when(doubled & met, variant("DUP", first, first + dev, F.lit("full")))
        .when(doubled & (dist >= -most), variant("DUP", first, first + dev, F.lit("partial")))
        .when(doubled, bnd)
        .when(turned & (ahead | behind) & size.between(least, most), variant("INV", low, low + size, side))
        .when(turned & (ahead | behind), bnd)
        .when(~one & near & close, bnd)
    )
    rows = rows.withColumn("v", found).where("v is not null")
    return rows.select("qname", "q_start", "v.kind", "chrom", "v.start", F.when(F.col("v.kind") == "BND", F.col("n_chrom")).otherwise(F.col("chrom")).alias("chrom2"), "v.end", "v.detail")


#: Bounds on the overlap of two aligned parts, by platform: a fixed number of letters, or a share of the size.
CONTIG_RULES = {"Hifi": ("letters", 3000.0), "CLR": ("share", 0.3)}


def contig_split_indels(pairs: DataFrame, platform: str = "Hifi", most: int = 50_000, least: int = 30) -> DataFrame:
    """Insertions and deletions between two alignments of a contig: pairs (qname, ref1_end, ref2_start, read1_end, read2_start).

    The difference of the distances on reference and contig is the size; what both alignments cover twice may not be more than the platform's bound.
    """
    kind, bound = CONTIG_RULES[platform]
    size = (F.col("ref2_start") - F.col("ref1_end")) - (F.col("read2_start") - F.col("read1_end"))
    rows = pairs.withColumn("size", size).where(F.abs("size") <= most)
    twice = F.when(F.col("size") >= least, F.col("read1_end") - F.col("read2_start")).otherwise(F.col("ref1_end") - F.col("ref2_start"))
    rows = rows.withColumn("twice", twice)
    limit = F.lit(bound) if kind == "letters" else F.abs("size") * bound
    deleted = (F.col("size") >= least) & (F.abs("twice") <= limit)
    inserted = (F.col("size") <= -least) & ((F.col("twice") < limit) if kind == "letters" else (F.abs("twice") <= limit))
    half = F.col("twice") / 2
    half = F.when(half < 0, F.ceil(half)).otherwise(F.floor(half)).cast("long")
    middle = F.floor((F.col("ref1_end") + F.col("ref2_start")) / 2).cast("long")
    pos_del = F.col("ref1_end") - half if kind == "letters" else F.col("ref1_end")
    pos = F.when(deleted, pos_del).otherwise(F.when(F.abs("twice") > 400, middle).otherwise(F.col("ref2_start")))
    svlen = F.when(deleted, F.col("size")).otherwise(F.abs(F.col("read2_start") - F.col("read1_end") + F.col("twice")))
    return rows.where(deleted | inserted).select("qname", F.when(deleted, "DEL").otherwise("INS").alias("svtype"), pos.alias("pos"), svlen.alias("svlen"))


def read_split_indels(pairs: DataFrame, most: int = 50_000, least: int = 30) -> DataFrame:
    """As contig_split_indels for reads: both alignments may share fewer than `least` letters of the reference."""
    size = (F.col("ref2_start") - F.col("ref1_end")) - (F.col("read2_start") - F.col("read1_end"))
    rows = pairs.withColumn("size", size).where((F.abs("size") >= least) & (F.abs("size") <= most) & (F.col("ref1_end") - F.col("ref2_start") < least))
    pos = F.when(F.col("size") > 0, F.col("ref1_end")).otherwise(F.floor((F.col("ref1_end") + F.col("ref2_start")) / 2).cast("long"))
    return rows.select("qname", F.when(F.col("size") > 0, "DEL").otherwise("INS").alias("svtype"), pos.alias("pos"), F.abs("size").alias("svlen"))


#: Chain merging within a read: both longer than the first number, starts closer than the second (fixed values).
CHAIN_RULES = {"INS": ((250, 250), (320, 380), (100, 250)), "DEL": ((150, 150),)}


def merge_chains(sigs: DataFrame, svtype: str) -> DataFrame:
    """Merge neighbouring signatures (qname, chrom, pos, svlen, q_start, q_end) of one read, from left to right, each with what has been merged before it.

    A merged insertion is as long as the read part that it spans, a deletion as the reference part; the first position stays. A fold
    over the sorted array of a read's signatures, of which there are few.
    """
    sig = F.struct("pos", "q_start", "q_end", "svlen")
    sigs = sigs.groupBy("qname", "chrom").agg(F.array_sort(F.collect_list(sig)).alias("sigs"))

    def step(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        joins = F.lit(False)
        for length, apart in CHAIN_RULES[svtype]:
            joins = joins | ((last["svlen"] > length) & (s["svlen"] > length) & (F.abs(s["pos"] - last["pos"]) < apart))
        end = s["q_end"] if svtype == "INS" else last["q_start"] + 1
        svlen = s["q_end"] - last["q_start"] if svtype == "INS" else s["pos"] + s["svlen"] - last["pos"]
        merged = F.struct(last["pos"].alias("pos"), last["q_start"].alias("q_start"), end.alias("q_end"), svlen.alias("svlen"))
        return F.when(F.size(done) == 0, F.array(s)).when(joins, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(merged))).otherwise(F.concat(done, F.array(s)))

    empty = F.slice("sigs", 1, 0)
    return sigs.select("qname", "chrom", F.explode(F.aggregate("sigs", empty, step)).alias("s")).select("qname", "chrom", "s.*")


def combine_signatures(sigs: DataFrame, svtype: str, apart: int | None = None) -> DataFrame:
    """(qname, chrom, svtype, pos, svlen, n): neighbouring signatures (qname, chrom, pos, svlen) of a read, whose start is at most `apart`
    (INS 100, DEL 0) past the end of the one before, as one at the first position with all lengths. An insertion ends where it starts."""
    apart = {"INS": 100, "DEL": 0}[svtype] if apart is None else apart
    w = W.partitionBy("qname", "chrom").orderBy("pos", "svlen")
    end = F.lag(F.col("pos") + (F.col("svlen") if svtype == "DEL" else 0)).over(w)
    rows = sigs.withColumn("_new", F.when(F.col("pos") - end <= apart, 0).otherwise(1)).withColumn("_part", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    out = rows.groupBy("qname", "chrom", "_part").agg(F.min("pos").alias("pos"), F.sum("svlen").alias("svlen"), F.count(F.lit(1)).alias("n"))
    return out.select("qname", "chrom", F.lit(svtype).alias("svtype"), "pos", "svlen", "n")


def split_reads(alns: DataFrame) -> DataFrame:
    """(chrom, qname, n): reads with several alignments on a contig."""
    return alns.groupBy("chrom", "qname").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def interspersed_duplications(breakends: DataFrame, least: int = MIN_SIZE, most: int = MAX_SIZE, near: int = 20) -> DataFrame:
    """Pairs of breakends (qname, idx, dir1, dir2, chrom1, pos1, chrom2, pos2) of a read, the later of which comes back to where the earlier left.

    Both go the same way; the stretch between them is the duplicated source (chrom, start, end), inserted at (to_chrom, to_pos).
    """
    b = breakends.select("qname", *[F.col(c).alias(f"b_{c}") for c in ("idx", "dir1", "dir2", "chrom1", "pos1", "chrom2", "pos2")])
    rows = b.join(breakends, "qname").where("b_idx < idx AND b_dir1 = dir2 AND b_dir2 = dir1 AND b_dir1 = b_dir2 AND b_chrom1 = chrom2 AND b_chrom2 = chrom1")
    rows = rows.where(F.abs(F.col("b_pos1") - F.col("pos2")) < near)
    fwd = F.col("dir1") == "fwd"
    start, end = F.when(fwd, F.col("b_pos2")).otherwise(F.col("pos1")), F.when(fwd, F.col("pos1") + 1).otherwise(F.col("b_pos2") + 1)
    to = F.floor(F.when(fwd, F.col("b_pos1") + 1 + F.col("pos2")).otherwise(F.col("b_pos1") + F.col("pos2") + 1) / 2).cast("long")
    out = rows.select("qname", F.col("chrom1").alias("chrom"), start.alias("start"), end.alias("end"), F.col("b_chrom1").alias("to_chrom"), to.alias("to_pos"))
    return out.where((F.col("end") - F.col("start")).between(least, most))


def read_split_variants(segments: DataFrame, least: int = 30, most: int | None = 50_000, slack: int = 100) -> DataFrame:
    """Variants (qname, kind, chrom, pos, svlen, chrom2, pos2) of split reads, from windows of up to three segments (qname, q_start, q_end, chrom, ref_start, ref_end, is_reverse).

    Neighbours on one chromosome and strand give INS or DEL by the difference of their distances on read and reference. In a read of three or
    more segments this takes a window of three on that chromosome and strand: the pair that comes first on the reference counts if the third segment
    begins past it, the window's other pair counts in the read's last window. Neighbours on two chromosomes give a translocation; kind is A (N[c:p[), B (N]c:p]), C ([c:p[N) or
    D (]c:p]N), seen from the chromosome that sorts first. If a read of three or more segments has one, its first and last segment may give an INS.
    The read's last two segments give a translocation only where the two before them lie on two chromosomes as well.
    The length of an insertion or deletion is at most `most` (None: any).
    """
    w = W.partitionBy("qname").orderBy("q_start", "q_end", "chrom", "ref_start", "ref_end", "is_reverse")
    one = F.struct("q_start", "q_end", "chrom", "ref_start", "ref_end", "is_reverse")
    rows = segments.select("qname", one.alias("a"), F.lead(one).over(w).alias("b"), F.lead(one, 2).over(w).alias("c"), F.row_number().over(w).alias("i"), F.count(F.lit(1)).over(W.partitionBy("qname")).alias("n"))
    rows = rows.where("b is not null")
    a, b, c, i, n = (F.col(x) for x in "abcin")
    empty = F.array().cast("array<struct<kind:string,chrom:string,pos:double,svlen:bigint,chrom2:string,pos2:bigint>>")

    def found(kind, chrom, pos, svlen, chrom2=None, pos2=None) -> Column:
        null = F.lit(None)
        return F.struct(kind.alias("kind"), chrom.alias("chrom"), pos.cast("double").alias("pos"), (null if svlen is None else svlen).cast("long").alias("svlen"), (null if chrom2 is None else chrom2).cast("string").alias("chrom2"), (null if pos2 is None else pos2).cast("long").alias("pos2"))

    def allowed(size: Column) -> Column:
        return (size >= least) if most is None else size.between(least, most)

    def indel(x: Column, y: Column) -> Column:
        """Of neighbours x, y along the read, on one strand."""
        rev = x["is_reverse"]
        left_end, right_start = F.when(rev, y["ref_end"]).otherwise(x["ref_end"]), F.when(rev, x["ref_start"]).otherwise(y["ref_start"])
        apart, gap = right_start - left_end, y["q_start"] - x["q_end"]
        near = -apart < least
        ins = F.when(near & (apart <= slack) & allowed(gap - apart), F.array(found(F.lit("INS"), x["chrom"], (right_start + left_end) / 2, gap - apart))).otherwise(empty)
        return F.when(near & (gap <= slack) & allowed(apart - gap), F.array(found(F.lit("DEL"), x["chrom"], left_end, apart - gap))).otherwise(ins)

    def translocation(x: Column, y: Column) -> Column:
        """Of neighbours x, y along the read: its last letter of x and first of y are joined."""
        out, into = F.when(x["is_reverse"], x["ref_start"]).otherwise(x["ref_end"]), F.when(y["is_reverse"], y["ref_end"]).otherwise(y["ref_start"])
        first = x["chrom"] < y["chrom"]
        same = x["is_reverse"] == y["is_reverse"]
        kind = F.when(same, F.when(first != x["is_reverse"], "A").otherwise("D")).otherwise(F.when(x["is_reverse"], "C").otherwise("B"))
        pick = lambda p, q: F.when(first, p).otherwise(q)
        row = found(kind, pick(x["chrom"], y["chrom"]), pick(out, into), None, pick(y["chrom"], x["chrom"]), pick(into, out))
        return F.when(y["q_start"] - x["q_end"] <= slack, F.array(row)).otherwise(empty)

    one_chrom, last = a["chrom"] == b["chrom"], i == n - 2
    alike = one_chrom & (b["chrom"] == c["chrom"]) & (a["is_reverse"] == b["is_reverse"]) & (b["is_reverse"] == c["is_reverse"])
    beyond = F.when(a["is_reverse"], a["ref_start"]).otherwise(c["ref_start"]) >= b["ref_end"]
    leading = F.when(beyond, F.when(a["is_reverse"], indel(b, c)).otherwise(indel(a, b))).otherwise(empty)
    other = F.when(last, F.when(a["is_reverse"], indel(a, b)).otherwise(indel(b, c))).otherwise(empty)
    of_two = F.when(~one_chrom, translocation(a, b)).when(a["is_reverse"] == b["is_reverse"], indel(a, b)).otherwise(empty)
    of_three = F.when(~one_chrom, F.concat(translocation(a, b), F.when(last & (b["chrom"] != c["chrom"]), translocation(b, c)).otherwise(empty))).when(alike, F.concat(leading, other)).otherwise(empty)
    pieces = rows.select("qname", F.explode(F.when(n == 2, of_two).when(c.isNotNull(), of_three).otherwise(empty)).alias("v")).select("qname", "v.*")
    # Segments of another chromosome between the first and the last one may be an insertion.
    moved = rows.where("n >= 3").groupBy("qname").agg(F.min(F.struct("i", "a")).alias("f"), F.max(F.struct("i", "b")).alias("l"), F.bool_or((i <= n - 2) & ~one_chrom).alias("moved")).where("moved")
    x, y = F.col("f.a"), F.col("l.b")
    rev = x["is_reverse"]
    left_end, right_start = F.when(rev, y["ref_end"]).otherwise(x["ref_end"]), F.when(rev, x["ref_start"]).otherwise(y["ref_start"])
    apart, gap = right_start - left_end, y["q_start"] - x["q_end"]
    around = moved.where((x["chrom"] == y["chrom"]) & (rev == y["is_reverse"]) & (apart < slack) & allowed(gap - apart))
    return pieces.unionByName(around.select("qname", found(F.lit("INS"), x["chrom"], F.least(left_end, right_start), gap - apart).alias("v")).select("qname", "v.*"))
