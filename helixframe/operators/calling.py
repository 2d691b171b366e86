"""Support, coverage, genotype and filter operators on calls and signatures."""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left, bisect_right
from itertools import takewhile

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.operators.intervals import TILE, band_join, depth, depth_at, joined_tiles, overlap_join
from helixframe.operators.sequence import edit_distance, edit_similarity

#: Genotype thresholds on the support ratio by platform, type, size (up to 1000 letters, larger) and called genotype, as in the six
#: parameter files (fixed values). A null one leaves the genotype.
GT_THRESHOLDS = {
    ("CLR", "DEL"): {"t_large_11": 0.55, "t_small_11": 0.59, "t_large_01": 0.65, "t_small_01": 0.75},
    ("CLR", "INS"): {"t_large_11": None, "t_small_11": None, "t_large_01": 0.64, "t_small_01": 0.75},
    ("Hifi", "DEL"): {"t_large_11": 0.6, "t_small_11": 0.69, "t_large_01": 0.71, "t_small_01": 0.91},
    ("Hifi", "INS"): {"t_large_11": None, "t_small_11": 0.59, "t_large_01": 0.63, "t_small_01": 0.79},
    ("ONT", "DEL"): {"t_large_11": 0.61, "t_small_11": 0.61, "t_large_01": 0.68, "t_small_01": 0.79},
    ("ONT", "INS"): {"t_large_11": None, "t_small_11": None, "t_large_01": 0.67, "t_small_01": 0.72},
}


def thresholds_of(platform: str) -> dict[str, dict[str, float | None]]:
    return {svtype: t for (p, svtype), t in GT_THRESHOLDS.items() if p == platform}


def read_thresholds(spark, paths: dict[str, str]) -> dict[str, dict[str, float | None]]:
    """The same from parameter files (name:value lines) by type; they have a handful of lines."""
    from helixframe.sources.formats import read_parameters

    return {svtype: {r.name: r.value for r in read_parameters(spark, path).collect()} for svtype, path in paths.items()}


def _points(sigs: DataFrame) -> DataFrame:
    return sigs.select(F.col("chrom").alias("p_chrom"), F.col("pos").alias("p_pos"), F.col("svlen").alias("p_len"), F.col("svtype").alias("p_type"), F.col("n").alias("p_n"))


def dedup_signatures(sigs: DataFrame) -> DataFrame:
    return sigs.groupBy("chrom", "svtype", "pos", "svlen").agg(F.count(F.lit(1)).alias("n"))


def support(calls: DataFrame, sigs: DataFrame, width: int = 4000) -> DataFrame:
    """Reads that support each call: near it (500, or 2.3 lengths), of its type, of similar length (0.6). Missing is 0."""
    radius = F.greatest(F.lit(500), F.floor(F.col("svlen") * 2.3)).cast("long")
    # Lengths that differ by less than 5 / 3 are in the same class of powers of it or in neighbouring ones: type and class are join keys.
    size_class = lambda c: F.floor(F.log(F.greatest(F.col(c), F.lit(1)).cast("double")) / math.log(5 / 3))
    sized = calls.select("svid", "chrom", "pos", "svlen", "svtype").withColumn("_class", F.explode(F.array(*[size_class("svlen") + i for i in (-1, 0, 1)])))
    points = _points(dedup_signatures(sigs)).withColumn("p_class", size_class("p_len"))
    near = band_join(sized, points, radius, width, keys=(("svtype", "p_type"), ("_class", "p_class")))
    near = near.where(F.least("svlen", "p_len") * 10 >= F.greatest("svlen", "p_len") * 6)
    return calls.join(near.groupBy("svid").agg(F.sum("p_n").alias("n_support")), "svid", "left").withColumn("n_support", F.coalesce("n_support", F.lit(0)))


def spanning_depth(calls: DataFrame, alns: DataFrame) -> DataFrame:
    """Alignments (n_cov, a double) past both sides of each call: of insertions, 100 about the start; of deletions up to 1000, the
    whole deletion; of larger ones, the mean over a probe of 100 that starts 150 before the start and one 150 past the end."""
    probe = lambda at, to: F.struct(at.cast("long").alias("start"), to.cast("long").alias("end"))
    pos, end = F.col("pos"), F.col("pos") + F.col("svlen")
    probes = F.when(F.col("svtype") == "INS", F.array(probe(pos - 100, pos + 100))).when(F.col("svlen") <= 1000, F.array(probe(pos, end))).otherwise(F.array(probe(pos - 150, pos - 50), probe(end + 150, end + 250)))
    spans = calls.select("svid", "chrom", F.size(probes).alias("n_probes"), F.explode(probes).alias("p")).select("svid", "chrom", "n_probes", "p.*")
    reads = alns.select("chrom", F.col("ref_start").alias("b_start"), F.col("ref_end").alias("b_end"))
    hits = overlap_join(spans, reads).where("b_start < start AND b_end > end").groupBy("svid").agg((F.count(F.lit(1)) / F.max("n_probes")).alias("n_cov"))
    return calls.join(hits, "svid", "left").withColumn("n_cov", F.coalesce("n_cov", F.lit(0.0)))


def corrected_genotype(ratio: Column, svtype: Column, svlen: Column, gt: Column, thresholds: dict[str, dict[str, float | None]]) -> Column:
    """1/1 where the ratio passes the threshold of type, size and called genotype, else 0/1; without a threshold, and for other genotypes, gt stays."""
    limit = F.lit(None).cast("double")
    for kind, t in thresholds.items():
        for name, value in t.items():
            _, size, called = name.split("_")
            here = (svtype == kind) & (svlen > 1000 if size == "large" else svlen <= 1000) & (gt == "/".join(called))
            limit = F.when(here, F.lit(value).cast("double")).otherwise(limit)
    return F.when(limit.isNull() | ratio.isNull(), gt).when(ratio > limit, "1/1").otherwise("0/1")


def correct_genotypes(calls: DataFrame, sigs: DataFrame, alns: DataFrame, thresholds: dict[str, dict[str, float | None]] | None = None) -> DataFrame:
    """Calls with n_support, n_cov, n_ratio (1 without cover) and new_gt, by the HiFi thresholds unless others are given."""
    both = support(calls, sigs).join(spanning_depth(calls, alns).select("svid", "n_cov"), "svid")
    both = both.withColumn("n_ratio", F.when(F.col("n_cov") == 0, F.lit(1.0)).otherwise(F.col("n_support") / F.col("n_cov")))
    return both.withColumn("new_gt", corrected_genotype(F.col("n_ratio"), F.col("svtype"), F.col("svlen"), F.col("gt"), thresholds or thresholds_of("Hifi")))


def evaluation(rows: DataFrame, key: str, truth: Column, called: Column) -> DataFrame:
    """(key, tp, fp, fn, precision, recall, f1), each ratio to 6 digits and null without a divisor."""
    n = lambda a, b: F.sum((F.coalesce(called, F.lit(False)) == F.lit(a)).cast("long") * (F.coalesce(truth, F.lit(False)) == F.lit(b)).cast("long"))
    x = rows.groupBy(key).agg(n(True, True).alias("tp"), n(True, False).alias("fp"), n(False, True).alias("fn"))
    div = lambda p, q: F.round(F.try_divide(p.cast("double"), q.cast("double")), 6)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return x.select(key, "tp", "fp", "fn", div(tp, tp + fp).alias("precision"), div(tp, tp + fn).alias("recall"), div(2 * tp, 2 * tp + fp + fn).alias("f1"))


def inversion_support(calls: DataFrame, alns: DataFrame, flank: int = 1000, least: int = 1, mapq: int = 0) -> DataFrame:
    """Calls (svid, n_start, n_end) near both of whose ends at least so many reads align in both directions.

    A read supports the places that are near alignments of it in either direction; each read's such stretches are apart, so that an end has as
    many reads as stretches that cover it. No call meets an alignment, but for calls of an id that occurs several times, whose reads are counted once together.
    """
    ends = F.explode(F.array(F.struct(F.lit(True).alias("first"), F.col("pos").alias("at")), F.struct(F.lit(False).alias("first"), (F.col("pos") + F.col("svlen")).alias("at"))))
    points = calls.withColumn("_n", F.count(F.lit(1)).over(W.partitionBy("svid"))).select("_n", "svid", "chrom", ends.alias("e")).select("_n", "svid", "chrom", "e.*")
    reads = alns.where(F.col("mapq") >= mapq).select("chrom", F.col("ref_start").alias("b_start"), F.col("ref_end").alias("b_end"), "qname", F.col("is_reverse").cast("boolean").alias("is_reverse"))
    # The low half of the depth counts alignments forward, the high half those on the reverse strand.
    reach = reads.where("is_reverse IS NOT NULL").select("chrom", "qname", "is_reverse", (F.col("b_start") - flank + 1).alias("start"), (F.col("b_end") + flank).alias("end")).where("start < end")
    own = depth(reach, weight=F.when(F.col("is_reverse"), F.lit(1 << 32)).otherwise(F.lit(1)).cast("long"), keys=("chrom", "qname"))
    own = own.where((F.col("depth") >= 1 << 32) & (F.col("depth").bitwiseAND(F.lit((1 << 32) - 1)) > 0))
    once = points.where("_n = 1")
    found = once.join(depth_at(once, own).where("depth > 0"), ["chrom", "at"]).select("svid", "first", F.col("depth").alias("n"))
    several = points.where("_n > 1")
    if not several.isEmpty():
        near = several.select("svid", "chrom", "first", (F.col("at") - flank).alias("start"), (F.col("at") + flank).alias("end"))
        both = overlap_join(near, reads).groupBy("svid", "first", "qname").agg(F.min("is_reverse").alias("lo"), F.max("is_reverse").alias("hi")).where("lo < hi")
        found = found.unionByName(both.select("svid", "first", F.lit(1).cast("long").alias("n")))
    side = lambda first: F.sum(F.when(F.col("first") == first, F.col("n")).otherwise(0))
    counts = found.groupBy("svid").agg(side(True).alias("n_start"), side(False).alias("n_end"))
    return counts.where((F.col("n_start") >= least) & (F.col("n_end") >= least))


def read_supported(calls: DataFrame, sigs: DataFrame, shift: int = 500, exempt: int = 250) -> DataFrame:
    """False-positive filter: calls longer than exempt pass; others need a signature of any type at most shift away of half their size or more."""
    small = calls.where(F.col("svlen") <= exempt)
    points = _points(dedup_signatures(sigs))
    near = band_join(small, points, F.lit(shift), 1000).where("least(svlen, p_len) * 2 >= greatest(svlen, p_len)")
    return calls.where(F.col("svlen") > exempt).unionByName(small.join(near.select("svid").distinct(), "svid", "left_semi"))


def insertion_cover(calls: DataFrame, sigs: DataFrame, radius: int = 1000) -> DataFrame:
    points = _points(dedup_signatures(sigs.where("svtype = 'INS'")))
    hits = band_join(calls.where("svtype = 'INS'"), points, F.lit(radius), 4000).groupBy("svid").agg(F.sum(F.col("p_len") * F.col("p_n")).alias("cov"))
    return calls.where("svtype = 'INS'").join(hits, "svid", "left").select("svid", F.coalesce("cov", F.lit(0)).alias("cov"))


def deletion_cover(calls: DataFrame, sigs: DataFrame, flank: int = 100) -> DataFrame:
    """Summed lengths of the signatures that overlap the flanked deletion (closed intervals)."""
    spans = calls.where("svtype = 'DEL'").select("svid", "chrom", (F.col("pos") - flank).alias("start"), (F.col("pos") + F.col("svlen") + flank + 1).alias("end"))
    blocks = sigs.where("svtype = 'DEL'").select("chrom", F.col("pos").alias("b_start"), (F.col("pos") + F.col("svlen") + 1).alias("b_end"), "svlen")
    hits = overlap_join(spans, blocks).groupBy("svid").agg(F.sum("svlen").alias("cov"))
    return spans.join(hits, "svid", "left").select("svid", F.coalesce("cov", F.lit(0)).alias("cov"))


def median_ratio_filter(table: DataFrame, key: str, value: str, low: float, high: float) -> DataFrame:
    """Rows whose value lies within [low, high] times the median of their key's values."""
    medians = table.groupBy(key).agg(F.percentile(value, F.lit(0.5)).alias("median"))
    return table.join(F.broadcast(medians), key).where((F.col(value) >= low * F.col("median")) & (F.col(value) <= high * F.col("median")))


def gap_partitions(df: DataFrame, keys: list[str], gap: int, tile: int = TILE) -> DataFrame:
    """Number (from 1) the stretches of rows of equal keys whose positions are at most gap apart.

    Rows are sorted within tiles only; the tiles' first and last positions tell which stretches go on.
    """
    rows = df.withColumn("_tile", F.floor(F.col("pos") / tile))
    order = W.partitionBy(*keys, "_tile").orderBy("pos")
    new = F.when((F.col("pos") - F.lag("pos").over(order)) <= gap, 0).otherwise(1)
    rows = rows.withColumn("_new", new).withColumn("_local", F.sum("_new").over(order))
    tiles = rows.groupBy(*keys, "_tile").agg(F.min("pos").alias("_first"), F.max("pos").alias("_last"), F.sum("_new").alias("_n"))
    across = W.partitionBy(*keys).orderBy("_tile")
    tiles = tiles.withColumn("_goes_on", F.when(F.col("_first") - F.lag("_last").over(across) <= gap, 1).otherwise(0))
    tiles = tiles.withColumn("_before", F.sum(F.col("_n") - F.col("_goes_on")).over(across.rowsBetween(W.unboundedPreceding, 0)) - F.col("_n"))
    return joined_tiles(rows, tiles.drop("_first", "_last", "_n", "_goes_on"), keys).withColumn("part", F.col("_local") + F.col("_before")).drop("_new", "_local", "_before", "_tile")


def _checkpoints(spark) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        there = spark.conf.get("spark.checkpoint.dir", None)
        if not there and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        import tempfile

        # A local session is one process on one machine.
        spark.sparkContext.setCheckpointDir(there or tempfile.mkdtemp(prefix="helixframe-"))


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node of each component of edges (a, b). Each round is checkpointed.

    A node takes the least of its label, its neighbours' labels and its label's label; the neighbours' least label also goes to
    the node's label, so that whole trees are hooked and rounds grow with the logarithm of a component's diameter.
    Labels only fall, and the loop ends when none does: then all ends of edges agree.
    """
    _checkpoints(edges.sparkSession)
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")).checkpoint()
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        own = labels.join(near, "node").join(jump, "label", "left").select("node", "label", F.least("label", "near", "far").alias("least"), "near")
        offers = F.array(F.struct("node", F.col("label").alias("was"), F.col("least").alias("label")), F.struct(F.col("label").alias("node"), F.lit(None).alias("was"), F.col("near").alias("label")))
        new = own.select(F.explode(offers).alias("o")).select("o.*").groupBy("node").agg(F.min("was").alias("was"), F.min("label").alias("label")).checkpoint()
        labels = new.drop("was")
        if new.where("was <> label").isEmpty():
            return labels


def redundancy_links(calls: DataFrame) -> DataFrame:
    """Links (a, b) of redundant calls (svid, chrom, svtype, pos, svlen, alt): deletions at most 3000 apart, of a size ratio of 0.1,
    that overlap or touch; insertions at most 500 apart, of a size ratio of 0.5 and an edit similarity of alt of 0.5."""
    points = calls.select(F.col("svid").alias("b"), F.col("chrom").alias("p_chrom"), F.col("svtype").alias("p_type"), F.col("pos").alias("p_pos"), F.col("svlen").alias("p_len"), F.col("alt").alias("p_alt"))
    rules = {"DEL": (3000, "least(svlen, p_len) * 10 >= greatest(svlen, p_len) AND least(pos + svlen, p_pos + p_len) >= greatest(pos, p_pos)"), "INS": (500, "least(svlen, p_len) * 2 >= greatest(svlen, p_len)")}
    parts = []
    for svtype, (radius, rule) in rules.items():
        near = band_join(calls.where(F.col("svtype") == svtype), points.where(F.col("p_type") == svtype), F.lit(radius), 4 * radius).where(f"svid < b AND {rule}")
        near = near.where(edit_similarity(F.col("alt"), F.col("p_alt")) >= 0.5) if svtype == "INS" else near
        parts.append(near.select(F.col("svid").alias("a"), "b"))
    return parts[0].unionByName(parts[1])


#: Positions per tile in which redundant calls are linked.
LINK_TILE = 50_000


def _linked_in_tile(deletions: bool, rows: list[tuple]) -> list[tuple]:
    """(svid, root) of the calls (pos, svlen, svid, alt) of a tile and those that reach into it; the root is the least svid of a set, and only sets of several are given.

    A call is tried against earlier ones until it is linked with each set that it can be, not against all of them.
    """
    parent: dict[str, str] = {}

    def find(x: str) -> str:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def union(x: str, y: str) -> str:
        x, y = sorted((find(x), find(y)))
        parent[y] = x
        return x

    rows.sort(key=lambda r: r[:3])
    if deletions:
        # All deletions that go on at a place overlap each other there, so that one linked with any shorter (longer) one is linked with the longest shorter (shortest longer) one, and through it with the others.
        going: list[tuple] = []
        ends: list[tuple] = []
        for pos, svlen, svid, _ in rows:
            parent.setdefault(svid, svid)
            while ends and ends[0][0] < pos:
                gone = heapq.heappop(ends)[1]
                del going[bisect_left(going, gone)]
            k = bisect_right(going, (svlen, svid))
            for j in (k - 1, k):
                if 0 <= j < len(going) and min(svlen, going[j][0]) * 10 >= max(svlen, going[j][0]):
                    union(svid, going[j][1])
            going.insert(k, (svlen, svid))
            heapq.heappush(ends, (pos + min(svlen, 3000), (svlen, svid)))
    else:
        # Members of each set that are near enough, by the set's root.
        sets: dict[str, list[tuple]] = {}
        for row in rows:
            pos, svlen, svid, alt = row
            root = find(parent.setdefault(svid, svid))
            met: list[list[tuple]] = []
            for other in list(sets):
                members = sets[other]
                if members[-1][0] < pos - 500:
                    del sets[other]
                elif other == root:
                    met.append(sets.pop(other))
                else:
                    near = list(takewhile(lambda m: m[0] >= pos - 500, reversed(members)))
                    # Those of equal length need no edit distance.
                    if any(len(m[3]) == len(alt) and _alike(row, m) for m in near) or any(_alike(row, m) for m in near):
                        root = union(svid, other)
                        met.append(sets.pop(other))
            if root in sets:
                met.append(sets.pop(root))
            merged = met[0] if len(met) == 1 else sorted(m for x in met for m in x)
            merged.append(row)
            if merged[len(merged) // 2][0] < pos - 500:
                del merged[: len(merged) // 2]
            sets[root] = merged
    sizes: dict[str, int] = {}
    for svid in parent:
        sizes[find(svid)] = sizes.get(find(svid), 0) + 1
    return [(svid, find(svid)) for svid in parent if sizes[find(svid)] > 1]


def _alike(x: tuple, y: tuple) -> bool:
    """The rule of insertions (pos, svlen, svid, alt) that are near each other."""
    if min(x[1], y[1]) * 2 < max(x[1], y[1]):
        return False
    a, b = x[3], y[3]
    most = (len(a) + len(b)) // 2
    return most > 0 and (len(a) == len(b) or edit_distance(a, b, most) >= 0)


def redundancy_labels(calls: DataFrame) -> DataFrame:
    """(node, label): the least svid of each component of redundancy_links, of which only as many as connect the components are sought.

    Calls are linked within tiles, each with those before it that may reach into it; then the tiles' sets that share a call are components of
    a graph of a few nodes per tile.
    """
    import pyarrow as pa

    rows = calls.select("chrom", "svtype", F.col("pos").cast("long").alias("pos"), F.col("svlen").cast("long").alias("svlen"), F.col("svid").cast("string").alias("svid"), F.when(F.col("svtype") == "INS", F.col("alt")).otherwise("").alias("alt"))
    rows = rows.where("svtype IN ('DEL', 'INS') AND chrom IS NOT NULL AND pos IS NOT NULL AND svlen >= 0 AND svid IS NOT NULL AND alt IS NOT NULL")
    reach = F.when(F.col("svtype") == "DEL", F.least("svlen", F.lit(3000))).otherwise(F.lit(500))
    tile = F.floor(F.col("pos") / LINK_TILE)
    rows = rows.withColumn("_tile", F.explode(F.sequence(tile, F.floor((F.col("pos") + reach) / LINK_TILE))))

    def sets(table: pa.Table) -> pa.Table:
        columns = [table.column(c).to_pylist() for c in ("pos", "svlen", "svid", "alt")]
        found = _linked_in_tile(table.column("svtype")[0].as_py() == "DEL", list(zip(*columns, strict=True)))
        return pa.table({"svid": pa.array([f[0] for f in found], pa.string()), "root": pa.array([f[1] for f in found], pa.string())})

    found = rows.groupBy("chrom", "svtype", "_tile").applyInArrow(sets, "svid string, root string")
    # A call in several tiles is in one set of each; they are one component.
    roots = found.groupBy("svid").agg(F.collect_set("root").alias("roots"))
    _checkpoints(calls.sparkSession)
    roots = roots.checkpoint()
    edges = roots.select(F.array_min("roots").alias("a"), F.explode("roots").alias("b")).distinct()
    labels = components(edges)
    return roots.select(F.col("svid").alias("_svid"), F.array_min("roots").alias("node")).join(labels, "node").select(F.col("_svid").alias("node"), "label")


def collapse_redundant(calls: DataFrame) -> DataFrame:
    """Calls with collapse_id (type and least svid of the component; null without links) and kept: the longest of a component, the
    one of the least svid among equals, and every call without links."""
    labels = redundancy_labels(calls).select(F.col("node").alias("svid"), "label")
    best = calls.join(labels, "svid").groupBy("label").agg(F.min(F.struct((-F.col("svlen")).alias("size"), F.col("svid").alias("best"))).alias("b")).select("label", F.col("b.best").alias("best"))
    out = calls.join(labels.join(best, "label"), "svid", "left")
    return out.withColumn("collapse_id", F.concat("svtype", F.lit(":"), "label")).withColumn("kept", F.coalesce(F.col("best") == F.col("svid"), F.lit(True))).drop("label", "best")
