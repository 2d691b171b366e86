"""Complete-linkage clustering of partitions of variants, pairing of haplotypes into genotypes, sweeps and folds over a read's variants."""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from helixframe.operators.calling import gap_partitions
from helixframe.operators.sequence import edit_distance, reverse_complement

#: Breakends: keys of more members lie in difficult regions and give no clusters (a rule of the method, fixed value). Calls paired by sequence: larger partitions are compared in chunks.
MOST_MEMBERS = 10
FAR = 1_000_000_000
#: Members of a large partition in a chunk; two chunks are compared at a time.
CHUNK = 32
_COMPLEMENT = str.maketrans("ACGT", "TGCA")


def complete_linkage(distances: np.ndarray, cut: float) -> np.ndarray:
    """Cluster numbers, in the order of first members: the two clusters whose furthest members are nearest are joined while that distance is at most `cut`."""
    n = len(distances)
    d = distances.astype(float).copy()
    np.fill_diagonal(d, np.inf)
    members = {i: [i] for i in range(n)}
    while len(members) > 1:
        i, j = divmod(int(np.argmin(d)), n)
        if d[i, j] > cut:
            break
        i, j = min(i, j), max(i, j)
        d[i] = d[:, i] = np.maximum(d[i], d[j])
        d[i, i] = np.inf
        d[j] = d[:, j] = np.inf
        members[i] += members.pop(j)
    out = np.zeros(n, int)
    for number, i in enumerate(sorted(members, key=lambda i: min(members[i]))):
        out[members[i]] = number
    return out


def linked(rows: DataFrame, keys: list[str], order: list[str], distance: Callable[[pd.DataFrame], np.ndarray], cut: float, most: int = MOST_MEMBERS) -> DataFrame:
    """Rows with `cluster` (from 0 in each key). distance gives the matrix of a key's rows; keys of more than `most` rows give none and never reach a task whole."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") <= most)
    kept = rows.join(counts, keys)

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order).reset_index(drop=True)
        return pdf.assign(cluster=complete_linkage(distance(pdf), cut))

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields], "cluster long"])
    several = kept.where("_n > 1").select(rows.columns).groupBy(*keys).applyInPandas(cluster, schema)
    # A key's only row needs no Python.
    return several.unionByName(kept.where("_n = 1").select(*rows.columns, F.lit(0).cast("long").alias("cluster")))


def haplotype_text(window: Column, offset: Column, svtype: Column, start: Column, end: Column, alt: Column, copies: Column) -> Column:
    """A window of the reference (from `offset`) with the variant put in."""
    part = lambda a, b: F.substring(window, (a - offset + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int"))
    left, middle, right = part(offset, start), part(start, end), F.expr("''")
    right = F.substring(window, (F.when(svtype == "INS", start).otherwise(end) - offset + 1).cast("int"), F.lit(1 << 30))
    put = F.when(svtype == "INS", alt).when(svtype == "INV", reverse_complement(middle)).when(svtype == "DUP", F.repeat(middle, (copies + 1).cast("int"))).otherwise(F.lit(""))
    return F.concat(left, put, right)


def pair_by_sequence(calls: DataFrame, refs: DataFrame, gap: int = 1000, cut: int = 200, flank: int = 100, most: int = MOST_MEMBERS) -> DataFrame:
    """calls (svid, hap 1 or 2, chrom, svtype, start, end, alt, copies) with `part` and `cluster`.

    Calls of a type whose starts are at most `gap` apart form a partition; two of different haplotypes are as far apart as the edit distance of the
    reference (chrom, seq) with either put in, two of one haplotype infinitely far. A partition of at most `most` members is one row, whose
    texts and clusters are arrays; a larger one is compared in chunks of its members and gives the same clusters. No pair of texts is ever a row.
    """
    names = [c for c in calls.columns if c not in ("chrom", "svtype")]
    calls = gap_partitions(calls.withColumn("pos", F.col("start")), ["chrom", "svtype"], gap).drop("pos")
    keys = ["chrom", "svtype", "part"]
    spans = calls.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.greatest(F.min("start") - flank, F.lit(0)).alias("_low"), (F.max("end") + flank).alias("_high"))
    member = F.struct("start", "end", "hap", "svid", *[c for c in names if c not in ("start", "end", "hap", "svid")])
    # A large partition is dealt over several rows.
    dealt = F.when(F.col("_n") > most, F.pmod(F.xxhash64(member), F.ceil(F.col("_n") / CHUNK))).otherwise(0)
    parts = calls.join(spans, keys).groupBy(*keys, dealt.alias("_dealt")).agg(*[F.max(c).alias(c) for c in ("_n", "_low", "_high")], F.array_sort(F.collect_list(member)).alias("_members"))
    refs = refs.select("chrom", "seq")
    parts = parts.drop("_dealt").join(refs, "chrom")
    small = parts.where(F.col("_n") <= most).withColumn("_window", F.upper(F.substring(F.col("seq"), (F.col("_low") + 1).cast("int"), (F.col("_high") - F.col("_low")).cast("int")))).drop("seq", "_high")
    text = lambda m: haplotype_text(F.col("_window"), F.col("_low"), F.col("svtype"), m["start"], m["end"], m["alt"], m["copies"])

    def clusters(texts: pd.Series, haps: pd.Series, svids: pd.Series) -> pd.Series:
        return pd.Series([cluster_of_texts(list(t), list(h), list(s), cut).tolist() for t, h, s in zip(texts, haps, svids, strict=True)], dtype=object)

    found = F.pandas_udf(clusters, "array<bigint>")(F.transform("_members", text), F.transform("_members", lambda m: m["hap"].cast("string")), F.transform("_members", lambda m: m["svid"].cast("string")))
    several = small.where(F.size("_members") > 1).withColumn("_clusters", found)
    # A partition's only call needs no Python.
    single = small.where(F.size("_members") == 1).withColumn("_clusters", F.array(F.lit(0).cast("long")))
    rows = several.unionByName(single).select(*keys, F.explode(F.arrays_zip("_members", "_clusters")).alias("_m"))
    out = rows.select(*[F.col(f"_m._members.{c}").alias(c) for c in names], *keys, F.col("_m._clusters").alias("cluster"))
    large = parts.where(F.col("_n") > most).select(*keys, F.xxhash64("seq").alias("_ref"), F.explode("_members").alias("_m"))
    large = _paired_in_chunks(large, refs, [*keys, "_ref"], cut)
    return out.unionByName(large.select(*[F.col(f"_m.{c}").alias(c) for c in names], *keys, "cluster"))


def _paired_in_chunks(rows: DataFrame, refs: DataFrame, keys: list[str], cut: int) -> DataFrame:
    """Rows (keys, _m) with `cluster`. Two chunks of a partition's members are one row, which gives the pairs at most `cut` apart; these are gone through from near to far."""
    rows = rows.withColumn("_i", (F.row_number().over(W.partitionBy(*keys).orderBy("_m")) - 1).cast("long"))
    m = lambda c: F.col(f"_m.{c}")
    one = F.struct("_i", m("start").alias("start"), m("end").alias("end"), m("alt").alias("alt"), m("copies").alias("copies"), m("hap").cast("string").alias("hap"), m("svid").cast("string").alias("svid"))
    chunks = rows.groupBy(*keys, F.floor(F.col("_i") / CHUNK).alias("_chunk")).agg(F.min(F.least(m("start"), m("end"))).alias("_low"), F.max(F.greatest(m("start"), m("end"))).alias("_high"), F.array_sort(F.collect_list(one)).alias("_a"))
    later = chunks.withColumnsRenamed({"_chunk": "_chunk2", "_low": "_low2", "_high": "_high2", "_a": "_b"})
    both = chunks.join(later, keys).where("_chunk <= _chunk2").withColumn("_low", F.greatest(F.least("_low", "_low2"), F.lit(0))).withColumn("_high", F.greatest("_high", "_high2"))
    both = both.join(refs, "chrom").where(F.xxhash64("seq") == F.col("_ref"))
    window = F.upper(F.substring(F.col("seq"), (F.col("_low") + 1).cast("int"), (F.col("_high") - F.col("_low")).cast("int")))
    both = both.select(*keys, "_low", "_a", "_b", window.alias("_window"))
    of_keys = [rows.schema[k] for k in keys]
    near = StructType([*of_keys, *[StructField(c, LongType()) for c in ("d", "i", "j")], *[StructField(c, StringType()) for c in ("hap", "hap2")]])
    joined = StructType([*of_keys, StructField("_i", LongType()), StructField("_first", LongType())])
    near_arrow, joined_arrow = to_arrow_schema(near), to_arrow_schema(joined)

    def distances(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found = [(*[row[k] for k in keys], *p) for p in _near_pairs(row["_a"], row["_b"], row["svtype"], row["_window"], row["_low"], cut)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), near_arrow, strict=True)], schema=near_arrow)

    def clusters(batches):
        pairs = (p for batch in batches for p in zip(*[c.to_pylist() for c in batch.columns], strict=True))
        for key, mine in itertools.groupby(pairs, key=lambda p: p[: len(keys)]):
            found = linkage_of_pairs(p[len(keys) :] for p in mine)
            columns = [*[[k] * len(found) for k in key], list(found), list(found.values())]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, joined_arrow, strict=True)], schema=joined_arrow)

    pairs = both.mapInArrow(distances, near).repartition(*keys).sortWithinPartitions(*keys, "d", "i", "j")
    rows = rows.join(pairs.mapInArrow(clusters, joined), [*keys, "_i"], "left")
    first = F.coalesce("_first", "_i")
    return rows.withColumn("cluster", (F.dense_rank().over(W.partitionBy(*keys).orderBy(first)) - 1).cast("long"))


def _near_pairs(a: list[dict], b: list[dict], svtype: str, window: str | None, low: int, cut: int):
    """(distance, i, j, hap of i, hap of j) of the members of two chunks, or of one with itself, whose texts are at most `cut` apart."""
    if window is None:
        return

    def put(m: dict, start: int, end: int) -> str:
        s, e = m["start"], m["end"]
        left, middle = window[start - low : s - low], window[s - low : e - low] if svtype in ("INV", "DUP") else ""
        if svtype == "INS":
            return left + m["alt"] + window[s - low : end - low]
        middle = middle[::-1].translate(_COMPLEMENT) if svtype == "INV" else middle * (m["copies"] + 1) if svtype == "DUP" else ""
        return left + middle + window[e - low : end - low]

    need = ["start", "hap", "svid", *({"INS": ["alt"], "DUP": ["end", "copies"]}.get(svtype, ["end"]))]
    whole = lambda ms: [m for m in ms if all(m[c] is not None for c in need)]
    for x, y in itertools.product(whole(a), whole(b)):
        if x["_i"] < y["_i"] and x["hap"] != y["hap"] and x["svid"] != y["svid"]:
            # What lies before and behind both variants is the same in both texts.
            ends = [m[c] for m in (x, y) for c in (("start",) if svtype == "INS" else ("start", "end"))]
            start, end = max(min(ends), low), max(ends)
            if (far := edit_distance(put(x, start, end), put(y, start, end), cut)) >= 0:
                yield far, x["_i"], y["_i"], x["hap"], y["hap"]


def linkage_of_pairs(pairs: Iterable[tuple]) -> dict[int, int]:
    """The first member of each member's cluster, as by complete_linkage, from the pairs (distance, i, j, hap of i, hap of j; i < j) within its cut, in ascending order.

    Two clusters are joined once all pairs across them have come. Members of one haplotype have no pair, so clusters that share one are never counted.
    """
    root, members, haps, seen = {}, {}, {}, {}
    ready: list[tuple[int, int]] = []

    def count(a: int, b: int, n: int) -> None:
        seen.setdefault(a, {})[b] = seen.setdefault(b, {})[a] = n
        if n == len(members[a]) * len(members[b]):
            heapq.heappush(ready, (min(a, b), max(a, b)))

    def join(a: int, b: int) -> None:
        for x in members[b]:
            root[x] = a
        members[a] += members.pop(b)
        haps[a] |= haps.pop(b)
        mine, other = seen.pop(a, {}), seen.pop(b, {})
        for c in (mine.keys() | other.keys()) - {a, b}:
            seen[c].pop(a, None), seen[c].pop(b, None)
            if haps[a].isdisjoint(haps[c]):
                count(a, c, mine.get(c, 0) + other.get(c, 0))
            elif not seen[c]:
                del seen[c]

    for _, level in itertools.groupby(pairs, key=lambda p: p[0]):
        for _, i, j, *of in level:
            for x, hap in zip((i, j), of, strict=True):
                if x not in root:
                    root[x], members[x], haps[x] = x, [x], {hap}
            a, b = root[i], root[j]
            if a == b or not haps[a].isdisjoint(haps[b]):
                continue
            if len(members[a]) == len(members[b]) == 1 and a not in seen and b not in seen:
                # Equally near clusters that come before these would have been counted.
                join(a, b)
            else:
                count(a, b, seen.get(a, {}).get(b, 0) + 1)
        while ready:
            a, b = heapq.heappop(ready)
            if a in members and b in members and seen.get(a, {}).get(b) == len(members[a]) * len(members[b]):
                join(a, b)
    return root


def cluster_of_texts(texts: list[str | None], haps: list, svids: list, cut: int) -> np.ndarray:
    """Cluster numbers of a partition's members; the distance to a null one is infinite."""
    d = np.full((len(texts), len(texts)), float(FAR))
    for i, j in itertools.combinations(range(len(texts)), 2):
        known = None not in (texts[i], texts[j], haps[i], haps[j], svids[i], svids[j])
        if known and haps[i] != haps[j] and svids[i] != svids[j] and (far := edit_distance(texts[i], texts[j], cut)) >= 0:
            d[i, j] = d[j, i] = far
    return complete_linkage(d, cut)


def pair_breakends(breakends: DataFrame, keys: list[str], cut: float = 0.3, most: int = MOST_MEMBERS) -> DataFrame:
    """breakends (keys, svid, hap, pos1, dir1, pos2, dir2) with `cluster`: those of different haplotypes and equal directions are (d1 + d2) / 3000 apart."""

    def distances(pdf: pd.DataFrame) -> np.ndarray:
        p, q = pdf.pos1.to_numpy(float), pdf.pos2.to_numpy(float)
        d = (np.abs(p[:, None] - p) + np.abs(q[:, None] - q)) / 3000
        hap, way = pdf.hap.to_numpy(), (pdf.dir1 + pdf.dir2).to_numpy()
        return np.where((hap[:, None] != hap) & (way[:, None] == way), d, 99999.0)

    return linked(breakends, keys, ["pos1", "pos2", "hap", "svid"], distances, cut, most)


def genotypes(clustered: DataFrame, keys: list[str]) -> DataFrame:
    """One row per cluster: its first start and end, members, and 1/1 where both haplotypes are in it, else 1/0 or 0/1."""
    has = lambda h: F.max((F.col("hap") == h).cast("int"))
    first = F.min(F.struct("hap", "start", "end")).alias("f")
    out = clustered.groupBy(*keys, "cluster").agg(F.count(F.lit(1)).alias("n"), first, F.concat_ws("/", has(1).cast("string"), has(2).cast("string")).alias("gt"))
    return out.select(*keys, "cluster", F.col("f.start").alias("start"), F.col("f.end").alias("end"), "n", "gt")


def swept_inversions(inversions: DataFrame, cut: float = 0.3) -> DataFrame:
    """Inversions (qname, chrom, start, end, complete) from adjacencies (qname, chrom, start, end, side) of a read: overlapping ones are clustered by
    complete linkage on 1 less their smaller relative overlap (1 for the same side); a cluster's inner ends count, and it is complete with two or more.

    An adjacency that starts past all before it begins the next sweep (none is dropped).
    """
    w = W.partitionBy("qname", "chrom").orderBy("start", "end", "side")
    ahead = F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1))
    rows = inversions.withColumn("_new", F.when(F.col("start") < ahead, 0).otherwise(1)).withColumn("sweep", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_new")

    def distances(pdf: pd.DataFrame) -> np.ndarray:
        s, e, side = pdf.start.to_numpy(float), pdf.end.to_numpy(float), pdf.side.str.split("_").str[0].to_numpy()
        shared = np.minimum(e[:, None], e) - np.maximum(s[:, None], s)
        size = e - s
        return np.where((side[:, None] == side) | (shared <= 0), 1.0, 1 - np.minimum(shared / size[:, None], shared / size))

    clustered = linked(rows, ["qname", "chrom", "sweep"], ["start", "end", "side"], distances, cut, 1 << 30)
    return clustered.groupBy("qname", "chrom", "sweep", "cluster").agg(F.max("start").alias("start"), F.min("end").alias("end"), (F.count(F.lit(1)) > 1).alias("complete")).drop("sweep", "cluster")


def tandem_runs(dups: DataFrame, near: int = 20) -> DataFrame:
    """(qname, chrom, start, end, copies, full) of a read's tandem duplications (qname, idx, chrom, start, end, full, forward): neighbours that are like the
    mean of the run before them, in the same direction, are copies of one. A fold over the sorted array of a read."""
    one = F.struct("idx", "chrom", "start", "end", "full", "forward")
    rows = dups.groupBy("qname").agg(F.array_sort(F.collect_list(one)).alias("d"))

    def run(x: Column, starts: Column, ends: Column, n: Column, full: Column) -> Column:
        return F.struct(x["chrom"].alias("chrom"), starts.alias("starts"), ends.alias("ends"), n.alias("n"), full.alias("full"), x["forward"].alias("forward"))

    def step(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        alike = (last["chrom"] == x["chrom"]) & (last["forward"] == x["forward"]) & (F.abs(last["starts"] / last["n"] - x["start"]) < near) & (F.abs(last["ends"] / last["n"] - x["end"]) < near)
        more = run(x, last["starts"] + x["start"], last["ends"] + x["end"], last["n"] + 1, last["full"] | x["full"])
        fresh = run(x, x["start"], x["end"], F.lit(1).cast("long"), x["full"])
        return F.when(F.size(done) == 0, F.array(fresh)).when(alike, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(more))).otherwise(F.concat(done, F.array(fresh)))

    empty = F.from_json(F.lit("[]"), "array<struct<chrom:string,starts:bigint,ends:bigint,n:bigint,full:boolean,forward:boolean>>")
    r = rows.select("qname", F.explode(F.aggregate("d", empty, step)).alias("r"))
    return r.select("qname", "r.chrom", F.floor(F.col("r.starts") / F.col("r.n")).alias("start"), F.floor(F.col("r.ends") / F.col("r.n")).alias("end"), F.col("r.n").alias("copies"), "r.full")
