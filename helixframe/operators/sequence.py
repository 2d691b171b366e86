"""Sequence and k-mer operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def reverse_complement(seq: Column) -> Column:
    return F.translate(F.reverse(F.upper(seq)), "ACGT", "TGCA")


#: Letters of the pieces that kmers() cuts a sequence into; a window is sought from its piece's start.
PIECE = 256


def kmers(seq: Column, k: int, include_last: bool = True) -> Column:
    """All windows of k letters, in order; the read-hashing variant leaves out the last one.

    The sequence is cut into overlapping pieces first, so that the work does not grow with the square of its length.
    """
    last = F.length(seq) - k + (1 if include_last else 0)
    starts = F.sequence(F.lit(1), F.greatest(last, F.lit(1)), F.lit(PIECE))
    pieces = F.transform(starts, lambda i: F.substring(seq, i, F.least(F.lit(PIECE), last - i + 1) + (k - 1)))
    windows = F.flatten(F.transform(pieces, lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - (k - 1)), lambda i: F.substring(p, i, F.lit(k)))))
    return F.when(last >= 1, windows).otherwise(F.array().cast("array<string>"))


def pack(kmer: Column) -> Column:
    """Two bits a letter, A 0 to T 3; k of up to 31."""
    return F.conv(F.translate(F.upper(kmer), "ACGT", "0123"), 4, 10).cast("long")


def size_similarity(a: Column, b: Column) -> Column:
    return F.try_divide(F.least(F.abs(a), F.abs(b)).cast("double"), F.greatest(F.abs(a), F.abs(b)).cast("double"))


def edit_similarity(a: Column, b: Column) -> Column:
    total = F.length(a) + F.length(b)
    return F.try_divide((total - F.levenshtein(a, b)).cast("double"), total.cast("double"))


def edit_distance(a: str, b: str, most: int) -> int:
    """The Levenshtein distance of two texts, -1 if it is more than `most`; a column of the matrix is one number's bits (Myers, Hyyrö)."""
    if abs(len(a) - len(b)) > most:
        return -1

    def shared(x: str, y: str) -> int:
        low, high = 0, min(len(x), len(y))
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if x[low:mid] == y[low:mid] else (low, mid - 1)
        return low

    n = shared(a, b)
    a, b = a[n:], b[n:]
    n = shared(a[::-1], b[::-1])
    text, pattern = sorted((a[: len(a) - n], b[: len(b) - n]), key=len)
    if not text:
        return len(pattern) if len(pattern) <= most else -1
    m, turned = len(pattern), pattern[::-1]
    mask, last = (1 << m) - 1, 1 << (m - 1)
    kinds = set(pattern)
    at = {c: int(turned.translate({ord(x): "1" if x == c else "0" for x in kinds}), 2) for c in kinds}
    up, down, score = mask, 0, m
    for left, c in zip(range(len(text) - 1, -1, -1), text, strict=True):
        x = at.get(c, 0) | down
        same = (((x & up) + up) ^ up | x) & mask
        more, less = down | mask ^ (same | up), same & up
        score += 1 if more & last else -1 if less & last else 0
        if score - left > most:
            return -1
        more = more << 1 | 1
        up = (less << 1 | ~(same | more)) & mask
        down = more & same & mask
    return score


#: Windows that a task counts at once; a longer sequence is cut into overlapping pieces.
WINDOWS = 1 << 20


def _window_counts(texts: list[str], k: int, include_last: bool):
    """Distinct windows of k letters of some texts and how often each occurs, in batches."""
    import numpy as np
    import pyarrow as pa

    def as_texts(found: np.ndarray) -> pa.Array:
        if found.dtype.kind == "U":
            return pa.array(found.tolist(), pa.string())
        offsets = np.arange(len(found) + 1, dtype=np.int32) * k
        return pa.StringArray.from_buffers(len(found), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(found)))

    def counted(pieces: list[str]):
        whole = "".join(pieces)
        ascii_only = whole.isascii()
        letters = np.frombuffer(whole.encode("ascii"), "S1") if ascii_only else np.frombuffer(whole.encode("utf-32-le"), "<U1")
        if len(letters) < k:
            return None
        ends = np.cumsum([len(p) for p in pieces])
        starts = np.ones(len(letters) - k + 1, bool)
        for i in range(1, k):
            cut = ends[:-1] - i
            starts[cut[(cut >= 0) & (cut < len(starts))]] = False
        windows = np.lib.stride_tricks.sliding_window_view(letters, k)[starts]
        joined = np.ascontiguousarray(windows).view(f"S{k}" if ascii_only else f"<U{k}").ravel()
        if ascii_only and k <= 21:
            # Letters of up to eight kinds fit three bits each: sorting numbers is faster than sorting texts.
            kinds, code = np.unique(letters, return_inverse=True)
            if len(kinds) <= 8:
                code = code.astype(np.int64)
                packed = np.zeros(len(starts), np.int64)
                for i in range(k):
                    packed = packed << 3 | code[i : i + len(starts)]
                _, first, times = np.unique(packed[starts], return_index=True, return_counts=True)
                return as_texts(joined[first]), times
        found, times = np.unique(joined, return_counts=True)
        return as_texts(found), times

    held: list[str] = []
    size = 0
    for text in texts:
        text = text if include_last else text[:-1]
        for at in range(0, max(len(text) - k + 1, 0), WINDOWS):
            piece = text[at : at + WINDOWS + k - 1]
            held.append(piece)
            size += len(piece)
            if size >= WINDOWS:
                yield counted(held)
                held, size = [], 0
    if held:
        yield counted(held)


def count_kmers(reads: DataFrame, k: int, *groups: str, include_last: bool = True) -> DataFrame:
    """(groups, kmer, cnt) of the windows of k letters of seq; null and short sequences have none.

    Windows are counted in each task by sorting them as numbers, so that only distinct ones with their counts are shuffled and no array of
    all windows of a sequence ever stands in a row.
    """
    import pyarrow as pa

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in reads.select(*groups).schema.fields], "kmer string, cnt long"])

    def rows(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            of: dict[tuple, list[str]] = {}
            values = [table.column(g).to_pylist() for g in groups]
            for i, text in enumerate(table.column("seq").to_pylist()):
                if text is not None:
                    of.setdefault(tuple(v[i] for v in values), []).append(text)
            for key, texts in of.items():
                for got in _window_counts(texts, k, include_last):
                    if got is not None:
                        n = len(got[1])
                        columns = [pa.repeat(pa.scalar(v, table.schema.field(g).type), n) for g, v in zip(groups, key, strict=True)]
                        yield pa.RecordBatch.from_arrays([*columns, got[0], pa.array(got[1], pa.int64())], [*groups, "kmer", "cnt"])

    counts = reads.select(*groups, "seq").mapInArrow(rows, schema)
    return counts.groupBy(*groups, "kmer").agg(F.sum("cnt").alias("cnt"))


def unique_kmers(counts: DataFrame, group: str) -> DataFrame:
    """K-mers that stand in one group only."""
    kept = counts.groupBy("kmer").agg(F.count(F.lit(1)).alias("n"), F.first(group).alias(group), F.first("cnt").alias("cnt")).where("n = 1")
    return kept.select(group, "kmer", "cnt")


def minimizers(reads: DataFrame, k: int, w: int) -> DataFrame:
    """(doc_id, pos, kmer): the least k-mer of each window of w consecutive ones (first on ties)."""
    rows = reads.select("doc_id", F.posexplode(kmers(F.col("seq"), k)).alias("pos", "kmer"))
    window = W.partitionBy("doc_id").orderBy("pos").rowsBetween(0, w - 1)
    full = rows.withColumn("m", F.min(F.struct("kmer", "pos")).over(window)).withColumn("n", F.count(F.lit(1)).over(window)).where(F.col("n") == w)
    return full.select("doc_id", F.col("m.pos").cast("long").alias("pos"), F.col("m.kmer").alias("kmer")).distinct()


def parted_reads(reads: DataFrame, k: int, seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """The reads of k letters or more without an N, and the others, null ones among them."""
    good = F.coalesce((F.length(seq) >= k) & ~F.col(seq).contains("N"), F.lit(False))
    return reads.where(good), reads.where(~good)


def assembly_statistics(sequences: DataFrame, length: str) -> DataFrame:
    """(name, length, n): N10 to N90 with the number of sequences, from the longest on, that reach that share of all letters; min, max, mean (whole) and total, with the number of all.

    Lengths are counted first; the running sum is over distinct lengths.
    """
    counts = sequences.where(F.col(length).isNotNull()).groupBy(F.col(length).cast("long").alias("len")).agg(F.count(F.lit(1)).alias("n"))
    down = W.partitionBy(F.lit(1)).orderBy(F.desc("len"))
    whole = W.partitionBy(F.lit(1))
    rows = counts.withColumn("sum", F.sum(F.col("len") * F.col("n")).over(down)).withColumn("rank", F.sum("n").over(down)).withColumn("total", F.sum(F.col("len") * F.col("n")).over(whole))
    # Within a length, the rank is the first at which the sum gets there.
    before, before_n = F.col("sum") - F.col("len") * F.col("n"), F.col("rank") - F.col("n")
    shares = rows.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(9)))).where((F.col("sum") * 10 >= F.col("total") * F.col("k")) & (before * 10 < F.col("total") * F.col("k")))
    more = F.ceil((F.col("total") * F.col("k") - before * 10) / (F.col("len") * 10)).cast("long")
    nx = shares.select(F.concat(F.lit("N"), F.col("k") * 10).alias("name"), F.col("len").alias("length"), (before_n + more).alias("n"))
    t = counts.agg(F.min("len").alias("min"), F.max("len").alias("max"), F.floor(F.sum(F.col("len") * F.col("n")) / F.sum("n")).alias("mean"), F.sum(F.col("len") * F.col("n")).alias("total"), F.sum("n").alias("n")).where("n is not null")
    return nx.unionByName(t.unpivot("n", ["min", "max", "mean", "total"], "name", "length").select("name", "length", "n"))
