"""Scores of reads by k-mers that stand in one group of reads only, without a row for each read and k-mer.

K-mers of a, c, g and t are numbers of two bits a letter. Tasks count them, and pass on sorted blocks of their differences; the k-mers
of one group, with their counts, are written as such blocks to the folder that driver and executors share. Reads, dealt by their id,
are then scored against them. Windows with any other letter are few in reads; they are counted and joined as texts.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.operators import sequence

#: Windows that a task holds at once, and distinct k-mers that it counts before it passes them on.
WINDOWS = 1 << 21
HELD = 1 << 22
#: Bits of a k-mer's number by which blocks are dealt.
BLOCK_BITS = 8
#: K-mers of up to so many bits are looked up by their place in an array of all.
DENSE_BITS = 24
OTHER = "[^acgt]"

_CODES = np.full(256, 4, np.uint8)
_CODES[[ord(c) for c in "acgt"]] = range(4)


def windows(pieces: list[str], k: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """The numbers of all windows of k letters a, c, g, t, the piece of each, and whether there are windows with other letters."""
    whole, sizes = "".join(pieces), np.array([len(p) for p in pieces], np.int64)
    if whole.isascii():
        letters = _CODES[np.frombuffer(whole.encode("ascii"), np.uint8)]
    else:
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), "<u4")
        letters = np.where(points < 256, _CODES[np.minimum(points, 255)], 4).astype(np.uint8)
    n = len(letters) - k + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), False
    piece = np.repeat(np.arange(len(pieces)), sizes)
    inside = piece[:n] == piece[k - 1 :]
    known = inside
    if (letters == 4).any():
        bad = np.concatenate([[0], np.cumsum(letters == 4)])
        known = inside & (bad[k:] == bad[:n])
    number = np.uint32 if k <= 16 else np.uint64
    codes = np.zeros(n, number)
    for i in range(k):
        codes <<= number(2)
        codes |= letters[i : i + n] & 3
    return codes[known].astype(np.uint64), piece[:n][known], bool((inside & ~known).any())


def smallest(values: np.ndarray) -> bytes:
    """Whole numbers from 0 in as few bytes each as hold the largest; the first byte says how many."""
    most = int(values.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w))
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def as_numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.uint64)


def as_block(codes: np.ndarray) -> bytes:
    """Sorted numbers as differences; the first one is in eight bytes before them."""
    return codes[:1].astype("<u8").tobytes() + smallest(np.diff(codes))


def of_block(raw: bytes) -> np.ndarray:
    return np.cumsum(np.concatenate([np.frombuffer(raw, "<u8", 1), as_numbers(raw[8:])]), dtype=np.uint64)


def summed(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers, sorted, and the sums of their counts."""
    every, times = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every = every[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    return every[first], np.add.reduceat(times[order], first)


def cut(text: str, k: int) -> Iterator[str]:
    """Pieces of a text that together have its windows, each once."""
    for at in range(0, max(len(text) - k + 1, 0), WINDOWS):
        yield text[at : at + WINDOWS + k - 1]


BLOCKS = "block int, codes binary, counts binary"


def _blocks(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Blocks of the counted k-mers of each group (block -1: there are windows with other letters)."""
    held: dict = {}
    pending: dict = {}
    waiting, odd, kind = 0, False, None
    shift = np.uint64(max(0, 2 * k - BLOCK_BITS))

    def count() -> None:
        nonlocal odd
        for group, pieces in pending.items():
            codes, _, more = windows(pieces, k)
            odd = odd or more
            if len(codes):
                new = np.unique(codes, return_counts=True)
                old = held.get(group)
                held[group] = new if old is None else summed([old[0], new[0]], [old[1], new[1]])
        pending.clear()

    def passed_on() -> Iterator[pa.RecordBatch]:
        for group, (codes, counts) in held.items():
            block = (codes >> shift).astype(np.int64)
            first = np.flatnonzero(np.diff(block, prepend=-1))
            ends = np.append(first[1:], len(codes))
            parts = [(int(block[a]), as_block(codes[a:b]), smallest(counts[a:b])) for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
            names = pa.array([group] * len(parts), kind)
            yield pa.RecordBatch.from_arrays([names, *[pa.array(v, t) for v, t in zip(zip(*parts, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)]], ["grp", "block", "codes", "counts"])
        held.clear()

    for batch in batches:
        kind = batch.column(0).type
        for group, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for piece in cut(text or "", k):
                pending.setdefault(group, []).append(piece)
                waiting += len(piece)
                if waiting >= WINDOWS:
                    count()
                    waiting = 0
                    if sum(len(x[0]) for x in held.values()) >= HELD:
                        yield from passed_on()
    count()
    yield from passed_on()
    if odd:
        yield pa.RecordBatch.from_arrays([pa.array([None], kind), pa.array([-1], pa.int32()), pa.array([b""], pa.binary()), pa.array([b""], pa.binary())], ["grp", "block", "codes", "counts"])


def _of_one_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block: its k-mers of one group. Rows come sorted by block."""

    def kept(block: int, groups: dict) -> pa.RecordBatch:
        if block == -1:
            codes, counts = b"", b""
        else:
            each = [summed(*x) for x in groups.values()]
            every, times = np.concatenate([x[0] for x in each]), np.concatenate([x[1] for x in each])
            order = np.argsort(every, kind="stable")
            every = every[order]
            same = every[1:] == every[:-1]
            alone = ~(np.append(same, False) | np.insert(same, 0, False))
            codes, counts = as_block(every[alone]) if alone.any() else b"", smallest(times[order][alone])
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([codes], pa.binary()), pa.array([counts], pa.binary())], ["block", "codes", "counts"])

    now, groups = None, {}
    for batch in batches:
        for row in batch.to_pylist():
            if row["block"] != now:
                if now is not None:
                    yield kept(now, groups)
                now, groups = row["block"], {}
            if now != -1:
                codes, counts = groups.setdefault(row["grp"], ([], []))
                codes.append(of_block(row["codes"]))
                counts.append(as_numbers(row["counts"]).astype(np.int64))
                if len(codes) > 16:
                    one = summed(codes, counts)
                    groups[row["grp"]] = ([one[0]], [one[1]])
    if now is not None:
        yield kept(now, groups)


class Marks:
    """The written k-mers of one group, in a worker."""

    def __init__(self, folder: str, k: int) -> None:
        self.folder, self.k, self.all = folder, k, None
        if 2 * k <= DENSE_BITS:
            self.all = np.zeros(1 << (2 * k), np.uint32)
            for codes, counts in self.blocks():
                if counts.max() >= 1 << 32:
                    self.all = self.all.astype(np.int64)
                self.all[codes] = counts

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(self.folder)
        for info in sorted(store.get_file_info(fs.FileSelector(root)), key=lambda x: x.path):
            if info.base_name.endswith(".parquet"):
                with store.open_input_file(info.path) as f:
                    for batch in pq.ParquetFile(f).iter_batches(1):
                        for row in batch.to_pylist():
                            if row["codes"]:
                                yield of_block(row["codes"]), as_numbers(row["counts"]).astype(np.int64)

    def counts(self, codes: np.ndarray) -> np.ndarray:
        """How often each of the k-mers stands in its one group; 0 if it stands in several."""
        if self.all is not None:
            return self.all[codes].astype(np.int64)
        wanted, which = np.unique(codes, return_inverse=True)
        out = np.zeros(len(wanted), np.int64)
        for known, counts in self.blocks():
            low, high = np.searchsorted(wanted, known[0]), np.searchsorted(wanted, known[-1], side="right")
            at = np.minimum(np.searchsorted(known, wanted[low:high]), len(known) - 1)
            out[low:high] = np.where(known[at] == wanted[low:high], counts[at], out[low:high])
        return out[which]


_marks: list[Marks] = []


def marks_in(folder: str, k: int) -> Marks:
    if not _marks or _marks[0].folder != folder:
        _marks[:] = [Marks(folder, k)]
    return _marks[0]


def _scores(batches: Iterator[pa.RecordBatch], folder: str, k: int) -> Iterator[pa.RecordBatch]:
    """(id, group, score) of the reads, which come sorted by id and group; a pair that goes on in the next slice keeps the k-mers it has had."""
    marks = marks_in(folder, k)
    keys: list[tuple] = []  # the pairs of this slice; the first may have begun before
    pieces: list[str] = []
    owner: list[int] = []
    had, score, hits, size = np.zeros(0, np.uint64), 0, 0, 0
    kinds = None

    def score_slice(last: bool) -> pa.RecordBatch:
        nonlocal had, score, hits, size
        codes, piece, _ = windows(pieces, k)
        counts = marks.counts(codes) if len(codes) else np.zeros(0, np.int64)
        found = counts > 0
        codes, counts, whose = codes[found], counts[found], np.array(owner, np.int64)[piece[found]]
        n = np.bincount(whose, minlength=len(keys))
        total = n.copy()
        order = np.lexsort((codes, whose)) if 2 * k > 40 else np.argsort(whose.astype(np.uint64) << np.uint64(2 * k) | codes)
        codes, counts, whose = codes[order], counts[order], whose[order]
        new = np.ones(len(codes), bool)
        new[1:] = (codes[1:] != codes[:-1]) | (whose[1:] != whose[:-1])
        codes, counts, whose = codes[new], counts[new], whose[new]
        if len(had):
            mine = int(np.searchsorted(whose, 0, side="right"))
            seen = np.isin(codes[:mine], had)
            counts[:mine][seen] = 0
        np.add.at(total, whose, counts)
        total[0] += score
        n[0] += hits
        done = len(keys) if last else len(keys) - 1
        rows = [(*key, t) for key, t, x in zip(keys[:done], total.tolist(), n.tolist(), strict=False) if x]
        out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((*kinds, pa.int64()))], ["id", "grp", "score"])
        if not last:
            own = codes[int(np.searchsorted(whose, len(keys) - 1)) :]
            had = np.union1d(had, own) if len(keys) == 1 else own
            score, hits = int(total[-1]), int(n[-1])
            keys[:] = keys[-1:]
        pieces.clear()
        owner.clear()
        size = 0
        return out

    for batch in batches:
        kinds = kinds or (batch.column(0).type, batch.column(1).type)
        for *key, text in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
            for piece in cut(text or "", k):
                if not keys or keys[-1] != tuple(key):
                    keys.append(tuple(key))
                pieces.append(piece)
                owner.append(len(keys) - 1)
                size += len(piece)
                if size >= WINDOWS:
                    yield score_slice(False)
    if keys:
        yield score_slice(True)


def shared_folder(spark: SparkSession) -> str:
    there = spark.conf.get("spark.checkpoint.dir", None)
    if not there:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        there = f"file://{tempfile.mkdtemp(prefix='helixframe-')}"
    return f"{there.rstrip('/')}/marks-{uuid.uuid4().hex}"


def _joined_scores(reads: DataFrame, k: int, group: str, where=None) -> DataFrame:
    """The same scores by rows of reads and k-mers; where: only of such k-mers."""
    marks, counts = sequence.count_kmers(reads, k, group), sequence.count_kmers(reads, k, "doc_id").withColumnRenamed("cnt", "c")
    if where is not None:
        marks, counts = marks.where(where), counts.where(where)
    return counts.join(sequence.unique_kmers(marks, group), "kmer").groupBy("doc_id", group).agg(F.sum(F.col("c") + F.col("cnt")).alias("score"))


def mark_scores(reads: DataFrame, k: int, group: str) -> DataFrame:
    """(doc_id, group, score) of the reads (doc_id, group, seq): over the k-mers that stand in one group only, how often the read has each, plus how often the group has."""
    if k > 31:
        return _joined_scores(reads, k, group)
    spark = reads.sparkSession
    kind, ids = reads.schema[group].dataType.simpleString(), reads.schema["doc_id"].dataType.simpleString()
    counted = reads.select(group, "seq").mapInArrow(lambda batches: _blocks(batches, k), f"grp {kind}, {BLOCKS}")
    folder = shared_folder(spark)
    counted.repartition("block").sortWithinPartitions("block").mapInArrow(_of_one_group, BLOCKS).write.parquet(folder)
    dealt = reads.select("doc_id", group, "seq").repartition("doc_id", group).sortWithinPartitions("doc_id", group)
    scores = dealt.mapInArrow(lambda batches: _scores(batches, folder, k), f"id {ids}, grp {kind}, score long").select(F.col("id").alias("doc_id"), F.col("grp").alias(group), "score")
    if spark.read.schema(BLOCKS).parquet(folder).where("block = -1").limit(1).count():
        some = reads.where(F.col("seq").rlike(OTHER))
        scores = scores.unionByName(_joined_scores(some, k, group, F.col("kmer").rlike(OTHER))).groupBy("doc_id", group).agg(F.sum("score").alias("score"))
    return scores
