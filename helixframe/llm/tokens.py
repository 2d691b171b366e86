"""Token-ID output: flat files of unsigned integers with 64-bit document offsets.

Documents are dealt out by ranges of doc_id and sorted within each range.  Each task
encodes its documents and writes one part: `.bin` (the ids of all its documents,
end to end, little-endian unsigned 16-bit where the vocabulary fits, else 32-bit),
`.off` (one 64-bit offset per document and one more, in ids from the part's start)
and `.doc` (the 64-bit doc_ids).  A part's place among all ids is the prefix sum of the
parts before it.  Files carry the task attempt in their names and count only
once the attempt's manifest row is in, so a lost executor leaves no half-written part behind.

Encoding is the tokenizer library's.  Its byte-level BPE works on each pre-token alone, so
a text is cut into pre-tokens by vectorised code (the rule of the library's
pre-tokenizer), each distinct one is encoded by the library once, many in a call, and the ids
are put together; the bytes that ids stand for tell where the ids of one pre-token end. Pre-tokens are looked up by a hash and compared byte by byte; in a slice where two differ under one hash,
all texts go to the library whole, as do slices of text with a special token's string, or with code points that Python's
tables do not know.

Edge cases: a null or empty text is the end id alone; rows that repeat an id follow
each other in the order of their text's md5; a null doc_id comes first, as in Spark's ascending order; an
empty table writes nothing and gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import os
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.llm import kernels as K
from helixframe.llm.common import documents, importable, shared_dir, written

END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
SLICE = 1 << 20
#: Bytes of text of a part, about.
PART_BYTES = 16 << 20
#: Pre-tokens that the library encodes in one call.
AT_ONCE = 1024
#: Distinct pre-tokens that a worker remembers; then it starts anew.
MOST_REMEMBERED = 1_000_000
NULL_ID = -(1 << 63)

SPACE, LETTER, NUMBER, OTHER, UNKNOWN = range(5)
_classes: list[np.ndarray] = []


def classes() -> np.ndarray:
    """By code point: white space, letter, number, other, or not known here."""
    if not _classes:
        table = np.full(0x110000, OTHER, np.uint8)
        for i in range(0x110000):
            kind = unicodedata.category(chr(i))
            if kind[0] == "L":
                table[i] = LETTER
            elif kind[0] == "N":
                table[i] = NUMBER
            elif kind[0] == "Z":
                table[i] = SPACE
            elif kind == "Cn":  # not assigned here, but perhaps in the library's tables
                table[i] = UNKNOWN
        table[[*range(9, 14), 0x85]] = SPACE
        _classes.append(table)
    return _classes[0]


def pretoken_starts(points: np.ndarray, row_at: np.ndarray, kind: np.ndarray | None = None) -> np.ndarray:
    """True where a pre-token starts. row_at: the first code point of each row, and the end; kind: the classes of the points, if they are known."""
    n = len(points)
    kind = classes()[points] if kind is None else kind
    space = kind == SPACE
    row_start = np.zeros(n + 1, bool)
    row_start[row_at] = True
    new = np.ones(n, bool)
    new[1:] = kind[1:] != kind[:-1]
    new |= row_start[:n]
    blank_before = np.zeros(n, bool)
    blank_before[1:] = points[:-1] == 0x20
    blank_before &= ~row_start[:n]
    solid_after = np.zeros(n, bool)
    solid_after[:-1] = ~space[1:]
    solid_after &= ~row_start[1:]
    start = np.where(space, new | solid_after, new & ~blank_before)
    # 's 't 'm 'd 're 've 'll at the start of a pre-token are one of their own.
    quote = np.flatnonzero((points == 0x27) & start)
    if len(quote):
        ends = row_at[np.searchsorted(row_at, quote, side="right")]
        at = lambda i: np.where(quote + i < ends, points[np.minimum(quote + i, n - 1)], 0)
        one, two = at(1), at(2)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        length = np.where(short, 2, np.where(long, 3, 0))
        quote, ends, length = quote[length > 0], ends[length > 0], length[length > 0]
        start[quote + 1] = False
        after = quote + length
        start[after[after < ends]] = True
    return start


def stretches(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of all stretches, end to end."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def same_spans(words: np.ndarray, at: np.ndarray, counts: np.ndarray, sizes: np.ndarray, others: np.ndarray, other_at: np.ndarray, other_sizes: np.ndarray) -> bool:
    """Whether each span's bytes (counts words of `words` from `at`) are those of the other one (from other_at in others)."""
    if not (np.array_equal(sizes, other_sizes) and np.array_equal(words[at], others[other_at])):
        return False
    more = np.flatnonzero(counts > 1)
    return np.array_equal(words[stretches(at[more], counts[more])], others[stretches(other_at[more], counts[more])])


def kinds_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes in the order in which they first occur, where each does, and the number of each row's."""
    coded = pa.array(hashes).dictionary_encode()
    which = coded.indices.to_numpy()
    return coded.dictionary.to_numpy(), np.flatnonzero(np.diff(np.maximum.accumulate(which), prepend=-1) > 0), which


class Encoder:
    """Encodes columns of text; remembers the ids of pre-tokens."""

    def __init__(self, tokenizer: str) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.library = Tokenizer.from_file(tokenizer)
        self.specials = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.vocabulary = self.library.get_vocab_size()
        # The bytes that each id stands for: in a byte-level vocabulary every character is one.
        names = self.library.get_vocab()
        self.id_bytes = np.zeros(max(names.values(), default=0) + 1, np.int64)
        self.id_bytes[list(names.values())] = [len(x) for x in names]
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted hashes of the known pre-tokens, and the slot of each
        self.slots = np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1, np.int64)
        self.used = 0
        # The pre-tokens themselves by slot, as the words of K.span_words and their bytes.
        self.words = np.zeros(1 << 16, np.uint64)
        self.word_starts = np.zeros(1, np.int64)
        self.sizes = np.zeros(0, np.int64)

    def _learn(self, keys: np.ndarray, places: np.ndarray, texts: list[str], words: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> None:
        """Encode new pre-tokens; places: where their sorted keys go among the known ones; words, counts, sizes: their bytes."""
        filled = int(self.word_starts[-1])
        if filled + len(words) > len(self.words):
            self.words = np.concatenate([self.words, np.zeros(len(self.words) + len(words), np.uint64)])
        self.words[filled : filled + len(words)] = words
        self.word_starts = np.concatenate([self.word_starts, filled + np.cumsum(counts)])
        self.sizes = np.concatenate([self.sizes, sizes])
        found = [self._encoded(texts[i : i + AT_ONCE], sizes[i : i + AT_ONCE]) for i in range(0, len(texts), AT_ONCE)]
        flat, lengths = (np.concatenate(x) for x in zip(*found, strict=True))
        if self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids) + len(flat), np.uint32)])
        self.ids[self.used : self.used + len(flat)] = flat
        slots = len(self.keys) + np.arange(len(keys))
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(lengths)])
        self.used += len(flat)
        self.keys = np.insert(self.keys, places, keys)
        self.slots = np.insert(self.slots, places, slots)

    def _encoded(self, texts: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pre-tokens, end to end, and how many each has. The library takes them as one text that is already cut: an object
        for each would cost more than its ids. If the ids' bytes do not end where each pre-token does, they are encoded one by one."""
        (got,) = self.library.encode_batch_fast([texts], is_pretokenized=True, add_special_tokens=False)
        ids, ends = np.array(got.ids, np.int64), np.cumsum(sizes)
        upto = np.cumsum(self.id_bytes[ids])
        last = np.searchsorted(upto, ends)
        if len(ids) and upto[-1] == ends[-1] and np.array_equal(upto[last], ends):
            return ids, np.diff(last, prepend=-1)
        each = [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for x in each for i in x], np.int64), np.array([len(x) for x in each], np.int64)

    def _slots(self, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where sorted hashes stand, or would, among the known ones; and whether they are known."""
        places = np.searchsorted(self.keys, kinds)
        if not len(self.keys):
            return places, np.zeros(len(kinds), bool)
        return places, self.keys[np.minimum(places, len(self.keys) - 1)] == kinds

    def whole(self, raw: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """slice() by the library alone."""
        each = [self.library.encode(raw[a:b].decode("utf-8"), add_special_tokens=False).ids for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        return np.array([i for ids in each for i in ids], np.uint32), np.array([len(ids) for ids in each], np.int64)

    def slice(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows, end to end, and the ids in each row."""
        raw = data.tobytes()
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        kind = classes()[points]
        if any(s in raw for s in self.specials) or (kind == UNKNOWN).any():
            return self.whole(raw, at)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(at) - 1, np.int64)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        begins = lead[pretoken_starts(points, np.searchsorted(lead, at), kind)]
        ends = np.append(begins[1:], len(data))
        sizes = ends - begins
        words, counts = K.span_words(data, begins, ends)
        at_word = np.cumsum(counts) - counts
        kinds, first, which = kinds_of(K.word_hashes(words, counts, sizes))
        if not same_spans(words, at_word, counts, sizes, words, at_word[first][which], sizes[first][which]):
            return self.whole(raw, at)
        if len(self.keys) + len(kinds) > MOST_REMEMBERED:
            self.forget()
        order = np.argsort(kinds)
        kinds, first = kinds[order], first[order]
        places, known = self._slots(kinds)
        if not known.all():
            new = np.flatnonzero(~known)
            texts = [raw[x:y].decode("utf-8") for x, y in zip(begins[first[new]].tolist(), ends[first[new]].tolist(), strict=True)]
            mine = first[new]
            self._learn(kinds[new], places[new], texts, words[stretches(at_word[mine], counts[mine])], counts[mine], sizes[mine])
            places, _ = self._slots(kinds)
        slots = self.slots[places]
        if not same_spans(words, at_word[first], counts[first], sizes[first], self.words, self.word_starts[slots], self.sizes[slots]):
            return self.whole(raw, at)
        by_kind = np.empty(len(slots), np.int64)
        by_kind[order] = slots
        known_ids = pa.LargeListArray.from_arrays(pa.array(self.starts), pa.array(self.ids[: self.used]))
        found = known_ids.take(pa.array(by_kind[which]))
        return found.flatten().to_numpy(), np.diff(found.offsets.to_numpy()[np.searchsorted(begins, at)])

    def column(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for _, _, data, at in K.text_slices(column, SLICE):
            yield self.slice(data, at)


_encoders: dict[str, Encoder] = {}


def encoder(tokenizer: str) -> Encoder:
    if tokenizer not in _encoders:
        _encoders[tokenizer] = Encoder(tokenizer)
    return _encoders[tokenizer]


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows' ids with the end id after each."""
    out = np.full(len(ids) + len(counts), end, np.uint32)
    out[np.arange(len(ids)) + K.rows_of(counts)] = ids
    return out, counts + 1


MANIFEST = "part int, path string, width int, n_docs long, n_ids long"


def write_parts(docs: DataFrame, tokenizer: str, folder: str, end: int = END_ID) -> DataFrame:
    """Write the files under a folder that all executors share; one manifest row per part, in the order of doc_id."""
    importable(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    n_parts = max(size // PART_BYTES, docs.sparkSession.sparkContext.defaultParallelism)
    rows = rows.withColumn("mark", F.md5("text")).repartitionByRange(n_parts, "doc_id", "mark").sortWithinPartitions("doc_id", "mark").drop("mark")

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        context = TaskContext.get()
        coder = encoder(tokenizer)
        kind = np.dtype("<u2") if max(coder.vocabulary - 1, end) < 1 << 16 else np.dtype("<u4")
        store, root = fs.FileSystem.from_uri(folder)
        path = f"{root}/part-{context.partitionId():06d}-{context.taskAttemptId()}"
        files, docs_seen, ids_seen = {}, 0, 0
        try:
            for batch in batches:
                if not files and batch.num_rows:
                    store.create_dir(root, recursive=True)
                    files = {x: store.open_output_stream(f"{path}.{x}") for x in ("bin", "off", "doc")}
                    files["off"].write(np.zeros(1, "<i8").tobytes())
                for got in coder.column(batch.column(1)):
                    ids, counts = with_end(*got, end)
                    files["bin"].write(ids.astype(kind).tobytes())
                    files["off"].write((np.cumsum(counts) + ids_seen).astype("<i8").tobytes())
                    ids_seen += len(ids)
                if batch.num_rows:
                    files["doc"].write(batch.column(0).fill_null(NULL_ID).to_numpy().astype("<i8").tobytes())
                    docs_seen += batch.num_rows
        finally:
            for f in files.values():
                f.close()
        if docs_seen:
            values = ([context.partitionId()], [path], [kind.itemsize], [docs_seen], [ids_seen])
            kinds = (pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], [c.split(" ")[0] for c in MANIFEST.split(", ")])

    manifest = written(rows.mapInArrow(parts, MANIFEST), "token-parts")
    order = W.partitionBy(F.lit(1)).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(order), F.lit(0)))


def _mapped(store, path: str, kind: str):
    """A file as an array to be cut (low, high): memory-mapped where the file system is local, else read by stretches."""
    from pyarrow import fs

    if isinstance(store, fs.LocalFileSystem):
        whole = np.memmap(path, kind, "r")
        return lambda low, high: whole[low:high]
    size, f = np.dtype(kind).itemsize, store.open_input_file(path)
    return lambda low, high: np.frombuffer(f.read_at((high - low) * size, low * size), kind)


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def crc_of(ids, low: int, high: int, most: int = 1 << 20) -> int:
    """The crc32 of the ids low to high as 32-bit integers, so many at a time."""
    crc = 0
    for i in range(low, high, most):
        crc = zlib.crc32(ids(i, min(i + most, high)).astype("<u4").tobytes(), crc)
    return crc


def read_parts(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document, from the files."""
    n = manifest.count()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for part in batch.to_pylist():
                ids = _mapped(store, f"{part['path']}.bin", f"<u{part['width']}")
                off = _mapped(store, f"{part['path']}.off", "<i8")
                doc = _mapped(store, f"{part['path']}.doc", "<i8")
                for low in range(0, part["n_docs"], 4096):
                    high = min(low + 4096, part["n_docs"])
                    bounds = off(low, high + 1).tolist()
                    crc = [crc_of(ids, a, b) for a, b in zip(bounds, bounds[1:], strict=False)]
                    names = np.array(doc(low, high))
                    starts, counts = np.array(bounds[:-1]) + part["base"], np.diff(bounds)
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64(), mask=names == NULL_ID), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return manifest.select("path", "width", "n_docs", "base").repartition(max(1, n)).mapInArrow(rows, READ)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    return read_parts(write_parts(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER), folder), folder)
