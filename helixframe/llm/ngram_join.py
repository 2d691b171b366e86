"""N-gram Jaccard self-join of documents, by T-occurrence search with DivideSkip.

A document's set holds the 64-bit hashes of its distinct shingles of five words.
Documents of equal sets form one class, and all work after that is on classes.
Two classes of n and m shingles link when they share T = ceil(4 (n + m) / 9) of them,
which is a Jaccard similarity of 0.8.

1. Inverted lists. List lengths are estimated by a sketch over all
   documents, with as many counters as documents up to a fixed most. Every class orders its shingles from short lists to long ones; the last
   T - 1 (T for the smallest partner) are its long lists and stay out of the index, as
   any partner has to occur on one of the others.
2. Search. Lists are read in order, as a stream. First each member is only paired with
   the list's first one, which joins large groups of near copies without listing
   their pairs; then pairs of members that are not yet in one component are taken, all of
   them, so that no link between components is missed. A pair is a candidate if sizes,
   positions and parity signatures allow the overlap and if it occurs on T less the number of long lists, or more, of the
   short ones.
3. Each candidate pair's overlap is decided by DivideSkip on its whole sets (see divide_skip): the
   short lists are merged with a heap, sets that occur often enough there are looked up in the
   long lists by binary search.

Components are labelled by minimum propagation over written tables. Nothing that grows
with the corpus beyond a fixed size is collected or broadcast: sketch, bitmap of candidate classes, and the keys
that hold more than 1/1024 of a table's rows. The rows of such hot keys (hubs of large groups, their labels, classes of many copies)
are spread: a small partner is broadcast, a set goes to 64 salted parts.

Edge cases: a text of one to four words is one shingle of them all; a null text, or one
without words, has an empty set and is linked with nothing; rows that repeat an id are
documents of their own that share the id; a null doc_id takes the smallest id among its
component's others, or stays null; an empty table gives an empty result; further
columns are ignored by components() and kept by distinct_documents().
"""

from __future__ import annotations

import bisect
import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm import kernels as K
from helixframe.llm.common import documents, hot_keys, importable, joined_by_key, joined_by_salted_key, removed, unused, written

WORDS = 5
#: Fewest and most counters of the list-length sketch (one for each document, in between), and bits of the bitmap of
#: candidate classes (16 for each pair, or each document if there are more pairs). Both only save work: longer tables tell more lists and classes apart.
SKETCH = (1 << 16, 1 << 24)
BITMAP = (1 << 20, 1 << 30)
BLOCKS = 64
#: DivideSkip's cost ratio between merging and probing.
MU = 0.0085
#: Postings of one list that are compared with as many at a time.
BLOCK = 512
#: Bits of a class's parity signature: bit i says whether an odd number of its shingles hash to i.
SIGNATURE = 512


def needed(n, m):
    """The least overlap of linked sets of n and m shingles: 100 i >= 80 (n + m - i)."""
    return -((-4 * (n + m)) // 9)


def may_link(n, i, m, j):
    """Whether sets of n and m shingles that share their i-th and j-th can reach the overlap."""
    return (10 * np.minimum(n, m) >= 8 * np.maximum(n, m)) & (np.minimum(i, j) + np.minimum(n - i, m - j) >= needed(n, m))


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    for _, _, data, at in K.text_slices(column):
        data = K.ASCII_LOWER[data]
        begins, ends, counts = K.word_spans(data, at)
        words = K.span_hashes(data, begins, ends)
        grams = K.gram_hashes(words, WORDS)
        first = 0
        for n in counts.tolist():
            if n >= WORDS:
                yield np.unique(grams[first : first + n - WORDS + 1])
            else:
                yield K.gram_hashes(words[first : first + n], n) if n else np.zeros(0, np.uint64)
            first += n


def class_of(grams: np.ndarray) -> int:
    """A 64-bit name of a set, as a signed integer."""
    total = np.uint64(len(grams)) + np.add.reduce(K.mix(grams ^ np.uint64(0xA0761D6478BD642F)), dtype=np.uint64)
    return int(K.mix(np.array([total]))[0].view(np.int64))


def signature(grams: np.ndarray) -> bytes:
    return np.packbits(np.bincount((grams & np.uint64(SIGNATURE - 1)).astype(np.int64), minlength=SIGNATURE) & 1).tobytes()


def may_differ(n, m):
    """Most shingles that linked sets of n and m do not share; signatures differ in no more bits than that."""
    return n + m - 2 * needed(n, m)


def table_size(n: int, bounds: tuple[int, int]) -> int:
    """The power of two from n on, within bounds."""
    return min(max(1 << max(n - 1, 0).bit_length(), bounds[0]), bounds[1])


def _blocks_out(whole: np.ndarray) -> Iterator[tuple[int, bytes]]:
    for i, part in enumerate(np.split(whole, BLOCKS)):
        if part.any():
            yield i, part.tobytes()


def _merged(parts: DataFrame, dtype: str, join) -> np.ndarray | None:
    """Merge the tasks' arrays, block by block, and bring the fixed-size whole to the driver."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = np.frombuffer(data.as_buffer(), dtype)
                held[block] = join(held[block], x) if block in held else x.copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())], ["block", "data"])

    rows = parts.select("block", "data").repartition("block").mapInArrow(merge, "block int, data binary").collect()
    if not rows:
        return None
    size = len(rows[0].data) // np.dtype(dtype).itemsize
    whole = np.zeros(size * BLOCKS, dtype)
    for r in rows:
        whole[r.block * size : (r.block + 1) * size] = np.frombuffer(r.data, dtype)
    return whole


def _members(docs: DataFrame, size: int) -> DataFrame:
    """A row (doc_id, n, cls, data) per document, and rows (block, data) of the sketch of so many counters.

    A document's data is its class's signature, at its first document in each task. A third column of docs, mark, is kept.
    """
    marked = len(docs.columns) > 2

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(size, np.int64)
        seen: set[int] = set()
        names = ["doc_id", "n", "cls", "block", "data"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
        names += ["mark"] * marked
        for batch in batches:
            sizes, classes, signatures = [], [], []
            for grams in shingle_sets(batch.column(1)):
                c = class_of(grams) if len(grams) else None
                signatures.append(signature(grams) if c is not None and c not in seen else None)
                if c is not None and c not in seen:
                    seen.add(c)
                    np.add.at(sketch, (grams >> np.uint64(32)).astype(np.int64) & (size - 1), 1)
                sizes.append(len(grams))
                classes.append(c)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, kinds[1]), pa.array(classes, kinds[2]), pa.nulls(n, kinds[3]), pa.array(signatures, kinds[4]), *batch.columns[2:]], names)
        for block, data in _blocks_out(sketch):
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kinds[0]), pa.nulls(1, kinds[1]), pa.nulls(1, kinds[2]), pa.array([block], kinds[3]), pa.array([data], kinds[4]), *[pa.nulls(1, pa.string())] * marked], names)

    return docs.mapInArrow(rows, "doc_id long, n int, cls long, block int, data binary" + ", mark string" * marked)


def list_levels(sketch: np.ndarray | None) -> np.ndarray:
    """0 for counters that only the mass of rare shingles explains; above that, one more for each doubling."""
    if sketch is None:
        return np.zeros(SKETCH[0], np.uint8)
    mean = sketch.mean()
    usual = mean + 6 * math.sqrt(mean) + 8
    return np.where(sketch > usual, 1 + np.floor(np.log2(np.maximum(sketch - mean, 1) / math.sqrt(usual))).clip(0, 60), 0).astype(np.uint8)


def short_lists(grams: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The shingles to index: all but the T - 1 of the longest lists, from short to long."""
    n = len(grams)
    level = levels[(grams >> np.uint64(32)).astype(np.int64) & (len(levels) - 1)]
    ordered = grams[np.argsort(level, kind="stable")] if level.any() else grams
    return ordered[: n - (4 * n + 4) // 5 + 1]


def _postings(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            held: list[tuple[np.ndarray, int, int]] = []
            size = 0

            def made() -> pa.RecordBatch:
                lengths = [len(h[0]) for h in held]
                columns = [np.concatenate([h[0] for h in held]).view(np.int64), np.repeat([h[1] for h in held], lengths), np.repeat([h[2] for h in held], lengths).astype(np.int32), np.concatenate([np.arange(k, dtype=np.int32) for k in lengths])]
                return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "cls", "n", "pos"])

            for grams in shingle_sets(batch.column(1)):
                if len(grams) and (c := class_of(grams)) not in seen:
                    seen.add(c)
                    held.append((short_lists(grams, levels), c, len(grams)))
                    size += len(held[-1][0])
                    if size > 1 << 17:
                        yield made()
                        held, size = [], 0
            if held:
                yield made()

    return docs.mapInArrow(rows, "gram long, cls long, n int, pos int")


LISTED = "gram long, cls long, n int, pos int, head long, head_n int, head_pos int"


def _lists(postings: DataFrame) -> DataFrame:
    """Every posting but the first of its list, with that first one. Lists pass as a stream, in the order of (gram, pos, cls).

    First comes the class with the fewest shorter lists, which is the one nearest to the middle of a group of near copies.
    """
    names = [c.split(" ")[0] for c in LISTED.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple[int, int] | None = None
        head = (0, 0, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            gram, cls, n, pos = (batch.column(i).to_numpy() for i in range(4))
            begins = np.ones(len(gram), bool)
            begins[1:] = gram[1:] != gram[:-1]
            begins[0] = before is None or gram[0] != before[0]
            again = np.zeros(len(gram), bool)
            again[1:] = cls[1:] == cls[:-1]
            again[0] = before is not None and cls[0] == before[1]
            before = (int(gram[-1]), int(cls[-1]))
            fresh = begins | ~again
            gram, cls, n, pos, begins = gram[fresh], cls[fresh], n[fresh], pos[fresh], begins[fresh]
            if not len(gram):
                continue
            at = np.maximum.accumulate(np.where(begins, np.arange(len(gram)), -1))
            heads = [np.where(at >= 0, x[np.maximum(at, 0)], old) for x, old in zip((cls, n, pos), head, strict=True)]
            head = tuple(h[-1] for h in heads)
            columns = [gram, cls, n, pos, heads[0], heads[1].astype(np.int32), heads[2].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c[~begins]) for c in columns], names)

    return postings.repartition("gram").sortWithinPartitions("gram", "pos", "cls").mapInArrow(rows, LISTED)


def _candidate_sets(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(cls, grams) of the classes in any pair, by a bitmap: a few others may come along."""
    # There are no more classes than documents, however many pairs they make.
    n_bits = table_size(16 * min(pairs.count(), docs.count()), BITMAP)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.zeros(n_bits // 8, np.uint8)
        for batch in batches:
            for column in batch.columns:
                at = np.unique(column.to_numpy() & (n_bits - 1))
                np.bitwise_or.at(bitmap, at >> 3, (128 >> (at & 7)).astype(np.uint8))
        for block, data in _blocks_out(bitmap):
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([data], pa.binary())], ["block", "data"])

    marks = _merged(pairs.select("a", "b").mapInArrow(bits, "block int, data binary"), "u1", np.bitwise_or)
    if marks is None:
        marks = np.zeros(n_bits // 8, np.uint8)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            held: list[tuple[int, bytes]] = []
            size = 0
            for grams in shingle_sets(batch.column(1)):
                if len(grams) and (c := class_of(grams)) not in seen and marks[(c & (n_bits - 1)) >> 3] >> (7 - (c & 7)) & 1:
                    seen.add(c)
                    held.append((c, grams.tobytes()))
                    size += len(grams)
                    if size > 1 << 17:
                        yield pa.RecordBatch.from_arrays([pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.binary())], ["cls", "grams"])
                        held, size = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.binary())], ["cls", "grams"])

    return docs.mapInArrow(rows, "cls long, grams binary")


def divide_skip(query: np.ndarray, sets: list[np.ndarray]) -> list[bool]:
    """Which of the sets (sorted, distinct) share enough with the query to link.

    The inverted lists of the query's shingles hold the numbers of the sets they occur in.
    L = T / (MU log2 M + 1) of them, the longest, are long (T: least overlap asked of any set, M:
    longest list). A set has to occur on T - L short lists, which a heap merges; those
    that do are looked up in the long lists by binary search until the overlap is reached or out of reach.
    """
    if not sets:
        return []
    need = [needed(len(query), len(x)) for x in sets]
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    at = np.minimum(np.searchsorted(query, every), len(query) - 1)
    shared = query[at] == every
    at, owner = at[shared], owner[shared]
    order = np.argsort(at, kind="stable")
    lists = [x.tolist() for x in np.split(owner[order], np.cumsum(np.bincount(at, minlength=len(query)))[:-1]) if len(x)]
    least = min(need)
    if len(lists) < least:
        return [False] * len(sets)
    lists.sort(key=len, reverse=True)
    n_long = min(least - 1, int(least / (MU * math.log2(len(lists[0]) + 1) + 1)))
    long, short = lists[:n_long], lists[n_long:]
    occurs = Counter(heapq.merge(*short)) if len(sets) > 1 else Counter({0: len(short)})
    out = [False] * len(sets)
    for c, times in occurs.items():
        if times < need[c] - n_long:
            continue
        for k, one in enumerate(long):
            if times >= need[c] or times + n_long - k < need[c]:
                break
            i = bisect.bisect_left(one, c)
            times += i < len(one) and one[i] == c
        out[c] = times >= need[c]
    return out


def _occurs_enough(a: str = "na", b: str = "nb", times: str = "times"):
    """T-occurrence on the short lists: T less the long lists of the set that has more of them."""
    long = lambda n: F.ceil(F.col(n) * 0.8 - 1e-6) - 1
    return F.col(times) >= F.ceil(4 * (F.col(a) + F.col(b)) / 9 - 1e-6) - F.greatest(long(a), long(b))


def _verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that link, of a written table of candidates."""
    sets = _candidate_sets(docs, pairs).dropDuplicates(["cls"])
    # The first of a list (b) may be paired with a large group's every class.
    heads = joined_by_salted_key(pairs, sets.select(F.col("cls").alias("b"), F.col("grams").alias("gb")), "b", "a")
    both = heads.join(sets.select(F.col("cls").alias("a"), F.col("grams").alias("ga")), "a")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            ga, gb = batch.column(2), batch.column(3)
            keep = np.zeros(len(a), bool)
            order = np.argsort(b, kind="stable")
            for group in np.split(order, np.flatnonzero(np.diff(b[order])) + 1):
                if len(group):
                    read = lambda x, i: np.frombuffer(x[int(i)].as_buffer(), np.uint64)
                    keep[group] = divide_skip(read(gb, group[0]), [read(ga, i) for i in group])
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])

    return both.select("a", "b", "ga", "gb").mapInArrow(rows, "a long, b long")


def connected(edges: DataFrame) -> DataFrame:
    """(cls, label): for every end of an edge (a, b), the least of its component. Each round is a written table."""
    both = written(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "join-edges")
    labels = written(both.groupBy(F.col("a").alias("cls")).agg(F.min("b").alias("low")).select("cls", F.least("cls", "low").alias("label")), "join-labels")
    hubs = hot_keys(both, "b")
    while True:
        near = joined_by_key(both, labels.select(F.col("cls").alias("b"), F.col("label").alias("other")), "b", hot=hubs).groupBy(F.col("a").alias("cls")).agg(F.min("other").alias("near"))
        jump = labels.select(F.col("cls").alias("label"), F.col("label").alias("far"))
        following = joined_by_key(labels, jump, "label", "left").join(near, "cls")
        following = written(following.select("cls", F.col("label").alias("was"), F.least("label", "near", F.coalesce("far", "label")).alias("label")), "join-labels")
        done = following.where("was != label").isEmpty()
        removed(labels)
        labels = following.drop("was")
        if done:
            removed(both)
            return labels


def _open_pairs(lists: DataFrame, members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Candidate pairs (a, b) on one list whose labels differ; all candidate pairs if there are no labels."""
    if labels is None:
        rows = lists.withColumn("label", F.col("cls")).withColumn("head_label", F.col("head"))
    else:
        rows = lists.join(labels, "cls", "left").join(labels.select(F.col("cls").alias("head"), F.col("label").alias("head_label")), "head", "left")
        rows = rows.withColumn("label", F.coalesce("label", "cls")).withColumn("head_label", F.coalesce("head_label", "head"))
        rows = rows.join(rows.where("label != head_label").select("gram").distinct(), "gram", "left_semi")
    heads = rows.groupBy("gram").agg(F.first("head").alias("cls"), F.first("head_n").alias("n"), F.first("head_pos").alias("pos"), F.first("head_label").alias("label"))
    signatures = members.where("signature is not null").groupBy("cls").agg(F.first("signature").alias("signature"))
    rows = rows.select("gram", "cls", "n", "pos", "label").unionByName(heads).join(signatures, "cls")
    rows = rows.select("gram", "cls", "n", "pos", "label", "signature")

    def pairs_of(members: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        cls, n, pos, label, marks = members
        n, pos = n.astype(np.int64), pos.astype(np.int64)
        for i in range(0, len(cls), BLOCK):
            for j in range(i, len(cls), BLOCK):
                x, y = slice(i, i + BLOCK), slice(j, j + BLOCK)
                ok = (label[x, None] != label[None, y]) & may_link(n[x, None], pos[x, None], n[None, y], pos[None, y])
                if i == j:
                    ok = np.triu(ok, 1)
                p, q = np.nonzero(ok)
                na, nb = n[x][p], n[y][q]
                near = np.bitwise_count(marks[x][p] ^ marks[y][q]).sum(axis=1) <= may_differ(na, nb)
                p, q, na, nb = p[near], q[near], na[near], nb[near]
                if len(p):
                    a, b = cls[x][p], cls[y][q]
                    swap = a > b
                    columns = [np.where(swap, b, a), np.where(swap, a, b), np.where(swap, nb, na), np.where(swap, na, nb)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "na", "nb"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        gram = None
        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(5)]
            columns.append(np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint64).reshape(-1, SIGNATURE // 64))
            edges = np.flatnonzero(np.diff(columns[0])) + 1
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(columns[0])], strict=True):
                if lo == hi:
                    continue
                if columns[0][lo] != gram:
                    if held:
                        yield from pairs_of([np.concatenate(x) for x in zip(*held, strict=True)])
                    gram, held = columns[0][lo], []
                held.append([c[lo:hi] for c in columns[1:]])
        if held:
            yield from pairs_of([np.concatenate(x) for x in zip(*held, strict=True)])

    found = rows.repartition("gram").sortWithinPartitions("gram", "cls").mapInArrow(search, "a long, b long, na long, nb long")
    return found.groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("times")).where(_occurs_enough()).select("a", "b")


def _indexed(docs: DataFrame, marked: bool = False) -> tuple[DataFrame, DataFrame]:
    """(members, lists), as written tables; marked members have the md5 of their text."""
    first = written(_members(docs.withColumn("mark", F.md5("text")) if marked else docs, table_size(docs.count(), SKETCH)), "join-members")
    levels = list_levels(_merged(first.where(F.col("block").isNotNull()), "i8", np.add))
    return first.where(F.col("block").isNull()).select("doc_id", "n", "cls", F.col("data").alias("signature"), *["mark"] * marked), written(_lists(_postings(docs, levels)), "join-lists")


def _texts(docs: DataFrame) -> DataFrame:
    importable(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All links (a, b) between classes, and the membership (doc_id, n, cls) of documents."""
    docs = _texts(docs)
    members, lists = _indexed(docs)
    return _verified(docs, written(_open_pairs(lists, members, None), "join-pairs")), members.drop("signature")


def _labelled(docs: DataFrame, marked: bool = False) -> tuple[DataFrame, DataFrame]:
    """The members, and (cls, label) of the classes with links: the least class of their component."""
    docs = _texts(docs)
    members, lists = _indexed(docs, marked)
    # Pairs with the first of a list; on a list where another class comes first the pair is not counted, so that some are left to the second step.
    stars = lists.groupBy(F.col("cls").alias("a"), F.col("head").alias("b"), F.col("n").alias("na"), F.col("head_n").alias("nb")).agg(F.count(F.lit(1)).alias("times"))
    stars = stars.where(_occurs_enough() & (10 * F.least("na", "nb") >= 8 * F.greatest("na", "nb"))).select("a", "b")
    pairs = written(stars, "join-pairs")
    found = written(_verified(docs, pairs), "join-links")
    removed(pairs)
    known = connected(found)
    pairs = written(_open_pairs(lists, members, known), "join-pairs")
    removed(lists)
    removed(known)
    more = written(_verified(docs, pairs), "join-links")
    labels = connected(found.unionByName(more))
    for table in (pairs, found, more):
        removed(table)
    return members, labels


def components(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the least doc_id of those reachable by links)."""
    members, labels = _labelled(docs)
    least = members.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("low")).join(labels, "cls", "left")
    least = written(least.select("cls", "low", F.coalesce("label", "cls").alias("root")), "join-roots")
    roots = least.groupBy("root").agg(F.min("low").alias("component_id"))
    least = joined_by_key(least, roots, "root").select("cls", "component_id")
    out = joined_by_key(members.select("doc_id", "n", "cls"), least, "cls", "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """One row of each component, that of the least doc_id and then the least md5 of the text, with all columns of docs.

    A null doc_id comes after all others. Rows without words are linked with nothing and all stay, alike or not.
    """
    members, labels = _labelled(docs, True)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("first")
    firsts = members.where("cls is not null").groupBy("cls").agg(first).join(labels, "cls", "left")
    firsts = firsts.groupBy(F.coalesce("label", "cls").alias("root")).agg(F.min("first").alias("first"))
    # The text decides the class and so the root: no other component has rows of this id and text.
    id_name, mark_name = unused("_kept_id", docs.columns), unused("_kept_mark", docs.columns)
    kept = firsts.select(F.col("first.doc_id").alias(id_name), F.col("first.mark").alias(mark_name))
    text = F.col("text").cast("string")
    worded = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    on = F.col("doc_id").cast("long").eqNullSafe(F.col(id_name)) & (F.md5(text) == F.col(mark_name))
    return docs.where(worded).join(kept, on, "left_semi").dropDuplicates(["doc_id", "text"]).unionByName(docs.where(~worded))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(documents(spark, sf_dir))


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return distinct_documents(docs)
