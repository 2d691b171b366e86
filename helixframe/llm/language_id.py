"""Language identification with hyperdimensional profiles.

Every letter (any Unicode letter, lower-cased; runs of other characters count as
one space) has a random vector of D entries +1 or -1, drawn from its code point.
An n-gram's vector binds its letters' vectors, each rotated by its place, by
multiplication; a text's vector bundles (adds) those of its trigrams, and so does a
language's prototype over all its training texts.  A text gets the language whose
prototype has the largest cosine with it.

All sums are of whole numbers, and so are the same in any
partitioning.  Training adds up D numbers per language.

Edge cases: a null text, or one without letters, is `und` with score 0; a null
lang is not learned from; equal cosines go to the language first in order; without
training texts all is `und`; repeated rows count each; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm import kernels as K
from helixframe.llm.common import crc_remainder, documents, importable

D = 1024
SEED = 20
UNKNOWN = "und"
#: Trigrams whose vectors are held at once, (row, trigram) pairs that are added at once, and rows of a slice.
KINDS, PAIRS, ROWS = 4096, 4096, 2048


class _Alphabet:
    """Lower case and letter tables by code point, and the letters' vectors; made once in each worker."""

    def __init__(self) -> None:
        self.fold = np.zeros(0, np.uint32)
        self.vectors: dict[int, np.ndarray] = {}

    def folded(self, points: np.ndarray) -> np.ndarray:
        """Lower-cased letters; 0 for all else."""
        top = int(points.max(initial=0)) + 1
        if top > len(self.fold):
            have, top = len(self.fold), 0x3000 if top <= 0x3000 else 0x110000
            more = np.zeros(top - have, np.uint32)
            for i in range(have, top):
                c = chr(i)
                if c.isalpha():
                    low = c.lower()
                    more[i - have] = ord(low) if len(low) == 1 else i
            self.fold = np.concatenate([self.fold, more])
        return self.fold[points]

    def vector(self, point: int) -> np.ndarray:
        if point not in self.vectors:
            rng = np.random.Generator(np.random.Philox(key=[SEED, point]))
            self.vectors[point] = (rng.integers(0, 2, D, dtype=np.int8) * 2 - 1).astype(np.int8)
        return self.vectors[point]


_alphabet = _Alphabet()


def trigrams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters (u, 3) of the distinct trigrams, index into them of each trigram, trigrams in each row)."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    rows = np.diff(lead[at])
    # A space before each row and one after it.
    letters = np.zeros(len(points) + 2 * len(rows), np.uint32)
    place = np.arange(len(points)) + 2 * K.rows_of(rows) + 1
    letters[place] = _alphabet.folded(points)
    keep = letters != 0
    keep[1:] |= letters[:-1] != 0
    first = np.concatenate([[0], np.cumsum(rows + 2)])
    keep[first[:-1]] = True
    left = np.diff(np.concatenate([[0], np.cumsum(keep)])[first])
    letters = letters[keep]
    left_at = np.concatenate([[0], np.cumsum(left)])
    counts = np.maximum(left - 2, 0)
    seen = np.flatnonzero(np.bincount(letters, minlength=1))
    a = len(seen)
    code = np.zeros(int(seen[-1]) + 1 if a else 1, np.int64)
    code[seen] = np.arange(a)
    x = code[letters]
    if len(x) < 3:
        return np.zeros((0, 3), np.int64), np.zeros(0, np.int64), np.zeros(len(rows), np.int64)
    whole = (x[:-2] * a + x[1:-1]) * a + x[2:]
    inside = np.ones(len(whole), bool)
    for i in (1, 2):
        cut = left_at[1:-1] - i
        inside[cut[(cut >= 0) & (cut < len(whole))]] = False
    whole = whole[inside]
    if a**3 <= 1 << 22:
        kinds = np.flatnonzero(np.bincount(whole, minlength=1))
        index = np.zeros(int(kinds[-1]) + 1 if len(kinds) else 1, np.int64)
        index[kinds] = np.arange(len(kinds))
        which = index[whole]
    else:
        kinds, which = np.unique(whole, return_inverse=True)
    return np.stack([seen[kinds // (a * a)], seen[kinds // a % a], seen[kinds % a]], axis=1), which, counts


def bound_vectors(letters: np.ndarray) -> np.ndarray:
    """(u, D): the vector of each trigram, as float32."""
    points, code = np.unique(letters, return_inverse=True)
    code = code.reshape(letters.shape)
    one = np.stack([_alphabet.vector(int(p)) for p in points]) if len(points) else np.zeros((0, D), np.int8)
    out = np.roll(one, 2, axis=1)[code[:, 0]]
    out *= np.roll(one, 1, axis=1)[code[:, 1]]
    out *= one[code[:, 2]]
    return out.astype(np.float32)


def text_vectors(data: np.ndarray, at: np.ndarray, groups: np.ndarray | None = None, n: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The bundled vector of each row (or of each group of rows), and its number of trigrams with a letter.

    Distinct (row, trigram) pairs are taken KINDS trigrams at a time: their counts make a dense table for one matrix product where
    most of it is filled, else the pairs' vectors are added up row by row, PAIRS of them at a time. Memory follows KINDS, PAIRS
    and the number of rows, never rows times trigrams.
    """
    letters, which, counts = trigrams(data, at)
    n = len(counts) if n is None else n
    row = K.rows_of(counts)
    row = row if groups is None else groups[row]
    u = len(letters)
    out = np.zeros((n, D))
    if not u:
        return out, np.zeros(n, np.int64)
    lettered = (letters != 0).any(axis=1)
    if u * n <= 1 << 22:
        table = np.bincount(which * n + row, minlength=1)
        pairs = np.flatnonzero(table)
        times = table[pairs]
    else:
        pairs, times = np.unique(which * n + row, return_counts=True)
    kind, row = pairs // n, pairs % n
    known = np.bincount(row, times * lettered[kind], minlength=n).astype(np.int64)
    exact = np.float32 if len(which) < 1 << 24 else np.float64
    cuts = np.searchsorted(kind, np.arange(0, u + KINDS, KINDS))
    for i, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
        if low == high:
            continue
        vectors = bound_vectors(letters[i * KINDS : (i + 1) * KINDS]).astype(exact)
        k, t = kind[low:high] - i * KINDS, times[low:high].astype(exact)
        rows, r = np.unique(row[low:high], return_inverse=True)
        if len(rows) * len(vectors) <= 16 * len(k):
            table = np.zeros((len(rows), len(vectors)), exact)
            table[r, k] = t
            out[rows] += table @ vectors
            continue
        order = np.argsort(r, kind="stable")
        r, k, t = r[order], k[order], t[order]
        for x in range(0, len(r), PAIRS):
            y = slice(x, x + PAIRS)
            first = np.flatnonzero(np.diff(r[y], prepend=-1))
            out[rows[r[y][first]]] += np.add.reduceat(vectors[k[y]] * t[y][:, None], first, axis=0)
    return out, known


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and their prototypes, of unit length. D numbers per language reach the driver."""
    importable(docs.sparkSession)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            codes = batch.column(1).dictionary_encode()
            names, groups = codes.dictionary.to_pylist(), codes.indices.to_numpy()
            for low, high, data, at in K.text_slices(batch.column(0), rows=ROWS):
                here, index = np.unique(groups[low:high], return_inverse=True)
                vectors, _ = text_vectors(data, at, index, len(here))
                for g, v in zip(here, vectors, strict=True):
                    sums[names[g]] = sums.get(names[g], 0) + v
        for name, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * D), pa.array(np.arange(D, dtype=np.int32)), pa.array(v.astype(np.int64))], ["lang", "place", "total"])

    parts = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("text").cast("string"), F.col("lang").cast("string"))
    table = parts.mapInArrow(partial, "lang string, place int, total long").groupBy("lang", "place").agg(F.sum("total").alias("total")).toPandas()
    names = sorted(table["lang"].unique())
    prototypes = np.zeros((len(names), D))
    for r in table.itertuples(index=False):
        prototypes[names.index(r.lang), r.place] = r.total
    return names, prototypes / np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-12)


def identify(docs: DataFrame, names: list[str], prototypes: np.ndarray) -> DataFrame:
    """One row per document: doc_id, lang_pred, score (the cosine, 0 to 1)."""
    importable(docs.sparkSession)
    labels = np.array([*names, UNKNOWN], dtype=object)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = [np.zeros(0, np.int64)], [np.zeros(0)]
            for _, _, data, at in K.text_slices(batch.column(1), rows=ROWS):
                vectors, lettered = text_vectors(data, at)
                cosine = np.round(vectors @ prototypes.T / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12), 9) if names else np.zeros((len(at) - 1, 1))
                known = (lettered > 0) & bool(names)
                best.append(np.where(known, cosine.argmax(axis=1), len(names)))
                score.append(np.where(known, np.clip(cosine.max(axis=1), 0, 1), 0.0))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(labels[np.concatenate(best)], pa.string()), pa.array(np.concatenate(score))], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rows, "doc_id long, lang_pred string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = crc_remainder("doc_id", 4) == 2
    names, prototypes = train(docs.where(~F.coalesce(held_out, F.lit(False))))
    out = identify(docs, names, prototypes)
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")
