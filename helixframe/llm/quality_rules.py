"""Quality rules: fixed text statistics, then a length-normalised log-likelihood ratio with one threshold.

The ratio compares hashed n-gram multinomials of the trusted target (documents
labelled of good quality) and of the raw corpus, both counted over all rows.  It
is divided by the number of n-grams, and a document is kept if the target explains it
at least as well as the corpus does.  Every document gets a
verdict by the same rule; no rank or quantile of the corpus enters it.

Edge cases: a null or empty text has no words and fails the base rule
(n_words < 50), with a ratio of 0; a ratio equal to the threshold keeps; repeated rows are judged each; an empty table gives an empty
result; further columns are ignored; lines are split at \n alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm import kernels as K
from helixframe.llm import ngram_models as M
from helixframe.llm.common import documents, importable, labels

#: Least length-normalised log ratio, in nats an n-gram, of a kept document.
THRESHOLD = 0.0
MIN_WORDS = 50
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

FIELDS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, llr double, kept boolean"


def _per_row(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[at])


def _later_copies(row: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Of the items (row, h), how many in each row equal another one before."""
    _, first, times = np.unique(h ^ K.mix(row.astype(np.uint64)), return_index=True, return_counts=True)
    return np.bincount(row[first], times - 1, minlength=n).astype(np.int64)


def statistics(data: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each row."""
    n = len(at) - 1
    solid = ~K.IS_SPACE[data]
    begins, ends, counts = K.word_spans(data, at)
    out = {"n_words": counts, "word_chars": _per_row(solid & ((data & 0xC0) != 0x80), at), "n_symbols": _per_row(SYMBOLS[data], at)}

    starts = np.unique(np.concatenate([at[:-1], np.flatnonzero(data == 10) + 1]))
    starts = starts[starts < len(data)]
    stops = np.append(starts[1:], len(data))
    stops = stops - ((stops > starts) & (data[np.maximum(stops - 1, 0)] == 10)) if len(data) else stops
    worded = np.zeros(len(data) + 1, np.int64)
    np.cumsum(solid, out=worded[1:])
    full = worded[stops] > worded[starts]
    starts, stops = starts[full], stops[full]
    out["n_dup_lines"] = _later_copies(np.searchsorted(at, starts, side="right") - 1, K.span_hashes(data, starts, stops), n)

    row = K.rows_of(counts)
    grams = K.gram_hashes(K.span_hashes(data, begins, ends), 3)
    inside = np.flatnonzero(row[: len(grams)] == row[len(row) - len(grams) :])
    keys = grams[inside] ^ K.mix(row[inside].astype(np.uint64))
    _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
    twice = inside[times[which] > 1]
    covered = np.zeros(len(row) + 2, bool)
    for i in range(3):
        covered[twice + i] = True
    out["n_repeat_words"] = np.bincount(row[covered[: len(row)]], minlength=n)
    return out


def judge(docs: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: the base statistics, the normalised ratio llr and the verdict kept."""
    importable(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for _, _, data, at in K.text_slices(batch.column(1)):
                x = statistics(data, at)
                sums, grams = M.gram_scores(ratios, data, at)
                x["base_failed"] = (x["n_words"] < MIN_WORDS) | (100 * x["n_repeat_words"] > 50 * x["n_words"])
                x["llr"] = np.round(sums / np.maximum(grams, 1), 9)
                x["kept"] = ~x["base_failed"] & (x["llr"] >= threshold)
                parts.append(x)
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept"]
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            columns = [pa.array(np.concatenate([p[c] for p in parts]) if parts else [], kind) for c, kind in zip(names, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *names])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rows, FIELDS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return judge(docs, M.fit(docs, labels(spark, sf_dir)))
