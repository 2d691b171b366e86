"""Toxicity: a learned lexicon, misspellings by Levenshtein automata, and context windows.

The lexicon is learned from a bounded sample of labelled rows (MAX_LABELLED, a
parameter; never from held-out rows): beginnings of words that stand in toxic documents after
many different words and hardly ever in other ones.  An entry is a whole word where
most of its documents have the same one, else a stem.  Every word of every text is run
through the automaton of all entries (lexicon.py).  An occurrence counts in full, or by
QUOTED where a window of CONTEXT words around it shows a quotation.  A document's
evidence is the sum of the learned log odds of the distinct (entry, edits) that
occur; with the prior it makes the score.

Edge cases: a null or empty text has the prior's score, below 0.5; null labels are not
learned from, several labels of an id count by the largest; without toxic rows the lexicon is empty and every score the prior's;
repeated rows are scored each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import crc_remainder, documents, importable, labelled_sample, labels, removed, written
from helixframe.llm.lexicon import Lexicon

MAX_LABELLED = 20_000
#: Stems have so many letters. Those that reach the driver stand in MIN_SHARE_OF_TOXIC of the sample's toxic documents
#: or more, so their number is bounded by the sample's.
SHORTEST, LONGEST = 4, 12
#: Least number of different contexts among toxic documents, and share of toxic ones among documents with it.
MIN_CONTEXTS, MIN_SHARE_OF_TOXIC, MIN_PRECISION = 6, 0.005, 0.98
#: An entry is a whole word if so many of its toxic documents have that word.
WHOLE = 0.9
#: Log odds of occurrences that the sample has too few of, by edits.
DEFAULT_ODDS = {0: 3.0, 1: 2.6, 2: 1.5}
MOST_ODDS = 6.0
#: Words on either side that can open or close a quotation; what an occurrence inside counts.
CONTEXT = 6
QUOTED = 0.15
OPENING, CLOSING = "\"“„«‘'", "\"”“»’'"
#: Words that announce someone else's.
REPORTING = frozenset("said says wrote writes quote quoted called term word zitat sagte schrieb wort dit écrit mot citation dijo escribió palabra cita".split())
#: A worker's memory of words is emptied at so many letters, and the automaton's of states at so many; both only save work.
MOST_REMEMBERED = 48 << 20
MOST_STATES = 50_000
_STRIP = "\"“”„«»‘’'.,;:!?()[]{}*&%$#-_|<>~"


def words_of(text: str) -> list[str]:
    return text.lower().split()


def bare(word: str) -> str:
    return word.strip(_STRIP)


def _sample_counts(sample: DataFrame, count, schema: str) -> DataFrame:
    """Run count(rows of (words, toxic)) over each task's part of the sample; it yields rows of the schema."""
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = ((words_of(t), bool(y)) for batch in batches for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if t)
        found = list(count(pairs))
        if found:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in found])

    return sample.select("text", "toxic").mapInArrow(rows, schema)


def _beginnings(word: str) -> list[str]:
    return [word[:k] for k in range(SHORTEST, min(len(word), LONGEST) + 1)] + [f"{word}$"] if len(word) >= SHORTEST else []


def learn_entries(sample: DataFrame) -> list[tuple[str, bool]]:
    """(text, whether a stem) of the lexicon's entries, from a table (text, toxic) of bounded size."""

    def in_toxic(pairs):
        n: Counter = Counter()
        for words, toxic in pairs:
            if toxic:
                n.update({b for w in {bare(w) for w in words} for b in _beginnings(w)})
        return ((b, k) for b, k in n.items())

    totals = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_toxic = totals.get(1, 0)
    least = max(MIN_CONTEXTS, math.ceil(MIN_SHARE_OF_TOXIC * n_toxic))
    often = _sample_counts(sample, in_toxic, "start string, n long").groupBy("start").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    candidates = frozenset(r.start for r in often.collect())
    if not candidates:
        return []

    def contexts(pairs):
        clean: Counter = Counter()
        after: defaultdict = defaultdict(set)
        for words, toxic in pairs:
            if toxic:
                words = [bare(w) for w in words]
                for before, w in zip(["", *words], words, strict=False):
                    for b in _beginnings(w):
                        if b in candidates:
                            after[b].add(hash_of(before))
            else:
                # Where other documents only quote a word, it still marks toxic ones.
                clean.update({b for i, w in enumerate(words) for b in _beginnings(bare(w)) if b in candidates and not quoted(words, i)})
        return ((b, list(after[b]), clean[b]) for b in {*after, *clean})

    table = _sample_counts(sample, contexts, "start string, after array<long>, clean long")
    table = table.groupBy("start").agg(F.size(F.array_distinct(F.flatten(F.collect_list("after")))).alias("after"), F.sum("clean").alias("clean"))
    seen = {r.start: (r.after, r.clean) for r in table.where(F.col("after") >= least).collect()}
    good = {b: a for b, (a, clean) in seen.items() if a >= MIN_PRECISION * (a + clean)}
    entries: list[tuple[str, bool]] = []
    covered: set[str] = set()
    for b in sorted((b for b in good if b[-1] != "$"), key=lambda b: (len(b), b)):
        if any(b[:k] in covered for k in range(SHORTEST, len(b))):
            continue
        covered.add(b)
        whole = max((w for w in seen if w[-1] == "$" and w.startswith(b)), key=lambda w: (seen[w][0], w), default=None)
        entries.append((whole, False) if whole and seen[whole][0] >= WHOLE * good[b] else (b, True))
    entries.sort(key=lambda e: (-seen[e[0]][0], e[0]))
    return [(e.rstrip("$"), stem) for e, stem in entries]


def hash_of(word: str) -> int:
    return zlib.crc32(word.encode())


class Finder:
    """Occurrences of a lexicon in texts; remembers words."""

    def __init__(self, entries: list[tuple[str, bool]]) -> None:
        self.lexicon = Lexicon(entries)
        self.known: dict[str, tuple[int, int] | None] = {}
        self.letters = 0

    def occurrences(self, text: str) -> dict[tuple[int, int], float]:
        """By (entry, edits), how much the occurrence that counts most counts."""
        words = words_of(text)
        known, found = self.known, {}
        for i, word in enumerate(words):
            try:
                hit = known[word]
            except KeyError:
                self.letters += len(word) + 100
                if self.letters >= MOST_REMEMBERED:
                    known.clear()
                    self.letters = len(word)
                if len(self.lexicon.states) >= MOST_STATES:
                    self.lexicon.forget()
                hit = known[word] = self.lexicon.nearest(bare(word))
            if hit is not None:
                key = (hit[1], hit[0])
                found[key] = max(found.get(key, 0.0), QUOTED if quoted(words, i) else 1.0)
        return found


def quoted(words: list[str], i: int) -> bool:
    """Whether the i-th word stands within quotation marks, or after a word of reporting, in its window."""
    before, after = words[max(0, i - CONTEXT) : i], words[i + 1 : i + 1 + CONTEXT]
    opened = words[i][:1] in OPENING and len(words[i]) > 1
    for w in reversed(before):
        if opened or w.rstrip(".,;:!?")[-1:] in CLOSING:
            break
        opened = w[:1] in OPENING
    closed = words[i].rstrip(".,;:!?")[-1:] in CLOSING
    for w in after:
        if closed or w[:1] in OPENING:
            break
        closed = w.rstrip(".,;:!?")[-1:] in CLOSING
    return (opened and closed) or any(bare(w) in REPORTING for w in before[-3:])


def learn_odds(sample: DataFrame, entries: list[tuple[str, bool]]) -> tuple[dict[tuple[int, int], float], float]:
    """Log odds by (entry, edits), and the prior."""

    def occur(pairs):
        finder, n = Finder(entries), Counter()
        for words, toxic in pairs:
            # Where an entry itself occurs, near ones say nothing more.
            found = [key for key, weight in finder.occurrences(" ".join(words)).items() if weight == 1]
            n.update((*key, toxic) for key in found if key[1] == min(k[1] for k in found))
        return ((*key, k) for key, k in n.items())

    totals = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    table: defaultdict = defaultdict(lambda: [0, 0])
    for r in _sample_counts(sample, occur, "entry long, edits long, toxic boolean, n long").groupBy("entry", "edits", "toxic").agg(F.sum("n").alias("n")).collect():
        table[r.entry, r.edits][r.toxic] = r.n
    odds = {}
    for key, (clean, toxic) in table.items():
        if clean + toxic >= 3 or clean:
            value = math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))
            odds[key] = round(min(MOST_ODDS, max(0.0, value)), 6)
    for entry in range(len(entries)):
        for edits, value in DEFAULT_ODDS.items():
            odds.setdefault((entry, edits), value)
    return odds, round(math.log((n_toxic + 0.5) / (n_clean + 0.5)), 6) if n_clean else -2.0


def score(docs: DataFrame, entries: list[tuple[str, bool]], odds: dict[tuple[int, int], float], prior: float) -> DataFrame:
    """One row per document: doc_id, score, hits (number of distinct entries and edits that occur)."""
    importable(docs.sparkSession)
    prior = min(prior, -0.7)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(entries)
        for batch in batches:
            values, hits = [], []
            for i in range(batch.num_rows):
                found = finder.occurrences(batch.column(1)[i].as_py() or "")
                total = prior + sum(weight * odds[key] for key, weight in sorted(found.items()))
                values.append(1 / (1 + math.exp(-max(-30.0, min(30.0, total)))))
                hits.append(len(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.round(np.array(values, float), 9)), pa.array(hits, pa.int32())], ["doc_id", "score", "hits"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rows, "doc_id long, score double, hits int")


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> tuple[list[tuple[str, bool]], dict[tuple[int, int], float], float]:
    importable(docs.sparkSession)
    chosen = labelled_sample(labels, "toxic", most).withColumnRenamed("doc_id", "_labelled")
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_labelled"))
    sample = written(sample.select(F.col("text").cast("string"), F.col("toxic").cast("int").alias("toxic")).dropDuplicates(), "toxicity-sample")
    entries = learn_entries(sample)
    model = entries, *learn_odds(sample, entries)
    removed(sample)
    return model


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, known = documents(spark, sf_dir), labels(spark, sf_dir)
    model = fit(docs, known.where(crc_remainder("doc_id", 5) != 0))
    held_out = F.coalesce(crc_remainder("doc_id", 5) == 0, F.lit(False))
    return score(docs, *model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "hits")
