"""Collinear chains of exact matches between two sequences."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def best_chain(q: np.ndarray, t: np.ndarray, n: np.ndarray, gap: float) -> tuple[float, list[int]]:
    """The score and the matches, in order, of the best chain of matches (q, t, length n), each of which begins at or after the end of the one before on both sequences.

    A chain scores its letters less `gap` for each letter between its matches, on either sequence. That cost is a difference of
    two terms, so the best predecessor is a maximum over the ends before a match: a binary indexed tree over t gives it, in
    n log n steps for all matches. Of equal scores the match that ends first counts.
    """
    if not len(q):
        return 0.0, []
    q, t, n = (np.asarray(x, np.int64) for x in (q, t, n))
    ends = np.unique(t + n)
    size = len(ends)
    value, owner = [-np.inf] * (size + 1), [-1] * (size + 1)
    slot = (np.searchsorted(ends, t + n) + 1).tolist()
    reach = np.searchsorted(ends, t, side="right").tolist()
    # An end at a position comes before the starts there.
    where = np.concatenate([q + n, q])
    kind = np.repeat([0, 1], len(q))
    match = np.tile(np.arange(len(q)), 2)
    order = np.lexsort((match, t[match], kind, where))
    score, before = [0.0] * len(q), [-1] * len(q)
    starts, stops, letters = (q + t).tolist(), (q + t + 2 * n).tolist(), n.tolist()
    for e in order.tolist():
        i = int(match[e])
        if kind[e]:
            best, at, from_ = -np.inf, reach[i], -1
            while at:
                if value[at] > best:
                    best, from_ = value[at], owner[at]
                at -= at & -at
            gained = best - gap * starts[i]
            if gained > 0:
                score[i], before[i] = letters[i] + gained, from_
            else:
                score[i] = float(letters[i])
        else:
            offer, at = score[i] + gap * stops[i], slot[i]
            while at <= size:
                if offer > value[at]:
                    value[at], owner[at] = offer, i
                at += at & -at
    last = min(range(len(q)), key=lambda i: (-score[i], q[i] + n[i], t[i] + n[i], i))
    total, chain = score[last], []
    while last >= 0:
        chain.append(last)
        last = before[last]
    return total, chain[::-1]


def chains(matches: DataFrame, keys: list[str], gap: float = 0.05) -> DataFrame:
    """(keys, score, n_matches, q_start, q_end, t_start, t_end) of the best chain of each key's matches (q, t, n); matches of reverse strands come with turned t.

    A key is a pair of sequences and a strand; its matches are one task's, and repeated ones count once.
    """

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["q", "t", "n"])
        q, t, n = (pdf[c].to_numpy() for c in ("q", "t", "n"))
        score, chain = best_chain(q, t, n, gap)
        first, last = chain[0], chain[-1]
        return pd.DataFrame([{**{k: pdf[k].iloc[0] for k in keys}, "score": score, "n_matches": len(chain), "q_start": q[first], "q_end": q[last] + n[last], "t_start": t[first], "t_end": t[last] + n[last]}])

    kinds = ", ".join(f"`{k}` {matches.schema[k].dataType.simpleString()}" for k in keys)
    rows = matches.select(*keys, "q", "t", "n").where("n > 0").distinct()
    return rows.groupBy(*keys).applyInPandas(one, f"{kinds}, score double, n_matches long, q_start long, q_end long, t_start long, t_end long")
