"""k-mer counts against plain counting: several alphabets, long sequences in pieces, groups, nulls and the left-out last window."""

import random
from collections import Counter

import pytest

from helixframe.operators import sequence


@pytest.mark.parametrize("alphabet", ["acgt", "ACGTN", "abcdefghijklmnop", "aé漢b"])
@pytest.mark.parametrize("k", [3, 12, 25])
def test_counts(spark, monkeypatch, alphabet, k):
    monkeypatch.setattr(sequence, "WINDOWS", 64)
    r = random.Random(k)
    rows = [(r.choice(["x", "y", None]), "".join(r.choice(alphabet) for _ in range(r.randrange(300)))) for _ in range(60)] + [("x", None), ("y", ""), ("x", "a" * (k - 1)), ("x", "a" * 500)]
    table = spark.createDataFrame(rows, "g string, seq string")
    for last in (True, False):
        want = Counter((g, s[i : i + k]) for g, s in rows if s for i in range(len(s) - k + (1 if last else 0)))
        assert {(x.g, x.kmer): x.cnt for x in sequence.count_kmers(table, k, "g", include_last=last).collect()} == want
    assert {x.kmer: x.cnt for x in sequence.count_kmers(table, k).collect()} == Counter(s[i : i + k] for _, s in rows if s for i in range(len(s) - k + 1))
