"""Scores by k-mers of one group, against the join of all rows of reads and k-mers."""

import random

from pyspark.sql import functions as F

from helixframe.operators import marks
from helixframe.plans import catalogue

SCHEMA = "doc_id long, lang string, seq string"


def plain(rows, k):
    n, r = {}, {}
    for i, g, s in rows:
        for j in range(len(s or "") - k + 1):
            w = s[j : j + k]
            n.setdefault(w, {}).setdefault(g, 0)
            n[w][g] += 1
            r.setdefault((i, w), 0)
            r[i, w] += 1
    out = {}
    for (i, w), c in r.items():
        if len(n[w]) == 1:
            ((g, cnt),) = n[w].items()
            out[i, g] = out.get((i, g), 0) + c + cnt
    return out


def odd_rows():
    rng = random.Random(5)
    text = lambda n, letters="acgt": "".join(rng.choices(letters, k=n))
    rows = [(i % 40, rng.choice(["en", "de", None, ""]), text(rng.randrange(60))) for i in range(150)]
    rows += [(None, "en", text(30)), (None, "en", text(30)), (None, None, text(9)), (7, "en", None), (8, "de", ""), (9, "fr", text(200, "acgtnACé\U0001f600")), (9, "fr", text(200, "acgtN"))]
    return [*rows, (50, "en", text(900)), (50, "en", text(900)), (50, "fr", "acgt" * 300), (51, "fr", "acgt" * 300)]


def scored(spark, rows, k):
    out = marks.mark_scores(spark.createDataFrame(rows, SCHEMA), k, "lang").collect()
    found = {(r.doc_id, r.lang): r.score for r in out}
    assert len(found) == len(out)
    return found


def test_as_the_join(spark):
    rows = odd_rows()
    for k in (1, 4, 7, 15, 31, 33):
        assert scored(spark, rows, k) == plain(rows, k)


def test_slices(spark, monkeypatch):
    from itertools import chain

    import pyarrow as pa

    rows = sorted((r for r in odd_rows() if not set(r[2] or "") - set("acgt")), key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1]))
    monkeypatch.setattr(marks, "WINDOWS", 64)
    monkeypatch.setattr(marks, "HELD", 50)
    for k in (4, 7, 15, 25):
        # The same code in this process, with slices and blocks that are far smaller than a read.
        table = pa.table({"lang": pa.array([r[1] for r in rows]), "seq": pa.array([r[2] for r in rows])}).to_batches(max_chunksize=20)
        blocks = sorted(chain.from_iterable(b.to_pylist() for b in marks._blocks(iter(table), k)), key=lambda b: b["block"])
        sent = pa.RecordBatch.from_pylist(blocks, pa.schema([("grp", pa.string()), ("block", pa.int32()), ("codes", pa.binary()), ("counts", pa.binary())]))
        kept = pa.Table.from_batches(list(marks._of_one_group(iter([sent]))))

        class Known(marks.Marks):
            def blocks(self, kept=kept):
                return ((marks.of_block(r["codes"]), marks.as_numbers(r["counts"]).astype("int64")) for r in kept.to_pylist() if r["codes"])

        monkeypatch.setattr(marks, "marks_in", lambda folder, k, Known=Known: Known(folder, k))
        reads = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "lang": pa.array([r[1] for r in rows]), "seq": pa.array([r[2] for r in rows])}).to_batches(max_chunksize=20)
        out = list(chain.from_iterable(b.to_pylist() for b in marks._scores(iter(reads), "", k)))
        assert {(r["id"], r["grp"]): r["score"] for r in out} == plain(rows, k)
        assert len({(r["id"], r["grp"]) for r in out}) == len(out)


def test_no_row_for_each_read_and_kmer(spark):
    out = catalogue.QUERIES["kmer_overlap"](spark, "/root/testdata/sf0.001")
    out.select(F.sum("score")).collect()
    plan = out._jdf.queryExecution().toString()
    # Reads meet k-mers in no join and no aggregate over rows of the two.
    assert "Join" not in plan and "kmer" not in plan
