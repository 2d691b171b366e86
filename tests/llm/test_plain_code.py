"""Corpus operators against plain code: models, verdicts, packing and the pipeline's stages."""

import math
import random
import re
import sys
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from helixframe.llm import common, kernels, language_id, lexicon, mixing, ngram_join, ngram_models, packing, quality_classifier, quality_rules, secrets, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(spark, n=120, seed=4, more=()):
    """Texts of two languages, good ones and ones full of symbols; returns the table, its rows and the labels' table."""
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        lang = "en" if i % 3 else "de"
        stock = "the of and house river green stone water under over little great" if lang == "en" else "der die und haus fluss grün stein wasser unter über klein groß"
        words = [r.choice(stock.split()) + r.choice(["", "s", "e"]) for _ in range(r.randrange(5, 90))]
        good = i % 4 != 1
        text = " ".join(words) if good else " ".join(w.upper() + "!!#$" for w in words)
        rows.append((i, text, lang, f"s{i % 3}", len(text)))
        if i % 2:
            labels.append((i, int(good), 0))
    rows += list(more)
    labels += [(r[0], 1, 0) for r in more if (r[0] or 0) >= 700]
    return spark.createDataFrame(rows, COLUMNS), rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


ODD = [(500, None, "en", None, None), (501, "", None, "s0", 0), (502, " \n\t", "de", "s1", 3), (503, "abc", "en", "s2", 3), (504, "a b c", None, None, 5), (504, "a b c", None, None, 5), (None, "the river and the stone", "en", "s1", 23), (505, "word " * 20000, None, "s0", 100000)]


def buckets_of(text):
    data = (text or "").encode()
    out = []
    for i in range(len(data) - ngram_models.N + 1):
        h = 0
        for b in data[i : i + ngram_models.N]:
            h = (h * 257 + b) % 2**32
        out.append((h * 2654435769 % 2**32) >> (32 - 16))
    return out


def plain_ratios(rows, trusted, stratum):
    grams = [buckets_of(r[1]) for r in rows]
    of, raw = Counter(), Counter()
    for r, g in zip(rows, grams, strict=True):
        raw[stratum[r[2]]] += len(g)
        of[stratum[r[2]]] += len(g) * (r[0] in trusted)
    weight = {s: round(2**20 * of[s] / raw[s]) / 2**20 if raw[s] else 0 for s in raw}
    target, mass = Counter(), Counter()
    for r, g in zip(rows, grams, strict=True):
        for b in g:
            target[b] += r[0] in trusted
            mass[b] += weight[stratum[r[2]]]
    return {b: math.log(target[b] + ngram_models.SMOOTHING) - math.log(mass[b] + ngram_models.SMOOTHING) for b in mass}, grams


def test_models_rules_and_resampling(spark):
    docs, rows, labels = corpus(spark, more=ODD)
    strata = {r.lang: r.s for r in docs.selectExpr("lang", f"cast(pmod(xxhash64(lang), {ngram_models.STRATA}) as int) s").distinct().collect()}
    trusted = {r.doc_id for r in labels.where("quality = 1").collect()}
    ratios, grams = plain_ratios(rows, trusted, strata)
    fitted = ngram_models.fit(docs, labels)
    assert all(abs(fitted[b] - v) < 1e-9 for b, v in ratios.items())
    sums = [sum(ratios[b] for b in g) for g in grams]

    got = sorted(((r.doc_id, r.llr, r.base_failed, r.kept) for r in quality_rules.judge(docs, fitted).collect()), key=str)
    want = []
    for r, s, g in zip(rows, sums, grams, strict=True):
        words = WORD.findall(r[1] or "")
        seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        covered = {i + k for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for k in range(3)}
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        want.append((r[0], round(s / max(len(g), 1), 9), failed, not failed and round(s / max(len(g), 1), 9) >= 0))
    want.sort(key=str)
    assert [(a, c, d) for a, _, c, d in got] == [(a, c, d) for a, _, c, d in want]
    assert all(abs(x[1] - y[1]) < 1e-8 for x, y in zip(got, want, strict=True))

    noise = quality_classifier.gumbel(pa.array([r[0] for r in rows], pa.int64()))
    keys = [math.floor((round(s, 6) + g) * quality_classifier.STEPS_PER_NAT) for s, g in zip(sums, noise.tolist(), strict=True)]
    k = round(sum(min(1.0, math.exp(min(0, round(s, 6)))) for s in sums))
    ranked = sorted(range(len(rows)), key=lambda i: (-keys[i], rows[i][0] is not None, rows[i][0] or 0, len(grams[i])))
    kept = Counter((rows[i][0], rows[i][1]) for i in ranked[:k])
    found = quality_classifier.classify(docs, labels)
    assert sorted((r.doc_id for r in found.where("kept").collect()), key=str) == sorted((d for d, n in kept.items() for d in [d[0]] * n), key=str)
    assert Counter((r.doc_id, r.text) for r in quality_classifier.keep(docs, labels).collect()) == kept
    assert 0.5 * len(rows) < k < 0.9 * len(rows)
    assert quality_classifier.keep(docs, labels, share=0.25).count() == len(rows) // 4


def test_resampling_follows_the_weights(spark):
    """Of many documents of two weights, those of the larger are drawn more often, as sampling without replacement says."""
    n, k = 20_000, 6_000
    noise = quality_classifier.gumbel(pa.array(range(n), pa.int64()))
    weight = np.where(np.arange(n) % 2 == 0, math.log(4), 0.0)
    table = spark.createDataFrame([(i, 1, int(v)) for i, v in enumerate(np.floor((weight + noise) * quality_classifier.STEPS_PER_NAT))], "doc_id long, n_grams long, key long")
    least = quality_classifier.top_key(table, k)
    drawn = np.floor((weight + noise) * quality_classifier.STEPS_PER_NAT) >= least
    # Of a share x of the light ones, 1 - (1 - x) ** 4 of the heavy ones: x + 1 - (1 - x) ** 4 = 2 k / n.
    x = next(v / 10000 for v in range(10000) if v / 10000 + 1 - (1 - v / 10000) ** 4 >= 2 * k / n)
    assert abs(drawn[1::2].mean() - x) < 0.02 and abs(drawn[0::2].mean() - (1 - (1 - x) ** 4)) < 0.02


def test_extreme_keys(spark):
    keys = [-(1 << 50), -(1 << 50) + 3, 1 << 45, 5, 7, -(1 << 44)]
    table = spark.createDataFrame([(i, 0, k) for i, k in enumerate(keys)], "doc_id long, n_grams long, key long")
    assert [quality_classifier.top_key(table, k) for k in range(1, 6)] == sorted(keys, reverse=True)[:5]


def test_language_vectors_against_plain_code(spark):
    texts = [("Der Hund läuft über die Straße", "de"), ("the dog runs over the street 123", "en"), ("el perro corre por la calle", "es"), ("xyz", None), (None, "de"), ("", "en"), ("漢字 かな 漢字", "ja"), ("12 !!", "en"), ("the the the the", "en"), ("the dog", None)]
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(texts)], "doc_id long, text string, lang string")

    def vector(text):
        letters = " "
        for c in (text or "") + " ":
            c = (c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " "
            letters += c if c != " " or letters[-1] != " " else ""
        total = np.zeros(language_id.D)
        for i in range(len(letters) - 2):
            total += np.prod([np.roll(language_id._alphabet.vector(0 if c == " " else ord(c)).astype(int), 2 - j) for j, c in enumerate(letters[i : i + 3])], axis=0)
        return total if any(c.isalpha() for c in text or "") else np.zeros(language_id.D)

    prototypes = defaultdict(lambda: np.zeros(language_id.D))
    for t, lang in texts:
        if lang and t:
            prototypes[lang] += vector(t)
    names, made = language_id.train(docs)
    assert names == sorted({lang for t, lang in texts if lang and t})
    cosine = lambda a, b: float(a @ b / max(np.linalg.norm(a) * np.linalg.norm(b), 1e-12))
    for r in language_id.identify(docs, names, made).collect():
        v = vector(texts[r.doc_id][0])
        if not v.any():
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        each = [round(cosine(v, prototypes[n]), 9) for n in names]
        assert r.lang_pred == names[int(np.argmax(each))] and abs(r.score - min(1, max(0, max(each)))) < 1e-6, r


def test_language_memory_paths_agree():
    """Dense and sparse sums, whole and in parts, are the same numbers."""
    r = random.Random(1)
    text = ["".join(r.choice("abcdefghijklmnopqrst é漢") for _ in range(r.randrange(60))) for _ in range(300)]
    data, at = kernels.utf8(pa.array(text))
    whole = language_id.text_vectors(data, at)
    kinds, pairs = language_id.KINDS, language_id.PAIRS
    try:
        language_id.KINDS, language_id.PAIRS = 37, 11
        parts = language_id.text_vectors(data, at)
    finally:
        language_id.KINDS, language_id.PAIRS = kinds, pairs
    assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])
    one = [language_id.text_vectors(*kernels.utf8(pa.array([t]))) for t in text]
    assert np.array_equal(whole[0], np.concatenate([v for v, _ in one]))


def test_language_edges(spark):
    docs, rows, _ = corpus(spark, 30, more=ODD)
    found = {(r.doc_id, r.lang_pred, r.score) for r in language_id.identify(docs, *language_id.train(docs)).collect()}
    by = {d: (p, s) for d, p, s in found}
    assert by[500] == by[501] == by[502] == ("und", 0.0) and by[504][0] in ("en", "de") and by[None][0] == "en"
    assert len(found) == len({r[0] for r in rows})
    assert language_id.identify(docs, [], np.zeros((0, language_id.D))).select("lang_pred").distinct().first()[0] == "und"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        row = [last := i] + [last := min(row[j] + (c != d), row[j + 1] + 1, last + 1) for j, d in enumerate(b)]
    return row[-1]


def test_toxicity_against_plain_code(spark):
    r = random.Random(8)
    bad, calm = ["blorpen", "snurgly"], "the house is green and the river runs under a stone bridge today".split()
    rows, labels = [], []
    for i in range(160):
        words = [r.choice(calm) for _ in range(r.randrange(6, 20))]
        toxic = i % 2
        if toxic:
            w = r.choice(bad)
            words.insert(r.randrange(len(words)), w if i % 6 else w[:3] + "x" + w[4:])
        elif i % 10 == 0:
            words += ["he", "said", f'"{r.choice(bad)}"']
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    rows += [(500, None), (501, ""), (502, "blorpen"), (502, "blorpen"), (None, "you BLORPEN!"), (503, "calm " * 30000 + "blorpen")]
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    entries, odds, prior = toxicity.fit(docs, known)
    assert {e for e, _ in entries} >= {b[: len(e)] for b in bad for e, _ in entries if b.startswith(e)} and len(entries) >= 2

    def near(word):
        best = None
        for n, (text, stem) in enumerate(entries):
            most = lexicon.allowed_edits(text, stem)
            d = min(distance(word[:i], text) for i in range(len(word) + 1)) if stem else distance(word, text)
            if d <= most and (best is None or (d, n) < best):
                best = (d, n)
        return best

    def occurrences(text):
        words, out = text.lower().split(), {}
        for i, w in enumerate(words):
            hit = near(w.strip(toxicity._STRIP))
            if hit:
                key = (hit[1], hit[0])
                out[key] = max(out.get(key, 0), toxicity.QUOTED if toxicity.quoted(words, i) else 1)
        return out

    table, toxic_of = defaultdict(lambda: [0, 0]), dict((i, t) for i, _, t in labels)
    sample = {(t, toxic_of[i]) for i, t in rows if i in toxic_of}
    for text, toxic in sample:
        found = [k for k, w in occurrences(text).items() if w == 1]
        for k in found:
            if k[1] == min(x[1] for x in found):
                table[k][toxic] += 1
    n = Counter(t for _, t in sample)
    want = {}
    for k, (clean, toxic) in table.items():
        if clean + toxic >= 3 or clean:
            want[k] = round(min(6.0, max(0.0, math.log((toxic + 0.5) / (n[1] + 1)) - math.log((clean + 0.5) / (n[0] + 1)))), 6)
    for e in range(len(entries)):
        for edits, v in toxicity.DEFAULT_ODDS.items():
            want.setdefault((e, edits), v)
    assert odds == want and prior == round(math.log((n[1] + 0.5) / (n[0] + 0.5)), 6)
    got = sorted(((x.doc_id, x.score) for x in toxicity.score(docs, entries, odds, prior).collect()), key=str)
    plain = []
    for i, text in rows:
        total = min(prior, -0.7) + sum(w * odds[k] for k, w in occurrences((text or "")[-400:]).items())
        plain.append((i, round(1 / (1 + math.exp(-total)), 9)))
    for (i, a), (j, b) in zip(got, sorted(plain, key=str), strict=True):
        assert i == j and abs(a - b) < 1e-8
    scores = dict(got)
    assert scores[500] == scores[501] < 0.5 < scores[502] == scores[503] == scores[None]


def test_lexicon_forgets_without_change():
    words = ["moron", "disgusting", "trash", "worthless"]
    a, b = lexicon.Lexicon([(w, False) for w in words]), lexicon.Lexicon([(w, False) for w in words])
    for w in ["moro", "trsh", "disgustin", "x" * 5000, "worthles", "morons", "rubbish"]:
        b.forget()
        assert a.nearest(w) == b.nearest(w)


def one_by_one(lengths, sizes, opening):
    """Best-fit decreasing, item by item: the cost after each bin has become the smallest size that holds it."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if b[0] - b[1] >= n]
        if fits:
            min(fits, key=lambda b: b[0] - b[1])[1] += n
        else:
            bins.append([opening(n), n])
    return sum(packing.cost(next(s for s in sizes if s >= used)) for _, used in bins)


def test_packing_plans_against_item_by_item():
    r = random.Random(3)
    for sizes in ((8, 16, 32), (10, 25), (7,)):
        for _ in range(120):
            lengths = [r.randrange(1, max(sizes) + 1) for _ in range(r.randrange(1, 60))]
            fitting = lambda n: [s for s in sizes if s >= n]  # noqa: E731, B023
            rules = [lambda n: min(fitting(n), key=lambda s: (packing.cost(s) / (s // n), s)), lambda n: min(fitting(n), key=lambda s: (packing.cost(s) / s, s))]  # noqa: B023
            rules += [lambda n, s=s: s if s >= n else fitting(n)[0] for s in sizes]  # noqa: B023
            costs = [one_by_one(lengths, sizes, rule) for rule in rules]
            for rule, cost in zip(rules, costs, strict=True):
                assert abs(packing.plan_bins(Counter(lengths), sizes, rule)[2] - cost) < 1e-9
            _, groups = packing.best_plan(Counter(lengths), sizes)
            assert abs(sum(n * packing.cost(s) for _, n, s in groups) - min(costs)) < 1e-9


def check_packed(pieces, words, sizes):
    """Every word of every document once, bins without holes or overflow, each the smallest size that holds it, at the plan's cost."""
    assert sum(p.length for p in pieces) == sum(words)
    of, bins = defaultdict(list), defaultdict(list)
    for p in pieces:
        of[p.doc_id].append(p)
        if p.length:
            bins[p.bin_id].append(p)
    cost = 0
    for held in bins.values():
        held.sort(key=lambda p: p.bin_offset)
        assert [p.bin_offset for p in held] == [sum(q.length for q in held[:i]) for i in range(len(held))]
        used = sum(p.length for p in held)
        assert {p.bin_size for p in held} == {next(s for s in sizes if s >= used)}
        cost += packing.cost(held[0].bin_size)
    rests = [n % max(sizes) for n in words if n % max(sizes)]
    _, groups = packing.best_plan(Counter(rests), sizes)
    assert abs(cost - sum(n * packing.cost(s) for _, n, s in groups) - sum(n // max(sizes) for n in words) * packing.cost(max(sizes))) < 1e-6


def test_packing_rows(spark):
    docs, rows, _ = corpus(spark, 90, more=ODD + [(600 + i, "same words here", "en", "s0", 15) for i in range(200)])
    sizes = (16, 64, 256)
    check_packed(packing.pack(docs, sizes).collect(), [len(WORD.findall(r[1] or "")) for r in rows], sizes)


def jaccard_groups(texts):
    sets = []
    for t in texts:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in WORD.findall(t or "")]
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))], sets


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    where = tmp_path_factory.mktemp("pipeline")
    r = random.Random(6)
    base = [" ".join(f"{r.choice('abcdefgh')}{r.randrange(40)}" for _ in range(70)) for _ in range(6)]
    more = [(700 + 10 * i + j, t.replace(t.split()[30], "changed", 1) if j % 2 else t + f" password = 'abcdefgh{i}{j}xyz'", "en", f"s{j % 3}", len(t)) for i, t in enumerate(base) for j in range(5)]
    docs, rows, labels = corpus(spark, 80, more=ODD + more)
    docs.write.parquet(f"{where}/documents.parquet")
    labels.write.parquet(f"{where}/labels.parquet")
    return str(where)


def test_pipeline_stages_against_plain_code(spark, folder):
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "ngram_join", "secret_scan", "mix_sources", "best_fit_packing"]
    docs = common.documents(spark, folder)
    key = lambda rows: sorted((tuple(r) for r in rows), key=str)

    after = common.written(stages["quality_classifier"](spark, docs, folder), "test")
    kept = quality_classifier.classify(docs, common.labels(spark, folder)).where("kept").select("doc_id")
    assert key(after.select("doc_id").collect()) == key(kept.collect()) and after.columns == docs.columns
    assert not set(key(after.collect())) - set(key(docs.collect()))

    before, docs = after.collect(), after
    after = common.written(stages["ngram_join"](spark, docs, folder), "test")
    groups, sets = jaccard_groups([r.text for r in before])
    want = []
    for g in sorted(set(groups)):
        members = [r for r, x in zip(before, groups, strict=True) if x == g]
        worded = sets[g]
        want += [min(members, key=lambda r: (r.doc_id is None, r.doc_id or 0))] if worded else members
    assert key(after.select("doc_id").collect()) == key([(r.doc_id,) for r in want])
    assert len(want) < len(before)

    before, docs = after.collect(), after
    after = common.written(stages["secret_scan"](spark, docs, folder), "test")
    assert key(after.drop("text", "n_chars").collect()) == key(docs.drop("text", "n_chars").collect())
    texts = {(r.doc_id, r.source): r.text for r in after.collect()}
    for r in before:
        plain = secrets.ASSIGN.sub(lambda m: "[secret]" if len(m[2]) >= 12 else m[0], r.text) if r.text else r.text
        assert texts[r.doc_id, r.source] == plain
    assert any("[secret]" in (t or "") for t in texts.values())

    docs = after
    after = common.written(stages["mix_sources"](spark, docs, folder), "test")
    db = duckdb.connect()
    db.register("documents", pa.Table.from_pandas(docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"})))
    taken = {(d, s): t for d, s, _, _, _, t in db.sql(mixing.SQL).fetchall()}
    got = Counter()
    for r in after.collect():
        got[r.doc_id, r.source] += len(WORD.findall(r.text))
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in taken.items() if v} and after.columns == docs.columns

    docs = after
    check_packed(stages["best_fit_packing"](spark, docs, folder).collect(), [len(WORD.findall(r.text or "")) for r in docs.collect()], packing.SIZES)
    assert corpus_pipeline.run(spark, folder).count() >= docs.count()


def test_pipeline_stages_on_empty_tables(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    empty = spark.createDataFrame([], COLUMNS)
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, str(tmp_path))
        assert out.count() == 0 and (name == "best_fit_packing" or out.columns == empty.columns)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_shared_folder_is_not_made_up_on_a_cluster(monkeypatch):
    class Conf(dict):
        set = dict.__setitem__

    class Session:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master = "spark://somewhere:7077"

    with pytest.raises(ValueError):
        common.shared_dir(Session())
    Session.sparkContext.master = "local[2]"
    assert common.shared_dir(Session()).startswith("file://")
    assert sys.modules["helixframe.llm.common"] is common
