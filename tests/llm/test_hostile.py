"""Texts and files made to break the corpus operators: equal hashes, deep or endless secrets, swelling images, clashing names."""

import random
import struct
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

from helixframe.llm import kernels, media, mixing, ngram_join, packing, quality_classifier, quality_rules, secrets, tiff, tokens

SCHEMA = "doc_id long, text string"


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") & 1] for i in range(n))


def test_words_that_polynomial_hashes_confuse(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    one = thue_morse(1024)
    two = one.translate({97: "b", 98: "a"})
    docs = spark.createDataFrame([(1, one), (2, two), (3, one + "\n" + two)], SCHEMA)
    assert sorted(tuple(r) for r in ngram_join.components(docs).collect()) == [(1, 1, 1), (2, 1, 2), (3, 1, 3)]
    path = public_tokenizers.path(tokens.TOKENIZER)
    library = Tokenizer.from_file(path)
    coder = tokens.Encoder(path)
    for column in (pa.array([one, two]), pa.array([two]), pa.array([two, one])):
        got = [x.tolist() for ids, counts in coder.column(column) for x in np.split(ids, np.cumsum(counts)[:-1])]
        assert got == [e.ids for e in library.encode_batch(column.to_pylist(), add_special_tokens=False)]
    rows = {r.doc_id: r for r in quality_rules.judge(docs, np.zeros(1 << 16)).collect()}
    assert rows[3].n_dup_lines == 0


def test_equal_hashes_are_told_apart_by_bytes(monkeypatch):
    """With a hash of two values almost all pre-tokens meet under one, within a slice and with remembered ones; the ids stay the library's."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(tokens.TOKENIZER)
    library, coder = Tokenizer.from_file(path), tokens.Encoder(path)
    monkeypatch.setattr(kernels, "word_hashes", lambda words, counts, sizes: sizes.astype(np.uint64) % np.uint64(2))
    for text in ("the house", "a", "b", "the house is green and so is the river", "!", "houses"):
        (ids, counts), = coder.column(pa.array([text]))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids and counts.sum() == len(ids)


def test_hashes_see_place_length_and_every_byte():
    r = random.Random(1)
    words = {"".join(r.choice("ab") for _ in range(r.randrange(1, 40))) for _ in range(20000)} | {"a" * n for n in range(1, 400)} | {"\0" * n for n in range(1, 40)}
    words = sorted(words)
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    begins = np.concatenate([[0], ends[:-1]])
    hashes = kernels.span_hashes(data, begins, ends)
    assert len(set(hashes.tolist())) == len(words)
    some = np.array(sorted(r.sample(range(len(words)), 500)))
    assert np.array_equal(kernels.span_hashes(data, begins[some], ends[some]), hashes[some])


def jwt(header):
    import base64

    return base64.urlsafe_b64encode(header.encode()).decode().rstrip("=") + ".payload.signature"


def test_secrets_in_hostile_texts(spark):
    deep = jwt('{"a":' + "[" * 200_000)
    long_number = jwt('{"alg":' + "1" * 20_000 + "}")
    good = jwt('{"alg":"HS256"}')
    texts = [deep, long_number, good, "eyJ" * 350_000, "-----BEGIN PRIVATE KEY-----\n" * 36_000, "-----BEGIN PRIVATE KEY-----\nabc\n" + "-----END RSA PRIVATE KEY-----\n" * 30_000 + "-----END PRIVATE KEY-----",
             "é 0123456789abcdef " * 50_000, "token " * 150_000, "-----BEGIN " * 90_000, "eyJ" + good, None, "", "".join(f"-----BEGIN {'A' * i}PRIVATE KEY-----" for i in range(1400))]
    began = time.time()
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.found] for r in secrets.scan(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()}
    assert time.time() - began < 40
    assert not any(k == "jwt" for k, _, _ in got[0] + got[1] + got[3]) and got[2] == [("jwt", 0, len(good))]
    assert got[4] == got[7] == got[8] == got[10] == got[11] == got[12] == []
    assert got[5] == [("pem", 0, len(texts[5]))]
    assert got[6][:2] == [("hex", 2, 18), ("hex", 21, 37)] and len(got[6]) == 50_000


def test_private_keys_end_at_their_own_label():
    key = "-----BEGIN RSA PRIVATE KEY-----\nMIIE+/=\n-----END RSA PRIVATE KEY-----"
    assert secrets.keyword_spans(f"x {key} y") == [(2, 2 + len(key), "pem")]
    assert secrets.keyword_spans(key.replace("END RSA", "END EC")) == []
    assert secrets.keyword_spans(key.replace("MIIE", "MI(E")) == []
    inner = "-----BEGIN EC PRIVATE KEY-----\n" + key
    assert secrets.keyword_spans(inner) == [(31, 31 + len(key), "pem")]


def page_entry(data, tag):
    (at,) = struct.unpack_from("<I", data, 4)
    (n,) = struct.unpack_from("<H", data, at)
    return next(at + 2 + 12 * i for i in range(n) if struct.unpack_from("<H", data, at + 2 + 12 * i)[0] == tag)


def test_damaged_and_swelling_images(spark):
    page = np.zeros((4, 4), np.uint8)
    none = bytearray(tiff.encode([page]))
    struct.pack_into("<H", none, page_entry(none, 277) + 8, 0)
    huge = bytearray(tiff.encode([page], rows_per_strip=4))
    struct.pack_into("<I", huge, page_entry(huge, 256) + 8, 1 << 31)
    bomb = bytearray(tiff.encode([page], tiff.NONE))
    packed = zlib.compress(bytes(200 << 20))
    struct.pack_into("<I", bomb, page_entry(bomb, 273) + 8, len(bomb))
    struct.pack_into("<I", bomb, page_entry(bomb, 279) + 8, len(packed))
    struct.pack_into("<H", bomb, page_entry(bomb, 259) + 8, tiff.DEFLATE)
    bomb += packed
    began = time.time()
    rows = spark.createDataFrame([(0, none), (1, huge), (2, bomb), (3, bytearray(tiff.encode([page])[:-30])), (4, bytearray(b"MM\0*"))], "id long, media binary")
    got = {r.id: r for r in media.tiff_pages(rows, keep=("id",)).collect()}
    assert time.time() - began < 20
    assert got[0].error and got[1].error and got[3].error and got[4].error
    assert got[2].error is None and got[2].samples == bytes(16)
    assert media.tiff_pages(rows.limit(0), keep=("id",)).count() == 0


@pytest.mark.parametrize("order", "<>")
@pytest.mark.parametrize("kind", [np.uint8, np.uint16])
def test_byte_orders_and_depths(order, kind):
    r = np.random.default_rng(5)
    page = r.integers(0, np.iinfo(kind).max, (37, 29), dtype=kind)
    for compression in (tiff.NONE, tiff.LZW, tiff.DEFLATE, tiff.PACKBITS):
        for predictor in (1, 2):
            for tile in (None, (16, 16)):
                (got,) = tiff.decode(tiff.encode([page], compression, predictor, tile, 5, order))
                assert np.array_equal(got["image"][:, :, 0], page) and got["bits"] == page.dtype.itemsize * 8


def test_layouts_are_dealt_evenly():
    r = random.Random(2)
    seen = [next(tiff.decode(media.stored(media.payload(str(r.random()).encode())))) for _ in range(800)]
    for field, least in (("compression", 150), ("predictor", 300), ("tiled", 300)):
        counts = {v: sum(p[field] == v for p in seen) for v in {p[field] for p in seen}}
        assert len(counts) == (4 if field == "compression" else 2) and min(counts.values()) > least


def test_names_that_clash(spark):
    """Work columns' names may stand in the input; they are kept where the operator keeps columns."""
    base = " ".join(f"word{i}" for i in range(60))
    names = ["_kept_id", "_kept_mark", "mark", "cls", "root", "label", "n", "block", "data", "_row", "_copy", "_n", "taken", "edge_key", "key", "_trusted", "stratum", "is_target", "_id", "bucket", "salt", "whole", "rest", "rank"]
    rows = [(1, base, "a", *range(len(names))), (2, base.replace("word30", "x"), "a", *range(len(names))), (3, "other text here", None, *range(len(names))), (4, None, "b", *range(len(names)))]
    docs = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", "source string", *[f"{n} long" for n in names]]))
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert sorted(r.doc_id for r in ngram_join.distinct_documents(docs).collect()) == [1, 3, 4]
    for out in (ngram_join.distinct_documents(docs), quality_classifier.keep(docs, labels), secrets.redact(docs), mixing.mix(docs)):
        assert out.columns == docs.columns and out.count() > 0
        assert {tuple(r[3:]) for r in out.collect()} == {tuple(range(len(names)))}
    assert packing.pack(docs).count() == 4


def test_token_files_of_empty_and_hot_tables(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(tokens.TOKENIZER)
    library = Tokenizer.from_file(path)
    empty = spark.createDataFrame([], SCHEMA)
    folder = f"file://{tmp_path}/none"
    assert tokens.read_parts(tokens.write_parts(empty, path, folder), folder).count() == 0
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, null, if(id % 3 = 1, 7, id)) as doc_id", "concat('text ', id) as text")
    folder = f"file://{tmp_path}/hot"
    rows = sorted(tokens.read_parts(tokens.write_parts(docs, path, folder), folder).collect(), key=lambda r: r.start)
    assert [r.start for r in rows] == np.concatenate([[0], np.cumsum([r.n_tokens for r in rows])[:-1]]).tolist()
    assert [r.doc_id is not None for r in rows] == sorted(r.doc_id is not None for r in rows) and len(rows) == 3000
    crc = lambda t: zlib.crc32(np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes())
    assert sorted(r.ids_crc32 for r in rows) == sorted(crc(r.text) for r in docs.collect())


def test_hot_keys_are_spread_and_join_alike(spark, monkeypatch):
    """The joins give what a plain join gives, with hot keys, null keys and keys without a partner."""
    from helixframe.llm import common

    rows = spark.range(6000).selectExpr("case when id % 3 = 0 then 7 when id % 3 = 1 then null when id % 5 = 0 then id else 8 end as k", "id as a")
    other = spark.range(0, 6000, 2).selectExpr("id as k", "id * 10 as v").unionByName(spark.createDataFrame([(7, 1)], "k long, v long"))
    assert common.hot_keys(rows, "k") == [7, 8] or sorted(common.hot_keys(rows, "k")) == [7, 8]
    key = lambda df: sorted((tuple(r) for r in df.select("k", "a", "v").collect()), key=str)
    for how in ("inner", "left"):
        assert key(common.joined_by_key(rows, other, "k", how)) == key(rows.join(other, "k", how))
    assert key(common.joined_by_salted_key(rows, other, "k", "a")) == key(rows.join(other, "k"))


def test_join_of_one_large_group_of_near_copies(spark):
    """A hub of hundreds of near copies, exact copies of one of them, and others: one component each."""
    r = random.Random(9)
    words = [f"w{i}" for i in range(90)]
    texts = [" ".join(words)] * 300
    for _ in range(400):
        copy = list(words)
        copy[r.randrange(len(copy))] = f"z{r.random()}"
        texts.append(" ".join(copy))
    texts += [" ".join(f"{i}v{j}" for j in range(40)) for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    got = {x.doc_id: x.component_id for x in ngram_join.components(docs).collect()}
    assert got == {i: 0 if i < 700 else i for i in range(1000)}
    assert ngram_join.distinct_documents(docs).count() == 301
