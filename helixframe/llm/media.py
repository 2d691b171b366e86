"""Media columns: TIFF files in a binary column become one row per page.

tiff_pages() is the operator. The query stores each text as a TIFF, reads it back
through the operator and digests what it read.

Edge cases: a null value, or bytes that are no readable TIFF, gives one row with a null
page number (0 pages read; damaged tables, no samples per pixel, data that end early, a page beyond 2 GB) and the reason in error, after the pages that could be read; a file without pages gives one such row
too; repeated rows are read each; an empty table gives an empty result; further
columns are carried along if named.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm import kernels as K
from helixframe.llm import tiff
from helixframe.llm.common import documents, importable

#: Payloads are padded to a multiple of this many bytes, the width of a page.
WIDTH = 576
PAD = 255
#: Rows of a page; longer payloads take more pages.
PAGE_ROWS = 256

PAGE = "page int, width int, height int, bits int, samples_per_pixel int, compression string, predictor int, tiled boolean, samples binary, error string"
_PAGE_FIELDS = [("page", pa.int32()), ("width", pa.int32()), ("height", pa.int32()), ("bits", pa.int32()), ("samples_per_pixel", pa.int32()), ("compression", pa.string()), ("predictor", pa.int32()), ("tiled", pa.bool_()), ("samples", pa.binary()), ("error", pa.string())]
#: Samples gathered before a batch of pages is handed on.
_BATCH_BYTES = 4 << 20


def pages_of(data: bytes | None) -> Iterator[dict]:
    """The page rows of one value."""
    n = 0
    try:
        if data is None:
            raise tiff.TiffError("null")
        for n, page in enumerate(tiff.decode(data), 1):
            image = page.pop("image")
            yield page | {"page": n - 1, "samples": image.tobytes(), "error": None}
        if not n:
            raise tiff.TiffError("no pages")
    except tiff.TiffError as e:
        yield dict.fromkeys([name for name, _ in _PAGE_FIELDS]) | {"error": str(e)}


def tiff_pages(df: DataFrame, media: str = "media", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per page of each value of a binary column; a value's pages follow each other in order."""
    importable(df.sparkSession)
    source = df.select(*keep, F.col(media).cast("binary").alias("_media"))
    n = len(keep)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where: list[int] = []
            found: list[dict] = []
            held = 0

            def made() -> pa.RecordBatch:
                kept = [batch.column(i).take(pa.array(where, pa.int64())) for i in range(n)]
                columns = [pa.array([p[name] for p in found], kind) for name, kind in _PAGE_FIELDS]
                return pa.RecordBatch.from_arrays([*kept, *columns], [*keep, *[name for name, _ in _PAGE_FIELDS]])

            for i in range(batch.num_rows):
                for page in pages_of(batch.column(n)[i].as_py()):
                    where.append(i)
                    found.append(page)
                    held += len(page["samples"] or b"")
                    if held > _BATCH_BYTES:
                        yield made()
                        where, found, held = [], [], 0
            if found:
                yield made()

    head = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields[:n])
    return source.mapInArrow(rows, head + PAGE)


def payload(text: bytes) -> bytes:
    return text + bytes([PAD]) * (WIDTH - len(text) % WIDTH if len(text) % WIDTH or not text else 0)


def stored(data: bytes) -> bytes:
    """The payload as a TIFF. The layout follows from its bytes; all compressions, strips and tiles, predictors and byte orders are dealt alike."""
    rows = np.frombuffer(data, np.uint8).reshape(-1, WIDTH)
    pages = [rows[y : y + PAGE_ROWS] for y in range(0, len(rows), PAGE_ROWS)]
    plan = zlib.crc32(data)
    compression = (tiff.NONE, tiff.PACKBITS, tiff.LZW, tiff.DEFLATE)[plan % 4]
    return tiff.encode(pages, compression, 1 + plan // 4 % 2, (16, 192) if plan // 8 % 2 else None, order="<>"[plan // 16 % 2])


def store(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media) of every row: its text as a TIFF."""
    importable(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, at in K.text_slices(batch.column(1), _BATCH_BYTES):
                media = [stored(payload(data[at[i] : at[i + 1]].tobytes())) for i in range(high - low)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(np.diff(at)), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rows, "doc_id long, n_bytes long, media binary")


DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def digest(pages: DataFrame) -> DataFrame:
    """One row per stored document, from the rows of its pages as tiff_pages() leaves them."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in DIGEST.split(", ")]
        kinds = [pa.int64()] * 3 + [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        now: dict = {}

        def finished() -> dict:
            share = now["levels"] / now["length"]
            entropy = float(-(share[share > 0] * np.log2(share[share > 0])).sum())
            mean = float((share * np.arange(256)).sum())
            return now["head"] | {"payload_bytes": now["length"], "payload_sha256": now["sha"].hexdigest(), "tail_crc32": zlib.crc32(now["tail"]), "feature": f"pages={now['pages']};mean={mean:.4f};entropy={entropy:.4f};edges={now['edges'] / now['length']:.4f}"}

        for batch in batches:
            done = []
            for i in range(batch.num_rows):
                # One page at a time: a batch's pixels are not copied together.
                r = {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns, strict=True)}
                if r["error"] is not None:
                    raise ValueError(f"document {r['doc_id']}: {r['error']}")
                if r["page"] == 0:
                    if now:
                        done.append(finished())
                    now = {"head": {k: r[k] for k in ("doc_id", "n_bytes", "media_bytes", "media_sha256")}, "length": 0, "sha": hashlib.sha256(), "tail": b"", "levels": np.zeros(256, np.int64), "edges": 0, "pages": 0}
                data = r["samples"]
                x = np.frombuffer(data, np.uint8)
                now["length"] += len(data)
                now["sha"].update(data)
                now["tail"] = (now["tail"] + data)[-32:]
                now["levels"] += np.bincount(x, minlength=256)
                now["edges"] += int(np.count_nonzero(np.abs(np.diff(x.astype(np.int16))) > 16))
                now["pages"] += 1
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[c] for d in done], k) for c, k in zip(names, kinds, strict=True)], names)
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([finished()[c]], k) for c, k in zip(names, kinds, strict=True)], names)

    return pages.mapInArrow(rows, DIGEST)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = store(documents(spark, sf_dir))
    media = media.select("doc_id", "n_bytes", F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "media")
    return digest(tiff_pages(media, keep=("doc_id", "n_bytes", "media_bytes", "media_sha256")))
