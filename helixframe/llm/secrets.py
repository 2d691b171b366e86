"""Secret scan: keyword prefilter, anchored expressions near hits, checksum validation.

One Aho-Corasick pass over the lower-cased text finds the keywords with which
all kinds but one begin; an expression is then matched only at a hit, anchored
there.  The kind without a keyword, long hexadecimal runs, is prefiltered by a
vectorised search for runs.  Kinds with an embedded checksum are reported only
if it holds.  Whole texts are scanned.

Base kinds: assign (a password-like name, a separator and a value of 12 characters
or more), access (AKIA and upper-case letters or digits, 18 characters or more), hex
(16 hexadecimal digits or more).  Added kinds: github and npm (prefix, 30
characters, and their CRC-32 in 6 base-62 digits), jwt (three base64url parts of which
the first decodes to a JSON object with "alg"), pem (a private-key block).

Work is linear in the text, whatever it holds: a run of base64url letters is tried for a jwt once, from the first
eyJ in it; the ends of private-key blocks and the letters that cannot stand in one are found in one pass each; a header
that no JSON parser takes (too deep, too long a number) fails the check.

Spans are in code points, end exclusive, leftmost and non-overlapping per kind.
Edge cases: a null or empty text has no spans; repeated rows are scanned each; an
empty table gives an empty result; further columns are ignored by scan() and kept
by redact().
"""

from __future__ import annotations

import base64
import binascii
import bisect
import json
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm import kernels as K
from helixframe.llm.common import documents, importable

#: Kinds in the order in which spans of one start are listed.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm", "jwt", "pem")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
CHECKED = re.compile(r"(gh[pousr]_|npm_)([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
JWT = re.compile(r"(eyJ[A-Za-z0-9_-]+)(?:\.[A-Za-z0-9_-]+(\.[A-Za-z0-9_-]+)?)?")
PEM_BEGIN = re.compile(r"-----BEGIN ([A-Z ]*)PRIVATE KEY-----")
PEM_END = re.compile(r"-----END ([A-Z ]*)PRIVATE KEY-----")
NOT_PEM = re.compile(r"[^A-Za-z0-9+/=\s:,.-]")

BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62_crc32(text: str) -> str:
    """The CRC-32 of a text in six base-62 digits."""
    value, digits = zlib.crc32(text.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


class _Blocks:
    """The private-key blocks of a text: each begins at a BEGIN line and ends at the next END line of its label, with only PEM's letters between."""

    def __init__(self, text: str, ends: list[int]) -> None:
        self.text, self.clean = text, (0, 0)
        self.ends: dict[str, list[tuple[int, int]]] = {}
        for at in ends:
            if m := PEM_END.match(text, at):
                self.ends.setdefault(m[1], []).append(m.span())

    def end(self, start: int) -> int | None:
        """Where the block that begins at start ends."""
        m = PEM_BEGIN.match(self.text, start)
        if m is None:
            return None
        ends = self.ends.get(m[1], [])
        i = bisect.bisect_left(ends, (m.end(), 0))
        if i == len(ends):
            return None
        # The stretch without other letters that was found last, from and to.
        if not self.clean[0] <= m.end() <= self.clean[1]:
            bad = NOT_PEM.search(self.text, m.end())
            self.clean = (m.end(), bad.start() if bad else len(self.text))
        return ends[i][1] if ends[i][0] <= self.clean[1] else None


def _checked(m: re.Match) -> bool:
    return base62_crc32(m[2]) == m[3]


def _json_header(m: re.Match) -> bool:
    try:
        head = json.loads(base64.urlsafe_b64decode(m[1] + "=" * (-len(m[1]) % 4)))
    except (ValueError, binascii.Error, RecursionError):
        return False
    return isinstance(head, dict) and "alg" in head


#: Keyword (lower case) to rule: (kind, expression, what a match has to pass).
_RULES = {
    **dict.fromkeys(("password", "passwd", "secret", "token", "apikey", "api_key"), ("assign", ASSIGN, lambda m: len(m[2]) >= 12)),
    "akia": ("access", ACCESS, lambda m: len(m[0]) >= 18),
    **dict.fromkeys(("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), ("github", CHECKED, _checked)),
    "npm_": ("npm", CHECKED, _checked),
    "eyj": ("jwt", JWT, lambda m: m[2] is not None and _json_header(m)),
    "-----begin ": ("pem", PEM_BEGIN, lambda m: True),
    "-----end ": ("pem", PEM_END, lambda m: False),
}


def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for word in _RULES:
        a.add_word(word, word)
    a.make_automaton()
    return a


_built: list[ahocorasick.Automaton] = []


def keyword_spans(text: str) -> list[tuple[int, int, str]]:
    """The spans of all kinds but hex."""
    if not _built:
        _built.append(_automaton())
    low = text.lower()
    if len(low) != len(text):  # a capital I with dot becomes two characters
        low = text.replace("İ", "i").lower()
    hits = [(end - len(word) + 1, word) for end, word in _built[0].iter(low)]
    if not hits:
        return []
    spans, past, blocks = [], dict.fromkeys(KINDS, 0), None
    for start, word in sorted(hits):
        kind, pattern, passes = _RULES[word]
        if start < past[kind]:
            continue
        if kind == "pem":
            if blocks is None:
                blocks = _Blocks(text, [at for at, w in hits if w == "-----end "])
            if word == "-----begin " and (end := blocks.end(start)) is not None:
                past[kind] = end
                spans.append((start, end, kind))
        elif m := pattern.match(text, start):
            good = passes(m)
            # As a plain left-to-right search would, a base match moves on even if it then fails the length.
            if kind in BASE_KINDS or good:
                past[kind] = m.end()
            elif kind == "jwt":
                past[kind] = m.end(1)
            if good:
                spans.append((start, m.end(), kind))
    return spans


HEX = np.zeros(256, bool)
HEX[list(b"0123456789abcdef")] = True


def column_spans(column: pa.Array) -> Iterator[list[tuple[int, int, str]]]:
    """The spans of each row of a string column, sorted by start, then kind."""
    for low, high, data, at in K.text_slices(column):
        begins, ends = K.runs(HEX[data], at)
        long = ends - begins >= 16
        begins, ends = begins[long], ends[long]
        row = np.searchsorted(at, begins, side="right") - 1
        found: dict[int, list] = {}
        if len(begins):
            lead = np.zeros(len(data) + 1, np.int64)
            np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
            before = lead[begins] - lead[at[row]]
            for r, b, n in zip(row.tolist(), before.tolist(), (ends - begins).tolist(), strict=True):
                found.setdefault(r, []).append((b, b + n, "hex"))
        for r, text in enumerate(column.slice(low, high - low).to_pylist()):
            spans = (keyword_spans(text) if text else []) + found.get(r, [])
            spans.sort(key=lambda s: (s[0], KINDS.index(s[2])))
            yield spans


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


SPANS = "array<struct<kind:string,start:int,end:int>>"


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, found) of every row; found lists (kind, start, end)."""
    importable(docs.sparkSession)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"kind": k, "start": s, "end": e} for s, e, k in spans] for spans in column_spans(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["doc_id", "found"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rows, f"doc_id long, found {SPANS}")


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each stretch of overlapping spans replaced by [secret]."""
    out, past = [], 0
    merged: list[list[int]] = []
    for start, end, _ in spans:
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    for start, end in merged:
        out += [text[past:start], "[secret]"]
        past = end
    return "".join([*out, text[past:]])


def redact(docs: DataFrame) -> DataFrame:
    """All rows and columns of docs, with secrets replaced in text and n_chars, where there, set to the new length."""
    importable(docs.sparkSession)
    at = docs.columns.index("text")
    length = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            changed = {r: redacted(batch.column(at)[r].as_py(), spans) for r, spans in enumerate(column_spans(batch.column(at))) if spans}
            columns = list(batch.columns)
            if changed:
                columns[at] = pa.array([changed.get(r, t) for r, t in enumerate(batch.column(at).to_pylist())], batch.schema.field(at).type)
                if length is not None:
                    columns[length] = pa.array([len(changed[r]) if r in changed else n for r, n in enumerate(batch.column(length).to_pylist())], batch.schema.field(length).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(rows, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir))
    of = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("found", lambda s: s["kind"].isin(*BASE_KINDS))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"), F.sha2(of(base), 256).alias("base_sha256"), of(F.col("found")).alias("spans"))


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)
