"""TIFF: a writer of 8- and 16-bit grey pages and a reader of strips and tiles.

The reader walks the chain of image directories of classic TIFF in either byte
order, decodes uncompressed, PackBits, LZW and deflate data in strips or tiles, and
undoes horizontal differencing of 8- and 16-bit samples.  No strip or tile is decoded beyond the bytes
that its page has room for, so that a small file cannot swell to more than its pages' claimed size.
A page of more than MOST_BYTES is an error: no binary value of Spark or Arrow could hold its samples.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
NAMES = {NONE: "none", LZW: "lzw", DEFLATE: "deflate", OLD_DEFLATE: "deflate", PACKBITS: "packbits"}
#: Bytes of a value of each TIFF field type that the reader needs.
_TYPES = {1: "B", 3: "H", 4: "I"}
#: The most bytes of a binary value.
MOST_BYTES = (1 << 31) - 16


class TiffError(ValueError):
    """The bytes are not a TIFF that can be read."""


def packbits_encode(data: bytes) -> bytes:
    """Runs of 3 equal bytes or more become repeats, the rest literals."""
    if not data:
        return b""
    x = np.frombuffer(data, np.uint8)
    edge = np.flatnonzero(np.diff(x)) + 1
    begins = np.concatenate([[0], edge])
    ends = np.concatenate([edge, [len(x)]])
    long = ends - begins >= 3
    out, past = bytearray(), 0

    def literal(upto: int) -> None:
        for i in range(past, upto, 128):
            part = data[i : min(i + 128, upto)]
            out.append(len(part) - 1)
            out.extend(part)

    for b, e in zip(begins[long].tolist(), ends[long].tolist(), strict=True):
        literal(b)
        for i in range(b, e, 128):
            n = min(128, e - i)
            out.append((1 - n) & 255 if n > 1 else 0)
            out.append(data[b])
        past = e
    literal(len(data))
    return bytes(out)


def packbits_decode(data: bytes, most: int | None = None) -> bytes:
    """Decode until there are most bytes, where given."""
    out, i, n = bytearray(), 0, len(data)
    while i < n and (most is None or len(out) < most):
        head = data[i]
        i += 1
        if head < 128:
            out += data[i : i + head + 1]
            i += head + 1
        elif head > 128:
            if i >= n:
                raise TiffError("PackBits data end within a run")
            out += data[i : i + 1] * (257 - head)
            i += 1
    return bytes(out)


_CLEAR, _END, _FIRST = 256, 257, 258


def lzw_encode(data: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits, most significant bit first, widths changing one code early."""
    out = bytearray()
    acc, held, width = _CLEAR, 9, 9
    table: dict = {}
    size, prefix = _FIRST, -1
    for byte in data:
        if prefix < 0:
            prefix = byte
            continue
        key = (prefix << 8) | byte
        code = table.get(key)
        if code is not None:
            prefix = code
            continue
        acc = (acc << width) | prefix
        held += width
        while held >= 8:
            held -= 8
            out.append(acc >> held & 255)
        acc &= (1 << held) - 1
        table[key] = size
        size += 1
        if size == 4094:
            acc = (acc << width) | _CLEAR
            held += width
            table, size, width = {}, _FIRST, 9
        elif size + 1 > (1 << width):
            width += 1
        prefix = byte
    if prefix >= 0:
        acc = (acc << width) | prefix
        held += width
        size += 1
        if size + 1 > (1 << width) and width < 12:
            width += 1
    acc = (acc << width) | _END
    held += width
    pad = -held % 8
    acc <<= pad
    held += pad
    while held >= 8:
        held -= 8
        out.append(acc >> held & 255)
    return bytes(out)


def lzw_decode(data: bytes, most: int | None = None) -> bytes:
    """Decode up to most bytes, where given."""
    first = [bytes([i]) for i in range(256)] + [b"", b""]
    table = list(first)
    out: list[bytes] = []
    acc = held = made = 0
    width, last = 9, b""
    for byte in data:
        acc = (acc << 8) | byte
        held += 8
        if held < width:
            continue
        held -= width
        code = acc >> held
        acc &= (1 << held) - 1
        if code == _CLEAR:
            table, width, last = list(first), 9, b""
            continue
        if code == _END:
            break
        if not last:
            if code > 255:
                raise TiffError("LZW data begin with a code that has no entry")
            entry = first[code]
        else:
            if code < len(table):
                entry = table[code]
            elif code == len(table):
                entry = last + last[:1]
            else:
                raise TiffError("LZW code beyond the table")
            table.append(last + entry[:1])
            if len(table) + 1 >= (1 << width) and width < 12:
                width += 1
        out.append(entry)
        last = entry
        made += len(entry)
        if most is not None and made >= most:
            break
    return b"".join(out)


def _difference(rows: np.ndarray) -> np.ndarray:
    """Horizontal differencing of (height, width, samples)."""
    out = rows.copy()
    out[:, 1:] -= rows[:, :-1]
    return out


def _compress(block: bytes, compression: int) -> bytes:
    if compression == DEFLATE:
        return zlib.compress(block, 1)
    if compression == LZW:
        return lzw_encode(block)
    return packbits_encode(block) if compression == PACKBITS else block


def encode(pages: list[np.ndarray], compression: int = DEFLATE, predictor: int = 1, tile: tuple[int, int] | None = None, rows_per_strip: int = 64, order: str = "<") -> bytes:
    """A TIFF of grey pages, each a height x width array of 8 or 16 bits; order: little (<) or big-endian (>)."""
    out = bytearray(b"II*\0\0\0\0\0" if order == "<" else b"MM\0*\0\0\0\0")
    link = 4
    for page in pages:
        height, width = page.shape
        blocks = []
        if tile:
            th, tw = tile
            padded = np.zeros((-(-height // th) * th, -(-width // tw) * tw), page.dtype)
            padded[:height, :width] = page
            parts = [padded[y : y + th, x : x + tw] for y in range(0, height, th) for x in range(0, width, tw)]
        else:
            parts = [page[y : y + rows_per_strip] for y in range(0, height, rows_per_strip)]
        for part in parts:
            part = _difference(part[:, :, None]) if predictor == 2 else part
            blocks.append(_compress(part.astype(page.dtype.newbyteorder(order)).tobytes(), compression))
        offsets = []
        for block in blocks:
            offsets.append(len(out))
            out += block
            out += b"\0" * (len(out) % 2)
        n = len(blocks)

        def many(values: list[int]) -> int:
            if len(values) == 1:
                return values[0]
            where = len(out)
            out.extend(struct.pack(f"{order}{len(values)}I", *values))
            return where

        at_offsets, at_counts = many(offsets), many([len(b) for b in blocks])
        entries = [(256, 4, 1, width), (257, 4, 1, height), (258, 3, 1, 8 * page.dtype.itemsize), (259, 3, 1, compression), (262, 3, 1, 1), (277, 3, 1, 1), (317, 3, 1, predictor)]
        if tile:
            entries += [(322, 4, 1, tile[1]), (323, 4, 1, tile[0]), (324, 4, n, at_offsets), (325, 4, n, at_counts)]
        else:
            entries += [(273, 4, n, at_offsets), (278, 4, 1, rows_per_strip), (279, 4, n, at_counts)]
        entries.sort()
        struct.pack_into(f"{order}I", out, link, len(out))
        out += struct.pack(f"{order}H", len(entries))
        for tag, kind, count, value in entries:
            out += struct.pack(f"{order}HHII", tag, kind, count, value) if kind == 4 or count > 1 else struct.pack(f"{order}HHIHH", tag, kind, count, value, 0)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def _directory(data: bytes, order: str, at: int) -> tuple[dict[int, list[int]], int]:
    try:
        (count,) = struct.unpack_from(f"{order}H", data, at)
        tags = {}
        for i in range(count):
            place = at + 2 + 12 * i
            tag, kind, n = struct.unpack_from(f"{order}HHI", data, place)
            if kind not in _TYPES:
                continue
            code = _TYPES[kind]
            if n * struct.calcsize(code) > len(data):
                raise TiffError(f"tag {tag} has more values than the file has bytes")
            where = place + 8
            if n * struct.calcsize(code) > 4:
                (where,) = struct.unpack_from(f"{order}I", data, where)
            tags[tag] = list(struct.unpack_from(f"{order}{n}{code}", data, where))
        (following,) = struct.unpack_from(f"{order}I", data, at + 2 + 12 * count)
    except struct.error as e:
        raise TiffError(f"directory at {at} is cut off") from e
    return tags, following


def _block(data: bytes, compression: int, size: int) -> bytes:
    if compression == NONE:
        out = data
    elif compression == PACKBITS:
        out = packbits_decode(data, size)
    elif compression == LZW:
        out = lzw_decode(data, size)
    elif compression in (DEFLATE, OLD_DEFLATE):
        try:
            out = zlib.decompressobj().decompress(data, size)
        except zlib.error as e:
            raise TiffError(f"deflate data: {e}") from e
    else:
        raise TiffError(f"compression {compression} is not supported")
    if len(out) < size:
        raise TiffError("a strip or tile holds too few bytes")
    return out[:size]


def _page(data: bytes, order: str, tags: dict[int, list[int]]) -> dict:
    one = lambda tag, default=None: tags[tag][0] if tags.get(tag) else default
    width, height = one(256), one(257)
    bits, samples = one(258, 1), one(277, 1)
    compression, predictor = one(259, 1), one(317, 1)
    if not width or not height or not samples or bits not in (8, 16) or one(284, 1) != 1 or len(set(tags.get(258, [8]))) > 1:
        raise TiffError(f"unsupported layout: {width} x {height}, {bits} bits, planar {one(284, 1)}")
    if predictor not in (1, 2):
        raise TiffError(f"predictor {predictor} is not supported")
    if width * height * samples * bits // 8 > MOST_BYTES:
        raise TiffError("a page of more bytes than a binary value holds")
    kind = np.dtype(np.uint8) if bits == 8 else np.dtype(np.uint16).newbyteorder(order)
    tiled = 322 in tags
    bw, bh = (one(322), one(323)) if tiled else (width, min(one(278, height), height))
    offsets, counts = (tags.get(324), tags.get(325)) if tiled else (tags.get(273), tags.get(279))
    if not bw or not bh or not offsets or not counts or len(offsets) != len(counts):
        raise TiffError("strip or tile tables are missing")
    if bw * bh * samples * bits // 8 > MOST_BYTES:
        raise TiffError("a tile of more bytes than a binary value holds")
    across, down = -(-width // bw), -(-height // bh)
    if len(offsets) < across * down:
        raise TiffError("strips or tiles are missing")
    image = np.zeros((height, width, samples), kind.newbyteorder("="))
    for i in range(across * down):
        y, x = i // across * bh, i % across * bw
        rows = bh if tiled else min(bh, height - y)
        raw = _block(data[offsets[i] : offsets[i] + counts[i]], compression, rows * bw * samples * kind.itemsize)
        part = np.frombuffer(raw, kind).reshape(rows, bw, samples).astype(image.dtype)
        if predictor == 2:
            part = np.cumsum(part, axis=1, dtype=image.dtype)
        image[y : y + rows, x : x + bw] = part[: height - y, : width - x]
    return {"width": width, "height": height, "bits": bits, "samples_per_pixel": samples, "compression": NAMES[compression], "predictor": predictor, "tiled": tiled, "image": image}


def decode(data: bytes) -> Iterator[dict]:
    """The pages in the order of the directory chain; raises TiffError where the bytes make no sense."""
    if len(data) < 8 or data[:4] not in (b"II*\0", b"MM\0*"):
        raise TiffError("not a classic TIFF")
    order = "<" if data[:2] == b"II" else ">"
    (at,) = struct.unpack_from(f"{order}I", data, 4)
    seen = set()
    while at:
        if at in seen:
            raise TiffError("the directories form a circle")
        seen.add(at)
        tags, at = _directory(data, order, at)
        yield _page(data, order, tags)
