"""GIF images as columns: LZW code streams, palettes, disposal, transparency, timed frames and colour histograms.

encode_gif() writes frames of 8-bit samples as GIF89a with an LZW code stream; decode_gif() reads any GIF: interlaced or not, local
or global palettes, transparent colours, and the disposal methods 0 to 3, composited frame by frame. Damaged or
truncated files raise ValueError in decode_gif(); decoded() turns them into a null image with the error beside it.

as_gif() stores a payload losslessly: WIDTH samples a row, ROWS rows a frame, an identity grey palette, so a sample is its colour.
The payload read back is the composited frames' red channel. All rows are independent: there is no shuffle, and memory is bounded by
the largest single payload. Null texts are empty texts; equal texts give equal rows; repeated rows stay; other columns are not
looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import offsets_and_bytes

WIDTH, ROWS, DELAY, BINS = 64, 1024, 10, 8
_GREY = bytes(v for i in range(256) for v in (i, i, i))


@dataclass
class Frame:
    """What is on the canvas while a frame shows: its delay in hundredths of a second and rows x columns x RGBA."""

    delay: int
    rgba: np.ndarray


def lzw_encode(data: bytes, bits: int = 8) -> bytes:
    """The code stream of data: variable code lengths up to 12 bits, a clear code first and whenever the table is full.

    Codes are kept times 256 in the loop, so that a table key is a sum of code and sample."""
    clear = 1 << bits
    codes, stops = [clear << 8], []
    put, table, free, full = codes.append, {}, clear + 2 << 8, 4096 << 8
    find, shifted = table.get, [i << 8 for i in range(256)]
    if data:
        p = shifted[data[0]]
        for c in data[1:]:
            if q := find(key := p + c):
                p = q
                continue
            put(p)
            p = shifted[c]
            if free < full:
                table[key] = free
                free += 256
            else:
                put(clear << 8)
                stops.append(len(codes))
                table.clear()
                free = clear + 2 << 8
        put(p)
    put(clear + 1 << 8)
    return _packed(np.array(codes) >> 8, stops, bits)


def _lengths(n: int, bits: int) -> np.ndarray:
    """Bits of the 1st, 2nd, ... code after a clear code. The decoder's table has clear + 1 + k entries when it reads code k."""
    free = (1 << bits) + 1 + np.arange(n)
    return np.clip(np.floor(np.log2(np.maximum(free, 1))).astype(np.int64) + 1, bits + 1, 12)


_LENGTHS = {bits: _lengths(4100, bits) for bits in range(1, 9)}
_STARTS = {bits: np.concatenate([[0], np.cumsum(x)]) for bits, x in _LENGTHS.items()}


def _packed(codes: np.ndarray, stops: list[int], bits: int) -> bytes:
    size = np.full(len(codes), bits + 1)
    a = 1
    for b in [*stops, len(codes)]:  # the clear code that ends a run still has the run's length
        size[a:b] = _LENGTHS[bits][: b - a]
        a = b
    at = np.cumsum(size)
    total = (int(at[-1]) + 7) // 8
    at -= size
    byte, value = at >> 3, codes << (at & 7)
    out = np.zeros(total + 3)
    for k in range(3):  # codes don't share bits, so the parts of a byte add up
        out[: total + 3] += np.bincount(byte + k, value >> 8 * k & 255, total + 3)[: total + 3]
    return out[:total].astype(np.uint8).tobytes()


def lzw_decode(stream: bytes, bits: int, want: int) -> bytes:
    """At most want samples of a code stream.

    Code lengths follow from the number of codes since the last clear code, so a whole run is unpacked at once. Entry k of a run's
    table is what code k puts out and one sample more, which is contiguous in the output; so lengths, and then samples, are
    resolved by pointer doubling over the run instead of code by code."""
    if not 1 <= bits <= 8:
        raise ValueError("LZW: code size")
    clear, out, have, at, end = 1 << bits, [], 0, 0, len(stream) * 8
    data = np.frombuffer(stream + b"\0\0\0\0", np.uint8).astype(np.uint32)
    quad = data[:-3] | data[1:-2] << np.uint32(8) | data[2:-1] << np.uint32(16)
    while have < want:
        span = _STARTS[bits] + at
        n = int(np.searchsorted(span, end, "right")) - 1
        if n <= 0:
            break
        tail = n == len(_LENGTHS[bits])
        place, size = span[:n], _LENGTHS[bits][:n]
        if tail:  # the table is full: codes of 12 bits go on until a clear code
            more = np.arange(span[n], end - 11, 12)
            place, size = np.concatenate([place, more]), np.concatenate([size, np.full(len(more), 12)])
        codes = ((quad[place >> 3] >> (place & 7).astype(np.uint32)) & ((1 << size) - 1).astype(np.uint32)).astype(np.int64)
        stop = np.flatnonzero((codes == clear) | (codes == clear + 1))
        n = int(stop[0]) if len(stop) else len(codes)
        if n:
            got = _run(codes[:n], clear)
            out.append(got)
            have += len(got)
        if not len(stop) or codes[n] == clear + 1:
            break
        at = int(place[n] + size[n])
    return b"".join(out)[:want]


def _run(codes: np.ndarray, clear: int) -> bytes:
    n = len(codes)
    root = codes < clear
    entry = codes - (clear + 2)  # which earlier code's output this one repeats, with one sample more
    if not root[0] or (entry >= np.minimum(np.arange(n), 4094 - clear))[~root].any():
        raise ValueError("LZW: code beyond the table")
    length, up = np.ones(n, np.int64), np.where(root, np.arange(n), entry)
    length[root] = 0
    while True:  # length: steps up to the root so far
        nxt = up[up]
        if (nxt == up).all():
            break
        length = length + length[up]
        up = nxt
    length += 1
    start = np.cumsum(length) - length
    total = int(start[-1] + length[-1])
    inside = np.arange(total) - np.repeat(start, length)
    of = np.repeat(np.where(root, -1, entry), length)
    source = np.where(of < 0, np.arange(total), start[of] + inside)
    while True:
        nxt = source[source]
        if (nxt == source).all():
            break
        source = nxt
    value = np.repeat(codes, length)
    return value[source].astype(np.uint8).tobytes()


def _blocks(data: bytes) -> bytes:
    return b"".join(bytes([len(data[i : i + 255])]) + data[i : i + 255] for i in range(0, len(data), 255)) + b"\0"


def encode_gif(frames: list[np.ndarray], delay: int = DELAY, palette: bytes = _GREY) -> bytes:
    """frames: rows x columns of uint8 each; the first one's shape is the canvas."""
    rows, cols = frames[0].shape
    out = [b"GIF89a", struct.pack("<HHBBB", cols, rows, 0xF7, 0, 0), palette]
    for f in frames:
        out += [b"\x21\xf9\x04", struct.pack("<BHBB", 1 << 2, delay, 0, 0), b"\x2c", struct.pack("<HHHHB", 0, 0, f.shape[1], f.shape[0], 0), b"\x08", _blocks(lzw_encode(f.tobytes()))]
    return b"".join([*out, b"\x3b"])


def decode_gif(data: bytes) -> list[Frame]:
    if data[:6] not in (b"GIF87a", b"GIF89a") or len(data) < 13:
        raise ValueError("not a GIF")
    cols, rows, flags, _, _ = struct.unpack_from("<HHBBB", data, 6)
    at, common = 13, None
    if flags & 0x80:
        n = 3 << ((flags & 7) + 1)
        common, at = np.frombuffer(data, np.uint8, n, at).reshape(-1, 3), at + n
    canvas = np.zeros((rows, cols, 4), np.uint8)
    frames: list[Frame] = []
    disposal, delay, clear_index = 0, 0, None
    try:
        while True:
            kind = data[at]
            if kind == 0x3B:
                return frames
            if kind == 0x21:
                if data[at + 1] == 0xF9:
                    packed, delay, index = struct.unpack_from("<BHB", data, at + 3)
                    disposal, clear_index = packed >> 2 & 7, index if packed & 1 else None
                at += 2
                while data[at]:
                    at += data[at] + 1
                at += 1
            elif kind == 0x2C:
                x, y, w, h, flags = struct.unpack_from("<HHHHB", data, at + 1)
                at += 10
                palette = common
                if flags & 0x80:
                    n = 3 << ((flags & 7) + 1)
                    palette, at = np.frombuffer(data, np.uint8, n, at).reshape(-1, 3), at + n
                if palette is None:
                    raise ValueError("no palette")
                bits, at, parts = data[at], at + 1, []
                while data[at]:
                    parts.append(data[at + 1 : at + 1 + data[at]])
                    at += data[at] + 1
                at += 1
                got = lzw_decode(b"".join(parts), bits, w * h)
                if len(got) < w * h:
                    raise ValueError("too few samples")
                index = np.frombuffer(got, np.uint8).reshape(h, w)
                if flags & 0x40:
                    order = np.concatenate([np.arange(s, h, d) for s, d in ((0, 8), (4, 8), (2, 4), (1, 2))])
                    index = index[np.argsort(order)]
                before = canvas.copy() if disposal == 3 else None
                area = canvas[y : y + h, x : x + w]
                index = index[: area.shape[0], : area.shape[1]]
                if len(index) and int(index.max(initial=0)) >= len(palette):
                    raise ValueError("sample beyond the palette")
                seen = np.ones(index.shape, bool) if clear_index is None else index != clear_index
                area[seen, :3] = palette[index[seen]]
                area[seen, 3] = 255
                frames.append(Frame(delay, canvas.copy()))
                if disposal == 2:
                    area[:] = 0
                elif before is not None:
                    canvas = before
                disposal, delay, clear_index = 0, 0, None
            else:
                raise ValueError(f"unknown block {kind}")
    except (IndexError, struct.error) as e:
        raise ValueError("truncated GIF") from e


def histogram(frames: list[Frame], bins: int = BINS) -> np.ndarray:
    """3 x bins counts of red, green and blue over the visible pixels of all frames."""
    out = np.zeros((3, bins), np.int64)
    for f in frames:
        visible = f.rgba[f.rgba[..., 3] > 0]
        for c in range(3):
            out[c] += np.bincount(visible[:, c].astype(np.int64) * bins >> 8, minlength=bins)
    return out


def as_gif(payload: bytes, width: int = WIDTH, rows: int = ROWS) -> bytes:
    """payload: a positive multiple of width bytes."""
    grid = np.frombuffer(payload, np.uint8).reshape(-1, width)
    return encode_gif([grid[i : i + rows] for i in range(0, len(grid), rows)])


def payload_of(frames: list[Frame], size: int, rows: int = ROWS) -> bytes:
    """The samples that as_gif() stored; the last frame may cover part of the canvas only."""
    left, out = size // frames[0].rgba.shape[1], []
    for f in frames:
        n = min(left, rows)
        out.append(np.ascontiguousarray(f.rgba[:n, :, 0]).tobytes())
        left -= n
    return b"".join(out)


def stored(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes and the GIF of every row's padded UTF-8 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, data = offsets_and_bytes(batch.column(1))
            for lo in range(0, batch.num_rows, 256):
                hi = min(lo + 256, batch.num_rows)
                raw = [data[off[i] : off[i + 1]].tobytes() for i in range(lo, hi)]
                gifs = [as_gif(x + bytes(64 - len(x) % 64 if len(x) % 64 or not x else 0)) for x in raw]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array([len(x) for x in raw], pa.int64()), pa.array(gifs, pa.binary())], ["doc_id", "n_bytes", "gif"])

    return docs.select(key, text).mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, n_bytes long, gif binary")


def decoded(images: DataFrame, key: str = "doc_id", image: str = "gif", bins: int = BINS) -> DataFrame:
    """Per image its frames as rows of one array column (delay, height, width, samples of RGBA) with histogram columns; error where it can't be read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data, row = batch.column(1)[i].as_py(), {"frames": None, "red": None, "green": None, "blue": None, "error": None}
                try:
                    frames = decode_gif(data or b"")
                    row |= {"frames": [{"delay": f.delay, "height": f.rgba.shape[0], "width": f.rgba.shape[1], "rgba": f.rgba.tobytes()} for f in frames]}
                    row |= dict(zip(("red", "green", "blue"), histogram(frames, bins).tolist(), strict=True))
                except ValueError as e:
                    row["error"] = str(e)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i : i + 1], *[pa.array([row[n]], t) for n, t in kinds.items()]], [key, *kinds])

    longs = pa.list_(pa.int64())
    kinds = {"frames": pa.list_(pa.struct([("delay", pa.int32()), ("height", pa.int32()), ("width", pa.int32()), ("rgba", pa.binary())])), "red": longs, "green": longs, "blue": longs, "error": pa.string()}
    schema = f"{key} {images.schema[key].dataType.simpleString()}, frames array<struct<delay:int,height:int,width:int,rgba:binary>>, red array<bigint>, green array<bigint>, blue array<bigint>, error string"
    return images.select(key, image).mapInArrow(run, schema)


def digests(images: DataFrame, bins: int = BINS) -> DataFrame:
    """Reads each stored GIF back and gives the digest columns of its payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for n, gif in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                frames = decode_gif(gif)
                size = n + (-n % 64) or 64
                back = payload_of(frames, size)
                hist = histogram(frames, bins)[0]
                rows.append((len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(gif), hashlib.sha256(gif).hexdigest(), f"{len(frames)}:{sum(f.delay for f in frames)}:" + ",".join(map(str, hist))))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]], NAMES)

    return images.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


NAMES = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]


def query(spark, sf_dir: str) -> DataFrame:
    return digests(stored(spark.read.parquet(f"{sf_dir}/documents.parquet")))
