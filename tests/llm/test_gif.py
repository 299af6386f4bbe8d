import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skyflux.llm import op02_gif as gif


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=3000), st.integers(1, 200))
def test_lzw_round_trip(data, repeat):
    data = data * repeat if len(data) * repeat < 60_000 else data
    assert gif.lzw_decode(gif.lzw_encode(data), 8, len(data)) == data


def test_lzw_full_table_without_clear():
    """A stream whose encoder goes on with 12-bit codes when the table is full, read code by code for comparison."""
    rng = np.random.default_rng(0)
    data = bytes(rng.integers(0, 4, 60_000).astype(np.uint8))
    codes, table, free, w = [4], {bytes([i]): i for i in range(4)}, 6, b""
    for b in data:
        if (x := w + bytes([b])) in table:
            w = x
            continue
        codes.append(table[w])
        if free < 4096:
            table[x] = free
            free += 1
        w = bytes([b])
    codes += [table[w], 5]
    bits = []
    size, k = 3, 0
    for i, c in enumerate(codes):
        bits += [c >> j & 1 for j in range(size)]
        if i:
            k += 1
        size = min(12, max(3, (5 + k).bit_length())) if i else 3
    stream = np.packbits(np.array(bits, np.uint8), bitorder="little").tobytes()
    assert gif.lzw_decode(stream, 2, len(data)) == data


@pytest.mark.parametrize("bad", [b"", b"GIF89a", b"GIF89a" + bytes(7), b"\x00" * 30, gif.as_gif(b"x" * 64)[:-20], gif.as_gif(b"x" * 64)[:100]])
def test_damaged(bad):
    with pytest.raises(ValueError):
        gif.decode_gif(bad)


def frame(x, y, w, h, index, disposal=0, clear=None, delay=7, interlaced=False):
    rows = np.full((h, w), index, np.uint8) if np.isscalar(index) else np.asarray(index, np.uint8)
    if interlaced:
        rows = rows[np.concatenate([np.arange(s, h, d) for s, d in ((0, 8), (4, 8), (2, 4), (1, 2))])]
    control = bytes([0x21, 0xF9, 4, disposal << 2 | (clear is not None), delay, 0, clear or 0, 0])
    place = b"\x2c" + b"".join(v.to_bytes(2, "little") for v in (x, y, w, h)) + bytes([0x40 if interlaced else 0])
    return control + place + b"\x08" + gif._blocks(gif.lzw_encode(rows.tobytes()))


def test_disposal_and_transparency():
    head = b"GIF89a" + bytes([4, 0, 3, 0, 0xF7, 0, 0]) + gif._GREY + b"\x21\xff\x0bNETSCAPE2.0\x03\x01\x00\x00\x00"
    data = head + frame(0, 0, 4, 3, 10) + frame(1, 1, 2, 1, 20, disposal=2) + frame(0, 0, 1, 1, 30, disposal=3) + frame(0, 0, 4, 3, [[40, 0, 0, 0]] + [[0] * 4] * 2, clear=0) + b"\x3b"
    frames = gif.decode_gif(data)
    assert [f.delay for f in frames] == [7] * 4
    red = [f.rgba[..., 0].tolist() for f in frames]
    alpha = [f.rgba[..., 3].tolist() for f in frames]
    assert red[0] == [[10] * 4] * 3 and red[1][1] == [10, 20, 20, 10]
    assert red[2][0][0] == 30 and alpha[2][1] == [255, 0, 0, 255]
    assert red[3][0] == [40, 10, 10, 10] and alpha[3][1] == [255, 0, 0, 255]
    assert gif.histogram(frames[:1])[0].tolist() == [12] + [0] * 7


def test_interlaced_and_local_palette():
    rows = np.arange(20).repeat(2).reshape(20, 2)
    data = b"GIF89a" + bytes([2, 0, 20, 0, 0xF7, 0, 0]) + gif._GREY + frame(0, 0, 2, 20, rows, interlaced=True) + b"\x3b"
    assert (gif.decode_gif(data)[0].rgba[..., 0] == rows).all()
    local = b"GIF89a" + bytes([1, 0, 1, 0, 0, 0, 0]) + b"\x2c" + bytes([0, 0, 0, 0, 1, 0, 1, 0, 0x80]) + bytes([9, 8, 7, 1, 2, 3]) + b"\x02" + gif._blocks(gif.lzw_encode(b"\x01", 2)) + b"\x3b"
    assert gif.decode_gif(local)[0].rgba.tolist() == [[[1, 2, 3, 255]]]


def test_query(docs_of):
    texts = [None, "", "a" * 64, "é" * 33, "x" * 70_000, "same", "same", "tab\tnew\nline" * 500]
    got = gif.digests(gif.stored(docs_of(texts))).toPandas().set_index("doc_id")
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        padded = raw + bytes(-len(raw) % 64 or (64 if not raw else 0))
        r = got.loc[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
        stored = gif.as_gif(padded)
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
    assert got.loc[5].equals(got.loc[6])
    assert gif.digests(gif.stored(docs_of([]))).count() == 0


def test_decoded_columns(spark):
    images = spark.createDataFrame([(1, bytearray(gif.as_gif(b"\x05" * 128))), (2, bytearray(b"no")), (3, None)], "doc_id long, gif binary")
    rows = {r["doc_id"]: r for r in gif.decoded(images).collect()}
    assert rows[1]["frames"][0]["delay"] == gif.DELAY and rows[1]["red"][0] == 128 and rows[1]["error"] is None
    assert rows[2]["error"] and rows[3]["error"] and rows[2]["frames"] is None
