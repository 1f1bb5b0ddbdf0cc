"""Media columns: Netpbm and BMP images in binary columns, decoded to numpy arrays.

``features`` area-resizes each image by integral images, writes the result as an NPY tile and adds a difference
hash. Images are worked on in strips of rows, so the working memory is that of the image plus one strip.

Defined results: a null or undecodable image has null features; an image with no rows or columns has an all-zero
tile and hash; repeated rows and equal images give equal values; extra input columns are passed through or ignored by
the caller's choice of ``keep``.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Payload bytes are stored as rows of so many 8-bit samples.
WIDTH = 64
#: Rows of an image that are summed at a time.
STRIP = 8192
TILE = (16, 16)

FEATURES = ("height", "width", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "tile")

_PNM = re.compile(rb"(?:\s|#[^\n]*\n)*([0-9]+)")


def encode_pgm(samples: np.ndarray) -> bytes:
    """A binary Netpbm image: P5 for (h, w), P6 for (h, w, 3)."""
    h, w = samples.shape[:2]
    kind = b"P6" if samples.ndim == 3 else b"P5"
    return b"%s\n%d %d\n255\n" % (kind, w, h) + np.ascontiguousarray(samples, np.uint8).tobytes()


def encode_bmp(samples: np.ndarray) -> bytes:
    """An uncompressed bottom-up BMP: 8 bits with a grey palette for (h, w), 24 bits for (h, w, 3)."""
    h, w = samples.shape[:2]
    deep = samples.ndim == 3
    rows = samples[::-1, :, ::-1].reshape(h, w * 3) if deep else samples[::-1]
    pad = -rows.shape[1] % 4
    body = np.pad(rows, ((0, 0), (0, pad))).astype(np.uint8).tobytes()
    palette = b"" if deep else b"".join(bytes((i, i, i, 0)) for i in range(256))
    at = 54 + len(palette)
    head = struct.pack("<2sIHHI", b"BM", at + len(body), 0, 0, at)
    info = struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24 if deep else 8, 0, len(body), 2835, 2835, 0 if deep else 256, 0)
    return head + info + palette + body


def _decode_pnm(data: bytes) -> np.ndarray:
    kind, at, fields = data[:2], 2, []
    for _ in range(2 if kind in (b"P1", b"P4") else 3):
        m = _PNM.match(data, at)
        if not m:
            raise ValueError("bad Netpbm header")
        fields.append(int(m[1]))
        at = m.end()
    w, h, top = fields[0], fields[1], fields[2] if len(fields) > 2 else 1
    depth = 3 if kind in (b"P3", b"P6") else 1
    n = w * h * depth
    if kind in (b"P1", b"P2", b"P3"):
        body = re.sub(rb"#[^\n]*", b"", data[at:])
        found = [int(x) for x in (re.findall(rb"[01]", body) if kind == b"P1" else body.split())]
        values = np.array(found[:n], np.int64)
    elif kind == b"P4":
        raw = np.frombuffer(data, np.uint8, count=h * ((w + 7) // 8), offset=at + 1).reshape(h, -1)
        values = np.unpackbits(raw, axis=1)[:, :w].reshape(-1).astype(np.int64)
    else:
        values = np.frombuffer(data, np.uint8 if top < 256 else ">u2", count=n, offset=at + 1)
    if len(values) != n:
        raise ValueError("short Netpbm raster")
    if kind in (b"P1", b"P4"):
        values = (1 - values) * 255
    elif top != 255:
        values = np.minimum(values.astype(np.int64), top) * 255 // max(1, top)
    return values.astype(np.uint8, copy=False).reshape((h, w, 3) if depth == 3 else (h, w))


def _decode_bmp(data: bytes) -> np.ndarray:
    at, info = struct.unpack_from("<I", data, 10)[0], struct.unpack_from("<IiiHHI", data, 14)
    size, w, h, _, bits, packed = info
    if packed not in (0, 3) or bits not in (1, 4, 8, 24, 32):
        raise ValueError("unsupported BMP")
    upside, h = h > 0, abs(h)
    stride = (w * bits + 31) // 32 * 4
    raw = np.frombuffer(data, np.uint8, count=stride * h, offset=at).reshape(h, stride)
    if bits <= 8:
        if bits < 8:
            per = 8 // bits
            shifts = np.arange(per - 1, -1, -1, dtype=np.uint8) * bits
            raw = ((raw[:, :, None] >> shifts) & ((1 << bits) - 1)).reshape(h, -1)
        used = struct.unpack_from("<I", data, 46)[0] or 1 << bits
        palette = np.frombuffer(data, np.uint8, count=4 * used, offset=14 + size).reshape(-1, 4)[:, 2::-1]
        index = raw[:, :w]
        out = palette[:, 0][index] if (palette == palette[:, :1]).all() else palette[index]
    elif packed == 3:  # a mask says which bits hold red, green and blue
        masks = struct.unpack_from("<III", data, 54)
        if bits != 32 or not all(masks):
            raise ValueError("unsupported BMP masks")
        pixels = raw.view("<u4")[:, :w].astype(np.int64)
        out = np.stack([((pixels & m) >> (m & -m).bit_length() - 1) * 255 // (m // (m & -m)) for m in masks], axis=2).astype(np.uint8)
    else:
        out = raw[:, : w * bits // 8].reshape(h, w, bits // 8)[:, :, 2::-1]
    return np.ascontiguousarray(out[::-1] if upside else out)


def decode(data: bytes) -> np.ndarray:
    """An (h, w) or (h, w, 3) array of 8-bit samples from a Netpbm (P1 to P6) or uncompressed BMP image."""
    if data[:2] == b"BM":
        return _decode_bmp(data)
    if data[:1] == b"P" and data[1:2] in b"123456":
        return _decode_pnm(data)
    raise ValueError("neither Netpbm nor BMP")


def _at(edges: np.ndarray, integral: np.ndarray, axis: int) -> np.ndarray:
    low = np.minimum(edges.astype(np.int64), integral.shape[axis] - 1)
    high = np.minimum(low + 1, integral.shape[axis] - 1)
    part = (edges - low).reshape((-1, 1) if axis == 0 else (1, -1))
    a, b = np.take(integral, low, axis), np.take(integral, high, axis)
    return a + (b - a) * part


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Means over the (fractional) areas of a height x width grid, from the integral image.

    The integral image is linear between whole rows and columns, so its values at fractional edges are exact. It is
    built in strips of rows, and only its rows at the wanted edges are kept.
    """
    grey = image.mean(axis=2) if image.ndim == 3 else image
    h, w = grey.shape
    if not h or not w:
        return np.zeros((height, width))
    ys, xs = np.arange(height + 1) * (h / height), np.arange(width + 1) * (w / width)
    rows, above = np.zeros((height + 1, w)), np.zeros(w)
    for top in range(0, h, STRIP):
        part = grey[top : top + STRIP]
        integral = np.vstack([above, above + np.cumsum(part, axis=0, dtype=np.float64)])
        last = top + len(part) >= h
        here = (ys >= top) & ((ys < top + len(part)) | last)
        if here.any():
            rows[here] = _at(ys[here] - top, integral, 0)
        above = integral[-1]
    across = np.hstack([np.zeros((height + 1, 1)), np.cumsum(rows, axis=1)])
    corners = _at(xs, across, 1)
    sums = corners[1:, 1:] - corners[:-1, 1:] - corners[1:, :-1] + corners[:-1, :-1]
    return sums / ((h / height) * (w / width))


def difference_hash(image: np.ndarray) -> str:
    """64 bits in hex: whether each of 8 x 9 area means is below its right neighbour."""
    small = np.round(area_resize(image, 8, 9), 6)
    return np.packbits(small[:, :-1] < small[:, 1:]).tobytes().hex()


def npy_tile(image: np.ndarray, shape: tuple[int, int] = TILE) -> bytes:
    out = io.BytesIO()
    np.save(out, np.floor(area_resize(image, *shape) + 0.5).astype(np.uint8), allow_pickle=False)
    return out.getvalue()


def read_tile(data: bytes) -> np.ndarray:
    return np.load(io.BytesIO(data), allow_pickle=False)


def features(df: DataFrame, media: str = "media", keep: tuple[str, ...] = ("doc_id",), shape: tuple[int, int] = TILE) -> DataFrame:
    """``keep`` columns, then height, width, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256,
    feature (difference hash) and tile (NPY bytes) of each image. Null or undecodable images: nulls. A kept column with
    one of these names is replaced."""
    keep = tuple(c for c in keep if c not in FEATURES)
    kept = df.select(*keep)
    schema = kept.schema.simpleString()[7:-1] + ", height int, width int, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, tile binary"

    def one(data: bytes | None) -> tuple:
        if data is None:
            return (None,) * 9
        size, digest = len(data), hashlib.sha256(data).hexdigest()
        try:
            image = decode(data)
        except (ValueError, struct.error, IndexError):
            return (None, None, None, None, None, size, digest, None, None)
        payload = image.tobytes()
        return (image.shape[0], image.shape[1], len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), size, digest, difference_hash(image), npy_tile(image, shape))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
        for batch in batches:
            values = batch.column(batch.num_columns - 1)
            rows = [one(x.as_py()) for x in values]
            made = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + made, [*batch.schema.names[:-1], *FEATURES])

    return common.in_arrow(df.select(*keep, F.col(media).alias("__media")), work, schema)


def images_of_texts(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, media): each text's UTF-8 bytes, padded with 0 to a positive multiple of 64, as rows of 64
    8-bit grey samples; a checksum of the text picks Netpbm or BMP. Null texts count as empty."""
    source = df.select(key, F.encode(common.text_or_empty(text), "UTF-8").alias("__payload"))
    schema = source.select(key).schema.simpleString()[7:-1] + ", n_bytes long, media binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, media = [], []
            for x in batch.column(1):
                data = x.as_py()
                n = len(data)
                data += bytes(-n % WIDTH or (WIDTH if not n else 0))
                samples = np.frombuffer(data, np.uint8).reshape(-1, WIDTH)
                sizes.append(n)
                media.append(encode_bmp(samples) if zlib.crc32(data) & 1 else encode_pgm(samples))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], [batch.schema.names[0], "n_bytes", "media"])

    return common.in_arrow(source, work, schema)


def tile_facts(df: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` columns, tile_shape and tile_mean of each stored NPY tile. Null tiles: nulls."""
    schema = df.select(*keep).schema.simpleString()[7:-1] + ", tile_shape string, tile_mean double"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tiles = [None if x is None else read_tile(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
            shapes = [None if t is None else "x".join(map(str, t.shape)) for t in tiles]
            means = [None if t is None else float(t.mean()) for t in tiles]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(shapes, pa.string()), pa.array(means, pa.float64())], [*batch.schema.names[:-1], "tile_shape", "tile_mean"])

    return common.in_arrow(df.select(*keep, F.col("tile").alias("__tile")), work, schema)


def op1_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images are written and read again, and so are what is computed from them and their tiles."""
    stored = common.stage(images_of_texts(common.table(spark, sf_dir, "documents")), "media")
    found = common.stage(features(stored, keep=("doc_id", "n_bytes")).drop("height", "width"), "tiles")
    return tile_facts(found, tuple(c for c in found.columns if c != "tile"))
