"""Image hashes and embeddings, with decoder and model given by the caller."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Decoder = Callable[[bytes], np.ndarray]


def decode_ppm(data: bytes) -> np.ndarray:
    """Height x width x 3 from a binary PPM or PGM image: a decoder that needs no library."""
    fields, at = [], 0
    while len(fields) < 4:
        while data[at : at + 1].isspace():
            at += 1
        if data[at : at + 1] == b"#":
            at = data.index(b"\n", at)
            continue
        end = at
        while end < len(data) and not data[end : end + 1].isspace():
            end += 1
        fields.append(data[at:end])
        at = end
    kind, width, height = fields[0], int(fields[1]), int(fields[2])
    planes = {b"P6": 3, b"P5": 1}[kind]
    pixels = np.frombuffer(data, np.uint8, width * height * planes, at + 1).reshape(height, width, planes)
    return np.repeat(pixels, 3, 2) if planes == 1 else pixels


def decode_png(data: bytes) -> np.ndarray:
    """Height x width x 3 from a PNG of 8 bits a channel, not interlaced: grey, colour or palette, with or without alpha (which is dropped)."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("no PNG")
    at, packed, palette, head = 8, [], None, None
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            packed.append(body)
        at += size + 12
    width, height, depth, color, _, _, interlaced = head
    planes = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[color]
    if depth != 8 or interlaced:
        raise ValueError("only 8 bits a channel, not interlaced")
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, 1 + width * planes)
    out = np.zeros((height, width, planes), np.int64)
    above = np.zeros((width, planes), np.int64)
    for y in range(height):
        rule, raw = lines[y, 0], lines[y, 1:].reshape(width, planes).astype(np.int64)
        if rule == 0:
            row = raw
        elif rule == 1:
            row = np.cumsum(raw, 0) % 256
        elif rule == 2:
            row = (raw + above) % 256
        else:  # average and Paeth look at the pixel just made
            row, left, corner = np.zeros_like(raw), np.zeros(planes, np.int64), np.zeros(planes, np.int64)
            for x in range(width):
                up = above[x]
                if rule == 3:
                    guess = (left + up) // 2
                else:
                    p = left + up - corner
                    a, b, c = np.abs(p - left), np.abs(p - up), np.abs(p - corner)
                    guess = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
                row[x] = left = (raw[x] + guess) % 256
                corner = up
        out[y] = above = row
    pixels = out.astype(np.uint8)
    if palette is not None and color == 3:
        return palette[pixels[..., 0]]
    return np.repeat(pixels[..., :1], 3, 2) if planes < 3 else pixels[..., :3]


def decode(data: bytes) -> np.ndarray:
    """Any image that needs no library: PNG, PPM, PGM."""
    return decode_png(data) if data[:1] == b"\x89" else decode_ppm(data)


def linear_model(spark: SparkSession, weights: np.ndarray) -> Callable[[], Callable[[np.ndarray], np.ndarray]]:
    """A model for `embedded` from features x pixels weights, which are broadcast once instead of sent with every task."""
    held = spark.sparkContext.broadcast(np.asarray(weights, np.float64))
    return lambda: lambda batch: batch.mean(3).reshape(len(batch), -1) @ held.value.T


def resized(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear, with pixel centres aligned."""
    h, w = image.shape[:2]
    y = np.clip((np.arange(height) + 0.5) * h / height - 0.5, 0, h - 1)
    x = np.clip((np.arange(width) + 0.5) * w / width - 0.5, 0, w - 1)
    y0, x0 = y.astype(int), x.astype(int)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    fy, fx = (y - y0)[:, None, None], (x - x0)[None, :, None]
    f = image.astype(np.float64)
    return (f[y0][:, x0] * (1 - fx) + f[y0][:, x1] * fx) * (1 - fy) + (f[y1][:, x0] * (1 - fx) + f[y1][:, x1] * fx) * fy


def difference_hash(data: bytes | None, decode: Decoder = decode, side: int = 5) -> bytes | None:
    """Which of neighbouring pixels of a small grey image is brighter, as bits; null if it can't be decoded."""
    try:
        grey = resized(decode(data), side, side + 1).mean(2)
    except Exception:  # noqa: BLE001 - any broken image has no hash
        return None
    return np.packbits((grey[:, 1:] > grey[:, :-1]).ravel()).tobytes()


def with_hash(df: DataFrame, content: str, decode: Decoder = decode, name: str = "image_hash") -> DataFrame:
    @F.pandas_udf("binary")
    def hashed(batch: pd.Series) -> pd.Series:
        return batch.map(lambda x: difference_hash(bytes(x), decode) if x is not None else None)

    return df.withColumn(name, hashed(content))


def color_histogram(batch: np.ndarray) -> np.ndarray:
    """A model without training: the share of 4 x 4 x 4 colours of each image, from values in [-1, 1]."""
    levels = np.clip(((batch + 1) * 2).astype(int), 0, 3)
    codes = (levels[..., 0] * 16 + levels[..., 1] * 4 + levels[..., 2]).reshape(len(batch), -1)
    return np.stack([np.bincount(c, minlength=64) for c in codes]).astype(np.float64)


def embedded(df: DataFrame, content: str, model: Callable[[], Callable[[np.ndarray], np.ndarray]] | None = None, decode: Decoder = decode, side: int = 200, batch: int = 8, name: str = "product_image_embedding") -> DataFrame:
    """df with a vector of length 1 per image; a null or broken image counts as a black one.

    model is called once per task and returns a function from images (n, side, side, 3) in
    [-1, 1] to features. Batches bound what is in memory; wide rows should be repartitioned before.
    """
    load = model or (lambda: color_histogram)

    def prepared(data: bytes | None) -> np.ndarray:
        try:
            return resized(decode(bytes(data)), side, side) / 127.5 - 1
        except Exception:  # noqa: BLE001
            return np.zeros((side, side, 3))

    @F.pandas_udf("array<float>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = load()
        for part in parts:
            out: list[np.ndarray] = []
            for i in range(0, len(part), batch):
                found = features(np.stack([prepared(x) for x in part.iloc[i : i + batch]]))
                found = found.reshape(len(found), -1)
                out += list((found / (np.linalg.norm(found, axis=1, keepdims=True) + 1e-5)).astype(np.float32))
            yield pd.Series(out, dtype=object)

    return df.withColumn(name, run(content))
