"""Measures of page images, decoded by Spark's ``image`` source (grey, or colour averaged).

A page is one row; its pixels are handled in one numpy array. Undecodable
images give nulls.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

THRESHOLD = 245


def grey(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    pixels = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return pixels[:, :, 0] if channels == 1 else pixels[:, :, :3].mean(axis=2).astype(np.uint8)


def content_box(mask: np.ndarray, padding: int = 0) -> tuple[int, int, int, int]:
    """``(x0, y0, x1, y1)`` around all that is set, padded and kept on the page; the whole page if nothing is."""
    rows, cols = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
    h, w = mask.shape
    if not len(rows):
        return 0, 0, w, h
    return max(0, int(cols[0]) - padding), max(0, int(rows[0]) - padding), min(w, int(cols[-1]) + 1 + padding), min(h, int(rows[-1]) + 1 + padding)


def text_pixels(mask: np.ndarray, ruled: float = 0.8) -> int:
    """Set pixels outside of rows and columns that are mostly set (ruling lines)."""
    rows, cols = mask.mean(axis=1) >= ruled, mask.mean(axis=0) >= ruled
    return int(mask[np.ix_(~rows, ~cols)].sum())


def projection(counts: np.ndarray, share: float = 0.02) -> tuple[int, int]:
    """Runs of dense lines, and the longest gap between them."""
    dense = counts > share * max(1, int(counts.max(initial=0)))
    edges = np.flatnonzero(np.diff(np.concatenate(([0], dense.astype(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    gaps = starts[1:] - ends[:-1]
    return len(starts), int(gaps.max(initial=0))


def snap_edges(edges: list[int], profile: np.ndarray, radius: int) -> list[int]:
    """Inner edges moved to the darkest line within the radius, half a step apart at least."""
    if len(edges) < 3:
        return list(edges)
    least = max(1, min(b - a for a, b in zip(edges, edges[1:])) // 2)
    out = [edges[0]]
    for e in edges[1:-1]:
        low, high = max(out[-1] + least, e - radius), min(edges[-1] - least, e + radius)
        window = profile[low : high + 1]
        out.append(low + int(window.argmax()) if len(window) and window.max() > 2 * max(1.0, float(np.median(profile))) else e)
    return [*out, edges[-1]]


def png_size(header: bytes) -> tuple[int, int] | None:
    """Width and height from the first bytes of a PNG, BMP or JPEG."""
    if header[:8] == b"\x89PNG\r\n\x1a\n":
        return struct.unpack(">II", header[16:24])
    if header[:2] == b"BM":
        w, h = struct.unpack("<ii", header[18:26])
        return w, abs(h)
    if header[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(header):
            if header[at] != 0xFF:
                return None
            mark, size = header[at + 1], struct.unpack(">H", header[at + 2 : at + 4])[0]
            if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack(">HH", header[at + 5 : at + 9])
                return w, h
            at += 2 + size
    return None


_SIZE = StructType([StructField("width", IntegerType()), StructField("height", IntegerType())])
_PROFILE = StructType(
    [StructField(n, IntegerType()) for n in ("width", "height")]
    + [StructField("box", ArrayType(IntegerType()))]
    + [StructField(n, LongType()) for n in ("content_pixels", "text_pixels")]
    + [StructField(n, DoubleType()) for n in ("content_ratio", "text_ratio", "aspect")]
    + [StructField(n, IntegerType()) for n in ("row_bands", "row_gap", "col_bands", "col_gap")]
)


@F.pandas_udf(_SIZE)
def image_size(content: pd.Series) -> pd.DataFrame:
    """Width and height from headers alone."""
    rows = [png_size(bytes(c)) if c is not None else None for c in content]
    return pd.DataFrame([r or (None, None) for r in rows], columns=["width", "height"], dtype="Int32")


@F.pandas_udf(_PROFILE)
def profile(height: pd.Series, width: pd.Series, channels: pd.Series, data: pd.Series) -> pd.DataFrame:
    out = []
    for h, w, c, d in zip(height, width, channels, data):
        if not h or h < 0 or d is None:
            out.append((None,) * len(_PROFILE.names))
            continue
        mask = grey(h, w, c, bytes(d)) < THRESHOLD
        dark, text = int(mask.sum()), text_pixels(mask)
        rows, cols = projection(mask.sum(axis=1)), projection(mask.sum(axis=0))
        out.append((w, h, list(content_box(mask)), dark, text, dark / mask.size, text / mask.size, w / h, *rows, *cols))
    return pd.DataFrame(out, columns=_PROFILE.names)


def profiles(images: DataFrame) -> DataFrame:
    """``(origin, width, height, box, ...)`` of a frame read by ``spark.read.format("image")``."""
    i = "image."
    p = profile(F.col(i + "height"), F.col(i + "width"), F.col(i + "nChannels"), F.col(i + "data"))
    return images.select(F.col(i + "origin").alias("origin"), p.alias("p")).select("origin", "p.*")
