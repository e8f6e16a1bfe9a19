"""Text boxes and payloads as recognisers write them."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gridloom.functions.tables import strip_fence
from gridloom.functions.text import LINE_END
from gridloom.operators.geometry import to_page

#: Keys of a payload in the order in which they are looked at.
KEYS = ("markdown", "md", "ground_truth", "result", "content", "text", "data", "choices", "message")


def _number(c: Column) -> Column:
    return c.try_cast("double")


def tile_boxes(rows: DataFrame, key: str, tsv: str = "tsv") -> DataFrame:
    """Boxes on the page from tab-separated lines ``x y width height confidence text`` of scaled tiles.

    The tile is given by ``x0, x1, y0, y1, width, height``. Lines with fewer
    fields or fields that are no numbers are left out.
    """
    line = rows.select(key, "x0", "x1", "y0", "y1", "width", "height", F.explode(F.split(tsv, LINE_END)).alias("_line"))
    f = line.withColumn("_f", F.split("_line", "\t", 6)).where(F.size("_f") == 6)
    part = lambda i: _number(F.col("_f")[i])
    sx, sy = (F.col("x1") - F.col("x0")) / F.col("width"), (F.col("y1") - F.col("y0")) / F.col("height")
    out = f.select(
        key,
        to_page(part(0), F.col("x0"), F.col("x1"), F.col("width")).alias("x"),
        to_page(part(1), F.col("y0"), F.col("y1"), F.col("height")).alias("y"),
        (part(2) * sx).alias("width"),
        (part(3) * sy).alias("height"),
        part(4).alias("confidence"),
        F.col("_f")[5].alias("text"),
    )
    return out.dropna(subset=["x", "y", "width", "height", "confidence"])


def corner_boxes(rows: DataFrame, key: str, tsv: str = "tsv") -> DataFrame:
    """The same from boxes given by their lower left corner in parts of the tile: ``x y width height confidence text``."""
    line = rows.select(key, "x0", "x1", "y0", "y1", F.explode(F.split(tsv, LINE_END)).alias("_line"))
    f = line.withColumn("_f", F.split("_line", "\t", 6)).where(F.size("_f") == 6)
    part = lambda i: _number(F.col("_f")[i])
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    out = f.select(
        key,
        (F.col("x0") + (part(0) + part(2) / 2) * w).alias("x"),
        (F.col("y0") + (1 - (part(1) + part(3) / 2)) * h).alias("y"),
        (part(2) * w).alias("width"),
        (part(3) * h).alias("height"),
        part(4).alias("confidence"),
        F.col("_f")[5].alias("text"),
    )
    return out.dropna(subset=["x", "y", "width", "height", "confidence"])


def to_tsv(x: Column, y: Column, width: Column, height: Column, confidence: Column, text: Column) -> Column:
    """One line of a box; tabs and line ends in its text become spaces."""
    return F.concat_ws("\t", *[c.cast("string") for c in (x, y, width, height, confidence)], F.regexp_replace(text, r"[\t\r\n]", " "))


def quad_to_box(quad: Column) -> Column:
    """``struct(x, y, width, height)`` around four corners ``array<array<double>>``."""
    xs, ys = F.transform(quad, lambda p: p[0]), F.transform(quad, lambda p: p[1])
    x0, x1, y0, y1 = F.array_min(xs), F.array_max(xs), F.array_min(ys), F.array_max(ys)
    return F.struct(((x0 + x1) / 2).alias("x"), ((y0 + y1) / 2).alias("y"), (x1 - x0).alias("width"), (y1 - y0).alias("height"))


def _find(value) -> str | None:
    if isinstance(value, str):
        try:
            inner = json.loads(value) if value.lstrip()[:1] in "{[" and value.strip() else None
        except ValueError:
            inner = None
        return (_find(inner) if isinstance(inner, (dict, list)) else None) or value
    if isinstance(value, dict):
        order = [value[k] for k in KEYS if k in value] + [v for k, v in value.items() if k not in KEYS and isinstance(v, (dict, list))]
        return next((t for t in map(_find, order) if t), None)
    if isinstance(value, list):
        parts = [t for t in map(_find, value) if t]
        return "\n\n".join(parts) or None
    return None


def payload_text(payload: str, lenient: bool = False) -> str:
    """The text of a payload: what is not JSON as it is, else what its known keys lead to, without a fence.

    Raises ``ValueError`` for payloads that say they failed and for open fences.
    """
    try:
        value = json.loads(payload)
    except ValueError:
        return payload
    if isinstance(value, dict) and (value.get("success") is False or value.get("code", None) not in (None, "SUCCESS", 0, "0")):
        raise ValueError(f"the payload reports {value.get('message') or value.get('code')}")
    found = _find(value)
    return strip_fence(found, lenient) if found else json.dumps(value, ensure_ascii=False, indent=2)


@F.pandas_udf(StringType())
def payload_texts(payloads: pd.Series) -> pd.Series:
    """Null where the payload failed."""

    def get(p):
        try:
            return None if p is None else payload_text(p)
        except ValueError:
            return None

    return payloads.map(get)


def cached_tiles(files: DataFrame) -> DataFrame:
    """Tile texts of a cache by ``path`` and ``content``: ``<stem>_content_rNNN_cNNN.md``.

    For each stem the directory with most tiles is taken, the first by name on
    a tie. Gives ``(stem, row, col, text)``.
    """
    from pyspark.sql.window import Window

    pattern = r"(.*)/([^/]+)_content_r(\d+)_c(\d+)\.md$"
    get = lambda i: F.regexp_extract("path", pattern, i)
    rows = files.where(F.col("path").rlike(pattern)).select(get(1).alias("folder"), get(2).alias("stem"), get(3).cast("int").alias("row"), get(4).cast("int").alias("col"), F.decode("content", "UTF-8").alias("text"))
    size = rows.groupBy("stem", "folder").agg(F.count("*").alias("n"))
    best = size.withColumn("_r", F.row_number().over(Window.partitionBy("stem").orderBy(F.desc("n"), "folder"))).where("_r = 1").select("stem", "folder")
    return rows.join(best, ["stem", "folder"]).select("stem", "row", "col", payload_texts("text").alias("text"))
