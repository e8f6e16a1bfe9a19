"""Tile geometry as column expressions: ranges, grids, budgets and crops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Places of a crop within the page, as parts of the room left and right, above and below.
ANCHORS = {
    "top_left": (0.0, 0.0),
    "top": (0.5, 0.0),
    "top_right": (1.0, 0.0),
    "left": (0.0, 0.5),
    "center": (0.5, 0.5),
    "right": (1.0, 0.5),
    "bottom_left": (0.0, 1.0),
    "bottom": (0.5, 1.0),
    "bottom_right": (1.0, 1.0),
}


def axis_ranges(length: Column, size: Column, overlap: Column) -> Column:
    """Overlapping ranges ``(lo, hi)`` that cover [0, length): one of them if the size is null, not positive or enough."""
    whole = F.array(F.struct(F.lit(0).alias("lo"), length.cast("int").alias("hi")))
    step = F.greatest(size - overlap, F.lit(1))
    n = F.ceil((length - size) / step).cast("int")
    parts = F.transform(F.sequence(F.lit(0), n), lambda i: F.struct((i * step).cast("int").alias("lo"), F.least(i * step + size, length).cast("int").alias("hi")))
    return F.when(size.isNull() | (size <= 0) | (size >= length), whole).otherwise(parts)


def grid_tiles(pages: DataFrame, key: str, width: str, height: str, tile_w: int, tile_h: int, x_overlap: int, y_overlap: int) -> DataFrame:
    """``(key, row, col, rows, cols, x0, x1, y0, y1)``, rows and columns from 1, row by row. Pages without an extent have no tiles."""
    real = pages.where((F.col(width) > 0) & (F.col(height) > 0))
    xs = axis_ranges(F.col(width), F.lit(tile_w), F.lit(x_overlap))
    ys = axis_ranges(F.col(height), F.lit(tile_h), F.lit(y_overlap))
    ranged = real.select(key, xs.alias("xs"), ys.alias("ys"))
    by_row = ranged.select(key, "xs", F.size("ys").alias("rows"), F.posexplode("ys").alias("r", "y"))
    tiles = by_row.select(key, "rows", "r", "y", F.size("xs").alias("cols"), F.posexplode("xs").alias("c", "x"))
    return tiles.select(
        key, (F.col("r") + 1).alias("row"), (F.col("c") + 1).alias("col"), "rows", "cols", F.col("x.lo").alias("x0"), F.col("x.hi").alias("x1"), F.col("y.lo").alias("y0"), F.col("y.hi").alias("y1")
    )


def even_edges(start: Column, end: Column, parts: Column) -> Column:
    """Edges of ``parts`` equal ranges, rounded half to even."""
    return F.transform(F.sequence(F.lit(0), parts.cast("int")), lambda i: (start + F.bround((end - start) * i / parts, 0)).cast("int"))


def adaptive_count(content: Column, target: int, least: int, most: int) -> Column:
    return F.least(F.lit(most), F.greatest(F.lit(least), F.ceil(content / target))).cast("int")


def adaptive_overlap(tile: Column, ratio: float, least: int, most: int) -> Column:
    return F.least(F.lit(most), F.greatest(F.lit(least), F.bround(tile * ratio, 0))).cast("int")


def fit_to_budget(rows: Column, cols: Column, budget: int) -> Column:
    """``struct(r, c)`` within the budget that shrinks the longer axis least, then has most tiles, then the nearest aspect; the first on a tie."""
    ways = F.flatten(
        F.transform(
            F.sequence(F.lit(1), rows.cast("int")),
            lambda r: F.transform(
                F.sequence(F.lit(1), cols.cast("int")),
                lambda c: F.struct(F.greatest(rows / r, cols / c).alias("shrink"), (-r * c).alias("area"), F.abs(rows / cols - r / c).alias("aspect"), r.alias("r"), c.alias("c")),
            ),
        )
    )
    best = F.array_min(F.filter(ways, lambda w: -w["area"] <= budget))
    whole = F.struct(rows.cast("int").alias("r"), cols.cast("int").alias("c"))
    return F.when(rows * cols <= budget, whole).otherwise(F.struct(best["r"].alias("r"), best["c"].alias("c")))


def anchor_crops(pages: DataFrame, key: str, width: str, height: str, sizes: tuple[int, ...] = (800, 600, 500, 400), anchors: tuple[str, ...] = ("top_left", "top_right", "center", "bottom_left", "bottom_right")) -> DataFrame:
    """``(key, ord, x0, x1, y0, y1)`` of square crops by size and anchor, each box once at its first place."""
    crops = []
    for size in sizes:
        for name in anchors:
            fx, fy = ANCHORS[name]
            w, h = F.least(F.lit(size), F.col(width)).cast("int"), F.least(F.lit(size), F.col(height)).cast("int")
            x0 = F.floor((F.col(width) - w) * fx).cast("int")
            y0 = F.floor((F.col(height) - h) * fy).cast("int")
            crops.append(F.struct(x0.alias("x0"), (x0 + w).alias("x1"), y0.alias("y0"), (y0 + h).alias("y1")))
    real = pages.where((F.col(width) > 0) & (F.col(height) > 0))
    listed = real.select(key, F.posexplode(F.array_distinct(F.array(*crops))).alias("ord", "c"))
    return listed.select(key, (F.col("ord") + 1).alias("ord"), "c.x0", "c.x1", "c.y0", "c.y1")


def split_tile(tiles: DataFrame, key: str) -> DataFrame:
    """The four quarters of each tile in page pixels."""
    x, y = F.floor((F.col("x0") + F.col("x1")) / 2).cast("int"), F.floor((F.col("y0") + F.col("y1")) / 2).cast("int")
    quarter = lambda a, b, c, d: F.struct(a.alias("x0"), b.alias("x1"), c.alias("y0"), d.alias("y1"))
    x0, x1, y0, y1 = (F.col(c) for c in ("x0", "x1", "y0", "y1"))
    parts = F.array(quarter(x0, x, y0, y), quarter(x, x1, y0, y), quarter(x0, x, y, y1), quarter(x, x1, y, y1))
    return tiles.select(key, F.posexplode(parts).alias("quarter", "q")).select(key, "quarter", "q.*")


def low_content(text_pixels: Column, pixels: Column, ratio: Column, min_text: int = 0, min_pixels: int = 0, min_ratio: float = 0.0) -> Column:
    """Too little on a tile: too little text; or too few pixels and too low a ratio, as far as thresholds are set. Null densities are unknown, not low."""
    few, thin = pixels < min_pixels, ratio < min_ratio
    dense = few & thin if min_pixels > 0 and min_ratio > 0 else few if min_pixels > 0 else thin if min_ratio > 0 else F.lit(False)
    return F.coalesce(text_pixels < min_text, F.lit(False)) | F.coalesce(dense, F.lit(False))


def route(width: Column, height: Column, aspect: float = 0.12) -> Column:
    """``long`` for narrow strips, else ``table``; null without an extent."""
    return F.when((width > 0) & (height > 0), F.when(width / height <= aspect, F.lit("long")).otherwise(F.lit("table")))


def to_page(value: Column, tile0: Column, tile1: Column, size: Column) -> Column:
    """A coordinate of a scaled tile on the page."""
    return tile0 + value * (tile1 - tile0) / size


def content_grid(pages: DataFrame, key: str, rows: int, cols: int, overlap: int) -> DataFrame:
    """Tiles of equal parts of the content box ``bx0, bx1, by0, by1``, widened by the overlap but kept within the box."""
    xs, ys = even_edges(F.col("bx0"), F.col("bx1"), F.lit(cols)), even_edges(F.col("by0"), F.col("by1"), F.lit(rows))
    real = pages.where("bx1 > bx0 and by1 > by0").select(key, "bx0", "bx1", "by0", "by1", xs.alias("xs"), ys.alias("ys"))
    cells = real.withColumn("row", F.explode(F.sequence(F.lit(1), F.lit(rows)))).withColumn("col", F.explode(F.sequence(F.lit(1), F.lit(cols))))
    at = lambda edges, i: F.element_at(edges, i.cast("int"))
    return cells.select(
        key,
        "row",
        "col",
        F.greatest(F.col("bx0"), at("xs", F.col("col")) - F.when(F.col("col") > 1, overlap).otherwise(0)).alias("x0"),
        F.least(F.col("bx1"), at("xs", F.col("col") + 1) + F.when(F.col("col") < cols, overlap).otherwise(0)).alias("x1"),
        F.greatest(F.col("by0"), at("ys", F.col("row")) - F.when(F.col("row") > 1, overlap).otherwise(0)).alias("y0"),
        F.least(F.col("by1"), at("ys", F.col("row") + 1) + F.when(F.col("row") < rows, overlap).otherwise(0)).alias("y1"),
    )


def refine_first(width: Column, height: Column, target_w: int, target_h: int, depth: Column) -> Column:
    """A whole tile twice as large as wanted on either axis is cut before it is read."""
    return F.coalesce((depth == 0) & ((width > 2 * target_w) | (height > 2 * target_h)), F.lit(False))
