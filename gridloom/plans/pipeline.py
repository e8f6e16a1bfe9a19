"""Pages to result set: tiles, recognition, merging, gates and the template.

Recognisers are pluggable: any picklable object with ``read(tiles)`` that turns
a frame of tiles into texts. None is required; one that replays stored texts is
included. Tiles already in the cache table are not read again.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.tables import pipes_from_html, within_budget
from gridloom.functions.text import candidate_issue, duplicate_line_ratio, html_shape, let, looks_truncated, strip, table_markup, unstructured_table
from gridloom.operators.combine import expand_template
from gridloom.operators.geometry import route
from gridloom.operators.merge import merge_lines, rebuild_pages
from gridloom.plans.presets import Settings, as_dict
from gridloom.session import ship_package


class Recogniser(Protocol):
    def read(self, tile: dict) -> str: ...


class Replay:
    """Texts that are in the tiles already; for tests and for stored recognitions."""

    def read(self, tile: dict) -> str:
        if tile.get("stored") is None:
            raise ValueError("nothing is stored for the tile")
        return tile["stored"]


def namespace(s: Settings, *fields: str) -> str:
    """Digest of the settings that shape a tile; part of a cache's key."""
    chosen = {k: v for k, v in as_dict(s).items() if not fields or k in fields}
    return hashlib.sha1(json.dumps(chosen, sort_keys=True).encode()).hexdigest()[:10]


def call_with_retries(read, tile: dict, retries: int, delay: float = 0.0) -> str:
    """Up to ``retries`` further tries; waits double only when told to slow down (429)."""
    for attempt in range(retries + 1):
        try:
            return read(tile)
        except Exception as e:  # noqa: BLE001 - any failure of a recogniser counts
            if attempt == retries:
                raise
            time.sleep(delay * (2**attempt if "429" in str(e) else 1))
    raise AssertionError


def recognise(tiles: DataFrame, recogniser: Recogniser, s: Settings) -> DataFrame:
    """``(tile_id, text, error)`` of each tile, read in the executors."""
    ship_package(tiles.sparkSession)
    retries = s.retries

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for tile in frame.to_dict("records"):
                try:
                    rows.append((tile["tile_id"], call_with_retries(recogniser.read, tile, retries), None))
                except Exception as e:  # noqa: BLE001
                    rows.append((tile["tile_id"], None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["tile_id", "text", "error"])

    return tiles.mapInPandas(run, "tile_id string, text string, error string")


def with_cache(tiles: DataFrame, cache: DataFrame, recogniser: Recogniser, s: Settings) -> tuple[DataFrame, DataFrame]:
    """All texts, and those newly read (to be appended to the cache)."""
    held = cache.select("tile_id", "text").where("text is not null").dropDuplicates(["tile_id"])
    fresh = recognise(tiles.join(held, "tile_id", "left_anti"), recogniser, s)
    old = tiles.select("tile_id").join(held, "tile_id").withColumn("error", F.lit(None).cast("string"))
    return old.unionByName(fresh), fresh.where("error is null").select("tile_id", "text")


def page_budgets(texts: DataFrame, s: Settings) -> DataFrame:
    """By page: tiles, failures, the most frequent large output, and whether the page may be used."""
    digest = F.when(F.length("text") >= s.identical_chars, F.sha2("text", 256))
    same = texts.select("file_name", digest.alias("d")).where("d is not null").groupBy("file_name", "d").count().groupBy("file_name").agg(F.max("count").alias("same"))
    counted = texts.groupBy("file_name").agg(F.count("*").alias("n"), F.count("error").alias("failed"))
    rows = counted.join(same, "file_name", "left").withColumn("same", F.coalesce("same", F.lit(0)))
    usable = (
        (F.col("n") - F.col("failed") >= F.ceil(F.col("n") * s.success_share))
        & (F.col("failed") <= s.max_failures)
        & (F.col("failed") <= F.col("n") * s.max_failure_rate)
        & (F.col("same") < s.identical_limit)
    )
    return rows.withColumn("usable", usable)


def page_texts(tiles: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """``(file_name, text, strategy, issue)``: tables rebuilt from the grid, else lines merged in order; failed gates in ``issue``."""
    rows = tiles.join(texts, "tile_id")
    usable = page_budgets(rows, s).where("usable").select("file_name")
    kept = rows.join(usable, "file_name", "left_semi").where("text is not null")
    built = rebuild_pages(kept, "file_name").withColumnRenamed("text", "built")
    order = F.struct("row", "col", "text")
    lines = kept.groupBy("file_name").agg(F.max("page_w").alias("w"), F.max("page_h").alias("h"), F.sort_array(F.collect_list(order)).alias("parts"))
    merged = lines.select("file_name", route(F.col("w"), F.col("h"), s.long_aspect).alias("strategy"), merge_lines(F.transform("parts", lambda p: p["text"])).alias("merged"))
    out = merged.join(built, "file_name", "left").withColumn("text", F.coalesce("built", "merged")).drop("built", "merged")
    gate = candidate_issue("text", s.min_chars, s.max_blocks, s.max_cells, s.max_duplicate)
    return out.withColumn("issue", gate)


def output_text(text, s: Settings):
    """HTML tables as pipes where that loses nothing, within the byte budget where there is one; null where nothing fits it."""
    piped = F.coalesce(pipes_from_html(text), text)
    return within_budget(s.byte_budget)(piped) if s.byte_budget else piped


def submission(template: DataFrame, pages: DataFrame, s: Settings) -> DataFrame:
    """Every name of the template with its text or the placeholder."""
    good = pages.where("issue is null").select("file_name", output_text(F.col("text"), s).alias("text")).where("text is not null")
    if s.on_error == "raise":
        bad = F.when(F.col("issue").isNotNull(), F.raise_error(F.concat_ws(": ", "file_name", "issue"))).otherwise(F.col("text"))
        good = pages.select("file_name", bad.alias("text"))
    return expand_template(template, good, placeholder="" if s.on_error == "empty" else s.placeholder)


def table_score(text, parts=0, coverage=None):
    """0 to 100: tables, balance, cells, rows, parts, coverage and little repetition."""
    shape = html_shape(text)
    pipes = F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"^\s*\|.*\|\s*$")))
    cells, rows = F.greatest(shape["cells"], pipes * 2), F.greatest(shape["rows"], pipes)
    points = F.when(table_markup(text), 16).otherwise(0) + F.when(candidate_issue(text, 0).isNull(), 14).otherwise(0) + F.when(~looks_truncated(text), 14).otherwise(0)
    points = points + F.least(F.lit(24.0), cells / 18) + F.least(F.lit(14.0), rows / 6) + F.least(F.lit(10), F.lit(2) * parts)
    points = points + (F.when(coverage >= 0.75, 8).otherwise(0) if coverage is not None else 0) + F.when(duplicate_line_ratio(text) <= 0.18, 8).otherwise(0)
    return F.when(strip(F.coalesce(text, F.lit(""))) == "", 0.0).otherwise(points.cast("double"))


def better_repair(previous, repair, gain: int = 300, max_duplicate: float = 0.30):
    """Whether a repair replaces the text before: more structure, a score 8 higher, or no lower with more characters."""
    kind = lambda t: F.when(t.rlike("(?i)<table|\\|\\s*:?-{3,}"), 2).when(table_markup(t), 1).otherwise(0)

    def decide(s):
        old, new, a, b = s["old"], s["new"], s["a"], s["b"]
        longer = F.length(strip(new)) >= F.length(strip(old)) + gain
        better = (kind(new) > kind(old)) | (strip(old) == "") | (b >= a + 8) | ((b >= a) & longer)
        return (strip(new) != "") & (duplicate_line_ratio(new) <= max_duplicate) & better

    old, new = F.coalesce(previous, F.lit("")), F.coalesce(repair, F.lit(""))
    return let(F.struct(old.alias("old"), new.alias("new"), table_score(old).alias("a"), table_score(new).alias("b")), decide)


def wants_repair(text, content_pixels, min_chars: int = 600, density: float = 0.0):
    """A page whose text is short for what is on it, or that reads like a table without structure."""
    least = F.greatest(F.lit(min_chars), F.ceil(F.coalesce(content_pixels, F.lit(0)) * density))
    plain = F.coalesce(text, F.lit(""))
    return (F.length(strip(plain)) < least) | (unstructured_table(plain) & ~table_markup(plain))


def wants_local_matrix(text, width, height, content_pixels, s: Settings, gap=None, huge: int = 100_000_000, huge_gap: int = 8):
    """Whether boxes of a local recogniser are read: page area within the band, huge pages only with a gap in their numbers, and little text."""
    area, n = width * height, F.length(strip(F.coalesce(text, F.lit(""))))
    band = area >= s.local_min_pixels
    if s.local_max_pixels:
        band = band & (area <= s.local_max_pixels)
    if gap is not None:
        band = band & ((area < huge) | (F.coalesce(gap, F.lit(0)) >= huge_gap))
    thin = n <= s.trigger_chars
    if s.trigger_density:
        thin = thin | (n / F.greatest(content_pixels, F.lit(1)) <= s.trigger_density)
    return F.coalesce(band & thin & F.lit(s.local_ocr), F.lit(False))


def needed_tiles(n, least: int = 4, share: float = 0.75):
    """Tiles that must be read: all where there are few, else the larger of a floor and a share."""
    return F.when(n <= least, n).otherwise(F.greatest(F.lit(least), F.ceil(n * share)))
