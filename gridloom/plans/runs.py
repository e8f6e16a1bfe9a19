"""Whole runs: pages to a result set, repairs from stored readings, and experiments on labelled pages.

A run reads a tile once: what a recogniser gives is written to a table before
anything is planned on it, and texts go on to the cache. Tiles carry the source
of their page, not its pixels; a recogniser opens the page itself.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.pixels import image_size
from gridloom.functions.tables import table_stats
from gridloom.functions.text import let
from gridloom.operators import evaluate as scoring
from gridloom.operators.combine import guarded_overlay
from gridloom.operators.experiment import family_keys, grouped_split
from gridloom.operators.geometry import adaptive_count, adaptive_overlap, even_edges, fit_to_budget, grid_tiles, route
from gridloom.operators.lattice import matrices
from gridloom.operators.merge import remerge
from gridloom.plans.pipeline import Recogniser, better_repair, namespace, page_texts, recognise, submission, wants_local_matrix, wants_repair
from gridloom.plans.presets import Settings
from gridloom.session import cut_lineage, ship_package

#: Settings that shape tiles: texts in a cache are only those of tiles of the same shape.
SHAPE = ("tile_width", "tile_height", "overlap_ratio", "min_overlap", "call_budget", "long_aspect", "long_height", "long_overlap")
_PLACE = ("row", "col", "rows", "cols", "x0", "x1", "y0", "y1")
#: Most rows and columns of a grid before it is fitted to the budget of calls.
MOST_ROWS, MOST_COLS = 40, 40


@dataclass(frozen=True)
class Run:
    """What a run gives: the result set by template, pages with their gates, all tile texts, and failures as ``(file_name, source, error)``."""

    results: DataFrame
    pages: DataFrame
    texts: DataFrame
    errors: DataFrame


def recogniser_of(name: str) -> Recogniser:
    """The recogniser that ``module:name`` makes when called."""
    module, _, maker = name.partition(":")
    return getattr(importlib.import_module(module), maker)()


def sized_pages(images: DataFrame) -> DataFrame:
    """``(file_name, source, page_w, page_h)`` from the headers of images; pages that cannot be measured have nulls."""
    return images.select("file_name", "source", image_size("content").alias("z")).select("file_name", "source", F.col("z.width").alias("page_w"), F.col("z.height").alias("page_h"))


def plan_tiles(pages: DataFrame, s: Settings) -> DataFrame:
    """``(tile_id, file_name, source, strategy, row, col, rows, cols, x0, x1, y0, y1, page_w, page_h)``.

    Long pages are cut into strips, others into an even grid within the budget
    of calls. Pages without an extent have no tiles.
    """
    sized = pages.where("page_w > 0 and page_h > 0").withColumn("strategy", route(F.col("page_w"), F.col("page_h"), s.long_aspect))
    head = ("file_name", "source", "strategy", "page_w", "page_h")
    strips = grid_tiles(sized.where("strategy = 'long'").select("file_name", "page_w", "page_h"), "file_name", "page_w", "page_h", 1 << 30, s.long_height, 0, s.long_overlap)
    strips = strips.join(sized.select(*head), "file_name").select(*head, *_PLACE)
    counts = F.struct(adaptive_count(F.col("page_h"), s.tile_height, 1, MOST_ROWS).alias("r"), adaptive_count(F.col("page_w"), s.tile_width, 1, MOST_COLS).alias("c"))
    fitted = sized.where("strategy = 'table'").withColumn("n", let(counts, lambda n: F.when(n["r"] * n["c"] <= s.call_budget, n).otherwise(fit_to_budget(n["r"], n["c"], s.call_budget))))
    edged = fitted.select(*head, F.col("n.r").alias("rows"), F.col("n.c").alias("cols"), even_edges(F.lit(0), F.col("page_w"), F.col("n.c")).alias("xs"), even_edges(F.lit(0), F.col("page_h"), F.col("n.r")).alias("ys"))
    cells = edged.withColumn("row", F.explode(F.sequence(F.lit(1), "rows"))).withColumn("col", F.explode(F.sequence(F.lit(1), "cols")))
    edge = lambda edges, i: F.element_at(edges, i.cast("int"))

    def wide(edges: str, i: str, end: str) -> tuple:
        low, high = edge(F.col(edges), F.col(i)), edge(F.col(edges), F.col(i) + 1)
        over = adaptive_overlap(high - low, s.overlap_ratio, s.min_overlap, 10 * s.min_overlap)
        return F.greatest(F.lit(0), low - F.when(F.col(i) > 1, over).otherwise(0)).cast("int"), F.least(F.col(end), high).cast("int")

    (x0, x1), (y0, y1) = wide("xs", "col", "page_w"), wide("ys", "row", "page_h")
    grid = cells.select(*head, "row", "col", "rows", "cols", x0.alias("x0"), x1.alias("x1"), y0.alias("y0"), y1.alias("y1"))
    both = strips.select(*grid.columns).unionByName(grid)
    return both.select(F.concat_ws("/", F.lit(namespace(s, *SHAPE)), "file_name", *[F.col(c).cast("string") for c in ("x0", "x1", "y0", "y1")]).alias("tile_id"), *both.columns)


def _cache(spark: SparkSession, path: str | None) -> DataFrame:
    if path is not None:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            return spark.read.schema("tile_id string, text string").parquet(path)
    return spark.createDataFrame([], "tile_id string, text string")


def predict(pages: DataFrame, template: DataFrame, recogniser: Recogniser, s: Settings, cache: str | None = None) -> Run:
    """Tiles, readings, merged pages and the result set. Only tiles that the cache lacks are read; new texts are appended to it."""
    spark = pages.sparkSession
    tiles = cut_lineage(plan_tiles(pages, s))
    held = _cache(spark, cache).where("text is not null").dropDuplicates(["tile_id"])
    held = cut_lineage(held.join(tiles.select("tile_id"), "tile_id", "left_semi"))
    fresh = cut_lineage(recognise(tiles.join(held, "tile_id", "left_anti"), recogniser, s))
    if cache is not None:
        fresh.where("error is null").select("tile_id", "text").write.mode("append").parquet(cache)
    texts = held.withColumn("error", F.lit(None).cast("string")).unionByName(fresh)
    merged = cut_lineage(page_texts(tiles, texts, s))
    return Run(submission(template, merged, s), merged, texts, _errors(pages, tiles, texts, merged))


def _errors(pages: DataFrame, tiles: DataFrame, texts: DataFrame, merged: DataFrame) -> DataFrame:
    by_tile = tiles.join(texts.where("error is not null"), "tile_id").select("file_name", F.col("tile_id").alias("source"), "error")
    by_gate = merged.where("issue is not null").select("file_name", F.lit("page").alias("source"), F.col("issue").alias("error"))
    unsized = pages.where("not coalesce(page_w > 0 and page_h > 0, false)").select("file_name", "source", F.lit("the page has no size").alias("error"))
    return by_tile.unionByName(by_gate).unionByName(unsized)


def baseline(pages: DataFrame, template: DataFrame, recogniser: Recogniser, s: Settings, cache: str | None = None, boxes: DataFrame | None = None) -> Run:
    """A run, then two repairs where a page's text is thin or not structured: tiles of half the size, and matrices laid out of boxes.

    A repair is taken only if it is the better text. ``boxes`` are text boxes of
    pages (``file_name, x, y, width, height, confidence, text``).
    """
    first = predict(pages, template, recogniser, s, cache)
    thin = first.pages.where(F.col("issue").isNotNull() | wants_repair(F.col("text"), F.lit(0), s.min_chars)).where("strategy = 'table'").select("file_name")
    again = pages.join(thin, "file_name", "left_semi")
    half = replace(s, tile_width=max(1, s.tile_width // 2), tile_height=max(1, s.tile_height // 2))
    second = predict(again, template, recogniser, half, cache)
    merged = repaired(first.pages, second.pages.where("issue is null").select("file_name", "text"))
    if boxes is not None:
        merged = rebuilt_matrices(merged, boxes, pages, s)
    merged = cut_lineage(merged)
    errors = first.errors.where("source <> 'page'").unionByName(second.errors.where("source <> 'page'"))
    by_gate = merged.where("issue is not null").select("file_name", F.lit("page").alias("source"), F.col("issue").alias("error"))
    return Run(submission(template, merged, s), merged, first.texts.unionByName(second.texts), errors.unionByName(by_gate))


def repaired(pages: DataFrame, repairs: DataFrame) -> DataFrame:
    """Pages with the repair's text, and no issue, where that is the better one; others as they are."""
    both = pages.join(repairs.select("file_name", F.col("text").alias("_new")), "file_name", "left")
    both = both.withColumn("_better", F.col("_new").isNotNull() & better_repair(F.col("text"), F.col("_new")))
    return both.withColumn("text", F.when(F.col("_better"), F.col("_new")).otherwise(F.col("text"))).withColumn("issue", F.when(~F.col("_better"), F.col("issue"))).drop("_new", "_better")


def rebuilt_matrices(pages: DataFrame, boxes: DataFrame, sizes: DataFrame, s: Settings) -> DataFrame:
    """Pages whose size and text call for it get the matrix laid out of their stored boxes, where that is the better text."""
    called = pages.join(sizes.select("file_name", "page_w", "page_h"), "file_name")
    called = called.where(wants_local_matrix(F.col("text"), F.col("page_w").cast("bigint"), F.col("page_h"), F.lit(None).cast("bigint"), replace(s, local_ocr=True))).select("file_name")
    laid = matrices(boxes.join(called, "file_name", "left_semi"), "file_name").where("text is not null")
    return repaired(pages, laid)


def remerged(base: DataFrame, tiles: DataFrame, max_duplicate: float = 0.30) -> DataFrame:
    """``base`` with pages rebuilt from stored tiles ``(stem, row, col, text)`` where that only repairs them, and ``changed``.

    A page has few tiles, which are gathered by page; pages without tiles stay.
    """
    ship_package(base.sparkSession)
    stem = F.regexp_replace("file_name", r"\.[^.]*$", "")
    listed = tiles.groupBy("stem").agg(F.sort_array(F.collect_list(F.struct("row", "col", F.coalesce("text", F.lit("")).alias("text")))).alias("tiles"))
    known = base.select("file_name", "text", stem.alias("stem")).where("text is not null").join(listed, "stem").select("file_name", "text", "tiles")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [remerge(t, [tuple(x.values()) for x in parts], max_duplicate) for t, parts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["file_name", "_new"])

    new = known.mapInArrow(build, "file_name string, _new string").where("_new is not null")
    both = base.join(new, "file_name", "left")
    return both.withColumn("changed", F.coalesce(F.col("_new") != F.col("text"), F.lit(False))).withColumn("text", F.coalesce("_new", "text")).drop("_new")


def overlaid(base: DataFrame, *overrides: DataFrame, **guards) -> DataFrame:
    """The guarded overlay of several override sets, the later over the earlier."""
    for rows in overrides:
        base = guarded_overlay(base.drop("accepted"), rows, **guards)
    return base


def label_features(labels: DataFrame, pages: DataFrame, run: str = "train") -> DataFrame:
    """``(run_id, file_name, family, gt_tables, gt_length, pixels)`` of labelled pages; texts are reduced where they are read."""
    ship_package(labels.sparkSession)
    texts = labels.select("file_name", F.lit(run).alias("run_id"), family_keys("text").alias("family"), table_stats("text")["tables"].alias("gt_tables"), F.length("text").cast("bigint").alias("gt_length"))
    return texts.join(pages.select("file_name", (F.col("page_w").cast("bigint") * F.col("page_h")).alias("pixels")), "file_name", "left").withColumn("family", F.when(F.col("family") != "", F.col("family")))


def train_experiment(pages: DataFrame, labels: DataFrame, recogniser: Recogniser, s: Settings, shares: dict[str, float], cache: str | None = None) -> DataFrame:
    """Scores of labelled pages with the split each is in; families of pages stay in one split. ``scores_by_split`` sums them up."""
    split = cut_lineage(grouped_split(label_features(labels, pages), shares).select("file_name", "split"))
    wanted = pages.join(split, "file_name", "left_semi")
    run = baseline(wanted, split.select("file_name"), recogniser, s, cache)
    scores = scoring.evaluate(run.results, labels)
    return scores.join(split, "file_name")


def scores_by_split(scores: DataFrame) -> DataFrame:
    """Pairs and mean scores of each split and of all together (null)."""
    names = ("text", "reading_order", "structure", "markdown", "overall")
    return scores.rollup("split").agg(F.count("*").alias("n_pairs"), *[F.avg(n).alias(f"mean_{n}") for n in names])


def manifest(tiles: DataFrame) -> DataFrame:
    """What a cache of tile texts holds: tiles and their extent by page, to be checked before stored boxes are used again."""
    return tiles.groupBy("file_name").agg(F.count("*").alias("n_tiles"), F.max("x1").alias("page_w"), F.max("y1").alias("page_h"), F.bit_xor(F.xxhash64("tile_id")).alias("digest"))


