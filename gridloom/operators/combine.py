"""Relational combination of keyed result sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.text import duplicate_line_ratio, html_issue, strip


def _length(c: Column) -> Column:
    return F.length(F.coalesce(strip(c), F.lit("")))


def last_per_name(rows: DataFrame, name: str = "file_name", order: tuple[str, ...] = ("ord",)) -> DataFrame:
    """Of rows with the same name the last in order wins; null and empty names are dropped."""
    named = rows.where(F.col(name).isNotNull() & (strip(F.col(name)) != ""))
    others = [c for c in rows.columns if c != name]
    best = F.max_by(F.struct(*others), F.struct(*order))  # combined before the shuffle; nulls come lowest
    return named.groupBy(name).agg(best.alias("_row")).select(name, "_row.*").select(*rows.columns)


def guarded_overlay(
    base: DataFrame, overrides: DataFrame, key: str = "file_name", text: str = "text", min_ratio: float = 0.0, min_gain: int = 0, max_duplicate: float = 1.0
) -> DataFrame:
    """Base rows with the override's text where it passes the guards.

    An override is skipped if it is shorter than ``min_ratio`` of the base,
    gains less than ``min_gain`` characters, breaks the nesting of its tables
    or repeats more lines than allowed. Lengths are those of stripped texts; a
    null text has length 0. Base rows without override stay. Keys of the
    overrides must be unique; null keys never match.
    """
    new = overrides.select(F.col(key), F.col(text).alias("_new"))
    n_base, n_new = _length(F.col(text)), _length(F.col("_new"))
    accept = (
        F.col("_new").isNotNull()
        & (n_new >= n_base * min_ratio)
        & (n_new - n_base >= min_gain)
        & html_issue("_new").isNull()
        & (duplicate_line_ratio("_new") <= max_duplicate)
    )
    joined = base.join(new, key, "left").withColumn("accepted", F.coalesce(accept, F.lit(False)))
    return joined.withColumn(text, F.when(F.col("accepted"), F.col("_new")).otherwise(F.col(text))).drop("_new")


def unknown_overrides(base: DataFrame, overrides: DataFrame, key: str = "file_name") -> DataFrame:
    return overrides.join(base.select(key), key, "left_anti").select(key)


def collapsed_fallback(
    primary: DataFrame, fallback: DataFrame, key: str = "file_name", text: str = "text", max_chars: int = 200, max_ratio: float = 0.5, need_table: bool = False
) -> DataFrame:
    """Primary rows, with the fallback's text where the primary collapsed: short, and a small part of the fallback."""
    other = fallback.select(key, F.col(text).alias("_other"))
    n, m = _length(F.col(text)), _length(F.col("_other"))
    use = (n <= max_chars) & (m > 0) & (n < m * max_ratio)
    if need_table:
        use = use & F.lower("_other").contains("<table")
    rows = primary.join(other, key).withColumn("fell_back", F.coalesce(use, F.lit(False)))
    return rows.withColumn(text, F.when(F.col("fell_back"), F.col("_other")).otherwise(F.col(text))).drop("_other")


def expand_template(template: DataFrame, results: DataFrame, key: str = "file_name", text: str = "text", placeholder: str = "<table></table>") -> DataFrame:
    """Every row of the template with its result, or the placeholder where there is none or only an empty one."""
    found = results.select(key, F.col(text).alias(text))
    rows = template.select(key).join(found, key, "left")
    missing = F.col(text).isNull() | (strip(F.col(text)) == "")
    return rows.withColumn("missing", missing).withColumn(text, F.when(missing, F.lit(placeholder)).otherwise(F.col(text)))


def reconcile(predictions: DataFrame, truths: DataFrame, key: str = "file_name") -> DataFrame:
    """``(key, status)``: matched, missing (truth only) or unknown (prediction only); each name once."""
    a = predictions.where(F.col(key).isNotNull()).select(key).distinct().withColumn("_p", F.lit(True))
    b = truths.where(F.col(key).isNotNull()).select(key).distinct().withColumn("_t", F.lit(True))
    status = F.when(F.col("_p").isNull(), F.lit("missing")).when(F.col("_t").isNull(), F.lit("unknown")).otherwise(F.lit("matched"))
    return a.join(b, key, "full_outer").select(key, status.alias("status"))


def validation_report(rows: DataFrame, expected: DataFrame, key: str = "file_name", text: str = "text") -> DataFrame:
    """One row of counts: rows, bytes, empty names, repeated names, blank texts, broken tables, missing and unknown names."""
    name = strip(F.col(key))
    named = rows.select(name.alias("_name"), F.col(text).alias("_text"))
    counted = named.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum(F.octet_length(F.coalesce("_text", F.lit("")))), F.lit(0)).alias("n_bytes"),
        F.count_if(F.coalesce(F.col("_name"), F.lit("")) == "").alias("n_unnamed"),
        F.count_if(_length(F.col("_text")) == 0).alias("n_blank"),
        F.count_if(html_issue("_text").isNotNull()).alias("n_broken"),
    )
    repeated = named.where("_name <> ''").groupBy("_name").count().where("count > 1").agg(F.count("*").alias("n_repeated"))
    sides = reconcile(named.where("_name <> ''").withColumnRenamed("_name", key), expected, key)
    names = sides.agg(F.count_if(F.col("status") == "missing").alias("n_missing"), F.count_if(F.col("status") == "unknown").alias("n_unknown"))
    return counted.join(repeated).join(names)  # three single rows


def fill_cells(base: DataFrame, local: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Cell-wise coalesce of base and local rows with the same key; base rows all stay, once for each of their own."""
    other = local.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    rows = base.join(other, key, "left")
    return rows.select(key, *[F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) for c in columns])


def complete_grid(tiles: DataFrame, key: str, rows: str = "rows", cols: str = "cols", row: str = "row", col: str = "col") -> DataFrame:
    """Every place of each page's grid with whether a tile is there: sequences, not a join of all with all."""
    grid = tiles.where(F.col(key).isNotNull() & (F.col(rows) > 0) & (F.col(cols) > 0)).groupBy(key).agg(F.max(rows).alias("_r"), F.max(cols).alias("_c"))
    places = grid.withColumn(row, F.explode(F.sequence(F.lit(1), "_r"))).withColumn(col, F.explode(F.sequence(F.lit(1), "_c"))).drop("_r", "_c")
    there = tiles.select(key, row, col).distinct().withColumn("_there", F.lit(True))
    return places.join(there, [key, row, col], "left").select(key, row, col, F.coalesce("_there", F.lit(False)).alias("present"))


def identical_outputs(rows: DataFrame, key: str, text: str = "text", min_chars: int = 1_000, threshold: int = 3) -> DataFrame:
    """``(digest, n)`` of large outputs that come ``threshold`` times or more."""
    large = rows.where(F.length(text) >= min_chars)
    return large.groupBy(F.sha2(F.col(text), 256).alias("digest")).agg(F.count("*").alias("n"), F.min(key).alias("first")).where(F.col("n") >= threshold)


def not_cached(rows: DataFrame, cache: DataFrame, key: str = "file_name") -> DataFrame:
    """Rows whose key has no entry in the cache, by digest."""
    digest = F.sha1(F.col(key).cast("string"))
    held = cache.select(digest.alias("_digest")).distinct()
    return rows.withColumn("_digest", digest).join(held, "_digest", "left_anti").drop("_digest")


def worst(rows: DataFrame, score: str, key: str, k: int = 10) -> DataFrame:
    """The k lowest scores, ties by key."""
    return rows.orderBy(F.col(score).asc_nulls_last(), F.col(key).asc_nulls_last()).limit(k)
