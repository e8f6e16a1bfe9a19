"""Result sets as CSV: ``file_name,ground_truth``, quotes doubled, texts over several lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions.text import strip
from gridloom.operators.combine import last_per_name

HEADER = ("file_name", "ground_truth")
_DIALECT = {"header": "true", "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1", "encoding": "UTF-8"}


def read_results(spark: SparkSession, path: str, duplicates: str = "last") -> DataFrame:
    """``(ord, file_name, text)``.

    ``duplicates``: ``last`` keeps the last row of a name and drops unnamed
    rows; ``error`` fails on unnamed and repeated names when rows are read.
    Raises at once if the header is not exactly that of a result set.
    """
    rows = spark.read.options(**_DIALECT).csv(path)
    found = tuple(c.lstrip("\ufeff") for c in rows.columns)
    if found != HEADER:
        raise ValueError(f"the header is {','.join(found)}")
    rows = rows.toDF("file_name", "text").select(F.monotonically_increasing_id().alias("ord"), strip(F.col("file_name")).alias("file_name"), F.coalesce("text", F.lit("")).alias("text"))
    if duplicates == "last":
        return last_per_name(rows)
    name = F.col("file_name")
    times = F.count("*").over(Window.partitionBy("file_name"))
    checked = F.when(name.isNull() | (name == ""), F.raise_error(F.lit("a row has no name"))).when(times > 1, F.raise_error(F.concat(F.lit("more than one row for "), name)))
    return rows.withColumn("file_name", F.coalesce(checked.cast("string"), name))


def _write(ordered: DataFrame, path: str, single: bool, **options: str) -> None:
    """Parts in the order of their names. One file is for small results: rows are worked out and sorted before it, but written by one task."""
    (ordered.coalesce(1) if single else ordered).write.mode("overwrite").options(header="true", **options).csv(path)


def write_results(rows: DataFrame, path: str, text: str = "text", order: str = "ord", single: bool = False) -> None:
    """Result sets in order, each part with the header; ``single`` writes one file."""
    ordered = rows.orderBy(order) if order in rows.columns else rows.orderBy("file_name")
    out = ordered.select("file_name", F.coalesce(text, F.lit("")).alias("ground_truth"))
    _write(out, path, single, escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false", emptyValue="")


def write_scores(scores: DataFrame, path: str, single: bool = False) -> None:
    """Scores with six decimals, by name."""
    columns = [F.format_string("%.6f", c).alias(c) if t == "double" else F.col(c) for c, t in scores.dtypes]
    _write(scores.select(*columns).orderBy(scores.columns[0]), path, single)


def write_errors(rows: DataFrame, path: str, single: bool = False) -> bool:
    """``file_name, source, error``, only if there is any."""
    if rows.isEmpty():
        return False
    _write(rows.select("file_name", "source", "error").orderBy("file_name", "source"), path, single, escape='"')
    return True
