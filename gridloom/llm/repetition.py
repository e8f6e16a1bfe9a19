"""Repetition inside a single text, with risk-controlled cutoffs.

Share: the part of the core that lies in passages of ``PASSAGE`` or more core
characters that stood earlier in the same text (an overlapping earlier place
counts: a loop repeats itself). It is computed exactly, from the first places
of all runs of that length, where it is asked for.

Score: the part of the runs of ``RUN`` characters whose place in a bitmap sketch
is taken again, which needs no sort. A passage of ``PASSAGE`` repeated
characters has at least ``PASSAGE - RUN + 1`` repeated runs, and places that
different runs share only raise the score, so a text of which a third is
repeated never scores below ``FLOOR``.

Cutoffs: all rows of the table are labelled (the label is the exact share, which
is worked out for rows that score ``FLOOR`` or more; below it no row is a case)
and put into strata by script and length. For each stratum and each cutoff of
``GRID`` the false rejections, rows that are no case but would be rejected by
their score, are counted over the whole table and bounded from above by the
exact binomial (Clopper-Pearson) limit at level ``DELTA``, shared out over all
tests (Bonferroni). The lowest cutoff whose bound is at most ``ALPHA`` is taken;
a stratum too small to certify any has none.

A row is rejected if its score reaches the cutoff of its stratum. Between
``FLOOR`` and the cutoff the exact share decides. So no case is lost, and false
rejections are limited as certified; the rows found are the rejected ones whose
exact share confirms them, so none of them is false.

Null and empty texts have an empty core and share 0.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.text_core import core, join_codes, rolling, slices
from gridloom.session import cut_lineage, ship_package

PASSAGE, RUN, CASE = 20, 12, 1 / 3
#: The least score of a case: a third of the characters, of which a passage has this part as starts of repeated runs.
FLOOR = CASE * (PASSAGE - RUN + 1) / PASSAGE
ALPHA, DELTA = 0.01, 0.05
GRID = (CASE, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
#: Core characters up to which a text is short, middling or long.
SIZES = (400, 1_200)
#: Places of the sketch for each run at least, and largest sketch (as a power of two); texts beyond it have no score.
PLACES, LARGEST = 32, 24


def _runs(cores: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs (different for each text), the text and the place of each, and the sizes of the texts."""
    joined, ends = join_codes(cores)
    size = np.diff(ends)
    hashes = rolling(joined, width)
    text = np.repeat(np.arange(len(cores)), size)[: len(hashes)]
    at = np.arange(len(hashes))
    inside = at + width <= ends[text + 1] if len(hashes) else np.zeros(0, np.bool_)
    text, at = text[inside], at[inside]
    return hashes[inside] ^ (text.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), text, at, size


def repeated_shares(cores: list[str]) -> np.ndarray:
    """Repeated core characters of each core, over its length."""
    keys, text, at, size = _runs(cores, PASSAGE)
    order = np.argsort(keys, kind="stable")  # within equal keys by place
    again = np.zeros(len(keys), np.bool_)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    starts = at[again]
    if not len(starts):
        return np.zeros(len(cores))
    covered = np.minimum(PASSAGE, np.append(np.diff(starts), PASSAGE))
    return np.bincount(text[again], weights=covered, minlength=len(cores)) / np.maximum(1, size)


def sketch_scores(cores: list[str]) -> np.ndarray:
    """Part of the runs of each core whose place in the sketch a later run takes; NaN where the sketch is too small."""
    keys, text, _, size = _runs(cores, RUN)
    bits = min(LARGEST, max(10, int(len(keys) * PLACES).bit_length()))
    if len(keys) * PLACES > 1 << bits:
        return np.full(len(cores), np.nan)
    place = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)
    number = np.arange(len(keys), dtype=np.int32)
    sketch = np.empty(1 << bits, np.int32)
    sketch[place] = number
    again = sketch[place] != number
    return np.bincount(text[again], minlength=len(cores)) / np.maximum(1, size - RUN + 1)


def judged(cores: list[str], cutoffs: dict[str, float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(score, cutoff, rejected)`` of each core; the cutoff is NaN where a stratum has none."""
    score = sketch_scores(cores)
    cutoff = np.array([cutoffs.get(stratum(c), np.nan) for c in cores])
    with np.errstate(invalid="ignore"):
        rejected = score >= cutoff
        unsure = np.flatnonzero(~rejected & ~(score < FLOOR - 1e-12))
    rejected[unsure] = repeated_shares([cores[i] for i in unsure]) * 3 >= 1.0 - 1e-12
    return score, cutoff, rejected


def stratum(text_core: str) -> str:
    size = "short" if len(text_core) <= SIZES[0] else "middling" if len(text_core) <= SIZES[1] else "long"
    return ("latin" if text_core.isascii() else "other") + "-" + size


def binomial_upper(k: int, n: int, level: float) -> float:
    """Clopper-Pearson: the largest rate under which k or fewer of n have probability ``level``."""
    if k >= n:
        return 1.0
    last = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    def tail(p: float) -> float:
        term = total = 1.0
        for i in range(k, 0, -1):  # terms fall below k, so few of them count in a large table
            term *= i / (n - i + 1) * (1 - p) / p
            total += term
            if term < total * 1e-17:
                break
        return total * math.exp(last + k * math.log(p) + (n - k) * math.log1p(-p))

    low, high = k / n, 1.0
    for _ in range(60):
        p = (low + high) / 2
        low, high = (p, high) if 0 < p < 1 and tail(p) > level or p == 0 else (low, p)
    return high


def select_cutoffs(rows: list[tuple[str, float, bool]]) -> dict[str, tuple[float | None, int, int, float]]:
    """:func:`certified` cutoffs of (stratum, score, label) rows."""
    counts: dict[str, list[int]] = defaultdict(lambda: [0] * (1 + len(GRID)))
    for name, score, label in rows:
        for i, least in enumerate((-math.inf, *GRID)):
            counts[name][i] += not label and score >= least  # a stratum of cases only is still one
    return certified(counts)


def certified(counts: dict[str, list[int]]) -> dict[str, tuple[float | None, int, int, float]]:
    """``stratum -> (cutoff or None, rows that are no case, false rejections, bound)``.

    ``counts`` has for each stratum the rows that are no case, then those of them at or above each cutoff of ``GRID``.
    Without a cutoff the figures are those of the highest of ``GRID``.
    """
    out = {}
    level = DELTA / max(1, len(counts) * len(GRID))
    for name, (n, *false) in sorted(counts.items()):
        for cutoff, k in zip(GRID, false):
            bound = binomial_upper(k, n, level) if n else 1.0
            out[name] = (cutoff if bound <= ALPHA else None, n, k, bound)
            if bound <= ALPHA:
                break
    return out


def _scored(cells: DataFrame, text: str, key: str, exact: bool) -> DataFrame:
    """``(key, source, n_core, stratum, share, score, label)`` of each row once; the share of all rows, or else of those that can be cases."""
    ship_package(cells.sparkSession)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for start, end in slices(texts, 250, 200_000):
                cores = [core(t) for t in texts[start:end]]
                score, share = sketch_scores(cores), np.full(len(cores), np.nan)
                asked = np.arange(len(cores)) if exact else np.flatnonzero(~(score < FLOOR - 1e-12))
                share[asked] = repeated_shares([cores[i] for i in asked])
                size = np.array([len(c) for c in cores])
                with np.errstate(invalid="ignore"):
                    label = (share * 3 >= 1.0 - 1e-12) & (size > 0)
                columns = [pa.array(size, pa.int64()), pa.array([stratum(c) for c in cores], pa.string()), pa.array(share, from_pandas=True), pa.array(score, from_pandas=True), pa.array(label)]
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(start, end - start) for k in (0, 1)), *columns], names=[key, "source", "n_core", "stratum", "share", "score", "label"])

    kind = cells.schema[key].dataType.simpleString()
    source = F.col("source") if "source" in cells.columns else F.lit(None).cast("string").alias("source")
    out = cells.select(key, source, text).mapInArrow(measure, f"`{key}` {kind}, source string, n_core bigint, stratum string, share double, score double, label boolean")
    return out.dropDuplicates([key])  # after the map, so that no text is shuffled


def _cutoffs(scored: DataFrame) -> dict[str, tuple[float | None, int, int, float]]:
    """Cutoffs certified on all rows; what reaches the driver is a row of counts for each stratum."""
    false = [F.count_if(~F.col("label") & (F.col("score") >= cutoff)) for cutoff in GRID]
    counts = scored.groupBy("stratum").agg(F.count_if(~F.col("label")), *false)
    return certified({name: n for name, *n in counts.collect()})


def holdout_cutoffs(cells: DataFrame, text: str = "ground_truth", key: str = "row_id") -> dict[str, tuple[float | None, int, int, float]]:
    return _cutoffs(_scored(cells, text, key, False))


def _measured(cells: DataFrame, text: str, key: str, exact: bool) -> DataFrame:
    scored = cut_lineage(_scored(cells, text, key, exact))  # scores and labels that the cutoffs are counted on are those they are applied to
    cutoff = F.lit(None).cast("double")
    for name, (value, *_) in _cutoffs(scored).items():
        if value is not None:
            cutoff = F.when(F.col("stratum") == name, F.lit(value)).otherwise(cutoff)
    return scored.withColumn("cutoff", cutoff).withColumn("rejected", F.col("label") | F.coalesce(F.col("score") >= F.col("cutoff"), F.lit(False)))


def repetition(cells: DataFrame, text: str = "ground_truth", key: str = "row_id") -> DataFrame:
    """``(key, source, n_core, share, score, cutoff, rejected)`` of each row once, with the exact share of all rows."""
    return _measured(cells, text, key, True).select(key, "source", "n_core", "share", "score", "cutoff", "rejected")


def repetitive_rows(cells: DataFrame, text: str = "ground_truth", key: str = "row_id") -> DataFrame:
    """Rejected rows whose exact share confirms them."""
    return _measured(cells, text, key, False).where(F.col("rejected") & F.col("label")).select(key)


def cutoff_table(spark: SparkSession, cells: DataFrame) -> DataFrame:
    rows = [(k, *v) for k, v in holdout_cutoffs(cells).items()]
    return spark.createDataFrame(rows, "stratum string, cutoff double, n_holdout int, n_false int, bound double")
