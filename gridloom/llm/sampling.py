"""Bounded samples for fitting; every other stage reads all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_RANGE = 1 << 30
#: Longest text that a fit is shown.
SAMPLE_CHARS = 20_000


def hash_sample(df: DataFrame, key: str, size: int, text: str) -> DataFrame:
    """Rows of about ``size`` keys chosen by the hash of ``key``; all rows if there are no more.

    One count and one filtered scan, in as many tasks as the table has; nothing
    is sorted or gathered. Rows without a key and texts over ``SAMPLE_CHARS``
    are not taken. A key that many rows repeat comes with all of them: callers
    reduce the rows first and keep each key once, so that what reaches the
    driver is about ``size`` narrow rows.
    """
    n = df.count()
    df = df.where(F.col(key).isNotNull() & (F.length(text) <= SAMPLE_CHARS))
    if n <= size:
        return df
    return df.where(F.pmod(F.xxhash64(key), F.lit(_RANGE)) < int(_RANGE * (size / n)))
