"""Evaluation splits that keep families together and balance strata."""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from gridloom.functions.tables import document_grids
from gridloom.operators.sequences import quantile_bucket


def _masked(text: str) -> str:
    text = unicodedata.normalize("NFKC", html.unescape(text)).strip("# ")
    text = re.sub(r"\d+(?:[.,]\d+)?", "#", re.sub(r"\s+", " ", text))
    return "".join(c for c in text if c == "#" or c.isalnum())


def family_key(text: str) -> str:
    """The first filled line before the first table, numbers masked; else the first cells; else the first line."""
    before = re.split(r"<table\b", text, maxsplit=1, flags=re.I)[0]
    for line in before.splitlines():
        if (key := _masked(line)[:96]):
            return key
    for grid in document_grids(text):
        cells = [c for r in (grid.header, *grid.rows) for c in r][:16]
        return " | ".join(_masked(c) for c in cells)[:256]
    return next((_masked(x) for x in text.splitlines() if x.strip()), "")


@F.pandas_udf(StringType())
def family_keys(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else family_key(t))


def place_families(families: list[tuple[str, dict[tuple, int]]], targets: dict[str, int]) -> dict[str, str]:
    """Family -> split: the largest first, each to the split of least overflow, use and crowding of its strata."""
    totals: Counter = Counter()
    for _, strata in families:
        totals.update(strata)
    n, used = max(1, sum(totals.values())), {s: 0 for s in targets}
    held: dict[str, Counter] = {s: Counter() for s in targets}
    out = {}
    for name, strata in sorted(families, key=lambda f: (-sum(f[1].values()), f[0])):
        size = sum(strata.values())

        def cost(split: str) -> tuple[float, float]:
            target = max(1, targets[split])
            new = used[split] + size
            crowd = sum((held[split][k] + c) / max(1.0, totals[k] * target / n) for k, c in strata.items()) / len(strata)
            return 1000.0 * max(0, new - target) + new / target + crowd, used[split] / target

        split = min(targets, key=cost)
        out[name] = split
        used[split] += size
        held[split].update(strata)
    return out


#: Families over this part of a run are placed one by one (fewer than 1 / BIG of them), the others by running weight.
BIG = 0.005
_BUCKETS = 1_024


def by_running_weight(sized: DataFrame, loads: DataFrame, shares: dict[str, float], run: str, item: str) -> DataFrame:
    """``(run, item, split)``: items in the order of a hash, each where the middle of its weight falls in the room that is left.

    ``sized`` has ``run, item, w, all`` (weights of the item and of the run),
    ``loads`` has ``run, load`` (an array: what each split holds already). Weights
    are summed in two levels, so that no run is summed in one task.
    """
    names, wanted = list(shares), F.array(*[F.lit(float(v)) for v in shares.values()])
    rows = sized.withColumn("_bucket", F.pmod(F.xxhash64(item), F.lit(_BUCKETS)))
    level = rows.groupBy(run, "_bucket").agg(F.sum("w").alias("_bw"))
    before = level.withColumn("_before", F.sum("_bw").over(Window.partitionBy(run).orderBy("_bucket")) - F.col("_bw")).drop("_bw")  # at most _BUCKETS rows a run
    within = Window.partitionBy(run, "_bucket").orderBy(item)
    rows = rows.join(before, [run, "_bucket"]).withColumn("_mid", F.col("_before") + F.sum("w").over(within) - F.col("w") / 2)
    rows = rows.join(loads, run, "left")
    load = F.coalesce("load", F.array(*[F.lit(0.0)] * len(names)))
    room = F.zip_with(wanted, load, lambda share, used: F.greatest(F.lit(0.0), share * F.col("all") - used))
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda a, b: a + b)
    scale = (F.col("all") - total(load)) / F.greatest(F.lit(1e-9), total(room))
    edges = F.aggregate(room, F.array().cast("array<double>"), lambda acc, r: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0)) + r * scale)))
    at = F.least(F.lit(len(names)), F.size(F.filter(edges, lambda e: e <= F.col("_mid"))) + 1)
    return rows.select(run, item, F.element_at(F.array(*[F.lit(n) for n in names]), at).alias("split"))


def grouped_split(rows: DataFrame, shares: dict[str, float], run: str = "run_id", family: str = "family") -> DataFrame:
    """Rows with ``split``; a family of a run is never divided. Null families stand alone.

    Strata are buckets of tables, length and pixels. Families over ``BIG`` of a
    run are placed one after another on their counts by stratum, the largest
    first; there are fewer than ``1 / BIG`` of them. The others follow by
    running weight, which spreads strata evenly by its hashed order, so neither
    rows nor families of a run are gathered.
    """
    bucketed = quantile_bucket(rows, "gt_length", 8, run).withColumnRenamed("bucket", "_l")
    bucketed = quantile_bucket(bucketed, "pixels", 8, run).withColumnRenamed("bucket", "_p")
    named = bucketed.withColumn("_family", F.coalesce(F.col(family), F.concat(F.lit("\u0001"), F.col("file_name"))))
    stratum = F.concat_ws("/", F.least(F.coalesce("gt_tables", F.lit(0)), F.lit(3)), F.coalesce("_l", F.lit(-1)), F.coalesce("_p", F.lit(-1)))
    counted = named.groupBy(run, "_family", stratum.alias("_s")).agg(F.count("*").alias("_n"))
    sized = counted.groupBy(run, "_family").agg(F.sum("_n").alias("w"))
    sized = sized.join(sized.groupBy(run).agg(F.sum("w").alias("all")), run)
    is_big = F.col("w") > F.col("all") * BIG
    names = list(shares)

    def place(part: pd.DataFrame) -> pd.DataFrame:
        families = [(name, dict(zip(g["_s"], g["_n"].astype(int)))) for name, g in part.groupby("_family")]
        total = int(part["all"].iloc[0])
        chosen = place_families(families, {s: round(total * share) for s, share in shares.items()})
        return pd.DataFrame({run: part[run].iloc[0], "_family": list(chosen), "split": list(chosen.values())})

    kind = rows.schema[run].dataType.simpleString()
    placed = counted.join(sized.where(is_big).select(run, "_family", "all"), [run, "_family"]).groupBy(run).applyInPandas(place, f"`{run}` {kind}, _family string, split string")
    held = placed.join(sized, [run, "_family"]).groupBy(run)
    loads = held.agg(F.array(*[F.coalesce(F.sum(F.when(F.col("split") == n, F.col("w"))), F.lit(0)).cast("double") for n in names]).alias("load"))
    rest = by_running_weight(sized.where(~is_big), loads, shares, run, "_family")
    return named.join(placed.unionByName(rest), [run, "_family"]).drop("_family", "_l", "_p")
