"""Splits that keep related records together.

Records of a run are related when they share a family, author or entity, and
so are records related to the same one. Components are found by random-mate
contraction: every round each vertex draws a coin, tails next to a head are
collapsed into the least such head, and the edges are carried over, until no
edge is left. The rounds are then unwound, so that each vertex gets the
representative it ended in. Edges lead from a record to
the least record with the same key, one for each, so that a key that a third
of all rows share is a star and no group is collected.

Keys are compared without case, width and outer spaces; null, empty and
placeholder keys relate nothing. Rows without a file name or run are left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.overlap import listed
from gridloom.operators.experiment import by_running_weight
from gridloom.session import cut_lineage

KEYS = ("family", "author", "entity")
#: Placeholders that stand for a missing key, folded.
PLACEHOLDERS = ("", "-", "n/a", "unknown", "未知")
#: Components over this part of a run are placed one by one (at most 1 / BIG of them); the rest by running weight.
BIG = 0.02
#: Split targets at most; more are an error, never a part of the list.
SPLITS = 1_000
_WIDE = "".join(chr(0xFF01 + i) for i in range(94))
_NARROW = "".join(chr(0x21 + i) for i in range(94))


def folded(column: str) -> Column:
    plain = F.lower(F.translate(F.col(column), _WIDE + "\u3000", _NARROW + " "))
    return F.regexp_replace(plain, r"(?U)^\s+|\s+$", "")


def _coin(column: str, turn: int) -> Column:
    return F.pmod(F.xxhash64(F.col(column), F.lit(turn)), F.lit(2)) == 1


def components(features: DataFrame) -> DataFrame:
    """``(run_id, file_name, root)`` of each record once; ``root`` is the vertex its component ended in."""
    rows = features.where("run_id is not null and file_name is not null")
    vertex = F.concat_ws("\u0000", "run_id", "file_name")
    long = reduce(DataFrame.unionAll, [rows.select("run_id", vertex.alias("v"), F.lit(k).alias("what"), folded(k).alias("key")) for k in KEYS])
    long = long.where(F.col("key").isNotNull() & ~F.col("key").isin(*PLACEHOLDERS))
    hubs = long.groupBy("run_id", "what", "key").agg(F.min("v").alias("hub"))
    edges = cut_lineage(long.join(hubs, ["run_id", "what", "key"]).where("v <> hub").select(F.col("v").alias("x"), F.col("hub").alias("y")).distinct())
    mates, turn = [], 0
    while not edges.isEmpty():
        turn += 1
        ways = edges.select(F.explode(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))).alias("e")).select("e.x", "e.y")
        mate = cut_lineage(ways.where(~_coin("x", turn) & _coin("y", turn)).groupBy("x").agg(F.min("y").alias("to")))
        mates.append(mate)
        left = edges.join(mate, "x", "left").select(F.coalesce("to", "x").alias("x"), "y")
        right = left.join(mate.withColumnRenamed("x", "y"), "y", "left").select("x", F.coalesce("to", "y").alias("y")).where("x <> y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        edges = cut_lineage(right.distinct() if turn % 3 == 1 else right)  # edges that become equal are counted once now and then; mates do not mind
    # A vertex is collapsed once, into one that stays until a later round: the mates are trees no deeper than the
    # rounds, unwound by pointing every vertex twice as far each time.
    found = reduce(DataFrame.unionAll, mates) if mates else None
    for k in range((turn - 1).bit_length() if turn else 0):
        farther = found.select(F.col("x").alias("to"), F.col("to").alias("far"))
        found = found.join(farther, "to", "left").select("x", F.coalesce("far", "to").alias("to"))
        if k % 2 == 1:
            found = cut_lineage(found)
    found = found.withColumnRenamed("to", "root") if mates else None
    records = rows.select("run_id", "file_name", vertex.alias("x")).distinct()
    if found is None:
        return records.select("run_id", "file_name", F.col("x").alias("root"))
    return records.join(found, "x", "left").select("run_id", "file_name", F.coalesce("root", "x").alias("root"))


def torn_groups(features: DataFrame, splits: DataFrame) -> DataFrame:
    """``(run_id, file_name)``: the least file of each group that stands in more than one split."""
    groups = components(features)
    placed = groups.join(listed(splits), ["run_id", "file_name"], "left")
    by_group = placed.groupBy("run_id", "root").agg(F.min("file_name").alias("file_name"), F.min("name").alias("one"), F.max("name").alias("other"))
    return by_group.where("one <> other").select("run_id", "file_name")


def regrouped_splits(features: DataFrame, targets: DataFrame) -> DataFrame:
    """``(run_id, name, file_name)``: every record once, components whole, near the target shares.

    The target table is small and fixed (one row a split). Components over
    ``BIG`` of a run are placed largest first where most room is left; the rest
    follow in the order of a hash by their running weight, in two levels so
    that no run is summed in one task.
    """
    rows = targets.select("name", "share").where("name is not null").orderBy("name").limit(SPLITS + 1).collect()
    if len(rows) > SPLITS:
        raise ValueError(f"more than {SPLITS} split targets")
    shares = [(r[0], float(r[1] or 0)) for r in rows]
    total = sum(s for _, s in shares) or 1.0
    names, wanted = [n for n, _ in shares], [s / total for _, s in shares]
    groups = cut_lineage(components(features))
    sized = groups.groupBy("run_id", "root").agg(F.count("*").alias("w"))
    runs = sized.groupBy("run_id").agg(F.sum("w").alias("all"))
    sized = sized.join(runs, "run_id")
    big = sized.where(F.col("w") > F.col("all") * BIG)
    ordered = big.groupBy("run_id", "all").agg(F.sort_array(F.collect_list(F.struct("w", "root")), asc=False).alias("big"))  # at most 1 / BIG
    start = F.struct(F.array(*[F.lit(0.0)] * len(names)).alias("load"), F.array().cast("array<int>").alias("at"))
    want = F.array(*[F.lit(s) for s in wanted])

    def place(state, item):
        room = F.zip_with(want, state["load"], lambda s, used: s * F.col("all") - used)
        best = F.array_position(room, F.array_max(room)).cast("int")
        load = F.transform(state["load"], lambda used, i: F.when(i == best - 1, used + item["w"].cast("double")).otherwise(used))
        return F.struct(load.alias("load"), F.concat(state["at"], F.array(best)).alias("at"))

    placed = ordered.withColumn("state", F.aggregate("big", start, place))
    big_at = placed.select("run_id", F.explode(F.arrays_zip(F.col("big.root").alias("root"), F.col("state.at").alias("at"))).alias("z")).select("run_id", "z.root", "z.at")
    loads = placed.select("run_id", F.col("state.load").alias("load"))
    rest = by_running_weight(sized.where(F.col("w") <= F.col("all") * BIG), loads, dict(zip(names, wanted)), "run_id", "root").withColumnRenamed("split", "name")
    chosen = big_at.select("run_id", "root", F.element_at(F.array(*[F.lit(n) for n in names]), F.col("at")).alias("name")).unionByName(rest)
    return groups.join(chosen, ["run_id", "root"]).select("run_id", "name", "file_name")
