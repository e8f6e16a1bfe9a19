"""Ordered-sequence operators: clustering, alignment, runs and repairs along one axis.

Folds run inside ``aggregate`` over an array of one group. What is gathered for
a group are its distinct values with their counts, which pixels and row numbers
bound, never its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def value_counts(rows: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, points)``: the distinct values of each key in order, with how often each comes."""
    counted = rows.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    return counted.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col(value).cast("double").alias("v"), "n"))).alias("points"))


def running_mean_clusters(points: Column, tolerance: float) -> Column:
    """Groups of ordered values; a value over the mean of the group so far by more than the tolerance starts the next.

    Equal values stay together: joining a group moves its mean towards them.
    """
    empty = F.array().cast("array<struct<total:double,n:bigint>>")

    def step(groups, p):
        last = F.try_element_at(groups, F.lit(-1))
        joins = F.coalesce(p["v"] - last["total"] / last["n"] <= tolerance, F.lit(False))
        grown = F.struct((last["total"] + p["v"] * p["n"]).alias("total"), (last["n"] + p["n"]).alias("n"))
        fresh = F.struct((p["v"] * p["n"]).alias("total"), p["n"].alias("n"))
        head = F.when(joins, F.slice(groups, 1, F.greatest(F.size(groups) - 1, F.lit(0)))).otherwise(groups)
        return F.concat(head, F.array(F.when(joins, grown).otherwise(fresh)))

    groups = F.aggregate(points, empty, step)
    return F.transform(groups, lambda g: F.struct((g["total"] / g["n"]).alias("center"), g["n"].alias("n")))


def cluster_axis(rows: DataFrame, key: str, value: str, tolerance: float) -> DataFrame:
    """``(key, cluster, center, n)`` with clusters numbered from 1."""
    grouped = value_counts(rows, key, value).select(key, F.posexplode(running_mean_clusters(F.col("points"), tolerance)).alias("cluster", "c"))
    return grouped.select(key, (F.col("cluster") + 1).alias("cluster"), "c.center", "c.n")


def assignment_limit(centers: Column, floor: float = 20.0, part: float = 0.42, single_gap: float = 80.0) -> Column:
    """How far from a centre a value may lie: a part of the least gap between centres, a floor at least."""
    n = F.size(centers)
    gaps = F.zip_with(F.slice(centers, 2, F.greatest(n - 1, F.lit(0))), F.slice(centers, 1, F.greatest(n - 1, F.lit(0))), lambda b, a: b - a)
    least = F.coalesce(F.array_min(F.filter(gaps, lambda g: g > 0)), F.lit(single_gap))
    return F.greatest(F.lit(floor), least * part)


def nearest_index(value: Column, centers: Column) -> Column:
    """Place (from 1) of the nearest centre, the first on a tie; null without centres."""
    ways = F.transform(centers, lambda c, i: F.struct(F.abs(c - value).alias("d"), (i + 1).alias("i")))
    return F.array_min(ways)["i"]


def assign_to_centers(rows: DataFrame, centers: DataFrame, key: str, value: str) -> DataFrame:
    """Rows with the nearest centre of their key as ``place``, those too far from any left out."""
    listed = centers.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("cluster", "center"))), lambda s: s["center"]).alias("_centers"))
    placed = rows.join(listed, key).withColumn("place", nearest_index(F.col(value), F.col("_centers")))
    distance = F.abs(F.col(value) - F.element_at("_centers", F.col("place").cast("int")))
    return placed.where(distance <= assignment_limit(F.col("_centers"))).drop("_centers")


def offset_mode(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """``(key, start, inliers, n)``: the most frequent difference of value and row number, the least on a tie."""
    numbered = rows.withColumn("_at", F.row_number().over(Window.partitionBy(key).orderBy(order, value)))
    counted = numbered.groupBy(key, (F.col(value) - F.col("_at")).alias("start")).agg(F.count("*").alias("inliers"))
    best = counted.groupBy(key).agg(F.max_by("start", F.struct(F.col("inliers"), -F.col("start"))).alias("start"), F.max("inliers").alias("inliers"), F.sum("inliers").alias("n"))
    return best


def largest_gap(rows: DataFrame, key: str, value: str, least_keys: int = 12, least_steps: int = 10, step_share: float = 0.6) -> DataFrame:
    """``(key, n_keys, gap)``: the largest hole in a sequence that mostly steps by one."""
    distinct = rows.where(F.col(value).isNotNull()).select(key, value).distinct()
    step = F.lead(value).over(Window.partitionBy(key).orderBy(value)) - F.col(value)
    steps = distinct.withColumn("_step", step)
    out = steps.groupBy(key).agg(F.count("*").alias("n_keys"), F.count_if(F.col("_step") == 1).alias("n_ones"), F.coalesce(F.max("_step") - 1, F.lit(0)).alias("gap"))
    return out.where((F.col("n_keys") >= least_keys) & (F.col("n_ones") >= least_steps) & (F.col("n_ones") >= step_share * (F.col("n_keys") - 1))).select(key, "n_keys", "gap")


def consecutive_runs(rows: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, first, last, n)`` of maximal runs of consecutive whole numbers."""
    distinct = rows.where(F.col(value).isNotNull()).select(key, value).distinct()
    island = F.col(value) - F.row_number().over(Window.partitionBy(key).orderBy(value))
    return distinct.withColumn("_i", island).groupBy(key, "_i").agg(F.min(value).alias("first"), F.max(value).alias("last"), F.count("*").alias("n")).drop("_i")


def triangular_resets(rows: DataFrame, key: str, order: str, width: str, least_jump: int = 4, least_rows: int = 4) -> DataFrame:
    """Rows with the group they fall in: a new one starts where the right edge jumps out again after shrinking."""
    by = Window.partitionBy(key).orderBy(order)
    jump = F.col(width) - F.lag(width).over(by) >= least_jump
    marked = rows.withColumn("_at", F.row_number().over(by)).withColumn("_new", F.coalesce(jump & (F.col("_at") > least_rows), F.lit(False)).cast("int"))
    return marked.withColumn("group", F.sum("_new").over(by) + 1).drop("_at", "_new")


def quantile_bucket(rows: DataFrame, value: str, buckets: int, within: str) -> DataFrame:
    """Rows with ``bucket``: how many values of the group are less, in parts of the group's size.

    Counted on the distinct values of each group, so that ties and hot values
    cost one row each. Null values have no bucket.
    """
    counted = rows.where(F.col(value).isNotNull()).groupBy(within, value).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(within).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("_n").over(Window.partitionBy(within))
    bucket = F.least(F.lit(buckets - 1), F.floor(before * buckets / total)).cast("int")
    placed = counted.select(within, value, bucket.alias("bucket"))
    return rows.join(placed, [within, value], "left")


def dominant_value(rows: DataFrame, key: str, value: str, share: float = 0.7, least: int = 10) -> DataFrame:
    """``(key, value, n, total)`` of keys that one value fills by ``share``; the least value on a tie."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    top = counted.groupBy(key).agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias(value), F.max("n").alias("n"), F.sum("n").alias("total"))
    return top.where((F.col("total") >= least) & (F.col("n") >= F.col("total") * share))


def fill_dominant(rows: DataFrame, key: str, value: str, share: float = 0.7, least: int = 10) -> DataFrame:
    """Rows with a missing value filled in where one value dominates the key."""
    top = dominant_value(rows, key, value, share, least).select(key, F.col(value).alias("_top"))
    return rows.join(top, key, "left").withColumn(value, F.coalesce(value, "_top")).drop("_top")


def repair_by_neighbours(values: Column) -> Column:
    """A value between two that agree with each other becomes theirs; from left to right over what was repaired."""
    empty = F.array().cast("array<string>")

    def step(done, at):
        left, right = F.try_element_at(done, F.lit(-1)), F.try_element_at(values, (at + 1).cast("int"))
        agree = F.coalesce((left == right) & (F.element_at(values, at.cast("int")) != left), F.lit(False))
        return F.concat(done, F.array(F.when(agree, left).otherwise(F.element_at(values, at.cast("int")))))

    return F.when(F.size(values) == 0, values).otherwise(F.aggregate(F.sequence(F.lit(1), F.size(values)), empty, step))


def nearest_fill(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Missing values from the nearest row of the key that has one, the earlier on a tie."""
    back = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(key).orderBy(order).rowsBetween(0, Window.unboundedFollowing)
    at = F.when(F.col(value).isNotNull(), F.col(order))
    marked = (
        rows.withColumn("_b", F.last(value, True).over(back))
        .withColumn("_bo", F.last(at, True).over(back))
        .withColumn("_a", F.first(value, True).over(ahead))
        .withColumn("_ao", F.first(at, True).over(ahead))
    )
    earlier = F.col("_ao").isNull() | (F.col(order) - F.col("_bo") <= F.col("_ao") - F.col(order))
    filled = F.when(F.col("_bo").isNotNull() & earlier, F.col("_b")).otherwise(F.col("_a"))
    return marked.withColumn(value, F.coalesce(F.col(value), filled)).drop("_b", "_bo", "_a", "_ao")


def central_gaps(centers: Column) -> Column:
    """Positive gaps within 0.7 to 1.3 of their median."""
    n = F.size(centers)
    gaps = F.filter(F.zip_with(F.slice(centers, 2, F.greatest(n - 1, F.lit(0))), F.slice(centers, 1, F.greatest(n - 1, F.lit(0))), lambda b, a: b - a), lambda g: g > 0)
    sorted_ = F.array_sort(gaps)
    m = F.size(sorted_)
    low, high = F.try_element_at(sorted_, F.floor((m + 1) / 2).cast("int")), F.try_element_at(sorted_, F.floor(m / 2 + 1).cast("int"))
    middle = F.when(m > 0, (low + high) / 2)
    return F.filter(gaps, lambda g: (g >= middle * 0.7) & (g <= middle * 1.3))


def distinct_positive(values: Column) -> Column:
    """Positive numbers, each once, in the order they first come."""
    return F.array_distinct(F.filter(values, lambda v: v > 0))
