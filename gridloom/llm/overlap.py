"""Records of a run that recur across its splits, unchanged or nearly so.

Texts are reduced to their core and winnowed: the least rolling hash of each
window of ``WINDOW`` hashes of ``SEED`` characters. Equal cores of a run form a
class and are joined as one; classes of the two sides are joined on their
fingerprints. Only the rarest fingerprints of a class in its run take part:
two texts of which at least ``NEAR`` of the fingerprints agree must share one
of the rarest ``1 - NEAR`` (the prefix filter), so boilerplate that a whole run
has in common joins nothing, and nothing is capped. Pairs left are compared on
all their fingerprints and then on their texts: seeds are chained along
diagonals and extended to maximal common passages (coverage), and the share of
common runs of ``GRAM`` characters decides.

An edit may touch every fingerprint of a short text. Texts of fewer than
``SHORT`` distinct runs of ``GRAM`` characters, and those up to half again as
many, which can be alike to them, are joined on all these runs by the same
filter with the share that is asked for, which loses no pair. Texts with fewer
than ``GRAM`` core characters are alike only if their cores are equal. Null and blank texts match nothing. Names without a record, names
listed twice and the list ``all`` add nothing; repeated rows count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.llm.text_core import codes, core, join_codes, rolling, slices
from gridloom.session import cut_lineage, ship_package

SEED, WINDOW, GRAM = 8, 6, 5
#: Share of the fingerprints of the text with more of them that near copies have in common at least. Pairs at the
#: limit of two thirds of the runs of five characters keep a third of the fingerprints even if edits lie evenly.
NEAR = 0.25
SHARE = 2 / 3
#: Distinct runs of ``GRAM`` characters below which a text is matched on all of them.
SHORT = 100


def winnow(text_core: str) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints (signed hashes) and their places, each hash at its first place."""
    h = rolling(codes(text_core), SEED)
    if not len(h):
        h = rolling(codes(text_core), max(1, len(text_core))) if text_core else h
    if len(h) <= WINDOW:
        at = np.array([h.argmin()]) if len(h) else np.zeros(0, np.int64)
    else:
        n = len(h) - WINDOW + 1
        least, at = h[WINDOW - 1 :].copy(), np.arange(WINDOW - 1, len(h))
        for j in range(WINDOW - 2, -1, -1):  # the last of equal minima
            less = h[j : n + j] < least
            least[less] = h[j : n + j][less]
            at[less] = np.flatnonzero(less) + j
        at = at[np.append(True, at[1:] != at[:-1])]  # places never go back from one window to the next
    keys, first = np.unique(h[at], return_index=True)
    return keys.view(np.int64), at[first]


def grams(text_core: str) -> np.ndarray:
    return np.unique(rolling(codes(text_core), GRAM))


def all_runs(text_core: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (signed) and first places of all runs of ``GRAM`` characters."""
    keys, first = np.unique(rolling(codes(text_core), GRAM), return_index=True)
    return keys.view(np.int64), first


def _has_few_runs(hashes: np.ndarray) -> bool:
    """Whether a text with these hashes of runs is short or can be alike to a short one."""
    # A text that has so many different runs at its beginning already has no fewer in all.
    if len(hashes) > 4 * SHORT and len(np.unique(hashes[: 4 * SHORT])) * 2 > SHORT * 3:
        return False
    return len(np.unique(hashes)) * 2 <= SHORT * 3


def marks_of(cores: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its fingerprints, and all runs of one that is short or can be alike to a short one; the other is empty.

    Fingerprints are those of ``winnow``, worked out for all texts at once.
    """
    joined, ends = join_codes(cores)
    size = np.diff(ends)
    seeds, grams_ = rolling(joined, SEED), rolling(joined, GRAM)
    n = len(seeds) - WINDOW + 1
    keys = at = np.zeros(0, np.int64)
    text = np.zeros(0, np.int64)
    if n > 0:
        least, at = seeds[WINDOW - 1 :].copy(), np.arange(WINDOW - 1, len(seeds))
        for j in range(WINDOW - 2, -1, -1):  # the last of equal minima
            less = np.flatnonzero(seeds[j : n + j] < least)
            least[less] = seeds[less + j]
            at[less] = less + j
        owner = np.repeat(np.arange(len(cores)), size)[:n]
        inside = np.arange(n) + WINDOW + SEED - 1 <= ends[owner + 1]
        text, at = owner[inside], at[inside]
        new = np.append(True, (at[1:] != at[:-1]) | (text[1:] != text[:-1]))[: len(at)]
        text, at = text[new], at[new]
        keys = seeds[at].view(np.int64)
        order = np.lexsort((seeds[at], text))
        text, keys = text[order], keys[order]
        new = np.append(True, (keys[1:] != keys[:-1]) | (text[1:] != text[:-1]))[: len(keys)]
        text, keys = text[new], keys[new]
    where = np.searchsorted(text, np.arange(len(cores) + 1))
    none, out = np.zeros(0, np.int64), []
    for k, c in enumerate(cores):
        hashes = grams_[ends[k] : max(ends[k], ends[k + 1] - GRAM + 1)]
        runs = np.unique(hashes).view(np.int64) if _has_few_runs(hashes) else none
        few = len(runs) < SHORT and (len(runs) > 0 or len(c) < GRAM)
        marks = none if few else keys[where[k] : where[k + 1]] if size[k] >= WINDOW + SEED - 1 else winnow(c)[0]
        out.append((marks, runs))
    return out


def compare(a: str, b: str) -> tuple[float, float, float]:
    """Share of common runs, and the part of each core in common passages of a collinear chain."""
    if a == b:
        return 1.0, 1.0, 1.0
    ga, gb = grams(a), grams(b)
    most = max(len(ga), len(gb))
    share = len(np.intersect1d(ga, gb, assume_unique=True)) / most if most else 0.0
    seeds_of = all_runs if min(len(ga), len(gb)) < SHORT else winnow
    ha, pa_ = seeds_of(a)
    hb, pb_ = seeds_of(b)
    common, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    if not len(common):
        return share, 0.0, 0.0
    ca, cb = codes(a), codes(b)
    seeds = sorted(zip(pa_[ia].tolist(), pb_[ib].tolist()))
    # The longest chain of seeds that rise in both texts (patience sorting on the places in b).
    tops: list[int] = []
    ends: list[int] = []
    back = [-1] * len(seeds)
    from bisect import bisect_left

    for i, (_, y) in enumerate(seeds):
        k = bisect_left(tops, y)
        if k == len(tops):
            tops.append(y)
            ends.append(i)
        else:
            tops[k], ends[k] = y, i
        back[i] = ends[k - 1] if k else -1
    chain, i = [], ends[-1]
    while i >= 0:
        chain.append(seeds[i])
        i = back[i]
    seen_a = seen_b = upto_a = upto_b = 0
    for x, y in chain[::-1]:
        if x < upto_a or y < upto_b:
            continue  # inside the passage before
        left = min(x - upto_a, y - upto_b)
        differ = np.flatnonzero(ca[x - left : x][::-1] != cb[y - left : y][::-1])
        left = int(differ[0]) if len(differ) else left
        right = min(len(ca) - x, len(cb) - y)
        differ = np.flatnonzero(ca[x : x + right] != cb[y : y + right])
        right = int(differ[0]) if len(differ) else right
        seen_a += left + right
        seen_b += left + right
        upto_a, upto_b = x + right, y + right
    return share, seen_a / len(a), seen_b / len(b)


def _fingerprinted(records: DataFrame) -> DataFrame:
    """``(file_name, source, cls, c, core, marks, runs)`` of every record with a core, each file once; ``c`` is a short form of ``cls``."""

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cores = [core(t) for t in batch.column(2).to_pylist()]
            keep = [i for i, c in enumerate(cores) if c]
            rows = pa.array(keep, pa.int64())
            kept = [cores[i] for i in keep]
            marked = [m for start, end in slices(kept, chars=1_000_000) for m in marks_of(kept[start:end])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    pa.array([xxhash.xxh3_128_hexdigest(c.encode("utf-8", "replace")) for c in kept], pa.string()),
                    pa.array([xxhash.xxh3_64_intdigest(c.encode("utf-8", "replace")) - (1 << 63) for c in kept], pa.int64()),
                    pa.array(kept, pa.string()),
                    *(pa.array([m[k] for m in marked], pa.list_(pa.int64())) for k in range(2)),
                ],
                names=["file_name", "source", "cls", "c", "core", "marks", "runs"],
            )

    rows = records.select("file_name", "source", "read_text").where("file_name is not null and read_text is not null")
    return rows.mapInArrow(prepare, "file_name string, source string, cls string, c bigint, core string, marks array<bigint>, runs array<bigint>").dropDuplicates(["file_name"])


def listed(splits: DataFrame) -> DataFrame:
    """``(run_id, name, file_name)``, each once, without the list of all files."""
    rows = splits.select("run_id", F.lower(F.trim("name")).alias("name"), F.explode("file_names").alias("file_name"))
    return rows.where("run_id is not null and file_name is not null").where(F.col("name").isin("train", "validation", "test")).distinct()


def _overlaps(splits: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of classes by run and split, and near class pairs ``(run_id, a, b, share, cover_a, cover_b)``, a in train."""
    ship_package(records.sparkSession)
    texts = cut_lineage(_fingerprinted(records))
    members = listed(splits).join(texts.select("file_name", "source", "cls", "c"), "file_name")
    classes = members.groupBy("run_id", "cls", "c").agg(F.bool_or(F.col("name") == "train").alias("left"), F.bool_or(F.col("name") != "train").alias("right"))
    # ``at`` stands for a class in a run with one kind of mark (``short``: runs of short texts); its two last bits say on
    # which sides the class is. ``k`` stands for a mark in a run. Rows of marks are these two numbers alone; what else is
    # known of ``at`` is joined when few rows are left. Candidates found through equal hashes of different values fall
    # away below, where classes and texts are compared themselves.
    held = classes.join(texts.select("cls", "marks", "runs").dropDuplicates(["cls"]), "cls")
    kinds = F.array(F.struct(F.lit(False).alias("short"), F.col("marks").alias("of")), F.struct(F.lit(True).alias("short"), F.col("runs").alias("of")))
    held = held.select("c", "cls", "run_id", "left", "right", F.explode(kinds).alias("kind")).where(F.size("kind.of") > 0)
    sides = F.when(F.col("left"), 2).otherwise(0) + F.when(F.col("right"), 1).otherwise(0)
    at = F.shiftleft(F.shiftright(F.xxhash64("run_id", "cls", "kind.short"), 2), 2).bitwiseOR(sides.cast("bigint"))
    held = cut_lineage(held.select(at.alias("at"), "c", "kind.short", F.size("kind.of").alias("n"), F.transform("kind.of", lambda m: F.xxhash64(F.col("run_id"), m, F.col("kind.short"))).alias("ks")))
    known = held.select("at", "c", "short", "n").dropDuplicates(["at"])
    marks = held.select("at", F.explode("ks").alias("k"))
    on = lambda bit: F.col("at").bitwiseAND(F.lit(bit)) != 0
    spread = marks.groupBy("k").agg(F.count("*").cast("int").alias("df"), F.bit_or(F.col("at").bitwiseAND(F.lit(3)).cast("tinyint")).alias("seen"))
    # Marks of one side come first in the common order; they join nothing, so only their number matters to the rank of the others.
    both_sided = spread.where("seen = 3").select("k", "df")
    by_class = Window.partitionBy("at")
    ranked = marks.join(both_sided, "k").withColumn("rank", F.row_number().over(by_class.orderBy("df", "k"))).withColumn("n_both", F.count("*").over(by_class))
    others = F.when(F.col("short"), F.floor(F.col("n") / 3)).otherwise(F.floor(F.col("n") * (1 - NEAR)))
    rare = ranked.join(known, "at").where(F.col("n") - F.col("n_both") + F.col("rank") <= others + 1)
    rare = cut_lineage(rare.select("k", "c", "short", "n", on(2).alias("left"), on(1).alias("right")))
    a = rare.where("left").select("k", "short", F.col("c").alias("x"), F.col("n").alias("n_x"))
    b = rare.where("right").select("k", F.col("c").alias("y"), F.col("n").alias("n_y"))
    near_size = F.when(F.col("short"), F.least("n_x", "n_y") * 3 >= F.greatest("n_x", "n_y") * 2).otherwise(F.least("n_x", "n_y") >= F.greatest("n_x", "n_y") * NEAR)
    # The texts of a pair of classes are compared once, whatever the runs and sides that have it.
    met = a.join(b, "k").where((F.col("x") != F.col("y")) & near_size)
    met_once = cut_lineage(met.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct())
    # Only texts that are in some pair go on.
    wanted = met_once.select(F.col("x").alias("c")).unionAll(met_once.select(F.col("y").alias("c"))).distinct()
    bodies = cut_lineage(texts.select("cls", "c", "core", "marks", "runs").join(wanted, "c", "left_semi").dropDuplicates(["cls"]))
    held_a = bodies.select(F.col("c").alias("x"), F.col("cls").alias("a"), F.col("marks").alias("marks_a"), F.col("runs").alias("runs_a"))
    held_b = bodies.select(F.col("c").alias("y"), F.col("cls").alias("b"), F.col("marks").alias("marks_b"), F.col("runs").alias("runs_b"))
    common = F.size(F.array_intersect("marks_a", "marks_b")) >= F.greatest(F.size("marks_a"), F.size("marks_b")) * NEAR
    common_runs = F.size(F.array_intersect("runs_a", "runs_b")) * 3 >= F.greatest(F.size("runs_a"), F.size("runs_b")) * 2
    both_short = (F.size("runs_a") > 0) & (F.size("runs_b") > 0)
    alike = met_once.join(held_a, "x").join(held_b, "y").where(F.when(both_short, common_runs).otherwise(common)).select("a", "b")
    with_text = alike.join(bodies.select(F.col("cls").alias("a"), F.col("core").alias("core_a")), "a").join(
        bodies.select(F.col("cls").alias("b"), F.col("core").alias("core_b")), "b"
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [compare(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            columns = [pa.array([g[k] for g in got], pa.float64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["a", "b", "share", "cover_a", "cover_b"])

    measured = with_text.select("a", "b", "core_a", "core_b").mapInArrow(measure, "a string, b string, share double, cover_a double, cover_b double")
    measured = measured.where(F.col("share") >= SHARE - 1e-12)
    both = measured.unionByName(measured.select(F.col("b").alias("a"), F.col("a").alias("b"), "share", F.col("cover_b").alias("cover_a"), F.col("cover_a").alias("cover_b")))
    # Alike classes count in every run that has one of them in train and the other beside it.
    in_train = classes.where("left").select("run_id", F.col("cls").alias("a"))
    beside = classes.where("right").select("run_id", F.col("cls").alias("b"))
    near = both.join(in_train, "a").join(beside, ["run_id", "b"]).select("run_id", "a", "b", "share", "cover_a", "cover_b")
    one = F.lit(1.0)
    same = classes.where(F.col("left") & F.col("right")).select("run_id", F.col("cls").alias("a"), F.col("cls").alias("b"), one.alias("share"), one.alias("cover_a"), one.alias("cover_b"))
    return members, near.unionByName(same)


def cross_split_pairs(splits: DataFrame, records: DataFrame) -> DataFrame:
    """``(run_id, train_file, file_name, name, source, share, cover_train, cover)`` of every pair, ``name`` the other split."""
    members, pairs = _overlaps(splits, records)
    left = members.where("name = 'train'").select("run_id", F.col("cls").alias("a"), F.col("file_name").alias("train_file"))
    right = members.where("name <> 'train'").select("run_id", F.col("cls").alias("b"), "file_name", "name", "source")
    return pairs.join(left, ["run_id", "a"]).join(right, ["run_id", "b"]).select(
        "run_id", "train_file", "file_name", "name", "source", "share", F.col("cover_a").alias("cover_train"), F.col("cover_b").alias("cover")
    )


def overlapping_files(splits: DataFrame, records: DataFrame) -> DataFrame:
    rows = cross_split_pairs(splits, records)
    return rows.select("run_id", F.least("train_file", "file_name").alias("file_lo"), F.greatest("train_file", "file_name").alias("file_hi")).distinct()


def overlap_counts(splits: DataFrame, records: DataFrame) -> DataFrame:
    """Pairs and files of the evaluation side by run, split and source.

    Worked out from the sizes of classes; copies are not expanded into pairs.
    """
    members, pairs = _overlaps(splits, records)
    left = members.where("name = 'train'").groupBy("run_id", F.col("cls").alias("a")).agg(F.count("*").alias("n_left"))
    right = members.where("name <> 'train'").groupBy("run_id", F.col("cls").alias("b"), "name", "source").agg(F.count("*").alias("n_right"))
    of_class = pairs.join(left, ["run_id", "a"]).groupBy("run_id", "b").agg(F.sum("n_left").alias("n_left"), F.sum(F.col("n_left") * F.col("cover_b")).alias("covered"))
    return of_class.join(right, ["run_id", "b"]).groupBy("run_id", "name", "source").agg(
        F.sum(F.col("n_left") * F.col("n_right")).alias("n_pairs"), F.sum("n_right").alias("n_files"), F.round(F.sum(F.col("covered") * F.col("n_right")) / F.sum(F.col("n_left") * F.col("n_right")), 6).alias("mean_cover")
    )
