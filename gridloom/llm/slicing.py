"""Cutting slices that are too tall, between text boxes where that is possible.

The boxes of a slice are reduced to the whole pixels a cut must avoid; for each
first pixel only the farthest last one is kept, so what is gathered for a slice
is bounded by its height in pixels, however many boxes it has.

All cuts are balanced: for the least number of pieces that fit the rest, the
next target lies at an equal length and moves to the strongest free gap nearby
(the widest, less half its distance), or else to a free gap anywhere in reach.
A target that moved back may leave too much for the pieces planned; then one is
added and the rest is balanced anew. Where no free pixel is in reach, the cut
goes through the fewest boxes, as near to the target as possible.

Whether clean cuts exist at all is decided by going as far as the limit allows
at every cut, which is exact: a cut that goes farther can only reach farther.
For the same reason any free pixel has a clean continuation if there is one, so
the balanced cuts of such a slice are all clean.

``y0`` or ``y1`` missing follows from ``height``; with both missing a slice has
no place on the page and is left out, as are slices of an unknown ``kind`` or
with no extent. An overlap as large as the limit allows no progress and counts
as none. Slices are given once each; boxes without slice count for nothing.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.session import ship_package


#: Pixels from which a gap is as strong as any wider one.
WIDE = 60


def merged(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(intervals):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


class _Free:
    """Pixels at which no box is crossed."""

    def __init__(self, blocked: list[tuple[int, int]]):
        self.boxes = sorted(blocked)
        self.blocked = merged(blocked)
        self.lows = [b[0] for b in self.blocked]

    def holder(self, at: int) -> tuple[int, int] | None:
        k = bisect.bisect_right(self.lows, at) - 1
        return self.blocked[k] if k >= 0 and self.blocked[k][1] >= at else None

    def last_upto(self, at: int) -> int:
        held = self.holder(at)
        return at if held is None else held[0] - 1

    def gaps(self, low: int, high: int) -> list[tuple[int, int]]:
        """Free runs of pixels within [low, high]."""
        out, at = [], low
        k = max(0, bisect.bisect_right(self.lows, low) - 1)
        for a, b in self.blocked[k:]:
            if a > high:
                break
            if b < at:
                continue
            if a > at:
                out.append((at, a - 1))
            at = max(at, b + 1)
        if at <= high:
            out.append((at, high))
        return out


    def least_crossed(self, low: int, high: int, target: float) -> int:
        """The pixel of [low, high] that the fewest boxes hold, the nearest to ``target`` of several."""
        turns = {low: 0, high + 1: 0}
        for a, b in self.boxes[: bisect.bisect_right(self.boxes, (high, 1 << 62))]:
            if b >= low:
                turns[max(a, low)] = turns.get(max(a, low), 0) + 1
                turns[min(b, high) + 1] = turns.get(min(b, high) + 1, 0) - 1
        at, held, best = sorted(turns), 0, None
        for begin, end in zip(at, at[1:]):
            held += turns[begin]
            near = int(min(max(target, begin), end - 1))
            if best is None or (held, abs(near - target)) < best[:2]:
                best = (held, abs(near - target), near)
        return best[2]


def clean_cuts_exist(y0: int, y1: int, limit: int, overlap: int, free: _Free) -> bool:
    """Whether clean cuts that each go as far as they can reach the end."""
    at = start = y0
    while y1 - start > limit:
        to = free.last_upto(min(start + limit, y1 - 1))
        if to <= at:
            return False
        at, start = to, max(y0, to - overlap)
    return True


def _strongest(free: _Free, low: int, high: int, target: float) -> int | None:
    """A pixel of [low, high] in the gap that is widest for its distance from the target, away from the gap's edges."""
    gaps = [g for g in free.gaps(low - WIDE, high + WIDE) if g[0] <= high and g[1] >= low]
    if not gaps:
        return None
    first, last = max(gaps, key=lambda g: (min(g[1] - g[0], WIDE) - 0.5 * max(g[0] - target, target - g[1], 0.0), -g[0]))
    edge = min(WIDE // 2, (last - first) // 2)
    return int(min(max(round(target), first + edge, low), max(last - edge, low), high))


def balanced(y0: int, y1: int, limit: int, overlap: int, free: _Free) -> list[int]:
    """Cuts near equal lengths, as few as fit."""
    cuts: list[int] = []
    at = start = y0
    while y1 - start > limit:
        rest = y1 - start
        n = -(-(rest - overlap) // (limit - overlap))  # the pieces left at least
        length = (rest + (n - 1) * overlap) / n
        target, last = start + length, min(start + limit, y1 - 1)
        near = max(1, int((length - overlap) / 3))
        least = min(at + 1 + (limit - overlap) // 4, last)  # no slivers where that can be helped
        to = _strongest(free, max(least, int(target) - near), min(last, int(target) + near), target)
        if to is None:
            to = _strongest(free, least, last, target)
        if to is None and free.last_upto(last) > at:
            to = free.last_upto(last)
        at = free.least_crossed(least, last, target) if to is None else to
        cuts.append(at)
        start = max(y0, at - overlap)
    return cuts


def plan(y0: int, y1: int, limit: int, overlap: int, blocked: list[tuple[int, int]]) -> tuple[str, list[int]]:
    """``(clean or forced, cuts)`` of an extent over the limit."""
    overlap = overlap if 0 <= overlap < limit else 0
    free = _Free(blocked)
    return "clean" if clean_cuts_exist(y0, y1, limit, overlap, free) else "forced", balanced(y0, y1, limit, overlap, free)


def oversized(slices: DataFrame, specs: DataFrame) -> DataFrame:
    """``(slice_id, y0, y1, limit, overlap, confident)`` of slices over the limit of their kind, each once."""
    kind = F.lower(F.regexp_replace("kind", r"(?U)^\s+|\s+$", ""))
    rows = slices.dropDuplicates(["slice_id"]).select("slice_id", kind.alias("kind"), "y0", "y1", "height")
    limits = specs.select(kind.alias("kind"), F.col("max_height").alias("limit"), F.coalesce("y_overlap", F.lit(0)).alias("overlap"), F.col("min_confidence").alias("confident"))
    y0 = F.coalesce(F.col("y0"), F.col("y1") - F.col("height"))
    y1 = F.coalesce(F.col("y1"), F.col("y0") + F.col("height"))
    return rows.join(limits, "kind").select("slice_id", y0.cast("int").alias("y0"), y1.cast("int").alias("y1"), "limit", "overlap", "confident").where("y1 - y0 > limit and limit > 0")


def cut_slices(slices: DataFrame, observations: DataFrame, specs: DataFrame) -> DataFrame:
    """``(slice_id, cut, pieces)`` with ``pieces`` an array of ``(y0, height)``."""
    ship_package(slices.sparkSession)
    tall = oversized(slices, specs)
    top, bottom = F.col("y") - F.col("height") / 2, F.col("y") + F.col("height") / 2
    first, last = F.floor(top).cast("int") + 1, F.ceil(bottom).cast("int") - 1
    boxes = (
        observations.where("slice_id is not null and y is not null and height is not null and confidence is not null")
        .select("slice_id", first.alias("low"), last.alias("high"), "confidence")
        .where("low <= high")
        .join(tall.select("slice_id", "y0", "y1", "confident"), "slice_id")
        .where("confidence >= confident and high > y0 and low < y1")
        .groupBy("slice_id", "low")
        .agg(F.max("high").alias("high"))
        .groupBy("slice_id")
        .agg(F.collect_list(F.struct("low", "high")).alias("boxes"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, pieces = [], []
            for y0, y1, limit, overlap, boxes_ in zip(*(batch.column(i).to_pylist() for i in range(1, 6))):
                how, cuts = plan(y0, y1, limit, overlap, [(b["low"], b["high"]) for b in boxes_ or ()])
                overlap = overlap if 0 <= overlap < limit else 0
                starts = [y0, *(max(y0, c - overlap) for c in cuts)]
                kinds.append(how)
                pieces.append([{"y0": a, "height": b - a} for a, b in zip(starts, [*cuts, y1])])
            kind = pa.list_(pa.struct([("y0", pa.int32()), ("height", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kinds, pa.string()), pa.array(pieces, kind)], names=["slice_id", "cut", "pieces"])

    rows = tall.join(boxes, "slice_id", "left").select("slice_id", "y0", "y1", "limit", "overlap", "boxes")
    return rows.mapInArrow(cut, "slice_id bigint, cut string, pieces array<struct<y0:int,height:int>>")


def slice_pieces(slices: DataFrame, observations: DataFrame, specs: DataFrame) -> DataFrame:
    rows = cut_slices(slices, observations, specs).select("slice_id", F.posexplode("pieces").alias("piece", "p"))
    return rows.select("slice_id", "piece", "p.y0", "p.height")
