"""Evaluation passages inside a training corpus.

Candidates. A passage that counts has at least ``P`` core characters (16, or
the shortest eight words in a row of an English item). Documents are read run
by run (``width`` characters each, one after another) and items at every
offset; with ``2 * width - 1 <= P`` each passage holds a whole run of the
document, so an item is met wherever one of its passages stands. How many runs
an item must meet follows from how few distinct runs can make up half of it
(``needed``), so an item that repeats a phrase is found in a document that has
the phrase once.

Verification. For the pairs left, shared passages are located exactly, and a
pair stays if they cover at least half of the item's core.

Windows of the size of an item, embedded and sampled, are not what is looked
up: half of an item may lie scattered in passages of sixteen characters, which
no such window resembles (README has the figures).

The query set is read in blocks of at most ``ITEM_BLOCK`` items and
``ITEM_CHARS`` characters: each block is a broadcast of bounded size, whatever
the number of items; all documents pass each block. Null, empty and blank texts
match nothing; repeated documents come out once for each row, items with an
empty core or fewer words than a passage never match.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.text_core import codes, core, join_codes, rolling, slices, word_sizes
from gridloom.session import ship_package

#: Items of one broadcast block, and core characters of an item beyond which a block holds it alone.
ITEM_BLOCK, ITEM_CHARS = 20_000, 2_000_000
#: Core characters of a run at most, by the script of the item; items with shorter passages have shorter runs.
WIDTH = {"zh": 8, "en": 10}
#: Exact passages: 16 characters (zh), or 8 words (en), which are sought by 20 core characters, or fewer if an item has shorter words.
PASSAGE, PASSAGE_WORDS = {"zh": 16, "en": 20}, 8


def _run_keys(runs: np.ndarray) -> np.ndarray:
    """64-bit hashes of the rows of ``runs``."""
    key = np.zeros(len(runs), np.uint64)
    for j in range(runs.shape[1]):
        key = (key ^ (runs[:, j].astype(np.uint64) + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
    return key ^ (key >> np.uint64(29))


def needed(counts: np.ndarray, length: int, passage: int, width: int) -> int:
    """Runs of ``width`` characters, read one after another, that a document with half of an item has at least.

    ``counts`` are the occurrences of each distinct run of the item. Passages
    that cover half of it hold that half's share of starts of runs; the most
    frequent runs make up this number with the fewest distinct ones, and each
    stretch of ``2 * width - 1`` starts holds one that is read.
    """
    starts = -(-(-(-length // 2) * (passage - width + 1)) // passage)
    distinct = int(np.searchsorted(np.cumsum(np.sort(counts)[::-1]), starts)) + 1
    return max(1, -(-distinct // (2 * width - 1)))


class _Lists:
    """Sorted keys with the values of each: a multimap over arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, start = np.unique(keys[order], return_index=True)
        self.start = np.append(start, len(keys))
        self.values = values[order]
        self.seen = np.zeros(1 << 22, np.bool_)
        self.seen[(self.keys >> np.uint64(42)).astype(np.int64)] = True

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``keys`` that are held, with each of their values."""
        rows = np.flatnonzero(self.seen[(keys >> np.uint64(42)).astype(np.int64)])
        if not len(self.keys) or not rows.size:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.searchsorted(self.keys, keys[rows])
        at[at == len(self.keys)] = 0
        held = self.keys[at] == keys[rows]
        rows, at = rows[held], at[held]
        size = self.start[at + 1] - self.start[at]
        first = np.repeat(self.start[at] - np.concatenate(([0], np.cumsum(size)[:-1])), size)
        return np.repeat(rows, size), self.values[first + np.arange(int(size.sum()))]


class ItemIndex:
    """Everything a worker needs of the items of a block whose passages are sought in the same way."""

    def __init__(self, script: str, passage: int, rows: list[tuple[int, str, list[int]]]):
        """``rows`` are ``(item_id, core, characters of its words)``; ``passage`` are the characters of a passage at least."""
        self.script, self.passage, self.ids = script, passage, np.array([r[0] for r in rows], np.int64)
        self.width = min(WIDTH[script], (passage + 1) // 2)
        cores = [r[1] for r in rows]
        self.length = np.array([len(c) for c in cores], np.int64)
        joined, ends = join_codes(cores)
        keys, owner, grams, places = [], [], [], []
        self.need = np.ones(len(rows), np.int64)
        for k in range(len(rows)):
            c = joined[ends[k] : ends[k + 1]]
            distinct, counts = np.unique(_run_keys(np.lib.stride_tricks.sliding_window_view(c, self.width)), return_counts=True)
            self.need[k] = needed(counts, len(c), passage, self.width)
            keys.append(distinct)
            owner.append(np.full(len(distinct), k, np.int64))
            grams.append(rolling(c, passage))
            places.append(ends[k] + np.arange(len(grams[-1])))
        self.runs = _Lists(np.concatenate(keys), np.concatenate(owner))
        self.item_of = np.repeat(np.arange(len(rows)), self.length)
        # Whole words that start before, and that end before each place: their difference counts the words of a passage.
        starts, stops = np.zeros(len(joined) + 1, np.int64), np.zeros(len(joined) + 1, np.int64)
        for k, (_, _, sizes) in enumerate(rows):
            edge = ends[k] + np.cumsum([0, *sizes])
            np.add.at(starts, edge[:-1], 1)
            np.add.at(stops, edge[1:], 1)
        self.begun, self.ended = np.concatenate(([0], np.cumsum(starts))), np.cumsum(stops)
        self.grams = _Lists(np.concatenate(grams), np.concatenate(places))

    def candidates(self, cores: list[str]) -> np.ndarray:
        """Pairs (document, item) with enough runs in common, as rows."""
        w, n = self.width, len(self.ids)
        cut = [c[: len(c) // w * w] for c in cores]
        owner = np.repeat(np.arange(len(cut)), [len(c) // w for c in cut])
        if not owner.size:
            return np.zeros((0, 2), np.int64)
        rows, items = self.runs.find(_run_keys(codes("".join(cut)).reshape(-1, w)))
        pairs, count = np.unique(owner[rows] * n + items, return_counts=True)
        pairs = pairs[count >= self.need[pairs % n]]
        return np.stack([pairs // n, pairs % n], axis=1)

    def verify(self, cores: list[str], pairs: np.ndarray) -> np.ndarray:
        """Those of the pairs (document, item) whose passages cover half of the item."""
        width, n, size = self.passage, len(self.ids), np.int64(len(self.item_of) + 2)
        wanted = np.unique(pairs[:, 0])
        gap = "\x00" * width  # no passage crosses from one document to the next
        where = np.repeat(wanted, [len(cores[d]) + width for d in wanted])
        rows, places = self.grams.find(rolling(codes(gap.join([*(cores[d] for d in wanted), ""])), width))
        keys = np.unique(where[rows] * size + places)
        if not keys.size:
            return pairs[:0]
        doc, start = keys // size, keys % size
        item = self.item_of[start]
        # Seeds at consecutive places of an item are one passage.
        new = np.ones(len(keys), np.bool_)
        new[1:] = (keys[1:] != keys[:-1] + 1) | (item[1:] != item[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(keys)) - 1
        doc, item, begin, end = doc[first], item[first], start[first], start[last] + width
        if self.script == "en":
            long = self.ended[end] - self.begun[begin] >= PASSAGE_WORDS
            doc, item, begin, end = doc[long], item[long], begin[long], end[long]
        if len(doc) > 1:  # passages of an item may overlap
            same = (doc[1:] == doc[:-1]) & (item[1:] == item[:-1])
            begin[1:] = np.where(same, np.maximum(begin[1:], end[:-1]), begin[1:])
        held, place = np.unique(doc * n + item, return_inverse=True)
        covered = np.bincount(place, weights=np.maximum(0, end - begin), minlength=len(held))
        held = held[covered * 2 >= self.length[held % n]]
        return pairs[np.isin(pairs[:, 0] * n + pairs[:, 1], held)]

    def search(self, cores: list[str]) -> np.ndarray:
        """Rows (document, item id)."""
        pairs = self.candidates(cores)
        if len(pairs):
            pairs = self.verify(cores, pairs)
        return np.stack([pairs[:, 0], self.ids[pairs[:, 1]]], axis=1)


def item_indexes(block: Iterable[tuple[int, str, str]]) -> list[ItemIndex]:
    """Indexes of ``(item_id, script, text)``, one for each script and size of passages."""
    groups: dict[tuple[str, int], list[tuple[int, str, list[int]]]] = {}
    for i, script, text in block:
        c = core(text)
        words = word_sizes(text, c) if script == "en" else []
        passage = PASSAGE[script]
        if script == "en":  # the core characters of any 8 words in a row
            passage = min([passage, *(sum(words[k : k + PASSAGE_WORDS]) for k in range(len(words) - PASSAGE_WORDS + 1))])
        if len(c) >= passage and (script != "en" or len(words) >= PASSAGE_WORDS):
            groups.setdefault((script, passage), []).append((i, c, words))
    return [ItemIndex(script, passage, rows) for (script, passage), rows in sorted(groups.items())]


#: The index of a worker, by the query it was built for.
_INDEX: dict[str, list[ItemIndex]] = {}


def _blocks(rows: Iterable) -> Iterator[list]:
    block, chars = [], 0
    for row in rows:
        if block and (len(block) >= ITEM_BLOCK or chars + len(row[2] or "") > ITEM_CHARS):
            yield block
            block, chars = [], 0
        block.append(row)
        chars += len(row[2] or "")
    if block:
        yield block


def leaked_items(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``(doc_id, item_id)`` of every document that holds half of an item or more.

    ``documents`` has ``doc_id, text``; ``items`` has ``item_id, lang, text``.
    """
    spark = documents.sparkSession
    ship_package(spark)
    found = []
    query = items.select("item_id", F.lower(F.trim("lang")), "text").where("item_id is not null and text is not null")
    for block in _blocks(map(tuple, query.orderBy("item_id", "text").toLocalIterator())):
        held = spark.sparkContext.broadcast([(i, "en" if (lang or "").startswith("en") else "zh", t) for i, lang, t in block])
        found.append(documents.select("doc_id", "text").where("text is not null").mapInArrow(_searcher(held), "doc_id bigint, item_id bigint"))
    if not found:
        return documents.select("doc_id", F.lit(0).cast("bigint").alias("item_id")).limit(0)
    return reduce(DataFrame.unionAll, found)


def _searcher(held):
    number = uuid.uuid4().hex

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _INDEX.get(number)
        if index is None:
            _INDEX.clear()
            index = _INDEX[number] = item_indexes(held.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, end in slices(texts):
                ids, cores = batch.column(0).slice(start, end - start), [core(t) for t in texts[start:end]]
                rows = np.concatenate([x.search(cores) for x in index] or [np.zeros((0, 2), np.int64)])
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows[:, 0])), pa.array(rows[:, 1], pa.int64())], names=["doc_id", "item_id"])

    return search
