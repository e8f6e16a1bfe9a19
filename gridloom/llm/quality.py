"""Line labels by a hidden Markov model, and text statistics of documents.

A line is prose, list, table or junk; the hidden states refine these. Each line is described by discrete
features; a hidden Markov model scores the lines of
a document together, so that a wrapped line takes part of its label from its
neighbours. The model is fitted by hard expectation-maximisation on a bounded
sample (about ``SAMPLE`` documents chosen by hash), started
from lines that are beyond doubt. All documents are then labelled whole.

Null, empty and blank documents have no lines and no label.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.text import LINE_END, SPACES, strip
from gridloom.llm.sampling import hash_sample
from gridloom.llm.text_core import slices
from gridloom.session import ship_package

LABELS = ("prose", "list", "table", "junk")
#: The states of the model and the label of each: running text, titles, entries, series within a line, rows, odd signs, random letters.
STATES = ("text", "title", "entry", "series", "row", "signs", "letters")
LABEL_OF = np.array([0, 0, 1, 1, 2, 3, 3])
#: Documents the model is fitted on, rounds of fitting, and longest lines of one unit.
SAMPLE, ROUNDS, UNIT = 3_000, 6, 400

_BULLET = re.compile(r"^\s*(?:[-*+•·●○▪◦‣■□☐☑☒✓✔◆◇]|\\item\b|<li>)\s*(?=\S)")
_NUMBER = re.compile(
    r"^\s*(?:[0-9]{1,3}(?:\.[0-9]{1,3})+\.?\s|[0-9]{1,3}[.)）、．](?![0-9])|[(（](?:[0-9]{1,3}|[a-zA-Z]|[一二三四五六七八九十]{1,3})[)）]"
    r"|[a-zA-Z][.)）]\s|[一二三四五六七八九十]{1,3}[、.．)）]|[①-⑳])\s*"
)
_LEADER = re.compile(r"(?:(?<!\.)\.{4,}+|(?<!…)…{2,}+|(?<!·)·{4,}+)\s*+[0-9ivx]+\s*+$")
_GAPS = re.compile(r"\S(?: {2,}|\t)(?=\S)")
_CELL = re.compile(r"</t[dh]>|\|\||&(?= )")
_TAGS = re.compile(r"<[^<>]*>")
_LATIN = re.compile(r"[A-Za-z]+(?:'[a-z]+)?")
_VOWEL = re.compile(r"[aeiouAEIOU]")
_LONG = re.compile(r"[A-Za-z0-9+/=_%\\-]{28,}")
_HAN = re.compile(r"[㐀-鿿豈-﫿]+")
_PLAIN = re.compile(r"[0-9A-Za-z\s一-鿿，。；：、！？（）“”‘’《》【】…—,.;:!?()\[\]'\"|/%#*\-+=<>&_`~$\\{}^]+")
_ODD_HEAD = re.compile(r"^\s*[□☐☑☒✓✔•·●○▪◦‣■◆◇]\s?(?=\w)")
_SPLIT = re.compile("\r\n|[\n\r\v\f\x85\u2028\u2029]")
_STOP = re.compile(r"(?<=[。！？])|(?<=[a-z][.!?] )")
_HEX = re.compile(r"(?:\b[0-9a-f]{2}\b[ :]?){9,}|(?:[0-9a-f]{4,8} ){6,}", re.I)
_WIDE = re.compile(r"[０-９Ａ-Ｚａ-ｚ．％]")
_NARROW = {c: c - 0xFEE0 for c in (*range(0xFF10, 0xFF1A), *range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B), 0xFF0E, 0xFF05)}
_CLAUSE = re.compile(r"(?<![0-9])[,.;](?![0-9])")

_ENDS = tuple("。！？.!?:：")

#: Number of values of each feature.
CARDS = (4, 4, 4, 4, 3, 4, 4, 4, 4, 2, 3, 3, 3)


def line_features(line: str, common: frozenset[str]) -> tuple[int, ...]:
    n = len(line)
    seen = sum(map(len, line.split())) or 1
    cells = line.count("|") + line.count("\t") + line.count(";")
    if "  " in line:
        cells += len(_GAPS.findall(line))
    text = line
    if "<" in line:
        cells += 2 * len(_CELL.findall(line))
        text = _TAGS.sub(" ", line)
    digits = len(re.findall(r"[0-9]", text)) / seen
    if _BULLET.match(line):
        head = 1
    elif _NUMBER.match(line):
        head = 2
    else:
        head = 0
    if "." in line and _LEADER.search(line):
        head = 3
    last = text.rstrip()[-1:]
    end = 1 if last and last in "。！？.!?：:" else 2 if last and last in "，,、;；" else 3 if last.isdigit() or last == "|" else 0
    listed, stops = text.count("、"), text.count("，") + text.count("。") + text.count("；")
    latin = _LATIN.findall(text)
    if len(latin) * 4 > seen / 2 and not listed:
        listed, stops = text.count(","), 0
        share = sum(w.lower() in common for w in latin) / len(latin)
        per = listed / max(1, len(latin))
        series = 2 if per > 0.16 and share < 0.2 else 1 if listed else 0
        said = 1 + (share >= 0.14)
        used = 0 if share < 0.04 else 1 if share < 0.14 else 2 if share < 0.24 else 3
    else:
        han = "".join(_HAN.findall(text))
        share = sum(map(han.count, common)) / max(1, len(han)) if len(han) > 5 else 0.0
        if not stops and ("," in text or "." in text):
            stops = len(_CLAUSE.findall(text))
        said = 0 if not stops or not han else 1 if stops * 40 < len(han) else 2
        series = 2 if listed > 2 * stops else 1 if listed else 0
        used = 0 if share < 0.02 else 1 if share < 0.07 else 2 if share < 0.13 else 3
    odd = sum(map(len, _PLAIN.sub("", _ODD_HEAD.sub("", line)).split())) / seen
    han_all = "".join(_HAN.findall(text))
    rare = (len(han_all) - len(han_all.encode("gb2312", "ignore")) // 2) / seen if han_all else 0.0
    cut = lambda x: 0 if x < 0.01 else 1 if x < 0.08 else 2 if x < 0.3 else 3
    symbols = len(re.findall(r"[^\w\s，。；：、！？,.;:!?()（）|<>/]", text)) / seen
    letters = "".join(latin)
    vowels = len(_VOWEL.findall(letters)) / len(letters) if len(letters) > 11 else -1.0
    return (
        0 if cells == 0 else 1 if cells == 1 else 2 if cells < 4 else 3,
        0 if digits == 0 else 1 if digits < 0.15 else 2 if digits < 0.4 else 3,
        head,
        end,
        series,
        used,
        cut(odd),
        cut(rare),
        0 if n < 8 else 1 if n < 30 else 2 if n < 80 else 3,
        1 if _LONG.search(text) or _HEX.search(text) else 0,
        0 if symbols < 0.08 else 1 if symbols < 0.3 else 2,
        said,
        0 if vowels < 0 else 1 if vowels < 0.27 else 2,
    )


def certain(f: tuple[int, ...]) -> int:
    """The state of a line that is beyond doubt, else -1."""
    cells, digits, head, end, series, used, odd, rare, size, long_, symbols, said, vowels = f
    if odd == 3 or rare == 3 or (symbols == 2 and cells == 0 and head == 0 and size > 0):
        return 5
    if ((long_ and size >= 2) or (vowels == 1 and size == 3)) and used == 0 and said < 2 and cells < 3:
        return 6
    if odd or rare > 1 or long_ or vowels == 1:
        return -1
    if cells == 3 and (digits >= 2 or end == 3):
        return 4
    if head in (1, 3) and size <= 2 and cells < 2 and end != 1 and said < 2:
        return 2
    if head == 2 and size <= 1 and cells < 2 and end == 0 and said < 2:
        return 2
    if series == 2 and size == 3 and end != 1 and head == 0 and cells < 2:
        return 3
    if said == 2 and head == 0 and cells == 0 and size >= 2 and series < 2 and digits < 2:
        return 0
    if head == 0 and cells == 0 and size <= 1 and said == 0 and end == 0 and series == 0 and digits == 0:
        return 1
    return -1


def _stands_alone(line: str) -> bool:
    return (
        "|" in line
        or "\t" in line.strip()
        or line.count(";") > 1
        or "<t" in line
        or "</t" in line
        or _BULLET.match(line) is not None
        or _NUMBER.match(line) is not None
        or len(_GAPS.findall(line)) > 1
        or (".." in line and _LEADER.search(line) is not None)
    )


def units(text: str) -> list[str]:
    """Logical lines: hard-wrapped running text put together, and cut again after sentences at ``UNIT`` characters.

    Rows of cells, entries of lists and rows that end in leaders stand alone.
    """
    whole, run = [], []
    if _WIDE.search(text):
        text = text.translate(_NARROW)
    for line in _SPLIT.split(text):
        if not line or line.isspace():
            if run:
                whole.append(run)
                run = []
        elif _stands_alone(line):
            if run:
                whole.append(run)
                run = []
            whole.append([line])
        else:
            if run and run[-1].rstrip()[-1:] in _ENDS:
                whole.append(run)
                run = []
            run.append(line)
    if run:
        whole.append(run)
    out = []
    for run in whole:
        line = run[0] if len(run) == 1 else _glue(run)
        if len(line) <= UNIT:
            out.append(line)
            continue
        part = ""
        for piece in _STOP.split(line):
            while len(piece) > UNIT:
                out.append(part + piece[: UNIT - len(part)])
                piece, part = piece[UNIT - len(part) :], ""
            if len(part) + len(piece) > UNIT:
                out.append(part)
                part = ""
            part += piece
        if part:
            out.append(part)
    return [u for u in out if u and not u.isspace()]


def _glue(run: list[str]) -> str:
    """Lines of running text as one, with a space only between Latin words."""
    out = run[0].rstrip()
    parts = [out]
    for line in run[1:]:
        line = line.strip()
        if parts[-1][-1:].isascii() and line[:1].isascii():
            parts.append(" ")
        parts.append(line)
    return "".join(parts)


class LineModel:
    def __init__(self, common: list[str]):
        self.common = frozenset(w.lower() for w in common)
        self.first = np.log(np.full(7, 1 / 7))
        self.move = np.log(np.full((7, 7), 0.02) + np.eye(7) * 0.86)
        self.table = np.zeros((sum(CARDS), 7))
        self.shift = np.concatenate(([0], np.cumsum(CARDS)[:-1]))

    def describe(self, texts: list[str | None]) -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray]:
        """Features and sizes (non-space characters) of all lines, and lines of each text."""
        features, sizes, counts = [], [], []
        for t in texts:
            lines = units(t) if t else []
            counts.append(len(lines))
            for line in lines:
                features.append(line_features(line, self.common))
                sizes.append(sum(map(len, line.split())))
        return features, np.array(sizes, np.int64), np.array(counts, np.int64)

    def scores(self, features: np.ndarray) -> np.ndarray:
        return self.table[features + self.shift].sum(axis=1)

    def states(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Viterbi over all texts at once, one line of each a step."""
        if not len(features):
            return np.zeros(0, np.int64)
        emit = self.scores(features)
        order = np.argsort(-counts, kind="stable")
        start = np.concatenate(([0], np.cumsum(counts)[:-1]))[order]
        sizes = counts[order]
        back = np.zeros((len(features), 7), np.int8)
        best = np.empty((len(features), 7))
        for i in range(int(sizes[0])):
            n = int(np.searchsorted(-sizes, -(i + 1), side="right"))
            at = start[:n] + i
            if i == 0:
                best[at] = self.first + emit[at]
            else:
                ways = best[at - 1][:, :, None] + self.move
                back[at] = ways.argmax(axis=1)
                best[at] = ways.max(axis=1) + emit[at]
        out = np.zeros(len(features), np.int64)
        for i in range(int(sizes[0]) - 1, -1, -1):
            n = int(np.searchsorted(-sizes, -(i + 1), side="right"))
            at = start[:n] + i
            ended = sizes[:n] == i + 1
            out[at[ended]] = best[at[ended]].argmax(axis=1)
            go = at[~ended]
            out[go] = back[go + 1, out[go + 1]]
        return out

    def fit(self, texts: list[str]) -> LineModel:
        features, _, counts = self.describe(texts)
        return self.train(features, counts)

    def train(self, features: list[tuple[int, ...]], counts: np.ndarray) -> LineModel:
        """Hard expectation-maximisation over the lines of documents, one after another."""
        seeds = np.array([certain(f) for f in features] or [0])
        x = np.array(features or [(0,) * len(CARDS)])
        sure = np.flatnonzero(seeds >= 0)
        new_doc = np.zeros(len(x), np.bool_)
        new_doc[np.concatenate(([0], np.cumsum(counts)[:-1]))[counts > 0]] = True
        label, used = np.where(seeds >= 0, seeds, 0), sure
        for _ in range(ROUNDS):
            count = np.ones((sum(CARDS), 7)) * 0.5
            for k in range(len(CARDS)):
                np.add.at(count, (x[used, k] + self.shift[k], label[used]), 1.0)
            for k, c in enumerate(CARDS):
                rows = slice(self.shift[k], self.shift[k] + c)
                self.table[rows] = np.log(count[rows] / count[rows].sum(axis=0))
            if len(used) == len(x):
                moves = np.ones((7, 7)) * 2
                inner = np.flatnonzero(~new_doc)
                np.add.at(moves, (label[inner - 1], label[inner]), 1.0)
                self.move = np.log(moves / moves.sum(axis=1, keepdims=True))
                begins = np.bincount(label[new_doc], minlength=7) + 2.0
                self.first = np.log(begins / begins.sum())
            label = self.states(x, counts) if counts.sum() else label
            label[sure] = seeds[sure]  # the certain lines keep the states in their places
            used = np.arange(len(x))
        return self


#: Common words that are sent to every worker at most, and Latin ones up to which one pattern is quicker than a set.
COMMON_WORDS, PATTERN_WORDS = 200_000, 1_000


def all_common_words(common_words: DataFrame) -> list[str]:
    """Every word once in lower case, in order; more than can be sent to the workers are an error, never a part of the list."""
    rows = common_words.where("word is not null").select(F.lower("word").alias("w")).distinct().limit(COMMON_WORDS + 1).toLocalIterator()
    words = sorted(r[0] for r in rows)
    if len(words) > COMMON_WORDS:
        raise ValueError(f"common_words has more than {COMMON_WORDS} words")
    return words


def fitted_model(documents: DataFrame, common_words: DataFrame) -> LineModel:
    """Fit on about ``SAMPLE`` documents chosen by the hash of their id; the driver sees the features of their lines only."""
    ship_package(documents.sparkSession)
    model = LineModel(all_common_words(common_words))

    def reduce_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [np.array(model.describe([t])[0], np.int8).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.binary())], names=["doc_id", "lines"])

    sample = hash_sample(documents.select("doc_id", "text"), "doc_id", SAMPLE, "text").mapInArrow(reduce_, "doc_id bigint, lines binary").dropDuplicates(["doc_id"])
    rows = sorted((r[0], bytes(r[1])) for r in sample.toLocalIterator())
    seen = [np.frombuffer(lines, np.int8).reshape(-1, len(CARDS)) for _, lines in rows]
    return model.train([tuple(f) for x in seen for f in x.tolist()], np.array([len(x) for x in seen], np.int64))


def line_shares(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """``doc_id`` with non-space characters and the share of them in each kind of line; null shares for blank texts."""
    spark = documents.sparkSession
    ship_package(spark)
    model = spark.sparkContext.broadcast(fitted_model(documents, common_words))

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, end in slices(texts, 1_000):
                features, sizes, counts = m.describe(texts[start:end])
                x = np.array(features) if features else np.zeros((0, len(CARDS)), np.int64)
                label = LABEL_OF[m.states(x, counts)]
                doc = np.repeat(np.arange(len(counts)), counts)
                mass = np.bincount(doc * 4 + label, weights=sizes, minlength=len(counts) * 4).reshape(-1, 4)
                total = mass.sum(axis=1)
                with np.errstate(invalid="ignore", divide="ignore"):
                    shares = mass / total[:, None]
                arrays = [batch.column(0).slice(start, end - start), pa.array(total.astype(np.int64))]
                arrays += [pa.array(shares[:, k], mask=total == 0) for k in range(4)]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_seen", *LABELS])

    kinds = ", ".join(f"{x} double" for x in LABELS)
    return documents.select("doc_id", "text").mapInArrow(share, f"doc_id bigint, n_seen bigint, {kinds}")


def mostly_not_prose(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """``(doc_id, kind)`` of documents more than half of which is list, table or junk."""
    shares = line_shares(documents, common_words)
    kind = F.coalesce(*[F.when(F.col(k) > 0.5, F.lit(k)) for k in LABELS[1:]])
    return shares.select("doc_id", kind.alias("kind")).where("kind is not null")


#: Fixed values of the statistics: what is a word (a run of Latin letters and digits, or one ideograph), and what ends a line.
WORD, LINE_ENDS = "[a-z0-9]+|[一-鿿]", "。！？.!?；;：:…"


def text_statistics(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """Counts and ratios of every text, in built-in expressions.

    ``n_words``, ``mean_word_length``, ``symbol_ratio`` (of the non-space
    characters), ``line_end_ratio`` (of the non-blank lines) and
    ``common_ratio`` (of the words). A null text has null throughout; a ratio of
    nothing is null. All common words count; those that are no word
    here (several ideographs, or with other signs) equal none.
    """
    words = all_common_words(common_words)
    latin = [w for w in words if re.fullmatch("[a-z0-9]+", w)]
    others = [w for w in words if re.fullmatch("[一-鿿]", w)]
    low = F.lower("text")
    n_words = F.regexp_count(low, F.lit(WORD))
    in_words = F.length(low) - F.length(F.regexp_replace(low, "[a-z0-9一-鿿]+", ""))  # taking the longer runs out is cheaper
    n_seen = F.length(F.regexp_replace("text", f"[{SPACES}]+", ""))
    n_symbols = F.length(F.regexp_replace("text", f"[{SPACES}0-9A-Za-z一-鿿]+", ""))
    n_common = F.when(low.isNotNull(), 0)
    if len(latin) > PATTERN_WORDS:
        n_common = n_common + F.size(F.filter(F.regexp_extract_all(low, F.lit("[a-z0-9]+"), F.lit(0)), lambda w: w.isin(latin)))
    elif latin:
        n_common = n_common + F.regexp_count(low, F.lit(f"(?=[a-z0-9])(?<![a-z0-9])(?:{'|'.join(latin)})(?![a-z0-9])"))
    if others:
        n_common = n_common + F.length(low) - F.length(F.regexp_replace(low, f"[{''.join(others)}]+", ""))
    counted = documents.select("doc_id", n_words.alias("w"), in_words.alias("c"), n_seen.alias("s"), n_symbols.alias("y"), n_common.alias("k"), _solid_ends("text").alias("e"))
    ratio = lambda a, b: F.when(b > 0, a / b)
    e = F.col("e")
    return counted.select(
        "doc_id",
        F.col("w").cast("bigint").alias("n_words"),
        ratio(F.col("c"), F.col("w")).alias("mean_word_length"),
        ratio(F.col("y"), F.col("s")).alias("symbol_ratio"),
        ratio(F.size(F.filter(e, lambda x: x)), F.size(e)).alias("line_end_ratio"),
        ratio(F.col("k"), F.col("w")).alias("common_ratio"),
    )


def _solid_ends(column: str):
    """For each non-blank line whether it ends in punctuation; null for a null text."""
    lines = F.transform(F.split(column, LINE_END), strip)
    return F.transform(F.filter(lines, lambda x: x != ""), lambda x: x.rlike(f"[{LINE_ENDS}]\\z"))
