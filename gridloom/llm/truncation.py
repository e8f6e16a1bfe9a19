"""Texts that were cut off.

A hashed logistic regression is trained on rows of the table itself: rows that
end beyond doubt are intact, and artificial cuts of them are the positives.
Its features are the closing characters, what stands open at the end (tags,
fences, brackets, emphasis, environments, rows with missing cells, series) and
whether the length is one at which texts of the corpus pile up. All rows are
then scored whole.

Closing lines (dates, page and end marks) are last lines that a fair share of
all rows has and that no longer lines begin with; they and lengths that pile up
are counted over all rows. Null and blank texts are not cut.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.llm.sampling import hash_sample
from gridloom.session import cut_lineage, ship_package

#: Rows the classifier is fitted on, cuts made of each intact row, width of the hashed features.
SAMPLE, CUTS, BITS = 6_000, 3, 16
#: How often a length or a closing line must occur at least, and the rows for which a closing line must occur once.
#: The last is the same share of a table of any size.
LEAST, ROWS_A_CLOSER = 5, 10_000
#: Characters of a closing line at most: a date, a page mark or an end mark, not a sentence.
CLOSING = 24
#: A limit has so many times the mean count of the lengths up to ``AROUND`` away; those up to ``BESIDE`` away are left
#: out, since characters of several bytes and marks put behind a cut spread it. By chance a table has ``CHANCE`` such.
TIMES, AROUND, BESIDE, CHANCE = 4, 32, 4, 0.01
#: A full date is a whole line even where other lines begin with one.
_DATE = r"^9(年9月9日|([-/.])9\2 ?9)$"
_ODD_CLOSER = r"[。；;，,|.:：、]$|^[-*·#=]|  |9 9|[&<>|\\]"

_END = "。！？!?.…；;：:"
_CLOSED = re.compile(r"[。！？.!?][\s\"'”’」』）)*`_]*+(?:\{\{[^{}]*+\}\}|\\footnote\{[^{}]*+\}|<!--[^<>]*+(?<=--)>|</[a-z0-9]++>|[\s*`_）)\]])*+$")
_MARK = re.compile(r"(?:\s*+(?:\[[^\[\]\n]{1,24}\]|[（(<【][^（）()<>【】\n]{1,12}[)）>】]|\.{3,}+|…++|~++|—++|-{2,}+|\ufffd++))++\s*+$")
_TOKEN = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)(?:\s[^<>]*)?(/?)>")
_VOID = frozenset(("br", "hr", "img", "input", "meta", "link", "col"))
_BLOCK_END = re.compile(r"(?:</(?:ul|ol|pre|div|blockquote)>|\\end\{[a-z]+\})$")
_ENV = re.compile(r"\\(begin|end)\{([^{}]*)\}")
_PAIRS = {"(": ")", "（": "）", "[": "]", "{": "}", "《": "》", "“": "”", "「": "」", "【": "】"}
_BULLET = re.compile(r"^\s*(?:[-*·•]|\\item|[0-9]+[.、)]|[（(][0-9]+[)）])")
_HEADING = re.compile(r"^\s*(?:#{1,6}\s|=+[^=\n]+=+\s*$|\\(?:sub)*section\{|第[一二三四五六七八九十百]+[条章节])")
_SHAPES = [(re.compile(r"[一-鿿]"), "汉"), (re.compile(r"[A-Za-z]"), "a"), (re.compile(r"[0-9]"), "9")]


def shape(text: str) -> str:
    for pattern, letter in _SHAPES:
        text = pattern.sub(letter, text)
    return text


def masked(line: str) -> str:
    return re.sub(r"[0-9]+", "9", line.strip())


def open_tags(text: str) -> list[str]:
    stack: list[str] = []
    for close, name, alone in _TOKEN.findall(text):
        name = name.lower()
        if name in _VOID or alone:
            continue
        if not close:
            stack.append(name)
        elif name in stack:
            while stack.pop() != name:
                pass
    return stack


def cells(line: str) -> tuple[str, int]:
    """Kind of row and number of cells."""
    line = line.strip()
    if line.startswith("|") and "||" in line:
        return "wiki", line.count("||") + 1
    if line.startswith("|") and not line.startswith(("|}", "|-")):
        return "pipe", line.count("|")
    if " & " in line or line.endswith("&"):
        return "tex", line.count("&")
    parts = re.split(r"\t| {2,}", line)
    return ("gap", len(parts)) if len(parts) > 1 else ("", 0)


def _trailing_mark(body: str) -> re.Match | None:
    """The marks that stand after the end, however many; sought from the end in growing parts."""
    size = 80
    while True:
        near = max(0, len(body) - size)
        mark = _MARK.search(body, near)
        if not near or mark is None or mark.start() > near:
            return mark
        size *= 4


def features(text: str, lengths: frozenset[int], closers: frozenset[str]) -> list[str]:
    body = text.rstrip()
    out = [f"bytes:{len(text.encode('utf-8', 'replace')) in lengths}", f"chars:{len(text) in lengths}", f"trail:{len(text) > len(body)}"]
    out.append("over" if "\ufffd" in body[-2:] else "whole")
    mark = _trailing_mark(body)
    lines = body.rsplit("\n", 1)
    closed_by = ""
    for _ in range(2):
        if masked(lines[-1]) in closers and len(lines) > 1:
            closed_by = masked(lines[-1])
            body = lines[0].rstrip()
            lines = body.rsplit("\n", 1)
    if closed_by:
        out += ["closer", f"closer:{closed_by}"]
    elif mark and mark.start() > 0:
        bare = body[: mark.start()].rstrip()
        if bare and bare != body:
            out += ["mark", f"mark:{masked(mark.group())}"]
            body = bare
            lines = body.rsplit("\n", 1)
    last = lines[-1].strip()
    closer = "+" if closed_by else ""
    tail = shape(body[-8:])
    done = _CLOSED.search(body) is not None
    out.append(f"done:{done}{closer}")
    out += [f"t{n}{closer}:{tail[-n:]}" for n in (1, 2, 3, 4)]
    if body:
        out.append(f"ch{closer}:{body[-1]}" if not body[-1].isalnum() else "ch:alnum" + closer)
    stack = open_tags(body)
    out.append(f"stack{closer}:{'/'.join(stack[-2:])}")
    opened = last.rfind("<")
    if opened > last.rfind(">"):
        out.append("opentag:" + str(bool(re.match(r"<[/a-zA-Z!]", last[opened:]))))
    part = body.rsplit("\n\n", 1)[-1]
    out.append(f"bold:{part.count('**') % 2}{done}")
    out.append(f"tick:{part.count('`') % 2 if '```' not in part else 2}{done}")
    out.append(f"fence:{body.count('```') % 2}{closer}")
    out.append(f"quotes:{part.count(chr(39) * 3) % 2}{done}")
    out.append(f"comment:{body.rfind('<!--') > body.rfind('-->')}")
    out.append(f"math:{part.count('$') % 2}{done}")
    for left, right in _PAIRS.items():
        if last.count(left) > last.count(right):
            out.append(f"open:{left}{done}")
    envs = []
    for what, name in _ENV.findall(body):
        if what == "begin":
            envs.append(name)
        elif name in envs:
            envs.remove(name)
    if envs:
        out.append(f"env{closer}:{envs[-1]}{done}")
    if body.count("{|") > body.count("|}"):
        out.append(f"wikitable{closer}")
    if body.endswith(("</table>", "|}", "```")) or _BLOCK_END.search(last):
        out.append(f"block{closer}:{len(stack)}{len(envs)}{body.count('```') % 2}")
    kind, n = cells(last)
    above = lines[0].rstrip("\n").rsplit("\n", 2)[-2:] if len(lines) > 1 else []
    peers = [m for k, m in map(cells, above) if k == kind]
    if kind:
        fit = "alone" if not peers else "short" if n < max(peers) else "long" if n > max(peers) else "even"
        out += [f"row{closer}:{kind}{fit}", f"row{closer}:{kind}{fit}{tail[-1:]}"]
    if _BULLET.match(last):
        peer = [a.strip()[-1:] for a in above if _BULLET.match(a)]
        out.append(f"item{closer}:{done}{last[-1:] in '；;'}{bool(peer) and all(p in _END for p in peer)}")
    if _HEADING.match(last):
        out.append("heading" + closer)
    elif len(lines) > 1 and last and not done and not kind:
        out.append(f"loose{closer}:{len(last) < 30}{bool(above) and not above[-1].strip()}")
    return out


def ends_well(text: str, closers: frozenset[str]) -> bool:
    """Beyond doubt: a finished sentence, row or block at the end and nothing left open."""
    body = text.rstrip()
    if not body or "\ufffd" in body[-2:] or body.endswith(("...", "…")):
        return False
    lines = body.rsplit("\n", 1)
    if masked(lines[-1]) in closers and len(lines) > 1:
        body = lines[0].rstrip()
        lines = body.rsplit("\n", 1)
        if body and masked(lines[-1]) in closers:
            return True
    if open_tags(body) or body.count("```") % 2 or body.count("{|") > body.count("|}") or len(re.findall(r"\\begin\{", body)) != len(re.findall(r"\\end\{", body)):
        return False
    part = body.rsplit("\n\n", 1)[-1]
    if part.count("**") % 2 or part.count("`") % 2:
        return False
    if body.endswith(("</table>", "|}", "```")) or re.search(r"\\end\{[a-z]+\}$", body):
        return True
    kind, n = cells(lines[-1])
    if kind in ("pipe", "gap") and len(lines) > 1:
        above = cells(lines[0].rsplit("\n", 1)[-1])
        return above == (kind, n) and (kind == "gap" or lines[-1].endswith("|"))
    if _BULLET.match(lines[-1]) and lines[-1].endswith(("；", ";")):
        return True
    return _CLOSED.search(body) is not None


def hashed(features_: list[str]) -> list[int]:
    mask = (1 << BITS) - 1
    return [zlib.crc32(f.encode("utf-8", "replace")) & mask for f in features_]


def _flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Row and hashed feature of every entry."""
    return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.array([c for r in rows for c in r], np.int64)


class Classifier:
    """Hashed logistic regression over ``features``; ``lengths`` and ``closers`` are what the corpus piles up at."""

    def __init__(self, lengths: frozenset[int], closers: frozenset[str]):
        self.lengths, self.closers = lengths, closers
        self.weight, self.bias = np.zeros(1 << BITS), 0.0

    def score(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        row, column = _flat([hashed(features(t, self.lengths, self.closers)) for t in texts])
        z = np.bincount(row, weights=self.weight[column], minlength=len(texts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def examples(self, text: str) -> tuple[list[list[int]], list[float]]:
        """A text that ends beyond doubt (0) and cuts of it (1) as hashed features; nothing of other texts.

        Cuts are drawn from the text itself, so they are the same wherever and whenever it is read.
        """
        if not text or not ends_well(text, self.closers):
            return [], []
        rng = np.random.default_rng(zlib.crc32(text.encode("utf-8", "replace")))
        body, pieces = text.rstrip(), [text]
        fits = [n for n in sorted(self.lengths) if n < len(body) - 1]
        for k in range(CUTS if len(body) >= 24 else 0):
            at = int(rng.choice(fits)) if fits and k == 0 else int(rng.integers(max(8, len(body) // 5), len(body) - 1))
            if k == 2:  # breaks near the end of the last block
                at = len(body) - int(rng.integers(1, min(60, len(body) - 8)))
            piece = body[:at]
            if ends_well(piece, self.closers) or masked(piece.rsplit("\n", 1)[-1]) in self.closers or not piece.strip():
                continue  # the cut fell where a sentence ends
            draw = rng.random()
            if draw < 0.08:
                piece += str(rng.choice([" [truncated]", "…", "...", "……", " [...]", "（未完）", "——"]))
            elif draw < 0.12:
                piece += "\n"
            elif draw < 0.16 and self.closers:
                piece += "\n\n" + str(rng.choice(sorted(self.closers))).replace("9", "12")
            elif draw < 0.22:
                piece += "\ufffd"
            pieces.append(piece)
        return [hashed(features(p, self.lengths, self.closers)) for p in pieces], [0.0] + [1.0] * (len(pieces) - 1)

    def fit(self, texts: list[str]) -> Classifier:
        made = [self.examples(t) for t in texts]
        return self.train([r for rows, _ in made for r in rows], [y for _, labels in made for y in labels])

    def train(self, x: list[list[int]], y: list[float]) -> Classifier:
        """Both kinds weigh the same; full steps by moments of the gradient."""
        if not any(y):
            return self
        row, column = _flat(x)
        target, n = np.array(y), len(y)
        share = np.where(target == 1, n / 2 / target.sum(), n / 2 / max(1.0, n - target.sum()))
        used, place = np.unique(column, return_inverse=True)
        w, b = np.zeros(len(used)), 0.0
        m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
        for step in range(1, 301):
            z = np.bincount(row, weights=w[place], minlength=n) + b
            error = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / n
            g = np.append(np.bincount(place, weights=error[row], minlength=len(used)) + 1e-4 * w, error.sum())
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            w, b = w - move[:-1], b - move[-1]
        self.weight[used], self.bias = w, float(b)
        return self


def closing_lines(held: DataFrame, closings: DataFrame, n_rows: int, text: str) -> frozenset[str]:
    """Last lines that are whole lines of their own: no rarer than once in ``ROWS_A_CLOSER`` rows, and no beginnings.

    A fragment that a cut left after a line break is the beginning of lines that
    go on elsewhere, and more of them go on than break off there; a closing line
    stands alone. Both tests are shares, so a larger table of the same kind has
    the same closing lines. ``closings`` has ``closing`` of each row.
    """
    level = max(LEAST, -(-n_rows // ROWS_A_CLOSER))
    counts = closings.where("closing <> ''").groupBy("closing").agg(F.count("*").alias("n")).where(F.col("n") >= level)
    alone = {r[0]: r[1] for r in counts.where(~F.col("closing").rlike(_ODD_CLOSER)).toLocalIterator()}  # ROWS_A_CLOSER at most
    if not alone:
        return frozenset()
    sizes = sorted({len(c) for c in alone})
    wanted = held.sparkSession.sparkContext.broadcast(frozenset(alone))

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[str] = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                for line in map(masked, t.split("\n")):
                    for size in sizes:
                        if size >= len(line):
                            break
                        if line[:size] in wanted.value:
                            n[line[:size]] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["closing", "n"])

    longer = {r[0]: r[1] for r in held.select(text).mapInArrow(go_on, "closing string, n bigint").groupBy("closing").agg(F.sum("n")).toLocalIterator()}
    return frozenset(c for c, n in alone.items() if longer.get(c, 0) <= n or re.search(_DATE, c))


def length_limits(lengths: DataFrame) -> frozenset[int]:
    """Values of ``length`` that rows pile up at: ``TIMES`` as many as at the lengths around, and more than chance gives.

    Lengths are gathered in blocks of ``AROUND`` with the blocks on either side,
    so no part of the histogram is larger than three blocks.
    """
    counts = lengths.groupBy("length").agg(F.count("*").alias("n"))
    block = F.floor(F.col("length") / AROUND)
    near = counts.withColumn("block", F.explode(F.array(block - 1, block, block + 1)))
    by_block = Window.partitionBy("block").orderBy("length")
    around = F.sum("n").over(by_block.rangeBetween(-AROUND, AROUND)) - F.sum("n").over(by_block.rangeBetween(-BESIDE, BESIDE))
    seen = cut_lineage(near.withColumn("usual", around / (2 * (AROUND - BESIDE))).where(F.col("block") == block).select("length", "n", "usual"))
    tested = seen.count()
    piled = seen.where((F.col("length") > 64) & (F.col("n") >= LEAST) & (F.col("n") >= TIMES * F.col("usual")))
    return frozenset(k for k, n, usual in piled.toLocalIterator() if poisson_tail(n, usual) * tested < CHANCE)


def poisson_tail(n: int, mean: float) -> float:
    """Upper bound of the chance of ``n`` or more where ``mean`` are usual, ``n`` being larger."""
    if mean <= 0:
        return 0.0
    return math.exp(n * math.log(mean) - mean - math.lgamma(n + 1)) / (1 - mean / (n + 1))


def fitted_classifier(cells_: DataFrame, text: str = "ground_truth", key: str = "row_id") -> Classifier:
    """Corpus counts over all rows, then the fit on a bounded sample.

    The sample is reduced to hashed features where it is read; the driver sees no text.
    """
    ship_package(cells_.sparkSession)
    whole = F.rtrim(F.col(text), F.lit(" \t\n\x0b\f\r"))
    last = F.substring_index(whole, "\n", -1)
    closing = F.when((F.length(last) <= CLOSING) & (F.length(last) < F.length(whole)), F.trim(F.regexp_replace(last, r"[0-9]+", "9"))).otherwise("")
    # Each key once, after texts are reduced to what is counted.
    held = cells_.where(F.length(F.trim(text)) > 0)
    narrow = held.select(key, F.length(text).alias("chars"), F.octet_length(text).alias("bytes"), closing.alias("closing")).dropDuplicates([key])
    # A text whose characters are bytes has one length.
    lengths = length_limits(narrow.select(F.explode(F.array_distinct(F.array("chars", "bytes"))).alias("length")))
    model = Classifier(lengths, closing_lines(held, narrow, narrow.count(), text))

    def reduce_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [model.examples(t) for t in batch.column(1).to_pylist()]
            columns = [pa.array([m[0] for m in made], pa.list_(pa.list_(pa.int32()))), pa.array([m[1] for m in made], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[key, "x", "y"])

    kind = cells_.schema[key].dataType.simpleString()
    sample = hash_sample(held.select(key, text), key, SAMPLE, text).mapInArrow(reduce_, f"`{key}` {kind}, x array<array<int>>, y array<double>").dropDuplicates([key])
    rows = sorted(tuple(r) for r in sample.toLocalIterator())  # about SAMPLE rows of numbers
    return model.train([x for r in rows for x in r[1]], [y for r in rows for y in r[2]])


def cut_scores(cells_: DataFrame, text: str = "ground_truth", key: str = "row_id") -> DataFrame:
    """``(key, source, score)`` of each row once; null and blank texts have score 0."""
    spark = cells_.sparkSession
    ship_package(spark)
    model = spark.sparkContext.broadcast(fitted_classifier(cells_, text, key))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            texts = batch.column(2).to_pylist()
            full = [i for i, t in enumerate(texts) if t and not t.isspace()]
            scores = np.zeros(len(texts))
            scores[full] = m.score([texts[i] for i in full])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores)], names=[key, "source", "score"])

    kind = cells_.schema[key].dataType.simpleString()
    scored = cells_.select(key, "source", text).mapInArrow(score, f"`{key}` {kind}, source string, score double")
    return scored.dropDuplicates([key])


def cut_rows(cells_: DataFrame) -> DataFrame:
    return cut_scores(cells_).where("score >= 0.5").select("row_id")


def cut_report(cells_: DataFrame) -> DataFrame:
    """Rows, cut rows and rate of each source (null is a source of its own)."""
    return (
        cut_scores(cells_)
        .groupBy("source")
        .agg(F.count("*").alias("n_rows"), F.count_if(F.col("score") >= 0.5).alias("n_cut"))
        .withColumn("rate", F.round(F.col("n_cut") / F.col("n_rows"), 6))
    )
