"""Putting the parts of a page together: overlapping lines, and grids of tiles with tables.

Line merging is a fold of built-in expressions. Grids of tiles are merged per
page; a page's tiles are bounded by its pixels.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.tables import Grid, join_row, parse_html, parse_pipe, stats, tidy, to_html, to_pipe
from gridloom.functions.text import let, lines, strip
from gridloom.session import ship_package

OVERLAP = 30


def overlap_length(done: Column, following: Column, most: int = OVERLAP) -> Column:
    """The longest k up to ``most`` for which the last k lines of one are the first k of the other."""
    limit = F.least(F.size(done), F.size(following), F.lit(most))
    fits = F.filter(
        F.sequence(F.lit(1), F.greatest(limit, F.lit(1))),
        lambda k: (k <= limit) & (F.slice(done, F.when(F.size(done) >= k, -k).otherwise(F.lit(1)), k) == F.slice(following, F.lit(1), k)),
    )
    return F.coalesce(F.array_max(fits), F.lit(0))


def edge_trimmed(part: Column) -> Column:
    """Lines of a part without blank ones at its edges."""

    def trim(all_: Column) -> Column:
        def cut(solid: Column) -> Column:
            first = F.array_position(solid, True).cast("int")
            last = F.size(solid) - F.array_position(F.reverse(solid), True).cast("int") + 1
            return F.when(first > 0, F.slice(all_, first, last - first + 1)).otherwise(F.array().cast("array<string>"))

        return let(F.transform(all_, lambda x: strip(x) != ""), cut)

    return let(lines(part), trim)


def merge_lines(parts: Column, most: int = OVERLAP) -> Column:
    """Parts (in order) as one text, repeated lines at the seams once; ends in a line end. No parts give an empty text."""
    empty = F.array().cast("array<string>")

    def step(done, following):
        rest = lambda k: F.slice(following, k + 1, F.greatest(F.size(following) - k, F.lit(0)))
        return F.concat(done, let(overlap_length(done, following, most), rest))

    folded = F.aggregate(F.transform(parts, edge_trimmed), empty, step)
    return let(folded, lambda all_: F.when(F.size(all_) == 0, F.lit("")).otherwise(F.concat(strip(F.array_join(all_, "\n")), F.lit("\n"))))


def merge_parts(rows: DataFrame, key: str, order: str, part: str) -> DataFrame:
    """``(key, text)``: the parts of each key in order, merged. A page has few parts."""
    listed = rows.where(F.col(part).isNotNull()).groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, part))).alias("_parts"))
    return listed.select(key, merge_lines(F.transform("_parts", lambda p: p[part])).alias("text"))


def preamble(text: Column) -> Column:
    """Text before the first table, null without one."""
    return F.when(F.lower(text).contains("<table"), F.regexp_extract(text, "(?is)^(.*?)<table", 1))


def postamble(text: Column) -> Column:
    return F.when(F.lower(text).contains("</table>"), F.regexp_extract(text, "(?is)^.*</table>(.*)$", 1))


def distinct_lines(texts: Column) -> Column:
    """Lines of several texts in order, each stripped, non-blank and once."""
    all_ = F.flatten(F.transform(texts, lambda t: F.transform(lines(F.coalesce(t, F.lit(""))), strip)))
    return F.array_join(F.array_distinct(F.filter(all_, lambda x: x != "")), "\n")


def _same(a, b) -> bool:
    return tuple(map(tidy, a)) == tuple(map(tidy, b))


def row_overlap(above: list, below: list, most: int) -> int:
    return next((k for k in range(min(len(above), len(below), most), 0, -1) if all(map(_same, above[-k:], below[:k]))), 0)


def column_overlap(left: list, right: list, most: int) -> int:
    """Most columns that end the left and begin the right; blanks alone prove nothing, two filled cells are needed."""
    for k in range(min(len(left), len(right), most), 0, -1):
        if all(map(_same, left[-k:], right[:k])) and sum(bool(tidy(v)) for column in right[:k] for v in column) >= 2:
            return k
    return 0


def repeated_prefix(first: list, later: list, most: int) -> int:
    k = 0
    while k < min(len(first), len(later), most) and _same(first[k], later[k]):
        k += 1
    return k


def _columns(g: Grid) -> list[tuple[str, ...]]:
    return list(zip(g.header, *g.rows))


def merge_horizontal(grids: list[Grid]) -> Grid | None:
    """Tables side by side: equal row counts; the label columns of the first are dropped where they come again, then columns both ends share."""
    if not grids or len({len(g.rows) for g in grids}) != 1:
        return None
    done = _columns(grids[0])
    for g in grids[1:]:
        new = _columns(g)
        new = new[repeated_prefix(_columns(grids[0]), new, 8) :]
        done += new[column_overlap(done, new, 5) :]
    grid = list(zip(*done))
    explicit = 2 * sum(g.explicit for g in grids) >= len(grids)
    return Grid(tuple(grid[0]), tuple(map(tuple, grid[1:])), explicit)


def merge_vertical(grids: list[Grid]) -> Grid | None:
    """Tables below each other with equal headers; rows that come again at the top and at the seams are dropped."""
    if not grids or any(not _same(g.header, grids[0].header) for g in grids):
        return None
    rows = list(grids[0].rows)
    for g in grids[1:]:
        new = list(g.rows)
        k = repeated_prefix(list(grids[0].rows), new, 5)
        new = new[k:]
        rows += new[row_overlap(rows, new, 10) :]
    return Grid(grids[0].header, tuple(rows), grids[0].explicit)


def _keys(g: Grid) -> list[int]:
    out = []
    for row in (g.rows[:1], g.rows[-1:]):
        out.append(next((int(c) for r in row for c in r[:8] if tidy(c).isdigit() and int(c) <= 130), -1))
    return out


def join_bands(bands: list[Grid]) -> list[Grid]:
    """Bands of a page whose row numbers go on (by 1 or 2) become one table; others stay apart."""
    out: list[list[Grid]] = []
    for band in bands:
        if out and (last := _keys(out[-1][-1])[1]) >= 0 and _keys(band)[0] - last in (1, 2):
            out[-1].append(band)
        else:
            out.append([band])
    joined = []
    for island in out:
        width = max(len(r) for g in island for r in (g.header, *g.rows))
        pad = lambda r: tuple(r) + ("",) * (width - len(r))
        rows = [pad(r) for r in island[0].rows]
        for g in island[1:]:
            if not _same(g.header, island[0].header):
                rows.append(pad(g.header))  # a header that is really a row
            rows += map(pad, g.rows)
        joined.append(Grid(pad(island[0].header), tuple(rows), island[0].explicit))
    return joined


def rebuild(tiles: list[tuple[int, int, str]]) -> str | None:
    """Tiles ``(row, column, text)`` of one page as tables, or None if any filled tile is no table."""
    bands = []
    for r in sorted({t[0] for t in tiles}):
        grids = []
        for _, _, text in sorted(t for t in tiles if t[0] == r):
            if not text.strip():
                continue
            grid = parse_pipe(text) or parse_html(text)
            if grid is None:
                return None
            grids.append(grid)
        if not grids:
            continue
        tall = max(len(g.rows) for g in grids)
        grids = [Grid(g.header, g.rows + (("",) * len(g.header),) * (tall - len(g.rows)), g.explicit) for g in grids]
        band = merge_horizontal(grids)
        if band is None:
            return None
        rows = list(band.rows)
        while rows and not any(map(tidy, rows[-1])):
            rows.pop()
        bands.append(Grid(band.header, tuple(rows), band.explicit))
    if not bands:
        return None
    whole = merge_vertical(bands)
    return "\n\n".join(map(to_pipe, [whole] if whole else join_bands(bands))) + "\n"


def coalesce_by_sequence(previous: Grid, local: Grid) -> Grid | None:
    """Previous cells with gaps filled from the local table, rows matched by their whole number in the first column.

    Short rows of the previous table are laid along the local row by their
    longest common subsequence. None unless every previous key is a local one.
    """
    by_key = {tidy(r[0]): r for r in local.rows if r and tidy(r[0]).isdigit()}
    known = [tidy(r[0]) for r in previous.rows if r and tidy(r[0]).isdigit()]
    if not known or any(k not in by_key for k in known) or len(set(known)) != len(known):
        return None
    earlier = {tidy(r[0]): r for r in previous.rows if r}
    rows = []
    for key, row in sorted(by_key.items(), key=lambda kv: int(kv[0])):
        old = earlier.get(key, ())
        if old and len(old) != len(row):
            old = _laid_along(list(map(tidy, old)), list(map(tidy, row)))
        rows.append(tuple((old[i] if i < len(old) and tidy(old[i]) else c) for i, c in enumerate(row)))
    return Grid(local.header, tuple(rows), local.explicit)


def _laid_along(short: list[str], long: list[str]) -> list[str]:
    n, m = len(short), len(long)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if short[i] == long[j] else max(best[i + 1][j], best[i][j + 1])
    if best[0][0] < max(3, n / 2):
        return [""] * m
    out, i, j = [""] * m, 0, 0
    while i < n and j < m:
        if short[i] == long[j]:
            out[j] = short[i]
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


_TABLES = re.compile(r"<table\b.*?</table\s*>", re.I | re.S)


def coalesce_adjacent(text: str) -> str:
    """HTML tables with nothing but space between them become one where they are equally wide and their row numbers go on."""
    found = list(_TABLES.finditer(text))
    out, at = [], 0
    run: list[re.Match] = []

    def flush() -> None:
        if run:
            bodies = [re.sub(r"^<table[^<>]*>|</table\s*>$", "", m.group(), flags=re.I) for m in run]
            out.append(re.match(r"<table[^<>]*>", run[0].group(), re.I).group() + "".join(bodies) + "</table>")
            run.clear()

    for m in found:
        if run and text[run[-1].end() : m.start()].strip() == "" and _goes_on(run[-1].group(), m.group()):
            run.append(m)
        else:
            flush()
            out.append(text[at : m.start()])
            run.append(m)
        at = m.end()
    flush()
    return "".join([*out, text[at:]])


def _goes_on(left: str, right: str) -> bool:
    a, b = parse_html(left), parse_html(right)
    if a is None or b is None or len(a.header) != len(b.header) or len(a.header) < 2:
        return False
    number = lambda g: [int(r[0]) for r in (g.header, *g.rows) if tidy(r[0]).isdigit()]
    x, y = number(a), number(b)
    return bool(x) and bool(y) and min(y) == max(x) + 1


def block_overlap(left: list[str], right: list[str], most: int = 8, least: int = 2) -> int:
    """The longest run of blocks at the end of one that come again at the start of the other; long blocks need only be alike."""
    alike = lambda a, b: a == b or (len(a) >= 80 and len(b) >= 80 and SequenceMatcher(None, a, b).ratio() >= 0.94)
    for k in range(min(most, len(left), len(right)), least - 1, -1):
        if all(map(alike, left[-k:], right[:k])):
            return k
    return 0


def merge_blocks(parts: list[str]) -> str:
    done: list[str] = []
    for part in parts:
        blocks = [" ".join(b.split()) for b in re.split(r"\n\s*\n", part) if b.strip()]
        raw = [b.strip("\n") for b in re.split(r"\n\s*\n", part) if b.strip()]
        done += raw[block_overlap([" ".join(b.split()) for b in done], blocks) :]
    return "\n\n".join(done) + "\n" if done else ""


def keep_context(previous: str, repaired: str) -> str:
    """The prose around the previous table with the repaired table in it, if both have one table with the same header or axis."""
    split = lambda t: re.match(r"(?s)(.*?)((?:^[ \t]*\|[^\n]*(?:\n|\Z))+)(.*)\Z", t, re.M)
    a, b = split(previous), split(repaired)
    if not a or not b:
        return repaired
    old, new = parse_pipe(a.group(2)), parse_pipe(b.group(2))
    if old is None or new is None or not _compatible(old.header, new.header):
        return repaired
    return a.group(1) + b.group(2).rstrip("\n") + "\n" + a.group(3)


def _compatible(a: tuple[str, ...], b: tuple[str, ...]) -> bool:
    if _same(a, b):
        return True
    axis = lambda h: [tidy(c) for c in h if tidy(c).isdigit()]
    return len(axis(a)) >= 4 and axis(a) == axis(b) and (tidy(a[0]) in tidy(b[0]) or tidy(b[0]) in tidy(a[0]))


def thousands_by_vote(grid: Grid, least: int = 10, times: int = 3) -> Grid:
    """Columns in which most thousands are set off by commas get commas where a point stands for one."""
    rows = [list(r) for r in grid.rows]
    for c in range(len(grid.header)):
        cells = [r[c] for r in rows if c < len(r)]
        commas = sum(bool(re.fullmatch(r"\d{1,3}(?:,\d{3})+(?:\.\d+)?", v)) for v in cells)
        points = sum(bool(re.fullmatch(r"\d{1,3}\.\d{3}", v)) for v in cells)
        if commas >= least and commas >= times * points:
            for r in rows:
                if c < len(r) and re.fullmatch(r"\d{1,3}\.\d{3}", r[c]):
                    r[c] = r[c].replace(".", ",")
    return Grid(grid.header, tuple(map(tuple, rows)), grid.explicit)


def deepest_heading(text: str) -> str | None:
    """The label of the one heading at the deepest level before the first table, or None."""
    before = re.split(r"<table\b|^[ \t]*\|", text, maxsplit=1, flags=re.I | re.M)[0]
    heads = [(len(m.group(1)), m.group(2).strip()) for m in re.finditer(r"^(#{1,6})[ \t]+(.+)$", before, re.M)]
    if not heads:
        return None
    level = max(n for n, _ in heads)
    labels = {t for n, t in heads if n == level}
    return labels.pop() if len(labels) == 1 else None


def remerge(base: str, tiles: list[tuple[int, int, str]], max_duplicate: float = 0.30) -> str | None:
    """The rebuilt page if it only repairs the base: tables rebuilt, no more of them, as many rows, little repetition; else None."""
    built = rebuild(tiles)
    if built is None:
        return None
    old, new = stats(base), stats(built)
    solid = [tidy(x) for x in built.splitlines() if x.strip()]
    if new[0] > old[0] or new[1] != old[1] or 1 - len(set(solid)) / max(1, len(solid)) > max_duplicate:
        return None
    return built


def rebuild_pages(tiles: DataFrame, key: str, row: str = "row", col: str = "col", text: str = "text") -> DataFrame:
    """``(key, text)``: the tables of each page from its tiles, null where they cannot be put together."""
    ship_package(tiles.sparkSession)
    listed = tiles.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(row, col, F.coalesce(text, F.lit("")).alias("t")))).alias("tiles"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [rebuild([tuple(t.values()) for t in ts]) for ts in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    kind = tiles.schema[key].dataType.simpleString()
    return listed.mapInArrow(build, f"`{key}` {kind}, text string")


def fill_tables(pairs: DataFrame, key: str, previous: str, local: str) -> DataFrame:
    """``(key, text)``: previous tables with cells filled from local ones by row number, null where the rows do not belong together."""
    ship_package(pairs.sparkSession)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                old, new = parse_pipe(a or ""), parse_pipe(b or "")
                grid = coalesce_by_sequence(old, new) if old and new else None
                out.append(grid and to_pipe(grid))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=[key, "text"])

    return pairs.select(key, previous, local).mapInArrow(fill, f"`{key}` {pairs.schema[key].dataType.simpleString()}, text string")


def to_two_row_header(grid: Grid, leaves_from: int, label: str) -> str:
    """HTML of a table whose columns from ``leaves_from`` on stand under one label."""
    if not 0 < leaves_from < len(grid.header):
        return to_html(grid)
    plain = to_html(Grid(grid.header, grid.rows, grid.explicit))
    first = "<tr>" + "".join(f'<th rowspan="2">{h}</th>' for h in grid.header[:leaves_from]) + f'<th colspan="{len(grid.header) - leaves_from}">{label}</th></tr>'
    second = "<tr>" + "".join(f"<th>{h}</th>" for h in grid.header[leaves_from:]) + "</tr>"
    body = plain.split("\n")[2:]
    return "\n".join(["<table>", first, second, *body])


__all__ = ["join_row", "merge_lines", "merge_parts", "rebuild", "rebuild_pages"]
