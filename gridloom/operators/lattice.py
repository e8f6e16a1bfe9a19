"""Text boxes of a page back into reading order, and into a numeric matrix.

Everything here is per group of boxes (a page or slice), whose distinct boxes
its pixels bound. Boxes are sorted by place before anything is decided, so the
order in which they arrive means nothing.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from statistics import median

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.tables import Grid, to_pipe
from gridloom.session import ship_package

NUMBER = re.compile(r"[+-]?[\d,]*\.?\d+")
MARKER = re.compile(r"^\s*(?:[-*·•]|[(（]?\d{1,3}[.)）、]|第[一二三四五六七八九十百]+[条章节])")


@dataclass(frozen=True)
class Box:
    x: float
    y: float
    width: float
    height: float
    confidence: float
    text: str

    @property
    def left(self) -> float:
        return self.x - self.width / 2

    @property
    def right(self) -> float:
        return self.x + self.width / 2


def number(text: str) -> str | None:
    """The text of a number without gaps after commas and points, else None."""
    tight = re.sub(r"(?<=\d)([,.])\s+(?=\d)", r"\1", text.strip())
    return tight if NUMBER.fullmatch(tight) else None


def in_reading_order(boxes: list[Box], least: float = 0.25) -> str:
    """Lines from bands of boxes around a running median, doubled boxes once, paragraphs where the gap is wide."""
    seen = sorted((b for b in boxes if b.confidence >= least and b.text.strip()), key=lambda b: (b.y, b.x, b.text))
    if not seen:
        return ""
    tall = median(b.height for b in seen)
    bands: list[list[Box]] = []
    for b in seen:
        if bands and abs(b.y - median(o.y for o in bands[-1])) <= max(3.0, 0.65 * tall):
            bands[-1].append(b)
        else:
            bands.append([b])
    lines: list[tuple[float, str]] = []
    for band in bands:
        kept: list[Box] = []
        for b in sorted(band, key=lambda b: (b.x, -b.confidence)):
            twin = next((k for k, o in enumerate(kept) if _doubled(o, b)), None)
            if twin is None:
                kept.append(b)
            elif b.confidence > kept[twin].confidence:
                kept[twin] = b
        text = "".join(b.text.strip() for b in sorted(kept, key=lambda b: b.x))
        y = median(b.y for b in band)
        if not lines or lines[-1][1] != text or y - lines[-1][0] > max(3.0, 0.65 * tall) * 2:
            lines.append((y, text))
    gaps = [b[0] - a[0] for a, b in zip(lines, lines[1:])]
    usual = median(gaps) if gaps else 0.0
    out = [lines[0][1]]
    for (y0, above), (y1, line) in zip(lines, lines[1:]):
        wide = y1 - y0 > max(1.8 * tall, 1.45 * usual)
        apart = wide or MARKER.match(above) or MARKER.match(line) or (len(above) <= 80 and y1 - y0 > 1.2 * usual)
        out.append(("\n\n" if apart else "\n") + line)
    return "".join(out) + "\n"


def _doubled(a: Box, b: Box) -> bool:
    shared = min(a.right, b.right) - max(a.left, b.left)
    if shared >= 0.8 * min(a.width, b.width) > 0:
        return True
    return a.text == b.text and abs(a.x - b.x) <= 0.35 * max(a.width, b.width)


def clusters(values: list[float], tolerance: float) -> list[tuple[float, int]]:
    """Mean and size of groups of sorted values by the distance to the mean so far."""
    out: list[list[float]] = []
    for v in sorted(values):
        if out and v - out[-1][0] / out[-1][1] <= tolerance:
            out[-1][0] += v
            out[-1][1] += 1
        else:
            out.append([v, 1])
    return [(total / n, int(n)) for total, n in out]


def walk(centers: list[tuple[float, int]], step: float) -> list[float]:
    """From the first centre on, the one a step further within 0.38 of it with most evidence, until there is none."""
    if not centers or step <= 0:
        return []
    out, at = [centers[0][0]], centers[0][0]
    places = [c for c, _ in centers]
    while len(out) < 10_000:
        want = at + step
        low, high = bisect.bisect_left(places, want - 0.38 * step), bisect.bisect_right(places, want + 0.38 * step)
        near = [c for c in centers[low:high] if c[0] > at]
        if not near:
            break
        at = max(near, key=lambda c: (c[1], -abs(c[0] - want)))[0]
        out.append(at)
    return out


def merge_fragments(boxes: list[Box]) -> list[Box]:
    """Numbers that a seam cut in two are put together: in a row, where the right part is a fraction or the left lacks its last digits."""
    left_over = sorted(boxes, key=lambda b: (b.y, b.x, b.text))
    used, out = set(), []
    for i, a in enumerate(left_over):
        if i in used:
            continue
        joined = a
        for j in range(i + 1, len(left_over)):
            b = left_over[j]
            if b.y - a.y > 0.55 * max(a.height, 1.0):
                break
            if j in used or b.left < joined.left:
                continue
            gap = b.left - joined.right
            if not -0.10 * a.height <= gap <= 0.75 * a.height:
                continue
            text = _whole_number(joined.text.strip(), b.text.strip())
            if text is not None:
                used.add(j)
                edge = b.right
                joined = replace(joined, text=text, x=(joined.left + edge) / 2, width=edge - joined.left, confidence=min(a.confidence, b.confidence))
                break
        out.append(joined)
    return out


def _whole_number(a: str, b: str) -> str | None:
    if re.fullmatch(r"[+-]?\d[\d,]*", a) and re.fullmatch(r"\.\d{1,4}", b):
        return a + b
    if re.fullmatch(r"[+-]?\d[\d,]*\.", a) and re.fullmatch(r"\d{1,4}", b):
        return a + b
    if re.fullmatch(r"\d{3,6}", a) and re.fullmatch(r"\d{2}", b):
        return f"{a}.{b}"
    return None


def assign(boxes: list[Box], xs: list[float], ys: list[float], y_part: float = 0.45) -> dict[tuple[int, int], Box]:
    """The box of each (row, column): nearest centres within limits, the most confident, the later on a tie."""
    gaps = [b - a for a, b in zip(xs, xs[1:]) if b > a]
    steps = [b - a for a, b in zip(ys, ys[1:]) if b > a]
    x_limit, y_limit = max(20.0, 0.42 * min(gaps, default=80.0)), y_part * (median(steps) if steps else 80.0)
    out: dict[tuple[int, int], Box] = {}
    for b in sorted(boxes, key=lambda b: (b.y, b.x, b.text)):
        c, r = _nearest(xs, b.x), _nearest(ys, b.y)
        if abs(xs[c] - b.x) > x_limit or abs(ys[r] - b.y) > y_limit:
            continue
        if (r, c) not in out or b.confidence >= out[r, c].confidence:
            out[r, c] = b
    return out


def _nearest(centers: list[float], value: float) -> int:
    k = bisect.bisect_left(centers, value)
    if k == len(centers) or (k and value - centers[k - 1] <= centers[k] - value):
        return k - 1
    return k


def best_offset(pairs: list[tuple[int, int]]) -> tuple[int, int]:
    """The most frequent value minus index, the least on a tie, and how many have it."""
    counted = Counter(v - i for i, v in pairs)
    return min(counted.items(), key=lambda kv: (-kv[1], kv[0])) if counted else (0, 0)


def semantic_matrix(boxes: list[Box]) -> Grid | None:
    """A matrix of numbers with row keys in the first column and a header axis of consecutive whole numbers.

    None if it is too small, too sparse, or its axes do not count up.
    """
    numeric = [replace(b, text=t) for b in merge_fragments(boxes) if (t := number(b.text)) is not None]
    if len(numeric) < 20:
        return None
    tall = median(b.height for b in numeric)
    rows = clusters([b.y for b in numeric], 0.6 * tall)
    head = _header_band(numeric, rows, tall)
    if head is None:
        return None
    top, axis = head
    body = [b for b in numeric if b.y > top + 0.6 * tall]
    groups = clusters([b.x for b in body], max(8.0, 0.35 * tall))
    most = max((n for _, n in groups), default=0)
    xs = [c for c, n in groups if n >= max(3, 0.18 * most)]
    if not 4 <= len(xs) <= 256:
        return None
    found = [(c, int(b.text)) for b in axis for c in [_nearest(xs, b.x)] if abs(xs[c] - b.x) <= max(20.0, 0.42 * min((q - p for p, q in zip(xs, xs[1:])), default=80.0))]
    start, inliers = best_offset(found)
    if inliers < max(3, len(xs) / 5):
        return None
    dense = [(c, n) for c, n in clusters([b.y for b in body], 0.6 * tall) if n >= max(4, len(xs) / 2)]
    if len(dense) < 3:
        return None
    steps = [b[0] - a[0] for a, b in zip(dense, dense[1:])]
    ys = walk(clusters([b.y for b in body if b.y >= dense[0][0] - 0.6 * tall], 0.6 * tall), median(steps))
    if len(ys) < 4:
        return None
    cell = assign(body, xs, ys, 0.42)
    keys = [(r, int(cell[r, 0].text)) for r in range(len(ys)) if (r, 0) in cell and cell[r, 0].text.isdigit()]
    first, held = best_offset(keys)
    if held < max(4, len(ys) / 12):
        return None
    filled = sum((r, c) in cell for r in range(len(ys)) for c in range(1, len(xs)))
    if filled < max(20, 0.35 * len(ys) * (len(xs) - 1)):
        return None
    label = next((b.text.strip() for b in sorted(boxes, key=lambda b: b.x) if abs(b.y - top) <= tall and number(b.text) is None), "")
    header = (label, *(str(start + c) for c in range(1, len(xs))))
    grid = tuple((str(first + r), *(cell[r, c].text if (r, c) in cell else "" for c in range(1, len(xs)))) for r in range(len(ys)))
    return Grid(header, grid)


def anchored_matrix(boxes: list[Box]) -> Grid | None:
    """The matrix by centres, right or left edges of the boxes, whichever fills most; the earlier on a tie."""
    shifted = lambda f: [replace(b, x=f(b)) for b in boxes]
    found = [g for g in (semantic_matrix(boxes), semantic_matrix(shifted(lambda b: b.right)), semantic_matrix(shifted(lambda b: b.left))) if g]
    return max(found, key=lambda g: sum(bool(c) for r in g.rows for c in r), default=None)


def stacked_labels(boxes: list[Box], words: str = r"年|龄|age|year") -> list[Box]:
    """Corner labels that stand in two boxes, one above or beside the other, as one box each."""
    parts = sorted((b for b in boxes if b.text.strip() and number(b.text) is None), key=lambda b: (b.y, b.x, b.text))
    out = []
    for i, a in enumerate(parts):
        if re.search(words, a.text, re.I):
            out.append(a)
        for b in parts[i + 1 :]:
            if b.y - a.y > 2.2 * max(a.height, b.height):
                break
            below = abs(a.x - b.x) <= 0.6 * max(a.width, b.width) and b.y - a.y > 0.5 * a.height
            beside = abs(a.y - b.y) <= 0.5 * a.height and 0 <= b.left - a.right <= a.height
            if (below or beside) and re.search(words, a.text + b.text, re.I) and not re.search(words, a.text, re.I):
                left, right = min(a.left, b.left), max(a.right, b.right)
                out.append(replace(a, text=a.text.strip() + b.text.strip(), x=(left + right) / 2, width=right - left, y=(a.y + b.y) / 2))
    return out


def saturated(boxes: int, limit: int = 1_000) -> bool:
    """A tile on which a recogniser found as many boxes as it can give should be cut and read again."""
    return boxes >= limit


def _header_band(numeric: list[Box], rows: list[tuple[float, int]], tall: float) -> tuple[float, list[Box]] | None:
    """The band with the longest run of consecutive whole numbers from left to right, the higher on a tie."""
    best = None
    for y, _ in rows:
        whole = sorted((b for b in numeric if abs(b.y - y) <= 0.6 * tall and b.text.isdigit() and int(b.text) < 255), key=lambda b: b.x)
        run = longest = 1
        for a, b in zip(whole, whole[1:]):
            run = run + 1 if int(b.text) == int(a.text) + 1 else 1
            longest = max(longest, run)
        if whole and longest >= 3 and (best is None or longest > best[0]):
            best = (longest, y, whole)
    return None if best is None else (best[1], best[2])


def monotonic_keys(values: list[int | None], most: int = 120, stride: int = 3) -> tuple[list[int], int] | None:
    """Row keys from 0 to ``most`` that climb by 1 to ``stride``: fewest mismatches, then least error, then fewest skips; the smaller key on a tie.

    Missing values mismatch nothing. Returns the keys and how many values agree,
    or None where there are no values or more than such keys can climb.
    """
    if not 0 < len(values) <= most + 1:
        return None
    keys = np.arange(most + 1)
    # One number for the three costs. How far a value lies beyond the keys is the same for all of them and left out.
    costs = np.zeros((len(values), most + 1), np.int64)
    for row, v in zip(costs, values):
        if v is not None:
            v = min(max(v, -1), most + 1)
            row += (keys != v) * (1 << 40) + np.abs(keys - v) * (1 << 16)
    never = np.int64(1 << 60)
    best, steps = costs[0], []
    for cost in costs[1:]:
        # ways[d - 1][k]: from key k - d, the longest stride first so that the smaller key wins a tie
        ways = np.full((stride, most + 1), never)
        for d in range(1, stride + 1):
            ways[stride - d, d:] = best[:-d] + (d - 1)
        steps.append(stride - ways.argmin(axis=0))
        best = np.minimum(ways.min(axis=0) + cost, never)
    path = [int(best.argmin())]
    for step in reversed(steps):
        path.append(path[-1] - int(step[path[-1]]))
    path.reverse()
    return path, sum(v == k for v, k in zip(values, path))


@dataclass(frozen=True)
class Body:
    """Numbers laid out on columns and rows, before any header is known."""

    xs: list[float]
    ys: list[float]
    cells: dict[tuple[int, int], Box]

    @property
    def coverage(self) -> float:
        return len(self.cells) / max(1, len(self.xs) * len(self.ys))

    def row(self, r: int) -> list[str]:
        return [self.cells[r, c].text.strip() if (r, c) in self.cells else "" for c in range(len(self.xs))]

    def right_edge(self, r: int) -> int:
        return max((c for c in range(len(self.xs)) if (r, c) in self.cells), default=-1)


def body_lattice(boxes: list[Box], least_share: float = 0.04) -> Body | None:
    """Columns and rows of all boxes by clustering; thin columns close to a fuller one go to it."""
    if not boxes:
        return None
    tall = median(b.height for b in boxes)
    columns = clusters([b.x for b in boxes], max(8.0, 0.35 * tall))
    rows = clusters([b.y for b in boxes], 0.6 * tall)
    most = max(n for _, n in columns)
    xs = _without_thin_neighbours([(c, n) for c, n in columns if n >= max(3, least_share * most)])
    ys = [c for c, n in rows if n >= 2]
    if len(xs) < 2 or len(ys) < 2:
        return None
    return Body(xs, ys, assign(boxes, xs, ys))


def _without_thin_neighbours(columns: list[tuple[float, int]]) -> list[float]:
    """Of two columns closer than 0.45 of the usual gap the one with half the evidence or less is dropped."""
    gaps = [b[0] - a[0] for a, b in zip(columns, columns[1:])]
    usual, out = (median(gaps) if gaps else 0.0), list(columns)
    i = 0
    while i + 1 < len(out):
        (x0, n0), (x1, n1) = out[i], out[i + 1]
        if x1 - x0 < 0.45 * usual and min(n0, n1) * 2 <= max(n0, n1):
            del out[i if n0 < n1 else i + 1]
        else:
            i += 1
    return [c for c, _ in out]


def reset_groups(edges: list[int], least_jump: int = 4, least_rows: int = 4) -> list[int]:
    """Group of each row: a new one where the right edge jumps out again after enough rows."""
    out, group, since = [], 0, 0
    for i, e in enumerate(edges):
        if i and e - edges[i - 1] >= least_jump and since >= least_rows and len(edges) - i >= least_rows:
            group, since = group + 1, 0
        out.append(group)
        since += 1
    return out


def triangular_grid(boxes: list[Box]) -> Grid | None:
    """Headerless values whose right edge shrinks row by row: 300 numbers, 14 to 128 columns, 30 to 200 rows, a quarter to four fifths filled."""
    numeric = [replace(b, text=t) for b in merge_fragments(boxes) if (t := number(b.text)) is not None]
    if len(numeric) < 300:
        return None
    body = body_lattice(numeric)
    if body is None or not 14 <= len(body.xs) <= 128 or not 30 <= len(body.ys) <= 200 or not 0.25 <= body.coverage <= 0.80:
        return None
    edges = [body.right_edge(r) for r in range(len(body.ys))]
    groups = reset_groups(edges, max(4, len(body.xs) // 5), max(4, min(20, len(body.xs) // 4)))
    falls = sum(b <= a for a, b, g, h in zip(edges, edges[1:], groups, groups[1:]) if g == h)
    if falls < 0.9 * (len(edges) - 1 - groups[-1]):
        return None
    rows = tuple(tuple(body.row(r)) for r in range(len(body.ys)))
    return Grid(tuple(f"c{c + 1}" for c in range(len(body.xs))), rows, False)


def fixed_grid(boxes: list[Box]) -> Grid | None:
    """Headerless rows of up to three labels and values: 7 to 20 columns, 20 rows, four fifths filled; missing labels from the nearest row."""
    body = body_lattice([b for b in merge_fragments(boxes) if b.text.strip()])
    if body is None or not 7 <= len(body.xs) <= 20 or len(body.ys) < 20 or body.coverage < 0.80:
        return None
    rows = [body.row(r) for r in range(len(body.ys))]
    if sum(number(c) is not None for row in rows for c in row[3:]) < 0.8 * sum(len(row) - 3 for row in rows):
        return None
    for c in range(3):
        fill_nearest(rows, c)
    repair_columns(rows)
    return Grid(tuple(f"c{c + 1}" for c in range(len(body.xs))), tuple(map(tuple, rows)), False)


def sequential_records(boxes: list[Box]) -> Grid | None:
    """Headerless records with a column that counts up by one and starts again: 5 to 12 columns, 30 to 500 rows, 82 % filled."""
    body = body_lattice([b for b in merge_fragments(boxes) if b.text.strip()])
    if body is None or not 5 <= len(body.xs) <= 12 or not 30 <= len(body.ys) <= 500 or body.coverage < 0.82:
        return None
    rows = [body.row(r) for r in range(len(body.ys))]
    for c in range(len(body.xs)):
        values = [int(row[c]) if row[c].isdigit() else None for row in rows]
        steps = sum(a is not None and b is not None and (b == a + 1 or b <= 1) for a, b in zip(values, values[1:]))
        if steps >= 0.8 * (len(rows) - 1):
            for r in range(1, len(rows)):  # a gap within a run is filled
                if values[r] is None and values[r - 1] is not None and (r + 1 == len(rows) or values[r + 1] == values[r - 1] + 2):
                    values[r] = values[r - 1] + 1
                    rows[r][c] = str(values[r])
            return Grid(tuple(f"c{k + 1}" for k in range(len(body.xs))), tuple(map(tuple, rows)), False)
    return None


def annual_matrix(boxes: list[Box]) -> Grid | None:
    """Labels, an age, then one column a year (headed 1, 2, 3 ...): 100 numbers, 20 rows, 35 % filled.

    Rows form groups in which the age climbs; ages are laid along the path that
    fits best, other labels come from the nearest row of the group.
    """
    merged = merge_fragments(boxes)
    numeric = [replace(b, text=t) for b in merged if (t := number(b.text)) is not None]
    if len(numeric) < 100:
        return None
    tall = median(b.height for b in numeric)
    head = _header_band(numeric, clusters([b.y for b in numeric], 0.6 * tall), tall)
    if head is None:
        return None
    top, axis = head
    years = [b for b in axis if 1 <= int(b.text) <= 254]
    if len(years) < 5 or int(years[0].text) != 1:
        return None
    first = years[0].x
    below = [b for b in merged if b.y > top + 0.6 * tall and b.text.strip()]
    body = body_lattice(below)
    if body is None or len(body.ys) < 20:
        return None
    from_ = next((c for c, x in enumerate(body.xs) if x >= first - max(20.0, 0.42 * _least_gap(body.xs))), None)
    if not from_:
        return None
    n_years = len(body.xs) - from_
    filled = sum(c >= from_ for _, c in body.cells)
    if filled < 0.35 * n_years * len(body.ys):
        return None
    rows = [body.row(r) for r in range(len(body.ys))]
    groups = reset_groups([body.right_edge(r) for r in range(len(body.ys))], max(4, n_years // 5), max(4, min(20, n_years // 4)))
    for g in range(groups[-1] + 1):
        part = [r for r, h in enumerate(groups) if h == g]
        path, inliers = monotonic_keys([int(rows[r][from_ - 1]) if rows[r][from_ - 1].isdigit() and int(rows[r][from_ - 1]) <= 120 else None for r in part]) or ([], 0)
        if path and inliers >= 0.5 * len(part):
            for r, age in zip(part, path):
                rows[r][from_ - 1] = str(age)
        block = [rows[r] for r in part]
        for c in range(from_ - 1):
            fill_nearest(block, c)
    repair_columns(rows, range(from_ - 1))
    labels = [""] * from_
    for b in merged:
        if abs(b.y - top) <= tall and b.x < first - tall and number(b.text) is None:
            labels[min(from_ - 1, _nearest(body.xs, b.x))] += b.text.strip()
    return Grid((*labels, *(str(c + 1) for c in range(n_years))), tuple(map(tuple, rows)))


def _least_gap(xs: list[float]) -> float:
    return min((b - a for a, b in zip(xs, xs[1:]) if b > a), default=80.0)


def fill_nearest(rows: list[list[str]], column: int) -> None:
    """Empty cells of a column from the nearest filled row, the earlier on a tie."""
    filled = [r for r, row in enumerate(rows) if row[column]]
    for r, row in enumerate(rows):
        if not row[column] and filled:
            near = min(filled, key=lambda k: (abs(k - r), k))
            row[column] = rows[near][column]


def repair_columns(rows: list[list[str]], columns=None, share: float = 0.85, least: int = 10) -> None:
    """In columns that one value fills by ``share`` the others become that value if they are a part of it or hold it."""
    for c in columns if columns is not None else range(min(3, len(rows[0]) if rows else 0)):
        counted = Counter(row[c] for row in rows if row[c])
        if sum(counted.values()) < least:
            continue
        value, n = min(counted.items(), key=lambda kv: (-kv[1], kv[0]))
        if n >= share * sum(counted.values()):
            for row in rows:
                if row[c] and (row[c] in value or value in row[c]):
                    row[c] = value


def collapse_seam_column(grid: Grid) -> Grid:
    """A column without heading between two that count on, whose cells complete those to its left, is merged into them."""
    header, rows = list(grid.header), [list(r) for r in grid.rows]
    c = 1
    while c < len(header):
        if not header[c]:
            joined = [(r, _whole_number(row[c - 1], row[c])) for r, row in enumerate(rows) if row[c]]
            if len(joined) >= 3 and all(t is not None for _, t in joined):
                for r, t in joined:
                    rows[r][c - 1] = t
                del header[c]
                for row in rows:
                    del row[c]
                continue
        c += 1
    return Grid(tuple(header), tuple(map(tuple, rows)), grid.explicit)


def impossible_axis(grid: Grid) -> bool:
    """A year or age axis that starts below zero cannot be right."""
    label = grid.header[0] if grid.header else ""
    axis = [int(h) for h in grid.header[1:] if re.fullmatch(r"[+-]?\d+", h)]
    return bool(axis) and axis[0] < 0 and bool(re.search(r"年|龄|age|year", label, re.I))


def matrix(boxes: list[Box]) -> Grid | None:
    """The first reading that holds: annual, triangular, fixed, sequential, then by headings; fewer than 20 boxes are none."""
    if len(boxes) < 20:
        return None
    for read in (annual_matrix, triangular_grid, fixed_grid, sequential_records, anchored_matrix):
        grid = read(boxes)
        if grid is not None and not impossible_axis(grid):
            return collapse_seam_column(grid)
    return None


def _grouped(boxes: DataFrame, key: str) -> DataFrame:
    """Distinct boxes of each key; boxes with a missing place or size cannot be placed."""
    whole = boxes.where(" and ".join(f"{c} is not null" for c in (key, "x", "y", "width", "height", "confidence", "text")))
    box = F.struct(*[F.col(c).cast("double").alias(c) for c in ("x", "y", "width", "height", "confidence")], "text")
    return whole.groupBy(key).agg(F.collect_set(box).alias("boxes"))


def _map_boxes(boxes: DataFrame, key: str, kind: str, f) -> DataFrame:
    ship_package(boxes.sparkSession)
    arrow = {"string": pa.string()}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [f([Box(**b) for b in bs]) for bs in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, arrow)], names=[key, "text"])

    return _grouped(boxes, key).mapInArrow(run, f"`{key}` {boxes.schema[key].dataType.simpleString()}, text {kind}")


def reading_order(boxes: DataFrame, key: str) -> DataFrame:
    """``(key, text)`` of each group of boxes in reading order."""
    return _map_boxes(boxes, key, "string", in_reading_order)


def matrices(boxes: DataFrame, key: str) -> DataFrame:
    """``(key, text)``: the matrix of each group as pipes, null where there is none."""
    return _map_boxes(boxes, key, "string", lambda bs: (g := matrix(bs)) and to_pipe(g))


def key_paths(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """``(key, path, inliers)``: the climbing row keys that fit the values of each key best, in order; null where none fit. Distinct values only; a page bounds them."""
    ship_package(rows.sparkSession)
    points = rows.where(F.col(key).isNotNull() & F.col(order).isNotNull()).select(key, order, value).distinct()
    listed = points.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, value))).alias("points"))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [monotonic_keys([p[value] for p in ps]) or (None, None) for ps in batch.column(1).to_pylist()]
            paths, inliers = pa.array([f[0] for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), paths, inliers], names=[key, "path", "inliers"])

    return listed.mapInArrow(fit, f"`{key}` {rows.schema[key].dataType.simpleString()}, path array<int>, inliers int")
