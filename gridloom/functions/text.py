"""Column functions on text. All are built-in expressions; null in, null out unless said otherwise.

White space and line ends are those of Unicode, written out so that every SQL
engine reads the same patterns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that are white space, and those that end a line.
SPACES = " \t\n\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"

COMMENT = "<!--(?s:.*?)-->"
TAG = "<[^>]+>"
FENCE = "```[a-zA-Z0-9_-]*"
SEPARATOR_LINE = f"(?m)^[{SPACES}]*:?-{{3,}}:?(?:[{SPACES}]+:?-{{3,}}:?)*[{SPACES}]*$"
SEPARATOR_CELL = "^:?-{3,}:?$"
NUMBER = "[0-9]+(?:[.,][0-9]+)*"
TABLE_TOKEN = "(?i)<\\s*/?\\s*(?:table|tr|td|th)(?:\\s[^<>]*)?>"
CELL_OPEN = "(?i)<t[dh](?:\\s[^<>]*)?>"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with a value that is worked out once, whatever the number of places that use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def collapse(c: Column | str) -> Column:
    """White space runs as one space, none at the edges."""
    return F.trim(F.regexp_replace(_col(c), f"[{SPACES}]+", " "))


def strip(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), f"^[{SPACES}]+|(?<![{SPACES}])[{SPACES}]+\\z", "")


def lines(c: Column | str) -> Column:
    """Lines of a text as they are; a final line end starts no further line."""
    return let(F.split(_col(c), LINE_END), lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, 1, F.size(p) - 1)).otherwise(p))


def solid_lines(c: Column | str) -> Column:
    """Collapsed lines that are not blank."""
    return F.filter(F.transform(F.split(_col(c), LINE_END), collapse), lambda x: x != "")


def duplicate_line_ratio(c: Column | str) -> Column:
    """1 - distinct / all of the collapsed non-blank lines; 1.0 where there are none, null included."""
    solid = F.coalesce(solid_lines(c), F.array().cast("array<string>"))
    return let(solid, lambda x: F.when(F.size(x) == 0, 1.0).otherwise(1 - F.size(F.array_distinct(x)) / F.size(x)))


def normalize_text(c: Column | str) -> Column:
    """Text without comments, tags, fences, pipes and separator lines, collapsed. Entities stay as they are."""
    out = _col(c)
    for pattern in (COMMENT, TAG, FENCE, "\\|"):
        out = F.regexp_replace(out, pattern, " ")
    return collapse(F.regexp_replace(out, "(?d)" + SEPARATOR_LINE, " "))


def count(c: Column | str, pattern: str) -> Column:
    return F.regexp_count(_col(c), F.lit(pattern))


def pipe_row(c: Column | str) -> Column:
    """Starts and ends with a pipe and has two at least."""
    return F.coalesce(strip(c).rlike("(?s)^\\|.*\\|$"), F.lit(False))


def pipe_cells(c: Column | str) -> Column:
    """Cells of a row: one outer pipe dropped on each side, the rest split and stripped."""
    inner = F.regexp_replace(F.regexp_replace(strip(c), "^\\|", ""), "\\|\\z", "")
    return F.transform(F.split(inner, "\\|", -1), strip)


def separator_row(c: Column | str) -> Column:
    cells = F.transform(pipe_cells(c), lambda x: F.regexp_replace(x, f"[{SPACES}]", ""))
    return F.forall(cells, lambda x: x.rlike(SEPARATOR_CELL))


def comment_line(c: Column | str) -> Column:
    return strip(c).rlike("^<!--(?s:.*)-->$")


def numeric_cell(c: Column | str) -> Column:
    return strip(c).rlike("^[+-]?[0-9,]+(?:\\.[0-9]+)?$")


def semantic_label(c: Column | str) -> Column:
    """Holds a Latin letter or an ideograph."""
    return _col(c).rlike("[A-Za-z一-鿿]")


def label_key(c: Column | str) -> Column:
    return F.lower(F.regexp_replace(_col(c), f"[{SPACES}()（）]", ""))


def tidy_number(c: Column | str) -> Column:
    """Drops the gap after a comma or point between digits."""
    return F.regexp_replace(_col(c), f"(?<=[0-9])([,.])[{SPACES}]+(?=[0-9])", "$1")


def table_tokens(c: Column | str) -> Column:
    """Table tags in order, as ``t`` or ``/t``."""
    found = F.regexp_extract_all(_col(c), F.lit(TABLE_TOKEN), F.lit(0))
    return F.transform(found, lambda x: F.regexp_extract(F.lower(F.regexp_replace(x, "[<>\\s]*(/?)\\s*([A-Za-z]+)(?s:.*)", "$1$2")), "^(/?[a-z]+)", 1))


def html_issue(c: Column | str) -> Column:
    """What is wrong with the nesting of table tags, or null; a fold over a stack."""
    start = F.struct(F.array().cast("array<string>").alias("open"), F.lit(None).cast("string").alias("issue"))

    def step(state, token):
        name = F.regexp_replace(token, "^/", "")
        top = F.try_element_at(state["open"], F.lit(-1))
        pushed = F.struct(F.concat(state["open"], F.array(name)).alias("open"), state["issue"].alias("issue"))
        popped = F.struct(F.slice(state["open"], 1, F.size(state["open"]) - 1).alias("open"), state["issue"].alias("issue"))
        text = F.when(top.isNull(), F.concat(F.lit("closes </"), name, F.lit("> without an opening tag"))).otherwise(
            F.concat(F.lit("closes </"), name, F.lit("> while <"), top, F.lit("> is open"))
        )
        broken = F.struct(state["open"].alias("open"), text.alias("issue"))
        return F.when(state["issue"].isNotNull(), state).when(~token.startswith("/"), pushed).when(top == name, popped).otherwise(broken)

    def finish(state):
        last = F.when(F.size(state["open"]) > 3, F.slice(state["open"], -3, 3)).otherwise(state["open"])
        rest = F.concat(F.lit("unclosed "), F.array_join(F.transform(last, lambda x: F.concat(F.lit("<"), x, F.lit(">"))), ", "))
        return F.coalesce(state["issue"], F.when(F.size(state["open"]) > 0, rest))

    return F.aggregate(table_tokens(c), start, step, finish)


def looks_truncated(c: Column | str) -> Column:

    def test(text: Column) -> Column:
        fences = F.size(F.filter(solid_lines(text), lambda x: x.startswith("```")))
        tables = count(text, "(?i)<table(?:\\s[^<>]*)?>") != count(text, "(?i)</table\\s*>")
        on_tag = text.rlike("(?i)<(?:td|th|tr|table)(?:\\s[^<>]*)?>\\z")
        short_cell = text.rlike("(?i)<t[dh](?:\\s[^<>]*)?>[^<>]{0,3}\\z")
        return (text == "") | (text.contains("```") & (fences % 2 == 1)) | tables | on_tag | short_cell

    return let(F.coalesce(strip(c), F.lit("")), test)


def unstructured_table(c: Column | str) -> Column:
    """Reads like a table without any structure: many numbers over several lines."""

    def test(per: Column) -> Column:
        n_lines, n_numbers = F.size(per), F.aggregate(per, F.lit(0), lambda a, x: a + x)
        rich = F.size(F.filter(per, lambda x: x >= 2))
        return (n_lines >= 4) & (n_numbers >= 8) & ((rich >= 3) | ((n_lines >= 6) & (n_numbers >= 12)))

    return F.coalesce(let(F.transform(solid_lines(c), lambda x: count(x, NUMBER)), test), F.lit(False))


def table_markup(c: Column | str) -> Column:
    text = _col(c)
    return F.coalesce(text.rlike("(?i)<table") | F.exists(F.split(text, LINE_END), pipe_row), F.lit(False))


def candidate_issue(c: Column | str, min_chars: int = 20, max_blocks: int = 32, max_cells: int = 256, max_duplicate: float = -1.0) -> Column:
    """The first gate a candidate fails, or null. A negative duplicate limit is no limit."""
    text = F.coalesce(_col(c), F.lit(""))
    rows = F.regexp_extract_all(text, F.lit("(?is)<tr(?:\\s[^<>]*)?>.*?</tr\\s*>"), F.lit(0))
    widest = F.coalesce(F.array_max(F.transform(rows, lambda r: count(r, CELL_OPEN))), F.lit(0))
    issue = html_issue(text)
    out = (
        F.when(F.length(strip(text)) < min_chars, F.lit("short"))
        .when(F.lower(text).contains("markdown parsing task"), F.lit("prompt"))
        .when(issue.isNotNull(), F.lit("structure"))
        .when(looks_truncated(text), F.lit("truncated"))
        .when(count(text, "(?i)<table(?:\\s[^<>]*)?>") > max_blocks, F.lit("blocks"))
        .when(widest > max_cells, F.lit("cells"))
        .when(~table_markup(text) & unstructured_table(text), F.lit("unstructured"))
    )
    return out if max_duplicate < 0 else out.when(duplicate_line_ratio(text) > max_duplicate, F.lit("duplicates"))


def html_shape(c: Column | str) -> Column:
    """Counts of opening table, row and cell tags."""
    text = F.coalesce(_col(c), F.lit(""))
    return F.struct(
        count(text, "(?i)<table(?:\\s[^<>]*)?>").alias("tables"), count(text, "(?i)<tr(?:\\s[^<>]*)?>").alias("rows"), count(text, CELL_OPEN).alias("cells")
    )


def blocks(c: Column | str) -> Column:
    """Blocks between blank lines, stripped at the edges, none of them blank."""
    plain = F.regexp_replace(_col(c), LINE_END, "\n")
    return F.filter(F.transform(F.split(plain, "\n[ \t]*\n\\s*"), lambda x: F.regexp_replace(x, "^\n+|[ \t\n]+\\z", "")), lambda x: strip(x) != "")


def parse_pipe_table(c: Column | str) -> Column:
    """``struct(header, rows)`` of a text that is one pipe table, else null.

    Blank and comment lines are dropped; each other line must hold a pipe, the
    second be separators, and all be as wide as the first.
    """

    def parse(kept: Column) -> Column:
        def check(grid: Column) -> Column:
            width = F.size(F.try_element_at(grid, F.lit(1)))
            bars = F.transform(F.try_element_at(grid, F.lit(2)), lambda x: F.regexp_replace(x, f"[{SPACES}]", ""))
            even = F.array_min(F.transform(grid, F.size)) == F.array_max(F.transform(grid, F.size))
            fine = even & F.forall(bars, lambda x: x.rlike(SEPARATOR_CELL)) & (width > 0)
            return F.when(fine, F.struct(F.element_at(grid, 1).alias("header"), F.slice(grid, 3, F.greatest(F.size(grid) - 2, F.lit(0))).alias("rows")))

        return F.when((F.size(kept) >= 2) & F.forall(kept, lambda x: x.contains("|")), let(F.transform(kept, pipe_cells), check))

    return let(F.filter(F.split(_col(c), LINE_END), lambda x: (strip(x) != "") & ~comment_line(x)), parse)


def format_pipe_row(cells: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))


def format_pipe_table(header: Column, rows: Column) -> Column:
    bar = F.transform(header, lambda x: F.lit("---"))
    return F.array_join(F.concat(F.array(format_pipe_row(header), format_pipe_row(bar)), F.transform(rows, format_pipe_row)), "\n")


def structure_score(left: list[Column], right: list[Column]) -> Column:
    """Mean over counters of 100 * (1 - |l - r| / max), 100 where both are zero, 0 at least."""
    parts = [
        F.when((a == 0) & (b == 0), 100.0).otherwise(F.greatest(F.lit(0.0), 100 * (1 - F.abs(a - b) / F.greatest(a, b, F.lit(1))))) for a, b in zip(left, right)
    ]
    return sum(parts[1:], parts[0]) / len(parts)


def contains_run(values: Column, run: Column) -> Column:
    """Whether an array holds another as a contiguous part; the empty one is in every array."""
    n, k = F.size(values), F.size(run)
    starts = F.sequence(F.lit(1), F.greatest(n - k + 1, F.lit(1)))
    return (k == 0) | ((k <= n) & F.exists(starts, lambda i: F.slice(values, i, F.greatest(k, F.lit(1))) == run))


def error_kind(message: Column) -> Column:
    """``truncated``, ``timeout`` or ``other``; a timeout counts as truncated for repeating, but is not worth a finer tile."""
    low = F.lower(message)
    return (
        F.when(low.rlike("timed? ?out|timeout"), F.lit("timeout"))
        .when(low.rlike("truncat|unclosed|max.?tokens|incomplete"), F.lit("truncated"))
        .when(message.isNotNull(), F.lit("other"))
    )
