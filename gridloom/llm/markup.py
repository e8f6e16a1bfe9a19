"""Markup in texts: which kinds a text holds, its clean form, and the templates of sources.

Recognition reads each kind by its own grammar (fixed tag names and attribute
forms, block starts at the start of a line, paired inline marks, commands that
no path or price can be mistaken for). An opening that a cut left without its
end counts where the text ends. Clean texts write headings as ``#``, entries as
``-`` or their number, rows as `` | `` between cells, code between fences and
formulas between dollar signs, whatever the markup was.

Templates are deduced in :mod:`gridloom.llm.templates`.

Null and blank texts have no markup; their clean form is null or empty.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.templates import template_classes, template_slots  # noqa: F401
from gridloom.session import ship_package

#: Element names that count as tags.
TAGS = (
    "a abbr b blockquote body br caption center code col colgroup dd del div dl dt em font footer h1 h2 h3 h4 h5 h6 head header hr html i img "
    "ins kbd li mark ol p pre q s samp section small span strike strong style sub sup table tbody td tfoot th thead title tr tt u ul var"
)
KINDS = ("html", "markdown", "wiki", "latex")

_NAME = "(?:" + "|".join(sorted(TAGS.split(), key=len, reverse=True)) + ")"
_ATTRS = r"(?:\s+[A-Za-z_:][-A-Za-z0-9_:.]*\s*=\s*(?:\"[^\"<>]*\"|'[^'<>]*'|[^\s\"'<>=]+))*"
TAG = re.compile(rf"<(/?)({_NAME}){_ATTRS}\s*/?>", re.I)
_TAG_CUT = re.compile(rf"<(?:/?{_NAME}(?:\s++[A-Za-z-]++(?:\s*+=\s*+(?:\"[^\"<>]*+\"?+|'[^'<>]*+'?+|[^\s\"<>]*+))?+)*+\s*+/?|/[A-Za-z]{{0,9}}|!-{{0,2}}|!--[^<>]*+)\s*+$", re.I)
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
_REFERENCE = re.compile(r"&(?:nbsp|amp|lt|gt|quot|apos|ldquo|rdquo|lsquo|rsquo|mdash|ndash|hellip|times|middot|copy|yen|ensp|emsp|#[0-9]{1,6}|#x[0-9a-f]{1,5});", re.I)

_WIKI_TABLE = re.compile(r"^\{\|.*?(?:^\|\}[^\n]*|\Z)", re.S | re.M)
_WIKI_LINK = re.compile(r"\[\[[^\[\]\n]+(?:\]\]|\]?\s*\Z)")
_WIKI_TEMPLATE = re.compile(r"\{\{[^{}\n|]{1,40}(?:\|[^{}]*)?(?:\}\}|\}?\s*\Z)")
_WIKI_QUOTES = re.compile(r"'''(?=[^\s'])[^'\n]+(?:'''|'{0,2}\s*\Z)|(?<!')''(?=[^\s'])[^'\n]+''(?!')")
_WIKI_HEADING = re.compile(r"^(={2,6})[ \t]*([^=\s][^\n=]*?)[ \t]*\1[ \t]*$|^={2,6}[ \t]+[^=\s][^\n=]*\Z", re.M)

_HEADING = re.compile(r"^ {0,3}#{1,6}[ \t]+\S|^ {0,3}#{2,6}[ \t]*\Z", re.M)
_UNDERLINED = re.compile(r"^(?![|<\s])[^\n]+\n(?:={3,}|-{3,})[ \t]*$", re.M)
_ITEM = re.compile(r"^ {0,3}(?:[-*+][ \t]+(?=\S)|[0-9]{1,3}\.[ \t]+(?=\S))", re.M)
_QUOTE = re.compile(r"^ {0,3}>[ \t]*\S", re.M)
_FENCE = re.compile(r"^ {0,3}(?:```|~~~)", re.M)
_PIPE_ROW = re.compile(r"^[ \t]*\|(?![-}+|])[^\n]*\|[ \t]*[^\n]*$|^[ \t]*\|(?:[ \t]*:?-{2,}:?[ \t]*\|)+|^[ \t]*\|[ \t]+[^|\n]*\Z", re.M)
_BOLD = re.compile(r"\*\*(?=[^\s*])[^*\n]*(?:[^\s*]\*\*|\*?\s*\Z)|\*\*\s*\Z")
_EMPHASIS = re.compile(r"(?<![\w*\\])\*(?=[^\s*])[^*\n]*[^\s*]\*(?![\w*])|(?<![\w_\\])__(?=[^\s_])[^\n]*?[^\s_]__(?![\w_])|(?<![\w_\\{}])_(?=[^\s_])[^_\n]*[^\s_]_(?![\w_])")
_STRUCK = re.compile(r"~~(?=\S)[^~\n]+~~")
_CODE = re.compile(r"(?<!`)(`+)(?!`)[^`\n]+(?:\1(?!`)|\Z)|(?<!`)`\s*\Z")
_LINK = re.compile(r"(?<!\\)!?\[[^\[\]\n]*\]\([^()\n]*(?:\)|\Z)|(?<![\[\\])\[(?![a-z]+\])[^\[\]\n0-9][^\[\]\n]*+\]\(?\s*\Z|(?<![\[\\])\[(?![0-9\[])[^\[\]\n]++\Z")
_RULE = re.compile(r"^ {0,3}(?:\*[ \t]*){3,}$", re.M)

_COMMAND = re.compile(r"(?<![\w\\:/])\\(?:[A-Za-z]{2,}\*?)(?=[\s{}\[\]_^\\$()&,.;=+\-，。；）（]|\Z)|(?<=[}\s])\\\\(?:\s|\Z)")
_WORDS = re.compile(r"\\(?:begin|end|(?:sub)*section|(?:sub)?paragraph|chapter|title|text[a-z]{2}|emph|footnote|ref|label|cite|item|frac|sum|prod|int|sqrt|cdot|times|hline)\b")
_FORMULA = re.compile(r"\$\$(?=[^$]*[\\^_{}=])[^$]+(?:\$\$|\$?\Z)|(?<![\\$\w])\$(?=[^$\n]*[\\^_{}=])(?!\s)[^$\n]+(?:(?<!\s)\$(?![0-9])|\Z)|\\\[(?=[^\]]*[\\^_={}])[^\[\]]+(?:\\\]|\Z)|\\\((?=[^)]*[\\^_={}]).+?(?:\\\)|\Z)")


def _holds_html(text: str) -> bool:
    if "<" in text and (TAG.search(text) or "<!--" in text or _TAG_CUT.match(text, text.rfind("<"))):
        return True
    return "&" in text and _REFERENCE.search(text) is not None


def _holds_wiki(text: str) -> bool:
    return bool(
        ("[[" in text and _WIKI_LINK.search(text))
        or ("{{" in text and _WIKI_TEMPLATE.search(text))
        or ("''" in text and _WIKI_QUOTES.search(text))
        or ("==" in text and _WIKI_HEADING.search(text))
        or ("{|" in text and _WIKI_TABLE.search(text))
    )


def _holds_markdown(text: str) -> bool:
    if "{|" in text:
        text = _WIKI_TABLE.sub("", text)
    if "`" in text and (_FENCE.search(text) or _CODE.search(text)):
        return True
    return bool(
        ("#" in text and _HEADING.search(text))
        or ("*" in text and (_BOLD.search(text) or _EMPHASIS.search(text) or _RULE.search(text)))
        or _ITEM.search(text)
        or ("[" in text and _LINK.search(_WIKI_LINK.sub("", text) if "[[" in text else text))
        or (">" in text and _QUOTE.search(text))
        or ("|" in text and _PIPE_ROW.search(text))
        or (("===" in text or "---" in text) and _UNDERLINED.search(text))
        or ("_" in text and "\\" not in text and _EMPHASIS.search(text))
        or ("~~" in text and _STRUCK.search(text))
    )


def _holds_latex(text: str) -> bool:
    if "\\" in text and (_WORDS.search(text) or _COMMAND.search(text) or _FORMULA.search(text)):
        return True
    return "$" in text and _FORMULA.search(text) is not None


_TESTS = {"html": _holds_html, "markdown": _holds_markdown, "wiki": _holds_wiki, "latex": _holds_latex}


def kinds(text: str | None) -> list[str]:
    if not text or text.isspace():
        return []
    return [k for k in KINDS if _TESTS[k](text)]


def _cells(row: str, splitter: str) -> str:
    return " | ".join(c.strip() for c in re.split(splitter, row.strip()))


def _wiki_rows(match: re.Match) -> str:
    out = []
    for line in match.group().split("\n")[1:]:
        if line.startswith(("|-", "|}")) or not line.strip():
            continue
        out.append(_cells(line.lstrip("|!"), r"\|\||!!"))
    return "\n".join(out)


def _tabular(match: re.Match) -> str:
    rows = [r for r in re.split(r"\\\\|\\hline", match.group(1)) if r.strip()]
    return "\n".join(_cells(r, r"(?<!\\)&") for r in rows)


def _html_rows(match: re.Match) -> str:
    rows = re.split(r"<tr[^<>]*>", match.group(), flags=re.I)[1:]
    lines = [" | ".join(TAG.sub("", c).strip() for c in re.split(r"<t[dh][^<>]*>", r, flags=re.I)[1:]) for r in rows]
    return "\n" + "\n".join(line for line in lines if line) + "\n"


_HTML_TABLE = re.compile(r"<table[^<>]*>.*?(?:</table>|\Z)", re.S | re.I)
_TABULAR = re.compile(r"\\begin\{tabular\}(?:\{[^{}]*\})?\s*(.*?)(?:\\end\{tabular\}|\Z)", re.S)
#: Names under which pages write headings, formulas and code without the elements for them.
_HEAD_CLASSES, _FORMULA_CLASSES, _CODE_TEMPLATES = "h|hd|head|heading|level|title", "f|formula|math|eq|equation", "代码|代碼|code|source|syntaxhighlight|pre"
_SUBS = [
    ("<", re.compile(r"<pre[^<>]*>\s*(?:<code[^<>]*>)?(.*?)(?:(?:</code>)?\s*</pre>|\Z)", re.S | re.I), r"\n```\n\1\n```\n"),
    ("<", re.compile(r"<h([1-6])[^<>]*>(.*?)</h\1>", re.S | re.I), lambda m: "\n" + "#" * int(m.group(1)) + " " + m.group(2).strip() + "\n"),
    ("<", re.compile(rf"<(div|p|span) class=\"?(?:{_HEAD_CLASSES})[-_]?([1-6])\"?>(.*?)</\1>", re.S | re.I), lambda m: "\n" + "#" * int(m.group(2)) + " " + m.group(3).strip() + "\n"),
    ("<", re.compile(r"<li[^<>]*>\s*", re.I), "\n- "),
    ("<", re.compile(rf"<(p|div|span) class=\"?(?:{_FORMULA_CLASSES})\"?>(.*?)</\1>", re.S | re.I), r"\n$\2$\n"),
    ("<", re.compile(r"<(?:br|hr)\s*/?>|</(?:p|div|ul|ol|tr|li|blockquote)>", re.I), "\n"),
    ("<", _COMMENT, ""),
    ("<", TAG, ""),
    ("\\", re.compile(r"\\((?:sub)*)section\*?\{([^{}]*)\}"), lambda m: "#" * (1 + m.group(1).count("sub")) + " " + m.group(2)),
    ("\\", re.compile(r"\\paragraph\*?\{([^{}]*)\}"), r"#### \1"),
    ("\\", re.compile(r"\\begin\{(?:verbatim|lstlisting)\}\s*(.*?)\s*(?:\\end\{(?:verbatim|lstlisting)\}|\Z)", re.S), r"```\n\1\n```"),
    ("\\", re.compile(r"\\(?:begin|end)\{(?:itemize|enumerate|quote|center|document)\}[ \t]*\n?"), ""),
    ("\\", re.compile(r"^\s*\\item\s*", re.M), "- "),
    ("\\", re.compile(r"\\\[\s*(.*?)\s*(?:\\\]|\Z)", re.S), r"$\1$"),
    ("\\", re.compile(r"\\(?:textbf|textit|emph|underline|texttt)\{([^{}]*)\}"), r"\1"),
    ("\\", re.compile(r"~?\\(?:footnote|ref|label|cite)\{[^{}]*\}"), ""),
    ("==", re.compile(r"^(={2,6})[ \t]*([^=\n]+?)[ \t]*\1[ \t]*$", re.M), lambda m: "#" * (len(m.group(1)) - 1) + " " + m.group(2)),
    ("{{", re.compile(rf"\{{\{{(?:{_CODE_TEMPLATES})\|(.*?)\}}\}}", re.S | re.I), r"```\n\1\n```"),
    ("{{", re.compile(r"\{\{[^{}|\n]*\|([^{}]*)\}\}"), r"\1"),
    ("[[", re.compile(r"^:+\s*\[\[[^\[\]\n]*\]\]\s*", re.M), "- "),
    ("[[", re.compile(r"\[\[(?:[^\[\]|\n]*\|)?([^\[\]\n]*)\]\]"), r"\1"),
    ("''", re.compile(r"'{2,5}"), ""),
    ("](", re.compile(r"!?\[([^\[\]\n]*)\]\([^()\n]*\)"), r"\1"),
    ("**", re.compile(r"\*\*"), ""),
    ("\n=", re.compile(r"^([^\n|]*\S)\n={3,}[ \t]*$", re.M), r"# \1"),
    ("\n-", re.compile(r"^([^\n|]*\S)\n-{3,}[ \t]*$", re.M), r"## \1"),
    ("`", re.compile(r"(?<!`)`([^`\n]+)`(?!`)"), r"\1"),
    ("*", re.compile(r"^ {0,3}[*+][ \t]+", re.M), "- "),
    (">", re.compile(r"^ {0,3}>[ \t]?", re.M), ""),
    ("|", re.compile(r"^[ \t]*\|(?:[ \t]*:?-{2,}:?[ \t]*\|)+[ \t]*\n?", re.M), ""),
    ("|", re.compile(r"^[ \t]*\|[ \t]?(.*?)[ \t]?\|[ \t]*$", re.M), r"\1"),
    ("$$", re.compile(r"\$\$([^$]+)\$\$"), r"$\1$"),
    ("&", _REFERENCE, lambda m: html.unescape(m.group()).replace("\xa0", " ")),
]


def clean(text: str | None) -> str | None:
    if not text:
        return text
    held = kinds(text)
    if not held:
        return text.strip()
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    if "wiki" in held and "{|" in text:
        text = _WIKI_TABLE.sub(_wiki_rows, text)
    if "html" in held and "<table" in text.lower():
        text = _HTML_TABLE.sub(_html_rows, text)
    if "latex" in held and "tabular" in text:
        text = _TABULAR.sub(_tabular, text)
    for sign, pattern, to in _SUBS:
        if sign in text:
            text = pattern.sub(to, text)
    return re.sub(r"\n{3,}", "\n\n", text).strip()


def texts_of(cells: DataFrame, records: DataFrame) -> DataFrame:
    """``(tab, rec_id, source, text)`` of both tables; repeated keys are still there."""
    a = cells.select(F.lit("submission_cells").alias("tab"), F.col("row_id").alias("rec_id"), "source", F.col("ground_truth").alias("text"))
    b = records.select(F.lit("markdown_records").alias("tab"), F.col("record_id").alias("rec_id"), "source", F.col("read_text").alias("text"))
    return a.unionAll(b)


def markup_kinds(texts: DataFrame) -> DataFrame:
    """``(tab, rec_id, markup)``, each once."""
    ship_package(texts.sparkSession)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [kinds(t) for t in batch.column(2).to_pylist()]
            at = pa.array([i for i, k in enumerate(held) for _ in k], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array([k for ks in held for k in ks], pa.string())], names=["tab", "rec_id", "markup"])

    rows = texts.select("tab", "rec_id", "text").where("text is not null")
    return rows.mapInArrow(find, "tab string, rec_id bigint, markup string").dropDuplicates(["tab", "rec_id", "markup"])


def clean_texts(texts: DataFrame) -> DataFrame:
    """``(tab, rec_id, clean)``, each record once.

    Texts are cleaned where they are read; only clean ones are shuffled, once, to drop repeated keys.
    """
    ship_package(texts.sparkSession)

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([clean(t) for t in batch.column(2).to_pylist()], pa.string())], names=["tab", "rec_id", "clean"])

    rows = texts.select("tab", "rec_id", "text").mapInArrow(tidy, "tab string, rec_id bigint, clean string")
    return rows.dropDuplicates(["tab", "rec_id"])
