"""The core of a text: its letters, digits and ideographs, case and width folded.

Markup (tags, comments, character references, link targets, commands,
template names) is dropped before. A null text has the empty core.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np

_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
_REFERENCE = re.compile(r"&(?:[A-Za-z]{2,8}|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});")
_TARGET = re.compile(r"\]\([^()\s]*\)")
_ENVIRONMENT = re.compile(r"\\(?:begin|end)\{[^{}\n]*\}(?:\{[lcrp|]*\})?")
_COMMAND = re.compile(r"\\[A-Za-z]+")
_LINK = re.compile(r"\[\[[^\[\]|\n]*\|")
_TEMPLATE = re.compile(r"\{\{[^{}|\n]*\|")
_WIKI_TABLE = re.compile(r"^\{\|.*$", re.M)
_FENCE = re.compile(r"^[ \t]*```[^\n`]*$", re.M)
_INVISIBLE = re.compile("[\u00ad\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff]")
_OTHER = re.compile(r"[\W_]+")
_WORD = re.compile(r"[^\W_]+")


def drop_markup(text: str) -> str:
    if "<" in text:
        text = _TAG.sub("", _COMMENT.sub("", text))
    if "&" in text:
        text = _REFERENCE.sub(" ", text)
    if "](" in text:
        text = _TARGET.sub("]", text)
    if "\\" in text:
        text = _COMMAND.sub(" ", _ENVIRONMENT.sub(" ", text))
    if "[[" in text:
        text = _LINK.sub("", text)
    if "{{" in text:
        text = _TEMPLATE.sub("", text)
    if "{|" in text:
        text = _WIKI_TABLE.sub("", text)
    if "```" in text:
        text = _FENCE.sub("", text)
    return text


def fold(text: str) -> str:
    if not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text)
    return text.casefold()


def core(text: str | None) -> str:
    if not text:
        return ""
    out = _OTHER.sub("", drop_markup(text))
    if out.isascii():
        return out.lower()
    return _OTHER.sub("", fold(out))


def core_words(text: str | None) -> list[str]:
    """The words that a core is put together from."""
    if not text:
        return []
    plain = _INVISIBLE.sub("", drop_markup(text))
    if plain.isascii():
        return _WORD.findall(plain.lower())
    # What the core drops before it folds (signs that folding makes letters of) must not come back here.
    return _WORD.findall(_bare(fold(_OTHER.sub(" ", _bare(plain)))))


def _bare(text: str) -> str:
    """Without combining marks, which are in no core and end no word."""
    return text if text.isascii() else "".join(c for c in text if not unicodedata.combining(c))


def word_sizes(text: str, text_core: str) -> list[int]:
    """Characters of each word in the core of a text; they always add up to it."""
    words = core_words(text)
    sizes = [len(w) for w in words]
    if sum(sizes) == len(text_core):
        return sizes
    # Letters on both sides of a space that become one in the core: each word has what the core grows by.
    edges = np.minimum([len(core("".join(words[: k + 1]))) for k in range(len(words))], len(text_core))
    return np.diff([0, *edges[:-1], len(text_core)]).tolist() if words else []


def slices(texts: list[str | None], rows: int = 1_500, chars: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of a batch that hold at most so many rows, and not many more characters than a text must have alone."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if i + 1 - start >= rows or held >= chars:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def codes(text: str) -> np.ndarray:
    """Code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def join_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts one after another, and where each starts (with the end)."""
    ends = np.cumsum([0, *map(len, texts)])
    return codes("".join(texts)), ends


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all runs of ``width`` values (wrapping arithmetic)."""
    if len(values) < width:
        return np.zeros(0, np.uint64)
    v = (values.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    v ^= v >> np.uint64(29)
    done, have, out, power = 0, v, None, np.uint64(0xD6E8FEB86659FD93)
    size = 1
    while True:  # doubling: hashes of 1, 2, 4 ... values, put together to the width
        if width & size:
            out = have[: len(v) - size + 1] if out is None else _glue(out, have, done, size, power)
            done += size
        if size * 2 > width:
            break
        have = _glue(have, have, size, size, power)
        size *= 2
    out = out[: len(values) - width + 1]
    return out ^ (out >> np.uint64(31))


def _glue(a: np.ndarray, b: np.ndarray, size_a: int, size_b: int, power: np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        n = min(len(a), len(b) - size_a)
        factor = np.uint64(pow(int(power), size_b, 1 << 64))
        return a[:n] * factor + (b[size_a : size_a + n] ^ np.uint64(size_a * 7919))
