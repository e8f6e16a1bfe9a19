"""CSV records that parse, and those that do not with the reason.

Records go through a columnar parser in blocks. A block fails if its rows do not
line up with its records (a quote that is not closed takes in the next ones);
it is bisected until the bad record stands alone. In a block that lines up a
record is taken if its parse is proved right: it equals one of the four ways to
write its two fields again (either enclosed or not). All others are diagnosed
strictly, one by one. The reason is the first that applies:

``quoting``  a quote or a line break in a field that is not enclosed, no
             closing quote, or anything but a comma after it
``columns``  not exactly two fields
``value``    the trimmed name is empty, a suffix only, without an image suffix,
             or has a slash or backslash; or the text is blank, or has U+FFFD
             or a control character other than tab, LF and CR

A null record has no fields (``columns``); an empty one has a single empty
field (``columns``). One line end at the very end of a record is dropped.
Extra columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pv
from pyspark.sql import DataFrame

from gridloom.session import ship_package

#: Records of a first block.
BLOCK = 512
#: The suffixes of page names.
SUFFIXES = (".jpg", ".jpeg", ".png", ".webp", ".bmp")

_NAME = r"(?i)^[^/\\]*[^/\\\s][^/\\]*\.(?:jpg|jpeg|png|webp|bmp)$"
_BAD_TEXT = "[\u0000-\u0008\u000b\u000c\u000e-\u001f\ufffd]"
_BAD_TEXT_RE = re.compile(_BAD_TEXT)
_READ = pv.ReadOptions(use_threads=False, column_names=["name", "text"], block_size=1 << 26)
_CONVERT = pv.ConvertOptions(column_types={"name": pa.string(), "text": pa.string()}, strings_can_be_null=False)


def name_is_valid(name: str) -> bool:
    name = name.strip()
    lower = name.lower()
    suffix = next((s for s in SUFFIXES if lower.endswith(s)), None)
    return bool(suffix) and bool(name[: -len(suffix)].strip()) and "/" not in name and "\\" not in name


def text_is_valid(text: str) -> bool:
    return bool(text.strip()) and not _BAD_TEXT_RE.search(text)


def strict_fields(record: str) -> list[str] | None:
    """The fields of one record, or None if its quoting is broken."""
    if record.endswith("\r\n"):
        record = record[:-2]
    elif record.endswith(("\n", "\r")):
        record = record[:-1]
    fields, at, n = [], 0, len(record)
    while True:
        if at < n and record[at] == '"':
            parts, at = [], at + 1
            while True:
                close = record.find('"', at)
                if close < 0:
                    return None
                parts.append(record[at:close])
                at = close + 1
                if at < n and record[at] == '"':
                    parts.append('"')
                    at += 1
                    continue
                break
            fields.append("".join(parts))
            if at < n and record[at] != ",":
                return None
        else:
            end = record.find(",", at)
            end = n if end < 0 else end
            field = record[at:end]
            if '"' in field or "\n" in field or "\r" in field:
                return None
            fields.append(field)
            at = end
        if at >= n:
            return fields
        at += 1  # the comma


def diagnose(record: str | None) -> tuple[str | None, str | None, str | None]:
    """``(name, text, reason)``; the reason is null for a valid record."""
    if record is None:
        return None, None, "columns"
    fields = strict_fields(record)
    if fields is None:
        return None, None, "quoting"
    if len(fields) != 2:
        return None, None, "columns"
    if not name_is_valid(fields[0]) or not text_is_valid(fields[1]):
        return None, None, "value"
    return fields[0].strip(), fields[1], None


def _bulk(records: pa.Array) -> tuple[list[int], pa.Array, pa.Array, pa.Array] | None:
    """``(places, names, texts, fine)`` of the rows of a block, or None if rows and records do not line up.

    A row is fine if its record is one of the four ways to write its two fields,
    which proves its parse right whatever the other rows hold, and if the values
    are valid. Places of records with another number of fields are missing.
    """
    body = pc.replace_substring_regex(pc.fill_null(records, ""), r"(?:\r\n|\n|\r)\z", "")
    joined = "\n".join(body.to_pylist()) + "\n"
    odd: list[int] = []

    def skip(row: pv.InvalidRow) -> str:
        odd.append(row.number)
        return "skip"

    try:
        table = pv.read_csv(pa.BufferReader(joined.encode("utf-8", "surrogatepass")), _READ, pv.ParseOptions(newlines_in_values=True, ignore_empty_lines=False, invalid_row_handler=skip), _CONVERT)
    except (pa.ArrowInvalid, pa.ArrowKeyError, UnicodeError):
        return None
    if table.num_rows + len(odd) != len(body) or None in odd:
        return None
    left_out = {n - 1 for n in odd}
    places = [i for i in range(len(body)) if i not in left_out]
    if len(places) != table.num_rows:
        return None
    body = body.take(pa.array(places, pa.int64()))
    name, text = table.column("name").combine_chunks(), table.column("text").combine_chunks()
    quoted = lambda x: pc.binary_join_element_wise('"', pc.replace_substring(x, '"', '""'), '"', "")
    plain = lambda x: pc.invert(pc.match_substring_regex(x, '[",\r\n]'))
    same = None
    for a, plain_a in ((name, True), (quoted(name), False)):
        for b, plain_b in ((text, True), (quoted(text), False)):
            hit = pc.equal(pc.binary_join_element_wise(a, b, ","), body)
            if plain_a:
                hit = pc.and_(hit, plain(name))
            if plain_b:
                hit = pc.and_(hit, plain(text))
            same = hit if same is None else pc.or_(same, hit)
    name = pc.utf8_trim_whitespace(name)
    fine = pc.and_(same, pc.match_substring_regex(name, _NAME))
    fine = pc.and_(fine, pc.invert(pc.match_substring_regex(text, _BAD_TEXT)))
    return places, name, text, pc.and_(fine, pc.not_equal(pc.utf8_trim_whitespace(text), ""))


def parse_block(records: pa.Array) -> list[tuple[str | None, str | None, str | None]]:
    """Every record of a block, in order."""
    got = _bulk(records) if len(records) > 1 else None
    if got is None:
        if len(records) == 1:
            return [diagnose(records[0].as_py())]
        half = len(records) // 2
        return parse_block(records[:half]) + parse_block(records[half:]) if half else []
    out: list = [None] * len(records)
    for at, name, text, fine in zip(got[0], *(x.to_pylist() for x in got[1:])):
        if fine:
            out[at] = (name, text, None)
    return [row or diagnose(records[at].as_py()) for at, row in enumerate(out)]


def parse_records(raw: DataFrame, key: str = "raw_id", record: str = "raw_row") -> DataFrame:
    """``(key, file_name, ground_truth, reason)`` of each key once; valid rows have a null reason."""
    ship_package(raw.sparkSession)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                rows = parse_block(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, pa.string()) for c in zip(*rows))], names=[key, "file_name", "ground_truth", "reason"])

    kind = raw.schema[key].dataType.simpleString()
    rows = raw.select(key, record).mapInArrow(parse, f"`{key}` {kind}, file_name string, ground_truth string, reason string")
    return rows.dropDuplicates([key])  # a repeated key repeats its record; after the map, so that rejects alone are shuffled narrow


def rejects(raw: DataFrame) -> DataFrame:
    return parse_records(raw).where("reason is not null").select("raw_id", "reason")


def accepted(raw: DataFrame) -> DataFrame:
    return parse_records(raw).where("reason is null").drop("reason")
