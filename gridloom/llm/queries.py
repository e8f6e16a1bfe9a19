"""Registry of the training-data queries; each reads its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridloom.functions.text import LINE_END, SPACES
from gridloom.llm.leak import PASSAGE as LEAK_PASSAGE
from gridloom.llm.leak import PASSAGE_WORDS, leaked_items
from gridloom.llm.markup import clean_texts, markup_kinds, template_classes, template_slots, texts_of
from gridloom.llm.overlap import GRAM, overlap_counts, overlapping_files
from gridloom.llm.quality import LINE_ENDS, WORD, line_shares, mostly_not_prose, text_statistics
from gridloom.llm.repetition import PASSAGE, cutoff_table, repetition, repetitive_rows
from gridloom.llm.slicing import cut_slices, slice_pieces
from gridloom.llm.splits import PLACEHOLDERS, regrouped_splits, torn_groups
from gridloom.llm.tokenize_bpe import encode_corpus
from gridloom.llm.truncation import cut_report, cut_rows
from gridloom.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@_query
def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_corpus(read_table(spark, folder, "documents", "doc_id", "text"))


@_query
def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents", "doc_id", "text")
    return leaked_items(documents, read_table(spark, folder, "heldout_items", "item_id", "lang", "text"))


@_query
def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents", "doc_id", "text")
    return mostly_not_prose(documents, read_table(spark, folder, "common_words", "lang", "word"))


@_query
def p10_shares(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents", "doc_id", "text")
    return line_shares(documents, read_table(spark, folder, "common_words", "lang", "word"))


def _cells(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "submission_cells", "row_id", "source", "ground_truth")


@_query
def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return cut_rows(_cells(spark, folder))


@_query
def p1_report(spark: SparkSession, folder: str) -> DataFrame:
    return cut_report(_cells(spark, folder))


@_query
def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return repetitive_rows(_cells(spark, folder))


@_query
def p3_shares(spark: SparkSession, folder: str) -> DataFrame:
    return repetition(_cells(spark, folder))


@_query
def p3_cutoffs(spark: SparkSession, folder: str) -> DataFrame:
    return cutoff_table(spark, _cells(spark, folder))


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "split_features", "run_id", "file_name", "family", "author", "entity")


def _splits(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "experiment_splits", "run_id", "name", "file_names")


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "markdown_records", "record_id", "file_name", "source", "read_text")


@_query
def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return torn_groups(_features(spark, folder), _splits(spark, folder))


@_query
def p2_splits(spark: SparkSession, folder: str) -> DataFrame:
    return regrouped_splits(_features(spark, folder), read_table(spark, folder, "split_targets", "name", "share"))


def _sliced(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        read_table(spark, folder, "image_slices", "slice_id", "kind", "y0", "y1", "height"),
        read_table(spark, folder, "observations", "slice_id", "y", "height", "confidence"),
        read_table(spark, folder, "slice_specs"),
    )


@_query
def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return cut_slices(*_sliced(spark, folder)).select("slice_id", "cut")


@_query
def p4_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return slice_pieces(*_sliced(spark, folder))


@_query
def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return overlapping_files(_splits(spark, folder), _records(spark, folder))


@_query
def p6_counts(spark: SparkSession, folder: str) -> DataFrame:
    return overlap_counts(_splits(spark, folder), _records(spark, folder))


@_query
def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return markup_kinds(texts_of(_cells(spark, folder), _records(spark, folder)))


@_query
def p7_clean(spark: SparkSession, folder: str) -> DataFrame:
    return clean_texts(texts_of(_cells(spark, folder), _records(spark, folder)))


@_query
def p7_templates(spark: SparkSession, folder: str) -> DataFrame:
    return template_classes(texts_of(_cells(spark, folder), _records(spark, folder)))


@_query
def p7_slots(spark: SparkSession, folder: str) -> DataFrame:
    return template_slots(texts_of(_cells(spark, folder), _records(spark, folder)))


@_query
def p10_stats(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents", "doc_id", "text")
    return text_statistics(documents, read_table(spark, folder, "common_words", "lang", "word"))


_SOLID = f"list_filter(list_transform(string_split_regex(text, '{LINE_END}'), lambda v: regexp_replace(v, '^[{SPACES}]+|[{SPACES}]+$', '', 'g')), lambda v: v <> '')"
ORACLE["p10_stats"] = f"""
    WITH k AS (SELECT list(DISTINCT lower(word)) AS ws FROM common_words WHERE word IS NOT NULL),
    c AS (SELECT doc_id, regexp_extract_all(lower(text), '{WORD}') AS words, length(regexp_replace(lower(text), '[^a-z0-9一-鿿]', '', 'g')) AS c, length(regexp_replace(text, '[{SPACES}]', '', 'g')) AS s,
      length(regexp_replace(text, '[{SPACES}0-9A-Za-z一-鿿]', '', 'g')) AS y, {_SOLID} AS l FROM documents)
    SELECT doc_id, len(words) AS n_words, CASE WHEN len(words) > 0 THEN c / len(words) END AS mean_word_length, CASE WHEN s > 0 THEN y / s END AS symbol_ratio,
      CASE WHEN len(l) > 0 THEN len(list_filter(l, lambda v: regexp_matches(v, '[{LINE_ENDS}]$'))) / len(l) END AS line_end_ratio,
      CASE WHEN len(words) > 0 THEN len(list_filter(words, lambda w: list_contains(ws, w))) / len(words) END AS common_ratio
    FROM c, k"""


#: Characters of double and single width, quotes doubled for SQL; characters of a passage of a Chinese item.
WIDE, NARROW = "".join(chr(0xFF01 + i) for i in range(94)), "".join(chr(0x21 + i) for i in range(94)).replace("'", "''")
PASSAGE_CHARS = LEAK_PASSAGE["zh"]


# SQL of the definitions, by brute force where the operators search.
def _core(x: str) -> str:
    """The core of a text: markup dropped, letters and digits kept, case and width folded."""
    for pattern, put in (
        (r"(?s)<!--.*?(-->|\z)", ""), (r"</?[A-Za-z][^<>]*>", ""), (r"&([A-Za-z]{2,8}|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});", " "), (r"\]\([^()\s]*\)", "]"),
        (r"\\(begin|end)\{[^{}\n]*\}(\{[lcrp|]*\})?", " "), (r"\\[A-Za-z]+", " "), (r"\[\[[^\[\]|\n]*\|", ""), (r"\{\{[^{}|\n]*\|", ""), (r"(?m)^\{\|.*$", ""), (r"(?m)^[ \t]*```[^\n`]*$", ""),
        (r"[^\p{L}\p{N}]", ""),
    ):
        x = f"regexp_replace({x}, '{pattern}', '{put}', 'g')"
    return f"lower(translate({x}, '{WIDE}', '{NARROW}'))"


def _key(column: str) -> str:
    plain = f"regexp_replace(lower(translate({column}, '{WIDE}　', '{NARROW} ')), '^[{SPACES}]+|[{SPACES}]+$', '', 'g')"
    return f"CASE WHEN {plain} NOT IN ({', '.join(repr(p) for p in PLACEHOLDERS)}) THEN {plain} END"


_LISTED = "(SELECT DISTINCT run_id, name, file_name FROM (SELECT run_id, lower(trim(name)) AS name, unnest(file_names) AS file_name FROM experiment_splits) WHERE run_id IS NOT NULL AND file_name IS NOT NULL AND name IN ('train', 'validation', 'test'))"
_LINKS = " UNION ".join(f"SELECT run_id, file_name, '{k}' AS what, {_key(k)} AS key FROM split_features WHERE run_id IS NOT NULL AND file_name IS NOT NULL" for k in ("family", "author", "entity"))
ORACLE["p2_found"] = f"""
    WITH RECURSIVE l AS ({_LINKS}), e AS (SELECT DISTINCT run_id, file_name, min(file_name) OVER (PARTITION BY run_id, what, key) AS hub FROM l WHERE key IS NOT NULL),
    b AS (SELECT run_id, file_name AS x, hub AS y FROM e UNION SELECT run_id, hub, file_name FROM e),
    r AS (SELECT DISTINCT run_id, file_name AS x, file_name AS y FROM l UNION SELECT r.run_id, r.x, b.y FROM r JOIN b ON r.run_id = b.run_id AND r.y = b.x),
    g AS (SELECT run_id, x AS file_name, min(y) AS root FROM r GROUP BY 1, 2)
    SELECT g.run_id, g.root AS file_name FROM g LEFT JOIN {_LISTED} s ON g.run_id = s.run_id AND g.file_name = s.file_name GROUP BY 1, 2 HAVING count(DISTINCT s.name) > 1"""
ORACLE["p3_found"] = f"""
    WITH c AS (SELECT row_id, {_core('ground_truth')} AS c FROM (SELECT DISTINCT ON (row_id) row_id, ground_truth FROM submission_cells WHERE ground_truth IS NOT NULL)),
    p AS (SELECT row_id, c, unnest(range(1, length(c) - {PASSAGE} + 2)) AS i FROM c WHERE length(c) >= {PASSAGE}),
    f AS (SELECT row_id, i, length(c) AS n, min(i) OVER (PARTITION BY row_id, substr(c, i, {PASSAGE})) AS first FROM p),
    s AS (SELECT row_id, n, least({PASSAGE}, coalesce(lead(i) OVER (PARTITION BY row_id ORDER BY i) - i, {PASSAGE})) AS covered FROM f WHERE i > first)
    SELECT row_id FROM s GROUP BY row_id HAVING sum(covered) * 3 >= min(n)"""
ORACLE["p4_found"] = f"""
    WITH RECURSIVE k AS (SELECT regexp_replace(lower(kind), '^[{SPACES}]+|[{SPACES}]+$', '', 'g') AS kind, max_height AS lim, coalesce(y_overlap, 0) AS lap, min_confidence FROM slice_specs),
    s AS (SELECT slice_id, coalesce(y0, y1 - height) AS y0, coalesce(y1, y0 + height) AS y1, lim, CASE WHEN lap >= 0 AND lap < lim THEN lap ELSE 0 END AS lap, min_confidence
      FROM (SELECT DISTINCT ON (slice_id) slice_id, kind, y0, y1, height FROM image_slices) i JOIN k ON regexp_replace(lower(i.kind), '^[{SPACES}]+|[{SPACES}]+$', '', 'g') = k.kind),
    t AS (SELECT * FROM s WHERE y1 - y0 > lim AND lim > 0),
    b AS (SELECT DISTINCT o.slice_id, floor(o.y - o.height / 2)::BIGINT + 1 AS low, ceil(o.y + o.height / 2)::BIGINT - 1 AS high FROM observations o JOIN t ON o.slice_id = t.slice_id AND o.confidence >= t.min_confidence),
    n AS (SELECT *, CASE WHEN low <= max(high) OVER (PARTITION BY slice_id ORDER BY low, high ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS fresh FROM b WHERE low <= high),
    m AS (SELECT slice_id, min(low) AS low, max(high) AS high FROM (SELECT *, sum(fresh) OVER (PARTITION BY slice_id ORDER BY low, high ROWS UNBOUNDED PRECEDING) AS run FROM n) GROUP BY slice_id, run),
    c AS (SELECT slice_id, y0, y1, lim, lap, y0::BIGINT AS pos, y0::BIGINT AS start, false AS stuck FROM t
      UNION ALL SELECT c.slice_id, y0, y1, lim, lap, coalesce(m.low - 1, least(start + lim, y1 - 1)), greatest(y0, coalesce(m.low - 1, least(start + lim, y1 - 1)) - lap), coalesce(m.low - 1, least(start + lim, y1 - 1)) <= pos
      FROM c LEFT JOIN m ON c.slice_id = m.slice_id AND least(start + lim, y1 - 1) BETWEEN m.low AND m.high WHERE NOT stuck AND y1 - start > lim)
    SELECT slice_id, CASE WHEN bool_or(stuck) THEN 'forced' ELSE 'clean' END AS cut FROM c GROUP BY slice_id"""
ORACLE["p6_found"] = f"""
    WITH c AS (SELECT file_name, {_core('read_text')} AS c FROM (SELECT DISTINCT ON (file_name) file_name, read_text FROM markdown_records WHERE file_name IS NOT NULL AND read_text IS NOT NULL)),
    g AS (SELECT DISTINCT file_name, substr(c, i, {GRAM}) AS g FROM (SELECT file_name, c, unnest(range(1, length(c) - {GRAM} + 2)) AS i FROM c WHERE length(c) >= {GRAM})),
    n AS (SELECT file_name, count(*) AS n FROM g GROUP BY 1), l AS {_LISTED},
    a AS (SELECT DISTINCT run_id, file_name FROM l WHERE name = 'train'), b AS (SELECT DISTINCT run_id, file_name FROM l WHERE name <> 'train'),
    k AS (SELECT DISTINCT a.run_id, a.file_name AS x, b.file_name AS y FROM a JOIN b ON a.run_id = b.run_id),
    p AS (SELECT x, y, count(*) AS m FROM (SELECT DISTINCT x, y FROM k) JOIN g ON x = g.file_name JOIN g h ON y = h.file_name AND g.g = h.g GROUP BY 1, 2),
    q AS (SELECT x, y FROM p JOIN n u ON x = u.file_name JOIN n v ON y = v.file_name WHERE m * 3 >= greatest(u.n, v.n) * 2
      UNION SELECT x.file_name, y.file_name FROM c x JOIN c y ON x.c = y.c WHERE x.c <> '')
    SELECT DISTINCT run_id, least(k.x, k.y) AS file_lo, greatest(k.x, k.y) AS file_hi FROM k JOIN q ON k.x = q.x AND k.y = q.y"""
ORACLE["p9_found"] = f"""
    WITH d AS (SELECT doc_id, {_core('text')} AS c FROM documents WHERE text IS NOT NULL),
    i AS (SELECT item_id, starts_with(lower(trim(lang)), 'en') AS en, {_core('text')} AS c, list_filter(list_transform(string_split(regexp_replace(text, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda w: {_core('w')}), lambda w: w <> '') AS ws
      FROM heldout_items WHERE item_id IS NOT NULL AND text IS NOT NULL),
    z AS (SELECT item_id, length(c) AS n, s, substr(c, s, {PASSAGE_CHARS}) AS run, s + {PASSAGE_CHARS} AS e FROM (SELECT *, unnest(range(1, length(c) - {PASSAGE_CHARS} + 2)) AS s FROM i WHERE NOT en AND length(c) >= {PASSAGE_CHARS})),
    f AS (SELECT doc_id, substr(c, unnest(range(1, length(c) - {PASSAGE_CHARS} + 2)), {PASSAGE_CHARS}) AS run FROM d WHERE length(c) >= {PASSAGE_CHARS}),
    w AS (SELECT item_id, n, 1 + length(array_to_string(ws[1 : k - 1], '')) AS s, array_to_string(ws[k : k + {PASSAGE_WORDS - 1}], '') AS run FROM (SELECT item_id, length(c) AS n, ws, unnest(range(1, len(ws) - {PASSAGE_WORDS} + 2)) AS k FROM i WHERE en AND len(ws) >= {PASSAGE_WORDS})),
    h AS (SELECT DISTINCT doc_id, item_id, n, s, e FROM z JOIN f ON z.run = f.run UNION SELECT doc_id, item_id, n, s, s + length(run) FROM w JOIN d ON contains(d.c, w.run)),
    o AS (SELECT doc_id, item_id, n, greatest(0, e - greatest(s, coalesce(max(e) OVER (PARTITION BY doc_id, item_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS fresh FROM h)
    SELECT doc_id, item_id FROM o GROUP BY 1, 2 HAVING sum(fresh) * 2 >= min(n)"""
