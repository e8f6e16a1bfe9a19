"""Registry of the core queries and the SQL each is checked against.

Every query reads its whole tables. Pieces of SQL that several share are built
by the small functions below; they name the same fixed character classes as
the column functions do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import text as T
from gridloom.functions import tables
from gridloom.operators import combine, evaluate, experiment, geometry, lattice, merge, sequences
from gridloom.operators.csv_records import accepted, rejects
from gridloom.plans.pipeline import better_repair, table_score
from gridloom.sources import boxes
from gridloom.sources.tables import one_per_key, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents", "doc_id", "text")


def _arrived_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Cells as they arrived, keys repeated; for queries that reduce texts first and drop repeated keys on narrow rows."""
    rows = read_table(spark, folder, "submission_cells", "row_id", "run_id", "ord", "file_name", "ground_truth")
    return rows.withColumn("file_name", T.strip("file_name")).withColumnRenamed("ground_truth", "text")


def _cells(spark: SparkSession, folder: str) -> DataFrame:
    return one_per_key(_arrived_cells(spark, folder), "row_id")


def _arrived_records(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "markdown_records", "record_id", "file_name", "read_text").withColumnRenamed("read_text", "text")


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return one_per_key(_arrived_records(spark, folder), "record_id")


def _slices(spark: SparkSession, folder: str) -> DataFrame:
    columns = "slice_id file_name kind x0 x1 y0 y1 width height row col rows cols content_pixels content_ratio text_pixels text_ratio".split()
    return one_per_key(read_table(spark, folder, "image_slices", *columns), "slice_id")


# Pieces of SQL.
def _s(x: str) -> str:
    return f"regexp_replace({x}, '^[{T.SPACES}]+|[{T.SPACES}]+$', '', 'g')"


def _c(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{T.SPACES}]+', ' ', 'g'), ' ')"


def _solid(x: str) -> str:
    return f"list_filter(list_transform(string_split_regex({x}, '{T.LINE_END}'), lambda v: {_c('v')}), lambda v: v <> '')"


def _n(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, '{pattern}'))"


def _dup(x: str) -> str:
    return f"(CASE WHEN coalesce(len({_solid(x)}), 0) = 0 THEN 1.0::DOUBLE ELSE 1 - len(list_distinct({_solid(x)}))::DOUBLE / len({_solid(x)}) END)"


def _pairs_gone(x: str) -> str:
    """Table tags as letters (capital: open), with matched neighbours taken out again and again; empty if all nest."""
    out = f"lower(array_to_string(list_transform(regexp_extract_all({x}, '{T.TABLE_TOKEN}'), lambda v: regexp_replace(v, '^<\\s*(/?)\\s*([a-zA-Z]+)(?s:.*)$', '\\1\\2,')), ''))"
    for name in ("td", "th", "tr", "table"):
        out = f"replace({out}, '{name},/{name},', '')"
    for _ in range(3):
        for name in ("td", "th", "tr", "table"):
            out = f"replace({out}, '{name},/{name},', '')"
    return out


_CELLS = f"(SELECT DISTINCT ON (row_id) row_id, run_id, ord, {_s('file_name')} AS file_name, ground_truth AS text FROM submission_cells)"
_RECORDS = "(SELECT DISTINCT ON (record_id) record_id, file_name, read_text AS text FROM markdown_records)"
_SLICES = "(SELECT DISTINCT ON (slice_id) * EXCLUDE (loaded_at) FROM image_slices)"
_LEN = lambda x: f"length(coalesce({_s(x)}, ''))"
_FINE = lambda x: f"({_pairs_gone(x)} = '')"


@_query(
    f"""
    SELECT b.row_id, coalesce(o.text IS NOT NULL AND {_LEN('o.text')} >= {_LEN('b.text')} * 0.5 AND {_LEN('o.text')} - {_LEN('b.text')} >= 10
        AND {_FINE('o.text')} AND {_dup('o.text')} <= 0.9, false) AS accepted,
      md5(CASE WHEN coalesce(o.text IS NOT NULL AND {_LEN('o.text')} >= {_LEN('b.text')} * 0.5 AND {_LEN('o.text')} - {_LEN('b.text')} >= 10
        AND {_FINE('o.text')} AND {_dup('o.text')} <= 0.9, false) THEN o.text ELSE b.text END) AS digest
    FROM {_CELLS} b LEFT JOIN {_RECORDS} o ON b.file_name = o.file_name"""
)
def guarded_overlay(spark: SparkSession, folder: str) -> DataFrame:
    base = _cells(spark, folder).select("row_id", "file_name", "text")
    rows = combine.guarded_overlay(base, _records(spark, folder), min_ratio=0.5, min_gain=10, max_duplicate=0.9)
    return rows.select("row_id", "accepted", F.md5("text").alias("digest"))


@_query(
    f"""
    SELECT b.row_id, coalesce({_LEN('b.text')} <= 400 AND {_LEN('o.text')} > 0 AND {_LEN('b.text')} < {_LEN('o.text')} * 0.5, false) AS fell_back
    FROM {_CELLS} b JOIN {_RECORDS} o ON b.file_name = o.file_name"""
)
def ensemble_collapsed(spark: SparkSession, folder: str) -> DataFrame:
    primary = _cells(spark, folder).select("row_id", "file_name", "text")
    return combine.collapsed_fallback(primary, _records(spark, folder), max_chars=400).select("row_id", "fell_back")


_LAST = f"(SELECT * FROM {_CELLS} WHERE file_name IS NOT NULL AND file_name <> '' QUALIFY row_number() OVER (PARTITION BY file_name ORDER BY run_id DESC NULLS LAST, ord DESC NULLS LAST, row_id DESC) = 1)"


@_query(
    f"""
    SELECT t.file_name, (r.text IS NULL OR {_s('r.text')} = '') AS missing, md5(CASE WHEN r.text IS NULL OR {_s('r.text')} = '' THEN '<table></table>' ELSE r.text END) AS digest
    FROM {_RECORDS} t LEFT JOIN {_LAST} r ON t.file_name = r.file_name"""
)
def template_expand(spark: SparkSession, folder: str) -> DataFrame:
    last = combine.last_per_name(_cells(spark, folder), order=("run_id", "ord", "row_id"))
    rows = combine.expand_template(_records(spark, folder), last)
    return rows.select("file_name", "missing", F.md5("text").alias("digest"))


@_query(
    f"""
    SELECT coalesce(p.file_name, t.file_name) AS file_name, CASE WHEN p.file_name IS NULL THEN 'missing' WHEN t.file_name IS NULL THEN 'unknown' ELSE 'matched' END AS status
    FROM (SELECT DISTINCT file_name FROM {_CELLS} WHERE file_name IS NOT NULL) p
    FULL OUTER JOIN (SELECT DISTINCT file_name FROM {_RECORDS} WHERE file_name IS NOT NULL) t ON p.file_name = t.file_name"""
)
def prediction_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    return combine.reconcile(_cells(spark, folder), _records(spark, folder))


@_query(
    f"""
    WITH c AS {_CELLS}, r AS {_RECORDS}, n AS (SELECT DISTINCT file_name FROM c WHERE file_name <> '')
    SELECT count(*) AS n_rows, sum(strlen(coalesce(text, '')))::BIGINT AS n_bytes, count(*) FILTER (coalesce(file_name, '') = '') AS n_unnamed,
      count(*) FILTER ({_LEN('text')} = 0) AS n_blank, count(*) FILTER (NOT {_FINE('text')}) AS n_broken,
      (SELECT count(*) FROM (SELECT file_name FROM c WHERE file_name <> '' GROUP BY 1 HAVING count(*) > 1)) AS n_repeated,
      (SELECT count(DISTINCT file_name) FROM r WHERE file_name NOT IN (SELECT file_name FROM n)) AS n_missing,
      (SELECT count(*) FROM n WHERE file_name NOT IN (SELECT file_name FROM r WHERE file_name IS NOT NULL)) AS n_unknown
    FROM c"""
)
def validate_report(spark: SparkSession, folder: str) -> DataFrame:
    return combine.validation_report(_cells(spark, folder), _records(spark, folder))


@_query(f"SELECT doc_id, round({_dup('text')}, 6) AS ratio FROM documents")
def duplicate_line_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder).select("doc_id", F.round(T.duplicate_line_ratio("text"), 6).alias("ratio"))


def _normalized(x: str) -> str:
    out = x
    for pattern in (T.COMMENT, T.TAG, T.FENCE, "\\|"):
        out = f"regexp_replace({out}, '{pattern}', ' ', 'g')"
    return _c(f"regexp_replace({out}, '{T.SEPARATOR_LINE}', ' ', 'g')")


@_query(f"SELECT row_id, md5({_normalized('text')}) AS digest, length({_normalized('text')}) AS n_chars FROM {_CELLS}")
def normalize_text(spark: SparkSession, folder: str) -> DataFrame:
    plain = T.normalize_text("text")
    return one_per_key(_arrived_cells(spark, folder).select("row_id", F.md5(plain).alias("digest"), F.length(plain).cast("bigint").alias("n_chars")), "row_id")


_TRUNCATED = (
    f"({_s('x')} = '' OR len(list_filter({_solid('x')}, lambda v: starts_with(v, '```'))) % 2 = 1 OR {_n('x', '(?i)<table(?:[ \\t\\n\\r\\f\\v][^<>]*)?>')} <> {_n('x', '(?i)</table[ \\t\\n\\r\\f\\v]*>')}"
    f" OR regexp_matches({_s('x')}, '(?i)<(?:td|th|tr|table)(?:[ \\t\\n\\r\\f\\v][^<>]*)?>$') OR regexp_matches({_s('x')}, '(?i)<t[dh](?:[ \\t\\n\\r\\f\\v][^<>]*)?>[^<>]{{0,3}}$'))"
)
_RICH = f"list_transform({_solid('x')}, lambda v: {_n('v', T.NUMBER)})"
_UNSTRUCTURED = f"(len({_solid('x')}) >= 4 AND coalesce(list_sum({_RICH}), 0) >= 8 AND (len(list_filter({_RICH}, lambda n: n >= 2)) >= 3 OR (len({_solid('x')}) >= 6 AND list_sum({_RICH}) >= 12)))"
_PIPE = f"regexp_matches({_s('v')}, '(?s)^\\|.*\\|$')"
_MARKUP = f"(regexp_matches(x, '(?i)<table') OR len(list_filter(string_split_regex(x, '{T.LINE_END}'), lambda v: {_PIPE})) > 0)"


@_query(
    f"""
    SELECT row_id, CASE WHEN length({_s('x')}) < 20 THEN 'short' WHEN contains(lower(x), 'markdown parsing task') THEN 'prompt' WHEN NOT {_FINE('x')} THEN 'structure'
      WHEN {_TRUNCATED} THEN 'truncated' WHEN {_n('x', '(?i)<table(?:[ \\t\\n\\r\\f\\v][^<>]*)?>')} > 2 THEN 'blocks'
      WHEN NOT {_MARKUP} AND {_UNSTRUCTURED} THEN 'unstructured' WHEN {_dup('x')} > 0.3 THEN 'duplicates' END AS issue
    FROM (SELECT row_id, coalesce(text, '') AS x FROM {_CELLS})"""
)
def candidate_gates(spark: SparkSession, folder: str) -> DataFrame:
    return one_per_key(_arrived_cells(spark, folder).select("row_id", T.candidate_issue("text", max_blocks=2, max_duplicate=0.3).alias("issue")), "row_id")


@_query(f"SELECT row_id, {_FINE('text')} AS fine FROM {_CELLS}")
def html_stack_check(spark: SparkSession, folder: str) -> DataFrame:
    issue = T.html_issue("text")
    return one_per_key(_arrived_cells(spark, folder).select("row_id", F.when(F.col("text").isNotNull(), issue.isNull()).alias("fine")), "row_id")


@_query(f"SELECT doc_id, {_UNSTRUCTURED} AS looks_tabular, {_TRUNCATED} AS truncated FROM (SELECT doc_id, coalesce(text, '') AS x FROM documents)")
def unstructured_table_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = _documents(spark, folder)
    return rows.select("doc_id", T.unstructured_table("text").alias("looks_tabular"), T.looks_truncated("text").alias("truncated"))


_BLOCKS = (
    f"list_filter(list_transform(string_split_regex(regexp_replace(text, '{T.LINE_END}', chr(10), 'g'), '\\n[ \\t]*\\n[ \\t\\n\\r\\f\\v]*'), "
    f"lambda b: regexp_replace(b, '^\\n+|[ \\t\\n]+$', '', 'g')), lambda b: {_s('b')} <> '')"
)
_CELLS_OF = lambda v: f"list_transform(string_split(regexp_replace(regexp_replace({_s(v)}, '^\\|', ''), '\\|$', ''), '|'), lambda q: {_s('q')})"
_PARSED = f"""
    WITH b AS (SELECT record_id, unnest({_BLOCKS}) AS block, generate_subscripts({_BLOCKS}, 1) AS place FROM {_RECORDS}),
    k AS (SELECT record_id, place, list_filter(string_split_regex(block, '{T.LINE_END}'), lambda v: {_s('v')} <> '' AND NOT regexp_matches({_s('v')}, '^<!--(?s:.*)-->$')) AS kept FROM b),
    g AS (SELECT record_id, place, kept, list_transform(kept, lambda v: {_CELLS_OF('v')}) AS grid FROM k WHERE len(kept) >= 2)
    SELECT record_id, place, grid FROM g
    WHERE len(list_filter(kept, lambda v: NOT contains(v, '|'))) = 0 AND len(list_filter(grid[2], lambda v: NOT regexp_matches(regexp_replace(v, '[{T.SPACES}]', '', 'g'), '{T.SEPARATOR_CELL}'))) = 0
      AND len(list_filter(grid, lambda r: len(r) <> len(grid[1]))) = 0"""


def _pipe_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Tables of the records as they arrived; repeated keys are dropped from what is made of them."""
    rows = _arrived_records(spark, folder).select("record_id", F.posexplode(T.blocks("text")).alias("place", "block"))
    parsed = rows.select("record_id", (F.col("place") + 1).cast("bigint").alias("place"), T.parse_pipe_table("block").alias("t"))
    return parsed.where("t is not null")


@_query(f"SELECT record_id, place, len(grid) - 2 AS n_rows, len(grid[1]) AS n_cols, array_to_string(grid[1], '/') AS header FROM ({_PARSED})")
def pipe_table_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = _pipe_tables(spark, folder)
    return rows.select("record_id", "place", F.size("t.rows").cast("bigint").alias("n_rows"), F.size("t.header").cast("bigint").alias("n_cols"), F.array_join("t.header", "/").alias("header")).dropDuplicates(["record_id", "place"])


_ROW = lambda r: f"'| ' || array_to_string({r}, ' | ') || ' |'"


@_query(
    f"""
    SELECT record_id, place, md5(array_to_string(list_concat([{_ROW('grid[1]')}, {_ROW("list_transform(grid[1], lambda c: '---')")}], list_transform(grid[3:], lambda r: {_ROW('r')})), chr(10))) AS digest
    FROM ({_PARSED})"""
)
def pipe_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    rows = _pipe_tables(spark, folder)
    return rows.select("record_id", "place", F.md5(T.format_pipe_table(F.col("t.header"), F.col("t.rows"))).alias("digest")).dropDuplicates(["record_id", "place"])


@_query(
    f"""
    WITH t AS (SELECT record_id, place, grid FROM ({_PARSED})),
    r AS (SELECT record_id, place, unnest(range(1, len(grid) + 1)) AS i, grid FROM t),
    w AS (SELECT record_id, place, i, strlen({_ROW("CASE WHEN i = 2 THEN list_transform(grid[1], lambda c: '---') ELSE grid[i] END")}) + 1 AS n FROM r),
    s AS (SELECT record_id, place, i, sum(n) OVER (PARTITION BY record_id, place ORDER BY i) AS total FROM w)
    SELECT record_id, place, count(*) FILTER (i > 2 AND total <= 401)::BIGINT AS kept, count(*) FILTER (i > 2)::BIGINT AS n_rows FROM s GROUP BY ALL"""
)
def byte_budget_rows(spark: SparkSession, folder: str) -> DataFrame:
    """How many leading rows of each table fit into 400 bytes with its header, line ends between rows counted."""
    rows = _pipe_tables(spark, folder)
    size = lambda r: F.octet_length(T.format_pipe_row(r)) + 1
    head = size(F.col("t.header")) + size(F.transform("t.header", lambda c: F.lit("---")))
    start = F.struct(head.alias("total"), F.lit(0).alias("kept"))
    fold = F.aggregate("t.rows", start, lambda s, r: F.struct((s["total"] + size(r)).alias("total"), (s["kept"] + F.when(s["total"] + size(r) <= 401, 1).otherwise(0)).alias("kept")))
    return rows.select("record_id", "place", fold["kept"].cast("bigint").alias("kept"), F.size("t.rows").cast("bigint").alias("n_rows")).dropDuplicates(["record_id", "place"])


def _shape_sql(x: str) -> list[str]:
    space = "[ \\t\\n\\r\\f\\v]"
    return [_n(x, f"(?i)<table(?:{space}[^<>]*)?>"), _n(x, f"(?i)<tr(?:{space}[^<>]*)?>"), _n(x, f"(?i)<t[dh](?:{space}[^<>]*)?>"), f"len(list_filter(string_split_regex({x}, '{T.LINE_END}'), lambda v: {_PIPE}))"]


def _score_sql(a: str, b: str) -> str:
    parts = [f"(CASE WHEN {p} = 0 AND {q} = 0 THEN 100.0::DOUBLE ELSE greatest(0.0::DOUBLE, 100 * (1 - abs({p} - {q})::DOUBLE / greatest({p}, {q}, 1))) END)" for p, q in zip(_shape_sql(a), _shape_sql(b))]
    return "(" + " + ".join(parts) + f") / {len(parts)}"


@_query(f"SELECT c.row_id, round({_score_sql('c.x', 'r.x')}, 6) AS score FROM (SELECT row_id, file_name, coalesce(text, '') AS x FROM {_CELLS}) c JOIN (SELECT file_name, coalesce(text, '') AS x FROM {_RECORDS}) r ON c.file_name = r.file_name")
def structure_score(spark: SparkSession, folder: str) -> DataFrame:
    a = _cells(spark, folder).select("row_id", "file_name", F.coalesce("text", F.lit("")).alias("a"))
    b = _records(spark, folder).select("file_name", F.coalesce("text", F.lit("")).alias("b"))

    def counts(c: str) -> list:
        shape = T.html_shape(c)
        return [shape["tables"], shape["rows"], shape["cells"], F.size(F.filter(F.split(F.col(c), T.LINE_END), T.pipe_row))]

    return a.join(b, "file_name").select("row_id", F.round(T.structure_score(counts("a"), counts("b")), 6).alias("score"))


@_query(f"SELECT sha256(text) AS digest, count(*) AS n, min(doc_id) AS first FROM documents WHERE length(text) >= 200 GROUP BY 1 HAVING count(*) >= 2")
def identical_part_breaker(spark: SparkSession, folder: str) -> DataFrame:
    return combine.identical_outputs(_documents(spark, folder), "doc_id", min_chars=200, threshold=2)


@_query(f"SELECT row_id, file_name FROM {_CELLS} WHERE file_name IS NOT NULL AND sha1(file_name) NOT IN (SELECT sha1(file_name) FROM {_RECORDS} WHERE file_name IS NOT NULL)")
def cache_anti_join(spark: SparkSession, folder: str) -> DataFrame:
    rows = _cells(spark, folder).where("file_name is not null").select("row_id", "file_name")
    return combine.not_cached(rows, _records(spark, folder))


@_query(f"SELECT row_id, ratio FROM (SELECT row_id, round({_dup('text')}, 6) AS ratio FROM {_CELLS}) ORDER BY ratio DESC, row_id LIMIT 25")
def worst_k(spark: SparkSession, folder: str) -> DataFrame:
    rows = one_per_key(_arrived_cells(spark, folder).select("row_id", F.round(T.duplicate_line_ratio("text"), 6).alias("ratio")), "row_id")
    return rows.orderBy(F.desc("ratio"), "row_id").limit(25)


@_query(f"SELECT record_id, file_name FROM {_RECORDS} ORDER BY file_name, record_id LIMIT 50 OFFSET 20")
def offset_limit(spark: SparkSession, folder: str) -> DataFrame:
    return _records(spark, folder).select("record_id", "file_name").orderBy("file_name", "record_id").offset(20).limit(50)


@_query(
    f"""
    WITH c AS (SELECT DISTINCT file_name FROM {_CELLS}), r AS (SELECT DISTINCT file_name FROM {_RECORDS})
    SELECT 'both' AS part, file_name FROM (SELECT file_name FROM c INTERSECT SELECT file_name FROM r)
    UNION ALL SELECT 'left', file_name FROM (SELECT file_name FROM c EXCEPT SELECT file_name FROM r)
    UNION ALL SELECT 'right', file_name FROM (SELECT file_name FROM r EXCEPT SELECT file_name FROM c)"""
)
def set_ops_names(spark: SparkSession, folder: str) -> DataFrame:
    c, r = _cells(spark, folder).select("file_name"), _records(spark, folder).select("file_name")
    part = lambda name, rows: rows.select(F.lit(name).alias("part"), "file_name")
    return part("both", c.intersect(r)).unionAll(part("left", c.subtract(r))).unionAll(part("right", r.subtract(c)))


@_query(f"SELECT row_id, len({_solid('text')}) AS n_lines, md5(array_to_string({_solid('text')}, chr(10))) AS digest FROM {_CELLS}")
def read_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    solid = T.solid_lines("text")
    return one_per_key(_arrived_cells(spark, folder).select("row_id", F.when(F.col("text").isNotNull(), F.size(solid)).cast("bigint").alias("n_lines"), F.md5(F.array_join(solid, "\n")).alias("digest")), "row_id")


@_query(
    f"""
    WITH c AS (SELECT DISTINCT regexp_replace(cell, '[{T.SPACES}()（）]', '', 'g') AS k0, cell FROM (SELECT unnest(grid[1]) AS cell FROM ({_PARSED})))
    SELECT cell, lower(k0) AS label_key, regexp_matches({_s('cell')}, '^[+-]?[0-9,]+(?:\\.[0-9]+)?$') AS is_number, regexp_matches(cell, '[A-Za-z一-鿿]') AS is_label FROM c"""
)
def cell_predicates(spark: SparkSession, folder: str) -> DataFrame:
    cells = _pipe_tables(spark, folder).select(F.explode("t.header").alias("cell")).distinct()
    return cells.select("cell", T.label_key("cell").alias("label_key"), T.numeric_cell("cell").alias("is_number"), T.semantic_label("cell").alias("is_label"))


@_query(
    """
    WITH RECURSIVE p AS (SELECT slice_id, x, count(*) AS n, row_number() OVER (PARTITION BY slice_id ORDER BY x) AS i FROM observations WHERE slice_id IS NOT NULL AND x IS NOT NULL GROUP BY 1, 2),
    f AS (SELECT slice_id, i, 1::BIGINT AS cluster, (x * n)::DOUBLE AS total, n::BIGINT AS m FROM p WHERE i = 1
      UNION ALL SELECT p.slice_id, p.i, CASE WHEN p.x - f.total / f.m <= 400 THEN f.cluster ELSE f.cluster + 1 END,
        CASE WHEN p.x - f.total / f.m <= 400 THEN f.total + p.x * p.n ELSE p.x * p.n END, CASE WHEN p.x - f.total / f.m <= 400 THEN f.m + p.n ELSE p.n END
      FROM f JOIN p ON p.slice_id = f.slice_id AND p.i = f.i + 1)
    SELECT slice_id, cluster, round(arg_max(total / m, i), 6) AS center, arg_max(m, i) AS n FROM f GROUP BY slice_id, cluster"""
)
def axis_cluster_running_mean(spark: SparkSession, folder: str) -> DataFrame:
    boxes = read_table(spark, folder, "observations", "slice_id", "x")
    clusters = sequences.cluster_axis(boxes, "slice_id", "x", 400.0)
    return clusters.select("slice_id", F.col("cluster").cast("bigint").alias("cluster"), F.round("center", 6).alias("center"), "n")


@_query(
    """
    WITH c AS (SELECT slice_id, row_number() OVER (PARTITION BY slice_id ORDER BY b) AS cluster, b * 250.0::DOUBLE AS center FROM (SELECT DISTINCT slice_id, floor(x / 250) AS b FROM observations WHERE slice_id IS NOT NULL AND x IS NOT NULL)),
    l AS (SELECT slice_id, greatest(20.0::DOUBLE, 0.42::DOUBLE * coalesce(min(g), 80.0)) AS lim FROM (SELECT slice_id, lead(center) OVER (PARTITION BY slice_id ORDER BY center) - center AS g FROM c) GROUP BY 1),
    w AS (SELECT o.obs_id, o.slice_id, o.x, c.cluster, abs(c.center - o.x) AS d, row_number() OVER (PARTITION BY o.obs_id, o.slice_id, o.x ORDER BY abs(c.center - o.x), c.cluster) AS r
      FROM (SELECT DISTINCT obs_id, slice_id, x FROM observations) o JOIN c ON o.slice_id = c.slice_id)
    SELECT w.obs_id, w.cluster AS place FROM w JOIN l USING (slice_id) WHERE r = 1 AND d <= lim"""
)
def nearest_center_assign(spark: SparkSession, folder: str) -> DataFrame:
    boxes = read_table(spark, folder, "observations", "obs_id", "slice_id", "x").distinct()
    bins = boxes.where("slice_id is not null and x is not null").select("slice_id", F.floor(F.col("x") / 250).alias("b")).distinct()
    from pyspark.sql.window import Window

    centers = bins.select("slice_id", F.row_number().over(Window.partitionBy("slice_id").orderBy("b")).alias("cluster"), (F.col("b") * 250.0).alias("center"))
    placed = sequences.assign_to_centers(boxes.where("x is not null"), centers, "slice_id", "x")
    return placed.select("obs_id", F.col("place").cast("bigint").alias("place"))


_KEYED = "(SELECT DISTINCT doc, CAST(text AS INT) AS k FROM observations WHERE regexp_matches(text, '^[0-9]{1,3}$') AND doc IS NOT NULL)"


def _keyed(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "observations", "doc", "text").where(F.col("text").rlike("^[0-9]{1,3}$") & F.col("doc").isNotNull())
    return rows.select("doc", F.col("text").cast("int").alias("k")).distinct()


@_query(
    f"""
    WITH n AS (SELECT doc, k - row_number() OVER (PARTITION BY doc ORDER BY k) AS start FROM {_KEYED}), c AS (SELECT doc, start, count(*) AS inliers FROM n GROUP BY 1, 2)
    SELECT doc, start, inliers, total AS n FROM (SELECT *, sum(inliers) OVER (PARTITION BY doc)::BIGINT AS total, row_number() OVER (PARTITION BY doc ORDER BY inliers DESC, start) AS r FROM c) WHERE r = 1"""
)
def row_offset_mode(spark: SparkSession, folder: str) -> DataFrame:
    rows = sequences.offset_mode(_keyed(spark, folder), "doc", "k", "k")
    return rows.select("doc", F.col("start").cast("bigint").alias("start"), "inliers", "n")


@_query(
    f"""
    WITH s AS (SELECT doc, k, lead(k) OVER (PARTITION BY doc ORDER BY k) - k AS step FROM {_KEYED})
    SELECT doc, count(*) AS n_keys, coalesce(max(step) - 1, 0)::BIGINT AS gap FROM s GROUP BY doc
    HAVING count(*) >= 3 AND count(*) FILTER (step = 1) >= 1 AND count(*) FILTER (step = 1) >= 0.1 * (count(*) - 1)"""
)
def sequence_gap(spark: SparkSession, folder: str) -> DataFrame:
    rows = sequences.largest_gap(_keyed(spark, folder), "doc", "k", least_keys=3, least_steps=1, step_share=0.1)
    return rows.select("doc", "n_keys", F.col("gap").cast("bigint").alias("gap"))


@_query(f"SELECT doc, min(k)::BIGINT AS first, max(k)::BIGINT AS last, count(*) AS n FROM (SELECT doc, k, k - row_number() OVER (PARTITION BY doc ORDER BY k) AS i FROM {_KEYED}) GROUP BY doc, i")
def consecutive_runs(spark: SparkSession, folder: str) -> DataFrame:
    rows = sequences.consecutive_runs(_keyed(spark, folder), "doc", "k")
    return rows.select("doc", F.col("first").cast("bigint").alias("first"), F.col("last").cast("bigint").alias("last"), "n")


@_query(
    f"""
    WITH r AS (SELECT file_name, slice_id, width, lag(width) OVER w AS before, row_number() OVER w AS k FROM {_SLICES} WHERE width IS NOT NULL WINDOW w AS (PARTITION BY file_name ORDER BY slice_id))
    SELECT slice_id, (1 + sum(CASE WHEN width - before >= 500 AND k > 2 THEN 1 ELSE 0 END) OVER (PARTITION BY file_name ORDER BY slice_id))::BIGINT AS grp FROM r"""
)
def triangular_resets(spark: SparkSession, folder: str) -> DataFrame:
    rows = _slices(spark, folder).where("width is not null")
    out = sequences.triangular_resets(rows, "file_name", "slice_id", "width", least_jump=500, least_rows=2)
    return out.select("slice_id", F.col("group").cast("bigint").alias("grp"))


_FEATURES = "(SELECT run_id, file_name, max(gt_length) AS gt_length FROM split_features GROUP BY 1, 2)"


@_query(
    f"""
    WITH f AS {_FEATURES}
    SELECT run_id, file_name, least(7, floor((rank() OVER (PARTITION BY run_id ORDER BY gt_length) - 1) * 8 / count(*) OVER (PARTITION BY run_id)))::BIGINT AS bucket FROM f WHERE gt_length IS NOT NULL"""
)
def quantile_strata(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "split_features", "run_id", "file_name", "gt_length").groupBy("run_id", "file_name").agg(F.max("gt_length").alias("gt_length"))
    out = sequences.quantile_bucket(rows.where("gt_length is not null"), "gt_length", 8, "run_id")
    return out.select("run_id", "file_name", F.col("bucket").cast("bigint").alias("bucket"))


@_query(
    """
    WITH c AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2), t AS (SELECT *, sum(n) OVER (PARTITION BY l_suppkey)::BIGINT AS total, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_returnflag) AS r FROM c)
    SELECT l_suppkey, l_returnflag, n, total FROM t WHERE r = 1 AND total >= 10 AND n >= total * 0.36"""
)
def dominant_value(spark: SparkSession, folder: str) -> DataFrame:
    return sequences.dominant_value(read_table(spark, folder, "lineitem", "l_suppkey", "l_returnflag"), "l_suppkey", "l_returnflag", share=0.36)


@_query(
    """
    WITH s AS (SELECT DISTINCT ON (slice_id) slice_id, file_name, content_pixels FROM image_slices)
    SELECT slice_id, coalesce(content_pixels, CASE
      WHEN b.slice_b IS NOT NULL AND (a.slice_a IS NULL OR slice_id - b.slice_b <= a.slice_a - slice_id) THEN b.pixels ELSE a.pixels END) AS content_pixels
    FROM s, LATERAL (SELECT max(t.slice_id) AS slice_b, arg_max(t.content_pixels, t.slice_id) AS pixels FROM s t WHERE t.file_name = s.file_name AND t.slice_id <= s.slice_id AND t.content_pixels IS NOT NULL) b,
      LATERAL (SELECT min(t.slice_id) AS slice_a, arg_min(t.content_pixels, t.slice_id) AS pixels FROM s t WHERE t.file_name = s.file_name AND t.slice_id >= s.slice_id AND t.content_pixels IS NOT NULL) a"""
)
def nearest_fill(spark: SparkSession, folder: str) -> DataFrame:
    rows = _slices(spark, folder).select("slice_id", "file_name", "content_pixels")
    return sequences.nearest_fill(rows, "file_name", "slice_id", "content_pixels").select("slice_id", "content_pixels")


@_query(
    f"""
    WITH o AS (SELECT slice_id, count(*) AS content_pixels, count(*) FILTER (text IS NOT NULL) AS text_pixels FROM observations GROUP BY 1)
    SELECT s.slice_id, coalesce(s.content_pixels, o.content_pixels) AS content_pixels, coalesce(s.text_pixels, o.text_pixels) AS text_pixels FROM {_SLICES} s LEFT JOIN o ON s.slice_id = o.slice_id"""
)
def row_key_cell_coalesce(spark: SparkSession, folder: str) -> DataFrame:
    local = read_table(spark, folder, "observations", "slice_id", "text").groupBy("slice_id").agg(F.count("*").alias("content_pixels"), F.count("text").alias("text_pixels"))
    return combine.fill_cells(_slices(spark, folder), local, "slice_id", ["content_pixels", "text_pixels"])


@_query(
    f"""
    WITH s AS {_SLICES}, g AS (SELECT file_name, max(rows) AS r, max(cols) AS c FROM s WHERE rows > 0 AND cols > 0 AND file_name IS NOT NULL GROUP BY 1),
    p AS (SELECT file_name, unnest(range(1, r + 1)) AS "row", c FROM g), q AS (SELECT file_name, "row", unnest(range(1, c + 1)) AS col FROM p)
    SELECT q.file_name, q."row", q.col, t.col IS NOT NULL AS present FROM q LEFT JOIN (SELECT DISTINCT file_name, "row", col FROM s) t ON q.file_name = t.file_name AND q."row" = t."row" AND q.col = t.col"""
)
def grid_completion(spark: SparkSession, folder: str) -> DataFrame:
    rows = combine.complete_grid(_slices(spark, folder), "file_name")
    return rows.select("file_name", F.col("row").cast("bigint").alias("row"), F.col("col").cast("bigint").alias("col"), "present")


_PAGES = "(SELECT file_name, max(x1) AS w, max(y1) AS h FROM image_slices WHERE file_name IS NOT NULL GROUP BY 1 HAVING max(x1) > 0 AND max(y1) > 0)"


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "image_slices", "file_name", "x1", "y1").where("file_name is not null")
    return rows.groupBy("file_name").agg(F.max("x1").alias("w"), F.max("y1").alias("h")).where("w > 0 and h > 0")


_AXIS = lambda n, size, over: f"CASE WHEN {size} >= {n} THEN 0 ELSE CAST(ceil(({n} - {size})::DOUBLE / {size - over}) AS BIGINT) END"


@_query(
    f"""
    WITH p AS {_PAGES}, r AS (SELECT *, {_AXIS('w', 2800, 80)} AS nc, {_AXIS('h', 4200, 120)} AS nr FROM p), a AS (SELECT *, unnest(range(0, nr + 1)) AS i FROM r), b AS (SELECT *, unnest(range(0, nc + 1)) AS j FROM a)
    SELECT file_name, i + 1 AS "row", j + 1 AS col, nr + 1 AS rows, nc + 1 AS cols, j * 2720 AS x0, least(j * 2720 + 2800, w) AS x1, i * 4080 AS y0, least(i * 4080 + 4200, h) AS y1 FROM b"""
)
def grid_slices(spark: SparkSession, folder: str) -> DataFrame:
    tiles = geometry.grid_tiles(_pages(spark, folder), "file_name", "w", "h", 2800, 4200, 80, 120)
    return tiles.select("file_name", *[F.col(c).cast("bigint").alias(c) for c in ("row", "col", "rows", "cols", "x0", "x1", "y0", "y1")])


@_query(
    f"""
    WITH p AS (SELECT file_name, greatest(1, least(8, ceil(w / 2800.0)))::BIGINT AS c, greatest(1, least(10, ceil(h / 4200.0)))::BIGINT AS r FROM {_PAGES}),
    a AS (SELECT *, unnest(range(1, r + 1)) AS i FROM p), b AS (SELECT *, unnest(range(1, c + 1)) AS j FROM a),
    k AS (SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY greatest(r::DOUBLE / i, c::DOUBLE / j), -i * j, abs(r::DOUBLE / c - i::DOUBLE / j), i, j) AS o FROM b WHERE i * j <= 12)
    SELECT file_name, r AS rows, c AS cols, CASE WHEN r * c <= 12 THEN r ELSE i END AS fit_rows, CASE WHEN r * c <= 12 THEN c ELSE j END AS fit_cols FROM k WHERE o = 1"""
)
def adaptive_grid_budget(spark: SparkSession, folder: str) -> DataFrame:
    rows = _pages(spark, folder).select("file_name", geometry.adaptive_count(F.col("h"), 4200, 1, 10).alias("rows"), geometry.adaptive_count(F.col("w"), 2800, 1, 8).alias("cols"))
    fit = geometry.fit_to_budget(F.col("rows"), F.col("cols"), 12)
    return rows.select("file_name", F.col("rows").cast("bigint").alias("rows"), F.col("cols").cast("bigint").alias("cols"), fit["r"].cast("bigint").alias("fit_rows"), fit["c"].cast("bigint").alias("fit_cols"))


_CROP = " UNION ALL ".join(
    f"SELECT file_name, {k} AS o, least({s}, w) AS cw, least({s}, h) AS ch, floor((w - least({s}, w)) * {geometry.ANCHORS[a][0]})::BIGINT AS x0, floor((h - least({s}, h)) * {geometry.ANCHORS[a][1]})::BIGINT AS y0 FROM p"
    for k, (s, a) in enumerate((s, a) for s in (800, 600) for a in ("top_left", "top_right", "center", "bottom_left", "bottom_right"))
)


@_query(
    f"""
    WITH p AS {_PAGES}, c AS ({_CROP}), d AS (SELECT file_name, x0, x0 + cw AS x1, y0, y0 + ch AS y1, min(o) AS o FROM c GROUP BY 1, 2, 3, 4, 5)
    SELECT file_name, row_number() OVER (PARTITION BY file_name ORDER BY o) AS ord, x0, x1, y0, y1 FROM d"""
)
def anchor_crops(spark: SparkSession, folder: str) -> DataFrame:
    crops = geometry.anchor_crops(_pages(spark, folder), "file_name", "w", "h", sizes=(800, 600))
    return crops.select("file_name", *[F.col(c).cast("bigint").alias(c) for c in ("ord", "x0", "x1", "y0", "y1")])


@_query(f"SELECT file_name, unnest(list_transform(range(0, 8), lambda i: round_even(h * i / 7.0, 0)::BIGINT)) AS edge, unnest(range(0, 8)) AS place FROM {_PAGES}")
def even_edges(spark: SparkSession, folder: str) -> DataFrame:
    rows = _pages(spark, folder).select("file_name", F.posexplode(geometry.even_edges(F.lit(0), F.col("h"), F.lit(7))).alias("place", "edge"))
    return rows.select("file_name", F.col("edge").cast("bigint").alias("edge"), F.col("place").cast("bigint").alias("place"))


@_query(f"SELECT slice_id, coalesce(text_pixels < 2000, false) OR coalesce(content_pixels < 20000 AND content_ratio < 0.01, false) AS skipped FROM {_SLICES}")
def low_content_slices(spark: SparkSession, folder: str) -> DataFrame:
    skipped = geometry.low_content(F.col("text_pixels"), F.col("content_pixels"), F.col("content_ratio"), 2_000, 20_000, 0.01)
    return _slices(spark, folder).select("slice_id", skipped.alias("skipped"))


@_query(f"SELECT slice_id, CASE WHEN width > 0 AND height > 0 THEN CASE WHEN width::DOUBLE / height <= 0.5 THEN 'long' ELSE 'table' END END AS strategy FROM {_SLICES}")
def routing(spark: SparkSession, folder: str) -> DataFrame:
    return _slices(spark, folder).select("slice_id", geometry.route(F.col("width"), F.col("height"), 0.5).alias("strategy"))


_PARTS = f"list_transform(range(0, greatest(1, ceil((len(l) - 3) / 5.0)::INT)), lambda i: l[i * 5 + 1 : i * 5 + 8])"
_MEET = "coalesce(list_max(list_filter(range(1, 31), lambda k: k <= len(a) AND k <= len(b) AND a[len(a) - k + 1 : len(a)] = b[1 : k])), 0)"


@_query(
    f"""
    WITH s AS (SELECT row_id, {_solid('text')} AS l FROM {_CELLS} WHERE text IS NOT NULL), p AS (SELECT row_id, {_PARTS} AS parts FROM s WHERE len(l) > 0)
    SELECT row_id, md5({_s("array_to_string(list_reduce(parts, lambda a, b: list_concat(a, b[" + _MEET + " + 1 : len(b)])), chr(10))")} || chr(10)) AS digest FROM p"""
)
def line_overlap_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Each text cut into parts of eight lines that share three, and merged again."""
    rows = _arrived_cells(spark, folder).where("text is not null").select("row_id", T.solid_lines("text").alias("l")).where(F.size("l") > 0)
    n = F.greatest(F.lit(1), F.ceil((F.size("l") - 3) / 5).cast("int"))
    parts = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.array_join(F.slice("l", i * 5 + 1, 8), "\n"))
    return one_per_key(rows.select("row_id", F.md5(merge.merge_lines(parts)).alias("digest")), "row_id")


@_query(
    f"""
    WITH t AS (SELECT row_id, text FROM {_CELLS} WHERE contains(lower(text), '<table')),
    l AS (SELECT row_id, unnest(v) AS line, generate_subscripts(v, 1) AS o FROM (SELECT row_id, list_filter(list_transform(
      string_split_regex(regexp_extract(text, '(?is)^(.*?)<table', 1), '{T.LINE_END}'), lambda v: {_s('v')}), lambda v: v <> '') AS v FROM t)),
    f AS (SELECT row_id, line, min(o) AS o FROM l GROUP BY 1, 2)
    SELECT t.row_id, coalesce((SELECT string_agg(line, chr(10) ORDER BY o) FROM f WHERE f.row_id = t.row_id), '') AS preamble FROM t"""
)
def preamble_distinct_lines(spark: SparkSession, folder: str) -> DataFrame:
    rows = _cells(spark, folder).where(F.lower("text").contains("<table"))
    return rows.select("row_id", merge.distinct_lines(F.array(merge.preamble(F.col("text")))).alias("preamble"))


@_query(
    f"""
    SELECT o.obs_id, round(s.x0 + o.x * (s.x1 - s.x0) / s.width, 6) AS x, round(s.y0 + o.y * (s.y1 - s.y0) / s.height, 6) AS y
    FROM (SELECT DISTINCT obs_id, slice_id, x, y, width, height, confidence FROM observations) o JOIN {_SLICES} s ON o.slice_id = s.slice_id
    WHERE s.width > 0 AND s.height > 0 AND s.y0 IS NOT NULL AND s.y1 IS NOT NULL AND o.x IS NOT NULL AND o.y IS NOT NULL AND o.width IS NOT NULL AND o.height IS NOT NULL AND o.confidence IS NOT NULL"""
)
def tsv_boxes(spark: SparkSession, folder: str) -> DataFrame:
    """Boxes written as lines of their tile and read back to the page; the text holds the box's number."""
    seen = read_table(spark, folder, "observations", "obs_id", "slice_id", "x", "y", "width", "height", "confidence").distinct()
    line = boxes.to_tsv(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("x", "y", "width", "height", "confidence")], F.col("obs_id").cast("string"))
    tiles = _slices(spark, folder).where("width > 0 and height > 0 and y0 is not null and y1 is not null").select("slice_id", "x0", "x1", "y0", "y1", "width", "height")
    read = boxes.tile_boxes(seen.select("slice_id", line.alias("tsv")).join(tiles, "slice_id"), "slice_id")
    return read.select(F.col("text").cast("bigint").alias("obs_id"), F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@_query(f"SELECT row_id, contains(lower(text), '<table') AS has_table, md5({_s('text')} || chr(10)) AS digest FROM {_CELLS} WHERE text IS NOT NULL AND {_s('text')} <> '' AND NOT starts_with({_s('text')}, '```')")
def payload_text(spark: SparkSession, folder: str) -> DataFrame:
    """Texts wrapped as nested payloads and taken out again, without white space at the edges and with one line end."""
    rows = _arrived_cells(spark, folder).where((T.strip("text") != "") & ~T.strip("text").startswith("```"))
    wrapped = F.to_json(F.struct(F.lit(True).alias("success"), F.struct(F.array(F.struct(F.col("text").alias("content"))).alias("choices")).alias("data")))
    read = rows.select("row_id", F.lower("text").contains("<table").alias("has_table"), wrapped.alias("wrapped")).select("row_id", "has_table", boxes.payload_texts("wrapped").alias("payload"))
    return one_per_key(read.select("row_id", "has_table", F.md5("payload").alias("digest")), "row_id")


# HTML tables without spans, as grids.
_HTML_BLOCK = r"(?is)<table\b.*?</table\s*>"
_HTML_ROWS = lambda x: f"list_transform(regexp_extract_all({x}, '(?is)<tr[^<>]*>.*?</tr>'), lambda r: list_transform(regexp_extract_all(r, '(?is)<t[dh][^<>]*>(.*?)</t[dh]>', 1), lambda c: {_c('c')}))"
_HTML_GRIDS = f"""
    SELECT record_id, place, block, {_HTML_ROWS('block')} AS grid, len(regexp_extract_all(regexp_extract(block, '(?is)<tr[^<>]*>(.*?)</tr>', 1), '(?i)<td')) = 0 AS explicit
    FROM (SELECT record_id, unnest(b) AS block, generate_subscripts(b, 1) - 1 AS place FROM (SELECT record_id, regexp_extract_all(text, '{_HTML_BLOCK}') AS b FROM {_RECORDS}))"""


@_query(f"SELECT record_id, place, len(grid[1]) AS n_cols, len(grid) - 1 AS n_rows, explicit, array_to_string(grid[1], '/') AS header FROM ({_HTML_GRIDS})")
def html_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Every HTML table as a grid; null header where it is no simple one."""
    rows = _arrived_records(spark, folder).where(F.lower("text").contains("<table"))
    found = F.regexp_extract_all("text", F.lit(_HTML_BLOCK), F.lit(0))
    each = rows.select("record_id", F.posexplode(found).alias("place", "block")).withColumn("g", tables.html_grid("block"))
    sized = each.select("record_id", F.col("place").cast("bigint").alias("place"), F.size("g.header").cast("bigint").alias("n_cols"), F.size("g.rows").cast("bigint").alias("n_rows"), "g.explicit", F.array_join("g.header", "/").alias("header"))
    return sized.dropDuplicates(["record_id", "place"])


_AS_PIPES = f"array_to_string(list_concat([{_ROW('grid[1]')}, {_ROW("list_transform(grid[1], lambda c: '---')")}], list_transform(grid[2:], lambda r: {_ROW('r')})), chr(10))"


@_query(
    f"""
    WITH g AS ({_HTML_GRIDS}), p AS (SELECT record_id, list({_AS_PIPES} ORDER BY place) AS pipes FROM g GROUP BY 1),
    t AS (SELECT record_id, string_split_regex(text, '{_HTML_BLOCK}') AS parts FROM {_RECORDS} WHERE contains(lower(text), '<table'))
    SELECT t.record_id, md5(array_to_string(list_transform(range(1, len(parts) + 1), lambda i: parts[i] || coalesce(pipes[i], '')), '')) AS digest FROM t LEFT JOIN p ON t.record_id = p.record_id"""
)
def html_to_pipe(spark: SparkSession, folder: str) -> DataFrame:
    rows = _arrived_records(spark, folder).where(F.lower("text").contains("<table"))
    return one_per_key(rows.select("record_id", F.md5(tables.pipes_from_html("text")).alias("digest")), "record_id")


@_query()
def implied_closures(spark: SparkSession, folder: str) -> DataFrame:
    rows = _arrived_cells(spark, folder).withColumn("closed", tables.implied_closed("text"))
    return one_per_key(rows.select("row_id", T.html_issue("text").alias("before"), T.html_issue("closed").alias("after")), "row_id")


@_query(
    f"""
    WITH h AS (SELECT record_id, grid FROM ({_HTML_GRIDS})),
    l AS (SELECT record_id, unnest(v) AS v, generate_subscripts(v, 1) AS i FROM (SELECT record_id, string_split_regex(regexp_replace(text, '{_HTML_BLOCK}', chr(10), 'g'), '{T.LINE_END}') AS v FROM {_RECORDS})),
    k AS (SELECT record_id, i, v, i - row_number() OVER (PARTITION BY record_id ORDER BY i) AS run FROM l WHERE {_PIPE}),
    b AS (SELECT record_id, list({_CELLS_OF('v')} ORDER BY i) AS grid FROM k GROUP BY record_id, run),
    p AS (SELECT record_id, list_concat([grid[1]], grid[3:]) AS grid FROM b WHERE len(grid) >= 2 AND len(list_filter(grid, lambda r: len(r) <> len(grid[1]))) = 0
      AND len(list_filter(grid[2], lambda c: NOT regexp_matches(replace(c, ' ', ''), '{T.SEPARATOR_CELL}'))) = 0),
    g AS (SELECT * FROM h UNION ALL SELECT * FROM p)
    SELECT r.record_id, count(g.grid) AS tables, coalesce(sum(len(grid)), 0)::BIGINT AS rows, coalesce(sum(len(grid) * len(grid[1])), 0)::BIGINT AS cells, coalesce(sum(len(grid[1])), 0)::BIGINT AS header_cells,
      coalesce(sum((len(grid) - 1) * len(grid[1])), 0)::BIGINT AS data_cells, coalesce(max(len(grid[1])), 0)::BIGINT AS columns
    FROM {_RECORDS} r LEFT JOIN g ON r.record_id = g.record_id GROUP BY r.record_id"""
)
def table_statistics(spark: SparkSession, folder: str) -> DataFrame:
    found = _arrived_records(spark, folder).select("record_id", tables.table_stats("text").alias("s"))
    return one_per_key(found.select("record_id", *[F.col(f"s.{f.name}").cast("bigint").alias(f.name) for f in found.schema["s"].dataType]), "record_id")


_ENDS = "\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}"
_BAR = f"contains(v, '|') AND len(list_filter({_CELLS_OF('v')}, lambda c: NOT regexp_matches(replace(c, ' ', ''), '{T.SEPARATOR_CELL}'))) = 0"


@_query(
    f"""
    WITH r AS (SELECT record_id, text, list_filter(regexp_extract_all(text, '[^{_ENDS}]*(?:\r\n|[{_ENDS}]|$)'), lambda v: v <> '') AS ls FROM {_RECORDS}),
    l AS (SELECT record_id, unnest(ls) AS v, generate_subscripts(ls, 1) AS i FROM r),
    k AS (SELECT record_id, i, v, sum(strlen(v)) OVER (PARTITION BY record_id ORDER BY i) AS upto, {_PIPE} AND length(v) - length(replace(v, '|', '')) > 1 AS is_row, {_BAR} AS bar, len({_CELLS_OF('v')}) AS w FROM l),
    n AS (SELECT *, is_row AND lead(bar) OVER (PARTITION BY record_id ORDER BY i) AS head, i - row_number() OVER (PARTITION BY record_id, is_row, w ORDER BY i) AS run FROM k),
    t AS (SELECT *, min(CASE WHEN head THEN i END) OVER (PARTITION BY record_id, w, run) AS first FROM n WHERE is_row),
    b AS (SELECT record_id, first, min(upto - strlen(v)) AS low, max(upto) AS high, max(upto) FILTER (i >= first + 2 AND upto <= 1000) AS part, max(CASE WHEN ends_with(v, chr(10)) THEN 0 ELSE 1 END) AS bare FROM t WHERE i >= first GROUP BY record_id, first),
    c AS (SELECT *, min(CASE WHEN high > 1000 THEN first END) OVER (PARTITION BY record_id) AS bad FROM b),
    g AS (SELECT record_id, CASE WHEN max(CASE WHEN first = bad AND low <= 1000 THEN 1 ELSE 0 END) = 1 THEN max(part) FILTER (first = bad) ELSE max(high + bare) FILTER (bad IS NULL OR first < bad) END AS kept FROM c GROUP BY 1)
    SELECT r.record_id, strlen(text) AS before, CASE WHEN strlen(text) <= 1000 THEN strlen(text) ELSE kept END AS after FROM r LEFT JOIN g ON r.record_id = g.record_id"""
)
def retain_within_budget(spark: SparkSession, folder: str) -> DataFrame:
    cut = tables.within_budget(1_000)("text")
    return one_per_key(_arrived_records(spark, folder).select("record_id", F.octet_length("text").cast("bigint").alias("before"), F.octet_length(cut).cast("bigint").alias("after")), "record_id")


@_query()
def evaluate_pairs(spark: SparkSession, folder: str) -> DataFrame:
    predictions = combine.last_per_name(_cells(spark, folder), order=("run_id", "ord", "row_id"))
    return evaluate.evaluate(predictions, _records(spark, folder))


@_query()
def evaluate_summary(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.summary(evaluate_pairs(spark, folder))


def _scored(rows: str) -> str:
    """Texts ``x`` with their score, kind, length and repetition."""
    tables_, rows_, cells, _ = _shape_sql("x")
    widest = f"coalesce(list_max(list_transform(regexp_extract_all(x, '(?is)<tr(?:[ \\t\\n\\r\\f\\v][^<>]*)?>.*?</tr[ \\t\\n\\r\\f\\v]*>'), lambda r: {_n('r', '(?i)<t[dh](?:[ \\t\\n\\r\\f\\v][^<>]*)?>')})), 0)"
    fine = f"NOT contains(lower(x), 'markdown parsing task') AND {_FINE('x')} AND NOT {_TRUNCATED} AND {tables_} <= 32 AND {widest} <= 256 AND ({_MARKUP} OR NOT {_UNSTRUCTURED})"
    pipes = "len(list_filter(string_split(x, chr(10)), lambda v: regexp_matches(v, '^[ \\t\\n\\r\\f\\v]*\\|.*\\|[ \\t\\n\\r\\f\\v]*$')))"
    return f"""
        SELECT * EXCLUDE (x, cells, pipes, rows_), CASE WHEN n = 0 THEN 0.0::DOUBLE ELSE CASE WHEN markup THEN 16 ELSE 0 END + CASE WHEN fine THEN 14 ELSE 0 END + CASE WHEN NOT cut THEN 14 ELSE 0 END
          + least(24.0::DOUBLE, greatest(cells, pipes * 2)::DOUBLE / 18) + least(14.0::DOUBLE, greatest(rows_, pipes)::DOUBLE / 6) + CASE WHEN dup <= 0.18 THEN 8 ELSE 0 END END AS score
        FROM (SELECT *, length({_s('x')}) AS n, {_MARKUP} AS markup, {fine} AS fine, {_TRUNCATED} AS cut, {_dup('x')} AS dup, {cells} AS cells, {rows_} AS rows_, {pipes} AS pipes,
          CASE WHEN regexp_matches(x, '(?i)<table|\\|[ \\t\\n\\r\\f\\v]*:?-{{3,}}') THEN 2 WHEN {_MARKUP} THEN 1 ELSE 0 END AS kind FROM ({rows}))"""


@_query(
    f"""
    WITH a AS ({_scored(f"SELECT row_id, file_name, coalesce(text, '') AS x FROM {_CELLS}")}), b AS ({_scored(f"SELECT file_name, coalesce(text, '') AS x FROM {_RECORDS}")})
    SELECT row_id, round(a.score, 6) AS score, round(b.score, 6) AS repair_score,
      b.n > 0 AND b.dup <= 0.30 AND (b.kind > a.kind OR a.n = 0 OR b.score >= a.score + 8 OR (b.score >= a.score AND b.n >= a.n + 300)) AS better
    FROM a JOIN b ON a.file_name = b.file_name"""
)
def candidate_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of each cell and of the record of its page, and whether the record is the better repair."""
    both = _cells(spark, folder).select("row_id", "file_name", F.col("text").alias("a")).join(_records(spark, folder).select("file_name", F.col("text").alias("b")), "file_name")
    return both.select("row_id", F.round(table_score(F.col("a")), 6).alias("score"), F.round(table_score(F.col("b")), 6).alias("repair_score"), better_repair(F.col("a"), F.col("b")).alias("better"))


@_query()
def reading_order(spark: SparkSession, folder: str) -> DataFrame:
    seen = read_table(spark, folder, "observations", "slice_id", "x", "y", "width", "height", "confidence", "text")
    return lattice.reading_order(seen, "slice_id")


@_query()
def lattice_matrices(spark: SparkSession, folder: str) -> DataFrame:
    """Matrices from boxes laid out of the line items: supplier by part, one page for each supplier."""
    rows = read_table(spark, folder, "lineitem", "l_suppkey", "l_linenumber", "l_quantity").groupBy("l_suppkey", "l_linenumber", F.col("l_quantity").cast("int").alias("q")).count()
    box = lambda x, y, t: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"), t.cast("string").alias("text"))
    cell = box(200 + 100 * F.col("l_linenumber"), 200 + 50 * F.col("q"), F.col("count"))
    key = box(F.lit(200), 200 + 50 * F.col("q"), F.col("q"))
    top = box(200 + 100 * F.col("l_linenumber"), F.lit(100), F.col("l_linenumber"))
    laid = rows.select("l_suppkey", F.explode(F.array(cell, key, top)).alias("b")).select("l_suppkey", "b.*").distinct()
    return lattice.matrices(laid.withColumns({"width": F.lit(30.0), "height": F.lit(10.0), "confidence": F.lit(1.0)}), "l_suppkey")


@_query(f"SELECT record_id || '/' || place AS page, true AS same FROM ({_PARSED}) WHERE len(grid) - 2 > 3")
def tile_rebuild(spark: SparkSession, folder: str) -> DataFrame:
    """Pipe tables cut into two bands of rows that share one, and rebuilt."""
    rows = _pipe_tables(spark, folder).where(F.size("t.rows") > 3).dropDuplicates(["record_id", "place"])
    n, half = F.size("t.rows"), F.floor(F.size("t.rows") / 2).cast("int")
    band = lambda a, k: T.format_pipe_table(F.col("t.header"), F.slice("t.rows", a, k))
    bands = F.array(band(F.lit(1), half + 1), band(half + 1, n - half))
    key = F.concat_ws("/", "record_id", "place")
    tiles = rows.select(key.alias("page"), F.posexplode(bands).alias("row", "text")).withColumn("col", F.lit(0))
    whole = rows.select(key.alias("page"), F.concat(T.format_pipe_table(F.col("t.header"), F.col("t.rows")), F.lit("\n")).alias("whole"))
    built = merge.rebuild_pages(tiles, "page")
    return built.join(whole, "page").select("page", (F.col("text") == F.col("whole")).alias("same"))


# The first line before a table that is not empty once numbers are masked and signs dropped.
_FAMILY_LINE = (
    "regexp_replace(regexp_replace(regexp_replace(trim(translate(regexp_replace(v, '&(nbsp|amp|lt|gt|quot|ensp|emsp|mdash|ndash|hellip|middot|times);', ' ', 'g'), "
    f"'{''.join(chr(0xFF01 + i) for i in range(94))}', '{''.join(chr(0x21 + i) for i in range(94)).replace(chr(39), chr(39) * 2)}'), '# '), '[{T.SPACES}]+', ' ', 'g'), "
    "'[0-9]+(?:[.,][0-9]+)?', '#', 'g'), '[^\\p{L}\\p{N}#]', '', 'g')"
)


@_query(
    f"""
    WITH t AS (SELECT list_filter(list_transform(string_split_regex(regexp_extract(text, '(?is)^(.*?)(<table|\\z)', 1), '{T.LINE_END}'), lambda v: {_FAMILY_LINE}), lambda v: v <> '') AS l FROM {_RECORDS} WHERE text IS NOT NULL)
    SELECT coalesce(l[1][1:96], '') AS family, count(*) AS n FROM t GROUP BY 1"""
)
def family_groups(spark: SparkSession, folder: str) -> DataFrame:
    keys = _records(spark, folder).where("text is not null").select(experiment.family_keys("text").alias("family"))
    return keys.groupBy("family").agg(F.count("*").alias("n"))


@_query()
def grouped_split(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "split_features", "run_id", "file_name", "family", "gt_tables", "gt_length", "pixels")
    one = rows.groupBy("run_id", "file_name").agg(*[F.max(c).alias(c) for c in ("family", "gt_tables", "gt_length", "pixels")])
    return experiment.grouped_split(one, {"dev": 0.2, "validation": 0.2, "test": 0.6}).select("run_id", "file_name", "split")


@_query()
def age_path(spark: SparkSession, folder: str) -> DataFrame:
    """Row keys of each slice: whole numbers read from top to bottom, laid along a climbing path."""
    seen = read_table(spark, folder, "observations", "slice_id", "y", "text").where(F.col("text").rlike("^[0-9]{1,2}$"))
    return lattice.key_paths(seen.select("slice_id", "y", F.col("text").cast("int").alias("k")), "slice_id", "y", "k")


@_query(f"SELECT record_id || '/' || place AS page, true AS same FROM ({_PARSED})")
def sequence_cell_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Numbered pipe tables with their last column emptied and filled again from the whole ones."""
    rows = _pipe_tables(spark, folder).dropDuplicates(["record_id", "place"])
    whole = T.format_pipe_table(F.col("t.header"), F.col("t.rows"))
    emptied = F.transform("t.rows", lambda r: F.concat(F.slice(r, 1, F.size(r) - 1), F.array(F.lit(""))))
    pairs = rows.select(F.concat_ws("/", "record_id", "place").alias("page"), T.format_pipe_table(F.col("t.header"), emptied).alias("previous"), whole.alias("local"))
    return merge.fill_tables(pairs, "page", "previous", "local").join(pairs.select("page", "local"), "page").select("page", F.coalesce(F.col("text") == F.col("local"), F.lit(False)).alias("same"))


# Fields of a record: enclosed with inner quotes doubled, or bare.
_FIELD = r'("([^"]|"")*"|[^",\r\n]*)'
_BARE = lambda f: f"CASE WHEN starts_with({f}, '\"') THEN replace(substr({f}, 2, length({f}) - 2), '\"\"', '\"') ELSE {f} END"
_FIELDS = f"""
    SELECT raw_id, name, text, CASE WHEN r IS NULL THEN 'columns' WHEN NOT regexp_full_match(r, '{_FIELD}(,{_FIELD})*') THEN 'quoting' WHEN NOT two THEN 'columns'
      WHEN NOT regexp_matches(lower(name), '\\.(jpg|jpeg|png|webp|bmp)$') OR {_s("regexp_replace(name, '(?i)\\.(jpg|jpeg|png|webp|bmp)$', '')")} = '' OR regexp_matches(name, '[/\\\\]')
        OR {_s('text')} = '' OR regexp_matches(text, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x{{fffd}}]') THEN 'value' END AS reason
    FROM (SELECT raw_id, r, two, {_s(_BARE('f1'))} AS name, {_BARE('f2')} AS text FROM (
      SELECT raw_id, r, regexp_full_match(r, '{_FIELD},{_FIELD}') AS two, regexp_extract(r, '^{_FIELD},{_FIELD}$', 1) AS f1, regexp_extract(r, '^{_FIELD},{_FIELD}$', 3) AS f2 FROM (
        SELECT DISTINCT ON (raw_id) raw_id, regexp_replace(raw_row, '(\\r\\n|\\n|\\r)$', '') AS r FROM submission_raw)))"""


@_query(f"SELECT raw_id, reason FROM ({_FIELDS}) WHERE reason IS NOT NULL")
def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return rejects(read_table(spark, folder, "submission_raw", "raw_id", "raw_row"))


@_query(f"SELECT raw_id, name AS file_name, text AS ground_truth FROM ({_FIELDS}) WHERE reason IS NULL")
def p5_valid(spark: SparkSession, folder: str) -> DataFrame:
    return accepted(read_table(spark, folder, "submission_raw", "raw_id", "raw_row"))
