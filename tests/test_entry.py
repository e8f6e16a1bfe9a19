"""The driver contract on the smallest tables: every SQL gives the rows of its query."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
CORE = sorted(entry.core.ORACLE)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return con


def plain(rows):
    fix = lambda v: None if v is None or v != v else round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return sorted([tuple(map(fix, r)) for r in rows], key=repr)


@pytest.mark.parametrize("name", CORE)
def test_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    want = duck.execute(f"select {', '.join(chr(34) + c + chr(34) for c in columns)} from ({entry.oracle_sql()[name]})").fetchall()
    assert plain(tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()) == plain(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["html_tables", "evaluate_pairs", "reading_order", "tile_rebuild", "grouped_split", "implied_closures", "age_path", "sequence_cell_merge", "lattice_matrices", "html_to_pipe", "table_statistics", "family_groups", "candidate_scores"])
def test_without_sql(spark, name):
    rows = entry.queries()[name](spark, FOLDER).collect()
    assert rows
    if name in ("tile_rebuild", "sequence_cell_merge"):
        assert all(r["same"] for r in rows)


def test_core_does_without_the_subpackage():
    import gridloom

    root = os.path.dirname(gridloom.__file__)
    for folder, _, files in os.walk(root):
        if os.path.basename(folder) == "llm":
            continue
        for f in files:
            if f.endswith(".py"):
                text = open(os.path.join(folder, f), encoding="utf-8").read()
                assert "gridloom.llm" not in text, f
