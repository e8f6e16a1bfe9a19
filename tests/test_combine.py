import pytest

from gridloom.operators import combine as C


def frame(spark, rows, kind="file_name string, text string"):
    return spark.createDataFrame(rows, kind)


def test_overlay(spark):
    base = spark.createDataFrame([("a", "x" * 100, 1), ("b", "y" * 100, 2), ("c", None, 3), (None, "n", 4), ("d", "<p>", 5)], "file_name string, text string, extra int")
    over = frame(spark, [("a", "x" * 99), ("b", "z" * 120), ("c", "new"), (None, "never"), ("d", "<table>" * 30)])
    got = {r["extra"]: (r["accepted"], r["text"]) for r in C.guarded_overlay(base, over, min_ratio=1.0, min_gain=1).collect()}
    assert got == {1: (False, "x" * 100), 2: (True, "z" * 120), 3: (True, "new"), 4: (False, "n"), 5: (False, "<p>")}
    lines = "\n".join(["same line"] * 100)
    assert not C.guarded_overlay(frame(spark, [("a", "x")]), frame(spark, [("a", lines)]), max_duplicate=0.9).first()["accepted"]
    assert [r[0] for r in C.unknown_overrides(base, frame(spark, [("q", "t"), ("a", "t")])).collect()] == ["q"]


def test_fallback(spark):
    got = {r["file_name"]: r["text"] for r in C.collapsed_fallback(frame(spark, [("a", "bad"), ("b", "good " * 80), ("z", "alone")]), frame(spark, [("a", "long " * 50), ("b", "x" * 900)])).collect()}
    assert got == {"a": "long " * 50, "b": "good " * 80}


def test_template_and_names(spark):
    rows = C.expand_template(frame(spark, [("a", ""), ("b", ""), ("c", "")]), frame(spark, [("a", "x"), ("b", " "), ("q", "z")]))
    assert {r["file_name"]: (r["missing"], r["text"]) for r in rows.collect()} == {"a": (False, "x"), "b": (True, "<table></table>"), "c": (True, "<table></table>")}
    status = C.reconcile(frame(spark, [("a", ""), ("a", ""), ("u", ""), (None, "")]), frame(spark, [("a", ""), ("m", "")]))
    assert dict(map(tuple, status.collect())) == {"a": "matched", "u": "unknown", "m": "missing"}


def test_last_wins_and_report(spark):
    rows = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("", "x", 3), (None, "y", 4)], "file_name string, text string, ord int")
    assert [(r["file_name"], r["text"]) for r in C.last_per_name(rows).collect()] == [("a", "2")]
    report = C.validation_report(rows, frame(spark, [("a", ""), ("b", "")])).first().asDict()
    assert report == {"n_rows": 4, "n_bytes": 4, "n_unnamed": 2, "n_blank": 0, "n_broken": 0, "n_repeated": 1, "n_missing": 1, "n_unknown": 0}
    empty = C.validation_report(rows.limit(0), frame(spark, [])).first().asDict()
    assert set(empty.values()) == {0}


def test_grid_cells_and_cache(spark):
    tiles = spark.createDataFrame([("p", 1, 1, 2, 2), ("p", 2, 2, 2, 2), ("q", 1, 1, None, 1)], "file_name string, row int, col int, rows int, cols int")
    got = {(r["row"], r["col"]): r["present"] for r in C.complete_grid(tiles, "file_name").collect()}
    assert got == {(1, 1): True, (1, 2): False, (2, 1): False, (2, 2): True}
    filled = C.fill_cells(spark.createDataFrame([(1, None, 2), (2, 3, None)], "k int, a int, b int"), spark.createDataFrame([(1, 7, 8)], "k int, a int, b int"), "k", ["a", "b"])
    assert sorted(map(tuple, filled.collect())) == [(1, 7, 2), (2, 3, None)]
    assert [r["file_name"] for r in C.not_cached(frame(spark, [("a", ""), ("b", "")]), frame(spark, [("a", "")])).collect()] == ["b"]
    same = C.identical_outputs(frame(spark, [(str(i), "x" * 1000) for i in range(3)] + [("q", "short")]), "file_name")
    assert [(r["n"], r["first"]) for r in same.collect()] == [(3, "0")]
    assert [r["file_name"] for r in C.worst(frame(spark, [("b", "1"), ("a", "1"), ("c", "0")]), "text", "file_name", 2).collect()] == ["c", "a"]


@pytest.mark.parametrize("f", [lambda a, b: C.guarded_overlay(a, b), lambda a, b: C.collapsed_fallback(a, b), lambda a, b: C.reconcile(a, b), lambda a, b: C.expand_template(a, b)])
def test_empty(spark, f):
    assert f(frame(spark, []), frame(spark, [])).count() == 0
