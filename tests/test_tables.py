import difflib
import random

import pytest

from gridloom.functions import tables as B
from gridloom.operators import evaluate as E
from gridloom.operators import experiment as X
from gridloom.operators import lattice as L
from gridloom.operators import merge as M


def test_html_spans_and_headers():
    g = B.parse_html("<table><tr><th rowspan=2>K</th><th colspan=2>V</th></tr><tr><th>a</th><th>b</th></tr><tr><td>1</td><td rowspan=9>x<br>y</td><td>&lt;</td></tr><tr><td>2</td><td>3</td></tr></table>")
    assert g.header == ("K", "V / a", "V / b") and g.explicit
    assert g.rows == (("1", "x y", "<"), ("2", "x y", "3"))
    assert B.parse_html("<table><tr><td rowspan=0>1</td></tr></table>") is None
    assert B.parse_html("<table><tr><td><table></table></td></tr></table>") is None
    assert B.parse_html("prose") is None
    years = B.parse_html("<table><tr><th>K</th><th colspan=5>years</th></tr><tr><td>1</td><td>2</td><td>3</td><td>4</td><td>5</td></tr><tr><td>a</td></tr></table>")
    assert years is not None and years.header[1].startswith("years")


def test_conversions():
    text = "before\n<table><tr><th>a</th></tr><tr><td>1</td></tr></table>\nafter"
    assert B.html_to_pipe(text) == "before\n| a |\n| --- |\n| 1 |\nafter"
    with pytest.raises(ValueError):
        B.html_to_pipe("<table><tr><td>a|b</td></tr></table>")
    g = B.parse_html("<table><tr><th>a</th></tr></table>")
    assert B.to_html(g) == "<table><tr><th>a</th></tr></table>"
    assert B.Grid(("a",), ()) == B.Grid(("a",), (), True, "source")
    assert B.stats(text + "\n| x | y |\n| --- | --- |\n| 1 | 2 |") == (2, 4, 6, 3, 3, 2)
    assert B.close_implied("<table><tr><td>1<td>2<tr><td>3</table>") == "<table><tr><td>1</td><td>2</td></tr><tr><td>3</td></tr></table>"


def test_stray_closings_stay_for_the_check():
    assert B.close_implied("<table><tr></td><td>1<td>2</table>") == "<table><tr></td><td>1</td><td>2</td></table>"
    assert B.close_implied("<table><tr><td>1<table><tr><th>2</table>3<tr><td>4</table>") == "<table><tr><td>1<table><tr><th>2</th></tr></table>3</td></tr><tr><td>4</td></tr></table>"


def test_budget_with_prose_behind_the_table():
    table = "| a | b |\n| --- | --- |\n| 1 | 2 |\n"
    assert B.retain_rows(table + "\n" + "long prose " * 100, 200) == table
    assert B.retain_rows("intro\n" + table + "middle\n" + table + "tail " * 50, 120) == "intro\n" + table + "middle\n" + table
    assert B.retain_rows("intro\n" + table + "middle " * 30 + "\n" + table, 120) == "intro\n" + table
    for text in ("prose only " * 40, "prose " * 40 + "\n" + table):
        with pytest.raises(ValueError):
            B.retain_rows(text, 100)


def test_columns_that_overlap():
    left, right = B.Grid(("k", "A", ""), (("1", "x", ""),)), B.Grid(("A", "", "C"), (("x", "", "z"),))
    assert M.merge_horizontal([left, right]) == B.Grid(("k", "A", "", "C"), (("1", "x", "", "z"),))
    blank = B.Grid(("", "C"), (("", "z"),))
    assert M.merge_horizontal([left, blank]) == B.Grid(("k", "A", "", "", "C"), (("1", "x", "", "", "z"),))


def test_matching_blocks_equal_difflib():
    rng = random.Random(3)
    for n in (40, 400, 900):
        for alphabet in ("ab", "abcdefgh投保人应当核对"):
            a = "".join(rng.choice(alphabet) for _ in range(n))
            b = list(a)
            for _ in range(n // 12):
                at = rng.randrange(len(b))
                b[at : at + rng.randrange(3)] = rng.choice(["", "x", a[: rng.randrange(20)]])
            b = "".join(b)
            wide, E.WIDE = E.WIDE, 300
            try:
                got = E.matching_characters(a, b)
            finally:
                E.WIDE = wide
            assert got == sum(m.size for m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks())


def test_large_tables_are_compared_by_cells():
    rows = [[f"{i}", *(f"{i * j * 7919 % 10_007}" for j in range(1, 40))] for i in range(200)]
    pipe = lambda rs: "| " + " | ".join(map(str, range(40))) + " |\n|" + " --- |" * 40 + "\n" + "".join(B.join_row(r) + "\n" for r in rs)
    true = "标题\n" + pipe(rows)
    shifted = "标题\n" + pipe([[*r[:1], *r[2:], ""] if k == 0 else r for k, r in enumerate(rows)])
    assert len(E.normalized(true)) > E.CHARS and E.score_pair(true, true)[0] == 100.0
    assert 99 < E.score_pair(shifted, true)[0] < 100
    cut = E.aligned_text("标题\n" + pipe(rows[:100]), true)
    assert 40 < cut < 60 and E.aligned_text("prose", true) is None
    assert E._cell_pairs(["a", "b", "c"], ["a", "c"]) == [("a", "a"), ("c", "c"), ("b", "")]


def test_split_numbers_and_budget():
    assert B.repair_split_numbers("| 1 | 441 | .02 | 5677. |  | 84 |") == "| 1 | 441.02 | 5677.84 |  |  |  |"
    assert B.repair_split_numbers("| --- | --- |") == "| --- | --- |"
    table = "| a |\n| --- |\n" + "".join(f"| {i} |\n" for i in range(20))
    cut = B.retain_rows("intro\n" + table + "tail", 60)
    assert cut.startswith("intro\n| a |") and len(cut.encode()) <= 60 and "tail" not in cut
    with pytest.raises(ValueError):
        B.retain_rows(table, 10)
    assert B.strip_fence("```md\nx\n```") == "x\n"
    with pytest.raises(ValueError):
        B.strip_fence("```md\nx")


def test_merge_lines(spark):
    rows = spark.createDataFrame([("p", 1, "\na\nb\nc\n"), ("p", 2, "b\nc\nd"), ("p", 3, "  "), ("p", 4, "d\nd"), ("q", 1, None)], "page string, ord int, part string")
    assert [tuple(r) for r in M.merge_parts(rows, "page", "ord", "part").collect()] == [("p", "a\nb\nc\nd\nd\n")]


def test_rebuild(spark):
    t = lambda h, *rows: "\n".join([B.join_row(h), B.join_row(["---"] * len(h)), *map(B.join_row, rows)])
    tiles = [(1, 1, t(["A"], ["1"], ["2"])), (1, 2, t(["B"], ["x"])), (2, 1, t(["A"], ["3"])), (2, 2, t(["B"], ["y"]))]
    assert M.rebuild(tiles) == "| A | B |\n| --- | --- |\n| 1 | x |\n| 2 |  |\n| 3 | y |\n"
    assert M.rebuild([(1, 1, "prose")]) is None and M.rebuild([]) is None
    apart = M.rebuild([(1, 1, t(["K", "v"], ["19", "a"], ["20", "b"])), (2, 1, t(["80", "c"], ["81", "d"]))])
    assert apart.count("---") == 4  # two tables
    joined = M.join_bands([B.Grid(("K", "v"), (("19", "a"), ("20", "b"))), B.Grid(("K", "v"), (("21", "c"),))])
    assert len(joined) == 1 and len(joined[0].rows) == 3
    df = spark.createDataFrame([("p", r, c, x) for r, c, x in tiles] + [("q", 1, 1, None)], "page string, row int, col int, text string")
    assert dict(map(tuple, M.rebuild_pages(df, "page").collect()))["q"] is None


def test_coalesce_by_sequence():
    before = B.Grid(("k", "a", "b"), (("1", "x", ""), ("3", "", "z")))
    local = B.Grid(("k", "a", "b"), (("1", "p", "q"), ("2", "r", "s"), ("3", "t", "u")))
    assert M.coalesce_by_sequence(before, local).rows == (("1", "x", "q"), ("2", "r", "s"), ("3", "t", "z"))
    assert M.coalesce_by_sequence(B.Grid(("k",), (("9",),)), local) is None


def boxes(rows, cols, skip=()):
    out = [L.Box(100, 100, 30, 10, 1, "age")] + [L.Box(200 + 100 * c, 100, 30, 10, 1, str(10 + c)) for c in range(cols)]
    for r in range(rows):
        out.append(L.Box(100, 200 + 50 * r, 30, 10, 1, str(20 + r)))
        out += [L.Box(200 + 100 * c, 200 + 50 * r, 30, 10, 1, f"{r}{c}.5") for c in range(cols) if (r, c) not in skip]
    return out


def test_matrix(spark):
    g = L.semantic_matrix(boxes(6, 5, skip={(2, 2)}))
    assert g.header == ("age", "10", "11", "12", "13", "14") and len(g.rows) == 6
    assert g.rows[2] == ("22", "20.5", "21.5", "", "23.5", "24.5")
    assert L.semantic_matrix([]) is None and L.semantic_matrix(boxes(2, 3)) is None
    rows = [("p", *map(float, (b.x, b.y, b.width, b.height, b.confidence)), b.text) for b in boxes(6, 5) * 2] + [("p", 1.0, None, 1.0, 1.0, 1.0, "n"), ("q", 1.0, 1.0, 1.0, 1.0, 1.0, "x")]
    df = spark.createDataFrame(rows, "page string, x double, y double, width double, height double, confidence double, text string")
    got = dict(map(tuple, L.matrices(df, "page").collect()))
    assert got["q"] is None and got["p"].count("\n") == 7


def test_fragments_and_walk():
    cut = [b for i in range(400) for b in (L.Box(100, 20 * i, 20, 10, 1, "12"), L.Box(122, 20 * i, 20, 10, 1, ".34"))]
    assert [b.text for b in L.merge_fragments(cut)] == ["12.34"] * 400
    drift = [(i * 10.1, 5) for i in range(500)]
    assert len(L.walk(drift, 10.0)) == 500
    assert L.monotonic_keys([5, 6, None, 9, 9]) == ([5, 6, 7, 8, 9], 3)
    assert L.monotonic_keys([]) is None and L.monotonic_keys([None] * 122) is None and L.monotonic_keys(list(range(200))) is None
    assert L.monotonic_keys(list(range(121))) == (list(range(121)), 121)
    assert L.monotonic_keys([None] * 121)[0] == list(range(121)) and L.monotonic_keys([7, 10**9, -5]) == ([7, 8, 9], 1)


def test_reading_order():
    line = lambda y, *xs: [L.Box(x, y, 40, 10, 0.9, t) for x, t in xs]
    seen = line(100, (100, "a"), (150, "b")) + line(112, (100, "c")) + line(200, (100, "d")) + [L.Box(100, 100, 40, 10, 0.5, "a"), L.Box(300, 100, 5, 5, 0.1, "faint")]
    assert L.in_reading_order(seen) == "ab\nc\n\nd\n"
    assert L.in_reading_order([]) == ""


def test_scores(spark):
    assert E.similarity("", "") == 100.0 and E.similarity("a", "") == 0.0
    assert E.similarity("abcd", "abxd") == pytest.approx(75.0)
    long = "word " * 6_000
    assert E.similarity(long, long + "x") > 90
    a = spark.createDataFrame([("p", "# A\n"), ("u", "x"), ("n", None)], "file_name string, text string")
    b = spark.createDataFrame([("p", "# A\n"), ("m", "x"), ("n", "x")], "file_name string, text string")
    got = {r["file_name"]: r["overall"] for r in E.evaluate(a, b).collect()}
    assert got["p"] == 100.0 and set(got) == {"p", "n"}
    s = E.summary(E.evaluate(a, b)).first()
    assert s["n_pairs"] == 2 and E.summary(E.evaluate(a.limit(0), b)).first()["mean_overall"] == 0.0
    assert "pairs: 2" in E.report(E.evaluate(a, b))


def test_families_and_split(spark):
    assert X.family_key("# Rate 2024\n<table>") == X.family_key("#  Rate 2023 \n<table>") == "Rate#"
    assert X.family_key("") == ""
    sizes = {"f1": 4, "f2": 2, "f3": 2, "f4": 1, "f5": 1}
    rows = [("r", f"{f}-{i}", f, 1, 10 * i, i) for f, n in sizes.items() for i in range(n)] + [("r", "alone", None, None, None, None)]
    df = spark.createDataFrame(rows, "run_id string, file_name string, family string, gt_tables int, gt_length int, pixels int")
    got = X.grouped_split(df, {"a": 0.2, "b": 0.2, "c": 0.6}).collect()
    assert len(got) == 11
    by = {}
    for r in got:
        by.setdefault(r["family"], set()).add(r["split"])
    assert all(len(v) == 1 for v in by.values())


def test_many_small_families_follow_by_weight(spark):
    rows = [("r", f"f{i}", None if i % 3 == 0 else f"k{i // 2}", i % 4, i, 7 * i) for i in range(3_000)] + [("r", f"h{i}", "hub", 1, i, i) for i in range(1_500)] + [("q", "x", "hub", 1, 1, 1)]
    df = spark.createDataFrame(rows, "run_id string, file_name string, family string, gt_tables int, gt_length int, pixels int")
    got = X.grouped_split(df, {"a": 0.2, "b": 0.2, "c": 0.6}).where("run_id = 'r'").collect()
    by, size = {}, {}
    for r in got:
        by.setdefault(r["family"] or r["file_name"], set()).add(r["split"])
        size[r["split"]] = size.get(r["split"], 0) + 1
    assert len(got) == 4_500 and all(len(v) == 1 for v in by.values()) and by["hub"] == {"c"}
    assert all(abs(size[k] / 4_500 - v) < 0.02 for k, v in {"a": 0.2, "b": 0.2, "c": 0.6}.items())
    assert X.grouped_split(df.limit(0), {"a": 1.0}).count() == 0
