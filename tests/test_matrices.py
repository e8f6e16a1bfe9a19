from gridloom.functions.tables import Grid
from gridloom.operators import lattice as L
from gridloom.operators import merge as M


def box(x, y, t):
    return L.Box(float(x), float(y), 30.0, 10.0, 1.0, str(t))


def test_triangular():
    seen = [box(100 + 60 * c, 100 + 30 * r, f"{r}.{c}1") for r in range(40) for c in range(40 - r)]
    g = L.triangular_grid(seen)
    assert g is not None and len(g.rows) == 39 and len(g.header) >= 37 and not g.explicit and g.rows[0][3] == "0.31"
    assert L.triangular_grid(seen[:200]) is None
    assert L.triangular_grid([box(100 + 60 * c, 100 + 30 * r, "1.5") for r in range(40) for c in range(20)]) is None  # full


def test_fixed():
    seen = [box(100 + 80 * c, 100 + 30 * r, ("10年" if c == 0 else "男" if c == 1 else 20 + r if c == 2 else f"{r}{c}.5")) for r in range(30) for c in range(9) if not (c == 0 and r % 5)]
    g = L.fixed_grid(seen)
    assert g is not None and len(g.rows) == 30 and all(r[0] == "10年" and r[1] == "男" for r in g.rows)
    assert L.fixed_grid(seen[:50]) is None


def test_sequential():
    seen = [box(100 + 90 * c, 100 + 30 * r, (r % 15 + 1 if c == 0 else f"v{r}{c}")) for r in range(45) for c in range(6) if (r, c) != (20, 0)]
    g = L.sequential_records(seen)
    assert g is not None and [r[0] for r in g.rows[18:23]] == ["4", "5", "6", "7", "8"]
    assert L.sequential_records([box(100 + 90 * c, 100 + 30 * r, "x") for r in range(45) for c in range(6)]) is None


def test_annual():
    seen = [box(100, 60, "性别"), box(180, 60, "年龄")] + [box(300 + 60 * c, 60, c + 1) for c in range(12)]
    for r in range(24):
        seen += [box(180, 120 + 30 * r, 20 + r)] + ([box(100, 120 + 30 * r, "男")] if r % 3 == 0 else [])
        seen += [box(300 + 60 * c, 120 + 30 * r, f"{r}{c}.5") for c in range(12 - r // 3)]
    g = L.annual_matrix(seen)
    assert g.header[:2] == ("性别", "年龄") and g.header[2:5] == ("1", "2", "3") and len(g.rows) == 24
    assert all(r[0] == "男" for r in g.rows) and [r[1] for r in g.rows[:3]] == ["20", "21", "22"]
    assert L.matrix(seen) == g and L.matrix(seen[:10]) is None


def test_small_repairs():
    rows = [["a"]] * 9 + [["ab"]] + [["q"]]
    rows = [list(r) for r in rows]
    L.repair_columns(rows, [0], share=0.8)
    assert rows[9] == ["a"] and rows[10] == ["q"]
    g = L.collapse_seam_column(Grid(("k", "1", "", "2"), (("a", "441", ".02", "x"), ("b", "7", ".5", "y"), ("c", "8", ".25", ""))))
    assert g.header == ("k", "1", "2") and g.rows[0] == ("a", "441.02", "x")
    assert L.impossible_axis(Grid(("年龄", "-1", "0"), ())) and not L.impossible_axis(Grid(("年龄", "0", "1"), ()))
    assert L.reset_groups([9, 7, 5, 3, 9, 7, 5, 3]) == [0] * 4 + [1] * 4


def test_merging_of_tables_and_blocks():
    t = lambda *r: "<table>" + "".join(f"<tr><td>{a}</td><td>{b}</td></tr>" for a, b in r) + "</table>"
    assert M.coalesce_adjacent("x\n" + t((1, "a"), (2, "b")) + "\n" + t((3, "c")) + "\ny").count("<table>") == 1
    assert M.coalesce_adjacent(t((1, "a")) + t((5, "c"))).count("<table>") == 2 and M.coalesce_adjacent("no table") == "no table"
    assert M.merge_blocks(["a\n\nb\n\nc", "b\n\nc\n\nd"]) == "a\n\nb\n\nc\n\nd\n" and M.merge_blocks([]) == ""
    old, new = "intro\n\n| a | b |\n| --- | --- |\n| 1 | 2 |\n\ntail", "| a | b |\n| --- | --- |\n| 1 | 3 |"
    assert M.keep_context(old, new) == "intro\n\n| a | b |\n| --- | --- |\n| 1 | 3 |\n\ntail"
    assert M.keep_context("prose", new) == new
    voted = M.thousands_by_vote(Grid(("x",), tuple(("1,234",) for _ in range(12)) + (("5.678",),)))
    assert voted.rows[-1] == ("5,678",)
    assert M.deepest_heading("# A\n## B\n<table>") == "B" and M.deepest_heading("## A\n## B\n| x |") is None
    base = "| A |\n| --- |\n| 1 |\n| 2 |\n"
    assert M.remerge(base, [(1, 1, "| A |\n| --- |\n| 1 |"), (2, 1, "| A |\n| --- |\n| 2 |")]) == base
    assert M.remerge(base, [(1, 1, "| A |\n| --- |\n| 1 |")]) is None


def test_labels_and_anchors():
    seen = [box(100, 100, "年"), box(104, 116, "龄"), box(400, 100, "其他")]
    assert [b.text for b in L.stacked_labels(seen)] == ["年", "龄"] and [b.text for b in L.stacked_labels([box(100, 100, "保单"), box(102, 116, "年度")])] == ["保单年度", "年度"]
    right = [box(100, 60, "age")] + [box(200 + 100 * c, 60, 10 + c) for c in range(6)]
    for r in range(8):
        right += [box(100, 120 + 30 * r, 20 + r)] + [L.Box(215 + 100 * c - w / 2, 120.0 + 30 * r, w, 10.0, 1.0, f"{r}{c}.5") for c in range(6) for w in [20.0 + 30.0 * ((r + c) % 2)]]
    assert L.anchored_matrix(right) is not None and L.anchored_matrix([]) is None
    assert L.saturated(1_000) and not L.saturated(3)


def test_cells_rows_and_routing(spark):
    from pyspark.sql import functions as F

    from gridloom.functions import tables as B
    from gridloom.functions import text as T
    from gridloom.operators import geometry as G
    from gridloom.plans import pipeline as P
    from gridloom.plans.presets import settings

    assert [B.merge_seam(*p) for p in (("", "x"), ("441", ".02"), ("12", "34"), ("long one", "b"))] == ["x", "441.02", "1234", "long one"]
    assert B.trimmed(Grid(("k", "v"), (("1", "a"), ("2", "b"), ("", ""), ))).rows == (("1", "a"), ("2", "b"))
    df = spark.createDataFrame([([1, 2, 3, 4], [2, 3]), ([1, 2], [2, 1]), ([1], []), ([1], [1, 2])], "a array<int>, b array<int>")
    assert [r["r"] for r in df.select(T.contains_run(F.col("a"), F.col("b")).alias("r")).collect()] == [True, False, True, False]
    e = spark.createDataFrame([("Read timed out",), ("output truncated",), ("HTTP 500",), (None,)], "m string").select(T.error_kind(F.col("m")).alias("k"))
    assert [r["k"] for r in e.collect()] == ["timeout", "truncated", "other", None]
    pages = spark.createDataFrame([("p", 10, 110, 0, 50), ("q", 5, 5, 0, 9)], "f string, bx0 int, bx1 int, by0 int, by1 int")
    tiles = G.content_grid(pages, "f", 1, 2, 5).orderBy("col").collect()
    assert [(t["x0"], t["x1"], t["y0"], t["y1"]) for t in tiles] == [(10, 65, 0, 50), (55, 110, 0, 50)]
    s = settings("v4")
    rows = spark.createDataFrame([("short", 4_000, 4_000, 100), ("x" * 5_000, 4_000, 4_000, 100), ("short", 10, 10, 100), (None, 4_000, 4_000, None)], "t string, w int, h int, c int")
    got = rows.select(P.wants_local_matrix(F.col("t"), F.col("w"), F.col("h"), F.col("c"), s).alias("m"), P.wants_repair(F.col("t"), F.col("c")).alias("r"), P.needed_tiles(F.col("w")).alias("n")).collect()
    assert [r["m"] for r in got] == [True, False, False, True] and [r["r"] for r in got] == [True, False, True, True] and got[2]["n"] == 8
    assert rows.select(G.refine_first(F.col("w"), F.col("h"), 800, 650, F.lit(0)).alias("x")).first()["x"] is True
