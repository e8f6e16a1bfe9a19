"""Whole runs over small trees of pages."""

import pytest
from pyspark.sql import functions as F

from gridloom.plans import cli, runs
from gridloom.plans.presets import settings
from gridloom.sources import archives, results
from tests.test_sources import png


def reader(rows_a_tile=2, broken=()):
    """A recogniser that gives numbered rows by where the tile lies; made here so that workers get it by value."""

    class Rows:
        def read(self, tile):
            if tile["file_name"] in broken:
                raise RuntimeError("no answer")
            first = 1 + (tile["row"] - 1) * rows_a_tile
            return "| k | v |\n| --- | --- |\n" + "".join(f"| {i} | {i * 11} |\n" for i in range(first, first + rows_a_tile))

    return Rows()


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([("a.png", "/a.png", 700, 1_300), ("long.png", "/l.png", 100, 3_000), ("b.png", "/b.png", 700, 1_300), ("none.png", "/n.png", None, None)], "file_name string, source string, page_w int, page_h int")


def test_tiles(pages):
    s = settings("v1", long_height=1_000, long_overlap=100, min_overlap=20)
    tiles = {}
    for r in runs.plan_tiles(pages, s).collect():
        tiles.setdefault(r["file_name"], []).append((r["row"], r["col"], r["x0"], r["x1"], r["y0"], r["y1"]))
    assert sorted(tiles["a.png"]) == [(1, 1, 0, 700, 0, 650), (2, 1, 0, 700, 618, 1_300)]
    assert sorted(tiles["long.png"]) == [(1, 1, 0, 100, 0, 1_000), (2, 1, 0, 100, 900, 1_900), (3, 1, 0, 100, 1_800, 2_800), (4, 1, 0, 100, 2_700, 3_000)]
    assert "none.png" not in tiles
    few = runs.plan_tiles(pages.where("file_name = 'a.png'"), settings("v1", tile_height=100, tile_width=100, call_budget=12)).collect()
    assert len(few) <= 12 and {r["rows"] * r["cols"] for r in few} == {len(few)}


def test_predict_reads_each_tile_once(spark, pages, tmp_path):
    s = settings("v1", min_chars=5, max_duplicate=0.9)
    template = spark.createDataFrame([("a.png",), ("b.png",), ("none.png",)], "file_name string")
    run = runs.predict(pages.where("file_name <> 'long.png'"), template, reader(broken=("b.png",)), s, f"{tmp_path}/cache")
    got = {r["file_name"]: r["text"] for r in run.results.collect()}
    assert got["a.png"] == "| k | v |\n| --- | --- |\n| 1 | 11 |\n| 2 | 22 |\n| 3 | 33 |\n| 4 | 44 |\n" and got["b.png"] == got["none.png"] == s.placeholder
    errors = [tuple(r) for r in run.errors.select("file_name", "error").collect()]
    assert errors.count(("b.png", "RuntimeError: no answer")) == 2 and ("none.png", "the page has no size") in errors
    assert spark.read.parquet(f"{tmp_path}/cache").count() == 2
    again = runs.predict(pages.where("file_name = 'a.png'"), template, reader(broken=("a.png",)), s, f"{tmp_path}/cache")
    assert again.errors.count() == 0 and {r["file_name"]: r["text"] for r in again.results.collect()}["a.png"] == got["a.png"]
    other = runs.predict(pages.where("file_name = 'a.png'"), template, reader(broken=("a.png",)), settings("v1", tile_height=400), f"{tmp_path}/cache")
    assert other.errors.count() > 0  # tiles of another shape are not in the cache


def test_repairs_and_matrices(spark, pages):
    template = spark.createDataFrame([("a.png",), ("b.png",)], "file_name string")
    s = settings("v1", min_chars=400, max_duplicate=0.9)
    run = runs.baseline(pages.where("file_name <> 'none.png'"), template, reader(15), s)
    text = {r["file_name"]: r["text"] for r in run.results.collect()}["a.png"]
    assert "| 60 | 660 |" in text  # the halves of tiles hold twice the rows
    box = lambda x, y, t: (x, y, 30.0, 10.0, 1.0, t)
    laid = [box(100.0, 100.0, "年龄")] + [box(200.0 + 100 * c, 100.0, str(10 + c)) for c in range(4)] + [box(100.0, 200.0 + 50 * r, str(20 + r)) for r in range(6)]
    laid += [box(200.0 + 100 * c, 200.0 + 50 * r, str(1000 + 17 * r * r + 31 * c * (r + 1))) for c in range(4) for r in range(6)]
    boxes = spark.createDataFrame([("a.png", *b) for b in laid], "file_name string, x double, y double, width double, height double, confidence double, text string")
    thin = spark.createDataFrame([("a.png", "short", "issue"), ("b.png", "short", "issue")], "file_name string, text string, issue string")
    rebuilt = {r["file_name"]: (r["text"], r["issue"]) for r in runs.rebuilt_matrices(thin, boxes, pages, settings("v4", local_min_pixels=1, local_max_pixels=0)).collect()}
    assert rebuilt["b.png"] == ("short", "issue") and rebuilt["a.png"][1] is None and rebuilt["a.png"][0].count("\n") >= 7


def test_remerged(spark):
    part = lambda a, b: "| k | v |\n| --- | --- |\n" + "".join(f"| {i} | {i * 7} |\n" for i in range(a, b))
    base = spark.createDataFrame([("a.jpg", part(1, 4) + "\n" + part(4, 7), 1), ("b.jpg", "prose", 2), ("c.jpg", None, 3)], "file_name string, text string, ord int")
    tiles = spark.createDataFrame([("a", 1, 1, part(1, 5)), ("a", 2, 1, part(4, 8)), ("b", 1, 1, part(1, 3))], "stem string, row int, col int, text string")
    got = {r["file_name"]: (r["text"], r["changed"]) for r in runs.remerged(base, tiles).collect()}
    assert got["a.jpg"] == (part(1, 8), True) and got["b.jpg"] == ("prose", False) and got["c.jpg"] == (None, False)
    assert runs.remerged(base, tiles.limit(0)).where("changed").count() == 0


def test_experiment_and_commands(spark, tmp_path):
    raw = tmp_path / "raw" / "set"
    raw.mkdir(parents=True)
    for i in range(6):
        (raw / f"p{i}.png").write_bytes(png(60, 50, {(3, 3)}))
        (raw / f"p{i}.md").write_text(f"# 标题{chr(65 + i // 2)}\n| k | v |\n| --- | --- |\n| 1 | 11 |\n| 2 | 22 |\n")
    pages = runs.sized_pages(archives.page_images(spark, str(tmp_path / "raw")))
    labels = archives.directory_markdown(spark, str(tmp_path / "raw")).select(F.regexp_replace("file_name", r"\.jpg$", ".png").alias("file_name"), "text")
    scores = runs.train_experiment(pages, labels, reader(), settings("v1", min_chars=5, max_duplicate=0.9), {"dev": 0.34, "test": 0.66})
    rows = scores.collect()
    assert len(rows) == 6 and all(r["structure"] == 100.0 and r["text"] > 60 for r in rows)
    by = {r["split"]: r["n_pairs"] for r in runs.scores_by_split(scores).collect()}
    assert by[None] == 6 and set(by) == {None, "dev", "test"}
    results.write_results(spark.createDataFrame([(0, "p1.png", ""), (1, "p0.png", "")], "ord int, file_name string, text string"), f"{tmp_path}/template")
    do = lambda *a: cli.run(spark, cli.parser().parse_args(list(a)))
    report, code = do("predict", str(tmp_path / "raw"), f"{tmp_path}/template", f"{tmp_path}/out", "--recogniser", "gridloom.plans.pipeline:Replay", "--errors", f"{tmp_path}/errors")
    assert code == 0 and report["rows"] == 2 and report["errors"] >= 6
    assert [(r["file_name"], r["text"]) for r in results.read_results(spark, f"{tmp_path}/out").orderBy("ord").collect()] == [("p1.png", "<table></table>"), ("p0.png", "<table></table>")]
    (tmp_path / "tiles").mkdir()
    (tmp_path / "tiles" / "p0_content_r001_c001.md").write_text("x")
    assert do("remerge", f"{tmp_path}/out", f"{tmp_path}/tiles", f"{tmp_path}/re") == ({"rows": 2, "changed": 0}, 0)
