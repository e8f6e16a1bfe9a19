import struct
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from gridloom.functions import pixels
from gridloom.plans import cli
from gridloom.plans.pipeline import Replay, call_with_retries, namespace, page_budgets, page_texts, submission, with_cache
from gridloom.plans.presets import PRESETS, settings
from gridloom.sources import archives, boxes, results


def png(width, height, dark=()):
    rows = b"".join(b"\0" + bytes(0 if (x, y) in dark else 255 for x in range(width)) for y in range(height))
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def test_zip_and_directories(spark, tmp_path):
    for name, members in (("a.zip", {"set/images/p1.jpg": b"1", "set/images/._p9.jpg": b"", "__MACOSX/p8.jpg": b"", "set/mds/p1.md": "# ä".encode()}), ("b.zip", {"set/images/p1.jpg": b"2", "set/images/p2.PNG": b"3"})):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            for member, data in members.items():
                z.writestr(member, data)
    pages = {r["file_name"]: bytes(r["content"]) for r in archives.zip_images(spark, f"{tmp_path}/*.zip").collect()}
    assert pages == {"p1.jpg": b"1", "p2.PNG": b"3"}
    assert [tuple(r)[:2] for r in archives.zip_markdown(spark, f"{tmp_path}/*.zip").select("file_name", "text").collect()] == [("p1.jpg", "# ä")]
    assert archives.zip_images(spark, f"{tmp_path}/*.zip", prefixes=("other/",)).count() == 0
    assert archives.inspect(spark, str(tmp_path)) == {"images": 2, "labels": 1, "unlabelled": 1}
    out = tmp_path / "out"
    assert len(archives.extract(f"{tmp_path}/*.zip", str(out))) == 4
    assert {r["file_name"] for r in archives.directory_images(spark, str(out)).collect()} == {"p1.jpg", "p2.PNG"}
    with zipfile.ZipFile(tmp_path / "evil.zip", "w") as z:
        z.writestr("../evil.jpg", b"")
    with pytest.raises(ValueError):
        archives.extract(f"{tmp_path}/evil.zip", str(out))


def test_result_csv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(0, "b.jpg", 'a "quoted", text\nwith lines\n'), (1, "a.jpg", ""), (2, "c.jpg", " x \\ " + "y" * 200_000)], "ord int, file_name string, text string")
    results.write_results(rows, f"{tmp_path}/r")
    back = {r["file_name"]: r["text"] for r in results.read_results(spark, f"{tmp_path}/r").collect()}
    assert back == {r["file_name"]: r["text"] for r in rows.collect()}
    (tmp_path / "bad.csv").write_text("name,text\na,b\n")
    with pytest.raises(ValueError):
        results.read_results(spark, f"{tmp_path}/bad.csv")
    (tmp_path / "twice.csv").write_text("file_name,ground_truth\na.jpg,1\na.jpg,2\n")
    assert [r["text"] for r in results.read_results(spark, f"{tmp_path}/twice.csv").collect()] == ["2"]
    with pytest.raises(Exception, match="more than one row"):
        results.read_results(spark, f"{tmp_path}/twice.csv", "error").collect()


def test_boxes_and_payloads(spark):
    df = spark.createDataFrame([("t", 100, 300, 200, 400, 100, 100, "25\t50\t10\t20\t0.95\t123\nbad\tline\n1\t2\t3\tx\t5\t6")], "id string, x0 int, x1 int, y0 int, y1 int, width int, height int, tsv string")
    assert [tuple(r)[1:] for r in boxes.tile_boxes(df, "id").collect()] == [(150.0, 300.0, 20.0, 40.0, 0.95, "123")]
    corner = df.withColumn("tsv", F.lit("0\t0\t0.5\t0.5\t1\tq"))
    assert [tuple(r)[1:] for r in boxes.corner_boxes(corner, "id").collect()] == [(150.0, 350.0, 100.0, 100.0, 1.0, "q")]
    assert boxes.payload_text("plain ```") == "plain ```"
    nested = '{"success": true, "result": "{\\"choices\\": [{\\"message\\": {\\"content\\": \\"```md\\\\nx\\\\n```\\"}}]}"}'
    assert boxes.payload_text(nested) == "x\n"
    for bad in ('{"success": false}', '{"code": 7}', '{"content": "```md\\nx"}'):
        with pytest.raises(ValueError):
            boxes.payload_text(bad)
    quad = spark.createDataFrame([([[0.0, 0.0], [4.0, 0.0], [4.0, 2.0], [0.0, 2.0]],)], "q array<array<double>>").select(boxes.quad_to_box(F.col("q")).alias("b")).first()["b"]
    assert tuple(quad) == (2.0, 1.0, 4.0, 2.0)
    files = spark.createDataFrame([("/c/p_content_r001_c002.md", bytearray(b"x")), ("/d/p_content_r001_c001.md", bytearray(b"y")), ("/d/p_content_r001_c002.md", bytearray(b"z")), ("/d/other.md", bytearray(b""))], "path string, content binary")
    assert sorted(tuple(r) for r in boxes.cached_tiles(files).collect()) == [("p", 1, 1, "y"), ("p", 1, 2, "z")]


def test_pixels(spark, tmp_path):
    (tmp_path / "p.png").write_bytes(png(40, 20, {(x, y) for x in range(10, 20) for y in range(5, 8)}))
    row = pixels.profiles(spark.read.format("image").load(str(tmp_path))).first()
    assert (row["width"], row["height"], row["box"], row["content_pixels"]) == (40, 20, [10, 5, 20, 8], 30)
    raw = spark.read.format("binaryFile").load(str(tmp_path)).select(pixels.image_size("content").alias("s")).first()["s"]
    assert tuple(raw) == (40, 20)
    assert pixels.snap_edges([0, 50, 100], __import__("numpy").eye(1, 101, 53)[0] * 9, 5) == [0, 53, 100]


def test_pipeline(spark):
    s = settings("v6", success_share=0.5)
    tiles = spark.createDataFrame(
        [("1", "p.jpg", 1, 1, 900, 900, "| A |\n| --- |\n| 1 |"), ("2", "p.jpg", 2, 1, 900, 900, "| A |\n| --- |\n| 2 |"), ("3", "q.jpg", 1, 1, 900, 900, None)],
        "tile_id string, file_name string, row int, col int, page_w int, page_h int, stored string",
    )
    cache = spark.createDataFrame([("1", "| A |\n| --- |\n| 1 |")], "tile_id string, text string")
    texts, fresh = with_cache(tiles, cache, Replay(), s)
    assert {r["tile_id"]: r["error"] is None for r in texts.collect()} == {"1": True, "2": True, "3": False}
    assert [r["tile_id"] for r in fresh.collect()] == ["2"]
    assert {r["file_name"]: r["usable"] for r in page_budgets(tiles.join(texts, "tile_id"), s).collect()} == {"p.jpg": True, "q.jpg": False}
    pages = page_texts(tiles, texts, s)
    out = {r["file_name"]: r["text"] for r in submission(spark.createDataFrame([("p.jpg",), ("q.jpg",)], "file_name string"), pages, s).collect()}
    assert out == {"p.jpg": "| A |\n| --- |\n| 1 |\n| 2 |\n", "q.jpg": "<table></table>"}


def test_retries_and_presets():
    calls = []

    def flaky(tile):
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("HTTP 429")
        return "ok"

    assert call_with_retries(flaky, {}, 2) == "ok" and len(calls) == 3
    with pytest.raises(RuntimeError):
        call_with_retries(lambda t: (_ for _ in ()).throw(RuntimeError("x")), {}, 1)
    assert len(PRESETS) == 8 and settings("v8").local_max_pixels == 400_000_000
    with pytest.raises(ValueError):
        settings("v9")
    with pytest.raises(ValueError):
        settings("v1", on_error="what")
    assert namespace(settings("v1")) != namespace(settings("v4")) and namespace(settings("v1"), "retries") == namespace(settings("v2"), "retries")


def test_commands(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), "ord int, file_name string, text string")
    results.write_results(rows((0, "a.jpg", "short"), (1, "b.jpg", "kept as it is")), f"{tmp_path}/base")
    results.write_results(rows((0, "a.jpg", "a much longer text than before")), f"{tmp_path}/over")
    do = lambda *a: cli.run(spark, cli.parser().parse_args(list(a)))
    assert do("overlay", f"{tmp_path}/base", f"{tmp_path}/over", f"{tmp_path}/out", "--min-gain", "1") == ({"rows": 2, "accepted": 1}, 0)
    report, code = do("validate", f"{tmp_path}/out", f"{tmp_path}/base")
    assert code == 0 and report["n_rows"] == 2
    assert do("validate", f"{tmp_path}/over", f"{tmp_path}/base")[1] == 1
    assert do("ensemble", f"{tmp_path}/base", f"{tmp_path}/over", f"{tmp_path}/e")[1] == 1
    assert do("compact", f"{tmp_path}/base", f"{tmp_path}/c") == ({"rows": 2, "over_budget": 0}, 0)
    (tmp_path / "labels").mkdir()
    (tmp_path / "labels/a.md").write_text("short")
    summary, _ = do("evaluate", f"{tmp_path}/base", f"{tmp_path}/labels", "--scores", f"{tmp_path}/scores")
    assert summary["n_pairs"] == 1 and summary["mean_overall"] == 100.0


def test_streaming(spark, tmp_path):
    from gridloom.streaming.results import deduplicated, gate_counts, resume_into

    rows = spark.createDataFrame([(1, "a" * 40), (2, "b"), (2, "b"), (3, "c" * 40)], "row_id long, ground_truth string").withColumn("loaded_at", F.lit("2026-01-01 10:00:00").cast("timestamp"))
    rows.write.parquet(f"{tmp_path}/in")
    read = lambda: spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    for _ in range(2):
        q = resume_into(read(), f"{tmp_path}/out", f"{tmp_path}/ck{_}")
        q.awaitTermination()
    assert sorted(r["row_id"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2, 3]
    q = deduplicated(read()).writeStream.format("memory").queryName("once").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("once").count() == 3
    q = gate_counts(read()).writeStream.format("memory").outputMode("complete").queryName("gates").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [(r["n_rows"], r["n_failed"]) for r in spark.table("gates").collect()] == [(4, 2)]
