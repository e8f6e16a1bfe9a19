import random

from pyspark.sql import functions as F

from gridloom.operators import geometry as G
from gridloom.operators import sequences as S


def reference_clusters(values, tolerance):
    groups = []
    for v in sorted(values):
        if groups and v - sum(groups[-1]) / len(groups[-1]) <= tolerance:
            groups[-1].append(v)
        else:
            groups.append([v])
    return [(round(sum(g) / len(g), 6), len(g)) for g in groups]


def test_running_mean_clusters(spark):
    rng = random.Random(3)
    values = {k: [float(rng.randrange(0, 300)) for _ in range(80)] for k in range(5)}
    rows = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs] + [(None, 1.0), (1, None)], "k int, v double")
    got = {}
    for r in S.cluster_axis(rows, "k", "v", 4.0).orderBy("k", "cluster").collect():
        got.setdefault(r["k"], []).append((round(r["center"], 6), r["n"]))
    assert got == {k: reference_clusters(vs, 4.0) for k, vs in values.items()}
    assert S.cluster_axis(rows.limit(0), "k", "v", 4.0).count() == 0


def test_assignment(spark):
    rows = spark.createDataFrame([(1, 14.0), (1, 15.0), (1, 60.0), (1, 900.0)], "k int, v double")
    centers = spark.createDataFrame([(1, 1, 10.0), (1, 2, 20.0), (1, 3, 70.0)], "k int, cluster int, center double")
    assert sorted((r["v"], r["place"]) for r in S.assign_to_centers(rows, centers, "k", "v").collect()) == [(14.0, 1), (15.0, 1), (60.0, 3)]


def test_sequence_repairs(spark):
    rows = spark.createDataFrame([("a", i, v) for i, v in enumerate([5, 6, 7, 9, 9, 40])], "k string, i int, v int")
    best = S.offset_mode(rows, "k", "i", "v").first()
    assert (best["start"], best["inliers"], best["n"]) == (4, 4, 6)
    ints = spark.createDataFrame([("a", v) for v in [*range(1, 12), 20, 21]], "k string, v int")
    gap = S.largest_gap(ints, "k", "v").first()
    assert (gap["n_keys"], gap["gap"]) == (13, 8)
    assert sorted(map(tuple, S.consecutive_runs(ints, "k", "v").select("first", "last", "n").collect())) == [(1, 11, 11), (20, 21, 2)]
    filled = S.nearest_fill(spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("a", 4, None), ("a", 6, "y"), ("b", 1, None)], "k string, i int, v string"), "k", "i", "v")
    assert sorted(map(tuple, filled.select("k", "i", "v").collect()), key=str) == sorted([("a", 1, "x"), ("a", 2, "x"), ("a", 4, "x"), ("a", 6, "y"), ("b", 1, None)], key=str)
    seq = spark.createDataFrame([(["a", "b", "a", "c", "a"],), ([],)], "v array<string>").select(S.repair_by_neighbours(F.col("v")).alias("r"))
    assert [r["r"] for r in seq.collect()] == [["a", "a", "a", "a", "a"], []]


def test_buckets_and_dominance(spark):
    rows = spark.createDataFrame([("r", i, v) for i, v in enumerate([1, 1, 1, 1, 5, 6, 7, 8])] + [("r", 99, None)], "run string, i int, v int")
    got = {r["i"]: r["bucket"] for r in S.quantile_bucket(rows, "v", 4, "run").collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 2, 5: 2, 6: 3, 7: 3, 99: None}
    d = spark.createDataFrame([("k", x) for x in "aaaaaaaabb"] + [("k", None)], "k string, v string")
    assert tuple(S.dominant_value(d, "k", "v").first()) == ("k", "a", 8, 10)
    assert S.fill_dominant(d, "k", "v").where("v is null").count() == 0
    t = spark.createDataFrame([("k", i, w) for i, w in enumerate([9, 7, 5, 3, 9, 7])], "k string, i int, w int")
    assert [r["group"] for r in S.triangular_resets(t, "k", "i", "w").orderBy("i").collect()] == [1, 1, 1, 1, 2, 2]
    c = spark.createDataFrame([([0.0, 10.0, 20.0, 50.0, 60.0],)], "c array<double>").select(S.central_gaps(F.col("c")).alias("g")).first()["g"]
    assert c == [10.0, 10.0, 10.0]


def test_grid(spark):
    pages = spark.createDataFrame([("p", 300, 220), ("q", 0, 5), ("n", None, 5)], "f string, w int, h int")
    tiles = G.grid_tiles(pages, "f", "w", "h", 120, 100, 20, 10).orderBy("row", "col").collect()
    assert len(tiles) == 9 and (tiles[1]["x0"], tiles[1]["x1"]) == (100, 220)
    assert tuple(tiles[-1])[1:] == (3, 3, 3, 3, 200, 300, 180, 220)
    edges = pages.where("f = 'p'").select(G.even_edges(F.lit(0), F.lit(5), F.lit(2)).alias("e")).first()["e"]
    assert edges == [0, 2, 5]
    fit = spark.createDataFrame([(8, 6), (2, 3)], "r int, c int").select(G.fit_to_budget(F.col("r"), F.col("c"), 24).alias("f")).collect()
    assert tuple(fit[1]["f"]) == (2, 3) and fit[0]["f"]["r"] * fit[0]["f"]["c"] <= 24
    crops = G.anchor_crops(pages, "f", "w", "h", sizes=(500,)).collect()
    assert [tuple(c)[1:] for c in crops] == [(1, 0, 300, 0, 220)]
    quarters = G.split_tile(spark.createDataFrame([("t", 0, 10, 0, 6)], "t string, x0 int, x1 int, y0 int, y1 int"), "t")
    assert quarters.count() == 4
    low = spark.createDataFrame([(5, 10, 0.001), (500, 10, 0.5), (None, None, None)], "t int, p int, r double").select(G.low_content(F.col("t"), F.col("p"), F.col("r"), 10, 100, 0.01).alias("l"))
    assert [r["l"] for r in low.collect()] == [True, False, False]
