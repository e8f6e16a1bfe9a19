"""Grouped splits, cuts and overlaps against brute force."""

import random

import numpy as np
import pytest

from gridloom.llm import overlap, slicing, splits

FEATURES = "file_name string, run_id string, family string, author string, entity string, name string"


def brute_components(rows):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for f, run, *keys, _ in rows:
        if f is None or run is None:
            continue
        me = find((run, f))
        for kind, key in enumerate(keys):
            key = (key or "").strip().lower().replace("Ａ", "a").replace("ａ", "a")
            if key not in splits.PLACEHOLDERS:
                a, b = find(me), find((run, kind, key))
                root[a] = b
    groups = {}
    for f, run, *_ in rows:
        if f is not None and run is not None:
            groups.setdefault(find((run, f)), set()).add((run, f))
    return sorted(map(sorted, groups.values()))


@pytest.fixture(scope="module")
def features(spark):
    rng = random.Random(4)
    pick = lambda n: rng.choice([f"A{rng.randrange(n)}", f" a{rng.randrange(n)} ", f"Ａ{rng.randrange(n)}", None, "", "-", "N/A", "unknown", "未知"])
    rows = [(f"f{i}.jpg", f"r{i % 3}", pick(90), pick(90), pick(90), "x") for i in range(150)]
    rows += [(f"h{i}.jpg", "r9", "hot", None, None, "x") for i in range(60)] + [(f"c{i}.jpg", "r8", f"k{i}", f"k{i + 1}", None, "x") for i in range(12)]
    rows += [("c11.jpg", "r8", None, "link", None, "x"), ("z.jpg", "r8", None, "link", None, "x"), (None, "r1", "A1", None, None, "x"), ("n.jpg", None, "A1", None, None, "x"), rows[0], rows[0]]
    return rows, spark.createDataFrame(rows, FEATURES)


def test_components(features):
    rows, df = features
    got = {}
    for r in splits.components(df).collect():
        got.setdefault(r["root"], set()).add((r["run_id"], r["file_name"]))
    assert sorted(map(sorted, got.values())) == brute_components(rows)
    assert splits.components(df.limit(0)).count() == 0


def test_torn_groups_and_new_splits(spark, features):
    rows, df = features
    listed = spark.createDataFrame([("r9", "train", ["h1.jpg", "h2.jpg", "h2.jpg", "nobody.jpg"]), ("r9", "TEST ", ["h3.jpg"]), ("r9", "all", ["h1.jpg"]), ("r8", "train", ["z.jpg"]), ("r8", "validation", None), (None, "test", ["z.jpg"])], "run_id string, name string, file_names array<string>")
    assert [tuple(r) for r in splits.torn_groups(df, listed).collect()] == [("r9", "h0.jpg")]
    assert splits.torn_groups(df, listed.limit(0)).count() == 0 and splits.torn_groups(df.limit(0), listed).count() == 0
    targets = spark.createDataFrame([("train", 0.6), ("validation", 0.2), ("test", 0.2)], "name string, share double")
    new = splits.regrouped_splits(df, targets).collect()
    at = {(r["run_id"], r["file_name"]): r["name"] for r in new}
    groups = brute_components(rows)
    assert len(new) == len(at) == sum(map(len, groups)) and all(len({at[m] for m in g}) == 1 for g in groups)
    big = [(f"b{i}.jpg", "big", f"A{i // 2}", None, None, "x") for i in range(1000)]
    share = splits.regrouped_splits(spark.createDataFrame(big, FEATURES), targets).groupBy("name").count().collect()
    assert {r["name"]: round(r["count"] / 1000, 1) for r in share} == {"train": 0.6, "validation": 0.2, "test": 0.2}


def brute_clean(y0, y1, limit, over, blocked):
    bad = {c for a, b in blocked for c in range(a, b + 1)}
    reach = {y0}
    for c in range(y0 + 1, y1 + 1):
        if (c == y1 or c not in bad) and any(p < c and c - (p if p == y0 else max(y0, p - over)) <= limit for p in reach):
            reach.add(c)
    return y1 in reach


def test_plan_equals_brute_force():
    rng = random.Random(6)
    for _ in range(400):
        y0 = rng.randrange(50)
        limit, over = rng.randrange(8, 40), rng.randrange(0, 7)
        y1 = y0 + limit + rng.randrange(1, 120)
        blocked = [(a, a + rng.randrange(0, 14)) for a in (rng.randrange(y0, y1) for _ in range(rng.randrange(12)))]
        how, cuts = slicing.plan(y0, y1, limit, over, blocked)
        assert (how == "clean") == brute_clean(y0, y1, limit, over, blocked)
        starts = [y0, *(max(y0, c - over) for c in cuts)]
        assert all(0 < e - s <= limit for s, e in zip(starts, [*cuts, y1])) and cuts == sorted(set(cuts))
        bad = {c for a, b in blocked for c in range(a, b + 1)}
        if how == "clean":
            assert not bad & set(cuts)
        for at, start, c in zip([y0, *cuts], starts, cuts):  # a cut through boxes only where no free pixel is in reach
            assert c not in bad or all(p in bad for p in range(at + 1, min(start + limit, y1 - 1) + 1))


def test_cuts_are_balanced():
    """Equal lengths in the least number of pieces without boxes, the widest gap nearby with them, few boxes where none is free."""
    for y1, limit, over in [(1_000, 400, 0), (1_000, 400, 50), (5_003, 700, 90), (900, 400, 200)]:
        how, cuts = slicing.plan(0, y1, limit, over, [])
        sizes = [e - s for s, e in zip([0, *(max(0, c - over) for c in cuts)], [*cuts, y1])]
        assert how == "clean" and max(sizes) - min(sizes) <= 2 and len(sizes) == max(2, -(-(y1 - over) // (limit - over)))
    lines = [(k * 20 + 4, k * 20 + 19) for k in range(50)]  # gaps of four pixels between lines
    apart = [b for b in lines if not 480 <= b[0] <= 540]  # and one wide gap
    assert slicing.plan(0, 1_000, 600, 0, apart) == ("clean", [510])
    how, cuts = slicing.plan(0, 1_000, 600, 0, [(0, 1_000), (0, 540), (560, 1_000)])
    assert how == "forced" and 541 <= cuts[0] <= 559


def test_slices(spark):
    slices = spark.createDataFrame(
        [(1, "Long ", 0, 100, None, "x"), (1, "Long ", 0, 100, None, "x"), (2, "long", None, 100, 100, "x"), (3, "long", 0, None, 100, "x"), (4, "long", None, None, 100, "x"), (5, "long", 0, 50, 90, "x"), (6, "odd", 0, 999, None, "x"), (7, None, 0, 999, None, "x"), (None, "long", 0, 50, None, "x")],
        "slice_id long, kind string, y0 int, y1 int, height int, confidence string",
    )
    boxes = [(1, 50.0, 99.0, 0.9), (2, 50.0, 99.0, 0.1), (2, None, 9.0, 0.9), (2, 5.0, None, 0.9), (3, 50.0, 10.0, None), (3, 50.0, 2.0, 0.3), (None, 1.0, 1.0, 1.0)] + [(3, 20.0, 4.0, 0.5)] * 300
    seen = spark.createDataFrame([(*b, 1) for b in boxes], "slice_id long, y double, height double, confidence double, kind int")
    specs = spark.createDataFrame([("LONG", 60, 5, 0.25), ("table", 30, 1, 0.25)], "kind string, max_height int, y_overlap int, min_confidence double")
    got = {r["slice_id"]: r["cut"] for r in slicing.cut_slices(slices, seen, specs).collect()}
    assert got == {1: "forced", 2: "clean", 3: "clean"}
    pieces = slicing.slice_pieces(slices, seen, specs).where("slice_id = 3").orderBy("piece").collect()
    assert pieces[0]["y0"] == 0 and pieces[-1]["y0"] + pieces[-1]["height"] == 100 and all(p["height"] <= 60 for p in pieces)
    assert slicing.cut_slices(slices.limit(0), seen, specs).count() == 0 and slicing.cut_slices(slices, seen.limit(0), specs).count() == 3


def test_overlaps_equal_brute_force(spark):
    rng = random.Random(9)
    say = lambda n: "".join(rng.choice("投保人应当核对编号并注明金额由双方各执一份理赔专员复查保险单自签收次日零时起本公司") for _ in range(n))
    base = [say(rng.randrange(60, 400)) for _ in range(30)]
    texts = {f"t{i}.jpg": t for i, t in enumerate(base)}
    for i, t in enumerate(base[:20]):
        edits = list(t)
        for _ in range(rng.randrange(0, len(t) // 14)):
            edits[rng.randrange(len(edits))] = rng.choice("甲乙丙")
        texts[f"e{i}.jpg"] = "<p>" + "".join(edits) + "</p>"
    texts |= {"s1.jpg": "短", "s2.jpg": "短。", "n.jpg": None, "b.jpg": " \n", "m.jpg": base[0] + " "}
    rows = [(i, f, "s" if i % 2 else None, t, "x") for i, (f, t) in enumerate(texts.items())]
    records = spark.createDataFrame(rows + rows[:3], "record_id long, file_name string, source string, read_text string, core string")
    train, test = [f for f in texts if f[0] in "tn"] + ["s1.jpg", "both.jpg", "t0.jpg"], [f for f in texts if f[0] in "ebm"] + ["s2.jpg", "t1.jpg", "nobody.jpg"]
    lists = spark.createDataFrame([("r", "train", train), ("r", "test", test[:12]), ("r", "validation", test[8:]), ("r", "all", list(texts)), ("q", "train", ["t1.jpg"]), ("q", "test", ["e2.jpg"]), ("q", "test", None)], "run_id string, name string, file_names array<string>")
    got = {tuple(r) for r in overlap.overlapping_files(lists, records).collect()}
    want = set()
    cores = {f: overlap.core(t) for f, t in texts.items()}
    for a in set(train) & set(cores):
        for b in set(test) & set(cores):
            x, y = cores[a], cores[b]
            if x and y:
                g, h = overlap.grams(x), overlap.grams(y)
                if x == y or (max(len(g), len(h)) and len(np.intersect1d(g, h)) * 3 >= 2 * max(len(g), len(h))):
                    want.add(("r", min(a, b), max(a, b)))
    assert got == want and ("r", "m.jpg", "t0.jpg") in got and ("r", "t1.jpg", "t1.jpg") in got and len(want) > 8
    counts = overlap.overlap_counts(lists, records).collect()
    assert sum(r["n_pairs"] for r in counts) >= len(want)
    assert overlap.overlapping_files(lists.limit(0), records).count() == 0 and overlap.overlapping_files(lists, records.limit(0)).count() == 0


def test_short_texts_lose_no_pair(spark):
    """An edit in a text of 8 to 150 characters may touch every fingerprint of it."""
    rng = random.Random(3)
    say = lambda n: "".join(rng.choice("投保人应当核对编号并注明金额由双方各执一份理赔专员复查保险单自签收次日零时起本公司") for _ in range(n))
    texts = {}
    for i in range(400):
        t = say(rng.choice([4, 5, 6, 8, 9, 10, 11, 12, 13, 16, 20, 25, 30, 40, 60, 90, 110, 150]))
        at = rng.randrange(len(t))
        u = rng.choice([t[:at] + "甲" + t[at + 1 :], t[:-1], "乙" + t, t + say(len(t) // 3), "".join("丙" if k % 16 == 7 else c for k, c in enumerate(t))])
        texts |= {f"a{i}.jpg": t, f"b{i}.jpg": u}
    texts |= {"a_loop.jpg": "保单" * 200, "b_loop.jpg": "保单保单保单保"}
    records = spark.createDataFrame([(i, f, "s", t) for i, (f, t) in enumerate(texts.items())], "record_id long, file_name string, source string, read_text string")
    a, b = [f for f in texts if f[0] == "a"], [f for f in texts if f[0] == "b"]
    lists = spark.createDataFrame([("r", "train", a), ("r", "test", b)], "run_id string, name string, file_names array<string>")
    got = overlap.cross_split_pairs(lists, records).collect()
    runs = {f: set(overlap.grams(overlap.core(t)).tolist()) for f, t in texts.items()}
    want = {(x, y) for x in a for y in b if texts[x] == texts[y] or runs[x] and len(runs[x] & runs[y]) * 3 >= 2 * max(len(runs[x]), len(runs[y]))}
    assert {(r["train_file"], r["file_name"]) for r in got} == want and len(got) == len(want) > 150
    assert ("a_loop.jpg", "b_loop.jpg") in want and min(r["cover"] for r in got) > 0.5


def test_compare():
    a = "投保人应当核对编号并注明金额由双方各执一份"
    assert overlap.compare(a, a) == (1.0, 1.0, 1.0)
    share, left, right = overlap.compare(a + "甲乙丙丁戊己庚辛壬癸", a)
    assert 0 < share < 1 and left < 1 and right == pytest.approx(1.0)
    assert overlap.compare("甲乙丙", "丁戊己")[0] == 0.0
