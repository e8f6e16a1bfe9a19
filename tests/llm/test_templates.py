"""Template deduction: order, nesting and roles of classes, slots of records."""

import pytest

from gridloom.llm import templates


@pytest.fixture(scope="module")
def texts(spark):
    def page(i):  # entries of two kinds of list, by turns of their own
        ul, ol = 1 + i % 2, 1 + i % 3
        return f"<h2>T{i}</h2><ul>" + "".join(f"<li>u{i}{k} <b>x</b></li>" for k in range(ul)) + "</ul>\n<ol class=\"c\">" + "".join(f"<li>o{i}{k}</li>" for k in range(ol)) + "</ol>"

    rows = [("t", i, "s", page(i)) for i in range(12)] + [("t", 3, "s", page(3)), ("t", None, "s", None), ("t", 50, "s", ""), ("t", 51, "s", "plain")]
    rows += [("t", 100 + i, None, f"[[a{i}]] {{{{b{i}}}}}" if i % 2 else f"{{{{b{i}}}}} [[a{i}]]") for i in range(6)]  # equal counts in no fixed order
    rows += [("t", 200 + i, "x", f"<ins>1<del>{i}</ins>2</del>" + "<u>k</u>" * i) for i in range(6)] + [("t", 300, "x", "<ins>0</ins>")]  # overlapping
    return spark.createDataFrame(rows, "tab string, rec_id long, source string, text string")


def test_classes_are_ordered_and_nested(texts):
    rows = templates.template_classes(texts).collect()
    frame = next(r for r in rows if r["template"][0] == "<h2")
    assert frame["template"] == ["<h2", "</h2", "<ul", "</ul", "<ol class=\"c\"", "</ol"] and frame["parent"] is None and frame["depth"] == 0 and frame["support"] == 12
    entries = {r["parent_slot"]: r for r in rows if r["source"] == "s" and r["template"][0] == "<li"}
    assert set(entries) == {3, 5} and all(r["parent"] == frame["class"] and r["tokens"] == sorted(r["tokens"]) for r in entries.values())
    assert entries[3]["template"] == ["<li", "<b", "</b", "</li"] and entries[5]["template"] == ["<li", "</li"]  # one sign, two roles
    assert sorted(r["template"] for r in rows if r["source"] is None) == [["[[", "]]"], ["{{", "}}"]]
    assert sorted((r["template"], r["support"]) for r in rows if r["source"] == "x") == [(["<ins", "</ins"], 7), (["<u", "</u"], 5)]


def test_slots(texts):
    classes = {r["class"]: r["template"][0] for r in templates.template_classes(texts).collect()}
    rows = templates.template_slots(texts).collect()
    assert len({(r["tab"], r["rec_id"], r["class"], r["nth"], r["slot"]) for r in rows}) == len(rows)
    got = sorted((classes[r["class"]], r["nth"], r["slot"], classes.get(r["in_class"]), r["in_nth"], r["in_slot"], r["parts"]) for r in rows if r["rec_id"] == 3)
    page = [("<h2", 1, 1, None, None, None, ["T3"]), ("<h2", 1, 2, None, None, None, [""]), ("<h2", 1, 3, None, None, None, ["", "", ""]), ("<h2", 1, 4, None, None, None, ["\n"]), ("<h2", 1, 5, None, None, None, ["", ""])]
    lists = [("<li", n, s, "<h2", 1, 3, [p]) for n in (1, 2) for s, p in ((1, f"u3{n - 1} "), (2, "x"), (3, ""))] + [("<li", 1, 1, "<h2", 1, 5, ["o30"])]
    assert got == sorted(page + lists)
    assert {r["rec_id"] for r in rows if 100 <= r["rec_id"] < 200} == set(range(100, 106))
    assert [r["parts"] for r in rows if r["rec_id"] == 200] == [["1<del>0"]]


def test_parts_of_a_class():
    assert templates.broken_pairs(("a", "b", "a", "b")) == {("b", "a")} and templates.broken_pairs(("a", "a", "b", "b")) == {("a", "b"), ("b", "a")}
    assert templates.ordered_parts(["a", "b", "c"], {("b", "a"), ("c", "b"), ("a", "c"), ("c", "a")}) == [["a", "b"]]
    assert templates.ordered_parts(["b", "a"], {("b", "a")}) == [["a", "b"]]


def test_no_templates(texts):
    assert templates.template_classes(texts.limit(0)).count() == 0 and templates.template_slots(texts.limit(0)).count() == 0
