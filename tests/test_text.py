import pytest
from pyspark.sql import functions as F

from gridloom.functions import text as T


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, ratio",
    [("a\nb\na\n\n a ", 0.5), ("", 1.0), (None, 1.0), ("　\n\t", 1.0), ("x\r\nx x", 1 - 1 / 3), ("x", 0.0)],
)
def test_duplicate_lines(spark, text, ratio):
    assert one(spark, T.duplicate_line_ratio("x"), text) == pytest.approx(ratio)


def test_normalize(spark):
    text = "<!-- a\nb --><b>Hi</b> | there\n--- | :---:\n```python\ncode``` &amp;"
    assert one(spark, T.normalize_text("x"), text) == "Hi there code &amp;"
    assert one(spark, T.normalize_text("x"), None) is None


@pytest.mark.parametrize(
    "text, issue",
    [
        ("<table><tr><td>1</td></tr></table>", None),
        ("no tags", None),
        ("</td>", "closes </td> without an opening tag"),
        ("<table><tr></table>", "closes </table> while <tr> is open"),
        ("<table><tr><td><th>", "unclosed <tr>, <td>, <th>"),
        ("<TABLE class='x'><tr ><td>a</td ></tr></Table>", None),
        ("<td/>", None),
        (None, None),
    ],
)
def test_html_issue(spark, text, issue):
    assert one(spark, T.html_issue("x"), text) == issue


@pytest.mark.parametrize(
    "text, cut",
    [("", True), (None, True), ("fine.", False), ("```\ncode", True), ("```\ncode\n```", False), ("<table><tr>", True), ("a <td>12", True), ("<table></table>", False)],
)
def test_truncated(spark, text, cut):
    assert one(spark, T.looks_truncated("x"), text) is cut


def test_gates_in_order(spark):
    gate = T.candidate_issue("x", max_blocks=1, max_duplicate=0.3)
    assert one(spark, gate, None) == "short"
    assert one(spark, gate, "this is the Markdown Parsing Task of today") == "prompt"
    assert one(spark, gate, "x" * 30 + "</table>") == "structure"
    assert one(spark, gate, "y" * 30 + "\n```\nopen") == "truncated"
    assert one(spark, gate, "z" * 30 + "<table></table>" * 2) == "blocks"
    assert one(spark, gate, "\n".join(f"row {i} {i} {i}" for i in range(8))) == "unstructured"
    assert one(spark, gate, "the same line again\n" * 5) == "duplicates"
    assert one(spark, gate, "a text that is long enough to pass") is None


def test_pipe_tables(spark):
    text = "| a | b |\n| --- | :---: |\n\n<!-- note -->\n| 1 |  |\n"
    t = one(spark, T.parse_pipe_table("x"), text)
    assert t["header"] == ["a", "b"] and t["rows"] == [["1", ""]]
    for bad in ("prose", "| a | b |\n| --- |\n", "| a |\nprose\n", "| a |\n| b |", "", None, "| a |"):
        assert one(spark, T.parse_pipe_table("x"), bad) is None
    back = T.format_pipe_table(F.col("t.header"), F.col("t.rows"))
    df = spark.createDataFrame([(text,)], "x string").withColumn("t", T.parse_pipe_table("x"))
    assert df.select(back.alias("r")).first()["r"] == "| a | b |\n| --- | --- |\n| 1 |  |"


def test_cells_and_labels(spark):
    assert one(spark, T.pipe_cells("x"), "| a ||b |") == ["a", "", "b"]
    assert one(spark, T.numeric_cell("x"), " -1,234.50 ") is True
    assert one(spark, T.numeric_cell("x"), "12a") is False
    assert one(spark, T.label_key("x"), " Age （岁） (X) ") == "age岁x"
    assert one(spark, T.tidy_number("x"), "1, 234. 5") == "1,234.5"
    assert one(spark, T.semantic_label("x"), "12 年") is True
    assert one(spark, T.lines("x"), "a\r\nb\n") == ["a", "b"]
    assert one(spark, T.blocks("x"), "a\nb\n\n\n c \n \n") == ["a\nb", "c"]
