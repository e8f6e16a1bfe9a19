import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.operators.csv_records import diagnose, parse_block, parse_records

CASES = {
    "a.jpg,x": None, '"a.jpg","x"': None, 'a.jpg,"x""y"': None, 'a.jpg,"x\ny"\r\n': None, "a.jpg,x\r": None, '"a\nb.jpg",x': None, "a.JPG ,x": None,
    'a.jpg,x"y': "quoting", 'a.jpg,"x"y': "quoting", 'a.jpg, "x"': "quoting", "a.jpg,x\ny": "quoting", 'a.jpg,"x': "quoting", "a.jpg,x\n\n": "quoting", 'a.jpg,x,"y"z': "quoting",
    "": "columns", "a.jpg": "columns", 'a.jpg,"x",': "columns", "a.jpg,b,c": "columns",
    ".jpg,x": "value", "a/b.jpg,x": "value", "a\\b.jpg,x": "value", "a.jpg,　": "value", "a.jpg,x\x07": "value", 'a.jpg,""': "value", "a.txt,x": "value", "a.jpg,x�": "value", "file_name,ground_truth": "value",
}


def test_reasons():
    assert {k: diagnose(k)[2] for k in CASES} == CASES
    assert diagnose(None)[2] == "columns"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.sampled_from(list(CASES)), st.text(alphabet='a.jpg,"\r\n \\/　x', max_size=14)), max_size=12))
def test_blocks_equal_single_records(records):
    assert parse_block(pa.array(records, pa.string())) == [diagnose(r) for r in records]


def test_frame(spark):
    rows = [(1, "a.jpg,x", 9), (1, "a.jpg,x", 8), (2, None, 1), (None, "b.png,y", 1), (3, "c.bmp," + "z" * 200_000, 1)]
    df = spark.createDataFrame(rows, "raw_id long, raw_row string, file_name int")
    got = {r["raw_id"]: (r["file_name"], len(r["ground_truth"] or ""), r["reason"]) for r in parse_records(df).collect()}
    assert got == {1: ("a.jpg", 1, None), 2: (None, 0, "columns"), None: ("b.png", 1, None), 3: ("c.bmp", 200_000, None)}
    assert parse_records(df.limit(0)).count() == 0
