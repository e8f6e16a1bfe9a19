"""Truncation, repetition, markup, tokens, leaks and quality on small tables with every kind of dirt."""

import math
import random
import time

import numpy as np
import pytest

from gridloom.llm import leak, markup, quality, repetition, text_core, tokenize_bpe, truncation

LONG = "据此，保全柜台应当核对保险单，并注明编号。" * 4_000


@pytest.fixture(scope="module")
def cells(spark):
    prose = [f"第{i}次，投保人应当在{i}日内核对编号{i * 37}的保险单，并由双方各执一份。其中，金额为{i * 911}元的，由理赔专员复查。" for i in range(1, 80)]
    rows = [(i, "s1" if i % 3 else None, t) for i, t in enumerate(prose)]
    rows += [(100 + i, "s2", t[: len(t) // 2 + 3]) for i, t in enumerate(prose[:20])]
    rows += [(200, "s1", None), (201, None, ""), (202, "s1", " \n\t"), (203, "s3", LONG), (None, "s1", "没有编号的一行。"), (0, "s1", prose[0]), (0, "s1", prose[0])]
    data = [(*r, "clash", 1.5, "x") for r in rows]
    return spark.createDataFrame(data, "row_id long, source string, ground_truth string, text string, score double, key string")


def test_truncation(cells):
    found = {r["row_id"] for r in truncation.cut_rows(cells).collect()}
    assert {100 + i for i in range(20)} <= found and len(found - {100 + i for i in range(20)}) <= 2
    assert not found & {200, 201, 202}
    report = {r["source"]: (r["n_rows"], r["n_cut"]) for r in truncation.cut_report(cells).collect()}
    assert report["s2"] == (20, 20) and sum(n for n, _ in report.values()) == 79 + 20 + 4 + 1
    empty = cells.limit(0)
    assert truncation.cut_rows(empty).count() == 0 and truncation.cut_report(empty).count() == 0


@pytest.mark.parametrize("text", ["完成。<!-- p9 --></p>", "完成。</b>\n\n第 9 页", "完成。" + "\\footnote{" + "另有约定" * 90 + "}", "**done.)**", "完成。" + "</b>" * 90])
def test_whole_ends(text):
    assert truncation.ends_well(text, frozenset(("第 9 页",)))


def test_open_marks_far_from_the_end():
    """What was opened long before the end still counts, and a row of marks behind the end is seen whole."""
    rest = "保险单的编号" * 300 + "。"
    assert not truncation.ends_well("前文。\n\n**" + rest, frozenset()) and truncation.ends_well("前文。\n\n**注**" + rest, frozenset())
    features = lambda t: truncation.features(t, frozenset(), frozenset())
    assert "bold:1True" in features("前文。\n\n**" + rest) and "math:1True" in features("前文。\n\n$x" + rest)
    assert "opentag:True" in features("见 <a href=" + "x" * 400) and "mark" in features("前文" + "……" * 200)


def test_truncation_held_out():
    rng = random.Random(5)
    make = lambda: "".join(rng.choice("投保人应当核对编号并注明金额由双方各执一份理赔专员复查保险单") + ("，" if rng.random() < 0.1 else "") for _ in range(rng.randrange(60, 200))) + "。"
    model = truncation.Classifier(frozenset(), frozenset()).fit([make() for _ in range(300)])
    whole = [make() for _ in range(200)]
    cut = [t[: rng.randrange(20, len(t) - 2)] for t in whole]
    assert (model.score(whole) < 0.5).mean() > 0.97 and (model.score(cut) >= 0.5).mean() > 0.97


def test_fragments_are_no_closing_lines(spark):
    """Fragments that a cut left after a line break repeat in a large table, but longer lines begin with them."""
    prose = [f"第{i}次，投保人应当在{i}日内核对编号{i * 37}的保险单。\n除另有约定外，金额为{i * 911}元的，由理赔专员复查。" for i in range(300)]
    rows = [(i, t) for i, t in enumerate(prose)]
    rows += [(1_000 + i, f"{t}\n\n第 {i} 页") for i, t in enumerate(prose[:40])] + [(2_000 + i, f"{t}\n\n2024年1月{i + 1}日") for i, t in enumerate(prose[:20])]
    rows += [(3_000 + i, f"{t}\n除另有约") for i, t in enumerate(prose[100:130])]  # cut just after a line break
    rows += [(4_000 + i, f"{t}\n2024年1月{i + 1}日起，本公司应当返还保险单的全部价值。") for i, t in enumerate(prose[200:240])]
    data = [(i, "s", t) for i, t in rows]
    df = spark.createDataFrame(data, "row_id long, source string, ground_truth string")
    model = truncation.fitted_classifier(df)
    assert model.closers == {"第 9 页", "9年9月9日"}
    assert {r["row_id"] for r in truncation.cut_rows(df).collect()} >= set(range(3_000, 3_030))


def test_limits_stand_out_from_the_lengths_around(spark):
    """Ordinary lengths of a large table are frequent too, and one long text says nothing about them."""
    sizes = [n for n in range(500, 1_100) for _ in range(6 + n % 4)] + [900] * 60 + [1_024] * 50 + [3_001] * 9 + [200_000]
    df = spark.createDataFrame([(i, "s", "a" * n) for i, n in enumerate(sizes)], "row_id long, source string, ground_truth string")
    assert truncation.fitted_classifier(df).lengths == {900, 1_024, 3_001}
    assert truncation.poisson_tail(3, 0.5) == pytest.approx(0.01439, rel=0.02) and truncation.poisson_tail(5, 0.0) == 0.0


def brute_share(core):
    seen, covered = set(), set()
    for i in range(len(core) - repetition.PASSAGE + 1):
        gram = core[i : i + repetition.PASSAGE]
        if gram in seen:
            covered.update(range(i, i + repetition.PASSAGE))
        seen.add(gram)
    return len(covered) / max(1, len(core))


def test_repeated_share_equals_brute_force():
    rng = random.Random(1)
    texts = ["", "a", "ab" * 30, "甲" * 19, "甲" * 20, "甲" * 21] + ["".join(rng.choice("甲乙丙") for _ in range(rng.randrange(400))) for _ in range(40)]
    texts += [t + "x" + t for t in texts[-5:]]
    assert repetition.repeated_shares(texts) == pytest.approx([brute_share(t) for t in texts])
    case = [bool(t) and brute_share(t) * 3 >= 1 - 1e-12 for t in texts]
    score, cutoff, rejected = repetition.judged(texts, {})
    assert rejected.tolist() == case and np.isnan(cutoff).all()
    assert min(s for s, c in zip(score, case) if c) >= repetition.FLOOR - 1e-12


def test_no_case_scores_below_the_floor():
    """Cases at the limit, made of passages as short as they may be, and loops of any period."""
    rng = random.Random(11)
    say = lambda n: "".join(chr(0x4E00 + rng.randrange(5_000)) for _ in range(n))
    texts = []
    for _ in range(60):
        parts = [say(20) for _ in range(rng.randrange(2, 30))]
        texts.append("".join(p + say(rng.randrange(0, 5)) for p in parts) + say(rng.randrange(0, 10)) + "".join(p + say(rng.randrange(1, 25)) for p in rng.sample(parts, len(parts))))
    texts += [say(k) * 40 for k in range(1, 30)]
    share, score = np.array([brute_share(t) for t in texts]), repetition.sketch_scores(texts)
    case = share * 3 >= 1 - 1e-12
    assert 40 < case.sum() < len(texts) and (score[case] >= repetition.FLOOR - 1e-12).all()
    assert repetition.judged(texts, {})[2].tolist() == case.tolist()


def test_cutoffs():
    assert repetition.binomial_upper(0, 100, 0.05) == pytest.approx(1 - 0.05 ** (1 / 100), abs=1e-9)
    assert repetition.binomial_upper(5, 5, 0.05) == 1.0
    rows = [("a", 0.01, False)] * 2_000 + [("a", 0.37, False)] * 60 + [("a", 0.9, True)] * 10 + [("b", 0.0, False)] * 3 + [("c", 0.95, True)]
    got = repetition.select_cutoffs(rows)
    assert got["a"][:3] == (0.4, 2_060, 0) and got["a"][3] <= repetition.ALPHA
    assert got["b"][0] is None and got["c"][0] is None  # too few rows to certify anything
    assert repetition.select_cutoffs([]) == {}


def test_bound_of_a_whole_table():
    exact = lambda p: sum(math.comb(500, i) * p**i * (1 - p) ** (500 - i) for i in range(41))
    assert exact(repetition.binomial_upper(40, 500, 0.01)) == pytest.approx(0.01, rel=1e-6)
    start = time.process_time()
    assert repetition.binomial_upper(300_000, 30_000_000, 0.001) == pytest.approx(0.01 + 3.09 * (0.0099 / 30_000_000) ** 0.5, rel=1e-4)
    assert time.process_time() - start < 5


def test_cutoffs_decide():
    """Above the cutoff the score alone rejects, below it the exact share does."""
    rng = random.Random(2)
    say = lambda n: "".join(chr(0x4E00 + rng.randrange(5_000)) for _ in range(n))
    parts = [say(15) for _ in range(30)]
    near = "".join(p + say(1) for p in parts) + "".join(p + say(1) for p in parts)  # repeats 15 characters at a time: no case
    assert brute_share(near) == 0 and repetition.sketch_scores([near])[0] > 0.1
    again = "".join(p + say(1) for _ in range(6) for p in parts)
    assert brute_share(again) == 0 and not repetition.judged([again], {})[2][0]
    assert repetition.judged([again], {repetition.stratum(again): 0.2})[2][0]


def test_holdout_stays_within_its_risk(spark):
    """False rejections of rows that the cutoffs were not chosen on."""
    rng = random.Random(13)
    say = lambda n: "".join(chr(0x4E00 + rng.randrange(5_000)) for _ in range(n))
    rows = []
    for i in range(3_000):
        t = say(rng.randrange(100, 300))
        rows.append((i, t + t[: len(t) * rng.randrange(0, 4) // 6] + say(3)))
    df = spark.createDataFrame(rows, "row_id long, ground_truth string")
    cutoffs = {k: v[0] for k, v in repetition.holdout_cutoffs(df.where("row_id < 2000")).items() if v[0] is not None}
    assert cutoffs
    held = [t for i, t in rows if i >= 2_000]
    case = np.array([brute_share(t) * 3 >= 1 - 1e-12 for t in held])
    rejected = repetition.judged(held, cutoffs)[2]
    assert rejected[case].all() and rejected[~case].mean() <= repetition.ALPHA


def test_repetition(spark, cells):
    assert {r["row_id"] for r in repetition.repetitive_rows(cells).collect()} == {203}
    assert repetition.repetition(cells).count() == 104 and repetition.repetition(cells.limit(0)).count() == 0
    assert repetition.cutoff_table(spark, cells.limit(0)).count() == 0
    huge = "据此，保全柜台应当核对编号。" * 60_000
    assert np.isnan(repetition.sketch_scores([huge, "短"])).all() and repetition.judged([huge, "短"], {})[2].tolist() == [True, False]
    shares = {r["row_id"]: r["share"] for r in repetition.repetition(cells).collect()}
    assert shares[200] == shares[201] == shares[202] == 0.0


def test_cutoffs_come_from_all_rows(spark):
    """Every key counts once, whatever the size of the table and of its texts; what the score alone rejects is no row found."""
    rng = random.Random(17)
    say = lambda n: "".join(chr(0x4E00 + rng.randrange(5_000)) for _ in range(n))
    parts = [say(19) for _ in range(10)]
    again = "".join(p + say(1) for _ in range(12) for p in parts)  # scores high, but repeats 19 characters at a time
    assert brute_share(again) == 0
    loop = say(30) * 20
    rows = [(i, say(500)) for i in range(9_000)] + [(9_000, again), (9_001, loop), (9_002, loop), (9_002, loop), (9_003, say(30_000))]
    df = spark.createDataFrame([(i, "s", t) for i, t in rows], "row_id long, source string, ground_truth string")
    found = {r["stratum"]: r for r in repetition.cutoff_table(spark, df).collect()}
    assert found["other-middling"]["n_holdout"] == 9_000 and found["other-long"]["n_holdout"] == 2
    assert found["other-middling"]["cutoff"] == repetition.CASE and found["other-long"]["cutoff"] is None
    many = df.unionAll(spark.createDataFrame([(20_000 + i, "s", say(1_300)) for i in range(1_500)], df.schema))
    rejected = {r["row_id"]: (r["cutoff"], r["rejected"]) for r in repetition.repetition(many).where("score >= 0.3").collect()}
    assert rejected == {9_000: (repetition.CASE, True), 9_001: (repetition.CASE, True), 9_002: (repetition.CASE, True)}
    assert {r["row_id"] for r in repetition.repetitive_rows(many).collect()} == {9_001, 9_002}


MARKUP = {
    "# head\ntext": ["markdown"], "a **b** c": ["markdown"], "see `x` now": ["markdown"], "- item\n- item": ["markdown"], "1. one": ["markdown"], "[a b](#s1) x": ["markdown"], "> said": ["markdown"],
    "| a | b |\n| --- | --- |": ["markdown"], "Title\n=====": ["markdown"], "```\nx": ["markdown"], "cut **here": ["markdown"], "x\n\n| 年": ["markdown"], "x\n\n##": ["markdown"], "cut `he": ["markdown"], "cut '''he": ["wiki"], "cut [[he": ["wiki"], "cut \\text": ["latex"], "cut $v^{7": ["latex"],
    "<p>x</p>": ["html"], "a&nbsp;b": ["html"], "x <!-- note -->": ["html"], "<table border=\"1\"><tr><td": ["html"], "line<br>line": ["html"],
    "== Head ==": ["wiki"], "[[a|b]]": ["wiki"], "{{n|x}}": ["wiki"], "'''b'''": ["wiki"], "{| class=\"w\"\n! a !! b\n|-\n| 1 || 2\n|}": ["wiki"],
    "\\section{x}": ["latex"], "\\begin{itemize}\n\\item x": ["latex"], "so $a_{1} = b$ holds": ["latex"], "\\[ \\frac{a}{b} \\]": ["latex"], "x~\\ref{s1}": ["latex"],
    "年龄<18周岁且保额>100的": [], "A&B 两档": [], "男|女即可": [], "5 * 29 * 2": [], "从 $98 到 $98 。": [], "#158 号窗口": [], "D:\\scan\\page131": [], "见脚注[6]": [], "甲 == 乙时取{甲方}": [],
    "plan_code = \"T1\"": [], "（1）一项": [], "·一项": [], "S * (1 - a) * (b)": [], "续 [truncated]": [], "": [], "  ": [],
}


@pytest.mark.parametrize("text", list(MARKUP))
def test_markup_kinds(text):
    assert markup.kinds(text) == MARKUP[text]


LONG_OPENINGS = {
    "见 <a href=\"https://x.cn/" + "q1/" * 300: ["html"], "图 <img src='" + "一 " * 400: ["html"], "<td class=\"c\" title=\"" + "说明，" * 200: ["html"],
    "见 [" + "附表所列的费率" * 30: ["markdown"], "见 [" + "附表所列的费率" * 30 + "](": ["markdown"], "见 [" + "附表所列的费率" * 30 + "](#s": ["markdown"],
    "保额 < 100 元" + "的保险单" * 100: [], "<a b, " + "c d, " * 100: [], "见[6" + "附表" * 60: [], "<b" + " x=" * 2_000 + " >": [], "[" * 5_000 + "]": [], "<" * 5_000: [],
}


@pytest.mark.parametrize("text", list(LONG_OPENINGS), ids=range(len(LONG_OPENINGS)))
def test_long_openings_that_a_cut_left(text):
    assert markup.kinds(text) == LONG_OPENINGS[text]


def test_markup_frames(spark, cells):
    records = spark.createDataFrame([(1, "s", "<h1>T</h1><ul><li>a</li></ul>", "x"), (1, "s", "<h1>T</h1><ul><li>a</li></ul>", "x"), (2, None, None, "x"), (3, "s", "", "x"), (None, "s", "**b**", "x")], "record_id long, source string, read_text string, text string")
    both = markup.texts_of(cells, records)
    assert sorted((r["tab"], r["rec_id"], r["markup"]) for r in markup.markup_kinds(both).collect() if r["rec_id"]) == [("markdown_records", 1, "html")]
    cleaned = {(r["tab"], r["rec_id"]): r["clean"] for r in markup.clean_texts(both).collect()}
    assert cleaned["markdown_records", 1] == "# T\n\n- a" and cleaned["markdown_records", 2] is None and cleaned["markdown_records", None] == "b"
    assert markup.markup_kinds(both.limit(0)).count() == 0 and markup.template_classes(both.limit(0)).count() == 0
    many = spark.createDataFrame([("t", i, "s", "<p>x</p>" * (i + 1)) for i in range(4)], "tab string, rec_id long, source string, text string")
    assert [r["tokens"] for r in markup.template_classes(many).collect()] == [["</p", "<p"]]


def test_clean_keeps_structure():
    html = markup.clean("<h2>H</h2><p>a <b>b</b>&nbsp;c</p><table><tr><th>x</th><th>y</th></tr><tr><td>1</td><td>2</td></tr></table><pre><code>k = 1</code></pre>")
    assert "## H" in html and "a b c" in html and "x | y\n1 | 2" in html and "```\nk = 1\n```" in html
    wiki = markup.clean("== H ==\n:: [[项1]] a；\n{| class=\"w\"\n! x !! y\n|-\n| 1 || 2\n|}\n'''b''' [[p|q]]")
    assert "# H" in wiki and "- a；" in wiki and "x | y\n1 | 2" in wiki and "b q" in wiki
    tex = markup.clean("\\subsection{H}\n\\begin{itemize}\n\\item a\n\\end{itemize}\n\\begin{tabular}{rr}\nx & y \\\\\n1 & 2 \\\\\n\\end{tabular}\n\\[ a_1 \\] \\textbf{b}\\footnote{3}")
    assert "## H" in tex and "- a" in tex and "x | y\n1 | 2" in tex and "$a_1$" in tex and "b" in tex and "footnote" not in tex
    assert markup.clean(None) is None and markup.clean("") == ""


def test_tokens_equal_public_tokenizer(spark):
    tokenizers = pytest.importorskip("tokenizers")
    ref = tokenizers.Tokenizer.from_file(tokenize_bpe.tokenizer_file())
    ref.encode_special_tokens = True
    rng = random.Random(2)
    texts = ["", "a", " a  b\n\n c", "aaaaaaaaaaaaaaaa", "<|endoftext|> x", "it's we'll 123456", "龘靐齉爩" * 300, "👨‍⚕️½\u200b\ufeff", LONG[:5_000], "x" * 3_000, "\r\n\t" * 50]
    texts += ["".join(rng.choice("ab 1.,\n的保é龘😀'") for _ in range(rng.randrange(60))) for _ in range(300)]
    machine = tokenize_bpe.Automaton(*tokenize_bpe.read_merges(tokenize_bpe.tokenizer_file()), tokenize_bpe.pre_split_pattern())
    ids, ends = machine.encode(texts)
    got = [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]
    assert got == [e.ids for e in ref.encode_batch(texts, add_special_tokens=False)]
    assert [machine.decode(x) for x in got] == texts
    tokenize_bpe_words, tokenize_bpe.MEMORY_WORDS = tokenize_bpe.MEMORY_WORDS, 40
    again, _ = machine.encode(texts)  # more words than are remembered
    tokenize_bpe.MEMORY_WORDS = tokenize_bpe_words
    assert again.tolist() == ids.tolist()
    arcs, tokenize_bpe.ARCS = tokenize_bpe.ARCS, 50
    machine.forget()
    again, _ = machine.encode(texts)  # more arcs than are kept
    tokenize_bpe.ARCS = arcs
    assert again.tolist() == ids.tolist()
    rows = [(i, t, "clash") for i, t in enumerate(texts[:20])] + [(98, None, ""), (99, "", ""), (99, "", ""), (None, "a", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = {r["doc_id"]: r["ids"] for r in tokenize_bpe.encode_corpus(df).collect()}
    assert out[98] == out[99] == [] and out[None] == out[1] and [out[i] for i in range(20)] == got[:20]
    assert tokenize_bpe.encode_corpus(df).count() == len(rows) and tokenize_bpe.encode_corpus(df.limit(0)).count() == 0


def brute_leaks(documents, items):
    found = set()
    for i, lang, text in items:
        if not text_core.core(text):
            continue
        words = [len(w) for w in text_core.core_words(text)]
        whole = text_core.core(text)
        edges = [sum(words[:k]) for k in range(len(words) + 1)]
        for d, doc in documents:
            body, covered = text_core.core(doc), set()
            spans = [(a, a + 16) for a in range(len(whole) - 15)] if lang == "zh" else [(edges[k], edges[k + 8]) for k in range(len(words) - 7)]
            for a, b in spans:
                if whole[a:b] in body:
                    covered.update(range(a, b))
            if len(covered) * 2 >= len(whole):
                found.add((d, i))
    return found


def test_leaks_equal_brute_force(spark):
    rng = random.Random(8)
    zh = lambda n: "".join(rng.choice("投保人应当核对编号并注明金额由双方各执一份理赔专员复查保险单自签收次日零时起") for _ in range(n))
    en = lambda n: " ".join(rng.choice("the policyholder shall promptly verify any annexed bonus notice and return a stamped benefit ratio".split()) for _ in range(n))
    items = [(1, "zh", zh(200)), (2, "zh", zh(60)), (3, "en", en(120)), (4, "en", en(30)), (5, "zh", ""), (6, None, zh(90))]
    texts = {i: t for i, _, t in items}
    documents = [(1, zh(500) + texts[1] + zh(50)), (2, texts[1][:60] + "。" + zh(40) + texts[1][120:170]), (3, en(50) + ". " + texts[3].upper()), (4, texts[3][: len(texts[3]) // 3])]
    documents += [(5, "\n".join(texts[1][k : k + 15] for k in range(0, 200, 15))), (6, "<p>" + texts[2][:35] + "</p>"), (7, zh(3_000)), (8, en(2_000)), (9, texts[4].replace(" ", "  ", 3)), (10, texts[6])]
    dirty = documents + [(11, None), (12, ""), (13, " \n")]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in dirty], "doc_id long, text string, item_id int, lang string")
    q = spark.createDataFrame([(i, s, t, "validation") for i, s, t in items] + [(7, "zh", None, "test")], "item_id long, lang string, text string, name string")
    got = {(r["doc_id"], r["item_id"]) for r in leak.leaked_items(df, q).collect()}
    assert got == brute_leaks(documents, [(i, "en" if s == "en" else "zh", t) for i, s, t in items])
    assert {(1, 1), (2, 1), (3, 3), (10, 6)} <= got and not any(d in (7, 8) for d, _ in got)
    assert leak.leaked_items(df.limit(0), q).count() == 0 and leak.leaked_items(df, q.limit(0)).count() == 0


def test_leaks_of_repetitive_items(spark):
    """An item that repeats a phrase is held by a document that has the phrase once, wherever runs are read."""
    rng = random.Random(21)
    zh = lambda n: "".join(rng.choice("投保人应当核对编号并注明金额由双方各执一份理赔专员复查保险单自签收次日零时起") for _ in range(n))
    items, documents = [], []
    for k, times in enumerate([1, 2, 3, 6, 10, 20, 20, 40]):
        phrase = zh(16 + k)
        items.append((k, "zh", phrase * times + zh(len(phrase) * times // 3)))
        documents += [(100 * k + at, zh(at) + phrase + zh(7)) for at in range(12)]  # once, at every offset
    items += [(20, "en", "a b c d e f g h " * 5), (21, "en", "it is as it is to me as it is to us all"), (22, "en", "only five words in this"), (23, "zh", "投保人" * 4)]
    documents += [(2_000 + k, zh(k) + " a b c d e f g h. " + zh(9)) for k in range(5)] + [(3_000 + k, f"{zh(k)} it is as it is to me as it is to us. Only five words in this") for k in range(5)]
    got = leak.leaked_items(spark.createDataFrame(documents, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, lang string, text string"))
    want = brute_leaks(documents, items)
    assert {tuple(r) for r in got.collect()} == want and {i for _, i in want} == set(range(8)) | {20, 21}


def test_leaks_of_items_with_signs(spark):
    """Signs that folding makes letters of, decomposed letters and letters that join across a space lose no item."""
    rng = random.Random(12)
    en = lambda: " ".join(rng.choice("the policyholder shall promptly verify any annexed bonus notice and return a stamped benefit ratio".split()) for _ in range(40))
    items = [(i, "en", f"{en()} {sign} {en()}") for i, sign in enumerate(["Acme\u2122 tariff", "\u2116 7 at 20 \u2103", "40 \u33a1 of floor", "cafe\u0301s and \u0130stanbul", "\u1100 \u1161 mark", "\u2474a \ufb01ne"])]
    documents = [(10 + i, f"{en()}. {t} {en()}") for i, _, t in items]
    got = leak.leaked_items(spark.createDataFrame(documents, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, lang string, text string"))
    assert {tuple(r) for r in got.collect()} == {(10 + i, i) for i, _, _ in items}
    signs = "".join(map(chr, [*range(0xA0, 0x1100), *range(0x2000, 0xD800), *range(0xF900, 0xFFFE)]))
    for k in range(0, len(signs), 7):
        text = "word " + signs[k : k + 7].replace("", " a ")
        assert sum(text_core.word_sizes(text, text_core.core(text))) == len(text_core.core(text))
    assert text_core.core_words("cafe\u0301s \u0130stanbul Acme\u2122") == ["cafes", "istanbul", "acme"]


def test_quality(spark):
    words = spark.createDataFrame([("zh", w) for w in "的在和应由自起并"] + [("en", w) for w in "the a of to and".split()] + [(None, None)], "lang string, word string")
    prose = [(i, f"据此，投保人应当在{i}日内核对保险单的编号，并由双方各执一份。其中，金额为{i}元的，应由理赔专员复查。\n同时，自签收次日起，本公司应及时返还保费，并在{i}日内通知。") for i in range(30)]
    lists = [(100 + i, "\n".join(f"- 第{j}项保险单" for j in range(12))) for i in range(10)]
    tables = [(200 + i, "\n".join("\t".join(str(j * k + 3.5) for k in range(5)) for j in range(12))) for i in range(10)]
    junk = [(300 + i, "".join(chr(0x9F98 - (i * 7 + j * 13) % 90) for j in range(300))) for i in range(10)]
    rows = [(i, t, "x", 0.1) for i, t in [*prose, *lists, *tables, *junk, (400, None), (401, ""), (402, " \n "), (403, LONG)]]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string, prose double")
    got = {r["doc_id"]: r["kind"] for r in quality.mostly_not_prose(df, words).collect()}
    assert got == {i: "list" for i, _ in lists} | {i: "table" for i, _ in tables} | {i: "junk" for i, _ in junk}
    shares = {r["doc_id"]: r for r in quality.line_shares(df, words).collect()}
    assert shares[400]["prose"] is None and shares[402]["n_seen"] == 0 and shares[403]["prose"] > 0.9
    assert quality.mostly_not_prose(df.limit(0), words.limit(0)).count() == 0


def test_core():
    assert text_core.core("<b>Ａ</b>&nbsp;１２ [x](#s1) \\textbf{y} ，。") == "a12xy"
    assert text_core.core(None) == "" and text_core.core_words("Re-start, NOW's") == ["re", "start", "now", "s"]


def test_statistics(spark):
    words = spark.createDataFrame([("zh", "的"), ("en", "the"), ("en", None), ("en", "The")], "lang string, word string")
    df = spark.createDataFrame([(1, "The cat。\n的 x!\n- y", "c"), (2, None, "c"), (3, "", "c"), (4, " \n", "c"), (5, "#?", "c")], "doc_id long, text string, n_words string")
    got = {r["doc_id"]: tuple(r)[1:] for r in quality.text_statistics(df, words).collect()}
    assert got[1] == (5, 9 / 5, 3 / 12, 2 / 3, 2 / 5)
    assert got[2] == (None,) * 5 and got[3] == got[4] == (0, None, None, None, None) and got[5] == (0, None, 1.0, 1.0, None)
    assert quality.text_statistics(df.limit(0), words.limit(0)).count() == 0


def test_all_common_words_count(spark, monkeypatch):
    many = spark.range(12_000).selectExpr("'en' as lang", "concat('A', id) as word").unionAll(spark.createDataFrame([("en", "the"), ("en", "zoo"), ("zh", "龍"), ("zh", "保险")], "lang string, word string"))
    df = spark.createDataFrame([(1, "The zoo, a11999 b1 a0x 龍保险"), (2, None)], "doc_id long, text string")
    ratio = lambda: {r["doc_id"]: r["common_ratio"] for r in quality.text_statistics(df, many).collect()}
    assert ratio() == {1: 4 / 8, 2: None}  # a word of several ideographs is none of the words counted
    monkeypatch.setattr(quality, "PATTERN_WORDS", 20_000)
    assert ratio() == {1: 4 / 8, 2: None}
    assert {"the", "zoo", "龍", "a11999"} <= quality.fitted_model(df, many).common
    monkeypatch.setattr(quality, "COMMON_WORDS", 12_003)
    with pytest.raises(ValueError):
        quality.text_statistics(df, many)
