import pytest
from pyspark.sql import functions as F

from pagequarry.functions import html, text
from pagequarry.operators.chunking import (
    RegexTokenizer,
    chunk_id,
    explode_chunks,
    fixed_length_chunks,
    page_chunks,
    page_chunks_with,
    paragraphs,
)
from pagequarry.operators.terms import bag_of_words, summarise_long_texts


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row.r for row in df.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()]


def test_symbols(spark):
    cleaned = column(spark, ["●a■b➔c", "5 K/g x", r"a\\s+b", "a  b", None], text.clean_symbols)
    assert cleaned == [" a b c", "5   x", r"a\\s+b", "a  b", None]
    assert column(spark, ["a \n b"], lambda c: text.clean_symbols(c, True)) == ["a b"]


def test_blank_lines(spark):
    assert column(spark, ["\n a\n\n\n\nb\n\nc \n", ""], text.collapse_blank_lines) == ["a\n\nb\n\nc", ""]


def test_illegal_characters(spark):
    assert column(spark, ["a\x00\x07b\tC\n"], text.remove_illegal_characters) == ["ab\tC\n"]
    assert column(spark, ["  A\x01b \n C "], text.normalise_case) == ["ab c"]


def test_stop_words(spark):
    assert column(spark, ["The cat, and THE dog!"], text.remove_stop_words) == ["cat dog"]


def test_truncation_keeps_the_text_before_the_cut(spark):
    cut = column(spark, ["a  b\nc d", "a b", "", None], lambda c: text.truncate_tokens(c, 3))
    assert cut == ["a  b\nc", "a b", "", None]
    marks = r"\w+|[^\w\s]"
    assert column(spark, ["Hi, you. Yes"], lambda c: text.truncate_tokens(c, 4, marks)) == ["Hi, you."]
    assert column(spark, ["Hi, you. Yes"], lambda c: text.token_count(c, marks)) == [5]


def test_term_counts(spark):
    found = column(spark, [["b", "a", "b"], []], text.term_counts, "array<string>")
    assert [[tuple(t) for t in terms] for terms in found] == [[("a", 1), ("b", 2)], []]


def test_labels_and_breaks(spark):
    assert column(spark, ["Answer: x", "x Answer: y"], text.drop_leading_label) == ["x", "x Answer: y"]
    assert column(spark, ["a\nb"], text.line_breaks_to_html) == ["a<br/>b"]


def test_titles(spark):
    pages = [
        "<h1>One &amp; <b>two</b></h1><h1>Three</h1>",
        '<h1 class="x">One</h1>',
        "<h1>One\ntwo</h1>",
        "<p>none</p>",
        None,
    ]
    assert column(spark, pages, html.page_title) == ["One & two", "", "", "", None]


def test_html_text(spark):
    pages = ['<p>a</p><script>var t="</p>";</script><!-- x --><b>b &amp;lt; c</b>', "1 < 2 &middot; 3"]
    assert column(spark, pages, html.html_to_text) == ["ab &lt; c", "1 < 2 · 3"]


def test_nested_container(spark):
    page = '<div><div itemprop="articleBody">\n<div>a</div>b</div>c</div>'
    found = column(spark, [page, "<div>x</div>", None], html.container_html)
    assert found == ['<div itemprop="articleBody">\n<div>a</div>b</div>', None, None]
    unclosed = '<div itemprop="articleBody"><div>a</div>'
    assert column(spark, [unclosed], html.container_html) == [unclosed]


SECTIONED = {
    "small tail": ("<h1>T</h1> a b c <h2>S1</h2> d e f g h <h2>S2</h2> i", {}, ["T a b c S1 d e f g h"]),
    "large tail": ("x <h2>S1</h2> a b c d e f <h2 id='s'>S2</h2> g h i", {}, ["x S1 a b c d e f", "S2 g h i"]),
    "repeated heading": ("p <h2>S</h2> a b c d e <h2>S</h2> f g h i j k", {}, ["p S a b c d e", "S f g h i j k"]),
    "short": ("a <h2>b</h2>\n\n\n\nc", {}, ["a b\n\nc"]),
    "long without sections": ("a b c d e f g h i j k l", {}, ["a b c d e f g h i j"]),
    "empty": ("", {}, [""]),
    "min above half": ("a b c d e f <h2>g</h2> h i j k l m", {"min_tokens": 8}, ["a b c d e f"]),
}


@pytest.mark.parametrize("case", SECTIONED)
def test_sections(spark, case):
    page, changed, expected = SECTIONED[case]
    limits = {"max_tokens": 10, "min_tokens": 2} | changed
    assert column(spark, [page], lambda c: page_chunks(c, **limits)) == [expected]
    assert column(spark, [page], lambda c: page_chunks_with(c, RegexTokenizer, **limits)) == [expected]


def test_tail_can_be_kept(spark):
    page = SECTIONED["small tail"][0]
    assert column(spark, [page], lambda c: page_chunks(c, 10, 2, keep_tail=True))[0][-1] == "S2 i"


def test_chunks_stay_below_the_limit(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    chunks = pages.select(F.explode(page_chunks(F.col("html"), 50, 5, tag="p")).alias("c"))
    assert chunks.filter(text.token_count(F.col("c")) > 50).isEmpty()


def test_null_and_empty_pages_have_no_chunk_rows(spark):
    df = spark.createDataFrame([(1, "a\n\nb"), (2, ""), (3, None)], "id int, t string")
    rows = explode_chunks(df, paragraphs(F.col("t")), "id").collect()
    assert [tuple(r) for r in rows] == [(1, 0, "a"), (1, 1, "b")]


def test_fixed_length(spark):
    assert column(spark, ["a b  c d e", "", "a"], lambda c: fixed_length_chunks(c, 2)) == [["a b", "  c d", " e"], [], ["a"]]


def test_chunk_id_refuses_overflow(spark):
    df = spark.createDataFrame([(2, 65_535), (2, 65_536)], "page bigint, n bigint")
    ids = df.select("n", chunk_id(F.col("page"), F.col("n")).alias("id"))
    assert ids.filter("n = 65535").first().id == 2 * 65_536 + 65_535
    with pytest.raises(Exception, match="out of range"):
        ids.collect()


def test_summaries(spark):
    long_text = "Common words here. Zebra quagga okapi. Common words again. Common words here again."
    rows = [(1, long_text), (2, "Common words here again and again."), (3, None), (4, "." * 100)]
    df = spark.createDataFrame(rows, "id int, t string")
    result = {r.id: r.text_short for r in summarise_long_texts(df, "id", "t", limit=50, keep=1).collect()}
    assert result == {1: "Zebra quagga okapi.", 2: rows[1][1], 3: None, 4: rows[3][1]}


def test_bag_of_words_leaves_out_stop_words(spark):
    df = spark.createDataFrame([(1, "The the cat")], "id int, t string")
    assert bag_of_words(df, "id", "t", ("the",)).first().terms == [("cat", 1)]


def test_parser_agrees_with_expressions(spark):
    pages = ["<p>a</p><script>var t='</p>';</script>b &amp;lt; &middot;<style>x</style><!-- c -->d", None, "<b>open <i>tags"]
    assert column(spark, pages, html.parsed_text) == column(spark, pages, html.html_to_text)
    assert column(spark, ["caf&eacute; <p a='>'>x"], html.parsed_text) == ["café x"]


def test_summaries_of_rows_that_share_an_id_or_have_none(spark):
    from pagequarry.operators.terms import summarise_long_texts

    blue = " ".join(f"Blue whales swim {k}." for k in range(40)) + " Krill feeds giants."
    red = " ".join(f"Red apples grow {k}." for k in range(40)) + " Orchards need bees."
    rows = [(1, blue), (1, red), (None, red), (2, "short"), (None, None)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    out = summarise_long_texts(df, "id", "text", limit=100, keep=2).collect()
    assert len(out) == 5
    for row in out:
        if row.text and len(row.text) > 100:
            words = set(row.text_short.split())
            assert words <= set(row.text.split()) and row.text_short != row.text
        else:
            assert row.text_short == row.text
