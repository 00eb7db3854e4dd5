from pyspark.sql import functions as F

from paperloom.functions.html import combined_text, html_to_text, plain_text
from paperloom.functions.text import clean, collapse_space, sections_long, split_sections, strip_tags
from paperloom.operators.fulltext import parse_payloads


def test_strip_tags_eats_less_than_signs_too(value):
    assert value(strip_tags, ["a<b>c", "p < 0.05 and q > 3", None]) == ["a c", "p   3", ""]


def test_collapse_space_knows_unicode_space(value):
    got = value(collapse_space, [" a \n b\x1c　c ", None, "\x1f"])
    assert got == ["a b c", "", ""]


def test_clean(value):
    assert value(clean, ["<p>p < 0.05 and q > 3</p>", "<b>x</b>\ny"]) == ["p 3", "x y"]


def test_sections(value):
    got = value(
        split_sections,
        [
            "Pre Abstract one. Methods two. Results three. RESULTS four ",
            "Materials and Methods: x",
            "no heading <b>here</b>",
            "resultsX",
            None,
            "Method a methods b",
        ],
    )
    assert got == [
        {"abstract": "one.", "methods": "two.", "results": "four"},
        {"materials_and_methods": ": x"},
        {"body": "no heading here"},
        {"results": "X"},
        {"body": ""},
        {"method": "a", "methods": "b"},
    ]


def test_sections_long(spark):
    df = spark.createDataFrame([(1, "Abstract a Results b")], "id int, t string")
    rows = sections_long(df.select("id", split_sections(F.col("t")).alias("sections"))).collect()
    assert {tuple(r) for r in rows} == {(1, "abstract", "a"), (1, "results", "b")}


def test_html_entities_are_decoded_once(value):
    html = "<p>5 &lt; 6 &amp;lt; &#955; &#x3BB; &nosuch; AT&T &apos;&eacute;&#0;</p>"
    assert value(html_to_text, [html]) == [" 5 < 6 &lt; λ λ &nosuch; AT&T 'é&#0; "]


def test_html_leaves_out_what_is_not_shown(value):
    html = (
        "<!DOCTYPE html><html><head><style>p{}</style><SCRIPT>var t='</p>';</SCRIPT></head>"
        "<body><!-- a > b --><h1 title='x > y'>Head</h1><p>p < 0.05 <b>bold</b>text</body></html>"
    )
    assert value(plain_text, [html]) == ["Head p < 0.05 bold text"]


def test_text_that_is_no_markup_keeps_entities(value):
    assert value(plain_text, ["a &lt; b", " \n<i>a &lt; b</i>", None]) == ["a &lt; b", "a < b", ""]


def test_combined_text_skips_empty_parts(spark):
    rows = [("A <b>x</b>", "<p>F</p>"), (None, "F"), ("A", ""), (None, None)]
    df = spark.createDataFrame(rows, "a string, f string")
    got = [r[0] for r in df.select(combined_text(F.col("a"), F.col("f"))).collect()]
    assert got == ["A x F", "F", "A", ""]


def test_parse_payload_with_html(spark):
    full = "<html><body><h1>Methods</h1><p>DSPC with cholesterol.</p></body></html>"
    df = spark.createDataFrame([("Abstract of it", full)], "abstract string, fulltext string")
    row = parse_payloads(df).first()
    assert row["abstract_or_body"] == "Abstract of it Methods DSPC with cholesterol."
    assert row["sections"] == {"abstract": "of it", "methods": "DSPC with cholesterol."}


def test_comments_and_raw_text_hide_each_other_in_order(value):
    from paperloom.functions.html import plain_text

    cases = {
        "<p>a</p><!-- <script> old --> visible <script>x()</script> end": "a visible end",
        "<script>var a = '<!--';</script> b <style>c</style>": "b",
        "<p>a</p><script>never closed <p>b": "a",
        "<p>a<!-- never closed <p>b": "a",
        "<p>&copy 2024 a&nbsp b &amp z &ampx &unknown;</p>": "© 2024 a b & z &x &unknown;",
        "<p>&#0000000000000000000065; &#x00000000000000041; &#99999999999999999999; &#xD800;</p>":
            "A A &#99999999999999999999; &#xD800;",
    }
    assert value(plain_text, list(cases)) == list(cases.values())
