import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.functions import web as U
from textloom.operators import chunking as C


def one(spark, column, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(column.alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("f", "value", "want"),
    [
        (T.tokens, "It's 3 PM, Ünal", ["it", "s", "3", "pm", "nal"]),
        (T.tokens, "", []),
        (T.tokens, None, None),
        (T.slug, "  Héllo World--9! ", "h_llo_world_9"),
        (T.collapse_white, " a  b\n\tc ", "a b c"),
        (T.strip_tags, "<b>Hi</b><br/>you", "Hi you"),
        (T.sentences, "One. Two!  Three? 3.5 mg", ["One.", "Two!", "Three?", "3.5 mg"]),
        (T.word_count, "  a b\nc ", 3),
        (T.word_count, "   ", 0),
        (T.normal_license, " CC BY ", "cc-by"),
        (T.first_line, "abc\ndef", "abc"),
        (T.domain_of_name, "Final_Extension_2.docx", "women_health_extension"),
        (T.organisation, "https://www.nhs.uk/x", "NHS"),
        (T.topics, "PCOS and Thyroid", ["pcos_endocrine", "endocrine"]),
        (T.topics, "nothing here", ["women_health_general"]),
        (U.canonical, "https://A.Example/x/?utm_term=1&b=2&utm_source=q#f", "https://a.example/x?b=2&utm_source=q"),
        (U.canonical, "https://a.example/", "https://a.example/"),
        (U.canonical, "not a url", "not a url"),
        (U.netloc, "HTTP://Host.example:80/p", "host.example:80"),
        (U.domain, "https://www.a.example/x", "a.example"),
        (U.host_suffixes, "www.a.b.c", ["a.b.c", "b.c", "c"]),
        (U.blocked, "https://a.example/f.PDF", True),
        (U.blocked, "https://a.example/page", False),
    ],
)
def test_golden(spark, f, value, want):
    assert one(spark, f(F.col("x")), value) == want


def test_clean_keeps_a_text_that_would_vanish(spark):
    text = "Reported age: 33. Reported age: 33."
    assert tuple(one(spark, T.clean(F.col("x")), text)) == (text, 2)
    got = one(spark, T.clean(F.col("x")), "Drink water. drink WATER. This can be within normal variation for you. Rest.")
    assert tuple(got) == ("Drink water. Rest.", 2)


def test_links_and_paragraphs(spark):
    html = "<p>short</p><p class='a'>A paragraph of more than twenty letters</p><a href='/b'>x</a><a href=\"javascript:1\">y</a>"
    assert one(spark, U.html_paragraphs(F.col("x")), html) == ["A paragraph of more than twenty letters"]
    assert one(spark, U.html_links(F.col("x")), html) == ["/b"]


def pack(paras, limit):
    done, buf, size = [], [], 0
    for p in paras:
        if size and size + 1 + len(p) > limit:
            done.append("\n".join(buf))
            buf, size = [p], len(p)
        else:
            buf.append(p)
            size += len(p) + 1
    return [*done, "\n".join(buf)] if buf else done


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.text("ab ", max_size=30).map(str.strip).filter(bool), max_size=8), min_size=1, max_size=6))
def test_packing_equals_a_loop(spark, docs):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, p array<string>")
    got = {r["i"]: r["c"] for r in df.select("i", C.pack_paragraphs(F.col("p"), 40).alias("c")).collect()}
    assert got == {i: pack(d, 40) for i, d in enumerate(docs)}


def test_chunks_keep_every_paragraph(spark):
    text = "\n\n".join(f"paragraph {k} " + "x" * (k * 37 % 300) for k in range(40))
    rows = C.chunks(spark.createDataFrame([("Doc 1", text)], "k string, t string"), F.col("k"), F.col("t"), "MD_").orderBy("chunk_no").collect()
    assert rows[0]["chunk_id"] == "MD_doc_1_001"
    assert [p for r in rows for p in r["text"].split("\n")] == [p.strip() for p in text.split("\n\n")]


def test_distinct_ignoring_case_keeps_the_first(spark):
    assert one(spark, T.distinct_ignoring_case(F.col("x")), ["B", "a", "b", "A", "c"], "x array<string>") == ["B", "a", "c"]


def test_token_pattern_is_ascii(spark):
    text = "K ſ İ x"
    assert one(spark, T.tokens(F.col("x")), text) == re.findall("[a-z0-9]+", text.lower())


def test_comments_scripts_entities_and_bare_links(spark):
    page = """<!-- <h1>old</h1> <a href="/c"> --><script>var a = '<a href="/s"><p>a text of a script, long enough</p>';</script><h1 class=x>Rest &amp; sleep</h1>
<p>More than twenty letters &lt;here&gt; in a row</p><a class="b" href=/bare>x</a><a data-href="/no" href='/q?a=1&amp;b=2'>y</a><A HREF="mailto:a@b">m</A>"""
    row = spark.createDataFrame([(page, "https://a.example/d/")], "h string, u string").select(
        U.html_title(F.col("h"), F.col("u")).alias("t"), U.html_paragraphs(F.col("h")).alias("p"), U.html_links(F.col("h")).alias("l"), U.first_links(F.col("h"), F.col("u"), 1).alias("f")
    ).first()
    assert row["t"] == "Rest & sleep" and row["p"] == ["More than twenty letters <here> in a row"]
    assert row["l"] == ["/bare", "/q?a=1&b=2"] and row["f"] == ["https://a.example/bare"]
