"""Whole pages and blocks, against plain Python on small inputs."""

import random

import pytest
from pyspark.sql import functions as F

from warcloom.functions import markup
from warcloom.operators import boilerplate as bp
from warcloom.operators.page_text import title_of, with_page_text

STOPWORDS = {"cs": ["a", "je", "se", "na", "v"], "en": ["the", "of", "and", "is", "to", "in"]}


def one(spark, html, column):
    frame = spark.createDataFrame([(html, "http://h.cz/a/b.html")], "html string, url string")
    return frame.withColumn("cleaned", markup.clean(F.col("html"))).select(column).first()[0]


def test_title_and_headlines(spark):
    html = """<html><head><!-- <title>no</title> --><script>'<title>no</title>'</script>
    <TITLE lang=en>
      A &amp;amp; B </title><title>second</title></head><body>
    <h2>Two <b>bold</b> tail</h2><h1 class="x">One<br>more</h1><h3> </h3><h1>Last &eacute;<i>x<b>y</b></i></h1></body>"""
    assert one(spark, html, title_of(F.col("cleaned"))) == "A & B"
    found = one(spark, html, markup.headlines(F.col("cleaned")))
    assert found == ["One", "more", "Last é", "Two", "tail"]
    assert one(spark, "<p>x", title_of(F.col("cleaned"))) is None
    assert one(spark, "<p>x", markup.headlines(F.col("cleaned"))) == []


def test_links(spark):
    html = """<a href="/x?a=1&amp;b=2">1</a><A class=y HREF='rel'>2</A><a name=q>3</a><a href=plain.html>4</a>
    <a href="mailto:a@b.cz">5</a><a href="javascript:void(0)">6</a><a href="">7</a><a href="#top">8</a>
    <!-- <a href="/no">9</a> --><a data-href="/no2">10</a><a href="//o.cz">11</a><area href="/no3"><a href="/x?a=1&amp;b=2">12</a>"""
    links = one(spark, html, markup.absolute_links(F.col("cleaned"), F.col("url")))
    assert links == [
        "http://h.cz/x?a=1&b=2",
        "http://h.cz/a/rel",
        "http://h.cz/a/plain.html",
        "http://h.cz/a/b.html#top",
        "http://o.cz",
        "http://h.cz/x?a=1&b=2",
    ]


def test_visible_text(spark):
    html = "<style>s</style><p>One</p><p>Two&nbsp;</p><button>no</button><script>no</script a < b<textarea>no</textarea>!"
    assert one(spark, html, markup.visible_markup(F.col("cleaned"))) == "OneTwo&nbsp;"
    html = "<p>a < b</p><!-- x --><p>c</p>"
    assert one(spark, html, markup.visible_markup(F.col("cleaned"))) == "a < bc"


def test_blocks(spark):
    html = """<head><title>no</title></head><p>one <b>two</b><br>three<br><br>four</p>
    <a href=x><div>in link</div>still</a> out<ul><li><a href=y>item</a> x</li></ul><pre>
    </pre><p-custom>own</p-custom>"""
    blocks = one(spark, html, markup.marked_blocks(markup.block_markup(F.col("cleaned"))))
    assert [tuple(b) for b in blocks] == [
        ("one two three", ""),
        ("four", ""),
        ("in link", "in link"),
        ("still out", "still"),
        ("item x", "item"),
        ("own", ""),
    ]


def revise(classes, distance):
    """The neighbour rules, block by block."""

    def nearest(known, at, step, wanted):
        for k in range(1, distance + 1):
            i = at + step * k
            if 0 <= i < len(known) and known[i] in wanted:
                return known[i]
        return "bad"

    strict, loose = ("good", "bad"), ("good", "bad", "neargood")
    first = list(classes)
    for i, c in enumerate(classes):
        if c == "short":
            p, n = nearest(classes, i, -1, strict), nearest(classes, i, 1, strict)
            pn, nn = nearest(classes, i, -1, loose), nearest(classes, i, 1, loose)
            if p == n:
                first[i] = p
            elif (p == "bad" and pn == "neargood") or (n == "bad" and nn == "neargood"):
                first[i] = "good"
            else:
                first[i] = "bad"
    second = list(first)
    for i, c in enumerate(first):
        if c == "neargood":
            both = nearest(first, i, -1, strict), nearest(first, i, 1, strict)
            second[i] = "bad" if both == ("bad", "bad") else "good"
    return second


@pytest.mark.parametrize("distance", [1, 5, 20])
def test_neighbour_rules(spark, distance):
    chance = random.Random(distance)
    kinds = ["short", "short", "neargood", "good", "bad"]
    rows = [[chance.choice(kinds) for _ in range(chance.randrange(0, 40))] for _ in range(200)]
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, c array<string>")
    revised = bp.revise_neargood(bp.revise_short(F.col("c"), distance), distance)
    found = {r[0]: r[1] for r in frame.select("i", revised).collect()}
    assert [found[i] for i in range(len(rows))] == [revise(r, distance) for r in rows]


GOOD = "The end of the story is in the house and the garden of the king is to the north. " * 3


def page(body):
    return f"<html><head><title>T</title></head><body><div><a href='/m'>Menu</a></div>{body}<p>© Owner</p></body></html>"


def test_page_text_and_fallbacks(spark):
    rows = [
        (1, page(f"<p>{GOOD}</p><p>short one</p><p>{GOOD}</p>")),
        (2, page(f"<p><a href='/x'>{GOOD}</a></p>")),
        (3, page("<p>too short</p>")),
        (4, None),
        (5, page("<p>unbekannte Sprache ohne bekannte Wörter</p>")),
    ]
    frame = spark.createDataFrame([(i, h, "http://h.cz/") for i, h in rows], "i int, html string, url string")
    found = {r["i"]: r for r in with_page_text(frame, STOPWORDS).collect()}
    text = GOOD.strip()
    assert found[1]["language"] == "en" and found[1]["plain_text"] == f"{text}\nshort one\n{text}"
    assert found[2]["plain_text"] == text  # only with links allowed
    assert found[3]["plain_text"] == "" and found[3]["language"] is None
    assert found[4]["plain_text"] is None and found[4]["links"] is None
    assert found[5]["title"] == "T" and found[5]["links"] == ["http://h.cz/m"]
    # a language without a stoplist for blocks gives no text at all
    other = with_page_text(frame, STOPWORDS, {"cs": STOPWORDS["cs"]}).filter("i = 1").first()
    assert other["plain_text"] is None and other["title"] == "T" and other["language"] == "en"


def test_page_text_needs_no_shuffle_and_pushes_filters(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = with_page_text(pages, STOPWORDS).filter("page_id = 3 AND language = 'en'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text
    assert "EqualTo(page_id,3)" in text
    assert "Python" not in text


def test_markup_with_optional_parts(spark):
    from warcloom.functions import markup

    pages = [
        "<head><title></title><title>T</title><body><p>Kept text",
        "<html><head><meta charset=utf-8><p>No body tag either",
        "<body><p>before <iframe src=x> after</p>",
        "<body><a title='a > b' href='/x'>go</a><a href=/y>z</a>",
        "<body><p title=\"it's\">a &lt;b&gt; &amp;lt; &#65;&#x42; &nosuch; 1 & 2</p>",
    ]
    frame = spark.createDataFrame([(p,) for p in pages], "html string").repartition(1)
    from warcloom.functions.texts import decode_entities

    cleaned = markup.clean(F.col("html"))
    rows = frame.select(
        markup.title_markup(cleaned).alias("title"),
        F.transform(markup.marked_blocks(decode_entities(markup.block_markup(cleaned))), lambda b: b["text"]).alias("blocks"),
        markup.hrefs(cleaned).alias("links"),
    ).collect()
    assert rows[0].title == "T" and rows[0].blocks == ["Kept text"]
    assert rows[1].blocks == ["No body tag either"]
    assert rows[2].blocks == ["before after"]
    assert rows[3].links == ["/x", "/y"]
    assert rows[4].blocks == ["a <b> &lt; AB &nosuch; 1 & 2"]


def test_every_declared_charset_is_weighed(spark):
    from warcloom.operators.page_text import charset_of

    body = '<meta charset="utf-8">'.encode() + "café élève".encode("iso-8859-1")
    frame = spark.createDataFrame([(body, "text/html; charset=iso-8859-1")], "b binary, t string")
    assert frame.select(charset_of(F.col("b"), F.col("t"))["charset"]).first()[0] == "iso-8859-1"
