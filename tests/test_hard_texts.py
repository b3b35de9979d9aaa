"""Texts of a megabyte that are hard for patterns: no stack runs out, and time stays linear."""

import time

import pytest
from pyspark.sql import functions as F

from warcloom.functions import charset, headers, markup, texts, tokens
from warcloom.operators.boilerplate import blocks_of
from warcloom.operators.page_text import title_of, with_page_text
from warcloom.operators.readability import with_reading_ease
from warcloom.plans import steps
from warcloom.plans.run import process

SIZE = 1_000_000
PAGES = {
    "open a": "<p>if x <a " + "b c " * (SIZE // 4),
    "many a": "<a " * (SIZE // 3),
    "quotes": "<a \"<a '" * (SIZE // 8),
    "quoted hrefs": "<a x='href=1' " * (SIZE // 14) + ">",
    "buttons": "<button>" * (SIZE // 8),
    "closed buttons": "<button>x</button>" * (SIZE // 18),
    "headlines": "<h1>x" * (SIZE // 5),
    "tags": "<b class='x' " * (SIZE // 13),
    "comments": "<!-- " * (SIZE // 5),
    "scripts": "<script " * (SIZE // 8),
    "heads": "<head <head>" * (SIZE // 12),
    "titles": "<title >" * (SIZE // 8),
    "blanks": "<p>a" + " " * SIZE + "b",
    "breaks": "<br>" + "\n" * SIZE + "x",
    "blocks": "<p>word " * (SIZE // 8),
    "metas": "<meta x " * (SIZE // 8),
    "references": "&amp" * (SIZE // 4),
}
TEXTS = {
    "numbers": "1," * (SIZE // 2) + "1",
    "digits": "1" * SIZE,
    "times": "1:1 " * (SIZE // 4),
    "signs": "a" + "!" * SIZE + "a",
    "stops": "A. " * (SIZE // 3),
    "blanks after a stop": "end." + " " * SIZE + "x",
    "quotes after a stop": "end." + '"' * SIZE + "x",
    "quotes before a word": "End. " + '"' * SIZE,
    "marks": "é" * (SIZE // 2),
    "wide and narrow": "a\U0001f600" * (SIZE // 3),
    "hyphens": "a-" * (SIZE // 2),
    "apostrophes": "'" * SIZE,
}


@pytest.mark.parametrize("name", PAGES)
def test_pages(spark, name):
    frame = spark.createDataFrame([(PAGES[name], "http://h.cz/a/b.html")], "html string, url string")
    start = time.perf_counter()
    page = with_page_text(frame, {"en": ["the", "of"]}).withColumn("cleaned", markup.clean(F.col("html")))
    page.select(
        "title", "headlines", "links", "language", F.length("plain_text"), title_of(F.col("cleaned")),
        F.size(blocks_of(F.col("cleaned"), F.lit("en"), {"en": ["the"]})),
        charset.declared_charsets(F.encode("html", "UTF-8"), F.lit("text/html")),
    ).collect()
    assert time.perf_counter() - start < 60


@pytest.mark.parametrize("name", TEXTS)
def test_texts(spark, name):
    frame = spark.createDataFrame([(TEXTS[name], "en")], "plain_text string, language string")
    start = time.perf_counter()
    with_reading_ease(frame).select(
        "reading_ease", F.size(tokens.tokens(F.col("plain_text"))), F.size(tokens.sentences(F.col("plain_text"), F.col("language"))),
        F.size(tokens.normalised_words(F.col("plain_text"))), F.length(tokens.stripped_word(F.col("plain_text"))),
        F.length(texts.strip_space(F.col("plain_text"))), F.length(texts.normalise(F.col("plain_text"))),
        F.size(headers.header_map(F.concat(F.lit("HTTP/1.1\r\nA: "), F.col("plain_text")))),
    ).collect()
    assert time.perf_counter() - start < 60


@pytest.mark.parametrize("payload", [PAGES["open a"], "<p>" + TEXTS["numbers"], PAGES["buttons"]], ids=["open a", "numbers", "buttons"])
def test_run(spark, payload):
    fields = {"id": "1", "url": "http://h.cz/", "timestamp": "t", "mime_type": "text/html", "response_code": "200", "warc_filename": "f", "warc_type": "response"}
    row = spark.range(1).select(
        *(F.lit(value).alias(name) for name, value in fields.items()), F.lit(0).cast("long").alias("warc_offset"), F.lit(5).cast("long").alias("warc_record_size"),
        F.lit("").alias("refers_to"), F.lit(False).alias("is_revisit"), F.lit(None).cast("string").alias("scan_error"), F.lit(None).cast("map<string,string>").alias("http_headers"),
        F.lit(bytearray(payload.encode())).alias("content"),
    )
    html = [steps.html_text({"en": ["the"]}), steps.word_tokens(), steps.sentence_tokens(), steps.flesch_reading_ease()]
    start = time.perf_counter()
    assert len(process(row, {"HTML": html}).processed.select("n_words", "links").collect()) == 1
    assert time.perf_counter() - start < 60


def test_numbers_before_numbers(spark):
    text = F.lit("Am 15." + " " * 300 + "2. war es. 3 kamen. Ende 4. Neu 5. \"6\" x.")
    found = spark.range(1).select(tokens.sentences(text, F.lit("de"))).first()[0]
    assert [" ".join(s.split()) for s in found] == ["Am 15. 2. war es.", "3 kamen.", "Ende 4.", "Neu 5.", '"6" x.']


def test_elements_within_elements(spark):
    html = "<object>a<object>b</object>c</object>d<h1>x<h1>y</h1><a href='/1' href='/2' title='href=/3'>z</a><a\nhref = /4>w</a>"
    frame = spark.createDataFrame([(html,)], "html string")
    seen, heads, links = frame.select(markup.visible_markup(F.col("html")), markup.headlines(F.col("html")), markup.hrefs(F.col("html"))).first()
    assert (seen, heads, links) == ("acdxyzw", ["y"], ["/1", "/4"])
