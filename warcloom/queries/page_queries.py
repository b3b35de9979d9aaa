"""Pages: charsets, text, links, boilerplate."""

from __future__ import annotations

from pyspark.sql import functions as F

from warcloom.fixed_values import BOILERPLATE_BASE
from warcloom.functions import charset as cs
from warcloom.functions.binding import let
from warcloom.functions.markup import absolute_links, headlines
from warcloom.functions.markup import visible_markup
from warcloom.functions.texts import decode_entities
from warcloom.operators.boilerplate import blocks_of, classes_of, with_fallback
from warcloom.operators.page_text import (
    page_language_of,
    title_of,
    with_charset,
    with_cleaned,
    with_html,
    with_page_text,
)
from warcloom.operators.readability import with_reading_ease
from warcloom.queries.catalog import query, table
from warcloom.queries.inputs import STOPLIST_WORDS, stoplists
from warcloom.queries.oracle_parts import (
    CLEANED,
    PLAIN_TEXT,
    VISIBLE,
    block_classes,
    decoded,
    guessed_charsets,
    language_of,
    page_blocks,
    squeezed,
    stoplist,
    text_statistics,
)


def cleaned_pages(spark, sf_dir):
    return with_cleaned(table(spark, sf_dir, "pages"))


def pages_with_blocks(spark, sf_dir):
    lists = stoplists(spark, sf_dir)
    blocks = let(
        F.col("cleaned"), lambda cleaned: blocks_of(cleaned, page_language_of(cleaned, lists), lists)
    )
    return cleaned_pages(spark, sf_dir).select("page_id", blocks.alias("blocks"))


@query(
    """WITH marked AS (
  SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'EFBBBF' WHEN 1 THEN '0000FEFF' WHEN 2 THEN 'FFFE0000'
    WHEN 3 THEN 'FEFF' WHEN 4 THEN 'FFFE' ELSE '' END AS mark, html FROM pages
)
SELECT page_id, md5(mark || hex(encode(html))) AS payload, CASE mark WHEN 'EFBBBF' THEN 'utf-8-sig'
  WHEN '0000FEFF' THEN 'utf-32-be' WHEN 'FFFE0000' THEN 'utf-32-le' WHEN 'FEFF' THEN 'utf-16-be'
  WHEN 'FFFE' THEN 'utf-16-le' END AS charset FROM marked"""
)
def bom_charset(spark, sf_dir):
    marks = ["EFBBBF", "0000FEFF", "FFFE0000", "FEFF", "FFFE", ""]
    mark = F.element_at(F.array(*map(F.lit, marks)), (F.col("page_id") % 6 + 1).cast("int"))
    marked = table(spark, sf_dir, "pages").select(
        "page_id", F.concat(F.unhex(mark), F.encode("html", "UTF-8")).alias("content")
    )
    return marked.select(
        "page_id", F.md5(F.hex("content")).alias("payload"), cs.bom_charset(F.col("content")).alias("charset")
    )


@query(
    """SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'iso-8859-2,utf-8,windows-1250' WHEN 1 THEN 'utf-8,windows-1250'
  ELSE 'utf-8' END AS declared FROM pages"""
)
def declared_charset(spark, sf_dir):
    # pages declare utf-8 in a meta tag; header and XML declaration are set in front of them
    html = F.when(F.col("page_id") % 3 < 2, F.concat(F.lit(' <?xml version="1.0" encoding="Windows-1250"?>'), "html"))
    header = (
        F.when(F.col("page_id") % 3 == 0, 'text/html; Charset="ISO-8859-2"')
        .when(F.col("page_id") % 3 == 1, "text/html; charset=no-such-charset")
        .otherwise("text/html")
    )
    payload = F.encode(F.coalesce(html, F.col("html")), "UTF-8")
    return table(spark, sf_dir, "pages").select(
        "page_id", F.array_join(cs.declared_charsets(payload, header), ",").alias("declared")
    )


# Pages declare utf-8; without that, and in another charset, the bytes must be guessed.
RECODED = ["utf-8", "cp1250", "iso-8859-2", "utf-16-le"]


def recoded_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.replace("html", F.lit('<meta charset="utf-8">')).alias("html"))
    name = F.element_at(
        F.array(*map(F.lit, ["utf-8", "windows-1250", "ISO-8859-2", "UTF-16LE"])), (F.col("page_id") % 4 + 1).cast("int")
    )
    return pages.select(
        "page_id",
        "html",
        F.call_function("encode", "html", name).alias("content"),
        F.lit(None).cast("string").alias("content_type"),
    )


@query(guessed_charsets(dict(enumerate(RECODED))))
def charset_guess(spark, sf_dir):
    guessed = with_charset(recoded_pages(spark, sf_dir))
    return guessed.select("page_id", "charset", "charset_origin")


@query(
    """SELECT page_id, CAST(octet_length(encode(html)) - length(html) + length(regexp_replace(html, '[\\x00-\\x7f]', '', 'g'))
  AS BIGINT) AS ascii_errors, 0::BIGINT AS utf8_errors FROM pages"""
)
def decode_errors(spark, sf_dir):
    # read as ASCII, every byte of a non-ASCII character is one error
    pages = table(spark, sf_dir, "pages").select("page_id", F.encode("html", "UTF-8").alias("content"))
    as_ascii = with_html(pages.withColumn("charset", F.lit("ascii"))).withColumnRenamed("decode_errors", "ascii_errors")
    both = with_html(as_ascii.drop("html").withColumn("charset", F.lit("utf-8")))
    return both.select(
        "page_id",
        F.col("ascii_errors").cast("bigint").alias("ascii_errors"),
        F.col("decode_errors").cast("bigint").alias("utf8_errors"),
    )


@query(f"WITH {CLEANED}, {VISIBLE} SELECT page_id, visible FROM visible")
def page_text(spark, sf_dir):
    declared = F.concat(F.lit(' <?xml version="1.0"?>\n'), "html")
    content = table(spark, sf_dir, "pages").select("page_id", F.encode(declared, "UTF-8").alias("content"))
    pages = with_cleaned(with_html(content.withColumn("charset", F.lit("utf-8"))))
    raw = pages.select("page_id", visible_markup(F.col("cleaned")).alias("raw"))
    return raw.select("page_id", decode_entities(F.col("raw")).alias("visible"))


@query(
    f"""WITH {CLEANED} SELECT page_id,
  {squeezed(decoded("regexp_extract(cleaned, '(?is)<title[^>]*>(.*?)</title', 1)"))} AS title FROM cleaned"""
)
def page_title(spark, sf_dir):
    return cleaned_pages(spark, sf_dir).select("page_id", title_of(F.col("cleaned")).alias("title"))


@query(
    f"""WITH {CLEANED}, found AS (
  SELECT page_id, level, unnest(texts) AS text, unnest(range(1, len(texts) + 1)) AS place FROM (
    SELECT page_id, level, regexp_extract_all(cleaned, '(?is)<h' || level || '[^>]*>(.*?)</h' || level || '>', 1) AS texts
    FROM cleaned, (SELECT unnest(range(1, 7)) AS level)))
SELECT page_id, string_agg({squeezed(decoded('text'))}, ' | ' ORDER BY level, place) AS headlines
FROM found GROUP BY page_id"""
)
def page_headlines(spark, sf_dir):
    return cleaned_pages(spark, sf_dir).select(
        "page_id", F.array_join(headlines(F.col("cleaned")), " | ").alias("headlines")
    )


@query(
    f"""WITH {CLEANED}, found AS (
  SELECT page_id, url, unnest(hrefs) AS href, unnest(range(1, len(hrefs) + 1)) AS place
  FROM (SELECT page_id, url, regexp_extract_all(cleaned, '(?is)<a href="([^"]+)"', 1) AS hrefs FROM cleaned))
SELECT page_id, place - 1 AS pos, regexp_extract(url, '^[a-z]+://[^/?#]+', 0) || {decoded('href')} AS link FROM found"""
)
def page_links(spark, sf_dir):
    links = cleaned_pages(spark, sf_dir).select(
        "page_id", F.posexplode_outer(absolute_links(F.col("cleaned"), F.col("url"))).alias("pos", "link")
    )
    return links.filter("pos IS NOT NULL").select("page_id", F.col("pos").cast("bigint").alias("pos"), "link")


@query(
    f"""WITH {page_blocks(STOPLIST_WORDS)}
SELECT page_id, pos, text, length, link_length, n_words, n_stopwords FROM blocks"""
)
def boilerplate_blocks(spark, sf_dir):
    blocks = pages_with_blocks(spark, sf_dir).select("page_id", F.posexplode_outer("blocks").alias("pos", "b"))
    numbers = [F.col(f"b.{name}").cast("bigint").alias(name) for name in ["length", "link_length", "n_words", "n_stopwords"]]
    return blocks.filter("pos IS NOT NULL").select("page_id", F.col("pos").cast("bigint").alias("pos"), "b.text", *numbers)


@query(
    f"""WITH {page_blocks(STOPLIST_WORDS)}, {block_classes('base', 0.4, 5)}, {block_classes('far', 0.4, 20)}
SELECT page_id, pos, base.class AS class, far.class AS far_class FROM base JOIN far USING (page_id, pos)"""
)
def boilerplate_classes(spark, sf_dir):
    both = pages_with_blocks(spark, sf_dir).select(
        "page_id",
        classes_of(F.col("blocks")).alias("classes"),
        classes_of(F.col("blocks"), BOILERPLATE_BASE | {"max_good_distance": 20}).alias("far_classes"),
    )
    zipped = both.select("page_id", F.posexplode_outer(F.arrays_zip("classes", "far_classes")).alias("pos", "c"))
    return zipped.filter("pos IS NOT NULL").select(
        "page_id",
        F.col("pos").cast("bigint").alias("pos"),
        F.col("c.classes").alias("class"),
        F.col("c.far_classes").alias("far_class"),
    )


@query(
    f"""WITH {page_blocks(STOPLIST_WORDS)}, {PLAIN_TEXT}
SELECT page_id, max(setting) AS setting, count(*) FILTER (WHERE class = 'good') AS n_good
FROM pages LEFT JOIN chosen USING (page_id) GROUP BY page_id"""
)
def boilerplate_fallback(spark, sf_dir):
    chosen = pages_with_blocks(spark, sf_dir).select("page_id", with_fallback(F.col("blocks")).alias("chosen"))
    n_good = F.size(F.filter("chosen.classes", lambda c: c == "good")).cast("bigint")
    return chosen.select(
        "page_id", F.col("chosen.setting").alias("setting"), F.coalesce(n_good, F.lit(0)).alias("n_good")
    )


@query(
    f"""WITH {page_blocks(STOPLIST_WORDS)}, {PLAIN_TEXT} SELECT page_id, language, plain_text FROM plain"""
)
def page_plain_text(spark, sf_dir):
    texts = with_page_text(table(spark, sf_dir, "pages"), stoplists(spark, sf_dir))
    return texts.select("page_id", "language", "plain_text")


@query(
    f"""WITH {stoplist(STOPLIST_WORDS)}, {CLEANED}, {VISIBLE}, {language_of('visible', 'page_id', 'visible')}
SELECT key AS page_id, language FROM guessed"""
)
def page_language(spark, sf_dir):
    language = page_language_of(F.col("cleaned"), stoplists(spark, sf_dir))
    return cleaned_pages(spark, sf_dir).select("page_id", language.alias("language"))


@query(
    f"""WITH {page_blocks(STOPLIST_WORDS)}, {PLAIN_TEXT}, {text_statistics('plain', 'page_id', 'plain_text', 'language')}
SELECT p.page_id, p.url, n_sentences, n_words, n_syllables, reading_ease
FROM statistics s JOIN pages p ON p.page_id = s.key"""
)
def reading_ease(spark, sf_dir):
    texts = with_page_text(table(spark, sf_dir, "pages"), stoplists(spark, sf_dir))
    scored = with_reading_ease(texts)
    return scored.select(
        "page_id",
        "url",
        *(F.col(name).cast("bigint").alias(name) for name in ["n_sentences", "n_words", "n_syllables"]),
        F.round("reading_ease", 6).alias("reading_ease"),
    )
