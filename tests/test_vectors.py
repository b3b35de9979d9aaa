"""Known results of single expressions."""

import re

import pytest
from pyspark.sql import functions as F

from warcloom.functions import charset as cs
from warcloom.functions import headers
from warcloom.functions import tokens as tk
from warcloom.functions.texts import decode_entities, normalise
from warcloom.functions.urls import resolve, url_key
from warcloom.operators import gates
from warcloom.operators import language as lg
from warcloom.operators import records as rec
from warcloom.operators.classify import page_type
from warcloom.operators.page_text import charset_of


def values(spark, rows, schema, *columns):
    """Results of expressions over one-row inputs, in order."""
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {schema}")
    picked = frame.select("i", *(c.alias(f"r{n}") for n, c in enumerate(columns))).orderBy("i").collect()
    return [row[1] if len(columns) == 1 else tuple(row)[1:] for row in picked]


def test_harvest_info(spark):
    long = "MigrantCrisisEU-2015-02-20160220233522082-00275-8523~crawler00.example.cz~7778.warc.gz"
    names = [
        long,
        "/some/path/" + long,
        "CZ-2015-12-20151224071107633-01001-11606~crawler18.example.cz~7778.warc.gz",
        "Test-2019-06-30-cc-naki-crawler00-20190701115137757-00008-12296~crawler00.example.cz~7778.warc.gz",
        "",
        "invalid/filename",
    ]
    found = values(spark, [(n,) for n in names], "n string", rec.harvest_info(F.col("n")))
    assert [tuple(x) for x in found] == [
        ("MigrantCrisisEU-2015-02", "MigrantCrisisEU", "20160220"),
        ("MigrantCrisisEU-2015-02", "MigrantCrisisEU", "20160220"),
        ("CZ-2015-12", "CZ", "20151224"),
        ("Test-2019-06-30-cc-naki-crawler00", "Test", "20190701"),
        ("", "", ""),
        ("", "", ""),
    ]


def test_base64(spark):
    rows = [(b"Python is fun",), (b"",), (bytes(range(256)) * 3,)]
    import base64

    encoded = values(spark, rows, "b binary", rec.content_base64(F.col("b")))
    assert encoded == [base64.b64encode(row[0]).decode() for row in rows]
    back = values(spark, [(e,) for e in encoded] + [("?",), (None,)], "s string", rec.content_bytes(F.col("s")))
    assert [bytes(b) for b in back] == [row[0] for row in rows] + [b"", b""]


def test_byte_order_marks(spark):
    marks = {
        b"text": None,
        b"\xef\xbb\xbftext": "utf-8-sig",
        b"\xfe\xfftext": "utf-16-be",
        b"\xff\xfetext": "utf-16-le",
        b"\x00\x00\xfe\xfftext": "utf-32-be",
        b"\xff\xfe\x00\x00text": "utf-32-le",
    }
    assert values(spark, [(m,) for m in marks], "b binary", cs.bom_charset(F.col("b"))) == list(marks.values())


CZECH = "Žluťoučký kůň pěl ďábelské ódy. Příliš žluťoučký kůň úpěl."


def test_charset_guess(spark):
    expected = [
        ("Žluťoučký kůn".encode("ascii", "replace"), "ascii"),
        ("Žluťoučký kůn".encode("utf-8"), "utf-8"),
        ("Žluťoučký kůn".encode("cp1250"), "cp1250"),
        ("Žluťoučký kůn".encode("iso-8859-2"), "iso-8859-2"),
        (CZECH.encode("utf-8"), "utf-8"),
        (CZECH.encode("cp1250"), "cp1250"),
        (CZECH.encode("iso-8859-2"), "iso-8859-2"),
        (CZECH.encode("cp852"), "cp852"),
        (CZECH.encode("utf-16"), "utf-16"),
        (b"plain ascii text", "ascii"),
        (b"x", "ascii"),
        (b"x" * 1_000_001 + CZECH.encode("utf-8"), "utf-8"),  # the whole payload counts, not its start
        (b"", None),
    ]
    found = values(spark, [(c,) for c, _ in expected], "b binary", cs.guess_charset(F.col("b")))
    assert found == [name for _, name in expected]


def test_decode_like_python(spark):
    names = ["utf-8", "cp1250", "iso-8859-2", "cp1251", "cp1252", "cp852", "utf-16", "utf-8-sig", "ascii", "utf-16-le"]
    rows = [(CZECH.encode(n, errors="replace"), n) for n in names]
    rows += [(b"\xff\xfea\x00b\x00", "utf-16"), (b"\xfe\xff\x00a", "utf-16"), (b"a\xffb\xc3", "utf-8"), (b"\x98\x81", "cp1251")]
    found = values(spark, rows, "b binary, n string", cs.decode(F.col("b"), F.col("n")))
    assert found == [b.decode(n, errors="replace") for b, n in rows]


def test_charset_choice(spark):
    page = "<html><head><meta http-equiv='x' content='text/html; charset=%s'></head><p>" + CZECH
    rows = [
        (b"\xef\xbb\xbf" + (page % "cp1250").encode("utf-8"), "text/html; charset=iso-8859-2"),
        ((page % "windows-1250").encode("cp1250"), "text/html"),
        ((page % "utf-8").encode("cp1250"), 'text/html; charset="windows-1250"'),
        (CZECH.encode("cp1250"), "text/html"),
        (CZECH.encode("utf-8"), "text/html; charset=made-up-enc"),
        (("<?xml version='1.0' encoding='ISO-8859-2'?>" + CZECH).encode("iso-8859-2"), None),
    ]
    found = values(spark, rows, "b binary, t string", charset_of(F.col("b"), F.col("t")))
    assert [tuple(f) for f in found] == [
        ("utf-8-sig", "bom"),
        ("windows-1250", "declared"),
        ("cp1250", "resolved"),
        ("cp1250", "guessed"),
        ("utf-8", "guessed"),
        ("iso-8859-2", "declared"),
    ]


def test_known_charsets(spark):
    names = ["cp1250", "made-up-enc", "UTF8", "Windows-1250", "latin-1", "utf_8"]
    found = values(spark, [(n,) for n in names], "n string", cs.java_charset(F.col("n")))
    assert found == ["windows-1250", None, "UTF-8", "windows-1250", "ISO-8859-1", "UTF-8"]


def test_stripped_words(spark):
    words = {".-%text!>_": "text", "te_*xt*": "te_*xt", "*text12*": "text12", "***": "", "Ěž!": "Ěž"}
    assert values(spark, [(w,) for w in words], "w string", tk.stripped_word(F.col("w"))) == list(words.values())
    text = ".-%text!>_ te_*xt* *text12* *** Ěž! X y\x1cZ..."
    expected = ["text", "te_*xt", "text12", "ěž", "x", "y", "z"]
    assert values(spark, [(text,)], "t string", tk.normalised_words(F.col("t"))) == [expected]


def test_headers(spark):
    block = "HTTP/1.1 302 Found\r\nA: 1\r\nLocation: /x\r\nA: 2\r\n  more\r\ncontent-type: text/html\r\nNo value"
    parsed = values(spark, [(block,), (None,)], "b string", headers.header_map(F.col("b")), headers.status_code(F.col("b")))
    assert parsed == [({"A": "2  more", "Location": "/x", "content-type": "text/html"}, "302"), ({}, "")]


def test_record_fields(spark):
    ids = values(
        spark,
        [("<urn:uuid:fbd6cf0a>", "f", 1), (None, "f", 1), ("", "f", 2), (None, "f", 1)],
        "r string, f string, o long",
        rec.record_id(F.col("r"), F.col("f"), F.col("o")),
    )
    assert ids[0] == "urn:uuid:fbd6cf0a" and ids[1] == ids[3] != ids[2]
    assert all(re.fullmatch("urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", i) for i in ids[1:])
    digits = [("569874",), ("unsupported_type",), ("",), (None,), ("12.5",), ("99999999999999999999",)]
    assert values(spark, digits, "v string", rec.integer_field(F.col("v"))) == [569874] + [None] * 5
    moved = [("/a", "302"), ("/a", "201"), ("/a", "200"), ("/a", None), ("", "302"), (None, "301"), ("/a", "3021")]
    assert values(spark, moved, "l string, s string", rec.redirect_url(F.col("l"), F.col("s"))) == ["/a", "/a"] + [None] * 5


def test_url_key(spark):
    urls = {
        "http://www.Example.com:80/Path/?b=2&a=1#x": "http://example.com/path?a=1&b=2",
        "https://user:pw@www2.example.com:443/?": "https://example.com/",
        "https://example.com:8080": "https://example.com:8080/",
        "mailto:A@b.c": "mailto:a@b.c",
        "": "-",
    }
    assert values(spark, [(u,) for u in urls], "u string", url_key(F.col("u"))) == list(urls.values())


def test_links_like_urljoin(spark):
    from urllib.parse import urljoin

    bases = ["http://h.cz/a/b/c.html?q=1", "https://h.cz", "http://h.cz/", "http://h.cz/d/e/"]
    found = "x /x //o.cz/y ?z=1 ../up ../../../top ./here . .. a/./b/../c /a/../b/. http://full.cz/p?q#f x#frag a//b sub/".split()
    rows = [(r, b) for b in bases for r in found]
    assert values(spark, rows, "r string, b string", resolve(F.col("r"), F.col("b"))) == [urljoin(b, r) for r, b in rows]


def test_entities(spark):
    import html

    texts = ["a &amp; b", "&lt;&eacute;&#233;&#xE9;&#x1F600;", "&amp;lt; &amp;amp;", "none", "&unknown; &copy;", "&#38;#38;", "&apos;&nbsp;x"]
    assert values(spark, [(t,) for t in texts], "t string", decode_entities(F.col("t"))) == [html.unescape(t) for t in texts]
    assert values(spark, [(" a\n\t&amp;amp;  b ",)], "t string", normalise(F.col("t"))) == ["a & b"]


def test_tokens(spark):
    texts = {
        "Dobrý den, toto je test.": ["Dobrý", "den", ",", "toto", "je", "test", "."],
        ".": ["."],
        "První řádek.\nDruhý řádek.": ["První", "řádek", ".", "Druhý", "řádek", "."],
        "C'est un test.": ["C'est", "un", "test", "."],
    }
    assert values(spark, [(t,) for t in texts], "t string", tk.tokens(F.col("t"))) == list(texts.values())
    assert values(spark, [(None,)], "t string", tk.tokens(F.col("t"))) == [[]]


def test_sentences(spark):
    rows = {
        ("Dobrý den. Toto je test.", "cs"): ["Dobrý den.", "Toto je test."],
        ("Přijdu 15.2.2023, tzn. v pondělí.", None): ["Přijdu 15.2.2023, tzn. v pondělí."],
        ("Dne 15. 2. 2023 přišel Dr. Novák. Odešel!", "cs"): ["Dne 15. 2. 2023 přišel Dr. Novák.", "Odešel!"],
        ("Mr. Smith met J. R. Doe. \"Why?\" Nobody knew.", "en"): ["Mr. Smith met J. R. Doe.", "\"Why?\"", "Nobody knew."],
        ("Das ist z.B. Prof. Dr. Maier. Ja.", "de"): ["Das ist z.B. Prof. Dr. Maier.", "Ja."],
        ("", "en"): [],
        (" \n ", "en"): [],
        (None, None): [],
    }
    frame = [(t, l) for t, l in rows]
    both = values(
        spark, frame, "t string, l string", tk.sentences(F.col("t"), F.col("l")), tk.sentence_count(F.col("t"), F.col("l"))
    )
    assert [b[0] for b in both] == list(rows.values())
    assert [b[1] or 0 for b in both] == [len(r) for r in rows.values()]


def test_syllables(spark):
    words = {
        ("Dobrý", "den", "toto", "je", "test"): 7,
        ("nejneobhospodařovávatelnějšímu",): 13,
        ("žluto-modrý", "kůň"): 5,
        ("-",): 2,
        ("vlk", "psst"): 2,
        (): 0,
    }
    rows = [(list(w), "cs") for w in words]
    assert values(spark, rows, "w array<string>, l string", tk.syllable_count(F.col("w"), F.col("l"))) == list(words.values())


def test_reading_ease(spark):
    rows = [(10, 50, 100), (2, 5, 7), (1, 1, 1), (1, 0, 0), (0, 0, 0)]
    found = values(spark, rows, "s int, w int, y int", tk.reading_ease(F.col("s"), F.col("w"), F.col("y")))
    assert [None if f is None else round(f, 8) for f in found] == [32.56, 85.8575, 121.22, None, None]


def test_text_statistics(spark):
    texts = {
        None: (0, 0, 0, None),
        "Dobrý den. Toto je test.": (2, 5, 7, 85.8575),
        "a": (1, 1, 1, 121.22),
        ",": (1, 0, 0, None),
        "10": (1, 1, 1, 121.22),
        "@ % + *": (1, 0, 0, None),
    }
    found = values(
        spark, [(t,) for t in texts], "t string", tk.text_statistics(F.col("t"), F.lit(None).cast("string"))
    )
    assert [(a, b, c, d if d is None else round(d, 8)) for a, b, c, d in found] == list(texts.values())


def test_page_type(spark):
    urls = {
        "https://www.idnes.cz/zpravy/domaci/x": "news",
        "https://www.vari.cz/rady-a-navody/diskusni-forum/?thId=3681": "forum",
        "https://www.alza.cz/siguro.htm": "eshop",
        "https://www.idnes.cz/forum": "news",
        "https://example.com/": "others",
        None: None,
    }
    assert values(spark, [(u,) for u in urls], "u string", page_type(F.col("u"))) == list(urls.values())


@pytest.mark.parametrize(
    "ratio, count, expected", [(1, 0, None), (0.51, 0, None), (0.5, 0, "cs"), (0, 0, "cs"), (0, 2, "cs"), (0, 3, None)]
)
def test_language_limits(spark, ratio, count, expected):
    guess = lg.language_of(F.col("t"), {"cs": ["a", "b"]}, ratio, count)
    assert values(spark, [("Foo bar a b.",)], "t string", guess) == [expected]


def test_language_ties_and_blanks(spark):
    lists = {"sk": ["je"], "cs": ["je"], "en": ["is", "it"]}
    rows = [("je je je",), ("is it is je je je it",), ("",), (None,), ("nothing known here",)]
    assert values(spark, rows, "t string", lg.language_of(F.col("t"), lists)) == ["sk", "en", None, None, None]


def test_mime_groups(spark):
    types = {"text/html": "HTML", "TEXT/HTMLX": "HTML", "application/xhtml+xml": "HTML", "application/pdf": "PDF",
             "image/png": "IMG", "imagemap": "IMG", "video/mp4": None, "": None, None: None}
    assert values(spark, [(t,) for t in types], "t string", gates.mime_group(F.col("t"))) == list(types.values())


def test_numbers_are_one_token(spark):
    text = "At 12:30 it was 3.14, not 1,000."
    assert values(spark, [(text,)], "t string", tk.tokens(F.col("t"))) == [
        ["At", "12:30", "it", "was", "3.14", ",", "not", "1,000", "."]
    ]
    assert values(spark, [(text,)], "t string", tk.words_of(F.col("t"))) == [["At", "it", "was", "not"]]
