"""SQL fragments that several oracles share. They restate operators on exploded rows, with joins and windows."""

from warcloom.fixed_values import BLOCK_TAGS, CZECH_LETTERS, DEFAULT_CHARSETS, EMBEDDED_TAGS, STOPLIST_IGNORED, STOPLIST_STRIP_CHARS

SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


IGNORED_ROWS = ", ".join(f"('{lang}', {quoted(w)})" for lang, words in STOPLIST_IGNORED.items() for w in words)

# corpus_counts(lang, word, n): words of documents as the stoplist builder counts them.
CORPUS_COUNTS = f"""ignored(lang, word) AS (VALUES {IGNORED_ROWS}),
corpus_words AS (
  SELECT lang, lower(trim(raw, {quoted(STOPLIST_STRIP_CHARS)})) AS word
  FROM (SELECT lang, unnest(string_split_regex(text, '{SPACE}+')) AS raw FROM documents)
), corpus_counts AS (
  SELECT w.lang, w.word, count(*) AS n FROM corpus_words w
  WHERE w.word <> '' AND NOT EXISTS (SELECT 1 FROM ignored i WHERE i.lang = w.lang AND i.word = w.word)
  GROUP BY w.lang, w.word
)"""


def stoplist(size: int) -> str:
    """stoplist(lang, word) and languages(lang, rank)."""
    return f"""{CORPUS_COUNTS}, stoplist AS (
  SELECT lang, word, n, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rank FROM corpus_counts)
  WHERE rank <= {size}
), languages AS (
  SELECT lang, coalesce(list_position(['cs', 'sk', 'en', 'de', 'pl', 'ru', 'fr'], lang), 99) AS rank
  FROM (SELECT DISTINCT lang FROM stoplist)
)"""


def language_of(source: str, key: str, text: str) -> str:
    """guessed(key, language) for all rows of a table."""
    return f"""text_words AS (
  SELECT {key} AS key, lower(word) AS word FROM (
    SELECT {key}, regexp_replace(unnest(string_split_regex({text}, '{SPACE}+')),
      '^[^\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+$', '', 'g') AS word FROM {source})
  WHERE word <> ''
), text_totals AS (SELECT key, count(*) AS total FROM text_words GROUP BY key
), text_hits AS (
  SELECT w.key, s.lang, count(*) AS n FROM text_words w JOIN stoplist s ON s.word = w.word GROUP BY w.key, s.lang
), text_best AS (
  SELECT h.key, h.lang, row_number() OVER (PARTITION BY h.key ORDER BY h.n DESC, l.rank, h.lang) AS place
  FROM text_hits h JOIN text_totals t ON t.key = h.key JOIN languages l ON l.lang = h.lang
  WHERE h.n >= greatest(3.0, 0.05 * t.total)
), guessed AS (
  SELECT d.{key} AS key, b.lang AS language FROM {source} d LEFT JOIN text_best b ON b.key = d.{key} AND b.place = 1
)"""


# Regular expressions over markup.
CLEAN = r"(?is)<!--.*?(?:-->|\z)|<script\b[^>]*>.*?(?:</script\s*>|\z)|<style\b[^>]*>.*?(?:</style\s*>|\z)"
EMBEDDED = "(?is)" + "|".join(rf"<{t}\b[^>]*>.*?(?:</{t}\s*>|\z)" for t in EMBEDDED_TAGS)
HEAD_EMBEDDED = "(?is)" + "|".join(rf"<{t}\b[^>]*>.*?(?:</{t}\s*>|\z)" for t in ["head", *EMBEDDED_TAGS])
TAG = r"</?[a-zA-Z!?][^>]*>"
BLOCK_TAG = rf"(?i)</?(?:{'|'.join(BLOCK_TAGS)})(?:[\s/][^>]*)?>|<br\s*/?>\s*<br\s*/?>"


def decoded(text: str) -> str:
    """The references that occur in pages; the ampersand comes last."""
    pairs = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&nbsp;", " ")]
    for reference, character in pairs + [("&amp;", "&")]:
        text = f"replace({text}, '{reference}', {quoted(character)})"
    return text


def squeezed(text: str) -> str:
    return f"trim(regexp_replace({text}, '{SPACE}+', ' ', 'g'))"


CLEANED = f"cleaned AS (SELECT page_id, url, regexp_replace(html, '{CLEAN}', '', 'g') AS cleaned FROM pages)"
VISIBLE = f"""visible AS (SELECT page_id, {decoded(
    f"regexp_replace(regexp_replace(cleaned, '{EMBEDDED}', '', 'g'), '{TAG}', '', 'g')")} AS visible FROM cleaned)"""


def page_blocks(size: int) -> str:
    """blocks(page_id, pos, text, length, link_length, n_words, n_stopwords) with their page's language.

    Everything from the cleaned page on; the links of these pages never span blocks.
    """
    body = f"regexp_replace(regexp_replace(cleaned, '{HEAD_EMBEDDED}', '', 'g'), '{BLOCK_TAG}', chr(1), 'g')"
    text = squeezed(decoded(f"regexp_replace(regexp_replace(raw, '(?i)<br\\s*/?>', ' ', 'g'), '{TAG}', '', 'g')"))
    link = squeezed(
        decoded(
            f"regexp_replace(array_to_string(regexp_extract_all(raw, '(?is)<a(?:\\s[^>]*)?>(.*?)</a\\s*>', 1), ''),"
            f" '{TAG}', '', 'g')"
        )
    )
    return f"""{stoplist(size)}, {CLEANED}, {VISIBLE}, {language_of('visible', 'page_id', 'visible')},
raw_blocks AS (
  SELECT page_id, unnest(pieces) AS raw, unnest(range(1, len(pieces) + 1)) AS place
  FROM (SELECT page_id, string_split({body}, chr(1)) AS pieces FROM cleaned)
), text_blocks AS (
  SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY place) - 1 AS pos, text, length(text) AS length,
    length(link_text) AS link_length
  FROM (SELECT page_id, place, {text} AS text, {link} AS link_text FROM raw_blocks) WHERE text <> ''
), block_words AS (
  SELECT page_id, pos, lower(unnest(string_split(text, ' '))) AS word FROM text_blocks
), block_counts AS (
  SELECT w.page_id, w.pos, count(*) AS n_words, count(s.word) AS n_stopwords
  FROM block_words w JOIN guessed g ON g.key = w.page_id
  LEFT JOIN stoplist s ON s.lang = coalesce(g.language, 'cs') AND s.word = w.word
  GROUP BY w.page_id, w.pos
), blocks AS (
  SELECT b.*, c.n_words, c.n_stopwords, g.language FROM text_blocks b
  JOIN block_counts c ON c.page_id = b.page_id AND c.pos = b.pos
  JOIN guessed g ON g.key = b.page_id
  WHERE coalesce(g.language, 'cs') IN (SELECT lang FROM languages)
)"""


def block_classes(name: str, link_density: float, distance: int) -> str:
    """{name}(page_id, pos, class): the two neighbour passes as windows."""

    def nearest(classes: str, side: str) -> str:
        value = f"CASE WHEN class IN ({classes}) THEN class END"
        if side == "before":
            return (
                f"coalesce(last_value({value} IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY pos "
                f"ROWS BETWEEN {distance} PRECEDING AND 1 PRECEDING), 'bad')"
            )
        return (
            f"coalesce(first_value({value} IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY pos "
            f"ROWS BETWEEN 1 FOLLOWING AND {distance} FOLLOWING), 'bad')"
        )

    return f"""{name}_free AS (
  SELECT page_id, pos, CASE
    WHEN link_length / length > {link_density} THEN 'bad'
    WHEN contains(text, '©') OR contains(text, '&copy') THEN 'bad'
    WHEN length < 70 THEN CASE WHEN link_length > 0 THEN 'bad' ELSE 'short' END
    WHEN n_stopwords / n_words >= 0.3 THEN CASE WHEN length > 140 THEN 'good' ELSE 'neargood' END
    WHEN n_stopwords / n_words >= 0.2 THEN 'neargood' ELSE 'bad' END AS class
  FROM blocks
), {name}_sides AS (
  SELECT *, {nearest("'good', 'bad'", 'before')} AS p, {nearest("'good', 'bad'", 'after')} AS n,
    {nearest("'good', 'bad', 'neargood'", 'before')} AS pn, {nearest("'good', 'bad', 'neargood'", 'after')} AS nn
  FROM {name}_free
), {name}_short AS (
  SELECT page_id, pos, CASE WHEN class <> 'short' THEN class
    WHEN p = 'good' AND n = 'good' THEN 'good'
    WHEN p = 'bad' AND n = 'bad' THEN 'bad'
    WHEN (p = 'bad' AND pn = 'neargood') OR (n = 'bad' AND nn = 'neargood') THEN 'good' ELSE 'bad' END AS class
  FROM {name}_sides
), {name} AS (
  SELECT page_id, pos, CASE WHEN class <> 'neargood' THEN class
    WHEN p = 'bad' AND n = 'bad' THEN 'bad' ELSE 'good' END AS class
  FROM (SELECT *, {nearest("'good', 'bad'", 'before')} AS p, {nearest("'good', 'bad'", 'after')} AS n FROM {name}_short)
)"""


PLAIN_TEXT = f"""{block_classes('base', 0.4, 5)}, {block_classes('linked', 1.0, 5)}, {block_classes('far', 0.4, 20)},
tried AS (
  SELECT b.page_id, b.pos, b.text, base.class AS c0, linked.class AS c1, far.class AS c2,
    max(base.class = 'good') OVER (PARTITION BY b.page_id) AS g0,
    max(linked.class = 'good') OVER (PARTITION BY b.page_id) AS g1
  FROM blocks b JOIN base USING (page_id, pos) JOIN linked USING (page_id, pos) JOIN far USING (page_id, pos)
), chosen AS (
  SELECT page_id, pos, text, CASE WHEN g0 THEN c0 WHEN g1 THEN c1 ELSE c2 END AS class,
    CASE WHEN g0 THEN 0 WHEN g1 THEN 1 ELSE 2 END AS setting
  FROM tried
), plain AS (
  SELECT g.key AS page_id, g.language,
    CASE WHEN coalesce(g.language, 'cs') IN (SELECT lang FROM languages)
      THEN coalesce(string_agg(c.text, chr(10) ORDER BY c.pos) FILTER (WHERE c.class = 'good'), '') END AS plain_text
  FROM guessed g LEFT JOIN chosen c ON c.page_id = g.key GROUP BY g.key, g.language
)"""


def sentence_pieces(text: str, language: str) -> str:
    """List of sentences of a text, as an expression."""
    import re

    from warcloom.fixed_values import ABBREVIATIONS

    def glued(source: str, lang: str) -> str:
        listed = "|".join(re.escape(word) for word in ABBREVIATIONS[lang].split())
        pattern = rf"(?i)((?:^|[^\p{{L}}\p{{N}}])(?:{listed})\.{SPACE}+)\x01"
        return twice(source, pattern, "\\1")

    def twice(source: str, pattern: str, kept: str) -> str:
        # matches that touch each other need a second pass
        for _ in range(2):
            source = f"regexp_replace({source}, {quoted(pattern)}, '{kept}', 'g')"
        return source

    end = rf"""([.!?]["'»”)\]]*{SPACE}+)(["'„“‘«(\[]*[\p{{Lu}}\p{{N}}])"""
    marked = f"regexp_replace(coalesce({text}, ''), {quoted(end)}, '\\1' || chr(1) || '\\2', 'g')"
    marked = twice(marked, rf"(\p{{N}}\.{SPACE}+)\x01(\p{{N}})", "\\1\\2")
    marked = twice(marked, rf"((?:^|[^\p{{L}}\p{{N}}])\p{{Lu}}\.{SPACE}+)\x01", "\\1")
    cases = " ".join(
        f"WHEN {language} = '{lang}' THEN {glued(marked, lang)}" for lang in ("en", "de", "pl", "fr")
    )
    pieces = f"string_split(CASE {cases} ELSE {glued(marked, 'cs')} END, chr(1))"
    trimmed = f"list_transform({pieces}, lambda s: regexp_replace(s, '^{SPACE}+|{SPACE}+$', '', 'g'))"
    return f"list_filter({trimmed}, lambda s: s <> '')"


TOKEN = r"\p{N}+(?:[.,:]\p{N}+)+|[\p{L}\p{M}\p{N}_'\-]+|[^\t-\r\x1c-\x20\x85\p{Z}\p{L}\p{M}\p{N}_]"


def token_list(text: str) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), {quoted(TOKEN)}, 0)"


def text_statistics(source: str, key: str, text: str, language: str) -> str:
    """statistics(key, n_sentences, n_words, n_syllables, reading_ease) of every row of a table."""
    from warcloom.functions.tokens import SYLLABLE_LANGUAGES, VOWELS

    vowel = f"[{VOWELS}{VOWELS.upper()}]"
    known = ", ".join(f"'{lang}'" for lang in SYLLABLE_LANGUAGES if lang not in ("cs", "sk"))
    word = quoted(r"[\p{L}\p{N}_\-']+")
    return f"""valid_tokens AS (
  SELECT key, language, token FROM (
    SELECT {key} AS key, {language} AS language, unnest({token_list(text)}) AS token FROM {source})
  WHERE regexp_full_match(token, {word})
), word_parts AS (
  SELECT key, language, unnest(string_split_regex(token, '-+')) AS part FROM valid_tokens
), part_syllables AS (
  SELECT key, sum(greatest(1, len(CASE WHEN language IN ({known})
    THEN regexp_extract_all(part, '{vowel}+', 0) ELSE regexp_extract_all(part, '[aeoAEO][uU]|{vowel}', 0) END)))
    AS n_syllables FROM word_parts GROUP BY key
), word_totals AS (SELECT key, count(*) AS n_words FROM valid_tokens GROUP BY key
), sentence_totals AS (
  SELECT {key} AS key, len({sentence_pieces(text, language)}) AS n_sentences FROM {source}
), totals AS (
  SELECT s.key, s.n_sentences, coalesce(w.n_words, 0) AS n_words, coalesce(p.n_syllables, 0) AS n_syllables
  FROM sentence_totals s LEFT JOIN word_totals w ON w.key = s.key LEFT JOIN part_syllables p ON p.key = s.key
), statistics AS (
  SELECT key, CAST(n_sentences AS BIGINT) AS n_sentences, CAST(n_words AS BIGINT) AS n_words,
    CAST(n_syllables AS BIGINT) AS n_syllables,
    CASE WHEN n_sentences > 0 AND n_words > 0 THEN
      round(206.835 - 1.015 * (CAST(n_words AS DOUBLE) / n_sentences)
        - 84.6 * (CAST(n_syllables AS DOUBLE) / n_words), 6) END AS reading_ease
  FROM totals
)"""


def _one_byte(charset: str) -> tuple[str, str]:
    """The bytes from 128 on as characters, and what a charset reads in them."""
    return "".join(map(chr, range(128, 256))), "".join(bytes([b]).decode(charset, "replace") for b in range(128, 256))


def _encoded(charset: str) -> str:
    """SQL for the bytes, as characters up to U+00FF, of `html` in a charset of one byte per character."""
    known = [(b, c) for b, c in zip(*_one_byte(charset), strict=True) if c != "\ufffd"]
    letters = "".join(f"\\x{{{ord(c):X}}}" for _, c in known)
    return f"translate(regexp_replace(html, '[^\\x00-\\x7F{letters}]', '?', 'g'), '{''.join(c for _, c in known)}', '{''.join(b for b, _ in known)}')"


def _spans(*ranges: str) -> str:
    """A pattern for bytes of these ranges one after another: `"C2-DF 80-BF"`."""
    one = lambda span: "[" + "-".join(f"\\x{{{x}}}" for x in span.split("-")) + "]"
    return "|".join("".join(map(one, spans.split())) for spans in ranges)


# Whole sequences of UTF-8, and beginnings of sequences, which are one error each.
_WHOLE = _spans("C2-DF 80-BF", "E0 A0-BF 80-BF", "E1-EC 80-BF 80-BF", "ED 80-9F 80-BF", "EE-EF 80-BF 80-BF", "F0 90-BF 80-BF 80-BF", "F1-F3 80-BF 80-BF 80-BF", "F4 80-8F 80-BF 80-BF")
_BEGUN = _spans("E0 A0-BF", "E1-EC 80-BF", "ED 80-9F", "EE-EF 80-BF", "F0 90-BF 80-BF", "F0 90-BF", "F1-F3 80-BF 80-BF", "F1-F3 80-BF", "F4 80-8F 80-BF", "F4 80-8F")
# Units of UTF-16 that are half a character stand as characters that no text has.
_HIGH, _LOW = "\\x{10FFFD}", "\\x{10FFFC}"
_HALVES = f"(?s){_HIGH}.|{_LOW}|{_HIGH}"


def guessed_charsets(encoded: dict[int, str]) -> str:
    """SQL for the charset with most Czech letters of pages that are written in `encoded[page_id % n]`, without declaration.

    `raw` has the bytes as characters up to U+00FF; `texts` what each candidate reads, with one mark per error.
    """
    sql = {
        "utf-8": """array_to_string(list_transform(regexp_extract_all(html, '(?s).'), lambda c: CASE
      WHEN unicode(c) < 128 THEN c
      WHEN unicode(c) < 2048 THEN chr(192 + unicode(c) // 64) || chr(128 + unicode(c) % 64)
      WHEN unicode(c) < 65536 THEN chr(224 + unicode(c) // 4096) || chr(128 + unicode(c) // 64 % 64) || chr(128 + unicode(c) % 64)
      ELSE chr(240 + unicode(c) // 262144) || chr(128 + unicode(c) // 4096 % 64) || chr(128 + unicode(c) // 64 % 64) || chr(128 + unicode(c) % 64) END), '')""",
        "utf-16-le": """array_to_string(list_transform(regexp_extract_all(html, '(?s).'), lambda c: CASE
      WHEN unicode(c) < 65536 THEN chr(unicode(c) % 256) || chr(unicode(c) // 256)
      ELSE chr((unicode(c) - 65536) // 1024 % 256) || chr(216 + (unicode(c) - 65536) // 262144)
        || chr(unicode(c) % 256) || chr(220 + unicode(c) % 1024 // 256) END), '')""",
    }
    raw = " ".join(f"WHEN {k} THEN {sql.get(name) or _encoded(name)}" for k, name in encoded.items())
    czech = "".join(sorted(set(CZECH_LETTERS) - set(map(chr, range(128)))))
    letters = f"[^a-zA-Z{czech}]"
    two_bytes = "|".join("".join(f"\\x{{{b:X}}}" for b in c.encode()) for c in czech)
    reads = []
    for at, name in enumerate(DEFAULT_CHARSETS):
        if name == "ascii":
            text = "regexp_replace(b, '[^\\x00-\\x7F]', '\ufffd', 'g')"
        elif name == "utf-8":  # a whole sequence is the letter a if it is a Czech letter, else no letter
            whole = f"regexp_replace(regexp_replace(b, '{two_bytes}', 'a', 'g'), '{_WHOLE}', '.', 'g')"
            text = f"regexp_replace(regexp_replace({whole}, '{_BEGUN}', '\ufffd', 'g'), '[\\x{{80}}-\\x{{FF}}]', '\ufffd', 'g')"
        elif name == "utf-16":
            text = "wide"
        else:
            text = "translate(b, '{}', '{}')".format(*_one_byte(name))
        reads.append(f"SELECT page_id, {at} AS place, '{name}' AS charset, {text} AS text FROM units")
    return f"""
WITH given AS (SELECT page_id, replace(html, '<meta charset="utf-8">', '') AS html FROM pages),
raw AS MATERIALIZED (SELECT page_id, CASE page_id % {len(encoded)} {raw} END AS b FROM given),
bytes AS MATERIALIZED (SELECT page_id, b, list_transform(regexp_extract_all(b, '(?s).'), lambda c: unicode(c)) AS codes FROM raw),
pairs AS (SELECT page_id, b, list_transform(range(1, len(codes) + 1, 2), lambda i: codes[i] + 256 * codes[i + 1]) AS pairs FROM bytes),
halves AS (SELECT page_id, b, array_to_string(list_transform(pairs, lambda u: CASE
    WHEN u IS NULL THEN chr(65533) WHEN u BETWEEN 55296 AND 56319 THEN chr(1114109) WHEN u BETWEEN 56320 AND 57343 THEN chr(1114108)
    ELSE chr(u) END), '') AS halves FROM pairs),
units AS MATERIALIZED (SELECT page_id, b, regexp_replace(halves, '{_HALVES}', '', 'g')
    || array_to_string(list_transform(regexp_extract_all(halves, '{_HALVES}'), lambda x: CASE x WHEN chr(1114109) || chr(1114108) THEN '.' ELSE chr(65533) END), '') AS wide
  FROM halves),
texts AS ({" UNION ALL ".join(reads)}),
scores AS (SELECT page_id, place, charset, length(regexp_replace(text, '{letters}', '', 'g')) / length(text) AS letters,
    length(regexp_replace(text, '[^\ufffd]', '', 'g')) / length(text) AS errors FROM texts WHERE length(text) > 0),
best AS (SELECT page_id, charset FROM scores QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY letters DESC, errors, place) = 1)
SELECT page_id, charset, 'guessed' AS charset_origin FROM pages LEFT JOIN best USING (page_id)"""
