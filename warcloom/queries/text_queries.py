"""Texts: words, languages, stoplists, tokens, sentences, syllables, classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from warcloom.fixed_values import PAGE_TYPE_NEEDLES, PAGE_TYPES
from warcloom.functions import tokens as tk
from warcloom.operators import classify, language
from warcloom.operators.readability import with_reading_ease
from warcloom.queries.catalog import query, table
from warcloom.queries.inputs import STOPLIST_WORDS, stoplist_counts, stoplists
from warcloom.queries.oracle_parts import (
    SPACE,
    language_of,
    sentence_pieces,
    stoplist,
    text_statistics,
    token_list,
)
from warcloom.session import stored
from warcloom.sources.listing import stoplist_words


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@query(
    f"""WITH stripped AS (
  SELECT doc_id, place, lower(regexp_replace(raw, '^[^\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+$', '', 'g')) AS word FROM (
    SELECT doc_id, unnest(pieces) AS raw, unnest(range(1, len(pieces) + 1)) AS place
    FROM (SELECT doc_id, string_split_regex(text, '{SPACE}+') AS pieces FROM documents))
)
SELECT doc_id, count(*) AS n_words, string_agg(word, ' ' ORDER BY place) AS words
FROM stripped WHERE word <> '' GROUP BY doc_id"""
)
def normalized_words(spark, sf_dir):
    words = documents(spark, sf_dir).select("doc_id", tk.normalised_words(F.col("text")).alias("w"))
    return words.filter(F.size("w") > 0).select(
        "doc_id", F.size("w").cast("bigint").alias("n_words"), F.array_join("w", " ").alias("words")
    )


@query(
    f"""WITH {stoplist(STOPLIST_WORDS)}, {language_of('documents', 'doc_id', 'text')}
SELECT key AS doc_id, language FROM guessed"""
)
def language_guess(spark, sf_dir):
    guessed = language.with_language(documents(spark, sf_dir), "text", stoplists(spark, sf_dir), "language")
    return guessed.select("doc_id", "language")


@query(
    f"""WITH {stoplist(1000)} SELECT lang, word, n, rank FROM stoplist"""
)
def stoplist_topn(spark, sf_dir):
    return language.top_words(stoplist_counts(spark, sf_dir), 1000).select(
        "lang", "word", "n", F.col("rank").cast("bigint").alias("rank")
    )


@query(f"WITH {stoplist(1000)} SELECT lang, word FROM stoplist")
def stoplist_load(spark, sf_dir):
    # lines as the stoplist writer makes them, read as the stoplist reader does
    ranked = language.top_words(stoplist_counts(spark, sf_dir), 1000)
    lines = ranked.select("lang", F.concat_ws("\t", F.concat(F.lit("  "), "word"), F.col("n").cast("string")).alias("value"))
    return stoplist_words(lines)


@query(
    f"""WITH {stoplist(1000)}, totals AS (SELECT lang, sum(n) AS n_words FROM corpus_counts GROUP BY lang)
SELECT s.lang, count(*) AS n_stopwords, CAST(sum(s.n) AS BIGINT) AS n_occurrences, CAST(max(t.n_words) AS BIGINT) AS n_words,
  round(CAST(sum(s.n) AS DOUBLE) * 100 / max(t.n_words), 6) AS coverage
FROM stoplist s JOIN totals t ON t.lang = s.lang GROUP BY s.lang"""
)
def stoplist_coverage(spark, sf_dir):
    counts = stoplist_counts(spark, sf_dir)
    return language.coverage(counts, 1000).withColumn("coverage", F.round(F.col("coverage").cast("double"), 6))


@query(
    f"""SELECT doc_id, CAST(len(tokens) AS BIGINT) AS n_tokens, array_to_string(tokens, ' ') AS tokens
FROM (SELECT doc_id, {token_list('text')} AS tokens FROM documents)"""
)
def word_tokens(spark, sf_dir):
    split = documents(spark, sf_dir).select("doc_id", tk.tokens(F.col("text")).alias("t"))
    return split.select("doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


@query(
    f"""SELECT doc_id, CAST(len(s) AS BIGINT) AS n_sentences, array_to_string(s, ' | ') AS sentences
FROM (SELECT doc_id, {sentence_pieces('text', 'lang')} AS s FROM documents)"""
)
def sentences(spark, sf_dir):
    split = documents(spark, sf_dir).select("doc_id", tk.sentences(F.col("text"), F.col("lang")).alias("s"))
    return split.select(
        "doc_id", F.size("s").cast("bigint").alias("n_sentences"), F.array_join("s", " | ").alias("sentences")
    )


@query(
    f"""WITH {text_statistics('documents', 'doc_id', 'text', 'lang')}
SELECT key AS doc_id, n_words, n_syllables FROM statistics"""
)
def syllables(spark, sf_dir):
    words = documents(spark, sf_dir).select(
        "doc_id", "lang", tk.valid_words(tk.tokens(F.col("text"))).alias("words")
    )
    return words.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        tk.syllable_count(F.col("words"), F.col("lang")).cast("bigint").alias("n_syllables"),
    )


@query(
    f"""WITH spoken AS (SELECT conv_id * 1000 + turn AS key, text, CAST(NULL AS VARCHAR) AS lang FROM conversations),
{text_statistics('spoken', 'key', 'text', 'lang')} SELECT * FROM statistics"""
)
def reading_ease_unknown_language(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("key"), "text", F.lit(None).cast("string").alias("lang")
    )
    return statistics_of(turns, "key")


@query(
    f"""WITH {text_statistics('documents', 'doc_id', 'text', 'lang')}
SELECT key AS doc_id, n_sentences, n_words, n_syllables, reading_ease FROM statistics"""
)
def reading_ease_documents(spark, sf_dir):
    return statistics_of(documents(spark, sf_dir), "doc_id")


def statistics_of(texts, key):
    return with_reading_ease(texts, "text", "lang").select(
        key,
        *(F.col(name).cast("bigint").alias(name) for name in ["n_sentences", "n_words", "n_syllables"]),
        F.round("reading_ease", 6).alias("reading_ease"),
    )


# URLs of these pages hold none of the usual strings, so two more are looked for in this query.
_NEEDLES = PAGE_TYPE_NEEDLES | {
    "news": PAGE_TYPE_NEEDLES["news"] + ["/en/"],
    "forum": PAGE_TYPE_NEEDLES["forum"] + ["page="],
}
_NEEDLE_ROWS = ", ".join(
    f"({priority}, '{kind}', '{needle}')"
    for priority, (kind, needles) in enumerate(_NEEDLES.items())
    for needle in needles
)


@query(
    f"""WITH rules(priority, kind, needle) AS (VALUES {_NEEDLE_ROWS})
SELECT p.page_id, p.url, coalesce(arg_min(r.kind, r.priority), 'others') AS web_page_type
FROM pages p LEFT JOIN rules r ON contains(p.url, r.needle) GROUP BY p.page_id, p.url"""
)
def page_type(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", "url", classify.page_type(F.col("url"), _NEEDLES).alias("web_page_type")
    )


_TOKENS = f"tokens AS (SELECT doc_id, lang, unnest({token_list('text')}) AS term FROM documents)"
_MODEL = """occurrences AS (
  SELECT l.class, t.term, count(*) AS n_in FROM labelled l JOIN tokens t USING (doc_id) GROUP BY l.class, t.term
), everywhere AS (
  SELECT term, count(*) AS n_all FROM tokens WHERE doc_id IN (SELECT doc_id FROM labelled) GROUP BY term
), class_totals AS (SELECT class, CAST(sum(n_in) AS DOUBLE) AS t_in FROM occurrences GROUP BY class
), sizes AS (SELECT CAST(sum(n_all) AS DOUBLE) AS t_all, count(*) AS n_terms FROM everywhere
), model AS (
  SELECT o.class, o.term, ln((n_in + 1.0::DOUBLE) / (t_in + n_terms))
    - ln((n_all - n_in + 1.0::DOUBLE) / (t_all - t_in + n_terms)) AS weight
  FROM occurrences o JOIN everywhere e USING (term) JOIN class_totals c USING (class), sizes
), bias AS (
  SELECT class, ln((count(*) + 1.0::DOUBLE) / ((SELECT count(DISTINCT doc_id) FROM labelled) - count(*) + 1)) AS bias
  FROM labelled GROUP BY class
), texts AS (SELECT DISTINCT doc_id FROM tokens WHERE lang = 'en'
), scores AS (
  SELECT d.doc_id, b.class, max(b.bias) + coalesce(sum(m.weight), 0) AS score
  FROM texts d CROSS JOIN bias b
  LEFT JOIN (SELECT t.doc_id, m.class, m.weight FROM tokens t JOIN model m USING (term)) m
    ON m.doc_id = d.doc_id AND m.class = b.class
  GROUP BY d.doc_id, b.class
)"""


def _scored(texts, labels):
    # a model is stored once and then used, as a trained one would be
    tokens = tk.tokens(F.col("text"))
    model, bias = (stored(part, "model") for part in classify.fit_linear_model(texts, "doc_id", tokens, labels))
    return classify.class_scores(texts, "doc_id", tokens, model, bias, "lang", "en"), bias


@query(
    f"""WITH {_TOKENS}, labelled AS (
  SELECT DISTINCT l.doc_id, d.source AS class FROM labels l JOIN documents d USING (doc_id)
  UNION SELECT doc_id, 'quality' FROM labels WHERE quality = 1
), {_MODEL}
SELECT doc_id, coalesce(string_agg(class, ',' ORDER BY class) FILTER (WHERE score > 0), '') AS topics
FROM scores GROUP BY doc_id"""
)
def topic_assign(spark, sf_dir):
    texts = documents(spark, sf_dir)
    graded = table(spark, sf_dir, "labels")
    sources = graded.select("doc_id").join(documents(spark, sf_dir), "doc_id")
    sources = sources.select("doc_id", F.col("source").alias("class"))
    labels = sources.union(graded.filter("quality = 1").select("doc_id", F.lit("quality"))).distinct()
    scores, bias = _scored(texts, labels)
    return classify.topics(scores, "doc_id", bias).select("doc_id", F.array_join("topics", ",").alias("topics"))


@query(
    f"""WITH {_TOKENS}, labelled AS (
  SELECT doc_id, CASE toxic WHEN 1 THEN 'negative' ELSE 'positive' END AS class FROM labels), {_MODEL}
SELECT doc_id, round(tanh((max(score) FILTER (WHERE class = 'positive') - max(score) FILTER (WHERE class = 'negative')) / 2), 6)
  AS sentiment
FROM scores GROUP BY doc_id"""
)
def sentiment_score(spark, sf_dir):
    texts = documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("toxic") == 1, "negative").otherwise("positive").alias("class")
    )
    scores, bias = _scored(texts, labels)
    return classify.sentiment(scores, "doc_id", bias).select("doc_id", F.round("sentiment", 6).alias("sentiment"))


@query(
    """SELECT 'topics' AS name, source AS term, row_number() OVER (ORDER BY source) - 1 AS idx
FROM (SELECT DISTINCT source FROM documents)
UNION ALL SELECT 'languages', lang, row_number() OVER (ORDER BY lang) - 1 FROM (SELECT DISTINCT lang FROM documents)
UNION ALL VALUES ('webtypes', 'eshop', 0), ('webtypes', 'news', 1), ('webtypes', 'forum', 2), ('webtypes', 'others', 3)"""
)
def vocab_ids(spark, sf_dir):
    both = documents(spark, sf_dir).select(
        F.explode(
            F.array(
                F.struct(F.lit("topics").alias("name"), F.col("source").alias("term")),
                F.struct(F.lit("languages").alias("name"), F.col("lang").alias("term")),
            )
        ).alias("v")
    )
    ids = classify.vocabulary(both.select("v.name", "v.term"), "name", "term")
    fixed = classify.fixed_vocabulary(spark, "webtypes", PAGE_TYPES)
    return ids.union(fixed).select("name", "term", F.col("idx").cast("bigint").alias("idx"))
