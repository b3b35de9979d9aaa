"""Page type, topics and sentiment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from warcloom.fixed_values import DEFAULT_LANGUAGE, OTHER_PAGE_TYPE, PAGE_TYPE_NEEDLES
from warcloom.functions.literals import sql_string
from warcloom.operators.counted import as_column, counts_by_classes, sums_by_class
from warcloom.session import stored


def page_type(url: Column, needles: dict[str, list[str]] = PAGE_TYPE_NEEDLES, other: str = OTHER_PAGE_TYPE) -> Column:
    """First type one of whose strings occurs in a URL, case-sensitively; null without URL."""
    chosen = F.lit(other)
    for kind, listed in reversed(list(needles.items())):
        found = F.lit(False)
        for needle in listed:
            found = found | url.contains(needle)
        chosen = F.when(found, F.lit(kind)).otherwise(chosen)
    return F.when(url.isNotNull(), chosen)


def class_scores(
    texts: DataFrame,
    key: str,
    tokens: str | Column,
    model: DataFrame,
    bias: DataFrame,
    language: str | None = None,
    only_language: str = DEFAULT_LANGUAGE,
) -> DataFrame:
    """Decision scores of a linear model: rows (key, class, score) for every class that shares a term with a text.

    `model` has (class, term, weight), `bias` one row (class, bias) per class. A text with tokens but without any term
    of the model has one row with a null class. With `language`, texts of another language, or of none, have no row.

    Texts are scored in chunks that ask for the weights of their distinct terms (`counted.sums_by_class`), so neither tokens
    nor pairs of text and term are shuffled. `tokens` is a column's name or an expression.
    """
    wanted = texts if language is None else texts.filter(F.col(language) == only_language)
    scored = sums_by_class(wanted, key, tokens, model).groupBy(key, "class").agg(F.sum("total").alias("total"))
    return scored.join(bias, "class", "left").select(key, "class", (F.col("total") + F.col("bias")).alias("score"))


def topics(scores: DataFrame, key: str, bias: DataFrame) -> DataFrame:
    """Sorted array of the classes with a positive score; one row per scored text."""
    # a class without a common term has its bias as score, which may be positive by itself
    positive_bias = bias.filter("bias > 0").agg(F.collect_list("class").alias("classes")).scalar()
    found = scores.groupBy(key).agg(
        F.collect_list(F.when(F.col("score") > 0, F.col("class"))).alias("positive"),
        F.collect_list("class").alias("scored"),
    )
    return found.select(
        key,
        F.sort_array(F.concat("positive", F.array_except(positive_bias, F.col("scored")))).alias("topics"),
    )


def sentiment(
    scores: DataFrame, key: str, bias: DataFrame, positive: str = "positive", negative: str = "negative"
) -> DataFrame:
    """p(positive) - p(negative) of a softmax over two scores, in [-1, 1].

    This difference equals tanh of half the score difference, which cannot overflow.
    """

    def score(name: str) -> Column:
        alone = bias.filter(F.col("class") == name).agg(F.max("bias")).scalar()
        return F.coalesce(F.max(F.when(F.col("class") == name, F.col("score"))), alone)

    return scores.groupBy(key).agg(F.tanh((score(positive) - score(negative)) / 2).alias("sentiment"))


def fit_linear_model(
    texts: DataFrame, key: str, tokens: str | Column, labels: DataFrame, smoothing: float = 1.0
) -> tuple[DataFrame, DataFrame]:
    """A model for `class_scores`: weights are log-odds of a term inside and outside a class, smoothed.

    `labels` has distinct (key, class); a text may have several. Returns (class, term, weight) and (class, bias). Only
    counts are needed, which are stored at once in the shared folder: texts are read a single time. `tokens` is a column's
    name or an expression.
    """
    classes = labels.groupBy(key).agg(F.array_sort(F.collect_set("class")).alias("_classes"))
    # tokens are made behind the join, which then moves texts as they are
    labelled = texts.join(classes, key).select(as_column(tokens).alias("tokens"), F.col("_classes").alias("classes"))
    # a null class counts every labelled text
    everything = F.array_append("classes", F.lit(None).cast("string"))
    counts = (
        counts_by_classes(labelled)
        .select("term", "n", F.explode(everything).alias("class"))
        .groupBy("class", "term")
        .agg(F.sum("n").alias("n"))
    )
    # everything below reads these counts, which are far smaller than the texts
    counts = stored(counts, "term-counts")
    totals = counts.groupBy("class").agg(F.sum("n").alias("t_in"), F.count(F.lit(1)).alias("n_terms"))
    of_all = totals.agg(
        F.max(F.when(F.col("class").isNull(), F.struct(F.col("t_in").alias("t"), F.col("n_terms").alias("n"))))
    ).scalar()
    overall = F.max(F.when(F.col("class").isNull(), F.col("n"))).over(Window.partitionBy("term"))
    inside = counts.withColumn("n_all", overall).filter("class IS NOT NULL").withColumnRenamed("n", "n_in")
    added = smoothing * of_all["n"]
    weight = F.log((F.col("n_in") + smoothing) / (F.col("t_in") + added)) - F.log(
        (F.col("n_all") - F.col("n_in") + smoothing) / (of_all["t"] - F.col("t_in") + added)
    )
    model = inside.join(totals, "class").select("class", "term", weight.alias("weight"))
    n_texts = classes.agg(F.count(F.lit(1))).scalar()
    n_class = F.count(F.lit(1))
    bias = labels.groupBy("class").agg(
        F.log((n_class + smoothing) / (n_texts - n_class + smoothing)).alias("bias")
    )
    return model, bias


def vocabulary(labels: DataFrame, name: str, label: str) -> DataFrame:
    """Labels with stable ids: distinct, in label order, from 0, per vocabulary `name`.

    A vocabulary is the label set of a classifier, so it is small once it is distinct; the distinct comes first.
    """
    distinct = labels.select(F.col(name).alias("name"), F.col(label).alias("term")).distinct()
    position = F.row_number().over(Window.partitionBy("name").orderBy("term")) - 1
    return distinct.select("name", "term", position.alias("idx"))


def vocabulary_json(vocabularies: DataFrame) -> DataFrame:
    """One configuration document per vocabulary: `{name: {"value": {term: idx}}}`."""
    terms = F.map_from_entries(F.array_sort(F.collect_list(F.struct("term", "idx"))))
    return (
        vocabularies.groupBy("name")
        .agg(terms.alias("terms"))
        .select("name", F.to_json(F.create_map("name", F.create_map(F.lit("value"), "terms"))).alias("document"))
    )


def fixed_vocabulary(spark, name: str, ids: dict[str, int]) -> DataFrame:
    """A vocabulary whose ids are given, such as the page types."""
    rows = ", ".join(f"({sql_string(name)}, {sql_string(term)}, {idx})" for term, idx in ids.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS v(name, term, idx)")
