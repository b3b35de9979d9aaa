"""Processing steps per record type, in one pass over the records.

A step is a function DataFrame -> DataFrame that adds its output columns, row by row. Rows of other types, revisits and
rows that the step makes invalid keep their old values. No type is split off and united again, so the input is read
once however many types there are.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from warcloom.fixed_values import DEFAULT_LANGUAGE, MIME_GROUPS, PAGE_TYPE_NEEDLES
from warcloom.functions import tokens as tk
from warcloom.operators import classify
from warcloom.operators.classify import page_type
from warcloom.operators.gates import invalid_rules
from warcloom.operators.language import Stoplists
from warcloom.operators.linear import LinearModel, StoredModel, sentiment_of, topics_of, with_scored
from warcloom.operators.page_text import with_charset, with_html, with_page_text
from warcloom.operators.readability import with_reading_ease, with_sentences, with_tokens
from warcloom.sources.warc import NOT_DECODED


@dataclass(frozen=True)
class Step:
    """`apply` reads `inputs` and adds or replaces `outputs` (name to type), without changing the number of rows."""

    name: str
    apply: Callable[[DataFrame], DataFrame]
    outputs: Mapping[str, str]
    inputs: Sequence[str] = field(default=())


def html_text(stoplists: Stoplists, block_stoplists: Stoplists | None = None) -> Step:
    """Title, headlines, links, language and plain text from an HTML payload."""

    def apply(records: DataFrame) -> DataFrame:
        encoded = F.coalesce(F.col("scan_error").endswith(NOT_DECODED), F.lit(False))
        typed = records.withColumns(
            {
                "_content_type": F.try_element_at("http_headers", F.lit("Content-Type")),
                "_payload": F.when(~encoded, F.col("content")),
            }
        )
        decoded = with_html(with_charset(typed, "_payload", "_content_type"), "_payload")
        return with_page_text(decoded, stoplists, block_stoplists).drop(
            "_content_type", "_payload", "charset", "charset_origin", "decode_errors", "html"
        )

    outputs = {
        "title": "string",
        "headlines": "array<string>",
        "links": "array<string>",
        "language": "string",
        "plain_text": "string",
    }
    return Step("HTMLTextExtractor", apply, outputs, ["content"])


def word_tokens() -> Step:
    return Step("WordTokenizer", with_tokens, {"plain_text_tokens": "array<string>"}, ["plain_text"])


def sentence_tokens() -> Step:
    return Step("SentenceTokenizer", with_sentences, {"plain_text_sentences": "array<string>"}, ["plain_text"])


def web_page_type(needles: dict[str, list[str]] = PAGE_TYPE_NEEDLES) -> Step:
    def apply(records: DataFrame) -> DataFrame:
        return records.withColumn("web_page_type", page_type(F.col("url"), needles))

    return Step("WebPageTypeIdentifier", apply, {"web_page_type": "string"}, ["url"])


def flesch_reading_ease() -> Step:
    outputs = {"n_sentences": "int", "n_words": "int", "n_syllables": "int", "reading_ease": "double"}
    return Step("FleschReadingEase", with_reading_ease, outputs, ["plain_text"])


def _classified(name: str, output: str, kind: str, model: LinearModel | StoredModel, expression: Callable, joined: Callable, only_language: str) -> Step:
    """A step that scores the tokens of texts of one language; the tokens of a step before it, or else its own. A stored
    model's scores come by a join, for which records are stored."""

    def apply(records: DataFrame) -> DataFrame:
        own = tk.tokens(F.col("plain_text"))
        made = F.col("plain_text_tokens") if "plain_text_tokens" in records.columns else None
        tokens = own if made is None else F.when(F.size(made) > 0, made).otherwise(own)
        wanted = F.when(F.col("language") == only_language, tokens)
        if isinstance(model, StoredModel):
            return with_scored(records, output, wanted, model, joined)
        return records.withColumn(output, expression(records.sparkSession, model)(wanted))

    return Step(name, apply, {output: kind}, ["plain_text", "language"])


def topics(model: LinearModel | StoredModel, only_language: str = DEFAULT_LANGUAGE) -> Step:
    """Sorted classes with a positive score; unset for other languages and texts without tokens. No shuffle but for a
    stored model."""
    return _classified("TopicIdentifier", "topics", "array<string>", model, topics_of, classify.topics, only_language)


def sentiment(model: LinearModel | StoredModel, only_language: str = DEFAULT_LANGUAGE) -> Step:
    """Sentiment in [-1, 1]; unset for other languages and texts without tokens. No shuffle but for a stored model."""
    return _classified("SentimentAnalyzer", "sentiment", "double", model, sentiment_of, classify.sentiment, only_language)


#: How the message of a failed step begins in the column `errors`.
FAILED_STEP = "step "


def failed_steps(records: DataFrame) -> Column:
    """Whether a step has failed on a record."""
    if "errors" not in records.columns:
        return F.lit(False)
    return F.coalesce(F.exists("errors", lambda message: message.startswith(FAILED_STEP)), F.lit(False))


def python_step(
    name: str, function: Callable[[pd.DataFrame], pd.DataFrame], outputs: Mapping[str, str], inputs: Sequence[str]
) -> Step:
    """A step of the user's own that cannot fail a run: `function` makes the output columns of a batch of input rows.

    It gets pandas frames of the records that the step is for, and returns as many rows in their order. A batch on which
    it raises, or gives something else, is halved until the rows that fail stand alone: these keep what they had before the
    step, with a message in `errors`, and all others have their results. Results must depend on the row alone, as
    a row may be tried several times. The payload crosses to Python only if it is among the inputs.
    """
    columns = list(outputs)
    kinds = {c: T._parse_datatype_string(kind) for c, kind in outputs.items()}
    schema = T.StructType([*(T.StructField(c, kind) for c, kind in kinds.items()), T.StructField("_error", T.StringType())])
    arrow = {c: to_arrow_type(kind) for c, kind in kinds.items()}

    def results(frame: pd.DataFrame) -> list[pa.Array]:
        made = function(frame.copy())
        if len(made) != len(frame):
            raise ValueError(f"{len(made)} rows for {len(frame)}")
        return [pa.array(made[c], arrow[c], from_pandas=True) for c in columns]

    def tried(frame: pd.DataFrame, at: list[int], done: list[tuple[list[int], list[pa.Array], str | None]]) -> None:
        """Results of rows, of each half apart where the whole fails. A stack of halves, as deep as it is."""
        open_ranges = [(0, len(at))] if at else []
        while open_ranges:
            low, high = open_ranges.pop()
            try:
                done.append((at[low:high], results(frame.iloc[low:high].reset_index(drop=True)), None))
            except Exception as error:
                if high - low > 1:
                    middle = (low + high) // 2
                    open_ranges += [(middle, high), (low, middle)]
                else:
                    done.append((at[low:high], [pa.nulls(1, arrow[c]) for c in columns], f"{type(error).__name__}: {error}"))

    def work(active: pa.Array, *given: pa.Array) -> pa.Array:
        at = [k for k, x in enumerate(active.to_pylist()) if x]
        frame = pa.table([x.take(pa.array(at, pa.int64())) for x in given], names=list(inputs)).to_pandas()
        done: list[tuple[list[int], list[pa.Array], str | None]] = []
        tried(frame, at, done)
        order = pa.array([k for rows, *_ in done for k in rows], pa.int64())
        places = {k: place for place, k in enumerate(order.to_pylist())}
        take = pa.array([places.get(k) for k in range(len(active))], pa.int64())
        made = [pa.concat_arrays([arrays[c] for _, arrays, _ in done] or [pa.nulls(0, arrow[x])]).take(take) for c, x in enumerate(columns)]
        messages = pa.array([error for rows, _, error in done for _ in rows], pa.string()).take(take)
        return pa.StructArray.from_arrays([*made, messages], names=[*columns, "_error"])

    run = F.arrow_udf(work, schema)

    def apply(records: DataFrame) -> DataFrame:
        active = F.col("_active") if "_active" in records.columns else F.lit(True)
        made = records.withColumn("_made", run(active, *(F.col(c) for c in inputs)))
        message = F.concat(F.lit(f"{FAILED_STEP}{name}: "), F.col("_made._error"))
        before = F.coalesce("errors", F.expr("cast(array() as array<string>)"))
        failed = F.col("_made._error").isNotNull()
        results = {
            c: F.when(failed, F.col(f"_old_{c}") if f"_old_{c}" in records.columns else F.lit(None)).otherwise(F.col(f"_made.{c}")) for c in columns
        }
        results["errors"] = F.when(failed, F.array_append(before, message)).otherwise(F.col("errors"))
        return made.withColumns(results).drop("_made")

    return Step(name, apply, {**outputs, "errors": "array<string>"}, [*inputs, "errors"])


def pdf_text() -> Step:
    """PDF records are kept as they are."""
    return Step("PDFTextExtractor", lambda records: records, {})


def parse_sequence(text: str, steps: Mapping[str, Step], groups: Mapping[str, str] = MIME_GROUPS):
    """`TYPE:step1,step2` as (TYPE, [steps]); an unknown type or step is an error."""
    group, colon, names = text.partition(":")
    if not colon:
        raise ValueError(f"cannot parse {text!r}, expected TYPE:step1,step2")
    if group not in groups:
        raise ValueError(f"record type {group!r} is not supported")
    chosen = [name for name in names.split(",") if name]
    unknown = [name for name in chosen if name not in steps]
    if unknown:
        raise ValueError(f"no step with name {unknown[0]!r}")
    return group, [steps[name] for name in chosen]


def run_steps(
    records: DataFrame, sequences: Mapping[str, Sequence[Step]], condition: Column | None = None
) -> DataFrame:
    """Apply to every record the steps of its `mime_group`; records of groups without a sequence are dropped.

    An empty sequence keeps its records unprocessed, and so does a revisit. With a `condition`, no record is dropped,
    and those that do not meet it stay as they are.
    """
    done = records.filter(F.col("mime_group").isin(list(sequences))) if condition is None else records
    meant = F.lit(True) if condition is None else condition
    for step, groups in _in_order(sequences):
        done = apply_step(done, step, meant & F.col("mime_group").isin(groups) & ~F.col("is_revisit"))
    return done


def _in_order(sequences: Mapping[str, Sequence[Step]]) -> list[tuple[Step, list[str]]]:
    """Steps with their groups, by position; a step that several groups have at one position comes once."""
    planned: list[tuple[Step, list[str]]] = []
    for position in range(max((len(steps) for steps in sequences.values()), default=0)):
        here: list[tuple[Step, list[str]]] = []
        for group, steps in sequences.items():
            if position < len(steps):
                shared = next((groups for step, groups in here if step is steps[position]), None)
                if shared is None:
                    here.append((steps[position], [group]))
                else:
                    shared.append(group)
        planned += here
    return planned


def apply_step(records: DataFrame, step: Step, active: Column) -> DataFrame:
    """Run one step on the active rows, and roll it back on rows it makes invalid.

    Inactive rows show the step null inputs, so it has nothing to do for them.
    """
    names = list(step.outputs)
    if not names:
        return records
    declared = records.withColumns(
        {name: F.lit(None).cast(kind) for name, kind in step.outputs.items() if name not in records.columns}
    )
    saved = [name for name in declared.columns if name in names or name in step.inputs]
    masked = declared.withColumn("_active", F.coalesce(active, F.lit(False))).withColumns(
        {f"_old_{name}": F.col(name) for name in saved}
    )
    # an output is absent before its step, unless a step before has made it
    shown = {name: F.when(F.col("_active"), F.col(name)) for name in step.inputs}
    before = masked.withColumns(shown).drop(*(n for n in names if n not in records.columns and n not in step.inputs))
    after = step.apply(before)
    valid = F.size(invalid_rules(names)) == 0
    checked = after.withColumn("_use", F.col("_active") & valid)
    result = {
        name: F.when(F.col("_use"), F.col(name).cast(kind)).otherwise(F.col(f"_old_{name}"))
        for name, kind in step.outputs.items()
    }
    result |= {name: F.col(f"_old_{name}") for name in step.inputs if name not in names}
    return checked.withColumns(result).drop("_active", "_use", *(f"_old_{name}" for name in saved))
