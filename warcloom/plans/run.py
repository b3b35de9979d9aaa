"""Whole runs: from WARC files, or from stored rows, to keyed tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warcloom.fixed_values import DROPPED_FIELDS, MIME_GROUPS, RUN_STATUS, SEPARATE_COLUMNS
from warcloom.operators import gates, output, registry
from warcloom.operators.records import normalise, normalisation_errors
from warcloom.plans.steps import Step, failed_steps, run_steps
from warcloom.session import configure, stored
from warcloom.sources.keyed import KeyedTable, Manifest
from warcloom.sources.listed import scan_listed
from warcloom.sources.warc import scan


@dataclass(frozen=True)
class Run:
    """Lazy results of a run."""

    results: DataFrame  # every scanned record with its drop reason and, if it passed, the columns of its steps

    @property
    def processed(self) -> DataFrame:
        """Records that passed all gates."""
        return gates.passed(self.results)


def process(
    records: DataFrame, sequences: Mapping[str, Sequence[Step]], ids: DataFrame | None = None
) -> Run:
    """Gate normalised records and run their steps.

    Types without a sequence fail the MIME type gate; types are tried in the order of `sequences`. Records that
    `scan_listed` gave say themselves whether they are listed; others are joined with `ids`, payloads and all.
    """
    unknown = [group for group in sequences if group not in MIME_GROUPS]
    if unknown:
        raise ValueError(f"record type {unknown[0]!r} is not supported")
    groups = {group: MIME_GROUPS[group] for group in sequences}
    if "is_listed" in records.columns:
        gated = gates.with_gates(records, groups, F.col("is_listed")).drop("is_listed")
    elif ids is not None and not ids.isEmpty():
        marked = ids.select("id").distinct().withColumn("is_listed", F.lit(True))
        listed = records.join(marked, "id", "left").withColumn("is_listed", F.coalesce("is_listed", F.lit(False)))
        gated = gates.with_gates(listed, groups, F.col("is_listed")).drop("is_listed")
    else:
        gated = gates.with_gates(records, groups)
    return Run(run_steps(gated, sequences, F.col("drop_reason").isNull()))


def process_warcs(
    spark: SparkSession, glob: str, sequences: Mapping[str, Sequence[Step]], ids: DataFrame | None = None
) -> Run:
    """`process` over WARC files. With an ID list, payloads of other records are never built, see `scan_listed`."""
    configure(spark)
    restricted = ids is not None and not ids.isEmpty()
    found = scan_listed(spark, glob, ids) if restricted else scan(spark, glob, all_records=True)
    return process(normalise(found).withColumn("errors", normalisation_errors()), sequences)


def reprocess(stored: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Run text-level steps again on stored rows, which have no payload any more."""
    rows = stored.withColumns({"mime_group": F.lit("stored"), "is_revisit": F.coalesce("refers_to", F.lit("")) != ""})
    return run_steps(rows, {"stored": list(steps)}).drop("mime_group", "is_revisit")


def reprocess_table(table: KeyedTable, steps: Sequence[Step], batch_of: tuple[str, int] | None = None) -> Manifest:
    """Run text-level steps again on a stored main table, and put what they give back into its rows.

    Steps see key, url, plain text and language. Their outputs become cells: those that rows have a column for replace it,
    others are added as columns. Revisits, and cells that no step names, stay as they are.
    """
    text = {name: F.nullif(F.col(name), F.lit("")) for name in ("plain_text", "language", "refers_to")}
    rows = table.read().withColumns(text | {"url": F.get_json_object("IF", "$.url")})
    texts = rows.filter(F.col("refers_to").isNull()).select("key", "url", *text)
    outputs = [name for step in steps for name in step.outputs if name not in DROPPED_FIELDS]
    again = reprocess(texts, steps)
    cells = {name: output.as_text(again, name) for name in dict.fromkeys(outputs)}
    # a separate column is empty where it has no value, so that an old value goes; other cells are absent
    put = [F.coalesce(c, F.lit("")).alias(n) if n in SEPARATE_COLUMNS else c.alias(n) for n, c in cells.items()]
    return table.upsert(again.select("key", *put), batch_of=batch_of)


def save_run(
    spark: SparkSession,
    glob: str,
    sequences: Mapping[str, Sequence[Step]],
    main: str | KeyedTable,
    harvests: str,
    runs: str,
    ids: DataFrame | None = None,
    args: str = "",
) -> DataFrame:
    """Process WARC files into tables: `main` rows, new `harvests`, and one row of `runs`, which is returned.

    Files are scanned and pages extracted once: results, without payloads, go to the shared folder, and all tables are
    made from there. A lost executor costs only its own part. In a keyed table as `main`, rows replace those of earlier
    runs with the same key; a path receives rows by append, as an export.
    """
    return save_results(spark, process_warcs(spark, glob, sequences, ids), main, harvests, runs, args)


def save_results(
    spark: SparkSession,
    run: Run,
    main: str | KeyedTable,
    harvests: str,
    runs: str,
    args: str = "",
    batch_of: tuple[str, int] | None = None,
) -> DataFrame:
    """Store the results of a run, see `save_run`.

    The row of the run has the status `running` from its start, and is replaced by one with `finished` or `failed`. With
    `batch_of`, (writer, number), the run may be repeated after a failure: a keyed table takes its rows once, known
    harvests are not added again, and its row in the log is replaced.
    """
    started = int(time.time() * 1000)
    run_id = f"run-{started}-{uuid.uuid4().hex[:8]}" if batch_of is None else f"batch-{uuid.uuid5(uuid.NAMESPACE_URL, batch_of[0])}-{batch_of[1]}"

    nothing = spark.sql("SELECT 0L AS records_processed, 0L AS records_failed, cast(array() AS array<string>) AS harvests")

    def log(counts: DataFrame, status: str) -> None:
        row = registry.run_row(counts, run_id, args, started, int(time.time() * 1000), status)
        row.drop("run_id").write.mode("overwrite").parquet(f"{runs.rstrip('/')}/run_id={run_id}")

    log(nothing, RUN_STATUS[0])
    try:
        results = stored(run.results.drop(*DROPPED_FIELDS), "results")
        if results.filter(F.col("drop_reason").isNull() | (F.col("drop_reason") != gates.UNREADABLE)).isEmpty() and not results.isEmpty():
            raise OSError("none of the files could be read")
        rows = output.decompose(gates.passed(results))
        if isinstance(main, KeyedTable):
            main.upsert(rows, batch_of=batch_of)
        else:
            output.write_table(rows, main, "append")
        known = stored_table(spark, harvests, "hid string, type string, date string")
        registry.new_harvests(registry.registered(results), known).write.mode("append").parquet(harvests)
        log(registry.run_counts(results, F.col("scan_error").isNotNull() | failed_steps(results)), "finished")
    except Exception:
        log(nothing, "failed")
        raise
    return spark.read.parquet(runs).filter(F.col("run_id") == run_id)


def stored_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table, or an empty one if nothing is stored yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
