"""New WARC files as a stream: the batch run, for files that no earlier call has seen."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from warcloom.operators.records import normalisation_errors, normalise
from warcloom.plans.run import process, save_results
from warcloom.plans.steps import Step
from warcloom.session import configure
from warcloom.sources.keyed import KeyedTable
from warcloom.sources.warc import scan_files

_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def save_new_files(
    spark: SparkSession,
    folder: str,
    sequences: Mapping[str, Sequence[Step]],
    main: str | KeyedTable,
    harvests: str,
    runs: str,
    checkpoint: str,
    max_files_per_batch: int = 10_000,
) -> None:
    """Process the files of a folder that are not in the `checkpoint` yet, in batches, and end.

    The stream carries paths and lengths only. An interrupted batch is processed again: a keyed table as `main` knows the
    batches of this checkpoint and takes each once; a path, to which rows are appended, gets its rows twice.
    """
    configure(spark)

    def save(batch: DataFrame, number: int) -> None:
        records = normalise(scan_files(batch, all_records=True)).withColumn("errors", normalisation_errors())
        run = process(records, sequences)
        save_results(batch.sparkSession, run, main, harvests, runs, f"batch {number}", (checkpoint, number))

    for_each_batch_of_files(spark, folder, checkpoint, save, max_files_per_batch)


def for_each_batch_of_files(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    action: Callable[[DataFrame, int], None],
    max_files_per_batch: int = 10_000,
) -> None:
    listed = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .load(folder)
        .select("path", "length")
    )
    query = (
        listed.writeStream.foreachBatch(action)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
