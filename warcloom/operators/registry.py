"""Harvest registry, run log, and reads of keyed and versioned tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warcloom.fixed_values import TABLE_MAX_VERSIONS
from warcloom.operators.gates import UNREADABLE
from warcloom.operators.ranking import top_n_per_group
from warcloom.operators.records import harvest_info


def new_harvests(records: DataFrame, known: DataFrame) -> DataFrame:
    """Harvests (hid, type, date) among the records that the registry does not know yet.

    Records are reduced to distinct harvests in every task first; then the registry is asked once, by an anti join.
    """
    info = harvest_info(F.col("warc_filename"))
    seen = (
        records.filter(F.coalesce(F.col("harvest_id"), F.lit("")) != "")
        .groupBy(F.col("harvest_id").alias("hid"))
        .agg(F.min(F.struct(info["type"].alias("type"), info["date"].alias("date"))).alias("info"))
    )
    return seen.join(known.select("hid"), "hid", "left_anti").select("hid", "info.type", "info.date")


def register_harvests(records: DataFrame, known: DataFrame) -> DataFrame:
    """The registry with new harvests added; known rows stay as they are."""
    return known.select("hid", "type", "date").unionByName(new_harvests(records, known))


def run_harvests(records: DataFrame) -> DataFrame:
    """Distinct harvests of a run, in order."""
    return (
        records.filter(F.coalesce(F.col("harvest_id"), F.lit("")) != "").select("harvest_id").distinct().orderBy("harvest_id")
    )


def run_counts(gated: DataFrame, failed: Column) -> DataFrame:
    """One row: records_processed, records_failed, and the sorted array of harvests.

    Counts are aggregates over the output, so a retried task counts once. What the scan could not read has failed.
    """
    kept = F.col("drop_reason").isNull()
    per_harvest = gated.groupBy("harvest_id").agg(
        F.count_if(kept & ~failed).alias("processed"),
        F.count_if((kept & failed) | (F.col("drop_reason") == UNREADABLE)).alias("failed"),
        F.count_if(~F.coalesce("drop_reason", F.lit("")).isin(_UNSEEN)).alias("seen"),
    )
    known = F.when((F.col("seen") > 0) & (F.col("harvest_id") != ""), F.col("harvest_id"))
    return per_harvest.agg(
        F.coalesce(F.sum("processed"), F.lit(0)).alias("records_processed"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("records_failed"),
        F.sort_array(F.collect_set(known)).alias("harvests"),
    )


# Records stopped by these gates are not registered.
_UNSEEN = [UNREADABLE, "record type", "record size", "not listed", "metadata filter", "invalid record"]


def registered(gated: DataFrame) -> DataFrame:
    """Records whose harvest counts: those that reach the MIME type gate, whether they pass it or not."""
    return gated.filter(~F.coalesce("drop_reason", F.lit("")).isin(_UNSEEN))


def run_row(counts: DataFrame, run_id: str, args: str, started_ms: int, finished_ms: int | None, status: str):
    """The row a run has in the table of runs."""
    return counts.select(
        F.lit(run_id).alias("run_id"),
        F.lit(args).alias("cmd_args"),
        F.lit(started_ms).cast("long").alias("t_started"),
        F.lit(finished_ms).cast("long").alias("t_finished"),
        F.lit(status).alias("operation_status"),
        "records_processed",
        "records_failed",
        "harvests",
    )


def get_row(table: DataFrame, key: str, column: str = "key") -> DataFrame:
    """The row of a key, or none. The comparison reaches the Parquet scan, which skips row groups by statistics."""
    return table.filter(F.col(column) == key)


def has_row(table: DataFrame, key: str, column: str = "key") -> bool:
    return not get_row(table, key, column).isEmpty()


def prefix_scan(table: DataFrame, prefix: str, column: str = "key") -> DataFrame:
    """Rows whose key begins with a prefix; all rows for the empty one."""
    return table.filter(F.col(column).startswith(prefix)) if prefix else table


def keep_versions(versions: DataFrame, limit: int = TABLE_MAX_VERSIONS["config"]) -> DataFrame:
    """The `limit` newest versions of every cell (row, col, value, version)."""
    newest = [F.col("version").desc(), F.col("value").asc()]
    return top_n_per_group(versions, ["row", "col"], newest, limit, spread=["version", "value"], rank="nth")


def cell_versions(versions: DataFrame, row: str, col: str) -> DataFrame:
    """All versions of one cell, newest first."""
    return versions.filter((F.col("row") == row) & (F.col("col") == col)).orderBy(F.col("version").desc())


def cell_history(versions: DataFrame, limit: int = TABLE_MAX_VERSIONS["config"]) -> DataFrame:
    """Kept versions of all cells with their place in the history, 1 is the newest."""
    return keep_versions(versions, limit)
