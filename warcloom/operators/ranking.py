"""Top rows per group where a group may be any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64


def top_n_per_group(
    rows: DataFrame, group: list[str], order: list[Column], n: int, spread: list[str], rank: str = "rank"
) -> DataFrame:
    """The first `n` rows of every group, with their rank.

    A group is first cut into SALTS parts by the columns `spread`; each part keeps its own first `n`, and only these
    meet in one task. So one task never sees more than SALTS x `n` rows of a group, and no row is lost that belongs to
    the result.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS)))
    parts = Window.partitionBy(*group, "_salt").orderBy(*order)
    whole = Window.partitionBy(*group).orderBy(*order)
    kept = salted.withColumn(rank, F.row_number().over(parts)).filter(F.col(rank) <= n).drop("_salt", rank)
    return kept.withColumn(rank, F.row_number().over(whole)).filter(F.col(rank) <= n)
