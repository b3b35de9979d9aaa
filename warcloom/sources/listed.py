"""Records of an ID list: found by their headers first, payloads read afterwards for these alone."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warcloom.fixed_values import MAX_RECORD_BYTES, RECORD_TYPES
from warcloom.functions.headers import header_map
from warcloom.operators.records import plain_filename, record_id
from warcloom.session import configure, stored
from warcloom.sources.listing import files
from warcloom.sources.warc import SCHEMA, fetch_records, in_batches, keep_of, scan_files


def scan_listed(
    spark: SparkSession,
    glob: str,
    ids: DataFrame,
    record_types: Iterable[str] = RECORD_TYPES,
    max_record_bytes: int = MAX_RECORD_BYTES,
    split_bytes: int = 512 << 20,
) -> DataFrame:
    """All records as `scan` gives them with `all_records`, and `is_listed`; only listed ones have HTTP block and payload.

    A first pass frames headers and builds no payload; they meet the list in a join. A second pass reads the listed
    records from their offsets. So what is shuffled are headers and offsets, never payloads, and a list of a few records
    costs little more than finding them. Headers are stored between the passes. Null IDs list nothing; repeated ones count once.
    """
    configure(spark)
    listing = files(spark, glob)
    found = scan_files(listing, (), max_record_bytes, split_bytes, all_records=True)
    raw = F.try_element_at(header_map(F.col("rec_block")), F.lit("WARC-Record-ID"))
    named = found.drop("http_block", "content").withColumn(
        "_id", record_id(raw, plain_filename(F.col("warc_filename")), F.col("warc_offset"))
    )
    listed = ids.select(F.col("id").alias("_id")).distinct().withColumn("_in_list", F.lit(True))
    in_list = F.coalesce("_in_list", F.lit(False)) & F.col("rec_block").isNotNull()
    headers = stored(named.join(listed, "_id", "left").withColumn("is_listed", in_list).drop("_id", "_in_list"), "headers")

    places = headers.filter("is_listed").groupBy("warc_filename", F.floor(F.col("warc_offset") / split_bytes).alias("block")).agg(
        F.sort_array(F.collect_set(F.struct("warc_offset", F.md5("rec_block").alias("digest")))).alias("places")
    )
    tasks = max(places.count(), 1)  # parts of files with a listed record: small rows, so their number must be given
    keep = keep_of(record_types, max_record_bytes)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                wanted = {(place["warc_offset"], place["digest"]) for place in row["places"]}
                yield from in_batches(fetch_records(row["warc_filename"], wanted, keep))

    fetched = places.repartitionByRange(tasks, "warc_filename", "block").mapInArrow(fetch, SCHEMA)
    others = headers.filter("NOT is_listed").withColumns(
        {"http_block": F.lit(None).cast("string"), "content": F.lit(None).cast("binary")}
    )
    return fetched.withColumn("is_listed", F.lit(True)).unionByName(others)

