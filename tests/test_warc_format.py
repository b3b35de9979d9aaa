"""The data source: rows of the scan, filters and columns taken over by the reader."""

import gzip
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In, IsNotNull, LessThan, LessThanOrEqual
from test_warc import record, records

from warcloom.sources import warc_format
from warcloom.sources.warc import scan
from warcloom.sources.warc_format import WarcReader


def archive(tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, records())))
    (tmp_path / "b.warc").write_bytes(b"".join([*records(), b"NOISE\n" + record("response", 30, b"x")]))
    (tmp_path / "notes.txt").write_text("no archive")
    return f"{tmp_path}/*.warc*"


def test_rows_of_the_scan(spark, tmp_path):
    glob = archive(tmp_path)
    columns = ["warc_offset", "rec_block", "http_block", "content", "scan_error"]
    want = scan(spark, glob, record_types=["request", "warcinfo", "response", "revisit"], all_records=True)
    read = warc_format.register(spark).read.format("warc")
    for size in (512 << 20, 300):
        found = read.option("splitBytes", size).load(glob)
        assert found.exceptAll(found.limit(0)).count() == want.count()
        assert sorted(map(repr, found.select(*columns).collect())) == sorted(map(repr, want.select(*columns).collect()))
    names = {r[0].rsplit("/", 1)[1] for r in read.load(glob).select("warc_filename").distinct().collect()}
    assert names == {"a.warc.gz", "b.warc"}
    assert read.load(str(tmp_path / "b.warc")).count() == 14


def test_filters_reach_the_reader(spark, tmp_path):
    found = warc_format.register(spark).read.format("warc").load(archive(tmp_path))
    large = found.filter("warc_type = 'response' AND warc_record_size <= 1000 AND warc_record_id IN ('urn:uuid:9', 'urn:uuid:3')")
    assert [r[0] for r in large.select("warc_record_id").distinct().collect()] == ["urn:uuid:3"]
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"= response|<= 1000|IN \(urn", plan.split("BatchScan")[0])
    one = found.filter(F.col("warc_filename").endswith("b.warc") & (F.col("warc_type") == "revisit"))
    assert [r.warc_record_id for r in one.collect()] == ["urn:uuid:8"]


def test_payloads_are_built_for_wanted_rows_alone(tmp_path):
    path = archive(tmp_path)

    def rows(names, *filters):
        reader = WarcReader(names, path, 1 << 30)
        rest = list(reader.pushFilters(list(filters)))
        return [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()], rest, reader

    kind = In(("warc_type",), ("revisit", "response"))
    found, rest, reader = rows(["warc_record_id", "content"], kind, IsNotNull(("warc_type",)), LessThan(("warc_record_size",), 200))
    assert len(rest) == 1 and reader.most == 199 and len(found) == 2 * 9 + 1
    assert all(r["content"] is not None for r in found)
    found, _, _ = rows(["warc_record_id"], kind, LessThanOrEqual(("warc_record_size",), 10**9), EqualTo(("warc_type",), "revisit"))
    assert found == [{"warc_record_id": "urn:uuid:8"}] * 2
    found, _, reader = rows(["warc_offset"], EqualTo(("warc_filename",), "file:/none"))
    assert found == [] and [p.path for p in reader.partitions()] == [""]


def test_unknown_column(spark, tmp_path):
    with pytest.raises(Exception, match="no column 'other'"):
        warc_format.register(spark).read.format("warc").schema("other string").load(archive(tmp_path)).collect()
