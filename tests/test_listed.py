"""Runs over an ID list shuffle headers, never payloads, and give the rows of a scan."""

import gzip
import re

from pyspark.sql import functions as F
from test_warc import record, records, wanted

from warcloom.operators.gates import gate_report
from warcloom.operators.records import normalise
from warcloom.plans import steps
from warcloom.plans.run import process_warcs
from warcloom.sources.listed import scan_listed
from warcloom.sources.warc import scan


def ids_of(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id string")


def payloads(frame):
    rows = normalise(frame).collect()
    return {r.id: bytes(r.content) for r in rows if r.is_listed}, len(rows)


def archive(tmp_path):
    """Members of one record, one member of all, a plain file, and a damaged file."""
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, records())))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(b"".join(r.replace(b"urn:uuid:", b"urn:one:") for r in records())))
    (tmp_path / "c.warc").write_bytes(b"".join(r.replace(b"urn:uuid:", b"urn:plain:") for r in records()))
    bad = record("response", 50, b"bad").replace(b"Content-Length", b"Content-Size")
    # the record 52 begins in a member that ends within it, 53 behind that end
    tail = record("response", 52, b"z" * 40) + record("response", 53, b"behind")
    parts = [record("response", 51, b"before"), bad]
    (tmp_path / "d.warc.gz").write_bytes(b"".join(map(gzip.compress, [*parts, tail[:-250], tail[-250:]])))
    return str(tmp_path / "*.warc*")


def test_listed_records(spark, tmp_path):
    glob = archive(tmp_path)
    kinds = ("uuid", "one", "plain")
    everything = {i.replace("uuid", kind): body for i, body in wanted().items() for kind in kinds}
    everything |= {"urn:uuid:51": b"before", "urn:uuid:52": b"z" * 40, "urn:uuid:53": b"behind"}
    listed, n = payloads(scan_listed(spark, glob, ids_of(spark, *everything, None, "urn:none")))
    assert listed == everything and n == scan(spark, glob, all_records=True).count()
    some = ["urn:uuid:3", "urn:one:9", "urn:one:3", "urn:plain:4", "urn:uuid:53"]
    for size in (512 << 20, 700):
        listed, count = payloads(scan_listed(spark, glob, ids_of(spark, *some, *some), split_bytes=size))
        assert listed == {i: everything[i] for i in some} and count == n
    found = scan_listed(spark, glob, ids_of(spark, *some))
    assert found.filter("NOT is_listed AND (content IS NOT NULL OR http_block IS NOT NULL)").isEmpty()


def test_records_without_id(spark, tmp_path):
    nameless = [re.sub(rb"WARC-Record-ID: [^\r]*\r\n", b"", record("response", n, b"%d" % n)) for n in range(4)]
    (tmp_path / "a.warc").write_bytes(b"".join(nameless))
    made = normalise(scan(spark, str(tmp_path / "a.warc"))).orderBy("warc_offset").select("id").collect()
    listed, n = payloads(scan_listed(spark, str(tmp_path / "a.warc"), ids_of(spark, made[2].id)))
    assert listed == {made[2].id: b"2"} and n == 4


def test_empty_archives(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(b"")
    assert scan_listed(spark, str(tmp_path / "a.warc"), ids_of(spark, "urn:uuid:1")).count() == 0


def test_no_payload_is_shuffled(spark, tmp_path):
    glob = archive(tmp_path)
    html = {"HTML": [steps.web_page_type()]}
    run = process_warcs(spark, glob, html, ids_of(spark, "urn:uuid:2", "urn:plain:2", "urn:uuid:0"))
    plan = run.results._jdf.queryExecution().optimizedPlan()
    shuffled = [node for node in plan.toString().splitlines() if "RepartitionByExpression" in node or "Join" in node]
    assert shuffled and "Join" not in "".join(shuffled)
    physical = run.results._jdf.queryExecution().executedPlan().toString()
    below = physical[physical.index("Exchange") :]
    assert "content#" not in below.split("Scan", 1)[0]
    report = {r.reason: r.n_records for r in gate_report(run.results).collect()}
    whole = process_warcs(spark, glob, html)
    assert report["kept"] == 2 and sum(report.values()) == whole.results.count()
    ids = {r.id for r in run.processed.select("id").collect()}
    assert ids == {"urn:uuid:2", "urn:plain:2"}
    shown = run.processed.select("id", F.md5("content").alias("m")).collect()
    assert sorted(shown) == sorted(whole.processed.filter(F.col("id").isin(ids)).select("id", F.md5("content").alias("m")).collect())
