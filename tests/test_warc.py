"""WARC files written by the test, read by the scan."""

import gzip
import zlib

from pyspark.sql import functions as F

from warcloom.operators.records import normalise
from warcloom.sources import listing
from warcloom.sources.warc import scan

CRLF = b"\r\n"


def record(kind, number, body, *, url=None, http=True, fields=(), warc_fields=()):
    block = body
    if http:
        head = ["HTTP/1.1 200 OK", "Content-Type: text/html", *fields]
        block = CRLF.join(h.encode() for h in head) + CRLF * 2 + body
    lines = [
        "WARC/1.0",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{number}>",
        f"WARC-Target-URI: {url or f'http://example.com/{number}'}",
        "WARC-Date: 2020-01-01T00:00:00Z",
        f"Content-Length: {len(block)}",
        *warc_fields,
    ]
    return CRLF.join(line.encode() for line in lines) + CRLF * 2 + block + CRLF * 2


def records():
    body = "<p>Žluťoučký kůň</p>".encode()
    raw = zlib.compressobj(wbits=-15)
    return [
        record("warcinfo", 0, b"software: test", http=False, url="urn:none"),
        record("request", 1, b"GET / HTTP/1.1\r\n\r\n", http=False),
        record("response", 2, body, fields=["X: 1", "X: 2"]),
        record("response", 3, b"4\r\nWiki\r\n5;ext=1\r\npedia\r\n0\r\n\r\n", fields=["Transfer-Encoding: chunked"]),
        record("response", 4, gzip.compress(body), fields=["Content-Encoding: gzip"]),
        record("response", 5, raw.compress(body) + raw.flush(), fields=["Content-Encoding: deflate"]),
        record("response", 6, b"kept", fields=["Content-Encoding: non-exist-compression"]),
        record("response", 7, b"kept", fields=["Content-Encoding: br"]),
        record("revisit", 8, b"", warc_fields=["WARC-Refers-To: <urn:uuid:2>"]),
        record("response", 9, b"x" * 5000),
        record("response", 10, b"not chunked", fields=["Transfer-Encoding: chunked"]),
        record("response", 11, b"broken", fields=["Content-Encoding: gzip"]),
    ]


def wanted(body="<p>Žluťoučký kůň</p>".encode()):
    return {
        "urn:uuid:2": body,
        "urn:uuid:3": b"Wikipedia",
        "urn:uuid:4": body,
        "urn:uuid:5": body,
        "urn:uuid:6": b"kept",
        "urn:uuid:7": b"kept",
        "urn:uuid:8": b"",
        "urn:uuid:9": b"x" * 5000,
        "urn:uuid:10": b"not chunked",
        "urn:uuid:11": b"broken",
    }


def contents(frame):
    rows = normalise(frame).filter("warc_type IS NOT NULL").collect()
    return {row["id"]: bytes(row["content"]) for row in rows}


def test_gzip_members(spark, tmp_path):
    members = [gzip.compress(r) for r in records()]
    (tmp_path / "good.warc.gz").write_bytes(b"".join(members))
    rows = normalise(scan(spark, f"file://{tmp_path}/*.warc.gz")).orderBy("warc_offset").collect()
    assert {row["id"]: bytes(row["content"]) for row in rows} == wanted()
    starts, at = [], 0
    for member in members:
        starts.append(at)
        at += len(member)
    assert [row["warc_offset"] for row in rows] == starts[2:]
    by_id = {row["id"]: row for row in rows}
    assert by_id["urn:uuid:2"]["http_headers"]["X"] == "2"
    assert by_id["urn:uuid:8"]["is_revisit"] and by_id["urn:uuid:8"]["refers_to"] == "urn:uuid:2"
    assert "br" in by_id["urn:uuid:7"]["scan_error"] and "broken" in by_id["urn:uuid:11"]["scan_error"]


def test_plain_file_and_offsets(spark, tmp_path):
    (tmp_path / "plain.warc").write_bytes(b"".join(records()))
    rows = normalise(scan(spark, str(tmp_path / "plain.warc"))).orderBy("warc_offset").collect()
    assert {row["id"]: bytes(row["content"]) for row in rows} == wanted()
    starts = [sum(map(len, records()[:i])) for i in range(len(records()))]
    assert [row["warc_offset"] for row in rows] == starts[2:]


def test_one_stream_for_all_records(spark, tmp_path):
    (tmp_path / "stream.warc.gz").write_bytes(gzip.compress(b"".join(records())))
    assert contents(scan(spark, str(tmp_path / "stream.warc.gz"))) == wanted()


def test_ranges_give_every_record_once(spark, tmp_path):
    many = [record("response", n, bytes([n % 251]) * (n * 7 % 900)) for n in range(300)]
    data = b"".join(gzip.compress(r) for r in many)
    (tmp_path / "big.warc.gz").write_bytes(data)
    whole = scan(spark, str(tmp_path / "big.warc.gz"))
    for size in (97, 1000, 20_000, len(data)):
        parts = scan(spark, str(tmp_path / "big.warc.gz"), split_bytes=size)
        key = F.concat_ws("|", "warc_offset", F.md5("content"))
        assert sorted(r[0] for r in parts.select(key).collect()) == sorted(r[0] for r in whole.select(key).collect())
    assert whole.count() == 300


def test_broken_files_keep_earlier_rows(spark, tmp_path):
    members = [gzip.compress(r) for r in records()]
    (tmp_path / "cut.warc.gz").write_bytes(b"".join(members)[:-100])
    (tmp_path / "junk.warc.gz").write_bytes(b"this is no archive")
    (tmp_path / "empty.warc").write_bytes(b"")
    scanned = scan(spark, f"{tmp_path}/*").cache()
    assert contents(scanned).keys() == wanted().keys() - {"urn:uuid:11"}
    errors = {r[0].rsplit("/", 1)[1] for r in scanned.filter("rec_block IS NULL").select("warc_filename").collect()}
    assert errors == {"cut.warc.gz", "junk.warc.gz"}


def test_limits_of_the_scan(spark, tmp_path):
    (tmp_path / "plain.warc").write_bytes(b"".join(records()))
    small = contents(scan(spark, str(tmp_path / "plain.warc"), max_record_bytes=4000))
    assert small.keys() == wanted().keys() - {"urn:uuid:9"}
    requests = contents(scan(spark, str(tmp_path / "plain.warc"), record_types=["request"]))
    assert list(requests) == ["urn:uuid:1"]


def test_broken_records_hide_no_others(spark, tmp_path):
    five = [record("response", n, b"body %d" % n) for n in range(5)]
    broken = {
        "length": five[1].replace(b"Content-Length", b"Content-Size"),
        "number": five[1].replace(b"Content-Length: ", b"Content-Length: x"),
        "start": b"NOISE" + five[1],
    }
    for name, bad in broken.items():
        parts = [five[0], bad, *five[2:]]
        (tmp_path / f"{name}.warc").write_bytes(b"".join(parts))
        (tmp_path / f"{name}.warc.gz").write_bytes(b"".join(map(gzip.compress, parts)))
        for path, sizes in ((f"{name}.warc", [512 << 20]), (f"{name}.warc.gz", [512 << 20, 100, 300])):
            for size in sizes:
                rows = scan(spark, str(tmp_path / path), split_bytes=size).collect()
                assert sorted(r.content for r in rows if r.content) == [b"body 0", b"body 2", b"body 3", b"body 4"]
                assert sum(r.rec_block is None for r in rows) == 1


def test_stacked_and_cut_encodings(spark, tmp_path):
    text = b"first-" + b"second" * 50
    coded = [
        ("gzip", gzip.compress(b"first-") + gzip.compress(b"second" * 50), text, None),
        ("gzip", gzip.compress(text)[:-12], None, "cut off"),
        ("deflate, gzip", gzip.compress(zlib.compress(text)), text, None),
        ("gzip, zstd", b"anything", b"anything", "is not decoded"),
    ]
    made = [record("response", n, body, fields=[f"Content-Encoding: {name}"]) for n, (name, body, _, _) in enumerate(coded)]
    (tmp_path / "coded.warc").write_bytes(b"".join(made))
    rows = scan(spark, str(tmp_path / "coded.warc")).orderBy("warc_offset").collect()
    for row, (_, body, want, error) in zip(rows, coded, strict=True):
        assert bytes(row.content) == (body if want is None else want)
        assert row.scan_error is None if error is None else error in row.scan_error


def test_dropped_records_are_counted(spark, tmp_path):
    from warcloom.operators.gates import gate_report
    from warcloom.plans import steps
    from warcloom.plans.run import process_warcs

    lost = record("response", 20, b"x").replace(b"Content-Length", b"Content-Size")
    (tmp_path / "a.warc").write_bytes(b"".join([*records(), lost, record("response", 21, b"<p>last</p>")]))
    run = process_warcs(spark, str(tmp_path / "a.warc"), {"HTML": [steps.web_page_type()]})
    report = {r.reason: r.n_records for r in gate_report(run.results).collect()}
    assert report["record type"] == 2 and report["unreadable"] == 1
    assert sum(report.values()) == len(records()) + 2


def test_lists(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("  urn:uuid:1 \n\nurn:uuid:2\nurn:uuid:1\n")
    assert {r[0] for r in listing.id_list(spark, str(tmp_path / "ids.txt")).collect()} == {"urn:uuid:1", "urn:uuid:2"}
    (tmp_path / "cs.txt").write_text("A\t12\n\n  je 3\nje\t1\n", encoding="utf-8")
    (tmp_path / "en.txt").write_text("The\t9\n", encoding="utf-8")
    loaded = listing.stoplists(spark, {"cs": str(tmp_path / "cs.txt"), "en": str(tmp_path / "en.txt")})
    assert sorted(map(tuple, loaded.collect())) == [("cs", "a"), ("cs", "je"), ("en", "the")]
    (tmp_path / "config.json").write_text('{"webtypes": {"value":\n {"eshop": 0}, "note": "x"}}')
    assert sorted(map(tuple, listing.config_rows(spark, str(tmp_path / "config.json")).collect())) == [
        ("webtypes", "note", "x"),
        ("webtypes", "value", '{"eshop":0}'),
    ]
    with gzip.open(tmp_path / "corpus.txt.gz", "wt", encoding="utf-8") as out:
        out.write("Jedna dvě.\nTři\n")
    assert listing.corpus(spark, str(tmp_path / "corpus.txt.gz"), "cs").count() == 2
    assert {r["length"] > 0 for r in listing.files(spark, f"{tmp_path}/*").collect()} == {True}
