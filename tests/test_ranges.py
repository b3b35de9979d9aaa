"""Plain files read by several tasks give the rows that one task gives."""

import gzip
import random

from test_warc import record

from warcloom.sources.listing import files
from warcloom.sources.warc import plain_ranges, scan


def rows(spark, path, size):
    found = scan(spark, str(path), split_bytes=size, all_records=True).collect()
    return sorted((r.warc_offset, r.rec_block or "", bytes(r.content or b""), r.scan_error or "") for r in found)


def agree(spark, path, sizes):
    whole = rows(spark, path, 1 << 40)
    for size in sizes:
        assert rows(spark, path, size) == whole, size
    return whole


def test_plain_ranges(spark, tmp_path):
    many = [record("response", n, bytes([n % 251]) * (n * 7 % 900)) for n in range(200)]
    (tmp_path / "big.warc").write_bytes(b"".join(many))
    assert len(agree(spark, tmp_path / "big.warc", (997, 20_000))) == 200
    ranges = plain_ranges(files(spark, str(tmp_path / "big.warc")), 20_000)
    assert ranges.count() > 3


def test_archives_in_payloads(spark, tmp_path):
    inner = b"".join(record("response", 100 + n, b"y" * 300) for n in range(40))
    parts = [record("response", 0, b"first"), record("response", 1, inner), record("response", 2, b"\n" + inner[:-700])]
    parts += [record("resource", 3, inner + b"\n\nrest", http=False), record("response", 4, b"last")]
    (tmp_path / "nested.warc").write_bytes(b"".join(parts))
    found = agree(spark, tmp_path / "nested.warc", (500, 2_000, 9_000))
    assert len(found) == 5 and not any(r[3] for r in found)


def test_damaged_plain_files(spark, tmp_path):
    chance = random.Random(3)
    parts = [record("response", n, bytes(chance.randrange(256) for _ in range(200))) for n in range(40)]
    parts[7] = parts[7].replace(b"Content-Length", b"Content-Size")
    parts[8] = b"NOISE" + parts[8]
    parts[20] = parts[20].replace(b"Content-Length: ", b"Content-Length: 9")  # takes in the records behind it
    parts[38] = parts[38][:-150]
    (tmp_path / "damaged.warc").write_bytes(b"".join(parts))
    found = agree(spark, tmp_path / "damaged.warc", (450, 3_000))
    assert any(r[3] for r in found)
    (tmp_path / "blank.warc").write_bytes(b"\r\n" * 3_000)
    assert agree(spark, tmp_path / "blank.warc", (1_000,)) == []
    (tmp_path / "packed.warc").write_bytes(gzip.compress(b"".join(parts[:5])))
    assert len(agree(spark, tmp_path / "packed.warc", (100,))) == 5
    (tmp_path / "plain.warc.gz").write_bytes(b"".join(parts[:5]))
    assert len(agree(spark, tmp_path / "plain.warc.gz", (100, 500))) == 5
