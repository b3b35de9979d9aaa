"""Transfer encodings: all or nothing, with a reason."""

from __future__ import annotations

import gzip

import pytest

from warcloom.sources.warc import NOT_DECODED, _decoded


def chunked(*parts, end=b"0\r\n\r\n"):
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + end


ZIPPED = gzip.compress(b"page")


@pytest.mark.parametrize(
    "body, fields, want",
    [
        (chunked(b"abc", b"d" * 20), {"transfer-encoding": "chunked"}, b"abc" + b"d" * 20),
        (b"3;name=x\r\nabc\r\n0\r\n\r\n", {"transfer-encoding": "Chunked"}, b"abc"),
        (chunked(ZIPPED[:9], ZIPPED[9:]), {"transfer-encoding": "gzip, chunked"}, b"page"),
        (chunked(ZIPPED), {"transfer-encoding": "chunked", "content-encoding": "gzip"}, b"page"),
        (b"<p>stored without chunks", {"transfer-encoding": "chunked"}, b"<p>stored without chunks"),
        (b"", {"transfer-encoding": "chunked"}, b""),
        (chunked(b"abc", end=b""), {"transfer-encoding": "chunked"}, b"abc"),
    ],
)
def test_whole_bodies(body, fields, want):
    assert _decoded(body, fields) == (want, None)


@pytest.mark.parametrize(
    "body, fields",
    [
        (b"10\r\nabc", {"transfer-encoding": "chunked"}),
        (chunked(b"abc", end=b"7\r\nab"), {"transfer-encoding": "chunked"}),
        (chunked(b"abc", end=b"no size\r\nrest"), {"transfer-encoding": "chunked"}),
        (chunked(ZIPPED[:9]), {"transfer-encoding": "gzip, chunked"}),
    ],
)
def test_broken_bodies_stay_as_they_are(body, fields):
    data, error = _decoded(body, fields)
    assert data == body and error and (error.endswith(NOT_DECODED) or "gzip" in error)
