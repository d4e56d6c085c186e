import gzip
import hashlib
import io

import pytest

from clickvault.llm.common import fresh_path, list_files
from clickvault.llm.warc import members, parse, read_warc, write_warc

PAGES = "page_id long, url string, html string, digest string, record string, part int"


def expected(rows):
    """Brute force over (page_id, url, html)."""
    out = []
    for page, _, html, *_ in rows:
        body = (html or "").encode()
        same = [p for p, _, h, *_ in rows if (h or "").encode() == body and p is not None]
        target = max(same) if len(body) >= 1000 and same and sum((h or "").encode() == body for _, _, h, *_ in rows) > 1 else None
        revisit = target is not None and target != page
        out.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", target if revisit else None))
    return sorted(out, key=str)


ROWS = [(1, "http://a/x y\r\nEvil: 1", "é" * 600, "c", "c", 1), (2, None, None, "c", "c", 1), (3, "http://b/", "", "c", "c", 1),
        (5, "http://c/", "é" * 600, "c", "c", 1), (9, "http://d/", "é" * 600, "c", "c", 1), (9, "http://d/", "é" * 600, "c", "c", 1),
        (None, "http://e/", "é" * 600, "c", "c", 1), (10, "http://f/", "short", "c", "c", 1), (11, "http://f/", "short", "c", "c", 1),
        (12, "http://g/", "x\r\n\r\ny" * 300, "c", "c", 1), (13, "http://日本/", "z" * 400_000, "c", "c", 1)]


@pytest.mark.parametrize("roll", [700, 32 << 20])
def test_round_trip(spark, roll):
    out = fresh_path(spark, "t-warc")
    manifest = write_warc(spark.createDataFrame(ROWS, PAGES).repartition(3), out, roll_bytes=roll)
    got = read_warc(spark, out).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(ROWS)
    assert sum(m["records"] for m in manifest) == len(ROWS) and (len(manifest) > 1) == (roll == 700)
    texts = {r.page_id: bytes(r.payload) for r in got if r.record_type == "response"}
    assert texts[12] == ("x\r\n\r\ny" * 300).encode() and texts[2] == b""


def test_same_files_whatever_the_partitions(spark):
    digests = []
    for n in (1, 4):
        out = fresh_path(spark, "t-warc")
        write_warc(spark.createDataFrame(ROWS, PAGES).repartition(n), out, roll_bytes=900)
        files = [p.removeprefix("file:") for p, _ in list_files(spark, out) if p.endswith(".gz")]
        digests.append([(p.rsplit("/", 1)[1], hashlib.sha1(open(p, "rb").read()).hexdigest()) for p in files])
        for p in files:  # any gzip reader sees whole records in order
            raw = b"".join(members(open(p, "rb").read()))
            assert gzip.GzipFile(fileobj=io.BytesIO(open(p, "rb").read())).read() == raw
    assert digests[0] == digests[1] and len(digests[0]) > 1


def test_empty(spark):
    out = fresh_path(spark, "t-warc")
    assert write_warc(spark.createDataFrame([], PAGES), out) == []


def test_broken_record():
    from clickvault.llm.warc import build
    raw = build(1, "http://a/", b"abc", hashlib.sha1(b"abc").hexdigest(), None, "2000-01-01T00:00:00Z")
    assert parse(raw)["payload"] == b"abc"
    with pytest.raises(ValueError):
        parse(raw.replace(b"abc", b"abd"))
    with pytest.raises(ValueError):
        list(members(gzip.compress(raw)[:-3]))
