"""Operator 13: archives written, read back, and read by a plain reader."""

import gzip
import hashlib
import random
from collections import Counter

import pytest

from claimloom.llm import warc
from claimloom.session import fresh_path

ROWS = "page_id long, url string, html string, data string, digest string, n int, first long, file string, bytes long"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, 2, "z", 3) for r in rows], ROWS)


def plain_pages(rows):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        ids = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        again = len(data) >= warc.MIN_BYTES and ids and (i is None or i > min(ids))
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", min(ids) if again else None))
    return Counter(out)


def plain_read(path):
    """Records of one archive, read whole: header lines and block."""
    data, out = gzip.open(path).read(), []
    while data:
        header, rest = data.split(b"\r\n\r\n", 1)
        lines = header.decode().split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        n = int(fields["Content-Length"])
        assert lines[0] == "WARC/1.1" and rest[n : n + 4] == b"\r\n\r\n"
        out.append((fields, rest[:n]))
        data = rest[n + 4 :]
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("ab <p>é日\U0001f642\r\n\0") for _ in range(n))
    same, edge = text(400), "é" * 50
    rows = [(k, f"http://a/{k}", text(rng.randint(0, 3000))) for k in range(40)]
    rows += [(100 + k, "http://copy/", same) for k in range(30)] + [(None, None, same), (None, "http://b/\r\nX: y", None), (-3, "", same), (100, "http://copy/", same)]
    rows += [(200, "u", edge), (201, "u", edge), (202, "u", edge[:-1] + "a"), (203, "u", edge[:-1] + "a"), (204, "u", None), (205, "u", "")]
    return rows + [(300, "long", text(200_000)), (301, "http", "HTTP/1.1 200 OK\r\n\r\nx" * 20), (None, "n", "z" * 200), (None, "n", "z" * 200)]


def test_round_trip(spark, rows):
    folder = fresh_path(spark, "archives")
    manifest = warc.write(pages_of(spark, rows).repartition(3), folder, file_bytes=20_000)
    files = [r.file for r in manifest.collect()]
    assert len(files) > 3 and sum(r.records for r in manifest.collect()) == len(rows) + len(files)
    table = warc.chunks(manifest, chunk=1000)
    assert Counter(tuple(r) for r in warc.pages(table).collect()) == plain_pages(rows)
    assert Counter(tuple(r) for r in warc.pages(warc.chunks(manifest, data=False)).collect()) == plain_pages(rows)
    # another reader finds the same records
    found = [x for f in files for x in plain_read(f.removeprefix("file://"))]
    payloads = {(x["Page-Id"], b.split(b"\r\n\r\n", 1)[1]) for x, b in found if x["WARC-Type"] == "response" and "Page-Id" in x}
    kinds = plain_pages(rows)
    want = {(str(i), (h or "").encode()) for i, _, h in rows for n, _, d, kind, _ in kinds if i is not None and (n, d, kind) == (i, hashlib.sha256((h or "").encode()).hexdigest(), "response")}
    assert payloads == want
    by_id = {x["WARC-Record-ID"] for x, _ in found}
    assert all(x["WARC-Refers-To"] in by_id and b.endswith(b"\r\n\r\n") for x, b in found if x["WARC-Type"] == "revisit")
    # whole payloads from chunks, digests of every prefix
    got = warc.whole(table).where("headers['WARC-Type'] = 'response'").collect()
    assert {(r.headers.get("Page-Id"), bytes(r.payload)) for r in got if "Page-Id" in r.headers} == payloads
    long = table.where("headers['Page-Id'] = '300'").orderBy("chunk").collect()
    data = next(h for i, _, h in rows if i == 300).encode()
    assert len(long) == -(-len(data) // 1000) and [r.last for r in long] == [False] * (len(long) - 1) + [True]
    assert all(r.sha256 == hashlib.sha256(data[: r.bytes]).hexdigest() for r in long) and all(len(r.data) <= 1000 for r in long)


def test_other_archives(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n" + b"p" * 5000
    first = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Type: application/http;msgtype=response\r\ncontent-length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"
    second = b"WARC/1.0\r\nWARC-Type: metadata\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(first + second)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(first + second))
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(first) + gzip.compress(second))
    (tmp_path / "empty.warc").write_bytes(b"")
    files = spark.createDataFrame([(str(p),) for p in sorted(tmp_path.iterdir())], "file string")
    got = warc.whole(warc.chunks(files, chunk=700)).orderBy("file", "record").collect()
    assert [bytes(r.payload) for r in got] == [b"p" * 5000, b"abc"] * 3
    assert {r.offset for r in warc.chunks(files).where("file like '%a.warc' and record = 1").collect()} == {len(first)}
    assert {r.offset for r in warc.chunks(files).where("file like '%c.warc.gz' and record = 1").collect()} == {len(gzip.compress(first))}
    (tmp_path / "cut.warc").write_bytes(first[:3000])
    with pytest.raises(Exception, match="cut off"):
        warc.chunks(spark.createDataFrame([(str(tmp_path / "cut.warc"),)], "file string")).collect()


def test_empty_table(spark):
    manifest = warc.write(pages_of(spark, []), fresh_path(spark, "archives"))
    assert manifest.count() == 0 and warc.pages(warc.chunks(manifest)).count() == 0


def test_split_digests(spark, rows, monkeypatch):
    """Beyond the bound for a broadcast the join splits hot digests."""
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", 0)
    folder = fresh_path(spark, "archives")
    assert Counter(tuple(r) for r in warc.pages(warc.chunks(warc.write(pages_of(spark, rows), folder))).collect()) == plain_pages(rows)
