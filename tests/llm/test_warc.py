"""WARC archives against plain Python, and against an independent reading of the written files."""

import base64
import glob
import gzip
import hashlib
import random
from collections import defaultdict

import pytest

from kerbside.llm import warc

SCHEMA = "page_id long, url string, html string, id string, row string, holder int"


def rows():
    rng = random.Random(2)
    texts = ["", "é" * 10, "same page " * 400, "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n", "x\r\n" * 70_000, "\0\n"]
    out = [(i, f"http://h/{i}", f"page {i} " * rng.randrange(300), "a", "b", 1) for i in range(40)]
    out += [(100 + i, f"http://h/é {i}\r\nX: y", texts[i % 6], "a", "b", 1) for i in range(50)]
    out += [(500 + i, None, "hot", "a", "b", 1) for i in range(1_500)]
    return out + [(3_000, "u", None, "a", "b", 1), (None, None, "alone", "a", "b", 1), (None, "v", "hot", "a", "b", 1), out[3], out[3], (-7, "w", "hot", "a", "b", 1)]


def brute(rows, least):
    groups = defaultdict(list)
    for r in rows:
        groups[(r[2] or "").encode()].append(r)
    out = []
    for payload, own in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        for n, r in enumerate(own, 1):
            first = n == len(own) or len(payload) < least
            out.append((r[0], len(payload), digest, "response" if first else "revisit", None if first else own[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least, chunk, roll", [(0, 1 << 18, 1 << 28), (11, 1_000, 5_000), (10_000_000, 7, 1)])
def test_round_trip(spark, tmp_path, least, chunk, roll):
    data = rows() if chunk > 100 else rows()[:60]
    pages = spark.createDataFrame(data, SCHEMA).repartition(4)
    archives = warc.write_archives(pages, least, str(tmp_path / "w"), chunk, roll)
    got = warc.page_records(archives)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(data, least)
    assert archives.agg({"records": "sum"}).first()[0] == len(data)


def test_the_chunk_table_carries_running_digests(spark, tmp_path):
    pages = spark.createDataFrame(rows(), SCHEMA)
    chunks = warc.read_archives(warc.write_archives(pages, folder=str(tmp_path / "w"), chunk=999), chunk=4_096).collect()
    records = defaultdict(list)
    for c in chunks:
        records[c.record_id].append(c)
    want = {f"<urn:page:{r[0]}>": (r[2] or "").encode() for r in rows() if r[0] is not None}
    for name, own in records.items():
        payload = b""
        for n, c in enumerate(sorted(own, key=lambda c: c.chunk_no)):
            payload += bytes(c.chunk)
            if own[0].record_type == "response" and name in want and name != "<urn:page:3>":  # that one comes three times
                assert (c.chunk_no, c.bytes_so_far, len(c.chunk) <= 4_096) == (n, len(payload), True)
                assert c.sha1_so_far == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if own[0].record_type == "response" and name in want and name != "<urn:page:3>":
            assert payload == want[name] and own[0].url in (None, "u", "w") or payload == want[name] and own[0].url.startswith("http://h/")


def test_files_are_plain_members_with_exact_lengths(spark, tmp_path):
    warc.write_archives(spark.createDataFrame(rows(), SCHEMA).coalesce(2), folder=str(tmp_path / "w"))
    seen = 0
    for path in glob.glob(str(tmp_path / "w" / "*.warc.gz")):
        data = gzip.open(path).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
            length = int(fields[b"Content-Length"])
            assert head.startswith(b"WARC/1.1\r\n") and rest[length:length + 4] == b"\r\n\r\n"
            data, seen = rest[length + 4:], seen + 1
    assert seen == len(rows())


def test_damage_is_noticed_and_plain_files_are_read(spark, tmp_path):
    head = warc.header("response", 5, "u", 5, hashlib.sha1(b"hello").hexdigest(), None, "2000-01-01T00:00:00Z")
    (tmp_path / "good.warc").write_bytes(head + b"hello\r\n\r\n" + head + b"hello\r\n\r\n")
    (tmp_path / "bad.warc").write_bytes(head + b"hellO\r\n\r\n")
    (tmp_path / "short.warc").write_bytes(head + b"hel")
    at = lambda name: spark.createDataFrame([(str(tmp_path / name),)], "path string")
    assert [r.payload_bytes for r in warc.page_records(at("good.warc")).collect()] == [5, 5]
    with pytest.raises(Exception, match="differs from its digest"):
        warc.page_records(at("bad.warc")).collect()
    with pytest.raises(Exception, match="ends within a record"):
        warc.page_records(at("short.warc")).collect()


def test_no_pages(spark):
    assert warc.page_records(warc.write_archives(spark.createDataFrame([], SCHEMA))).count() == 0
