"""WARC archives as a chunked record table: written from pages, read back in bounded pieces with running digests.

A page is one record, its payload the html in UTF-8. Of pages with equal payloads of at least ``least`` bytes the one with the
largest page_id is a ``response``; the others are ``revisit`` records that name it and hold no payload. Archives are files of
gzip members, a record each (WARC/1.1), which ``read_archives`` also reads if others wrote them.

Method. No task holds a record whole outside Spark's own row. A payload goes to the writer as rows (record, chunk number,
chunk), which it compresses as they come; the reader inflates, parses and hashes piece by piece and gives rows (record_id,
chunk_no, bytes so far, SHA-1 so far), so a record's last chunk carries the size and digest of the whole, and every
earlier one what is needed to see where damage began. A payload that differs from its header's digest stops the job.

Edge cases: a null html is an empty payload; a null page_id is smaller than all others and its record id ends in ``null``; of rows
equal in page_id and payload one is the response, the others revisit it; a null url is left out, characters that a header
cannot hold are percent-encoded; an empty table gives no archive and no rows. Further columns are ignored.

Scale: equal payloads are found by (SHA-1, length, 64-bit hash). A Bloom filter of the repeated ones keeps all other pages out
of every shuffle: they go from the scan to the archive. For the rest, one payload per group and task moves, whatever the
number of copies; groups with more than a thousandth of all rows (at most a thousand) are broadcast to their copies.
A task writes files of its own names, and only those that its result lists belong to the archive: a task that runs twice, or is
lost, leaves files that nobody reads. Archive files are opened by ``pyarrow.fs``, which must know the scheme of ``folder``.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyarrow import fs as file_systems
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm import sketches
from kerbside.llm.common import stored
from kerbside.session import work_folder

CHUNK = 1 << 18
ROLL = 1 << 28  # an archive file ends with the record that takes it past so many bytes
SAME = ["sha1", "payload_bytes", "mark"]
RECORD = "urn:page:"
#: Fixed values of the format.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http;msgtype=response"


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def described(pages: DataFrame) -> DataFrame:
    """(id, url, payload, sha1, payload_bytes, mark): each page with what equal payloads have in common."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select(F.col("page_id").cast("long").alias("id"), F.col("url").cast("string").alias("url"), payload.alias("payload")).select(
        "*", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("payload_bytes"), F.xxhash64("payload").alias("mark"))


def revisits_of(rows: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """(id, url, sha1, payload_bytes, refers_to): the rows of repeated payloads, without those that hold them."""
    hot = groups.filter(F.col("n") > max(total // 1_000, 1_000))
    rest = groups.filter(F.col("n") <= max(total // 1_000, 1_000))
    rows = rows.join(F.broadcast(hot.select(*SAME, F.col("holder").alias("hot_holder"))), SAME, "left")
    in_hot = rows.filter("hot_holder IS NOT NULL").withColumnRenamed("hot_holder", "holder")
    others = rows.filter("hot_holder IS NULL").drop("hot_holder").join(rest.select(*SAME, "holder"), SAME)
    return in_hot.unionByName(others).filter("row <> holder.row").select(
        "id", "url", "sha1", "payload_bytes", F.col("holder.id").alias("refers_to"))


def header(kind: str, page_id: int | None, url: str | None, size: int, sha1: str, refers_to: int | None, date: str) -> bytes:
    """Everything of a record before its payload."""
    name = lambda i: f"<{RECORD}{'null' if i is None else i}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="".join(map(chr, range(33, 127)))))
    lines.append(f"WARC-Payload-Digest: sha1:{base32(bytes.fromhex(sha1))}")
    if kind == "revisit":
        lines += [f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {SAME_PAYLOAD}"]
    lines += [f"Content-Type: {HTTP}", f"Content-Length: {len(http) + (size if kind == 'response' else 0)}", "", ""]
    return "\r\n".join(lines).encode() + http.encode()


class ArchiveWriter:
    """Archive files of one task: records come as chunks, in order, and are compressed as they come."""

    def __init__(self, folder: str, roll: int, level: int) -> None:
        self.files, self.base = file_systems.FileSystem.from_uri(folder)
        self.folder, self.roll, self.level, self.out = folder, roll, level, None

    def begin(self, head: bytes) -> None:
        if self.out is None:
            self.name, self.records = f"{uuid.uuid4().hex}.warc.gz", 0
            self.files.create_dir(self.base, recursive=True)
            self.out = self.files.open_output_stream(f"{self.base}/{self.name}", compression=None)
        self.pack = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        self.add(head)

    def add(self, data: bytes) -> None:
        self.out.write(self.pack.compress(data))

    def end(self) -> Iterator[tuple]:
        self.out.write(self.pack.compress(b"\r\n\r\n") + self.pack.flush())
        self.records += 1
        if self.out.tell() >= self.roll:
            yield from self.close()

    def close(self) -> Iterator[tuple]:
        if self.out is not None:
            size = self.out.tell()
            self.out.close()
            self.out = None
            yield f"{self.folder}/{self.name}", self.records, size


def write_chunks(chunks: DataFrame, folder: str, date: str, roll: int = ROLL, level: int = 1) -> DataFrame:
    """Write (kind, id, url, sha1, payload_bytes, refers_to, chunk_no, chunk), a record's chunks one after the other; returns the
    written files (path, records, bytes)."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        to, left = ArchiveWriter(folder, roll, level), 0
        plain = lambda x: None if pd.isna(x) else x
        for batch in batches:
            done = []
            for r in batch.astype({"id": object, "refers_to": object}).itertuples(index=False):
                if r.chunk_no == 0:
                    if left:
                        raise ValueError("a record's chunks are not together")
                    page, other = plain(r.id), plain(r.refers_to)
                    to.begin(header(r.kind, None if page is None else int(page), plain(r.url), r.payload_bytes, r.sha1,
                                    None if other is None else int(other), date))
                    left = r.payload_bytes if r.kind == "response" else 0
                to.add(r.chunk)
                left -= len(r.chunk)
                if not left:
                    done.extend(to.end())
            yield pd.DataFrame(done, columns=["path", "records", "bytes"])
        yield pd.DataFrame(list(to.close()), columns=["path", "records", "bytes"])

    # ids as text: a long column with nulls would pass through floating point
    as_text = chunks.withColumns({c: F.col(c).cast("string") for c in ("id", "refers_to")})
    return as_text.mapInPandas(rows, "path string, records long, bytes long")


def in_chunks(records: DataFrame, size: int) -> DataFrame:
    """Rows (…, chunk_no, chunk) in place of ``payload``; an empty payload is one empty chunk."""
    last = F.greatest(F.ceil(F.col("payload_bytes") / size) - 1, F.lit(0)).cast("int")
    return records.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), last))).withColumn(
        "chunk", F.substring("payload", F.col("chunk_no") * size + 1, F.lit(size))).drop("payload")


def write_archives(pages: DataFrame, least: int = 0, folder: str | None = None, chunk: int = CHUNK, roll: int = ROLL,
                   date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write all pages to archives below ``folder``; returns the files (path, records, bytes)."""
    spark = pages.sparkSession
    folder = folder or work_folder(spark, "archives")
    every = described(pages)
    rows = stored(every.drop("payload").withColumn("row", F.monotonically_increasing_id()), "archive-rows")
    total = rows.count()
    groups = stored(
        rows.filter(F.col("payload_bytes") >= least).groupBy(*SAME)
        .agg(F.max(F.struct("id", "url", "row")).alias("holder"), F.count("*").alias("n")).filter("n > 1"), "archive-groups")
    again = F.col("payload_bytes") >= least
    may = sketches.asked(sketches.bloom_of(groups.select("mark"), groups.count()))
    one_each = every.filter(again & may("mark")).groupBy(*SAME).agg(F.max(F.struct("id", "url")).alias("holder"), F.first("payload").alias("payload"))
    responses = every.filter(~(again & may("mark"))).unionByName(one_each.select("holder.id", "holder.url", "payload", *SAME))
    revisits = revisits_of(rows.filter(again & may("mark")), groups, total)
    chunks = in_chunks(responses.drop("mark"), chunk).withColumns({"kind": F.lit("response"), "refers_to": F.lit(None).cast("long")})
    chunks = chunks.unionByName(revisits.withColumns({"kind": F.lit("revisit"), "chunk_no": F.lit(0), "chunk": F.lit(b"")}))
    with sketches.batches_of(spark, 64, "16m"):
        return stored(write_chunks(chunks, folder, date, roll), "archive-files")


def parsed(stream: io.BufferedIOBase, chunk: int) -> Iterator[tuple]:
    """(fields, chunk_no, bytes so far, SHA-1 so far, is last, chunk) of each piece of each record of an open archive."""
    def fields() -> dict[str, str]:
        found = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            key, _, value = line.partition(b":")
            found[key.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        return found

    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins here: {line[:40]!r}")
        about = fields()
        left = int(about["content-length"])
        if about.get("content-type", "").startswith("application/http"):
            before = left
            while left:  # the status line and the fields of the response
                line = stream.readline()
                left -= len(line)
                if not line.strip():
                    break
                key, _, value = line.partition(b":")
                about.setdefault("http " + key.strip().lower().decode("latin-1"), value.strip().decode("latin-1"))
            if left < 0 or before and not line:
                raise EOFError("an archive ends within a record")
        sha1, so_far, number = hashlib.sha1(), 0, 0
        while left or number == 0:
            piece = stream.read(min(left, chunk))
            if left and not piece:
                raise EOFError("an archive ends within a record")
            left -= len(piece)
            sha1.update(piece)
            so_far += len(piece)
            yield about, number, so_far, sha1.digest(), not left, piece
            number += 1


def read_archives(archives: DataFrame, chunk: int = CHUNK, payload: bool = True) -> DataFrame:
    """The chunked record table of archive files (path): a row per piece of at most ``chunk`` bytes, in order.

    (record_id, record_type, url, refers_to, chunk_no, bytes_so_far, sha1_so_far, last, declared_bytes, declared_digest, chunk);
    without ``payload`` the bytes stay in the task and chunk is null. Digests are upper-case base32.
    """
    names = ["record_id", "record_type", "url", "refers_to", "chunk_no", "bytes_so_far", "sha1_so_far", "last", "declared_bytes", "declared_digest", "chunk"]
    schema = ("record_id string, record_type string, url string, refers_to string, chunk_no int, bytes_so_far long, sha1_so_far string, "
              "last boolean, declared_bytes string, declared_digest string, chunk binary")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                files, name = file_systems.FileSystem.from_uri(path)
                out, held = [], 0
                with files.open_input_stream(name, compression=None) as raw:
                    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else raw, 1 << 16)
                    for about, number, so_far, sha1, last, piece in parsed(stream, chunk):
                        kind, digest = about.get("warc-type"), about.get("warc-payload-digest", "").removeprefix("sha1:") or None
                        if last and kind != "revisit" and digest and digest != base32(sha1):
                            raise ValueError(f"{path}: the payload of {about.get('warc-record-id')} differs from its digest")
                        out.append((about.get("warc-record-id"), kind, about.get("warc-target-uri"), about.get("warc-refers-to"), number,
                                    so_far, base32(sha1), last, about.get("http content-length"), digest, piece if payload else None))
                        held += len(piece) if payload else 0
                        if len(out) >= 1_000 or held > 1 << 24:
                            yield pd.DataFrame(out, columns=names)
                            out, held = [], 0
                yield pd.DataFrame(out, columns=names)

    files = min(max(archives.count(), 1), 10_000)
    return archives.select("path").repartition(files).mapInPandas(rows, schema)


def page_of(record_id: Column) -> Column:
    """The page_id that a record's id names; null for none."""
    text = F.regexp_extract(record_id, f"^<{RECORD}(-?[0-9]+)>$", 1)
    return F.when(text != "", text.cast("long"))


def page_records(archives: DataFrame) -> DataFrame:
    """A row per record of archives of pages: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    A response's size and digest are those of the payload read; a revisit's are the ones it states of the payload it names.
    """
    ends = read_archives(archives, payload=False).filter("last")
    again = F.col("record_type") == "revisit"
    return ends.select(
        page_of(F.col("record_id")).alias("page_id"), F.when(again, F.col("declared_bytes").cast("long")).otherwise(F.col("bytes_so_far")).alias("payload_bytes"),
        F.when(again, F.col("declared_digest")).otherwise(F.col("sha1_so_far")).alias("payload_digest"), "record_type",
        page_of(F.col("refers_to")).alias("refers_to"))
