"""Operator 13: WARC archives written from a table of pages, and read back as a table of chunks.

Writing. Payloads of MIN_BYTES or more that occur more than once are stored once: the row with the smallest id is a response, the
others are revisits (profile identical-payload-digest) that name it and hold no payload. What is shuffled for that are
digests and ids; digests that occur more than once come to the pages by broadcast if there are few, else by a join that splits
hot digests. Each task writes archives of about FILE_BYTES, one gzip member per record, payloads in slices. File names are
new for each attempt, and only files that the returned manifest lists count, so a lost or repeated task does no harm.

Reading. An archive is streamed: at no time is a record in memory as a whole. Each record gives rows of the chunk table: file,
number of the record in it, offset, headers, chunk number, up to CHUNK bytes of payload, and the bytes and SHA-256 of the payload
so far; the row with ``last`` has the sums of the whole payload. Archives of others are read as well, with or without gzip and with
other kinds of records; transfer encodings are not undone. An archive that ends within a record is an error.

Folders are named by URIs that pyarrow's file systems know (``file``, ``hdfs``, ``s3``, ``gs``, ``abfs``; ``s3a`` is read as ``s3``) or by paths.

Defined cases: null html is an empty payload; rows without id are revisits of a row with an id and the same payload, else
responses; repeated rows (same id, same payload) are records of their own and of one kind; a null url writes no target; control
characters of a url are left out. An empty table writes no archive. Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.common import Stored, bounded
from claimloom.operators.keyed import lookup

MIN_BYTES, CHUNK, FILE_BYTES, SLICE, LEVEL, MOST_HEADER, WHOLE = 100, 1 << 20, 256 << 20, 1 << 20, 4, 1 << 20, 64 << 20
BROADCAST_DIGESTS = 500_000
#: The version line and the profile that the format's standard names.
VERSION, PROFILE = b"WARC/1.1\r\n", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
MANIFEST = "file string, records long, bytes long"
CHUNKS = (
    "file string, record long, offset long, headers map<string,string>, chunk long, data binary, bytes long, sha256 string, last boolean"
)


def opened(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri("s3" + uri.removeprefix("s3a") if uri.startswith("s3a:") else uri)


def decided(pages: DataFrame) -> DataFrame:
    """``page_id, url, data, digest, refers_to``: ``refers_to`` is the smallest id with the same payload where that is another row's."""
    data = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), data.alias("data")).withColumn("digest", F.unhex(F.sha2("data", 256)))
    copies = rows.where(F.octet_length("data") >= MIN_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    found = Stored(copies.where("n > 1 and first is not null"), "payloads").df
    joined = lookup(rows, found.select("digest", "first"), "digest", ["page_id"], "left", BROADCAST_DIGESTS, found.select("digest", "n"))
    return joined.withColumn("refers_to", F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("first")), F.col("first"))).drop("first")


def record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page} {digest}'.encode()).digest()[:16], version=5)}>"


def head(fields: dict[str, object]) -> bytes:
    lines = (f"{name}: {value}\r\n" for name, value in fields.items() if value is not None)
    return VERSION + "".join(lines).encode() + b"\r\n"


def parts(page: int | None, url: str | None, data: pa.Buffer, digest: str, refers_to: int | None, date: str) -> Iterator[bytes | memoryview]:
    """A page's record in slices."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % data.size
    stored = refers_to is None
    yield head(
        {
            "WARC-Type": "response" if stored else "revisit",
            "WARC-Record-ID": record_id(page, digest),
            "WARC-Date": date,
            "WARC-Target-URI": None if url is None else "".join(c for c in url if c.isprintable()).strip(),
            "WARC-Payload-Digest": f"sha256:{digest}",
            "WARC-Profile": None if stored else PROFILE,
            "WARC-Refers-To": None if stored else record_id(refers_to, digest),
            "Page-Id": page,
            "Refers-To-Page-Id": refers_to,
            "Content-Type": "application/http; msgtype=response",
            "Content-Length": len(http) + data.size * stored,
        }
    )
    yield http
    if stored:
        view = memoryview(data)
        for at in range(0, data.size, SLICE):
            yield view[at : at + SLICE]
    yield END


class Archive:
    """One archive being written."""

    def __init__(self, folder: str, date: str):
        self.file = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        self.store, path = opened(folder)
        self.store.create_dir(path, recursive=True)
        self.path = f"{path}/{self.file.rsplit('/', 1)[1]}"
        self.out, self.records, self.bytes = self.store.open_output_stream(self.path, compression=None), 0, 0
        info = b"software: claimloom\r\nformat: WARC File Format 1.1\r\n"
        fields = {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": date, "Content-Type": "application/warc-fields"}
        self.add(iter([head(fields | {"Content-Length": len(info)}), info, END]))

    def add(self, slices: Iterator[bytes | memoryview]) -> None:
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        for data in slices:
            self._put(packer.compress(data))
        self._put(packer.flush())
        self.records += 1

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.file, self.records, self.bytes


def write(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES, date: str | None = None) -> DataFrame:
    """Writes a record per row of ``pages(page_id, url, html)`` to archives in ``folder``; returns the manifest ``file, records, bytes``, stored."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches):
        archive = None
        try:
            for batch in batches:
                done = []
                for k in range(batch.num_rows):
                    page, url, data, digest, refers_to = (batch[c][k] for c in ("page_id", "url", "data", "digest", "refers_to"))
                    archive = archive or Archive(folder, date)
                    archive.add(parts(page.as_py(), url.as_py(), data.as_buffer(), digest.as_py().hex(), refers_to.as_py(), date))
                    if archive.bytes >= file_bytes:
                        done.append(archive.close())
                        archive = None
                yield _manifest(done)
            yield _manifest([archive.close()] if archive else [])
        except BaseException:
            if archive:
                archive.out.close()
                archive.store.delete_file(archive.path)
            raise

    rows = decided(pages).select("page_id", "url", "data", "digest", "refers_to")
    return Stored(rows.transform(bounded).mapInArrow(run, MANIFEST), "manifest").df


def _manifest(done: list[tuple[str, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(("file", "records", "bytes"), x)) for x in done], pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))


class Source:
    """An archive as a stream of bytes that can be taken piece by piece; gzip members are unpacked one after another."""

    def __init__(self, uri: str):
        store, path = opened(uri)
        self.stream, self.uri = store.open_input_stream(path, compression=None), uri
        self.buffer, self.read, self.packed = b"", 0, None
        self.raw = self._more()
        self.zipped = self.raw[:2] == b"\x1f\x8b"

    def _more(self) -> bytes:
        data = self.stream.read(SLICE)
        self.read += len(data)
        return data

    def fill(self) -> bool:
        """Takes more bytes into the buffer, SLICE at most; false at the end."""
        if not self.zipped:
            self.buffer, self.raw = self.buffer + self.raw, b""
            if self.buffer:
                return True
            self.raw = self._more()
            return bool(self.raw) and self.fill()
        while True:
            if self.packed is None or self.packed.eof:
                rest = self.raw if self.packed is None else self.packed.unused_data
                rest = rest or self._more()
                if not rest.strip(b"\0"):
                    return False
                self.packed, self.raw = zlib.decompressobj(31), rest
            data = self.packed.decompress(self.raw, SLICE)
            self.raw = self.packed.unconsumed_tail
            if data:
                self.buffer += data
                return True
            if not self.packed.eof and not self.raw:
                self.raw = self._more()
                if not self.raw:
                    raise ValueError(f"{self.uri}: a gzip member is cut off")

    def offset(self) -> int:
        """Where the next byte lies in the file; inside a gzip member, where the part read of it ends."""
        waiting = len(self.packed.unused_data) if self.packed is not None and self.packed.eof else len(self.raw)
        return self.read - waiting - (0 if self.zipped else len(self.buffer))

    def extend(self) -> bool:
        """Like ``fill``, also if the buffer holds something."""
        before = self.buffer
        self.buffer = b""
        more = self.fill()
        self.buffer = before + self.buffer
        return more

    def until(self, mark: bytes, most: int) -> bytes | None:
        """Everything up to ``mark`` and the mark itself, or nothing if it does not come within ``most`` bytes."""
        while (at := self.buffer.find(mark)) < 0:
            if len(self.buffer) > most or not self.extend():
                return None
        out, self.buffer = self.buffer[: at + len(mark)], self.buffer[at + len(mark) :]
        return out

    def take(self, most: int) -> bytes:
        """Some bytes, ``most`` at most; nothing only at the end."""
        if not self.buffer and most:
            self.fill()
        out, self.buffer = self.buffer[:most], self.buffer[most:]
        return out


def records(source: Source) -> Iterator[tuple[int, dict[str, str], Iterator[bytes]]]:
    """Offset, headers and payload pieces of each record. The pieces have to be taken before the next record."""
    while True:
        while source.buffer[:1] in (b"\r", b"\n") or not source.buffer:  # line ends after a record
            if source.buffer:
                source.buffer = source.buffer.lstrip(b"\r\n")
                continue
            offset = source.offset()
            if not source.extend():
                return
        offset = offset if source.zipped else source.offset()
        header = source.until(END, MOST_HEADER)
        if header is None:
            raise ValueError(f"{source.uri}: no end of the header at {offset}")
        lines = header.decode("utf-8", "replace").split("\r\n")
        fields = dict((x.strip() for x in line.split(":", 1)) for line in lines[1:] if ":" in line)
        size = next((v for k, v in fields.items() if k.lower() == "content-length"), "")
        if not lines[0].startswith("WARC/") or not size.isdigit():
            raise ValueError(f"{source.uri}: no record at {offset}")
        yield offset, fields, _payload(source, fields, int(size))


def _payload(source: Source, fields: dict[str, str], left: int) -> Iterator[bytes]:
    http = next((v for k, v in fields.items() if k.lower() == "content-type"), "").startswith("application/http")
    start = b""
    while left:
        data = source.take(min(left, SLICE))
        if not data:
            raise ValueError(f"{source.uri}: a record is cut off")
        left -= len(data)
        if http:
            start += data
            at = start.find(END)
            if at < 0 and left and len(start) < MOST_HEADER:
                continue
            data, http, start = start[at + len(END) :] if at >= 0 else start, False, b""
        if data:
            yield data


def _sized(pieces: Iterator[bytes], size: int) -> Iterator[bytes]:
    """The same bytes in pieces of just ``size`` bytes, and a last one that may be shorter; at least one."""
    kept, n = [], 0
    for data in pieces:
        while n + len(data) > size:
            yield b"".join([*kept, data[: size - n]])
            data, kept, n = data[size - n :], [], 0
        kept.append(data)
        n += len(data)
    yield b"".join(kept)


def _with_last(items: Iterator[bytes]) -> Iterator[tuple[bytes, bool]]:
    before = next(items)
    for item in items:
        yield before, False
        before = item
    yield before, True


def chunks(files: DataFrame, chunk: int = CHUNK, data: bool = True) -> DataFrame:
    """The chunk table (``CHUNKS``) of the archives that ``files(file)`` names; without ``data`` the payload bytes are not handed on."""
    spark = files.sparkSession
    schema = pa.schema(
        [("file", pa.string()), ("record", pa.int64()), ("offset", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("chunk", pa.int64()),
         ("data", pa.binary()), ("bytes", pa.int64()), ("sha256", pa.string()), ("last", pa.bool_())]
    )

    def run(batches):
        rows, held = [], 0
        for batch in batches:
            for uri in batch["file"].to_pylist():
                for number, (offset, fields, pieces) in enumerate(records(Source(uri))):
                    digest, total = hashlib.sha256(), 0
                    for k, (part, last) in enumerate(_with_last(_sized(pieces, chunk))):
                        digest.update(part)
                        total += len(part)
                        rows.append((uri, number, offset, list(fields.items()), k, part if data else None, total, digest.copy().hexdigest(), last))
                        held += len(part) * data + 2000
                        if held > 4 * CHUNK:
                            yield _batch(rows, schema)
                            rows, held = [], 0
        yield _batch(rows, schema)

    # a task takes a few archives, whatever files the manifest lies in
    n = min(max(1, files.count()), max(200, 4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return files.select("file").repartition(n).transform(bounded).mapInArrow(run, CHUNKS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def whole(table: DataFrame, most: int = WHOLE) -> DataFrame:
    """``file, record, headers, payload`` of records of at most ``most`` bytes, put together from their chunks; longer ones stay chunks."""
    size = table.where(F.col("last") & (F.col("bytes") <= most)).select("file", "record")
    few = table.join(size, ["file", "record"], "left_semi").groupBy("file", "record")
    got = few.agg(F.first("headers").alias("headers"), F.array_sort(F.collect_list(F.struct("chunk", F.hex("data").alias("data")))).alias("c"))
    return got.select("file", "record", "headers", F.unhex(F.array_join(F.col("c.data"), "")).alias("payload"))


def pages(table: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of the pages in a chunk table: what each record's last
    chunk says, and for revisits what the response they refer to says."""
    header = lambda name: F.try_element_at("headers", F.lit(name))
    read = table.where("last").select(
        header("Page-Id").cast("long").alias("page_id"), header("WARC-Type").alias("record_type"), header("Refers-To-Page-Id").cast("long").alias("refers_to"),
        header("WARC-Payload-Digest").alias("said"), F.concat(F.lit("sha256:"), F.col("sha256")).alias("digest"), "bytes",
    )
    read = Stored(read.where("record_type in ('response', 'revisit')"), "records").df
    responses, revisits = read.where("record_type = 'response'"), read.where("record_type = 'revisit'")
    counts = Stored(revisits.groupBy("refers_to", "said").agg(F.count("*").alias("n")), "revisited").df
    # only responses that a revisit names, each once
    kept = responses.select(F.col("page_id").alias("refers_to"), F.col("digest").alias("said"), "bytes").dropDuplicates(["refers_to", "said"])
    named = Stored(kept.join(counts.select("refers_to", "said"), ["refers_to", "said"], "left_semi"), "named").df
    full = lookup(revisits.drop("bytes"), named, ["refers_to", "said"], ["page_id"], "inner", BROADCAST_DIGESTS, counts)
    bare = lambda c: F.substring_index(c, ":", -1).alias("payload_digest")
    out = ["page_id", F.col("bytes").alias("payload_bytes")]
    return responses.select(*out, bare("digest"), "record_type", F.lit(None).cast("long").alias("refers_to")).union(full.select(*out, bare("said"), "record_type", "refers_to"))
