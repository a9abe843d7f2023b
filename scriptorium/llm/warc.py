"""WARC archives with a two-level capture index.

Writing: one pass over the captures appends compressed WARC records to archives in the shared folder, each task to its
own; of equal large payloads one is a response and the others revisit it. The captures are then sorted by their
reversed-host URL key over all tasks; each task writes a run of the index as compressed blocks of lines, with a
directory of the first key of each block behind them. The first keys of the runs are the top level.

Reading: requests, sorted by key, are looked up by binary search in the top level, in the directory of one run and in
the lines of one block; then each archive's ranges are read in order, each once, and the records parsed. A key of the
index is the URL key, the page's id, and the digest and place of the payload, so that captures which repeat an id and a
URL stay apart: a request that names a digest gets that capture, one that does not gets all of its id and URL.

Archives and runs get new names in each attempt, and only those of finished tasks are referred to, so tasks that are
run again after a loss leave nothing behind that is read. Folders are opened through pyarrow's file systems.

Defined results: a null page is an empty payload, a null URL has the empty key; rows that repeat page_id and url have
each their own record, and those that repeat the payload too, equal ones; rows with a null page_id are kept; a request
without a capture is an error of ``op4_warc``; an empty table gives no rows; extra columns do not matter.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import drop_staged, new_path, read, small_batches, staged

#: Payloads of so many bytes may be revisited.
REVISIT_LEAST = 1000
#: An archive is closed after so many bytes; lines of an index block; bytes that a task reads back, about.
ARCHIVE_BYTES, BLOCK_LINES, READ_BYTES = 64 << 20, 1000, 16 << 20
#: Lines of a run of the index at least; beyond, runs and their lines both grow with the root of the captures.
RUN_LINES = 4096
#: Digests of repeated payloads are broadcast up to so many rows; beyond, they are joined by shuffling.
BROADCAST_ROWS = 100_000
NO_ID = -(1 << 63)

CAPTURE = "key string, page_id bigint, digest string, file string, offset bigint, length bigint"
RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def url_key(url: str | None) -> str:
    """The reversed-host key of a URL: host labels from the last, then port, path and query; without the fragment."""
    if not url:
        return ""
    url = url.replace("\t", "%09").replace("\n", "%0A")  # a key is a field of a line
    m = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::(\d*))?([^#]*)", url)
    if not m:
        return url.split("#")[0]
    host, port, rest = m[1].lower(), m[2], m[3] or "/"
    return ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in ("80", "443") else "") + ")" + rest


def runs_for(captures: int) -> int:
    """How many runs an index of so many captures has."""
    return int(captures // max(RUN_LINES, 64 * captures**0.5)) + 1


def _line_safe(text: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 else c for c in text)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = "2000-01-01T00:00:00Z") -> bytes:
    """One WARC record: a response, or a revisit of the response ``refers_to``, whose payload is left out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if url:
        head.insert(3, f"WARC-Target-URI: {_line_safe(url)}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """What a record says: its headers, and its payload (None for a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    kind = fields["WARC-Type"]
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if kind == "response":
        own = hashlib.sha1(payload).hexdigest()
        if own != digest or len(payload) != size:
            raise ValueError(f"record {fields['WARC-Record-ID']}: its payload is not what its headers say")
    number = lambda x: int(x[len("<urn:x-page:") : -1]) if len(x) > len("<urn:x-page:>") else None
    return {
        "page_id": number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": digest,
        "record_type": kind, "refers_to": number(fields["WARC-Refers-To"]) if kind == "revisit" else None, "payload": payload if kind == "response" else None,
    }


class Folder:
    """A folder of the shared file system."""

    def __init__(self, uri: str):
        self.fs, self.path = fs.FileSystem.from_uri(uri)

    def create(self, name: str):
        self.fs.create_dir(self.path, recursive=True)
        return self.fs.open_output_stream(f"{self.path}/{name}", compression=None)

    def open(self, name: str):
        return self.fs.open_input_file(f"{self.path}/{name}")


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record for each row of pages (page_id, url, html) and returns the captures, as ``CAPTURE``."""
    spark = pages.sparkSession
    small_batches(spark)
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.select("*", F.sha1("payload").alias("digest"))
    repeated = staged(
        rows.where(F.octet_length("payload") >= REVISIT_LEAST)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first"),
        "repeated",
    )
    small = repeated.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rows = rows.join(F.broadcast(repeated) if small else repeated, "digest", "left")
    refers = F.when(F.coalesce(F.col("page_id"), F.lit(NO_ID)) != F.col("first"), F.col("first"))
    rows = rows.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, to, name, at = Folder(folder), None, "", 0
        for batch in batches:
            made = []
            for r in batch.to_pylist():
                if to is None:
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    to = out.create(name)
                pack = zlib.compressobj(3, zlib.DEFLATED, 31)
                data = pack.compress(record(r["page_id"], r["url"], r["payload"], r["digest"], r["refers_to"])) + pack.flush()
                to.write(data)
                made.append((url_key(r["url"]), r["page_id"], r["digest"], name, at, len(data)))
                at += len(data)
                if at >= ARCHIVE_BYTES:
                    to.close()
                    to = None
            yield _batch(made, CAPTURE)
        if to is not None:
            to.close()

    return staged(rows.mapInArrow(write, CAPTURE), "captures")


_TYPES = {"string": pa.string(), "bigint": pa.int64()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


RUN = "key string, page_id bigint, digest string, run string, at bigint, size bigint"


def _by_key(df: DataFrame, runs: int, *last) -> DataFrame:
    """The rows dealt by ranges of key, id and digest, and in that order; ``last`` splits the rows of a key that many
    have. Keys are compared as bytes here, as in the index."""
    df = df.withColumn("_id", F.coalesce("page_id", F.lit(NO_ID))).withColumn("_key", F.encode("key", "UTF-8"))
    order = ["_key", "_id", "digest", *last]
    return df.repartitionByRange(runs, *order).sortWithinPartitions(*order).drop("_id", "_key")


def write_index(captures: DataFrame, folder: str, runs: int | None = None) -> list[tuple]:
    """Writes the index of the captures and returns its top level: for each run its first key, id and digest, its name,
    and where its directory is. Its runs, and so what the driver holds, grow with the root of the captures."""
    runs = runs or runs_for(captures.count())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: list[tuple] = []
        directory: list[str] = []
        to, name, at, first = None, "", 0, None

        def block() -> None:
            nonlocal to, name, at, first, lines
            if to is None:
                name = f"{uuid.uuid4().hex}.idx"
                to = Folder(folder).create(name)
                first = lines[0][:3]
            data = zlib.compress("\n".join("\t".join(map(str, x)) for x in lines).encode())
            to.write(data)
            directory.append("\t".join(map(str, (*lines[0][:3], at, len(data)))))
            at += len(data)
            lines = []

        for batch in batches:
            for r in batch.to_pylist():
                lines.append((r["key"], NO_ID if r["page_id"] is None else r["page_id"], r["digest"], r["file"], r["offset"], r["length"]))
                if len(lines) >= BLOCK_LINES:
                    block()
        if lines:
            block()
        if to is not None:
            data = zlib.compress("\n".join(directory).encode())
            to.write(data)
            to.close()
            yield _batch([(*first, name, at, len(data))], RUN)

    held = staged(_by_key(captures, runs, "file", "offset").mapInArrow(write, RUN), "runs")
    top = [tuple(r) for r in held.collect()]  # a row for each run
    drop_staged(held)
    return sorted(top, key=lambda t: (t[0].encode(), *t[1:]))


class CaptureIndex:
    """Looks up captures by binary search; keeps the directory and the block that it read last."""

    def __init__(self, folder: str, top: list[tuple]):
        self.folder, self.top, self.firsts = Folder(folder), top, [(t[0].encode(), *t[1:3]) for t in top]
        self.run, self.file, self.directory, self.block_at, self.lines = None, None, [], None, []

    def find(self, key: str, page_id: int | None, digest: str | None = None) -> list[tuple[str, int, int]]:
        """(file, offset, length) of the captures of a URL key and id: the first one of the digest, all without one."""
        want, found = (key.encode(), NO_ID if page_id is None else page_id, digest or ""), []
        # The lines of a key may begin in the block, or the run, before the one whose first line is not less.
        k = max(bisect_left(self.firsts, want) - 1, 0)
        while k < len(self.top):
            self._open(k)
            b = max(bisect_left(self.blocks, want) - 1, 0)
            while b < len(self.directory):
                self._load(b)
                for n in range(bisect_left(self.keys, want), len(self.keys)):
                    if self.keys[n][:2] != want[:2] or (digest and self.keys[n][2] != digest):
                        return found
                    found.append(self.places[n])
                    if digest:
                        return found
                b += 1
            k += 1
        return found

    def _open(self, k: int) -> None:
        if self.run != k:
            if self.file is not None:
                self.file.close()
            self.run, self.file, self.block_at = k, self.folder.open(self.top[k][3]), None
            rows = [x.split("\t") for x in self._read(*self.top[k][4:])]
            self.blocks, self.directory = [(x[0].encode(), int(x[1]), x[2]) for x in rows], [(int(x[3]), int(x[4])) for x in rows]

    def _load(self, b: int) -> None:
        if self.block_at != b:
            self.block_at = b
            rows = [x.split("\t") for x in self._read(*self.directory[b])]
            self.keys, self.places = [(x[0].encode(), int(x[1]), x[2]) for x in rows], [(x[3], int(x[4]), int(x[5])) for x in rows]

    def _read(self, at: int, size: int) -> list[str]:
        self.file.seek(at)
        return zlib.decompress(self.file.read(size)).decode().split("\n")


FOUND = "page_id bigint, file string, offset bigint, length bigint"


def look_up(requests: DataFrame, folder: str, top: list[tuple], runs: int | None = None) -> DataFrame:
    """Where the captures of the requests (page_id, url, digest) are, as ``FOUND``; digest may be null. A request
    without a capture has one row, with a null file."""
    small_batches(requests.sparkSession)

    @F.arrow_udf("string")
    def keys(urls: pa.Array) -> pa.Array:
        return pa.array([url_key(u.as_py()) for u in urls], pa.string())

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CaptureIndex(folder, top)
        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in ("key", "page_id", "digest")), strict=True)
            yield _batch([(i, *at) for k, i, d in rows for at in index.find(k, i, d) or [(None, None, None)]], FOUND)

    wanted = requests.select(F.col("page_id").cast("bigint").alias("page_id"), keys("url").alias("key"), "digest")
    return _by_key(wanted.withColumn("_row", F.monotonically_increasing_id()), runs or max(len(top), 1), "_row").mapInArrow(find, FOUND)


def read_records(found: DataFrame, folder: str, tasks: int) -> DataFrame:
    """The records at the ranges, as ``RECORD``, one for each row of ``found``. Archives are dealt to ``tasks`` tasks;
    a range that many rows ask for is read once."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home, name, file = Folder(folder), None, None
        for batch in batches:
            made = []
            for r in batch.to_pylist():
                if r["file"] != name:
                    if file is not None:
                        file.close()
                    name, file = r["file"], home.open(r["file"])
                file.seek(r["offset"])
                x = parse(zlib.decompress(file.read(r["length"]), 31))
                made.append((r["file"], r["offset"], x["page_id"], x["payload_bytes"], x["payload_digest"], x["record_type"], x["refers_to"]))
            yield _batch(made, f"file string, offset bigint, {RECORD}")
        if file is not None:
            file.close()

    once = found.select("file", "offset", "length").distinct().repartition(tasks, "file", F.expr(f"offset div {READ_BYTES}")).sortWithinPartitions("file", "offset")
    records = once.mapInArrow(fetch, f"file string, offset bigint, {RECORD}")
    return found.select("file", "offset").join(records, ["file", "offset"]).drop("file", "offset")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes a record for every page, indexes the archives, and reads each record back through the index."""
    folder = new_path(spark, "warc")
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    captures = write_archives(pages, folder)
    top = write_index(captures, folder)
    size = captures.agg(F.sum("length")).first()[0] or 0
    drop_staged(captures)
    found = staged(look_up(pages.select("page_id", "url", F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8")).alias("digest")), folder, top), "found")
    if lost := found.where("file IS NULL").count():
        raise ValueError(f"{lost} pages have no capture")
    return read_records(found, folder, int(size // READ_BYTES) + 1)


OP4_SQL = f"""
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= {REVISIT_LEAST} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {REVISIT_LEAST} AND page_id <> first THEN first END AS refers_to
FROM (SELECT page_id, n, digest, max(page_id) OVER (PARTITION BY digest) AS first
      FROM (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages))
"""
