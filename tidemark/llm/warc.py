"""WARC archives of web pages: a distributed writer and a sequential reader.

The writer puts every record into a gzip member of its own and starts a new file every
``FILE_BYTES``. Files lie in the shared folder; their names hold the task attempt, and only the
files listed by attempts that succeeded are read, so a lost executor leaves nothing that counts.
The reader goes through a file once: it inflates member by member, piece by piece, finds the end of
a record's header, takes as many bytes as its Content-Length says, and checks the digests of block
and payload. It holds one record at a time. Archives of other writers are read, too: records of other
kinds are passed over, ids of any form are kept as ``record_id``, digests may be missing. A payload
is what follows the HTTP header; transfer and content encodings are not undone. A damaged archive is
an error.

Of records with equal payloads the one with the smallest page_id is written as a response, the
others as revisits that refer to it and carry only its HTTP header; payloads under ``least_bytes``
are always responses. Equal means equal SHA-1 and length.

Defined results: a null html is an empty payload; a null url leaves out the target; a null page_id
sorts after all others and never is referred to unless it is the only one; rows that repeat the
smallest page_id of a payload are all responses. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import cut, new_folder

FILE_BYTES = 64 << 20
READ_BYTES, HEADER_BYTES = 1 << 18, 1 << 20
#: Records that carry a page.
KINDS = ("response", "revisit")
DATE = "1970-01-01T00:00:00Z"
_END = b"\r\n\r\n"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record, not yet compressed."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>",
        ]
    head += [
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + _END + block + _END


def member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme of the file system that Spark takes for it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return "file://" + whole.removeprefix("file:") if whole.startswith("file:/") and whole[6:7] != "/" else whole


def roles(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, sha, size of the pages that revisit, with the page they refer to. Counts per
    payload are combined before the shuffle; only ids and digests move."""
    found = pages.select("page_id", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("size"))
    first = (
        found.where(F.col("size") >= least_bytes).groupBy("sha", "size")
        .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    )
    return (
        found.join(first, ["sha", "size"]).where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select("page_id", "sha", "refers_to").distinct()
    )


def write(pages: DataFrame, folder: str, least_bytes: int = 0, level: int = 6) -> DataFrame:
    """Write pages (page_id, url, html) as archives below ``folder``; returns path, records, bytes
    of every file. Evaluate the result once, as ``cut`` does."""
    folder = qualified(pages.sparkSession, folder)
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    )
    told = roles(rows, least_bytes).toDF("r_id", "r_sha", "refers_to")
    # a text is compared with its digest too: ids may repeat
    both = rows.join(
        told, F.col("page_id").eqNullSafe(F.col("r_id")) & (F.sha1("payload") == F.col("r_sha")), "left"
    ).select("page_id", "url", "payload", "refers_to", F.col("r_sha").isNotNull().alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        system, base = _filesystem(folder)
        system.create_dir(base, recursive=True)
        name, out, size, count, number = "", None, 0, 0, 0

        def listed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"path": [f"{folder}/{name}"], "records": [count], "bytes": [size]},
                schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]),
            )

        for batch in batches:
            ids, urls, refers, revisit = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
            for n, payload in enumerate(batch.column(2)):
                if out is None:
                    name = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}-{number:04d}.warc.gz"
                    # the members are packed here: without this the name's ending would pack them once more
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                    size, count, number = 0, 0, number + 1
                packed = member(record(ids[n], urls[n], payload.as_py(), refers[n], revisit[n]), level)
                out.write(packed)
                size, count = size + len(packed), count + 1
                if size >= FILE_BYTES:
                    out.close()
                    out = None
                    yield listed()
        if out is not None:
            out.close()
            yield listed()

    return both.mapInArrow(run, "path string, records bigint, bytes bigint")


class Damaged(ValueError):
    pass


class Inflated:
    """The content of a gzip file of many members, inflated as it is asked for."""

    def __init__(self, stream):
        self.stream = stream
        self.packed = b""
        self.held = bytearray()
        self.unpacker = None
        self.members = 0

    def more(self) -> bool:
        """Inflate the next piece; False at the end of the file."""
        self.packed = self.packed or self.stream.read(READ_BYTES)
        if self.unpacker is None:
            if not self.packed:
                return False
            self.unpacker = zlib.decompressobj(31)
            self.members += 1
        try:
            # with nothing left to read, what the inflater still holds
            part = self.unpacker.decompress(self.packed, READ_BYTES)
        except zlib.error as error:
            raise Damaged(str(error)) from error
        if not part and not self.packed and not self.unpacker.eof:
            raise Damaged("the archive ends inside a member")
        self.held += part
        if self.unpacker.eof:
            self.packed, self.unpacker = self.unpacker.unused_data, None
        else:
            self.packed = self.unpacker.unconsumed_tail
        return True

    def take(self, size: int) -> bytes:
        while len(self.held) < size:
            if not self.more():
                raise Damaged("the archive ends inside a record")
        found = bytes(self.held[:size])
        del self.held[:size]
        return found

    def skip(self, size: int) -> None:
        while size:
            part = min(size, READ_BYTES)
            self.take(part)
            size -= part

    def header(self) -> bytes | None:
        """Up to and with the next empty line; None at the end of the archive."""
        looked = 0
        while (end := self.held.find(_END, max(looked - 3, 0))) < 0:
            looked = len(self.held)
            if looked > HEADER_BYTES:
                raise Damaged("no end of a record header")
            if not self.more():
                if self.held.strip():
                    raise Damaged("the archive ends inside a header")
                return None
        return self.take(end + len(_END))


def records(stream, kinds: tuple[str, ...] = KINDS) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of the records of these kinds, one after the other.

    A record is framed by its Content-Length while the file is inflated, so the current record is all
    that is held; blocks of other kinds (warcinfo, request, metadata, ...) are passed over piece by piece.
    """
    source = Inflated(stream)
    while (raw := source.header()) is not None:
        lines = raw[: -len(_END)].lstrip(b"\r\n").decode(errors="replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise Damaged("no record header")
        head = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        if not head.get("content-length", "").isdigit():
            raise Damaged("a record without a length")
        size = int(head["content-length"])
        if head.get("warc-type", "").lower() in kinds:
            block = source.take(size)
            checked(head.get("warc-block-digest"), block, "block")
            yield head, block
        else:
            source.skip(size)
        if source.take(len(_END)) != _END:
            raise Damaged("the length of a record is not as stated")


def checked(stated: str | None, data: bytes, what: str) -> None:
    """Compare with a SHA-1 digest, in base32 or hexadecimal; other digests and none are not checked."""
    name, _, value = (stated or "").partition(":")
    if name.lower() != "sha1":
        return
    if value.upper() != digest(data) and value.lower() != hashlib.sha1(data).hexdigest():
        raise Damaged(f"the {what} differs from its digest")


def content(head: dict[str, str], block: bytes) -> tuple[bytes | None, int | None]:
    """The payload (None for a revisit) and the length of the full payload (None for a revisit that
    does not state it)."""
    start = block.find(_END)
    http = block[: max(start, 0)].decode(errors="replace").lower().split("\r\n")
    stated = [x.partition(":")[2].strip() for x in http if x.startswith("content-length:")]
    size = int(stated[0]) if stated and stated[0].isdigit() else None
    if head["warc-type"].lower() == "revisit":
        return None, size
    payload = block[start + len(_END) :] if start >= 0 else block
    checked(head.get("warc-payload-digest"), payload, "payload")
    return payload, len(payload)


def _page(value: str | None) -> int | None:
    """The page of one of our own record ids; None for ids of other writers."""
    number = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def _payload_digest(head: dict[str, str], payload: bytes | None) -> str | None:
    if payload is not None:
        return digest(payload)
    name, _, value = head.get("warc-payload-digest", "").partition(":")
    return value if name.lower() == "sha1" else None


def read(files: DataFrame) -> DataFrame:
    """Every response and revisit of the listed archives (column ``path``): page_id (null where the id is not
    one of ours), record_id, url, record_type, refers_to, payload (null for a revisit), payload_bytes
    and payload_digest of the full payload (null where a foreign revisit does not state them)."""
    spark = files.sparkSession
    spread = files.select("path").repartition(spark.sparkContext.defaultParallelism * 4, "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
            ("refers_to", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()), ("record_id", pa.string()),
        ])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, name = _filesystem(path)
                rows, held = [], 0
                with system.open_input_stream(name, compression=None) as stream:
                    for head, block in records(stream):
                        payload, size = content(head, block)
                        rows.append((
                            _page(head.get("warc-record-id")), head.get("warc-target-uri"), head["warc-type"].lower(),
                            _page(head.get("warc-refers-to")), payload, size, _payload_digest(head, payload),
                            head.get("warc-record-id"),
                        ))
                        held += len(block)
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return spread.mapInArrow(
        run,
        "page_id bigint, url string, record_type string, refers_to bigint, payload binary,"
        "payload_bytes bigint, payload_digest string, record_id string",
    )


def op6(pages: DataFrame) -> DataFrame:
    files = cut(write(pages, new_folder(pages.sparkSession, "warc")), "warc-files")
    return read(files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, upper(sha1(html)) AS h FROM p),
f AS (SELECT h, payload_bytes, min(page_id) AS first FROM d GROUP BY ALL)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((('0x' || substr(h, (1 + 10 * (i // 8))::INT, 10))::UBIGINT >> (35 - 5 * (i % 8))::UBIGINT)
    & 31))::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM d JOIN f USING (h, payload_bytes)
"""
