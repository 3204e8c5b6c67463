"""WARC archives of evidence snapshots: a deterministic sharded writer with a commit by manifest, and its reader."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.llm import shared

VERSION = b"WARC/1.1"
DATE = "2000-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAUSE = 1 << 16  # bytes read at a time
MANY_ROWS = 1_000_000  # longest list of digests that is broadcast
MANIFEST = "task string, name string, records long, bytes long, crc32 long"
RECORD = "payload_bytes long, payload_digest string, record_type string, refers_to string"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(path, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{path} {digest}')}>"


def one_line(value) -> str:
    """A header value: line breaks and edge blanks would end or change the field, so they are percent-encoded."""
    text = str(value)
    out = "".join(f"%{ord(c):02X}" if c in "\r\n%" else c for c in text)
    return out if out == out.strip() else "".join(f"%{ord(c):02X}" if c.isspace() and ord(c) < 128 else c for c in out)


def record(path, uri, payload: bytes, size: int, digest: str, refers_to, date: str = DATE) -> bytes:
    """One record with headers and digests made anew: a response with its payload, or a revisit without."""
    if refers_to is None:
        kind, block = "response", f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + payload
    else:
        kind, block = "revisit", f"HTTP/1.1 200 OK\r\nContent-Length: {size}\r\n\r\n".encode()
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id(path, digest)), ("WARC-Date", date),
              ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block)),
              ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Payload-Length", size)]
    if uri is not None:
        fields.append(("WARC-Target-URI", one_line(uri)))
    if path is not None:
        fields.append(("Record-Path", one_line(path)))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("Refers-To-Path", one_line(refers_to))]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def member(raw: bytes, level: int = 4) -> bytes:
    """A gzip member of its own, without a time stamp, as archives want for each record."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a compressed archive, one in memory at a time; checks the block digest."""
    rest, unpacker, raw = b"", None, []
    while True:
        data = rest or stream.read(PAUSE)
        rest = b""
        if not data:
            if unpacker is not None:
                raise ValueError("an archive ends inside a record")
            return
        unpacker = unpacker or zlib.decompressobj(31)
        raw.append(unpacker.decompress(data))
        if unpacker.eof:
            whole, rest, unpacker, raw = b"".join(raw), unpacker.unused_data, None, []
            head, _, body = whole.partition(b"\r\n\r\n")
            lines = head.split(b"\r\n")
            if lines[0] != VERSION:
                raise ValueError(f"not a record: {lines[0][:40]!r}")
            fields = dict(x.decode().split(": ", 1) for x in lines[1:])
            block = body[: int(fields["Content-Length"])]
            if fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
                raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
            yield fields, block


def _from_line(value: str | None) -> str | None:
    if value is None:
        return None
    parts = value.split("%")
    return parts[0] + "".join(chr(int(p[:2], 16)) + p[2:] for p in parts[1:])


def _place(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def planned_records(pages: DataFrame, path: str, doc: str, uri: str | None, revisit_from: int) -> DataFrame:
    """(path, uri, payload, size, digest, refers_to): revisits have no payload any more."""
    payload = F.encode(F.coalesce(F.col(doc).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(path).alias("path"), (F.col(uri) if uri else F.lit(None)).cast("string").alias("uri"), payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("size"), F.unhex(F.sha1("payload")).alias("digest"))
    groups = rows.where(F.col("path").isNotNull() & (F.col("size") >= revisit_from)).groupBy("digest")
    leaders = groups.agg(F.max("path").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "leader")
    leaders = shared.written(leaders, "leaders")
    rows = rows.join(F.broadcast(leaders) if leaders.count() <= MANY_ROWS else leaders, "digest", "left")
    refers = F.when((F.col("size") >= revisit_from) & (F.col("path") < F.col("leader")), F.col("leader"))
    rows = rows.withColumn("refers_to", refers).drop("leader")
    return rows.select("path", "uri", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "size", "digest", "refers_to")


def write_archives(pages: DataFrame, folder: str, path: str = "path", doc: str = "doc", uri: str | None = None,
                   revisit_from: int = 0, roll_bytes: int = 32 << 20, date: str = DATE) -> DataFrame:
    """Write evidence snapshots (``path``, ``doc``) as WARC files below ``folder`` and return the manifest.

    Of snapshots with equal payloads of at least ``revisit_from`` bytes, the one with the largest path is a response
    and the others revisit it; all others are responses. Records are sorted by path into ranges; a task rolls its
    file when ``roll_bytes`` compressed bytes are reached. Files get their names (range and number) only after
    the table of the task results, one result per task whatever was tried or lost, is complete; the manifest is
    written last, and :func:`read_archives` reads what it lists. The same rows give the same bytes.

    NULL payloads are empty. Rows with a NULL path are responses and never referred to; rows that repeat the largest
    path of a payload are all responses. An empty table gives an empty manifest. Other columns are ignored.
    """
    spark = pages.sparkSession
    rows = planned_records(pages, path, doc, uri, revisit_from)
    out = shared.arrow_schema(T._parse_datatype_string(MANIFEST))
    where, root = _place(folder)
    where.create_dir(f"{root}/_temporary", recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, base = _place(folder)
        part, made, sink, temporary, count, size, crc = TaskContext.get().partitionId(), [], None, "", 0, 0, 0

        def close():
            sink.close()
            made.append((temporary, f"part-{part:06d}-{len(made):05d}.warc.gz", count, size, crc))

        for batch in shared.chunks(batches, 200):
            for key, target, payload, n, digest, refers in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if sink is None:
                    temporary, count, size, crc = f"_temporary/{uuid.uuid4().hex}", 0, 0, 0
                    sink = store.open_output_stream(f"{base}/{temporary}", compression=None)
                raw = member(record(key, target, payload or b"", n, base64.b32encode(digest).decode(), refers, date))
                sink.write(raw)
                count, size, crc = count + 1, size + len(raw), zlib.crc32(raw, crc)
                if size >= roll_bytes:
                    close()
                    sink = None
        if sink is not None:
            close()
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), out.types)], schema=out)

    ranges = rows.repartitionByRange("path", F.xxhash64("uri")).sortWithinPartitions("path", "uri", "digest")
    results = shared.written(ranges.mapInArrow(write, MANIFEST), "archives")

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = _place(folder)
        for batch in batches:
            for temporary, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if store.get_file_info(f"{base}/{temporary}").type != fs.FileType.NotFound:
                    store.move(f"{base}/{temporary}", f"{base}/{name}")
                elif store.get_file_info(f"{base}/{name}").type == fs.FileType.NotFound:
                    raise FileNotFoundError(f"{folder}/{name}")
            yield batch

    manifest = results.mapInArrow(commit, MANIFEST).drop("task")
    manifest.write.parquet(f"{folder.rstrip('/')}/_manifest")
    where.delete_dir(f"{root}/_temporary")  # what lost tasks have left
    return spark.read.parquet(f"{folder.rstrip('/')}/_manifest")


def read_archives(spark: SparkSession, folder: str, path: str = "path", kind: T.DataType = T.StringType()) -> DataFrame:
    """One row per record of the files in the manifest of ``folder``: ``path`` and refers_to (of type ``kind``),
    payload_bytes, payload_digest, record_type. Files are streamed record by record; a file that differs from the
    manifest, a damaged block or a payload that does not have its digest is an error."""
    files = spark.read.parquet(f"{folder.rstrip('/')}/_manifest").select("name", "records", "crc32")
    schema = T.StructType([T.StructField("path", T.StringType()), *T._parse_datatype_string(RECORD).fields])

    class Counted:
        def __init__(self, raw):
            self.raw, self.crc = raw, 0

        def read(self, n):
            data = self.raw.read(n)
            self.crc = zlib.crc32(data, self.crc)
            return data

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _place(folder)
        out = shared.arrow_schema(schema)
        for batch in batches:
            for name, expected, crc in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rows, seen = [], 0
                with store.open_input_stream(f"{base}/{name}", compression=None) as raw:
                    stream = Counted(raw)
                    for fields, block in records_of(stream):
                        digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["Payload-Length"])
                        if fields["WARC-Type"] == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            if base32_sha1(payload) != digest or len(payload) != size:
                                raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
                        rows.append((_from_line(fields.get("Record-Path")), size, digest, fields["WARC-Type"], _from_line(fields.get("Refers-To-Path"))))
                        seen += 1
                        if len(rows) == 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), out.types)], schema=out)
                            rows = []
                if seen != expected or stream.crc != crc:
                    raise ValueError(f"{name} differs from the manifest")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), out.types)], schema=out)

    count = files.count()
    found = files.repartition(max(1, min(count, 10_000))).mapInArrow(read, schema)
    return found.select(F.col("path").cast(kind).alias(path), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
