"""WARC: a writer, and a reader that is a PySpark Python data source named ``warc``.

Archives are gzip files with one member per record. Each member's header has
the ``sl`` extra field (compressed and full length of the member), so a reader
can step over a member without inflating it.

The source plans one partition per run of files of about ``splitBytes``, takes
equality and IN filters on ``record_type`` and on header columns, inflates and
parses a record's header first, and inflates the payload only if the header
passes and the ``payload`` column is wanted (option ``payload``).
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from wordloom.llm import common as C

SPLIT_BYTES = 64 << 20
FILE_BYTES = 64 << 20  # a new archive begins after so many bytes
DEDUP_BYTES = 1000
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = "record_type string, record_id string, target_uri string, refers_to string, payload_digest string, payload_bytes bigint, content_length bigint, payload binary"
#: header field of each column that filters can be pushed to
_FIELDS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest"}


def _clean(value: str) -> str:
    """A header value: line ends would begin another field."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(kind: str, record_id: str, uri: str | None, digest: str, size: int, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC/1.1 record. A revisit has the HTTP header of the full payload and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", "Content-Type: application/http; msgtype=response"]
    head += [f"WARC-Target-URI: {_clean(uri)}"] if uri is not None else []
    head += [f"WARC-Payload-Digest: {digest}"]
    head += [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {_PROFILE}"] if kind == "revisit" else []
    head += [f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 1) -> bytes:
    """A gzip member with the skip-length extra field."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    total = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def mark_revisits(pages: DataFrame, id_col: str = "page_id", min_bytes: int = DEDUP_BYTES) -> DataFrame:
    """Add digest, size, and keeper: of rows with equal payloads of ``min_bytes`` or more, the largest id.

    Only digests that occur more than once are joined back; they are counted map-side first, so a payload
    that a third of the rows have is one row per task before the shuffle.
    """
    sized = pages.withColumn("size", F.octet_length("payload").cast("bigint")).withColumn("digest", F.sha1("payload"))
    again = sized.where(F.col("size") >= min_bytes).select("digest", F.col(id_col).alias("k")).groupBy("digest").agg(F.max("k").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return sized.join(again, "digest", "left")


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = DEDUP_BYTES) -> None:
    """Write a record for every row into ``path`` (a folder on shared storage).

    A null html is an empty payload, a null url gives no WARC-Target-URI, a null id has an empty one in the record id.
    A group whose ids are all null has no keeper and stays responses. Repeated rows that carry the largest id are all
    responses. Other columns are not read. A repeated task replaces its own files only.
    """
    C.ship(pages.sparkSession)
    folder = C.mounted(path)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    marked = mark_revisits(rows, "id", min_bytes)
    kind = F.when(F.col("keeper").isNull() | (F.col("id") == F.col("keeper")), "response").otherwise("revisit")
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    ready = marked.select(kind.alias("kind"), urn(F.col("id")).alias("rid"), "url", "digest", "size", F.when(kind == "response", F.col("payload")).otherwise(F.lit(b"")).alias("payload"), urn(F.col("keeper")).alias("ref"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, names = TaskContext.get().partitionId(), []
        out, size = [], 0

        def flush():
            name = f"part-{part:06d}-{len(names):05d}.warc.gz"
            C.write_file(f"{folder}/{name}", lambda f: f.writelines(out))
            names.append(name)

        for batch in batches:
            for r in batch.to_pylist():
                m = member(record(r["kind"], r["rid"], r["url"], r["digest"], r["size"], r["payload"], r["ref"]))
                out.append(m)
                size += len(m)
                if size >= FILE_BYTES:
                    flush()
                    out, size = [], 0
        if out:
            flush()
        yield pa.record_batch([pa.array(names, pa.string())], ["file"])

    # the files that tasks report are the archive; a file that a lost attempt left under another name is not listed
    names = ready.mapInArrow(write, "file string")
    names.write.mode("overwrite").text(f"{path}/_files")


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)``; options ``payload`` (true), ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> "WarcReader":
        return WarcReader(self.options)


class _Files(InputPartition):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths


class WarcReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.folder = C.mounted(options["path"])
        self.payload = options.get("payload", "true").lower() == "true"
        self.split = int(options.get("splitBytes", SPLIT_BYTES))
        self.want: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]):
        """Keep equality and IN on header columns; Spark applies the rest."""
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if values is not None and len(f.attribute) == 1 and f.attribute[0] in _FIELDS:
                field = _FIELDS[f.attribute[0]]
                self.want[field] = self.want.get(field, values) & values
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        names = sorted(x for d, _, fs in os.walk(f"{self.folder}/_files") for f in fs if f.startswith("part-") for x in open(f"{d}/{f}").read().split("\n") if x)
        out, run, size = [], [], 0
        for name in names:
            run.append(f"{self.folder}/{name}")
            size += os.path.getsize(run[-1])
            if size >= self.split:
                out.append(_Files(run))
                run, size = [], 0
        return out + ([_Files(run)] if run or not out else [])

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.binary() if t == "binary" else pa.int64() if t == "bigint" else pa.string()) for c, t in (x.split() for x in SCHEMA.split(", "))])
        rows, size = [], 0
        for path in partition.paths:
            with open(path, "rb") as f:
                for head, payload in records(f, self.want, self.payload):
                    rows.append([head.get(_FIELDS[c]) for c in _FIELDS] + [head["payload-bytes"], int(head["Content-Length"]), payload])
                    size += len(payload or b"") + 200
                    if size > 4 << 20:
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                        rows, size = [], 0
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _fields(text: bytes) -> dict:
    return dict(line.split(": ", 1) for line in text.decode("utf-8", "replace").split("\r\n")[1:] if ": " in line)


def records(f, want: dict[str, set], payload: bool) -> Iterator[tuple[dict, bytes | None]]:
    """(header fields, payload or None) of the records whose header passes ``want``."""
    while start := f.read(24):
        extra, at = (start[12:24], f.tell() - 24) if start[3] & 4 and start[12:14] == b"sl" else (None, f.tell() - len(start))
        length = struct.unpack("<I", extra[4:8])[0] if extra else 0
        if extra is None or not length:
            raise ValueError("a member without skip lengths")
        z = zlib.decompressobj(-15)
        text, rest = b"", b""
        left = length - 24 - 8
        need = 2  # header blocks: the record's and the HTTP message's
        # what was read may be inflated in part only: in the unconsumed tail, or inside the object with no tail at all
        while text.count(b"\r\n\r\n") < need and not z.eof:
            chunk = z.unconsumed_tail or f.read(min(4096, left))
            left -= 0 if z.unconsumed_tail else len(chunk)
            more = z.decompress(chunk, 2048)
            if not chunk and not more:
                raise ValueError("a member that is cut short")
            text += more
        head_text, _, rest = text.partition(b"\r\n\r\n")
        head = _fields(head_text)
        if all(head.get(k) in v for k, v in want.items()):
            http, _, body = rest.partition(b"\r\n\r\n")
            head["payload-bytes"] = int(_fields(http).get("Content-Length", 0))
            data = None
            if payload and head["WARC-Type"] == "response":
                parts = [body]
                while not z.eof:
                    chunk = z.unconsumed_tail or f.read(left)
                    left = left if z.unconsumed_tail else 0
                    parts.append(z.decompress(chunk))
                    if not chunk and not parts[-1]:
                        raise ValueError("a member that is cut short")
                data = b"".join(parts)[: head["payload-bytes"]]
            yield head, data
        f.seek(at + length)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of the archives in ``path``; filters on record type and header columns reach the reader."""
    C.ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)
