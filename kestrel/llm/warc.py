"""Deterministic sharded WARC writer and reader.

Pages are range-sorted by id; each task writes its range as gzip-per-record archive
files, starting a new file when the compressed size would pass ``roll_bytes``. Headers and
digests are made anew from the payload alone (fixed date, record ids derived from id and
digest), so a task that runs twice writes the same bytes. A file is written under a
temporary name and renamed; only names in the manifest, which is written last, count.

Equal payloads of at least ``revisit_from`` bytes are stored once: the row with the
largest page_id is the response, the others are revisit records that name it.

Defined results: null html is an empty payload; rows without page_id sort first and
are a response only if no row of their payload has one; of rows equal in page_id and payload
the first is the response; an empty table gives no archive and an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import map_arrow
from kestrel.session import materialize, shared_path

DATE = "2020-01-01T00:00:00Z"
ROLL_BYTES, REVISIT_FROM, LEVEL = 64 << 20, 1000, 4
_SPACE = uuid.UUID("6f0f4f6c-8a3c-5d0e-9a55-0d8a3f7a1c11")
MANIFEST = "file string, records bigint, bytes bigint, sha1 string"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store of a URI (file:, hdfs:, s3:, gs:) and the path inside it."""
    return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def record_id(page_id, digest: str, nth: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}/{digest}/{nth}')}>"


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _block(headers: list[tuple[str, str]], body: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


def _line(text) -> str:
    """A header value: one line, no control characters."""
    return "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in str(text))


def build_record(page_id, url, payload: bytes, digest: str, refers_to: str | None, refers_page, nth: int) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to else http + payload
    headers = [("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", record_id(page_id, digest, nth)),
               ("WARC-Date", DATE), ("Content-Type", "application/http;msgtype=response"),
               ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{hashlib.sha1(body).hexdigest()}"),
               ("X-Page-Id", "" if page_id is None else str(page_id)), ("X-Payload-Length", str(len(payload)))]
    if url is not None:
        headers.insert(3, ("WARC-Target-URI", _line(url)))
    if refers_to:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                    ("WARC-Refers-To", refers_to), ("X-Refers-To-Page", "" if refers_page is None else str(refers_page))]
    return _block(headers, body)


class _Roller:
    """Writes members to files that are rolled by compressed size and renamed when complete."""

    def __init__(self, uri: str, shard: int, roll_bytes: int):
        self.fs, self.path = file_system(uri)
        self.shard, self.roll, self.n, self.out, self.done = shard, roll_bytes, 0, None, []

    def write(self, member: bytes) -> None:
        if self.out and self.size + len(member) > self.roll:
            self.close()
        if not self.out:
            self.name = f"shard-{self.shard:06d}-{self.n:05d}.warc.gz"
            self.temp = f"{self.path}/_temporary/{self.name}.{uuid.uuid4().hex}"
            self.out, self.size, self.records, self.sha = self.fs.open_output_stream(self.temp, compression=None), 0, 0, hashlib.sha1()
        self.out.write(member)
        self.sha.update(member)
        self.size, self.records = self.size + len(member), self.records + 1

    def close(self) -> None:
        if self.out:
            self.out.close()
            final = f"{self.path}/{self.name}"
            if self.fs.get_file_info(final).type == pafs.FileType.File:  # of an earlier attempt: the same bytes
                self.fs.delete_file(final)
            self.fs.move(self.temp, final)
            self.done.append({"file": self.name, "records": self.records, "bytes": self.size, "sha1": self.sha.hexdigest()})
            self.out, self.n = None, self.n + 1


def payload_facts(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", F.sha1(F.coalesce(F.encode("html", "utf-8"), F.lit(b""))).alias("digest"),
                        F.coalesce(F.octet_length("html"), F.lit(0)).cast("bigint").alias("n"))


def revisits(facts: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """(page_id, digest, target): the pages whose payload a page with a larger id holds.
    The group's response is found with partial aggregation; the join back is narrow, its
    right side holds repeated payloads only, and a hot payload's rows can be split."""
    big = facts.where(F.col("n") >= revisit_from)
    groups = (big.groupBy("digest").agg(F.max("page_id").alias("target"), F.count("*").alias("rows"))
              .where("rows > 1").drop("rows"))
    return (big.join(groups, "digest").where(~F.col("page_id").eqNullSafe(F.col("target")))
            .select("page_id", "digest", "target").distinct())


def write_archive(pages: DataFrame, uri: str, shards: int, roll_bytes: int = ROLL_BYTES,
                  revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Write the archive under ``uri`` and return its manifest (file, records, bytes, sha1)."""
    src = pages.select("page_id", "url", F.coalesce(F.encode("html", "utf-8"), F.lit(b"")).alias("payload"))
    refs = revisits(materialize(payload_facts(pages), "warc-facts"), revisit_from)
    nothing = F.lit(None)
    both = (src.select("page_id", F.lit(1).alias("kind"), "url", "payload", nothing.cast("string").alias("digest"),
                       nothing.cast(src.schema["page_id"].dataType).alias("target"))
            .unionByName(refs.select("page_id", F.lit(0).alias("kind"), nothing.cast("string").alias("url"),
                                     nothing.cast("binary").alias("payload"), "digest", "target")))
    ordered = both.repartitionByRange(shards, "page_id").sortWithinPartitions("page_id", "kind", "url", "payload")

    def write(batches):
        roller, now, refs_here, seen = _Roller(uri, TaskContext.get().partitionId(), roll_bytes), object(), {}, {}
        for batch in batches:
            for page_id, kind, url, payload, digest, target in zip(*(c.to_pylist() for c in batch.columns)):
                if page_id != now:
                    now, refs_here, seen = page_id, {}, {}
                if kind == 0:
                    refs_here[digest] = target
                    continue
                digest = hashlib.sha1(payload).hexdigest()
                nth = seen[digest] = seen.get(digest, -1) + 1
                refers, page = None, None
                if digest in refs_here:
                    page = refs_here[digest]
                    refers = record_id(page, digest)
                elif nth and len(payload) >= revisit_from:
                    refers, page = record_id(page_id, digest), page_id
                roller.write(_member(build_record(page_id, url, payload, digest, refers, page, nth)))
        roller.close()
        yield pa.RecordBatch.from_pylist(roller.done, schema=pa.schema([("file", pa.string()), ("records", pa.int64()),
                                                                       ("bytes", pa.int64()), ("sha1", pa.string())]))

    fs, path = file_system(uri)
    fs.create_dir(f"{path}/_temporary", recursive=True)
    manifest = map_arrow(ordered, write, MANIFEST)
    manifest.write.mode("overwrite").parquet(f"{uri}/_manifest")
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{uri}/_manifest")


def records(stream):
    """(headers, block) of each record of a gzip-per-record archive, reading as it goes."""
    raw, z, data = b"", zlib.decompressobj(31), bytearray()
    while True:
        if not raw:
            raw = stream.read(1 << 20)
            if not raw:
                return
        data += z.decompress(raw)
        raw = z.unused_data
        if z.eof:
            head, _, body = bytes(data).partition(b"\r\n\r\n")
            headers = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            yield headers, body[:int(headers["Content-Length"])]
            z, data = zlib.decompressobj(31), bytearray()


def read_archive(spark: SparkSession, uri: str, id_type: str = "bigint", with_payload: bool = False) -> DataFrame:
    """One row per record of the files in the manifest; digests are computed anew
    and a record or file that differs from what it states fails the read."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{uri}/_manifest")
    schema = (f"page_id {id_type}, payload_bytes bigint, payload_digest string, record_type string, refers_to {id_type}, "
              "url string, file string" + (", payload binary" if with_payload else ""))

    def number(x):
        return None if not x else x if id_type == "string" else int(x)

    def parse(batches):
        fs, path = file_system(uri)
        for batch in batches:
            for name, n, size, sha in zip(*(c.to_pylist() for c in batch.columns)):
                rows, held, found, count = [], 0, hashlib.sha1(), 0
                source = fs.open_input_stream(f"{path}/{name}", compression=None)
                for h, block in records(_Hashed(source, found)):
                    payload, count = block.partition(b"\r\n\r\n")[2], count + 1
                    digest, response = h["WARC-Payload-Digest"].removeprefix("sha1:"), h["WARC-Type"] == "response"
                    if response and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(h["X-Payload-Length"])):
                        raise ValueError(f"{name}: a payload differs from its digest")
                    rows.append({"page_id": number(h.get("X-Page-Id")), "payload_bytes": int(h["X-Payload-Length"]), "payload_digest": digest,
                                 "record_type": h["WARC-Type"], "refers_to": number(h.get("X-Refers-To-Page")),
                                 "url": h.get("WARC-Target-URI"), "file": name} | ({"payload": payload} if with_payload else {}))
                    held += len(payload) if with_payload else 200
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows, held = [], 0
                if found.hexdigest() != sha or count != n:
                    raise ValueError(f"{name} differs from the manifest")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    ident = pa.string() if id_type == "string" else pa.int64()
    arrow = pa.schema([("page_id", ident), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                       ("refers_to", ident), ("url", pa.string()), ("file", pa.string())] + ([("payload", pa.binary())] if with_payload else []))
    files = max(1, manifest.count())
    return map_arrow(manifest.repartition(min(files, 10_000)), parse, schema)


class _Hashed(io.RawIOBase):
    """A stream that adds what is read to a hash."""

    def __init__(self, stream, sha):
        self.stream, self.sha = stream, sha

    def read(self, n=-1):
        data = self.stream.read(n)
        self.sha.update(data)
        return data


def archive_path(spark: SparkSession) -> str:
    """A fresh folder for an archive under the shared folder."""
    return shared_path(spark, "archives", uuid.uuid4().hex)
