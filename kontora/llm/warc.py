"""WARC archives of web pages: a deterministic sharded writer, and a reader of what it committed.

Records are sorted by page id and payload digest over all archives. Shard bounds come from the rows with the least keyed hashes,
weighted by size, so they depend on the pages alone; each task writes one shard and starts a new file when the compressed size
would pass a limit. Headers and digests are made anew from the payload. Files are written under temporary names of their
task attempt; the commit gives them their names and then writes the manifest in the same way. Readers open only files that a
manifest names, so lost executors and repeated tasks leave nothing that is read.

Equal payloads are stored once. A thin table of digests says which page holds the payload; its rows meet the pages in the one
shuffle that sorts them.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from kontora.llm.common import NO_ID, partitions, stored
from kontora.session import scratch_path

#: Equal payloads of fewer bytes are all stored.
REVISITED = 1000
#: Compressed bytes after which a file ends.
FILE_BYTES = 256 << 20
#: Pages have no capture date; this one stands in every header, so that archives repeat byte for byte.
DATE = "2024-01-01T00:00:00Z"
#: Sampled rows per shard bound.
SAMPLED = 20
MANIFEST = "MANIFEST.json"
# Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ROW = "page_id long, url string, record_type string, record_id string, payload_bytes long, payload_digest string, refers_to long"


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _record_id(*parts: object) -> str:
    return uuid.UUID(bytes=hashlib.sha1("\x1f".join(map(str, parts)).encode()).digest()[:16], version=5).urn


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _line(value: str) -> str:
    """A header value: control characters and blanks, which could end it, are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in value)


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record as one gzip member. Fields without a value are left out."""
    fields = [*fields, ("WARC-Block-Digest", _sha1(block)), ("Content-Length", len(block))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None).encode()
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(VERSION + head + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers: dict | None) -> bytes:
    """A response with its payload or, if the payload is another page's, a revisit with the headers of the response alone."""
    digest = hashlib.sha1(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [
        ("WARC-Type", "revisit" if refers else "response"), ("WARC-Record-ID", f"<{_record_id(page_id, url, digest)}>"), ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else _line(url)), ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", _sha1(payload)), ("X-Page-ID", page_id),
    ]
    if refers:
        fields += [
            ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{_record_id(refers['id'], refers['url'], digest)}>"),
            ("WARC-Refers-To-Target-URI", None if refers["url"] is None else _line(refers["url"])), ("WARC-Refers-To-Date", DATE),
            ("X-Refers-To-Page-ID", refers["id"]),
        ]
    return record(fields, http if refers else http + payload)


class Written(NamedTuple):
    temporary: str
    name: str
    records: int
    bytes: int
    sha256: str


@dataclass
class Files(WriterCommitMessage):
    files: list[Written]


class Writer(DataSourceArrowWriter):
    """Rows in shard order, a marker row (no payload) before the pages whose payload another page holds."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.limit, self.overwrite = options["path"], int(options.get("filebytes", FILE_BYTES)), overwrite
        store, root = _place(self.path)
        if not overwrite and store.get_file_info(f"{root}/{MANIFEST}").type != fs.FileType.NotFound:
            raise FileExistsError(f"{self.path} has a manifest")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Files:
        store, root = _place(self.path)
        store.create_dir(root, recursive=True)
        shard, attempt, files = TaskContext.get().partitionId(), uuid.uuid4().hex, []
        out, size, count, digest, marker = None, 0, 0, hashlib.sha256(), None

        def end() -> None:
            out.close()
            files.append(Written(temporary, name, count, size, digest.hexdigest()))

        for batch in batches:
            columns = [batch.column(c) for c in ("d", "digest", "marker", "page_id", "url", "payload", "refers")]
            for k in range(batch.num_rows):
                d, sha, is_marker, page_id, url, payload, refers = (c[k].as_py() for c in columns)
                if is_marker:
                    marker = (d, sha, refers)
                    continue
                member = page_record(page_id, url, payload, marker[2] if marker and marker[:2] == (d, sha) else None)
                if out and size + len(member) > self.limit:
                    end()
                    out = None
                if out is None:
                    name = f"pages-{shard:06d}-{len(files):05d}.warc.gz"
                    temporary = f".{name}.{attempt}"
                    out, size, count, digest = store.open_output_stream(f"{root}/{temporary}", compression=None), 0, 0, hashlib.sha256()
                    info = record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{_record_id(name)}>"), ("WARC-Date", DATE),
                                   ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                    out.write(info)
                    digest.update(info)
                    size = len(info)
                out.write(member)
                digest.update(member)
                size, count = size + len(member), count + 1
        if out:
            end()
        return Files(files)

    def commit(self, messages: list[Files | None]) -> None:
        store, root = _place(self.path)
        store.create_dir(root, recursive=True)
        files = sorted((f for m in messages if m for f in m.files), key=lambda f: f.name)
        for f in files:
            store.move(f"{root}/{f.temporary}", f"{root}/{f.name}")
        body = json.dumps({"files": [{"name": f.name, "records": f.records, "bytes": f.bytes, "sha256": f.sha256} for f in files]}, indent=0)
        temporary = f"{root}/.{MANIFEST}.{uuid.uuid4().hex}"
        with store.open_output_stream(temporary) as out:
            out.write(body.encode())
        store.move(temporary, f"{root}/{MANIFEST}")
        kept = {f.name for f in files}
        for x in store.get_file_info(fs.FileSelector(root)):  # of attempts that were lost, and of what was there before
            if x.is_file and x.base_name.lstrip(".").startswith("pages-") and x.base_name not in kept:
                store.delete_file(x.path)

    def abort(self, messages: list[Files | None]) -> None:
        store, root = _place(self.path)
        for f in (f for m in messages if m for f in m.files):
            if store.get_file_info(f"{root}/{f.temporary}").type != fs.FileType.NotFound:
                store.delete_file(f"{root}/{f.temporary}")


def members(source) -> Iterator[bytes]:
    """The decompressed gzip members of a stream, one at a time."""
    unpacker, parts, data = zlib.decompressobj(31), [], b""
    while data or (data := source.read(1 << 20)):
        parts.append(unpacker.decompress(data))
        data = unpacker.unused_data
        if unpacker.eof:
            yield b"".join(parts)
            unpacker, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the archive ends within a record")


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record; an error if its length or digest is not that of the block."""
    head, _, rest = member.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines)
    block = rest[: int(fields["Content-Length"])]
    if first.encode() + b"\r\n" != VERSION or rest[len(block) :] != b"\r\n\r\n" or _sha1(block) != fields["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    return fields, block


def page_row(fields: dict[str, str], block: bytes) -> tuple:
    """The columns of ``_ROW`` and the payload (null in a revisit)."""
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    whole = fields["WARC-Type"] == "response"
    if whole and (len(payload) != size or _sha1(payload) != fields["WARC-Payload-Digest"]):
        raise ValueError(f"damaged payload {fields['WARC-Record-ID']}")
    page, other = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
    return (
        page and int(page), fields.get("WARC-Target-URI"), fields["WARC-Type"], fields["WARC-Record-ID"][1:-1], size,
        base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex(), other and int(other), payload if whole else None,
    )


class File(InputPartition):
    def __init__(self, name: str):
        super().__init__(name)


class Reader(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.path, self.names = options["path"], [f.name for f in schema.fields]

    def partitions(self) -> list[File]:
        store, root = _place(self.path)
        with store.open_input_stream(f"{root}/{MANIFEST}") as source:
            return [File(f["name"]) for f in json.loads(source.read())["files"]] or [File("")]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        if not partition.value:
            return
        store, root = _place(self.path)
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()][: len(self.names)]
        rows, held = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=self.names)

        with store.open_input_stream(f"{root}/{partition.value}", compression=None) as source:
            for member in members(source):
                fields, block = parse(member)
                if fields["WARC-Type"] == "warcinfo":
                    continue
                rows.append(page_row(fields, block)[: len(self.names)])
                held += len(member)
                if held >= 4 << 20 or len(rows) >= 4096:
                    yield batch()
                    rows, held = [], 0
        if rows:
            yield batch()


class WarcSource(DataSource):
    """``spark.read.format("warc")``: options ``path`` and ``payload`` (true unless false); writes take ``fileBytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return _ROW + (", payload binary" if self.options.get("payload", "true") != "false" else "")

    def reader(self, schema) -> Reader:
        return Reader(self.options, schema)

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options, overwrite)


def _keys(pages: DataFrame) -> DataFrame:
    """``d, page_id, url, payload, digest, size, x, salt`` of every page; rows of one page and payload differ in ``salt`` alone."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    rows = rows.select(F.coalesce("page_id", F.lit(NO_ID)).alias("d"), "*", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("size"))
    return rows.select("*", F.conv(F.substring("digest", 1, 15), 16, 10).cast("long").alias("x"), F.monotonically_increasing_id().alias("salt"))


def _revisits(thin: DataFrame, least: int) -> DataFrame:
    """``d, digest, x, refers`` of every page whose payload a page with a larger id holds."""
    big = thin.filter(F.col("size") >= least)
    held = big.groupBy("digest", "size").agg(F.max(F.struct("page_id", "url")).alias("last"), F.count("*").alias("n")).filter("n > 1")
    held = stored(held.select("digest", "size", F.struct(F.col("last.page_id").alias("id"), "last.url").alias("refers")), "held")
    once = stored(big.groupBy("d", "page_id", "digest", "size", "x").agg(F.lit(1).alias("one")).drop("one"), "pages")
    return stored(once.join(held, ["digest", "size"]).filter(~F.col("page_id").eqNullSafe(F.col("refers.id"))).select("d", "digest", "x", "refers"), "revisits")


def _bounds(thin: DataFrame, shards: int) -> list[tuple[int, int, int]]:
    """``shards - 1`` keys that part the rows into shards of about equal size, from a weighted sample by keyed hashes."""
    even = (F.xxhash64("d", "digest", "url").bitwiseAND((1 << 52) - 1) + 1) / float(1 << 52)
    drawn = thin.select("d", "x", "salt", (-F.log(even) / (F.col("size") + 2000)).alias("turn"))
    keys = sorted((r.d, r.x, r.salt) for r in drawn.orderBy("turn", "d", "x", "salt").limit(SAMPLED * shards).collect())
    picked = [keys[len(keys) * k // shards] for k in range(1, shards)] if keys else []
    groups = [k[:2] for k in picked]
    # a page that repeats so often that several bounds fall into it is split by its rows' places
    return [k if groups.count(k[:2]) > 1 else (*k[:2], -1) for k in picked]


def _shard(bounds: list[tuple[int, int, int]], d: Column, x: Column, salt: Column) -> Column:
    """How many bounds are not above the key, by binary search."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.struct(*(F.lit(v).cast("long").alias(n) for v, n in zip(b, "dxs"))) for b in bounds])
    key = F.struct(d.alias("d"), x.alias("x"), salt.cast("long").alias("s"))
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= len(bounds)) & (F.get(table, at + step - 1) <= key), at + step).otherwise(at))


def write(pages: DataFrame, path: str, least: int = REVISITED, shards: int | None = None, file_bytes: int = FILE_BYTES) -> None:
    """Archives of all ``pages`` under ``path``; an error if one is there already.

    Pages are sorted by id (a null last), payload digest and address. Of pages with equal payloads of ``least`` bytes or more, those with
    the largest id (a null is the least) are responses and the others revisit them; smaller payloads are always stored. Rows that
    repeat id and payload share their record type, and equal rows their record id. A null page text is an empty payload. The
    same pages give the same files byte for byte, however they are partitioned, unless one row repeats so often that it fills
    whole shards. An empty table gives a manifest without files. Other columns are ignored.
    """
    spark = pages.sparkSession
    spark.dataSource.register(WarcSource)
    rows, shards = _keys(pages), shards or partitions(spark)
    thin = stored(rows.drop("payload"), "digests")
    marks = _revisits(thin, least)
    bounds = _bounds(thin, shards)
    shape = ("shard", "d", "digest", "marker", "page_id", "url", "payload", "refers")
    refers = "struct<id:bigint,url:string>"
    body = rows.withColumns({"shard": _shard(bounds, F.col("d"), F.col("x"), F.col("salt")), "marker": F.lit(False), "refers": F.lit(None).cast(refers)})
    first, last = (_shard(bounds, F.col("d"), F.col("x"), F.lit(s)) for s in (0, NO_ID))
    marks = marks.withColumns({"shard": F.explode(F.sequence(first, last)), "marker": F.lit(True), "page_id": F.lit(None).cast("long"),
                               "url": F.lit(None).cast("string"), "payload": F.lit(None).cast("binary"), "refers": F.col("refers").cast(refers)})
    dealt = body.select(*shape).union(marks.select(*shape)).repartitionById(shards, F.col("shard"))
    ordered = dealt.sortWithinPartitions("d", "digest", F.desc("marker"), "url").drop("shard")
    ordered.write.format("warc").mode("append").option("path", path).option("fileBytes", file_bytes).save()


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """A row per page record of the committed archives, with ``payload`` null in revisits; damaged records are errors."""
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).option("path", path).load()


def report(pages: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, record_id`` per page, read back from its archives."""
    path = scratch_path(pages.sparkSession, "warc")
    write(pages, path)
    return read(pages.sparkSession, path, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id")


#: The rows that the archives must hold, for distinct ids.
SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
q AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM q)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {REVISITED} AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {REVISITED} AND page_id <> last THEN last END AS refers_to
FROM r
"""
