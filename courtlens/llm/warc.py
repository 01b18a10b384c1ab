"""Deterministic sharded WARC writer, and a reader of what it wrote.

* Records are sorted by id, then digest, over all shards. Shard bounds come from the different
  (id, digest) pairs with the smallest hashes, so they depend on the rows alone, and an id that many
  payloads share is cut between digests. Payloads are shuffled once, straight to their shard.
* Of equal payloads of at least MIN_REVISIT bytes the one with the smallest id is the response and
  the others are revisits. That is decided on digests; each revisit's mark is sorted in front of
  its record, so payloads are joined to nothing.
* A task streams its shard into gzip members, one a record, regenerates every header and digest,
  and rolls to the next file when the compressed size reaches ``roll_bytes``.
* Files are written under temporary names. Once the write job has ended, the files of its
  successful attempts are renamed, which may be repeated, and the manifest is written last.
  Leftovers of failed attempts go with their folder.
* Reading follows the manifest: a folder without one, a missing, added, shortened or lengthened file
  and a file with another number of records are errors, as are blocks and payloads that do not
  match their digests.

Equal input gives equal files, byte for byte, whatever the partitions and attempts.

Defined cases: a null payload is empty; a null url has no target header; control characters of a
url are percent-encoded; null ids sort first and are revisits if an equal payload has an id;
among repeated rows with the smallest id the first is the response, the others revisit it; an
empty table gives an archive without files; other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlens.llm.common import column, store

MIN_REVISIT = 100
SHARD_BYTES = 32 << 20
ROLL_BYTES = 16 << 20
# Shards are larger than SHARD_BYTES from 640 GB on; each samples SAMPLE keys for its bound.
MAX_SHARDS = 20_000
SAMPLE = 16
# Tasks that read an archive, at most.
MAX_READERS = 20_000
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the format.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc-record")


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


# ---- records ----------------------------------------------------------------


def record_id(page: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page}/{digest}')}>"


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One gzip member; zlib writes no time into it."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = packer.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n")
    return data + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def page_record(
    page: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, revisit: bool
) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page, digest)),
        ("WARC-Date", DATE),
    ]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        headers.append(("WARC-Target-URI", safe))
    headers += [
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    if page is not None:
        headers.append(("X-Page-ID", page))
    if revisit:
        headers += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_id(refers_to, digest))]
        if refers_to is not None:
            headers.append(("X-Refers-To-Page-ID", refers_to))
    return _member(headers, block)


def _info_record(name: str) -> bytes:
    headers = [
        ("WARC-Type", "warcinfo"),
        ("WARC-Record-ID", record_id(name, "")),
        ("WARC-Date", DATE),
        ("WARC-Filename", name),
        ("Content-Type", "application/warc-fields"),
    ]
    return _member(headers, b"format: WARC File Format 1.1\r\n")


def members(data: bytes) -> Iterator[bytes]:
    """The unpacked gzip members of a file."""
    view, at = memoryview(data), 0
    while at < len(view):
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if at >= len(view):
                raise ValueError("the last record is cut off")
            piece = view[at : at + 65536]
            parts.append(unpacker.decompress(piece))
            at += len(piece) - len(unpacker.unused_data)
        yield b"".join(parts)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    if "WARC-Block-Digest" in headers:
        if headers["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
            raise ValueError(f"block of {headers['WARC-Record-ID']} does not match its digest")
    return headers, block


# ---- writing ----------------------------------------------------------------


class _Shard:
    """The files of one shard, under temporary names."""

    def __init__(self, folder: str, shard: int, roll_bytes: int) -> None:
        self.store, self.path = _open(folder)
        self.shard, self.roll, self.files, self.out = shard, roll_bytes, [], None

    def add(self, record: bytes) -> None:
        if self.out is None:
            name = f"part-{self.shard:05d}-{len(self.files):05d}.warc.gz"
            temporary = f"_temporary/{name}.{uuid.uuid4().hex}"
            self.store.create_dir(posixpath.join(self.path, "_temporary"), recursive=True)
            self.out = self.store.open_output_stream(posixpath.join(self.path, temporary))
            self.files.append({"name": name, "temporary": temporary, "bytes": 0, "records": 0})
            self._write(_info_record(name))
        self._write(record)
        self.files[-1]["records"] += 1
        if self.files[-1]["bytes"] >= self.roll:
            self.close()

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.files[-1]["bytes"] += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def _write_shard(folder: str, roll_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, mark, last, done = None, None, None, []
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(batch.num_columns))):
                number, page, is_page, digest, leader, url = (x.as_py() for x in row[:6])
                if shard is None or shard.shard != number:
                    if shard is not None:
                        shard.close()
                        done += shard.files
                    shard, mark, last = _Shard(folder, number, roll_bytes), None, None
                if not is_page:
                    mark = (page, digest, leader)
                    continue
                payload = row[6].cast(pa.binary()).as_py()
                revisit, refers_to = False, None
                if mark is not None and mark[:2] == (page, digest):
                    revisit, refers_to = True, mark[2]
                elif last == (page, digest) and len(payload) >= MIN_REVISIT:
                    revisit, refers_to = True, page
                last = (page, digest)
                shard.add(page_record(page, url, payload, digest, refers_to, revisit))
        if shard is not None:
            shard.close()
            done += shard.files
        kind = pa.struct(
            [("name", pa.string()), ("temporary", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]
        )
        yield pa.RecordBatch.from_struct_array(pa.array(done, kind))

    return run


def _rename(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, path = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                source = posixpath.join(path, row["temporary"])
                final = posixpath.join(path, row["name"])
                # Nothing is left to do if an earlier attempt got this far.
                if target.get_file_info(source).type != fs.FileType.NotFound:
                    target.move(source, final)
                elif target.get_file_info(final).type == fs.FileType.NotFound:
                    raise FileNotFoundError(row["temporary"])
            yield batch.select(["name", "bytes", "records"])

    return run


def write_warc(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
) -> DataFrame:
    """Write one record per row into ``folder``, which must be new; returns the manifest."""
    spark = pages.sparkSession
    payload = F.coalesce(column(pages, payload_col), F.lit(""))
    rows = pages.select(
        column(pages, id_col).alias("id"),
        F.sha2(F.encode(payload, "UTF-8"), 256).alias("digest"),
        F.octet_length(payload).cast("long").alias("size"),
        column(pages, url_col).alias("url"),
        payload.alias("payload"),
    )
    slim = store(rows.select("id", "digest", "size"), "digests")
    total = slim.agg(F.sum("size")).first()[0] or 0
    shards = min(max(1, -(-total // shard_bytes)), MAX_SHARDS)
    text = F.col("id").cast("string")
    sample = (
        slim.select("id", "digest").distinct().orderBy(F.xxhash64("id", "digest"), "id", "digest").limit(SAMPLE * shards)
    )
    # (False, digest) for a null id, which sorts first.
    keys = sorted(((True, i, d) if i is not None else (False, d)) for i, d in sample.collect())
    bounds = [keys[len(keys) * i // shards] for i in range(1, shards)] if keys else []

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series, none: pd.Series, digests: pd.Series) -> pd.Series:
        rows = zip(ids.tolist(), none.tolist(), digests.tolist(), strict=True)
        return pd.Series([bisect.bisect_right(bounds, (False, d) if n else (True, i, d)) for i, n, d in rows], dtype="int32")

    leaders = (
        slim.filter(F.col("size") >= MIN_REVISIT)
        .groupBy("digest")
        .agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    marks = slim.join(leaders, "digest").filter("leader < id OR id IS NULL AND leader IS NOT NULL")
    kept = ["id", "page", "is_page", "digest", "leader", "url", "payload"]
    both = (
        rows.withColumn("leader", F.lit(None).cast("string"))
        .withColumn("is_page", F.lit(True))
        .withColumn("page", text)
        .select(kept)
        .unionByName(
            marks.dropDuplicates(["id", "digest"])
            .select(
                "id",
                text.alias("page"),
                F.lit(False).alias("is_page"),
                "digest",
                F.col("leader").cast("string").alias("leader"),
                F.lit(None).cast("string").alias("url"),
                F.lit(None).cast("string").alias("payload"),
            )
            .select(kept)
        )
    )
    # The id of a null one is any value of its type, so that the others reach the task as they are.
    some = F.coalesce("id", F.lit("0").cast(slim.schema["id"].dataType))
    placed = both.withColumn("shard", shard_of(some, F.col("id").isNull(), "digest"))
    dealt = placed.repartitionById(shards, F.col("shard")).sortWithinPartitions(
        "shard", "id", "digest", "is_page", "url"
    )
    written = store(
        dealt.select("shard", "page", "is_page", "digest", "leader", "url", "payload").mapInArrow(
            _write_shard(folder, roll_bytes), "name string, temporary string, bytes bigint, records bigint"
        ),
        "written_files",
    )
    manifest = f"{folder}/_manifest"
    written.mapInArrow(_rename(folder), "name string, bytes bigint, records bigint").write.parquet(manifest)
    return spark.read.parquet(manifest)


# ---- reading ----------------------------------------------------------------


def _parse_files(folder: str):
    """Tasks that read the files of manifest rows."""
    names = ["page", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload"]
    kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]

    def record(headers: dict[str, str], block: bytes) -> tuple:
        http, _, payload = block.partition(b"\r\n\r\n")
        digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
        length = int(re.search(rb"Content-Length: (\d+)", http)[1])
        revisit = headers["WARC-Type"] == "revisit"
        if not revisit and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match")
        return (
            headers.get("X-Page-ID"),
            headers.get("WARC-Target-URI"),
            headers["WARC-Type"],
            digest,
            length,
            headers.get("X-Refers-To-Page-ID"),
            None if revisit else payload,
        )

    def read(name: str, content: bytes, size: int, expected: int) -> Iterator[pa.RecordBatch]:
        if len(content) != size:
            raise ValueError(f"{name} has {len(content)} bytes, not {size}")
        rows, held, seen = [], 0, 0
        for member in members(content):
            headers, block = parse_record(member)
            if headers["WARC-Type"] == "warcinfo":
                continue
            rows.append(record(headers, block))
            seen, held = seen + 1, held + len(block)
            if held > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                rows, held = [], 0
        if seen != expected:
            raise ValueError(f"{name} has {seen} records, not {expected}")
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, path = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with archive.open_input_stream(posixpath.join(path, row["name"]), compression=None) as stream:
                    content = stream.read()
                yield from read(row["name"], content, row["bytes"], row["records"])

    return run


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """(page, url, record_type, payload_digest, payload_bytes, refers_to, payload) per record.

    The files named in the manifest, and no others, make up an archive. Ids are strings; the payload
    of a revisit is null. Files are read whole, so ``roll_bytes`` bounds a task's memory.
    """
    schema = (
        "page string, url string, record_type string, payload_digest string, "
        "payload_bytes bigint, refers_to string, payload binary"
    )
    manifest = spark.read.parquet(f"{folder}/_manifest")
    there = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    there = there.select(F.substring_index("path", "/", -1).alias("name"), "length")
    off = there.join(manifest, "name", "full_outer").filter("NOT (length <=> bytes)")
    if wrong := [r["name"] for r in off.select("name").orderBy("name").limit(5).collect()]:
        raise ValueError(f"files differ from the manifest: {', '.join(wrong)}")
    files = manifest.count()
    if not files:
        return spark.createDataFrame([], schema)
    return manifest.repartition(min(files, MAX_READERS)).mapInArrow(_parse_files(folder), schema)
