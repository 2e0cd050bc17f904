"""A deterministic, sharded WARC writer, and a reader that checks what it reads.

Records are range-sorted by page id (then address and digest). Shard boundaries come
from a bounded sample that a hash of the rows' content selects, so the same table gives
the same files however it is partitioned. A shard's task appends records, each a gzip
member, to a file under a temporary name; when the file reaches a compressed size it is
moved to its final name and the next one begins. The manifest, a table that Spark
commits, lists the files with their sizes and digests; a reader goes by the manifest
alone, so files of lost or repeated attempts are never seen. All headers, ids and
digests are computed anew; dates are a parameter.

Of records with equal payloads, the one with the largest id is a response, the others
are revisits that refer to it and carry no payload. Equal payloads are found by SHA-1,
grouped with partial sums; only digests that occur twice are joined, by broadcast while
their checked number allows it. Tasks hold one record at a time.

Defined results: a NULL payload is empty; a NULL address is ``urn:page:<id>``; a NULL id
sorts first; of rows that are equal in id, address and payload the first one written is
the response; line breaks and blanks in addresses are percent-encoded; no rows give no
files; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.llm.ranking import SMALL
from jobsignals.llm.tables import kept, table, text_bytes
from jobsignals.session import shared_folder

#: Payload bytes of a shard, and the compressed size at which a file is closed.
SHARD_BYTES = 32 << 20
ROLL_BYTES = 16 << 20
MAX_SHARDS = 50_000
#: Rows per shard in the sample that sets the boundaries.
SAMPLED = 100
MAX_SAMPLE = 1_000_000
#: Tasks that read archives, about one file each up to this number of files.
READ_TASKS = 10_000
DATE = "2000-01-01T00:00:00Z"
LEVEL = 6

MANIFEST = "shard int, file int, path string, records long, bytes long, sha1 string"
RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, payload binary")
_IDS = uuid.UUID("7d1e2f36-2c0f-4b52-9d6a-0f3f5a8f3c11")
_LOWEST = -(1 << 63)


def _file_system(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder)


def _address(url: str | None, page_id: int | None) -> str:
    if url is None:
        return f"urn:page:{'' if page_id is None else page_id}"
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _record_id(page_id: int | None, url: str | None, sha1: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_IDS, f'{page_id}|{_address(url, page_id)}|{sha1}|{copy}')}>"


def _base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _member(fields: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return gzip.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n", level, mtime=0)


def _block_digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def _record(page_id, url, payload: bytes, size: int, sha1: str, first, copy: int, date: str, level: int) -> bytes:
    """One response or, if ``first`` names another record (id, address, copy), one revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if first else http + payload
    fields = [
        ("WARC-Type", "revisit" if first else "response"), ("WARC-Record-ID", _record_id(page_id, url, sha1, copy)),
        ("WARC-Date", date), ("WARC-Target-URI", _address(url, page_id)),
        ("WARC-Payload-Digest", "sha1:" + _base32(sha1)), ("WARC-Block-Digest", _block_digest(block)),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if first:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", _record_id(first[0], first[1], sha1, 0)),
            ("WARC-Refers-To-Target-URI", _address(first[1], first[0])), ("WARC-Refers-To-Date", date),
        ]
        if first[0] is not None:
            fields.append(("X-Refers-To-Page-Id", str(first[0])))
    return _member(fields, block, level)


class _Files:
    """Rolling files of one shard: temporary while they grow, then moved."""

    def __init__(self, folder: str, shard: int, roll_bytes: int, date: str, level: int) -> None:
        self.system, self.folder = _file_system(folder)
        self.shard, self.roll_bytes, self.date, self.level = shard, roll_bytes, date, level
        self.number, self.stream = -1, None

    def add(self, record: bytes) -> Iterator[tuple]:
        if self.stream is None:
            self.number += 1
            self.name = f"pages-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.folder}/{self.name}.{uuid.uuid4().hex}.open"
            self.stream = self.system.open_output_stream(self.temporary, compression=None)
            self.size, self.records, self.sha1 = 0, 0, hashlib.sha1()
            block = f"software: jobsignals\r\nformat: WARC File Format 1.1\r\npart: {self.name}\r\n".encode()
            self._write(_member([
                ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_IDS, self.name)}>"),
                ("WARC-Date", self.date), ("WARC-Filename", self.name), ("WARC-Block-Digest", _block_digest(block)),
                ("Content-Type", "application/warc-fields")], block, self.level))
        self._write(record)
        self.records += 1
        if self.size >= self.roll_bytes:
            yield self.close()

    def _write(self, member: bytes) -> None:
        self.stream.write(member)
        self.sha1.update(member)
        self.size += len(member)

    def close(self) -> tuple | None:
        if self.stream is None:
            return None
        self.stream.close()
        self.stream = None
        final = f"{self.folder}/{self.name}"
        try:
            self.system.move(self.temporary, final)
        except OSError:  # some stores do not replace; an earlier attempt wrote the same bytes
            self.system.delete_file(final)
            self.system.move(self.temporary, final)
        return self.shard, self.number, final, self.records, self.size, self.sha1.hexdigest()


def _written(folder: str, roll_bytes: int, date: str, level: int):
    def manifest(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
            names=["shard", "file", "path", "records", "bytes", "sha1"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        files, last, copy = None, None, 0
        names = ("shard", "page_id", "url", "size", "sha1", "first_id", "first_url", "response", "again")
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in names)
            for (shard, page_id, url, size, sha1, first_id, first_url, response, again), payload in zip(
                    zip(*columns), text_bytes(batch.column("payload"))):
                if files is None or files.shard != shard:
                    if files:
                        done.append(files.close())
                    files = _Files(folder, shard, roll_bytes, date, level)
                copy = copy + 1 if (page_id, url, sha1) == last else 0
                last = (page_id, url, sha1)
                if not again:
                    first = None
                elif response:
                    first = (page_id, url) if copy else None
                else:
                    first = (first_id, first_url)
                done += files.add(_record(page_id, url, payload, size, sha1, first, copy, date, level))
        if files:
            done.append(files.close())
        yield manifest([r for r in done if r])

    return run


def _sharded(boundaries: np.ndarray):
    """Adds the number of the range a row lies in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.empty(batch.num_rows, boundaries.dtype)
            for name in ("order", "tie"):
                keys[name] = batch.column(name).to_numpy(zero_copy_only=False)
            shard = np.searchsorted(boundaries, keys, side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard)], names=[*batch.schema.names, "shard"])

    return run


def _boundaries(slim: DataFrame, shard_bytes: int) -> np.ndarray:
    """First keys of all shards but the first, by sizes in a sample that the rows'
    content selects: about SAMPLED rows a shard, MAX_SAMPLE at most expected."""
    rows, size = slim.agg(F.count("*"), F.sum("size")).first()
    shards = min(max(1, -(-(size or 0) // shard_bytes)), MAX_SHARDS)
    kind = np.dtype([("order", np.int64), ("tie", np.int64)])
    if shards == 1:
        return np.empty(0, kind)
    part = max(1, rows // min(SAMPLED * shards, MAX_SAMPLE))
    picked = slim.where(F.pmod("tie", F.lit(part)) == 0).select("order", "tie", "size").collect()
    picked = sorted((r["order"], r["tie"], r["size"]) for r in picked)
    if not picked:
        return np.empty(0, kind)
    reached = np.cumsum([r[2] + 500 for r in picked])
    cuts = np.searchsorted(reached, reached[-1] * np.arange(1, shards) / shards)
    return np.unique(np.array([picked[c][:2] for c in cuts], dtype=kind))


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", least_bytes: int = 0, shard_bytes: int = SHARD_BYTES,
               roll_bytes: int = ROLL_BYTES, date: str = DATE, level: int = LEVEL,
               broadcast_digests: int = SMALL) -> DataFrame:
    """Write the records and return the manifest: shard, file, path, records, bytes, sha1.
    Payloads below ``least_bytes`` bytes are all responses."""
    system, root = _file_system(folder)
    system.create_dir(root, recursive=True)
    payload = F.coalesce(F.encode(F.col(payload_col).cast("string"), "UTF-8"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload"))
    rows = rows.withColumns({
        "size": F.octet_length("payload").cast("long"), "sha1": F.sha1("payload"),
        "order": F.coalesce("page_id", F.lit(_LOWEST))})
    rows = rows.withColumn("tie", F.xxhash64("order", "url", "sha1"))
    slim = kept(rows.drop("payload"), "warc-rows")
    place = F.struct("order", F.coalesce("url", F.lit("")).alias("known_url"), F.col("url").isNull(), "page_id", "url")
    again = slim.where(F.col("size") >= least_bytes).groupBy("sha1").agg(
        F.count("*").alias("n"), F.max(place).alias("first")).where("n > 1")
    again = kept(again.select("sha1", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"),
                              F.lit(True).alias("again")), "warc-digests")
    if again.limit(broadcast_digests + 1).count() <= broadcast_digests:
        again = F.broadcast(again)
    joined = rows.join(again, "sha1", "left").withColumn("again", F.coalesce("again", F.lit(False)))
    response = F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url"))
    # Revisits need no payload, so it is not shuffled. Equal rows keep theirs: the first is the response.
    joined = joined.withColumn("response", ~F.col("again") | response).withColumn(
        "payload", F.when(F.col("response"), F.col("payload")))
    boundaries = _boundaries(slim, shard_bytes)
    names = ["page_id", "url", "payload", "size", "sha1", "order", "tie", "first_id", "first_url", "again", "response"]
    joined = joined.select(*names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema) + ", shard int"
    # One task per shard; a hash of the shard's number would put some shards together.
    dealt = joined.mapInArrow(_sharded(boundaries), schema).repartitionById(len(boundaries) + 1, F.col("shard"))
    dealt = dealt.sortWithinPartitions("shard", "order", "url", "sha1")
    return kept(dealt.mapInArrow(_written(folder, roll_bytes, date, level), MANIFEST), "warc-manifest")


def _members(stream) -> Iterator[bytes]:
    """Unpacked gzip members of a stream, one at a time."""
    expand, parts, data = zlib.decompressobj(31), [], b""
    while True:
        if not data:
            data = stream.read(1 << 20)
            if not data:
                if parts:
                    raise ValueError("a record is cut off")
                return
        parts.append(expand.decompress(data))
        data = expand.unused_data
        if expand.eof:
            yield b"".join(parts)
            expand, parts = zlib.decompressobj(31), []


def _parsed(member: bytes) -> tuple | None:
    """The values of one response or revisit; digests and lengths are checked."""
    head, _, rest = member.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if fields.get("WARC-Block-Digest") != _block_digest(block) or rest[len(block):] != b"\r\n\r\n":
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    if fields["WARC-Type"] == "warcinfo":
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (
            len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
    number = lambda name: int(fields[name]) if name in fields else None
    return (number("X-Page-Id"), fields["WARC-Target-URI"], size, digest, fields["WARC-Type"],
            number("X-Refers-To-Page-Id"), payload if fields["WARC-Type"] == "response" else None)


def read_warc(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """Records of the files in a manifest. Every file is compared with its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        for batch in batches:
            for path, uri, records in zip(*(batch.column(c).to_pylist() for c in ("path", "root", "records"))):
                system, _ = _file_system(uri)
                rows, seen, size = [], 0, 0
                with system.open_input_stream(path, compression=None) as stream:
                    for member in _members(stream):
                        row = _parsed(member)
                        if row is None:
                            continue
                        seen += 1
                        rows.append(row if payloads else (*row[:6], None))
                        size += len(member) if payloads else 200
                        if size > 8 << 20:
                            yield batch_of(rows)
                            rows, size = [], 0
                if seen != records:
                    raise ValueError(f"{path} holds {seen} records, its manifest says {records}")
                yield batch_of(rows)

    # A manifest is small and its files are not, so the number of tasks is given: Spark
    # would merge them by the manifest's size.
    tasks = max(1, min(manifest.count(), READ_TASKS))
    number = F.pmod(F.xxhash64("path"), F.lit(tasks)).cast("int")
    return manifest.select("path", "root", "records").repartitionById(tasks, number).mapInArrow(run, RECORD)


def op4_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    manifest = write_warc(table(spark, sf_dir, "pages"), folder).withColumn("root", F.lit(folder))
    return read_warc(manifest, payloads=False).drop("url", "payload")
