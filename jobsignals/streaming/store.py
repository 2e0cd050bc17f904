"""A table keyed by id that streams write to: the last write of a key wins.

The table is a log of numbered commits, ``log/<version>.json``, over immutable files,
``data/<folder>/_bucket=<n>``. A commit is one small file that is put only if its number is
free, so writers take turns and a reader works on the files of one version, whatever
others add or replace meanwhile. A key's bucket follows from its hash. A bucket has a
*base*, the last writes when it was compacted, and *tails*, what batches brought since.

- Writing costs what the batch holds: its rows become tails. A batch that a query runs
  again after a failure is committed once; the id of the query, kept in its checkpoint,
  and the number of the batch say so. Files of writers that failed belong to no commit.
- Reading takes the rows of a base as they are, without a shuffle; only buckets with
  tails are merged. A read of some keys opens their buckets only.
- :func:`compact` replaces base and tails of the buckets that have tails by a new base and
  leaves what was committed meanwhile. Old files stay for readers of earlier versions
  until :func:`vacuum` deletes them.
- :func:`changes` gives the old and the new row of each key that was written between two
  versions.

Every row carries what decides between writes, so readers and writers agree:
``_at``, numbers to compare first to last, and where the source has them
``_partition`` and ``_offset``. Within a partition of the source the greatest offset
is the last write; between partitions, and everywhere else, the greatest ``_at`` is.
By default that is the source's time stamp, or the time of writing. Rows without a
key are not stored. A store without commits is empty.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from jobsignals.sources.files import Folder

#: Columns of a source that place a message.
POSITION = ("partition", "offset", "timestamp")
#: Buckets of a new store; large ones take as many as keep a bucket near a gigabyte.
BUCKETS = 16
_ORDER = [
    StructField("_partition", IntegerType()), StructField("_offset", LongType()),
    StructField("_at", ArrayType(LongType())),
]
#: In a base: whether the row is its key's last write. A base also keeps the last writes of
#: other partitions, since a later message of one partition can put another's on top.
_CURRENT = StructField("_current", BooleanType())


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order.

    Spark turns the rank filter into a limit that each task applies before the
    shuffle: of a key that holds most rows, every task sends one.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter("_rank = 1").drop("_rank")


def _data(rows: DataFrame, key: str) -> list[Column]:
    return [F.desc(c) for c in rows.columns if c != key and not c.startswith("_")]


def _of_each_partition(rows: DataFrame, key: str) -> DataFrame:
    """Last write per key and partition of the source; equal ones: the greatest in column
    order, so that a rerun picks the same."""
    return latest_per_key(
        rows, [key, "_partition"], [F.desc_nulls_last("_offset"), F.desc("_at"), *_data(rows, key)])


def _last_writes(rows: DataFrame, key: str) -> DataFrame:
    rows = _of_each_partition(rows, key)
    return latest_per_key(rows, [key], [F.desc("_at"), *_data(rows, key)])


# --- The log

@dataclass(frozen=True)
class Snapshot:
    """The files of one version: bases and tails by bucket, as (version, folder)."""

    version: int = -1
    buckets: int = BUCKETS
    base: dict[int, str] = field(default_factory=dict)
    tails: dict[int, tuple[tuple[int, str], ...]] = field(default_factory=dict)
    #: Last batch of each stream.
    batches: dict[str, int] = field(default_factory=dict)

    def after(self, version: int, commit: dict) -> Snapshot:
        """This version with the next commit."""
        base, tails = dict(self.base), dict(self.tails)
        batches, folder = dict(self.batches), commit["folder"]
        if commit["kind"] == "batch":
            for bucket in commit["buckets"]:
                tails[bucket] = (*tails.get(bucket, ()), (version, folder))
            batches[commit["stream"]] = commit["batch"]
        else:
            for name, upto in commit["merged"].items():
                bucket = int(name)
                left = tuple(t for t in tails.pop(bucket, ()) if t[0] > upto)
                base[bucket] = folder
                if left:
                    tails[bucket] = left
        return Snapshot(version, commit["table_buckets"], base, tails, batches)

    def state(self) -> dict:
        return {"base": self.base, "tails": self.tails, "batches": self.batches}

    @classmethod
    def of(cls, version: int, commit: dict) -> Snapshot:
        """The version of a commit that holds its whole state."""
        state = commit["state"]
        return cls(
            version, commit["table_buckets"], {int(b): f for b, f in state["base"].items()},
            {int(b): tuple((v, f) for v, f in ts) for b, ts in state["tails"].items()}, state["batches"])


def _log(spark: SparkSession, path: str) -> Folder:
    return Folder(spark, f"{path}/log")


def _name(version: int) -> str:
    return f"{version:020d}.json"


#: Every so many commits hold the whole state, so that a reader reads few files.
_WHOLE = 32


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot:
    """The last version of the store, or a given one."""
    log = _log(spark, path)
    versions = sorted(int(n[:-5]) for n in log.names() if n.endswith(".json") and n[:-5].isdigit())
    versions = [v for v in versions if version is None or v <= version]
    if version is not None and version >= 0 and version not in versions:
        raise ValueError(f"no version {version} in {path}")
    found, later = Snapshot(), []
    for v in reversed(versions):
        commit = json.loads(log.text(_name(v)))
        if "state" in commit:
            found = Snapshot.of(v, commit)
            break
        later.append((v, commit))
    for v, commit in reversed(later):
        found = found.after(v, commit)
    return found


def _commit(spark: SparkSession, path: str, commit: dict, still: Callable[[Snapshot], bool]) -> int | None:
    """Append a commit; its version, or None if ``still`` says that it is void by now."""
    while True:
        now = snapshot(spark, path)
        if not still(now):
            return None
        entry = commit | {"table_buckets": now.buckets if now.version >= 0 else commit["table_buckets"],
                          "time": int(time.time() * 1000)}
        version = now.version + 1
        if version % _WHOLE == 0 and version:
            entry["state"] = now.after(version, entry).state()
        if _log(spark, path).put(_name(version), json.dumps(entry)):
            return version


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str, key: str, buckets: int) -> tuple[str, list[int]]:
    """Rows as files of their buckets, each sorted by key: the new folder and its buckets. A
    bucket has one file, or several where it is large: adaptive execution splits what one
    task would have to read."""
    folder = uuid.uuid4().hex
    (rows.withColumn("_bucket", _bucket(F.col(key), buckets)).hint("rebalance", "_bucket")
     .sortWithinPartitions("_bucket", key).write.partitionBy("_bucket").option("compression", "zstd")
     .parquet(f"{path}/data/{folder}"))
    names = Folder(rows.sparkSession, f"{path}/data").names(folder)
    return folder, sorted(int(n.split("=")[1]) for n in names if n.startswith("_bucket="))


# --- Writing

def _number(c: Column, kind: str) -> Column:
    return F.unix_micros(c.cast("timestamp")) if kind in ("timestamp", "date", "timestamp_ntz") else c.cast("long")


def upsert_batch(path: str, key: str = "id", newest: Sequence[str] = (), stream: str | Callable[[], str] = "manual",
                 buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes each batch to the store.

    ``newest`` names columns of numbers or times; the row with the greatest values wins,
    whichever batch it came in. Without it source positions decide, or else the time of
    writing. Columns named in ``POSITION`` are not stored as data. ``stream`` is the id
    of the writing stream, or a function that finds it; its batches have rising numbers.
    ``buckets`` counts where the store is new.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = stream if isinstance(stream, str) else stream()

        def new(now: Snapshot) -> bool:
            return now.batches.get(name, -1) < batch_id

        before = snapshot(spark, path)
        if not new(before):
            return  # written, committed and run again
        kinds = dict(batch.dtypes)
        placed = set(POSITION) <= kinds.keys()
        if newest:
            at = F.array(*[_number(F.col(c), kinds[c]) for c in newest])
        elif placed:
            at = F.array(_number(F.col("timestamp"), kinds["timestamp"]))
        else:
            at = F.array(F.unix_micros(F.current_timestamp()), F.lit(batch_id).cast("long"))
        by_position = placed and not newest
        rows = batch.dropna(subset=[key]).withColumns({
            "_partition": (F.col("partition") if by_position else F.lit(None)).cast("int"),
            "_offset": (F.col("offset") if by_position else F.lit(None)).cast("long"),
            "_at": at,
        })
        rows = rows.drop(*POSITION) if placed else rows
        rows = _of_each_partition(rows, key) if by_position else _last_writes(rows, key)
        count = before.buckets if before.version >= 0 else buckets
        while True:
            folder, touched = _write(rows, path, key, count)
            commit = {"kind": "batch", "folder": folder, "buckets": touched, "stream": name, "batch": batch_id,
                      "table_buckets": count}
            version = _commit(spark, path, commit, lambda now: new(now) and (now.version < 0 or now.buckets == count))
            now = snapshot(spark, path)
            if version is not None or not new(now):
                return
            count = now.buckets  # another writer began the store with another number

    return write


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps in its checkpoint from its first start on."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


# --- Reading

def _paths(path: str, files: Iterable[tuple[int, str]]) -> list[str]:
    return [f"{path}/data/{folder}/_bucket={bucket}" for bucket, folder in sorted(files)]


def _rows(spark: SparkSession, path: str, schema: StructType, files: Iterable[tuple[int, str]]) -> DataFrame:
    """Rows of some files, (bucket, folder) each."""
    whole = StructType([*schema.fields, *_ORDER, _CURRENT])
    paths = _paths(path, files)
    return spark.read.schema(whole).parquet(*paths) if paths else spark.createDataFrame([], whole)


def _files(at: Snapshot, buckets: Iterable[int]) -> list[tuple[int, str]]:
    out = []
    for b in buckets:
        out += [(b, at.base[b])] if b in at.base else []
        out += [(b, folder) for _, folder in at.tails.get(b, ())]
    return out


def _read(spark: SparkSession, path: str, schema: StructType, key: str, at: Snapshot, buckets: Iterable[int],
          chosen: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    buckets = list(buckets)
    merged = [b for b in buckets if at.tails.get(b)]
    clean = [(b, at.base[b]) for b in buckets if b in at.base and not at.tails.get(b)]
    names = schema.fieldNames()
    out = chosen(_rows(spark, path, schema, clean).where("_current").select(*names))
    if merged:
        # A base and each tail hold a row per key and partition, so no key is hot here, and one
        # shuffle by key serves both steps of the merge.
        found = chosen(_rows(spark, path, schema, _files(at, merged)).drop("_current"))
        out = out.unionAll(_last_writes(found.repartition(key), key).select(*names))
    return out


def read_store(spark: SparkSession, path: str, schema: StructType, key: str = "id", version: int | None = None,
               keys: Sequence | None = None) -> DataFrame:
    """Rows of the store, now or at a version; with ``keys``, a list the caller knows, those
    rows only, from their buckets."""
    at = snapshot(spark, path, version)
    if keys is None:
        return _read(spark, path, schema, key, at, range(at.buckets))
    wanted = spark.createDataFrame([(k,) for k in keys], StructType([StructField("key", schema[key].dataType)]))
    buckets = [r[0] for r in wanted.select(_bucket(F.col("key"), at.buckets)).distinct().collect()]
    return _read(spark, path, schema, key, at, sorted(buckets), lambda rows: rows.where(F.col(key).isin(list(keys))))


def changes(spark: SparkSession, path: str, schema: StructType, after: int, upto: int, key: str = "id") -> DataFrame:
    """Keys written in the versions after ``after`` and up to ``upto`` with their rows at
    either: key, old, new (structs; ``old`` is NULL for a new key). Keys whose row stayed as it
    was are left out. Only the buckets that were written are opened."""
    old, new = snapshot(spark, path, after), snapshot(spark, path, upto)
    log = _log(spark, path)
    written = []
    for version in range(after + 1, upto + 1):
        commit = json.loads(log.text(_name(version)))
        written += [(b, commit["folder"]) for b in commit["buckets"]] if commit["kind"] == "batch" else []
    touched = sorted({b for b, _ in written})
    keys = _rows(spark, path, schema, written).select(key).distinct()

    def at(version: Snapshot, name: str) -> DataFrame:
        rows = _read(spark, path, schema, key, version, touched, lambda rows: rows.join(keys, key, "left_semi"))
        return rows.select(F.col(key), F.struct(*schema.fieldNames()).alias(name))

    both = keys.join(at(old, "old"), key, "left").join(at(new, "new"), key, "left")
    return both.where(~F.col("old").eqNullSafe(F.col("new")))


# --- Keeping

def compact(spark: SparkSession, path: str, schema: StructType, key: str = "id", tails: int = 1) -> int | None:
    """Replace base and tails of the buckets with at least ``tails`` tails by a new base;
    the version, or None if there was nothing to do or another compaction was faster.
    Batches committed meanwhile stay as tails; readers of earlier versions go on."""
    at = snapshot(spark, path)
    due = [b for b, found in at.tails.items() if len(found) >= tails]
    if not due:
        return None
    rows = _of_each_partition(_rows(spark, path, schema, _files(at, due)).drop("_current"), key)
    first = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("_at"), *_data(rows, key)))
    folder, _ = _write(rows.withColumn("_current", first == 1), path, key, at.buckets)
    merged = {str(b): max(v for v, _ in at.tails[b]) for b in due}

    def still(now: Snapshot) -> bool:
        return all(now.base.get(b) == at.base.get(b) for b in due)

    commit = {"kind": "base", "folder": folder, "merged": merged, "table_buckets": at.buckets}
    return _commit(spark, path, commit, still)


def vacuum(spark: SparkSession, path: str, keep_hours: float = 168) -> int:
    """Delete files that the last version does not use and that are older than
    ``keep_hours``, which has to exceed any read or write; how many folders of buckets went.
    Versions whose files are gone can no longer be read."""
    at = snapshot(spark, path)
    used = set(_files(at, range(at.buckets)))
    data, oldest, gone = Folder(spark, f"{path}/data"), (time.time() - 3600 * keep_hours) * 1000, 0
    for folder, changed in data.names().items():
        names = {n: t for n, t in data.names(folder).items() if n.startswith("_bucket=")}
        dead = [n for n, t in names.items() if t < oldest and (int(n.split("=")[1]), folder) not in used]
        if len(dead) == len(names) and changed < oldest:
            data.delete(folder)
        else:
            for name in dead:
                data.delete(f"{folder}/{name}")
        gone += len(dead)
    return gone
