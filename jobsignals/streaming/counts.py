"""Counts of a keyed store's terms, kept up to date by its changes.

The table is a log of signed counts: each refresh reads the keys that were written since
the last one, counts the terms of their old rows with -1 and those of their new rows
with +1, and appends what does not cancel out. Its work follows from what was written,
not from what the store holds. Commits are numbered and put only if their number is
free, so a refresh that runs twice or beside another one counts once.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from jobsignals.sources.files import Folder
from jobsignals.streaming.store import changes, snapshot


def _entries(spark: SparkSession, path: str) -> list[dict]:
    """The log's entries from the last whole one on."""
    log = Folder(spark, f"{path}/log")
    out: list[dict] = []
    for name in sorted(log.names(), reverse=True):
        if name.endswith(".json"):
            out.insert(0, json.loads(log.text(name)) | {"number": int(name[:-5])})
            if out[0]["whole"]:
                break
    return out


def _append(spark: SparkSession, path: str, number: int, entry: dict) -> bool:
    return Folder(spark, f"{path}/log").put(f"{number:020d}.json", json.dumps(entry))


def _sum(spark: SparkSession, path: str, entries: list[dict], name: str, kind: str) -> DataFrame:
    schema = f"`{name}` {kind}, count long"
    folders = [f"{path}/data/{e['folder']}" for e in entries]
    rows = spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
    return rows.groupBy(name).agg(F.sum("count").alias("count")).where("count <> 0")


def refresh_counts(spark: SparkSession, path: str, store: str, schema: StructType, column: str, name: str,
                   key: str = "id") -> int:
    """Bring the counts of the terms in the list ``column`` up to the store's last version,
    which is returned. NULL lists and NULL terms are not counted."""
    entries = _entries(spark, path)
    done, number = (entries[-1]["upto"], entries[-1]["number"] + 1) if entries else (-1, 0)
    upto = snapshot(spark, store).version
    if upto <= done:
        return done
    feed = changes(spark, store, schema, done, upto, key)
    signed = F.explode(F.array(
        F.struct(F.lit(-1).alias("sign"), F.col(f"old.{column}").alias("terms")),
        F.struct(F.lit(1).alias("sign"), F.col(f"new.{column}").alias("terms"))))
    terms = feed.select(signed.alias("side")).select("side.sign", F.explode("side.terms").alias(name))
    folder = uuid.uuid4().hex
    (terms.where(F.col(name).isNotNull()).groupBy(name).agg(F.sum("sign").alias("count")).where("count <> 0")
     .write.parquet(f"{path}/data/{folder}"))
    _append(spark, path, number, {"folder": folder, "upto": upto, "whole": False})
    return upto


def read_counts(spark: SparkSession, path: str, name: str, kind: str = "string") -> DataFrame:
    """The counts as of the last refresh: ``name``, count."""
    return _sum(spark, path, _entries(spark, path), name, kind)


def merge_counts(spark: SparkSession, path: str, name: str, kind: str = "string") -> None:
    """One table of counts in place of the appended ones; readers start from it."""
    entries = _entries(spark, path)
    if len(entries) < 2:
        return
    folder = uuid.uuid4().hex
    _sum(spark, path, entries, name, kind).write.parquet(f"{path}/data/{folder}")
    last = entries[-1]
    _append(spark, path, last["number"] + 1, {"folder": folder, "upto": last["upto"], "whole": True})
