"""Streaming jobs. Every query has a checkpoint folder of its own."""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence
from typing import TextIO

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from jobsignals import schemas
from jobsignals.operators.postings import drop_incomplete, extract, parse_postings
from jobsignals.streaming.store import POSITION, stream_id, upsert_batch


def _writer(df: DataFrame, checkpoint: str, once: bool):
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    # Without a trigger batches follow one another; with it the query takes what
    # there is, in batches the source may bound, and ends.
    return writer.trigger(availableNow=True) if once else writer


def append_stream(df: DataFrame, checkpoint: str, path: str | None = None, format: str = "json",
                  options: Mapping[str, str] | None = None, once: bool = False) -> StreamingQuery:
    """Append a stream to files, or to any sink whose connector is present."""
    writer = _writer(df, checkpoint, once).format(format).options(**(options or {}))
    return writer.start(path) if path else writer.start()


def echo_stream(df: DataFrame, checkpoint: str, rows: int = 20, once: bool = False,
                out: TextIO | None = None) -> StreamingQuery:
    """Print the first rows of each batch, cut to the column width. Spark's own
    console sink brings whole batches to the driver; this brings what it prints."""

    def show(batch: DataFrame, batch_id: int) -> None:
        target = out or sys.stdout
        print(f"Batch: {batch_id}", file=target)
        print(batch._show_string(rows, True), file=target)

    return _writer(df, checkpoint, once).foreachBatch(show).start()


def upsert_stream(df: DataFrame, checkpoint: str, path: str, key: str = "id",
                  newest: Sequence[str] = (), once: bool = False) -> StreamingQuery:
    """Write a stream to a keyed store. Its folders there carry the query's id."""
    write = upsert_batch(path, key, newest, lambda: stream_id(df.sparkSession, checkpoint))
    return _writer(df, checkpoint, once).foreachBatch(write).start()


def await_all(queries: Sequence[StreamingQuery]) -> None:
    """Wait until all queries have ended; when one fails, stop the others and raise."""
    try:
        while any(q.isActive for q in queries):
            for query in queries:
                query.awaitTermination(1)
        for query in queries:
            query.awaitTermination()  # raises what ended it
    except Exception:
        for query in queries:
            query.stop()
        raise


def land(messages: DataFrame, path: str, checkpoint: str, schema: StructType = schemas.POSTING,
         once: bool = False) -> StreamingQuery:
    """Parse messages and append them to JSON files."""
    return append_stream(parse_postings(messages, schema), checkpoint, path, once=once)


def land_and_echo(messages: DataFrame, path: str, checkpoint: str,
                  schema: StructType = schemas.POSTING, once: bool = False,
                  out: TextIO | None = None) -> list[StreamingQuery]:
    """Two independent queries on one parsed stream: files and printed rows."""
    parsed = parse_postings(messages, schema)
    return [
        append_stream(parsed, f"{checkpoint}/files", path, once=once),
        echo_stream(parsed, f"{checkpoint}/echo", once=once, out=out),
    ]


def extract_stream(messages: DataFrame, schema: StructType = schemas.POSTING_STREAM,
                   required: Sequence[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Extracted rows of the complete messages of a stream (or of a batch), with the
    columns ``keep`` of the messages."""
    complete = drop_incomplete(parse_postings(messages, schema, keep), required or schema.fieldNames())
    return extract(complete, keep=keep)


def positions(messages: DataFrame) -> list[str]:
    """The columns that place a message in its topic, if the source has all of them."""
    return list(POSITION) if set(POSITION) <= set(messages.columns) else []


def store_raw(messages: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Write the six main columns of the postings, as they came, to a keyed store."""
    keep = positions(messages)
    raw = parse_postings(messages, keep=keep).select(*schemas.POSTING_RAW_STORE.fieldNames(), *keep)
    return upsert_stream(raw, checkpoint, path, once=once)
