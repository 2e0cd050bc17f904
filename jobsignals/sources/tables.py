"""Posting files, document indexes and catalog tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from jobsignals import schemas


def read_postings(spark: SparkSession, path: str, schema: StructType = schemas.POSTING) -> DataFrame:
    """JSON lines under a path or glob, with a declared schema; bad lines give NULLs."""
    return spark.read.schema(schema).json(path)


_ADVISED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def write_json(df: DataFrame, path: str, files: int | None = None, file_mb: int | None = None) -> None:
    """Replace the JSON files under ``path``. The rows are computed in as many tasks as they
    come in; without further arguments each writes its own files. ``files`` deals the
    finished rows out to so many files, for small results; ``file_mb`` to as many as hold about
    that much each, as Spark measures it in the shuffle, large tasks' rows split and small
    ones' put together."""
    spark = df.sparkSession
    if files is not None:
        df.repartition(files).write.mode("overwrite").json(path)
    elif file_mb is None:
        df.write.mode("overwrite").json(path)
    else:
        before = spark.conf.get(_ADVISED, None)
        spark.conf.set(_ADVISED, f"{file_mb}m")
        try:
            df.hint("rebalance").write.mode("overwrite").json(path)
        finally:
            if before is None:
                spark.conf.unset(_ADVISED)
            else:
                spark.conf.set(_ADVISED, before)


def write_index(documents: DataFrame, format: str, options: Mapping[str, str],
                path: str | None = None) -> None:
    """Replace a document index with one document per row."""
    writer = documents.write.format(format).options(**options).mode("overwrite")
    writer.save(path) if path else writer.save()


def ensure_table(spark: SparkSession, name: str, schema: StructType = schemas.EXTRACTED,
                 format: str = "parquet", location: str | None = None) -> None:
    """Create a catalog table unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    quoted = ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))
    escaped = (location or "").replace("\\", "\\\\").replace("'", "\\'")
    place = f" LOCATION '{escaped}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted} ({columns}) USING {format}{place}")
