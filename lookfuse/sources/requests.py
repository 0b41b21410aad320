"""Requests given as literals, and as file streams."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Flush:
    """When a micro-batch of requests goes out: with so many files or bytes of them, or after so many seconds.

    The same object opens the source (:func:`requests_from_files`) and starts the stream (``enrich_stream(flush=...)``). A
    batch that reaches its size is followed by the next at once if that one is due; seconds are counted from start to start.
    """

    seconds: float = 5
    files: int | None = None
    bytes: int | None = None

    def __post_init__(self):
        if self.seconds < 0 or any(n is not None and n < 1 for n in (self.files, self.bytes)):
            raise ValueError("Flush needs seconds from 0, and files and bytes from 1")
        if self.files is not None and self.bytes is not None:
            raise ValueError("A file source takes a limit of files or of bytes, not both")

    def trigger(self) -> dict:
        return {"processingTime": f"{int(self.seconds * 1000)} milliseconds"}

    def source_options(self) -> dict[str, int]:
        limits = {"maxFilesPerTrigger": self.files, "maxBytesPerTrigger": self.bytes}
        return {name: limit for name, limit in limits.items() if limit is not None}


def requests_from_rows(spark: SparkSession, rows: Iterable[Any], schema: T.StructType | str) -> DataFrame:
    """A small literal collection of requests: dicts, tuples or rows."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = schema.names
    values = [tuple(r.get(n) for n in names) if isinstance(r, dict) else tuple(r) for r in rows]
    return spark.createDataFrame(values, schema)


def requests_from_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    format: str = "parquet",
    max_files_per_batch: int | None = None,
    flush: Flush | None = None,
    **options: str,
) -> DataFrame:
    """A stream of requests from a folder or a single file; ``max_files_per_batch``, or ``flush``, bounds a micro-batch."""
    reader = spark.readStream.format(format).schema(schema).options(**options)
    if max_files_per_batch is not None:
        flush = Flush(files=max_files_per_batch)
    if flush is not None:
        reader = reader.options(**flush.source_options())
    # A file source takes a single file only by way of a pattern; this one matches just the path itself.
    path = path.rstrip("/")
    return reader.load(f"{path[:-1]}[{path[-1]}]" if path[-1].isalnum() else path)
