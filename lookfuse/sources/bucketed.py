"""Lookups laid out by key, so that batches join them without moving them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from lookfuse.functions.names import quoted


def store_lookup(lookup: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Write a lookup as a table in ``buckets`` buckets by its keys, sorted by them, and give it back.

    Every enrichment by these keys reads a bucket a task and shuffles only the requests, stream batches among them; ``buckets``
    should be at least ``spark.sql.shuffle.partitions``, else Spark shuffles the lookup to have more tasks. ``path``: where the
    files go if not to the warehouse; a later session finds them by :func:`open_lookup`.
    """
    writer = lookup.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return lookup.sparkSession.table(table)


def open_lookup(spark: SparkSession, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """The lookup that :func:`store_lookup` wrote to ``path``, under a name in this session's catalog."""
    schema = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    by = ", ".join(quoted(k) for k in keys)
    where = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{where}'")
    return spark.table(table)
