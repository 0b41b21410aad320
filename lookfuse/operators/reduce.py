"""Keep one lookup row for each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lookfuse.functions.names import col

_RANK = "__rn"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by ``order``.

    Spark plans a group limit before the shuffle, so a task sends at most one row for each key,
    however many rows a hot key has.
    """
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(col(_RANK) == 1).drop(_RANK)


def count_per_key(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*[col(k) for k in keys]).agg(F.count("*").alias(name))
