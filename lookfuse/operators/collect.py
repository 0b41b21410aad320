"""Groups as arrays, for callers and selectors that want to see all rows of a key.

Groups are cut into chunks of their own order, so what comes out depends on the rows and not on where they lie; each
row is in exactly one chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lookfuse.constants import CHOSEN, COUNT, HIT
from lookfuse.functions.names import col
from lookfuse.functions.ordering import parse_order
from lookfuse.functions.types import is_orderable

CHUNK_ROWS = 1000

_PARTITION = "__partition"
_CHUNK = "__chunk"
_RANK = "__rank"
_ROWS = "__rows"


def group_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Sequence[str],
    columns: Sequence[str] | None = None,
    chunk_rows: int | None = CHUNK_ROWS,
) -> DataFrame:
    """The rows of each key, in the given order, as ``rows`` arrays of ``chunk_rows``, numbered from 0 by ``chunk``.

    Only the last chunk of a key is shorter; with ``chunk_rows=None`` each key has one array, whatever its size. The
    result depends on the rows alone if ``order`` leaves no ties. A key column that is NULL forms no group.
    """
    sort = [t.sort() for t in parse_order(order)]
    names = list(columns or [c for c in df.columns if c not in keys])
    present = F.lit(True)
    for key in keys:
        present = present & col(key).isNotNull()
    numbered = _number(df.where(present), keys, sort, chunk_rows)
    gathered = _gather(numbered, [*keys, _CHUNK], F.struct(*[col(n).alias(n) for n in names]))
    return gathered.select(*[col(k) for k in keys], col(_CHUNK).alias("chunk"), col(_ROWS).alias("rows"))


def select_from_groups(
    df: DataFrame,
    keys: Sequence[str],
    sort: Sequence[Column],
    row: Column,
    choose: Callable[[Column], Column],
    decomposable: bool,
    hot: Column | None,
    chunk_rows: int = CHUNK_ROWS,
    max_group_rows: int | None = None,
) -> DataFrame:
    """Apply ``choose`` (array of rows to one row or NULL) to each group: ``keys``, HIT, CHOSEN, COUNT.

    A decomposable selector (best of a group = best of the bests of its parts) runs over chunks, then over the
    chunks' choices. Groups that are ``hot`` are cut by ranges of key and order first, so that a hot key is spread
    over tasks, each has an unbroken stretch of it, and the stretches' choices stand in the group's own order: the
    answer is that of the unsplit group. Any other selector needs its group whole; with ``max_group_rows`` a larger
    group fails the job before it is gathered, rather than being cut.
    """
    partition = F.lit(-1)
    if hot is not None and decomposable:
        df = df.repartitionByRange(*[col(k) for k in keys], *sort)
        partition = F.when(hot, F.spark_partition_id()).otherwise(F.lit(-1))
    df = df.withColumn(_PARTITION, partition).withColumn(COUNT, F.lit(1).cast("bigint"))
    if not decomposable:
        return _choose(_whole_groups(df, keys, sort, max_group_rows), keys, row, choose)
    if hot is not None:
        local = [*keys, _PARTITION]
        chunks = _choose(_number(df, local, sort, chunk_rows), [*local, _CHUNK], row, choose)
        partitions = _choose_again(chunks, local, _CHUNK, choose)
        numbered = _number(partitions, keys, [col(_PARTITION)], chunk_rows)
        chunks = _choose_again(numbered, [*keys, _CHUNK], _RANK, choose)
    else:
        chunks = _choose(_number(df, keys, sort, chunk_rows), [*keys, _CHUNK], row, choose)
    return _choose_again(chunks, keys, _CHUNK, choose)


def _number(df: DataFrame, group: Sequence[str], sort: Sequence[Column], chunk_rows: int | None) -> DataFrame:
    window = Window.partitionBy(*[col(g) for g in group]).orderBy(*sort)
    chunk = F.lit(0).cast("bigint") if chunk_rows is None else F.floor((col(_RANK) - 1) / chunk_rows)
    return df.withColumn(_RANK, F.row_number().over(window)).withColumn(_CHUNK, chunk)


def _whole_groups(df: DataFrame, keys: Sequence[str], sort: Sequence[Column], limit: int | None) -> DataFrame:
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*sort)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    if limit is None:
        return ranked
    message = (
        f"A group has more than {limit} matching rows. Use an order, a selector declared decomposable, "
        "or a larger max_group_rows."
    )
    # One rank beyond the limit is kept as evidence.
    too_many = F.raise_error(F.lit(message)).cast("int")
    return ranked.where(col(_RANK) <= limit + 1).withColumn(_RANK, F.when(col(_RANK) > limit, too_many).otherwise(col(_RANK)))


def _gather(df: DataFrame, group: Sequence[str], row: Column, place: str = _RANK) -> DataFrame:
    element = F.struct(col(place).alias("place"), row.alias("row"))
    gathered = F.array_agg(element)
    # Places are unique in a group, so no comparison reaches the row itself.
    if is_orderable(df.select(element).schema[0].dataType):
        ordered = F.array_sort(gathered)
    else:
        ordered = F.array_sort(gathered, lambda a, b: (a["place"] - b["place"]).cast("int"))
    counts = [F.sum(col(COUNT)).alias(COUNT)] if COUNT in df.columns else []
    return df.groupBy(*[col(g) for g in group]).agg(
        F.transform(ordered, lambda e: e["row"]).alias(_ROWS), *counts
    )


def _choose(df: DataFrame, group: Sequence[str], row: Column, choose: Callable[[Column], Column]) -> DataFrame:
    return _gather(df, group, row).select(
        *[col(g) for g in group], F.lit(True).alias(HIT), choose(col(_ROWS)).alias(CHOSEN), col(COUNT)
    )


def _choose_again(
    df: DataFrame, group: Sequence[str], place: str, choose: Callable[[Column], Column]
) -> DataFrame:
    """Choose among earlier choices. Declined parts offer none, and a lone choice stands."""
    offered = _gather(df, group, col(CHOSEN), place).withColumn(
        _ROWS, F.filter(col(_ROWS), lambda r: r.isNotNull())
    )
    contested = F.when(F.size(col(_ROWS)) > 1, col(_ROWS))
    return offered.select(
        *[col(g) for g in group],
        F.lit(True).alias(HIT),
        F.when(F.size(col(_ROWS)) > 1, choose(contested)).otherwise(F.get(col(_ROWS), 0)).alias(CHOSEN),
        col(COUNT),
    )
