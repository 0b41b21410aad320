"""Bring picked rows back to all requests, matched or not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookfuse.constants import SALT
from lookfuse.functions.names import col
from lookfuse.operators.skew import Splitter, copy_to_salts, find_hot_keys, fits_broadcast, key_hash, salt_rows


def attach(
    requests: DataFrame,
    request_columns: Sequence[str],
    picked: DataFrame,
    picked_columns: Sequence[str],
    splitter: Splitter,
    null_safe: Sequence[str] = (),
    single_row: bool = False,
    entered: bool = False,
) -> DataFrame:
    """Left join with at most one picked row for each combination of ``picked_columns``.

    The first request column is NULL for requests that cannot match. If these are many, or a key is hot, their
    requests are spread over salts, unless the picked side is small enough to be broadcast. Without either, the
    picked side keeps the partitioning it has. With ``entered`` sides hold several entries for each row, more than Spark
    reckons, and neither is broadcast.
    """
    salted = splitter.enabled and not single_row and (entered or not fits_broadcast(picked))
    if salted:
        # xxhash64 skips NULLs, so requests that cannot match are told apart here.
        hashed = F.when(col(request_columns[0]).isNotNull(), key_hash(request_columns))
        hot = find_hot_keys(requests.select(hashed.alias("h")), splitter)
        salted = bool(hot) or hot.null_is_hot
    if salted:
        unmatched = col(request_columns[0]).isNull()
        mine = F.when(unmatched, F.lit(splitter.parts)).otherwise(hot.parts(request_columns))
        requests = salt_rows(requests, mine)
        picked = copy_to_salts(picked, hot.parts(picked_columns), SALT + "_p")
    if single_row:
        picked = F.broadcast(picked)  # one row by construction
    if entered:
        picked = picked.hint("merge")
    condition = F.lit(True)
    for mine, theirs in zip(request_columns, picked_columns):
        same = col(mine).eqNullSafe(col(theirs)) if mine in null_safe else col(mine) == col(theirs)
        condition = condition & same
    if salted:
        condition = condition & (col(SALT) == col(SALT + "_p"))
    return requests.join(picked, condition, "left")
