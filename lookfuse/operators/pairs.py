"""Lookups whose restriction needs each pair tested: join on the keys, reduce at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookfuse.constants import SALT
from lookfuse.functions.names import col
from lookfuse.operators.ranges import Range, enter_ranges
from lookfuse.operators.skew import Splitter, copy_to_salts, find_hot_grid, key_hash, salt_rows

_PROBE_SALT = SALT + "_probe"


def matching_pairs(
    probes: DataFrame,
    probe_keys: Sequence[str],
    lookup: DataFrame,
    lookup_keys: Sequence[str],
    residual: Column | None,
    splitter: Splitter,
    how: str = "inner",
    ranges: tuple[Range, Range] | None = None,
    raw_probes: DataFrame | None = None,
    entered: bool = False,
) -> tuple[DataFrame, list[str]]:
    """Pairs (``how="inner"``) or lookup rows with any partner (``how="left_semi"``) with equal keys that pass the
    residual test, and the names of the salt columns they carry.

    A hot key's rows form a grid: parts of its probes by parts of its lookup rows, one task for each cell. Its
    tests then run in many tasks, and a pick is made first within a part of the lookup, then over all. For a
    semi-join only the probes are repeated, so that no lookup row comes out twice.

    ``ranges`` of the probes and of the lookup have to meet wherever the residual test holds; then only rows whose
    ranges are near each other are tested. They don't serve a semi-join, which would find a lookup row in several places.
    ``raw_probes`` are rows with the probes' columns to take statistics from. ``entered`` says that a side has several entries
    for each row already. Spark reckons such a side as if it had one, so it is never left to be broadcast.
    """
    if ranges is not None:
        probes, mine, lookup, theirs, meet = enter_ranges(probes, ranges[0], lookup, ranges[1], raw_probes)
        probe_keys, lookup_keys = [*probe_keys, *mine], [*lookup_keys, *theirs]
        residual = meet if residual is None else meet & residual
    salts: list[str] = []
    condition = F.lit(True)
    for mine, theirs in zip(probe_keys, lookup_keys):
        condition = condition & (col(mine) == col(theirs))
    if splitter.enabled:
        probe_parts, lookup_parts = find_hot_grid(
            probes.select(key_hash(probe_keys).alias("h")),
            lookup.select(key_hash(lookup_keys).alias("h")),
            splitter,
            how == "inner",
        )
        probes = salt_rows(probes, probe_parts.parts(probe_keys), _PROBE_SALT)
        probes = copy_to_salts(probes, lookup_parts.parts(probe_keys), f"{SALT}_probe_at")
        lookup = salt_rows(lookup, lookup_parts.parts(lookup_keys))
        lookup = copy_to_salts(lookup, probe_parts.parts(lookup_keys), f"{SALT}_at")
        condition = condition & (col(SALT) == col(f"{SALT}_probe_at")) & (col(f"{SALT}_at") == col(_PROBE_SALT))
        salts = [SALT]
    if residual is not None:
        condition = condition & residual
    if ranges is not None or entered:
        probes = probes.hint("merge")
    return lookup.join(probes, condition, how), salts
