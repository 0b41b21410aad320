"""Custom selection of one lookup row out of all that match."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lookfuse.operators.collect import CHUNK_ROWS


def takes_request(fn: Callable) -> bool:
    """Whether a selector has a second parameter, for the request."""
    try:
        parameters = inspect.signature(fn).parameters.values()
    except (TypeError, ValueError):
        return False
    positional = [
        p
        for p in parameters
        if p.kind in (p.POSITIONAL_ONLY, p.POSITIONAL_OR_KEYWORD) and p.default is p.empty
    ]
    return len(positional) >= 2


@dataclass(frozen=True)
class ColumnSelector:
    """``fn(rows[, request])`` over columns: an array of structs to one struct, NULL to decline.

    Stays inside the JVM: build it from ``F.reduce``, ``F.filter``, ``F.array_sort``, ``F.try_element_at``.
    """

    fn: Callable[..., Column]
    decomposable: bool = False
    chunk_rows: int = CHUNK_ROWS
    max_group_rows: int | None = None

    @property
    def with_request(self) -> bool:
        return takes_request(self.fn)

    def bind(self, schema: T.StructType) -> Callable[..., Column]:
        return self.fn

    def result_type(self, schema: T.StructType) -> T.StructType:
        return schema


@dataclass(frozen=True)
class PythonSelector:
    """``fn(rows[, request])`` as a Python function over a list of rows.

    ``rows_as`` gives the rows as dicts or as ``Row`` objects; the request is a ``Row``. A function that raises, or
    returns something that is no row, falls back to the first row; an empty dict declines; ``None`` does what
    ``none_means`` says.
    ``decomposable=True`` promises that the best of a group is the best of the bests of its parts (true for
    latest, largest, cheapest and the like); then groups of any size work. ``schema`` is the type of the returned
    row if it is not the type of the lookup rows.
    """

    fn: Callable[..., Any]
    decomposable: bool = False
    rows_as: str = "dict"
    none_means: str = "decline"
    schema: T.StructType | None = None
    chunk_rows: int = CHUNK_ROWS
    max_group_rows: int | None = None

    def __post_init__(self):
        if self.rows_as not in ("dict", "row"):
            raise ValueError("rows_as must be 'dict' or 'row'")
        if self.none_means not in ("decline", "first"):
            raise ValueError("none_means must be 'decline' or 'first'")
        if self.decomposable and self.schema is not None:
            raise ValueError("A decomposable selector returns rows of the type it is given")

    @property
    def with_request(self) -> bool:
        return takes_request(self.fn)

    def result_type(self, schema: T.StructType) -> T.StructType:
        return self.schema or schema

    def bind(self, schema: T.StructType) -> Callable[..., Column]:
        fn, as_dict, none_first = self.fn, self.rows_as == "dict", self.none_means == "first"
        result = self.result_type(schema)
        names = result.names

        def pick(rows: list[dict] | None, *request: dict) -> dict | None:
            if not rows:
                return None
            offered = rows if as_dict else [Row(**r) for r in rows]
            return outcome(lambda: fn(offered, *[Row(**r) for r in request]), offered[0], names, none_first)

        def pick_all(groups: pa.Array, *requests: pa.Array) -> pa.Array:
            columns = [c.to_pylist() for c in (groups, *requests)]
            return pa.array([pick(*args) for args in zip(*columns)], to_arrow_type(result))

        # Whole groups travel as Arrow lists; rows become dicts at once, without one pickle for each.
        return F.arrow_udf(pick_all, result)


@dataclass(frozen=True)
class StreamSelector:
    """``fn(rows[, request])`` as a Python function over an iterator of rows, in the stated ``order``.

    For choices that need a key's rows one after the other and can do so without holding them: running totals, the first
    change, the longest stretch. Rows and request are as for :class:`PythonSelector`, and so is what comes of raising, of an
    empty dict and of ``None``. A function may stop early. No group becomes a list, so its size is bounded by nothing but time.
    """

    fn: Callable[..., Any]
    order: Sequence[str] = ()
    rows_as: str = "dict"
    none_means: str = "decline"
    schema: T.StructType | None = None
    decomposable = False

    def __post_init__(self):
        if self.rows_as not in ("dict", "row"):
            raise ValueError("rows_as must be 'dict' or 'row'")
        if self.none_means not in ("decline", "first"):
            raise ValueError("none_means must be 'decline' or 'first'")

    @property
    def with_request(self) -> bool:
        return takes_request(self.fn)

    def result_type(self, schema: T.StructType) -> T.StructType:
        return self.schema or schema

    def picker(self, schema: T.StructType) -> Callable[..., dict | None]:
        """``pick(first row, iterator of all rows[, request])``."""
        fn, as_dict, none_first = self.fn, self.rows_as == "dict", self.none_means == "first"
        names = self.result_type(schema).names

        def pick(first: dict, rows: Iterator[dict], *request: dict) -> dict | None:
            offered = rows if as_dict else (Row(**r) for r in rows)
            return outcome(lambda: fn(offered, *[Row(**r) for r in request]), first, names, none_first)

        return pick


def outcome(choose: Callable[[], Any], first: Any, names: Sequence[str], none_first: bool) -> dict | None:
    """The row a selector chose, by name: the first row if it fails or returns something that is no row; None if it declines."""
    try:
        chosen = choose()
    except Exception:
        chosen = first
    if chosen is None:
        chosen = first if none_first else {}
    elif not isinstance(chosen, (Mapping, Row)):
        chosen = first
    values = chosen.asDict() if isinstance(chosen, Row) else chosen
    return {n: values.get(n) for n in names} if values else None
