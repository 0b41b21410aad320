"""Hot keys: how large an input is, which keys are hot, and how their rows are split.

Splitting is only planned for inputs above ``spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes``
(256 MB unless set): below that, one task can hold all rows, whatever their keys. Above it, two kinds of small
facts are read when the plan is built, both of bounded size: hashes and counts of the hot keys (those with more
than one part's share of the rows, so at most ``MAX_PARTS`` of them) and, for range lookups, cut points of the
hot rows (at most ``MAX_PARTS``). A key gets as many parts as its share calls for.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lookfuse.constants import SALT
from lookfuse.functions.names import col
from lookfuse.functions.ordering import as_number
from lookfuse.functions.types import is_orderable

MAX_PARTS = 16384
MIN_PARTS = 8
#: Pairs that a cell of a hot key's grid tests, and how often its rows are repeated for that at most, on average.
CELL_PAIRS = 10_000_000
MAX_COPIES = 32
_TRACKED_KEYS = 100_000  # the sketch's error, 3.5 / 131072 of the rows, is then below one part

_UNKNOWN_SIZE = 1 << 60
_FEW_ROWS = 10_000
_UNITS = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def _bytes_setting(spark: SparkSession, key: str) -> int:
    text = str(spark.conf.get(key)).strip().lower()
    digits = text.rstrip("bkmgt")
    unit = text[len(digits) :].rstrip("b") or "b"
    return int(float(digits) * _UNITS[unit])


def plan_bytes(df: DataFrame) -> int | None:
    """Spark's own size estimate; None where there is none, as for data that come from an RDD."""
    try:
        size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except AttributeError:
        return None
    return size if size < _UNKNOWN_SIZE else None


def _small_or_unknown(df: DataFrame) -> int | None:
    """The estimate, or 0 for an input without one that turns out to have few rows."""
    size = plan_bytes(df)
    if size is None and df.select(F.lit(1)).limit(_FEW_ROWS + 1).count() <= _FEW_ROWS:
        return 0
    return size


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark itself would broadcast this side."""
    size = plan_bytes(df)
    return size is not None and size <= _bytes_setting(df.sparkSession, "spark.sql.autoBroadcastJoinThreshold")


def too_large_to_broadcast(df: DataFrame) -> bool:
    """Whether the side is known to be above what Spark would broadcast."""
    return plan_bytes(df) is not None and not fits_broadcast(df)


@dataclass(frozen=True)
class Splitter:
    """Whether, and into how many parts, a hot group is split."""

    enabled: bool
    parts: int = 1

    @classmethod
    def plan(cls, split: bool | str, *inputs: DataFrame, one_group: bool = False) -> "Splitter":
        """``one_group``: all rows have the same key, so that without splitting there would be one task."""
        if split is False or any(df.isStreaming for df in inputs):
            return cls(False)  # a micro-batch is bounded by the rate options of its source
        if split not in (True, "auto"):
            raise ValueError("split must be 'auto', True or False")
        spark = inputs[0].sparkSession
        threshold = _bytes_setting(spark, "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
        threshold = threshold // 16 if one_group else threshold
        sizes = [(_small_or_unknown if split == "auto" else plan_bytes)(df) for df in inputs]
        known = sum(size for size in sizes if size is not None)
        if split == "auto" and None not in sizes and known <= threshold:
            return cls(False)
        parts = -(-known // max(threshold, 1))
        if None in sizes:
            parts += int(spark.conf.get("spark.sql.shuffle.partitions"))
        return cls(True, max(MIN_PARTS, min(MAX_PARTS, parts)))


def _hash_sql(keys: Sequence[str]) -> str:
    names = [k.replace("`", "``") for k in keys]
    return "xxhash64(" + ", ".join(f"`{n}`" for n in names) + ")"


def key_hash(keys: Sequence[str]) -> Column:
    return F.expr(_hash_sql(keys))


@dataclass(frozen=True)
class HotKeys:
    """Hashes of hot keys, grouped by the number of parts (a power of two) each is split into."""

    classes: tuple[tuple[int, tuple[int, ...]], ...] = ()
    null_is_hot: bool = False

    def __bool__(self) -> bool:
        return bool(self.classes)

    # Lists of thousands of hashes are parsed faster than made one by one.

    def has(self, keys: Sequence[str]) -> Column:
        hashes = [h for _, group in self.classes for h in group]
        return F.expr(_in_sql(keys, hashes)) if hashes else F.lit(False)

    def parts(self, keys: Sequence[str]) -> Column:
        """Into how many parts the key's rows go; 1 for a key that is not hot."""
        if not self.classes:
            return F.lit(1)
        cases = " ".join(f"WHEN {_in_sql(keys, hashes)} THEN {parts}" for parts, hashes in self.classes)
        return F.expr(f"CASE {cases} ELSE 1 END")


def _in_sql(keys: Sequence[str], hashes: Sequence[int]) -> str:
    return f"{_hash_sql(keys)} IN ({', '.join(f'{h}L' for h in hashes)})"


def _from_parts(parts_of: dict[int, float], null_is_hot: bool = False) -> HotKeys:
    classes: dict[int, list[int]] = {}
    for item, parts in parts_of.items():
        if parts > 1:
            classes.setdefault(1 << math.ceil(math.log2(parts)), []).append(item)
    return HotKeys(tuple((p, tuple(h)) for p, h in sorted(classes.items(), reverse=True)), null_is_hot)


def _frequent(hashes: DataFrame) -> tuple[dict[int, int], int, int]:
    """Counts of the most frequent values of a one-column DataFrame, the number of its rows, and of its NULLs.

    A frequent-items sketch finds them in one pass with map-side merging. Its counts are estimates; they decide
    how evenly the work is spread, not what comes out.
    """
    (name,) = hashes.columns
    found = hashes.agg(
        F.expr(f"approx_top_k(`{name}`, {MAX_PARTS}, {_TRACKED_KEYS})").alias("top"),
        F.count("*").alias("n"),
        F.count(F.when(col(name).isNull(), 1)).alias("nulls"),
    ).first()
    counts = {e["item"]: e["count"] for e in found["top"] or [] if e["item"] is not None}
    return counts, found["n"], found["nulls"]


def find_hot_keys(hashes: DataFrame, splitter: Splitter) -> HotKeys:
    """Keys with more than one part's share of the rows; each gets twice its share of the parts."""
    counts, total, nulls = _frequent(hashes)
    shares = {h: n * splitter.parts / total for h, n in counts.items()}
    return _from_parts({h: 2 * s for h, s in shares.items() if s > 1}, nulls * splitter.parts > total)


def find_hot_grid(left: DataFrame, right: DataFrame, splitter: Splitter, split_left: bool) -> tuple[HotKeys, HotKeys]:
    """Parts of the left and of the right side of keys whose pairs are too many for a task, for joins that test them all.

    A key gets cells by its pairs, ``CELL_PAIRS`` to a cell, and by its rows, where they are more than a task's share. Rows of one
    side are repeated for each part of the other, so parts are in proportion to the sides' sizes, which keeps the
    repeated rows fewest for a number of cells; more than ``MAX_COPIES`` of each row on average are never made.
    """
    (mine, my_total, _), (theirs, their_total, _) = _frequent(left), _frequent(right)
    floor = (my_total + their_total) / splitter.parts
    rows, columns = {}, {}
    for item in {*mine, *theirs}:
        a, b = max(mine.get(item, 0), 1), max(theirs.get(item, 0), 1)
        cells = max(a * b / CELL_PAIRS, 2 * (a + b) / floor if a + b > floor else 1)
        if cells <= 1:
            continue
        most = MAX_COPIES * (a + b)
        cells = min(cells, MAX_PARTS, most * most / (4 * a * b) if split_left else max((most - b) / a, 1))
        rows[item] = min(max(math.sqrt(cells * a / b), 1), cells) if split_left else 1
        columns[item] = cells / rows[item]
    return _from_parts(rows), _from_parts(columns)


def spread(df: DataFrame, parts: Column) -> Column:
    """A part number for each row, from its content and its input partition: the same in a repeated task."""
    hashable = [col(f.name) for f in df.schema.fields if is_orderable(f.dataType)]
    return F.pmod(F.xxhash64(*hashable) + F.spark_partition_id(), parts).cast("int")


def salt_rows(df: DataFrame, parts: Column, name: str = SALT) -> DataFrame:
    """Spread the rows of a key over its parts; a key with one part gets salt 0."""
    return df.withColumn(name, F.when(parts > 1, spread(df, parts)).otherwise(F.lit(0)))


def copy_to_salts(df: DataFrame, parts: Column, name: str = SALT) -> DataFrame:
    """Repeat each row once for each part of its key on the other side."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), parts - 1)))


def common_prefix(values: DataFrame) -> int:
    """How many bytes all strings of a one-column DataFrame begin with; 0 for other types."""
    (field,) = values.schema.fields
    if not isinstance(field.dataType, T.StringType):
        return 0
    ends = values.agg(F.min(col(field.name)).alias("a"), F.max(col(field.name)).alias("b")).first()
    a, b, skip = (ends["a"] or "").encode(), (ends["b"] or "").encode(), 0
    while skip < min(len(a), len(b)) and a[skip] == b[skip]:
        skip += 1
    return skip


def range_cuts(values: DataFrame, parts: int) -> tuple[int, list[float]]:
    """Cut points that divide a one-column DataFrame evenly, for :func:`range_part`.

    Strings are cut on the six bytes that follow the prefix common to all of them.
    """
    (field,) = values.schema.fields
    skip = common_prefix(values)
    shares = literal_numbers(i / parts for i in range(1, parts))
    number = range_number(col(field.name), field.dataType, skip)
    cuts = values.agg(F.percentile_approx(number, shares, F.lit(4 * parts)).alias("cuts")).first()["cuts"]
    return skip, sorted({c for c in cuts or [] if c == c})


def range_part(value: Column, dtype: T.DataType, cuts: tuple[int, list[float]]) -> Column:
    """How many cut points lie below the value: a binary search over a literal array."""
    skip, points = cuts
    if not points:
        return F.lit(0)
    table = literal_numbers(points)
    number = range_number(value, dtype, skip)
    steps = []
    step = 1 << (len(points).bit_length() - 1)
    while step:
        steps.append(step)
        step >>= 1
    found = F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda low, s: F.when(
            (low + s <= F.lit(len(points))) & (F.get(table, low + s - 1) < number), low + s
        ).otherwise(low),
    )
    return F.when(number.isNull(), F.lit(0)).otherwise(found)


def literal_numbers(values) -> Column:
    """A literal array, as one string that is folded once: thousands of literals would be analysed again with every step of a plan."""
    text = ",".join(repr(float(v)) for v in values)
    return F.expr(f"cast(split('{text}', ',') as array<double>)" if text else "cast(array() as array<double>)")


def range_number(value: Column, dtype: T.DataType, skip: int) -> Column:
    if isinstance(dtype, T.StringType):
        digits = F.rpad(F.substring(F.hex(value), 2 * skip + 1, 12), 12, "0")
        return F.conv(digits, 16, 10).cast("double")
    return as_number(value, dtype).cast("double")
