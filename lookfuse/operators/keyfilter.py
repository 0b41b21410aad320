"""Lookup rows that can have no partner, dropped at the scan by a Bloom filter over all key columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookfuse.functions.names import col

#: Bits for each key, and the most the filter may have (8 MB).
KEY_BITS = 16
MAX_BITS = 1 << 26
_HASHES = 2


def _places(keys: Sequence[str], bits: int) -> Column:
    hashes = [F.xxhash64(F.lit(i), *[col(k) for k in keys]) for i in range(_HASHES)]
    return F.array(*[h.bitwiseAND(F.lit(bits - 1).cast("bigint")) for h in hashes])


def filter_by_keys(lookup: DataFrame, lookup_keys: Sequence[str], asked: DataFrame, asked_keys: Sequence[str]) -> DataFrame:
    """Lookup rows whose key may be among the asked ones; none that is among them is dropped.

    The filter is one row of at most ``MAX_BITS`` bits, made once by a scalar subquery, whatever the number and types of the
    keys; with more keys than it has room for it lets more rows through. Key columns of both sides have equal types.
    """
    spark = lookup.sparkSession
    number = asked.agg(F.approx_count_distinct(F.xxhash64(*[col(k) for k in asked_keys]))).first()[0]
    bits = min(MAX_BITS, max(1 << 12, 1 << (max(number, 1) * KEY_BITS - 1).bit_length()))
    place = F.explode(_places(asked_keys, bits)).alias("place")
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place").bitwiseAND(63).cast("int"))
    words = asked.select(place).groupBy(F.shiftright("place", 6).alias("id")).agg(F.bit_or(one).alias("word"))
    whole = spark.range(bits >> 6).join(words, "id", "left").select(F.struct("id", F.coalesce("word", F.lit(0).cast("bigint")).alias("word")).alias("at"))
    table = whole.agg(F.sort_array(F.collect_list("at")).getField("word").alias("words")).scalar()

    def has(at: Column) -> Column:
        word = F.get(table, F.shiftright(at, 6).cast("int"))
        return F.call_function("shiftright", word, at.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1

    places = _places(lookup_keys, bits)
    tests = [has(F.get(places, i)) for i in range(_HASHES)]
    return lookup.where(tests[0] & tests[1])
