"""Selectors over streams of a group's rows: the same picks as over lists, in bounded memory."""

import itertools
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lookfuse import PythonSelector, StreamSelector, enrich


def both(requests, lookup, fn, order, **options):
    """A selector over a stream and the same over a list, whose rows have to come in the same order."""
    streamed = enrich(requests, lookup, select=StreamSelector(fn, order=order), **options)
    listed = enrich(requests, lookup, select=PythonSelector(lambda rows, *r: fn(iter(rows), *r)) if fn.__code__.co_argcount == 1 else PythonSelector(lambda rows, r: fn(iter(rows), r)), **options)
    return [{tuple(str(v) for v in r) for r in df.collect()} for df in (streamed, listed)]


@pytest.mark.parametrize("split", [False, True])
def test_streams_pick_what_lists_pick(spark, no_broadcast, split):
    requests = spark.createDataFrame([(i, i % 6 if i % 7 else None, float(i % 4) if i % 9 else float("nan")) for i in range(60)], "id int, k bigint, b double").repartition(3)
    lookup = spark.createDataFrame([(i % 5, i * 7 % 40, i % 3 if i % 4 else None) for i in range(90)], "k bigint, v int, w int").repartition(4)
    fns = {
        "last": lambda rows: max(rows, key=lambda r: r["v"]),
        "third": lambda rows: next(itertools.islice(rows, 2, None), {}),
        "fails": lambda rows: next(rows)["none"],
        "nothing": lambda rows: None,
        "number": lambda rows: 5,
    }
    for fn in fns.values():
        a, b = both(requests, lookup, fn, [], join_key="k", column_names=["k", "v", "w"], match_count=True, split=split)
        assert a == b and len(a) > 40
    near = lambda rows, request: min(rows, key=lambda r: (abs(r["v"] - request["id"]), r["v"], r["w"] is None, r["w"] or 0))
    a, b = both(requests, lookup, near, [], join_key="k", column_names=["k", "v", "w"], match_count=True, split=split)
    assert a == b
    # A restriction, so that requests of a key have different rows; NaN is a value like others.
    a, b = both(requests, lookup, near, [], join_key="k", restriction="v > {b}", fields=["b"], column_names=["k", "v", "w"], match_count=True, split=split)
    assert a == b


def test_order_types_and_declining(spark):
    requests = spark.range(3).withColumnRenamed("id", "k")
    lookup = spark.sql("select 0L k, cast(1.5 as decimal(20,4)) d, timestamp'2024-01-01 01:02:03' t, array(1, null) a, struct(1 x, 'y' y) s, X'00ff' z union all select 0L, null, timestamp'2024-01-02 00:00:00', null, null, null")
    first = StreamSelector(lambda rows: next(rows), order=["t desc"])
    got = {r.k: r for r in enrich(requests, lookup, join_key="k", select=first).collect()}
    assert str(got[0].t) == "2024-01-02 00:00:00" and got[0].d is None and got[0]["__enrichment_status"] == "SUCCESS"
    assert got[1]["__enrichment_status"] == "NO_BQ_DATA"
    last = StreamSelector(lambda rows: list(rows)[-1], order=["t desc"], rows_as="row")
    (row,) = enrich(requests.where("k = 0"), lookup, join_key="k", select=last).drop("__enrichment_status").collect()
    assert row == lookup.where("d is not null").select("k", "d", "t", "a", "s", "z").first()
    declined = enrich(requests.where("k = 0"), lookup, join_key="k", select=StreamSelector(lambda rows: {})).first()
    assert declined["__enrichment_status"] == "BQ_SELECTION_FAILED" and declined.t is None
    none = enrich(requests.where("k = 0"), lookup, join_key="k", select=StreamSelector(lambda rows: None, order=["t"], none_means="first")).first()
    assert str(none.t) == "2024-01-01 01:02:03"
    total = StreamSelector(lambda rows: {"n": sum(1 for _ in rows)}, schema=T.StructType([T.StructField("n", T.LongType())]))
    assert {r.k: r.n for r in enrich(requests, lookup, join_key="k", select=total).collect()} == {0: 2, 1: None, 2: None}
    with pytest.raises(ValueError):
        StreamSelector(first, rows_as="list")
    with pytest.raises(ValueError):
        StreamSelector(first, none_means="x")


def test_a_group_larger_than_memory(spark):
    """A key with 400 MB of rows passes in a few; a list of them would not fit what the worker may grow by."""
    rows, width = 200_000, 2_000
    lookup = spark.range(rows).select(F.lit(1).cast("bigint").alias("k"), "id", F.rpad(F.col("id").cast("string"), width, "x").alias("text"))
    requests = spark.createDataFrame([(1,), (2,)], "k bigint")

    def resident():
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")

    def grown(found):
        start, most, n, last = resident(), 0, 0, -1
        for row in found:
            assert row["id"] == last + 1 and len(row["text"]) == width
            last, n = row["id"], n + 1
            if n % 1000 == 0:
                most = max(most, resident() - start)
        return {"n": n, "most": most}

    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("most", T.LongType())])
    got = {r.k: r for r in enrich(requests, lookup, join_key="k", select=StreamSelector(grown, order=["id"], schema=schema)).collect()}
    assert got[1].n == rows and got[1].most < 150_000_000 and got[2].n is None
