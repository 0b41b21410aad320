"""Streams give what the batch plan gives, over several micro-batches and after a restart."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from lookfuse import Flush, enrich, enrich_stream, read_sink, requests_from_files
from lookfuse.streaming.sink import FolderSink

ALL = {"availableNow": True}


@pytest.fixture
def tables(spark, tmp_path):
    requests = spark.range(60).select(
        "id", F.when(F.col("id") % 9 != 0, F.col("id") % 7).alias("k"), (F.col("id") % 20).alias("b")
    )
    path = str(tmp_path / "requests")
    requests.repartition(3).write.parquet(path)
    lookup = spark.range(40).select(
        (F.col("id") % 5).alias("k"), (F.col("id") % 25).alias("x"), F.col("id").alias("v")
    )
    return requests, path, lookup


CASES = {
    "keys": dict(join_key="k", select=["v desc"], match_count=True),
    "template_keys": dict(join_key="k", restriction="k = {k} AND x > 3", fields=["k"], select=["v"]),
    "bound": dict(join_key="k", restriction="x <= {b}", fields=["b"], select=["x desc"], null_keys="keep"),
    "two_sided": dict(
        join_key="k", restriction="x <= {b} AND x > {a}", select=["x desc"],
        condition_value_fn=lambda r: {"b": r.b, "a": r.b - 5},
    ),
    "residual": dict(join_key="k", restriction="x % 2 = {b} % 2", fields=["b"]),
    "pairs": dict(keys=["k"], mode="pairs", null_keys="keep"),
    "selector": dict(join_key="k", select=lambda found: F.get(found, F.size(found) - 1)),
    "composite": dict(keys={"k": "k", "b": "x"}),
    "dispatch": dict(join_key="k", restriction={1: "x > {b}", 2: "x < {b}"}, fields=["b"], template_id="k"),
}


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


# Without broadcasting only these take another way than for a small lookup.
LARGE = [(case, True) for case in ("keys", "bound", "two_sided", "composite")]


@pytest.mark.parametrize("case,large", [(case, False) for case in sorted(CASES)] + LARGE)
def test_stream_equals_batch(spark, tables, tmp_path, case, large):
    requests, path, lookup = tables
    sink = str(tmp_path / "sink")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if large:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stream = requests_from_files(spark, path, requests.schema, max_files_per_batch=1)
        query = enrich_stream(
            stream, lookup, sink=sink, checkpoint=str(tmp_path / "checkpoint"), trigger=ALL, **CASES[case]
        )
        query.awaitTermination()
        assert len(query.recentProgress) >= 3
        assert same(read_sink(spark, sink), enrich(requests, lookup, **CASES[case]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_restart_goes_on_where_it_stopped(spark, tables, tmp_path):
    requests, path, lookup = tables
    places = dict(sink=str(tmp_path / "sink"), checkpoint=str(tmp_path / "checkpoint"), trigger=ALL)
    for _ in range(2):
        stream = requests_from_files(spark, path, requests.schema)
        enrich_stream(stream, lookup, **places, **CASES["bound"]).awaitTermination()
        requests.limit(10).write.mode("append").parquet(path)
    want = enrich(requests.union(requests.limit(10)), lookup, **CASES["bound"])
    assert same(read_sink(spark, places["sink"]), want)


def rows_of(spark, path, ids, files):
    spark.createDataFrame([(i, i % 7, i % 20) for i in ids], "id long, k long, b long").repartition(files).write.mode("append").parquet(path)
    return spark.read.parquet(path).schema


def ids_in(spark, sink):
    return sorted(r.id for r in read_sink(spark, sink).collect())


def test_the_same_call_again_adds_nothing_and_loses_nothing(spark, tables, tmp_path):
    _, _, lookup = tables
    sink, first, other = (str(tmp_path / n) for n in ("sink", "first", "other"))
    schema = rows_of(spark, first, range(30), 3)
    rows_of(spark, other, range(100, 110), 1)

    def run(path, files=1, **places):
        stream = requests_from_files(spark, path, schema, flush=Flush(files=files))
        query = enrich_stream(stream, lookup, sink=sink, trigger=ALL, **places, **CASES["bound"])
        query.awaitTermination()
        return len([p for p in query.recentProgress if p.numInputRows])

    assert run(first) == 3 and ids_in(spark, sink) == list(range(30))
    # Other batch sizes, and another source, from the same place.
    assert run(first, files=2) == 0 and ids_in(spark, sink) == list(range(30))
    assert run(other) == 1 and ids_in(spark, sink) == [*range(30), *range(100, 110)]
    # A new checkpoint would number its batches from 0 again.
    with pytest.raises(ValueError, match="another checkpoint"):
        run(other, checkpoint=str(tmp_path / "new"))
    assert ids_in(spark, sink) == [*range(30), *range(100, 110)]
    run(other, checkpoint=str(tmp_path / "new"), join_sink=True)
    assert ids_in(spark, sink) == sorted([*range(30), *range(100, 110), *range(100, 110)])


@pytest.mark.parametrize("fails", ["rows", "commit", "after"])
def test_a_batch_that_fails_is_written_once(spark, tables, tmp_path, monkeypatch, fails):
    """Whatever step of a batch is the last before a crash, its rows are there once after a restart."""
    _, _, lookup = tables
    sink, path = str(tmp_path / "sink"), str(tmp_path / "thirty")
    schema = rows_of(spark, path, range(30), 3)
    write, commit, left = FolderSink.write, FolderSink.commit, [1]

    def crash(step):
        if fails == step and left and left.pop():
            raise RuntimeError(step)

    def broken_commit(self, batch, attempt):
        crash("rows")
        if batch == 1:
            crash("commit")
        commit(self, batch, attempt)

    def broken_write(self, rows, batch):
        write(self, rows, batch)
        if batch == 1:
            crash("after")

    monkeypatch.setattr(FolderSink, "commit", broken_commit)
    monkeypatch.setattr(FolderSink, "write", broken_write)
    for attempt in range(2):
        stream = requests_from_files(spark, path, schema, flush=Flush(files=1))
        query = enrich_stream(stream, lookup, sink=sink, trigger=ALL, **CASES["bound"])
        if attempt == 0:
            with pytest.raises(Exception, match=fails):
                query.awaitTermination()
        else:
            query.awaitTermination()
    assert ids_in(spark, sink) == list(range(30))


def test_flush_by_size_or_time(spark, tables, tmp_path):
    """One object sets both; batches are counted by a listener."""
    requests, path, lookup = tables
    seen = []

    class Listener(StreamingQueryListener):
        def onQueryStarted(self, event):
            pass

        def onQueryProgress(self, event):
            seen.append((event.progress.name, event.progress.numInputRows, event.progress.timestamp))

        def onQueryTerminated(self, event):
            pass

    listener = Listener()
    spark.streams.addListener(listener)
    try:
        # By size: three files go out as three batches without waiting for the time.
        flush = Flush(seconds=0, files=1)
        query = enrich_stream(
            requests_from_files(spark, path, requests.schema, flush=flush), lookup, sink=str(tmp_path / "size"), flush=flush, join_key="k"
        )
        query.processAllAvailable()
        query.stop()
        sizes = [p.numInputRows for p in query.recentProgress if p.numInputRows]
        assert len(sizes) == 3 and sum(sizes) == 60
        assert read_sink(spark, str(tmp_path / "size")).count() == requests.where("k is not null").count()
        # By time: what a steady source brings goes out every second.
        rate = spark.readStream.format("rate").option("rowsPerSecond", 20).load().selectExpr("value as id", "value % 5 as k")
        query = enrich_stream(rate, lookup, sink=str(tmp_path / "time"), flush=Flush(seconds=1), join_key="k")
        query.awaitTermination(12)
        query.stop()
        times = [p.timestamp for p in query.recentProgress if p.numInputRows]
        assert len(times) >= 2
        starts = [dt.datetime.fromisoformat(t.replace("Z", "+00:00")).timestamp() for t in times]
        assert all(b - a >= 0.9 for a, b in zip(starts, starts[1:]))
        assert len({r.id for r in read_sink(spark, str(tmp_path / "time")).collect()}) >= sum(n for _, n, _ in seen[-1:])
    finally:
        spark.streams.removeListener(listener)
    with pytest.raises(ValueError):
        Flush(files=1, bytes=1)
    with pytest.raises(ValueError):
        enrich_stream(rate, lookup, sink="console", flush=Flush(), trigger=ALL, join_key="k")


def test_lookup_read_again_for_each_batch(spark, tables, tmp_path):
    requests, path, lookup = tables
    calls, seen = [], []

    def fresh():
        calls.append(1)
        return lookup

    stream = requests_from_files(spark, path, requests.schema, max_files_per_batch=1)
    enrich_stream(
        stream, fresh, sink=lambda df, i: seen.append((i, df.count())), checkpoint=str(tmp_path / "c"), trigger=ALL,
        join_key="k",
    ).awaitTermination()
    assert len(seen) == 3 and len(calls) == 4
    assert sum(n for _, n in seen) == requests.where("k is not null").count()


def test_console(spark, tables, tmp_path, capfd):
    requests, path, lookup = tables
    for case in ("keys", "residual"):
        stream = requests_from_files(spark, path, requests.schema)
        enrich_stream(
            stream, lookup, sink="console", checkpoint=str(tmp_path / case), trigger=ALL, **CASES[case]
        ).awaitTermination()
    assert "__enrichment_status" in capfd.readouterr().out


def test_batch_requests_are_refused(spark, tables):
    requests, _, lookup = tables
    with pytest.raises(ValueError, match="not a stream"):
        enrich_stream(requests, lookup, sink="console", join_key="k")
