"""Streams of requests, run to the end of what is there."""

import uuid

from lookfuse import Flush, enrich_stream, read_sink, requests_from_files, scratch_folder, store_lookup
from lookfuse.catalog.registry import query
from lookfuse.catalog.shared import EVENTS_SQL, event_requests, missing_sql, status_sql, with_missing


BATCHES = 3


def _stream(t):
    """All events from several files, a file a micro-batch."""
    path = scratch_folder(t.spark, "stream-requests")
    t.events.repartition(BATCHES, "event_id").write.parquet(path)
    return event_requests(requests_from_files(t.spark, path, t.events.schema, flush=Flush(files=1)))


def _run(t, requests, lookup, **options):
    sink = scratch_folder(t.spark, "stream-result")
    query = enrich_stream(requests, lookup, sink=sink, trigger={"availableNow": True}, **options)
    query.awaitTermination()
    return read_sink(t.spark, sink)


@query(f"""
    SELECT event_id, user_id, c_name, {status_sql("c_custkey IS NOT NULL")}
    FROM (SELECT event_id, {missing_sql("user_id")} AS user_id FROM ({EVENTS_SQL})) LEFT JOIN customer ON c_custkey = user_id
    WHERE user_id IS NOT NULL
""")
def stream_enrich(t):
    return _run(
        t,
        _stream(t).select("event_id", with_missing("user_id")),
        t.customer,
        join_key="user_id",
        column_names=["c_custkey as user_id", "c_name"],
    )


@query(f"""
    WITH best AS (
        SELECT event_id, o_orderkey, row_number() OVER (PARTITION BY event_id ORDER BY o_orderdate DESC, o_orderkey) AS rn
        FROM ({EVENTS_SQL}) JOIN orders ON o_custkey = user_id AND o_orderdate <= cutoff)
    SELECT e.event_id, user_id, cutoff, o_orderkey, {status_sql("o_orderkey IS NOT NULL")}
    FROM ({EVENTS_SQL}) e LEFT JOIN best ON best.event_id = e.event_id AND rn = 1 WHERE user_id IS NOT NULL
""")
def stream_enrich_restricted(t):
    return _run(
        t,
        _stream(t).select("event_id", "user_id", "cutoff"),
        t.orders,
        join_key="user_id",
        restriction="o_custkey = {user_id} AND o_orderdate <= '{cutoff}'",
        fields=["user_id", "cutoff"],
        column_names=["o_custkey as user_id", "o_orderkey", "o_orderdate"],
        select=["o_orderdate desc", "o_orderkey"],
    ).drop("o_orderdate")


@query(f"""
    WITH best AS (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
    SELECT event_id, user_id, o_orderkey, {status_sql("o_orderkey IS NOT NULL")}
    FROM ({EVENTS_SQL}) LEFT JOIN best ON o_custkey = user_id AND rn = 1 WHERE user_id IS NOT NULL
""")
def stream_bucketed_lookup(t):
    """Micro-batches against a lookup that lies in buckets of the key."""
    place = scratch_folder(t.spark, "orders-by-customer")
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    orders = store_lookup(t.orders, f"orders_{uuid.uuid4().hex}", ["o_custkey"], buckets, path=place)
    return _run(
        t,
        _stream(t).select("event_id", "user_id"),
        orders,
        join_key="user_id",
        column_names=["o_custkey as user_id", "o_orderkey", "o_totalprice"],
        select=["o_totalprice desc", "o_orderkey"],
        pushdown_keys=0,
    ).drop("o_totalprice")
