"""Grouping, counting and sharing among requests and matches."""

from pyspark.sql import functions as F

from lookfuse import enrich, group_rows, restrict_to_requests
from lookfuse.catalog.registry import query
from lookfuse.catalog.shared import EVENTS_SQL, event_requests, missing_sql, status_sql, with_missing
from lookfuse.operators.requests import distinct_probes as distinct


def _chunks(groups, key, item):
    """Each chunk's size and its items in order."""
    items = F.transform("rows", lambda r: r[item].cast("string"))
    return groups.select(key, "chunk", F.size("rows").cast("bigint").alias("n_rows"), F.array_join(items, " ").alias("items"))


def _chunks_sql(source: str, key: str, item: str, order: str, size: int) -> str:
    return f"""
        SELECT {key}, chunk, CAST(count(*) AS BIGINT) AS n_rows, string_agg(CAST({item} AS VARCHAR), ' ' ORDER BY rn) AS items
        FROM (SELECT *, CAST(floor((rn - 1) / {size}) AS BIGINT) AS chunk FROM (
            SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {source} WHERE {key} IS NOT NULL))
        GROUP BY {key}, chunk"""


@query(_chunks_sql(f"({EVENTS_SQL})", "user_id", "event_id", "event_id", 2))
def group_requests(t):
    return _chunks(group_rows(event_requests(t.events), ["user_id"], ["event_id"], chunk_rows=2), "user_id", "event_id")


@query(_chunks_sql("(SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer))", "o_custkey", "o_orderkey", "o_orderdate, o_orderkey", 8))
def collect_matches(t):
    asked = restrict_to_requests(t.orders, t.customer, {"c_custkey": "o_custkey"})
    groups = group_rows(asked, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderdate"], 8)
    return _chunks(groups, "o_custkey", "o_orderkey")


@query(f"""
    WITH customer AS (SELECT {missing_sql("c_custkey")} AS c_custkey FROM main.customer),
    counts AS (SELECT o_custkey, count(*) AS n, min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey)
    SELECT c_custkey, o_orderkey, CAST(coalesce(n, 0) AS BIGINT) AS "__match_count", {status_sql("n IS NOT NULL")}
    FROM customer LEFT JOIN counts ON o_custkey = c_custkey
""")
def match_count(t):
    return enrich(
        t.customer.select(with_missing("c_custkey")),
        t.orders,
        join_key="c_custkey",
        column_names=["o_orderkey", "o_custkey as c_custkey"],
        match_count=True,
    )


@query(f"""
    WITH e AS ({EVENTS_SQL}),
    reps AS (SELECT user_id, cutoff FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM e WHERE user_id IS NOT NULL) WHERE rn = 1),
    best AS (
        SELECT user_id, o_orderkey, row_number() OVER (PARTITION BY user_id ORDER BY o_orderdate DESC, o_orderkey) AS rn
        FROM reps JOIN orders ON o_custkey = user_id AND o_orderdate <= cutoff)
    SELECT event_id, e.user_id, o_orderkey, {status_sql("o_orderkey IS NOT NULL")}
    FROM e LEFT JOIN best ON best.user_id = e.user_id AND rn = 1 WHERE e.user_id IS NOT NULL
""")
def representative_per_key(t):
    return enrich(
        event_requests(t.events).select("event_id", "user_id", "cutoff"),
        t.orders,
        join_key="user_id",
        restriction="o_custkey = {user_id} AND o_orderdate <= '{cutoff}'",
        fields=["user_id"],
        additional_condition_fields=["cutoff"],
        column_names=["o_custkey as user_id", "o_orderkey", "o_orderdate"],
        select=["o_orderdate desc", "o_orderkey"],
        representative=["event_id desc"],
    ).drop("cutoff", "o_orderdate")


@query(f"SELECT DISTINCT user_id, wanted_status FROM ({EVENTS_SQL})")
def distinct_probes(t):
    return distinct(event_requests(t.events), ["user_id", "wanted_status"])


@query(f"""
    WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS nth FROM ({EVENTS_SQL})),
    best AS (SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey)
    SELECT event_id, user_id, value, o_orderkey, {status_sql("o_orderkey IS NOT NULL")}
    FROM e LEFT JOIN best ON o_custkey = user_id AND nth = 1 WHERE user_id IS NOT NULL
""")
def duplicates_first(t):
    return enrich(
        event_requests(t.events).select("event_id", "user_id", "value"),
        t.orders,
        join_key="user_id",
        column_names=["o_orderkey", "o_custkey as user_id"],
        duplicates="first",
        request_order=["value desc", "event_id"],
    )
