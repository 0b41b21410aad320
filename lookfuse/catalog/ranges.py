"""Two-sided ranges: around a request's value, around a lookup row's, and as what any request asks for."""

from pyspark.sql import functions as F

from lookfuse import enrich
from lookfuse.catalog.registry import query
from lookfuse.catalog.shared import EVENTS_SQL, event_requests, status_sql


@query(f"""
    WITH pairs AS (
        SELECT event_id, o_orderkey, o_totalprice, count(*) OVER (PARTITION BY event_id) AS n,
               row_number() OVER (PARTITION BY event_id ORDER BY o_totalprice DESC, o_orderkey) AS rn
        FROM ({EVENTS_SQL}) JOIN orders
          ON o_custkey = user_id AND o_orderdate BETWEEN cutoff - to_days(400) AND cutoff)
    SELECT e.event_id, user_id, cutoff, o_orderkey, o_totalprice, coalesce(n, 0) AS "__match_count",
           {status_sql("o_orderkey IS NOT NULL")}
    FROM ({EVENTS_SQL}) e LEFT JOIN pairs ON pairs.event_id = e.event_id AND rn = 1 WHERE user_id IS NOT NULL
""")
def range_keyed(t):
    """The dearest order of the user in the 400 days before."""
    return enrich(
        event_requests(t.events).select("event_id", "user_id", "cutoff"),
        t.orders,
        join_key="user_id",
        restriction="o_custkey = {user} AND o_orderdate <= '{until}' AND o_orderdate >= '{after}'",
        condition_value_fn=lambda row: {
            "user": row.user_id,
            "until": row.cutoff,
            "after": row.cutoff - F.expr("interval 400 days"),
        },
        column_names=["o_custkey as user_id", "o_orderkey", "o_totalprice"],
        select=["o_totalprice desc", "o_orderkey"],
        match_count=True,
    )


@query(f"""
    WITH pairs AS (
        SELECT event_id, p_partkey, p_size, count(*) OVER (PARTITION BY event_id) AS n,
               row_number() OVER (PARTITION BY event_id ORDER BY p_size DESC, p_partkey) AS rn
        FROM events JOIN part ON p_retailprice >= value * 3 AND p_retailprice < value * 3 + 5)
    SELECT e.event_id, e.value * 3 AS price, p_partkey, p_size, coalesce(n, 0) AS "__match_count",
           {status_sql("p_partkey IS NOT NULL")}
    FROM events e LEFT JOIN pairs ON pairs.event_id = e.event_id AND rn = 1
""")
def range_keyless(t):
    """The largest part of about a price."""
    return enrich(
        t.events.select("event_id", (F.col("value") * 3).alias("price")),
        t.part,
        restriction="p_retailprice >= {low} AND p_retailprice < {high}",
        condition_value_fn=lambda row: {"low": row.price, "high": row.price + 5},
        column_names=["p_partkey", "p_size"],
        select=["p_size desc", "p_partkey"],
        match_count=True,
        allow_theta=True,
    )


@query(f"""
    WITH pairs AS (
        SELECT event_id, l_orderkey, l_linenumber,
               row_number() OVER (PARTITION BY event_id ORDER BY l_orderkey, l_linenumber) AS rn
        FROM ({EVENTS_SQL}) JOIN lineitem ON l_suppkey = user_id % 100 AND l_shipdate <= cutoff
          AND l_shipdate + to_days(CAST(l_quantity AS INTEGER)) > cutoff)
    SELECT e.event_id, e.user_id % 100 AS supplier, cutoff, l_orderkey, l_linenumber, {status_sql("l_orderkey IS NOT NULL")}
    FROM ({EVENTS_SQL}) e LEFT JOIN pairs ON pairs.event_id = e.event_id AND rn = 1 WHERE user_id IS NOT NULL
""")
def range_stab(t):
    """The first item of a supplier that was on its way at a time."""
    return enrich(
        event_requests(t.events).select("event_id", (F.col("user_id") % 100).alias("supplier"), "cutoff"),
        t.lineitem.withColumn("until", F.expr("l_shipdate + make_dt_interval(cast(l_quantity as int))")),
        keys={"supplier": "l_suppkey"},
        restriction="l_shipdate <= '{cutoff}' AND until > '{cutoff}'",
        fields=["cutoff"],
        column_names=["l_suppkey as supplier", "l_orderkey", "l_linenumber"],
        select=["l_orderkey", "l_linenumber"],
    )


_ASKED = """
    SELECT c_custkey, TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(c_custkey * 53 % 2000 AS INTEGER)) AS since FROM customer WHERE c_custkey % 40 = 0
"""


@query(f"""
    WITH asked AS (SELECT c_custkey, since, since + to_days(20) AS until FROM ({_ASKED})),
    best AS (
        SELECT o.*, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders o
        WHERE EXISTS (SELECT 1 FROM asked WHERE o_orderdate >= since AND o_orderdate < until))
    SELECT c_custkey, since, o_orderkey, o_orderdate, {status_sql("o_orderkey IS NOT NULL")}
    FROM asked LEFT JOIN best ON o_custkey = c_custkey AND rn = 1
""")
def range_any_request(t):
    """Each customer's dearest order from a time that any customer asks for."""
    asked = t.customer.select(
        "c_custkey",
        F.expr("timestamp_ntz'1995-01-01 00:00:00' + make_dt_interval(cast(c_custkey * 53 % 2000 as int))").alias("since"),
    ).where("c_custkey % 40 = 0")
    return enrich(
        asked,
        t.orders,
        keys={"c_custkey": "o_custkey"},
        restriction="o_orderdate >= '{since}' AND o_orderdate < '{until}'",
        condition_value_fn=lambda row: {"since": row.since, "until": row.since + F.expr("interval 20 days")},
        column_names=["o_orderkey", "o_custkey as c_custkey", "o_orderdate", "o_totalprice"],
        scope="any_request",
        select=["o_totalprice desc", "o_orderkey"],
    ).drop("o_totalprice")


@query(f"""
    WITH pairs AS (
        SELECT event_id, p_partkey, p_size, count(*) OVER (PARTITION BY event_id) AS n,
               row_number() OVER (PARTITION BY event_id ORDER BY p_size, p_partkey) AS rn
        FROM events JOIN part ON abs(p_retailprice - value * 3) < 2.5)
    SELECT e.event_id, e.value * 3 AS price, p_partkey, p_size, coalesce(n, 0) AS "__match_count",
           {status_sql("p_partkey IS NOT NULL")}
    FROM events e LEFT JOIN pairs ON pairs.event_id = e.event_id AND rn = 1
""")
def range_distance(t):
    """The smallest part whose price is near."""
    return enrich(
        t.events.select("event_id", (F.col("value") * 3).alias("price")),
        t.part,
        restriction="abs(p_retailprice - {price}) < 2.5",
        fields=["price"],
        column_names=["p_partkey", "p_size"],
        select=["p_size", "p_partkey"],
        match_count=True,
        allow_theta=True,
    )
