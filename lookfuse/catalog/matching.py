"""Keys, NULLs, and how the lookup is cut to what is asked for."""

from pyspark.sql import functions as F

from lookfuse import enrich, restrict_to_requests
from lookfuse.catalog.registry import query
from lookfuse.catalog.shared import EVENTS_SQL, event_requests, missing_sql, status_sql, with_missing


@query(f"""
    WITH best AS (
        SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey) AS rn
        FROM orders)
    SELECT event_id, user_id, wanted_status, o_orderkey, o_orderdate, {status_sql("o_orderkey IS NOT NULL")}
    FROM ({EVENTS_SQL}) LEFT JOIN best ON o_custkey = user_id AND o_orderstatus = wanted_status AND rn = 1
    WHERE user_id IS NOT NULL
""")
def enrich_composite_key(t):
    return enrich(
        event_requests(t.events).select("event_id", "user_id", "wanted_status"),
        t.orders,
        keys={"user_id": "o_custkey", "wanted_status": "o_orderstatus"},
        column_names=["o_orderkey", "o_orderdate", "o_custkey as user_id", "o_orderstatus as wanted_status"],
        select=["o_orderdate desc", "o_orderkey"],
    )


_ASKING = f"(SELECT event_id, {missing_sql('user_id')} AS user_id FROM ({EVENTS_SQL}))"


def _events_to_customer(t, **options):
    return enrich(
        event_requests(t.events).select("event_id", with_missing("user_id")),
        t.customer,
        join_key="user_id",
        column_names=["c_custkey as user_id", "c_name"],
        **options,
    )


@query(f"""
    SELECT event_id, user_id, c_name, {status_sql("c_custkey IS NOT NULL")}
    FROM {_ASKING} LEFT JOIN customer ON c_custkey = user_id WHERE user_id IS NOT NULL
""")
def null_key_drop(t):
    return _events_to_customer(t, null_keys="drop")


@query(f"""
    SELECT event_id, user_id, c_name, {status_sql("c_custkey IS NOT NULL")}
    FROM {_ASKING} LEFT JOIN customer ON c_custkey = user_id
""")
def null_key_keep(t):
    return _events_to_customer(t, null_keys="keep")


@query(f"""
    SELECT event_id, user_id, c_name, {status_sql("k IS NOT NULL")}
    FROM ({EVENTS_SQL})
    LEFT JOIN (SELECT CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey END AS k, c_name FROM customer) ON k = user_id
""")
def lookup_null_key_drop(t):
    lookup = t.customer.select(F.when(F.col("c_custkey") % 10 != 0, F.col("c_custkey")).alias("user_id"), "c_name")
    return enrich(
        event_requests(t.events).select("event_id", "user_id"), lookup, join_key="user_id", null_keys="keep"
    )


@query("""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 9000)
""")
def semi_reduce(t):
    asked = t.customer.where("c_acctbal > 9000")
    kept = restrict_to_requests(t.orders, asked, {"c_custkey": "o_custkey"}, max_keys=0)
    return kept.select("o_orderkey", "o_custkey", "o_totalprice")


@query(f"""
    WITH best AS (
        SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey) AS rn
        FROM orders)
    SELECT event_id, user_id, wanted_status, o_orderkey, {status_sql("o_orderkey IS NOT NULL")}
    FROM ({EVENTS_SQL}) LEFT JOIN best ON o_custkey = user_id AND o_orderstatus = wanted_status AND rn = 1
    WHERE user_id IS NOT NULL AND event_id % 3 = 0
""")
def bloom_reduce(t):
    """A lookup cut to the composite keys that are asked for, by a filter at its scan."""
    return enrich(
        event_requests(t.events).select("event_id", "user_id", "wanted_status").where("event_id % 3 = 0"),
        t.orders,
        keys={"user_id": "o_custkey", "wanted_status": "o_orderstatus"},
        column_names=["o_orderkey", "o_orderdate", "o_custkey as user_id", "o_orderstatus as wanted_status"],
        select=["o_orderdate desc", "o_orderkey"],
        semi_reduce="bloom",
    ).drop("o_orderdate")


@query("""
    SELECT c_custkey, c_name, c_nationkey FROM customer
    WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)
""")
def isin_pushdown(t):
    asked = t.nation.where("n_regionkey = 2")
    kept = restrict_to_requests(t.customer, asked, {"n_nationkey": "c_nationkey"})
    return kept.select("c_custkey", "c_name", "c_nationkey")


_ASKED = """
    SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END AS wanted,
           TIMESTAMP '1999-01-01 00:00:00' + to_days(CAST(c_custkey % 700 AS INTEGER)) AS since
    FROM customer
"""


def _asked(customer):
    return customer.select(
        "c_custkey",
        F.expr("case c_custkey % 3 when 0 then 'F' when 1 then 'O' else 'P' end").alias("wanted"),
        F.expr("timestamp_ntz'1999-01-01 00:00:00' + make_dt_interval(cast(c_custkey % 700 as int))").alias("since"),
    )


@query(f"""
    WITH asked AS ({_ASKED}), widest AS (SELECT wanted, min(since) AS since FROM asked GROUP BY wanted),
    best AS (
        SELECT o.*, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
        FROM orders o JOIN widest ON o_orderstatus = wanted AND o_orderdate >= since)
    SELECT c_custkey, asked.wanted, asked.since, o_orderkey, o_orderstatus, o_orderdate, {status_sql("o_orderkey IS NOT NULL")}
    FROM asked LEFT JOIN best ON o_custkey = c_custkey AND rn = 1
""")
def scope_any_request(t):
    return enrich(
        _asked(t.customer),
        t.orders,
        keys={"c_custkey": "o_custkey"},
        restriction="o_orderstatus = '{wanted}' AND o_orderdate >= '{since}'",
        fields=["wanted", "since"],
        column_names=["o_orderkey", "o_custkey as c_custkey", "o_orderstatus", "o_orderdate"],
        scope="any_request",
        select=["o_orderdate", "o_orderkey"],
    )


@query(f"""
    SELECT c_custkey, c_nationkey, n_nationkey, n_name, {status_sql("n_nationkey IS NOT NULL")}
    FROM (SELECT c_custkey, c_nationkey, n_nationkey, n_name,
                 row_number() OVER (PARTITION BY c_custkey ORDER BY n_name DESC, n_nationkey) AS rn
          FROM customer LEFT JOIN nation ON n_nationkey < c_nationkey) WHERE rn = 1
""")
def theta_lookup(t):
    return enrich(
        t.customer.select("c_custkey", "c_nationkey"),
        t.nation,
        restriction="n_nationkey < {c_nationkey}",
        fields=["c_nationkey"],
        column_names=["n_nationkey", "n_name"],
        select=["n_name desc", "n_nationkey"],
        allow_theta=True,
    )


@query(f"""
    WITH cheapest AS (SELECT p_retailprice, min(p_partkey) AS p_partkey FROM part GROUP BY p_retailprice)
    SELECT event_id, price, p_partkey, p_retailprice, {status_sql("p_partkey IS NOT NULL")}
    FROM (SELECT event_id, value * 3 AS price FROM events) ASOF LEFT JOIN cheapest ON price >= p_retailprice
""")
def theta_nearest(t):
    return enrich(
        t.events.select("event_id", (F.col("value") * 3).alias("price")),
        t.part,
        restriction="p_retailprice <= {price}",
        fields=["price"],
        column_names=["p_partkey", "p_retailprice"],
        select=["p_retailprice desc", "p_partkey"],
        allow_theta=True,
    )
