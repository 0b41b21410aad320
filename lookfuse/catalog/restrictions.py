"""Restrictions built from each request's own values."""

from pyspark.sql import functions as F

from lookfuse import enrich
from lookfuse.catalog.registry import query
from lookfuse.catalog.shared import EVENTS_SQL, event_requests, status_sql

_FLOORS_SQL = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice / 100 AS floor FROM orders
"""


def _floors(orders):
    return orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", (F.col("o_totalprice") / 100).alias("floor")
    )


_COLUMNS = ["c_custkey as o_custkey", "c_name", "c_acctbal"]


@query(f"""
    SELECT o_orderkey, o_custkey, o_orderstatus, floor, c_name, c_acctbal, {status_sql("c_custkey IS NOT NULL")}
    FROM ({_FLOORS_SQL}) LEFT JOIN customer
      ON c_custkey = o_custkey AND c_acctbal > floor AND c_mktsegment <> 'BUILDING'
""")
def restrict_template(t):
    return enrich(
        _floors(t.orders),
        t.customer,
        join_key="o_custkey",
        restriction="c_custkey = {o_custkey} AND c_acctbal > {floor} AND c_mktsegment <> 'BUILDING'",
        fields=["o_custkey"],
        additional_condition_fields=["floor"],
        column_names=_COLUMNS,
    )


@query(f"""
    SELECT o_orderkey, o_custkey, o_orderstatus, floor, c_name, c_acctbal, {status_sql("c_custkey IS NOT NULL")}
    FROM ({_FLOORS_SQL}) LEFT JOIN customer
      ON c_custkey = o_custkey
      AND CASE WHEN o_orderstatus = 'F' THEN c_acctbal > floor ELSE c_mktsegment = 'BUILDING' END
""")
def restrict_fn(t):
    def condition(values, row):
        return F.when(row.o_orderstatus == "F", F.col("c_acctbal") > values["floor"]).otherwise(
            F.col("c_mktsegment") == "BUILDING"
        )

    return enrich(
        _floors(t.orders),
        t.customer,
        join_key="o_custkey",
        restriction=condition,
        fields=["o_custkey", "floor"],
        column_names=_COLUMNS,
    )


@query(f"""
    SELECT o_orderkey, o_custkey, o_orderstatus, floor, c_name, c_acctbal, {status_sql("c_custkey IS NOT NULL")}
    FROM ({_FLOORS_SQL}) LEFT JOIN customer
      ON c_custkey = o_custkey
      AND CASE o_orderstatus WHEN 'F' THEN c_acctbal > floor WHEN 'O' THEN c_mktsegment = 'BUILDING' ELSE FALSE END
""")
def restrict_dispatch(t):
    return enrich(
        _floors(t.orders),
        t.customer,
        join_key="o_custkey",
        restriction={
            "F": "c_custkey = {o_custkey} AND c_acctbal > {floor}",
            "O": "c_custkey = {o_custkey} AND c_mktsegment = 'BUILDING'",
        },
        template_id="o_orderstatus",
        fields=["o_custkey", "floor"],
        column_names=_COLUMNS,
    )


@query(f"""
    SELECT o_orderkey, o_custkey, o_orderstatus, c_name, c_acctbal, {status_sql("c_custkey IS NOT NULL")}
    FROM orders LEFT JOIN customer
      ON c_custkey = o_custkey
      AND CASE o_orderstatus WHEN 'F' THEN c_acctbal > 0 WHEN 'O' THEN c_mktsegment = 'BUILDING' ELSE FALSE END
""")
def restrict_dispatch_keys(t):
    return enrich(
        t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"),
        t.customer,
        join_key="o_custkey",
        restriction={
            "F": "c_custkey = {o_custkey} AND c_acctbal > 0",
            "O": "c_custkey = {o_custkey} AND c_mktsegment = 'BUILDING'",
        },
        template_id="o_orderstatus",
        fields=["o_custkey"],
        column_names=_COLUMNS,
    )


_OPTIONAL_FLOOR_SQL = f"""
    SELECT event_id, user_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value * 10 END AS floor FROM ({EVENTS_SQL})
"""


def _optional_floor(events):
    return event_requests(events).select(
        "event_id", "user_id", F.when(F.col("event_id") % 7 != 0, F.col("value") * 10).alias("floor")
    )


_USER_COLUMNS = ["c_custkey as user_id", "c_name", "c_acctbal"]


@query(f"""
    SELECT event_id, user_id, floor, c_name, c_acctbal, {status_sql("c_custkey IS NOT NULL")}
    FROM ({_OPTIONAL_FLOOR_SQL}) LEFT JOIN customer
      ON c_custkey = user_id AND floor IS NOT NULL AND (c_acctbal > floor OR c_mktsegment = 'BUILDING')
    WHERE user_id IS NOT NULL
""")
def null_condition_unmatched(t):
    return enrich(
        _optional_floor(t.events),
        t.customer,
        join_key="user_id",
        restriction="c_custkey = {user_id} AND (c_acctbal > {floor} OR c_mktsegment = 'BUILDING')",
        fields=["user_id"],
        additional_condition_fields=["floor"],
        column_names=_USER_COLUMNS,
    )


@query(f"""
    SELECT event_id, user_id, floor, c_name, c_acctbal, {status_sql("c_custkey IS NOT NULL")}
    FROM ({_OPTIONAL_FLOOR_SQL}) LEFT JOIN customer ON c_custkey = user_id AND (floor IS NULL OR c_acctbal > floor)
    WHERE user_id IS NOT NULL
""")
def restrict_fn_nulls(t):
    return enrich(
        _optional_floor(t.events),
        t.customer,
        join_key="user_id",
        restriction=lambda values, row: values["floor"].isNull() | (F.col("c_acctbal") > values["floor"]),
        fields=["user_id", "floor"],
        column_names=_USER_COLUMNS,
    )


@query(f"""
    SELECT event_id, user_id, floor, c_name, c_acctbal, {status_sql("c_custkey IS NOT NULL")}
    FROM ({_OPTIONAL_FLOOR_SQL}) LEFT JOIN customer ON c_custkey = user_id AND c_acctbal >= floor - 500
    WHERE user_id IS NOT NULL
""")
def condition_value_fn(t):
    return enrich(
        _optional_floor(t.events),
        t.customer,
        join_key="user_id",
        restriction="c_custkey = {key} AND c_acctbal >= {least}",
        condition_value_fn=lambda row: {"key": row.user_id, "least": row.floor - 500},
        column_names=_USER_COLUMNS,
    )


@query(f"""
    WITH best AS (
        SELECT event_id, o_orderkey, o_orderdate, o_totalprice,
               row_number() OVER (PARTITION BY event_id ORDER BY o_orderdate DESC, o_orderkey) AS rn
        FROM ({EVENTS_SQL}) JOIN orders ON o_custkey = user_id AND o_orderdate <= cutoff)
    SELECT e.event_id, user_id, cutoff, o_orderkey, o_orderdate, o_totalprice, {status_sql("o_orderkey IS NOT NULL")}
    FROM ({EVENTS_SQL}) e LEFT JOIN best ON best.event_id = e.event_id AND rn = 1 WHERE user_id IS NOT NULL
""")
def asof_latest(t):
    return enrich(
        event_requests(t.events).select("event_id", "user_id", "cutoff"),
        t.orders,
        join_key="user_id",
        restriction="o_custkey = {user_id} AND o_orderdate <= '{cutoff}'",
        fields=["user_id"],
        additional_condition_fields=["cutoff"],
        column_names=["o_custkey as user_id", "o_orderkey", "o_orderdate", "o_totalprice"],
        select=["o_orderdate desc", "o_orderkey"],
    )


@query(f"""
    WITH best AS (
        SELECT event_id, o_orderkey, o_orderdate,
               row_number() OVER (PARTITION BY event_id ORDER BY o_orderdate DESC, o_orderkey) AS rn
        FROM ({EVENTS_SQL}) JOIN orders
          ON o_custkey = user_id AND o_orderdate <= cutoff AND o_orderdate > cutoff - to_days(180))
    SELECT e.event_id, user_id, o_orderkey, o_orderdate, {status_sql("o_orderkey IS NOT NULL")}
    FROM ({EVENTS_SQL}) e LEFT JOIN best ON best.event_id = e.event_id AND rn = 1 WHERE user_id IS NOT NULL
""")
def asof_within(t):
    return enrich(
        event_requests(t.events).select("event_id", "user_id", "cutoff"),
        t.orders,
        join_key="user_id",
        restriction="o_custkey = {user} AND o_orderdate <= '{until}' AND o_orderdate > '{after}'",
        condition_value_fn=lambda row: {
            "user": row.user_id,
            "until": row.cutoff,
            "after": row.cutoff - F.expr("interval 180 days"),
        },
        column_names=["o_custkey as user_id", "o_orderkey", "o_orderdate"],
        select=["o_orderdate desc", "o_orderkey"],
    ).drop("cutoff")


@query(f"""
    WITH pairs AS (
        SELECT event_id, o_orderkey, o_totalprice, count(*) OVER (PARTITION BY event_id) AS n,
               row_number() OVER (PARTITION BY event_id ORDER BY o_totalprice DESC, o_orderkey) AS rn
        FROM ({EVENTS_SQL}) JOIN orders ON o_custkey = user_id AND o_orderdate <= cutoff OR o_orderkey = event_id)
    SELECT e.event_id, user_id, cutoff, o_orderkey, o_totalprice, CASE WHEN user_id IS NULL THEN 0 ELSE coalesce(n, 0) END AS "__match_count",
           {status_sql("o_orderkey IS NOT NULL")}
    FROM ({EVENTS_SQL}) e LEFT JOIN pairs ON pairs.event_id = e.event_id AND rn = 1 AND user_id IS NOT NULL
""")
def restrict_disjunction(t):
    """The user's dearest order so far, or the one with the event's own number if that is dearer."""
    return enrich(
        event_requests(t.events).select("event_id", "user_id", "cutoff"),
        t.orders,
        restriction="o_custkey = {user_id} AND o_orderdate <= '{cutoff}' OR o_orderkey = {event_id}",
        fields=["user_id", "event_id", "cutoff"],
        column_names=["o_orderkey", "o_totalprice"],
        select=["o_totalprice desc", "o_orderkey"],
        match_count=True,
    )


_BY_STATUS = {
    "F": "c_custkey = {o_custkey} AND c_acctbal > {floor}",
    "O": "c_custkey = {o_custkey} AND c_mktsegment = 'BUILDING'",
}


@query(f"""
    WITH asking AS (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM ({_FLOORS_SQL})),
    answers AS (
        SELECT o_custkey, c_name, c_acctbal FROM asking JOIN customer
          ON c_custkey = o_custkey AND rn = 1
          AND CASE o_orderstatus WHEN 'F' THEN c_acctbal > floor WHEN 'O' THEN c_mktsegment = 'BUILDING' ELSE FALSE END)
    SELECT o_orderkey, o_custkey, o_orderstatus, floor, c_name, c_acctbal, {status_sql("c_name IS NOT NULL")}
    FROM ({_FLOORS_SQL}) LEFT JOIN answers USING (o_custkey)
""")
def restrict_dispatch_representative(t):
    """A customer's first order asks, by its own template, for all of them."""
    return enrich(
        _floors(t.orders),
        t.customer,
        join_key="o_custkey",
        restriction=_BY_STATUS,
        template_id="o_orderstatus",
        fields=["o_custkey", "floor"],
        column_names=_COLUMNS,
        representative=["o_orderkey"],
    )


@query(f"""
    WITH first AS (
        SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus IN ('F', 'O') ORDER BY o_orderkey) = 1 AS asks FROM ({_FLOORS_SQL}))
    SELECT o_orderkey, o_custkey, o_orderstatus, floor, c_name, c_acctbal, {status_sql("c_custkey IS NOT NULL")}
    FROM first LEFT JOIN customer ON c_custkey = o_custkey AND asks
      AND CASE o_orderstatus WHEN 'F' THEN c_acctbal > floor WHEN 'O' THEN c_mktsegment = 'BUILDING' ELSE FALSE END
""")
def restrict_dispatch_duplicates(t):
    """Only a customer's first order that has a template is answered."""
    return enrich(
        _floors(t.orders),
        t.customer,
        join_key="o_custkey",
        restriction=_BY_STATUS,
        template_id="o_orderstatus",
        fields=["o_custkey", "floor"],
        column_names=_COLUMNS,
        duplicates="first",
        request_order=["o_orderkey"],
    )


@query(f"""
    WITH asked AS (
        SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'since' WHEN 1 THEN 'above' WHEN 2 THEN 'none' END AS kind,
               TIMESTAMP '1999-01-01 00:00:00' + to_days(CAST(c_custkey % 700 AS INTEGER)) AS since, 400000.0 - c_custkey AS least FROM customer),
    admitted AS (
        SELECT * FROM orders
        WHERE o_orderdate >= (SELECT min(since) FROM asked WHERE kind = 'since') AND o_orderstatus = 'F'
           OR o_totalprice > (SELECT min(least) FROM asked WHERE kind = 'above')),
    best AS (
        SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
        FROM admitted)
    SELECT c_custkey, kind, o_orderkey, o_orderdate, coalesce(n, 0) AS "__match_count", {status_sql("o_orderkey IS NOT NULL")}
    FROM asked LEFT JOIN best ON o_custkey = c_custkey AND rn = 1 AND kind IN ('since', 'above')
""")
def restrict_dispatch_any_request(t):
    """Orders that any request's own template admits, by customer."""
    asked = t.customer.select(
        "c_custkey",
        F.expr("case c_custkey % 4 when 0 then 'since' when 1 then 'above' when 2 then 'none' end").alias("kind"),
        F.expr("timestamp_ntz'1999-01-01 00:00:00' + make_dt_interval(cast(c_custkey % 700 as int))").alias("since"),
        (F.lit(400000.0) - F.col("c_custkey")).alias("least"),
    )
    return enrich(
        asked,
        t.orders,
        keys={"c_custkey": "o_custkey"},
        restriction={"since": "o_orderdate >= '{since}' AND o_orderstatus = 'F'", "above": "o_totalprice > {least}"},
        template_id="kind",
        fields=["since", "least"],
        column_names=["o_orderkey", "o_custkey as c_custkey", "o_orderdate"],
        scope="any_request",
        select=["o_orderdate", "o_orderkey"],
        match_count=True,
        allow_theta=True,
    ).drop("since", "least")
