"""Which of several matching rows is picked, and the two ready-made forms."""

from pyspark.sql import functions as F

from lookfuse import ColumnSelector, KeyedEnrichment, LookupHandler, PythonSelector, StreamSelector, enrich
from lookfuse.catalog.registry import query
from lookfuse.catalog.shared import EVENTS_SQL, event_requests, missing_sql, status_sql, with_missing

_CUSTOMER = f"SELECT * REPLACE ({missing_sql('c_custkey')} AS c_custkey) FROM main.customer"

_COLUMNS = ["o_orderkey", "o_custkey as c_custkey", "o_totalprice", "o_orderstatus", "o_orderdate"]


def _customer_to_orders(t, select, **options):
    enriched = enrich(
        t.customer.select(with_missing("c_custkey"), "c_acctbal"),
        t.orders,
        join_key="c_custkey",
        column_names=_COLUMNS,
        select=select,
        **options,
    )
    return enriched.select("c_custkey", "o_orderkey", "o_totalprice", "__enrichment_status")


def _picked_sql(order: str, where: str = "TRUE") -> str:
    return f"""
        WITH customer AS ({_CUSTOMER}),
        best AS (
            SELECT c_custkey AS k, o.*, row_number() OVER (PARTITION BY c_custkey ORDER BY {order}) AS rn
            FROM orders o JOIN customer ON o_custkey = c_custkey WHERE {where}),
        hits AS (SELECT DISTINCT o_custkey AS h FROM orders)
        SELECT c_custkey, o_orderkey, o_totalprice,
               CASE WHEN h IS NULL THEN 'NO_BQ_DATA' WHEN k IS NULL THEN 'BQ_SELECTION_FAILED' ELSE 'SUCCESS' END
                   AS "__enrichment_status"
        FROM customer LEFT JOIN best ON k = c_custkey AND rn = 1 LEFT JOIN hits ON h = c_custkey
    """


@query(_picked_sql("o_orderkey"))
def select_first(t):
    return _customer_to_orders(t, "first")


@query(_picked_sql("o_orderdate DESC, o_orderkey"))
def select_latest(t):
    return _customer_to_orders(t, ["o_orderdate desc nulls last", "o_orderkey"])


@query(_picked_sql("o_totalprice DESC, o_orderkey"))
def select_reduce(t):
    def dearest(rows):
        return F.reduce(
            rows, F.get(rows, 0), lambda best, r: F.when(r["o_totalprice"] > best["o_totalprice"], r).otherwise(best)
        )

    return _customer_to_orders(t, ColumnSelector(dearest, decomposable=True))


def _dearest(rows):
    return max(rows, key=lambda r: (r.get("o_totalprice", 0), -r["o_orderkey"]))


@query(_picked_sql("o_totalprice DESC, o_orderkey"))
def select_python(t):
    return _customer_to_orders(t, PythonSelector(_dearest, decomposable=True))


@query(_picked_sql("abs(o_totalprice - c_acctbal * 40), o_orderkey"))
def select_with_request(t):
    def nearest(rows, request):
        def gap(r):
            return F.abs(r["o_totalprice"] - request["c_acctbal"] * 40)

        return F.reduce(rows, F.get(rows, 0), lambda best, r: F.when(gap(r) < gap(best), r).otherwise(best))

    return _customer_to_orders(t, ColumnSelector(nearest, decomposable=True))


def _last_of_few(rows):
    if len(rows) > 10:
        raise ValueError("too many")
    return rows[-1]


@query(f"""
    WITH customer AS ({_CUSTOMER}),
    best AS (SELECT o_custkey AS k, CASE WHEN count(*) > 10 THEN min(o_orderkey) ELSE max(o_orderkey) END AS pick
             FROM orders GROUP BY o_custkey)
    SELECT c_custkey, o_orderkey, o_totalprice, CASE WHEN k IS NULL THEN 'NO_BQ_DATA' ELSE 'SUCCESS' END AS "__enrichment_status"
    FROM customer LEFT JOIN best ON k = c_custkey LEFT JOIN orders ON o_orderkey = pick
""")
def select_python_fallback(t):
    return _customer_to_orders(t, PythonSelector(_last_of_few))


def _reached_sql(limit: str) -> str:
    return _picked_sql(
        "o_orderdate, o_orderkey",
        f"""o_orderkey IN (
            SELECT o_orderkey FROM (
                SELECT o_orderkey, o_custkey AS k, sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER
                    (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS total FROM orders)
            JOIN customer ON c_custkey = k WHERE total > {limit})""",
    )


_IN_TIME = ["o_orderdate", "o_orderkey"]


@query(_reached_sql("100000000"))
def select_streamed(t):
    """The order with which a customer's total reaches a million; none if it does not."""

    def reached(rows):
        total = 0
        for row in rows:
            total += round(row["o_totalprice"] * 100)
            if total > 100_000_000:
                return row
        return {}

    return _customer_to_orders(t, StreamSelector(reached, order=_IN_TIME))


@query(_reached_sql("CAST(c_acctbal AS BIGINT) * 20000"))
def select_streamed_with_request(t):
    """The same with a limit of the customer's own."""

    def reached(rows, request):
        total = 0
        for row in rows:
            total += round(row.o_totalprice * 100)
            if total > round(request.c_acctbal) * 20_000:
                return row
        return None

    return _customer_to_orders(t, StreamSelector(reached, order=_IN_TIME, rows_as="row"))


@query(_picked_sql("o_orderkey", "o_orderstatus = 'P'"))
def select_declined(t):
    def first_pending(rows):
        return F.get(F.filter(rows, lambda r: r["o_orderstatus"] == "P"), 0)

    return _customer_to_orders(t, ColumnSelector(first_pending, decomposable=True))


@query(f"""
    WITH best AS (
        SELECT o_custkey, o_orderkey, o_orderdate,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders
        WHERE o_orderstatus = 'F')
    SELECT event_id, user_id, o_orderkey, o_orderdate, {status_sql("o_orderkey IS NOT NULL")}
    FROM ({EVENTS_SQL}) LEFT JOIN best ON o_custkey = user_id AND rn = 1 WHERE user_id IS NOT NULL
""")
def keyed_enrichment(t):
    latest_finished = KeyedEnrichment(
        table_name=t.path("orders"),
        join_key_field="user_id",
        fields=["user_id"],
        row_restriction_template="o_custkey = {user_id} AND o_orderstatus = 'F'",
        column_names=["o_custkey as user_id", "o_orderkey", "o_orderdate"],
        select=["o_orderdate desc", "o_orderkey"],
    )
    return event_requests(t.events).select("event_id", "user_id").transform(latest_finished)


@query(f"""
    WITH best AS (
        SELECT o_custkey, o_orderstatus, o_orderkey,
               row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
    SELECT event_id, user_id, o_orderkey, o_orderkey IS NULL AS no_response
    FROM ({EVENTS_SQL}) LEFT JOIN best ON o_custkey = user_id AND o_orderstatus = wanted_status AND rn = 1
""")
def lookup_handler(t):
    handler = LookupHandler(
        table_name=t.orders,
        fields=["user_id", "wanted_status"],
        row_restriction_template="o_custkey = {user_id} AND o_orderstatus = '{wanted_status}'",
        column_names=["o_custkey as user_id", "o_orderstatus as wanted_status", "o_orderkey", "o_totalprice"],
        latest_value_selector=["o_totalprice desc", "o_orderkey"],
    )
    pairs = handler(event_requests(t.events))
    return pairs.select(
        "request.event_id",
        "request.user_id",
        F.col("response.o_orderkey").alias("o_orderkey"),
        F.col("response").isNull().alias("no_response"),
    )
