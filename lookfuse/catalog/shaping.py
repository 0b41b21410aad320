"""Scans, projections and merge modes."""

from pyspark.sql import functions as F

from lookfuse import enrich, requests_from_rows, resolve_lookup, scan_lookup
from lookfuse.catalog.registry import query
from lookfuse.catalog.shared import EVENTS_SQL, event_requests, missing_sql, status_sql, with_missing

_ORDERS = f"(SELECT o_orderkey, {missing_sql('o_custkey')} AS o_custkey FROM orders)"
_LINEITEM = f"(SELECT * REPLACE ({missing_sql('l_partkey')} AS l_partkey) FROM lineitem)"


@query("SELECT c_custkey AS id, c_name AS customer FROM customer WHERE c_mktsegment = 'BUILDING'")
def lookup_scan(t):
    customer = resolve_lookup(t.spark, t.path("customer"))
    return scan_lookup(customer, ["c_custkey as id", "c_name AS customer"], "c_mktsegment = 'BUILDING'")


@query(f"""
    WITH r(segment, note) AS (VALUES ('BUILDING', 'b'), ('MACHINERY', 'm'), ('FURNITURE', 'f'), ('NO SUCH', 'n')),
    best AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer)
    SELECT segment, note, c_custkey, c_acctbal, {status_sql("c_custkey IS NOT NULL")}
    FROM r LEFT JOIN best ON c_mktsegment = segment AND rn = 1
""")
def enrich_literal_requests(t):
    rows = [("BUILDING", "b"), ("MACHINERY", "m"), ("FURNITURE", "f"), ("NO SUCH", "n")]
    requests = requests_from_rows(t.spark, rows, "segment string, note string")
    return enrich(
        requests,
        t.customer,
        join_key="segment",
        restriction="c_mktsegment = '{segment}'",
        fields=["segment"],
        column_names=["c_mktsegment as segment", "c_custkey", "c_acctbal"],
        select=["c_acctbal desc", "c_custkey"],
    )


@query("""
    SELECT event_id, CAST(NULL AS VARCHAR) AS c_name, 'NO_BQ_DATA' AS "__enrichment_status" FROM events
""")
def enrich_no_valid_probe(t):
    requests = t.events.select("event_id", F.lit(None).cast("bigint").alias("user_id"))
    return enrich(
        requests, t.customer, join_key="user_id", column_names=["c_custkey as user_id", "c_name"], null_keys="keep"
    ).drop("user_id")


@query(f"""
    SELECT o_orderkey, o_custkey, c_name AS customer, c_acctbal AS balance, {status_sql("c_custkey IS NOT NULL")}
    FROM {_ORDERS} LEFT JOIN customer ON c_custkey = o_custkey
""")
def project_aliases(t):
    return enrich(
        t.orders.select("o_orderkey", with_missing("o_custkey")),
        t.customer,
        join_key="o_custkey",
        column_names=["c_custkey as o_custkey", "c_name AS customer", " c_acctbal  As  balance "],
    )


@query(f"""
    SELECT o_orderkey, o_custkey, c_custkey, c_name AS customer, c_nationkey, c_acctbal, c_mktsegment,
           {status_sql("c_custkey IS NOT NULL")}
    FROM {_ORDERS} LEFT JOIN customer ON c_custkey = o_custkey
""")
def project_all(t):
    return enrich(
        t.orders.select("o_orderkey", with_missing("o_custkey")),
        t.customer,
        keys={"o_custkey": "c_custkey"},
        column_names=["c_name as customer", "*", "c_acctbal as not read"],
    )


@query(f"""
    SELECT o_orderkey, c.c_custkey AS key_read, c.c_name AS name_read, {status_sql("c.c_custkey IS NOT NULL")}
    FROM {_ORDERS} LEFT JOIN customer c ON c.c_custkey = o_custkey
""")
def project_ensured_key(t):
    nested = enrich(
        t.orders.select("o_orderkey", with_missing("o_custkey").alias("c_custkey")),
        t.customer,
        join_key="c_custkey",
        column_names=["c_name"],
        mode="add_nested",
        nested_key="found",
    )
    return nested.select(
        "o_orderkey",
        F.col("found.c_custkey").alias("key_read"),
        F.col("found.c_name").alias("name_read"),
        "__enrichment_status",
    )


_DOCUMENTS = ("doc_id", "lang", "source", "n_chars")


@query(f"""
    SELECT d.doc_id, lang, source, n_chars, quality, toxic, {status_sql("l.doc_id IS NOT NULL")}
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
""")
def enrich_merge_new(t):
    return enrich(t.documents.select(*_DOCUMENTS), t.labels, join_key="doc_id")


@query(f"""
    SELECT d.doc_id, lang, l.doc_id AS label_doc_id, quality AS label_quality, l.doc_id IS NULL AS without_label,
           {status_sql("l.doc_id IS NOT NULL")}
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
""")
def enrich_add_nested(t):
    enriched = enrich(
        t.documents.select(*_DOCUMENTS), t.labels, join_key="doc_id", mode="add_nested", nested_key="source"
    )
    return enriched.select(
        "doc_id",
        "lang",
        F.col("source.doc_id").alias("label_doc_id"),
        F.col("source.quality").alias("label_quality"),
        F.col("source").isNull().alias("without_label"),
        "__enrichment_status",
    )


@query(f"""
    SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN -1 ELSE l.quality END AS quality, toxic,
           {status_sql("l.doc_id IS NOT NULL")}
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
""")
def enrich_overwrite(t):
    requests = t.documents.select("doc_id", F.lit(-1).alias("quality"))
    return enrich(requests, t.labels, join_key="doc_id", mode="overwrite")


@query(f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, p_name, p_brand, p_retailprice,
           {status_sql("p_partkey IS NOT NULL")}
    FROM {_LINEITEM} LEFT JOIN part ON p_partkey = l_partkey
""")
def enrich_lineitem_part(t):
    return enrich(
        t.lineitem.select("l_orderkey", "l_linenumber", with_missing("l_partkey"), "l_quantity"),
        t.part,
        join_key="l_partkey",
        column_names=["p_partkey as l_partkey", "p_name", "p_brand", "p_retailprice"],
    )


@query("""
    SELECT d.doc_id, lang, l.doc_id AS response_doc_id, quality, l.doc_id IS NULL AS no_response
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
""")
def lookup_pairs(t):
    pairs = enrich(t.documents.select(*_DOCUMENTS), t.labels, keys=["doc_id"], mode="pairs")
    return pairs.select(
        "request.doc_id",
        "request.lang",
        F.col("response.doc_id").alias("response_doc_id"),
        "response.quality",
        F.col("response").isNull().alias("no_response"),
    )


@query(f"""
    SELECT o_orderkey, o_custkey, c_name, {status_sql("c_custkey IS NOT NULL")}
    FROM {_ORDERS} LEFT JOIN customer ON c_custkey = o_custkey
""")
def enrich_key_alias(t):
    return enrich(
        t.orders.select("o_orderkey", with_missing("o_custkey")),
        t.customer,
        join_key="o_custkey",
        fields=["o_custkey"],
        restriction="c_custkey = {o_custkey}",
        column_names=["c_custkey as o_custkey", "c_name"],
    )


@query(f"""
    SELECT event_id, CASE WHEN user_id IS NULL THEN NULL ELSE event_type END AS event_type_part, user_id AS user_id_part
    FROM ({EVENTS_SQL})
""")
def row_key(t):
    from lookfuse import row_key as key

    requests = event_requests(t.events)
    keyed = requests.select("event_id", key(requests, ["user_id", "event_type"]).alias("key"))
    return keyed.select(
        "event_id", F.col("key.event_type").alias("event_type_part"), F.col("key.user_id").alias("user_id_part")
    )


@query(f"""
    SELECT event_id, CASE WHEN user_id IS NULL THEN '__invalid_key__'
        ELSE '{{"event_type":"' || event_type || '","user_id":' || CAST(user_id AS VARCHAR) || '}}' END AS cache_key
    FROM ({EVENTS_SQL})
""")
def cache_key(t):
    from lookfuse import cache_key as key

    requests = event_requests(t.events)
    return requests.select("event_id", key(requests, ["user_id", "event_type"]).alias("cache_key"))
