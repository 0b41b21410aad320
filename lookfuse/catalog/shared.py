"""Request tables several queries start from, in both languages."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Every fiftieth event has no user.
EVENTS_SQL = """
    SELECT event_id, CASE WHEN event_id % 50 = 0 THEN NULL ELSE user_id END AS user_id, event_type, value,
           TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(event_id * 37 % 2400 AS INTEGER)) AS cutoff,
           CASE event_id % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END AS wanted_status
    FROM events
"""


def event_requests(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        F.when(F.col("event_id") % 50 != 0, F.col("user_id")).alias("user_id"),
        "event_type",
        "value",
        F.expr("timestamp_ntz'1995-01-01 00:00:00' + make_dt_interval(cast(event_id * 37 % 2400 as int))").alias("cutoff"),
        F.expr("case event_id % 3 when 0 then 'F' when 1 then 'O' else 'P' end").alias("wanted_status"),
    )


# Every seventh customer is asked for by a number that none has.
def missing_sql(key: str) -> str:
    return f"CASE WHEN {key} % 7 = 0 THEN -1 - {key} ELSE {key} END"


def with_missing(key: str) -> Column:
    return F.when(F.col(key) % 7 == 0, -1 - F.col(key)).otherwise(F.col(key)).alias(key)


STATUS_SQL = "CASE WHEN {hit} THEN 'SUCCESS' ELSE 'NO_BQ_DATA' END AS \"__enrichment_status\""


def status_sql(hit: str) -> str:
    return STATUS_SQL.format(hit=hit)
