"""A folder that streams write to, batch by batch, with a log of what is committed.

``rows/run=R/batch=N/attempt=A`` holds what one attempt at a batch wrote, ``commits`` a row for each batch that is complete, written
after its rows. Readers take committed attempts only. A run is one checkpoint: its identity lies in the checkpoint's
folder, so a batch that comes again after a failure is known, and batches of another checkpoint, numbered from 0
again, cannot take the place of earlier ones.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ROWS, _COMMITS, _IDENTITY = "rows", "commits", "sink-run"
_RUN, _BATCH, _ATTEMPT = "__run", "__batch", "__attempt"
_COMMIT = f"{_RUN} string, {_BATCH} long, {_ATTEMPT} string"


def _name(letter: str) -> str:
    # A letter in front keeps partition discovery from reading it as a number.
    return letter + uuid.uuid4().hex


def _read_or_none(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a folder, none if there is no such folder."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class FolderSink:
    """One checkpoint's side of a sink."""

    def __init__(self, spark: SparkSession, path: str, checkpoint: str, join: bool = False):
        self.spark, self.path = spark, path.rstrip("/")
        identity = f"{checkpoint.rstrip('/')}/{_IDENTITY}"
        known = _read_or_none(spark, identity, f"{_RUN} string").collect()
        self.run = known[0][0] if known else _name("r")
        commits = _read_or_none(spark, f"{self.path}/{_COMMITS}", _COMMIT)
        last = {r[0]: r[1] for r in commits.groupBy(_RUN).agg(F.max(_BATCH)).collect()}
        if not join and last.keys() - {self.run}:
            raise ValueError(
                f"{path} holds batches of another checkpoint than {checkpoint}; go on with that one, or say join_sink=True "
                "to add a further stream's rows to it"
            )
        if not known:
            spark.createDataFrame([(self.run,)], f"{_RUN} string").coalesce(1).write.parquet(identity)
        self.last = last.get(self.run, -1)

    def write(self, rows: DataFrame, batch: int) -> None:
        """Write and commit a batch; one that is committed already is left as it is."""
        if batch <= self.last:
            return
        attempt = _name("a")
        rows.write.parquet(f"{self.path}/{_ROWS}/{_RUN}={self.run}/{_BATCH}={batch}/{_ATTEMPT}={attempt}")
        self.commit(batch, attempt)
        self.last = batch

    def commit(self, batch: int, attempt: str) -> None:
        row = self.spark.createDataFrame([(self.run, batch, attempt)], _COMMIT)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/{_COMMITS}")


def read_sink(spark: SparkSession, path: str) -> DataFrame:
    """The committed rows of a folder that :func:`lookfuse.enrich_stream` has written to."""
    path = path.rstrip("/")
    commits = spark.read.schema(_COMMIT).parquet(f"{path}/{_COMMITS}")
    rows = spark.read.parquet(f"{path}/{_ROWS}")
    # Columns of folders: what is not committed is not read.
    return rows.join(commits, [_RUN, _BATCH, _ATTEMPT], "left_semi").drop(_RUN, _BATCH, _ATTEMPT)
