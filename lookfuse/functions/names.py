"""Column name handling that follows the session's case sensitivity."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A literal name in SQL."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """A column by its literal name: dots and spaces are part of the name."""
    return F.col(quoted(name))


class NameIndex:
    """Finds a column of a DataFrame the way Spark would resolve it."""

    def __init__(self, names: Iterable[str], spark: SparkSession):
        self._fold = (
            (lambda s: s)
            if str(spark.conf.get("spark.sql.caseSensitive")).lower() == "true"
            else (lambda s: s.lower())
        )
        self._by_fold = {self._fold(n): n for n in names}

    @classmethod
    def of(cls, df: DataFrame) -> "NameIndex":
        return cls(df.columns, df.sparkSession)

    def find(self, name: str) -> str | None:
        return self._by_fold.get(self._fold(name))

    def __contains__(self, name: str) -> bool:
        return self.find(name) is not None
