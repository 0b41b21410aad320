"""The row object that plan-time callbacks get: attributes and items are columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column


class ColumnRow(Mapping):
    """Stands for any row of a DataFrame; remembers which fields were asked for."""

    def __init__(self, names: Iterable[str], column: Callable[[str], Column]):
        self._names = tuple(names)
        self._column = column
        self.used: set[str] = set()

    def __getitem__(self, name: str) -> Column:
        if name not in self._names:
            raise KeyError(f"No field {name!r} among {list(self._names)}")
        self.used.add(name)
        return self._column(name)

    def __getattr__(self, name: str) -> Column:
        if name.startswith("_"):
            raise AttributeError(name)
        try:
            return self[name]
        except KeyError as error:
            raise AttributeError(str(error)) from None

    def __iter__(self):
        return iter(self._names)

    def __len__(self):
        return len(self._names)
