"""Which lookup columns are read, and what they are called in the output."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from lookfuse.functions.names import NameIndex

_AS = re.compile(r"\s+as\s+", re.IGNORECASE)


@dataclass(frozen=True)
class ColumnList:
    """A parsed ``column_names`` list."""

    names: tuple[str, ...] = ()
    renames: dict[str, str] = field(default_factory=dict)
    everything: bool = True

    def original(self, name: str) -> str:
        """The lookup column behind an output name (the name itself if not an alias)."""
        for source, alias in self.renames.items():
            if alias == name:
                return source
        return name


def parse_column_names(column_names: Sequence[str] | None) -> ColumnList:
    """Parse ``["id as user_id", "email"]``; ``None``, ``[]`` and ``*`` mean all columns.

    ``*`` ends the parsing: aliases given before it stay in force, entries after it do not count.
    """
    if not column_names:
        return ColumnList()
    names: list[str] = []
    renames: dict[str, str] = {}
    for entry in column_names:
        parts = [p.strip() for p in _AS.split(entry, maxsplit=1)]
        if not all(parts):
            raise ValueError(f"Empty column name or alias in column_names: {entry!r}")
        if parts == ["*"]:
            return ColumnList(tuple(names), renames, True)
        if parts[0] not in names:
            names.append(parts[0])
        if len(parts) == 2:
            renames[parts[0]] = parts[1]
    return ColumnList(tuple(names), renames, False)


def output_columns(
    parsed: ColumnList,
    available: NameIndex,
    all_names: Sequence[str],
    required: Iterable[str] = (),
    wanted: Iterable[str] = (),
) -> list[tuple[str, str]]:
    """``[(lookup column, output name)]`` for the list plus the key columns.

    ``required`` names have to exist in the lookup, ``wanted`` ones are added only if they do.
    """
    sources = list(all_names) if parsed.everything else list(parsed.names)
    if parsed.everything:
        missing = [n for n in parsed.renames if n not in available]
    else:
        sources += [parsed.original(n) for n in required]
        sources += [parsed.original(n) for n in wanted if parsed.original(n) in available]
        missing = [n for n in sources if n not in available]
    if missing:
        raise ValueError(f"Lookup has no column(s) {sorted(set(missing))}; it has {list(all_names)}")
    renames = {available.find(n): alias for n, alias in parsed.renames.items()}
    resolved = dict.fromkeys(available.find(n) for n in sources)
    result = [(n, renames.get(n, n)) for n in resolved]
    outputs = [out for _, out in result]
    twice = sorted({o for o in outputs if outputs.count(o) > 1})
    if twice:
        raise ValueError(f"Several lookup columns would be called {twice}; give them different aliases")
    return result
