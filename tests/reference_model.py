"""A row-by-row model of the enrichment, for small fixtures only."""

from functools import cmp_to_key


def _compare(order):
    def compare(a, b):
        for name, descending in order:
            x, y = a[name], b[name]
            if x == y:
                continue
            if x is None:
                return 1
            if y is None:
                return -1
            return (1 if x < y else -1) if descending else (-1 if x < y else 1)
        return 0

    return cmp_to_key(compare)


def pick(requests, lookup, test, order, tie):
    """``[(request, first match or None, number of matches)]``; ties by ``tie`` columns, NULL first."""
    result = []
    for request in requests:
        matches = [row for row in lookup if test(request, row)]
        matches.sort(key=lambda r: tuple((r[t] is not None, r[t]) if r[t] is not None else (False, 0) for t in tie))
        matches.sort(key=_compare(order))
        result.append((request, matches[0] if matches else None, len(matches)))
    return result
