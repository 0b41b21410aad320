"""Distributed steps: reduce to one row, prefix lookups, pair lookups, collecting, attaching, merging."""
