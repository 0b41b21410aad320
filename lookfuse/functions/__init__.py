"""Column-level helpers: projections, templates, keys, orders and types."""
