"""Where lookups and requests come from."""
