"""From options to one declarative plan."""
