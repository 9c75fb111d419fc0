"""Holdings that arrive over time."""
