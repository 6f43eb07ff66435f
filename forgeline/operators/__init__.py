"""Set-based operators over DataFrames: joins, aggregates, keys, change logs, checks."""
