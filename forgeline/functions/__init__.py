"""Column functions: dates, serialized lists, JSON cells, amounts."""
