"""Layered data marts on PySpark: cleaning operators, layers, marts, reports, table layout."""
