"""Verification: inputs made from the driver tables, queries, their SQL twins, a comparer."""
