"""Clustered tables that are appended to and put in order again in part."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tiermill.sources import clustered as cl
from tiermill.sources.tables import commits_of

NAMES = ("l", "t", "v")


def ranges(spark, root):
    rows = cl.read_clustered(spark, root, "l", "t")
    found = rows.groupBy(F.col("_metadata.file_path")).agg(F.min("v").alias("a"), F.max("v").alias("b"))
    return sorted((row.a, row.b) for row in found.collect())


def numbers(spark, low, high, step=1):
    return spark.range(low, high, step, 3).select(F.col("id").alias("v"), F.lit("x").alias("s"))


def test_after_an_append_few_files_are_rewritten_and_none_overlap(spark, tmp_path):
    root = str(tmp_path)
    first = cl.append_clustered(numbers(spark, 0, 20_000), root, *NAMES, files=20)
    cl.append_clustered(numbers(spark, 19_000, 20_000), root, *NAMES, files=2)
    cl.append_clustered(numbers(spark, 19_500, 20_500), root, *NAMES, files=2)
    before = cl.table_files(spark, root, "l", "t")
    assert len(before) == 24
    old, new = cl.recluster(spark, root, *NAMES, file_bytes=8000)
    assert new and len([one for one in old if one in first]) <= 3 and len(old) < len(before) / 3
    after = cl.table_files(spark, root, "l", "t")
    assert set(after) == set(before) - set(old) | set(new)
    found = ranges(spark, root)
    assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))
    rows = cl.read_clustered(spark, root, "l", "t")
    assert rows.count() == 22_000 and rows.agg(F.sum("v")).first()[0] == sum(range(20_000)) + sum(
        range(19_000, 20_000)
    ) + sum(range(19_500, 20_500))
    assert cl.recluster(spark, root, *NAMES) == ([], [])


def test_a_depth_lets_appends_gather(spark, tmp_path):
    root = str(tmp_path)
    cl.append_clustered(numbers(spark, 0, 5000), root, *NAMES, files=5)
    cl.append_clustered(numbers(spark, 0, 5000, 100), root, *NAMES, files=1)
    assert cl.recluster(spark, root, *NAMES, depth=2) == ([], [])
    cl.append_clustered(numbers(spark, 0, 5000, 100), root, *NAMES, files=1)
    old, _ = cl.recluster(spark, root, *NAMES, depth=2)
    assert len(old) == 7 and cl.read_clustered(spark, root, "l", "t").count() == 5100


def test_depths_of_ranges(spark):
    files = [
        ("a", 0, 10), ("b", 10, 20), ("c", 12, 15), ("d", 14, 20), ("e", 20, 20), ("f", 20, 30),
        ("g", 40, 50), ("h", 45, 45), ("i", 60, 60), ("j", 60, 60), ("k", None, None),
    ]
    df = spark.createDataFrame(files, "file string, low int, high int")
    found = {row.file: row for row in cl.overlap_depths(df).collect()}
    depths = {name: row.depth for name, row in found.items()}
    assert depths == {"a": 1, "b": 3, "c": 3, "d": 3, "e": 1, "f": 1, "g": 2, "h": 2, "i": 1, "j": 1}
    assert found["g"].stretch == found["h"].stretch != found["a"].stretch
    assert found["a"].stretch != found["b"].stretch == found["d"].stretch != found["f"].stretch


def test_a_hot_value_spread_over_files_is_in_order(spark, tmp_path):
    root = str(tmp_path)
    hot = F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 1000)
    rows = spark.range(9000).select(hot.alias("v"), F.lit("same").alias("s"))
    for odd in (0, 1):
        cl.append_clustered(rows.filter(F.pmod(F.xxhash64("v"), F.lit(2)) == odd), root, *NAMES, files=4)
    old, new = cl.recluster(spark, root, *NAMES, file_bytes=2000)
    found = ranges(spark, root)
    assert old and len(new) > 3 and all(a[1] <= b[0] for a, b in zip(found, found[1:]))
    assert cl.recluster(spark, root, *NAMES) == ([], [])


def test_replaced_runs_go_when_unused(spark, tmp_path):
    root = str(tmp_path)
    for _ in range(3):
        cl.append_clustered(numbers(spark, 0, 100), root, *NAMES, files=1)
        cl.recluster(spark, root, *NAMES)
    runs = list((tmp_path / "l/t").glob("run-*"))
    assert len(runs) <= 3 and cl.read_clustered(spark, root, "l", "t").count() == 300
    assert len(commits_of(spark, f"{root}/l/t")) == 5


def test_nothing_to_read_or_cluster(spark, tmp_path):
    root = str(tmp_path)
    assert cl.recluster(spark, root, *NAMES) == ([], [])
    with pytest.raises(ValueError, match="no table"):
        cl.read_clustered(spark, root, "l", "t")
