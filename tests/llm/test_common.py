from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from tiermill.llm.common import join_totals, rows_with_keys, run_folder, stored
from tiermill.llm.lines import dedup_lines
from tiermill.sources import remove_folder


def test_tables_between_steps_can_be_removed(spark, make_docs):
    base = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(base.iterdir())
    with run_folder(spark) as path:
        found = dedup_lines(make_docs(["a\nb\nc", "a\nb\nc"]), words=50).select("doc_id", "n_removed")
        rows = sorted(tuple(row) for row in found.collect())
    assert rows == [(0, 0), (1, 3)]
    assert set(base.iterdir()) - before == {Path(path)} and len(list(Path(path).iterdir())) >= 2
    assert remove_folder(spark, path) and set(base.iterdir()) == before
    assert Path(stored(spark.range(1), "x").inputFiles()[0].removeprefix("file:")).parent.parent == base


def test_totals_of_hot_and_cold_keys(spark):
    rows = [(None if at % 3 == 0 else at % 2500, at) for at in range(6000)]
    df = stored(spark.createDataFrame(rows, "k int, v long"), "totals")
    truth = {}
    for key, value in rows:
        truth[key] = truth.get(key, 0) + value
    found = join_totals(df, "k", "v", "sum").collect()
    assert len(found) == 6000 and all(row["sum"] == truth[row.k] for row in found)
    assert join_totals(df.limit(0), "k", "v", "sum").count() == 0


def test_rows_of_hot_and_cold_keys(spark):
    rows = [(7 if at % 3 == 0 else at, at) for at in range(3000)]
    df = stored(spark.createDataFrame(rows, "k int, v long"), "keyed")
    keys = df.groupBy("k").agg(F.count("*").alias("n")).filter("k % 2 = 1")
    found = sorted(row.v for row in rows_with_keys(df, keys, "k", "n").collect())
    assert found == sorted(value for key, value in rows if key % 2)
