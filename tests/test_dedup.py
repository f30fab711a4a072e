from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.plans import physical_plan
from tiermill import operators as op


def test_rows_are_distinct_with_arrays_and_nulls(spark):
    rows = [(1, ["a"], None), (1, ["a"], None), (1, ["b"], None), (None, None, None)]
    df = spark.createDataFrame(rows + rows, "i int, a array<string>, n string")
    once = op.dedup_rows(df)
    assert once.count() == 3
    assert op.dedup_rows(once).count() == 3


def test_copies_are_removed_before_the_shuffle(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    plan = physical_plan(op.dedup_rows(df)).split("\n\n")[0]
    assert plan.count("HashAggregate") == 2
    assert plan.index("Exchange") < plan.rindex("HashAggregate")


def test_smallest_row_by_order_then_by_the_rest_is_kept(spark):
    rows = [
        (1, 1, "b", 1.0),
        (1, 1, "a", 2.0),
        (1, 1, "a", 3.0),
        (1, 2, None, 0.5),
        (1, 2, "z", 9.0),
        (None, 2, "k", 1.0),
        (None, 2, "l", 1.0),
    ]
    df = spark.createDataFrame(rows, "k int, n int, s string, v double")
    kept = op.dedup_by_key(df, ["k", "n"], ["s"])
    assert {tuple(row) for row in kept.collect()} == {
        (1, 1, "a", 2.0),
        (1, 2, "z", 9.0),
        (None, 2, "k", 1.0),
    }
    assert kept.columns == df.columns


def test_keys_only_frames_and_maps_work(spark):
    keys = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert op.dedup_by_key(keys, ["k"]).count() == 2
    maps = spark.createDataFrame([(1, {"a": 1}, 5), (1, {"b": 2}, 4)], "k int, m map<string,int>, v int")
    assert op.dedup_by_key(maps, ["k"]).collect()[0].v == 5
    assert op.dedup_by_key(maps, ["k"], ["v"]).collect()[0].v == 4


def test_rows_that_differ_in_a_map_are_ordered_too(spark):
    rows = [(i % 3, {"x": i % 7, "y": (i * 5) % 11}) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, m map<string,int>")
    kept = [
        sorted((r.k, sorted(r.m.items())) for r in op.dedup_by_key(df.repartition(n, F.rand(n)), ["k"]).collect())
        for n in (1, 2, 5, 9)
    ]
    assert kept[0] == kept[1] == kept[2] == kept[3]


def test_rows_without_an_order_are_refused(spark):
    odd = spark.sql("SELECT 1 AS k, parse_json('{}') AS v")
    with pytest.raises(TypeError, match="ordered by v"):
        op.dedup_by_key(odd, ["k"])


def test_kept_rows_do_not_depend_on_partitioning(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(40), rng.randrange(3), rng.choice("abc"), i % 7) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, a int, s string, b int")
    best = {}
    for k, *rest in rows:
        best[k] = min(best.get(k, rest), rest)
    for parts in (1, 3, 11):
        mixed = df.repartition(parts, F.rand(parts))
        kept = op.dedup_by_key(mixed, ["k"]).collect()
        assert {row.k: [row.a, row.s, row.b] for row in kept} == best


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    hot = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
        (F.col("id") * 31 % 1009).alias("v"),
    )
    kept = op.dedup_by_key(hot, ["k"])
    plan = physical_plan(kept)
    head = plan.split("\n\n")[0]
    assert head.count("WindowGroupLimit") == 2
    assert head.index("WindowGroupLimit") < head.index("Exchange") < head.rindex("WindowGroupLimit")
    assert "row_number(), 1, Partial" in plan
    assert kept.count() == hot.select("k").distinct().count()
    assert kept.filter("k = 7").first().v == hot.filter("k = 7").agg(F.min("v")).first()[0]


def shuffled_bytes(df):
    """Bytes and rows that the exchanges of a frame wrote, from the metrics of the run."""
    df.write.format("noop").mode("overwrite").save()
    execution = df._jdf.queryExecution()
    # The noop write planned the frame anew; collecting the plan's own run is what has metrics.
    execution.toRdd().count()
    found, open_ = [], [execution.executedPlan()]
    while open_:
        node = open_.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            open_.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            open_.append(node.plan())
            continue
        if name == "Exchange":
            metrics = node.metrics()
            found.append(
                (
                    metrics.apply("shuffleBytesWritten").value(),
                    metrics.apply("shuffleRecordsWritten").value(),
                )
            )
        children = node.children()
        open_ += [children.apply(at) for at in range(children.size())]
    return [sum(x) for x in zip(*found)]


@pytest.fixture
def mostly_unique(spark, tmp_path):
    path = str(tmp_path / "rows")
    base = spark.range(0, 20_000, 1, 4).select(
        F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("text"), (F.col("id") * 0.1).alias("x")
    )
    base.unionByName(base.filter("id % 100 = 0")).write.parquet(path)
    return spark.read.parquet(path)


def test_rows_without_an_equal_are_not_shuffled(mostly_unique):
    plain, few = op.dedup_rows(mostly_unique), op.dedup_rows(mostly_unique, bits=op.dedup.BITMAP_BITS)
    assert plain.exceptAll(few).count() == few.exceptAll(plain).count() == 0 and few.count() == 20_000
    assert few.dtypes == plain.dtypes
    # A fifth of the bytes: the hashes of all rows, and the rows that have an equal.
    assert shuffled_bytes(few)[0] < shuffled_bytes(plain)[0] / 3


@pytest.mark.parametrize("bits", [32_768, 1 << 20])
def test_a_crowded_bitmap_only_moves_more(spark, bits):
    rng = random.Random(4)
    rows = [(rng.randrange(40_000), rng.choice("ab")) for _ in range(60_000)]
    df = spark.createDataFrame(rows, "k int, s string").repartition(5)
    found = sorted(tuple(row) for row in op.dedup_few(df, bits).collect())
    assert found == sorted(set(rows))


def test_equal_rows_of_any_kind_share_a_bit(spark):
    nan = float("nan")
    rows = [(1, 0.0, ["a"], None), (1, -0.0, ["a"], None), (2, nan, None, "x"), (2, nan, None, "x")]
    rows += [(None, None, None, None)] * 3 + [(3, 1.0, [], "")]
    df = spark.createDataFrame(rows, "`a.b` int, d double, l array<string>, bucket string")
    assert op.dedup_few(df).count() == op.dedup_rows(df).count() == 4
    assert op.dedup_few(df).columns == df.columns
    assert op.dedup_few(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="multiple"):
        op.dedup_few(df, 1000)


def test_every_repeated_hash_and_no_other_is_marked(spark):
    hashes = spark.createDataFrame([(h,) for h in [1, 1, 2, 32_767, 32_767, 32_768, 32_768, 65_535, 0, 0, -1, -1]], "h long")
    bitmaps = {r.bucket: bytes(r.bitmap) for r in op.repeated_hashes(hashes, 65_536).collect()}
    marked = set()
    for bucket, bitmap in bitmaps.items():
        for at in range(32_768):
            if bitmap[at // 8] >> at % 8 & 1:
                marked.add((bucket, at))
    places = spark.createDataFrame([(1,), (32_767,), (32_768,), (0,), (65_535,)], "p long")
    wanted = places.select(F.bitmap_bucket_number("p"), F.bitmap_bit_position("p")).collect()
    assert marked == {tuple(row) for row in wanted}
