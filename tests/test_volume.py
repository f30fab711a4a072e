"""What duplicate removals and pipelines move: only rows that share a key, and packed files."""

import os
import random
import time

import pytest

from checks import queries as catalog
from checks import star
from tests.plans import physical_plan
from tests.test_dedup import shuffled_bytes
from tiermill import operators as op
from tiermill.plans import layers
from tiermill.sources import sizing


@pytest.fixture
def raw(spark, sf_dir, tmp_path):
    path = str(tmp_path / "raw")
    star.raw_orders(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def same_rows(one, other):
    return one.exceptAll(other).count() == other.exceptAll(one).count() == 0


@pytest.mark.parametrize("bits", [32_768, 1 << 20])
def test_few_by_key_keeps_the_same_rows(spark, bits):
    rng = random.Random(8)
    rows = [
        (rng.choice([None, *range(40_000)]), rng.choice([None, 1, 2]), rng.choice("abc"), float(at % 7))
        for at in range(30_000)
    ]
    df = spark.createDataFrame(rows, "k int, m int, s string, x double").repartition(4)
    assert same_rows(op.dedup_by_key(df, ["k", "m"], ["x"], bits), op.dedup_by_key(df, ["k", "m"], ["x"]))
    assert same_rows(op.dedup_few(df, bits, ["k"]), op.dedup_rows(df))


def test_rows_are_split_by_whether_their_key_is_repeated(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, s string")
    alone, repeated = op.split_repeated(df, ["k"])
    assert [row.s for row in alone.collect()] == ["c"]
    assert sorted(row.s for row in repeated.collect()) == ["a", "b", "d", "e"]


def test_every_bit_of_a_bitmap_is_found(spark):
    bits = op.dedup.BITMAP_SIZE * 2
    rows = spark.range(-bits, bits).select(op.dedup.F.col("id").alias("h"))
    marked = rows.filter("pmod(h, 3) = 0 or pmod(h, 32) = 31")
    seen = op.with_seen(rows, op.dedup.F.col("h"), op.hash_bitmaps(marked, bits), bits, "seen")
    wanted = {row.h % bits for row in marked.collect()}
    assert all(row.seen == (row.h % bits in wanted) for row in seen.collect())


def test_silver_from_raw_rows_is_that_of_bronze_and_moves_less(raw):
    plain, few = layers.silver_orders(layers.bronze_orders(raw)), layers.raw_silver_orders(raw)
    assert same_rows(plain, few) and few.columns == plain.columns
    assert shuffled_bytes(few)[0] < shuffled_bytes(plain)[0] * 0.6


def test_silver_of_stored_bronze_moves_less(spark, raw, tmp_path):
    path = str(tmp_path / "bronze")
    layers.bronze_orders(raw).write.parquet(path)
    stored = spark.read.parquet(path)
    few, plain = layers.silver_orders(stored), layers.finished_orders(layers.order_winners(stored))
    assert same_rows(plain, few)
    assert shuffled_bytes(few)[0] < shuffled_bytes(plain)[0] * 0.8


def test_marts_read_orders_that_move_less(spark, sf_dir):
    silver = catalog.silver(spark, sf_dir)
    plain = layers.silver_orders(layers.bronze_orders(star.raw_orders(spark, sf_dir)))
    assert same_rows(silver, plain)
    assert shuffled_bytes(silver)[0] < shuffled_bytes(plain)[0] * 0.6


def test_csv_inputs_are_packed(spark, sf_dir, tmp_path):
    path = catalog.orders_csv(spark, sf_dir, str(tmp_path))
    names = [row.path for row in spark.read.format("binaryFile").load(path).select("path").collect()]
    assert names and all(name.endswith(".gz") for name in names)


def test_zeros_have_no_sign_in_rows_that_stay(raw):
    half = op.dedup.F.expr("if(order_id % 2 = 0, -0D, 1.5D)")
    signed = raw.withColumn("longitude", half)
    for one in (layers.bronze_orders(signed, op.BITMAP_BITS), layers.raw_silver_orders(signed)):
        shown = {row[0] for row in one.selectExpr("cast(longitude AS string)").distinct().collect()}
        assert shown == {"0.0", "1.5"}
        assert one.filter("longitude = 0 and cast(longitude AS string) = '-0.0'").count() == 0


def test_buckets_read_from_buckets_are_not_dealt_again(spark, raw, tmp_path, monkeypatch):
    from tiermill.plans import late

    dealt, plain = [], late.replace_buckets
    monkeypatch.setattr(late, "replace_buckets", lambda *a, **k: dealt.append(k.get("dealt", False)) or plain(*a, **k))
    bronze = layers.bronze_orders(raw)
    late.add_orders(bronze, str(tmp_path / "late"), buckets=4)
    assert dealt == [False, True]
    assert same_rows(late.orders_of(spark, str(tmp_path / "late")), layers.silver_orders(bronze))


def test_an_order_file_is_parsed_once_and_its_rows_stay(spark, sf_dir, tmp_path):
    path = catalog.orders_csv(spark, sf_dir, str(tmp_path))
    raw = catalog.read_orders_csv(spark, path)
    plain, few = layers.bronze_orders(raw), catalog._bronze_of_file(raw)
    assert same_rows(plain, few) and few.dtypes == plain.dtypes
    assert "csv" not in few._jdf.queryExecution().executedPlan().toString().lower()
    assert shuffled_bytes(few)[0] < shuffled_bytes(plain)[0] * 0.3
    assert layers.order_accounts(raw).collect() == layers.order_accounts(raw, few).collect()


def test_bitmaps_are_broadcast_in_short_pieces(spark):
    rows = spark.range(1000).select(op.dedup.F.xxhash64("id").alias("h"))
    told = op.with_seen(rows, op.dedup.F.col("h"), op.hash_bitmaps(rows.limit(10)), op.BITMAP_BITS, "seen")
    assert told.filter("seen").count() == 10
    pieces = op.dedup._pieces(op.dedup.F.col("bucket"), op.dedup.F.col("bitmap"))
    sizes = op.hash_bitmaps(rows).select(op.dedup.F.explode(pieces).alias("p")).selectExpr("length(p.__row_bitmap)")
    assert {row[0] for row in sizes.distinct().collect()} == {op.dedup.PIECE_BITS // 8}


def test_sums_and_sets_of_ids_apart_give_the_same_marts(spark, raw):
    from tiermill.plans import gold

    silver = layers.silver_orders(layers.bronze_orders(raw))
    parts = [silver.filter(f"pmod(order_id, 3) = {at}") for at in range(3)]
    for name, mart in gold.MARTS.items():
        apart = [part.transform(mart.state, apart=True) for part in parts]
        mixed = [apart[0], parts[1].transform(mart.state), apart[2]]
        wanted = mart.build(silver, ordered=False)
        for states in (apart, mixed, [mart.merged(apart[:2]), apart[2]]):
            assert same_rows(mart.finished(mart.merged(states), ordered=False), wanted)
    wide = gold.MARTS["kpi_summary"].state(silver, apart=True)
    assert wide.filter("order_id__rows IS NOT NULL").count() == silver.select("market", "category_name").distinct().count()


def test_large_parts_join_before_orders_and_places_last(spark, sf_dir):
    key, rows = "spark.sql.autoBroadcastJoinThreshold", {}
    before = spark.conf.get(key)
    for most in (5000, 1 << 20):
        spark.conf.set(key, str(most))
        try:
            raw = star.raw_orders(spark, sf_dir)
            plan = raw._jdf.queryExecution().optimizedPlan().toString()
            at = [plan.index(f"Relation [{name}") for name in ("l_orderkey", "p_partkey", "o_orderkey", "n_nationkey")]
            assert (at == sorted(at)) == (most == 5000) and max(at) == at[-1]
            hashes = raw.select(op.dedup.F.xxhash64(*raw.columns).cast("decimal(38,0)").alias("h"))
            rows[most] = tuple(hashes.selectExpr("count(*)", "sum(h)").first())
        finally:
            spark.conf.set(key, before)
    assert len(set(rows.values())) == 1


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name}


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    from tiermill.sources import write_layer

    before, rows = shuffle_files(spark), spark.range(50_000).selectExpr("id % 7777 AS k").groupBy("k").count()
    write_layer(rows, str(tmp_path), "raw", "counts")
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left


def test_the_setting_for_shuffle_files_comes_back_after_the_last_block(spark):
    before = spark.conf.get(sizing.SHUFFLE_CLEANUP)
    first, second = sizing.shuffles_dropped(spark), sizing.shuffles_dropped(spark)
    first.__enter__(), second.__enter__(), first.__exit__(None, None, None)
    assert spark.conf.get(sizing.SHUFFLE_CLEANUP) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(sizing.SHUFFLE_CLEANUP) == before and not sizing._cleanup


def test_a_csv_run_parses_its_orders_once(spark, sf_dir, tmp_path, monkeypatch):
    from tiermill.plans import pipeline

    given, plain = [], pipeline.bronze_orders
    monkeypatch.setattr(pipeline, "bronze_orders", lambda rows, bits: given.append(rows) or plain(rows, bits))
    path = catalog.orders_csv(spark, sf_dir, str(tmp_path))
    pipeline.run_csv_pipeline(spark, path, None, str(tmp_path / "lake"))
    assert len(given) == 1 and layers.is_stored(given[0])
    assert sorted(one.name for one in (tmp_path / "lake").iterdir()) == ["bronze", "gold", "silver"]
    assert same_rows(catalog.read_layer(spark, str(tmp_path / "lake"), "bronze", "orders"), layers.bronze_orders(catalog.read_orders_csv(spark, path)))


def test_orders_are_added_from_stored_bronze_and_raw_rows_go(spark, sf_dir, monkeypatch):
    folders, given, plain = [], [], catalog.add_orders
    monkeypatch.setattr(catalog, "work_folder", lambda s, to, f=catalog.work_folder: folders.append(f(s, to)) or folders[-1])
    monkeypatch.setattr(catalog, "add_orders", lambda rows, *a, **k: given.append(rows) or plain(rows, *a, **k))
    rows = catalog.silver_orders_from_loads(spark, sf_dir)
    assert len(given) == 3 and all(layers.is_stored(one) for one in given)
    assert rows.count() == layers.silver_orders(layers.bronze_orders(star.raw_orders(spark, sf_dir))).count()
    catalog.layers_from_tables(spark, sf_dir)
    raw = [path for path in folders if "/raw-orders-" in path]
    assert len(raw) == 2 and not any(os.path.exists(path) for path in raw)


def test_rejects_parse_the_file_for_counts_only(spark, sf_dir):
    tree = physical_plan(catalog.order_rejects_from_csv(spark, sf_dir)).split("\n\n")[0]
    assert tree.count("Scan csv") == 2
