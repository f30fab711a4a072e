from __future__ import annotations

import random
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from tiermill.llm.hilbert import hilbert_index, hilbert_shards, write_in_curve_order


@pytest.mark.parametrize("dims, bits", [(2, 1), (2, 4), (3, 2), (3, 3), (4, 2), (1, 3)])
def test_the_curve_visits_every_cell_by_unit_steps(spark, dims, bits):
    cells = list(product(range(2**bits), repeat=dims))
    names = [f"x{k}" for k in range(dims)]
    df = spark.createDataFrame(cells, ", ".join(f"{name} long" for name in names))
    rows = df.select(*names, hilbert_index([F.col(name) for name in names], bits).alias("at")).collect()
    path = sorted(rows, key=lambda row: row.at)
    assert [row.at for row in path] == list(range(len(cells)))
    for one, two in zip(path, path[1:]):
        assert sum(abs(one[name] - two[name]) for name in names) == 1


def check(rows, shards, total):
    assert len(rows) == total
    counts = [0] * shards
    for row in rows:
        counts[row.shard] += 1
    assert max(counts) - min(counts) <= 1
    for shard in range(shards):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(counts[shard]))


@pytest.mark.parametrize("group_rows", [4096, 7])
def test_shards_are_even_and_follow_the_curve(spark, sf_dir, group_rows):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = hilbert_shards(docs, 24, group_rows=group_rows).collect()
    texts = {row.doc_id: row.text for row in docs.collect()}
    check(rows, 24, len(texts))
    for row in rows:
        raw = texts[row.doc_id].encode()
        assert (row.size, row.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
    # Shards are runs of the curve.
    ordered = sorted(rows, key=lambda row: (row.shard, row.slot))
    assert [r.place for r in ordered] == sorted(r.place for r in ordered)


def test_shards_are_compact_in_each_dimension(spark):
    rng = random.Random(4)
    langs = [f"l{k:02}" for k in range(16)]
    rows = [(at, "t", rng.choice(langs), f"s{rng.randrange(16):02}", rng.randrange(10_000)) for at in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = hilbert_shards(docs, 32).join(docs, "doc_id").groupBy("shard").agg(
        F.countDistinct("lang").alias("lang"), F.countDistinct("source").alias("source"), F.countDistinct("n_chars").alias("n")
    )
    means = found.agg(F.avg("lang"), F.avg("source")).first()
    # Random shards would hold all sixteen values of both.
    assert max(means) < 9


def test_nulls_ties_equal_rows_and_odd_columns(make_docs, hard_texts):
    rows = [(None, None), (None, None), (1, "a"), (1, "a"), *((at, t) for at, t in enumerate(hard_texts))]
    docs = make_docs(rows, langs=[None, "", "é", "zz"] + ["en"] * len(hard_texts))
    found = hilbert_shards(docs, 4).collect()
    check(found, 4, len(rows))
    assert sorted(r.size for r in found if r.doc_id is None) == [8, 8]
    assert {r.text_crc32 for r in found if r.doc_id is None} == {0}


def test_one_hot_place_is_split(make_docs):
    docs = make_docs(["same"] * 500)
    found = hilbert_shards(docs, 24, group_rows=16)
    check(found.collect(), 24, 500)


def test_empty_table_and_limits(make_docs):
    assert hilbert_shards(make_docs([])).count() == 0
    with pytest.raises(ValueError, match="bits"):
        hilbert_shards(make_docs([]), bits=6)


def test_no_python_in_the_plan(make_docs):
    plan = hilbert_shards(make_docs(["a"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_few_values_are_spread_over_the_curve(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = hilbert_shards(docs, 24).join(docs, "doc_id").groupBy("shard").agg(
        F.countDistinct("lang").alias("lang"), F.countDistinct("source").alias("source")
    )
    langs, sources = found.agg(F.avg("lang"), F.avg("source")).first()
    assert langs <= 2 and sources <= 10


def test_files_in_curve_order_prune_by_each_dimension(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    path = write_in_curve_order(docs, str(tmp_path / "t"))
    stored = spark.read.parquet(path)
    assert stored.columns == docs.columns and stored.exceptAll(docs).count() == docs.exceptAll(stored).count() == 0
    ranges = stored.groupBy(F.col("_metadata.file_path").alias("f")).agg(
        *[f(c).alias(f"{c}_{f.__name__}") for c in ("lang", "source", "n_chars") for f in (F.min, F.max)],
        F.count("*").alias("n"),
    ).collect()
    assert len(ranges) == 24 and max(r.n for r in ranges) < 3 * docs.count() / 24

    def met(column, low, high):
        return sum(r[f"{column}_min"] <= high and r[f"{column}_max"] >= low for r in ranges)

    langs = sorted(r.lang for r in docs.select("lang").distinct().collect())
    sources = sorted(r.source for r in docs.select("source").distinct().collect())
    assert sum(met("lang", x, x) for x in langs) / len(langs) < 16
    assert sum(met("source", x, x) for x in sources) / len(sources) < 14
    small, large = docs.approxQuantile("n_chars", [0.05, 0.95], 0.001)
    assert met("n_chars", 0, small) < 14 and met("n_chars", large, 10**9) < 14
