from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiermill.llm import negatives as ng

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank int, list string"


def brute(rows, every=100):
    kept = [
        (key, [math.floor(256 * float(np.float32(x))) for x in vector], label)
        for key, vector, label in rows
        if label is not None
        and vector is not None
        and all(x is not None and math.isfinite(x) for x in vector)
    ]
    kept = [
        (key, v, (label + 1) % 10 if key is not None and key % 7 == 0 else label)
        for key, v, label in kept
    ]
    last = 1 << 63
    found = []
    for at, (key, vector, label) in enumerate(kept):
        if key is None or key % every:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(vector, v)), last if k is None else k, own == label)
            for other, (k, v, own) in enumerate(kept)
            if other != at
        )
        for high, positive, _ in [s for s in scored if s[2]][:5]:
            fitting = [s for s in scored if not s[2] and 80 * -high <= 100 * -s[0] <= 100 * -high]
            for rank, (low, negative, _) in enumerate(fitting[:5], 1):
                ids = [None if x == last else x for x in (positive, negative)]
                found.append((key, ids[0], rank, ids[1], -high, -low))
    return sorted(found, key=repr)


def ours(spark, rows, **options):
    frame = spark.createDataFrame([(*row, 0.5, 1, "x") for row in rows], SCHEMA)
    flipped = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = ng.hard_negatives(frame, flipped, **options).collect()
    return sorted(
        (
            (r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score)
            for r in found
        ),
        key=repr,
    )


def vectors(count, seed, depth=16, grain=None):
    rng = np.random.default_rng(seed)
    found = rng.normal(0.1, 0.2, (count, depth))
    if grain:
        found = np.round(found / grain) * grain
    return found.astype(np.float32).tolist()


@pytest.mark.parametrize("count, grain, every", [(3, None, 1), (400, None, 10), (400, 0.25, 10), (30, None, 1)])
def test_rows_are_those_of_brute_force(spark, count, grain, every):
    rng = random.Random(count)
    rows = [(at, v, rng.randrange(4)) for at, v in enumerate(vectors(count, 3, grain=grain))]
    rng.shuffle(rows)
    assert ours(spark, rows, every=every) == brute(rows, every)


def test_small_blocks_and_sets_of_anchors(spark, monkeypatch):
    monkeypatch.setattr(ng, "BLOCK", 16)
    monkeypatch.setattr(ng, "STEP", 3)
    rows = [(at, v, at % 5) for at, v in enumerate(vectors(150, 5, grain=0.125))]
    assert ours(spark, rows, every=10, anchors_at_once=4) == brute(rows, 10)


def test_nulls_repeats_and_what_is_not_finite(spark):
    base = vectors(60, 7, grain=0.25)
    rows = [(at % 40, v, None if at % 9 == 4 else at % 3) for at, v in enumerate(base)]
    rows += [(0, base[0], 0), (None, base[3], 1), (None, base[4], 2), (99, None, 1), (-10, base[8], 1)]
    for odd in (None, float("nan"), float("inf"), float("-inf")):
        rows.append((100, [odd, *base[1][1:]], 1))
    assert ours(spark, rows, every=10) == brute(rows, 10)


def test_nothing_to_find(spark):
    assert ours(spark, []) == []
    assert ours(spark, [(1, None, 2)]) == []
    assert ours(spark, [(0, [0.5, 0.5], 2)]) == []
    assert ours(spark, [(0, [-0.5, 0.5], 1), (1, [0.5, -0.5], 2), (2, [0.5, 0.5], 2)], every=1) == []


def test_vectors_that_do_not_fit_are_refused(spark):
    with pytest.raises(ValueError):
        ours(spark, [(1, [0.5] * 8, 1), (2, [0.5] * 16, 1)])
    with pytest.raises(ValueError):
        ours(spark, [(1, [1e9] * 8, 1)])


def test_products_are_exact():
    rng = np.random.default_rng(4)
    left = rng.integers(-(1 << 20), 1 << 20, (20, 64))
    right = rng.integers(-(1 << 20), 1 << 20, (30, 64))
    largest = int((1 << 40) * 64)
    primes = ng.primes_for(64, largest)
    assert math.prod(primes) > 2 * largest + 1
    assert all(64 * (p // 2) ** 2 <= 1 << 24 for p in primes)
    residues = ng.Residues(primes)
    found = residues.product(residues.split(left), residues.split(right))
    assert (found == left @ right.T).all()


def test_top_breaks_ties_by_column():
    scores = np.array([[3, 5, 5, ng.NONE, -7], [ng.NONE] * 5, [0, 0, 0, 0, 0]], np.int64)
    assert ng.top(scores, 3).tolist() == [[1, 2, 0], [-1, -1, -1], [0, 1, 2]]
    assert ng.top(scores, 8)[0].tolist() == [1, 2, 0, 4, -1]
