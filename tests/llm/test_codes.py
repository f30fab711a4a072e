from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from tiermill.llm import codes as cd

SCHEMA = "vec_id long, embedding array<float>, label int, code string, block long"


def brute(rows, parts=8, entries=16, rounds=6):
    kept = [
        (key, [math.floor(4096 * float(np.float32(x))) for x in vector], label)
        for key, vector, label in rows
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    ]
    if not kept:
        return []
    depth = len(kept[0][1]) // parts
    cut = [[v[p * depth : (p + 1) * depth] for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0], kept[i][1]))
    books = [[cut[i][p] for i in order[:entries]] for p in range(parts)]

    def nearest(book, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = [[] for _ in books[p]]
            for one in cut:
                members[nearest(books[p], one[p])[1]].append(one[p])
            books[p] = [
                [sum(x) // len(own) for x in zip(*own)] if own else entry
                for own, entry in zip(members, books[p])
            ]
    found = []
    for one in cut:
        hits = [nearest(books[p], one[p]) for p in range(parts)]
        found.append(("".join(f"{e:02x}" for _, e in hits), sum(d for d, _ in hits)))
    total = {}
    for (_, _, label), (_, error) in zip(kept, found):
        total[label] = total.get(label, 0) + error
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return sorted(
        [(key, code, error, total[label], digest) for (key, _, label), (code, error) in zip(kept, found)],
        key=repr,
    )


def ours(spark, rows, **options):
    frame = spark.createDataFrame([(*row, "x", 1) for row in rows], SCHEMA)
    found = cd.vector_codes(frame, **options).collect()
    return sorted(
        ((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in found), key=repr
    )


def vectors(count, seed, depth=16, grain=None):
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 0.2, (7, depth))
    found = centers[rng.integers(0, 7, count)] + rng.normal(0, 0.05, (count, depth))
    if grain:
        found = np.round(found / grain) * grain
    return found.astype(np.float32).tolist()


@pytest.mark.parametrize("count, grain", [(5, None), (16, None), (300, None), (300, 0.1)])
def test_codes_are_those_of_brute_force(spark, count, grain):
    rng = random.Random(count)
    rows = [(at, v, rng.choice([None, 1, 2, 3])) for at, v in enumerate(vectors(count, 3, grain=grain))]
    rng.shuffle(rows)
    assert ours(spark, rows) == brute(rows)


def test_small_blocks_and_wide_codebooks(spark, monkeypatch):
    monkeypatch.setattr(cd, "BLOCK", 32)
    rows = [(at, v, at % 3) for at, v in enumerate(vectors(200, 5))]
    assert ours(spark, rows, parts=4, entries=40, rounds=9) == brute(rows, 4, 40, 9)


def test_nulls_repeats_and_what_is_not_finite(spark):
    base = vectors(40, 7)
    rows = [(at % 30, v, None if at % 4 else 0) for at, v in enumerate(base)]
    rows += [(0, base[0], 0), (None, base[3], 1), (None, base[4], 1), (99, None, 1)]
    for odd in (None, float("nan"), float("inf"), float("-inf")):
        rows.append((100, [odd, *base[1][1:]], 1))
    assert ours(spark, rows) == brute(rows)


def test_nothing_kept(spark):
    assert ours(spark, []) == []
    assert ours(spark, [(1, None, 2)]) == []


def test_shapes_that_do_not_fit_are_refused(spark):
    with pytest.raises(ValueError):
        ours(spark, [(1, [0.5] * 8, 1), (2, [0.5] * 16, 1)])
    with pytest.raises(ValueError):
        ours(spark, [(1, [0.5] * 9, 1)])
    with pytest.raises(ValueError):
        ours(spark, [(1, [1e9] * 8, 1)])


def test_bounds_spare_most_distances(monkeypatch):
    """After some rounds most parts keep their entry without any distance, and lists get short."""
    rng = np.random.default_rng(1)
    points = np.rint(rng.normal(0, 400, (12, 4))[rng.integers(0, 12, 2000)] + rng.normal(0, 9, (2000, 4)))
    points = points.astype(np.int64)
    book = points[:16].copy()
    known, seen = cd.Bounds.measured(points, book, 4), []
    plain = cd._squares
    monkeypatch.setattr(cd, "_squares", lambda p, b, e: seen.append(e.size) or plain(p, b, e))
    for _ in range(12):
        own = np.array([points[known.entry == e].sum(0) // max(1, (known.entry == e).sum()) for e in range(16)])
        moves = np.sqrt(((own - book) ** 2).sum(1).astype(float)) * (1 + 1e-9)
        book = own
        seen.clear()
        known.moved(moves)
        known = known.assign(points, book)
        right = ((points[:, None] - book) ** 2).sum(2).argmin(1)
        assert (known.entry == right).all()
    assert sum(seen) < 2000 * 16 / 20
    assert known.near.shape[1] < 4


def test_lists_grow_where_all_entries_are_measured_often():
    rng = np.random.default_rng(2)
    points = rng.integers(-100, 100, (500, 3))
    book = points[:16].copy()
    known = cd.Bounds.measured(points, book, 1)
    book = rng.integers(-100, 100, (16, 3))
    known.moved(np.full(16, 400.0))
    known = known.assign(points, book)
    assert known.near.shape[1] == 2
    assert (known.entry == ((points[:, None] - book) ** 2).sum(2).argmin(1)).all()
