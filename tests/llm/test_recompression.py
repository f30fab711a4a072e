from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiermill.llm import recompression as rc


def brute(rows, window):
    """The contract, word for word."""
    split = [(key, (text or "").encode().split()) for key, text in rows]
    seen = Counter(
        tuple(words[at : at + window]) for _, words in split for at in range(len(words) - window + 1)
    )
    found = []
    for key, words in split:
        gone = [False] * len(words)
        for at in range(len(words) - window + 1):
            if seen[tuple(words[at : at + window])] > 1:
                gone[at : at + window] = [True] * window
        kept = b" ".join(word for word, out in zip(words, gone) if not out)
        found.append((key, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=repr)


def ours(docs, window):
    rows = rc.remove_repeats(docs, window).collect()
    return sorted(
        ((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=repr
    )


def corpus(seed, letters, sizes, count):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(letters) for _ in range(rng.choice(sizes))) for _ in range(count)]
    for _ in range(count // 2):
        words = rng.choice(texts).split()
        at = rng.randrange(max(1, len(words)))
        piece = words[at : at + rng.randint(1, 90)]
        into = rng.randrange(count)
        host = texts[into].split()
        spot = rng.randrange(len(host) + 1)
        texts[into] = " ".join(host[:spot] + piece + host[spot:])
    return texts


@pytest.mark.parametrize("seed, letters, window", [(1, "ab", 12), (2, "abcdefgh", 35), (3, "a", 20), (4, list(map(str, range(400))), 35)])
def test_random_texts_lose_what_brute_force_says(make_docs, seed, letters, window):
    texts = corpus(seed, letters, [0, 5, 40, 150, 300], 24)
    rows = list(enumerate(texts))
    assert ours(make_docs(rows), window) == brute(rows, window)


def test_copies_near_copies_and_periods(make_docs, prose, hard_texts):
    base = prose(4, 220, seed=1)
    words = base[0].split()
    near = " ".join(words[:100] + ["changed"] + words[101:])
    period = " ".join(["x", "y", "z"] * 60)
    texts = [*base, base[1], near, near, period, " ".join(words[30:110]), *hard_texts]
    rows = list(enumerate(texts))
    assert ours(make_docs(rows), 35) == brute(rows, 35)


def test_a_hot_passage_between_unlike_neighbours(make_docs, prose):
    passage = prose(1, 50, seed=9)[0]
    rows = [
        (at, f"{a} {passage} {b}")
        for at, (a, b) in enumerate(zip(prose(60, 20, seed=10), prose(60, 20, seed=11)))
    ]
    found = ours(make_docs(rows), 35)
    assert found == brute(rows, 35)
    assert min(row[2] for row in found) == 50


def test_equal_ids_null_ids_and_equal_rows(make_docs, prose):
    a, b, c = prose(3, 80, seed=4)
    rows = [(1, a), (1, b), (1, b), (None, c), (None, f"{c} more"), (None, None), (2, "")]
    assert ours(make_docs(rows), 35) == brute(rows, 35)


def test_empty_table(make_docs):
    assert rc.remove_repeats(make_docs([])).count() == 0


def test_kept_text(make_docs, prose):
    a = prose(1, 60, seed=6)[0]
    rows = rc.remove_repeats(make_docs([f"x {a} y", a, "short"]), texts=True).orderBy("doc_id").collect()
    assert [row.kept for row in rows] == ["x y", "", None]


def test_equal_windows_choose_equal_anchors():
    """Whatever surrounds a window, its anchor is the same."""
    rng = random.Random(5)
    window = [rng.choice("abcd") for _ in range(35)]
    anchors = set()
    for _ in range(40):
        left = [rng.choice("abcd") for _ in range(rng.randint(0, 30))]
        right = [rng.choice("abcd") for _ in range(rng.randint(0, 30))]
        words = rc.Words(rc.split_words([" ".join(left + window + right)])[0], rc._Hashes())
        found = rc.blocks_of(words)
        at = int(np.searchsorted(found.first, len(left), side="right")) - 1
        assert found.first[at] <= len(left) <= found.last[at]
        anchors.add(int(found.anchor[at]))
    assert len(anchors) == 1


def test_least_place_in_ranges():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 6, 300).astype(np.uint64)
    low = rng.integers(0, 280, 200)
    last = np.minimum(299, low + rng.integers(0, 40, 200))
    wanted = [a + int(np.argmin(values[a : b + 1])) for a, b in zip(low, last)]
    assert rc._least(values, low, last).tolist() == wanted


def test_what_is_gathered_for_a_row_without_an_id_is_bounded_by_its_text(spark, make_docs, prose, monkeypatch):
    texts = prose(90, 70, seed=31)
    rows = [(None if at % 3 == 0 else at, text) for at, text in enumerate(texts)]
    sizes, plain = [], rc._lists

    def watched(found, value, *args, **options):
        made = plain(found, value, *args, **options)
        sizes.append(made.agg(F.max(F.size(made.columns[-1]))).first()[0])
        return made

    monkeypatch.setattr(rc, "_lists", watched)
    assert ours(make_docs(rows), 35) == brute(rows, 35)
    # A text of 70 words has 36 windows.
    assert max(size or 0 for size in sizes) <= 36
