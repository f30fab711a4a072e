from __future__ import annotations

import random

import pytest
import xxhash

from tests.plans import physical_plan
from tiermill.llm import simhash as sh
from tiermill.llm.components import components


def plain_fingerprint(text, size=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    parts = [b" ".join(words[at : at + size]) for at in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(part, seed=42) for part in parts]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    """Least member reachable, by plain search."""
    found = {}
    for start in sorted(nodes):
        if start in found:
            continue
        edge, found[start] = [start], start
        while edge:
            one = edge.pop()
            for other in nodes:
                if other not in found and linked(one, other):
                    found[other] = start
                    edge.append(other)
    return found


def test_fingerprints_of_hard_texts(make_docs, hard_texts, prose):
    texts = hard_texts + prose(20, 500, seed=3) + ["A b C", "ÀB c d e"]
    rows = sh.fingerprints(make_docs(texts)).orderBy("doc_id").collect()
    assert [row.fp & (2**64 - 1) for row in rows] == [plain_fingerprint(text) for text in texts]


@pytest.mark.parametrize("radius", [1, 3, 4])
def test_some_mask_hides_any_few_bits(radius):
    masks = sh.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    rng = random.Random(1)
    for _ in range(20_000):
        bits = sum(1 << bit for bit in rng.sample(range(64), rng.randint(1, radius)))
        assert any(mask & bits == 0 for mask in masks)


@pytest.mark.parametrize("bucket", [sh.BUCKET, 3])
def test_links_join_what_all_pairs_join(spark, bucket):
    rng = random.Random(7)
    centres = [rng.getrandbits(64) for _ in range(6)]
    values = {0, 3}
    for centre in centres:
        for _ in range(25):
            flips = sum(1 << bit for bit in rng.sample(range(64), rng.randint(0, 7)))
            values.add(centre ^ flips)
    values |= {rng.getrandbits(64) for _ in range(60)}
    signed = {value: sh._signed(value) for value in values}
    nodes = spark.createDataFrame([(fp,) for fp in signed.values()], "fp long")
    edges = sh.links(nodes, 4, bucket)
    found = {row.node: row.root for row in components(edges).collect()}
    wanted = groups(set(signed.values()), lambda a, b: (a ^ b).bit_count() <= 4 or ((a ^ b) & (2**64 - 1)).bit_count() <= 4)
    assert {fp: found.get(fp, fp) for fp in signed.values()} == wanted


def test_exploded_rows_are_not_broadcast(spark, tmp_path, monkeypatch):
    path, plans, kept = str(tmp_path / "nodes"), [], sh.stored
    spark.range(500).selectExpr("id * 3 AS fp").write.parquet(path)
    monkeypatch.setattr(sh, "stored", lambda df, to: plans.append(physical_plan(df)) or kept(df, to))
    edges = sh.links(spark.read.parquet(path), 4, 100)
    assert len(plans) == 1 and "BroadcastExchange" not in plans[0] and "SortMergeJoin" in plans[0]
    tree = physical_plan(edges).split("\n\n")[0]
    # The masks' flips are broadcast, to either side of the join of midpoints; that join is none.
    assert tree.count("SortMergeJoin") == 1 and tree.count("BroadcastHashJoin") == 2
    assert edges.filter("u <> v").count() > 0


def test_components_of_long_paths_and_stars(spark):
    rng = random.Random(2)
    path = list(range(200))
    rng.shuffle(path)
    pairs = list(zip(path, path[1:])) + [(1000, n) for n in range(1001, 1100)] + [(5000, 5000)]
    pairs += [(2000, 2001), (2001, 2000), (2000, 2001)]
    found = {row.node: row.root for row in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    wanted = dict.fromkeys(path, 0) | dict.fromkeys(range(1000, 1100), 1000) | {2000: 2000, 2001: 2000}
    assert found == wanted
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def near_texts(prose):
    base = prose(3, 400, seed=12)
    words = base[0].split()
    near = [" ".join(words[:at] + ["odd"] + words[at + 1 :]) for at in (10, 200, 390)]
    return [*base, *near, base[1], None, "", " "]


def test_documents_are_grouped_as_brute_force_does(make_docs, prose, hard_texts):
    texts = near_texts(prose) + hard_texts
    rows = sh.near_duplicates(make_docs(texts)).collect()
    prints = {at: plain_fingerprint(text) for at, text in enumerate(texts)}
    wanted = groups(set(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert {row.doc_id: row.component_id for row in rows} == wanted


def test_one_document_of_each_group_stays(make_docs, prose):
    texts = near_texts(prose)
    rows = [(at + 10, text) for at, text in enumerate(texts)]
    # The same row again, the least id again with another text, and a group without ids.
    rows += [(10, texts[0]), (11, "quite another text of its own"), (None, "no id here at all"), (None, "no id here at all")]
    docs = make_docs(rows)
    kept = sh.representatives(docs)
    assert kept.columns == docs.columns
    prints = [plain_fingerprint(text) for _, text in rows]
    root = groups(set(range(len(rows))), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert len(found) == len(set(root.values()))
    for group in set(root.values()):
        members = [rows[at] for at in root if root[at] == group]
        least = min((key for key, _ in members if key is not None), default=None)
        assert sum((key, text) in members and key == least for key, text in found) >= 1


def test_empty_table(make_docs):
    assert sh.near_duplicates(make_docs([])).count() == 0
    assert sh.representatives(make_docs([])).count() == 0
