from __future__ import annotations

import random

import duckdb
import pytest

from tiermill.llm.lines import dedup_lines
from tiermill.llm.queries import LINES_SQL


def brute(rows, run=3):
    """First occurrences of line windows keep their lines; other covered lines go."""
    full = {}
    for key, text in rows:
        lines = (text or "").split("\n")
        full[key] = [at for at, line in enumerate(lines) if line.strip(" \t\n\x0b\x0c\r")]
    places = {}
    for key, text in sorted(rows, key=lambda row: row[0]):
        lines = (text or "").split("\n")
        for at in range(len(full[key]) - run + 1):
            window = full[key][at : at + run]
            places.setdefault(tuple(lines[i] for i in window), []).append((key, window))
    gone, kept = set(), set()
    for found in places.values():
        for nth, (key, window) in enumerate(found if len(found) > 1 else []):
            (kept if nth == 0 else gone).update((key, i) for i in window)
    cut = gone - kept
    return {
        key: None if text is None else "\n".join(line for i, line in enumerate(text.split("\n")) if (key, i) not in cut)
        for key, text in rows
    }


def random_rows(seed, kinds):
    rng = random.Random(seed)
    return [
        (key, "\n".join(rng.choice(kinds) for _ in range(rng.randint(0, 30)))) for key in range(30)
    ]


@pytest.mark.parametrize("kinds", ["ab", ["a", "b", "", " "], list(map(str, range(40))), ["x"]])
@pytest.mark.parametrize("run", [2, 3])
def test_random_lines(make_docs, kinds, run):
    rows = random_rows(len(kinds) * 10 + run, kinds)
    found = {row.doc_id: row.text for row in dedup_lines(make_docs(rows), run).collect()}
    assert found == brute(rows, run)


def test_the_sql_says_the_same(make_docs):
    rows = random_rows(77, ["a", "b", "c", "d", "", "\t"]) + [(100, "a\nb\nc"), (101, None), (102, "")]
    ours = {r.doc_id: (r.n_lines, r.n_removed) for r in dedup_lines(make_docs(rows)).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert ours == {r[0]: (r[1], r[2]) for r in con.execute(LINES_SQL).fetchall()}


def test_columns_nulls_and_equal_rows(make_docs, hard_texts):
    run = "l1\nl2\nl3\nl4"
    rows = [(1, run), (1, run), (2, f"x\n{run}\ny"), (None, run), (None, None), (3, None), (3, "l1\nl2")]
    rows += [(50 + at, text) for at, text in enumerate(hard_texts)]
    docs = make_docs(rows)
    found = dedup_lines(docs)
    assert set(docs.columns) <= set(found.columns) and found.count() == len(rows)
    texts = {(r.doc_id, r.text) for r in found.collect()}
    # A null id comes first, so it keeps the run; the equal rows of document 1 lose it both.
    assert {(None, run), (1, ""), (2, "x\ny"), (3, None), (3, "l1\nl2"), (None, None)} <= texts


def test_a_hot_run_and_an_empty_table(make_docs):
    rows = [(key, f"top {key}\nh1\nh2\nh3\nend {key}") for key in range(300)]
    found = {row.doc_id: row.n_removed for row in dedup_lines(make_docs(rows)).collect()}
    assert found == {key: 0 if key == 0 else 3 for key in range(300)}
    assert dedup_lines(make_docs([])).count() == 0


def test_no_python_in_the_plan(make_docs):
    plan = dedup_lines(make_docs(["a\nb\nc"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_words(rows, run, words):
    """As `brute`, with windows of fewer lines that have enough words."""
    places = {}
    for key, text in sorted(rows, key=lambda row: row[0]):
        lines = text.split("\n")
        full = [at for at, line in enumerate(lines) if line.split()]
        for size in range(1, run + 1):
            for at in range(len(full) - size + 1):
                window = [lines[i] for i in full[at : at + size]]
                if size == run or sum(len(line.split()) for line in window) >= words:
                    places.setdefault(tuple(window), []).append((key, full[at : at + size]))
    gone, kept = set(), set()
    for found in places.values():
        for nth, (key, window) in enumerate(found if len(found) > 1 else []):
            (kept if nth == 0 else gone).update((key, i) for i in window)
    cut = gone - kept
    return {
        key: "\n".join(line for i, line in enumerate(text.split("\n")) if (key, i) not in cut) for key, text in rows
    }


def test_small_bitmaps_only_move_more(make_docs):
    rows = random_rows(9, ["a", "b c", "", *map(str, range(40))])
    found = {r.doc_id: r.text for r in dedup_lines(make_docs(rows), words=2, bits=32_768).collect()}
    assert found == brute_words(rows, 3, 2)


def test_hot_fingerprints_and_names_are_not_joined_on(make_docs):
    """The only join that moves rows is that of texts that lose lines with their own results."""
    plan = dedup_lines(make_docs(["a\nb\nc"] * 5), words=50)._jdf.queryExecution().optimizedPlan().toString()
    assert "mark" not in plan and "name_a" not in plan


def test_long_passages_of_one_or_two_lines_go(make_docs):
    one, half = " ".join(f"w{k}" for k in range(300)), " ".join(f"v{k}" for k in range(30))
    rows = [(key, f"top {key}\n{one}\nend {key}") for key in range(100)]
    rows += [(100 + key, f"{half}\n\n{half} more") for key in range(50)] + [(200, one), (201, "short"), (202, "short")]
    found = {row.doc_id: row.n_removed for row in dedup_lines(make_docs(rows), words=50).collect()}
    removed = {key: 1 for key in (*range(1, 100), 200)} | {key: 2 for key in range(101, 150)}
    assert found == {key: 0 for key, _ in rows} | removed


@pytest.mark.parametrize("run", [2, 3])
def test_random_lines_with_words(make_docs, run):
    rows = random_rows(run, ["a", "b c", "d e f", "", "g h i j k", *map(str, range(20))])
    found = {row.doc_id: row.text for row in dedup_lines(make_docs(rows), run, words=5).collect()}
    assert found == brute_words(rows, run, 5)
