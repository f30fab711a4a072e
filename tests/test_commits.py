"""Which write of a layer table counts: the last commit, by path and by name."""

from __future__ import annotations

import threading
import time

import pytest
from pyspark.sql import functions as F

from tiermill import sources as src
from tiermill.sources import tables


def state(spark, root, name):
    """Rows of the table by path and by name; both must come from one folder."""
    path = src.layer_path(root, "silver", "t")
    spark.catalog.refreshTable(name)
    files = {f.rsplit("/", 1)[0].split("/silver/t/")[1] for f in spark.table(name).inputFiles()}
    assert files == {src.current_path(spark, path).split("/silver/t/")[1]}
    by_path = src.read_layer(spark, root, "silver", "t").count()
    assert by_path == spark.table(name).count()
    return by_path


@pytest.fixture
def lake(spark, tmp_path):
    """A root, a table name, and a writer of that many rows."""
    root, name = str(tmp_path), f"commits_{tmp_path.name}".replace("-", "_")

    def write(rows):
        return src.write_layer(spark.range(rows), root, "silver", "t", table=name)

    yield root, name, write
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def runs(root):
    from pathlib import Path

    return sorted(path.name for path in Path(root, "silver/t").glob("run-*"))


def test_clocks_that_run_backwards_do_not_matter(spark, lake, monkeypatch):
    root, name, write = lake
    clock = iter(range(10**9, 0, -1000))
    for at in ("time", "time_ns", "monotonic"):
        monkeypatch.setattr(time, at, lambda: next(clock))
    for rows in (3, 5, 2, 9, 1):
        write(rows)
        assert state(spark, root, name) == rows
    assert len(runs(root)) == 2


def during(monkeypatch, where, *steps):
    """Run other writers whole just before a writer commits (or names its table), each once."""
    plain, waiting = getattr(tables, where), list(steps)

    def hooked(*args, **options):
        if waiting:
            waiting.pop(0)()
        return plain(*args, **options)

    monkeypatch.setattr(tables, where, hooked)


def test_of_two_overlapping_writers_the_last_commit_wins(spark, lake, monkeypatch):
    root, name, write = lake
    write(1)
    during(monkeypatch, "_commit", lambda: write(20))
    write(30)
    assert state(spark, root, name) == 30


def test_a_writer_overtaken_by_three_keeps_its_folder(spark, lake, monkeypatch):
    root, name, write = lake

    def others():
        for rows in (20, 21, 22):
            write(rows)
        assert state(spark, root, name) == 22

    during(monkeypatch, "_commit", others)
    write(30)
    assert state(spark, root, name) == 30


def test_three_writers_inside_each_other(spark, lake, monkeypatch):
    root, name, write = lake
    write(1)
    during(monkeypatch, "_commit", lambda: write(20), lambda: write(30))
    write(10)
    assert state(spark, root, name) == 10


def test_a_name_follows_a_commit_that_came_in_between(spark, lake, monkeypatch):
    root, name, write = lake
    write(1)
    during(monkeypatch, "_name_current", lambda: write(20), lambda: write(30))
    write(10)
    assert state(spark, root, name) == 30


def test_a_name_made_late_is_made_again(spark, lake, monkeypatch):
    root, name, write = lake
    write(1)
    during(monkeypatch, "register", lambda: write(20), lambda: write(30))
    write(10)
    # The outer writer names its own folder last and then sees that it is not the table.
    assert state(spark, root, name) == 30


def test_many_writers_at_once(spark, lake):
    root, name, write = lake
    failed = []

    def some(first):
        try:
            for rows in range(first, first + 4):
                write(rows)
        except Exception as error:
            failed.append(str(error))

    threads = [threading.Thread(target=some, args=(10 * at,)) for at in range(1, 4)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert failed == []
    assert state(spark, root, name) in (13, 23, 33)


def commits(spark, path):
    return tables._commits(tables.folder_names(spark, path))


def blind_once(monkeypatch, seen):
    """The next look at the commits finds an old state."""
    plain, old = tables._commits, [seen]
    monkeypatch.setattr(tables, "_commits", lambda names: old.pop() if old else plain(names))


@pytest.mark.parametrize("mine, last", [("0" * 32, 2), ("f" * 32, 1)])
def test_of_two_commits_under_one_number_one_is_made_again(spark, tmp_path, monkeypatch, mine, last):
    path, other = str(tmp_path), "8" * 32
    assert tables._commit(spark, path, other) == 1
    blind_once(monkeypatch, [])
    assert tables._commit(spark, path, mine) == last
    assert commits(spark, path)[-1] == (last, mine)


def test_a_commit_far_behind_is_made_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    for at in range(1, 7):
        tables._commit(spark, path, f"{at:032x}")
    blind_once(monkeypatch, [(1, f"{1:032x}")])
    assert tables._commit(spark, path, "a" * 32) == 7
    assert src.current_path(spark, path).endswith("a" * 32)


def test_success_marks_are_not_needed(spark, lake):
    root, name, write = lake
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        for rows in (4, 6, 5):
            write(rows)
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert state(spark, root, name) == 5


def test_a_dead_writers_folder_goes_on_request_only(spark, lake):
    root, name, write = lake
    write(2)
    spark.range(7).write.parquet(f"{root}/silver/t/run-dead")
    for rows in (3, 4, 5):
        write(rows)
    assert "run-dead" in runs(root)
    assert src.drop_unfinished(spark, root, "silver", "t") == ["run-dead"]
    assert len(runs(root)) == 2 and state(spark, root, name) == 5


def test_a_failed_write_removes_its_folder(spark, lake):
    root, name, write = lake
    write(2)
    broken = spark.range(5).select(F.raise_error(F.lit("lost")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        src.write_layer(broken, root, "silver", "t", table=name)
    assert len(runs(root)) == 1 and state(spark, root, name) == 2


def test_old_commit_files_are_thinned_out(spark, lake, monkeypatch):
    root, name, write = lake
    monkeypatch.setattr(tables, "COMMITS_KEPT", 4)
    for rows in range(1, 8):
        write(rows)
    path = src.layer_path(root, "silver", "t")
    assert [number for number, _ in commits(spark, path)] == [4, 5, 6, 7]
    assert state(spark, root, name) == 7
