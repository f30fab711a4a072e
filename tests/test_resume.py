"""A pipeline run that goes on where the last one ended."""

from __future__ import annotations

import pytest

from checks import queries as catalog
from tiermill import sources as src
from tiermill.plans import gold, pipeline
from tiermill.plans.pipeline import input_fingerprint, run_csv_pipeline
from tiermill.sources import tables


@pytest.fixture
def files(spark, sf_dir, tmp_path):
    folder = str(tmp_path / "in")
    return catalog.orders_csv(spark, sf_dir, folder), catalog.logs_csv(spark, sf_dir, folder)


@pytest.fixture
def written(monkeypatch):
    """Every layer table that is written, in order."""
    seen, plain = [], tables.write_layer

    def watched(df, root, layer, name, *args, **options):
        seen.append(f"{layer}/{name}")
        return plain(df, root, layer, name, *args, **options)

    monkeypatch.setattr(tables, "write_layer", watched)
    monkeypatch.setattr(pipeline, "write_layer", watched)
    return seen


LAYERS = {"bronze/orders", "silver/orders", "bronze/logs", "silver/logs"}
MARTS = {f"gold/{name}" for name in gold.MARTS}


def counts(audit):
    return [(row.mart, row.rows) for row in audit.collect()]


def test_a_run_that_dies_in_the_marts_restarts_there(spark, files, written, tmp_path, monkeypatch):
    root, plain = str(tmp_path / "lake"), tables.write_counted

    def dying(df, root, layer, name, *args, **options):
        if name == "monthly_financials":
            raise RuntimeError("lost")
        return plain(df, root, layer, name, *args, **options)

    monkeypatch.setattr(tables, "write_counted", dying)
    with pytest.raises(RuntimeError, match="lost"):
        run_csv_pipeline(spark, *files, root, resume=True)
    assert set(written) == LAYERS | MARTS - {"gold/monthly_financials"}
    written.clear()
    monkeypatch.setattr(tables, "write_counted", plain)
    resumed = counts(run_csv_pipeline(spark, *files, root, resume=True))
    assert written == ["gold/monthly_financials"]
    written.clear()
    again = counts(run_csv_pipeline(spark, *files, root, resume=True))
    assert written == []
    whole = counts(run_csv_pipeline(spark, *files, str(tmp_path / "other")))
    assert resumed == again == whole


def test_a_run_that_dies_after_bronze_restarts_at_silver(spark, files, written, tmp_path, monkeypatch):
    root, plain = str(tmp_path / "lake"), pipeline.silver_orders

    def dying(bronze):
        raise RuntimeError("lost")

    monkeypatch.setattr(pipeline, "silver_orders", dying)
    with pytest.raises(RuntimeError, match="lost"):
        run_csv_pipeline(spark, *files, root, resume=True)
    written.clear()
    monkeypatch.setattr(pipeline, "silver_orders", plain)
    run_csv_pipeline(spark, *files, root, resume=True)
    assert set(written) == {"silver/orders"} | MARTS


def test_changed_input_or_parameters_restart_at_bronze(spark, files, written, tmp_path, sf_dir):
    root = str(tmp_path / "lake")
    run_csv_pipeline(spark, *files, root, resume=True)
    written.clear()
    # One more file under the orders' path.
    rows = spark.read.option("header", True).csv(files[0]).limit(3)
    rows.write.options(**catalog.CSV_OPTIONS).mode("append").csv(files[0])
    run_csv_pipeline(spark, *files, root, resume=True)
    assert set(written) == LAYERS | MARTS
    written.clear()
    run_csv_pipeline(spark, *files, root, encoding="ISO-8859-1", resume=True)
    assert set(written) == LAYERS | MARTS


def test_runs_that_do_not_ask_write_everything(spark, files, written, tmp_path):
    root = str(tmp_path / "lake")
    run_csv_pipeline(spark, *files, root, resume=True)
    written.clear()
    run_csv_pipeline(spark, *files, root)
    assert set(written) == LAYERS | MARTS
    written.clear()
    # Their tables carry no note, so nothing is taken for finished afterwards.
    run_csv_pipeline(spark, *files, root, resume=True)
    assert set(written) == LAYERS | MARTS


def test_names_are_given_on_resume_too(spark, files, tmp_path):
    root = str(tmp_path / "lake")
    run_csv_pipeline(spark, *files, root, resume=True)
    run_csv_pipeline(spark, *files, root, tables=True, resume=True)
    for name in ("orders_bronze", "orders_silver", "logs_silver", "kpi_summary"):
        assert spark.table(name).count() > 0
        spark.sql(f"DROP TABLE {name}")
    for name in ("logs_bronze", "monthly_financials", "shipping_performance", "customer_analytics"):
        spark.sql(f"DROP TABLE {name}")


def test_fingerprints(spark, tmp_path, monkeypatch):
    (tmp_path / "a").write_text("x")
    path = str(tmp_path)
    one = input_fingerprint(spark, [path], "UTF-8")
    assert one == input_fingerprint(spark, [path], "UTF-8") != input_fingerprint(spark, [path], "X")
    (tmp_path / "b").write_text("x")
    assert one != input_fingerprint(spark, [path], "UTF-8")
    (tmp_path / "b").unlink()
    assert one == input_fingerprint(spark, [path], "UTF-8")
    monkeypatch.setattr(pipeline.rules, "TOP_K", 6)
    assert one != input_fingerprint(spark, [path], "UTF-8")


def test_notes_belong_to_the_rows(spark, tmp_path):
    root = str(tmp_path)
    src.write_layer(spark.range(3), root, "l", "t", note="first")
    assert tables.layer_note(spark, root, "l", "t") == "first"
    assert src.read_layer(spark, root, "l", "t").count() == 3
    src.write_layer(spark.range(4), root, "l", "t")
    assert tables.layer_note(spark, root, "l", "t") is None
    assert tables.layer_note(spark, root, "l", "none") is None
