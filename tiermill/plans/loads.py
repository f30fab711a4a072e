"""Marts that take in loads one by one.

For every load the mergeable parts of each mart are stored once, as a layer table ``state/<mart>/<load>``; the
marts are made of the parts of all loads. Adding a load reads its own rows and the small states of the others,
never their rows. Adding the same load again replaces its part, so a run that died is simply repeated, and a
corrected load counts instead of the first one. Loads must not share order items.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tiermill.plans.gold import MARTS
from tiermill.sources.tables import (
    DEFAULT_FORMAT,
    folder_names,
    layer_path,
    read_layer,
    write_layer,
    write_marts,
)

STATE = "state"


def loads_of(spark: SparkSession, root: str, mart: str) -> list[str]:
    """The loads that a mart is made of, in order of their names."""
    return sorted(folder_names(spark, layer_path(root, STATE, mart)))


def mart_of_loads(
    spark: SparkSession, root: str, name: str, fmt: str = DEFAULT_FORMAT, ordered: bool = True
) -> DataFrame:
    """A mart from the stored states of all loads."""
    loads = loads_of(spark, root, name)
    if not loads:
        raise ValueError(f"no load of {name} under {root}")
    states = [read_layer(spark, root, STATE, f"{name}/{load}", fmt) for load in loads]
    mart = MARTS[name]
    return mart.finished(mart.merged(states) if len(states) > 1 else states[0], ordered)


def add_load(
    silver: DataFrame, root: str, load: str, fmt: str = DEFAULT_FORMAT, tables: bool = False
) -> DataFrame:
    """Add the silver orders of one load, rewrite the marts, and return their row counts ``(mart, rows)``.

    The states of the marts are written side by side, each from a scan of its columns, and one of its ids if it
    counts any: ``silver`` should be a stored table.
    """
    if not load or "/" in load or load.startswith((".", "_")):
        raise ValueError(f"{load!r} cannot name a load")
    spark = silver.sparkSession

    def keep(name: str) -> None:
        write_layer(MARTS[name].state(silver, apart=True), root, STATE, f"{name}/{load}", fmt)

    with ThreadPoolExecutor(len(MARTS)) as pool:
        list(pool.map(inheritable_thread_target(spark)(keep), MARTS))
    marts = {name: mart_of_loads(spark, root, name, fmt, ordered=False) for name in MARTS}
    return write_marts(marts, root, fmt, tables=tables)
