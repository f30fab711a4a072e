"""Files and tables: CSV in, layer tables in and out, layout, work folders."""

from tiermill.sources.csv_files import read_access_log_csv, read_orders_csv
from tiermill.sources.layout import cluster, compact_and_cluster, layout_stats
from tiermill.sources.sizing import (
    data_bytes,
    partitions_for,
    scanned_bytes,
    shuffle_sized_for,
    task_bytes,
)
from tiermill.sources.tables import (
    MART_LAYER,
    current_path,
    drop_unfinished,
    layer_path,
    read_layer,
    register,
    write_counted,
    write_layer,
    write_marts,
)
from tiermill.sources.workspace import remove_folder, work_folder

__all__ = [
    "MART_LAYER",
    "cluster",
    "compact_and_cluster",
    "current_path",
    "data_bytes",
    "drop_unfinished",
    "layer_path",
    "layout_stats",
    "partitions_for",
    "read_access_log_csv",
    "read_layer",
    "read_orders_csv",
    "register",
    "remove_folder",
    "scanned_bytes",
    "shuffle_sized_for",
    "task_bytes",
    "work_folder",
    "write_counted",
    "write_layer",
    "write_marts",
]
