"""DataFrame -> DataFrame operators, made for `DataFrame.transform`."""

from tiermill.operators.columns import (
    canonicalize,
    cast_columns,
    drop_columns,
    fill_nulls,
    flag_night,
    ip_first_octet,
    ip_prefix,
    month_bucket,
    normalize_names,
    normalize_text,
    null_if_numeric,
    parse_timestamps,
    rename_positional,
    split_path,
    strip_non_letters,
)
from tiermill.operators.dedup import (
    BITMAP_BITS,
    dedup_by_key,
    dedup_few,
    dedup_rows,
    hash_bitmaps,
    repeated_hashes,
    split_repeated,
    with_seen,
)
from tiermill.operators.quality import (
    account,
    count_fields,
    keep_between,
    keep_in,
    keep_positive,
    rejected_rows,
    rejects,
    require,
)

__all__ = [
    "BITMAP_BITS",
    "account",
    "canonicalize",
    "cast_columns",
    "count_fields",
    "dedup_by_key",
    "dedup_few",
    "dedup_rows",
    "drop_columns",
    "fill_nulls",
    "flag_night",
    "hash_bitmaps",
    "ip_first_octet",
    "ip_prefix",
    "keep_between",
    "keep_in",
    "keep_positive",
    "month_bucket",
    "normalize_names",
    "normalize_text",
    "null_if_numeric",
    "parse_timestamps",
    "rejected_rows",
    "rejects",
    "rename_positional",
    "repeated_hashes",
    "require",
    "split_path",
    "split_repeated",
    "strip_non_letters",
    "with_seen",
]
