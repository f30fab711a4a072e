"""Bronze and silver layers of the order table and the access log.

The order of steps is part of the meaning: full-row dedup comes before the private columns are
dropped, the null test on the raw dates before they are parsed, and the keyed dedup before the
value and status filters. Moving one changes which rows survive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill import functions as fn
from tiermill import operators as op
from tiermill import rules


def order_casts(named: DataFrame) -> dict[str, str]:
    """The columns bronze converts: some always, others where they are text."""
    texts = {name for name, kind in named.dtypes if kind == "string"}
    extra = {name: to for name, to in rules.ORDER_TEXT_CASTS.items() if name in texts}
    return rules.ORDER_CASTS | extra


def _well_formed(named: DataFrame) -> DataFrame:
    """Without the rows whose shape the reader found wrong, if it was asked to tell them."""
    if rules.MALFORMED not in named.columns:
        return named
    return named.filter(F.col(rules.MALFORMED).isNull()).drop(rules.MALFORMED)


def typed_orders(raw: DataFrame) -> DataFrame:
    """The row-wise part of bronze: normal names, pinned types, required keys, rows of the right shape."""
    named = _well_formed(op.normalize_names(raw))
    return named.transform(op.cast_columns, order_casts(named)).transform(
        op.require, rules.ORDER_REQUIRED
    )


def _plain_zeros(df: DataFrame) -> DataFrame:
    """Zeros without a sign, as a duplicate removal by a shuffle leaves them."""
    kinds = {name: kind for name, kind in df.dtypes if kind in ("float", "double")}
    return df.withColumns(
        {name: F.when(F.col(name) == 0, F.lit(0.0).cast(kind)).otherwise(F.col(name)) for name, kind in kinds.items()}
    )


def bronze_orders(raw: DataFrame, bits: int | None = None) -> DataFrame:
    """Normal names, pinned types, required keys, no equal rows, no private columns.

    Rows of the wrong shape go, where the reader kept them apart (``malformed=True``). ``bits`` finds equal
    rows by `dedup_few`, which reads an input three times that gives the same rows each time, and hardly shuffles.
    """
    rows = typed_orders(raw).transform(op.dedup_rows, bits)
    if bits is not None:
        rows = _plain_zeros(rows)
    return rows.transform(op.drop_columns, rules.ORDER_PRIVATE_COLUMNS)


def silver_orders_basic(bronze: DataFrame) -> DataFrame:
    """Bronze rows with positive sales and quantity and any status."""
    return bronze.transform(op.keep_positive, rules.ORDER_POSITIVE).transform(
        op.require, ["order_status"]
    )


def clean_orders(bronze: DataFrame) -> DataFrame:
    """The row-wise part of silver: text, countries, dates. No shuffle; works on a stream."""
    return (
        bronze.transform(op.drop_columns, rules.ORDER_UNUSED_COLUMNS)
        .transform(op.fill_nulls, rules.ORDER_NULL_DEFAULTS)
        .transform(op.strip_non_letters, rules.ORDER_LETTER_COLUMNS)
        .transform(op.null_if_numeric, "order_country")
        .transform(op.canonicalize, "order_country", rules.COUNTRY_RULES)
        .transform(op.normalize_text, rules.ORDER_TEXT_COLUMNS)
        .transform(op.require, list(rules.ORDER_TIMES.values()))
        .transform(op.parse_timestamps, rules.ORDER_TIMES)
    )


def order_winners(bronze: DataFrame, bits: int | None = None) -> DataFrame:
    """The one bronze row with dates that stands for each order item.

    It is the least by a total order, so the winners of winners are those of all rows. ``bits`` moves only rows
    that share an order key, see `dedup_by_key`.
    """
    tie_break = [name for name in rules.ORDER_TIE_BREAK if name in bronze.columns]
    return bronze.transform(op.require, list(rules.ORDER_TIMES.values())).transform(
        op.dedup_by_key, rules.ORDER_KEY, tie_break, bits
    )


def finished_orders(winners: DataFrame) -> DataFrame:
    """The row-wise rest of silver: positive figures, finished statuses, cleaned columns."""
    return (
        winners.transform(op.keep_positive, rules.ORDER_POSITIVE)
        .transform(op.normalize_text, ["order_status"])
        .transform(op.keep_in, "order_status", rules.ORDER_STATUSES)
        .transform(clean_orders)
    )


def is_stored(df: DataFrame) -> bool:
    """Whether a frame is a table of files as it is read, which may be read more than once."""
    return df._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation"


def silver_orders(bronze: DataFrame) -> DataFrame:
    """Cleaned orders, one row per order item, finished statuses only.

    The rows are chosen first, by their bronze values, as cleaning text is the dear part and half
    of the rows go. Of the cleaning, only the status decides about a row. Of a stored table, only rows that share
    an order key are moved.
    """
    return finished_orders(order_winners(bronze, op.BITMAP_BITS if is_stored(bronze) else None))


def raw_order_winners(raw: DataFrame, bits: int = op.BITMAP_BITS) -> DataFrame:
    """`order_winners` of `bronze_orders`, moving only rows that share an order key.

    A row whose order key no other row has, has no equal either, so only the others go through the two duplicate
    removals, and through the first one whole only if they may have an equal. The input is read five times, twice
    of them few columns, and must give the same rows each time.
    """
    alone, repeated = op.split_repeated(typed_orders(raw), rules.ORDER_KEY, bits)
    single = _plain_zeros(alone).transform(op.drop_columns, rules.ORDER_PRIVATE_COLUMNS).transform(
        op.require, list(rules.ORDER_TIMES.values())
    )
    return single.unionByName(order_winners(bronze_orders(repeated, bits)))


def raw_silver_orders(raw: DataFrame, bits: int = op.BITMAP_BITS) -> DataFrame:
    """`silver_orders` of `bronze_orders`; see `raw_order_winners`."""
    return finished_orders(raw_order_winners(raw, bits))


WRONG_SHAPE = "row_shape"
FIELDS = "fields"
Checks = dict[str, tuple[str | Column, Column]]


def _conversions(named: DataFrame) -> Checks:
    """Every column that bronze or silver converts for this input, and how."""
    kinds = dict(named.dtypes)
    checks = {
        name: (name, fn.as_type(F.col(name), to, kinds[name])) for name, to in order_casts(named).items()
    }
    for source in rules.ORDER_TIMES.values():
        checks[source] = (source, fn.parse_time(F.col(source)))
    return checks


def _log_conversions() -> Checks:
    """The columns of the log that bronze converts, and how."""
    hours = {name: (name, fn.as_type(F.col(name), to)) for name, to in rules.LOG_CASTS.items()}
    return {"event_time": ("event_time", fn.parse_time(F.col("event_time")))} | hours


def _with_shape(named: DataFrame, checks: Checks) -> Checks:
    """The checks for rows of the right shape, and the shape itself, where the reader told it."""
    if rules.MALFORMED not in named.columns:
        return checks
    line = F.col(rules.MALFORMED)
    sound = {name: (F.when(line.isNull(), F.col(at)), to) for name, (at, to) in checks.items()}
    return {WRONG_SHAPE: (line, F.lit(None).cast("string"))} | sound


def _set_aside(named: DataFrame, checks: Checks) -> DataFrame:
    """Rows that break a check. Of a row of the wrong shape, only its line and field count are shown."""
    found = op.rejected_rows(named, _with_shape(named, checks))
    if rules.MALFORMED not in named.columns:
        return found
    line = F.col(rules.MALFORMED)
    parsed = [name for name in named.columns if name != rules.MALFORMED]
    shown = found.withColumns({name: F.when(line.isNull(), F.col(name)) for name in parsed})
    return shown.withColumn(FIELDS, op.count_fields(line))


def _accounts(
    named: DataFrame, checks: Checks, required: Sequence[str], bronze: DataFrame
) -> DataFrame:
    lost = F.lit(False)
    missing = F.lit(False)
    for name in required:
        source, converted = checks.get(name, (name, F.col(name)))
        nothing = converted.isNull()
        if dict(named.dtypes)[name] in ("float", "double") or name in rules.ORDER_CASTS:
            nothing = nothing | F.isnan(converted.cast("double"))
        lost = lost | (F.col(source).isNotNull() & nothing)
        missing = missing | F.col(source).isNull()
    fates = {"value rejected": lost, "value missing": missing}
    if rules.MALFORMED in named.columns:
        fates = {"row of the wrong shape": F.col(rules.MALFORMED).isNotNull()} | fates
    return op.account(named, fates, bronze, copies="equal copy", rest="kept")


def order_rejects(raw: DataFrame) -> DataFrame:
    """How many values of the raw order table casting or parsing turns into null, per column.

    Where the reader kept rows of the wrong shape apart, ``row_shape`` counts them, and the other rules
    the rest.
    """
    named = op.normalize_names(raw)
    return op.rejects(named, _with_shape(named, _conversions(named)))


def order_quarantine(raw: DataFrame) -> DataFrame:
    """The raw order rows that hold such a value, with the columns concerned.

    Of rows of the wrong shape, ``malformed_row`` and ``fields`` show the line and its number of fields;
    their other columns are null, as nobody knows which value belongs where.
    """
    named = op.normalize_names(raw)
    return _set_aside(named, _conversions(named))


def order_accounts(raw: DataFrame, bronze: DataFrame | None = None) -> DataFrame:
    """What bronze makes of every raw order row: ``(fate, rows)``, adding up to all rows.

    A row goes for its shape, for a required value that does not convert, for one that is not there, or
    as a copy of an equal one, whichever comes first; the rest is kept. ``bronze`` is `bronze_orders` of
    these rows, if the caller has it.
    """
    named = op.normalize_names(raw)
    kept = bronze_orders(raw) if bronze is None else bronze
    return _accounts(named, _conversions(named), rules.ORDER_REQUIRED, kept)


def _named_logs(raw: DataFrame) -> DataFrame:
    """The log under its names; the column of malformed rows, if there is one, comes last."""
    told = [rules.MALFORMED] if rules.MALFORMED in raw.columns else []
    return op.rename_positional(raw, [*rules.LOG_COLUMNS, *told])


def log_rejects(raw: DataFrame) -> DataFrame:
    """How many times and hours of the raw log do not convert, and how many rows have another shape.

    The shape is counted where the reader kept such rows apart (``malformed=True``).
    """
    named = _named_logs(raw)
    return op.rejects(named, _with_shape(named, _log_conversions()))


def log_quarantine(raw: DataFrame) -> DataFrame:
    """The raw log rows concerned, with the rules they break; see `order_quarantine`."""
    return _set_aside(_named_logs(raw), _log_conversions())


def log_accounts(raw: DataFrame) -> DataFrame:
    """What bronze makes of every raw log row; see `order_accounts`."""
    return _accounts(_named_logs(raw), _log_conversions(), rules.LOG_REQUIRED, bronze_logs(raw))


def clean_logs(raw: DataFrame) -> DataFrame:
    """The row-wise part of the log's bronze layer. No shuffle; works on a stream."""
    return (
        _well_formed(_named_logs(raw))
        .transform(op.normalize_text, rules.LOG_TEXT_COLUMNS)
        .transform(op.parse_timestamps, ["event_time"])
        .transform(op.cast_columns, rules.LOG_CASTS)
        .transform(op.require, rules.LOG_REQUIRED)
    )


def bronze_logs(raw: DataFrame, bits: int | None = None) -> DataFrame:
    """Cleaned log without equal rows, with path parts and region; ``bits`` as in `bronze_orders`."""
    return (
        clean_logs(raw)
        .transform(op.dedup_rows, bits)
        .transform(op.split_path)
        .transform(op.ip_first_octet)
    )


def silver_logs_basic(bronze: DataFrame) -> DataFrame:
    """Bronze log rows with a time and a product."""
    return bronze.transform(op.require, ["event_time", "product"])


def silver_logs(bronze: DataFrame, distinct_input: bool = False) -> DataFrame:
    """Log rows with a valid hour, the silver region and the night flag.

    ``distinct_input=True`` skips the dedup when the caller knows there is nothing to drop, as
    after `bronze_logs`: its derived columns are functions of the columns it made distinct. That
    saves a shuffle of the whole table.
    """
    rows = bronze if distinct_input else op.dedup_rows(bronze)
    return (
        silver_logs_basic(rows)
        .transform(op.parse_timestamps, ["event_time"])
        .transform(op.keep_between, "hour", *rules.LOG_HOURS)
        .transform(op.ip_prefix)
        .transform(op.flag_night)
    )
