"""Duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

RANK = "__row_rank"


HASH, SEEN = "__row_hash", "__row_seen"
BUCKET, BITMAP = "__row_bucket", "__row_bitmap"
BITMAP_BITS = 1 << 27
# Bits and bytes of one bitmap of Spark's bitmap functions.
BITMAP_SIZE = 32_768
PIECE_BITS = 1024
PIECES = BITMAP_SIZE // PIECE_BITS


def dedup_rows(
    df: DataFrame, bits: int | None = None, keys: Sequence[str] | None = None
) -> DataFrame:
    """Drop fully equal rows.

    Spark removes copies inside each task before the shuffle, so a row that makes up a large
    share of the table reaches the shuffle once per task.

    With ``bits``, rows without an equal are not shuffled at all; see `dedup_few`.
    """
    return df.dropDuplicates() if bits is None else dedup_few(df, bits, keys)


def repeated_hashes(hashes: DataFrame, bits: int = BITMAP_BITS) -> DataFrame:
    """`hash_bitmaps` of the hashes in the one column that occur twice or more."""
    (name,) = hashes.columns
    twice = hashes.groupBy(name).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return hash_bitmaps(twice.select(name), bits)


def hash_bitmaps(hashes: DataFrame, bits: int = BITMAP_BITS) -> DataFrame:
    """Bitmaps ``(bucket, bitmap)`` of the different hashes in the one column.

    Together they have ``bits`` bits, an eighth as many bytes, whatever the number of hashes.
    """
    if bits % BITMAP_SIZE:
        raise ValueError(f"bits must be a multiple of {BITMAP_SIZE}")
    (name,) = hashes.columns
    place = F.pmod(F.col(name), F.lit(bits))
    return (
        hashes.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("at"))
        .distinct()
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("at").alias("bitmap"))
    )


def with_seen(rows: DataFrame, hashed: Column, bitmaps: DataFrame, bits: int, name: str) -> DataFrame:
    """Rows, each with whether the bit of its hash is set; the bitmaps are broadcast, no row is moved.

    They are broadcast in pieces of `PIECE_BITS` bits, without those that are empty: a row copies its piece.
    """
    place = F.pmod(hashed, F.lit(bits))
    bucket, at = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    pieces = bitmaps.toDF(BUCKET, BITMAP).select(F.explode(_pieces(F.col(BUCKET), F.col(BITMAP))).alias("p"))
    maps = F.broadcast(pieces.select("p.*").filter(F.bitmap_count(BITMAP) > 0))
    piece = bucket * PIECES + F.shiftright(at, PIECE_BITS.bit_length() - 1)
    marked = rows.join(maps, piece == F.col(BUCKET), "left")
    seen = F.coalesce(_bit(F.col(BITMAP), F.pmod(at, F.lit(PIECE_BITS)).cast("int")), F.lit(False))
    return marked.withColumn(name, seen).drop(BUCKET, BITMAP)


def _pieces(bucket: Column, bitmap: Column) -> Column:
    """The pieces of a bitmap, numbered over all bitmaps."""
    size = PIECE_BITS // 8
    return F.transform(
        F.sequence(F.lit(0), F.lit(PIECES - 1)),
        lambda at: F.struct(
            (bucket * PIECES + at).alias(BUCKET), F.substring(bitmap, at * size + 1, F.lit(size)).alias(BITMAP)
        ),
    )


def _bit(bitmap: Column, position: Column) -> Column:
    """One bit of a bitmap, lowest bit of a byte first."""
    byte = F.substring(bitmap, F.shiftright(position, 3) + 1, F.lit(1))
    # Latin-1 has a letter of the same number for every byte.
    return F.bit_get(F.ascii(F.decode(byte, "ISO-8859-1")), position.bitwiseAND(7)) != 0


def split_repeated(
    df: DataFrame, keys: Sequence[str], bits: int = BITMAP_BITS
) -> tuple[DataFrame, DataFrame]:
    """Rows whose key no other row has, and the rest; no row is moved.

    A pass over the keys shuffles eight bytes for each row and marks the hashes that occur twice in a bitmap of
    ``bits`` bits, which is broadcast. A hash that two keys share, or a bit that two hashes share, only puts
    rows of a single key with the rest. A null equals a null.
    """
    hashed = df.withColumn(HASH, F.xxhash64(*[F.col(f"`{name}`") for name in keys]))
    bitmaps = repeated_hashes(hashed.select(HASH), bits)
    told = with_seen(hashed, F.col(HASH), bitmaps, bits, SEEN).drop(HASH)
    return told.filter(~F.col(SEEN)).drop(SEEN), told.filter(SEEN).drop(SEEN)


def dedup_few(
    df: DataFrame, bits: int = BITMAP_BITS, keys: Sequence[str] | None = None
) -> DataFrame:
    """Drop fully equal rows of a table in which few rows have an equal, moving only those.

    A first pass shuffles eight bytes for each row and marks the hashes that occur twice in a bitmap of
    ``bits`` bits, which is broadcast: 16 MiB by default. Rows whose bit is clear have no equal and stay where
    they are; the others are compared whole, as `dedup_rows` does. Exact: equal rows have equal hashes, and a
    bit that two hashes share only costs a shuffle. With as many repeated hashes as bits, most rows move.

    ``keys`` are columns whose hash is taken instead of that of all columns. Any will do, as equal rows have equal
    keys; where few rows share a key, the first pass reads less.

    The table is scanned three times, so it should be a stored one that gives the same rows each time.
    """
    alone, repeated = split_repeated(df, df.columns if keys is None else keys, bits)
    return alone.unionByName(repeated.dropDuplicates())


def _ordering(name: str, kind: DataType) -> Column:
    """The column as something rows can be ordered by: a map as its sorted entries."""
    if isinstance(kind, MapType) and _orderable(kind.keyType) and _orderable(kind.valueType):
        return F.array_sort(F.map_entries(name))
    if not _orderable(kind):
        raise TypeError(f"rows cannot be ordered by {name} ({kind.simpleString()}); drop or cast it")
    return F.col(name)


def _orderable(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_orderable(field.dataType) for field in kind.fields)
    return not isinstance(kind, (MapType, VariantType))


def dedup_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    bits: int | None = None,
) -> DataFrame:
    """Keep one row per key: the smallest by ``order_by``, then by all other columns, nulls last.

    The order is total, so the same rows survive on every run and on every retry; a column that has
    no order, such as a variant, raises. ``row_number() = 1`` lets Spark cut each task to one row per key
    *before* the shuffle (WindowGroupLimit), so
    a key that holds a large share of the rows never lands in one task whole.

    With ``bits``, rows whose key no other row has are not moved, at the price of three scans; see
    `split_repeated`.
    """
    if bits is not None:
        alone, repeated = split_repeated(df, keys, bits)
        return alone.unionByName(dedup_by_key(repeated, keys, order_by))
    first = [name for name in order_by or [] if name not in keys]
    others = [name for name in df.columns if name not in keys and name not in first]
    order = [_ordering(name, df.schema[name].dataType).asc_nulls_last() for name in first + others]
    if not order:
        return df.dropDuplicates(list(keys))
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(RANK, F.row_number().over(window))
    return ranked.filter(F.col(RANK) == 1).drop(RANK)
