"""Sharding along a Hilbert curve: rows close in several metadata columns share files.

Each dimension is cut at its quantiles into ``2 ** bits`` steps, a row's steps give its place on the
curve, and the curve's order is cut into runs whose row counts differ by one at most. A shard thus
covers a compact box of values and its files can be pruned on any of the dimensions.

Only DataFrame functions. No window sees more than about `GROUP_ROWS` rows: a place on the curve
that holds many rows is ordered by a hash of the row, in as many hash groups as its count asks for.
Ranks come from counts per place (at most ``2 ** (bits * dimensions)``) and per group. Nulls in a
dimension share its first step, a null text has size 8 and checksum 0, rows equal in every
respect take neighbouring ranks, and an empty table gives no rows. Columns other than the named
ones are not read.
"""

from __future__ import annotations

from functools import reduce
from os.path import commonprefix

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermill.llm.common import let, stored

GROUP_ROWS = 4096
MAX_CURVE_BITS = 16
ROW_OVERHEAD = 8
QUANTILE_ACCURACY = 10_000
# Bytes of a string, after the prefix that all values share, that order it.
CODE_BYTES = 6


def hilbert_index(axes: list[Column], bits: int) -> Column:
    """Place on the Hilbert curve of a point with integer axes in ``[0, 2 ** bits)``.

    The usual exclusive-or rule for n dimensions, run as folds over small arrays.
    """
    n = len(axes)
    steps = [(1 << b, i) for b in range(bits - 1, 0, -1) for i in range(n)]

    def undo(point: Column, step: Column) -> Column:
        low = step["q"] - 1
        at = step["i"]
        hit = F.get(point, at).bitwiseAND(step["q"]) != 0
        swap = F.get(point, F.lit(0)).bitwiseXOR(F.get(point, at)).bitwiseAND(low)
        return F.transform(
            point,
            lambda x, j: F.when(hit, F.when(j == 0, x.bitwiseXOR(low)).otherwise(x))
            .when((j == 0) | (j == at), x.bitwiseXOR(F.when(at == 0, F.lit(0)).otherwise(swap)))
            .otherwise(x),
        )

    def folded(point: Column) -> Column:
        if not steps:
            return point
        listed = F.array(
            *(F.struct(F.lit(q).cast("long").alias("q"), F.lit(i).alias("i")) for q, i in steps)
        )
        return F.aggregate(listed, point, undo)

    def gray(point: Column) -> Column:
        # Each axis becomes the exclusive or of itself and all before it.
        return F.transform(
            point,
            lambda _, j: F.aggregate(
                F.slice(point, F.lit(1), j + 1), F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x)
            ),
        )

    def twist(point: Column) -> Column:
        last = F.get(point, F.lit(n - 1))
        turn = reduce(
            lambda a, b: a.bitwiseXOR(b),
            (
                F.when(
                    last.bitwiseAND(F.lit(1 << b)) != 0, F.lit((1 << b) - 1).cast("long")
                ).otherwise(F.lit(0).cast("long"))
                for b in range(bits - 1, 0, -1)
            ),
            F.lit(0).cast("long"),
        )
        return let(turn, lambda t: F.transform(point, lambda x: x.bitwiseXOR(t)))

    def woven(point: Column) -> Column:
        return reduce(
            lambda a, b: a + b,
            (
                F.shiftleft(
                    F.shiftright(F.get(point, F.lit(i)), b).bitwiseAND(F.lit(1).cast("long")),
                    b * n + n - 1 - i,
                )
                for b in range(bits)
                for i in range(n)
            ),
        )

    start = F.array(*(axis.cast("long") for axis in axes))
    return let(folded(start), lambda p: let(gray(p), lambda g: let(twist(g), woven)))


def _codes(df: DataFrame, dims: list[str]) -> dict[str, Column]:
    """Each dimension as a number in the order of its values."""
    kinds = dict(df.dtypes)
    texts = [name for name in dims if kinds[name] == "string"]
    codes = {name: F.col(name).cast("double") for name in dims if name not in texts}
    if texts:
        ends = df.agg(
            *(f(name).alias(f"{f.__name__}_{name}") for name in texts for f in (F.min, F.max))
        ).first()
        for name in texts:
            low, high = ((ends[f"{f}_{name}"] or "").encode() for f in ("min", "max"))
            shared = len(commonprefix([low, high]))
            tail = F.hex(F.substring(F.col(name).cast("binary"), shared + 1, CODE_BYTES))
            codes[name] = F.conv(F.rpad(tail, 2 * CODE_BYTES, "0"), 16, 10).cast("double")
    return codes


def _steps(df: DataFrame, dims: list[str], bits: int) -> list[Column]:
    """Each dimension cut at its quantiles, as an integer below ``2 ** bits``.

    The steps of a dimension with few values are spread over the whole range, so that the curve's first
    turns tell them apart.
    """
    codes = _codes(df, dims)
    shares = [k / 2**bits for k in range(1, 2**bits)]
    found = df.agg(
        *(
            made.alias(f"{what}{k}")
            for k, name in enumerate(dims)
            for what, made in (
                ("cut", F.percentile_approx(codes[name], shares, QUANTILE_ACCURACY)),
                ("most", F.max(codes[name])),
            )
        )
    ).first()
    steps = []
    for k, name in enumerate(dims):
        cuts = sorted(cut for cut in set(found[f"cut{k}"] or []) if cut < found[f"most{k}"])
        above = [F.when(codes[name] > F.lit(cut), 1).otherwise(0) for cut in cuts]
        step = reduce(lambda a, b: a + b, above, F.lit(0))
        steps.append((step * F.lit(2**bits) / F.lit(len(cuts) + 1)).cast("int"))
    return steps


def hilbert_shards(
    docs: DataFrame,
    shards: int = 24,
    dims: tuple[str, ...] = ("lang", "source", "n_chars"),
    bits: int = 4,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``doc_id, size, text_crc32, place, shard, slot`` for every document.

    ``size`` is the text's UTF-8 bytes plus 8, ``place`` the index on the curve, ``slot`` the
    position inside the shard, gapless from 0.
    """
    if bits * len(dims) > MAX_CURVE_BITS:
        raise ValueError(f"more than {MAX_CURVE_BITS} bits in all")
    text = F.coalesce("text", F.lit(""))
    place = hilbert_index(_steps(docs, list(dims), bits), bits)
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            place.alias("place"),
        ).withColumn("mix", F.xxhash64("doc_id", "text_crc32", "size")),
        "places",
    )
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # One row per place on the curve: at most 2 ** MAX_CURVE_BITS rows of three longs.
    places = (
        rows.groupBy("place")
        .agg(F.count("*").alias("n"))
        .select(
            "place",
            F.ceil(F.col("n") / group_rows).alias("groups"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before_place"),
            F.sum("n").over(everything).alias("total"),
        )
    )
    grouped = rows.join(F.broadcast(places), "place").withColumn("part", F.expr("pmod(mix, groups)"))
    inside = Window.partitionBy("place").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        grouped.groupBy("place", "part")
        .agg(F.count("*").alias("n"))
        .select("place", "part", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("before_part"))
    )
    order = Window.partitionBy("place", "part").orderBy("mix", "doc_id", "text_crc32", "size")
    ranked = (
        grouped.withColumn("at", F.row_number().over(order) - 1)
        .join(starts, ["place", "part"])
        .withColumn("rank", F.col("before_place") + F.col("before_part") + F.col("at"))
        .withColumn("shard", F.expr(f"int((rank * {shards}) div total)"))
    )
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return ranked.select(
        "doc_id", "size", "text_crc32", "place", "shard", (F.col("rank") - first).alias("slot")
    )


def write_in_curve_order(
    docs: DataFrame,
    path: str,
    files: int = 24,
    dims: tuple[str, ...] = ("lang", "source", "n_chars"),
    bits: int = 4,
) -> str:
    """Write the documents as Parquet files that each hold a run of the curve, columns unchanged.

    Every file then has few values, or a narrow range, of each dimension, so a filter on any of them skips
    most files by their statistics. A hot place on the curve is spread over files by a hash of id and text.
    No column may be called ``__place`` or ``__mix``.
    """
    if bits * len(dims) > MAX_CURVE_BITS:
        raise ValueError(f"more than {MAX_CURVE_BITS} bits in all")
    place = hilbert_index(_steps(docs, list(dims), bits), bits)
    (
        docs.withColumn("__place", place)
        .withColumn("__mix", F.xxhash64("doc_id", "text"))
        .repartitionByRange(files, "__place", "__mix")
        .sortWithinPartitions("__place", "__mix")
        .drop("__place", "__mix")
        .write.parquet(path)
    )
    return path
