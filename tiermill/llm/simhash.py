"""SimHash near-duplicates found by covering locality-sensitive hashing.

A text's fingerprint has a bit set where more than half of its shingles' hashes have it. Fingerprints
within ``radius`` bits are linked; links join into components.

Covering: every bit position gets a non-zero vector of ``radius + 1`` bits, and every non-zero vector
of that length a mask that keeps the positions with an odd inner product. The at most ``radius``
positions in which two linked fingerprints differ span less than the whole space, so some mask hides
all of them: each linked pair meets in at least one table.

Equal fingerprints are one node, so copies cost nothing. Buckets of up to `BUCKET` fingerprints are
compared directly, and a bucket yields a spanning forest of its links, not its pairs. In larger
buckets fingerprints meet at common midpoints, at most ``radius / 2`` bits from either end: rows grow
in proportion to the bucket and no link is lost.

Null and empty texts have no words and fingerprint zero, which is linked like any other. Texts of
fewer words than a shingle are one shingle. Repeated rows share a component; a component whose
``doc_id`` are all null has a null id. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermill.llm.common import stored, to_python
from tiermill.llm.components import components

BITS = 64
BUCKET = 4096
# Lanes of eight one-byte counters hold this many rows before one could overflow.
LANE_ROWS = 255


def fingerprint(text: str, shingle: int, seed: int = 42) -> int:
    """SimHash of one text, as an unsigned 64-bit integer."""
    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space parts
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    size = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(line[a:b], seed) for a, b in zip(starts.tolist(), ends[size - 1 :].tolist())],
        np.uint64,
    )
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    lanes = np.add.reduceat(bits.view(np.uint64), np.arange(0, len(hashes), LANE_ROWS), axis=0)
    counts = lanes.view(np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, also: Sequence[str] = ()) -> DataFrame:
    """``doc_id, fp`` and the long columns ``also``; ``fp`` is the fingerprint as a signed long."""
    names = ["doc_id", *also]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text.as_py() or "", shingle) for text in batch.column("text")]
            signed = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in names), pa.array(signed)], names=[*names, "fp"]
            )

    fields = ", ".join(f"{name} long" for name in [*names, "fp"])
    longs = [F.col(name).cast("long").alias(name) for name in names]
    return to_python(docs.select(*longs, "text")).mapInArrow(run, fields)


def covering_masks(radius: int) -> list[int]:
    """Masks such that any set of at most ``radius`` bits is hidden by one of them."""
    vectors = 2 ** (radius + 1) - 1
    of_bit = [1 + bit % vectors for bit in range(BITS)]
    return [
        sum(1 << bit for bit in range(BITS) if (of_bit[bit] & v).bit_count() % 2)
        for v in range(1, vectors + 1)
    ]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _bucket_links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """For each bucket, an edge from every fingerprint to the least one its links reach inside it."""
    for batch in batches:
        left, right = [], []
        for bucket in batch.column("fps"):
            fps = np.sort(np.array(bucket.as_py(), np.int64))
            near = [
                np.flatnonzero(np.bitwise_count((fps ^ one).view(np.uint64)) <= radius) for one in fps
            ] if len(fps) <= 64 else None
            root = np.full(len(fps), -1)
            for start in range(len(fps)):
                if root[start] >= 0:
                    continue
                root[start] = start
                edge = [start]
                while edge:
                    at = edge.pop()
                    reach = (
                        near[at]
                        if near is not None
                        else np.flatnonzero(np.bitwise_count((fps ^ fps[at]).view(np.uint64)) <= radius)
                    )
                    new = reach[root[reach] < 0]
                    root[new] = start
                    edge.extend(new.tolist())
            moved = np.flatnonzero(root != np.arange(len(fps)))
            left.append(fps[moved])
            right.append(fps[root[moved]])
        if left:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["u", "v"]
            )


def links(nodes: DataFrame, radius: int = 4, bucket: int = BUCKET) -> DataFrame:
    """Edges ``(u, v)`` that connect all distinct ``fp`` within ``radius`` bits of each other."""
    masks = [_signed(mask) for mask in covering_masks(radius)]
    tables = F.array(
        *(
            F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
            for t, m in enumerate(masks)
        )
    )
    rows = nodes.select("fp", F.explode(tables).alias("b")).select("b.t", "b.key", "fp")
    shared = rows.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1")
    # Written once: both kinds of bucket read it, and most fingerprints share no bucket. Both joins are merge
    # joins by hint: Spark counts an exploded row as one, and would broadcast all rows of these tables.
    met = stored(rows.join(shared.hint("merge"), ["t", "key"]), "buckets")
    small = (
        met.filter(F.col("n") <= bucket)
        .groupBy("t", "key")
        .agg(F.collect_list("fp").alias("fps"))
        .select("fps")
        .mapInArrow(lambda batches: _bucket_links(batches, radius), "u long, v long")
    )
    # A pair within the radius differs in hidden bits only, so flips of hidden bits reach midpoints.
    half = (radius + 1) // 2
    flips = [
        [
            _signed(sum(1 << bit for bit in chosen))
            for size in range(half + 1)
            for chosen in combinations([b for b in range(BITS) if not (mask >> b) & 1], size)
        ]
        for mask in masks
    ]
    spark = nodes.sparkSession
    flip_rows = spark.createDataFrame(
        list(enumerate(flips)),
        T.StructType(
            [T.StructField("t", T.IntegerType()), T.StructField("flips", T.ArrayType(T.LongType()))]
        ),
    )
    large = (
        met.filter(F.col("n") > bucket)
        .join(F.broadcast(flip_rows), "t")  # a row per mask, of a few hundred longs each
        .select("t", "key", "fp", F.explode("flips").alias("flip"))
        .withColumn("middle", F.col("fp").bitwiseXOR(F.col("flip")))
    )
    least = large.groupBy("t", "key", "middle").agg(F.min("fp").alias("v"))
    far = (
        large.join(least.hint("merge"), ["t", "key", "middle"])
        .filter("fp <> v")
        .filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("v"))) <= radius)
        .select(F.col("fp").alias("u"), "v")
    )
    return small.unionByName(far).distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = 4, radius: int = 4, bucket: int = BUCKET
) -> DataFrame:
    """``doc_id, fp, component_id``: the least ``doc_id`` that links reach from a document."""
    rows = stored(fingerprints(docs, shingle), "fingerprints")
    return rows.join(_components(rows, radius, bucket), "fp").select("doc_id", "fp", "component_id")


def representatives(
    docs: DataFrame, shingle: int = 4, radius: int = 4, bucket: int = BUCKET
) -> DataFrame:
    """One document of every component, the one with the least ``doc_id``; columns unchanged.

    None may be called ``__id``, ``__hash`` or ``__nth``.

    Rows without an id stay only where no row of their component has one. Of rows with one id, that
    with the least text hash stays, and of equal rows one.
    """
    keyed = docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-1))).withColumn(
        "__hash", F.xxhash64(F.col("doc_id").isNull(), "text")
    )
    rows = stored(fingerprints(keyed, shingle, ["__id", "__hash"]), "fingerprints")
    place = F.struct(F.col("doc_id").isNull(), "__id", "__hash")
    kept = (
        rows.join(_components(rows, radius, bucket), "fp")
        .groupBy("root")
        .agg(F.min(place).alias("kept"))
        .select("kept.__id", "kept.__hash")
    )
    # The join and the choice among equal rows need the same partitioning.
    order = Window.partitionBy("__id", "__hash").orderBy("__id")
    return (
        keyed.join(kept, ["__id", "__hash"], "left_semi")
        .withColumn("__nth", F.row_number().over(order))
        .filter("__nth = 1")
        .drop("__id", "__hash", "__nth")
    )


def _components(rows: DataFrame, radius: int, bucket: int) -> DataFrame:
    """``fp, root, component_id`` of all distinct fingerprints."""
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = components(links(nodes, radius, bucket))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return stored(rooted.join(named, "root").select("fp", "root", "component_id"), "components")
