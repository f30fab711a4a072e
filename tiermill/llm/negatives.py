"""Hard negatives from exact integer scores, computed as float32 products modulo small primes.

Components become integers. A score is an inner product of integers, and its residue modulo a prime is the
product of the residues, centred around zero. The primes are so small that float32 holds every such product
exactly, and so many that their product exceeds every score's range; the Chinese remainder theorem then gives
the signed score. How large scores can be is known from the longest vector.

Every row is a candidate for every anchor. Rows are packed into blocks; anchors are taken `ANCHORS` at a time,
a bounded set that is sent to all tasks, and each set needs two passes over the blocks: one finds the positives,
the next the rows inside each positive's window of scores. A task keeps the best few of each list across all its
blocks, so what moves is a handful of rows per task and list, merged by a window on the list.

Rows with a null label or vector, or with a null or non-finite component, take no part. Null ids sort last, are
never anchors, and have no flipped label. Equal ids are different rows: only the anchor's own row is excluded,
and each row that is an anchor has lists of its own. Vectors of different lengths, or scores beyond 2^48, raise
a ValueError. Without rows, anchors or positives the result is empty. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermill.llm.common import finite, stored, table_folder, to_python

SCALE = 256
BLOCK = 4096
ANCHORS = 32_768
STEP = 256
EXACT = 1 << 24
# A score and a place in a block share 64 bits.
LIMIT = 1 << 48
# Stands for a null id; sorts after all others.
NO_ID = (1 << 63) - 1
NONE = np.iinfo(np.int64).min


def primes_for(depth: int, largest: int) -> list[int]:
    """Primes whose residues multiply exactly over ``depth`` terms and that tell scores within ±largest apart."""
    half = math.isqrt(EXACT // max(1, depth))
    found, product, at = [], 1, 2 * half + 1
    while product <= 2 * largest + 1 or len(found) < 2:
        while at > 2 and any(at % d == 0 for d in range(2, math.isqrt(at) + 1)):
            at -= 1
        if at < 3:
            raise ValueError("vectors are too long for exact products")
        found.append(at)
        product *= at
        at -= 1
    return found


class Residues:
    """Matrix products of integer rows by their residues modulo some primes."""

    def __init__(self, primes: list[int]) -> None:
        self.primes = primes

    def split(self, rows: np.ndarray) -> list[np.ndarray]:
        """The residues of each component, between ``-p/2`` and ``p/2``, in float32."""
        return [((rows + p // 2) % p - p // 2).astype(np.float32) for p in self.primes]

    def product(self, left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
        """Inner products of all pairs of rows, exact and signed."""
        value, modulus = None, 1
        for p, a, b in zip(self.primes, left, right):
            residue = np.rint(a @ b.T).astype(np.int64) % p
            if value is None:
                value = residue
            else:
                # The digit that makes the value right modulo p too.
                value = value + modulus * ((residue - value) % p * pow(modulus, -1, p) % p)
            modulus *= p
        return np.where(value > modulus // 2, value - modulus, value)


class Best:
    """The best few ``(score, id)`` of some lists; higher scores first, then smaller ids."""

    def __init__(self, lists: int, most: int) -> None:
        self.most = most
        self.scores = np.full((lists, most), NONE)
        self.ids = np.full((lists, most), NO_ID)

    def add(self, at: slice, scores: np.ndarray, ids: np.ndarray) -> None:
        """Candidates of the lists ``at``, by row; `NONE` is no candidate."""
        scores = np.c_[self.scores[at], scores]
        ids = np.c_[self.ids[at], ids]
        # Scores are above the least integer but for those that are none.
        order = np.lexsort((ids, -np.maximum(scores, NONE + 1)), axis=-1)[:, : self.most]
        self.scores[at] = np.take_along_axis(scores, order, 1)
        self.ids[at] = np.take_along_axis(ids, order, 1)

    def rows(self, lists: np.ndarray) -> pa.RecordBatch:
        used = self.scores != NONE
        ids = self.ids[used]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(lists, used.sum(axis=1))),
                pa.array(self.scores[used]),
                pa.array(ids, mask=ids == NO_ID),
            ],
            names=["list", "score", "id"],
        )


LISTED = "list long, score long, id long"


def top(scores: np.ndarray, most: int) -> np.ndarray:
    """Columns of the ``most`` highest scores of each row, ties to lower columns, highest first."""
    width = scores.shape[1]
    shift = np.int64(max(1, (width - 1).bit_length()))
    keys = (scores << shift) | (width - 1 - np.arange(width))
    keys[scores == NONE] = NONE
    if width > most:
        keys = np.partition(keys, width - most, axis=1)[:, width - most :]
    keys = np.sort(keys, axis=1)[:, ::-1]
    return np.where(keys == NONE, -1, width - 1 - (keys & ((1 << shift) - 1)))


def _add_top(best: Best, at: slice, scores: np.ndarray, ids: np.ndarray) -> None:
    columns = top(scores, best.most)
    found = np.where(columns < 0, NONE, np.take_along_axis(scores, np.maximum(columns, 0), 1))
    best.add(at, found, ids[np.maximum(columns, 0)])


class Anchors:
    """A bounded set of anchors, as every task gets it."""

    def __init__(self, rows: list, residues: Residues) -> None:
        self.residues = residues
        self.row = np.array([row["row"] for row in rows], np.int64)
        self.label = np.array([row["label"] for row in rows], np.int64)
        self.vector = np.stack([np.frombuffer(row["vector"], "<i8") for row in rows])
        self.positive = None

    def scored(self, batches: Iterator[pa.RecordBatch]):
        """Per block and some anchors: their slice, scores, labels, row numbers and ids, in order of ids."""
        parts = self.residues.split(self.vector)
        for batch in batches:
            for at in range(batch.num_rows):
                ids = batch.column("ids")[at].values.to_numpy()
                order = np.argsort(ids, kind="stable")
                vectors = np.frombuffer(batch.column("vectors")[at].as_buffer(), "<i8")
                vectors = vectors.reshape(len(ids), -1)[order]
                labels = batch.column("labels")[at].values.to_numpy()[order]
                rows = batch.column("block")[at].as_py() + order
                own = self.residues.split(vectors)
                for start in range(0, len(self.row), STEP):
                    some = slice(start, start + STEP)
                    scores = self.residues.product([x[some] for x in parts], own)
                    yield some, scores, labels, rows, ids[order]

    def positives(self, batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
        best = Best(len(self.row), most)
        for some, scores, labels, rows, ids in self.scored(batches):
            other = (labels != self.label[some][:, None]) | (rows == self.row[some][:, None])
            scores[other] = NONE
            _add_top(best, some, scores, ids)
        yield best.rows(np.arange(len(self.row)))

    def negatives(
        self, batches: Iterator[pa.RecordBatch], most: int, share: tuple[int, int]
    ) -> Iterator[pa.RecordBatch]:
        """Lists are numbered by anchor, then positive."""
        least, whole = share
        several = self.positive.shape[1]
        lists = [Best(len(self.row), most) for _ in range(several)]
        for some, scores, labels, rows, ids in self.scored(batches):
            same = labels == self.label[some][:, None]
            for best, high in zip(lists, self.positive[some].T[:, :, None]):
                # Scores are integers: from the least share rounded up to the positive's own.
                low = -((-least * high) // whole)
                out = same | (scores < low) | (scores > high) | (high == NONE)
                if not out.all():
                    _add_top(best, some, np.where(out, NONE, scores), ids)
        for at, best in enumerate(lists):
            yield best.rows(np.arange(len(self.row)) * several + at)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows packed into blocks; a row's number is its block's plus its place."""
    number = TaskContext.get().partitionId() << 40
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            values = part.column("vector").flatten().to_numpy(zero_copy_only=False).astype("<i8")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([part.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([part.column("label").to_pylist()], pa.list_(pa.int64())),
                    pa.array([values.tobytes()], pa.binary()),
                ],
                names=["block", "ids", "labels", "vectors"],
            )
            number += part.num_rows


def _anchor_rows(batches: Iterator[pa.RecordBatch], every: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            ids = batch.column("ids")[at].values.to_numpy()
            chosen = np.flatnonzero((ids % every == 0) & (ids != NO_ID))
            vectors = np.frombuffer(batch.column("vectors")[at].as_buffer(), "<i8")
            vectors = vectors.reshape(len(ids), -1)[chosen]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(batch.column("block")[at].as_py() + chosen),
                    pa.array(ids[chosen]),
                    batch.column("labels")[at].values.take(pa.array(chosen)),
                    pa.array([x.tobytes() for x in vectors], pa.binary()),
                ],
                names=["row", "vec_id", "label", "vector"],
            )


def _first(found: DataFrame, most: int) -> DataFrame:
    """The best few of each list, from the best few of each task."""
    order = Window.partitionBy("list").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def _turns(anchors: DataFrame, size: int) -> Iterator[list]:
    """All anchors, ``size`` at a time, in order of their numbers; only one set is held."""
    after = -1
    while True:
        rows = anchors.filter(F.col("row") > after).orderBy("row").limit(size).collect()
        if not rows:
            return
        yield rows
        if len(rows) < size:
            return
        after = rows[-1]["row"]


def hard_negatives(
    rows: DataFrame,
    label: Column | None = None,
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    share: tuple[int, int] = (80, 100),
    scale: int = SCALE,
    anchors_at_once: int = ANCHORS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are rows whose ``vec_id`` is divisible by ``every``. For each anchor and each of its best
    ``positives`` of the same label, the best ``negatives`` of other labels whose score is between ``share``
    of the positive's and the positive's own. ``label`` replaces the label column; null takes no part.
    """
    spark = rows.sparkSession
    label = F.col("label") if label is None else label
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    sound = rows.filter(finite("embedding") & label.isNotNull())
    kept = sound.select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("vec_id"),
        label.cast("long").alias("label"),
        vector.alias("vector"),
    )
    length = F.aggregate(
        "embedding",
        F.lit(0.0),
        lambda total, x: total + F.pow(F.abs(x.cast("double")) * scale + 1, F.lit(2)),
    )
    shape = sound.agg(
        F.min(F.size("embedding")).alias("least"),
        F.max(F.size("embedding")).alias("most"),
        F.max(length).alias("squared"),
    ).first()
    schema = (
        "anchor_id long, positive_id long, rank int, negative_id long, "
        "positive_score long, negative_score long"
    )
    if not shape["least"]:
        return spark.createDataFrame([], schema)
    if shape["least"] != shape["most"]:
        raise ValueError("vectors must share one length")
    if shape["squared"] >= LIMIT:
        raise ValueError("scores are too large to be exact")
    # No inner product exceeds the longest vector's with itself.
    residues = Residues(primes_for(shape["most"], math.ceil(shape["squared"] * (1 + 1e-9))))

    blocks = stored(
        to_python(kept).mapInArrow(
            _blocks, "block long, ids array<long>, labels array<long>, vectors binary"
        ),
        "negatives-blocks",
    )
    chosen = stored(
        to_python(blocks).mapInArrow(
            lambda batches: _anchor_rows(batches, every),
            "row long, vec_id long, label long, vector binary",
        ),
        "negatives-anchors",
    )
    path = table_folder(spark, "negatives-found")
    spark.createDataFrame([], schema).write.parquet(path)
    for turn in _turns(chosen, anchors_at_once):
        anchors = Anchors(turn, residues)
        sent = spark.sparkContext.broadcast(anchors)

        def find_positives(batches, sent=sent):
            return sent.value.positives(batches, positives)

        found = _first(blocks.mapInArrow(find_positives, LISTED), positives).collect()
        sent.unpersist()
        if not found:
            continue
        anchors.positive = np.full((len(turn), positives), NONE)
        for row in found:
            anchors.positive[row["list"], row["rank"] - 1] = row["score"]
        sent = spark.sparkContext.broadcast(anchors)

        def find_negatives(batches, sent=sent):
            return sent.value.negatives(batches, negatives, share)

        near = _first(blocks.mapInArrow(find_negatives, LISTED), negatives)
        heads = spark.createDataFrame(
            [
                (
                    row["list"] * positives + row["rank"] - 1,
                    turn[row["list"]]["vec_id"],
                    row["id"],
                    row["score"],
                )
                for row in found
            ],
            "list long, anchor_id long, positive_id long, positive_score long",
        )
        near.join(heads, "list").select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        ).write.mode("append").parquet(path)
        sent.unpersist()
    return spark.read.schema(schema).parquet(path)
