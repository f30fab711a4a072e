"""Product codes of vectors: exact integer clustering of their parts with adaptive distance bounds.

Components become integers, vectors are cut into equal parts, and every part position has a codebook that
some rounds of assigning and averaging refine. Each part keeps, from round to round,

* its entry and an upper bound of the distance to it,
* its ``b`` next closest entries with lower bounds in ascending order,
* one outer bound below the distance to every other entry.

A round moves the bounds by as much as the entries have moved. A part whose upper bound stays below its
first lower bound keeps its entry unseen; otherwise the bound is made exact, then as many listed entries as
could be nearer are measured in integers, and all entries only where the outer bound does not rule them out.
Bounds are rounded away from the truth and must differ to decide, so ties are always settled by integers.
``b`` follows what the last round needed, by block and part position.

Vectors are packed into blocks; a round reads the last round's table in the shared folder, writes the next
one with the block's sums, and removes the one before. Only codebooks and their sums, a few thousand numbers,
reach the driver.

Rows whose vector is null or holds a null or non-finite component are dropped. Without rows the result is
empty; with fewer rows than entries the codebooks have as many entries as rows. Equal ids are ordered by their
integers and null ids come last where the first entries are chosen. Labels may be null and have any type that
can be grouped. Vectors of different lengths, of a length that the parts do not divide, or with components
beyond 2^26 after scaling raise a ValueError, as sums could not be exact. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from tiermill.llm.common import finite, join_totals, stored, table_folder, to_python
from tiermill.sources.workspace import remove_folder

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
BLOCK = 4096
LARGEST = 1 << 26
# More than this share of parts measured against all entries asks for longer lists.
WIDEN = 0.125


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def _squares(points: np.ndarray, book: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of each point to its own entries."""
    apart = points[:, None, :] - book[entries]
    return np.einsum("nek,nek->ne", apart, apart)


@dataclass
class Bounds:
    """What the parts at one position of a block know: see the module's docstring."""

    entry: np.ndarray
    upper: np.ndarray
    near: np.ndarray
    lower: np.ndarray
    outer: np.ndarray

    @classmethod
    def measured(cls, points: np.ndarray, book: np.ndarray, width: int) -> Bounds:
        """From the distances to all entries."""
        size = len(book)
        entries = np.broadcast_to(np.arange(size), (len(points), size))
        squares = _squares(points, book, entries)
        order = np.argsort(squares, axis=1, kind="stable")
        roots = np.sqrt(np.take_along_axis(squares, order, 1).astype(np.float64))
        outer = roots[:, width + 1] if width + 1 < size else np.full(len(points), np.inf)
        return cls(
            order[:, 0].astype(np.uint8),
            _up(roots[:, 0]),
            order[:, 1 : width + 1].astype(np.uint8),
            _down(roots[:, 1 : width + 1]),
            _down(outer),
        )

    def moved(self, moves: np.ndarray) -> None:
        """After entries have moved by at most so much."""
        self.upper = _up(self.upper.astype(np.float64) + moves[self.entry])
        self.lower = _down(self.lower.astype(np.float64) - moves[self.near])
        self.outer = _down(self.outer.astype(np.float64) - moves.max())
        self.order()

    def order(self) -> None:
        """No bound above a later one."""
        both = np.c_[self.lower, self.outer]
        both = np.minimum.accumulate(both[:, ::-1], axis=1)[:, ::-1]
        self.lower = np.ascontiguousarray(both[:, :-1])

    def least(self) -> np.ndarray:
        return self.lower[:, 0] if self.lower.shape[1] else self.outer

    def assign(self, points: np.ndarray, book: np.ndarray) -> Bounds:
        """The nearest entry of every part, ties to the lower index; the result has the list that fits."""
        width = self.near.shape[1]
        open_ = np.flatnonzero(self.upper >= self.least())
        exact = _squares(points[open_], book, self.entry[open_][:, None])[:, 0]
        self.upper[open_] = _up(np.sqrt(exact.astype(np.float64)))
        open_ = open_[self.upper[open_] >= self.least()[open_]]
        reached = (self.lower[open_] <= self.upper[open_][:, None]).sum(axis=1)
        unbound = self.upper[open_] >= self.outer[open_]
        for count in np.unique(reached[~unbound]).tolist():
            some = open_[~unbound & (reached == count)]
            found = np.sort(np.c_[self.entry[some], self.near[some, :count]], axis=1)
            squares = _squares(points[some], book, found)
            order = np.argsort(squares, axis=1, kind="stable")
            found = np.take_along_axis(found, order, 1)
            roots = np.sqrt(np.take_along_axis(squares, order, 1).astype(np.float64))
            self.entry[some], self.upper[some] = found[:, 0], _up(roots[:, 0])
            self.near[some, :count], self.lower[some, :count] = found[:, 1:], _down(roots[:, 1:])
        rest = open_[unbound]
        fresh = Bounds.measured(points[rest], book, width)
        for name in ("entry", "upper", "near", "lower", "outer"):
            getattr(self, name)[rest] = getattr(fresh, name)
        self.order()
        if len(rest) > WIDEN * len(points):
            return self.resized(min(width + 1, len(book) - 1))
        needed = int(reached[~unbound].max(initial=0))
        return self.resized(min(width, max(1, len(book) // 8, needed)))

    def resized(self, width: int) -> Bounds:
        """Shorter lists, whose bounds join the outer one, or lists with one more place to fill."""
        had = self.near.shape[1]
        if width < had:
            outer = np.minimum(self.outer, self.lower[:, width])
            return Bounds(self.entry, self.upper, self.near[:, :width], self.lower[:, :width], outer)
        for _ in range(width - had):
            # The own entry once more; the outer bound still holds for what is not listed.
            self.near = np.c_[self.near, self.entry]
            self.lower = np.c_[self.lower, self.outer]
        return self

    def packed(self) -> bytes:
        arrays = (self.entry, self.upper, self.near, self.lower, self.outer)
        return b"".join(np.ascontiguousarray(x).tobytes() for x in arrays)

    @classmethod
    def unpacked(cls, raw: memoryview, size: int, width: int) -> Bounds:
        shapes = (("u1", 1), ("<f4", 1), ("u1", width), ("<f4", width), ("<f4", 1))
        found, at = [], 0
        for kind, many in shapes:
            array = np.frombuffer(raw, kind, size * many, at).copy()
            at += array.nbytes
            found.append(array)
        entry, upper, near, lower, outer = found
        return cls(entry, upper, near.reshape(size, width), lower.reshape(size, width), outer)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors packed into blocks of integers."""
    held: list[pa.RecordBatch] = []
    number = TaskContext.get().partitionId() << 32

    def block(rows: pa.Table) -> pa.RecordBatch:
        vectors = rows["vector"].combine_chunks()
        values = vectors.flatten().to_numpy(zero_copy_only=False).astype("<i4")
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([rows["vec_id"].to_pylist()], pa.list_(pa.int64())),
                pa.array([rows["label"].to_pylist()], pa.list_(rows.schema.field("label").type)),
                pa.array([values.tobytes()], pa.binary()),
                pa.array([None], pa.list_(pa.int32())),
                pa.array([None], pa.binary()),
                pa.array([None], pa.binary()),
            ],
            names=["block", "ids", "labels", "vectors", "widths", "bounds", "sums"],
        )

    count = 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        while count >= BLOCK:
            rows = pa.Table.from_batches(held)
            yield block(rows.slice(0, BLOCK))
            number += 1
            held, count = rows.slice(BLOCK).to_batches(), count - BLOCK
    if count:
        yield block(pa.Table.from_batches(held))


class Round:
    """One assignment of all blocks to the codebooks, and what the codebooks become."""

    def __init__(self, books: np.ndarray, moves: np.ndarray | None) -> None:
        self.books, self.moves = books, moves

    def bounds(self, row: dict, points: np.ndarray) -> list[Bounds]:
        """Bounds of every part position of a block after this assignment."""
        parts, size, depth = self.books.shape
        found, at = [], 0
        for part in range(parts):
            own = points[:, part * depth : (part + 1) * depth]
            if self.moves is None:
                found.append(Bounds.measured(own, self.books[part], min(size - 1, max(1, size // 4))))
                continue
            width = row["widths"][part]
            length = len(points) * (9 + 5 * width)
            known = Bounds.unpacked(row["bounds"][at : at + length], len(points), width)
            at += length
            known.moved(self.moves[part])
            found.append(known.assign(own, self.books[part]))
        return found

    def points(self, row: dict) -> np.ndarray:
        parts, _, depth = self.books.shape
        values = np.frombuffer(row["vectors"], "<i4").astype(np.int64)
        return values.reshape(len(row["ids"]), parts * depth)

    def sums(self, points: np.ndarray, found: list[Bounds]) -> np.ndarray:
        """By part position and entry: the sum of the parts, and their number."""
        parts, size, depth = self.books.shape
        sums = np.zeros((parts, size, depth + 1), np.int64)
        for part, known in enumerate(found):
            own = points[:, part * depth : (part + 1) * depth]
            np.add.at(sums[part], known.entry, np.c_[own, np.ones(len(own), np.int64)])
        return sums

    def step(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                row = one.to_pylist()[0]
                points = self.points(row)
                found = self.bounds(row, points)
                fresh = {
                    "widths": pa.array([[x.near.shape[1] for x in found]], pa.list_(pa.int32())),
                    "bounds": pa.array([b"".join(x.packed() for x in found)], pa.binary()),
                    "sums": pa.array([self.sums(points, found).tobytes()], pa.binary()),
                }
                columns = [fresh.get(name, one.column(i)) for i, name in enumerate(one.schema.names)]
                yield pa.RecordBatch.from_arrays(columns, names=one.schema.names)

    def codes(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The last assignment: codes and errors by vector."""
        parts, _, depth = self.books.shape
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                points = self.points(row)
                found = self.bounds(row, points)
                error = np.zeros(len(points), np.int64)
                for part, known in enumerate(found):
                    own = points[:, part * depth : (part + 1) * depth]
                    error += _squares(own, self.books[part], known.entry[:, None])[:, 0]
                entries = np.stack([known.entry for known in found], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[at].values,
                        batch.column("labels")[at].values,
                        pa.array([x.tobytes().hex() for x in entries], pa.string()),
                        pa.array(error),
                    ],
                    names=["vec_id", "label", "code", "error"],
                )


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sums, one row for each number."""
    total = None
    for batch in batches:
        for cell in batch.column("sums"):
            sums = np.frombuffer(cell.as_buffer(), np.int64)
            total = sums.copy() if total is None else total + sums
    if total is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total))), pa.array(total)], names=["place", "total"]
        )


def _refined(books: np.ndarray, sums: np.ndarray) -> np.ndarray:
    counts = sums[:, :, -1:]
    return np.where(counts > 0, sums[:, :, :-1] // np.maximum(counts, 1), books)


def _moves(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    squares = np.square(new - old).sum(axis=2).astype(np.float64)
    return np.where(squares > 0, np.nextafter(np.sqrt(squares) * (1 + 1e-12), np.inf), 0.0)


def _digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(
    rows: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every vector that is kept.

    ``code`` has two hex digits for each part; ``error`` is the squared distance to the coded vector in
    integers; ``label_error`` its sum over the vectors of the same label, null being a label too.
    """
    spark = rows.sparkSession
    if not 1 <= entries <= 255:
        raise ValueError("a codebook has 1 to 255 entries")
    sound = rows.select("vec_id", "label", "embedding").filter(finite("embedding"))
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    kept = to_python(
        sound.select(F.col("vec_id").cast("long").alias("vec_id"), "label", vector.alias("vector"))
    )
    shape = sound.agg(
        F.min(F.size("embedding")).alias("least"),
        F.max(F.size("embedding")).alias("most"),
        F.max(F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double"))))).alias("far"),
    ).first()
    kind = kept.schema["label"].dataType
    if shape["least"] is None:
        nothing = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
        return spark.createDataFrame([], nothing)
    if shape["least"] != shape["most"] or shape["most"] % parts:
        raise ValueError(f"vectors must share one length that {parts} divides")
    if (shape["far"] or 0) * scale > LARGEST:
        raise ValueError(f"components must be within {LARGEST} after scaling")

    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    books = np.array([row["vector"] for row in first], np.int64).reshape(len(first), parts, -1)
    books = np.ascontiguousarray(books.transpose(1, 0, 2))

    schema = StructType.fromDDL(
        "block long, ids array<long>, vectors binary, widths array<int>, bounds binary, sums binary"
    )
    schema = StructType([*schema.fields[:2], StructField("labels", ArrayType(kind)), *schema.fields[2:]])

    def write(frame: DataFrame) -> str:
        path = table_folder(spark, "codes-round")
        frame.write.parquet(path)
        return path

    path = write(kept.mapInArrow(_blocks, schema))
    moves = None
    for _ in range(rounds):
        turn = Round(books, moves)
        last, path = path, write(spark.read.parquet(path).mapInArrow(turn.step, schema))
        remove_folder(spark, last)
        sums = (
            spark.read.parquet(path)
            .select("sums")
            .mapInArrow(_totals, "place long, total long")
            .groupBy("place")
            .agg(F.sum("total").alias("total"))
            .orderBy("place")
            .collect()
        )
        size = (*books.shape[:2], books.shape[2] + 1)
        fresh = _refined(books, np.array([row["total"] for row in sums], np.int64).reshape(size))
        moves, books = _moves(books, fresh), fresh

    turn = Round(books, moves)
    result = StructType.fromDDL("vec_id long, code string, error long")
    result = StructType([result.fields[0], StructField("label", kind), *result.fields[1:]])
    coded = stored(spark.read.parquet(path).mapInArrow(turn.codes, result), "codes")
    remove_folder(spark, path)
    return join_totals(coded, "label", "error", "label_error").select(
        "vec_id", "code", "error", "label_error", F.lit(_digest(books)).alias("codebooks_sha256")
    )
