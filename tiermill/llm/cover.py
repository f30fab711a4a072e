"""Exact removal of repeated byte strings by blockwise suffix sorting with a difference cover.

Places are counted from the start of their document. A cover ``D`` of period ``v`` holds two residues of
every difference, so that for any two places ``p`` and ``q`` some ``step < v`` puts both ``p + step`` and
``q + step`` on the cover. Two equal strings of ``length`` bytes thus share a sample place in the same
spot, followed by at least ``length - v + 1`` equal bytes. Texts are packed into chunks, and suffixes are
sorted bucket by bucket: a bucket is a range of the sort order, all its suffixes meet in one task, and
there are as many buckets as keep each one small. Suffixes are in the order of their fingerprints, not of
the alphabet, as only equal beginnings have to become neighbours.

1. All sample suffixes are sorted by their first ``length - v + 1`` bytes. Those alone in their class, and
   all places that reach no other, are done.
2. Samples that share a class get a rank by what surrounds them: the ``v - 1`` bytes before and ``length`` bytes
   after, which hold every string through the sample. Equal ranks settle long ties at once: all those
   strings are repeated, and a later copy need not be sorted any more. So are classes of one rank.
3. Places left, near the ends of repeats, are sorted by all of their ``length`` bytes.

A chunk sends each different suffix once, so a hot passage costs an entry per chunk, and what comes back is a
flag per entry in the order sent. The chunks are bucketed by number once; no later step moves text. Class
names have 32 bits and those of their bucket, ranks 128 bits in all, strings 96 bits.

Null texts count as empty; empty and short texts lose nothing. A row that occurs twice counts twice. Ids may be
null or repeat; only ``doc_id`` and ``text`` are read, and rows of the result stand for rows of the input.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import bucketed, stored, to_python

LENGTH = 200
CHUNK_BYTES = 4 << 20
BUCKET_ENTRIES = 1 << 20
# An entry's row must carry about so many entries on average, or rows outweigh what they carry.
ROW_ENTRIES = 16
SEGMENT = 1 << 18
WORD = 8
PRIMES = (13, 11, 7, 5, 3, 2)
BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
SALTS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
MIXED, ELSEWHERE, LATER = 1, 2, 4


def difference_cover(prime: int) -> np.ndarray:
    """``prime + 1`` residues whose differences are all residues mod ``prime**2 + prime + 1``, each once.

    Singer's construction: the powers of x without a square term, in the field of cubes over ``prime``.
    """
    period = prime * prime + prime + 1
    for a in range(prime):
        for b in range(prime):
            for c in range(1, prime):
                found, power = [], (1, 0, 0)
                for at in range(period):
                    if power[2] == 0:
                        found.append(at)
                    low, mid, top = power
                    power = (c * top % prime, (low + b * top) % prime, (mid + a * top) % prime)
                apart = {(x - y) % period for x in found for y in found}
                if len(found) == prime + 1 and len(apart) == period:
                    return np.array(found)
    raise AssertionError("every prime has such a cover")


@dataclass(frozen=True)
class Cover:
    """Period and residues for strings of one length, and how many equal bytes a sample sees."""

    length: int
    period: int
    residues: tuple[int, ...]

    @property
    def seen(self) -> int:
        return self.length - self.period + 1


@lru_cache(maxsize=8)
def cover_for(length: int) -> Cover:
    """The sparsest cover that leaves a third of the string, and eight bytes, to tell samples apart."""
    for prime in PRIMES:
        period = prime * prime + prime + 1
        if 3 * period <= 2 * length and length - period + 1 >= WORD:
            return Cover(length, period, tuple(difference_cover(prime).tolist()))
    raise ValueError("strings must have 14 bytes or more")


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit integers, in place."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=4)
def _powers(size: int, lane: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (BASES[lane], pow(BASES[lane], -1, 1 << 64)):
        powers = np.full(size, base, np.uint64)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers))
    return out[0], out[1]


def names(data: np.ndarray, first: np.ndarray, stop: np.ndarray, lane: int) -> np.ndarray:
    """Fingerprints of the byte ranges ``[first, stop)`` of eight bytes or more; ``first`` ascends.

    Works through segments, so memory does not depend on how long a text is.
    """
    out = np.empty(len(first), np.uint64)
    at = 0
    while at < len(first):
        low = int(first[at])
        end = int(np.searchsorted(first, low + SEGMENT))
        high = int(stop[at:end].max())
        size = high - low - WORD + 1
        words = np.ndarray((size,), "<u8", data[low:high], strides=(1,)) ^ np.uint64(SALTS[lane])
        powers, inverse = _powers(max(2 * SEGMENT, 1 << size.bit_length()), lane)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(mixed(words) * powers[:size], out=sums[1:])
        begin = first[at:end] - low
        over = stop[at:end] - low - WORD + 1
        out[at:end] = mixed(
            (sums[over] - sums[begin]) * inverse[begin] + (over - begin).astype(np.uint64)
        )
        at = end
    return out


@dataclass
class Samples:
    """Sample places of a chunk in order, and the bounds of their documents."""

    place: np.ndarray
    start: np.ndarray
    end: np.ndarray


def samples_of(sizes: np.ndarray, cover: Cover) -> Samples:
    """The places on the cover in documents that hold a string at all."""
    ends = np.cumsum(sizes)
    longest = int(sizes.max(initial=0))
    turns = np.arange(longest // cover.period + 1)[:, None] * cover.period
    pattern = (turns + np.array(cover.residues)).ravel()
    counts = np.where(sizes < cover.length, 0, np.searchsorted(pattern, sizes - cover.seen, "right"))
    starts = ends - sizes
    own = [pattern[:n] + at for n, at in zip(counts.tolist(), starts.tolist()) if n]
    place = np.concatenate(own) if own else np.zeros(0, np.int64)
    return Samples(place, np.repeat(starts, counts), np.repeat(ends, counts))


def union(first: np.ndarray, last: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in any of the ranges ``[first, last]``, given by ascending firsts."""
    inside = np.zeros(size + 1, np.int8)
    if len(first):
        reach = np.maximum.accumulate(last)
        heads = np.flatnonzero(np.r_[True, first[1:] > reach[:-1] + 1])
        inside[first[heads]] = 1
        inside[reach[np.r_[heads[1:] - 1, len(first) - 1]] + 1] -= 1
    return np.cumsum(inside, dtype=np.int8)[:size].astype(bool)


@dataclass
class Entries:
    """Different keys of a chunk in sorted order, the entry of every item, and items that are not alone."""

    a: np.ndarray
    b: np.ndarray | None
    entry: np.ndarray
    many: np.ndarray
    again: np.ndarray

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray | None = None) -> Entries:
        order = np.argsort(a, kind="stable") if b is None else np.lexsort((b, a))
        a = a[order]
        new = a[1:] != a[:-1]
        if b is not None:
            b = b[order]
            new = new | (b[1:] != b[:-1])
        fresh = np.r_[True, new][: len(a)]
        heads = np.flatnonzero(fresh)
        entry = np.empty(len(a), np.int64)
        entry[order] = np.cumsum(fresh) - 1
        again = np.empty(len(a), bool)
        again[order] = ~fresh
        counts = np.diff(np.r_[heads, len(a)])
        return cls(a[heads], None if b is None else b[heads], entry, counts > 1, again)


@lru_cache(maxsize=4)
def _bounds(buckets: int) -> np.ndarray:
    """Least key of every bucket."""
    return np.array([-((-at << 64) // buckets) for at in range(buckets)], np.uint64)


def _binary(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    width = values.dtype.itemsize
    return pa.Array.from_buffers(
        pa.binary(),
        len(offsets) - 1,
        [None, pa.py_buffer((offsets * width).astype(np.int32)), pa.py_buffer(values.tobytes())],
    )


def _dealt(chunk: int, entries: Entries, buckets: int, short: bool) -> pa.RecordBatch:
    """A chunk's entries, one row for each bucket that they reach."""
    bounds = _bounds(buckets)
    offsets = np.r_[np.searchsorted(entries.a, bounds), len(entries.a)]
    used = np.flatnonzero(np.diff(offsets))
    cuts = np.r_[offsets[used], len(entries.a)].astype(np.int64)
    a = entries.a
    if short:
        # The bits after those that the bucket tells.
        lower = a - np.repeat(bounds[used], np.diff(cuts))
        a = (lower >> np.uint64(max(0, 32 - (buckets.bit_length() - 1)))).astype(np.uint32)
    second = np.zeros(0, np.uint8) if entries.b is None else entries.b
    return pa.RecordBatch.from_arrays(
        [
            pa.array(used.astype(np.int64)),
            pa.array(np.full(len(used), chunk, np.int64)),
            _binary(cuts, a),
            _binary(cuts if entries.b is not None else np.zeros(len(cuts), np.int64), second),
        ],
        names=["bucket", "chunk", "a", "b"],
    )


DEALT = "bucket long, chunk long, a binary, b binary"


def _joined(cells: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(cells.to_pylist()), kind)


def judged(rows: pa.Table, kind_a: str, kind_b: str | None) -> pa.Table:
    """Sorts the suffixes of one bucket and tells each entry about its neighbours.

    Flags: `MIXED`, equal in ``a`` to an entry that differs in ``b``; `ELSEWHERE`, equal in both to an entry of
    another chunk; `LATER`, of an earlier chunk.
    """
    rows = rows.sort_by("chunk")
    a = _joined(rows["a"], kind_a)
    lengths = np.array([len(x) for x in rows["a"].to_pylist()]) // np.dtype(kind_a).itemsize
    chunk = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    if kind_b is None:
        order = np.argsort(a, kind="stable")
        new = np.diff(a[order]) != 0
        flags = np.zeros(len(a), np.uint8)
    else:
        b = _joined(rows["b"], kind_b)
        order = np.lexsort((b, a))
        other = np.r_[True, np.diff(a[order]) != 0]
        new = other[1:] | (np.diff(b[order]) != 0)
        kinds = np.add.reduceat(np.r_[True, new].astype(np.int32), np.flatnonzero(other))
        flags = ((kinds > 1) * MIXED).astype(np.uint8)[np.cumsum(other) - 1]
    # The sort is stable, so within a class chunks ascend.
    heads = np.flatnonzero(np.r_[True, new])
    sizes = np.diff(np.r_[heads, len(a)])
    chunk = chunk[order]
    least, most = chunk[heads], chunk[heads + sizes - 1]
    flags |= np.repeat((least != most) * np.uint8(ELSEWHERE), sizes).astype(np.uint8)
    flags |= ((chunk != np.repeat(least, sizes)) * np.uint8(LATER)).astype(np.uint8)
    told = np.empty(len(a), np.uint8)
    told[order] = flags
    return pa.table(
        {
            "chunk": rows["chunk"],
            "told": pa.chunked_array(
                [
                    pa.StructArray.from_arrays(
                        [
                            rows["bucket"].combine_chunks(),
                            _binary(np.r_[0, np.cumsum(lengths)], told),
                        ],
                        ["bucket", "flags"],
                    )
                ]
            ),
        }
    )


def _answers(dealt: DataFrame, kind_a: str, kind_b: str | None, name: str) -> DataFrame:
    """For every chunk, the flags of its entries in order, once all buckets are sorted."""

    def judge(rows: pa.Table) -> pa.Table:
        return judged(rows, kind_a, kind_b)

    told = dealt.groupBy("bucket").applyInArrow(
        judge, "chunk long, told struct<bucket:long,flags:binary>"
    )
    return stored(
        told.groupBy("chunk").agg(F.sort_array(F.collect_list("told"))["flags"].alias(name)),
        f"cover-{name}",
    )


def _packed(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """Documents packed into chunks, compressed; a long text has a chunk of its own."""
    at = TaskContext.get().partitionId() << 32
    ids, sizes, pieces, size = [], [], [], 0

    def chunk() -> pa.RecordBatch:
        data = pa.compress(b"".join(pieces), "zstd", asbytes=True)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([at], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([sizes], pa.list_(pa.int64())),
                pa.array([data], pa.binary()),
            ],
            names=["chunk", "ids", "sizes", "data"],
        )

    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        for key, text in zip(batch.column("doc_id").to_pylist(), texts):
            piece = text.as_py() or b""
            if pieces and size + len(piece) > chunk_bytes:
                yield chunk()
                at += 1
                ids, sizes, pieces, size = [], [], [], 0
            ids.append(key)
            sizes.append(len(piece))
            pieces.append(piece)
            size += len(piece)
    if pieces:
        yield chunk()


class Chunk:
    """A chunk's texts and, as far as answers are there, what is known of its suffixes."""

    def __init__(self, batch: pa.RecordBatch, row: int, cover: Cover) -> None:
        self.cover = cover
        self.number = batch.column("chunk")[row].as_py()
        self.ids = batch.column("ids")[row].values
        self.sizes = batch.column("sizes")[row].values.to_numpy()
        total = int(self.sizes.sum())
        raw = pa.decompress(batch.column("data")[row].as_buffer(), total, "zstd") if total else b""
        self.data = np.frombuffer(raw, np.uint8)
        self.answers = {
            name: np.frombuffer(b"".join(batch.column(name)[row].as_py() or []), np.uint8)
            for name in batch.schema.names
            if name in ("classes", "ranks", "strings")
        }
        self.samples = samples_of(self.sizes, cover)
        place = self.samples.place
        self.keys = names(self.data, place, place + cover.seen, 0)

    def classes(self) -> Entries:
        """All samples by the bytes that a sample sees."""
        return Entries.of(self.keys)

    def shared(self) -> np.ndarray:
        """Samples whose class has others."""
        found = self.classes()
        return np.flatnonzero(((self.answers["classes"] & ELSEWHERE > 0) | found.many)[found.entry])

    def ranks(self, some: np.ndarray) -> Entries:
        """Those samples by class and by what surrounds them, as far as the document goes."""
        place, cover = self.samples.place[some], self.cover
        low = np.maximum(self.samples.start[some], place - cover.period + 1)
        high = np.minimum(self.samples.end[some], place + cover.length)
        around = names(self.data, low, high, 1)
        shape = ((place - low) * 2 * cover.length + high - place).astype(np.uint64)
        return Entries.of(self.keys[some], mixed(around ^ (shape * np.uint64(SALTS[0]))))

    def settle(self) -> tuple[np.ndarray, np.ndarray]:
        """Places whose strings are repeated by rank, and places whose strings are still to be sorted."""
        some = self.shared()
        found = self.ranks(some)
        flags = self.answers["ranks"][found.entry]
        place = self.samples.place[some]
        low = np.maximum(self.samples.start[some], place - self.cover.period + 1)
        high = np.minimum(place, self.samples.end[some] - self.cover.length)

        def places(which: np.ndarray) -> np.ndarray:
            which = which & (low <= high)
            return union(low[which], high[which], len(self.data))

        repeated = places((flags & ELSEWHERE > 0) | found.many[found.entry])
        later = places((flags & LATER > 0) | found.again)
        open_ = places(flags & MIXED > 0)
        return repeated, np.flatnonzero(open_ & ~later)

    def strings(self, place: np.ndarray) -> Entries:
        """Whole strings at some places."""
        stop = place + self.cover.length
        second = (names(self.data, place, stop, 1) >> np.uint64(32)).astype(np.uint32)
        return Entries.of(names(self.data, place, stop, 0), second)

    def removed(self) -> np.ndarray:
        """Which bytes repeated strings cover."""
        repeated, place = self.settle()
        found = self.strings(place)
        repeated[place] |= ((self.answers["strings"] & ELSEWHERE > 0) | found.many)[found.entry]
        starts = np.flatnonzero(repeated)
        return union(starts, starts + self.cover.length - 1, len(self.data))


def _chunks(batches: Iterator[pa.RecordBatch], cover: Cover) -> Iterator[Chunk]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield Chunk(batch, row, cover)


def _kept(chunk: Chunk, texts: bool) -> pa.RecordBatch:
    """Per document of a chunk: sizes, spans, digest and, if asked for, what is left."""
    gone = chunk.removed()
    ends = np.cumsum(chunk.sizes)
    starts = ends - chunk.sizes
    counts = np.r_[0, np.cumsum(gone)]
    removed = counts[ends] - counts[starts]
    heads = gone.copy()
    heads[1:] &= ~gone[:-1]
    begins = starts[chunk.sizes > 0]
    heads[begins] = gone[begins]
    spans = np.r_[0, np.cumsum(heads)]
    digests, left = [], []
    for start, end, lost in zip(starts.tolist(), ends.tolist(), removed.tolist()):
        rest = chunk.data[start:end]
        rest = rest[~gone[start:end]].tobytes() if lost else rest.tobytes()
        digests.append(hashlib.sha256(rest).hexdigest())
        if texts:
            left.append(rest)
    columns = {
        "doc_id": chunk.ids,
        "n_bytes": pa.array(chunk.sizes),
        "n_removed": pa.array(removed),
        "n_spans": pa.array(spans[ends] - spans[starts]),
        "kept_sha256": pa.array(digests, pa.string()),
    }
    if texts:
        columns["kept"] = pa.array(left, pa.binary())
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _sizes(docs: DataFrame, cover: Cover) -> tuple[int, int]:
    """Bytes of a chunk and number of buckets, from the bytes of all texts.

    Samples alone fill buckets of `BUCKET_ENTRIES`. Whole strings are as many at most as there are bytes, which
    are then four times that in a bucket, and far fewer where most text is unique.

    Both grow with the square root of very large inputs, so that a chunk has some entries for each bucket.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    entries = max(1, total * len(cover.residues) // cover.period)
    each = CHUNK_BYTES * len(cover.residues) // cover.period
    grown = max(1.0, math.sqrt(ROW_ENTRIES * entries / (each * BUCKET_ENTRIES)))
    return int(CHUNK_BYTES * grown), math.ceil(max(entries, total / 4) / (BUCKET_ENTRIES * grown))


def remove_repeated_bytes(
    docs: DataFrame, length: int = LENGTH, texts: bool = False, chunk_bytes: int | None = None
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document.

    A byte goes if a string of ``length`` bytes over it also starts anywhere else. ``texts=True`` adds the
    bytes that are left, which may be no valid UTF-8 where a cut falls into a character. ``chunk_bytes`` is
    found from the size of the input unless given.
    """
    cover = cover_for(length)
    rows = to_python(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    fitting, buckets = _sizes(rows, cover)
    chunk_bytes = chunk_bytes or fitting
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(buckets, 4 * tasks)
    chunks = bucketed(
        rows.mapInArrow(
            lambda b: _packed(b, chunk_bytes),
            "chunk long, ids array<long>, sizes array<long>, data binary",
        ),
        "chunk",
        tasks,
        "cover-chunks",
    )

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, cover):
            yield _dealt(chunk.number, chunk.classes(), buckets, short=True)

    def ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, cover):
            yield _dealt(chunk.number, chunk.ranks(chunk.shared()), buckets, short=False)

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, cover):
            yield _dealt(chunk.number, chunk.strings(chunk.settle()[1]), buckets, short=False)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, cover):
            yield _kept(chunk, texts)

    known = chunks
    for step, name, kind_a, kind_b in (
        (classes, "classes", "<u4", None),
        (ranks, "ranks", "<u8", "<u8"),
        (strings, "strings", "<u8", "<u4"),
    ):
        found = _answers(known.mapInArrow(step, DEALT), kind_a, kind_b, name)
        known = known.join(found, "chunk", "left")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return known.mapInArrow(kept, schema + (", kept binary" if texts else ""))
