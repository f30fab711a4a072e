"""Exact removal of repeated word windows, found by recompression.

A text is rewritten in rounds. A round first names every run of one symbol, then splits all symbols
into two classes and names every pair of a first-class and a second-class symbol. Names and classes are
hashes of what they stand for, so every task of the cluster gives equal phrases the same name
without a name table. Equal substrings therefore get the same symbols, except near their ends: in
each round at most the outermost run and one more symbol depend on what lies outside. What is left
of a window between those ends, its interior, depends on the window alone.

1. Every window picks its anchor: the least name of `SPAN` neighbouring interior symbols. Windows in
   a row with the same anchor are a block. An anchor that occurs once in the corpus shows that its
   windows do: most text ends here.
2. Blocks of other anchors are named by all words they cover. If all blocks of an anchor are equal, all
   their windows are repeated.
3. Otherwise one block of each kind, weighted, lists its windows by 128-bit names; windows whose
   weights add up to one are unique.

Each step is one aggregate with map-side combining, whose row for a thing that occurs once still
says where; nothing is expanded into pairs, and a hot passage costs one row per task. Results of a
step go back to their documents by ``doc_id`` and checksum, so what is gathered for one is bounded by its
text, also where many rows have one id or none. Texts without repeats leave after step 1, and their
text is not written again.

Null and empty texts have no words and lose none; texts shorter than a window lose none. A row that
occurs twice counts twice, so its windows are repeated. Rows with one ``doc_id``, or none, but
different texts are told apart by checksum. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import rows_with_keys, stored, text_chunks, to_python

WINDOW = 35
ROUNDS = 2
SPAN = 4
CACHED_WORDS = 100_000
SALT = 0x9E3779B97F4A7C15
BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
OUT_ROWS = 100_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Name of an ordered pair of names."""
    return mixed(mixed(left + np.uint64(SALT)) ^ (right * np.uint64(BASES[0])))


class _Hashes(dict):
    """Word to 16 bytes of hash; holds a bounded number of words."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > CACHED_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh128_digest(word)
        return found


class Words:
    """The words of some texts in one flat array of two 64-bit hashes each."""

    def __init__(self, texts: list[list[bytes]], hashes: _Hashes) -> None:
        self.counts = np.array([len(words) for words in texts], np.int64)
        self.starts = np.r_[0, np.cumsum(self.counts)]
        flat = b"".join(b"".join(map(hashes.__getitem__, words)) for words in texts)
        self.lanes = np.frombuffer(flat, "<u8").reshape(-1, 2)
        self._sums: list[tuple[np.ndarray, np.ndarray]] = []

    def names(self, first: np.ndarray, stop: np.ndarray, lane: int) -> np.ndarray:
        """Names of the word ranges ``[first, stop)``, from prefix sums; equal words, equal names."""
        if not self._sums:
            size = len(self.lanes)
            for k, base in enumerate(BASES):
                back = pow(base, -1, 1 << 64)
                powers = np.full(size + 1, base, np.uint64)
                inverse = np.full(size + 1, back, np.uint64)
                powers[0] = inverse[0] = 1
                powers, inverse = np.multiply.accumulate(powers), np.multiply.accumulate(inverse)
                sums = np.zeros(size + 1, np.uint64)
                np.cumsum(mixed(self.lanes[:, k]) * powers[:-1], out=sums[1:])
                self._sums.append((sums, inverse))
        sums, inverse = self._sums[lane]
        return mixed((sums[stop] - sums[first]) * inverse[first] + (stop - first).astype(np.uint64))


def rewritten(names: np.ndarray, owner: np.ndarray, low: np.ndarray, high: np.ndarray, turn: int):
    """One round: new names and owners, and where interiors that began or stopped at a symbol do now.

    ``low`` and ``high`` are first symbols and stops (exclusive) of interiors.
    """
    size = len(names)
    fresh = np.r_[True, (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])]
    run = np.cumsum(fresh) - 1
    starts = np.flatnonzero(fresh)
    lengths = np.diff(np.r_[starts, size])
    symbols, owner = names[starts].copy(), owner[starts]
    many = lengths > 1
    symbols[many] = joined(symbols[many], lengths[many].astype(np.uint64))
    # The outermost runs may go on outside.
    low = np.r_[run, len(symbols) - 1][low] + 1
    high = np.r_[0, run][high]

    size = len(symbols)
    first = (mixed(symbols ^ np.uint64((SALT * (2 * turn + 1)) % (1 << 64))) >> np.uint64(63)) == 0
    paired = first[:-1] & ~first[1:] & (owner[:-1] == owner[1:])
    begins = ~np.r_[False, paired]
    phrase = np.cumsum(begins) - 1
    # A second-class symbol at the left end may pair with one outside, a first-class one at the
    # right end too.
    low = low + ~np.r_[first, True][low]
    high = high - np.r_[False, first][high]
    heads = np.flatnonzero(begins)
    made = symbols[heads]
    twins = np.r_[paired, False][heads]
    made[twins] = joined(symbols[heads[twins]], symbols[heads[twins] + 1])
    low = np.r_[phrase, len(heads), len(heads)][np.minimum(low, size)]
    high = np.r_[0, phrase + 1][high]
    return made, owner[heads], low, high


@dataclass
class Blocks:
    """Blocks of windows: text, anchor, first and last window (flat word places)."""

    owner: np.ndarray
    anchor: np.ndarray
    first: np.ndarray
    last: np.ndarray


def blocks_of(words: Words, window: int = WINDOW, rounds: int = ROUNDS, span: int = SPAN) -> Blocks:
    """The blocks of all texts in order."""
    total = len(words.lanes)
    text = np.repeat(np.arange(len(words.counts)), words.counts)
    starts = np.arange(total)
    starts = starts[: max(0, total - window + 1)]
    starts = starts[text[starts] == text[starts + window - 1]] if len(starts) else starts
    if not len(starts):
        empty = np.zeros(0, np.int64)
        return Blocks(empty, empty.astype(np.uint64), empty, empty)
    names, owner = mixed(words.lanes[:, 0]), text
    low, high = starts.copy(), starts + window
    for turn in range(rounds):
        names, owner, low, high = rewritten(names, owner, low, high, turn)
    tuples = names[: len(names) - span + 1] if len(names) >= span else names[:0]
    for step in range(1, span):
        tuples = joined(tuples, names[step : step + len(tuples)])
    last = high - span
    inside = last >= low
    best = np.full(len(starts), -1, np.int64)
    if inside.any():
        best[inside] = _least(tuples, low[inside], last[inside])
    anchor = np.empty(len(starts), np.uint64)
    anchor[inside] = tuples[best[inside]]
    # A window without enough interior is its own anchor, named by its words.
    bare = starts[~inside]
    anchor[~inside] = joined(words.names(bare, bare + window, 0), words.names(bare, bare + window, 1))
    best[~inside] = -1 - bare
    new = np.r_[True, (best[1:] != best[:-1]) | (np.diff(starts) != 1)]
    heads = np.flatnonzero(new)
    tails = np.r_[heads[1:], len(starts)] - 1
    return Blocks(text[starts[heads]], anchor[heads], starts[heads], starts[tails])


def _least(values: np.ndarray, low: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Place of the least value, leftmost, in each range ``[low, last]``."""
    step = np.arange(len(values))
    levels = [step]
    longest = int((last - low).max()) + 1
    width = 1
    while width * 2 <= longest:
        left, right = levels[-1][:-width], levels[-1][width:]
        levels.append(np.where(values[right] < values[left], right, left))
        width *= 2
    size = last - low + 1
    level = np.frexp(size)[1] - 1
    best = np.empty(len(low), np.int64)
    for k, table in enumerate(levels):
        at = np.flatnonzero(level == k)
        left, right = table[low[at]], table[last[at] - (1 << k) + 1]
        best[at] = np.where(values[right] < values[left], right, left)
    return best


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def split_words(texts: list[str]) -> tuple[list[list[bytes]], np.ndarray]:
    """The words of each text, and its checksum. Of bytes, only ASCII white space parts words."""
    coded = [text.encode() for text in texts]
    return [text.split() for text in coded], np.array([zlib.crc32(text) for text in coded], np.int64)


def _tags(checks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A place in a text, with the text's checksum above it."""
    return ((checks.astype(np.uint64) << np.uint64(32)) | places.astype(np.uint64)).view(np.int64)


def _ranges(lists: pa.Array, *fields: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """Offsets of a list column, and its values' fields (or the values) as flat arrays."""
    offsets = lists.offsets.to_numpy()
    flat = lists.values
    columns = [flat.field(name) for name in fields] if fields else [flat]
    return offsets, [column.to_numpy(zero_copy_only=False) for column in columns]


def _anchor_rows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    hashes = _Hashes()
    for batch in batches:
        for start, texts in text_chunks(batch, "text"):
            lists, checks = split_words(texts)
            words = Words(lists, hashes)
            found = blocks_of(words, window)
            ids = batch.column("doc_id").slice(start, len(texts))
            tags = _tags(checks[found.owner], found.first - words.starts[found.owner])
            for at in range(0, len(tags), OUT_ROWS):
                part = slice(at, at + OUT_ROWS)
                yield pa.RecordBatch.from_arrays(
                    [
                        _longs(found.anchor[part]),
                        ids.take(pa.array(found.owner[part])),
                        pa.array(tags[part]),
                    ],
                    names=["anchor", "doc_id", "tag"],
                )


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _block_rows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Per text: word count and digest, and, where anchors recur, the text and those blocks."""
    hashes = _Hashes()
    for batch in batches:
        offsets, (unique,) = _ranges(batch.column("tags"))
        for start, texts in text_chunks(batch, "text"):
            lists, checks = split_words(texts)
            words = Words(lists, hashes)
            found = blocks_of(words, window)
            tags = _tags(checks[found.owner], found.first - words.starts[found.owner])
            bounds = np.searchsorted(found.owner, np.arange(len(texts) + 1))
            again = np.ones(len(tags), bool)
            for at in range(len(texts)):
                known = np.sort(unique[offsets[start + at] : offsets[start + at + 1]])
                if len(known):
                    mine = tags[bounds[at] : bounds[at + 1]]
                    place = np.minimum(np.searchsorted(known, mine), len(known) - 1)
                    again[bounds[at] : bounds[at + 1]] = known[place] != mine
            first, last, owner = found.first[again], found.last[again], found.owner[again]
            base = words.starts[owner]
            fields = {
                "anchor": found.anchor[again].view(np.int64),
                "block": words.names(first, last + window, 1).view(np.int64),
                "first": first - base,
                "last": last - base,
                "tag": tags[again],
            }
            structs = pa.StructArray.from_arrays([pa.array(x) for x in fields.values()], list(fields))
            stops = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
            whole = (np.diff(stops) == 0).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(start, len(texts)),
                    pa.array(words.counts),
                    pa.array(
                        [_digest(one) if done else None for one, done in zip(lists, whole)],
                        pa.string(),
                    ),
                    pa.array([None if done else text for text, done in zip(texts, whole)], pa.string()),
                    pa.ListArray.from_arrays(pa.array(stops), structs),
                ],
                names=["doc_id", "n_words", "kept_sha256", "text", "blocks"],
            )


def _window_rows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Names of all windows of the listed blocks; only their words are hashed."""
    hashes = _Hashes()
    for batch in batches:
        block_at, (firsts, lasts, tags) = _ranges(batch.column("blocks"), "first", "last", "tag")
        list_at, (wanted, weights) = _ranges(batch.column("listed"), "tag", "weight")
        for start, texts in text_chunks(batch, "text"):
            lists, checks = split_words(texts)
            pieces, starts, places, values, owners = [], [], [], [], []
            size = 0
            for at, words in enumerate(lists):
                row = start + at
                blocks = slice(block_at[row], block_at[row + 1])
                some = slice(list_at[row], list_at[row + 1])
                order = np.argsort(wanted[some])
                known, weight = wanted[some][order], weights[some][order]
                spot = np.minimum(np.searchsorted(known, tags[blocks]), len(known) - 1)
                hit = np.flatnonzero(known[spot] == tags[blocks])
                first, last, weight = firsts[blocks][hit], lasts[blocks][hit], weight[spot[hit]]
                if not len(hit):
                    continue
                # Blocks that follow each other share words, so they make one piece.
                heads = np.flatnonzero(np.r_[True, first[1:] != last[:-1] + 1])
                tails = np.r_[heads[1:], len(hit)] - 1
                for a, b in zip(first[heads].tolist(), last[tails].tolist()):
                    pieces.append(words[a : b + window])
                    starts.append(np.arange(size, size + b - a + 1))
                    places.append(np.arange(a, b + 1))
                    size += b - a + window
                counts = last - first + 1
                values.append(np.repeat(weight, counts))
                owners.append(np.full(int(counts.sum()), at))
            if not pieces:
                continue
            words = Words(pieces, hashes)
            flat, owner = np.concatenate(starts), np.concatenate(owners)
            columns = [
                _longs(words.names(flat, flat + window, 0)),
                _longs(words.names(flat, flat + window, 1)),
                pa.array(np.concatenate(values)),
                batch.column("doc_id").slice(start, len(texts)).take(pa.array(owner)),
                pa.array(_tags(checks[owner], np.concatenate(places))),
            ]
            whole = pa.RecordBatch.from_arrays(columns, names=["a", "b", "weight", "doc_id", "tag"])
            for at in range(0, whole.num_rows, OUT_ROWS):
                yield whole.slice(at, OUT_ROWS)


def _kept_rows(
    batches: Iterator[pa.RecordBatch], window: int, texts_out: bool
) -> Iterator[pa.RecordBatch]:
    """What is left of the texts with recurring anchors."""
    for batch in batches:
        block_at, (firsts, lasts) = _ranges(batch.column("blocks"), "first", "last")
        tag_at, (tags,) = _ranges(batch.column("tags"))
        counts, removed, digests, kept_texts = [], [], [], []
        for row, text in enumerate(batch.column("text")):
            coded = text.as_py().encode()
            words = coded.split()
            blocks = slice(block_at[row], block_at[row + 1])
            # Windows from first to last start a repeat each, but for those found to be alone.
            steps = np.zeros(len(words) + 1, np.int64)
            steps[firsts[blocks]] += 1
            np.subtract.at(steps, lasts[blocks] + 1, 1)
            repeated = np.cumsum(steps)[:-1] > 0
            alone = tags[tag_at[row] : tag_at[row + 1]].view(np.uint64)
            alone = alone[(alone >> np.uint64(32)) == zlib.crc32(coded)] & np.uint64(0xFFFFFFFF)
            repeated[alone.astype(np.int64)] = False
            starts = np.flatnonzero(repeated)
            steps = np.zeros(len(words) + 1, np.int64)
            steps[starts] += 1
            np.subtract.at(steps, starts + window, 1)
            gone = np.cumsum(steps)[:-1] > 0
            kept = list(compress(words, (~gone).tolist()))
            counts.append(len(words))
            removed.append(int(gone.sum()))
            digests.append(_digest(kept))
            if texts_out:
                kept_texts.append(b" ".join(kept).decode())
        columns = [
            batch.column("doc_id"),
            pa.array(counts, pa.int64()),
            pa.array(removed, pa.int64()),
            pa.array(digests, pa.string()),
        ]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        if texts_out:
            columns.append(pa.array(kept_texts, pa.string()))
            names.append("kept")
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _lists(rows: DataFrame, value: str, tag: str = "tag", name: str = "tags") -> DataFrame:
    """What was found for each text, known by id and checksum."""
    return rows.groupBy(
        F.col("doc_id").alias("of_id"), F.shiftrightunsigned(F.col(tag), 32).alias("of_check")
    ).agg(F.collect_list(value).alias(name))


def _of(rows: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    same = rows["doc_id"].eqNullSafe(lists["of_id"]) & (rows["checked"] == lists["of_check"])
    return rows.join(lists, same, how)


def remove_repeats(docs: DataFrame, window: int = WINDOW, texts: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every document.

    A word goes if a window over it also starts anywhere else in the corpus. ``texts=True`` adds the
    kept words, joined by blanks, of documents that have any recurring anchor (null: nothing was removed).
    """
    checked = F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("checked")
    rows = to_python(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", checked))
    anchors = rows.select("doc_id", "text").mapInArrow(
        lambda b: _anchor_rows(b, window), "anchor long, doc_id long, tag long"
    )
    # A group of one row says where it is: the least of one value is that value.
    once = (
        anchors.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"), F.min("tag").alias("tag"))
        .filter("n = 1")
        .select("doc_id", "tag")
    )
    unique = _lists(once, "tag")
    parsed = stored(
        _of(rows, unique, "left")
        .select("doc_id", "text", "tags")
        .mapInArrow(
            lambda b: _block_rows(b, window),
            "doc_id long, n_words long, kept_sha256 string, text string, "
            "blocks array<struct<anchor:long,block:long,first:long,last:long,tag:long>>",
        ),
        "blocks",
    )
    recurring = parsed.filter("text is not null").select("doc_id", "text", "blocks", checked)
    # Of equal blocks, the one with the least id and tag stands for all.
    chosen = (
        recurring.select("doc_id", F.explode("blocks").alias("x"))
        .groupBy("x.anchor", "x.block")
        .agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "x.tag")).alias("at"))
    )
    kinds = stored(chosen, "kinds")
    mixed_anchors = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    listed = _lists(
        rows_with_keys(kinds, mixed_anchors, "anchor", "kinds").select(
            F.col("at.doc_id").alias("doc_id"),
            F.col("at.tag").alias("tag"),
            F.struct(
                F.col("at.tag").alias("tag"), F.least(F.col("n"), F.lit(2)).alias("weight")
            ).alias("one"),
        ),
        "one",
        name="listed",
    )
    windows = (
        _of(recurring, listed, "inner")
        .select("doc_id", "text", "blocks", "listed")
        .mapInArrow(
            lambda b: _window_rows(b, window), "a long, b long, weight long, doc_id long, tag long"
        )
    )
    alone = _lists(
        windows.groupBy("a", "b")
        .agg(F.sum("weight").alias("n"), F.min("doc_id").alias("doc_id"), F.min("tag").alias("tag"))
        .filter("n = 1"),
        "tag",
    )
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    cut = (
        _of(recurring, alone, "left")
        .select("doc_id", "text", "blocks", "tags")
        .mapInArrow(lambda b: _kept_rows(b, window, texts), schema + (", kept string" if texts else ""))
    )
    whole = parsed.filter("text is null").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256"
    )
    return cut.unionByName(whole, allowMissingColumns=True)
