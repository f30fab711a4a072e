"""Benchmark decontamination by latent semantic retrieval and subsequence checks.

Passages are half-overlapping windows of words. A TF-IDF space over the benchmark's own terms, with
document frequencies from all documents, is reduced by a randomised SVD whose matrix (benchmark
items, weighted up, and the passages of all different texts) is spread over Spark tasks: tasks
make their part of ``A'A``, or if the terms are many of ``A'A Q``, summed per block of terms. Every passage of
every text is projected and compared with every item by cosine; candidates are checked by the longest common
subsequence of the item with the words around the passage, and of the item's answer (its last sentence). Items longer
than `PIECE_FROM` are retrieved by pieces as long as a passage; the words checked grow with the item.

The benchmark is a stated query set, searched in blocks of `ITEMS` pieces, `BLOCKS` of them in one pass over
the texts; one pass before that, over the different texts, writes down the terms of them all, place by place, for
counting and fitting. What a task holds is bounded: at most the terms of those blocks times `RANK` numbers, or
`PAIRS` numbers. The search leaves documents in their task, so hot passages and very long texts cost time in
proportion to their length only.

Null and empty texts and items match nothing. Items under `MIN_TOKENS` different tokens are found by their exact sequence of words only, so a
one-word item is found wherever the word is. Items with letters of a script without blanks are
looked for by their characters too. The cosine of an exact find is null.
Repeated rows give repeated results, a null ``doc_id`` is kept as it is, and an empty benchmark or corpus gives no
leaks. `find_leaks` reads ``doc_id`` and ``text`` only; `drop_leaks` passes all columns on.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import chain, pairwise, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import stored, text_chunks, to_python

TOKEN = re.compile(r"[^\W_]+")
SENTENCE_END = re.compile(r"[.!?]+\s+|\n+")
ITEMS = 1000
BLOCKS = 10
RANK = 256
SAMPLE_DOCS = 2000
ITEM_WEIGHT = 10.0
STRIDE = 24
# Up to here a passage and its neighbours hold the whole item, wherever the passages begin.
PIECE_FROM = 3 * STRIDE
# Words between those of an item may stretch it by a quarter.
STRETCH = 1.25
# Items with fewer different tokens say too little for a cosine or a paraphrase.
MIN_TOKENS = 5
# Letters of scripts written without blanks: Thai to Myanmar, Khmer, kana, Han with its extensions.
UNSPACED = re.compile(
    r"[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3005-\u3007\u3400-\u4dbf"
    r"\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]"
)
# Terms in more than this share of the documents carry no meaning, unless an item has little else.
STOP_SHARE = 0.1
STOP_LEAST = 20
ITEM_TERMS = 3
MIN_COSINE = 0.45
# A copy, or a paraphrase that also gives the answer.
COPY_SHARE = 0.8
PARAPHRASE_SHARE = 0.7
ANSWER_SHARE = 0.8
# Shorter answers occur anywhere; then the item's share alone decides.
ANSWER_TOKENS = 3
TERM_BLOCK = 512
# A product of fewer pairs of terms is formed once: 128 MiB in a task. Of more, only its products are.
PAIRS = 1 << 24
PAIR_ROWS = 64
# Pairs of terms that are made at once.
PAIRS_AT_ONCE = 1 << 19
PART = "place long, part binary"
# Texts of more different marks than this are split by the pattern.
MARKS = 64
ASCII_TOKENS = "".join(chr(code).lower() if chr(code).isalnum() else " " for code in range(128))
# Few enough that their vectors stay in the processor's cache.
PASSAGES_AT_ONCE = 512


def tokens_of(text: str | None) -> list[str]:
    """Lower-case words of letters and digits: `TOKEN` in ``text.lower()``, mostly without the pattern."""
    text = text or ""
    if text.isascii():
        return text.translate(ASCII_TOKENS).split()
    text = text.lower()
    marks = [mark for mark in set(text) if not mark.isalnum()]
    if len(marks) > MARKS:
        return TOKEN.findall(text)
    for mark in marks:
        text = text.replace(mark, " ")
    return text.split()


def answer_of(text: str) -> list[str]:
    """Tokens of an item's last sentence."""
    parts = [tokens for tokens in map(tokens_of, SENTENCE_END.split(text)) if tokens]
    return parts[-1] if parts else []


def needle_of(tokens: list[str]) -> str:
    """What to look for in a text's tokens joined by blanks; open ends in scripts without blanks."""
    words = " ".join(tokens)
    before, after = ("" if UNSPACED.match(letter) else " " for letter in (words[0], words[-1]))
    return before + words + after


def common_length(short: list[str], masks: dict[str, int], long: list[str]) -> int:
    """Length of the longest common subsequence, one bit per token of ``short``.

    ``masks`` has, for every token of ``short``, the bits of its places.
    """
    full = (1 << len(short)) - 1
    row = full
    for token in long:
        hit = row & masks.get(token, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(short) - row.bit_count()


def pieces_of(tokens: list[str]) -> list[list[str]]:
    """What an item is retrieved by: itself, or if it is long its passages."""
    if len(tokens) <= PIECE_FROM:
        return [tokens]
    return [tokens[start : start + 2 * STRIDE] for start in range(0, len(tokens) - STRIDE, STRIDE)]


def reach_of(tokens: list[str]) -> int:
    """How many words before and after a passage inside a copy of the item hold the whole copy."""
    return max(STRIDE, int(len(tokens) * STRETCH) - 2 * STRIDE)


def masks_of(tokens: list[str]) -> dict[str, int]:
    """Bits of the places of every token."""
    masks: dict[str, int] = {}
    for at, token in enumerate(tokens):
        masks[token] = masks.get(token, 0) | (1 << at)
    return masks


@dataclass
class Model:
    """What a task needs to search for one block of items."""

    terms: dict[str, int]
    weights: np.ndarray
    """Row per term: its IDF times its place in the latent space."""
    items: np.ndarray
    """Column per piece of an item, item by item: its direction in the latent space."""
    firsts: np.ndarray
    """Every item's first column."""
    item_ids: list
    tokens: list[list[str]]
    answers: list[list[str]]
    exact: list[tuple]
    """``(place, item_id, needle)`` of the items to find whole: place in ``tokens``, or negative."""

    def parts(self) -> tuple:
        """The fields, in order, as plain values."""
        found = self.terms, self.weights, self.items, self.firsts, self.item_ids
        return *found, self.tokens, self.answers, self.exact


def _hits(tokens: list[list[str]], terms: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Known terms of some texts, in order: number of strides up to each text, and stride and term of each hit.

    A text without tokens has one stride.
    """
    sizes = np.array([len(words) for words in tokens], np.int64)
    first_stride = np.r_[0, np.cumsum(np.maximum(1, -(-sizes // STRIDE)))]
    ids = np.fromiter(map(terms.get, chain.from_iterable(tokens), repeat(-1)), np.int32, int(sizes.sum()))
    hit = np.flatnonzero(ids >= 0)
    shift = np.repeat(first_stride[:-1] * STRIDE - (np.cumsum(sizes) - sizes), sizes)
    return first_stride, (hit + shift[hit]) // STRIDE, ids[hit]


@dataclass
class Coded:
    """The known terms of all different texts."""

    rows: DataFrame
    """Per text: its ``copies``, the number of hits in each of its ``strides`` (a byte each), and their ``ids``."""
    words: dict[str, int]
    counts: dict[str, int]
    """In how many documents each term occurs."""
    total: int
    """The number of documents."""


def _coded_rows(texts: DataFrame, words: dict[str, int]) -> DataFrame:
    """The texts of `sampled_texts` as the known words in them, written, as they are read more than once."""
    known = texts.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, some in text_chunks(batch, "text"):
                strides, place, ids = _hits([tokens_of(text) for text in some], known.value)
                filled = np.bincount(place, minlength=strides[-1])
                ends = np.r_[0, np.cumsum(filled)][strides] * ids.itemsize
                columns = [
                    [cells[begin:end] for begin, end in zip(bounds[:-1], bounds[1:])]
                    for cells, bounds in (
                        (filled.astype(np.uint8).tobytes(), strides.tolist()),
                        (ids.tobytes(), ends.tolist()),
                    )
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("copies").slice(start, len(some)),
                        *(pa.array(cells, pa.binary()) for cells in columns),
                    ],
                    names=["copies", "strides", "ids"],
                )

    return stored(to_python(texts).mapInArrow(run, "copies long, strides binary, ids binary"), "coded-texts")


def _cells(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a binary column, and how many each row has."""
    cells = column.to_pylist()
    numbers = np.frombuffer(b"".join(cells), kind)
    return numbers, np.array([len(cell) for cell in cells], np.int64) // numbers.itemsize


def _document_counts(rows: DataFrame, words: dict[str, int]) -> tuple[dict[str, int], int]:
    """In how many documents each benchmark term occurs, and the number of documents."""
    width = max(1, len(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, documents = np.zeros(width, np.int64), 0
        for batch in batches:
            copies = batch.column("copies").to_numpy()
            ids, sizes = _cells(batch.column("ids"), np.int32)
            found = np.sort(np.repeat(np.arange(len(sizes)) * width, sizes) + ids)
            text, term = np.divmod(found[np.diff(found, prepend=-1) > 0], width)
            counts += np.bincount(term, copies[text], width).astype(np.int64)
            documents += int(copies.sum())
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[-1, there], pa.int32()), pa.array(np.r_[documents, counts[there]], pa.int64())],
            names=["term", "n"],
        )

    found = to_python(rows).mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts, listed = {row["term"]: row["n"] for row in found}, list(words)
    total = counts.pop(-1, 0)
    return {listed[term]: n for term, n in counts.items()}, total


def code_texts(texts: DataFrame, vocabulary: set[str]) -> Coded:
    """Read all texts of `sampled_texts` once for the terms of a vocabulary."""
    words = {word: at for at, word in enumerate(sorted(vocabulary))}
    rows = _coded_rows(texts, words)
    return Coded(rows, words, *_document_counts(rows, words))


def _passage_rows(
    batches: Iterator[pa.RecordBatch], lookup: np.ndarray, idf: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Terms, values and numbers of terms of the passages of coded texts that have any, as `_sparse` gives them.

    ``lookup`` has the term of each known word, or -1.
    """
    for batch in batches:
        filled, strides = _cells(batch.column("strides"), np.uint8)
        ids = lookup[_cells(batch.column("ids"), np.int32)[0]]
        place = np.repeat(np.arange(len(filled)), filled)[ids >= 0]
        ids = ids[ids >= 0]
        # A passage begins with every stride but a text's last, and with its only one.
        ends = np.cumsum(strides)
        begins, follows = np.ones((2, len(filled)), bool)
        begins[ends[strides > 1] - 1] = False
        follows[(ends - strides)[strides > 0]] = False
        here, before = begins[place], follows[place]
        place = np.concatenate([place[here], place[before] - 1])
        found = np.sort(place * len(idf) + np.concatenate([ids[here], ids[before]]))
        heads = np.flatnonzero(np.diff(found, prepend=-1))
        place, at = np.divmod(found[heads], len(idf))
        values = np.diff(heads, append=len(found)) * idf[at]
        values /= np.maximum(np.sqrt(np.bincount(place, values * values)), 1e-12)[place]
        yield at, values, np.diff(np.flatnonzero(np.diff(place, prepend=-1)), append=len(place))


def _lookup(coded: Coded, terms: dict[str, int]) -> np.ndarray:
    """The term of each known word, or -1."""
    lookup = np.full(len(coded.words), -1, np.int64)
    for term, at in terms.items():
        lookup[coded.words[term]] = at
    return lookup


ROW = "ids array<int>, vals array<double>"


def _passages(coded: Coded, terms: dict[str, int], idf: np.ndarray) -> DataFrame:
    """The rows of all passages."""
    shared = coded.rows.sparkSession.sparkContext.broadcast((_lookup(coded, terms), idf))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, values, sizes in _passage_rows(batches, *shared.value):
            bounds = np.r_[0, np.cumsum(sizes)]
            for start in range(0, len(sizes), PASSAGES_AT_ONCE):
                own = bounds[start : start + PASSAGES_AT_ONCE + 1]
                rows, offsets = slice(own[0], own[-1]), pa.array(own - own[0], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(offsets, pa.array(at[rows], pa.int32())),
                        pa.ListArray.from_arrays(offsets, pa.array(values[rows])),
                    ],
                    names=["ids", "vals"],
                )

    return to_python(coded.rows.select("strides", "ids")).mapInArrow(run, ROW)


def _add_gram(total: np.ndarray, basis: np.ndarray, batch: pa.RecordBatch) -> None:
    """Add some rows' part of ``A'A Q``; a row's terms are different and at least one."""
    ids, values = batch.column("ids"), batch.column("vals")
    at, weight = ids.flatten().to_numpy(), values.flatten().to_numpy().astype(np.float32)
    sizes = np.diff(ids.offsets.to_numpy())
    if not len(at):
        return
    row = np.repeat(np.arange(len(sizes)), sizes)
    terms, place = np.unique(at, return_inverse=True)
    # Few terms of many occur in so few rows: there the products are dense.
    dense = np.zeros((len(sizes), len(terms)), np.float32)
    dense[row, place] = weight
    total[terms] += dense.T @ (dense @ basis[terms])


def _gram_times(rows: DataFrame, terms: int, basis: np.ndarray) -> np.ndarray:
    """``A'A Q`` for the sparse rows of A, summed over tasks per block of terms."""
    shared = rows.sparkSession.sparkContext.broadcast(basis)
    width = basis.shape[1]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((terms, width), np.float32)
        for batch in batches:
            for start in range(0, batch.num_rows, PASSAGES_AT_ONCE):
                _add_gram(total, shared.value, batch.slice(start, PASSAGES_AT_ONCE))
        yield from _parts(total.ravel(), _term_bounds(terms, width))

    return _product(rows.mapInArrow(multiply, PART), terms, width)


def _parts(total: np.ndarray, bounds: Iterable[int]) -> Iterator[pa.RecordBatch]:
    """The runs of numbers between some bounds, without empty ones, each with its first place."""
    for start, end in pairwise(bounds):
        part = total[start:end]
        if part.any():
            yield _part(start, part)


def _part(place: int, numbers: np.ndarray) -> pa.RecordBatch:
    cells = [pa.array([place], pa.int64()), pa.array([numbers.astype(np.float32).tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(cells, names=["place", "part"])


def _summed(parts: DataFrame) -> DataFrame:
    """The tasks' `_parts`, summed place by place."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for place, part in zip(batch.column("place").to_pylist(), batch.column("part")):
                values = np.frombuffer(part.as_py(), np.float32)
                sums[place] = sums.get(place, 0.0) + values.astype(np.float64)
        for place, values in sums.items():
            yield _part(place, values)

    return parts.repartition("place").mapInArrow(add, PART)


def _product(parts: DataFrame, terms: int, width: int) -> np.ndarray:
    """The sum of the tasks' parts of a row of ``width`` numbers per term, whatever the number of rows."""
    result = np.zeros(terms * width)
    for row in _summed(parts).collect():
        part = np.frombuffer(row["part"], np.float32)
        result[row["place"] : row["place"] + len(part)] = part
    return result.reshape(terms, width)


def _term_bounds(terms: int, width: int) -> range:
    """Bounds of the parts of a product."""
    return range(0, (terms + TERM_BLOCK) * width, TERM_BLOCK * width)


def _add_pairs(total: np.ndarray, at: np.ndarray, weight: np.ndarray, sizes: np.ndarray) -> None:
    """Add some rows' part of ``A'A``, its lower triangle row by row; a row's terms ascend."""
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes[sizes > 0]).tolist():
        heads = starts[sizes == size]
        high, low = np.tril_indices(size)
        step = max(1, PAIRS_AT_ONCE // len(high))
        for start in range(0, len(heads), step):
            cells = heads[start : start + step, None] + np.arange(size)
            ids, values = at[cells].astype(np.int64), weight[cells]
            places = (ids * (ids + 1) // 2)[:, high] + ids[:, low]
            np.add.at(total, places.ravel(), (values[:, high] * values[:, low]).ravel())


def _first_pair(term: int) -> int:
    """The place of a term's row in the lower triangle."""
    return term * (term + 1) // 2


def _pair_sums(coded: Coded, terms: dict[str, int], idf: np.ndarray) -> DataFrame:
    """``A'A`` for all passages, its lower triangle in runs of `PAIR_ROWS` rows; written, as it is read often."""
    shared = coded.rows.sparkSession.sparkContext.broadcast((_lookup(coded, terms), idf))
    bounds = [_first_pair(min(term, len(terms))) for term in range(0, len(terms) + PAIR_ROWS, PAIR_ROWS)]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(bounds[-1])
        for rows in _passage_rows(batches, *shared.value):
            _add_pairs(total, *rows)
        yield from _parts(total, bounds)

    # Every task sends its sums, so no more of them than keep the cluster busy.
    tasks = 2 * coded.rows.sparkSession.sparkContext.defaultParallelism
    rows = to_python(coded.rows.select("strides", "ids")).coalesce(tasks)
    return stored(_summed(rows.mapInArrow(multiply, PART)), "pair-sums")


def _add_block(total: np.ndarray, basis: np.ndarray, first: int, packed: np.ndarray) -> None:
    """Add the product of some rows of the lower triangle, and of the columns above them, from term ``first`` on."""
    ends = np.arange(first + 1, len(basis) + 1)
    ends = ends[: np.searchsorted(np.cumsum(ends), len(packed)) + 1]
    rows, last = np.arange(len(ends)), int(ends[-1])
    block = np.zeros((len(ends), last), np.float32)
    block[np.arange(last) < ends[:, None]] = packed
    total[first:last] += block @ basis[:last]
    block[rows, first + rows] = 0
    total[:last] += block.T @ basis[first:last]


def _pair_sums_times(sums: DataFrame, terms: int, basis: np.ndarray) -> np.ndarray:
    """``A'A Q`` from `_pair_sums`."""
    shared = sums.sparkSession.sparkContext.broadcast(basis)
    width = basis.shape[1]
    firsts = {_first_pair(term): term for term in range(0, terms, PAIR_ROWS)}

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((terms, width), np.float32)
        for batch in batches:
            for place, part in zip(batch.column("place").to_pylist(), batch.column("part")):
                _add_block(total, shared.value, firsts[place], np.frombuffer(part.as_py(), np.float32))
        yield from _parts(total.ravel(), _term_bounds(terms, width))

    return _product(sums.mapInArrow(multiply, PART), terms, width)


def latent_space(rows: DataFrame, terms: int, rank: int, turns: int = 2) -> np.ndarray:
    """Leading right singular vectors of the sparse rows, by randomised subspace iteration."""
    return _leading(partial(_gram_times, rows, terms), terms, rank, turns)


def _leading(times: Callable[[np.ndarray], np.ndarray], terms: int, rank: int, turns: int = 2) -> np.ndarray:
    """Leading eigenvectors of the matrix by which ``times`` multiplies."""
    width = min(terms, rank)
    basis = np.random.default_rng(7).standard_normal((terms, width)).astype(np.float32)
    for _ in range(turns):
        basis = np.linalg.qr(times(basis))[0].astype(np.float32)
    small = basis.T @ times(basis)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    keep = values > max(values.max(initial=0.0), 0.0) * 1e-6
    return (basis @ turn[:, keep].astype(np.float32)) if keep.any() else np.zeros((terms, 1), np.float32)


def _sparse(
    tokens: list[str], terms: dict[str, int], idf: np.ndarray, scale: float
) -> tuple[list[int], list[float]]:
    counts = Counter(at for at in map(terms.get, tokens) if at is not None)
    ids = sorted(counts)
    values = np.array([counts[at] for at in ids]) * idf[ids]
    return ids, (values * scale / max(np.linalg.norm(values), 1e-12)).tolist()


def vocabulary_of(items: list[tuple]) -> set[str]:
    """The terms of the items that are searched by cosine."""
    listed = [set(tokens_of(text)) for _, text in items]
    return {token for tokens in listed if len(tokens) >= MIN_TOKENS for token in tokens}


def sampled_texts(docs: DataFrame, total: int, sample: int = SAMPLE_DOCS) -> DataFrame:
    """About ``sample`` different texts, those with the least hashes, with the number of their ``copies``.

    They are written, as every list of blocks reads them. With ``sample`` no less than ``total``, as the searches
    fit their models, these are all texts. Copies count once in a fit, so a hot text does not weigh more; null
    texts count as empty.
    """
    step = 1_000_000
    share = max(1, step * sample // max(1, total))
    text = F.coalesce("text", F.lit("")).alias("text")
    chosen = docs.select(text)
    if share < step:
        chosen = chosen.filter(F.pmod(F.xxhash64("text"), F.lit(step)) < share)
    return stored(chosen.groupBy("text").agg(F.count("*").alias("copies")), "sampled-texts")


def fit(docs: DataFrame, items: list[tuple], rank: int = RANK, coded: Coded | None = None) -> Model | None:
    """The latent space of one block of ``(item_id, text)``; nothing if no item can be searched.

    ``coded`` is what `code_texts` found for several blocks.
    """
    listed = [(key, tokens_of(text), answer_of(text or "")) for key, text in items]
    short = [one for one in listed if 0 < len(set(one[1])) < MIN_TOKENS]
    listed = [one for one in listed if len(set(one[1])) >= MIN_TOKENS]
    exact = [(-1 - at, key, needle_of(tokens)) for at, (key, tokens, _) in enumerate(short)]
    exact += [
        (at, key, needle_of(tokens))
        for at, (key, tokens, _) in enumerate(listed)
        if any(map(UNSPACED.search, tokens))
    ]
    if not listed:
        if not exact:
            return None
        none = np.zeros((0, 1), np.float32)
        return Model({}, none, none.T, np.zeros(0, np.int64), [], [], [], exact)
    vocabulary = {token for _, tokens, _ in listed for token in tokens}
    coded = coded or code_texts(sampled_texts(docs, 1, 1), vocabulary)
    counts, total = coded.counts, coded.total
    if not total:
        return None
    often = max(STOP_SHARE * total, STOP_LEAST)
    stops = {token for token in vocabulary if counts.get(token, 0) > often}
    for _, tokens, _ in listed:
        if len(set(tokens) - stops) < ITEM_TERMS:
            stops -= set(tokens)
    terms = {token: at for at, token in enumerate(sorted(vocabulary - stops))}
    idf = np.log((1 + total) / (1 + np.array([counts.get(token, 0) for token in terms]))) + 0.1

    pieces = [pieces_of(tokens) for _, tokens, _ in listed]
    firsts = np.cumsum([0, *map(len, pieces[:-1])])
    columns = [piece for some in pieces for piece in some]
    heavy = [_sparse(piece, terms, idf, ITEM_WEIGHT) for piece in columns]
    # What is read once per multiplication.
    if _first_pair(len(terms)) <= PAIRS:
        of_passages = partial(_pair_sums_times, _pair_sums(coded, terms, idf), len(terms))
    else:
        of_passages = partial(_gram_times, stored(_passages(coded, terms, idf), "passages"), len(terms))
    of_items = pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*heavy), (pa.list_(pa.int32()), pa.list_(pa.float64())))],
        names=["ids", "vals"],
    )

    def times(basis: np.ndarray) -> np.ndarray:
        total = of_passages(basis)
        for start in range(0, of_items.num_rows, PASSAGES_AT_ONCE):
            _add_gram(total, basis, of_items.slice(start, PASSAGES_AT_ONCE))
        return total

    space = _leading(times, len(terms), rank)
    weights = (space * idf[:, None]).astype(np.float32)
    vectors = np.zeros((space.shape[1], len(columns)), np.float32)
    for column, piece in enumerate(columns):
        found = np.array([terms[token] for token in piece if token in terms], np.int64)
        vector = weights[found].sum(axis=0)
        vectors[:, column] = vector / max(float(np.linalg.norm(vector)), 1e-12)
    return Model(terms, weights, vectors, firsts, *map(list, zip(*listed)), exact)


def _sums_of(weights: np.ndarray, term: np.ndarray, heads: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """The sums of the weights of runs of terms: all first terms at once, then all second ones, and so on."""
    order = np.argsort(-hits, kind="stable")
    heads, longer = heads[order], np.bincount(hits)
    sums = weights[term[heads]]
    left = len(heads)
    for at in range(1, len(longer)):
        left -= longer[at]
        sums[:left] += weights[term[heads[:left] + at]]
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return sums[back]


def search(
    texts: list[str], model: Model, item_masks: list[dict], answer_masks: list[dict]
) -> list[list[tuple]]:
    """For each text its leaks ``(item, cosine, item share, answer share)``, best passage each."""
    tokens = [tokens_of(text) for text in texts]
    first_stride, place, term = _hits(tokens, model.terms)
    found: list[dict[int, tuple]] = [{} for _ in texts]
    for words, leaks in zip(tokens, found) if model.exact else ():
        whole = f" {' '.join(words)} "
        for at, key, needle in model.exact:
            if needle in whole:
                leaks[at] = (key, None, 1.0, 1.0)
    if not len(place):
        return [list(leaks.values()) for leaks in found]
    heads = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    # Strides that hold any term, in order. A passage whose first half holds none has no more than
    # the one that begins with its second half.
    filled = place[heads]
    hits = np.diff(heads, append=len(place))
    text_of = np.repeat(np.arange(len(texts)), np.diff(first_stride))
    for start in range(0, len(filled), PASSAGES_AT_ONCE):
        # One stride more than the passages that begin here, for the last one's second half.
        end = min(start + PASSAGES_AT_ONCE, len(filled))
        more = min(end + 1, len(filled))
        sums = _sums_of(model.weights, term, heads[start:more], hits[start:more])
        here = filled[start:more]
        owner = text_of[here]
        double = np.flatnonzero((np.diff(here) == 1) & (owner[1:] == owner[:-1]))
        passages = sums[: end - start].copy()
        passages[double] += sums[double + 1]
        passages /= np.maximum(np.linalg.norm(passages, axis=1, keepdims=True), 1e-12)
        cosines = passages @ model.items
        if len(model.firsts) < cosines.shape[1]:
            cosines = np.maximum.reduceat(cosines, model.firsts, axis=1)
        near, item = np.nonzero(cosines >= MIN_COSINE)
        for k, which in zip(near.tolist(), item.tolist()):
            text = int(owner[k])
            begin = int(here[k] - first_stride[text]) * STRIDE
            short = model.tokens[which]
            reach = reach_of(short)
            words = tokens[text][max(0, begin - reach) : begin + 2 * STRIDE + reach]
            masks = item_masks[which]
            # No subsequence is longer than the item's tokens that occur here at all.
            most = sum(masks[token].bit_count() for token in masks.keys() & set(words))
            before = found[text].get(which)
            if most < PARAPHRASE_SHARE * len(short) or before and before[2] >= most / len(short):
                continue
            share = common_length(short, masks, words) / len(short)
            if share < PARAPHRASE_SHARE or before and before[2] >= share:
                continue
            answer = model.answers[which]
            answered = common_length(answer, answer_masks[which], words) / len(answer)
            if share >= COPY_SHARE or answered >= ANSWER_SHARE and len(answer) >= ANSWER_TOKENS:
                found[text][which] = (model.item_ids[which], float(cosines[k, which]), share, answered)
    return [list(leaks.values()) for leaks in found]


def _item_blocks(benchmark: DataFrame) -> Iterator[list[list[tuple]]]:
    """At most `BLOCKS` blocks of items at a time, each counted by its pieces."""
    items = benchmark.select("item_id", "text").distinct().orderBy("item_id", "text").toLocalIterator()
    blocks: list[list[tuple]] = [[]]
    size = 0
    for row in items:
        if size >= ITEMS:
            if len(blocks) == BLOCKS:
                yield blocks
                blocks = []
            blocks.append([])
            size = 0
        blocks[-1].append((row["item_id"], row["text"]))
        size += len(pieces_of(tokens_of(row["text"])))
    if blocks[-1]:
        yield blocks


def _models(docs: DataFrame, benchmark: DataFrame) -> Iterator[list[Model]]:
    """The models of the blocks that one pass searches.

    The different texts are written once for all, and for each of these lists read once, for their terms.
    """
    texts = None
    for blocks in _item_blocks(benchmark):
        vocabulary = {token for block in blocks for token in vocabulary_of(block)}
        if vocabulary and texts is None:
            texts = sampled_texts(docs, 1, 1)  # all of them
        coded = code_texts(texts, vocabulary) if vocabulary else None
        models = [fit(docs, block, coded=coded) for block in blocks]
        if found := [model for model in models if model]:
            yield found


class Searcher:
    """Some models in a task, ready to search texts."""

    def __init__(self, parts: list[tuple]) -> None:
        self.models = [Model(*one) for one in parts]
        self.masks = [
            ([masks_of(x) for x in model.tokens], [masks_of(x) for x in model.answers])
            for model in self.models
        ]

    def leaks(self, texts: list[str]) -> list[list[tuple]]:
        """For each text, the leaks that any model finds."""
        found: list[list[tuple]] = [[] for _ in texts]
        for model, masks in zip(self.models, self.masks):
            for own, more in zip(found, search(texts, model, *masks)):
                own += more
        return found


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, cosine, item_share, answer_share`` for every leaked item of a document."""
    rows = to_python(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    schema = f"doc_id long, item_id {dict(benchmark.dtypes)['item_id']}, cosine double, item_share double, answer_share double"
    result = docs.sparkSession.createDataFrame([], schema)
    for models in _models(docs, benchmark):
        shared = docs.sparkSession.sparkContext.broadcast([model.parts() for model in models])

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(shared.value)
            for batch in batches:
                for start, texts in text_chunks(batch, "text"):
                    ids = batch.column("doc_id").slice(start, len(texts)).to_pylist()
                    leaks = [(key, *leak) for key, some in zip(ids, searcher.leaks(texts)) for leak in some]
                    if leaks:
                        yield pa.RecordBatch.from_pydict(
                            dict(
                                zip(
                                    ("doc_id", "item_id", "cosine", "item_share", "answer_share"),
                                    map(list, zip(*leaks)),
                                )
                            )
                        )

        result = result.unionByName(rows.mapInArrow(run, schema))
    return result


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without those that hold a leaked item; columns unchanged, nothing is shuffled."""
    left = to_python(docs)
    for models in _models(docs, benchmark):
        shared = docs.sparkSession.sparkContext.broadcast([model.parts() for model in models])

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(shared.value)
            for batch in batches:
                clean: list[bool] = []
                for _, texts in text_chunks(batch, "text"):
                    clean += [not leaks for leaks in searcher.leaks(texts)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        left = left.mapInArrow(run, left.schema)
    return left
