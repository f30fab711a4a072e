"""Byte-pair encoding and decoding in batched numpy merge rounds, and token counts.

The symbols of many distinct words lie in one flat array. In a round, the rank of every adjacent
pair is found by binary search over the sorted pair keys, every word merges all places of its
lowest-ranked pair, and words without a known pair leave. A word is merged once per batch and kept
in a cache of bounded size, so a text costs one lookup per word.

Null and empty texts have no tokens. Repeated rows give equal results; rows with a null ``doc_id``
pass through. Only ``doc_id`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from tiermill.llm.common import text_chunks, to_python

CACHED_WORDS = 200_000
NO_RANK = np.iinfo(np.int32).max
# Scripts whose letters and digits every Unicode version in use agrees on: Latin to Cyrillic, general
# punctuation, Kana, Han, Hangul. Texts with other characters are cut by the library's own rules.
OTHER_SCRIPTS = regex.compile(
    "[^\u0000-\u052F\u2010-\u2060\u3040-\u3096\u30A1-\u30FA\u4E00-\u9FA5\uAC00-\uD7A3]"
)


def default_vocabulary() -> str:
    """Path of the public vocabulary file that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def read_vocabulary(path: str) -> dict:
    """The fields of a word-ending BPE vocabulary file that encoding needs; raises on other kinds."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    steps = [step["type"] for step in (spec["normalizer"] or {}).get("normalizers", [])]
    cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    if steps != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cuts] != ["Split", "ByteLevel"]:
        raise ValueError(f"{path}: not a lower-casing, byte-level vocabulary")
    if any(token["normalized"] or token["single_word"] for token in spec["added_tokens"]):
        raise ValueError(f"{path}: added tokens of this kind are not supported")
    return {
        "vocab": spec["model"]["vocab"],
        "merges": [tuple(pair) for pair in spec["model"]["merges"]],
        "suffix": spec["model"]["end_of_word_suffix"],
        "pattern": cuts[0]["pattern"]["Regex"],
        "special": {token["content"]: token["id"] for token in spec["added_tokens"]},
    }


def _byte_letters() -> list[str]:
    """The character that stands for each byte: printable ones themselves, the rest from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shifted = iter(range(256, 512))
    return [chr(byte) if byte in plain else chr(next(shifted)) for byte in range(256)]


class WordBpe:
    """Encoder and decoder of one vocabulary; made once per Python task."""

    def __init__(self, spec: Mapping) -> None:
        vocab, suffix = spec["vocab"], spec["suffix"]
        self.suffix = suffix
        letters = _byte_letters()
        self.inner = np.array([vocab[letter] for letter in letters], np.int64)
        self.last = np.array([vocab[letter + suffix] for letter in letters], np.int64)
        self.size = max(vocab.values()) + 1
        left = np.array([vocab[a] for a, _ in spec["merges"]], np.int64)
        right = np.array([vocab[b] for _, b in spec["merges"]], np.int64)
        made = np.array([vocab[a + b] for a, b in spec["merges"]], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made
        # A merge that only uses symbols made before it can never create a lower-ranked pair, so
        # all places of a pair may merge at once. Otherwise they merge one by one.
        born = np.full(self.size, -1, np.int64)
        born[made] = np.arange(len(made))
        rank = np.arange(len(made))
        self.at_once = bool(
            len(np.unique(made)) == len(made) and (born[left] < rank).all() and (born[right] < rank).all()
        )
        self.special = dict(spec["special"])
        self.strings = {number: token for token, number in {**vocab, **self.special}.items()}
        self.words = regex.compile(spec["pattern"])
        self.normalizer = normalizers.Sequence(
            [normalizers.NFC(), normalizers.Replace(Regex(r"\s+"), " "), normalizers.Lowercase()]
        )
        self.splitter = pre_tokenizers.Split(Regex(spec["pattern"]), "removed", invert=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.cache: dict[str, bytes] = {}

    def pretokens(self, text: str) -> list[str]:
        """Words of a text as the vocabulary's own library cuts them."""
        if OTHER_SCRIPTS.search(text):
            plain = self.normalizer.normalize_str(text)
            return [word for word, _ in self.splitter.pre_tokenize_str(plain)]
        # Python lower-cases a sigma at a word's end differently from the library.
        return self.words.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def parts(self, text: str) -> Iterator[tuple[list[str], int | None]]:
        """Runs of words, each with the special token that ends it, if any."""
        if not any(token in text for token in self.special):
            yield self.pretokens(text), None
            return
        pieces = self.cut.split(text)
        for at in range(0, len(pieces), 2):
            end = self.special[pieces[at + 1]] if at + 1 < len(pieces) else None
            yield self.pretokens(pieces[at]), end

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, by binary search over the sorted pair keys."""
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RANK)

    def merged(self, words: list[str]) -> list[bytes]:
        """The token ids of each word, as little-endian unsigned 32-bit integers."""
        coded = [word.encode() for word in words]
        lengths = np.array([len(word) for word in coded], np.int64)
        flat = np.frombuffer(b"".join(coded), np.uint8)
        symbols = self.inner[flat]
        ends = np.cumsum(lengths)
        symbols[ends - 1] = self.last[flat[ends - 1]]
        owner = np.repeat(np.arange(len(words)), lengths)
        rank = np.full(len(symbols), NO_RANK, np.int32)
        rank[:-1] = self.pair_ranks(symbols[:-1], symbols[1:])
        rank[ends - 1] = NO_RANK
        done_symbols, done_owner = [], []
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(owner)])
            lowest = np.minimum.reduceat(rank, starts)
            live = np.repeat(lowest != NO_RANK, sizes)
            best = np.repeat(lowest, sizes)
            if not live.all():
                done_symbols.append(symbols[~live])
                done_owner.append(owner[~live])
                best, symbols, owner, rank = best[live], symbols[live], owner[live], rank[live]
            if not len(symbols):
                break
            hit = rank == best
            if self.at_once:
                at = _left_to_right(np.flatnonzero(hit))
            else:
                at = np.flatnonzero(hit)
                at = at[np.r_[True, owner[at][1:] != owner[at][:-1]]]
            symbols[at] = self.made[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
            # Only pairs with a new symbol have new ranks: the one it begins and the one it ends.
            made = at - np.arange(len(at))
            for place in (made, made[made > 0] - 1):
                place = place[place < len(symbols) - 1]
                fresh = self.pair_ranks(symbols[place], symbols[place + 1])
                fresh[owner[place] != owner[place + 1]] = NO_RANK
                rank[place] = fresh
            rank[-1] = NO_RANK
        all_symbols = np.concatenate(done_symbols)
        all_owner = np.concatenate(done_owner)
        order = np.argsort(all_owner, kind="stable")
        stops = np.cumsum(np.bincount(all_owner, minlength=len(words))) * 4
        packed = all_symbols[order].astype("<u4").tobytes()
        return [packed[a:b] for a, b in zip([0, *stops.tolist()[:-1]], stops.tolist())]

    def learn(self, words: set[str]) -> None:
        """Put the ids of all these words into the cache, which may be emptied first."""
        new = words - self.cache.keys()
        if len(self.cache) + len(new) > CACHED_WORDS:
            self.cache.clear()
            new = words
        if new:
            listed = list(new)
            self.cache.update(zip(listed, self.merged(listed)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        parted = [list(self.parts(text)) for text in texts]
        self.learn({word for parts in parted for words, _ in parts for word in words})
        of = self.cache.__getitem__
        return [
            b"".join(
                b"".join(map(of, words)) + (b"" if end is None else end.to_bytes(4, "little"))
                for words, end in parts
            )
            for parts in parted
        ]

    def decode(self, ids: bytes) -> str:
        """The text of an id sequence; the vocabulary names no decoder, so tokens are spaced."""
        return " ".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _left_to_right(at: np.ndarray) -> np.ndarray:
    """Of adjacent places, as in ``aaaa``, every second: a symbol merges only once."""
    run_start = np.r_[True, np.diff(at) > 1]
    if run_start.all():
        return at
    first = np.maximum.accumulate(np.where(run_start, at, 0))
    return at[(at - first) % 2 == 0]


def shared_vocabulary(df: DataFrame, path: str | None):
    """The vocabulary as a broadcast variable: its size is fixed by the file, not by the data."""
    return df.sparkSession.sparkContext.broadcast(read_vocabulary(path or default_vocabulary()))


def bpe_encode(docs: DataFrame, path: str | None = None, ids: bool = False) -> DataFrame:
    """Encode and decode whole texts: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    The digests are of the ids as little-endian unsigned 32-bit integers and of the decoded text
    in UTF-8. ``ids=True`` adds the ids (``array<int>``) and the decoded text.
    """
    spec = shared_vocabulary(docs, path)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if ids:
        schema += ", ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(spec.value)
        for batch in batches:
            for start, texts in text_chunks(batch, "text"):
                coded = bpe.encode(texts)
                decoded = [bpe.decode(row) for row in coded]
                columns = {
                    "doc_id": batch.column("doc_id").slice(start, len(texts)),
                    "n_tokens": pa.array([len(row) // 4 for row in coded], pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(row).hexdigest() for row in coded]),
                    "decoded_sha256": pa.array(
                        [hashlib.sha256(text.encode()).hexdigest() for text in decoded]
                    ),
                }
                if ids:
                    listed = [np.frombuffer(row, "<u4").astype(np.int32) for row in coded]
                    columns["ids"] = pa.array(listed, pa.list_(pa.int32()))
                    columns["decoded"] = pa.array(decoded, pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    return to_python(docs.select(F.col("doc_id").cast("long"), "text")).mapInArrow(run, schema)


def whole_tokens(bpe: WordBpe) -> frozenset[str]:
    """Pre-tokens proved, by merging them, to encode as one token.

    Candidates are the vocabulary's word-ending strings that are words of their own. The proof covers the
    whole vocabulary and needs no data.
    """
    back = {letter: byte for byte, letter in enumerate(_byte_letters())}
    words = set()
    for token in bpe.strings.values():
        stem = token.removesuffix(bpe.suffix)
        if bpe.suffix and stem == token or not stem or any(letter not in back for letter in stem):
            continue
        try:
            words.add(bytes(back[letter] for letter in stem).decode())
        except UnicodeDecodeError:
            continue
    listed = sorted(words)
    return frozenset(
        word for word, found in zip(listed, bpe.merged(listed)) if len(found) == 4
    )


@lru_cache(maxsize=2)
def proved_tokens(path: str) -> frozenset[str]:
    """`whole_tokens` of a vocabulary file."""
    return whole_tokens(WordBpe(read_vocabulary(path)))


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = 2048) -> DataFrame:
    """Token counts of whole texts: ``doc_id, n_bytes, n_tokens, over_limit``.

    Pre-tokens in `whole_tokens` count one without merging; only the others are merged. The proof runs once,
    before any text is read, and tasks get its result. ``n_whole`` and ``n_merged`` say how many pre-tokens
    went either way.
    """
    spec = shared_vocabulary(docs, path)
    # Not more words than the vocabulary has.
    proved = docs.sparkSession.sparkContext.broadcast(proved_tokens(path or default_vocabulary()))
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_whole long, n_merged long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(spec.value)
        whole = proved.value
        lengths: dict[str, int] = {}
        for batch in batches:
            for start, texts in text_chunks(batch, "text"):
                rest, direct, special = [], [], []
                for text in texts:
                    parts = list(bpe.parts(text))
                    merge = [w for words, _ in parts for w in words if w not in whole]
                    rest.append(merge)
                    direct.append(sum(len(words) for words, _ in parts) - len(merge))
                    special.append(sum(end is not None for _, end in parts))
                new = {word for merge in rest for word in merge} - lengths.keys()
                if len(lengths) + len(new) > CACHED_WORDS:
                    lengths.clear()
                    new = {word for merge in rest for word in merge}
                if new:
                    listed = list(new)
                    lengths.update(zip(listed, (len(ids) // 4 for ids in bpe.merged(listed))))
                merged = [sum(map(lengths.__getitem__, merge)) for merge in rest]
                tokens = np.array(direct) + np.array(merged) + np.array(special)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").slice(start, len(texts)),
                        "n_bytes": pa.array([len(text.encode()) for text in texts], pa.int64()),
                        "n_tokens": pa.array(tokens, pa.int64()),
                        "over_limit": pa.array(tokens > limit),
                        "n_whole": pa.array(direct, pa.int64()),
                        "n_merged": pa.array([len(merge) for merge in rest], pa.int64()),
                    }
                )

    return to_python(docs.select(F.col("doc_id").cast("long"), "text")).mapInArrow(run, schema)
