from __future__ import annotations

import hashlib
import random
from array import array

import pytest
from tokenizers import Tokenizer

from tiermill.llm import bpe


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


@pytest.fixture(scope="module")
def coder():
    return bpe.WordBpe(bpe.read_vocabulary(bpe.default_vocabulary()))


def ids_of(coder, texts):
    return [array("I", row).tolist() for row in coder.encode(texts)]


def library_ids(library, texts):
    return [row.ids for row in library.encode_batch(texts, add_special_tokens=False)]


def test_every_character_is_encoded_as_by_the_library(coder, library):
    points = [p for p in range(0x30000) if not 0xD800 <= p < 0xE000]
    texts = [
        "".join(f"{chr(p)}a{chr(p)}1{chr(p)}{chr(p)}+" for p in points[at : at + 64])
        for at in range(0, len(points), 64)
    ]
    assert ids_of(coder, texts) == library_ids(library, texts)


def test_random_texts_round_trip_as_in_the_library(coder, library):
    rng = random.Random(1)
    alphabet = "aaabcdeth  \n'.!?<|>19ßéΣσǺ中\U0001f600" + "".join(map(chr, range(33, 127)))
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120))) for _ in range(400)]
    texts += ["<|endoftext|>", "a<|startoftext|><|endoftext|>b", "<|ENDOFTEXT|>", "a" * 5000, "ab" * 3000, ""]
    found = coder.encode(texts)
    wanted = library_ids(library, texts)
    assert [array("I", row).tolist() for row in found] == wanted
    assert [coder.decode(row) for row in found] == [
        library.decode(row, skip_special_tokens=False) for row in wanted
    ]


def test_a_small_cache_changes_nothing(coder, library, monkeypatch, prose):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 10)
    texts = prose(30, 40, seed=5)
    assert ids_of(coder, texts) == library_ids(library, texts)


def test_merging_one_by_one_gives_the_same_where_both_are_right(prose):
    coder = bpe.WordBpe(bpe.read_vocabulary(bpe.default_vocabulary()))
    words = sorted({word for text in prose(5, 60, seed=8) for word in text.split()} | {"a" * 300})
    at_once = coder.merged(words)
    assert coder.at_once
    coder.at_once = False
    assert coder.merged(words) == at_once


def test_encoded_table(make_docs, hard_texts, library):
    rows = bpe.bpe_encode(make_docs(hard_texts), ids=True).orderBy("doc_id").collect()
    texts = [text or "" for text in hard_texts]
    for row, text in zip(rows, texts, strict=True):
        wanted = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(wanted, skip_special_tokens=False)
        assert row.ids == wanted and row.n_tokens == len(wanted) and row.decoded == decoded
        assert row.ids_sha256 == hashlib.sha256(array("I", wanted).tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_counts_agree_with_the_library(make_docs, hard_texts, library, prose):
    texts = hard_texts + prose(20, 300, seed=2)
    rows = bpe.count_tokens(make_docs(texts), limit=700).orderBy("doc_id").collect()
    for row, text in zip(rows, texts, strict=True):
        count = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (row.n_tokens, row.over_limit) == (count, count > 700)
        assert row.n_bytes == len((text or "").encode())


def test_whole_tokens_are_proved_by_the_library_too(coder, library):
    found = sorted(bpe.whole_tokens(coder))
    assert len(found) > 30_000
    # A word that the library splits before merging can never be looked up; the others are one token.
    alone = [word for word in found if coder.pretokens(word) == [word]]
    assert all(len(row) == 1 for row in library_ids(library, alone))


def test_empty_table_and_repeated_null_ids(make_docs):
    assert bpe.bpe_encode(make_docs([])).count() == bpe.count_tokens(make_docs([])).count() == 0
    rows = bpe.count_tokens(make_docs([(None, "a b"), (None, "a b"), (7, None)])).collect()
    assert sorted((r.doc_id is None, r.n_tokens) for r in rows) == [(False, 0), (True, 2), (True, 2)]


def test_other_vocabularies_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError, match="byte-level"):
        bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


def test_the_proof_follows_the_vocabularys_suffix():
    spec = dict(bpe.read_vocabulary(bpe.default_vocabulary()))
    whole = bpe.whole_tokens(bpe.WordBpe(spec))
    swap = lambda x: x.replace("</w>", "~~")
    other = {
        **spec,
        "suffix": "~~",
        "vocab": {swap(token): number for token, number in spec["vocab"].items()},
        "merges": [tuple(map(swap, pair)) for pair in spec["merges"]],
    }
    assert len(whole) > 10_000 and bpe.whole_tokens(bpe.WordBpe(other)) == whole
