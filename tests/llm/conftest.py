from __future__ import annotations

import random

import pytest

# Columns whose names the operators use themselves.
CLASHING = "n_words long, kept boolean, tags string, words long, place long, shard int, fp long, score double, row_rank int"


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from texts or ``(doc_id, text)`` pairs, with clashing extra columns."""

    def make(items, langs=None):
        rows = []
        for at, item in enumerate(items):
            key, text = item if isinstance(item, tuple) else (at, item)
            lang = langs[at] if langs else "en"
            size = None if text is None else len(text)
            rows.append((key, text, lang, "src0", size, 1, True, "x", 2, 3, 4, 5, 0.5, 6))
        kind = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
        return spark.createDataFrame(rows, kind)

    return make


@pytest.fixture(scope="session")
def hard_texts():
    """Null, empty, blank, very long, odd characters, copies."""
    rng = random.Random(3)
    long = " ".join(rng.choice("the of and a lion tiger bear".split()) for _ in range(30_000))
    return [
        None,
        "",
        " \t\n\x0b\x0c\r ",
        long,
        "one",
        "one two three \x1c four",
        "Ünïcode Σας 'S 12 ﬁ \U0001f600 ٠ ΑΣ <|endoftext|> x",
        "same text, twice",
        "same text, twice",
    ]


@pytest.fixture(scope="session")
def prose():
    """``count`` invented texts of ``size`` words."""

    def make(count, size, seed=0, syllables=("th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha")):
        rng = random.Random(seed)

        def word():
            return "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))

        return [" ".join(word() for _ in range(size)) for _ in range(count)]

    return make
