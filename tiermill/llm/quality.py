"""Quality rules: repetition and length counts, and divergence from the language's usual text.

A document's histograms of character classes and of its language's common words are compared, by
Jensen-Shannon distance, with the language's usual ones: the median share of every bin over all its
documents that pass the base rules. Distances are judged only from minimum lengths on, as short texts
scatter.

Only DataFrame functions; a text is read in one task and never leaves it. Common words come from
exact counts over all words of all documents; the histogram has the `COMMON_WORDS` most frequent of them and
one bin for all others, so the reference table has that many short rows per language. Windows of words are compared by 64-bit hashes within
one text. Null and empty texts have no words and fail the base rules; a null language is a language
of its own; repeated rows give equal results. Only ``doc_id, text, lang`` are read.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import let, stored, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
COMMON_WORDS = 32
# A common word makes up at least this share of its language's words.
COMMON_SHARE = 0.004
# Distances (0 to 1) beyond which a document is unlike its language, and the numbers of words from
# which they are judged: one address or key moves a short text far. Measured, see README.
MAX_CLASS_DISTANCE = ((60, 0.2), (20, 0.4))
MAX_WORD_DISTANCE = 0.45
MIN_COMMON_WORDS = 100
REFERENCE_ACCURACY = 1000
CLASSES = ("lower", "upper", "digit", "gap", "symbol", "other")


def _repeat_words(words: Column) -> Column:
    """How many words lie in windows that occur twice or more in the text."""

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        places = let(
            placed,
            lambda s: F.sort_array(
                F.filter(
                    F.transform(
                        s,
                        lambda x, k: F.when(
                            (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]), x["i"]
                        ),
                    ),
                    lambda i: i.isNotNull(),
                )
            ),
        )
        return let(
            places,
            lambda p: F.aggregate(
                F.transform(
                    p, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - i, F.lit(WINDOW)))
                ),
                F.lit(0).cast("long"),
                lambda total, n: total + n,
            ),
        )

    def windows(found: Column) -> Column:
        # Words are hashed once; a window is the hash of its words' hashes.
        return let(
            F.transform(found, lambda word: F.xxhash64(word)),
            lambda h: F.transform(
                F.sequence(F.lit(0), F.size(h) - WINDOW),
                lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WINDOW))),
            ),
        )

    return F.when(
        F.size(words) >= WINDOW,
        let(
            windows(words),
            lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(
                F.lit(0).cast("long")
            ),
        ),
    ).otherwise(F.lit(0).cast("long"))


def base_counts(text: Column) -> Column:
    """Struct of the base counts of a text (null: empty)."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(
        words_of(whole),
        lambda words: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(whole, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
            let(lines, lambda l: F.size(l) - F.size(F.array_distinct(l)))
            .cast("long")
            .alias("n_dup_lines"),
            _repeat_words(words).alias("n_repeat_words"),
        ),
    )


def plain_words(text: Column) -> Column:
    """Lower-case letters and digits, two blanks between words and around the text."""
    spaced = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", "  ")
    return F.concat(F.lit("  "), F.trim(spaced), F.lit("  "))


def common_words(docs: DataFrame) -> DataFrame:
    """``lang, words``: every language's common words, most frequent first."""
    counts = (
        docs.select(
            F.coalesce("lang", F.lit("")).alias("lang"),
            F.explode(F.split(F.trim(plain_words(F.col("text"))), " +")).alias("word"),
        )
        .filter("word <> ''")
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"))
    )
    # Words that occur once count in their language's total, as one row without a word.
    all_words = stored(
        counts.groupBy("lang", F.when(F.col("n") > 1, F.col("word")).alias("word")).agg(
            F.sum("n").alias("n")
        ),
        "word_counts",
    )
    kept = all_words.filter("word IS NOT NULL")
    # One row per language. Written, so that its size is known and the join below moves no words.
    totals = stored(all_words.groupBy("lang").agg(F.sum("n").alias("total")), "word_totals")
    # At most 1 / COMMON_SHARE words of a language pass.
    return (
        kept.join(totals, "lang")
        .filter(F.col("n") >= F.lit(COMMON_SHARE) * F.col("total"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "word"))).alias("found"))
        .select("lang", F.slice("found.word", 1, COMMON_WORDS).alias("words"))
    )


def _class_counts(text: Column, n_words_chars: Column, n_symbols: Column) -> Column:
    def left(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, pattern, "")).cast("long")

    size = F.length(text).cast("long")
    return let(
        F.struct(
            left(r"\P{L}+").alias("letters"),
            left(r"\P{Lu}+").alias("upper"),
            left(r"\P{N}+").alias("digits"),
        ),
        lambda c: F.array(
            c["letters"] - c["upper"],
            c["upper"],
            c["digits"],
            size - n_words_chars,
            n_symbols,
            n_words_chars - c["letters"] - c["digits"] - n_symbols,
        ),
    )


def _word_counts(plain: Column, words: Column) -> Column:
    """Occurrences of each common word and, last, of all other words."""
    found = F.transform(
        words,
        lambda w: (
            (
                F.octet_length(plain)
                - F.octet_length(F.replace(plain, F.concat(F.lit(" "), w, F.lit(" "))))
            )
            / (F.octet_length(w) + 2)
        ).cast("long"),
    )
    gaps = (F.octet_length(plain) - F.octet_length(F.replace(plain, F.lit(" ")))) / 2
    total = F.when(F.trim(plain) == "", F.lit(0.0)).otherwise(gaps - 1)
    return let(
        found,
        lambda n: F.concat(
            n,
            F.array(
                F.greatest(
                    F.lit(0),
                    total.cast("long") - F.aggregate(n, F.lit(0).cast("long"), lambda a, x: a + x),
                )
            ),
        ),
    )


def js_distance(left: Column, right: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two count arrays; null if either is empty or all zero."""

    def part(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))

    def distance(p: Column, q: Column) -> Column:
        terms = F.zip_with(p, q, lambda a, b: (part(a, (a + b) / 2) + part(b, (a + b) / 2)) / 2)
        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)))

    # `greatest` skips nulls, so missing shares are kept out of it.
    return let(
        _shares(left),
        lambda p: let(_shares(right), lambda q: F.when(p.isNotNull() & q.isNotNull(), distance(p, q))),
    )


def _shares(counts: Column) -> Column:
    """A count array divided by its sum; null if that is zero."""
    return let(
        F.aggregate(counts, F.lit(0.0), lambda a, x: a + x),
        lambda total: F.when(total > 0, F.transform(counts, lambda x: x / total)),
    )


def _usual(features: DataFrame, name: str) -> DataFrame:
    """Each language's median share of every bin, over its documents: junk hardly moves it."""
    return (
        features.select("lang", F.posexplode(_shares(F.col(name))))
        .groupBy("lang", "pos")
        .agg(F.percentile_approx("col", 0.5, REFERENCE_ACCURACY).alias("share"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "share"))).alias("all"))
        .select("lang", F.col("all.share").alias(f"{name}_reference"))
    )


def quality_rules(docs: DataFrame) -> DataFrame:
    """Counts, distances and verdict of every document.

    ``base_failed``: fewer than 20 words, or over 30 percent of them in repeated windows. ``kept``:
    not failed, and no judged distance above its bound. Distances of texts that are too short, or
    whose language has no reference, are reported but not judged.
    """
    common = stored(common_words(docs), "common_words")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # The reference table is as small as its language count; Spark broadcasts it while it is below
    # the session's own threshold.
    joined = rows.join(common, "lang", "left")
    counted = joined.select("doc_id", "lang", "text", "words", base_counts(F.col("text")).alias("c"))
    features = stored(
        counted.select(
            "doc_id",
            "lang",
            "c.*",
            _class_counts(F.col("text"), F.col("c.word_chars"), F.col("c.n_symbols")).alias("classes"),
            let(
                plain_words(F.col("text")),
                lambda plain: _word_counts(plain, F.coalesce("words", F.array().cast("array<string>"))),
            ).alias("commons"),
        ).withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        ),
        "features",
    )
    good = features.filter(~F.col("base_failed"))
    long = good.filter(F.col("n_words") >= MIN_COMMON_WORDS)
    reference = stored(
        _usual(good, "classes").join(_usual(long, "commons"), "lang", "left"), "language_references"
    )
    judged = features.join(reference, "lang", "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        js_distance(F.col("classes"), F.col("classes_reference")).alias("class_distance"),
        js_distance(F.col("commons"), F.col("commons_reference")).alias("word_distance"),
    )

    def far(name: str, bound: float, least: int) -> Column:
        return F.coalesce((F.col("n_words") >= least) & (F.col(name) > bound), F.lit(False))

    kept = (
        ~F.col("base_failed")
        & ~reduce(or_, (far("class_distance", bound, least) for least, bound in MAX_CLASS_DISTANCE))
        & ~far("word_distance", MAX_WORD_DISTANCE, MIN_COMMON_WORDS)
    )
    base = [name for name in judged.columns if not name.endswith("_distance")]
    return judged.select(*base, kept.alias("kept"), "class_distance", "word_distance")
