"""Line dedup by winnowing: later copies of runs of lines go, across and inside documents.

A run is ``run`` neighbouring lines, or with ``words``, fewer lines that have that many words together, so that a
long passage goes though it is one line. Lines are hashed; of every window of a run, the line with the least
hash, the last of equal ones, is its fingerprint, so equal windows always choose equal fingerprints in the
same spot.

1. Fingerprints, one for each place that any window chose, are counted. Those that occur twice are marked
   in bitmaps of a stated size, which all tasks get; windows of other fingerprints have no copy and are done.
2. The positions of shared fingerprints are joined and extended both ways: each of their windows is named by
   all its lines, and names are aggregated to the place of the first occurrence by ``(doc_id, text hash,
   line)``, and whether there are others. Overlapping repeated windows make up maximal runs.
3. Each document gathers its own windows' results. Lines of first occurrences stay; lines that only later
   occurrences cover go. Only texts that lose lines are moved.

No step joins on a fingerprint or a name: a hot one costs one aggregate row per task and one row back, to the
document where it comes first. Line and window names are 128 bits.

Only DataFrame functions. Blank lines are no part of runs and stay. A null text stays null; an
empty text, and one without a run, stays as it is; a text may become empty. Equal rows with the same
``doc_id`` are one document. Extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import let, stored, words_of
from tiermill.operators import hash_bitmaps, repeated_hashes, with_seen

RUN_LINES = 3
RUN_WORDS = 50
# 16 MiB of bitmaps each for fingerprints and for documents that lose lines.
BITS = 1 << 27


def _full_lines(text: Column, counted: bool) -> Column:
    """Number, two hashes and, if asked for, words of every line that is not blank."""

    def line_of(line: Column, i: Column) -> Column:
        fields = [
            i.alias("i"),
            F.xxhash64(line).alias("a"),
            F.xxhash64(line, F.lit(1)).alias("b"),
            line.rlike(r"[^\x20\x09-\x0D]").alias("full"),
        ]
        return F.struct(*fields, F.size(words_of(line)).alias("n")) if counted else F.struct(*fields)

    return F.filter(F.transform(F.split(text, "\n"), line_of), lambda line: line["full"])


def _window(found: Column, start: Column, size: int, run: int) -> Column:
    """A window of ``size`` lines: its fingerprint, the place of that, and its name."""

    def made(part: Column) -> Column:
        def with_least(least: Column) -> Column:
            # Windows of other sizes have fingerprints of their own.
            mark = least if size == run else F.xxhash64(least, F.lit(size))
            return F.struct(
                mark.alias("mark"),
                (start + size - F.array_position(F.reverse(part["a"]), least)).cast("int").alias("mark_at"),
                start.alias("start"),
                F.xxhash64(part["a"]).alias("name_a"),
                F.xxhash64(part["b"]).alias("name_b"),
                part["i"].alias("at"),
            )

        return let(F.array_min(part["a"]), with_least)

    return let(F.slice(found, start + 1, F.lit(size)), made)


def _all_windows(found: Column, run: int, words: int | None) -> Column:
    """The windows of all sizes; each tells whether it is the first that chose its fingerprint's place."""

    def of_size(size: int) -> Column:
        starts = F.when(
            F.size(found) >= size, F.sequence(F.lit(0), F.size(found) - size)
        ).otherwise(F.array().cast("array<int>"))
        if size < run:

            def enough(start: Column) -> Column:
                total = F.get(found, start)["n"]
                for step in range(1, size):
                    total = total + F.get(found, start + step)["n"]
                return total >= words

            starts = F.filter(starts, enough)
        made = F.transform(starts, lambda start: _window(found, start, size, run))
        return let(
            made,
            lambda all_: F.transform(
                all_,
                lambda w, k: w.withField(
                    "head", F.coalesce(F.get(all_, k - 1)["mark_at"] != w["mark_at"], F.lit(True))
                ),
            ),
        )

    sizes = [run] if words is None else range(1, run + 1)
    return F.concat(*[of_size(size) for size in sizes])


def windows(docs: DataFrame, run: int, words: int | None = None) -> DataFrame:
    """One row per window of a document: ``__id, __hash`` and what `_window` tells."""
    made = let(_full_lines(F.col("text"), words is not None), lambda found: _all_windows(found, run, words))
    return docs.select(
        F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__hash"), F.explode(made).alias("w")
    ).select("__id", "__hash", "w.*")


def removed_lines(
    docs: DataFrame, run: int = RUN_LINES, words: int | None = None, bits: int = BITS
) -> DataFrame:
    """``__id, __hash, cut``: the places of the lines to remove, for documents that lose any."""
    rows = stored(windows(docs, run, words), "line-windows")
    marks = repeated_hashes(rows.filter("head").select("mark"), bits)
    shared = with_seen(rows.drop("mark_at", "head"), F.col("mark"), marks, bits, "__seen")
    shared = stored(shared.filter("__seen").drop("__seen", "mark"), "line-windows-shared")

    place = F.struct("__id", "__hash", "start")
    named = shared.groupBy("name_a", "name_b").agg(
        F.min(F.struct(place.alias("place"), F.col("at"))).alias("first"), F.max(place).alias("last")
    )
    # One row per name, for the document where it comes first: alone there, or the copy that stays.
    told = named.select(
        F.col("first.place.__id").alias("__id"),
        F.col("first.place.__hash").alias("__hash"),
        F.when(F.col("first.place") == F.col("last"), F.col("first.at")).alias("alone"),
        F.when(F.col("first.place") != F.col("last"), F.col("first.at")).alias("stays"),
        F.lit(None).cast("array<int>").alias("any"),
    )
    nothing = F.lit(None).cast("array<int>")
    own = shared.select(
        "__id", "__hash", nothing.alias("alone"), nothing.alias("stays"), F.col("at").alias("any")
    )
    gathered = (
        own.unionByName(told)
        .groupBy("__id", "__hash")
        .agg(*[F.collect_list(name).alias(name) for name in ("alone", "stays", "any")])
    )
    again = F.array_except(F.array_except("any", "alone"), F.col("stays"))
    cut = F.array_except(F.flatten(again), F.flatten("stays"))
    return gathered.select("__id", "__hash", cut.alias("cut")).filter(F.size("cut") > 0)


def dedup_lines(
    docs: DataFrame, run: int = RUN_LINES, words: int | None = None, bits: int = BITS
) -> DataFrame:
    """The documents, with ``n_lines``, ``n_removed`` and the shortened ``text``.

    A run has ``run`` lines, or if given, ``words`` words in fewer lines. ``bits`` is the size of each set of
    bitmaps; where more fingerprints or documents than that are concerned, more rows are moved than need be.

    Other columns are unchanged and none may begin with ``__``, nor, as they are added here, be called
    ``n_lines`` or ``n_removed``: those are replaced.
    """
    cut = stored(removed_lines(docs, run, words, bits).withColumnRenamed("cut", "__cut"), "line-cuts")
    left = docs.drop("n_lines", "n_removed")
    key = F.xxhash64("doc_id", F.xxhash64("text"))
    losing = hash_bitmaps(cut.select(F.xxhash64("__id", "__hash").alias("key")), bits)
    marked = with_seen(left, key, losing, bits, "__seen")
    whole = marked.filter(~F.col("__seen")).drop("__seen").withColumn("__cut", F.lit(None).cast("array<int>"))
    some = marked.filter("__seen").drop("__seen")
    joined = some.join(
        cut,
        some["doc_id"].eqNullSafe(cut["__id"]) & (F.xxhash64(some["text"]) == cut["__hash"]),
        "left",
    ).drop("__id", "__hash")
    kept = let(
        F.split("text", "\n"),
        lambda lines: F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__cut")),
                lambda i: F.get(lines, i),
            ),
            "\n",
        ),
    )
    return whole.unionByName(joined).select(
        *(
            F.when(F.col("__cut").isNull(), F.col("text")).otherwise(kept).alias("text")
            if name == "text"
            else F.col(f"`{name}`")
            for name in left.columns
        ),
        F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__cut"), F.lit(0)).cast("long").alias("n_removed"),
    )
