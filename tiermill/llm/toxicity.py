"""Toxicity by maximum-scoring segments over token log-odds.

Learning, on a bounded sample of labelled documents: for each word and word beginning, the
log-odds of occurring in toxic against clean documents, shrunk by a Dirichlet prior from the pooled
rate; only units whose log-odds are significant score, every other token costs a small drift. A
linear-time scan finds all maximal-scoring segments of a whole text. Segment scores of clean
documents have an exponential tail, which gives the expected number of chance segments at least as
good in a text of the same length; the evidence of all significant segments, those expected less than
once, is added up and mapped to a probability by a logistic fit on the sample. Their places in the
text are returned as spans of characters.

Bounds: `SAMPLE` labelled documents, a parameter; the units are all significant ones among them. Scoring reads every
document. Labels, language, source and id are no inputs of a score. Null and empty texts have no
evidence and get the lowest score; a document labelled twice counts as toxic if either label says so; null labels are
ignored; without labels of both kinds every score is 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import stored, to_python

SAMPLE = 20_000
# The prior weighs as much as this share of the sample, and at least so many documents.
PRIOR_SHARE = 0.01
PRIOR_LEAST = 10.0
MIN_Z = 3.0
# Odds a unit must at least multiply by; below, copies and topics of a few documents look toxic.
MIN_GAIN = math.log(20.0)
STEMS = (6, 5, 4)
DRIFT = 0.05
FOLDS = 5
CACHED_WORDS = 200_000
TOKEN = re.compile(r"[^\W\d_]+")


def units_of(word: str) -> list[str]:
    """A word and its beginnings; a beginning is marked so that it cannot equal a word."""
    return [word, *(f"{word[:size]}*" for size in STEMS if len(word) >= size)]


def segments(places: Sequence[int], gains: Sequence[float], drift: float = DRIFT) -> list[float]:
    """Scores of all maximal-scoring segments of a text; see `passages`."""
    return [score for score, _, _ in passages(places, gains, drift)]


def passages(
    places: Sequence[int], gains: Sequence[float], drift: float = DRIFT
) -> list[tuple[float, int, int]]:
    """Score, first and last place of all maximal-scoring segments of a text, in one linear scan.

    ``places`` are the token positions that score ``gains``; each other token scores ``-drift``.
    The usual stack of candidates: each keeps the running total before it and at its end, and a new
    candidate swallows those between it and the last one that starts lower and ends lower. Each also keeps
    the place in the stack of the nearest one below it that starts lower: the search follows these links, and
    every link it passes is never passed again, as the new candidate's own leads past it.
    """
    found: list[tuple[float, float, int, int, int]] = []
    total, before = 0.0, -1
    for place, gain in zip(places, gains):
        total -= drift * (place - before - 1)
        left, total, before = total, total + gain, place
        right, first = total, place
        at = len(found) - 1
        while True:
            while at >= 0 and found[at][0] >= left:
                at = found[at][4]
            if at < 0 or found[at][1] >= right:
                found.append((left, right, first, place, at))
                break
            left, _, first, _, below = found[at]
            del found[at:]
            at = below
    return [(right - left, first, last) for left, right, first, last, _ in found]


@dataclass
class Model:
    """What scoring needs: unit log-odds, the chance tail and the logistic map."""

    gains: dict[str, float]
    rate: float = 1e-6
    decay: float = 1.0
    offset: float = -4.0
    slope: float = 1.0

    def surprise(self, score: float, words: int) -> float:
        """Log of one over the expected number of chance segments at least as good."""
        return self.decay * score - math.log(max(words, 1) * self.rate)

    def evidence(self, scores: Sequence[float], words: int) -> float:
        """Sum of the surprise over segments better than chance."""
        return sum(max(0.0, self.surprise(score, words)) for score in scores)

    def probability(self, evidence: float) -> float:
        """The logistic map, kept inside the open interval."""
        x = max(-30.0, min(30.0, self.offset + self.slope * math.log1p(evidence)))
        return 1.0 / (1.0 + math.exp(-x))


class _Gains(dict):
    """Word to score: its own log-odds if significant, else its longest significant beginning's."""

    def __init__(self, units: dict[str, float]) -> None:
        super().__init__()
        self.units = units

    def __missing__(self, word: str) -> float:
        if len(self) > CACHED_WORDS:
            self.clear()
        gain = next((self.units[unit] for unit in units_of(word) if unit in self.units), 0.0)
        self[word] = gain
        return gain


def _scan(text: str, gains: _Gains) -> tuple[list[float], int]:
    words = TOKEN.findall(text.lower())
    values = list(map(gains.__getitem__, words))
    places = [at for at, value in enumerate(values) if value]
    return (segments(places, [values[at] for at in places]) if places else []), len(words)


def _spans(text: str, gains: _Gains, fitted: Model) -> tuple[list[dict], list[float], int]:
    """Significant segments as characters ``begin`` to before ``end``, all scores, and the token count."""
    words = TOKEN.findall(text.lower())
    values = list(map(gains.__getitem__, words))
    places = [at for at, value in enumerate(values) if value]
    found = passages(places, [values[at] for at in places]) if places else []
    good = [one for one in found if fitted.surprise(one[0], len(words)) > 0]
    spans = []
    if good:
        lower = text.lower()
        edges = [match.span() for match in TOKEN.finditer(lower)]
        # A few letters become two in lower case; offsets are those of the text itself.
        back = None
        if len(lower) != len(text):
            back = [at for at, letter in enumerate(text) for _ in letter.lower()]
        for score, first, last in good:
            begin, end = edges[first][0], edges[last][1]
            if back:
                begin, end = back[begin], back[end - 1] + 1
            spans.append({"begin": begin, "end": end, "score": score})
    return spans, [score for score, _, _ in found], len(words)


def held_out(doc_id: Column) -> Column:
    """Whether a document's labels may not be learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """``text, toxic`` of at most ``size`` labelled documents, those with the least hashes.

    Copies of a text count once.
    """
    ids = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .filter(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("labelled"), "labelled")
        .limit(size)
    )
    # At most ``size`` rows of an id and a label.
    return stored(
        docs.join(F.broadcast(ids), docs["doc_id"] == ids["labelled"])
        .groupBy(docs["text"])
        .agg(F.max(ids["toxic"]).alias("toxic")),
        "toxic_sample",
    )


def _unit_counts(sample: DataFrame) -> DataFrame:
    """``unit, toxic, clean``: in how many documents of each kind a unit occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = (Counter(), Counter())
            for text, toxic in zip(batch.column("text"), batch.column("toxic")):
                words = set(TOKEN.findall((text.as_py() or "").lower()))
                counts[1 if toxic.as_py() else 0].update(
                    {unit for word in words for unit in units_of(word)}
                )
            names = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_pydict(
                {
                    "unit": pa.array(names, pa.string()),
                    "toxic": pa.array([counts[1][name] for name in names], pa.int64()),
                    "clean": pa.array([counts[0][name] for name in names], pa.int64()),
                }
            )

    return (
        to_python(sample).mapInArrow(run, "unit string, toxic long, clean long")
        .groupBy("unit")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )


def _log_odds(counts: DataFrame, n_toxic: int, n_clean: int) -> DataFrame:
    weight = max(PRIOR_LEAST, PRIOR_SHARE * (n_toxic + n_clean))
    prior = F.lit(weight) * (F.col("toxic") + F.col("clean")) / (n_toxic + n_clean)
    odds = F.log((F.col("toxic") + prior) / (n_toxic + weight - F.col("toxic") - prior + 1)) - F.log(
        (F.col("clean") + prior) / (n_clean + weight - F.col("clean") - prior + 1)
    )
    spread = F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    return counts.select("unit", odds.alias("gain"), (odds / spread).alias("z"))


def _scans(docs: DataFrame, gains, keep: list[str]) -> DataFrame:
    """``keep`` columns, segment scores and token count of every text."""
    fields = ", ".join(f"{name} {kind}" for name, kind in docs.select(*keep).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Gains(gains.value)
        for batch in batches:
            found = [_scan(text.as_py() or "", table) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in keep),
                    pa.array([scores for scores, _ in found], pa.list_(pa.float64())),
                    pa.array([words for _, words in found], pa.int64()),
                ],
                names=[*keep, "scores", "words"],
            )

    return to_python(docs.select(*keep, "text")).mapInArrow(
        run, f"{fields}, scores array<double>, words long"
    )


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Offset and slope of a lightly ridged logistic fit, by Newton's method."""
    design = np.column_stack([np.ones(len(x)), x])
    weights, ridge = np.zeros(2), np.array([1e-3, 1e-2]) * len(x) / 100
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (p - y) + ridge * weights
        curve = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0]), float(weights[1])


def learn(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Model:
    """Fit on at most ``size`` labelled documents outside the held-out fold."""
    sample = _sample(docs, labels, size)
    kinds = {
        row["toxic"]: row["n"]
        for row in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()
    }
    n_toxic, n_clean = sum(n for k, n in kinds.items() if k), kinds.get(0, 0)
    if not n_toxic or not n_clean:
        return Model({}, offset=-30.0, slope=0.0)
    best = (
        _log_odds(_unit_counts(sample), n_toxic, n_clean)
        .filter((F.col("z") >= MIN_Z) & (F.col("gain") >= MIN_GAIN))
        .orderBy("unit")
    )
    model = Model({row["unit"]: row["gain"] for row in best.collect()})
    shared = sample.sparkSession.sparkContext.broadcast(model.gains)
    # At most ``size`` rows of a few numbers each.
    rows = _scans(sample, shared, ["toxic"]).collect()
    chance = [score for row in rows if not row["toxic"] for score in row["scores"]]
    words = sum(row["words"] for row in rows if not row["toxic"])
    # One imagined segment keeps the tail proper where clean texts have none.
    typical = float(np.median(list(model.gains.values()))) if model.gains else 1.0
    least = min(chance, default=0.0)
    mean = (sum(chance) + typical) / (len(chance) + 1) - min(least, typical)
    model.decay = 1.0 / max(mean, 0.1)
    model.rate = (len(chance) + 1) / (words + 1) * math.exp(model.decay * min(least, typical))
    x = np.array([math.log1p(model.evidence(row["scores"], row["words"])) for row in rows])
    model.offset, model.slope = _logistic(x, np.array([float(bool(row["toxic"])) for row in rows]))
    return model


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, n_segments, best_segment, spans`` for every document.

    ``spans`` are the significant segments, in order, ``n_segments`` their number: characters ``begin``
    to before ``end``, counted from 0, and the segment's score. ``best_segment`` is the best score of all.
    """
    fitted = replace(model, gains={})
    gains = docs.sparkSession.sparkContext.broadcast(model.gains)
    span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Gains(gains.value)
        for batch in batches:
            found = [_spans(text.as_py() or "", table, fitted) for text in batch.column("text")]
            probable = [fitted.probability(fitted.evidence(scores, words)) for _, scores, words in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(probable, pa.float64()),
                    pa.array([len(spans) for spans, _, _ in found], pa.int64()),
                    pa.array([max(scores, default=0.0) for _, scores, _ in found], pa.float64()),
                    pa.array([spans for spans, _, _ in found], span),
                ],
                names=["doc_id", "score", "n_segments", "best_segment", "spans"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return to_python(rows).mapInArrow(
        run,
        "doc_id long, score double, n_segments long, best_segment double, "
        "spans array<struct<begin:int,end:int,score:double>>",
    )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every document, and whether it is held out from learning."""
    scored = score_toxicity(docs, learn(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_segments",
        "best_segment",
        "spans",
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, bound: float = 0.5) -> DataFrame:
    """The documents that score below ``bound``; columns unchanged, nothing is shuffled."""
    model = learn(docs, labels)
    fitted = replace(model, gains={})
    gains = docs.sparkSession.sparkContext.broadcast(model.gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Gains(gains.value)
        for batch in batches:
            scans = [_scan(text.as_py() or "", table) for text in batch.column("text")]
            keep = [fitted.probability(fitted.evidence(*scan)) < bound for scan in scans]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return to_python(docs).mapInArrow(run, docs.schema)
