"""Chat formatting: a finite-state machine over roles writes text segments with loss flags.

Rows are turns ``(conv_id, turn, role, text)``. They are sorted into ranges of about equal size, wherever that
cuts a conversation, and each range streams through the machine on its own. The machine's state is the role
before, so one row per range then tells each range what came before it and what comes next: a conversation of
any length is formatted by many tasks. The template is data: markers, loss flags and allowed role changes.
Control strings inside texts are escaped, and `read_back` undoes that from the segments alone, range by range
too; only conversations that a range or `RUN_BYTES` cuts are put together, as plain bytes, in one stream each.

Null texts and roles count as empty, a null ``conv_id`` is a conversation of its own, a null turn
comes first, and rows with equal turns are ordered by role and text; repeated rows are repeated
turns. Rows that agree in all but the text beyond its first `KEY_CHARS` characters share a range. Order errors are
flagged in ``ok``, never dropped. Only the four columns are read. An empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tiermill.llm.common import stored, to_python

# A batch from Python holds at most so many rows or bytes, but a row at least.
OUT_ROWS = 2_000
OUT_BYTES = 8 * 1024 * 1024
# Plain bytes of a conversation that are put together in one piece.
RUN_BYTES = 1024 * 1024
# What the driver's sample for the ranges holds of a text.
KEY_CHARS = 64
TURNS = (
    "place long, conv_id long, turn long, role string, opening string, body string, closing string, "
    "prior string, opens boolean, closes boolean, first boolean, final boolean"
)
RUNS = (
    "conv_id long, place long, n_turns long, loss_chars long, formatted_chars long, valid boolean, "
    "said binary, learnt binary, turns_sha256 string, loss_sha256 string"
)
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, valid boolean"
)
# `monotonically_increasing_id` holds the partition above these bits, and the row's number below.
RANGE_BITS = 33


@dataclass(frozen=True)
class Template:
    """Markers, loss roles and role order of a chat format.

    Every marker starts with ``<`` or ``[`` and holds neither again, so that no marker can arise
    where a text meets a marker.
    """

    begin: str = "<s>"
    end: str = "</s>"
    roles: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {
            "system": ("[SYS]", "[/SYS]"),
            "user": ("[INST]", "[/INST]"),
            "assistant": ("[ANS]", "[/ANS]"),
        }
    )
    # A role without markers of its own: its name, then its text.
    other: tuple[str, str, str] = ("[ROLE]", "[TEXT]", "[/TEXT]")
    loss: frozenset[str] = frozenset({"assistant"})
    order: dict[str, frozenset[str]] = field(
        default_factory=lambda: {
            "": frozenset({"system", "user"}),
            "system": frozenset({"user"}),
            "user": frozenset({"assistant"}),
            "assistant": frozenset({"user"}),
        }
    )
    final: frozenset[str] = frozenset({"assistant"})

    def controls(self) -> list[str]:
        """Every control string; raises if one could be misread."""
        found = [self.begin, self.end, *self.other, *(m for pair in self.roles.values() for m in pair)]
        for marker in found:
            if len(marker) < 2 or marker[0] not in "<[" or re.search(r"[<\[\\]", marker[1:]):
                raise ValueError(f"not a usable marker: {marker!r}")
        if len(set(found)) < len(found):
            raise ValueError("markers must differ")
        return found

    def pattern(self) -> re.Pattern:
        """Matches any control string."""
        longest = sorted(self.controls(), key=len, reverse=True)
        return re.compile("|".join(map(re.escape, longest)))


def escape(text: str, controls: re.Pattern) -> str:
    """Double backslashes and put one behind the first character of each control string."""
    doubled = text.replace("\\", "\\\\")
    return controls.sub(lambda m: m[0][0] + "\\" + m[0][1:], doubled)


def unescape(text: str) -> str:
    """The text that `escape` was given."""
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def in_ranges(conversations: DataFrame) -> DataFrame:
    """Turns in order, cut into ranges; ``place`` counts on within a range and grows from range to range."""
    return (
        conversations.select(
            F.col("conv_id").cast("long"),
            F.col("turn").cast("long"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, KEY_CHARS))
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select(F.monotonically_increasing_id().alias("place"), "conv_id", "turn", "role", "text")
    )


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        columns = [batch.column(name) for name in names]
        for at in range(batch.num_rows):
            yield tuple(column[at].as_py() for column in columns)


def _kinds(fields: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(fields))


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    def batch(held: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(column, type_) for column, type_ in zip(zip(*held), schema.types)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(value) for value in row if isinstance(value, (str, bytes)))
        if len(held) == OUT_ROWS or size >= OUT_BYTES:
            yield batch(held)
            held, size = [], 0
    if held:
        yield batch(held)


def _formatted(turns: DataFrame, layout: Template) -> DataFrame:
    """Every turn with its markers and escaped text, and what its own range knows of its neighbours.

    ``prior`` is the role before, empty where the turn ``opens`` its conversation; ``closes`` says that
    the conversation ends here. Both are open to correction for a range's ``first`` and ``final`` row.
    """
    kinds = _kinds(TURNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        controls = layout.pattern()

        def turns_of(rows: Iterator[tuple]) -> Iterator[tuple]:
            held = None
            for place, conv, turn, role, text in rows:
                opens = held is None or held[1] != conv
                if held:
                    yield (*held, opens, held[0] % (1 << RANGE_BITS) == 0, False)
                if role in layout.roles:
                    opening, closing = layout.roles[role]
                else:
                    name, middle, closing = layout.other
                    opening = name + escape(role, controls) + middle
                prior = "" if opens else held[3]
                held = place, conv, turn, role, opening, escape(text, controls), closing, prior, opens
            if held:
                yield (*held, True, held[0] % (1 << RANGE_BITS) == 0, True)

        names = ["place", "conv_id", "turn", "role", "text"]
        yield from _batches(turns_of(_rows(batches, names)), kinds)

    return to_python(turns).mapInArrow(run, TURNS)


def _neighbours(turns: DataFrame) -> DataFrame:
    """``range, before, after``: the last turn of the range before, and the first of the next one.

    As many rows as there are ranges, each read from two rows.
    """
    edge = F.struct("place", "conv_id", "role")
    order = Window.orderBy("range")
    return (
        turns.filter("first OR final")
        .groupBy(F.shiftright("place", RANGE_BITS).alias("range"))
        .agg(F.min(edge).alias("head"), F.max(edge).alias("tail"))
        .select("range", F.lag("tail").over(order).alias("before"), F.lead("head").over(order).alias("after"))
    )


def format_chat(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """Segments of every conversation: markers and escaped texts, each with a loss flag.

    The segments of a conversation, by ``place`` and ``part``, are its formatted text; segments with
    ``loss`` are what a model learns from. ``ok`` is false where a turn breaks the role order, or, in the
    last segment (``last``), where the conversation ends on a role that may not end it. ``place`` is the
    turn's, ``part`` the segment's in it; rows come in that order within a task. Formatted turns are
    written once, so that all that follows sees the same ranges.
    """
    layout = template or Template()
    layout.controls()
    turns = stored(_formatted(in_ranges(conversations), layout), "chat")
    # At most as many rows as the shuffle has partitions.
    rows = turns.join(
        F.broadcast(_neighbours(turns)), F.shiftright("place", RANGE_BITS) == F.col("range"), "left"
    )
    goes_on = F.col("first") & F.col("before").isNotNull() & F.col("before.conv_id").eqNullSafe(F.col("conv_id"))
    stays = F.col("final") & F.col("after").isNotNull() & F.col("after.conv_id").eqNullSafe(F.col("conv_id"))
    prior = F.when(goes_on, F.col("before.role")).otherwise(F.col("prior"))
    role = F.col("role")
    ok = reduce(
        or_,
        [(prior == state) & role.isin(*sorted(after)) for state, after in layout.order.items() if after],
        F.lit(False),
    )

    def piece(segment: Column, loss: Column, ok: Column, here: Column, mark: bool = False, last: bool = False) -> Column:
        return F.struct(
            (F.lit(None).cast("long") if mark else F.col("turn")).alias("turn"),
            (F.lit("") if mark else role).alias("role"),
            segment.alias("segment"),
            loss.alias("loss"),
            ok.alias("ok"),
            F.lit(last).alias("last"),
            here.alias("here"),
        )

    yes, no = F.lit(True), F.lit(False)
    pieces = F.array(
        piece(F.lit(layout.begin), no, yes, F.col("opens") & ~goes_on, mark=True),
        piece(F.col("opening"), no, F.col("fits"), yes),
        piece(F.col("body"), role.isin(*sorted(layout.loss)), F.col("fits"), yes),
        piece(F.col("closing"), no, F.col("fits"), yes),
        piece(F.lit(layout.end), no, role.isin(*sorted(layout.final)), F.col("closes") & ~stays, mark=True, last=True),
    )
    return (
        rows.withColumn("fits", ok)
        .select("conv_id", "place", F.posexplode(F.filter(pieces, lambda one: one["here"])).alias("part", "s"))
        .select("conv_id", "s.turn", "s.role", "s.segment", "s.loss", "s.ok", "s.last", "place", "part")
    )


class _Run:
    """Neighbouring turns of one conversation: their plain bytes and counts."""

    def __init__(self, conv: int | None, place: int) -> None:
        self.conv, self.place, self.at = conv, place, place
        self.said, self.learnt = bytearray(), bytearray()
        self.turns = self.chars = self.total = 0
        self.valid, self.opened, self.closed = True, False, False

    def row(self) -> tuple:
        counts = self.conv, self.place, self.turns, self.chars, self.total, self.valid
        if self.opened and self.closed:
            return (*counts, None, None, hashlib.sha256(self.said).hexdigest(), hashlib.sha256(self.learnt).hexdigest())
        return (*counts, bytes(self.said), bytes(self.learnt), None, None)


def _runs(rows: Iterator[tuple], layout: Template) -> Iterator[tuple]:
    """What segments say, as `RUNS`: whole conversations as digests, parts of others as bytes."""
    controls = layout.pattern()
    opening = {pair[0]: role for role, pair in layout.roles.items()}
    closing = {pair[1] for pair in layout.roles.values()} | {layout.other[2]}
    name_mark, text_mark, _ = layout.other
    now, role, named = None, None, None
    for conv, place, segment, loss, ok in rows:
        full = now and place != now.at and len(now.said) + len(now.learnt) >= RUN_BYTES
        if not now or conv != now.conv or place - now.at not in (0, 1) or full:
            if now:
                yield now.row()
            now, role, named = _Run(conv, place), None, None
        now.at = place
        now.total += len(segment)
        now.valid = now.valid and ok
        at = 0
        pieces = []
        for mark in controls.finditer(segment):
            pieces += [(False, segment[at : mark.start()]), (True, mark[0])]
            at = mark.end()
        pieces.append((False, segment[at:]))
        for is_mark, text in pieces:
            if not is_mark:
                if role is not None:
                    plain = unescape(text)
                    now.said += plain.encode()
                    if loss:
                        now.learnt += plain.encode()
                        now.chars += len(plain)
                elif named is not None:
                    named += text
                elif text:
                    raise ValueError(f"text outside a turn in conversation {conv}")
            elif text == layout.begin:
                now.opened = True
            elif text in opening or text == text_mark:
                role = opening[text] if text in opening else unescape(named or "")
                now.said += f"{role}\n".encode()
            elif text in closing:
                now.said += b"\n"
                now.turns, role, named = now.turns + 1, None, None
            elif text == name_mark:
                named = ""
            elif text == layout.end:
                now.closed = True
    if now:
        yield now.row()


def _digests(runs: Iterator[tuple]) -> Iterator[tuple]:
    """One row per conversation from its runs in order."""
    started, now = False, None
    for conv, turns, chars, total, valid, said, learnt, said_digest, learnt_digest in runs:
        if started and conv != now:
            yield now, counts[0], all_said.hexdigest(), counts[1], all_learnt.hexdigest(), counts[2], sound
            started = False
        if said_digest is not None:
            yield conv, turns, said_digest, chars, learnt_digest, total, valid
            continue
        if not started:
            started, now, counts, sound = True, conv, [0, 0, 0], True
            all_said, all_learnt = hashlib.sha256(), hashlib.sha256()
        counts = [sum(pair) for pair in zip(counts, (turns, chars, total))]
        sound = sound and valid
        all_said.update(said)
        all_learnt.update(learnt)
    if started:
        yield now, counts[0], all_said.hexdigest(), counts[1], all_learnt.hexdigest(), counts[2], sound


def read_back(segments: DataFrame, template: Template | None = None) -> DataFrame:
    """Digests of what the formatted text says, one row per conversation.

    Reads ``conv_id``, ``place``, ``segment``, ``loss`` and ``ok`` as `format_chat` gives them, a turn's segments
    together and in order, and finds roles and texts from the markers. ``valid`` joins the ``ok`` flags.
    Whole conversations are digested where they lie. A digest needs its bytes in order, so those that are cut
    meet in one task, run after run: the only step that is not split.
    """
    layout = template or Template()
    run_kinds, digest_kinds = _kinds(RUNS), _kinds(DIGESTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _rows(batches, ["conv_id", "place", "segment", "loss", "ok"])
        yield from _batches(_runs(rows, layout), run_kinds)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [
            "conv_id", "n_turns", "loss_chars", "formatted_chars", "valid",
            "said", "learnt", "turns_sha256", "loss_sha256",
        ]
        yield from _batches(_digests(_rows(batches, names)), digest_kinds)

    read = to_python(segments.select("conv_id", "place", "segment", "loss", "ok")).mapInArrow(run, RUNS)
    return read.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(fold, DIGESTS)
