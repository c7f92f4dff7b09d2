"""Chat formatting with any template, taken as a black box.

A template is a function from a list of (role, text) to one string. Successive
prefixes of a conversation are rendered and compared: where each output begins
with the one before, the new part is the span of the new turn. Rendering the
last turn with two texts that have no character in common shows where its text
lies in the span. An output that does not begin with the one before belongs to a
template that rewrites history.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

Turns = Sequence[tuple[str, str]]
Render = Callable[[Turns], str]

TURNS_AT_ONCE = 64
_PROBES = ("\ue000", "\ue001\ue001")


class HistoryRewritten(ValueError):
    """The template changes what it wrote for earlier turns."""


# -- a template ----------------------------------------------------------------

# Control strings of the built-in template.
_OPEN, _CLOSE = "### ", "</turn>\n"
_LABELS = {"system": "System", "user": "User", "assistant": "Assistant"}
_ROLES = {label: role for role, label in _LABELS.items()}
_CONTROL = re.compile(r"\\|###|</turn>")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|:|^@")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:|@)")
_BODY = r"(?:[^\\<#]|\\(?:\\|###|</turn>|:|@)|<(?!/turn>)|#(?!##))*+"
_TURN = re.compile(rf"### ({_BODY.replace('[^', '[^:')}): ({_BODY})</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    """A backslash before every control string and every backslash."""
    return _CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def marked_turns(turns: Turns) -> str:
    """``### Role: text</turn>`` and a line end per turn, texts escaped. Roles other
    than system, user and assistant are written after an @ sign."""
    out = []
    for role, text in turns:
        label = _LABELS.get(role) or "@" + _ROLE_CONTROL.sub(r"\\\g<0>", role)
        out.append(f"{_OPEN}{label}: {escape(text)}{_CLOSE}")
    return "".join(out)


def read_marked_turns(text: str) -> list[tuple[str, str]]:
    """The turns that ``marked_turns`` wrote."""
    turns, at = [], 0
    while at < len(text):
        found = _TURN.match(text, at)
        if not found:
            raise ValueError(f"no turn at character {at}")
        label, body = found.groups()
        role = unescape(label[1:]) if label.startswith("@") else _ROLES[label]
        turns.append((role, unescape(body)))
        at = found.end()
    return turns


# -- spans -----------------------------------------------------------------------


@dataclass(frozen=True)
class Span:
    """Characters of a turn, and of its text within."""

    start: int
    end: int
    text_start: int
    text_end: int


def _common_end(a: str, b: str) -> int:
    return len(commonprefix([a[::-1], b[::-1]]))


def turn_spans(render: Render, turns: Turns, known: int = 0) -> tuple[str, list[Span]]:
    """What the template writes for the turns after the first ``known`` ones, and
    their spans in it. Raises ``HistoryRewritten``."""
    before = render(turns[:known]) if known else ""
    base, spans = len(before), []
    for k in range(known, len(turns)):
        role, _ = turns[k]
        history = list(turns[:k])
        now = render(turns[: k + 1])
        probes = [render([*history, (role, probe)]) for probe in _PROBES]
        if not all(x.startswith(before) for x in (now, *probes)):
            raise HistoryRewritten(f"turn {k} changes what was written before it")
        head = len(commonprefix(probes))
        tail = _common_end(*(p[head:] for p in probes))
        spans.append(Span(len(before) - base, len(now) - base, head - base, len(now) - tail - base))
        before = now
    return before[base:], spans


# -- the operator ------------------------------------------------------------------

_TURN_TYPE = "array<struct<role: string, text: string>>"
_FORMATTED = (
    "conv_id long, piece long, text string, rewritten boolean, "
    "spans array<struct<role: string, start: int, end: int, text_start: int, text_end: int, "
    "loss: boolean>>"
)


def _chunks(turns: DataFrame) -> DataFrame:
    """conv_id, piece order, turns: runs of consecutive turns of a conversation."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, n, shard = None, [], 0, 0
        kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

        def emit() -> pa.RecordBatch:
            nonlocal held, n
            row = [
                pa.array([key], pa.int64()),
                pa.array([shard], pa.int32()),
                pa.array([n], pa.int64()),
                pa.array([held], kind),
            ]
            held, n = [], n + 1
            return pa.record_batch(row, names=["conv_id", "shard", "n", "turns"])

        for batch in batches:
            for conv, role, text, place in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (conv != key or len(held) == TURNS_AT_ONCE):
                    yield emit()
                key, shard = conv, place
                held.append({"role": role or "", "text": text or ""})
        if held:
            yield emit()

    order = ["conv_id", "turn", "role", "text"]
    rows = turns.select(*order).withColumn("spread", F.monotonically_increasing_id())
    keys = [F.col("conv_id"), F.col("turn"), F.xxhash64("role", "text"), F.col("spread")]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(
        *[F.col(c).asc_nulls_first() for c in order]
    )
    return ordered.select("conv_id", "role", "text", F.spark_partition_id().alias("shard")).mapInArrow(
        cut, f"conv_id long, shard int, n long, turns {_TURN_TYPE}"
    )


def format_conversations(
    turns: DataFrame,
    render: Render = marked_turns,
    loss_roles: Sequence[str] = ("assistant",),
    on_rewrite: str = "raise",
    history: int | None = None,
) -> DataFrame:
    """Conversations as a template writes them: conv_id, piece, text, rewritten, spans.

    ``turns``: conv_id, turn, role, text; other columns are not read. Turns are in
    the order of turn, then role and text; equal rows are all kept. NULL roles
    and texts are empty; rows of a NULL conv_id are one conversation, and NULL
    turns come first. ``spans`` are the characters of each turn of the piece, of
    its text, and whether that text is under the loss mask.

    A conversation is one piece, unless it has more than ``TURNS_AT_ONCE`` turns
    or lies over a border of the sort: then it is several, whose texts follow each
    other. A later piece is rendered behind all turns before it, as a black box may
    look at any of them; so its task holds the conversation up to there. Where the
    template is known to write a turn by the ``history`` turns before it alone, give
    that number: then no task holds more than a piece and those turns. The number is
    the caller's promise; it is not checked.

    A template that rewrites history is an error, or, with ``on_rewrite="flag"``,
    gives the conversation as one piece marked ``rewritten``, with the whole text
    as written for all its turns and no spans.
    """
    chunks = stored(_chunks(turns), "chat-turns")
    order = Window.partitionBy("conv_id").orderBy("shard", "n")
    # Every piece has a turn at least, so as many pieces hold that many turns.
    reach = Window.unboundedPreceding if history is None else -max(history, 1)
    earlier = F.flatten(F.collect_list("turns").over(order.rowsBetween(reach, -1)))
    if history is not None:
        earlier = F.slice(earlier, F.greatest(F.size(earlier) - history + 1, F.lit(1)), history)
    placed = chunks.withColumns(
        {"piece": (F.row_number().over(order) - 1).cast("long"), "context": earlier}
    ).select("conv_id", "piece", "context", "turns")
    loss, flag = frozenset(loss_roles), on_rewrite == "flag"

    def pairs(rows) -> list[tuple[str, str]]:
        return [(r["role"], r["text"]) for r in rows or []]

    def one(context: Turns, own: Turns) -> tuple[str, bool, list[dict]]:
        try:
            text, spans = turn_spans(render, [*context, *own], len(context))
        except HistoryRewritten:
            if not flag:
                raise
            return "", True, []
        found = [
            {
                "role": role, "start": s.start, "end": s.end,
                "text_start": s.text_start, "text_end": s.text_end, "loss": role in loss,
            }
            for (role, _), s in zip(own, spans)
        ]
        return text, False, found

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"role": pa.string(), "loss": pa.bool_()}
        names = ("role", "start", "end", "text_start", "text_end", "loss")
        spans_type = pa.list_(pa.struct([(n, kinds.get(n, pa.int32())) for n in names]))
        for batch in batches:
            rows = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            out = [one(pairs(context), pairs(own)) for context, own in rows]
            yield pa.record_batch(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([t for t, _, _ in out], pa.string()),
                    pa.array([r for _, r, _ in out], pa.bool_()),
                    pa.array([s for _, _, s in out], spans_type),
                ],
                names=["conv_id", "piece", "text", "rewritten", "spans"],
            )

    formatted = placed.mapInArrow(write, _FORMATTED)
    if not flag:
        return formatted
    formatted = stored(formatted, "chat-pieces")
    # A rewrite is seen where it happens; the whole conversation is then written anew.
    rewritten = formatted.filter("rewritten").select(F.col("conv_id").alias("_conv")).distinct()
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    said = F.array_sort(F.collect_list(F.struct("shard", "n", "turns")))
    whole = chunks.join(rewritten, same, "left_semi").groupBy("conv_id").agg(
        F.flatten(F.transform(said, lambda chunk: chunk["turns"])).alias("turns")
    )

    def write_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [render(pairs(own)) for own in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), pa.array(texts, pa.string())], names=["conv_id", "text"]
            )

    anew = whole.mapInArrow(write_whole, "conv_id long, text string").select(
        "conv_id", F.lit(0).cast("long").alias("piece"), "text", F.lit(True).alias("rewritten"),
        F.array().cast(formatted.schema["spans"].dataType).alias("spans"),
    )
    return formatted.join(rewritten, same, "left_anti").unionByName(anew)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of conversations, read from what ``marked_turns`` wrote: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    The pieces of a conversation pass through one task in order, one at a time:
    a digest of the whole has no other way.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def emit() -> pa.RecordBatch:
            n, turns, chars, loss, size = state
            values = [key, n, turns.hexdigest(), chars, loss.hexdigest(), size]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.record_batch(
                [pa.array([v], k) for v, k in zip(values, kinds)],
                names=[
                    "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                    "formatted_chars",
                ],
            )

        for batch in batches:
            for conv, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or conv != key:
                    if state is not None:
                        yield emit()
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in read_marked_turns(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                for span in spans:
                    if span["loss"]:
                        said = unescape(text[span["text_start"] : span["text_end"]])
                        state[2] += len(said)
                        state[3].update(said.encode())
                state[4] += len(text)
        if state is not None:
            yield emit()

    return (
        formatted.repartition("conv_id")
        .sortWithinPartitions("conv_id", "piece")
        .select("conv_id", "text", "spans")
        .mapInArrow(
            digest,
            "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
            "loss_sha256 string, formatted_chars long",
        )
    )
