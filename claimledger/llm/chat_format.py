"""Conversations as marked-up text with a loss mask, assembled column by column.

A turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``. The loss mask covers the texts of assistant turns.

Control strings inside texts and roles are escaped: wherever ``<``, any number of backslashes and ``|`` follow each
other, one backslash is added, so that ``<|`` never comes from a text. In roles, backslashes are doubled and line ends
are written as ``\\n`` first. Both are undone by ``parse``.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"

# Turns are assembled in slices that end at so many bytes, at a conversation's end.
SLICE_BYTES = 8_000_000

FORMATTED = "conv_id bigint, formatted string, loss_spans array<struct<start:bigint,end:bigint>>"
_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)
_LOSS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, r"<(\\*)\|", r"<\1\\|")


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(roles: pa.Array) -> pa.Array:
    return escape(pc.replace_substring(pc.replace_substring(roles, "\\", "\\\\"), "\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted conversation."""
    return [(unescape_role(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def _data(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The offsets (from 0) and bytes of a large string column."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0] : offsets[-1]]


def _scatter(target: np.ndarray, places: np.ndarray, offsets: np.ndarray, data: np.ndarray) -> None:
    """Copy segment i of ``data`` to ``places[i]``."""
    lengths = np.diff(offsets)
    target[np.arange(len(data)) + np.repeat(places - offsets[:-1], lengths)] = data


def assemble(conv_id: np.ndarray, roles: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """One row per conversation. The turns of a conversation are neighbours, in order."""
    learned = np.asarray(pc.equal(roles, LEARNED_ROLE), dtype=bool)
    segments = [
        pa.repeat(pa.scalar(START, pa.large_string()), len(roles)),
        escape_role(roles),
        pa.repeat(pa.scalar("\n", pa.large_string()), len(roles)),
        escape(texts),
        pa.repeat(pa.scalar(END + "\n", pa.large_string()), len(roles)),
    ]
    parts = [_data(s) for s in segments]
    lengths = np.stack([np.diff(offsets) for offsets, _ in parts], 1)
    ends = np.cumsum(lengths.ravel()).reshape(lengths.shape)
    starts = ends - lengths
    buffer = np.empty(int(ends[-1, -1]), np.uint8)
    for number, (offsets, data) in enumerate(parts):
        _scatter(buffer, starts[:, number], offsets, data)
    first = np.flatnonzero(np.append(True, conv_id[1:] != conv_id[:-1]))
    bounds = np.append(starts[first, 0], len(buffer))
    formatted = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(buffer))
    # Positions in code points: bytes that do not continue a character, counted from the conversation's start.
    points = np.append(0, np.cumsum((buffer & 0xC0) != 0x80))
    owner = np.cumsum(np.append(True, conv_id[1:] != conv_id[:-1])) - 1
    base = points[bounds[:-1]][owner]
    spans = pa.StructArray.from_arrays(
        [pa.array((points[starts[:, 3]] - base)[learned]), pa.array((points[ends[:, 3]] - base)[learned])], ["start", "end"]
    )
    per_conversation = np.append(0, np.cumsum(np.bincount(owner[learned], minlength=len(first))))
    loss = pa.ListArray.from_arrays(pa.array(per_conversation, pa.int32()), spans)
    ids = pa.array(conv_id[first])
    return pa.RecordBatch.from_arrays([ids, formatted.cast(pa.string()), loss.cast(_LOSS)], ["conv_id", "formatted", "loss_spans"])


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: list[pa.RecordBatch] = []

    def flush(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        role, text = (rows.column(c).combine_chunks().cast(pa.large_string()) for c in ("role", "text"))
        return assemble(np.asarray(rows.column("conv_id")), role, text)

    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        size += batch.nbytes
        if size < SLICE_BYTES:
            continue
        rows = pa.Table.from_batches(waiting)
        ids = np.asarray(rows.column("conv_id"))
        done = int(np.searchsorted(ids, ids[-1], "left"))  # the last conversation may go on
        if done:
            yield flush(rows.slice(0, done))
            waiting = rows.slice(done).combine_chunks().to_batches()
            size = sum(b.nbytes for b in waiting)
    if waiting:
        yield flush(pa.Table.from_batches(waiting))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: its text and the spans (code points, end exclusive) under the loss mask.

    ``turns`` has conv_id, turn, role and text; other columns are ignored. Turns are ordered by ``turn`` (NULL first),
    ties by role and text; repeated rows are turns of their own. NULL texts and roles are empty; an unknown role is
    written as it is, without loss. Rows without ``conv_id`` belong to no conversation and go. One shuffle by conversation;
    a conversation becomes one row, so its turns meet in one task, which streams over them in order.
    """
    rows = (
        turns.where(F.col("conv_id").isNotNull())
        .select(
            F.col("conv_id").cast("bigint").alias("conv_id"),
            F.col("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )
    return rows.mapInArrow(_format, FORMATTED)


def read_turns(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say: the turns, and the learned texts cut out by the loss spans, unescaped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts, spans = part.column("formatted").to_pylist(), part.column("loss_spans").to_pylist()
                turns = [[{"role": r, "text": t} for r, t in parse(text)] for text in texts]
                learned = [
                    [unescape(text[s["start"] : s["end"]]) for s in own] for text, own in zip(texts, spans, strict=True)
                ]
                kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
                arrays = [part.column("conv_id"), pa.array(texts), pa.array(turns, kind), pa.array(learned, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "formatted", "turns", "learned"])

    kinds = "conv_id bigint, formatted string, turns array<struct<role:string,text:string>>, learned array<string>"
    return formatted.mapInArrow(run, kinds)
