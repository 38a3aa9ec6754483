"""Chat formatting by columnar byte assembly, with a loss mask, and the way back.

A turn is ``### ROLE: TEXT</turn>`` and a line feed.  Inside roles and texts a
backslash becomes two, ``### `` becomes ``\\h``, ``</turn>`` becomes ``\\t`` and,
in roles, a colon becomes ``\\c``; so the marks of the template occur only where
the template put them, and the way back is exact.

Method: per block of turns, escape the columns, compute the lengths of headers,
contents and ends, turn them into cumulative offsets, and scatter all bytes into
one preallocated Arrow buffer.  The loss mask is the byte range of each assistant
text.

Scale: one shuffle by conversation; a task streams its sorted turns in blocks, so
a conversation of any length is never held whole: it comes out as numbered chunks of
whole turns.  Chunks can be stored and read in any order and number of tasks; the way
back shuffles them by conversation and sorts them by number.  A conversation's turns
pass through one task each way, since chunk numbers and digests follow their order; it
streams them.

Defined cases: null text, role: empty.  Turns with one number are ordered by role,
then text; null turns come first; repeated rows are turns of their own.  Rows
with a null conversation id are one conversation.  An empty table gives an empty
result.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import c
from tessera.llm.words import blocks, flat, ranges

OPEN, MIDDLE, END = "### ", ": ", "</turn>\n"
ESCAPES = (("\\", "\\\\"), (OPEN, "\\h"), ("</turn>", "\\t"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
_BACK = {"\\": "\\", "h": OPEN, "t": "</turn>", "c": ":"}


def escape(values: pa.Array, rules: tuple = ESCAPES) -> pa.Array:
    for plain, coded in rules:
        values = pc.replace_substring(values, plain, coded)
    return values


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _BACK[m[1]], text) if "\\" in text else text


def assemble(columns: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """The rows' strings, column after column, in one buffer; and the byte offset of each cell."""
    flats = [flat(x) for x in columns]
    lengths = np.stack([np.diff(offsets) for _, offsets in flats], axis=1)
    ends = np.cumsum(lengths.reshape(-1))
    offsets = np.concatenate([[0], ends])
    out = np.empty(int(offsets[-1]), np.uint8)
    starts = offsets[:-1].reshape(lengths.shape)
    for k, (data, _) in enumerate(flats):
        out[ranges(starts[:, k], lengths[:, k])] = data
    return out, offsets


FORMAT_SCHEMA = "conv_id long, chunk long, first_turn long, n_turns long, formatted string, mask_starts array<long>, mask_lengths array<long>"


def format_conversations(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learn: str = "assistant"
) -> DataFrame:
    """Chunks of formatted conversations, each chunk's whole turns in order.

    ``chunk`` numbers the chunks of a conversation from 0, ``first_turn`` is the
    number of turns before a chunk.  The mask is in bytes of ``formatted`` and covers the texts of role ``learn``.
    """
    rows = turns.select(c(conv).cast("long").alias("conv"), c(turn).alias("turn"), F.coalesce(c(role), F.lit("")).alias("role"), F.coalesce(c(text), F.lit("")).alias("text"))
    ordered = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None  # the conversation of the last chunk, the chunk's number, the turns up to its end
        for batch in blocks(batches, "text"):
            roles, n = batch.column("role"), batch.num_rows
            cells = [pa.array([OPEN] * n), escape(roles, ROLE_ESCAPES), pa.array([MIDDLE] * n), escape(batch.column("text")), pa.array([END] * n)]
            out, offsets = assemble(cells)
            who = batch.column("conv")
            number = np.asarray(who.fill_null(0))
            changed = (number[1:] != number[:-1]) | (np.asarray(who.is_null())[1:] != np.asarray(who.is_null())[:-1])
            first = np.flatnonzero(np.concatenate([[True], changed]))
            bounds = np.append(first, n)
            starts = offsets[5 * bounds]
            learned = np.flatnonzero(np.asarray(pc.equal(roles, learn)))
            chunk = np.searchsorted(first, learned, side="right") - 1
            at = pa.array(np.searchsorted(learned, bounds), pa.int32())
            a, b = offsets[5 * learned + 3], offsets[5 * learned + 4]
            turns_of, names = np.diff(bounds), who.take(pa.array(first))
            chunks, before = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
            if now is not None and now[0] == names[0].as_py():
                chunks[0], before[0] = now[1] + 1, now[2]
            now = (names[-1].as_py(), int(chunks[-1]), int(before[-1] + turns_of[-1]))
            yield pa.RecordBatch.from_arrays([
                names, pa.array(chunks), pa.array(before), pa.array(turns_of, pa.int64()),
                pa.StringArray.from_buffers(len(first), pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(out)),
                pa.ListArray.from_arrays(at, pa.array(a - starts[chunk], pa.int64())), pa.ListArray.from_arrays(at, pa.array(b - a, pa.int64())),
            ], names=[x.split()[0] for x in FORMAT_SCHEMA.split(", ")])

    return ordered.mapInArrow(run, FORMAT_SCHEMA)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted chunk."""
    out = []
    for part in formatted.split(END)[:-1]:
        role, _, text = part.removeprefix(OPEN).partition(MIDDLE)
        out.append((unescape(role), unescape(text)))
    return out


DIGEST_SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the formatted chunks alone, in whatever order they are read: counts and digests of turns and loss texts."""
    ordered = formatted.select("conv_id", "chunk", "formatted", "mask_starts", "mask_lengths").repartition("conv_id").sortWithinPartitions("conv_id", "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in DIGEST_SCHEMA.split(", ")]
        state: list | None = None

        def done(s: list) -> tuple:
            return (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5])

        for batch in batches:
            rows = []
            for x in batch.to_pylist():
                if state is None or state[0] != x["conv_id"]:
                    if state is not None:
                        rows.append(done(state))
                    state = [x["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turns, raw = parse(x["formatted"]), x["formatted"].encode()
                for role, text in turns:
                    state[2].update(f"{role}\n{text}\n".encode())
                for a, n in zip(x["mask_starts"], x["mask_lengths"], strict=True):
                    text = unescape(raw[a : a + n].decode())
                    state[3] += len(text)
                    state[4].update(text.encode())
                state[1] += len(turns)
                state[5] += len(x["formatted"])
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=names)
        if state is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, done(state), strict=True))])

    return ordered.mapInArrow(run, DIGEST_SCHEMA)
