"""Columnar word splitting: one numpy pass over the UTF-8 bytes of a batch of texts.

No Python object is made per word.  Every class of separators used here is
ASCII, and the bytes of other characters are all above 0x7F, so working on
bytes is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 4 << 20

#: Word bytes of `[^\x20\x09-\x0D]+`.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Word bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` (after lower-casing A-Z).
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


@dataclass
class Words:
    """Words of a block of texts; row r has the words ``rows[r]:rows[r + 1]``."""

    data: np.ndarray  # bytes of all texts, one after the other
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte after each word
    rows: np.ndarray  # word offsets of the rows, one more than rows
    mask: np.ndarray  # the bytes of ``data`` that lie in words

    def array(self) -> pa.Array:
        """The words as a string array (bytes are copied once)."""
        n = self.end - self.start
        offsets = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=offsets[1:])
        return pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(offsets), pa.py_buffer(self.data[self.mask]))

    def codes(self) -> tuple[np.ndarray, pa.Array]:
        """Per word its number in the block's vocabulary, and that vocabulary."""
        d = self.array().dictionary_encode()
        return d.indices.to_numpy(zero_copy_only=False), d.dictionary

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their row offsets; null counts as empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def split_words(texts: pa.Array, word_bytes: np.ndarray = NOT_SPACE, lower: bool = False, cuts=None) -> Words:
    """Words of each text; ``cuts(data)`` marks bytes that begin a word inside a run of word bytes."""
    data, rows = flat(texts)
    if lower:
        data = np.frombuffer(data.tobytes().translate(LOWER), np.uint8)
    w = word_bytes[data]
    first, last = w.copy(), w.copy()
    apart = ~w[:-1] | ~w[1:]  # two neighbours that are not in one word
    if cuts is not None:
        apart |= cuts(data)[1:]
    first[1:] &= apart
    last[:-1] &= apart
    full = rows[:-1] < rows[1:]
    at = rows[:-1][full]
    first[at] = w[at]
    at = rows[1:][full] - 1
    last[at] = w[at]
    start = np.flatnonzero(first)
    return Words(data, start, np.flatnonzero(last) + 1, np.searchsorted(start, rows), w)


def blocks(batches: Iterator[pa.RecordBatch], text: str, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each has about ``size`` bytes of text at most, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = flat(batch.column(text))[1]
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + size, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to
        del batch, ends  # before the next one is read


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after the other."""
    ends = np.cumsum(lengths, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total < 1 << 31 and (not len(starts) or int(starts.max()) < (1 << 31) - total) else np.int64
    return np.arange(total, dtype=kind) + np.repeat((starts - (ends - lengths)).astype(kind), lengths)


def join_words(data: np.ndarray, start: np.ndarray, end: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of each row's words joined by one space, and the rows' byte offsets."""
    n = end - start
    width = n + 1
    if len(n):
        lasts = rows[1:][rows[1:] > rows[:-1]] - 1
        width[lasts] -= 1
    ends = np.cumsum(width)
    out = np.full(int(ends[-1]) if len(n) else 0, 0x20, np.uint8)
    out[ranges(ends - width, n)] = data[ranges(start, n)]
    return out, np.concatenate([[0], ends])[rows]
