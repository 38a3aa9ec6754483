"""Token ids of whole texts by a public tokenizer, each distinct word encoded once.

ASCII white space never lies inside a token of these vocabularies (it is
dropped, and no step before the BPE looks across it), so a text's ids are the
ids of its white-space separated words, one after the other.  Only tokenizers
for which this holds may be used; ``splits_at_space`` tells.  Where the
pre-tokenizer also parts letters from punctuation and the normalizer lower-cases,
words are parted and lower-cased first, so fewer are distinct.

A block's distinct words are found by column code, encoded once, and gathered
per text; a worker keeps the ids of words it has met.
"""

from __future__ import annotations

import ctypes
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from tessera.llm.words import ranges, split_words

#: Words whose ids a worker keeps (about 200 bytes each); emptied when full.
KEPT_WORDS = 400_000
#: Words encoded as one text, if they are letters only.
TOGETHER = 512
#: Fixed value: a pre-tokenizer pattern that parts letters from punctuation.
PARTING = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_MARK = np.zeros(256, bool)  # ASCII punctuation but the apostrophe, which contractions begin with
_MARK[0x21:0x30] = _MARK[0x3A:0x41] = _MARK[0x5B:0x61] = _MARK[0x7B:0x7F] = True
_MARK[0x27] = False


def give_back() -> None:
    """Return freed memory to the system, which the allocators of a worker that is used again would keep."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def forget() -> None:
    """Free the tokenizers and the ids of words that this worker keeps, for a step that needs neither."""
    _load.cache_clear()
    give_back()


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@dataclass
class _Loaded:
    tokenizer: Tokenizer
    spec: dict
    kept: dict[str, bytes]
    ends: np.ndarray | None  # ids that end a word, if the vocabulary marks them
    parts: bool  # letters are parted from punctuation, and lower-cased
    added: list[bytes]


@lru_cache(maxsize=2)
def _load(path: str) -> _Loaded:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    tokenizer = Tokenizer.from_file(path)
    spec = json.loads(tokenizer.to_str())
    suffix = spec["model"].get("end_of_word_suffix")
    ends = None
    if suffix:
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        ends[[v for k, v in vocabulary.items() if k.endswith(suffix)]] = True
    lowers = any(x.get("type") == "Lowercase" for x in (spec.get("normalizer") or {}).get("normalizers", []))
    parts = lowers and any(x.get("pattern", {}).get("Regex") == PARTING for x in _steps(spec))
    added = [x["content"].lower().encode() for x in spec.get("added_tokens", [])]
    return _Loaded(tokenizer, spec, {}, ends, parts, added)


def _steps(spec: dict) -> list[dict]:
    pre = spec.get("pre_tokenizer") or {}
    return pre.get("pretokenizers", [pre])


def splits_at_space(path: str) -> bool:
    """True if the tokenizer drops white space and takes nothing across it."""
    spec = _load(path).spec
    steps = _steps(spec)
    drops = any(s.get("type") in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer") or (s.get("type") == "Split" and s.get("behavior") == "Removed") for s in steps)
    prefixed = any(s.get("add_prefix_space") for s in steps)
    plain = not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or any(x.isspace() for x in t["content"]) for t in spec.get("added_tokens", []))
    return drops and not prefixed and plain


def vocabulary_size(path: str) -> int:
    return _load(path).tokenizer.get_vocab_size(with_added_tokens=True)


def _parting(data: np.ndarray) -> np.ndarray:
    """Bytes that begin a word after letters or punctuation: a sure pre-token border.

    Beside ASCII letters, the two-byte letters U+00C0 to U+024F count; other
    characters may be marks, so nothing is parted at them.
    """
    mark, letter = _MARK[data], _LETTER[data]
    before = letter.copy()
    two = (data[:-1] >= 0xC3) & (data[:-1] <= 0xC9) & ~((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))
    before[1:] |= two
    out = np.zeros(len(data), bool)
    out[1:] = (before[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
    return out


def _encode_new(t: _Loaded, words: list[str]) -> Iterator[tuple[str, bytes]]:
    plain = [w for w in words if w.isalpha()] if t.ends is not None else []
    rest = [w for w in words if not w.isalpha()] if t.ends is not None else words
    groups = [plain[i : i + TOGETHER] for i in range(0, len(plain), TOGETHER)]
    coded = t.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
    for group, x in zip(groups, coded, strict=True):
        ids = np.array(x.ids, np.uint32)
        ends = np.flatnonzero(t.ends[ids]) + 1
        if len(ends) != len(group):  # a letter that the tokenizer takes for none
            rest.extend(group)
            continue
        raw, at = ids.tobytes(), 0
        for w, e in zip(group, (4 * ends).tolist(), strict=True):
            yield w, raw[at:e]
            at = e
    if rest:
        x = t.tokenizer.encode(rest, is_pretokenized=True, add_special_tokens=False)
        raw = np.array(x.ids, np.uint32).tobytes()
        at = 4 * np.searchsorted(np.array(x.word_ids, np.int64), np.arange(len(rest) + 1))
        for w, i, j in zip(rest, at[:-1].tolist(), at[1:].tolist(), strict=True):
            yield w, raw[i:j]


def _ids_of(t: _Loaded, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the distinct words, one after the other, and their counts."""
    kept = t.kept
    if len(kept) > KEPT_WORDS:
        kept.clear()
    new = [w for w in words if w not in kept]
    if new:
        kept.update(_encode_new(t, new))
    parts = [kept[w] for w in words]
    counts = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    return np.frombuffer(b"".join(parts), np.uint32), counts


def encode_texts(texts: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a block of texts, ``end_id`` after each text, and the rows' offsets.

    A null text counts as empty: its only id is ``end_id``.
    """
    t = _load(path)
    words = split_words(texts, lower=t.parts, cuts=_parting if t.parts else None)
    if t.parts and any(x in words.data.tobytes() for x in t.added):
        words = split_words(texts)  # an added token is one piece, in this spelling only
    codes, vocabulary = words.codes()
    ids, counts = _ids_of(t, vocabulary.to_pylist())
    first = (np.cumsum(counts) - counts).astype(np.int32)
    per_word = counts.astype(np.int32)[codes]
    before = np.concatenate([[0], np.cumsum(per_word, dtype=np.int64)])[words.rows]
    rows = before + np.arange(len(before))
    out = np.full(int(rows[-1]), end_id, np.uint32)
    body = np.ones(len(out), bool)
    body[rows[1:] - 1] = False
    out[body] = ids[ranges(first[codes], per_word)]
    return out, rows
