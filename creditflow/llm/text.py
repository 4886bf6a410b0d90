"""Words of Arrow text batches as NumPy arrays.

A word is a run of word bytes of the UTF-8 form; both word rules used here separate words by
ASCII bytes only, so working on bytes is exact. Words and runs of words are named by 64-bit
polynomial hashes (base odd, modulo 2**64, finalised by a bijective mixer), taken from prefix
sums, so no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are turned into arrays at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 19
_WORD_BASE, _RUN_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_U = np.uint64


def _byte_table(separators: list[range], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    word = np.ones(256, dtype=bool)
    for span in separators:
        word[list(span)] = False
    fold = np.arange(256, dtype=np.uint8)
    if lower:
        fold[65:91] += 32
    return word[fold], fold


_BLANKS = [range(0x20, 0x21), range(0x09, 0x0E)]
_LETTERS = [range(0x30, 0x3A), range(0x41, 0x5B), range(0x61, 0x7B), range(0x80, 0x100)]
#: Bytes that end a piece of text.
ENDS = [range(0x0A, 0x0E), *(range(b, b + 1) for b in b".,;:!?")]
_SIGNS = [range(0x00, 0x09), range(0x0E, 0x20), range(0x21, 0x30), range(0x3A, 0x41), range(0x5B, 0x61), range(0x7B, 0x80)]
#: Word rules by name, each with the bytes that separate words.
RULES = {
    "blank": _byte_table(_BLANKS, lower=False),
    "blank_lower": _byte_table(_BLANKS, lower=True),
    "piece_lower": _byte_table(_BLANKS + ENDS, lower=True),
    "alnum_lower": _byte_table([range(0x00, 0x30), range(0x3A, 0x61), range(0x7B, 0x80)], lower=True),
    "letters": _byte_table(_BLANKS + _SIGNS, lower=False),
    "signs": _byte_table(_BLANKS + _LETTERS, lower=False),
}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def hash_order(keys: np.ndarray) -> np.ndarray:
    """The stable order of 64-bit hashes.

    The place of each rides in its low bits, so that numbers are sorted and no places with them.
    """
    low = _U((1 << len(keys).bit_length()) - 1)
    packed = (keys & ~low) | np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    order = (packed & low).astype(np.int64)
    own = keys[order]
    apart = own[1:] ^ own[:-1]
    if ((apart != 0) & (apart <= low)).any():  # hashes that differ in low bits only
        return np.argsort(keys, kind="stable")
    return order


class _Powers:
    """Powers of a base and of its inverse, modulo 2**64, grown when needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", self.base), ("down", self.inverse)):
                table = np.full(size, base, dtype=np.uint64)
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))
        return self.up, self.down


_word_powers, _run_powers = _Powers(_WORD_BASE), _Powers(_RUN_BASE)


@dataclass
class Words:
    """Words of a block of texts.

    ``starts`` and ``ends`` are byte positions in ``data``, ``hashes`` name the words, and text i
    holds words ``first[i]`` to ``first[i + 1]``; its own bytes begin at ``offsets[i]``.
    """

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def runs(self, n: int) -> np.ndarray:
        """Hash of the n words from each word on; meaningless where the text ends sooner."""
        total = len(self.hashes)
        if total < n:
            return np.empty(0, dtype=np.uint64)
        up, down = _run_powers.get(total + 1)
        sums = np.zeros(total + 1, dtype=np.uint64)
        np.cumsum(self.hashes * up[:total], out=sums[1:])
        return mix((sums[n:] - sums[: total - n + 1]) * down[: total - n + 1])

    def run(self, i: int, start: int, end: int) -> bytes:
        return self.data[self.starts[start] : self.ends[end - 1]].tobytes()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0:
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive texts of about ``size`` bytes: first and last index, bytes, offsets."""
    data, offsets = utf8(column)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        to = min(n, max(to, at + 1))
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def words(data: np.ndarray, offsets: np.ndarray, rule: str) -> Words:
    """The words of texts given as bytes and offsets."""
    is_word, _ = RULES[rule]
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = is_word[data]
    begins = inside[1:-1] & ~inside[:-2]
    stops = inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    begins[edges] = inside[edges + 1]
    stops[edges - 1] = inside[edges]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return Words(data, offsets, starts, ends, span_hashes(data, starts, ends, rule), np.searchsorted(starts, offsets))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> np.ndarray:
    """Hashes of spans of bytes, as ``words`` gives them to its words."""
    _, fold = RULES[rule]
    n = len(data)
    up, down = _word_powers.get(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    # One array from the bytes to their sums; "clip" only keeps take from buffering, bytes are in range.
    own = sums[1:]
    np.take(fold.astype(np.uint64) + _U(1), data, out=own, mode="clip")
    own *= up[:n]
    np.cumsum(own, out=own)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_blocks(column: pa.Array, rule: str, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Words]]:
    for at, to, data, offsets in blocks(column, size):
        yield at, to, words(data, offsets, rule)
