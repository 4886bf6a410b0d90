"""Token ids of whole texts by a given tokenizer file of the ``tokenizers`` library."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex

from creditflow.llm import text as T
from creditflow.llm.scratch import return_memory

#: Units whose ids a worker remembers.
MEMORY = 600_000
#: Bytes of text encoded at once, and new units in one text for the library.
BLOCK_BYTES, JOINED = 1 << 20, 256
# Fixed value: how word_bpe_49k.json cuts text into pieces (from the file): runs of letters, single
# numerals, runs of signs, and before them these endings behind an apostrophe.
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
_SUFFIX, _SPECIAL = "</w>", b"<|"
# Characters for which lower case and normal form need no context and no newer Unicode version:
# Latin and Cyrillic letters that are composed, and usual signs. Special tokens begin with "<|".
_USUAL = "[!-~\u00a1-\u012f\u0131-\u02ff\u0400-\u0482\u048a-\u052f\u2010-\u2027\u2030-\u203a\u20ac]"
_BLANK, _LETTER, _NUMERAL, _SIGN, _UNUSUAL = range(5)


def _kinds() -> np.ndarray:
    """The kind of each character up to U+FFFF."""
    kinds = np.full(1 << 16, _UNUSUAL, dtype=np.uint8)
    usual = regex.findall(_USUAL, "".join(map(chr, range(0xD800))))
    for kind, pattern in ((_SIGN, "."), (_NUMERAL, r"\p{N}"), (_LETTER, r"\p{L}")):
        kinds[[ord(c) for c in usual if regex.match(pattern, c)]] = kind
    kinds[[0x20, *range(0x09, 0x0E)]] = _BLANK
    return kinds


_KINDS = _kinds()


def _byte_kinds(data: np.ndarray) -> np.ndarray:
    """For each byte of UTF-8 text the kind of its character."""
    kinds = _KINDS[:256][data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        kinds[data >= 0x80] = _UNUSUAL
        b, n = data[lead].astype(np.uint16), len(data) - 1
        second, third = (data[np.minimum(lead + k, n)].astype(np.uint16) & 0x3F for k in (1, 2))
        two, three = b < 0xE0, (b >= 0xE0) & (b < 0xF0)
        kind = np.full(len(lead), _UNUSUAL, dtype=np.uint8)
        kind[two] = _KINDS[((b & 0x1F) << 6 | second)[two]]
        kind[three] = _KINDS[((b & 0x0F) << 12 | second << 6 | third)[three]]
        kinds[lead], kinds[lead + 1], kinds[lead[three] + 2] = kind, kind, kind[three]
    return kinds


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last byte of each unit of texts, and whether it holds unusual characters.

    A unit is one of the tokenizer's pieces, or a whole run without white space if that holds
    unusual characters or may hold a special token.
    """
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    kinds = _byte_kinds(data)
    begins = offsets[:-1][offsets[:-1] < n]
    edge = np.ones(n + 1, dtype=bool)
    np.not_equal(kinds[1:], kinds[:-1], out=edge[1:n])
    edge[:n] |= (kinds == _NUMERAL) & ((data & 0xC0) != 0x80)
    edge[begins] = True
    _endings(data, kinds, edge, begins)
    strange = kinds == _UNUSUAL
    strange[:-1] |= (data[:-1] == _SPECIAL[0]) & (data[1:] == _SPECIAL[1])
    at = np.flatnonzero(strange)
    if len(at):
        # Runs without white space, in which nothing is cut if they hold such a byte.
        blank = kinds == _BLANK
        cut = np.ones(n + 1, dtype=bool)
        np.not_equal(blank[1:], blank[:-1], out=cut[1:n])
        cut[begins] = True
        cuts = np.flatnonzero(cut)
        run = np.unique(np.searchsorted(cuts, at, side="right") - 1)
        within = np.zeros(n + 1, dtype=np.int8)
        within[cuts[run]] += 1
        within[cuts[run + 1]] -= 1
        strange = np.cumsum(within, dtype=np.int8).astype(bool)
        edge = (edge & ~strange) | cut
    edges = np.flatnonzero(edge)
    starts, ends = edges[:-1], edges[1:]
    kept = kinds[starts] != _BLANK
    starts, ends = starts[kept], ends[kept]
    return starts, ends, strange[starts]


def _endings(data: np.ndarray, kinds: np.ndarray, edge: np.ndarray, begins: np.ndarray) -> None:
    """Put endings with their apostrophe: where a run of signs is one apostrophe before letters."""
    n = len(data)
    at = np.flatnonzero(data[:-1] == 0x27)
    at = at[edge[at] & edge[at + 1] & (kinds[at + 1] == _LETTER)]
    at = at[~np.isin(at + 1, begins)]
    if not len(at):
        return
    after = np.flatnonzero(edge)
    to = after[np.searchsorted(after, at + 1, side="right")]  # the letters end here
    one, two = (data[np.minimum(at + k, n - 1)] | 0x20 for k in (1, 2))
    for ending in _ENDINGS:
        fits = (one == ord(ending[0])) & (to >= at + 1 + len(ending))
        if len(ending) > 1:
            fits &= two == ord(ending[1])
        edge[at[fits] + 1] = False
        edge[at[fits] + 1 + len(ending)] = True


class Encoder:
    """Encodes texts by their units, for tokenizers that drop white space and mark word ends.

    No token reaches across a unit. A block's units are found and told apart by their 64-bit
    hashes, without regard to the case of A-Z, and only those that are not remembered go to the
    library: usual ones many at a time with blanks between, where the mark at a piece's end tells
    their ids apart; unusual ones go one by one. Tests compare with whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(_SUFFIX)]] = True
        self._forget(0)

    def _forget(self, kept: int) -> None:
        """Keep the units met first, among which are the frequent ones."""
        if not kept:
            self.hashes, self.bounds, self.pool = np.empty(0, np.uint64), np.zeros(1, np.int64), np.empty(0, "<u4")
        else:
            self.hashes, self.bounds = self.hashes[:kept], self.bounds[: kept + 1]
            self.pool = self.pool[: self.bounds[-1]]
        self.order = np.argsort(self.hashes)
        self.sorted = self.hashes[self.order]

    def encode(self, column: pa.Array, end: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For each block of texts: first and last row, all ids (each text's and ``end``; null is
        empty) as unsigned 32-bit integers, and where each text's begin."""
        for at, to, data, offsets in T.blocks(column, BLOCK_BYTES):
            starts, ends, strange = units(data, offsets)
            # Special tokens are told apart by case, so their units' hashes are as well.
            lower = _SPECIAL not in data.tobytes()
            hashes = T.span_hashes(data, starts, ends, "blank_lower" if lower else "blank")
            order = np.argsort(hashes)
            ranked = hashes[order]
            fresh = np.append(True, ranked[1:] != ranked[:-1])[: len(ranked)]
            unique, first = ranked[fresh], order[fresh]
            inverse = np.empty(len(hashes), np.int64)
            inverse[order] = np.cumsum(fresh) - 1
            place = np.minimum(np.searchsorted(self.sorted, unique), max(len(self.sorted) - 1, 0))
            known = self.sorted[place] == unique if len(self.sorted) else np.zeros(len(unique), dtype=bool)
            new = np.flatnonzero(~known)
            new = new[np.argsort(strange[first[new]], kind="stable")]
            n_usual = len(new) - int(strange[first[new]].sum())
            ids, sizes = self._new(data, starts[first[new]], ends[first[new]], n_usual)
            pool = np.concatenate([self.pool, ids, np.array([end], "<u4")])
            begin, size = np.zeros(len(unique), np.int64), np.zeros(len(unique), np.int64)
            if known.any():
                own = self.order[place[known]]
                begin[known], size[known] = self.bounds[own], self.bounds[own + 1] - self.bounds[own]
            size[new] = sizes
            begin[new] = len(self.pool) + np.cumsum(sizes) - sizes
            text = np.searchsorted(starts, offsets)
            begins = np.insert(begin[inverse], text[1:], len(pool) - 1)
            counts = np.insert(size[inverse], text[1:], 1)
            reach = np.append(0, np.cumsum(counts))
            out = pool[np.repeat(begins - reach[:-1], counts) + np.arange(reach[-1])]
            self._remember(unique[new], ids, sizes)
            yield at, to, out, reach[text + np.arange(len(text))]

    def _remember(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        if not len(hashes):
            return
        if len(self.hashes) + len(hashes) > MEMORY:
            self._forget(min(len(self.hashes), MEMORY // 2))
        order = np.argsort(hashes)
        place = np.searchsorted(self.sorted, hashes[order])
        self.sorted = np.insert(self.sorted, place, hashes[order])
        self.order = np.insert(self.order, place, len(self.hashes) + order)
        self.bounds = np.append(self.bounds, self.bounds[-1] + np.cumsum(sizes))
        self.pool, self.hashes = np.concatenate([self.pool, ids]), np.concatenate([self.hashes, hashes])

    def _new(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, n_usual: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units end to end, and how many each has; the first ``n_usual`` are usual ones."""
        parts, sizes = [], []
        spans = list(zip(starts.tolist(), ends.tolist()))
        joined = _joined(data, starts[:n_usual], ends[:n_usual])
        got = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        for k, one in enumerate(got):
            ids, n = np.array(one.ids, dtype="<u4"), min(JOINED, n_usual - k * JOINED)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == n:
                parts.append(ids)
                sizes.append(np.diff(stops, prepend=0))
            else:  # the marks don't tell
                self._single(data, spans[k * JOINED : k * JOINED + n], parts, sizes)
        if n_usual < len(spans):
            self._single(data, spans[n_usual:], parts, sizes)
        return np.concatenate([np.empty(0, "<u4"), *parts]), np.concatenate([np.empty(0, np.int64), *sizes])

    def _single(self, data: np.ndarray, spans: list[tuple[int, int]], parts: list, sizes: list) -> None:
        texts = [data[a:b].tobytes().decode("utf-8") for a, b in spans]
        each = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        parts.append(np.array([i for own in each for i in own], dtype="<u4"))
        sizes.append(np.array([len(own) for own in each], dtype=np.int64))

    def close(self) -> None:
        """Forget everything: workers stay for later stages, which need the memory."""
        self._forget(0)
        return_memory()

    def ids(self, text: str | None, end: int) -> np.ndarray:
        """The ids of one text."""
        ((_, _, out, _),) = self.encode(pa.array([text], pa.string()), end)
        return out


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    """Texts of ``JOINED`` units each, with blanks between."""
    if not len(starts):
        return []
    sizes = ends - starts + 1
    reach = np.append(0, np.cumsum(sizes))
    raw = np.append(data, np.uint8(0x20))[np.minimum(np.repeat(starts - reach[:-1], sizes) + np.arange(reach[-1]), len(data))]
    raw[reach[1:] - 1] = 0x20
    whole, cuts = raw.tobytes(), reach[::JOINED].tolist()
    return [whole[a:b].decode("utf-8") for a, b in zip(cuts, [*cuts[1:], len(whole)]) if a < b]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
