"""Plain restatements of what the operators must return, for small tables."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np

_FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
LAST = 1 << 63


def blank_words(text: str | None, lower: bool = False) -> list[str]:
    text = text or ""
    return re.findall("[^\x20\x09-\x0d]+", text.translate(_FOLD) if lower else text)


def item_words(text: str | None) -> list[str]:
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(_FOLD))


class Groups:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def shingle_set(text: str | None, width: int = 5) -> set[tuple]:
    w = blank_words(text, lower=True)
    return set(zip(*(w[k:] for k in range(width)))) if len(w) >= width else ({tuple(w)} if w else set())


def near_duplicates(rows: list[tuple], percent: int) -> dict:
    """doc_id -> (n_shingles, component); ids must differ."""
    sets = {i: shingle_set(t) for i, t in rows if i is not None}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    both = Counter(pair for ids in holders.values() for pair in combinations(sorted(ids), 2))
    groups = Groups()
    for (a, b), n in both.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            groups.join(a, b)
    return {i: (len(s), groups.find(i)) for i, s in sets.items()}


def warc(rows: list[tuple]) -> list[tuple]:
    first = {}
    for page, html in rows:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    out = []
    for page, html in rows:
        data, ref = (html or "").encode(), first.get(html or "")
        revisit = ref is not None and ref != page
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", ref if revisit else None))
    return out


def token_ids(tokenizer, text: str | None) -> np.ndarray:
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")


def records(tokenizer, rows: list[tuple]) -> list[tuple]:
    """Of rows in the order in which they are written."""
    out, start = [], 0
    for doc, text in rows:
        ids = token_ids(tokenizer, text)
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def pieces(tokenizer, rows: list[tuple], capacity: int) -> list[tuple]:
    out = []
    for doc, text in rows:
        ids = token_ids(tokenizer, text)
        for k, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            out.append((doc, k, start, len(part), zlib.crc32(part.tobytes())))
    return out


def contaminated(docs: list[tuple], items: list[tuple], window: int = 10) -> list[tuple]:
    windows = defaultdict(set)
    for item, text in items:
        w = item_words(text)
        if w and item is not None:
            for k in range(max(1, len(w) - window + 1)):
                windows[tuple(w[k : k + window])].add(str(item))
    out = []
    sizes = {len(x) for x in windows}
    for doc, text in docs:
        w = item_words(text)
        hit, found = set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if (own := windows.get(tuple(w[k : k + size]))) is not None:
                    hit.update(range(k, k + size))
                    found |= own
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return out


def vector_links(rows: list[tuple], threshold: float) -> dict:
    """vec_id -> (n_links, component); ids must differ."""
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, dtype=np.float64)
            good[i] = x / np.sqrt((x * x).sum())
    ids = sorted(good)
    groups, links = Groups(), Counter()
    for a, b in combinations(ids, 2):
        if len(good[a]) == len(good[b]) and good[a] @ good[b] >= threshold:
            links[a] += 1
            links[b] += 1
            groups.join(a, b)
    return {i: (links[i], groups.find(i)) for i, _ in rows if i is not None}


def without_repeats(rows: list[tuple], window: int = 20) -> list[tuple]:
    """(doc_id, n_words, n_removed, kept text)."""
    key = lambda doc: LAST if doc is None else doc
    first, words = {}, [(doc, blank_words(text)) for doc, text in rows]
    for doc, w in words:
        for k in range(len(w) - window + 1):
            run = tuple(w[k : k + window])
            first[run] = min(first.get(run, (key(doc), k)), (key(doc), k))
    out = []
    for doc, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < (key(doc), k):
                gone.update(range(k, k + window))
        out.append((doc, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out
