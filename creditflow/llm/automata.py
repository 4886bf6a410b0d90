"""Weighted acyclic automata that map sequences of labels to counts, as NumPy arrays.

A state has a weight and arcs in the order of their labels; the weight of the state that a sequence
leads to is its count. Labels are 64-bit numbers other than 0. States that are alike in weight and
arcs are one state.

Sequences travel as :class:`Counted`: rows of labels, filled up with 0, and a count each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from creditflow.llm.text import hash_order, mix

_U = np.uint64
_ODD = _U(0xD6E8FEB86659FD93)


@dataclass
class Counted:
    """Label sequences, a row each, and their counts."""

    labels: np.ndarray
    n: np.ndarray

    @classmethod
    def of(cls, pairs, width: int) -> Counted:
        """From pairs of a sequence of numbers and its count."""
        pairs = list(pairs)
        rows = [[*labels, *[0] * (width - len(labels))] for labels, _ in pairs]
        return cls(np.array(rows, dtype=np.uint64).reshape(len(rows), width), np.array([n for _, n in pairs], dtype=np.int64))

    @classmethod
    def joined(cls, parts: list[Counted]) -> Counted:
        return cls(np.concatenate([p.labels for p in parts]), np.concatenate([p.n for p in parts]))

    def __len__(self) -> int:
        return len(self.n)

    def __getitem__(self, rows) -> Counted:
        return Counted(self.labels[rows], self.n[rows])

    @property
    def sizes(self) -> np.ndarray:
        return (self.labels != 0).sum(axis=1)

    def sorted(self) -> Counted:
        return self[np.lexsort(self.labels.T[::-1])] if len(self) else self

    def keys(self) -> np.ndarray:
        """A hash per row."""
        key = np.zeros(len(self), dtype=np.uint64)
        for column in self.labels.T:
            key = mix(key * _ODD + column)
        return key

    def summed(self) -> Counted:
        """Each sequence once, with the sum of its counts, in the order of hashes."""
        key = self.keys()
        order = hash_order(key)
        rows, key = self[order], key[order]
        if not len(rows):
            return rows
        same = (rows.labels[1:] == rows.labels[:-1]).all(axis=1)
        if (same != (key[1:] == key[:-1])).any():  # two sequences of one hash
            rows = self.sorted()
            same = (rows.labels[1:] == rows.labels[:-1]).all(axis=1)
        first = np.flatnonzero(np.concatenate([[True], ~same]))
        return Counted(rows.labels[first], np.add.reduceat(rows.n, first))


@dataclass
class CountTransducer:
    """``weights[s]``; the arcs of state s are ``first[s]`` to ``first[s + 1]``. The root is the last state."""

    weights: np.ndarray
    first: np.ndarray
    labels: np.ndarray
    targets: np.ndarray
    width: int

    def _arcs(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The arcs of some states, and the place in ``states`` that each belongs to."""
        n = self.first[states + 1] - self.first[states]
        row = np.repeat(np.arange(len(states)), n)
        return np.repeat(self.first[states], n) + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n), row

    def counted(self) -> Counted:
        """All sequences of a weight above 0, the shorter ones first."""
        states = np.array([len(self.weights) - 1])
        rows, found = np.zeros((1, self.width), dtype=np.uint64), []
        for depth in range(self.width + 1):
            held = self.weights[states] > 0
            found.append(Counted(rows[held], self.weights[states[held]]))
            if depth < self.width:
                arc, of = self._arcs(states)
                rows = rows[of]
                rows[:, depth] = self.labels[arc]
                states = self.targets[arc]
        return Counted.joined(found)


def build(counts: Counted) -> CountTransducer:
    """From sequences in sorted order, each once.

    Neighbours share the states of their common beginning. From the last labels on, states that
    are alike are made one.
    """
    m, width = counts.labels.shape
    sizes = counts.sizes
    changed = np.ones((m, width + 1), dtype=bool)
    changed[:, 0] = False
    if m:
        changed[1:, 1:] = np.logical_or.accumulate(counts.labels[1:] != counts.labels[:-1], axis=1)
    numbers = [np.zeros(m, dtype=np.int64)]  # of each row's state, by depth
    parents, labels, weights = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.zeros(1, dtype=np.int64)]
    weights[0][0] = counts.n[sizes == 0].sum()
    for depth in range(1, width + 1):
        new = changed[:, depth] & (sizes >= depth)
        number = np.cumsum(new) - 1
        parents.append(numbers[-1][new])
        labels.append(counts.labels[new, depth - 1])
        own = np.zeros(int(new.sum()), dtype=np.int64)
        ends = sizes == depth
        own[number[ends]] = counts.n[ends]
        weights.append(own)
        numbers.append(number)
    made, out = 0, []
    ids = np.empty(0, np.int64)  # final number of each state one level below
    for depth in range(width, -1, -1):
        n = len(weights[depth])
        below = depth < width
        row, label = (parents[depth + 1], labels[depth + 1]) if below else (np.empty(0, np.int64), np.empty(0, np.uint64))
        target = ids
        first = np.searchsorted(row, np.arange(n + 1))
        sign = mix(weights[depth].astype(np.uint64))
        np.add.at(sign, row, mix(mix(label) * _ODD + target.astype(np.uint64)))
        order = hash_order(sign)
        new = np.ones(n, dtype=bool)
        new[1:] = sign[order][1:] != sign[order][:-1]
        kept, place = order[new], np.empty(n, dtype=np.int64)
        place[order] = np.cumsum(new) - 1
        if not _alike(kept[place], weights[depth], first, label, target):
            kept = place = np.arange(n)
        count = (first[1:] - first[:-1])[kept]
        arc = np.repeat(first[kept], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        out.append((weights[depth][kept], count, label[arc], target[arc]))
        ids = made + place
        made += len(kept)
    own, count, label, target = (np.concatenate(side) for side in zip(*out))
    return CountTransducer(own, np.concatenate([[0], np.cumsum(count)]), label, target, width)


def _alike(to: np.ndarray, weights: np.ndarray, first: np.ndarray, label: np.ndarray, target: np.ndarray) -> bool:
    """Whether each state has the weight and the arcs of the state that would stand for it."""
    count = first[1:] - first[:-1]
    if (weights != weights[to]).any() or (count != count[to]).any():
        return False
    arc = np.arange(len(label))
    other = np.repeat(first[to] - first[:-1], count) + arc
    return bool((label == label[other]).all() and (target == target[other]).all())


def union(parts: list[CountTransducer], least: int = 0) -> CountTransducer:
    """Sums the weights of each sequence over ``parts``; those of less than ``least`` go."""
    total = Counted.joined([p.counted() for p in parts]).summed()
    return build(total[total.n >= least].sorted())


def composed(asked: CountTransducer, counts: CountTransducer) -> Counted:
    """The counts of the sequences that both hold, by walking both automata together."""
    a, c = np.array([len(asked.weights) - 1]), np.array([len(counts.weights) - 1])
    rows, found = np.zeros((1, asked.width), dtype=np.uint64), []
    for depth in range(asked.width + 1):
        held = (asked.weights[a] > 0) & (counts.weights[c] > 0)
        found.append(Counted(rows[held], counts.weights[c[held]]))
        if depth == asked.width:
            break
        arc_a, of_a = asked._arcs(a)
        arc_c, of_c = counts._arcs(c)
        # Arcs of one pair of states that have one label stand side by side.
        of, label = np.concatenate([of_a, of_c]), np.concatenate([asked.labels[arc_a], counts.labels[arc_c]])
        to, side = np.concatenate([asked.targets[arc_a], counts.targets[arc_c]]), np.repeat([0, 1], [len(of_a), len(of_c)])
        order = np.lexsort((side, label, of))
        both = order[:-1][(of[order][1:] == of[order][:-1]) & (label[order][1:] == label[order][:-1])]
        then = order[1:][(of[order][1:] == of[order][:-1]) & (label[order][1:] == label[order][:-1])]
        rows = rows[of[both]]
        rows[:, depth] = label[both]
        a, c = to[both], to[then]
    return Counted.joined(found)
