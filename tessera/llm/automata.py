"""Weighted acyclic automata over n-grams of one length, as flat arrays.

A ``CountAutomaton`` maps n-grams (tuples of words) to counts.  Its states lie on levels 0
(the root) to n - 1; an arc carries a word and leads to a state of the next level, on the
last level to a count.  States with the same arcs are one state.  Arcs of a state are
sorted by word, and words are numbered in byte order, so n-grams are listed in order.
"""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Each 64-bit number spread over all its bits."""
    h = h.astype(np.uint64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def row_keys(rows: np.ndarray, size: int) -> np.ndarray:
    """A number for each row of whole numbers below ``size``, in the rows' order; equal rows get equal ones."""
    key, span = rows[:, 0].astype(np.int64), size
    for column in rows.T[1:]:
        if span * size >= 2**62:
            distinct, key = np.unique(key, return_inverse=True)
            span = len(distinct)
        key, span = key * size + column, span * size
    return key


def summed(rows: np.ndarray, weights: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, and the sum of each one's weights."""
    if not len(rows):
        return rows, weights.astype(np.int64)
    key = row_keys(rows, size)
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.diff(key[order], prepend=key[order[0]] - 1))
    return rows[order[first]], np.add.reduceat(weights[order].astype(np.int64), first)


def _arcs_of(first: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all arcs of ``states``, in turn, and how many each has."""
    counts = first[states + 1] - first[states]
    upto = np.cumsum(counts)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(first[states] - (upto - counts), counts), counts


class Builder:
    """Builds an automaton from sorted n-grams, block by block.

    States under a first word that is complete are frozen: merged with an equal state that
    the level's register knows, or added to it.  The last first word's n-grams wait for
    the next block.
    """

    def __init__(self, n: int):
        self.n = n
        self.labels = [[] for _ in range(n)]  # of each level's arcs: blocks of arrays
        self.ends = [[] for _ in range(n)]  # what each arc leads to (a state, or a count)
        self.begins = [[] for _ in range(n)]  # where each state's arcs begin, in each block
        self.states = [0] * n
        self.known: list[dict[int, tuple]] = [{} for _ in range(n)]  # by hash: number, block, place in it
        self.waiting = (np.zeros((0, n), np.int64), np.zeros(0, np.int64))

    def add(self, rows: np.ndarray, counts: np.ndarray) -> None:
        """Distinct n-grams (word numbers), sorted and behind all earlier ones."""
        rows = np.concatenate([self.waiting[0], rows])
        counts = np.concatenate([self.waiting[1], counts])
        if len(rows):
            cut = int(np.searchsorted(rows[:, 0], rows[-1, 0]))
            self._freeze(rows[:cut], counts[:cut])
            self.waiting = rows[cut:], counts[cut:]

    def _freeze(self, rows: np.ndarray, ends: np.ndarray) -> None:
        for level in range(self.n - 1, 0, -1):  # states of this level, from the last
            if not len(rows):
                return
            starts = np.flatnonzero(np.r_[True, (rows[1:, :level] != rows[:-1, :level]).any(axis=1)])
            ends = self._merge(level, rows[:, level], ends, starts)
            rows = rows[starts, :level]
        self.labels[0].append(rows[:, 0])
        self.ends[0].append(ends)

    def _merge(self, level: int, labels: np.ndarray, ends: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """State numbers of the groups of arcs that begin at ``starts``; new states join the register."""
        sizes = np.diff(np.append(starts, len(labels)))
        place = (np.arange(len(labels)) - np.repeat(starts, sizes)).astype(np.uint64)
        arc = mixed(mixed(labels.astype(np.uint64) * _ODD + place) + ends.astype(np.uint64) * _ODD)
        marks = mixed(np.add.reduceat(arc, starts) + sizes.astype(np.uint64))
        distinct, sample, of = np.unique(marks, return_index=True, return_inverse=True)
        # equal marks should mean equal arcs; a group that differs from its sample stays a state of its own
        like = sample[of]
        same = sizes == sizes[like]
        left = np.repeat(same, sizes)
        shift = np.repeat(starts[like] - starts, sizes)[left] + np.flatnonzero(left)
        differs = (labels[left] != labels[shift]) | (ends[left] != ends[shift])
        same[np.repeat(np.arange(len(starts)), sizes)[left][differs]] = False
        known, numbers, fresh = self.known[level], np.empty(len(distinct), np.int64), []
        block = len(self.labels[level])
        for i, mark in enumerate(distinct.tolist()):
            g = int(sample[i])
            state = known.get(mark)
            if state is None or not self._is_state(level, state, labels[starts[g] : starts[g] + sizes[g]], ends[starts[g] :]):
                state = (self.states[level] + len(fresh), block, len(fresh))
                known.setdefault(mark, state)
                fresh.append(g)
            numbers[i] = state[0]
        out = numbers[of]
        odd = np.flatnonzero(~same)
        out[odd] = self.states[level] + len(fresh) + np.arange(len(odd))
        fresh = np.array([*fresh, *odd.tolist()], dtype=np.int64)
        self.states[level] += len(fresh)
        arcs, counts = _arcs_of(np.append(starts, len(labels)), fresh)
        self.labels[level].append(labels[arcs])
        self.ends[level].append(ends[arcs])
        self.begins[level].append(np.append(0, np.cumsum(counts)))
        return out

    def _is_state(self, level: int, state: tuple[int, int, int], labels: np.ndarray, ends: np.ndarray) -> bool:
        """Whether a state of an earlier block has these arcs."""
        _, block, i = state
        begin, end = self.begins[level][block][i : i + 2]
        if end - begin != len(labels):
            return False
        same_words = (self.labels[level][block][begin:end] == labels).all()
        return bool(same_words and (self.ends[level][block][begin:end] == ends[: len(labels)]).all())

    def finish(self, words: list[bytes]) -> CountAutomaton:
        self._freeze(*self.waiting)
        self.waiting = (np.zeros((0, self.n), np.int64), np.zeros(0, np.int64))
        joined = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        labels, ends = [joined(x) for x in self.labels], [joined(x) for x in self.ends]
        firsts = [np.array([0, len(labels[0])])]
        firsts += [np.append(0, np.cumsum(joined([np.diff(b) for b in x]))).astype(np.int64) for x in self.begins[1:]]
        return CountAutomaton(words, firsts, labels, ends)


class CountAutomaton:
    """``words`` in byte order; for each level the first arc of each state, the arcs' words and ends."""

    def __init__(self, words: list[bytes], firsts: list, labels: list, ends: list):
        self.words, self.firsts, self.labels, self.ends = words, firsts, labels, ends
        self.n = len(labels)

    @classmethod
    def build(cls, words: list[bytes], rows: np.ndarray, counts: np.ndarray, block: int = 1 << 16) -> CountAutomaton:
        """From distinct sorted n-grams (word numbers); words that none of them has are left out."""
        used, numbers = np.unique(rows, return_inverse=True)
        numbers = numbers.reshape(rows.shape)
        builder = Builder(rows.shape[1])
        for i in range(0, len(rows), block):
            builder.add(numbers[i : i + block], counts[i : i + block])
        return builder.finish([words[i] for i in used.tolist()])

    def listed(self) -> tuple[np.ndarray, np.ndarray]:
        """All n-grams (word numbers), in order, and their counts."""
        states, columns = np.zeros(1, np.int64), []
        for first, labels, ends in zip(self.firsts, self.labels, self.ends):
            arcs, counts = _arcs_of(first, states)
            columns = [np.repeat(c, counts) for c in columns] + [labels[arcs].astype(np.int64)]
            states = ends[arcs].astype(np.int64)
        return np.stack(columns, axis=1), states

    def grams(self, rows: np.ndarray) -> list[tuple[bytes, ...]]:
        return [tuple(self.words[i] for i in row) for row in rows.tolist()]

    def composed(self, words: list[bytes], rows: np.ndarray) -> np.ndarray:
        """Counts of the n-grams ``rows`` (numbers of ``words``); 0 for those it doesn't hold.

        The n-grams are followed arc by arc, all of them a level at a time.
        """
        number = {w: i for i, w in enumerate(self.words)}
        own = np.array([number.get(w, -1) for w in words], dtype=np.int64)[rows]
        states, alive = np.zeros(len(rows), np.int64), (own >= 0).all(axis=1)
        for column, first, labels, ends in zip(own.T, self.firsts, self.labels, self.ends):
            owners = np.repeat(np.arange(len(first) - 1), np.diff(first))
            keys = owners * (len(self.words) + 1) + labels.astype(np.int64)
            wanted = states * (len(self.words) + 1) + column
            at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
            alive &= (keys[at] == wanted) if len(keys) else False
            states = np.where(alive, ends[at].astype(np.int64) if len(ends) else 0, 0)
        return np.where(alive, states, 0)

    def cut(self, places: list[int]) -> list[CountAutomaton]:
        """Automata of the n-grams before, between and behind ``places`` in the list.

        They may be many and small, and are soon united: each is a tree, its equal states are not merged.
        """
        rows, counts = self.listed()
        n_rows = len(rows)
        # where the n-grams that share their first words begin, for one such word, two, ...
        begins, fresh = [], np.arange(n_rows) == 0
        for column in rows.T[:-1]:
            fresh[1:] |= column[1:] != column[:-1]
            begins.append(np.flatnonzero(fresh))
        ends = [0, *places, n_rows]
        return [self._slice(rows, counts, begins, a, b) for a, b in zip(ends, ends[1:])]

    def _slice(self, rows: np.ndarray, counts: np.ndarray, begins: list[np.ndarray], a: int, b: int) -> CountAutomaton:
        """The tree of the n-grams from ``a`` to ``b``: a state for each of their beginnings."""
        used, numbers = np.unique(rows[a:b], return_inverse=True)
        numbers = numbers.reshape(-1, self.n)
        states = []
        for begin in begins:
            inner = begin[np.searchsorted(begin, a, "right") : np.searchsorted(begin, b)]
            states.append(np.append(0, inner - a) if b > a else np.zeros(0, np.int64))
        arcs = [*states, np.arange(b - a)]
        firsts = [np.array([0, len(arcs[0])])]
        firsts += [np.append(np.searchsorted(arcs[i + 1], own), len(arcs[i + 1])) for i, own in enumerate(states)]
        labels = [numbers[at, i] for i, at in enumerate(arcs)]
        return CountAutomaton([self.words[i] for i in used.tolist()], firsts, labels, [*(np.arange(len(x)) for x in states), counts[a:b]])

    def at_least(self, count: int) -> CountAutomaton:
        rows, counts = self.listed()
        kept = counts >= count
        return self.build(self.words, rows[kept], counts[kept])

    @classmethod
    def union(cls, automata: list[CountAutomaton], least: int = 0) -> CountAutomaton:
        """All n-grams of some automata, equal ones with the sum of their counts (those of ``least`` or more)."""
        words = sorted(set().union(*[a.words for a in automata]))
        number = dict(zip(words, range(len(words))))
        rows, counts = [], []
        for a in automata:
            own, c = a.listed()
            rows.append(np.fromiter(map(number.__getitem__, a.words), np.int64, len(a.words))[own])
            counts.append(c)
        rows, counts = summed(np.concatenate(rows), np.concatenate(counts), len(words) + 1)
        kept = counts >= least
        return cls.build(words, rows[kept], counts[kept])

    def to_bytes(self) -> bytes:
        """Words hold no line feed, so they are joined by it.  Widths and lengths of all parts come first."""
        least = lambda x: x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))
        text, parts = b"\n".join(self.words), [least(x) for x in (*self.firsts, *self.labels, *self.ends)]
        head = [self.n, len(self.words), len(text), *(v for x in parts for v in (x.itemsize, len(x)))]
        return b"".join([np.array(head, dtype=np.int64).tobytes(), text, *(x.tobytes() for x in parts)])

    @classmethod
    def from_bytes(cls, data: bytes) -> CountAutomaton:
        n, n_words, n_text = np.frombuffer(data, np.int64, 3).tolist()
        sizes = np.frombuffer(data, np.int64, 6 * n, 24).reshape(-1, 2).tolist()
        at = 24 + 48 * n + n_text
        text, parts = data[at - n_text : at], []
        for width, length in sizes:
            parts.append(np.frombuffer(data[at : at + width * length], f"u{width}"))
            at += width * length
        firsts = [x.astype(np.int64) for x in parts[:n]]
        return cls(text.split(b"\n") if n_words else [], firsts, parts[n : 2 * n], parts[2 * n :])
