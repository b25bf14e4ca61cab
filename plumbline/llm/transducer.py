"""Weighted acyclic automata over words: a path spells an n-gram, and the weights along it sum up to the n-gram's count.

Weights are pushed towards the root (an arc carries what the least count below it exceeds that of its source), so equal
remainders share one state. States are minimised against a register as sorted n-grams arrive, block by block.
"""

from __future__ import annotations

import struct

import numpy as np

#: n-grams that are minimised at a time.
BLOCK = 200_000
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * _A
        return (x ^ (x >> np.uint64(29))) * _B


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (size[0] of them), first[1], ..."""
    return np.repeat(first - np.cumsum(np.r_[0, size[:-1]]), size) + np.arange(int(size.sum()))


def order_of(grams: np.ndarray) -> np.ndarray:
    """Order of the rows of labels, shorter ones (padded with -1) first."""
    return np.lexsort(grams.T[::-1])


def summed(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in order, equal ones once with the sum of their counts."""
    if not len(grams):
        return grams, counts
    by = order_of(grams)
    grams, counts = grams[by], counts[by]
    new = np.flatnonzero(np.r_[True, (grams[1:] != grams[:-1]).any(axis=1)])
    return grams[new], np.add.reduceat(counts, new)


class Transducer:
    """vocab: labels in byte order. State s has the arcs first[s] : first[s + 1], by label; final[s] is -1 where no n-gram ends."""

    def __init__(self, vocab: list[bytes], first, label, target, weight, final, root: int, base: int):
        self.vocab, self.first, self.label, self.target, self.weight, self.final, self.root, self.base = vocab, first, label, target, weight, final, root, base

    @property
    def states(self) -> int:
        return len(self.final)

    def to_bytes(self) -> bytes:
        arrays = [np.ascontiguousarray(a, np.min_scalar_type(int(a.max()) if len(a) else 0)) for a in (self.first, self.label, self.target, self.weight, self.final + 1)]
        words = b"\n".join(self.vocab)
        head = struct.pack("<qqqq", self.root, self.base, len(self.vocab), len(words)) + b"".join(struct.pack("<qB", len(a), a.itemsize) for a in arrays)
        return b"".join([head, *(a.tobytes() for a in arrays), words])

    @classmethod
    def from_bytes(cls, raw: bytes) -> Transducer:
        root, base, n_words, size = struct.unpack_from("<qqqq", raw)
        shapes = [struct.unpack_from("<qB", raw, 32 + 9 * i) for i in range(5)]
        at, arrays = 32 + 45, []
        for n, width in shapes:
            arrays.append(np.frombuffer(raw, f"<u{width}", n, at).astype(np.int64))
            at += n * width
        arrays[4] = arrays[4] - 1
        return cls(raw[at : at + size].split(b"\n") if n_words else [], *arrays, root, base)

    def grams(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """All (labels padded with -1 to width, count), level by level."""
        state, paths, sums, out, counts = np.array([self.root]), np.full((1, width), -1, np.int32), np.array([self.base]), [], []
        depth = 0
        while len(state):
            ends = self.final[state] >= 0
            out.append(paths[ends])
            counts.append(sums[ends] + self.final[state[ends]])
            size = self.first[state + 1] - self.first[state]
            arcs, came = _ranges(self.first[state], size), np.repeat(np.arange(len(state)), size)
            paths, sums, state = paths[came], sums[came] + self.weight[arcs], self.target[arcs]
            if len(state):
                paths[:, depth] = self.label[arcs]
            depth += 1
        return np.concatenate(out), np.concatenate(counts)

    def compose(self, asked: Transducer, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(labels of `asked`, count here) of the n-grams that both accept, walking both automata together."""
        place = {w: i for i, w in enumerate(self.vocab)}
        own = np.array([place.get(w, -1) for w in asked.vocab], np.int64)
        n = len(self.vocab)
        key = np.repeat(np.arange(self.states), np.diff(self.first)) * n + self.label  # rises with the arcs
        mine, theirs = np.array([self.root]), np.array([asked.root])
        paths, sums, out, counts, depth = np.full((1, width), -1, np.int32), np.array([self.base]), [], [], 0
        while len(mine):
            ends = (self.final[mine] >= 0) & (asked.final[theirs] >= 0)
            out.append(paths[ends])
            counts.append(sums[ends] + self.final[mine[ends]])
            size = asked.first[theirs + 1] - asked.first[theirs]
            arcs, came = _ranges(asked.first[theirs], size), np.repeat(np.arange(len(theirs)), size)
            label = own[asked.label[arcs]]
            want = mine[came] * n + label
            at = np.minimum(np.searchsorted(key, want), max(0, len(key) - 1))
            hit = (label >= 0) & (key[at] == want) if len(key) else np.zeros(len(want), bool)
            arcs, came, at = arcs[hit], came[hit], at[hit]
            paths, sums, mine, theirs = paths[came], sums[came] + self.weight[at], self.target[at], asked.target[arcs]
            if len(mine):
                paths[:, depth] = asked.label[arcs]
            depth += 1
        return np.concatenate(out), np.concatenate(counts)


class Builder:
    """Takes sorted, distinct n-grams in blocks that never part n-grams of one first label; done() gives the automaton."""

    def __init__(self, vocab: list[bytes]):
        self.vocab, self.register = vocab, {}
        self.first, self.label, self.target, self.weight, self.final, self.size = [0], [], [], [], [], 0
        self.top: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def _frozen(self, degree, label, target, weight, final) -> np.ndarray:
        """Ids of states that are given by their arcs one after another: known ones from the register, others new."""
        begin = np.cumsum(np.r_[0, degree[:-1]])
        with np.errstate(over="ignore"):
            arc = _mix(_mix(_mix(label.astype(np.uint64)) + target.astype(np.uint64)) + weight.astype(np.uint64))
            sums = np.r_[np.uint64(0), np.cumsum(arc, dtype=np.uint64)]
            h = _mix(sums[begin + degree] - sums[begin] + _mix(final.astype(np.uint64)) + degree.astype(np.uint64))
        _, rep, inverse = np.unique(h, return_index=True, return_inverse=True)
        like = rep[inverse]
        same = (degree == degree[like]) & (final == final[like])
        probe = np.flatnonzero(same & (degree > 0) & (like != np.arange(len(like))))
        own, other = _ranges(begin[probe], degree[probe]), _ranges(begin[like[probe]], degree[probe])
        differs = (label[own] != label[other]) | (target[own] != target[other]) | (weight[own] != weight[other])
        same[np.repeat(probe, degree[probe])[differs]] = False
        like = np.where(same, like, np.arange(len(like)))  # hashes that agree by chance stand for themselves
        ids = np.full(len(degree), -1, np.int64)
        for s in np.unique(like).tolist():
            a, b = begin[s], begin[s] + degree[s]
            name = (int(final[s]), label[a:b].tobytes(), target[a:b].tobytes(), weight[a:b].tobytes())
            at = self.register.get(name)
            if at is None:
                at = self.register[name] = self.size
                self.size += 1
                self.first.append(self.first[-1] + int(degree[s]))
                self.label.append(label[a:b])
                self.target.append(target[a:b])
                self.weight.append(weight[a:b])
                self.final.append(int(final[s]))
            ids[s] = at
        return ids[like]

    def add(self, grams: np.ndarray, counts: np.ndarray) -> None:
        if not len(grams):
            return
        width = int((grams >= 0).sum(axis=1).max())
        changed = np.zeros(len(grams), bool)
        changed[0] = True
        levels = []  # of each depth: rows where a node begins, the parent of each node, its own count or -1
        above = np.zeros(len(grams), np.int64)
        for d in range(width):
            changed[1:] |= grams[1:, d] != grams[:-1, d]
            rows = np.flatnonzero(changed & (grams[:, d] >= 0))
            node = np.cumsum(changed & (grams[:, d] >= 0)) - 1
            ends = grams[rows, d + 1] < 0 if d + 1 < grams.shape[1] else np.ones(len(rows), bool)
            levels.append((grams[rows, d].astype(np.int64), above[rows], np.where(ends, counts[rows], -1)))
            above = node
        ids, least = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for d in range(width - 1, -1, -1):
            label, _, own = levels[d]
            n, limit = len(label), np.iinfo(np.int64).max
            low = np.where(own >= 0, own, limit)
            if d + 1 < width:
                child_label, parent, _ = levels[d + 1]
                np.minimum.at(low, parent, least)
                degree = np.bincount(parent, minlength=n)
                ids = self._frozen(degree, child_label, ids, least - low[parent], np.where(own >= 0, own - low, -1))
            else:
                ids = self._frozen(np.zeros(n, np.int64), *(np.zeros(0, np.int64),) * 3, own - low)
            least = low
        self.top.append((levels[0][0], ids, least))

    def done(self) -> Transducer:
        label, target, least = (np.concatenate([t[i] for t in self.top]) if self.top else np.zeros(0, np.int64) for i in range(3))
        base = int(least.min()) if len(least) else 0
        flat = lambda parts, last: np.concatenate([*parts, last]) if parts else last
        first = np.array([*self.first, self.first[-1] + len(label)], np.int64)
        return Transducer(self.vocab, first, flat(self.label, label), flat(self.target, target), flat(self.weight, least - base), np.array([*self.final, -1], np.int64), self.size, base)


def built(vocab: list[bytes], grams: np.ndarray, counts: np.ndarray) -> Transducer:
    """The automaton of sorted, distinct n-grams over the labels that they use."""
    used = np.zeros(len(vocab), bool)
    used[grams[grams >= 0]] = True
    rank = np.r_[np.cumsum(used) - 1, -1]  # label -1 stays
    grams = rank[grams]
    build, lo = Builder([vocab[i] for i in np.flatnonzero(used).tolist()]), 0
    while lo < len(grams):
        hi = min(len(grams), lo + BLOCK)
        hi = int(np.searchsorted(grams[:, 0], grams[hi - 1, 0], side="right"))
        build.add(grams[lo:hi], counts[lo:hi])
        lo = hi
    return build.done()


class Union:
    """The sum of automata, folded in one at a time; at most `hold` n-grams wait to be summed."""

    def __init__(self, width: int, hold: int = 2_000_000):
        self.width, self.hold, self.place, self.parts, self.size = width, hold, {}, [], 0

    def add(self, t: Transducer) -> None:
        place = self.place
        own = np.array([place.setdefault(w, len(place)) for w in t.vocab] + [-1], np.int32)
        grams, counts = t.grams(self.width)
        self.parts.append((own[grams], counts))
        self.size += len(grams)
        if self.size > self.hold:
            self._sum()
            self.hold = max(self.hold, 2 * self.size)

    def _sum(self) -> None:
        grams = np.concatenate([g for g, _ in self.parts]) if self.parts else np.zeros((0, self.width), np.int32)
        counts = np.concatenate([c for _, c in self.parts]) if self.parts else np.zeros(0, np.int64)
        self.parts = [summed(grams, counts)]
        self.size = len(self.parts[0][0])

    def done(self, least: int = 0) -> Transducer:
        """Of the n-grams with a count of `least` or more."""
        self._sum()
        grams, counts = self.parts[0]
        grams, counts = grams[counts >= least], counts[counts >= least]
        words = list(self.place)
        order = sorted(range(len(words)), key=words.__getitem__)
        rank = np.empty(len(words) + 1, np.int64)
        rank[order], rank[-1] = np.arange(len(words)), -1
        grams = rank[grams]
        by = order_of(grams)
        return built([words[i] for i in order], grams[by], counts[by])
