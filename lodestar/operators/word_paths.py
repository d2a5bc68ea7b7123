"""Cheapest paths of many runs of characters through a dictionary, in numpy.

The words are a trie whose steps are one hash table.  All places of all runs walk
down it together, a character at a time, as long as the characters are the beginning
of a word.  Where no word crosses, a run falls apart; the parts of all runs are then
walked place by place together, each word moving the cost of its beginning to its
end.  The work grows with the characters and the words found at them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)
_FAR = np.int64(1 << 62)
_NONE = np.empty(0, np.int64)


def code_points(texts: Sequence[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


class Steps:
    """Exact look-up of whole numbers >= 0 that have a number from 0 on each."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.number = np.zeros(1 << bits, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] < 0
            # of those that want a free slot one gets it
            self.number[slot[free]] = left[free]
            own = free.copy()
            own[free] = self.number[slot[free]] == left[free]
            self.keys[slot[own]] = keys[left[own]]
            left, slot = left[~own], (slot[~own] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for one that is not there."""
        slot = self._slot(keys)
        held = self.keys[slot]
        hit = held == keys
        out = np.where(hit, self.number[slot], -1)
        left = np.flatnonzero(~hit & (held >= 0))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & self.mask
            held = self.keys[slot]
            hit = held == keys[left]
            out[left[hit]] = self.number[slot[hit]]
            on = ~hit & (held >= 0)
            left, slot = left[on], slot[on]
        return out


class Words:
    """Dictionary words and their costs, for :meth:`cheapest`."""

    def __init__(self, words: Sequence[str], costs: Sequence[int], unknown: int):
        self.unknown = unknown
        lengths = np.array([len(w) for w in words], np.int64)
        codes = code_points(words)
        self.alphabet = np.full(int(codes.max(initial=0)) + 2, -1, np.int32)
        letters = np.unique(codes)
        self.alphabet[letters] = np.arange(len(letters))
        self.letters = max(1, len(letters))
        letter = self.alphabet[codes].astype(np.int64)
        first = np.cumsum(lengths) - lengths
        # the states of one depth after those of the depth before; 0 is the beginning
        state, on = np.zeros(len(words), np.int64), np.arange(len(words))
        keys, ends, states = [], [], 1
        for depth in range(int(lengths.max(initial=0))):
            on = on[lengths[on] > depth]
            key, which = np.unique(state[on] * self.letters + letter[first[on] + depth],
                                   return_inverse=True)
            state[on] = states + which
            states += len(key)
            keys.append(key)
        self.steps = Steps(np.concatenate([*keys, _NONE]))
        self.word = np.full(states, -1, np.int32)
        self.word[state[lengths > 0]] = np.flatnonzero(lengths > 0)
        self.cost = np.asarray(costs, np.int64)

    def _found(self, letter: np.ndarray, stop: np.ndarray):
        """``(place, word)`` of the words of each length found, from length 1 on."""
        at = np.flatnonzero(letter >= 0)
        state = np.zeros(len(at), np.int64)
        depth = 0
        while len(at):
            state = self.steps.find(state * self.letters + letter[at + depth])
            on = state >= 0
            at, state = at[on], state[on].astype(np.int64) + 1
            word = self.word[state]
            ends = word >= 0
            yield at[ends], word[ends]
            depth += 1
            on = at + depth < stop[at]
            at, state = at[on], state[on]
            on = letter[at + depth] >= 0
            at, state = at[on], state[on]

    def cheapest(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(place in codes, word number)`` of the words of more than one character on
        the cheapest way through each run, in order; the longer last word wins a tie.

        ``codes`` are the runs' code points, back to back.
        """
        n = len(codes)
        letter = self.alphabet[np.minimum(codes, len(self.alphabet) - 1)].astype(np.int64)
        run_stop = np.repeat(np.cumsum(lengths), lengths)
        single = np.full(n, self.unknown, np.int64)
        found, crossed = [], np.zeros(n + 1, np.int32)
        for size, (at, word) in enumerate(self._found(letter, run_stop), 1):
            if size == 1:
                single[at] = np.minimum(self.unknown, self.cost[word])
                continue
            if len(at):
                found.append((size, at, word))
                crossed[at + 1] += 1        # a place has one word of a length at most
                crossed[at + size] -= 1
        begins = np.cumsum(crossed)[:n] == 0
        start = np.flatnonzero(begins)
        part = np.cumsum(begins) - 1
        size = np.diff(start, append=n)
        # a part of n characters has n + 1 cells, one for each place between them
        cell, inside = np.arange(n) + part, np.arange(n) - start[part]
        deep = int(size.max(initial=0))
        several = np.flatnonzero(size[part] > 1)
        found.insert(0, (1, several, np.full(len(several), -1, np.int32)))
        place, word = (np.concatenate([f[i] for f in found]) for i in (1, 2))
        length = np.repeat([f[0] for f in found], [len(f[1]) for f in found])
        depth = inside[place]
        if deep < 1 << 16:
            depth = depth.astype(np.uint16)         # sorted by counting
        order = np.argsort(depth, kind="stable")
        place, word, length = place[order], word[order], length[order]
        ends = np.cumsum(np.bincount(depth, minlength=deep)).tolist()
        cost = np.where(word < 0, single[place], self.cost.take(word, mode="clip")
                        if len(self.cost) else 0)
        from_ = cell[place]
        to = from_ + length
        best = np.full(n + len(start), _FAR)
        best[cell[start]] = 0
        back = np.zeros(n + len(start), np.int64)       # the way that reaches a cell
        a = 0
        for b in ends:
            # ways from one place of a part end at different ones, so each has its own cell
            arrive = best[from_[a:b]] + cost[a:b]
            at = to[a:b]
            less = np.flatnonzero(arrive < best[at])
            at = at[less]
            best[at] = arrive[less]
            back[at] = less + a
            a = b
        out = [_NONE]
        wide = size > 1
        low = cell[start[wide]]
        at = low + size[wide]
        while len(at):
            way = back[at]
            out.append(way[word[way] >= 0])
            at = at - length[way]
            on = at > low
            at, low = at[on], low[on]
        way = np.concatenate(out)
        order = np.argsort(place[way], kind="stable")
        return place[way][order], word[way][order]
