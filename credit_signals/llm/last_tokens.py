"""Last token of every prefix, for many short texts at once.

A helper of the tokenizers: all tokens that match anywhere in a batch of units
are found by walking a trie over the whole batch, and then, end by end, the one
match whose predecessor lets it follow becomes the last token of that prefix.
All units of a batch advance together, so the work per unit is array work.
"""

from collections.abc import Callable

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)


class Lookup:
    """A fixed map of non-negative int64 keys to int32 values; -1 for an absent key."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(4 * len(keys) + 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int32)
        keys, values = np.asarray(keys, np.int64), np.asarray(values, np.int32)
        slot = self._slot(keys)
        while keys.size:                          # the first key of each free slot settles, the others move on
            at, who = np.unique(slot, return_index=True)
            self.keys[at], self.values[at] = keys[who], values[who]
            left = np.ones(keys.size, bool)
            left[who] = False
            keys, values = keys[left], values[left]
            slot = self._free(slot[left])

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> self.shift).astype(np.int64)

    def _free(self, slot: np.ndarray) -> np.ndarray:
        """The first slots from ``slot`` on that are free."""
        taken = self.keys[slot] != -1
        while taken.any():
            slot[taken] = (slot[taken] + 1) & self.mask
            taken = self.keys[slot] != -1
        return slot

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        out = self.values[slot]
        seen = self.keys[slot]
        other = np.flatnonzero((seen != keys) & (seen != -1))
        out[seen == -1] = -1
        while other.size:
            slot[other] = (slot[other] + 1) & self.mask
            seen = self.keys[slot[other]]
            out[other] = np.where(seen == keys[other], self.values[slot[other]], -1)
            other = other[(seen != keys[other]) & (seen != -1)]
        return out


class Memo:
    """Answers of a yes/no question about (left, right) pairs, kept in a table of fixed size."""

    def __init__(self, ask: Callable[[np.ndarray, np.ndarray], np.ndarray], bits: int = 20):
        self.ask, self.shift = ask, np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.yes = np.zeros(1 << bits, bool)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right
        slot = ((keys.astype(np.uint64) * _MIX) >> self.shift).astype(np.int64)
        out = self.yes[slot]
        new = np.flatnonzero(self.keys[slot] != keys)
        if new.size:
            distinct, back = np.unique(keys[new], return_inverse=True)
            found = self.ask(distinct >> 32, distinct & 0xFFFFFFFF)
            out[new] = found[back]
            at = ((distinct.astype(np.uint64) * _MIX) >> self.shift).astype(np.int64)
            self.keys[at], self.yes[at] = distinct, found
            # two keys with one slot: the later write holds both arrays, so keys and answers agree
            self.yes[at] = found[_last_write(at)]
        return out


def _last_write(at: np.ndarray) -> np.ndarray:
    """For each entry the index of the last entry with the same value."""
    _, back = np.unique(at, return_inverse=True)
    last = np.empty(back.max() + 1, np.int64)
    last[back] = np.arange(at.size)
    return last[back]


class LastTokens:
    """Segments units into the tokens that ``fits`` allows one after the other.

    ``tokens`` are (bytes, id) with every single byte or character that may occur
    among them, ``fits(left ids, right ids)`` tells whether right may follow left
    and ``starts(ids)`` whether a token may begin a unit.  For every prefix
    exactly one chain of tokens must fit.
    """

    def __init__(self, tokens: list[tuple[bytes, int]], fits, starts=None):
        self.fits, self.starts = fits, starts
        nodes: dict[tuple[int, int], int] = {}
        token_at = [-1]
        for text, i in tokens:
            node = 0
            for b in text:
                key = (node, b)
                node = nodes.get(key, -1)
                if node < 0:
                    node = nodes[key] = len(token_at)
                    token_at.append(-1)
            token_at[node] = i
        self.token_at = np.array(token_at, np.int32)
        self.child = Lookup(np.array([(n << 8) | b for n, b in nodes], np.int64),
                            np.fromiter(nodes.values(), np.int32, len(nodes)))
        self.size = np.zeros(max(i for _, i in tokens) + 1, np.int64)
        for text, i in tokens:
            self.size[i] = len(text)

    def matches(self, data: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, token) of every token that occurs; ``stop`` is the end of each byte's unit."""
        at = np.arange(data.size)
        node = np.zeros(data.size, np.int64)
        found, size = [], 0
        while at.size:
            node = self.child((node << 8) | data[at + size]).astype(np.int64)
            size += 1
            on = node >= 0
            at, node = at[on], node[on]
            token = self.token_at[node]
            hit = token >= 0
            found.append((at[hit], at[hit] + size, token[hit]))
            more = at + size < stop[at]
            at, node = at[more], node[more]
        return tuple(np.concatenate(x) for x in zip(*found))

    def split(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(token ids of all units in a row, where each unit ends in it); no unit is empty."""
        data = np.frombuffer(b"".join(units), np.uint8)
        length = np.fromiter(map(len, units), np.int64, len(units))
        end = np.cumsum(length)
        begin = end - length
        start, stop, token = self.matches(data, np.repeat(end, length))
        first = np.repeat(begin, length)[start]
        order = np.argsort(stop - first, kind="stable")
        start, stop, token, first = start[order], stop[order], token[order], first[order]
        steps = np.searchsorted(stop - first, np.arange(1, int(length.max()) + 2))
        last = np.full(data.size, -1, np.int32)
        for a, b in zip(steps[:-1], steps[1:]):                 # all units advance one byte
            if a == b:
                continue
            s, t = start[a:b], token[a:b]
            head = s == first[a:b]
            before = last[np.maximum(s - 1, 0)]
            ok = head & self.starts(t) if self.starts else head.copy()
            ask = np.flatnonzero(~head & (before >= 0))
            ok[ask] = self.fits(before[ask], t[ask])
            last[stop[a:b][ok] - 1] = t[ok]
        unit, at, ids = np.arange(len(units)), end.copy(), []
        while unit.size:                                        # backwards, all units together
            t = last[at - 1]
            ids.append((unit, t))
            at = at - self.size[t]
            on = at > begin[unit]
            unit, at = unit[on], at[on]
        unit = np.concatenate([u for u, _ in ids][::-1])
        token = np.concatenate([t for _, t in ids][::-1])
        return token[np.argsort(unit, kind="stable")], np.cumsum(np.bincount(unit, minlength=len(units)))
