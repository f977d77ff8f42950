"""Run-length index: a run-compressed Burrows-Wheeler transform of many short strings with sampled run ends.

Used inside tasks on one bounded bucket of strings. ``build`` sorts the suffixes, keeps the runs of the transform, the
text position of the first and last row of each run, and for every group of suffixes that share their first ``match``
symbols the least owner of a string in it. ``stream`` reads all strings from right to left at once and keeps, for each,
the longest match with the index (its matching statistics): a step stays in the run or jumps to the nearer run of the
wanted symbol, whichever shares more.
"""

from __future__ import annotations

import numpy as np

from plumbline.llm import textarrays as ta


def _ranked(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in the order of their keys, equal ones by place; rank of each place, equal for equal keys)."""
    n = len(key)
    low = max(n - 1, 1).bit_length()
    if bits + low <= 63:  # a place fits beside its key, and sorting values is much faster than sorting places
        both = np.sort(key << low | np.arange(n))
        order, key = both & ((1 << low) - 1), both >> low
    else:
        order = np.argsort(key, kind="stable")
        key = key[order]
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(np.append(False, key[1:] != key[:-1])[:n])
    return order, rank


class RunIndex:
    """``text``: symbols 1..256 with a 0 after each string; ``owner``: ascending owner of each string."""

    def __init__(self, text: np.ndarray, owner: np.ndarray, longest: int, match: int):
        self.text, self.match = text, match
        n = len(text)
        string = np.cumsum(text == 0) - (text == 0)
        left = np.flatnonzero(text == 0)[string] - np.arange(n)  # symbols before the string's end
        order, rank = self._sorted(text, string, left, longest)
        before = np.concatenate([text[-1:], text[:-1]])[order]
        head = np.ones(n, bool)
        head[1:] = before[1:] != before[:-1]
        self.heads = np.flatnonzero(head)
        self.symbol = before[self.heads]
        size = np.diff(np.append(self.heads, n))
        self.first, self.last = order[self.heads], order[self.heads + size - 1]  # the sampled run ends
        self.tails = self.heads + size - 1
        self.start = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=257))])  # rows before each symbol
        runs = np.argsort(self.symbol, kind="stable")
        done = np.cumsum(size[runs]) - size[runs]
        symbols, at = np.unique(self.symbol[runs], return_index=True)
        base = np.zeros(258, np.int64)
        base[symbols] = done[at]
        self.step = np.empty(len(runs), np.int64)  # where a run's first row goes
        self.step[runs] = self.start[self.symbol[runs]] + done - base[self.symbol[runs]]
        self.by_symbol = self.symbol[runs].astype(np.int64) * (len(runs) + 1) + runs
        self.runs = runs
        self.row_of = order[np.minimum(self.start[:257], n - 1)]
        # suffixes that share ``match`` symbols within their strings are neighbours
        deep = rank
        same = np.zeros(n, bool)
        same[1:] = (deep[order[1:]] == deep[order[:-1]]) & (left[order[1:]] >= match)
        groups = np.flatnonzero(~same)
        # by row: its run, and the least owner of its group
        self.run_of = np.repeat(np.arange(len(size)), size)
        self.least = np.repeat(np.minimum.reduceat(owner[string[order]], groups), np.diff(np.append(groups, n)))
        up, self.down = ta.powers(n + 1)
        self.acc = np.zeros(n + 1, ta.U64)
        np.cumsum((text.astype(ta.U64) + ta.U64(1)) * up[:n], out=self.acc[1:])

    def _sorted(self, text, string, left, longest):
        """(suffixes in order, a rank equal for suffixes with the same first ``match`` symbols), by doubling."""
        n, width = len(text), min(4, self.match)
        pad = np.concatenate([text, np.zeros(width, text.dtype)]).astype(np.int64)
        key = np.zeros(n, np.int64)
        for k in range(width):  # nothing beyond the string's end counts
            key = key * 257 + np.where(left > k, pad[k : n + k], 0)
        order, rank = _ranked(key, 36)
        shallow = rank if width == self.match else None
        while width < longest + 1:
            nxt = min(width * 2, longest + 1)
            if width < self.match <= nxt and shallow is None:
                shallow = self._join(rank, self.match - width, left)[1]
            order, rank = self._join(rank, nxt - width, left)
            width = nxt
        return order, rank if shallow is None else shallow

    @staticmethod
    def _join(rank: np.ndarray, ahead: int, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        after = np.zeros(len(rank), np.int64)
        after[: len(rank) - ahead] = rank[ahead:] + 1
        after[left < ahead] = 0
        most = int(rank.max(initial=0)) + 2
        return _ranked(rank * most + after, 2 * most.bit_length())

    def _shared(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Symbols that the texts at a and b share, at most ``most``; by bisection over span hashes."""
        n = len(self.text)
        most = np.minimum(most, np.minimum(n - a, n - b))
        low = np.zeros(len(a), np.int64)
        high = most.copy()
        while (low < high).any():
            mid = (low + high + 1) >> 1
            equal = (self.acc[a + mid] - self.acc[a]) * self.down[a] == (self.acc[b + mid] - self.acc[b]) * self.down[b]
            low, high = np.where(equal, mid, low), np.where(equal, high, mid - 1)
        return low

    def stream(self, begin: np.ndarray, length: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(string, offset) of every place whose next ``match`` symbols also occur in a string of a lesser owner."""
        m = len(begin)
        row, size, pos = np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m, np.int64)
        found_s, found_t = [], []
        many = len(self.heads)
        for t in range(1, int(length.max(initial=0)) + 1):
            act = np.flatnonzero(length >= t)
            c = self.text[begin[act] + length[act] - t].astype(np.int64)
            fresh = size[act] == 0
            run = self.run_of[row[act]]
            stay = (self.symbol[run] == c) & ~fresh
            jump = np.flatnonzero(~stay & ~fresh)
            if len(jump):
                key = c[jump] * (many + 1) + run[jump]
                i = np.searchsorted(self.by_symbol, key)
                nxt, prv = self.runs[np.minimum(i, many - 1)], self.runs[np.maximum(i - 1, 0)]
                ok_n = (i < many) & (self.symbol[nxt] == c[jump])
                ok_p = (i > 0) & (self.symbol[prv] == c[jump])
                own, most = pos[act[jump]], size[act[jump]]
                by_n = np.where(ok_n, self._shared(own, self.first[nxt], most), -1)
                by_p = np.where(ok_p, self._shared(own, self.last[prv], most), -1)
                up = by_n >= by_p
                best = np.maximum(by_n, by_p)
                fresh[jump[best <= 0]] = True
                a = act[jump]
                run[jump] = np.where(up, nxt, prv)
                row[a] = np.where(up, self.heads[nxt], self.tails[prv])
                pos[a] = np.where(up, self.first[nxt], self.last[prv])
                size[a] = np.maximum(best, 0)
            old = np.flatnonzero(~fresh)
            a = act[old]
            row[a] = self.step[run[old]] + row[a] - self.heads[run[old]]
            pos[a] -= 1
            size[a] += 1
            new = np.flatnonzero(fresh)
            a = act[new]
            row[a], pos[a], size[a] = self.start[c[new]], self.row_of[c[new]], 1
            long = act[size[act] >= self.match]
            if len(long):
                hit = long[self.least[row[long]] < owner[long]]
                found_s.append(hit)
                found_t.append(length[hit] - t)
        return (np.concatenate(found_s), np.concatenate(found_t)) if found_s else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def repeated_places(strings: list[bytes], owner: np.ndarray, match: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, offset) of each place of a string whose next ``match`` bytes also occur in a string of a lesser owner."""
    if not len(strings):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(owner, kind="stable")
    length = np.array([len(strings[i]) for i in order])
    end = np.cumsum(length + 1)
    text = np.zeros(end[-1], np.int32)
    flat = np.frombuffer(b"".join([strings[i] for i in order]), np.uint8)
    text[np.arange(len(flat)) + np.repeat(np.arange(len(order)), length)] = flat.astype(np.int32) + 1
    sorted_owner = owner[order]
    index = RunIndex(text, sorted_owner, int(length.max()), match)
    s, t = index.stream(end - length - 1, length, sorted_owner)
    return order[s], t
