"""Suffix order and common prefixes of one shard by external induced sorting.

A suffix is of type S if it is smaller than the next one, else L; a leftmost S suffix has an L
before it.  The stretches between leftmost S suffixes are named by order and the shorter string of
names is sorted, stretch by stretch of doubled length: the base of the recursion, which holds a
third of the positions or less.  From their order the L suffixes are induced upwards and from
those the S suffixes downwards: the smallest entry of a queue is taken, and what precedes it is put
back under its own first symbol.  An entry is (position, common prefix with the entry before).
Entries reach each symbol's queue in order, so the priority queue is one append-only run for each
symbol, which goes to disk beyond ``room`` bytes and is read back in blocks.  Common prefixes are
carried along: that of two induced neighbours is 1 more than the least among what lies between
their successors.  They count up to ``cap``.

The text is bytes shifted up by one; 0 ends it, and 255 parts its pieces (neither is in UTF-8).
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

END, PART = 0, 255
BLOCK = 1 << 19
ROOM = 64 << 20


class Queues:
    """A run of (position, common prefix) for each symbol, in memory up to ``room`` bytes."""

    def __init__(self, folder: str, room: int):
        self.runs = [[] for _ in range(256)]
        self.room, self.held, self.spilled = room, 0, 0
        self.file = tempfile.TemporaryFile(dir=folder)

    def put(self, symbol: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.runs[symbol].append((pos, lcp))
        self.held += pos.nbytes + lcp.nbytes
        if self.held > self.room:
            for runs in self.runs:
                for i, run in enumerate(runs):
                    if not isinstance(run[0], int):
                        at = self.file.seek(0, os.SEEK_END)
                        self.file.write(run[0].tobytes())
                        self.file.write(run[1].tobytes())
                        runs[i] = (at, len(run[0]), run[0].dtype)
            self.spilled += self.held
            self.held = 0

    def _load(self, run):
        if not isinstance(run[0], int):
            return run
        at, n, kind = run
        self.file.seek(at)
        return np.frombuffer(self.file.read(n * kind.itemsize), kind), np.frombuffer(self.file.read(n), np.uint8)

    def take(self, symbol: int):
        """Blocks of entries, oldest first, until the queue stays empty."""
        while runs := self.runs[symbol]:
            block, size = [], 0
            while runs and (not block or size < BLOCK):
                run = runs.pop(0)
                self.held -= 0 if isinstance(run[0], int) else run[0].nbytes + run[1].nbytes
                block.append(self._load(run))
                size += len(block[-1][0])
            yield block[0] if len(block) == 1 else tuple(np.concatenate([r[i] for r in block]) for i in (0, 1))

    def newest_first(self, symbol: int):
        for run in reversed(self.runs[symbol]):
            yield self._load(run)


def _types(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is of type S."""
    s = np.ones(len(t), bool)
    ends = np.flatnonzero(t[:-1] != t[1:])
    s[:-1] = np.repeat(t[ends] < t[ends + 1], np.diff(ends, prepend=-1))
    return s


class _Prefixes:
    """Common prefixes of pairs of suffixes by direct comparison, eight bytes at a time."""

    def __init__(self, t: np.ndarray, cap: int):
        self.raw = np.concatenate([t, np.zeros(cap + 16, np.uint8)])
        self.words = np.ndarray(len(t) + cap + 8, "<u8", self.raw, strides=(1,))
        self.cap = cap

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out, left = np.full(len(a), self.cap, np.uint8), np.arange(len(a))
        one = np.uint64(1)
        for at in range(0, self.cap, 8):
            x = self.words[a[left] + at] ^ self.words[b[left] + at]
            differ = x != 0
            d = x[differ]
            low = np.bitwise_count((d & (~d + one)) - one) >> 3
            out[left[differ]] = np.minimum(self.cap, at + low)
            left = left[~differ]
            if not len(left):
                break
        return out


def _refine(rank: np.ndarray, active: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Part the tied groups in ``active`` by ``key`` (below 2^32); returns what is still tied."""
    both = rank[active].astype(np.uint64) << np.uint64(32) | key.astype(np.uint64)
    order = np.argsort(both)
    a, both = active[order], both[order]
    old = rank[a]
    at = np.arange(len(a))
    fresh = np.ones(len(a), bool)
    fresh[1:] = both[1:] != both[:-1]
    group = np.ones(len(a), bool)
    group[1:] = old[1:] != old[:-1]
    rank[a] = old + np.maximum.accumulate(np.where(fresh, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
    alone = fresh & np.append(fresh[1:], True)
    return a[~alone]


def _sorted_leftmost(t: np.ndarray, s: np.ndarray, lms: np.ndarray, cap: int) -> np.ndarray:
    """The leftmost S suffixes in order of their first ``cap`` symbols at least."""
    n = len(lms)
    last = np.append(lms[1:], lms[-1])                     # a stretch runs up to the next one, inclusive
    rank, tied = np.zeros(n, np.int64), np.arange(n)
    reach = 0
    while len(tied):                                       # seven symbols with their types a step
        word = np.zeros(len(tied), np.uint64)
        for i in range(reach, reach + 7):
            p = lms[tied] + i
            inside = p <= last[tied]
            p = np.minimum(p, len(t) - 1)
            word = word << np.uint64(9) | np.where(inside, t[p].astype(np.uint64) << np.uint64(1) | s[p], 0)
        tied = _refine(rank, tied, np.unique(word, return_inverse=True)[1])
        reach += 7
        more = last[tied] >= lms[tied] + reach
        if not more.any():
            break
        tied = tied[more]
    order = np.argsort(rank, kind="stable")
    ties = rank[order[1:]] == rank[order[:-1]]
    tied = order[np.append(False, ties) | np.append(ties, False)]
    step = 1
    while len(tied) and step <= cap // 2 + 1:              # each name stands for two symbols or more
        tied = _refine(rank, tied, rank[np.minimum(tied + step, n - 1)])
        step *= 2
    return lms[np.argsort(rank, kind="stable")]


class _Inducer:
    """Puts what precedes the scanned entries into queues, with carried common prefixes."""

    def __init__(self, t, wanted, queues, cap):
        self.t, self.wanted, self.queues, self.cap = t, wanted, queues, cap
        self.since = np.full(256, cap, np.uint8)           # least prefix since a symbol was last put
        self.known = np.zeros(256, bool)

    def scan(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        """``lcp``: common prefix of each entry with the one scanned before it."""
        m = len(pos)
        if not m:
            return
        at = np.flatnonzero(pos > 0)
        at = at[self.wanted[pos[at] - 1]]
        before = pos[at] - 1
        symbol = self.t[before]
        order = np.argsort(symbol, kind="stable")
        at, before, symbol = at[order], before[order], symbol[order]
        first = np.ones(len(at), bool)
        first[1:] = symbol[1:] != symbol[:-1]
        got = np.zeros(len(at), np.uint8)
        f = np.flatnonzero(first)
        least = np.minimum.accumulate(lcp)
        got[f] = np.minimum(self.since[symbol[f]], least[at[f]])
        rest = np.flatnonzero(~first)
        if len(rest):
            got[rest] = _range_least(lcp, at[rest - 1] + 1, at[rest])
        got = np.minimum(got.astype(np.int16) + 1, self.cap).astype(np.uint8)
        got[f[~self.known[symbol[f]]]] = 0
        self.since = np.minimum(self.since, least[-1])
        ends = np.append(f[1:], len(at))
        if len(f):
            tail = np.minimum.accumulate(lcp[::-1])[::-1]
            e = at[ends - 1] + 1
            self.since[symbol[f]] = np.where(e < m, tail[np.minimum(e, m - 1)], self.cap)
            self.known[symbol[f]] = True
        for a, b in zip(f.tolist(), ends.tolist()):
            self.queues.put(int(symbol[a]), before[a:b], got[a:b])


def _range_least(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least of x[lo..hi], ends included."""
    size = hi - lo + 1
    level = np.frexp(size)[1] - 1
    out = np.empty(len(lo), x.dtype)
    row, width = x, 1
    for k in range(int(level.max()) + 1):
        here = np.flatnonzero(level == k)
        if len(here):
            out[here] = np.minimum(row[lo[here]], row[hi[here] - width + 1])
        row = np.minimum(row[:len(row) - width], row[width:]) if len(row) > width else row
        width *= 2
    return out


def _large(size: int, kind, folder: str, room: int) -> np.ndarray:
    """An array on disk if it exceeds ``room`` bytes."""
    if size * np.dtype(kind).itemsize <= room:
        return np.zeros(size, kind)
    with tempfile.TemporaryFile(dir=folder) as f:
        return np.memmap(f, kind, "w+", shape=(size,))


def repeated(t: np.ndarray, cap: int, folder: str | None = None, room: int = ROOM) -> np.ndarray:
    """Whether the first ``cap`` symbols at each position also begin at another position.
    ``t`` ends with 0, which is nowhere else; ``cap`` is below 255."""
    flags = _large(len(t), bool, folder, room)
    if len(t) < 2:
        return flags
    kind = np.int32 if len(t) < 1 << 31 else np.int64
    s = _types(t)
    lms = (np.flatnonzero(s[1:] & ~s[:-1]) + 1).astype(kind)
    order = _sorted_leftmost(t, s, lms, cap)
    prefix = _Prefixes(t, cap)
    cut = np.searchsorted(t[order], np.arange(257))
    rising, placed = Queues(folder, room), Queues(folder, room)
    up = _Inducer(t, ~s, rising, cap)
    for symbol in range(256):
        last = None
        for pos, lcp in rising.take(symbol):
            up.scan(pos, lcp)
            placed.put(symbol, pos, lcp)
            last = pos[-1:]
        for a in range(cut[symbol], cut[symbol + 1], BLOCK):
            pos = order[a:min(a + BLOCK, cut[symbol + 1])]
            lcp = np.zeros(len(pos), np.uint8)
            lcp[1:] = prefix.of(pos[:-1], pos[1:])
            lcp[:1] = prefix.of(last, pos[:1]) if last is not None else 0
            up.scan(pos, lcp)
            last = pos[-1:]
    falling = Queues(folder, room)
    down = _Inducer(t, s, falling, cap)

    def mark(pos, lcp, before):
        same = np.flatnonzero(lcp >= cap)
        flags[pos[same]] = True
        flags[pos[same[same > 0] - 1]] = True
        if len(same) and same[0] == 0 and before is not None:
            flags[before] = True

    for symbol in range(255, -1, -1):
        last = None
        for pos, lcp in falling.take(symbol):
            down.scan(pos, lcp)
            mark(pos, lcp, last)
            last = pos[-1:]
        link = prefix.of(last, last) if last is not None else None
        for pos, lcp in placed.newest_first(symbol):
            if link is None:
                head = 0
            elif last is not None and link == "next":
                head = following
            else:
                head = prefix.of(last, pos[-1:])[0]
            fall = np.empty(len(pos), np.uint8)
            fall[0], fall[1:] = head, lcp[:0:-1]
            down.scan(pos[::-1], fall)
            mark(pos[::-1], fall, last)
            last, link, following = pos[:1], "next", lcp[0]
    return flags
