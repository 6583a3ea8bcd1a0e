"""Suffix sorting by induction, with disk-backed queues that carry suffix tuples and common prefixes.

A text is a sequence of strings, each closed by a mark smaller than any symbol;
marks rank by position. Suffixes that begin a descent (the leftmost smaller ones)
are sorted first: their substrings by one induction, then the string of the
substrings' names. From them all others are induced: sweeping the symbols
upwards, each sorted suffix puts its larger predecessor into the queue of that
predecessor's symbol; sweeping downwards, its smaller one. A symbol's queue is a
priority queue whose order within equal keys is the order of arrival.

What a queue holds is a tuple: position, the symbols before it (``CARRIED`` of
them, so that the text is only looked at when they run out) and the common prefix
with the entry before it. A new entry's common prefix is one more than the least
one met since the last entry of its symbol, so prefixes pass through the sweeps
with the suffixes. Queues share a memory limit; beyond it all their blocks go to a
run file, from which each is read back piece by piece. The names are sorted by the
same induction where there are few of them; of many, by ranks over doubling lengths.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np

MARK = 0
SYMBOLS = 257
BITS, CARRIED = 9, 3
#: Names that are sorted by induction again; more would need a queue each.
FEW_NAMES = 500
#: Entries of a block that is handled at once, and bytes of an entry.
BLOCK, ENTRY = 1 << 15, 10
MOST = 65535
Block = tuple[np.ndarray, np.ndarray, np.ndarray]  # positions, common prefixes, symbols before


class Store:
    """Queues of one sort, their common memory and their run files, which lie in a folder that any file system may hold."""

    def __init__(self, folder: str, limit: int) -> None:
        from pyarrow import fs

        self.files, base = fs.FileSystem.from_uri(folder)
        self.base, self.limit, self.held, self.spilled = f"{base}/{uuid.uuid4().hex}", limit, 0, 0
        self.queues: list[Queue] = []
        self.open: dict[str, object] = {}

    def queue(self) -> Queue:
        self.queues.append(Queue(self))
        return self.queues[-1]

    def spill(self) -> None:
        """Write all blocks in memory to one run file."""
        if not self.open:
            self.files.create_dir(self.base, recursive=True)
        name, at = f"{self.base}/{len(self.open)}", 0
        with self.files.open_output_stream(name, compression=None) as out:
            for q in self.queues:
                for j, part in enumerate(q.parts):
                    if isinstance(part[0], np.ndarray):
                        for a in part:
                            out.write(a.tobytes())
                        q.parts[j] = (name, at, len(part[0]))
                        at += len(part[0]) * ENTRY
        self.open[name] = self.files.open_input_file(name)
        self.spilled, self.held = self.spilled + at, 0

    def read(self, name: str, at: int, n: int) -> Block:
        raw = self.open[name].read_at(n * ENTRY, at)
        return np.frombuffer(raw, np.int32, n), np.frombuffer(raw, np.uint16, n, 4 * n), np.frombuffer(raw, np.uint32, n, 6 * n)

    def close(self) -> None:
        for f in self.open.values():
            f.close()
        if self.open:
            self.files.delete_dir(self.base)
        self.open, self.queues = {}, []


class Queue:
    """Blocks of tuples in order of arrival, in memory or in a run file."""

    def __init__(self, store: Store) -> None:
        self.store, self.parts = store, []

    def push(self, block: Block) -> None:
        if len(block[0]):
            self.parts.append(block)
            self.store.held += len(block[0]) * ENTRY
            if self.store.held > self.store.limit:
                self.store.spill()

    def _load(self, part) -> Block:
        if isinstance(part[0], np.ndarray):
            self.store.held -= len(part[0]) * ENTRY
            return part
        return self.store.read(*part)

    def drain(self) -> Iterator[Block]:
        """Blocks in order, small neighbours together; what arrives meanwhile follows."""
        while self.parts:
            got, n = [], 0
            while self.parts and n < BLOCK:
                got.append(self._load(self.parts.pop(0)))
                n += len(got[-1][0])
            yield got[0] if len(got) == 1 else tuple(np.concatenate(x) for x in zip(*got, strict=True))

    def backwards(self) -> Iterator[Block]:
        """Blocks from the last to the first, each still in order."""
        while self.parts:
            got, n = [], 0
            while self.parts and n < BLOCK:
                got.append(self._load(self.parts.pop()))
                n += len(got[-1][0])
            yield got[0] if len(got) == 1 else tuple(np.concatenate(x[::-1]) for x in zip(*got, strict=True))


def least(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of values[lo : hi + 1] for each pair; the largest value where the range is empty."""
    out = np.full(len(lo), MOST, np.uint16)
    some = np.flatnonzero(hi >= lo)
    if len(some):
        lo, hi = lo[some], hi[some]
        power = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        table = [values]
        for k in range(int(power.max())):
            step = 1 << k
            row = table[-1].copy()
            row[:-step] = np.minimum(row[:-step], row[step:])
            table.append(row)
        if len(table) == 1:
            out[some] = values[lo]
        else:
            grid = np.stack(table)
            out[some] = np.minimum(grid[power, lo], grid[power, hi - (1 << power) + 1])
    return out


def before(t: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """The symbols before each position, the nearest in the lowest bits, each one higher than it is; a text begins after a mark."""
    out = np.zeros(len(pos), np.uint32)
    for k in range(CARRIED, 0, -1):
        at = pos - k
        out = (out << np.uint32(BITS)) | np.where(at >= 0, t[np.maximum(at, 0)].astype(np.uint32) + np.uint32(1), np.uint32(MARK + 1))
    return out


class _Sweep:
    """One sweep: routes predecessors to the queues of their symbols, with their common prefixes."""

    def __init__(self, t: np.ndarray, n_symbols: int, store: Store) -> None:
        self.t = t
        self.queues = [store.queue() for _ in range(n_symbols)]
        self.met = np.zeros(n_symbols, np.uint16)  # the least common prefix since the last entry of each symbol

    def route(self, block: Block, fits: Callable[[np.ndarray], np.ndarray]) -> None:
        pos, lcp, pre = block
        out = np.flatnonzero(pre == 0)
        if len(out):
            pre = pre.copy()
            pre[out] = before(self.t, pos[out])
        symbol = (pre & np.uint32((1 << BITS) - 1)).astype(np.int32) - 1
        go = np.flatnonzero(fits(symbol) & (symbol != MARK))
        go = go[np.argsort(symbol[go].astype(np.uint16), kind="stable")]
        own = symbol[go]
        first = np.ones(len(go), bool)
        first[1:] = own[1:] != own[:-1]
        start = np.zeros(len(go), np.int64)
        start[1:] = go[:-1] + 1
        start[first] = 0
        heads = np.flatnonzero(first)
        tails = np.append(heads[1:], len(go))[: len(heads)] - 1
        # Common prefixes of the new entries, and of what follows the last entry of each symbol.
        found = least(lcp, np.concatenate([start, go[tails] + 1]), np.concatenate([go, np.full(len(heads), len(pos) - 1)]))
        shared, rest = found[: len(go)], found[len(go) :]
        shared[heads] = np.minimum(shared[heads], self.met[own[heads]])
        self.met = np.minimum(self.met, lcp.min()) if len(lcp) else self.met
        self.met[own[heads]] = rest
        new = (pos[go] - 1, (np.minimum(shared, MOST - 1) + 1).astype(np.uint16), pre[go] >> np.uint32(BITS))
        for a, b in zip(heads.tolist(), tails.tolist(), strict=True):
            self.queues[own[a]].push(tuple(x[a : b + 1] for x in new))


def _run(t: np.ndarray, p: int) -> int:
    """Length of the run of equal symbols from a position."""
    n = 1
    while p + n < len(t) and t[p + n] == t[p] and n < MOST:
        n += 1
    return n


def induce(t: np.ndarray, seeds: np.ndarray, shared: np.ndarray, n_symbols: int, store: Store, emit: Callable[[np.ndarray, np.ndarray], None]) -> None:
    """All suffixes from the sorted seeds (with their common prefixes), handed to ``emit`` from the largest to the smallest.

    ``emit`` gets blocks of positions, each with the common prefix that it has with the suffix before it.
    """
    first = np.searchsorted(t[seeds], np.arange(n_symbols + 1))  # seeds come in symbol order
    up = _Sweep(t, n_symbols, store)
    falling = [store.queue() for _ in range(n_symbols)]
    most = [-1] * n_symbols  # the largest falling suffix of each symbol
    for c in range(n_symbols):
        empty = True
        for pos, lcp, pre in up.queues[c].drain():
            if empty:
                lcp, empty = lcp.copy(), False
                lcp[0] = 0
            falling[c].push((pos, lcp, pre))
            most[c] = int(pos[-1])
            up.route((pos, lcp, pre), lambda s, c=c: s >= c)
        for lo in range(int(first[c]), int(first[c + 1]), BLOCK):
            pos = seeds[lo : min(lo + BLOCK, int(first[c + 1]))]
            lcp = shared[lo : lo + len(pos)].copy()
            if lo == first[c]:  # a falling and a rising suffix part where the shorter of their first runs ends
                lcp[0] = 0 if most[c] < 0 else min(_run(t, most[c]), _run(t, int(pos[0])))
            up.route((pos, lcp, np.zeros(len(pos), np.uint32)), lambda s, c=c: s > c)
    down = _Sweep(t, n_symbols, store)
    for c in range(n_symbols - 1, -1, -1):
        last = -1
        if c == MARK:
            pos = seeds[: int(first[1])][::-1]
            emit(pos, np.zeros(len(pos), np.uint16))
            continue
        for pos, lcp, pre in down.queues[c].drain():
            if last < 0:
                lcp = lcp.copy()
                lcp[0] = 0
            last = int(pos[-1])
            emit(pos, lcp)
            down.route((pos, lcp, pre), lambda s, c=c: s <= c)
        after = 0 if last < 0 or most[c] < 0 else min(_run(t, most[c]), _run(t, last))
        for pos, lcp, pre in falling[c].backwards():
            turned = np.empty_like(lcp)
            turned[0], turned[1:] = after, lcp[:0:-1]
            after = int(lcp[0])
            pos, pre = pos[::-1], pre[::-1]
            emit(pos, turned)
            # Their symbols before were counted down by the first sweep's reading only, so they serve again.
            down.route((pos, turned, pre), lambda s, c=c: s < c)


def smaller_than_next(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; marks are, runs follow their end."""
    n = len(t)
    out = np.zeros(n, bool)
    out[:-1] = t[:-1] < t[1:]
    equal = np.zeros(n, bool)
    equal[:-1] = (t[:-1] == t[1:]) & (t[:-1] != MARK)
    # The end of each run of equal symbols decides for the whole run.
    at = np.where(equal, n, np.arange(n))
    end = np.minimum.accumulate(at[::-1])[::-1]
    out = out[end]
    out[t == MARK] = True
    return out


def common_prefixes(t: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Of each suffix with the one before it, up to ``most``; marks are all different. Four symbols are compared at once."""
    n = len(t)
    wide = np.zeros(n + 4, np.uint64)
    wide[:n] = t
    four = wide[:n] | (wide[1 : n + 1] << np.uint64(16)) | (wide[2 : n + 2] << np.uint64(32)) | (wide[3 : n + 3] << np.uint64(48))
    at = np.where(t == MARK, np.arange(n), n)
    room = np.minimum.accumulate(at[::-1])[::-1] - np.arange(n)  # symbols up to the string's mark
    out = np.zeros(len(order), np.int64)
    left = np.arange(1, len(order))
    for k in range(0, most, 4):
        differ = four[np.minimum(order[left] + k, n - 1)] ^ four[np.minimum(order[left - 1] + k, n - 1)]
        low = differ & (~differ + np.uint64(1))  # the lowest bit in which they differ tells the symbol
        out[left] = k + np.where(differ == 0, 4, (low >= np.uint64(1 << 16)).astype(np.int64) + (low >= np.uint64(1 << 32)) + (low >= np.uint64(1 << 48)))
        left = left[(differ == 0) & (room[order[left]] > k + 4)]
        if not len(left):
            break
    out[1:] = np.minimum(out[1:], np.minimum(room[order[1:]], room[order[:-1]]))
    return np.minimum(out, MOST - 1).astype(np.uint16)


def _doubled(names: np.ndarray, ordered: np.ndarray, most: int) -> np.ndarray:
    """Order of the suffixes of a string whose marks have names of their own, from their order by name: ranks over doubling lengths.

    Only what is still equal is sorted again. A name is worth two symbols at least, so after ``most`` symbols the
    rest may stay in any order.
    """
    m, step = len(names), 1
    order, rank = ordered.copy(), np.empty(m, np.int64)
    new = np.ones(m, bool)
    new[1:] = names[order[1:]] != names[order[:-1]]
    while True:
        heads = np.flatnonzero(new)
        rank[order] = np.repeat(heads, np.diff(np.append(heads, m)))  # a group's rank is where it begins
        open_ = np.flatnonzero(~new | ~np.append(new[1:], True))
        if not len(open_) or step >= m or 2 * step >= most:
            return order
        part = order[open_]
        after = np.where(part + step < m, rank[np.minimum(part + step, m - 1)], -1)
        by = np.lexsort((after, rank[part]))
        part, after = part[by], after[by]
        order[open_] = part
        new[open_] = np.append(True, (rank[part[1:]] != rank[part[:-1]]) | (after[1:] != after[:-1]))
        step *= 2


class _Seeds:
    """Of all sorted suffixes, those that begin a descent, with their common prefixes."""

    def __init__(self, starts: np.ndarray) -> None:
        self.starts, self.pos, self.lcp, self.met = starts, [], [], MOST

    def emit(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        at = np.flatnonzero(self.starts[pos])
        if len(at):
            shared = np.minimum.reduceat(lcp[: at[-1] + 1], np.append(0, at[:-1] + 1))
            shared[0] = min(int(shared[0]), self.met)
            self.pos.append(pos[at])
            self.lcp.append(shared)
            rest = lcp[at[-1] + 1 :]
            self.met = int(rest.min()) if len(rest) else MOST
        elif len(lcp):
            self.met = min(self.met, int(lcp.min()))

    def rising(self) -> tuple[np.ndarray, np.ndarray]:
        pos, lcp = np.concatenate(self.pos)[::-1], np.concatenate(self.lcp)
        return pos, np.append(np.uint16(0), lcp[:0:-1])


def sort_suffixes(t: np.ndarray, folder: str, emit: Callable[[np.ndarray, np.ndarray], None], limit: int, most: int = MOST - 1, n_symbols: int = SYMBOLS) -> int:
    """All suffixes of ``t`` (strings closed by marks) from the largest to the smallest; returns the bytes that queues wrote to ``folder``.

    ``emit`` gets blocks of positions and the common prefix that each has with the one before it, exact up to ``most``.
    """
    if not len(t):
        return 0
    rising = smaller_than_next(t)
    starts = np.zeros(len(t), bool)
    starts[1:] = rising[1:] & ~rising[:-1]
    starts[t == MARK] = True
    at = np.flatnonzero(starts).astype(np.int32)
    seeds = at[np.argsort(t[at], kind="stable")]
    store, found, spilled = Store(folder, limit), _Seeds(starts), 0
    try:
        same = np.ones(len(seeds), np.uint16)
        same[1:] = t[seeds[1:]] == t[seeds[:-1]]
        same[t[seeds] == MARK] = 0
        same[0] = 0
        induce(t, seeds, same, n_symbols, store, found.emit)
    finally:
        spilled += store.spilled
        store.close()
    ordered, shared = found.rising()
    # Names of the substrings, each up to and with the next start: equal where all their symbols are.
    where = np.searchsorted(at, ordered)
    size = np.append(at[1:], len(t) - 1)[where] - ordered + 1
    new = np.ones(len(ordered), bool)
    new[1:] = (size[1:] != size[:-1]) | (shared[1:] < size[1:])
    new |= t[ordered] == MARK
    names = np.empty(len(at), np.int64)
    names[where] = np.cumsum(new) - 1
    marks = int((t == MARK).sum())
    if new.all():
        order = ordered
    elif int(names.max()) + 1 - marks < min(FEW_NAMES, (1 << BITS) - 2):
        reduced, parts = np.maximum(names - marks + 1, 0).astype(np.uint16), []
        spilled += sort_suffixes(reduced, folder, lambda pos, _: parts.append(pos.copy()), limit, MOST - 1, int(reduced.max()) + 1)
        order = at[np.concatenate(parts)[::-1]]
    else:
        order = at[_doubled(names, where, most)]
    store = Store(folder, limit)
    try:
        induce(t, order, common_prefixes(t, order, most), n_symbols, store, emit)
    finally:
        spilled += store.spilled
        store.close()
    return spilled


def suffix_array(t: np.ndarray, folder: str, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The whole suffix array and the common prefix of each suffix with the one before it, for texts of memory's size."""
    pos, lcp = [np.zeros(0, np.int32)], [np.zeros(0, np.uint16)]
    sort_suffixes(t, folder, lambda p, x: (pos.append(p.copy()), lcp.append(x.copy())), limit)
    order, shared = np.concatenate(pos)[::-1], np.concatenate(lcp)
    return order, np.append(np.uint16(0), shared[:0:-1])[: len(order)]
