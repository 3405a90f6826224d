"""Suffix and common-prefix arrays by external induced sorting.

Suffixes are L or S type (larger or smaller than the next one). The leftmost S suffixes are sorted by recursion on
their substrings' names; all others are induced by scanning: a popped suffix pushes the one before it into a queue.
The queue orders its suffix tuples by first symbol and, within a symbol, by arrival, which is their final order. As
the size of each symbol's part is known, its slots lie in one file on disk, with a head per symbol in memory; pops
and pushes move whole runs of tuples, as far as all slots are filled. Types and leftmost S suffixes are found run by
run too. At most SMALL names of substrings are sorted in memory by doubling, where a scan would move a few tuples for
each name. The order and names of the leftmost S suffixes and the suffixes of one symbol are still held in memory, so
that a shard's memory grows with its size.

The tuples also carry the common prefix with the tuple before them in their part: one more than the least value
between the two suffixes that pushed them. Values stop at `limit`.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

#: Tuples that are popped and pushed at a time.
RUN = 1 << 16
#: Most names that are sorted in memory.
SMALL = 1 << 19
#: Longest text whose positions and names are 32-bit numbers.
NARROW = np.iinfo(np.int32).max


def place_type(n: int) -> type:
    """The integer type of positions in a text of n symbols."""
    return np.int32 if n <= NARROW else np.int64


class Disk:
    """Arrays in files of a folder of this task; they go with it."""

    def __init__(self):
        self._folder = tempfile.TemporaryDirectory(prefix="suffixes-")
        self._n = 0

    def __enter__(self) -> Disk:
        return self

    def __exit__(self, *_) -> None:
        self._folder.cleanup()

    def array(self, n: int, dtype) -> np.ndarray:
        self._n += 1
        path = os.path.join(self._folder.name, str(self._n))
        return np.memmap(path, dtype, "w+", shape=(max(n, 1),)).view(np.ndarray)[:n]

    def keep(self, values: np.ndarray) -> np.ndarray:
        out = self.array(len(values), values.dtype)
        out[:] = values
        return out


class Queue:
    """Disk-backed priority queue of suffix tuples: position and common prefix, by first symbol, then arrival."""

    def __init__(self, disk: Disk, sizes: np.ndarray, limit: int, kind: type):
        self.ends = np.cumsum(sizes)
        self.heads = self.ends - sizes
        self.starts = self.heads.copy()
        n = int(self.ends[-1])
        self.positions = disk.array(n, kind)
        self.prefixes = disk.array(n, np.uint8) if limit else None
        self.limit = limit
        self.low = np.zeros(len(sizes), np.uint8)  # least prefix scanned since the last push of each symbol

    def push(self, symbols: np.ndarray, positions: np.ndarray, sources: np.ndarray, scanned: np.ndarray | None) -> None:
        """Push in order of arrival; `sources` are places in the run being scanned, `scanned` its common prefixes."""
        order = np.argsort(symbols, kind="stable")
        sorted_symbols = symbols[order]
        first = np.flatnonzero(np.concatenate(([True], sorted_symbols[1:] != sorted_symbols[:-1]))) if len(order) else order
        present = sorted_symbols[first]
        counts = np.diff(np.append(first, len(order)))
        slots = np.arange(len(order)) - np.repeat(first, counts) + np.repeat(self.heads[present], counts)
        self.positions[slots] = positions[order]
        if self.limit:
            tables = _minimum_tables(scanned)
            at = sources[order]
            before = np.concatenate(([-1], at[:-1])) if len(at) else at
            before[first] = -1
            least = _range_minima(tables, before + 1, at)
            least[first] = np.minimum(least[first], self.low[present])
            values = np.minimum(least.astype(np.int16) + 1, self.limit).astype(np.uint8)
            values[first[self.heads[present] == self.starts[present]]] = 0
            self.prefixes[slots] = values
            np.minimum(self.low, tables[0].min(), out=self.low)
            last = at[first + counts - 1] if len(at) else at
            tail = np.full(len(present), 255, np.uint8)
            more = last + 1 < len(scanned)
            tail[more] = _range_minima(tables, last[more] + 1, np.full(more.sum(), len(scanned) - 1))
            self.low[present] = tail
        self.heads[present] += counts


def _minimum_tables(values: np.ndarray) -> list[np.ndarray]:
    tables, size = [values], 1
    while 2 * size <= len(values):
        tables.append(np.minimum(tables[-1][:-size], tables[-1][size:]))
        size *= 2
    return tables


def _range_minima(tables: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minimum over each closed range."""
    out = np.empty(len(first), np.uint8)
    if not len(first):
        return out
    level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    for k in np.unique(level):
        at = level == k
        table = tables[k]
        out[at] = np.minimum(table[first[at]], table[last[at] + 1 - (1 << k)])
    return out


def _s_types(disk: Disk, text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next one. The last symbol is the smallest and unique."""
    n = len(text)
    out = disk.array(n, bool)
    out[n - 1] = following = True
    for stop in range(n - 1, 0, -RUN):  # downwards, with the type of the suffix after the run
        at = max(0, stop - RUN)
        here, after = text[at:stop], text[at + 1 : stop + 1]
        decided = np.where(here == after, stop - at, np.arange(stop - at))
        decided = np.minimum.accumulate(decided[::-1])[::-1]
        out[at:stop] = np.append(here < after, following)[decided]
        following = bool(out[at])
    return out


def _induce(
    disk: Disk, text: np.ndarray, fill: np.ndarray, seeds: np.ndarray, seed_prefixes: np.ndarray | None, alphabet: int,
    limit: int, is_down: bool, common,
) -> Queue:
    """Fill the queue with all suffixes of one type from the sorted `seeds`, scanning symbols upwards or downwards.

    Of each symbol the filled part is scanned first, then its seeds.
    """
    def symbol(at):
        found = text[at].astype(np.int64)
        return alphabet - 1 - found if is_down else found

    sizes = np.zeros(alphabet, np.int64)
    for at in range(0, len(text), RUN):
        chosen = np.flatnonzero(fill[at : at + RUN]) + at
        sizes += np.bincount(symbol(chosen), minlength=alphabet)
    kind = place_type(len(text))
    queue = Queue(disk, sizes, limit, kind)
    seed_sizes = np.zeros(alphabet, np.int64)
    for at in range(0, len(seeds), RUN):
        seed_sizes += np.bincount(symbol(seeds[at : at + RUN]), minlength=alphabet)
    seed_ends = np.cumsum(seed_sizes)

    def scan(positions: np.ndarray, prefixes: np.ndarray | None) -> None:
        at = np.flatnonzero(positions > 0)
        before = positions[at].astype(np.int64) - 1
        keep = fill[before]
        at, before = at[keep], before[keep]
        if len(at) or limit:
            queue.push(symbol(before), before.astype(kind), at, prefixes)

    def border(c: int) -> int:
        """Common prefix of the last filled suffix of a symbol and its first seed."""
        if queue.starts[c] == queue.ends[c]:
            return 0
        return common(int(queue.positions[queue.ends[c] - 1]), int(seeds[seed_ends[c] - seed_sizes[c]]))

    cursor = 0
    busy = np.flatnonzero((sizes > 0) | (seed_sizes > 0))  # only symbols that occur
    i = 0
    while i < len(busy):
        c = int(busy[i])
        if cursor < queue.ends[c]:
            if queue.heads[c] < queue.ends[c] or limit or max(queue.ends[c] - cursor, seed_sizes[c]) > RUN:
                stop = min(int(queue.heads[c]), cursor + RUN)
                if stop == cursor:
                    raise AssertionError("a slot stayed empty")
                scan(np.array(queue.positions[cursor:stop]), np.array(queue.prefixes[cursor:stop]) if limit else None)
                cursor = stop
                continue
        if limit or seed_sizes[c] > RUN:
            for at in range(int(seed_ends[c] - seed_sizes[c]), int(seed_ends[c]), RUN):
                stop = min(at + RUN, int(seed_ends[c]))
                part = np.array(seed_prefixes[at:stop]) if limit else None
                if limit and at == seed_ends[c] - seed_sizes[c]:
                    part[0] = border(c)
                scan(np.array(seeds[at:stop]), part)
            i += 1
            continue
        # Many small parts: all symbols whose parts are filled go in one run.
        last, window = i, 64
        while last + 1 < len(busy):
            look = busy[last + 1 : last + 1 + window]
            ready = queue.heads[look] == queue.ends[look]
            room = (queue.ends[look] - cursor) + (seed_ends[look] - seed_ends[c] + seed_sizes[c]) <= RUN
            good = ready & room
            if good.all():
                last += len(look)
                window *= 2
                continue
            last += int(np.argmin(good))
            break
        chosen = busy[i : last + 1]
        own = np.array(queue.positions[cursor : int(queue.ends[busy[last]])])
        others = np.array(seeds[int(seed_ends[c] - seed_sizes[c]) : int(seed_ends[busy[last]])])
        own_sizes = sizes[chosen].copy()
        own_sizes[0] = queue.ends[c] - cursor
        merged = np.empty(len(own) + len(others), kind)
        ranks = np.arange(len(chosen))
        merged[_interleave(own_sizes, seed_sizes[chosen], ranks, False)] = own
        merged[_interleave(own_sizes, seed_sizes[chosen], ranks, True)] = others
        scan(merged, None)
        cursor = int(queue.ends[busy[last]])
        i = last + 1
    return queue


def _interleave(own: np.ndarray, others: np.ndarray, ranks: np.ndarray, is_other: bool) -> np.ndarray:
    """Places of the members when for each symbol its own part comes first, then the others."""
    begin = np.cumsum(own + others) - (own + others)
    sizes = others if is_other else own
    begin = begin + own if is_other else begin
    inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.repeat(begin, sizes) + inner


def _s_leftmost(disk: Disk, types: np.ndarray, kind: type) -> np.ndarray:
    def within(at: int) -> np.ndarray:
        stop = min(at + RUN, len(types))
        return np.flatnonzero(types[at:stop] & ~types[at - 1 : stop - 1]) + at

    starts = range(1, len(types), RUN)
    out, filled = disk.array(sum(len(within(at)) for at in starts), kind), 0
    for at in starts:
        found = within(at)
        out[filled : filled + len(found)] = found
        filled += len(found)
    return out


def common_prefixes(text: np.ndarray, left: np.ndarray, right: np.ndarray, limit: int) -> np.ndarray:
    """Common prefix of pairs of different suffixes, at most `limit`."""
    out = np.zeros(len(left), np.int64)
    live = np.arange(len(left))
    wide = 8 // text.itemsize  # symbols that are compared at a time, as one number at any place
    if len(text) > wide and text.flags.c_contiguous:
        words = np.ndarray(len(text) - wide + 1, np.uint64, text, strides=(text.itemsize,))
        while len(live):
            at = out[live]
            fits = (np.maximum(left[live], right[live]) + at < len(words)) & (at + wide <= limit)
            live, at = live[fits], at[fits]
            live = live[words[left[live] + at] == words[right[live] + at]]
            out[live] += wide
        live = np.flatnonzero(out < limit)
    while len(live):
        live = live[text[left[live] + out[live]] == text[right[live] + out[live]]]
        out[live] += 1
        live = live[out[live] < limit]
    return out


def small_order(names: np.ndarray) -> np.ndarray:
    """All suffixes in order, by doubling; the last symbol is the smallest and unique."""
    n = len(names)
    bits = max(1, int(names.max()).bit_length())
    step = max(1, 63 // bits)  # symbols that make up the first ranks
    padded = np.concatenate((names, np.zeros(step, names.dtype))).astype(np.int64)
    ranks = np.zeros(n, np.int64)
    for i in range(step):
        ranks = ranks << bits | padded[i : i + n]
    order = np.argsort(ranks)
    slots, groups, low = np.arange(n), np.zeros(n, np.int64), ranks[order]
    ranks = np.empty(n, np.int64)
    while True:
        # `order` holds suffixes that share their group with others, `low` what tells those of a group apart.
        fresh = np.ones(len(order), bool)
        fresh[1:] = (groups[1:] != groups[:-1]) | (low[1:] != low[:-1])
        ranks[order] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
        several = ~(fresh & np.append(fresh[1:], True))
        order, slots = order[several], slots[several]
        if not len(order):
            break
        # The end of the text is unique, so suffixes with equal first symbols end after them.
        value = ranks[order] * n + ranks[order + step]
        sort = np.argsort(value)
        order, value = order[sort], value[sort]
        groups, low = np.divmod(value, n)
        step *= 2
    out = np.empty(n, np.int64)
    out[ranks] = np.arange(n)
    return out


def _sort(disk: Disk, text: np.ndarray, alphabet: int, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]] | np.ndarray:
    """All suffixes in order: with a limit as (positions, common prefixes) by symbol, else one array."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int32)
    kind = place_type(n)
    types = _s_types(disk, text)
    leftmost = _s_leftmost(disk, types, kind)
    is_leftmost = disk.array(n, bool)
    for at in range(0, len(leftmost), RUN):
        is_leftmost[leftmost[at : at + RUN]] = True
    large, small = np.logical_not(types, out=disk.array(n, bool)), disk.keep(types)
    small[n - 1] = False  # the end of the text pushes nothing

    def pair(a: int, b: int) -> int:
        return int(common_prefixes(text, np.array([a]), np.array([b]), limit)[0])

    def passes(disk, seeds, prefixes, limit):
        up = _induce(disk, text, large, seeds, prefixes, alphabet, limit, False, pair)
        down_prefixes = None
        if limit:  # going down, a tuple's neighbour before it is the next larger one
            down_prefixes = disk.array(len(up.prefixes), np.uint8)
            down_prefixes[1:] = up.prefixes[:0:-1]
        down = _induce(disk, text, small, up.positions[::-1], down_prefixes, alphabet, limit, True, pair)
        return up, down

    with Disk() as first_disk:  # the arrays of the first round go when the substrings are sorted
        by_symbol = first_disk.keep(leftmost[np.argsort(text[leftmost], kind="stable")])
        down = passes(first_disk, by_symbol, None, 0)[1]
        ordered = down.positions[::-1]
        ordered = np.concatenate(([n - 1], ordered[is_leftmost[ordered]])).astype(kind)
        del by_symbol, down
    # Names: equal neighbours among the sorted substrings share one. A substring ends with the next leftmost S.
    place = np.searchsorted(leftmost, ordered)
    lengths = np.append(np.diff(leftmost), 0)[place] + 1
    same = lengths[1:] == lengths[:-1]
    same[0:1] = False  # the end of the text is unique
    live = np.flatnonzero(same)
    for step in range(int(lengths.max())):
        if not len(live):
            break
        live_long = live[lengths[live] > step]
        differ = live_long[text[ordered[live_long] + step] != text[ordered[live_long + 1] + step]]
        same[differ] = False
        live = live_long[same[live_long]]
    names = np.concatenate(([0], np.cumsum(~same)))
    if names[-1] + 1 < len(names):
        with Disk() as disk_below:
            reduced = disk_below.array(len(leftmost), place_type(len(leftmost)))
            reduced[place] = names
            is_small = len(reduced) <= SMALL
            ordered = leftmost[small_order(reduced) if is_small else _sort(disk_below, reduced, int(names[-1]) + 1, 0)]
    seeds = disk.keep(np.asarray(ordered, kind))
    prefixes = None
    if limit:
        prefixes = disk.array(len(seeds), np.uint8)
        prefixes[1:] = common_prefixes(text, seeds[:-1].astype(np.int64), seeds[1:].astype(np.int64), limit)
    up, down = passes(disk, seeds, prefixes, limit)
    if limit:
        return _by_symbol(up, down, alphabet, pair)
    out = disk.array(n, kind)
    large_sizes = up.ends - up.starts
    small_sizes = (down.ends - down.starts)[::-1].copy()
    small_sizes[0] += 1  # the end of the text
    ranks = np.arange(alphabet)
    out[_interleave(large_sizes, small_sizes, ranks, False)] = up.positions
    out[_interleave(large_sizes, small_sizes, ranks, True)] = np.concatenate(([n - 1], down.positions[::-1]))
    return out


def _by_symbol(up: Queue, down: Queue, alphabet: int, pair) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for c in range(1, alphabet):
        large = slice(int(up.starts[c]), int(up.ends[c]))
        d = alphabet - 1 - c
        small = slice(int(down.starts[d]), int(down.ends[d]))
        positions = np.concatenate((up.positions[large], down.positions[small][::-1]))
        if not len(positions):
            continue
        n_large = large.stop - large.start
        prefixes = np.zeros(len(positions), np.uint8)
        prefixes[:n_large] = up.prefixes[large]
        if small.stop > small.start:
            prefixes[n_large + 1 :] = down.prefixes[small][:0:-1]
            if n_large:
                prefixes[n_large] = pair(int(positions[n_large - 1]), int(positions[n_large]))
        yield positions, prefixes


def suffix_groups(disk: Disk, text: np.ndarray, alphabet: int, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted suffixes with their common prefixes (up to `limit`, below 255), one symbol after the other.

    `text` ends with a zero, the only one in it.
    """
    return _sort(disk, text, alphabet, limit) if len(text) > 1 else iter(())
