"""Suffix order and common prefixes of one shard by external induced sorting.

The order of the S* suffixes (each larger than the suffix before it, smaller
than the one after) is found first: the text between two of them is named by
its rank, and the string of names is ordered, by the same induction where its
alphabet is small and by doubling ranks where it is not.  All other suffixes
follow from them: a queue holds tuples (first symbol, place, common prefix)
and gives them out by first symbol; every tuple taken out puts the suffix one
place further left into the queue.  One run through the symbols upwards induces
the suffixes larger than their successor, one downwards the smaller ones.

Common prefixes travel with the tuples: two suffixes of one first symbol share
one symbol more than their successors, and these share the minimum over what
was taken out between them.  Prefixes count up to ``cap`` symbols.

The queue writes its tuples to the task's spill file when they exceed its
memory, and the symbols may be a memory map, so a shard may exceed memory.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np

from riskspark.llm.common import Hashes, mix

QUEUE_BYTES = 64 << 20
BATCH = 1 << 19
RECURSE_SYMBOLS = 1024
DIRECT = 12  # symbols compared one by one


class TupleQueue:
    """Tuples (place, common prefix) by first symbol, in the order they came."""

    def __init__(self, symbols: int, memory: int = QUEUE_BYTES):
        self.parts: list[list] = [[] for _ in range(symbols)]
        self.memory, self.held, self.file = memory, 0, None

    def put(self, symbol: int, place: np.ndarray, prefix: np.ndarray) -> None:
        self.parts[symbol].append((place, prefix))
        self.held += place.nbytes + prefix.nbytes
        if self.held > self.memory:
            self.spill()

    def spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for parts in self.parts:
            for k, part in enumerate(parts):
                if isinstance(part[0], np.ndarray):
                    at = self.file.tell()
                    self.file.write(part[0].tobytes())
                    self.file.write(part[1].tobytes())
                    parts[k] = (at, len(part[0]))
        self.held = 0

    def read(self, part: tuple) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(part[0], np.ndarray):
            return part
        at, n = part
        self.file.seek(at)
        return (np.frombuffer(self.file.read(8 * n), np.int64), np.frombuffer(self.file.read(2 * n), np.int16))

    def batches(self, parts: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Parts in order, joined to batches."""
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for part in parts:
            place, prefix = self.read(part)
            if part[0] is place:
                self.held -= place.nbytes + prefix.nbytes
            for at in range(0, len(place), BATCH):
                held.append((place[at:at + BATCH], prefix[at:at + BATCH]))
                size += len(held[-1][0])
                if size >= BATCH:
                    yield tuple(map(np.concatenate, zip(*held)))
                    held, size = [], 0
        if held:
            yield tuple(map(np.concatenate, zip(*held)))

    def take(self, symbol: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The tuples of a symbol, also those put while they are taken."""
        while self.parts[symbol]:
            parts, self.parts[symbol] = self.parts[symbol], []
            yield from self.batches(parts)

    def backwards(self, symbol: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The tuples of a symbol in reverse order."""
        parts, self.parts[symbol] = self.parts[symbol], []
        while parts:
            group, size = [], 0
            while parts and size < BATCH:
                part = parts.pop()
                size += len(part[0]) if isinstance(part[0], np.ndarray) else part[1]
                group.append(part)
            both = [(p, c) for p, c in self.batches(group[::-1])]
            for place, prefix in reversed(both):
                yield place[::-1], prefix[::-1]


class Minima:
    """Range minima of an array."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 ** len(self.rows) <= len(values):
            row, half = self.rows[-1], 2 ** (len(self.rows) - 1)
            self.rows.append(np.minimum(row[:-half], row[half:]))
        self.flat = np.concatenate(self.rows)
        self.begin = np.cumsum([0] + [len(r) for r in self.rows])[:-1]

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        begin = self.begin[level]
        return np.minimum(self.flat[begin + first], self.flat[begin + last - (1 << level) + 1])


class Induction:
    """One direction: remembers, by symbol, the smallest prefix since its last tuple."""

    def __init__(self, text: np.ndarray, symbols: int, cap: int, out: TupleQueue):
        self.text, self.cap, self.out = text, cap, out
        self.since = np.full(symbols, cap, np.int16)
        self.begun = np.zeros(symbols, bool)

    def pass_on(self, place: np.ndarray, prefix: np.ndarray, wanted: Callable[[np.ndarray], np.ndarray]) -> None:
        """Put the suffixes left of ``place`` whose first symbols are ``wanted``.

        ``prefix`` is each suffix's common prefix with the one taken out before it.
        """
        before = self.text[np.maximum(place - 1, 0)]
        index = np.flatnonzero((place > 0) & wanted(before))
        whole = prefix.min()
        if not len(index):
            np.minimum(self.since, whole, out=self.since)
            return
        order = np.argsort(before[index], kind="stable")
        at = index[order]
        symbol = before[at]
        first = np.ones(len(at), bool)
        first[1:] = symbol[1:] != symbol[:-1]
        low = np.where(first, 0, np.concatenate([[0], at[:-1] + 1]))
        minima = Minima(prefix)
        least = minima.of(low, at)
        least = np.where(first, np.minimum(least, self.since[symbol]), least)
        carried = np.minimum(least + 1, self.cap).astype(np.int16)
        carried[first & ~self.begun[symbol]] = 0
        np.minimum(self.since, whole, out=self.since)
        bounds = np.append(np.flatnonzero(first), len(at))
        left = place[at] - 1
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            s, end = int(symbol[a]), int(at[b - 1])
            self.out.put(s, left[a:b], carried[a:b])
            self.since[s] = prefix[end + 1:].min() if end + 1 < len(prefix) else self.cap
            self.begun[s] = True


def star_places(text: np.ndarray) -> np.ndarray:
    """Places of the S* suffixes; the last symbol, smallest of all, is one."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    step = np.sign(np.diff(text.astype(np.int64)))
    last = np.where(step != 0, np.arange(n - 1), n)
    following = np.minimum.accumulate(last[::-1])[::-1]  # the next place where the symbol changes
    small = np.ones(n, bool)
    small[:-1] = step[np.minimum(following, n - 2)] > 0
    return np.flatnonzero(small[1:] & ~small[:-1]) + 1


def refined(rank: np.ndarray, member: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Ranks after the tied ``member`` items are told apart by ``key``; returns who is still tied.

    A rank is the number of smaller items.
    """
    own = rank[member]
    low, high = int(key.min(initial=0)), int(key.max(initial=0))
    if not own.any():
        order = np.argsort(key)
    elif (int(own.max()) + 1) * (high - low + 1) < 1 << 62:
        order = np.argsort(own * (high - low + 1) + (key - low))
    else:
        order = np.lexsort((key, own))
    own, keys = own[order], key[order]
    group = np.ones(len(order), bool)
    group[1:] = own[1:] != own[:-1]
    part = group.copy()
    part[1:] |= keys[1:] != keys[:-1]
    index = np.arange(len(order))
    begin = np.maximum.accumulate(np.where(group, index, 0))
    start = np.maximum.accumulate(np.where(part, index, 0))
    rank[member[order]] = own + (start - begin)
    alone = part & np.append(part[1:], True)
    return member[order[~alone]]


def star_order(text: np.ndarray, stars: np.ndarray, symbols: int, cap: int) -> np.ndarray:
    """The S* places in the order of their suffixes, by their first ``cap`` symbols at least."""
    n = len(stars)
    lengths = np.append(np.diff(stars) + 1, 1)
    bits = int(symbols + 1).bit_length()
    width = 63 // bits
    rank, tied, done = np.zeros(n, np.int64), np.arange(n), 0
    while len(tied):
        key = np.zeros(len(tied), np.int64)
        for k in range(done, done + width):
            inside = k < lengths[tied]
            symbol = text[np.minimum(stars[tied] + k, len(text) - 1)].astype(np.int64)
            key = (key << bits) | np.where(inside, symbol, symbols)  # the shorter of two is the larger
        tied = refined(rank, tied, key)
        done += width
        tied = tied[lengths[tied] >= done]  # one that ends here is not yet told from longer ones
    names = np.unique(rank, return_inverse=True)[1]
    distinct = int(names.max()) + 1
    if distinct == n:
        return stars[np.argsort(rank)]
    if distinct <= RECURSE_SYMBOLS and n > 4 * RECURSE_SYMBOLS:
        order = np.concatenate([place for place, _ in ordered(names, distinct, -(-cap // 2) + 1)])
        return stars[order]
    tied = np.flatnonzero(np.bincount(names)[names] > 1)
    reach = 1
    while len(tied) and reach <= cap:  # a name advances two symbols or more
        ahead = tied + reach
        tied = refined(rank, tied, np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1))
        reach *= 2
    return stars[np.argsort(rank, kind="stable")]


def prefixes(text: np.ndarray, order: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of each place of ``order`` with the one before it, up to ``cap``.

    The first symbols are compared one by one; pairs that agree in them are
    bisected with hashes of whole runs.
    """
    out = np.zeros(len(order), np.int16)
    n, hashes = len(text), None
    active = np.arange(1, len(order))
    for step in range(min(cap, DIRECT)):
        a, b = order[active] + step, order[active - 1] + step
        active = active[(np.maximum(a, b) < n) & (text[np.minimum(a, n - 1)] == text[np.minimum(b, n - 1)])]
        out[active] = step + 1
    for at in range(0, len(active), BATCH):
        hashes = hashes or Hashes(mix(text.astype(np.uint64) + np.uint64(1)))
        k = active[at:at + BATCH]
        a, b = order[k], order[k - 1]
        room = np.minimum(n - np.maximum(a, b), cap)
        same, bit = out[k].astype(np.int64), 1 << int(cap).bit_length()
        while bit:
            more = same + bit
            good = np.flatnonzero(more <= room)
            equal = hashes.of(a[good], a[good] + more[good]) == hashes.of(b[good], b[good] + more[good])
            same[good[equal]] += bit
            bit >>= 1
        out[k] = same
    return out


def run_length(text: np.ndarray, place: int, cap: int) -> int:
    part = text[place:place + cap]
    other = np.flatnonzero(part != part[0])
    return int(other[0]) if len(other) else len(part)


def ordered(text: np.ndarray, symbols: int, cap: int, memory: int = QUEUE_BYTES
            ) -> list[tuple[np.ndarray, np.ndarray]]:
    """Suffixes in ascending order as parts (places, common prefixes with the one before)."""
    return list(reversed([(p[::-1], c[::-1]) for p, c in descending(text, symbols, cap, memory)]))


def descending(text: np.ndarray, symbols: int, cap: int, memory: int = QUEUE_BYTES
               ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes from the largest on: (places, common prefix with the next smaller one).

    The last symbol of ``text`` is 0 and stands nowhere else.
    """
    stars = star_order(text, star_places(text), symbols, cap)
    shared = prefixes(text, stars, cap)
    first = text[stars]
    bounds = np.searchsorted(first, np.arange(symbols + 1))
    run = lambda place: run_length(text, int(place), cap)

    larger, done = TupleQueue(symbols, memory), TupleQueue(symbols, memory)
    up = Induction(text, symbols, cap, larger)
    last_of = np.full(symbols, -1, np.int64)
    for c in range(symbols):
        for place, prefix in larger.take(c):
            up.pass_on(place, prefix, lambda before: before >= c)
            done.put(c, place, prefix)
            last_of[c] = place[-1]
        for at in range(bounds[c], bounds[c + 1], BATCH):
            stop = min(at + BATCH, bounds[c + 1])
            place, prefix = stars[at:stop], shared[at:stop].copy()
            if at == bounds[c]:
                prefix[0] = min(run(last_of[c]), run(place[0])) if last_of[c] >= 0 else 0
            up.pass_on(place, prefix, lambda before: before > c)

    smaller = TupleQueue(symbols, memory)
    down = Induction(text, symbols, cap, smaller)
    for c in range(symbols - 1, -1, -1):
        pending: tuple[np.ndarray, np.ndarray] | None = None  # prefixes with the next smaller one come late
        lowest = -1
        for place, prefix in smaller.take(c):
            down.pass_on(place, prefix, lambda before: before <= c)
            if pending:
                yield pending[0], np.append(pending[1][1:], prefix[0])
            pending, lowest = (place, prefix), place[-1]
        fresh = True
        border = 0
        carry = border
        for place, prefix in done.backwards(c):
            if fresh:
                border = min(run(lowest), run(place[0])) if lowest >= 0 else 0
                if pending:
                    yield pending[0], np.append(pending[1][1:], border).astype(np.int16)
                    pending = None
                carry, fresh = border, False
            above = np.append(carry, prefix[:-1]).astype(np.int16)  # with the next larger one
            down.pass_on(place, above, lambda before: before < c)
            carry = prefix[-1]
            yield place, prefix
        if pending:
            yield pending[0], np.append(pending[1][1:], 0).astype(np.int16)
        if c == 0:
            yield np.array([len(text) - 1]), np.zeros(1, np.int16)


def repeated_starts(strings: list[bytes], window: int, memory: int = QUEUE_BYTES) -> list[np.ndarray]:
    """For each string, the starts of its windows that start elsewhere in the strings too."""
    sizes = np.array(list(map(len, strings)), np.int64)
    text = np.zeros(int(sizes.sum()) + len(strings) + 1, np.uint16)
    begin = np.cumsum(sizes + 1) - sizes - 1
    raw = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    text[:-1] = raw
    text[:-1] += 2
    text[begin + sizes] = 1
    twice = np.zeros(len(text), bool)
    held, link = -1, 0
    for place, prefix in descending(text, 258, window, memory):
        if link >= window:
            twice[held] = twice[place[0]] = True
        near = prefix[:-1] >= window
        twice[place[:-1][near]] = True
        twice[place[1:][near]] = True
        held, link = place[-1], prefix[-1]
    return [np.flatnonzero(twice[b:b + max(0, n - window + 1)]) for b, n in zip(begin.tolist(), sizes.tolist())]
