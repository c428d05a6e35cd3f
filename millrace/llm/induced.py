"""Suffix arrays by external induced sorting, in rounds of numpy operations.

A text is a row of whole numbers that ends with a 0 found nowhere else. The recursion: suffixes
that begin at a left-most S place are told apart by the piece up to the next such place, the
ranks of these pieces are a shorter text, and its suffix array orders these suffixes. Two sweeps
induce the rest: upwards, a suffix hands its left neighbour to the queue if that one is of type L;
downwards, of type S.

The priority queue is a row of lanes, a lane a range of first characters. What enters a lane comes
in the order of the suffixes that hand it over, so a lane is read once, and sorting it by first
character alone (stably) orders it. Tuples carry the place and the common prefix with the tuple
before them, cut off at `depth`: it is one more than the least common prefix between the suffixes
that handed them over.

What has more than `memory` entries lies in the task's own scratch files, which vanish when they are
closed and which nothing else reads: the text, its types, the starts and their names, the queue, and
the results of both sweeps and of the whole. Memory holds one lane, or one block of these, at a
time; a lane is at least one character, so the commonest one's suffixes must fit.
"""

from __future__ import annotations

import tempfile

import numpy as np

LANES = 48
MEMORY = 1 << 25


class Scratch:
    """Arrays, in nameless files if they have more than `memory` entries."""

    def __init__(self, memory: int):
        self.memory = max(memory, 16)

    def array(self, size: int, kind) -> np.ndarray:
        if size <= self.memory:
            return np.empty(size, dtype=kind)
        file = tempfile.TemporaryFile()
        file.truncate(size * np.dtype(kind).itemsize)
        return np.memmap(file, dtype=kind, mode="r+", shape=(size,))

    def blocks(self, size: int) -> list[tuple[int, int]]:
        """Ranges of so many entries as memory holds."""
        return [(a, min(a + self.memory, size)) for a in range(0, size, self.memory)]

    def counts(self, values, size: int) -> np.ndarray:
        """How often each number below `size` occurs; values(a, b) gives the a-th to b-th of them."""
        total = np.zeros(0, dtype=np.int64)
        for a, b in self.blocks(size):
            own = np.bincount(values(a, b))
            if len(own) > len(total):
                own[: len(total)] += total
                total = own
            else:
                total[: len(own)] += own
        return total


class LaneQueue:
    """Lanes of tuples (place, prefix) that are filled in order and read once."""

    def __init__(self, lanes: int, memory: int):
        self.held: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(lanes)]
        self.files: list[list] = [[] for _ in range(lanes)]
        self.count, self.memory = 0, memory

    def push(self, lane: int, places: np.ndarray, prefixes: np.ndarray) -> None:
        self.held[lane].append((places, prefixes))
        self.count += len(places)
        if self.count > self.memory:
            self._spill()

    def _spill(self) -> None:
        for lane, parts in enumerate(self.held):
            for places, prefixes in parts:
                file = tempfile.TemporaryFile()
                places.tofile(file)
                prefixes.tofile(file)
                self.files[lane].append((file, len(places), places.dtype, prefixes.dtype))
            parts.clear()
        self.count = 0

    def pop(self, lane: int) -> tuple[np.ndarray, np.ndarray]:
        parts = []
        for file, size, kind, other in self.files[lane]:
            with file:
                file.seek(0)
                parts.append((np.fromfile(file, kind, size), np.fromfile(file, other, size)))
        self.count -= sum(len(p[0]) for p in self.held[lane])
        parts += self.held[lane]
        self.files[lane], self.held[lane] = [], []
        if not parts:
            return np.zeros(0, np.int32), np.zeros(0, np.uint8)
        return tuple(np.concatenate([p[i] for p in parts]) for i in (0, 1))


def s_types(text: np.ndarray, scratch: Scratch) -> np.ndarray:
    """Whether each suffix is smaller than its right neighbour; the last one counts as such."""
    n = len(text)
    out, after = scratch.array(n, bool), True
    for a, b in reversed(scratch.blocks(n)):
        part = text[a : min(b + 1, n)].astype(np.int32, copy=False)
        turn = np.flatnonzero(part[1:] != part[:-1])  # the last place of each run of the block
        rising = part[turn] < part[turn + 1]
        lengths = np.diff(np.concatenate(([-1], turn, [b - a - 1])))
        out[a:b] = np.repeat(np.append(rising, after), lengths)
        after = bool(out[a])
    return out


def _left_most(kinds: np.ndarray, scratch: Scratch) -> np.ndarray:
    """The places of type S whose left neighbour is of type L."""
    n = len(kinds)

    def found(a: int, b: int) -> np.ndarray:
        low = max(a, 1)
        return low + np.flatnonzero(kinds[low:b] & ~kinds[low - 1 : b - 1])

    sizes = [len(found(a, b)) for a, b in scratch.blocks(n)]
    out, at = scratch.array(sum(sizes), np.int32 if n < 1 << 31 else np.int64), 0
    for (a, b), size in zip(scratch.blocks(n), sizes, strict=True):
        out[at : at + size] = found(a, b)
        at += size
    return out


def _range_minima(values: np.ndarray) -> list[np.ndarray]:
    table, width = [values], 1
    while 2 * width <= len(values):
        table.append(np.minimum(table[-1][:-width], table[-1][width:]))
        width *= 2
    return table


def _least(table: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of values[low:high] for each of the ranges, none of which is empty."""
    level = np.frexp(high - low)[1] - 1
    out = np.empty(len(low), dtype=table[0].dtype)
    for k in np.unique(level).tolist():
        at = level == k
        out[at] = np.minimum(table[k][low[at]], table[k][high[at] - (1 << k)])
    return out


def _bounds(text: np.ndarray, lanes: int, scratch: Scratch) -> np.ndarray:
    """First characters of the lanes, which hold about equally many places each."""
    counts = scratch.counts(lambda a, b: text[a:b], len(text))
    share = np.cumsum(counts) * lanes // max(len(text), 1)
    return np.concatenate(([0], np.flatnonzero(np.diff(share)) + 1, [len(counts)]))


def _words_at(text: np.ndarray, scratch: Scratch) -> np.ndarray:
    """The eight bytes from each place of a text of bytes, as one number; zeros follow the text."""
    padded = scratch.array(len(text) + 8, np.uint8)
    padded[:-8], padded[-8:] = text, 0
    return np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), shape=(len(text) + 1,), strides=(1,))


def common_prefixes(words: np.ndarray, one: np.ndarray, two: np.ndarray, depth: int) -> np.ndarray:
    """Common prefixes, up to `depth`, of the suffixes at different places one and two. The text
    ends with a character found nowhere else, so they end before the text does."""
    n = len(words) - 1
    out = np.zeros(len(one), dtype=np.uint8)
    live, done = np.arange(len(one)), 0
    while len(live) and done < depth:
        differing = words[np.minimum(one[live] + done, n)] ^ words[np.minimum(two[live] + done, n)]
        same = np.bitwise_count((differing & (~differing + np.uint64(1))) - np.uint64(1)) >> 3
        out[live] = np.minimum(done + same, depth)
        live = live[differing == 0]
        done += 8
    return out


class Sweep:
    """One sweep over all lanes. Upwards it induces L suffixes, downwards S suffixes; downwards all
    orders are turned round, so that both sweeps read alike. With a depth of 0 there are no
    prefixes."""

    def __init__(self, text: np.ndarray, kinds: np.ndarray, down: bool, depth: int, scratch: Scratch, words=None):
        self.text, self.kinds, self.down, self.depth, self.words = text, kinds, down, depth, words
        self.bounds = _bounds(text, max(2, min(LANES, len(text) >> 15), min(1 << 15, 4 * len(text) // scratch.memory)), scratch)
        self.lanes = len(self.bounds) - 1
        self.lane_of = np.repeat(np.arange(self.lanes, dtype=np.uint8 if self.lanes < 256 else np.uint16), np.diff(self.bounds))
        self.queue = LaneQueue(self.lanes, scratch.memory)
        #: least common prefix met since a suffix was last handed to each character
        self.low = np.full(int(self.bounds[-1]) if depth else 0, -1, dtype=np.int16)  # -1: none yet

    def _order(self, chars: np.ndarray, lane: int) -> np.ndarray | None:
        """A stable order by first character; None where the lane has but one."""
        low, high = int(self.bounds[lane]), int(self.bounds[lane + 1]) - 1
        if low == high:
            return None
        within = (high - chars if self.down else chars - low) if chars.dtype != np.uint8 else (
            np.uint8(high) - chars if self.down else chars - np.uint8(low))
        return np.argsort(within.astype(np.uint8 if high - low < 256 else np.uint16 if high - low < 1 << 16 else np.int64), kind="stable")

    def run(self, seeds: list[tuple[np.ndarray, np.ndarray]]):
        """Yields, lane by lane, the induced places with their prefixes, in the sweep's order.
        seeds: per lane the places that stand after the induced ones of the same character, in
        the sweep's order, with their prefixes."""
        for lane in range(self.lanes - 1, -1, -1) if self.down else range(self.lanes):
            yield self._lane(lane, *self.queue.pop(lane), *seeds[lane])

    def _sorted(self, places: np.ndarray, lane: int) -> np.ndarray:
        order = self._order(self.text[places], lane)
        return places if order is None else places[order]

    def _with_runs(self, base: np.ndarray, lane: int) -> np.ndarray:
        """The places with those that they induce before the same character, and these in turn,
        each after the places that induced them; by character."""
        parts, front = [base], base
        while len(front):
            left = np.maximum(front - 1, 0)
            front = left[(front > 0) & (self.kinds[left] == self.down) & (self.text[left] == self.text[front])]
            parts.append(front)
        return base if len(parts) < 3 else self._sorted(np.concatenate(parts), lane)

    def _lane(self, lane, places, prefixes, seed, seed_prefixes):
        order = self._order(self.text[places], lane)
        if order is not None:
            places, prefixes = places[order], prefixes[order] if self.depth else prefixes
        inner = places[:0]
        while True:
            # the places from other lanes come first, by character; those induced in this lane follow
            own = self._with_runs(self._sorted(np.concatenate((places, inner)), lane) if len(inner) else places, lane)
            line = np.concatenate((own, seed))
            line_order = self._order(self.text[line], lane)
            if line_order is not None:
                line = line[line_order]
            chars = self.text[line]
            left = np.maximum(line - 1, 0)
            at = np.flatnonzero((line > 0) & (self.kinds[left] == self.down))
            handed = left[at]
            handed_chars = self.text[handed]
            inside = self.lane_of[handed_chars] == lane
            more = handed[inside & (handed_chars != chars[at])]
            if np.array_equal(more, inner):
                break
            inner = more
        if not self.depth:
            self._push(handed, np.zeros(0, np.uint8), handed_chars, inside)
            return own, prefixes
        size = len(line)
        where = np.arange(size) if line_order is None else line_order
        induced = where < len(own)
        first = np.ones(size, dtype=bool)
        first[1:] = chars[1:] != chars[:-1]
        # what came from other lanes stands first of its character, in the order in which it came
        counts = np.bincount(self.text[places] - self.text.dtype.type(self.bounds[lane]), minlength=int(self.bounds[lane + 1] - self.bounds[lane]))
        heads = np.flatnonzero(first)
        rank = np.arange(size) - heads[np.cumsum(first) - 1] if size else np.arange(0)
        came = rank < counts[chars - self.text.dtype.type(self.bounds[lane])]
        line_prefixes = np.empty(size, dtype=np.uint8)
        line_prefixes[came] = prefixes
        line_prefixes[~induced] = seed_prefixes if line_order is None else seed_prefixes[where[~induced] - len(own)]
        # those that this lane induces, and the first seed after an induced one, are compared
        new = (induced & ~came) | np.concatenate(([False], induced[1:] != induced[:-1])) if size else induced
        new = np.flatnonzero(new & ~first)
        line_prefixes[new] = common_prefixes(self.words, line[new - 1], line[new], self.depth)
        line_prefixes[first] = 0
        handed_prefixes = self._handed_prefixes(line_prefixes, *self._ranges(at, handed_chars))
        self._push(handed, handed_prefixes, handed_chars, inside)
        if size:
            self.low = np.where(self.low < 0, -1, np.minimum(self.low, line_prefixes.min())).astype(np.int16)
            after = np.minimum.accumulate(np.append(line_prefixes[1:], np.uint8(self.depth))[::-1])[::-1]
            self.low[handed_chars] = after[at]  # the last one of a character stays
        return own, line_prefixes[induced]

    def _ranges(self, at: np.ndarray, chars: np.ndarray):
        """For what is handed over, by character: the line's stretch since the one before it."""
        order = np.argsort(chars, kind="stable")
        sorted_at, sorted_chars = at[order], chars[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = sorted_chars[1:] != sorted_chars[:-1]
        start = np.where(new, 0, np.concatenate(([-1], sorted_at[:-1]))[: len(order)] + 1)
        return order, sorted_chars, new, start, sorted_at + 1

    def _handed_prefixes(self, prefixes, order, chars, new, start, end) -> np.ndarray:
        if not len(order):
            return np.zeros(0, np.uint8)
        least = _least(_range_minima(prefixes), start, end).astype(np.int16)
        least[new] = np.minimum(least[new], self.low[chars[new]])
        out = np.empty(len(order), dtype=np.uint8)
        out[order] = np.minimum(least + 1, self.depth)
        return out

    def _push(self, handed, prefixes, chars, inside) -> None:
        """Hand what belongs to other lanes to the queue."""
        away = np.flatnonzero(~inside)
        lanes = self.lane_of[chars[away]]
        order = np.argsort(lanes, kind="stable")
        counts = np.bincount(lanes, minlength=self.lanes)
        ends = np.cumsum(counts)
        for lane in np.flatnonzero(counts).tolist():
            take = away[order[ends[lane] - counts[lane] : ends[lane]]]
            self.queue.push(lane, handed[take], prefixes[take] if self.depth else prefixes)


def suffix_array(text: np.ndarray, depth: int = 0, memory: int = MEMORY) -> tuple[np.ndarray, np.ndarray]:
    """(places in order, common prefix with the one before, at most `depth`). With a depth of 0
    there are no prefixes; else the text is one of bytes."""
    n, scratch = len(text), Scratch(memory)
    kinds = s_types(text, scratch)
    words = _words_at(text, scratch) if depth else None
    starts = _left_most(kinds, scratch)
    kind = starts.dtype
    seeds = _sorted_starts(text, starts, scratch)
    seed_prefixes = scratch.array(len(seeds) if depth else 0, np.uint8)
    for a, b in scratch.blocks(len(seed_prefixes)):
        low = max(a, 1)
        seed_prefixes[a:low] = 0
        seed_prefixes[low:b] = common_prefixes(words, seeds[low - 1 : b - 1], seeds[low:b], depth)
    smaller = sum(int(np.count_nonzero(kinds[a:b])) for a, b in scratch.blocks(n))

    up = Sweep(text, kinds, False, depth, scratch, words)
    l_places, l_prefixes = _joined(up.run(_by_lane(text, seeds, seed_prefixes, up, scratch)), n - smaller, kind, depth, scratch)
    down = Sweep(text, kinds, True, depth, scratch, words)
    s_places, s_prefixes = _joined(down.run(_by_lane(text, l_places, l_prefixes, down, scratch)), smaller - 1, kind, depth, scratch)
    del up, down, seeds
    return _merged(text, kinds, (l_places, l_prefixes), (s_places, s_prefixes), depth, words, scratch)


def _merged(text, kinds, large, small, depth: int, words, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """Both types in one order: by first character the L suffixes come before the S suffixes; the end
    comes first of all. large: in order; small: in falling order."""
    n = len(text)
    places, prefixes = scratch.array(n, large[0].dtype), scratch.array(n if depth else 0, np.uint8)
    places[0] = n - 1
    prefixes[:1] = 0
    s_count = len(small[0])
    l_ends, s_ends = (np.cumsum(scratch.counts(
        lambda a, b, want=want: text[a : min(b, n - 1)][kinds[a : min(b, n - 1)] == want], n)) for want in (False, True))
    width = max(len(l_ends), len(s_ends), 1)
    l_ends, s_ends = (np.append(x, np.full(width - len(x), x[-1] if len(x) else 0)) for x in (l_ends, s_ends))
    # whole characters at a time, as many as memory holds
    cuts = np.append(np.flatnonzero(np.diff((l_ends + s_ends) // scratch.memory)), width - 1)
    l_from = s_from = 0
    for cut in cuts.tolist():
        l_to, s_to = int(l_ends[cut]), int(s_ends[cut])
        low, high = s_count - s_to, s_count - s_from
        own = np.concatenate((large[0][l_from:l_to], small[0][low:high][::-1]))
        chars = text[own]
        order = np.argsort(chars, kind="stable")
        out = slice(1 + l_from + s_from, 1 + l_to + s_to)
        places[out] = own[order]
        if depth and len(own):
            # a falling order's prefixes belong to the place before
            turned = small[1][low + 1 : high + 1]
            turned = np.append(turned, np.zeros(high - low - len(turned), np.uint8))[::-1]
            joined = np.concatenate((large[1][l_from:l_to], turned))[order]
            own, chars = own[order], chars[order]
            is_small = kinds[own]
            first = np.ones(len(own), dtype=bool)
            first[1:] = chars[1:] != chars[:-1]
            joined[first] = 0
            seam = np.flatnonzero(~first[1:] & (is_small[1:] != is_small[:-1])) + 1
            joined[seam] = common_prefixes(words, own[seam - 1], own[seam], depth)
            prefixes[out] = joined
        l_from, s_from = l_to, s_to
    return places, prefixes


def _joined(parts, size: int, kind, depth: int, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """A sweep's results, lane after lane."""
    places, prefixes, at = scratch.array(size, kind), scratch.array(size if depth else 0, np.uint8), 0
    for own, own_prefixes in parts:
        places[at : at + len(own)] = own
        if depth:
            prefixes[at : at + len(own)] = own_prefixes
        at += len(own)
    return places, prefixes


def _by_lane(text, places, prefixes, sweep: Sweep, scratch: Scratch):
    """Per lane the places, which are in order, and prefixes in the sweep's order."""
    counts = scratch.counts(lambda a, b: sweep.lane_of[text[places[a:b]]], len(places))
    ends = np.append(np.cumsum(counts), np.full(sweep.lanes - len(counts), len(places))).tolist()

    class Lanes:
        def __getitem__(self, lane: int) -> tuple[np.ndarray, np.ndarray]:
            a, b = ends[lane - 1] if lane else 0, ends[lane]
            if not sweep.down:
                return np.asarray(places[a:b]), np.asarray(prefixes[a:b])
            turned = prefixes[a + 1 : b + 1] if sweep.depth else prefixes
            if sweep.depth and len(turned) < b - a:
                turned = np.append(turned, np.uint8(0))
            return np.asarray(places[a:b])[::-1], np.asarray(turned)[::-1]

    return Lanes()


def _names(text: np.ndarray, starts: np.ndarray, scratch: Scratch) -> tuple[np.ndarray, int]:
    """The rank of each left-most S place's piece, and how many there are. Pieces are ranked by first
    character, as many characters at a time as memory holds pieces of."""
    m, n = len(starts), len(text)
    names = scratch.array(m, np.int32)
    ends = np.cumsum(scratch.counts(lambda a, b: text[starts[a:b]], m))
    cuts = [-1, *np.flatnonzero(np.diff(ends // scratch.memory)).tolist(), len(ends) - 1]
    total, wide = 0, 8 if text.max(initial=0) < 255 else 2
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        parts = []
        for a, b in scratch.blocks(m):
            chars = text[starts[a:b]]
            parts.append(a + np.flatnonzero((chars > low) & (chars <= high)))
        own = np.concatenate(parts)
        if len(own):
            after = np.minimum(own + 1, m - 1)
            ends_at = np.where(own + 1 < m, starts[after].astype(np.int64) + 1, n)
            names[own], count = _piece_ranks(text, np.asarray(starts[own]), ends_at, wide)
            names[own] += total
            total += count
    return names, total


def _piece_ranks(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, wide: int) -> tuple[np.ndarray, int]:
    """The rank of each piece: the characters from a left-most S place up to and with the next one.
    A piece is at most as long as it is between places, so blocks of `wide` characters refine the ranks."""
    n, sizes = len(text), ends - starts
    bits = 64 // wide
    ranks, live, block = np.zeros(len(starts), dtype=np.int64), np.arange(len(starts)), 0
    while len(live):
        key = np.zeros(len(live), dtype=np.uint64)
        for k in range(wide):
            at = starts[live] + block * wide + k
            inside = at < ends[live]
            # what goes on where another piece has ended, in type S, goes on in type L: it is smaller
            char = np.where(inside, text[np.minimum(at, n - 1)].astype(np.uint64), np.uint64((1 << bits) - 1))
            key = (key << np.uint64(bits)) | char
        order = np.lexsort((key, ranks[live]))
        sorted_live, sorted_key, sorted_rank = live[order], key[order], ranks[live][order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (sorted_key[1:] != sorted_key[:-1]) | (sorted_rank[1:] != sorted_rank[:-1])
        head = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        rank_first = np.ones(len(order), dtype=bool)
        rank_first[1:] = sorted_rank[1:] != sorted_rank[:-1]
        begin = np.maximum.accumulate(np.where(rank_first, np.arange(len(order)), 0))
        ranks[sorted_live] = sorted_rank + head[group] - begin
        tie = np.bincount(group)[group] > 1
        # a piece that ends with the block shows its end in the next one
        live = sorted_live[tie & (sizes[sorted_live] >= (block + 1) * wide)]
        live.sort()
        block += 1
    distinct, names = np.unique(ranks, return_inverse=True)
    return names, len(distinct)


def _sorted_starts(text: np.ndarray, starts: np.ndarray, scratch: Scratch) -> np.ndarray:
    """Left-most S places in the order of their suffixes."""
    m = len(starts)
    if m <= 1:
        return starts
    names, count = _names(text, starts, scratch)
    out = scratch.array(m, starts.dtype)
    if count == m:
        for a, b in scratch.blocks(m):
            out[names[a:b]] = starts[a:b]
        return out
    # the last piece is the end, whose name is smaller than all others and found nowhere else
    order = suffix_array(names, 0, scratch.memory)[0]
    for a, b in scratch.blocks(m):
        out[a:b] = starts[order[a:b]]
    return out
