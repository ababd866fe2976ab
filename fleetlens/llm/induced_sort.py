"""External induced sorting of suffixes, with common-prefix values.

Suffixes smaller than their neighbours on both sides (LMS) are named by their substrings and put in order by recursion on
the names; two scans induce the order of all others from them. A scan is a run of a priority queue: what is popped under
one symbol is pushed, one symbol longer, under the symbol before it. In the last scans entries are (position, prefix
shared with the entry pushed before), where the prefix is one more than the smallest such value popped in between.

Nothing that grows with the text is bound to memory: queues write their blocks to a scratch file beyond a budget, arrays
that are longer than the budget are maps of scratch files, and everything is worked through in chunks. Only counts per
symbol are held. Recursion ends where a text is small enough to be sorted by prefix doubling. Scratch files have no name
and end with their task.
"""

import tempfile
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np

#: Entries worked on at once.
CHUNK = 1 << 17
#: A queue over a large alphabet has about so many keys, each for a range of symbols.
RANGES = 64
#: Entries of a range that bring others into it, over more steps than this, are worked through piece by piece.
DEPTH = 64


def scratch(n: int, dtype, budget: int) -> np.ndarray:
    """An array of zeros; beyond the budget of bytes it is a map of a scratch file."""
    size = n * np.dtype(dtype).itemsize
    if size <= budget or not n:
        return np.zeros(n, dtype)
    with tempfile.TemporaryFile() as file:
        file.truncate(size)
        return np.asarray(np.memmap(file, dtype, "r+", shape=(n,)))


class Growing:
    """An array that is appended to: in memory up to the budget, then in a scratch file."""

    def __init__(self, dtype, budget: int):
        self.dtype, self.budget, self.parts, self.held, self.file = np.dtype(dtype), budget, [], 0, None

    def append(self, values: np.ndarray) -> None:
        values = np.ascontiguousarray(values, self.dtype)
        self.parts.append(values)
        self.held += values.nbytes
        if self.held > self.budget:
            if self.file is None:
                self.file = tempfile.TemporaryFile()  # noqa: SIM115  ends with the array
            for p in self.parts:
                self.file.write(p.data)
            self.parts, self.held = [], 0

    def array(self) -> np.ndarray:
        if self.file is None:
            return np.concatenate(self.parts) if self.parts else np.zeros(0, self.dtype)
        for p in self.parts:
            self.file.write(p.data)
        self.file.flush()
        return np.asarray(np.memmap(self.file, self.dtype, "r"))


class BlockQueue:
    """Blocks of pairs of arrays under keys, taken from either end of a key; on disk beyond a budget of bytes."""

    def __init__(self, budget: int):
        self.budget, self.blocks, self.held, self.spilled, self.file = budget, {}, 0, 0, None

    def push(self, key: int, first: np.ndarray, second: np.ndarray) -> None:
        if not len(first):
            return
        self.blocks.setdefault(key, deque()).append((first, second))
        self.held += first.nbytes + second.nbytes
        if self.held > self.budget:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()  # noqa: SIM115  ends with the queue
        self.file.seek(0, 2)
        at = self.file.tell()
        for parts in self.blocks.values():
            live = [p for p in parts if isinstance(p[0], np.ndarray)]
            if not live:
                continue
            a, b = (np.concatenate([p[k] for p in live]) for k in (0, 1))
            done = [p for p in parts if not isinstance(p[0], np.ndarray)]
            parts.clear()
            parts.extend(done)  # what is on disk is older than what is not
            for k in range(0, len(a), CHUNK):
                x, y = a[k : k + CHUNK], b[k : k + CHUNK]
                self.file.write(x.data)
                self.file.write(y.data)
                parts.append((at, len(x), len(y), x.dtype, y.dtype))
                at += x.nbytes + y.nbytes
                self.spilled += x.nbytes + y.nbytes
        self.held = 0

    def _load(self, part):
        if isinstance(part[0], np.ndarray):
            self.held -= part[0].nbytes + part[1].nbytes
            return part
        at, n, m, ka, kb = part
        self.file.seek(at)
        return np.frombuffer(self.file.read(n * ka.itemsize), ka), np.frombuffer(self.file.read(m * kb.itemsize), kb)

    def take(self, key: int, most: int = CHUNK, last: bool = False):
        """About `most` pairs from the front of a key (last: from its end, still in the order pushed), or None."""
        parts = self.blocks.get(key)
        if not parts:
            return None
        got, n = [], 0
        while parts and n < most:
            got.append(self._load(parts.pop() if last else parts.popleft()))
            n += len(got[-1][0])
        if last:
            got.reverse()
        return got[0] if len(got) == 1 else tuple(np.concatenate([g[k] for g in got]) for k in (0, 1))

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def small_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling, in memory."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    n, step = len(text), 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        pair = rank * (n + 2) + after
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        new = np.zeros(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(pair[1:] != pair[:-1])])
        rank, step = new, step * 2
        if rank.max() == n - 1 or step >= n:
            return order


def least_in(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest of values[a:b] for each pair (a < b)."""
    level = np.frexp((b - a).astype(np.float64))[1] - 1
    rows = [values]
    for k in range(int(level.max(initial=0))):
        half = 1 << k
        rows.append(np.append(np.minimum(rows[-1][:-half], rows[-1][half:]), rows[-1][-half:]))
    table = np.stack(rows)
    return np.minimum(table[level, a], table[level, b - (1 << level)])


class _Ordered:
    """Chunks of positions in scan order, handed out up to a key."""

    def __init__(self, chunks: Iterable[np.ndarray], key_of):
        self.chunks, self.key_of, self.pos, self.keys = iter(chunks), key_of, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def upto(self, key: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(keys, positions) with keys of at most `key`, in pieces."""
        while True:
            if not len(self.pos):
                self.pos = next(self.chunks, None)
                if self.pos is None:
                    self.pos = np.zeros(0, np.int64)
                    return
                self.pos = self.pos.astype(np.int64)
                self.keys = self.key_of(self.pos)
                continue
            n = int(np.searchsorted(self.keys, key, "right"))
            if not n:
                return
            yield self.keys[:n], self.pos[:n]
            self.keys, self.pos = self.keys[n:], self.pos[n:]


def within(code: np.ndarray, place: np.ndarray, end: int, before, depth: int = DEPTH):
    """A range's entries (in the order of their codes) with all that they bring into it, in scan order: codes, places, and
    the keys and places of what goes on to later ranges. None if it takes more than `depth` steps.

    What is new under a code comes after what stood there, in the order of what brought it. So ranks are right for pairs of
    which one stood there, then for pairs of which one was brought by such an entry, and so on: a sort for each step, or
    until nothing moves.
    """
    codes, places, sources, on, base = [code], [place], [np.full(len(code), -1)], [], 0
    while True:
        ok, pred, keys = before(places[-1])
        inside = keys <= end
        on.append((base + ok[~inside], keys[~inside], pred[~inside]))
        if not inside.any():
            break
        if len(codes) > depth:
            return None
        base += len(places[-1])
        sources.append(base - len(places[-1]) + ok[inside])
        codes.append(keys[inside] * 2)
        places.append(pred[inside])
    from_, keys, preds = (np.concatenate([x[k] for x in on]) for k in range(3))
    if len(codes) > 1:
        code, place, source = np.concatenate(codes), np.concatenate(places), np.concatenate(sources)
        n = len(code)
        new = np.flatnonzero(source >= 0)
        key, among, rank = code * 2, np.arange(n), np.zeros(n, np.int64)
        key[new] += 1
        for _ in range(len(codes)):
            order, last = np.argsort(key * n + among, kind="stable"), rank
            rank = np.empty(n, np.int64)
            rank[order] = np.arange(n)
            if np.array_equal(rank, last):
                break
            among[new] = rank[source[new]]
        code, place, from_ = code[order], place[order], rank[from_]
        order = np.argsort(from_, kind="stable")
        keys, preds = keys[order], preds[order]
    return code, place, keys, preds


class Level:
    """Order of the suffixes of a text of whole numbers, whose last symbol is 0 and stands nowhere else."""

    def __init__(self, text: np.ndarray, budget: int, small: int):
        self.text, self.budget, self.small, self.spilled = text, budget, small, 0
        self.n = n = len(text)
        self.index = np.int32 if n < 1 << 31 else np.int64
        self.smaller = scratch(n, bool, budget)
        self.counts = np.zeros(1, np.int64)
        lms, after, right = [], True, 0
        for a in range((n - 1) // CHUNK * CHUNK, -1, -CHUNK):
            b = min(a + CHUNK, n)
            now = text[a:b].astype(np.int64)
            found = np.bincount(now, minlength=len(self.counts))
            found[: len(self.counts)] += self.counts
            self.counts = found
            step = np.sign(np.append(now[1:], right) - now)
            if b == n:
                step[-1] = 1  # the end is the smallest suffix
            next_ = np.where(step != 0, np.arange(b - a), b - a)
            next_ = np.minimum.accumulate(next_[::-1])[::-1]
            kind = np.append(step > 0, after)[next_]
            self.smaller[a:b] = kind
            if b < n and self.smaller[b] and not kind[-1]:
                lms.append(np.array([b], self.index))
            lms.append((np.flatnonzero(kind[1:] & ~kind[:-1])[::-1] + a + 1).astype(self.index))
            after, right = bool(kind[0]), int(now[0])
        ordered = Growing(self.index, budget)
        for part in reversed(lms):
            ordered.append(part[::-1])
        self.lms = ordered.array()
        self.number = None  # of the LMS position at a place of the text, while names are given
        self.top = len(self.counts) - 1

    # ------------------------------------------------------------ order alone

    def _ranges(self, down: bool) -> np.ndarray:
        """First keys of the queue's ranges: about n / RANGES entries each, or what the budget holds."""
        counts = self.counts[::-1] if down else self.counts
        each = max(1, min(self.n // RANGES, self.budget // 16))
        part = np.cumsum(counts) // each
        begins = np.concatenate([[True], part[1:] != part[:-1]])
        begins |= counts > each
        begins[1:] |= counts[:-1] > each
        return np.flatnonzero(begins)

    def scan(self, seeds: Iterable[np.ndarray], want: bool) -> Iterator[np.ndarray]:
        """Positions of the wanted kind in scan order: ascending for those larger than their neighbour (want False),
        descending for smaller ones. seeds: the other kind's positions, in scan order."""
        key_of = (lambda p: self.top - self.text[p].astype(np.int64)) if want else (lambda p: self.text[p].astype(np.int64))
        firsts = self._ranges(want)
        ends = np.append(firsts[1:], self.top + 1) - 1
        queue, given = BlockQueue(self.budget), _Ordered(seeds, key_of)

        def before(pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Which positions have a predecessor of the wanted kind, that predecessor and its key."""
            ok = np.flatnonzero((pos > 0) & (self.smaller[pos - 1] == want))
            return ok, pos[ok] - 1, key_of(pos[ok] - 1)

        def push(keys: np.ndarray, pos: np.ndarray) -> None:
            at = np.searchsorted(firsts, keys, "right") - 1
            order = np.argsort(at.astype(np.int16 if len(firsts) < 1 << 15 else np.int64), kind="stable")
            at, keys, pos = at[order], keys[order].astype(self.index), pos[order].astype(self.index)
            edges = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.zeros(0, np.int64)
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(at)], strict=False):
                queue.push(int(at[a]), keys[a:b], pos[a:b])

        for k, (first, end) in enumerate(zip(firsts.tolist(), ends.tolist(), strict=True)):
            if first == end:
                while (block := queue.take(k)) is not None:
                    pos = block[1].astype(np.int64)
                    yield pos
                    _, p, keys = before(pos)
                    push(keys, p)
                for _, pos in given.upto(end):
                    _, p, keys = before(pos)
                    push(keys, p)
                continue
            parts = [queue.take(k, self.n)]
            entries = (parts[0][0].astype(np.int64), parts[0][1].astype(np.int64)) if parts[0] else (np.zeros(0, np.int64),) * 2
            own = list(given.upto(end))
            code = np.concatenate([entries[0] * 2, *(x * 2 + 1 for x, _ in own)])
            place = np.concatenate([entries[1], *(x for _, x in own)])
            order = np.argsort(code, kind="stable")
            code, place, at, wide = code[order], place[order], 0, 1024
            if (all_ := within(code, place, end, before)) is not None:
                c, p, keys, pred = all_
                out = p[c % 2 == 0]
                if len(out):
                    yield out
                push(keys, pred)
                continue
            new_code, new_place = np.zeros(0, np.int64), np.zeros(0, np.int64)
            while at < len(code) or len(new_code):
                stop = min(at + wide, len(code))
                limit = code[stop - 1] if stop > at else 0
                m = int(np.searchsorted(new_code, limit)) if stop < len(code) else len(new_code)
                c, p = code[at:stop], place[at:stop]
                if m:
                    # what is new comes after what stood under its symbol, and before the symbol's seeds
                    merged = np.argsort(np.concatenate([c, new_code[:m]]), kind="stable")
                    c, p = np.concatenate([c, new_code[:m]])[merged], np.concatenate([p, new_place[:m]])[merged]
                ok, pred, keys = before(p)
                lowest = np.full(len(c), np.iinfo(np.int64).max)
                lowest[ok] = keys * 2
                bad = c[1:] > np.minimum.accumulate(lowest)[:-1]
                cut = int(bad.argmax()) + 1 if bad.any() else len(c)
                if m:
                    took_new = int(np.count_nonzero(merged[:cut] >= stop - at))
                    done = cut - took_new
                else:
                    took_new, done = 0, cut
                at += done
                out = p[:cut][c[:cut] % 2 == 0]
                if len(out):
                    yield out
                sent = ok < cut
                keys, pred = keys[sent], pred[sent]
                inside = keys <= end
                push(keys[~inside], pred[~inside])
                new_code, new_place = new_code[took_new:], new_place[took_new:]
                if inside.any():
                    new_code = np.concatenate([new_code, keys[inside] * 2])
                    new_place = np.concatenate([new_place, pred[inside]])
                    order = np.argsort(new_code, kind="stable")
                    new_code, new_place = new_code[order], new_place[order]
                wide = min(CHUNK, wide * 2) if cut == len(c) else max(64, 2 * cut)
        self.spilled += queue.spilled
        queue.close()

    def both_scans(self, seeds: Iterable[np.ndarray]) -> Iterator[tuple[bool, np.ndarray]]:
        """(smaller, positions): those larger than their neighbour ascending, then the smaller ones descending."""
        larger = BlockQueue(self.budget)
        for pos in self.scan(seeds, False):
            larger.push(0, pos.astype(self.index), np.zeros(0, np.uint8))
            yield False, pos

        def back():
            while (block := larger.take(0, last=True)) is not None:
                yield block[0][::-1]

        for pos in self.scan(back(), True):
            yield True, pos
        self.spilled += larger.spilled
        larger.close()

    def sorted_lms(self) -> Iterator[np.ndarray]:
        """Chunks of the LMS positions in the order of their suffixes."""
        lms, m = self.lms, len(self.lms)
        if m < 2:
            yield np.asarray(lms, np.int64)
            return
        rough = BlockQueue(self.budget)
        for a in range(0, m, CHUNK):
            pos = np.asarray(lms[a : a + CHUNK])
            symbol = self.text[pos].astype(np.int64)
            order = np.argsort(symbol, kind="stable")
            symbol, pos = symbol[order], pos[order]
            if self.top < 1 << 10:
                edges = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]]))
                for x, y in zip(edges.tolist(), [*edges[1:].tolist(), len(pos)], strict=True):
                    rough.push(int(symbol[x]), pos[x:y], np.zeros(0, np.uint8))
            else:
                part = symbol * RANGES // (self.top + 1)
                edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
                for x, y in zip(edges.tolist(), [*edges[1:].tolist(), len(pos)], strict=True):
                    rough.push(int(part[x]), pos[x:y], np.zeros(0, np.uint8))

        def by_symbol():
            for key in range(self.top + 1 if self.top < 1 << 10 else RANGES):
                if self.top < 1 << 10:
                    while (block := rough.take(key)) is not None:
                        yield block[0]
                elif (block := rough.take(key, m)) is not None:
                    yield block[0][np.argsort(self.text[block[0]], kind="stable")]

        names, self.number = scratch(m, self.index, self.budget), scratch(self.n, self.index, self.budget)
        for a in range(0, m, CHUNK):
            self.number[lms[a : a + CHUNK]] = np.arange(a, min(a + CHUNK, m))
        count, last = 0, None  # names fall from the largest on
        for smaller, pos in self.both_scans(by_symbol()):
            if not smaller:
                continue
            pos = pos[(pos > 0) & ~self.smaller[pos - 1]]
            if not len(pos):
                continue
            full = pos if last is None else np.concatenate([[last], pos])
            new = ~self._same(full[:-1], full[1:])
            ranks = count + np.cumsum(np.append(0, new) if last is None else new)
            names[self.number[pos]] = ranks
            count, last = int(ranks[-1]), pos[-1]
        self.spilled += rough.spilled
        rough.close()
        reduced = scratch(m, self.index, self.budget)
        for a in range(0, m - 1, CHUNK):
            b = min(a + CHUNK, m - 1)
            reduced[a:b] = count + 1 - names[a:b]
        del names
        self.number = None
        if count + 1 == m - 1:  # every name once: the names are the order
            order = scratch(m, self.index, self.budget)
            for a in range(0, m, CHUNK):
                order[reduced[a : a + CHUNK]] = np.arange(a, min(a + CHUNK, m))
        elif m <= self.small:
            order = small_order(reduced)
        else:
            inner = Level(reduced, self.budget, self.small)
            order = inner.order()
            self.spilled += inner.spilled
        for a in range(0, m, CHUNK):
            yield np.asarray(lms[order[a : a + CHUNK]], np.int64)

    def _same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the LMS substrings at a and b are equal, while places have their LMS numbers."""
        lms, m = self.lms, len(self.lms)
        size = lambda p: lms[np.minimum(self.number[p] + 1, m - 1)] - p + 1
        long = size(a).astype(np.int64)
        same = long == size(b)
        live, k = np.flatnonzero(same), 0
        while len(live):
            width = np.minimum(8, long[live] - k).max()
            x, y, ok = a[live] + k, b[live] + k, np.ones(len(live), bool)
            for j in range(int(width)):
                here = k + j < long[live]
                ok &= ~here | (self.text[np.minimum(x + j, self.n - 1)] == self.text[np.minimum(y + j, self.n - 1)])
            same[live[~ok]] = False
            k += 8
            live = live[ok & (long[live] > k)]
        return same

    def order(self) -> np.ndarray:
        """All positions in the order of their suffixes."""
        if self.n <= self.small:
            return small_order(np.asarray(self.text))
        starts = np.concatenate([[0], np.cumsum(self.counts)])
        out = scratch(self.n, self.index, self.budget)
        for key, n_larger, pos, ascending in self._placed():
            at = starts[key] + n_larger if ascending else starts[key + 1] - 1 - n_larger
            out[at] = pos
        out[0] = self.n - 1
        return out

    def _placed(self):
        """(symbols, ranks within the symbol and kind, positions, whether ascending) by chunks of both scans."""
        last, run = {False: -1, True: -1}, {False: 0, True: 0}
        for smaller, pos in self.both_scans(self.sorted_lms()):
            key = self.text[pos].astype(np.int64)
            fresh = np.concatenate([[key[0] != last[smaller]], key[1:] != key[:-1]])
            begin = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), -1))
            rank = np.where(begin < 0, run[smaller] + np.arange(len(key)), np.arange(len(key)) - begin)
            last[smaller], run[smaller] = int(key[-1]), int(rank[-1]) + 1
            yield key, rank, pos, not smaller


class Induction(Level):
    """Suffixes of a text of few symbols (1024 at most) in order, with the prefixes neighbours share, up to cap."""

    def __init__(self, text: np.ndarray, cap: int = 0, budget: int = 256 << 20, small: int = 1 << 20):
        super().__init__(text, budget, small)
        self.cap = cap

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefixes of suffixes a and b (different ones), counted up to the cap."""
        out, live, n = np.zeros(len(a), np.int64), np.arange(len(a)), self.n
        raw = np.asarray(self.text).view(np.uint8) if self.text.dtype.itemsize == 1 else None
        for k in range(0, self.cap, 8):
            x, y = a[live] + k, b[live] + k
            if raw is not None and n > 8:
                near = np.maximum(x, y) + 8 <= n
                words = np.ndarray((n - 7,), "<u8", raw, strides=(1,)) if raw.flags.c_contiguous else None
                left, right = np.minimum(x, n - 8), np.minimum(y, n - 8)
                diff = words[left] ^ words[right]
                equal = np.where(diff == 0, 8, np.bitwise_count((diff & (~diff + np.uint64(1))) - np.uint64(1)).astype(np.int64) // 8)
                slow = np.flatnonzero(~near)
            else:
                equal, slow = np.zeros(len(live), np.int64), np.arange(len(live))
            if len(slow):
                equal[slow] = 0
                going = slow
                for j in range(8):
                    ok = (np.maximum(x[going], y[going]) + j < n) & (self.text[np.minimum(x[going] + j, n - 1)] == self.text[np.minimum(y[going] + j, n - 1)])
                    going = going[ok]
                    equal[going] = j + 1
            out[live] = k + equal
            live = live[equal == 8]
            if not len(live):
                break
        return np.minimum(out, self.cap).astype(np.uint8)

    def _one(self, a: int, b: int) -> int:
        return int(self.common(np.array([a]), np.array([b]))[0]) if self.cap else 0

    def _emit(self, queue: BlockQueue, carry: np.ndarray, pos: np.ndarray, lcp: np.ndarray, want: bool) -> None:
        """Pushes the predecessors of a block that are of the wanted kind, with their common prefixes. carry: by symbol the
        smallest value since its last push, -1 before the first."""
        pos = pos.astype(np.int64)
        ok = np.flatnonzero((pos > 0) & (self.smaller[pos - 1] == want))
        before = self.text[pos[ok] - 1]
        order = np.argsort(before, kind="stable")
        ok, before = ok[order], before[order]
        n = len(lcp)
        held = carry >= 0
        if not len(ok):
            carry[held] = np.minimum(carry[held], lcp.min())
            return
        fresh = np.concatenate([[True], before[1:] != before[:-1]])
        edges = np.flatnonzero(fresh)
        ends = np.append(edges[1:], len(ok))
        keys = before[edges].astype(np.int64)
        since = np.where(fresh, 0, np.concatenate([[0], ok[:-1] + 1]))
        least = least_in(lcp, since, ok + 1).astype(np.int64)
        old = carry[keys]
        least[edges] = np.where(old < 0, -1, np.minimum(least[edges], old))
        new = np.minimum(least + 1, self.cap).astype(np.uint8)
        after = ok[ends - 1] + 1
        rest = np.full(len(keys), self.cap, np.int64)
        inner = np.flatnonzero(after < n)
        if len(inner):
            rest[inner] = least_in(lcp, after[inner], np.full(len(inner), n))
        carry[held] = np.minimum(carry[held], lcp.min())
        carry[keys] = rest
        before_pos = (pos[ok] - 1).astype(self.index)
        for key, a, b in zip(keys.tolist(), edges.tolist(), ends.tolist(), strict=True):
            queue.push(key, before_pos[a:b], new[a:b])

    def descending(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Chunks of all positions from the largest suffix down, with the prefix shared with the one before in this order."""
        symbols = self.top + 1
        up, down, larger, seeds = (BlockQueue(self.budget) for _ in range(4))
        last = None
        for pos in self.sorted_lms():
            full = pos if last is None else np.concatenate([[last], pos])
            lcp = self.common(full[:-1], full[1:]) if self.cap else np.zeros(len(full) - 1, np.uint8)
            lcp = np.concatenate([np.zeros(1, np.uint8), lcp]) if last is None else lcp
            symbol = self.text[pos]
            edges = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]]))
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(pos)], strict=True):
                seeds.push(int(symbol[a]), pos[a:b].astype(self.index), lcp[a:b])
            last = pos[-1]
        carry = np.full(symbols, -1, np.int64)
        for key in range(symbols):
            last = None
            while (block := up.take(key)) is not None:
                larger.push(key, *block)
                last = int(block[0][-1])
                self._emit(up, carry, *block, want=False)
            opened = False
            while (block := seeds.take(key)) is not None:
                pos, lcp = block[0], block[1].copy()
                if not opened:
                    lcp[0] = self._one(last, int(pos[0])) if last is not None else 0
                opened = True
                self._emit(up, carry, pos, lcp, want=False)
        carry[:] = -1
        for key in range(symbols - 1, -1, -1):
            last, after = None, np.uint8(0)
            if key == 0:
                last = self.n - 1
                yield np.array([last]), np.zeros(1, np.uint8)
            while (block := down.take(key)) is not None:
                pos, lcp = block[0], block[1].copy()
                if last is None:
                    lcp[0] = 0
                self._emit(down, carry, pos, lcp, want=True)
                last = int(pos[-1])
                yield pos, lcp
            opened = False
            while (block := larger.take(key, last=True)) is not None:
                pos, lcp = block[0][::-1], block[1]
                head = after if opened else np.uint8(self._one(last, int(pos[0])) if last is not None else 0)
                after, opened = lcp[0], True
                lcp = np.concatenate([[head], lcp[1:][::-1]])
                self._emit(down, carry, pos, lcp, want=True)
                yield pos, lcp
        for q in (up, down, larger, seeds):
            self.spilled += q.spilled
            q.close()

    def buckets(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(positions, common prefix with the one before) of each first symbol, the symbols descending; holds a bucket."""
        if self.n == 1:
            yield np.zeros(1, np.int64), np.zeros(1, np.uint8)
            return
        parts, symbol = [], None
        for pos, lcp in self.descending():
            if symbol is not None and self.text[pos[0]] != symbol:
                yield self._ascending(parts)
                parts = []
            symbol = self.text[pos[0]]
            parts.append((pos, lcp))
        yield self._ascending(parts)

    def _ascending(self, parts) -> tuple[np.ndarray, np.ndarray]:
        pos, lcp = (np.concatenate([p[k] for p in parts])[::-1] for k in (0, 1))
        return pos, np.concatenate([np.zeros(1, np.uint8), lcp[:-1]])
