"""Best-fit packing improved by swap-based local search.

Documents become pieces no longer than a sequence; a full piece is a sequence of its own. All others are dealt to groups
of bounded size by a hash of their row, so that no key is hot. In a group best-fit decreasing gives a first packing;
then, from the fullest underfull bin to the emptiest, pieces are moved or exchanged (one for one, two for one, one for
two) with emptier bins, always so that the sum of squared fills grows, until no exchange does or all bins are full.
Emptied bins vanish. The bins that stay underfull, with what they hold, are dealt to new and fewer groups and searched on,
level by level, down to one group. Levels carry (row, length, bin) only; other columns join the result by row.
"""

import functools
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import cut
from fleetlens.llm.packing import BATCH_BYTES, encoder

MOST = 2048
#: Pieces in a group, about.
GROUP = 8192
SCHEMA = "doc_id long, piece int, start long, length long, ids binary"


# ---------------------------------------------------------------- pieces


def _pieces(batches, vocabulary: str, most: int):
    encode = encoder(vocabulary)
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids"])

    for batch in batches:
        rows, held = [], 0
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = np.append(encode(text.as_py() or ""), np.uint32(0)).astype("<u4").tobytes()
            n, at = len(raw) // 4, 0
            for k, end in enumerate(range(n % most or most, n + 1, most)):
                rows.append((doc, k, at, end - at, raw[4 * at : 4 * end]))
                at = end
            held += len(raw)
            if held >= BATCH_BYTES:
                yield out(rows)
                rows, held = [], 0
        if rows:
            yield out(rows)


def pieces(docs: DataFrame, vocabulary: str = "byte_bpe_50k", most: int = MOST) -> DataFrame:
    """doc_id, piece, start, length and ids (little-endian unsigned 32-bit) of every document's token string, which ends
    with id 0. Only a string longer than `most` is cut; all its pieces are full but the first may be shorter.

    A null or empty text is the end id alone; a text of any length is cut whole; rows with one id, or equal rows, are cut
    each; a null doc_id stays null; an empty table gives no rows; other columns are not read.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(lambda it: _pieces(it, vocabulary, most), SCHEMA)


# ---------------------------------------------------------------- one group


def best_fit(lengths: list[int], most: int) -> list[list[int]]:
    """Best-fit decreasing: every piece, longest first, goes to the fullest bin that takes it. Bins of piece numbers."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(most + 1)]  # bins by free space
    there = 0  # bit s: some bin has s free
    for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        n = lengths[i]
        fitting = there >> n
        if fitting:
            free = n + (fitting & -fitting).bit_length() - 1
            k = room[free].pop()
            if not room[free]:
                there ^= 1 << free
        else:
            free, k = most, len(bins)
            bins.append([])
        bins[k].append(i)
        room[free - n].append(k)
        there |= 1 << free - n
    return bins


class Bins:
    """Bins under local search. The fullest underfull one is the target; all that are emptier can give to it, so whatever
    moves, moves to a fuller bin, and the sum of squared fills grows with every exchange."""

    def __init__(self, bins: list[list[int]], lengths: list[int], most: int):
        self.most = most
        self.held: list[dict[int, list[int]]] = []  # pieces by length
        for items in bins:
            by: dict[int, list[int]] = {}
            for i in items:
                by.setdefault(lengths[i], []).append(i)
            self.held.append(by)
        self.fill = [sum(lengths[i] for i in items) for items in bins]

    def improve(self) -> None:
        while self._pass():
            pass

    def _pass(self) -> bool:
        """Takes the underfull bins in turn, fullest first; True if any exchange was made."""
        queue = [(-f, k) for k, f in enumerate(self.fill) if 0 < f < self.most]
        queue.sort()
        self.open = [False] * len(self.fill)  # bins that still give
        self.giving: dict[int, list[int]] = {}  # bins by a length they have, the emptiest last; some no longer do
        self.bits = self.mirror = 0  # bit n, and bit most - n: length n is in giving
        for _, k in queue:
            self.open[k] = True
            for n in self.held[k]:
                self._offer(n, k)
        changed, stuck = False, set()  # stuck: what gained nothing since the last exchange; without one, offers only go
        while queue:
            f, k = heapq.heappop(queue)
            if self.fill[k] != -f:  # it has given since
                if self.fill[k]:
                    heapq.heappush(queue, (-self.fill[k], k))
                continue
            self.open[k] = False
            while self.fill[k] < self.most and (like := self._like(k)) not in stuck:
                if found := self._best(k):
                    self._exchange(k, *found)
                    stuck.clear()
                    changed = True
                else:
                    stuck.add(like)
        return changed

    def _like(self, k: int) -> tuple:
        """Bins alike in this gain by the same exchanges."""
        return tuple(sorted((n, len(own)) for n, own in self.held[k].items()))

    def _offer(self, n: int, k: int) -> None:
        self.giving.setdefault(n, []).append(k)
        self.bits |= 1 << n
        self.mirror |= 1 << self.most - n

    def _donor(self, n: int, but: int = -1) -> int:
        """The last bin offered that gives length n, other than `but`; -1 if there is none. Offers out of date are dropped."""
        stack, found, held = self.giving.get(n, []), -1, False
        while stack and found < 0:
            d = stack.pop()
            if self.open[d] and n in self.held[d]:
                held |= d == but
                found = d if d != but else -1
        stack += ([found] if found >= 0 else []) + ([but] if held else [])
        if not stack:
            self.bits &= ~(1 << n)
            self.mirror &= ~(1 << self.most - n)
        return found

    def _single(self, limit: int) -> int:
        """The longest length up to limit that is given; 0 if none."""
        while fitting := self.bits & (1 << limit + 1) - 1:
            n = fitting.bit_length() - 1
            if self._donor(n) >= 0:
                return n
        return 0

    def _pair(self, total: int, least: int) -> tuple[int, int] | None:
        """Two given lengths of exactly this total, the longer first; it is `least` or more, or both are of one bin."""
        shift = self.most - total
        both = self.bits & (self.mirror >> shift if shift >= 0 else self.mirror << -shift)
        while both and (n := both.bit_length() - 1) * 2 >= total:
            both ^= 1 << n
            d, e = self._donors(n, total - n)
            if d >= 0 and e >= 0 and (n >= least or d == e):
                return n, total - n
        return None

    def _totals(self) -> int:
        """Bit t: two given lengths may make up t. All bits from twice the shortest on where there are many lengths, as
        some pair then makes up nearly every total."""
        if self.bits.bit_count() > 64:
            least = 2 * ((self.bits & -self.bits).bit_length() - 1)
            return (1 << self.most + 1) - (1 << least) if least <= self.most else 0
        out, rest = 0, self.bits
        while rest:
            n = (rest & -rest).bit_length() - 1
            rest ^= 1 << n
            out |= self.bits << n
        return out

    def _donors(self, n: int, m: int) -> tuple[int, int]:
        d = self._donor(n)
        if d < 0:
            return -1, -1
        spare = self.held[d].get(m)
        if spare and (m != n or len(spare) > 1):
            return d, d
        return d, self._donor(m, d)

    def _best(self, k: int) -> tuple[list[int], list[int]] | None:
        """(lengths given, lengths taken) that fill bin k most; None if nothing adds to it. Of several ways the first:
        a move, an exchange of one for one, of two for one, then one or none for two."""
        gap, own = self.most - self.fill[k], sorted(self.held[k])
        twos = [[n, m] for i, n in enumerate(own) for m in own[i:] if m != n or len(self.held[k][n]) > 1]
        ones = [[], *([n] for n in own)]
        best, gain = None, 0
        for give in ones + twos:
            n = self._single(min(self.most, sum(give) + gap))
            if n - sum(give) > gain:
                best, gain = (give, [n]), n - sum(give)
                if gain == gap:
                    return best
        totals = self._totals()
        for give in ones:
            fitting = totals & (1 << sum(give) + gap + 1) - 1
            while (total := fitting.bit_length() - 1) > sum(give) + gain:
                if two := self._pair(total, sum(give)):
                    best, gain = (give, list(two)), total - sum(give)
                    break
                fitting ^= 1 << total
            if gain == gap:
                break
        return best

    def _exchange(self, k: int, give: list[int], take: list[int]) -> None:
        donors = (self._donor(take[0]),) if len(take) == 1 else self._donors(*take)
        for n, d in zip(take, donors, strict=True):
            self._move(n, d, k)
        for n in give:
            self._move(n, k, donors[0])
            self._offer(n, donors[0])

    def _move(self, n: int, source: int, target: int) -> None:
        own = self.held[source]
        self.held[target].setdefault(n, []).append(own[n].pop())
        if not own[n]:
            del own[n]
        self.fill[source] -= n
        self.fill[target] += n


def search(bins: list[list[int]], lengths: list[int], most: int) -> list[list[int]]:
    """The bins after local search among the underfull ones; emptied bins are gone."""
    work = Bins(bins, lengths, most)
    work.improve()
    return [[i for n in by for i in by[n]] for by in work.held if by]


# ---------------------------------------------------------------- all groups


def _group(table: pa.Table, most: int) -> pa.Table:
    table = table.sort_by([("length", "descending"), ("row", "ascending")])
    rows, lengths, bins = (table.column(c).to_pylist() for c in ("row", "length", "bin"))
    if bins[0] is None:
        start = best_fit(lengths, most)
    else:
        by: dict[int, list[int]] = {}
        for i, b in enumerate(bins):
            by.setdefault(b, []).append(i)
        start = [by[b] for b in sorted(by)]
    out: list[list[int]] = [[], [], [], [], []]
    for items in search(start, lengths, most):
        at, name, fill = 0, min(rows[i] for i in items), sum(lengths[i] for i in items)
        for i in items:
            for column, value in zip(out, (rows[i], lengths[i], name, at, fill), strict=True):
                column.append(value)
            at += lengths[i]
    return pa.table([pa.array(c, pa.int64()) for c in out], ["row", "length", "bin", "offset", "fill"])


def _dealt(df: DataFrame, key: str, level: int, groups: int) -> DataFrame:
    return df.withColumn("g", F.pmod(F.xxhash64(key, F.lit(level)), F.lit(groups))).repartition(min(groups, max(1024, groups // 16)), "g").groupBy("g")


def pack(items: DataFrame, most: int = MOST, group: int = GROUP) -> DataFrame:
    """items with sequence_id and offset: rows of one sequence_id are `most` long together at most, gapless from 0.

    items has a column length (1 to most, never null) and any others; their names may not be row, sequence_id or offset.
    Ties and repeated rows are told apart by a row number; an empty table gives no rows. Levels end once one group has
    been searched, or when a level empties fewer bins than it has groups, so no group ever holds more than about `group`
    pieces and what more levels could save is below one sequence for each.
    """
    items = cut(items.withColumn("row", F.monotonically_increasing_id()))
    short = items.where(F.col("length") < most).select("row", "length", F.lit(None).cast("long").alias("bin"))
    count, level, done = short.count(), 0, []
    rest, key, bins = short, "row", None
    while count:
        groups = -(-count // group)
        held = cut(_dealt(rest, key, level, groups).applyInArrow(lambda t: _group(t, most), "row long, length long, bin long, offset long, fill long"))
        now = held.where(F.col("fill") < most).agg(F.count("*").alias("n"), F.sum(F.expr("if(offset = 0, 1, 0)")).alias("bins"), F.sum(F.expr(f"if(offset = 0, {most} - fill, 0)")).alias("free")).first()
        full = held.where(F.col("fill") == most).agg(F.sum(F.expr("if(offset = 0, 1, 0)"))).first()[0] or 0
        last = groups == 1 or not now.n or now.free < most or bins is not None and bins - full - now.bins < groups
        if last:
            done.append(held)
            break
        done.append(held.where(F.col("fill") == most))
        rest, key, count, bins, level = held.where(F.col("fill") < most).select("row", "length", "bin"), "bin", now.n, now.bins, level + 1
    out = items.where(F.col("length") == most).withColumns({"sequence_id": F.col("row"), "offset": F.lit(0).cast("long")})
    if done:
        placed = functools.reduce(DataFrame.union, [part.select("row", F.col("bin").alias("sequence_id"), "offset") for part in done])
        out = out.union(items.where(F.col("length") < most).join(placed, "row").select(out.columns))
    return out.drop("row")


def op12_best_fit(spark, sf_dir: str) -> DataFrame:
    """Ids stay out of the shuffle: their checksum is taken where they are made."""
    cut_up = pieces(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(cut_up).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
