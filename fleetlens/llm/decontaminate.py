"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, and windows of eight template words are hashed. Windows of the
benchmark are held by every task (in blocks of a bounded size); a document's windows are looked up there, and those found
are hash-joined with the benchmark's table, which says whose they are and what stood in the slots. A re-parameterised
question is one where each slot value of the item has a single value in an occurrence of it in the document. Windows of
the bare words stand beside the templates, so that literal copies match whatever they consist of.

A phrase that many items share ("Which of the following is the best answer") says nothing about one of them. So places of
an item are ranked by how many texts of the benchmark have what stands there, and an occurrence counts only with some of
the item's rarest places or with half of all. That is also the prefix filter: whatever leaks holds one of the rarest places
or of the half-and-one rarest, so only these are joined with the documents' windows, and all other windows are joined for
the candidate pairs alone.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import Rolling, blocks, cut, mix, utf8

WINDOW = 8
#: Benchmark windows need so many words that are no placeholder.
LITERAL = 4
#: An item none of whose windows has so many is looked for as a whole if it has so many words that are no placeholder.
WHOLE = 2
#: Places of an item's windows belong to one occurrence if they are shifted by so many words or fewer.
SHIFT = 4
#: A document leaks an item if so many of the item's windows (or all, if it has fewer) stand in it.
LEAST = 4
#: The benchmark's table is broadcast up to so many bytes.
BROADCAST_BYTES = 16 << 20
#: So many of them (or all, if there are fewer) must be among the item's rarest, unless half of the item stands there. One
#: may reach a single word beyond a shared phrase.
RARE = 2
#: Hashes of the benchmark that a task holds at once (8 bytes each); a larger benchmark takes several passes.
HELD = 4_000_000
#: Words for units, which count as such after a number.
UNITS = "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t lb lbs oz ounce ounces pound pounds ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years hz khz mhz ghz b kb mb gb tb bit bits byte bytes w kw mw watt watts v volt volts a amp amps c f k degree degrees percent dollar dollars cent cents euro euros usd eur gbp mph kmh kph".split()

_B = np.arange(256)
_UPPER = (_B >= 65) & (_B <= 90)
_DIGIT = (_B >= 48) & (_B <= 57)
_WORD = _UPPER | _DIGIT | (_B >= 97) & (_B <= 122) | (_B >= 128)
_STOP = np.isin(_B, list(b".!?:;\n\"()"))
_CODES = mix(np.array([101, 202, 303], np.uint64))
_NUMBER, _UNIT, _NAME = _CODES
_ODD = np.array([pow(0xD1342543DE82EF95, k, 1 << 64) for k in range(WINDOW + 1)], np.uint64)


def lowered(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes in lower case (ASCII and Latin-1 letters) and where a capital stood."""
    after = np.concatenate([[False], data[:-1] == 0xC3]) if len(data) else np.zeros(0, bool)
    high = after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    upper = _UPPER[data] | high
    return np.where(upper, data + 32, data).astype(np.uint8), upper


class Template:
    """Of a block of texts: a row, a word hash and four codes for each word: template without names, with them,
    with words that open a sentence as possible names too, and the bare words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        low, upper = lowered(data)
        kind = _WORD[data]
        if len(data) > 2:
            digit = _DIGIT[data]
            kind = kind.copy()
            kind[1:-1] |= ((data[1:-1] == 46) | (data[1:-1] == 44)) & digit[:-2] & digit[2:]
        first = np.zeros(len(data) + 1, bool)
        first[offsets[:-1]] = True
        edge = np.concatenate([[False], kind, [False]])
        start = kind & (~edge[:-2] | first[:-1])
        end = kind & (~edge[2:] | first[1:])
        begin, stop = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.row = np.searchsorted(offsets, begin, "right") - 1
        self.words = Rolling(low).spans(begin, stop) if len(begin) else np.zeros(0, np.uint64)
        count = lambda flags: np.concatenate([[0], np.cumsum(flags)])
        digits, capitals, stops = count(_DIGIT[data]), count(upper), count(_STOP[data])
        number = digits[stop] > digits[begin]
        before = np.concatenate([[0], stop[:-1]])
        fresh = np.concatenate([[True], self.row[1:] != self.row[:-1]]) if len(begin) else np.zeros(0, bool)
        opens = fresh | (stops[begin] > stops[np.minimum(before, begin)])
        wide = begin + (data[begin] == 0xC3) if len(begin) else begin
        maybe = upper[wide] & (capitals[stop] - capitals[begin] == 1) & ~number if len(begin) else np.zeros(0, bool)
        unit = np.concatenate([[False], number[:-1]]) & ~fresh & np.isin(self.words, _unit_hashes()) if len(begin) else np.zeros(0, bool)
        self.plain = np.where(number, _NUMBER, np.where(unit, _UNIT, self.words))
        self.named = np.where(maybe & ~opens, _NAME, self.plain)
        self.codes = [self.plain, self.named, np.where(maybe, _NAME, self.plain), self.words]

    def windows(self, size: int, variant: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of windows that lie in one row, and their hashes."""
        codes = self.codes[variant]
        n = len(codes) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        total = np.full(n, size, np.uint64)
        for k in range(size):
            total += codes[k : k + n] * _ODD[k + 1]
        ok = np.flatnonzero(self.row[:n] == self.row[size - 1 :])
        return ok, mix(total[ok])

    def slots(self, start: int, size: int, variant: int) -> list[int]:
        """Word hashes where the window has placeholders, 0 elsewhere."""
        codes, words = self.codes[variant][start : start + size], self.words[start : start + size]
        return np.where(codes != words, words, 0).view(np.int64).tolist()


_units: list[np.ndarray] = []


def _unit_hashes() -> np.ndarray:
    if not _units:
        raw = np.frombuffer("".join(UNITS).encode(), np.uint8)
        ends = np.cumsum([len(u) for u in UNITS])
        _units.append(Rolling(raw).spans(ends - [len(u) for u in UNITS], ends))
    return _units[0]


#: Variants of a window: template without names, with names, with possible names at the opening of sentences, bare words.
OPENED, EXACT = 2, 3
_BENCH = "hash long, item_id long, item long, content long, at int, size int, slots array<long>, windows int, exact_windows int, whole boolean, opened boolean, template boolean, exact boolean"
_HIT = "doc_id long, content long, hash long, word int, doc_slots array<long>"


def _bench(batches, window: int, literal: int):
    for batch in batches:
        rows = []
        for item, text, own, content in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            data, offsets = utf8(pa.array([text.as_py() or ""], pa.large_string()))
            t = Template(data, offsets)
            size = min(window, len(t.words))
            found = {}  # (place, hash) -> slots, literals, first variant, whether bare words
            for variant in range(EXACT + 1):
                for at, h in zip(*t.windows(size, variant), strict=True):
                    slots = t.slots(int(at), size, variant)
                    old = found.get((int(at), int(h)))
                    found[int(at), int(h)] = (*(old[:3] if old else (slots, size - sum(x != 0 for x in slots), variant)), variant == EXACT)
            templates = {k for k, (_, n, v, _) in found.items() if v != EXACT and n >= min(literal, size)}
            whole = not templates and np.count_nonzero(t.plain == t.words) >= WHOLE
            if whole:
                templates = {k for k, (_, n, v, _) in found.items() if v != EXACT and n}
            several, places = len({at for at, _ in templates}), len({at for at, _ in found})
            for (at, h), (slots, _, variant, exact) in found.items():
                if exact or (at, h) in templates:
                    rows.append((int(np.uint64(h).view(np.int64)), item, own, content, at, size, slots, several, places, whole, variant == OPENED, (at, h) in templates, exact))
        columns = list(zip(*rows, strict=True)) or [()] * 13
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int32(), pa.int32(), *[pa.bool_()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["hash", "item_id", "item", "content", "at", "size", "slots", "windows", "exact_windows", "whole", "opened", "template", "exact"])


def bench_windows(benchmark: DataFrame, window: int = WINDOW, literal: int = LITERAL) -> DataFrame:
    """hash, item_id, item (its id and text), content (its text), at, size, slots, windows (how many places of the item have a template), exact_windows (bare words)
    and whether the templates stand for the item only all together, count as names what opens a sentence, and are a
    template and bare words. An item shorter than a window is one window; a null or empty item has none."""
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text", F.xxhash64("item_id", "text"), F.xxhash64("text")).mapInArrow(lambda it: _bench(it, window, literal), _BENCH)


def ranked(bench: DataFrame) -> DataFrame:
    """bench with rare (the place is one of its item's rarest) and first (an occurrence that counts has a place like this: a
    rare one, one of the half-and-one rarest, or a template of an item that needs them all).

    A place is as common as the most general of its windows: the number of different texts that have it."""
    held = bench.groupBy("hash", "content").agg(F.lit(1).alias("n")).groupBy("hash").agg(F.sum("n").alias("texts"))
    out = bench.join(held, "hash").withColumn("texts", F.max("texts").over(Window.partitionBy("item", "at")))  # an item's windows
    by = Window.partitionBy("item")
    out = out.withColumns({"rare": F.col("texts") == F.min("texts").over(by), "rank": F.dense_rank().over(by.orderBy("texts", "at"))})
    first = F.col("rare") | (F.col("rank") <= F.floor(F.col("exact_windows") / 2) + 1) | F.col("whole") & F.col("template")
    rares = F.size(F.collect_set(F.when(F.col("rare"), F.col("at"))).over(by))
    return out.withColumns({"first": first, "rares": rares}).drop("rank", "texts", "content")


def _lookup(batches, shared):
    sizes, known = shared.value
    filter_ = np.zeros(1 << 20, bool)
    filter_[known >> np.uint64(44)] = True
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        ids, contents, rows = batch.column(0).to_pylist(), batch.column(2).to_pylist(), []
        for a, b in blocks(offsets, 1 << 20):
            part = offsets[a : b + 1]
            t = Template(data[part[0] : part[-1]], part - part[0])
            first = np.searchsorted(t.row, np.arange(b - a))
            for size in sizes:
                seen = set()
                for variant in range(EXACT + 1):
                    at, hashes = t.windows(size, variant)
                    maybe = np.flatnonzero(filter_[hashes >> np.uint64(44)])
                    for k in maybe[np.isin(hashes[maybe], known)]:
                        key = (int(at[k]), int(hashes[k]))
                        if key not in seen:
                            seen.add(key)
                            row = int(t.row[key[0]])
                            rows.append((ids[a + row], contents[a + row], int(hashes[k : k + 1].view(np.int64)[0]), key[0] - int(first[row]), t.slots(key[0], size, variant)))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64())], strict=True)], ["doc_id", "content", "hash", "word", "doc_slots"])


def window_hits(docs: DataFrame, bench: DataFrame, held: int = HELD) -> DataFrame:
    """doc_id, content (a hash of the text), hash, word and doc_slots for each window of docs that the benchmark has. bench: a written table."""
    spark = docs.sparkSession
    sizes = sorted(r[0] for r in bench.select("size").distinct().collect())  # WINDOW values at most
    passes = max(1, -(-bench.count() // held))
    out = None
    for k in range(passes):
        part = bench.where(F.pmod("hash", F.lit(passes)) == k).select("hash").distinct()
        known = np.array([r[0] for r in part.toLocalIterator()], np.int64).view(np.uint64)
        shared = spark.sparkContext.broadcast((sizes, np.sort(known)))  # about `held` hashes at most
        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text")).mapInArrow(lambda it, s=shared: _lookup(it, s), _HIT)
        out = found if out is None else out.union(found)
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, literal: int = LITERAL, least: int = LEAST, held: int = HELD) -> DataFrame:
    """A row per document and item that leaks: doc_id, content (a hash of its text), item_id, n_windows found, item_windows, n_slots, slots_consistent, first_word and
    last_word, all of the occurrence that shows it best.

    An occurrence is what stands at one shift of the item's words, at neighbouring shifts, or in the whole document; each
    is judged with and without the templates that take a sentence's opening word for a name, and one that passes is
    enough: it has `least` of the item's places, among them two of its rarest, or else half of all. Null or empty texts on
    either side have no windows; words cut at their ends still count by their windows; a text of any length is searched
    whole; documents are told apart by id and text, items too, so rows that repeat both count once and null ids are no
    group; of equally good occurrences the one with the larger place is shown; empty tables give no rows; other columns
    are not read.
    """
    bench = cut(ranked(cut(bench_windows(benchmark, window, literal))))
    hits = cut(window_hits(docs, bench, held).distinct())
    size = bench.agg(F.sum(F.size("slots") * 8 + 96)).first()[0] or 0
    table = F.broadcast(bench) if size <= BROADCAST_BYTES else bench
    some = F.broadcast(bench.where("first").select("hash", "item")) if size <= BROADCAST_BYTES else bench.where("first").select("hash", "item")
    candidates = hits.select("doc_id", "content", "hash").distinct().join(some, "hash").select("doc_id", "content", "item").distinct()
    asked = candidates.join(table.select("item", "hash").distinct(), "item")
    same = (F.col("h.hash") == F.col("a.hash")) & F.col("h.doc_id").eqNullSafe(F.col("a.doc_id")) & F.col("h.content").eqNullSafe(F.col("a.content"))
    pairs = asked.alias("a").join(hits.alias("h"), same).select("a.*", "h.word", "h.doc_slots").join(table, ["item", "hash"])
    values = F.filter(F.arrays_zip(F.col("slots").alias("item"), F.col("doc_slots").alias("doc")), lambda x: x.item != 0)
    keys = ["doc_id", "content", "item_id", "item"]
    columns = [*keys, "at", "word", "size", "windows", "exact_windows", "whole", "opened", "template", "exact", "rare", "rares"]
    pairs = pairs.select(*columns, (F.col("word") - F.col("at")).alias("shift"), F.transform(values, lambda x: F.struct(x.item.alias("item"), x.doc.alias("doc"))).alias("values"))
    by = Window.partitionBy(*keys).orderBy("shift")
    pairs = pairs.withColumn("far", F.coalesce(F.col("shift") - F.lag("shift").over(by) > SHIFT, F.lit(False)).cast("int")).withColumn("near", F.sum("far").over(by))
    scopes = [F.struct(F.lit(k).alias("scope"), c.cast("long").alias("place"), F.lit(o).alias("with_opened")) for k, c in enumerate((F.col("shift"), F.col("near"), F.lit(0))) for o in (False, True)]
    spread = pairs.withColumn("o", F.explode(F.array(*scopes))).where(F.col("o.with_opened") | ~F.col("opened"))
    found = lambda condition: F.count_distinct(F.when(condition, F.col("at")))
    occurrences = spread.groupBy(*keys, "o").agg(
        found(F.col("template")).alias("n_template"), found(F.col("exact")).alias("n_exact"),
        found(F.col("template") & (F.size("values") == 0)).alias("fixed"), found(F.col("rare") & F.col("template")).alias("rare_template"),
        found(F.col("rare") & F.col("template") & (F.size("values") == 0)).alias("rare_fixed"), found(F.col("rare") & F.col("exact")).alias("rare_exact"), F.least(F.lit(RARE), F.max("rares")).alias("rares"), F.count_distinct("at").alias("n_windows"),
        F.max("windows").alias("templates"), F.max("exact_windows").alias("exacts"), F.max("whole").alias("whole"),
        F.min("word").alias("first_word"), F.max(F.col("word") + F.col("size") - 1).alias("last_word"),
        F.array_distinct(F.flatten(F.collect_set("values"))).alias("values"),
    )
    item_values = F.size(F.array_distinct(F.transform("values", lambda x: x.item)))
    judged = occurrences.select("*", F.size("values").alias("n_slots"), (item_values == F.size("values")).alias("slots_consistent"))
    need = F.when(F.col("whole"), F.col("templates")).otherwise(F.least(F.lit(least), F.col("templates")))
    n, rare = (F.when(F.col("slots_consistent"), F.col(a)).otherwise(F.col(b)) for a, b in (("n_template", "fixed"), ("rare_template", "rare_fixed")))
    templated = (F.col("templates") > 0) & (n >= need) & ((rare >= F.col("rares")) | F.col("whole") | (2 * n >= F.col("exacts")))
    enough = templated | (F.col("n_exact") >= F.least(F.lit(least), F.col("exacts"))) & ((F.col("rare_exact") >= F.col("rares")) | (2 * F.col("n_exact") >= F.col("exacts")))
    fields = [F.col(c) if c != "item_windows" else F.greatest("templates", "exacts").alias(c) for c in ("slots_consistent", "n_windows", "item_windows", "n_slots", "first_word", "last_word")]
    best = judged.where(enough).groupBy(*keys).agg(F.max(F.struct(*fields)).alias("b"))
    return best.select("doc_id", "content", "item_id", "b.n_windows", "b.item_windows", "b.n_slots", "b.slots_consistent", "b.first_word", "b.last_word")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without those that leak an item. Nulls, ties, long texts and repeats as in leaks; a leak drops the rows of its
    id and text alone, so that a clean row with a null id, or with another's id, stays; an empty table gives no rows; all
    columns pass through."""
    found = leaks(docs, benchmark).select(F.col("doc_id").alias("__leak"), F.col("content").alias("__content")).distinct()
    return docs.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col("__leak")) & (F.xxhash64("text") == F.col("__content")), "left_anti")


def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("content")
