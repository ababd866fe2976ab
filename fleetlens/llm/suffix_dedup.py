"""Removal of repeated passages with suffix arrays made by external induced sorting.

A byte goes if a 100-byte string over it also starts earlier in the corpus. Strings are found in five steps.

1. Every text is sampled by content: of each 100-byte window the 24-byte string with the smallest hash is its anchor, so
   equal windows have equal anchors at equal places. Around each anchor, the bytes that its windows can reach are a
   segment. A task compares its segments first: of equal ones only the first goes on, so that copies and periodic texts
   are few rows. Then anchors that occur once in the corpus are left behind; no window that repeats is.
2. Equal segments are one, with its first place; what stands at the other places is a repeat.
3. A window that stands in two different segments has the same bytes around its anchor in both, a core of 81 bytes at
   one of four places; segments without such a core in common with another cannot share a window and are done, and the
   others are cut to what windows around their common cores can reach.
4. The other segments are dealt by anchor to shards of about SHARD_BYTES, which are read as streams into scratch files and
   whose suffixes are sorted (module induced_sort). Windows whose suffixes share 100 bytes or more with their neighbours in
   that order are equal, and all but the first are repeats.
5. An anchor with more than HOT different segments (a passage in very many contexts) would be one task's work; the hashes of
   its segments' windows are counted by Spark instead, with partial aggregation.
"""

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import Rolling, blocks, cut, drop_cut, mix, slices, utf8
from fleetlens.llm.induced_sort import Growing, Induction, scratch

LENGTH, ANCHOR = 100, 24
#: Bytes of segments in a shard, of a queue or array that a sort holds in memory, and the texts that are sorted by doubling.
SHARD_BYTES, QUEUE_BYTES, SMALL = 2 << 20, 2 << 20, 1 << 18
#: Segments of one anchor beyond which its windows are counted by hash.
HOT = 20_000
#: Bits of the filter of documents with repeats; it has this size whatever the input, and only saves shuffling.
FILTER_BITS = 1 << 26


def sliding(op, x: np.ndarray, width: int) -> np.ndarray:
    """op over every `width` neighbours."""
    size = 1
    while 2 * size <= width:
        x = op(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return op(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(data: np.ndarray, row: np.ndarray, rolling: Rolling, length: int = LENGTH, size: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of all windows that lie in one row of a block (row: of each byte)."""
    width = length - size + 1
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = rolling.windows(size) | np.uint64(1)
    least = sliding(np.minimum, hashes, width)
    least[row[: len(least)] != row[length - 1 :]] = 0
    pad = np.zeros(width - 1, np.uint64)
    most = sliding(np.maximum, np.concatenate([pad, least, pad]), width)
    at = np.flatnonzero(most == hashes)
    return at, hashes[at]


_ANCHOR_SCHEMA = "doc_id long, pos int, a int, b int, anchor long, content long, sure boolean"
#: Segments that a task compares among themselves before it sends them; so many of one anchor are many.
BUFFER, MANY = 1 << 19, 64
#: Fixed values of pos: a run of repeats, and a sign that an anchor repeats.
RUN, SIGN = -1, -2


def runs(doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges [a, b) of documents, with those joined that touch or overlap and end in order."""
    order = np.lexsort((b, a, doc))
    doc, a, b = doc[order], a[order], b[order]
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (a[1:] > b[:-1]) | (b[1:] < b[:-1])])) if len(doc) else np.zeros(0, np.int64)
    return doc[first], a[first], b[np.append(first[1:], len(doc)) - 1] if len(doc) else b


def _sent(parts: list[tuple]) -> pa.RecordBatch:
    """What a task sends of its segments (doc, pos, a, b, anchor, content): of equal ones the first, the others as runs of
    repeats. Anchors with many different segments here repeat for sure: their rows say so and may be spread by content, and
    a sign stands in for them where rows of the same anchor meet."""
    doc, pos, a, b, anchor, content = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(anchor, kind="stable")
    same = anchor[order[1:]] == anchor[order[:-1]]
    order = order[np.append(same, False) | np.concatenate([[False], same])] if len(order) else order
    order = order[np.lexsort((pos[order], doc[order], content[order], anchor[order]))]
    x, y = anchor[order], content[order]
    begins = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]) if len(order) else np.zeros(0, bool)
    at = np.flatnonzero(begins)
    head = np.repeat(at, np.diff(np.append(at, len(order))))
    kept = np.ones(len(doc), bool)
    kept[order[~begins]] = False
    again = order[~begins & ((doc[order] != doc[order[head]]) | (pos[order] != pos[order[head]]))]  # not a row given twice
    names, counts = np.unique(x[begins], return_counts=True)
    names = names[counts > MANY]
    sure = np.zeros(len(doc), bool)
    sure[order] = np.isin(x, names)
    run_doc, run_a, run_b = runs(doc[again], a[again], b[again])
    n, m, kept = len(run_doc), len(names), np.flatnonzero(kept)
    spread = mix(run_doc.view(np.uint64) ^ (run_a.astype(np.uint64) << np.uint64(32)))
    zero = np.zeros(m, np.int32)
    columns = [
        np.concatenate([doc[kept], run_doc, zero]), np.concatenate([pos[kept], np.full(n, RUN), np.full(m, SIGN)]), np.concatenate([a[kept], run_a, zero]), np.concatenate([b[kept], run_b, zero]),
        np.concatenate([anchor[kept], spread, names]).view(np.int64), np.concatenate([content[kept], spread, names]).view(np.int64), np.concatenate([sure[kept], np.ones(n, bool), np.zeros(m, bool)]),
    ]
    kinds = [pa.int64(), *[pa.int32()] * 3, *[pa.int64()] * 2, pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "pos", "a", "b", "anchor", "content", "sure"])


def _anchors(batches, length: int, size: int):
    """Rows for the segments of the texts; see _sent."""
    parts, held = [], 0
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for first, last in blocks(offsets, 1 << 19):
            part = offsets[first : last + 1] - offsets[first]
            block = data[offsets[first] : offsets[last]]
            row = np.repeat(np.arange(last - first), np.diff(part))
            rolling = Rolling(block)
            at, hashes = anchors(block, row, rolling, length, size)
            row = row[at]
            pos = at - part[row]
            left = np.minimum(pos, length - size)
            right = np.minimum(part[row + 1] - at, length)
            content = mix(rolling.spans(at - left, at + right) ^ (left.astype(np.uint64) << np.uint64(40)))
            parts.append((ids[first + row], pos.astype(np.int32), (pos - left).astype(np.int32), (pos + right).astype(np.int32), hashes, content))
            held += len(at)
            if held >= BUFFER:
                yield _sent(parts)
                parts, held = [], 0
    if parts:
        yield _sent(parts)


_MARKED_SCHEMA = "doc_id long, pos int, a int, b int, anchor long, again boolean"


def _marked(batches):
    """Of rows in the order of anchor, content and place: those of anchors that repeat, and whether a row repeats an earlier
    one's segment. One row and the first of its equals are carried from batch to batch."""
    names = ["doc_id", "pos", "a", "b", "anchor", "content", "sure"]
    tail = first = None  # the last row, not yet sent, with whether its anchor stood before it; the first of its equals

    def send(rows, twice, again):
        ok = (twice | rows["sure"]) & (rows["pos"] != SIGN) & ~again["row"]
        again_ = again["copy"] | (rows["pos"] == RUN)
        return pa.RecordBatch.from_arrays([pa.array(v[ok], k) for v, k in zip((rows["doc_id"], rows["pos"], rows["a"], rows["b"], rows["anchor"], again_), (pa.int64(), *[pa.int32()] * 3, pa.int64(), pa.bool_()), strict=True)], ["doc_id", "pos", "a", "b", "anchor", "again"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
        before = first is not None
        keys = ("anchor", "content", "doc_id", "pos")
        anchor, content, doc, pos = (np.concatenate([first[n], rows[n]]) if before else rows[n] for n in keys)
        # the carried head stands in front; equal to it is what goes on with its group
        begins = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])])
        at = np.flatnonzero(begins)
        head = np.repeat(at, np.diff(np.append(at, len(anchor))))
        other = (doc != doc[head]) | (pos != pos[head])
        copy, row = (~begins & other)[before:], (~begins & ~other)[before:]
        near = anchor[1:] == anchor[:-1]
        twice = (np.concatenate([near, [False]]) | np.concatenate([[False], near]))[before:]
        if tail is not None:
            held, t_twice, t_again = tail
            yield send(held, t_twice | np.array([held["anchor"][0] == rows["anchor"][0]]), t_again)
        again = {"copy": copy, "row": row}
        if len(copy) > 1:
            yield send({n: v[:-1] for n, v in rows.items()}, twice[:-1], {n: v[:-1] for n, v in again.items()})
        tail = ({n: v[-1:] for n, v in rows.items()}, twice[-1:], {n: v[-1:] for n, v in again.items()})
        k = head[-1]
        first = {n: v[k : k + 1] for n, v in zip(keys, (anchor, content, doc, pos), strict=True)}
    if tail is not None:
        yield send(*tail)


def id_filter(ids: DataFrame):
    """A broadcast bit array of FILTER_BITS bits, set where a doc_id of ids hashes to."""
    spark = ids.sparkSession
    bit = ids.select(F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).alias("bit"))
    words = bit.groupBy(F.shiftright("bit", 6).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
    out = np.zeros(FILTER_BITS // 64, np.int64)
    got = words.toArrow()  # FILTER_BITS / 64 rows at most
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return spark.sparkContext.broadcast(out)


def _split(batches, shared, want: bool):
    words = shared.value
    for batch in batches:
        bit = batch.column(batch.num_columns - 1).to_numpy()
        hit = (words[bit >> 6] >> (bit & 63) & 1).astype(bool)
        kept = batch.filter(pa.array(hit == want))
        yield pa.RecordBatch.from_arrays(kept.columns[:-1], kept.schema.names[:-1])


def split(docs: DataFrame, shared, want: bool) -> DataFrame:
    """The rows of docs that the filter says may (want) or surely do not have a repeat."""
    bit = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(FILTER_BITS))
    return docs.withColumn("__bit", bit).mapInArrow(lambda it: _split(it, shared, want), docs.schema)


_SEGMENT_SCHEMA = "anchor long, doc_id long, start int, pos int, piece binary, cores array<long>"
#: A window lies in one of so many cells by where its anchor is in it; windows of a cell share a core around the anchor.
CELLS = 4


def cell_step(length: int, size: int) -> int:
    """A window of cell j begins step * j to step * (j + 1) bytes before its anchor."""
    return -(-(length - size) // CELLS)


def structs(column: pa.Array, *fields: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of a column of arrays of structs: where each row's entries begin (and the last end), and the fields' values."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    entries = column.flatten()
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), [entries.field(f).to_numpy(zero_copy_only=False) for f in fields]


def _segments(batches, length: int, size: int):
    """A row for each place of a text: the segment's bytes and for each cell the hash of its core, null where the text has
    no room for it."""
    step = cell_step(length, size)
    names, kinds = ["anchor", "doc_id", "start", "pos", "piece", "cores"], (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    for batch in batches:
        entries, fields = structs(batch.column(2), "pos", "a", "b", "anchor")
        data, offsets = utf8(batch.column(1))
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for first, last in blocks(offsets, 1 << 19):
            part = offsets[first : last + 1] - offsets[first]
            block = data[offsets[first] : offsets[last]]
            own = slice(entries[first], entries[last])
            pos, a, b, anchor = (f[own] for f in fields)
            row = np.repeat(np.arange(last - first), np.diff(entries[first : last + 1]))
            base, size_of = part[row], np.diff(part)[row]
            rolling, cores, ok = Rolling(block), np.zeros((len(pos), CELLS), np.uint64), np.zeros((len(pos), CELLS), bool)
            for j in range(CELLS):
                x, y = pos - step * j, pos + length - step * (j + 1)
                ok[:, j] = (x >= 0) & (y <= size_of)
                here = np.flatnonzero(ok[:, j])
                cores[here, j] = mix(rolling.spans(base[here] + x[here], base[here] + y[here]) + np.uint64(j))
            raw, starts, stops = block.tobytes(), (base + a).tolist(), (base + b).tolist()
            for k in range(0, len(pos), BATCH):
                s = slice(k, k + BATCH)
                values = pa.array(cores[s].reshape(-1).view(np.int64), mask=~ok[s].reshape(-1))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ok[s]) + 1) * CELLS, pa.int32()), values)
                columns = (anchor[s], ids[first + row[s]], a[s], pos[s], [raw[x:y] for x, y in zip(starts[s], stops[s], strict=True)])
                yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, kinds, strict=True)), lists], names)


#: Segments are sent to Spark in batches of so many, so that a task holds few at once.
BATCH = 8192


def repeated_windows(batches, length: int = LENGTH, budget: int = QUEUE_BYTES, small: int = SMALL):
    """Of the segments of one shard (doc_id, start, piece), read as a stream: batches of doc_id, a, b, runs of bytes under
    windows that also start earlier in the shard. Texts, places and the marks of windows that go are scratch files beyond
    the budget."""
    text, docs, starts, sizes = Growing(np.uint8, budget), Growing(np.int64, budget), Growing(np.int32, budget), Growing(np.int32, budget)
    for batch in batches:
        raw, offsets = batch.column(batch.schema.get_field_index("piece")), None
        offsets = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1]
        held = np.frombuffer(raw.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        size = np.diff(offsets)
        spaced = np.ones(len(held) + len(size), np.uint8)  # 1 ends a piece; UTF-8 has no byte above 244, so two more fit
        spaced[np.arange(len(held)) + np.repeat(np.arange(len(size)), size)] = held + np.uint8(2)
        text.append(spaced)
        docs.append(batch.column(batch.schema.get_field_index("doc_id")).to_numpy())
        starts.append(batch.column(batch.schema.get_field_index("start")).to_numpy())
        sizes.append(size)
    text.append(np.zeros(1, np.uint8))
    text, docs, starts, sizes = text.array(), docs.array(), starts.array(), sizes.array()
    ends = np.cumsum(np.asarray(sizes, np.int64) + 1) - 1
    gone = scratch(len(text), bool, budget)
    first = np.zeros(0, np.int64)  # where the first place of the group of equal windows at hand stands in the text

    def place(pos):
        segment = np.searchsorted(ends, pos)
        return docs[segment], starts[segment] + pos - (ends[segment] - sizes[segment])

    for pos, lcp in Induction(text, length, budget, small).descending():
        equal = lcp >= length
        group = np.cumsum(~equal)
        top = group[-1]
        several = equal | np.append(equal[1:], True)  # the chunk's last may have its equals in the next one
        pos, group = pos[several].astype(np.int64), group[several]
        segment = np.minimum(np.searchsorted(ends, pos), len(ends) - 1)
        ok = (pos + length <= ends[segment]) & (pos < len(text) - 1)
        pos, group = np.concatenate([first, pos[ok]]), np.concatenate([np.zeros(len(first), np.int64), group[ok]])
        if len(pos):
            doc, at = place(pos)
            order = np.lexsort((at, doc, group))
            pos, doc, at, group = pos[order], doc[order], at[order], group[order]
            edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            head = np.repeat(edges, np.diff(np.append(edges, len(group))))
            gone[pos[(doc != doc[head]) | (at != at[head])]] = True  # one window may stand in two segments of its document
            first = pos[edges[-1:]] if group[-1] == top else first[:0]
    for k in range(0, len(gone), 1 << 20):
        marked = np.flatnonzero(gone[k : k + (1 << 20)]) + k
        if not len(marked):
            continue
        edges = np.flatnonzero(np.concatenate([[True], np.diff(marked) > 1]))
        stop = np.append(edges[1:], len(marked)) - 1
        doc, a = place(marked[edges])
        yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(a, pa.int32()), pa.array(a + (marked[stop] - marked[edges]) + length, pa.int32())], ["doc_id", "a", "b"])


def _window_hashes(batches, length: int):
    """(window, doc_id, pos) of every window of the segments."""
    for batch in batches:
        for part in slices([batch], 512):
            raw = part.column(2)
            offsets = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1]
            held = np.frombuffer(raw.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
            offsets = offsets - offsets[0]
            row = np.repeat(np.arange(len(raw)), np.diff(offsets))
            if len(held) < length:
                continue
            hashes = Rolling(held).windows(length)
            at = np.flatnonzero(row[: len(hashes)] == row[length - 1 :])
            row = row[at]
            columns = [hashes[at].view(np.int64), part.column(0).to_numpy()[row], part.column(1).to_numpy()[row] + at - offsets[row]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int32()), strict=True)], ["window", "doc_id", "pos"])


def repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, shard_bytes: int = SHARD_BYTES, budget: int = QUEUE_BYTES, small: int = SMALL, hot: int = HOT) -> DataFrame:
    """A written table (doc_id, spans): the byte ranges [a, b) of each document under windows that start earlier; ranges
    may touch or overlap. No join or group has a key that one passage can fill: places are joined by document and
    position, and whatever is counted by content is aggregated in part first."""
    spark = docs.sparkSession
    texts = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.mapInArrow(lambda it: _anchors(it, length, anchor), _ANCHOR_SCHEMA)
    route = F.when(F.col("sure"), F.xxhash64("anchor", "content")).otherwise(F.col("anchor"))
    marked = cut(found.repartition(route).sortWithinPartitions("anchor", "content", "doc_id", "pos").mapInArrow(_marked, _MARKED_SCHEMA))
    copies = marked.where(F.col("again") & (F.col("b") - F.col("a") >= length)).select("doc_id", "a", "b")
    owners = marked.where("not again")
    places = owners.groupBy("doc_id").agg(F.collect_list(F.struct("pos", "a", "b", "anchor")).alias("places"))  # as many as the document's anchors
    few = split(texts, id_filter(owners), True)
    pieces = cut(few.join(places, "doc_id").select("doc_id", "text", "places").mapInArrow(lambda it: _segments(it, length, anchor), _SEGMENT_SCHEMA))
    cores = pieces.select("doc_id", "start", "anchor", F.posexplode("cores").alias("cell", "core")).where("core is not null")
    # of a core that stands once, the smallest of each column are those of its only row
    single = cores.groupBy("core").agg(F.count("*").alias("m"), *[F.min(c).alias(c) for c in ("doc_id", "start", "anchor", "cell")]).where("m = 1")
    alone = single.groupBy("doc_id", "start", "anchor").agg(F.sum(F.expr("shiftleft(1, cell)")).cast("int").alias("alone"))
    has = F.aggregate(F.transform("cores", lambda x, j: F.when(x.isNull(), 0).otherwise(F.pow(F.lit(2), j).cast("int"))), F.lit(0), lambda a, x: a + x)
    joined = pieces.withColumn("has", has).join(alone.hint("shuffle_hash"), ["doc_id", "start", "anchor"], "left")
    shared = joined.withColumn("cells", F.col("has").bitwiseAND(F.bitwise_not(F.coalesce("alone", F.lit(0))))).where("cells <> 0")
    # only what windows of cells with a core in common can reach is left of a segment
    step, masks = cell_step(length, anchor), range(1 << CELLS)
    table = lambda f: F.element_at(F.array(*[F.lit(f(m)) for m in masks]), F.col("cells") + 1)
    lowest, highest = table(lambda m: (m & -m).bit_length() - 1), table(lambda m: m.bit_length() - 1)
    begin = F.greatest(F.col("start"), F.col("pos") - step * (highest + 1))
    end = F.least(F.col("start") + F.length("piece"), F.col("pos") + length - step * lowest)
    chosen = cut(shared.select("anchor", "doc_id", begin.alias("start"), F.substring("piece", begin - F.col("start") + 1, end - begin).alias("piece")))
    drop_cut(spark, pieces)
    large = cut(chosen.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("anchor"))
    shards = max(1, -(-(chosen.agg(F.sum(F.length("piece") + 1)).first()[0] or 0) // shard_bytes))
    mild, spans = chosen, [copies]
    if not large.isEmpty():
        mild = chosen.join(large, "anchor", "left_anti")
        windows = cut(chosen.join(large, "anchor", "left_semi").select("doc_id", "start", "piece").mapInArrow(lambda it: _window_hashes(it, length), "window long, doc_id long, pos int"))
        firsts = windows.groupBy("window").agg(F.min(F.struct("doc_id", "pos")).alias("f")).select("f.*")
        spans.append(windows.join(firsts, ["doc_id", "pos"], "left_anti").select("doc_id", F.col("pos").alias("a"), (F.col("pos") + length).alias("b")))

    def sort_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from repeated_windows(batches, length, budget, small)

    segments = mild.select(F.pmod("anchor", F.lit(shards)).cast("int").alias("shard"), "doc_id", "start", "piece")
    spans.append(segments.groupBy("shard").applyInArrow(sort_shard, "doc_id long, a int, b int"))
    out = cut(functools.reduce(DataFrame.union, spans).groupBy("doc_id").agg(F.collect_list(F.struct("a", "b")).alias("spans")))
    for table in (marked, chosen, large):
        drop_cut(spark, table)
    return out


def merged(starts: np.ndarray, ends: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Ranges that touch or overlap joined, cut at size."""
    order = np.argsort(starts, kind="stable")
    a, b = starts[order].astype(np.int64), np.maximum.accumulate(np.minimum(ends[order].astype(np.int64), size))
    if not len(a):
        return []
    first = np.flatnonzero(np.concatenate([[True], a[1:] > b[:-1]]))
    last = np.append(first[1:], len(a)) - 1
    return [(x, y) for x, y in zip(a[first].tolist(), b[last].tolist(), strict=True) if y > x]


def without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for a, b in spans:
        parts.append(raw[at:a])
        at = b
    return b"".join([*parts, raw[at:]])


def whole_characters(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans drawn in so far that none cuts a UTF-8 character."""
    out = []
    for a, b in spans:
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        if b > a:
            out.append((a, b))
    return out


def _digest(batches):
    for batch in batches:
        offsets, (starts, ends) = structs(batch.column(2), "a", "b")
        rows = []
        for i, (doc, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1), strict=True)):
            raw, own = (text.as_py() or "").encode(), slice(offsets[i], offsets[i + 1])
            gone = merged(starts[own], ends[own], len(raw))
            rows.append((doc, len(raw), sum(b - a for a, b in gone), len(gone), hashlib.sha256(without(raw, gone)).hexdigest()))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [*[pa.int64()] * 4, pa.string()], strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _shorten(batches):
    for batch in batches:
        offsets, (starts, ends) = structs(batch.column("__spans"), "a", "b")
        texts = []
        for i, text in enumerate(batch.column("text")):
            raw, own = (text.as_py() or "").encode(), slice(offsets[i], offsets[i + 1])
            gone = whole_characters(raw, merged(starts[own], ends[own], len(raw)))
            texts.append(without(raw, gone).decode() if gone else text.as_py())
        names = batch.schema.names[:-1]
        yield pa.RecordBatch.from_arrays([pa.array(texts, batch.schema.field("text").type) if n == "text" else batch.column(n) for n in names], names)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """docs with repeated passages taken out of text (whole characters only) and n_chars, where there is one, counted anew.

    Null texts stay null; a row with a null doc_id is left as it is, and its text makes nothing a repeat; doc_id is the
    key, so rows that share it must be equal and then lose the same; texts of less than 100 bytes keep all; an empty
    table gives no rows; other columns pass through.
    """
    spans = repeats(docs)
    shared = id_filter(spans)
    shape = docs.schema
    touched = split(docs, shared, True)
    joined = touched.join(spans.select(F.col("doc_id").alias("__doc"), F.col("spans").alias("__spans")), F.col("doc_id") == F.col("__doc"), "left").select(*[F.col(f"`{c}`") for c in docs.columns], "__spans")
    short = joined.mapInArrow(_shorten, shape)
    if "n_chars" in docs.columns:
        short = short.withColumn("n_chars", F.length("text").cast(shape["n_chars"].dataType)).select(*docs.columns)
    return split(docs, shared, False).union(short)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row (to the byte, without regard to characters)."""
    spans = repeats(docs)
    shared = id_filter(spans)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    zero, raw = F.lit(0).cast("long"), F.coalesce(F.col("text"), F.lit("")).cast("binary")
    whole = split(docs, shared, False).select("doc_id", F.octet_length(raw).cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.sha2(raw, 256).alias("kept_sha256"))
    touched = split(docs, shared, True).join(spans, "doc_id", "left").select("doc_id", "text", "spans")
    return whole.union(touched.mapInArrow(_digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))


def op5_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
