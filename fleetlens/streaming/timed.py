"""Timed state (R-3, R-6, R-8, R-10): newest values and alert changes by event time, behind a watermark.

Rows older than the watermark are not lost: they come out as rows of kind `late` and touch no state. A key from which nothing
came for `quiet` is forgotten by a timer, so state holds what lived within that time and not all keys ever seen. Timers stand
in event time (state's own time to live counts processing time, which a repeat of a stream can't give again). A key's rows
come in Arrow batches; of a key, one value is held, or what hasn't been passed by the watermark. Newest values are held by
bucket, many keys in one state. A row without a time is late.
Times before 1970 are late, as a stream's first watermark is there.
"""

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STAMP = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
OUT = "kind string, at long, version long, body string, previous string"
#: Newest values: so many states, each of all keys of a hash, as a call of Python costs more than hundreds of rows; rows of
#: state in one message.
BUCKETS, PIECE = 1024, 4096


def with_rocks(spark: SparkSession) -> None:
    """Timed state needs the RocksDB store; set it where another is set, before the query starts."""
    if not spark.conf.get(PROVIDER, "").endswith("RocksDBStateStoreProvider"):
        spark.conf.set(PROVIDER, ROCKS)


def frame(rows: list[tuple], key: tuple, keys: list[str]):
    """Rows of (kind, at, version, body, previous) with their key; whole numbers stay whole beside nulls."""
    import pandas as pd

    out = pd.DataFrame(rows, columns=["kind", "at", "version", "body", "previous"]).astype({"at": "Int64", "version": "Int64"})
    for place, (name, value) in enumerate(zip(keys, key)):
        out.insert(place, name, value)
    return out


class Timed(StatefulProcessor):
    """Splits late rows off. Times and versions come as text, so that none is rounded where another is null."""

    def __init__(self, keys: list[str], quiet: timedelta):
        self.keys, self.quiet = keys, int(quiet.total_seconds() * 1000)

    def init(self, handle) -> None:
        self.handle = handle
        self.prepare()

    def split(self, rows, mark: int):
        """(on time, late) lists of (at, version, body) of each batch."""
        for pdf in rows:
            told = [(None if a is None else int(a), None if v is None else int(v), b) for a, v, b in zip(pdf["row_at"], pdf["row_version"], pdf["row_body"])]
            yield [r for r in told if r[0] is not None and r[0] // 1000 >= mark], [r for r in told if r[0] is None or r[0] // 1000 < mark]

    def wake(self, ms: int) -> None:
        """The key's one timer, moved."""
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(ms)

    def close(self) -> None:
        """Nothing is held outside the store."""


class Newest(Timed):
    """Holds key, version, body and when last heard of, of all keys of a bucket. A version replaces another if either is null
    or it is newer; of one batch, rows with a null version come last and the greatest body of equal versions counts."""

    def prepare(self) -> None:
        self.held = self.handle.getListState("held", ", ".join(f"key_{k} string" for k in range(len(self.keys))) + ", version long, body string, heard long")

    def read(self) -> dict:
        n = len(self.keys)
        return {tuple(r[:n]): tuple(r[n:]) for r in self.held.get()} if self.held.exists() else {}

    def write(self, state: dict) -> int | None:
        """When the first of its keys will be quiet."""
        rows = [(*key, *value) for key, value in state.items()]
        if not rows:
            self.held.clear()
            return None
        self.held.put(rows[:PIECE])
        for k in range(PIECE, len(rows), PIECE):
            self.held.appendList(rows[k : k + PIECE])
        return min(heard for _, _, heard in state.values()) // 1000 + self.quiet + 1

    def frame(self, rows: list[tuple]):
        """Rows of (kind, at, version, body, previous, *key)."""
        keys = list(zip(*[r[5:] for r in rows]))
        out = frame([r[:5] for r in rows], (), [])
        for place, name in enumerate(self.keys):
            out.insert(place, name, list(keys[place]))
        return out

    def handleInputRows(self, key, rows, timerValues):
        mark, fresh, last = timerValues.getCurrentWatermarkInMs(), {}, {}
        columns = [*[f"key_{k}" for k in range(len(self.keys))], "row_at", "row_version", "row_body"]
        for pdf in rows:
            late = []
            for row in zip(*[pdf[c].tolist() for c in columns]):
                own, (at, version) = row[:-3], (None if v is None else int(v) for v in row[-3:-1])
                if at is None or at // 1000 < mark:
                    late.append(("late", at, version, row[-1], None, *own))
                    continue
                rank = (version is None, version or 0, row[-1])
                if own not in fresh:
                    fresh[own], last[own] = rank, at
                    continue
                fresh[own], last[own] = max(fresh[own], rank), max(last[own], at)
            if late:
                yield self.frame(late)
        if not fresh:
            return
        state, changed = self.read(), []
        for own, (unversioned, version, body) in fresh.items():
            before = state.get(own)
            now, heard = (None if unversioned else version, body), last[own]
            if before is not None:
                newer = now[0] is None or before[0] is None or now[0] > before[0]
                now, heard = now if newer else before[:2], max(heard, before[2])
            if (*now, heard) != before:
                state[own] = (*now, heard)
                changed.append(("state", heard, *now, None, *own))
        if changed:
            self.wake(self.write(state))
            yield self.frame(changed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        mark, state = timerValues.getCurrentWatermarkInMs(), self.read()
        gone = [own for own, (_, _, heard) in state.items() if heard // 1000 + self.quiet < mark]
        out = [("quiet", state[own][2], *state[own][:2], None, *own) for own in gone]
        for own in gone:
            del state[own]
        due = self.write(state)
        if due is not None:
            self.handle.registerTimer(due)
        if out:
            yield self.frame(out)


class Changes(Timed):
    """Holds rows until the watermark has passed them, so that they are compared in order of time whatever the order they
    came in; then the last body and its time. A body counts as new after `quiet` without a row."""

    def prepare(self) -> None:
        self.waiting = self.handle.getListState("waiting", "at long, version long, body string")
        self.last = self.handle.getValueState("last", "body string, at long")

    def handleInputRows(self, key, rows, timerValues):
        first = None
        for fresh, late in self.split(rows, timerValues.getCurrentWatermarkInMs()):
            if late:
                yield frame([("late", *r, None) for r in late], key, self.keys)
            if fresh:
                self.waiting.appendList(fresh)
                first = min([r[0] for r in fresh] + ([] if first is None else [first]))
        if first is not None:
            due = first // 1000 + 1
            if due < min(self.handle.listTimers(), default=due + 1):
                self.wake(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        mark = timerValues.getCurrentWatermarkInMs()
        waiting = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        ready = sorted((r for r in waiting if r[0] // 1000 < mark), key=lambda r: (r[0], r[2]))
        rest = [r for r in waiting if r[0] // 1000 >= mark]
        body, at = self.last.get() if self.last.exists() else (None, None)
        out = []
        for row in ready:
            if at is not None and row[0] // 1000 - at // 1000 > self.quiet:
                body = None
            if row[2] != body:
                out.append(("change", *row, body))
            at, body = row[0], row[2]
        if ready:
            self.waiting.clear()
            if rest:
                self.waiting.put(rest)
        if at is not None and at // 1000 + self.quiet < mark:
            self.last.clear()
            at = None
        elif ready:
            self.last.update((body, at))
        due = [r[0] // 1000 + 1 for r in rest] + ([] if at is None else [at // 1000 + self.quiet + 1])
        if due:
            self.handle.registerTimer(max(min(due), mark + 1))
        if out:
            yield frame(out, key, self.keys)


def timed(stream: DataFrame, processor: Timed, time: str, version, body, lateness: str, buckets: int | None = None) -> DataFrame:
    """The stream through a processor. The watermark follows `time`, but the column that goes on is another: on the column
    itself Spark would drop late rows before the processor sees them. With buckets, a state is that of all keys of a hash."""
    keys = processor.keys
    own = [F.col(k).cast("string").alias(f"key_{place}" if buckets else k) for place, k in enumerate(keys)]
    told = [F.unix_micros(time).cast("string").alias("row_at"), version.cast("long").cast("string").alias("row_version"), body.alias("row_body")]
    marked = stream.withWatermark(time, lateness).select(*own, *told)
    if buckets:
        marked = marked.withColumn("_bucket", F.pmod(F.xxhash64(*[f"key_{place}" for place in range(len(keys))]), F.lit(buckets)))
    return marked.groupBy(*(["_bucket"] if buckets else keys)).transformWithStateInPandas(processor, ", ".join(f"`{k}` string" for k in keys) + ", " + OUT, "append", "eventTime")


def latest_state(stream: DataFrame, keys: list[str], time: str, version: str, fields: dict[str, str], lateness: str = "15 minutes", quiet: timedelta = timedelta(days=7), buckets: int = BUCKETS) -> DataFrame:
    """R-3: kind, keys as strings, at (when the key was last heard of; a late row's own time), version, fields. Kind `state`
    is a key's value whenever a batch changed it, `quiet` the value that was forgotten, `late` a row set aside. A batch reads
    and writes the state of the buckets that its keys lie in; a task holds one bucket's keys. A stream keeps its number."""
    with_rocks(stream.sparkSession)
    out = timed(stream, Newest(keys, quiet), time, F.col(version), F.to_json(F.struct(*fields), STAMP), lateness, buckets)
    read = F.from_json("body", ", ".join(f"`{n}` {t}" for n, t in fields.items()), STAMP)
    return out.withColumn("_f", read).select("kind", *keys, F.timestamp_micros("at").alias("at"), F.col("version").alias(version), "_f.*")


def alert_changes(stream: DataFrame, keys: list[str], time: str = "ts", label: str = "severity", lateness: str = "15 minutes", quiet: timedelta = timedelta(days=7)) -> DataFrame:
    """R-10, W-11: kind, keys, time, label, previous. Kind `change` is a row whose label differs from its key's last one in
    order of time (equal times by label), once the watermark has passed it; `late` a row set aside. A null label is ''."""
    with_rocks(stream.sparkSession)
    out = timed(stream, Changes(keys, quiet), time, F.lit(None), F.coalesce(F.col(label), F.lit("")), lateness)
    return out.select("kind", *keys, F.timestamp_micros("at").alias(time), F.col("body").alias(label), "previous")
