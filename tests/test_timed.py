"""Timed state: order of arrival, late rows, forgotten keys, null and odd values, state size."""

import datetime as dt

import pytest

from fleetlens.streaming import jobs, timed

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
KIND = "k string, c string, ts timestamp, severity string, version long, v double, note string"


def at(hours):
    return None if hours is None else T0 + dt.timedelta(hours=hours)


@pytest.fixture
def runs(spark, tmp_path):
    """Runs batches one after another; gives the rows of each run and the number of rows in state after it."""

    def run(build, *batches):
        rows, sizes = [], []
        for batch in batches:
            spark.createDataFrame([(k, "c", at(h), s, ver, v, n) for k, h, s, ver, v, n in batch], KIND).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            q = jobs.run_once(build(spark.readStream.schema(KIND).parquet(str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "mark"))
            q.awaitTermination()
            sizes.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
        return spark.read.parquet(str(tmp_path / "out")).collect(), sizes

    return run


def row(k, h, s=None, version=None, v=None, note=None):
    return (k, h, s, version, v, note)


def hours(t):
    return t and (t.replace(tzinfo=None) - T0.replace(tzinfo=None)).total_seconds() / 3600


def changes(stream):
    return timed.alert_changes(stream, ["k", "c"], lateness="2 hours", quiet=dt.timedelta(hours=10))


def newest(stream):
    return timed.latest_state(stream, ["k", "c"], "ts", "version", {"v": "double", "note": "string"}, "2 hours", dt.timedelta(hours=10))


def test_changes_come_in_order_of_time(runs):
    first = [row("a", 3, "HIGH"), row("a", 1, "INFO"), row("a", 2, "INFO"), row(None, 2, "LOW")]
    got, _ = runs(changes, first, [row("a", 2.5, "HIGH"), row("a", 4, "INFO"), row("a", 0.5, "OLD"), row("a", None, "X")], [row("z", 20, "INFO")])
    told = sorted((r.kind, r.k or "", hours(r.ts) or -1, r.severity, r.previous or "") for r in got)
    assert told == [
        ("change", "", 2, "LOW", ""), ("change", "a", 1, "INFO", ""), ("change", "a", 2.5, "HIGH", "INFO"), ("change", "a", 4, "INFO", "HIGH"),
        ("late", "a", -1, "X", ""), ("late", "a", 0.5, "OLD", ""),
    ]


def test_a_quiet_key_starts_anew_and_a_null_label_is_empty(runs):
    got, _ = runs(changes, [row("a", 1, "HIGH"), row("b", 1, None)], [row("a", 11.5, "HIGH"), row("a", 11.5, "HIGH"), row("b", 11, None)], [row("z", 40, "INFO")])
    assert sorted((r.k, hours(r.ts), r.severity, r.previous) for r in got) == [("a", 1, "HIGH", None), ("a", 11.5, "HIGH", None), ("b", 1, "", None)]


def test_state_falls_when_keys_go_quiet(runs):
    many = [row(f"k{n}", 1, "INFO", n, float(n)) for n in range(50)]
    got, sizes = runs(newest, many, [row("z", 2, None, 1, 1.0)], [row("z", 30, None, 2, None, "é")])
    assert sizes[1] > 50 and sizes[2] < 10
    quiet = [r for r in got if r.kind == "quiet" and r.k != "z"]
    assert len(quiet) == 50 and {(r.k, r.version, r.v) for r in quiet} == {(f"k{n}", n, float(n)) for n in range(50)}
    assert [(r.v, r.note) for r in got if r.k == "z" and r.version == 2] == [(None, "é")]


def test_newest_versions_nulls_and_large_numbers(runs):
    big = 2**53 + 1
    got, _ = runs(newest, [row("a", 1, None, big, 1.0), row("a", 2, None, big - 1, 2.0), row("b", 1, None, 5, 1.0)], [row("a", 3, None, big, 9.0), row("b", 3, None, None, 3.0, "null version")], [row("b", 3, None, 1, 4.0)])
    a, b = ([(hours(r.at), r.version, r.v) for r in sorted(got, key=lambda r: (r.at, r.version is not None)) if r.k == k and r.kind == "state"] for k in "ab")
    assert a == [(2, big, 1.0), (3, big, 1.0)]
    assert b == [(1, 5, 1.0), (3, None, 3.0), (3, 1, 4.0)]


def test_no_rows(runs):
    assert runs(newest, [])[0] == []


def test_many_keys_share_one_state_and_one_timer(spark, tmp_path):
    """More keys than one message to the store takes; each is replaced, kept, set aside and forgotten as if it were alone."""
    keys = [f"k{n}" for n in range(5000)] + [None]
    batches = [
        [row(k, 1 + n % 3, None, n, float(n)) for n, k in enumerate(keys)],
        [row(k, 9, None, n + 1 if n % 2 else n - 1, -1.0) for n, k in enumerate(keys) if n % 5 == 0] + [row("k1", None, None, 9, 9.0), row("k7", 9, None, None, 7.0)],
        [row("k2", 0.5, None, 99, 99.0), row("k4", 30, None, 99, 4.0)],
    ]
    sizes, timers = [], []
    for batch in batches:
        spark.createDataFrame([(k, "c", at(h), s, ver, v, n) for k, h, s, ver, v, n in batch], KIND).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = timed.latest_state(spark.readStream.schema(KIND).parquet(str(tmp_path / "in")), ["k", "c"], "ts", "version", {"v": "double"}, "2 hours", dt.timedelta(hours=10), buckets=1)
        q = jobs.run_once(stream, str(tmp_path / "out"), str(tmp_path / "mark"))
        q.awaitTermination()
        state = q.lastProgress["stateOperators"][0]
        sizes.append(state["numRowsTotal"])
        timers.append(state["customMetrics"]["numRegisteredTimers"])
    assert max(sizes) <= 1 and max(timers) <= 1
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r.k, r.v) for r in got if r.kind == "late"} == {("k1", 9.0), ("k2", 99.0)}
    last = {k: (n, float(n)) for n, k in enumerate(keys)} | {k: (n + 1, -1.0) for n, k in enumerate(keys) if n % 5 == 0 and n % 2} | {"k7": (None, 7.0)}
    heard = {k: 1 + n % 3 for n, k in enumerate(keys)} | {k: 9 for n, k in enumerate(keys) if n % 5 == 0} | {"k7": 9}
    quiet = {r.k: (r.version, r.v) for r in got if r.kind == "quiet"}
    del last["k4"]
    assert quiet == last and {r.k: hours(r.at) for r in got if r.kind == "quiet"} == {k: h for k, h in heard.items() if k != "k4"}
    assert [(r.version, r.v, hours(r.at)) for r in got if r.k == "k4" and r.kind == "state"] == [(4, 4.0, 2), (99, 4.0, 30)]
