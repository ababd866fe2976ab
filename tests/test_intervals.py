"""Spans found by cells against comparing all with all."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from fleetlens.operators import decisions, intervals

START = datetime(2024, 1, 1)


def drawn(spark, seed, n, m):
    r = random.Random(seed)
    rows = [(k, START + timedelta(seconds=r.choice([r.randrange(40 * 86400), 900 * r.randrange(4000), 14400 * r.randrange(240)]))) for k in range(n)] + [(n, None)]
    spans = []
    for k in range(m):
        a = START + timedelta(seconds=r.choice([r.randrange(40 * 86400), 900 * r.randrange(4000), 256 * 900 * r.randrange(15)]))
        spans.append((k, a, a + timedelta(seconds=r.choice([0, 1, 899, 900, 86400, 10 * 86400, 256 * 900, r.randrange(30 * 86400), -5]))))
    spans += [(m, None, START), (m + 1, START, None), (m + 2, datetime(1960, 1, 1), datetime(1969, 12, 31, 23)), (m + 3, datetime(1960, 1, 1), datetime(2030, 1, 1))]
    return rows, spans, spark.createDataFrame(rows, "id long, ts timestamp_ntz"), spark.createDataFrame(spans, "span int, s timestamp_ntz, e timestamp_ntz")


def test_equals_comparing_all(spark):
    for seed in range(3):
        rows, spans, a, b = drawn(spark, seed, 300, 60)
        got = sorted((r.id, r.span) for r in intervals.held(a, b, "ts", "s", "e", F.col("id")).select("id", "span").collect())
        assert got == sorted((k, j) for k, t in rows for j, s, e in spans if t and s and e and s <= t <= e)


def test_cells_of_a_span_do_not_overlap_and_are_few(spark):
    _, spans, _, b = drawn(spark, 9, 1, 200)
    seen = {}
    for r in intervals.cells(b.where("span < 200"), "s", "e").where("_slice = 0").collect():
        size = 16**r._level
        ticks = set(range(r._cell * size, (r._cell + 1) * size))
        assert not ticks & seen.setdefault(r.span, [set(), 0])[0]
        seen[r.span][0].update(ticks)
        seen[r.span][1] += 1
    for k, s, e in spans[:200]:
        if s <= e:
            lo, hi = (int((t - datetime(1970, 1, 1)).total_seconds() // 900) for t in (s, e))
            assert seen[k][0] == set(range(lo, hi + 1)) and seen[k][1] <= 60 + (hi - lo) // 256
        else:
            assert k not in seen


def test_no_spans_and_clashing_names(spark):
    _, _, a, b = drawn(spark, 1, 20, 5)
    assert intervals.held(a, b.limit(0), "ts", "s", "e", F.col("id")).count() == 0
    assert intervals.held(a.limit(0), b, "ts", "s", "e", F.col("id")).count() == 0


def test_a_long_span_shares_no_key_with_all_rows(spark):
    """A row every ten minutes of forty days beside a span over all: the fullest key holds little more than four hours."""
    rows = spark.range(40 * 144).select("id", (F.lit(START).cast("timestamp") + F.make_interval(mins=F.col("id") * 10)).cast("timestamp_ntz").alias("ts"))
    placed = intervals.places(rows, "ts", F.col("id"), [0, 1, 2]).groupBy(*intervals.KEYS).count()
    assert placed.agg(F.max("count")).first()[0] <= 2 * 24


def test_first_window_is_named_and_odd_rows_stay(spark):
    t = START + timedelta(hours=5)
    rows = spark.createDataFrame([("a", "r1", "Compute", t, "HIGH", True), ("b", "r2", None, t, "HIGH", True), ("c", None, "Network", None, "HIGH", True), ("d", None, "Network", t, "HIGH", True)], "prediction_id string, resource_id string, category string, ts timestamp_ntz, severity string, trigger boolean")
    windows = spark.createDataFrame([(2, None, "*", START, START + timedelta(days=100), "late"), (1, "*", "Compute", START, START + timedelta(hours=5), "early"), (0, "r9", "*", START, START + timedelta(days=1), "other")], "window_id int, resource_id string, category string, starts_at timestamp_ntz, ends_at timestamp_ntz, reason string")
    got = {r.prediction_id: (r.reason, r.severity, r.trigger) for r in decisions.suppress(rows, windows).collect()}
    assert got == {"a": ("early", "INFO", False), "b": ("late", "INFO", False), "c": (None, "HIGH", True), "d": ("late", "INFO", False)}
