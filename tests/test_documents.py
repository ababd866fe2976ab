"""Redaction against a plain recursion, times in all forms, documents of odd shapes."""

import datetime as dt
import json
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlens.functions import documents as D
from fleetlens.operators import normalize


def plainly(raw, depth=2):
    """The rule said as a recursion."""
    if depth < 0 or raw is None:
        return None
    if isinstance(raw, dict):
        kept = {k: plainly(v, depth - 1) for k, v in raw.items() if not any(p in re.sub("[- ]", "_", k.lower()) for p in D.SECRET_PARTS)}
        return {k: v for k, v in kept.items() if v is not None} or None
    if isinstance(raw, list):
        return [x for x in (plainly(v, depth - 1) for v in raw) if x is not None] or None
    if isinstance(raw, str):
        s = raw.strip(" \t\n\r\f\v")
        if not s or re.search(D.SECRET_TEXT, s) or "://" in s:
            return None
        return s[:397] + "…" if len(s) > 400 else s
    return raw


texts = st.one_of(st.sampled_from(["", " ", "arn:x", "http://a", "a" * 401, "f" * 32, " é ", "12", "true", "2024-01-01"]), st.text("abé 1", max_size=5))
keys = st.sampled_from(["name", "API-Token", "Tenant ID", "os", "a.b", "it's", "né", "$x", ""])
trees = st.recursive(st.one_of(st.none(), st.booleans(), st.integers(-(2**40), 2**40), st.sampled_from([0.5, -2.25]), texts), lambda t: st.one_of(st.lists(t, max_size=3), st.dictionaries(keys, t, max_size=4)), max_leaves=12)


@settings(max_examples=4, deadline=None)
@given(st.lists(trees, min_size=40, max_size=80))
def test_redaction_is_the_plain_recursion(spark, docs):
    rows = spark.createDataFrame([(n, json.dumps(x)) for n, x in enumerate(docs)], "n int, j string").withColumn("v", F.parse_json("j"))
    got = {r.n: r.s and json.loads(r.s) for r in rows.select("n", F.to_json(D.redacted(F.col("v"))).alias("s")).collect()}
    for n, x in enumerate(docs):
        assert got[n] == plainly(x), x


def test_moments(spark):
    forms = ['"2024-01-02T03:04:05Z"', '"2024-01-02"', '{"$date":"2024-01-02T05:04:05+02:00"}', '{"$date":1704164645000}', '{"$date":{"$numberLong":"1704164645000"}}', '"soon"', "17", "null", "{}", '{"$date":null}', "[1]"]
    rows = spark.createDataFrame([(n, x) for n, x in enumerate(forms)], "n int, j string").withColumn("v", F.parse_json("j"))
    got = [r.t for r in rows.orderBy("n").select(D.moment(F.col("v")).alias("t")).collect()]
    when = dt.datetime(2024, 1, 2, 3, 4, 5)
    assert got == [when, dt.datetime(2024, 1, 2), when, when, when] + [None] * 6


def test_documents_of_odd_shapes(spark):
    docs = [
        {"_id": 1, "resourceId": 7, "service_name": None, "provider": "AWS", "metric_value": [{"Average": {"$numberDouble": "1.5"}, "Timestamp": {"$date": "2024-01-01T00:00:00Z"}}, 3, None]},
        {"_id": {"$oid": "x"}, "element_id": "e", "resource_id": "later", "Average": "2.5", "created_at": "2024-01-03"},
        {"_id": "m", "metric_value": None, "Sum": "none", "tags": {"a": [1]}},
        {"_id": "n", "metric_value": "text", "count": 4, "from_date": {"$date": "2024-01-05"}},
        {},
    ]
    lines = [json.dumps(x) for x in docs] + ["not json", "[1]", "", None]
    rows = spark.createDataFrame([(x, "clash") for x in lines], "line string, _id string")
    out = D.metric_documents(rows, "line")
    assert [r.broken for r in out.where("broken is not null").orderBy("broken").collect()] == ["", "[1]", "not json"]
    got = sorted(((r._id, r.resource_id, r.value, str(r.ts)) for r in normalize.points(out).where("value is not null").collect()), key=str)
    assert got == [("1", "7", 1.5, "2024-01-01 00:00:00"), ("n", None, 4.0, "2024-01-05 00:00:00"), ("x", "e", 2.5, "2024-01-03 00:00:00")]
    assert out.where("provider = 'AWS'").count() == 1 and out.count() == 9 and out.limit(0).count() == 0
