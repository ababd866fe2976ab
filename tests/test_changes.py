"""Change feeds: restarts, repeats, deletes and odd rows."""

from fleetlens.streaming import changes as C

SCHEMA = "token long, op string, id string, v double, batch_note string"


def write(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).repartition(2).write.mode("append").parquet(path)


def test_a_restart_loses_and_repeats_nothing(spark, tmp_path):
    feed, seen, mark = str(tmp_path / "feed"), [], str(tmp_path / "mark")
    run = lambda **k: C.changes(spark, feed, SCHEMA, **k).writeStream.foreachBatch(lambda b, n: seen.append(sorted(r.token for r in b.collect()))).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    write(spark, [(k, "insert", f"k{k}", 1.0, None) for k in range(10)], feed)
    run()
    run()
    write(spark, [(k, "insert", f"k{k}", 1.0, None) for k in range(10, 25)], feed)
    run()
    assert sorted(t for b in seen for t in b) == list(range(25)) and [b for b in seen if b] == [list(range(10)), list(range(10, 25))]


def test_a_new_query_resumes_after_a_token(spark, tmp_path):
    feed, log = str(tmp_path / "feed"), str(tmp_path / "log")
    write(spark, [(k, "insert", f"k{k}", None, None) for k in range(10)], feed)
    C.follow(C.changes(spark, feed, SCHEMA, 6), log, ["id"], str(tmp_path / "mark")).awaitTermination()
    assert sorted(r.token for r in C.state(spark.read.parquet(log), ["id"]).collect()) == [7, 8, 9]


def test_state_after_deletes_repeats_and_null_keys(spark, tmp_path):
    rows = [(1, "insert", "a", 1.0, None), (2, "delete", "a", None, None), (3, "insert", "a", 3.0, None), (4, "insert", None, 4.0, None), (5, "insert", "b", 5.0, None), (6, "delete", "b", None, None), (7, None, "c", None, "x")]
    log = spark.createDataFrame(rows + rows[:3], SCHEMA)
    want = {("a", 3.0, 3), (None, 4.0, 4), ("c", None, 7)}
    assert {(r.id, r.v, r.token) for r in C.state(log, ["id"]).collect()} == want
    assert C.state(log.limit(0), ["id"]).count() == 0
    path = str(tmp_path / "log")
    sink = C.keep(path, ["id"])
    sink(log.where("token <= 4"), 0)
    sink(log.where("token > 4"), 1)
    sink(log.where("token > 4"), 1)
    sink(log.where("token <= 4"), 0)
    kept = spark.read.parquet(path)
    assert kept.count() == 4 and {(r.id, r.v, r.token) for r in C.state(kept, ["id"]).collect()} == want


def test_differences(spark):
    rows = [(1, "insert", None, 1.0, None, None), (2, "update", 1.0, 1.0, "x", "y"), (3, "replace", 1.0, None, "y", "y"), (4, "delete", None, None, "y", None)]
    x = spark.createDataFrame(rows, "token long, op string, before_v double, v double, before_w string, w string")
    got = [r.d for r in x.withColumn("d", C.differences(x, ["v", "w"])).orderBy("token").collect()]
    assert got == [["v"], ["w"], ["v"], ["w"]]


def test_files_without_statistics_empty_files_and_null_tokens(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    feed, log = tmp_path / "feed", str(tmp_path / "log")
    feed.mkdir()
    kind = pa.schema([("token", pa.int64()), ("op", pa.string()), ("id", pa.string()), ("v", pa.float64()), ("batch_note", pa.string())])
    for n, (tokens, kept) in enumerate([([3, None, 5], False), ([], True), ([None, None], True), ([9], True)]):
        table = pa.table({"token": tokens, "op": ["insert"] * len(tokens), "id": [f"{n}-{t}" for t in tokens], "v": [1.0] * len(tokens), "batch_note": [None] * len(tokens)}, schema=kind)
        pq.write_table(table, feed / f"{n}.parquet", write_statistics=kept)
    C.follow(C.changes(spark, str(feed), SCHEMA), log, ["id"], str(tmp_path / "mark")).awaitTermination()
    assert sorted(r.token for r in C.state(spark.read.parquet(log), ["id"]).collect()) == [3, 5, 9]
