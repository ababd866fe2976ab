"""Profiles replaced by key, documents newest first, tables by prefix, CSV."""

import datetime as dt

from fleetlens.operators import assemble, serve
from fleetlens.sources.catalog import Catalog, load_documents

PROFILE = "rtype string, category string, feature string, n long, mean double"


def test_profiles_are_replaced_by_key(spark, tmp_path):
    path = str(tmp_path / "profiles")
    make = lambda rows: spark.createDataFrame(rows, PROFILE)
    assemble.save_profiles(make([("vm", "Compute", "cpu", 5, 1.0), ("vm", "Compute", "mem", 5, 2.0), (None, "Compute", "cpu", 5, 3.0), ("disk", "Storage", "io", 5, 4.0)]), path)
    new = make([("vm", "Compute", "cpu", 9, 10.0), ("vm", "Compute", "cpu", 8, 11.0), (None, "Compute", "cpu", 6, 12.0), ("vpc", "Network", "up", 7, 13.0)])
    for _ in range(2):
        assemble.upsert_profiles(spark, path, new)
        got = {(r.rtype, r.category, r.feature, r.n, r["mean"]) for r in spark.read.parquet(path).collect()}
        assert got == {("vm", "Compute", "cpu", 9, 10.0), ("vm", "Compute", "mem", 5, 2.0), (None, "Compute", "cpu", 6, 12.0), ("disk", "Storage", "io", 5, 4.0), ("vpc", "Network", "up", 7, 13.0)}
    assemble.upsert_profiles(spark, path, new.limit(0))
    assert spark.read.parquet(path).count() == 5
    assert [r.feature for r in assemble.load_profiles(spark, path, "Network").collect()] == ["up"]


def test_documents_of_categories_newest_first(spark):
    day = lambda n: dt.datetime(2024, 1, n)
    rows = [("a", "ec2 ", day(1), day(1)), ("b", "COMPUTE", day(3), day(1)), ("c", "compute", day(3), day(2)), ("d", None, day(4), day(4)), ("e", "Storage", None, None)]
    docs = spark.createDataFrame(rows, "_id string, category string, from_date timestamp_ntz, created_at timestamp_ntz")
    assert [r._id for r in load_documents(docs, ["Compute"]).collect()] == ["c", "b"]
    assert [r._id for r in load_documents(docs).collect()] == ["d", "c", "b", "a", "e"]
    assert [r._id for r in load_documents(docs, limit=2).collect()] == ["d", "c"] and load_documents(docs.limit(0)).count() == 0


def test_tables_by_prefix_and_csv(spark, tmp_path):
    for name in ("lens_a", "lens_b", "other_c"):
        spark.range(1).createOrReplaceTempView(name)
    assert sorted(r.name for r in Catalog(spark, "x").tables("lens_").collect()) == ["lens_a", "lens_b"]
    assert Catalog(spark, "x", {"a": "/y"}).path("a") == "/y" and Catalog(spark, "x").path("a") == "x/a.parquet"
    path = str(tmp_path / "csv")
    rows = spark.createDataFrame([(1, 'a "b", c\nd'), (2, None)], "id long, text string")
    serve.export_csv(rows, path)
    back = spark.read.option("header", True).option("multiLine", True).csv(path)
    assert sorted((r.id, r.text) for r in back.collect()) == [("1", 'a "b", c\nd'), ("2", None)]
