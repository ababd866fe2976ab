"""Files that each lookup of a curved layout has to open, by the footers' least and greatest values."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from fleetlens.operators import layout


def opened(path, **wanted):
    """Number of files whose ranges overlap (low, high) of all wanted columns, and of all files."""
    n = files = 0
    for name in glob.glob(f"{path}/*.parquet"):
        m = pq.ParquetFile(name)
        at = {m.schema_arrow.names[i]: i for i in range(len(m.schema_arrow.names))}
        groups = [{c: m.metadata.row_group(g).column(at[c]).statistics for c in wanted} for g in range(m.metadata.num_row_groups)]
        files += bool(groups)
        n += any(all(s[c].min <= hi and lo <= s[c].max for c, (lo, hi) in wanted.items()) for s in groups)
    return n, files


def rows(spark, n=20000):
    return spark.range(n).select((F.col("id") * 7919 % n).alias("t"), F.concat(F.lit("p"), F.lpad((F.col("id") % 40).cast("string"), 3, "0")).alias("project"), F.concat(F.lit("r"), F.lpad((F.col("id") % 1000).cast("string"), 5, "0")).alias("resource_id"))


def test_both_lookups_open_few_files(spark, tmp_path):
    curved, plain = str(tmp_path / "curved"), str(tmp_path / "plain")
    layout.write_curved(rows(spark), curved, ["project", "t"], ["resource_id"], files=64)
    rows(spark).repartition(64).write.parquet(plain)
    side = 8  # the square root of the number of files: what one strip of a square curve takes
    projects = [{"project": (f"p{k:03d}", f"p{k:03d}")} for k in range(0, 40, 3)]
    times = [{"t": (500 * k, 500 * k + 499)} for k in range(40)]  # about as wide as a range, so most windows lie in two
    by_project, by_time = ([opened(curved, **w)[0] for w in wanted] for wanted in (projects, times))
    both = [opened(curved, **p, **w)[0] for p in projects[::4] for w in times[::8]]
    assert opened(curved)[1] == 64 and {opened(plain, **w)[0] for w in projects[:2] + times[:2]} == {64}
    assert max(by_project) <= 2 * side and sum(by_time) <= 2 * side * len(times) and max(by_time) <= 3 * side and max(both) <= side
    back = spark.read.parquet(curved)
    assert back.count() == 20000 and back.exceptAll(rows(spark)).count() == 0


def test_a_hot_value_is_split_and_nulls_and_no_rows_pass(spark, tmp_path):
    hot = rows(spark, 6000).withColumn("project", F.when(F.col("t") % 3 == 0, "hot").when(F.col("t") % 3 == 1, F.col("project"))).withColumn("t", F.lit(1))
    path = str(tmp_path / "hot")
    layout.write_curved(hot, path, ["project", "t"], files=12)
    t = spark.read.parquet(path)
    assert t.where("project = 'hot'").select(F.input_file_name()).distinct().count() >= 3
    assert t.count() == 6000 and t.where("project is null").count() == 2000
    layout.write_curved(hot.limit(0), path, ["project", "t"], files=12)
    assert spark.read.schema(hot.schema).parquet(path).count() == 0
