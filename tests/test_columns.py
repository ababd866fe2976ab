from pyspark.sql import functions as F

from fleetlens.functions import columns as C


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_aliases(spark):
    assert one(spark, C.category(F.lit(" Networking "))) == "Network"
    assert one(spark, C.category(F.lit("Mainframe "))) == "Mainframe"
    assert one(spark, C.provider(F.lit(None).cast("string"))) == "unknown"
    assert one(spark, C.resource_type(F.lit("Mystery_DB"), F.lit("Databases"))) == "other_databases"


def test_stat_priority_takes_the_first_key_that_holds_a_number(spark):
    m = F.create_map(F.lit("Average"), F.lit("n/a"), F.lit("Delta"), F.lit("10516"), F.lit("Value"), F.lit("3"))
    assert tuple(one(spark, C.stat(m))) == (10516.0, "delta")


def test_percentages_are_never_rescaled(spark):
    assert one(spark, C.transform(F.lit(0.41), F.lit("p"))) == 0.41
    assert one(spark, C.transform(F.lit(30.0), F.lit("inv"))) == 70.0


def test_labels(spark):
    assert [one(spark, C.severity(F.lit(float(x)))) for x in (95, 75, 50, 49.9)] == ["CRITICAL", "HIGH", "WARNING", "INFO"]
    assert one(spark, C.channel(F.lit("INFO"))) == "suppressed"
    assert one(spark, C.threshold_state(F.lit("canonical_burst_balance_pct"), F.lit(9.0))) == "critical"
    assert one(spark, C.threshold_state(F.lit("canonical_cpu_pct"), F.lit(None).cast("double"))) == "unknown"


def test_median_absolute_deviation(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 100)], "v double")
    assert abs(df.agg(C.mad("v").alias("x")).first().x - 1.4826) < 1e-9
