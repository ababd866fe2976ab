"""Registered queries of change feeds: each event is a change of its user's document of its event type."""

from pyspark.sql import functions as F

from fleetlens.plans.registration import query
from fleetlens.sources.catalog import Catalog
from fleetlens.sources.shared import new_path
from fleetlens.streaming import changes

KEYS = ["user_id", "event_type"]
OP = "CASE WHEN event_id % 5 = 0 THEN 'delete' WHEN event_id % 3 = 0 THEN 'replace' ELSE 'update' END"
C_SQL = f"c AS (SELECT event_id AS token, {OP} AS op, user_id, event_type, value, lag(value) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS before_value, lag({OP}) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS was FROM events)"


def feed(spark, d):
    return Catalog(spark, d).read("events").select(F.col("event_id").alias("token"), F.expr(OP).alias("op"), *KEYS, "value")


@query(f"WITH {C_SQL} SELECT token, user_id, event_type, value FROM c QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY token DESC) = 1 AND op <> 'delete'")
def change_feed_state(spark, d):
    """S-9, R-1, R-5: half of the feed, a stop, the rest from the resume token; then the last batch once more."""
    every, at, log, checkpoint = feed(spark, d), new_path(spark, "feed"), new_path(spark, "log"), new_path(spark, "checkpoint")
    middle = every.agg(F.expr("(min(token) + max(token)) div 2")).first()[0]
    for part in (F.col("token") <= middle, F.col("token") > middle):
        every.where(part).write.mode("append").parquet(at)
        changes.follow(changes.changes(spark, at, every.schema), log, KEYS, checkpoint).awaitTermination()
    changes.keep(log, KEYS)(every.where(F.col("token") > middle), 1)  # a batch that comes twice
    return changes.state(spark.read.parquet(log).drop("batch"), KEYS)


@query(f"WITH {C_SQL} SELECT token, op, CASE WHEN op = 'delete' THEN CASE WHEN before_value IS NULL THEN '' ELSE 'value' END WHEN before_value IS DISTINCT FROM value THEN 'value' ELSE '' END AS fields FROM c")
def change_differences(spark, d):
    """S-9's before-images: which fields a change changed."""
    from pyspark.sql import Window

    told = feed(spark, d).withColumn("before_value", F.lag("value").over(Window.partitionBy(*KEYS).orderBy("token")))  # what a database would send along
    return told.select("token", "op", F.array_join(changes.differences(told, ["value"]), ",").alias("fields"))
