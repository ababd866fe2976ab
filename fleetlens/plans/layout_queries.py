"""Registered query of the curved layout: two lookups of one table."""

from pyspark.sql import functions as F

from fleetlens.operators import layout
from fleetlens.plans.base_queries import P_SQL, typed
from fleetlens.plans.registration import query
from fleetlens.sources.shared import new_path


@query(f"WITH {P_SQL} SELECT 'project' AS lookup, event_id, value FROM p WHERE project = 'p3' AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13' UNION ALL SELECT 'resource', event_id, value FROM p WHERE resource_id = 'r7'")
def curved_lookups(spark, d):
    """K-8, S-5: by project and time, and by resource, from the same files."""
    path = new_path(spark, "curved")
    layout.write_curved(typed(spark, d), path, ["project", "ts", "resource_id"], ["resource_id"], 16)
    t = spark.read.parquet(path)
    by_project = t.where("project = 'p3' and ts >= timestamp_ntz'2024-01-10' and ts < timestamp_ntz'2024-01-13'")
    return by_project.select(F.lit("project").alias("lookup"), "event_id", "value").unionByName(t.where("resource_id = 'r7'").select(F.lit("resource").alias("lookup"), "event_id", "value"))
