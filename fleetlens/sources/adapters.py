"""The driver's tables as telemetry: long series from events, metric documents from orders, inventory from customers."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.sources.catalog import Catalog

CATEGORIES = ["Storage", "Compute", "Network", "Container", "Databases"]
PROVIDERS = ["AWS", "Azure", "GCP", "OCI"]
COMPONENTS = [["EBS", "S3"], ["EC2", "Lambda"], ["VPC", "Load_Balancers"], ["Azure_Kubernetes_Service", "Container_Registry"], ["DynamoDB", "Mystery_DB"]]


def _pick(values: list[str], at) -> F.Column:
    return F.element_at(F.array(*map(F.lit, values)), (at + 1).cast("int"))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T: one row per reading, from events."""
    e = Catalog(spark, sf_dir).read("events")
    user, k = F.col("user_id"), F.get_json_object("props", "$.k").cast("double")
    flat = F.flatten(F.array(*[F.array(*map(F.lit, c)) for c in COMPONENTS]))
    return e.select(
        F.col("event_id"), F.concat(F.lit("r"), user).alias("resource_id"), _pick(CATEGORIES, user % 5).alias("category"), _pick(PROVIDERS, user % 4).alias("provider"),
        F.element_at(flat, (user % 5 * 2 + F.floor(user / 5) % 2 + 1).cast("int")).alias("component"), F.concat(F.lit("loc"), (F.floor(user / 100) % 2).cast("string")).alias("location"),
        F.concat(F.lit("a"), (user % 20).cast("string")).alias("account_id"), F.concat(F.lit("p"), (user % 10).cast("string")).alias("project"),
        F.col("event_type").alias("feature"), "ts", "value", (F.col("value") * (1 + k / 20.0)).alias("vmax"), k.alias("sample_count"),
    )


T_SQL = """
t AS (
  SELECT event_id, 'r' || user_id AS resource_id, (['Storage','Compute','Network','Container','Databases'])[(user_id % 5 + 1)::INT] AS category,
         (['AWS','Azure','GCP','OCI'])[(user_id % 4 + 1)::INT] AS provider,
         (['EBS','S3','EC2','Lambda','VPC','Load_Balancers','Azure_Kubernetes_Service','Container_Registry','DynamoDB','Mystery_DB'])[(user_id % 5 * 2 + (user_id // 5) % 2 + 1)::INT] AS component,
         'loc' || ((user_id // 100) % 2) AS location, 'a' || (user_id % 20) AS account_id, 'p' || (user_id % 10) AS project,
         event_type AS feature, ts, value, value * (1 + CAST(json_extract_string(props, '$.k') AS DOUBLE) / 20.0) AS vmax, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS sample_count
  FROM events)
"""


def metric_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M: one metric document per order."""
    o = Catalog(spark, sf_dir).read("orders")
    return o.select(
        F.col("o_orderkey").alias("_id"), F.col("o_custkey").cast("string").alias("resource_id"), F.when(F.col("o_orderkey") % 10 == 0, F.lit(-1)).otherwise(F.col("o_custkey") % 7).cast("string").alias("account_id"),
        F.col("o_orderpriority").alias("metric"), F.col("o_totalprice").alias("value"), F.col("o_orderdate").alias("from_date"), F.col("o_orderdate").alias("merged_at"), F.col("o_orderstatus").alias("project"),
    )


M_SQL = """
m AS (SELECT o_orderkey AS _id, CAST(o_custkey AS VARCHAR) AS resource_id, CAST(CASE WHEN o_orderkey % 10 = 0 THEN -1 ELSE o_custkey % 7 END AS VARCHAR) AS account_id,
             o_orderpriority AS metric, o_totalprice AS value, o_orderdate AS from_date, o_orderdate AS merged_at, o_orderstatus AS project FROM orders)
"""


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I: one inventory row per customer, and a newer version of every third."""
    read = Catalog(spark, sf_dir).read
    c = read("customer").join(F.broadcast(read("nation")), F.col("c_nationkey") == F.col("n_nationkey"))  # nation is a fixed dimension
    one = c.select(F.col("c_custkey").cast("string").alias("element_id"), (F.col("c_custkey") % 7).cast("string").alias("account_id"), F.col("c_mktsegment").alias("project"), F.col("n_name").alias("location"), F.col("c_acctbal").alias("balance"), F.lit(1).cast("long").alias("version"))
    return one.unionByName(one.where(F.col("element_id").cast("long") % 3 == 0).withColumn("version", F.lit(2).cast("long")).withColumn("project", F.concat("project", F.lit("-v2"))))


I_SQL = """
i1 AS (SELECT CAST(c_custkey AS VARCHAR) AS element_id, CAST(c_custkey % 7 AS VARCHAR) AS account_id, c_mktsegment AS project, n_name AS location, c_acctbal AS balance, CAST(1 AS BIGINT) AS version FROM customer JOIN nation ON c_nationkey = n_nationkey),
i AS (SELECT * FROM i1 UNION ALL SELECT element_id, account_id, project || '-v2', location, balance, 2 FROM i1 WHERE CAST(element_id AS BIGINT) % 3 = 0)
"""
