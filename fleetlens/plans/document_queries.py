"""Registered queries of documents of unknown shape, made as JSON text from customers and events."""

from pyspark.sql import functions as F

from fleetlens.functions import documents
from fleetlens.operators import normalize
from fleetlens.plans.registration import query
from fleetlens.sources.catalog import Catalog


@query("""SELECT c_custkey AS id, '{"owner":{' || CASE WHEN c_custkey % 4 = 0 THEN '' ELSE '"note":"' || c_name || '",' END || '"team":' || c_nationkey || '},"segment":"' || c_mktsegment || '","sizes":[1' || CASE WHEN c_custkey % 3 = 0 THEN ',"x"' ELSE '' END || ']}' AS safe FROM customer""")
def redacted_documents(spark, d):
    """E-3: secrets at several levels go, and what is empty without them."""
    c = Catalog(spark, d).read("customer")
    note = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("see https://x.example/"), F.col("c_name"))).otherwise(F.col("c_name"))
    owner = F.struct(F.col("c_nationkey").alias("team"), F.col("c_name").alias("API-Token"), note.alias("note"), F.struct(F.lit(1).alias("deep")).alias("below"))
    last = F.when(F.col("c_custkey") % 3 == 0, F.lit(" x ")).otherwise(F.lit("arn:aws:x"))
    text = F.to_json(F.struct(F.col("c_mktsegment").alias("segment"), owner.alias("owner"), F.struct(F.col("c_name").alias("phone")).alias("ssh keys"), F.struct(F.lit("").alias("none")).alias("empty"), F.array(F.lit("1"), last).alias("sizes")))
    text = F.regexp_replace(text, r'\["1"', "[1")  # a list of a number and a text
    parsed = c.select(F.col("c_custkey").alias("id"), F.parse_json(text).alias("v"))
    return parsed.select("id", F.to_json(documents.redacted(F.col("v"))).alias("safe"))


@query("""WITH e AS (SELECT *, date_trunc('second', ts) AS s FROM events)
SELECT CAST(event_id AS VARCHAR) AS _id, 'r' || user_id AS resource_id, CASE WHEN event_id % 3 = 2 OR event_id % 4 = 3 THEN date_trunc('day', ts) ELSE s END AS ts, value, CASE WHEN event_id % 3 = 0 THEN 'average' ELSE 'delta' END AS stat FROM e
UNION ALL SELECT CAST(event_id AS VARCHAR), 'r' || user_id, s, value + 1, 'maximum' FROM e WHERE event_id % 3 = 0""")
def dated_documents(spark, d):
    """P-8, P-9: points in an array, an object or on the document; times as text, wrapped, wrapped milliseconds or absent."""
    e = Catalog(spark, d).read("events").withColumn("s", F.date_trunc("second", "ts"))
    iso = F.date_format("s", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    quoted, value = F.concat(F.lit('"'), iso, F.lit('"')), F.col("value").cast("string")
    date = lambda x: F.concat(F.lit('{"$date":'), x, F.lit("}"))
    ms = F.concat(F.lit('{"$numberLong":"'), F.unix_millis(F.col("s").cast("timestamp")).cast("string"), F.lit('"}'))
    kind = F.col("event_id") % 4
    time = F.when(kind == 0, quoted).when(kind == 1, date(quoted)).when(kind == 2, date(ms)).otherwise(F.lit("null"))
    several = F.concat(F.lit('"metric_value":[{"Timestamp":'), time, F.lit(',"Average":'), value, F.lit('},{"timestamp":'), date(quoted), F.lit(',"Maximum":'), (F.col("value") + 1).cast("string"), F.lit("}]"))
    one = F.concat(F.lit('"metric_value":{"timestamp":'), time, F.lit(',"Delta":"'), value, F.lit('"}'))
    above = F.concat(F.lit('"Delta":"'), value, F.lit('"'))
    shape = F.col("event_id") % 3
    day = F.concat(F.lit('"'), F.date_format("ts", "yyyy-MM-dd"), F.lit('"'))
    text = F.concat(F.lit('{"_id":{"$oid":"'), F.col("event_id").cast("string"), F.lit('"},"resourceId":"r'), F.col("user_id").cast("string"), F.lit('","from_date":'), date(day), F.lit(","), F.when(shape == 0, several).when(shape == 1, one).otherwise(above), F.lit("}"))
    docs = documents.metric_documents(e.select(text.alias("line")), "line")
    return normalize.points(docs).select("_id", "resource_id", "ts", "value", "stat")
