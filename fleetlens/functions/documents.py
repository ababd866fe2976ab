"""Documents of unknown shape as variants: redaction at every level, moments and numbers in their wrapped forms, and metric
documents read from JSON text. All are column expressions; no row is told what its schema is beforehand."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key that holds one of these (lower case, `_` for blanks and `-`) goes with all below it.
SECRET_PARTS = [
    "password", "passwd", "secret", "token", "key", "credential", "auth", "cert", "certificate", "connection_string", "connectionstring",
    "endpoint", "uri", "url", "ssh", "fingerprint", "private", "access", "subscription_id", "tenant_id", "client_id", "client_secret", "apikey",
]
#: Text that goes wherever it stands; what has a `://` goes too.
SECRET_TEXT = "(?i)(-----BEGIN|arn:|[A-Za-z0-9+/]{40,}={0,2}$|[a-f0-9]{32,})"
#: The fields that may hold a document's resource, project names and provider, first non-null first.
ALTERNATIVES = {
    "resource_id": ["element_id", "resourceId", "resource_id", "inventory_id"],
    "account_id": ["account_id"],
    "category": ["category"],
    "component": ["component", "service_type", "resource_type"],
    "provider": ["service_name", "provider"],
    "location": ["location"],
    "metric": ["metric"],
    "project": ["project"],
}
MOMENTS = ["from_date", "to_date", "created_at", "merged_at"]
STATS = ["average", "delta", "maximum", "sum", "total", "minimum", "count", "samplecount", "value"]


def kind(v: Column) -> Column:
    """OBJECT, ARRAY, STRING, BIGINT, VOID and so on."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def redacted(v: Column, depth: int = 2, most: int = 400) -> Column:
    """E-3: a variant without secret keys and texts, nulls, empty texts and what is empty without them, at every level down
    to `depth` (the root is level 0; what lies deeper goes). Texts are trimmed and cut to `most` characters."""
    if depth < 0:
        return F.lit(None).cast("variant")
    inner = lambda x: redacted(x, depth - 1, most)
    open_key = lambda k: ~F.regexp_replace(F.lower(k), "[- ]", "_").rlike("|".join(SECRET_PARTS))
    fields = F.map_filter(F.try_variant_get(v, "$", "map<string,variant>"), lambda k, x: open_key(k))
    fields = F.map_filter(F.transform_values(fields, lambda k, x: inner(x)), lambda k, x: x.isNotNull())
    items = F.filter(F.transform(F.try_variant_get(v, "$", "array<variant>"), inner), lambda x: x.isNotNull())
    text = F.regexp_replace(F.try_variant_get(v, "$", "string"), r"^\s+|\s+$", "")
    short = F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - 3), F.lit("…"))).otherwise(text)
    seen = (text != "") & ~text.rlike(SECRET_TEXT) & ~text.contains("://")
    what = kind(v)
    return (
        F.when((what == "OBJECT") & (F.size(fields) > 0), F.to_variant_object(fields))
        .when((what == "ARRAY") & (F.size(items) > 0), F.to_variant_object(items))
        .when((what == "STRING") & seen, short.cast("variant"))
        .when(~what.isin("OBJECT", "ARRAY", "STRING", "VOID"), v)
    )


def moment(v: Column) -> Column:
    """P-8: a time from text, `{"$date": text}`, `{"$date": milliseconds}` or `{"$date": {"$numberLong": text}}`, in the
    session's zone; null for all else."""
    own = F.when(kind(v) == "STRING", F.try_variant_get(v, "$", "string"))
    text = F.coalesce(F.try_variant_get(v, "$['$date']", "string"), own)
    ms = F.coalesce(F.try_variant_get(v, "$['$date']['$numberLong']", "bigint"), F.try_variant_get(v, "$['$date']", "bigint"))
    return F.coalesce(text.try_cast("timestamp"), F.timestamp_millis(ms)).cast("timestamp_ntz")


def plain(v: Column) -> Column:
    """Text of a value, out of `$oid` and `$number...` where it is wrapped in one; null of null."""
    wrapped = [F.try_variant_get(v, f"$['{k}']", "string") for k in ("$oid", "$numberLong", "$numberInt", "$numberDouble", "$numberDecimal")]
    return F.coalesce(*wrapped, F.try_variant_get(v, "$", "string"))


def entry(v: Column) -> Column:
    """A point's keys with their values as text; its time as a time's text."""
    return F.transform_values(F.try_variant_get(v, "$", "map<string,variant>"), lambda k, x: F.when(F.lower(k) == "timestamp", F.coalesce(moment(x).cast("string"), plain(x))).otherwise(plain(x)))


def points(v: Column) -> Column:
    """P-9: metric_value as an array of entries, whether it is an array, an object or absent (then one entry of the stats on
    the document itself)."""
    value = F.try_variant_get(v, "$.metric_value", "variant")
    several = F.filter(F.transform(F.try_variant_get(value, "$", "array<variant>"), entry), lambda m: m.isNotNull())
    above = F.map_filter(entry(v), lambda k, x: F.lower(k).isin(STATS) & x.isNotNull())
    return F.when(kind(value) == "ARRAY", several).when(kind(value) == "OBJECT", F.array(entry(value))).otherwise(F.array(above))


def metric_documents(rows: DataFrame, column: str) -> DataFrame:
    """JSON text as metric documents, ready for normalize.points: _id, the fields of ALTERNATIVES as text, the MOMENTS,
    metric_value and `broken` (the text where it is no JSON object; all else is null and metric_value has no point)."""
    at = lambda name: F.try_variant_get("_v", f"$['{name}']", "variant")
    parsed = rows.select(column, F.try_parse_json(column).alias("_v"))
    whole = kind(F.col("_v")).eqNullSafe(F.lit("OBJECT"))
    first = [F.coalesce(*[plain(at(n)) for n in names]).alias(out) for out, names in ALTERNATIVES.items()]
    return parsed.select(
        plain(at("_id")).alias("_id"), *first, *[moment(at(m)).alias(m) for m in MOMENTS],
        F.when(whole, points(F.col("_v"))).otherwise(F.array().cast("array<map<string,string>>")).alias("metric_value"), F.when(~whole, F.col(column)).alias("broken"),
    )
