"""Column functions: normalisation, labels, numbers and keys. All stay inside generated code."""

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlens.functions import vocabulary as V


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(values.items())])


def category(raw: Column) -> Column:
    """P-1: canonical category; an unknown spelling stays as it is, trimmed."""
    return F.coalesce(literal_map(V.CATEGORY_ALIASES)[F.lower(F.trim(raw))], F.trim(raw))


def provider(raw: Column) -> Column:
    """P-2: canonical provider; null is `unknown`."""
    return F.coalesce(literal_map(V.PROVIDER_ALIASES)[F.lower(F.trim(raw))], F.trim(raw), F.lit("unknown"))


def resource_type(component: Column, category_: Column) -> Column:
    """P-5: type of a component, `other_<category>` for an unknown one."""
    return F.coalesce(literal_map(V.COMPONENT_TYPES)[component], F.concat(F.lit("other_"), F.lower(category_)))


def join_id(raw: Column) -> Column:
    """P-21."""
    return F.trim(raw.cast("string"))


def get_ci(m: Column, *keys: str) -> Column:
    """P-3: first non-null of several keys of a map, without regard to case."""
    low = F.transform_keys(m, lambda k, _: F.lower(k))
    return F.coalesce(*[low[k.lower()] for k in keys])


def stat(m: Column) -> Column:
    """P-6: (value, stat): the first key of the priority list that holds a number."""
    low = F.transform_keys(m, lambda k, _: F.lower(k))
    tried = F.array(*[F.struct(low[k].try_cast("double").alias("value"), F.lit(k).alias("stat")) for k in V.STAT_PRIORITY])
    return F.get(F.filter(tried, lambda x: x.value.isNotNull()), 0)


def stat_bundle(m: Column) -> Column:
    """P-7."""
    low = F.transform_keys(m, lambda k, _: F.lower(k))
    return F.struct(*[low[k].try_cast("double").alias(n) for k, n in (("average", "avg"), ("maximum", "vmax"), ("minimum", "vmin"), ("samplecount", "sample_count"))])


def transform(value: Column, kind: Column) -> Column:
    """P-10."""
    return F.when(kind == "inv", 100 - value).otherwise(value)


def seconds(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / 1e6


def hours_between(a: Column, b: Column) -> Column:
    return (seconds(b) - seconds(a)) / 3600


def r(value: Column, places: int = 6) -> Column:
    """Rounded, with a fixed shift that keeps averages of two-decimal values off exact ties."""
    return F.round(value + F.lit(3.7e-8), places)


def hash_key(*parts) -> Column:
    """X-2: first 24 hex digits of SHA-256 over parts joined by ::."""
    return F.substring(F.sha2(F.concat_ws("::", *parts), 256), 1, 24)


def ladder(value: Column, steps: list, otherwise: str) -> Column:
    out = F.lit(otherwise)
    for limit, label in reversed(steps):
        out = F.when(value >= limit, label).otherwise(out)
    return out


def severity(risk: Column) -> Column:
    """X-9."""
    return ladder(risk, V.SEVERITIES, "INFO")


def badge(risk: Column) -> Column:
    return ladder(risk, V.BADGES, "green")


def channel(severity_: Column) -> Column:
    return F.coalesce(literal_map(V.CHANNELS)[severity_], F.lit("suppressed"))


def is_true(flag: Column) -> Column:
    """P-24: null counts as false."""
    return F.coalesce(flag, F.lit(False))


def threshold_state(feature: Column, value: Column) -> Column:
    """X-12: critical, warn or ok by the feature's thresholds, `unknown` without any."""
    out = F.lit("unknown")
    for name, (warn, crit, inverted) in V.DIGEST_THRESHOLDS.items():
        bad, poor = (value <= crit, value <= warn) if inverted else (value >= crit, value >= warn)
        out = F.when(feature == name, F.when(bad, "critical").when(poor, "warn").otherwise("ok")).otherwise(out)
    return F.when(value.isNull(), "unknown").otherwise(out)


def format_value(feature: Column, value: Column) -> Column:
    """X-10: with a unit by the feature's name."""
    size = F.when(value >= 1 << 30, F.format_string("%.2f GB", value / (1 << 30))).when(value >= 1 << 20, F.format_string("%.2f MB", value / (1 << 20))).when(value >= 1 << 10, F.format_string("%.2f KB", value / (1 << 10))).otherwise(F.format_string("%.0f B", value))
    return F.when(feature.endswith("_pct"), F.format_string("%.1f%%", value)).when(feature.endswith("_bytes"), size).when(feature.endswith("_ms"), F.format_string("%.1f ms", value)).otherwise(F.format_string("%.2f", value))


def mad(value: str) -> Column:
    """V-4: median absolute deviation as a normal deviation; an aggregate over a collected array."""
    values = F.sort_array(F.collect_list(value))
    middle = lambda a: (F.get(a, F.floor((F.size(a) - 1) / 2).cast("int")) + F.get(a, F.floor(F.size(a) / 2).cast("int"))) / 2
    return 1.4826 * F.aggregate(F.array(values), F.lit(None).cast("double"), lambda _, v: F.aggregate(F.array(middle(v)), F.lit(None).cast("double"), lambda _, m: middle(F.sort_array(F.transform(v, lambda x: F.abs(x - m))))))
