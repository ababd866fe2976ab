"""Reads for dashboards, digests and explanations; sinks."""

import json
import re
import time

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.operators.chunks import token_chunks  # noqa: F401  the digests' chunks, beside their other operators
from fleetlens.sources.shared import cut


def search(rows: DataFrame, text: str | None = None, equals: dict | None = None, least_risk: float | None = None, tag: tuple[str, str] | None = None, offset: int = 0, limit: int | None = None) -> DataFrame:
    """F-8: criteria that are given hold together; newest-highest risk first."""
    for name, value in (equals or {}).items():
        rows = rows.where(F.col(name) == value)
    if text:
        fields = [F.coalesce(F.col(c), F.lit("")).rlike(f"(?i){text}") for c in ("resource_id", "project", "component", "location")]
        any_of = fields[0]
        for f in fields[1:]:
            any_of = any_of | f
        rows = rows.where(any_of)
    if least_risk is not None:
        rows = rows.where(F.col("risk") >= least_risk)
    if tag:
        rows = rows.where(F.exists(F.map_entries("tags"), lambda e: (F.lower(e.key) == tag[0].lower()) & (e.value == tag[1])))
    if offset or limit is not None:
        rows = rows.orderBy(F.desc("risk"), "resource_id")
        rows = rows.offset(offset) if offset else rows
        rows = rows.limit(limit) if limit is not None else rows
    return rows


def platform_stats(rows: DataFrame) -> DataFrame:
    """A-18: totals overall, by provider and by category."""
    return rows.groupingSets([[], ["provider"], ["category"]], "provider", "category").agg(F.count_distinct("resource_id").alias("resources"), F.count_distinct("project").alias("projects"), F.sum((F.col("risk") >= 75).cast("long")).alias("high"), C.r(F.avg("risk")).alias("mean_risk"))


def tag_match(tags: Column, wanted: Column) -> Column:
    """F-10: every wanted pair is there, keys without regard to case; an empty filter matches all."""
    low = F.transform_keys(tags, lambda k, _: F.lower(k))
    return F.forall(F.map_entries(wanted), lambda e: C.is_true(F.get(F.map_values(F.map_filter(low, lambda k, v: k == F.lower(e.key))), 0) == e.value))


#: Parts of keys whose values are hidden.
SECRET_KEYS = ["password", "secret", "token", "credential", "private", "apikey", "api_key", "access_key"]


def redact(details: Column, most: int = 400) -> Column:
    """E-3: a flat map without secret keys, with URLs and credential-like values hidden and long values cut."""
    safe = F.map_filter(details, lambda k, v: ~F.lower(k).rlike("|".join(SECRET_KEYS)))
    hidden = lambda v: F.when(v.rlike("(?i)https?://|AKIA[0-9A-Z]{16}|^[A-Za-z0-9+/_-]{32,}={0,2}$"), F.lit("[hidden]")).otherwise(F.when(F.length(v) > most, F.concat(F.substring(v, 1, most), F.lit("..."))).otherwise(v))
    return F.transform_values(safe, lambda k, v: hidden(v))


def explanation(risk: Column, category: Column, z: Column, burst: Column, forest: Column, trend: Column, feature: Column, day_change: Column, reliability: Column, profile_confidence: Column, profile_days: Column) -> Column:
    """E-1: sentences about risk, drivers, trend and profile, in that order, joined by spaces."""
    name = F.regexp_replace(F.regexp_replace(feature, "^canonical_", ""), "_", " ")
    drivers = F.concat_ws(
        " ",
        F.when(z >= 0.7, "The value is far from what is usual at this time of the week.").when(z >= 0.4, "The value is somewhat unusual for this time of the week."),
        F.when(burst >= 0.6, "It spiked sharply within the reporting interval.").when(burst >= 0.4, "It was a little bursty within the reporting interval."),
        F.when(forest >= 0.55, "Taken together, its signals set it apart from its pool."),
    )
    return F.concat_ws(
        " ",
        F.format_string("Risk %.1f of 100 for this %s resource.", C.r(risk, 1), category),
        F.when(drivers == "", "No single signal stands out.").otherwise(drivers),
        F.when(trend == "stable", "There is no marked trend.").when(trend.isNotNull(), F.format_string("%s is %s by about %.2f an hour (reliability: %s).", name, trend, F.abs(day_change) / 24, reliability)),
        F.when(profile_confidence.isNotNull(), F.format_string("Profile confidence %.2f from %d days.", profile_confidence, profile_days.cast("long"))),
    )


def digest_line(rows: DataFrame) -> DataFrame:
    """L-1: one line of text per prediction and its token estimate, a quarter of its characters and 1 at least."""
    text = F.concat_ws(" | ", F.col("resource_id"), F.col("category"), F.format_string("risk %.1f", F.col("risk")), F.col("severity"), C.format_value(F.col("feature"), F.col("value")))
    return rows.withColumn("digest", text).withColumn("tokens", F.greatest(F.lit(1), F.floor(F.length(text) / 4)).cast("long"))


def summarise(chunks: DataFrame, call=None) -> DataFrame:
    """L-3 to L-5: a text per project from an injected callable (project, lines) -> text; without one, a fixed summary.
    A failing call gives an error row, not a failed job. `chunks` has project, chunk and digest."""

    def run(batches):
        for pdf in batches:
            out = []
            for project, n, lines in zip(pdf["project"], pdf["chunk"], pdf["lines"], strict=True):
                try:
                    out.append((project, int(n), call(project, list(lines)) if call else f"{len(lines)} findings, the first: {lines[0]}", None))
                except Exception as e:
                    out.append((project, int(n), None, str(e)))
            yield pd.DataFrame(out, columns=["project", "chunk", "summary", "error"])

    grouped = chunks.groupBy("project", "chunk").agg(F.sort_array(F.collect_list("digest")).alias("lines"))  # a chunk is bounded by its token budget
    return grouped.mapInPandas(run, "project string, chunk int, summary string, error string")


def reduce_summaries(parts: DataFrame, call=None, fan_in: int = 8) -> DataFrame:
    """L-3: the texts of a project's chunks made one by call(project, texts), fan_in at a time and again until one is left,
    so that no call and no group grows with the project. Without a call, texts are joined by lines. A text alone stays as it
    is; errors are carried along, and a project has an empty text only where all its chunks failed."""

    def run(batches):
        for pdf in batches:
            out = []
            for project, n, items in zip(pdf["project"], pdf["chunk"], pdf["items"], strict=True):
                texts = [i["summary"] for i in items if i["summary"] is not None]
                errors = [i["error"] for i in items if i["error"] is not None]
                text = texts[0] if texts else None
                if len(texts) > 1:
                    try:
                        text = call(project, texts) if call else "\n".join(texts)
                    except Exception as e:
                        text, errors = None, [*errors, str(e)]
                out.append((project, int(n), text, "; ".join(errors) or None))
            yield pd.DataFrame(out, columns=["project", "chunk", "summary", "error"])

    level = cut(parts.select("project", "chunk", "summary", "error"))
    last = level.agg(F.max("chunk")).first()[0] or 0
    counts = level.groupBy("project").agg(F.count("*").alias("chunks"))
    while last > 0:
        items = F.array_sort(F.collect_list(F.struct("chunk", "summary", "error")))
        grouped = level.groupBy("project", F.floor(F.col("chunk") / fan_in).cast("int").alias("group")).agg(items.alias("items"))
        level = cut(grouped.withColumnRenamed("group", "chunk").mapInPandas(run, "project string, chunk int, summary string, error string"))
        last //= fan_in
    return level.join(counts, "project").select("project", "summary", "error", "chunks")


def with_retries(call, retries: int = 2, wait: float = 2.0):
    """L-4: the callable tried again after a failure, after `wait` seconds, then twice and so on; the last failure is raised."""

    def tried(*args):
        for n in range(retries):
            try:
                return call(*args)
            except Exception:
                time.sleep(wait * (n + 1))
        return call(*args)

    return tried


def parse_reply(text: str) -> dict:
    """L-4: a provider's reply as an object: thoughts and a code fence around it are taken off; what is no JSON object
    becomes its narrative, marked so."""
    body = re.sub(r"(?s)<think>.*?</think>", "", text).strip()
    fenced = re.fullmatch(r"(?is)```(?:json)?\s*(.*?)\s*```", body)
    body = fenced[1] if fenced else body
    try:
        found = json.loads(body)
    except ValueError:
        found = None
    return found if isinstance(found, dict) else {"narrative": body, "risk_level": "UNKNOWN", "parse_error": True}


def write_by_category(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K-3: one folder per category."""
    rows.write.mode(mode).partitionBy("category").parquet(path)


def export_csv(rows: DataFrame, path: str) -> None:
    """K-7."""
    rows.write.mode("overwrite").csv(path, header=True)
