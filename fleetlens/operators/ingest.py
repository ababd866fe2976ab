"""Deduplication, inventory versions and enrichment."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def content_hash(docs: DataFrame, without: tuple[str, ...] = ("_id",)):
    names = sorted(c for c in docs.columns if c not in without)
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in names])), 256)


def dedup_documents(docs: DataFrame) -> DataFrame:
    """A-1: one document of each content, that with the smallest _id. Partial aggregation keeps a content that is very
    common from being one task's work."""
    rest = [c for c in docs.columns if c != "_id"]
    kept = docs.withColumn("_h", content_hash(docs)).groupBy("_h").agg(F.min_by(F.struct("_id", *rest), "_id").alias("d"))
    return kept.select("d.*").select(*docs.columns)


def latest_inventory(inventory: DataFrame, version: str = "version") -> DataFrame:
    """R-3 in batch: the newest version of each (element_id, account_id); a null version is older than any other."""
    rest = [c for c in inventory.columns if c not in ("element_id", "account_id")]
    newest = F.max_by(F.struct(*rest), F.coalesce(F.col(version).cast("long"), F.lit(-(1 << 62))))
    return inventory.groupBy("element_id", "account_id").agg(newest.alias("i")).select("element_id", "account_id", "i.*")


def enrich(docs: DataFrame, inventory: DataFrame) -> DataFrame:
    """J-1: documents joined to the newest inventory version of (resource, account). The strategy is left to Spark,
    which broadcasts the inventory only where its size says so."""
    inv = latest_inventory(inventory)
    on = (F.trim(docs["resource_id"].cast("string")) == F.trim(inv["element_id"].cast("string"))) & (docs["account_id"] == inv["account_id"])
    extra = [inv[c].alias(f"inv_{c}") for c in inv.columns if c not in ("element_id", "account_id")]
    return docs.join(inv, on, "inner").select(docs["*"], *extra)


def unmatched(docs: DataFrame, inventory: DataFrame) -> DataFrame:
    """Q-18: documents without inventory, kept for later."""
    keys = inventory.select(F.trim(F.col("element_id").cast("string")).alias("_e"), F.col("account_id").alias("_a")).distinct()
    return docs.join(keys, (F.trim(docs["resource_id"].cast("string")) == F.col("_e")) & (docs["account_id"] == F.col("_a")), "left_anti")


def merge_precedence(enriched: DataFrame) -> DataFrame:
    """P-20: project always comes from the inventory, its provenance is kept."""
    return enriched.select("_id", "resource_id", "account_id", F.col("project").alias("document_project"), F.col("inv_project").alias("project"), F.col("inv_location").alias("location"), F.col("inv_version").alias("inventory_version"))


def duplicate_keys(inventory: DataFrame) -> DataFrame:
    """A-20."""
    return inventory.groupBy("element_id", "account_id").agg(F.count("*").alias("versions"), F.sum(F.col("version").isNull().cast("long")).alias("missing_versions")).where("versions > 1")


def change_log(docs: DataFrame, operation: str, captured_at) -> DataFrame:
    """S-17: documents as rows of the append-only history."""
    return docs.select(F.col("_id").alias("source_id"), F.lit(operation).alias("operation_type"), F.lit(captured_at).alias("captured_at"), F.to_json(F.struct(*docs.columns)).alias("document"))


def latest_rows(rows: DataFrame, keys: list[str], order: str = "ts", tie: str = "event_id") -> DataFrame:
    """W-1: the newest row of each key."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order), F.desc(tie))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
