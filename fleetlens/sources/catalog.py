"""Where tables are and how they are read (S-1, S-2, S-18)."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions import columns as C


@dataclass
class Catalog:
    """Logical names to parquet paths below a root; registered overrides win."""

    spark: SparkSession
    root: str
    overrides: dict[str, str] | None = None

    def path(self, name: str) -> str:
        return (self.overrides or {}).get(name, f"{self.root}/{name}.parquet")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def tables(self, prefix: str = "") -> DataFrame:
        """S-18: tables of the session's catalog whose name starts with a prefix."""
        return self.spark.createDataFrame([(t.name,) for t in self.spark.catalog.listTables(pattern=f"{prefix}*")], "name string")


def load_documents(docs: DataFrame, categories: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """S-2: documents of some categories (after normalisation), newest first."""
    if categories:
        docs = docs.where(C.category(F.col("category")).isin(categories))
    docs = docs.orderBy(F.desc("from_date"), F.desc("created_at"), "_id")
    return docs if limit is None else docs.limit(limit)


def changed_since(docs: DataFrame, since, id_column: str = "resource_id") -> tuple[DataFrame, DataFrame]:
    """S-4: ids changed after a cursor, and the new high-water mark as one row."""
    new = docs.where(F.col("merged_at") > F.lit(since))
    return new.select(id_column).distinct(), new.agg(F.max("merged_at").alias("high_water"))


def history_of(docs: DataFrame, ids: DataFrame, id_column: str = "resource_id") -> DataFrame:
    """S-5: all documents of the given ids; a semi-join, without paging."""
    return docs.join(ids, id_column, "left_semi")


def data_horizon(docs: DataFrame, column: str = "to_date") -> DataFrame:
    """S-14."""
    return docs.agg(F.max(column).alias("horizon"))


def granularity_minutes(docs: DataFrame, sample: int = 200) -> DataFrame:
    """S-15: upper median of spans of the first `sample` documents, times 1.5, 60 at least; 1440 without any."""
    spans = docs.orderBy("from_date", "_id").limit(sample).select((C.hours_between(F.col("from_date"), F.col("to_date")) * 60).alias("m")).where("m > 0 and m < 10080")
    middle = spans.agg(F.array_sort(F.collect_list("m")).alias("a"))
    return middle.select(F.when(F.size("a") == 0, F.lit(1440.0)).otherwise(F.greatest(F.lit(60.0), F.get("a", F.floor(F.size("a") / 2).cast("int")) * 1.5)).alias("minutes"))


def read_stream(spark: SparkSession, kind: str, schema: str, **options) -> DataFrame:
    """S-9 to S-11: one interface for change feeds. kind is any streaming source that is on the class path: files
    (json, parquet), kafka (its value is parsed with the schema), rate."""
    reader = spark.readStream.format(kind).options(**options)
    if kind == "kafka":
        value = F.from_json(F.col("value").cast("string"), schema)
        return reader.load().select(F.coalesce(F.col("key").cast("string"), F.sha2("value", 256)).alias("_key"), value.alias("v")).select("_key", "v.*")
    return reader.schema(schema).load() if kind != "rate" else reader.load()
