"""Change feeds (S-9 to S-11, R-1, R-5): a streaming source whose offsets are resume tokens, and a log of changes from which
the present state is read.

A change has token (a long that grows along the feed), op (insert, update, replace or delete) and the fields of its key and
its after-image; before_<field> columns hold before-images where the feed gives them. What a micro-batch brought is one
folder of the log, named by the batch, so that a batch that comes twice writes the same folder again and changes nothing. No
batch rewrites what others wrote; a key's newest change counts.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

TOKEN, OP, DELETE = "token", "op", "delete"


class Stretch(InputPartition):
    """Changes of one file with after < token <= upto."""

    def __init__(self, path: str, after: int, upto: int):
        self.path, self.after, self.upto = path, after, upto


class ChangeReader(DataSourceStreamReader):
    def __init__(self, schema, options):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        self.path, self.first = options["path"], int(options.get("resumeafter", -1))
        kind = to_arrow_schema(schema)
        self.kind = pa.schema([pa.field(f.name, f.type) for f in kind])

    def footers(self):
        """Each file of the feed with its least and greatest token, from its footer, or from its tokens where that has none."""
        import pyarrow.compute as pc
        import pyarrow.dataset as ds
        import pyarrow.parquet as pq

        data = ds.dataset(self.path, format="parquet")
        for name in data.files:
            with data.filesystem.open_input_file(name) as f:
                file = pq.ParquetFile(f)
                at = file.schema_arrow.get_field_index(TOKEN)
                seen = [file.metadata.row_group(k).column(at).statistics for k in range(file.metadata.num_row_groups)]
                if all(s is not None and (s.has_min_max or not s.num_values) for s in seen):
                    ends = [t for s in seen if s.has_min_max for t in (s.min, s.max)]
                else:
                    ends = [t for t in pc.min_max(file.read(columns=[TOKEN])[TOKEN]).as_py().values() if t is not None]
            if ends:
                yield name, min(ends), max(ends)

    def initialOffset(self) -> dict:
        return {TOKEN: self.first}

    def latestOffset(self) -> dict:
        return {TOKEN: max([self.first, *[top for _, _, top in self.footers()]])}

    def partitions(self, start: dict, end: dict):
        return [Stretch(name, start[TOKEN], end[TOKEN]) for name, low, top in self.footers() if low <= end[TOKEN] and top > start[TOKEN]]

    def read(self, part: Stretch):
        import pyarrow.compute as pc
        import pyarrow.dataset as ds

        data = ds.dataset([part.path], format="parquet", filesystem=ds.dataset(self.path, format="parquet").filesystem)
        inside = (pc.field(TOKEN) > part.after) & (pc.field(TOKEN) <= part.upto)
        for batch in data.scanner(columns=self.kind.names, filter=inside).to_batches():
            if batch.num_rows:
                yield batch.cast(self.kind)

    def commit(self, end: dict) -> None:
        """Nothing to let go of: the feed keeps its changes."""


class ChangeFeed(DataSource):
    """Parquet files of changes in the folder `path`; a new query starts after the token `resumeAfter`, a restarted one
    after the token that its checkpoint holds. A change without a token is not delivered."""

    @classmethod
    def name(cls) -> str:
        return "changes"

    def streamReader(self, schema) -> ChangeReader:
        return ChangeReader(schema, self.options)


def changes(spark: SparkSession, path: str, schema, resume_after: int = -1) -> DataFrame:
    """S-9 to S-11: the feed as a stream."""
    spark.dataSource.register(ChangeFeed)
    return spark.readStream.format("changes").schema(schema).option("resumeAfter", str(resume_after)).load(path)


def newest(log: DataFrame, keys: list[str]) -> DataFrame:
    """The change with the greatest token of each key, deletes too; repeated changes are one. Null keys are keys."""
    rest = [c for c in log.columns if c not in keys]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), TOKEN).alias("_c")).select(*keys, "_c.*").select(*log.columns)


def keep(path: str, keys: list[str]):
    """R-5: a sink for foreachBatch that writes a batch's newest changes to its folder of the log."""

    def write(batch: DataFrame, n: int) -> None:
        newest(batch, keys).write.mode("overwrite").parquet(f"{path}/batch={n}")

    return write


def follow(stream: DataFrame, path: str, keys: list[str], checkpoint: str):
    """R-1: all changes that are there now go into the log, then the query stops; a repeat goes on after the last token."""
    return stream.writeStream.foreachBatch(keep(path, keys)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def state(log: DataFrame, keys: list[str]) -> DataFrame:
    """What the changes leave: each key's newest change unless that is a delete, without op."""
    return newest(log, keys).where(~F.col(OP).eqNullSafe(F.lit(DELETE))).drop(OP)


def differences(changed: DataFrame, fields: list[str]) -> Column:
    """Names of the fields whose before-image differs from the after-image, in order; of a delete all that were filled."""
    return F.filter(F.array(*[F.when(~F.col(f"before_{f}").eqNullSafe(F.when(F.col(OP) != DELETE, F.col(f))), F.lit(f)) for f in fields]), lambda x: x.isNotNull())
