"""Sharding by balanced label propagation, with DataFrame functions only.

Documents with equal texts are linked. Every linked document starts in a shard given by a hash; in each round joins tell
a document where most of its group stands, and it moves there as far as the shard's quota allows, larger groups first.
Unlinked documents then fill what is free, so that row counts differ by one at most (law: rows). Only per-shard totals
(as many numbers as there are shards) reach the driver.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import cut, drop_cut

SHARDS = 24
ROUNDS = 5
#: Groups' labels are joined to documents in so many slices, so that one large group is spread over tasks.
SLICES = 24
#: A numbering is made in so many parts, whose sizes are then summed.
PARTS = 512


def numbered(rows: DataFrame, within: list[str], name: str, parts: int = PARTS) -> DataFrame:
    """rows with a gapless number from 0 in each value of `within`, in no particular order. Needs a unique column row.

    The window is over parts of the rows; only the parts' sizes are summed in order.
    """
    cut_up = rows.withColumn("_p", F.pmod(F.xxhash64("row"), F.lit(parts)))
    sizes = cut_up.groupBy(*within, "_p").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*within).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_s", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")  # at most parts rows each
    inner = cut_up.withColumn("_r", F.row_number().over(Window.partitionBy(*within, "_p").orderBy("row")))
    return inner.join(F.broadcast(starts), [*within, "_p"]).withColumn(name, (F.col("_s") + F.col("_r") - 1).cast("long")).drop("_p", "_s", "_r")


def pick(values: list[int], at: str) -> Column:
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col(at) + 1)


def totals(rows: DataFrame, shards: int, value: Column) -> list[int]:
    got = {r[0]: r[1] for r in rows.groupBy("shard").agg(F.sum(value)).collect()}
    return [int(got.get(s) or 0) for s in range(shards)]


def propagate(linked: DataFrame, quota: list[int], turn: int, slices: int = SLICES) -> DataFrame:
    """One round over linked (row, gid, shard, slice). A group's homes are the shards where most of it stands, as many as
    have room for it, open ones first; its other members move to a home as far as quotas allow."""
    shards = len(quota)
    counts = linked.groupBy("gid", "shard").agg(F.count("*").alias("n"))
    load = totals(counts, shards, F.col("n"))
    free = [max(0, q - x) for q, x in zip(quota, load, strict=True)]
    own = Window.partitionBy("gid")  # at most as many rows as there are shards
    good = (pick(free, "shard") > 0) | (2 * F.col("n") >= pick(quota, "shard"))
    ranked = counts.withColumn("place", F.row_number().over(own.orderBy(F.desc(good), F.desc("n"), F.xxhash64("gid", "shard"))))
    room = F.col("n") + pick(free, "shard")
    ahead = F.sum(room).over(own.orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    ranked = ranked.withColumn("is_home", F.coalesce(ahead, F.lit(0)) < F.sum("n").over(own)).withColumn("best", F.max("n").over(own))
    ranked = ranked.withColumn("homes", F.sum(F.col("is_home").cast("int")).over(own).cast("int"))
    home = ranked.where("place <= homes").select("gid", F.col("place").alias("goal"), F.col("shard").alias("to"))
    away = ranked.where("place > homes").select("gid", "shard", "n", "homes", "best", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
    moves = away.withColumn("goal", F.pmod("slice", "homes") + 1).join(home, ["gid", "goal"])
    moves = moves.select("gid", "shard", "slice", "to", (F.col("n") / slices).alias("n"), F.struct(-F.floor(F.log2("best")), F.pmod(F.xxhash64("gid"), F.lit(64))).alias("turn"))
    wanted = moves.groupBy("to", "turn").agg(F.sum("n").alias("want"))  # bounded: shards x magnitudes x 64
    before = F.sum("want").over(Window.partitionBy("to").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1))
    share = wanted.withColumn("share", (pick(free, "to") - F.coalesce(before, F.lit(0))) / F.col("want")).drop("want").where("share > 0")
    allowed = moves.join(F.broadcast(share), ["to", "turn"]).select("gid", "shard", "slice", "to", "share")
    drawn = F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(1 << 20)) / F.lit(1 << 20)
    return linked.join(allowed, ["gid", "shard", "slice"], "left").select("row", "gid", F.when(drawn < F.col("share"), F.col("to")).otherwise(F.col("shard")).alias("shard"), "slice")


def shard(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, gid (null for a text that occurs once), shard and slot.

    size is the text's UTF-8 bytes plus 8; a null text has none and equals an empty one. Repeated rows are placed one
    by one, as a group; a group larger than a shard is spread over as few shards as the quotas allow; null ids are
    placed like any; an empty table gives no rows; other columns are not read.
    """
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.xxhash64(raw).alias("content"))
    rows = cut(rows.select("doc_id", "size", "text_crc32", F.xxhash64("content", "text_crc32", "size").alias("gid"), F.monotonically_increasing_id().alias("row")))
    total = rows.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    each = F.pmod(F.xxhash64("row"), F.lit(SLICES)).cast("int")
    groups = rows.groupBy("gid").agg(F.count("*").alias("n")).where("n > 1").select("gid", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))).alias("slice"))
    linked = cut(rows.select("row", "gid", each.alias("slice")).join(groups, ["gid", "slice"]).select("row", "gid", F.pmod(F.xxhash64("row", F.lit(7)), F.lit(shards)).cast("int").alias("shard"), "slice"))
    for turn in range(rounds):
        moved = cut(propagate(linked, quota, turn))
        drop_cut(docs.sparkSession, linked)
        linked = moved
    held = cut(numbered(linked.select("row", "shard"), ["shard"], "slot"))
    stay = held.where(F.col("slot") < pick(quota, "shard"))
    kept = totals(stay, shards, F.lit(1))
    pool = numbered(rows.join(stay, "row", "left_anti").select("row"), [], "place") if total else None
    if pool is None:
        placed = stay
    else:
        upto, ends = 0, []
        for q, k in zip(quota, kept, strict=True):
            upto += q - k
            ends.append(upto)
        chosen = F.coalesce(*[F.when(F.col("place") < e, F.lit(s)) for s, e in enumerate(ends)]).cast("int")
        starts = [e - (q - k) for e, q, k in zip(ends, quota, kept, strict=True)]
        placed = stay.select("row", "shard", "slot").union(pool.withColumn("shard", chosen).select("row", "shard", (pick(kept, "shard") + F.col("place") - pick(starts, "shard")).cast("long").alias("slot")))
    back = linked.select("row", F.lit(True).alias("linked"))
    return rows.join(placed, "row").join(back, "row", "left").select("doc_id", "size", "text_crc32", F.when(F.col("linked"), F.col("gid")).alias("gid"), "shard", "slot")


def op10_sharding(spark, sf_dir: str) -> DataFrame:
    out = shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
