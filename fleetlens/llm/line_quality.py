"""Quality rules from cross-document line frequency, with DataFrame functions only.

Base rules count words, symbols, repeated lines and repeated word windows of each text. The method then hashes every
normalised line, counts for each host (the column source) the distinct documents holding it, takes lines above limits
for boilerplate, and rejects documents of which too little is left without those lines. Limits are a number of documents
and a share of the host's, so that a large host's common headings are no boilerplate.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = "[ \\t-\\r]+"
#: A line is boilerplate if more documents of one host than this hold it, and more than this share of the host's documents.
LINE_LIMIT, LINE_SHARE = 5, 0.05
#: A document is depleted if boilerplate lines hold more than this share of its letters.
DEPLETED = 0.7
#: Boilerplate lines are joined to rows in so many slices, so that one very common line is spread over tasks.
SLICES = 16


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def let(value: Column, body) -> Column:
    """body(value), with value computed once per row rather than at each mention inside nested lambdas."""
    return F.get(F.transform(F.array(value), body), 0)


def _repeated(windows: Column) -> Column:
    """Words covered by windows of 8 whose hash occurs twice or more; windows: array of hashes by start."""

    def twice(s: Column) -> Column:
        flagged = F.transform(s, lambda x, k: F.struct(x.i.alias("i"), ((F.get(s, k - 1).h == x.h) | (F.get(s, k + 1).h == x.h)).alias("twice")))
        return F.sort_array(F.transform(F.filter(flagged, lambda x: x.twice), lambda x: x.i))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(8), F.get(p, k + 1) - x)), F.lit(0), lambda a, x: a + x)

    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(let(pairs, twice), covered)


def base_features(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed added."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    some = docs.select("*", words_of(text).alias("_w"), lines.alias("_l"))
    windows = let(F.transform("_w", lambda w: F.xxhash64(w)), lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - 7), lambda i: F.xxhash64(F.slice(h, i, 8))))
    some = some.withColumn("_v", F.when(F.size("_w") >= 9, windows).otherwise(F.array().cast("array<bigint>")))
    out = some.select(
        *docs.columns,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, "[^#*$%&|<>]++", "")).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        let(F.col("_v"), lambda v: F.when(F.size(F.array_distinct(v)) == F.size(v), F.lit(0)).otherwise(_repeated(v))).cast("long").alias("n_repeat_words"),
    )
    return out.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def lines_of(docs: DataFrame, host: str = "source") -> DataFrame:
    """(doc_id, content, host, line, chars) for each line with a word: content is a hash of the text, line of the line
    in lower case with white space squeezed, chars its length."""
    one = F.trim(F.regexp_replace(F.lower(F.col("_x")), SPACES, " "))
    rows = docs.select("doc_id", F.xxhash64("text").alias("content"), F.coalesce(F.col(host), F.lit("")).alias("host"), F.explode(F.split(F.coalesce(F.col("text"), F.lit("")), "\n")).alias("_x"))
    return rows.select("doc_id", "content", "host", one.alias("_n")).where("_n <> ''").select("doc_id", "content", "host", F.xxhash64("_n").alias("line"), F.length("_n").cast("long").alias("chars"))


def boilerplate(docs: DataFrame, lines: DataFrame, limit: int, share: float) -> DataFrame:
    """(host, line, documents) above the limits; a document with a null id counts for none. Documents are counted in two
    steps, so a common line is not one task's work. Hosts' sizes are joined to what is above the first limit only."""
    once = lines.where("doc_id is not null").select("host", "line", "doc_id").distinct()
    often = once.groupBy("host", "line").agg(F.count("*").alias("documents")).where(F.col("documents") > limit)
    hosts = docs.where("doc_id is not null").select(F.coalesce("host", F.lit("")).alias("host"), "doc_id").distinct().groupBy("host").agg(F.count("*").alias("all"))
    return often.join(hosts, "host").where(F.col("documents") > share * F.col("all")).drop("all")


def slice_of(slices: int) -> Column:
    """Of a row by its id and text: copies of one text lie in different slices."""
    return F.pmod(F.xxhash64("doc_id", "content"), F.lit(slices)).cast("int")


def in_slices(common: DataFrame, slices: int) -> DataFrame:
    """common (host, line) once for each slice."""
    return common.select("host", "line", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))


def line_quality(docs: DataFrame, host: str = "source", limit: int = LINE_LIMIT, share: float = LINE_SHARE, depleted: float = DEPLETED, slices: int = SLICES) -> DataFrame:
    """docs' doc_id and the base counts, line_chars, removed_chars, removed_share and kept.

    Nulls: a text counts as empty (base_failed, not kept), a host as one nameless host, a row with a null doc_id keeps a row
    but counts for no document. Texts are read whole, at any length; an empty table gives no rows. A line exactly at a
    limit is no boilerplate, a document exactly at the depleted share is kept. Repeated rows: the share is that of one of
    them, and each gets it. Rows of one doc_id with different texts are told apart by their content. Columns of other
    names, clashing ones included, are ignored.
    """
    docs = docs.select("doc_id", "text", F.col(host).alias("host"))
    lines = lines_of(docs, "host")
    common = in_slices(boilerplate(docs, lines, limit, share), slices)
    marked = lines.withColumn("slice", slice_of(slices)).join(common.withColumn("hit", F.lit(True)), ["host", "line", "slice"], "left")
    parts = marked.groupBy("doc_id", "content").agg(F.sum("chars").alias("line_chars"), F.sum(F.when(F.col("hit"), F.col("chars")).otherwise(0)).alias("removed_chars"))
    parts = parts.select(F.col("doc_id").alias("_d"), F.col("content").alias("_c"), "line_chars", "removed_chars", (F.col("removed_chars") / F.col("line_chars")).alias("removed_share"))
    base = base_features(docs).withColumn("_content", F.xxhash64("text")).drop("text", "host")
    out = base.join(parts, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_content") == F.col("_c")), "left").drop("_content", "_d", "_c")
    return out.fillna(0, ["line_chars", "removed_chars"]).fillna(0.0, ["removed_share"]).withColumn("kept", ~F.col("base_failed") & (F.col("removed_share") <= depleted))


def strip_lines(docs: DataFrame, host: str = "source", limit: int = LINE_LIMIT, share: float = LINE_SHARE, slices: int = SLICES) -> DataFrame:
    """docs with the boilerplate lines taken out of text; each document's own boilerplate hashes come back as one array.
    Nulls, ties, repeats, long texts and empty tables as in line_quality; all columns pass through."""
    lines = lines_of(docs, host)
    common = in_slices(boilerplate(docs.select("doc_id", F.col(host).alias("host")), lines, limit, share), slices)
    hits = lines.withColumn("slice", slice_of(slices)).join(common, ["host", "line", "slice"], "left_semi").groupBy(F.col("doc_id").alias("__d"), F.col("content").alias("__c")).agg(F.collect_set("line").alias("__gone"))
    hashed = lambda x: F.xxhash64(F.trim(F.regexp_replace(F.lower(x), SPACES, " ")))
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x: ~F.array_contains(F.col("__gone"), hashed(x))), "\n")
    joined = docs.withColumn("__content", F.xxhash64("text")).join(hits, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("__content") == F.col("__c")), "left")
    return joined.withColumn("text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept)).select(*docs.columns)


def op2_line_quality(spark, sf_dir: str) -> DataFrame:
    out = line_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "line_chars", "removed_chars")


OP2_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, text, coalesce(source, '') AS host FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[ \\t-\\r]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS ls FROM d),
win AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
rep AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS n_repeat_words
        FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt
              FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1) GROUP BY doc_id),
base AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
                length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
                (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
         FROM w LEFT JOIN rep USING (doc_id)),
ln AS (SELECT doc_id, host, text, trim(regexp_replace(lower(x), '[ \\t-\\r]+', ' ', 'g'), ' ') AS n FROM (SELECT doc_id, host, text, unnest(string_split(t, chr(10))) AS x FROM d)),
hs AS (SELECT host, count(DISTINCT doc_id) AS n_docs FROM d GROUP BY host),
bp AS (SELECT ln.host, n FROM ln JOIN hs ON ln.host = hs.host WHERE n <> '' GROUP BY ln.host, n, n_docs HAVING count(DISTINCT doc_id) > 5 AND count(DISTINCT doc_id) > 0.05 * n_docs),
sh AS (SELECT doc_id, sum(length(ln.n))::BIGINT AS line_chars, sum(CASE WHEN bp.n IS NULL THEN 0 ELSE length(ln.n) END)::BIGINT AS removed_chars
       FROM ln LEFT JOIN bp ON ln.host = bp.host AND ln.n = bp.n WHERE ln.n <> '' GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND coalesce(removed_chars / line_chars, 0) <= 0.7 AS kept,
       coalesce(line_chars, 0) AS line_chars, coalesce(removed_chars, 0) AS removed_chars
FROM base LEFT JOIN sh USING (doc_id)
"""
