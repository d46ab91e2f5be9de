"""Line deduplication by range-partitioned line hashes.

Line hashes are range-partitioned and sorted by (hash, document, position), so that
even a line that fills a third of the corpus spreads over partitions. First
occurrences stream out of that order; per-line counts combine before any shuffle.
What goes back to a document is a compressed bitmap of kept lines (runs of kept
positions), never text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANK, cut, tasks, text_hash


def line_key(line: F.Column) -> F.Column:
    """The line without white space at both ends, A-Z lower-cased."""
    bare = F.regexp_replace(line, rf"^[{BLANK}]++|(?<![{BLANK}])[{BLANK}]++\z", "")
    return F.translate(bare, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _lines(text: F.Column) -> F.Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc_id, text_hash, n_dropped, keep_runs) of each text that loses lines.

    keep_runs is the keep bitmap in run-length form: array of (start, length) over
    0-based line positions; the last run has length null, for all lines that follow.
    A line whose key has at least min_chars code points and occurs in at least
    min_docs distinct documents is kept in the largest doc_id that holds it and goes
    everywhere else, each time it occurs. Rows with a null id neither count nor lose
    lines; null or empty texts are one empty line; rows of one doc_id count once, and
    each loses lines of its own text. No rows give no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    lines = rows.select("doc_id", text_hash(F.col("text")).alias("text_hash"), F.posexplode(_lines(F.col("text"))).alias("pos", "line")).where(F.length("line") >= min_chars)
    keyed = lines.select("doc_id", "text_hash", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    # the salt comes first: after the key it would make h2 a function of h1
    hashed = keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "text_hash", "pos")
    order = ["h1", "h2", "doc_id", "text_hash", "pos"]
    # written first: finding the ranges reads the rows twice; a line of one document is
    # in one range, so whether a row is its first shows from the row before
    here = Window.partitionBy("h1", "h2", "doc_id").orderBy("text_hash", "pos")
    ranged = cut(cut(hashed).repartitionByRange(tasks(spark), *order[:3]).sortWithinPartitions(*order).withColumn("first", F.lag("pos").over(here).isNull()))
    firsts = ranged.where("first")
    # what all documents say of a line
    known = firsts.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper")).where(F.col("n_docs") >= min_docs)
    repeated = cut(known.select("h1", "h2", "keeper"))
    drops = ranged.join(repeated, ["h1", "h2"]).where("doc_id < keeper").groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("pos")).alias("drops"))
    starts = F.concat(F.array(F.lit(0)), F.transform("drops", lambda d: d + 1))
    ends = F.concat("drops", F.array(F.lit(None).cast("int")))
    runs = F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("start"), (e - s).alias("length")))
    return drops.select("doc_id", "text_hash", F.size("drops").cast("long").alias("n_dropped"), F.filter(runs, lambda r: r["length"].isNull() | (r["length"] > 0)).alias("keep_runs"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with __n_lines, __n_dropped, __keep_runs (null: all lines stay) and
    __kept_text (null texts become empty). Other columns pass through."""
    side = cut(bitmaps.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("n_dropped").alias("__n_dropped"), F.col("keep_runs").alias("__keep_runs")))
    joined = docs.join(side, (docs[id_col].cast("long") == F.col("__id")) & (text_hash(docs[text_col].cast("string")) == F.col("__hash")), "left").drop("__id", "__hash")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = _lines(text)
    kept = F.array_join(F.flatten(F.transform("__keep_runs", lambda r: F.slice(lines, r["start"] + 1, F.coalesce(r["length"], F.size(lines))))), "\n")
    return (
        joined.withColumn("__n_lines", (F.length(text) - F.length(F.translate(text, "\n", "")) + 1).cast("long"))
        .withColumn("__n_dropped", F.coalesce("__n_dropped", F.lit(0)).cast("long"))
        .withColumn("__kept_text", F.when(F.col("__keep_runs").isNotNull(), kept).otherwise(text))
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Bitmaps applied: see keep_bitmaps and apply_bitmaps."""
    return apply_bitmaps(docs, keep_bitmaps(docs, id_col, text_col, min_chars, min_docs), id_col, text_col)
