"""Conflict-constrained best-fit packing of documents into sequences.

Documents are measured in words. A document longer than a sequence fills whole
sequences of its own and its rest is packed. Shards of bounded size are packed side
by side: within one, bins are ordered by residual; each item goes to the tightest
bin whose source and duplicate-cluster bitmaps don't meet its own, found by
successor search from its length upwards.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANK, cut, runs_of, tasks, text_hash
from .jaccard import near_duplicates

#: Items of a shard, about, and numbers that deal repeated rows to different shards.
SHARD, SPREAD = 4096, 1024


def best_fit(items: list[tuple[int, int, int]], capacity: int) -> list[int]:
    """Bin of each item (length, source, cluster), longest first, ties in the given
    order. No bin holds two items of one source or of one cluster; -1 as source or
    cluster conflicts with nothing.

    Bins of one residual stand in one list; the sorted residuals are searched from
    the item's length upwards until a bin is compatible. Per residual the bitmap of
    what all its bins carry in common lets the search pass over it at once.
    """
    bit: dict[tuple[int, int], int] = {}
    by_residual: dict[int, list[int]] = {}
    common: dict[int, int] = {}
    residuals: list[int] = []
    carries: list[int] = []
    placed = [0] * len(items)
    for k in sorted(range(len(items)), key=lambda i: -items[i][0]):
        length, source, cluster = items[k]
        mask = 0
        for kind, x in enumerate((source, cluster)):
            if x >= 0:
                mask |= 1 << bit.setdefault((kind, x), len(bit))
        at, found = bisect_left(residuals, length), -1
        while at < len(residuals) and found < 0:
            r = residuals[at]
            if not common[r] & mask:
                found = next((j for j, b in enumerate(by_residual[r]) if not carries[b] & mask), -1)
            at += found < 0
        if found >= 0:
            r = residuals[at]
            own = by_residual[r]
            b = own.pop(found)
            if not own:
                del by_residual[r], common[r], residuals[at]
            carries[b] |= mask
        else:
            r, b = capacity, len(carries)
            carries.append(mask)
        placed[k] = b
        r -= length
        if r:
            if r in by_residual:
                by_residual[r].append(b)
                common[r] &= carries[b]
            else:
                by_residual[r] = [b]
                common[r] = carries[b]
                insort(residuals, r)
    return placed


def _packed(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs_of(batches, ["shard"]):
            shards, rows = table.column("shard").to_pylist(), table.to_pydict()
            start = 0
            while start < len(shards):
                end = start
                while end < len(shards) and shards[end] == shards[start]:
                    end += 1
                many: dict[int, int] = {}
                for x in rows["cluster"][start:end]:
                    many[x] = many.get(x, 0) + 1
                items = [(n, s, c if c is not None and many[c] > 1 else -1) for n, s, c in zip(rows["rest"][start:end], rows["source_code"][start:end], rows["cluster"][start:end])]
                names: dict = {}
                items = [(n, names.setdefault(("s", s), len(names)) if s is not None else -1, names.setdefault(("c", c), len(names)) if c != -1 else -1) for n, s, c in items]
                bins = best_fit(items, capacity)
                yield pa.record_batch({"doc_id": pa.array(rows["doc_id"][start:end], pa.int64()), "n_words": pa.array(rows["n_words"][start:end], pa.int64()), "length": pa.array([x[0] for x in items], pa.int64()), "shard": pa.array([shards[start]] * (end - start), pa.int32()), "bin": pa.array(bins, pa.int32())})
                start = end

    return run


def near_clusters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text_hash, group) of each text with words: its group of near copies, over all
    rows; see jaccard.near_duplicates."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # rows without an id have copies too
    named = docs.select(F.coalesce(F.col(id_col).cast("long"), F.xxhash64(F.lit(1), text)).alias("doc_id"), text.alias("text"))
    return near_duplicates(named, hashed=True).where("n_shingles > 0").groupBy("text_hash").agg(F.min("component_id").alias("group"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str | None = "source", cluster_col: str | None = None, capacity: int = 2048, clusters: DataFrame | None = None) -> DataFrame:
    """A row for each piece of a document: doc_id, piece (0 on), start and length in
    words, bin_id; every word of every text is in exactly one piece.

    Whole sequences of a long document have bin_id 'd<doc_id>.<piece>.<row hash>',
    the rest a bin 's<shard>.<bin>' which it shares with rests of other sources and
    other duplicate clusters only. cluster_col names the duplicate cluster, or clusters
    (see near_clusters) that of a text; without them, and for texts that clusters
    lacks, equal texts (white space and case aside) are a cluster. Null source or
    cluster conflicts with nothing; null and blank texts have length 0 and one piece
    of their own bin 'e'. Repeated rows are packed as often as they come, dealt to
    shards by their place in the input. Texts are read whole. Other columns are not
    looked at. No rows give no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    bare = F.ltrim(text, F.lit(" \t\n\x0b\x0c\r"))
    # a character for each word, so one pass counts them
    n_words = F.length(F.regexp_replace(bare, rf"[^{BLANK}]++[{BLANK}]*+", "x")).cast("long")
    plain = F.trim(F.lower(F.regexp_replace(text, rf"[{BLANK}]++", " ")))
    named = F.xxhash64(F.col(cluster_col)) if cluster_col else text_hash(text) if clusters is not None else F.xxhash64(plain)
    measured = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.col(source_col).cast("string") if source_col else F.lit(None).cast("string")).alias("source_code"),
        F.when(F.col(cluster_col).isNotNull() if cluster_col else F.lit(True), named).alias("cluster"),
        text_hash(text).alias("text_hash"), n_words.alias("n_words"),
    ).select("doc_id", "source_code", "cluster", "text_hash", "n_words", (F.col("n_words") % capacity).alias("rest"), F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).alias("salt"))
    # the hash names rows, the group is what must not meet
    measured = cut(measured.withColumn("own", F.col("cluster")))
    if clusters is not None:
        keyed = measured.withColumn("text_hash", F.when(F.col("n_words") > 0, F.col("text_hash")))
        measured = keyed.join(cut(clusters), "text_hash", "left").withColumn("cluster", F.coalesce(F.xxhash64("group"), "cluster"))
    measured = cut(measured.withColumn("n_full", F.expr(f"n_words div {capacity}")))
    full = (
        measured.where("n_full > 0")
        .select("doc_id", "own", F.explode(F.expr("sequence(0, cast(n_full - 1 as int))")).alias("piece"))
        .select("doc_id", "piece", (F.col("piece").cast("long") * capacity).alias("start"), F.lit(capacity).cast("long").alias("length"), F.concat(F.lit("d"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit("."), "piece", F.lit("."), F.lower(F.hex("own"))).alias("bin_id"))
    )
    empty = measured.where("n_words = 0").select("doc_id", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("length"), F.lit("e").alias("bin_id"))
    rests = measured.where("rest > 0")
    shards = max(1, rests.count() // SHARD)
    dealt = (
        rests.withColumn("shard", F.expr(f"cast(pmod(xxhash64(doc_id, own, n_words, salt), {shards}) as int)"))
        .select("shard", "doc_id", "n_words", "rest", "source_code", "cluster")
        .repartition(tasks(spark), "shard").sortWithinPartitions("shard", F.desc("rest"), "doc_id", "cluster", "source_code", "n_words")
    )
    packed = dealt.mapInArrow(_packed(capacity), "doc_id long, n_words long, length long, shard int, bin int").select(
        "doc_id", F.expr(f"cast(n_words div {capacity} as int)").alias("piece"), (F.col("n_words") - F.col("length")).alias("start"), "length", F.concat(F.lit("s"), "shard", F.lit("."), "bin").alias("bin_id")
    )
    return full.unionByName(empty).unionByName(packed)
