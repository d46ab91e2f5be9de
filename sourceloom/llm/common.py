"""What the training-data operators share: the shared folder, lineage cuts,
word splitting over Arrow batches and connected components."""

from __future__ import annotations

import gc
import re
import tempfile
import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Inside of a character class: the white space that separates words.
BLANK = r"\x20\x09-\x0D"
#: Bytes of text that one vectorised step works on. A step takes some 60 bytes for each,
#: and workers are kept, so this is in an executor's memory as often as it has workers.
SLICE_BYTES = 1 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_shared_dir(spark: SparkSession) -> None:
    """Use the folder that the cluster names in spark.checkpoint.dir; where the
    setting is absent take an own one, on one machine only: on a cluster executors would
    not see it."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if context.getCheckpointDir() is None:
        if not named and not re.match(r"local(\[|$)", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="sourceloom-"))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared folder, so that later steps neither repeat the
    work nor depend on a live executor.

    A checkpoint hands on its plan's estimated size and constraints. The size of a join
    is estimated as a product, so over rounds of joins the number itself grows to
    millions of digits and planning takes longer than any work; a frame over the
    checkpointed rows alone carries neither.
    """
    spark = df.sparkSession
    ensure_shared_dir(spark)
    kept = df.checkpoint(eager=True)._jdf
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(kept.queryExecution().toRdd(), kept.schema(), False), spark)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffles, and where the cluster says so the checkpoints, that
    no frame needs any more: it does when the driver's JVM collects garbage, and by itself
    that may be long after, with all of them still on the disks. Threads of Spark hold the
    last job for up to a second, so it takes two goes."""
    for wait in (1, 0):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(wait)


def tasks(spark: SparkSession) -> int:
    """Partitions for an explicit repartition: the session's shuffle setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_hash(text: F.Column) -> F.Column:
    """Tells texts of one id apart; null is the empty text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


#: Bits of the filter that tells which rows may go (a bound on its size).
GONE_BITS = 1 << 23


def without(rows: DataFrame, gone: DataFrame, keys: list[F.Column]) -> DataFrame:
    """The rows whose keys are none of the rows of gone (longs, as many as keys; null keys
    stay). A filter of GONE_BITS bits is sent to all tasks and only rows that it stops are
    shuffled, to meet gone itself: the others are large and stay where they are."""
    names = [f"__key{i}" for i in range(len(keys))]
    gone = cut(gone.toDF(*names).distinct())
    place, bit = F.pmod(F.xxhash64(*names), F.lit(GONE_BITS)).alias("__place"), F.expr("shiftleft(1L, cast(__place % 64 as int))")
    words_ = gone.select(place).groupBy(F.expr("__place div 64").alias("__at")).agg(F.bit_or(bit).alias("__word"))
    keyed = rows.select("*", *[k.alias(x) for k, x in zip(keys, names)]).select("*", place)
    marked = keyed.join(F.broadcast(words_), F.expr("__place div 64") == F.col("__at"), "left")
    stopped = F.coalesce(F.col("__word"), F.lit(0)).bitwiseAND(bit) != 0
    passed, met = marked.where(~stopped), marked.where(stopped).join(gone, names, "left_anti")
    return passed.select(*rows.columns).unionByName(met.select(*rows.columns))


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a slice holds about most bytes of the text column (a longer
    text is a slice of its own)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, start, held = np.cumsum(sizes), 0, 0
    for i, end in enumerate(ends):
        if end - held > most and i > start:
            yield batch.slice(start, i - start)
            start, held = i, ends[i - 1]
    if start < batch.num_rows:
        yield batch.slice(start)


def flat_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A-Z lower-cased words: (offsets of each text's words, all words in order). Null is
    the empty text."""
    # a copy: string kernels go wrong on arrays that start inside of their buffers
    whole = texts.take(pa.array(np.arange(len(texts)))).cast(pa.large_string())
    lowered = pc.ascii_lower(pc.fill_null(whole, ""))
    parts = pc.ascii_split_whitespace(lowered)
    flat, bounds = parts.values, parts.offsets.to_numpy()
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    before = np.concatenate(([0], np.cumsum(full)))
    return before[bounds], flat.filter(pa.array(full))


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """flat_words with (offsets, code of each word, distinct words)."""
    bounds, flat = flat_words(texts)
    coded = flat.dictionary_encode()
    return bounds, coded.indices.to_numpy(), coded.dictionary


_BASE = 0xD1342543DE82EF95  # odd, so that its powers have inverses
_BYTES = np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=np.uint64)


_held: list[np.ndarray] = [np.empty(0, np.uint64), np.empty(0, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """_BASE and its inverse to the powers 0..n-1, kept for slices of the usual size."""
    if n <= len(_held[0]):
        return [x[:n] for x in _held]
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers = np.full(max(n, SLICE_BYTES + (1 << 16)), base, np.uint64)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers))
    if n <= SLICE_BYTES + (1 << 16):
        _held[:] = out
    return [x[:n] for x in out]


def flat_hashes(strings: pa.Array) -> np.ndarray:
    """64-bit hash of each string of a large_string array, from running sums over all
    their bytes: no string is touched by itself."""
    ends = np.frombuffer(strings.buffers()[1], np.int64, len(strings) + 1, 8 * strings.offset)
    low, n = int(ends[0]) if len(strings) else 0, int(ends[-1] - ends[0]) if len(strings) else 0
    at = ends - low
    powers, inverses = _powers(n + 1)
    data = np.frombuffer(strings.buffers()[2], np.uint8, n, low) if n else np.empty(0, np.uint8)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[data] * powers[:n], out=sums[1:])
    # the sum over a string, as if it were the first
    own = (sums[at[1:]] - sums[at[:-1]]) * inverses[at[:-1]]
    return mix(own ^ (np.diff(at).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def string_hash(values: pa.Array) -> np.ndarray:
    """64-bit hash of each string, the same on every machine."""
    return pd.util.hash_array(values.to_pandas().to_numpy(dtype=object), categorize=False)


def runs_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that hold whole runs of equal keys, from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(k)[-1] for k in keys]
        same = np.ones(batch.num_rows, bool)
        for k, x in zip(keys, last):
            same &= batch.column(k).to_numpy(zero_copy_only=False) == x.as_py()
        start = batch.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
        if start or (held and [held[-1].column(k)[-1] for k in keys] != last):
            yield pa.Table.from_batches([*held, batch.slice(0, start)])
            held = []
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values. numpy's unique puts each value of whole numbers in a node of
    a hash table first, which takes several times the memory and the time."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64 bits (uint64, in place)."""
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def most_frequent(rows: DataFrame, most: int, count: str = "count", weight: F.Column | None = None, most_weight: int = 0) -> DataFrame:
    """The rows of the highest counts: all above a threshold that leaves at most most
    rows, of at most most_weight in all if a weight is given. The threshold comes from
    a histogram of under 70,000 bars, so no more than the bound ever reaches the
    driver, however many tasks there are. rows should be materialised."""
    bar = F.when(F.col(count) < 65536, F.col(count)).otherwise(F.lit(65536) + F.floor(F.log2(F.col(count) / 65536) * 16)).cast("long")
    bars = rows.groupBy(bar.alias("bar")).agg(F.count("*").alias("n"), F.sum(weight if weight is not None else F.lit(0)).alias("w")).toPandas().sort_values("bar", ascending=False)
    fit = (bars["n"].cumsum() <= most) & (bars["w"].cumsum() <= most_weight)
    return rows.where(bar >= int(bars["bar"][fit].min())) if fit.any() else rows.limit(0)


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer pairs with the same components: each id with the smallest of its
    component."""
    ids, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    x, y = at[: len(left)], at[len(left) :]
    label = np.arange(len(ids))
    while True:
        new = label.copy()
        np.minimum.at(new, x, label[y])
        np.minimum.at(new, y, label[x])
        new = new[new]
        if (new == label).all():
            break
        label = new
    out = np.flatnonzero(label != np.arange(len(ids)))
    return ids[label[out]], ids[out]


#: Most edges (16 bytes each) of a graph that one task labels by itself.
ONE_TASK = 1 << 20


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node of the pairs with the smallest node of its component."""
    ends = [(np.empty(0, np.int64), np.empty(0, np.int64))] + [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches]
    u, v = (np.concatenate(x) for x in zip(*ends))
    nodes = np.unique(np.concatenate([u, v]))
    label, node = forest(u, v) if len(u) else (u, v)
    component = nodes.copy()
    component[np.searchsorted(nodes, node)] = label
    yield pa.record_batch({"node": pa.array(nodes), "component": pa.array(component)})


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Components of an undirected graph.

    edges: pairs of long ids in columns a and b. Returns (node, component), a row
    for each node that occurs, component being the smallest node of its component.
    Loops, repeated edges and edges with a null end have no effect beyond naming
    their nodes; no edges give no rows.

    Of at most ONE_TASK edges one task makes the labels. Of more, labels move along
    edges and then to the label's own label, so paths halve in each round; every
    aggregation combines before its shuffle, every join reads materialised sides that
    skew handling can split, and nothing but a count reaches the driver.
    """
    pairs = cut(edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u is not null and v is not null"))
    if pairs.count() <= ONE_TASK:
        return cut(pairs.coalesce(1).mapInArrow(_labelled, "node long, component long"))
    both = cut(pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = cut(both.groupBy(F.col("u").alias("node")).agg(F.min(F.least("u", "v")).alias("component")))
    while True:
        told = (
            both.join(labels.select(F.col("node").alias("u"), "component"), "u")
            .select(F.col("v").alias("node"), "component")
            .union(labels.select("node", "component"))
            # the label itself hears of the smaller label of its members
            .union(both.join(labels.select(F.col("node").alias("u"), F.col("component").alias("new")), "u").join(labels.select(F.col("node").alias("v"), F.col("component").alias("old")), "v").where("new < old").select(F.col("old").alias("node"), F.col("new").alias("component")))
            .groupBy("node")
            .agg(F.min("component").alias("component"))
        )
        moved = cut(told)
        jumped = cut(
            moved.join(moved.select(F.col("node").alias("component"), F.col("component").alias("further")), "component")
            .select("node", F.least("component", "further").alias("component"))
        )
        changed = jumped.join(labels.withColumnRenamed("component", "was"), "node").where("component <> was").limit(1).count()
        labels = jumped
        if not changed:
            return labels
