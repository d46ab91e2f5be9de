"""Embedding near-duplicates by sorted projection passes.

Each pass hashes a vector by random projections and concatenates the bits to one key;
vectors are ordered by it and each is compared with a bounded window of neighbours, over
the borders of partitions too. Verified pairs of all passes are united.

A bit tells on which side of a threshold a projection lies. The thresholds of the first
bits are medians among the rows that share the bits before, those of the others their
means, fitted on a bounded sample; so crowded cones and vectors with a common mean are
split as finely as others. Two vectors meet where log2(rows / window) bits agree; how
often that is, at exactly the least cosine, is measured with probes around sampled
vectors, and passes go on until a share of MISS of the probes, or less, would fail in
all of them. So passes grow with the rows, slowly, and with how crowded they are.

What a component holds is then counted exactly, not from the windows: vectors are sorted
by their angle to the component's mean into shells; the triangle inequality decides most
pairs of shells whole, and only the others are multiplied out, tile by tile.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import connected_components, cut, runs_of, tasks

WINDOW = 256
#: Share of pairs of exactly the least cosine that all passes may miss; most passes.
MISS, MOST_PASSES = 0.005, 256
#: Bits of a key, and how many of them have medians for thresholds.
BITS, DEPTH = 40, 8
#: Most rows and bytes of the sample that thresholds are fitted on; passes that probes
#: go through, probes, and regions of space (two to this power) that are looked at apart.
SAMPLE_ROWS, SAMPLE_BYTES = 1 << 14, 32 << 20
TRIALS, PROBES, REGION_BITS = 12, 4096, 4
#: Rows of a range of keys, most ranges of a pass, and rows of a tile of the exact count.
RANGE, MOST_RANGES, TILE = 16384, 1024, 1024
#: Shells of an angle of the threshold's size.
SHELLS = 16
#: More than any rounding of an angle.
SLACK = 1e-6


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _units(blobs: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    """Unit vectors, in double precision, of binary vectors of one length."""
    joined = b"".join(blobs.to_pylist())
    return _unit(np.frombuffer(joined, kind).reshape(len(blobs), -1))


def _written(kind: str):
    """vec_id and the vector's bytes, null where it links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            given = lists.is_valid().to_numpy(zero_copy_only=False) & batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
            bounds = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).astype(kind)
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
            some = np.concatenate(([0], np.cumsum(flat != 0)))
            start, end = bounds[:-1], bounds[1:]
            sound = given & (bad[end] == bad[start]) & (some[end] > some[start])
            yield pa.record_batch({"vec_id": batch.column("vec_id"), "vector": pa.array([flat[s:e].tobytes() if ok else None for s, e, ok in zip(start, end, sound)], pa.binary())})

    return run


class Passes:
    """Projections and thresholds of all passes for vectors of one length, fitted on a
    sample for a number of rows."""

    def __init__(self, sample: np.ndarray, dim: int, rows: int, least: float, window: int, passes: int | None, seed: int):
        self.random, self.dim = np.random.default_rng([seed, dim]), dim
        self.ranges = max(1, min(MOST_RANGES, rows // RANGE)) if len(sample) else 1
        self.planes: list[np.ndarray] = []
        self.medians: list[np.ndarray] = []
        self.means: list[np.ndarray] = []
        self.splitters: list[np.ndarray] = []
        for _ in range(passes or TRIALS):
            self._add(sample)
        if passes is None:
            wanted = self._wanted(sample, rows, least, window)
            for _ in range(TRIALS, wanted):
                self._add(sample)
            for own in (self.planes, self.medians, self.means, self.splitters):
                del own[wanted:]

    def _add(self, sample: np.ndarray) -> None:
        """One more pass."""
        planes = self.random.standard_normal((self.dim, BITS))
        medians, means = np.zeros(1 << DEPTH), np.zeros((1 << DEPTH, BITS - DEPTH), np.float32)
        projected = sample @ planes
        code = np.zeros(len(sample), np.int64)
        for level in range(DEPTH):
            nodes = 1 << level
            order = np.lexsort((projected[:, level], code))
            ends = np.searchsorted(code[order], np.arange(nodes + 1))
            full = np.flatnonzero(np.diff(ends))
            medians[nodes + full] = projected[order[(ends[full] + ends[full + 1]) // 2], level]
            code = 2 * code + (projected[:, level] > medians[nodes + code])
        held = np.maximum(np.bincount(code, minlength=1 << DEPTH), 1)
        for bit in range(DEPTH, BITS):
            means[:, bit - DEPTH] = np.bincount(code, projected[:, bit], minlength=1 << DEPTH) / held
        self.planes.append(planes)
        self.medians.append(medians)
        self.means.append(means)
        keys = np.sort(self.keys(len(self.planes) - 1, sample))
        self.splitters.append(keys[np.arange(1, self.ranges) * len(keys) // self.ranges])

    def keys(self, p: int, units: np.ndarray) -> np.ndarray:
        projected = units @ self.planes[p]
        code = np.zeros(len(projected), np.int64)
        for level in range(DEPTH):
            code = 2 * code + (projected[:, level] > self.medians[p][(1 << level) + code])
        key = code.copy()
        for bit in range(DEPTH, BITS):
            key = 2 * key + (projected[:, bit] > self.means[p][code, bit - DEPTH])
        return key

    def _wanted(self, sample: np.ndarray, rows: int, least: float, window: int) -> int:
        """Passes after which a share of MISS of the probes has never met, region by
        region of the first pass."""
        bits = math.ceil(math.log2(max(1, rows / window)))
        if not len(sample) or not bits:
            return 1
        if self.dim == 1 or bits > BITS:
            return 1 if self.dim == 1 else MOST_PASSES
        at = sample[: max(1, min(len(sample), PROBES))]
        away = self.random.standard_normal(at.shape)
        away -= (away * at).sum(axis=1, keepdims=True) * at
        probes = least * at + math.sqrt(1 - least * least) * away / np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-300)
        region = self.keys(0, at) >> (BITS - REGION_BITS)
        held = np.bincount(region, minlength=1 << REGION_BITS)
        met = np.zeros(1 << REGION_BITS)
        for p in range(TRIALS):
            met += np.bincount(region, (self.keys(p, at) >> (BITS - bits)) == (self.keys(p, probes) >> (BITS - bits)), minlength=1 << REGION_BITS)
        failed = 1 - np.minimum(met / (TRIALS * np.maximum(held, 1)), 1)
        share = held / held.sum()
        return next((k for k in range(1, MOST_PASSES) if (share * failed**k).sum() <= MISS), MOST_PASSES)


def _dealt(fitted, kind: str):
    """Each vector once for every pass: its range, key and bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("dim").to_numpy()
            for dim in np.unique(sizes):
                rows = batch.filter(pa.array(sizes == dim))
                first, own = fitted.value[int(dim)]
                units = _units(rows.column("vector"), kind)
                for p in range(len(own.planes)):
                    key = own.keys(p, units)
                    part = np.searchsorted(own.splitters[p], key, side="right")
                    yield pa.record_batch({"part": pa.array((first + p * own.ranges + part).astype(np.int32)), "last": pa.array(part == own.ranges - 1), "key": pa.array(key), "node": rows.column("node"), "vector": rows.column("vector")})

    return run


def _stars(x: np.ndarray, y: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Fewer pairs of 0..n-1 with the same components."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, x, label[y])
        np.minimum.at(new, y, label[x])
        new = new[new]
        if (new == label).all():
            out = np.flatnonzero(label != np.arange(n))
            return label[out], out
        label = new


def _neighbours(window: int, least: float, kind: str):
    """From rows sorted by (part, key, node): (a, b), a spanning forest of the pairs of
    cosine least or more within the window; and the rows at the borders of each range,
    under the number of the border (b null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail, part, seen = None, None, 0

        def border(rows: pa.Table, number: int, ahead: bool) -> pa.RecordBatch:
            n = rows.num_rows
            return pa.record_batch({"a": rows.column("node").combine_chunks(), "b": pa.nulls(n, pa.int64()), "border": pa.array(np.full(n, number, np.int32)), "ahead": pa.array(np.full(n, ahead)), "vector": rows.column("vector").combine_chunks()})

        def closed() -> Iterator[pa.RecordBatch]:
            if tail is not None and not tail.column("last")[0].as_py():
                yield border(tail, part, False)

        for batch in batches:
            parts = batch.column("part").to_numpy()
            starts = np.flatnonzero(np.append(True, parts[1:] != parts[:-1])) if len(parts) else []
            for s, e in zip(starts, np.append(starts[1:], len(parts)).astype(int)):
                rows = pa.Table.from_batches([batch.slice(int(s), int(e - s))])
                if part != parts[s]:
                    yield from closed()
                    tail, part, seen = None, int(parts[s]), 0
                if seen < window:
                    yield border(rows.slice(0, window - seen), part - 1, True)
                seen += rows.num_rows
                old = tail.num_rows if tail is not None else 0
                table = pa.concat_tables([tail, rows]).combine_chunks() if old else rows
                units, nodes = _units(table.column("vector"), kind), table.column("node").to_numpy()
                left, right = [], []
                for at in range(0, len(units), window):
                    ahead = units[at + 1 : at + 2 * window]
                    near = units[at : at + window] @ ahead.T >= least
                    x, y = np.nonzero(np.triu(np.tril(near, window - 1)))
                    fresh = at + 1 + y >= old
                    a, b = _stars(x[fresh], y[fresh] + 1, 2 * window + 1)
                    left.append(nodes[at + a])
                    right.append(nodes[at + b])
                if sum(map(len, left)):
                    a, b = np.concatenate(left), np.concatenate(right)
                    yield pa.record_batch({"a": pa.array(a), "b": pa.array(b), "border": pa.nulls(len(a), pa.int32()), "ahead": pa.nulls(len(a), pa.bool_()), "vector": pa.nulls(len(a), pa.binary())})
                tail = table.slice(max(0, table.num_rows - window))
        yield from closed()

    return run


def _bordering(least: float, kind: str):
    """(a, b) of pairs across a border, from rows sorted by it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs_of(batches, ["border"]):
            borders = table.column("border").to_numpy()
            starts = np.flatnonzero(np.append(True, borders[1:] != borders[:-1]))
            for s, e in zip(starts, np.append(starts[1:], len(borders))):
                rows = table.slice(int(s), int(e - s))
                ahead, nodes = rows.column("ahead").to_numpy(zero_copy_only=False), rows.column("a").to_numpy()
                if not ahead.any() or ahead.all():
                    continue
                units = _units(rows.column("vector"), kind)
                x, y = np.nonzero(units[~ahead] @ units[ahead].T >= least)
                yield pa.record_batch({"a": pa.array(nodes[~ahead][x]), "b": pa.array(nodes[ahead][y])})

    return run


def _fitted(classes: DataFrame, least: float, window: int, passes: int | None, seed: int, kind: str) -> tuple[dict, int]:
    """For each length of vectors (first range, Passes), and the number of all ranges.
    The sample is that of the smallest hashes, bounded by SAMPLE_ROWS and SAMPLE_BYTES
    over all lengths."""
    counts = {r["dim"]: r["count"] for r in classes.groupBy("dim").count().collect()}
    size = np.dtype(kind).itemsize * max(counts, default=1)
    bound = max(256, min(SAMPLE_ROWS, SAMPLE_BYTES // size))
    sample = classes.select("dim", "vector", F.xxhash64("vector").alias("h")).orderBy("h").limit(bound).select("dim", "vector").toArrow()
    out, first = {}, 0
    for dim, n in sorted(counts.items()):
        own = sample.filter(pa.array(sample.column("dim").to_numpy() == dim)).column("vector")
        out[dim] = (first, Passes(_units(own, kind) if len(own) else np.empty((0, dim)), dim, n, least, window, passes, seed))
        first += len(out[dim][1].planes) * out[dim][1].ranges
    return out, first


def _counted(least: float, kind: str):
    """(node, links) of each row of components that fit one tile, sorted by cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs_of(batches, ["cluster"]):
            clusters, copies = table.column("cluster").to_numpy(), table.column("copies").to_numpy()
            starts = np.flatnonzero(np.append(True, clusters[1:] != clusters[:-1]))
            links = np.zeros(len(clusters), np.int64)
            for s, e in zip(starts, np.append(starts[1:], len(clusters))):
                units = _units(table.column("vector").slice(int(s), int(e - s)), kind)
                near = units @ units.T >= least
                np.fill_diagonal(near, False)
                links[s:e] = near @ copies[s:e]
            yield pa.record_batch({"node": table.column("node").combine_chunks(), "links": pa.array(links)})

    return run


def _summed(kind: str):
    """Partial sums of the unit vectors of each cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clusters = batch.column("cluster").to_numpy()
            order = np.argsort(clusters, kind="stable")
            names, starts = np.unique(clusters[order], return_index=True)
            vectors = batch.column("vector").take(pa.array(order))
            for name, s, e in zip(names, starts, np.append(starts[1:], len(order))):
                total = _units(vectors.slice(int(s), int(e - s)), kind).sum(axis=0)
                yield pa.record_batch({"cluster": pa.array([name]), "total": pa.array([total.tobytes()], pa.binary())})

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for name, total in zip(batch.column("cluster").to_pylist(), batch.column("total").to_pylist()):
            totals[name] = totals.get(name, 0) + np.frombuffer(total, np.float64)
    for name, total in totals.items():
        yield pa.record_batch({"cluster": pa.array([name]), "total": pa.array([total.tobytes()], pa.binary())})


def _angled(kind: str):
    """Angle of each row to its cluster's mean (to any vector, if the mean is zero)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            angles = np.empty(batch.num_rows)
            for i, (blob, total) in enumerate(zip(batch.column("vector").to_pylist(), batch.column("total").to_pylist())):
                own, pivot = _unit(np.frombuffer(blob, kind)[None])[0], np.frombuffer(total, np.float64)
                size = np.linalg.norm(pivot)
                pivot = pivot / size if size > 1e-9 else np.eye(1, len(pivot))[0]
                # exact for small angles too
                angles[i] = 2 * math.atan2(np.linalg.norm(own - pivot), np.linalg.norm(own + pivot))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("cluster", "node", "copies", "vector")), pa.array(angles)], ["cluster", "node", "copies", "vector", "angle"])

    return run


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each tile, in one row."""
    for table in runs_of(batches, ["cluster", "shell", "slot"]):
        key = np.stack([table.column(k).to_numpy() for k in ("cluster", "shell", "slot")])
        starts = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)))
        for s, e in zip(starts, np.append(starts[1:], key.shape[1])):
            rows = table.slice(int(s), int(e - s))
            blobs = {"nodes": rows.column("node").to_numpy().tobytes(), "weights": rows.column("copies").to_numpy().tobytes(), "vectors": b"".join(rows.column("vector").to_pylist())}
            yield pa.record_batch({"cluster": pa.array([key[0, s]]), "shell": pa.array([key[1, s]], pa.int32()), "slot": pa.array([key[2, s]], pa.int32()), **{k: pa.array([x], pa.binary()) for k, x in blobs.items()}})


def _multiplied(least: float, kind: str):
    """(node, links) from pairs of tiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                nodes, weights, units = [], [], []
                for end in ("", "2"):
                    nodes.append(np.frombuffer(batch.column("nodes" + end)[r].as_buffer(), np.int64))
                    weights.append(np.frombuffer(batch.column("weights" + end)[r].as_buffer(), np.int64))
                    units.append(_unit(np.frombuffer(batch.column("vectors" + end)[r].as_buffer(), kind).reshape(len(nodes[-1]), -1)))
                near = units[0] @ units[1].T >= least
                same = batch.column("same")[r].as_py()
                if same:
                    np.fill_diagonal(near, False)
                yield pa.record_batch({"node": pa.array(nodes[0]), "links": pa.array(near @ weights[1])})
                if not same:
                    yield pa.record_batch({"node": pa.array(nodes[1]), "links": pa.array(near.T @ weights[0])})

    return run


def _degrees(placed: DataFrame, least: float, kind: str) -> DataFrame:
    """(node, links): copies of other vectors that link with each vector, counted within
    its cluster. placed: cluster, node, copies, vector."""
    spark = placed.sparkSession
    theta = math.acos(least)
    sizes = cut(placed.groupBy("cluster").agg(F.count("*").alias("rows")))
    small = placed.join(sizes.where(f"rows <= {TILE}"), "cluster").drop("rows")
    few = small.repartition(tasks(spark), "cluster").sortWithinPartitions("cluster").mapInArrow(_counted(least, kind), "node long, links long")
    # of larger ones: shells by the angle to the mean
    large = placed.join(sizes.where(f"rows > {TILE}"), "cluster").drop("rows")
    means = large.mapInArrow(_summed(kind), "cluster long, total binary").repartition(tasks(spark), "cluster").mapInArrow(_added, "cluster long, total binary")
    angled = large.join(cut(means), "cluster").mapInArrow(_angled(kind), "cluster long, node long, copies long, vector binary, angle double")
    shelled = cut(angled.withColumn("shell", F.floor(F.col("angle") * SHELLS / theta).cast("int")))
    shells = cut(shelled.groupBy("cluster", "shell").agg(F.min("angle").alias("low"), F.max("angle").alias("high"), F.sum("copies").alias("held"), F.ceil(F.count("*") / TILE).cast("int").alias("slots")))
    both = shells.join(shells.select("cluster", *[F.col(c).alias(f"{c}2") for c in ("shell", "low", "high", "held", "slots")]), "cluster")
    sure = both.where(F.col("high") + F.col("high2") <= theta - SLACK).groupBy("cluster", "shell").agg(F.sum("held2").alias("sure"), F.max(F.col("shell") == F.col("shell2")).alias("own"))
    by_shell = shelled.join(sure, ["cluster", "shell"]).select("node", (F.col("sure") - F.when(F.col("own"), F.col("copies")).otherwise(0)).alias("links"))
    open_ = both.where((F.col("shell") <= F.col("shell2")) & (F.col("high") + F.col("high2") > theta - SLACK) & (F.col("low2") - F.col("high") <= theta + SLACK))
    pairs = (
        open_.select("cluster", "shell", "shell2", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"), "slots2")
        .select("cluster", "shell", "slot", "shell2", F.explode(F.sequence(F.lit(0), F.col("slots2") - 1)).alias("slot2"))
        .where("shell < shell2 or slot <= slot2")
    )
    wanted = open_.select("cluster", "shell").union(open_.select("cluster", F.col("shell2").alias("shell"))).distinct()
    dealt = shelled.join(shells.select("cluster", "shell", "slots").join(wanted, ["cluster", "shell"]), ["cluster", "shell"]).withColumn("slot", F.expr("cast(pmod(xxhash64(node), slots) as int)"))
    order = ["cluster", "shell", "slot"]
    tiles = cut(dealt.select(*order, "node", "copies", "vector").repartition(tasks(spark), *order).sortWithinPartitions(*order).mapInArrow(_tiled, "cluster long, shell int, slot int, nodes binary, weights binary, vectors binary"))
    others = tiles.select("cluster", *[F.col(c).alias(f"{c}2") for c in ("shell", "slot", "nodes", "weights", "vectors")])
    matched = pairs.join(tiles, order).join(others, ["cluster", "shell2", "slot2"]).withColumn("same", (F.col("shell") == F.col("shell2")) & (F.col("slot") == F.col("slot2")))
    products = matched.mapInArrow(_multiplied(least, kind), "node long, links long")
    return few.unionByName(by_shell).unionByName(products).groupBy("node").agg(F.sum("links").alias("links"))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.9, passes: int | None = None, window: int = WINDOW, seed: int = 7) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row.

    Two vectors link when their cosine, in double precision, is least (above 0) or more.
    Windows find the components; passes None takes as many
    as the probes want (see the module), at most MOST_PASSES; vectors that crowd so that
    this isn't enough lose links between components. Within a component every link counts, found by a window or not. Equal
    vectors are one row of the passes, however many they are, and link with one another.

    Null or zero vectors, vectors with null or non-finite components and empty ones
    link with nothing, nor do vectors of different length. A null id stays as a row
    without component and counts for no one. Repeated rows (same id and vector)
    count as separate vectors. Other columns are not looked at. No rows give none.
    """
    spark = vectors.sparkSession
    given = vectors.schema[vector_col].dataType
    kind, typed = ("f4", "array<float>") if isinstance(given, ArrayType) and isinstance(given.elementType, FloatType) else ("f8", "array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(typed).alias("vector")).mapInArrow(_written(kind), "vec_id long, vector binary")
    classes = rows.where("vector is not null").groupBy("vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    classes = cut(classes.withColumn("dim", (F.length("vector") / np.dtype(kind).itemsize).cast("int")).withColumn("node", F.monotonically_increasing_id()))
    fitted, ranges = _fitted(classes, least, window, passes, seed, kind)
    passed = spark.sparkContext.broadcast(fitted)
    dealt = classes.select("dim", "node", "vector").mapInArrow(_dealt(passed, kind), "part int, last boolean, key long, node long, vector binary")
    ordered = dealt.repartitionById(max(1, ranges), "part").sortWithinPartitions("part", "key", "node")
    found = cut(ordered.mapInArrow(_neighbours(window, least, kind), "a long, b long, border int, ahead boolean, vector binary"))
    across = found.where("b is null").select("border", "ahead", "a", "vector").repartition(tasks(spark), "border").sortWithinPartitions("border").mapInArrow(_bordering(least, kind), "a long, b long")
    labels = cut(connected_components(found.where("b is not null").select("a", "b").unionByName(across)).withColumnRenamed("component", "cluster"))
    placed = cut(classes.join(labels, "node").select("cluster", "node", "id", "copies", "vector"))
    smallest = placed.groupBy("cluster").agg(F.min("id").alias("smallest"))
    degrees = _degrees(placed.drop("id"), least, kind)
    linked = cut(placed.select("cluster", "node").join(smallest, "cluster").join(degrees, "node", "left").select("node", "smallest", "links"))
    named = classes.join(linked, "node", "left").select("vector", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("smallest", "id").alias("first"))
    return rows.join(named, "vector", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("first", "vec_id").alias("component_id"), F.coalesce(F.col("vec_id") == F.coalesce("first", "vec_id"), F.lit(False)).alias("kept")
    )
