"""N-gram Jaccard join as a blocked sparse matrix product.

Rows of the matrix are distinct n-gram sets (documents with one set form a class,
named by a hash of the set), columns are n-grams. Columns are ordered from rare to
frequent: n-grams by the counts that are known of them or, where it is more, by what the
counts of their words let expect, so that an n-gram of common words comes late though
no task has met it twice; by the size-derived prefix bound, two sets that link share a column among
the first n - ceil(t*n) + 1 of each. The product over those columns is zero outside
of blocks that are found as components over columns; within each block the overlap
counts are accumulated over all columns and pairs below the bound
100*overlap >= percent*union are discarded. The order of columns changes the cost
only, never the result.

A block of more than TILE sets is not multiplied out whole. Sets of one minimum hash
are multiplied first, in tiles, a few times over; what links there becomes one label.
Then only tiles of different labels and of sizes that can link are multiplied, so a
large group of near copies costs a product a tile and seed, not one for each two tiles.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, cut, distinct, flat_hashes, flat_words, forest, mix, most_frequent, release, runs_of, slices, tasks, text_hash

#: Most n-grams that are known by name as frequent (the broadcast's bound: 16 bytes each).
FREQUENT = 1 << 17
#: N-grams among which repeated ones are looked for at once.
COUNTED = 4 << 20
#: Cells by hash that hold the counts of words (the broadcast: 4 bytes each), and the uses
#: in a task below which a cell counts as rare.
WORD_CELLS, COMMON = 1 << 20, 8
#: Cells by hash that tell which n-grams may be frequent.
FOUND_CELLS = 1 << 21
#: Postings of a bucket of columns, about; a column counted more often than HOT is split.
BUCKET, HOT = 1 << 20, 1 << 16
#: Postings that a task deals to buckets at once, and that are paired at once.
DEALT, CHUNK = 1 << 17, 1 << 15
#: A column with more rows than this joins its rows by a star instead of pair counts.
LONG_COLUMN = 64
#: Sets of a tile of the product, and n-grams of one that is sent to others.
TILE, TILE_GRAMS = 256, 1 << 20
#: Columns of a tile with fewer rows are multiplied pair by pair.
SHORT = 12
#: Tiles of a block that are all multiplied with one another, whatever they hold.
FEW_TILES = 16
#: Minimum hashes by which sets of a large block meet.
SEEDS = 3
#: Bits of the filter that names the sets wanted by the product (a bound on its size).
FILTER_BITS = 1 << 23


def _rolled(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets of each text's words, hashes of all words, hashes of n words from each on)."""
    bounds, flat = flat_words(texts)
    each = flat_hashes(flat)
    k = np.uint64(0x9E3779B97F4A7C15)
    rolled = np.zeros(max(0, len(each) - n + 1), np.uint64)
    for j in range(n):
        rolled = rolled * k + each[j : j + len(rolled)]
    return bounds, each, mix(rolled)


def _short(each: np.ndarray) -> np.ndarray:
    """The only shingle of a text with fewer words than a shingle has."""
    whole = np.array([len(each)], np.uint64)
    for x in each:
        whole = whole * np.uint64(0x9E3779B97F4A7C15) + x
    return mix(whole)


def _cells(each: np.ndarray) -> np.ndarray:
    return (each % np.uint64(WORD_CELLS)).astype(np.int64)


def shingle_sets(texts: pa.Array, n: int, used: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its n-word shingles; of a
    text with fewer words, of its whole sequence; of one without words, none. used: counts
    of words by cell, added to."""
    bounds, each, rolled = _rolled(texts, n)
    if used is not None:
        np.add.at(used, _cells(each), 1)
    for start, end in zip(bounds[:-1], bounds[1:]):
        if end - start >= n:
            yield distinct(rolled[start : end - n + 1])
        elif end > start:
            yield _short(each[start:end])
        else:
            yield np.empty(0, np.uint64)


def _finder(frequent: np.ndarray):
    """A function of n-grams: which of them are among the sorted frequent ones, and where
    there. Few are, so a table by hash answers for most."""
    table = np.zeros(FOUND_CELLS, bool)
    table[frequent % np.uint64(FOUND_CELLS)] = True

    def find(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(frequent):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        hit = np.flatnonzero(table[grams % np.uint64(FOUND_CELLS)])
        at = np.minimum(np.searchsorted(frequent, grams[hit]), len(frequent) - 1)
        same = frequent[at] == grams[hit]
        return hit[same], at[same]

    return find


def ordered_sets(texts: pa.Array, n: int, share: np.ndarray, find, known: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """shingle_sets, each with its shingles' ranks, which depend on the shingle alone: eighths of its sum
    over its words of share (by cell) or, where that is more, of known at the place that find gives."""
    bounds, each, rolled = _rolled(texts, n)
    of_word, rank = share[_cells(each)], np.zeros(len(rolled), np.float32)
    for j in range(n):
        rank += of_word[j : j + len(rolled)]
    hit, at = find(rolled)
    rank[hit] = np.maximum(known[at], rank[hit])
    # of 16 bits, which are sorted in linear time
    rank = np.round(8 * rank).astype(np.int16)
    for start, end in zip(bounds[:-1], bounds[1:]):
        if end - start >= n:
            own = rolled[start : end - n + 1]
            order = np.argsort(own)
            grams = own[order]
            first = np.append(True, grams[1:] != grams[:-1])
            yield grams[first], rank[start : end - n + 1][order[first]]
        elif end > start:
            yield _short(each[start:end]), np.zeros(1, np.int16)
        else:
            yield np.empty(0, np.uint64), np.empty(0, np.int16)


def _name(grams: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


def _described(n: int, hashed: bool):
    """Rows of three kinds: a document's set size and name, with hashed its text_hash too; the n-grams that repeat
    among the documents of about COUNTED n-grams; the cells of words that a task uses COMMON times or more. The
    latter two are pairs of key and count in binary."""

    def packed(kind: str, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        blob = pa.array([np.stack([keys.view(np.int64), counts.astype(np.int64)]).tobytes()], pa.binary())
        none = pa.nulls(1, pa.int64())
        return pa.record_batch({**({"text_hash": none} if hashed else {}), "doc_id": none, "node": none, "size": none, **{k: blob if k == kind else pa.nulls(1, pa.binary()) for k in ("grams", "words")}})

    def repeated(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if held:
            grams, counts = np.unique(np.concatenate(held), return_counts=True)
            yield packed("grams", grams[counts > 1], counts[counts > 1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        total, used = 0, np.zeros(WORD_CELLS, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                sets = list(shingle_sets(part.column("text"), n, used))
                yield pa.record_batch(
                    {**({"text_hash": part.column("text_hash")} if hashed else {}), "doc_id": part.column("doc_id"), "node": pa.array([_name(s) for s in sets], pa.int64()), "size": pa.array([len(s) for s in sets], pa.int64()), "grams": pa.nulls(len(sets), pa.binary()), "words": pa.nulls(len(sets), pa.binary())}
                )
                held += sets
                total += sum(map(len, sets))
                if total >= COUNTED:
                    yield from repeated(held)
                    held, total = [], 0
        yield from repeated(held)
        at = np.flatnonzero(used >= COMMON)
        yield packed("words", at, used[at])

    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, count) from pairs in binary."""
    for batch in batches:
        for blob in batch.column(0):
            keys, counts = np.frombuffer(blob.as_py(), np.int64).reshape(2, -1)
            yield pa.record_batch({"key": pa.array(keys), "count": pa.array(counts)})


def _shares(counted: DataFrame, n: int) -> np.ndarray:
    """For each cell a logarithm, so that the sum over the words of an n-gram is that of the
    count to expect of it were words drawn one by one. counted: key, count of cells, at
    most WORD_CELLS rows."""
    rows = counted.toArrow()
    counts = np.ones(WORD_CELLS, np.float64)
    counts[rows.column("key").to_numpy()] = rows.column("count").to_numpy()
    return (np.log2(counts) - (n - 1) / n * np.log2(counts.sum())).astype(np.float32)


def _prefixes(n: int, percent: int, frequent: np.ndarray, known: np.ndarray, parts: np.ndarray, shares, buckets: int):
    """Postings (gram, node, size) of the prefix columns of each distinct set: a row for
    each bucket of columns, with the postings in binary. known: logarithms of the
    counts of frequent n-grams; shares: a broadcast, see _shares."""

    def dealt(find, columns: list[np.ndarray], nodes: list[np.ndarray], sizes: list[np.ndarray]) -> pa.RecordBatch:
        gram, node, size = np.concatenate(columns), np.concatenate(nodes), np.concatenate(sizes)
        place = gram.copy()
        # a hot column lies in several buckets, dealt by its rows
        hit, at = find(gram)
        place[hit] += node[hit].view(np.uint64) % parts[at].astype(np.uint64)
        bucket = (mix(place) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
        gram, node, size, bucket = gram[order], node[order], size[order], bucket[order]
        starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        ends = np.append(starts[1:], len(bucket))
        blobs = [[x[a:b].tobytes() for a, b in zip(starts, ends)] for x in (gram, node, size)]
        return pa.record_batch({"bucket": pa.array(bucket[starts]), **{k: pa.array(x, pa.binary()) for k, x in zip(("gram", "node", "size"), blobs)}})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, find = np.frombuffer(shares.value, np.float32), _finder(frequent)
        for batch in batches:
            seen: set[int] = set()
            columns, nodes, sizes, held = [], [], [], 0
            for part in slices(batch, "text"):
                for grams, rank in ordered_sets(part.column("text"), n, share, find, known):
                    if not len(grams) or (name := _name(grams)) in seen:
                        continue
                    seen.add(name)
                    length = len(grams) - (-(-percent * len(grams) // 100)) + 1
                    # equal ones, nearly, by their hash: which columns of a set are meant is to be chance
                    columns.append(grams[np.argsort(rank, kind="stable")[:length]])
                    nodes.append(np.full(length, name, np.int64))
                    sizes.append(np.full(length, len(grams), np.int32))
                    held += length
                if held >= DEALT:
                    yield dealt(find, columns, nodes, sizes)
                    columns, nodes, sizes, held = [], [], [], 0
            if held:
                yield dealt(find, columns, nodes, sizes)

    return run


def _block_edges(percent: int, split: np.ndarray):
    """From postings sorted by bucket: partial overlap counts of pairs whose sizes can
    link, for columns of up to LONG_COLUMN rows; star edges (count null) over the rows
    of a longer column whose sizes can still link. Of a split column the hubs of all
    parts have an edge to the column itself, where they meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs_of(batches, ["bucket"]):
            starts = np.flatnonzero(np.diff(table.column("bucket").to_numpy(), prepend=-1))
            for s, e in zip(starts, np.append(starts[1:], table.num_rows)):
                rows = table.slice(int(s), int(e - s))
                yield from edges(*(np.frombuffer(b"".join(rows.column(k).to_pylist()), t) for k, t in (("gram", np.int64), ("node", np.int64), ("size", np.int32))))

    def edges(gram: np.ndarray, node: np.ndarray, size: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((node, size, gram))
        gram, node, size = gram[order], node[order], size[order]
        fresh = np.ones(len(gram), bool)
        fresh[1:] = (gram[1:] != gram[:-1]) | (node[1:] != node[:-1])
        gram, node, size = gram[fresh], node[fresh], size[fresh].astype(np.int64)
        # whole columns of about CHUNK postings at once: pairs take many times their memory
        columns = np.flatnonzero(np.append(True, gram[1:] != gram[:-1])) if len(gram) else np.empty(0, np.int64)
        ends = np.append(columns[1:], len(gram)).astype(np.int64)
        low = 0
        for high in ends[np.append(np.diff(ends // CHUNK) > 0, True)] if len(ends) else []:
            yield from pairs_of(gram[low:high], node[low:high], size[low:high])
            low = high

    def pairs_of(gram: np.ndarray, node: np.ndarray, size: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = np.flatnonzero(np.append(True, gram[1:] != gram[:-1])) if len(gram) else np.empty(0, np.int64)
        length = np.repeat(np.diff(np.append(first, len(gram))), np.diff(np.append(first, len(gram))))
        long = length > LONG_COLUMN
        out = []
        if long.any():
            g, v, z = gram[long], node[long], size[long]
            start = np.ones(len(g), bool)
            start[1:] = (g[1:] != g[:-1]) | (100 * z[:-1] < percent * z[1:])
            at = np.flatnonzero(start)
            hubs = np.minimum.reduceat(v, at)
            hub = np.repeat(hubs, np.diff(np.append(at, len(v))))
            meet = np.isin(g[at], split)
            out.append((np.unique(np.stack([np.append(hub[hub != v], g[at][meet]), np.append(v[hub != v], hubs[meet])]), axis=1), None))
        # a part of a split column may be short, and its rows are still to meet those of others
        short = (length > 1) & ~long
        lone = ~long & np.isin(gram, split)
        if lone.any():
            out.append((np.stack([gram[lone], node[lone]]), None))
        g, v, z = gram[short], node[short], size[short]
        left, right = [], []
        for shift in range(1, int(length[short].max()) if short.any() else 1):
            near = np.flatnonzero((g[:-shift] == g[shift:]) & (100 * z[:-shift] >= percent * z[shift:]))
            left.append(near)
            right.append(near + shift)
        if left:
            x, y = np.concatenate(left), np.concatenate(right)
            swap = v[x] > v[y]
            x, y = np.where(swap, y, x), np.where(swap, x, y)
            order = np.lexsort((v[y], v[x]))
            x, y = x[order], y[order]
            new = np.flatnonzero(np.append(True, (v[x][1:] != v[x][:-1]) | (v[y][1:] != v[y][:-1]))) if len(x) else np.empty(0, np.int64)
            counts = np.diff(np.append(new, len(x)))
            out.append((np.stack([v[x[new]], v[y[new]], z[x[new]], z[y[new]]]), counts))
        for rows, counts in out:
            if rows.shape[1]:
                m = rows.shape[1]
                sizes = (pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())) if counts is None else (pa.array(rows[2]), pa.array(rows[3]), pa.array(counts))
                yield pa.record_batch({"a": pa.array(rows[0]), "b": pa.array(rows[1]), "size_a": sizes[0], "size_b": sizes[1], "count": sizes[2]})

    return run


def overlaps(sets: list[np.ndarray], others: list[np.ndarray] | None = None, columns_at_once: int = 4096) -> np.ndarray:
    """Overlap counts of every two sets (of sets and others, if given): a product of
    sparse rows, accumulated as integers. Columns of few rows are multiplied pair by
    pair, others in blocks."""
    whole = sets + (others or [])
    split = len(sets) if others is not None else 0
    where = np.repeat(np.arange(len(whole)), [len(s) for s in whole])
    grams = np.concatenate(whole)
    order = np.lexsort((where, grams))
    where, grams = where[order], grams[order]
    start = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
    count = np.diff(np.append(start, len(grams)))
    height, width = (split, len(whole) - split) if others is not None else (len(whole), len(whole))
    total = np.zeros(height * width, np.int64)
    length = np.repeat(count, count)
    few = (length > 1) & (length < SHORT)
    row, gram = where[few], grams[few]
    for shift in range(1, SHORT - 1):
        same = np.flatnonzero(gram[:-shift] == gram[shift:])
        if not len(same):
            break
        x, y = row[same], row[same + shift]
        if others is not None:
            across = (x < split) & (y >= split)
            x, y = x[across], y[across] - split
        total += np.bincount(x * width + y, minlength=len(total))
    total = total.reshape(height, width)
    if others is None:
        total += total.T
        total[np.arange(height), np.arange(height)] = [len(s) for s in sets]
    many = np.flatnonzero(count >= SHORT)
    for low in range(0, len(many), columns_at_once):
        some = many[low : low + columns_at_once]
        block = np.zeros((len(whole), len(some)), np.float32)
        for k, c in enumerate(some):
            block[where[start[c] : start[c] + count[c]], k] = 1
        # at most columns_at_once, so exact
        product = (block[:split] @ block[split:].T if others is not None else block @ block.T).astype(np.int64)
        if others is None:
            np.fill_diagonal(product, 0)
        total += product
    return total


def _rows(table: pa.Table, s: int, e: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Nodes and n-gram sets of some rows, each node once."""
    nodes, first = np.unique(table.column("node").to_numpy()[s:e], return_index=True)
    blobs = table.column("grams").slice(s, e - s).to_pylist()
    return nodes, [np.frombuffer(blobs[x], np.uint64) for x in first]


def _product(percent: int, every: bool, keys: list[str]):
    """Links within the tiles that keys name, as all pairs or as a spanning forest of
    each tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs_of(batches, keys):
            key = np.stack([table.column(k).to_numpy() for k in keys])
            starts = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)))
            left, right = [], []
            for s, e in zip(starts, np.append(starts[1:], table.num_rows)):
                own, sets = _rows(table, int(s), int(e))
                if len(own) < 2:
                    continue
                both, sizes = overlaps(sets), np.array([len(x) for x in sets])
                x, y = np.nonzero(np.triu(100 * both >= percent * (sizes[:, None] + sizes[None, :] - both), 1))
                a, b = (own[x], own[y]) if every or not len(x) else forest(own[x], own[y])
                left.append(a)
                right.append(b)
            if left and sum(map(len, left)):
                yield pa.record_batch({"a": pa.array(np.concatenate(left)), "b": pa.array(np.concatenate(right))})

    return run


TILE_KEYS = ["cluster", "band", "kind", "slot"]
PAIR_KEYS = [*TILE_KEYS, "band2", "kind2", "slot2"]


def _crossed(percent: int, every: bool):
    """Links between sets of different labels, from the rows of pairs of tiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs_of(batches, PAIR_KEYS):
            key = np.stack([table.column(k).to_numpy() for k in PAIR_KEYS])
            starts = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)))
            left, right = [], []
            for s, e in zip(starts, np.append(starts[1:], table.num_rows)):
                rows = table.slice(int(s), int(e - s))
                behind = rows.column("behind").to_numpy(zero_copy_only=False)
                label = dict(zip(rows.column("node").to_pylist(), rows.column("label").to_pylist()))
                same = not behind.any()
                (nodes, sets), (nodes2, sets2) = (_rows(rows.filter(pa.array(x)), 0, int(x.sum())) for x in (~behind, ~behind if same else behind))
                if not len(nodes) or not len(nodes2):
                    continue
                (sizes, labels), (sizes2, labels2) = ((np.array([len(x) for x in y]), np.array([label[i] for i in z.tolist()])) for y, z in ((sets, nodes), (sets2, nodes2)))
                both = overlaps(sets) if same else overlaps(sets, sets2)
                link = (100 * both >= percent * (sizes[:, None] + sizes2[None, :] - both)) & (labels[:, None] != labels2[None, :])
                x, y = np.nonzero(np.triu(link, 1) if same else link)
                a, b = (nodes[x], nodes2[y]) if every or not len(x) else forest(nodes[x], nodes2[y])
                left.append(a)
                right.append(b)
            if left and sum(map(len, left)):
                yield pa.record_batch({"a": pa.array(np.concatenate(left)), "b": pa.array(np.concatenate(right))})

    return run


def _sets(n: int, wanted):
    """(doc_id, node, size, grams, m0..) of the sets that the filter lets pass, each once
    a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(wanted.value, np.uint8), bitorder="little").astype(bool)
        seen: set[int] = set()
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            batch = batch.filter(pa.array(bits[(mix(ids.astype(np.uint64)) % np.uint64(FILTER_BITS)).astype(np.int64)]))
            for part in slices(batch, "text"):
                rows, names, sets = [], [], []
                for i, s in enumerate(shingle_sets(part.column("text"), n)):
                    if len(s) and ((name := _name(s)), part.column("doc_id")[i].as_py()) not in seen:
                        seen.add((name, part.column("doc_id")[i].as_py()))
                        rows.append(i)
                        names.append(name)
                        sets.append(s)
                if not rows:
                    continue
                least = [[int(mix(s ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (1 << 64) - 1)).min().astype(np.int64)) for s in sets] for k in range(SEEDS)]
                yield pa.record_batch({"doc_id": part.column("doc_id").take(pa.array(rows)), "node": pa.array(names, pa.int64()), "size": pa.array([len(s) for s in sets], pa.int64()), "grams": pa.array([s.tobytes() for s in sets], pa.binary()), "least": pa.array([list(x) for x in zip(*least)], pa.list_(pa.int64()))})

    return run


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bits of the filter that a task's ids set, packed by words of 64."""
    bits = np.zeros(FILTER_BITS, bool)
    for batch in batches:
        bits[(mix(batch.column("class_id").to_numpy().astype(np.uint64)) % np.uint64(FILTER_BITS)).astype(np.int64)] = True
    packed = np.packbits(bits, bitorder="little").view(np.int64)
    at = np.flatnonzero(packed)
    yield pa.record_batch({"at": pa.array(at), "word": pa.array(packed[at])})


def _wanted(needed: DataFrame) -> bytes:
    """The filter: FILTER_BITS bits, however many ids there are."""
    words_ = needed.select("class_id").mapInArrow(_marked, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    packed = np.zeros(FILTER_BITS // 64, np.int64)
    packed[words_.column("at").to_numpy()] = words_.column("word").to_numpy()
    return packed.tobytes()


def _large_blocks(large: DataFrame, percent: int, every: bool) -> DataFrame:
    """Links (a, b) within blocks of more than TILE sets. large: cluster, node, size,
    grams, least."""
    spark = large.sparkSession
    if every:
        labelled = large.select("cluster", "node", "size", F.col("node").alias("label"))
        first = None
    else:
        seeded = large.select("cluster", "node", F.posexplode("least").alias("seed", "m"))
        groups = seeded.groupBy("cluster", "seed", "m").agg(F.ceil(F.count("*") / TILE).alias("slots"))
        dealt = seeded.join(groups, ["cluster", "seed", "m"]).withColumn("slot", F.pmod(F.xxhash64("node", "seed"), F.col("slots")))
        keys = ["cluster", "seed", "m", "slot"]
        tiles = large.select("node", "grams").join(dealt.select(*keys, "node"), "node").withColumn("seed", F.col("seed").cast("long"))
        first = cut(tiles.repartition(tasks(spark), *keys).sortWithinPartitions(*keys).mapInArrow(_product(percent, False, keys), "a long, b long"))
        labels = connected_components(first).withColumnRenamed("component", "label")
        labelled = large.select("cluster", "node", "size").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    labelled = cut(labelled)
    several = labelled.groupBy("cluster").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("cluster")
    several = labelled.join(several, "cluster").groupBy("cluster").agg(F.count("*").alias("held"))
    # sizes of linked sets lie in one band or in neighbouring ones; a block of a few tiles
    # isn't cut finer
    band = F.floor(F.log(F.col("size").cast("double")) / math.log(100 / percent) + 1e-9) if percent < 100 else F.col("size")
    wide = F.col("held") > TILE * FEW_TILES
    rest = cut(labelled.join(several, "cluster").withColumn("band", F.when(wide, band).otherwise(0).cast("long")).withColumn("wide", wide))
    counts = rest.groupBy("cluster", "band", "label").agg(F.count("*").alias("n"), F.first("wide").alias("wide"))
    # a label of its own tiles, or 0 for those that share some
    kinds = counts.select("cluster", "band", "label", F.when(F.col("wide") & (F.col("n") >= TILE // 2), F.col("label")).otherwise(0).alias("kind"))
    named = cut(rest.join(kinds, ["cluster", "band", "label"]))
    tiles = cut(named.groupBy("cluster", "band", "kind").agg(F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("size") / TILE_GRAMS)).alias("slots")))
    placed = named.join(tiles, ["cluster", "band", "kind"]).withColumn("slot", F.pmod(F.xxhash64("node"), F.col("slots"))).select(*TILE_KEYS, "node", "label")
    spread = tiles.select("cluster", "band", "kind", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)).alias("slot"))
    ahead = spread.withColumn("band2", F.explode(F.array(F.col("band"), F.col("band") + 1)))
    behind = spread.select("cluster", *[F.col(c).alias(f"{c}2") for c in ("band", "kind", "slot")])
    pairs = cut(ahead.join(behind, ["cluster", "band2"]).where("(band < band2 or kind < kind2 or (kind = kind2 and slot <= slot2)) and not (kind = kind2 and kind <> 0)").select(*PAIR_KEYS))
    first_side = placed.join(pairs, TILE_KEYS).select(*PAIR_KEYS, F.lit(False).alias("behind"), "node", "label")
    other_side = placed.join(pairs.withColumnsRenamed({k: f"{k}1" for k in TILE_KEYS[1:]}).withColumnsRenamed({f"{k}2": k for k in TILE_KEYS[1:]}), TILE_KEYS).where("band <> band1 or kind <> kind1 or slot <> slot1")
    other_side = other_side.select("cluster", *[F.col(f"{k}1").alias(k) for k in TILE_KEYS[1:]], *[F.col(k).alias(f"{k}2") for k in TILE_KEYS[1:]], F.lit(True).alias("behind"), "node", "label")
    sent = first_side.unionByName(other_side).join(large.select("node", "grams"), "node")
    crossed = sent.repartition(tasks(spark), *PAIR_KEYS).sortWithinPartitions(*PAIR_KEYS).mapInArrow(_crossed(percent, every), "a long, b long")
    return crossed if first is None else first.unionByName(crossed)


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80, every_link: bool = False, hashed: bool = False) -> tuple[DataFrame, DataFrame]:
    """Documents whose word n-gram sets have Jaccard similarity percent/100 or more.

    Returns (members, links). members: doc_id, n_shingles, class_id (smallest doc_id
    with the same set) for each row. links: pairs (a, b) of class hashes
    (members.node); with hashed members have text_hash; with every_link all links between different sets, else enough of
    them to join each component.

    Null and blank texts have an empty set and link with nothing; a null id stays as
    a row but is in no class. Repeated rows fall into one class. Texts are read
    whole. Other columns of docs are not looked at. No rows give no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    named = ["text_hash"] if hashed else []
    texts = docs.select(*[text_hash(F.col("text")).alias(x) for x in named], "doc_id", "text")
    described = cut(texts.mapInArrow(_described(n, hashed), ("text_hash long, " if hashed else "") + "doc_id long, node long, size long, grams binary, words binary"))
    members = cut(described.where("size is not null").select(*named, "doc_id", "node", "size"))
    # frequent n-grams and words, bounded in number: they only order the columns and split hot ones
    counts_of = lambda kind: described.where(F.col(kind).isNotNull()).select(kind).mapInArrow(_unpacked, "key long, count long").groupBy("key").agg(F.sum("count").alias("count"))
    repeated = cut(counts_of("grams").withColumnRenamed("key", "gram"))
    top = most_frequent(repeated, FREQUENT).toPandas()
    frequent = top["gram"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(frequent)
    known = np.log2(top["count"].to_numpy(dtype=np.float64))[order].astype(np.float32)
    parts = (top["count"].to_numpy(dtype=np.int64) // HOT + 1)[order]
    shares = spark.sparkContext.broadcast(_shares(counts_of("words"), n).tobytes())
    del described, repeated, counts_of
    total = members.agg(F.sum("size")).first()[0] or 0
    # of small corpora too little is left on the disks to wait for
    free = release if total > COUNTED else lambda spark: None
    free(spark)
    buckets = max(tasks(spark), total * (100 - percent) // 100 // BUCKET)
    postings = docs.where("doc_id is not null").mapInArrow(_prefixes(n, percent, frequent[order], known, parts, shares, buckets), "bucket long, gram binary, node binary, size binary")
    columns = postings.repartitionById(min(buckets, tasks(spark)), F.expr(f"cast(bucket % {min(buckets, tasks(spark))} as int)")).sortWithinPartitions("bucket")
    partial = columns.mapInArrow(_block_edges(percent, frequent[order][parts > 1].view(np.int64)), "a long, b long, size_a long, size_b long, count long")
    # counts over all columns; what a prefix has not shared, the rest of the sets could
    counted = partial.groupBy("a", "b").agg(F.sum("count").alias("count"), F.max("size_a").alias("size_a"), F.max("size_b").alias("size_b"), F.max(F.col("count").isNull()).alias("star"))
    least = F.expr(f"({percent} * (size_a + size_b) + {99 + percent}) div {100 + percent}")
    rest = lambda size: F.expr(f"({percent} * {size} + 99) div 100 - 1")
    edges = counted.where(F.col("star") | (F.col("count") + F.greatest(rest("size_a"), rest("size_b")) >= least)).select("a", "b")
    # a long column is a node of the graph too, but no set
    first = cut(members.where("doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("class_id")))
    blocks = cut(connected_components(edges).join(first, "node").select("node", "class_id", F.col("component").alias("cluster")))
    sized = blocks.groupBy("cluster").agg(F.count("*").alias("held")).where("held > 1")
    needed = cut(blocks.join(sized, "cluster"))
    free(spark)
    passing = spark.sparkContext.broadcast(_wanted(needed))
    sets = docs.where("doc_id is not null").mapInArrow(_sets(n, passing), "doc_id long, node long, size long, grams binary, least array<long>")
    rows = cut(sets.join(needed.withColumnRenamed("class_id", "doc_id"), ["doc_id", "node"]).drop("doc_id"))
    free(spark)
    small = rows.where(f"held <= {TILE}").select("cluster", "node", "grams").repartition(tasks(spark), "cluster").sortWithinPartitions("cluster").mapInArrow(_product(percent, every_link, ["cluster"]), "a long, b long")
    large = rows.where(f"held > {TILE}").drop("held").dropDuplicates(["node"])
    links = cut(small.unionByName(_large_blocks(cut(large), percent, every_link)) if sized.where(f"held > {TILE}").limit(1).count() else small)
    return members.join(first, "node", "left").select(*named, "doc_id", F.col("size").alias("n_shingles"), "node", "class_id"), links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80, hashed: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id of each document: the smallest doc_id that
    links reach, itself included (null where doc_id is null); with hashed text_hash
    too, which tells texts of one doc_id apart. See jaccard_join."""
    members, links = jaccard_join(docs, id_col, text_col, n, percent, hashed=hashed)
    found = connected_components(links)
    first = members.where("doc_id is not null and n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    labelled = found.join(first, "node")
    smallest = labelled.groupBy("component").agg(F.min("doc_id").alias("smallest"))
    named = cut(labelled.join(smallest, "component").select("node", "smallest"))
    return members.join(named, "node", "left").select(
        *(["text_hash"] if hashed else []),
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.coalesce("smallest", "class_id"))).alias("component_id"),
    )
