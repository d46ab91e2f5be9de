"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and
skip-grams.

Features are the presence of hashed unigrams, bigrams, trigrams and one-word
skip-grams. FTRL-proximal gives each coordinate its own rate, and its L1 term leaves
few weights other than zero, so the model that tasks receive is small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import cut, distinct, mix, slices, string_hash, words

#: Hash slots (the weights' bound), and most labelled rows that the model is fitted on.
SLOTS = 1 << 20
MAX_ROWS = 12_000
EPOCHS = 3
#: Marks that are no part of a word at its ends.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¡¿«»…“”‘’„–—"
#: ALPHA, L1, EPOCHS and MARKS were chosen by cross-validation (three folds, F1) on the
#: labels of sf0.1 that are not held out.
ALPHA, BETA, L1, L2 = 3.0, 1.0, 6.0, 0.1


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, slot) of every occurrence."""
    bounds, codes, distinct = words(texts)
    bare = pc.utf8_trim(distinct, characters=MARKS)
    each = string_hash(bare)[codes] if len(codes) else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    k = np.uint64(0x9E3779B97F4A7C15)
    docs, slots = [owner], [each]
    for salt, offsets in enumerate(((0, 1), (0, 2), (0, 1, 2)), 2):
        n = max(0, len(each) - offsets[-1])
        x = np.full(n, salt, np.uint64)
        for o in offsets:
            x = x * k + each[o : o + n]
        inside = owner[:n] == owner[offsets[-1] : offsets[-1] + n]
        docs.append(owner[:n][inside])
        slots.append(x[inside])
    return np.concatenate(docs), (mix(np.concatenate(slots)) & np.uint64(SLOTS - 1)).astype(np.int32)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            doc, slot = features(part.column("text"))
            pairs = distinct(doc.astype(np.int64) * SLOTS + slot)
            bounds = np.searchsorted(pairs // SLOTS, np.arange(part.num_rows + 1)).astype(np.int32)
            yield pa.record_batch({"turn": part.column("turn"), "label": part.column("label"), "slots": pa.ListArray.from_arrays(pa.array(bounds), pa.array((pairs % SLOTS).astype(np.int32)))})


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One online pass over rows in their order; the last slot is the intercept."""
    z, n = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)

    def weights(at):
        shrunk = np.sign(z[at]) * np.maximum(0, np.abs(z[at]) - np.where(at == SLOTS, 0.0, L1))
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    seen = 0
    for batch in batches:
        labels = batch.column("label").to_numpy()
        lists = batch.column("slots")
        flat, bounds = lists.values.to_numpy(), lists.offsets.to_numpy()
        for i, y in enumerate(labels):
            at = np.append(flat[bounds[i] : bounds[i + 1]], SLOTS)
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
            seen += 1
    if seen:
        w = weights(np.arange(SLOTS + 1))
        at = np.flatnonzero(w)
        yield pa.record_batch({"slot": pa.array(at.astype(np.int32)), "weight": pa.array(w[at])})


def _scored(model, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, weight = model.value
        dense = np.zeros(SLOTS + 1)
        dense[slot] = weight
        for batch in batches:
            row = batch.column("row")
            texts = batch.column("text") if "text" in batch.schema.names else row.field(text_col)
            for part in slices(pa.record_batch({"row": row, "text": texts}), "text"):
                doc, at = features(part.column("text"))
                hit = dense[at] != 0
                pairs = distinct(doc[hit].astype(np.int64) * SLOTS + at[hit])
                total = dense[SLOTS] + np.bincount(pairs // SLOTS, dense[pairs % SLOTS], minlength=part.num_rows)
                score = 1 / (1 + np.exp(-np.clip(total, -35, 35))) if len(slot) else np.zeros(part.num_rows)
                yield pa.record_batch({"row": part.column("row"), "__score": pa.array(score)})

    return run


def held_out(id_col: F.Column) -> F.Column:
    """True where crc32 of the id as text leaves 0 when divided by 5."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = MAX_ROWS, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """(slots, weights) other than zero, the intercept in slot SLOTS.

    Fitted on at most max_rows labelled rows that are not held out, those whose ids
    have the smallest hashes. Null ids and labels teach nothing; of several labels of
    an id the largest counts, of several texts the smallest; without rows the model is
    empty.
    """
    known = labels.select(F.col(id_col).cast("long").alias("__id"), F.col(label_col).cast("int").alias("label")).where("__id is not null and label is not null").where(~held_out(F.col("__id"))).groupBy("__id").agg(F.max("label").alias("label"))
    texts = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("text"))
    present = known.join(texts.select("__id").distinct(), "__id", "left_semi")
    chosen = cut(present.withColumn("turn", F.xxhash64("__id")).orderBy("turn", "__id").limit(max_rows))
    # one text for each id, so that repeated rows of an id keep the bound
    rows = texts.join(F.broadcast(chosen), "__id").groupBy("__id", "turn", "label").agg(F.min("text").alias("text")).select("turn", F.col("label").cast("double").alias("label"), "text")
    featured = rows.mapInArrow(_featured, "turn long, label double, slots array<int>")
    order = F.explode(F.sequence(F.lit(1), F.lit(epochs))).alias("epoch")
    turned = featured.select("*", order).withColumn("turn", F.xxhash64("turn", "epoch")).repartition(1).sortWithinPartitions("epoch", "turn", "label")
    found = turned.select("label", "slots").mapInArrow(_trained, "slot int, weight double").toPandas()
    return found["slot"].to_numpy(dtype=np.int64), found["weight"].to_numpy(dtype=np.float64)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], text_col: str = "text") -> DataFrame:
    """docs with __score, 0 to 1: the likelier toxic, the higher. Null texts are
    empty, and an empty text has the intercept's score; an empty model scores 0.
    Texts are read whole; other columns pass through."""
    passed = docs.sparkSession.sparkContext.broadcast(model)
    # a text that is there as such is not sent twice
    there = [f.dataType for f in docs.schema.fields if f.name == text_col] == [StringType()]
    inner = docs.select(F.struct("*").alias("row"), *([] if there else [F.col(text_col).cast("string").alias("text")]))
    schema = StructType([inner.schema["row"], StructField("__score", DoubleType())])
    return inner.mapInArrow(_scored(passed, text_col), schema).select("row.*", "__score")
