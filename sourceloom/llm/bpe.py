"""Byte-level BPE through a table of distinct words.

Texts are split into words. Each slice of up to 64 MB of text keeps the numbers of its
words in their order and sends its distinct words to the buckets of a table, by hash. A
bucket encodes each distinct word of the corpus that falls to it once, whichever slices
ask, and answers each slice with the ids of its words; there ids are joined back by
position. The table is never in one place: a task holds one bucket of it at a time.
Decoding joins ids with the pieces of the vocabulary.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, runs_of, slices, string_hash, tasks

#: Buckets of the table for each task of a shuffle, words that are encoded at once, most
#: bytes of text of a slice (a batch of rows is one, if it holds no more), and words that
#: are joined with their ids at once.
BUCKETS, AT_ONCE, SLICE, JOINED = 2, 1 << 16, 64 << 20, 1 << 20
#: The split of byte-level BPE, and how it writes bytes as characters.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: From here on, character classes can depend on the library's Unicode version.
OTHER_SCRIPTS = regex.compile("[԰-\U0010ffff]")


def _byte_characters() -> dict[str, int]:
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """A tokenizer file, read from its JSON text (tasks get the text, not a path)."""

    def __init__(self, text: str):
        from tokenizers import Tokenizer

        spec = json.loads(text)
        if (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or spec["normalizer"] or spec["pre_tokenizer"]["add_prefix_space"] or not spec["pre_tokenizer"]["use_regex"] or spec["post_processor"]:
            raise ValueError("only byte-level BPE with the standard split is supported")
        self.tokenizer = Tokenizer.from_str(text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens must match literally")
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        bytes_of = _byte_characters()
        self.pieces: dict[int, bytes] = {}
        for piece, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            known = piece not in self.special and all(c in bytes_of for c in piece)
            self.pieces[i] = bytes(bytes_of[c] for c in piece) if known else piece.encode()
        self.id_type = np.dtype(np.uint16 if max(self.pieces) < 1 << 16 else np.uint32)
        every = range(max(self.pieces) + 1)
        self.piece_table = pa.array([self.pieces.get(i, b"") for i in every], pa.large_binary())
        self.decimals = pa.array([b"%d" % i for i in every], pa.large_binary())

    def words(self, text: str) -> list[str]:
        if self.at_special and any(s in text for s in self.special):
            return [w for part in self.at_special.split(text) if part for w in ([part] if part in self.special else self._split(part))]
        return self._split(text)

    def _split(self, text: str) -> list[str]:
        if text.isascii() or not OTHER_SCRIPTS.search(text):
            return SPLIT.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def joined(self, table: pa.Array, ids: np.ndarray, bounds: np.ndarray, between: bytes) -> list[bytes]:
        """What the table has for the ids of each document, in one piece."""
        taken = table.take(pa.array(ids.astype(np.int64)))
        return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), taken), pa.scalar(between, pa.large_binary())).to_pylist()

    def encode(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]


_codecs: dict[str, Codec] = {}


def codec(text: str) -> Codec:
    """One codec for each tokenizer and process."""
    key = hashlib.sha256(text.encode()).hexdigest()
    if key not in _codecs:
        _codecs[key] = Codec(text)
    return _codecs[key]


def _coded(own: Codec, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Bounds of each text's words, their codes, distinct words."""
    bounds, flat = [0], []
    for text in part.column("text").to_pylist():
        flat += own.words(text or "")
        bounds.append(len(flat))
    coded = pa.array(flat, pa.string()).dictionary_encode()
    return np.array(bounds), coded.indices.to_numpy(), coded.dictionary


def _shut(plain: bytes) -> bytes:
    """Compressed, behind its length."""
    return len(plain).to_bytes(8, "little") + pa.Codec("zstd", 3).compress(plain, asbytes=True)


def _opened(blob: bytes) -> bytes:
    return pa.Codec("zstd").decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)


def _coded_whole(own: Codec, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """_coded, a few MB of text at a time, so that few words exist one by one."""
    bounds, chunks = [np.zeros(1, np.int64)], []
    for some in slices(part, "text"):
        at, codes, distinct = _coded(own, some)
        bounds.append(at[1:] + bounds[-1][-1])
        chunks.append(pa.DictionaryArray.from_arrays(pa.array(codes, pa.int32()), distinct))
    one = pa.chunked_array(chunks).unify_dictionaries()
    return np.concatenate(bounds), np.concatenate([c.indices.to_numpy() for c in one.chunks]), one.chunk(0).dictionary


def _squeezed(values: np.ndarray) -> bytes:
    """Numbers from 0, compressed, of one byte each below 255, three below 65,790, else
    eleven."""
    low, mid = np.minimum(values, 255).astype(np.uint8), values[values >= 255] - 255
    far = mid[mid >= 65535] - 65535
    near = np.minimum(mid, 65535).astype(np.uint16)
    # like bytes side by side, as they compress best
    return _shut(np.array([len(low), len(mid)], np.int64).tobytes() + low.tobytes() + near.astype(np.uint8).tobytes() + (near >> 8).astype(np.uint8).tobytes() + far.astype(np.int64).tobytes())


def _widened(blob: bytes) -> np.ndarray:
    blob = _opened(blob)
    n, m = np.frombuffer(blob, np.int64, 2)
    out = np.frombuffer(blob, np.uint8, n, 16).astype(np.int64)
    mid = np.frombuffer(blob, np.uint8, m, 16 + n).astype(np.int64) | np.frombuffer(blob, np.uint8, m, 16 + n + m).astype(np.int64) << 8
    mid[mid == 65535] += np.frombuffer(blob, np.int64, -1, 16 + n + 2 * m)
    out[out == 255] += mid
    return out


def _split(spec, buckets: int):
    """Rows of two kinds. Bucket -1: a slice's documents, words of each, numbers of the
    words (the more frequent in the slice, the smaller) and the bucket of each number.
    Others: the slice's distinct words of a bucket, in the order of their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(spec.value)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                bounds, codes, distinct = _coded_whole(own, part)
                order = np.argsort(-np.bincount(codes, minlength=len(distinct)), kind="stable")
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                words = distinct.take(pa.array(order))
                place = (string_hash(words) % np.uint64(buckets)).astype(np.int64) if len(words) else np.empty(0, np.int64)
                yield pa.record_batch({
                    "slice": pa.array([number], pa.int64()), "bucket": pa.array([-1], pa.int32()), "docs": pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    "a": pa.array([_squeezed(np.diff(bounds))], pa.binary()), "b": pa.array([_squeezed(rank[codes])], pa.binary()), "c": pa.array([_squeezed(place)], pa.binary()),
                })
                by = np.argsort(place, kind="stable")
                dealt, at = words.take(pa.array(by)).cast(pa.large_binary()), place[by]
                flat, ends = dealt.buffers()[2], np.frombuffer(dealt.buffers()[1], np.int64, len(by) + 1)
                starts = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(by) else np.empty(0, np.int64)
                stops = np.append(starts[1:], len(by)).astype(np.int64)
                yield pa.record_batch({
                    "slice": pa.array(np.full(len(starts), number)), "bucket": pa.array(at[starts].astype(np.int32)), "docs": pa.nulls(len(starts), pa.list_(pa.int64())),
                    "a": pa.array([_squeezed(np.diff(ends[s : e + 1])) for s, e in zip(starts, stops)], pa.binary()), "b": pa.array([_shut(bytes(flat[ends[s] : ends[e]])) for s, e in zip(starts, stops)], pa.binary()), "c": pa.nulls(len(starts), pa.binary()),
                })
                number += 1

    return run


def _encoded(spec):
    """From rows sorted by bucket: the number of ids of each word, and the ids. A word is
    encoded once for its bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(spec.value)
        known: dict[bytes, np.ndarray] = {}
        held: list[tuple[int, list[bytes]]] = []
        bucket, waiting = None, 0

        def answered() -> Iterator[pa.RecordBatch]:
            new = list(dict.fromkeys(w for _, words in held for w in words if w not in known))
            known.update(zip(new, (np.array(x, np.int64) for x in own.encode([w.decode("utf-8") for w in new]))))
            for number, words in held:
                ids = [known[w] for w in words]
                yield pa.record_batch({
                    "slice": pa.array([number], pa.int64()), "bucket": pa.array([bucket], pa.int32()), "docs": pa.nulls(1, pa.list_(pa.int64())),
                    "a": pa.array([_squeezed(np.array(list(map(len, ids)), np.int64))], pa.binary()), "b": pa.array([_shut(np.concatenate(ids).astype(own.id_type).tobytes())], pa.binary()), "c": pa.nulls(1, pa.binary()),
                })

        for batch in batches:
            for number, at, lengths, flat in zip(*(batch.column(c).to_pylist() for c in ("slice", "bucket", "a", "b"))):
                if at != bucket or waiting >= AT_ONCE:
                    yield from answered()
                    held, waiting = [], 0
                    if at != bucket:
                        known, bucket = {}, at
                ends = np.concatenate(([0], np.cumsum(_widened(lengths)))).tolist()
                flat = _opened(flat)
                held.append((number, [flat[s:e] for s, e in zip(ends[:-1], ends[1:])]))
                waiting += len(ends)
        yield from answered()

    return run


def _whole(spec, digest: bool):
    """Documents of each slice, from its rows sorted by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(spec.value)
        for table in runs_of(batches, ["slice"]):
            numbers = table.column("slice").to_numpy()
            starts = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1]))
            for s, e in zip(starts, np.append(starts[1:], len(numbers))):
                rows = table.slice(int(s), int(e - s))
                a, b = rows.column("a").to_pylist(), rows.column("b").to_pylist()
                per_doc, codes, place = _widened(a[0]), _widened(b[0]), _widened(rows.column("c")[0].as_py())
                # ids of the distinct words, bucket by bucket, and where each number's are
                lengths = np.concatenate([_widened(x) for x in a[1:]]) if len(a) > 1 else np.empty(0, np.int64)
                listed = np.frombuffer(b"".join(map(_opened, b[1:])), own.id_type)
                by = np.argsort(place, kind="stable")
                first, held = np.empty(len(by), np.int64), np.empty(len(by), np.int64)
                first[by], held[by] = np.cumsum(lengths) - lengths, lengths
                words_to = np.concatenate(([0], np.cumsum(per_doc)))
                docs = rows.column("docs").combine_chunks()[0].values
                low = 0
                while low < len(per_doc):
                    # documents of about JOINED words
                    high = max(low + 1, int(np.searchsorted(words_to, words_to[low] + JOINED, side="right")) - 1)
                    here = codes[words_to[low] : words_to[high]]
                    # joined back by position
                    many = held[here]
                    ends = np.cumsum(many)
                    ids = listed[np.repeat(first[here] - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)]
                    bounds = np.concatenate(([0], ends))[words_to[low : high + 1] - words_to[low]]
                    yield batch_of(own, docs.slice(low, high - low), ids, bounds)
                    low = high

    def batch_of(own: Codec, docs: pa.Array, ids: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
        columns = {"doc_id": docs, "n_tokens": pa.array(np.diff(bounds))}
        # the id-to-piece join
        decoded = [x.decode("utf-8", "replace") for x in own.joined(own.piece_table, ids, bounds, b"")]
        if digest:
            sha = lambda xs: pa.array([hashlib.sha256(x).hexdigest() for x in xs], pa.string())
            return pa.record_batch(columns | {"ids_sha256": sha(own.joined(own.decimals, ids, bounds, b",")), "decoded_sha256": sha(x.encode() for x in decoded)})
        return pa.record_batch(columns | {"ids": pa.array([ids[s:e].astype(np.int32) for s, e in zip(bounds[:-1], bounds[1:])], pa.list_(pa.int32())), "decoded": pa.array(decoded, pa.string())})

    return run


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """doc_id, n_tokens and ids (array<int>), decoded (string) of each row; with
    digest their SHA-256 instead: ids_sha256 of the decimal ids joined by commas,
    decoded_sha256 of the decoded text.

    Ids are those of the tokenizers library without special tokens added; the
    strings of special tokens in a text are those tokens. Null texts are empty; an
    empty text has no ids. Texts are read whole; repeated rows give repeated rows.
    Other columns are not looked at. No rows give no rows.
    """
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(Path(tokenizer_path).read_text(encoding="utf-8"))
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema, parts = "slice long, bucket int, docs array<long>, a binary, b binary, c binary", tasks(spark)
    split = cut(docs.mapInArrow(_split(spec, BUCKETS * parts), schema))
    asked = split.where("bucket >= 0").repartition(parts, "bucket").sortWithinPartitions("bucket")
    answers = asked.mapInArrow(_encoded(spec), schema)
    whole = split.where("bucket < 0").unionByName(answers).repartition(parts, "slice").sortWithinPartitions("slice", "bucket")
    if digest:
        return whole.mapInArrow(_whole(spec, True), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return whole.mapInArrow(_whole(spec, False), "doc_id long, n_tokens long, ids array<int>, decoded string")
