"""Registered queries against SQL or brute force on whole small tables."""

import glob
import hashlib
import os
import re
import zlib
from collections import defaultdict

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sourceloom.llm import pii, queries, toxicity

SMALL, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.1"
FOUND = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
BLANK = " \t\n\x0b\x0c\r"


def lower(x):
    return re.sub("[A-Z]", lambda m: m.group().lower(), x)


def base(text):
    def good(kind, t):
        digits = [int(c) for c in t if c in "0123456789"]
        if kind == "ip":
            return all(int(x) <= 255 for x in t.split("."))
        if kind == "card":
            return 16 <= len(digits) <= 19 and sum(d if i % 2 == 0 else 2 * d - 9 * (2 * d > 9) for i, d in enumerate(digits[::-1])) % 10 == 0
        return kind != "phone" or 8 <= len(digits) <= 15

    return [(k, m.start(), m.end()) for k, p in FOUND.items() for m in re.finditer(p, text) if good(k, m.group())]


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components(sets):
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in sets}


def without_lines(texts):
    key = lambda x: lower(x.strip(BLANK))
    holders = defaultdict(set)
    for i, t in texts.items():
        for x in t.split("\n"):
            holders[key(x)].add(i)
    gone = lambda i, k: len(k) >= 20 and len(holders[k]) >= 3 and max(holders[k]) != i
    return {i: "\n".join(x for x in t.split("\n") if not gone(i, key(x))) for i, t in texts.items()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for p in glob.glob(f"{SMALL}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    df = queries.QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    result = c.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert sorted(tuple(str(r[k]) for k in columns) for r in df.collect()) == sorted(tuple(str(r[names.index(k)]) for k in columns) for r in result.fetchall())


def test_pii_equals_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in queries.read(spark, SMALL, "documents").collect()}
    for r in queries.op1_pii(spark, SMALL).collect():
        spans = ",".join(f"{k}:{s}:{e}" for k, s, e in base(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest() and set(spans.split(",")) <= set(r.spans.split(","))


def test_pii_discovers_by_context(spark):
    rows = [(i, f"w{i} thanks a lot. badge id mail{i}@x.example.org ok badge id ZX-{i}99-Q ok") for i in range(6)] + [(9, "code lone 12345-A here")]
    got = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(len(got[i].base) == 1 and len(got[i].spans) == 2 for i in range(6)) and got[9].spans == []
    text = rows[0][1]
    assert text[got[0].spans[1].s : got[0].spans[1].e] == "ZX-099-Q"


def test_bpe_equals_library(spark):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text or "" for r in queries.read(spark, SMALL, "documents").collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for r in queries.op4_bpe(spark, SMALL).collect():
        ids = t.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False)))


def test_bpe_special_strings_and_scripts(spark):
    from sourceloom.llm import bpe

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    texts = ["a<|endoftext|>b  !!<|endoftext|>\n\n x'll", "漢字 ١٢ 　 y", "  lead  trail  \n", "😀 " * 50, "é" * 3000]
    got = bpe.encode_decode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path).collect()
    for r in got:
        ids = t.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == t.decode(ids, skip_special_tokens=False)


def test_toxicity_held_out(spark):
    labels = {r.doc_id: r.toxic for r in queries.read(spark, MORE, "labels").collect()}
    rows = [r for r in queries.op5_toxicity(spark, MORE).collect()]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    hits, false = sum(p and y for p, y in held), sum(p and not y for p, y in held)
    assert hits >= 0.7 * sum(y for _, y in held) and false <= 0.05 * hits + 2


def test_pipeline_equals_brute_force(spark, tmp_path):
    docs = queries.read(spark, SMALL, "documents")
    outs, frame = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frame, SMALL).write.parquet(str(tmp_path / name))
        frame = spark.read.parquet(str(tmp_path / name))
        outs[name] = frame
        if name != "packing":
            assert frame.columns == docs.columns
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}
    model = toxicity.fit(docs, queries.read(spark, SMALL, "labels"))
    clean = texts(toxicity.score(docs, model).where("__score < 0.5"))
    assert texts(outs["toxicity"]) == clean
    shorter = without_lines({i: t or "" for i, t in clean.items()})
    assert texts(outs["line_dedup"]) == shorter
    groups = components({i: shingles(t) for i, t in shorter.items()})
    kept = {i: t for i, t in shorter.items() if groups[i] == i}
    assert texts(outs["jaccard_dedup"]) == kept
    masked = texts(outs["pii"])
    assert set(masked) == set(kept)
    for i, t in kept.items():
        spans = sorted((s, e, k) for k, s, e in base(t))
        at, want = 0, ""
        for s, e, k in spans:
            if s >= at:
                want += t[at:s] + f"[{k.upper()}]"
            at = max(at, e)
        assert masked[i] == want + t[at:]
    pieces = defaultdict(int)
    for r in outs["packing"].collect():
        pieces[r.doc_id] += r.length
    assert pieces == {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in masked.items()}
    assert corpus_pipeline.run(spark, SMALL).count() == outs["packing"].count()


def test_pipeline_stages_on_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "x " * 50000, "en", "s", 1), (3, "x " * 50000, "en", "s", 1), (None, "mail a@b.co", "en", "s", 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("found", F.lit(1))
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SMALL)
            if name != "packing":
                assert out.columns == docs.columns and out.count() == frame.count()
            else:
                assert out.count() >= frame.count()
