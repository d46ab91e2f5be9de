"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and
columns with clashing names."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sourceloom.llm import bpe, common, jaccard, lines, packing, pii, quality, quotes, toxicity, urls, vectors
from sourceloom.llm.common import connected_components

LONG = ("word " * 30000 + "end\n") * 2
ROWS = [(1, "A shared line of more than twenty characters\nown one", "en", "s", 7), (2, "a SHARED line of more than twenty characters \nown two", "en", "s", 7), (3, "\tA shared line of more than twenty characters", None, None, None), (3, "\tA shared line of more than twenty characters", None, None, None), (None, "A shared line of more than twenty characters", "en", "s", 1), (4, None, "en", "s", None), (5, "", "en", "s", 0), (6, LONG, "en", "hot", 1), (7, " \n ", "en", "s", 1)]
#: Columns named like the operators' own.
CLASH = ["component_id", "n_lines", "keep_runs", "spans", "found", "score", "shard", "node", "class_id", "cluster", "grams", "turn_", "n_tokens", "label", "failed", "drops"]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    return frame.withColumns({c: F.lit("x") for c in CLASH})


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_components(spark, monkeypatch, most):
    monkeypatch.setattr(common, "ONE_TASK", most)
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (5, 5), (9, 8), (8, 7), (None, 4)] + [(100 + i, 101 + i) for i in range(40)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert {got[i] for i in (1, 2, 3)} == {1} and got[5] == 5 and {got[i] for i in (7, 8, 9)} == {7} and {got[100 + i] for i in range(41)} == {100}
    assert connected_components(edges.limit(0)).count() == 0


def test_pii(docs):
    rows = pii.find_pii(docs).collect()
    assert len(rows) == len(ROWS) and all(r.base == [] and r.spans == [] for r in rows)
    assert pii.find_pii(docs.limit(0)).count() == 0
    kept = pii.find_pii(docs, keep_text=True)
    assert set(docs.columns) <= set(kept.columns) and kept.count() == len(ROWS)


def test_quality(docs):
    got = quality.apply_policy(quality.ledger(docs))
    rows = got.collect()
    assert len(rows) == len(ROWS)
    some = by_id(got)
    assert some[4].n_words == 0 and some[4].base_failed and not some[4].kept and some[7].n_lines == 0
    assert some[6].n_words == 60002 and some[6].n_repeat_words >= 60000 and some[6].n_dup_lines == 1
    assert quality.ledger(docs.limit(0)).count() == 0
    alone = {r.rule: r for r in quality.ablations(quality.ledger(docs)).collect()}
    assert alone["few_words"].n_failed == 6 and alone["repeated_words"].n_alone == 1


def test_urls(spark):
    rows = [(1, "http://a.example.com/en/x"), (2, "https://www.EXAMPLE.com/en/"), (3, "http://k.net/es/?q"), (3, "http://k.net/es/?q"), (4, None), (5, "no url"), (6, "http://h.org/login"), (7, "http://com"), (None, "http://x.com/"), (8, "http://" + "a" * 50000 + ".org/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit("x"), "rule": F.lit("y"), "token": F.lit("z")})
    got = [(r.page_id or 0, r.rule, r.verdict) for r in urls.judge(pages).collect() if r.page_id != 8]
    want = [(1, "example.com/en/", "block"), (2, "www.example.com/en/", "allow"), (3, "net/es/", "block"), (3, "net/es/", "block"), (4, None, "allow"), (5, None, "allow"), (6, None, "block"), (7, None, "allow"), (0, "com/", "allow")]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert urls.judge(pages.limit(0)).count() == 0 and urls.judge(pages, rules=urls.BASE_RULES).count() == len(rows)


def test_url_rules_meet_few_urls(spark):
    """Hundreds of rules with several literals: their rarest one fetches a few
    candidates for a URL, and regular expressions reject some of these."""
    assert len(urls.PATTERN_RULES) > 400 and sum(len(r.literals) > 1 for r in urls.PATTERN_RULES) > 300
    rows = ["http://free-bets.example.org/en/1", "http://example.org/free/bets", "http://a.org/user/login", "http://a.org/login-of-user", "http://a.org/x?sid=4", "http://a.org/sid", "http://a.org/b.zip?x", "http://a.org/zip/code", "http://ads.org/track", "http://win.example.org/bets/free"]
    rows += [f"http://h{i}.example.org/free/{i}" for i in range(300)]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = {rows[r.page_id]: r for r in urls.judge(df, counted=True).collect()}
    assert [u for u in rows[:10] if got[u].verdict == "block"] == [rows[i] for i in (0, 2, 3, 4, 6)]
    assert any(r.n_candidates > r.n_fitting for r in got.values()) and all(r.n_candidates < 100 for r in got.values()) and all(got[u].n_candidates == 0 for u in rows[10:])
    # all rules on all URLs
    for u in rows:
        assert got[u].n_fitting == sum(bool(re.search(r.pattern, u)) for r in urls.PATTERN_RULES)


def test_url_rules_beyond_broadcast(spark):
    """More rules than are broadcast, and the other join, give the same verdicts."""
    many = urls.BASE_RULES + urls.PATTERN_RULES + tuple(urls.Rule("block", rf"/p{i}/q{i % 7}(?:/|$)", (f"p{i}", f"q{i % 7}"), on_url=True) for i in range(urls.BROADCAST_RULES))
    rows = [f"http://h{i}.example.org/p{i}/q{i % 7 + i % 2}" for i in range(400)] + ["https://www.example.com/en/", "http://k.com/login", None]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judge(df, rules=many).collect()}
    assert [got[i] for i in range(400)] == ["allow" if i % 2 else "block" for i in range(400)] and (got[400], got[401], got[402]) == ("allow", "allow", "allow")


def test_bpe(docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = bpe.encode_decode(docs, path).collect()
    assert len(rows) == len(ROWS) and all(r.decoded in {t or "" for _, t, *_ in ROWS} for r in rows)
    assert by_id(bpe.encode_decode(docs, path, digest=True))[4].n_tokens == 0
    assert bpe.encode_decode(docs.limit(0), path).count() == 0


def test_bpe_squeezes_numbers():
    for values in ([], [0], [254, 255, 256, 65789, 65790, 65791, 10**12], list(range(70000))):
        assert bpe._widened(bpe._squeezed(np.array(values, np.int64))).tolist() == values


def test_bpe_encodes_each_word_once(spark, monkeypatch):
    """A row for each slice and bucket asks; words that many slices share are encoded by
    one bucket, and repeated rows and one long text come back whole."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(bpe, "BUCKETS", 3)
    monkeypatch.setattr(bpe, "SLICE", 20_000)
    rows = [(i % 50, f"shared words and own{i} é😀 " * (1 + i % 9)) for i in range(400)] + [(60, "long text " * 200_000), (61, None), (61, None)]
    calls = spark.sparkContext.accumulator(0)
    real = bpe._encoded

    def counting(spec):
        inner = real(spec)

        def run(batches):
            own = bpe.codec(spec.value)
            encode = own.encode

            def counted(words):
                calls.add(len(words))
                return encode(words)

            own.encode = counted
            yield from inner(batches)
            del own.encode

        return run

    monkeypatch.setattr(bpe, "_encoded", counting)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sorted((r.doc_id, r.decoded, r.ids) for r in bpe.encode_decode(df, path).collect())
    t = Tokenizer.from_file(path)
    assert got == sorted((i, x or "", t.encode(x or "", add_special_tokens=False).ids) for i, x in rows)
    words = {w for _, x in rows for w, _ in t.pre_tokenizer.pre_tokenize_str(x or "")}
    assert calls.value == len(words)


def test_toxicity(spark, docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int").withColumn("text", F.lit("x"))
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model)
    assert scored.count() == len(ROWS) and all(0 <= r["__score"] <= 1 for r in scored.collect()) and set(docs.columns) <= set(scored.columns)
    empty = toxicity.fit(docs, labels.limit(0))
    assert {r["__score"] for r in toxicity.score(docs, empty).collect()} == {0.0} and toxicity.score(docs.limit(0), model).count() == 0


def test_toxicity_repeated_rows_teach_once(spark):
    rows = [(i, f"{'foul' if i % 3 == 0 else 'fair'} word {i % 7}") for i in range(1, 90)]
    once = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int")
    a, b = toxicity.fit(once, labels), toxicity.fit(once.union(once.where("doc_id < 40")).union(once.where("doc_id = 3")), labels)
    assert len(a[0]) and a[0].tolist() == b[0].tolist() and a[1].tolist() == b[1].tolist()


def test_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.9, 0.1]), (4, [0.0, 0.0]), (5, None), (6, [1.0, None]), (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, []), (None, [1.0, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [-1.0, 0.0]), (12, [1e200, 1e190])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"cluster": F.lit(1), "id": F.lit(2), "vector": F.lit(3)})
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(df).collect()]
    assert len(got) == len(rows) and (1, 4, 1, True) in got and got.count((2, 4, 1, False)) == 2 and (3, 4, 1, False) in got and (12, 4, 1, False) in got
    assert all(n == 0 for v, n, _, _ in got if v is None or 4 <= v <= 11)
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_vectors_in_a_cone_lose_no_link(spark):
    rng = np.random.default_rng(3)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    mean, away = unit(rng.standard_normal(64)), lambda n: unit(rng.standard_normal((n, 64)))
    cone = unit(2.3 * mean + away(4000))
    rows = np.concatenate([cone, unit(cone[:200] + 0.45 * away(200)), unit(rng.standard_normal((100, 64)))])
    near = rows @ rows.T >= 0.9
    np.fill_diagonal(near, False)
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows.tolist())], "vec_id long, embedding array<double>").union(spark.createDataFrame([(9000, [1.0, 0.0]), (9001, [1.0, 0.1])], "vec_id long, embedding array<double>"))
    want = {i: i for i in range(len(rows))}
    while (new := {i: min([want[i], *(want[j] for j in np.flatnonzero(near[i]))]) for i in want}) != want:
        want = new
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(df).collect()}
    assert near.sum() > 300 and got.pop(9000) == (1, 9000) and got.pop(9001) == (1, 9000)
    assert got == {i: (int(near[i].sum()), want[i]) for i in want}


def _links(rows):
    pairs = np.argwhere(np.triu(rows @ rows.T >= 0.9, 1))
    return pairs[:, 0], pairs[:, 1], np.bincount(pairs.ravel(), minlength=len(rows))


@pytest.mark.parametrize("shape", ["even", "common mean", "hot group", "hot cone"])
def test_vectors_recall(spark, tmp_path, shape):
    """Recall against brute force, counts in components exact; the hot group is larger
    than a window and a tile, and ranges of keys have borders."""
    rng = np.random.default_rng(9)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    away = lambda n: unit(rng.standard_normal((n, 64)))
    mean = away(1)
    base = {"even": away(6000), "common mean": unit(away(6000) + mean), "hot group": np.concatenate([away(4000), unit(mean + 0.3 * away(2000))]), "hot cone": np.concatenate([away(4000), unit(1.5 * mean + away(2000))])}[shape]
    at = base[rng.permutation(len(base))[:300]]
    off = away(300)
    off = unit(off - (off * at).sum(axis=1, keepdims=True) * at)
    rows = np.concatenate([base, 0.905 * at + np.sqrt(1 - 0.905**2) * off])
    x, y, degree = _links(rows)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows.tolist())], "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.component_id, r.n_links) for r in vectors.near_vectors(df).collect())
    component, links = np.array([r[1] for r in got]), np.array([r[2] for r in got])
    assert len(x) >= 300 and (component[x] == component[y]).mean() >= 0.98
    assert (links <= degree).all() and links.sum() >= 0.98 * degree.sum()
    assert (links == degree).mean() >= 0.98 and (shape != "hot group" or degree[4000:6000].min() > 2 * vectors.WINDOW)


def test_vectors_meet_across_borders(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = np.repeat(rng.standard_normal((1500, 64)), 2, axis=0) + rng.standard_normal((3000, 64)) * 0.05
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows.tolist())], "vec_id long, embedding array<double>")
    monkeypatch.setattr(vectors, "RANGE", 8)
    # so narrow that most pairs stand astride some border
    got = vectors.near_vectors(df, passes=12, window=64)
    assert got.where("n_links = 1 and component_id = vec_id - vec_id % 2").count() == 3000


def test_vectors_shells_decide_alike(spark, monkeypatch):
    rng = np.random.default_rng(4)
    line = np.array([[np.cos(t), np.sin(t)] for t in rng.uniform(0, 6.28, 1500)])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(line.tolist())], "vec_id long, embedding array<double>")
    monkeypatch.setattr(vectors, "TILE", 64)
    _, _, degree = _links(line)
    got = {r.vec_id: r.n_links for r in vectors.near_vectors(df).collect()}
    assert [got[i] for i in range(1500)] == degree.tolist()


def test_jaccard(docs):
    rows = jaccard.near_duplicates(docs).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert len(rows) == len(ROWS) and got[4] == (0, 4) and got[5] == (0, 5) and got[7] == (0, 7) and got[None] == (4, None) and got[3] == (4, 3) and got[6] == (6, 6)
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0


def test_flat_hashes_tell_strings_apart():
    rng = random.Random(3)
    strings = ["", "a", "b", "aa", "ab", "ba", "é", "日本", "a" * 300, "a" * 301] + ["".join(rng.choice("abcdef") for _ in range(rng.randrange(1, 12))) for _ in range(20000)]
    whole = common.flat_hashes(pa.array(strings, pa.large_string()))
    assert len(set(zip(strings, whole.tolist()))) == len(set(strings)) == len(set(whole.tolist()))
    # whatever stands before, and in parts of a larger buffer
    assert (common.flat_hashes(pa.array(strings[::-1], pa.large_string()))[::-1] == whole).all()
    assert (common.flat_hashes(pa.array(strings, pa.large_string()).slice(7, 500)) == whole[7:507]).all() and len(common.flat_hashes(pa.array([], pa.large_string()))) == 0


def test_overlaps_are_counts():
    rng = np.random.default_rng(6)
    for size in (2, 9, 40):
        # some columns of few sets, some of all
        sets = [np.unique(np.concatenate([rng.integers(0, 60, 20), 1000 + rng.integers(0, 4000, 30), np.arange(500, 520)])).astype(np.uint64) for _ in range(size)]
        want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
        assert (jaccard.overlaps(sets) == want).all()
        assert (jaccard.overlaps(sets[:3], sets[3:]) == want[:3, 3:]).all() if size > 3 else True


@pytest.fixture(scope="module")
def crowded(spark):
    """A large group of near copies, a chain whose ends don't link, texts that share most
    of a passage with the group but don't link, groups of few, and repeated rows."""
    base = [f"b{i}" for i in range(60)]
    rows = [(i, " ".join(base[: i % 55] + [f"x{i}"] + base[i % 55 + 1 :])) for i in range(300)]
    rows += [(1000 + i, " ".join(base[:40] + [f"o{i}w{j}" for j in range(15 + i % 20)])) for i in range(150)]
    rows += [(2000 + i, " ".join(f"c{j}" for j in range(5 * i, 5 * i + 100))) for i in range(120)]
    rows += [(3000 + i, " ".join([f"g{i // 3}w{j}" for j in range(70)] + [f"e{i}"])) for i in range(60)]
    rows += [rows[0]] * 200
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(8), dict(rows)


@pytest.mark.parametrize("tile, long_, few", [(256, 64, 16), (16, 64, 16), (16, 8, 1)])
def test_jaccard_of_large_blocks(crowded, monkeypatch, tile, long_, few):
    from .test_whole import components, shingles

    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "LONG_COLUMN", long_)
    monkeypatch.setattr(jaccard, "FEW_TILES", few)
    monkeypatch.setattr(jaccard, "HOT", 50)
    df, texts = crowded
    want = components({i: shingles(t) for i, t in texts.items()})
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(df).collect()}
    assert got == want and len({want[i] for i in range(300)}) < 40 and len({want[i] for i in range(2000, 2120)}) == 1


def test_jaccard_gives_every_link(crowded, monkeypatch):
    from .test_whole import shingles

    monkeypatch.setattr(jaccard, "TILE", 16)
    df, texts = crowded
    members, links = jaccard.jaccard_join(df, every_link=True)
    node = {r.node: r.class_id for r in members.collect()}
    got = {tuple(sorted((node[r.a], node[r.b]))) for r in links.collect()}
    sets = {i: shingles(t) for i, t in texts.items()}
    want = {(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert got == want and len(want) > 4000


def test_lines(docs):
    got = by_id(lines.dedup_lines(docs))
    assert got[1]["__kept_text"] == "own one" and got[2]["__n_dropped"] == 1 and got[3]["__kept_text"].startswith("\tA shared") and got[None]["__n_dropped"] == 0
    assert got[4]["__n_lines"] == 1 and got[4]["__kept_text"] == "" and got[6]["__kept_text"] == LONG
    assert lines.dedup_lines(docs.limit(0)).count() == 0


def test_lines_all_dropped(spark):
    df = spark.createDataFrame([(i, "the very same long line here\nthe very same long line here") for i in range(4)], "doc_id long, text string")
    got = by_id(lines.dedup_lines(df))
    assert got[0]["__kept_text"] == "" and got[0]["__n_dropped"] == 2 and got[3]["__n_dropped"] == 0


def test_packing(docs):
    rows = packing.pack(docs, capacity=1000).collect()
    total = {}
    for r in rows:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == {1: 10, 2: 10, 3: 16, None: 8, 4: 0, 5: 0, 6: 60002, 7: 0}
    assert packing.pack(docs.limit(0)).count() == 0 and packing.pack(docs, source_col=None, cluster_col="cluster", capacity=1000).count() == len(rows)


def test_packing_deals_repeated_rows_to_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 100)
    df = spark.createDataFrame([(1, "five words are in here", "s")] * 5000, "doc_id long, text string, source string").repartition(3)
    shards = [r.n for r in packing.pack(df, source_col=None, cluster_col=None).groupBy(F.split("bin_id", r"\.")[0].alias("shard")).agg(F.count("*").alias("n")).collect()]
    assert sum(shards) == 5000 and len(shards) == 50 and max(shards) < 300


def test_packing_query_keeps_its_rules(spark):
    """Every word in one piece, no bin over its capacity, no two of a source or of a group
    of near copies in a bin, and bins about as few as any packing needs."""
    from sourceloom.llm import queries

    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r for r in queries.read(spark, folder, "documents").collect()}
    group = {r.doc_id: r.component_id for r in queries.op7_jaccard(spark, folder).collect()}
    rows = queries.op9_packing(spark, folder).collect()
    bins, words = {}, {}
    for r in rows:
        words[r.doc_id] = words.get(r.doc_id, 0) + r.length
        if r.bin_id.startswith("s"):
            bins.setdefault(r.bin_id, []).append(r)
    assert words == {i: len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) for i, d in docs.items()}
    for own in bins.values():
        sources, groups = [docs[r.doc_id].source for r in own], [group[r.doc_id] for r in own]
        assert sum(r.length for r in own) <= 2048 and len(set(sources)) == len(sources) and len(set(groups)) == len(groups)
    items = [(r.length, docs[r.doc_id].source, group[r.doc_id]) for r in rows if r.bin_id.startswith("s")]
    most = max(sum(s == x for _, s, _ in items) for x in {s for _, s, _ in items})
    assert len(bins) <= 1.1 * max(most, -(-sum(n for n, _, _ in items) // 2048)) + 1


def test_best_fit_takes_the_tightest_bin():
    """Each item goes to a compatible bin of the least residual: among bins of one
    residual any may be taken, so bins are replayed by the choices made."""
    rng = np.random.default_rng(8)
    for _ in range(60):
        items = [(int(rng.integers(1, 60)), int(rng.integers(-1, 4)), int(rng.integers(-1, 6))) for _ in range(60)]
        got = packing.best_fit(items, 64)
        bins: dict = {}
        for k in sorted(range(len(items)), key=lambda i: -items[i][0]):
            n, s, c = items[k]
            own = ({("s", s)} if s >= 0 else set()) | ({("c", c)} if c >= 0 else set())
            fit = [r for r, carried in bins.values() if r >= n and not carried & own]
            left, carried = bins.get(got[k], (64, set()))
            assert left == (min(fit) if fit else 64) and not carried & own and (got[k] in bins) == bool(fit)
            bins[got[k]] = (left - n, carried | own)


def test_best_fit_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(60):
        items = [(int(rng.integers(1, 60)), int(rng.integers(-1, 4)), int(rng.integers(-1, 6))) for _ in range(40)]
        got = packing.best_fit(items, 64)
        bins: list = []
        for k in sorted(range(len(items)), key=lambda i: -items[i][0]):
            n, s, c = items[k]
            fit = [b for b in bins if b[0] >= n and not (s >= 0 and ("s", s) in b[1]) and not (c >= 0 and ("c", c) in b[1])]
            b = min(fit, key=lambda b: b[0]) if fit else None
            if b is None:
                b = [64, set()]
                bins.append(b)
            b[0] -= n
            b[1] |= {("s", s)} | {("c", c)}
        filled: dict = {}
        for (n, s, c), b in zip(items, got):
            x = filled.setdefault(b, [0, [], []])
            x[0] += n
            x[1] += [s] * (s >= 0)
            x[2] += [c] * (c >= 0)
        assert all(n <= 64 and len(set(s)) == len(s) and len(set(c)) == len(c) for n, s, c in filled.values())
        assert abs(len(filled) - len(bins)) <= 2


def test_quotes(spark):
    rows = [(1, 0, "user", "What is the plan?\n\nSecond paragraph is here."), (1, 1, "assistant", "The plan is long and has steps."), (1, 2, "user", "On Monday A wrote:\n> what is   the PLAN?\nI ask again."), (1, 3, "assistant", ">> What is the plan?\n> I ask again.\nAnswer to the second."), (1, 4, "user", "> never said by anyone at all\nstray"), (2, 0, None, None), (2, 0, None, None), (None, 1, "user", "> What is the plan?"), (3, None, "user", "x"), (4, 0, "user", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"level": F.lit(1), "path": F.lit("p"), "depth": F.lit("d")})
    out = quotes.link_quotes(df)
    got = {(r.conv_id, r.turn): r for r in out.collect()}
    assert out.count() == len(rows)
    assert got[1, 2].parent_turn == 0 and got[1, 2].text == "I ask again." and got[1, 2].n_quoted == 1
    assert got[1, 3].parent_turn == 2 and got[1, 3].thread_root == 0 and got[1, 3].depth == 2
    assert got[1, 4].parent_turn is None and got[2, 0].text == "" and got[None, 1].parent_turn is None
    assert [r.turn for r in sorted((r for k, r in got.items() if k[0] == 1), key=lambda r: (r.thread_root, r.position))] == [0, 2, 3, 1, 4]
    assert quotes.link_quotes(df.limit(0)).count() == 0


def test_quotes_deep_and_far(spark):
    deep, far = ">" * 1_000_000 + " x", 10**15
    rows = [(1, far, "first words"), (1, far + 5, "other words"), (1, far + 7, "> other words\nyes"), (1, -3, "the earliest"), (1, -2, "> the earliest\nso"), (1, 9, deep), (2, 0, "said 0")]
    n = 3000
    rows += [(2, i, f"> said {i - 1}\nsaid {i}") for i in range(1, n)] + [(3, 0, "root")] + [(3, i, f"> root\nreply {i}") for i in range(1, 9000, 3)]
    # a repeated row and one turn with two texts
    rows += [(4, 0, "one\ntwo\nthree"), (4, 1, "> two\n> three\nok"), (4, 1, "> two\n> three\nok"), (4, 1, "> one\n> two\n> three\nwell")]
    got = quotes.link_quotes(spark.createDataFrame([(c, t, "u", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")).collect()
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn): r for r in got}
    assert by[1, far + 7].parent_turn == far + 5 and by[1, far + 7].thread_root == far + 5 and by[1, -2].parent_turn == -3 and by[1, 9].n_quoted == 1
    assert all(by[2, i].depth == by[2, i].position == i and by[2, i].thread_root == 0 for i in range(n))
    assert all(by[3, i].position == (i + 2) // 3 and by[3, i].depth == 1 for i in range(1, 9000, 3))
    assert [r.parent_turn for r in got if r.conv_id == 4 and r.turn == 1] == [0, 0, 0]


def _brute_quotes(rows):
    """Parent, depth and position of each (conversation, turn), the plain way."""
    norm = lambda x: re.sub(r"\s+", " ", x).strip().lower()
    units = lambda t: [t, *re.split(r"\n\s*\n", t), *t.split("\n")]
    split = {k: [(len(re.match(r"((?:> ?)*)", x).group().replace(" ", "")), re.sub(r"^(?:> ?)+", "", x)) for x in t.split("\n")] for k, t in rows.items()}
    own = {k: "\n".join(b for n, b in x if n == 0).strip("\n") for k, x in split.items()}
    parent = {}
    for (c, t), x in split.items():
        runs = []
        for n, b in x:
            runs = [*runs[:-1], (n, runs[-1][1] + [b])] if runs and runs[-1][0] == n else [*runs, (n, [b])]
        asked = []
        for n, bodies in runs:
            if n:
                parts = re.split(r"\n\s*\n", "\n".join(bodies))
                asked += [(n, 2, "\n".join(bodies))] + [(n, 1, p) for p in parts if len(parts) > 1] + [(n, 0, b) for b in bodies]
        votes = {}
        for n, w, u in asked:
            origin = min((o for (d, o), y in own.items() if d == c and norm(u) and norm(u) in map(norm, units(y))), default=None)
            if origin is not None and origin < t:
                votes.setdefault(origin, []).append((n, w))
        if votes:
            parent[c, t] = max(votes, key=lambda o: (-min(n for n, _ in votes[o]), max(w for _, w in votes[o]), len(votes[o]), o))
    placed, seen = {}, {}

    def walk(c, t, root, depth):
        placed[c, t] = (parent.get((c, t)), root, depth, seen.setdefault((c, root), 0))
        seen[c, root] += 1
        for u in sorted(u for (d, u), p in parent.items() if (d, p) == (c, t)):
            walk(c, u, root, depth + 1)

    for c, t in rows:
        if (c, t) not in parent:
            walk(c, t, t, 0)
    return placed


def test_quotes_query_equals_brute_force(spark, tmp_path):
    from sourceloom.llm import queries

    rng = random.Random(5)
    rows = {}
    for c in range(12):
        for t in range(14):
            lines = []
            for _ in range(rng.randrange(3)):
                if rows.get((c, 0)) and t:
                    quoted = rows[c, rng.randrange(t)].split("\n")
                    a = rng.randrange(len(quoted))
                    lines += [">" * rng.choice([1, 1, 2]) + " " + x.lstrip("> ") for x in quoted[a : a + rng.randrange(1, 4)]]
            lines += [f"line {rng.randrange(30)} of {rng.randrange(3)}" if rng.random() < 0.8 else "" for _ in range(rng.randrange(1, 5))] + [f"own {t}"]
            rows[c, t] = "\n".join(lines)
    spark.createDataFrame([(c, t, "user", x) for (c, t), x in rows.items()], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {(r.conv_id, r.turn): (r.parent_turn, r.thread_root, r.depth, r.position) for r in queries.op10_quotes(spark, str(tmp_path)).collect()}
    want = _brute_quotes(rows)
    assert sum(x[0] is not None for x in want.values()) > 40 and got == want


def test_quotes_short_and_partial(spark):
    long = "The first paragraph is\nwrapped here.\n\nThe second paragraph goes on\nfor two lines.\n\nThe third one is not quoted."
    rows = [
        (1, 0, "Sure.\nLet me check."), (1, 1, "Other words."), (1, 2, "> Sure.\nThanks."),
        (2, 0, "Buy:\n- bread\n- milk\n- eggs\n- tea"), (2, 1, "ok"), (2, 2, "> - milk\n> - eggs\nHow many?"),
        (3, 0, long), (3, 1, "ok"), (3, 2, "> The first\n> paragraph is wrapped here.\n> \n> The second paragraph goes\n> on for two lines.\nYes."),
        (4, 0, "a whole\npassage"), (4, 1, "passage"), (4, 2, "> a whole passage\nx"), (5, 0, "Sure."), (5, 1, "> No.\nx"),
    ]
    df = spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): (r.parent_turn, r.text) for r in quotes.link_quotes(df).collect()}
    assert [got[c, 2] for c in (1, 2, 3, 4)] == [(0, "Thanks."), (0, "How many?"), (0, "Yes."), (0, "x")] and got[5, 1] == (None, "x")


def test_texts_of_one_id_are_kept_apart(spark):
    import corpus_pipeline

    line = "a line of more than twenty characters"
    rows = [(1, f"{line}\nown one"), (1, f"other words of one\n{line}\nmore\nyet more"), (2, line), (3, f"{line}\nx")]
    got = sorted((r.doc_id, r["__kept_text"]) for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, "other words of one\nmore\nyet more"), (1, "own one"), (2, ""), (3, f"{line}\nx")]
    copied, alone = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    docs = spark.createDataFrame([(1, copied), (2, copied + " end"), (2, alone), (3, alone + " end"), (None, copied)], "doc_id long, text string")
    kept = {(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert kept == {(1, copied), (2, alone), (None, copied)}


def test_near_duplicates_go_without_a_shuffle_of_texts(spark, tmp_path, monkeypatch):
    """Only the rows that the filter stops meet the ids that go: a filter of 64 bits stops all."""
    import corpus_pipeline

    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"{text} end{i}" if i < 40 else " ".join(f"v{i}x{k}" for k in range(40)), "s") for i in range(200)] + [(None, text, "s"), (300, None, "s"), (7, f"{text} end7", "s"), (41, f"{text} end3", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    whole = [r for r in rows if r[0] in (0, None, 300) or r[0] >= 40 and not (r[1] or "").startswith("w0")]
    for bits in (common.GONE_BITS, 64):
        monkeypatch.setattr(common, "GONE_BITS", bits)
        kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
        kept.write.parquet(path := str(tmp_path / f"{bits}"))
        assert sorted(map(repr, map(tuple, spark.read.parquet(path).collect()))) == sorted(map(repr, whole))
        # the plan keeps two ways, and the first has no exchange of texts
        ways = kept._jdf.queryExecution().optimizedPlan().toString().split("LeftAnti")
        assert len(ways) == 2 and ways[0].strip().startswith("Union")
    assert common.without(docs, docs.limit(0).select(F.col("doc_id"), F.col("doc_id")), [docs["doc_id"], docs["doc_id"]]).count() == len(rows)


def test_score_sends_a_text_once(spark):
    docs = spark.createDataFrame([(1, "a text", 2), (2, None, 3)], "doc_id long, text string, __text int")
    model = (np.array([toxicity.SLOTS]), np.array([1.0]))
    for frame, sent in ((docs, 1), (docs.withColumn("text", F.col("text").cast("binary")), 2)):
        got = toxicity.score(frame, model)
        assert got.columns == [*docs.columns, "__score"] and [r["__score"] for r in got.collect()] == pytest.approx([1 / (1 + np.exp(-1))] * 2)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.split("MapInArrow")[1].count("text#") >= sent and ("AS text#" in plan.split("MapInArrow")[1]) == (sent == 2)
    assert [r.text for r in toxicity.score(docs, model).collect()] == ["a text", None]


def test_workers_hold_little(spark):
    """What a worker keeps for its next task, and what a slice of words takes."""
    common.flat_hashes(pa.array(["x" * 1000] * 900, pa.large_string()))
    assert sum(x.nbytes for x in common._held) <= 20 << 20
    x = np.random.default_rng(1).integers(0, 1000, 5000)
    assert (common.distinct(x) == np.unique(x)).all() and len(common.distinct(x[:0])) == 0


@pytest.mark.parametrize("parts", [1, 3])
def test_postings_are_those_of_plain_sets(parts):
    """Frequent columns come last and are split, whatever the slices; copies in a batch count once."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{w}" for w in rng.integers(0, 60 if i % 3 else 2, rng.integers(1, 90))) for i in range(60)] * 2 + ["", None]
    sets = list(jaccard.shingle_sets(pa.array(texts), 5))
    grams, counts = np.unique(np.concatenate(sets[:60]), return_counts=True)
    frequent, known = grams[counts > 1], np.log2(counts[counts > 1]).astype(np.float32)
    assert len(frequent) > 10

    class Held:
        value = np.zeros(jaccard.WORD_CELLS, np.float32).tobytes()

    batch = pa.record_batch({"text": pa.array(texts)})
    out = pa.Table.from_batches(jaccard._prefixes(5, 80, frequent, known, np.full(len(frequent), parts), Held, 1000)(iter([batch])))
    got = sorted(p for r in out.to_pylist() for p in zip(*[np.frombuffer(r[k], t).tolist() for k, t in (("gram", np.uint64), ("node", np.int64), ("size", np.int32))]))
    rank = dict(zip(frequent.tolist(), np.round(8 * known).tolist()))
    plain = {jaccard._name(s): s.tolist() for s in sets if len(s)}
    assert got == sorted((g, name, len(s)) for name, s in plain.items() for g in sorted(s, key=lambda g: (rank.get(g, 0), g))[: len(s) - -(-80 * len(s) // 100) + 1])


def test_first_lines_stream_from_the_ranges(spark, monkeypatch):
    plans, cut = [], lines.cut
    monkeypatch.setattr(lines, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    df = spark.createDataFrame([(i, f"a line of more than twenty characters\nown {i}\nA line of more than twenty characters") for i in range(9)], "doc_id long, text string")
    assert {(r.doc_id, r.n_dropped) for r in lines.keep_bitmaps(df).collect()} == {(i, 2) for i in range(8)}
    ranged = [p for p in plans if "rangepartitioning" in p]
    assert len(ranged) == 1 and "Window" in ranged[0] and "hashpartitioning" not in ranged[0] and ranged[0].count("Sort [") == 1


def test_packing_keeps_near_copies_apart(spark, tmp_path):
    from sourceloom.llm import queries

    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"{text} end{i}", f"s{i}") for i in range(6)] + [(None, f"{text} END0", "s9"), (None, f"{text} x", "s10"), (20, "few words", "s11"), (21, "other words", "s12")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op9_packing(spark, str(tmp_path)).collect()
    bins = [r.bin_id for r in got if r.length > 10]
    assert len(got) == len(rows) and len(bins) == 8 == len(set(bins)) and len({r.bin_id for r in got}) == 8


def test_pii_finds_whole_identifiers(spark):
    far = "y" * 120
    rows = [(i, f"w{i} thanks. send mail to mail{i}@x.example.org now") for i in range(9)]
    rows += [(20, "please send mail to anna@intranet now"), (21, "we send mail to 555 123 4567, ok")]
    # contexts of words beyond the old windows: 3 seeds agree, 9 that only begin alike don't
    rows += [(30 + i, f"left{i} first{far} second{far} box{i}@x.example.org") for i in range(4)] + [(35, f"first{far} second{far} K-12345 end")]
    rows += [(40 + i, f"first{far}x{i} second{far} H{i}-12345 end") for i in range(9)]
    texts = dict(rows)
    got = {r.doc_id: [texts[r.doc_id][x.s : x.e] for x in r.spans] for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[20] == ["anna@intranet"] and got[21] == ["555 123 4567"] and got[35] == ["K-12345"] and all(got[40 + i] == [] for i in range(9))


@pytest.mark.parametrize("size", [1, 127, 128, 129, 5000, 70000])
def test_pii_places_are_sums(spark, size):
    lengths = [(i * 7919) % 13 for i in range(size)]
    got = spark.createDataFrame([(lengths,)], "x array<int>").select(pii._starts(F.col("x")).alias("y")).first().y
    assert got == np.concatenate(([0], np.cumsum(lengths)[:-1])).tolist()


def test_pii_long_text_of_identifiers(spark):
    """10 MB with 300,000 identifiers in one text, in time that grows with its length."""
    n = 150_000
    text = "".join(f"seen user{i}@mail{i % 7}.example.org at 10.{i % 256}.{i // 256 % 256}.7 id K-{i}\n" for i in range(n))
    start = time.perf_counter()
    got = pii.find_pii(spark.createDataFrame([(1, text), (2, "seen x@y.zz at home")], "doc_id long, text string")).select("doc_id", F.size("base").alias("n"), F.size("spans").alias("m"), F.get("base", F.lit(n - 1)).alias("last")).collect()
    took = time.perf_counter() - start
    by = {r.doc_id: r for r in got}
    want = list(re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text))[-1]
    assert by[1].n == 2 * n and by[1].m >= by[1].n and (by[1].last.s, by[1].last.e) == want.span() and by[2].n == 1 and took < 120


def test_pii_goes_on_while_patterns_are_new(spark):
    # each context is trusted by the instances which the one before has found
    sizes = (400, 40, 12, 4)
    rows = [(f"c{c}", f"i{k}.{j}", 0 if k == 0 else None) for c in (1, 2, 3) for k in (c - 1, c) for j in range(sizes[k])]
    occurring = spark.createDataFrame([(i, s, [p]) for p, i, s in rows], "instance string, seed int, patterns array<string>")
    two, whole = (pii.bootstrap(occurring, min_score=0.4, **n)[1].count() for n in ({"rounds": 2}, {}))
    assert (two, whole) == (452, 456)


def test_jaccard_columns_of_common_words_come_late():
    """Texts of word runs, as unlike as texts of one vocabulary are, spread over tasks that meet no n-gram twice:
    with the words' counts hardly any share one of their first columns."""
    rng = np.random.default_rng(7)
    pick = lambda k: rng.choice(3000, k, p=(p := 1 / np.arange(1, 3001)) / p.sum())
    texts = [" ".join(f"w{w}" for w in np.repeat(pick(8), rng.integers(8, 16))) for _ in range(1500)]
    parts = [pa.record_batch({"doc_id": pa.array([i], pa.int64()), "text": pa.array([t])}) for i, t in enumerate(texts)]
    described = [pa.Table.from_batches(jaccard._described(5, False)(iter([p]))) for p in parts]
    words = [pa.record_batch([t.column("words").drop_null().combine_chunks()], ["words"]) for t in described]
    cells = pa.Table.from_batches(jaccard._unpacked(iter(words))).group_by("key").aggregate([("count", "sum")]).rename_columns(["key", "count"])

    class Cells:
        toArrow = staticmethod(lambda: cells)

    class Held:
        def __init__(self, share):
            self.value = share.tobytes()

    def longest(share):
        none = np.empty(0, np.uint64)
        rows = pa.Table.from_batches(jaccard._prefixes(5, 80, none, np.empty(0, np.float32), none, Held(share), 4)(iter(parts)))
        grams = np.frombuffer(b"".join(rows.column("gram").to_pylist()), np.int64)
        return np.bincount(np.unique(grams, return_inverse=True)[1]).max()

    assert longest(np.zeros(jaccard.WORD_CELLS, np.float32)) > 3 * longest(jaccard._shares(Cells, 5))


def test_release_deletes_shuffles_that_nothing_needs(spark):
    tracker = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    first = spark._jsc.sc().newShuffleId() + 1
    rows = common.cut(spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count())
    assert tracker.containsShuffle(first)
    common.release(spark)
    deadline = time.time() + 5
    while tracker.containsShuffle(first) and time.time() < deadline:
        time.sleep(0.1)
    assert not tracker.containsShuffle(first) and rows.count() == 7
