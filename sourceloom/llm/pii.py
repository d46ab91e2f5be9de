"""Personal data by bootstrapped contextual extraction.

Base entities (e-mail, IP, card, phone) are seeds. The words around seeds become
lexical patterns; a graph joins patterns with the identifier-like tokens in their
slots. Scores move over that graph until nothing new is found: a pattern is as good as the share
of known instances among all its instances, an instance as good as its patterns.
Tokens which high-confidence patterns discover are added to the base spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANK, cut, text_hash

KINDS = ("email", "ip", "card", "phone")
#: Each finds what the plain pattern finds, but starts once in a run of characters
#: and never takes a character back, so that long texts take linear time.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])(?=(?:[0-9][\x20-]?+){15}[0-9])[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without it has no match.
NEEDED = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: A token with a digit or an @.
TOKEN = rf"(?<![^{BLANK}])[^{BLANK}0-9@]*+[0-9@][^{BLANK}]*+"

#: Groups of digits on one line, a blank between each two.
GROUPS = rf"(?<![^{BLANK}])[+(]*+[0-9][0-9().-]*+(?:[\x20\t][(]?+[0-9][0-9().-]*+(?=[,;:!?]*+(?![^{BLANK}])))++[,;:!?]*+"

MIN_SUPPORT, MIN_CONFIDENCE, MIN_SCORE = 3, 0.5, 0.7


#: Array elements that are added up at once; no array grows by more than this.
CHUNK = 128


def _bound(value: Column, use) -> Column:
    """use(value), with value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _starts(lengths: Column, levels: int = 3) -> Column:
    """Sum of all lengths before each. Chunk by chunk, for an array that grows element by
    element takes the square of its length; chunk sums are added up alike, in levels."""
    none = F.array().cast("array<int>")

    def step(state, x):
        return F.struct((state["p"] + x).alias("p"), F.concat(state["a"], F.array(state["p"])).alias("a"))

    def whole(xs, start):
        return F.aggregate(xs, F.struct(start.alias("p"), none.alias("a")), step)["a"]

    if not levels:
        return whole(lengths, F.lit(0))

    def chunked(xs):
        chunks = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / CHUNK).cast("int"))
        part = lambda i: F.slice(xs, i * CHUNK + 1, F.lit(CHUNK))
        sums = F.transform(chunks, lambda i: F.aggregate(part(i), F.lit(0), lambda s, x: s + x))
        return _bound(_starts(sums, levels - 1), lambda offsets: F.flatten(F.transform(chunks, lambda i: whole(part(i), F.get(offsets, i)))))

    return _bound(lengths, lambda xs: F.when(F.size(xs) == 0, none).when(F.size(xs) <= CHUNK, whole(xs, F.lit(0))).otherwise(chunked(xs)))


def _placed(text: Column, pattern: str) -> Column:
    """array<struct<s,e,t>> of all matches, in code points, end exclusive."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    none = F.array().cast("array<struct<s:int,e:int,t:string>>")
    pairs = F.filter(F.arrays_zip(hits.alias("t"), gaps.alias("gap")), lambda x: x["t"].isNotNull())

    def at(xs):
        starts = _starts(F.transform(xs, lambda x: x["gap"] + F.length(x["t"])))
        return F.zip_with(xs, starts, lambda x, p: F.struct((p + x["gap"]).alias("s"), (p + x["gap"] + F.length(x["t"])).alias("e"), x["t"].alias("t")))

    return F.when(F.regexp_like(text, F.lit(pattern)), _bound(pairs, at)).otherwise(none)


def _in_context(text: Column, pattern: str, joined: bool) -> Column:
    """array<struct<s,e,t,l2,l1,r1,joined>> of all matches: the two words before (^ before
    the first) and the word after ($ after the last), lower-cased. pattern matches
    whole words."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<s:int,e:int,t:string,l2:string,l1:string,r1:string,joined:boolean>>")
    words = lambda x: F.filter(F.split(F.lower(x), rf"[{BLANK}]++"), lambda w: w != "")
    # of each gap its length, its last two words and its first
    ends = F.transform(gaps, lambda g: F.struct(F.length(g).alias("gap"), words(g).alias("w")))
    brief = F.transform(ends, lambda x: F.struct(x["gap"].alias("gap"), F.when(F.size(x["w"]) > 2, F.slice(x["w"], -2, 2)).otherwise(x["w"]).alias("last"), F.get(x["w"], F.lit(0)).alias("first")))
    pairs = F.arrays_zip(hits.alias("t"), brief.alias("g"))  # one gap more than matches

    def at(xs):
        starts = _starts(F.transform(xs, lambda x: x["g"]["gap"] + F.length(F.coalesce(x["t"], F.lit("")))))
        word = lambda x: F.lower(x["t"])

        def found(x, i, p):
            before, earlier, after = F.get(xs, i - 1), F.get(xs, i - 2), F.get(xs, i + 1)
            left = F.concat(
                F.array(F.lit("^"), F.coalesce(word(earlier), F.lit("^"))), F.coalesce(before["g"]["last"], F.array().cast("array<string>")), F.when(before["t"].isNotNull(), F.array(word(before))).otherwise(F.array().cast("array<string>")), x["g"]["last"]
            )
            s = p + x["g"]["gap"]
            r1 = F.coalesce(after["g"]["first"], F.regexp_extract(word(after), rf"[^{BLANK}]++", 0), F.lit("$"))
            return F.struct(s.alias("s"), (s + F.length(x["t"])).alias("e"), x["t"].alias("t"), F.element_at(left, -2).alias("l2"), F.element_at(left, -1).alias("l1"), r1.alias("r1"), F.lit(joined).alias("joined"))

        all_ = _bound(starts, lambda ps: F.transform(xs, lambda x, i: found(x, i, F.get(ps, i))))
        return F.filter(all_, lambda x: x["t"].isNotNull())

    return F.when(F.regexp_like(text, F.lit(pattern)), _bound(pairs, at)).otherwise(none)


def _luhn(digits: Column) -> Column:
    def add(total, i):
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _passes(kind: str, t: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(t, r"\."), lambda x: F.when(F.length(F.ltrim(x, F.lit("0"))) > 3, F.lit(False)).otherwise(F.coalesce(F.when(F.ltrim(x, F.lit("0")) == "", F.lit(0)).otherwise(F.ltrim(x, F.lit("0")).cast("int")), F.lit(0)) <= 255))
    digits = F.regexp_replace(t, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _kept(placed: Column, kind: str, k: int) -> Column:
    good = F.filter(placed, lambda x: _passes(kind, x["t"]))
    return F.transform(good, lambda x: F.struct(F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e")))


def base_spans(text: Column) -> Column:
    """array<struct<k,s,e>> of the base entities, by kind (its place in KINDS), then
    start. Null is the empty text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    none = F.array().cast("array<struct<k:int,s:int,e:int>>")
    found = []
    for k, kind in enumerate(KINDS):
        own = _kept(_placed(text, PATTERNS[kind]), kind, k)
        found.append(F.when(F.contains(text, F.lit(NEEDED[kind])), own).otherwise(none) if NEEDED[kind] else own)
    return F.concat(*found)


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def occurrences(docs: DataFrame) -> DataFrame:
    """From (doc_id, text): each identifier-like token, and each row of digit groups as
    one, with its whole context words and, when it begins a base entity, that entity's
    kind: the first in KINDS of those that begin in it. Tokens are placed in their text
    and meet base spans in one ordered pass, so time grows with a text's length."""
    text = F.coalesce("text", F.lit(""))
    # neither filter nor plain explode on the tokens: pushed down, it would place them twice
    tokens = docs.where(F.regexp_like(text, F.lit("[0-9@]"))).select("doc_id", text_hash(F.col("text")).alias("text_hash"), text.alias("text"), F.concat(_in_context(text, TOKEN, False), _in_context(text, GROUPS, True)).alias("tokens"))
    none = F.lit(None)
    span = F.transform(base_spans(F.col("text")), lambda b: F.struct(b["s"].alias("s"), b["e"].alias("e"), b["k"].alias("k"), none.cast("string").alias("t"), none.cast("string").alias("l2"), none.cast("string").alias("l1"), none.cast("string").alias("r1"), F.array(F.lit(False), F.lit(True)).alias("joined")))
    own = F.transform("tokens", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), none.cast("int").alias("k"), x["t"].alias("t"), x["l2"].alias("l2"), x["l1"].alias("l1"), x["r1"].alias("r1"), F.array(x["joined"]).alias("joined")))
    each = tokens.select("doc_id", "text_hash", F.concat(span, own).alias("events")).select("doc_id", "text_hash", F.explode_outer("events").alias("x")).where("x is not null")
    # a row that comes again tells nothing new
    events = each.select("doc_id", "text_hash", "x.s", "x.e", "x.k", "x.t", "x.l2", "x.l1", "x.r1", F.explode("x.joined").alias("joined")).distinct()
    here = Window.partitionBy("doc_id", "text_hash", "joined").orderBy("s", F.col("t").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    is_token = F.col("t").isNotNull()
    placed = events.withColumn("reach", F.max(F.when(~is_token, F.col("e"))).over(here)).withColumn("token", F.last(F.when(is_token, F.struct("s", "e")), ignorenulls=True).over(Window.partitionBy("doc_id", "text_hash", "joined").orderBy("s", ~F.col("t").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)))
    inside = placed.where(is_token | (F.col("s") < F.col("token.e")))
    seen = inside.groupBy("doc_id", "text_hash", "joined", F.col("token.s").alias("from")).agg(
        F.max(F.when(is_token, F.struct("t", "l2", "l1", "r1"))).alias("x"), F.min("k").alias("seed"), F.max(F.when(is_token, F.coalesce(F.col("reach") > F.col("s"), F.lit(False)))).alias("under")
    )
    bare = F.regexp_replace(F.regexp_replace("x.t", r"^[^\p{L}\p{N}+]++", ""), r"[^\p{L}\p{N}]++\z", "")
    lead = F.length("x.t") - F.length(F.regexp_replace("x.t", r"^[^\p{L}\p{N}+]++", ""))
    out = seen.select("doc_id", "text_hash", "joined", "seed", "under", (F.col("from") + lead).alias("s"), bare.alias("bare"), "x.l2", "x.l1", "x.r1")
    return (
        out.where((F.col("seed").isNull() & ~F.col("under")) | (F.col("seed").isNotNull() & ~F.col("joined")))
        .where(F.col("seed").isNotNull() | ((F.length("bare") >= 5) & F.regexp_like("bare", F.lit("[0-9@]"))))
        .select("doc_id", "text_hash", "s", (F.col("s") + F.length("bare")).alias("e"), F.lower("bare").alias("instance"), "seed",
                F.array(F.concat_ws(" ", F.lit("L"), "l2", "l1"), F.concat_ws(" ", F.lit("A"), "l1", F.lit("_"), "r1")).alias("patterns"))
    )


def bootstrap(occurring: DataFrame, rounds: int | None = None, min_support: int = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_score: float = MIN_SCORE) -> tuple[DataFrame, DataFrame]:
    """(patterns: pattern, kind, confidence; instances: instance, kind, score), by
    scoring the graph of patterns and instances in rounds: as many as asked for, else
    until one names no pattern or instance that none has named before."""
    edges = cut(occurring.select("instance", "seed", F.explode("patterns").alias("pattern")).groupBy("pattern", "instance").agg(F.min("seed").alias("seed")))
    seeds = cut(edges.where("seed is not null").groupBy("instance").agg(F.min("seed").alias("kind")).withColumn("score", F.lit(1.0)))
    instances, seen, done = seeds, None, 0
    while rounds is None or done < rounds:
        told = edges.select("pattern", "instance").join(instances, "instance", "left")
        sums = told.groupBy("pattern").agg(F.count("*").alias("n"), *[F.sum(F.when(F.col("kind") == k, F.col("score")).otherwise(0.0)).alias(f"k{k}") for k in range(len(KINDS))])
        best = F.greatest(*[f"k{k}" for k in range(len(KINDS))])
        kind = F.coalesce(*[F.when(F.col(f"k{k}") == best, F.lit(k)) for k in range(len(KINDS))])
        patterns = cut(sums.select("pattern", kind.alias("kind"), (best / F.col("n")).alias("confidence"), best.alias("support")).where((F.col("support") >= min_support) & (F.col("confidence") >= min_confidence)).drop("support"))
        found = (
            edges.where("seed is null").join(patterns, "pattern").groupBy("instance")
            .agg(F.max_by("kind", F.struct("confidence", -F.col("kind"))).alias("kind"), (1 - F.exp(F.sum(F.log1p(-0.999 * F.col("confidence"))))).alias("score"))
            .where(F.col("score") >= min_score)
        )
        instances = cut(seeds.unionByName(found.join(seeds, "instance", "left_anti")))
        done += 1
        if rounds is None:
            names = patterns.select(F.concat(F.lit("p"), "pattern").alias("name"), "kind").union(instances.select(F.concat(F.lit("i"), "instance"), "kind"))
            new = cut(names if seen is None else names.join(seen, ["name", "kind"], "left_anti"))
            if not (new.limit(1).count() if seen is not None else patterns.limit(1).count()):
                break
            seen = new if seen is None else seen.union(new)
    return patterns, instances


def discover(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, text_hash, found): spans that patterns add to texts of (doc_id, text)."""
    occurring = cut(occurrences(docs))
    patterns, instances = bootstrap(occurring, **settings)
    good = (
        occurring.where("seed is null").select("doc_id", "text_hash", "s", "e", "instance", F.explode("patterns").alias("pattern"))
        .join(patterns.select("pattern"), "pattern").join(instances.select("instance", "kind"), "instance")
    )
    return cut(good.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set(F.struct(F.col("kind").cast("int").alias("k"), "s", "e"))).alias("found")))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False, **settings) -> DataFrame:
    """A row for each row of docs: doc_id, base and spans (array<struct<k,s,e>>, k an
    index of KINDS, code points, end exclusive; spans = base and what patterns add);
    with keep_text all columns of docs too, those two named __base and __spans.

    Null texts are empty and have no spans; null ids stay; repeated rows give
    repeated rows. Texts are read whole. No rows give no rows.
    """
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    extra = discover(keyed, **settings)
    text_hash = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    if keep_text:
        rows = docs.withColumns({"__base": base_spans(F.col(text_col)), "__hash": text_hash})
        side = extra.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__text_hash"), F.col("found").alias("__found"))
        joined = rows.join(side, F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__text_hash")), "left")
        return joined.withColumn("__spans", _with_found(F.col("__base"), F.col("__found"))).drop("__hash", "__id", "__text_hash", "__found")
    rows = keyed.select("doc_id", base_spans(F.col("text")).alias("base"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    side = extra.withColumnRenamed("doc_id", "id")
    joined = rows.join(side, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("text_hash")), "left")
    return joined.select("doc_id", "base", _with_found(F.col("base"), F.col("found")).alias("spans"))


def _with_found(base: Column, found: Column) -> Column:
    return F.when(found.isNull(), base).otherwise(F.array_sort(F.concat(base, found)))


def redact(text: Column, spans: Column) -> Column:
    """The text with each span, and spans that touch it, replaced by [KIND]."""
    text = F.coalesce(text, F.lit(""))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))

    def step(state, x):
        fresh = x["s"] >= state["p"]
        out = F.when(fresh, F.concat(state["o"], F.substr(text, state["p"] + 1, x["s"] - state["p"]), F.get(names, x["k"]))).otherwise(state["o"])
        return F.struct(F.greatest(state["p"], x["e"]).alias("p"), out.alias("o"))

    done = F.aggregate(ordered, F.struct(F.lit(0).alias("p"), F.lit("").alias("o")), step, lambda st: F.concat(st["o"], F.substr(text, st["p"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
