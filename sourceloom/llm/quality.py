"""Quality rules as a bitmask ledger.

Every rule is evaluated once. The ledger of a document holds its measurements and one
bit for each rule that fails. Policies are versioned masks over those bits, so
applying one, comparing two or finding what each rule alone removes needs no second
look at a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK

#: Marks that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Rules in the order of their bits, over the measurements of the ledger.
RULES = (
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("long_words", "word_chars > 40 * n_words"),
    ("symbols", "n_symbols > n_words"),
    ("repeated_lines", "10 * n_dup_lines > 5 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
)
#: Versioned policies: rules whose failure removes a document.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "long_words", "symbols", "repeated_lines", "short_words"),
}


def mask(rules) -> int:
    return sum(1 << i for i, (name, _) in enumerate(RULES) if name in rules)


def _repeated_words(hashes: Column) -> Column:
    """Words in windows of five that occur twice or more, from the words' hashes."""
    n = F.size(hashes)
    windows = F.transform(F.sequence(F.lit(0), n - 5), lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2), F.get(hashes, i + 3), F.get(hashes, i + 4)))
    return F.when(n >= 5, windows).otherwise(F.array().cast("array<bigint>"))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the measurements of each row of docs."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    blank = " \t\n\x0b\x0c\r"
    words = F.filter(F.split(text, rf"[{BLANK}]++"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.regexp_like(x, F.lit(rf"[^{BLANK}]")))
    first = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.length(F.translate(text, blank, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.transform(lines, lambda x: F.xxhash64(x, F.lit(1))).alias("line_hashes"),
        F.transform(words, lambda w: F.xxhash64(w)).alias("hashes"),
    )
    second = first.select(
        "doc_id", "word_chars", "n_symbols", F.size("hashes").cast("long").alias("n_words"), F.size("line_hashes").cast("long").alias("n_lines"),
        (F.size("line_hashes") - F.size(F.array_distinct("line_hashes"))).cast("long").alias("n_dup_lines"), _repeated_words(F.col("hashes")).alias("windows"),
    )
    # sorted (hash, position) only where some window repeats
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    third = second.withColumn("placed", F.when(F.size("windows") > F.size(F.array_distinct("windows")), placed)).drop("windows")
    at = lambda i: F.get(F.col("placed"), i)
    repeated = F.transform("placed", lambda x, i: F.when((F.get(F.col("placed"), i - 1)["h"] == x["h"]) | (at(i + 1)["h"] == x["h"]), x["i"]))
    starts = third.withColumn("starts", F.array_sort(F.array_compact(repeated))).drop("placed")
    spread = F.zip_with(F.col("starts"), F.slice(F.col("starts"), F.lit(2), F.greatest(F.size("starts") - 1, F.lit(0))), lambda a, b: F.least(F.coalesce(b - a, F.lit(5)), F.lit(5)))
    covered = F.aggregate(spread, F.lit(0), lambda s, x: s + x)
    return starts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.when(F.col("starts").isNotNull(), covered).otherwise(0).cast("long").alias("n_repeat_words"), "n_lines")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, measurements and failed (bit i: RULES[i] fails) of each row.

    Null texts have no words and fail few_words; null ids stay; repeated rows give
    repeated rows. Texts are read whole. Other columns are not looked at. No rows
    give no rows.
    """
    bits = [F.when(F.expr(test), F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, test) in enumerate(RULES)]
    total = bits[0]
    for b in bits[1:]:
        total = total + b
    return measured(docs, id_col, text_col).withColumn("failed", total.cast("long"))


def apply_policy(ledgers: DataFrame, version: str = "v1") -> DataFrame:
    """The ledger with base_failed and kept under a policy."""
    return ledgers.withColumn("base_failed", F.col("failed").bitwiseAND(mask(POLICIES["base"])) != 0).withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask(POLICIES["base"]) | mask(POLICIES[version]))) == 0)


def ablations(ledgers: DataFrame, version: str = "v1") -> DataFrame:
    """For each rule of a policy: rule, n_failed, n_alone (documents that only this
    rule removes, so that come back without it) and n_removed by the whole policy."""
    own = F.col("failed").bitwiseAND(mask(POLICIES[version]))
    by_mask = ledgers.groupBy(own.alias("bits")).count()
    rules = [(name, 1 << i) for i, (name, _) in enumerate(RULES) if name in POLICIES[version]]
    each = by_mask.select("*", F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).cast("long").alias("bit")) for n, b in rules])).alias("r"))
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("count")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("count")).otherwise(0)).alias("n_alone"),
        F.sum(F.when(F.col("bits") != 0, F.col("count")).otherwise(0)).alias("n_removed"),
    )
