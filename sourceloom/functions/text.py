"""Text expressions: Column -> Column, all inside of the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P

#: Inside of a character class: white space as web scripts see it.
SPACE = r"\t\n\x0B\f\r    -     　﻿"
#: A word boundary between ASCII word characters and others.
EDGE = r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"
BENGALI_DIGITS = "০১২৩৪৫৬৭৮৯"
S = f"[{SPACE}]"


def matches(text: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_like(text, F.lit(pattern)), F.lit(False))


#: The same white space as a list of characters.
BLANKS = "\t\n\x0b\x0c\r \xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"


def trim(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def squeeze(text: Column) -> Column:
    """White space runs become one space."""
    return F.regexp_replace(text, f"{S}+", " ")


def fingerprint(text: Column) -> Column:
    return F.lower(squeeze(trim(text)))


def joined_fingerprint(*parts: Column) -> Column:
    return fingerprint(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def number(text: Column) -> Column:
    """The leading number of a text in Latin or Bengali digits, without commas."""
    plain = F.translate(text, BENGALI_DIGITS + ",", "0123456789")
    return F.regexp_extract(trim(plain), r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)", 0).try_cast("double")


def has_bengali(text: Column) -> Column:
    return matches(text, r"[\x{0980}-\x{09FF}]")


def languages(text: Column) -> Column:
    found = F.array_compact(F.array(F.when(matches(text, "[A-Za-z]"), "en"), F.when(has_bengali(text), "bn")))
    return F.when(F.size(found) == 0, F.array(F.lit("en"))).otherwise(found)


def language(text: Column) -> Column:
    return F.when(has_bengali(text), "bn").otherwise("en")


def override_currency(text: Column, target: str = "BDT") -> Column:
    return F.regexp_replace(text, f"(?i){EDGE}TK{EDGE}", target)


def publish_currency(text: Column) -> Column:
    return F.regexp_replace(text, f"(?i){EDGE}(?:TK|Taka){EDGE}", "BDT")


def normal_content(html: Column) -> Column:
    """Content without what changes on each visit."""
    x = F.regexp_replace(html, r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}[Z+-][0-9]{2}:[0-9]{2}", "")
    x = trim(squeeze(x))
    return F.regexp_replace(F.regexp_replace(x, r'data-timestamp="[^"]*"', ""), r'data-session="[^"]*"', "")


def source_id(url: Column) -> Column:
    return F.concat(F.lit("source."), F.sha1(url))


def claim_id(kind: Column, service_key: Column, url: Column, locator: Column, print_: Column) -> Column:
    basis = F.concat_ws("\n", F.coalesce(url, F.lit("")), kind, F.coalesce(locator, F.lit("")), F.coalesce(print_, F.lit("")))
    return F.concat_ws(".", F.lit("claim"), kind, service_key, F.substring(F.sha1(basis), 1, 16))


def event_id(kind: Column, timestamp: Column, entities: dict[str, Column]) -> Column:
    """evt. and the SHA-1 of kind, time and the entities: names and ids ascending,
    kinds without ids left out."""
    pairs = []
    for name in sorted(entities):
        ids = F.array_sort(F.coalesce(entities[name], F.array().cast("array<string>")))
        pairs.append(F.when(F.size(ids) > 0, F.concat(F.lit(f'"{name}":'), F.to_json(ids))))
    text = F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*pairs)), ","), F.lit("}"))
    return F.concat(F.lit("evt."), F.sha1(F.concat_ws("|", kind, timestamp, text)))


def actor(name: Column) -> Column:
    return F.concat(F.lit("script:"), F.regexp_replace(name, "[^A-Za-z0-9_.-]", "_"))


def is_actor(x: Column) -> Column:
    return matches(x, r"^(?:system|user|script:[A-Za-z0-9_.-]+)\z")


def bare_step(line: Column) -> Column:
    """A step line without numbers, bullets and step words."""
    x = F.regexp_replace(line, rf"^[0-9]+[.):]?{S}*", "")
    x = F.regexp_replace(x, rf"^[{BENGALI_DIGITS}]+[.)।:]?{S}*", "")
    x = F.regexp_replace(x, rf"^[-•–*]{S}*", "")
    x = F.regexp_replace(x, rf"^(?:{'|'.join(P.STEP_WORDS)}){S}*[-:{SPACE}]*(?:[0-9]+|[{BENGALI_DIGITS}]+)?{S}*", "")
    return trim(x)


def step_title(text: Column) -> Column:
    first = F.regexp_extract(text, "^[^।.!?]+[।.!?]?", 0)
    return F.when(first != "", trim(first)).otherwise(F.substring(text, 1, 100))


def fee_label(line: Column, fallback: Column) -> Column:
    x = F.regexp_replace(line, rf"(?i)[0-9,{BENGALI_DIGITS}]+{S}*(?:BDT|Taka|টাকা|৳)", "")
    x = F.regexp_replace(x, rf"৳{S}*[0-9,{BENGALI_DIGITS}]+", "")
    x = F.substring(trim(squeeze(F.regexp_replace(x, r"[:\-–|]", " "))), 1, 100)
    return F.when(F.length(x) < 3, fallback).otherwise(x)


def fee_variant(text: Column) -> Column:
    tests = [F.when(matches(text, "(?i)" + "|".join(f"{EDGE}{w}{EDGE}".replace(r"\s", S) for w in words)), name) for name, words in P.FEE_VARIANTS]
    return F.coalesce(*tests)


def label_delivery(label: Column) -> Column:
    low = F.lower(label)
    return F.when(low.contains("regular"), "regular").when(low.contains("super express"), "super_express").when(low.contains("express"), "express")


def label_pages(label: Column) -> Column:
    return F.regexp_extract(F.lower(label), rf"([0-9]+){S}*page", 1).try_cast("int")


def label_years(label: Column) -> Column:
    return F.regexp_extract(F.lower(label), rf"([0-9]+){S}*year", 1).try_cast("int")


def label_amount(label: Column) -> Column:
    return F.translate(F.regexp_extract(label, "[0-9]{1,3}(?:,[0-9]{3})*", 0), ",", "").try_cast("int")


def fee_signal(text: Column) -> Column:
    low = F.lower(text)
    return F.coalesce(low.contains("৳") | low.contains("টাকা") | low.contains("bdt") | low.contains("regular") | low.contains("express"), F.lit(False))


def locator_text(kind: Column, heading_path: Column, css: Column, xpath: Column, fragment: Column, page: Column) -> Column:
    return (
        F.when(kind == "heading_path", F.array_join(heading_path, " > "))
        .when(kind == "css_selector", F.concat(F.lit("CSS: "), css))
        .when(kind == "xpath", F.concat(F.lit("XPath: "), xpath))
        .when(kind == "url_fragment", F.concat(F.lit("#"), fragment))
        .when(kind == "pdf_page", F.concat(F.lit("Page "), page.cast("string")))
    )


def slug(x: Column, prefix: str) -> Column:
    """prefix.name with lower-case letters, digits and _; dots stay behind the prefix."""
    low = F.lower(x)
    has = low.startswith(f"{prefix}.")
    body = F.when(has, F.substring(low, len(prefix) + 2, 1 << 30)).otherwise(low)
    clean = F.when(has, F.regexp_replace(body, "[^a-z0-9_.]", "_")).otherwise(F.regexp_replace(body, "[^a-z0-9_]", "_"))
    return F.concat(F.lit(f"{prefix}."), F.regexp_replace(clean, r"^_+|_+\z", ""))


def variant_label(x: Column) -> Column:
    """Words with a first capital, the rest as it was."""
    return F.array_join(F.transform(F.split(x, "_"), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), " ")


def step_order(structured: Column, claim: Column, heading_path: Column) -> Column:
    from_path = F.get(F.filter(F.transform(heading_path, lambda h: F.regexp_extract(h, rf"(?i)step{S}*([0-9]+)", 1)), lambda x: x != ""), F.lit(0))
    return F.coalesce(structured.cast("int"), F.regexp_extract(claim, r"\.([0-9]+)\z", 1).try_cast("int"), from_path.try_cast("int"))


def keywords(*texts: Column) -> Column:
    """Distinct tokens of more than two characters, first seen first."""
    words = F.split(F.lower(F.concat_ws(" ", *texts)), f"{S}+")
    return F.array_distinct(F.filter(words, lambda w: F.length(w) > 2))
