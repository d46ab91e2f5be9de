"""URL expressions: Column -> Column, without exceptions for bad input."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import patterns as P
from .text import S, matches

PARTS = r"(?is)^([a-z][a-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)"


def _part(url: Column, i: int) -> Column:
    return F.nullif(F.regexp_extract(url, PARTS, i), F.lit(""))


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def domain(url: Column) -> Column:
    """Lower-cased host, or null."""
    return F.lower(_part(url, 2))


def path(url: Column) -> Column:
    """The path, / where it is empty; null without a host."""
    return F.when(domain(url).isNotNull(), F.coalesce(_part(url, 3), F.lit("/")))


def depth(url: Column) -> Column:
    segments = F.filter(F.split(path(url), "/"), lambda s: s != "")
    return F.when(domain(url).isNull(), 999).otherwise(F.size(segments))


def normal_url(url: Column) -> Column:
    return F.when(domain(url).isNull(), url).otherwise(F.regexp_replace(F.concat(scheme(url), F.lit("://"), domain(url), path(url)), r"/\z", ""))


def override_key(url: Column) -> Column:
    p = path(url)
    return F.concat(F.regexp_replace(domain(url), r"^www\.", ""), F.when(p == "/", p).otherwise(F.regexp_replace(p, r"/+\z", "")))


def with_override(rows: DataFrame, url: str = "url") -> DataFrame:
    """rows with override: the options of pages that have some of their own, else null.
    The list is a handful of fixed values, so it is a literal map, not a join."""
    kind = "map<string,struct<only_main_content:boolean,formats:array<string>,wait_ms:int,bdt_for_tk:boolean>>"
    known = F.from_json(F.lit(json.dumps(P.OVERRIDES)), kind)
    return rows.withColumn("override", F.try_element_at(known, F.coalesce(override_key(F.col(url)), F.lit(""))))


def resolve(base: Column, ref: Column) -> Column:
    """An absolute URL for a link on a page; the link itself where the base has no host."""
    origin = F.concat(scheme(base), F.lit("://"), F.regexp_extract(base, r"(?is)^[a-z][a-z0-9+.-]*://([^/?#]*)", 1))
    folder = F.regexp_replace(path(base), r"[^/]*\z", "")
    tail = F.regexp_extract(ref, r"(?s)[?#].*\z", 0)
    body = F.regexp_replace(ref, r"(?s)[?#].*\z", "")
    whole = F.when(body.startswith("/"), body).otherwise(F.concat(folder, body))

    def step(kept, seg):
        return F.when(seg == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))).when(seg == ".", kept).otherwise(F.concat(kept, F.array(seg)))

    segments = F.split(F.substring(whole, 2, 1 << 30), "/", -1)
    clean = F.aggregate(segments, F.array().cast("array<string>"), step)
    dotted = matches(whole, r"/\.{1,2}\z")
    flat = F.concat(F.lit("/"), F.array_join(clean, "/"), F.when(dotted & (F.size(clean) > 0), "/").otherwise(""))
    relative = F.when(body == "", F.concat(origin, path(base), F.when(ref.startswith("#"), F.concat(F.regexp_extract(base, r"\?[^#]*", 0), tail)).otherwise(tail))).otherwise(F.concat(origin, flat, tail))
    return (
        F.when(matches(ref, r"(?i)^[a-z][a-z0-9+.-]*:"), ref)
        .when(domain(base).isNull(), ref)
        .when(ref.startswith("//"), F.concat(scheme(base), F.lit(":"), ref))
        .otherwise(relative)
    )


def extension(url: Column, default: str = "") -> Column:
    last = F.regexp_extract(path(url), r"([^/]*)/?\z", 1)
    ext = F.lower(F.regexp_extract(last, r"[^.](\.[^.]*)\z", 1))
    return F.when(F.coalesce(ext, F.lit("")) == "", F.lit(default)).otherwise(ext)


def mime(ext: Column) -> Column:
    low = F.lower(ext)
    dotted = F.when(low.startswith("."), low).otherwise(F.concat(F.lit("."), low))
    return F.coalesce(*[F.when(dotted == k, v) for k, v in P.MIME_TYPES.items()], F.lit("application/octet-stream"))


def is_binary(url: Column) -> Column:
    return F.coalesce(extension(url).isin(*P.BINARY_EXTENSIONS), F.lit(False))


def is_document_page(url: Column) -> Column:
    low = F.lower(url)
    return matches(low, r"\.(?:pdf|docx?|xlsx?|pptx?)(?:\?|\z)") | matches(low, "download|attachment|circular|notice|form")


def one_end(pattern: str) -> str:
    return pattern.replace("$", r"\z")


def priority(url: Column) -> Column:
    """Score of a URL: EXCLUDED_SCORE, or the weights of all patterns it has and a
    bonus for short paths. Every pattern counts once."""
    low = F.lower(url)
    excluded = matches(low, "|".join(f"(?:{one_end(p)})" for p in P.EXCLUDE))
    groups = (("very_high", P.VERY_HIGH), ("high", P.HIGH), ("medium", P.MEDIUM), ("low", P.LOW))
    points = [F.when(matches(low, one_end(p)), P.WEIGHTS[name]).otherwise(0) for name, group in groups for p in group]
    d = depth(url)
    bonus = F.when(d <= 2, 2).otherwise(0) + F.when(d == 1, 3).otherwise(0)
    return F.when(excluded, P.EXCLUDED_SCORE).otherwise(reduce(lambda a, b: a + b, points) + bonus)


def is_service_page(url: Column) -> Column:
    return priority(url) >= 10


def normal_domain(x: Column) -> Column:
    x = F.regexp_replace(F.lower(F.regexp_replace(x, rf"^{S}+|{S}+\z", "")), r"^\.+", "")
    return F.regexp_replace(F.regexp_replace(x, r"/.*\z", ""), r"\.+\z", "")


def domain_matches(host: Column, allowed: Column) -> Column:
    """Equal, or a subdomain."""
    h, a = normal_domain(host), normal_domain(allowed)
    return F.coalesce((h != "") & (a != "") & ((h == a) | h.endswith(F.concat(F.lit("."), a))), F.lit(False))


def is_valid(url: Column) -> Column:
    return F.coalesce(scheme(url).isin("http", "https") & domain(url).isNotNull(), F.lit(False))


def service_key(host: Column) -> Column:
    bare = F.regexp_replace(F.lower(host), r"^www\.", "")
    for suffix in ("gov", "com", "org"):
        bare = F.regexp_replace(bare, rf"\.{suffix}\.bd\z", "")
    return F.coalesce(F.translate(bare, ".", "_"), F.lit("unknown"))


def service_id(host: Column) -> Column:
    bare = F.regexp_replace(F.lower(host), r"^www\.", "")
    known = F.create_map(*[F.lit(x) for pair in P.SERVICES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, bare), F.concat(F.lit("svc."), service_key(host)))


def key_of_service(service: Column) -> Column:
    """The part of a service id that claim ids carry."""
    return F.coalesce(F.regexp_replace(service, r"^svc\.", ""), F.lit("unknown"))


def bare_host(host: Column) -> Column:
    return F.regexp_replace(F.lower(host), r"^www\.", "")


def agency_id(host: Column) -> Column:
    """The agency of the host, or of the host without www., or a generic one."""
    known = F.create_map(*[F.lit(x) for pair in P.AGENCIES.items() for x in pair])
    generic = F.concat(F.lit("agency."), F.regexp_replace(bare_host(host), "[^a-z0-9]", "_"))
    return F.coalesce(F.try_element_at(known, F.lower(host)), F.try_element_at(known, bare_host(host)), generic)


def auto_agency_id(host: Column) -> Column:
    return F.concat(F.lit("agency.auto_"), F.substring(F.sha1(F.regexp_replace(F.lower(host), r"^www\.", "")), 1, 12))


def page_type(url: Column) -> Column:
    low = F.lower(url)
    any_of = lambda *words: matches(low, "|".join(words))
    return (
        F.when(any_of("fee", "cost", "price"), "fee_schedule").when(any_of("instruction", "guide", "how-to"), "instruction")
        .when(any_of("form"), "form").when(any_of("notice"), "notice").when(any_of("regulation", "rule"), "regulation")
        .when(F.size(F.split(low, "/")) <= 4, "main_portal").otherwise("other")
    )


def crawl_page_type(url: Column, host: Column) -> Column:
    low = F.lower(url)
    portal = F.coalesce((low == host) | low.endswith(F.concat(host, F.lit("/"))), F.lit(False))
    return F.when(matches(low, "fee|charge"), "fee_schedule").when(matches(low, "instruction|how-to|step"), "instruction").when(matches(low, "form"), "form").when(portal, "main_portal").otherwise("other")


def page_types(url: Column, title: Column, content: Column) -> Column:
    """All page types that URL, title or content name, in their order."""
    text = F.lower(F.concat_ws(" ", url, title, content))
    found = F.array_compact(F.array(*[F.when(matches(text, p), k) for k, p in P.PAGE_TYPES.items()]))
    return F.when(F.size(found) == 0, F.array(F.lit("general"))).otherwise(found)
