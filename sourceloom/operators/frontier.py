"""The URL frontier: which pages of which host to visit, in which order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls as U
from ..functions.text import S, matches, trim


def ranked(urls: DataFrame, top: int = 300, url: str = "url", pos: str = "pos") -> DataFrame:
    """The first top URLs of each host: score descending, then shorter, then earlier.
    Excluded URLs and those without a host are out. Adds host, depth, score, rank.

    The limit by rank is applied within tasks before rows are exchanged, so a host
    with a large share of all URLs costs its partition top rows from each task.
    """
    scored = urls.withColumns({"host": U.domain(F.col(url)), "depth": U.depth(F.col(url)), "score": U.priority(F.col(url))})
    kept = scored.where(F.col("host").isNotNull() & (F.col("score") > U.P.EXCLUDED_SCORE))
    order = Window.partitionBy("host").orderBy(F.desc("score"), F.length(url), pos)
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def allowed(path: Column, allow: Column, disallow: Column) -> Column:
    """Robots test: any allowed prefix wins, then any disallowed one denies."""
    hit = lambda rules: F.exists(F.coalesce(rules, F.array().cast("array<string>")), lambda p: F.startswith(path, p))
    return F.when(hit(allow), True).when(hit(disallow), False).otherwise(True)


def of_seed(url: Column, seed_domain: Column) -> Column:
    """The host contains the seed's domain (www. aside), anywhere."""
    return F.coalesce(U.domain(url).contains(F.regexp_replace(seed_domain, r"^www\.", "")), F.lit(False))


def of_host(url: Column, seed_domain: Column) -> Column:
    """The host is the seed's domain or its www. form."""
    return F.coalesce((U.domain(url) == seed_domain) | (U.domain(url) == F.concat(F.lit("www."), seed_domain)), F.lit(False))


def known_tld(url: Column) -> Column:
    return F.coalesce(url.contains(".gov.bd") | url.contains(".com.bd"), F.lit(False))


def archived_excluded(url: Column) -> Column:
    """The older crawler's exclude list."""
    return matches(F.lower(url), "|".join(f"(?:{U.one_end(p)})" for p in U.P.ARCHIVED_EXCLUDE))


def archived_service_page(url: Column, content: Column | None = None) -> Column:
    """The older crawler's include list and keywords, in URL or content."""
    low = F.lower(F.concat_ws(" ", url, content if content is not None else F.lit("")))
    words = "|".join(k.replace(".", r"\.") for k in U.P.ARCHIVED_KEYWORDS)
    return matches(low, "|".join((*U.P.ARCHIVED_INCLUDE, words)))


def seeds_of(seeds: DataFrame, domains: list[str]) -> DataFrame:
    """Seeds of the asked domains, either containing the other; all if none is asked."""
    asked = F.array(*map(F.lit, domains))
    return seeds.where(F.exists(asked, lambda d: F.contains("domain", d) | F.contains(d, F.col("domain")))) if domains else seeds


def frontier(urls: DataFrame, seeds: DataFrame, max_depth: int = 4, top: int = 300) -> DataFrame:
    """URLs of (seed_domain, url, pos) that pass the host, robots and depth filters of
    their seed (domain, allow, disallow), ranked per seed."""
    rules = seeds.select(F.col("domain").alias("seed_domain"), "allow", "disallow")
    firsts = urls.groupBy("seed_domain", "url").agg(F.min("pos").alias("pos"))
    joined = firsts.join(rules, "seed_domain")
    kept = joined.where(of_seed(F.col("url"), F.col("seed_domain")) & allowed(U.path(F.col("url")), F.col("allow"), F.col("disallow")) & (U.depth(F.col("url")) <= max_depth))
    scored = kept.withColumn("score", U.priority(F.col("url"))).where(F.col("score") > U.P.EXCLUDED_SCORE)
    order = Window.partitionBy("seed_domain").orderBy(F.desc("score"), F.length("url"), "pos")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).drop("allow", "disallow")


def parse_robots(files: DataFrame, agent: str = "*", key: str = "host", text: str = "robots") -> DataFrame:
    """allow, disallow and sitemaps of each file. The last User-agent line above a
    rule decides whether it applies; Sitemap lines always do. A row for each row that has
    a text, worked out within it."""
    line = lambda x: F.struct(F.lower(trim(F.regexp_extract(x, "^([^:]*):", 1))).alias("field"), trim(F.regexp_extract(x, "^[^:]*:(.*)", 1)).alias("value"))
    every = F.filter(F.transform(F.split(text, "\n"), lambda x: line(trim(x))), lambda x: ~F.startswith(x["field"], F.lit("#")))
    parts = files.where(F.col(text).isNotNull()).select(key, every.alias("parts"))
    agents = F.array_compact(F.transform("parts", lambda x, i: F.when(x["field"] == "user-agent", F.struct(i.alias("i"), F.lower(x["value"]).alias("agent")))))
    cut = parts.select(key, "parts", agents.alias("agents"))
    end = lambda k: F.coalesce(F.get(F.col("agents"), k + 1)["i"], F.size("parts"))
    own = F.flatten(F.transform("agents", lambda a, k: F.when(a["agent"].isin("*", agent.lower()), F.slice("parts", a["i"] + 1, end(k) - a["i"])).otherwise(F.slice("parts", 1, 0))))
    ruled = cut.select(key, "parts", own.alias("own"))
    values = lambda xs, field: F.transform(F.filter(xs, lambda x: (x["field"] == field) & (x["value"] != "")), lambda x: x["value"])
    return ruled.select(key, values("own", "allow").alias("allow"), values("own", "disallow").alias("disallow"), values("parts", "sitemap").alias("sitemaps"))


def parse_sitemap(xml: Column) -> Column:
    """struct(kind: index or urls, locs). An index wins over a URL set."""
    found = lambda tag: F.transform(F.regexp_extract_all(xml, F.lit(rf"(?is)<{tag}>.*?<loc>(.*?)</loc>"), F.lit(1)), trim)
    index = found("sitemap")
    return F.when(F.size(index) > 0, F.struct(F.lit("index").alias("kind"), index.alias("locs"))).otherwise(F.struct(F.lit("urls").alias("kind"), found("url").alias("locs")))


def child_sitemaps(maps: DataFrame, key: str = "host", locs: str = "locs", most: int = 5) -> DataFrame:
    """The first children of each sitemap index."""
    return maps.withColumn(locs, F.slice(locs, 1, most))


def seed_links(markdown: Column) -> Column:
    """array<struct<label,url>> of the Public Services section, else of the whole
    page, limited to known top-level domains, icons stripped from labels."""
    section = F.regexp_extract(markdown, r"(?is)##\s*Public Services\s*\n(.*?)(?=\n##\s|\z)", 1)
    area = F.when(section != "", section).otherwise(markdown)
    raw = F.regexp_extract_all(area, F.lit(r"(?:\[(?:!\[[^\]]*\]\([^)]*\))?[^\]\[]*\])\(https?://[^)\s]+\)"), F.lit(0))
    parts = F.transform(raw, lambda x: F.struct(trim(F.regexp_replace(F.regexp_extract(x, r"(?s)^\[(.*)\]\(", 1), r"!\[[^\]]*\]\([^)]*\)", "")).alias("label"), F.regexp_extract(x, r"\((https?://[^)\s]+)\)\z", 1).alias("url")))
    return F.filter(parts, lambda p: known_tld(p["url"]))


def merge_seeds(old: DataFrame, new: DataFrame) -> DataFrame:
    """Seeds of old, and those of new whose domain no seed of old has as its domain or,
    whole or as the end of a host, within a start URL; the first of a domain counts (columns: domain, start_urls, pos)."""
    firsts = new.groupBy("domain").agg(F.min_by(F.struct(*[c for c in new.columns if c != "domain"]), "pos").alias("x")).select("domain", "x.*")
    # every run of host characters in a start URL, and each of its ends, in place of a
    # comparison of all domains with all URLs
    hosts = F.flatten(F.transform("start_urls", lambda u: F.regexp_extract_all(u, F.lit(r"[^/?#@:]+"), F.lit(0))))
    labels = lambda h: F.split(h, r"\.", -1)
    tails = F.flatten(F.transform(F.filter(hosts, lambda h: h.contains(".")), lambda h: F.transform(F.sequence(F.lit(1), F.size(labels(h))), lambda i: F.array_join(F.slice(labels(h), i, F.size(labels(h))), "."))))
    known = old.select(F.explode(F.array_distinct(F.concat(F.array("domain"), F.coalesce(tails, F.array().cast("array<string>"))))).alias("domain")).distinct()
    fresh = firsts.join(known, "domain", "left_anti")
    return old.unionByName(fresh.select(*old.columns))


def quotas(urls: DataFrame, first: int = 8, rest: int = 4, least: int = 10) -> DataFrame:
    """At most first URLs of score least or more and rest others of each host."""
    scored = urls.withColumns({"host": U.domain(F.col("url")), "score": U.priority(F.col("url"))}).withColumn("prime", F.col("score") >= least)
    order = Window.partitionBy("host", "prime").orderBy(F.desc("score"), F.length("url"), "pos")
    return scored.withColumn("n", F.row_number().over(order)).where(F.col("n") <= F.when(F.col("prime"), first).otherwise(rest)).drop("n")


def exclusions(urls: DataFrame, top: int = 5) -> DataFrame:
    """How many URLs each first matching exclude pattern drops; the top ones."""
    low = F.lower("url")
    rules = F.array(*[F.named_struct(F.lit("pattern"), F.lit(p), F.lit("test"), F.lit(U.one_end(p))) for p in U.P.EXCLUDE])
    first = F.get(F.filter(rules, lambda r: F.regexp_like(low, r["test"])), F.lit(0))["pattern"]
    return urls.select(first.alias("pattern")).where("pattern is not null").groupBy("pattern").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "pattern").limit(top)


def changed(pages: DataFrame, hashes: DataFrame) -> DataFrame:
    """Pages (source_page_id, content_hash) that are new or whose stored hash differs."""
    old = hashes.select("source_page_id", F.col("content_hash").alias("old_hash"))
    return pages.join(old, "source_page_id", "left").where(~F.col("old_hash").eqNullSafe(F.col("content_hash")))


def missing(pages: DataFrame, snapshots: DataFrame, day: Column) -> DataFrame:
    """Pages without a snapshot of the day."""
    return pages.join(snapshots.where(F.col("snapshot_date") == day).select("source_page_id"), "source_page_id", "left_anti")
