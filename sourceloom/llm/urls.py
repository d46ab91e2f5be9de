"""URL filters: pattern rules indexed by their rarest literal token.

A rule names literal tokens that every URL it matches contains. Tokens are counted
over all URLs and each rule is filed under its rarest one. The tokens of a URL fetch
candidate rules; only those run their regular expressions, which look at where the
tokens stand (host, path, parameter, file ending) and next to what.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut

#: Most rules that are sent to all tasks; more are joined by a shuffle, in which each
#: token is dealt to SALTS tasks, since some (com, https) are in a third of all URLs.
BROADCAST_RULES = 10_000
SALTS = 32


@dataclass(frozen=True)
class Rule:
    """action: allow or block. pattern: a regular expression for host and path, or,
    where on_url, for the lower-cased URL. literals: tokens of any match. Rules with a
    name are base rules: the longest name that fits decides before all others."""

    action: str
    pattern: str
    literals: tuple[str, ...]
    name: str | None = None
    on_url: bool = False


def host_rule(action: str, rule: str) -> Rule:
    """host/path: fits the host and its subdomains where the path starts alike."""
    host, _, path = rule.partition("/")
    tokens = [*re.findall("[a-z0-9]+", host), *re.findall("[a-z0-9]+(?=[^a-z0-9])", path.lower())]
    return Rule(action, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape('/' + path)}", tuple(tokens), rule)


BASE_RULES = tuple(host_rule(a, r) for a, r in (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")))

END = "(?:[^a-z0-9]|$)"
#: Words that make a host worthless side by side, in either order.
HOST_PAIRS = (
    (("casino", "bet", "bets", "betting", "poker", "slots", "jackpot", "lottery", "roulette"), ("win", "free", "bonus", "online", "live", "best", "vip", "club")),
    (("ad", "ads", "adserver", "banner", "popup"), ("track", "tracker", "click", "clicks", "serve", "pixel", "network", "sync")),
    (("spam", "link", "links", "seo", "doorway"), ("farm", "network", "exchange", "blast", "wheel")),
    (("porn", "xxx", "sex", "escort", "nude"), ("cam", "cams", "tube", "free", "live", "videos", "pics")),
    (("viagra", "cialis", "pharma", "pills", "replica"), ("cheap", "online", "store", "buy", "discount")),
)
#: Neighbours in a path: pages for members, of shops, and lists without end.
PATH_PAIRS = (
    (("account", "user", "users", "member", "members", "my", "customer", "auth"), ("login", "logout", "signin", "signup", "register", "password", "profile")),
    (("shop", "store", "order", "orders"), ("cart", "basket", "checkout", "wishlist", "payment")),
    (("calendar", "archive", "archives", "events"), ("day", "week", "month", "year")),
    (("search", "tag", "tags", "filter", "sort"), ("results", "page", "all", "list")),
)
#: Parameters that name a visit or an action, not a page.
PARAMETERS = ("sid", "sessionid", "jsessionid", "phpsessid", "token", "replytocom", "add_to_cart", "action", "print", "share", "redirect", "returnurl", "captcha")
#: Endings of files that hold no prose.
ENDINGS = ("zip", "exe", "jpg", "jpeg", "png", "gif", "webp", "svg", "mp3", "mp4", "avi", "iso", "dmg", "apk", "torrent", "css", "js", "woff")
#: Words that decide wherever they stand.
WORDS = ("login", "logout", "signin", "signup", "cart", "checkout", "casino", "porn", "xxx", "viagra", "torrent")


def _pattern_rules() -> Iterable[Rule]:
    """What the method adds: hosts, sections and kinds of pages that hold no prose.
    Patterns have nothing that engines read differently."""
    for few, others in HOST_PAIRS:
        for pair in product(few, others):
            for a, b in (pair, pair[::-1]):
                yield Rule("block", rf"^[a-z][a-z0-9+.-]*://(?:[^/?#]*[^a-z0-9/?#])?{a}[-_.]+{b}(?:[^a-z0-9]|$)", (a, b), on_url=True)
    for few, others in PATH_PAIRS:
        for a, b in product(few, others):
            yield Rule("block", rf"^[a-z][a-z0-9+.-]*://[^/?#]*/(?:[^?#]*[^a-z0-9?#])?{a}[/_-]{b}{END}", (a, b), on_url=True)
    for name in PARAMETERS:
        yield Rule("block", rf"[?&;]{name}=", tuple(name.split("_")), on_url=True)
    for name in ENDINGS:
        yield Rule("block", rf"^[a-z][a-z0-9+.-]*://[^/?#]*/[^?#]*[.]{name}(?:[?#]|$)", (name,), on_url=True)
    for word in WORDS:
        yield Rule("block", rf"(?:^|[^a-z0-9]){word}{END}", (word,), on_url=True)


PATTERN_RULES = tuple(_pattern_rules())


def host_of(url: Column) -> Column:
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(after, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rules_frame(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    """A table of the rules, read by the JVM from one literal."""
    rows = [{"id": i, "action": r.action, "pattern": r.pattern, "literals": r.literals, "name": r.name, "on_url": r.on_url} for i, r in enumerate(rules)]
    kind = "array<struct<id:int,action:string,pattern:string,literals:array<string>,name:string,on_url:boolean>>"
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), kind)).alias("r")).select("r.*")


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(url), "[^a-z0-9]+"), lambda t: t != ""))


def judge(pages: DataFrame, rules: Iterable[Rule] | DataFrame = BASE_RULES + PATTERN_RULES, id_col: str = "page_id", url_col: str = "url", counted: bool = False) -> DataFrame:
    """page_id, host, path, rule, verdict of each row; with counted n_candidates, the
    rules whose regular expression its URL met, and n_fitting, those that fit.

    rules: Rule objects, or a table with the columns of rules_frame. The longest base
    rule that fits gives rule and verdict; without one, rule is null and the verdict is
    block if some other rule blocks, else allow. A URL that is null or has no :// has an
    empty host and path and is allowed by default. Repeated rows give repeated rows; a
    URL is judged once, however often it comes. URLs are read whole, whatever their
    length. Other columns are not looked at. No rules allow all; no rows give no rows.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    table = cut(rules if isinstance(rules, DataFrame) else rules_frame(spark, rules))
    small = table.count() <= BROADCAST_RULES
    urls = rows.where(F.contains("url", F.lit("://"))).select("url").distinct()
    tokens = urls.select("url", F.explode(url_tokens(F.col("url"))).alias("token"))
    wanted = table.select("id", F.explode("literals").alias("token"))
    # how often each literal occurs, then the rarest one of each rule
    literals = wanted.select("token").distinct()
    counted_tokens = tokens.join(F.broadcast(literals) if small else literals, "token").groupBy("token").agg(F.count("*").alias("n"))
    rarest = wanted.join(counted_tokens, "token", "left").groupBy("id").agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))
    index = cut(table.join(rarest, "id").select("token", "action", "pattern", "name", "on_url"))
    if small:
        candidates = tokens.join(F.broadcast(index), "token")
    else:
        salted = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        candidates = tokens.withColumn("salt", F.pmod(F.xxhash64("url"), F.lit(SALTS)).cast("int")).join(salted, ["token", "salt"])
    subject = F.when(F.col("on_url"), F.lower("url")).otherwise(F.concat(host_of(F.col("url")), path_of(F.col("url"))))
    tried = candidates.withColumn("fits", F.regexp_like(subject, F.col("pattern")))
    rank = F.struct(F.col("name").isNotNull().alias("base"), F.coalesce(F.length("name"), F.lit(0)).alias("length"), (F.col("action") == "block").alias("block"), "name", "action")
    met = (tried if counted else tried.where("fits")).groupBy(F.col("url").alias("judged"))
    judged = cut(met.agg(F.max(F.when(F.col("fits"), rank)).alias("best"), F.count("*").alias("n_candidates"), F.count_if("fits").alias("n_fitting")))
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_candidates", "n_fitting")] if counted else []
    return rows.join(judged, F.col("url") == F.col("judged"), "left").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("best.name").alias("rule"), F.coalesce("best.action", F.lit("allow")).alias("verdict"), *counts
    )
