"""The knowledge base: upserts, indexes, change detection, staleness and audit.

Entities are tables; citations are rows (claim_id, pos, source_page_id, ...). Nothing
is updated in place: each operator returns the next version of a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U


def first_wins(rows: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """The row of the smallest pos for each key; combines before the exchange."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.min_by(F.struct(*rest), pos).alias("x")).select(key, "x.*")


def insert_absent(old: DataFrame, new: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """old, and the first row of each key of new that old lacks (columns of old)."""
    fresh = first_wins(new, key, pos).join(old.select(key), key, "left_anti")
    return old.unionByName(fresh.select(*old.columns))


def upsert_pages(old: DataFrame, new: DataFrame, now: Column, keep_history: bool = True) -> DataFrame:
    """source_page_id, canonical_url, content_hash, previous_hash, change_log,
    last_crawled_at after new pages (source_page_id, canonical_url, content_hash) are
    merged. A changed hash moves to previous_hash and is logged. With an unchanged one
    the history stays, or goes if keep_history is off."""
    o, n = old.alias("o"), new.alias("n")
    joined = o.join(n, F.col("o.source_page_id") == F.col("n.source_page_id"), "full_outer")
    hit, known = F.col("n.source_page_id").isNotNull(), F.col("o.source_page_id").isNotNull()
    changed = hit & known & ~F.col("o.content_hash").eqNullSafe(F.col("n.content_hash"))
    none = F.array().cast("array<struct<detected_at:string,hash_before:string,hash_after:string>>")
    entry = F.array(F.struct(now.alias("detected_at"), F.col("o.content_hash").alias("hash_before"), F.col("n.content_hash").alias("hash_after")))
    wiped = hit & known & ~changed & F.lit(not keep_history)
    log = F.coalesce("o.change_log", none)
    return joined.select(
        F.coalesce("n.source_page_id", "o.source_page_id").alias("source_page_id"),
        F.coalesce("n.canonical_url", "o.canonical_url").alias("canonical_url"),
        F.coalesce("n.content_hash", "o.content_hash").alias("content_hash"),
        F.when(changed, F.col("o.content_hash")).when(wiped, None).otherwise(F.col("o.previous_hash")).alias("previous_hash"),
        F.when(changed, F.concat(log, entry)).when(wiped, none).otherwise(log).alias("change_log"),
        F.when(hit, now).otherwise(F.col("o.last_crawled_at")).alias("last_crawled_at"),
    )


def ensure_agencies(agencies: DataFrame, hosts: DataFrame) -> DataFrame:
    """agency_id, name, domain_allowlist: known agencies get the hosts that map to
    them; a host outside of the map makes an agency of its own, named by the host
    without www. and allowing the host with and without it."""
    known = F.create_map(*[F.lit(x) for pair in U.P.AGENCY_NAMES.items() for x in pair])
    made = hosts.select(F.lower("host").alias("host")).where("host is not null").distinct().withColumns({"agency_id": U.agency_id(F.col("host")), "bare": U.bare_host(F.col("host"))})
    new = made.groupBy("agency_id").agg(F.array_sort(F.collect_set("host")).alias("hosts"), F.array_sort(F.collect_set("bare")).alias("bares"), F.min("bare").alias("first")).withColumn("mapped", F.try_element_at(known, F.col("agency_id")))
    joined = agencies.join(new, "agency_id", "full_outer")
    return joined.select(
        "agency_id", F.coalesce("name", "mapped", "first").alias("name"),
        F.when(F.col("domain_allowlist").isNull(), F.array_sort(F.array_union("hosts", "bares"))).when(F.col("mapped").isNotNull(), F.array_union("domain_allowlist", "hosts")).otherwise(F.col("domain_allowlist")).alias("domain_allowlist"),
    )


# indexes ----------------------------------------------------------------------------


def index_pairs(keys: DataFrame, *references: DataFrame) -> DataFrame:
    """(key, claim_ids sorted): all keys, also those without claims; references are
    (key, claim_id)."""
    pairs = references[0].select("key", "claim_id")
    for r in references[1:]:
        pairs = pairs.unionByName(r.select("key", "claim_id"))
    grouped = pairs.groupBy("key").agg(F.array_sort(F.collect_set("claim_id")).alias("claim_ids"))
    every = keys.select("key").union(pairs.select("key")).distinct()
    return every.join(grouped, "key", "left").select("key", F.coalesce("claim_ids", F.array().cast("array<string>")).alias("claim_ids"))


def incremental_index(pairs: DataFrame, changed: DataFrame, current: DataFrame) -> DataFrame:
    """(key, claim_id) pairs after the claims of changed (claim_id) are taken out and
    put in again as current has them. Equals a full rebuild as sets."""
    kept = pairs.join(changed.select("claim_id").distinct(), "claim_id", "left_anti").select("key", "claim_id")
    again = current.join(changed.select("claim_id").distinct(), "claim_id", "left_semi").select("key", "claim_id")
    return kept.unionByName(again).distinct()


def affected_claims(changed_claims: DataFrame, citations: DataFrame, changed_pages: DataFrame) -> DataFrame:
    """claim_id of changed claims and of those that cite changed pages."""
    citing = citations.join(changed_pages.select("source_page_id").distinct(), "source_page_id", "left_semi").select("claim_id")
    return changed_claims.select("claim_id").union(citing).distinct()


# change and staleness ---------------------------------------------------------------


def normalized_hash(content: Column) -> Column:
    return F.sha2(T.normal_content(content), 256)


def changed_sources(old: DataFrame, new: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """source_page_id, pos, old_hash, new_hash of pages in both whose hashes, both
    known, differ; only limits to its source_page_id."""
    pages = new if only is None else new.join(only.select("source_page_id").distinct(), "source_page_id", "left_semi")
    was = old.select("source_page_id", F.col("content_hash").alias("old_hash"))
    return pages.select("source_page_id", "pos", F.col("content_hash").alias("new_hash")).join(was, "source_page_id").where("old_hash <> new_hash")


def invalidate(claims: DataFrame, citations: DataFrame, changed: DataFrame, now: Column) -> DataFrame:
    """claims (claim_id, status, previous_status, stale_marked_at,
    stale_due_to_source_hash, ...) with those citing changed sources stale: verified
    and unverified ones keep their status as previous_status, stale ones renew hash and
    time, others stay. The last changed source gives the hash; invalidated_by is the
    first."""
    hits = citations.select("claim_id", "source_page_id").distinct().join(changed, "source_page_id")
    by = hits.groupBy("claim_id").agg(F.max_by("new_hash", "pos").alias("__hash"), F.min_by("source_page_id", "pos").alias("__by"))
    joined = claims.join(by, "claim_id", "left")
    fresh = F.col("__hash").isNotNull() & F.col("status").isin("verified", "unverified")
    any_ = F.col("__hash").isNotNull() & F.col("status").isin("verified", "unverified", "stale")
    return joined.withColumns({
        "previous_status": F.when(fresh, F.col("status")).otherwise(F.col("previous_status")),
        "stale_marked_at": F.when(any_, now).otherwise(F.col("stale_marked_at")),
        "stale_due_to_source_hash": F.when(any_, F.col("__hash")).otherwise(F.col("stale_due_to_source_hash")),
        "invalidated_by": F.when(fresh, F.col("__by")),
        "status": F.when(any_, "stale").otherwise(F.col("status")),
    }).drop("__hash", "__by")


EVENT_TYPES = ("source_change", "claim_invalidation", "verification", "migration", "guide_update")


def audit_rows(events: DataFrame) -> DataFrame:
    """event_id, event_type, timestamp, affected entities, actor, description of events
    (event_type, timestamp, agencies, claims, documents, services, source_pages,
    actor, description)."""
    kinds = ("agencies", "claims", "documents", "services", "source_pages")
    return events.select(T.event_id(F.col("event_type"), F.col("timestamp"), {k: F.col(k) for k in kinds}).alias("event_id"), "event_type", "timestamp", F.struct(*[F.array_sort(k).alias(k) for k in kinds]).alias("affected_entities"), "actor", "description")


def invalidation_event(claims: DataFrame, changed: DataFrame, now: Column, actor: Column, per_row: int = 10_000) -> DataFrame:
    """Audit rows for all claims that invalidate() turned stale, about per_row claims
    each, dealt by their hash; none without any."""
    none = F.array().cast("array<string>")
    hit = claims.where("invalidated_by is not null").select("claim_id", "invalidated_by")
    rows = max(1, -(-hit.count() // per_row))
    part = F.pmod(F.xxhash64("claim_id"), F.lit(rows)).alias("part")
    ids = hit.groupBy(part).agg(F.array_sort(F.collect_set("claim_id")).alias("claims"), F.array_sort(F.collect_set("invalidated_by")).alias("source_pages"), F.count("*").alias("n"))
    return audit_rows(ids.select(F.lit("claim_invalidation").alias("event_type"), now.alias("timestamp"), none.alias("agencies"), "claims", none.alias("documents"), none.alias("services"), "source_pages", actor.alias("actor"), F.concat(F.col("n"), F.lit(" claims invalidated")).alias("description")))


def source_change_events(changed: DataFrame, now: Column, actor: Column) -> DataFrame:
    """An audit row for each changed source (source_page_id, old_hash, new_hash)."""
    return _event(changed, "source_change", now, actor, F.concat(F.lit("Source page content changed: "), F.col("source_page_id")), source_pages=F.array("source_page_id"))


def verification_events(claims: DataFrame, now: Column, actor: Column) -> DataFrame:
    """An audit row for each claim (claim_id, status) whose status was set."""
    return _event(claims, "verification", now, actor, F.concat(F.lit("Claim "), F.col("claim_id"), F.lit(" marked as "), F.col("status")), claims=F.array("claim_id"))


def migration_events(versions: DataFrame, now: Column, actor: Column) -> DataFrame:
    """An audit row for each migration (old_version, new_version)."""
    return _event(versions, "migration", now, actor, F.concat(F.lit("Migrated from "), F.col("old_version"), F.lit(" to "), F.col("new_version")))


def _event(rows: DataFrame, kind: str, now: Column, actor: Column, description: Column, **affected: Column) -> DataFrame:
    none = F.array().cast("array<string>")
    entities = [affected.get(k, none).alias(k) for k in ("agencies", "claims", "documents", "services", "source_pages")]
    return audit_rows(rows.select(F.lit(kind).alias("event_type"), now.alias("timestamp"), *entities, actor.alias("actor"), description.alias("description")))


def process_source_changes(old: DataFrame, new: DataFrame, claims: DataFrame, citations: DataFrame, now: Column, actor: Column, only: DataFrame | None = None, per_row: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """From pages before and after a crawl: claims with those that cite changed pages
    stale, and the audit rows of the changes and of the claims they turned stale."""
    changed = changed_sources(old, new, only)
    after = invalidate(claims, citations, changed, now)
    return after, source_change_events(changed, now, actor).unionByName(invalidation_event(after, changed, now, actor, per_row))


def by_type(log: DataFrame, kind: str) -> DataFrame:
    return log.where(F.col("event_type") == kind)


def by_entity(log: DataFrame, kind: str, entity: str) -> DataFrame:
    return log.where(F.array_contains(F.col(f"affected_entities.{kind}"), entity))


def by_time(log: DataFrame, start: str, end: str) -> DataFrame:
    return log.where(F.col("timestamp").cast("timestamp").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


def by_actor(log: DataFrame, actor: str) -> DataFrame:
    return log.where(F.col("actor") == actor)
