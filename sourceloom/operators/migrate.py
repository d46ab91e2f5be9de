"""Migrations: agencies, claims and guides of older knowledge bases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U

# The guide section of each claim type.
SECTIONS = {
    "step": "application_steps", "document_requirement": "required_documents", "fee": "fees", "processing_time": "processing_time", "eligibility_requirement": "eligibility",
    "portal_link": "portal_links", "portal_url": "portal_links", "service_info": "service_info", "operational_info": "service_info", "rule": "service_info",
    "condition": "service_info", "definition": "service_info", "location": "service_info", "contact_info": "service_info", "other": "service_info",
}


def section(claim_type: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in SECTIONS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, claim_type), F.lit("service_info"))


def guide_sections(claims: DataFrame) -> DataFrame:
    """service_id, section, claim_ids in step order, then position (claims: service_id,
    claim_type, claim_id, step_order, pos)."""
    rank = F.struct(F.coalesce("step_order", F.lit(2147483647)).alias("order"), "pos", "claim_id")
    grouped = claims.withColumn("section", section(F.col("claim_type"))).groupBy("service_id", "section").agg(F.array_sort(F.collect_list(rank)).alias("x"))
    return grouped.select("service_id", "section", F.transform("x", lambda r: r["claim_id"]).alias("claim_ids"))


def fee_variants(fees: DataFrame) -> DataFrame:
    """service_id, variant_id, label, fee_claim_ids in order (fees: service_id,
    delivery_type, claim_id, pos)."""
    grouped = fees.withColumn("variant_id", F.coalesce("delivery_type", F.lit("regular"))).groupBy("service_id", "variant_id").agg(F.array_sort(F.collect_list(F.struct("pos", "claim_id"))).alias("x"))
    return grouped.select("service_id", "variant_id", T.variant_label(F.col("variant_id")).alias("label"), F.transform("x", lambda r: r["claim_id"]).alias("fee_claim_ids"))


def official_links(entry_urls: Column, portal_claims: Column, entrypoints: Column, default: Column) -> Column:
    """The first list that isn't empty."""
    full = lambda a: F.when(F.size(a) > 0, a)
    return F.coalesce(full(entry_urls), full(portal_claims), full(entrypoints), F.array(default))


def agency_of_urls(urls: DataFrame, allowlists: DataFrame) -> DataFrame:
    """url, agency_id: the first agency (pos) with a domain that equals the host or is
    a suffix of it at a dot, else one made from the host. Suffixes of the host are
    joined by equality, so no URL meets all agencies."""
    hosts = urls.select("url", U.domain(F.col("url")).alias("host")).where("host is not null")
    labels = F.split("host", r"\.")
    suffixes = hosts.select("url", "host", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("suffix"))
    known = allowlists.select("agency_id", "pos", F.explode("domain_allowlist").alias("suffix")).withColumn("suffix", U.normal_domain(F.col("suffix"))).groupBy("suffix").agg(F.min_by("agency_id", "pos").alias("agency_id"), F.min("pos").alias("pos"))
    best = suffixes.join(known, "suffix").groupBy("url").agg(F.min_by("agency_id", "pos").alias("agency_id"))
    return hosts.join(best, "url", "left").select("url", F.coalesce("agency_id", U.auto_agency_id(F.col("host"))).alias("agency_id"))


def nested_urls(json: Column) -> Column:
    """Distinct http(s) URLs in string values of a JSON text, at any depth."""
    return F.array_distinct(F.regexp_extract_all(json, F.lit(r'"(https?://[^"\\\s]+)"(?!\s*:)'), F.lit(1)))


def claims_of_services(services: DataFrame) -> DataFrame:
    """Claims of an old service table (service_id, source_url, fees, steps): fee and
    step claims with ids claim.<type>.<service>.<n>, the source and its quoted text."""
    base = services.select(T.slug(F.col("service_id"), "svc").alias("service_id"), F.col("source_url"), "fees", "steps")
    name = F.translate(F.substring("service_id", 5, 1 << 30), ".", "_")
    fees = base.select("service_id", "source_url", F.posexplode("fees").alias("pos", "x")).select("service_id", "source_url", "pos", F.lit("fee").alias("claim_type"), F.coalesce("x.description", F.lit("Fee")).alias("text"), F.col("x.amount").alias("amount"), F.lit(None).cast("int").alias("step_order"), F.coalesce("x.source_text", "x.description", F.lit("Fee")).alias("quoted_text"))
    steps = base.select("service_id", "source_url", F.posexplode("steps").alias("pos", "x")).select("service_id", "source_url", "pos", F.lit("step").alias("claim_type"), F.coalesce("x.title", "x.description").alias("text"), F.lit(None).cast("double").alias("amount"), F.col("x.order").alias("step_order"), F.coalesce("x.source_text", "x.description", "x.title").alias("quoted_text"))
    return fees.unionByName(steps).select(F.concat_ws(".", F.lit("claim"), "claim_type", name, F.coalesce("step_order", F.col("pos") + 1)).alias("claim_id"), T.source_id(F.col("source_url")).alias("source_page_id"), "*")


def twins(claims: DataFrame) -> DataFrame:
    """old_id, new_id: claims with an auto_ id and the first one without that says the
    same of the same entity (claim_id, claim_type, entity_id, text, pos)."""
    keys = ["claim_type", "entity_id", "text"]
    auto = claims.where(F.col("claim_id").contains("auto_"))
    real = claims.where(~F.col("claim_id").contains("auto_")).groupBy(*keys).agg(F.min_by("claim_id", "pos").alias("new_id"))
    return auto.join(real, keys).select(F.col("claim_id").alias("old_id"), "new_id")


def rewrite_ids(guides: DataFrame, renamed: DataFrame, column: str = "claim_ids") -> DataFrame:
    """guides with ids replaced, first place only, order kept."""
    each = guides.select("guide_id", F.posexplode(column).alias("pos", "claim_id"))
    named = each.join(renamed.select(F.col("old_id").alias("claim_id"), "new_id"), "claim_id", "left")
    order = Window.partitionBy("guide_id", "claim_id").orderBy("pos")
    first = named.withColumn("n", F.row_number().over(order)).withColumn("id", F.when(F.col("n") == 1, F.coalesce("new_id", "claim_id")).otherwise(F.col("claim_id")))
    return first.groupBy("guide_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"]).alias(column))


def legacy_lines(lines: DataFrame, key: str = "page_id") -> DataFrame:
    """Processing times and eligibility lines: key, line_no, claim_type, amount, unit,
    text, n (running number of the page)."""
    time = rf"(?i)([0-9]+){T.S}*(?:working{T.S}+)?(day|week|month|hour)"
    kind = F.when(T.matches(F.col("line"), time), "processing_time").when(T.matches(F.col("line"), "(?i)eligib|qualif|must be|required to be"), "eligibility_requirement")
    found = lines.where(~F.col("is_heading")).withColumn("claim_type", kind).where("claim_type is not null")
    is_time = F.col("claim_type") == "processing_time"
    return found.select(key, "line_no", "claim_type", F.when(is_time, F.regexp_extract("line", time, 1).try_cast("int")).alias("amount"), F.when(is_time, F.lower(F.regexp_extract("line", time, 2))).alias("unit"), F.col("line").alias("text"), F.row_number().over(Window.partitionBy(key).orderBy("line_no")).alias("n"))
