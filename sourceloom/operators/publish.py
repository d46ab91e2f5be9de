"""Publishing: guides with resolved citations, fee selection and the search index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U

#: Order of delivery types.
DELIVERY = ("regular", "express", "super_express")


def guide_claims(guides: DataFrame) -> DataFrame:
    """(guide_id, pos, claim_id): distinct claims of steps, sections, variants,
    documents and fees (array<string> columns), first place first."""
    none = F.array().cast("array<string>")
    parts = [F.coalesce(F.col(c), none) for c in ("step_claims", "section_claims", "variant_claims", "document_claims", "fee_claims")]
    return guides.select("guide_id", F.posexplode(F.array_distinct(F.concat(*parts))).alias("pos", "claim_id"))


def resolve_citations(links: DataFrame, citations: DataFrame, pages: DataFrame) -> DataFrame:
    """links (guide_id, pos, claim_id) with an ordered array of citations, each with URL
    and title of its page (null where the page is missing)."""
    p = pages.select("source_page_id", F.col("canonical_url"), F.col("title").alias("page_title"), U.domain(F.col("canonical_url")).alias("domain"))
    joined = links.join(citations.withColumnRenamed("pos", "cite_pos"), "claim_id").join(p, "source_page_id", "left")
    one = F.struct("cite_pos", "canonical_url", "page_title", "domain", "quoted_text", "retrieved_at")
    return joined.groupBy("guide_id", "pos", "claim_id").agg(F.array_sort(F.collect_list(one)).alias("citations"))


def verification_summary(links: DataFrame, claims: DataFrame) -> DataFrame:
    """guide_id, total and a count for each status of resolvable claims."""
    known = links.join(claims.select("claim_id", F.coalesce("status", F.lit("unverified")).alias("status")), "claim_id")
    return known.groupBy("guide_id").agg(F.count("*").alias("total"), *[F.count_if(F.col("status") == s).alias(s) for s in ("verified", "unverified", "stale", "deprecated", "contradicted")])


def guide_sources(links: DataFrame, citations: DataFrame, pages: DataFrame) -> DataFrame:
    """guide_id, last_crawled_at (latest of the cited pages), source_domains (sorted)."""
    cited = links.join(citations.select("claim_id", "source_page_id"), "claim_id").join(pages, "source_page_id")
    return cited.groupBy("guide_id").agg(F.max("last_crawled_at").alias("last_crawled_at"), F.array_sort(F.collect_set(U.domain(F.col("canonical_url")))).alias("source_domains"))


def delivery_rank(kind: Column) -> Column:
    return F.coalesce(*[F.when(kind == d, i) for i, d in enumerate(DELIVERY)], F.lit(len(DELIVERY)))


def canonical_fees(fees: DataFrame, preferred: Column, vat: Column) -> DataFrame:
    """Of fees (key, pos, label, amount, delivery, pages, years, url, retrieved_at) one
    for each delivery, pages and years: one whose URL is preferred, of those the newest
    citation, of those the first. If any label of the key names VAT, only such labels
    count. Fees without a preferred citation are left out. Adds rank in fee order."""
    marked = fees.withColumn("vat", F.coalesce(vat, F.lit(False))).withColumn("preferred", F.coalesce(preferred, F.lit(False)))
    some = marked.groupBy("key").agg(F.max("vat").alias("any_vat"))
    kept = marked.join(some, "key").where((~F.col("any_vat") | F.col("vat")) & F.col("preferred"))
    rest = [c for c in fees.columns if c not in ("key", "delivery", "pages", "years")]
    best = kept.groupBy("key", "delivery", "pages", "years").agg(F.max_by(F.struct(*rest), F.struct("retrieved_at", -F.col("pos"))).alias("x")).select("key", "delivery", "pages", "years", "x.*")
    order = Window.partitionBy("key").orderBy(F.coalesce("pages", F.lit(0)), F.coalesce("years", F.lit(0)), delivery_rank(F.col("delivery")), "pos")
    return best.withColumn("rank", F.row_number().over(order))


def index_entries(guides: DataFrame) -> DataFrame:
    """guide_id, title, keywords, step_count, status from guides (guide_id, title,
    step_titles, agency_name, status)."""
    return guides.select("guide_id", "title", T.keywords(F.col("title"), F.array_join("step_titles", " "), F.col("agency_name")).alias("keywords"), F.size("step_titles").alias("step_count"), "status")


def totals(guides: DataFrame) -> DataFrame:
    """One row over guides (step_count, citation_count, source_domains)."""
    each = guides.select("step_count", "citation_count", F.explode_outer(F.concat(F.array(F.lit(None).cast("string")), F.coalesce("source_domains", F.array().cast("array<string>")))).alias("domain"))
    # the row without a domain stands for the guide
    one = lambda c: F.sum(F.when(F.col("domain").isNull(), c))
    return each.agg(F.coalesce(one(F.lit(1)), F.lit(0)).cast("long").alias("guides"), one(F.col("step_count")).alias("steps"), one(F.col("citation_count")).alias("citations"), F.count_distinct("domain").alias("domains"))


def published(guides: DataFrame, claims: DataFrame, citations: DataFrame, pages: DataFrame, agencies: DataFrame) -> DataFrame:
    """One row for each guide: resolved claims in order, meta, agency name."""
    links = guide_claims(guides)
    resolved = resolve_citations(links, citations, pages)
    texts = links.join(claims.select("claim_id", "text", "claim_type", "status"), "claim_id").join(resolved, ["guide_id", "pos", "claim_id"], "left")
    items = texts.groupBy("guide_id").agg(F.array_sort(F.collect_list(F.struct("pos", "claim_type", "text", "status", "citations"))).alias("items"))
    counts = links.groupBy("guide_id").agg(F.count("*").alias("citation_count"))
    return (
        guides.select("guide_id", "service_id", "agency_id", "title").join(agencies.select("agency_id", F.col("name").alias("agency_name")), "agency_id", "left")
        .join(items, "guide_id", "left").join(counts, "guide_id", "left").join(verification_summary(links, claims), "guide_id", "left").join(guide_sources(links, citations, pages), "guide_id", "left")
    )
