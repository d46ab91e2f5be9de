"""Reports over a run: extraction statistics, errors, coverage, documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def extraction_stats(pages: DataFrame, *counters: str) -> DataFrame:
    """Sums of the counters for each domain, and over all (domain null)."""
    return pages.rollup("domain").agg(F.count("*").alias("pages"), *[F.sum(c).alias(c) for c in counters])


def failure_type(name: Column) -> Column:
    """Kind of failure by the name of the error that ended a run."""
    return (
        F.when(name.endswith("UnavailableError"), "scraper_unavailable").when(name.endswith("MapError"), "map_failed").when(name.endswith("ScrapeError"), "scrape_failed")
        .when(name.endswith("DownloadNotAllowedError"), "download_blocked").otherwise("unexpected_error")
    )


def failure_stage(name: Column, message: Column) -> Column:
    kind = failure_type(name)
    return (
        F.when(kind == "scraper_unavailable", F.when(message.contains("map"), "map").otherwise("scrape")).when(kind == "map_failed", "map").when(kind == "scrape_failed", "scrape")
        .when(kind == "download_blocked", "document_download").otherwise("unknown")
    )


def failures(errors: DataFrame) -> DataFrame:
    """type, stage, n of errors (name, message)."""
    return errors.groupBy(failure_type(F.col("name")).alias("type"), failure_stage(F.col("name"), F.col("message")).alias("stage")).agg(F.count("*").alias("n"))


def first_errors(errors: DataFrame, most: int = 50) -> DataFrame:
    """The report shows the first errors only."""
    return errors.orderBy("pos").limit(most)


def document_stats(documents: DataFrame) -> DataFrame:
    return documents.groupBy("domain", "extension").agg(F.count("*").alias("n"), F.sum("file_size").alias("bytes"))


def new_documents(found: DataFrame, stored: DataFrame) -> DataFrame:
    """Documents (url, domain, content_hash, pos) whose URL isn't stored and whose
    content isn't stored for their domain; the first of each counts."""
    fresh = found.join(stored.select("url").distinct(), "url", "left_anti").join(stored.select("domain", "content_hash").distinct(), ["domain", "content_hash"], "left_anti")
    by_url = fresh.groupBy("url").agg(F.min_by(F.struct("domain", "content_hash", "pos"), "pos").alias("x")).select("url", "x.*")
    order = Window.partitionBy("domain", "content_hash").orderBy("pos", "url")
    return by_url.withColumn("n", F.row_number().over(order)).where("n = 1").drop("n")


def fee_coverage(pages: DataFrame) -> DataFrame:
    """One row: domains that have a fee page, and those whose fee pages gave fees."""
    return pages.agg(F.count_distinct(F.when(F.col("is_fee_page"), F.col("domain"))).alias("with_fee_page"), F.count_distinct(F.when(F.col("is_fee_page") & (F.col("n_fees") > 0), F.col("domain"))).alias("with_fees"))


def silent_domains(pages: DataFrame) -> DataFrame:
    """Domains whose pages made no claims."""
    return pages.groupBy("domain").agg(F.count("*").alias("pages"), F.sum("n_claims").alias("claims")).where("claims = 0")


def run_summary(domains: DataFrame, pages: DataFrame, documents: DataFrame) -> DataFrame:
    """One row over a run: domains (domain, status: crawled, failed or skipped), pages
    (outcome: kept, excluded or unchanged; counts of claims, steps, fees, faqs, links) and
    documents (fetched_via)."""
    totals = (
        domains.select(F.lit("domains_attempted").alias("what"), F.lit(1).alias("n")).unionByName(domains.select(F.concat(F.lit("domains_"), "status").alias("what"), F.lit(1).alias("n")))
        .unionByName(pages.select(F.lit("pages_total").alias("what"), F.lit(1).alias("n"))).unionByName(pages.select(F.concat(F.lit("pages_"), "outcome").alias("what"), F.lit(1).alias("n")))
        .unionByName(documents.select(F.lit("docs_downloaded").alias("what"), F.lit(1).alias("n"))).unionByName(documents.select(F.concat(F.lit("documents_fetched_via_"), "fetched_via").alias("what"), F.lit(1).alias("n")))
    )
    for c in ("claims", "steps", "fees", "faqs", "links"):
        totals = totals.unionByName(pages.select(F.lit(f"{c}_extracted").alias("what"), F.col(c).cast("int").alias("n")))
    return totals.groupBy("what").agg(F.sum("n").alias("n"))


def reasons(domains: DataFrame, status: str) -> DataFrame:
    """Why domains ended so: (reason, n)."""
    return domains.where(F.col("status") == status).groupBy("reason").agg(F.count("*").alias("n"))


def save_report(summary: DataFrame, errors: DataFrame, folder: str, day: str, run_id: str, started_at: str, completed_at: str, status: str = "completed") -> str:
    """Writes one JSON line with the run's times, its summary and its first errors under
    runs of the day, and returns the path. Both parts are bounded: the counters are
    named here, the errors limited."""
    totals = summary.agg(F.map_from_entries(F.collect_list(F.struct("what", "n"))).alias("summary"))
    first = first_errors(errors).agg(F.array_sort(F.collect_list(F.struct("pos", "message"))).alias("errors"))
    path = f"{folder}/{day}/{run_id}"
    row = totals.select(F.lit(run_id).alias("run_id"), F.lit(started_at).alias("started_at"), F.lit(completed_at).alias("completed_at"), F.lit(status).alias("status"), "summary", F.lit(1).alias("one"))
    row.join(first.withColumn("one", F.lit(1)), "one").drop("one").write.mode("errorifexists").json(path)
    return path
