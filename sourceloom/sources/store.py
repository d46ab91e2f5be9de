"""Reading and writing: knowledge base JSON, seeds, state, indexes, snapshots, files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CITATION = "struct<source_page_id:string,canonical_url:string,quoted_text:string,locator:struct<type:string,heading_path:array<string>,css_selector:string,xpath:string,url_fragment:string,pdf_page:int>,retrieved_at:string,language:string>"
KB_SCHEMA = (
    "`$schema_version` string, data_version int, last_updated_at string, updated_by string,"
    "source_pages array<struct<source_page_id:string,canonical_url:string,agency_id:string,page_type:string,title:string,language:array<string>,crawl_method:string,last_crawled_at:string,content_hash:string,previous_hash:string,snapshot_ref:string,change_log:array<struct<detected_at:string,hash_before:string,hash_after:string,notes:string>>,status:string,notes:array<string>>>,"
    f"claims array<struct<claim_id:string,entity_ref:struct<type:string,id:string>,claim_type:string,text:string,structured_data:string,citations:array<{CITATION}>,status:string,last_verified_at:string,last_verified_source_hash:string,stale_marked_at:string,stale_due_to_source_hash:string,previous_status:string,tags:array<string>,notes:array<string>>>,"
    "agencies array<struct<agency_id:string,name:string,short_name:string,website:string,domain_allowlist:array<string>,claims:array<string>>>,"
    "documents array<struct<document_id:string,document_name:string,issued_by:string,claims:array<string>,status:string,last_updated_at:string>>,"
    "services array<struct<service_id:string,service_name:string,service_family:string,agency_id:string,claims:array<string>,official_entrypoints:array<string>,status:string>>"
)
TABLES = ("source_pages", "claims", "agencies", "documents", "services")


def load_kb(spark: SparkSession, *paths: str) -> dict[str, DataFrame]:
    """The tables of the first path that exists and parses, else empty ones; kb_meta has
    the scalars. Rows carry pos, their place in the file."""
    whole = None
    for path in paths:
        try:
            read = spark.read.schema(KB_SCHEMA).option("multiLine", True).json(path)
            if read.where("data_version is not null").limit(1).count():
                whole = read
                break
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
    if whole is None:
        whole = spark.createDataFrame([], KB_SCHEMA)
    tables = {t: whole.select(F.posexplode(t).alias("pos", "x")).select("x.*", "pos") for t in TABLES}
    return tables | {"kb_meta": whole.select("$schema_version", "data_version", "last_updated_at", "updated_by")}


def save_kb(tables: dict[str, DataFrame], folder: str, version: int | None = None) -> str:
    """Each table as Parquet under a folder of its own version, which is returned; a
    version is never overwritten. Without a version, that of kb_meta and one more."""
    if version is None:
        told = tables["kb_meta"].agg(F.max("data_version")).first()[0] if "kb_meta" in tables else None
        version = (told or 0) + 1
    target = f"{folder}/v{version}"
    for name, df in tables.items():
        out = df.withColumn("data_version", F.lit(version)) if name == "kb_meta" else df
        out.write.mode("errorifexists").parquet(f"{target}/{name}")
    return target


def claim_citations(claims: DataFrame) -> DataFrame:
    return claims.select("claim_id", F.posexplode("citations").alias("pos", "c")).select("claim_id", "pos", "c.*")


SEEDS = "seeds array<struct<label:string,domain:string,start_urls:array<string>,source_page_url:string>>"
DOMAIN_STATE = "struct<lastCrawled:string,pagesCrawled:int,robotsRules:struct<disallow:array<string>,allow:array<string>,sitemaps:array<string>>,sitemapUrls:array<string>,discoveredUrls:array<string>,processedUrls:array<string>>"


def _json_or_empty(spark: SparkSession, schema: str, path: str, lines: bool = False) -> DataFrame:
    """The file as one row, or as one for each line; no row where it is missing. What
    doesn't parse is a row of nulls."""
    try:
        return spark.read.schema(schema).option("multiLine", not lines).json(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def load_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Seeds with pos; none where the file is missing or doesn't parse."""
    return _json_or_empty(spark, SEEDS, path).select(F.posexplode("seeds").alias("pos", "x")).select("x.*", "pos")


def load_state(spark: SparkSession, path: str, lines: bool = False) -> dict[str, DataFrame]:
    """domain_state, page_hash and document_hash of a crawl state file, or with lines of
    the folder that save_state wrote; empty where it is missing or doesn't parse."""
    state = _json_or_empty(spark, f"domainStates map<string,{DOMAIN_STATE}>, pageHashes map<string,string>, documentHashes map<string,string>", path, lines)
    named = lambda c, key, value: state.select(F.explode(c).alias(key, value))
    return {"domain_state": named("domainStates", "domain", "x").select("domain", "x.*"), "page_hash": named("pageHashes", "source_page_id", "content_hash"), "document_hash": named("documentHashes", "url", "content_hash")}


def save_state(state: dict[str, DataFrame], path: str, now: Column) -> None:
    """The tables of load_state as JSON lines that load_state reads: one entry a line, so
    that no task holds all of them."""
    none = F.lit(None)
    kinds = {"domainStates": f"map<string,{DOMAIN_STATE}>", "pageHashes": "map<string,string>", "documentHashes": "map<string,string>"}
    keys = {"domainStates": ("domain_state", "domain"), "pageHashes": ("page_hash", "source_page_id"), "documentHashes": ("document_hash", "url")}
    lines = None
    for kind, (table, key) in keys.items():
        rows = state[table]
        value = F.struct(*[c for c in rows.columns if c != key]) if kind == "domainStates" else F.col("content_hash")
        entry = F.create_map(F.col(key), value)
        line = rows.select(F.to_json(F.struct(*[(entry if k == kind else none.cast(t)).alias(k) for k, t in kinds.items()], now.alias("lastUpdated"))).alias("value"))
        lines = line if lines is None else lines.unionByName(line)
    lines.write.mode("errorifexists").text(path)


def load_index(spark: SparkSession, path: str) -> DataFrame:
    """(key, claim_id) pairs of an index file {key: [claim_id, ...]}."""
    text = spark.read.text(path, wholetext=True)
    parsed = text.select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("key", "ids"))
    return parsed.select("key", F.explode("ids").alias("claim_id"))


def save_index(index: DataFrame, path: str) -> None:
    index.write.mode("errorifexists").json(path)


def save_snapshots(pages: DataFrame, folder: str, day: Column) -> None:
    """Pages under the day of their snapshot, which later reads prune by."""
    pages.withColumn("snapshot_date", day).write.mode("append").partitionBy("snapshot_date").parquet(folder)


def read_files(spark: SparkSession, folder: str, most_bytes: int = 50 << 20) -> DataFrame:
    """path, content and SHA-256 of fetched files; larger ones are left out."""
    files = spark.read.format("binaryFile").load(folder).where(F.col("length") <= most_bytes)
    return files.select("path", "length", F.sha2("content", 256).alias("content_hash"), "content")


def scraped_links(raw: Column) -> Column:
    """Links of a site map answer: a list, {links: [...]} or {urls: [...]}, of strings or
    of objects with a url."""
    lists = F.coalesce(F.when(F.startswith(raw, F.lit("[")), F.from_json(raw, "array<string>")), F.from_json(F.get_json_object(raw, "$.links"), "array<string>"), F.from_json(F.get_json_object(raw, "$.urls"), "array<string>"))
    return F.transform(lists, lambda x: F.coalesce(F.when(F.startswith(x, F.lit("{")), F.get_json_object(x, "$.url")), x))


def generated_at(given: str | None, kb_meta: DataFrame) -> Column:
    """The time that exports carry: a given one (a build's), else that of the knowledge
    base, else now."""
    told = kb_meta.agg(F.max("last_updated_at")).first()[0]
    return F.lit(given or told) if given or told else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def export_guides(guides: DataFrame, at: Column, version: int = 1, schema_version: str = "3.0.0") -> DataFrame:
    """guide_id, json and the header's columns for each guide: the file's header stands
    on each row, so that a file of any number of guides is written in parallel."""
    return guides.select("guide_id", F.to_json(F.struct("*")).alias("json"), F.lit(schema_version).alias("schema_version"), at.alias("generated_at"), F.lit(version).alias("source_kb_version"))
