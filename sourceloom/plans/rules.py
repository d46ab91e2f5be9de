"""Registered queries of filters, validators, reports and scalar functions over entities
made of the test tables, with planted cases; their SQL states what was planted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from ..functions import urls as U
from ..operators import frontier, kb, migrate, publish, report, validate
from .catalog import HOST, q, query, table

# URLs of parts: some of the override page, some of excluded and included kinds
PART_URL = """'https://' || CASE p_partkey % 4 WHEN 0 THEN 'www.epassport.gov.bd' WHEN 1 THEN 'epassport.gov.bd' WHEN 2 THEN 'land.gov.bd' ELSE 'shop.example.com' END || CASE p_partkey % 9
WHEN 0 THEN '/instructions/passport-fees' WHEN 1 THEN '/instructions/passport-fees/' WHEN 2 THEN '/news/today' WHEN 3 THEN '/apply-online' WHEN 4 THEN '/about' WHEN 5 THEN '/' WHEN 6 THEN '/charge' WHEN 7 THEN '/files/a.pdf' ELSE '/how-to/step-2' END"""
PARTS_SQL = f"parts AS (SELECT p_partkey, p_name, {PART_URL} AS url FROM part)"


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", F.expr(PART_URL).alias("url"))


_OVERRIDDEN = f"regexp_replace({HOST}, '^www\\.', '') = 'epassport.gov.bd' AND p_partkey % 9 IN (0, 1)"


@query(f"""WITH {PARTS_SQL} SELECT p_partkey, url, {_OVERRIDDEN} AS overridden, CASE WHEN {_OVERRIDDEN} THEN p_name || ' 100 BDT, ' || 'BDT.' ELSE p_name || ' 100 tk, TK.' END AS text FROM parts""")
def overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options of URLs that have some of their own, and the text they change."""
    rows = parts(spark, sf_dir).withColumn("text", F.concat("p_name", F.lit(" 100 tk, TK.")))
    return U.with_override(rows).select("p_partkey", "url", F.col("override").isNotNull().alias("overridden"), F.when(F.col("override.bdt_for_tk"), T.override_currency(F.col("text"))).otherwise(F.col("text")).alias("text"))


_BAD = " OR ".join(f"regexp_matches(lower(url), {q(U.one_end(p))})" for p in P.ARCHIVED_EXCLUDE)
_GOOD = " OR ".join([*(f"regexp_matches(lower(url), {q(p)})" for p in P.ARCHIVED_INCLUDE), *(f"contains(lower(url), {q(k)})" for k in P.ARCHIVED_KEYWORDS)])


@query(f"WITH {PARTS_SQL} SELECT p_partkey, {_BAD} AS excluded, {_GOOD} AS service_page FROM parts")
def archived_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older crawler's exclude list, include list and keywords."""
    return parts(spark, sf_dir).select("p_partkey", frontier.archived_excluded(F.col("url")).alias("excluded"), frontier.archived_service_page(F.col("url")).alias("service_page"))


@query("""WITH s AS (SELECT s_suppkey, 's' || s_suppkey || '.gov.bd' AS domain FROM supplier) SELECT s_suppkey, domain FROM s WHERE contains(domain, 's7') OR contains('www.s11.gov.bd', domain)""")
def seed_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds of asked domains, either containing the other."""
    seeds = table(spark, sf_dir, "supplier").select("s_suppkey", F.expr("'s' || s_suppkey || '.gov.bd'").alias("domain"))
    return frontier.seeds_of(seeds, ["s7", "www.s11.gov.bd"])


_SEED = "CASE p_partkey % 4 WHEN 2 THEN 'land.gov.bd' WHEN 3 THEN 'nowhere.org' ELSE 'www.epassport.gov.bd' END"


@query(f"""WITH {PARTS_SQL}, f AS (SELECT {_SEED} AS seed_domain, url, min(p_partkey) AS pos FROM parts GROUP BY 1, 2)
SELECT seed_domain, url, pos FROM f WHERE seed_domain <> 'nowhere.org' AND NOT contains(url, '/files/')""")
def frontier_by_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs of each seed that host, robots and depth let pass."""
    rows = parts(spark, sf_dir).select(F.expr(_SEED).alias("seed_domain"), "url", F.col("p_partkey").alias("pos"))
    rules = [(d, ["/files/open"], ["/files/", "/private"]) for d in ("www.epassport.gov.bd", "land.gov.bd")]
    seeds = spark.createDataFrame(rules, "domain string, allow array<string>, disallow array<string>")
    return frontier.frontier(rows, seeds).select("seed_domain", "url", "pos")


@query("""WITH p AS (SELECT page_id, sha256(url) AS h FROM pages)
SELECT page_id, 'changed' AS why FROM p WHERE page_id % 3 <> 0 UNION ALL SELECT page_id, 'missing' FROM p WHERE page_id % 5 <> 0""")
def refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to fetch again: new or changed ones, and those without today's snapshot."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("page_id").cast("string").alias("source_page_id"), F.sha2("url", 256).alias("content_hash"))
    hashes = pages.where("page_id % 3 = 0 or page_id % 3 = 1").select("source_page_id", F.when(F.col("page_id") % 3 == 0, F.col("content_hash")).otherwise(F.lit("old")).alias("content_hash"))
    shots = pages.select("source_page_id", F.when(F.col("page_id") % 5 == 0, "2026-01-02").otherwise("2026-01-01").alias("snapshot_date"))
    changed, missing = frontier.changed(pages, hashes), frontier.missing(pages, shots, F.lit("2026-01-02"))
    return changed.select("page_id", F.lit("changed").alias("why")).unionByName(missing.select("page_id", F.lit("missing").alias("why")))


_DOC = "CASE doc_id % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN '.docx' ELSE '.xlsx' END"


@query(f"SELECT source AS domain, {_DOC} AS extension, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS bytes FROM documents GROUP BY 1, 2")
def document_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Harvested documents by domain and extension."""
    docs = table(spark, sf_dir, "documents")
    return report.document_stats(docs.select(F.col("source").alias("domain"), F.expr(_DOC).alias("extension"), F.col("n_chars").alias("file_size")))


@query("""WITH p AS (SELECT o_custkey % 50 AS d, o_orderkey % 7 = 0 AND o_custkey % 50 <> 9 AS fee, o_orderkey % 2 AS n, CASE WHEN o_custkey % 50 < 40 THEN 1 ELSE 0 END AS c FROM orders)
SELECT 'coverage' AS what, count(DISTINCT d) FILTER (fee) AS a, count(DISTINCT d) FILTER (fee AND n > 0) AS b FROM p UNION ALL SELECT 'silent', d, count(*) FROM p GROUP BY d HAVING sum(c) = 0""")
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domains with fee pages and with fees; domains whose pages made no claims."""
    pages = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("domain"), F.expr("o_orderkey % 7 = 0 and o_custkey % 50 <> 9").alias("is_fee_page"), (F.col("o_orderkey") % 2).alias("n_fees"), F.expr("if(o_custkey % 50 < 40, 1, 0)").alias("n_claims"))
    one = report.fee_coverage(pages).select(F.lit("coverage").alias("what"), F.col("with_fee_page").alias("a"), F.col("with_fees").alias("b"))
    return one.unionByName(report.silent_domains(pages).select(F.lit("silent").alias("what"), F.col("domain").alias("a"), F.col("pages").alias("b")))


@query("""WITH g AS (SELECT o_orderkey, CAST(o_orderkey % 5 AS BIGINT) AS steps, CAST(o_orderkey % 3 AS BIGINT) AS cites, o_custkey % 20 AS d FROM orders)
SELECT count(*) AS guides, CAST(sum(steps) AS BIGINT) AS steps, CAST(sum(cites) AS BIGINT) AS citations, (SELECT count(DISTINCT d) FROM g WHERE d <> 3) AS domains FROM g""")
def build_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums over all guides and their domains."""
    g = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 5).alias("step_count"), (F.col("o_orderkey") % 3).alias("citation_count"), F.expr("if(o_custkey % 20 = 3, array(), array(cast(o_custkey % 20 as string), cast(o_custkey % 20 as string)))").alias("source_domains"))
    return publish.totals(g)


@query("""SELECT l_orderkey AS guide_id, max(l_shipdate) AS last_crawled_at, string_agg(DISTINCT 's' || (l_suppkey % 4) || '.org', ',' ORDER BY 's' || (l_suppkey % 4) || '.org') AS domains FROM lineitem GROUP BY 1""")
def guide_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When the pages of a guide were last crawled, and their domains."""
    i = table(spark, sf_dir, "lineitem").select("l_orderkey", F.expr("l_orderkey || '.' || l_linenumber || '.' || l_partkey || '.' || l_suppkey").alias("claim_id"), "l_suppkey", "l_shipdate")
    pages = i.select(F.col("claim_id").alias("source_page_id"), F.expr("'https://s' || (l_suppkey % 4) || '.org/x'").alias("canonical_url"), F.col("l_shipdate").alias("last_crawled_at"))
    got = publish.guide_sources(i.select(F.col("l_orderkey").alias("guide_id"), "claim_id"), i.select("claim_id", F.col("claim_id").alias("source_page_id")), pages.distinct())
    return got.select("guide_id", "last_crawled_at", F.array_join("source_domains", ",").alias("domains"))


@query(f"""WITH {PARTS_SQL} SELECT p_partkey, p_name || ' 48 page 3,450 TK' AS raw, p_name || ' 48 page 3,450 BDT' AS published, 48 AS amount,
CASE p_partkey % 5 WHEN 0 THEN 'a > b' WHEN 1 THEN 'CSS: #x' WHEN 2 THEN '#frag' WHEN 3 THEN 'Page 7' END AS locator,
'svc.' || regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9_]', '_', 'g'), '^_+|_+$', '', 'g') AS slug, 'script:' || regexp_replace(p_name, '[^A-Za-z0-9_.-]', '_', 'g') AS actor, true AS actor_ok,
CAST(p_partkey % 6 AS INT) AS step, contains(url, '.gov.bd') AS known_tld, true AS valid,
CASE WHEN p_partkey % 9 IN (0, 1, 6) THEN 'fee_schedule' WHEN p_partkey % 9 = 8 THEN 'instruction' WHEN p_partkey % 9 = 5 THEN 'main_portal' ELSE 'other' END AS crawl_type FROM parts""")
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scalar functions of labels, locators, ids and URLs."""
    c, null = F.col, F.lit(None).cast("string")
    raw = F.concat("p_name", F.lit(" 48 page 3,450 TK"))
    kind = F.expr("case p_partkey % 5 when 0 then 'heading_path' when 1 then 'css_selector' when 2 then 'url_fragment' when 3 then 'pdf_page' else 'other' end")
    return parts(spark, sf_dir).select(
        "p_partkey", raw.alias("raw"), T.publish_currency(raw).alias("published"), T.label_amount(F.lit("48 page 3,450")).alias("amount"),
        T.locator_text(kind, F.array(F.lit("a"), F.lit("b")), F.lit("#x"), null, F.lit("frag"), F.lit(7)).alias("locator"), T.slug(c("p_name"), "svc").alias("slug"), T.actor(c("p_name")).alias("actor"), T.is_actor(T.actor(c("p_name"))).alias("actor_ok"),
        T.step_order(null, F.concat(F.lit("claim.step.x."), (c("p_partkey") % 6).cast("string")), F.array(F.lit("Step 9"))).alias("step"), frontier.known_tld(c("url")).alias("known_tld"), U.is_valid(c("url")).alias("valid"), U.crawl_page_type(c("url"), F.concat(F.lit("https://"), U.domain(c("url")))).alias("crawl_type"),
    )


# validators ---------------------------------------------------------------------------

DOC_JSON = """'{"document_id":"' || CASE WHEN p_partkey % 5 = 0 THEN 'DOC.' ELSE 'doc.' END || p_partkey || '"' || CASE WHEN p_partkey % 7 = 0 THEN '' ELSE ',"document_name":"n"' END || ',"claims":' || CASE WHEN p_partkey % 11 = 0 THEN '[]' ELSE '["claim.a"]' END
|| CASE WHEN p_partkey % 13 = 0 THEN ',"steps":["", "go there"]' WHEN p_partkey % 13 = 1 THEN ',"description":" "' WHEN p_partkey % 13 = 2 THEN ',"definition":"a text"' ELSE '' END || CASE WHEN p_partkey % 17 = 0 THEN ',"status":"odd"' ELSE ',"status":"partial"' END || '}'"""


def _rows(rule: str, entity: str, ident: str, source: str, where: str) -> str:
    return f"SELECT '{rule}' AS rule, 'error' AS severity, '{entity}' AS entity, {ident} AS entity_id, '' AS detail FROM {source} WHERE {where}"


_D = lambda rule, where: _rows(rule, "document", "CASE WHEN p_partkey % 5 = 0 THEN 'DOC.' ELSE 'doc.' END || p_partkey", "part", where)


@query(" UNION ALL ".join([_D("id_pattern", "p_partkey % 5 = 0"), _D("required:document_name", "p_partkey % 7 = 0"), _D("claims", "p_partkey % 11 = 0"), _D("free_text:steps", "p_partkey % 13 = 0"), _D("free_text:definition", "p_partkey % 13 = 2"), _D("status", "p_partkey % 17 = 0")]))
def validate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents refer to claims and hold no text of their own."""
    return validate.documents(table(spark, sf_dir, "part").select(F.expr(DOC_JSON).alias("json")))


SVC_JSON = """'{"service_id":"svc.' || s_suppkey || '","service_name":"n","agency_id":"agency.a","claims":["claim.a"]' || CASE WHEN s_suppkey % 3 = 0 THEN '' WHEN s_suppkey % 3 = 1 THEN ',"portal_mapping":{"entry_urls":[]}' ELSE ',"portal_mapping":{"entry_urls":[{"url":"u","source_page_id":"s"},{"url":"u"}]}' END
|| CASE WHEN s_suppkey % 7 = 0 THEN ',"official_entrypoints":[{"label":"x"}]' WHEN s_suppkey % 7 = 1 THEN ',"official_entrypoints":[]' ELSE ',"official_entrypoints":[{"source_page_id":"s"}]' END || CASE WHEN s_suppkey % 11 = 0 THEN ',"fees":"100"' ELSE '' END || CASE WHEN s_suppkey % 5 = 0 THEN ',"status":"odd"' ELSE '' END || '}'"""
_V = lambda rule, where: _rows(rule, "service", "'svc.' || s_suppkey", "supplier", where)


@query(" UNION ALL ".join([_V("required:portal_mapping", "s_suppkey % 3 = 0"), _V("entry_urls", "s_suppkey % 3 = 1"), _V("entry_url_fields", "s_suppkey % 3 = 2"), _V("entrypoint_source", "s_suppkey % 7 = 0"), _V("entrypoints", "s_suppkey % 7 = 1"), _V("free_text:fees", "s_suppkey % 11 = 0"), _V("status", "s_suppkey % 5 = 0")]))
def validate_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Services refer to claims, pages and entry points and hold no text of their own."""
    return validate.services(table(spark, sf_dir, "supplier").select(F.expr(SVC_JSON).alias("json")))


_A = lambda rule, where: _rows(rule, "agency", "CASE WHEN n_nationkey % 4 = 0 THEN 'Agency.' ELSE 'agency.' END || n_nationkey", "nation", where)


@query(" UNION ALL ".join([_A("id_pattern", "n_nationkey % 4 = 0"), _A("required", "n_nationkey % 5 = 0"), _A("allowlist", "n_nationkey % 6 = 0"), "SELECT 'unique_id', 'error', 'agency', 'agency.1', '2'"]))
def validate_agencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids, names and allowlists of agencies."""
    n = table(spark, sf_dir, "nation").select(F.expr("case when n_nationkey % 4 = 0 then 'Agency.' else 'agency.' end || n_nationkey").alias("agency_id"), F.expr("if(n_nationkey % 5 = 0, ' ', n_name)").alias("name"), F.expr("if(n_nationkey % 6 = 0, array(), array('a.b'))").alias("domain_allowlist"))
    return validate.agencies(n.unionByName(n.where("agency_id = 'agency.1'")))


_P = lambda rule, where: _rows(rule, "source_page", "CASE WHEN s_suppkey % 6 = 0 THEN 'source.x' || s_suppkey ELSE 'source.' || sha1('https://a.org/' || s_suppkey) END", "supplier", where)


@query(" UNION ALL ".join([_P("id_of_url", "s_suppkey % 6 = 0"), _P("id_pattern", "s_suppkey % 6 = 0"), _P("hash", "s_suppkey % 7 = 0"), _P("agency_pattern", "s_suppkey % 8 = 0"), _P("language", "s_suppkey % 9 IN (0, 1)"), _P("page_type", "s_suppkey % 10 = 0"), _P("required:last_crawled_at", "s_suppkey % 11 = 0")]))
def validate_source_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of URLs, hashes, languages and types of source pages."""
    x = F.expr
    rows = table(spark, sf_dir, "supplier").select(
        x("case when s_suppkey % 6 = 0 then 'source.x' || s_suppkey else 'source.' || sha1('https://a.org/' || s_suppkey) end").alias("source_page_id"), x("'https://a.org/' || s_suppkey").alias("canonical_url"),
        x("if(s_suppkey % 8 = 0, 'Agency A', 'agency.a')").alias("agency_id"), x("if(s_suppkey % 10 = 0, 'page', 'form')").alias("page_type"), x("case s_suppkey % 9 when 0 then array() when 1 then array('en', 'fr') else array('bn') end").alias("language"),
        x("if(s_suppkey % 7 = 0, 'abc', sha2('x', 256))").alias("content_hash"), x("if(s_suppkey % 11 = 0, null, '2026-01-01')").alias("last_crawled_at"), F.lit("t").alias("title"), F.lit("active").alias("status"),
    )
    return validate.source_pages(rows)


_C = lambda rule, where: _rows(rule, "claim", "'claim.' || o_orderkey", "orders", where)
_CLAIM_JSON = """'{"amount_bdt":' || CASE o_orderkey % 7 WHEN 0 THEN '"12"' ELSE '12' END || '}'"""


@query(" UNION ALL ".join([_C("text", "o_orderkey % 5 = 0"), _C("status", "o_orderkey % 6 = 0"), _C("structured_data", "o_orderkey % 8 = 0"), _C("fee_amount", "o_orderkey % 8 <> 0 AND o_orderkey % 7 = 0"), _C("citations", "o_orderkey % 9 = 0"),
    _rows("quoted_text", "citation", "'claim.' || o_orderkey", "orders", "o_orderkey % 9 <> 0 AND o_orderkey % 10 = 0"), "SELECT 'source_exists', 'error', 'citation', 'claim.' || o_orderkey, 'source.' || sha1('b') FROM orders WHERE o_orderkey % 9 <> 0 AND o_orderkey % 11 = 0"]))
def validate_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts, status, structured data and citations of claims."""
    x = F.expr
    o = table(spark, sf_dir, "orders").select("o_orderkey", x("'claim.' || o_orderkey").alias("claim_id"))
    rows = o.select("claim_id", x("if(o_orderkey % 5 = 0, ' ', 'a')").alias("text"), x("if(o_orderkey % 6 = 0, 'odd', 'stale')").alias("status"), F.lit("fee").alias("claim_type"), F.lit("svc.a").alias("entity_id"), x(f"if(o_orderkey % 8 = 0, null, {_CLAIM_JSON})").alias("structured_data"))
    cites = o.where("o_orderkey % 9 <> 0").select("claim_id", x("'source.' || sha1(if(o_orderkey % 11 = 0, 'b', 'a'))").alias("source_page_id"), x("if(o_orderkey % 10 = 0, '', 'q')").alias("quoted_text"), F.lit("2026-01-01").alias("retrieved_at"))
    return validate.claims(rows, cites, spark.range(1).select(x("'source.' || sha1('a')").alias("source_page_id")))


_G = lambda rule, where, entity="guide": _rows(rule, entity, "'guide.' || c_custkey", "customer", where)


@query(" UNION ALL ".join([_G("id_pattern", "false"), _G("required", "c_custkey % 5 = 0"), _G("status", "c_custkey % 6 = 0"), "SELECT 'service_exists', 'error', 'guide', 'guide.' || c_custkey, 'svc.z' FROM customer WHERE c_custkey % 7 = 0",
    _G("steps", "c_custkey % 8 = 0"), _G("step_fields", "c_custkey % 8 = 1"), _G("sections", "c_custkey % 9 = 0"), _G("variants", "c_custkey % 10 = 0"), _G("links", "c_custkey % 11 = 0"), _G("link_fields", "c_custkey % 11 = 1")]))
def validate_guides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required fields and references of guides; steps, sections, variants and links."""
    x = F.expr
    c = table(spark, sf_dir, "customer")
    rows = c.select(x("'guide.' || c_custkey").alias("guide_id"), x("if(c_custkey % 7 = 0, 'svc.z', 'svc.a')").alias("service_id"), F.lit("agency.a").alias("agency_id"), x("if(c_custkey % 5 = 0, null, 'T')").alias("title"), x("if(c_custkey % 6 = 0, 'odd', 'draft')").alias("status"))
    known = spark.createDataFrame([("svc.a", "agency.a")], "service_id string, agency_id string")
    parts_ = c.select(
        x("'guide.' || c_custkey").alias("guide_id"),
        x("""'{"steps":' || case c_custkey % 8 when 0 then '[]' when 1 then '[{"step_number":1,"title":"t"}]' else '[{"step_number":1,"title":"t","claim_ids":["claim.a"]}]' end || ',"sections":' || if(c_custkey % 9 = 0, '{"fees":[""]}', '{"fees":["claim.a"]}')
            || ',"variants":' || if(c_custkey % 10 = 0, '[{"label":"l"}]', '[{"variant_id":"v","label":"l"}]') || ',"official_links":' || case c_custkey % 11 when 0 then '[]' when 1 then '[{"label":"l","url":"ftp://x","source_page_id":"source.a"}]' else '[{"label":"l","url":"https://x.org","source_page_id":"source.a"}]' end || '}'""").alias("json"),
    )
    return validate.union(validate.guides(rows, known, known), validate.guide_parts(parts_))


SCHEMA = {"type": "object", "required": ["id", "meta"], "properties": {
    "id": {"type": "string", "pattern": "^g[0-9]+$"}, "kind": {"const": "guide"}, "steps": {"type": "array", "minItems": 1, "items": {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer", "minimum": 1}}}},
    "meta": {"type": "object", "properties": {"status": {"enum": ["draft", "published"]}, "title": {"type": "string", "minLength": 2}}}, "any": {"oneOf": [{"type": "array", "minItems": 2}, {"type": "string"}]}}}
_SCHEMA_JSON = """'{"id":' || CASE n_nationkey % 4 WHEN 0 THEN n_nationkey || '' WHEN 1 THEN '"x"' ELSE '"g1"' END || ',"kind":"' || CASE WHEN n_nationkey % 5 = 0 THEN 'page' ELSE 'guide' END || '","steps":' || CASE n_nationkey % 6 WHEN 0 THEN '[]' WHEN 1 THEN '[{"n":1},{}]' WHEN 2 THEN '[{"n":0}]' WHEN 3 THEN '[{"n":1.5}]' ELSE '[{"n":2}]' END
|| CASE WHEN n_nationkey % 7 = 0 THEN '' ELSE ',"meta":{"status":"' || CASE WHEN n_nationkey % 7 = 1 THEN 'odd' ELSE 'draft' END || '","title":"' || CASE WHEN n_nationkey % 7 = 2 THEN 'a' ELSE 'abc' END || '"}' END || ',"any":' || CASE n_nationkey % 3 WHEN 0 THEN '[1]' WHEN 1 THEN '[1,2]' ELSE '"s"' END || '}'"""
_J = lambda rule, where: _rows(rule, "row", "CAST(n_nationkey AS VARCHAR)", "nation", where)


@query(" UNION ALL ".join([_J("type:$.id", "n_nationkey % 4 = 0"), _J("pattern:$.id", "n_nationkey % 4 = 1"), _J("const:$.kind", "n_nationkey % 5 = 0"), _J("minItems:$.steps", "n_nationkey % 6 = 0"), _J("required:$.steps[].n", "n_nationkey % 6 = 1"), _J("minimum:$.steps[].n", "n_nationkey % 6 = 2"), _J("type:$.steps[].n", "n_nationkey % 6 = 3"),
    _J("required:$.meta", "n_nationkey % 7 = 0"), _J("enum:$.meta.status", "n_nationkey % 7 = 1"), _J("minLength:$.meta.title", "n_nationkey % 7 = 2"), _J("oneOf:$.any", "n_nationkey % 3 = 0")]))
def schema_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schema's rules at any depth of JSON."""
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("key"), F.expr(_SCHEMA_JSON).alias("json"))
    return validate.json_schema(rows, "key", SCHEMA)


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS entity_id, CASE WHEN n_nationkey % 3 = 0 THEN 'claim_key' ELSE 'claim_value' END AS rule FROM nation WHERE n_nationkey % 3 < 2
UNION ALL SELECT 'kb' || n_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN 'schema_version' ELSE 'array:claims' END FROM nation WHERE n_nationkey % 4 < 2
UNION ALL SELECT 'evt.' || n_nationkey, 'id_pattern' FROM nation UNION ALL SELECT 'evt.' || n_nationkey, 'actor' FROM nation WHERE n_nationkey % 5 = 0""")
def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What published rows, whole files and audit rows must keep to."""
    x = F.expr
    n = table(spark, sf_dir, "nation").select("n_nationkey")
    shown = n.select(F.col("n_nationkey").alias("guide_id"), F.when(F.col("n_nationkey") % 3 == 0, F.lit("x")).alias("claim_id"), F.array(F.struct(x("if(n_nationkey % 3 = 1, 'claim.z', 'text')").alias("note"))).alias("steps"))
    whole = n.select(x("'kb' || n_nationkey").alias("name"), x("""'{"$schema_version":"' || if(n_nationkey % 4 = 0, '1.0.0', '2.0.0') || '","source_pages":[],"claims":' || if(n_nationkey % 4 = 1, '{}', '[]') || ',"agencies":[],"documents":[],"services":[]}'""").alias("json"))
    log = n.select(x("'evt.' || n_nationkey").alias("event_id"), F.lit("migration").alias("event_type"), x("if(n_nationkey % 5 = 0, 'robot', 'system')").alias("actor"))
    found = validate.union(validate.contract(shown), validate.top_level(whole, "name"), validate.audit_entries(log))
    return found.select("entity_id", "rule")


@query("""WITH c AS (SELECT o_orderkey, 'claim.' || o_orderkey AS claim_id, o_custkey % 200 AS page, CASE o_orderkey % 5 WHEN 0 THEN 'verified' WHEN 1 THEN 'unverified' WHEN 2 THEN 'stale' ELSE 'deprecated' END AS status FROM orders)
SELECT 'claim' AS kind, status AS type, CASE WHEN page % 4 = 0 AND status IN ('verified', 'unverified') THEN 'stale' ELSE status END AS now, count(*) AS n FROM c GROUP BY ALL
UNION ALL SELECT 'event', 'source_change', '', count(DISTINCT page) FROM c WHERE page % 4 = 0
UNION ALL SELECT 'event', 'claim_invalidation', '', (count(*) + 99) // 100 FROM c WHERE page % 4 = 0 AND status IN ('verified', 'unverified')""")
def source_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages change: claims that cite them turn stale, and the audit log says so."""
    x = F.expr
    rows = table(spark, sf_dir, "orders").select(x("'claim.' || o_orderkey").alias("claim_id"), x("cast(o_custkey % 200 as string)").alias("page"), x("case o_orderkey % 5 when 0 then 'verified' when 1 then 'unverified' when 2 then 'stale' else 'deprecated' end").alias("status"))
    none = F.lit(None).cast("string")
    claims = rows.select("claim_id", "status", F.col("status").alias("was"), none.alias("previous_status"), none.alias("stale_marked_at"), none.alias("stale_due_to_source_hash"))
    pages = rows.select(F.col("page").alias("source_page_id")).distinct()
    old = pages.select("source_page_id", F.lit("a").alias("content_hash"))
    new = pages.select("source_page_id", F.col("source_page_id").cast("int").alias("pos"), x("if(cast(source_page_id as int) % 4 = 0, 'b', 'a')").alias("content_hash"))
    after, events = kb.process_source_changes(old, new, claims, rows.select("claim_id", F.col("page").alias("source_page_id")), F.lit("2026-01-02"), F.lit("system"), per_row=100)
    by_status = after.groupBy(F.lit("claim").alias("kind"), F.col("was").alias("type"), F.col("status").alias("now")).agg(F.count("*").alias("n"))
    return by_status.unionByName(events.groupBy(F.lit("event").alias("kind"), F.col("event_type").alias("type"), F.lit("").alias("now")).agg(F.count("*").alias("n")))


@query("""SELECT 'd' || s_suppkey || '.gov.bd' AS domain, s_suppkey AS pos FROM supplier WHERE s_suppkey % 3 <> 1""")
def seed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known seeds (every third), and new ones whose domain no known seed has as its own
    or, as each has its successor's, in a start URL."""
    s = table(spark, sf_dir, "supplier").select(F.expr("'d' || s_suppkey || '.gov.bd'").alias("domain"), F.expr("array('https://www.d' || (s_suppkey + 1) || '.gov.bd/x', 'https://d' || s_suppkey || '.gov.bd')").alias("start_urls"), F.col("s_suppkey").alias("pos"))
    return frontier.merge_seeds(s.where("pos % 3 = 0"), s.where("pos % 3 <> 0")).select("domain", "pos")


@query("""SELECT o_orderkey AS guide_id, CASE WHEN o_orderkey % 4 = 0 THEN 'new,b,old' ELSE 'old,b,old' END AS ids FROM orders WHERE o_orderkey % 4 < 2 AND o_orderkey % 4 <> 1
UNION ALL SELECT o_orderkey, 'x,y' FROM orders WHERE o_orderkey % 4 = 1""")
def guide_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of guides replaced by those of twins, the first place only."""
    g = table(spark, sf_dir, "orders").where("o_orderkey % 4 < 2").select(F.col("o_orderkey").alias("guide_id"), F.expr("if(o_orderkey % 4 = 0, array('old', 'b', 'old'), array('x', 'y'))").alias("claim_ids"))
    return migrate.rewrite_ids(g, spark.createDataFrame([("old", "new")], "old_id string, new_id string")).select("guide_id", F.array_join("claim_ids", ",").alias("ids"))
