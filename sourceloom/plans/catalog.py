"""The registered queries over the test tables, and their SQL.

Where the tables lack what an operator works on (Markdown headings, fees, robots
files), columns are made of them by one SQL expression that both engines run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from ..functions import urls as U
from ..operators import extract, frontier, kb, migrate, publish, report, validate

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# pieces of SQL for the oracle side ---------------------------------------------------

S = r"[\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_trim(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{S}+', ''), '{S}+$', '')"


def sql_squeeze(x: str) -> str:
    return f"regexp_replace({x}, '{S}+', ' ', 'g')"


def sql_print(*parts: str) -> str:
    joined = " || chr(10) || ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)
    return f"lower({sql_squeeze(sql_trim('(' + joined + ')'))})"


HOST = "lower(nullif(regexp_extract(url, '(?is)^[a-z][a-z0-9+.-]*://([^/?#:]*)', 1), ''))"
PATH = "coalesce(nullif(regexp_extract(url, '(?is)^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)', 1), ''), '/')"
DEPTH = f"len(list_filter(string_split({PATH}, '/'), lambda s: s <> ''))"


def sql_score(url: str) -> str:
    low = f"lower({url})"
    one = lambda p: q(U.one_end(p))
    out = " OR ".join(f"regexp_matches({low}, {one(p)})" for p in P.EXCLUDE)
    points = " + ".join(f"CASE WHEN regexp_matches({low}, {one(p)}) THEN {P.WEIGHTS[k]} ELSE 0 END" for k, ps in (("very_high", P.VERY_HIGH), ("high", P.HIGH), ("medium", P.MEDIUM), ("low", P.LOW)) for p in ps)
    return f"CASE WHEN {out} THEN {P.EXCLUDED_SCORE} ELSE {points} + CASE WHEN {DEPTH} <= 2 THEN 2 ELSE 0 END + CASE WHEN {DEPTH} = 1 THEN 3 ELSE 0 END END"


# a page URL and a second one with words that carry weight
RICH = "'https://' || CASE page_id % 3 WHEN 0 THEN 'www.epassport.gov.bd' WHEN 1 THEN 'nidw.gov.bd' ELSE 'sub.unknown.com.bd' END || CASE page_id % 7 WHEN 0 THEN '/instructions/fees' WHEN 1 THEN '/apply' WHEN 2 THEN '/Downloads/Form_' || page_id || '.pdf?x=1' WHEN 3 THEN '/old/archive/' || page_id WHEN 4 THEN '/login' WHEN 5 THEN '' ELSE '/office/contact/' || page_id || '/' END"


def rich_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return pages.select("page_id", "url", "html").unionByName(pages.select("page_id", F.expr(RICH).alias("url"), "html"))


RICH_SQL = f"rich AS (SELECT page_id, url, html FROM pages UNION ALL SELECT page_id, {RICH} AS url, html FROM pages)"


@query(f"""WITH {RICH_SQL},
s AS (SELECT page_id, url, html, {HOST} AS host, CAST({DEPTH} AS INT) AS depth, CAST({sql_score('url')} AS INT) AS score FROM rich),
r AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY score DESC, length(url), page_id, url) AS rank FROM s WHERE host IS NOT NULL AND score > {P.EXCLUDED_SCORE})
SELECT page_id, url, host, depth, score, CAST(rank AS INT) AS rank, 'source.' || sha1(url) AS source_page_id, sha256(html) AS content_hash,
CASE WHEN regexp_matches(html, '[A-Za-z]') AND regexp_matches(html, '[\\x{{0980}}-\\x{{09FF}}]') THEN 'en,bn' WHEN regexp_matches(html, '[\\x{{0980}}-\\x{{09FF}}]') THEN 'bn' ELSE 'en' END AS languages
FROM r WHERE rank <= 300""")
def frontier_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best 300 URLs of each host, with source id, content hash and languages."""
    pages = rich_pages(spark, sf_dir)
    # the limit by rank comes before the exchange, so pages can ride along
    best = frontier.ranked(pages.withColumn("pos", F.struct("page_id", "url")))
    return best.select("page_id", "url", "host", "depth", "score", "rank", T.source_id(F.col("url")).alias("source_page_id"), F.sha2("html", 256).alias("content_hash"), F.array_join(T.languages(F.col("html")), ",").alias("languages"))


@query(f"""WITH {RICH_SQL} SELECT page_id, url, {HOST} AS host, CAST({DEPTH} AS INT) AS depth,
regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+', 0)) || '://' || {HOST} || {PATH}, '/$', '') AS normal,
regexp_replace({HOST}, '^www\\.', '') || CASE WHEN {PATH} = '/' THEN '/' ELSE regexp_replace({PATH}, '/+$', '') END AS override_key,
lower(regexp_extract(regexp_extract({PATH}, '([^/]*)/?$', 1), '[^.](\\.[^.]*)$', 1)) AS extension,
CASE lower(regexp_extract(regexp_extract({PATH}, '([^/]*)/?$', 1), '[^.](\\.[^.]*)$', 1)) WHEN '.pdf' THEN 'application/pdf' ELSE 'application/octet-stream' END AS mime,
lower(regexp_extract(regexp_extract({PATH}, '([^/]*)/?$', 1), '[^.](\\.[^.]*)$', 1)) IN ('.pdf', '.doc', '.docx', '.zip') AS is_binary,
regexp_matches(lower(url), '\\.(?:pdf|docx?|xlsx?|pptx?)(?:\\?|$)') OR regexp_matches(lower(url), 'download|attachment|circular|notice|form') AS is_document_page,
CASE {HOST} WHEN 'www.epassport.gov.bd' THEN 'svc.epassport' WHEN 'nidw.gov.bd' THEN 'svc.nid' ELSE 'svc.' || replace(regexp_replace(regexp_replace({HOST}, '^www\\.', ''), '\\.(gov|com|org)\\.bd$', ''), '.', '_') END AS service_id,
CASE {HOST} WHEN 'www.epassport.gov.bd' THEN 'agency.dip' WHEN 'nidw.gov.bd' THEN 'agency.bec' ELSE 'agency.' || regexp_replace(regexp_replace({HOST}, '^www\\.', ''), '[^a-z0-9]', '_', 'g') END AS agency_id,
'agency.auto_' || sha1(regexp_replace({HOST}, '^www\\.', ''))[1:12] AS auto_agency_id,
CASE WHEN regexp_matches(lower(url), 'fee|cost|price') THEN 'fee_schedule' WHEN regexp_matches(lower(url), 'instruction|guide|how-to') THEN 'instruction' WHEN contains(lower(url), 'form') THEN 'form' WHEN contains(lower(url), 'notice') THEN 'notice'
WHEN regexp_matches(lower(url), 'regulation|rule') THEN 'regulation' WHEN len(string_split(url, '/')) <= 4 THEN 'main_portal' ELSE 'other' END AS page_type,
ends_with({HOST}, 'example.com') AS in_domain FROM rich""")
def url_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scalar functions of every URL."""
    u, h = F.col("url"), U.domain(F.col("url"))
    return rich_pages(spark, sf_dir).select(
        "page_id", "url", h.alias("host"), U.depth(u).alias("depth"), U.normal_url(u).alias("normal"), U.override_key(u).alias("override_key"), U.extension(u).alias("extension"), U.mime(U.extension(u)).alias("mime"),
        U.is_binary(u).alias("is_binary"), U.is_document_page(u).alias("is_document_page"), U.service_id(h).alias("service_id"), U.agency_id(h).alias("agency_id"), U.auto_agency_id(h).alias("auto_agency_id"), U.page_type(u).alias("page_type"), U.domain_matches(h, F.lit("example.com")).alias("in_domain"))


@query(f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no FROM documents WHERE text IS NOT NULL),
t AS (SELECT doc_id, line_no, raw, {sql_trim('raw')} AS line FROM l)
SELECT doc_id, line_no, sha1(lower({sql_squeeze('line')})) AS print, CASE WHEN regexp_matches(line, '[\\x{{0980}}-\\x{{09FF}}]') THEN 'bn' ELSE 'en' END AS language,
CASE WHEN regexp_extract(line, '^[^।.!?]+[।.!?]?', 0) <> '' THEN {sql_trim("regexp_extract(line, '^[^।.!?]+[।.!?]?', 0)")} ELSE substring(line, 1, 100) END AS title,
regexp_matches(lower(line), '৳|টাকা|bdt|regular|express') AS fee_signal,
CAST(len(list_distinct(list_filter(regexp_split_to_array(lower(line), '{S}+'), lambda w: length(w) > 2))) AS INT) AS n_keywords FROM t""")
def text_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint, language, title and keywords of every line of every document."""
    split = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "raw"))
    line = T.trim(F.col("raw"))
    lines = split.select("doc_id", (F.col("i") + 1).cast("long").alias("line_no"), line.alias("line"))
    c = F.col("line")
    return lines.select("doc_id", "line_no", F.sha1(T.fingerprint(c)).alias("print"), T.language(c).alias("language"), T.step_title(c).alias("title"), T.fee_signal(c).alias("fee_signal"), F.size(T.keywords(c)).alias("n_keywords"))


LINE = """CASE l_partkey % 16
WHEN 0 THEN '# Order guide ' || l_suppkey WHEN 1 THEN '## Express service fee' WHEN 2 THEN '### Regular **fee** table ' || l_linenumber
WHEN 3 THEN CAST(l_partkey % 5 AS STRING) || '. Apply online for part ' || l_partkey || '. Then wait.' WHEN 4 THEN '- Submit form ' || l_partkey || ' at the office'
WHEN 5 THEN 'Urgent fee: ' || CAST(l_quantity * 100 AS BIGINT) || ' BDT for 48 page passport' WHEN 6 THEN 'Fee | TK 4,' || (100 + l_partkey % 800) || ' and ৳ 5' || (l_suppkey % 90 + 10)
WHEN 7 THEN '৳ ৩,৪৫০ জমা' WHEN 8 THEN 'Q: What is part ' || l_partkey || '?' WHEN 9 THEN 'A: It is item ' || l_suppkey || ' of the list.' WHEN 10 THEN '## How much is part ' || l_partkey || '?'
WHEN 11 THEN '  Plain text about item ' || l_suppkey || ' with some more words for length' WHEN 12 THEN '[form ' || l_partkey || '](/files/form_' || l_partkey || '.pdf) and [more](page.html)'
WHEN 13 THEN '* [Is it ' || l_suppkey || '?](https://h.example.org/faq)' WHEN 14 THEN '১২. আবেদন ফরম পূরণ করুন ' || l_suppkey ELSE '' END"""
LINE_SQL = LINE.replace("AS STRING", "AS VARCHAR")
PAGE_URL = "'https://' || CASE l_orderkey % 4 WHEN 0 THEN 'www.epassport.gov.bd' WHEN 1 THEN 'nidw.gov.bd' WHEN 2 THEN 'shop.example.org' ELSE 'sub.unknown.gov.bd' END || '/instructions/fees/' || l_orderkey"


def pages_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Markdown page for each order, a line for each of its line items."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.struct("l_linenumber", F.expr(LINE).alias("line")).alias("x"))
    pages = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    return pages.select(F.col("l_orderkey").alias("page_id"), F.expr(PAGE_URL).alias("url"), F.array_join(F.transform("xs", lambda x: x["line"]), "\n").alias("markdown"), F.lit(None).cast("string").alias("html"))


_STEP = "list_reduce(hs[:n], lambda acc, h: acc[:CAST(h[1] AS INT) - 1] || [h[2]], [])"
PAGES_SQL = rf"""p AS (SELECT l_orderkey AS page_id, {PAGE_URL} AS url, list({LINE_SQL} ORDER BY l_linenumber, {LINE_SQL}) AS ls FROM lineitem GROUP BY l_orderkey),
raw AS (SELECT page_id, url, ls, unnest(ls) AS line0, unnest(range(1, len(ls) + 1)) AS line_no FROM p),
l0 AS (SELECT page_id, url, ls, line_no, {sql_trim('line0')} AS line, regexp_matches({sql_trim('line0')}, '^#{{1,6}}{S}+.') AS is_heading FROM raw),
hl AS (SELECT page_id, list([CAST(length(regexp_extract(line, '^(#+)', 1)) AS VARCHAR), {sql_trim("replace(regexp_extract(line, '^#+" + S + "+(.+)', 1), '**', '')")}] ORDER BY line_no) AS hs FROM l0 WHERE is_heading GROUP BY page_id),
l1 AS (SELECT l0.*, hs, count(*) FILTER (is_heading) OVER (PARTITION BY page_id ORDER BY line_no) AS n FROM l0 LEFT JOIN hl USING (page_id)),
l2 AS (SELECT *, CASE WHEN n = 0 THEN CAST([] AS VARCHAR[]) ELSE list_reduce(list_prepend(CAST([] AS VARCHAR[]), hs[:n]), lambda acc, h: acc[:CAST(h[1] AS INT) - 1] || [h[2]]) END AS path FROM l1),
lines AS (SELECT page_id, url, ls, line_no, line, is_heading, path, array_to_string(path, ' > ') AS heading_path, CASE WHEN is_heading THEN path[-1] END AS heading FROM l2)"""


@query(f"WITH {PAGES_SQL} SELECT page_id, line_no, heading, heading_path FROM lines WHERE is_heading")
def page_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings of all pages with their paths."""
    return extract.headings(extract.page_lines(pages_of_orders(spark, sf_dir))).withColumn("line_no", F.col("line_no").cast("long"))


_BARE = sql_trim(f"regexp_replace(regexp_replace(regexp_replace(line, '^[0-9]+[.):]?{S}*', ''), '^[০-৯]+[.)।:]?{S}*', ''), '^[-•–*]{S}*', '')")
_TITLE = f"CASE WHEN regexp_extract(text, '^[^।.!?]+[।.!?]?', 0) <> '' THEN {sql_trim(chr(34) + 'f' + chr(34))} ELSE substring(text, 1, 100) END"
_NUMBERED = "TRY_CAST(regexp_extract(line, '^([0-9]+)[.):].*[^.):]', 1) AS DOUBLE)"
_ENGLISH = r"(?i)\b(?:" + "|".join(P.ENGLISH_ACTIONS) + r")\b"
_ENDS = "|".join([f"{w}{S}*[।.]*$" for w in P.BENGALI_ENDINGS] + [f"{a}{S}*{b}" for a, b in P.BENGALI_ACTIONS])
STEPS_SQL = rf"""m AS (SELECT *, {_BARE} AS text, CASE WHEN {_NUMBERED} > 0 THEN 'ordered_list' WHEN regexp_matches(line, '^[০-৯]+[.)।:]') THEN 'bengali_ordered'
WHEN regexp_matches(line, '^[-•–*]') AND (regexp_matches(line, '{_ENGLISH}') OR regexp_matches(line, '{_ENDS}')) THEN 'bullet_imperative' WHEN regexp_matches(line, '{_ENDS}') THEN 'bengali_imperative' END AS marker,
CASE WHEN {_NUMBERED} > 0 THEN {_NUMBERED} WHEN regexp_matches(line, '^[০-৯]+[.)।:]') THEN CAST(translate(regexp_extract(line, '^[০-৯]+', 0), '০১২৩৪৫৬৭৮৯', '0123456789') AS DOUBLE) END AS num FROM lines WHERE NOT is_heading AND length(line) > 5),
st AS (SELECT *, regexp_extract(text, '^[^।.!?]+[।.!?]?', 0) AS f, coalesce(num, sum(CASE WHEN num IS NULL THEN 1 END) OVER (PARTITION BY page_id ORDER BY line_no)) AS ord FROM m WHERE marker IS NOT NULL AND length(text) >= 5),
steps AS (SELECT page_id, url, row_number() OVER (PARTITION BY page_id ORDER BY ord, line_no) AS step_no, substring({_TITLE}, 1, 150) AS title, CASE WHEN length(text) > length({_TITLE}) THEN substring(text, 1, 500) ELSE '' END AS description, text, heading_path, line_no, marker FROM st)"""


@query(f"WITH {PAGES_SQL}, {STEPS_SQL} SELECT page_id, step_no, title, description, heading_path, line_no, marker FROM steps")
def page_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of all pages."""
    found = extract.steps(extract.page_lines(pages_of_orders(spark, sf_dir)))
    return found.select("page_id", F.col("step_no").cast("long").alias("step_no"), "title", "description", "heading_path", F.col("line_no").cast("long").alias("line_no"), "marker")


_VAR = lambda x: f"CASE WHEN regexp_matches({x}, '(?i)\\bsuper[-\\s]?express\\b') THEN 'super_express' WHEN regexp_matches({x}, '(?i)\\b(emergency|urgent)\\b') THEN 'emergency' WHEN regexp_matches({x}, '(?i)\\bexpress\\b') THEN 'express' WHEN regexp_matches({x}, '(?i)\\bregular\\b') THEN 'regular' END"
_NUM = "[0-9]{1,7}(?:,[0-9]{3})*"
_BNUM = "[০-৯]{1,7}(?:,[০-৯]{3})*"
_LABEL = f"substring({sql_trim(sql_squeeze('regexp_replace(regexp_replace(regexp_replace(line, ' + q('(?i)[0-9,০-৯]+' + S + '*(?:BDT|Taka|টাকা|৳)') + ', ' + q('') + ', ' + q('g') + '), ' + q('৳' + S + '*[0-9,০-৯]+') + ', ' + q('') + ', ' + q('g') + '), ' + q('[:\\-–|]') + ', ' + q(' ') + ', ' + q('g') + ')'))}, 1, 100)"
FEES_SQL = rf"""fv AS (SELECT *, last_value({_VAR('heading')} IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY line_no) AS sticky,
nullif(regexp_extract(line, '(?i)({_NUM}){S}*(?:{P.CURRENCY})', 1), '') AS a1, nullif(regexp_extract(line, '৳{S}*({_NUM})', 1), '') AS a2, nullif(regexp_extract(line, '(?i)\b(?:{P.CURRENCY}){S}*({_NUM})', 1), '') AS a3,
nullif(regexp_extract(line, '৳{S}*({_BNUM})', 1), '') AS a4, nullif(regexp_extract(line, '({_BNUM}){S}*টাকা', 1), '') AS a5 FROM lines),
fa AS (SELECT *, list_transform(list_filter([a1, a2, CASE WHEN a1 IS NULL THEN a3 END, a4, a5], lambda a: a IS NOT NULL), lambda a: CAST(translate(a, '০১২৩৪৫৬৭৮৯,', '0123456789') AS BIGINT)) AS amounts FROM fv WHERE NOT is_heading AND line <> ''),
fb AS (SELECT *, list_filter(amounts, lambda a, i: a > 0 AND a <= 10000000 AND list_position(amounts, a) = i) AS kept FROM fa),
fc AS (SELECT *, unnest(kept) AS amount, unnest(range(len(kept))) AS pos FROM fb),
fees AS (SELECT page_id, url, pos, amount, CASE WHEN length({_LABEL}) < 3 THEN coalesce(path[-1], 'Fee') ELSE {_LABEL} END AS label, coalesce({_VAR('line')}, sticky) AS variant, substring(line, 1, 200) AS text, heading_path, line_no FROM fc)"""


@query(f"WITH {PAGES_SQL}, {FEES_SQL} SELECT page_id, pos, amount, label, variant, 'BDT' AS currency, text, heading_path, line_no FROM fees")
def page_fees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fees of all pages."""
    found = extract.fees(extract.page_lines(pages_of_orders(spark, sf_dir), sticky=True))
    return found.withColumns({"pos": F.col("pos").cast("long"), "line_no": F.col("line_no").cast("long")})


_STRIP = lambda x, w: sql_trim(f"regexp_replace({x}, '^(?i:{w})[.:]?{S}*', '')")
FAQS_SQL = rf"""tl AS (SELECT page_id, list({sql_trim('line')} ORDER BY line_no) AS alls FROM lines GROUP BY page_id),
qs AS (SELECT page_id, heading_path, line_no, {_STRIP('line', 'q')} AS question FROM lines WHERE NOT is_heading AND regexp_matches(line, '^(?i:q)')),
qa AS (SELECT q.page_id, q.heading_path, q.line_no, q.question, {_STRIP('a.line', 'a')} AS answer, row_number() OVER (PARTITION BY q.page_id, q.line_no ORDER BY a.line_no) - 1 AS pos FROM qs q JOIN lines a ON a.page_id = q.page_id AND a.line_no BETWEEN q.line_no + 1 AND q.line_no + 9 AND regexp_matches(a.line, '^(?i:a)')),
hq AS (SELECT l.page_id, l.heading, l.path, l.line_no, coalesce(min(h.line_no), 1000000) AS stop FROM lines l LEFT JOIN lines h ON h.page_id = l.page_id AND h.is_heading AND h.line_no > l.line_no WHERE l.is_heading AND ends_with(l.heading, '?') GROUP BY ALL),
ha AS (SELECT hq.page_id, hq.heading, hq.path, hq.line_no, a.line, a.line_no AS n, coalesce(sum(CASE WHEN a.line <> '' THEN length(a.line) + 1 END) OVER (PARTITION BY hq.page_id, hq.line_no ORDER BY a.line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - 1 AS so_far FROM hq JOIN lines a ON a.page_id = hq.page_id AND a.line_no BETWEEN hq.line_no + 1 AND hq.line_no + 19 AND a.line_no < stop),
hb AS (SELECT *, coalesce(max(CASE WHEN line = '' AND so_far > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY page_id, line_no ORDER BY n), 0) AS over FROM ha),
hc AS (SELECT page_id, heading, path, line_no, string_agg(line, ' ' ORDER BY n) FILTER (line <> '') AS answer FROM hb WHERE over = 0 GROUP BY ALL),
faqs AS (SELECT page_id, 'heading' AS form, heading AS question, substring(answer, 1, 1000) AS answer, NULL AS link, array_to_string(path[:-2], ' > ') AS heading_path, line_no, 0 AS pos FROM hc WHERE length(answer) > 10
UNION ALL SELECT page_id, 'pair', question, substring(answer, 1, 1000), NULL, heading_path, line_no, pos FROM qa WHERE length(question) > 5 AND length(answer) > 5
UNION ALL SELECT page_id, 'link', regexp_extract(line, '\[([^\]]+\?[^\]]*)\]\(([^)]+)\)', 1), NULL, regexp_extract(line, '\[([^\]]+\?[^\]]*)\]\(([^)]+)\)', 2), heading_path, line_no, 0 FROM lines WHERE NOT is_heading AND regexp_matches(line, '^[-•*].*\[([^\]]+\?[^\]]*)\]\('))"""


@query(f"WITH {PAGES_SQL}, {FAQS_SQL} SELECT page_id, form, question, answer, link, heading_path, line_no, CAST(pos AS BIGINT) AS pos FROM faqs")
def page_faqs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions and answers of all pages."""
    pages = pages_of_orders(spark, sf_dir)
    found = extract.faqs(extract.page_lines(pages, below=True))
    return found.withColumns({"pos": F.col("pos").cast("long"), "line_no": F.col("line_no").cast("long")})


DOCS_SQL = rf"""dl AS (SELECT page_id, url AS base, line_no, regexp_extract(line, '\[(form [0-9]+)\]', 1) AS text, regexp_extract(line, '\((/files/[^)]+)\)', 1) AS ref FROM lines WHERE contains(line, '/files/')),
du AS (SELECT page_id, base, line_no, text, regexp_extract(base, '^https://[^/]+', 0) || ref AS url FROM dl),
docs AS (SELECT page_id, base, url, arg_min(text, line_no) AS text, min(line_no) AS line_no FROM du GROUP BY ALL)"""


@query(f"WITH {PAGES_SQL}, {DOCS_SQL} SELECT page_id, text, url, '.pdf' AS extension, 'markdown_link' AS method FROM docs")
def page_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document links of all pages, resolved, the first of each URL."""
    return extract.document_links(pages_of_orders(spark, sf_dir)).drop("pos")


_KEY = "CASE regexp_extract(purl, '://([^/]+)', 1) WHEN 'www.epassport.gov.bd' THEN 'epassport' WHEN 'nidw.gov.bd' THEN 'nid' WHEN 'shop.example.org' THEN 'shop_example_org' ELSE 'sub_unknown' END"
_SVC = "CASE regexp_extract(purl, '://([^/]+)', 1) WHEN 'www.epassport.gov.bd' THEN 'svc.epassport' WHEN 'nidw.gov.bd' THEN 'svc.nid' WHEN 'shop.example.org' THEN 'svc.shop_example_org' ELSE 'svc.sub_unknown' END"
CLAIMS_SQL = rf"""cl AS (SELECT page_id, url AS purl, 'fee' AS t, label AS text, heading_path || ':' || line_no AS loc, {sql_print('label', 'amount', q('BDT'), 'variant')} AS fp FROM fees
UNION ALL SELECT page_id, url, 'step', title, heading_path || ':' || line_no, {sql_print('title', 'description')} FROM steps
UNION ALL SELECT page_id, base, 'document_requirement', text, '', {sql_print('url', 'text')} FROM docs
UNION ALL SELECT f.page_id, p.url, 'faq', question, heading_path || ':' || line_no, {sql_print('question', 'answer')} FROM faqs f JOIN p USING (page_id)),
claims AS (SELECT page_id, t AS claim_type, {_SVC} AS service_id, 'source.' || sha1(purl) AS source_page_id, text, 'claim.' || t || '.' || {_KEY} || '.' || sha1(purl || chr(10) || t || chr(10) || loc || chr(10) || fp)[1:16] AS claim_id FROM cl)"""


@query(f"WITH {PAGES_SQL}, {STEPS_SQL}, {FEES_SQL}, {FAQS_SQL}, {DOCS_SQL}, {CLAIMS_SQL} SELECT page_id, claim_type, service_id, source_page_id, text, claim_id FROM claims")
def page_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims of all pages with their deterministic ids."""
    return extract.claims(pages_of_orders(spark, sf_dir)).select("page_id", "claim_type", "service_id", "source_page_id", "text", "claim_id")


# knowledge base: line items as claims that cite suppliers, orders as entities ---------

CLAIM = "'claim.item.' || l_orderkey || '.' || l_linenumber || '.' || l_partkey || '.' || l_suppkey"
STATUS = "CASE o_orderpriority WHEN '1-URGENT' THEN 'verified' WHEN '2-HIGH' THEN 'stale' WHEN '3-MEDIUM' THEN 'unverified' WHEN '4-NOT SPECIFIED' THEN 'deprecated' ELSE 'contradicted' END"
SITE = "'https://s' || (s_suppkey % 40) || '.example.' || CASE s_suppkey % 3 WHEN 0 THEN 'com' WHEN 1 THEN 'org' ELSE 'net' END || '/p/' || s_suppkey"
SITES_SQL = f"sites AS (SELECT 'source.' || s_suppkey AS source_page_id, s_suppkey AS pos, {SITE} AS canonical_url, s_name AS title, 'agency.n' || s_nationkey AS agency_id FROM supplier)"
FACTS_SQL = f"facts AS (SELECT {CLAIM} AS claim_id, l_orderkey, 'source.' || l_suppkey AS source_page_id, l_linenumber AS pos, o_custkey, o_orderdate, CASE WHEN l_linenumber % 5 = 0 THEN 'verified' ELSE {STATUS} END AS status FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"


def sites(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    return s.select(F.expr("'source.' || s_suppkey").alias("source_page_id"), F.col("s_suppkey").alias("pos"), F.expr(SITE).alias("canonical_url"), F.col("s_name").alias("title"), F.expr("'agency.n' || s_nationkey").alias("agency_id"))


def facts(spark, sf_dir):
    joined = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select(F.expr(CLAIM).alias("claim_id"), "l_orderkey", F.expr("'source.' || l_suppkey").alias("source_page_id"), F.col("l_linenumber").alias("pos"), "o_custkey", "o_orderdate", F.expr(f"CASE WHEN l_linenumber % 5 = 0 THEN 'verified' ELSE {STATUS} END").alias("status"))


@query("""WITH o AS (SELECT o_custkey AS k, min(o_orderkey) AS pos FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), n AS (SELECT o_custkey AS k, min(o_orderkey) AS pos FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1)
SELECT k, pos, 'old' AS origin FROM o UNION ALL SELECT k, pos, 'new' FROM n WHERE k NOT IN (SELECT k FROM o)""")
def claim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert if absent: customers of finished orders, then those of others."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("pos"), "o_orderstatus")
    old = kb.first_wins(o.where("o_orderstatus = 'F'").select("k", "pos"), "k").withColumn("origin", F.lit("old"))
    return kb.insert_absent(old, o.where("o_orderstatus <> 'F'").select("k", "pos", F.lit("new").alias("origin")), "k")


@query("""WITH old AS (SELECT 'source.' || s_suppkey AS id, sha256(s_name) AS h FROM supplier WHERE s_suppkey % 5 <> 0), new AS (SELECT 'source.' || s_suppkey AS id, sha256(CASE WHEN s_suppkey % 3 = 0 THEN upper(s_name) || '!' ELSE s_name END) AS h FROM supplier WHERE s_suppkey % 7 <> 0)
SELECT coalesce(new.id, old.id) AS source_page_id, coalesce(new.h, old.h) AS content_hash, CASE WHEN new.id IS NOT NULL AND old.id IS NOT NULL AND new.h <> old.h THEN old.h END AS previous_hash,
CAST(CASE WHEN new.id IS NOT NULL AND old.id IS NOT NULL AND new.h <> old.h THEN 1 ELSE 0 END AS INT) AS n_log, CASE WHEN new.id IS NOT NULL THEN '2026-01-02' ELSE '2026-01-01' END AS last_crawled_at FROM new FULL JOIN old USING (id)""")
def page_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source pages after a crawl in which some texts changed."""
    s = table(spark, sf_dir, "supplier")
    page = lambda text: [F.expr("'source.' || s_suppkey").alias("source_page_id"), F.expr(SITE).alias("canonical_url"), F.sha2(F.expr(text), 256).alias("content_hash")]
    none = F.array().cast("array<struct<detected_at:string,hash_before:string,hash_after:string>>")
    old = s.where("s_suppkey % 5 <> 0").select(*page("s_name"), F.lit(None).cast("string").alias("previous_hash"), none.alias("change_log"), F.lit("2026-01-01").alias("last_crawled_at"))
    new = s.where("s_suppkey % 7 <> 0").select(*page("CASE WHEN s_suppkey % 3 = 0 THEN upper(s_name) || '!' ELSE s_name END"))
    return kb.upsert_pages(old, new, F.lit("2026-01-02")).select("source_page_id", "content_hash", "previous_hash", F.size("change_log").alias("n_log"), "last_crawled_at")


@query(f"""WITH h AS (SELECT DISTINCT regexp_extract({SITE}, '://([^/]+)', 1) AS host FROM supplier UNION SELECT unnest(['passport.gov.bd', 'www.passport.gov.bd', 'dip.gov.bd', 'www.foo.gov.bd', 'www.bar.org', 'bar.org'])),
b AS (SELECT host, regexp_replace(host, '^www\\.', '') AS bare FROM h),
m AS (SELECT host, bare, CASE WHEN bare IN ('passport.gov.bd', 'dip.gov.bd') THEN 'agency.dip' ELSE 'agency.' || regexp_replace(bare, '[^a-z0-9]', '_', 'g') END AS agency_id FROM b),
d AS (SELECT agency_id, host FROM m UNION SELECT agency_id, bare FROM m WHERE agency_id <> 'agency.dip')
SELECT agency_id, CASE WHEN agency_id = 'agency.dip' THEN 'Old name' ELSE min(regexp_replace(host, '^www\\.', '')) END AS name, CASE WHEN agency_id = 'agency.dip' THEN 'visa.gov.bd,' ELSE '' END || string_agg(host, ',' ORDER BY host) AS domains FROM d GROUP BY agency_id""")
def agency_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agencies of all hosts: mapped ones grow, others are made."""
    old = spark.createDataFrame([("agency.dip", "Old name", ["visa.gov.bd"])], "agency_id string, name string, domain_allowlist array<string>")
    hosts = sites(spark, sf_dir).select(U.domain(F.col("canonical_url")).alias("host")).union(spark.createDataFrame([(x,) for x in ("passport.gov.bd", "www.passport.gov.bd", "dip.gov.bd", "www.foo.gov.bd", "www.bar.org", "bar.org")], "host string"))
    return kb.ensure_agencies(old, hosts).select("agency_id", "name", F.array_join("domain_allowlist", ",").alias("domains"))


@query(f"""WITH {FACTS_SQL} SELECT 'c' || c_custkey AS key, coalesce(string_agg(DISTINCT claim_id, ',' ORDER BY claim_id), '') AS claim_ids FROM customer LEFT JOIN facts ON o_custkey = c_custkey GROUP BY c_custkey
UNION ALL SELECT 'source.' || s_suppkey, coalesce(string_agg(DISTINCT claim_id, ',' ORDER BY claim_id), '') FROM supplier LEFT JOIN facts ON source_page_id = 'source.' || s_suppkey GROUP BY s_suppkey""")
def claim_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims by entity and by source page, with keys that have none."""
    f = facts(spark, sf_dir)
    keys = table(spark, sf_dir, "customer").select(F.expr("'c' || c_custkey").alias("key"))
    pages = table(spark, sf_dir, "supplier").select(F.expr("'source.' || s_suppkey").alias("key"))
    both = kb.index_pairs(keys, f.select(F.expr("'c' || o_custkey").alias("key"), "claim_id")).unionByName(kb.index_pairs(pages, f.select(F.col("source_page_id").alias("key"), "claim_id")))
    return both.select("key", F.array_join("claim_ids", ",").alias("claim_ids"))


@query(f"""WITH {FACTS_SQL}, hit AS (SELECT claim_id FROM facts WHERE status = 'stale' UNION SELECT claim_id FROM facts WHERE source_page_id IN ('source.1', 'source.7'))
SELECT DISTINCT CASE WHEN claim_id IN (SELECT claim_id FROM hit) THEN 'new' ELSE 'old' END || o_custkey AS key, claim_id FROM facts""")
def index_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index pairs after stale claims and those of two pages are indexed anew."""
    f = facts(spark, sf_dir)
    changed = kb.affected_claims(f.where("status = 'stale'"), f, spark.createDataFrame([("source.1",), ("source.7",)], "source_page_id string"))
    return kb.incremental_index(f.select(F.expr("'old' || o_custkey").alias("key"), "claim_id"), changed, f.select(F.expr("'new' || o_custkey").alias("key"), "claim_id"))


@query(f"""WITH {FACTS_SQL}, ch AS (SELECT 'source.' || s_suppkey AS source_page_id, s_suppkey AS pos, sha256('new' || s_suppkey) AS h FROM supplier WHERE s_suppkey % 4 = 0),
b AS (SELECT claim_id, arg_max(h, ch.pos) AS h, arg_min(ch.source_page_id, ch.pos) AS by_ FROM facts JOIN ch USING (source_page_id) GROUP BY claim_id)
SELECT f.claim_id, CASE WHEN h IS NOT NULL AND status IN ('verified', 'unverified', 'stale') THEN 'stale' ELSE status END AS status, CASE WHEN h IS NOT NULL AND status IN ('verified', 'unverified') THEN status END AS previous_status,
CASE WHEN status IN ('verified', 'unverified', 'stale') THEN h END AS stale_due_to_source_hash, CASE WHEN h IS NOT NULL AND status IN ('verified', 'unverified') THEN by_ END AS invalidated_by FROM facts f LEFT JOIN b USING (claim_id)""")
def invalidation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims after a quarter of the source pages changed."""
    f = facts(spark, sf_dir)
    s = table(spark, sf_dir, "supplier")
    page = lambda word: [F.expr("'source.' || s_suppkey").alias("source_page_id"), F.col("s_suppkey").alias("pos"), F.sha2(F.expr(word), 256).alias("content_hash")]
    changed = kb.changed_sources(s.select(*page("'old' || s_suppkey")), s.select(*page("CASE WHEN s_suppkey % 4 = 0 THEN 'new' ELSE 'old' END || s_suppkey")))
    none = F.lit(None).cast("string")
    claims = f.select("claim_id", "status", none.alias("previous_status"), none.alias("stale_marked_at"), none.alias("stale_due_to_source_hash"))
    return kb.invalidate(claims, f, changed, F.lit("2026-01-02")).drop("stale_marked_at")


_EVENT = "CASE event_type WHEN 'click' THEN 'source_change' WHEN 'view' THEN 'verification' ELSE event_type END"


@query(f"""SELECT 'evt.' || sha1({_EVENT} || '|' || event_id || '|' || '{{"claims":["c' || least(event_id, user_id) || '","c' || greatest(event_id, user_id) || '"],"source_pages":["s' || user_id || '"]}}') AS event_id, {_EVENT} AS event_type,
{_EVENT} IN ('source_change', 'claim_invalidation', 'verification', 'migration', 'guide_update') AS known, user_id % 10 = 3 AS has_entity FROM (SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id_, user_id, event_type FROM events)""".replace("least(event_id, user_id)", "least(event_id, user_id_)").replace("greatest(event_id, user_id)", "greatest(event_id, user_id_)"))
def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows of all events, with deterministic ids, and two of their queries."""
    e = table(spark, sf_dir, "events")
    none = F.array().cast("array<string>")
    rows = e.select(F.expr(_EVENT).alias("event_type"), F.col("event_id").cast("string").alias("timestamp"), none.alias("agencies"), F.expr("array('c' || event_id, 'c' || user_id)").alias("claims"), none.alias("documents"), none.alias("services"), F.expr("array('s' || user_id)").alias("source_pages"), F.lit("system").alias("actor"), F.lit("").alias("description"))
    log = kb.audit_rows(rows)
    page = F.regexp_extract(F.get("affected_entities.source_pages", F.lit(0)), "s(.*)", 1).cast("long")
    return log.select("event_id", "event_type", F.col("event_type").isin(*kb.EVENT_TYPES).alias("known"), (page % 10 == 3).alias("has_entity"))


@query("""SELECT event_id, 'type' AS q FROM events WHERE event_type = 'click' UNION ALL SELECT event_id, 'time' FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-05' UNION ALL SELECT event_id, 'actor' FROM events WHERE user_id = 7 UNION ALL SELECT event_id, 'entity' FROM events WHERE user_id = 9""")
def audit_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows by type, time, actor and entity."""
    log = table(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").alias("timestamp"), F.expr("'script:' || user_id").alias("actor"), F.struct(F.expr("array('c' || user_id)").alias("claims")).alias("affected_entities"))
    found = ((kb.by_type(log, "click"), "type"), (kb.by_time(log, "2024-01-02", "2024-01-05"), "time"), (kb.by_actor(log, "script:7"), "actor"), (kb.by_entity(log, "claims", "c9"), "entity"))
    out = [d.select("event_id", F.lit(name).alias("q")) for d, name in found]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query(f"""WITH {FACTS_SQL}, n AS (SELECT o_custkey, count(*) AS n, count_if(status = 'verified') AS v, count_if(status = 'unverified') AS u, count_if(status = 'stale') AS s, count_if(status = 'deprecated') AS d, count_if(status = 'contradicted') AS c FROM (SELECT DISTINCT o_custkey, claim_id, status FROM facts) GROUP BY 1)
SELECT c_custkey AS entity_id, CASE WHEN n IS NULL THEN 'unverified' WHEN v = n THEN 'verified' WHEN d > 0 THEN 'deprecated' WHEN c > 0 THEN 'contradicted' WHEN s > 0 THEN 'stale' WHEN v > 0 AND u > 0 THEN 'partial' ELSE 'unverified' END AS derived FROM customer LEFT JOIN n ON o_custkey = c_custkey""")
def derived_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of every customer from the claims about them."""
    f = facts(spark, sf_dir)
    entities = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity_id"))
    return validate.derived_statuses(entities, f.select(F.col("o_custkey").alias("entity_id"), "claim_id"), f.select("claim_id", "status").distinct())


@query(f"""WITH {SITES_SQL}, {FACTS_SQL} SELECT 'id_pattern' AS rule, 'error' AS severity, 'claim' AS entity, claim_id AS entity_id, '' AS detail FROM facts WHERE NOT regexp_matches(claim_id, '^claim\\.[a-z0-9_.]+')
UNION ALL SELECT 'status', 'error', 'claim', claim_id, '' FROM facts WHERE status = 'unverified' AND pos = 1
UNION ALL SELECT 'unique_id', 'error', 'order', CAST(l_orderkey AS VARCHAR), CAST(count(*) AS VARCHAR) FROM facts GROUP BY l_orderkey HAVING count(*) > 1
UNION ALL SELECT 'source_exists', 'error', 'claim', claim_id, source_page_id FROM facts WHERE source_page_id NOT IN (SELECT source_page_id FROM sites WHERE pos % 6 <> 0)
UNION ALL SELECT 'orphan', 'warning', 'source_page', source_page_id, '' FROM sites WHERE source_page_id NOT IN (SELECT source_page_id FROM facts WHERE status = 'verified' AND pos = 2)""")
def validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of id, status, uniqueness, reference and orphan rules."""
    f, s = facts(spark, sf_dir), sites(spark, sf_dir)
    return validate.union(
        validate.checks(f, "claim", "claim_id", {"id_pattern": ~T.matches(F.col("claim_id"), validate.ID_PATTERNS["claim"]), "status": (F.col("status") == "unverified") & (F.col("pos") == 1)}),
        validate.duplicates(f, "order", "l_orderkey"), validate.dangling(f, "claim_id", "source_page_id", s.where("pos % 6 <> 0"), "source_page_id", "source_exists", "claim"),
        validate.orphans(s, f.where("status = 'verified' and pos = 2")),
    )


@query(f"""WITH {SITES_SQL}, h AS (SELECT source_page_id, agency_id, regexp_extract(canonical_url, '://([^/]+)', 1) AS host FROM sites)
SELECT source_page_id, agency_id, host, CASE WHEN host = 's1.example.org' THEN 'exact' WHEN ends_with(host, '.example.com') THEN 'subdomain' ELSE 'none' END AS match, CASE WHEN host = 's1.example.org' THEN 'S1.example.org.' WHEN ends_with(host, '.example.com') THEN 'example.com' END AS matched FROM h""")
def allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which domain of its agency each source page matches."""
    agencies = table(spark, sf_dir, "nation").select(F.expr("'agency.n' || n_nationkey").alias("agency_id"), F.expr("array('S1.example.org.', 'example.com', 'xample.net')").alias("domain_allowlist"))
    return validate.allowlist(sites(spark, sf_dir), agencies)


@query("""WITH s AS (SELECT l_orderkey AS guide_id, CAST(l_linenumber + CASE WHEN l_partkey % 50 = 0 THEN 1 ELSE 0 END AS INT) AS step_number, l_linenumber AS pos, l_partkey FROM lineitem), e AS (SELECT *, row_number() OVER (PARTITION BY guide_id ORDER BY pos, l_partkey) AS expected FROM s)
SELECT 'duplicate_step' AS rule, 'error' AS severity, 'guide' AS entity, CAST(guide_id AS VARCHAR) AS entity_id, CAST(step_number AS VARCHAR) AS detail FROM s GROUP BY guide_id, step_number HAVING count(*) > 1
UNION ALL SELECT 'sequence', 'error', 'guide', CAST(guide_id AS VARCHAR), CAST(step_number AS VARCHAR) FROM e WHERE step_number <> expected""")
def step_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate and out-of-sequence step numbers."""
    s = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("guide_id"), F.expr("cast(l_linenumber + if(l_partkey % 50 = 0, 1, 0) as int)").alias("step_number"), F.struct("l_linenumber", "l_partkey").alias("pos"))
    return validate.step_numbers(s, pos="pos")


@query(f"""WITH {FACTS_SQL}, {SITES_SQL}, c AS (SELECT l_orderkey, f.claim_id, status, canonical_url, regexp_extract(canonical_url, '://([^/]+)', 1) AS domain FROM facts f LEFT JOIN sites USING (source_page_id))
SELECT l_orderkey AS guide_id, count(DISTINCT claim_id) AS citation_count, count(DISTINCT claim_id) FILTER (status = 'verified') AS verified, count(DISTINCT claim_id) FILTER (status = 'stale') AS stale, string_agg(DISTINCT domain, ',' ORDER BY domain) AS source_domains, string_agg(DISTINCT claim_id || '>' || canonical_url, '|' ORDER BY claim_id || '>' || canonical_url) AS cited, CASE l_orderkey % 2 WHEN 0 THEN 'Even office' END AS agency_name FROM c GROUP BY l_orderkey""")
def published_guides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A guide for each order, with resolved citations and counts."""
    f = facts(spark, sf_dir).dropDuplicates(["claim_id"])
    none = F.array().cast("array<string>")
    guides = f.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("claim_id")).alias("step_claims")).select(F.col("l_orderkey").alias("guide_id"), "step_claims", none.alias("section_claims"), none.alias("variant_claims"), F.col("step_claims").alias("document_claims"), none.alias("fee_claims"), F.lit("svc.x").alias("service_id"), F.expr("'agency.' || (l_orderkey % 2)").alias("agency_id"), F.lit("t").alias("title"))
    claims = f.select("claim_id", F.lit("text").alias("text"), F.lit("step").alias("claim_type"), "status")
    cites = f.select("claim_id", F.lit(0).alias("pos"), "source_page_id", F.lit("quote").alias("quoted_text"), F.col("o_orderdate").cast("string").alias("retrieved_at"))
    agencies = spark.createDataFrame([("agency.0", "Even office")], "agency_id string, name string")
    pages = sites(spark, sf_dir).withColumn("last_crawled_at", F.lit("2026-01-01"))
    out = publish.published(guides, claims, cites, pages, agencies)
    cited = F.array_sort(F.flatten(F.transform("items", lambda i: F.transform(i["citations"], lambda c: c["canonical_url"]))))
    pairs = publish.resolve_citations(publish.guide_claims(guides), cites, pages).select("guide_id", F.explode("citations").alias("c"), "claim_id").groupBy("guide_id").agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(">", "claim_id", "c.canonical_url"))), "|").alias("cited"))
    return out.where(F.size(cited) > 0).join(pairs, "guide_id").select("guide_id", "citation_count", "verified", "stale", F.array_join("source_domains", ",").alias("source_domains"), "cited", "agency_name")


_LBL = "CASE l_partkey % 4 WHEN 0 THEN 'Regular delivery' WHEN 1 THEN 'Super Express delivery' WHEN 2 THEN 'Express delivery' ELSE 'Other' END || ', ' || (CASE WHEN l_linenumber % 2 = 0 THEN 48 ELSE 64 END) || ' page, ' || (5 + 5 * (l_suppkey % 2)) || ' years' || CASE WHEN l_partkey % 9 = 0 THEN ' incl. VAT' ELSE '' END"
_DEL = "CASE l_partkey % 4 WHEN 0 THEN 'regular' WHEN 1 THEN 'super_express' WHEN 2 THEN 'express' END"


@query(f"""WITH f AS (SELECT l_orderkey AS key, l_linenumber * 10000000 + l_partkey * 10 + l_suppkey % 10 AS pos, {_LBL.replace('STRING', 'VARCHAR')} AS label, {_DEL} AS delivery, CASE WHEN l_linenumber % 2 = 0 THEN 48 ELSE 64 END AS pages, 5 + 5 * (l_suppkey % 2) AS years, l_suppkey % 3 > 0 AS preferred, l_shipdate, CAST(l_quantity AS BIGINT) AS amount, l_partkey % 9 = 0 AS vat FROM lineitem),
v AS (SELECT *, max(vat) OVER (PARTITION BY key) AS any_vat FROM f), k AS (SELECT *, row_number() OVER (PARTITION BY key, delivery, pages, years ORDER BY l_shipdate DESC, pos) AS n FROM v WHERE (NOT any_vat OR vat) AND preferred)
SELECT key, label, amount, delivery, CAST(pages AS INT) AS pages, CAST(years AS INT) AS years, CAST(row_number() OVER (PARTITION BY key ORDER BY pages, years, CASE delivery WHEN 'regular' THEN 0 WHEN 'express' THEN 1 WHEN 'super_express' THEN 2 ELSE 3 END, pos) AS INT) AS rank FROM k WHERE n = 1""")
def canonical_fees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fee of each delivery, page count and years of every order."""
    li = table(spark, sf_dir, "lineitem")
    label = F.col("label")
    f = li.select(F.col("l_orderkey").alias("key"), F.expr("l_linenumber * 10000000 + l_partkey * 10 + l_suppkey % 10").alias("pos"), F.expr(_LBL).alias("label"), F.col("l_quantity").cast("long").alias("amount"), F.expr("'https://x.example/' || l_suppkey % 3").alias("url"), F.col("l_shipdate").alias("retrieved_at"))
    f = f.withColumns({"delivery": T.label_delivery(label), "pages": T.label_pages(label), "years": T.label_years(label)})
    return publish.canonical_fees(f, ~F.col("url").endswith("/0"), F.lower(label).contains("vat")).select("key", "label", "amount", "delivery", "pages", "years", "rank")


@query(f"""WITH g AS (SELECT o_orderkey AS guide_id, lower(o_orderpriority || ' order of ' || c_mktsegment || ' ' || c_name || ' ' || n_name) AS t FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey),
w AS (SELECT guide_id, unnest(regexp_split_to_array(t, '{S}+')) AS w, unnest(range(1, len(regexp_split_to_array(t, '{S}+')) + 1)) AS i FROM g), d AS (SELECT guide_id, w, min(i) AS i FROM w WHERE length(w) > 2 GROUP BY 1, 2)
SELECT guide_id, string_agg(w, ' ' ORDER BY i) AS keywords FROM d GROUP BY guide_id""")
def search_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords of a guide for each order, in the order they are seen."""
    g = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(table(spark, sf_dir, "nation")), F.col("n_nationkey") == F.col("c_nationkey"))
    guides = g.select(F.col("o_orderkey").alias("guide_id"), F.expr("o_orderpriority || ' order of'").alias("title"), F.array("c_mktsegment", "c_name").alias("step_titles"), F.col("n_name").alias("agency_name"), F.lit("draft").alias("status"))
    return publish.index_entries(guides).select("guide_id", F.array_join("keywords", " ").alias("keywords"))


_TYPE = "CASE l_partkey % 5 WHEN 0 THEN 'step' WHEN 1 THEN 'fee' WHEN 2 THEN 'rule' WHEN 3 THEN 'processing_time' ELSE 'unheard_of' END"
_SECT = "CASE l_partkey % 5 WHEN 0 THEN 'application_steps' WHEN 1 THEN 'fees' WHEN 3 THEN 'processing_time' ELSE 'service_info' END"


@query(f"""WITH c AS (SELECT l_orderkey AS service_id, {_SECT} AS section, {CLAIM} AS claim_id, CASE WHEN l_suppkey % 3 > 0 THEN l_suppkey ELSE 2147483647 END AS o, l_linenumber AS pos FROM lineitem)
SELECT service_id, section, string_agg(claim_id, ',' ORDER BY o, pos, claim_id) AS claim_ids FROM c GROUP BY 1, 2""")
def guide_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims of every order by guide section, in step order."""
    c = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("service_id"), F.expr(_TYPE).alias("claim_type"), F.expr(CLAIM).alias("claim_id"), F.expr("if(l_suppkey % 3 > 0, cast(l_suppkey as int), null)").alias("step_order"), F.col("l_linenumber").alias("pos"))
    return migrate.guide_sections(c).select("service_id", "section", F.array_join("claim_ids", ",").alias("claim_ids"))


@query(f"""WITH c AS (SELECT l_orderkey AS service_id, coalesce({_DEL}, 'regular') AS variant_id, {CLAIM} AS claim_id, l_linenumber AS pos FROM lineitem)
SELECT service_id, variant_id, CASE variant_id WHEN 'regular' THEN 'Regular' WHEN 'express' THEN 'Express' ELSE 'Super Express' END AS label, string_agg(claim_id, ',' ORDER BY pos, claim_id) AS fee_claim_ids FROM c GROUP BY 1, 2""")
def fee_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fee claims of every order by variant."""
    c = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("service_id"), F.expr(_DEL).alias("delivery_type"), F.expr(CLAIM).alias("claim_id"), F.col("l_linenumber").alias("pos"))
    return migrate.fee_variants(c).withColumn("fee_claim_ids", F.array_join("fee_claim_ids", ","))


@query(f"""WITH {SITES_SQL} SELECT canonical_url AS url, CASE WHEN ends_with(canonical_url, '') AND regexp_matches(canonical_url, '://s1\\.example\\.org/') THEN 'agency.one' WHEN regexp_matches(canonical_url, '\\.example\\.com/') THEN 'agency.com' ELSE 'agency.auto_' || sha1(regexp_extract(canonical_url, '://([^/]+)', 1))[1:12] END AS agency_id FROM sites""")
def agency_of_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The agency of each site's URL, the first whose domains fit."""
    lists = spark.createDataFrame([("agency.one", 0, ["s1.example.org"]), ("agency.com", 1, ["example.com", "s1.example.org"])], "agency_id string, pos int, domain_allowlist array<string>")
    return migrate.agency_of_urls(sites(spark, sf_dir).select(F.col("canonical_url").alias("url")), lists)


@query(f"""WITH s AS (SELECT regexp_extract({SITE}, '://([^/]+)', 1) AS domain, CAST(floor(s_acctbal) AS BIGINT) AS fees, s_suppkey % 7 AS steps FROM supplier) SELECT domain, count(*) AS pages, CAST(sum(fees) AS BIGINT) AS fees, CAST(sum(steps) AS BIGINT) AS steps FROM s GROUP BY ROLLUP (domain)""")
def extraction_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction counters of each domain and over all."""
    s = table(spark, sf_dir, "supplier").select(U.domain(F.expr(SITE)).alias("domain"), F.floor("s_acctbal").alias("fees"), F.expr("s_suppkey % 7").alias("steps"))
    return report.extraction_stats(s, "fees", "steps")


_ERR = "CASE event_id % 5 WHEN 0 THEN 'AUnavailableError' WHEN 1 THEN 'AMapError' WHEN 2 THEN 'AScrapeError' WHEN 3 THEN 'HttpDownloadNotAllowedError' ELSE 'TypeError' END"


@query("""WITH e AS (SELECT event_id % 5 AS k, event_type LIKE '%c%' AS m FROM events) SELECT CASE k WHEN 0 THEN 'scraper_unavailable' WHEN 1 THEN 'map_failed' WHEN 2 THEN 'scrape_failed' WHEN 3 THEN 'download_blocked' ELSE 'unexpected_error' END AS type,
CASE k WHEN 0 THEN CASE WHEN m THEN 'map' ELSE 'scrape' END WHEN 1 THEN 'map' WHEN 2 THEN 'scrape' WHEN 3 THEN 'document_download' ELSE 'unknown' END AS stage, count(*) AS n FROM e GROUP BY 1, 2""")
def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures by type and stage."""
    e = table(spark, sf_dir, "events").select(F.expr(_ERR).alias("name"), F.expr("if(event_type like '%c%', 'the map failed', 'no')").alias("message"))
    return report.failures(e)


@query(f"""WITH {RICH_SQL}, x AS (SELECT {'CASE ' + ' '.join(f"WHEN regexp_matches(lower(url), {q(U.one_end(p))}) THEN {q(p)}" for p in P.EXCLUDE) + ' END'} AS pattern FROM rich) SELECT pattern, count(*) AS n FROM x WHERE pattern IS NOT NULL GROUP BY 1 ORDER BY n DESC, pattern LIMIT 5""")
def exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five exclude patterns that drop most URLs."""
    return frontier.exclusions(rich_pages(spark, sf_dir))


@query(f"""WITH {RICH_SQL}, s AS (SELECT page_id, url, {HOST} AS host, {sql_score('url')} AS score FROM rich), r AS (SELECT *, row_number() OVER (PARTITION BY host, score >= 10 ORDER BY score DESC, length(url), page_id, url) AS n FROM s) SELECT page_id, url, host, CAST(score AS INT) AS score FROM r WHERE n <= CASE WHEN score >= 10 THEN 8 ELSE 4 END""")
def quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight service pages and four others of each host."""
    return frontier.quotas(rich_pages(spark, sf_dir).select("page_id", "url", F.struct("page_id", "url").alias("pos"))).select("page_id", "url", "host", "score")


@query("""WITH d AS (SELECT 'u' || (l_partkey % 700) AS url, 'd' || (l_suppkey % 20) AS domain, sha256(CAST(l_partkey % 500 AS VARCHAR)) AS h, l_orderkey * 10 + l_linenumber AS pos, l_partkey, l_suppkey FROM lineitem),
st AS (SELECT 'u' || s_suppkey AS url, 'd' || (s_suppkey % 20) AS domain, sha256(CAST(s_suppkey AS VARCHAR)) AS h FROM supplier),
f AS (SELECT * FROM d WHERE url NOT IN (SELECT url FROM st) AND (domain, h) NOT IN (SELECT domain, h FROM st)), u AS (SELECT url, arg_min(struct_pack(domain := domain, h := h, pos := pos), pos) AS x FROM f GROUP BY url),
r AS (SELECT url, x.domain AS domain, x.h AS content_hash, x.pos AS pos, row_number() OVER (PARTITION BY x.domain, x.h ORDER BY x.pos, url) AS n FROM u) SELECT url, domain, content_hash, pos FROM r WHERE n = 1""")
def new_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to store: new URL, new content for the domain, first of each."""
    d = table(spark, sf_dir, "lineitem").select(F.expr("'u' || (l_partkey % 700)").alias("url"), F.expr("'d' || (l_suppkey % 20)").alias("domain"), F.sha2(F.expr("cast(l_partkey % 500 as string)"), 256).alias("content_hash"), F.expr("l_orderkey * 10 + l_linenumber").alias("pos"))
    st = table(spark, sf_dir, "supplier").select(F.expr("'u' || s_suppkey").alias("url"), F.expr("'d' || (s_suppkey % 20)").alias("domain"), F.sha2(F.expr("cast(s_suppkey as string)"), 256).alias("content_hash"))
    return report.new_documents(d, st)


_HTML = "html || ' data-session=\"x' || page_id || '\" 2024-01-02T03:04:05+06:00  end'"


@query(f"""SELECT page_id, sha256({_HTML}) AS raw_hash, sha256(regexp_replace({sql_trim(sql_squeeze("regexp_replace(" + _HTML + ", '[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}[Z+-][0-9]{2}:[0-9]{2}', '', 'g')"))}, 'data-session="[^"]*"', '', 'g')) AS normal_hash FROM pages""")
def content_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw and normalised content hash of every page."""
    p = table(spark, sf_dir, "pages").select("page_id", F.expr(_HTML).alias("html"))
    return p.select("page_id", F.sha2("html", 256).alias("raw_hash"), kb.normalized_hash(F.col("html")).alias("normal_hash"))


@query("""WITH f AS (SELECT o_orderkey AS host, o_custkey % 3 AS k FROM orders) SELECT host, CASE k WHEN 2 THEN '' ELSE '/a' END AS allow, CASE k WHEN 0 THEN '/x|/y' WHEN 1 THEN '/x' ELSE '' END AS disallow, 'https://s/' || host AS sitemaps, k <> 1 AS may_z, k = 2 AS may_x FROM f""")
def robots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of a robots file for each order, and two tests of them."""
    text = F.expr("'User-agent: ' || if(o_custkey % 3 = 2, 'other', '*') || '\n Allow: /a \nDisallow: /x\n# Disallow: /c\n' || if(o_custkey % 3 = 1, 'User-agent: bot\n', '') || 'disallow: /y\nSitemap: https://s/' || o_orderkey")
    rules = frontier.parse_robots(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("host"), text.alias("robots"), "o_custkey"))
    k = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("host"), (F.col("o_custkey") % 3).alias("k"))
    may = lambda p: frontier.allowed(F.lit(p), F.col("allow"), F.col("disallow"))
    return rules.join(k, "host").select("host", F.array_join("allow", "|").alias("allow"), F.array_join("disallow", "|").alias("disallow"), F.array_join("sitemaps", "|").alias("sitemaps"), ((F.col("k") != 1) & may("/z")).alias("may_z"), may("/x/1").alias("may_x"))


@query("""SELECT o_orderkey AS host, CASE WHEN o_custkey % 2 = 0 THEN 'index' ELSE 'urls' END AS kind, CASE WHEN o_custkey % 2 = 0 THEN 'https://i/' || o_orderkey ELSE 'https://u/' || o_orderkey || '|https://v' END AS locs FROM orders""")
def sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed sitemap of each order."""
    xml = F.expr("if(o_custkey % 2 = 0, '<sitemapindex><sitemap> <loc> https://i/' || o_orderkey || '</loc></sitemap>', '') || '<urlset><url><loc>https://u/' || o_orderkey || ' </loc></url>\n<url><loc>https://v</loc></url></urlset>'")
    parsed = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("host"), frontier.parse_sitemap(xml).alias("m"))
    return parsed.select("host", "m.kind", F.array_join("m.locs", "|").alias("locs"))


@query(f"""WITH c AS (SELECT CASE WHEN l_partkey % 6 = 0 THEN 'claim.auto_' ELSE 'claim.real_' END || l_orderkey || '_' || l_linenumber || '_' || l_partkey AS claim_id, l_suppkey AS e, l_returnflag AS text, l_orderkey * 100000000 + l_linenumber * 10000000 + l_partkey AS pos FROM lineitem),
r AS (SELECT e, text, arg_min(claim_id, pos) AS new_id FROM c WHERE NOT contains(claim_id, 'auto_') GROUP BY 1, 2) SELECT claim_id AS old_id, new_id FROM c JOIN r USING (e, text) WHERE contains(claim_id, 'auto_')""")
def id_twins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deterministic twin of each claim with a counter id."""
    c = table(spark, sf_dir, "lineitem").select(F.expr("if(l_partkey % 6 = 0, 'claim.auto_', 'claim.real_') || l_orderkey || '_' || l_linenumber || '_' || l_partkey").alias("claim_id"), F.lit("step").alias("claim_type"), F.col("l_suppkey").alias("entity_id"), F.col("l_returnflag").alias("text"), F.expr("l_orderkey * 100000000 + l_linenumber * 10000000 + l_partkey").alias("pos"))
    return migrate.twins(c)


@query(f"""WITH {PAGES_SQL}, g AS (SELECT page_id, line_no, CASE WHEN regexp_matches(line, '(?i)[0-9]+{S}*(?:working{S}+)?(day|week|month|hour)') THEN 'processing_time' WHEN regexp_matches(line, '(?i)eligib|qualif|must be|required to be') THEN 'eligibility_requirement' END AS claim_type, line FROM (SELECT page_id, line_no, is_heading, line || CASE line_no % 3 WHEN 0 THEN ' takes 7 working days' WHEN 1 THEN ' must be valid' ELSE '' END AS line FROM lines) WHERE NOT is_heading)
SELECT page_id, line_no, claim_type, CASE WHEN claim_type = 'processing_time' THEN CAST(regexp_extract(line, '(?i)([0-9]+){S}*(?:working{S}+)?(day|week|month|hour)', 1) AS INT) END AS amount, CASE WHEN claim_type = 'processing_time' THEN lower(regexp_extract(line, '(?i)([0-9]+){S}*(?:working{S}+)?(day|week|month|hour)', 2)) END AS unit, CAST(row_number() OVER (PARTITION BY page_id ORDER BY line_no) AS INT) AS n FROM g WHERE claim_type IS NOT NULL""")
def legacy_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processing times and eligibility lines of all pages."""
    lines = extract.page_lines(pages_of_orders(spark, sf_dir)).withColumn("line", F.expr("line || CASE line_no % 3 WHEN 0 THEN ' takes 7 working days' WHEN 1 THEN ' must be valid' ELSE '' END"))
    return migrate.legacy_lines(lines).select("page_id", F.col("line_no").cast("long").alias("line_no"), "claim_type", "amount", "unit", "n")


from . import rules  # noqa: E402,F401  registers its queries
