"""Extraction from Markdown pages: lines, headings, steps, fees, questions, document
links and the claims made of them.

A page is cut into sections at its headings and these into a row for each line. What a
line needs from above (heading path, sticky fee variant) or from below (the lines of an
answer) is worked out within the page's row, so cutting pages shuffles nothing; only the
steps found are numbered by a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from ..functions import urls as U
from ..functions.text import BENGALI_DIGITS, EDGE, S, matches, trim

HEADING = rf"^(#{{1,6}}){S}+(.+)"


#: What begins a question and an answer; the mark behind the word is optional.
QUESTION = rf"^(?:(?i:Q)[.:]?{S}*|প্রশ্ন[.:]?{S}*)"
ANSWER = rf"^(?:(?i:A)[.:]?{S}*|উত্তর[.:]?{S}*)"
#: Lines below a question in which its answer is looked for.
BELOW = 19


def _asks(heading: Column) -> Column:
    return heading.endswith("?") | heading.endswith("？")


def _sections(heads: Column, sticky: bool) -> Column:
    """array<struct<i,heading,path,sticky>> from the headings struct<i,level,text> in
    order: a heading of level n keeps the first n-1 entries of the path before it."""
    none = F.array().cast("array<struct<i:int,heading:string,path:array<string>,sticky:string>>")
    start = F.struct(F.array().cast("array<string>").alias("path"), F.lit(None).cast("string").alias("sticky"), none.alias("out"))

    def step(state, h):
        path = F.concat(F.slice(state["path"], F.lit(1), h["level"] - 1), F.array(h["text"]))
        variant = F.coalesce(T.fee_variant(h["text"]), state["sticky"]) if sticky else F.lit(None).cast("string")
        return F.struct(path.alias("path"), variant.alias("sticky"), F.concat(state["out"], F.array(F.struct(h["i"].alias("i"), h["text"].alias("heading"), path.alias("path"), variant.alias("sticky")))).alias("out"))

    first = F.struct(F.lit(0).alias("i"), F.lit(None).cast("string").alias("heading"), F.array().cast("array<string>").alias("path"), F.lit(None).cast("string").alias("sticky"))
    return F.concat(F.array(first), F.aggregate(heads, start, step)["out"])


def page_lines(pages: DataFrame, key: str = "page_id", text: str = "markdown", carry: tuple[str, ...] = (), sticky: bool = False, below: bool = False) -> DataFrame:
    """key, columns to carry, line_no (from 1), line (trimmed), is_heading, heading (text
    or null), path (of the last heading so far); with sticky the fee variant that
    headings so far have set; with below the lines under one that asks something."""
    base = pages.select(key, *carry, F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), trim).alias("all"))
    head = lambda x, i: F.when(matches(x, HEADING), F.struct(i.alias("i"), F.length(F.regexp_extract(x, HEADING, 1)).alias("level"), trim(F.replace(F.regexp_extract(x, HEADING, 2), F.lit("**"), F.lit(""))).alias("text")))
    cut = base.select(key, *carry, "all", _sections(F.array_compact(F.transform("all", head)), sticky).alias("sections"))
    end = lambda k: F.coalesce(F.get(F.col("sections"), k + 1)["i"], F.size("all"))

    def section(x, k):
        def line(y, j):
            is_heading = (j == 0) & x["heading"].isNotNull()
            asked = F.when((is_heading & _asks(x["heading"])) | (~is_heading & matches(y, QUESTION)), F.slice("all", x["i"] + j + 2, F.lit(BELOW))) if below else F.lit(None).cast("array<string>")
            return F.struct((x["i"] + j + 1).alias("line_no"), y.alias("line"), is_heading.alias("is_heading"), asked.alias("below"))

        return F.struct(x["heading"].alias("heading"), x["path"].alias("path"), x["sticky"].alias("sticky"), F.transform(F.slice("all", x["i"] + 1, end(k) - x["i"]), line).alias("lines"))

    parts = cut.select(key, *carry, F.explode(F.transform("sections", section)).alias("x"))
    lines = parts.select(key, *carry, "x.path", "x.sticky", F.col("x.heading").alias("title"), F.explode("x.lines").alias("y"))
    out = lines.select(key, *carry, "y.line_no", "y.line", "y.is_heading", F.when(F.col("y.is_heading"), F.col("title")).alias("heading"), "path", "sticky", "y.below")
    return out.drop(*([] if sticky else ["sticky"]), *([] if below else ["below"]))


def headings(lines: DataFrame, key: str = "page_id") -> DataFrame:
    return lines.where("is_heading").select(key, "line_no", "heading", F.array_join("path", " > ").alias("heading_path"))


def step_mark(line: Column) -> Column:
    """struct(marker, number) of a line, marker null where it is no step."""
    numbered = F.regexp_extract(line, rf"^([0-9]+)[.):]{S}*.+", 1)
    bengali = F.regexp_extract(line, rf"^([{BENGALI_DIGITS}]+)[.)।:]{S}*.+", 1)
    words = f"(?:{'|'.join(P.STEP_WORDS)})"
    marked = matches(line, rf"^{words}{S}*[-:{T.SPACE}]*(?:[0-9]+|[{BENGALI_DIGITS}]+)") | matches(line, rf"^[{BENGALI_DIGITS}]+[.)।:]{S}*") | matches(line, rf"^(?:{'|'.join(P.STEP_ADVERBS)}){EDGE}")
    any_number = T.number(F.regexp_extract(line, rf"[0-9]+|[{BENGALI_DIGITS}]+", 0))
    bengali_action = "|".join([rf"{w}{S}*[।.]*\z" for w in P.BENGALI_ENDINGS] + [rf"{a}{S}*{b}" for a, b in P.BENGALI_ACTIONS])
    english_action = rf"(?i){EDGE}(?:{'|'.join(P.ENGLISH_ACTIONS)}){EDGE}".replace(r"\s", S)
    bullet = F.regexp_extract(line, rf"^[-•–*]{S}*(.+)", 1)
    mark = lambda name, n: F.struct(F.lit(name).alias("marker"), n.cast("double").alias("number"))
    none = F.lit(None).cast("double")
    return (
        F.when(F.coalesce(numbered.try_cast("double") > 0, F.lit(False)), mark("ordered_list", numbered.try_cast("double")))
        .when(F.coalesce(T.number(bengali) > 0, F.lit(False)), mark("bengali_ordered", T.number(bengali)))
        .when(marked, mark("bengali_step_marker", any_number))
        .when((bullet != "") & (matches(bullet, bengali_action) | matches(bullet, english_action)), mark("bullet_imperative", none))
        .when(T.has_bengali(line) & matches(line, bengali_action), mark("bengali_imperative", none))
        .otherwise(F.struct(F.lit(None).cast("string").alias("marker"), none.alias("number")))
    )


def steps(lines: DataFrame, key: str = "page_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """key, carried columns, step_no (1..n), title, description, text, heading_path, line_no, marker."""
    found = lines.where(~F.col("is_heading") & (F.length("line") > 5)).withColumn("mark", step_mark(F.col("line"))).where("mark.marker is not null").withColumn("text", T.bare_step(F.col("line"))).where(F.length("text") >= 5)
    own = F.when(F.col("mark.number") > 0, F.col("mark.number"))
    above = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    numbered = found.withColumn("order", F.coalesce(own, F.sum(F.when(own.isNull(), 1)).over(above).cast("double")))
    title = T.step_title(F.col("text"))
    return numbered.withColumn("step_no", F.row_number().over(Window.partitionBy(key).orderBy("order", "line_no"))).select(
        key, *carry, "step_no", F.substring(title, 1, 150).alias("title"), F.when(F.length("text") > F.length(title), F.substring("text", 1, 500)).otherwise("").alias("description"), "text", F.array_join("path", " > ").alias("heading_path"), "line_no", F.col("mark.marker").alias("marker")
    )


def fees(lines: DataFrame, key: str = "page_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """key, carried columns, pos, amount, label, variant, currency, text, heading_path,
    line_no; lines are page_lines with sticky."""
    first = lambda p: F.nullif(F.regexp_extract("line", p, 1), F.lit(""))
    after = first(rf"(?i)([0-9]{{1,7}}(?:,[0-9]{{3}})*){S}*(?:{P.CURRENCY})")
    sign = first(rf"৳{S}*([0-9]{{1,7}}(?:,[0-9]{{3}})*)")
    before = F.when(after.isNull(), first(rf"(?i){EDGE}(?:{P.CURRENCY}){S}*([0-9]{{1,7}}(?:,[0-9]{{3}})*)"))
    bengali_sign = first(rf"৳{S}*([{BENGALI_DIGITS}]{{1,7}}(?:,[{BENGALI_DIGITS}]{{3}})*)")
    bengali_after = first(rf"([{BENGALI_DIGITS}]{{1,7}}(?:,[{BENGALI_DIGITS}]{{3}})*){S}*টাকা")
    amounts = F.array_distinct(F.filter(F.transform(F.array_compact(F.array(after, sign, before, bengali_sign, bengali_after)), T.number), lambda a: (a > 0) & (a <= P.MAX_AMOUNT)))
    found = lines.where(~F.col("is_heading") & (F.col("line") != "")).select("*", F.posexplode(amounts).alias("pos", "amount"))
    fallback = F.coalesce(F.try_element_at("path", F.lit(-1)), F.lit("Fee"))
    return found.select(
        key, *carry, "pos", F.col("amount").cast("long").alias("amount"), T.fee_label(F.col("line"), fallback).alias("label"), F.coalesce(T.fee_variant(F.col("line")), "sticky").alias("variant"), F.lit("BDT").alias("currency"), F.substring("line", 1, 200).alias("text"), F.array_join("path", " > ").alias("heading_path"), "line_no"
    )


def faqs(lines: DataFrame, key: str = "page_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """key, carried columns, form (heading, pair or link), question, answer, link,
    heading_path, line_no, pos (of answers to one question); lines are page_lines with
    below."""

    def gather(state, x):
        stop = state["stop"] | matches(x, rf"^#{{1,6}}{S}") | ((x == "") & (F.length(state["answer"]) > 50))
        more = F.when(x == "", state["answer"]).when(state["answer"] == "", x).otherwise(F.concat(state["answer"], F.lit(" "), x))
        return F.struct(stop.alias("stop"), F.when(stop, state["answer"]).otherwise(more).alias("answer"))

    asked = lines.where(F.col("is_heading") & _asks(F.col("heading")))
    answer = F.aggregate("below", F.struct(F.lit(False).alias("stop"), F.lit("").alias("answer")), gather)["answer"]
    parent = F.array_join(F.slice("path", F.lit(1), F.size("path") - 1), " > ")
    none = F.lit(None).cast("string")
    by_heading = asked.withColumn("answer", answer).where(F.length("answer") > 10).select(key, *carry, F.lit("heading").alias("form"), F.col("heading").alias("question"), F.substring("answer", 1, 1000).alias("answer"), none.alias("link"), parent.alias("heading_path"), "line_no", F.lit(0).alias("pos"))

    plain = lines.where(~F.col("is_heading"))
    questions = plain.where(matches(F.col("line"), QUESTION)).withColumn("question", trim(F.regexp_replace("line", QUESTION, ""))).where(F.length("question") > 5)
    after = F.transform(F.filter(F.slice("below", 1, 9), lambda x: matches(x, ANSWER)), lambda x: trim(F.regexp_replace(x, ANSWER, "")))
    pairs = questions.select(key, *carry, "question", "path", "line_no", F.posexplode(after).alias("pos", "answer")).where(F.length("answer") > 5)
    path = F.array_join("path", " > ")
    by_pair = pairs.select(key, *carry, F.lit("pair").alias("form"), "question", F.substring("answer", 1, 1000).alias("answer"), none.alias("link"), path.alias("heading_path"), "line_no", "pos")

    bullet = trim(F.regexp_replace("line", rf"^[-•*]{S}*", ""))
    link = r"\[([^\]]+\?[^\]]*)\]\(([^)]+)\)"
    by_link = plain.where(matches(F.col("line"), "^[-•*]")).withColumn("bullet", bullet).where(matches(F.col("bullet"), link)).select(key, *carry, F.lit("link").alias("form"), F.regexp_extract("bullet", link, 1).alias("question"), none.alias("answer"), F.regexp_extract("bullet", link, 2).alias("link"), path.alias("heading_path"), "line_no", F.lit(0).alias("pos"))
    return by_heading.unionByName(by_pair).unionByName(by_link)


def document_links(pages: DataFrame, key: str = "page_id", url: str = "url", markdown: str = "markdown", html: str = "html") -> DataFrame:
    """key, pos, text, url, extension, method; the first of a URL on a page counts, by
    method in the order markdown_link, bare_url, html_href, html_download, php_download."""
    md, page = F.coalesce(F.col(markdown), F.lit("")), F.coalesce(F.col(html), F.lit(""))
    ends = r"\.(?:pdf|docx?|xlsx?|pptx?)"
    every = lambda src, p, g: F.regexp_extract_all(src, F.lit(p), F.lit(g))
    entry = lambda texts, links, method: F.transform(F.arrays_zip(texts.alias("t"), links.alias("u")), lambda x: F.struct(x["t"].alias("text"), x["u"].alias("link"), F.lit(method).alias("method")))
    named = lambda links, text: F.transform(links, lambda _: F.lit(text))
    pair = r"\[([^\]]+)\]\(([^)]+)\)"
    bare = every(md, rf'(?i)(https?://[^{T.SPACE}<>"]+{ends}(?:\?[^{T.SPACE}<>"]*)?)', 1)
    href = every(page, rf"""(?i)href=["']([^"']+{ends}(?:\?[^"']*)?)""", 1)
    down = F.filter(every(page, r"""(?i)href=["']([^"']*(?:download|attachment|file)[^"']*)["']""", 1), lambda x: ~x.endswith(".js") & ~x.endswith(".css"))
    php = every(page, r"""(?i)href=["']([^"']*\.php\?[^"']*(?:id|file|doc)=[^"']*)["']""", 1)
    found = F.concat(entry(every(md, pair, 1), every(md, pair, 2), "markdown_link"), entry(bare, bare, "bare_url"), entry(named(href, "Document link"), href, "html_href"), entry(named(down, "Download link"), down, "html_download"), entry(named(php, "Download"), php, "php_download"))
    rows = pages.select(key, F.col(url).alias("base"), F.posexplode(found).alias("pos", "x")).withColumn("url", U.resolve(F.col("base"), F.col("x.link"))).withColumn("extension", U.extension(F.col("url")))
    wanted = F.col("extension").isin(*P.DOCUMENT_EXTENSIONS) | ((F.col("extension") == "") & (matches(F.col("url"), "(?i)download|attachment|file|document") | matches(F.col("url"), "(?i)[?&](?:id|file|doc|attachment)=")))
    first = rows.where(wanted).groupBy(key, "url").agg(F.min_by(F.struct("x.text", "x.method", "extension"), "pos").alias("x"), F.min("pos").alias("pos"))
    return first.select(key, "pos", F.substring("x.text", 1, 200).alias("text"), "url", F.when(F.col("x.extension") == "", ".unknown").otherwise(F.col("x.extension")).alias("extension"), F.col("x.method").alias("method"))


def claims(pages: DataFrame, key: str = "page_id", url: str = "url", markdown: str = "markdown", html: str = "html") -> DataFrame:
    """All claims of the pages, with deterministic ids: claim_id, claim_type,
    service_id, source_page_id, url, text, locator, quoted_text, language, tags,
    status, key, rank (type) and pos in their order."""
    pages = pages.withColumn("__url", F.col(url))
    own = ("__url",)
    lines = page_lines(pages, key, markdown, own, sticky=True, below=True)
    host = U.domain(F.col("__url"))
    spot = F.concat(F.col("heading_path"), F.lit(":"), F.col("line_no").cast("string"))
    word = lambda c: F.when(T.has_bengali(c), "bengali").otherwise("english")
    nothing = F.lit("")
    about = pages.select(key, "__url")

    def made(rows, kind, rank, text, locator, print_, quoted, tags, pos):
        return rows.select(key, "__url", F.lit(kind).alias("claim_type"), F.lit(rank).alias("rank"), pos.cast("long").alias("pos"), text.alias("text"), locator.alias("locator"), print_.alias("print"), F.substring(quoted, 1, 300).alias("quoted_text"), tags.alias("tags"))

    fee, step, faq, link = fees(lines, key, own), steps(lines, key, own), faqs(lines, key, own), document_links(pages, key, url, markdown, html).join(about, key)
    c = F.col
    all_ = (
        made(fee, "fee", 0, c("label"), spot, T.joined_fingerprint(c("label"), c("amount"), c("currency"), c("variant")), c("text"), F.array_compact(F.array(F.lit("fee"), F.lit("auto_extracted"), c("variant"))), c("line_no") * 10 + c("pos"))
        .unionByName(made(step, "step", 1, c("title"), spot, T.joined_fingerprint(c("title"), c("description")), c("text"), F.array(F.lit("step"), F.lit("auto_extracted"), word(c("text"))), c("step_no")))
        .unionByName(made(link, "document_requirement", 2, c("text"), nothing, T.joined_fingerprint(c("url"), c("text")), c("text"), F.array(F.lit("document"), F.lit("download"), F.lit("auto_extracted")), c("pos")))
        .unionByName(made(faq, "faq", 3, c("question"), spot, T.joined_fingerprint(c("question"), c("answer")), c("question"), F.array(F.lit("faq"), F.lit("auto_extracted"), word(c("question"))), c("line_no") * 100 + c("pos")))
    )
    service = U.service_id(host)
    return all_.select(
        T.claim_id(c("claim_type"), U.key_of_service(service), c("__url"), c("locator"), c("print")).alias("claim_id"), "claim_type", service.alias("service_id"), T.source_id(c("__url")).alias("source_page_id"), c("__url").alias("url"), "text", "locator", "quoted_text", T.language(c("quoted_text")).alias("language"), "tags", F.lit("unverified").alias("status"), key, "rank", "pos"
    )
