"""Extraction from small pages written for these tests."""

from pyspark.sql import functions as F

from sourceloom.functions import text as T
from sourceloom.functions import urls as U
from sourceloom.operators import extract

PAGE = """# Main **page**
#### Deep
### Middle
## Side
1. Apply online at the office. Bring papers.
- Submit the form today
- plain bullet without verb... no
## Express delivery
Fee: 3,450 BDT and ৳ 5000
## Other
TK 100 for all
১,০০,০০০ টাকা
Q: What is the fee?
A: It is the usual fee.
Another answer begins with a.
## How long does it take?
It takes about ten days to get it.

More text that is long enough to pass fifty characters, surely.

Not part of it.
[form](files/a.pdf) and [again](/x/files/a.pdf) and [page](b.html)
"""


def pages(spark, *texts):
    return spark.createDataFrame([(i, "https://www.epassport.gov.bd/x/page", t, None) for i, t in enumerate(texts)], "page_id long, url string, markdown string, html string")


def test_heading_path_is_a_stack_by_depth(spark):
    found = extract.headings(extract.page_lines(pages(spark, PAGE))).orderBy("line_no").collect()
    assert [r.heading_path for r in found][:4] == ["Main page", "Main page > Deep", "Main page > Deep > Middle", "Main page > Side"]


def test_steps_in_order(spark):
    found = extract.steps(extract.page_lines(pages(spark, PAGE))).orderBy("step_no").collect()
    assert [(r.step_no, r.marker) for r in found] == [(1, "ordered_list"), (2, "bullet_imperative")]
    assert found[0].title == "Apply online at the office." and found[0].description.endswith("papers.")


def test_fees_and_sticky_variant(spark):
    found = extract.fees(extract.page_lines(pages(spark, PAGE), sticky=True)).orderBy("line_no", "pos").collect()
    assert [(r.amount, r.variant) for r in found] == [(3450, "express"), (5000, "express"), (100, "express")]


def test_questions(spark):
    p = pages(spark, PAGE)
    found = extract.faqs(extract.page_lines(p, below=True)).orderBy("line_no", "pos").collect()
    assert [(r.form, r.question) for r in found] == [("pair", "What is the fee?"), ("pair", "What is the fee?"), ("heading", "How long does it take?")]
    assert found[1].answer == "nother answer begins with a." and "Not part" not in found[2].answer


def test_documents_once_each(spark):
    found = extract.document_links(pages(spark, PAGE)).collect()
    assert [(r.url, r.text, r.method) for r in found] == [("https://www.epassport.gov.bd/x/files/a.pdf", "form", "markdown_link")]


def test_claims_are_deterministic_and_empty_pages_give_none(spark):
    p = pages(spark, PAGE, None, "")
    one, two = ({r.claim_id for r in extract.claims(p).collect()} for _ in range(2))
    assert one == two and all(c.startswith(("claim.fee.epassport.", "claim.step.epassport.", "claim.faq.epassport.", "claim.document_requirement.epassport.")) for c in one)
    assert {r.page_id for r in extract.claims(p).collect()} == {0}


def one(spark, column):
    return spark.range(1).select(column.alias("x")).collect()[0].x


def test_text_and_url_functions(spark):
    lit = F.lit
    assert one(spark, T.number(lit("৩,৪৫০"))) == 3450 and one(spark, T.number(lit(""))) is None
    assert one(spark, T.trim(lit("  x\t "))) == "x"
    assert one(spark, T.fingerprint(lit(" A\n  B "))) == "a b"
    assert one(spark, T.label_amount(lit("4025"))) == 402
    assert one(spark, T.slug(lit("My Service!"), "svc")) == "svc.my_service"
    assert one(spark, T.variant_label(lit("super_express"))) == "Super Express"
    base = lit("https://h.org/a/b/c.html?q=1")
    for ref, want in {"d.pdf": "https://h.org/a/b/d.pdf", "../d": "https://h.org/a/d", "/x/./y/../z": "https://h.org/x/z", "//k.org/p": "https://k.org/p", "?z=2": "https://h.org/a/b/c.html?z=2", "http://o.org/": "http://o.org/"}.items():
        assert one(spark, U.resolve(base, lit(ref))) == want
    assert one(spark, U.depth(lit("no url"))) == 999 and one(spark, U.extension(lit("https://h.org/.pdf"))) == ""
    assert one(spark, U.priority(lit("https://h.org/login"))) == -999 and one(spark, U.priority(lit("https://h.org/"))) == 2
    for host, allowed, want in (("example.com", "example.com", True), ("a.b.example.com", "example.com", True), ("evil-example.com", "example.com", False), ("other.org", "example.com", False), ("example.com", "a.example.com", False), ("", "example.com", False), ("EXAMPLE.com", "Example.COM.", True)):
        assert one(spark, U.domain_matches(lit(host), lit(allowed))) is want
    entities = lambda *ids: {"claims": F.array(*map(lit, ids)), "agencies": F.array().cast("array<string>")}
    a, b = (one(spark, T.event_id(lit("migration"), lit("t"), entities(*ids))) for ids in (("x", "y"), ("y", "x")))
    assert a == b and len(a) == 44
    assert one(spark, T.is_actor(lit("script:a b"))) is False and one(spark, T.is_actor(T.actor(lit("a b")))) is True
