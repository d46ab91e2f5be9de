"""Knowledge base operators on small tables."""

from pyspark.sql import functions as F

from sourceloom.operators import frontier, kb, migrate, publish, validate
from sourceloom.sources import store


def test_insert_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1)], "id string, pos int")
    new = spark.createDataFrame([("b", 2), ("b", 1), ("a", 5)], "id string, pos int")
    once = kb.insert_absent(old, new, "id")
    assert sorted(map(tuple, once.collect())) == [("a", 1), ("b", 1)]
    assert kb.insert_absent(once, new, "id").count() == 2


def test_upsert_keeps_or_wipes_history(spark):
    schema = "source_page_id string, canonical_url string, content_hash string, previous_hash string, change_log array<struct<detected_at:string,hash_before:string,hash_after:string>>, last_crawled_at string"
    old = spark.createDataFrame([("s", "u", "h1", "h0", [("t0", "h0", "h1")], "t0")], schema)
    same = spark.createDataFrame([("s", "u", "h1")], "source_page_id string, canonical_url string, content_hash string")
    kept, wiped = (kb.upsert_pages(old, same, F.lit("t1"), keep_history=k).collect()[0] for k in (True, False))
    assert kept.previous_hash == "h0" and len(kept.change_log) == 1 and wiped.previous_hash is None and wiped.change_log == []
    changed = kb.upsert_pages(old, same.withColumn("content_hash", F.lit("h2")), F.lit("t1")).collect()[0]
    assert changed.previous_hash == "h1" and len(changed.change_log) == 2


def test_staleness(spark):
    claims = spark.createDataFrame([("c1", "verified", None, None, None), ("c2", "stale", "verified", "t0", "h0"), ("c3", "deprecated", None, None, None), ("c4", "verified", None, None, None)], "claim_id string, status string, previous_status string, stale_marked_at string, stale_due_to_source_hash string")
    cites = spark.createDataFrame([("c1", "s1"), ("c1", "s2"), ("c2", "s1"), ("c3", "s1"), ("c4", "s3")], "claim_id string, source_page_id string")
    pages = lambda *rows: spark.createDataFrame(list(rows), "source_page_id string, pos int, content_hash string")
    changed = kb.changed_sources(pages(("s1", 0, "a"), ("s2", 1, "a"), ("s3", 2, "a")), pages(("s1", 0, "b"), ("s2", 1, "c"), ("s3", 2, "a")))
    after = {r.claim_id: r for r in kb.invalidate(claims, cites, changed, F.lit("t1")).collect()}
    assert (after["c1"].status, after["c1"].previous_status, after["c1"].stale_due_to_source_hash, after["c1"].invalidated_by) == ("stale", "verified", "c", "s1")
    assert (after["c2"].previous_status, after["c2"].stale_marked_at) == ("verified", "t1") and after["c3"].status == "deprecated" and after["c4"].status == "verified"
    rows = kb.invalidation_event(kb.invalidate(claims, cites, changed, F.lit("t1")), changed, F.lit("t1"), F.lit("system"))
    event = rows.collect()
    assert len(event) == 1 and event[0].affected_entities.claims == ["c1"] and validate.audit_entries(rows).count() == 0


def test_incremental_index_equals_full(spark):
    pairs = spark.createDataFrame([("k1", "c1"), ("k1", "c2"), ("k2", "c3")], "key string, claim_id string")
    current = spark.createDataFrame([("k1", "c1"), ("k2", "c2"), ("k2", "c3")], "key string, claim_id string")
    changed = spark.createDataFrame([("c2",)], "claim_id string")
    assert sorted(map(tuple, kb.incremental_index(pairs, changed, current).collect())) == sorted(map(tuple, current.collect()))


def test_robots_last_agent_decides(spark):
    files = spark.createDataFrame([("h", "User-agent: *\nUser-agent: other\nDisallow: /a\nUser-agent: *\nAllow: /b\nDisallow: /b/c\nSitemap: https://h/s")], "host string, robots string")
    rules = frontier.parse_robots(files).collect()[0]
    assert (rules.allow, rules.disallow, rules.sitemaps) == (["/b"], ["/b/c"], ["https://h/s"])
    test = frontier.parse_robots(files).select(frontier.allowed(F.lit("/b/c/d"), F.col("allow"), F.col("disallow")).alias("x")).collect()[0].x
    assert test is True


def test_locator_union(spark):
    rows = spark.createDataFrame([("xpath", "//a", None, '{"type":"xpath","xpath":"//a"}'), ("xpath", "//a", "x", '{"type":"xpath"}'), ("other", "//a", None, "{}"), ("xpath", "//a", None, '{"type":"xpath","xpath":"//a","z":1}')], "kind string, xpath string, css_selector string, raw string")
    bad = [r.x for r in rows.select(validate.locator_bad(F.col("kind"), {"xpath": F.col("xpath"), "css_selector": F.col("css_selector")}, F.col("raw")).alias("x")).collect()]
    assert bad == [False, True, True, True]


def test_contract_and_schema_rules(spark):
    rows = spark.createDataFrame([("guide.a", "fine"), ("guide.b", "claim.fee.x")], "guide_id string, text string")
    assert [r.entity_id for r in validate.contract(rows).collect()] == ["guide.b"]
    found = validate.schema_rules(rows, "guide_id", {"text": {"pattern": "^f", "minLength": 5}}).collect()
    assert sorted((r.entity_id, r.rule) for r in found) == [("guide.a", "minLength:text"), ("guide.b", "pattern:text")]


def test_rewrite_first_place_only(spark):
    guides = spark.createDataFrame([("g", ["a", "b", "a"])], "guide_id string, claim_ids array<string>")
    renamed = spark.createDataFrame([("a", "z")], "old_id string, new_id string")
    assert migrate.rewrite_ids(guides, renamed).collect()[0].claim_ids == ["z", "b", "a"]


def test_load_and_save(spark, tmp_path):
    path = tmp_path / "kb.json"
    path.write_text('{"$schema_version":"3","data_version":4,"claims":[{"claim_id":"claim.a","citations":[{"source_page_id":"source.x","quoted_text":"q"}]}],"agencies":[]}')
    tables = store.load_kb(spark, str(tmp_path / "none.json"), str(path))
    assert tables["kb_meta"].collect()[0].data_version == 4 and store.claim_citations(tables["claims"]).collect()[0].source_page_id == "source.x"
    target = store.save_kb({"claims": tables["claims"]}, str(tmp_path / "out"), 5)
    assert spark.read.parquet(f"{target}/claims").count() == 1
    assert store.load_kb(spark, str(tmp_path / "none.json"))["claims"].count() == 0
    (tmp_path / "i.json").write_text('{"k":["a","b"]}')
    assert store.load_index(spark, str(tmp_path / "i.json")).count() == 2


def test_canonical_fees_prefer_vat_and_newest(spark):
    rows = [("k", 0, "Regular, 48 page, 5 year incl VAT", 1, "u/p", "2024"), ("k", 1, "Regular, 48 page, 5 year incl VAT", 2, "u/p", "2025"), ("k", 2, "Express, 48 page, 5 year", 3, "u/p", "2025"), ("k", 3, "Express incl vat, 48 page, 5 year", 4, "u/q", "2025")]
    from sourceloom.functions import text as T

    f = spark.createDataFrame(rows, "key string, pos int, label string, amount int, url string, retrieved_at string").withColumns({"delivery": T.label_delivery(F.col("label")), "pages": T.label_pages(F.col("label")), "years": T.label_years(F.col("label"))})
    got = publish.canonical_fees(f, F.col("url") == "u/p", F.lower("label").contains("vat")).collect()
    assert [(r.amount, r.delivery, r["rank"]) for r in got] == [(2, "regular", 1)]
