"""Sources and sinks: what is written is read back; missing and broken files are empty."""

import json

from pyspark.sql import functions as F

from sourceloom.operators import report
from sourceloom.sources import store


def test_state_round_trip(spark, tmp_path):
    one = {"domainStates": {"a.gov.bd": {"lastCrawled": "2026-01-01", "pagesCrawled": 3, "sitemapUrls": ["s"]}}, "pageHashes": {"source.1": "h1", "source.2": "h2"}, "documentHashes": {"u": "d"}}
    (tmp_path / "state.json").write_text(json.dumps(one, indent=2))
    state = store.load_state(spark, str(tmp_path / "state.json"))
    assert {(r.source_page_id, r.content_hash) for r in state["page_hash"].collect()} == {("source.1", "h1"), ("source.2", "h2")}
    store.save_state(state, str(tmp_path / "again"), F.lit("2026-01-02"))
    again = store.load_state(spark, str(tmp_path / "again"), lines=True)
    for name, df in state.items():
        assert sorted(map(str, df.collect())) == sorted(map(str, again[name].collect()))
    (tmp_path / "broken.json").write_text("{ not json")
    for path in ("missing.json", "broken.json"):
        assert all(df.count() == 0 for df in store.load_state(spark, str(tmp_path / path)).values())
        assert store.load_seeds(spark, str(tmp_path / path)).count() == 0


def test_seeds_index_and_links(spark, tmp_path):
    (tmp_path / "seeds.json").write_text(json.dumps({"seeds": [{"label": "L", "domain": "d.gov.bd", "start_urls": ["https://d.gov.bd"]}, {"domain": "e"}]}))
    assert [(r.pos, r.domain) for r in store.load_seeds(spark, str(tmp_path / "seeds.json")).orderBy("pos").collect()] == [(0, "d.gov.bd"), (1, "e")]
    (tmp_path / "index.json").write_text(json.dumps({"svc.a": ["c1", "c2"], "svc.b": []}))
    assert {tuple(r) for r in store.load_index(spark, str(tmp_path / "index.json")).collect()} == {("svc.a", "c1"), ("svc.a", "c2")}
    raw = spark.createDataFrame([('["u1", "u2"]',), ('{"links": [{"url": "u3"}]}',), ('{"urls": ["u4"]}',)], "raw string")
    assert [r.x for r in raw.select(store.scraped_links(F.col("raw")).alias("x")).collect()] == [["u1", "u2"], ["u3"], ["u4"]]


def test_kb_versions(spark, tmp_path):
    whole = {"$schema_version": "3.0.0", "data_version": 4, "last_updated_at": "2026-01-05", "source_pages": [], "claims": [], "agencies": [{"agency_id": "agency.a", "name": "A", "domain_allowlist": ["a"]}], "documents": [], "services": []}
    (tmp_path / "kb.json").write_text(json.dumps(whole))
    tables = store.load_kb(spark, str(tmp_path / "none.json"), str(tmp_path / "kb.json"))
    target = store.save_kb(tables, str(tmp_path / "out"))
    assert target.endswith("/v5") and spark.read.parquet(f"{target}/kb_meta").first().data_version == 5 and spark.read.parquet(f"{target}/agencies").count() == 1
    at = lambda given, meta: spark.range(1).select(store.generated_at(given, meta).alias("x")).first().x
    assert at("2025", tables["kb_meta"]) == "2025" and at(None, tables["kb_meta"]) == "2026-01-05" and at(None, tables["kb_meta"].limit(0)).endswith("Z")
    guides = spark.createDataFrame([("guide.a", "T")], "guide_id string, title string")
    row = store.export_guides(guides, F.lit("2025"), 5).first()
    assert json.loads(row.json) == {"guide_id": "guide.a", "title": "T"} and (row.generated_at, row.source_kb_version, row.schema_version) == ("2025", 5, "3.0.0")


def test_files_and_snapshots(spark, tmp_path):
    (tmp_path / "files").mkdir()
    (tmp_path / "files" / "a.pdf").write_bytes(b"abc")
    (tmp_path / "files" / "big.pdf").write_bytes(b"x" * 100)
    assert [r.length for r in store.read_files(spark, str(tmp_path / "files"), most_bytes=50).collect()] == [3]
    pages = spark.createDataFrame([("source.1", "text")], "source_page_id string, markdown string")
    for day in ("2026-01-01", "2026-01-02"):
        store.save_snapshots(pages, str(tmp_path / "snaps"), F.lit(day))
    assert spark.read.parquet(str(tmp_path / "snaps")).where("snapshot_date = '2026-01-02'").count() == 1


def test_run_report(spark, tmp_path):
    domains = spark.createDataFrame([("a", "crawled", None), ("b", "failed", "timeout"), ("c", "failed", "timeout")], "domain string, status string, reason string")
    pages = spark.createDataFrame([("kept", 3, 1, 1, 0, 1), ("excluded", 0, 0, 0, 0, 0)], "outcome string, claims int, steps int, fees int, faqs int, links int")
    documents = spark.createDataFrame([("http",)], "fetched_via string")
    summary = report.run_summary(domains, pages, documents)
    got = {r.what: r.n for r in summary.collect()}
    assert got["domains_attempted"] == 3 and got["domains_failed"] == 2 and got["pages_kept"] == 1 and got["claims_extracted"] == 3 and got["documents_fetched_via_http"] == 1
    assert [tuple(r) for r in report.reasons(domains, "failed").collect()] == [("timeout", 2)]
    errors = spark.createDataFrame([(i, f"m{i}") for i in range(80)], "pos int, message string")
    path = report.save_report(summary, errors, str(tmp_path), "2026-01-02", "run_1", "t0", "t1")
    row = spark.read.json(path).first()
    assert row.run_id == "run_1" and len(row.errors) == 50 and row.errors[0].message == "m0" and row.summary.claims_extracted == 3
