"""Validators: each rule gives rows (rule, severity, entity, entity_id, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U
from ..functions.text import matches

# Enumerations and id patterns.
CLAIM_STATUS = ("verified", "unverified", "stale", "deprecated", "contradicted")
ENTITY_STATUS = (*CLAIM_STATUS, "partial")
GUIDE_STATUS = ("draft", "published", "archived")
LANGUAGES = ("bn", "en")
PAGE_KINDS = ("main_portal", "instruction", "fee_schedule", "form", "notice", "regulation", "other")
PAGE_STATUS = ("active", "stale", "unreachable", "archived")
ID_PATTERNS = {"agency": r"^agency\.[a-z0-9_]+", "source": r"^source\.[a-f0-9]{40}\z", "claim": r"^claim\.[a-z0-9_.]+", "document": r"^doc\.[a-z0-9_]+", "service": r"^svc\.[a-z0-9_]+", "guide": r"^guide\.[a-z0-9_]+", "event": r"^evt\.[a-f0-9]{40}\z"}


def violations(rows: DataFrame, rule: str, entity: str, entity_id: Column, bad: Column, detail: Column | None = None, severity: str = "error") -> DataFrame:
    return rows.where(F.coalesce(bad, F.lit(False))).select(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), F.lit(entity).alias("entity"), entity_id.cast("string").alias("entity_id"), (detail if detail is not None else F.lit("")).cast("string").alias("detail"))


def union(*found: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), found)


def checks(rows: DataFrame, entity: str, key: str, rules: dict[str, Column], severity: str = "error") -> DataFrame:
    """Row-wise rules {name: violated} in one scan of rows."""
    found = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), name) for name, bad in rules.items()]))
    return rows.select(F.col(key).cast("string").alias("entity_id"), F.explode(found).alias("rule")).select("rule", F.lit(severity).alias("severity"), F.lit(entity).alias("entity"), "entity_id", F.lit("").alias("detail"))


def duplicates(rows: DataFrame, entity: str, key: str, rule: str = "unique_id", severity: str = "error") -> DataFrame:
    many = rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    return violations(many, rule, entity, F.col(key), F.lit(True), F.col("n"), severity)


def dangling(rows: DataFrame, key: str, reference: str, known: DataFrame, known_key: str, rule: str, entity: str, severity: str = "error") -> DataFrame:
    """References to no row of known."""
    lost = rows.where(F.col(reference).isNotNull()).join(known.select(F.col(known_key).alias(reference)).distinct(), reference, "left_anti")
    return violations(lost, rule, entity, F.col(key), F.lit(True), F.col(reference), severity)


def blank(c: str) -> Column:
    return F.col(c).isNull() | (T.trim(F.col(c)) == "")


def agencies(rows: DataFrame) -> DataFrame:
    return union(
        checks(rows, "agency", "agency_id", {"required": blank("agency_id") | blank("name"), "id_pattern": ~matches(F.col("agency_id"), ID_PATTERNS["agency"]), "allowlist": F.coalesce(F.size("domain_allowlist"), F.lit(0)) < 1}),
        duplicates(rows, "agency", "agency_id"),
    )


def source_pages(rows: DataFrame) -> DataFrame:
    c = F.col
    return union(
        checks(rows, "source_page", "source_page_id", {
            **{f"required:{k}": (F.coalesce(F.size(k), F.lit(-1)) < 0) if k == "language" else c(k).isNull() for k in ("source_page_id", "canonical_url", "agency_id", "page_type", "language", "content_hash", "last_crawled_at")},
            "page_type": ~c("page_type").isin(*PAGE_KINDS),
            "id_of_url": c("source_page_id") != T.source_id(c("canonical_url")), "id_pattern": ~matches(c("source_page_id"), ID_PATTERNS["source"]), "scheme": ~U.is_valid(c("canonical_url")),
            "hash": c("content_hash").isNotNull() & ~matches(c("content_hash"), r"^[a-f0-9]{64}\z"), "agency_pattern": ~matches(c("agency_id"), ID_PATTERNS["agency"]),
            "language": F.exists("language", lambda x: ~x.isin(*LANGUAGES)) | (F.size("language") < 1), "status": ~c("status").isin(*PAGE_STATUS),
        }),
        duplicates(rows, "source_page", "source_page_id"), duplicates(rows, "source_page", "canonical_url", "unique_url", "warning"),
    )


def claims(rows: DataFrame, citations: DataFrame, pages: DataFrame) -> DataFrame:
    c = F.col
    cited = citations.select("claim_id").distinct()
    return union(
        checks(rows, "claim", "claim_id", {"id_pattern": ~matches(c("claim_id"), ID_PATTERNS["claim"]), "text": blank("text"), "status": ~c("status").isin(*CLAIM_STATUS), 
            "structured_data": c("claim_type").isin("fee", "processing_time") & c("structured_data").isNull(), "fee_amount": (c("claim_type") == "fee") & c("structured_data").isNotNull() & ~_is(_at("$.amount_bdt", F.col("structured_data")), "number"), "entity_ref": blank("entity_id")}),
        duplicates(rows, "claim", "claim_id"),
        violations(rows.join(cited, "claim_id", "left_anti"), "citations", "claim", c("claim_id"), F.lit(True)),
        checks(citations, "citation", "claim_id", {"source_pattern": ~matches(c("source_page_id"), ID_PATTERNS["source"]), "quoted_text": blank("quoted_text"), "retrieved_at": blank("retrieved_at")}),
        dangling(citations, "claim_id", "source_page_id", pages, "source_page_id", "source_exists", "citation"),
    )


# entities as JSON texts, where a missing member and an empty one differ -----------------


def _at(path: str, raw: Column | None = None, kind: str = "variant") -> Column:
    """A member of the column json, or of raw, as a variant."""
    return F.try_variant_get(F.try_parse_json(raw if raw is not None else F.col("json")), path, kind)


def _is(v: Column, kind: str) -> Column:
    """Whether a variant has a type of JSON Schema; false where it is missing."""
    of = F.schema_of_variant(v)
    tests = {
        "string": of == "STRING", "boolean": of == "BOOLEAN", "array": of.startswith("ARRAY"), "object": of.startswith("OBJECT"), "null": of == "VOID",
        "number": of.isin("BIGINT", "DOUBLE", "FLOAT") | of.startswith("DECIMAL"),
        "integer": (of == "BIGINT") | ((of.isin("DOUBLE", "FLOAT") | of.startswith("DECIMAL")) & (F.try_variant_get(v, "$", "double") % 1 == 0)),
    }
    return F.coalesce(tests[kind], F.lit(False))


def _items(v: Column) -> Column:
    return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array().cast("array<variant>"))


def _empty_list(path: str) -> Column:
    """The member is there, but no list, or one without items."""
    v = _at(path)
    return v.isNotNull() & ~_is(v, "null") & (~_is(v, "array") | (F.size(_items(v)) == 0))


def _text(v: Column) -> Column:
    return _is(v, "string") & (T.trim(F.try_variant_get(v, "$", "string")) != "")


def _free_text(path: str) -> Column:
    v = _at(path)
    return _text(v) | (_is(v, "array") & F.exists(_items(v), _text))


def _missing(path: str) -> Column:
    """Within an item of a list: the member is missing or empty."""
    return lambda item: F.coalesce(F.try_variant_get(item, path, "string"), F.lit("")) == ""


def _entity_rules(required: tuple[str, ...], key: str, pattern: str, texts: tuple[str, ...]) -> dict[str, Column]:
    keys = F.coalesce(F.json_object_keys("json"), F.array().cast("array<string>"))
    status = F.try_variant_get(F.try_parse_json("json"), "$.status", "string")
    return {
        **{f"required:{k}": ~F.array_contains(keys, k) for k in required}, "id_pattern": F.col(key).isNotNull() & ~matches(F.col(key), pattern), "claims": _empty_list("$.claims"),
        **{f"free_text:{k}": _free_text(f"$.{k}") for k in texts}, "status": (status != "") & ~status.isin(*ENTITY_STATUS),
    }


def _identified(rows: DataFrame, key: str) -> DataFrame:
    return rows.select("json", F.get_json_object("json", f"$.{key}").alias(key))


def documents(rows: DataFrame) -> DataFrame:
    """Violations of documents (json): they refer to claims and hold no text."""
    own = _identified(rows, "document_id")
    rules = _entity_rules(("document_id", "document_name", "claims"), "document_id", ID_PATTERNS["document"] + r"\z", ("definition", "how_to_get", "description", "instructions", "eligibility", "steps"))
    return union(checks(own, "document", "document_id", rules), duplicates(own.where("document_id is not null"), "document", "document_id"))


def services(rows: DataFrame) -> DataFrame:
    """Violations of services (json): they refer to claims, pages and entry points."""
    own = _identified(rows, "service_id")
    rules = _entity_rules(("service_id", "service_name", "agency_id", "claims", "portal_mapping", "official_entrypoints"), "service_id", ID_PATTERNS["service"] + r"\z", ("eligibility", "description", "instructions", "steps", "fees", "processing_time"))
    portal, urls, points = _at("$.portal_mapping"), _at("$.portal_mapping.entry_urls"), _at("$.official_entrypoints")
    rules |= {
        "entry_urls": _is(portal, "object") & (F.size(_items(urls)) == 0), "entry_url_fields": F.exists(_items(urls), lambda x: _missing("$.url")(x) | _missing("$.source_page_id")(x)),
        "entrypoints": _empty_list("$.official_entrypoints"), "entrypoint_source": F.exists(_items(points), _missing("$.source_page_id")),
    }
    return union(checks(own, "service", "service_id", rules), duplicates(own.where("service_id is not null"), "service", "service_id"))


def top_level(rows: DataFrame, key: str, version: str = "2.0.0") -> DataFrame:
    """Violations of whole files (key, json): version and the five lists."""
    told = F.get_json_object("json", "$.$schema_version")
    lists = {f"array:{k}": ~_is(_at(f"$.{k}"), "array") for k in ("source_pages", "claims", "agencies", "documents", "services")}
    return checks(rows, "file", key, {"schema_version": F.coalesce(F.try_variant_get(F.try_parse_json("json"), "$['$schema_version']", "string") != version, F.lit(True)) & told.isNull() | (told != version), **lists})


def guide_parts(rows: DataFrame, key: str = "guide_id") -> DataFrame:
    """Violations of the parts of guides (key, json): steps have number, title and claims;
    sections list claim ids; variants have an id and a label; links have label, http URL
    and source."""
    steps_, links = _items(_at("$.steps")), _items(_at("$.official_links"))
    blank_id = lambda x: ~_text(x)
    sections = F.flatten(F.transform(F.coalesce(F.json_object_keys(F.to_json(_at("$.sections"))), F.array().cast("array<string>")), lambda k: _items(F.try_variant_get(_at("$.sections"), F.concat(F.lit("$."), k), "variant"))))
    return checks(rows, "guide", key, {
        "steps": F.size(steps_) == 0, "step_fields": F.exists(steps_, lambda x: _missing("$.step_number")(x) | _missing("$.title")(x) | (F.size(_items(F.try_variant_get(x, "$.claim_ids", "variant"))) == 0)),
        "sections": F.exists(sections, blank_id), "variants": F.exists(_items(_at("$.variants")), lambda x: _missing("$.variant_id")(x) | _missing("$.label")(x)),
        "links": F.size(links) == 0, "link_fields": F.exists(links, lambda x: _missing("$.label")(x) | _missing("$.source_page_id")(x) | ~U.is_valid(F.try_variant_get(x, "$.url", "string"))),
    })


def json_schema(rows: DataFrame, key: str, schema: dict) -> DataFrame:
    """Violations of JSON texts (key, json): required, type, const, pattern, enum, minimum,
    minLength, minItems, properties, items and oneOf (of lists and strings), at any depth;
    a rule is named by kind and path, [] being any item."""

    def rules(v: Column, own: dict, path: str) -> list[Column]:
        there = v.isNotNull()
        text, number = F.try_variant_get(v, "$", "string"), F.try_variant_get(v, "$", "double")
        bad = lambda kind, test: F.when(there & F.coalesce(test, F.lit(False)), F.array(F.lit(f"{kind}:{path}"))).otherwise(F.array().cast("array<string>"))
        found = []
        if "type" in own:
            found.append(bad("type", ~_is(v, own["type"])))
        if "const" in own:
            found.append(bad("const", text != str(own["const"])))
        if "enum" in own:
            found.append(bad("enum", ~text.isin(*map(str, own["enum"]))))
        if "pattern" in own:
            found.append(bad("pattern", _is(v, "string") & ~matches(text, own["pattern"].replace("$", r"\z"))))
        if "minimum" in own:
            found.append(bad("minimum", _is(v, "number") & (number < own["minimum"])))
        if "minLength" in own:
            found.append(bad("minLength", _is(v, "string") & (F.length(text) < own["minLength"])))
        if "minItems" in own:
            found.append(bad("minItems", _is(v, "array") & (F.size(_items(v)) < own["minItems"])))
        if "oneOf" in own:
            fits = [F.size(F.flatten(F.array(*rules(v, one, path)))) == 0 for one in own["oneOf"]]
            found.append(bad("oneOf", reduce(lambda a, b: a + b, [f.cast("int") for f in fits]) != 1))
        for name in own.get("required", ()):
            lost = F.when(_is(v, "object") & F.try_variant_get(v, f"$.{name}", "variant").isNull(), F.array(F.lit(f"required:{path}.{name}")))
            found.append(F.coalesce(lost, F.array().cast("array<string>")))
        for name, inner in own.get("properties", {}).items():
            found += rules(F.try_variant_get(v, f"$.{name}", "variant"), inner, f"{path}.{name}")
        if "items" in own:
            found.append(F.flatten(F.transform(_items(v), lambda x: F.flatten(F.array(*rules(x, own["items"], f"{path}[]"))))))
        return found

    each = rows.select(F.col(key).cast("string").alias("entity_id"), F.explode(F.array_distinct(F.flatten(F.array(*rules(_at("$"), schema, "$"))))).alias("rule"))
    return each.select("rule", F.lit("error").alias("severity"), F.lit("row").alias("entity"), "entity_id", F.lit("").alias("detail"))


def locator_bad(kind: Column, members: dict[str, Column], raw: Column | None = None) -> Column:
    """A locator has its own member, non-empty, and no other; raw is its JSON, for keys
    that no member has."""
    own = F.lit(False)
    for name, value in members.items():
        others = [v.isNotNull() for k, v in members.items() if k != name]
        own = own | ((kind == name) & (value.isNull() | reduce(lambda a, b: a | b, others)))
    bad = ~kind.isin(*members) | own
    if raw is not None:
        bad = bad | F.exists(F.json_object_keys(raw), lambda k: (k != "type") & (k != kind))
    return F.coalesce(bad, F.lit(True))


def orphans(pages: DataFrame, *references: DataFrame) -> DataFrame:
    """Pages that no citation, entry URL or entry point (source_page_id) names."""
    used = reduce(lambda a, b: a.union(b), [r.select("source_page_id") for r in references]).distinct()
    return violations(pages.join(used, "source_page_id", "left_anti"), "orphan", "source_page", F.col("source_page_id"), F.lit(True), severity="warning")


def allowlist(pages: DataFrame, agencies_: DataFrame) -> DataFrame:
    """source_page_id, agency_id, host, match (exact, subdomain or none) and matched
    (the first domain of the agency's allowlist that fits)."""
    hosts = pages.select("source_page_id", "agency_id", U.domain(F.col("canonical_url")).alias("host"))
    joined = hosts.join(agencies_.select("agency_id", "domain_allowlist"), "agency_id", "left")
    fits = F.filter(F.coalesce("domain_allowlist", F.array().cast("array<string>")), lambda d: U.domain_matches(F.col("host"), d))
    matched = F.get(fits, F.lit(0))
    return joined.select("source_page_id", "agency_id", "host", F.when(matched.isNull(), "none").when(U.normal_domain(matched) == F.col("host"), "exact").otherwise("subdomain").alias("match"), matched.alias("matched"))


def derived_status(counts: dict[str, Column], total: Column) -> Column:
    """Status of an entity from how many of its known claims have each status."""
    n = counts
    return (
        F.when(total == 0, "unverified").when(n["verified"] == total, "verified").when(n["deprecated"] > 0, "deprecated").when(n["contradicted"] > 0, "contradicted")
        .when(n["stale"] > 0, "stale").when((n["verified"] > 0) & (n["unverified"] > 0), "partial").otherwise("unverified")
    )


def derived_statuses(entities: DataFrame, links: DataFrame, claims_: DataFrame, key: str = "entity_id") -> DataFrame:
    """key, derived: from links (key, claim_id) and claims (claim_id, status); claims
    without status are unverified, unknown claims don't count."""
    known = links.select(key, "claim_id").distinct().join(claims_.select("claim_id", F.coalesce("status", F.lit("unverified")).alias("status")), "claim_id")
    sums = known.groupBy(key).agg(F.count("*").alias("n"), *[F.count_if(F.col("status") == s).alias(s) for s in CLAIM_STATUS])
    joined = entities.select(key).join(sums, key, "left").na.fill(0)
    return joined.select(key, derived_status({s: F.col(s) for s in CLAIM_STATUS}, F.col("n")).alias("derived"))


def status_consistency(entities: DataFrame, derived: DataFrame, entity: str, key: str = "entity_id") -> DataFrame:
    """Entities that say verified while their claims don't."""
    joined = entities.select(key, "status").join(derived, key)
    return violations(joined, "derived_status", entity, F.col(key), (F.col("status") == "verified") & (F.col("derived") != "verified"), F.col("derived"))


def guides(rows: DataFrame, services: DataFrame, agencies_: DataFrame) -> DataFrame:
    return union(
        checks(rows, "guide", "guide_id", {"required": blank("guide_id") | blank("service_id") | blank("agency_id") | blank("title"), "id_pattern": ~matches(F.col("guide_id"), ID_PATTERNS["guide"]), "status": ~F.col("status").isin(*GUIDE_STATUS)}),
        duplicates(rows, "guide", "guide_id"),
        dangling(rows, "guide_id", "service_id", services, "service_id", "service_exists", "guide"), dangling(rows, "guide_id", "agency_id", agencies_, "agency_id", "agency_exists", "guide"),
    )


def step_numbers(steps: DataFrame, key: str = "guide_id", number: str = "step_number", pos: str | None = None) -> DataFrame:
    """Duplicate numbers (error) and numbers that aren't 1..n in order; without pos the
    order of the numbers (warning), else the order of pos (error)."""
    order = Window.partitionBy(key).orderBy(pos or number)
    wrong = steps.withColumn("expected", F.row_number().over(order)).where(F.col(number) != F.col("expected"))
    many = steps.groupBy(key, number).agg(F.count("*").alias("n")).where("n > 1")
    return union(violations(many, "duplicate_step", "guide", F.col(key), F.lit(True), F.col(number)), violations(wrong, "sequence", "guide", F.col(key), F.lit(True), F.col(number), "error" if pos else "warning"))


def contract(published: DataFrame, key: str = "guide_id") -> DataFrame:
    """Published rows that show internal claim ids, at any depth."""
    text = F.to_json(F.struct("*"))
    return checks(published.select(F.col(key), text.alias("json")), "published", key, {"claim_key": matches(F.col("json"), r'"claim_ids?"\s*:'), "claim_value": matches(F.col("json"), r'"claim\.')})


def audit_entries(log: DataFrame) -> DataFrame:
    from .kb import EVENT_TYPES

    return checks(log, "audit", "event_id", {"event_type": ~F.col("event_type").isin(*EVENT_TYPES), "actor": ~T.is_actor(F.col("actor")), "id_pattern": ~matches(F.col("event_id"), ID_PATTERNS["event"])})


def schema_rules(rows: DataFrame, key: str, rules: dict[str, dict]) -> DataFrame:
    """Rules of a schema by column: required, pattern, enum, minimum, minLength, minItems."""
    bad: dict[str, Column] = {}
    for name, rule in rules.items():
        c = F.col(name)
        for kind, x in rule.items():
            bad[f"{kind}:{name}"] = {"required": lambda: c.isNull(), "pattern": lambda: ~matches(c, x), "enum": lambda: ~c.isin(*x), "minimum": lambda: c < x, "minLength": lambda: F.length(c) < x, "minItems": lambda: F.size(c) < x}[kind]()
    return checks(rows, "row", key, bad)


def valid(found: DataFrame) -> DataFrame:
    """One row: n_errors, n_warnings, valid."""
    counts = found.agg(F.count_if(F.col("severity") == "error").alias("n_errors"), F.count_if(F.col("severity") == "warning").alias("n_warnings"))
    return counts.withColumn("valid", F.col("n_errors") == 0)
