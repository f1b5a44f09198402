import datetime

import pytest
from pyspark.sql import functions as F

from lodestrata import plugins
from lodestrata.operators import chunking, exports, index, ingest, neardup, pipeline, registry, retrieval, rules, search, wiki
from lodestrata.sources import links, parsers
from lodestrata.streaming import incremental

ART = "id string, parent_artifact_id string, artifact_type string, quality_score double, metadata string, created_at int, source_id string"


def arts(spark, rows):
    return spark.createDataFrame([(i, p, k, q, m, n, "s") for n, (i, p, k, q, m) in enumerate(rows)], ART)


def lake(spark):
    rows = []
    for d in "abc":
        rows += [(f"p{d}", None, "parsed_document", None, '{"parse_quality": 0.5}'), (f"k{d}", f" P{d} ".replace("P" + d, "p" + d), "cleaned_document", None, None), (f"e{d}", f"k{d}", "enriched_document", 0.6, None)]
        rows += [(f"u{d}", f"k{d}", "curated_document", 0.9 if d == "a" else 0.1, None), (f"c{d}", f"p{d}", "chunk", None, None)]
    return arts(spark, rows)


def test_contamination_sides_overrides_and_gate(spark):
    a = lake(spark)
    ex = spark.createDataFrame([("ca", '{"question": "q"}'), ("cb", '{"question": "q"}'), ("eb", '{"instruction": "i"}'), (None, '{"question": "q"}'), ("ec", '{"instruction": "i"}'), ("gone", '{"question": "q"}')], "source_artifact_id string, payload string")
    none = spark.createDataFrame([], "cleaned_id string")
    status = lambda *ids: spark.createDataFrame([(x, "near_dup") for x in ids], "cleaned_id string, dedup_status string")
    rows = lambda s, o=none: {r["cleaned_id"]: (r["direct"], r["near_dup"]) for r in exports.contamination(ex, a, s, o).collect()}
    assert rows(status()) == {"ka": (True, False), "kb": (True, False)}
    assert rows(status("kc")) == {"ka": (True, False), "kb": (True, False)}  # only the training side holds one
    assert rows(status("kc", "ka")) == {"ka": (True, True), "kb": (True, False), "kc": (False, True)}
    assert rows(status(), spark.createDataFrame([("ka",)], "cleaned_id string")) == {"kb": (True, False)}
    with pytest.raises(exports.ContaminationError, match="2 documents"):
        exports.require_clean(exports.contamination(ex, a, status(), none))
    exports.require_clean(exports.contamination(ex.limit(0), a, status(), none))


def test_composite_counts_the_filters_passed(spark):
    a = lake(spark)
    ratios = spark.createDataFrame([("pa", 1 / 3), ("pb", 1.0)], "parsed_id string, ratio double")
    got = {r["curated_id"]: r["composite"] for r in exports.composite(a, ratios).collect()}
    assert got == {"ua": pytest.approx(0.15 + 0.24 + 0.1), "ub": pytest.approx(0.69), "uc": pytest.approx(0.39)}
    text = "The people have to be with the group and that is of use to all of them here. " * 12
    docs = spark.createDataFrame([("x", text), ("y", "short"), ("z", None)], "id string, text string")
    results = {r["id"]: {k: v["passed"] for k, v in r["results"].items()} for r in exports.filter_results(docs, id="id").collect()}
    assert set(results) == {"x", "y"} and results["y"] == {"gopher_repetition": True, "gopher_quality": False, "c4_quality": False} and not results["x"]["gopher_repetition"]


def test_recrawl_branches(spark):
    at = lambda d: datetime.datetime(2025, 5, d)
    s = spark.createDataFrame([("new", None, None, None), ("same", "h", at(30), None), ("changed", "g", at(30), None), ("stale", "h", at(1), 5), ("kept", "h", at(1), 90), ("never", "h", None, None)], "id string, last_content_hash string, last_crawled_at timestamp, max_staleness_days int")
    probes = s.select("id", F.lit("h").alias("signature"))
    got = {r["id"]: (r["status"], r["reason"]) for r in exports.recrawl(s, probes, "2025-06-01 00:00:00").collect()}
    skip = ("skipped_unchanged", None)
    assert got == {"new": ("recrawled", "null_hash"), "same": skip, "changed": ("recrawled", "changed"), "stale": ("recrawled", "stale"), "kept": skip, "never": skip}


def test_substance_keys_and_prefixes(spark):
    m = spark.createDataFrame([("{}",), ('{"substance_passed": true}',), ('{"substance_passed": false}',), ('{"substance_passed": null}',), (None,)], "m string")
    assert [r[0] for r in m.select(exports.substance_kept(F.col("m"))).collect()] == [True, True, False, False, True]
    ids = spark.createDataFrame([("chk_aaaa1",), ("chk_aaaa2",), ("chk_b%b",), ("chk_bxb",)], "id string")
    asked = spark.createDataFrame([("chk_aaaa",), ("chk_aaaa1",), ("chk_b%",), ("chk",), ("zzzz",), ("c" * 40,), (None,)], "prefix string")
    got = {r["prefix"]: (r["status"], r["id"]) for r in exports.expanded_prefixes(ids, asked).collect()}
    assert got == {"chk_aaaa": ("ambiguous", None), "chk_aaaa1": ("found", "chk_aaaa1"), "chk_b%": ("found", "chk_b%b"), "chk": ("too_short", None), "zzzz": ("none", None), "c" * 40: ("full", "c" * 40)}


def test_section_rules(spark):
    kind = "array<struct<heading:string,section_path:string,page:int,text:string,is_table:boolean>>"
    prose = "The clerk has to sign the form and to send it with the record of that day."
    texts = [prose, prose + "\nHome", "take 500 mg\nHome", "Home", "1 2 3 4", None]
    rows = [("p", "h", [("h", "1", 1, t, i == 4) for i, t in enumerate(texts)]), ("q", "other", [("h", "1", 1, texts[2], None)])]
    d = spark.createDataFrame(rows, f"parsed_id string, source_id string, sections {kind}")
    sources = spark.createDataFrame([("h", "healthcare"), ("other", "")], "id string, domain string").withColumn("config", F.struct(F.lit(None).cast("string").alias("domain")))
    got = [(r["parsed_id"], r["allowlisted"], r["is_boilerplate"], r["emptied"], r["reason"]) for r in rules.classified_sections(d, sources, allowed=rules.ALLOWED).orderBy("parsed_id", "section_no").collect()]
    assert got == [
        ("p", False, False, False, "substance_ok"), ("p", False, True, False, "boilerplate_pattern_match"), ("p", True, False, False, r"domain_allowlist_match:\d+\s*mg"), ("p", False, True, True, "boilerplate_pattern_match"),
        ("p", False, False, False, "substance_ok"), ("p", False, True, True, "below_token_floor"), ("q", False, True, False, "boilerplate_pattern_match"),
    ]
    assert rules.valid_patterns(["(", "a"]) == ["a"]


def test_hash_is_nfkc_and_keeps_case(spark):
    from lodestrata.functions import text as X

    d = spark.createDataFrame([("A  1 b",), ("Ａ １ b ",), ("a 1 b",), (None,)], "text string")
    h = [r[0] for r in d.select(X.text_hash(F.col("text"))).collect()]
    assert h[0] == h[1] != h[2] and h[3] is None


def test_contributors_put_the_primary_first(spark):
    rows = spark.createDataFrame([("t", 0, "a"), ("t", 1, "b"), ("t", 2, "c")], "text_hash string, ord int, chunk_id string")
    first = lambda p: spark.createDataFrame([("t", p)], "text_hash string, primary_id string")
    assert registry.contributors(rows, most=2, primary=first("c")).first()["contributors"] == "c|a"
    with pytest.raises(Exception, match="none of the text"):
        registry.contributors(rows, most=2, primary=first("x")).collect()


def points(spark):
    rows = [(str(i), ["one", "two", "three"][i % 3] + " word here", "healthcare" if i < 4 else None, 0.1 * i if i else None, ["x", "y"] if i % 2 else [], f"d{i % 2}") for i in range(8)]
    p = spark.createDataFrame(rows, "id string, text string, domain string, quality_score double, tags array<string>, document string")
    return p.join(retrieval.hashed_vectors(p, id="id", text="text"), "id")


def test_search_modes_filters_and_routes(spark):
    p = points(spark)
    q = spark.createDataFrame([(1, "outline of two"), (2, " "), (3, "three")], "query_id int, query string")
    assert {r["query_id"] for r in search.search(p, q, mode="dense", k=2).collect()} == {1, 3}
    assert {r["id"] for r in search.search(p, q, mode="sparse", k=9, domain="healthcare").collect()} == {"1", "2"}
    assert search.filtered(p, min_quality_score=0.0).count() == 7 and search.filtered(p, tags=["x", "z"]).count() == 4 and search.filtered(p, domain=None, tags=[]).count() == 8
    with pytest.raises(ValueError, match="sparse vectors"):
        search.store_search(p.drop("text"), q, mode="hybrid", k=2)
    with pytest.raises(ValueError, match="no such"):
        search.filtered(p, owner="x")
    nodes = spark.createDataFrame([("d1", "1", "The outline"), ("d0", "1", "Rest")], "doc string, section_path string, title string")
    via = lambda **k: {(r["query_id"], r["via"]) for r in search.routed_search(p, nodes, q, k=2, **k).collect()}
    assert via() == {(1, "tree"), (3, "chunk")} and via(route="tree") == {(1, "tree")} and via(route="chunk") == {(1, "chunk"), (3, "chunk")}
    assert {(r["query_id"], r["via"]) for r in search.routed_search(p, nodes.limit(0), q, k=2).collect()} == {(1, "chunk"), (3, "chunk")}


def test_points_refresh_and_parity(spark):
    stored = spark.createDataFrame([("1", "d", "old"), ("2", None, "own")], "id string, document string, domain string")
    merged, found = index.with_payload(stored, spark.createDataFrame([("1", "new"), ("9", "x")], "id string, domain string"), key="id")
    assert {r["id"]: r["domain"] for r in merged.collect()} == {"1": "new", "2": "own"} and {r["id"]: r["found"] for r in found.collect()} == {"1": True, "9": False}
    assert {r["id"]: r["domain"] for r in index.upserted(stored, merged.where("id = '1'"), key="id").collect()} == {"1": "new", "2": "own"}
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "point_id string")
    assert index.parity(ids("a", "b"), ids("a"), ids("b")).first()["parity"] and not index.parity(ids("a", "b"), ids("a"), ids()).first()["parity"] and not index.parity(ids("a"), ids("a", "z"), ids()).first()["parity"]
    with pytest.raises(Exception, match="not in the ledger"):
        index.must_match(ids("a"), ids("b"), key="point_id").collect()


def test_wiki_slugs_and_pages(spark):
    d = spark.createDataFrame([("1", "A b", "11111111x", 1), ("2", "a-B", "22222222x", 2), ("3", "A  B", "22222222y", 3), ("4", None, "4", 4), ("5", "日本", "5", 5)], "id string, title string, digest string, created_at int")
    got = {r["id"]: r["slug"] for r in wiki.slugs(d, id="id", title="title", digest="digest", order=["created_at"]).collect()}
    assert got["1"] == "a-b" and got["2"] == "a-b-22222222" and got["3"].startswith("a-b-") and got["3"] != got["2"] and got["4"] == "document-4" and got["5"] == "untitled"
    docs = spark.createDataFrame([("1", "s", "T", "Lead.", "guide", ["k"], "Src", None), ("2", "r", "", None, None, None, None, "https://x.org")], "id string, slug string, title string, lead string, document_type string, keywords array<string>, source_name string, source_url string")
    linked = spark.createDataFrame([("1", 0, "A|b]]c", "a-b")], "id string, pos int, entity string, concept string")
    pages = {r["id"]: r["page"] for r in wiki.document_pages(docs, linked).collect()}
    assert pages["1"] == "# T\n\n**Type:** guide\n**Source:** Src\n\n## Summary\n\nLead.\n\n## Keywords\n\n`k`\n\n## Related Concepts\n\n- [[a-b|A-bc]]\n"
    assert pages["2"] == "# r\n\n**Type:** unknown\n**Source:** [Unknown](https://x.org)\n"
    lines = wiki.concept_lines(spark.createDataFrame([("c", "E")], "slug string, entity string"), spark.createDataFrame([], "entity string, created_at timestamp, id string, doc_slug string, doc_title string")).orderBy("line_no").collect()
    assert [r["line"] for r in lines] == ["# E", "", "*Concept page for entity: **E***", ""]


def test_ingest_statuses(spark):
    files = spark.createDataFrame([("a", "https://x.org/1", "one"), ("b", "https://x.org/2", "one"), ("c", "HTTPS://Y.org/k/", "two"), ("d", "https://x.org/3", "held"), ("e", None, "three"), ("f", None, None)], "key string, url string, content string")
    known = spark.createDataFrame([("k1", None, "held"), ("k2", "https://y.org/k", None)], "id string, url string, c string").select("id", "url", F.sha2("c", 256).alias("content_hash"))
    got = {r["key"]: (r["status"], r["of"]) for r in ingest.ingest_plan(files, known).collect()}
    assert got == {"a": ("stored", None), "b": ("duplicate_content", "a"), "c": ("existing_url", "k2"), "d": ("duplicate_content", "k1"), "e": ("stored", None), "f": ("empty", None)}


def test_objects_are_written_once(spark, tmp_path):
    folder = str(tmp_path / "raw")
    rows = spark.createDataFrame([("k", "v"), ("k", "v"), ("l", "w")], "key string, body string")
    assert ingest.put_objects(rows, folder).count() == 2 and ingest.put_objects(rows, folder).count() == 0 and spark.read.parquet(folder).count() == 2
    assert ingest.get_objects(spark, folder, rows.where("key = 'k'")).count() == 1
    with pytest.raises(Exception, match="no such object"):
        ingest.get_objects(spark, folder, rows.select(F.lit("zz").alias("key"))).collect()


@pytest.mark.parametrize(("url", "why"), [("https://x.org/", None), ("http://x.org/", "scheme"), ("https://10.0.0.1/", "address"), ("https://[::ffff:10.0.0.1]/", "address"), ("https://8.8.8.8/", None), ("https://localhost/", "host"), (None, "scheme"), ("https://[bad/", "malformed"), ("https://169.254.169.254/", "address")])
def test_addresses(url, why):
    assert ingest.refusal(url) == why


def test_cron():
    at = lambda *x: datetime.datetime(*x, tzinfo=datetime.UTC)
    assert ingest.cron_ticks("0 6 * * 1", at(2025, 6, 2, 6), True) == at(2025, 6, 9, 6) and ingest.cron_ticks("0 6 * * 1", at(2025, 6, 2, 6), False) == at(2025, 6, 2, 6)
    assert ingest.cron_ticks("*/15 0-1 29 2 *", at(2025, 1, 1), True) == at(2028, 2, 29) and ingest.cron_ticks("5,10 3 1 * *", at(2025, 6, 2), False) == at(2025, 6, 1, 3, 10)
    with pytest.raises(ValueError):
        ingest.cron_ticks("@daily", at(2025, 1, 1), True)


def test_due_robots_costs_ids(spark):
    s = spark.createDataFrame([("a", "0 0 * * *", datetime.datetime(2025, 5, 31, 12), None), ("b", "0 0 * * *", datetime.datetime(2025, 6, 1, 0, 30), None), ("c", "nonsense", None, None), ("d", None, None, None)], "id string, crawl_schedule string, last_crawled_at timestamp, created_at timestamp")
    got = {r["id"]: (r["due"], r["run_key"]) for r in ingest.due(s, "2025-06-01T01:00:00").collect()}
    assert got == {"a": (True, "a:2025-06-01T00:00:00+00:00"), "b": (False, None), "c": (False, None)}
    r = spark.createDataFrame([("h", "/x/1", "User-agent: *\nDisallow: /x\nCrawl-delay: 3"), ("h", "y", "User-agent: *\nDisallow: /x"), ("g", "/x", None)], "host string, path string, robots_txt string")
    assert [(x["allowed"], x["delay"]) for x in ingest.robots(r).collect()] == [(False, 3.0), (True, None), (True, None)]
    one = spark.createDataFrame([(datetime.datetime(2025, 1, 1),)], "at timestamp")
    assert one.select(ingest.new_id("chunk", F.col("at"), F.lit("s")).alias("i")).where("i rlike '^chk_[0-9a-f-]{36}$'").count() == 1
    with pytest.raises(ValueError):
        ingest.new_id("thing", F.lit(None), F.lit(1))


@pytest.mark.parametrize(("raw", "out"), [('```json\n{"a": "}"} tail\n```', '{"a": "}"}'), ('{"a": {"b": 1}', '{"a": {"b": 1}'), ('{"a": 1} x {"b": 2} y', '{"a": 1} x {"b": 2}'), ('{"a": "\\"}"}z', '{"a": "\\"}"}'), ("none", "none"), ("", "")])
def test_json_prefix(raw, out):
    assert ingest.closed_prefix(raw) == out


def test_minhash_and_whole_documents(spark):
    d = spark.createDataFrame([(1, "a b c d e f"), (2, "A b  c d e f"), (3, "a b"), (4, ""), (5, None)], "id long, text string")
    got = {r["id"]: r["signature"] for r in neardup.minhash(d, id="id", permutations=8).collect()}
    assert set(got) == {1, 2, 3} and got[1] == got[2] != got[3]
    kind = "array<struct<heading:string,section_path:string,page:int,text:string,is_table:boolean>>"
    docs = spark.createDataFrame([("x", "All of it.", []), ("y", "Other.", None)], f"parsed_id string, text string, sections {kind}")
    assert {(r["doc"], r["section_path"], r["page"], r["text"]) for r in chunking.chunk_sections(docs).collect()} == {("x", "§1", 1, "All of it."), ("y", "§1", 1, "Other.")}


def test_pipeline_and_plugins(spark, tmp_path):
    body = "# H\n\n" + "The clerk signs the form. " * 20
    raw = spark.createDataFrame([("a", body), ("b", body), ("c", "Just a moment... " + "x" * 400), ("d", None), ("e", "# H\n\nHome\n\n" + "Other text here. " * 30)], "id string, raw string").withColumn("mime", F.lit("text/markdown"))
    made, failed = pipeline.run(raw, id="id", content="raw", mime="mime")
    assert {r["id"] for r in made.collect()} == {"a", "e"} and {r["id"] for r in failed.collect()} == {"c", "d"}
    assert "Home" not in made.where("id = 'e'").first()["text"]
    store = plugins.ParquetStore(spark, str(tmp_path / "points"))
    p = points(spark).select("id", "text", "domain", "embedding")
    assert store.count() == 0 and store.dim() is None
    store.upsert(p)
    assert store.count() == 8 and store.dim() == 64 and {r["found"] for r in store.set_payload(spark.createDataFrame([("1", "law"), ("z", "law")], "id string, domain string")).collect()} == {True, False}
    with pytest.raises(ValueError):
        store.upsert(p.withColumn("embedding", F.slice("embedding", 1, 3)))
    plugins.register("vector_store", "folder", store)
    assert plugins.resolve("vector_store", "folder") is store
    for bad, error in ((("parser", "1x", store), ValueError), (("parser", "x", store), TypeError), (("thing", "x", store), ValueError)):
        with pytest.raises(error):
            plugins.register(*bad)
    with pytest.raises(KeyError):
        plugins.resolve("parser", "none")


def test_crawl_statuses(spark):
    u = "https://a.org/"
    edges = spark.createDataFrame([(u, u + "1"), (u, "https://b.org/x"), (u, u + "2"), (u + "1", u + "3"), (u + "2", u + "4")], "url string, link string")
    seeds = spark.createDataFrame([("j", u)], "job string, url string")
    one = lambda x: spark.createDataFrame([(x,)], "url string")
    got = {r["url"][len(u) :]: r["status"] for r in links.crawl_order(edges, seeds, blocked=one(u + "1"), failed=one(u + "9"), done=spark.createDataFrame([("j", u)], "job string, url string")).collect()}
    assert got == {"": "complete", "1": "robots_blocked", "2": "pending", "4": "pending"}
    assert parsers.quality("", []) == 0.0


def test_limits_and_manifest_streams(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([("h", "u1", 0.0, 1.0, False), ("h", "u2", 0.1, 1.0, True), ("h", "u3", 0.2, 1.0, False), ("g", "v1", 5.0, 1.0, False)], "host string, url string, at double, delay double, failed boolean").write.parquet(src)
    stream = spark.readStream.schema("host string, url string, at double, delay double, failed boolean").parquet(src)
    incremental.run_available(incremental.host_limits(stream), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert {r["url"]: r["start"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"u1": 0.0, "u2": 1.0, "u3": 31.0, "v1": 5.0}
    root, pages = str(tmp_path / "manifest"), str(tmp_path / "pages")
    for k, rows in enumerate(([("a", "1"), ("b", "1")], [("a", "1")], [("a", "2"), ("c", "1")])):
        spark.createDataFrame(rows, "key string, digest string").write.mode("append").parquet(pages)
        incremental.manifest_updates(spark.readStream.schema("key string, digest string").parquet(pages), root, str(tmp_path / "ck2"))
        from lodestrata.sources.sinks import current

        assert current(spark, root) == ["v1", "v1", "v2"][k]
    assert {tuple(r) for r in spark.read.parquet(f"{root}/v2").select("key", "digest").collect()} == {("a", "2"), ("b", "1"), ("c", "1")}
