import json
import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from lodestrata.functions import text as X
from lodestrata.operators import chunking, neardup, rules
from lodestrata.operators.retrieval import dense_topk
from lodestrata.runtime import running_totals, skew_safe_lookup
from lodestrata.sources import links, parsers, replay, sinks
from lodestrata.streaming import incremental


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "text string").select(expr(F.col("text"))).first()[0]


@pytest.mark.parametrize(("raw", "clean"), [("Home\nbody text  \n\n\n\nmore ", "body text\n\nmore"), ("Page 1 of 5\nx", "x"), (" a\n", "a"), ("", "")])
def test_boilerplate(spark, raw, clean):
    assert one(spark, X.remove_boilerplate, raw) == clean


def test_urls_slugs_leads(spark):
    assert one(spark, X.normalize_url, "HTTPS://me@Ex.ORG:443/A/b//?q=1#f") == "https://ex.org:443/A/b?q=1"
    assert one(spark, X.normalize_url, "http://EX.org/") == "http://ex.org/"
    assert one(spark, X.slugify, "Çafé & Bar!") == "af-bar"
    assert one(spark, X.slugify, "日本") == "untitled"
    assert one(spark, lambda c: X.truncate_lead(c, 12), "One two. Three four") == "One two...."
    assert one(spark, lambda c: X.truncate_lead(c, 30), "short") == "short"


def test_point_id_is_uuid5(spark):
    space = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"
    assert one(spark, lambda c: X.point_id(c, space), "ab12") == str(uuid.uuid5(uuid.UUID(space), "ab12"))


def test_gate_boundaries(spark):
    for text, code in [("", "below_token_floor"), ("one two", "below_token_floor"), ("1 2 3 4", "below_alpha_ratio"), ("red green blue", "all_checks_passed"), ("cat dog fox hen owl bat.", "below_stopword_ratio"), ("the cat and the dog sat", "below_terminal_punct")]:
        assert one(spark, rules.substance_code, text) == code


def test_repetition_rules():
    assert rules.repetition_code(None) is None
    assert rules.repetition_code("a b\n\na b\n\na b") == "dup_paragraph_frac"
    assert rules.repetition_code("every word here is different from all the others") is None


def test_lookup_and_totals_under_skew(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    table = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("v", F.col("k") * 2)
    got = skew_safe_lookup(rows, table, ["k"], "n", 5000)
    assert got.count() == 5000 and got.where("v <> k * 2").count() == 0
    totals = running_totals(rows.withColumn("one", F.lit(1)), ["k"], ["id"], "one", "t")
    assert totals.groupBy("k").agg((F.max("t") == F.count("t")).alias("ok"), (F.countDistinct("t") == F.count("t")).alias("u")).where("not ok or not u").count() == 0
    assert running_totals(rows.limit(0).withColumn("one", F.lit(1)), ["k"], ["id"], "one", "t").count() == 0


def test_near_dup_flags_every_member(spark):
    base = " ".join(f"w{i}" for i in range(200))
    docs = spark.createDataFrame([(1, base), (2, base + " extra"), (3, " ".join(f"z{i}" for i in range(200))), (4, None), (5, "")], "id long, text string")
    assert {r["id"]: r["status"] for r in neardup.near_dup_status(docs, id="id").collect()} == {1: "near_dup", 2: "near_dup", 3: "unique", 4: "unique", 5: "unique"}


def test_near_dup_classes_are_whole(spark):
    rng = random.Random(1)
    base = [[f"b{k}w{i}" for i in range(120)] for k in range(40)]
    rows, footer = [], " ".join(f"f{i}" for i in range(40))
    for k, words in enumerate(base):
        for v in range(4):
            changed = list(words)
            for at in rng.sample(range(120), [0, 1, 2, 4][v]):
                changed[at] = f"x{k}v{v}a{at}"
            rows.append((k * 10 + v, " ".join(changed) + (" " + footer if k % 2 else "")))
    rows += [(900, rows[0][1]), (901, None), (902, "a b"), (903, "A  b")]
    split = lambda t: (t or "").lower().split()
    sets = {i: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} for i, t in rows if (w := split(t))}
    want = {i: i for i, _ in rows}
    linked = [(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    for _ in rows:
        for a, b in linked:
            want[a] = want[b] = min(want[a], want[b])
    got = {r["id"]: r for r in neardup.near_dup_status(spark.createDataFrame(rows, "id long, text string"), id="id").collect()}
    assert {i: r["class_id"] for i, r in got.items()} == want and len(linked) > 60
    sizes = Counter(want.values())
    assert all((r["status"] == "near_dup") == (sizes[want[i]] > 1) for i, r in got.items())
    chain = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(-5, -3), (40, 7)], "a long, b long")
    assert {r["node"]: r["label"] for r in neardup.components(chain).collect()} == {i: 1 for i in range(1, 41)} | {-5: -5, -3: -5}
    empty = spark.createDataFrame([], "id long, text string")
    assert neardup.near_dup_status(empty, id="id").count() == 0


def test_chunks_cover_all_sentences():
    text = " ".join(f"Sentence number {i} says a little more here." for i in range(200))
    chunks = chunking.pack_sentences(text, 60, 12)
    assert all(f"number {i} says" in " ".join(chunks) for i in range(200)) and all(chunking.tokens(c) <= 60 for c in chunks)
    assert chunking.pack_sentences("") == []


def test_dense_topk(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [0.0, 1.0]), (3, None)], "vec_id long, embedding array<float>")
    assert [(r["id"], r["rank"]) for r in dense_topk(df, df.where("vec_id = 0"), k=2).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert dense_topk(df, df.limit(0), k=2).count() == 0


def test_parsers():
    text, title, sections = parsers.parse_html("<title>T</title><nav>Menu</nav><h1>A &amp; B</h1><p>One<script>x()</script> two</p><h2>C</h2><table><tr><td>1</td><td>2</td></tr></table>")
    assert title == "T" and [s[0] for s in sections] == ["A & B", "C"] and sections[1][4] and "Menu" not in text
    assert parsers.parse_json('{"b": "x", "n": 1, "a": ["y", {"z": " "}]}')[0] == "x\ny"
    assert parsers.parse_xml('<r xmlns="u"><a>1</a>t</r>')[0] == "1\nt"
    assert parsers.parse("{bad", "application/json")[3:] [0] == "text/plain"
    assert parsers.parse(None, None)[5] == "empty"
    assert links.links('<a href="/b#x">b</a><a href="https://other.org/">o</a><a href="c.png">c</a>', "https://s.ex.org/a") == ["https://s.ex.org/b"]


def test_parse_documents_and_replay(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(json.dumps({"url": "https://x.org/", "mime": "text/html", "content": "<h1>H</h1><p>" + "word " * 80 + "</p>"}) + "\n")
    replay.register(spark)
    pages = spark.read.format("page_replay").load(str(tmp_path))
    row = parsers.parse_documents(pages, id="url", content="content", mime="mime").first()
    assert row["parser"] == "text/html" and row["sections"][0]["heading"] == "H" and row["error"] is None
    seeds = spark.createDataFrame([("j", "https://a.org/1")], "job string, url string")
    edges = spark.createDataFrame([("https://a.org/1", "https://a.org/2"), ("https://a.org/2", "https://a.org/3"), ("https://a.org/3", "https://a.org/4")], "url string, link string")
    assert {(r["url"][-1], r["level"]) for r in links.crawl_order(edges, seeds).collect()} == {("1", 0), ("2", 1), ("3", 2)}


def test_versions_and_exports(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = spark.range(3).withColumnRenamed("id", "key")
    assert sinks.current(spark, root) is None and sinks.publish(rows, root, "key") == "v1" and sinks.publish(rows, root, "key") == "v2"
    with pytest.raises(ValueError):
        sinks.publish(rows.union(rows), root, "key")
    assert sinks.current(spark, root) == "v2"
    assert sinks.write_messages(spark.createDataFrame([("q", "a")], "prompt string, completion string"), str(tmp_path / "m")) == 1


def test_streams_agree_with_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([("a  b", "2024-01-01 00:00:00"), ("a b", "2024-01-01 00:01:00"), ("c", "2024-01-01 00:02:00")], "text string, at string").select("text", F.to_timestamp("at").alias("at")).write.parquet(src)
    stream = spark.readStream.schema("text string, at timestamp").parquet(src)
    incremental.run_available(incremental.new_texts(stream, text="text", at="at"), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_contract_names_agree():
    assert set(contract.oracle_sql()) <= set(contract.queries())
