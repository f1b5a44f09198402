from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lodestrata.llm import boilerplate, furniture, leakage, mixing, packing, pairs, quality, repeated_lines, sentences, splitting
from lodestrata.llm.queries import oracle_sql, queries

SECTIONS = "array<struct<heading:string,section_path:string,page:int,text:string,is_table:boolean>>"
DOCS = f"parsed_id string, source_id string, text string, title string, sections {SECTIONS}, doc string, line string"


def docs(spark, rows):
    made = [(i, s, t, h, None if x is None else [(None, "§1", 1, y, k) for y, k in x], "clash", "clash") for i, s, t, h, x in rows]
    return spark.createDataFrame(made, DOCS)


def pages(spark):
    rows = [(f"p{i}", "s" if i % 4 else None, f"Home\nSkip to content\n\n# Title {i}\n\n{chr(97 + i) * 4} says this and that.\nShare this page: mail", f"Title {i}", [("Same  LINE\nown line %d" % i, None), ("same line", False), (None, None), ("x" * 1600, i % 2 == 0)]) for i in range(12)]
    return docs(spark, [*rows, rows[1], ("empty", "s", None, None, None), ("blank", "s", "", None, [])])


def test_boilerplate(spark):
    df = pages(spark)
    got = {tuple(r) for r in boilerplate.furniture_lines(df).collect()}
    assert got == {(f"p{i}", n) for i in range(12) for n in (0, 1, 6)}
    body = {r["page"]: r["body"] for r in boilerplate.main_body(df).collect()}
    assert body["p3"] == "# Title 3\n\ndddd says this and that." and body["empty"] == "" and len(body) == 14
    assert boilerplate.furniture_lines(df.limit(0)).count() == 0


def test_boilerplate_without_phrases(spark):
    """Lines that no phrase list knows come out because they recur as lines; what body texts share stays."""
    rng = __import__("random").Random(4)
    words = ["".join(rng.choice("bdfgklm") + rng.choice("aeiou") for _ in range(4)) for _ in range(400)]
    rows, want = [], set()
    for i in range(60):
        body = [" ".join(["the office keeps", *rng.sample(words, 30), "and the office keeps", *rng.sample(words, 9)]) + "." for _ in range(3)]
        lines = ["Xanthe quorl", "Vimble torvo", "", f"# {words[i]} {words[i + 1]}", "", *body, f"Zorble wexit {i} frap the lorn dup", "", "## Spare heading", " ".join(rng.sample(words, 12)) + ".", f"Drum gax lim {words[i]} of pex tor vell"]
        want |= {(f"p{i}", n) for n in (0, 1, 8, 12)}
        rows.append((f"p{i}", f"h{i % 3}", "\n".join(lines), f"{words[i]} {words[i + 1]}", [("x", None)]))
    made = docs(spark, rows).withColumn("sections", F.transform("sections", lambda s: s.withField("heading", F.lit("Spare heading"))))
    got = {tuple(r) for r in boilerplate.furniture_lines(made.unionByName(made.limit(9)), notices=False).collect()}
    assert got == want


def test_ranks_agree_with_tokens():
    streams = boilerplate.Streams()
    streams.add(0, boilerplate.tokens(["a b c d e f g", "a b c d e f h", "x"]))
    streams.add(1, boilerplate.tokens(["x", "a b c"]))
    levels = {n: r for n, r in zip((3, 6), (r for _, r in streams.ranks()))}
    a, b, x, y, c = streams.starts
    assert levels[3][a] == levels[3][b] == levels[3][c] and levels[6][a] == levels[6][b] != levels[6][c] and levels[3][x] == levels[3][y] != levels[3][a]


def test_recurring_lines(spark):
    df = pages(spark)
    lines = repeated_lines.section_lines(df, doc="parsed_id", source="source_id")
    got = {tuple(r) for r in repeated_lines.recurring_lines(lines, df.select("source_id", F.col("parsed_id").alias("doc"))).select("doc", "section_no", "line_no").collect()}
    seen = defaultdict(set)
    rows = {r["parsed_id"]: r for r in df.collect() if r["source_id"]}
    fold = lambda x: " ".join(x.split()).lower()
    for k, r in rows.items():
        for s in r["sections"] or []:
            for x in (s["text"] or "").split("\n"):
                seen[fold(x)].add(k)
    want = {(k, n, m) for k, r in rows.items() for n, s in enumerate(r["sections"] or []) for m, x in enumerate((s["text"] or "").split("\n")) if fold(x) and len(seen[fold(x)]) >= 3}
    assert got == want and want
    clean = {(r["doc"], r["section_no"]): r["text"] for r in repeated_lines.without_recurring_lines(df).collect()}
    assert clean["p1", 0] == "own line 1" and clean["p1", 1] == "" and clean["p4", 0].startswith("Same")
    assert repeated_lines.recurring_lines(lines.limit(0), df.limit(0).select("source_id", F.col("parsed_id").alias("doc"))).count() == 0


def test_splitting(spark):
    df = pages(spark)
    got = splitting.split_sections(df)
    assert got.where("not is_table and length(text) > 1500").count() == 0
    assert {r["doc"] for r in got.where("n_pieces > 1").collect()} == {f"p{i}" for i in range(1, 12, 2)}
    assert splitting.split_sections(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        splitting.split_sections(df, overlap=1500)


def test_quality(spark):
    df = docs(spark, [(f"d{i}", "s", "", None, [("The clerk signs the form and the office keeps a copy of it.", None), ("a\tb\n1\t2" if i % 2 else "- the form\n- a copy", True), ("", None), (None, None)]) for i in range(20)])
    got = {(r["doc"], r["section_no"]): r["kind"] for r in quality.not_prose(df.unionByName(df.limit(3))).collect()}
    assert got == {(f"d{i}", n): k for i in range(20) for n, k in ((1, "table" if i % 2 else "list"), (2, "junk"), (3, "junk"))}
    ranks = quality.outlier_scores(quality.section_statistics(df)).toPandas()
    for s in quality.STATISTICS:
        assert (ranks.groupby("lang")[s].rank(method="max", pct=True) - ranks[f"{s}_rank"]).abs().max() < 1e-12
    assert quality.not_prose(df.limit(0)).count() == 0


def test_quality_of_a_language_without_prose(spark):
    for text, kind in (("- the form\n- a copy", "list"), ("a\tb\n1\t2", "table"), ("", "junk")):
        df = docs(spark, [(f"d{i}", "s", "", None, [(text, None)] * 10) for i in range(100)])
        assert [tuple(r) for r in quality.not_prose(df).groupBy("kind").count().collect()] == [(kind, 1000)]


def test_leaks(spark):
    run = " ".join(f"w{i}" for i in range(20))
    items = spark.createDataFrame([(1, run, None), (2, "short one", run + " tail"), (2, "short one", run + " tail"), (None, run, run)], "item_id long, question string, answer string")
    corpus = spark.createDataFrame([("a", f"intro {run} end"), ("b", " ".join(f"w{i}" for i in range(11))), ("c", None), ("d", f"X {' '.join(f'W{i}' for i in range(3, 16))}"), ("a", f"intro {run} end")], "doc string, text string")
    got = {(r["item_id"], r["doc"], r["field"]) for r in leakage.leaked_items(corpus, items, doc="doc", text="text").collect()}
    assert got == {(1, "a", "question"), (2, "a", "answer"), (1, "d", "question"), (2, "d", "answer")}
    small = {(r["item_id"], r["doc"], r["field"]) for r in leakage.leaked_items(corpus, items, doc="doc", text="text", built_bytes=900).collect()}
    assert small == got  # in rounds
    assert leakage.leaked_items(corpus, items.limit(0), doc="doc", text="text").count() == 0
    assert leakage.leaked_items(corpus.limit(0), items, doc="doc", text="text").count() == 0


def test_packing(spark):
    rows = [(i, (i * 37) % 700 + 1) for i in range(400)] + [(1000, 2500), (1001, 1000), (1002, 0), (1003, None), (5, (5 * 37) % 700 + 1)]
    got = packing.packed(spark.createDataFrame(rows, "id long, size long"), item="id", size="size", capacity=1000, rounds=30).toPandas()
    assert got.groupby("item").length.sum().to_dict() == {i: s or 0 for i, s in rows}
    used = got[got.length > 0].groupby("container").length.sum()
    assert used.max() <= 1000 and len(used) <= 1.06 * used.sum() / 1000 + 2
    assert set(got[got.piece_no > 0].item) == {1000} | ({1001} & set(got[got.piece_no > 0].item))
    assert packing.packed(spark.createDataFrame([], "id long, size long"), item="id", size="size").count() == 0


def test_mixing(spark):
    rows = [(i, "a", "x" * 10) for i in range(50)] + [(100 + i, "b", "é" * 5) for i in range(5)] + [(200, None, "zz"), (201, "other", None)]
    d = spark.createDataFrame(rows, "doc_id long, source string, text string")
    t = spark.createDataFrame([("a", 0.3, 20), ("b", 0.6, 3), ("none", 0.1, 2), ("a", 0.3, 20)], "source string, target_share double, max_repeats int")
    for most_local in (10, 0):
        plan = mixing.mixture_plan(d, t, most_local=most_local)
        got = {r["source"]: r for r in plan.collect()}
        assert got["b"]["falls_short"] and got["none"]["falls_short"] and not got["a"]["falls_short"]
        assert got["b"]["repeats"] == 3 and got["a"]["budget"] == 552 - 150 and got["none"]["budget"] == 0 and abs(sum(r["actual_share"] for r in got.values()) - 1) < 1e-9
    taken = mixing.mixed_documents(d.unionByName(d.limit(7)), plan, block=100).toPandas()
    assert (taken[taken.source == "b"].groupby("id").size() == 3).all() and 0 <= taken[taken.source == "a"]["size"].sum() - got["a"]["budget"] < 10
    assert sorted(taken.position) == list(range(1, len(taken) + 1)) and not taken.duplicated(["id", "pass_no"]).any()
    assert taken.sort_values("position").block_no.is_monotonic_increasing and taken.block_no.nunique() == 6
    shares = taken[taken.source == "b"].groupby("block_no")["size"].sum()
    assert shares.max() <= 30 + 20 and len(shares) == 6  # every block holds its part
    assert mixing.mixture_plan(d.limit(0), t).count() == 3 and mixing.mixture_plan(d, t.limit(0)).count() == 0


def test_mixing_tempers_to_the_limits(spark):
    rows = [(i, "a", "x" * 10) for i in range(90)] + [(100 + i, "b", "y" * 10) for i in range(10)] + [(200 + i, "c", "z" * 10) for i in range(4)]
    d = spark.createDataFrame(rows, "doc_id long, source string, text string")
    t = spark.createDataFrame([("a", 0.4, 5), ("b", 0.1, 2), ("c", 0.5, 2)], "source string, target_share double, max_repeats int")
    plans = [{r["source"]: r for r in mixing.mixture_plan(d, t, most_local=k).collect()} for k in (10, 0)]
    for got in plans:
        assert got["c"]["budget"] == 80 and 0 < got["b"]["exponent"] < 1.0 or got["b"]["budget"] <= 200
        assert abs(sum(r["budget"] for r in got.values()) - 1040) <= 3
        assert all(r["budget"] <= r["held"] * r["max_repeats"] for r in got.values())
    assert {s: r["budget"] for s, r in plans[0].items()} == {s: r["budget"] for s, r in plans[1].items()}
    low = {r["source"]: r for r in mixing.mixture_plan(d, t, target_entropy=0.4).collect()}
    x = [low[s]["tempered_share"] for s in "ab"]
    assert abs(mixing.entropy(dict(enumerate(x))) - 0.4) < 1e-3


def test_pairs_and_sentences(spark):
    e = spark.createDataFrame([("1", '{"question": "Who?", "answer": ""}'), ("1", '{"question": "Who?", "answer": ""}'), ("2", None), (None, "{}"), ("3", '{"question": "Who?", "answer": "a deputy"}')], "id string, payload string")
    assert {tuple(r) for r in pairs.defective_pairs(e).select("id", "defect").collect()} == {("1", "empty"), ("2", "empty")}
    d = spark.createDataFrame([(1, "One. Two."), (1, "One. Two."), (2, None), (3, " ")], "doc_id long, text string")
    assert {tuple(r) for r in sentences.sentences(d).collect()} == {(1, 0, 4), (1, 5, 9)}


def test_names():
    assert set(oracle_sql()) <= set(queries()) and all(f"p{n}_found" in queries() for n in (1, 2, 4, 5, 6, 7, 8, 9, 10))
    assert furniture.is_notice("back to top")
