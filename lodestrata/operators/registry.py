"""Set-oriented lookups, aggregates and exports over the artifact registry.

Tables hold each row once (see plans.base.once). Parent references are compared trimmed and in lower case; blank ones are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..runtime import cut, skew_safe_lookup
from .hierarchy import hierarchy


def parent(column: str = "parent_artifact_id") -> Column:
    text = F.lower(F.trim(column))
    return F.when(text != "", text)


def domain() -> Column:
    blank = lambda c: F.when(F.col(c) != "", F.col(c))
    return F.coalesce(blank("domain"), blank("config.domain"))


def of_type(artifacts: DataFrame, kind: str) -> DataFrame:
    return artifacts.where(F.col("artifact_type") == kind)


def without_child(artifacts: DataFrame, kind: str, child: str) -> DataFrame:
    """Artifacts of a type that have no child of another type."""
    return of_type(artifacts, kind).join(of_type(artifacts, child).select(parent().alias("id")).where(F.col("id").isNotNull()), "id", "left_anti")


def first_child(artifacts: DataFrame, kind: str, key: str, prefix: str) -> DataFrame:
    """Per parent its first child of a type by (created_at, id), by partial aggregation: no window over hot parents."""
    rows = of_type(artifacts, kind).select(parent().alias(key), "id", "quality_score", F.struct("created_at", "id").alias("o")).where(F.col(key).isNotNull())
    best = rows.groupBy(key).agg(F.min_by(F.struct("id", "quality_score"), "o").alias("b"))
    return best.select(key, F.col("b.id").alias(f"{prefix}_id"), F.col("b.quality_score").alias(f"{prefix}_score"))


def chunk_chain(artifacts: DataFrame) -> DataFrame:
    """Each chunk with its parsed document's cleaned child and that one's enriched and curated children."""
    chunks = of_type(artifacts, "chunk").select(F.col("id").alias("chunk_id"), parent().alias("parsed_id"))
    cleaned = first_child(artifacts, "cleaned_document", "parsed_id", "cleaned").drop("cleaned_score")
    tail = cleaned.join(first_child(artifacts, "enriched_document", "cleaned_id", "enriched"), "cleaned_id", "left")
    tail = tail.join(first_child(artifacts, "curated_document", "cleaned_id", "curated"), "cleaned_id", "left")
    return chunks.join(tail, "parsed_id", "left")


def index_payload(artifacts: DataFrame, chunks: DataFrame, sources: DataFrame) -> DataFrame:
    names = sources.select(F.col("id").alias("source_id"), F.col("name").alias("source_name"), domain().alias("domain"))
    rows = chunk_chain(artifacts).join(chunks.select("chunk_id", "source_id", "section_path", "page"), "chunk_id").join(names, "source_id", "left")
    return rows.select("chunk_id", "parsed_id", "source_id", "source_name", "domain", "enriched_id", "curated_id", F.coalesce("curated_score", "enriched_score").alias("quality_score"), "section_path", "page")


def register(sources: DataFrame) -> DataFrame:
    """One source per normalised URL, with how many rows asked for it."""
    return sources.groupBy("normalized_url").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("registered"))


def audit(grouped: GroupedData) -> DataFrame:
    passed = F.col("substance_passed")
    kept, rejected = F.count_if(passed), F.count_if(~passed)
    return grouped.agg(F.count(F.lit(1)).alias("considered"), kept.alias("kept"), rejected.alias("rejected"), F.round(F.try_divide(rejected, kept + rejected), 6).alias("garbage_rate"))


def hashed(chunks: DataFrame) -> DataFrame:
    """(chunk_id, source_id, ord, text_hash) of the chunks with a text, rows delivered twice once; texts are hashed where they lie."""
    return chunks.where(F.col("text").isNotNull()).select("chunk_id", "source_id", "ord", X.text_hash(F.col("text")).alias("text_hash")).distinct()


def first_writer(rows: DataFrame) -> DataFrame:
    """Which chunk was first with its text, by (ord, chunk_id); hot texts are reduced before they are joined back."""
    rows = cut(rows.select("chunk_id", "ord", "text_hash"))
    first = cut(rows.groupBy("text_hash").agg(F.min(F.struct("ord", "chunk_id"))["chunk_id"].alias("_first"), F.count(F.lit(1)).alias("n")))
    return skew_safe_lookup(rows, first, ["text_hash"], "n", rows.count()).select("chunk_id", "text_hash", (F.col("chunk_id") == F.col("_first")).alias("is_new"))


def contributors(rows: DataFrame, *, most: int, primary: DataFrame | None = None) -> DataFrame:
    """(text_hash, contributors): each text's chunk ids, the current primary first, then the others by (ord, chunk_id), at most `most`.

    primary (text_hash, primary_id) is what the ledger holds; without it the first chunk is primary. A primary that is none of the
    text's chunks is an error. The rank limit is applied in the tasks before the shuffle.
    """
    window = Window.partitionBy("text_hash").orderBy(F.col("first").desc(), "ord", "chunk_id")
    rows = rows.select("text_hash", "ord", "chunk_id")
    if primary is None:
        rows = rows.withColumn("first", F.lit(False))
    else:
        rows = rows.join(primary, "text_hash", "left").withColumn("first", F.coalesce(F.col("chunk_id") == F.col("primary_id"), F.lit(False)))
    ranked = rows.withColumn("k", F.row_number().over(window)).where(F.col("k") <= most)
    listed = ranked.groupBy("text_hash").agg(F.sort_array(F.collect_list(F.struct("k", "chunk_id", "first"))).alias("c"))
    if primary is not None:
        listed = listed.withColumn("c", F.when(F.col("c")[0]["first"], F.col("c")).otherwise(F.raise_error(F.lit("the primary is none of the text's contributors"))))
    return listed.select("text_hash", F.array_join(F.transform("c", lambda x: x["chunk_id"]), "|").alias("contributors"))


def finetune(examples: DataFrame, artifacts: DataFrame) -> DataFrame:
    """(id, dataset, kind, prompt, completion) of examples whose source artifact exists; a question makes it a QA pair."""
    known = examples.join(artifacts.select(F.col("id").alias("source_artifact_id")), "source_artifact_id", "left_semi")
    get = lambda k: F.get_json_object("payload", f"$.{k}")
    qa = F.array_contains(F.json_object_keys("payload"), "question")
    more = F.concat(get("instruction"), F.lit("\n\n"), get("input"))
    prompt = F.when(qa, get("question")).when(F.coalesce(get("input"), F.lit("")) != "", more).otherwise(get("instruction"))
    return known.select("id", "dataset", F.when(qa, "qa").otherwise("instruction").alias("kind"), prompt.alias("prompt"), F.when(qa, get("answer")).otherwise(get("output")).alias("completion"))


def example_index(examples: DataFrame) -> DataFrame:
    """The running number from 0 of each example in its dataset by (created_at, id), by sorted partitions with offsets."""
    from ..runtime import running_totals

    rows = examples.select("id", "dataset", "created_at", F.lit(1).alias("one"))
    return running_totals(rows, ["dataset"], ["created_at", "id"], "one", "n").select("id", "dataset", (F.col("n") - 1).alias("running_index"))


def pretrain_rows(artifacts: DataFrame, parsed: DataFrame, least: float = 0.4) -> DataFrame:
    curated = of_type(artifacts, "curated_document").where(F.coalesce("quality_score", F.lit(0.0)) >= least).select(F.col("id").alias("curated_id"), parent().alias("cleaned_id"), "quality_score")
    cleaned = of_type(artifacts, "cleaned_document").select(F.col("id").alias("cleaned_id"), parent().alias("parsed_id"))
    return curated.join(cleaned, "cleaned_id").join(parsed.select("parsed_id", "text"), "parsed_id", "left").select("curated_id", "parsed_id", F.coalesce("text", F.lit("")).alias("text"), "quality_score")


def ancestry(artifacts: DataFrame, *, kind: str, most: int) -> DataFrame:
    """(leaf, ancestor, steps) of every artifact of a type and each ancestor up to `most` links above, itself at 0."""
    paths = hierarchy(artifacts, with_path=True).join(of_type(artifacts, kind).select("id"), "id", "left_semi").where(F.col("node_depth") >= 0)
    up = paths.select(F.lower(F.trim("id")).alias("leaf"), "node_depth", F.posexplode("path").alias("at", "ancestor"))
    steps = (F.col("node_depth") - F.col("at")).cast("int")
    return up.select("leaf", F.lower(F.trim("ancestor")).alias("ancestor"), steps.alias("steps")).where(F.col("steps") <= most)


ENTITY = "[A-Z][a-z]+ (?:[A-Z][a-z]+ )*(?:Board|Council|Bureau|Registry|Office|Authority)"


def entities(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(f"({ENTITY})"), 1))).alias("entity"))


def entity_idf(documents: DataFrame, least: int = 2) -> DataFrame:
    """(entity, df, idf = ln(N / df)) of the entities in at least `least` documents."""
    total = documents.agg(F.count(F.lit(1)).alias("total"))
    counts = entities(documents).groupBy("entity").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= least)
    return counts.crossJoin(F.broadcast(total)).select("entity", "df", F.round(F.log(F.col("total") / F.col("df")), 6).alias("idf"))


def concepts(documents: DataFrame, least_idf: float = 1.5) -> DataFrame:
    wanted = entity_idf(documents).where(F.col("idf") >= least_idf).select("entity")
    return entities(documents).join(wanted, "entity", "left_semi").groupBy("entity").agg(F.count(F.lit(1)).alias("backlinks"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))


def manifest_diff(old: DataFrame, new: DataFrame, key: str, digest: str) -> DataFrame:
    o, n = old.select(key, F.col(digest).alias("_old")), new.select(key, F.col(digest).alias("_new"))
    status = F.when(F.col("_old").isNull(), "new").when(F.col("_new").isNull(), "removed").when(F.col("_old") != F.col("_new"), "changed").otherwise("unchanged")
    return o.join(n, key, "full").select(key, status.alias("status"))


def tree_nodes(parsed: DataFrame) -> DataFrame:
    """(parsed_id, section_no, level, parent_no, page_start, page_end): sections as nodes of a tree by their path's dots.

    The parent is the nearest earlier section of a smaller level that is no table. A node ends a page before the next
    section of its level or above starts, no earlier than it starts itself; the last ends with the document, a table where
    it starts. Everything is decided within the document's own row, by a stack of open sections per pass.
    """

    def node(s, i):
        level = (F.regexp_count(F.coalesce(s["section_path"], F.lit("")), F.lit("[.]")) + 1).cast("bigint")
        return F.struct(i.alias("no"), level.alias("level"), s["page"].alias("page"), F.coalesce(s["is_table"], F.lit(False)).alias("t"))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, pages, nodes in zip(batch["parsed_id"], batch["page_count"], batch["ns"]):
                found, above, below = [], [], []
                for n in nodes:
                    smaller = next((a for a in reversed(above) if a["level"] < n["level"]), None)
                    found.append(smaller["no"] if smaller is not None else None)
                    if not n["t"]:  # what it hides can be no later section's parent
                        while above and above[-1]["level"] >= n["level"]:
                            above.pop()
                        above.append(n)
                for k in range(len(nodes) - 1, -1, -1):
                    n = nodes[k]
                    while below and below[-1]["level"] > n["level"]:
                        below.pop()
                    page = n["page"]
                    other = below[-1]["page"] - 1 if below and below[-1]["page"] is not None else None if below or pd.isna(pages) else int(pages)
                    end = page if n["t"] or page is None and other is None else max(x for x in (page, other) if x is not None)
                    out.append((name, n["no"], n["level"], found[k], page, end))
                    below.append(n)
            yield pd.DataFrame(out, columns=["parsed_id", "section_no", "level", "parent_no", "page_start", "page_end"]).astype({"parent_no": "Int32", "page_start": "Int32", "page_end": "Int32"})

    rows = parsed.where(F.col("sections").isNotNull()).select("parsed_id", "page_count", F.transform("sections", node).alias("ns"))
    return rows.mapInPandas(build, "parsed_id string, section_no int, level bigint, parent_no int, page_start int, page_end int").distinct()
