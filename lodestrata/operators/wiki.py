"""Documents and concepts rendered as linked Markdown pages; what has changed since the last manifest.

Pages of documents are strings, one per document. Concept and index pages can list any number of documents, so they come as
numbered lines (slug, line_no, line); a writer that sorts by slug and line never holds a page in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..runtime import running_totals

MOST_KEYWORDS, MOST_ENTITIES, LEAD = 20, 50, 500


def wikilink_text(text: Column) -> Column:
    """Without what would end or part a link: bars become hyphens, closing brackets go, line ends become spaces."""
    return F.translate(F.replace(F.replace(text, F.lit("|"), F.lit("-")), F.lit("]]"), F.lit("")), "\n\r", "  ")


def link(slug: Column, text: Column) -> Column:
    return F.concat(F.lit("[["), slug, F.lit("|"), wikilink_text(text), F.lit("]]"))


def lead_of(summary: Column) -> Column:
    return X.truncate_lead(F.coalesce(summary, F.lit("")), LEAD)


def slugs(rows: DataFrame, *, id: str, title: str, digest: str, order: list[str]) -> DataFrame:
    """(id, slug) of rows: the slug of the title for the first row in `order`, with eight digits of `digest` after it for the others,
    and with eight of the SHA-256 of the id where that is taken as well. Blank titles are document-<id>.

    Who comes first is a minimum, not a window, so a title that a third of all rows has gathers nowhere.
    """
    text = F.coalesce(F.nullif(F.col(title), F.lit("")), F.concat(F.lit("document-"), F.col(id).cast("string")))
    key = F.struct(*order, id)
    rows = rows.select(F.col(id).alias("id"), X.slugify(text).alias("base"), F.substring(digest, 1, 8).alias("d"), key.alias("o"))
    first = rows.groupBy("base").agg(F.min("o").alias("first"))
    rows = rows.join(first, "base").withColumn("cand", F.when(F.col("o") == F.col("first"), F.col("base")).otherwise(F.concat_ws("-", "base", "d")))
    taken = rows.groupBy("cand").agg(F.min(F.struct((F.col("cand") != F.col("base")).alias("late"), "o")).alias("holder"))
    rows = rows.join(taken, "cand")
    own = F.col("holder.o") == F.col("o")
    return rows.select("id", F.when(own, F.col("cand")).otherwise(F.concat(F.col("base"), F.lit("-"), F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 8))).alias("slug"))


def document_pages(docs: DataFrame, linked: DataFrame) -> DataFrame:
    """(id, slug, page) of docs (id, slug, title, lead, document_type, keywords, source_name, source_url); linked (id, pos, entity, concept)
    are a document's concepts in their order, at most MOST_ENTITIES."""
    concepts = linked.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("pos", F.concat(F.lit("- "), link(F.col("concept"), F.col("entity"))).alias("line")))).alias("c"))
    rows = docs.join(concepts, "id", "left")
    some = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    lines = lambda *xs: F.array(*[x if isinstance(x, Column) else F.lit(x) for x in xs])
    none = F.array().cast("array<string>")
    lead = F.coalesce("lead", F.lit(""))
    named = F.coalesce("source_name", F.lit("Unknown"))
    origin = F.when(F.coalesce("source_url", F.lit("")) != "", F.concat(F.lit("**Source:** ["), named, F.lit("]("), F.col("source_url"), F.lit(")"))).otherwise(F.concat(F.lit("**Source:** "), named))
    head = lines(F.concat(F.lit("# "), F.coalesce(F.nullif("title", F.lit("")), "slug")), "", F.concat(F.lit("**Type:** "), F.coalesce(F.nullif("document_type", F.lit("")), F.lit("unknown"))), origin, "")
    summary = F.when(lead != "", lines("## Summary", "", lead, "")).otherwise(none)
    words = F.when(some("keywords"), lines("## Keywords", "", F.array_join(F.transform(F.slice("keywords", 1, MOST_KEYWORDS), lambda k: F.concat(F.lit("`"), k, F.lit("`"))), ", "), "")).otherwise(none)
    related = F.when(some("c"), F.concat(lines("## Related Concepts", ""), F.transform("c", lambda x: x["line"]), lines(""))).otherwise(none)
    return rows.select("id", "slug", F.array_join(F.concat(head, summary, words, related), "\n").alias("page"))


def _numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    return running_totals(rows.withColumn("one", F.lit(1)), group, order, "one", "n").withColumn("line_no", (F.col("n") - 1).cast("bigint"))


def concept_lines(concepts: DataFrame, backlinks: DataFrame) -> DataFrame:
    """(slug, line_no, line) of the page of each concept (slug, entity); backlinks (entity, created_at, id, doc_slug, doc_title), one
    per time a document names the entity."""
    title = lambda: F.concat(F.lit("# "), "entity")
    head = [title(), F.lit(""), F.concat(F.lit("*Concept page for entity: **"), "entity", F.lit("***")), F.lit("")]
    with_docs = concepts.join(backlinks.select("entity").distinct(), "entity", "left_semi")
    fixed = lambda rows, lines, part: rows.select("slug", F.lit(part).alias("part"), F.posexplode(F.array(*lines)).alias("at", "line")).select("slug", "part", F.col("at").cast("string").alias("when"), F.lit("").alias("id"), "line")
    listed = backlinks.join(concepts, "entity").select("slug", F.lit(2).alias("part"), F.coalesce(F.date_format("created_at", "yyyyMMddHHmmssSSSSSS"), F.lit("")).alias("when"), F.col("id").cast("string").alias("id"), F.concat(F.lit("- "), link(F.col("doc_slug"), F.col("doc_title"))).alias("line"))
    rows = fixed(concepts, head, 0).unionByName(fixed(with_docs, [F.lit("## Documents"), F.lit("")], 1)).unionByName(listed).unionByName(fixed(with_docs, [F.lit("")], 3))
    return _numbered(rows, ["slug"], ["part", "when", "id", "line"]).select("slug", "line_no", "line")


def index_lines(docs: DataFrame, concepts: DataFrame) -> DataFrame:
    """(line_no, line) of the index: documents (slug, title, source_name) by source and title, then concepts (slug, entity) by name."""
    row = lambda df, part, source, kind, title, slug, line: df.select(F.lit(part).alias("part"), source.alias("source"), F.lit(kind).alias("kind"), title.alias("title"), slug.alias("slug"), line.alias("line"))
    spark, none = docs.sparkSession, F.lit("")
    once = spark.range(1)
    sources = docs.select("source_name").distinct()
    rows = row(once, 0, none, 0, none, none, F.lit("# Knowledge Base Index")).unionByName(row(once, 0, none, 1, none, none, none))
    rows = rows.unionByName(row(once, 0, none, 2, none, none, F.lit("## Documents"))).unionByName(row(once, 0, none, 3, none, none, none))
    name = F.col("source_name")
    rows = rows.unionByName(row(sources, 1, name, 0, none, none, F.concat(F.lit("### "), name))).unionByName(row(sources, 1, name, 1, none, none, none)).unionByName(row(sources, 1, name, 3, none, none, none))
    rows = rows.unionByName(row(docs, 1, name, 2, F.col("title"), F.col("slug"), F.concat(F.lit("- "), link(F.col("slug"), F.col("title")))))
    some = concepts.limit(1)
    rows = rows.unionByName(row(some, 2, none, 0, none, none, F.lit("## Concepts"))).unionByName(row(some, 2, none, 1, none, none, none)).unionByName(row(some, 4, none, 0, none, none, none))
    rows = rows.unionByName(row(concepts, 3, none, 0, F.col("entity"), F.col("slug"), F.concat(F.lit("- "), link(F.col("slug"), F.col("entity")))))
    return _numbered(rows, [], ["part", "source", "kind", "title", "slug"]).select("line_no", "line")


def write_pages(pages: DataFrame, folder: str) -> int:
    """Pages (key, page) as a table of the folder, one file set per compile; returns how many were written."""
    pages.write.mode("overwrite").parquet(folder)
    return pages.sparkSession.read.parquet(folder).count()
