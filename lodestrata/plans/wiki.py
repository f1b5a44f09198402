"""Queries of the wiki: slugs, pages of documents and concepts, the index, what a compile would change."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import registry as R
from ..operators import wiki as K
from ..runtime import cut
from .base import Book
from .relational import ART, DOMAIN, PARSED, SRC
from .text import _rr

book = Book()
queries = lambda: book.queries
oracle_sql = lambda: book.sql

SCOPE = "healthcare"


def _docs(t):
    """The parsed documents of one domain, with what stands in for their enrichment; each text is read once, for its lead and names."""
    named = t("sources").select(F.col("id").alias("source_id"), R.domain().alias("domain"), F.col("name").alias("source_name"), F.col("url").alias("source_url"), F.col("config.tags").alias("keywords"), F.col("source_type").alias("document_type"))
    known = t("artifacts").where(F.col("artifact_type") == "parsed_document").select(F.col("id").alias("parsed_id"), "created_at", "content_hash")
    found = F.slice(F.array_distinct(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({R.ENTITY})"), 1)), 1, K.MOST_ENTITIES)
    rows = t("parsed_docs").select("parsed_id", "source_id", K.lead_of(F.col("text")).alias("lead"), found.alias("names"), "title").join(named, "source_id").where(F.col("domain") == SCOPE).join(known, "parsed_id")
    rows = cut(rows.withColumnRenamed("parsed_id", "id"))
    return cut(rows.join(K.slugs(rows, id="id", title="title", digest="content_hash", order=["created_at"]), "id"))


def _entities(docs):
    return docs.select("id", F.posexplode("names").alias("pos", "entity"))


def _concepts(docs, mentions):
    total = docs.agg(F.count(F.lit(1)).alias("total"))
    df = mentions.groupBy("entity").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= 2).crossJoin(F.broadcast(total))
    wanted = df.where(F.log(F.col("total") / F.col("df")) >= 1.5).select("entity")
    named = wanted.withColumn("digest", F.sha2("entity", 256))
    return cut(wanted.join(K.slugs(named, id="entity", title="entity", digest="digest", order=["entity"]).withColumnRenamed("id", "entity"), "entity"))


def _slug(e: str) -> str:
    s = _rr(_rr("lower(" + _rr(e, r"[^\x00-\x7f]") + ")", "[^a-z0-9]+", "-"), "^-+|-+$")
    return f"CASE WHEN {s} = '' THEN 'untitled' ELSE {s} END"


def _slugged(src: str, order: str) -> str:
    """(id, slug) of (id, title, digest, ...)."""
    return f"""SELECT id, CASE WHEN row_number() OVER (PARTITION BY cand ORDER BY cand <> base, {order}, id) = 1 THEN cand ELSE base || '-' || substr(sha256(id), 1, 8) END AS slug FROM
        (SELECT *, CASE WHEN row_number() OVER (PARTITION BY base ORDER BY {order}, id) = 1 THEN base ELSE base || '-' || substr(digest, 1, 8) END AS cand FROM (SELECT *, {_slug("coalesce(nullif(title, ''), 'document-' || id)")} AS base FROM ({src})))"""


_D = f"""d0 AS (SELECT p.parsed_id AS id, p.title, p.text AS summary, s.source_type AS document_type, s.config.tags AS keywords, s.name AS source_name, s.url AS source_url, a.created_at, a.content_hash AS digest FROM {PARSED} p JOIN (SELECT *, {DOMAIN} AS home FROM {SRC} z) s ON s.id = p.source_id
    JOIN (SELECT * FROM {ART} q WHERE artifact_type = 'parsed_document') a ON a.id = p.parsed_id WHERE s.home = '{SCOPE}'), d AS (SELECT d0.*, slug FROM d0 JOIN ({_slugged('SELECT * FROM d0', 'created_at')}) USING (id))"""
_M = f"""m0 AS (SELECT id, list_extract(l, i) AS entity, i FROM (SELECT id, l, unnest(range(1, least(len(l), 50) + 1)) AS i FROM (SELECT id, [x for x, i in al if list_position(al, x) = i] AS l FROM (SELECT id, regexp_extract_all(coalesce(summary, ''), '{R.ENTITY}') AS al FROM d))))"""
_C = f"""w AS (SELECT entity FROM m0 GROUP BY entity HAVING count(*) >= 2 AND ln((SELECT count(*) FROM d) / count(*)) >= 1.5), c AS (SELECT id AS entity, slug FROM ({_slugged("SELECT entity AS id, entity AS title, sha256(entity) AS digest FROM w", 'id')}))"""
_LINK = lambda slug, text: f"'[[' || {slug} || '|' || translate(replace(replace({text}, '|', '-'), ']]', ''), chr(10) || chr(13), '  ') || ']]'"
_LEAD = f"""CASE WHEN length(summary) <= 500 THEN summary ELSE {_rr("CASE WHEN s <> '' THEN s WHEN contains(w, ' ') THEN regexp_extract(w, '(?s)^(.*) [^ ]*$', 1) ELSE w END", X.WS + '+$')} || '...' END"""
_P = f"""p AS (SELECT id, slug, '# ' || coalesce(nullif(title, ''), slug) || chr(10) || chr(10) || '**Type:** ' || coalesce(nullif(document_type, ''), 'unknown') || chr(10) || CASE WHEN coalesce(source_url, '') <> '' THEN '**Source:** [' || source_name || '](' || source_url || ')' ELSE '**Source:** ' || source_name END || chr(10)
    || CASE WHEN lead <> '' THEN chr(10) || '## Summary' || chr(10) || chr(10) || lead || chr(10) ELSE '' END || CASE WHEN len(keywords) > 0 THEN chr(10) || '## Keywords' || chr(10) || chr(10) || array_to_string(list_transform(keywords[1:20], lambda k: '`' || k || '`'), ', ') || chr(10) ELSE '' END
    || coalesce(chr(10) || '## Related Concepts' || chr(10) || chr(10) || (SELECT string_agg('- ' || {_LINK('c.slug', 'm0.entity')}, chr(10) ORDER BY m0.i) FROM m0 JOIN c USING (entity) WHERE m0.id = f.id) || chr(10), '') AS page
    FROM (SELECT *, {_LEAD} AS lead FROM (SELECT * REPLACE (coalesce(summary, '') AS summary), substring(coalesce(summary, ''), 1, 500) AS w, regexp_extract(substring(coalesce(summary, ''), 1, 500), '(?s)^(.*[.!?])(?: .*)?$', 1) AS s FROM d)) f)"""


@book.add(f"WITH {_D} SELECT id, slug FROM d")
def wiki_slugs(t):
    return _docs(t).select("id", "slug")


def _pages(t):
    docs = _docs(t)
    mentions = _entities(docs)
    concepts = _concepts(docs, mentions)
    linked = mentions.join(concepts.withColumnRenamed("slug", "concept"), "entity")
    return K.document_pages(docs, linked)


@book.add(f"WITH {_D}, {_M}, {_C}, {_P} SELECT id, slug, page FROM p")
def wiki_doc_page(t):
    return _pages(t)


@book.add(f"""WITH {_D}, {_M}, {_C}, l AS (SELECT slug, 0 AS part, unnest([0, 1, 2, 3]) AS k, NULL::TIMESTAMPTZ AS made, '' AS id, unnest(['# ' || entity, '', '*Concept page for entity: **' || entity || '***', '']) AS line FROM c
    UNION ALL SELECT slug, 1, unnest([0, 1]), NULL, '', unnest(['## Documents', '']) FROM c UNION ALL SELECT c.slug, 2, 0, d.created_at, d.id, '- ' || {_LINK('d.slug', "coalesce(nullif(d.title, ''), d.slug)")} FROM m0 JOIN c USING (entity) JOIN d ON d.id = m0.id UNION ALL SELECT slug, 3, 0, NULL, '', '' FROM c)
    SELECT slug, row_number() OVER (PARTITION BY slug ORDER BY part, k, made, id) - 1 AS line_no, line FROM l""")
def wiki_concept_lines(t):
    docs = _docs(t)
    mentions = _entities(docs)
    back = mentions.join(docs.select("id", "created_at", F.col("slug").alias("doc_slug"), F.coalesce(F.nullif("title", F.lit("")), "slug").alias("doc_title")), "id")
    return K.concept_lines(_concepts(docs, mentions), back)


@book.add(f"""WITH {_D}, {_M}, {_C}, t AS (SELECT slug, coalesce(nullif(title, ''), slug) AS title, source_name FROM d), l AS (SELECT 0 AS part, '' AS source, unnest([0, 1, 2, 3]) AS kind, '' AS title, '' AS slug, unnest(['# Knowledge Base Index', '', '## Documents', '']) AS line
    UNION ALL SELECT 1, source_name, unnest([0, 1, 3]), '', '', unnest(['### ' || source_name, '', '']) FROM (SELECT DISTINCT source_name FROM t) UNION ALL SELECT 1, source_name, 2, title, slug, '- ' || {_LINK('slug', 'title')} FROM t
    UNION ALL SELECT part, '', kind, '', '', line FROM (VALUES (2, 0, '## Concepts'), (2, 1, ''), (4, 0, '')) v(part, kind, line) WHERE (SELECT count(*) FROM c) > 0 UNION ALL SELECT 3, '', 0, entity, slug, '- ' || {_LINK('slug', 'entity')} FROM c)
    SELECT row_number() OVER (ORDER BY part, source, kind, title, slug) - 1 AS line_no, line FROM l""")
def wiki_index_lines(t):
    docs = _docs(t)
    return K.index_lines(docs.select("slug", F.coalesce(F.nullif("title", F.lit("")), "slug").alias("title"), "source_name"), _concepts(docs, _entities(docs)))


@book.add(f"""WITH {_D}, {_M}, {_C}, {_P}, n AS (SELECT slug AS key, sha256(page) AS h FROM p), o AS (SELECT key, CASE WHEN key LIKE 'a%' THEN 'x' ELSE h END AS h FROM n WHERE key NOT LIKE 'b%' UNION ALL SELECT 'gone-page', 'x')
    SELECT CASE WHEN o.h IS NULL THEN 'new' WHEN n.h IS NULL THEN 'removed' WHEN o.h <> n.h THEN 'changed' ELSE 'unchanged' END AS status, count(*) AS pages FROM o FULL JOIN n ON o.key = n.key GROUP BY 1""")
def wiki_compile_plan(t):
    """How many pages a compile would write, keep and delete against an older manifest, one that lacks some pages and has others stale."""
    new = _pages(t).select(F.col("slug").alias("key"), F.sha2("page", 256).alias("h"))
    old = new.where(~F.col("key").startswith("b")).withColumn("h", F.when(F.col("key").startswith("a"), "x").otherwise(F.col("h")))
    gone = new.sparkSession.createDataFrame([("gone-page", "x")], "key string, h string")
    return R.manifest_diff(old.unionByName(gone), new, "key", "h").groupBy("status").agg(F.count(F.lit(1)).alias("pages"))
