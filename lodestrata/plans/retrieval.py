"""Queries of retrieval, near duplicates and chunking."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import chunking, neardup
from ..operators import index as I
from ..operators import registry as R
from ..operators import retrieval as V
from ..operators import search as S
from .base import Book
from .relational import _CHAIN, ART, DOMAIN, SRC
from .text import HASHED

book = Book()
queries = lambda: book.queries
oracle_sql = lambda: book.sql

CH = "(SELECT DISTINCT * FROM chunks)"
EV = "(SELECT DISTINCT * FROM eval_items)"
W = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"


_FIELDS = f"""SELECT p.id AS document, s.domain, json_extract_string(e.metadata, '$.document_type') AS document_type, CAST([] AS VARCHAR[]) AS keywords, x.quality_score, p.source_id, s.name AS source_name, s.url AS source_url, s.source_type AS format, coalesce(s.tags, CAST([] AS VARCHAR[])) AS tags, json_extract_string(e.metadata, '$.title') AS title, s.organization
    FROM (SELECT DISTINCT id, source_id FROM {ART} a WHERE artifact_type = 'parsed_document') p LEFT JOIN (SELECT DISTINCT parsed_id, enriched_id, coalesce(curated_score, enriched_score) AS quality_score FROM ({_CHAIN})) x ON x.parsed_id = p.id
    LEFT JOIN {ART} e ON e.id = x.enriched_id LEFT JOIN (SELECT id, name, url, source_type, config.tags AS tags, config.organization AS organization, {DOMAIN} AS domain FROM {SRC} s) s ON s.id = p.source_id"""


def _rank(scored: str, k: int) -> str:
    return f"SELECT query_id, id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM ({scored})) WHERE rank <= {k}"


def _cosine(points: str, asked: str) -> str:
    return f"SELECT q.id AS query_id, p.id, round(list_cosine_similarity(CAST(q.v AS DOUBLE[]), CAST(p.v AS DOUBLE[])), 6) AS score FROM ({asked}) q, ({points}) p WHERE q.id <> p.id"


@book.add(_rank(_cosine("SELECT vec_id AS id, embedding AS v FROM embeddings", "SELECT vec_id AS id, embedding AS v FROM embeddings WHERE vec_id % 50 = 0"), 5))
def dense_topk(t):
    e = t("embeddings")
    return V.dense_topk(e, e.where(F.col("vec_id") % 50 == 0), k=5)


@book.add(_rank(_cosine("SELECT vec_id AS id, embedding AS v FROM embeddings WHERE label IN (1, 3, 5)", "SELECT vec_id AS id, embedding AS v FROM embeddings WHERE vec_id % 50 = 0"), 5))
def filtered_search(t):
    e = t("embeddings")
    return V.dense_topk(e.where(F.col("label").isin(1, 3, 5)), e.where(F.col("vec_id") % 50 == 0), k=5)


_BM25 = f"""WITH tok AS (SELECT chunk_id AS id, unnest({W.format('text')}) AS term FROM {CH} c), len_ AS (SELECT id, count(*) AS n FROM tok GROUP BY id),
    st AS (SELECT count(*) AS total, avg(n) AS mean FROM len_), qt AS (SELECT DISTINCT item_id AS query_id, unnest({W.format('question')}) AS term FROM {EV} e WHERE item_id % 50 = 0),
    tf AS (SELECT id, term, count(*) AS tf FROM tok GROUP BY id, term), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
    SELECT query_id, tf.id, round(sum(ln(1 + (total - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / mean))), 6) AS score
    FROM qt JOIN tf USING (term) JOIN df USING (term) JOIN len_ ON len_.id = tf.id, st GROUP BY query_id, tf.id"""


def _sparse(t, k):
    return V.sparse_topk(t("chunks"), t("eval_items").where(F.col("item_id") % 50 == 0), k=k, id="chunk_id", text="text", query="item_id", query_text="question")


@book.add(_rank(_BM25, 10))
def sparse_topk(t):
    return _sparse(t, 10)


#: Signed feature hashing of words in SQL, and its cosine.
_VEC = lambda src, id, text: f"SELECT id, slot, sum(s) AS x FROM (SELECT id, h % 64 AS slot, CASE WHEN (h // 64) % 2 = 0 THEN 1.0 ELSE -1.0 END AS s FROM (SELECT {id} AS id, CAST('0x' || substr(md5(unnest({W.format(text)})), 1, 8) AS BIGINT) AS h FROM {src} x)) GROUP BY id, slot"
_POINTS = f"""pt AS (SELECT c.chunk_id AS id, c.parsed_id AS document, c.text, f.* EXCLUDE (document) FROM {CH} c LEFT JOIN ({_FIELDS}) f ON f.document = c.parsed_id)"""
_ASK = f"qu AS (SELECT item_id AS query_id, question AS query FROM {EV} e WHERE item_id % 50 = 0)"


def _dense(where: str, k: int) -> str:
    return _rank(f"""SELECT query_id, id, round(d / (qn * pn), 6) AS score FROM (SELECT q.id AS query_id, p.id, sum(q.x * p.x) AS d FROM qv q JOIN (SELECT * FROM pv WHERE id IN (SELECT id FROM pt WHERE {where})) p ON p.slot = q.slot GROUP BY 1, 2
        UNION ALL SELECT q.id, p.id, 0 FROM (SELECT DISTINCT id FROM qv) q, (SELECT DISTINCT id FROM pv WHERE x <> 0 AND id IN (SELECT id FROM pt WHERE {where})) p WHERE NOT EXISTS (SELECT 1 FROM qv a JOIN pv b ON a.slot = b.slot WHERE a.id = q.id AND b.id = p.id))
        JOIN (SELECT id AS query_id, sqrt(sum(x * x)) AS qn FROM qv GROUP BY id) USING (query_id) JOIN (SELECT id, sqrt(sum(x * x)) AS pn FROM pv GROUP BY id HAVING sum(x * x) > 0) USING (id)""", k)


def _bm25(where: str) -> str:
    return f"""WITH tok AS (SELECT id, unnest({W.format('text')}) AS term FROM pt WHERE {where}), len_ AS (SELECT id, count(*) AS n FROM tok GROUP BY id), st AS (SELECT count(*) AS total, avg(n) AS mean FROM len_),
        qt AS (SELECT DISTINCT query_id, unnest({W.format('query')}) AS term FROM qu), tf AS (SELECT id, term, count(*) AS tf FROM tok GROUP BY id, term), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
        SELECT query_id, tf.id, round(sum(ln(1 + (total - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / mean))), 6) AS score FROM qt JOIN tf USING (term) JOIN df USING (term) JOIN len_ ON len_.id = tf.id, st GROUP BY query_id, tf.id"""


def _hybrid(where: str, k: int) -> str:
    return _rank(f"""WITH d AS ({_dense(where, k)}), s AS ({_rank(_bm25(where), k)}) SELECT coalesce(d.query_id, s.query_id) AS query_id, coalesce(d.id, s.id) AS id,
        round(coalesce(1 / (60 + d.rank), 0) + coalesce(1 / (60 + s.rank), 0), 6) AS score FROM d FULL JOIN s ON d.query_id = s.query_id AND d.id = s.id""", k)


_STORE = f"WITH {_POINTS}, {_ASK}, pv AS ({_VEC('pt', 'id', 'text')}), qv AS ({_VEC('qu', 'query_id', 'query')}) "


def _points(t):
    fields = I.document_fields(t("artifacts"), t("sources")).select("document", *[c for c in I.DERIVED])
    rows = t("chunks").select(F.col("chunk_id").alias("id"), F.col("parsed_id").alias("document"), "text")
    vectors = V.hashed_vectors(rows, id="id", text="text")
    return rows.join(fields, "document", "left").join(vectors, "id", "left")


def _asked(t):
    return t("eval_items").where(F.col("item_id") % 50 == 0).select(F.col("item_id").alias("query_id"), F.col("question").alias("query"))


@book.add(_STORE + _hybrid("true", 10))
def hybrid_rrf(t):
    """BM25 and cosine of hashed word vectors, fused."""
    return S.search(_points(t), _asked(t), mode="hybrid", k=10)


@book.add(_STORE + _dense("domain = 'healthcare' AND quality_score >= 0.4 AND format = 'html'", 5))
def search_filtered(t):
    return S.search(_points(t), _asked(t), mode="dense", k=5, domain="healthcare", min_quality_score=0.4, format="html")


@book.add(_STORE + f"SELECT * FROM ({_rank(_bm25('list_has_any(tags, [' + chr(39) + 'claims' + chr(39) + ', ' + chr(39) + 'labs' + chr(39) + '])'), 8)}) WHERE rank > 3")
def search_tags_page(t):
    """Hits 4 to 8 among points with any of two tags."""
    asked = _asked(t)
    vectors = V.hashed_vectors(asked, id="query_id", text="query").withColumnRenamed("id", "query_id")
    return S.store_search(S.filtered(_points(t), tags=["claims", "labs"]), asked.join(vectors, "query_id", "left"), mode="sparse", k=5, offset=3)


@book.add(f"SELECT query_id, c.parsed_id AS doc, max(score) AS score FROM ({_rank(_BM25, 20)}) h JOIN {CH} c ON c.chunk_id = h.id GROUP BY query_id, c.parsed_id")
def shortlist_docs(t):
    hits = _sparse(t, 20).join(t("chunks").select(F.col("chunk_id").alias("id"), F.col("parsed_id").alias("doc")), "id")
    return hits.groupBy("query_id", "doc").agg(F.max("score").alias("score"))


_TREE = f"""WITH hit AS ({_rank(_BM25, 20)}), docs AS (SELECT query_id, c.parsed_id AS doc, max(score) AS s FROM hit JOIN {CH} c ON c.chunk_id = hit.id GROUP BY query_id, c.parsed_id),
    best AS (SELECT query_id, doc FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc) AS r FROM docs) WHERE r <= 3),
    q AS (SELECT item_id AS query_id, list_distinct({W.format('question')}) AS q FROM {EV} e WHERE item_id % 50 = 0),
    n AS (SELECT parsed_id AS doc, sec.section_path, list_distinct({W.format("coalesce(sec.heading, '')")}) AS t FROM (SELECT parsed_id, unnest(sections) AS sec FROM (SELECT DISTINCT * FROM parsed_docs)) WHERE sec.section_path IS NOT NULL),
    sc AS (SELECT DISTINCT query_id, doc, section_path, round(len(list_intersect(q, t)) / len(q), 6) AS score FROM best JOIN q USING (query_id) JOIN n USING (doc))
    SELECT query_id, doc, section_path, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc, section_path) AS rank FROM sc WHERE score > 0) WHERE rank <= 5"""


@book.add(_TREE)
def tree_search(t):
    hits = shortlist_docs(t)
    nodes = t("parsed_docs").select(F.col("parsed_id").alias("doc"), F.explode("sections").alias("s")).select("doc", "s.section_path", F.col("s.heading").alias("title")).where(F.col("section_path").isNotNull()).distinct()
    asked = t("eval_items").where(F.col("item_id") % 50 == 0).select(F.col("item_id").alias("query_id"), F.col("question").alias("query"))
    return V.tree_search(nodes, asked, hits, k=5, most_docs=3).drop("rank")


_ROUTE = "CASE " + " ".join(f"WHEN regexp_matches(query, '{p}') THEN '{n}'" for n, p in X.ROUTES) + " ELSE 'no_match' END"
_ROUTED = f"""WITH {_POINTS}, al AS (SELECT item_id AS query_id, CASE WHEN item_id % 3 = 0 THEN 'outline of ' || question ELSE question END AS query FROM {EV} e WHERE item_id % 50 = 0), pv AS ({_VEC('pt', 'id', 'text')}),
    w AS (SELECT * FROM al WHERE {_ROUTE} <> 'no_match'), h0 AS (WITH qu AS (SELECT * FROM w) {_rank(_bm25('true'), 20)}), docs AS (SELECT query_id, document AS doc, max(score) AS s FROM h0 JOIN pt USING (id) GROUP BY 1, 2),
    best AS (SELECT query_id, doc FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc) AS r FROM docs) WHERE r <= 3), q AS (SELECT query_id, list_distinct({W.format('query')}) AS q FROM w),
    n AS (SELECT parsed_id AS doc, sec.section_path, list_distinct({W.format("coalesce(sec.heading, '')")}) AS t FROM (SELECT parsed_id, unnest(sections) AS sec FROM (SELECT DISTINCT * FROM parsed_docs)) WHERE sec.section_path IS NOT NULL),
    sc AS (SELECT DISTINCT query_id, doc, section_path, round(len(list_intersect(q, t)) / len(q), 6) AS score FROM best JOIN q USING (query_id) JOIN n USING (doc)),
    tr AS (SELECT query_id, doc || ' ' || section_path AS hit, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc, section_path) AS rank FROM sc WHERE score > 0),
    ch AS (WITH qu AS (SELECT * FROM al WHERE query_id NOT IN (SELECT query_id FROM tr)), qv AS ({_VEC('qu', 'query_id', 'query')}) {_hybrid("domain = 'healthcare'", 5)})
    SELECT query_id, 'tree' AS via, hit, score, rank FROM tr WHERE rank <= 5 UNION ALL SELECT query_id, 'chunk', id, score, rank FROM ch"""


@book.add(_ROUTED)
def routed_search(t):
    """Some of the questions call for an outline and go to the tree; the rest, and what it misses, to filtered chunks."""
    asked = _asked(t).withColumn("query", F.when(F.col("query_id") % 3 == 0, F.concat(F.lit("outline of "), "query")).otherwise(F.col("query")))
    nodes = t("parsed_docs").select(F.col("parsed_id").alias("doc"), F.explode("sections").alias("s")).select("doc", "s.section_path", F.col("s.heading").alias("title")).where(F.col("section_path").isNotNull()).distinct()
    return S.routed_search(_points(t), nodes, asked, domain="healthcare")


_PAYLOAD = f"SELECT c.parsed_id AS document, coalesce(c.section_path, '') AS section_path, coalesce(c.page, 1) AS page, c.chunk_id, regexp_replace(c.chunk_id, '^[^_]*_', '') AS qdrant_id, md5(coalesce(c.text, '')) AS text, f.* EXCLUDE (document) REPLACE (array_to_string(keywords, '|') AS keywords, array_to_string(tags, '|') AS tags) FROM {CH} c LEFT JOIN ({_FIELDS}) f ON f.document = c.parsed_id"


def _flat(rows):
    return rows.withColumn("text", F.md5("text")).withColumn("keywords", F.array_join("keywords", "|")).withColumn("tags", F.array_join("tags", "|"))


@book.add(_PAYLOAD)
def point_payload(t):
    """All fields of a point, its text as a digest."""
    return _flat(I.payloads(t("artifacts"), t("chunks"), t("sources")))


@book.add(_PAYLOAD.replace("f.* EXCLUDE (document)", "f.* EXCLUDE (document)"))
def payload_refresh(t):
    """Points whose derived fields have been lost get them back."""
    stored = I.payloads(t("artifacts"), t("chunks"), t("sources"))
    lost = stored.select(*I.CITATION, *[F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in I.DERIVED])
    return _flat(I.refreshed(lost, I.document_fields(t("artifacts"), t("sources"))))


_LED = f"(SELECT chunk_id, source_id, ord, {HASHED('text')} AS text_hash FROM {CH} c WHERE text IS NOT NULL)"
_PTS = f"SELECT text_hash, arg_min(chunk_id, (ord, chunk_id)) AS primary_id, count(*) AS contributor_count FROM {_LED} GROUP BY text_hash"


@book.add(f"SELECT primary_id, contributor_count, text_hash = text_hash AS named FROM ({_PTS})")
def deduplicated_points(t):
    rows = I.points(R.hashed(t("chunks")))
    return rows.select("primary_id", "contributor_count", (F.length("point_id") == 36).alias("named"))


def _stores(t):
    every = I.points(R.hashed(t("chunks")))
    tables = t("chunks").where(F.coalesce("is_table", F.lit(False))).select(F.col("chunk_id").alias("primary_id"))
    return every, every.join(tables, "primary_id", "left_semi")


@book.add(f"SELECT primary_id, contributor_count FROM ({_PTS}) JOIN {CH} c ON c.chunk_id = primary_id WHERE c.is_table")
def vanished_points(t):
    """The store has lost its tables."""
    every, tables = _stores(t)
    return I.vanished(every.join(tables.select("point_id"), "point_id", "left_anti"), every).select("primary_id", "contributor_count")


@book.add(f"SELECT count(*) AS stored, count(*) FILTER (NOT coalesce(c.is_table, false)) AS copied, count(*) FILTER (c.is_table) AS skipped, true AS parity FROM ({_PTS}) JOIN {CH} c ON c.chunk_id = primary_id")
def reindex_parity(t):
    """A new version without tables, which are skipped on purpose."""
    every, tables = _stores(t)
    return I.parity(every, every.join(tables.select("point_id"), "point_id", "left_anti"), tables)


@book.add(f"SELECT count(*) AS stored, count(*) FILTER (NOT coalesce(c.is_table, false)) AS copied, 0 AS skipped, false AS parity FROM ({_PTS}) JOIN {CH} c ON c.chunk_id = primary_id")
def reindex_loss(t):
    """The same version where nothing was to be skipped: no parity."""
    every, tables = _stores(t)
    return I.parity(every, every.join(tables.select("point_id"), "point_id", "left_anti"), tables.where("false"))


@book.add(None)
def near_dup_status(t):
    return neardup.near_dup_status(t("documents").select("doc_id", "text"), id="doc_id")


@book.add(None)
def chunk_documents(t):
    return chunking.chunk_sections(t("parsed_docs")).withColumnRenamed("doc", "parsed_id")


@book.add(None)
def hashed_embeddings(t):
    v = V.hashed_vectors(t("chunks"), id="chunk_id", text="text")
    return v.select(F.col("id").alias("chunk_id"), F.transform("embedding", lambda x: F.round(x, 6)).alias("embedding"))
