"""Queries over the registry tables: joins, aggregates, windows, set operations, exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import registry as R
from .base import Book
from .text import HASHED

book = Book()
queries = lambda: book.queries
oracle_sql = lambda: book.sql

ART = "(SELECT DISTINCT * FROM artifacts)"
SRC = "(SELECT DISTINCT * FROM sources)"
CH = "(SELECT DISTINCT * FROM chunks)"
EX = "(SELECT DISTINCT * FROM dataset_examples)"
PARSED = "(SELECT DISTINCT * FROM parsed_docs)"
DOC = "(SELECT DISTINCT * FROM documents)"
PAR = "nullif(lower(trim(parent_artifact_id)), '')"
DOMAIN = "coalesce(nullif(domain, ''), nullif(config.domain, ''))"


def child(kind: str) -> str:
    return f"(SELECT {PAR} AS parent, id, quality_score FROM (SELECT *, row_number() OVER (PARTITION BY {PAR} ORDER BY created_at, id) AS k FROM {ART} a WHERE artifact_type = '{kind}') WHERE k = 1 AND {PAR} IS NOT NULL)"


@book.add(f"SELECT id, source_id, created_at FROM {ART} r WHERE artifact_type = 'raw_document' AND id NOT IN (SELECT {PAR} FROM {ART} p WHERE artifact_type = 'parsed_document' AND {PAR} IS NOT NULL)")
def unprocessed_raw(t):
    return R.without_child(t("artifacts"), "raw_document", "parsed_document").select("id", "source_id", "created_at")


_CHAIN = f"""SELECT c.id AS chunk_id, c.p AS parsed_id, k.id AS cleaned_id, e.id AS enriched_id, u.id AS curated_id, e.quality_score AS enriched_score, u.quality_score AS curated_score
    FROM (SELECT id, {PAR} AS p FROM {ART} a WHERE artifact_type = 'chunk') c LEFT JOIN {child('cleaned_document')} k ON k.parent = c.p
    LEFT JOIN {child('enriched_document')} e ON e.parent = k.id LEFT JOIN {child('curated_document')} u ON u.parent = k.id"""


@book.add(f"SELECT chunk_id, parsed_id, cleaned_id, enriched_id, enriched_score FROM ({_CHAIN})")
def chunk_enrichment(t):
    return R.chunk_chain(t("artifacts")).select("chunk_id", "parsed_id", "cleaned_id", "enriched_id", "enriched_score")


@book.add(f"SELECT chunk_id, cleaned_id, curated_id, curated_score FROM ({_CHAIN})")
def chunk_curation(t):
    return R.chunk_chain(t("artifacts")).select("chunk_id", "cleaned_id", "curated_id", "curated_score")


@book.add(f"""SELECT x.chunk_id, x.parsed_id, c.source_id, s.name AS source_name, {DOMAIN.replace('domain', 's.domain', 1).replace('config', 's.config')} AS domain, x.enriched_id, x.curated_id, coalesce(x.curated_score, x.enriched_score) AS quality_score, c.section_path, c.page
    FROM ({_CHAIN}) x JOIN {CH} c ON c.chunk_id = x.chunk_id LEFT JOIN {SRC} s ON s.id = c.source_id""")
def index_payload(t):
    return R.index_payload(t("artifacts"), t("chunks"), t("sources"))


@book.add(f"SELECT id, {DOMAIN} AS domain FROM {SRC} s")
def source_domain(t):
    return t("sources").select("id", R.domain().alias("domain"))


@book.add(f"""SELECT min(id) AS id, n AS normalized_url, count(*) AS registered FROM (SELECT id, normalized_url AS n FROM {SRC} s) GROUP BY n""")
def register_sources(t):
    return R.register(t("sources"))


@book.add(f"SELECT artifact_type, count(*) AS n, count(DISTINCT source_id) AS sources FROM {ART} a GROUP BY artifact_type")
def stats_by_type(t):
    return t("artifacts").groupBy("artifact_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("source_id").alias("sources"))


@book.add(f"SELECT coalesce(s.domain, '_unclassified') AS domain, artifact_type, count(*) AS n FROM {ART} a LEFT JOIN (SELECT id, {DOMAIN} AS domain FROM {SRC} s) s ON s.id = a.source_id GROUP BY 1, 2")
def stats_domain(t):
    counts = t("artifacts").groupBy("source_id", "artifact_type").agg(F.count(F.lit(1)).alias("n"))
    named = counts.join(t("sources").select(F.col("id").alias("source_id"), R.domain().alias("domain")), "source_id", "left")
    return named.groupBy(F.coalesce("domain", F.lit("_unclassified")).alias("domain"), "artifact_type").agg(F.sum("n").alias("n"))


@book.add(f"SELECT id, source_id, created_at FROM {ART} a WHERE artifact_type = 'raw_document' ORDER BY created_at DESC, id LIMIT 50 OFFSET 10")
def list_documents(t):
    raw = t("artifacts").where(F.col("artifact_type") == "raw_document").select("id", "source_id", "created_at")
    return raw.orderBy(F.desc("created_at"), "id").offset(10).limit(50)


@book.add(f"SELECT id, source_id, quality_score FROM {ART} a WHERE artifact_type = 'curated_document' AND quality_score >= 0.4")
def list_curated(t):
    return t("artifacts").where((F.col("artifact_type") == "curated_document") & (F.col("quality_score") >= 0.4)).select("id", "source_id", "quality_score")


_AUDIT = f"SELECT source_id, count(*) AS considered, count(*) FILTER (substance_passed) AS kept, count(*) FILTER (NOT substance_passed) AS rejected, round(count(*) FILTER (NOT substance_passed) / nullif(count(*) FILTER (substance_passed IS NOT NULL), 0), 6) AS garbage_rate FROM {CH} c"


@book.add(f"{_AUDIT} GROUP BY source_id")
def quality_audit(t):
    return R.audit(t("chunks").groupBy("source_id"))


@book.add(f"{_AUDIT} GROUP BY ROLLUP (source_id)")
def quality_audit_full(t):
    return R.audit(t("chunks").rollup("source_id"))


@book.add(f"SELECT source_id, lower(regexp_extract(rejection_reason, '^[^:]*')) AS code, count(*) AS n FROM {CH} c WHERE rejection_reason <> '' GROUP BY 1, 2")
def rejection_histogram(t):
    rows = t("chunks").where(F.col("rejection_reason") != "")
    return rows.groupBy("source_id", F.lower(F.substring_index("rejection_reason", ":", 1)).alias("code")).agg(F.count(F.lit(1)).alias("n"))


_H = HASHED("text")
_LEDGER = f"SELECT *, {_H} AS text_hash FROM {CH} c WHERE text IS NOT NULL"


@book.add(f"SELECT chunk_id, text_hash, row_number() OVER (PARTITION BY text_hash ORDER BY ord, chunk_id) = 1 AS is_new FROM ({_LEDGER})")
def dedup_new_vs_dup(t):
    return R.first_writer(R.hashed(t("chunks")))


@book.add(f"SELECT count(*) AS total, count(DISTINCT text_hash) AS unique_texts, count(*) - count(DISTINCT text_hash) AS duplicates FROM ({_LEDGER})")
def dedup_stats(t):
    return R.hashed(t("chunks")).groupBy("text_hash").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("unique_texts"), (F.sum("n") - F.count(F.lit(1))).alias("duplicates"))


@book.add(f"SELECT text_hash, count(*) AS contributor_count, min(chunk_id) AS least_chunk, count(DISTINCT source_id) AS sources FROM ({_LEDGER}) GROUP BY text_hash")
def dedup_contributors(t):
    return R.hashed(t("chunks")).groupBy("text_hash").agg(F.count(F.lit(1)).alias("contributor_count"), F.min("chunk_id").alias("least_chunk"), F.countDistinct("source_id").alias("sources"))


@book.add(f"""SELECT e.id, e.dataset, CASE WHEN json_exists(payload, '$.question') THEN 'qa' ELSE 'instruction' END AS kind,
    CASE WHEN json_exists(payload, '$.question') THEN payload->>'$.question' WHEN coalesce(payload->>'$.input', '') <> '' THEN (payload->>'$.instruction') || chr(10) || chr(10) || (payload->>'$.input') ELSE payload->>'$.instruction' END AS prompt,
    CASE WHEN json_exists(payload, '$.question') THEN payload->>'$.answer' ELSE payload->>'$.output' END AS completion
    FROM {EX} e SEMI JOIN {ART} a ON a.id = e.source_artifact_id""")
def finetune_rows(t):
    return R.finetune(t("dataset_examples"), t("artifacts"))


@book.add(f"SELECT dataset, count(*) AS examples, count(*) FILTER (a.id IS NULL) AS dangling FROM {EX} e LEFT JOIN (SELECT DISTINCT id FROM artifacts) a ON a.id = e.source_artifact_id GROUP BY dataset")
def dangling_examples(t):
    ids = t("artifacts").select(F.col("id").alias("source_artifact_id"), F.lit(1).alias("known"))
    return t("dataset_examples").join(ids, "source_artifact_id", "left").groupBy("dataset").agg(F.count(F.lit(1)).alias("examples"), F.count_if(F.col("known").isNull()).alias("dangling"))


@book.add(f"SELECT id, dataset, row_number() OVER (PARTITION BY dataset ORDER BY created_at, id) - 1 AS running_index FROM {EX} e")
def example_index(t):
    return R.example_index(t("dataset_examples"))


@book.add("SELECT user_id, count(*) FILTER (event_type = 'view') AS view, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'error') AS error, count(*) FILTER (event_type = 'purchase') AS purchase, count(*) FILTER (event_type = 'signup') AS signup FROM events GROUP BY user_id")
def events_by_type(t):
    """Pivoted counts with 0 for what is missing, the form of the crawl state counts."""
    kinds = ["view", "click", "error", "purchase", "signup"]
    return t("events").groupBy("user_id").agg(*[F.count_if(F.col("event_type") == k).alias(k) for k in kinds])


@book.add("SELECT user_id AS scope, round(sum(value), 4) AS spent, sum(value) >= 100 AS over_budget FROM events GROUP BY user_id")
def spend_by_scope(t):
    return t("events").groupBy(F.col("user_id").alias("scope")).agg(F.round(F.sum("value"), 4).alias("spent"), (F.sum("value") >= 100).alias("over_budget"))


@book.add("SELECT user_id, max_by(event_type, (ts, event_id)) AS state, max(ts) AS at FROM events GROUP BY user_id")
def latest_state(t):
    return t("events").groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("state"), F.max("ts").alias("at"))


@book.add("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def events_tumbling(t):
    w = t("events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return w.select(F.col("w.start").alias("hour"), "event_type", "n", "total")


@book.add("""SELECT user_id, min(ts) AS started, count(*) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM
    (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, k""")
def events_session(t):
    s = t("events").groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return s.select("user_id", F.col("w.start").alias("started"), "n")


_ID = r"regexp_replace(lower({0}), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


@book.add(f"""WITH RECURSIVE nodes AS (SELECT {_ID.format('id')} AS id, {_ID.format('parent_artifact_id')} AS parent, artifact_type FROM {ART} a),
    up AS (SELECT id AS leaf, id, parent, 0 AS steps FROM nodes WHERE artifact_type = 'chunk' UNION ALL SELECT leaf, n.id, n.parent, steps + 1 FROM up JOIN nodes n ON n.id = up.parent WHERE steps < 400)
    SELECT leaf, id AS ancestor, steps FROM up WHERE steps <= 50 AND leaf NOT IN (SELECT leaf FROM up WHERE steps = 400)""")
def lineage_ancestry(t):
    return R.ancestry(t("artifacts"), kind="chunk", most=50)


_ENT = f"SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[A-Z][a-z]+ (?:[A-Z][a-z]+ )*(?:Board|Council|Bureau|Registry|Office|Authority)')) AS entity FROM {DOC} d WHERE text IS NOT NULL"


@book.add(f"SELECT entity, count(*) AS df, round(ln((SELECT count(*) FROM {DOC} d) / count(*)), 6) AS idf FROM ({_ENT}) GROUP BY entity HAVING count(*) >= 2")
def entity_idf(t):
    return R.entity_idf(t("documents"))


@book.add(f"""WITH e AS ({_ENT}), q AS (SELECT entity, ln((SELECT count(*) FROM {DOC} d) / count(*)) AS idf FROM e GROUP BY entity HAVING count(*) >= 2)
    SELECT e.entity, count(*) AS backlinks, min(doc_id) AS first_doc, max(doc_id) AS last_doc FROM e JOIN q USING (entity) WHERE idf >= 1.5 GROUP BY e.entity""")
def wiki_concepts(t):
    return R.concepts(t("documents"))


@book.add(f"""WITH o AS (SELECT doc_id, md5(text) AS h FROM {DOC} d WHERE doc_id % 10 <> 3 AND text IS NOT NULL), n AS (SELECT doc_id, md5(CASE WHEN doc_id % 7 = 0 THEN text || 'x' ELSE text END) AS h FROM {DOC} d WHERE doc_id % 10 <> 4 AND text IS NOT NULL)
    SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, CASE WHEN o.h IS NULL THEN 'new' WHEN n.h IS NULL THEN 'removed' WHEN o.h <> n.h THEN 'changed' ELSE 'unchanged' END AS status FROM o FULL JOIN n ON o.doc_id = n.doc_id""")
def wiki_manifest_diff(t):
    d = t("documents").where(F.col("text").isNotNull())
    old = d.where(F.col("doc_id") % 10 != 3).select("doc_id", F.md5("text").alias("h"))
    new = d.where(F.col("doc_id") % 10 != 4).select("doc_id", F.md5(F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text"))).alias("h"))
    return R.manifest_diff(old, new, "doc_id", "h")


@book.add(f"""WITH s AS (SELECT parsed_id, page_count, CAST(unnest(range(len(sections))) AS INT) AS section_no, unnest(sections) AS sec FROM {PARSED} p),
    n AS (SELECT parsed_id, page_count, section_no, len(regexp_extract_all(coalesce(sec.section_path, ''), '[.]')) + 1 AS level, sec.page AS page_start, coalesce(sec.is_table, false) AS is_table FROM s)
    SELECT parsed_id, section_no, CAST(level AS BIGINT) AS level, (SELECT max(m.section_no) FROM n m WHERE m.parsed_id = n.parsed_id AND m.section_no < n.section_no AND m.level < n.level AND NOT m.is_table) AS parent_no, page_start,
    CASE WHEN is_table THEN page_start WHEN EXISTS (SELECT 1 FROM n m WHERE m.parsed_id = n.parsed_id AND m.section_no > n.section_no AND m.level <= n.level)
    THEN (SELECT greatest(n.page_start, min_by(m.page_start, m.section_no) - 1) FROM n m WHERE m.parsed_id = n.parsed_id AND m.section_no > n.section_no AND m.level <= n.level) ELSE greatest(page_start, page_count) END AS page_end FROM n""")
def tree_nodes(t):
    return R.tree_nodes(t("parsed_docs"))


@book.add(f"SELECT p.parsed_id, len(sections) > 0 AS has_sections, EXISTS (SELECT 1 FROM {ART} a WHERE artifact_type = 'tree_index' AND {PAR} = p.parsed_id) AS has_index FROM {PARSED} p")
def tree_coverage(t):
    trees = t("artifacts").where(F.col("artifact_type") == "tree_index").select(R.parent().alias("parsed_id")).distinct().withColumn("tree", F.lit(True))
    return t("parsed_docs").join(trees, "parsed_id", "left").select("parsed_id", (F.size("sections") > 0).alias("has_sections"), F.coalesce("tree", F.lit(False)).alias("has_index"))


@book.add(f"SELECT id, nullif(s3, '') AS key, s3 <> '' AS valid FROM (SELECT id, regexp_extract(storage_uri, '^s3://[^/]+/(.+)$', 1) AS s3 FROM {ART} a WHERE storage_uri IS NOT NULL)")
def uri_to_key(t):
    key = F.nullif(F.regexp_extract("storage_uri", r"^s3://[^/]+/(.+)$", 1), F.lit(""))
    return t("artifacts").where(F.col("storage_uri").isNotNull()).select("id", key.alias("key"), key.isNotNull().alias("valid"))



