"""Queries of the export gates, scores and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import exports as E
from ..operators import registry as R
from ..operators import rules as Q
from .base import Book
from .relational import _CHAIN, _LEDGER, ART, CH, DOMAIN, EX, PAR, PARSED, SRC, child
from .text import _C4, _C4_LINES, _GOPHER, HASHED, WORDS, _signature

book = Book()
queries = lambda: book.queries
oracle_sql = lambda: book.sql

NAMED = DOMAIN.replace("domain", "s.domain", 1).replace("config", "s.config")
#: The domain that the domain-scoped queries ask for.
SCOPE = "healthcare"

_RAG = f"""SELECT c.chunk_id, coalesce(x.parsed_id, '') AS document_id, coalesce(c.section_path, '') AS section_path, coalesce(c.page, 1) AS page, c.text, {NAMED} AS domain, json_extract_string(e.metadata, '$.document_type') AS document_type, '' AS keywords, x.enriched_score AS quality_score
    FROM {CH} c JOIN ({_CHAIN}) x ON x.chunk_id = c.chunk_id LEFT JOIN {SRC} s ON s.id = c.source_id LEFT JOIN {ART} e ON e.id = x.enriched_id WHERE c.substance_passed"""


def _rag(t, wanted=None):
    rows = E.rag_export(t("artifacts"), t("chunks"), t("sources"), wanted)
    return rows.withColumn("keywords", F.array_join("keywords", "|"))


@book.add(_RAG)
def export_rag_corpus(t):
    return _rag(t)


@book.add(f"SELECT * FROM ({_RAG}) WHERE domain = '{SCOPE}'")
def export_rag_domain(t):
    return _rag(t, SCOPE)


_PRETRAIN = f"""SELECT u.id AS curated_id, c.p AS parsed_id, coalesce(p.text, '') AS text, u.quality_score, u.source_id FROM (SELECT id, source_id, {PAR} AS k, quality_score FROM {ART} a WHERE artifact_type = 'curated_document' AND coalesce(quality_score, 0) >= 0.4) u
    JOIN (SELECT id, {PAR} AS p FROM {ART} a WHERE artifact_type = 'cleaned_document') c ON c.id = u.k LEFT JOIN {PARSED} p ON p.parsed_id = c.p"""


@book.add(f"SELECT curated_id, parsed_id, text, quality_score FROM ({_PRETRAIN})")
def export_pretrain(t):
    return R.pretrain_rows(t("artifacts"), t("parsed_docs"))


@book.add(f"SELECT curated_id, parsed_id, quality_score, d.domain FROM ({_PRETRAIN}) p JOIN (SELECT id, {DOMAIN} AS domain FROM {SRC} s) d ON d.id = p.source_id WHERE d.domain = '{SCOPE}'")
def export_pretrain_domain(t):
    homes = t("artifacts").where(F.col("artifact_type") == "curated_document").select(F.col("id").alias("curated_id"), "source_id")
    named = homes.join(t("sources").select(F.col("id").alias("source_id"), R.domain().alias("domain")), "source_id")
    rows = R.pretrain_rows(t("artifacts"), t("parsed_docs").select("parsed_id", "text")).drop("text").join(named.drop("source_id"), "curated_id")
    return E.in_domain(rows, SCOPE)


_TUNE = f"""SELECT e.id, e.dataset, CASE WHEN json_exists(payload, '$.question') THEN payload->>'$.question' WHEN coalesce(payload->>'$.input', '') <> '' THEN (payload->>'$.instruction') || chr(10) || chr(10) || (payload->>'$.input') ELSE payload->>'$.instruction' END AS prompt,
    CASE WHEN json_exists(payload, '$.question') THEN payload->>'$.answer' ELSE payload->>'$.output' END AS completion FROM {EX} e SEMI JOIN {ART} a ON a.id = e.source_artifact_id"""


@book.add(f"SELECT id, dataset, prompt AS user_content, completion AS assistant_content, 2 AS messages FROM ({_TUNE})")
def export_finetune(t):
    """The chat messages of each example, as the export writes them."""
    rows = R.finetune(t("dataset_examples"), t("artifacts"))
    message = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    rows = rows.select("id", "dataset", F.array(message("user", "prompt"), message("assistant", "completion")).alias("m"))
    return rows.select("id", "dataset", F.col("m")[0]["content"].alias("user_content"), F.col("m")[1]["content"].alias("assistant_content"), F.size("m").alias("messages"))


_SIDES = f"""ev AS (SELECT DISTINCT k.id AS cleaned_id FROM {EX} e JOIN (SELECT id, {PAR} AS p FROM {ART} a WHERE artifact_type = 'chunk') c ON c.id = e.source_artifact_id JOIN {child('cleaned_document')} k ON k.parent = c.p WHERE json_exists(e.payload, '$.question')),
    tr AS (SELECT {PAR} AS cleaned_id FROM {ART} a WHERE artifact_type = 'enriched_document' AND {PAR} IS NOT NULL AND id IN (SELECT source_artifact_id FROM {EX} x WHERE json_exists(x.payload, '$.instruction') AND NOT json_exists(x.payload, '$.question'))
    UNION SELECT {PAR} FROM {ART} b WHERE artifact_type = 'curated_document' AND coalesce(quality_score, 0) >= 0.4 AND {PAR} IS NOT NULL)"""
#: Documents flagged for the test: those whose text another document has too.
_COPIES = f"""cp AS (SELECT k.id AS cleaned_id, count(*) OVER (PARTITION BY h) > 1 AS dup FROM (SELECT id, {PAR} AS p FROM {ART} a WHERE artifact_type = 'cleaned_document') k JOIN (SELECT parsed_id, {HASHED('text')} AS h FROM {PARSED} d WHERE text IS NOT NULL) d ON d.parsed_id = k.p)"""


def _statuses(t):
    hashed = t("parsed_docs").where(F.col("text").isNotNull()).select("parsed_id", X.text_hash(F.col("text")).alias("h")).distinct()
    cleaned = t("artifacts").where(F.col("artifact_type") == "cleaned_document").select(F.col("id").alias("cleaned_id"), R.parent().alias("parsed_id")).join(hashed, "parsed_id")
    counts = cleaned.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    return cleaned.join(counts, "h").select("cleaned_id", F.when(F.col("n") > 1, "near_dup").otherwise("unique").alias("dedup_status"))


def _none(t):
    return t("artifacts").select(F.col("id").alias("cleaned_id")).limit(0)


@book.add(f"WITH {_SIDES} SELECT cleaned_id FROM ev INTERSECT SELECT cleaned_id FROM tr")
def contamination_direct(t):
    return E.contamination(t("dataset_examples"), t("artifacts"), _statuses(t), _none(t)).where("direct").select("cleaned_id")


@book.add(f"""WITH {_SIDES}, {_COPIES}, nd AS (SELECT cleaned_id FROM cp WHERE dup), e2 AS (SELECT cleaned_id FROM ev INTERSECT SELECT cleaned_id FROM nd), t2 AS (SELECT cleaned_id FROM tr INTERSECT SELECT cleaned_id FROM nd)
    SELECT cleaned_id FROM (SELECT cleaned_id FROM e2 UNION SELECT cleaned_id FROM t2) WHERE (SELECT count(*) FROM e2) > 0 AND (SELECT count(*) FROM t2) > 0""")
def contamination_near_dup(t):
    return E.contamination(t("dataset_examples"), t("artifacts"), _statuses(t), _none(t)).where("near_dup").select("cleaned_id")


@book.add(f"""WITH {_SIDES}, ov AS (SELECT id AS cleaned_id FROM {ART} a WHERE artifact_type = 'cleaned_document' AND json_exists(metadata, '$.flags')) SELECT cleaned_id FROM ev WHERE cleaned_id IN (SELECT cleaned_id FROM tr) AND cleaned_id NOT IN (SELECT cleaned_id FROM ov)""")
def contamination_overridden(t):
    """The direct overlap without reviewed documents, here those whose metadata carry flags."""
    flagged = t("artifacts").where((F.col("artifact_type") == "cleaned_document") & E.has_key("metadata", "flags")).select(F.col("id").alias("cleaned_id"))
    return E.contamination(t("dataset_examples"), t("artifacts"), _statuses(t).where("false"), flagged).select("cleaned_id")


@book.add(f"WITH {_SIDES} SELECT cleaned_id, cleaned_id IN (SELECT cleaned_id FROM ev) AS in_eval, cleaned_id IN (SELECT cleaned_id FROM tr) AS in_train FROM (SELECT cleaned_id FROM ev UNION SELECT cleaned_id FROM tr)")
def train_eval_sides(t):
    ev = E.eval_documents(t("dataset_examples"), t("artifacts")).withColumn("in_eval", F.lit(True))
    tr = E.train_documents(t("dataset_examples"), t("artifacts")).withColumn("in_train", F.lit(True))
    return ev.join(tr, "cleaned_id", "full").na.fill(False)


_MADE = "CASE WHEN rejection_reason IS NULL THEN '{}' ELSE '{\"substance_passed\": ' || coalesce(CAST(substance_passed AS VARCHAR), 'null') || '}' END"


@book.add(f"SELECT chunk_id, NOT json_exists(m, '$.substance_passed') OR coalesce(json_extract_string(m, '$.substance_passed') = 'true', false) AS kept FROM (SELECT chunk_id, {_MADE} AS m FROM {CH} c)")
def substance_skip(t):
    """Outcomes as they stand in metadata: no key without a reason, else true, false or an explicit null."""
    made = F.when(F.col("rejection_reason").isNull(), "{}").otherwise(F.concat(F.lit('{"substance_passed": '), F.coalesce(F.col("substance_passed").cast("string"), F.lit("null")), F.lit("}")))
    return t("chunks").select("chunk_id", made.alias("m")).select("chunk_id", E.substance_kept(F.col("m")).alias("kept"))


_RATIO = f"""SELECT parsed_id, (CASE WHEN g = 'passed' THEN 1 ELSE 0 END + CASE WHEN c = 'passed' THEN 1 ELSE 0 END) / 2.0 AS ratio FROM (SELECT parsed_id, {_GOPHER} AS g, {_C4} AS c FROM
    (SELECT parsed_id, text, string_split(text, chr(10)) AS ls, {WORDS('text')} AS ws, list_avg(list_transform({WORDS('text')}, lambda w: length(w))) AS mean, {_C4_LINES} AS kept FROM {PARSED} p WHERE text IS NOT NULL))"""


@book.add(f"""SELECT u.id AS curated_id, round(greatest(0, least(1, 0.3 * coalesce(CAST(json_extract(p.metadata, '$.parse_quality') AS DOUBLE), 0.5) + 0.4 * coalesce(e.quality_score, 0.5) + 0.3 * coalesce(r.ratio, 0))), 6) AS composite
    FROM (SELECT id, {PAR} AS k FROM {ART} a WHERE artifact_type = 'curated_document') u LEFT JOIN (SELECT id, {PAR} AS p FROM {ART} a WHERE artifact_type = 'cleaned_document') c ON c.id = u.k
    LEFT JOIN (SELECT id, metadata FROM {ART} a WHERE artifact_type = 'parsed_document') p ON p.id = c.p LEFT JOIN {child('enriched_document')} e ON e.parent = u.k LEFT JOIN ({_RATIO}) r ON r.parsed_id = c.p""")
def composite_two_filters(t):
    """The composite with the ratio of the two filters that SQL can say as well."""
    rows = t("parsed_docs").where(F.col("text").isNotNull()).select("parsed_id", "text", Q.once(X.words(F.col("text"))).alias("words")).withColumn("kept", Q.c4_lines(F.col("text")))
    codes = rows.select("parsed_id", Q.gopher_quality_code(F.col("text"), F.col("words")).alias("g"), Q.c4_code(F.col("text"), F.col("kept")).alias("c"))
    ratio = (F.when(F.col("g") == "passed", 1).otherwise(0) + F.when(F.col("c") == "passed", 1).otherwise(0)) / 2
    return E.composite(t("artifacts"), codes.select("parsed_id", ratio.alias("ratio")))


@book.add(None)
def composite_quality(t):
    results = E.filter_results(t("parsed_docs").select("parsed_id", "text"), id="parsed_id")
    return E.composite(t("artifacts"), results.select("parsed_id", E.pass_ratio(F.col("results")).alias("ratio")))


@book.add(None)
def filter_results(t):
    rows = E.filter_results(t("parsed_docs").select("parsed_id", "text"), id="parsed_id").select("parsed_id", F.explode("results").alias("filter", "r"))
    return rows.select("parsed_id", "filter", "r.passed", "r.reason")


_VISIT = f"""SELECT s.id, last_crawled_at, CASE WHEN crawl_schedule IS NULL THEN last_content_hash ELSE coalesce(g.signature, last_content_hash) END AS stored, CASE WHEN source_type = 'pdf' THEN 400 ELSE 30 END AS days, g.signature
    FROM {SRC} s LEFT JOIN (SELECT source_id, min_by({_signature('text')}, parsed_id) AS signature FROM {PARSED} p WHERE text IS NOT NULL GROUP BY source_id) g ON g.source_id = s.id"""


@book.add(f"""SELECT id, CASE WHEN reason IS NULL THEN 'skipped_unchanged' ELSE 'recrawled' END AS status, reason, CASE WHEN reason IS NULL THEN stored ELSE signature END AS last_content_hash FROM
    (SELECT *, CASE WHEN stored IS NULL THEN 'null_hash' WHEN last_crawled_at < TIMESTAMPTZ '2025-06-01 00:00:00+00' - to_days(days) THEN 'stale' WHEN stored IS DISTINCT FROM signature THEN 'changed' END AS reason FROM ({_VISIT}))""")
def recrawl_decision(t):
    """A visit where the scheduled sources are unchanged since the last one, the page fetched being each source's first."""
    pages = t("parsed_docs").where(F.col("text").isNotNull()).select("source_id", "parsed_id", X.change_signature(F.col("text")).alias("g"))
    probes = pages.groupBy(F.col("source_id").alias("id")).agg(F.min_by("g", "parsed_id").alias("signature"))
    held = t("sources").join(probes, "id", "left").withColumn("last_content_hash", F.when(F.col("crawl_schedule").isNull(), F.col("last_content_hash")).otherwise(F.coalesce("signature", "last_content_hash")))
    held = held.drop("signature").withColumn("max_staleness_days", F.when(F.col("source_type") == "pdf", 400))
    return E.recrawl(held, probes, "2025-06-01 00:00:00").drop("last_crawled_at")


@book.add(f"""WITH {_COPIES}, u AS (SELECT DISTINCT {PAR} AS k FROM {ART} a WHERE artifact_type = 'curated_document')
    SELECT count(*) AS total, count(*) FILTER (k IS NOT NULL AND NOT dup) AS "unique", count(*) FILTER (k IS NOT NULL AND dup) AS near_dup, count(*) FILTER (k IS NULL) AS skipped_no_curation FROM cp LEFT JOIN u ON u.k = cp.cleaned_id""")
def batch_dedup_summary(t):
    return E.dedup_summary(_statuses(t), t("artifacts"))


_ASKED = f"SELECT DISTINCT unnest([p[1:3], p[1:14], p[1:24], p, 'chk_%', 'zzzz-none']) AS prefix FROM (SELECT coalesce(source_artifact_id, 'x') AS p FROM {EX} e)"


@book.add(f"""WITH q AS ({_ASKED}), i AS (SELECT DISTINCT id FROM artifacts), l AS (SELECT DISTINCT length(prefix) AS n FROM q WHERE length(prefix) BETWEEN 4 AND 39), b AS (SELECT id, left(id, n) AS prefix FROM i, l WHERE length(id) >= n), h AS (SELECT prefix, count(*) AS n, min(id) AS id FROM q JOIN b USING (prefix) GROUP BY prefix)
    SELECT q.prefix, CASE WHEN length(q.prefix) >= 40 THEN 'full' WHEN length(q.prefix) < 4 THEN 'too_short' WHEN n IS NULL THEN 'none' WHEN n > 1 THEN 'ambiguous' ELSE 'found' END AS status, CASE WHEN length(q.prefix) >= 40 THEN q.prefix WHEN n = 1 THEN h.id END AS id FROM q LEFT JOIN h ON h.prefix = q.prefix""")
def id_prefix(t):
    p = F.coalesce("source_artifact_id", F.lit("x"))
    asked = F.array(p.substr(1, 3), p.substr(1, 14), p.substr(1, 24), p, F.lit("chk_%"), F.lit("zzzz-none"))
    return E.expanded_prefixes(t("artifacts"), t("dataset_examples").select(F.explode(asked).alias("prefix")))


@book.add(f"""WITH l AS ({_LEDGER}), m AS (SELECT text_hash, max(chunk_id) AS primary_id FROM l GROUP BY text_hash), k AS (SELECT l.*, row_number() OVER (PARTITION BY l.text_hash ORDER BY (chunk_id = primary_id) DESC, ord, chunk_id) AS k FROM l JOIN m USING (text_hash))
    SELECT text_hash, string_agg(chunk_id, '|' ORDER BY k) AS contributors FROM k WHERE k <= 50 GROUP BY text_hash""")
def contributors_capped(t):
    """The primary is the latest chunk, as after a repair, so it isn't the first by order."""
    rows = R.hashed(t("chunks"))
    return R.contributors(rows, most=50, primary=rows.groupBy("text_hash").agg(F.max("chunk_id").alias("primary_id")))
