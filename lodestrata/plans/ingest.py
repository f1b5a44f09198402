"""Queries of intake and crawl control."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import ingest as G
from ..operators import neardup, pipeline
from ..operators import registry as R
from ..sources import links as L
from ..sources import parsers as P
from .base import Book
from .relational import ART, CH, DOC, DOMAIN, EX, PAR, PARSED, SRC
from .text import NORM, WORDS, _boiler, _rr

book = Book()
queries = lambda: book.queries
oracle_sql = lambda: book.sql

_EXT = "CASE mime_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in G.EXTENSION.items()) + " ELSE 'bin' END"
_TYPE = "CASE lower(regexp_extract(storage_uri, '[.]([^.]*)$', 1)) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in G.TYPE.items()) + " ELSE 'application/octet-stream' END"


@book.add(f"SELECT id, {_EXT} AS extension, {_TYPE} AS detected FROM {ART} a")
def mime_maps(t):
    return t("artifacts").select("id", G.extension_of(F.col("mime_type")).alias("extension"), F.coalesce(G.type_of(F.col("storage_uri")), F.lit("application/octet-stream")).alias("detected"))


#: Files of two kinds: the documents' texts, at addresses of their own, and once more under the address of a registered source.
_FILES = f"SELECT 'd' || doc_id AS key, text AS content, 'https://files.example/' || doc_id AS url FROM {DOC} d UNION ALL SELECT 'p' || parsed_id, text, 'https://files.example/' || parsed_id FROM {PARSED} p UNION ALL SELECT 's' || id, 'page of ' || name, url FROM {SRC} s UNION ALL SELECT 'r' || id, 'page of ' || name || '!', upper(url[1:5]) || url[6:] FROM {SRC} s"
_NORMAL = r"regexp_replace(lower(regexp_extract({0}, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) || '://' || lower(regexp_extract({0}, '^[^:]+://([^/?]*)', 1)) || CASE WHEN regexp_extract({0}, '^[^:]+://[^/?]*([^?]*)', 1) = '/' THEN '/' ELSE regexp_replace(regexp_extract({0}, '^[^:]+://[^/?]*([^?]*)', 1), '/+$', '') END || regexp_extract({0}, '([?].*)$', 1), '#.*$', '')"


def _files(t):
    file = lambda df, p, id, content, url: df.select(F.concat(F.lit(p), F.col(id).cast("string")).alias("key"), content.alias("content"), url.alias("url"))
    at = lambda id: F.concat(F.lit("https://files.example/"), F.col(id).cast("string"))
    s, url = t("sources"), F.col("url")
    rows = file(t("documents"), "d", "doc_id", F.col("text"), at("doc_id")).unionByName(file(t("parsed_docs"), "p", "parsed_id", F.col("text"), at("parsed_id")))
    rows = rows.unionByName(file(s, "s", "id", F.concat(F.lit("page of "), "name"), url))
    return rows.unionByName(file(s, "r", "id", F.concat(F.lit("page of "), "name", F.lit("!")), F.concat(F.upper(F.substring(url, 1, 5)), F.expr("substring(url, 6)"))))


def _known(t):
    held = t("documents").where("doc_id % 3 = 0").select(F.concat(F.lit("k"), F.col("doc_id").cast("string")).alias("id"), F.sha2(F.col("text").cast("binary"), 256).alias("content_hash"), F.lit(None).cast("string").alias("url"))
    return held.unionByName(t("sources").select("id", F.lit(None).cast("string").alias("content_hash"), "url"))


@book.add(f"""WITH f AS (SELECT key, sha256(content) AS h, {_NORMAL.format("regexp_replace(trim(url), '#.*$', '')")} AS u FROM ({_FILES})), k AS (SELECT sha256(text) AS h, min('k' || doc_id) AS same FROM {DOC} d WHERE doc_id % 3 = 0 AND text IS NOT NULL GROUP BY 1), a AS (SELECT {_NORMAL.format("regexp_replace(trim(url), '#.*$', '')")} AS u, min(id) AS at_id FROM {SRC} s WHERE url IS NOT NULL GROUP BY 1),
    j AS (SELECT f.*, same, at_id FROM f LEFT JOIN k ON k.h = f.h LEFT JOIN a ON a.u = f.u), n AS (SELECT h, min(key) AS first FROM j WHERE same IS NULL AND at_id IS NULL AND h IS NOT NULL GROUP BY h)
    SELECT key, CASE WHEN j.h IS NULL THEN 'empty' WHEN same IS NOT NULL THEN 'duplicate_content' WHEN at_id IS NOT NULL THEN 'existing_url' WHEN first = key THEN 'stored' ELSE 'duplicate_content' END AS status, CASE WHEN first = key THEN NULL ELSE coalesce(same, at_id, first) END AS of FROM j LEFT JOIN n ON n.h = j.h""")
def ingest_plan(t):
    """All texts taken in as files where a third of the documents is known by content and the sources by address."""
    return G.ingest_plan(_files(t), _known(t)).drop("content_hash")


@book.add(f"SELECT id, storage_uri IS NOT NULL AS stored, concat_ws('/', 'raw', coalesce({DOMAIN.replace('domain', 's.domain', 1).replace('config', 's.config')}, '_unclassified'), s.name, a.content_hash || '.' || ({_EXT.replace('mime_type', 'a.mime_type', 1)})) AS key FROM (SELECT id, source_id, content_hash, mime_type, storage_uri FROM {ART} x WHERE artifact_type = 'raw_document' AND content_hash IS NOT NULL) a JOIN {SRC} s ON s.id = a.source_id".replace("SELECT id, storage_uri", "SELECT a.id, a.storage_uri"))
def raw_object_keys(t):
    named = t("sources").select(F.col("id").alias("source_id"), R.domain().alias("domain"), "name")
    raw = t("artifacts").where((F.col("artifact_type") == "raw_document") & F.col("content_hash").isNotNull()).join(named, "source_id")
    return raw.select("id", F.col("storage_uri").isNotNull().alias("stored"), G.object_key("raw", F.col("domain"), F.col("name"), F.col("content_hash"), G.extension_of(F.col("mime_type"))).alias("key"))


@book.add(f"""SELECT u AS url, CASE WHEN why THEN 'skipped_ssrf' WHEN known THEN 'existing' ELSE 'registered' END AS status FROM (SELECT u, bool_or(lower(trim(url)) NOT LIKE 'https:%' OR url LIKE '%//10.%' OR url LIKE '%[::ffff:10.%') AS why, bool_or(u IN (SELECT normalized_url FROM {SRC} k WHERE normalized_url IS NOT NULL)) AS known
    FROM (SELECT url, {_NORMAL.format("regexp_replace(trim(url), '#.*$', '')")} AS u FROM (SELECT url FROM {SRC} s UNION ALL SELECT url || 'found' FROM {SRC} s UNION ALL SELECT replace(url, 'https:', 'http:') FROM {SRC} s UNION ALL SELECT 'https://10.0.0.8/' || name FROM {SRC} s UNION ALL SELECT 'https://[::ffff:10.0.0.8]/' || name FROM {SRC} s UNION ALL SELECT 'https://8.8.8.8/' || name FROM {SRC} s)) GROUP BY u)""")
def discover_register(t):
    s, url = t("sources"), F.col("url")
    at = lambda host: F.concat(F.lit(f"https://{host}/"), "name")
    asked = F.array(url, F.concat(url, F.lit("found")), F.replace(url, F.lit("https:"), F.lit("http:")), at("10.0.0.8"), at("[::ffff:10.0.0.8]"), at("8.8.8.8"), F.lit(" "))
    return G.discovered(s.select(F.explode(asked).alias("url")), s)


@book.add(f"SELECT parsed_id, status, status = 200 AND length(coalesce(body, '')) < 200 AS escalate FROM (SELECT parsed_id, text[1:150 + 20 * page_count] AS body, CASE WHEN page_count % 2 = 0 THEN 200 ELSE 404 END AS status FROM {PARSED} p)", per_row=True)
def escalate_pages(t):
    """Pages that came in part, or not at all where the page count is odd."""
    rows = t("parsed_docs").select("parsed_id", F.expr("substring(text, 1, 150 + 20 * page_count)").alias("body"), F.when(F.col("page_count") % 2 == 0, 200).otherwise(404).alias("status"))
    return rows.select("parsed_id", "status", G.should_escalate(F.col("status"), F.col("body")).alias("escalate"))


@book.add("""SELECT event_id, round(CASE WHEN seconds IS NOT NULL THEN seconds WHEN rps > 0 THEN 1 / rps WHEN rps IS NOT NULL THEN 2.0 ELSE coalesce(robots, 2.0) END + CASE WHEN errors > 0 THEN least(pow(2.0, errors), 60.0) ELSE 0.0 END, 6) AS delay FROM
    (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN value END AS seconds, CASE WHEN event_id % 5 IN (1, 2) THEN value - 20 END AS rps, CASE WHEN event_id % 5 = 3 THEN value END AS robots, event_id % 9 AS errors FROM events)""")
def crawl_delay(t):
    """All tiers, with up to eight errors in a row."""
    e, v = F.col("event_id"), F.col("value")
    only = lambda c, x: F.when(c, x)
    return t("events").select("event_id", F.round(G.crawl_delay(only(e % 5 == 0, v), only((e % 5).isin(1, 2), v - 20), only(e % 5 == 3, v), 2.0, e % 9), 6).alias("delay"))


@book.add("""SELECT event_id, round(CASE WHEN reported > 0 THEN reported ELSE coalesce(listed, coalesce(tin, 0) / 1000 * 0.15 + coalesce(tout, 0) / 1000 * 0.6, 0) END, 6) AS cost FROM
    (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN value - 10 END AS reported, CASE WHEN event_id % 4 = 1 THEN value END AS listed, CASE WHEN event_id % 4 < 3 THEN user_id * 100.0 END AS tin, user_id * 10.0 AS tout FROM events)""")
def call_cost(t):
    e, v = F.col("event_id"), F.col("value")
    tokens = F.when(e % 4 < 3, F.col("user_id") * 100.0)
    return t("events").select("event_id", F.round(G.call_cost(F.when(e % 4 == 0, v - 10), F.when(e % 4 == 1, v), tokens, F.col("user_id") * 10.0, 0.15, 0.6), 6).alias("cost"))


@book.add(f"SELECT DISTINCT id, regexp_replace(id, '^[^_]*_', '') AS bare FROM {ART} a")
def bare_ids(t):
    return t("artifacts").select("id", G.without_prefix(F.col("id")).alias("bare"))


_WORDS = "array_to_string(list_transform(string_split(trim(regexp_replace(regexp_replace(regexp_replace(regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1), '/+$', ''), '^.*/', ''), '[-_]+', ' ', 'g')), ' '), lambda w: upper(w[1:1]) || lower(w[2:])), ' ')"


@book.add(f"SELECT id, CASE WHEN w <> '' THEN w ELSE lower(regexp_extract(url, '^[^:]+://([^/?#]*)', 1)) END AS name FROM (SELECT id, url, {_WORDS} AS w FROM {SRC} s)")
def source_names(t):
    return t("sources").select("id", G.source_name(F.col("url")).alias("name"))


_CLEANED = _boiler("text", X.BOILERPLATE)


@book.add(f"SELECT parsed_id, sha256(parsed_id || ':' || {_CLEANED}) AS content_hash FROM {PARSED} p WHERE text IS NOT NULL", per_row=True)
def cleaned_content_hash(t):
    """Hashes scoped to the parent: equal texts of two documents differ."""
    return t("parsed_docs").where(F.col("text").isNotNull()).select("parsed_id", F.sha2(F.concat("parsed_id", F.lit(":"), X.remove_boilerplate(F.col("text"))), 256).alias("content_hash"))


@book.add(f"SELECT chunk_id, sha256(parsed_id || ':v1:' || text) AS content_hash FROM {CH} c WHERE text IS NOT NULL", per_row=True)
def chunk_content_hash(t):
    return t("chunks").where(F.col("text").isNotNull()).select("chunk_id", F.sha2(F.concat("parsed_id", F.lit(":v1:"), "text"), 256).alias("content_hash"))


@book.add(f"SELECT count(*) AS rows, count(DISTINCT id) AS distinct_ids, true AS well_formed FROM {EX} e")
def generated_ids(t):
    ids = t("dataset_examples").select(G.new_id("chunk", F.col("created_at"), F.col("id")).alias("id"))
    shaped = F.col("id").rlike("^chk_[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$") | F.col("id").isNull()
    return ids.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("distinct_ids"), F.min(shaped).alias("well_formed"))


@book.add(f"SELECT id, payload AS repaired FROM {EX} e WHERE payload IS NOT NULL AND json_valid(payload)", per_row=True)
def json_prefix(t):
    """Payloads within fences and with a tail that is none of them come out as they were."""
    rows = t("dataset_examples").where(F.col("payload").isNotNull() & F.try_parse_json("payload").isNotNull())
    return rows.select("id", G.json_prefix(F.concat(F.lit("```json\n"), "payload", F.lit(" and so on ]\n```"))).alias("repaired"))


@book.add(f"SELECT p.id AS parent, c.id AS child, row_number() OVER (PARTITION BY p.id ORDER BY c.created_at, c.id) AS place FROM {ART} p JOIN (SELECT id, {PAR} AS parent, created_at FROM {ART} a WHERE artifact_type <> 'chunk') c ON c.parent = p.id")
def ordered_children(t):
    """Children of every node by creation; the place is a running number from sorted partitions, so no parent is a hot group."""
    from ..runtime import running_totals

    children = t("artifacts").where(F.col("artifact_type") != "chunk").select(R.parent().alias("parent"), F.col("id").alias("child"), "created_at", F.lit(1).alias("one"))
    held = children.join(t("artifacts").select(F.col("id").alias("parent")), "parent", "left_semi")
    return running_totals(held, ["parent"], ["created_at", "child"], "one", "place").select("parent", "child", "place")


@book.add(f"SELECT id, source_id, created_at FROM {ART} r WHERE artifact_type = 'raw_document' AND id NOT IN (SELECT {PAR} FROM {ART} p WHERE artifact_type = 'parsed_document' AND {PAR} IS NOT NULL) ORDER BY created_at DESC, id LIMIT 20")
def next_unprocessed(t):
    return R.without_child(t("artifacts"), "raw_document", "parsed_document").select("id", "source_id", "created_at").orderBy(F.desc("created_at"), "id").limit(20)


@book.add(f"SELECT s.name AS source_name, count(*) AS documents, min(p.parsed_id) AS first_id FROM {PARSED} p JOIN {SRC} s ON s.id = p.source_id GROUP BY s.name")
def documents_by_source(t):
    named = t("sources").select(F.col("id").alias("source_id"), F.col("name").alias("source_name"))
    return t("parsed_docs").join(named, "source_id").groupBy("source_name").agg(F.count(F.lit(1)).alias("documents"), F.min("parsed_id").alias("first_id"))


@book.add(f"""SELECT count(*) AS sources, count(*) FILTER (ok) AS succeeded, count(*) FILTER (NOT ok) AS failed, CAST(sum(pages) AS BIGINT) AS pages FROM (SELECT s.id, count(a.id) AS pages, count(a.id) > 0 AS ok FROM {SRC} s LEFT JOIN (SELECT * FROM {ART} x WHERE artifact_type = 'raw_document') a ON a.source_id = s.id GROUP BY s.id)""")
def crawl_totals(t):
    pages = t("artifacts").where(F.col("artifact_type") == "raw_document").groupBy(F.col("source_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    rows = t("sources").join(pages, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("pages"))
    return rows.agg(F.count(F.lit(1)).alias("sources"), F.count_if(F.col("pages") > 0).alias("succeeded"), F.count_if(F.col("pages") == 0).alias("failed"), F.sum("pages").alias("pages"))


@book.add(None)
def due_sources(t):
    return G.due(t("sources"), "2025-06-01T00:00:00")


@book.add(None)
def robots_rules(t):
    """Every source's address against rules that shut out one tree for all."""
    s = t("sources").select(F.regexp_extract("url", r"^[^:]+://([^/?#]*)", 1).alias("host"), F.regexp_extract("url", r"^[^:]+://[^/?#]*([^?#]*)", 1).alias("path"))
    rules = F.when(F.length("host") % 2 == 0, "User-agent: *\nDisallow: /library\nCrawl-delay: 4")
    return G.robots(s.withColumn("robots_txt", rules)).distinct()


_HTML = """'<html><head><title>' || coalesce(title, '') || '</title></head><body><p>' || replace(coalesce(text, ''), chr(10), '</p><p>') || '</p></body></html>'"""


def _page(c="text"):
    return F.concat(F.lit("<html><head><title>"), F.coalesce("title", F.lit("")), F.lit("</title></head><body><p>"), F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("\n"), F.lit("</p><p>")), F.lit("</p></body></html>"))


@book.add(f"""SELECT parsed_id, CASE WHEN section_count > 6 THEN 'spider' WHEN section_count < 4 AND length(coalesce(text, '')) < 500 THEN 'browser' ELSE 'static' END AS crawler FROM (SELECT parsed_id, text, coalesce(len(sections), 0) AS section_count FROM {PARSED} p)""", per_row=True)
def select_crawler(t):
    """Pages of many sections stand at sitemap addresses, those of few are single-page applications."""
    n = F.coalesce(F.size("sections"), F.lit(0))
    url = F.when(n > 6, "https://x.example/SiteMap-1.xml").otherwise("https://x.example/page")
    html = F.when(n < 4, F.concat(F.lit('<div id="root">'), F.translate(F.coalesce("text", F.lit("")), "<>", "()"), F.lit("</div><script>a()</script><script>b()</script><script>c()</script>"))).otherwise(F.lit("<p>static</p>"))
    return t("parsed_docs").select("parsed_id", L.select_crawler(url, html).alias("crawler"))


@book.add(None)
def extract_links(t):
    """Each page stands on the site that its first link leads to."""
    site = F.regexp_extract(F.coalesce("text", F.lit("")), r"(https?://[^/\s)]+/)", 1)
    pages = t("parsed_docs").select("parsed_id", site.alias("url"), "text").where(F.col("url") != "")
    return L.extract_links(pages, id="parsed_id", url="url", content="text").distinct()


@book.add(None)
def extract_linked_docs(t):
    pages = t("parsed_docs").select("parsed_id", F.lit("https://www.site0.example/library/").alias("url"), F.replace("text", F.lit(")\n"), F.lit(".pdf)\n")).alias("text"))
    return L.extract_links(pages, id="parsed_id", url="url", content="text", documents=True).distinct()


@book.add(None)
def html_to_text(t):
    """Pages wrapped in markup and read back by the parser chain."""
    rows = P.parse_documents(t("parsed_docs").withColumn("raw", _page()).withColumn("mime", F.lit("text/html")), id="parsed_id", content="raw", mime="mime")
    return rows.select("parsed_id", F.length("text").alias("chars"), "title", "parser", "error").distinct()


_PERM = 128
_P31 = 4294967291


@book.add(f"""WITH w AS (SELECT doc_id, {WORDS('lower(text)')} AS w FROM {DOC} d WHERE text IS NOT NULL), s AS (SELECT DISTINCT doc_id, CAST('0x' || substr(md5(array_to_string(w[i:i + 4], ' ')), 1, 8) AS BIGINT) AS h FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0))
    SELECT doc_id, md5(string_agg(m, ',' ORDER BY p)) AS signature FROM (SELECT doc_id, p, CAST(min((h * (1000003 * (p + 1) % 2147483647) + 7919 * p) % {_P31}) AS VARCHAR) AS m FROM s, range({_PERM}) r(p) GROUP BY doc_id, p) GROUP BY doc_id""")
def minhash_signature(t):
    """128 minima of linear permutations of a 32-bit hash of the five-word shingles, as a digest."""
    return neardup.minhash(t("documents"), id="doc_id", permutations=_PERM)


def _raw(t):
    return t("parsed_docs").select("parsed_id", F.when(F.col("title").isNull(), F.lit("Just a moment... checking your browser before accessing " + "x" * 300)).otherwise(_sections()).alias("raw"), F.lit("text/markdown").alias("mime"))


def _sections():
    part = F.transform("sections", lambda s: F.concat(F.lit("# "), F.coalesce(F.nullif(s["heading"], F.lit("")), F.lit("Section")), F.lit("\n\n"), F.coalesce(s["text"], F.lit(""))))
    return F.array_join(part, "\n\n")


@book.add(None)
def process_crawled(t):
    """Pages to deduplicated points; those without a title came as a challenge."""
    points, failed = pipeline.run(_raw(t), id="parsed_id", content="raw", mime="mime")
    made = points.agg(F.count(F.lit(1)).alias("points"), F.sum("contributor_count").alias("chunks"), F.countDistinct("parsed_id").alias("documents"))
    return made.crossJoin(failed.agg(F.count(F.lit(1)).alias("failed")))


@book.add(None)
def run_document(t):
    """The same without cleaning and deduplication."""
    points, failed = pipeline.run(_raw(t), id="parsed_id", content="raw", mime="mime", clean=False, deduplicate=False)
    made = points.agg(F.count(F.lit(1)).alias("points"), F.sum("contributor_count").alias("chunks"), F.countDistinct("parsed_id").alias("documents"))
    return made.crossJoin(failed.agg(F.count(F.lit(1)).alias("failed")))
