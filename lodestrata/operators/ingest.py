"""Taking documents in: types, dedup by content and address, guards, robots rules, crawl control, costs, ids."""

from __future__ import annotations

import datetime
import ipaddress
import json
from urllib.parse import urlsplit
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

# Extensions of types and types of extensions.
EXTENSION = {"application/pdf": "pdf", "text/html": "html", "text/plain": "txt", "text/markdown": "md", "application/json": "json", "application/xml": "xml", "text/xml": "xml"}
TYPE = {"html": "text/html", "htm": "text/html", "pdf": "application/pdf", "txt": "text/plain", "md": "text/markdown", "json": "application/json", "xml": "application/xml", "csv": "text/csv"}
# Id prefixes of kinds.
PREFIX = {"source": "src", "raw_document": "doc", "parsed_document": "doc", "cleaned_document": "doc", "enriched_document": "doc", "chunk": "chk", "artifact": "art"}
#: A page with less text than this is fetched again by a browser.
SHORT_PAGE = 200
MAX_BACKOFF, COOLDOWN = 60.0, 30.0


def _lookup(table: dict[str, str], key: Column, other: str) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.element_at(pairs, key), F.lit(other))


def extension_of(mime: Column) -> Column:
    return _lookup(EXTENSION, mime, "bin")


def type_of(uri: Column) -> Column:
    """By what follows the last dot, in any case."""
    return _lookup(TYPE, F.when(F.instr(uri, ".") > 0, F.lower(F.substring_index(uri, ".", -1))), "application/octet-stream")


def ingest_plan(new: DataFrame, known: DataFrame) -> DataFrame:
    """(key, status, content_hash, of): of files (key, url, content) what becomes of each against known (id, content_hash, url).

    Content comes first: bytes that are known are `duplicate_content` of the known id. Else an address that is known, however it is
    spelled, is `existing_url`. Of new files with the same bytes the smallest key is `stored`, the others are duplicates of it. Null
    contents are `empty`.
    """
    rows = new.select("key", F.sha2(F.col("content").cast("binary"), 256).alias("content_hash"), X.normalize_url(F.col("url")).alias("url"))
    by_hash = known.where(F.col("content_hash").isNotNull()).groupBy("content_hash").agg(F.min("id").alias("same"))
    by_url = known.select(X.normalize_url(F.col("url")).alias("url"), "id").where(F.col("url").isNotNull()).groupBy("url").agg(F.min("id").alias("at"))
    rows = rows.join(by_hash, "content_hash", "left").join(by_url, "url", "left")
    fresh = rows.where(F.col("same").isNull() & F.col("at").isNull() & F.col("content_hash").isNotNull()).groupBy("content_hash").agg(F.min("key").alias("first"))
    rows = rows.join(fresh, "content_hash", "left")
    own = F.col("first") == F.col("key")
    status = F.when(F.col("content_hash").isNull(), "empty").when(F.col("same").isNotNull(), "duplicate_content").when(F.col("at").isNotNull(), "existing_url").when(own, "stored").otherwise("duplicate_content")
    return rows.select("key", status.alias("status"), "content_hash", F.when(~own | own.isNull(), F.coalesce("same", "at", "first")).alias("of"))


def object_key(zone: str, domain: Column, source: Column, digest: Column, extension: Column) -> Column:
    """Content-addressed: the same bytes of a source have one key."""
    return F.concat_ws("/", F.lit(zone), F.coalesce(domain, F.lit("_unclassified")), source, F.concat(digest, F.lit("."), extension))


def put_objects(rows: DataFrame, folder: str) -> DataFrame:
    """Appends rows (key, ...) whose key the folder lacks and returns those written; nothing is overwritten, so a repeat is no change."""
    spark = rows.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    rows = rows.dropDuplicates(["key"])
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        rows = rows.join(spark.read.parquet(folder).select("key"), "key", "left_anti")
    rows = rows.persist()
    rows.write.mode("append").parquet(folder)
    return rows


def get_objects(spark, folder: str, keys: DataFrame) -> DataFrame:
    """The stored rows of the keys; a key that is not there is an error."""
    found = keys.select("key").distinct().join(spark.read.parquet(folder).withColumn("_here", F.lit(True)), "key", "left")
    checked = F.when(F.col("_here"), F.col("key")).otherwise(F.raise_error(F.concat(F.lit("no such object: "), "key")))
    return found.withColumn("key", checked).drop("_here")


def reachable(url: Column) -> Column:
    """Null for a public https address, else why not: scheme, host, or a literal address that isn't routed globally. Names are
    resolved by the fetcher, which must ask again."""

    @F.pandas_udf("string")
    def check(urls: pd.Series) -> pd.Series:
        return urls.map(refusal)

    return check(url)


def refusal(url: str | None) -> str | None:
    try:
        parts = urlsplit(url or "")
        host = parts.hostname or ""
    except ValueError:
        return "malformed"
    if parts.scheme != "https":
        return "scheme"
    if not host or host == "localhost" or host.endswith(".localhost"):
        return "host"
    try:
        address = ipaddress.ip_address(host)
    except ValueError:
        return None
    address = getattr(address, "ipv4_mapped", None) or address
    return None if address.is_global else "address"


def discovered(results: DataFrame, sources: DataFrame) -> DataFrame:
    """(url, status) of search results: `existing` sources, addresses refused (`skipped_ssrf`), or `registered`; blank urls are
    dropped, spellings of one address come out once."""
    rows = results.where(F.coalesce(F.trim("url"), F.lit("")) != "").select(X.normalize_url(F.col("url")).alias("url"), reachable(F.col("url")).alias("why")).groupBy("url").agg(F.min("why").alias("why"))
    known = sources.select(F.col("normalized_url").alias("url")).where(F.col("url").isNotNull()).distinct().withColumn("known", F.lit(True))
    status = F.when(F.col("why").isNotNull(), "skipped_ssrf").when(F.col("known"), "existing").otherwise("registered")
    return rows.join(known, "url", "left").select("url", status.alias("status"))


def should_escalate(status: Column, text: Column) -> Column:
    """A page that came but holds hardly any text."""
    return (status == 200) & (F.char_length(F.coalesce(text, F.lit(""))) < SHORT_PAGE)


def robots(rules: DataFrame) -> DataFrame:
    """(host, path, allowed, delay) of (host, path, robots_txt): a host without robots.txt allows everything."""

    def judge(batches):
        for batch in batches:
            out, parsed = [], {}
            for host, path, body in zip(batch["host"], batch["path"], batch["robots_txt"]):
                if (host, body) not in parsed:
                    parsed[host, body] = RobotFileParser()
                    parsed[host, body].parse((body or "").splitlines())
                policy = parsed[host, body]
                path = path or "/"
                delay = policy.crawl_delay("*")
                out.append((host, path, not body or policy.can_fetch("*", f"http://example.com{path if path.startswith('/') else '/' + path}"), None if delay is None else float(delay)))
            yield pd.DataFrame(out, columns=["host", "path", "allowed", "delay"])

    return rules.select("host", "path", "robots_txt").mapInPandas(judge, "host string, path string, allowed boolean, delay double")


def crawl_delay(seconds: Column, rps: Column, robots_delay: Column, default: float, errors: Column, base: float = 1.0) -> Column:
    """The source's seconds, else its rate (none or below zero: the default), else the robots delay, else the default; and for n errors
    in a row min(base * 2 ** n, 60) on top."""
    tier = F.when(seconds.isNotNull(), seconds).when(rps > 0, 1 / rps).when(rps.isNotNull(), F.lit(default)).otherwise(F.coalesce(robots_delay, F.lit(default)))
    extra = F.when(F.coalesce(errors, F.lit(0)) > 0, F.least(base * F.pow(F.lit(2.0), errors), F.lit(MAX_BACKOFF))).otherwise(0.0)
    return tier + extra


def _field(spec: str, low: int, high: int) -> set[int]:
    found: set[int] = set()
    for part in spec.split(","):
        body, _, step = part.partition("/")
        a, _, b = body.partition("-")
        first, last = (low, high) if body == "*" else (int(a), int(b) if b else high if step else int(a))
        found.update(range(first, last + 1, int(step or 1)))
    return found


def cron_ticks(spec: str, start: datetime.datetime, forward: bool) -> datetime.datetime | None:
    """The first tick of a five-field schedule after `start`, or the last one up to it; null for none within five years."""
    minute, hour, day, month, weekday = spec.split()
    minutes, hours = sorted(_field(minute, 0, 59)), sorted(_field(hour, 0, 23))
    days, months, weekdays = _field(day, 1, 31), _field(month, 1, 12), {d % 7 for d in _field(weekday, 0, 7)}
    either = day != "*" and weekday != "*"  # both given: either will do
    step = datetime.timedelta(days=1 if forward else -1)
    date = start.date()
    for _ in range(5 * 366):
        fits = date.day in days, date.isoweekday() % 7 in weekdays
        if date.month in months and (any(fits) if either else all(fits)):
            times = (datetime.datetime.combine(date, datetime.time(h, m), start.tzinfo) for h in hours[:: 1 if forward else -1] for m in minutes[:: 1 if forward else -1])
            if hit := next((x for x in times if (x > start if forward else x <= start)), None):
                return hit
        date += step
    return None


def due(sources: DataFrame, now: str) -> DataFrame:
    """(id, due, run_key) of sources with a schedule: due from the first tick after the last visit, or else the registration, on;
    run_key names the source and the latest tick, so asking twice starts nothing twice. Malformed schedules are never due."""
    at = datetime.datetime.fromisoformat(now).replace(tzinfo=datetime.UTC)

    @F.pandas_udf("due boolean, run_key string")
    def judge(ids: pd.Series, specs: pd.Series, bases: pd.Series) -> pd.DataFrame:
        out = []
        for name, spec, base in zip(ids, specs, bases):
            try:
                tick = cron_ticks(spec, base.to_pydatetime().replace(tzinfo=datetime.UTC), True)
                on = tick is not None and at >= tick
                fire = cron_ticks(spec, at, False) if on else None
            except (ValueError, AttributeError):
                on, fire = False, None
            out.append((on, f"{name}:{fire.isoformat()}" if fire else None))
        return pd.DataFrame(out, columns=["due", "run_key"])

    rows = sources.where(F.col("crawl_schedule").isNotNull())
    base = F.coalesce("last_crawled_at", "created_at").cast("timestamp_ntz")
    return rows.select("id", judge("id", "crawl_schedule", base).alias("j")).select("id", "j.due", "j.run_key")


def call_cost(reported: Column, listed: Column, prompt: Column, completion: Column, per_1k_in: float, per_1k_out: float) -> Column:
    """What the provider reports if it is above zero, else the list price, else tokens at flat rates, else zero."""
    flat = F.coalesce(prompt, F.lit(0)) / 1000 * per_1k_in + F.coalesce(completion, F.lit(0)) / 1000 * per_1k_out
    return F.when(reported > 0, reported).otherwise(F.coalesce(listed, flat, F.lit(0.0)))


def new_id(kind: str, at: Column, seed: Column) -> Column:
    """prefix_ and a version-7 UUID: the milliseconds of `at`, then digits hashed from `seed`, so a repeated task names things alike."""
    if kind not in PREFIX:
        raise ValueError(f"no such kind: {kind}; known are {sorted(PREFIX)}")
    time = F.lpad(F.lower(F.hex(F.unix_millis(at.cast("timestamp")))), 12, "0")
    digest = F.sha2(seed.cast("string"), 256)
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(digest, 4, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    uuid = F.concat_ws("-", F.substring(time, 1, 8), F.substring(time, 9, 4), F.concat(F.lit("7"), F.substring(digest, 1, 3)), F.concat(variant, F.substring(digest, 5, 3)), F.substring(digest, 8, 12))
    return F.concat(F.lit(PREFIX[kind] + "_"), uuid)


def without_prefix(id: Column) -> Column:
    return F.regexp_replace(id, "^[^_]*_", "")


def source_name(url: Column) -> Column:
    """The last segment of the path as words with capitals, else the host."""
    path = F.regexp_replace(F.regexp_extract(url, r"^[^:]+://[^/?#]*([^?#]*)", 1), "/+$", "")
    last = F.regexp_replace(F.substring_index(path, "/", -1), r"[.][A-Za-z0-9]{1,5}$", "")
    words = F.initcap(F.trim(F.regexp_replace(last, "[-_]+", " ")))
    return F.when(words != "", words).otherwise(F.lower(F.regexp_extract(url, r"^[^:]+://([^/?#]*)", 1)))


def json_prefix(text: Column) -> Column:
    """The longest beginning that closes the outermost object, fences of code removed; texts that close none stay as they are."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(closed_prefix, na_action="ignore")

    return cut(text)


def closed_prefix(text: str) -> str:
    bare = text.strip()
    if bare.startswith("```"):
        bare = bare.removeprefix("```json").removeprefix("```").removesuffix("```").strip()
    decoder, end = json.JSONDecoder(strict=False), 0
    opened = bare.find("{")
    if opened < 0:
        return bare
    try:
        end = decoder.raw_decode(bare, opened)[1]
    except ValueError:
        return _balanced(bare)
    more = bare.find("{", end)
    return _balanced(bare) if more >= 0 else bare[:end]


def _balanced(text: str) -> str:
    """By counting braces outside strings."""
    depth, last, quoted, i = 0, 0, False, 0
    while i < len(text):
        c = text[i]
        if quoted and c == "\\":
            i += 1
        elif c == '"':
            quoted = not quoted
        elif not quoted and c in "{}":
            depth += 1 if c == "{" else -1
            last = i + 1 if c == "}" and depth == 0 else last
        i += 1
    return text[:last] if last else text
