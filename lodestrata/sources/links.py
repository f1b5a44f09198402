"""Links, crawl order and crawler choice over fetched pages."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import urldefrag, urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_url
from ..runtime import cut

_HREF = re.compile(r"""href\s*=\s*["']?([^"'\s>]+)|\]\((https?://[^)\s]+)\)""", re.I)
# File types that are no pages.
ASSETS = (".png", ".jpg", ".jpeg", ".gif", ".svg", ".css", ".js", ".ico", ".woff", ".woff2", ".ttf", ".eot", ".mp4", ".mp3", ".zip", ".gz", ".tar", ".exe")
# Public suffixes of two labels that are told apart; others are taken to have one.
SECOND_LEVEL = {"co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "gov.au", "co.jp", "co.nz", "com.br", "co.in"}


def registrable(host: str) -> str:
    labels = host.lower().split(":")[0].split(".")
    n = 3 if ".".join(labels[-2:]) in SECOND_LEVEL else 2
    return ".".join(labels[-n:])


def links(page: str | None, base: str, *, documents: bool = False, most: int | None = None) -> list[str]:
    """Absolute links in order, once each: pages of the same registrable domain, or else PDF and DOCX files anywhere."""
    found: list[str] = []
    for m in _HREF.finditer(page or ""):
        try:
            url = urldefrag(urljoin(base, m[1] or m[2]))[0]
            parts = urlsplit(url)
        except ValueError:
            continue
        path = parts.path.lower()
        if parts.scheme not in ("http", "https") or url in found:
            continue
        if documents and path.endswith((".pdf", ".docx")) or not documents and registrable(parts.netloc) == registrable(urlsplit(base).netloc) and not path.endswith(ASSETS):
            found.append(url)
    return found[:most] if most else found


def extract_links(pages: DataFrame, *, id: str, url: str, content: str, documents: bool = False) -> DataFrame:
    """(id, ord, link) of every page; null contents have none."""
    kind = dict(pages.dtypes)[id]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(i, k, x) for i, u, c in zip(batch["id"], batch["url"], batch["content"]) for k, x in enumerate(links(c, u or "", documents=documents, most=10 if documents else None))]
            yield pd.DataFrame(out, columns=["id", "ord", "link"])

    return pages.select(F.col(id).alias("id"), F.col(url).alias("url"), F.col(content).alias("content")).mapInPandas(run, f"id {kind}, ord int, link string").withColumnRenamed("id", id)


def crawl_order(edges: DataFrame, seeds: DataFrame, *, depth: int = 2, most: int = 50, blocked: DataFrame | None = None, failed: DataFrame | None = None, done: DataFrame | None = None) -> DataFrame:
    """(job, url, level, status): breadth-first frontier over known links (url, link) from seeds (job, url), `most` pages a job.

    Levels are joins and anti-joins; within the page budget, lower levels and then smaller URLs come first. Pages of blocked
    (url) are `robots_blocked`, of failed (url) `failed`: both use up budget but lead nowhere; done (job, url) resumes: what it holds counts as
    `complete` and is not fetched again. Links beyond the seeds' registrable domains are not followed and cost nothing.
    """

    @F.pandas_udf("string")
    def home(hosts: pd.Series) -> pd.Series:
        return hosts.map(registrable, na_action="ignore")

    host = lambda c: F.regexp_extract(c, r"^[^:]+://([^/?#]*)", 1)
    url = lambda df, c="url": df.select(normalize_url(F.col(c)).alias("url")).distinct()
    out = edges.select(normalize_url(F.col("url")).alias("url"), normalize_url(F.col("link")).alias("link")).distinct()
    barred = None
    for df, status in ((blocked, "robots_blocked"), (failed, "failed")):
        if df is not None:
            part = url(df).withColumn("status", F.lit(status))
            barred = part if barred is None else barred.unionByName(part)
    barred = barred.groupBy("url").agg(F.max("status").alias("status")) if barred is not None else out.select("url", F.lit("").alias("status")).limit(0)
    starts = seeds.select("job", normalize_url(F.col("url")).alias("url")).distinct()
    homes = cut(starts.select("job", home(host("url")).alias("home")).distinct())
    seen = cut(starts.withColumn("level", F.lit(0)))
    frontier = seen
    for level in range(1, depth + 1):
        open_ = frontier.join(barred.select("url"), "url", "left_anti")
        reached = open_.join(out, "url").select("job", F.col("link").alias("url")).distinct().withColumn("home", home(host("url"))).join(homes, ["job", "home"], "left_semi").select("job", "url")
        frontier = cut(reached.join(seen.select("job", "url"), ["job", "url"], "left_anti").withColumn("level", F.lit(level)))
        seen = seen.unionByName(frontier)
    rank = F.row_number().over(Window.partitionBy("job").orderBy("level", "url"))
    chosen = seen.withColumn("k", rank).where(F.col("k") <= most).drop("k").join(barred, "url", "left")
    if done is not None:
        finished = done.select("job", normalize_url(F.col("url")).alias("url"), F.lit("complete").alias("known")).distinct()
        chosen = chosen.join(finished, ["job", "url"], "left").withColumn("status", F.coalesce("status", "known")).drop("known")
    return chosen.select("job", "url", "level", F.coalesce("status", F.lit("pending")).alias("status"))


def select_crawler(url: Column, html: Column) -> Column:
    """`spider` for sitemaps, `browser` for pages that are mostly script, else `static`."""
    text = F.char_length(F.regexp_replace(F.regexp_replace(html, r"(?is)<script.*?</script>", ""), r"<[^>]*>", ""))
    scripted = html.rlike(r'(?i)id="(?:root|app|__next)"|ng-app|data-reactroot') & (text < 500) & (F.regexp_count(html, F.lit("(?i)<script")) >= 3)
    return F.when(F.lower(url).rlike(r"sitemap[^/]*\.xml$"), "spider").when(scripted, "browser").otherwise("static")

