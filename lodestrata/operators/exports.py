"""Gates and row builders of the exports: train/eval overlap, scores, allow-listed columns, recrawl and dedup summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from . import rules as Q
from .registry import domain, first_child, of_type, parent

# The columns that a retrieval export may have.
RAG_COLUMNS = ["chunk_id", "document_id", "section_path", "page", "text", "domain", "document_type", "keywords", "quality_score"]


class ContaminationError(RuntimeError):
    """Training and evaluation share documents that no override names."""


def has_key(payload: str, key: str) -> Column:
    return F.coalesce(F.array_contains(F.json_object_keys(payload), key), F.lit(False))


def eval_documents(examples: DataFrame, artifacts: DataFrame) -> DataFrame:
    """(cleaned_id) of the documents whose chunks QA examples come from: chunk, its parsed document, that one's first cleaned child."""
    asked = examples.where(has_key("payload", "question")).select(F.col("source_artifact_id").alias("id"))
    chunks = of_type(artifacts, "chunk").join(asked, "id", "left_semi").select(parent().alias("parsed_id"))
    return chunks.join(first_child(artifacts, "cleaned_document", "parsed_id", "cleaned"), "parsed_id").select("cleaned_id").distinct()


def train_documents(examples: DataFrame, artifacts: DataFrame, least: float = 0.4) -> DataFrame:
    """(cleaned_id) behind instruction examples made from enriched documents, and behind curated documents of at least that score."""
    told = examples.where(has_key("payload", "instruction") & ~has_key("payload", "question")).select(F.col("source_artifact_id").alias("id"))
    tuned = of_type(artifacts, "enriched_document").join(told, "id", "left_semi").select(parent().alias("cleaned_id"))
    curated = of_type(artifacts, "curated_document").where(F.coalesce("quality_score", F.lit(0.0)) >= least).select(parent().alias("cleaned_id"))
    return tuned.unionByName(curated).where(F.col("cleaned_id").isNotNull()).distinct()


def contamination(examples: DataFrame, artifacts: DataFrame, statuses: DataFrame, overrides: DataFrame, least: float = 0.4) -> DataFrame:
    """(cleaned_id, direct, near_dup) of the documents that both sides share or may share, without those in overrides.

    statuses (cleaned_id, dedup_status). Near duplicates count only if both sides hold any, and then all of either side.
    """
    sides = eval_documents(examples, artifacts).withColumn("e", F.lit(1)).join(train_documents(examples, artifacts, least).withColumn("t", F.lit(1)), "cleaned_id", "full")
    flags = statuses.where(F.col("dedup_status") == "near_dup").select("cleaned_id").distinct().withColumn("n", F.lit(1))
    both = sides.join(flags, "cleaned_id", "left").select("cleaned_id", *[F.col(c).isNotNull().alias(c) for c in ("e", "t", "n")])
    met = both.agg((F.coalesce(F.max(F.col("e") & F.col("n")), F.lit(False)) & F.coalesce(F.max(F.col("t") & F.col("n")), F.lit(False))).alias("met"))
    rows = both.crossJoin(F.broadcast(met)).select("cleaned_id", (F.col("e") & F.col("t")).alias("direct"), (F.col("n") & F.col("met")).alias("near_dup"))
    return rows.where(F.col("direct") | F.col("near_dup")).join(overrides.select("cleaned_id"), "cleaned_id", "left_anti")


def require_clean(overlap: DataFrame) -> None:
    """Raises unless the overlap is empty; every export calls it first and writes nothing otherwise."""
    n, direct, near = overlap.agg(F.count(F.lit(1)), F.count_if("direct"), F.count_if("near_dup")).first()
    if n:
        some = ", ".join(r[0] for r in overlap.select("cleaned_id").orderBy("cleaned_id").limit(20).collect())
        raise ContaminationError(f"{n} documents are in training and evaluation ({direct} direct, {near} near duplicates): {some}")


def in_domain(rows: DataFrame, wanted: str | None) -> DataFrame:
    """Rows of the domain; rows without a domain are in none. No domain asked for: all rows."""
    return rows if wanted is None else rows.where(F.col("domain") == wanted)


def substance_kept(metadata: Column) -> Column:
    """Of a JSON object: a missing key counts as passed, false or an explicit null as failed."""
    value = F.get_json_object(metadata, "$.substance_passed")
    known = F.coalesce(F.array_contains(F.json_object_keys(metadata), "substance_passed"), F.lit(False))
    return ~known | F.coalesce(value == "true", F.lit(False))


def rag_export(artifacts: DataFrame, chunks: DataFrame, sources: DataFrame, wanted: str | None = None) -> DataFrame:
    """RAG_COLUMNS of the chunks whose gate outcome is true: a failure or a null outcome is left out; the enriched score."""
    names = sources.select(F.col("id").alias("source_id"), domain().alias("domain"))
    cleaned = first_child(artifacts, "cleaned_document", "parsed_id", "cleaned").select("parsed_id", "cleaned_id")
    about = of_type(artifacts, "enriched_document").select(F.col("id").alias("enriched_id"), F.get_json_object("metadata", "$.document_type").alias("document_type"), F.from_json(F.get_json_object("metadata", "$.keywords"), "array<string>").alias("keywords"))
    enriched = first_child(artifacts, "enriched_document", "cleaned_id", "enriched").join(about, "enriched_id")
    lineage = of_type(artifacts, "chunk").select(F.col("id").alias("chunk_id"), parent().alias("parsed_id")).join(cleaned, "parsed_id", "left").join(enriched, "cleaned_id", "left")
    rows = chunks.where("substance_passed").select("chunk_id", "source_id", "section_path", "page", "text").join(lineage, "chunk_id").join(names, "source_id", "left")
    rows = rows.select("chunk_id", F.coalesce("parsed_id", F.lit("")).alias("document_id"), F.coalesce("section_path", F.lit("")).alias("section_path"), F.coalesce("page", F.lit(1)).alias("page"), "text", "domain", "document_type", F.coalesce("keywords", F.array().cast("array<string>")).alias("keywords"), F.col("enriched_score").alias("quality_score"))
    return in_domain(rows, wanted).select(*RAG_COLUMNS)


def filter_results(documents: DataFrame, *, id: str, text: str = "text") -> DataFrame:
    """(id, results) with results MAP<filter, STRUCT<passed, reason>> of the three corpus filters, each asked on its own."""
    words = documents.select(F.col(id).alias(id), F.col(text).alias("text")).where(F.col("text").isNotNull())
    repeated = Q.gopher_repetition(words, id=id).select(id, F.col("passed").alias("p1"), F.col("reason").alias("r1"))
    rows = words.select(id, "text", Q.once(X.words(F.col("text"))).alias("words"), Q.c4_lines(F.col("text")).alias("kept"))
    rows = rows.select(id, Q.gopher_quality_code(F.col("text"), F.col("words")).alias("c2"), Q.c4_code(F.col("text"), F.col("kept")).alias("c3"))
    entry = lambda passed, reason: F.struct(passed.alias("passed"), F.when(~passed, reason).alias("reason"))
    pairs = [F.lit("gopher_repetition"), entry(F.col("p1"), F.col("r1")), F.lit("gopher_quality"), entry(F.col("c2") == "passed", F.col("c2")), F.lit("c4_quality"), entry(F.col("c3") == "passed", F.col("c3"))]
    return rows.join(repeated, id).select(id, F.create_map(*pairs).alias("results"))


def pass_ratio(results: Column) -> Column:
    """Share of filters passed, 0 without results."""
    values = F.map_values(results)
    return F.coalesce(F.try_divide(F.size(F.filter(values, lambda r: r["passed"])), F.size(values)), F.lit(0.0))


def composite(artifacts: DataFrame, ratios: DataFrame) -> DataFrame:
    """(curated_id, composite): 0.3 parse + 0.4 enrichment + 0.3 ratio of filters passed, within 0 and 1. ratios (parsed_id, ratio);
    a missing parse or enrichment score counts 0.5, a missing ratio 0."""
    curated = of_type(artifacts, "curated_document").select(F.col("id").alias("curated_id"), parent().alias("cleaned_id"))
    cleaned = of_type(artifacts, "cleaned_document").select(F.col("id").alias("cleaned_id"), parent().alias("parsed_id"))
    parsed = of_type(artifacts, "parsed_document").select(F.col("id").alias("parsed_id"), F.get_json_object("metadata", "$.parse_quality").cast("double").alias("parse"))
    rows = curated.join(cleaned, "cleaned_id", "left").join(parsed, "parsed_id", "left").join(first_child(artifacts, "enriched_document", "cleaned_id", "enriched"), "cleaned_id", "left").join(ratios, "parsed_id", "left")
    score = 0.3 * F.coalesce("parse", F.lit(0.5)) + 0.4 * F.coalesce("enriched_score", F.lit(0.5)) + 0.3 * F.coalesce("ratio", F.lit(0.0))
    return rows.select("curated_id", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 6).alias("composite"))


def recrawl(sources: DataFrame, probes: DataFrame, now: str, days: int = 30) -> DataFrame:
    """(id, status, reason, last_content_hash, last_crawled_at): what a visit at `now` does with each source.

    probes (id, signature) of the pages just fetched. A visit is skipped if a signature is stored, equals the new one and is no
    staler than max_staleness_days of the source, if there is such a column, else `days`; a skip keeps the stored hash and moves
    the time only. Sources that were never crawled are not stale.
    """
    own = F.coalesce("max_staleness_days", F.lit(days)) if "max_staleness_days" in sources.columns else F.lit(days)
    at = F.to_timestamp(F.lit(now))
    rows = sources.join(probes, "id", "left")
    stale = F.coalesce(F.col("last_crawled_at") + F.make_dt_interval(own) < at, F.lit(False))
    reason = F.when(F.col("last_content_hash").isNull(), "null_hash").when(stale, "stale").when(~F.col("last_content_hash").eqNullSafe(F.col("signature")), "changed")
    status = F.when(reason.isNull(), "skipped_unchanged").otherwise("recrawled")
    return rows.select("id", status.alias("status"), reason.alias("reason"), F.when(reason.isNull(), F.col("last_content_hash")).otherwise(F.col("signature")).alias("last_content_hash"), at.alias("last_crawled_at"))


def dedup_summary(statuses: DataFrame, artifacts: DataFrame) -> DataFrame:
    """One row total, unique, near_dup, skipped_no_curation of (cleaned_id, dedup_status): documents without a curated child are skipped."""
    curated = first_child(artifacts, "curated_document", "cleaned_id", "curated").select("cleaned_id", F.lit(True).alias("curated"))
    rows = statuses.join(curated, "cleaned_id", "left")
    has = F.col("curated").isNotNull()
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(has & (F.col("dedup_status") == "unique")).alias("unique"), F.count_if(has & (F.col("dedup_status") == "near_dup")).alias("near_dup"), F.count_if(~has).alias("skipped_no_curation"))


def expanded_prefixes(ids: DataFrame, prefixes: DataFrame, *, id: str = "id", least: int = 4, full: int = 40) -> DataFrame:
    """(prefix, status, id) of each asked prefix: `full` ids of at least `full` characters as they are, `too_short`, `none`, `ambiguous`
    or `found` with the only id that begins with it. Wildcards have no meaning. Ids are joined by their beginnings of the asked lengths."""
    asked = prefixes.select("prefix").where(F.col("prefix").isNotNull()).distinct().withColumn("len", F.char_length("prefix"))
    wanted = asked.where((F.col("len") >= least) & (F.col("len") < full))
    lengths = wanted.agg(F.sort_array(F.collect_set("len")).alias("lens"))  # at most full - least numbers
    begun = ids.select(F.col(id).alias("id")).distinct().crossJoin(F.broadcast(lengths)).select("id", F.explode("lens").alias("len")).where(F.char_length("id") >= F.col("len"))
    begun = begun.select("id", F.expr("left(id, len)").alias("prefix")).join(wanted.select("prefix"), "prefix", "left_semi")
    hits = begun.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"))
    rows = asked.join(hits, "prefix", "left")
    status = F.when(F.col("len") >= full, "full").when(F.col("len") < least, "too_short").when(F.col("n").isNull(), "none").when(F.col("n") > 1, "ambiguous").otherwise("found")
    return rows.select("prefix", status.alias("status"), F.when(F.col("len") >= full, F.col("prefix")).when(F.col("n") == 1, F.col("id")).alias("id"))
