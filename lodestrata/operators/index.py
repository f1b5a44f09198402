"""The table of indexed points: payloads, upserts, refreshes, repairs and parity between versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .registry import chunk_chain, contributors, domain, first_writer, of_type

# The fields of a point, those that cite its place first.
CITATION = ["document", "section_path", "page", "chunk_id", "qdrant_id", "text"]
DERIVED = ["domain", "document_type", "keywords", "quality_score", "source_id", "source_name", "source_url", "format", "tags", "title", "organization"]
NAMESPACE = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"


def document_fields(artifacts: DataFrame, sources: DataFrame) -> DataFrame:
    """DERIVED of each parsed document (document): its source, and what enrichment and curation say; a curated score wins."""
    tail = chunk_chain(artifacts).select("parsed_id", "enriched_id", F.coalesce("curated_score", "enriched_score").alias("quality_score")).where(F.col("parsed_id").isNotNull()).distinct()
    get = lambda k: F.get_json_object("metadata", f"$.{k}")
    about = of_type(artifacts, "enriched_document").select(F.col("id").alias("enriched_id"), get("document_type").alias("document_type"), F.from_json(get("keywords"), "array<string>").alias("keywords"), get("title").alias("title"))
    named = sources.select(F.col("id").alias("source_id"), domain().alias("domain"), F.col("name").alias("source_name"), F.col("url").alias("source_url"), F.col("source_type").alias("format"), F.col("config.tags").alias("tags"), F.col("config.organization").alias("organization"))
    rows = of_type(artifacts, "parsed_document").select(F.col("id").alias("parsed_id"), "source_id").join(tail, "parsed_id", "left").join(about, "enriched_id", "left").join(named, "source_id", "left")
    none = F.array().cast("array<string>")
    rows = rows.withColumn("keywords", F.coalesce("keywords", none)).withColumn("tags", F.coalesce("tags", none))
    return rows.select(F.col("parsed_id").alias("document"), *DERIVED)


def payloads(artifacts: DataFrame, chunks: DataFrame, sources: DataFrame) -> DataFrame:
    """CITATION and DERIVED of every chunk; the point id is the chunk's id without its prefix."""
    rows = chunks.select("chunk_id", F.col("parsed_id").alias("document"), F.coalesce("section_path", F.lit("")).alias("section_path"), F.coalesce("page", F.lit(1)).alias("page"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("qdrant_id", F.regexp_replace("chunk_id", "^[^_]*_", ""))
    return rows.join(document_fields(artifacts, sources), "document", "left").select(*CITATION, *DERIVED)


def points(ledger: DataFrame, *, most: int = 50) -> DataFrame:
    """(point_id, primary_id, contributors, contributor_count): one point per text of the ledger (chunk_id, ord, text_hash), named by the
    version-5 UUID of the hash; the first chunk is primary, at most `most` contributors are listed, all are counted."""
    first = first_writer(ledger).where("is_new").select("text_hash", F.col("chunk_id").alias("primary_id"))
    counted = ledger.groupBy("text_hash").agg(F.count(F.lit(1)).alias("contributor_count"))
    listed = contributors(ledger, most=most, primary=first)
    return first.join(counted, "text_hash").join(listed, "text_hash").select(X.point_id(F.col("text_hash"), NAMESPACE).alias("point_id"), "primary_id", "contributors", "contributor_count")


def refreshed(stored: DataFrame, fields: DataFrame) -> DataFrame:
    """Points with DERIVED taken anew from document_fields; what cites stays, and so do points without a document."""
    fresh = fields.select("document", *[F.col(c).alias(f"_{c}") for c in DERIVED])
    rows = stored.join(fresh, "document", "left")
    return rows.select(*CITATION, *[F.when(F.col("document").isNull(), F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in DERIVED])


def upserted(stored: DataFrame, new: DataFrame, *, key: str) -> DataFrame:
    """Stored points, those of the same key replaced by new ones."""
    return stored.join(new.select(key), key, "left_anti").unionByName(new)


def with_payload(stored: DataFrame, updates: DataFrame, *, key: str) -> tuple[DataFrame, DataFrame]:
    """(points with the updates' columns merged in, (key, found) of every update): an update of no point changes nothing."""
    fresh = [c for c in updates.columns if c != key]
    rows = stored.join(updates.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in fresh]), key, "left")
    merged = rows.select(*[F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in fresh else F.col(c) for c in stored.columns])
    return merged, updates.select(key).join(stored.select(key, F.lit(True).alias("found")), key, "left").na.fill(False, ["found"])


def vanished(stored: DataFrame, ledger_points: DataFrame) -> DataFrame:
    """Ledger points that the store lacks: to be embedded again from their primary chunk."""
    return ledger_points.join(stored.select("point_id"), "point_id", "left_anti")


def must_match(hits: DataFrame, ledger: DataFrame, *, key: str) -> DataFrame:
    """Hits with the ledger's columns; a hit that the ledger doesn't know is an error."""
    rows = hits.join(ledger.withColumn("_known", F.lit(True)), key, "left")
    checked = F.when(F.col("_known"), F.col(key)).otherwise(F.raise_error(F.concat(F.lit("not in the ledger: "), F.col(key).cast("string"))))
    return rows.withColumn(key, checked).drop("_known")


def parity(stored: DataFrame, copied: DataFrame, skipped: DataFrame, *, key: str = "point_id") -> DataFrame:
    """One row stored, copied, skipped, parity: the new version may replace the old one if it lacks the skipped points only."""
    ids = lambda df, name: df.select(key).distinct().withColumn(name, F.lit(1))
    rows = ids(stored, "s").join(ids(copied, "c"), key, "full").join(ids(skipped, "k"), key, "full")
    n = lambda c: F.count(c)
    bad = F.count_if(F.col("s").isNull() | (F.col("c").isNull() == F.col("k").isNull()))
    return rows.agg(n("s").alias("stored"), n("c").alias("copied"), n("k").alias("skipped"), (bad == 0).alias("parity"))
