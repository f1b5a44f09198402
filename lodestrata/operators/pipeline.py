"""Raw documents to indexed points in one plan: parse, clean, chunk, gate, deduplicate, embed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..runtime import cut
from ..sources.parsers import parse_documents
from . import chunking, index, registry, retrieval


def run(raw: DataFrame, *, id: str, content: str, mime: str, clean: bool = True, deduplicate: bool = True) -> tuple[DataFrame, DataFrame]:
    """(points, failed): points (point_id, id, ord, text, embedding, contributor_count), failed (id, error) of the documents that no parser could
    read or that challenge the reader.

    With clean boilerplate lines leave the sections and empty ones are dropped; with deduplicate a text is one point, named by
    its hash, else every chunk is one. Documents of equal texts share one parse: the smallest id stands for all of them.
    """
    parsed = cut(parse_documents(raw, id=id, content=content, mime=mime))
    challenge = X.first_match(F.coalesce("text", F.lit("")), X.CHALLENGES)
    judged = parsed.withColumn("error", F.coalesce("error", F.when(challenge.isNotNull(), F.concat(F.lit("challenge: "), challenge))))
    failed = judged.where(F.col("error").isNotNull()).select(id, "error").distinct()
    good = judged.where(F.col("error").isNull())
    one = good.groupBy(X.text_hash(F.col("text")).alias("h")).agg(F.min(id).alias(id)).select(id)
    good = good.join(one, id, "left_semi").dropDuplicates([id])
    if clean:
        tidy = F.transform("sections", lambda s: s.withField("text", X.remove_boilerplate(F.coalesce(s["text"], F.lit("")))))
        good = good.withColumn("sections", F.filter(tidy, lambda s: s["text"] != ""))
    chunks = cut(chunking.chunk_sections(good, doc=id).select(F.concat_ws("#", F.col("doc").cast("string"), "section_no", "part").alias("chunk_id"), F.col("doc").cast("string").alias("source_id"), F.struct("section_no", "part").alias("ord"), "text"))
    ledger = registry.hashed(chunks)
    if deduplicate:
        named = index.points(ledger).select("point_id", F.col("primary_id").alias("chunk_id"), "contributor_count")
    else:
        named = ledger.select(X.point_id(F.col("chunk_id"), index.NAMESPACE).alias("point_id"), "chunk_id", F.lit(1).cast("bigint").alias("contributor_count"))
    vectors = retrieval.hashed_vectors(chunks, id="chunk_id", text="text").withColumnRenamed("id", "chunk_id")
    points = named.join(chunks, "chunk_id").join(vectors, "chunk_id", "left")
    return points.select("point_id", F.col("source_id").alias(id), "ord", "text", "embedding", "contributor_count"), failed
