"""Lines that recur across the documents of one source, found with compressed bitmaps of document numbers.

A line counts as recurring if it occurs in at least `least_docs` documents and at least `least_share` of the source's
documents. Per source, a line's documents are a bitmap cut into containers of 32,768 document numbers (4 kB each; only
containers that hold a document exist). Variants of a line (spelling in upper case, spaces) have bitmaps of their own,
which are united; the united bitmap's exact cardinality decides which lines go. The rows of such a line are those whose bits made the
bitmap, so they are taken by the line, without testing bit by bit.

Only lines that occur often enough to possibly pass get bitmaps: a line's rows, counted by hash with partial aggregation,
are at least as many as its documents. A source has at most 1 / least_share times its mean number of lines per document
of such lines, so bitmaps and lookups stay small however long the corpus is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut, skew_safe_lookup

#: A table of lines is broadcast up to this many rows.
MOST_LINES = 100_000
_GAP = r"[\s\p{Z}\x1c-\x1f\x85]+"


def same_line(line: Column) -> Column:
    """Trimmed, each run of Unicode white space one space, lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(line, _GAP, " "), "^ | $", ""))


def section_lines(docs: DataFrame, *, doc: str, source: str, sections: str = "sections") -> DataFrame:
    """(source_id, doc, section_no, line_no, line) of all lines, blank ones included; a null section or text has none."""
    slim = docs.select(F.col(source).cast("string").alias("source_id"), F.col(doc).cast("string").alias("doc"), F.transform(F.col(sections), lambda s: s["text"]).alias("texts"))
    slim = slim.where(F.col("source_id").isNotNull() & F.col("doc").isNotNull())
    texts = slim.select("source_id", "doc", F.posexplode("texts").alias("section_no", "text")).where(F.col("text").isNotNull())
    return texts.select("source_id", "doc", "section_no", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


def recurring_lines(lines: DataFrame, sources: DataFrame, *, least_docs: int = 3, least_share: float = 0.1) -> DataFrame:
    """The rows of lines (source_id, doc, ..., line) that recur in their source, plus the line's exact document count `docs`.

    sources holds (source_id, doc) of all documents, repeated rows allowed. Blank and null lines never recur. The result is
    distinct; rows of a null source or doc are ignored.
    """
    spark = lines.sparkSession
    numbered = cut(sources.where(F.col("source_id").isNotNull() & F.col("doc").isNotNull()).select("source_id", "doc").distinct())
    counts = numbered.groupBy("source_id").agg(F.count(F.lit(1)).alias("n_docs"))
    least = F.greatest(F.lit(least_docs).cast("double"), F.col("n_docs") * F.lit(least_share) - 1e-9)
    keyed = lines.where(F.col("line").isNotNull()).withColumn("same", same_line(F.col("line"))).where(F.col("same") != "")
    keyed = keyed.withColumn("h", F.xxhash64("same"))
    often = keyed.groupBy("source_id", "h").agg(F.count(F.lit(1)).alias("n"))
    often = cut(often.where(F.col("n") >= least_docs).join(counts, "source_id").where(F.col("n") >= least).select("source_id", "h", "n"))
    n_often = often.count()
    if not n_often:
        return lines.limit(0).withColumn("docs", F.lit(0).cast("bigint"))
    if n_often <= MOST_LINES:
        rows = keyed.join(F.broadcast(often.select("source_id", "h")), ["source_id", "h"], "left_semi")
    else:
        rows = skew_safe_lookup(keyed, often, ["source_id", "h"], "n", keyed.count())
    # Dense document numbers: checkpointed partitions are fixed, so the number is the same whenever it is read.
    numbers = cut(numbered.select("source_id", "doc", F.monotonically_increasing_id().alias("number")))
    rows = cut(rows.drop("h").join(numbers, ["source_id", "doc"]))
    container, bit = F.expr("number div 32768"), F.expr("number % 32768")
    variants = rows.groupBy("source_id", "same", F.col("line").alias("variant"), container.alias("container")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    united = variants.groupBy("source_id", "same", "container").agg(F.bitmap_or_agg("bits").alias("bits"))
    exact = united.groupBy("source_id", "same").agg(F.sum(F.bitmap_count("bits")).alias("docs"))
    heavy = cut(exact.join(counts, "source_id").where(F.col("docs") >= least).select("source_id", "same", "docs"))
    if heavy.count() <= MOST_LINES:
        found = rows.join(F.broadcast(heavy), ["source_id", "same"])
    else:
        found = skew_safe_lookup(rows, heavy.withColumn("n", F.col("docs")), ["source_id", "same"], "n", rows.count())
    return found.select(*lines.columns, "docs").distinct()


def without_recurring_lines(docs: DataFrame, *, doc: str = "parsed_id", source: str = "source_id", sections: str = "sections", least_docs: int = 3, least_share: float = 0.1) -> DataFrame:
    """(doc, section_no, text, removed) of every section, without the recurring lines; removed counts them.

    Sections whose lines are all removed come out empty. Documents delivered twice come out once.
    """
    lines = section_lines(docs, doc=doc, source=source, sections=sections)
    gone = recurring_lines(lines, docs.select(F.col(source).cast("string").alias("source_id"), F.col(doc).cast("string").alias("doc")), least_docs=least_docs, least_share=least_share)
    marks = gone.groupBy("doc", "section_no").agg(F.collect_set("line_no").alias("gone"))  # lines of one section
    texts = docs.select(F.col(doc).cast("string").alias("doc"), F.posexplode(F.transform(F.col(sections), lambda s: s["text"])).alias("section_no", "text")).where(F.col("doc").isNotNull())
    texts = texts.dropDuplicates(["doc", "section_no"]).join(marks, ["doc", "section_no"], "left")
    kept = F.filter(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda line, i: ~F.array_contains(F.coalesce("gone", F.array().cast("array<int>")), i))
    return texts.select("doc", "section_no", F.array_join(kept, "\n").alias("text"), F.coalesce(F.size("gone"), F.lit(0)).alias("removed"))
