"""Queries over the test tables for the operators of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import cut, table
from .boilerplate import furniture_lines, main_body
from .leakage import leaked_items
from .mixing import mixed_documents, mixture_plan
from .packing import CAPACITY, containers_needed, packed
from .pairs import defective_pairs
from .quality import STATISTICS, not_prose, outlier_scores, section_statistics
from .repeated_lines import recurring_lines, section_lines, without_recurring_lines
from .sentences import sentences
from .splitting import split_sections

Query = Callable[[SparkSession, str], DataFrame]


def _leaks(s: SparkSession, d: str) -> DataFrame:
    return leaked_items(table(s, d, "parsed_docs"), table(s, d, "eval_items"), doc="parsed_id", text="text")


def p1_found(s: SparkSession, d: str) -> DataFrame:
    return _leaks(s, d).select("item_id", F.col("doc").alias("parsed_id")).distinct()


def p1_leaked_fields(s: SparkSession, d: str) -> DataFrame:
    return _leaks(s, d).groupBy(F.col("doc").alias("parsed_id")).agg(F.countDistinct("item_id").alias("items"), F.count_if(F.col("field") == "question").alias("questions"), F.count_if(F.col("field") == "answer").alias("answers"))


def p2_found(s: SparkSession, d: str) -> DataFrame:
    return not_prose(table(s, d, "parsed_docs")).select(F.col("doc").alias("parsed_id"), "section_no", "kind")


def p2_statistics(s: SparkSession, d: str) -> DataFrame:
    scored = outlier_scores(section_statistics(table(s, d, "parsed_docs")))
    return scored.select(F.col("doc").alias("parsed_id"), "section_no", "lang", *STATISTICS, *[f"{x}_rank" for x in STATISTICS], "score")


def p4_found(s: SparkSession, d: str) -> DataFrame:
    return defective_pairs(table(s, d, "dataset_examples")).where(F.col("rank") == 0).select("id", "defect")


def p4_defect_types(s: SparkSession, d: str) -> DataFrame:
    return defective_pairs(table(s, d, "dataset_examples")).select("id", "defect", "rank")


def p5_found(s: SparkSession, d: str) -> DataFrame:
    return furniture_lines(table(s, d, "parsed_docs")).select(F.col("page").alias("parsed_id"), "line_no")


def p5_main_body(s: SparkSession, d: str) -> DataFrame:
    return main_body(table(s, d, "parsed_docs")).select(F.col("page").alias("parsed_id"), "body", "removed")


def _recurring(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "parsed_docs")
    return recurring_lines(section_lines(docs, doc="parsed_id", source="source_id"), docs.select("source_id", F.col("parsed_id").alias("doc")))


def p6_found(s: SparkSession, d: str) -> DataFrame:
    return _recurring(s, d).select(F.col("doc").alias("parsed_id"), "section_no", "line_no")


def p6_lines(s: SparkSession, d: str) -> DataFrame:
    return _recurring(s, d).groupBy("source_id", "line").agg(F.max("docs").alias("docs"), F.count(F.lit(1)).alias("places"))


def p6_clean_sections(s: SparkSession, d: str) -> DataFrame:
    return without_recurring_lines(table(s, d, "parsed_docs")).withColumnRenamed("doc", "parsed_id")


def p7_found(s: SparkSession, d: str) -> DataFrame:
    pieces = split_sections(table(s, d, "parsed_docs"), deduplicate=False)
    return pieces.where(F.col("n_pieces") > 1).select(F.col("doc").alias("parsed_id"), "section_no").distinct()


def p7_pieces(s: SparkSession, d: str) -> DataFrame:
    return split_sections(table(s, d, "parsed_docs")).withColumnRenamed("doc", "parsed_id")


def _sized(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", F.octet_length("text").alias("size"))


def _packed(s: SparkSession, d: str) -> DataFrame:
    return packed(_sized(s, d), item="doc_id", size="size")


def p8_found(s: SparkSession, d: str) -> DataFrame:
    # Pieces that hold something: a document of several is one that is cut.
    cut = _packed(s, d).where(F.col("length") > 0).groupBy(F.col("item").alias("doc_id")).agg(F.count(F.lit(1)).alias("pieces"))
    return cut.where(F.col("pieces") > 1).select("doc_id")


def p8_assignment(s: SparkSession, d: str) -> DataFrame:
    return _packed(s, d).withColumnRenamed("item", "doc_id")


def p8_documents(s: SparkSession, d: str) -> DataFrame:
    """Of each document the pieces and bytes that the assignment holds, and whether they follow each other without a gap."""
    pieces = _packed(s, d).groupBy(F.col("item").alias("doc_id"))
    follow = F.sum("length") == F.max(F.col("start") + F.col("length"))
    return pieces.agg(F.count_if(F.col("length") > 0).alias("pieces"), F.sum("length").alias("bytes"), follow.alias("whole"))


def p8_containers(s: SparkSession, d: str) -> DataFrame:
    """What the containers hold in all, and whether none is over the capacity."""
    filled = _packed(s, d).where(F.col("length") > 0).groupBy("container").agg(F.sum("length").alias("filled"))
    return filled.agg(F.sum("filled").alias("bytes"), (F.max("filled") <= CAPACITY).alias("all_fit"), (F.count(F.lit(1)) * CAPACITY <= F.sum("filled") * 1.05 + CAPACITY).alias("within_5_percent"))


def p8_unused_space(s: SparkSession, d: str) -> DataFrame:
    filled = _packed(s, d).where(F.col("length") > 0).groupBy("container").agg(F.sum("length").alias("filled"))
    _, dual, volume = containers_needed(_sized(s, d), item="doc_id", size="size")
    bounds = [F.lit(round(dual, 3)).alias("dual_bound"), F.lit(round(volume, 3)).alias("size_bound")]
    return filled.agg(F.count(F.lit(1)).alias("containers"), F.sum("filled").alias("tokens"), F.max("filled").alias("fullest"), F.round(1 - F.sum("filled") / (F.count(F.lit(1)) * CAPACITY), 6).alias("unused")).select("*", *bounds)


def _plan(s: SparkSession, d: str) -> DataFrame:
    return mixture_plan(table(s, d, "documents"), table(s, d, "mix_targets"))


def p9_found(s: SparkSession, d: str) -> DataFrame:
    return _plan(s, d).where("falls_short").select("source")


def p9_plan(s: SparkSession, d: str) -> DataFrame:
    columns = [F.round(c, 6).alias(c) for c in ("exponent", "tempered_share", "repeats", "actual_share")]
    return _plan(s, d).select("source", "target_share", "max_repeats", "docs", "held", "budget", *columns, "falls_short")


def _mixed(s: SparkSession, d: str) -> DataFrame:
    return mixed_documents(table(s, d, "documents"), cut(_plan(s, d)))


def p9_documents(s: SparkSession, d: str) -> DataFrame:
    return _mixed(s, d).withColumnRenamed("id", "doc_id")


def p9_actual_shares(s: SparkSession, d: str) -> DataFrame:
    """What the chosen copies add up to."""
    taken = _mixed(s, d).groupBy("source").agg(F.count(F.lit(1)).alias("copies"), F.sum("size").alias("taken"))
    return taken.crossJoin(F.broadcast(taken.agg(F.sum("taken").alias("whole")))).select("source", "copies", "taken", F.round(F.col("taken") / F.col("whole"), 6).alias("actual_share"))


def p10_found(s: SparkSession, d: str) -> DataFrame:
    return sentences(table(s, d, "documents"))


def p10_sentences(s: SparkSession, d: str) -> DataFrame:
    return sentences(table(s, d, "documents"), with_text=True)


def queries() -> dict[str, Query]:
    found = [p1_found, p1_leaked_fields, p2_found, p2_statistics, p4_found, p4_defect_types, p5_found, p5_main_body, p6_found, p6_lines, p6_clean_sections, p7_found, p7_pieces, p8_found, p8_assignment, p8_documents, p8_containers, p8_unused_space, p9_found, p9_plan, p9_documents, p9_actual_shares, p10_found, p10_sentences]
    return {f.__name__: f for f in found}


_WORDS = "regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}]+')"
_LINE = r"regexp_replace(regexp_replace(lower({0}), '[\s\p{{Z}}\x{{1c}}-\x{{1f}}\x{{85}}]+', ' ', 'g'), '^ | $', '', 'g')"

_RECURRING = rf"""
    WITH docs AS (SELECT DISTINCT parsed_id, source_id, sections FROM parsed_docs WHERE parsed_id IS NOT NULL AND source_id IS NOT NULL),
    n AS (SELECT source_id, count(DISTINCT parsed_id) AS n_docs FROM docs GROUP BY source_id),
    sec AS (SELECT parsed_id, source_id, CAST(unnest(range(len(sections))) AS INT) AS section_no, unnest(sections) AS sec FROM docs),
    ln AS (SELECT parsed_id, source_id, section_no, unnest(string_split(sec.text, chr(10))) AS line, CAST(unnest(range(len(string_split(sec.text, chr(10))))) AS INT) AS line_no FROM sec WHERE sec.text IS NOT NULL),
    nl AS (SELECT *, {_LINE.format('line')} AS same FROM ln),
    hv AS (SELECT source_id, same, count(DISTINCT parsed_id) AS docs FROM nl WHERE same <> '' GROUP BY source_id, same),
    hit AS (SELECT nl.*, hv.docs FROM nl JOIN hv USING (source_id, same) JOIN n USING (source_id) WHERE hv.docs >= 3 AND hv.docs >= 0.1 * n.n_docs)
"""


# The mix where no source that can meet its target comes to its limit by filling up for the others: the exponent is 1.
_MIX = """WITH t AS (SELECT source, max(target_share) AS target_share, max(max_repeats) AS max_repeats FROM mix_targets GROUP BY source),
    h AS (SELECT source, count(*) AS docs, CAST(sum(strlen(text)) AS BIGINT) AS held FROM documents GROUP BY source), w AS (SELECT CAST(sum(strlen(text)) AS DOUBLE) AS total FROM documents),
    p AS (SELECT t.*, coalesce(docs, 0) AS docs, coalesce(held, 0) AS held, total, coalesce(held, 0) * max_repeats < target_share * total OR coalesce(held, 0) = 0 AS pinned, coalesce(held, 0) * max_repeats < target_share * total AS short FROM t LEFT JOIN h ON h.source = t.source, w),
    r AS (SELECT sum(held * max_repeats) FILTER (pinned) AS given, sum(target_share) FILTER (NOT pinned) AS free FROM p),
    plan AS (SELECT p.*, CASE WHEN pinned THEN 0.0 ELSE target_share / free END AS tempered, CAST(CASE WHEN pinned THEN held * max_repeats ELSE floor(target_share / free * (total - coalesce(given, 0))) END AS BIGINT) AS budget FROM p, r)
    """
_TAKEN = """, d AS (SELECT DISTINCT doc_id, source, strlen(text) AS size FROM documents WHERE strlen(text) > 0),
    c AS (SELECT d.*, held, budget, CAST(unnest(range(CAST(ceil(budget / held) AS BIGINT))) AS INT) AS pass_no FROM d JOIN plan USING (source) WHERE budget > 0),
    u AS (SELECT *, pass_no * held + sum(size) OVER (PARTITION BY source, pass_no ORDER BY md5('order|0|' || pass_no || '|' || doc_id), doc_id) - size AS before FROM c),
    placed AS (SELECT doc_id, source, size, pass_no, CAST(floor(before / budget * greatest(1, ceil((SELECT sum(budget) FROM plan) / 1048576.0))) AS BIGINT) AS block_no, md5('block|0|' || pass_no || '|' || doc_id) AS h FROM u WHERE before < budget)
    """


def oracle_sql() -> dict[str, str]:
    return {
        "p6_found": _RECURRING + "SELECT DISTINCT parsed_id, section_no, line_no FROM hit",
        "p6_lines": _RECURRING + "SELECT source_id, line, max(docs) AS docs, count(*) AS places FROM (SELECT DISTINCT source_id, parsed_id, section_no, line_no, line, docs FROM hit) GROUP BY source_id, line",
        "p7_found": """SELECT DISTINCT parsed_id, section_no FROM (SELECT parsed_id, CAST(unnest(range(len(sections))) AS INT) AS section_no, unnest(sections) AS sec FROM parsed_docs)
            WHERE length(sec.text) > 1500 AND sec.is_table IS NOT TRUE""",
        "p8_found": "SELECT DISTINCT doc_id FROM documents WHERE strlen(text) > 8192",
        "p8_documents": "SELECT doc_id, greatest(ceil(strlen(coalesce(text, '')) / 8192.0), 0)::BIGINT AS pieces, strlen(coalesce(text, '')) AS bytes, true AS whole FROM (SELECT DISTINCT doc_id, text FROM documents)",
        "p8_containers": "SELECT CAST(sum(strlen(text)) AS BIGINT) AS bytes, true AS all_fit, true AS within_5_percent FROM (SELECT DISTINCT doc_id, text FROM documents)",
        "p9_found": """SELECT t.source FROM (SELECT source, max(target_share) AS target_share, max(max_repeats) AS max_repeats FROM mix_targets GROUP BY source) t
            LEFT JOIN (SELECT source, sum(strlen(text)) AS held FROM documents GROUP BY source) d ON d.source = t.source
            WHERE coalesce(held, 0) * max_repeats < target_share * (SELECT sum(strlen(text)) FROM documents)""",
        "p9_plan": _MIX + """SELECT source, target_share, max_repeats, docs, held, budget, 1.0 AS exponent, round(tempered, 6) AS tempered_share, CASE WHEN held > 0 THEN round(budget / held, 6) ELSE 0.0 END AS repeats,
            round(budget / (SELECT sum(budget) FROM plan), 6) AS actual_share, short AS falls_short FROM plan""",
        "p9_documents": _MIX + _TAKEN + "SELECT doc_id, source, size, pass_no, block_no, row_number() OVER (ORDER BY block_no, h, source, doc_id) AS position FROM placed",
        "p9_actual_shares": _MIX + _TAKEN + "SELECT source, count(*) AS copies, CAST(sum(size) AS BIGINT) AS taken, round(sum(size) / (SELECT sum(size) FROM placed), 6) AS actual_share FROM placed GROUP BY source",
    }
