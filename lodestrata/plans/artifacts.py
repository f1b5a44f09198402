"""Queries of the hierarchy operator over the artifacts table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.hierarchy import descendants, hierarchy
from ..runtime import table


def p3_found(s: SparkSession, d: str) -> DataFrame:
    return hierarchy(table(s, d, "artifacts"))


def p3_paths(s: SparkSession, d: str) -> DataFrame:
    nodes = hierarchy(table(s, d, "artifacts"), with_path=True)
    return nodes.select("id", "root_id", "node_depth", F.array_join("path", " > ").alias("node_path"))


def p3_descendants(s: SparkSession, d: str) -> DataFrame:
    return descendants(table(s, d, "artifacts"))


_KEY = r"regexp_replace(lower({0}), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
# Climbs 400 links: longer than any chain of the test tables, so who gets there is on or below a loop, and from step 200 on it.
_UP = f"""WITH RECURSIVE n AS (SELECT {_KEY.format('id')} AS k, min(id) AS id, max(nullif({_KEY.format('parent_artifact_id')}, '')) AS p FROM artifacts WHERE id IS NOT NULL GROUP BY 1),
    nodes AS (SELECT k, id, CASE WHEN p IN (SELECT k FROM n) THEN p END AS p FROM n),
    up AS (SELECT id AS leaf, k AS leaf_k, k, id, p, 0 AS steps FROM nodes UNION ALL SELECT leaf, leaf_k, nodes.k, nodes.id, nodes.p, steps + 1 FROM up JOIN nodes ON nodes.k = up.p WHERE steps < 400),
    looped AS (SELECT leaf FROM up WHERE steps = 400)"""


def oracle_sql():
    return {
        "p3_found": _UP + """ SELECT leaf AS id, id AS root_id, CAST(steps AS INT) AS node_depth FROM up WHERE p IS NULL
            UNION ALL SELECT leaf, min(id) FILTER (steps >= 200), CASE WHEN bool_or(steps > 0 AND k = leaf_k) THEN -1 ELSE -2 END FROM up WHERE leaf IN (FROM looped) GROUP BY leaf""",
        "p3_descendants": _UP + " SELECT id AS ancestor_id, leaf AS descendant_id, CAST(steps AS INT) AS distance FROM up WHERE steps > 0 AND leaf NOT IN (FROM looped)",
        "p3_paths": _UP + """ SELECT leaf AS id, max_by(id, steps) AS root_id, CAST(max(steps) AS INT) AS node_depth, string_agg(id, ' > ' ORDER BY steps DESC) AS node_path FROM up WHERE leaf NOT IN (FROM looped) GROUP BY leaf
            UNION ALL SELECT leaf, min(id) FILTER (steps >= 200), CASE WHEN bool_or(steps > 0 AND k = leaf_k) THEN -1 ELSE -2 END, NULL FROM up WHERE leaf IN (FROM looped) GROUP BY leaf""",
    }


def queries():
    return {f.__name__: f for f in (p3_found, p3_paths, p3_descendants)}
