"""Search over indexed points: filters first, then dense, sparse or hybrid ranking, and the choice between chunks and section trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from . import retrieval as V

MODES = ("dense", "sparse", "hybrid")
ROUTES = ("auto", "chunk", "tree", "two_stage")
#: Filters by equality; quality and tags have rules of their own.
EQUAL = ("domain", "document_type", "source_name", "format", "source_id")


def filtered(points: DataFrame, *, min_quality_score: float | None = None, tags: list[str] | None = None, **equal: str | None) -> DataFrame:
    """Points that meet every filter given: equality, a quality of at least so much (none is less), any of the tags."""
    if unknown := set(equal) - set(EQUAL):
        raise ValueError(f"no such filter: {sorted(unknown)}")
    for column, value in equal.items():
        if value:
            points = points.where(F.col(column) == value)
    if min_quality_score is not None:
        points = points.where(F.col("quality_score") >= min_quality_score)
    if tags:
        points = points.where(F.array_contains("tags", tags[0]) if len(tags) == 1 else F.arrays_overlap("tags", F.array(*map(F.lit, tags))))
    return points


def store_search(points: DataFrame, queries: DataFrame, *, mode: str, k: int, offset: int = 0) -> DataFrame:
    """(query_id, id, score, rank) of points (id, embedding[, text]) for queries (query_id, query, embedding).

    sparse and hybrid need the points' text and are an error without it; nothing falls back. Hybrid fuses the k + offset
    best of both rankings. The first `offset` hits are left out, ranks count on.
    """
    if mode not in MODES:
        raise ValueError(f"no such mode: {mode}")
    if mode != "dense" and "text" not in points.columns:
        raise ValueError(f"{mode} search needs points with sparse vectors")
    n = k + offset
    dense = sparse = None
    if mode != "sparse":
        dense = V.dense_topk(points.select("id", "embedding"), queries.select(F.col("query_id").alias("id"), "embedding"), k=n, id="id")
    if mode != "dense":
        sparse = V.sparse_topk(points, queries, k=n, id="id", text="text", query="query_id", query_text="query")
    hits = dense if mode == "dense" else sparse if mode == "sparse" else V.fused(dense, sparse, k=n)
    return hits.where(F.col("rank") > offset)


def search(points: DataFrame, queries: DataFrame, *, mode: str = "hybrid", k: int = 5, **filters) -> DataFrame:
    """store_search over the points that pass the filters, for queries (query_id, query) that are not blank; queries are
    embedded as the points were (see retrieval.hashed_vectors)."""
    asked = queries.select("query_id", "query").where(F.coalesce(X.strip(F.col("query")), F.lit("")) != "").dropDuplicates(["query_id"])
    vectors = V.hashed_vectors(asked, id="query_id", text="query").withColumnRenamed("id", "query_id")
    return store_search(filtered(points, **filters), asked.join(vectors, "query_id", "left"), mode=mode, k=k)


def route_of(query: Column) -> Column:
    """The category of the first pattern that calls for the section tree, else no_match."""
    return F.coalesce(X.first_match(query, [(p, n) for n, p in X.ROUTES], ""), F.lit("no_match"))


def routed_search(points: DataFrame, nodes: DataFrame, queries: DataFrame, *, route: str = "auto", mode: str = "hybrid", k: int = 5, most_docs: int = 3, **filters) -> DataFrame:
    """(query_id, via, hit, score, rank): hits are chunk ids via `chunk`, or document and section path via `tree`.

    auto asks the tree where the query's words call for it and turns to chunks where that finds nothing; an explicit route
    stands as it is, without a fallback. Filters apply to the chunk route only. nodes is (doc, section_path, title); points need
    `document`.
    """
    if route not in ROUTES:
        raise ValueError(f"no such route: {route}")
    asked = queries.select("query_id", "query").where(F.coalesce(X.strip(F.col("query")), F.lit("")) != "").dropDuplicates(["query_id"])
    empty = asked.where("false").select("query_id", F.lit("").alias("via"), F.lit("").alias("hit"), F.lit(0.0).alias("score"), F.lit(0).alias("rank"))
    found, rest = empty, asked
    if route != "chunk":
        wanted = asked if route != "auto" else asked.where(route_of(F.col("query")) != "no_match")
        hits = search(points, wanted, mode="sparse", k=20).join(points.select("id", F.col("document").alias("doc")), "id")
        tree = V.tree_search(nodes, wanted, hits.select("query_id", "doc", "score"), k=k, most_docs=most_docs)
        found = tree.select("query_id", F.lit("tree").alias("via"), F.concat_ws(" ", "doc", "section_path").alias("hit"), "score", "rank")
        rest = asked.join(found.select("query_id").distinct(), "query_id", "left_anti")
    if route in ("auto", "chunk"):
        chunk = search(points, rest, mode=mode, k=k, **filters)
        found = found.unionByName(chunk.select("query_id", F.lit("chunk").alias("via"), F.col("id").alias("hit"), "score", "rank"))
    return found
