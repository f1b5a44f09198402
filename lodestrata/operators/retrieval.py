"""Dense, sparse and hybrid top-k retrieval, and two-stage tree search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import cut

#: Query vectors that are searched at once.
QUERIES = 1024
WORD = r"([\p{L}\p{N}]+)"


def dense_topk(points: DataFrame, queries: DataFrame, *, k: int, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, id, score, rank): the k points of highest cosine to each query, ties by id; a query is no hit of its own.

    Queries are taken in as many hash blocks as QUERIES vectors each need; each task keeps k candidates per query and batch, so what
    is shuffled is at most k rows per query and batch. Null vectors and vectors of another length than the query's give no
    hits, nor do vectors of zeros.
    """
    spark, kind = points.sparkSession, dict(points.dtypes)[id]
    asked = queries.select(F.col(id).alias("id"), F.col(vector).alias("v")).where(F.col("v").isNotNull()).dropDuplicates(["id"])
    slim = points.select(F.col(id).alias("id"), F.col(vector).alias("v")).where(F.col("v").isNotNull())
    found = None
    blocks = max(1, -(-asked.count() // QUERIES))
    for n in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == n).collect()  # QUERIES rows, about
        matrix = np.array([r[1] for r in rows], np.float64) if rows else np.zeros((0, 1))
        matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)
        held = spark.sparkContext.broadcast((np.array([r[0] for r in rows]), matrix))

        def search(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            names, m = held.value
            for batch in batches:
                batch = batch[batch["v"].map(len) == m.shape[1]]
                if not len(batch) or not len(names):
                    continue
                x = np.vstack(batch["v"].to_numpy()).astype(np.float64)
                x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
                own = batch["id"].to_numpy()
                place = np.argsort(np.argsort(own, kind="stable"), kind="stable")
                scores = np.round(m @ x.T, 6)
                scores[names[:, None] == own[None, :]] = -np.inf
                scores[:, ~x.any(axis=1)] = -np.inf
                order = np.lexsort((np.broadcast_to(place, scores.shape), -scores), axis=1)[:, :k]
                q, p = np.repeat(names, order.shape[1]), order.ravel()
                s = np.take_along_axis(scores, order, 1).ravel()
                keep = np.isfinite(s)
                yield pd.DataFrame({"query_id": q[keep], "id": own[p][keep], "score": s[keep]})

        part = slim.mapInPandas(search, f"query_id {dict(queries.dtypes)[id]}, id {kind}, score double")
        found = part if found is None else found.unionByName(part)
    return top(found, k)


def top(scored: DataFrame, k: int) -> DataFrame:
    """The k best (query_id, id, score) per query with their rank. Spark limits the rank in the tasks before it shuffles."""
    window = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return scored.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def terms(rows: DataFrame, id: str, text: str) -> DataFrame:
    return rows.select(F.col(id).alias("id"), F.explode(F.regexp_extract_all(F.lower(text), F.lit(WORD), 1)).alias("term"))


def sparse_topk(texts: DataFrame, queries: DataFrame, *, k: int, id: str, text: str, query: str, query_text: str, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(query_id, id, score, rank) by BM25 over word terms. Statistics count all texts; a term carries its text's length, and only
    query terms are shuffled. Each text is one row."""
    asked = terms(queries, query, query_text).distinct().withColumnRenamed("id", "query_id")
    split = texts.select(F.col(id).alias("id"), F.regexp_extract_all(F.lower(text), F.lit(WORD), 1).alias("ws"))
    stats = split.where(F.size("ws") > 0).agg(F.count(F.lit(1)).alias("total"), F.avg(F.size("ws")).alias("mean"))
    rows = split.select("id", F.size("ws").alias("n"), F.explode("ws").alias("term"))
    tf = cut(rows.join(asked.select("term").distinct(), "term", "left_semi").groupBy("id", "n", "term").agg(F.count(F.lit(1)).alias("tf")))
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.log(1 + (F.col("total") - F.col("df") + 0.5) / (F.col("df") + 0.5)) * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("n") / F.col("mean")))
    weighed = tf.join(df, "term").crossJoin(F.broadcast(stats)).select("id", "term", weight.alias("w"))
    scored = weighed.join(asked, "term").groupBy("query_id", "id").agg(F.round(F.sum("w"), 6).alias("score"))
    return top(scored, k)


def fused(dense: DataFrame, sparse: DataFrame, *, k: int, constant: int = 60) -> DataFrame:
    """Reciprocal rank fusion of two ranked lists: a missing hit adds nothing."""
    both = dense.select("query_id", "id", F.col("rank").alias("a")).join(sparse.select("query_id", "id", F.col("rank").alias("b")), ["query_id", "id"], "full")
    part = lambda c: F.coalesce(1 / (constant + F.col(c)), F.lit(0.0))
    return top(both.select("query_id", "id", F.round(part("a") + part("b"), 6).alias("score")), k)


def hashed_vectors(texts: DataFrame, *, id: str, text: str, dim: int = 64) -> DataFrame:
    """(id, embedding): word counts hashed with a sign into `dim` numbers; a stand-in where no model is at hand."""
    h = F.conv(F.substring(F.md5("term"), 1, 8), 16, 10).cast("bigint")
    counts = terms(texts, id, text).withColumn("h", h).groupBy("id", (F.col("h") % dim).alias("at")).agg(F.sum(F.when((F.col("h") / dim).cast("bigint") % 2 == 0, 1.0).otherwise(-1.0)).alias("x"))
    filled = counts.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("at", "x"))).alias("m"))
    vector = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.coalesce(F.element_at("m", i.cast("bigint")), F.lit(0.0)))
    return filled.select("id", vector.alias("embedding"))


def tree_search(nodes: DataFrame, queries: DataFrame, hits: DataFrame, *, k: int, most_docs: int) -> DataFrame:
    """(query_id, doc, section_path, score, rank): of each query's best documents the nodes that share most words with it.

    hits is (query_id, doc, score) of chunks; a document counts with its best chunk. nodes is (doc, section_path, title).
    A node's score is the share of query words in its title; nodes without any are left out.
    """
    docs = hits.groupBy("query_id", "doc").agg(F.max("score").alias("s"))
    window = Window.partitionBy("query_id").orderBy(F.desc("s"), "doc")
    chosen = docs.withColumn("r", F.row_number().over(window)).where(F.col("r") <= most_docs).select("query_id", "doc")
    bag = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(WORD), 1))
    asked = queries.select("query_id", bag("query").alias("q")).where(F.size("q") > 0)
    rows = chosen.join(asked, "query_id").join(nodes.select("doc", "section_path", bag(F.coalesce("title", F.lit(""))).alias("t")), "doc")
    scored = rows.select("query_id", "doc", "section_path", F.round(F.size(F.array_intersect("q", "t")) / F.size("q"), 6).alias("score")).where(F.col("score") > 0)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc", "section_path")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
