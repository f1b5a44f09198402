"""Exchangeable parts by name: parsers, embedders, vector stores, discovery, crawlers, indexers, retrievers, domain validators.

A part is any object with the methods of its protocol. Parts are registered under a group and a name and chosen by name, so a
deployment can bring its own; the built-in ones work without a network.
"""

from __future__ import annotations

import re
from typing import Any, Protocol, runtime_checkable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9_-]{0,63}")


@runtime_checkable
class Parser(Protocol):
    def can_parse(self, mime: str) -> bool: ...
    def parse(self, raw: str) -> tuple: ...


@runtime_checkable
class Embedder(Protocol):
    name: str
    dim: int

    def embed(self, texts: DataFrame, *, id: str, text: str) -> DataFrame: ...


@runtime_checkable
class VectorStore(Protocol):
    def upsert(self, points: DataFrame) -> None: ...
    def search(self, queries: DataFrame, *, mode: str, k: int, offset: int = 0) -> DataFrame: ...
    def set_payload(self, updates: DataFrame) -> DataFrame: ...
    def count(self) -> int: ...
    def dim(self) -> int | None: ...


@runtime_checkable
class Discovery(Protocol):
    def search(self, queries: DataFrame, limit: int) -> DataFrame: ...


@runtime_checkable
class Crawler(Protocol):
    def fetch(self, urls: DataFrame) -> DataFrame: ...


@runtime_checkable
class Indexer(Protocol):
    def build_index(self, parsed: DataFrame) -> DataFrame: ...


@runtime_checkable
class Retriever(Protocol):
    def search(self, nodes: DataFrame, queries: DataFrame, hits: DataFrame, *, k: int, most_docs: int) -> DataFrame: ...


GROUPS: dict[str, type] = {"parser": Parser, "embedder": Embedder, "vector_store": VectorStore, "discovery": Discovery, "crawler": Crawler, "indexer": Indexer, "retriever": Retriever}
_PARTS: dict[tuple[str, str], Any] = {}


def register(group: str, name: str, part: Any) -> None:
    """Makes a part available; the name must be well formed and the part have its protocol's methods."""
    if group not in GROUPS:
        raise ValueError(f"no such group: {group}")
    if not NAME.fullmatch(name):
        raise ValueError(f"malformed name: {name!r}")
    if not isinstance(part, GROUPS[group]):
        raise TypeError(f"{name} lacks methods of a {group}")
    _PARTS[group, name] = part


def resolve(group: str, name: str) -> Any:
    if (group, name) not in _PARTS:
        raise KeyError(f"no {group} named {name}; there are {sorted(n for g, n in _PARTS if g == group)}")
    return _PARTS[group, name]


class HashedEmbedder:
    """Signed feature hashing of words."""

    name, dim = "hashed", 64

    def embed(self, texts: DataFrame, *, id: str, text: str) -> DataFrame:
        from .operators.retrieval import hashed_vectors

        return hashed_vectors(texts, id=id, text=text, dim=self.dim)


class ParquetStore:
    """Points in a versioned folder behind a pointer (sources.sinks); reads see the current version only."""

    def __init__(self, spark, root: str):
        self.spark, self.root = spark, root

    def points(self) -> DataFrame | None:
        from .sources.sinks import current

        name = current(self.spark, self.root)
        return self.spark.read.parquet(f"{self.root}/{name}") if name else None

    def upsert(self, points: DataFrame) -> None:
        from .operators.index import upserted
        from .sources.sinks import publish

        dims = points.agg(F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
        if dims[0] != dims[1] or (known := self.dim()) is not None and dims[0] is not None and known != dims[0]:
            raise ValueError(f"vectors of {dims[0]} to {dims[1]} numbers for a store of {self.dim()}")
        held = self.points()
        publish(points if held is None else upserted(held, points, key="id"), self.root, "id")

    def search(self, queries: DataFrame, *, mode: str, k: int, offset: int = 0) -> DataFrame:
        from .operators.search import store_search

        return store_search(self.points(), queries, mode=mode, k=k, offset=offset)

    def set_payload(self, updates: DataFrame) -> DataFrame:
        from .operators.index import with_payload
        from .sources.sinks import publish

        merged, found = with_payload(self.points(), updates, key="id")
        publish(merged, self.root, "id")
        return found

    def count(self) -> int:
        held = self.points()
        return held.count() if held is not None else 0

    def dim(self) -> int | None:
        held = self.points()
        row = held.select(F.size("embedding")).first() if held is not None else None
        return row[0] if row else None


class StoredPages:
    """Pages fetched before (url, status, mime, content); addresses that are not there come out with status 404."""

    def __init__(self, pages: DataFrame):
        self.pages = pages

    def fetch(self, urls: DataFrame) -> DataFrame:
        return urls.select("url").distinct().join(self.pages, "url", "left").withColumn("status", F.coalesce("status", F.lit(404)))


class StoredResults:
    """Search results collected before (query, rank, url)."""

    def __init__(self, results: DataFrame):
        self.results = results

    def search(self, queries: DataFrame, limit: int) -> DataFrame:
        return queries.select("query").distinct().join(self.results.where((F.col("rank") <= limit) & (F.coalesce("url", F.lit("")) != "")), "query")


class TreeIndexer:
    def build_index(self, parsed: DataFrame) -> DataFrame:
        from .operators.registry import tree_nodes

        return tree_nodes(parsed)


class TreeRetriever:
    def search(self, nodes: DataFrame, queries: DataFrame, hits: DataFrame, *, k: int, most_docs: int) -> DataFrame:
        from .operators.retrieval import tree_search

        return tree_search(nodes, queries, hits, k=k, most_docs=most_docs)


register("embedder", "hashed", HashedEmbedder())
register("indexer", "tree", TreeIndexer())
register("retriever", "tree", TreeRetriever())
