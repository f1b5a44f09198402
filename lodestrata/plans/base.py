"""Registering queries next to the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import cut, table

Query = Callable[[SparkSession, str], DataFrame]
Reader = Callable[[str], DataFrame]

#: Rows delivered twice agree in all columns, so one per key is kept. doc_id of documents and all other keys are unique.
KEYS = {"sources": "id", "artifacts": "id", "parsed_docs": "parsed_id", "chunks": "chunk_id", "dataset_examples": "id", "eval_items": "item_id"}
#: Tables with texts, whose rows are not shuffled to find those delivered twice.
WIDE = ("parsed_docs", "chunks")
#: So many surplus rows are told to all tasks; more are left out by a join.
MOST_SURPLUS = 500_000


class Book:
    """Queries by name, each given the tables through a reader; sql is None where SQL cannot say it.

    per_row: the result has a row for each row read, with its key, and is small. It is computed on every row delivered and
    repeated rows fall together in the result, so no text is shuffled.
    """

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None, *, per_row: bool = False):
        def wrap(f: Callable[[Reader], DataFrame]):
            if per_row:
                self.queries[f.__name__] = lambda s, d: f(lambda name: table(s, d, name)).distinct()
            else:
                self.queries[f.__name__] = lambda s, d: f(lambda name: once(table(s, d, name), name))
            if sql:
                self.sql[f.__name__] = sql
            return f

        return wrap


def once(df: DataFrame, name: str) -> DataFrame:
    if name not in KEYS:
        return df
    return unrepeated(df, KEYS[name]) if name in WIDE else df.dropDuplicates([KEYS[name]])


def unrepeated(df: DataFrame, key: str) -> DataFrame:
    """The first row of each key of a table read from files. Only keys and row numbers are shuffled, and the numbers of the
    surplus rows, as a rule few, are told to all tasks; rows of a null key are one key."""
    at = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r"))
    keyed = df.select(key, at.alias("_at"))
    repeated = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")).where(F.col("_n") > 1)
    surplus = cut(keyed.join(repeated, keyed[key].eqNullSafe(repeated[key])).where(F.col("_at") != F.col("_first")).select("_at"))
    n = surplus.count()
    if not n:
        return df
    return df.withColumn("_at", at).join(F.broadcast(surplus) if n <= MOST_SURPLUS else surplus, "_at", "left_anti").drop("_at")
