"""Session helpers shared by all operators: tables, checkpoints, skew-safe lookups, dense ranks."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A key counts as hot from this share of all rows; at most HOT_PARTS keys can be hot.
HOT_PARTS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the folder named in spark.checkpoint.dir; a local session without one gets a temporary folder."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="lodestrata-checkpoint-")
    sc.setCheckpointDir(named)


def cut(df: DataFrame) -> DataFrame:
    """Materialises df in the shared checkpoint folder and cuts its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def skew_safe_lookup(rows: DataFrame, lookup: DataFrame, keys: list[str], count: str, total: int, how: str = "inner") -> DataFrame:
    """Joins rows with lookup, whose keys are unique and whose column `count` tells how many rows have the key.

    Keys with at least total / HOT_PARTS rows number HOT_PARTS at most, so that part of lookup is broadcast and rows
    of a hot key stay where they are; all other keys are joined by shuffling, with no partition dominated by a key.
    Rows with a null in a key match nothing. lookup is read twice: pass a materialised one.
    """
    least = max(2.0, total / HOT_PARTS)
    payload = [c for c in lookup.columns if c not in keys and c != count]
    hot = lookup.where(F.col(count) >= least).select(*keys, *payload, F.lit(True).alias("_hot"))
    cold = lookup.where(F.col(count) < least).select(*keys, *payload)
    first = rows.join(F.broadcast(hot), keys, "left")
    shuffled = first.where(F.col("_hot").isNull()).select(*rows.columns)
    if how == "left_semi":
        return first.where(F.col("_hot").isNotNull()).select(*rows.columns).unionByName(shuffled.join(cold, keys, "left_semi"))
    found = first.where(F.col("_hot").isNotNull()).select(*rows.columns, *payload)
    return found.unionByName(shuffled.join(cold, keys, how).select(*rows.columns, *payload))


#: running_totals broadcasts one row for each pair of sorted partition and group; more than this is joined by shuffling.
MOST_OFFSETS = 500_000


def running_totals(df: DataFrame, group: list[str], order: list[str], amount: str, out: str) -> DataFrame:
    """Adds the running total of `amount` within `group` in `order`, up to and including the row.

    Range-partitioned sort with partition offsets: a group larger than a partition spans several, and no task sees
    more than its own partition. Each sorted partition adds up its own rows; the totals of each pair of partition
    and group (a partition shares a group only with its neighbours, so there are at most partitions + groups pairs)
    become offsets. Make `order` unique within a group: rows that agree in it are placed arbitrarily.
    """
    parts = shuffle_width(df.sparkSession)
    ordered = cut(df.repartitionByRange(parts, *group, *order).withColumn("_part", F.spark_partition_id()))
    keys = ["_part", *group]
    inner = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut(ordered.groupBy(*keys).agg(F.sum(amount).alias("_total")))
    offsets = totals.select(*keys, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    if totals.count() <= MOST_OFFSETS:
        offsets = F.broadcast(offsets)
    summed = ordered.withColumn("_inner", F.sum(amount).over(inner))
    same = [summed[k].eqNullSafe(offsets[k]) for k in keys]
    joined = summed.join(offsets, same).select(*[summed[c] for c in df.columns], (F.col("_inner") + F.col("_before")).alias(out))
    return joined


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)
