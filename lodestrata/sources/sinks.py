"""Export files and versioned tables behind a pointer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(rows: DataFrame, path: str) -> int:
    rows.write.mode("errorifexists").parquet(path)
    return rows.sparkSession.read.parquet(path).count()


def write_messages(rows: DataFrame, path: str) -> int:
    """prompt and completion columns as JSON lines of chat messages."""
    message = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    rows.select(F.array(message("user", "prompt"), message("assistant", "completion")).alias("messages")).write.mode("errorifexists").json(path)
    return rows.sparkSession.read.json(path).count()


def publish(rows: DataFrame, root: str, key: str) -> str:
    """Writes the next version under root, checks that it holds as many keys as rows, then moves the pointer to it."""
    spark = rows.sparkSession
    known = current(spark, root)
    name = f"v{int(known[1:]) + 1 if known else 1}"
    rows.write.mode("errorifexists").parquet(f"{root}/{name}")
    written = spark.read.parquet(f"{root}/{name}").agg(F.count(F.lit(1)).alias("n"), F.countDistinct(key).alias("k")).first()
    if written["n"] != written["k"]:
        raise ValueError(f"{name} holds {written['n']} rows but {written['k']} keys; the pointer stays at {known}")
    spark.createDataFrame([(name,)], "name string").coalesce(1).write.mode("overwrite").text(f"{root}/_current")
    return name


def current(spark: SparkSession, root: str) -> str | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_current")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.text(f"{root}/_current").first()[0]
