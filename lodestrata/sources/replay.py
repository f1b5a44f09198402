"""A Python data source that replays stored pages, standing in for the network."""

from __future__ import annotations

import json
import os

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.folder = options["path"]

    def partitions(self):
        return [_File(os.path.join(self.folder, f)) for f in sorted(os.listdir(self.folder)) if f.endswith(".jsonl")] or [_File("")]

    def read(self, partition):
        if partition.path:
            with open(partition.path, encoding="utf-8") as lines:
                for line in lines:
                    x = json.loads(line)
                    yield x["url"], x.get("status", 200), x.get("mime"), x.get("content")


class ReplaySource(DataSource):
    """spark.read.format("page_replay").load(folder): one partition per .jsonl file of fetched pages."""

    @classmethod
    def name(cls) -> str:
        return "page_replay"

    def schema(self) -> str:
        return "url string, status int, mime string, content string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def register(spark) -> None:
    spark.dataSource.register(ReplaySource)
