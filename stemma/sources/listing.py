"""Paged listings as a batch data source: one partition per category, pages fetched in turn by an exchangeable fetcher.

The engine itself never opens connections: a fetcher is a function (category, page) -> (body, number of pages), named
as ``module:function``. A cached folder of earlier answers can serve as one.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Category(InputPartition):
    def __init__(self, name: str) -> None:
        self.name = name


class ListingReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.categories = [c for c in options["categories"].split(",") if c]
        self.fetcher = options["fetcher"]

    def partitions(self) -> list[Category]:
        return [Category(c) for c in self.categories]

    def read(self, partition: Category) -> Iterator[tuple]:
        module, _, name = self.fetcher.partition(":")
        fetch = getattr(importlib.import_module(module), name)
        page, pages = 1, 1
        while page <= pages:
            body, pages = fetch(partition.name, page)
            if not body:
                break
            yield partition.name, page, body
            page += 1


class ListingSource(DataSource):
    """``spark.read.format("stemma_listing")`` with options ``categories`` (comma-separated) and ``fetcher``."""

    @classmethod
    def name(cls) -> str:
        return "stemma_listing"

    def schema(self) -> str:
        return "category string, page int, body string"

    def reader(self, schema: object) -> ListingReader:
        return ListingReader(self.options)


class Batch(InputPartition):
    def __init__(self, keys: list[str]) -> None:
        self.keys = keys


class BatchReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.keys = [k for k in options["keys"].split("|") if k]
        self.size = int(options.get("size", 50))
        self.fetcher = options["fetcher"]

    def partitions(self) -> list[Batch]:
        return [Batch(self.keys[i : i + self.size]) for i in range(0, len(self.keys), self.size)] or [Batch([])]

    def read(self, partition: Batch) -> Iterator[tuple]:
        module, _, name = self.fetcher.partition(":")
        fetch = getattr(importlib.import_module(module), name)
        if partition.keys:
            for key, body in fetch(partition.keys):
                yield key, body


class BatchSource(DataSource):
    """``spark.read.format("stemma_batches")``: ``keys`` (joined by bars) asked for ``size`` at a time, one partition each.

    The fetcher takes a list of keys and gives (key, body) pairs.
    """

    @classmethod
    def name(cls) -> str:
        return "stemma_batches"

    def schema(self) -> str:
        return "key string, body string"

    def reader(self, schema: object) -> BatchReader:
        return BatchReader(self.options)
