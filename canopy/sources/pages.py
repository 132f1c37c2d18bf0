"""Harvests as DataFrames: the pagers behind Spark's Python data source interface.

A harvest has a row a record or page: (page, value). Of an SRU search the total
is asked for first, and spans of records are read by as many tasks; pages that
only the one before leads to are read by one task, in order, and never held.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from canopy.sources import pagers

SCHEMA = "page long, value string"
SPAN = 1000  # records a task


class Span(InputPartition):
    def __init__(self, start: int, end: int):
        super().__init__(start)
        self.start, self.end = start, end


def _sru(get: pagers.Get, endpoint: str, query: str, page: int, span: int, pace: float) -> DataSourceReader:
    class Reader(DataSourceReader):
        def partitions(self) -> list[Span]:
            total, _ = pagers.sru_page(pagers.with_retries(get, pagers.sru_url(endpoint, query, 1, 1)))
            return [Span(a, min(a + span, total + 1)) for a in range(1, total + 1, span)] or [Span(1, 1)]

        def read(self, part: Span) -> Iterator[tuple]:
            for k, record in enumerate(pagers.sru_span(get, endpoint, query, part.start, part.end, page, pace)):
                yield part.start + k, record

    return Reader()


def _in_order(pages) -> DataSourceReader:
    class Reader(DataSourceReader):
        def partitions(self) -> list[Span]:
            return [Span(0, 1)]

        def read(self, part: Span) -> Iterator[tuple]:
            yield from enumerate(pages())

    return Reader()


def _frame(spark: SparkSession, reader: DataSourceReader) -> DataFrame:
    own = f"canopy_{uuid.uuid4().hex}"

    class Pages(DataSource):
        @classmethod
        def name(cls) -> str:
            return own

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return reader

    spark.dataSource.register(Pages)
    return spark.read.format(own).load()


def sru(spark: SparkSession, get: pagers.Get, endpoint: str, query: str, page: int = pagers.PAGE, span: int = SPAN, pace: float = pagers.PACE) -> DataFrame:
    """(page, value): the position and XML of each record of a search."""
    return _frame(spark, _sru(get, endpoint, query, page, span, pace))


def hal(spark: SparkSession, get: pagers.Get, url: str) -> DataFrame:
    """(page, value): pages along their links, as JSON."""
    return _frame(spark, _in_order(lambda: (json.dumps(p) for p in pagers.hal(get, url))))


def numbered(spark: SparkSession, get: pagers.Get, url: str, key: str, short: int = pagers.SHORT_PAGE) -> DataFrame:
    """(page, value): numbered pages' rows as JSON arrays, until one is short."""
    return _frame(spark, _in_order(lambda: (json.dumps(p) for p in pagers.numbered(get, url, key, short))))
