"""Paged record tables as a Spark data source."""

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

import obsframe
from obsframe.functions.casts import typed
from obsframe.schemas import ROWS_PER_PAGE, TABLES

cloudpickle.register_pickle_by_value(obsframe)

MOST_PARTITIONS = 200


class PageTransport(Protocol):
    """What reaches the service: the number of records, and one page as (status, body)."""

    def count(self) -> int: ...

    def page(self, offset: int, limit: int) -> tuple[int, str | None]: ...


@dataclass
class Pages(InputPartition):
    first: int
    end: int


def plan_pages(rows: int, size: int = ROWS_PER_PAGE, partitions: int = MOST_PARTITIONS) -> list[Pages]:
    """Runs of pages covering ``rows``: one page each, or more where there are more pages than ``partitions``."""
    pages = -(-rows // size)
    run = max(1, -(-pages // partitions))
    return [Pages(first, min(first + run, pages)) for first in range(0, pages, run)]


class PagedReader(DataSourceReader):
    def __init__(self, transport: PageTransport, options):
        self.transport = transport
        self.size = int(options.get("page_size", ROWS_PER_PAGE))
        self.most = int(options.get("partitions", MOST_PARTITIONS))

    def partitions(self):
        return plan_pages(self.transport.count(), self.size, self.most)

    def read(self, partition: Pages) -> Iterator[tuple]:
        for page in range(partition.first, partition.end):
            try:
                status, body = self.transport.page(page * self.size, self.size)
            except Exception as error:  # noqa: BLE001 - kept as a row of the error table
                status, body = 0, repr(error)
            yield page, status, body


def register_paged_rest(spark: SparkSession, open_transport: Callable[[dict], PageTransport]) -> None:
    """Make ``spark.read.format("paged_rest")`` read through ``open_transport(options)``."""

    class PagedRest(DataSource):
        @classmethod
        def name(cls):
            return "paged_rest"

        def schema(self):
            return "page bigint, status int, body string"

        def reader(self, schema):
            return PagedReader(open_transport(dict(self.options)), self.options)

    spark.dataSource.register(PagedRest)


def read_pages(spark: SparkSession, **options: str) -> DataFrame:
    """(page, status, body), one row per page; pages that failed are rows too."""
    return spark.read.format("paged_rest").options(**options).load()


def _good_body() -> Column:
    """The body of a page; the job fails at the first page that is missing, so no page is lost unnoticed."""
    message = F.concat(F.lit("page "), F.col("page").cast("string"), F.lit(": status "), F.col("status").cast("string"))
    return F.when(F.col("status") == 200, F.col("body")).otherwise(F.raise_error(message).cast("string"))


def page_rows(pages: DataFrame, schema: T.StructType) -> DataFrame:
    """The records of all pages, whose body is ``{"list": [record, ...]}``; the job fails at one without a list."""
    envelope = T.StructType([T.StructField("list", T.ArrayType(schema))])
    message = F.concat(F.lit("page "), F.col("page").cast("string"), F.lit(": no list of records"))
    listed = F.from_json(_good_body(), envelope)["list"]
    checked = F.when(listed.isNotNull(), listed).otherwise(F.raise_error(message).cast(T.ArrayType(schema)))
    return pages.select(F.inline(checked))


def read_table(spark: SparkSession, table: str, **options: str) -> DataFrame:
    """A logical table (``current``, ``current_2``, ``daily``, ``daily_2``, ``location``), typed."""
    kind, schema = TABLES[table]
    return typed(page_rows(read_pages(spark, table=table, **options), schema), kind)
