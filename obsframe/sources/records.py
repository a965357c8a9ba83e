"""Records of a paged service as a Spark data source that fetches only pages a filter can match."""

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual,
)

from obsframe.schemas import ROWS_PER_PAGE
from obsframe.sources.paged import MOST_PARTITIONS, PageTransport

# An index has a low and a high value for so many runs of pages at most.
MOST_RUNS = 2_000
POSITION = "position"


class Number(str):
    """A number as it was written."""


class PageError(RuntimeError):
    """A page that is not what the service said it would be."""


@dataclass(frozen=True)
class PageIndex:
    """Lowest and highest value of each key in each run of ``run`` pages of ``size`` records, of the first ``rows``."""

    rows: int
    size: int
    run: int
    keys: dict[str, list[tuple]]

    def to_json(self) -> str:
        return json.dumps([self.rows, self.size, self.run, self.keys])

    @staticmethod
    def from_json(text: str) -> "PageIndex":
        return PageIndex(*json.loads(text))


@dataclass
class Span(InputPartition):
    first: int
    end: int
    rows: int


def page_index(rows: DataFrame, keys: list[str], size: int = ROWS_PER_PAGE) -> PageIndex:
    """The index of (stored) ``rows`` of :func:`read_records`, by one aggregation; runs are longer the more pages there
    are, so it stays small. Keys are text or numbers.

    The job fails where rows are missing, or where two runs hold the same values: a page was read twice."""
    for key in keys:
        if not isinstance(rows.schema[key].dataType, (T.StringType, T.NumericType)):
            raise ValueError(f"{key} is no text or number")
    last = rows.agg(F.max(POSITION)).first()[0]
    total = 0 if last is None else last + 1
    pages = -(-total // size)
    run = max(1, -(-pages // MOST_RUNS))
    of = F.floor(F.col(POSITION) / (size * run)).alias("run")
    ends = [F.struct(F.min(k), F.max(k)).alias(k) for k in keys]
    found = rows.groupBy(of).agg(F.count("*").alias("n"), *ends).orderBy("run").collect()  # at most MOST_RUNS rows
    if sum(r.n for r in found) != total:
        raise PageError(f"{sum(r.n for r in found)} rows of {total}")
    entries = {k: [tuple(r[k]) for r in found] for k in keys}
    whole = [tuple(entries[k][i] for k in keys) for i in range(len(found) - 1)]
    if keys and len(set(whole)) < len(whole):
        raise PageError("two runs of pages hold the same keys")
    return PageIndex(total, size, run, entries)


def may_match(filter_: Filter, low, high) -> bool:
    """Whether a value from ``low`` to ``high`` can pass; None says that there is no value."""
    value = filter_.value
    try:
        if isinstance(filter_, In):
            return low is not None and any(v is not None and low <= v <= high for v in value)
        if low is None or value is None:
            return False
        if isinstance(filter_, EqualTo):
            return low <= value <= high
        if isinstance(filter_, GreaterThan):
            return high > value
        if isinstance(filter_, GreaterThanOrEqual):
            return high >= value
        if isinstance(filter_, LessThan):
            return low < value
        return low <= value
    except TypeError:  # not comparable here; Spark decides
        return True


class RecordReader(DataSourceReader):
    def __init__(self, transport: PageTransport, schema: T.StructType, options) -> None:
        self.transport, self.schema = transport, schema
        self.size = int(options.get("page_size", ROWS_PER_PAGE))
        self.most = int(options.get("partitions", MOST_PARTITIONS))
        self.index = PageIndex.from_json(options["index"]) if options.get("index") else None
        if self.index and self.index.size != self.size:
            raise ValueError(f"the index is of pages of {self.index.size} records")
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """All filters stay with Spark too: here they only tell which pages to fetch."""
        for f in filters:
            if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, In, LessThan, LessThanOrEqual)) and len(f.attribute) == 1:
                self.filters.append(f)
            yield f

    def wanted(self, rows: int) -> list[int]:
        """The pages of ``rows`` records that may hold a match. Records beyond the index are always read."""
        pages = range(-(-rows // self.size))
        known = 0
        if self.index and self.index.rows <= rows:  # else the service has lost records, and the index says nothing
            known = self.index.rows // self.size
        found = []
        for page in pages:
            low, high = page * self.size, min(rows, (page + 1) * self.size) - 1
            if not all(may_match(f, low, high) for f in self.filters if f.attribute == (POSITION,)):
                continue
            if page < known:
                at = page // self.index.run
                if not all(may_match(f, *self.index.keys[f.attribute[0]][at]) for f in self.filters if f.attribute[0] in self.index.keys):
                    continue
            found.append(page)
        return found

    def partitions(self) -> list[Span]:
        rows = self.transport.count()
        spans: list[list[int]] = []
        wanted = self.wanted(rows)
        run = max(1, -(-len(wanted) // self.most))
        for page in wanted:
            if spans and spans[-1][1] == page and page - spans[-1][0] < run:
                spans[-1][1] += 1
            else:
                spans.append([page, page + 1])
        return [Span(first, end, rows) for first, end in spans]

    def read(self, partition: Span | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # a read without partitions is asked for one of none
            return
        for page in range(partition.first, partition.end):
            first = page * self.size
            due = min(self.size, partition.rows - first)
            status, body = self.transport.page(first, self.size)
            if status != 200:
                raise PageError(f"page {page}: status {status}")
            records = parse_body(body)
            if records is None:
                raise PageError(f"page {page}: no list of records")
            if len(records) < due or len(records) > self.size:
                raise PageError(f"page {page}: {len(records)} records of {due}")
            yield self.batch(first, records[:due])  # what was added since the count is of the next read

    def batch(self, first: int, records: list[dict]) -> pa.RecordBatch:
        columns, fields = [], []
        for field in self.schema.fields:
            if field.name == POSITION:
                values, kind = list(range(first, first + len(records))), pa.int64()
            else:
                kind = ARROW[type(field.dataType)]
                values = [value_of(r.get(field.name), kind) for r in records]
            columns.append(pa.array(values, kind))
            fields.append(field.name)
        return pa.RecordBatch.from_arrays(columns, names=fields)


ARROW = {
    T.StringType: pa.string(), T.IntegerType: pa.int32(), T.LongType: pa.int64(), T.DoubleType: pa.float64(), T.BooleanType: pa.bool_(),
}


def parse_body(body: str | None) -> list[dict] | None:
    """The records of ``{"list": [record, ...]}``; numbers keep their text. None if it is nothing of the kind."""
    try:
        listed = json.loads(body or "", parse_int=Number, parse_float=Number)["list"]
    except (ValueError, KeyError, TypeError):
        return None
    return listed if isinstance(listed, list) and all(isinstance(r, dict) for r in listed) else None


def written(value) -> str:
    """A value as JSON, numbers as they came."""
    if isinstance(value, Number):
        return str(value)
    if isinstance(value, list):
        return f"[{','.join(map(written, value))}]"
    if isinstance(value, dict):
        return f"{{{','.join(f'{json.dumps(k)}:{written(v)}' for k, v in value.items())}}}"
    return json.dumps(value)


def value_of(value, kind: pa.DataType):
    """A value as a column of ``kind`` holds it. Text takes anything as it was written; another kind takes what JSON
    has in that kind, and NULL for the rest."""
    if value is None:
        return None
    if kind == pa.string():
        return str(value) if isinstance(value, str) else written(value)
    if kind == pa.bool_():
        return value if isinstance(value, bool) else None
    if not isinstance(value, Number):
        return None
    try:
        if kind == pa.float64():
            return float(value)
        number = int(value)
    except ValueError:
        return None
    return number if abs(number) < 1 << (kind.bit_width - 1) else None


def register_paged_records(spark: SparkSession, open_transport: Callable[[dict], PageTransport]) -> None:
    """Make ``spark.read.format("paged_records")`` read through ``open_transport(options)``, and let it see filters."""

    class PagedRecords(DataSource):
        @classmethod
        def name(cls):
            return "paged_records"

        def schema(self):
            raise ValueError("give the schema of the records")

        def reader(self, schema):
            return RecordReader(open_transport(dict(self.options)), schema, self.options)

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedRecords)


def read_records(spark: SparkSession, schema: T.StructType, index: PageIndex | None = None, **options: str) -> DataFrame:
    """The records of a table, with their ``position``. Comparisons of ``position``, and of keys that ``index`` has,
    keep pages from being fetched; pages that the index does not cover in full always are, as far as ``position``
    allows. The job fails at a page that does not come whole, so a table is read up to the service's own count."""
    unknown = [f.name for f in schema.fields if type(f.dataType) not in ARROW or f.name == POSITION]
    if unknown:
        raise ValueError(f"no records with columns {', '.join(unknown)}")
    fields = T.StructType([T.StructField(POSITION, T.LongType()), *schema.fields])
    given = {"index": index.to_json()} if index else {}
    return spark.read.format("paged_records").schema(fields).options(**options, **given).load()
