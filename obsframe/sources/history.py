"""A stored copy of a paged table that only ever reads what was added."""

import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.sinks.commits import commit, delete, last_commit, names
from obsframe.sources.records import POSITION, read_records

# So many batches of a level are merged into one of the next.
MERGE = 16


class HistoryChanged(RuntimeError):
    """The service no longer has the records it had; copy the table anew, into another folder."""


@dataclass
class Batch:
    name: str
    level: int
    rows: int


@dataclass
class State:
    """What a folder holds: ``rows`` records, the last of which has the hash ``last``, in ``batches``."""

    version: int = 0
    rows: int = 0
    last: int | None = None
    batches: list[Batch] = field(default_factory=list)


def read_state(spark: SparkSession, folder: str) -> State:
    """The last state that was committed; the first, empty one where there is none."""
    _, found = last_commit(spark, f"{folder}/state")
    return State(found["version"], found["rows"], found["last"], [Batch(**b) for b in found["batches"]]) if found else State()


def _hash(schema: T.StructType) -> Column:
    return F.xxhash64(*[F.col(f.name) for f in schema.fields])


def sync(spark: SparkSession, schema: T.StructType, folder: str, **options: str) -> State:
    """Add to ``folder`` what the service has beyond it, and commit.

    Only pages from the last stored record on are fetched. That record is compared, so a service that has lost,
    shifted or changed its end is noticed. Rows are written before the state that names them: a run that fails
    between leaves files that nothing refers to. ``MERGE`` small batches become one of the next level, so a folder
    of n records added in any number of runs has some MERGE * log(n) batches, and a record is rewritten log(n) times.
    """
    state = read_state(spark, folder)
    batch = Batch(uuid.uuid4().hex, 0, 0)
    read = read_records(spark, schema, **options).where(F.col(POSITION) >= max(0, state.rows - 1))
    path = f"{folder}/rows/{batch.name}"
    read.write.parquet(path)
    fields = T.StructType([T.StructField(POSITION, T.LongType()), *schema.fields])
    added = spark.read.schema(fields).parquet(path)
    last = F.max_by(_hash(schema), POSITION)
    before = F.max(F.when(F.col(POSITION) == state.rows - 1, _hash(schema)))
    seen, first, end, newest = added.agg(F.count("*"), F.min(POSITION), F.max(POSITION), last).first()
    if state.rows and (not seen or first != state.rows - 1 or added.agg(before).first()[0] != state.last):
        raise HistoryChanged(f"record {state.rows - 1} is not what was stored in {folder}")
    if seen and seen != end - first + 1:
        raise HistoryChanged(f"{seen} records of {end - first + 1}")
    if not seen or end + 1 == state.rows:
        delete(spark, path)
        return state
    batch.rows = end + 1 - state.rows
    merged = _merged(spark, fields, folder, [*state.batches, batch])
    new = State(state.version + 1, end + 1, newest, merged)
    commit(spark, f"{folder}/state", new.version, asdict(new))
    return new


def _merged(spark: SparkSession, fields: T.StructType, folder: str, batches: list[Batch]) -> list[Batch]:
    level = 0
    while sum(b.level == level for b in batches) >= MERGE:
        old = [b for b in batches if b.level == level]
        whole = Batch(uuid.uuid4().hex, level + 1, sum(b.rows for b in old))
        rows = _rows(spark, fields, folder, old, batches)
        # Ranges of positions stay in files of their own.
        files = max(1, whole.rows // 1_000_000)
        rows.repartitionByRange(files, POSITION).write.parquet(f"{folder}/rows/{whole.name}")
        batches = [b for b in batches if b.level > level] + [whole]
        level += 1
    return batches


def _rows(spark: SparkSession, fields: T.StructType, folder: str, some: list[Batch], batches: list[Batch]) -> DataFrame:
    """The records of ``some`` batches. A batch begins with the last record before it, which is not its own."""
    begins, at = {}, 0
    for b in batches:
        begins[b.name] = at
        at += b.rows
    parts = [spark.read.schema(fields).parquet(f"{folder}/rows/{b.name}").where(F.col(POSITION) >= begins[b.name]) for b in some]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole


def read_history(spark: SparkSession, schema: T.StructType, folder: str, from_position: int = 0) -> DataFrame:
    """(position, record) of all committed records, or those from a position on: batches before it are not opened."""
    state = read_state(spark, folder)
    fields = T.StructType([T.StructField(POSITION, T.LongType()), *schema.fields])
    ends, at = [], 0
    for b in state.batches:
        at += b.rows
        ends.append(at)
    some = [b for b, end in zip(state.batches, ends) if end > from_position]
    if not some:
        return spark.createDataFrame([], fields)
    return _rows(spark, fields, folder, some, state.batches).where(F.col(POSITION) >= from_position)


def clean(spark: SparkSession, folder: str) -> int:
    """Delete batches that the last state does not name: of runs that failed, and merged ones. How many went.
    For when nothing else reads or writes the folder."""
    state = read_state(spark, folder)
    named = {b.name for b in state.batches}
    gone = [name for name in names(spark, f"{folder}/rows") if name not in named]
    for name in gone:
        delete(spark, f"{folder}/rows/{name}")
    return len(gone)

