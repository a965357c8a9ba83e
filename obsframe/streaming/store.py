"""Stream tables by day whose batches are merged, and whose keys are looked up in few files."""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from obsframe.operators.versions import latest
from obsframe.sinks.commits import commit, delete, last_commit, names
from obsframe.sinks.days import day_of
from obsframe.streaming.ingest import KEY, STORED_ROWS, Sink, start_ingest

# A day's batches are merged when there are so many.
MERGE = 16
# A batch's filter has so many bits a key, in maps of 32,768 bits: one key in about BITS that is not in it seems to be.
BITS, MAP = 10, 32_768
FILTER = "map int, maps int, bits binary"


class StreamTable:
    """Rows of a stream by day, in ``folder``. A document names the batches that each day consists of and the last
    batch taken in, and is written after them. So a batch that is tried again is taken in once, readers see a batch or
    merge whole, and what a failed one has written is not named.

    With ``keys`` a row is stored once per key, NULL keys being equal; its day must follow from the key. For every batch and day there is a filter of
    keys, so a new batch opens only those stored ones of its days that may hold one of its keys."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, keys: list[str] | None = None, merge: int = MERGE) -> None:
        self.spark, self.folder, self.schema, self.keys, self.merge = spark, folder.rstrip("/"), schema, keys, merge

    def state(self) -> tuple[int, dict]:
        version, found = last_commit(self.spark, f"{self.folder}/commits")
        return version, found or {"batch": -1, "days": {}}

    def read(self, days: list[str] | None = None) -> DataFrame:
        """The rows, of all days or of some."""
        known = self.state()[1]["days"]
        return self._rows([(d, b) for d in (known if days is None else days) for b in known.get(d, [])])

    def _rows(self, parts: list[tuple[str, str]]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.folder}/rows/{b}/day={d}" for d, b in parts])

    def add(self, rows: DataFrame, batch_id: int, time: str = "time") -> int:
        """Take in a batch; how many stored batches were opened to look for its keys."""
        version, state = self.state()
        if batch_id <= state["batch"]:
            return 0
        opened: list[tuple[str, str]] = []
        marked = rows.select(*self.schema.names).withColumn("day", day_of(time))
        if self.keys:
            order = [F.col(c).asc_nulls_last() for c in self.schema.names if c not in self.keys]
            marked = latest(marked, self.keys, order or [F.lit(0)])
        marked = marked.persist()
        try:
            if self.keys:
                days = [r.day for r in marked.select("day").distinct().collect()]  # the calendar bounds them
                opened = self.may_hold(marked, [(d, b) for d in days for b in state["days"].get(d, [])])
            new = marked
            if opened:
                known = self._rows(opened).select(*[F.col(k).alias(f"_{k}") for k in self.keys])
                same = F.lit(True)
                for k in self.keys:
                    same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
                new = marked.join(known, same, "left_anti")
            written = self._write(new, f"batch-{batch_id}")
        finally:
            marked.unpersist()
        for d in written:
            state["days"][d] = [*state["days"].get(d, []), f"batch-{batch_id}"]
        commit(self.spark, f"{self.folder}/commits", version + 1, {"batch": batch_id, "days": state["days"]})
        self.compact()
        return len(opened)

    def compact(self) -> list[str]:
        """Make one batch of each day that has ``merge`` or more; the days. Rows are written before the document
        that names them, so a merge that fails changes nothing."""
        version, state = self.state()
        full = [d for d, batches in state["days"].items() if len(batches) >= self.merge]
        if full:
            name = f"merged-{uuid.uuid4().hex}"
            rows = self._rows([(d, b) for d in full for b in state["days"][d]])
            self._write(rows.withColumn("day", day_of("time")), name)
            days = state["days"] | {d: [name] for d in full}
            commit(self.spark, f"{self.folder}/commits", version + 1, {"batch": state["batch"], "days": days})
        return full

    def clean(self) -> int:
        """Delete what no day names, of merged and failed batches; how many folders. For when no one reads."""
        days, gone = self.state()[1]["days"], 0
        for kind in ("rows", "filters"):
            for batch in names(self.spark, f"{self.folder}/{kind}"):
                for part in names(self.spark, f"{self.folder}/{kind}/{batch}"):
                    if part.startswith("day=") and batch not in days.get(part.removeprefix("day="), []):
                        delete(self.spark, f"{self.folder}/{kind}/{batch}/{part}")
                        gone += kind == "rows"
                if not any(p.startswith("day=") for p in names(self.spark, f"{self.folder}/{kind}/{batch}")):
                    delete(self.spark, f"{self.folder}/{kind}/{batch}")
        return gone

    def _write(self, rows: DataFrame, name: str) -> list[str]:
        path = f"{self.folder}/rows/{name}"
        dealt = rows.repartitionByRange("day", F.xxhash64(*self.schema.names))
        dealt.write.mode("overwrite").partitionBy("day").parquet(path)
        written = sorted(n.removeprefix("day=") for n in names(self.spark, path) if n.startswith("day="))
        if self.keys and written:
            stored = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("day", T.StringType())])).parquet(path)
            stored = stored.withColumn("day", day_of("time"))
            sizes = stored.groupBy("day").agg(F.ceil(F.count("*") * BITS / MAP).cast("int").alias("maps"))
            hashed = stored.join(F.broadcast(sizes), "day").select("day", "maps", *self._place("maps"))
            bits = hashed.groupBy("day", "map", "maps").agg(F.expr("bitmap_construct_agg(at)").alias("bits"))
            bits.repartitionByRange("day", "map").write.mode("overwrite").partitionBy("day").parquet(f"{self.folder}/filters/{name}")
        return written

    def _place(self, maps: str) -> list[Column]:
        """The map of a key, and the bit in it."""
        hashed = F.xxhash64(*self.keys)
        return [F.pmod(hashed, F.col(maps)).cast("int").alias("map"), F.pmod(F.shiftright(hashed, 24), F.lit(MAP)).alias("at")]

    def may_hold(self, rows: DataFrame, parts: list[tuple[str, str]]) -> list[tuple[str, str]]:
        """Which of the stored (day, batch) parts may hold a key of ``rows`` (with ``day``)."""
        if not parts:
            return []
        filters = None
        for day, batch in parts:
            own = self.spark.read.schema(FILTER).parquet(f"{self.folder}/filters/{batch}/day={day}")
            own = own.select(F.lit(day).alias("day"), F.lit(batch).alias("batch"), "*")
            filters = own if filters is None else filters.unionByName(own)
        sizes = filters.select("day", "batch", "maps").distinct()
        # A row meets each of its day's batches, which compaction bounds, and of each the one map with its bit.
        asked = rows.select("day", *self.keys).join(F.broadcast(sizes), "day").select("day", "batch", *self._place("maps")).distinct()
        octet = F.expr("cast(conv(hex(substring(bits, cast(at div 8 as int) + 1, 1)), 16, 10) as int)")
        held = F.expr("shiftright(octet, cast(at % 8 as int)) & 1") == 1
        met = asked.join(filters.drop("maps"), ["day", "batch", "map"]).withColumn("octet", octet).where(held)
        return sorted((r.day, r.batch) for r in met.select("day", "batch").distinct().collect())


def stream_tables(spark: SparkSession, root: str, merge: int = MERGE) -> dict[str, StreamTable]:
    """The tables of :func:`ingest_to_tables`: readings once per place and time, forecasts as they come."""
    plain = {k: T.StructType([f for f in s.fields if f.name not in ("day", "batch_id")]) for k, s in STORED_ROWS.items()}
    return {
        "current": StreamTable(spark, f"{root}/current", plain["current"], KEY, merge),
        "daily": StreamTable(spark, f"{root}/daily", plain["daily"], None, merge),
    }


def table_sink(tables: dict[str, StreamTable]) -> Sink:
    return lambda table, rows, batch_id: tables[table].add(rows, batch_id) and None


def ingest_to_tables(
    messages: DataFrame, root: str, checkpoint: str, available_now: bool = False, merge: int = MERGE,
) -> StreamingQuery:
    """:func:`ingest.start_ingest` into tables whose number of folders a day is bounded by ``merge``. A root belongs to
    one checkpoint, which counts the batches."""
    tables = stream_tables(messages.sparkSession, root, merge)
    return start_ingest(messages, checkpoint, table_sink(tables), lambda spark, batch_id, days: None, available_now)
