"""Tables stored by day, of which a run reads and writes only the days it changes."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.sinks.commits import commit, delete, last_commit, names

# The day of rows without one.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


class DayTable:
    """Rows with a ``day`` (text), in ``folder``. Every change writes new files, then a document that names the files
    of each day; readers see all of a change or nothing of it."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType) -> None:
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema

    def days(self) -> dict[str, list[str]]:
        """The batches that each day consists of."""
        return (last_commit(self.spark, f"{self.folder}/commits")[1] or {"days": {}})["days"]

    def read(self, days: list[str] | None = None) -> DataFrame:
        """The rows, of all days or of some; files of other days are not opened."""
        known = self.days()
        paths = [f"{self.folder}/rows/{batch}/day={d}" for d in (known if days is None else days) for batch in known.get(d, [])]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def add(self, rows: DataFrame) -> list[str]:
        """Store ``rows`` (with the table's columns and ``day``) beside what their days hold; the days written."""
        return self._write(rows, None)

    def replace(self, rows: DataFrame, days: list[str]) -> None:
        """Store ``rows`` in place of all that ``days`` hold; a day without rows is empty then."""
        self._write(rows, days)

    def _write(self, rows: DataFrame, replaced: list[str] | None) -> list[str]:
        batch = uuid.uuid4().hex
        path = f"{self.folder}/rows/{batch}"
        fields = [F.col(f.name).cast(f.dataType) for f in self.schema]
        # In ranges of days, and within a day of a hash: few files a task, and a day with many rows is no one task's.
        dealt = rows.select(*fields, "day").repartitionByRange("day", F.xxhash64(*self.schema.fieldNames()))
        dealt.write.partitionBy("day").parquet(path)
        written = sorted(n.removeprefix("day=") for n in names(self.spark, path) if n.startswith("day="))
        version, found = last_commit(self.spark, f"{self.folder}/commits")
        days = (found or {"days": {}})["days"]
        if replaced is None:
            days |= {d: [*days.get(d, []), batch] for d in written}
        else:
            days |= {d: [] for d in replaced} | {d: [batch] for d in written}
        commit(self.spark, f"{self.folder}/commits", version + 1, {"days": {d: b for d, b in days.items() if b}})
        return written

    def clean(self) -> int:
        """Delete the files that no day names: replaced ones, and those of runs that failed. How many folders went.
        For when nothing else reads or writes the table."""
        days, gone = self.days(), 0
        for batch in names(self.spark, f"{self.folder}/rows"):
            path = f"{self.folder}/rows/{batch}"
            if not any(batch in batches for batches in days.values()):
                delete(self.spark, path)
                gone += 1
                continue
            for part in names(self.spark, path):
                if part.startswith("day=") and batch not in days.get(part.removeprefix("day="), []):
                    delete(self.spark, f"{path}/{part}")
                    gone += 1
        return gone


def day_of(column: str):
    """The day of a timestamp as text, which is how a folder is named."""
    return F.coalesce(F.date_format(F.to_date(column), "yyyy-MM-dd"), F.lit(NO_DAY))
