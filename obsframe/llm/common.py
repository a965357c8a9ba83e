"""What several operators of this subpackage share."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A document belongs to the part of its key that models may learn from, or to the part held out.
FOLDS, HELD_OUT = 4, 2


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; -1 for a NULL key, which is thus in no fold by number."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds, F.lit(-1))


def held_out(key: str, folds: int = FOLDS) -> Column:
    return remainder(key, folds) == HELD_OUT


def blocks(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows in blocks whose ``column`` (string) takes up about ``most_bytes``; a longer text is a block alone."""
    for batch in batches:
        ends = text_bytes(batch.column(column))
        start, total = 0, 0
        for at, length in enumerate(ends):
            if at > start and total + length > most_bytes:
                yield batch.slice(start, at - start)
                start, total = at, 0
            total += length
        if batch.num_rows > start:
            yield batch.slice(start)
        del batch
        pa.default_memory_pool().release_unused()  # workers that wait for the next stage hold no batches


def schema_with(df: DataFrame, added: dict[str, str]) -> T.StructType:
    """The columns of ``df`` and some more, all of which may be NULL."""
    fields = [T.StructField(f.name, f.dataType) for f in df.schema.fields]
    return T.StructType(fields + [T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in added.items()])


def text_bytes(column: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_pylist()


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; NULL is empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def learnable(key: str, folds: int = FOLDS) -> Column:
    """Not held out; a NULL key is in neither part."""
    return (remainder(key, folds) >= 0) & ~held_out(key, folds)


def labelled(rows: DataFrame, label: str, text: str) -> DataFrame:
    """(label, hash, bytes) of the texts that have a label."""
    hashed = rows.select(F.col(label).alias("label"), F.xxhash64(text).alias("hash"), F.octet_length(text).alias("bytes"))
    return hashed.where(F.col("label").isNotNull() & F.col("bytes").isNotNull())


# A text longer than one in so many parts of a label's sample (or, of fewer texts, its even part) is learned from by
# excerpts, so that a long text neither ends the sample nor is left out of it.
PARTS, EXCERPTS = 16, 8


def sample_texts(texts: DataFrame, known: DataFrame, most_rows: int, most_bytes: int, text: str = "text") -> pa.Table:
    """(label, text) of distinct texts: per label of ``known`` (label, hash, bytes) the first ones by hash, up to so
    many rows and bytes. Only the chosen ones are read whole, and nothing but hashes is shuffled for the choice.

    A long text counts, and comes, as EXCERPTS evenly spread parts, together ``most_bytes`` by PARTS or by the number
    of the label's texts if that is less; so a label with any text has a sample."""
    order, all_ = Window.partitionBy("label").orderBy("hash"), Window.partitionBy("label")
    first = known.distinct().withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most_rows)
    part = (F.lit(most_bytes) / F.least(F.lit(PARTS), F.count("*").over(all_))).cast("bigint")
    first = first.withColumn("kept", F.least("bytes", part))
    chosen = first.withColumn("total", F.sum("kept").over(order)).where(F.col("total") <= most_bytes).select("label", "hash", "bytes", "kept")
    pairs = texts.sparkSession.createDataFrame(chosen.collect(), chosen.schema)
    hashed = texts.select(F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    # At most ``most_rows`` rows per label are broadcast.
    found = hashed.join(F.broadcast(pairs), "hash").dropDuplicates(["label", "hash"])
    found = found.select("label", F.when(F.col("kept") < F.col("bytes"), excerpts()).otherwise(F.col("text")).alias("text"), "hash").toArrow()
    return found.sort_by([("label", "ascending"), ("hash", "ascending")]).drop_columns(["hash"])


def excerpts() -> Column:
    """Of ``text``, evenly spread parts that together have about ``kept`` of its ``bytes``."""
    size = F.char_length("text")
    width = F.greatest(F.lit(1), F.floor(size * F.col("kept") / F.col("bytes") / EXCERPTS)).cast("int")
    starts = [F.floor((size - width) * (n / (EXCERPTS - 1))).cast("int") + 1 for n in range(EXCERPTS)]
    return F.concat_ws(" ", *[F.substr(F.col("text"), s, width) for s in starts])
