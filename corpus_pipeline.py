"""A corpus in four stages: language, toxicity, near-duplicates, packing.

Every stage takes the documents that its predecessor kept, as (spark, docs, sf_dir), and all but the last return the
columns of documents. Models are learned from the tables in ``sf_dir``, so a stage decides alike on any part of them.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsframe.llm import language, toxicity
from obsframe.llm.common import given, learnable
from obsframe.llm.queries import packed
from obsframe.llm.simhash import near_duplicates
from obsframe.workspace import materialize


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what is in no learned language: NULL texts, texts without letters, and those too far from all languages.

    Where no row has a language, nothing can be told apart and all texts are kept."""
    models = language.learn(given(spark, sf_dir, "documents").where(learnable("doc_id")))
    if models is None:
        return docs
    found = language.identify(docs, models)
    return found.where(~F.col("lang_rejected")).select(*docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what scores as toxic."""
    known = given(spark, sf_dir, "documents").where(learnable("doc_id"))
    found = toxicity.score(docs, toxicity.learn(known, given(spark, sf_dir, "labels")))
    return found.where(F.col("toxic_score") < toxicity.THRESHOLD).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group, one without an id only where no other is in it. Of rows
    that repeat both id and text one stays; an id that stands for several texts is judged by text."""
    hashed = F.xxhash64(F.coalesce("text", F.lit("")))
    own = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.coalesce("doc_id", F.lit(0)).alias("id"), hashed.alias("text"))
    named = docs.withColumn("_own", own)
    found = near_duplicates(named, words=4, distance=4, seed=42, key="_own")
    kept = found.where(F.col("_own") == F.col("component_id")).select("_own").distinct()
    return named.join(kept, "_own", "left_semi").dropDuplicates(["_own"]).drop("_own")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of up to 2048 tokens."""
    return packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("toxicity", toxicity_stage),
    ("simhash_dedup", near_duplicate_stage),
    ("packing", packing_stage),
]

# Models and a linear program are beyond SQL; the tests hold the result against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
