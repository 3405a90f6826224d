"""Training-data pipeline: a chain of document operators, each stage written as a table and read again.

Every stage keeps the columns of `documents` except the last, which gives the tokens of each kept document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentry.llm import bpe, decontam, langid, repeats, simhash, suffixdedup
from segmentry.llm.common import column
from segmentry.llm.queries import table, vocabulary_path
from segmentry.session import fresh_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _kept(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of the given ids. Rows without an id have numbers here (`with_ids`) and lose them again."""
    return repeats.without_ids(docs.join(ids.select("doc_id").distinct(), "doc_id", "left_semi")).select(*map(column, docs.columns))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; a text without letters goes, and only such if no document names a language."""
    docs = repeats.with_ids(docs)
    model = langid.learn(docs)
    if not len(model.langs):
        return _kept(docs, docs.filter(F.col("text").rlike(r"\p{L}")))
    return _kept(docs, langid.identify(docs, model).filter(langid.is_known(F.col("lang_pred"))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates, once."""
    docs = repeats.with_ids(docs)
    found = simhash.near_duplicates(docs, size=3, max_bits=2)
    return _kept(docs.dropDuplicates(["doc_id"]), found.filter("doc_id = component_id"))


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that start earlier; parts of letters at the cuts go, empty texts stay."""
    return suffixdedup.cleaned(docs, length=100)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    docs = repeats.with_ids(docs)
    found = decontam.find_items(docs, table(spark, sf_dir, "benchmark"), window=10)
    return _kept(docs, found.filter(F.size("spans") == 0))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and the digests of ids and decoded text."""
    return bpe.encoding_digests(bpe.encode_documents(docs, vocabulary_path()))


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("decontaminate", decontaminate),
    ("tokenize", tokenize),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
