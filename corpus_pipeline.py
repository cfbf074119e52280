"""The corpus pipeline: five stages over ``documents``.

Each stage is a function of (spark, docs, sf_dir); its result is written as
Parquet and read again as the next one's ``docs``.  All but the last return
the columns of ``documents``.

1. quality classifier: documents scored below its threshold go;
2. language ID: documents without a language the models accept go;
3. line dedup: repeated and similar lines go, every document stays;
4. SimHash near-dedup: one document of each group stays;
5. best-fit packing: the pieces and their places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteora.llm import langid, linededup, packing, quality, simhash
from meteora.llm.common import fold, keep_rows, stored, table
from meteora.llm.registry import vocabulary


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.fit(docs, labels, fold(F.col("doc_id"), 4) != 2)
    return keep_rows(docs, lambda d: quality.with_quality(d, model), F.col("predicted") == 1)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs, fold(F.col("doc_id"), 4) != 2)
    return keep_rows(docs, lambda d: langid.with_language(d, model), ~F.col("rejected"))


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.without_duplicate_lines(docs).select(*docs.columns)


def unique_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs, shingle=4, radius=4)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary(), 2048)


STAGES = [
    ("quality classifier", good_quality),
    ("language id", known_language),
    ("line dedup", unique_lines),
    ("simhash near-dedup", unique_documents),
    ("best-fit packing", packed),
]

#: SQL cannot express the learnt stages; the tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
