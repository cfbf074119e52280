"""Incremental ingestion of yearly observation files into a Parquet table.

The ingestion step of the pipeline converts each new headerless yearly CSV
file to Parquet.  As a Structured Streaming query over a folder it does the
same incrementally: the file source remembers (in the checkpoint) which
files it has already taken, so each run converts only new files, exactly
once, even when tasks or executors fail mid-run.  ``availableNow`` processes
whatever is there and then stops, so it runs from a scheduler like a batch.

A file that is replaced under the same name (the current year re-published
daily) is not seen again by a file stream.  ``ingest_with_ledger`` takes such files too: the
stream names the new files, the ledger of the target table (``sinks.ledger``) decides what is loaded and
replaced, and a sweep after the stream finds the changed ones.  A batch refresh refuses a table that
a stream appends to: its log names the files a refresh would remove.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from meteora.functions.scalar import parse_date
from meteora.operators.cleaning import normalize_flags
from meteora.schemas import OBS_CSV_SCHEMA
from meteora.sinks import ledger
from meteora.sinks.files import parquet_layout
from meteora.sources.csv import CSV_GLOB

# Columns of the file source, of which only the path is read.
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def observation_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Typed observations from CSV files as they land in ``source_dir``."""
    reader = spark.readStream.schema(OBS_CSV_SCHEMA).option("header", False).option("mode", "FAILFAST") \
        .option("columnPruning", False).option("pathGlobFilter", CSV_GLOB)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(source_dir)
    return parquet_layout(normalize_flags(raw.withColumn("date", parse_date("date"))))


def ingest_available(spark: SparkSession, source_dir: str, target: str, checkpoint: str,
                     max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Append every not yet ingested file to ``target`` (partitioned by year)
    and stop; returns the finished query.  ``checkpoint`` remembers the files taken."""
    query = (
        observation_stream(spark, source_dir, max_files_per_trigger)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .partitionBy("year")
        .outputMode("append")
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
    return query


def ingest_with_ledger(spark: SparkSession, source_dir: str, target: str, checkpoint: str,
                       max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Load every new or re-published CSV file of a folder into the store ``target``, and stop.

    The stream reads no file, only names: a micro-batch hands its files to the ledger, whose commit holds their
    rows and the note that they are loaded.  A micro-batch that is run again finds its files noted and does nothing.
    """
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", CSV_GLOB).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def take(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.select("path").collect()]  # file names of one micro-batch
        ledger.load(batch.sparkSession, source_dir, target, only=paths)

    query = reader.load(source_dir).select("path").writeStream.foreachBatch(take) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    ledger.load(spark, source_dir, target)
    return query
