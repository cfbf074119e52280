"""Observation files of mixed quality: lines that are no observation go to a table of their own.

A folder's files are checked first: one that is not CSV is listed with the reason and skipped.  The lines
of the others are parsed once, in permissive mode, and written once to a staging folder, accepted and
rejected rows apart; their numbers are observed in the same pass.  When more than a given share is rejected, the load fails
and the rejected lines stay readable.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meteora.schemas import FLAG_COLUMNS, OBS_CSV_SCHEMA, OBS_SCHEMA
from meteora.sources.csv import CSV_SUFFIXES
from meteora.sources.tables import child_paths

REJECT_SCHEMA = "file string, line string, reason string"
_BROKEN = "_broken"


class TooManyRejected(ValueError):
    """More lines were rejected than the load allows."""


@dataclass(frozen=True)
class Split:
    accepted: DataFrame
    rejected: DataFrame
    n_lines: int
    n_rejected: int


def check_sources(spark: SparkSession, folder: str) -> tuple[list[str], list[tuple[str, str]]]:
    """The CSV files of a folder, and the others with the reason they are skipped."""
    good, bad = [], []
    for path in child_paths(spark, folder):
        name = path.rsplit("/", 1)[1]
        if name.endswith(CSV_SUFFIXES) and not name.startswith(("_", ".")):
            good.append(path)
        elif not name.startswith(("_", ".")):
            bad.append((path, "only .csv and .csv.gz files are read"))
    return good, bad


def _reason(line: Column, row: Column) -> Column:
    """Why a line is rejected: its number of fields, a field that is no number, its date, or no station."""
    fields = F.size(F.split(line, ",", -1))
    return (
        F.when(row[_BROKEN].isNotNull() & (fields != len(OBS_CSV_SCHEMA)), F.lit("number of fields"))
        .when(row[_BROKEN].isNotNull(), F.lit("value"))
        .when(row["date"].isNotNull() & F.try_to_date(row["date"], "yyyyMMdd").isNull(), F.lit("date"))
        .when(row["id"].isNull(), F.lit("station"))
    )


def split_observations(spark: SparkSession, folder: str, staging: str, most_rejected: float = 0.01) -> Split:
    """Accepted observations and rejected lines (file, line, reason) of the CSV files of ``folder``.

    ``staging`` is a new folder that every executor can reach; both results read from it.  Files that are no CSV are rejected
    rows without a line.  Empty lines are no lines.
    """
    files, skipped = check_sources(spark, folder)
    if not files:
        raise ValueError(f"no CSV file in {folder}")
    schema = T.StructType([*OBS_CSV_SCHEMA.fields, T.StructField(_BROKEN, T.StringType())])
    parsed = spark.read.text(files).where("value != ''").select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"),
        F.from_csv("value", schema.simpleString()[len("struct<"):-1].replace(":", " "),
                   {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}).alias("row"))
    marked = parsed.withColumn("reason", _reason(F.col("line"), F.col("row")))
    seen = Observation()
    counted = marked.observe(seen, F.count(F.lit(1)).alias("n"), F.count("reason").alias("rejected"))
    values = {f.name: F.col("row")[f.name] for f in OBS_SCHEMA.fields}
    values["date"] = F.try_to_date(values["date"], "yyyyMMdd")
    values |= {c: F.coalesce(values[c], F.lit("")) for c in FLAG_COLUMNS}
    good = F.col("reason").isNull()
    out = counted.select(*[F.when(good, v).alias(c) for c, v in values.items()], F.when(~good, F.col("file")).alias("file"),
                         F.when(~good, F.col("line")).alias("line"), "reason", good.alias("accepted"))
    out.write.partitionBy("accepted").parquet(staging)
    n, bad = seen.get["n"], seen.get["rejected"]
    stored = spark.read.schema(out.schema).parquet(staging)
    rejected = stored.where(~F.col("accepted")).select("file", "line", "reason")
    if skipped:
        rejected = rejected.unionByName(spark.createDataFrame([(p, None, why) for p, why in skipped], REJECT_SCHEMA))
    if n and bad > most_rejected * n:
        raise TooManyRejected(f"{bad} of {n} lines of {folder} are no observation (at most {most_rejected:.2%}); see {staging}/accepted=false")
    return Split(stored.where("accepted").select(*values), rejected, n, bad)
