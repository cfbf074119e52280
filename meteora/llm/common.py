"""Helpers shared by the operators: tables, folds, batches of whole texts,
scratch tables in the shared folder."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meteora.session import scratch_path, unique_name

#: Bytes of text a Python task works on at a time; a longer text is one slice.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: Column, mod: int) -> Column:
    """crc32(doc_id as text) mod ``mod``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(mod)).cast("int")


def held_out(doc_id: Column, mod: int) -> Column:
    """Remainder 2; a row without an id is not held out."""
    return F.coalesce(fold(doc_id, mod) == 2, F.lit(False))


def text_slices(batch: pa.RecordBatch, text: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.StringArray]]:
    """The batch in runs of rows of about ``limit`` bytes of text, each with its
    texts (null: empty)."""
    if batch.num_rows == 0:
        return
    texts = pc.fill_null(batch.column(batch.schema.get_field_index(text)).cast(pa.string()), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(at, to - at), texts.slice(at, to - at)
        at = to


def release() -> None:
    """Give memory that a task no longer needs back to the system: a Python worker
    outlives its task, and waits beside those of later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def with_text_columns(df: DataFrame, fields: list[tuple[str, str]],
                      make: Callable[[], Callable[[pa.StringArray], list]], text: str = "text",
                      keep_text: bool = True, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``df`` with columns computed in Python from whole texts.

    ``make()`` runs once per task and gives the function from a slice of texts
    to one array per field.  All other columns pass through (the text only if
    ``keep_text``); columns of ``df`` that carry the name of a new field are
    replaced.
    """
    names = [n for n, _ in fields]
    kept = [c for c in df.columns if c not in names or c == text]
    df = df.select(*[F.col(f"`{c}`") for c in kept])
    there = [i for i, c in enumerate(kept) if c != text or keep_text]
    schema = T.StructType([df.schema.fields[i] for i in there] + [T.StructField(n, T._parse_datatype_string(t)) for n, t in fields])
    arrow = [_ARROW[t] for _, t in fields]

    def run(batches):
        f = make()
        for batch in batches:
            for part, texts in text_slices(batch, text, slice_bytes):
                new = [a if isinstance(a, pa.Array) else pa.array(a, t) for a, t in zip(f(texts), arrow, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in there] + new, names=[kept[i] for i in there] + names)
        release()

    return df.mapInArrow(run, schema)


_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "string": pa.string(),
          "boolean": pa.bool_(), "binary": pa.binary(), "array<float>": pa.list_(pa.float32())}


def keep_rows(docs: DataFrame, decide: Callable[[DataFrame], DataFrame], keep: Column) -> DataFrame:
    """The rows of ``docs``, with just its columns, that ``decide`` marks.

    ``decide`` gets doc_id, text, lang and the whole row as one struct, so
    that no column of ``docs`` clashes with those it adds.
    """
    cols = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__row"), "doc_id", "text")
    return decide(packed).where(keep).select(*[F.col(f"__row.`{c}`").alias(c) for c in cols])


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder of the shared scratch space and read again:
    later jobs start from files, also after executors are lost."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """``stored``, as a table bucketed by ``keys``, which grouping by them reads without a
    shuffle.  ``df`` should be hash-partitioned by ``keys`` already."""
    spark = df.sparkSession
    table_name = unique_name(name.replace("-", "_"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("compression", "zstd").option("path", scratch_path(spark, name)).bucketBy(buckets, *keys).saveAsTable(table_name)
    return spark.table(table_name)


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a table made by ``stored`` that nothing needs any more."""
    spark = df.sparkSession
    for f in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
