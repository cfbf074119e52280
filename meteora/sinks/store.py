"""Atomic, versioned tables over Parquet folders.

A store is a folder with named tables.  Their data lies in ``data/<table>/commit=<id>/<keys>``, and
a version is one JSON manifest, ``versions/<number>.json``, which names the current folder of each key (a year, a
source file, ...) of each table.  A transaction writes new data folders first; nothing refers to them
until its manifest is moved to the next number, so every table it changed changes at
once.  A run that dies before leaves folders that no manifest names: readers never see them, and ``clean``
removes them.  Two transactions from the same version: the second one's number is taken, and it fails.

The move must fail when its target exists, as it does on HDFS; on an object store use a file system
client with that guarantee.  A manifest holds one line per key, not per file.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meteora.sources.tables import child_paths, path_exists, rename


class Conflict(RuntimeError):
    """Another transaction committed first; run again from the new version."""


def read_text(spark: SparkSession, path: str) -> str:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def modified(spark: SparkSession, path: str) -> int:
    """When a file or folder was last changed, in milliseconds."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getModificationTime()


class Store:
    """The tables below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        names = (p.rsplit("/", 1)[1] for p in child_paths(self.spark, f"{self.path}/versions"))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/versions/{version:010d}.json"

    def manifest(self, version: int | None = None) -> dict:
        """The given version, the last one by default; an empty one before the first commit."""
        if version is None:
            found = self.versions()
            if not found:
                return {"version": 0, "tables": {}}
            version = found[-1]
        return json.loads(read_text(self.spark, self._manifest_path(version)))

    def has(self, table: str) -> bool:
        return table in self.manifest()["tables"]

    def keys(self, table: str) -> dict[str, dict]:
        """The current keys of a table with what was noted for each."""
        found = self.manifest()["tables"].get(table, {"entries": {}})["entries"]
        return {k: e["note"] for k, e in found.items()}

    def read(self, table: str, keys: Iterable[str] | None = None, version: int | None = None) -> DataFrame:
        """A table as of a version, whole or only some of its keys (``year=1996``)."""
        return self._read(self.manifest(version), table, keys)

    def _read(self, manifest: dict, table: str, keys: Iterable[str] | None = None) -> DataFrame:
        if table not in manifest["tables"]:
            raise ValueError(f"no table {table} in version {manifest['version']} of {self.path}")
        t = manifest["tables"][table]
        wanted = set(t["entries"]) if keys is None else set(keys)
        folders = sorted(e["folder"] for k, e in t["entries"].items() if k in wanted and e["folder"])
        schema = T.StructType.fromJson(t["schema"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        # a commit folder of which every key is current is read as one path
        by_commit: dict[str, list[str]] = {}
        for f in folders:
            by_commit.setdefault(f.split("/", 1)[0], []).append(f)
        whole = [c for c, f in by_commit.items() if len(f) == t["commits"].get(c)]
        paths = whole + [f for c, fs in by_commit.items() if c not in whole for f in fs]
        base = f"{self.path}/data/{table}"
        stored = T.StructType([*schema.fields, T.StructField("commit", T.StringType())])
        return self.spark.read.schema(stored).option("basePath", base).parquet(*[f"{base}/{p}" for p in paths]).select(*schema.names)

    def begin(self) -> "Transaction":
        return Transaction(self)

    def replace(self, table: str, df: DataFrame, partition_by: list[str] = (), cluster_by: list[str] = ()) -> None:
        """The whole table is replaced, or created."""
        t = self.begin()
        t.write(table, df, partition_by, cluster_by)
        t.commit()

    def refresh(self, table: str, df: DataFrame, keys: Iterable[str], cluster_by: list[str] = ()) -> None:
        """Only the given keys are replaced; one without rows in ``df`` goes."""
        t = self.begin()
        t.write(table, df, t.partition_by(table), cluster_by, keys=keys)
        t.commit()

    def clean(self, keep: int = 2, older_than_ms: int = 86_400_000, now_ms: int | None = None) -> list[str]:
        """Drop all but the last ``keep`` versions, and data folders none of those names.

        Folders younger than ``older_than_ms`` stay: they may belong to a run that has yet to commit.
        Returns the folders removed.
        """
        import time

        if keep < 1:
            raise ValueError("the current version stays")
        now_ms = int(time.time() * 1000) if now_ms is None else now_ms
        found = self.versions()
        used, gone = set(), []
        for v in found[-keep:]:
            for table, t in self.manifest(v)["tables"].items():
                used |= {(table, e["folder"].split("/", 1)[0]) for e in t["entries"].values() if e["folder"]}
        for v in found[:-keep]:
            delete(self.spark, self._manifest_path(v))
        for table_path in child_paths(self.spark, f"{self.path}/data"):
            for folder in child_paths(self.spark, table_path):
                name = (table_path.rsplit("/", 1)[1], folder.rsplit("/", 1)[1])
                if name not in used and modified(self.spark, folder) <= now_ms - older_than_ms:
                    delete(self.spark, folder)
                    gone.append(folder)
        return gone


class Transaction:
    """Changes to a store's tables that become visible together."""

    def __init__(self, store: Store):
        self.store, self.base = store, store.manifest()
        self.tables = json.loads(json.dumps(self.base["tables"]))
        self.id = uuid.uuid4().hex[:16]
        self.touched: set[str] = set()

    def read(self, table: str, keys: Iterable[str] | None = None) -> DataFrame:
        """A table as of the version this transaction began from."""
        return self.store._read(self.base, table, keys)

    def written(self, table: str) -> DataFrame:
        """The rows this transaction wrote to a table, which no reader of the store sees yet."""
        if table not in self.touched:
            raise ValueError(f"{table} is not written in this transaction")
        own = [k for k, e in self.tables[table]["entries"].items() if (e["folder"] or "").split("/", 1)[0] == f"commit={self.id}"]
        return self.store._read({"version": self.base["version"], "tables": self.tables}, table, own)

    def keys(self, table: str) -> dict[str, dict]:
        return {k: e["note"] for k, e in self.tables.get(table, {"entries": {}})["entries"].items()}

    def partition_by(self, table: str) -> list[str]:
        if table not in self.tables:
            raise ValueError(f"no table {table} in {self.store.path}")
        return self.tables[table]["partition_by"]

    def write(self, table: str, df: DataFrame, partition_by: list[str] = (), cluster_by: list[str] = (),
              keys: Iterable[str] | None = None, notes: dict[str, dict] | None = None, layout: bool | str = True) -> None:
        """New rows of a table: all of it, or only those of ``keys`` (which they replace).

        A key is the folder of its partition values (``year=1996``), or empty for a table without.
        A row outside of ``keys`` fails the write.  ``notes`` are kept with their keys.
        With ``layout`` rows are spread by range and sorted before the write (``sinks.tables``);
        with "folders" they are rebalanced by their folder and sorted, so that ``df`` is computed once and not
        sampled first; without, every task writes what it has.  A table is written once in a transaction.
        """
        if table in self.touched:
            raise ValueError(f"{table} is already written in this transaction")
        self.touched.add(table)
        from meteora.sinks.tables import _by_folder, _layout

        partition_by, spark = list(partition_by), self.store.spark
        base = f"{self.store.path}/data/{table}"
        folder = f"commit={self.id}"
        names = [c for c in df.columns if c not in partition_by] + partition_by
        df = df.select(*names)
        if keys is not None:
            keys = set(keys)
            asked = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))
                                       for c in partition_by])
            stray = ~asked.isin(sorted(keys)) if keys else F.lit(True)
            what = F.concat(F.lit(f"a row of {table} outside of the keys to be replaced: "), asked)
            c = names[0]
            df = df.withColumn(c, F.when(stray, F.raise_error(what).cast(df.schema[c].dataType)).otherwise(F.col(c)))
        if layout == "folders":
            laid = _by_folder(df, partition_by, list(cluster_by))
        else:
            laid = _layout(df, partition_by, list(cluster_by), None) if layout else df
        writer = laid.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{base}/{folder}")
        written = {k: f"{folder}/{k}" if k else folder for k in self._written(f"{base}/{folder}", len(partition_by))}
        old = self.tables.get(table, {"entries": {}, "commits": {}})
        entries = {} if keys is None else {k: e for k, e in old["entries"].items() if k not in keys}
        for k in set(written) | (keys or set()):
            entries[k] = {"folder": written.get(k), "note": (notes or {}).get(k, {})}
        if keys is not None and not notes:
            entries = {k: e for k, e in entries.items() if e["folder"] or e["note"]}
        used = {e["folder"].split("/", 1)[0] for e in entries.values() if e["folder"]}
        commits = {c: n for c, n in {**old["commits"], folder: len(written)}.items() if c in used}
        # every column may be null in a stored table
        fields = [T.StructField(f.name, f.dataType, True, f.metadata) for f in df.schema.fields]
        if table in self.tables and keys is not None:
            stored = T.StructType.fromJson(self.tables[table]["schema"])
            if [(f.name, f.dataType) for f in stored.fields] != [(f.name, f.dataType) for f in fields]:
                raise ValueError(f"{table} has the columns {stored.simpleString()}, not {T.StructType(fields).simpleString()}")
        self.tables[table] = {"schema": json.loads(T.StructType(fields).json()), "partition_by": partition_by, "entries": entries, "commits": commits}

    def _written(self, folder: str, depth: int) -> list[str]:
        """The partition folders of a write, as paths below it."""
        found = [""]
        for _ in range(depth):
            found = [f"{k}/{p.rsplit('/', 1)[1]}".lstrip("/") for k in found
                     for p in child_paths(self.store.spark, f"{folder}/{k}".rstrip("/")) if "=" in p.rsplit("/", 1)[1]]
        return found

    def drop(self, table: str, keys: Iterable[str]) -> None:
        """Keys that go without new rows."""
        for k in keys:
            self.tables[table]["entries"].pop(k, None)

    def commit(self) -> int:
        """Make the changes the current version; its number."""
        spark, store = self.store.spark, self.store
        version = self.base["version"] + 1
        text = json.dumps({"version": version, "tables": self.tables}, sort_keys=True, indent=0)
        draft = f"{store.path}/versions/_draft-{self.id}"
        write_text(spark, draft, text)
        try:
            if path_exists(spark, store._manifest_path(version)):
                raise Conflict(f"version {version} of {store.path} was committed by another run")
            try:
                rename(spark, draft, store._manifest_path(version))
            except OSError as exc:
                raise Conflict(f"version {version} of {store.path} was committed by another run") from exc
        except Conflict:
            delete(spark, draft)
            raise
        return version
