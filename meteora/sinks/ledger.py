"""Loading source files exactly once, and again when they change.

The ledger is the manifest of the table itself (``sinks.store``): every source file is a key of
it, noted with its size, time and checksum, so the note and the rows come with the same commit.  A load compares the
files that are there with the ledger: a new file is added, a file whose content changed replaces the rows it gave
before, and a file seen before is not read.  A run that is repeated, or that died before its commit, changes nothing twice.

The checksum of a file is the number of its lines and the sum of their hashes, computed by Spark over all changed
files in one pass; a file that only has a new time keeps its rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteora.schemas import OBS_PARQUET_COLUMNS
from meteora.sinks.store import Store
from meteora.sources.csv import CSV_SUFFIXES, read_observations_csv
from meteora.sources.tables import child_paths

TABLE = "observations"


def file_key(name: str) -> str:
    """The key of a source file: its partition folder."""
    return f"file={hashlib.md5(name.encode()).hexdigest()}"


def source_files(spark: SparkSession, folder: str) -> dict[str, dict]:
    """Each CSV file of a folder by key: its name, paths, size and time.

    A folder named like a file, with part files as a job writes them, is one file.
    """
    hadoop, conf, found = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration(), {}
    for path in child_paths(spark, folder):
        name = path.rsplit("/", 1)[1]
        if not name.endswith(CSV_SUFFIXES) or name.startswith(("_", ".")):
            continue
        p = hadoop(path)
        fs = p.getFileSystem(conf)
        parts = [fs.getFileStatus(p)]
        if parts[0].isDirectory():
            parts = [x for x in fs.listStatus(p) if x.getPath().getName().endswith(CSV_SUFFIXES) and not x.getPath().getName().startswith(("_", "."))]
        found[file_key(name)] = {"name": name, "path": path, "paths": sorted(x.getPath().toString() for x in parts),
                                 "size": sum(x.getLen() for x in parts), "time": max((x.getModificationTime() for x in parts), default=0)}
    return found


def checksums(spark: SparkSession, files: dict[str, dict]) -> dict[str, str]:
    """Lines and sum of line hashes of each file; one row per path comes back."""
    paths = [p for f in files.values() for p in f["paths"]]
    found = {}
    if paths:
        lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.xxhash64("value").cast("decimal(38,0)").alias("h"))
        found = {_same(r["path"]): (r["n"], int(r["h"])) for r in lines.groupBy("path").agg(F.count("*").alias("n"), F.sum("h").alias("h")).collect()}
    sums = {k: [found.get(_same(p), (0, 0)) for p in f["paths"]] for k, f in files.items()}
    return {k: f"{sum(n for n, _ in s)}:{sum(h for _, h in s)}" for k, s in sums.items()}


def _same(path: str) -> str:
    """A path with one slash after its scheme, as listings and rows write it differently."""
    scheme, sep, rest = path.partition(":")
    return f"{scheme}:/{rest.lstrip('/')}" if sep else path


def load(spark: SparkSession, folder: str, target: str, only: list[str] | None = None) -> dict[str, list[str]]:
    """Bring the table ``observations`` of the store ``target`` up to the files of ``folder``.

    ``only`` names the paths to look at (a stream's batch); all files by default.
    Returns the names of the files that were ``added``, ``replaced`` and ``touched`` (same content).
    A file that is gone keeps its rows.
    """
    store = Store(spark, target)
    change = store.begin()
    known = change.keys(TABLE)
    there = source_files(spark, folder)
    if only is not None:
        asked = {_same(p) for p in only}
        there = {k: f for k, f in there.items() if asked & {_same(p) for p in f["paths"]}}
    changed = {k: f for k, f in there.items() if k not in known or (known[k]["size"], known[k]["time"]) != (f["size"], f["time"])}
    sums = checksums(spark, changed)
    notes = {k: {"name": f["name"], "size": f["size"], "time": f["time"], "checksum": sums[k]} for k, f in changed.items()}
    touched = [k for k in changed if k in known and known[k]["checksum"] == notes[k]["checksum"]]
    todo = [k for k in changed if k not in touched]
    result = {"added": sorted(notes[k]["name"] for k in todo if k not in known),
              "replaced": sorted(notes[k]["name"] for k in todo if k in known),
              "touched": sorted(notes[k]["name"] for k in touched)}
    if todo:
        obs = read_observations_csv(spark, [changed[k]["path"] for k in todo], file_column="_path")
        above = len(_same(changed[todo[0]]["path"])) - len(changed[todo[0]]["name"])
        below = F.substring(F.regexp_replace("_path", "^([^:/]+):/+", "$1:/"), above + 1, 1 << 20)
        label = F.substring_index(below, "/", 1)
        rows = obs.select(*OBS_PARQUET_COLUMNS, F.year("date").alias("year"), F.md5(label).alias("file"))
        # a task reads part of one file: it sorts its rows and writes them into that file's folder
        rows = rows.sortWithinPartitions("file", "id", "date")
        change.write(TABLE, rows, ["file"], layout=False, keys=todo, notes={k: notes[k] for k in todo})
    for k in touched:
        change.tables[TABLE]["entries"][k]["note"] = notes[k]
    if todo or touched:
        change.commit()
    return result


def loaded(spark: SparkSession, target: str) -> DataFrame:
    """The loaded observations, with their year."""
    return Store(spark, target).read(TABLE).drop("file")
