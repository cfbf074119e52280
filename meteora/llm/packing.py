"""Best-fit packing of tokenised documents by length-histogram planning.

Documents become pieces of at most ``size`` ids (a longer document is cut;
its first piece takes the remainder).  Only the number of pieces of each
length goes to the driver, at most ``size`` counts.  Best-fit decreasing runs
over those counts: lengths from long to short, each into the fullest open
sequences that still take it, whole groups of equal sequences at a time.  The
plan is a short list of slots (a length, a run of ranks, the first sequence,
an offset), and pieces take their slots by joining on rank within length.

Ranks need no global sort: pieces are dealt into buckets within a length,
numbered inside each bucket, and shifted by the counts of the buckets before.

Null text counts as empty: a document always has at least its end id.
Repeated rows are packed each.  An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meteora.llm import bpe
from meteora.llm.common import release, stored, text_slices

END_ID = 0
#: Rows of one length that are numbered together.
RANK_ROWS = 1 << 20


def pieces(docs: DataFrame, path: str, size: int = 2048, wide: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    slice_bytes, most = bpe.WIDE if wide else (bpe.SLICE_BYTES, bpe.KNOWN_FRAGMENTS)
    docs = docs.select("doc_id", "text")
    schema = docs.select("doc_id").schema.add("piece", "integer").add("start", "long").add("length", "long").add("ids_crc32", "long")

    def run(batches):
        c = bpe.codec(path, most)
        for batch in batches:
            for part, texts in text_slices(batch, "text", slice_bytes):
                ids, counts = c.encode(texts)
                ends = np.cumsum(counts)
                row, no, start, length, crc = [], [], [], [], []
                for i, (a, b) in enumerate(zip((ends - counts).tolist(), ends.tolist(), strict=True)):
                    raw = np.append(ids[a:b], END_ID).astype("<u4").tobytes()
                    n = b - a + 1
                    at, k = 0, 0
                    while at < n:
                        take = (n - 1) % size + 1 if k == 0 else size
                        row.append(i)
                        no.append(k)
                        start.append(at)
                        length.append(take)
                        crc.append(zlib.crc32(raw[4 * at: 4 * (at + take)]))
                        at, k = at + take, k + 1
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row, pa.int64())), pa.array(no, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=schema.names)
        release()

    return docs.mapInArrow(run, schema)


def plan(counts: dict[int, int], size: int = 2048) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first rank, ranks, first sequence, offset) for a histogram of
    lengths: rank r of a length goes to sequence first + (r - first rank)."""
    open_: dict[int, list] = {}  # room left -> groups [number of sequences, ((length, copies), ...)]
    rooms: list[int] = []  # the rooms that have groups, in order

    def put(room: int, number: int, items: tuple) -> None:
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append([number, items])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                number, items = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[i]
            else:
                room, number, items = size, left, ()
            each = room // length
            full = min(number, left // each)
            if full:
                put(room - each * length, full, (*items, (length, each)))
                left -= full * each
            if number > full and left and left < each:  # the last, partly filled one
                put(room - left * length, 1, (*items, (length, left)))
                left, full = 0, full + 1
            if number > full and items:
                put(room, number - full, items)
    slots, rank, sequence = [], dict.fromkeys(counts, 0), 0
    for groups in open_.values():
        for number, items in groups:
            offset = 0
            for length, copies in items:
                for _ in range(copies):
                    slots.append((length, rank[length], number, sequence, offset))
                    rank[length] += number
                    offset += length
            sequence += number
    return slots


def pack(docs: DataFrame, path: str, size: int = 2048, wide: bool = False) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``.

    ``wide``: the larger bounds of ``bpe.WIDE`` for a worker's memory.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, path, size, wide), "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most ``size`` rows
    slots = spark.createDataFrame(plan(counts, size), "length long, first_rank long, ranks long, first_sequence long, offset long")
    buckets = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for n, c in counts.items() for x in (n, -(-c // RANK_ROWS))]),
                                          F.col("length")), F.lit(1)) if counts else F.lit(1)
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), buckets))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("length", "bucket").count().withColumn("base", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("no", F.row_number().over(inside) - 1).join(base, ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("no") + F.col("base")).drop("no", "base", "bucket")
    # the slots come from at most ``size`` counts, whatever the number of documents
    s = F.broadcast(slots)
    placed = ranked.join(s, (ranked["length"] == s["length"]) & (F.col("rank") >= F.col("first_rank"))
                         & (F.col("rank") < F.col("first_rank") + F.col("ranks")))
    return placed.select("doc_id", "piece", "start", ranked["length"], "ids_crc32",
                         (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), "offset")
