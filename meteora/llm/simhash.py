"""SimHash near-duplicates by tiled exact comparison.

Fingerprint: XXH64 (seed 42) of every 4-word shingle of the whole text; a bit
is 1 if it is set in over half of the hashes.  Links join fingerprints that
differ in at most ``radius`` bits.

Rows first fold to distinct fingerprints.  These are dealt into cells by the
population counts of their two halves, and cells into tiles of about
``TILE_ROWS``.  Two fingerprints within the radius have halves whose counts
differ by no more than the radius in sum, so a tile is compared (exclusive-or
and bit count, in numpy) only with tiles of such cells; inside a task,
sub-tiles are skipped in the same way by the counts of their four quarters.  A
task gives a spanning forest of the links it finds, not all pairs, and
``components`` joins the forests.

Rows: null text counts as empty; a text without words has fingerprint zero.
Rows without an id are given a fingerprint and the component of that
fingerprint (null if no row with an id has it).  Repeated rows stay repeated.
An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meteora.llm.common import stored, with_text_columns
from meteora.llm.components import components

TILE_ROWS = 16384
SUB_ROWS = 512


def fingerprint(text: str, shingle: int = 4) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII white space, ASCII case
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    lens = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lens + 1) - 1
    starts = ends - lens
    if n <= shingle:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: n - shingle + 1], ends[shingle - 1:]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 65536):
        bits = np.unpackbits(h[at: at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``docs`` with the fingerprint as a signed long in ``simhash``."""
    def make():
        def f(texts):
            out = np.fromiter((fingerprint(t, shingle) for t in texts.to_pylist()), np.uint64, len(texts))
            return [out.view(np.int64)]
        return f
    return with_text_columns(docs, [("simhash", "bigint")], make)


def _popcounts(fp: np.ndarray, parts: int) -> np.ndarray:
    """Population counts of the ``parts`` equal parts, one row per fingerprint."""
    return np.bitwise_count(fp.astype("<u8").view(f"<u{8 // parts}").reshape(-1, parts)).astype(np.int16)


def _neighbours(cell: int, radius: int) -> list[int]:
    """Cells whose half counts differ by no more than the radius in sum."""
    a, b = divmod(cell, 64)
    return [x * 64 + y for x in range(max(0, a - radius), min(32, a + radius) + 1)
            for y in range(max(0, b - radius + abs(a - x)), min(32, b + radius - abs(a - x)) + 1)]


class _Forest:
    """Union-find over positions, fed with blocks of pairs."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        r = self.up[x]
        while (self.up[r] != r).any():
            r = self.up[r]
        return r

    def link(self, x: np.ndarray, y: np.ndarray) -> None:
        while len(x):
            x, y = self.roots(x), self.roots(y)
            differ = x != y
            x, y = x[differ], y[differ]
            np.minimum.at(self.up, np.maximum(x, y), np.minimum(x, y))


def _sub_tiles(fp: np.ndarray) -> tuple[np.ndarray, list]:
    """An order by quarter counts, and (from, to, lows, highs) of each sub-tile."""
    q = _popcounts(fp, 4)
    order = np.lexsort(q.T[::-1])
    q = q[order]
    return order, [(at, min(at + SUB_ROWS, len(fp)), q[at: at + SUB_ROWS].min(0), q[at: at + SUB_ROWS].max(0))
                   for at in range(0, len(fp), SUB_ROWS)]


def links_within(home: np.ndarray, other: np.ndarray, radius: int, inside: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links from ``home`` to ``other`` and, if
    ``inside``, among ``home``, as positions in the two arrays laid end to end."""
    fp = np.concatenate([home, other])
    n, forest = len(home), _Forest(len(fp))
    order, tiles = _sub_tiles(home)
    order2, tiles2 = _sub_tiles(other) if len(other) else (np.zeros(0, np.int64), [])
    sides = ([(order, tiles, True)] if inside else []) + [(order2 + n, tiles2, False)]
    for i, (a0, a1, alo, ahi) in enumerate(tiles):
        left = order[a0:a1]
        for places, there, same in sides:
            for b0, b1, blo, bhi in there[i:] if same else there:
                if np.maximum(0, np.maximum(alo - bhi, blo - ahi)).sum() > radius:
                    continue
                right = places[b0:b1]
                x, y = np.nonzero(np.bitwise_count(fp[left][:, None] ^ fp[right][None, :]) <= radius)
                if len(x):
                    forest.link(left[x], right[y])
    at = np.arange(len(fp))
    up = forest.roots(at)
    moved = up != at
    return at[moved], up[moved]


def links(nodes: DataFrame, radius: int = 4) -> DataFrame:
    """Links (u, v) that connect just the nodes (node, simhash) that chains of
    fingerprints within the radius connect; fingerprints must be distinct."""
    half = lambda shift: F.bit_count(F.shiftrightunsigned("simhash", shift).bitwiseAND(F.lit(0xFFFFFFFF)))
    # the low half first, as _popcounts gives it
    celled = nodes.select("node", "simhash", (half(0) * 64 + half(32)).cast("int").alias("cell"))
    counts = {r["cell"]: r["count"] for r in celled.groupBy("cell").count().collect()}  # at most 33 x 33 rows
    tiles = {c: -(-n // TILE_ROWS) for c, n in counts.items()}
    per_cell = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in tiles.items() for x in kv]), F.col("cell")), F.lit(1)) \
        if tiles else F.lit(1)
    dealt = celled.withColumn("tile", F.pmod(F.xxhash64("simhash"), per_cell).cast("int"))

    def pack(key, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"cell": [key[0]], "tile": [key[1]], "fps": [pdf["simhash"].to_numpy(np.int64).tobytes()],
                             "nodes": [pdf["node"].to_numpy(np.int64).tobytes()]})

    packed = dealt.groupBy("cell", "tile").applyInPandas(pack, "cell int, tile int, fps binary, nodes binary")

    def deal(batches):
        # every pair of tiles meets once: at (home cell, home tile, number of the other tile)
        for pdf in batches:
            for cell, tile, fps, ids in pdf.itertuples(index=False):
                near = [c for c in _neighbours(cell, radius) if c in tiles]
                most = max(tiles[c] for c in near if c >= cell)
                keys = [(cell, tile, j, True) for j in range(most)]
                keys += [(c, i, tile, False) for c in near if c <= cell for i in range(tiles[c]) if c < cell or i < tile]
                yield pd.DataFrame([(*k, fps, ids) for k in keys], columns=["cell", "tile", "other", "home", "fps", "nodes"])

    met = packed.mapInPandas(deal, "cell int, tile int, other int, home boolean, fps binary, nodes binary")

    def compare(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("home", ascending=False, kind="stable")
        join = lambda col, t, rows: np.concatenate([np.frombuffer(x, t) for x in rows[col]] or [np.zeros(0, t)])
        home, rest = pdf[pdf["home"]], pdf[~pdf["home"]]
        ids = np.concatenate([join("nodes", np.int64, home), join("nodes", np.int64, rest)])
        u, v = links_within(join("fps", np.uint64, home), join("fps", np.uint64, rest), radius,
                            inside=key[2] == 0)
        return pd.DataFrame({"u": ids[u], "v": ids[v]})

    return met.groupBy("cell", "tile", "other").applyInPandas(compare, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row."""
    prints = stored(with_fingerprint(docs.select("doc_id", "text"), shingle).drop("text"), "simhash")
    classes = prints.groupBy("simhash").agg(F.min("doc_id").alias("node")).where("node is not null")
    classes = stored(classes, "simhash-classes")
    joined = components(links(classes, radius))
    labels = classes.join(joined, "node", "left").select("simhash", F.coalesce("component", "node").alias("component_id"))
    return prints.join(labels, "simhash", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``docs`` without all but one of each near-duplicate group.

    The row with the smallest id of a group stays (of rows with that id, the first by
    text hash, then by a hash of the whole row); rows without an id stay.  Rows that share
    an id are one group only if their texts are near duplicates.
    """
    own = F.xxhash64("text")
    prints = with_fingerprint(docs.where("doc_id is not null").select("doc_id", "text"), shingle)
    prints = stored(prints.select("doc_id", own.alias("text_hash"), "simhash"), "simhash-rows")
    # the fingerprint is its own node: an id can stand for several
    classes = stored(prints.select("simhash").distinct().withColumn("node", F.col("simhash")), "simhash-classes")
    joined = components(links(classes, radius)).withColumnRenamed("node", "simhash")
    labelled = prints.join(joined, "simhash", "left").withColumn("component", F.coalesce("component", "simhash"))
    firsts = labelled.groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("f")).select(
        F.col("f.doc_id").alias("__id"), F.col("f.text_hash").alias("__text")).distinct()
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col("doc_id").alias("__id"), own.alias("__text"))
    kept = packed.join(firsts, ["__id", "__text"], "left_semi")
    order = Window.partitionBy("__id", "__text").orderBy(F.xxhash64("__row"))
    kept = kept.withColumn("__no", F.row_number().over(order)).where("__no = 1")
    with_id = kept.select(*[F.col(f"__row.`{c}`").alias(c) for c in docs.columns])
    return with_id.unionByName(docs.where("doc_id is null"))
