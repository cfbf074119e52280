"""Document fingerprints as invertible Bloom lookup sketches, in DataFrame operations.

A text is a set of digests of its paragraphs.  A paragraph is cut into blocks, at the
end of a sentence or after ``BLOCK_WORDS`` words, because many texts are one
single paragraph.  A digest is 48 bits of hash with 16 bits of check sum over them.  It is
put into three cells of a sketch, one in each third; a cell holds the number of its
digests and their exclusive-or.

Sketches of two versions subtract cell by cell, which leaves what they do not share.
Peeling takes the cells with one digest left, notes whose it is, and takes the digest
out of its two other cells, until all cells are empty.  Two versions are compared by as
many sketches as their numbers of digests ask for, each for one part of the hash
space.  One wide grouped aggregate makes the differences, of sketches of two sizes for each part;
where the smaller one does not peel, the one twice as large is peeled.  If that fails too (few parts in a
thousand), the row's digest sets are compared outright.  Likeness is the Jaccard index, from the
recovered differences and the sizes of the sets.

The fingerprint is the number of digests and one sketch of ``CELLS`` cells as hex; equal texts have equal ones.

The edited text of a row needs the next one by id.  Rows are dealt into ranges of (id, hash of the text),
whose bounds come from a sample of bounded size, and the first rows of a range are dealt to the range before
too; so each range finds its next rows alone, and rows of one id, or of none, share the ranges like others.

Null text counts as empty.  A text without a word has no digests; two such texts have
likeness 1, one such and another 0.  A null id comes before all others; rows of one id
follow each other in the order of a hash of their text.  A single row is its own next one.
An empty table gives an empty result.  Ids are whole numbers, or text in the order of its
characters.  Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_WORDS = 8
CELLS = 24
LARGER = 48
#: Digests of two sets together that one sketch is meant for.
LOAD = 10
#: Bytes of text in one range of ids, about.
RANGE_BYTES = 2 << 20
MAX_RANGES = 1 << 14
#: Rows of the sample that the bounds of the ranges come from, for each range.
SAMPLED = 32

_BLOCK = rf"(?:\S*[^\s.!?][^\S\n]+){{0,{BLOCK_WORDS - 1}}}\S+"


def _marked(h: Column) -> Column:
    """A hash with its lowest 16 bits replaced by a check sum of the others."""
    high = h.bitwiseAND(F.lit(-(1 << 16)))
    return high.bitwiseOR(F.xxhash64(high).bitwiseAND(F.lit(0xFFFF)))


def digests(text: Column) -> Column:
    """The distinct digests of a text's blocks."""
    blocks = F.regexp_extract_all(text, F.lit(_BLOCK), F.lit(0))
    return F.array_distinct(F.transform(blocks, lambda b: _marked(F.xxhash64(b))))


def _places(digest: Column, cells: int = CELLS) -> list[Column]:
    """The three cells of a digest, one in each third."""
    third = cells // 3
    return [F.pmod(F.shiftrightunsigned(F.xxhash64(digest, F.lit(cells)), 20 * i), F.lit(third)).cast("int") + third * i
            for i in range(3)]


def fingerprint(found: Column) -> Column:
    """A set of digests as its size and its sketch: number and exclusive-or of each cell, as hex."""
    rows = F.transform(found, lambda d: F.struct(d.alias("d"), F.array(*_places(d)).alias("p")))

    def cell(rows, c):
        own = F.filter(rows, lambda r: F.get(r["p"], F.lit(c // (CELLS // 3))) == c)
        return F.concat(F.hex(F.size(own)), F.lit(":"), F.hex(F.aggregate(own, F.lit(0).cast("long"), lambda x, r: x.bitwiseXOR(r["d"]))))

    # the rows are worked out once: a one-element array binds them to a name
    sketch = F.get(F.transform(F.array(rows), lambda r: F.concat_ws(",", *[cell(r, c) for c in range(CELLS)])), F.lit(0))
    return F.concat(F.size(found).cast("string"), F.lit(";"), sketch)


def _order_id(rows: DataFrame) -> Column:
    """The id as a value that is never null: whole numbers, else text; no id comes first."""
    if dict(rows.dtypes)["doc_id"] in ("tinyint", "smallint", "int", "bigint"):
        return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    return F.coalesce(F.concat(F.lit("i"), F.col("doc_id").cast("string")), F.lit(""))


def _cuts(rows: DataFrame, ranges: int, total: int) -> list[tuple]:
    """(id, hash) of rows that cut all rows into about equal ranges, from a sample chosen by hash."""
    if ranges < 2:
        return []
    share = min(1.0, SAMPLED * ranges / total)
    # about SAMPLED rows for a range come back, whatever the number of rows
    some = rows.where(F.shiftrightunsigned(F.xxhash64(F.lit(11), "__id", "__h"), 1) <= min(int(share * (1 << 63)), (1 << 63) - 1))
    keys = [tuple(r) for r in some.select("__id", "__h").orderBy("__id", "__h").collect()]
    return [keys[len(keys) * i // ranges] for i in range(1, ranges)] if keys else []


def with_next(docs: DataFrame) -> DataFrame:
    """__range, __no (unique together), doc_id, text and its digests ``a``, and those of
    the next row by id (after the last the first): next_text, next_a."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({"a": digests(F.col("text")), "__id": _order_id(rows), "__h": F.xxhash64("text")})
    sizes = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n"), F.min(F.struct("__id", "__h")).alias("low")).first()
    if sizes["low"] is None:
        return rows.select(F.lit(0).alias("__range"), F.lit(0).alias("__no"), "doc_id", "text", "a",
                           F.col("text").alias("next_text"), F.col("a").alias("next_a"))
    n = max(1, min(MAX_RANGES, (sizes["bytes"] or 0) // RANGE_BYTES))
    # bounds are keys of rows, so that a range begins with its bound
    bounds = sorted({tuple(sizes["low"]), *_cuts(rows, n, sizes["n"])})
    steps = [1 << b for b in range(len(bounds).bit_length() - 1, -1, -1)]
    ids, hashes = F.lit([i for i, _ in bounds]), F.lit([h for _, h in bounds])

    def reached(at):
        """Whether the bound at that place is not above the row."""
        return (F.get(ids, at) < F.col("__id")) | ((F.get(ids, at) == F.col("__id")) & (F.get(hashes, at) <= F.col("__h")))

    # binary search for the last bound that is reached
    last = F.aggregate(F.lit(steps), F.lit(0), lambda at, s: F.when(F.coalesce(reached(at + s), F.lit(False)), at + s).otherwise(at))
    rows = rows.withColumn("__range", last)
    first = (F.get(ids, F.col("__range")) == F.col("__id")) & (F.get(hashes, F.col("__range")) == F.col("__h"))
    before = F.pmod(F.col("__range") - 1, F.lit(len(bounds)))
    own = F.struct(F.col("__range").alias("r"), F.lit(0).alias("copy"))
    copy = F.struct(before.alias("r"), F.lit(1).alias("copy"))
    dealt = rows.withColumn("__at", F.explode(F.when(first, F.array(own, copy)).otherwise(F.array(own))))
    # the range is a plain column: all groupings below begin with it and need no further shuffle;
    # the filter stands here because the join would add it to one side only, and make two shuffles of one
    dealt = dealt.where("__at.r is not null").select(F.col("__at.r").alias("__range"), F.col("__at.copy").alias("__copy"), "__id", "__h", "doc_id", "text", "a")
    order = Window.partitionBy("__range").orderBy("__copy", "__id", "__h", "text")
    dealt = dealt.withColumns({"next_text": F.lead("text").over(order), "next_a": F.lead("a").over(order), "__no": F.row_number().over(order)})
    return dealt.where("__copy = 0").select("__range", "__no", "doc_id", "text", "a", "next_text", "next_a")


def edited(text: Column, next_text: Column) -> Column:
    """``text`` with its last quarter (floor) replaced by as much of the next text's beginning."""
    n = F.length(text)
    k = F.floor(n / 4).cast("int")
    return F.concat(F.left(text, n - k), F.left(next_text, k))


def _peel(cells: Column, size: int) -> Column:
    """(a, b, left) of a difference of sketches, an array of (n, x) in cell order: digests
    only in the first and only in the second, and the number of cells that stay."""
    def go(state, _):
        pure = F.array_distinct(F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (c["x"] == _marked(c["x"]))))
        places = F.transform(pure, lambda c: F.struct(c["n"].alias("n"), c["x"].alias("x"), F.array(*_places(c["x"], size)).alias("p")))

        def after(taken):
            def without(c, i):
                # a cell lies in one third, and so meets one place of each digest
                own = F.filter(taken, lambda r: F.get(r["p"], F.floor(i / (size // 3)).cast("int")) == i)
                return F.aggregate(own, c, lambda acc, r: F.struct((acc["n"] - r["n"]).alias("n"), acc["x"].bitwiseXOR(r["x"]).alias("x")))

            def emptied(every):
                return F.transform(state["cells"], lambda c, i: F.when(F.array_contains(every, i), without(c, i)).otherwise(c))

            firsts = F.size(F.filter(taken, lambda r: r["n"] == 1))
            return F.when(F.size(taken) == 0, F.struct(state["a"].alias("a"), state["b"].alias("b"), state["cells"].alias("cells"),
                                                       F.lit(False).alias("open"))).otherwise(
                F.struct((state["a"] + firsts).alias("a"), (state["b"] + F.size(taken) - firsts).alias("b"),
                         F.transform(state["cells"], without).alias("cells"),
                         F.lit(True).alias("open")))

        return F.when(state["open"], F.get(F.transform(F.array(places), after), F.lit(0))).otherwise(state)

    start = F.struct(F.lit(0).alias("a"), F.lit(0).alias("b"), cells.alias("cells"), F.lit(True).alias("open"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(12)), start, go, lambda end: F.struct(
        end["a"].alias("a"), end["b"].alias("b"),
        F.size(F.filter(end["cells"], lambda c: (c["n"] != 0) | (c["x"] != 0))).alias("left")))


def differences(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """For rows with digest sets ``a`` and ``b``: keys, only_a, only_b, failed (no row if
    nothing differs)."""
    side = lambda name, sign: F.transform(name, lambda d: F.struct(d.alias("d"), F.lit(sign).cast("long").alias("n")))
    parts = F.ceil((F.size("a") + F.size("b")) / F.lit(LOAD)).cast("long")
    rows = pairs.select(*keys, parts.alias("__parts"), F.explode(F.concat(side("a", 1), side("b", -1))).alias("e"))
    rows = rows.select(*keys, F.pmod(F.xxhash64("e.d", F.lit(5)), F.col("__parts")).alias("__part"), F.col("e.d").alias("d"), F.col("e.n").alias("n"))
    rows = rows.select("*", *[p.alias(f"p{size}_{i}") for size in (CELLS, LARGER) for i, p in enumerate(_places(F.col("d"), size))])
    # Subtraction: what both have cancels in the sums and in the exclusive-ors.  The numbers
    # of eight cells share a long, 7 bits each; a part holds about LOAD digests.
    sums = []
    for size in (CELLS, LARGER):
        for c in range(size):
            place = f"p{size}_{c // (size // 3)}"
            sums.append(F.expr(f"bit_xor(if({place} = {c}, d, 0L))").alias(f"x{size}_{c}"))
            if c % 8 == 0:
                sums.append(F.expr(f"sum(if({place} div 8 = {c // 8}, shiftleft(n, 7 * ({place} % 8)), 0L))").alias(f"n{size}_{c // 8}"))
    sketches = rows.groupBy(*keys, "__part").agg(*sums)
    bias = sum(64 << (7 * i) for i in range(8))
    number = lambda size, c: (F.shiftright(F.col(f"n{size}_{c // 8}") + F.lit(bias), 7 * (c % 8)).bitwiseAND(F.lit(127)) - 64).cast("int")
    cells = lambda size: F.array(*[F.struct(number(size, c).alias("n"), F.col(f"x{size}_{c}").alias("x")) for c in range(size)])
    first = _peel(cells(CELLS), CELLS)
    again = F.get(F.transform(F.array(first), lambda p: F.when(p["left"] == 0, p).otherwise(_peel(cells(LARGER), LARGER))), F.lit(0))
    done = sketches.select(*keys, again.alias("p"))
    return done.groupBy(*keys).agg(F.sum("p.a").alias("only_a"), F.sum("p.b").alias("only_b"), F.max(F.col("p.left") > 0).alias("failed"))


def _likeness(size_a: Column, size_b: Column, only_a: Column, only_b: Column) -> Column:
    common = size_a - F.coalesce(only_a, F.lit(0))
    union = common + F.coalesce(only_a, F.lit(0)) + F.coalesce(only_b, F.lit(0))
    return F.when(union == 0, F.lit(1.0)).otherwise(common / union)


def _outright(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def compare_versions(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next
    of every row."""
    rows = with_next(docs)
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("next_text"))).withColumn("b", digests(F.col("edited")))
    # doc_id is a key so that both sides of the join read the same columns, from one shuffle
    keys = ["__range", "__no", "doc_id", "__pair"]
    pairs = rows.select("__range", "__no", "doc_id", F.explode(F.array(
        F.struct(F.lit(0).alias("p"), F.col("a"), F.col("b")), F.struct(F.lit(1).alias("p"), F.col("a"), F.col("next_a").alias("b")))).alias("s"))
    found = differences(pairs.select("__range", "__no", "doc_id", F.col("s.p").alias("__pair"), "s.a", "s.b"), keys)
    wide = found.groupBy("__range", "__no", "doc_id").agg(*[
        F.max(F.when(F.col("__pair") == p, F.col(c))).alias(f"{c}_{p}") for p in (0, 1) for c in ("only_a", "only_b", "failed")])
    own = rows.select("__range", "__no", "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                      fingerprint(F.col("a")).alias("fingerprint"), fingerprint(F.col("b")).alias("edited_fingerprint"),
                      F.size("a").alias("__a"), F.size("b").alias("__b0"), F.size("next_a").alias("__b1"),
                      _outright(F.col("a"), F.col("b")).alias("__out0"), _outright(F.col("a"), F.col("next_a")).alias("__out1"))
    both = own.join(wide.drop("doc_id"), ["__range", "__no"], "left")
    near = lambda p: F.when(F.col(f"failed_{p}"), F.col(f"__out{p}")).otherwise(
        _likeness(F.col("__a"), F.col(f"__b{p}"), F.col(f"only_a_{p}"), F.col(f"only_b_{p}")))
    return both.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       near(0).alias("near_edited"), near(1).alias("near_next"))
