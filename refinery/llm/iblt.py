"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is the set of its (paragraph, number of occurrences) pairs, each hashed to
64 bits; paragraphs end at line feeds. A sketch adds every element to one cell
in each of three parts of the table; a cell holds a count and the exclusive-or
of its elements and of their checksums. Subtracting the sketches of two versions
cancels what they share. Peeling takes the elements out of cells that hold just
one, which frees others, until all differing elements are known. Where it gets
stuck, sketches four times as large are taken, again and again.

All of it is DataFrame functions on arrays inside a row; nothing shuffles. Cells
are kept sparse and sorted by their number, so a large sketch of a short text is
small.

Defined cases: a null text is empty; an empty text has one empty paragraph, so
two empty texts are alike; equal texts have equal fingerprints, whatever their
ids; documents follow each other by doc_id (null first), those of one id by the
hash of their text, and the last is followed by the first, which may be itself;
all rows of one doc_id stand in one chunk; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARTS = 3
CELLS = 48
GROWTH = 4
RETRIES = 13
ROUNDS = 200
CHUNK_ROWS = 4096
MOST_CHUNKS = 1 << 16

CELL = "struct<cell:bigint,n:bigint,key:bigint,sum:bigint>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _runs(array: Column, same: Callable[[Column, Column], Column], of_run: Callable[[Column, Column], Column]) -> Column:
    """``of_run(first index, length)`` for every run of neighbours that are the ``same``."""
    def marked(starts: Column) -> Column:
        return F.transform(starts, lambda a, j: of_run(a, F.coalesce(F.get(starts, j + 1), F.size(array)) - a))
    begins = F.filter(F.sequence(F.lit(0), F.size(array) - 1),
                      lambda i: (i == 0) | ~same(F.get(array, i), F.get(array, i - 1)))
    return let(begins, marked)


def elements(text: Column) -> Column:
    """The distinct 64-bit elements of a text."""
    digests = F.sort_array(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda p: F.xxhash64(p)))
    return let(digests, lambda d: _runs(d, lambda x, y: x == y, lambda a, n: F.xxhash64(F.get(d, a), n)))


def _rows(element: Column, sign: Column, cells: Column) -> list[Column]:
    """An element's rows: one cell in each part."""
    width = cells / PARTS
    return [F.struct((F.lit(j) * F.floor(width) + F.pmod(F.xxhash64(element, F.lit(j)), F.floor(width))).cast("long").alias("cell"),
                     sign.cast("long").alias("n"), element.alias("key"), F.xxhash64(element, F.lit("sum")).alias("sum"))
            for j in range(PARTS)]


def _added(rows: Column) -> Column:
    """Rows of equal cells added up, by cell; cells that come to nothing left out."""
    zero = F.struct(F.lit(0).cast("long").alias("cell"), F.lit(0).cast("long").alias("n"),
                    F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("sum"))

    def add(acc: Column, row: Column) -> Column:
        return F.struct(row["cell"].alias("cell"), (acc["n"] + row["n"]).alias("n"),
                        acc["key"].bitwiseXOR(row["key"]).alias("key"), acc["sum"].bitwiseXOR(row["sum"]).alias("sum"))

    def of(s: Column) -> Column:
        sums = _runs(s, lambda x, y: x["cell"] == y["cell"], lambda a, n: F.aggregate(F.slice(s, a + 1, n), zero, add))
        return F.when(F.size(s) == 0, F.array().cast(f"array<{CELL}>")).otherwise(
            F.filter(sums, lambda c: (c["n"] != 0) | (c["key"] != 0) | (c["sum"] != 0)))

    return let(F.sort_array(rows), of)


def _spread(found: Column, sign: Callable[[Column], Column], key: Callable[[Column], Column], cells: Column) -> Column:
    return F.flatten(F.transform(found, lambda e: F.array(*_rows(key(e), sign(e), cells))))


def sketch(found: Column, cells: Column) -> Column:
    """The sketch of an array of elements: its non-empty cells."""
    return _added(_spread(found, lambda e: F.lit(1), lambda e: e, cells))


def minus(left: Column, right: Column) -> Column:
    """Left sketch less the right one, of the same number of cells."""
    negated = F.transform(right, lambda c: F.struct(c["cell"].alias("cell"), (-c["n"]).alias("n"), c["key"].alias("key"), c["sum"].alias("sum")))
    return _added(F.concat(left, negated))


def peel(difference: Column, cells: Column) -> Column:
    """(key, sign) of every differing element, or null where peeling gets stuck."""
    none = F.array().cast("array<struct<key:bigint,n:bigint>>")
    start = F.struct(difference.alias("cells"), none.alias("out"), F.lit(False).alias("stuck"))

    def step(state: Column, _: Column) -> Column:
        def out(pure: Column) -> Column:
            left = _added(F.concat(state["cells"], _spread(pure, lambda p: -p["n"], lambda p: p["key"], cells)))
            return F.struct(left.alias("cells"), F.concat(state["out"], pure).alias("out"), (F.size(pure) == 0).alias("stuck"))
        pure = F.array_distinct(F.transform(
            F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (c["sum"] == F.xxhash64(c["key"], F.lit("sum")))),
            lambda c: F.struct(c["key"].alias("key"), c["n"].alias("n"))))
        return F.when(state["stuck"] | (F.size(state["cells"]) == 0), state).otherwise(let(pure, out))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step,
                       lambda s: F.when(F.size(s["cells"]) == 0, s["out"]))


def peel_larger(known: Column, left: Column, right: Column, cells: int = CELLS) -> Column:
    """``known``, or where it is null what peels from sketches ``GROWTH`` times as large, and again."""
    def attempt(found: Column, t: Column) -> Column:
        size = F.lit(cells) * F.pow(F.lit(GROWTH), t).cast("long")
        return F.coalesce(found, peel(minus(sketch(left, size), sketch(right, size)), size))
    return F.aggregate(F.sequence(F.lit(1), F.lit(RETRIES)), known, attempt)


def likeness(left: Column, right: Column, differing: Column) -> Column:
    """1 less the differing elements' share of both texts' elements."""
    return F.lit(1.0) - F.size(differing) / (F.size(left) + F.size(right))


def serialised(cells: Column) -> Column:
    """A sketch as text: cell number, count, elements and checksums in fixed-width hex."""
    def fixed(x: Column, width: int) -> Column:
        return F.right(F.lpad(F.hex(x), F.lit(16), F.lit("0")), F.lit(width))
    return F.concat_ws("", F.transform(cells, lambda c: F.concat(
        fixed(c["cell"], 4), fixed(c["n"], 8), fixed(c["key"], 16), fixed(c["sum"], 16))))


def _chunk_of(doc_id: Column, bounds: list[int]) -> Column:
    """Number of bounds at or below the id, by binary search in a constant array."""
    if not bounds:
        return F.lit(0)
    table = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    steps = [F.lit(1 << s) for s in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(F.array(*steps), F.lit(0), lambda at, by: F.when(
        (at + by <= len(bounds)) & (F.get(table, at + by - 1) <= doc_id), at + by).otherwise(at))


def with_next(docs: DataFrame, columns: list[str], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``docs`` (doc_id and ``columns``, none of them null) with ``next_<column>`` of the following document.

    Documents are dealt by ranges of doc_id into chunks, in which a window looks
    ahead; a chunk's last row gets the first row of the next chunk. Two small
    jobs (row count, quantiles of doc_id) run while this is called.
    """
    n = docs.count()
    chunks = min(MOST_CHUNKS, -(-n // chunk_rows))
    marks = []
    if chunks > 1:
        cuts = docs.agg(F.percentile_approx("doc_id", [i / chunks for i in range(1, chunks)], max(10000, 4 * chunks))).first()[0]
        marks = sorted(set(cuts or []))
    order = ["doc_id", F.xxhash64(*columns)]
    dealt = docs.withColumn("__chunk", F.coalesce(_chunk_of(F.col("doc_id"), marks), F.lit(0)))
    ahead = Window.partitionBy("__chunk").orderBy(*order)
    value = F.struct(*columns)
    heads = dealt.groupBy("__chunk").agg(F.min_by(value, F.struct(F.col("doc_id").isNotNull(), *order)).alias("__head"))
    numbers = dealt.select("__chunk").distinct()
    first = Window.orderBy("__chunk")              # at most MOST_CHUNKS numbers
    follows = numbers.select("__chunk", F.coalesce(
        F.lead("__chunk").over(first), F.first("__chunk").over(first)).alias("__follows"))
    heads = follows.join(heads.withColumnRenamed("__chunk", "__follows"), "__follows").select("__chunk", "__head")
    looked = dealt.withColumn("__next", F.lead(value).over(ahead)).join(heads, "__chunk", "left")
    after = F.coalesce("__next", "__head")
    return looked.select("doc_id", *columns, *[after[c].alias(f"next_{c}") for c in columns])


def fingerprints(docs: DataFrame, cells: int = CELLS) -> DataFrame:
    """Per document: its fingerprint, that of its text edited with the next document's, and likenesses."""
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("elements", elements(F.col("text")))
    pairs = with_next(own, ["text", "elements"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    size = F.lit(cells)
    # one step a select: a value that later steps use more than once is computed once
    texts = pairs.select("doc_id", n.cast("long").alias("n_chars"), "elements", "next_elements", edited.alias("edited"))
    parts = texts.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                         "elements", "next_elements", elements(F.col("edited")).alias("edited_elements"))
    sketches = parts.select("*", sketch(F.col("elements"), size).alias("own"), sketch(F.col("edited_elements"), size).alias("changed"),
                            sketch(F.col("next_elements"), size).alias("following"))
    peeled = sketches.select("*", peel(minus(F.col("own"), F.col("changed")), size).alias("to_edited"),
                             peel(minus(F.col("own"), F.col("following")), size).alias("to_next"))
    whole = peeled.select(
        "*", peel_larger(F.col("to_edited"), F.col("elements"), F.col("edited_elements"), cells).alias("all_edited"),
        peel_larger(F.col("to_next"), F.col("elements"), F.col("next_elements"), cells).alias("all_next"))
    return whole.select(
        "doc_id", "n_chars", "edited_sha256", serialised(F.col("own")).alias("fingerprint"),
        serialised(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("elements"), F.col("edited_elements"), F.col("all_edited")).alias("near_edited"),
        likeness(F.col("elements"), F.col("next_elements"), F.col("all_next")).alias("near_next"))
