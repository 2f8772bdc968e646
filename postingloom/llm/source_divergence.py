"""How the sources of a language differ in their terms: exact sums over a quadtree of the group-term count matrix.

A language has a matrix of counts, a row per source and a column per kept term. A K-squared tree halves it (K ways on
each side) down to leaves of ``LEAF_ROWS`` x ``LEAF_COLS`` cells and keeps only quadrants with a count in them. Pairs of
sources walk down the tree together, a pair of row quadrants at a time: where both quadrants are all zero, every term
in them has the same price, which is multiplied by the width; where one is not, the walk goes on to its leaves,
whose cells are compared.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postingloom.llm.common import placed_in_order, shipped, stored, text_or_empty

#: Quadrants of a node on each side, and cells of a leaf on its two sides.
K, LEAF_ROWS, LEAF_COLS = 4, 4, 256
#: Shares are whole numbers of this unit.
UNIT = 1_000_000_000
#: Rows between two looks at how much is held, and how many counts may be held.
CHUNK, HELD = 200, 200_000

#: ASCII letters and every byte of a longer character; in UTF-8 the same runs as [^\x00-\x40\x5B-\x60\x7B-\x7F]+.
_TERM = re.compile(rb"[a-z\x80-\xff]+")


# ---- counts ---------------------------------------------------------------

_COUNTS = pa.schema([
    ("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())
])


def _partial_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and documents by group and term, as far as they fit; a row without a term says that a group exists."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def emitted() -> pa.RecordBatch:
        columns: list[list] = [[], [], [], [], []]
        for (lang, source), (counts, docs) in held.items():
            terms = [term.decode() for term in counts]
            for column, more in zip(
                columns,
                ([lang] * (len(terms) + 1), [source] * (len(terms) + 1), [None, *terms], [0, *counts.values()], [0, *map(docs.get, counts)]),
                strict=True,
            ):
                column += more
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _COUNTS, strict=True)], schema=_COUNTS)

    for batch in batches:
        for start in range(0, batch.num_rows, CHUNK):
            part = batch.slice(start, CHUNK)
            for lang, source, text in zip(*(part.column(name) for name in ("lang", "source", "text")), strict=True):
                counts, docs = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
                found = _TERM.findall(text.as_py().lower())  # bytes: lowers A-Z only
                counts.update(found)
                docs.update(set(found))
            if sum(len(counts) for counts, _ in held.values()) > HELD:
                yield emitted()
    if held:
        yield emitted()


def term_counts(documents: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group; a row without a term for each group."""
    read = documents.select(
        text_or_empty(F.col(lang).cast("string")).alias("lang"),
        text_or_empty(F.col(source).cast("string")).alias("source"),
        text_or_empty(text).cast("binary").alias("text"),
    )
    counted = read.mapInArrow(_partial_counts, "lang string, source string, term string, n bigint, docs bigint")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: str, of: str, v: str) -> Column:
    """1 + floor(UNIT * (n + 2) / (of + 2 v)), in whole numbers throughout."""
    return F.expr(f"1 + (CAST({n} + 2 AS DECIMAL(27,0)) * CAST({UNIT} AS DECIMAL(10,0))) DIV CAST({of} + 2 * {v} AS DECIMAL(27,0))")


def price(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)); shares stay below 2^30, so the square fits."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) DIV ({p} + {q})")


# ---- the matrix -----------------------------------------------------------

def matrix(counts: DataFrame, least_docs: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Groups (lang, source, row, n, v, s, p0), kept terms (lang, term, col, total, lang_n, v) and cells (lang, source, row, term, col, n, p).

    Terms in at least ``least_docs`` documents of a language are kept, the most frequent ones first. v counts the kept terms of the language
    and s its sources; p0 is the share of a term that the group lacks (null if v is 0)."""
    terms = (
        counts.where("term IS NOT NULL")
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= least_docs)
        .withColumn("rarity", -F.col("docs"))
    )
    placed = placed_in_order(terms, "lang", ["rarity", "term"], "divergence-terms")
    kept = stored(placed.select("lang", "term", F.col("place").alias("col"), "total", F.col("n").alias("v")), "divergence-kept")
    per_lang = kept.groupBy("lang").agg(F.sum("total").alias("lang_n"), F.count("*").alias("v"))
    held = stored(
        counts.where("term IS NOT NULL").select("lang", "source", "term", "n").join(kept.select("lang", "term", "col"), ["lang", "term"]),
        "divergence-held",
    )
    sizes = held.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    within = Window.partitionBy("lang")
    groups = stored(
        counts.where("term IS NULL")
        .select("lang", "source")
        .join(sizes, ["lang", "source"], "left")
        .join(per_lang.select("lang", "v"), "lang", "left")
        .select(
            "lang",
            "source",
            (F.row_number().over(within.orderBy("source")) - 1).cast("long").alias("row"),
            F.coalesce("size", F.lit(0).cast("long")).alias("n"),
            F.coalesce("v", F.lit(0).cast("long")).alias("v"),
            F.count("*").over(within).alias("s"),
        )
        .withColumn("p0", F.when(F.col("v") > 0, share("0", "n", "v"))),
        "divergence-groups",
    )
    of = groups.select("lang", "source", "row", F.col("n").alias("size"), "v")
    cells = stored(
        held.join(of, ["lang", "source"]).select("lang", "source", "row", "term", "col", "n", share("n", "size", "v").alias("p")),
        "divergence-cells",
    )
    return groups, kept.drop("v").join(per_lang, "lang"), cells


def n_levels(groups: DataFrame) -> int:
    """Levels above the leaves that the largest matrix needs."""
    s, v = groups.agg(F.coalesce(F.max("s"), F.lit(0)), F.coalesce(F.max("v"), F.lit(0))).first()
    side, levels = max(-(-s // LEAF_ROWS), -(-v // LEAF_COLS)), 0
    while K**levels < side:
        levels += 1
    return levels


def quadrants(cells: DataFrame, levels: int) -> DataFrame:
    """(lang, level, r, c) of every quadrant with a count in it, on all levels; level 0 has the leaves."""
    leaves = cells.select(
        "lang", F.floor(F.col("row") / LEAF_ROWS).alias("r"), F.floor(F.col("col") / LEAF_COLS).alias("c")
    ).distinct()
    steps = F.explode(F.array(*(
        F.struct(F.lit(k).alias("level"), F.floor(F.col("r") / K**k).alias("r"), F.floor(F.col("c") / K**k).alias("c"))
        for k in range(levels + 1)
    )))
    return leaves.select("lang", steps.alias("node")).select("lang", "node.*").distinct()


def walk(groups: DataFrame, tree: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of quadrants that end a walk: (lang, a, b, level, width) of all-zero pairs, (lang, a, b, c, width) of pairs of leaves.

    a <= b are row quadrants of the level and c a column quadrant; width counts the kept terms in it. A step replaces a pair that has
    counts by the pairs of its children."""
    shape = groups.where("v > 0").select("lang", "s", "v").distinct()
    pairs = shape.select("lang", "s", "v", *(F.lit(0).cast("long").alias(name) for name in ("a", "b", "c")))
    walked = []
    for level in range(levels, -1, -1):
        rows, cols = LEAF_ROWS * K**level, LEAF_COLS * K**level
        if level < levels:
            for name in ("a", "b", "c"):
                pairs = pairs.withColumn(name, F.explode(F.sequence(F.col(name) * K, F.col(name) * K + (K - 1))))
            pairs = pairs.where((F.col("a") <= F.col("b")) & (F.col("b") * rows < F.col("s")) & (F.col("c") * cols < F.col("v")))
        here = tree.where(F.col("level") == level).select("lang", "r", "c", F.lit(True).alias("found"))
        for name in ("a", "b"):
            pairs = pairs.join(here.withColumnsRenamed({"r": name, "found": f"in_{name}"}), ["lang", name, "c"], "left")
        width = (F.least((F.col("c") + 1) * cols, F.col("v")) - F.col("c") * cols).alias("width")
        zero = F.col("in_a").isNull() & F.col("in_b").isNull()
        step = stored(pairs.select("lang", "s", "v", "a", "b", "c", width, zero.alias("zero")), f"divergence-walk-{level}")
        walked.append(step.where("zero").select("lang", "s", "a", "b", F.lit(rows).alias("rows"), "width"))
        pairs = step.where("NOT zero").select("lang", "s", "v", "a", "b", "c", "width")
    zeros = walked[0]
    for more in walked[1:]:
        zeros = zeros.unionByName(more)
    return zeros, pairs


# ---- sums over pairs ------------------------------------------------------

def leaf_sums(
    a: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], width: int
) -> np.ndarray:
    """Prices of all pairs of rows of two leaves, summed over the columns of the leaf.

    A leaf is given by row, column and share of its cells, and the share of a missing term by row. Columns that neither leaf has
    cost the same each and are multiplied."""
    columns = np.union1d(a[1], b[1])
    filled = []
    for rows, cols, shares, missing in (a, b):
        dense = np.repeat(missing[:, None], len(columns), axis=1)
        dense[rows % LEAF_ROWS, np.searchsorted(columns, cols)] = shares
        filled.append(dense)
    left, right = filled[0][:, None, :], filled[1][None, :, :]
    apart = left - right
    known = (apart * apart // (left + right)).sum(axis=2)
    left, right = a[3][:, None], b[3][None, :]
    return known + (width - len(columns)) * ((left - right) ** 2 // (left + right))


def leaf_prices(*columns: str) -> Column:
    """Sums by row of a and row of b in turn, as array<bigint>.

    Columns: row, col, p and the missing term's share by row, of a and of b, and the width. A null leaf has no cells."""

    @F.arrow_udf("array<bigint>")
    def prices(
        a_row: pa.Array, a_col: pa.Array, a_p: pa.Array, a_missing: pa.Array,
        b_row: pa.Array, b_col: pa.Array, b_p: pa.Array, b_missing: pa.Array, width: pa.Array,
    ) -> pa.Array:
        def numbers(column: pa.Array, k: int) -> np.ndarray:
            return np.asarray(column[k].values if column[k].is_valid else [], np.int64)

        found = []
        for k in range(len(width)):
            a, b = (tuple(numbers(c, k) for c in side) for side in ((a_row, a_col, a_p, a_missing), (b_row, b_col, b_p, b_missing)))
            found.append(leaf_sums(a, b, width[k].as_py()).ravel())
        return pa.array(found, pa.list_(pa.int64()))

    return prices(*columns)


def _leaves(cells: DataFrame) -> DataFrame:
    """The cells of each leaf, at most LEAF_ROWS x LEAF_COLS of them, as three arrays in one order."""
    packed = cells.groupBy(
        "lang", F.floor(F.col("row") / LEAF_ROWS).alias("r"), F.floor(F.col("col") / LEAF_COLS).alias("c")
    ).agg(F.collect_list(F.struct("row", "col", "p")).alias("cells"))
    return packed.select("lang", "r", "c", "cells.row", "cells.col", "cells.p")


def pair_sums(groups: DataFrame, cells: DataFrame) -> DataFrame:
    """(lang, a, b, value) of every pair of rows a < b of a language that has kept terms."""
    levels = n_levels(groups)
    tree = stored(quadrants(cells, levels), "divergence-tree")
    zeros, pairs = walk(groups, tree, levels)
    a_rows, b_rows = (
        F.sequence(F.col(name) * F.col("rows"), F.least((F.col(name) + 1) * F.col("rows"), F.col("s")) - 1) for name in ("a", "b")
    )
    widths = (
        zeros.groupBy("lang", "s", "a", "b", "rows")
        .agg(F.sum("width").alias("width"))
        .select("lang", "width", "s", "b", "rows", F.explode(a_rows).alias("i"))
        .select("lang", "width", "i", F.explode(b_rows).alias("j"))
        .where("i < j")
        .groupBy("lang", "i", "j")
        .agg(F.sum("width").alias("width"))
    )
    share_of = groups.select("lang", "row", "p0")
    uniform = (
        widths.join(share_of.withColumnsRenamed({"row": "i", "p0": "p"}), ["lang", "i"])
        .join(share_of.withColumnsRenamed({"row": "j", "p0": "q"}), ["lang", "j"])
        .select("lang", "i", "j", (F.col("width") * price("p", "q")).alias("value"))
    )
    leaves = stored(_leaves(cells), "divergence-leaves")
    missing = (
        groups.groupBy("lang", F.floor(F.col("row") / LEAF_ROWS).alias("r"))
        .agg(F.array_sort(F.collect_list(F.struct("row", "p0"))).alias("of"))
        .select("lang", "r", F.col("of.p0").alias("missing"))
    )
    met = pairs
    for name in ("a", "b"):
        own = {column: f"{name}_{column}" for column in ("row", "col", "p", "missing")}
        met = met.join(leaves.withColumnsRenamed({"r": name, **own}), ["lang", name, "c"], "left")
        met = met.join(missing.withColumnsRenamed({"r": name, **own}), ["lang", name])
    sides = [f"{name}_{column}" for name in ("a", "b") for column in ("row", "col", "p", "missing")]
    b_size = F.size("b_missing")
    priced = met.select("lang", "a", "b", b_size.alias("b_size"), leaf_prices(*sides, "width").alias("sums"))
    compared = priced.select("lang", "a", "b", "b_size", F.posexplode("sums").alias("at", "value")).select(
        "lang",
        (F.col("a") * LEAF_ROWS + F.floor(F.col("at") / F.col("b_size"))).alias("i"),
        (F.col("b") * LEAF_ROWS + F.col("at") % F.col("b_size")).alias("j"),
        "value",
    ).where("i < j")
    return (
        uniform.unionByName(compared)
        .groupBy(F.col("lang"), F.col("i").alias("a"), F.col("j").alias("b"))
        .agg(F.sum("value").alias("value"))
    )


def audit(
    documents: DataFrame, least_docs: int, top: int, lang: str = "lang", source: str = "source", text: str = "text"
) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from each other one of its language, and by which terms it stands out.

    part ``pair`` has every other source, ``term`` the ``top`` terms that are more frequent in the source than in its language. Ranks go by
    value from the greatest, then item; value is exact. Null lang, source and text count as empty; a group whose
    texts have no terms still has its pairs, with value 0 where the language keeps no term at all. Repeated rows count each. Texts of any length
    are counted where they are read, a bounded number of counts at a time. Terms are numbered over range partitions; one row per
    group passes through a window of its language, and there are as many pairs as the result has rows. Only lang, source
    and text are read, so further columns may have any name. No rows give no rows."""
    counts = stored(term_counts(documents, lang, source, text), "divergence-counts")
    groups, kept, cells = matrix(counts, least_docs)
    sums = stored(pair_sums(groups, cells), "divergence-sums")
    both = sums.union(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    named = groups.select("lang", F.col("row").alias("b"), F.col("source").alias("item"))
    pairs = (
        groups.select("lang", "source", F.col("row").alias("a"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("s") - 1)).alias("b"))
        .where("a <> b")
        .join(both, ["lang", "a", "b"], "left")
        .join(named, ["lang", "b"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    )
    of_lang = kept.select("lang", "term", share("total", "lang_n", "v").alias("q"))
    terms = (
        cells.join(of_lang, ["lang", "term"])
        .where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), price("p", "q").alias("value"))
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [part.withColumn("rank", F.row_number().over(order)) for part in (pairs, terms)]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top))


shipped(__name__)
