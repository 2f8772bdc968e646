"""Near-duplicate vectors by a pivot-permutation index."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postingloom.llm.common import shipped, stored
from postingloom.llm.components import connected_components

#: Vectors of a list are compared in blocks of about so many, so that no task holds a long list.
BLOCK = 512
#: Sampled vectors for each pivot, and the cosine below which pivots lie.
SAMPLE, APART = 4, 0.7


def unit(vector: str | Column) -> Column:
    """The vector in double precision; null where it is null, empty, zero or has a null or non-finite component."""
    given = F.transform(F.col(vector) if isinstance(vector, str) else vector, lambda x: x.cast("double"))
    finite = F.forall(given, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.when(F.coalesce(finite, F.lit(False)) & F.exists(given, lambda x: x != 0.0), given)


def choose_pivots(distinct: DataFrame, n_pivots: int) -> dict[int, np.ndarray]:
    """Up to ``n_pivots`` reference points as unit rows for each length of vectors, from a sample of four times as many of that length.

    The sample has the vectors of the smallest hashes; it is all of the data that the driver sees, and its size follows from the
    parameter and the number of lengths. A vector too close to a pivot is passed over: pivots inside a group of near copies
    would order themselves differently for each of its members."""
    widths = sorted(row[0] for row in distinct.select(F.size("vector")).distinct().collect())
    return {width: _apart(distinct.where(F.size("vector") == width), n_pivots) for width in widths}


def _apart(distinct: DataFrame, n_pivots: int) -> np.ndarray:
    rows = distinct.orderBy("h", "g").limit(SAMPLE * n_pivots).select("vector").collect()
    sample = _unit_rows(np.array([row[0] for row in rows], dtype=np.float64))
    chosen: list[int] = []
    free = np.ones(len(sample), dtype=bool)
    for k in range(len(sample)):
        if free[k] and len(chosen) < n_pivots:
            chosen.append(k)
            free &= sample @ sample[k] < APART
    return sample[chosen]


def _unit_rows(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def permutation(vector: str, pivots: dict[int, np.ndarray], prefix: int) -> Column:
    """Numbers of the ``prefix`` nearest pivots of a vector's length, all where there are fewer, nearest first; ties go to the lower number."""

    @F.arrow_udf("array<int>")
    def nearest(vectors: pa.Array) -> pa.Array:
        widths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
        sizes = np.zeros(len(widths), np.int32)
        orders = []
        for width in np.unique(widths):
            at = np.flatnonzero(widths == width)
            own = vectors if len(at) == len(widths) else vectors.take(pa.array(at))
            order = np.argsort(-(_unit_rows(_rows(own)) @ pivots[width].T), axis=1, kind="stable")[:, :prefix]
            sizes[at] = order.shape[1]
            orders.append((at, order))
        ends = np.concatenate([np.zeros(1, np.int32), np.cumsum(sizes, dtype=np.int32)])
        numbers = np.empty(ends[-1], np.int32)
        for at, order in orders:
            numbers[ends[at][:, None] + np.arange(order.shape[1])] = order
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(numbers))

    return nearest(vector)


def _rows(vectors: pa.Array) -> np.ndarray:
    return np.asarray(vectors.flatten(), dtype=np.float64).reshape(len(vectors), -1)


def _lists(index: DataFrame, n_pivots: int, pivots: dict[int, np.ndarray], prefix: int, shared: int) -> DataFrame:
    """(list, node): the inverted lists, one for each set of ``shared`` pivots among a vector's nearest.

    The number of a list spells its pivots, ascending, in base n_pivots; the place of the vectors' length comes before them."""
    widths = sorted(pivots)
    own = F.array_position(F.array(*map(F.lit, widths)), F.size("vector")) - 1 if len(widths) > 1 else F.lit(0)
    near = F.array_sort("near")
    found = None
    # Lengths with fewer pivots than the prefix have shorter ones; others share one plan.
    for size in sorted({min(prefix, len(rows)) for rows in pivots.values()}):
        share = min(shared, size)
        numbers = [
            sum(
                (near[place].cast("long") * n_pivots ** (share - 1 - k) for k, place in enumerate(places)),
                own.cast("long") * n_pivots**shared,
            )
            for places in combinations(range(size), share)
        ]
        lists = index.where(F.size("near") == size).select(F.explode(F.array(*numbers)).alias("list"), "node")
        found = lists if found is None else found.unionByName(lists)
    return found


def _dealt(index: DataFrame, n_pivots: int, pivots: dict[int, np.ndarray], prefix: int, shared: int) -> DataFrame:
    """(list, first, second, node): each list of two vectors or more in pairs of blocks of about BLOCK vectors.

    A block is sent once for each pair it is part of, so a pair of vectors meets in one task and no task holds a long list."""
    lists = _lists(index, n_pivots, pivots, prefix, shared)
    sizes = lists.groupBy("list").agg(F.count("*").alias("n")).where("n > 1")
    n_blocks = F.ceil(F.col("n") / BLOCK)
    own = F.pmod(F.hash("node"), F.col("n_blocks"))
    return (
        lists.join(sizes, "list")
        .withColumn("n_blocks", n_blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
        .select("list", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"), "own", "node")
    )


_FOUND = "a bigint, b bigint, n bigint"


def _compared(group: pa.Table, cosine: float, n_pivots: int, shared: int) -> pa.Table | None:
    """Links among the vectors of a list (one pair of blocks): their number for each vector, and pairs that span what hangs together.

    Only pairs count whose smallest ``shared`` common pivots are those of the list: each pair does so in one list."""
    number = group.column("list")[0].as_py()
    shared = min(shared, len(group.column("near")[0]))
    pivots = [number // n_pivots**k % n_pivots for k in reversed(range(shared))]
    near = np.asarray(group.column("near").combine_chunks().flatten()).reshape(len(group), -1)
    before = np.zeros((len(group), pivots[-1] + 1), np.float32)
    rows, columns = np.nonzero(near < pivots[-1])
    before[rows, near[rows, columns]] = 1
    before[:, pivots] = 0
    vectors = _unit_rows(_rows(group.column("vector").combine_chunks()))
    linked = (vectors @ vectors.T >= cosine) & (before @ before.T == 0)
    own = group.column("own").to_numpy()
    first, second = group.column("first")[0].as_py(), group.column("second")[0].as_py()
    if first != second:
        linked &= own[:, None] != own[None, :]
    np.fill_diagonal(linked, False)
    hit = np.flatnonzero(linked.any(axis=1))
    if not len(hit):
        return None
    linked = linked[np.ix_(hit, hit)]
    nodes = group.column("node").to_numpy()[hit]
    copies = group.column("copies").to_numpy()[hit]
    root = np.arange(len(hit))
    while True:
        nearer = np.minimum(root, np.where(linked, root[None, :], len(hit)).min(axis=1))
        if (nearer == root).all():
            break
        root = nearer
    return pa.table({
        "a": pa.array(np.concatenate([nodes, nodes])),
        "b": pa.array(np.concatenate([nodes, nodes[root]])),
        "n": pa.array(np.concatenate([linked @ copies, np.zeros(len(hit), np.int64)]).astype(np.int64)),
    })


def _comparer(cosine: float, n_pivots: int, shared: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.Table] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(name).to_numpy() for name in ("list", "first", "second")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            table = pa.Table.from_batches([batch])
            for begin, end in zip(cuts, cuts[1:], strict=False):
                key = tuple(keys[:, begin])
                if key != last:
                    yield from _flushed(kept, cosine, n_pivots, shared)
                    kept, last = [], key
                kept.append(table.slice(begin, end - begin))
        yield from _flushed(kept, cosine, n_pivots, shared)

    return compare


def _flushed(kept: list[pa.Table], cosine: float, n_pivots: int, shared: int) -> Iterator[pa.RecordBatch]:
    if kept and sum(map(len, kept)) > 1:
        found = _compared(pa.concat_tables(kept), cosine, n_pivots, shared)
        if found is not None:
            yield from found.to_batches()


def near_duplicates(
    vectors: DataFrame,
    cosine: float,
    n_pivots: int = 1024,
    prefix: int = 8,
    shared: int = 3,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``.

    Each vector is described by its ``prefix`` nearest of ``n_pivots`` reference points, in order. Vectors with
    ``shared`` or more of these in common meet in an inverted list, and pairs of at least ``cosine`` there are links.
    Links below that don't occur; pairs that share fewer pivots are missed (see the README for the recall).
    Equal vectors are one node with a number of copies, linked with each other without any list.

    n_links counts other rows that are linked, component_id is the smallest vec_id
    reachable, kept says whether that is the row's own. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing. Vectors of different lengths don't link; each length has its own pivots and lists. A missing vec_id
    stays null; it names no component unless there is no other. Repeated rows count and come out each. Only the two columns are read, so further
    ones may have any name. No rows give no rows.
    """
    read = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), unit(embedding).alias("vector"))
    keyed = read.withColumns({
        "h": F.when(F.col("vector").isNotNull(), F.xxhash64("vector")),
        "g": F.when(F.col("vector").isNotNull(), F.xxhash64(F.lit(1), "vector")),
    })
    distinct = stored(
        keyed.where("vector is not null")
        .groupBy("vector", "h", "g")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()),
        "embedding-nodes",
    )
    pivots = choose_pivots(distinct, n_pivots)
    # The base in which lists are numbered; a length with fewer vectors than the prefix still gives each of them a whole, shorter one.
    n_pivots = max(map(len, pivots.values()), default=0)
    prefix = min(prefix, n_pivots)
    shared = min(shared, prefix)
    if shared:
        index = stored(distinct.select("node", "copies", "vector", permutation("vector", pivots, prefix).alias("near")), "embedding-index")
        dealt = _dealt(index, n_pivots, pivots, prefix, shared)
        members = dealt.join(index, "node").repartition("list", "first", "second").sortWithinPartitions("list", "first", "second")
        found = stored(members.mapInArrow(_comparer(cosine, n_pivots, shared), _FOUND), "embedding-links")
    else:
        found = vectors.sparkSession.createDataFrame([], _FOUND)
    counts = found.groupBy(F.col("a").alias("of")).agg(F.sum("n").alias("n"))
    rooted = connected_components(found.where("a <> b").select("a", "b"), "embedding")
    placed = distinct.join(counts, F.col("node") == F.col("of"), "left").join(
        rooted.withColumnRenamed("node", "rooted"), F.col("node") == F.col("rooted"), "left"
    ).select(
        F.col("h").alias("of_h"), F.col("g").alias("of_g"), "least",
        (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root"),
    )
    names = placed.groupBy(F.col("root").alias("of_root")).agg(F.min("least").alias("component_id"))
    described = placed.join(names, F.col("root") == F.col("of_root")).select("of_h", "of_g", "n_links", "component_id")
    return keyed.select("vec_id", "h", "g").join(
        described, (F.col("h") == F.col("of_h")) & (F.col("g") == F.col("of_g")), "left"
    ).select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("of_h").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


shipped(__name__)
