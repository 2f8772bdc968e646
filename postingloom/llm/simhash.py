"""Near-duplicate documents by SimHash, found through an inverted index of positional bytes."""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from postingloom.llm.common import bounded_batches, helper_prefix, shipped, stored, text_or_empty
from postingloom.llm.components import connected_components

SEED = 42
N_BYTES = 8
#: Posting lists up to this length are compared pair by pair, longer ones through midpoints; both find every link.
SHORT_LIST = 64
#: Hashes whose bits are counted at once.
BLOCK = 1 << 15


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of UTF-8 text as a signed 64-bit number; text without words has zero."""
    found = text.lower().split()  # bytes: lowers A-Z only and splits at the six ASCII blanks
    if not found:
        return 0
    if len(found) > shingle:
        pieces = map(b" ".join, zip(*(found[k:] for k in range(shingle)), strict=False))
    else:
        pieces = iter([b" ".join(found)])
    hashes = np.fromiter(map(xxh64_intdigest, pieces, repeat(SEED)), np.uint64)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), BLOCK):
        rows = hashes[start : start + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint_column(text: str, shingle: int) -> Column:
    @F.arrow_udf("bigint")
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array((fingerprint(value.as_py(), shingle) for value in texts), pa.int64())

    return simhash(text_or_empty(text).cast("binary"))


def posting_masks(distance: int) -> list[int]:
    """Positions whose bytes make the key of a posting list.

    ``distance`` differing bits touch at most that many of the eight bytes. Cut into
    ``distance + 2`` blocks, at least two blocks stay whole, so fingerprints that link
    share the list of some two blocks."""
    n_blocks = distance + 2
    if not 0 <= distance <= N_BYTES - 2:
        raise ValueError(f"distance must be between 0 and {N_BYTES - 2}")
    blocks = [[p for p in range(N_BYTES) if p * n_blocks // N_BYTES == block] for block in range(n_blocks)]
    return [sum(0xFF << 8 * p for block in two for p in block) for two in combinations(blocks, 2)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def links(fingerprints: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) between distinct values of ``fp`` that differ in at most ``distance`` bits.

    Short lists give every pair that links. In a long list fingerprints meet at the
    points half way between them, of which each has few around it (65 for two
    bits), and link to the smallest there. That keeps what is reachable without
    the pairs of a whole group.
    """
    masks = posting_masks(distance)
    distinct = fingerprints.select("fp").distinct()
    postings = distinct.select(
        "fp",
        F.explode(
            F.array(*(F.struct(F.lit(k).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bytes"))
                      for k, m in enumerate(masks)))
        ).alias("posting"),
    ).select("fp", "posting.*")
    sizes = postings.groupBy("part", "bytes").agg(F.count("*").alias("n")).where("n > 1")
    listed = stored(postings.join(sizes, ["part", "bytes"]), "simhash-postings")
    return _pairs(listed.where(F.col("n") <= SHORT_LIST), distance).union(
        _midpoints(listed.where(F.col("n") > SHORT_LIST), distance)
    )


def _pairs(listed: DataFrame, distance: int) -> DataFrame:
    """Tally the positional bytes that a pair shares; keep pairs with enough of them and verify their bits."""
    tally = " + ".join(f"int((a ^ b) & {_signed(0xFF << 8 * p)}L = 0L)" for p in range(N_BYTES))
    found = f"""flatten(transform(fps, (a, i) -> transform(
        filter(slice(fps, i + 2, size(fps)), b -> {tally} >= {N_BYTES - distance} and bit_count(a ^ b) <= {distance}),
        b -> struct(a as a, b as b))))"""
    return (
        listed.groupBy("part", "bytes")
        .agg(F.collect_list("fp").alias("fps"))
        .select(F.explode(F.expr(found)).alias("pair"))
        .select("pair.a", "pair.b")
    )


def _midpoints(listed: DataFrame, distance: int) -> DataFrame:
    """Link whatever lies around a point to the smallest fingerprint near it.

    Fingerprints that link have a point within half the distance, rounded down, of
    one and rounded up of the other. So all that is within the larger radius of a
    point links to each that is within the smaller one."""
    near, wide = distance // 2, (distance + 1) // 2
    flips = [(sum(1 << k for k in bits), n <= near) for n in range(wide + 1) for bits in combinations(range(64), n)]
    points = listed.select("fp").distinct().select(
        "fp",
        F.explode(
            F.transform(
                F.array(*(F.struct(F.lit(_signed(f)).alias("bits"), F.lit(close).alias("near")) for f, close in flips)),
                lambda f: F.struct(F.col("fp").bitwiseXOR(f["bits"]).alias("at"), f["near"].alias("near")),
            )
        ).alias("point"),
    )
    met = (
        points.groupBy("point.at")
        .agg(F.collect_list("fp").alias("fps"), F.min(F.when(F.col("point.near"), F.col("fp"))).alias("b"))
        .where((F.size("fps") > 1) & F.col("b").isNotNull())
    )
    return met.select(F.explode("fps").alias("a"), "b").where(
        (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    )


def near_duplicates(
    documents: DataFrame, shingle: int, distance: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, fp, component_id, root, text_hash), one row per row of ``documents``.

    component_id is the smallest doc_id that links of at most ``distance`` bits reach.
    A null text counts as empty; empty texts have fingerprint zero and link like any
    other. A missing doc_id is null in the result, and a component of such rows alone
    has a null component_id; root, a fingerprint, tells components apart; text_hash tells
    texts of one id apart. Repeated rows come out repeated. No rows give no rows.
    Only doc_id and text are read, so further columns may have any name.
    """
    bounded_batches(documents.sparkSession)
    prints = stored(
        documents.select(
            F.col(doc_id).cast("long").alias("doc_id"),
            F.xxhash64(text_or_empty(text)).alias("text_hash"),
            fingerprint_column(text, shingle).alias("fp"),
        ),
        "simhash-fingerprints",
    )
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = connected_components(links(least, distance), "simhash")
    placed = least.join(rooted, least.fp == rooted.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = placed.join(placed.groupBy("root").agg(F.min("least").alias("component_id")), "root").select(
        F.col("fp").alias("of"), "component_id", "root"
    )
    return prints.join(named, prints.fp == named.of).select("doc_id", "fp", "component_id", "root", "text_hash")


def one_of_each(documents: DataFrame, shingle: int, distance: int) -> DataFrame:
    """One document of each component: a row with the smallest doc_id there.

    Of several such rows one with a text stays before one without, then the one with the smallest text; rows that lack a
    doc_id go by fingerprint before text. Rows that share a doc_id but lie in different components don't
    touch each other: a row is known by doc_id and text. Columns stay as they are and may have any name."""
    own = helper_prefix(documents)
    kept = (
        near_duplicates(documents, shingle, distance)
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select(*(F.col(name).alias(own + name) for name in ("doc_id", "text_hash", "fp", "root")))
        .distinct()
    )
    nameless_fp = F.when(F.col("doc_id").isNull(), F.col(f"{own}fp"))
    place = F.row_number().over(
        Window.partitionBy(f"{own}root").orderBy(F.col("text").isNull(), nameless_fp, F.col("text"))
    )
    return (
        documents.join(
            kept,
            F.col("doc_id").cast("long").eqNullSafe(F.col(f"{own}doc_id"))
            & (F.xxhash64(text_or_empty("text")) == F.col(f"{own}text_hash")),
        )
        .withColumn(f"{own}place", place)
        .where(F.col(f"{own}place") == 1)
        .select(*documents.columns)
    )


shipped(__name__)
