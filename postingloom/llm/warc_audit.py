"""Fixity of WARC replicas: hash trees over records and offset ranges, compared from the root down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postingloom.llm.common import stored, text_or_empty

#: Bytes of a lowest range, and ranges that one of the level above spans.
RANGE, FAN = 1 << 16, 16


def record_bytes(url: Column, date: str, payload: Column) -> Column:
    """A WARC response record around a text; null parts are empty."""
    body = text_or_empty(payload).cast("binary")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "),
        text_or_empty(url),
        F.lit(f"\r\nWARC-Date: {date}\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head.cast("binary"), body, F.lit("\r\n\r\n").cast("binary"))


def records(
    pages: DataFrame,
    n_files: int,
    date: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    held: Column | None = None,
) -> DataFrame:
    """(file, offset, length, digest, page_id): a record for each page, side by side in ``n_files`` files.

    A page's file follows from its id and url; within the file records are ordered by id, missing ones first, url and digest.
    With ``held`` the digest is that of a replica which holds this in place of the page, at the place the page had.
    Records are hashed where they are read; only lengths and digests are shuffled."""
    made = record_bytes(F.col(url), date, F.col(html))
    kept = made if held is None else record_bytes(F.col(url), date, held)
    name = F.concat_ws("|", F.coalesce(F.col(page_id).cast("string"), F.lit("")), F.coalesce(F.col(url), F.lit("")))
    own = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("url"),
        (F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long") % n_files).alias("file"),
        F.octet_length(made).cast("long").alias("length"),
        F.sha2(made, 256).alias("own"),
        F.sha2(kept, 256).alias("digest"),
    )
    before = Window.partitionBy("file").orderBy("page_id", "url", "own").rowsBetween(Window.unboundedPreceding, -1)
    return own.select(
        "file", F.coalesce(F.sum("length").over(before), F.lit(0).cast("long")).alias("offset"), "length", "digest", "page_id"
    )


def _ranges(of: DataFrame) -> DataFrame:
    """(file, place, hash) of the lowest ranges: over the records that begin in them, in order of offset.

    A record has a head, so a range holds a bounded number of them."""
    leaf = F.concat_ws(":", F.col("offset").cast("string"), F.col("length").cast("string"), "digest")
    return of.groupBy("file", F.floor(F.col("offset") / RANGE).alias("place")).agg(
        _hash(F.collect_list(F.struct("offset", "digest", leaf.alias("hash"))))
    )


def _hash(children: Column) -> Column:
    ordered = F.transform(F.array_sort(children), lambda child: child["hash"])
    return F.sha2(F.array_join(ordered, ","), 256).alias("hash")


def _above(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("file", F.floor(F.col("place") / FAN).alias("place")).agg(
        _hash(F.collect_list(F.struct("place", "hash")))
    )


def tree(of: DataFrame, n_levels: int, purpose: str) -> list[DataFrame]:
    """Tables of nodes (file, place, hash), from the lowest ranges to the level of the roots."""
    levels = [stored(_ranges(of), f"warc-{purpose}-0")]
    for k in range(1, n_levels):
        levels.append(stored(_above(levels[-1]), f"warc-{purpose}-{k}"))
    return levels


def _unequal(one: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    return (
        one.select(*keys, F.col("hash").alias("h1"))
        .join(other.select(*keys, F.col("hash").alias("h2")), keys, "full")
        .where(~F.col("h1").eqNullSafe(F.col("h2")))
        .select(*keys)
    )


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """(file, offset, length, kind) of every record in which the replica differs from the primary.

    Both have (file, offset, length, digest), at most one record at an offset of a file. kind is altered, missing
    (only the primary has it) or added (only the replica); length is the primary's, else the
    replica's. Roots are compared for each file, then only the children of ranges that differ, down to the records. A file of any
    size is hashed range by range; the number of levels follows from the largest offset. Repeated records
    with the same offset give a row for each pair that differs. Rows that lack file or offset belong to no range and are not compared. Further columns may
    have any name. Empty tables give no rows; with one empty, all of the other is missing or added.
    """
    primary, replica = (
        stored(t.select("file", "offset", "length", "digest").where("file is not null and offset is not null"), "warc-records")
        for t in (primary, replica)
    )
    furthest = primary.select("offset").union(replica.select("offset")).agg(F.max("offset")).first()[0] or 0
    n_levels, width = 1, furthest // RANGE
    while width:
        n_levels, width = n_levels + 1, width // FAN
    ours, theirs = tree(primary, n_levels, "primary"), tree(replica, n_levels, "replica")
    unequal = _unequal(ours[-1], theirs[-1], ["file", "place"])
    for one, other in reversed(list(zip(ours[:-1], theirs[:-1], strict=True))):
        unequal = _unequal(_within(one, unequal, FAN, "place"), _within(other, unequal, FAN, "place"), ["file", "place"])
    unequal = stored(unequal, "warc-unequal")
    one, other = (_within(t, unequal, RANGE, "offset") for t in (primary, replica))
    both = one.select("file", "offset", F.col("length").alias("l1"), F.col("digest").alias("d1"), F.lit(True).alias("is1")).join(
        other.select("file", "offset", F.col("length").alias("l2"), F.col("digest").alias("d2"), F.lit(True).alias("is2")),
        ["file", "offset"],
        "full",
    )
    kind = F.when(F.col("is2").isNull(), "missing").when(F.col("is1").isNull(), "added").otherwise("altered")
    same = F.col("is1").eqNullSafe(F.col("is2"))
    return both.where(~(same & F.col("d1").eqNullSafe(F.col("d2")) & F.col("l1").eqNullSafe(F.col("l2")))).select(
        "file", "offset", F.coalesce("l1", "l2").alias("length"), kind.alias("kind")
    )


def _within(rows: DataFrame, ranges: DataFrame, width: int, column: str) -> DataFrame:
    """Rows whose column lies in one of the ranges (file, place) of that width."""
    above = ranges.select(F.col("file").alias("_file"), F.col("place").alias("_place"))
    return rows.join(above, (F.col("file") == F.col("_file")) & (F.floor(F.col(column) / width) == F.col("_place")), "left_semi")
