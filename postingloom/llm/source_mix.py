"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postingloom.llm.common import helper_prefix, numbered, row_key, words

#: Parts into which documents of one source and size class are dealt, so that no group of equals meets in one task.
PARTS = 256


def word_count(text: str = "text") -> Column:
    return F.size(words(text)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int], percent: int, most: int
) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Sources in order of code points, a missing one last, have the weights in turn and share ``percent`` of all
    sizes. A target stops at ``most`` times its source's size; what is above is shared again by weight. Sources are
    taken in order of size per weight: one is above its limit exactly if its share of what the
    earlier ones left is. One row per source passes through one window.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.array(*(F.lit(int(w)).cast("long") for w in weights))
    weighted = per_source.withColumn("place", place).withColumn("weight", turn[F.col("place") % len(weights)])
    everything = Window.partitionBy()
    earlier = Window.orderBy(
        F.col("source_size").cast("double") / F.col("weight"), "place"
    ).rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")

    def share(capped_size: Column, capped_weight: Column) -> Column:
        """Words per weight left by capped sources; sums stay whole numbers until the division."""
        left = percent * F.sum("source_size").over(everything) - 100 * most * capped_size
        weight = 100 * (F.sum("weight").over(everything) - capped_weight)
        return F.try_divide(left.cast("double"), weight.cast("double"))

    limit = (most * F.col("source_size")).cast("double")
    tried = weighted.withColumn(
        "capped",
        share(F.coalesce(F.sum("source_size").over(earlier), none), F.coalesce(F.sum("weight").over(earlier), none))
        * F.col("weight")
        >= limit,
    )
    capped = [F.sum(F.when(F.col("capped"), F.col(c)).otherwise(none)).over(everything) for c in ("source_size", "weight")]
    return tried.select(
        "source",
        "source_size",
        F.when(F.col("capped"), limit).otherwise(share(*capped) * F.col("weight")).alias("target"),
    )


def mix(
    documents: DataFrame,
    weights: Sequence[int],
    percent: int,
    most: int,
    seed: str = "mix",
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``documents`` with size (words), source_size, target (words of its source) and copies (how often the mix takes it).

    A document of a source is expected target / source_size times. Within the source, ordered by size class, part and
    size, the expected copies are added up from one random offset, and a document is taken
    once per whole number its stretch crosses, so neighbours in size share a source's copies evenly.
    No task has to see a whole source for that (see ``numbered``).

    A null text has size 0, a missing source is a source of its own, a missing doc_id goes
    by its text. Rows that agree in id and size are interchangeable, so repeated rows give the same rows in
    every run. The offset depends on seed and source alone. Columns named like an added one are replaced, others may have any
    name. A text of any length is one number, its size. No rows give no rows.
    """
    own = helper_prefix(documents)
    own_id, own_text = row_key(documents, doc_id, text)
    size = word_count(text)
    tens = F.length(F.col("size").cast("string"))
    label = F.coalesce(F.concat(F.lit("s"), F.col(f"{own}source")), F.lit("n"))
    name = F.coalesce(F.col(doc_id).cast("string"), F.col(f"{own}text").cast("string"))
    sized = (
        documents.withColumns({"size": size, f"{own}id": own_id, f"{own}text": own_text, f"{own}source": F.col(source).cast("string")})
        .withColumns({
            f"{own}class": tens * 100 + F.substring(F.col("size").cast("string"), 1, 2).cast("int"),
            f"{own}part": F.conv(F.substring(F.md5(name), 1, 2), 16, 10).cast("int"),
        })
        .withColumn(f"{own}group", F.concat_ws("|", f"{own}part", f"{own}class", label))
    )
    targets = source_targets(sized.select(F.col(f"{own}source").alias("source"), "size"), weights, percent, most).select(
        F.col("source").alias(f"{own}of_source"), F.col("source_size").alias(f"{own}source_size"), F.col("target").alias(f"{own}target")
    )
    rate = F.when(F.col(f"{own}source_size") > 0, F.col(f"{own}target") / F.col(f"{own}source_size")).otherwise(F.lit(0.0))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(f"{own}of_source", F.lit("")))), 1, 8), 16, 10).cast("double")
    rates = targets.select(
        f"{own}of_source",
        f"{own}source_size",
        f"{own}target",
        F.floor(rate).alias(f"{own}whole"),
        (rate - F.floor(rate)).alias(f"{own}rest"),
        (offset / 4294967296.0).alias(f"{own}offset"),
    )
    placed = numbered(sized, f"{own}source", f"{own}class", f"{own}part", f"{own}group", ["size", f"{own}id", f"{own}text"], f"{own}place")
    crossed = F.floor(F.col(f"{own}offset") + F.col(f"{own}place") * F.col(f"{own}rest")) - F.floor(
        F.col(f"{own}offset") + (F.col(f"{own}place") - 1) * F.col(f"{own}rest")
    )
    return (
        placed.join(rates, F.col(f"{own}source").eqNullSafe(F.col(f"{own}of_source")))
        .withColumns({"copies": F.col(f"{own}whole") + crossed, "source_size": F.col(f"{own}source_size"), "target": F.col(f"{own}target")})
        .drop(f"{own}id", f"{own}text", f"{own}source", f"{own}class", f"{own}part", f"{own}group", f"{own}place", *rates.columns)
    )


def taken(mixed: DataFrame) -> DataFrame:
    """The mix itself: every document as often as its copies say."""
    copy = f"{helper_prefix(mixed)}copy"
    return mixed.where("copies > 0").withColumn(
        copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    ).drop(copy)
