"""Which names of a table occur in which texts, by an index over trigrams of the names.

The vocabulary is data of any size: each name is listed under the one trigram that the fewest names share. Texts are cut
into their trigrams, these meet the list in an equi-join, and what meets is compared byte by byte at its place. So
a text is read once whatever the number of names, and no pair of text and name is formed without a trigram in common.

Trigrams are bytes of UTF-8, in which a substring of bytes is a substring of characters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import lowered_text

WIDTH = 3

#: Up to so many names, each cut off at the warehouse's limit of a name, the list is sent to all executors (some 20 MB).
#: A longer list is shuffled, and so are trigrams.
SENT_NAMES, SENT_BYTES = 100_000, 400


def name_index(names: DataFrame, name: str) -> DataFrame:
    """(gram, at, size, bytes, name): a row per distinct name, under its rarest trigram.

    ``at`` is the trigram's place in the name, from 0. Names shorter than a trigram are listed under themselves; missing and
    empty names are in no text."""
    distinct = names.select(F.col(name).alias("name"), F.col(name).cast("binary").alias("bytes")).where("bytes <> X''").distinct()
    sized = distinct.withColumn("size", F.octet_length("bytes"))
    grams = sized.select("name", "bytes", "size", F.explode(F.expr(f"sequence(0, greatest(size - {WIDTH}, 0))")).alias("at")).withColumn(
        "gram", F.expr(f"substring(bytes, at + 1, {WIDTH})")
    )
    shared = grams.select("name", "gram").distinct().groupBy("gram").agg(F.count(F.lit(1)).alias("sharing"))
    rarest = Window.partitionBy("name").orderBy("sharing", F.desc("gram"), "at")
    return (
        grams.join(shared, "gram")
        .withColumn("place", F.row_number().over(rarest))
        .where("place = 1")
        .select("gram", "at", "size", "bytes", "name")
    )


def mentioned(texts: DataFrame, keys: list[str], text: str, names: DataFrame, name: str = "name") -> DataFrame:
    """(keys, name), once each: the names that occur in a text of these keys as a bare substring.

    ``text`` is an SQL expression over ``texts``. Keys that many texts share are reduced in the map tasks."""
    index = name_index(names, name)
    spelled = texts.select(*keys, F.expr(f"CAST({text} AS BINARY)").alias("_text"))
    # What decides is the size of the list, which the vocabulary sets and not the number of texts.
    sizes = index.select("size").limit(SENT_NAMES + 1).agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("most")).first()
    if sizes.n == 0:
        return spelled.select(*keys, F.lit("").alias(name)).where("false")
    widths = [w for w in range(1, WIDTH) if index.where(F.col("size") == w).limit(1).count()] + [WIDTH]
    if sizes.n <= SENT_NAMES and sizes.most <= SENT_BYTES:
        met = _grams(spelled, ["_text"], keys, widths).join(F.broadcast(index), "gram")
        here = F.expr("_at > at AND substring(_text, _at - at, size) = bytes")
        found = met.where(here)
    else:
        pairs = _grams(spelled, [], keys, widths).distinct().join(index, "gram").select(*keys, "name", "bytes").distinct()
        same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
        found = spelled.join(pairs.withColumnsRenamed({k: f"_of_{k}" for k in keys}), same).where("contains(_text, bytes)")
    return found.select(*keys, F.col("name").alias(name)).distinct()


def _grams(spelled: DataFrame, kept: list[str], keys: list[str], widths: list[int]) -> DataFrame:
    """Every trigram of each text, and shorter ones where ``widths`` has them, with its place from 1 if the text is kept."""
    places = spelled.select(*keys, "_text", F.explode(F.expr("sequence(1, greatest(octet_length(_text), 1))")).alias("_at"))
    cut = [F.expr(f"substring(_text, _at, {width})") for width in widths]
    at = ["_at"] if kept else []
    if len(cut) == 1:
        return places.select(*keys, *kept, *at, cut[0].alias("gram"))
    return places.select(*keys, *kept, *at, F.explode(F.array(*cut)).alias("gram"))


def skill_pairs(relevant: DataFrame, dim_skill: DataFrame) -> DataFrame:
    """(source, external_id, skill_name) with the vocabulary read from a table."""
    return mentioned(relevant, ["source", "external_id"], lowered_text("title", "description"), dim_skill, "skill_name")
