"""Removal of repeated passages: windows of three consecutive lines that an earlier place has too."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postingloom.llm.common import digest_number, helper_prefix, row_key, text_or_empty

WINDOW = 3


def _line_structs(text: str) -> Column:
    """(line number, trimmed line) of every line with a word."""
    trimmed = F.transform(
        F.split(text_or_empty(text), "\n"),
        lambda line, i: F.struct(i.alias("i"), F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "").alias("line")),
    )
    return F.filter(trimmed, lambda at: at["line"] != "")


def document_order(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Column:
    """One number by which documents are ordered: by id, those without an id last, and among equal ids by 60 bits of the
    text's MD5. Only copies of one row share it. A decimal, as its smallest value is found by a hash aggregate."""
    key_id, _ = row_key(documents, doc_id, text)
    return key_id.cast("decimal(20,0)") * F.lit(1 << 60).cast("decimal(19,0)") + digest_number(text_or_empty(text))


def windows(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(owner, place, h, g): every window of three consecutive lines with a word.

    owner is the document's place in order, place counts such lines. h and g are two hashes of the lines, 128 bits together."""
    owner = document_order(documents, doc_id, text).alias("owner")
    # The lines are the variable of an outer lambda, so they are cut once wherever the optimizer moves the expression.
    hashed = F.transform(
        F.array(_line_structs(text)),
        lambda at: F.when(
            F.size(at) >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size(at) - WINDOW),
                lambda k: F.struct(
                    F.xxhash64(*(at[k + n]["line"] for n in range(WINDOW))).alias("h"),
                    F.xxhash64(F.lit(7), *(at[k + n]["line"] for n in reversed(range(WINDOW)))).alias("g"),
                ),
            ),
        ),
    )[0]
    return documents.select(owner, F.posexplode(hashed).alias("place", "at")).select("owner", "place", "at.h", "at.g")


def covered_lines(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(owner, covered): places of lines that later occurrences cover, merged.

    The first occurrence of a window is its first place in the first document by
    ``document_order``; all others are later ones. A later window in that same document
    spares the lines it shares with the first one."""
    own = windows(documents, doc_id, text)
    repeated = (
        own.groupBy("h", "g")
        .agg(F.min("owner").alias("first_owner"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("h").alias("of_h"), F.col("g").alias("of_g"), "first_owner")
    )
    later = (
        own.join(repeated, (F.col("h") == F.col("of_h")) & (F.col("g") == F.col("of_g")))
        .select("owner", "h", "g", "place", (F.col("owner") == F.col("first_owner")).alias("first"))
        .repartition("owner")
    )
    # One group per window of a document, then one per document: neither outgrows the document.
    places = later.groupBy("owner", "h", "g", "first").agg(
        F.min("place").alias("first_place"), F.collect_set("place").alias("places")
    )
    covers = F.expr(f"""flatten(transform(
        filter(places, p -> not first or p > first_place),
        p -> sequence(if(first, greatest(p, first_place + {WINDOW}), p), p + {WINDOW - 1})))""")
    return (
        places.select("owner", covers.alias("covers"))
        .where(F.size("covers") > 0)
        .groupBy("owner")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("covers")))).alias("covered"))
    )


def without_repeats(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with ``text`` less its repeated lines, and n_removed (int).

    Every row comes out once, in other respects unchanged; a text without repeats stays as it is,
    blank lines included. A null text stays null. Texts of fewer than three lines with a word have no window and stay.
    Documents are ordered by id, those without an id last, and among equal ids by their text's MD5, so of
    texts that share an id one comes first as well; copies of one row (id and text) keep or lose the same lines. Ids that are no whole
    numbers are ordered by their MD5. A document that is all repeats becomes an empty text; a text of any length is worked on
    in one row. A column named n_removed is replaced, others may have any name. No rows give no rows."""
    own = helper_prefix(documents)
    owner, of, gone = f"{own}owner", f"{own}of", f"{own}covered"
    covered = covered_lines(documents, doc_id, text).select(F.col("owner").alias(of), F.col("covered").alias(gone))
    rest = F.transform(
        F.array(F.struct(F.split(text, "\n").alias("lines"), _line_structs(text).alias("at"), F.col(gone).alias("gone"))),
        lambda row: F.array_join(
            F.transform(
                F.array_except(
                    F.sequence(F.lit(0), F.size(row["lines"]) - 1), F.transform(row["gone"], lambda p: row["at"][p]["i"])
                ),
                lambda i: row["lines"][i],
            ),
            "\n",
        ),
    )[0]
    return (
        documents.withColumn(owner, document_order(documents, doc_id, text))
        .join(covered, F.col(owner) == F.col(of), "left")
        .withColumns({
            text: F.when(F.col(gone).isNull(), F.col(text)).otherwise(rest),
            "n_removed": F.coalesce(F.size(gone), F.lit(0)),
        })
        .drop(owner, of, gone)
    )
