"""Quality rules over documents: word statistics of each text, and lines that too many documents of a host share."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postingloom.llm.common import BLANKS, WORD, helper_prefix, row_key, stored, text_or_empty

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Limits:
    """A text fails with fewer than ``least_words`` or more than ``repeat_share`` percent words in repeated windows.

    A line goes if more than ``line_documents`` documents of its host have it, and more than ``line_share`` percent
    of them. A document is depleted if fewer than ``least_words`` or ``kept_share`` percent of its words are left."""

    least_words: int = 10
    repeat_share: int = 20
    line_documents: int = 10
    line_share: int = 5
    kept_share: int = 30


def _repeat_words(words: str, window: int) -> str:
    """Words in windows of so many words that the text has twice or more.

    Window hashes are sorted with their places, equal neighbours found, and the covered places
    added up. Each step's array is the variable of an outer lambda, so it is made once wherever
    the optimizer moves the expression."""
    window_hash = ", ".join(f"{words}[i + {k}]" for k in range(window))
    return f"""transform(
        array(case when size({words}) < {window} then cast(array() as array<bigint>)
            else transform(sequence(0, size({words}) - {window}), i -> xxhash64({window_hash})) end),
        hashes -> case when size(hashes) = size(array_distinct(hashes)) then 0L else transform(
            array(array_sort(transform(hashes, (h, i) -> struct(h as h, i as i)))),
            s -> aggregate(
                array_sort(transform(
                    filter(s, (x, k) ->
                        coalesce(get(s, k - 1).h = x.h, false) or coalesce(get(s, k + 1).h = x.h, false)),
                    x -> x.i)),
                struct(0L as n, {-window} as last),
                (a, p) -> struct(a.n + least({window}, p - a.last) as n, p as last),
                a -> a.n))[0] end)[0]"""


def base_statistics(documents: DataFrame, limits: Limits = Limits(), text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and base_failed; a null text has no words."""
    own = f"coalesce(`{text}`, '')"
    statistics = f"""struct(
        transform(array(regexp_extract_all({own}, r'{WORD}', 0)), words ->
            struct(cast(size(words) as bigint) as n_words, {_repeat_words("words", 5)} as n_repeat_words))[0] as words,
        transform(array(filter(split({own}, '\\n'), line -> line rlike r'{WORD}')), lines ->
            cast(size(lines) - size(array_distinct(lines)) as bigint))[0] as n_dup_lines,
        cast(length(regexp_replace({own}, r'{BLANKS}', '')) as bigint) as word_chars,
        cast(length(regexp_replace({own}, r'[^#*$%&|<>]+', '')) as bigint) as n_symbols)"""
    made = f"{helper_prefix(documents)}statistics"
    return (
        documents.withColumn(made, F.expr(statistics))
        .withColumns({
            "n_words": F.col(f"{made}.words.n_words"),
            "word_chars": F.col(f"{made}.word_chars"),
            "n_symbols": F.col(f"{made}.n_symbols"),
            "n_dup_lines": F.col(f"{made}.n_dup_lines"),
            "n_repeat_words": F.col(f"{made}.words.n_repeat_words"),
        })
        .drop(made)
        .withColumn(
            "base_failed",
            (F.col("n_words") < limits.least_words)
            | (100 * F.col("n_repeat_words") > limits.repeat_share * F.col("n_words")),
        )
    )


def normalised(line: Column) -> Column:
    """A-Z in lower case, blanks as one space, none at the ends."""
    return F.translate(F.trim(F.regexp_replace(line, BLANKS, " ")), UPPER, LOWER)


def _lines(documents: DataFrame, host: str, doc_id: str, text: str) -> DataFrame:
    """Host, key of the row, place, hash and words of every line with a word."""
    key_id, key_text = row_key(documents, doc_id, text)
    lines = F.filter(F.transform(F.split(text_or_empty(text), "\n"), normalised), lambda line: line != "")
    hashed = F.transform(
        lines,
        lambda line: F.struct(F.xxhash64(line).alias("line"), F.size(F.split(line, " ")).cast("long").alias("n_words")),
    )
    own_host = F.col(host).cast("string").alias("host")
    return documents.select(own_host, key_id, key_text, F.posexplode(hashed).alias("place", "at")).select(
        "host", "key_id", "key_text", "place", "at.line", "at.n_words"
    )


def frequent_lines(
    documents: DataFrame, limits: Limits = Limits(), host: str = "source", doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(host, line, n_documents) of lines in more documents of a host than the limits allow.

    Documents are distinct texts: exact copies count once. A missing host is a host of its own."""
    per_line = (
        _lines(documents, host, doc_id, text)
        .groupBy("host", "line")
        .agg(F.count_distinct("key_text").alias("n_documents"))
        .where(F.col("n_documents") > limits.line_documents)
    )
    per_host = documents.groupBy(F.col(host).cast("string").alias("of_host")).agg(
        F.count_distinct(F.xxhash64(text_or_empty(text))).alias("n_texts")
    )
    return (
        per_line.join(per_host, F.col("host").eqNullSafe(F.col("of_host")))
        .where(100 * F.col("n_documents") > limits.line_share * F.col("n_texts"))
        .select("host", "line", "n_documents")
    )


def removed_lines(
    documents: DataFrame, limits: Limits = Limits(), host: str = "source", doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key_id, key_text, host, removed, n_removed_words) of documents with frequent lines.

    Rows that are copies of each other share a key; their lines count once."""
    frequent = frequent_lines(documents, limits, host, doc_id, text).select(
        F.col("host").alias("of_host"), F.col("line").alias("of_line")
    )
    return (
        _lines(documents, host, doc_id, text)
        .join(frequent, (F.col("line") == F.col("of_line")) & F.col("host").eqNullSafe(F.col("of_host")))
        .select("key_id", "key_text", "host", "place", "line", "n_words")
        .distinct()
        .groupBy("key_id", "key_text", "host")
        .agg(F.collect_set("line").alias("removed"), F.sum("n_words").alias("n_removed_words"))
    )


def _judged(documents: DataFrame, limits: Limits, host: str, doc_id: str, text: str) -> DataFrame:
    """As ``judged``, with the keys of each row: own_id, own_text and own_host behind the prefix of the documents."""
    own = helper_prefix(documents)
    gone = removed_lines(documents, limits, host, doc_id, text).select(
        F.col("key_id").alias(f"{own}gone_id"),
        F.col("key_text").alias(f"{own}gone_text"),
        F.col("host").alias(f"{own}gone_host"),
        F.col("removed").alias(f"{own}removed"),
        F.col("n_removed_words").alias(f"{own}n_removed_words"),
    )
    key_id, key_text = row_key(documents, doc_id, text)
    n_kept = F.col("n_words") - F.coalesce(f"{own}n_removed_words", F.lit(0))
    return (
        base_statistics(documents, limits, text)
        .withColumns({f"{own}own_id": key_id, f"{own}own_text": key_text, f"{own}own_host": F.col(host).cast("string")})
        .join(
            gone,
            (F.col(f"{own}own_id") == F.col(f"{own}gone_id"))
            & (F.col(f"{own}own_text") == F.col(f"{own}gone_text"))
            & F.col(f"{own}own_host").eqNullSafe(F.col(f"{own}gone_host")),
            "left",
        )
        .withColumns({"removed": F.coalesce(f"{own}removed", F.array().cast("array<bigint>")), "n_kept_words": n_kept})
        .withColumn(
            "kept",
            ~F.col("base_failed")
            & (F.col("n_kept_words") >= limits.least_words)
            & (100 * F.col("n_kept_words") >= limits.kept_share * F.col("n_words")),
        )
        .drop(*gone.columns)
    )


def judged(
    documents: DataFrame, limits: Limits = Limits(), host: str = "source", doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``documents`` with the base statistics, removed (hashes of its lines that go), n_kept_words and kept.

    kept is false where the base failed or too few words are left without the removed lines.
    Every row comes out once. A null text has no words and fails. A missing host is a host of
    its own. Rows that share id, text and host get the same verdict; a text of any length is worked on in one
    row. Columns named like an added one are replaced, others may have any name. No rows give no rows."""
    own = helper_prefix(documents)
    return _judged(documents, limits, host, doc_id, text).drop(f"{own}own_id", f"{own}own_text", f"{own}own_host")


def kept_documents(
    documents: DataFrame, limits: Limits = Limits(), host: str = "source", doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents that are kept, their texts without the removed lines, other columns as they are.

    The verdicts are worked out beside the texts and stored, so that only verdicts are shuffled on the way to them."""
    own, given = helper_prefix(documents), documents.select(doc_id, text, host)
    their = helper_prefix(given)
    key_id, key_text = row_key(documents, doc_id, text)
    verdicts = stored(
        _judged(given, limits, host, doc_id, text).select(
            F.col(f"{their}own_id").alias("of_id"), F.col(f"{their}own_text").alias("of_text"), F.col(f"{their}own_host").alias("of_host"),
            "kept", "removed",
        ),
        "quality-verdicts",
    )
    kept = verdicts.where("kept").select(
        *(F.col(name).alias(own + name) for name in ("of_id", "of_text", "of_host", "removed"))
    ).distinct()
    return (
        documents.withColumns({f"{own}own_id": key_id, f"{own}own_text": key_text})
        .join(
            kept,
            (F.col(f"{own}own_id") == F.col(f"{own}of_id"))
            & (F.col(f"{own}own_text") == F.col(f"{own}of_text"))
            & F.col(host).cast("string").eqNullSafe(F.col(f"{own}of_host")),
        )
        .withColumn(text, without_removed(F.col(text), F.col(f"{own}removed")))
        .drop(f"{own}own_id", f"{own}own_text", *kept.columns)
    )


def without_removed(text: Column, removed: Column) -> Column:
    """The text without its lines whose hashes are in ``removed``."""
    left = F.filter(
        F.split(text_or_empty(text), "\n"), lambda line: ~F.array_contains(removed, F.xxhash64(normalised(line)))
    )
    return F.when(F.size(removed) == 0, text).otherwise(F.array_join(left, "\n"))
