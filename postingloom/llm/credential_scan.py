"""Secrets in texts: fixed patterns, and weak candidates that count only beside their other parts."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postingloom.llm.common import row_key, shipped, stored, text_or_empty

#: Kinds in the order in which equal starts are listed. The first three are found by pattern alone. Fixed values.
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_IDENTIFIER = re.compile(
    r"""\b(?:user(?:_?name)?|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@+-]{3,})""",
    re.IGNORECASE | re.ASCII,
)
_SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
_ENDPOINT = re.compile(
    r"""\bhttps?://[^\s"'<>]+|\b(?:host|endpoint|server|region)["']?\x20*[:=]\x20*["']?[A-Za-z0-9][A-Za-z0-9.:-]{3,}""",
    re.IGNORECASE | re.ASCII,
)
_SCOPE_END = re.compile(r"\n[ \t\r]*\n")

#: What a part counts as beside others. A hex run is a secret from this length on.
SECRET_HEX = 32


def _random_like(token: str) -> bool:
    """Letters of both cases and digits, as keys have and words, paths and rules don't."""
    return any(map(str.isdigit, token)) and any(map(str.islower, token)) and any(map(str.isupper, token))


def base_matches(text: str) -> Iterator[tuple[str, int, int]]:
    if "=" in text or ":" in text:
        for found in _ASSIGN.finditer(text):
            if found.end(2) - found.start(2) >= 12:
                yield "assign", found.start(), found.end()
    for found in _ACCESS.finditer(text):
        yield "access", found.start(), found.end()
    for found in _HEX.finditer(text):
        yield "hex", found.start(), found.end()


def parts(text: str) -> list[tuple[str, int, int, str, bool, int]]:
    """(kind, start, end, role, weak, scope) of every base match and weak candidate; scopes end at blank lines."""
    found = [
        (kind, start, end, {"assign": "secret", "access": "identifier"}.get(kind, "secret" if end - start >= SECRET_HEX else ""), False)
        for kind, start, end in base_matches(text)
    ]
    taken = sorted((start, end) for _, start, end, _, _ in found)
    starts = [start for start, _ in taken]
    reached = list(accumulate((end for _, end in taken), max))

    def is_free(start: int, end: int) -> bool:
        k = bisect_right(starts, end - 1)
        return not (k and reached[k - 1] > start)

    weak = []
    if "=" in text or ":" in text:
        weak += [("identifier", m.start(), m.end()) for m in _IDENTIFIER.finditer(text)]
        weak += [("endpoint", m.start(), m.end()) for m in _ENDPOINT.finditer(text)]
    places = sorted((start, end) for kind, start, end in weak if kind == "endpoint")
    ends = [start for start, _ in places]
    for m in _SECRET.finditer(text):
        k = bisect_right(ends, m.start())
        if _random_like(m.group()) and not (k and places[k - 1][1] > m.start()):
            weak.append(("secret", m.start(), m.end()))
    found += [(kind, start, end, kind, True) for kind, start, end in weak if is_free(start, end)]
    if not found:
        return []
    scope_ends = [m.start() for m in _SCOPE_END.finditer(text)] if any(part[4] for part in found) else []
    return [(*part, bisect_right(scope_ends, part[1])) for part in found]


_PART = "struct<kind:string,start:bigint,`end`:bigint,role:string,weak:boolean,scope:bigint>"


def parts_column(text: str | Column) -> Column:
    @F.arrow_udf(f"array<{_PART}>")
    def credential_parts(texts: pa.Array) -> pa.Array:
        names = ("kind", "start", "end", "role", "weak", "scope")
        kind = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("role", pa.string()), ("weak", pa.bool_()), ("scope", pa.int64())])
        )
        return pa.array([[dict(zip(names, part, strict=True)) for part in parts(text.as_py())] for text in texts], kind)

    return credential_parts(text_or_empty(text))


def linked(found: DataFrame) -> DataFrame:
    """Weak candidates of (key_id, key_text, parts) beside which the other parts stand in the same scope.

    A weak identifier needs a secret, a weak secret an identifier or an endpoint, an endpoint both others; parts that
    overlap a candidate don't count. Some part of a role stands clear of a stretch if the first end of that role in the scope lies before
    it or the last start behind it. So the interval join needs two numbers per scope and role, and a scope
    full of parts, however long, gives no pairs.
    """
    flat = found.select("key_id", "key_text", F.explode("parts").alias("part")).select("key_id", "key_text", "part.*").distinct()
    place = ["key_id", "key_text", "scope"]
    others = (
        flat.where("role <> ''")
        .groupBy(*place, "role")
        .agg(F.min("end").alias("first_end"), F.max("start").alias("last_start"))
        .withColumnRenamed("role", "other")
    )
    met = flat.where("weak").join(others, place).where(
        (F.col("other") != F.col("role")) & ((F.col("first_end") <= F.col("start")) | (F.col("last_start") >= F.col("end")))
    )
    has_secret, n = F.max((F.col("other") == "secret").cast("int")), F.count_distinct("other")
    needed = F.when(F.col("role") == "identifier", F.col("has_secret") == 1).when(F.col("role") == "secret", F.col("n") > 0).otherwise(F.col("n") == 2)
    return (
        met.groupBy("key_id", "key_text", "kind", "start", "end", "role")
        .agg(has_secret.alias("has_secret"), n.alias("n"))
        .where(needed)
        .groupBy("key_id", "key_text")
        .agg(F.collect_list(F.struct("kind", "start", "end")).alias("linked"))
    )


def scan(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, base, spans), one row per row of ``documents``: arrays of (kind, start, end).

    Starts count code points, ends are exclusive, and spans are ordered by start, kind and end. base has the matches
    of the three fixed patterns; spans adds weak candidates whose other parts stand in the same scope (up to a blank line), however far away. A null or empty text has none. A missing
    doc_id stays null; repeated rows come out repeated. Only doc_id and text are read, so further columns may have
    any name. No rows give no rows."""
    key_id, key_text = row_key(documents, doc_id, text)
    found = stored(
        documents.select(F.col(doc_id).alias("doc_id"), key_id, key_text, parts_column(text).alias("parts")), "credential-parts"
    )
    spans = linked(found.where(F.exists("parts", lambda part: part["weak"]))).select(
        F.col("key_id").alias("of_id"), F.col("key_text").alias("of_text"), "linked"
    )
    base = F.transform(
        F.filter("parts", lambda part: ~part["weak"]),
        lambda part: F.struct(part["kind"].alias("kind"), part["start"].alias("start"), part["end"].alias("end")),
    )
    none = F.array().cast("array<struct<kind:string,start:bigint,`end`:bigint>>")
    joined = found.join(spans, (F.col("key_id") == F.col("of_id")) & (F.col("key_text") == F.col("of_text")), "left")
    return joined.select(
        "doc_id", in_order(base).alias("base"), in_order(F.concat(base, F.coalesce("linked", none))).alias("spans")
    )


def in_order(spans: Column) -> Column:
    """Spans by start, then kind in the order of KINDS, then end."""
    kinds = F.array(*map(F.lit, KINDS))
    keyed = F.transform(
        spans,
        lambda span: F.struct(
            span["start"].alias("start"), F.array_position(kinds, span["kind"]).alias("place"), span["end"].alias("end")
        ),
    )
    return F.transform(
        F.array_sort(keyed),
        lambda key: F.struct(
            F.element_at(kinds, key["place"].cast("int")).alias("kind"), key["start"].alias("start"), key["end"].alias("end")
        ),
    )


def spelled(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.concat_ws(
        ",", F.transform(spans, lambda span: F.concat_ws(":", span["kind"], span["start"].cast("string"), span["end"].cast("string")))
    )


shipped(__name__)
