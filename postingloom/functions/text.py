"""SQL fragments for text, shared by the posting rules.

Fragments are strings: a rule with dozens of word tests is handed to Spark as
one expression instead of dozens of calls, and reads the same in SQL.
"""

from __future__ import annotations

# Every character that counts as whitespace when text is stripped: the Unicode
# White_Space set plus the four ASCII separators. SQL's own trim() only knows
# the blank.
WHITESPACE = "".join(
    chr(code)
    for code in [
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
        *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    ]
)


def literal(value: str) -> str:
    """A SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return "'" + "".join(c if c.isprintable() else f"\\u{ord(c):04x}" for c in escaped) + "'"


def lowered_text(*parts: str) -> str:
    """Lower-cased parts joined by one blank; a missing part counts as empty.

    The blank is what lets a phrase match across the seam of two parts.
    """
    present = [f"coalesce({p}, '')" for p in parts]
    return f"lower({present[0]})" if len(present) == 1 else f"lower(concat_ws(' ', {', '.join(present)}))"


def lowered_bytes(*parts: str) -> str:
    """:func:`lowered_text` in UTF-8, for many tests on long text: a search in
    bytes finds the same words and takes about half the time."""
    return f"CAST({lowered_text(*parts)} AS BINARY)"


def mentions(text: str, word: str, in_bytes: bool = False) -> str:
    """True where ``word`` occurs in ``text`` as a bare substring."""
    return f"contains({text}, CAST({literal(word)} AS BINARY))" if in_bytes else f"contains({text}, {literal(word)})"


def mentions_any(text: str, words: list[str], in_bytes: bool = False) -> str:
    return "(" + " OR ".join(mentions(text, w, in_bytes) for w in words) + ")"


def strip(text: str) -> str:
    return f"btrim({text}, {literal(WHITESPACE)})"


def blank_to_null(text: str) -> str:
    return f"nullif({text}, '')"
