"""The posting rules. Each takes column names (or SQL expressions) and returns
a column.

All of them are built-in expressions, so they stay inside generated code.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as V
from .text import blank_to_null, literal, lowered_bytes, lowered_text, mentions, mentions_any, strip


# ---- classification -------------------------------------------------------

def work_mode(title: str = "title", description: str = "description") -> Column:
    """on_site / hybrid / remote / unknown.

    The order of the tests carries meaning: "no remote" must be seen before
    "remote" is.
    """
    text = lowered_bytes(title, description)
    return F.expr(
        f"""CASE WHEN {mentions_any(text, V.ON_SITE_WORDS, in_bytes=True)} THEN 'on_site'
                 WHEN {mentions_any(text, V.HYBRID_WORDS, in_bytes=True)} THEN 'hybrid'
                 WHEN {mentions_any(text, V.REMOTE_WORDS, in_bytes=True)} THEN 'remote'
                 ELSE 'unknown' END"""
    )


def is_noise(title: str = "title") -> Column:
    """Titles that feed A drops while extracting (bare substrings)."""
    return F.expr(mentions_any(lowered_text(title), V.NOISE_WORDS))


def is_relevant(title: str = "title") -> Column:
    """A wanted role is named and no off-topic word is; never NULL."""
    text = lowered_text(title)
    return F.expr(f"{mentions_any(text, V.ROLE_WORDS)} AND NOT {mentions_any(text, V.OFF_TOPIC_WORDS)}")


def seniority(title: str = "title") -> Column:
    text = lowered_text(title)
    return F.expr(
        f"""CASE WHEN {mentions_any(text, V.SENIOR_WORDS)} THEN 'senior'
                 WHEN {mentions_any(text, V.JUNIOR_WORDS)} THEN 'junior'
                 ELSE 'unknown' END"""
    )


def seniority_by_regex(title: str = "title") -> Column:
    """The same decision as :func:`seniority`, stated as two patterns."""
    text = lowered_text(title)
    senior, junior = (
        literal("|".join(re.escape(w).replace("\\ ", " ") for w in words))
        for words in (V.SENIOR_WORDS, V.JUNIOR_WORDS)
    )
    return F.expr(f"CASE WHEN {text} RLIKE {senior} THEN 'senior' WHEN {text} RLIKE {junior} THEN 'junior' ELSE 'unknown' END")


# ---- skills ---------------------------------------------------------------
# A posting's skills travel through the fold as BIGINT columns with a bit per
# vocabulary entry, 63 entries to a column: fixed-width values that ``bit_or``
# unions before the shuffle, however many entries there are. All entries are
# tests in generated code; a vocabulary of thousands is data for
# ``operators.mentions``.

#: Entries per column; the sign bit stays free.
MASK_BITS = 63


def mask_names(skills: Sequence[str] = V.SKILLS) -> list[str]:
    """The columns that hold the masks of a vocabulary."""
    more = range(1, -(-len(skills) // MASK_BITS))
    return ["skill_mask", *[f"skill_mask_{k}" for k in more]]


def searchable_text(title: str = "title", description: str = "description") -> Column:
    """What skills are looked for in. Keep it in a column of its own: the tests
    of :func:`skill_masks` read it more than twenty times."""
    return F.expr(lowered_bytes(title, description))


def _mentions_skill(text: str, skill: str, skills: Sequence[str]) -> str:
    """A skill that contains another one ("mysql", "sql") is only looked for
    where the shorter one was found, whose test is shared."""
    shorter = [s for s in skills if s != skill and s in skill]
    return " AND ".join(mentions(text, s, in_bytes=True) for s in [*shorter, skill])


def skill_masks(text: str, skills: Sequence[str] = V.SKILLS) -> dict[str, Column]:
    """The mask columns: bit ``i`` of column ``k`` is set where skill ``63 k + i`` occurs in a searchable text."""
    masks = {}
    for k, name in enumerate(mask_names(skills)):
        own = skills[k * MASK_BITS : (k + 1) * MASK_BITS]
        tests = [f"IF({_mentions_skill(text, skill, skills)}, {1 << i}L, 0L)" for i, skill in enumerate(own)]
        masks[name] = F.expr(" + ".join(tests or ["0L"]))
    return masks


def skills_in_mask(skills: Sequence[str] = V.SKILLS) -> Column:
    """The skill names of the mask columns as an array in vocabulary order."""
    return _in_mask([literal(skill) for skill in skills], skills)


def skill_ids_in_mask(skills: Sequence[str] = V.SKILLS) -> Column:
    """The keys of the skills in the mask columns. Each is worked out once, not once per row."""
    return _in_mask([_surrogate_key(literal(skill)) for skill in skills], skills)


def _in_mask(values: list[str], skills: Sequence[str]) -> Column:
    # Stays in generated code, unlike a filter with a lambda.
    names = mask_names(skills)
    tests = [f"IF(({names[i // MASK_BITS]} & {1 << i % MASK_BITS}L) != 0, {value}, '')" for i, value in enumerate(values)]
    return F.expr(f"array_remove(array({', '.join(tests)}), '')" if tests else "CAST(array() AS ARRAY<STRING>)")


# ---- geography ------------------------------------------------------------

def country_code(country: str = "country") -> Column:
    return F.expr(f"upper({blank_to_null(country)})")


def city_name(country: str = "country", location: str = "location") -> Column:
    """Text before the first comma, stripped; NULL without country or comma."""
    before = strip(f"substring_index({location}, ',', 1)")
    return F.expr(f"CASE WHEN {blank_to_null(country)} IS NOT NULL AND contains({location}, ',') THEN {before} END")


def city_text_before_comma(location: str = "location") -> Column:
    """Untrimmed text before the first comma, or all of it without a comma."""
    return F.expr(f"split_part({location}, ',', 1)")


def country_name(code: str = "country_code") -> Column:
    """Name of a country code; an unlisted code is its own name."""
    names = ", ".join(f"{literal(c)}, {literal(n)}" for c, n in V.COUNTRY_NAMES.items())
    return F.expr(f"coalesce(try_element_at(map({names}), lower({code})), upper({code}))")


# ---- other attributes -----------------------------------------------------

def company_or_unknown(company: str = "company_name") -> Column:
    return F.expr(f"coalesce({blank_to_null(company)}, {literal(V.UNKNOWN_COMPANY)})")


def _given(text: str) -> str:
    return blank_to_null(f"nullif({text}, 'None')")


def salary(text: str) -> Column:
    """DECIMAL(10,2) rounded half up; NULL for missing and unreadable text."""
    return F.expr(f"try_cast({_given(text)} AS DECIMAL(10,2))")


def salary_is_malformed(text: str) -> Column:
    """Text is there, yet it is no amount that fits the column; never NULL."""
    return F.expr(f"{_given(text)} IS NOT NULL AND try_cast({_given(text)} AS DECIMAL(10,2)) IS NULL")


def extraction_time_text(text: str = "extracted_at") -> Column:
    """One UTC spelling with fixed microseconds for the two spellings in use.

    A text without an offset is UTC already; a text that is no timestamp is
    kept as it is. With one spelling, the greatest text is also the latest
    time. Counted from the epoch, so the session's time zone plays no part.
    """
    return F.expr(f"coalesce({_utc_text(text)}, {text})")


def _utc_text(text: str) -> str:
    zoned = f"IF({text} RLIKE '(Z|[+-][0-9][0-9]:?[0-9][0-9])$', {text}, concat({text}, 'Z'))"
    utc = f"timestampadd(MICROSECOND, unix_micros(try_to_timestamp({zoned})), timestamp_ntz'1970-01-01 00:00:00')"
    return f"date_format({utc}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"


def run_key(extracted_at: str = "extracted_at") -> Column:
    """Directory-friendly form of the extraction time; sorts like the time."""
    # The one spelling has no other signs than these; any other text is searched.
    return F.expr(
        f"coalesce(translate({_utc_text(extracted_at)}, '-:.+', ''), regexp_replace({extracted_at}, '[^0-9A-Za-z]', ''))"
    )


def run_time(key: Column) -> Column:
    """The extraction time that a run key was made from, to the second where
    that is exact; any other text stays as it is."""
    whole = F.regexp_replace(
        key, r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})(\d{6})$", "$1-$2-$3T$4:$5:$6.$7"
    )
    return F.regexp_replace(whole, r"\.000000$", "")


def publication_day(text: str = "publication_date") -> Column:
    """The day that a publication time begins with; NULL for other texts and for days that don't exist."""
    return F.expr(f"CASE WHEN {text} RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}' THEN try_cast(substring({text}, 1, 10) AS DATE) END")


# ---- keys and measures ----------------------------------------------------

def surrogate_key(*parts: str) -> Column:
    """Key computed from a natural key; NULL where any part is NULL.

    128 bits of SHA-256: the same on every run and every executor, so foreign
    keys are projections and need no lookup join.
    """
    return F.expr(_surrogate_key(*parts))


def _surrogate_key(*parts: str) -> str:
    natural = ", '\\u0000', ".join(parts)
    return f"substring(sha2(concat({natural}), 256), 1, 32)"


def percent_of(part: str, total: str) -> Column:
    """``part`` as a percentage of ``total``, one decimal, rounded half up.

    Worked out on integers so that no binary fraction decides a tie; NULL when
    ``total`` is 0.
    """
    whole = f"nullif({total}, 0L)"
    return F.expr(f"CAST((2000L * {part} + {whole}) DIV (2L * {whole}) AS DOUBLE) / 10")


def calendar_fields(day: str) -> list[Column]:
    return [
        F.expr(text)
        for text in (
            f"{day} AS date_id", f"year({day}) AS year", f"month({day}) AS month", f"day({day}) AS day",
            f"weekofyear({day}) AS week_of_year", f"date_format({day}, 'EEEE') AS day_name",
        )
    ]
