"""Expressions over free text: log parsing, trimming and zero-padded codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that say what a log contains. The first engineer
# pattern that matches anywhere in the text wins.
ENGINEER_PATTERNS = (
    r"(?:Technician|engineer)\s+([A-Z][a-z]+(?:\s[A-Z][a-z]+)+)",
    r"by\s+([A-Z][a-z]+(?:\s[A-Z][a-z]+)+)\s*[:\-–]",
    r"–\s+([A-Z][a-z]+(?:\s[A-Z][a-z]+)+)\s+–",
)
DURATION_PATTERN = r"(\d+)\s*min(?:utes?)?"
ESCALATION_PATTERN = r"escalat"
UNKNOWN_ENGINEER = "Unknown"

# Words one of which each engineer pattern needs, in the same order. A substring
# test is far cheaper than a failed regex search.
_ENGINEER_MARKERS = (("Technician", "engineer"), ("by",), ("–",))

# What a full strip removes; Spark's trim() removes the plain space only.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Makes \s and \d cover Unicode blanks and digits.
_UNICODE_CLASSES = "(?U)"


def engineer_matches(text: Column) -> list[Column]:
    """What each engineer pattern finds in a log, "" or null without a match.

    Project these first and pass the columns to ``engineer_name``, which looks at each of
    them more than once; a pattern then runs once per text.
    """
    found = []
    for pattern, markers in zip(ENGINEER_PATTERNS, _ENGINEER_MARKERS):
        has_marker = F.lit(False)
        for marker in markers:
            has_marker = has_marker | text.contains(marker)
        found.append(F.when(has_marker, F.regexp_extract(text, _UNICODE_CLASSES + pattern, 1)))
    return found


def engineer_name(text: Column, matches: list[Column]) -> Column:
    """Name of the engineer in a log: ``Unknown`` without a match, null for a null text."""
    names = [F.nullif(match, F.lit("")) for match in matches]
    return F.when(text.isNotNull(), F.coalesce(*names, F.lit(UNKNOWN_ENGINEER)))


def duration_minutes(text: Column) -> Column:
    """First ``<digits> min`` of a text as a bigint, null when there is none."""
    digits = F.when(
        text.contains("min"), F.regexp_extract(text, _UNICODE_CLASSES + DURATION_PATTERN, 1)
    )
    return F.nullif(digits, F.lit("")).try_cast("bigint")


def mentions_escalation(text: Column) -> Column:
    """True when the text speaks of an escalation, in any letter case."""
    return text.rlike("(?iu)" + ESCALATION_PATTERN)


def upper_strip(text: Column) -> Column:
    """Upper case, then without any leading or trailing white space."""
    return F.btrim(F.upper(text), F.lit(WHITESPACE))


def padded_code(prefix: str | Column, number: Column, width: int = 4) -> Column:
    """``prefix`` plus a zero-padded number that grows past ``width`` instead of losing digits."""
    digits = number.cast("string")
    head = prefix if isinstance(prefix, Column) else F.lit(prefix)
    return F.concat(head, F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def pick(values: list[str], index: Column) -> Column:
    """The element of a short literal list at a 0-based index column."""
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def fill(template: str, **fields: Column) -> Column:
    """A text built from a ``{name}`` template and one column per name."""
    pieces: list[Column] = []
    rest = template
    while "{" in rest:
        before, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        if before:
            pieces.append(F.lit(before))
        pieces.append(fields[name].cast("string"))
    if rest:
        pieces.append(F.lit(rest))
    return F.concat(*pieces)
