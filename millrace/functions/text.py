"""Column expressions over strings; all stay in the JVM."""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, functions as F

# The ASCII punctuation that cleaning deletes. The backslash is kept on
# purpose: the pattern whose results we match escapes the bracket with it.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~"


def plural(word: Column) -> Column:
    return F.concat(word, F.lit("s"))


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends (`trim` removes blanks only)."""
    return F.regexp_replace(text, r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$", "")


def clean(text: Column) -> Column:
    """Lower case, strip, delete ASCII punctuation."""
    return F.translate(strip(F.lower(text)), PUNCTUATION, "")


def words(text: Column) -> Column:
    """Split on single blanks; neighbouring blanks give empty words."""
    return F.split(text, " ")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, as a byte-wise reader does; other letters are left alone."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def tokens(text: Column) -> Column:
    """Runs of ASCII letters, digits and underscores, lower-cased, in order."""
    return F.filter(F.split(ascii_lower(text), r"\W+"), lambda token: token != "")


def remove_quotes(text: Column) -> Column:
    return F.translate(text, '"', "")


def tabs_to_commas(text: Column) -> Column:
    return F.translate(text, "\t", ",")


def captures(line: Column, pattern: str) -> Column:
    """All groups of `pattern` as an array after one regex pass; when the line does
    not match, an array holding just the line (see `captured`).

    A text line holds no line feed, so the groups can be joined by line feeds and
    split again; this replaces one regex evaluation per group.
    """
    groups = _group_count(pattern)
    joined = "\n".join(f"${i + 1}" for i in range(groups))
    rewritten = F.regexp_replace(line, pattern + r"(?s:.*)$", joined)
    return F.split(rewritten, "\n")


def captured(parts: Column, pattern: str, group: int) -> Column:
    """Group number `group` (from 1) out of `captures`, NULL when nothing matched."""
    return F.when(F.size(parts) == _group_count(pattern), F.get(parts, F.lit(group - 1)))


def _group_count(pattern: str) -> int:
    return re.compile(pattern.replace("(?d)", "")).groups


def fixed_three(value: Column) -> Column:
    """Format to three decimals with the rounding of C's `%.3f` (exact binary value,
    ties to even). Splitting off a 24-bit head keeps both products exact; sound for
    magnitudes below 2**24.
    """
    head = value.cast("float").cast("double")
    scaled_head = head * 1000.0
    scaled_tail = (value - head) * 1000.0
    whole = F.floor(scaled_head)
    side = (scaled_head - whole - 0.5) + scaled_tail
    up = F.when(side > 0, 1).when(side < 0, 0).otherwise(F.pmod(whole, F.lit(2)))
    return F.format_string("%.3f", (whole + up) / F.lit(1000.0))


def rating_key(value: Column, name: Column) -> Column:
    """Composite sort key: the number as text with three decimals, a blank, the name."""
    return F.concat_ws(" ", fixed_three(value), name)
