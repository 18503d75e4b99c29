"""Trimming, text-to-number casts, text matching and number formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marklens.functions.scoring import raw_mean
from marklens.spec import DEFAULT_SPEC, ScorecardSpec

# The characters Python counts as white space.
_WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Only these characters may occur; the cast does the rest. Left to itself it
# would read "5d" as a number, and be slow on text that is none.
_WHOLE_NUMBER = "^[-+0-9]+$"
_REAL_NUMBER = "^[-+.0-9eE]+$"


def strip(column: Column) -> Column:
    """Without white space at either end, as ``str.strip`` leaves it."""
    return F.trim(column, F.lit(_WHITE_SPACE))


def to_long(column: Column) -> Column:
    """Whole number in a text, or null."""
    return _number(column, _WHOLE_NUMBER, "bigint")


def to_double(column: Column) -> Column:
    """Number in a text, or null; the words "NaN" and "inf" count as no number."""
    return _number(column, _REAL_NUMBER, "double")


def _number(column: Column, pattern: str, type_name: str) -> Column:
    """Text that is a number as it stands is not trimmed first."""
    stripped = strip(column)
    return F.when(column.rlike(pattern), column.try_cast(type_name)).when(
        stripped.rlike(pattern), stripped.try_cast(type_name)
    )


def matches_pattern(
    pattern: str, spec: ScorecardSpec = DEFAULT_SPEC
) -> Column:
    """Case-insensitive regular expression in the name or in the key's text."""
    ignoring_case = "(?iu)" + pattern
    return _in_name_or_key(lambda text: text.rlike(ignoring_case), spec)


def contains_text(text: str, spec: ScorecardSpec = DEFAULT_SPEC) -> Column:
    """Case-insensitive plain text in the name or in the key's text."""
    needle = F.lower(F.lit(text))
    return _in_name_or_key(lambda value: F.lower(value).contains(needle), spec)


def _in_name_or_key(test, spec: ScorecardSpec) -> Column:
    no = F.lit(False)
    return F.coalesce(test(F.col(spec.name)), no) | F.coalesce(
        test(F.col(spec.key).cast("string")), no
    )


def fixed(column: Column, digits: int) -> Column:
    """Text with a fixed number of decimals.

    ``format_number`` rounds the exact binary value half to even, which is what
    Python's ``f"{x:.1f}"`` does; ``format_string`` would round half up.
    """
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function("format_number", column, F.lit(pattern))


def percent(column: Column, digits: int = 2) -> Column:
    """A ratio as percent text."""
    return F.concat(fixed(column * 100, digits), F.lit("%"))


def round_half_even(column: Column, digits: int) -> Column:
    """Python's ``round`` on a double; ``F.round`` rounds half up."""
    return fixed(column, digits).cast("double")


def average_preview(spec: ScorecardSpec = DEFAULT_SPEC) -> Column:
    """The average as shown before a record is stored."""
    return round_half_even(raw_mean(spec), 2)


def explanation(spec: ScorecardSpec = DEFAULT_SPEC) -> Column:
    """One sentence with the values a prediction rests on."""
    # The wording.
    return F.concat(
        F.lit("Entered marks average: "),
        fixed(raw_mean(spec), 1),
        F.lit("/100; attendance: "),
        fixed(F.col(spec.attendance), 0),
        F.lit("%; study time: "),
        fixed(F.col(spec.hours), 1),
        F.lit(" hours/day. "),
        F.lit("This is a demonstration prediction based on synthetic data."),
    )
