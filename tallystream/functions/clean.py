"""Text to numbers and names, as JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_DIGITS = "0123456789"
_NUMBER_MARKS = r"^[0-9.\-]+\z"

# Every character that counts as white space at the ends of a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip_text(text: Column) -> Column:
    """Remove white space at both ends, no-break space included."""
    return F.trim(text, F.lit(WHITE_SPACE))


def number_text(text: Column) -> Column:
    """A cell without ``+``, ``%``, commas, spaces; an empty cell reads as zero."""
    bare = text
    for mark in "+%, ":
        bare = F.replace(bare, F.lit(mark), F.lit(""))
    # Looking for other white space costs more than the rest, and numbers rarely have any.
    return F.when(text == "", F.lit("0")).when(bare.rlike(_NUMBER_MARKS), bare).otherwise(strip_text(bare))


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.translate(text, char, ""))


def number_value(bare: Column, allow_negative: bool = True) -> Column:
    """Value of such a text, or null where it is no number.

    A cast alone would take exponents, type letters and words such as NaN, so other characters
    are ruled out first.
    """
    only_marks = bare.rlike(_NUMBER_MARKS)
    shaped = (_count(bare, _DIGITS) > 0) & (_count(bare, ".") <= 1) & (_count(bare, "-") <= 1)
    number = F.coalesce(bare.try_cast("double"), F.when(shaped, F.lit(0.0)))
    if not allow_negative:
        only_marks = only_marks & ~bare.contains("-")
    return F.when(only_marks, number)


def clean_number(text: Column, allow_negative: bool = True) -> Column:
    """Number in a scraped cell, or null where the text is not one.

    Text made of digits, one dot and one minus that still is no number ("5-3") counts as 0.0.
    """
    return number_value(number_text(text), allow_negative)


def is_rejected_number(text: Column, allow_negative: bool = True) -> Column:
    return text.isNotNull() & clean_number(text, allow_negative).isNull()


def percent_fraction(text: Column) -> Column:
    """``25%`` as 0.25; text without the sign keeps its value."""
    bare = strip_text(F.translate(text, ",", ""))
    percent = bare.endswith("%")
    digits = F.when(percent, F.substr(bare, F.lit(1), F.length(bare) - 1)).otherwise(bare)
    number = F.when(digits.rlike(_NUMBER_MARKS), digits.try_cast("double"))
    return F.when(percent, number / 100).otherwise(number)


def is_digits(text: Column) -> Column:
    return text.rlike(r"^[0-9]+\z")


def normalize_header(text: Column, blank: Column | str = "Unknown") -> Column:
    """Metric name of a row label: blanks to ``_``, no ``+``, nothing hanging off the ends."""
    blank = F.lit(blank) if isinstance(blank, str) else blank
    joined = F.translate(text, " +", "_")
    name = F.rtrim(F.ltrim(joined, F.lit(WHITE_SPACE)), F.lit(WHITE_SPACE + "_"))
    return F.when(name == "", blank).otherwise(name)


def fill_number(value: Column) -> Column:
    """Null and NaN metrics count as zero."""
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def parse_mark(text: Column) -> Column:
    """Progress mark as an instant; null when there is none yet.

    Empty or unreadable text and the year-one placeholder all mean "start from the beginning".
    """
    instant = F.try_to_timestamp(strip_text(text))
    return F.when(instant >= F.lit("0002-01-01 00:00:00").cast("timestamp"), instant)
