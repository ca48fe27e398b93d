"""Guarded numeric expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# A plain decimal number: digits, at most one dot, at most a minus sign in front.  These are the texts of
# the characters 0-9 . - that can be cast; sorting out the others (``--``, ``1-2``, ``1.2.3``) by pattern
# is far cheaper than a failing cast, which raises and catches an exception per row.
NUMBER_PATTERN = r"^-?([0-9]+\.?[0-9]*|\.[0-9]+)$"


def safe_double(text: Column, dtype: str = "double") -> Column:
    """The number in ``text``, or null when it is not a plain decimal number.

    Exponents, plus signs, blanks and thousands separators give null.  ``dtype="float"`` gives single
    precision, which cannot hold amounts above 16,777,216 exactly.
    """
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast(dtype))


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` where ``whole`` is positive, else null."""
    return F.when(whole > 0, part / whole)


def percent_change(first: Column, last: Column) -> Column:
    """Change from ``first`` to ``last`` in percent; null when ``first`` is zero."""
    return F.try_divide(last - first, first) * 100
