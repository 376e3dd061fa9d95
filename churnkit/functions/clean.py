"""Cleaning expressions (P1, P2, P9).  All are JVM-side Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: A number as text: digits with an optional sign, fraction and exponent.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def strip(text) -> Column:
    """The text without any white space (also tabs, line ends) at its ends."""
    return F.regexp_replace(_c(text), r"^\s+|\s+$", "")


def is_blank(text) -> Column:
    """True where the stripped text is empty (NULL stays NULL)."""
    return strip(text) == F.lit("")


def lenient_double(text) -> Column:
    """Strip then parse; anything that is not a number (blank, garbage, ``12d``) becomes NULL.

    ``try_cast`` keeps this safe under ANSI mode, where a plain cast raises.
    """
    t = strip(text)
    return F.when(t.rlike(NUMBER), t.try_cast("double"))


def impute_blank(text, fallback) -> Column:
    """Blank text takes ``fallback``; garbage that fails parsing stays NULL."""
    return F.when(is_blank(text), _c(fallback)).otherwise(lenient_double(text))


def finite_or_zero(c) -> Column:
    """Cast to double, replace NULL, NaN and +-inf by 0."""
    x = _c(c).cast("double")
    bad = x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(x)
