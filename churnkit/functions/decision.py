"""Decision and deviation expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def threshold_decision(p, t, yes=1, no=0) -> Column:
    """``p >= t`` -> yes else no (P15). ``t`` may be a column or number."""
    t = _c(t) if isinstance(t, (str, Column)) else F.lit(float(t))
    return F.when(_c(p) >= t, F.lit(yes)).otherwise(F.lit(no))


def outcome_label(pred, actual) -> Column:
    """TP/FP/FN/TN from 0/1 predicted and actual."""
    p, a = _c(pred), _c(actual)
    return (F.when((p == 1) & (a == 1), "TP").when((p == 1) & (a == 0), "FP")
            .when((p == 0) & (a == 1), "FN").when((p == 0) & (a == 0), "TN"))


def distance_pp(p, t) -> Column:
    """Distance to threshold in percentage points."""
    t = _c(t) if isinstance(t, (str, Column)) else F.lit(float(t))
    return F.abs(_c(p) - t) * 100.0


def pct_deviation(value, mean, eps: float = 1e-9) -> Column:
    """Percent deviation from a mean; NULL when |mean| < eps (P18, fixes the
    blow-up of the reference's exact-zero guard)."""
    v, m = _c(value), _c(mean)
    return F.when(F.abs(m) < F.lit(eps), F.lit(None).cast("double")).otherwise((v - m) / F.abs(m) * 100.0)


def deviation_band(pct) -> Column:
    """Colour band of a % deviation: > 50 red, > 20 orange, else grey."""
    a = F.abs(_c(pct))
    return F.when(a > 50, "red").when(a > 20, "orange").otherwise("grey")


def minmax_normalise(m, lo, hi, floor: float = 1e-9) -> Column:
    """(m - lo) / max(hi - lo, floor)."""
    return (_c(m) - _c(lo)) / F.greatest(_c(hi) - _c(lo), F.lit(floor))


def odds_ratio(coef) -> Column:
    """exp(coefficient) (P20)."""
    return F.exp(_c(coef))


def flip(score) -> Column:
    """Orientation flip so higher = more anomalous."""
    return -_c(score)


def sigmoid(z) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(z)))
