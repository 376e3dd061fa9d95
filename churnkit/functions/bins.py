"""Binning and derived-category expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def right_closed_bins(c, edges: Sequence[float], labels: Sequence[str], include_lowest: bool = True) -> Column:
    """``pd.cut`` semantics: intervals (e_i, e_{i+1}]; values outside -> NULL.

    With ``include_lowest`` the first interval is closed on the left too.
    ``ml.feature.Bucketizer`` is left-closed, so a ``when`` chain is used.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    x = _c(c)
    expr = None
    for i, lab in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        lower = (x >= F.lit(lo)) if (i == 0 and include_lowest) else (x > F.lit(lo))
        cond = lower & (x <= F.lit(hi)) if hi != float("inf") else lower
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def bin_ordinal(c, edges: Sequence[float], include_lowest: bool = True) -> Column:
    """Integer position of the interval (0-based) for ordering labelled bins."""
    return right_closed_bins(c, edges, [str(i) for i in range(len(edges) - 1)], include_lowest).cast("int")


# Cohort edges and labels of the reference's OLAP views.
TENURE_EDGES = (0, 12, 24, 48, 72)
TENURE_LABELS = ("0-12 mo", "13-24 mo", "25-48 mo", "49-72 mo")
CHARGE_EDGES = (0, 35, 65, 90, float("inf"))
CHARGE_LABELS = ("$0-35", "$35-65", "$65-90", "$90+")


def tenure_cohort(c, edges=TENURE_EDGES, labels=TENURE_LABELS) -> Column:
    """Tenure cohort, lowest edge included (P10)."""
    return right_closed_bins(c, edges, labels, include_lowest=True)


def charge_cohort(c, edges=CHARGE_EDGES, labels=CHARGE_LABELS) -> Column:
    """Charge cohort, lowest edge excluded so 0 -> NULL."""
    return right_closed_bins(c, edges, labels, include_lowest=False)


def pay_type(c, token: str = "automatic", yes: str = "Auto-pay", no: str = "Manual") -> Column:
    """Case-insensitive substring test (P12); NULL input -> NULL."""
    x = _c(c)
    return F.when(F.lower(x).contains(token.lower()), F.lit(yes)).when(x.isNotNull(), F.lit(no))


def service_count(cols: Sequence[str], yes: str = "Yes") -> Column:
    """Number of columns equal to ``yes``."""
    parts = [F.when(F.col(c) == F.lit(yes), 1).otherwise(0) for c in cols]
    return reduce(lambda a, b: a + b, parts).cast("int")
