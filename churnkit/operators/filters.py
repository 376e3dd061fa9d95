"""Row filters (F1-F7).  Each returns a lazily filtered DataFrame, so Catalyst
can push the predicates into the Parquet scan."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.functions.encode import normalise_name


def readable_filter(df: DataFrame, selections: dict | None = None, flag_col: str | None = None,
                    flag_state: str | None = None, flag_labels=("Senior", "Non-Senior")) -> DataFrame:
    """``col IN (...)`` per non-empty selection, ANDed; tri-state flag filter.

    ``flag_state`` equal to ``flag_labels[0]`` keeps flag = 1, ``flag_labels[1]``
    keeps flag = 0, anything else keeps all rows.
    """
    preds = [F.col(c).isin(list(v)) for c, v in (selections or {}).items() if v]
    if flag_col and flag_state == flag_labels[0]:
        preds.append(F.col(flag_col) == 1)
    elif flag_col and flag_state == flag_labels[1]:
        preds.append(F.col(flag_col) == 0)
    return df.where(reduce(and_, preds)) if preds else df


def onehot_filter(df: DataFrame, selections: dict | None = None) -> DataFrame:
    """selections on one-hot columns: OR inside a dimension, AND across.

    Values whose one-hot column is absent are skipped; a dimension with no
    usable value adds no predicate.
    """
    present = set(df.columns)
    preds = []
    for dim, values in (selections or {}).items():
        cols = [normalise_name(f"{dim}_{v}") for v in (values or [])]
        cols = [c for c in cols if c in present]
        if cols:
            preds.append(reduce(or_, [F.col(c) == 1 for c in cols]))
    return df.where(reduce(and_, preds)) if preds else df


def focus_slice(df: DataFrame, col: str | None = None, value=None) -> DataFrame:
    """``col = value`` or no filter."""
    return df.where(F.col(col) == F.lit(value)) if col and value is not None else df


def exclude_noise(df: DataFrame, cluster_col: str, noise: int = -1) -> DataFrame:
    """drop the noise cluster."""
    return df.where(F.col(cluster_col) != noise)


def drill_through(df: DataFrame, cohort: DataFrame, key: str) -> DataFrame:
    """Keep rows whose key is in ``cohort`` (left semi join).

    The cohort is a DataFrame of keys, never a driver-side list, so it can be
    as large as the table; Catalyst picks broadcast or shuffle by its size.
    """
    return df.join(cohort.select(key).distinct(), key, "left_semi")
