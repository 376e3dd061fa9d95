"""Z-score scaling with the population standard deviation.

``ml.feature.StandardScaler`` divides by the sample std, so the fit is one
``agg(avg, stddev_pop)`` pass; the driver receives 2 x d scalars and the
transform is a projection of literals (constant-folded, codegen).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_zscore(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    stats = {}
    for c in cols:
        m, s = row[f"m_{c}"], row[f"s_{c}"]
        stats[c] = (m if m is not None else 0.0, s if s not in (None, 0.0) else 1.0)
    return stats


def apply_zscore(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in stats.items()})


def zscore(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return apply_zscore(df, fit_zscore(df, cols))
