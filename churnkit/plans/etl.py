"""Layered ETL: raw -> staging -> curated (reference lifecycle L1).

Each layer is a lazy projection of the previous one; ``write_layers``
persists them as Parquet under a shared folder (E3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.functions.clean import finite_or_zero
from churnkit.functions.encode import addon_encode, binary_encode, onehot_columns
from churnkit.operators.scaling import apply_zscore, fit_zscore
from churnkit.spec import DEFAULT_SPEC, ChurnSpec


def discover_levels(df: DataFrame, cols) -> dict[str, list[str]]:
    """Sorted distinct non-NULL levels per categorical column.

    Each level becomes a column of the result, so the list must reach the driver;
    its rows are counted down by partial aggregation, never gathered in one task.
    """
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols])).alias("x"))
    out: dict[str, list[str]] = {c: [] for c in cols}
    for r in pairs.where("x.v IS NOT NULL").select("x.c", "x.v").distinct().collect():
        out[r["c"]].append(r["v"])
    return {c: sorted(v) for c, v in out.items()}


def fit_encoding(raw: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> tuple[dict, dict]:
    """Everything the staging and curated layers learn from the data: one-hot
    levels, and the z-score mean / population std of the numeric columns (the
    values are unchanged by staging)."""
    levels = discover_levels(raw, spec.onehot) if spec.onehot else {}
    row = raw.agg(*[f(c).alias(f"{k}_{c}") for c in spec.numeric for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    stats = {c: (row[f"m_{c}"] if row[f"m_{c}"] is not None else 0.0,
                 row[f"s_{c}"] if row[f"s_{c}"] not in (None, 0.0) else 1.0) for c in spec.numeric}
    return levels, stats


def curated_from_raw(raw: DataFrame, spec: ChurnSpec = DEFAULT_SPEC, passthrough=()) -> DataFrame:
    """raw -> staging -> curated with a single fitting pass; ``passthrough`` raw
    columns ride along unchanged (no join back on the key)."""
    levels, stats = fit_encoding(raw, spec)
    return curated_layer(staging_layer(raw, spec, levels, passthrough), spec, stats)


def staging_layer(raw: DataFrame, spec: ChurnSpec = DEFAULT_SPEC, levels: dict | None = None,
                  passthrough=()) -> DataFrame:
    """Binary and add-on encodings, one-hot with all levels, normalised names."""
    levels = levels or discover_levels(raw, spec.onehot)
    cols = [F.col(spec.key)] + [F.col(c).alias(f"raw_{c}") for c in passthrough]
    cols += [binary_encode(c).alias(c) for c in spec.binary]
    cols += [F.col(c).cast("int").alias(c) for c in spec.flags]
    cols += [F.col(c) for c in spec.numeric]
    cols += [addon_encode(c).alias(c) for c in spec.addons]
    cols += [binary_encode(spec.label).alias(spec.label)]
    for c in spec.onehot:
        cols += onehot_columns(c, levels[c])
    return raw.select(*cols)


def feature_columns(staging: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> list[str]:
    """Model features: every staging column except the key and the label."""
    return [c for c in staging.columns if c not in (spec.key, spec.label)]


def curated_layer(staging: DataFrame, spec: ChurnSpec = DEFAULT_SPEC, stats: dict | None = None) -> DataFrame:
    """Z-score of the numeric columns (population std); the key stays."""
    stats = stats or fit_zscore(staging, spec.numeric)
    return apply_zscore(staging, stats)


def model_matrix(curated: DataFrame, spec: ChurnSpec = DEFAULT_SPEC, features=None) -> DataFrame:
    """P7+P9: explicit feature order, finite doubles, key and 0/1 label kept."""
    feats = features or feature_columns(curated, spec)
    return curated.select(spec.key, *[finite_or_zero(c).alias(c) for c in feats],
                          F.col(spec.label).cast("int").alias(spec.label))


def build_layers(raw: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> dict[str, DataFrame]:
    levels, stats = fit_encoding(raw, spec)
    staging = staging_layer(raw, spec, levels)
    return {"raw": raw, "staging": staging, "curated": curated_layer(staging, spec, stats)}


def write_layers(spark: SparkSession, layers: dict[str, DataFrame], out_dir: str,
                 partition_by: dict | None = None) -> dict[str, str]:
    """Overwrite one Parquet folder per layer; returns the paths."""
    paths = {}
    for name, df in layers.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        w = df.write.mode("overwrite")
        if partition_by and name in partition_by:
            w = w.partitionBy(*partition_by[name])
        w.parquet(path)
        paths[name] = path
    return paths
