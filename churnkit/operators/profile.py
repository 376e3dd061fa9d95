"""Table profiling.

Wide single-pass aggregates wherever possible: one scan computes the
statistics of every column, and the one-row result is reshaped to long form
inside Spark (``inline`` of an array of structs), never on the driver.

Quantiles: ``exact=True`` uses ``churnkit.operators.quantiles`` (exact,
linear interpolation as in pandas/DuckDB, bounded per-task state: sketch
bracket + (value, count) pairs); ``exact=False`` returns the sketch
(``percentile_approx``) alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from churnkit.operators.quantiles import exact_quantiles

from churnkit.operators.ranking import join_null_safe


def _q(c, p, exact: bool = False, accuracy: int = 10000) -> Column:
    """Sketch quantile (bounded memory); exact quantiles go through ``exact_quantiles``."""
    col = F.col(c) if isinstance(c, str) else c
    return F.percentile_approx(col, list(p) if isinstance(p, (list, tuple)) else p, accuracy)


def _long(row_df: DataFrame, items: list[tuple[str, dict[str, Column]]], name_col: str = "column_name") -> DataFrame:
    """Reshape a one-row frame into one row per item (struct array + inline)."""
    structs = [F.struct(F.lit(n).alias(name_col), *[e.alias(k) for k, e in fields.items()]) for n, fields in items]
    return row_df.select(F.inline(F.array(*structs)))


def table_shape(df: DataFrame) -> DataFrame:
    """A1: row and column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def schema_table(df: DataFrame) -> DataFrame:
    """A1: column name, position and Spark type (built from the schema, no scan)."""
    spark = df.sparkSession
    rows = [(f.name, i, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "column string, position int, dtype string")


def missing_audit(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A2: NULL count, blank-string count and % missing per column (D12: blanks count)."""
    cols = list(cols or df.columns)
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        aggs.append(F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(f"n{i}"))
        blank = (F.when(F.trim(F.col(c)) == "", 1).otherwise(0) if isinstance(types[c], StringType) else F.lit(0))
        aggs.append(F.sum(blank).alias(f"b{i}"))
    one = df.agg(*aggs)
    items = [(c, {"n_null": F.col(f"n{i}").cast("long"), "n_blank": F.col(f"b{i}").cast("long"),
                  "pct_missing": F.round((F.col(f"n{i}") + F.col(f"b{i}")) * 100.0 / F.greatest(F.col("_n"), F.lit(1)),
                                         2)})
             for i, c in enumerate(cols)]
    return _long(one, items, "column_name")


def describe(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """A3: count, mean, sample std, min, quartiles (linear interpolation), max."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"c{i}"), F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}"),
                 F.min(c).cast("double").alias(f"lo{i}"), F.max(c).cast("double").alias(f"hi{i}")]
        if not exact:
            aggs.append(_q(c, [0.25, 0.5, 0.75], False).alias(f"q{i}"))
    one = df.agg(*aggs)
    quart = {}
    if exact:
        # all columns in one set of passes: long form grouped by column name
        long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "_col", "_v")
        qs = {(r["_col"], r["prob"]): r["quantile"]
              for r in exact_quantiles(long, "_v", [0.25, 0.5, 0.75], ["_col"]).collect()}
    for i, c in enumerate(cols):
        if exact:
            quart[c] = [F.lit(qs.get((c, p))).cast("double") for p in (0.25, 0.5, 0.75)]
        else:
            quart[c] = [F.col(f"q{i}")[j].cast("double") for j in range(3)]
    items = [(c, {"count": F.col(f"c{i}"), "mean": F.col(f"m{i}"), "std": F.col(f"s{i}"), "min": F.col(f"lo{i}"),
                  "p25": quart[c][0], "p50": quart[c][1], "p75": quart[c][2], "max": F.col(f"hi{i}")})
             for i, c in enumerate(cols)]
    return _long(one, items, "column_name")


def value_frequencies(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A4 + A5: count and share (%) of every value of every categorical column.

    ``unpivot`` then one groupBy; NULL values dropped like ``value_counts``.
    The percentage window runs over the aggregated rows only.
    """
    from pyspark.sql.window import Window

    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column_name", "value")
    counts = long.where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy("column_name")))


def distinct_counts(df: DataFrame, cols: Sequence[str], approx_rsd: float | None = None) -> DataFrame:
    """Distinct non-NULL values per column; ``approx_rsd`` switches to HLL++."""
    agg = [(F.approx_count_distinct(c, approx_rsd) if approx_rsd else F.count_distinct(c)).alias(f"d{i}")
           for i, c in enumerate(cols)]
    return _long(df.agg(*agg), [(c, {"n_distinct": F.col(f"d{i}")}) for i, c in enumerate(cols)], "column_name")


def shape_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Bias-corrected skewness G1 and excess kurtosis G2 (pandas definitions).

    Spark returns population g1, g2; G1 = g1*sqrt(n(n-1))/(n-2),
    G2 = (n-1)/((n-2)(n-3)) * ((n+1) g2 + 6).
    """
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"n{i}"), F.skewness(c).alias(f"g1{i}"), F.kurtosis(c).alias(f"g2{i}")]
    one = df.agg(*aggs)
    items = []
    for i, c in enumerate(cols):
        n = F.col(f"n{i}").cast("double")
        g1 = F.when(n > 2, F.col(f"g1{i}") * F.sqrt(n * (n - 1)) / (n - 2))
        g2 = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col(f"g2{i}") + 6))
        items.append((c, {"skewness": g1, "kurtosis": g2}))
    return _long(one, items, "column_name")


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlations of all column pairs in one aggregate, long form
    (both orders plus the unit diagonal)."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    one = df.agg(*[F.corr(a, b).alias(f"r{k}") for k, (a, b) in enumerate(pairs)])
    structs = [F.struct(F.lit(c).alias("col_a"), F.lit(c).alias("col_b"), F.lit(1.0).alias("corr")) for c in cols]
    for k, (a, b) in enumerate(pairs):
        structs.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"r{k}").alias("corr")))
        structs.append(F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"), F.col(f"r{k}").alias("corr")))
    return one.select(F.inline(F.array(*structs)))


def stats_by_label(df: DataFrame, features: Sequence[str], label: str, exact: bool = True,
                   digits: int = 2) -> DataFrame:
    """Mean, median, sample std, min, max per (feature, label), NULLs skipped."""
    long = df.select(label, *[F.col(c).cast("double").alias(c) for c in features]).unpivot(
        [label], list(features), "feature", "value")
    long = long.where(F.col("value").isNotNull() & F.col(label).isNotNull())
    agg = long.groupBy("feature", label).agg(
        F.round(F.avg("value"), digits).alias("mean"),
        *([] if exact else [F.round(_q("value", 0.5, False), digits).alias("median")]),
        F.round(F.stddev_samp("value"), digits).alias("std"),
        F.round(F.min("value"), digits).alias("min"),
        F.round(F.max("value"), digits).alias("max"),
    )
    if not exact:
        return agg
    med = exact_quantiles(long, "value", [0.5], ["feature", label]).select(
        "feature", label, F.round("quantile", digits).alias("median"))
    return agg.join(med, ["feature", label])


def histogram(df: DataFrame, features: Sequence[str], label: str | None = None, bins: int = 30) -> DataFrame:
    """Equal-width histogram per feature (optionally by label).

    Edges come from one min/max aggregate (2 x d scalars); bin i covers
    [lo + i*w, lo + (i+1)*w), the last bin also holds the maximum.
    """
    one = df.agg(*[F.min(c).cast("double").alias(f"lo{i}") for i, c in enumerate(features)],
                 *[F.max(c).cast("double").alias(f"hi{i}") for i, c in enumerate(features)]).first()
    parts = []
    keys = [label] if label else []
    for i, c in enumerate(features):
        lo, hi = one[f"lo{i}"], one[f"hi{i}"]
        if lo is None:
            continue
        width = (hi - lo) / bins if hi > lo else 1.0
        b = F.least(F.floor((F.col(c).cast("double") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
        parts.append(F.struct(F.lit(c).alias("feature"), b.alias("bin")))
    long = df.select(*keys, F.inline(F.array(*parts))).where(F.col("bin").isNotNull())
    counts = long.groupBy("feature", *keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    # every bin of every feature and label, also the empty ones
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(one[f"lo{i}"]).alias("lo"), F.lit(
        (one[f"hi{i}"] - one[f"lo{i}"]) / bins if one[f"hi{i}"] > one[f"lo{i}"] else 1.0).alias("width"))
        for i, c in enumerate(features) if one[f"lo{i}"] is not None])
    groups = df.select(*keys).distinct() if label else df.sparkSession.range(1).select()
    grid = groups.select(*keys, F.inline(cells)).select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = join_null_safe(grid, counts, ["feature", *keys, "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.select("feature", *keys, "bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
                      (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"), "n")


def box_stats(df: DataFrame, feature: str, label: str, exact: bool = True, whisker: float = 1.5) -> DataFrame:
    """Quartiles, mean, whiskers at 1.5 IQR and outlier count per label.

    Quartiles per label are a (labels)-row frame, broadcast back for the
    whisker pass: two scans, one tiny broadcast.
    """
    base = df.select(label, F.col(feature).cast("double").alias("x")).where(
        F.col("x").isNotNull() & F.col(label).isNotNull())
    if exact:
        ql = exact_quantiles(base, "x", [0.25, 0.5, 0.75], [label])
        q = ql.groupBy(label).agg(*[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n)
                                    for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
        q = q.join(base.groupBy(label).agg(F.avg("x").alias("mean")), label)
    else:
        q = base.groupBy(label).agg(_q("x", [0.25, 0.5, 0.75], False).alias("q"), F.avg("x").alias("mean"))
        q = q.select(label, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"),
                     "mean")
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo_f = F.col("q1") - whisker * F.col("iqr")
    hi_f = F.col("q3") + whisker * F.col("iqr")
    j = base.join(q, label)
    return j.groupBy(label).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.first("mean").alias("mean"), F.first("iqr").alias("iqr"),
        F.min(F.when(F.col("x") >= lo_f, F.col("x"))).alias("whisker_low"),
        F.max(F.when(F.col("x") <= hi_f, F.col("x"))).alias("whisker_high"),
        F.count(F.when((F.col("x") < lo_f) | (F.col("x") > hi_f), 1)).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"),
    )


def quantile_grid(df: DataFrame, score: str, label: str, probs=None, method: str = "disc") -> DataFrame:
    """Quantile grid of a score per label (the data behind a violin plot).

    ``method='disc'`` returns observed values (SQL PERCENTILE_DISC); 'linear'
    interpolates; 'approx' uses the bounded-memory sketch.
    """
    probs = probs or [round(0.05 * i, 2) for i in range(1, 20)]
    g = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(label)
    if method in ("disc", "linear"):
        base = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        return exact_quantiles(base, score, probs, [label], method=method)
    else:
        g = g.agg(_q(score, probs, method == "linear").alias("q"))
        structs = [F.struct(F.lit(float(p)).alias("prob"), F.col("q")[i].cast("double").alias("quantile"))
                   for i, p in enumerate(probs)]
    return g.select(label, F.inline(F.array(*structs)))


def feature_means(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Global mean per feature, long form."""
    one = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)])
    return _long(one, [(c, {"mean": F.col(f"m{i}")}) for i, c in enumerate(features)], "feature")


def covariance_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Population covariance of every pair of columns (rows with a NULL are left out), long form.

    Each task reduces its rows to one d x d matrix of sums around the means; the
    matrices are added up by entry, so d * d rows per task are shuffled.
    """
    import numpy as np
    import pyarrow as pa

    cols = list(cols)
    clean = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    mean = clean.agg(*[F.avg(c) for c in cols]).first()
    if mean[0] is None:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, covariance double")
    centre = np.array(list(mean))

    def gram(batches):
        total, n = np.zeros((len(centre), len(centre))), 0
        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns]) - centre
            total += x.T @ x
            n += len(x)
        i, j = np.indices(total.shape)
        yield pa.record_batch([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel()), pa.array(np.full(total.size, n))],
                              ["i", "j", "s", "n"])

    sums = clean.mapInArrow(gram, "i long, j long, s double, n long").groupBy("i", "j").agg((F.sum("s") / F.sum("n")).alias("covariance"))
    names = F.array(*[F.lit(c) for c in cols])
    return sums.select(F.get(names, F.col("i").cast("int")).alias("col_a"), F.get(names, F.col("j").cast("int")).alias("col_b"), "covariance")
