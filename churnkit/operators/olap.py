"""Churn-rate OLAP views.

Every view is one scan with partial aggregation and one exchange on the
grouping key.  Multi-dimension views use grouping sets (Expand + a single
shuffle) instead of one job per dimension.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.functions.bins import charge_cohort, pay_type, service_count, tenure_cohort
from churnkit.functions.encode import normalise_name


def positive_flag(label: str, positive) -> Column:
    """1 when label = positive, else 0 (a NULL label counts as not positive)."""
    return F.when(F.col(label) == F.lit(positive), 1).otherwise(0)


def rate_pct(label: str, positive) -> Column:
    return (F.avg(positive_flag(label, positive)) * 100.0)


def churn_rate_by(df: DataFrame, dim: str, label: str = "churn", positive="Yes",
                  rate_name: str = "churn_rate", count_name: str = "customer_count") -> DataFrame:
    """Rate (%) and row count per value of ``dim``; NULL keys dropped (pandas semantics),
    rate and count from the same aggregate (no positional alignment)."""
    return (df.where(F.col(dim).isNotNull())
            .groupBy(dim)
            .agg(rate_pct(label, positive).alias(rate_name), F.count(F.lit(1)).alias(count_name)))


def label_distribution(df: DataFrame, dim: str, label: str = "churn", pct_name: str = "pct") -> DataFrame:
    """A10: share (%) of each label value inside each group.

    The window runs over the already aggregated (groups x labels) rows only.
    """
    from pyspark.sql.window import Window

    counts = df.where(F.col(dim).isNotNull() & F.col(label).isNotNull()).groupBy(dim, label).agg(
        F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(dim)
    return counts.select(dim, label, (F.col("n") * 100.0 / F.sum("n").over(w)).alias(pct_name), "n")


def olap_frame(df: DataFrame, tenure_col="tenure", charge_col="monthly", payment_col="priority",
               tenure_edges=None, tenure_labels=None, charge_edges=None, charge_labels=None,
               auto_token: str = "automatic") -> DataFrame:
    """Adds tenure cohort, charge cohort and pay type (P10-P12) as columns."""
    tk = {} if tenure_edges is None else {"edges": tenure_edges, "labels": tenure_labels}
    ck = {} if charge_edges is None else {"edges": charge_edges, "labels": charge_labels}
    return df.withColumns({
        "tenure_cohort": tenure_cohort(tenure_col, **tk),
        "charge_cohort": charge_cohort(charge_col, **ck),
        "pay_type": pay_type(payment_col, auto_token),
    })


def multi_dim_rates(df: DataFrame, dims: Sequence[str], label: str = "churn", positive="Yes",
                    overall: str | None = "all") -> DataFrame:
    """A11/A15 core: GROUPING SETS ((d1), (d2), ..., ()) in one scan.

    Output in long form ``(dimension, value, churn_rate, customer_count)``.
    NULL values of a dimension are dropped, told apart from the rolled-up
    NULL by ``grouping()``.
    """
    sets = [[F.col(d)] for d in dims] + ([[]] if overall else [])
    g = df.select(*[F.col(d).cast("string").alias(d) for d in dims], label)
    agg = g.groupingSets(sets, *dims).agg(
        rate_pct(label, positive).alias("churn_rate"),
        F.count(F.lit(1)).alias("customer_count"),
        *[F.grouping(d).alias(f"_g_{i}") for i, d in enumerate(dims)],
    )
    dim_expr = None
    val_expr = None
    for i, d in enumerate(dims):
        cond = F.col(f"_g_{i}") == 0
        dim_expr = F.when(cond, F.lit(d)) if dim_expr is None else dim_expr.when(cond, F.lit(d))
        val_expr = F.when(cond, F.col(d)) if val_expr is None else val_expr.when(cond, F.col(d))
    if overall:
        dim_expr = dim_expr.otherwise(F.lit(overall))
        val_expr = val_expr.otherwise(F.lit(overall))
    out = agg.select(dim_expr.alias("dimension"), val_expr.alias("value"), "churn_rate", "customer_count")
    return out.where(F.col("value").isNotNull())


def olap_series(df: DataFrame, contract="segment", payment="priority", internet="region",
                focus_col: str | None = None, focus_val=None, label="churn", positive="Yes",
                **bin_kwargs) -> DataFrame:
    """Six churn-rate series under one focus slice plus the row count (overall row)."""
    from churnkit.operators.filters import focus_slice

    base = olap_frame(focus_slice(df, focus_col, focus_val), payment_col=payment, **bin_kwargs)
    return multi_dim_rates(base, [contract, "tenure_cohort", payment, internet, "charge_cohort", "pay_type"],
                           label, positive)


def crosstab(df: DataFrame, row_dim: str, col_dim: str, col_levels: Sequence[str], label="churn",
             positive="Yes", digits: int = 1) -> DataFrame:
    """Rate (%) per row x column cell, rounded; an empty cell is NULL.

    ``col_levels`` given explicitly so pivot needs no extra distinct job.
    """
    wide = (df.where(F.col(row_dim).isNotNull())
            .groupBy(row_dim).pivot(col_dim, list(col_levels))
            .agg(F.round(rate_pct(label, positive), digits)))
    return wide.select(row_dim, *[F.col(f"`{lvl}`").alias(normalise_name(str(lvl))) for lvl in col_levels])


def crosstab_long(df: DataFrame, row_dim: str, col_dim: str, label="churn", positive="Yes") -> DataFrame:
    return (df.where(F.col(row_dim).isNotNull() & F.col(col_dim).isNotNull())
            .groupBy(row_dim, col_dim).agg(rate_pct(label, positive).alias("churn_rate"),
                                           F.count(F.lit(1)).alias("customer_count")))


def crosstab_peak(df: DataFrame, row_dim: str, col_dim: str, label="churn", positive="Yes",
                  digits: int = 1) -> DataFrame:
    """The highest cell of the cross-tab (ties -> smallest row, then column value)."""
    long = crosstab_long(df, row_dim, col_dim, label, positive).withColumn(
        "peak_rate", F.round("churn_rate", digits))
    return (long.orderBy(F.col("peak_rate").desc(), F.col(row_dim), F.col(col_dim))
            .limit(1).select(row_dim, col_dim, "peak_rate"))


def kpi_row(df: DataFrame, predicate: Column | None = None, label="churn", positive="Yes",
            charge_col="monthly", tenure_col="tenure") -> DataFrame:
    """N, churn %, mean charge, mean tenure of the filtered rows and their
    delta to the same KPIs on the whole table — one scan, no join.  Empty
    selection gives zeros."""
    sel = predicate if predicate is not None else F.lit(True)
    flag = positive_flag(label, positive)
    agg = df.agg(
        F.count(F.when(sel, 1)).alias("n"),
        F.avg(F.when(sel, flag)).alias("_rate"),
        F.avg(F.when(sel, F.col(charge_col))).alias("_charge"),
        F.avg(F.when(sel, F.col(tenure_col))).alias("_tenure"),
        F.count(F.lit(1)).alias("base_n"),
        F.avg(flag).alias("_brate"),
        F.avg(charge_col).alias("_bcharge"),
        F.avg(tenure_col).alias("_btenure"),
    )
    z = F.lit(0.0)
    return agg.select(
        "n",
        (F.coalesce(F.col("_rate"), z) * 100.0).alias("churn_rate"),
        F.coalesce(F.col("_charge"), z).alias("avg_charge"),
        F.coalesce(F.col("_tenure"), z).alias("avg_tenure"),
        (F.col("n") - F.col("base_n")).alias("delta_n"),
        ((F.coalesce(F.col("_rate"), z) - F.coalesce(F.col("_brate"), z)) * 100.0).alias("delta_churn_pp"),
        (F.coalesce(F.col("_charge"), z) - F.coalesce(F.col("_bcharge"), z)).alias("delta_charge"),
        (F.coalesce(F.col("_tenure"), z) - F.coalesce(F.col("_btenure"), z)).alias("delta_tenure"),
    )


def demographic_rates(df: DataFrame, gender="gender", senior="senior", partner="partner",
                      dependents="dependents", label="churn", positive="Yes") -> DataFrame:
    """Churn rate per demographic segment plus the overall rate, one scan."""
    labelled = df.select(
        label,
        F.col(gender).alias("g_gender"),
        F.when(F.col(senior) == 1, "Senior").when(F.col(senior) == 0, "Non-Senior").alias("g_senior"),
        F.when(F.col(partner) == "Yes", "Has Partner").when(F.col(partner) == "No", "No Partner").alias("g_partner"),
        F.when(F.col(dependents) == "Yes", "Has Dependents").when(F.col(dependents) == "No", "No Dependents")
        .alias("g_dependents"),
    )
    long = multi_dim_rates(labelled, ["g_gender", "g_senior", "g_partner", "g_dependents"], label, positive,
                           overall="Overall")
    return long.select(F.col("value").alias("segment"), F.regexp_replace("dimension", "^g_", "").alias("dimension"),
                       "churn_rate", "customer_count")


def addon_adoption(df: DataFrame, addons: Sequence[str], label="churn", yes="Yes") -> DataFrame:
    """Adoption (%) of each add-on per label value (one groupBy)."""
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(
        *[(F.avg(F.when(F.col(a) == yes, 1).otherwise(0)) * 100.0).alias(a) for a in addons])


def service_count_rates(df: DataFrame, addons: Sequence[str], label="churn", positive="Yes",
                        yes="Yes") -> DataFrame:
    """Churn rate by number of adopted add-ons (P13 + A9)."""
    return churn_rate_by(df.withColumn("service_count", service_count(addons, yes)), "service_count",
                         label, positive)
