"""Column-expression builders: every function returns a ``Column`` and
compiles into whole-stage codegen (no Python UDFs)."""

from churnkit.functions.bins import (charge_cohort, pay_type, right_closed_bins, service_count,
                                     tenure_cohort)
from churnkit.functions.clean import finite_or_zero, impute_blank, is_blank, lenient_double
from churnkit.functions.decision import (deviation_band, distance_pp, flip, minmax_normalise, odds_ratio,
                                         outcome_label, pct_deviation, sigmoid, threshold_decision)
from churnkit.functions.encode import (addon_encode, binary_encode, label_map, map_values, normalise_name,
                                       onehot_columns)

__all__ = [
    "addon_encode", "binary_encode", "charge_cohort", "deviation_band", "distance_pp", "finite_or_zero",
    "flip", "impute_blank", "is_blank", "label_map", "lenient_double", "map_values", "minmax_normalise",
    "normalise_name", "odds_ratio", "onehot_columns", "outcome_label", "pay_type", "pct_deviation",
    "right_closed_bins", "service_count", "sigmoid", "tenure_cohort", "threshold_decision",
]
