"""Encoding expressions."""

from __future__ import annotations

import re
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The dictionary encodings of the reference's categorical columns.
BINARY_MAP = {"Yes": 1, "No": 0, "Female": 0, "Male": 1}
ADDON_MAP = {"Yes": 1, "No": 0, "No internet service": 0, "No phone service": 0, "No service": 0}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_values(c, mapping: dict) -> Column:
    """Dictionary lookup; keys missing from ``mapping`` give NULL (like ``Series.map``)."""
    lit_map = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return lit_map[_c(c)]


def binary_encode(c, mapping: dict | None = None) -> Column:
    """Yes/No, Male/Female -> 1/0 as int; unmapped -> NULL."""
    return map_values(c, mapping or BINARY_MAP).cast("int")


def addon_encode(c, mapping: dict | None = None) -> Column:
    """Three-valued service flag -> 1/0; the 'no service' levels count as 0."""
    return map_values(c, mapping or ADDON_MAP).cast("int")


def normalise_name(name: str) -> str:
    """Column-name normalisation: space and '-' -> '_', parentheses removed."""
    return name.replace(" ", "_").replace("-", "_").replace("(", "").replace(")", "")


def onehot_columns(c: str, levels) -> list[Column]:
    """One 0/1 int column per level, all levels kept, sorted order (P5).

    A NULL value gives 0 in every level column, as ``get_dummies`` does.
    """
    return [
        F.when(F.col(c) == F.lit(lvl), 1).otherwise(0).alias(normalise_name(f"{c}_{lvl}"))
        for lvl in sorted(levels)
    ]


def label_map(c, mapping: dict, default=None) -> Column:
    """Display label lookup (P14); ``default`` for unmapped values."""
    out = map_values(c, mapping)
    return out if default is None else F.coalesce(out, F.lit(default))


_SAFE = re.compile(r"[^0-9A-Za-z_]")


def safe_identifier(name: str) -> str:
    return _SAFE.sub("_", normalise_name(name))
