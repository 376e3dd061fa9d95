"""Column roles of a churn table.

Operators never hard-code column names; they receive a ``ChurnSpec`` (or
plain names).  The defaults are the names produced by
``churnkit.sources.adapters.customer_frame``.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class ChurnSpec:
    key: str = "customer_id"
    label: str = "churn"
    positive: str = "Yes"
    numeric: tuple[str, ...] = ("tenure", "monthly", "total")
    binary: tuple[str, ...] = ("gender", "partner", "dependents", "paperless")
    flags: tuple[str, ...] = ("senior",)
    addons: tuple[str, ...] = (
        "addon_click",
        "addon_error",
        "addon_purchase",
        "addon_signup",
        "addon_view",
    )
    onehot: tuple[str, ...] = ("segment", "region", "priority")
    # dimension roles used by the OLAP views
    contract: str = "segment"
    internet: str = "region"
    payment: str = "priority"
    extra: dict = field(default_factory=dict)


DEFAULT_SPEC = ChurnSpec()
