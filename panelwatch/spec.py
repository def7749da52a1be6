"""Column roles of a panel (one row per entity and period) and regime calendar."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Column roles of the customer-month churn panel, in the
# reference's order (period, id, target, numeric features, categorical features).
CHURN_PERIOD = "snapshot_month"
CHURN_ID = "customer_id"
CHURN_TARGET = "churn"
CHURN_NUMERIC = (
    "age",
    "tenure_months",
    "monthly_charges",
    "monthly_usage_gb",
    "support_tickets_30d",
    "avg_session_minutes",
    "num_services",
    "late_payments_3m",
)
CHURN_CATEGORICAL = (
    "gender",
    "region",
    "senior_citizen",
    "contract_type",
    "payment_method",
    "paperless_billing",
)
# Temporal split of the reference (train, validation months).
CHURN_TRAIN_MONTHS = ("2024-01", "2024-02", "2024-03", "2024-04", "2024-05", "2024-06")
CHURN_VALIDATION_MONTHS = ("2024-07", "2024-08")


@dataclass(frozen=True)
class PanelSpec:
    """Roles of the columns of a panel table.

    ``period`` is a sortable text label (``yyyy-MM`` or ``yyyy-MM-dd``), ``id``
    the entity key, ``target`` a 0/1 integer column.  Operators never hard-code
    column names; they read them from here.
    """

    period: str = CHURN_PERIOD
    id: str = CHURN_ID
    target: str = CHURN_TARGET
    numeric: tuple[str, ...] = CHURN_NUMERIC
    categorical: tuple[str, ...] = CHURN_CATEGORICAL
    train_periods: tuple[str, ...] = CHURN_TRAIN_MONTHS
    validation_periods: tuple[str, ...] = CHURN_VALIDATION_MONTHS

    @property
    def features(self) -> tuple[str, ...]:
        return tuple(self.numeric) + tuple(self.categorical)

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.id, self.period, *self.features, self.target)

    def with_(self, **kw) -> "PanelSpec":
        return replace(self, **kw)


# Regime names and month-index boundaries of the reference
# (index 0-7 baseline, 8-11 data_drift, 12 and later concept_drift).
REGIME_LABELS = ("baseline", "data_drift", "concept_drift")
REGIME_STARTS = (0, 8, 12)


@dataclass(frozen=True)
class RegimeSpec:
    """Calendar regimes: label by months elapsed since ``start`` (``yyyy-MM``)."""

    start: str = "2024-01"
    starts: tuple[int, ...] = REGIME_STARTS
    labels: tuple[str, ...] = REGIME_LABELS
    unit: str = field(default="month")  # "month" or "day"
