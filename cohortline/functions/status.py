"""Status texts, severities and thresholds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds of the drift decision.
PSI_WATCH = 0.10
PSI_ALERT = 0.25
KS_ALPHA = 0.05

# Status texts by severity.
OK_STATUSES = ("UP", "STABLE", "OK")
WARN_STATUSES = ("WATCH", "DEGRADED")
ALERT_STATUSES = ("DOWN", "DRIFT", "ALERT")


def drift_status(psi: Column, p_value: Column, watch: float = PSI_WATCH, alert: float = PSI_ALERT,
                 alpha: float = KS_ALPHA) -> Column:
    confirmed = F.coalesce(p_value < alpha, F.lit(False)) & (psi > watch)
    return F.when((psi > alert) | confirmed, "DRIFT").when(psi > watch, "WATCH").otherwise("STABLE")


def severity(status: Column) -> Column:
    """ok / warn / alert; unknown and missing statuses are warnings."""
    text = F.upper(status)
    return F.when(text.isin(*OK_STATUSES), "ok").when(text.isin(*ALERT_STATUSES), "alert").otherwise("warn")


def is_predict_path(path: Column, suffix: str = "/predict") -> Column:
    return F.rtrim(path, F.lit("/")).endswith(suffix)
