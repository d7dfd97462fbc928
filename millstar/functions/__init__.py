"""Column-level helpers (all built-in Spark expressions, no UDFs)."""

from millstar.functions.temporal import as_timestamp, date_key, epoch_seconds, hour_key
from millstar.functions.text import alert_category, first_digit_run, requires_ack

__all__ = ["as_timestamp", "date_key", "hour_key", "epoch_seconds",
           "first_digit_run", "alert_category", "requires_ack"]
