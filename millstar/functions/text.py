"""String helpers built only from JVM-side functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def first_digit_run(text: Column) -> Column:
    """The first run of digits in ``text`` as a long; NULL when there is none.

    ``'Technician 5'`` -> 5, ``'Tech 0012 and 5'`` -> 12, ``'Technician'`` -> NULL.
    A run longer than a long holds fails the cast (ANSI), on purpose.
    """
    # One pass: the match or NULL.
    return F.regexp_substr(text, F.lit("[0-9]+")).cast(T.LongType())


# Alert-type category by the first substring found, in this order.
ALERT_CATEGORY_RULES: list[tuple[str, str]] = [
    ("threshold", "Quality"),
    ("quality", "Environmental"),
    ("machine", "Mechanical"),
    ("offline", "Electrical"),
]
ALERT_CATEGORY_DEFAULT = "Operational"

# Severities that require an acknowledgement.
ACK_SEVERITIES: list[str] = ["critical", "high"]


def alert_category(alert_type: Column) -> Column:
    expr = None
    for needle, label in ALERT_CATEGORY_RULES:
        cond = alert_type.contains(needle)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(ALERT_CATEGORY_DEFAULT)


def requires_ack(severity: Column) -> Column:
    # NULL severity is not in the list -> false.
    return F.coalesce(severity.isin(*ACK_SEVERITIES), F.lit(False))
