"""Texts and states of KPI cards."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..functions.amounts import number_text
from ..functions.dates import _col

GOOD, BAD, WARN, NEUTRAL = "good", "bad", "warn", "neutral"


def kpi_label(value, fmt: str, suffix: str) -> Column:
    """Arrow, absolute change and suffix; 'no comparison' where there is no value."""
    v = _col(value).cast("double")
    arrow = F.when(v >= 0, F.lit("▲ ")).otherwise(F.lit("▼ "))
    return F.when(v.isNull(), F.lit("no comparison")).otherwise(
        F.concat(arrow, number_text(F.abs(v), fmt), F.lit(" " + suffix)))


def kpi_status(value, better: str) -> Column:
    """good, bad, or neutral without a value; better is 'higher', 'lower' or 'none'."""
    v = _col(value)
    if better == "none":
        return F.lit(NEUTRAL)
    fine = v >= 0 if better == "higher" else v <= 0
    return F.when(v.isNull(), F.lit(NEUTRAL)).when(fine, F.lit(GOOD)).otherwise(F.lit(BAD))


def run_status(status) -> Column:
    s = _col(status)
    return F.when(s == "Succeeded", F.lit(GOOD)).when(s == "Failed", F.lit(BAD)).otherwise(F.lit(NEUTRAL))


def severity_status(severity) -> Column:
    s = _col(severity)
    return F.when(s == "Error", F.lit(BAD)).when(s == "Warning", F.lit(WARN)).otherwise(F.lit(NEUTRAL))
