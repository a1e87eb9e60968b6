"""Banding by thresholds."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .dates import _col, months_crossed


def band(c, edges: Sequence[float], labels: Sequence[str], *, closed: str, missing: str | None = None) -> Column:
    """Label of the first edge that c does not pass, the last label beyond all edges.

    closed="upper": c <= edge belongs to the band; closed="lower": c < edge does.
    Null gives `missing`.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("one label more than edges is needed")
    c = _col(c)
    out = F.when(c.isNull(), F.lit(missing))
    for edge, label in zip(edges, labels):
        edge = F.lit(edge).cast("decimal(12,4)") if isinstance(edge, float) else F.lit(edge)
        out = out.when((c <= edge) if closed == "upper" else (c < edge), F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


# Edges and labels of the published bands.
ORIGINATION_LTV = ([0.60, 0.75, 0.85, 0.90], ["<= 60%", "60-75%", "75-85%", "85-90%", "> 90%"])
CURRENT_LTV = ([0.50, 0.60, 0.75, 0.85, 0.90],
               ["1. <= 50%", "2. 50-60%", "3. 60-75%", "4. 75-85%", "5. 85-90%", "6. > 90%"])
RATE = ([2, 3, 4, 5], ["1. < 2%", "2. 2-3%", "3. 3-4%", "4. 4-5%", "5. >= 5%"])
TENURE_MONTHS = ([12, 36, 60, 120], ["< 1 year", "1-3 years", "3-5 years", "5-10 years", "10+ years"])
DAYS_PAST_DUE = ([1, 30, 60, 90], ["Current", "1-29", "30-59", "60-89", "90+"])


def origination_ltv_band(c) -> Column:
    return band(c, *ORIGINATION_LTV, closed="upper")


def current_ltv_band(c) -> Column:
    return band(c, *CURRENT_LTV, closed="upper", missing="n/a")


def rate_band(c) -> Column:
    return band(c, *RATE, closed="lower")


def tenure_band(onboarded, as_of) -> Column:
    return band(months_crossed(onboarded, as_of), *TENURE_MONTHS, closed="lower", missing="Unknown")


def arrears_bucket(days_past_due) -> Column:
    return band(days_past_due, *DAYS_PAST_DUE, closed="lower")
