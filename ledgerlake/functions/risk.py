"""Loan formulas on a balance snapshot: payment, default and loss parameters, stage, provision."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from .dates import _col

# Fixed values of the risk rules.
PD_SCALE = 0.28
PD_FLOOR, PD_CAP = 0.0003, 0.95
BUCKET_MULTIPLIER = {"Current": 1.0, "1-29": 8.0, "30-59": 20.0, "60-89": 35.0, "90+": 1.0}
LGD_BY_PRODUCT = {"P05": 0.80, "P06": 0.85, "P08": 0.55, "P09": 0.05, "P10": 0.85}
LGD_DEFAULT = 0.8
SICR_RATIO, SICR_FLOOR, WEAK_DRIFT = 4.0, 0.004, 0.4
UNDRAWN_STAGE1, UNDRAWN_OTHER = 0.4, 0.6
SHOCK_LIMIT = 1.10


def annuity_payment(balance, rate_pct, months) -> Column:
    """Level monthly payment; without interest the balance is spread evenly."""
    balance, rate = _col(balance), _col(rate_pct) / F.lit(1200.0)
    n = F.greatest(_col(months), F.lit(1))
    with_rate = balance * rate / (1 - F.pow(1 + rate, -n))
    return F.when(rate > 1e-9, with_rate).otherwise(balance / n)


def monthly_interest(balance, rate_pct) -> Column:
    return _col(balance) * _col(rate_pct) / F.lit(1200.0)


def _by_value(c, mapping: dict, default) -> Column:
    out = None
    for key, value in mapping.items():
        cond = _col(c) == key
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def pd_12m(monthly_p, bucket) -> Column:
    """Twelve-month default probability from a monthly one; certain at 90+."""
    base = (1 - F.pow(1 - _col(monthly_p), F.lit(12))) * F.lit(PD_SCALE)
    value = base * _by_value(bucket, BUCKET_MULTIPLIER, 1.0)
    clipped = F.least(F.greatest(value, F.lit(PD_FLOOR)), F.lit(PD_CAP))
    return F.when(_col(bucket) == "90+", F.lit(1.0)).otherwise(clipped)


def loss_given_default(product, ltv, mortgage="P04") -> Column:
    """Collateral-based for mortgages, a constant per product otherwise."""
    uncovered = 1 - F.lit(0.75) / F.greatest(_col(ltv), F.lit(0.01))
    secured = F.least(F.greatest(uncovered, F.lit(0.0)), F.lit(1.0)) + F.lit(0.03)
    return F.when(_col(product) == mortgage, secured).otherwise(_by_value(product, LGD_BY_PRODUCT, LGD_DEFAULT))


def stage(bucket, pd, pd_at_origination, overlay, weak_score=None, drift=None, flagged_holiday=None) -> Column:
    """3 at 90+, 2 after a significant increase in risk, else 1."""
    pd = _col(pd)
    worse = (pd * _col(overlay) >= F.lit(SICR_RATIO) * _col(pd_at_origination)) & (pd >= SICR_FLOOR)
    two = (_col(bucket) != "Current") | worse
    if weak_score is not None:
        two = two | (_col(weak_score) & (_col(drift) > WEAK_DRIFT))
    if flagged_holiday is not None:
        two = two | _col(flagged_holiday)
    return F.when(_col(bucket) == "90+", 3).when(two, 2).otherwise(1)


def exposure_at_default(balance, limit, stage_col) -> Column:
    """Balance and a share of the undrawn limit; no limit means nothing undrawn."""
    undrawn = F.greatest(F.coalesce(_col(limit), F.lit(0.0)) - _col(balance), F.lit(0.0))
    share = F.when(_col(stage_col) == 1, F.lit(UNDRAWN_STAGE1)).otherwise(F.lit(UNDRAWN_OTHER))
    return _col(balance) + undrawn * share


def expected_loss(stage_col, pd, lgd, ead, years, overlay) -> Column:
    """Twelve-month loss in stage 1, lifetime in stage 2, full loss given default in stage 3."""
    pd, lgd, ead = _col(pd), _col(lgd), _col(ead)
    lifetime = 1 - F.pow(1 - pd, _col(years))
    probability = F.when(_col(stage_col) == 1, pd).when(_col(stage_col) == 2, lifetime).otherwise(F.lit(1.0))
    return probability * lgd * ead * _col(overlay)


def payment_shock(new_payment, old_payment) -> tuple[Column, Column]:
    """Ratio of payments at a repricing and whether it passes the limit."""
    shock = F.try_divide(_col(new_payment).cast("double"), _col(old_payment).cast("double"))
    return shock, shock > SHOCK_LIMIT


def regional_index(index, growth) -> Column:
    """National price index scaled to a region's growth factor."""
    return 1 + (_col(index) - 1) * _col(growth)
