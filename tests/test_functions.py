from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import amounts, bands, dates, risk, text
from ledgerlake.plans.status import kpi_label, kpi_status, run_status, severity_status


def d(*a):
    return F.lit(date(*a))


def test_date_key_and_back(one):
    assert one(dates.date_key(d(2024, 2, 29))) == 20240229
    assert one(dates.date_key(F.lit(None).cast("date"))) is None
    assert one(dates.key_date(F.lit(20240229))) == date(2024, 2, 29)


def test_month_ends(one):
    assert one(dates.month_end(d(2024, 1, 31), 1)) == date(2024, 2, 29)
    assert one(dates.month_end(d(2024, 3, 31), -1)) == date(2024, 2, 29)


def test_months_crossed_counts_boundaries(one):
    assert one(dates.months_crossed(d(2024, 2, 29), d(2024, 3, 1))) == 1
    assert one(dates.months_crossed(d(2024, 3, 1), d(2024, 3, 31))) == 0


def test_minutes_crossed(one):
    a, b = F.lit(datetime(2024, 1, 1, 10, 0, 59)), F.lit(datetime(2024, 1, 1, 10, 1, 0))
    assert one(dates.minutes_crossed(a, b)) == 1


def test_days_between_ignores_time(one):
    a, b = F.lit(datetime(2024, 1, 1, 23, 59)), F.lit(datetime(2024, 1, 2, 0, 1))
    assert one(dates.days_between(a, b)) == 1


def test_weekday_and_quarters(one):
    assert one(dates.weekday_number(d(2024, 1, 1))) == 1  # a Monday
    assert one(dates.weekday_number(d(2024, 1, 7))) == 7
    assert one(dates.quarter_label(d(2024, 5, 1))) == "2024 Q2"
    assert one(dates.quarter_label_of_key(F.lit(20240930))) == "2024 Q3"
    assert one(dates.quarter_period(d(2020, 4, 1))) == "2020Q2"


@pytest.mark.parametrize("raw,expected", [
    ("02 Jan 2020", date(2020, 1, 2)), ("2020-01-02", date(2020, 1, 2)), ("2020-01-02T00:00:00", date(2020, 1, 2)),
    ("n/a", None), ("", None)])
def test_parse_date(one, raw, expected):
    assert one(dates.parse_date(F.lit(raw))) == expected


def test_file_month(one):
    assert one(dates.file_month(F.lit("a/year=2024/month=03/x.parquet"))) == date(2024, 3, 1)
    assert one(dates.file_month(F.lit("a/x.parquet"))) is None


@pytest.mark.parametrize("raw,std,area,dirty", [
    ("ne127ab", "NE12 7AB", "NE", True), ("NE12 7AB", "NE12 7AB", "NE", False), (" b1 1aa ", "B1 1AA", "B", True),
    ("AB1", "AB1", "AB", True), ("ABCD", "ABCD", "ABCD", True)])
def test_postcode(one, raw, std, area, dirty):
    c = F.lit(raw)
    assert one(text.postcode_standard(c)) == std
    assert one(text.postcode_area(c)) == area
    assert one(text.postcode_was_dirty(c)) is dirty


def test_postcode_sector_and_codes(one):
    assert one(text.postcode_sector(F.lit("NE12 7AB"))) == "NE12 7"
    assert one(text.postcode_sector(F.lit("NE1"))) == "NE1"
    assert one(text.clean_code(F.lit("  ne "))) == "NE"
    assert one(text.clean_code(F.lit("  "))) is None
    assert one(text.join_flags(F.lit(None).cast("string"), F.lit("b"))) == "b"
    assert one(text.join_flags(F.lit(None).cast("string"))) is None


@pytest.mark.parametrize("ltv,label", [(0.5, "1. <= 50%"), (0.51, "2. 50-60%"), (0.9, "5. 85-90%"), (0.91, "6. > 90%"), (None, "n/a")])
def test_ltv_band_is_closed_above(one, ltv, label):
    assert one(bands.current_ltv_band(F.lit(ltv).cast("decimal(9,4)"))) == label


@pytest.mark.parametrize("rate,label", [("1.99", "1. < 2%"), ("2.00", "2. 2-3%"), ("5.00", "5. >= 5%")])
def test_rate_band_is_open_above(one, rate, label):
    assert one(bands.rate_band(F.lit(rate).cast("decimal(7,4)"))) == label


def test_tenure_band(one):
    assert one(bands.tenure_band(d(2025, 9, 30), d(2026, 8, 31))) == "< 1 year"
    assert one(bands.tenure_band(d(2025, 8, 31), d(2026, 8, 1))) == "1-3 years"  # twelve boundaries
    assert one(bands.tenure_band(F.lit(None).cast("date"), d(2026, 8, 31))) == "Unknown"


@pytest.mark.parametrize("days,label", [(0, "Current"), (1, "1-29"), (29, "1-29"), (30, "30-59"), (89, "60-89"), (90, "90+")])
def test_arrears_bucket(one, days, label):
    assert one(bands.arrears_bucket(F.lit(days))) == label


def test_blank_arithmetic(one):
    null, five = F.lit(None).cast("double"), F.lit(5.0)
    assert one(amounts.plus(null, five)) == 5.0
    assert one(amounts.plus(null, null)) is None
    assert one(amounts.minus(null, five)) == -5.0
    assert one(amounts.ratio(five, F.lit(0))) is None
    assert one(amounts.ratio(five, null)) is None
    assert one(amounts.smaller(null, five)) == 0.0
    assert one(amounts.larger(null, F.lit(-1.0))) == 0.0


def test_money_rounds_half_up(one):
    assert one(amounts.money(F.lit(2.675))) == Decimal("2.68")
    assert one(amounts.money(F.lit(-0.125))) == Decimal("-0.13")


def test_repair_sign_only_for_listed_products(one):
    assert one(amounts.repair_sign(F.lit(-5), F.lit("P02"), ["P02"])) == 5
    assert one(amounts.repair_sign(F.lit(-5), F.lit("P01"), ["P02"])) == -5


@pytest.mark.parametrize("bucket,dpd,stage,expected", [("90+", 95, None, 3), ("30-59", 31, None, 2), ("Current", 0, None, 1), ("90+", 95, 2.0, 2)])
def test_impute_stage(one, bucket, dpd, stage, expected):
    assert one(amounts.impute_stage(F.lit(stage).cast("double"), F.lit(bucket), F.lit(dpd))) == expected


def test_number_text(one):
    assert one(amounts.number_text(F.lit(0.1234), "0.0%")) == "12.3%"
    assert one(amounts.number_text(F.lit(12.5), "0")) == "13"
    assert one(amounts.number_text(F.lit(1.005), "0.00")) == "1.01"
    assert one(amounts.number_text(F.lit(1234567), "#,0")) == "1,234,567"


def test_spread_point(one):
    lat, lon = amounts.spread_point(F.lit(50.0), F.lit(1.0), F.lit(10))
    assert one(lat) == pytest.approx(50.0) and one(lon) == pytest.approx(1.0 - 2 * 0.055)


def test_annuity(one):
    assert one(risk.annuity_payment(F.lit(1200.0), F.lit(0.0), F.lit(12))) == pytest.approx(100.0)
    assert one(risk.annuity_payment(F.lit(1000.0), F.lit(12.0), F.lit(12))) == pytest.approx(88.8488, abs=1e-3)
    assert one(risk.annuity_payment(F.lit(10.0), F.lit(0.0), F.lit(-3))) == pytest.approx(10.0)


def test_risk_parameters(one):
    assert one(risk.pd_12m(F.lit(0.5), F.lit("90+"))) == 1.0
    assert one(risk.pd_12m(F.lit(0.0), F.lit("Current"))) == 0.0003
    assert one(risk.pd_12m(F.lit(0.9), F.lit("60-89"))) == 0.95
    assert one(risk.loss_given_default(F.lit("P04"), F.lit(0.5))) == pytest.approx(0.03)
    assert one(risk.loss_given_default(F.lit("P04"), F.lit(1.0))) == pytest.approx(0.28)
    assert one(risk.loss_given_default(F.lit("P09"), F.lit(None).cast("double"))) == 0.05
    assert one(risk.exposure_at_default(F.lit(60.0), F.lit(100.0), F.lit(1))) == pytest.approx(76.0)
    assert one(risk.exposure_at_default(F.lit(60.0), F.lit(None).cast("double"), F.lit(2))) == 60.0


def test_stage_rules(one):
    s = lambda bucket, pd, p0, **k: one(risk.stage(F.lit(bucket), F.lit(pd), F.lit(p0), F.lit(1.0), **k))
    assert s("90+", 1.0, 0.1) == 3
    assert s("1-29", 0.001, 0.1) == 2
    assert s("Current", 0.05, 0.01) == 2  # five times the origination value
    assert s("Current", 0.0039, 0.0001) == 1  # below the floor
    assert s("Current", 0.001, 0.1, weak_score=F.lit(True), drift=F.lit(0.5)) == 2


def test_expected_loss_by_stage(one):
    e = lambda st: one(risk.expected_loss(F.lit(st), F.lit(0.1), F.lit(0.5), F.lit(100.0), F.lit(2.0), F.lit(1.0)))
    assert e(1) == pytest.approx(5.0) and e(2) == pytest.approx(9.5) and e(3) == pytest.approx(50.0)


def test_payment_shock(one):
    ratio, flag = risk.payment_shock(F.lit(120.0), F.lit(100.0))
    assert one(ratio) == pytest.approx(1.2) and one(flag) is True


def test_status_texts(one):
    assert one(kpi_label(F.lit(-0.0312), "0.0%", "vs PY")) == "▼ 3.1% vs PY"
    assert one(kpi_label(F.lit(None).cast("double"), "0", "x")) == "no comparison"
    assert one(kpi_status(F.lit(0.0), "higher")) == "good"
    assert one(kpi_status(F.lit(1.0), "lower")) == "bad"
    assert one(kpi_status(F.lit(1.0), "none")) == "neutral"
    assert one(run_status(F.lit("Skipped"))) == "neutral"
    assert one(severity_status(F.lit("Warning"))) == "warn"
