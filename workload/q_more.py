"""Queries of the validation report, finance series, platform page, scalar rules and streams."""
from __future__ import annotations

from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ledgerlake.functions import risk
from ledgerlake.functions.amounts import number_text, ratio, smaller
from ledgerlake.functions.bands import arrears_bucket, band
from ledgerlake.functions.dates import (date_key, days_between, minutes_crossed, month_end, months_crossed, quarter_label_of_key,
                                        quarter_period)
from ledgerlake.operators.dedupe import duplicate_row_count
from ledgerlake.operators.groups import top_categories
from ledgerlake.operators.series import (average_balance, interpolate_linear, spread_month_to_days)
from ledgerlake.plans import finance, marts, quality, reports, stories
from ledgerlake.plans.measures import build_registry, latest_runs
from ledgerlake.plans.model import Context, Model, evaluate
from ledgerlake.plans.status import run_status, severity_status
from ledgerlake.sources import control
from ledgerlake.sources.tables import read_table
from ledgerlake.streaming import monthly
from .adapters import LAST_ACTUAL, PRODUCT_IDS, RULE_START
from .registry import query, r, res, rs, work_folder
from .sql import KEY, LAST

# ---------------------------------------------------------------- validation report
# The report reads staged rows, duplicates included.

_LM = """(SELECT month_end, year(month_end) AS y, product_id, sum(balance_eom) AS bal, sum(interest_income) AS ii, sum(ftp_charge) AS fch,
  sum(fee_income) AS fee, sum(ecl) AS ecl, sum(write_off_amount) AS wo, sum(guarantee_claim_amount) AS ga, sum(new_lending_amount) AS nl,
  sum(CASE WHEN arrears_bucket = '90+' THEN balance_eom ELSE 0 END) AS b90, sum(CASE WHEN ifrs9_stage = 2 THEN balance_eom ELSE 0 END) AS s2,
  sum(CASE WHEN ifrs9_stage = 3 THEN balance_eom ELSE 0 END) AS s3, sum(CASE WHEN is_payment_holiday THEN balance_eom ELSE 0 END) AS hol
 FROM loan_stage GROUP BY ALL)"""
_DM = """(SELECT month_end, year(month_end) AS y, product_id, sum(eom_balance) AS eom, sum(interest_expense) AS ie, sum(ftp_credit) AS fc, sum(fee_income) AS fee
 FROM dep_stage GROUP BY ALL)"""
_LAST_OF_YEAR = "month_end IN (SELECT max(month_end) FROM {0} z GROUP BY y)"
_INCOME = f"""(SELECT d.y, nd, nl, nd + nl AS nt, fd + fl AS fees, months, lavg FROM (SELECT y, sum(fc - ie) AS nd, sum(fee) AS fd FROM {_DM} d GROUP BY 1) d
 JOIN (SELECT y, sum(n) AS nl, sum(f) AS fl, avg(b::DOUBLE) AS lavg, count(*) AS months FROM (SELECT y, month_end, sum(ii - fch) AS n, sum(fee) AS f, sum(bal) AS b
       FROM {_LM} l GROUP BY 1, 2) m GROUP BY 1) l ON l.y = d.y)"""


def _dm(x):
    return stories.deposits_by_month(x.deposit_rows)


def _lm(x):
    return stories.loans_by_month(x.loan_rows)


@query("story_monthly_loans", f"""
SELECT month_end, product_id, {r('bal', 'balance')}, {r('ecl', 'ecl')}, {r('b90', 'b90')}, {r('s2', 's2')}, {r('s3', 's3')}, {r('hol', 'hol')} FROM {_LM} l""")
def story_monthly_loans(x):
    return res(_lm(x), month_end="month_end", product_id="product_id", balance="balance_eom", ecl="ecl", b90="b90", s2="s2", s3="s3", hol="hol")


@query("story_yearly_nii", f"""
SELECT CAST(i.y AS INTEGER) AS year, {r('rt', 'bank_rate_avg')}, {r('nd', 'nii_deposits')}, {r('nl', 'nii_lending')}, {r('nt', 'nii_total')}, {rs('fees')},
  {r('nt::DOUBLE / months * 12 / lavg * 100', 'nim_pct')}
FROM {_INCOME} i JOIN (SELECT year(d) AS y, avg(rate::DOUBLE) AS rt FROM rate GROUP BY 1) rr ON rr.y = i.y""")
def story_yearly_nii(x):
    from ledgerlake.functions.dates import key_date
    return res(stories.income_and_margin(_dm(x), _lm(x), x.rate.withColumn("Date", key_date("DateKey"))))


@query("story_year_end_deposits", f"""
SELECT CAST(y AS INTEGER) AS year, {r("sum(eom) FILTER (product_id = 'P01')", 'P01')}, {r("sum(eom) FILTER (product_id = 'P02')", 'P02')},
  {r("sum(eom) FILTER (product_id = 'P03')", 'P03')}, {r("sum(eom) FILTER (coalesce(product_id NOT IN ('P01', 'P02', 'P03'), true))", '"Other"')} FROM {_DM} d WHERE {_LAST_OF_YEAR.format(_DM)} GROUP BY 1""")
def story_year_end_deposits(x):
    return res(stories.year_end_balances(_dm(x), "eom_balance", PRODUCT_IDS[:3]))


@query("story_year_end_loans", f"""
SELECT CAST(y AS INTEGER) AS year, {r("sum(bal) FILTER (product_id = 'P04')", 'P04')}, {r("sum(bal) FILTER (product_id = 'P05')", 'P05')},
  {r("sum(bal) FILTER (product_id = 'P09')", 'P09')}, {r("sum(bal) FILTER (coalesce(product_id NOT IN ('P04', 'P05', 'P09'), true))", '"Other"')} FROM {_LM} l WHERE {_LAST_OF_YEAR.format(_LM)} GROUP BY 1""")
def story_year_end_loans(x):
    return res(stories.year_end_balances(_lm(x), "balance_eom", PRODUCT_IDS[3:]))


def _pct(a):
    return f"sum({a})::DOUBLE / nullif(sum(bal)::DOUBLE, 0) * 100"


@query("story_risk_by_year_product", f"""
SELECT CAST(y AS INTEGER) AS year, product_id, {r('sum(bal)', 'balance_eom')}, {r(_pct('b90'), 'arrears90_pct')}, {r(_pct('s2'), 'stage2_pct')},
  {r(_pct('s3'), 'stage3_pct')}, {r(_pct('ecl'), 'ecl_cov_pct')} FROM {_LM} l WHERE {_LAST_OF_YEAR.format(_LM)} GROUP BY 1, 2""")
def story_risk_by_year_product(x):
    return res(stories.year_end_risk(_lm(x)))


@query("story_risk_wide", "SELECT CAST(y AS INTEGER) AS year, " + ", ".join(
    r(f"sum({c}) FILTER (product_id = '{p}')::DOUBLE / nullif(sum(bal) FILTER (product_id = '{p}')::DOUBLE, 0) * 100", f'"{p}_{n}"')
    for p in PRODUCT_IDS[3:] for c, n in [("b90", "arrears90_pct"), ("s2", "stage2_pct")]) +
    f" FROM {_LM} l WHERE {_LAST_OF_YEAR.format(_LM)} GROUP BY 1")
def story_risk_wide(x):
    return res(stories.year_end_risk_wide(_lm(x), PRODUCT_IDS[3:]))


@query("story_coverage_by_year", f"SELECT CAST(y AS INTEGER) AS year, {r(_pct('ecl'), 'ecl_cov_pct')} FROM {_LM} l WHERE {_LAST_OF_YEAR.format(_LM)} GROUP BY 1")
def story_coverage_by_year(x):
    return res(stories.coverage_by_year(_lm(x)))


@query("story_holiday_balances", f"SELECT month_end, {r('sum(hol)', 'hol')} FROM {_LM} l WHERE y = 1996 GROUP BY 1 HAVING sum(hol) > 0")
def story_holiday_balances(x):
    return res(stories.holiday_balances(_lm(x), 1996))


@query("story_writeoffs_by_year", f"SELECT CAST(y AS INTEGER) AS year, {r('sum(wo)', 'write_off')}, {r('sum(ga)', 'guarantee')}, {r('sum(nl)', 'new_lending')} FROM {_LM} l GROUP BY 1")
def story_writeoffs_by_year(x):
    return res(stories.write_offs_by_year(_lm(x)))


@query("story_vintage_default_rate", f"""
SELECT concat(year(open_date), 'Q', quarter(open_date)) AS vintage, count(*) AS loans, {r('avg(CASE WHEN hit.account_id IS NULL THEN 0.0::DOUBLE ELSE 1.0 END) * 100', 'default_rate')}
FROM accounts_all a LEFT JOIN (SELECT DISTINCT account_id FROM loan_stage WHERE product_id = 'P09' AND (arrears_bucket = '90+' OR account_status = 'Written Off')) hit
  ON hit.account_id = a.account_id WHERE a.product_id = 'P09' GROUP BY 1""")
def story_vintage_default_rate(x):
    return res(stories.vintage_default_rate(x.accounts, x.loan_rows))


@query("story_checkpoints", f"""
SELECT p AS month_end, (SELECT count(*) FROM nation WHERE CASE WHEN n_nationkey >= 20 THEN DATE '2001-03-31' WHEN n_nationkey >= 18 THEN DATE '2001-10-31' ELSE DATE '9999-12-31' END > p)::BIGINT AS branches_open,
  count(month_end) AS digital_registered, count(*) FILTER (is_monthly_active) AS monthly_active, {r('avg(app_sessions::DOUBLE)', 'avg_app_sessions')}
FROM (SELECT unnest([DATE '1999-12-31', DATE '2000-12-31', DATE '2001-06-30']) AS p) pts JOIN digital ON month_end = p GROUP BY 1""")
def story_checkpoints(x):
    points = x.digital_rows.select("month_end").distinct().filter((F.month("month_end") == 12) | (F.col("month_end") == F.lit(date(2001, 6, 30))))
    return res(stories.checkpoints(x.branches, x.digital_rows, points))


@query("resolved_within_56_days", f"""
SELECT CAST(year(received) AS INTEGER) AS year, count(*) AS complaints,
  {r("avg(CASE WHEN date_diff('day', received, resolved) <= 56 THEN 1.0::DOUBLE ELSE 0.0 END) * 100", 'within_8_weeks_pct')},
  {r('avg(CASE WHEN upheld THEN 1.0::DOUBLE ELSE 0.0 END) * 100', 'upheld_pct')} FROM complaint_stage GROUP BY 1""")
def resolved_within_56_days(x):
    return res(stories.complaints_by_year(x.complaint_stage))


@query("scam_before_after", f"""
SELECT CASE WHEN post_rule THEN 'after rule' ELSE 'before rule' END AS period, count(*) AS cases, {r('sum(loss)', 'loss')}, {r('sum(reimbursed)', 'reimbursed')},
  {r('sum(reimbursed)::DOUBLE / sum(loss)::DOUBLE * 100', 'reimbursement_pct')} FROM fraud WHERE fraud_type = 'APP Scam' GROUP BY 1""")
def scam_before_after(x):
    return res(stories.scams_before_and_after(x.fraud_stage, rule_start=RULE_START))


@query("budget_vs_actual", f"""
SELECT CAST(i.y AS INTEGER) AS year, {r('nt', 'actual_nii')}, {r('b1', 'budget_nii')}, {r('b2', 'full_year_budget')} FROM {_INCOME} i
JOIN (SELECT year(month_end) AS y, sum(CASE WHEN month_end <= {LAST} THEN b_nii ELSE 0 END) AS b1, sum(b_nii) AS b2 FROM budget GROUP BY 1) b ON b.y = i.y""")
def budget_vs_actual(x):
    return res(stories.budget_against_actual(stories.yearly_income(_dm(x), _lm(x)), x.budget_stage, LAST_ACTUAL))


@query("story_cost_income", f"""
SELECT CAST(i.y AS INTEGER) AS year, {r('c::DOUBLE / nullif((nt + fees)::DOUBLE, 0) * 100', 'cost_income_pct')} FROM {_INCOME} i
JOIN (SELECT year(month_end) AS y, sum(actual) AS c FROM opex GROUP BY 1) o ON o.y = i.y""")
def story_cost_income(x):
    return res(stories.cost_income_by_year(stories.yearly_income(_dm(x), _lm(x)), x.opex_stage))


@query("dup_counts", """
SELECT count(*) AS total_rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderdate, o_orderpriority, o_orderstatus FROM orders) d) AS duplicate_rows
FROM orders""")
def dup_counts(x):
    return duplicate_row_count(x.t("orders").select("o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"))


# ---------------------------------------------------------------- loan formulas and finance series


@query("annuity", f"""
SELECT l_orderkey, l_linenumber, price::DOUBLE AS price, product_id, l_returnflag, round(pay, 8) AS payment, round(price::DOUBLE * (disc * 100)::DOUBLE / 1200.0, 8) AS interest FROM (
  SELECT *, CASE WHEN disc > 0 THEN price::DOUBLE * ((disc * 100)::DOUBLE / 1200.0) / (1 - pow(1 + (disc * 100)::DOUBLE / 1200.0, -greatest(qty::DOUBLE * 5, 1.0)))
    ELSE price::DOUBLE / greatest(qty::DOUBLE * 5, 1.0) END AS pay FROM base_rows) s""")
def annuity(x):
    d = x.base.select("l_orderkey", "l_linenumber", F.col("price").cast("double").alias("price"), "product_id", "l_returnflag",
                      (F.col("disc") * 100).cast("double").alias("rate"), (F.col("qty").cast("double") * 5).alias("n"))
    # a price over a whole number of months can end at the seventh place
    return d.select("l_orderkey", "l_linenumber", "price", "product_id", "l_returnflag",
                    F.round(risk.annuity_payment("price", "rate", "n"), 8).alias("payment"),
                    F.round(risk.monthly_interest("price", "rate"), 8).alias("interest"))


_PD = "CASE WHEN arrears_bucket = '90+' THEN 1.0::DOUBLE ELSE least(greatest((1 - pow(1 - p, 12)) * 0.28::DOUBLE * CASE arrears_bucket WHEN '1-29' THEN 8.0 WHEN '30-59' THEN 20.0 WHEN '60-89' THEN 35.0 ELSE 1.0 END::DOUBLE, 0.0003::DOUBLE), 0.95::DOUBLE) END"
_LGD = "CASE WHEN product_id = 'P04' THEN least(greatest(1 - 0.75::DOUBLE / greatest(ltv, 0.01::DOUBLE), 0.0::DOUBLE), 1.0::DOUBLE) + 0.03::DOUBLE WHEN product_id = 'P05' THEN 0.80::DOUBLE ELSE 0.05::DOUBLE END"
_STAGE = "CASE WHEN arrears_bucket = '90+' THEN 3 WHEN arrears_bucket <> 'Current' OR (pd * 1.25::DOUBLE >= 4.0::DOUBLE * p AND pd >= 0.004) THEN 2 ELSE 1 END"
_EAD = "bal + greatest(coalesce(lim, 0.0::DOUBLE) - bal, 0.0::DOUBLE) * CASE WHEN st = 1 THEN 0.4::DOUBLE ELSE 0.6::DOUBLE END"
_LOSS = "CASE WHEN st = 1 THEN pd WHEN st = 2 THEN 1 - pow(1 - pd, 5.0::DOUBLE) ELSE 1.0::DOUBLE END * lgd * ead * 1.25::DOUBLE"


@query("pd_lgd_ead_ecl", f"""
SELECT account_id, month_end, bal AS balance, CAST(st AS INTEGER) AS stage, {rs('pd', 'lgd', 'ead')}, round(({_LOSS})::DOUBLE, 8) AS ecl FROM (SELECT *, {_EAD} AS ead FROM (
  SELECT *, {_STAGE} AS st, {_LGD} AS lgd FROM (SELECT *, {_PD} AS pd FROM (SELECT account_id, month_end, product_id, arrears_bucket, balance_eom::DOUBLE AS bal, credit_limit::DOUBLE AS lim,
    pd_12m::DOUBLE / 10 AS p, current_ltv::DOUBLE AS ltv FROM loan_stage) a) b) c) d""")
def pd_lgd_ead_ecl(x):
    d = x.loan_rows.withColumn("p", F.col("pd_12m") / 10)
    d = d.withColumn("pd", risk.pd_12m("p", "arrears_bucket")).withColumn("lgd", risk.loss_given_default("product_id", "current_ltv"))
    d = d.withColumn("stage", risk.stage("arrears_bucket", "pd", "p", F.lit(1.25)))
    d = d.withColumn("ead", risk.exposure_at_default("balance_eom", "credit_limit", "stage"))
    d = d.withColumn("loss", risk.expected_loss("stage", "pd", "lgd", "ead", F.lit(5.0), F.lit(1.25)))
    # the product of two, four and two decimal places: eight places hold it without a tie
    return d.select("account_id", "month_end", F.round("balance_eom", 6).alias("balance"), "stage", F.round("pd", 6).alias("pd"),
                    F.round("lgd", 6).alias("lgd"), F.round("ead", 6).alias("ead"), F.round("loss", 8).alias("ecl"))


_DRIFT = "(ltv - 0.3)"
_STAGE_ALL = ("CASE WHEN arrears_bucket = '90+' THEN 3 WHEN arrears_bucket <> 'Current' OR (pd * 1.25::DOUBLE >= 4.0::DOUBLE * p AND pd >= 0.004) "
              f"OR (weak AND coalesce({_DRIFT} > 0.4::DOUBLE, false)) OR is_payment_holiday THEN 2 ELSE 1 END")


@query("stage_with_overlays", f"""
SELECT arrears_bucket AS bucket, CAST(st AS INTEGER) AS stage, count(*) AS n, count(*) FILTER (is_payment_holiday) AS holidays,
  count(*) FILTER (weak AND {_DRIFT} > 0.4::DOUBLE) AS weak_and_drifted, {r('sum(bal)', 'balance')} FROM (SELECT *, {_STAGE_ALL} AS st FROM (SELECT *, {_PD} AS pd FROM (
  SELECT arrears_bucket, balance_eom AS bal, pd_12m::DOUBLE / 10 AS p, current_ltv::DOUBLE AS ltv, is_payment_holiday, c.score_band IN ('Very Poor', 'Poor') AS weak
  FROM loan_stage JOIN cust c ON c.c_custkey = o_custkey) a) b) d GROUP BY ALL""")
def stage_with_overlays(x):
    """The stage with both further signs: a weak score whose risk drifted away, and a payment holiday."""
    owner = x.account_numbers.join(x.dim_customer.select("CustomerKey", "CreditScoreBand"), "CustomerKey").select(
        F.col("AccountID").alias("account_id"), F.col("CreditScoreBand").isin("Very Poor", "Poor").alias("weak"))
    d = x.loan_rows.join(owner, "account_id").withColumns({"p": F.col("pd_12m") / 10, "drift": F.coalesce(F.col("current_ltv") - 0.3, F.lit(0.0))})
    d = d.withColumn("pd", risk.pd_12m("p", "arrears_bucket"))
    d = d.withColumn("stage", risk.stage("arrears_bucket", "pd", "p", F.lit(1.25), "weak", "drift", "is_payment_holiday"))
    return res(d.groupBy(F.col("arrears_bucket").alias("bucket"), "stage").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_payment_holiday").alias("holidays"),
        F.count_if(F.col("weak") & (F.col("drift") > risk.WEAK_DRIFT)).alias("weak_and_drifted"), F.sum(F.col("balance_eom").cast("decimal(18,2)")).alias("balance")))


@query("payment_shock", f"""
SELECT e.date_key, e.account_id, {r('e.scheduled_payment::DOUBLE / p.scheduled_payment::DOUBLE', 'shock')}, e.scheduled_payment::DOUBLE / p.scheduled_payment::DOUBLE > 1.10::DOUBLE AS over_limit
FROM loan e JOIN loan p ON p.account_id = e.account_id AND p.month_end = last_day(e.month_end - INTERVAL 1 MONTH)
WHERE e.product_id = 'P04' AND (e.is_product_transfer OR e.is_deal_maturity) AND e.account_status = 'Open' AND p.scheduled_payment > 0""")
def payment_shock(x):
    """Each repriced mortgage's new payment against that of the month before."""
    shock, over = risk.payment_shock("ScheduledPayment", "OldScheduledPayment")
    d = marts.repricing_events(x.loans, x.dim_product).join(x.account_numbers.select("AccountKey", F.col("AccountID").alias("account_id")), "AccountKey")
    return res(d.select(F.col("DateKey").alias("date_key"), "account_id", shock.alias("shock"), over.alias("over_limit")))


def _index(x):
    """A price index: mean order value per month relative to a constant."""
    return x.t("orders").groupBy(F.last_day(F.col("o_orderdate").cast("date")).alias("month_end")).agg(
        (F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("double") / F.count(F.lit(1)) / 100000.0).alias("idx"))


@query("indexed_ltv", f"""
SELECT s.account_id, s.month_end, s.bal AS balance, {r('s.bal / (s.val * ((1 + (n.idx - 1) * f) / (1 + (o.idx - 1) * f)))', 'ltv')} FROM (
  SELECT b.account_id, b.month_end, price::DOUBLE AS bal, a.amount::DOUBLE * 2 AS val, last_day(a.open_date) AS om, 0.8::DOUBLE + c.region_key::DOUBLE / 10 AS f
  FROM base_rows b JOIN accounts_all a ON a.account_id = b.account_id JOIN cust c ON c.c_custkey = b.o_custkey WHERE b.product_id = 'P04') s
JOIN (SELECT last_day(CAST(o_orderdate AS DATE)) AS m, sum(o_totalprice::DECIMAL(12,2))::DOUBLE / count(*) / 100000.0 AS idx FROM orders GROUP BY 1) n ON n.m = s.month_end
JOIN (SELECT last_day(CAST(o_orderdate AS DATE)) AS m, sum(o_totalprice::DECIMAL(12,2))::DOUBLE / count(*) / 100000.0 AS idx FROM orders GROUP BY 1) o ON o.m = s.om""")
def indexed_ltv(x):
    a = x.accounts.select("account_id", (F.col("original_amount") * 2).alias("origination_value"), F.last_day(F.to_date("open_date")).alias("open_month"))
    c = x.dim_customer.select(F.col("CustomerID").alias("customer_id"), F.col("RegionKey").alias("region"))
    loans = x.base.filter("product_id = 'P04'").join(a, "account_id").join(c, "customer_id").select(
        "account_id", "month_end", "open_month", "region", F.col("price").cast("double").alias("balance"), "origination_value")
    growth = x.dim_region.select(F.col("RegionKey").alias("region"), (F.lit(0.8) + F.col("RegionKey").cast("double") / 10).alias("factor"))
    return res(finance.indexed_ltv(loans, _index(x), growth), account_id="account_id", month_end="month_end", balance="balance", ltv="indexed_ltv")


@query("arrears_bucket", """
SELECT arrears_bucket AS bucket, count(*) AS n, min(days_past_due)::BIGINT AS low, max(days_past_due)::BIGINT AS high FROM loan_stage GROUP BY 1""")
def arrears_bucket_query(x):
    return x.loan_rows.groupBy(arrears_bucket("days_past_due").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.min("days_past_due").alias("low"), F.max("days_past_due").alias("high"))


@query("average_balance", f"""
SELECT account_id, month_end, {r('bal', 'balance')}, {r('((CASE WHEN prev > 0 THEN prev ELSE bal * 0.6::DOUBLE END) + bal) / 2', 'avg_balance')} FROM (
  SELECT *, lag(bal) OVER (PARTITION BY account_id ORDER BY month_end) AS prev FROM (SELECT account_id, month_end, sum(price)::DOUBLE AS bal FROM base_rows GROUP BY 1, 2) g) s""")
def average_balance_query(x):
    months = x.base.groupBy("account_id", "month_end").agg(F.sum("price").cast("double").alias("balance"))
    return res(average_balance(months, "account_id", "month_end", "balance"))


_CELLS = f"""(SELECT month_end, region_key AS region, product_id AS product, sum(balance_eom)::DOUBLE AS balance, sum(interest_income - ftp_charge)::DOUBLE AS nii,
  sum(fee_income)::DOUBLE AS fees, sum(ecl)::DOUBLE AS ecl, sum(write_off_amount - guarantee_claim_amount)::DOUBLE AS nwo FROM loan WHERE month_end <= {LAST} GROUP BY ALL)"""
_FLOW = f"(SELECT *, coalesce(ecl - lag(ecl) OVER (PARTITION BY region, product ORDER BY month_end), ecl * 0.02::DOUBLE) + nwo AS impairment FROM {_CELLS} c)"


def _cells(x):
    l = x.loans.filter(F.col("DateKey") <= date_key(F.lit(LAST_ACTUAL))).join(x.dim_product.select("ProductKey", "ProductID"), "ProductKey")
    rows = l.select(F.last_day(F.to_date(F.col("DateKey").cast("string"), "yyyyMMdd")).alias("month_end"), F.col("RegionKey").alias("region"),
                    F.col("ProductID").alias("product"), F.col("BalanceEOM").alias("balance"), (F.col("InterestIncome") - F.col("FTPCharge")).alias("nii"),
                    F.col("FeeIncome").alias("fees"), F.col("ECL").alias("ecl"), (F.col("WriteOffAmount") - F.col("GuaranteeClaimAmount")).alias("net_write_off"))
    cells = finance.balances_by_cell(rows, ["balance", "nii", "fees", "ecl", "net_write_off"])
    return cells.select("month_end", "region", "product", *[F.col(c).cast("double").alias(c) for c in ("balance", "nii", "fees", "ecl", "net_write_off")])


@query("balance_by_cell", f"SELECT month_end, region, product, {rs('balance', 'nii', 'fees', 'ecl')}, {r('nwo', 'net_write_off')} FROM {_CELLS} c")
def balance_by_cell(x):
    return res(_cells(x))


@query("impairment_flow", f"SELECT month_end, region, product, {rs('impairment')} FROM {_FLOW} f")
def impairment_flow(x):
    return res(finance.impairment_flow(_cells(x)), month_end="month_end", region="region", product="product", impairment="impairment")


@query("budget_seed", f"""
SELECT last_day(CAST(month_end + to_months(k) AS DATE)) AS month_end, region, product, {r('balance * (0.9::DOUBLE + (year(last_day(CAST(month_end + to_months(k) AS DATE))) % 10)::DOUBLE / 100) * pow(1.002::DOUBLE, k)', 'budget_balance')},
  {r('nii * 1.05::DOUBLE * pow(0.995::DOUBLE, k)', 'budget_nii')}, {r('fees * 1.02::DOUBLE', 'budget_fees')}, {r('greatest(smooth, 0.0::DOUBLE) * 0.9::DOUBLE', 'budget_impairment')}
FROM (SELECT *, unnest(CASE WHEN month_end = {LAST} THEN [0, 1, 2, 3, 4, 5] ELSE [0] END) AS k FROM (SELECT *, avg(impairment) OVER (PARTITION BY region, product
  ORDER BY month_end ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS smooth FROM {_FLOW} f) s) t""")
def budget_seed(x):
    bias = x.dim_date.select(F.col("Year").alias("year")).distinct().select(
        "year", (F.lit(0.9) + (F.col("year") % 10).cast("double") / 100).alias("bias_balance"), F.lit(1.05).alias("bias_nii"),
        F.lit(1.02).alias("bias_fees"), F.lit(0.9).alias("bias_impairment"))
    return res(finance.budget_seed(finance.impairment_flow(_cells(x)), bias, 5))


@query("cost_driver_index", f"""
SELECT month_end, region, {r('raw * 0.52::DOUBLE * (SELECT sum(balance) FROM ' + _CELLS + ' c) / (sum(raw) OVER ())', 'cost')} FROM (
  SELECT month_end, region, sum(balance) / (SELECT sum(balance) FROM {_CELLS} c WHERE month_end = DATE '1995-01-31') * 0.6::DOUBLE
     + sum(fees) / (SELECT sum(fees) FROM {_CELLS} c WHERE month_end = DATE '1995-01-31') * 0.4::DOUBLE AS raw FROM {_CELLS} c GROUP BY 1, 2) s""")
def cost_driver_index(x):
    cells = _cells(x)
    drivers = cells.groupBy("month_end", "region").agg(F.sum("balance").alias("balance"), F.sum("fees").alias("fees"))
    income = cells.groupBy("month_end").agg(F.sum("balance").alias("income"))
    return res(finance.cost_driver_index(drivers, {"balance": 0.6, "fees": 0.4}, income).select("month_end", "region", "cost"))


@query("interpolate_linear", f"""
SELECT d AS day, {r('''CASE WHEN y1 IS NULL THEN y0 WHEN y0 IS NULL THEN y1 ELSE coalesce(y0 + (y1 - y0) / nullif(x1 - x0, 0) * (i - x0), y0) END''', 'value')} FROM (
  SELECT d, i, last_value(CASE WHEN rt IS NOT NULL THEN i END IGNORE NULLS) OVER b AS x0, last_value(rt IGNORE NULLS) OVER b AS y0,
    first_value(CASE WHEN rt IS NOT NULL THEN i END IGNORE NULLS) OVER a AS x1, first_value(rt IGNORE NULLS) OVER a AS y1 FROM (
      SELECT c.d, date_diff('day', DATE '1995-01-01', c.d) AS i, s.r::DOUBLE AS rt FROM rate c LEFT JOIN rate_seen s ON s.d = c.d) q
  WINDOW b AS (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) z""")
def interpolate_linear_query(x):
    from ledgerlake.functions.dates import key_date
    from ledgerlake.plans import facts
    seen = facts.valid_rates(x.rate_stage).select("Date", F.col("BankRate").cast("double").alias("rt"))
    days = x.rate.select(key_date("DateKey").alias("Date")).join(seen, "Date", "left")
    days = days.withColumn("i", F.datediff("Date", F.lit(date(1995, 1, 1))))
    return res(interpolate_linear(days, "i", "rt", "value"), day="Date", value="value")


@query("spread_month_to_days", f"""
SELECT t.month_end, t.region, d.d AS day, {r('t.total * d.w / (avg(d.w) OVER (PARTITION BY t.region, t.month_end)) / (count(*) OVER (PARTITION BY t.region, t.month_end))', 'amount')}
FROM (SELECT month_end, region, sum(fees) AS total FROM {_CELLS} c GROUP BY 1, 2) t JOIN (SELECT last_day(CAST(o_orderdate AS DATE)) AS m, CAST(o_orderdate AS DATE) AS d,
  count(*)::DOUBLE AS w FROM orders GROUP BY 1, 2) d ON d.m = t.month_end""")
def spread_month_to_days_query(x):
    monthly_total = _cells(x).groupBy("month_end", "region").agg(F.sum("fees").alias("total"))
    days = x.t("orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count(F.lit(1)).cast("double").alias("w"))
    days = days.withColumn("month_end", F.last_day("day"))
    return res(spread_month_to_days(monthly_total, days, "month_end", "day", "total", "w", "amount", ["region"]))


# ---------------------------------------------------------------- platform

_TABLES = ["customer", "orders", "lineitem", "events", "part", "supplier", "nation", "region", "documents", "labels", "pages", "conversations"]
_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in _TABLES)


def _platform(x) -> Model:
    """Driver tables as a warehouse: rows per table and layer, events as run log, checks as quality log."""
    counts = control.row_counts({t: x.t(t) for t in _TABLES}, "table_name")
    stats = counts.withColumn("layer", F.when(F.col("table_name").isin("orders", "lineitem", "events"), "gold").otherwise("stg")).withColumn(
        "used_mb", (F.col("row_count") / 1000).cast("decimal(12,2)"))
    runs = x.t("events").select(
        F.col("event_type").alias("activity"), F.concat(F.lit("table "), F.hour("ts").cast("string")).alias("source_table"),
        F.when(F.col("event_type") == "error", "Failed").when(F.col("event_type") == "signup", "Skipped").otherwise("Succeeded").alias("status"),
        F.floor("value").cast("bigint").alias("rows_written"), F.date_trunc("hour", "ts").alias("ended_at_utc"),
        F.col("ts").alias("started_at_utc"), F.to_date("ts").alias("run_date"))
    dup = control.dq_rows(quality.duplicates(x.deposit_rows, ["account_id"], "month_end"), layer="gold", table="deposits", period="month_end",
                          check="Duplicate rows removed", severity="Warning", action="one row of each account and month stays")
    stage = control.dq_rows(quality.missing(x.loan_rows, "ifrs9_stage", "month_end"), layer="gold", table="loans", period="month_end",
                            check="Missing stage", severity="Error", action="Imputed from arrears")
    _, marks = _marks(x)
    tables = {"dim_date": x.dim_date, "all_dates": x.dim_date, "platform_table_stats": stats, "pipeline_runs": runs, "last_load": latest_runs(runs),
              "data_quality_summary": control.dq_summary(dup.unionByName(stage)), "load_status": marks}
    return Model(tables, LAST_ACTUAL, build_registry())


def _marks(x):
    from .q_load import _plan_tables
    return _plan_tables(x)


_DQ = """(SELECT 'deposits' AS table_name, 'Warning' AS severity, sum(n - 1) AS a FROM (SELECT count(*) AS n FROM dep_stage GROUP BY account_id, month_end) g
  UNION ALL SELECT 'loans', 'Error', count(*) FROM loan_stage WHERE ifrs9_stage IS NULL)"""
_RUNS = """(SELECT *, CASE event_type WHEN 'error' THEN 'Failed' WHEN 'signup' THEN 'Skipped' ELSE 'Succeeded' END AS status FROM events)"""


@query("platform_kpis", f"""
SELECT (SELECT sum(n) FROM ({_COUNTS}) c WHERE table_name IN ('orders','lineitem','events'))::BIGINT AS rows_gold, (SELECT sum(n) FROM ({_COUNTS}) c)::BIGINT AS rows_all,
  (SELECT count(*) FROM ({_COUNTS}) c) AS tables_n, (SELECT count(*) FROM events) AS runs_n,
  {r(f"(SELECT count(*) FILTER (status = 'Succeeded')::DOUBLE / count(*) FILTER (status <> 'Skipped') FROM {_RUNS} e)", 'success_rate')},
  (SELECT sum(floor(value))::BIGINT FROM events) AS rows_copied,
  (SELECT (epoch(date_trunc('hour', max(ts))) - epoch(date_trunc('minute', min(ts)))) // 60 FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events))::BIGINT AS last_load_minutes,
  (SELECT sum(a)::BIGINT FROM {_DQ} d) AS issues_fixed, (SELECT count(*) FROM {_DQ} d) AS checks_n,
  concat('Loaded to ', strftime((SELECT max(last_day(o_orderdate)) FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '2-HIGH'), '%b %Y')) AS freshness,
  '31 Jul 2001' AS data_as_of""")
def platform_kpis(x):
    d = evaluate(_platform(x), Context(), [], [
        "Rows in Warehouse", "Rows All Layers", "Tables Monitored", "Pipeline Runs", "Pipeline Success Rate", "Rows Copied",
        "Last Load Duration min", "DQ Issues Fixed", "DQ Checks Triggered", "Data Freshness", "Data As Of"])
    return res(d, rows_gold="Rows in Warehouse", rows_all="Rows All Layers", tables_n="Tables Monitored", runs_n="Pipeline Runs",
               success_rate="Pipeline Success Rate", rows_copied="Rows Copied", last_load_minutes="Last Load Duration min",
               issues_fixed="DQ Issues Fixed", checks_n="DQ Checks Triggered", freshness="Data Freshness", data_as_of="Data As Of")


@query("top_tables", f"""
SELECT table_name, CASE WHEN table_name IN ('orders','lineitem','events') THEN 'gold' ELSE 'stg' END AS layer, n::BIGINT AS row_count,
  {r('round(n::DECIMAL(18,2) / 1000, 2)', 'used_mb')} FROM ({_COUNTS}) c ORDER BY n DESC, table_name LIMIT 10""")
def top_tables(x):
    return res(reports.rows_by_table(_platform(x)), table_name="table_name", layer="layer", row_count="Rows All Layers", used_mb="Warehouse Size MB")


@query("run_list", f"""
SELECT event_type AS activity, concat('table ', hour(ts)) AS source_table, status, strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS ended, sum(floor(value))::BIGINT AS rows_written,
  CASE status WHEN 'Succeeded' THEN 'good' WHEN 'Failed' THEN 'bad' ELSE 'neutral' END AS state FROM {_RUNS} e GROUP BY ALL""")
def run_list(x):
    d = reports.run_list(_platform(x).tables["pipeline_runs"])
    return d.select("activity", "source_table", "status", F.date_format("ended_at_utc", "yyyy-MM-dd HH").alias("ended"), "rows_written",
                    run_status("status").alias("state"))


@query("dq_list", f"""
SELECT 'gold' AS layer, table_name, CASE table_name WHEN 'deposits' THEN 'Duplicate rows removed' ELSE 'Missing stage' END AS check_name, severity, a::BIGINT AS affected_rows,
  CASE severity WHEN 'Error' THEN 'bad' ELSE 'warn' END AS state FROM {_DQ} d WHERE a > 0""")
def dq_list(x):
    d = reports.dq_list(_platform(x).tables["data_quality_summary"])
    return d.select("layer", "table_name", "check_name", "severity", F.col("affected_rows").cast("bigint").alias("affected_rows"),
                    severity_status("severity").alias("state"))


@query("run_status_measure", f"""
SELECT status, count(*) AS runs_n, CASE status WHEN 'Succeeded' THEN 'good' WHEN 'Failed' THEN 'bad' ELSE 'neutral' END AS state FROM {_RUNS} e GROUP BY 1""")
def run_status_measure(x):
    d = evaluate(_platform(x), Context(), ["pipeline_runs.status"], ["Pipeline Runs", "Run Status Colour"])
    return res(d, status="status", runs_n="Pipeline Runs", state="Run Status Colour")


@query("dq_severity_measure", f"""
SELECT severity, count(*) AS checks_n, sum(a)::BIGINT AS issues, CASE severity WHEN 'Error' THEN 'bad' ELSE 'warn' END AS state FROM {_DQ} d WHERE a > 0 GROUP BY 1""")
def dq_severity_measure(x):
    d = evaluate(_platform(x), Context(), ["data_quality_summary.severity"], ["DQ Checks Triggered", "DQ Issues Fixed", "DQ Severity Colour"])
    return res(d.withColumn("issues", F.col("DQ Issues Fixed").cast("bigint")), severity="severity", checks_n="DQ Checks Triggered", issues="issues", state="DQ Severity Colour")


# ---------------------------------------------------------------- basic operators on the order tables


@query("basic_joins", f"""
SELECT r_name, n_name, count(o_orderkey) AS orders_n, {r('sum(o_totalprice::DECIMAL(12,2))', 'total')}, count(DISTINCT c_custkey) AS customers_n
FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P'
GROUP BY ALL""")
def basic_joins(x):
    o = x.t("orders").filter("o_orderstatus = 'P'")
    d = x.customer_region.join(o, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("r_name", "n_name").agg(
        F.count("o_orderkey").alias("orders_n"), F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("total"),
        F.count_distinct("c_custkey").alias("customers_n"))
    return res(d)


@query("semi_join_ever_set", """
SELECT c_mktsegment AS segment, count(*) AS customers_n, count(*) FILTER (c_custkey IN (SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  WHERE l_returnflag = 'R' AND l_quantity >= 49)) AS ever_returned FROM customer GROUP BY 1""")
def semi_join_ever_set(x):
    ever = x.base.filter("l_returnflag = 'R' and qty >= 49").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("hit", F.lit(True))
    return x.t("customer").join(ever, "c_custkey", "left").groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("customers_n"), F.count("hit").alias("ever_returned"))


@query("basic_aggs", f"""
SELECT l_returnflag, l_linestatus, count(*) AS n, {r('sum(l_extendedprice::DECIMAL(12,2))', 'total')}, {r('min(l_extendedprice)', 'low')}, {r('max(l_extendedprice)', 'high')},
  {r('sum(l_quantity::DECIMAL(12,2))::DOUBLE / count(*)', 'mean_qty')}, count(DISTINCT l_suppkey) AS suppliers_n, count(*) FILTER (l_quantity > 25) AS big_n,
  {r('sum(l_extendedprice::DECIMAL(12,2) * l_discount::DECIMAL(4,2))::DOUBLE / sum(l_extendedprice::DECIMAL(12,2))::DOUBLE', 'weighted_discount')}
FROM lineitem GROUP BY 1, 2""")
def basic_aggs(x):
    p, d, q = F.col("l_extendedprice").cast("decimal(12,2)"), F.col("l_discount").cast("decimal(4,2)"), F.col("l_quantity").cast("decimal(12,2)")
    return res(x.t("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(p).alias("total"), F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high"),
        (F.sum(q).cast("double") / F.count(F.lit(1))).alias("mean_qty"), F.count_distinct("l_suppkey").alias("suppliers_n"),
        F.count_if(F.col("l_quantity") > 25).alias("big_n"), ratio(F.sum(p * d), F.sum(p)).alias("weighted_discount")))


@query("basic_filters", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED')
  AND o_orderdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-06-30' AND (o_totalprice > 300000 OR o_orderpriority = '1-URGENT')""")
def basic_filters(x):
    o = x.t("orders")
    return o.filter(F.col("o_orderstatus").isin("F", "O") & ~F.col("o_orderpriority").isin("5-LOW", "4-NOT SPECIFIED")
                    & F.col("o_orderdate").between(F.lit("1998-01-01").cast("timestamp_ntz"), F.lit("1998-06-30").cast("timestamp_ntz"))
                    & ((F.col("o_totalprice") > 300000) | (F.col("o_orderpriority") == "1-URGENT"))).select("o_orderkey", "o_orderstatus")


@query("active_at_date", """
SELECT region_key, count(*) FILTER ((first_order IS NULL OR first_order <= DATE '1999-06-30') AND (last_order >= DATE '2001-01-01' OR last_order > DATE '1999-06-30' OR last_order IS NULL)) AS active
FROM cust LEFT JOIN life ON o_custkey = c_custkey GROUP BY 1""")
def active_at_date(x):
    d = F.lit(date(1999, 6, 30))
    active = (F.col("OnboardingDate").isNull() | (F.col("OnboardingDate") <= d)) & (F.col("ChurnDate").isNull() | (F.col("ChurnDate") > d))
    return x.dim_customer_full.groupBy(F.col("RegionKey").alias("region_key")).agg(F.count_if(active).alias("active"))


@query("set_ops", """
SELECT kind, k, count(*) AS n FROM (SELECT 'order' AS kind, o_custkey AS k FROM orders UNION ALL SELECT 'event', user_id FROM events
  UNION ALL SELECT DISTINCT 'distinct', o_custkey FROM orders) u GROUP BY 1, 2""")
def set_ops(x):
    o = x.t("orders").select(F.lit("order").alias("kind"), F.col("o_custkey").alias("k"))
    e = x.t("events").select(F.lit("event").alias("kind"), F.col("user_id").alias("k"))
    once = o.select(F.lit("distinct").alias("kind"), "k").distinct()
    return reduce(DataFrame.unionByName, [o, e, once]).groupBy("kind", "k").agg(F.count(F.lit(1)).alias("n"))


@query("sort_limit", """
SELECT l.l_suppkey, count(*) AS n FROM lineitem l JOIN (SELECT l_suppkey FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, l_suppkey LIMIT 10) t ON t.l_suppkey = l.l_suppkey
GROUP BY 1 ORDER BY n DESC""")
def sort_limit(x):
    top = top_categories(x.t("lineitem").select("l_suppkey"), "l_suppkey", F.count(F.lit(1)), 10)
    return top.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"))


@query("slicer_values", """
SELECT 'region' AS slicer, region_name AS choice FROM regions_named UNION ALL SELECT DISTINCT 'segment', segment FROM cust
UNION ALL SELECT DISTINCT 'brand', brand FROM cust
UNION ALL SELECT 'year', CAST(y AS VARCHAR) FROM (SELECT unnest(generate_series(year(min(d)), year(max(d)))) AS y FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem) t) s
UNION ALL SELECT 'month', strftime(make_date(2000, CAST(range AS INTEGER), 1), '%b') FROM range(1, 13)""")
def slicer_values(x):
    m = replace(x.model, tables={t: x.model.tables[t] for t in ("dim_date", "dim_region", "dim_segment", "dim_brand")})
    values = reports.slicer_values(m)
    return reduce(DataFrame.unionByName, [values[n].select(F.lit(n).alias("slicer"), F.col(values[n].columns[0]).cast("string").alias("choice"))
                                          for n in ("region", "segment", "brand", "year", "month")])


@query("scalar_misc", f"""
SELECT l_orderkey, l_linenumber, qty::DOUBLE AS qty, price::DOUBLE AS price, date_diff('month', order_date, ship_date) AS months_n, date_diff('day', order_date, ship_date) AS days_n,
  last_day(CAST(order_date - INTERVAL 1 MONTH AS DATE)) AS prev_end, concat(year(order_date), 'Q', quarter(order_date)) AS quarter_period,
  concat(year(order_date), ' Q', quarter(order_date)) AS key_quarter, CASE WHEN disc < 0.02 THEN 'low' WHEN disc < 0.05 THEN 'mid' ELSE 'high' END AS band_open,
  CASE WHEN disc <= 0.02 THEN 'low' WHEN disc <= 0.05 THEN 'mid' ELSE 'high' END AS band_closed, printf('%.1f', round(disc::DOUBLE * 100, 1)) || '%' AS pct_text,
  {r('least(price::DOUBLE - 50000, 0)', 'smaller_zero')}, ship_date < order_date AS early FROM base_rows""")
def scalar_misc(x):
    disc = F.col("disc")
    return res(x.base.select(
        "l_orderkey", "l_linenumber", F.col("qty").cast("double").alias("qty"), F.col("price").cast("double").alias("price"),
        months_crossed("order_date", "ship_date").cast("bigint").alias("months_n"), days_between("order_date", "ship_date").cast("bigint").alias("days_n"),
        month_end("order_date", -1).alias("prev_end"), quarter_period("order_date").alias("quarter_period"),
        quarter_label_of_key(date_key("order_date")).alias("key_quarter"),
        band(disc, [0.02, 0.05], ["low", "mid", "high"], closed="lower").alias("band_open"),
        band(disc, [0.02, 0.05], ["low", "mid", "high"], closed="upper").alias("band_closed"), number_text(disc.cast("double"), "0.0%").alias("pct_text"),
        smaller(F.col("price").cast("double") - 50000, F.lit(None).cast("double")).alias("smaller_zero"), (F.col("ship_date") < F.col("order_date")).alias("early")))


@query("minutes_between", """
SELECT user_id, (epoch(date_trunc('minute', max(ts))) - epoch(date_trunc('minute', min(ts)))).round()::BIGINT // 60 AS minutes_n FROM events GROUP BY 1""")
def minutes_between(x):
    return x.t("events").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b")).select("user_id", minutes_crossed("a", "b").alias("minutes_n"))


@query("late_month_buckets", """
SELECT last_day(CAST(ts AS DATE)) AS month_end, event_type, count(*) AS n, round(sum(value::DECIMAL(18,2))::DOUBLE, 6) AS total FROM events GROUP BY 1, 2""")
def late_month_buckets(x):
    return res(monthly.month_totals(x.t("events"), "ts", ["event_type"], "value"))


# ---------------------------------------------------------------- streams


def _arriving_events(x, root: str, load) -> None:
    """Events land in three files that share days and users, the first of them twice; a run follows each landing."""
    events = x.t("events")
    for k in (0, 1, 2, 0):
        events.where(F.pmod("event_id", F.lit(3)) == k).write.mode("append").parquet(f"{root}/in")
        load(monthly.landing_stream(x.spark, f"{root}/in", events.schema)).awaitTermination()


@query("stream_incremental", f"""
SELECT {KEY.format('ts')} AS "DateKey", event_type, count(*) AS n, round(sum(value::DECIMAL(18,2))::DOUBLE, 6) AS total FROM events GROUP BY 1, 2""")
def stream_incremental(x):
    """Files with events of the same days arrive one after the other; every day's total adds up."""
    root = work_folder(x.spark)

    def by_day(rows):
        return rows.withColumn("DateKey", date_key(F.to_date("ts")))

    def daily(rows):
        return rows.groupBy("DateKey", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total"))

    _arriving_events(x, root, lambda stream: monthly.load_arrived_events(
        stream, by_day, f"{root}/events", daily, f"{root}/daily", "event_id", "DateKey", f"{root}/checkpoint"))
    return res(read_table(x.spark, f"{root}/daily")).select("DateKey", "event_type", "n", "total")


@query("stream_late_upsert", "SELECT user_id, event_type, count(*) AS n, max(event_id) AS last_id FROM events GROUP BY 1, 2")
def stream_late_upsert(x):
    """Counts by user and type over files that share users; nothing is dropped for being late."""
    root = work_folder(x.spark)

    def by_user(rows):
        return rows.withColumn("Bucket", F.pmod(F.xxhash64("user_id"), F.lit(16)).cast("int"))

    def counts(rows):
        return rows.groupBy("Bucket", "user_id", "event_type").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_id"))

    _arriving_events(x, root, lambda stream: monthly.load_arrived_events(
        stream, by_user, f"{root}/events", counts, f"{root}/latest", "event_id", "Bucket", f"{root}/checkpoint"))
    return read_table(x.spark, f"{root}/latest").select("user_id", "event_type", "n", "last_id")
