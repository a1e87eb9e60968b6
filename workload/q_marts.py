"""Queries over the marts and the report measures."""
from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import functions as F

from ledgerlake.plans import marts, reports, scope
from ledgerlake.plans.dimensions import SCORE_BANDS
from ledgerlake.plans.model import Context, Filter, evaluate, one_of
from .adapters import LAST_ACTUAL
from .registry import query, r, res, rs
from .sql import LAST

YEAR, MONTH = reports.YEAR, reports.MONTH
Y = {"year_no": "Year"}


def div(a, b):
    return f"({a})::DOUBLE / nullif(({b})::DOUBLE, 0)"


def by_year(x, ctx=Context(), **columns):
    """Measures by year under short names."""
    return res(evaluate(x.model, ctx, [YEAR], list(columns.values())), **Y, **columns)


# ---------------------------------------------------------------- marts

_PNL_SQL = ["avg_balance", "eom_balance", "interest_income", "interest_expense", "ftp_credit", "ftp_charge", "fee_income",
            "new_lending", "write_off", "guarantee", "ecl", "s1", "s2", "s3", "a30", "a90", "holiday", "climit", "rate_x_balance"]
_PNL_SPARK = ["AvgBalance", "EOMBalance", "InterestIncome", "InterestExpense", "FTPCredit", "FTPCharge", "FeeIncome",
              "NewLending", "WriteOff", "GuaranteeClaim", "ECL", "Stage1Balance", "Stage2Balance", "Stage3Balance",
              "Arrears30Balance", "Arrears90Balance", "PaymentHolidayBalance", "CreditLimit", "RateXBalance"]


@query("mart_product_pnl", f"""
SELECT date_key, region_key, CAST(right(product_id, 2) AS INTEGER) AS product_key, brand, sub_segment, accounts, {rs(*_PNL_SQL)} FROM pnl""")
def mart_product_pnl(x):
    return res(x.model.tables["fact_product_monthly"], date_key="DateKey", region_key="RegionKey", product_key="ProductKey",
               brand="Brand", sub_segment="SubSegment", accounts="Accounts", **dict(zip(_PNL_SQL, _PNL_SPARK)))


@query("mart_credit_risk", f"""
SELECT date_key, region_key, CAST(right(product_id, 2) AS INTEGER) AS product_key, score_band, ltv_band, CAST(stage AS INTEGER) AS stage,
  arrears_bucket, accounts, {rs('balance', 'ead', 'ecl', 'net_write_off', 'pd_x_ead')} FROM risk""")
def mart_credit_risk(x):
    return res(x.model.tables["fact_credit_risk_monthly"], date_key="DateKey", region_key="RegionKey", product_key="ProductKey",
               score_band="CreditScoreBand", ltv_band="LTVBand", stage="IFRS9Stage", arrears_bucket="ArrearsBucket",
               accounts="Accounts", balance="Balance", ead="EAD", ecl="ECL", net_write_off="NetWriteOff", pd_x_ead="PDxEAD")


@query("mart_maturity_wall", f"""
SELECT deal_end_quarter, deal_end_key, region_key, rate_type, rate_band, accounts, {rs('balance', 'rate_x_balance', 'monthly_payment')} FROM wall""")
def mart_maturity_wall(x):
    return res(marts.mortgage_maturity(x.loans, x.dim_product, LAST_ACTUAL), deal_end_quarter="DealEndQuarter",
               deal_end_key="DealEndMonthKey", region_key="RegionKey", rate_type="RateType", rate_band="CurrentRateBand",
               accounts="Accounts", balance="Balance", rate_x_balance="RateXBalance", monthly_payment="MonthlyPayment")


_REP = ["balance", "old_rate_x_balance", "new_rate_x_balance", "old_payment", "new_payment"]


@query("mart_repricing_shock", f"SELECT date_key, region_key, new_rate_type, repricings, {rs(*_REP)} FROM repricing")
def mart_repricing_shock(x):
    return res(x.model.tables["fact_mortgage_repricing"], date_key="DateKey", region_key="RegionKey", new_rate_type="NewRateType",
               repricings="Repricings", balance="Balance", old_rate_x_balance="OldRateXBalance",
               new_rate_x_balance="NewRateXBalance", old_payment="OldPayment", new_payment="NewPayment")


@query("mart_vintage_curve", f"""
SELECT vintage_quarter, months_on_book, loans, {rs('original_amount')}, defaulted_loans, {rs('defaulted_amount')} FROM vintage""")
def mart_vintage_curve(x):
    return res(x.model.tables["fact_bbl_vintage"], vintage_quarter="VintageQuarter", months_on_book="MonthsOnBook", loans="Loans",
               original_amount="OriginalAmount", defaulted_loans="DefaultedLoans", defaulted_amount="DefaultedAmount")


@query("mart_customer_monthly", """
SELECT date_key, region_key, segment, sub_segment, brand, age, active, new AS joined, churned, registered, mau, app_sessions,
  web_logins, features FROM custm""")
def mart_customer_monthly(x):
    return res(x.model.tables["fact_customer_monthly"], date_key="DateKey", region_key="RegionKey", segment="Segment",
               sub_segment="SubSegment", brand="Brand", age="AgeBand", active="ActiveCustomers", joined="NewCustomers",
               churned="ChurnedCustomers", registered="DigitalRegistered", mau="MonthlyActiveUsers", app_sessions="AppSessions",
               web_logins="WebLogins", features="FeaturesUsed")


@query("mart_txn_monthly", f"""
SELECT CAST(year(month_end) * 10000 + month(month_end) * 100 + day(month_end) AS INTEGER) AS date_key, region_key,
  CAST(right(product_id, 2) AS INTEGER) AS product_key, CAST(right(channel_code, 2) AS INTEGER) AS channel_key, txn_type, txn_count,
  {rs('txn_value')} FROM txn_month""")
def mart_txn_monthly(x):
    return res(x.model.tables["fact_transactions_monthly"], date_key="DateKey", region_key="RegionKey", product_key="ProductKey",
               channel_key="ChannelKey", txn_type="TxnType", txn_count="TxnCount", txn_value="TxnValue")


# ---------------------------------------------------------------- helpers, income, cost

_PERIOD_LABEL = "concat('Jan ', y, ' to ', CASE WHEN y = 2001 THEN 'Jul ' ELSE 'Dec ' END, y)"


@query("period_helpers", f"""
SELECT y AS year_no, DATE '2001-07-31' AS last_actual, pe AS period_end, CAST(n_months AS BIGINT) AS months_in_period, '31 Jul 2001' AS data_as_of,
  {_PERIOD_LABEL} AS period_label, 'All UK regions' AS region_title, (SELECT count(*) FROM orders WHERE year(o_orderdate) = y) AS orders_n FROM years""")
def period_helpers(x):
    d = evaluate(x.model, Context(), [YEAR], ["Last Actual Date", "Period End Date", "Months In Period", "Data As Of",
                                              "Selected Period Label", "Selected Region Title"])
    n = x.t("orders").groupBy(F.year("o_orderdate").alias("Year")).agg(F.count(F.lit(1)).alias("orders_n"))
    return res(d.join(n, "Year"), year_no="Year", last_actual="Last Actual Date", period_end="Period End Date",
               months_in_period="Months In Period", data_as_of="Data As Of", period_label="Selected Period Label",
               region_title="Selected Region Title", orders_n="orders_n")


@query("nii_by_month_vs_budget", f"""
SELECT strftime(m.month_end, '%Y-%m') AS year_month, {r('nii', 'nii')}, {r('b', 'nii_budget')}
FROM pm m LEFT JOIN (SELECT month_end, sum(b_nii) AS b FROM budget WHERE month_end <= {LAST} GROUP BY 1) b USING (month_end)""")
def nii_by_month_vs_budget(x):
    return res(reports.nii_by_month(x.model), year_month="YearMonth", nii="NII", nii_budget="NII Budget")


_CHG = "({0} - coalesce({1}, 0))::DOUBLE / nullif({1}::DOUBLE, 0)"


@query("income_kpis", f"""
SELECT yf.y AS year_no, {r('yf.ii', 'interest_income')}, {r('yf.ie', 'interest_expense')}, {r('yf.fc', 'ftp_credit')}, {r('yf.fch', 'ftp_charge')},
  {r('yf.nii', 'nii')}, {r('yp.nii', 'nii_py')}, {r(_CHG.format('yf.nii', 'yp.nii'), 'nii_yoy')}, {r('b_nii', 'nii_budget')},
  {r('b_nii_full', 'nii_budget_full')}, {r('yf.nii - b_nii', 'nii_vs_budget')}, {r(_CHG.format('yf.nii', 'b_nii'), 'nii_vs_budget_pct')},
  {r('yf.fees', 'fees')}, {r('yp.fees', 'fees_py')}, {r(_CHG.format('yf.fees', 'yp.fees'), 'fees_yoy')}, {r('b_fees', 'fees_budget')},
  {r('yf.nii + yf.fees', 'total_income')}, {r('yp.nii + yp.fees', 'total_income_py')}
FROM yf LEFT JOIN yp ON yp.y = yf.y LEFT JOIN bud_y ON bud_y.y = yf.y""")
def income_kpis(x):
    return by_year(x, interest_income="Interest Income", interest_expense="Interest Expense", ftp_credit="FTP Credit",
                   ftp_charge="FTP Charge", nii="NII", nii_py="NII PY", nii_yoy="NII YoY %", nii_budget="NII Budget",
                   nii_budget_full="NII Budget Full Year", nii_vs_budget="NII vs Budget", nii_vs_budget_pct="NII vs Budget %",
                   fees="Fee Income", fees_py="Fee Income PY", fees_yoy="Fee Income YoY %", fees_budget="Fee Income Budget",
                   total_income="Total Income", total_income_py="Total Income PY")


_CI, _CIP = div("oy.cost", "yf.nii + yf.fees"), div("op.cost", "yp.nii + yp.fees")


@query("cost_income", f"""
SELECT yf.y AS year_no, {r('oy.cost', 'costs')}, {r('op.cost', 'costs_py')}, {r('oy.b_cost', 'costs_budget')}, {r(_CI, 'cost_income')},
  {r(_CIP, 'cost_income_py')}, {r(f'({_CI} - coalesce({_CIP}, 0)) * 100', 'change_pp')}
FROM yf JOIN opex_y oy ON oy.y = yf.y LEFT JOIN yp ON yp.y = yf.y LEFT JOIN opex_p op ON op.y = yf.y""")
def cost_income(x):
    return by_year(x, costs="Operating Costs", costs_py="Operating Costs PY", costs_budget="Operating Costs Budget",
                   cost_income="Cost Income Ratio", cost_income_py="Cost Income Ratio PY", change_pp="Cost Income Ratio Change pp")


# ---------------------------------------------------------------- balance sheet


@query("balance_sheet_kpis", f"""
SELECT ye.y AS year_no, {r('ye.dep', 'deposits')}, {r('yep.dep', 'deposits_py')}, {r(_CHG.format('ye.dep', 'yep.dep'), 'deposits_yoy')},
  {r('ye.cur', 'current_accounts')}, {r('ye.sav', 'savings')}, {r('ye.fts', 'fixed_term')}, {r(div('ye.fts', 'ye.dep'), 'fixed_term_share')},
  {r('ye.loan_eom', 'loan_book')}, {r('yep.loan_eom', 'loan_book_py')}, {r(_CHG.format('ye.loan_eom', 'yep.loan_eom'), 'loan_book_yoy')},
  {r('ye.ecl', 'ecl_stock')}, {r('ye.loan_eom - ye.ecl', 'net_loans')}, {r('yep.loan_eom - yep.ecl', 'net_loans_py')},
  {r(_CHG.format('(ye.loan_eom - ye.ecl)', '(yep.loan_eom - yep.ecl)'), 'net_loans_yoy')}, {r(div('ye.loan_eom', 'ye.dep'), 'loan_to_deposit')},
  {r('yf.loan_mean', 'avg_loan_balance')}
FROM ye LEFT JOIN yep ON yep.y = ye.y LEFT JOIN yf ON yf.y = ye.y""")
def balance_sheet_kpis(x):
    return by_year(x, deposits="Customer Deposits", deposits_py="Customer Deposits PY", deposits_yoy="Customer Deposits YoY %",
                   current_accounts="Current Account Balances", savings="Savings Balances", fixed_term="Fixed Term Savings",
                   fixed_term_share="Fixed Term Share of Deposits", loan_book="Loan Book", loan_book_py="Loan Book PY",
                   loan_book_yoy="Loan Book YoY %", ecl_stock="ECL Stock", net_loans="Net Loans", net_loans_py="Net Loans PY",
                   net_loans_yoy="Net Loans YoY %", loan_to_deposit="Loan to Deposit Ratio", avg_loan_balance="Avg Loan Balance")


@query("deposit_mix_share", f"""
SELECT y AS year_no, CASE product_id WHEN 'P01' THEN 'STANDARD' WHEN 'P02' THEN 'SMALL' ELSE 'MEDIUM' END AS product, {r('b', 'deposits')},
  {r('b::DOUBLE / sum(b) OVER (PARTITION BY y)::DOUBLE', 'share')}
FROM (SELECT years.y, product_id, sum(eom_balance) AS b FROM years JOIN pnl ON month_end = pe WHERE product_id IN ('P01','P02','P03') GROUP BY ALL) s""")
def deposit_mix_share(x):
    return res(reports.deposit_mix(x.model), year_no="Year", product="ProductName", deposits="Customer Deposits", share="share")


@query("nim_vs_rate", f"""
SELECT CAST(date_trunc('month', m.month_end) AS DATE) AS month_start, {r(div('nii::DOUBLE * 12', 'loan_eom'), 'nim')}, {r('b.rt / 100', 'bank_rate')}
FROM pm m LEFT JOIN (SELECT last_day(d) AS month_end, avg(rate::DOUBLE) AS rt FROM rate GROUP BY 1) b USING (month_end) WHERE m.month_end <= {LAST}""")
def nim_vs_rate(x):
    return res(reports.nim_against_rate(x.model), month_start="MonthStart", nim="NIM", bank_rate="Bank Rate")


_NIM, _NIMP = div("yf.nii::DOUBLE * 12 / years.n_months", "yf.loan_mean"), div("yp.nii::DOUBLE * 12 / yp.n_months", "yp.loan_mean")


@query("margin_kpis", f"""
SELECT years.y AS year_no, {r(_NIM, 'nim')}, {r(_NIMP, 'nim_py')}, {r(f'({_NIM} - coalesce({_NIMP}, 0)) * 10000', 'nim_change_bps')},
  {r('(SELECT avg(rate::DOUBLE) FROM rate WHERE year(d) = years.y) / 100', 'bank_rate')},
  {r('(SELECT max(rate)::DOUBLE FROM rate WHERE d = pe) / 100', 'bank_rate_end')}, {r(div('yf.dep_rxb', 'yf.dep_avg') + ' / 100', 'rate_deposits')},
  {r(div('yf.loan_rxb', 'yf.loan_eom') + ' / 100', 'rate_loans')},
  {r(div(div('yf.dep_rxb', 'yf.dep_avg') + ' / 100', '(SELECT avg(rate::DOUBLE) FROM rate WHERE year(d) = years.y) / 100'), 'deposit_beta')}
FROM years JOIN yf ON yf.y = years.y LEFT JOIN yp ON yp.y = years.y""")
def margin_kpis(x):
    return by_year(x, nim="NIM", nim_py="NIM PY", nim_change_bps="NIM Change bps", bank_rate="Bank Rate",
                   bank_rate_end="Bank Rate Period End", rate_deposits="Customer Rate Deposits", rate_loans="Customer Rate Loans",
                   deposit_beta="Deposit Beta")


# ---------------------------------------------------------------- bridge

_BRIDGE = """
(SELECT y, sum((bm - bpy)::DOUBLE * (npy::DOUBLE / nullif(bpy::DOUBLE, 0))) AS vol,
   sum((nii::DOUBLE / nullif(bm::DOUBLE, 0) - coalesce(npy::DOUBLE / nullif(bpy::DOUBLE, 0), 0)) * bm::DOUBLE) AS mar, sum(nii) AS nii, sum(npy) AS npy,
   sum(bm) AS bm, sum(bpy) AS bpy
 FROM (SELECT years.y, product_id,
    sum(interest_income - ftp_charge + ftp_credit - interest_expense) FILTER (year(month_end) = years.y) AS nii,
    sum(interest_income - ftp_charge + ftp_credit - interest_expense) FILTER (month_end BETWEEN make_date(CAST(years.y - 1 AS INTEGER), 1, 1)
       AND last_day(CAST(pe - INTERVAL 1 YEAR AS DATE))) AS npy,
    sum(avg_balance) FILTER (year(month_end) = years.y) AS bm,
    sum(avg_balance) FILTER (month_end BETWEEN make_date(CAST(years.y - 1 AS INTEGER), 1, 1) AND last_day(CAST(pe - INTERVAL 1 YEAR AS DATE))) AS bpy
  FROM years JOIN pnl ON year(month_end) BETWEEN years.y - 1 AND years.y GROUP BY ALL) p GROUP BY y)"""


@query("nii_bridge", f"""
SELECT step_order, step, {r('value', 'value')} FROM (
  SELECT 1 AS step_order, 'Prior year NII' AS step, npy::DOUBLE AS value FROM {_BRIDGE} b WHERE y = 2000
  UNION ALL SELECT 2, 'Volume', vol FROM {_BRIDGE} b WHERE y = 2000 UNION ALL SELECT 3, 'Margin', mar FROM {_BRIDGE} b WHERE y = 2000) s""")
def nii_bridge(x):
    return res(reports.nii_bridge(x.model, Context((one_of("dim_date", "Year", 2000),))))


@query("bridge_by_year", f"""
SELECT y AS year_no, {r('bm', 'balance_months')}, {r('bpy', 'balance_months_py')}, {r('vol', 'volume')}, {r('mar', 'margin')},
  {r('nii::DOUBLE - coalesce(npy::DOUBLE, 0) - coalesce(vol, 0) - mar', 'other')}, {r('least(nii, coalesce(npy, 0))::DOUBLE * 0.9', 'axis_min')}
FROM {_BRIDGE} b""")
def bridge_by_year(x):
    return by_year(x, balance_months="Balance Months", balance_months_py="Balance Months PY", volume="Bridge Volume Effect",
                   margin="Bridge Margin Effect", other="Bridge Other", axis_min="Bridge Axis Min")


@query("bridge_steps", f"""
SELECT step_order, step, {r('value', 'value')} FROM (
  SELECT 1 AS step_order, 'Prior year NII' AS step, npy::DOUBLE AS value FROM {_BRIDGE} b WHERE y = 1999
  UNION ALL SELECT 2, 'Volume', vol FROM {_BRIDGE} b WHERE y = 1999 UNION ALL SELECT 3, 'Margin', mar FROM {_BRIDGE} b WHERE y = 1999
  UNION ALL SELECT 4, 'Other', nii::DOUBLE - npy::DOUBLE - vol - mar FROM {_BRIDGE} b WHERE y = 1999) s""")
def bridge_steps(x):
    """The switch measure on its step axis."""
    d = evaluate(x.model, Context((one_of("dim_date", "Year", 1999),)), ["bridge_steps.Order", "bridge_steps.Step"], ["NII Bridge Value"])
    return res(d, step_order="Order", step="Step", value="NII Bridge Value")


@query("budget_delivery_by_region", f"""
SELECT region_name, {r('nii', 'nii')}, {r('b', 'budget')}, {r('nii - b', 'variance')}, {r(div('nii - b', 'b'), 'variance_pct')},
  CASE WHEN (nii - b)::DOUBLE / nullif(b::DOUBLE, 0) IS NULL THEN 'neutral' WHEN nii - b >= 0 THEN 'good' ELSE 'bad' END AS status
FROM regions_named JOIN (SELECT region_key, sum(interest_income - ftp_charge + ftp_credit - interest_expense) AS nii FROM pnl GROUP BY 1) p USING (region_key)
LEFT JOIN (SELECT region_key, sum(b_nii) AS b FROM budget WHERE month_end <= {LAST} GROUP BY 1) bb USING (region_key)""")
def budget_delivery_by_region(x):
    return res(reports.budget_delivery(x.model), region_name="RegionName", nii="NII", budget="NII Budget", variance="NII vs Budget",
               variance_pct="NII vs Budget %", status="Budget Variance Colour")


# ---------------------------------------------------------------- credit risk


@query("new_lending", f"""
SELECT yf.y AS year_no, {r('yf.new_lending', 'new_lending')}, {r('yp.new_lending', 'new_lending_py')},
  {r(_CHG.format('yf.new_lending', 'yp.new_lending'), 'yoy')} FROM yf LEFT JOIN yp ON yp.y = yf.y""")
def new_lending(x):
    return by_year(x, new_lending="Gross New Lending", new_lending_py="Gross New Lending PY", yoy="Gross New Lending YoY %")


@query("stage_share_trend", f"""
SELECT strftime(month_end, '%Y-%m') AS year_month, {r(div('s2', 'loan_eom'), 'stage2_share')}, {r(div('s3', 'loan_eom'), 'stage3_share')},
  {r('s2', 'stage2_balance')}, {r('s3', 'stage3_balance')} FROM pm WHERE month_end <= {LAST}
UNION ALL SELECT '2001-08', {r(div('s2', 'loan_eom'), 'a')}, {r(div('s3', 'loan_eom'), 'b')}, {r('s2', 'c')}, {r('s3', 'd')} FROM pm WHERE month_end = {LAST}""")
def stage_share_trend(x):
    """The month after the last actual one repeats its balances; months without new lending are hidden."""
    return res(reports.stage_trend(x.model), year_month="YearMonth", stage2_share="Stage 2 Share", stage3_share="Stage 3 Share",
               stage2_balance="Stage 2 Balance", stage3_balance="Stage 3 Balance")


@query("arrears_by_product", f"""
SELECT strftime(month_end, '%Y-%m') AS year_month, CASE product_id WHEN 'P04' THEN 'ECONOMY' WHEN 'P05' THEN 'LARGE' ELSE 'PROMO' END AS product,
  {r(div('sum(a90)', 'sum(eom_balance)'), 'arrears90_rate')} FROM pnl
WHERE product_id IN ('P04','P05','P09') AND month_end BETWEEN DATE '1996-08-31' AND {LAST} GROUP BY ALL""")
def arrears_by_product(x):
    return res(reports.arrears_by_product(x.model, date(1996, 8, 1), date(2001, 7, 1)), year_month="YearMonth", product="ProductName",
               arrears90_rate="Arrears 90+ Rate")


@query("ltv_score_heatmap", "SELECT ltv_band, " + ", ".join(
    r(f"(sum(balance) FILTER (score_band = '{b}' AND arrears_bucket = '90+'))::DOUBLE / nullif((sum(balance) FILTER (score_band = '{b}'))::DOUBLE, 0)",
      b.lower().replace(" ", "_")) for b, _ in SCORE_BANDS) + f" FROM risk WHERE month_end = {LAST} AND ltv_band <> 'n/a' GROUP BY 1 HAVING count(*) FILTER (arrears_bucket = '90+') > 0")
def ltv_score_heatmap(x):
    bands = [b for b, _ in SCORE_BANDS]
    return res(reports.risk_heatmap(x.model, bands), ltv_band="LTVBand", **{b.lower().replace(" ", "_"): b for b in bands})


@query("risk_by_score", f"""
SELECT score_band, {r('sum(balance)', 'balance')}, {r("sum(balance) FILTER (arrears_bucket = '90+')", 'balance90')},
  {r(div("sum(balance) FILTER (arrears_bucket = '90+')", 'sum(balance)'), 'rate90')}, {r('sum(ecl)', 'ecl')}, {r(div('sum(ecl)', 'sum(balance)'), 'coverage')},
  {r('sum(ead)', 'ead')}, {r('sum(pd_x_ead)', 'pd_x_ead')}, {r(div('sum(pd_x_ead)', 'sum(ead)'), 'avg_pd')}
FROM risk WHERE month_end = {LAST} GROUP BY 1""")
def risk_by_score(x):
    d = evaluate(x.model, Context(), ["dim_score_band.CreditScoreBand"],
                 ["Risk Balance", "Risk 90+ Balance", "Risk 90+ Rate", "Risk ECL", "Risk ECL Coverage", "Risk EAD", "Risk PD x EAD", "Risk Avg PD"])
    return res(d, score_band="CreditScoreBand", balance="Risk Balance", balance90="Risk 90+ Balance", rate90="Risk 90+ Rate",
               ecl="Risk ECL", coverage="Risk ECL Coverage", ead="Risk EAD", pd_x_ead="Risk PD x EAD", avg_pd="Risk Avg PD")


@query("stage_and_arrears_kpis", f"""
SELECT ye.y AS year_no, {r('ye.s1', 'stage1')}, {r(div('ye.s1', 'ye.loan_eom'), 'stage1_share')}, {r(div('ye.s2', 'ye.loan_eom'), 'stage2_share')},
  {r(div('yep.s2', 'yep.loan_eom'), 'stage2_share_py')},
  {r('(' + div('ye.s2', 'ye.loan_eom') + ' - coalesce(' + div('yep.s2', 'yep.loan_eom') + ', 0)) * 100', 'stage2_change_pp')},
  {r('ye.a90', 'arrears90')}, {r(div('ye.a90', 'ye.loan_eom'), 'arrears90_rate')}, {r(div('yep.a90', 'yep.loan_eom'), 'arrears90_rate_py')},
  {r('(' + div('ye.a90', 'ye.loan_eom') + ' - coalesce(' + div('yep.a90', 'yep.loan_eom') + ', 0)) * 10000', 'arrears90_change_bps')},
  {r('ye.a30', 'arrears30')}, {r(div('ye.a30', 'ye.loan_eom'), 'arrears30_rate')}, {r(div('ye.ecl', 'ye.loan_eom'), 'coverage')},
  {r(div('yep.ecl', 'yep.loan_eom'), 'coverage_py')},
  {r('(' + div('ye.ecl', 'ye.loan_eom') + ' - coalesce(' + div('yep.ecl', 'yep.loan_eom') + ', 0)) * 10000', 'coverage_change_bps')}
FROM ye LEFT JOIN yep ON yep.y = ye.y""")
def stage_and_arrears_kpis(x):
    return by_year(x, stage1="Stage 1 Balance", stage1_share="Stage 1 Share", stage2_share="Stage 2 Share", stage2_share_py="Stage 2 Share PY",
                   stage2_change_pp="Stage 2 Share Change pp", arrears90="Arrears 90+ Balance", arrears90_rate="Arrears 90+ Rate",
                   arrears90_rate_py="Arrears 90+ Rate PY", arrears90_change_bps="Arrears 90+ Change bps", arrears30="Arrears 30+ Balance",
                   arrears30_rate="Arrears 30+ Rate", coverage="ECL Coverage", coverage_py="ECL Coverage PY",
                   coverage_change_bps="ECL Coverage Change bps")


@query("ecl_movement", f"""
SELECT yf.y AS year_no, {r('yo.ecl', 'ecl_opening')}, {r('ye.ecl', 'ecl_stock')}, {r('yf.wo - yf.ga', 'net_write_offs')},
  {r('ye.ecl - coalesce(yo.ecl, 0) + yf.wo - yf.ga', 'impairment')}, {r('b_imp', 'impairment_budget')}
FROM yf JOIN ye ON ye.y = yf.y LEFT JOIN yo ON yo.y = yf.y LEFT JOIN bud_y ON bud_y.y = yf.y""")
def ecl_movement(x):
    return by_year(x, ecl_opening="ECL Opening", ecl_stock="ECL Stock", net_write_offs="Net Write-offs", impairment="Impairment Charge",
                   impairment_budget="Impairment Budget")


# prior-year cost of risk re-evaluates stock, opening and write-offs inside the shifted window
_COR = div("(ye.ecl - coalesce(yo.ecl, 0) + yf.wo - yf.ga)::DOUBLE * 12 / years.n_months", "yf.loan_mean")
_CORP = div("(yep.ecl - coalesce(yop.ecl, 0) + yp.wo - yp.ga)::DOUBLE * 12 / yp.n_months", "yp.loan_mean")


@query("cost_of_risk", f"""
SELECT years.y AS year_no, {r(_COR, 'cost_of_risk')}, {r(_CORP, 'cost_of_risk_py')}, {r(f'({_COR} - coalesce({_CORP}, 0)) * 10000', 'change_bps')}
FROM years JOIN yf ON yf.y = years.y JOIN ye ON ye.y = years.y LEFT JOIN yo ON yo.y = years.y LEFT JOIN yp ON yp.y = years.y
LEFT JOIN yep ON yep.y = years.y LEFT JOIN yo yop ON yop.y = years.y - 1""")
def cost_of_risk(x):
    return by_year(x, cost_of_risk="Cost of Risk", cost_of_risk_py="Cost of Risk PY", change_bps="Cost of Risk Change bps")


@query("holiday_balance", f"SELECT strftime(month_end, '%Y-%m') AS year_month, {rs('holiday')} FROM pm")
def holiday_balance(x):
    return res(evaluate(x.model, Context(), [MONTH], ["Payment Holiday Balance"]), year_month="YearMonth", holiday="Payment Holiday Balance")


@query("maturity_wall_report", f"""
SELECT deal_end_quarter, rate_band, {r('sum(balance)', 'balance')}, {r(div('sum(rate_x_balance)', 'sum(balance)') + ' / 100', 'avg_rate')},
  {r('(SELECT sum(new_payment)::DOUBLE / sum(old_payment)::DOUBLE - 1 FROM repricing)', 'payment_shock')}, sum(accounts)::BIGINT AS accounts,
  {r(f'sum(balance) FILTER (deal_end_date > {LAST} AND deal_end_date <= last_day(CAST({LAST} + INTERVAL 12 MONTH AS DATE)))', 'next_12m')}
FROM wall GROUP BY 1, 2""")
def maturity_wall_report(x):
    """Payment shock comes from another table without these columns, so every row repeats its total."""
    axis = ["fact_mortgage_maturity.DealEndQuarter", "fact_mortgage_maturity.CurrentRateBand"]
    d = evaluate(x.model, Context(), axis, ["Maturing Fixed Balance", "Maturing Avg Current Rate", "Payment Shock %",
                                            "Maturing Fixed Accounts", "Maturing Next 12M Balance"])
    return res(d.filter(reports.not_blank("Maturing Fixed Balance")), deal_end_quarter="DealEndQuarter", rate_band="CurrentRateBand",
               balance="Maturing Fixed Balance", avg_rate="Maturing Avg Current Rate", payment_shock="Payment Shock %",
               accounts="Maturing Fixed Accounts", next_12m="Maturing Next 12M Balance")


@query("repricing_kpis", f"""
SELECT years.y AS year_no, sum(repricings)::BIGINT AS repricings, {r(div('sum(old_rate_x_balance)', 'sum(balance)') + ' / 100', 'old_rate')},
  {r(div('sum(new_rate_x_balance)', 'sum(balance)') + ' / 100', 'new_rate')},
  {r('coalesce(' + div('sum(new_payment)', 'sum(old_payment)') + ', 0) - 1', 'payment_shock')}
FROM years JOIN repricing ON year(month_end) = years.y GROUP BY 1""")
def repricing_kpis(x):
    return by_year(x, repricings="Repricings", old_rate="Repricing Old Rate", new_rate="Repricing New Rate", payment_shock="Payment Shock %")


@query("vintage_curve", f"""
SELECT months_on_book, vintage_quarter, {r(div('sum(defaulted_loans)', 'sum(loans)'), 'default_rate')},
  sum(loans) FILTER (months_on_book = 0)::BIGINT AS loans_at_start FROM vintage WHERE months_on_book <= 66 GROUP BY 1, 2""")
def vintage_curve(x):
    ctx = Context((Filter("fact_bbl_vintage", "MonthsOnBook", lambda c: c <= 66),))
    curve = reports.vintage_curve(x.model)
    starts = evaluate(x.model, ctx, ["fact_bbl_vintage.VintageQuarter"], ["BBL Loans"])
    d = curve.join(starts, "VintageQuarter", "left").withColumn("at_start", F.when(F.col("MonthsOnBook") == 0, F.col("BBL Loans")))
    return res(d, months_on_book="MonthsOnBook", vintage_quarter="VintageQuarter", default_rate="BBL Cumulative Default Rate",
               loans_at_start="at_start")


# ---------------------------------------------------------------- customers, branches, transactions

_CU = """(SELECT years.y, sum(new)::BIGINT AS joined, sum(churned)::BIGINT AS churned, sum(app_sessions)::BIGINT AS sessions, sum(mau)::BIGINT AS user_months,
   sum(active) FILTER (month_end = pe)::BIGINT AS active, sum(registered) FILTER (month_end = pe)::BIGINT AS registered,
   sum(mau) FILTER (month_end = pe)::BIGINT AS mau, any_value(n_months) AS n_months FROM years JOIN custm ON year(month_end) = years.y GROUP BY 1)"""
_CUP = """(SELECT years.y, sum(active)::BIGINT AS active, sum(mau)::BIGINT AS mau FROM years JOIN custm ON month_end = last_day(CAST(pe - INTERVAL 1 YEAR AS DATE)) GROUP BY 1)"""


@query("customer_kpis", f"""
SELECT c.y AS year_no, c.active, p.active AS active_py, {r(_CHG.format('c.active', 'p.active'), 'active_yoy')}, joined, churned,
  {r(div('churned::DOUBLE * 12 / n_months', 'c.active'), 'churn_rate')}, registered, c.mau, p.mau AS mau_py,
  {r(_CHG.format('c.mau', 'p.mau'), 'mau_yoy')}, {r(div('c.mau', 'c.active'), 'digital_share')}, {r(div('p.mau', 'p.active'), 'digital_share_py')},
  {r('(' + div('c.mau', 'c.active') + ' - coalesce(' + div('p.mau', 'p.active') + ', 0)) * 100', 'digital_change_pp')},
  {r(div('sessions', 'user_months'), 'sessions_per_user')}
FROM {_CU} c LEFT JOIN {_CUP} p ON p.y = c.y""")
def customer_kpis(x):
    return by_year(x, active="Active Customers", active_py="Active Customers PY", active_yoy="Active Customers YoY %",
                   joined="New Customers", churned="Churned Customers", churn_rate="Annualised Churn Rate", registered="Digital Registered",
                   mau="App Monthly Users", mau_py="App Monthly Users PY", mau_yoy="App Monthly Users YoY %",
                   digital_share="Digital Active Share", digital_share_py="Digital Active Share PY",
                   digital_change_pp="Digital Active Share Change pp", sessions_per_user="App Sessions per User")


@query("digital_share_by_region", f"""
SELECT region_name, {r(div('sum(mau)', 'sum(active)'), 'share')}, {r('(SELECT sum(mau)::DOUBLE / sum(active)::DOUBLE FROM custm WHERE month_end = DATE ' + "'2000-12-31')", 'share_all')}
FROM custm JOIN regions_named USING (region_key) WHERE month_end = DATE '2000-12-31' GROUP BY 1""")
def digital_share_by_region(x):
    """Region against the whole: the benchmark ignores the region axis."""
    d = evaluate(x.model, Context((one_of("dim_date", "Year", 2000),)), ["dim_region.RegionName"], ["Digital Active Share", "Digital Active Share UK"])
    return res(d, region_name="RegionName", share="Digital Active Share", share_all="Digital Active Share UK")


_BR = """(SELECT years.y, nullif(count(*) FILTER (month_end = pe AND NOT is_closure), 0) AS open_n, nullif(count(*) FILTER (year(month_end) = years.y AND is_closure), 0) AS closed_n,
  sum(footfall) FILTER (year(month_end) = years.y)::BIGINT AS footfall,
  nullif(count(*) FILTER (month_end = last_day(CAST(pe - INTERVAL 1 YEAR AS DATE)) AND NOT is_closure), 0) AS open_py
  FROM years JOIN branch_month ON year(month_end) BETWEEN years.y - 1 AND years.y GROUP BY 1)"""


@query("branch_kpis", f"""
SELECT y AS year_no, open_n AS open_branches, open_py AS open_branches_py,
  CASE WHEN coalesce(open_n, open_py) IS NOT NULL THEN coalesce(open_n, 0) - coalesce(open_py, 0) END AS change_n, closed_n AS closures, footfall FROM {_BR} b
WHERE coalesce(open_n, open_py, closed_n, footfall) IS NOT NULL""")
def branch_kpis(x):
    return by_year(x, open_branches="Open Branches", open_branches_py="Open Branches PY", change_n="Open Branches Change",
                   closures="Branch Closures", footfall="Branch Footfall")


@query("index_base100", f"""
SELECT strftime(m.month_end, '%Y-%m') AS year_month,
  {r("nullif((SELECT count(*) FROM branch_month b WHERE b.month_end = least(m.month_end, DATE '2001-07-31') AND NOT is_closure), 0)::DOUBLE / (SELECT count(*) FROM branch_month WHERE month_end = DATE '1999-01-31') * 100", 'branch_index')},
  {r("(SELECT sum(mau) FROM custm b WHERE b.month_end = least(m.month_end, DATE '2001-07-31'))::DOUBLE / (SELECT sum(mau) FROM custm WHERE month_end = DATE '1999-01-31')::DOUBLE * 100", 'app_index')}
FROM pm m""")
def index_base100(x):
    d = evaluate(x.model, Context(), [MONTH], ["Open Branches Index", "App Monthly Users Index", "Gross New Lending"])
    d = d.filter(reports.not_blank("Gross New Lending"))
    return res(d, year_month="YearMonth", branch_index="Open Branches Index", app_index="App Monthly Users Index")


@query("geo_spread", f"""
SELECT {r('round(n_nationkey * 1.5 + 40 + ((n_nationkey + 1) % 7 - 3) * 0.035::DOUBLE, 6)', 'lat')},
  {r('round(n_nationkey * 0.5 - 6 + (((n_nationkey + 1) // 7) % 7 - 3) * 0.055::DOUBLE, 6)', 'lon')},
  CASE WHEN n_nationkey >= 20 THEN 'Closed' ELSE 'Open' END AS status, n_name AS branch, n_name AS city,
  CASE WHEN n_nationkey >= 20 THEN DATE '2001-03-31' WHEN n_nationkey >= 18 THEN DATE '2001-10-31' END AS closure_date FROM nation""")
def geo_spread(x):
    return res(reports.branch_points(x.dim_branch), lat="lat", lon="lon", status="BranchStatus", branch="BranchName", city="City",
               closure_date="ClosureDate")


@query("channel_mix_share", f"""
SELECT y AS year_no, channel_group, n::BIGINT AS txn_n, {r('n::DOUBLE / sum(n) OVER (PARTITION BY y)::DOUBLE', 'share')} FROM (
  SELECT CAST(year(month_end) AS BIGINT) AS y, channel_group, sum(txn_count) AS n FROM txn_month WHERE channel_group <> 'Automated' GROUP BY 1, 2) s""")
def channel_mix_share(x):
    return res(reports.channel_mix(x.model), year_no="Year", channel_group="ChannelGroup", txn_n="Transactions", share="share")


@query("transaction_kpis", f"""
SELECT region_name, sum(txn_count)::BIGINT AS txn_n, {r('sum(txn_value)', 'txn_value')},
  {r(div("sum(txn_count) FILTER (channel_group = 'Digital')", "sum(txn_count) FILTER (channel_group IN ('Digital','Branch and Phone'))"), 'digital_share')}
FROM txn_month JOIN regions_named USING (region_key) GROUP BY 1""")
def transaction_kpis(x):
    d = evaluate(x.model, Context(), ["dim_region.RegionName"], ["Transactions", "Transaction Value", "Digital Transaction Share"])
    return res(d, region_name="RegionName", txn_n="Transactions", txn_value="Transaction Value", digital_share="Digital Transaction Share")


# ---------------------------------------------------------------- conduct


@query("complaints_by_category", f"""
SELECT CASE category_code WHEN 'P01' THEN 'STANDARD' WHEN 'P02' THEN 'SMALL' WHEN 'P03' THEN 'MEDIUM' WHEN 'P04' THEN 'ECONOMY'
  WHEN 'P05' THEN 'LARGE' ELSE 'PROMO' END AS category, count(*) AS complaints,
  {r(div('count(*) FILTER (within8)', 'count(within8)'), 'within_8_weeks')}, {r(div('count(*) FILTER (upheld)', 'count(*)'), 'upheld')}
FROM complaint GROUP BY 1""")
def complaints_by_category(x):
    return res(reports.complaints_by_category(x.model), category="CategoryName", complaints="Complaints",
               within_8_weeks="Resolved Within 8 Weeks %", upheld="Upheld %")


_CO = """(SELECT years.y, count(*) FILTER (year(received) = years.y) AS n,
   nullif(count(*) FILTER (received BETWEEN make_date(CAST(years.y - 1 AS INTEGER), 1, 1) AND last_day(CAST(pe - INTERVAL 1 YEAR AS DATE))), 0) AS n_py,
   sum(redress) FILTER (year(received) = years.y) AS redress, count(*) FILTER (year(received) = years.y AND referred) AS referred,
   count(*) FILTER (year(received) = years.y AND is_open) AS open_n, any_value(n_months) AS n_months
  FROM years JOIN complaint ON year(received) BETWEEN years.y - 1 AND years.y GROUP BY 1)"""


@query("complaint_rates", f"""
SELECT c.y AS year_no, c.n AS complaints, c.n_py AS complaints_py, {r(div('c.n::DOUBLE / c.n_months', 'a.active::DOUBLE / 1000'), 'per_1000')},
  {r(div('c.n_py::DOUBLE / c.n_months', 'p.active::DOUBLE / 1000'), 'per_1000_py')},
  {r(div('c.n::DOUBLE / c.n_months', 'a.active::DOUBLE / 1000') + ' - coalesce(' + div('c.n_py::DOUBLE / c.n_months', 'p.active::DOUBLE / 1000') + ', 0)', 'change')},
  {r('redress', 'redress')}, {r(div('referred', 'c.n'), 'referral')}, nullif(open_n, 0) AS open_n
FROM {_CO} c LEFT JOIN {_CU} a ON a.y = c.y LEFT JOIN {_CUP} p ON p.y = c.y""")
def complaint_rates(x):
    return by_year(x, complaints="Complaints", complaints_py="Complaints PY", per_1000="Complaints per 1000 Customers",
                   per_1000_py="Complaints per 1000 PY", change="Complaints per 1000 Change", redress="Redress Paid",
                   referral="FOS Referral %", open_n="Open Complaints")


@query("complaints_by_resolution_month", f"""
SELECT strftime(make_date(resolved_key // 10000, (resolved_key // 100) % 100, 1), '%Y-%m') AS year_month, count(*) AS resolved_n FROM complaint
GROUP BY 1""")
def complaints_by_resolution_month(x):
    """The inactive relationship: complaints counted by the month they were resolved in; open ones under the blank month."""
    d = evaluate(x.model.using("fact_complaint", "ResolvedDateKey"), Context(), [MONTH], ["Complaints"])
    return res(d, year_month="YearMonth", resolved_n="Complaints")


_FR = """(SELECT years.y, count(*) FILTER (year(reported) = years.y) AS n, sum(loss) FILTER (year(reported) = years.y) AS loss,
  sum(loss) FILTER (year(reported) = years.y AND fraud_type = 'APP Scam') AS scam, sum(reimbursed) FILTER (year(reported) = years.y AND fraud_type = 'APP Scam') AS back,
  sum(reimbursed - recovered) FILTER (year(reported) = years.y) AS net,
  sum(loss) FILTER (fraud_type = 'APP Scam' AND reported BETWEEN make_date(CAST(years.y - 1 AS INTEGER), 1, 1) AND last_day(CAST(pe - INTERVAL 1 YEAR AS DATE))) AS scam_py,
  sum(reimbursed) FILTER (fraud_type = 'APP Scam' AND reported BETWEEN make_date(CAST(years.y - 1 AS INTEGER), 1, 1) AND last_day(CAST(pe - INTERVAL 1 YEAR AS DATE))) AS back_py
  FROM years JOIN fraud ON year(reported) BETWEEN years.y - 1 AND years.y GROUP BY 1)"""


@query("fraud_kpis", f"""
SELECT y AS year_no, n AS cases, {rs('loss')}, {r('scam', 'scam_loss')}, {r('back', 'scam_reimbursed')}, {r(div('back', 'scam'), 'rate')},
  {r(div('back_py', 'scam_py'), 'rate_py')}, {r('(' + div('back', 'scam') + ' - coalesce(' + div('back_py', 'scam_py') + ', 0)) * 100', 'change_pp')},
  {r('net', 'net_cost')} FROM {_FR} f""")
def fraud_kpis(x):
    return by_year(x, cases="Fraud Cases", loss="Fraud Losses", scam_loss="APP Scam Losses", scam_reimbursed="APP Scam Reimbursed",
                   rate="APP Reimbursement Rate", rate_py="APP Reimbursement Rate PY", change_pp="APP Reimbursement Change pp",
                   net_cost="Fraud Net Cost")


# ---------------------------------------------------------------- contexts, cards, status, scope


@query("deposits_by_group", f"""
SELECT 'Deposits' AS product_group, {r('dep', 'deposits')}, {r('dep', 'all_balance')} FROM ye WHERE y = 2000
UNION ALL SELECT 'Lending', {r('dep', 'a')}, {r('loan_eom', 'b')} FROM ye WHERE y = 2000""")
def deposits_by_group(x):
    """A replacing filter overrides the axis on its own column: the lending row still shows deposits."""
    ctx = Context((one_of("dim_date", "YearMonth", "2000-12"),))
    d = evaluate(x.model, ctx, ["dim_product.ProductGroup"], ["Customer Deposits"])
    total = x.model.tables["fact_product_monthly"].filter("DateKey = 20001231").join(
        x.dim_product.select("ProductKey", "ProductGroup"), "ProductKey").groupBy("ProductGroup").agg(F.sum("EOMBalance").alias("all_balance"))
    return res(d.join(total, "ProductGroup"), product_group="ProductGroup", deposits="Customer Deposits", all_balance="all_balance")


@query("brand_does_not_reach_budget", f"""
SELECT brand, {r('sum(interest_income - ftp_charge + ftp_credit - interest_expense)', 'nii')},
  {r(f'(SELECT sum(b_nii) FROM budget WHERE month_end <= {LAST})', 'nii_budget')} FROM pnl GROUP BY 1""")
def brand_does_not_reach_budget(x):
    """A dimension without a relationship leaves the measure unchanged in every row."""
    return res(evaluate(x.model, Context(), ["dim_brand.Brand"], ["NII", "NII Budget"]), brand="Brand", nii="NII", nii_budget="NII Budget")


@query("segment_through_product", f"""
SELECT CASE WHEN product_id = 'P09' THEN 'SME' ELSE 'Personal' END AS segment, {r('sum(interest_income - ftp_charge + ftp_credit - interest_expense)', 'nii')}
FROM pnl GROUP BY 1""")
def segment_through_product(x):
    """Segment filters product facts through the product dimension, not through the customer."""
    return res(evaluate(x.model, Context(), ["dim_segment.Segment"], ["NII"]), segment="Segment", nii="NII")


@query("prior_year_window_with_gap", f"""
SELECT {r("sum(nii) FILTER (strftime(month_end, '%m') = '03' AND y IN (1998, 2000))", 'nii')},
  {r("sum(nii) FILTER (month_end BETWEEN DATE '1997-03-01' AND DATE '1999-03-31')", 'nii_py')} FROM pm""")
def prior_year_window_with_gap(x):
    """March of two years: the prior-year window is contiguous and also holds the months between."""
    ctx = Context((one_of("dim_date", "YearMonth", "1998-03", "2000-03"),))
    return res(evaluate(x.model, ctx, [], ["NII", "NII PY"]), nii="NII", nii_py="NII PY")


@query("home_cards", f"""
SELECT {r('yf.nii', 'nii')}, {r(_NIM, 'nim')}, c.active FROM years JOIN yf ON yf.y = years.y JOIN {_CU} c ON c.y = years.y WHERE years.y = 2001""")
def home_cards(x):
    return res(reports.home(x.model, 2001), nii="NII", nim="NIM", active="Active Customers")


_KPI_SHOWN = ["NII YoY", "NII vs Budget", "NIM", "Cost Income", "Deposits YoY", "Arrears 90", "ECL Coverage"]


def _label(v, digits, pct, suffix):
    shown = f"printf('%.{digits}f', round(abs({v}) * {100 if pct else 1}, {digits}))" + (" || '%'" if pct else "")
    return (f"CASE WHEN {v} IS NULL THEN 'no comparison' ELSE CASE WHEN {v} >= 0 THEN '▲ ' ELSE '▼ ' END || {shown} || ' {suffix}' END")


_KV = {
    "nii_yoy": (_CHG.format("yf.nii", "yp.nii"), 1, True, "vs PY", ">="),
    "nii_vs_budget": (_CHG.format("yf.nii", "b_nii"), 1, True, "vs budget", ">="),
    "nim": (f"({_NIM} - coalesce({_NIMP}, 0)) * 10000", 0, False, "bps vs PY", ">="),
    "cost_income": (f"({_CI} - coalesce({_CIP}, 0)) * 100", 1, False, "pp vs PY", "<="),
    "deposits_yoy": (_CHG.format("ye.dep", "yep.dep"), 1, True, "vs PY", ">="),
    "arrears_90": ("(" + div("ye.a90", "ye.loan_eom") + " - coalesce(" + div("yep.a90", "yep.loan_eom") + ", 0)) * 10000", 0, False, "bps vs PY", "<="),
}


@query("kpi_status", "SELECT y AS year_no, " + ", ".join(
    f"{_label(k, d, p, s)} AS {k}_label, CASE WHEN {k} IS NULL THEN 'neutral' WHEN {k} {op} 0 THEN 'good' ELSE 'bad' END AS {k}_state"
    for k, (_, d, p, s, op) in _KV.items()) + ", 'neutral' AS ecl_coverage_state FROM (SELECT years.y, " + ", ".join(
        f"{e} AS {k}" for k, (e, *_) in _KV.items()) + """
FROM years JOIN yf ON yf.y = years.y JOIN ye ON ye.y = years.y JOIN opex_y oy ON oy.y = years.y LEFT JOIN yp ON yp.y = years.y LEFT JOIN yep ON yep.y = years.y
LEFT JOIN bud_y ON bud_y.y = years.y LEFT JOIN opex_p op ON op.y = years.y) v""")
def kpi_status(x):
    cols = {}
    for k in _KPI_SHOWN:
        short = k.lower().replace(" ", "_")
        if k != "ECL Coverage":
            cols[f"{short}_label"] = f"{k} Label"
        cols[f"{short}_state"] = f"{k} Colour"
    return by_year(x, **cols)


@query("region_scorecard", f"""
SELECT CASE product_id WHEN 'P01' THEN 'STANDARD' WHEN 'P02' THEN 'SMALL' WHEN 'P03' THEN 'MEDIUM' WHEN 'P04' THEN 'ECONOMY'
  WHEN 'P05' THEN 'LARGE' ELSE 'PROMO' END AS product, {r("sum(eom_balance) FILTER (product_id NOT IN ('P01','P02','P03') AND month_end = DATE '2001-07-31')", 'loan_book')},
  {r("sum(eom_balance) FILTER (product_id IN ('P01','P02','P03') AND month_end = DATE '2001-07-31')", 'deposits')},
  {r('sum(interest_income - ftp_charge + ftp_credit - interest_expense)', 'nii')},
  {r(div("sum(a90) FILTER (month_end = DATE '2001-07-31')", "sum(eom_balance) FILTER (product_id NOT IN ('P01','P02','P03') AND month_end = DATE '2001-07-31')"), 'arrears90_rate')}
FROM pnl JOIN regions_named USING (region_key) WHERE region_name = 'Europe' GROUP BY 1""")
def region_scorecard(x):
    d = reports.region_scorecard(x.model, "Europe")["products"]
    return res(d, product="ProductName", loan_book="Loan Book", deposits="Customer Deposits", nii="NII", arrears90_rate="Arrears 90+ Rate")


@query("row_scope", f"""
SELECT strftime(month_end, '%Y-%m') AS year_month, {r('sum(interest_income - ftp_charge + ftp_credit - interest_expense)', 'nii')}
FROM pnl WHERE region_key = 3 GROUP BY 1""")
def row_scope(x):
    """One director sees one region in every measure."""
    t = {n: x.model.tables[n] for n in ("dim_date", "all_dates", "dim_region", "dim_product", "fact_product_monthly")}
    m = scope.row_scope(replace(x.model, tables=t), "Director2@bank.example")
    return res(evaluate(m, Context(), [MONTH], ["NII"]), year_month="YearMonth", nii="NII")
