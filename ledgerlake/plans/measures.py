"""The measure registry: names, folders, formats and definitions of the report measures."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.amounts import minus, plus, ratio, smaller
from ..functions.dates import minutes_crossed, month_label
from .model import DATE, Calc, Filter, Leaf, Measure, Period, Shift, SumOver, one_of
from .status import NEUTRAL, kpi_label, kpi_status, run_status, severity_status

PNL, RISK = "fact_product_monthly", "fact_credit_risk_monthly"
WALL, REPRICING, VINTAGE = "fact_mortgage_maturity", "fact_mortgage_repricing", "fact_bbl_vintage"
CUSTOMERS, TXN, BRANCHES = "fact_customer_monthly", "fact_transactions_monthly", "fact_branch_monthly"
COMPLAINTS, FRAUD = "fact_complaint", "fact_fraud_case"
BUDGET, OPEX, RATE = "fact_budget_monthly", "fact_opex_monthly", "fact_bank_rate_daily"
STATS, RUNS, DQ, LOADS = "platform_table_stats", "pipeline_runs", "data_quality_summary", "load_status"
LAST_LOAD = "last_load"  # the runs of the latest run date, see latest_runs

POUND, COUNT, PCT1, PCT2 = "£#,0", "#,0", "0.0%", "0.00%"
PP, BPS = "+0.0;-0.0;0.0", "+0;-0;0"

DEPOSITS = one_of("dim_product", "ProductGroup", "Deposits")
LENDING = one_of("dim_product", "ProductGroup", "Lending")
APP_SCAM = "APP Scam"


def _pct_change(now, before):
    return ratio(minus(now, before), before)


def _times(factor):
    return lambda now, before: minus(now, before) * F.lit(float(factor))


def _annualised(amount, months, base):
    return ratio(amount.cast("double") * 12 / months, base)


class Registry(dict):
    """Measures by name, in registration order."""

    def add(self, folder, name, fmt, node, description=""):
        if name in self:
            raise ValueError(f"measure {name!r} is registered twice")
        self[name] = Measure(folder, name, fmt, node, description)

    # -- shorthands for the repeating kinds
    def flow(self, folder, name, fmt, table, column=None, how="sum", *replace, note=""):
        self.add(folder, name, fmt, Leaf(table, how, column, "flow", replace), note)

    def at_end(self, folder, name, fmt, table, column=None, how="sum", *replace, note=""):
        self.add(folder, name, fmt, Leaf(table, how, column, "end", replace), note or "Read at the period end date.")

    def budget(self, folder, name, table, column):
        self.add(folder, name, POUND, Leaf(table, "sum", column, "cap"), "Actual months of the selection only.")

    def prior_flow(self, folder, of, fmt, name=None):
        self.add(folder, name or f"{of} PY", fmt, Shift(of, "py_flow"), "Same window one year earlier.")

    def prior_end(self, folder, of, fmt, name=None):
        self.add(folder, name or f"{of} PY", fmt, Shift(of, "py_end"), "Twelve months before the period end.")

    def yoy(self, folder, of, name=None):
        self.add(folder, name or f"{of} YoY %", PCT1, Calc(_pct_change, (of, f"{of} PY")))

    def change(self, folder, name, fmt, of, before, factor):
        self.add(folder, name, fmt, Calc(_times(factor), (of, before)))

    def share(self, folder, name, fmt, num, den, note=""):
        self.add(folder, name, fmt, Calc(ratio, (num, den)), note)


def build_registry() -> Registry:
    r = Registry()
    _helpers(r)
    _income(r)
    _balance_sheet(r)
    _bridge(r)
    _credit(r)
    _customers(r)
    _conduct(r)
    _platform(r)
    _status(r)
    return r


def _helpers(r: Registry):
    f = "00 Helpers"
    r.add(f, "Last Actual Date", "dd mmm yyyy", Leaf("all_dates", "max", "if(IsActualPeriod, Date, null)"),
          "Last day with actual data, whatever is selected.")
    r.add(f, "Period End Date", "dd mmm yyyy", Period("end"), "Last selected day, capped at the last actual date.")
    r.add(f, "Months In Period", COUNT, Period("months"), "Selected actual months.")
    r.add(f, "First Selected Date", "dd mmm yyyy", Period("first"))
    r.add(f, "Data As Of", "", Calc(lambda d: F.date_format(d, "dd MMM yyyy"), ("Last Actual Date",)))
    r.add(f, "Selected Period Label", "", Calc(
        lambda a, b: F.concat(month_label(a), F.lit(" to "), month_label(b)), ("First Selected Date", "Period End Date")))
    r.add(f, "Regions Selected", COUNT, Leaf("dim_region", "count_distinct", "RegionName"))
    r.add(f, "Region Name", "", Leaf("dim_region", "max", "RegionName"))
    r.add(f, "Region Director", "", Leaf("dim_region", "max", "RegionalDirector"))
    r.add(f, "Selected Region Title", "", Calc(
        lambda n, name, who: F.when(n == 1, F.concat(name, F.lit(" | Regional Director: "), F.coalesce(who, F.lit(""))))
        .otherwise("All UK regions"), ("Regions Selected", "Region Name", "Region Director")))


def _income(r: Registry):
    f = "01 Income"
    for name, column in [("Interest Income", "InterestIncome"), ("Interest Expense", "InterestExpense"),
                         ("FTP Credit", "FTPCredit"), ("FTP Charge", "FTPCharge")]:
        r.flow(f, name, POUND, PNL, column)
    r.add(f, "NII", POUND, Calc(lambda inc, charge, credit, exp: minus(plus(inc, credit), charge, exp),
                                ("Interest Income", "FTP Charge", "FTP Credit", "Interest Expense")),
          "Net interest income on a funds-transfer-pricing basis.")
    r.prior_flow(f, "NII", POUND)
    r.yoy(f, "NII")
    r.budget(f, "NII Budget", BUDGET, "BudgetNII")
    r.flow(f, "NII Budget Full Year", POUND, BUDGET, "BudgetNII")
    r.add(f, "NII vs Budget", POUND, Calc(minus, ("NII", "NII Budget")))
    r.add(f, "NII vs Budget %", PCT1, Calc(_pct_change, ("NII", "NII Budget")))
    r.flow(f, "Fee Income", POUND, PNL, "FeeIncome")
    r.prior_flow(f, "Fee Income", POUND)
    r.yoy(f, "Fee Income")
    r.budget(f, "Fee Income Budget", BUDGET, "BudgetFees")
    r.add(f, "Total Income", POUND, Calc(plus, ("NII", "Fee Income")))
    r.add(f, "Total Income PY", POUND, Calc(plus, ("NII PY", "Fee Income PY")))
    r.flow(f, "Operating Costs", POUND, OPEX, "ActualAmount")
    r.prior_flow(f, "Operating Costs", POUND)
    r.budget(f, "Operating Costs Budget", OPEX, "BudgetAmount")
    r.share(f, "Cost Income Ratio", PCT1, "Operating Costs", "Total Income")
    r.share(f, "Cost Income Ratio PY", PCT1, "Operating Costs PY", "Total Income PY")
    r.change(f, "Cost Income Ratio Change pp", PP, "Cost Income Ratio", "Cost Income Ratio PY", 100)


def _balance_sheet(r: Registry):
    f = "02 Balance Sheet"

    def products(*ids):
        return one_of("dim_product", "ProductID", *ids)

    r.at_end(f, "Customer Deposits", POUND, PNL, "EOMBalance", "sum", DEPOSITS)
    r.prior_end(f, "Customer Deposits", POUND)
    r.yoy(f, "Customer Deposits")
    r.at_end(f, "Current Account Balances", POUND, PNL, "EOMBalance", "sum", products("P01", "P07"))
    r.at_end(f, "Savings Balances", POUND, PNL, "EOMBalance", "sum", products("P02", "P03"))
    r.at_end(f, "Fixed Term Savings", POUND, PNL, "EOMBalance", "sum", products("P03"))
    r.share(f, "Fixed Term Share of Deposits", PCT1, "Fixed Term Savings", "Customer Deposits")
    r.at_end(f, "Loan Book", POUND, PNL, "EOMBalance", "sum", LENDING)
    r.prior_end(f, "Loan Book", POUND)
    r.yoy(f, "Loan Book")
    r.at_end(f, "ECL Stock", POUND, PNL, "ECL")
    r.add(f, "Net Loans", POUND, Calc(minus, ("Loan Book", "ECL Stock")))
    r.prior_end(f, "Net Loans", POUND)
    r.yoy(f, "Net Loans")
    r.share(f, "Loan to Deposit Ratio", PCT1, "Loan Book", "Customer Deposits")
    r.add(f, "Avg Loan Balance", POUND, Leaf(PNL, "sum", "EOMBalance", "cap", (LENDING,), per_month_mean=True),
          "Mean of the month-end loan balances of the selected actual months.")
    r.add(f, "NIM", PCT2, Calc(_annualised, ("NII", "Months In Period", "Avg Loan Balance")),
          "Annualised net interest income over average loans.")
    r.prior_flow(f, "NIM", PCT2)
    r.change(f, "NIM Change bps", BPS, "NIM", "NIM PY", 10000)
    r.flow(f, "Bank Rate Sum", PCT2, RATE, "BankRate")
    r.flow(f, "Bank Rate Days", COUNT, RATE, "BankRate", "count")
    r.add(f, "Bank Rate", PCT2, Calc(lambda s, n: ratio(s, n) / 100, ("Bank Rate Sum", "Bank Rate Days")),
          "Mean daily rate.")
    r.add(f, "Bank Rate Last", PCT2, Leaf(RATE, "max", "BankRate", "end_exact"))
    r.add(f, "Bank Rate Period End", PCT2, Calc(lambda x: x.cast("double") / 100, ("Bank Rate Last",)))
    for group, test, base in [("Deposits", DEPOSITS, "AvgBalance"), ("Loans", LENDING, "EOMBalance")]:
        r.flow(f, f"{group} Rate x Balance", POUND, PNL, "RateXBalance", "sum", test)
        r.flow(f, f"{group} Rate Base", POUND, PNL, base, "sum", test)
        r.add(f, f"Customer Rate {group}", PCT2, Calc(lambda a, b: ratio(a, b) / 100,
                                                      (f"{group} Rate x Balance", f"{group} Rate Base")))
    r.share(f, "Deposit Beta", PCT1, "Customer Rate Deposits", "Bank Rate")


def _bridge(r: Registry):
    f = "03 NII Bridge"
    r.flow(f, "Balance Months", POUND, PNL, "AvgBalance")
    r.prior_flow(f, "Balance Months", POUND)
    parts = ("NII", "NII PY", "Balance Months", "Balance Months PY")
    r.add(f, "Bridge Volume Effect", POUND, SumOver(
        "dim_product.ProductID", lambda n, npy, b, bpy: minus(b, bpy).cast("double") * ratio(npy, bpy), parts),
        "Balance growth at last year's margin, per product.")
    r.add(f, "Bridge Margin Effect", POUND, SumOver(
        "dim_product.ProductID",
        lambda n, npy, b, bpy: minus(ratio(n, b), ratio(npy, bpy)) * b.cast("double"), parts),
        "Margin change on this year's balance, per product.")
    r.add(f, "Bridge Other", POUND, Calc(
        lambda n, npy, v, m: minus(n.cast("double"), npy.cast("double"), v, m),
        ("NII", "NII PY", "Bridge Volume Effect", "Bridge Margin Effect")))
    r.add(f, "NII Bridge Value", POUND, Calc(
        lambda step, *values: F.coalesce(*[F.when(step == i + 1, v.cast("double")) for i, v in enumerate(values)]),
        ("@bridge_steps.Order", "NII PY", "Bridge Volume Effect", "Bridge Margin Effect", "Bridge Other")))
    r.add(f, "Bridge Axis Min", POUND, Calc(lambda a, b: smaller(a, b).cast("double") * 0.9, ("NII PY", "NII")))


def _credit(r: Registry):
    f = "04 Credit Risk"
    r.flow(f, "Gross New Lending", POUND, PNL, "NewLending")
    r.prior_flow(f, "Gross New Lending", POUND)
    r.yoy(f, "Gross New Lending")
    for s in (1, 2, 3):
        r.at_end(f, f"Stage {s} Balance", POUND, PNL, f"Stage{s}Balance")
        r.share(f, f"Stage {s} Share", PCT1, f"Stage {s} Balance", "Loan Book")
    r.prior_end(f, "Stage 2 Share", PCT1)
    r.change(f, "Stage 2 Share Change pp", PP, "Stage 2 Share", "Stage 2 Share PY", 100)
    r.at_end(f, "Arrears 90+ Balance", POUND, PNL, "Arrears90Balance")
    r.share(f, "Arrears 90+ Rate", PCT2, "Arrears 90+ Balance", "Loan Book")
    r.prior_end(f, "Arrears 90+ Rate", PCT2)
    r.change(f, "Arrears 90+ Change bps", BPS, "Arrears 90+ Rate", "Arrears 90+ Rate PY", 10000)
    r.at_end(f, "Arrears 30+ Balance", POUND, PNL, "Arrears30Balance")
    r.share(f, "Arrears 30+ Rate", PCT2, "Arrears 30+ Balance", "Loan Book")
    r.share(f, "ECL Coverage", PCT2, "ECL Stock", "Loan Book")
    r.prior_end(f, "ECL Coverage", PCT2)
    r.change(f, "ECL Coverage Change bps", BPS, "ECL Coverage", "ECL Coverage PY", 10000)
    r.add(f, "ECL Opening", POUND, Leaf(PNL, "sum", "ECL", "open"), "At the month end before the first selected day.")
    r.flow(f, "Write-offs", POUND, PNL, "WriteOff")
    r.flow(f, "Guarantee Claims", POUND, PNL, "GuaranteeClaim")
    r.add(f, "Net Write-offs", POUND, Calc(minus, ("Write-offs", "Guarantee Claims")))
    r.add(f, "Impairment Charge", POUND, Calc(lambda now, opening, net: plus(minus(now, opening), net),
                                              ("ECL Stock", "ECL Opening", "Net Write-offs")))
    r.budget(f, "Impairment Budget", BUDGET, "BudgetImpairment")
    r.add(f, "Cost of Risk", PCT2, Calc(_annualised, ("Impairment Charge", "Months In Period", "Avg Loan Balance")))
    r.prior_flow(f, "Cost of Risk", PCT2)
    r.change(f, "Cost of Risk Change bps", BPS, "Cost of Risk", "Cost of Risk PY", 10000)
    r.flow(f, "Payment Holiday Balance", POUND, PNL, "PaymentHolidayBalance")
    r.at_end(f, "Risk Balance", POUND, RISK, "Balance")
    r.at_end(f, "Risk 90+ Balance", POUND, RISK, "Balance", "sum", one_of(RISK, "ArrearsBucket", "90+"))
    r.share(f, "Risk 90+ Rate", PCT2, "Risk 90+ Balance", "Risk Balance")
    r.at_end(f, "Risk ECL", POUND, RISK, "ECL")
    r.share(f, "Risk ECL Coverage", PCT2, "Risk ECL", "Risk Balance")
    r.at_end(f, "Risk EAD", POUND, RISK, "EAD")
    r.at_end(f, "Risk PD x EAD", POUND, RISK, "PDxEAD")
    r.share(f, "Risk Avg PD", PCT2, "Risk PD x EAD", "Risk EAD")
    r.flow(f, "Maturing Fixed Balance", POUND, WALL, "Balance")
    r.flow(f, "Maturing Fixed Accounts", COUNT, WALL, "Accounts")
    r.flow(f, "Maturing Rate x Balance", POUND, WALL, "RateXBalance")
    r.add(f, "Maturing Avg Current Rate", PCT2, Calc(lambda a, b: ratio(a, b) / 100,
                                                     ("Maturing Rate x Balance", "Maturing Fixed Balance")))
    r.flow(f, "Maturing Next 12M Balance", POUND, WALL, "if(IsNext12Months, Balance, null)", "sum",
           Filter(WALL, "DealEndMonthKey", lambda c: c.isNotNull()))
    r.flow(f, "Repricings", COUNT, REPRICING, "Repricings")
    for name, column in [("Repriced Balance", "Balance"), ("Repricing Old Rate x Balance", "OldRateXBalance"),
                         ("Repricing New Rate x Balance", "NewRateXBalance"), ("Repricing Old Payment", "OldPayment"),
                         ("Repricing New Payment", "NewPayment")]:
        r.flow(f, name, POUND, REPRICING, column)
    for age in ("Old", "New"):
        r.add(f, f"Repricing {age} Rate", PCT2, Calc(lambda a, b: ratio(a, b) / 100,
                                                     (f"Repricing {age} Rate x Balance", "Repriced Balance")))
    r.add(f, "Payment Shock %", PCT1, Calc(lambda new, old: minus(ratio(new, old), F.lit(1.0)),
                                           ("Repricing New Payment", "Repricing Old Payment")))
    r.flow(f, "Vintage Defaulted Loans", COUNT, VINTAGE, "DefaultedLoans")
    r.flow(f, "Vintage Loans", COUNT, VINTAGE, "Loans")
    r.share(f, "BBL Cumulative Default Rate", PCT1, "Vintage Defaulted Loans", "Vintage Loans")
    r.flow(f, "BBL Loans", COUNT, VINTAGE, "Loans", "sum", one_of(VINTAGE, "MonthsOnBook", 0))


def _customers(r: Registry):
    f = "05 Customers"
    r.at_end(f, "Active Customers", COUNT, CUSTOMERS, "ActiveCustomers")
    r.prior_end(f, "Active Customers", COUNT)
    r.yoy(f, "Active Customers")
    r.flow(f, "New Customers", COUNT, CUSTOMERS, "NewCustomers")
    r.flow(f, "Churned Customers", COUNT, CUSTOMERS, "ChurnedCustomers")
    r.add(f, "Annualised Churn Rate", PCT1, Calc(_annualised, ("Churned Customers", "Months In Period", "Active Customers")))
    r.at_end(f, "Digital Registered", COUNT, CUSTOMERS, "DigitalRegistered")
    r.at_end(f, "App Monthly Users", COUNT, CUSTOMERS, "MonthlyActiveUsers")
    r.prior_end(f, "App Monthly Users", COUNT)
    r.yoy(f, "App Monthly Users")
    r.share(f, "Digital Active Share", PCT1, "App Monthly Users", "Active Customers")
    r.prior_end(f, "Digital Active Share", PCT1)
    r.change(f, "Digital Active Share Change pp", PP, "Digital Active Share", "Digital Active Share PY", 100)
    r.add(f, "Digital Active Share UK", PCT1, Shift("Digital Active Share", "clear:dim_region"),
          "The same share without the region selection.")
    r.flow(f, "App Sessions", COUNT, CUSTOMERS, "AppSessions")
    r.flow(f, "App User Months", COUNT, CUSTOMERS, "MonthlyActiveUsers")
    r.share(f, "App Sessions per User", "#,0.0", "App Sessions", "App User Months")
    r.at_end(f, "Open Branches", COUNT, BRANCHES, None, "count", one_of(BRANCHES, "IsClosureMonth", False))
    r.prior_end(f, "Open Branches", COUNT)
    r.add(f, "Open Branches Change", BPS, Calc(minus, ("Open Branches", "Open Branches PY")))
    r.flow(f, "Branch Closures", COUNT, BRANCHES, None, "count", one_of(BRANCHES, "IsClosureMonth", True))
    r.flow(f, "Branch Footfall", COUNT, BRANCHES, "Footfall")
    r.add(f, "Branches At Base", COUNT, Leaf(BRANCHES, "count", None, "base"), "Closing branches included.")
    r.add(f, "App Users At Base", COUNT, Leaf(CUSTOMERS, "sum", "MonthlyActiveUsers", "base"))
    index = lambda now, base: ratio(now, base) * 100
    r.add(f, "Open Branches Index", COUNT, Calc(index, ("Open Branches", "Branches At Base")))
    r.add(f, "App Monthly Users Index", COUNT, Calc(index, ("App Monthly Users", "App Users At Base")))
    r.flow(f, "Transactions", COUNT, TXN, "TxnCount")
    r.flow(f, "Transaction Value", POUND, TXN, "TxnValue")
    for name, groups in [("Digital Transactions", ["Digital"]),
                         ("Assisted and Digital Transactions", ["Digital", "Branch and Phone"])]:
        r.flow(f, name, COUNT, TXN, "TxnCount", "sum", one_of("dim_channel", "ChannelGroup", *groups))
    r.share(f, "Digital Transaction Share", PCT1, "Digital Transactions", "Assisted and Digital Transactions")


def _conduct(r: Registry):
    f = "06 Conduct"
    true = lambda c: c == F.lit(True)
    r.flow(f, "Complaints", COUNT, COMPLAINTS, None, "count")
    r.prior_flow(f, "Complaints", COUNT)
    r.add(f, "Complaints per 1000 Customers", "#,0.00", Calc(
        lambda n, months, active: ratio(n / months, active / 1000), ("Complaints", "Months In Period", "Active Customers")))
    r.prior_flow(f, "Complaints per 1000 Customers", "#,0.00", "Complaints per 1000 PY")
    r.change(f, "Complaints per 1000 Change", "+0.00;-0.00;0.00", "Complaints per 1000 Customers",
             "Complaints per 1000 PY", 1)
    r.flow(f, "Resolved Within 8 Weeks", COUNT, COMPLAINTS, None, "count", Filter(COMPLAINTS, "IsResolvedWithin8Weeks", true))
    r.flow(f, "Resolved Complaints", COUNT, COMPLAINTS, None, "count",
           Filter(COMPLAINTS, "IsResolvedWithin8Weeks", lambda c: c.isNotNull()))
    r.share(f, "Resolved Within 8 Weeks %", PCT1, "Resolved Within 8 Weeks", "Resolved Complaints")
    r.flow(f, "Upheld Complaints", COUNT, COMPLAINTS, None, "count", Filter(COMPLAINTS, "IsUpheld", true))
    r.share(f, "Upheld %", PCT1, "Upheld Complaints", "Complaints")
    r.flow(f, "Redress Paid", POUND, COMPLAINTS, "RedressAmount")
    r.flow(f, "FOS Referrals", COUNT, COMPLAINTS, None, "count", Filter(COMPLAINTS, "IsReferredToFOS", true))
    r.share(f, "FOS Referral %", PCT1, "FOS Referrals", "Complaints")
    r.flow(f, "Open Complaints", COUNT, COMPLAINTS, None, "count", Filter(COMPLAINTS, "IsOpen", true))
    r.flow(f, "Fraud Cases", COUNT, FRAUD, None, "count")
    r.flow(f, "Fraud Losses", POUND, FRAUD, "LossAmount")
    scam = one_of(FRAUD, "FraudType", APP_SCAM)
    r.flow(f, "APP Scam Losses", POUND, FRAUD, "LossAmount", "sum", scam)
    r.flow(f, "APP Scam Reimbursed", POUND, FRAUD, "ReimbursedAmount", "sum", scam)
    r.share(f, "APP Reimbursement Rate", PCT1, "APP Scam Reimbursed", "APP Scam Losses")
    r.prior_flow(f, "APP Reimbursement Rate", PCT1)
    r.change(f, "APP Reimbursement Change pp", PP, "APP Reimbursement Rate", "APP Reimbursement Rate PY", 100)
    r.flow(f, "Fraud Reimbursed", POUND, FRAUD, "ReimbursedAmount")
    r.flow(f, "Fraud Recovered", POUND, FRAUD, "RecoveredAmount")
    r.add(f, "Fraud Net Cost", POUND, Calc(minus, ("Fraud Reimbursed", "Fraud Recovered")))


def _platform(r: Registry):
    f = "07 Platform"
    r.flow(f, "Rows in Warehouse", COUNT, STATS, "row_count", "sum", one_of(STATS, "layer", "gold"))
    r.flow(f, "Rows All Layers", COUNT, STATS, "row_count")
    r.flow(f, "Warehouse Size MB", COUNT, STATS, "used_mb")
    r.flow(f, "Tables Monitored", COUNT, STATS, "table_name", "count_distinct")
    r.flow(f, "Pipeline Runs", COUNT, RUNS, None, "count")
    r.flow(f, "Succeeded Runs", COUNT, RUNS, None, "count", one_of(RUNS, "status", "Succeeded"))
    r.flow(f, "Finished Runs", COUNT, RUNS, None, "count", one_of(RUNS, "status", "Succeeded", "Failed"))
    r.share(f, "Pipeline Success Rate", PCT1, "Succeeded Runs", "Finished Runs", "Skipped runs do not count.")
    r.flow(f, "Rows Copied", COUNT, RUNS, "rows_written")
    r.flow(f, "Last Load Started", "", LAST_LOAD, "started_at_utc", "min")
    r.flow(f, "Last Load Ended", "", LAST_LOAD, "ended_at_utc", "max")
    r.add(f, "Last Load Duration min", COUNT, Calc(minutes_crossed, ("Last Load Started", "Last Load Ended")))
    r.flow(f, "DQ Issues Fixed", COUNT, DQ, "affected_rows")
    r.flow(f, "DQ Checks Triggered", COUNT, DQ, None, "count")
    r.flow(f, "Last Loaded Month", "", LOADS, "last_loaded_month_end", "max")
    r.add(f, "Data Freshness", "", Calc(lambda d: F.concat(F.lit("Loaded to "), month_label(d)), ("Last Loaded Month",)))


# Fixed values: (KPI, value, format, suffix, better). "none": the status is always neutral in the deployed report.
KPIS = [
    ("NII YoY", "NII YoY %", "0.0%", "vs PY", "higher"),
    ("NII vs Budget", "NII vs Budget %", "0.0%", "vs budget", "higher"),
    ("NIM", "NIM Change bps", "0", "bps vs PY", "higher"),
    ("Fee Income YoY", "Fee Income YoY %", "0.0%", "vs PY", "higher"),
    ("Cost Income", "Cost Income Ratio Change pp", "0.0", "pp vs PY", "lower"),
    ("Deposits YoY", "Customer Deposits YoY %", "0.0%", "vs PY", "higher"),
    ("Net Loans YoY", "Net Loans YoY %", "0.0%", "vs PY", "higher"),
    ("New Lending YoY", "Gross New Lending YoY %", "0.0%", "vs PY", "higher"),
    ("Loan Book YoY", "Loan Book YoY %", "0.0%", "vs PY", "higher"),
    ("Arrears 90", "Arrears 90+ Change bps", "0", "bps vs PY", "lower"),
    ("Stage 2", "Stage 2 Share Change pp", "0.0", "pp vs PY", "lower"),
    ("ECL Coverage", "ECL Coverage Change bps", "0", "bps vs PY", "none"),
    ("Cost of Risk", "Cost of Risk Change bps", "0", "bps vs PY", "lower"),
    ("Active Customers YoY", "Active Customers YoY %", "0.0%", "vs PY", "higher"),
    ("Digital Share", "Digital Active Share Change pp", "0.0", "pp vs PY", "higher"),
    ("App Users YoY", "App Monthly Users YoY %", "0.0%", "vs PY", "higher"),
    ("Branches", "Open Branches Change", "#,0", "branches vs PY", "none"),
    ("Complaints", "Complaints per 1000 Change", "0.00", "vs PY", "lower"),
    ("APP Reimbursement", "APP Reimbursement Change pp", "0.0", "pp vs PY", "higher"),
]


def _status(r: Registry):
    f = "08 KPI Labels"
    for name, value, fmt, suffix, better in KPIS:
        r.add(f, f"{name} Label", "", Calc(lambda v, fmt=fmt, suffix=suffix: kpi_label(v, fmt, suffix), (value,)))
        r.add(f, f"{name} Colour", "", Calc(lambda v, better=better: kpi_status(v, better), (value,)))
    r.add(f, "Budget Variance Colour", "", Calc(lambda v: kpi_status(v, "higher"), ("NII vs Budget %",)))
    r.add(f, "Run Status Colour", "", Calc(lambda s, n: F.coalesce(run_status(s), F.lit(NEUTRAL)),
                                           (f"@{RUNS}.status", "Pipeline Runs")))
    r.add(f, "DQ Severity Colour", "", Calc(lambda s, n: F.coalesce(severity_status(s), F.lit(NEUTRAL)),
                                            (f"@{DQ}.severity", "DQ Checks Triggered")))


# Building blocks that are not measures of their own in the report.
_PARTS = {
    "First Selected Date", "Regions Selected", "Region Name", "Region Director", "Bank Rate Sum", "Bank Rate Days",
    "Bank Rate Last", "Deposits Rate x Balance", "Deposits Rate Base", "Loans Rate x Balance", "Loans Rate Base",
    "Write-offs", "Guarantee Claims", "Maturing Rate x Balance", "Repriced Balance", "Repricing Old Rate x Balance",
    "Repricing New Rate x Balance", "Repricing Old Payment", "Repricing New Payment", "Vintage Defaulted Loans",
    "Vintage Loans", "App Sessions", "App User Months", "Branches At Base", "App Users At Base",
    "Digital Transactions", "Assisted and Digital Transactions", "Resolved Within 8 Weeks", "Resolved Complaints",
    "Upheld Complaints", "FOS Referrals", "Fraud Reimbursed", "Fraud Recovered", "Succeeded Runs", "Finished Runs",
    "Last Load Started", "Last Load Ended", "Last Loaded Month",
}


def measure_catalogue(spark: SparkSession, registry: Registry | None = None) -> DataFrame:
    """Folder, name, format and description of every report measure."""
    registry = registry or build_registry()
    rows = [(m.folder, m.name, m.fmt, m.description) for m in registry.values() if m.name not in _PARTS]
    return spark.createDataFrame(rows, "folder string, name string, format string, description string")


def latest_runs(runs: DataFrame) -> DataFrame:
    """The runs of the latest run date, for the load duration (slicers do not apply to it)."""
    return runs.filter(F.col("run_date") == runs.agg(F.max("run_date").alias("d")).scalar())


def flag_next_year(maturity: DataFrame, last_actual) -> DataFrame:
    """Deals that end after the last actual month and within twelve months of it."""
    last = F.lit(last_actual)
    end = F.last_day(F.add_months(last, 12))

    def key(d):
        return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)
    return maturity.withColumn(
        "IsNext12Months", (F.col("DealEndMonthKey") > key(last)) & (F.col("DealEndMonthKey") <= key(end)))


__all__ = ["DATE", "KPIS", "Registry", "build_registry", "measure_catalogue"]
