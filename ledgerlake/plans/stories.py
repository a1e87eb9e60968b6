"""Validation report: yearly figures recomputed from the staged extracts."""
from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..functions.amounts import MONEY, ratio
from ..functions.dates import days_between, quarter_period
from ..operators.groups import last_of_each, pivot_sum
from .facts import EIGHT_WEEKS, SCAM_RULE_START

def _year():
    return F.year("month_end")



def _sum(c):
    return F.sum(F.col(c).cast(MONEY))


def _sum_when(cond, c):
    return F.sum(F.when(cond, F.col(c).cast(MONEY)).otherwise(F.lit(0).cast(MONEY)))


def deposits_by_month(staged: DataFrame) -> DataFrame:
    return staged.groupBy("month_end", "product_id").agg(
        _sum("eom_balance").alias("eom_balance"), _sum("interest_expense").alias("interest_expense"),
        _sum("ftp_credit").alias("ftp_credit"), _sum("fee_income").alias("fee_income"))


def loans_by_month(staged: DataFrame) -> DataFrame:
    return staged.groupBy("month_end", "product_id").agg(
        *[_sum(c).alias(c) for c in ["balance_eom", "interest_income", "ftp_charge", "fee_income", "ecl",
                                     "write_off_amount", "guarantee_claim_amount", "new_lending_amount"]],
        _sum_when(F.col("arrears_bucket") == "90+", "balance_eom").alias("b90"),
        _sum_when(F.col("ifrs9_stage") == 2, "balance_eom").alias("s2"),
        _sum_when(F.col("ifrs9_stage") == 3, "balance_eom").alias("s3"),
        _sum_when(F.col("is_payment_holiday"), "balance_eom").alias("hol"))


def yearly_income(dep: DataFrame, ln: DataFrame) -> DataFrame:
    d = dep.groupBy(_year().alias("year")).agg(
        F.sum(F.col("ftp_credit") - F.col("interest_expense")).alias("nii_deposits"), F.sum("fee_income").alias("fees_d"))
    per_month = ln.groupBy(_year().alias("year"), "month_end").agg(
        F.sum("balance_eom").alias("bal"), F.sum(F.col("interest_income") - F.col("ftp_charge")).alias("nii"),
        F.sum("fee_income").alias("fee"))
    loan = per_month.groupBy("year").agg(
        F.sum("nii").alias("nii_lending"), F.sum("fee").alias("fees_l"), F.avg(F.col("bal").cast("double")).alias("loans_avg"),
        F.count(F.lit(1)).alias("months"))
    return d.join(loan, "year").select(
        "year", "nii_deposits", "nii_lending", (F.col("nii_deposits") + F.col("nii_lending")).alias("nii_total"),
        (F.col("fees_d") + F.col("fees_l")).alias("fees"), "months", "loans_avg")


def income_and_margin(dep: DataFrame, ln: DataFrame, rate: DataFrame) -> DataFrame:
    """Mean policy rate, income and margin by year, years with every part only."""
    mean_rate = rate.groupBy(F.year("Date").alias("year")).agg(F.avg(F.col("BankRate").cast("double")).alias("bank_rate_avg"))
    nim = F.col("nii_total").cast("double") / F.col("months") * 12 / F.col("loans_avg") * 100
    return yearly_income(dep, ln).join(mean_rate, "year").select(
        "year", "bank_rate_avg", "nii_deposits", "nii_lending", "nii_total", "fees", nim.alias("nim_pct"))


def year_end_balances(monthly: DataFrame, balance: str, products: Sequence[str]) -> DataFrame:
    """Balance at each year's last month, products as columns."""
    rows = last_of_each(monthly, _year(), "month_end").withColumn("year", _year())
    return pivot_sum(rows, ["year"], "product_id", products, balance)


def year_end_risk(ln: DataFrame) -> DataFrame:
    g = last_of_each(ln, _year(), "month_end").groupBy(_year().alias("year"), "product_id").agg(
        *[F.sum(c).alias(c) for c in ("balance_eom", "b90", "s2", "s3", "ecl")])
    pct = {"arrears90_pct": "b90", "stage2_pct": "s2", "stage3_pct": "s3", "ecl_cov_pct": "ecl"}
    return g.select("year", "product_id", "balance_eom", *[(ratio(c, "balance_eom") * 100).alias(n) for n, c in pct.items()])


def year_end_risk_wide(ln: DataFrame, products: Sequence[str]) -> DataFrame:
    return year_end_risk(ln).groupBy("year").pivot("product_id", list(products)).agg(
        F.max("arrears90_pct").alias("arrears90_pct"), F.max("stage2_pct").alias("stage2_pct"))


def coverage_by_year(ln: DataFrame) -> DataFrame:
    g = last_of_each(ln, _year(), "month_end").groupBy(_year().alias("year")).agg(
        F.sum("ecl").alias("ecl"), F.sum("balance_eom").alias("bal"))
    return g.select("year", (ratio("ecl", "bal") * 100).alias("ecl_cov_pct"))


def holiday_balances(ln: DataFrame, year: int) -> DataFrame:
    return ln.filter(_year() == year).groupBy("month_end").agg(F.sum("hol").alias("hol")).filter(F.col("hol") > 0)


def write_offs_by_year(ln: DataFrame) -> DataFrame:
    return ln.groupBy(_year().alias("year")).agg(
        F.sum("write_off_amount").alias("write_off"), F.sum("guarantee_claim_amount").alias("guarantee"),
        F.sum("new_lending_amount").alias("new_lending"))


def vintage_default_rate(accounts: DataFrame, loans: DataFrame, product: str = "P09") -> DataFrame:
    """Share of a product's accounts ever at 90+ or written off, by quarter of opening."""
    mine = accounts.filter(F.col("product_id") == product).select("account_id", "open_date").dropDuplicates(["account_id"])
    ever = loans.filter((F.col("product_id") == product) & (
        (F.col("arrears_bucket") == "90+") | (F.col("account_status") == "Written Off"))).select("account_id").distinct()
    marked = mine.join(ever.withColumn("hit", F.lit(1)), "account_id", "left")
    return marked.groupBy(quarter_period(F.to_date("open_date")).alias("vintage")).agg(
        F.count(F.lit(1)).alias("loans"), (F.avg(F.coalesce("hit", F.lit(0)).cast("double")) * 100).alias("default_rate"))


def checkpoints(branches: DataFrame, digital: DataFrame, points: DataFrame) -> DataFrame:
    """Open branches and digital use at each checkpoint (a table with a `month_end` column).

    Branches are summed per closure month first; every checkpoint then counts those that close later.
    """
    closing = branches.groupBy(F.to_date("closure_date").alias("closure")).agg(F.count(F.lit(1)).alias("n"))
    listed = points.agg(F.collect_set("month_end").alias("p")).scalar()  # a handful of report dates
    open_at = closing.withColumn("month_end", F.explode(listed)).groupBy("month_end").agg(
        F.sum(F.when(F.col("closure").isNull() | (F.col("closure") > F.col("month_end")), F.col("n")).otherwise(0))
        .alias("branches_open"))
    use = digital.join(points.select("month_end").distinct(), "month_end", "left_semi").groupBy("month_end").agg(
        F.count(F.lit(1)).alias("digital_registered"), F.count_if("is_monthly_active").alias("monthly_active"),
        F.avg(F.col("app_sessions").cast("double")).alias("avg_app_sessions"))
    return open_at.join(use, "month_end", "left")


def complaints_by_year(staged: DataFrame) -> DataFrame:
    """Here an open complaint counts as not resolved in time."""
    days = days_between("received_date", "resolved_date")
    return staged.groupBy(F.year("received_date").alias("year")).agg(
        F.count("complaint_id").alias("complaints"),
        (F.avg(F.when(days <= EIGHT_WEEKS, 1.0).otherwise(0.0)) * 100).alias("within_8_weeks_pct"),
        (F.avg(F.col("upheld").cast("double")) * 100).alias("upheld_pct"))


def scams_before_and_after(staged: DataFrame, fraud_type: str = "APP Scam", rule_start: date = SCAM_RULE_START) -> DataFrame:
    period = F.when(F.to_date("reported_date") >= F.lit(rule_start), "after rule").otherwise("before rule")
    g = staged.filter(F.col("fraud_type") == fraud_type).groupBy(period.alias("period")).agg(
        F.count("case_id").alias("cases"), _sum("loss_amount").alias("loss"), _sum("reimbursed_amount").alias("reimbursed"))
    return g.withColumn("reimbursement_pct", ratio("reimbursed", "loss") * 100)


def budget_against_actual(income: DataFrame, budget: DataFrame, last_actual) -> DataFrame:
    b = budget.groupBy(_year().alias("year")).agg(
        _sum_when(F.col("month_end") <= F.lit(last_actual), "budget_nii").alias("budget_nii"),
        _sum("budget_nii").alias("full_year_budget"))
    return income.select("year", F.col("nii_total").alias("actual_nii")).join(b, "year", "full")


def cost_income_by_year(income: DataFrame, opex: DataFrame) -> DataFrame:
    o = opex.groupBy(_year().alias("year")).agg(_sum("actual_amount").alias("cost"))
    return o.join(income, "year").select(
        "year", (ratio("cost", F.col("nii_total") + F.col("fees")) * 100).alias("cost_income_pct"))

