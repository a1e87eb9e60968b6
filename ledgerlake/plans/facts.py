"""Fact loaders. Each takes all staged months at once and returns the rows of the gold fact.

Cleansing happens in flight (no cleaned copy of a large fact is kept). Duplicates are removed before
the dimension lookup, so after it an account has one row per month whatever the extract held.
"""
from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..functions.amounts import FTP4, MONEY, PROB6, RATE4, impute_stage, repair_sign
from ..functions.dates import date_key, days_between, parse_date
from ..operators.dedupe import keep_latest, keep_one
from ..operators.lookup import lookup
from ..operators.series import day_spine, forward_fill
from ..sources.landing import PREFERRED_RATE_SOURCE

SAVINGS_PRODUCTS = ("P02", "P03")
SCAM_RULE_START = date(2024, 10, 7)
EIGHT_WEEKS = 56


class NoValidRate(ValueError):
    """The staged rate series holds no usable row."""


def account_keys(accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Account id to all keys a balance row needs, so that the fact is looked up only once.

    Product comes from the account, region from the customer.
    """
    return accounts.select(F.col("AccountID").alias("account_id"), "AccountKey", "CustomerKey", "ProductKey").join(
        customers.select("CustomerKey", "RegionKey"), "CustomerKey")


def deposit_balances(staged: DataFrame, keys: DataFrame) -> DataFrame:
    """One row per account and month; a negative average of a savings product is a sign error."""
    rows = lookup(keep_one(staged, ["account_id", "month_end"]), keys, "account_id")
    return rows.select(
        date_key("month_end").alias("DateKey"), "AccountKey", "CustomerKey", "ProductKey", "RegionKey",
        repair_sign("avg_balance", "product_id", SAVINGS_PRODUCTS).cast(MONEY).alias("AvgBalance"),
        F.col("eom_balance").cast(MONEY).alias("EOMBalance"), F.col("customer_rate").cast(RATE4).alias("CustomerRate"),
        F.col("ftp_rate").cast(FTP4).alias("FTPRate"), F.col("interest_expense").cast(MONEY).alias("InterestExpense"),
        F.col("ftp_credit").cast(MONEY).alias("FTPCredit"), F.col("fee_income").cast(MONEY).alias("FeeIncome"))


def loan_performance(staged: DataFrame, keys: DataFrame) -> DataFrame:
    """One row per account and month; a missing stage is imputed from arrears."""
    rows = lookup(keep_one(staged, ["account_id", "month_end"]), keys, "account_id")
    return rows.select(
        date_key("month_end").alias("DateKey"), "AccountKey", "CustomerKey", "ProductKey", "RegionKey",
        F.col("rate_type").alias("RateType"), F.col("balance_eom").cast(MONEY).alias("BalanceEOM"),
        F.col("credit_limit").cast(MONEY).alias("CreditLimit"), F.col("customer_rate").cast(RATE4).alias("CustomerRate"),
        F.col("ftp_rate").cast(FTP4).alias("FTPRate"), F.col("interest_income").cast(MONEY).alias("InterestIncome"),
        F.col("ftp_charge").cast(MONEY).alias("FTPCharge"), F.col("fee_income").cast(MONEY).alias("FeeIncome"),
        F.col("scheduled_payment").cast(MONEY).alias("ScheduledPayment"),
        F.col("days_past_due").cast("int").alias("DaysPastDue"), F.col("arrears_bucket").alias("ArrearsBucket"),
        impute_stage("ifrs9_stage", "arrears_bucket", "days_past_due").alias("IFRS9Stage"),
        F.col("pd_12m").cast(PROB6).alias("PD12m"), F.col("lgd").cast(PROB6).alias("LGD"),
        F.col("ead").cast(MONEY).alias("EAD"), F.col("ecl").cast(MONEY).alias("ECL"),
        F.col("write_off_amount").cast(MONEY).alias("WriteOffAmount"),
        F.col("guarantee_claim_amount").cast(MONEY).alias("GuaranteeClaimAmount"),
        F.col("is_payment_holiday").alias("IsPaymentHoliday"), date_key("deal_end_date").alias("DealEndDateKey"),
        F.col("is_deal_maturity").alias("IsDealMaturity"), F.col("is_product_transfer").alias("IsProductTransfer"),
        F.col("current_ltv").cast("decimal(9,4)").alias("CurrentLTV"),
        F.col("new_lending_amount").cast(MONEY).alias("NewLendingAmount"),
        F.col("account_status").alias("AccountStatus"))


def digital_activity(staged: DataFrame, customers: DataFrame) -> DataFrame:
    """Rows as delivered (this fact is not deduplicated); unknown customers are rejected."""
    keys = customers.select(F.col("CustomerID").alias("customer_id"), "CustomerKey", "RegionKey")
    return lookup(staged, keys, "customer_id").select(
        date_key("month_end").alias("DateKey"), "CustomerKey", "RegionKey",
        F.col("web_logins").cast("int").alias("WebLogins"), F.col("app_sessions").cast("int").alias("AppSessions"),
        F.col("is_monthly_active").alias("IsMonthlyActive"), F.col("features_used").cast("int").alias("FeaturesUsed"))


def daily_transactions(staged: DataFrame, regions: DataFrame, products: DataFrame, channels: DataFrame) -> DataFrame:
    """Region codes normalised, then summed again: two spellings of a code become one row.

    The sums run on the codes first, so only totals meet the dimensions.
    """
    cleaned = staged.withColumn("region_code", F.upper(F.trim("region_code")))
    totals = cleaned.groupBy("txn_date", "region_code", "product_id", "channel_code", "txn_type").agg(
        F.sum("txn_count").alias("TxnCount"), F.sum(F.col("txn_value").cast(MONEY)).cast("decimal(28,2)").alias("TxnValue"))
    return (totals
            .join(regions.select(F.col("RegionCode").alias("region_code"), "RegionKey"), "region_code")
            .join(products.select(F.col("ProductID").alias("product_id"), "ProductKey"), "product_id")
            .join(channels.select(F.col("ChannelCode").alias("channel_code"), "ChannelKey"), "channel_code")
            .select(date_key("txn_date").alias("DateKey"), "RegionKey", "ProductKey", "ChannelKey",
                    F.col("txn_type").alias("TxnType"), "TxnCount", "TxnValue"))


def branch_activity(staged: DataFrame, branches: DataFrame) -> DataFrame:
    """Repeated rows of a branch and month collapse to their maxima."""
    one = staged.groupBy("branch_id", "month_end").agg(
        F.max("footfall").cast("bigint").alias("Footfall"), F.max("counter_txn_count").cast("bigint").alias("CounterTxnCount"),
        F.max("staff_fte").cast("decimal(5,1)").alias("StaffFTE"), F.max("is_closure_month").alias("IsClosureMonth"))
    keys = branches.select(F.col("BranchID").alias("branch_id"), "BranchKey", "RegionKey")
    return one.join(keys, "branch_id").select(
        date_key("month_end").alias("DateKey"), "BranchKey", "RegionKey", "Footfall", "CounterTxnCount", "StaffFTE",
        "IsClosureMonth")


def newest_delivery(staged: DataFrame, key: str) -> DataFrame:
    """One row per case: of the newest file that delivered it, as a load month by month would end with."""
    return keep_latest(staged, [key], "_source_file") if "_source_file" in staged.columns else keep_one(staged, [key])


def complaint_rows(staged: DataFrame, customers: DataFrame, categories: DataFrame) -> DataFrame:
    """One row per complaint; a resolution before receipt is removed and flagged.

    Such a row has no eight-week answer, yet it is not open: only a missing date in the source is.
    """
    ok = F.col("resolved_date") >= F.col("received_date")
    days = F.when(ok, days_between("received_date", "resolved_date"))
    rows = newest_delivery(staged, "complaint_id")
    return (rows
            .join(customers.select(F.col("CustomerID").alias("customer_id"), "CustomerKey", "RegionKey"), "customer_id")
            .join(categories.select(F.col("CategoryCode").alias("category_code"), "CategoryKey"), "category_code")
            .select(
                F.col("complaint_id").alias("ComplaintID"), "CustomerKey", "RegionKey", "CategoryKey",
                date_key(F.to_date("received_date")).alias("ReceivedDateKey"),
                F.when(ok, date_key(F.to_date("resolved_date"))).alias("ResolvedDateKey"),
                F.col("root_cause").alias("RootCause"), F.col("channel").alias("Channel"),
                F.col("upheld").alias("IsUpheld"), F.col("redress_amount").cast(MONEY).alias("RedressAmount"),
                F.col("referred_to_fos").alias("IsReferredToFOS"), days.alias("DaysToResolve"),
                (days <= EIGHT_WEEKS).alias("IsResolvedWithin8Weeks"), F.col("resolved_date").isNull().alias("IsOpen"),
                F.when(F.col("resolved_date") < F.col("received_date"),
                       "Resolved before received: date removed").alias("DQFlag")))


def fraud_rows(staged: DataFrame, customers: DataFrame, rule_start=SCAM_RULE_START) -> DataFrame:
    rows = newest_delivery(staged, "case_id")
    keys = customers.select(F.col("CustomerID").alias("customer_id"), "CustomerKey", "RegionKey")
    return rows.join(keys, "customer_id").select(
        F.col("case_id").alias("CaseID"), "CustomerKey", "RegionKey",
        date_key(F.to_date("reported_date")).alias("ReportedDateKey"), F.col("fraud_type").alias("FraudType"),
        F.col("channel").alias("Channel"), F.col("loss_amount").cast(MONEY).alias("LossAmount"),
        F.col("reimbursed_amount").cast(MONEY).alias("ReimbursedAmount"),
        F.col("recovered_amount").cast(MONEY).alias("RecoveredAmount"), F.col("case_status").alias("CaseStatus"),
        (F.to_date("reported_date") >= F.lit(rule_start)).alias("IsPostPSRRule"))


def budget_rows(staged: DataFrame, regions: DataFrame, products: DataFrame) -> DataFrame:
    totals = staged.groupBy("month_end", "region_code", "product_id").agg(
        *[F.sum(F.col(c).cast(MONEY)).alias(name) for c, name in [
            ("budget_balance", "BudgetBalance"), ("budget_nii", "BudgetNII"), ("budget_fees", "BudgetFees"),
            ("budget_impairment", "BudgetImpairment")]])
    return (totals
            .join(regions.select(F.col("RegionCode").alias("region_code"), "RegionKey"), "region_code")
            .join(products.select(F.col("ProductID").alias("product_id"), "ProductKey"), "product_id")
            .select(date_key("month_end").alias("DateKey"), "RegionKey", "ProductKey", "BudgetBalance", "BudgetNII",
                    "BudgetFees", "BudgetImpairment"))


def opex_rows(staged: DataFrame, regions: DataFrame) -> DataFrame:
    """The actual amount stays null in forecast months."""
    totals = staged.groupBy("month_end", "region_code", "cost_category").agg(
        F.sum(F.col("actual_amount").cast(MONEY)).alias("ActualAmount"),
        F.sum(F.col("budget_amount").cast(MONEY)).alias("BudgetAmount"))
    return totals.join(regions.select(F.col("RegionCode").alias("region_code"), "RegionKey"), "region_code").select(
        date_key("month_end").alias("DateKey"), "RegionKey", F.col("cost_category").alias("CostCategory"),
        "ActualAmount", "BudgetAmount")


def valid_rates(staged: DataFrame) -> DataFrame:
    """Parsed rows of one source only: the preferred one when it delivered anything."""
    source = staged.agg(F.min_by("source_system", F.struct(
        F.when(F.col("source_system") == PREFERRED_RATE_SOURCE, 0).otherwise(1), "source_system")).alias("s")).scalar()
    parsed = staged.filter(F.col("source_system") == source).select(
        parse_date("rate_date").alias("Date"), F.col("bank_rate").try_cast("decimal(5,2)").alias("BankRate"),
        "source_system")
    return parsed.dropna(subset=["Date", "BankRate"]).groupBy("Date").agg(
        F.max("BankRate").alias("BankRate"), F.max("source_system").alias("SourceSystem"))


def policy_rate_daily(staged: DataFrame, start=date(2020, 1, 1), check: bool = True) -> DataFrame:
    """Full calendar from `start` to the last observed day, gaps filled forward.

    Raises NoValidRate when nothing could be parsed (an empty result must not replace the table).
    """
    spark = staged.sparkSession
    rates = valid_rates(staged)
    # one aggregate answers all that is asked about the series
    known = rates.agg(F.struct(F.max("Date").alias("last"), F.min_by("BankRate", "Date").alias("first_rate"), F.max("SourceSystem").alias("tag")).alias("known"))
    if check:
        row = known.first()["known"]
        if row["last"] is None:
            raise NoValidRate("no valid rate rows in staging")
        last, first_rate, tag = (F.lit(row[c]) for c in ("last", "first_rate", "tag"))
    else:
        one = known.scalar()
        last, first_rate, tag = (one[c] for c in ("last", "first_rate", "tag"))
    joined = day_spine(spark, start, last).join(rates.select("Date", "BankRate"), "Date", "left")
    filled = forward_fill(joined, "Date", "BankRate", leading="none")
    return filled.select(date_key("Date").alias("DateKey"),
                         F.coalesce(F.col("BankRate"), first_rate).alias("BankRate"), tag.alias("SourceSystem"))


def with_customer(fact: DataFrame, customers: DataFrame, *attributes: str) -> DataFrame:
    """Conduct views: a case with attributes of its customer."""
    return fact.join(customers.select("CustomerKey", *attributes), "CustomerKey")
