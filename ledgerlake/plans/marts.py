"""Aggregate marts over the gold facts."""
from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..functions.amounts import MONEY, TOTAL, TOTAL4
from ..functions.bands import current_ltv_band, rate_band
from ..functions.dates import date_key, key_date, month_end, quarter_label_of_key
from ..operators.groups import stack_aggregates
from ..operators.lookup import previous_period
from ..operators.series import active_over_time, month_end_spine

PNL_KEYS = ["DateKey", "RegionKey", "ProductKey", "Brand", "SubSegment"]


def _total(c, t=TOTAL):
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c).cast(t)


def _when_total(cond, c):
    return F.sum(F.when(cond, F.col(c)).otherwise(F.lit(0).cast(MONEY))).cast(TOTAL)


def product_pnl(deposits: DataFrame, loans: DataFrame, customers: DataFrame) -> DataFrame:
    """Month x region x product x brand x sub-segment.

    Deposits count every row, loans only open accounts. Each side is aggregated on its own and the
    two small results are stacked and summed.
    """
    who = customers.select("CustomerKey", "Brand", "SubSegment")
    dep = deposits.join(who, "CustomerKey").groupBy(*PNL_KEYS).agg(
        F.count(F.lit(1)).alias("Accounts"), _total("AvgBalance").alias("AvgBalance"),
        _total("EOMBalance").alias("EOMBalance"), _total("InterestExpense").alias("InterestExpense"),
        _total("FTPCredit").alias("FTPCredit"), _total("FeeIncome").alias("FeeIncome"),
        _total(F.col("CustomerRate") * F.col("AvgBalance"), TOTAL4).alias("RateXBalance"))
    stage = F.col("IFRS9Stage")
    loan = loans.join(who, "CustomerKey").groupBy(*PNL_KEYS).agg(
        F.count_if(F.col("AccountStatus") == "Open").alias("Accounts"),
        _total("BalanceEOM").alias("AvgBalance"), _total("BalanceEOM").alias("EOMBalance"),
        _total("InterestIncome").alias("InterestIncome"), _total("FTPCharge").alias("FTPCharge"),
        _total("FeeIncome").alias("FeeIncome"), _total("NewLendingAmount").alias("NewLending"),
        _total("WriteOffAmount").alias("WriteOff"), _total("GuaranteeClaimAmount").alias("GuaranteeClaim"),
        _total("ECL").alias("ECL"), _when_total(stage == 1, "BalanceEOM").alias("Stage1Balance"),
        _when_total(stage == 2, "BalanceEOM").alias("Stage2Balance"),
        _when_total(stage == 3, "BalanceEOM").alias("Stage3Balance"),
        _when_total(F.col("DaysPastDue") >= 30, "BalanceEOM").alias("Arrears30Balance"),
        _when_total(F.col("ArrearsBucket") == "90+", "BalanceEOM").alias("Arrears90Balance"),
        _when_total(F.col("IsPaymentHoliday"), "BalanceEOM").alias("PaymentHolidayBalance"),
        _total(F.coalesce(F.col("CreditLimit"), F.lit(0).cast(MONEY))).alias("CreditLimit"),
        _total(F.col("CustomerRate") * F.col("BalanceEOM"), TOTAL4).alias("RateXBalance"))
    stacked = stack_aggregates([dep, loan], PNL_KEYS)
    money = ["AvgBalance", "EOMBalance", "InterestIncome", "InterestExpense", "FTPCredit", "FTPCharge", "FeeIncome",
             "NewLending", "WriteOff", "GuaranteeClaim", "ECL", "Stage1Balance", "Stage2Balance", "Stage3Balance",
             "Arrears30Balance", "Arrears90Balance", "PaymentHolidayBalance", "CreditLimit"]
    return stacked.select(*PNL_KEYS, F.col("Accounts").cast("bigint").alias("Accounts"),
                          *[F.col(m).cast(TOTAL).alias(m) for m in money],
                          F.col("RateXBalance").cast(TOTAL4).alias("RateXBalance"))


def credit_risk(loans: DataFrame, customers: DataFrame) -> DataFrame:
    """Month x region x product x score band x LTV band x stage x bucket, open or written off."""
    rows = loans.filter((F.col("AccountStatus") == "Open") | (F.col("WriteOffAmount") > 0))
    rows = rows.join(customers.select("CustomerKey", "CreditScoreBand"), "CustomerKey")
    rows = rows.withColumn("LTVBand", current_ltv_band("CurrentLTV"))
    return rows.groupBy("DateKey", "RegionKey", "ProductKey", "CreditScoreBand", "LTVBand", "IFRS9Stage",
                        "ArrearsBucket").agg(
        F.count(F.lit(1)).alias("Accounts"), _total("BalanceEOM").alias("Balance"), _total("EAD").alias("EAD"),
        _total("ECL").alias("ECL"), _total(F.col("WriteOffAmount") - F.col("GuaranteeClaimAmount")).alias("NetWriteOff"),
        _total(F.col("PD12m") * F.col("EAD"), TOTAL4).alias("PDxEAD"))


def mortgage_maturity(loans: DataFrame, products: DataFrame, last_actual, mortgage: str = "P04") -> DataFrame:
    """Fixed deals still open at the last actual month, by the month they end.

    The snapshot filter is on the fact's partition column: one month is read.
    """
    key = date_key(F.lit(last_actual))
    mine = products.filter(F.col("ProductID") == mortgage).select("ProductKey")
    rows = loans.filter((F.col("DateKey") == key) & (F.col("AccountStatus") == "Open")
                        & F.col("DealEndDateKey").isNotNull()).join(mine, "ProductKey")
    return rows.groupBy(
        quarter_label_of_key("DealEndDateKey").alias("DealEndQuarter"), F.col("DealEndDateKey").alias("DealEndMonthKey"),
        "RegionKey", "RateType", rate_band("CustomerRate").alias("CurrentRateBand")).agg(
        F.count(F.lit(1)).alias("Accounts"), _total("BalanceEOM").alias("Balance"),
        _total(F.col("CustomerRate") * F.col("BalanceEOM"), TOTAL4).alias("RateXBalance"),
        _total("ScheduledPayment").alias("MonthlyPayment"))


def repricing_events(loans: DataFrame, products: DataFrame, mortgage: str = "P04", months=None) -> DataFrame:
    """Each repriced open mortgage with its rate and payment of the month before.

    Only mortgages are shuffled, on both sides. `months` limits the events, not the months they are compared with.
    """
    mine = loans.join(products.filter(F.col("ProductID") == mortgage).select("ProductKey"), "ProductKey", "left_semi")
    events = mine.filter((F.col("IsProductTransfer") | F.col("IsDealMaturity")) & (F.col("AccountStatus") == "Open"))
    if months is not None:
        events = events.filter(F.col("DateKey").isin(sorted(months)))
    events = events.select("DateKey", "AccountKey", "RegionKey", "RateType", "CustomerRate", "ScheduledPayment",
                           "BalanceEOM", date_key(month_end(key_date("DateKey"), -1)).alias("PrevKey"))
    before = mine.filter(F.col("ScheduledPayment") > 0).select("DateKey", "AccountKey", "CustomerRate", "ScheduledPayment")
    return previous_period(events, before, "AccountKey", "DateKey", "PrevKey", ["CustomerRate", "ScheduledPayment"])


def mortgage_repricing(loans: DataFrame, products: DataFrame, mortgage: str = "P04", months=None) -> DataFrame:
    """Old against new rate and payment, month x region x new rate type."""
    e = repricing_events(loans, products, mortgage, months)
    return e.groupBy("DateKey", "RegionKey", F.col("RateType").alias("NewRateType")).agg(
        F.count(F.lit(1)).alias("Repricings"), _total("BalanceEOM").alias("Balance"),
        _total(F.col("OldCustomerRate") * F.col("BalanceEOM"), TOTAL4).alias("OldRateXBalance"),
        _total(F.col("CustomerRate") * F.col("BalanceEOM"), TOTAL4).alias("NewRateXBalance"),
        _total("OldScheduledPayment").alias("OldPayment"), _total("ScheduledPayment").alias("NewPayment"))


def loan_vintage(accounts: DataFrame, loans: DataFrame, products: DataFrame, last_actual,
                 product: str = "P09") -> DataFrame:
    """Cumulative default by vintage quarter and months on book, only observable points.

    Accounts are first summed per (vintage, open month, default month); the months-on-book spine
    multiplies that small table, never the accounts, and needs no range join.
    """
    mine = products.filter(F.col("ProductID") == product).select("ProductKey")
    defaults = (loans.filter((F.col("ArrearsBucket") == "90+") | (F.col("AccountStatus") == "Written Off"))
                .join(mine, "ProductKey").groupBy("AccountKey").agg(F.min("DateKey").alias("DefaultKey")))
    opened = accounts.join(mine, "ProductKey").select(
        "AccountKey", "VintageQuarter", F.last_day("OpenDate").alias("OpenMonth"), "OriginalAmount")
    cells = opened.join(defaults, "AccountKey", "left").groupBy(
        "VintageQuarter", "OpenMonth", key_date("DefaultKey").alias("DefaultMonth")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("OriginalAmount").alias("amount"))
    # from opening to the last actual month end, however long that is
    reached = cells.filter(F.col("OpenMonth") <= F.lit(last_actual))
    whole = F.floor(F.months_between(F.last_day(F.date_add(F.lit(last_actual).cast("date"), 1)), "OpenMonth")).cast("int")
    spread = reached.withColumn("MonthsOnBook", F.explode(F.sequence(F.lit(0), whole)))
    at = month_end("OpenMonth", F.col("MonthsOnBook"))
    hit = F.col("DefaultMonth") <= at
    return spread.filter(at <= F.lit(last_actual)).groupBy("VintageQuarter", "MonthsOnBook").agg(
        F.sum("n").alias("Loans"), _total("amount").alias("OriginalAmount"),
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("DefaultedLoans"),
        F.sum(F.when(hit, F.col("amount")).otherwise(F.lit(0).cast(MONEY))).cast(TOTAL).alias("DefaultedAmount"))


CUSTOMER_GROUP = ["RegionKey", "Segment", "SubSegment", "Brand", "AgeBand"]


def customer_monthly(customers: DataFrame, digital: DataFrame, start, last_actual) -> DataFrame:
    """Active, new and churned customers and their digital use, month x group.

    A customer is active from the month end of joining up to, and without, that of leaving. Instead
    of pairing customers with months, joiners and leavers are summed per group and month and the
    active count is their running sum.
    """
    spark = customers.sparkSession
    first = F.last_day(F.lit(start).cast("date"))
    last = F.last_day(F.lit(last_actual).cast("date"))
    grouped = customers.withColumn("AgeBand", F.coalesce("AgeBand", F.lit("SME")))
    joined = F.last_day("OnboardingDate")
    left = F.last_day("ChurnDate")
    from_month = F.greatest(F.coalesce(joined, first), first)
    change = grouped.select(*CUSTOMER_GROUP, F.explode(F.array(
        # one entry per change of a customer: active from, active until, joined, left
        F.struct(from_month.alias("Date"), F.when(left.isNull() | (from_month < left), 1).otherwise(0).alias("active"),
                 F.lit(0).alias("new"), F.lit(0).alias("churned")),
        F.struct(left.alias("Date"), F.when(from_month < left, -1).otherwise(0).alias("active"),
                 F.lit(0).alias("new"), F.when(left >= first, 1).otherwise(0).alias("churned")),
        F.struct(joined.alias("Date"), F.lit(0).alias("active"),
                 F.when(joined >= first, 1).otherwise(0).alias("new"), F.lit(0).alias("churned")),
    )).alias("c")).select(*CUSTOMER_GROUP, "c.*")
    # every group keeps at least its first-month row, so a group without changes still appears
    inside = F.col("Date").between(first, last)
    moved = change.withColumn("Date", F.when(inside, F.col("Date")).otherwise(first)).withColumns(
        {m: F.when(inside, F.col(m)).otherwise(0) for m in ("active", "new", "churned")})
    per_month = moved.groupBy(*CUSTOMER_GROUP, "Date").agg(
        *[F.sum(m).alias(m) for m in ("active", "new", "churned")])
    spine = month_end_spine(spark, start, last_actual)
    base = active_over_time(per_month, spine, CUSTOMER_GROUP, "Date", "active", "ActiveCustomers").select(
        date_key("Date").alias("DateKey"), *CUSTOMER_GROUP, "ActiveCustomers",
        F.coalesce("new", F.lit(0)).cast("bigint").alias("NewCustomers"),
        F.coalesce("churned", F.lit(0)).cast("bigint").alias("ChurnedCustomers"))
    who = grouped.select("CustomerKey", "Segment", "SubSegment", "Brand", "AgeBand")
    use = digital.join(who, "CustomerKey").groupBy("DateKey", *CUSTOMER_GROUP).agg(
        F.count(F.lit(1)).alias("DigitalRegistered"), F.count_if("IsMonthlyActive").alias("MonthlyActiveUsers"),
        F.sum("AppSessions").alias("AppSessions"), F.sum("WebLogins").alias("WebLogins"),
        F.sum("FeaturesUsed").alias("FeaturesUsed"))
    metrics = ["DigitalRegistered", "MonthlyActiveUsers", "AppSessions", "WebLogins", "FeaturesUsed"]
    out = base.join(use, ["DateKey", *CUSTOMER_GROUP], "left")
    return out.withColumns({m: F.coalesce(F.col(m), F.lit(0)).cast("bigint") for m in metrics})


def transactions_monthly(transactions: DataFrame) -> DataFrame:
    """Month x region x product x channel x type."""
    month_key = date_key(F.last_day(key_date("DateKey")))
    return transactions.groupBy(month_key.alias("DateKey"), "RegionKey", "ProductKey", "ChannelKey", "TxnType").agg(
        F.sum("TxnCount").cast("bigint").alias("TxnCount"), _total("TxnValue").alias("TxnValue"))


DEFAULT_START = date(2020, 1, 31)
