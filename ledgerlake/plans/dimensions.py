"""Dimension builders: staging rows in, conformed dimension with stable integer keys out."""
from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.bands import origination_ltv_band, tenure_band
from ..functions.dates import (date_key, month_end, month_start, quarter_label, weekday_number)
from ..functions.text import (clean_code, join_flags, postcode_area, postcode_sector, postcode_standard,
                              postcode_was_dirty)
from ..operators.dedupe import keep_latest, keep_one
from ..operators.groups import most_frequent
from ..operators.keys import upsert_dimension
from ..operators.series import day_spine

LAST_ACTUAL = date(2026, 8, 31)

# Channel code to group; all other codes are 'Automated'.
CHANNEL_GROUPS = {"Digital": ["CH02", "CH03"], "Branch and Phone": ["CH01", "CH04"], "ATM": ["CH05"]}
BRIDGE_STEPS = [("Prior year NII", 1), ("Volume", 2), ("Margin", 3), ("Other", 4)]
SCORE_BANDS = [("Very Poor", 1), ("Poor", 2), ("Fair", 3), ("Good", 4), ("Excellent", 5)]


def dates_with_flags(spine: DataFrame, last_actual, holidays: DataFrame | None = None) -> DataFrame:
    """The 19 calendar columns for a spine with a Date column."""
    d = F.col("Date")
    if holidays is None:
        marked = spine.withColumn("__holiday", F.lit(False))
    else:
        days = holidays.select(F.col("holiday_date").alias("Date")).distinct()
        marked = spine.join(days.withColumn("__holiday", F.lit(True)), "Date", "left")
    holiday = F.coalesce(F.col("__holiday"), F.lit(False))
    weekend = weekday_number(d) >= 6
    return marked.select(
        date_key(d).alias("DateKey"), "Date", F.year(d).alias("Year"), F.quarter(d).alias("Quarter"),
        quarter_label(d).alias("QuarterLabel"), F.month(d).alias("Month"),
        F.date_format(d, "MMMM").alias("MonthName"), F.date_format(d, "MMM").alias("MonthShort"),
        F.date_format(d, "yyyy-MM").alias("YearMonth"), month_start(d).alias("MonthStart"),
        month_end(d).alias("MonthEnd"), (d == F.last_day(d)).alias("IsMonthEnd"),
        F.dayofmonth(d).alias("DayOfMonth"), weekday_number(d).alias("DayOfWeekNum"),
        F.date_format(d, "EEEE").alias("DayName"), weekend.alias("IsWeekend"), holiday.alias("IsUKBankHoliday"),
        (~weekend & ~holiday).alias("IsWorkingDay"), (d <= F.lit(last_actual)).alias("IsActualPeriod"),
    )


def date_dimension(spark: SparkSession, holidays: DataFrame | None = None, start=date(2019, 1, 1),
                   end=date(2027, 12, 31), last_actual=LAST_ACTUAL) -> DataFrame:
    return dates_with_flags(day_spine(spark, start, end), last_actual, holidays)


def date_view(dim_date: DataFrame, start=None, end=None) -> DataFrame:
    """The report calendar with the month-end key: the whole calendar, or a stretch of it that a report asks for."""
    if start is not None:
        dim_date = dim_date.filter(F.col("Date") >= F.lit(start))
    if end is not None:
        dim_date = dim_date.filter(F.col("Date") <= F.lit(end))
    return dim_date.withColumn("MonthEndKey", date_key("MonthEnd"))


def region_dimension(staged: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    source = staged.select(
        F.col("region_code").alias("RegionCode"), F.col("region_name").alias("RegionName"),
        F.col("nation").alias("Nation"), F.col("regional_director").alias("RegionalDirector"),
        F.col("director_email").alias("DirectorEmail")).distinct()
    return upsert_dimension(existing, source, "RegionCode", "RegionKey")


def product_dimension(staged: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    source = staged.select(
        F.col("product_id").alias("ProductID"), F.col("product_name").alias("ProductName"),
        F.col("product_group").alias("ProductGroup"), F.col("segment").alias("Segment"),
        F.col("is_secured").alias("IsSecured"), F.col("is_government_guaranteed").alias("IsGovernmentGuaranteed"),
        F.right("product_id", F.lit(2)).try_cast("int").alias("SortOrder")).distinct()
    return upsert_dimension(existing, source, "ProductID", "ProductKey")


def channel_group(code):
    out = None
    for group, codes in CHANNEL_GROUPS.items():
        cond = F.col(code).isin(*codes)
        out = F.when(cond, group) if out is None else out.when(cond, group)
    return out.otherwise("Automated")


def channel_dimension(staged: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    source = staged.select(
        F.col("channel_code").alias("ChannelCode"), F.col("channel_name").alias("ChannelName"),
        channel_group("channel_code").alias("ChannelGroup")).distinct()
    return upsert_dimension(existing, source, "ChannelCode", "ChannelKey")


def category_dimension(staged: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    source = staged.select(
        F.col("category_code").alias("CategoryCode"), F.col("category_name").alias("CategoryName"),
        F.col("fca_product_group").alias("FCAProductGroup")).distinct()
    return upsert_dimension(existing, source, "CategoryCode", "CategoryKey")


def branch_dimension(staged: DataFrame, regions: DataFrame, last_actual=LAST_ACTUAL,
                     existing: DataFrame | None = None) -> DataFrame:
    one = keep_one(staged, ["branch_id"]).withColumn("RegionCode", F.upper("region_code"))
    closure = F.to_date("closure_date")
    source = one.join(regions.select("RegionCode", "RegionKey"), "RegionCode").select(
        F.col("branch_id").alias("BranchID"), F.col("branch_name").alias("BranchName"), F.col("brand").alias("Brand"),
        "RegionKey", F.col("city").alias("City"), F.col("latitude").cast("decimal(9,5)").alias("Latitude"),
        F.col("longitude").cast("decimal(9,5)").alias("Longitude"), F.col("branch_format").alias("BranchFormat"),
        F.to_date("open_date").alias("OpenDate"), closure.alias("ClosureDate"),
        F.when(closure.isNull() | (closure > F.lit(last_actual)), "Open").otherwise("Closed").alias("BranchStatus"))
    return upsert_dimension(existing, source, "BranchID", "BranchKey")


def clean_customers(staged: DataFrame) -> DataFrame:
    """Newest row per customer, codes and postcodes repaired, timestamps as dates."""
    one = keep_latest(staged, ["customer_id"], "_load_ts")
    passed = ["customer_id", "segment", "sub_segment", "brand", "city", "age_band", "income_band", "industry",
              "turnover_band", "credit_score_band", "onboarding_channel", "home_branch_id", "customer_status"]
    return one.select(
        *passed, clean_code("region_code").alias("region_code_src"),
        postcode_standard("postcode_sector").alias("postcode"),
        postcode_area("postcode_sector").alias("postcode_area"),
        postcode_was_dirty("postcode_sector").alias("pc_fixed"),
        F.to_date("onboarding_date").alias("onboarding_date_src"),
        F.to_date("digital_registration_date").alias("digital_registration_date"),
        F.to_date("churn_date").alias("churn_date"))


def area_region_map(customers: DataFrame) -> DataFrame:
    """Region learned per postcode area: the most frequent one."""
    return most_frequent(customers, "postcode_area", "region_code_src", "mapped_region")


def customer_dimension(customers: DataFrame, regions: DataFrame, branches: DataFrame | None = None,
                       last_actual=LAST_ACTUAL, existing: DataFrame | None = None) -> DataFrame:
    """`customers` as given by clean_customers."""
    future = F.coalesce(F.col("onboarding_date_src") > F.lit(last_actual), F.lit(False))
    onboarded = F.when(~future, F.col("onboarding_date_src"))
    mapped = customers.join(area_region_map(customers), "postcode_area", "left").withColumn(
        "RegionCode", F.coalesce("region_code_src", "mapped_region"))
    joined = mapped.join(regions.select("RegionCode", "RegionKey"), "RegionCode")
    if branches is None:
        joined = joined.withColumn("HomeBranchKey", F.lit(None).cast("bigint"))
    else:
        homes = branches.select(F.col("BranchID").alias("home_branch_id"), F.col("BranchKey").alias("HomeBranchKey"))
        joined = joined.join(homes, "home_branch_id", "left")
    source = joined.select(
        F.col("customer_id").alias("CustomerID"), F.col("segment").alias("Segment"),
        F.col("sub_segment").alias("SubSegment"), F.col("brand").alias("Brand"), "RegionKey",
        F.col("city").alias("City"), postcode_sector("postcode").alias("PostcodeSector"),
        F.col("postcode_area").alias("PostcodeArea"), F.col("age_band").alias("AgeBand"),
        F.col("income_band").alias("IncomeBand"), F.col("industry").alias("Industry"),
        F.col("turnover_band").alias("TurnoverBand"), F.col("credit_score_band").alias("CreditScoreBand"),
        onboarded.alias("OnboardingDate"), F.year(onboarded).alias("OnboardingYear"),
        F.col("onboarding_channel").alias("OnboardingChannel"),
        F.col("digital_registration_date").alias("DigitalRegistrationDate"),
        F.col("digital_registration_date").isNotNull().alias("IsDigitallyRegistered"), "HomeBranchKey",
        F.col("churn_date").alias("ChurnDate"), F.col("customer_status").alias("CustomerStatus"),
        tenure_band(onboarded, F.lit(last_actual)).alias("TenureBand"),
        join_flags(F.when(F.col("region_code_src").isNull(), "Region derived from postcode"),
                   F.when(future, "Future onboarding date removed")).alias("DQFlag"))
    return upsert_dimension(existing, source, "CustomerID", "CustomerKey")


def clean_accounts(staged: DataFrame) -> DataFrame:
    return keep_latest(staged, ["account_id"], "_load_ts").withColumns(
        {"open_date": F.to_date("open_date"), "close_date": F.to_date("close_date")})


def account_dimension(accounts: DataFrame, customers: DataFrame, products: DataFrame,
                      branches: DataFrame | None = None, existing: DataFrame | None = None) -> DataFrame:
    """`accounts` as given by clean_accounts."""
    joined = (accounts
              .join(customers.select(F.col("CustomerID").alias("customer_id"), "CustomerKey"), "customer_id")
              .join(products.select(F.col("ProductID").alias("product_id"), "ProductKey"), "product_id"))
    if branches is None:
        joined = joined.withColumn("BranchKey", F.lit(None).cast("bigint"))
    else:
        joined = joined.join(branches.select(F.col("BranchID").alias("branch_id"), "BranchKey"), "branch_id", "left")
    source = joined.select(
        F.col("account_id").alias("AccountID"), "CustomerKey", "ProductKey", "BranchKey",
        F.col("open_date").alias("OpenDate"), F.col("close_date").alias("CloseDate"),
        F.col("account_status").alias("AccountStatus"),
        F.col("original_amount").cast("decimal(18,2)").alias("OriginalAmount"),
        F.col("term_months").cast("int").alias("TermMonths"),
        F.col("origination_rate").cast("decimal(7,4)").alias("OriginationRate"),
        F.col("origination_ltv").cast("decimal(7,4)").alias("OriginationLTV"),
        origination_ltv_band("origination_ltv").alias("OriginationLTVBand"),
        F.year("open_date").alias("VintageYear"), quarter_label("open_date").alias("VintageQuarter"))
    return upsert_dimension(existing, source, "AccountID", "AccountKey")


def static_dimensions(spark: SparkSession, customers: DataFrame) -> dict[str, DataFrame]:
    """Small fixed dimensions; segments and brands are those of the customers."""
    return {
        "dim_segment": customers.select("Segment").distinct(),
        "dim_brand": customers.select("Brand").distinct(),
        "bridge_steps": spark.createDataFrame(BRIDGE_STEPS, "Step string, `Order` int"),
        "dim_score_band": spark.createDataFrame(SCORE_BANDS, "CreditScoreBand string, ScoreOrder int"),
    }
