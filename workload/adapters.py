"""The banking extracts, derived by rule from the driver's order tables.

Every lineitem is a monthly balance row of the account (customer, product type); orders are cost and
fraud rows; events are digital and branch activity. Amounts are computed as decimals and staged as
doubles with two places, so both engines see the same numbers. `sql.py` states the same rules in SQL.
"""
from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlake.functions.bands import arrears_bucket
from ledgerlake.functions.dates import date_key
from ledgerlake.plans import dimensions as dims, facts, marts
from ledgerlake.plans.measures import build_registry, flag_next_year
from ledgerlake.plans.model import Model

FIRST_DAY = date(1995, 1, 1)
FIRST_MONTH, LAST_ACTUAL = date(1995, 1, 31), date(2001, 7, 31)
RULE_START = date(1998, 6, 1)
# type -> (id, group, segment, secured, guaranteed)
PRODUCTS = {
    "STANDARD": ("P01", "Deposits", "Personal", False, False),
    "SMALL": ("P02", "Deposits", "Personal", False, False),
    "MEDIUM": ("P03", "Deposits", "Personal", False, False),
    "ECONOMY": ("P04", "Lending", "Personal", True, False),
    "LARGE": ("P05", "Lending", "Personal", False, False),
    "PROMO": ("P09", "Lending", "SME", False, True),
}
PRODUCT_IDS = [v[0] for v in PRODUCTS.values()]
CHANNELS = {"click": "CH02", "view": "CH03", "purchase": "CH01", "signup": "CH05", "error": "CH06"}
MONEY = "decimal(18,2)"


def pick(c: str, mapping: dict) -> Column:
    out = None
    for key, value in mapping.items():
        out = F.when(F.col(c) == key, F.lit(value)) if out is None else out.when(F.col(c) == key, F.lit(value))
    return out


def dec(c, t: str = "decimal(12,2)") -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(t)


def as_double(c: Column) -> Column:
    return c.cast(MONEY).cast("double")


def account_ids() -> dict[str, Column]:
    """Text ids of the account (customer, product) and its customer."""
    customer = F.col("o_custkey").cast("string")
    return {"account_id": F.concat_ws("-", customer, F.col("product_id")), "customer_id": customer}


class Extracts:
    """Staged extracts and the gold tables and marts made from them, each built when first used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self.tables: dict[str, DataFrame] = {}

    def t(self, name: str) -> DataFrame:
        """A driver table, as it is; how it is split is left to Spark."""
        if name not in self.tables:
            self.tables[name] = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        return self.tables[name]

    # -- building blocks -----------------------------------------------------------------------
    @cached_property
    def base(self) -> DataFrame:
        """One row per lineitem with its customer, product, dates and exact decimals."""
        return self.lines(self.t("orders"))

    def lines(self, orders: DataFrame, *extra: str) -> DataFrame:
        """Lineitems of some orders, with `extra` columns of the orders.

        The part comes first: who asks for some products has fewer rows to shuffle by order.
        """
        li = self.t("lineitem").select(
            "l_orderkey", "l_partkey", "l_linenumber", dec("l_quantity").alias("qty"),
            dec("l_extendedprice").alias("price"), dec("l_discount", "decimal(4,2)").alias("disc"),
            dec("l_tax", "decimal(4,2)").alias("tax"), "l_returnflag", "l_linestatus",
            F.col("l_shipdate").cast("date").alias("ship_date"))
        o = orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_date"), *extra)
        p = self.t("part").select("p_partkey", pick("p_type", {k: v[0] for k, v in PRODUCTS.items()}).alias("product_id"))
        joined = li.join(p, F.col("l_partkey") == F.col("p_partkey")).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        return joined.withColumns({"month_end": F.last_day("order_date"), **account_ids()})

    @cached_property
    def customer_region(self) -> DataFrame:
        """Customer with nation and region names."""
        n = self.t("nation").join(self.t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return self.t("customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))

    def score_band(self) -> Column:
        c = F.col("c_acctbal")
        return (F.when(c < 0, "Very Poor").when(c < 2500, "Poor").when(c < 5000, "Fair").when(c < 7500, "Good")
                .otherwise("Excellent"))

    def segment(self) -> Column:
        return F.when(F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD", "FURNITURE"), "Personal").otherwise("SME")

    def brand(self) -> Column:
        return F.concat(F.lit("Brand "), (F.col("c_nationkey") % 3).cast("string"))

    def age_band(self) -> Column:
        c = F.col("c_acctbal")
        age = F.when(c < 2000, "18-34").when(c < 5000, "35-54").otherwise("55+")
        return F.when(self.segment() == "Personal", age)

    # -- staged extracts -----------------------------------------------------------------------
    @cached_property
    def regions(self) -> DataFrame:
        return self.t("region").select(
            F.col("r_name").alias("region_code"), F.initcap("r_name").alias("region_name"), F.lit("World").alias("nation"),
            F.concat(F.lit("Director "), F.col("r_regionkey").cast("string")).alias("regional_director"),
            F.concat(F.lit("director"), F.col("r_regionkey").cast("string"), F.lit("@bank.example")).alias("director_email"))

    @cached_property
    def products(self) -> DataFrame:
        def column(i: int) -> Column:
            return pick("p_type", {k: v[i] for k, v in PRODUCTS.items()})
        return self.t("part").select("p_type").distinct().select(
            column(0).alias("product_id"), F.col("p_type").alias("product_name"), column(1).alias("product_group"),
            column(2).alias("segment"), column(3).alias("is_secured"), column(4).alias("is_government_guaranteed"))

    @cached_property
    def channels(self) -> DataFrame:
        return self.t("events").select("event_type").distinct().select(
            pick("event_type", CHANNELS).alias("channel_code"), F.col("event_type").alias("channel_name"))

    @cached_property
    def categories(self) -> DataFrame:
        return self.t("part").select("p_type").distinct().select(
            pick("p_type", {k: v[0] for k, v in PRODUCTS.items()}).alias("category_code"),
            F.col("p_type").alias("category_name"),
            pick("p_type", {k: v[1] for k, v in PRODUCTS.items()}).alias("fca_product_group"))

    @cached_property
    def branches(self) -> DataFrame:
        n = self.t("nation").join(self.t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return n.select(
            F.concat(F.lit("B"), F.col("n_nationkey").cast("string")).alias("branch_id"), F.col("n_name").alias("branch_name"),
            F.concat(F.lit("Brand "), (F.col("n_nationkey") % 3).cast("string")).alias("brand"),
            F.lower("r_name").alias("region_code"), F.col("n_name").alias("city"),
            (F.col("n_nationkey") * 1.5 + 40).cast("double").alias("latitude"),
            (F.col("n_nationkey") * 0.5 - 6).cast("double").alias("longitude"), F.lit("Full").alias("branch_format"),
            F.lit(FIRST_DAY).cast("timestamp").alias("open_date"),
            F.when(F.col("n_nationkey") >= 20, F.lit(date(2001, 3, 31)))
             .when(F.col("n_nationkey") >= 18, F.lit(date(2001, 10, 31))).cast("timestamp").alias("closure_date"))

    @cached_property
    def lifecycle(self) -> DataFrame:
        """First and last order of each customer."""
        return self.t("orders").groupBy("o_custkey").agg(
            F.min("o_orderdate").cast("date").alias("first_order"), F.max("o_orderdate").cast("date").alias("last_order"))

    @cached_property
    def customers(self) -> DataFrame:
        """Two extracts: an older one of every customer, and the current one with its defects."""
        seen = self.t("events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.min("ts").alias("first_event"))
        joined = (self.customer_region.join(self.lifecycle, F.col("c_custkey") == F.col("o_custkey"), "left")
                  .join(seen, "c_custkey", "left"))
        spaced = F.concat(F.char(65 + F.col("c_nationkey")), (F.col("c_custkey") % 9 + 1).cast("string"), F.lit(" "),
                          (F.col("c_custkey") % 10).cast("string"), F.lit("AB"))
        messy = F.lower(F.regexp_replace(spaced, " ", ""))
        bal = F.col("c_acctbal")
        late = F.col("last_order") > F.lit(LAST_ACTUAL)
        current = joined.select(
            F.col("c_custkey").cast("string").alias("customer_id"), self.segment().alias("segment"),
            F.col("c_mktsegment").alias("sub_segment"), self.brand().alias("brand"),
            F.when(bal >= 0, F.when(bal > 9000, F.lower("r_name")).otherwise(F.col("r_name"))).alias("region_code"),
            F.col("n_name").alias("city"), F.when(bal > 8000, messy).otherwise(spaced).alias("postcode_sector"),
            self.age_band().alias("age_band"), F.lit(None).cast("string").alias("income_band"),
            F.lit(None).cast("string").alias("industry"), F.lit(None).cast("string").alias("turnover_band"),
            self.score_band().alias("credit_score_band"),
            F.when(late, F.date_add("first_order", 3650)).otherwise(F.col("first_order")).cast("timestamp").alias("onboarding_date"),
            F.lit("Branch").alias("onboarding_channel"), F.col("first_event").cast("timestamp").alias("digital_registration_date"),
            F.concat(F.lit("B"), F.col("c_nationkey").cast("string")).alias("home_branch_id"),
            F.when(F.col("last_order") < F.lit(date(2001, 1, 1)), F.col("last_order")).cast("timestamp").alias("churn_date"),
            F.lit("Active").alias("customer_status"), F.lit(LAST_ACTUAL).cast("timestamp").alias("_load_ts"))
        older = current.withColumns({"sub_segment": F.lit("OLD"), "_load_ts": F.lit(FIRST_DAY).cast("timestamp")})
        return current.unionByName(older)

    @cached_property
    def accounts(self) -> DataFrame:
        # by the two numbers that make up the text ids
        g = self.base.groupBy("o_custkey", "product_id").agg(
            F.min("order_date").alias("open"), F.max("price").alias("amount"), F.max("disc").alias("disc")).withColumns(account_ids())
        return g.select(
            "account_id", "customer_id", "product_id", F.lit(None).cast("string").alias("branch_id"),
            F.col("open").cast("timestamp").alias("open_date"), F.lit(None).cast("timestamp").alias("close_date"),
            F.lit("Open").alias("account_status"), F.col("amount").cast("double").alias("original_amount"),
            F.lit(240.0).alias("term_months"), (F.col("disc") * 100).cast("double").alias("origination_rate"),
            F.when(F.col("product_id") == "P04", F.col("disc") * 10).cast("double").alias("origination_ltv"),
            F.lit(LAST_ACTUAL).cast("timestamp").alias("_load_ts"))

    @cached_property
    def deposit_rows(self) -> DataFrame:
        b = self.base.filter(F.col("product_id").isin("P01", "P02", "P03"))
        price, wrong = F.col("price"), (F.col("l_returnflag") == "R") & (F.col("qty") == 13)
        return b.select(
            "account_id", "month_end", "product_id",
            as_double(F.when(wrong, -price).otherwise(price)).alias("avg_balance"),
            as_double(price * (1 - F.col("disc"))).alias("eom_balance"),
            (F.col("disc") * 100).cast("double").alias("customer_rate"), (F.col("tax") * 100).cast("double").alias("ftp_rate"),
            as_double(price * F.col("disc") * F.lit("0.08").cast("decimal(4,2)")).alias("interest_expense"),
            as_double(price * F.col("tax") * F.lit("0.08").cast("decimal(4,2)")).alias("ftp_credit"),
            as_double(F.col("qty")).alias("fee_income"))

    @cached_property
    def loan_rows(self) -> DataFrame:
        b = self.base.filter(F.col("product_id").isin("P04", "P05", "P09")).withColumn(
            "dpd", F.greatest(F.abs(F.datediff("ship_date", "order_date")) % 130 - 20, F.lit(0)).cast("bigint"))
        price, eight = F.col("price"), F.lit("0.08").cast("decimal(4,2)")
        mortgage, written = F.col("product_id") == "P04", (F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "R")
        months = F.when(F.col("l_linenumber") % 2 == 1, 24).otherwise(60)
        zero = F.lit(0).cast(MONEY)
        stage = F.when(F.col("qty") == 13, None).when(F.col("dpd") >= 90, 3.0).when(
            (F.col("dpd") >= 30) | (F.col("tax") >= F.lit("0.06").cast("decimal(4,2)")), 2.0).otherwise(1.0)
        ead = (price * F.lit("1.1").cast("decimal(2,1)")).cast(MONEY)
        return b.select(
            "account_id", "month_end", "product_id",
            F.when(F.col("l_linenumber") % 2 == 1, "2y Fixed").otherwise("5y Fixed").alias("rate_type"),
            as_double(price).alias("balance_eom"),
            F.when(F.col("product_id") == "P05", as_double(price * F.lit("1.2").cast("decimal(2,1)"))).alias("credit_limit"),
            (F.col("disc") * 100).cast("double").alias("customer_rate"), (F.col("tax") * 100).cast("double").alias("ftp_rate"),
            as_double(price * F.col("disc") * eight).alias("interest_income"),
            as_double(price * F.col("tax") * eight).alias("ftp_charge"), as_double(F.col("qty")).alias("fee_income"),
            as_double(price * F.lit("0.01").cast("decimal(4,2)")).alias("scheduled_payment"),
            F.col("dpd").alias("days_past_due"), arrears_bucket("dpd").alias("arrears_bucket"), stage.alias("ifrs9_stage"),
            F.col("tax").cast("double").alias("pd_12m"), F.lit(0.5).alias("lgd"), ead.cast("double").alias("ead"),
            as_double(ead * F.col("tax") * F.lit("0.5").cast("decimal(2,1)")).alias("ecl"),
            as_double(F.when(written, price).otherwise(zero)).alias("write_off_amount"),
            as_double(F.when(written & (F.col("product_id") == "P09"), price).otherwise(zero)).alias("guarantee_claim_amount"),
            (F.col("qty") >= 48).alias("is_payment_holiday"),
            F.when(mortgage, F.last_day(F.add_months("order_date", months))).alias("deal_end_date"),
            (F.col("l_returnflag") == "N").alias("is_deal_maturity"), (F.col("l_returnflag") == "A").alias("is_product_transfer"),
            F.when(mortgage, (F.col("disc") * 10).cast("double")).alias("current_ltv"),
            as_double(F.when(F.col("l_linenumber") == 1, price).otherwise(zero)).alias("new_lending_amount"),
            F.when(F.col("l_linestatus") == "O", "Open").when(written, "Written Off").otherwise("Closed").alias("account_status"))

    @cached_property
    def flow(self) -> DataFrame:
        """Events with their customer's region; each event day stands for one month from 1999-01 on."""
        e = self.t("events").withColumns({
            "month_start": F.add_months(F.lit(date(1999, 1, 1)), F.dayofmonth("ts") - 1), "amount": dec("value", MONEY)})
        c = self.customer_region.select("c_custkey", "c_nationkey", "r_name")
        return e.join(c, F.col("user_id") == F.col("c_custkey")).withColumn("month_end", F.last_day("month_start"))

    @cached_property
    def digital_rows(self) -> DataFrame:
        kind = F.col("event_type")
        return self.flow.groupBy(F.col("user_id").cast("string").alias("customer_id"), "month_end").agg(
            F.count_if(kind == "view").alias("web_logins"), F.count_if(kind == "click").alias("app_sessions"),
            (F.count_if(kind.isin("click", "purchase")) > 0).alias("is_monthly_active"),
            F.count_distinct("event_type").alias("features_used"))

    @cached_property
    def transaction_rows(self) -> DataFrame:
        v = F.col("amount")
        return self.flow.select(
            F.date_add("month_start", F.hour("ts")).alias("txn_date"),
            F.when(v > 100, F.lower("r_name")).otherwise(F.col("r_name")).alias("region_code"),
            F.when(v < 5, "P01").when(v < 20, "P02").otherwise("P03").alias("product_id"),
            pick("event_type", CHANNELS).alias("channel_code"),
            F.when(F.col("event_type").isin("purchase", "click"), "Payment").otherwise("Service").alias("txn_type"),
            F.lit(1).cast("bigint").alias("txn_count"), v.cast("double").alias("txn_value"))

    @cached_property
    def branch_rows(self) -> DataFrame:
        return self.flow.select(
            F.concat(F.lit("B"), F.col("c_nationkey").cast("string")).alias("branch_id"), "month_end",
            F.floor(F.col("amount") * 10).cast("bigint").alias("footfall"), F.hour("ts").cast("bigint").alias("counter_txn_count"),
            F.col("amount").cast("decimal(10,0)").cast("double").alias("staff_fte"),
            ((F.col("event_type") == "error") & (F.col("amount") > 150)).alias("is_closure_month"))

    @cached_property
    def complaint_stage(self) -> DataFrame:
        still = (F.col("l_linestatus") == "O") & (F.col("qty") > 45)
        path = F.concat(F.lit("conduct/complaints/"), F.date_format("ship_date", "'year='yyyy'/month='MM"), F.lit("/part.parquet"))
        return self.base.select(
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("complaint_id"),
            "customer_id", F.col("order_date").cast("timestamp").alias("received_date"),
            F.when(~still, F.col("ship_date")).cast("timestamp").alias("resolved_date"),
            F.col("product_id").alias("category_code"), F.col("l_returnflag").alias("root_cause"),
            F.col("l_linestatus").alias("channel"), (F.col("l_returnflag") == "A").alias("upheld"),
            as_double(F.col("price") * F.lit("0.01").cast("decimal(4,2)")).alias("redress_amount"),
            (F.col("tax") >= F.lit("0.07").cast("decimal(4,2)")).alias("referred_to_fos"), path.alias("_source_file"))

    @cached_property
    def fraud_stage(self) -> DataFrame:
        loss = (dec("o_totalprice") * F.lit("0.01").cast("decimal(4,2)")).cast(MONEY)
        back = F.when(F.col("o_orderstatus") == "F", "0.60").when(F.col("o_orderstatus") == "O", "0.90").otherwise("0.00")
        return self.t("orders").select(
            F.col("o_orderkey").cast("string").alias("case_id"), F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("o_orderdate").cast("timestamp").alias("reported_date"),
            pick("o_orderpriority", {"1-URGENT": "APP Scam", "2-HIGH": "Card Fraud"}).alias("t"),
            F.col("o_orderstatus").alias("channel"), loss.cast("double").alias("loss_amount"),
            as_double(loss * back.cast("decimal(4,2)")).alias("reimbursed_amount"),
            as_double(loss * F.lit("0.1").cast("decimal(2,1)")).alias("recovered_amount"),
            F.col("o_orderstatus").alias("case_status")).withColumn("fraud_type", F.coalesce("t", F.lit("Other"))).drop("t")

    @cached_property
    def rate_stage(self) -> DataFrame:
        """Text rates in three date notations and some rubbish; every order is one, its priority the source."""
        d = F.col("o_orderdate").cast("date")
        text = (F.when(F.col("o_totalprice") < 5000, "n/a").when(F.dayofmonth(d) < 10, F.date_format(d, "dd MMM yyyy"))
                .when(F.dayofmonth(d) < 20, F.date_format(d, "yyyy-MM-dd"))
                .otherwise(F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T00:00:00"))))
        return self.t("orders").select(
            text.alias("rate_date"), dec(F.floor(F.col("o_totalprice") / 1000) / 100, "decimal(6,2)").cast("string").alias("bank_rate"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "BoE API").otherwise(F.col("o_orderpriority")).alias("source_system"))

    @cached_property
    def budget_stage(self) -> DataFrame:
        c = self.customer_region.select("c_custkey", "r_name")
        # the region goes to the orders, which are fewer than their lines
        placed = self.t("orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
        return self.budgets(self.lines(placed, "r_name"))

    def budgets(self, lines: DataFrame) -> DataFrame:
        """Budget rows of lines with their region."""
        def part(c: str, f: str) -> Column:
            return as_double(F.col(c) * F.lit(f).cast("decimal(5,3)"))
        return lines.select(
            F.col("r_name").alias("region_code"), "month_end", "product_id", part("price", "1.020").alias("budget_balance"),
            part("price", "0.004").alias("budget_nii"), part("qty", "1.050").alias("budget_fees"),
            part("price", "0.001").alias("budget_impairment"))

    @cached_property
    def opex_stage(self) -> DataFrame:
        month = F.last_day(F.col("o_orderdate").cast("date"))
        c = self.customer_region.select("c_custkey", "r_name")
        o = self.t("orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
        total = dec("o_totalprice")
        return o.select(
            F.col("r_name").alias("region_code"), month.alias("month_end"), F.col("o_orderpriority").alias("cost_category"),
            F.when(month <= F.lit(LAST_ACTUAL), as_double(total * F.lit("0.001").cast("decimal(5,3)"))).alias("actual_amount"),
            as_double(total * F.lit("0.002").cast("decimal(5,3)")).alias("budget_amount"))

    # -- gold: dimensions as they stand after earlier loads, facts through the loaders ---------
    @cached_property
    def dim_date(self) -> DataFrame:
        first, last = self.calendar_years
        return dims.date_view(dims.date_dimension(self.spark, None, first, last, LAST_ACTUAL))

    @cached_property
    def calendar_years(self) -> tuple[date, date]:
        """Whole years from the first to the last day that an order or a line carries."""
        days = self.t("orders").select(F.col("o_orderdate").cast("date").alias("d")).unionByName(
            self.t("lineitem").select(F.col("l_shipdate").cast("date").alias("d")))
        low, high = days.agg(F.min("d"), F.max("d")).first()
        return (low or FIRST_DAY).replace(month=1, day=1), (high or FIRST_DAY).replace(month=12, day=31)

    @cached_property
    def dim_region(self) -> DataFrame:
        return self.t("region").select(
            (F.col("r_regionkey") + 1).alias("RegionKey"), F.col("r_name").alias("RegionCode"),
            F.initcap("r_name").alias("RegionName"), F.lit("World").alias("Nation"),
            F.concat(F.lit("Director "), F.col("r_regionkey").cast("string")).alias("RegionalDirector"),
            F.concat(F.lit("director"), F.col("r_regionkey").cast("string"), F.lit("@bank.example")).alias("DirectorEmail"))

    @cached_property
    def dim_product(self) -> DataFrame:
        return self.products.select(
            F.right("product_id", F.lit(2)).cast("int").alias("ProductKey"), F.col("product_id").alias("ProductID"),
            F.col("product_name").alias("ProductName"), F.col("product_group").alias("ProductGroup"),
            F.col("segment").alias("Segment"), F.right("product_id", F.lit(2)).cast("int").alias("SortOrder"))

    @cached_property
    def dim_channel(self) -> DataFrame:
        return self.channels.select(
            F.right("channel_code", F.lit(2)).cast("int").alias("ChannelKey"), F.col("channel_code").alias("ChannelCode"),
            F.col("channel_name").alias("ChannelName"), dims.channel_group("channel_code").alias("ChannelGroup"))

    @cached_property
    def dim_category(self) -> DataFrame:
        return self.categories.select(
            F.right("category_code", F.lit(2)).cast("int").alias("CategoryKey"), F.col("category_code").alias("CategoryCode"),
            F.col("category_name").alias("CategoryName"), F.col("fca_product_group").alias("FCAProductGroup"))

    @cached_property
    def dim_branch(self) -> DataFrame:
        return self.branches.join(self.dim_region.select(F.lower("RegionCode").alias("region_code"), "RegionKey"), "region_code").select(
            F.expr("cast(substring(branch_id, 2) as int) + 1").alias("BranchKey"), F.col("branch_id").alias("BranchID"),
            F.col("branch_name").alias("BranchName"), F.col("brand").alias("Brand"), "RegionKey", F.col("city").alias("City"),
            F.col("latitude").alias("Latitude"), F.col("longitude").alias("Longitude"),
            F.to_date("closure_date").alias("ClosureDate"),
            F.when(F.col("closure_date").isNull() | (F.col("closure_date") > F.lit(LAST_ACTUAL)), "Open")
             .otherwise("Closed").alias("BranchStatus"))

    @cached_property
    def dim_customer(self) -> DataFrame:
        """Attributes that need no order history."""
        return self.customer_region.select(
            (F.col("c_custkey") + 1).alias("CustomerKey"), F.col("c_custkey").cast("string").alias("CustomerID"),
            self.segment().alias("Segment"), F.col("c_mktsegment").alias("SubSegment"), self.brand().alias("Brand"),
            (F.col("n_regionkey") + 1).alias("RegionKey"), self.age_band().alias("AgeBand"),
            self.score_band().alias("CreditScoreBand"))

    @cached_property
    def dim_customer_full(self) -> DataFrame:
        life = self.lifecycle.select(
            (F.col("o_custkey") + 1).alias("CustomerKey"), F.col("first_order").alias("OnboardingDate"),
            F.when(F.col("last_order") < F.lit(date(2001, 1, 1)), F.col("last_order")).alias("ChurnDate"))
        return self.dim_customer.join(life, "CustomerKey", "left")

    @cached_property
    def account_numbers(self) -> DataFrame:
        """Account numbers as issued: each customer has one per product, used or not.

        Customers are dealt by key before they are multiplied: their file is one task's split up to millions of them, and
        the joins by CustomerKey that follow need that shuffle anyway.
        """
        ids = F.explode(F.array(*[F.lit(p) for p in PRODUCT_IDS])).alias("product_id")
        c = self.t("customer").select("c_custkey", (F.col("c_custkey") + 1).alias("CustomerKey")).repartition("CustomerKey")
        product = F.right("product_id", F.lit(2)).cast("int")
        return c.select("c_custkey", "CustomerKey", ids).select(
            (F.col("CustomerKey") * 100 + product).alias("AccountKey"),
            F.concat_ws("-", F.col("c_custkey").cast("string"), F.col("product_id")).alias("AccountID"),
            "CustomerKey", product.alias("ProductKey"))

    @cached_property
    def dim_account(self) -> DataFrame:
        """Accounts in use, with what their first rows tell about them."""
        a = self.accounts
        product = F.right("product_id", F.lit(2)).cast("int")
        customer = F.col("customer_id").cast("bigint") + 1
        return a.select(
            (customer * 100 + product).alias("AccountKey"), F.col("account_id").alias("AccountID"),
            customer.alias("CustomerKey"), product.alias("ProductKey"), F.to_date("open_date").alias("OpenDate"),
            F.col("original_amount").cast(MONEY).alias("OriginalAmount"),
            F.concat(F.year("open_date").cast("string"), F.lit(" Q"), F.quarter("open_date").cast("string")).alias("VintageQuarter"))

    @cached_property
    def account_keys(self) -> DataFrame:
        return facts.account_keys(self.account_numbers, self.dim_customer)

    @cached_property
    def deposits(self) -> DataFrame:
        return facts.deposit_balances(self.deposit_rows, self.account_keys)

    @cached_property
    def loans(self) -> DataFrame:
        return facts.loan_performance(self.loan_rows, self.account_keys)

    @cached_property
    def digital(self) -> DataFrame:
        return facts.digital_activity(self.digital_rows, self.dim_customer)

    @cached_property
    def transactions(self) -> DataFrame:
        return facts.daily_transactions(self.transaction_rows, self.dim_region, self.dim_product, self.dim_channel)

    @cached_property
    def branch_activity(self) -> DataFrame:
        return facts.branch_activity(self.branch_rows, self.dim_branch)

    @cached_property
    def complaints(self) -> DataFrame:
        return facts.complaint_rows(self.complaint_stage, self.dim_customer, self.dim_category)

    @cached_property
    def fraud(self) -> DataFrame:
        return facts.fraud_rows(self.fraud_stage, self.dim_customer, RULE_START)

    @cached_property
    def budget(self) -> DataFrame:
        return facts.budget_rows(self.budget_stage, self.dim_region, self.dim_product)

    @cached_property
    def opex(self) -> DataFrame:
        return facts.opex_rows(self.opex_stage, self.dim_region)

    @cached_property
    def rate(self) -> DataFrame:
        return facts.policy_rate_daily(self.rate_stage, FIRST_DAY, check=False)

    # -- marts and model -----------------------------------------------------------------------
    @cached_property
    def model(self) -> Model:
        makers = {
            "dim_date": lambda: self.dim_date, "all_dates": lambda: self.dim_date, "dim_region": lambda: self.dim_region,
            "dim_product": lambda: self.dim_product, "dim_channel": lambda: self.dim_channel,
            "dim_complaint_category": lambda: self.dim_category, "dim_branch": lambda: self.dim_branch,
            "dim_segment": lambda: self.dim_customer.select("Segment").distinct(),
            "dim_brand": lambda: self.dim_customer.select("Brand").distinct(),
            "dim_score_band": lambda: self.spark.createDataFrame(dims.SCORE_BANDS, "CreditScoreBand string, ScoreOrder int"),
            "bridge_steps": lambda: self.spark.createDataFrame(dims.BRIDGE_STEPS, "Step string, `Order` int"),
            "fact_product_monthly": lambda: marts.product_pnl(self.deposits, self.loans, self.dim_customer),
            "fact_credit_risk_monthly": lambda: marts.credit_risk(self.loans, self.dim_customer),
            "fact_mortgage_maturity": lambda: flag_next_year(
                marts.mortgage_maturity(self.loans, self.dim_product, LAST_ACTUAL), LAST_ACTUAL),
            "fact_mortgage_repricing": lambda: marts.mortgage_repricing(self.loans, self.dim_product),
            "fact_bbl_vintage": lambda: marts.loan_vintage(self.dim_account, self.loans, self.dim_product, LAST_ACTUAL),
            "fact_customer_monthly": lambda: marts.customer_monthly(self.dim_customer_full, self.digital, FIRST_MONTH, LAST_ACTUAL),
            "fact_transactions_monthly": lambda: marts.transactions_monthly(self.transactions),
            "fact_branch_monthly": lambda: self.branch_activity,
            "fact_complaint": lambda: facts.with_customer(self.complaints, self.dim_customer, "Segment", "Brand"),
            "fact_fraud_case": lambda: facts.with_customer(self.fraud, self.dim_customer, "Segment", "Brand", "AgeBand"),
            "fact_budget_monthly": lambda: self.budget, "fact_opex_monthly": lambda: self.opex,
            "fact_bank_rate_daily": lambda: self.rate,
        }
        return Model(_Lazy(makers), LAST_ACTUAL, build_registry(), index_base=date(1999, 1, 31))


class _Lazy(dict):
    """Tables built when first asked for."""

    def __init__(self, makers):
        super().__init__()
        self._makers = makers

    def __missing__(self, key):
        self[key] = self._makers[key]()
        return self[key]
