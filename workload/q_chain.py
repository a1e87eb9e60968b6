"""The whole chain on issued keys: staged extracts, dimension loaders, facts, marts and measures; compared by text ids.

Every dimension is loaded by its loader and stored. Customers and accounts come in two deliveries, so that keys of the
first one are kept and new ones continue. No key in here follows from an id by arithmetic.
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from ledgerlake.plans import dimensions as dims, reports
from ledgerlake.plans.model import Context, evaluate
from ledgerlake.sources import tables
from .adapters import FIRST_DAY, LAST_ACTUAL, Extracts
from .q_marts import _PNL_SPARK, _PNL_SQL, div
from .registry import query, r, res, rs, work_folder
from .sql import CTES, LAST, cte


class Chain(Extracts):
    """The extracts with dimensions as the loaders leave them."""

    @cached_property
    def account_keys(self) -> DataFrame:
        return self._put("account_keys", super().account_keys)

    @cached_property
    def root(self) -> str:
        return work_folder(self.spark)

    def _put(self, name: str, df: DataFrame) -> DataFrame:
        return tables.full_reload(df, f"{self.root}/{name}")

    def _delivered(self, name: str, load, deliveries: list[DataFrame]) -> DataFrame:
        """Each delivery through its loader, which sees the table as the one before it left it.

        Nearly all rows change here, so the table is written as a whole; `q_refresh` merges by bucket.
        """
        found = None
        for rows in deliveries:
            found = self._put(name, load(rows, found))
        return found

    @cached_property
    def accounts(self) -> DataFrame:
        """Opened at the customer's branch, business loans without one; mortgages were delivered before, with other amounts."""
        home = self.t("customer").select(F.col("c_custkey").cast("string").alias("customer_id"),
                                         F.concat(F.lit("B"), F.col("c_nationkey").cast("string")).alias("home"))
        now = super().accounts.join(home, "customer_id").withColumn(
            "branch_id", F.when(F.col("product_id") != "P09", F.col("home"))).drop("home")
        # both deliveries of a mortgage from one row, so that the lines are read and summed once
        both = now.withColumn("before", F.explode(
            F.when(F.col("product_id") == "P04", F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
        other = {"original_amount": F.lit(1.0), "account_status": F.lit("Pending"), "_load_ts": F.lit(FIRST_DAY).cast("timestamp")}
        return both.withColumns({c: F.when(F.col("before"), v).otherwise(F.col(c)) for c, v in other.items()}).drop("before")

    @cached_property
    def dim_region(self) -> DataFrame:
        return self._put("dim_region", dims.region_dimension(self.regions))

    @cached_property
    def dim_product(self) -> DataFrame:
        return self._put("dim_product", dims.product_dimension(self.products))

    @cached_property
    def dim_channel(self) -> DataFrame:
        return self._put("dim_channel", dims.channel_dimension(self.channels))

    @cached_property
    def dim_category(self) -> DataFrame:
        return self._put("dim_category", dims.category_dimension(self.categories))

    @cached_property
    def dim_branch(self) -> DataFrame:
        return self._put("dim_branch", dims.branch_dimension(self.branches, self.dim_region, LAST_ACTUAL))

    @cached_property
    def dim_customer(self) -> DataFrame:
        """First the customers whose region is known, then all of them."""
        clean = self._put("customers", dims.clean_customers(self.customers))
        return self._delivered("dim_customer", lambda rows, known: dims.customer_dimension(
            rows, self.dim_region, self.dim_branch, LAST_ACTUAL, known), [clean.where("region_code_src IS NOT NULL"), clean])

    @property
    def dim_customer_full(self) -> DataFrame:
        return self.dim_customer

    @cached_property
    def dim_account(self) -> DataFrame:
        """First the deposits, then all accounts."""
        clean = self._put("accounts", dims.clean_accounts(self.accounts))
        return self._delivered("dim_account", lambda rows, known: dims.account_dimension(
            rows, self.dim_customer, self.dim_product, self.dim_branch, known), [clean.where("product_id < 'P04'"), clean])

    @property
    def account_numbers(self) -> DataFrame:
        return self.dim_account

    # -- facts, stored as a load leaves them: each is made once, and what reads it has a short plan
    @cached_property
    def deposits(self) -> DataFrame:
        return self._put("fact_deposit_balance", super().deposits)

    @cached_property
    def loans(self) -> DataFrame:
        return self._put("fact_loan_performance", super().loans)

    @cached_property
    def digital(self) -> DataFrame:
        return self._put("fact_digital", super().digital)

    @cached_property
    def transactions(self) -> DataFrame:
        return self._put("fact_transactions", super().transactions)

    @cached_property
    def complaints(self) -> DataFrame:
        return self._put("fact_complaints", super().complaints)

    @cached_property
    def budget(self) -> DataFrame:
        return self._put("fact_budget_monthly", super().budget)

    # -- text ids of issued keys -----------------------------------------------------------------
    def named(self, df: DataFrame, *keys: str) -> DataFrame:
        """`df` with the text ids that its keys stand for."""
        ids = {"RegionKey": (self.dim_region, "RegionCode"), "ProductKey": (self.dim_product, "ProductID"),
               "ChannelKey": (self.dim_channel, "ChannelCode"), "CategoryKey": (self.dim_category, "CategoryCode"),
               "CustomerKey": (self.dim_customer, "CustomerID")}
        for key in keys:
            table, name = ids[key]
            df = df.join(table.select(key, name), key)
        return df


# an order after the last actual month makes the customer's first order a future date, which the loader removes
cte("custm_loaded", CTES["custm"].replace("SELECT c.*, first_order,", f"SELECT c.*, CASE WHEN last_order <= {LAST} THEN first_order END AS first_order,"))


@query("chain_dimension_keys", """
SELECT 'customers' AS table_name, count(*) FILTER (c_acctbal >= 0) AS first_n, count(*) AS all_n, count(*) AS top_key, 0 AS moved FROM customer
UNION ALL SELECT 'accounts', count(*) FILTER (product_id < 'P04'), count(*), count(*), 0 FROM accounts_all""")
def chain_dimension_keys(x):
    """Keys are dense, rows of the first delivery hold the lowest ones, and none is issued twice."""
    c = Chain(x.spark, x.dir)
    known = c.dim_customer.join(c.t("customer").select(F.col("c_custkey").cast("string").alias("CustomerID"), "c_acctbal"), "CustomerID")
    products = c.dim_account.join(c.dim_product.select("ProductKey", "ProductID"), "ProductKey")
    out = None
    for name, df, key, early in (("customers", known, "CustomerKey", F.col("c_acctbal") >= 0), ("accounts", products, "AccountKey", F.col("ProductID") < "P04")):
        n = df.agg(F.count_if(early).alias("first_n"), F.count(F.lit(1)).alias("all_n"), F.max(key).alias("top_key"),
                   F.count_distinct(key).alias("keys"), F.max(F.when(early, F.col(key))).alias("early_top"))
        moved = F.col("all_n") - F.col("keys") + F.abs(F.col("early_top") - F.col("first_n"))
        n = n.select(F.lit(name).alias("table_name"), "first_n", "all_n", "top_key", moved.cast("int").alias("moved"))
        out = n if out is None else out.unionByName(n)
    return out


@query("chain_product_pnl", f"""
SELECT date_key, r.code AS region, product_id AS product, brand, sub_segment, accounts, {rs(*_PNL_SQL)} FROM pnl JOIN regions_named r USING (region_key)""")
def chain_product_pnl(x):
    c = Chain(x.spark, x.dir)
    d = c.named(c.model.tables["fact_product_monthly"], "RegionKey", "ProductKey")
    return res(d, date_key="DateKey", region="RegionCode", product="ProductID", brand="Brand", sub_segment="SubSegment", accounts="Accounts",
               **dict(zip(_PNL_SQL, _PNL_SPARK)))


@query("chain_credit_risk", f"""
SELECT date_key, r.code AS region, product_id AS product, score_band, ltv_band, CAST(stage AS INTEGER) AS stage, arrears_bucket, accounts, {rs('balance', 'ead', 'ecl', 'net_write_off', 'pd_x_ead')}
FROM risk JOIN regions_named r USING (region_key)""")
def chain_credit_risk(x):
    c = Chain(x.spark, x.dir)
    d = c.named(c.model.tables["fact_credit_risk_monthly"], "RegionKey", "ProductKey")
    return res(d, date_key="DateKey", region="RegionCode", product="ProductID", score_band="CreditScoreBand", ltv_band="LTVBand", stage="IFRS9Stage",
               arrears_bucket="ArrearsBucket", accounts="Accounts", balance="Balance", ead="EAD", ecl="ECL", net_write_off="NetWriteOff", pd_x_ead="PDxEAD")


@query("chain_customers", """
SELECT date_key, r.code AS region, segment, sub_segment, brand, age, active, new AS joined, churned, registered, mau, app_sessions, web_logins, features
FROM custm_loaded JOIN regions_named r USING (region_key)""")
def chain_customers(x):
    c = Chain(x.spark, x.dir)
    d = c.named(c.model.tables["fact_customer_monthly"], "RegionKey")
    return res(d, date_key="DateKey", region="RegionCode", segment="Segment", sub_segment="SubSegment", brand="Brand", age="AgeBand",
               active="ActiveCustomers", joined="NewCustomers", churned="ChurnedCustomers", registered="DigitalRegistered", mau="MonthlyActiveUsers",
               app_sessions="AppSessions", web_logins="WebLogins", features="FeaturesUsed")


@query("chain_transactions", f"""
SELECT month_end, r.code AS region, product_id AS product, channel_code AS channel, txn_type, txn_count, {rs('txn_value')} FROM txn_month JOIN regions_named r USING (region_key)""")
def chain_transactions(x):
    c = Chain(x.spark, x.dir)
    d = c.named(c.model.tables["fact_transactions_monthly"], "RegionKey", "ProductKey", "ChannelKey")
    month = F.to_date(F.col("DateKey").cast("string"), "yyyyMMdd").alias("month_end")
    return res(d.select(month, F.col("RegionCode").alias("region"), F.col("ProductID").alias("product"), F.col("ChannelCode").alias("channel"),
                        F.col("TxnType").alias("txn_type"), F.col("TxnCount").alias("txn_count"), F.col("TxnValue").alias("txn_value")))


@query("chain_complaints_by_branch", f"""
SELECT n_name AS branch, category_code AS category, count(*) AS complaints, {r('sum(redress)', 'redress')}
FROM complaint JOIN cust USING (customer_key) GROUP BY ALL""")
def chain_complaints_by_branch(x):
    """Complaints by the home branch of the customer."""
    c = Chain(x.spark, x.dir)
    homes = c.dim_customer.select("CustomerKey", F.col("HomeBranchKey").alias("BranchKey")).join(c.dim_branch.select("BranchKey", "BranchName"), "BranchKey")
    d = c.named(c.complaints, "CategoryKey").join(homes, "CustomerKey")
    return res(d.groupBy(F.col("BranchName").alias("branch"), F.col("CategoryCode").alias("category")).agg(
        F.count(F.lit(1)).alias("complaints"), F.sum("RedressAmount").alias("redress")))


@query("chain_accounts_by_branch", f"""
SELECT g.region_name, CASE WHEN product_id <> 'P09' THEN n_name END AS branch, product_id AS product, count(*) AS accounts, {r('sum(amount)', 'original_amount')}, min(open_date) AS first_opened
FROM accounts_all a JOIN cust c ON c.c_custkey = a.o_custkey LEFT JOIN regions_named g ON g.region_key = c.region_key AND product_id <> 'P09' GROUP BY ALL""")
def chain_accounts_by_branch(x):
    """Accounts by the region of their branch (account, branch, region); business loans have no branch."""
    c = Chain(x.spark, x.dir)
    places = c.dim_branch.select("BranchKey", "BranchName", "RegionKey").join(c.dim_region.select("RegionKey", "RegionName"), "RegionKey").drop("RegionKey")
    d = c.named(c.dim_account, "ProductKey").join(places, "BranchKey", "left")
    return res(d.groupBy(F.col("RegionName").alias("region_name"), F.col("BranchName").alias("branch"), F.col("ProductID").alias("product")).agg(
        F.count(F.lit(1)).alias("accounts"), F.sum("OriginalAmount").alias("original_amount"), F.min("OpenDate").alias("first_opened")))


@query("chain_vintage", f"""
SELECT vintage_quarter, months_on_book, loans, {rs('original_amount')}, defaulted_loans, {rs('defaulted_amount')} FROM vintage""")
def chain_vintage(x):
    return res(Chain(x.spark, x.dir).model.tables["fact_bbl_vintage"], vintage_quarter="VintageQuarter", months_on_book="MonthsOnBook", loans="Loans",
               original_amount="OriginalAmount", defaulted_loans="DefaultedLoans", defaulted_amount="DefaultedAmount")


@query("chain_report", f"""
SELECT p.y AS year_no, g.region_name, {r('nii', 'nii')}, {r('b_nii', 'nii_budget')}, {r('dep', 'deposits')}, {r(div('a90', 'loan'), 'arrears90_rate')}, n AS complaints
FROM (SELECT years.y, region_key, sum(interest_income - ftp_charge + ftp_credit - interest_expense) FILTER (year(month_end) = years.y) AS nii,
        sum(eom_balance) FILTER (month_end = pe AND product_id < 'P04') AS dep, sum(eom_balance) FILTER (month_end = pe AND product_id >= 'P04') AS loan,
        sum(a90) FILTER (month_end = pe) AS a90 FROM years JOIN pnl ON year(month_end) = years.y GROUP BY ALL) p
JOIN regions_named g USING (region_key)
LEFT JOIN (SELECT year(month_end) AS y, region_key, sum(b_nii) AS b_nii FROM budget WHERE month_end <= {LAST} GROUP BY ALL) b USING (y, region_key)
LEFT JOIN (SELECT year(received) AS y, region_key, count(*) AS n FROM complaint GROUP BY ALL) k USING (y, region_key)""")
def chain_report(x):
    """Measures of four marts in one report."""
    d = evaluate(Chain(x.spark, x.dir).model, Context(), [reports.YEAR, reports.REGION], ["NII", "NII Budget", "Customer Deposits", "Arrears 90+ Rate", "Complaints"])
    return res(d, year_no="Year", region_name="RegionName", nii="NII", nii_budget="NII Budget", deposits="Customer Deposits",
               arrears90_rate="Arrears 90+ Rate", complaints="Complaints")
