"""Queries over the load: calendar, rate, dedupe, checks, keys, dimensions, facts, load control."""
from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ledgerlake.functions.dates import date_key, key_date
from ledgerlake.operators.dedupe import keep_latest, keep_one
from ledgerlake.operators.groups import most_frequent
from ledgerlake.operators.keys import assign_keys, number_rows
from ledgerlake.operators.lookup import split_hot_lookup
from ledgerlake.plans import dimensions as dims, facts, finance, quality
from ledgerlake.sources import control, tables
from .adapters import LAST_ACTUAL
from .registry import query, r, res, rs, work_folder
from .sql import KEY, LAST

# ---------------------------------------------------------------- calendar and rate


@query("date_dim_flags", f"""
SELECT {KEY.format('d')} AS date_key, d AS date_value, CAST(year(d) AS INTEGER) AS year_no, CAST(quarter(d) AS INTEGER) AS quarter_no,
  concat(year(d), ' Q', quarter(d)) AS quarter_label, CAST(month(d) AS INTEGER) AS month_no, monthname(d) AS month_name,
  left(monthname(d), 3) AS month_short, strftime(d, '%Y-%m') AS year_month, CAST(date_trunc('month', d) AS DATE) AS month_start,
  last_day(d) AS month_end, d = last_day(d) AS is_month_end, CAST(day(d) AS INTEGER) AS day_of_month,
  CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend, h.d2 IS NOT NULL AS is_holiday,
  isodow(d) < 6 AND h.d2 IS NULL AS is_working_day, d <= {LAST} AS is_actual
FROM (SELECT CAST(unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS DATE) AS d) s
LEFT JOIN (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d2 FROM orders WHERE o_totalprice > 490000) h ON h.d2 = d""")
def date_dim_flags(x):
    o = x.t("orders")
    ends = o.agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    spine = ends.select(F.explode(F.sequence("a", "b")).alias("Date"))
    holidays = o.filter(F.col("o_totalprice") > 490000).select(F.col("o_orderdate").cast("date").alias("holiday_date"))
    d = dims.dates_with_flags(spine, LAST_ACTUAL, holidays)
    return res(d, date_key="DateKey", date_value="Date", year_no="Year", quarter_no="Quarter", quarter_label="QuarterLabel",
               month_no="Month", month_name="MonthName", month_short="MonthShort", year_month="YearMonth",
               month_start="MonthStart", month_end="MonthEnd", is_month_end="IsMonthEnd", day_of_month="DayOfMonth",
               day_of_week="DayOfWeekNum", day_name="DayName", is_weekend="IsWeekend", is_holiday="IsUKBankHoliday",
               is_working_day="IsWorkingDay", is_actual="IsActualPeriod")


@query("rate_parse_formats", f"SELECT d AS rate_date, {r('r', 'rate')} FROM rate_seen")
def rate_parse_formats(x):
    return res(facts.valid_rates(x.rate_stage), rate_date="Date", rate="BankRate")


@query("rate_forward_fill", f"SELECT date_key, {rs('rate')}, 'BoE API' AS source_system FROM rate")
def rate_forward_fill(x):
    return res(x.rate, date_key="DateKey", rate="BankRate", source_system="SourceSystem")


def _monthly_rate(x):
    return finance.monthly_mean_rate(x.rate.withColumn("Date", key_date("DateKey")))


@query("rate_monthly_mean", f"SELECT last_day(d) AS month_end, {r('avg(rate::DOUBLE)', 'rate')} FROM rate GROUP BY 1")
def rate_monthly_mean(x):
    return res(_monthly_rate(x))


@query("hedge_trailing_mean", f"""
SELECT month_end, {rs('rate_ahead')},
  {r('(sum(rate_ahead) OVER w + (60 - count(*) OVER w) * 1.30) / 60', 'hedge')}
FROM (SELECT month_end, COALESCE(lead(rt, 6) OVER (ORDER BY month_end), last_value(rt) OVER (ORDER BY month_end
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS rate_ahead
      FROM (SELECT last_day(d) AS month_end, avg(rate::DOUBLE) AS rt FROM rate GROUP BY 1) m) a
WINDOW w AS (ORDER BY month_end ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)""")
def hedge_trailing_mean(x):
    return res(finance.hedge_yield(_monthly_rate(x)), month_end="month_end", rate_ahead="rate_ahead", hedge="hedge")


# ---------------------------------------------------------------- dedupe

_LINE = ["l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_quantity", "l_returnflag"]


@query("dedupe_latest", """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date, l_extendedprice, l_quantity, l_returnflag
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice, l_quantity,
        l_returnflag) AS rn FROM lineitem) s WHERE rn = 1""")
def dedupe_latest(x):
    rows = keep_latest(x.t("lineitem").select(*_LINE), ["l_orderkey", "l_linenumber"], "l_shipdate")
    return rows.withColumn("ship_date", F.col("l_shipdate").cast("date")).drop("l_shipdate")


@query("dedupe_any", """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date, l_extendedprice, l_quantity, l_returnflag
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice, l_quantity, l_returnflag,
        l_shipdate) AS rn FROM lineitem) s WHERE rn = 1""")
def dedupe_any(x):
    rows = keep_one(x.t("lineitem").select(*_LINE), ["l_orderkey", "l_linenumber"])
    return rows.withColumn("ship_date", F.col("l_shipdate").cast("date")).drop("l_shipdate")


# ---------------------------------------------------------------- data-quality checks


@query("dq_duplicates", """
SELECT month_end, sum(n - 1)::BIGINT AS affected, sum(n)::BIGINT AS total
FROM (SELECT account_id, month_end, count(*) AS n FROM dep_stage GROUP BY ALL) g GROUP BY month_end""")
def dq_duplicates(x):
    return quality.duplicates(x.deposit_rows, ["account_id"], "month_end")


@query("dq_null_impute", """
SELECT month_end, count(*) FILTER (ifrs9_stage IS NULL) AS affected, count(*) AS total FROM loan_stage GROUP BY month_end""")
def dq_null_impute(x):
    return quality.missing(x.loan_rows, "ifrs9_stage", "month_end")


@query("dq_sign_repair", """
SELECT month_end, count(*) FILTER (avg_balance < 0 AND product_id IN ('P02','P03')) AS affected, count(*) AS total
FROM dep_stage GROUP BY month_end""")
def dq_sign_repair(x):
    return quality.negative_savings(x.deposit_rows, facts.SAVINGS_PRODUCTS)


@query("dq_customer_checks", f"""
SELECT 'duplicates' AS check_name, count(*) AS affected, 2 * count(*) AS total FROM cust
UNION ALL SELECT 'missing region', count(*) FILTER (c_acctbal < 0), count(*) FROM cust
UNION ALL SELECT 'dirty postcode', count(*) FILTER (c_acctbal > 8000), count(*) FROM cust
UNION ALL SELECT 'future date', count(*) FILTER (last_order > {LAST}), count(*) FROM cust LEFT JOIN life ON o_custkey = c_custkey""")
def dq_customer_checks(x):
    clean = dims.clean_customers(x.customers)
    checks = {"duplicates": quality.duplicates(x.customers, ["customer_id"]),
              "missing region": quality.missing(clean, "region_code_src"), "dirty postcode": quality.dirty_postcodes(clean),
              "future date": quality.future_dates(clean, "onboarding_date_src", LAST_ACTUAL)}
    out = None
    for name, df in checks.items():
        row = df.select(F.lit(name).alias("check_name"), F.col("affected").cast("bigint").alias("affected"),
                        F.col("total").cast("bigint").alias("total"))
        out = row if out is None else out.unionByName(row)
    return out


@query("dq_key_case", """
SELECT count(*) FILTER (amount > 100) AS affected, count(*) AS total FROM flow_rows""")
def dq_key_case(x):
    return quality.lower_case_codes(x.transaction_rows, "region_code")


@query("dq_resolved_before_received", """
SELECT count(*) FILTER (resolved < received) AS affected, count(*) AS total FROM complaint_stage""")
def dq_resolved_before_received(x):
    return quality.resolved_before_received(x.complaint_stage)


@query("dq_late_arrival", """
SELECT count(*) FILTER (last_day(received) < date_trunc('month', ship_date)) AS affected, count(*) AS total FROM complaint_stage""")
def dq_late_arrival(x):
    return quality.late_arrivals(x.complaint_stage)


@query("dq_orphans", """
SELECT last_day(CAST(o_orderdate AS DATE)) AS month_end, count(*) FILTER (c_custkey IS NULL) AS affected, count(*) AS total
FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) c ON c_custkey = o_custkey GROUP BY 1""")
def dq_orphans(x):
    """Customers with a negative balance stand for those missing from the dimension."""
    o = x.t("orders").select(F.col("o_custkey").alias("k"), F.last_day(F.col("o_orderdate").cast("date")).alias("month_end"))
    known = x.t("customer").filter("c_acctbal >= 0").select(F.col("c_custkey").alias("k"))
    return quality.orphans(o, known, "k", "month_end")


@query("dq_postcode", """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, concat(chr(65 + c_nationkey), c_custkey % 9 + 1, ' ', c_custkey % 10, 'AB') AS postcode,
  concat(chr(65 + c_nationkey), c_custkey % 9 + 1, ' ', c_custkey % 10) AS sector, chr(65 + c_nationkey) AS area,
  c_acctbal > 8000 AS was_dirty FROM customer""")
def dq_postcode(x):
    from ledgerlake.functions.text import postcode_sector
    clean = dims.clean_customers(x.customers)
    return clean.select("customer_id", "postcode", postcode_sector("postcode").alias("sector"),
                        F.col("postcode_area").alias("area"), F.col("pc_fixed").alias("was_dirty"))


# ---------------------------------------------------------------- keys and dimensions

_MD5 = "substr(md5({0}), 1, 3), {0}"


@query("learned_mode_map", """
SELECT c_nationkey, c_mktsegment AS segment FROM (SELECT c_nationkey, c_mktsegment,
  row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, c_mktsegment) AS rn FROM customer GROUP BY 1, 2) s WHERE rn = 1""")
def learned_mode_map(x):
    return most_frequent(x.t("customer"), "c_nationkey", "c_mktsegment", "segment")


@query("scd1_upsert", """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
  CASE WHEN c_acctbal < 5000 THEN c_mktsegment ELSE 'OLD' END AS sub_segment FROM customer""")
def scd1_upsert(x):
    """Target: the older extract of customers without debt; source: the current one of lower balances, merged into its buckets."""
    bal = x.t("customer").select(F.col("c_custkey").cast("string").alias("customer_id"), "c_acctbal")
    rows = x.customers.select("customer_id", "sub_segment").join(bal, "customer_id")
    target = rows.filter("sub_segment = 'OLD' and c_acctbal >= 0").drop("c_acctbal")
    source = rows.filter("sub_segment <> 'OLD' and c_acctbal < 5000").drop("c_acctbal")
    path = f"{work_folder(x.spark)}/customers"
    tables.merge(target, path, ["customer_id"])
    return tables.upsert_table(x.spark, source, path, ["customer_id"])


@query("surrogate_keys", f"""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CASE WHEN c_acctbal >= 0
    THEN row_number() OVER (PARTITION BY c_acctbal >= 0 ORDER BY {_MD5.format('CAST(c_custkey AS VARCHAR)')})
    ELSE (SELECT count(*) FROM customer WHERE c_acctbal >= 0)
       + row_number() OVER (PARTITION BY c_acctbal >= 0 ORDER BY {_MD5.format('CAST(c_custkey AS VARCHAR)')}) END AS customer_key
FROM customer""")
def surrogate_keys(x):
    """Customers without debt were loaded first; the others get the next numbers."""
    all_rows = x.t("customer").select(F.col("c_custkey").cast("string").alias("customer_id"), "c_acctbal")
    existing = number_rows(all_rows.filter("c_acctbal >= 0").select("customer_id"), "customer_id", "customer_key")
    return assign_keys(all_rows.select("customer_id"), "customer_id", "customer_key", existing)


_REGION_KEYS = f"(SELECT r_name, row_number() OVER (ORDER BY {_MD5.format('r_name')}) AS rk FROM region)"
_CUSTOMER_KEYS = f"(SELECT c_custkey AS ck, row_number() OVER (ORDER BY {_MD5.format('CAST(c_custkey AS VARCHAR)')}) AS customer_no FROM customer)"


@query("customer_dim", f"""
SELECT customer_no AS customer_key, CAST(c.c_custkey AS VARCHAR) AS customer_id, c.segment, c.sub_segment, c.brand, rk AS region_key,
  n_name AS city, chr(65 + c_nationkey) AS postcode_area, c.age_band, c.score_band,
  CASE WHEN last_order <= {LAST} THEN first_order END AS onboarding_date,
  CASE WHEN last_order < DATE '2001-01-01' THEN last_order END AS churn_date, seen.u IS NOT NULL AS is_digital,
  CASE WHEN last_order IS NULL OR last_order > {LAST} THEN 'Unknown'
    WHEN date_diff('month', first_order, {LAST}) < 12 THEN '< 1 year' WHEN date_diff('month', first_order, {LAST}) < 36 THEN '1-3 years'
    WHEN date_diff('month', first_order, {LAST}) < 60 THEN '3-5 years' WHEN date_diff('month', first_order, {LAST}) < 120 THEN '5-10 years'
    ELSE '10+ years' END AS tenure_band,
  nullif(concat_ws('; ', CASE WHEN c_acctbal < 0 THEN 'Region derived from postcode' END,
    CASE WHEN last_order > {LAST} THEN 'Future onboarding date removed' END), '') AS dq_flag
FROM cust c LEFT JOIN life ON o_custkey = c_custkey LEFT JOIN (SELECT DISTINCT user_id AS u FROM events) seen ON u = c_custkey
JOIN {_REGION_KEYS} rg ON rg.r_name = c.r_name JOIN {_CUSTOMER_KEYS} nos ON ck = c_custkey""")
def customer_dim(x):
    regions = dims.region_dimension(x.regions)
    d = dims.customer_dimension(dims.clean_customers(x.customers), regions, None, LAST_ACTUAL)
    return res(d, customer_key="CustomerKey", customer_id="CustomerID", segment="Segment", sub_segment="SubSegment",
               brand="Brand", region_key="RegionKey", city="City", postcode_area="PostcodeArea", age_band="AgeBand",
               score_band="CreditScoreBand", onboarding_date="OnboardingDate", churn_date="ChurnDate",
               is_digital="IsDigitallyRegistered", tenure_band="TenureBand", dq_flag="DQFlag")


@query("account_dim", f"""
SELECT row_number() OVER (ORDER BY {_MD5.format('account_id')}) AS account_key, account_id, o_custkey + 1 AS customer_key, open_date,
  {r('amount', 'original_amount')}, 240 AS term_months, {r('disc * 100', 'origination_rate')},
  {r("CASE WHEN product_id = 'P04' THEN disc * 10 END", 'origination_ltv')},
  CASE WHEN product_id <> 'P04' THEN NULL WHEN disc * 10 <= 0.60 THEN '<= 60%' WHEN disc * 10 <= 0.75 THEN '60-75%'
    WHEN disc * 10 <= 0.85 THEN '75-85%' WHEN disc * 10 <= 0.90 THEN '85-90%' ELSE '> 90%' END AS ltv_band,
  CAST(year(open_date) AS INTEGER) AS vintage_year, concat(year(open_date), ' Q', quarter(open_date)) AS vintage_quarter
FROM accounts_all""")
def account_dim(x):
    d = dims.account_dimension(dims.clean_accounts(x.accounts), x.dim_customer, x.dim_product)
    return res(d, account_key="AccountKey", account_id="AccountID", customer_key="CustomerKey", open_date="OpenDate",
               original_amount="OriginalAmount", term_months="TermMonths", origination_rate="OriginationRate",
               origination_ltv="OriginationLTV", ltv_band="OriginationLTVBand", vintage_year="VintageYear",
               vintage_quarter="VintageQuarter")


@query("channel_group", f"""
SELECT row_number() OVER (ORDER BY {_MD5.format('code')}) AS channel_key, code, name, CASE WHEN code IN ('CH02','CH03') THEN 'Digital'
  WHEN code IN ('CH01','CH04') THEN 'Branch and Phone' WHEN code = 'CH05' THEN 'ATM' ELSE 'Automated' END AS channel_group
FROM (SELECT DISTINCT CASE event_type WHEN 'click' THEN 'CH02' WHEN 'view' THEN 'CH03' WHEN 'purchase' THEN 'CH01'
  WHEN 'signup' THEN 'CH05' WHEN 'error' THEN 'CH06' END AS code, event_type AS name FROM events) e""")
def channel_group(x):
    return res(dims.channel_dimension(x.channels), channel_key="ChannelKey", code="ChannelCode", name="ChannelName",
               channel_group="ChannelGroup")


@query("category_dim", f"""
SELECT row_number() OVER (ORDER BY {_MD5.format('code')}) AS category_key, code, name, CASE WHEN code IN ('P01','P02','P03') THEN 'Deposits' ELSE 'Lending' END AS grp
FROM (SELECT DISTINCT CASE p_type WHEN 'STANDARD' THEN 'P01' WHEN 'SMALL' THEN 'P02' WHEN 'MEDIUM' THEN 'P03' WHEN 'ECONOMY' THEN 'P04'
  WHEN 'LARGE' THEN 'P05' WHEN 'PROMO' THEN 'P09' END AS code, p_type AS name FROM part) p""")
def category_dim(x):
    return res(dims.category_dimension(x.categories), category_key="CategoryKey", code="CategoryCode", name="CategoryName", grp="FCAProductGroup")


@query("product_dim", f"""
SELECT row_number() OVER (ORDER BY {_MD5.format('id')}) AS product_key, id, name, CASE WHEN id IN ('P01','P02','P03') THEN 'Deposits' ELSE 'Lending' END AS grp,
  CASE WHEN id = 'P09' THEN 'SME' ELSE 'Personal' END AS segment, CAST(right(id, 2) AS INTEGER) AS sort_order
FROM (SELECT DISTINCT CASE p_type WHEN 'STANDARD' THEN 'P01' WHEN 'SMALL' THEN 'P02' WHEN 'MEDIUM' THEN 'P03' WHEN 'ECONOMY' THEN 'P04'
  WHEN 'LARGE' THEN 'P05' WHEN 'PROMO' THEN 'P09' END AS id, p_type AS name FROM part) p""")
def product_dim(x):
    return res(dims.product_dimension(x.products), product_key="ProductKey", id="ProductID", name="ProductName",
               grp="ProductGroup", segment="Segment", sort_order="SortOrder")


@query("branch_dim", f"""
SELECT row_number() OVER (ORDER BY {_MD5.format("concat('B', n_nationkey)")}) AS branch_key, concat('B', n_nationkey) AS branch_id, n_name AS name,
  rk AS region_key, {r('n_nationkey * 1.5 + 40', 'lat')}, {r('n_nationkey * 0.5 - 6', 'lon')},
  CASE WHEN n_nationkey >= 20 THEN DATE '2001-03-31' WHEN n_nationkey >= 18 THEN DATE '2001-10-31' END AS closure_date,
  CASE WHEN n_nationkey >= 20 THEN 'Closed' ELSE 'Open' END AS status
FROM nation JOIN region ON n_regionkey = r_regionkey JOIN {_REGION_KEYS} k ON k.r_name = region.r_name""")
def branch_dim(x):
    d = dims.branch_dimension(x.branches, dims.region_dimension(x.regions), LAST_ACTUAL)
    return res(d, branch_key="BranchKey", branch_id="BranchID", name="BranchName", region_key="RegionKey", lat="Latitude",
               lon="Longitude", closure_date="ClosureDate", status="BranchStatus")


# ---------------------------------------------------------------- facts


@query("deposit_fact", f"""
SELECT date_key, account_id, customer_key, region_key, {rs('avg_balance', 'eom_balance', 'customer_rate', 'ftp_rate', 'interest_expense', 'ftp_credit', 'fee_income')}
FROM dep""")
def deposit_fact(x):
    d = x.deposits.join(x.account_numbers.select("AccountKey", "AccountID"), "AccountKey")
    return res(d, date_key="DateKey", account_id="AccountID", customer_key="CustomerKey", region_key="RegionKey",
               avg_balance="AvgBalance", eom_balance="EOMBalance", customer_rate="CustomerRate", ftp_rate="FTPRate",
               interest_expense="InterestExpense", ftp_credit="FTPCredit", fee_income="FeeIncome")


@query("loan_fact", f"""
SELECT date_key, customer_key, region_key, rate_type, {rs('balance_eom', 'credit_limit', 'customer_rate', 'interest_income', 'ftp_charge', 'ecl', 'write_off_amount', 'guarantee_claim_amount', 'current_ltv')},
  CAST(days_past_due AS INTEGER) AS days_past_due, arrears_bucket, CAST(stage AS INTEGER) AS stage, is_payment_holiday,
  {KEY.format('deal_end_date')} AS deal_end_key, account_status FROM loan""")
def loan_fact(x):
    return res(x.loans, date_key="DateKey", customer_key="CustomerKey", region_key="RegionKey", rate_type="RateType",
               balance_eom="BalanceEOM", credit_limit="CreditLimit", customer_rate="CustomerRate",
               interest_income="InterestIncome", ftp_charge="FTPCharge", ecl="ECL", write_off_amount="WriteOffAmount",
               guarantee_claim_amount="GuaranteeClaimAmount", current_ltv="CurrentLTV", days_past_due="DaysPastDue",
               arrears_bucket="ArrearsBucket", stage="IFRS9Stage", is_payment_holiday="IsPaymentHoliday",
               deal_end_key="DealEndDateKey", account_status="AccountStatus")


@query("digital_fact", f"""
SELECT {KEY.format('month_end')} AS date_key, c_custkey + 1 AS customer_key, region_key, CAST(web_logins AS INTEGER) AS web_logins,
  CAST(app_sessions AS INTEGER) AS app_sessions, is_monthly_active, CAST(features_used AS INTEGER) AS features_used
FROM digital JOIN cust USING (c_custkey)""")
def digital_fact(x):
    return res(x.digital, date_key="DateKey", customer_key="CustomerKey", region_key="RegionKey", web_logins="WebLogins",
               app_sessions="AppSessions", is_monthly_active="IsMonthlyActive", features_used="FeaturesUsed")


@query("transaction_fact", f"""
SELECT date_key, region_key, CAST(right(product_id, 2) AS INTEGER) AS product_key, CAST(right(channel_code, 2) AS INTEGER) AS channel_key,
  txn_type, txn_count, {rs('txn_value')} FROM txn_daily""")
def transaction_fact(x):
    return res(x.transactions, date_key="DateKey", region_key="RegionKey", product_key="ProductKey", channel_key="ChannelKey",
               txn_type="TxnType", txn_count="TxnCount", txn_value="TxnValue")


@query("branch_fact", f"""
SELECT date_key, branch_key, region_key, footfall, counter_txn_count, {rs('staff_fte')}, is_closure FROM branch_month""")
def branch_fact(x):
    return res(x.branch_activity, date_key="DateKey", branch_key="BranchKey", region_key="RegionKey", footfall="Footfall",
               counter_txn_count="CounterTxnCount", staff_fte="StaffFTE", is_closure="IsClosureMonth")


@query("complaint_fact", f"""
SELECT complaint_id, customer_key, region_key, received_key, resolved_key, root_cause, channel, upheld, {rs('redress')}, referred,
  CAST(days AS INTEGER) AS days, within8, is_open, dq_flag FROM complaint""")
def complaint_fact(x):
    return res(x.complaints, complaint_id="ComplaintID", customer_key="CustomerKey", region_key="RegionKey",
               received_key="ReceivedDateKey", resolved_key="ResolvedDateKey", root_cause="RootCause", channel="Channel",
               upheld="IsUpheld", redress="RedressAmount", referred="IsReferredToFOS", days="DaysToResolve",
               within8="IsResolvedWithin8Weeks", is_open="IsOpen", dq_flag="DQFlag")


@query("fraud_fact", f"""
SELECT case_id, customer_key, region_key, reported_key, fraud_type, channel, {rs('loss', 'reimbursed', 'recovered')}, case_status, post_rule FROM fraud""")
def fraud_fact(x):
    return res(x.fraud, case_id="CaseID", customer_key="CustomerKey", region_key="RegionKey", reported_key="ReportedDateKey",
               fraud_type="FraudType", channel="Channel", loss="LossAmount", reimbursed="ReimbursedAmount",
               recovered="RecoveredAmount", case_status="CaseStatus", post_rule="IsPostPSRRule")


@query("conduct_view", f"""
SELECT segment, brand, count(*) AS cases, {r('sum(redress)', 'redress')} FROM complaint GROUP BY ALL""")
def conduct_view(x):
    v = facts.with_customer(x.complaints, x.dim_customer, "Segment", "Brand")
    return res(v.groupBy(F.col("Segment").alias("segment"), F.col("Brand").alias("brand")).agg(
        F.count(F.lit(1)).alias("cases"), F.sum("RedressAmount").alias("redress")))


@query("budget_fact", f"""
SELECT date_key, region_key, CAST(right(product_id, 2) AS INTEGER) AS product_key, {rs('b_balance', 'b_nii', 'b_fees', 'b_impairment')} FROM budget""")
def budget_fact(x):
    return res(x.budget, date_key="DateKey", region_key="RegionKey", product_key="ProductKey", b_balance="BudgetBalance",
               b_nii="BudgetNII", b_fees="BudgetFees", b_impairment="BudgetImpairment")


@query("opex_fact", f"SELECT date_key, region_key, cost_category, {rs('actual', 'b_amount')} FROM opex")
def opex_fact(x):
    return res(x.opex, date_key="DateKey", region_key="RegionKey", cost_category="CostCategory", actual="ActualAmount",
               b_amount="BudgetAmount")


@query("hot_key_lookup", f"""
SELECT c_mktsegment AS segment, count(*) AS orders_n, {r('sum(o_totalprice::DECIMAL(12,2))', 'total')}
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def hot_key_lookup(x):
    """Lookup that keeps keys with a large share of the rows out of the shuffle."""
    o = x.t("orders").select(F.col("o_custkey").alias("k"), F.col("o_totalprice").cast("decimal(12,2)").alias("v"))
    c = x.t("customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"))
    return res(split_hot_lookup(o, c, "k").groupBy("segment").agg(
        F.count(F.lit(1)).alias("orders_n"), F.sum("v").alias("total")))


# ---------------------------------------------------------------- replace rules and load control


@query("period_replace", f"""
SELECT k AS "DateKey", count(*) AS n, {r('sum(v)', 'total')} FROM (
  SELECT {KEY.format('last_day(o_orderdate)')} AS k, o_totalprice::DECIMAL(12,2) AS v FROM orders WHERE o_orderstatus = 'O'
    AND last_day(o_orderdate) NOT IN (SELECT last_day(o_orderdate) FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2000-01-01')
  UNION ALL SELECT {KEY.format('last_day(o_orderdate)')}, o_totalprice::DECIMAL(12,2) FROM orders
    WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2000-01-01') u GROUP BY 1""")
def period_replace(x):
    """Open orders are the table; finished ones since 2000 arrive and replace their months."""
    rows = x.t("orders").select(date_key(F.last_day("o_orderdate")).alias("DateKey"), "o_orderstatus", "o_orderdate",
                                F.col("o_totalprice").cast("decimal(12,2)").alias("v"))
    target = rows.filter("o_orderstatus = 'O'")
    new = rows.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") >= F.lit(date(2000, 1, 1))))
    path = f"{work_folder(x.spark)}/orders"
    tables.replace_periods(target, path)
    tables.replace_periods(new, path)
    return res(tables.read_table(x.spark, path).groupBy("DateKey").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total")))


@query("range_replace", f"""
SELECT k AS "DateKey", count(*) AS n, {r('sum(v)', 'total')} FROM (
  SELECT {KEY.format('o_orderdate')} AS k, o_totalprice::DECIMAL(12,2) AS v FROM orders WHERE o_orderstatus = 'O'
    AND o_orderdate NOT BETWEEN TIMESTAMP '1997-02-10' AND TIMESTAMP '1998-03-05'
  UNION ALL SELECT {KEY.format('o_orderdate')}, o_totalprice::DECIMAL(12,2) FROM orders WHERE o_orderstatus = 'F'
    AND o_orderdate BETWEEN TIMESTAMP '1997-02-10' AND TIMESTAMP '1998-03-05') u GROUP BY 1""")
def range_replace(x):
    """Days of the range that bring no new rows vanish."""
    rows = x.t("orders").select(date_key("o_orderdate").alias("DateKey"), "o_orderstatus",
                                F.col("o_totalprice").cast("decimal(12,2)").alias("v"))
    new = rows.filter((F.col("o_orderstatus") == "F") & F.col("DateKey").between(19970210, 19980305))
    path = f"{work_folder(x.spark)}/orders"
    tables.replace_periods(rows.filter("o_orderstatus = 'O'"), path)
    tables.replace_range(new, path, 19970210, 19980305)
    return res(tables.read_table(x.spark, path).groupBy("DateKey").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total")))


def _plan_tables(x):
    """Order priorities stand for source tables; what was last loaded comes from their finished orders."""
    names = x.t("orders").select(F.col("o_orderpriority").alias("table_name")).distinct()
    config = names.select(
        "table_name", F.concat(F.lit("sales/"), F.col("table_name")).alias("source_folder"),
        F.concat(F.lit("stg."), F.col("table_name")).alias("stg_table"), F.lit("orders").alias("target"),
        F.when(F.col("table_name") == "5-LOW", "FULL").otherwise("INCREMENTAL").alias("load_type"), F.lit(3).alias("load_group"),
        F.left("table_name", F.lit(1)).cast("int").alias("load_order"), (F.col("table_name") != "4-NOT SPECIFIED").alias("is_active"))
    done = x.t("orders").filter("o_orderstatus = 'F'").groupBy(F.col("o_orderpriority").alias("table_name")).agg(
        F.last_day(F.max("o_orderdate")).alias("last_loaded_month_end"))
    marks = done.filter("table_name <> '2-HIGH'").withColumn("updated_at_utc", F.lit(None).cast("timestamp"))
    return config, marks


_NEXT = "last_day(CAST(COALESCE(wm, DATE '2019-12-31') + INTERVAL 1 MONTH AS DATE))"


@query("load_plan", f"""
SELECT p AS table_name, CAST(left(p, 1) AS INTEGER) AS load_order, concat('sales/', p, CASE WHEN p <> '5-LOW' THEN
    concat('/year=', year({_NEXT}), '/month=', lpad(CAST(month({_NEXT}) AS VARCHAR), 2, '0')) ELSE '' END) AS copy_folder,
  strftime({_NEXT}, '%Y-%m-%d') AS next_month_end
FROM (SELECT DISTINCT o_orderpriority AS p FROM orders) t LEFT JOIN (SELECT o_orderpriority AS q, last_day(max(o_orderdate)) AS wm
  FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '2-HIGH' GROUP BY 1) w ON q = p WHERE p <> '4-NOT SPECIFIED'""")
def load_plan(x):
    config, marks = _plan_tables(x)
    return control.load_plan(config, marks, 3, "INCREMENTAL").select("table_name", "load_order", "copy_folder", "next_month_end")


@query("watermark", """
SELECT o_orderpriority AS table_name, greatest(max(last_day(o_orderdate)) FILTER (o_orderstatus = 'F'),
  max(last_day(o_orderdate)) FILTER (o_orderstatus = 'O' AND o_totalprice > 400000)) AS last_loaded_month_end
FROM orders WHERE o_orderpriority <> '2-HIGH' GROUP BY 1""")
def watermark(x):
    _, marks = _plan_tables(x)
    loaded = x.t("orders").filter("o_orderstatus = 'O' and o_totalprice > 400000").select(
        F.col("o_orderpriority").alias("table_name"), F.last_day("o_orderdate").alias("month_end"))
    return control.advance_watermark(marks, loaded).select("table_name", "last_loaded_month_end")


@query("dq_log", """
SELECT 'gold' AS layer, 'FactDepositBalanceMonthly' AS table_name, month_end AS period_month_end, 'Duplicate rows removed' AS check_name,
  'Warning' AS severity, sum(n - 1)::BIGINT AS affected_rows, sum(n)::BIGINT AS total_rows, 'one row of each account and month stays' AS action_taken
FROM (SELECT account_id, month_end, count(*) AS n FROM dep_stage GROUP BY ALL) g GROUP BY month_end HAVING sum(n - 1) > 0""")
def dq_log(x):
    rows = control.dq_rows(quality.duplicates(x.deposit_rows, ["account_id"], "month_end"), layer="gold",
                           table="FactDepositBalanceMonthly", check="Duplicate rows removed", severity="Warning",
                           action="one row of each account and month stays", period="month_end")
    return rows.drop("checked_at_utc")
