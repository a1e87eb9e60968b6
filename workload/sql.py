"""The adapter rules and the marts in SQL, as named CTEs; `sql(body)` adds those a body names."""
from __future__ import annotations

import re

LAST = "DATE '2001-07-31'"
FIRST = "DATE '1995-01-31'"

CTES: dict[str, str] = {}


def cte(name: str, text: str) -> None:
    CTES[name] = text


def _needs(text: str) -> list[str]:
    words = set(re.findall(r"\b[a-z_][a-z_0-9]*\b", text))
    return [n for n in CTES if n in words]


def sql(body: str) -> str:
    """The body with every CTE it needs, directly or through others, in order of definition."""
    wanted: set[str] = set()

    def visit(text: str) -> None:
        for n in _needs(text):
            if n not in wanted:
                wanted.add(n)
                visit(CTES[n])

    visit(body)
    if not wanted:
        return body
    parts = ",\n".join(f"{n} AS ({CTES[n]})" for n in CTES if n in wanted)
    return f"WITH {parts}\n{body}"


PRODUCT = ("CASE p_type WHEN 'STANDARD' THEN 'P01' WHEN 'SMALL' THEN 'P02' WHEN 'MEDIUM' THEN 'P03' "
           "WHEN 'ECONOMY' THEN 'P04' WHEN 'LARGE' THEN 'P05' WHEN 'PROMO' THEN 'P09' END")
KEY = "CAST(year({0}) * 10000 + month({0}) * 100 + day({0}) AS INTEGER)"

cte("base_rows", f"""
SELECT l_orderkey, l_linenumber, l_quantity::DECIMAL(12,2) AS qty, l_extendedprice::DECIMAL(12,2) AS price,
  l_discount::DECIMAL(4,2) AS disc, l_tax::DECIMAL(4,2) AS tax, l_returnflag, l_linestatus,
  CAST(l_shipdate AS DATE) AS ship_date, CAST(o_orderdate AS DATE) AS order_date, o_custkey, {PRODUCT} AS product_id,
  last_day(CAST(o_orderdate AS DATE)) AS month_end, concat(o_custkey, '-', {PRODUCT}) AS account_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""")

SEGMENT = "CASE WHEN c_mktsegment IN ('BUILDING','HOUSEHOLD','FURNITURE') THEN 'Personal' ELSE 'SME' END"
SCORE = ("CASE WHEN c_acctbal < 0 THEN 'Very Poor' WHEN c_acctbal < 2500 THEN 'Poor' WHEN c_acctbal < 5000 THEN 'Fair' "
         "WHEN c_acctbal < 7500 THEN 'Good' ELSE 'Excellent' END")
AGE = ("CASE WHEN c_mktsegment IN ('BUILDING','HOUSEHOLD','FURNITURE') THEN CASE WHEN c_acctbal < 2000 THEN '18-34' "
       "WHEN c_acctbal < 5000 THEN '35-54' ELSE '55+' END END")

cte("cust", f"""
SELECT c_custkey, c_custkey + 1 AS customer_key, {SEGMENT} AS segment, c_mktsegment AS sub_segment,
  concat('Brand ', c_nationkey % 3) AS brand, r_regionkey + 1 AS region_key, r_name, c_nationkey, {AGE} AS age_band,
  {SCORE} AS score_band, c_acctbal, n_name, concat(left(r_name, 1), lower(substr(r_name, 2))) AS region_word
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")

cte("regions_named", """
SELECT r_regionkey + 1 AS region_key, r_name AS code,
  CASE r_name WHEN 'MIDDLE EAST' THEN 'Middle East' ELSE concat(left(r_name, 1), lower(substr(r_name, 2))) END AS region_name
FROM region""")

cte("life", """
SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_order, CAST(max(o_orderdate) AS DATE) AS last_order
FROM orders GROUP BY o_custkey""")

cte("dep_stage", """
SELECT account_id, o_custkey, month_end, product_id,
  (CASE WHEN l_returnflag = 'R' AND qty = 13 THEN -price ELSE price END)::DECIMAL(18,2) AS avg_balance,
  (price * (1 - disc))::DECIMAL(18,2) AS eom_balance, (disc * 100)::DECIMAL(7,4) AS customer_rate,
  (tax * 100)::DECIMAL(9,4) AS ftp_rate, (price * disc * 0.08)::DECIMAL(18,2) AS interest_expense,
  (price * tax * 0.08)::DECIMAL(18,2) AS ftp_credit, qty::DECIMAL(18,2) AS fee_income
FROM base_rows WHERE product_id IN ('P01','P02','P03')""")

cte("dep", f"""
SELECT account_id, o_custkey + 1 AS customer_key, product_id, month_end, {KEY.format('month_end')} AS date_key,
  CASE WHEN avg_balance < 0 AND product_id IN ('P02','P03') THEN -avg_balance ELSE avg_balance END AS avg_balance,
  eom_balance, customer_rate, ftp_rate, interest_expense, ftp_credit, fee_income, c.region_key, c.brand, c.sub_segment
FROM (SELECT *, row_number() OVER (PARTITION BY account_id, month_end ORDER BY avg_balance, customer_rate, eom_balance,
        fee_income, ftp_credit, ftp_rate, interest_expense) AS rn FROM dep_stage) s
JOIN cust c ON c.c_custkey = s.o_custkey WHERE rn = 1""")

cte("loan_base", """
SELECT *, greatest(abs(date_diff('day', order_date, ship_date)) % 130 - 20, 0) AS dpd,
  (price * 1.1)::DECIMAL(18,2) AS ead, (l_linestatus = 'F' AND l_returnflag = 'R') AS written
FROM base_rows WHERE product_id IN ('P04','P05','P09')""")

cte("loan_stage", """
SELECT account_id, o_custkey, month_end, product_id,
  CASE WHEN l_linenumber % 2 = 1 THEN '2y Fixed' ELSE '5y Fixed' END AS rate_type, price::DECIMAL(18,2) AS balance_eom,
  CASE WHEN product_id = 'P05' THEN (price * 1.2)::DECIMAL(18,2) END AS credit_limit,
  (disc * 100)::DECIMAL(7,4) AS customer_rate, (tax * 100)::DECIMAL(9,4) AS ftp_rate,
  (price * disc * 0.08)::DECIMAL(18,2) AS interest_income, (price * tax * 0.08)::DECIMAL(18,2) AS ftp_charge,
  qty::DECIMAL(18,2) AS fee_income, (price * 0.01)::DECIMAL(18,2) AS scheduled_payment, dpd AS days_past_due,
  CASE WHEN dpd < 1 THEN 'Current' WHEN dpd < 30 THEN '1-29' WHEN dpd < 60 THEN '30-59' WHEN dpd < 90 THEN '60-89'
       ELSE '90+' END AS arrears_bucket,
  CASE WHEN qty = 13 THEN NULL WHEN dpd >= 90 THEN 3 WHEN dpd >= 30 OR tax >= 0.06 THEN 2 ELSE 1 END AS ifrs9_stage,
  tax::DECIMAL(9,6) AS pd_12m, ead, (ead * tax * 0.5)::DECIMAL(18,2) AS ecl,
  (CASE WHEN written THEN price ELSE 0 END)::DECIMAL(18,2) AS write_off_amount,
  (CASE WHEN written AND product_id = 'P09' THEN price ELSE 0 END)::DECIMAL(18,2) AS guarantee_claim_amount,
  qty >= 48 AS is_payment_holiday,
  CASE WHEN product_id = 'P04' THEN last_day(order_date + to_months(CASE WHEN l_linenumber % 2 = 1 THEN 24 ELSE 60 END)) END AS deal_end_date,
  l_returnflag = 'N' AS is_deal_maturity, l_returnflag = 'A' AS is_product_transfer,
  CASE WHEN product_id = 'P04' THEN (disc * 10)::DECIMAL(9,4) END AS current_ltv,
  (CASE WHEN l_linenumber = 1 THEN price ELSE 0 END)::DECIMAL(18,2) AS new_lending_amount,
  CASE WHEN l_linestatus = 'O' THEN 'Open' WHEN written THEN 'Written Off' ELSE 'Closed' END AS account_status
FROM loan_base""")

cte("loan", f"""
SELECT s.* EXCLUDE (ifrs9_stage, rn), {KEY.format('month_end')} AS date_key, o_custkey + 1 AS customer_key,
  COALESCE(ifrs9_stage, CASE WHEN arrears_bucket = '90+' THEN 3 WHEN days_past_due >= 30 THEN 2 ELSE 1 END) AS stage,
  c.region_key, c.brand, c.sub_segment, c.score_band
FROM (SELECT *, row_number() OVER (PARTITION BY account_id, month_end ORDER BY account_status, arrears_bucket, balance_eom,
    credit_limit NULLS FIRST, current_ltv NULLS FIRST, customer_rate, days_past_due, deal_end_date NULLS FIRST, ead, ecl,
    fee_income, ftp_charge, ftp_rate, guarantee_claim_amount, ifrs9_stage NULLS FIRST, interest_income,
    is_deal_maturity, is_payment_holiday, is_product_transfer, new_lending_amount, rate_type) AS rn FROM loan_stage) s
JOIN cust c ON c.c_custkey = s.o_custkey WHERE rn = 1""")

cte("pnl", """
SELECT date_key, month_end, region_key, product_id, brand, sub_segment, sum(accounts)::BIGINT AS accounts,
  sum(avg_balance) AS avg_balance, sum(eom_balance) AS eom_balance, sum(interest_income) AS interest_income,
  sum(interest_expense) AS interest_expense, sum(ftp_credit) AS ftp_credit, sum(ftp_charge) AS ftp_charge,
  sum(fee_income) AS fee_income, sum(new_lending) AS new_lending, sum(write_off) AS write_off,
  sum(guarantee) AS guarantee, sum(ecl) AS ecl, sum(s1) AS s1, sum(s2) AS s2, sum(s3) AS s3, sum(a30) AS a30,
  sum(a90) AS a90, sum(holiday) AS holiday, sum(climit) AS climit, sum(rate_x_balance)::DECIMAL(34,4) AS rate_x_balance
FROM (
  SELECT date_key, month_end, region_key, product_id, brand, sub_segment, 1 AS accounts, avg_balance, eom_balance,
    0 AS interest_income, interest_expense, ftp_credit, 0 AS ftp_charge, fee_income, 0 AS new_lending, 0 AS write_off,
    0 AS guarantee, 0 AS ecl, 0 AS s1, 0 AS s2, 0 AS s3, 0 AS a30, 0 AS a90, 0 AS holiday, 0 AS climit,
    customer_rate * avg_balance AS rate_x_balance FROM dep
  UNION ALL
  SELECT date_key, month_end, region_key, product_id, brand, sub_segment, CASE WHEN account_status = 'Open' THEN 1 ELSE 0 END,
    balance_eom, balance_eom, interest_income, 0, 0, ftp_charge, fee_income, new_lending_amount, write_off_amount,
    guarantee_claim_amount, ecl, CASE WHEN stage = 1 THEN balance_eom ELSE 0 END, CASE WHEN stage = 2 THEN balance_eom ELSE 0 END,
    CASE WHEN stage = 3 THEN balance_eom ELSE 0 END, CASE WHEN days_past_due >= 30 THEN balance_eom ELSE 0 END,
    CASE WHEN arrears_bucket = '90+' THEN balance_eom ELSE 0 END, CASE WHEN is_payment_holiday THEN balance_eom ELSE 0 END,
    COALESCE(credit_limit, 0), customer_rate * balance_eom FROM loan) u
GROUP BY ALL""")

cte("risk", """
SELECT date_key, month_end, region_key, product_id, score_band,
  CASE WHEN current_ltv IS NULL THEN 'n/a' WHEN current_ltv <= 0.50 THEN '1. <= 50%' WHEN current_ltv <= 0.60 THEN '2. 50-60%'
       WHEN current_ltv <= 0.75 THEN '3. 60-75%' WHEN current_ltv <= 0.85 THEN '4. 75-85%'
       WHEN current_ltv <= 0.90 THEN '5. 85-90%' ELSE '6. > 90%' END AS ltv_band,
  stage, arrears_bucket, count(*) AS accounts, sum(balance_eom) AS balance, sum(ead) AS ead, sum(ecl) AS ecl,
  sum(write_off_amount - guarantee_claim_amount) AS net_write_off, sum(pd_12m * ead)::DECIMAL(34,4) AS pd_x_ead
FROM loan WHERE account_status = 'Open' OR write_off_amount > 0 GROUP BY ALL""")

cte("wall", f"""
SELECT concat(year(deal_end_date), ' Q', quarter(deal_end_date)) AS deal_end_quarter, {KEY.format('deal_end_date')} AS deal_end_key,
  deal_end_date, region_key, rate_type,
  CASE WHEN customer_rate < 2 THEN '1. < 2%' WHEN customer_rate < 3 THEN '2. 2-3%' WHEN customer_rate < 4 THEN '3. 3-4%'
       WHEN customer_rate < 5 THEN '4. 4-5%' ELSE '5. >= 5%' END AS rate_band,
  count(*) AS accounts, sum(balance_eom) AS balance, sum(customer_rate * balance_eom)::DECIMAL(34,4) AS rate_x_balance,
  sum(scheduled_payment) AS monthly_payment
FROM loan WHERE month_end = {LAST} AND account_status = 'Open' AND product_id = 'P04' AND deal_end_date IS NOT NULL GROUP BY ALL""")

cte("repricing", """
SELECT e.date_key, e.month_end, e.region_key, e.rate_type AS new_rate_type, count(*) AS repricings, sum(e.balance_eom) AS balance,
  sum(p.customer_rate * e.balance_eom)::DECIMAL(34,4) AS old_rate_x_balance,
  sum(e.customer_rate * e.balance_eom)::DECIMAL(34,4) AS new_rate_x_balance,
  sum(p.scheduled_payment) AS old_payment, sum(e.scheduled_payment) AS new_payment
FROM loan e JOIN loan p ON p.account_id = e.account_id AND p.month_end = last_day(e.month_end - INTERVAL 1 MONTH)
WHERE e.product_id = 'P04' AND (e.is_product_transfer OR e.is_deal_maturity) AND e.account_status = 'Open' AND p.scheduled_payment > 0
GROUP BY ALL""")

cte("accounts_all", """
SELECT account_id, o_custkey, product_id, min(order_date) AS open_date, max(price)::DECIMAL(18,2) AS amount,
  max(disc) AS disc FROM base_rows GROUP BY ALL""")

cte("vintage", f"""
SELECT vq AS vintage_quarter, n AS months_on_book, count(*) AS loans, sum(amount) AS original_amount,
  sum(CASE WHEN default_month <= last_day(open_month + to_months(n)) THEN 1 ELSE 0 END)::BIGINT AS defaulted_loans,
  sum(CASE WHEN default_month <= last_day(open_month + to_months(n)) THEN amount ELSE 0 END) AS defaulted_amount
FROM (SELECT a.account_id, concat(year(open_date), ' Q', quarter(open_date)) AS vq, last_day(open_date) AS open_month, amount,
             (SELECT min(l.month_end) FROM loan l WHERE l.account_id = a.account_id
                AND (l.arrears_bucket = '90+' OR l.account_status = 'Written Off')) AS default_month
      FROM accounts_all a WHERE product_id = 'P09') x
CROSS JOIN (SELECT CAST(range AS INTEGER) AS n FROM range(80)) spine
WHERE last_day(open_month + to_months(n)) <= {LAST} GROUP BY ALL""")

cte("flow_rows", """
SELECT e.*, c.r_name, c.c_nationkey, c.region_key, value::DECIMAL(18,2) AS amount,
  CAST(DATE '1999-01-01' + to_months(CAST(day(ts) - 1 AS INTEGER)) AS DATE) AS month_start,
  last_day(CAST(DATE '1999-01-01' + to_months(CAST(day(ts) - 1 AS INTEGER)) AS DATE)) AS month_end
FROM events e JOIN cust c ON c.c_custkey = e.user_id""")

cte("digital", """
SELECT user_id AS c_custkey, month_end, count(*) FILTER (event_type = 'view') AS web_logins,
  count(*) FILTER (event_type = 'click') AS app_sessions,
  count(*) FILTER (event_type IN ('click','purchase')) > 0 AS is_monthly_active, count(DISTINCT event_type) AS features_used
FROM flow_rows GROUP BY ALL""")

cte("months", f"""
SELECT CAST(last_day(CAST({FIRST} AS DATE) + to_months(CAST(range AS INTEGER))) AS DATE) AS m FROM range(79)""")

cte("custm", f"""
SELECT {KEY.format('m')} AS date_key, m AS month_end, b.region_key, b.segment, b.sub_segment, b.brand, b.age,
  b.active, b.new, b.churned, COALESCE(d.registered, 0) AS registered, COALESCE(d.mau, 0) AS mau,
  COALESCE(d.app_sessions, 0) AS app_sessions, COALESCE(d.web_logins, 0) AS web_logins, COALESCE(d.features, 0) AS features
FROM (SELECT m, region_key, segment, sub_segment, brand, COALESCE(age_band, 'SME') AS age,
        count(*) FILTER ((first_order IS NULL OR first_order <= m) AND (churn IS NULL OR churn > m)) AS active,
        count(*) FILTER (first_order BETWEEN date_trunc('month', m) AND m) AS new,
        count(*) FILTER (churn BETWEEN date_trunc('month', m) AND m) AS churned
      FROM (SELECT c.*, first_order, CASE WHEN last_order < DATE '2001-01-01' THEN last_order END AS churn
            FROM cust c LEFT JOIN life ON o_custkey = c_custkey) cc CROSS JOIN months GROUP BY ALL) b
LEFT JOIN (SELECT month_end, region_key, segment, sub_segment, brand, COALESCE(age_band, 'SME') AS age, count(*) AS registered,
        count(*) FILTER (is_monthly_active) AS mau, sum(app_sessions)::BIGINT AS app_sessions,
        sum(web_logins)::BIGINT AS web_logins, sum(features_used)::BIGINT AS features
      FROM digital JOIN cust USING (c_custkey) GROUP BY ALL) d
  ON d.month_end = b.m AND d.region_key = b.region_key AND d.segment = b.segment AND d.sub_segment = b.sub_segment
 AND d.brand = b.brand AND d.age = b.age""")

cte("txn_daily", f"""
SELECT txn_date, {KEY.format('txn_date')} AS date_key, region_key, product_id, channel_code, txn_type,
  count(*) AS txn_count, sum(amount) AS txn_value
FROM (SELECT CAST(month_start + to_days(CAST(hour(ts) AS INTEGER)) AS DATE) AS txn_date, region_key,
        CASE WHEN amount < 5 THEN 'P01' WHEN amount < 20 THEN 'P02' ELSE 'P03' END AS product_id,
        CASE event_type WHEN 'click' THEN 'CH02' WHEN 'view' THEN 'CH03' WHEN 'purchase' THEN 'CH01' WHEN 'signup' THEN 'CH05'
          WHEN 'error' THEN 'CH06' END AS channel_code,
        CASE WHEN event_type IN ('purchase','click') THEN 'Payment' ELSE 'Service' END AS txn_type, amount
      FROM flow_rows) f GROUP BY ALL""")

cte("txn_month", """
SELECT last_day(txn_date) AS month_end, region_key, product_id, channel_code, txn_type,
  CASE channel_code WHEN 'CH02' THEN 'Digital' WHEN 'CH03' THEN 'Digital' WHEN 'CH01' THEN 'Branch and Phone'
    WHEN 'CH05' THEN 'ATM' ELSE 'Automated' END AS channel_group,
  sum(txn_count)::BIGINT AS txn_count, sum(txn_value) AS txn_value FROM txn_daily GROUP BY ALL""")

cte("branch_month", f"""
SELECT month_end, {KEY.format('month_end')} AS date_key, c_nationkey + 1 AS branch_key, region_key,
  max(floor(amount * 10))::BIGINT AS footfall, max(hour(ts))::BIGINT AS counter_txn_count,
  max(amount::DECIMAL(10,0))::DECIMAL(5,1) AS staff_fte, bool_or(event_type = 'error' AND amount > 150) AS is_closure
FROM flow_rows GROUP BY ALL""")

cte("complaint_stage", """
SELECT concat(l_orderkey, '-', l_linenumber) AS complaint_id, o_custkey, order_date AS received,
  CASE WHEN NOT (l_linestatus = 'O' AND qty > 45) THEN ship_date END AS resolved, product_id AS category_code,
  l_returnflag AS root_cause, l_linestatus AS channel, l_returnflag = 'A' AS upheld, (price * 0.01)::DECIMAL(18,2) AS redress,
  tax >= 0.07 AS referred, ship_date
FROM base_rows""")

cte("complaint", f"""
SELECT complaint_id, c.customer_key, c.region_key, c.segment, c.brand, category_code, received, {KEY.format('received')} AS received_key,
  CASE WHEN resolved >= received THEN {KEY.format('resolved')} END AS resolved_key, root_cause, channel, upheld, redress, referred,
  CASE WHEN resolved >= received THEN date_diff('day', received, resolved) END AS days,
  CASE WHEN resolved >= received THEN date_diff('day', received, resolved) <= 56 END AS within8, resolved IS NULL AS is_open,
  CASE WHEN resolved < received THEN 'Resolved before received: date removed' END AS dq_flag
FROM (SELECT *, row_number() OVER (PARTITION BY complaint_id ORDER BY ship_date DESC, category_code, channel, o_custkey::VARCHAR, received,
        redress, referred, resolved NULLS FIRST, root_cause, upheld) AS rn FROM (
          SELECT * REPLACE (date_trunc('month', ship_date) AS ship_date) FROM complaint_stage) t) s
JOIN cust c ON c.c_custkey = s.o_custkey WHERE rn = 1""")

cte("fraud", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS case_id, c.customer_key, c.region_key, c.segment, c.brand, CAST(o_orderdate AS DATE) AS reported,
  {KEY.format('o_orderdate')} AS reported_key,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'APP Scam' WHEN '2-HIGH' THEN 'Card Fraud' ELSE 'Other' END AS fraud_type,
  o_orderstatus AS channel, (o_totalprice::DECIMAL(12,2) * 0.01)::DECIMAL(18,2) AS loss,
  ((o_totalprice::DECIMAL(12,2) * 0.01)::DECIMAL(18,2) * CASE o_orderstatus WHEN 'F' THEN 0.60 WHEN 'O' THEN 0.90 ELSE 0.00 END)::DECIMAL(18,2) AS reimbursed,
  ((o_totalprice::DECIMAL(12,2) * 0.01)::DECIMAL(18,2) * 0.1)::DECIMAL(18,2) AS recovered, o_orderstatus AS case_status,
  CAST(o_orderdate AS DATE) >= DATE '1998-06-01' AS post_rule
FROM orders JOIN cust c ON c.c_custkey = o_custkey""")

cte("rate_seen", """
SELECT CAST(o_orderdate AS DATE) AS d, max((floor(o_totalprice / 1000) / 100)::DECIMAL(5,2)) AS r
FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice >= 5000 GROUP BY 1""")

cte("rate", f"""
SELECT c.d, {KEY.format('c.d')} AS date_key, COALESCE(
    last_value(r IGNORE NULLS) OVER (ORDER BY c.d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    (SELECT arg_min(r, d) FROM rate_seen)) AS rate
FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '1995-01-01', (SELECT max(d) FROM rate_seen)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS d) c
LEFT JOIN rate_seen ON rate_seen.d = c.d""")

cte("budget", f"""
SELECT month_end, {KEY.format('month_end')} AS date_key, c.region_key, product_id, sum((price * 1.020)::DECIMAL(18,2)) AS b_balance,
  sum((price * 0.004)::DECIMAL(18,2)) AS b_nii, sum((qty * 1.050)::DECIMAL(18,2)) AS b_fees,
  sum((price * 0.001)::DECIMAL(18,2)) AS b_impairment
FROM base_rows JOIN cust c ON c.c_custkey = o_custkey GROUP BY ALL""")

cte("opex", f"""
SELECT last_day(CAST(o_orderdate AS DATE)) AS month_end, {KEY.format('last_day(CAST(o_orderdate AS DATE))')} AS date_key, c.region_key,
  o_orderpriority AS cost_category,
  sum(CASE WHEN last_day(CAST(o_orderdate AS DATE)) <= {LAST} THEN (o_totalprice::DECIMAL(12,2) * 0.001)::DECIMAL(18,2) END) AS actual,
  sum((o_totalprice::DECIMAL(12,2) * 0.002)::DECIMAL(18,2)) AS b_amount
FROM orders JOIN cust c ON c.c_custkey = o_custkey GROUP BY ALL""")

# monthly totals used by the measure queries
cte("nii_month", """
SELECT month_end, year(month_end) AS y, sum(interest_income - ftp_charge + ftp_credit - interest_expense) AS nii,
  sum(fee_income) AS fees FROM pnl GROUP BY ALL""")

cte("cells", """
SELECT DISTINCT strftime(d, '%Y-%m') AS ym, last_day(d) AS me
FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS d) t""")

cte("years", """
SELECT CAST(range AS BIGINT) AS y, CASE WHEN range = 2001 THEN DATE '2001-07-31' ELSE make_date(CAST(range AS INTEGER), 12, 31) END AS pe,
  CASE WHEN range = 2001 THEN 7 ELSE 12 END AS n_months FROM range(1995, 2002)""")

DEP = "product_id IN ('P01','P02','P03')"
cte("pm", f"""
SELECT month_end, year(month_end) AS y, sum(interest_income) AS ii, sum(interest_expense) AS ie, sum(ftp_credit) AS fc,
  sum(ftp_charge) AS fch, sum(interest_income - ftp_charge + ftp_credit - interest_expense) AS nii, sum(fee_income) AS fees,
  sum(CASE WHEN {DEP} THEN eom_balance END) AS dep, sum(CASE WHEN NOT {DEP} THEN eom_balance END) AS loan_eom,
  sum(CASE WHEN product_id = 'P01' THEN eom_balance END) AS cur, sum(CASE WHEN product_id IN ('P02','P03') THEN eom_balance END) AS sav,
  sum(CASE WHEN product_id = 'P03' THEN eom_balance END) AS fts, sum(ecl) AS ecl, sum(avg_balance) AS bm,
  sum(new_lending) AS new_lending, sum(s1) AS s1, sum(s2) AS s2, sum(s3) AS s3, sum(a30) AS a30, sum(a90) AS a90,
  sum(write_off) AS wo, sum(guarantee) AS ga, sum(holiday) AS holiday,
  sum(CASE WHEN {DEP} THEN rate_x_balance END) AS dep_rxb, sum(CASE WHEN {DEP} THEN avg_balance END) AS dep_avg,
  sum(CASE WHEN NOT {DEP} THEN rate_x_balance END) AS loan_rxb
FROM pnl GROUP BY ALL""")

_FLOWS = ["ii", "ie", "fc", "fch", "nii", "fees", "bm", "new_lending", "wo", "ga", "holiday", "dep_rxb", "dep_avg", "loan_rxb", "loan_eom"]
_SUMS = ", ".join(f"sum({c}) AS {c}" for c in _FLOWS)
# per year: flows, flows of the window one year earlier, balances at the period end and one year earlier
cte("yf", f"""SELECT years.y, {_SUMS}, avg(CASE WHEN month_end <= {LAST} THEN loan_eom::DOUBLE END) AS loan_mean
FROM years JOIN pm ON pm.y = years.y GROUP BY 1""")
cte("yp", f"""SELECT years.y, {_SUMS}, avg(loan_eom::DOUBLE) AS loan_mean, count(*) AS n_months
FROM years JOIN pm ON month_end BETWEEN make_date(CAST(years.y - 1 AS INTEGER), 1, 1) AND last_day(CAST(pe - INTERVAL 1 YEAR AS DATE)) GROUP BY 1""")
cte("ye", "SELECT pm.* REPLACE (years.y AS y) FROM years JOIN pm ON month_end = pe")
cte("yep", "SELECT pm.* REPLACE (years.y AS y) FROM years JOIN pm ON month_end = last_day(CAST(pe - INTERVAL 1 YEAR AS DATE))")
cte("yo", "SELECT pm.* REPLACE (years.y AS y) FROM years JOIN pm ON month_end = make_date(CAST(years.y - 1 AS INTEGER), 12, 31)")
cte("bud_y", f"""SELECT year(month_end) AS y, sum(CASE WHEN month_end <= {LAST} THEN b_nii END) AS b_nii, sum(b_nii) AS b_nii_full,
  sum(CASE WHEN month_end <= {LAST} THEN b_fees END) AS b_fees, sum(CASE WHEN month_end <= {LAST} THEN b_impairment END) AS b_imp
FROM budget GROUP BY 1""")
cte("opex_y", f"""SELECT year(month_end) AS y, sum(actual) AS cost, sum(CASE WHEN month_end <= {LAST} THEN b_amount END) AS b_cost FROM opex GROUP BY 1""")
cte("opex_p", """SELECT years.y, sum(actual) AS cost FROM years JOIN opex ON month_end BETWEEN make_date(CAST(years.y - 1 AS INTEGER), 1, 1)
  AND last_day(CAST(pe - INTERVAL 1 YEAR AS DATE)) GROUP BY 1""")
