"""Declared schemas of the source extracts and of the operational tables."""
from __future__ import annotations

from pyspark.sql.types import StructType

# The published source columns, as DDL.
_DDL = {
    "regions": "region_code string, region_name string, nation string, regional_director string, director_email string",
    "products": "product_id string, product_name string, product_group string, segment string, "
                "is_secured boolean, is_government_guaranteed boolean",
    "channels": "channel_code string, channel_name string",
    "complaint_categories": "category_code string, category_name string, fca_product_group string",
    "uk_bank_holidays": "holiday_date date",
    "bank_rate": "rate_date string, bank_rate string, source_system string",
    "branches": "branch_id string, branch_name string, brand string, region_code string, city string, "
                "latitude double, longitude double, branch_format string, open_date timestamp, closure_date timestamp",
    "customers": "customer_id string, segment string, sub_segment string, brand string, region_code string, "
                 "city string, postcode_sector string, age_band string, income_band string, industry string, "
                 "turnover_band string, credit_score_band string, onboarding_date timestamp, "
                 "onboarding_channel string, digital_registration_date timestamp, home_branch_id string, "
                 "churn_date timestamp, customer_status string",
    "accounts": "account_id string, customer_id string, product_id string, branch_id string, "
                "open_date timestamp, close_date timestamp, account_status string, original_amount double, "
                "term_months double, origination_rate double, origination_ltv double",
    "deposit_balance_monthly": "account_id string, month_end date, product_id string, avg_balance double, "
                               "eom_balance double, customer_rate double, ftp_rate double, "
                               "interest_expense double, ftp_credit double, fee_income double",
    "loan_performance_monthly": "account_id string, month_end date, product_id string, rate_type string, "
                                "balance_eom double, credit_limit double, customer_rate double, ftp_rate double, "
                                "interest_income double, ftp_charge double, fee_income double, "
                                "scheduled_payment double, days_past_due bigint, arrears_bucket string, "
                                "ifrs9_stage double, pd_12m double, lgd double, ead double, ecl double, "
                                "write_off_amount double, guarantee_claim_amount double, "
                                "is_payment_holiday boolean, deal_end_date date, is_deal_maturity boolean, "
                                "is_product_transfer boolean, current_ltv double, new_lending_amount double, "
                                "account_status string",
    "digital_activity_monthly": "customer_id string, month_end date, web_logins bigint, app_sessions bigint, "
                                "is_monthly_active boolean, features_used bigint",
    "transactions_daily": "txn_date date, region_code string, product_id string, channel_code string, "
                          "txn_type string, txn_count bigint, txn_value double",
    "branch_activity_monthly": "branch_id string, month_end date, footfall bigint, counter_txn_count bigint, "
                               "staff_fte double, is_closure_month boolean",
    "complaints": "complaint_id string, customer_id string, received_date timestamp, resolved_date timestamp, "
                  "category_code string, root_cause string, channel string, upheld boolean, "
                  "redress_amount double, referred_to_fos boolean",
    "fraud_cases": "case_id string, customer_id string, reported_date timestamp, fraud_type string, "
                   "channel string, loss_amount double, reimbursed_amount double, recovered_amount double, "
                   "case_status string",
    "budget_monthly": "region_code string, month_end date, product_id string, budget_balance double, "
                      "budget_nii double, budget_fees double, budget_impairment double",
    "opex_monthly": "region_code string, month_end date, cost_category string, actual_amount double, "
                    "budget_amount double",
}

_OPS_DDL = {
    "run_log": "run_id string, job string, activity string, source_table string, source_file string, "
               "period_month_end date, rows_read bigint, rows_written bigint, status string, message string, "
               "started_at_utc timestamp, ended_at_utc timestamp",
    "watermark": "table_name string, last_loaded_month_end date, updated_at_utc timestamp",
    "dq_results": "checked_at_utc timestamp, layer string, table_name string, period_month_end date, "
                  "check_name string, severity string, affected_rows bigint, total_rows bigint, action_taken string",
    "load_config": "table_name string, source_folder string, stg_table string, target string, load_type string, "
                   "load_group int, load_order int, is_active boolean",
    "manifest": "scale double, total_rows bigint, total_bytes bigint, "
                "files array<struct<source: string, table: string, file: string, rows: bigint, bytes: bigint>>",
}

SOURCE_TABLES = tuple(_DDL)


def source_schema(table: str) -> StructType:
    return StructType.fromDDL(_DDL[table])


def ops_schema(table: str) -> StructType:
    return StructType.fromDDL(_OPS_DDL[table])
