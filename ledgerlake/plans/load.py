"""The whole load in order: reference and master data, dimensions, rate, facts, finance, marts.

A plain driver of DataFrame jobs. An error is logged and raised, so nothing that depends on the
failed step runs.
"""
from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.dates import key_date, month_end
from ..sources import control, landing, tables
from ..sources.schemas import source_schema
from . import dimensions as dims, facts, marts, quality
from .measures import build_registry, flag_next_year, latest_runs
from .model import Model
from .refresh import Refresh


@dataclass
class Warehouse:
    """A warehouse below one root folder: stg, gold, mart and ops layers."""
    spark: SparkSession
    landing: str
    root: str
    last_actual: date = dims.LAST_ACTUAL
    first_month: date = marts.DEFAULT_START
    run_id: str = "manual"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        df = tables.read_table(self.spark, self.path(layer, table))
        if df is None:
            raise LookupError(f"{layer}.{table} has not been loaded")
        return df

    def read_or_none(self, layer: str, table: str) -> DataFrame | None:
        return tables.read_table(self.spark, self.path(layer, table))

    # -- control -------------------------------------------------------------------------------
    def log(self, **values) -> None:
        row = control.run_log_row(self.spark, run_id=self.run_id, job="load", activity="Copy to staging", **values)
        tables.append_rows(row, self.path("ops", "run_log"))

    def log_dq(self, counts: DataFrame, **values) -> None:
        tables.append_rows(control.dq_rows(counts, **values), self.path("ops", "dq_results"))

    def log_checks(self, source: str, counted: DataFrame, checks: dict[str, str], table: str) -> None:
        """Log what the checks found and move the watermark, from one table of counts by month."""
        rows = self.spark.createDataFrame(counted.collect(), counted.schema)  # one row for each month of the delivery
        found = quality.check_rows(rows, checks, "month_end")
        tables.append_rows(found.select(
            F.current_timestamp().alias("checked_at_utc"), F.lit("gold").alias("layer"), F.lit(table).alias("table_name"), "period_month_end",
            "check_name", "severity", "affected_rows", "total_rows", "action_taken"), self.path("ops", "dq_results"))
        self.advance(source, rows.agg(F.max("month_end").alias("month_end")))

    def watermark(self) -> DataFrame:
        found = self.read_or_none("ops", "watermark")
        return control.initial_watermark(self.spark) if found is None else found

    def advance(self, table: str, marks: DataFrame) -> None:
        loaded = marks.select(F.lit(table).alias("table_name"), F.col("month_end"))
        tables.full_reload(control.advance_watermark(self.watermark(), loaded), self.path("ops", "watermark"))

    # -- steps ---------------------------------------------------------------------------------
    def stage_group(self, group: int, mode: str) -> list[tuple[str, str | None]]:
        """Copy one load group to staging; returns (table, target) of what was delivered."""
        plan = control.load_plan(control.load_config(self.spark), self.watermark(), group, mode).collect()
        done = []
        for row in plan:  # one row per source table
            folder = f"{self.landing}/{row['copy_folder']}"
            try:
                df, state = landing.scan_or_empty(self.spark, folder, row["table_name"])
                seen = Observation()
                columns = [*source_schema(row["table_name"]).names, "_source_file"]
                staged = df.select(*columns).observe(seen, F.count(F.lit(1)).alias("rows"))
                if row["table_name"] in ("customers", "accounts"):
                    staged, columns = staged.withColumn("_load_ts", F.current_timestamp()), [*columns, "_load_ts"]
                tables.stage(staged, self.path("stg", row["table_name"]), columns)
                n = seen.get["rows"]
                self.log(source_table=row["table_name"], source_file=folder, rows_read=n, rows_written=n, status=state,
                         message=None if state == "Succeeded" else "folder not found")
            except Exception as e:
                self.log(source_table=row["table_name"], source_file=folder, status="Failed", message=str(e))
                raise
            if state == "Succeeded":
                done.append((row["table_name"], row["target"]))
        return done

    def load_dimensions(self) -> None:
        stg, gold, la = lambda t: self.read("stg", t), lambda t: self.read_or_none("gold", t), self.last_actual

        def put(table: str, df: DataFrame) -> DataFrame:
            return tables.full_reload(df, self.path("gold", table))

        put("dim_date", dims.date_dimension(self.spark, stg("uk_bank_holidays"), last_actual=la))
        regions = put("dim_region", dims.region_dimension(stg("regions"), gold("dim_region")))
        products = put("dim_product", dims.product_dimension(stg("products"), gold("dim_product")))
        put("dim_channel", dims.channel_dimension(stg("channels"), gold("dim_channel")))
        put("dim_complaint_category", dims.category_dimension(stg("complaint_categories"), gold("dim_complaint_category")))
        branches = put("dim_branch", dims.branch_dimension(stg("branches"), regions, la, gold("dim_branch")))
        clean = tables.create_table_as(dims.clean_customers(stg("customers")), self.path("silver", "customers"))
        for check, counts in [
            ("customer_duplicates", quality.duplicates(stg("customers"), ["customer_id"])),
            ("customer_region", quality.missing(clean, "region_code_src")),
            ("customer_postcode", quality.dirty_postcodes(clean)),
            ("customer_future", quality.future_dates(clean, "onboarding_date_src", la)),
        ]:
            self.log_dq(counts, layer="silver", table="customers", **quality.check(check))
        # Large dimensions are merged: buckets of rows that stay as they are keep their files, and marts see which changed.
        customers = tables.upsert_table(self.spark, dims.customer_dimension(clean, regions, branches, la, gold("dim_customer")),
                                        self.path("gold", "dim_customer"), ["CustomerID"])
        accounts = tables.create_table_as(dims.clean_accounts(stg("accounts")), self.path("silver", "accounts"))
        self.log_dq(quality.duplicates(stg("accounts"), ["account_id"]), layer="silver", table="accounts",
                    **quality.check("account_duplicates"))
        tables.merge(dims.account_dimension(accounts, customers, products, branches, gold("dim_account")), self.path("gold", "dim_account"), ["AccountID"])

    def load_rate(self) -> None:
        staged = landing.first_available(
            self.spark, f"{self.landing}/external/bank_rate/bank_rate.csv", f"{self.landing}/external/bank_rate_fallback")
        tables.full_reload(facts.policy_rate_daily(staged, self.first_month.replace(day=1)),
                           self.path("gold", "fact_bank_rate_daily"))

    def load_fact(self, table: str, target: str) -> None:
        staged = self.read("stg", table)
        if staged.isEmpty():
            return
        gold = lambda t: self.read("gold", t)
        customers = gold("dim_customer")
        path = self.path("gold", f"fact_{target}")
        month = F.max("month_end").alias("month_end")
        if target in ("deposit_balance", "loan_performance"):
            keys = facts.account_keys(gold("dim_account"), customers)
            loader = facts.deposit_balances if target == "deposit_balance" else facts.loan_performance
            tables.replace_periods(loader(staged, keys), path)
            if target == "deposit_balance":
                wrong = (F.col("avg_balance") < 0) & F.col("product_id").isin(*facts.SAVINGS_PRODUCTS)
                name, special = "FactDepositBalanceMonthly", {"negative_savings": wrong}
            else:
                name, special = "FactLoanPerformanceMonthly", {"missing_stage": F.col("ifrs9_stage").isNull()}
            counted = quality.fact_checks(staged, keys, "account_id", "month_end", special)
            checks = {"monthly_duplicates": "duplicates", **{c: c for c in special}, "account_orphans": "orphan_keys"}
            self.log_checks(table, counted, checks, name)
        elif target == "digital":
            tables.replace_periods(facts.digital_activity(staged, customers), path)
            known = customers.select(F.col("CustomerID").alias("customer_id"))
            self.log_checks(table, quality.fact_checks(staged, known, "customer_id", "month_end"), {"customer_orphans": "orphan_rows"}, "FactDigitalMonthly")
        elif target == "transactions":
            low, high = staged.agg(*[F.date_format(f("txn_date"), "yyyyMMdd").cast("int") for f in (F.min, F.max)]).first()
            rows = facts.daily_transactions(staged, gold("dim_region"), gold("dim_product"), gold("dim_channel"))
            tables.replace_range(rows, path, low, high)
            self.log_dq(quality.lower_case_codes(staged, "region_code"), layer="gold", table="FactTransactionDaily",
                        **quality.check("lower_case_region"))
            self.advance(table, staged.agg(F.max("txn_date").alias("month_end")))
        elif target == "branch_activity":
            low, high = staged.agg(*[F.date_format(f("month_end"), "yyyyMMdd").cast("int") for f in (F.min, F.max)]).first()
            tables.replace_range(facts.branch_activity(staged, gold("dim_branch")), path, low, high)
            self.advance(table, staged.agg(month))
        elif target == "complaints":
            rows = facts.complaint_rows(staged, customers, gold("dim_complaint_category"))
            tables.upsert_table(self.spark, rows, path, ["ComplaintID"])
            log = dict(layer="gold", table="FactComplaint")
            self.log_dq(quality.resolved_before_received(staged), **quality.check("resolved_early"), **log)
            self.log_dq(quality.late_arrivals(staged), **quality.check("late_arrivals"), **log)
            self.advance(table, staged.agg(month_end(F.to_date(F.max("received_date"))).alias("month_end")))
        elif target == "fraud":
            tables.upsert_table(self.spark, facts.fraud_rows(staged, customers), path, ["CaseID"])
            self.advance(table, staged.agg(month_end(F.to_date(F.max("reported_date"))).alias("month_end")))
        else:
            raise ValueError(f"no loader for {target}")

    def load_finance(self) -> None:
        gold = lambda t: self.read("gold", t)
        tables.full_reload(facts.budget_rows(self.read("stg", "budget_monthly"), gold("dim_region"), gold("dim_product")),
                           self.path("gold", "fact_budget_monthly"))
        tables.full_reload(facts.opex_rows(self.read("stg", "opex_monthly"), gold("dim_region")),
                           self.path("gold", "fact_opex_monthly"))

    def cover_facts(self) -> None:
        """Widen the calendar to whole years around every date that a fact carries."""
        dated = {"fact_complaints": ["ReceivedDateKey", "ResolvedDateKey"], "fact_fraud": ["ReportedDateKey"]}
        keys = None
        for table in tables.children(self.spark, f"{self.root}/gold"):
            found = self.read_or_none("gold", table) if table.startswith("fact_") else None
            for column in dated.get(table, ["DateKey"]) if found is not None else []:
                part = found.agg(F.min(column).alias("low"), F.max(column).alias("high"))
                keys = part if keys is None else keys.unionByName(part)
        if keys is None:
            return
        calendar = self.read("gold", "dim_date")
        first, last = calendar.agg(F.min("Date"), F.max("Date")).first()
        low, high = keys.agg(F.min(key_date("low")), F.max(key_date("high"))).first()
        if low is not None and (low < first or high > last):
            start, end = min(first, low.replace(month=1, day=1)), max(last, high.replace(month=12, day=31))
            tables.full_reload(dims.date_dimension(self.spark, self.read("stg", "uk_bank_holidays"), start, end, self.last_actual),
                               self.path("gold", "dim_date"))

    def build_marts(self) -> DataFrame:
        """All marts brought up to date (`refresh`: months that changed; the others as a whole); returns their row counts."""
        g, la = (lambda t: self.read("gold", t)), self.last_actual
        loan, prod = g("fact_loan_performance"), g("dim_product")
        followed = Refresh(self.spark, self.root, la, self.first_month).run(prod)
        built = {
            "fact_mortgage_maturity": marts.mortgage_maturity(loan, prod, la),
            "fact_bbl_vintage": marts.loan_vintage(g("dim_account"), loan, prod, la),
        }
        written = {t: tables.create_table_as(df, self.path("mart", t)) for t, df in built.items()}
        written |= {t: self.read("mart", t) for t in followed}
        stats = control.table_stats(self.spark, self._layers())
        written[STATS_TABLE] = tables.create_table_as(stats, self.path("mart", STATS_TABLE))
        return control.row_counts(written)

    def _layers(self) -> dict[str, dict[str, str]]:
        out: dict[str, dict[str, str]] = {}
        for layer in ("stg", "silver", "gold", "mart", "ops"):
            for table in tables.children(self.spark, f"{self.root}/{layer}"):
                path = self.path(layer, table)
                current = tables.current_folders(self.spark, path)
                if current:
                    out.setdefault(layer, {})[table] = current
        return out

    def load_all(self, mode: str = "FULL", attempt: str | None = None) -> DataFrame:
        """The whole load; returns the marts' row counts.

        A load that failed goes on with the step that failed when its `attempt` (named in the error's note) is given.
        """
        attempt = attempt or f"{self.run_id}-{uuid.uuid4().hex[:12]}"
        steps = control.Steps(self.spark, self.path("ops", "steps"), attempt)
        try:
            for group in (1, 2):
                steps.run(f"stage {group}", lambda: self.stage_group(group, "FULL"))
            steps.run("dimensions", self.load_dimensions)
            steps.run("rate", self.load_rate)
            for table, target in steps.run("stage 3", lambda: self.stage_group(3, mode)):
                steps.run(f"fact {target}", lambda: self.load_fact(table, target))
            steps.run("stage 4", lambda: self.stage_group(4, "FULL"))
            steps.run("finance", self.load_finance)
            steps.run("calendar", self.cover_facts)
            counts = steps.run("marts", lambda: [list(r) for r in self.build_marts().collect()])  # one row per mart
        except Exception as e:
            e.add_note(f"load_all({mode!r}, attempt={attempt!r}) goes on from here")
            raise
        return self.spark.createDataFrame([tuple(c) for c in counts], "mart_table string, row_count long")

    # -- reporting -----------------------------------------------------------------------------
    def model(self) -> Model:
        """The measure model over the loaded marts."""
        g, m = (lambda t: self.read("gold", t)), (lambda t: self.read("mart", t))
        dates, cust = dims.date_view(g("dim_date")), g("dim_customer")
        runs = control.pipeline_runs(self.read("ops", "run_log"))
        found = {
            "dim_date": dates, "all_dates": dates, "dim_region": g("dim_region"), "dim_product": g("dim_product"),
            "dim_channel": g("dim_channel"), "dim_complaint_category": g("dim_complaint_category"),
            "dim_branch": g("dim_branch"), **dims.static_dimensions(self.spark, cust),
            **{t: m(t) for t in ("fact_product_monthly", "fact_credit_risk_monthly", "fact_mortgage_repricing",
                                 "fact_bbl_vintage", "fact_customer_monthly", "fact_transactions_monthly", STATS_TABLE)},
            "fact_mortgage_maturity": flag_next_year(m("fact_mortgage_maturity"), self.last_actual),
            "fact_branch_monthly": g("fact_branch_activity"),
            "fact_complaint": facts.with_customer(g("fact_complaints"), cust, "Segment", "Brand"),
            "fact_fraud_case": facts.with_customer(g("fact_fraud"), cust, "Segment", "Brand", "AgeBand"),
            "fact_budget_monthly": g("fact_budget_monthly"), "fact_opex_monthly": g("fact_opex_monthly"),
            "fact_bank_rate_daily": g("fact_bank_rate_daily"), "pipeline_runs": runs, "last_load": latest_runs(runs),
            "data_quality_summary": control.dq_summary(self.read("ops", "dq_results")),
            "load_status": control.load_status(self.watermark(), control.load_config(self.spark)),
        }
        return Model(found, self.last_actual, build_registry())


STATS_TABLE = "platform_table_stats"
