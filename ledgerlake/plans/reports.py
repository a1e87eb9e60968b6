"""Report queries: slicer context x axis x measures x visual filter x order.

`report` is the one operator; the functions below it are the report's named visuals.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.amounts import spread_point
from ..operators.groups import share_of_total, top_categories, unpivot_steps
from .measures import STATS
from .model import DATE, Context, Filter, Model, evaluate, one_of

MONTH = f"{DATE}.YearMonth"
MONTH_START = f"{DATE}.MonthStart"
YEAR = f"{DATE}.Year"
REGION = "dim_region.RegionName"


def report(model: Model, ctx: Context, axis: Sequence[str], measures: Sequence[str],
           having: Column | None = None, order: Sequence[Column] = ()) -> DataFrame:
    """One visual. `having` filters on measures after aggregation (e.g. not blank)."""
    out = evaluate(model, ctx, axis, measures)
    if having is not None:
        out = out.filter(having)
    return out.orderBy(*order) if order else out


def not_blank(measure: str) -> Column:
    return F.col(f"`{measure}`").isNotNull()


def without_date_slicers(ctx: Context) -> Context:
    """Visuals that ignore the year and month slicers."""
    return ctx.clear(DATE)


def slicer_values(model: Model) -> dict[str, DataFrame]:
    """Choices of the five slicers."""
    columns = {"year": (DATE, "Year"), "month": (DATE, "MonthShort"), "region": ("dim_region", "RegionName"),
               "segment": ("dim_segment", "Segment"), "brand": ("dim_brand", "Brand")}
    out = {}
    for name, (table, column) in columns.items():
        if name == "month":  # month names in calendar order
            out[name] = model.tables[table].select("Month", column).distinct().orderBy("Month").select(column)
        else:
            out[name] = model.tables[table].select(column).distinct().orderBy(column)
    return out


HOME_CARDS = ["NII", "NIM", "Active Customers"]
PROFIT_CARDS = ["NII", "NIM", "Fee Income", "Cost Income Ratio", "Customer Deposits", "Net Loans"]
CREDIT_CARDS = ["Gross New Lending", "Loan Book", "Arrears 90+ Rate", "Stage 2 Share", "ECL Coverage", "Cost of Risk"]
CUSTOMER_CARDS = ["Active Customers", "Digital Active Share", "App Monthly Users", "Open Branches",
                  "Complaints per 1000 Customers", "APP Reimbursement Rate"]
PLATFORM_CARDS = ["Rows in Warehouse", "Data As Of", "Pipeline Success Rate", "Last Load Duration min",
                  "DQ Issues Fixed", "Tables Monitored"]


#: The KPI that stands below each card of a page, in the order of the cards.
PROFIT_KPIS = ["NII YoY", "NIM", "Fee Income YoY", "Cost Income", "Deposits YoY", "Net Loans YoY"]
CREDIT_KPIS = ["New Lending YoY", "Loan Book YoY", "Arrears 90", "Stage 2", "ECL Coverage", "Cost of Risk"]
CUSTOMER_KPIS = ["Active Customers YoY", "Digital Share", "App Users YoY", "Branches", "Complaints", "APP Reimbursement"]


def cards(model: Model, ctx: Context, names: Sequence[str], kpis: Sequence[str] = (), axis: Sequence[str] = ()) -> DataFrame:
    """One row of headline values, with label and state of the given KPIs; with an axis, one row for each of its values."""
    labels = [f"{k} {part}" for k in kpis for part in ("Label", "Colour")]
    return report(model, ctx, axis, [*names, *labels])


def profit_cards(model: Model, ctx: Context = Context(), axis: Sequence[str] = ()) -> DataFrame:
    return cards(model, ctx, PROFIT_CARDS, PROFIT_KPIS, axis)


def credit_cards(model: Model, ctx: Context = Context(), axis: Sequence[str] = ()) -> DataFrame:
    return cards(model, ctx, CREDIT_CARDS, CREDIT_KPIS, axis)


def customer_cards(model: Model, ctx: Context = Context(), axis: Sequence[str] = ()) -> DataFrame:
    return cards(model, ctx, CUSTOMER_CARDS, CUSTOMER_KPIS, axis)


def home(model: Model, year: int) -> DataFrame:
    return cards(model, Context((one_of(DATE, "Year", year),)), HOME_CARDS)


def nii_by_month(model: Model, ctx: Context = Context()) -> DataFrame:
    return report(model, ctx, [MONTH], ["NII", "NII Budget"], order=[F.asc("YearMonth")])


def nim_against_rate(model: Model, ctx: Context = Context()) -> DataFrame:
    return report(model, without_date_slicers(ctx), [MONTH_START], ["NIM", "Bank Rate"], having=not_blank("NIM"))


def nii_bridge(model: Model, ctx: Context = Context()) -> DataFrame:
    """Waterfall rows in step order; the residual step is not shown."""
    parts = evaluate(model, ctx, [], ["NII PY", "Bridge Volume Effect", "Bridge Margin Effect", "Bridge Other"])
    steps = [(1, "Prior year NII", "NII PY"), (2, "Volume", "Bridge Volume Effect"),
             (3, "Margin", "Bridge Margin Effect"), (4, "Other", "Bridge Other")]
    return unpivot_steps(parts, [], steps).filter(F.col("step") != "Other").orderBy("step_order")


def deposit_mix(model: Model, ctx: Context = Context()) -> DataFrame:
    """Deposits by year and product with each product's share of its year."""
    ctx = without_date_slicers(ctx).keep(one_of("dim_product", "ProductGroup", "Deposits"))
    rows = report(model, ctx, [YEAR, "dim_product.ProductName"], ["Customer Deposits"])
    return share_of_total(rows, ["Year"], "Customer Deposits", "share")


def budget_delivery(model: Model, ctx: Context = Context()) -> DataFrame:
    return report(model, ctx, [REGION], ["NII vs Budget %", "NII", "NII Budget", "NII vs Budget", "Budget Variance Colour"],
                  having=not_blank("NII"), order=[F.desc("NII vs Budget %"), F.asc("RegionName")])


def stage_trend(model: Model, ctx: Context = Context()) -> DataFrame:
    names = ["Stage 2 Share", "Stage 3 Share", "Stage 2 Balance", "Stage 3 Balance", "Gross New Lending"]
    return report(model, ctx, [MONTH], names, having=not_blank("Gross New Lending")).drop("Gross New Lending")


def maturity_wall(model: Model, ctx: Context = Context()) -> DataFrame:
    return report(model, ctx, ["fact_mortgage_maturity.DealEndQuarter", "fact_mortgage_maturity.CurrentRateBand"],
                  ["Maturing Fixed Balance", "Maturing Avg Current Rate", "Payment Shock %"],
                  having=not_blank("Maturing Fixed Balance"))


def arrears_by_product(model: Model, first, last, ctx: Context = Context()) -> DataFrame:
    ctx = ctx.keep(Filter(DATE, "MonthStart", lambda c: c.between(F.lit(first), F.lit(last)))).keep(
        one_of("dim_product", "ProductGroup", "Lending"))
    return report(model, ctx, [MONTH, "dim_product.ProductName"], ["Arrears 90+ Rate"])


def risk_heatmap(model: Model, bands: Sequence[str], ctx: Context = Context()) -> DataFrame:
    """90+ rate, LTV band by score band in score order."""
    ctx = ctx.keep(Filter("fact_credit_risk_monthly", "LTVBand", lambda c: c != "n/a"))
    rows = report(model, ctx, ["fact_credit_risk_monthly.LTVBand", "dim_score_band.CreditScoreBand"], ["Risk 90+ Rate"])
    return rows.groupBy("LTVBand").pivot("CreditScoreBand", list(bands)).agg(F.max("Risk 90+ Rate"))


def vintage_curve(model: Model, limit: int = 66, ctx: Context = Context()) -> DataFrame:
    ctx = without_date_slicers(ctx).keep(Filter("fact_bbl_vintage", "MonthsOnBook", lambda c: c <= limit))
    return report(model, ctx, ["fact_bbl_vintage.MonthsOnBook", "fact_bbl_vintage.VintageQuarter"],
                  ["BBL Cumulative Default Rate"])


def branch_and_app_index(model: Model, ctx: Context = Context()) -> DataFrame:
    return report(model, ctx, [MONTH], ["Open Branches Index", "App Monthly Users Index", "Gross New Lending"],
                  having=not_blank("Gross New Lending")).drop("Gross New Lending")


def channel_mix(model: Model, ctx: Context = Context()) -> DataFrame:
    ctx = ctx.keep(Filter("dim_channel", "ChannelGroup", lambda c: ~c.isin("Automated")))
    rows = report(model, ctx, [YEAR, "dim_channel.ChannelGroup"], ["Transactions"])
    return share_of_total(rows, ["Year"], "Transactions", "share")


def complaints_by_category(model: Model, ctx: Context = Context()) -> DataFrame:
    return report(model, ctx, ["dim_complaint_category.CategoryName"],
                  ["Complaints", "Resolved Within 8 Weeks %", "Upheld %"],
                  order=[F.desc("Complaints"), F.asc("CategoryName")])


def scam_losses(model: Model, ctx: Context = Context()) -> DataFrame:
    """Scam losses, what was paid back of them and the rate, by year."""
    return report(model, without_date_slicers(ctx), [YEAR], ["APP Scam Losses", "APP Scam Reimbursed", "APP Reimbursement Rate"],
                  having=not_blank("APP Scam Losses"), order=[F.asc("Year")])


def branch_points(branches: DataFrame) -> DataFrame:
    """Map points: spread position and state with the first name, city and closure date there."""
    lat, lon = spread_point("Latitude", "Longitude", "BranchKey")
    return branches.groupBy(F.round(lat, 6).alias("lat"), F.round(lon, 6).alias("lon"), "BranchStatus").agg(
        F.min("BranchName").alias("BranchName"), F.min("City").alias("City"), F.min("ClosureDate").alias("ClosureDate"))


def rows_by_table(model: Model, n: int = 10) -> DataFrame:
    """Rows and MB by table and layer for the n largest tables."""
    stats = top_categories(model.tables[STATS], "table_name", F.sum("row_count"), n)
    sub = Model({**model.tables, STATS: stats}, model.last_actual, model.measures, model.index_base)
    return report(sub, Context(), [f"{STATS}.table_name", f"{STATS}.layer"], ["Rows All Layers", "Warehouse Size MB"])


def run_list(runs: DataFrame) -> DataFrame:
    return runs.groupBy("activity", "source_table", "status", "ended_at_utc").agg(
        F.sum("rows_written").alias("rows_written")).orderBy(F.desc("ended_at_utc"), "source_table")


def dq_list(summary: DataFrame) -> DataFrame:
    return summary.groupBy("layer", "table_name", "check_name", "severity", "action_taken").agg(
        F.sum("affected_rows").alias("affected_rows")).orderBy(F.desc("affected_rows"), "table_name", "check_name")


REGION_VISUALS = {"nii": ["NII", "NII Budget"], "stages": ["Stage 1 Share", "Stage 2 Share", "Stage 3 Share"],
                  "digital": ["Digital Active Share", "Digital Active Share UK"]}


def region_months(model: Model, region: str, ctx: Context = Context()) -> DataFrame:
    """The monthly visuals of the drill-through side by side, from one evaluation: one read of each mart gives them all."""
    here = ctx.replace(one_of("dim_region", "RegionName", region))
    return report(model, here, [MONTH], [m for names in REGION_VISUALS.values() for m in names])


def region_scorecard(model: Model, region: str, ctx: Context = Context()) -> dict[str, DataFrame]:
    """Drill-through for one region."""
    here = ctx.replace(one_of("dim_region", "RegionName", region))
    return {
        "title": evaluate(model, here, [], ["Selected Region Title"]),
        "nii": nii_by_month(model, here),
        "products": report(model, here, ["dim_product.ProductName"],
                           ["Loan Book", "Customer Deposits", "NII", "Arrears 90+ Rate"]),
        "stages": report(model, here, [MONTH], REGION_VISUALS["stages"]),
        "digital": evaluate(model, here, [MONTH], REGION_VISUALS["digital"]),
    }
