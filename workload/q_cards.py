"""Cards of the report pages, every KPI text, labels of a selection, drill-through of one region."""
from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ledgerlake.plans import reports
from ledgerlake.plans.measures import CUSTOMERS, KPIS
from ledgerlake.plans.model import Context, Filter, evaluate
from .q_marts import _BR, _CHG, _CI, _CIP, _CO, _COR, _CORP, _CU, _CUP, _FR, _NIM, _NIMP, _label, div
from .registry import query, r, res
from .sql import LAST
from .stored import Stored

YEAR, MONTH = reports.YEAR, reports.MONTH


def _change(now: str, before: str, factor: int) -> str:
    return f"({now} - coalesce({before}, 0)) * {factor}"


_NET, _NETP = "(ye.loan_eom - ye.ecl)", "(yep.loan_eom - yep.ecl)"
_PER_1000, _PER_1000P = div("co.n::DOUBLE / co.n_months", "cu.active::DOUBLE / 1000"), div("co.n_py::DOUBLE / co.n_months", "cup.active::DOUBLE / 1000")

#: KPI -> value in SQL, digits, percent, suffix, state by sign (None: always neutral)
_VALUES = {
    "NII YoY": (_CHG.format("yf.nii", "yp.nii"), 1, True, "vs PY", ">="),
    "NII vs Budget": (_CHG.format("yf.nii", "bud_y.b_nii"), 1, True, "vs budget", ">="),
    "NIM": (_change(_NIM, _NIMP, 10000), 0, False, "bps vs PY", ">="),
    "Fee Income YoY": (_CHG.format("yf.fees", "yp.fees"), 1, True, "vs PY", ">="),
    "Cost Income": (_change(_CI, _CIP, 100), 1, False, "pp vs PY", "<="),
    "Deposits YoY": (_CHG.format("ye.dep", "yep.dep"), 1, True, "vs PY", ">="),
    "Net Loans YoY": (_CHG.format(_NET, _NETP), 1, True, "vs PY", ">="),
    "New Lending YoY": (_CHG.format("yf.new_lending", "yp.new_lending"), 1, True, "vs PY", ">="),
    "Loan Book YoY": (_CHG.format("ye.loan_eom", "yep.loan_eom"), 1, True, "vs PY", ">="),
    "Arrears 90": (_change(div("ye.a90", "ye.loan_eom"), div("yep.a90", "yep.loan_eom"), 10000), 0, False, "bps vs PY", "<="),
    "Stage 2": (_change(div("ye.s2", "ye.loan_eom"), div("yep.s2", "yep.loan_eom"), 100), 1, False, "pp vs PY", "<="),
    "ECL Coverage": (_change(div("ye.ecl", "ye.loan_eom"), div("yep.ecl", "yep.loan_eom"), 10000), 0, False, "bps vs PY", None),
    "Cost of Risk": (_change(_COR, _CORP, 10000), 0, False, "bps vs PY", "<="),
    "Active Customers YoY": (_CHG.format("cu.active", "cup.active"), 1, True, "vs PY", ">="),
    "Digital Share": (_change(div("cu.mau", "cu.active"), div("cup.mau", "cup.active"), 100), 1, False, "pp vs PY", ">="),
    "App Users YoY": (_CHG.format("cu.mau", "cup.mau"), 1, True, "vs PY", ">="),
    "Branches": ("CASE WHEN coalesce(br.open_n, br.open_py) IS NOT NULL THEN (coalesce(br.open_n, 0) - coalesce(br.open_py, 0))::DOUBLE END", 0, False, "branches vs PY", None),
    "Complaints": (_change(_PER_1000, _PER_1000P, 1), 2, False, "vs PY", "<="),
    "APP Reimbursement": (_change(div("fr.back", "fr.scam"), div("fr.back_py", "fr.scam_py"), 100), 1, False, "pp vs PY", ">="),
}
_CARDS = {
    "NII": "yf.nii", "NIM": _NIM, "Fee Income": "yf.fees", "Cost Income Ratio": _CI, "Customer Deposits": "ye.dep", "Net Loans": _NET,
    "Gross New Lending": "yf.new_lending", "Loan Book": "ye.loan_eom", "Arrears 90+ Rate": div("ye.a90", "ye.loan_eom"),
    "Stage 2 Share": div("ye.s2", "ye.loan_eom"), "ECL Coverage": div("ye.ecl", "ye.loan_eom"), "Cost of Risk": _COR,
    "Active Customers": "cu.active", "Digital Active Share": div("cu.mau", "cu.active"), "App Monthly Users": "cu.mau", "Open Branches": "br.open_n",
    "Complaints per 1000 Customers": _PER_1000, "APP Reimbursement Rate": div("fr.back", "fr.scam"),
}
_FROM = f"""FROM years JOIN yf ON yf.y = years.y JOIN ye ON ye.y = years.y JOIN opex_y oy ON oy.y = years.y LEFT JOIN yp ON yp.y = years.y LEFT JOIN yep ON yep.y = years.y
LEFT JOIN yo ON yo.y = years.y LEFT JOIN yo yop ON yop.y = years.y - 1 LEFT JOIN bud_y ON bud_y.y = years.y LEFT JOIN opex_p op ON op.y = years.y
LEFT JOIN {_CU} cu ON cu.y = years.y LEFT JOIN {_CUP} cup ON cup.y = years.y LEFT JOIN {_BR} br ON br.y = years.y LEFT JOIN {_CO} co ON co.y = years.y
LEFT JOIN {_FR} fr ON fr.y = years.y"""
_COUNTS = ("Active Customers", "App Monthly Users", "Open Branches")


def _short(name: str) -> str:
    return name.lower().replace(" ", "_").replace("+", "")


def _texts(kpis: list[str], name) -> str:
    out = []
    for k in kpis:
        _, digits, percent, suffix, sign = _VALUES[k]
        v = f"k_{_short(k)}"
        state = f"CASE WHEN {v} IS NULL THEN 'neutral' WHEN {v} {sign} 0 THEN 'good' ELSE 'bad' END" if sign else "'neutral'"
        out += [f"{_label(v, digits, percent, suffix)} AS {name(k, 'Label')}", f"{state} AS {name(k, 'Colour')}"]
    return ", ".join(out)


def _inner(cards: list[str], kpis: list[str]) -> str:
    return ", ".join(["years.y", *[f"{_CARDS[c]} AS c_{_short(c)}" for c in cards], *[f"{_VALUES[k][0]} AS k_{_short(k)}" for k in kpis]])


def _page_sql(cards: list[str], kpis: list[str]) -> str:
    shown = ", ".join(f"c_{_short(c)} AS {_short(c)}" if c in _COUNTS else r(f"c_{_short(c)}", _short(c)) for c in cards)
    texts = _texts(kpis, lambda k, part: f"{_short(k)}_{'label' if part == 'Label' else 'state'}")
    return f"SELECT y AS year_no, {shown}, {texts} FROM (SELECT {_inner(cards, kpis)} {_FROM}) v"


def _page(d, cards: list[str], kpis: list[str]):
    texts = {f"{_short(k)}_{short}": f"{k} {part}" for k in kpis for part, short in (("Label", "label"), ("Colour", "state"))}
    return res(d, year_no="Year", **{_short(c): c for c in cards}, **texts)


@query("profit_cards", _page_sql(reports.PROFIT_CARDS, reports.PROFIT_KPIS))
def profit_cards(x):
    return _page(reports.profit_cards(x.model, axis=[YEAR]), reports.PROFIT_CARDS, reports.PROFIT_KPIS)


@query("credit_cards", _page_sql(reports.CREDIT_CARDS, reports.CREDIT_KPIS))
def credit_cards(x):
    return _page(reports.credit_cards(x.model, axis=[YEAR]), reports.CREDIT_CARDS, reports.CREDIT_KPIS)


@query("customer_cards", _page_sql(reports.CUSTOMER_CARDS, reports.CUSTOMER_KPIS))
def customer_cards(x):
    return _page(reports.customer_cards(x.model, axis=[YEAR]), reports.CUSTOMER_CARDS, reports.CUSTOMER_KPIS)


_NAMES = [k[0] for k in KPIS]


@query("all_kpi_labels", f"""SELECT {_texts(_NAMES, lambda k, part: f'"{k} {part}"')} FROM (SELECT {_inner([], _NAMES)} {_FROM}) v WHERE y = 2000""")
def all_kpi_labels(x):
    """Every KPI card of the report for one year."""
    names = [f"{k} {part}" for k in _NAMES for part in ("Label", "Colour")]
    stored = Stored(x.spark, x.dir)
    return evaluate(replace(stored.model, store=stored.put), Context((reports.one_of("dim_date", "Year", 2000),)), [], names)


@query("scam_losses", f"""
SELECT y AS year_no, {r('scam', 'loss')}, {r('back', 'reimbursed')}, {r(div('back', 'scam'), 'rate')} FROM {_FR} f WHERE scam IS NOT NULL""")
def scam_losses(x):
    return res(reports.scam_losses(x.model), year_no="Year", loss="APP Scam Losses", reimbursed="APP Scam Reimbursed", rate="APP Reimbursement Rate")


# ---------------------------------------------------------------- labels of a selection

_PICKED = "(SELECT min(last_day(o_orderdate)) AS low, max(last_day(o_orderdate)) AS high FROM orders WHERE o_orderstatus = 'P')"


@query("selection_labels", f"""
SELECT year(month_end) AS year_no, g.region_name, {r('sum(interest_income - ftp_charge + ftp_credit - interest_expense)', 'nii')},
  concat(strftime(greatest(make_date(year(month_end), 1, 1), date_trunc('month', any_value(low))), '%b %Y'), ' to ',
    strftime(least(make_date(year(month_end), 12, 31), any_value(high), {LAST}), '%b %Y')) AS period_label,
  concat(g.region_name, ' | Regional Director: Director ', g.region_key - 1) AS region_title
FROM pnl JOIN regions_named g USING (region_key) JOIN {_PICKED} p ON month_end BETWEEN low AND high GROUP BY year(month_end), g.region_name, g.region_key""")
def selection_labels(x):
    """Period and region texts over the months in which orders were in progress, beside the income that the selection shows."""
    month = F.last_day(F.col("o_orderdate").cast("date"))
    low, high = x.t("orders").where("o_orderstatus = 'P'").agg(F.min(month), F.max(month)).first()
    ctx = Context((Filter("dim_date", "MonthEnd", lambda c: c.between(F.lit(low), F.lit(high))),))
    d = reports.report(x.model, ctx, [YEAR, reports.REGION], ["NII", "Selected Period Label", "Selected Region Title"], having=reports.not_blank("NII"))
    return res(d, year_no="Year", region_name="RegionName", nii="NII", period_label="Selected Period Label", region_title="Selected Region Title")


# ---------------------------------------------------------------- one region


@query("region_trends", f"""
SELECT ym AS year_month, 'Europe | Regional Director: Director ' || (SELECT region_key - 1 FROM regions_named WHERE region_name = 'Europe') AS title,
  {r('nii', 'nii')}, {r('b_nii', 'nii_budget')}, {r(div('s1', 'loan'), 'stage1')}, {r(div('s2', 'loan'), 'stage2')}, {r(div('s3', 'loan'), 'stage3')},
  {r('share', 'digital_share')}, {r('share_all', 'digital_share_all')}
FROM (SELECT ym, me, least(me, {LAST}) AS pe FROM cells) t
LEFT JOIN (SELECT month_end AS me, sum(interest_income - ftp_charge + ftp_credit - interest_expense) AS nii
    FROM pnl JOIN regions_named USING (region_key) WHERE region_name = 'Europe' GROUP BY 1) n USING (me)
LEFT JOIN (SELECT month_end AS pe, sum(s1) AS s1, sum(s2) AS s2, sum(s3) AS s3, sum(CASE WHEN product_id >= 'P04' THEN eom_balance END) AS loan
    FROM pnl JOIN regions_named USING (region_key) WHERE region_name = 'Europe' GROUP BY 1) p USING (pe)
LEFT JOIN (SELECT month_end AS me, sum(b_nii) AS b_nii FROM budget JOIN regions_named USING (region_key) WHERE region_name = 'Europe' AND month_end <= {LAST} GROUP BY 1) b USING (me)
LEFT JOIN (SELECT month_end AS pe, sum(mau) FILTER (region_name = 'Europe')::DOUBLE / nullif(sum(active) FILTER (region_name = 'Europe'), 0) AS share, sum(mau)::DOUBLE / nullif(sum(active), 0) AS share_all
    FROM custm JOIN regions_named USING (region_key) GROUP BY 1) c USING (pe)""")
def region_trends(x):
    """The drill-through's title and its three monthly visuals for one region; balances stay as they were after the last actual month."""
    stored = Stored(x.spark, x.dir)
    model = replace(stored.model, store=stored.put)
    model.tables[CUSTOMERS] = stored.put(model.tables[CUSTOMERS])  # read twice, with and without the region
    title = reports.region_scorecard(stored.model, "Europe")["title"]
    d = reports.region_months(model, "Europe").withColumn("title", title.select("Selected Region Title").scalar())
    return res(d, year_month="YearMonth", title="title", nii="NII", nii_budget="NII Budget", stage1="Stage 1 Share", stage2="Stage 2 Share",
               stage3="Stage 3 Share", digital_share="Digital Active Share", digital_share_all="Digital Active Share UK")
