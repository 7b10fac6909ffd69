"""Filed facts as known at a cut-off: landed JSON to rows, the latest and the comparable earlier fact of each kind, and ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Forms that count, and the concepts of each measure.
PERIODIC_FORMS = ("10-Q", "10-Q/A", "10-K", "10-K/A", "20-F", "20-F/A", "40-F", "40-F/A")
INSTANT = {
    "cash": ("CashAndCashEquivalentsAtCarryingValue", "CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents", "CashAndDueFromBanks"),
    "assets": ("Assets",),
    "liabilities": ("Liabilities",),
    "equity": ("StockholdersEquity", "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest"),
    "current_assets": ("AssetsCurrent",),
    "current_liabilities": ("LiabilitiesCurrent",),
    "long_term_debt": ("LongTermDebt", "LongTermDebtNoncurrent", "LongTermDebtAndFinanceLeaseObligationsCurrent", "LongTermDebtCurrent"),
    "shares_outstanding": ("CommonStockSharesOutstanding", "EntityCommonStockSharesOutstanding"),
}
DURATION = {
    "revenue": ("RevenueFromContractWithCustomerExcludingAssessedTax", "Revenues", "SalesRevenueNet"),
    "net_income": ("NetIncomeLoss", "ProfitLoss"),
    "operating_income": ("OperatingIncomeLoss",),
    "gross_profit": ("GrossProfit",),
    "operating_cash_flow": ("NetCashProvidedByUsedInOperatingActivities",),
    "capex": ("PaymentsToAcquirePropertyPlantAndEquipment", "PaymentsForProceedsFromOtherPropertyPlantAndEquipment"),
    "diluted_shares": ("WeightedAverageNumberOfDilutedSharesOutstanding",),
}
NAMESPACES = ("us-gaap", "dei", "ifrs-full")
#: Days of a quarter, a year, and what lies between (fixed values), with the preference among them.
QUARTER, ANNUAL, COMPARABLE, COMPARABLE_LENGTH, NEAR = (65, 125), (250, 410), (330, 400), 25, 10
FACT = "struct<val: double, start: string, `end`: string, filed: string, form: string, accn: string>"
COMPANY = f"struct<facts: map<string, map<string, struct<units: map<string, array<{FACT}>>>>>>"


def facts_from_json(landed: DataFrame, symbol: str = "symbol", payload: str = "payload") -> DataFrame:
    """Landed company JSON, one row per fact: symbol, concept, unit, val, start, end, filed, form, accn.

    A concept in several namespaces is taken from the first that has facts. Malformed dates and numbers become null.
    """
    company = landed.select(F.col(symbol).alias("symbol"), F.from_json(payload, COMPANY).alias("c"))
    spaces = company.select("symbol", F.explode("c.facts").alias("space", "concepts")).filter(F.col("space").isin(*NAMESPACES))
    concepts = spaces.select("symbol", "space", F.explode("concepts").alias("concept", "body"))
    rows = concepts.select("symbol", "space", "concept", F.explode("body.units").alias("unit", "facts")).select("symbol", "space", "concept", "unit", F.explode("facts").alias("f"))
    place = F.array_position(F.lit(list(NAMESPACES)), F.col("space"))
    first = F.min(place).over(Window.partitionBy("symbol", "concept"))
    day = lambda c: F.try_to_timestamp(F.substring(F.col(f"f.{c}"), 1, 10), F.lit("yyyy-MM-dd")).cast("date").alias(c)
    return rows.withColumn("_first", first).filter(place == F.col("_first")).select("symbol", "concept", "unit", "f.val", day("start"), day("end"), day("filed"), "f.form", "f.accn")


def period_kind(days: Column) -> Column:
    """quarter, annual, interim or other by length."""
    return F.when(days.between(*QUARTER), "quarter").when(days.between(*ANNUAL), "annual").when((days > QUARTER[1]) & (days < ANNUAL[0]), "interim").otherwise("other")


def _named(facts: DataFrame, cutoff: Column, measures: dict[str, tuple[str, ...]], instant: bool) -> DataFrame:
    names = F.create_map(*[F.lit(v) for name, concepts in measures.items() for c in concepts for v in (c, name)])
    known = facts.withColumn("name", F.try_element_at(names, F.col("concept"))).filter(F.col("name").isNotNull() & F.col("form").isin(*PERIODIC_FORMS) & F.col("val").isNotNull() & F.col("end").isNotNull() & (F.col("filed") < cutoff))
    return known.filter(F.col("start").isNull() if instant else F.col("start").isNotNull())


def latest_facts(facts: DataFrame, cutoff: Column) -> DataFrame:
    """(symbol, name, val, end, filed, form, accn, kind, prior): the latest fact of every measure filed strictly before the cut-off.

    Of durations that end within ten days of the last end, quarters go before years before the rest, then the later filing and
    the length nearer to the usual one; prior is the value of a period of about the same length a year before.
    """
    stand = _named(facts, cutoff, INSTANT, True).groupBy("symbol", "name").agg(F.max(F.struct("end", "filed", "accn", "val", "form")).alias("b"))
    stand = stand.select("symbol", "name", "b.val", "b.end", "b.filed", "b.form", "b.accn", F.lit(None).cast("string").alias("kind"), F.lit(None).cast("double").alias("prior"))
    spans = _named(facts, cutoff, DURATION, False).withColumn("days", F.datediff("end", "start")).withColumn("kind", period_kind(F.col("days")))
    preference = F.when(F.col("kind") == "quarter", 4).when(F.col("kind") == "annual", 3).when(F.col("kind") == "interim", 2).otherwise(1)
    away = F.abs(F.col("days") - F.when(F.col("kind") == "quarter", 90).otherwise(365))
    last = spans.withColumn("_last", F.max("end").over(Window.partitionBy("symbol", "name"))).filter(F.datediff("_last", "end") <= NEAR)
    best = last.groupBy("symbol", "name").agg(F.max(F.struct(preference.alias("p"), "filed", (-away).alias("away"), "end", "accn", "val", "form", "kind", "days")).alias("b"))
    met = best.select("symbol", "name", F.col("b.end").alias("_end"), F.col("b.days").alias("_days")).join(spans, ["symbol", "name"])
    before = met.filter(F.datediff("_end", "end").between(*COMPARABLE) & (F.abs(F.col("days") - F.col("_days")) <= COMPARABLE_LENGTH))
    prior = before.groupBy("symbol", "name").agg(F.max(F.struct("end", "filed", "accn", "val"))["val"].alias("prior"))
    flow = best.join(prior, ["symbol", "name"], "left").select("symbol", "name", "b.val", "b.end", "b.filed", "b.form", "b.accn", "b.kind", "prior")
    return stand.unionByName(flow)


def share(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)


def fundamentals(facts: DataFrame, cutoff: Column) -> DataFrame:
    """One row per symbol with at least three known results: measures, ratios, changes, runway, coverage and age."""
    found = latest_facts(facts, cutoff)
    at = lambda name, column="val": F.max(F.when(F.col("name") == name, F.col(column)))
    wide = found.groupBy("symbol").agg(
        *[at(n).alias(n) for n in (*INSTANT, *DURATION)], *[at(n, "prior").alias(f"prior_{n}") for n in ("revenue", "net_income", "diluted_shares")],
        F.coalesce(at("revenue", "kind"), at("net_income", "kind"), F.lit("unknown")).alias("period_kind"), F.max("filed").alias("available_from"), F.max("end").alias("report_period_end"),
    )
    c = F.col
    grown = lambda n: share(c(n) - c(f"prior_{n}"), F.abs(f"prior_{n}"))
    free = c("operating_cash_flow") - F.coalesce("capex", F.lit(0.0))
    months = F.when(c("period_kind") == "quarter", 3.0).when(c("period_kind") == "annual", 12.0).otherwise(6.0)
    margin, prior_margin = share(c("net_income"), c("revenue")), share(c("prior_net_income"), c("prior_revenue"))
    results = {
        "revenue_yoy": grown("revenue"), "net_margin": margin, "net_margin_yoy_delta": margin - prior_margin, "operating_margin": share(c("operating_income"), c("revenue")), "gross_margin": share(c("gross_profit"), c("revenue")),
        "net_income_change_symmetric": share(2 * (c("net_income") - c("prior_net_income")), F.abs("net_income") + F.abs("prior_net_income")), "diluted_shares_yoy": grown("diluted_shares"),
        "cash_to_assets": share(c("cash"), c("assets")), "liabilities_to_assets": share(c("liabilities"), c("assets")), "equity_to_assets": share(c("equity"), c("assets")), "debt_to_assets": share(c("long_term_debt"), c("assets")),
        "current_ratio": share(c("current_assets"), c("current_liabilities")), "free_cash_flow": free, "cash_runway_months": F.when(free < 0, c("cash") / -free * months),
    }
    counted = [*results, "operating_cash_flow", "cash", "long_term_debt", "assets", "liabilities", "equity", "shares_outstanding", "revenue"]
    out = wide.withColumns(results)
    coverage = sum((F.col(n).isNotNull().cast("int") for n in counted), F.lit(0))
    return out.withColumn("metric_coverage_count", coverage).withColumn("age_days", F.datediff(cutoff, "available_from")).filter("metric_coverage_count >= 3")


def risk_flags() -> Column:
    """Flags that several ratios together support: dilution, solvency; none where a ratio is missing."""
    dilution = F.col("diluted_shares_yoy") >= 0.20
    solvency = (F.col("cash_to_assets") <= 0.01) & (F.col("liabilities_to_assets") >= 1.0) & (F.col("equity_to_assets") <= 0.0)
    return F.array_compact(F.array(F.when(dilution, "dilution"), F.when(solvency, "solvency")))
