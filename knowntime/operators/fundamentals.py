"""Fundamentals as of the day they were public: facts, trailing flows, valuation, dividends, quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from knowntime.functions.scalars import clamp_knowledge, derive_ratios, null_implausible, safe_div, statutory_tax
from knowntime.operators.asof import Source, asof_join, asof_many, bucket_days_for
from knowntime.operators.pit import dedup_latest
from knowntime.operators.windows import cagr, growth_streak, over, prior_mean, trailing_sum


def coalesce_by_priority(facts: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Facts (keys, metric, priority, filed, value) as one wide row a key.

    Of the tags of a metric the one of lowest priority wins, then the one filed last.
    """
    best = dedup_latest(facts, [*keys, "metric"], [F.col("priority"), F.col("filed").desc(), F.col("value").desc()])
    wide = best.groupBy(*keys).pivot("metric", metrics).agg(F.first("value"))
    return wide.join(best.groupBy(*keys).agg(F.max("filed").alias("knowledge")), keys)


def financial_table(facts: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """The wide filing table with ratios; knowledge never precedes the period's end."""
    wide = coalesce_by_priority(facts, keys, metrics)
    return null_implausible(derive_ratios(wide)).withColumn("knowledge", clamp_knowledge(F.col("knowledge"), F.col("period_end")))


def quarters_of_year(annual: DataFrame, quarterly: DataFrame, days: int, strict: bool, columns: list[str]) -> DataFrame:
    """Each annual row with the quarterly rows whose period ends inside its window; ``q_`` marks the latter.

    An equi-join on ticker with the window as residual: a ticker has few filings.
    """
    q = quarterly.select("ticker", *[F.col(c).alias(f"q_{c}") for c in columns])
    gap = F.datediff(F.col("period_end"), F.col("q_period_end"))
    return annual.join(q, "ticker").where((gap < days) & (gap > 0 if strict else gap >= 0))


def implied_q4_eps(filings: DataFrame, days: int = 280, guard: float = 6.0) -> DataFrame:
    """The fourth quarter's EPS: the year less the three nearest quarters before its end.

    Needs three quarters, and is dropped where it is over ``guard`` times their mean size.
    """
    annual, quarterly = filings.where("form = '10-K'"), filings.where("form = '10-Q'")
    near = quarters_of_year(annual.select("ticker", "period_end", "known", "eps"), quarterly, days, True, ["period_end", "eps"])
    rank = F.row_number().over(Window.partitionBy("ticker", "period_end").orderBy(F.col("q_period_end").desc()))
    three = near.withColumn("_rank", rank).where("_rank <= 3").groupBy("ticker", "period_end", "known", "eps").agg(
        F.sum("q_eps").alias("three"), F.avg(F.abs("q_eps")).alias("size"), F.count("q_eps").alias("n"))
    q4 = three.where("n = 3").withColumn("eps", F.col("eps") - F.col("three"))
    return q4.where(F.abs("eps") <= guard * F.col("size")).select("ticker", "period_end", "known", "eps", F.lit("10-Q").alias("form"))


def ttm_eps(filings: DataFrame) -> DataFrame:
    """Four quarters of EPS in the order in which they became known."""
    rows = filings.where("form = '10-Q' and eps is not null")
    one = dedup_latest(rows, ["ticker", "known"], [F.col("period_end")])
    return one.withColumn("ttm_eps", trailing_sum(F.col("eps"), "ticker", ["known", "period_end"], 4, 4)).where("ttm_eps is not null").select("ticker", "known", "ttm_eps")


def ttm_flow(filings: DataFrame, metric: str, days: int = 370) -> DataFrame:
    """Four quarters of a flow in period order, fourth quarters implied from the year.

    A quarter is implied where exactly three quarters end within ``days`` before
    the year's end; it is known when the last of its parts is. Of several
    quarters that become known at once the latest period counts.
    """
    rows = filings.where(F.col(metric).isNotNull())
    annual, quarterly = rows.where("form = '10-K'"), rows.where("form = '10-Q'")
    near = quarters_of_year(annual.select("ticker", "period_end", "known", metric), quarterly, days + 1, False, ["period_end", "known", metric])
    implied = near.groupBy("ticker", "period_end", "known", metric).agg(F.sum(f"q_{metric}").alias("_three"), F.count(F.lit(1)).alias("_n"), F.max("q_known").alias("_last")).where("_n = 3")
    implied = implied.select("ticker", "period_end", F.greatest("known", "_last").alias("known"), (F.col(metric) - F.col("_three")).alias("_v"))
    every = quarterly.select("ticker", "period_end", "known", F.col(metric).alias("_v")).unionByName(implied)
    every = dedup_latest(every, ["ticker", "period_end"], [F.col("known").desc(), F.col("_v").desc()])
    rolled = every.withColumn(f"ttm_{metric}", trailing_sum(F.col("_v"), "ticker", "period_end", 4, 4)).where(F.col(f"ttm_{metric}").isNotNull())
    return dedup_latest(rolled, ["ticker", "known"], [F.col("period_end").desc()]).select("ticker", "known", "period_end", f"ttm_{metric}")


SHEET = ("shares", "total_equity", "lt_debt", "cash")
FLOWS = ("revenue", "fcf")


def valuations(bars: DataFrame, filings: DataFrame, min_bars: int = 5) -> DataFrame:
    """Every bar valued with what was known at its close.

    Trailing EPS, the latest balance sheet, the latest year and trailing revenue and
    free cash flow are carried to the bars in one as-of pass on knowledge; a
    trailing flow is preferred to the year's. Ratios outside their range are null.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy("ticker"))
    base = bars.withColumn("_n", n).where(F.col("_n") >= min_bars).drop("_n")
    base = base.withColumn("ttm_dividends", trailing_sum(F.coalesce("dividends", F.lit(0.0)), "ticker", "event", 252))
    filings = filings.withColumn("fcf", F.col("operating_cf") - F.abs("capex"))

    def timed(df):
        return df.withColumn("_k", F.col("known").cast("timestamp_ntz"))

    year = [*FLOWS, "operating_income", "depreciation"]
    sheet = timed(filings.where("shares is not null")).select("ticker", "_k", "period_end", *SHEET)
    annual = timed(filings.where("form = '10-K'")).select("ticker", "_k", "period_end", *[F.col(c).alias(f"year_{c}") for c in year])
    quarterly = filings.where("form = '10-Q'").select("ticker", "period_end", "known", "eps", "form")
    every_eps = ttm_eps(quarterly.unionByName(implied_q4_eps(filings).select("ticker", "period_end", "known", "eps", "form")))
    sources = [Source(timed(every_eps), "_k", ("ttm_eps",)), Source(sheet, "_k", SHEET, ("period_end",)), Source(annual, "_k", tuple(f"year_{c}" for c in year), ("period_end",))]
    sources += [Source(timed(ttm_flow(filings, c)), "_k", (f"ttm_{c}",)) for c in FLOWS]
    out = asof_many(base, sources, ["ticker"], "known", bucket_days=bucket_days_for(bars, "ticker", "event"))
    out = out.withColumnsRenamed({"shares": "shares_outstanding"}).withColumns({c: F.coalesce(f"ttm_{c}", f"year_{c}") for c in FLOWS})
    shares, close = F.col("shares_outstanding"), F.col("close")
    earned = F.coalesce("year_operating_income", F.lit(0.0)) + F.coalesce("year_depreciation", F.lit(0.0))
    out = out.withColumns({
        "market_cap": close * shares, "book_value_per_share": safe_div(F.col("total_equity"), shares), "revenue_per_share": safe_div(F.col("revenue"), shares),
        "fcf_per_share": safe_div(F.col("fcf"), shares), "ebitda": F.when(earned > 0, earned)})
    out = out.withColumn("enterprise_value", F.col("market_cap") + F.coalesce("lt_debt", F.lit(0.0)) - F.coalesce("cash", F.lit(0.0)))
    return out.withColumns({
        "pe_ttm": safe_div(close, F.col("ttm_eps"), 0, 500), "pb": safe_div(close, F.col("book_value_per_share"), 0, 100), "ps": safe_div(close, F.col("revenue_per_share"), 0, 200),
        "ev_ebitda": safe_div(F.col("enterprise_value"), F.col("ebitda"), 0, 300), "fcf_yield": safe_div(F.col("fcf_per_share"), close, -0.5, 0.5),
        "dividend_yield": safe_div(F.col("ttm_dividends"), close, 0, 0.5)})


def annual_eps(filings: DataFrame) -> DataFrame:
    """Quarterly EPS added up by the year of the period, of each period the version known last."""
    last = dedup_latest(filings.where("form = '10-Q'"), ["ticker", "period_end"], [F.col("known").desc(), F.col("eps").desc()])
    return last.groupBy("ticker", F.year("period_end").alias("year")).agg(F.sum("eps").alias("annual_eps"))


def dividend_table(bars: DataFrame, filings: DataFrame, min_bars: int = 200) -> DataFrame:
    """Yearly dividends per share with growth, streak, payout and payer flag; thin years are left out."""
    dps = bars.groupBy("ticker", F.year("event").alias("year")).agg(F.sum("dividends").cast("double").alias("annual_dps"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_bars).drop("_n")
    dps = dps.withColumns({f"dps_growth_{n}y": cagr(F.col("annual_dps"), "ticker", "year", n, positive_now=False) for n in (1, 3, 5)})
    dps = growth_streak(dps, "annual_dps", "ticker", "year", "consecutive_growth")
    both = dps.join(annual_eps(filings), ["ticker", "year"], "left")
    return both.withColumns({"payout_ratio": safe_div(F.col("annual_dps"), F.col("annual_eps"), 0, 2), "is_payer": (F.col("annual_dps") > 0).cast("int")})


def quality_table(filings: DataFrame, bars: DataFrame, least: float = 1e6) -> DataFrame:
    """Annual quality measures: returns on capital, growth, margins against their past, buybacks, consistency, yield at filing.

    Capital and EBITDA of at most ``least`` in size are no base for a ratio.
    """
    w = over("ticker", "period_end")
    k = derive_ratios(filings.where("form = '10-K'"))
    debt, cash = F.coalesce("lt_debt", F.lit(0.0)), F.coalesce("cash", F.lit(0.0))
    invested, earned = F.coalesce("total_equity", F.lit(0.0)) + debt - cash, F.coalesce("operating_income", F.lit(0.0)) + F.coalesce("depreciation", F.lit(0.0))
    k = k.withColumns({
        "roic": F.when(F.abs(invested) > least, safe_div(F.col("operating_income") * (1 - statutory_tax(F.year("period_end"))), invested, -1, 3)),
        "net_debt_ebitda": F.when(F.abs(earned) > least, safe_div(debt - cash, earned, -50, 50)), "_eps": safe_div(F.col("net_income"), F.col("shares"))})
    for metric, column, spans in (("revenue", "revenue", (1, 3, 5)), ("eps", "_eps", (1, 3))):
        k = k.withColumns({f"{metric}_cagr_{n}y": cagr(F.col(column), "ticker", "period_end", n, -0.8, 5) for n in spans})
    k = k.withColumn("gross_margin_3y_avg", prior_mean(F.col("gross_margin"), "ticker", "period_end", 3))
    k = k.withColumn("gross_margin_trend", F.col("gross_margin") - F.col("gross_margin_3y_avg"))
    before = F.lag("shares").over(w)
    k = k.withColumn("buyback_yield", safe_div(before - F.col("shares"), before, -0.5, 0.5))
    k = k.withColumn("_rose", (F.col("net_income") > F.lag("net_income").over(w)).cast("double"))
    k = k.withColumn("earnings_consistency_5y", F.avg("_rose").over(w.rowsBetween(-4, 0))).drop("_rose", "_eps")
    priced = asof_join(k, bars.select("ticker", "event", "close"), ["ticker"], "known", "event", ["close"], bucket_days=bucket_days_for(bars, "ticker", "event"))
    return priced.withColumn("fcf_yield_filing", safe_div(F.col("fcf"), F.col("close") * F.col("shares"), -1, 1))


def first_tag(facts: DataFrame, by: list[str]) -> DataFrame:
    """Facts (.., priority) of the first tag that a company uses at all: a whole tag counts, not one a period."""
    best = F.min("priority").over(Window.partitionBy(*by, "metric"))
    return facts.withColumn("_best", best).where("priority = _best").drop("_best")


def earnings_table(eps_facts: DataFrame, estimates: DataFrame, columns: list[str]) -> DataFrame:
    """EPS of proper periods, newest filing first, with implied fourth quarters and the estimates of the same period.

    ``eps_facts`` has (ticker, period_end, form, priority, filed, value).
    """
    own = first_tag(eps_facts.withColumn("metric", F.lit("eps")), ["ticker"])
    own = dedup_latest(own, ["ticker", "period_end", "form"], [F.col("filed").desc(), F.col("value").desc()])
    own = own.select("ticker", "period_end", "form", F.col("filed").alias("known"), F.col("value").alias("eps"), F.lit(False).alias("implied"))
    implied = implied_q4_eps(own).select("ticker", "period_end", "form", "known", F.round("eps", 4).alias("eps"), F.lit(True).alias("implied"))
    return attach_estimates(own.unionByName(implied), estimates, columns)


def attach_estimates(actuals: DataFrame, estimates: DataFrame, columns: list[str]) -> DataFrame:
    """Actuals with the estimates of the same period; either side may be missing."""
    return actuals.join(estimates.select("ticker", "period_end", *columns), ["ticker", "period_end"], "full")
