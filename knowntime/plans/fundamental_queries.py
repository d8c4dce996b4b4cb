"""Filings, trailing flows, valuation, dividends and quality."""

import re

from pyspark.sql import functions as F

from knowntime.operators import fundamentals as X
from knowntime.plans.proxies import BARS, FIN, bars, financials, table, stored
from knowntime.plans.registry import query

IMPLIED_EPS = """near AS (SELECT a.ticker, a.period_end, a.known, a.eps, q.eps AS q_eps, row_number() OVER (PARTITION BY a.ticker, a.period_end ORDER BY q.period_end DESC) AS r
  FROM fin a JOIN fin q ON a.ticker = q.ticker AND a.form = '10-K' AND q.form = '10-Q' AND q.period_end < a.period_end AND q.period_end > a.period_end - 280),
q4 AS (SELECT ticker, period_end, known, eps - sum(q_eps) AS eps FROM near WHERE r <= 3 GROUP BY ticker, period_end, known, eps HAVING count(q_eps) = 3 AND abs(eps - sum(q_eps)) <= 6 * avg(abs(q_eps)))"""

TTM_EPS = """eps0 AS (SELECT ticker, period_end, known, eps FROM fin WHERE form = '10-Q' UNION ALL SELECT ticker, period_end, known, eps FROM q4),
eps1 AS (SELECT * FROM eps0 WHERE eps IS NOT NULL QUALIFY row_number() OVER (PARTITION BY ticker, known ORDER BY period_end) = 1),
teps AS (SELECT * FROM (SELECT ticker, known, CASE WHEN count(*) OVER w = 4 THEN sum(eps) OVER w END AS ttm_eps FROM eps1 WINDOW w AS (PARTITION BY ticker ORDER BY known, period_end ROWS 3 PRECEDING)) WHERE ttm_eps IS NOT NULL)"""


def flow(metric):
    return f"""imp AS (SELECT a.ticker, a.period_end, greatest(a.known, max(q.known)) AS known, a.{metric} - sum(q.{metric}) AS v
  FROM fin a JOIN fin q ON a.ticker = q.ticker AND a.form = '10-K' AND q.form = '10-Q' AND q.period_end <= a.period_end AND q.period_end >= a.period_end - 370 GROUP BY a.ticker, a.period_end, a.known, a.{metric} HAVING count(*) = 3),
every AS (SELECT * FROM (SELECT ticker, period_end, known, {metric} AS v FROM fin WHERE form = '10-Q' UNION ALL SELECT * FROM imp) QUALIFY row_number() OVER (PARTITION BY ticker, period_end ORDER BY known DESC, v DESC) = 1),
rolled AS (SELECT ticker, period_end, known, CASE WHEN count(*) OVER w = 4 THEN sum(v) OVER w END AS ttm FROM every WINDOW w AS (PARTITION BY ticker ORDER BY period_end ROWS 3 PRECEDING)),
ttm AS (SELECT * FROM rolled WHERE ttm IS NOT NULL QUALIFY row_number() OVER (PARTITION BY ticker, known ORDER BY period_end DESC) = 1)"""


@query("c5_coalesce_by_priority", """
WITH f AS (SELECT l_suppkey AS ticker, last_day(l_shipdate::DATE) AS period_end, CASE WHEN l_returnflag = 'R' THEN 'revenue' ELSE 'cost' END AS metric, l_linenumber AS priority, l_shipdate::DATE AS filed, l_extendedprice AS value FROM lineitem),
b AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY ticker, period_end, metric ORDER BY priority, filed DESC, value DESC) = 1)
SELECT ticker, period_end, max(value) FILTER (WHERE metric = 'revenue') AS revenue, max(value) FILTER (WHERE metric = 'cost') AS cost, max(filed) AS knowledge FROM b GROUP BY 1, 2""")
def c5(spark, sf):
    f = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("ticker"), F.last_day("l_shipdate").alias("period_end"), F.when(F.col("l_returnflag") == "R", "revenue").otherwise("cost").alias("metric"),
        F.col("l_linenumber").alias("priority"), F.col("l_shipdate").cast("date").alias("filed"), F.col("l_extendedprice").alias("value"))
    return X.coalesce_by_priority(f, ["ticker", "period_end"], ["revenue", "cost"])


@query("c7_quarters_of_year", f"""WITH {FIN} SELECT a.ticker, a.period_end, q.period_end AS q_period_end, round(q.revenue, 4) AS q_revenue
FROM fin a JOIN fin q ON a.ticker = q.ticker AND a.form = '10-K' AND q.form = '10-Q' AND q.period_end <= a.period_end AND q.period_end > a.period_end - 370""")
def c7(spark, sf):
    f = financials(spark, sf)
    out = X.quarters_of_year(f.where("form = '10-K'").select("ticker", "period_end"), f.where("form = '10-Q'"), 370, False, ["period_end", "revenue"])
    return out.withColumn("q_revenue", F.round("q_revenue", 4))


@query("e8_implied_q4_eps", f"WITH {FIN}, {IMPLIED_EPS} SELECT ticker, period_end, known, round(eps, 4) AS eps FROM q4")
def e8(spark, sf):
    return X.implied_q4_eps(financials(spark, sf)).select("ticker", "period_end", "known", F.round("eps", 4).alias("eps"))


@query("e6_ttm_eps", f"WITH {FIN}, {IMPLIED_EPS}, {TTM_EPS} SELECT ticker, known, round(ttm_eps, 4) AS ttm_eps FROM teps")
def e6(spark, sf):
    f = financials(spark, sf)
    q4 = X.implied_q4_eps(f)
    return X.ttm_eps(f.where("form = '10-Q'").select("ticker", "period_end", "known", "eps", "form").unionByName(q4)).withColumn("ttm_eps", F.round("ttm_eps", 4))


@query("e7_ttm_flow", f"WITH {FIN}, {flow('revenue')} SELECT ticker, known, period_end, round(ttm, 4) AS ttm_revenue FROM ttm")
def e7(spark, sf):
    return X.ttm_flow(financials(spark, sf), "revenue").withColumn("ttm_revenue", F.round("ttm_revenue", 4))


def trailing(metric):
    """The CTEs of :func:`flow` under names of the metric's own."""
    out = flow(metric)
    for name in ("imp", "every", "rolled", "ttm"):
        out = re.sub(rf"\b{name}\b(?! AS ttm)", f"{name}_{metric}", out)
    return out.replace(f"END AS ttm_{metric}", "END AS ttm").replace(f"ttm_{metric} IS NOT NULL", "ttm IS NOT NULL")


@query("f1_valuations", f"""WITH {BARS}, {FIN}, {IMPLIED_EPS}, {TTM_EPS}, {trailing('revenue')}, {trailing('fcf')},
b AS (SELECT *, sum(dividends) OVER (PARTITION BY ticker ORDER BY event ROWS 251 PRECEDING) AS ttm_dividends FROM bars QUALIFY count(*) OVER (PARTITION BY ticker) >= 5),
sheet AS (SELECT ticker, known, shares, total_equity, lt_debt, cash FROM fin QUALIFY row_number() OVER (PARTITION BY ticker, known ORDER BY period_end DESC) = 1),
yr AS (SELECT ticker, known, revenue, fcf, operating_income, depreciation FROM fin WHERE form = '10-K'),
j1 AS (SELECT b.*, e.ttm_eps FROM b ASOF LEFT JOIN teps e ON b.ticker = e.ticker AND b.known >= e.known),
j2 AS (SELECT j1.*, s.shares, s.total_equity, s.lt_debt, s.cash FROM j1 ASOF LEFT JOIN sheet s ON j1.ticker = s.ticker AND j1.known >= s.known),
j3 AS (SELECT j2.*, y.revenue AS yr_rev, y.fcf AS yr_fcf, coalesce(y.operating_income, 0) + coalesce(y.depreciation, 0) AS earned FROM j2 ASOF LEFT JOIN yr y ON j2.ticker = y.ticker AND j2.known >= y.known),
j4 AS (SELECT j3.*, t.ttm AS tr FROM j3 ASOF LEFT JOIN ttm_revenue t ON j3.ticker = t.ticker AND j3.known >= t.known),
j5 AS (SELECT j4.*, t.ttm AS tf FROM j4 ASOF LEFT JOIN ttm_fcf t ON j4.ticker = t.ticker AND j4.known >= t.known),
v AS (SELECT *, close * shares AS cap, coalesce(tr, yr_rev) AS rev, coalesce(tf, yr_fcf) AS flow, CASE WHEN earned > 0 THEN earned END AS ebitda, close * shares + coalesce(lt_debt, 0) - coalesce(cash, 0) AS ev, total_equity / shares AS bv FROM j5)
SELECT ticker, event, round(close, 8) AS close, cap AS market_cap, round(ev + 1e-7, 4) AS enterprise_value, shares AS shares_outstanding, round(ttm_eps + 1e-7, 4) AS ttm_eps, round(bv + 1e-7, 4) AS book_value_per_share, round(rev / shares + 1e-7, 4) AS revenue_per_share,
  round(flow / shares + 1e-7, 4) AS fcf_per_share, round(rev + 1e-7, 4) AS revenue, round(flow + 1e-7, 4) AS fcf, round(ebitda + 1e-7, 4) AS ebitda, round(CASE WHEN ttm_eps <> 0 AND close / ttm_eps BETWEEN 0 AND 500 THEN close / ttm_eps END + 1e-7, 4) AS pe_ttm,
  round(CASE WHEN bv <> 0 AND close / bv BETWEEN 0 AND 100 THEN close / bv END + 1e-7, 4) AS pb, round(CASE WHEN close / (rev / shares) BETWEEN 0 AND 200 THEN close / (rev / shares) END + 1e-7, 4) AS ps, round(CASE WHEN ev / ebitda BETWEEN 0 AND 300 THEN ev / ebitda END, 6) AS ev_ebitda,
  round(CASE WHEN flow / shares / close BETWEEN -0.5 AND 0.5 THEN flow / shares / close END, 6) AS fcf_yield, round(CASE WHEN ttm_dividends / close BETWEEN 0 AND 0.5 THEN ttm_dividends / close END, 6) AS dividend_yield FROM v""")
def f1(spark, sf):
    """Both sides round a little above a tie, which sums in another order would hit from either side."""
    # Bars are dealt by ticker once; their windows and the join as of a time follow without a table between.
    v = X.valuations(bars(spark, sf, ("ticker",)), stored(financials(spark, sf)))
    four = ("ttm_eps", "book_value_per_share", "revenue_per_share", "fcf_per_share", "revenue", "fcf", "ebitda", "pe_ttm", "pb", "ps")
    return v.select("ticker", "event", F.round("close", 8).alias("close"), "shares_outstanding", "market_cap", F.round(F.col("enterprise_value") + 1e-7, 4).alias("enterprise_value"), *[F.round(F.col(c) + 1e-7, 4).alias(c) for c in four], *[F.round(c, 6).alias(c) for c in ("ev_ebitda", "fcf_yield", "dividend_yield")])


@query("f2_dividends", f"""WITH {BARS}, {FIN}, d AS (SELECT ticker, year(event) AS year, sum(dividends::DECIMAL(18, 4))::DOUBLE AS dps FROM bars GROUP BY 1, 2 HAVING count(*) >= 40),
e AS (SELECT ticker, year, sum(eps) AS eps FROM fin WHERE form = '10-Q' GROUP BY 1, 2),
u AS (SELECT *, coalesce(dps > lag(dps) OVER w, false) AS up, CASE WHEN lag(dps) OVER w > 0 THEN dps / lag(dps) OVER w - 1 END AS g1, CASE WHEN lag(dps, 3) OVER w > 0 THEN pow(dps / lag(dps, 3) OVER w, 1 / 3.0) - 1 END AS g3, CASE WHEN lag(dps, 5) OVER w > 0 THEN pow(dps / lag(dps, 5) OVER w, 1 / 5.0) - 1 END AS g5 FROM d WINDOW w AS (PARTITION BY ticker ORDER BY year)),
g AS (SELECT *, count(*) FILTER (WHERE NOT up) OVER (PARTITION BY ticker ORDER BY year) AS grp FROM u)
SELECT ticker, year, round(dps, 6) AS annual_dps, round(g1, 6) AS dps_growth_1y, round(g3, 6) AS dps_growth_3y, round(g5, 6) AS dps_growth_5y, count(*) FILTER (WHERE up) OVER (PARTITION BY ticker, grp ORDER BY year) AS consecutive_growth,
       round(CASE WHEN eps <> 0 AND dps / eps BETWEEN 0 AND 2 THEN dps / eps END, 6) AS payout_ratio, (dps > 0)::INT AS is_payer FROM g LEFT JOIN e USING (ticker, year)""")
def f2(spark, sf):
    exact = bars(spark, sf).withColumn("dividends", F.col("dividends").cast("decimal(18,4)"))
    d = X.dividend_table(exact, stored(financials(spark, sf)), min_bars=40)
    return d.select("ticker", "year", *[F.round(c, 6).alias(c) for c in ("annual_dps", "dps_growth_1y", "dps_growth_3y", "dps_growth_5y", "payout_ratio")], F.col("consecutive_growth").cast("long").alias("consecutive_growth"), "is_payer").withColumn("year", F.col("year").cast("long"))


def grown(now, then, years):
    g = f"pow({now} / {then}, 1 / {years}.0) - 1"
    return f"round(CASE WHEN {then} > 0 AND {now} > 0 AND {g} BETWEEN -0.8 AND 5 THEN {g} END, 6)"


@query("f3_quality_metrics", f"""WITH {BARS}, {FIN}, k AS (SELECT *, gross_profit / revenue AS gm, CASE WHEN year(period_end) <= 2017 THEN 0.35 ELSE 0.21 END AS tax, total_equity + lt_debt - cash AS invested, operating_income + depreciation AS earned FROM fin WHERE form = '10-K'),
x AS (SELECT *, avg(gm) OVER (PARTITION BY ticker ORDER BY period_end ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS gm3, lag(shares) OVER w AS s0, lag(revenue) OVER w AS r1, lag(revenue, 3) OVER w AS r3, lag(revenue, 5) OVER w AS r5, lag(eps) OVER w AS e1, lag(eps, 3) OVER w AS e3,
  CASE WHEN lag(net_income) OVER w IS NULL THEN NULL WHEN net_income > lag(net_income) OVER w THEN 1.0 ELSE 0.0 END AS rose FROM k WINDOW w AS (PARTITION BY ticker ORDER BY period_end)),
y AS (SELECT *, avg(rose) OVER (PARTITION BY ticker ORDER BY period_end ROWS 4 PRECEDING) AS consistency FROM x), p AS (SELECT y.*, b.close FROM y ASOF LEFT JOIN bars b ON y.ticker = b.ticker AND y.known >= b.event)
SELECT ticker, period_end, {grown('revenue', 'r1', 1)} AS revenue_cagr_1y, {grown('revenue', 'r3', 3)} AS revenue_cagr_3y, {grown('revenue', 'r5', 5)} AS revenue_cagr_5y, {grown('eps', 'e1', 1)} AS eps_cagr_1y, {grown('eps', 'e3', 3)} AS eps_cagr_3y,
  round(CASE WHEN abs(invested) > 1e6 AND operating_income * (1 - tax) / invested BETWEEN -1 AND 3 THEN operating_income * (1 - tax) / invested END, 6) AS roic, round(CASE WHEN abs(earned) > 1e6 AND (lt_debt - cash) / earned BETWEEN -50 AND 50 THEN (lt_debt - cash) / earned END, 6) AS net_debt_ebitda,
  round(gm, 6) AS gross_margin, round(gm3, 6) AS gross_margin_3y_avg, round(gm - gm3, 6) AS gross_margin_trend, round(CASE WHEN (s0 - shares) / s0 BETWEEN -0.5 AND 0.5 THEN (s0 - shares) / s0 END, 6) AS buyback_yield, round(consistency, 6) AS earnings_consistency_5y,
  round(CASE WHEN fcf / (close * shares) BETWEEN -1 AND 1 THEN fcf / (close * shares) END, 6) AS fcf_yield_filing FROM p""")
def f3(spark, sf):
    q = X.quality_table(stored(financials(spark, sf)), stored(bars(spark, sf)))
    six = ("revenue_cagr_1y", "revenue_cagr_3y", "revenue_cagr_5y", "eps_cagr_1y", "eps_cagr_3y", "roic", "net_debt_ebitda", "gross_margin", "gross_margin_3y_avg", "gross_margin_trend", "buyback_yield", "earnings_consistency_5y", "fcf_yield_filing")
    return q.select("ticker", "period_end", *[F.round(c, 6).alias(c) for c in six])
