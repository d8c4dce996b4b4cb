"""Holdings of managers, and backtests."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from knowntime.operators import backtest as T
from knowntime.operators import pit
from knowntime.operators import portfolio as P
from knowntime.plans.proxies import BARS, HOLD, TODAY, bars, holdings, stored, table
from knowntime.plans.registry import query
from knowntime.plans.store_queries import shared

HISTORY = f"""{HOLD}, per AS (SELECT manager, period, row_number() OVER w AS ordinal, lead(period) OVER w AS next_period FROM (SELECT DISTINCT manager, period FROM hold) WINDOW w AS (PARTITION BY manager ORDER BY period)),
h0 AS (SELECT hold.*, ordinal, next_period, value / sum(value) OVER (PARTITION BY manager, period) AS weight FROM hold JOIN per USING (manager, period)),
h1 AS (SELECT *, lag(shares) OVER w AS ps, lag(ordinal) OVER w AS po, lead(ordinal) OVER w AS no, ordinal - row_number() OVER w AS isl FROM h0 WINDOW w AS (PARTITION BY manager, cusip ORDER BY ordinal)),
h2 AS (SELECT *, CASE WHEN po IS NULL OR po <> ordinal - 1 THEN 'new' WHEN shares / ps > 1.05 THEN 'increased' WHEN shares / ps < 0.95 THEN 'decreased' ELSE 'held' END AS change,
  row_number() OVER (PARTITION BY manager, cusip, isl ORDER BY ordinal) AS quarters_held FROM h1),
hist AS (SELECT manager, period, cusip, shares, value, weight, change, quarters_held, ordinal FROM h2
  UNION ALL SELECT manager, next_period, cusip, 0, 0, 0, 'closed', 0, ordinal + 1 FROM h2 WHERE next_period IS NOT NULL AND coalesce(no, -1) <> ordinal + 1)"""


@query("f8_portfolio_history", f"WITH {HISTORY} SELECT manager, period, cusip, shares, round(value, 2) AS value, round(weight, 8) AS weight, change, quarters_held::INT AS quarters_held FROM hist")
def f8(spark, sf):
    h = stored(holdings(spark, sf))
    return P.portfolio_history(h, rows=h.count()).select("manager", "period", "cusip", "shares", F.round("value", 2).alias("value"), F.round("weight", 8).alias("weight"), "change", "quarters_held")


@query("d6_d7_holdings", """WITH l AS (SELECT c_nationkey AS manager, last_day((date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH)::DATE) AS period, l_suppkey AS cusip, l_quantity AS shares, l_extendedprice AS value FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE l_linenumber <> 2),
h AS (SELECT manager, period, cusip, sum(shares) AS shares, sum(value) AS value FROM l GROUP BY ALL) SELECT manager, period, cusip, shares, round(value / sum(value) OVER (PARTITION BY manager, period), 8) AS weight FROM h""")
def d6(spark, sf):
    """Rows as they are filed: shares, shares with a blank, no kind, and principal amounts, which do not count."""
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.select(F.col("o_orderkey").alias("l_orderkey"), F.col("c_nationkey").alias("manager"), F.last_day(F.add_months(F.trunc("o_orderdate", "quarter"), 2)).alias("period"))
    kind = F.when(F.col("l_linenumber") == 1, "SH ").when(F.col("l_linenumber") == 2, "PRN").when(F.col("l_linenumber") == 3, "").when(F.col("l_linenumber") != 4, "SH")
    rows = table(spark, sf, "lineitem").join(o, "l_orderkey").select("manager", "period", F.col("l_suppkey").alias("cusip"), F.col("l_quantity").alias("shares"), F.col("l_extendedprice").alias("value"), kind.alias("share_type"))
    h = P.aggregate_holdings(rows, ["manager", "period", "cusip"])
    return h.select("manager", "period", "cusip", "shares", F.round(F.col("value") / F.sum("value").over(Window.partitionBy("manager", "period")), 8).alias("weight"))


@query("d19_change_breakdown", f"WITH {HISTORY} SELECT manager, change, count(*) AS n FROM hist WHERE (manager, period) IN (SELECT (manager, max(period)) FROM hold GROUP BY manager) GROUP BY 1, 2")
def d19(spark, sf):
    return P.change_breakdown(P.portfolio_history(holdings(spark, sf)))


@query("c13_map_identifier", f"WITH {HOLD} SELECT manager, period, cusip, s_name AS ticker FROM hold LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON cusip = s_suppkey")
def c13(spark, sf):
    mapping = table(spark, sf, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("cusip"), F.col("s_name").alias("ticker"))
    return P.map_identifier(holdings(spark, sf).select("manager", "period", "cusip"), mapping, "cusip")


RUNS = f"""{HISTORY}, r AS (SELECT *, count(*) FILTER (WHERE change = 'new') OVER (PARTITION BY manager, cusip ORDER BY ordinal) AS run, max(weight) OVER (PARTITION BY manager, cusip) AS peak FROM hist),
runs AS (SELECT manager, cusip, min(period) FILTER (WHERE change <> 'closed') AS start, max(period) FILTER (WHERE change <> 'closed') AS last, max(period) FILTER (WHERE change = 'closed') AS closed_on, count(*) FILTER (WHERE change <> 'closed') AS quarters,
  any_value(peak) AS peak_weight, max(period) FILTER (WHERE change = 'closed') IS NULL AS is_open, coalesce(max(period) FILTER (WHERE change = 'closed'), DATE '{TODAY}') AS exit FROM r GROUP BY manager, cusip, run)"""


@query("f11_holding_periods", f"""WITH {RUNS}, {BARS}, a AS (SELECT u.*, b.close AS c0 FROM runs u ASOF LEFT JOIN bars b ON u.cusip = b.ticker AND u.start >= b.event), b AS (SELECT a.*, b.close AS c1 FROM a ASOF LEFT JOIN bars b ON a.cusip = b.ticker AND a.exit >= b.event),
c AS (SELECT b.*, x.close AS b0 FROM b ASOF LEFT JOIN (SELECT * FROM bars WHERE ticker = 0) x ON b.start >= x.event), d AS (SELECT c.*, x.close AS b1 FROM c ASOF LEFT JOIN (SELECT * FROM bars WHERE ticker = 0) x ON c.exit >= x.event)
SELECT manager, cusip, start, last, closed_on, quarters, round(peak_weight, 8) AS peak_weight, is_open, exit, round(c0, 8) AS entry_price, round(c1, 8) AS exit_price, round(c1 / c0 - 1, 6) AS ret, round((c1 / c0) / (b1 / b0) - 1, 6) AS alpha FROM d WHERE c0 > 0 AND c1 IS NOT NULL""")
def f11(spark, sf):
    h, b = stored(holdings(spark, sf)), stored(bars(spark, sf).select("ticker", "event", "close"))
    runs = P.holding_returns(P.holding_runs(P.portfolio_history(h, rows=h.count()), TODAY), b, 0, h.count() + b.count())
    return runs.select("manager", "cusip", "start", "last", "closed_on", "quarters", F.round("peak_weight", 8).alias("peak_weight"), "is_open", "exit", *[F.round(c, 8).alias(c) for c in ("entry_price", "exit_price")], *[F.round(c, 6).alias(c) for c in ("ret", "alpha")])


POSITIONS = f"""{HISTORY}, {BARS}, sp AS (SELECT manager, period, period AS entry_date, coalesce(next_period, DATE '{TODAY}') AS exit_date FROM per),
p0 AS (SELECT h.*, entry_date, exit_date, count(*) OVER (PARTITION BY h.manager, h.period) < 10 AS confidential FROM hist h JOIN sp ON h.manager = sp.manager AND h.period = sp.period WHERE change <> 'closed'),
p1 AS (SELECT p0.*, b.close AS c0 FROM p0 ASOF LEFT JOIN bars b ON p0.cusip = b.ticker AND p0.entry_date >= b.event), p2 AS (SELECT p1.*, b.close AS c1 FROM p1 ASOF LEFT JOIN bars b ON p1.cusip = b.ticker AND p1.exit_date >= b.event),
p3 AS (SELECT p2.*, b.close AS b0 FROM p2 ASOF LEFT JOIN (SELECT * FROM bars WHERE ticker = 0) b ON p2.entry_date >= b.event), p4 AS (SELECT p3.*, b.close AS b1 FROM p3 ASOF LEFT JOIN (SELECT * FROM bars WHERE ticker = 0) b ON p3.exit_date >= b.event),
pos AS (SELECT *, c1 / c0 - 1 AS ret, b1 / b0 - 1 AS bench, (c1 / c0) / (b1 / b0) - 1 AS alpha FROM p4)"""


def _positions(spark, sf, copycat_days=0):
    h, b = stored(holdings(spark, sf)), stored(bars(spark, sf).select("ticker", "event", "close"))
    return P.position_returns(P.portfolio_history(h, rows=h.count()), b, 0, TODAY, copycat_days, rows=h.count() + b.count())


def _written(spark, df):
    """``df`` in the shared folder, for plans that read it more than once."""
    path = f"{shared(spark)}/once"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@query("f9_copycat_returns", f"""WITH {HISTORY}, {BARS}, sp AS (SELECT manager, period, period + 45 AS entry_date, coalesce(next_period + 45, DATE '{TODAY}') AS exit_date FROM per),
p0 AS (SELECT h.*, entry_date, exit_date FROM hist h JOIN sp ON h.manager = sp.manager AND h.period = sp.period WHERE change <> 'closed'),
p1 AS (SELECT p0.*, b.close AS c0 FROM p0 ASOF LEFT JOIN bars b ON p0.cusip = b.ticker AND p0.entry_date >= b.event), p2 AS (SELECT p1.*, b.close AS c1 FROM p1 ASOF LEFT JOIN bars b ON p1.cusip = b.ticker AND p1.exit_date >= b.event)
SELECT manager, period, cusip, entry_date, exit_date, round(c1 / c0 - 1, 6) AS ret FROM p2""")
def f9_copycat(spark, sf):
    """Bought and sold when the filings are public, 45 days on."""
    return _positions(spark, sf, 45).select("manager", "period", "cusip", "entry_date", "exit_date", F.round("ret", 6).alias("ret"))


@query("f9_position_returns", f"WITH {POSITIONS} SELECT manager, period, cusip, exit_date, confidential, round(ret, 6) AS ret, round(alpha, 6) AS alpha FROM pos")
def f9(spark, sf):
    return _positions(spark, sf).select("manager", "period", "cusip", "exit_date", "confidential", F.round("ret", 6).alias("ret"), F.round("alpha", 6).alias("alpha"))


QUARTERS = f"""{POSITIONS}, qr AS (SELECT manager, period, sum(weight * ret) / sum(weight) FILTER (WHERE ret IS NOT NULL) AS ret, coalesce(sum(value) FILTER (WHERE ret IS NOT NULL), NULL) / sum(value) AS coverage, max(bench) AS bench, max(confidential) AS confidential, count(*) AS positions FROM pos GROUP BY 1, 2)"""


@query("f10_quarterly_returns", f"WITH {QUARTERS} SELECT manager, period, round(ret, 6) AS ret, round(coverage, 6) AS coverage, round((1 + ret) / (1 + bench) - 1, 6) AS alpha, confidential, positions FROM qr")
def f10(spark, sf):
    q = P.quarterly_returns(_positions(spark, sf))
    return q.select("manager", "period", *[F.round(c, 6).alias(c) for c in ("ret", "coverage", "alpha")], "confidential", "positions")


@query("f12_performance", f"""WITH {QUARTERS}, c AS (SELECT *, (1 + ret) / (1 + bench) - 1 AS alpha FROM qr WHERE NOT confidential AND ret IS NOT NULL),
dd AS (SELECT manager, period, product(1 + ret) OVER (PARTITION BY manager ORDER BY period) AS cum FROM c), pk AS (SELECT *, max(cum) OVER (PARTITION BY manager ORDER BY period) AS peak FROM dd),
md AS (SELECT manager, min((cum - peak) / peak) AS max_drawdown FROM pk GROUP BY 1), tp AS (SELECT manager, avg(t) AS top5 FROM (SELECT manager, period, sum(weight) AS t FROM (SELECT * FROM pos QUALIFY row_number() OVER (PARTITION BY manager, period ORDER BY weight DESC, cusip) <= 5) GROUP BY 1, 2) GROUP BY 1)
SELECT manager, count(*) AS quarters, round(pow(product(1 + ret), 4.0 / count(*)) - 1, 5) AS annual_return, round(pow(product(1 + ret), 4.0 / count(*)) - pow(product(1 + bench), 4.0 / count(*)), 5) AS annual_alpha, round(avg((ret > 0)::INT), 6) AS hit_rate,
  round(avg(alpha) / stddev_samp(alpha) * 2, 5) AS information_ratio, round(any_value(max_drawdown), 5) AS max_drawdown, round(any_value(top5), 6) AS top5 FROM c JOIN md USING (manager) JOIN tp USING (manager) GROUP BY manager""")
def f12(spark, sf):
    p = _written(spark, _positions(spark, sf))
    s = P.performance_summary(P.quarterly_returns(p), p)
    return s.select("manager", "quarters", *[F.round(c, d).alias(c) for c, d in (("annual_return", 5), ("annual_alpha", 5), ("hit_rate", 6), ("information_ratio", 5), ("max_drawdown", 5), ("top5", 6))])


@query("d21_coverage_stats", f"""WITH {QUARTERS}, a AS (SELECT manager, count(*) AS n_quarters, count(*) FILTER (WHERE NOT confidential) AS n_clean_quarters, round(avg(coverage), 6) AS avg_coverage FROM qr GROUP BY 1),
t AS (SELECT manager, cusip, count(ret) AS priced FROM pos GROUP BY 1, 2) SELECT a.*, tickers, tickers_missing FROM a JOIN (SELECT manager, count(*) AS tickers, count(*) FILTER (WHERE priced = 0) AS tickers_missing FROM t GROUP BY 1) USING (manager)""")
def d21(spark, sf):
    p = _written(spark, _positions(spark, sf))
    return P.coverage_stats(P.quarterly_returns(p), p).withColumn("avg_coverage", F.round("avg_coverage", 6))


@query("e23_top_n", f"""WITH {POSITIONS}, a AS (SELECT manager, period, cusip, round(alpha, 6) AS alpha, row_number() OVER (PARTITION BY manager ORDER BY alpha DESC, period, cusip) AS up, row_number() OVER (PARTITION BY manager ORDER BY alpha, period, cusip) AS down FROM pos WHERE alpha IS NOT NULL)
SELECT manager, period, cusip, alpha, 'best' AS side FROM a WHERE up <= 5 UNION ALL SELECT manager, period, cusip, alpha, 'worst' FROM a WHERE down <= 5""")
def e23(spark, sf):
    """The five best and the five worst positions of each manager."""
    top = P.best_and_worst(_positions(spark, sf).select("manager", "period", "cusip", "alpha"), "manager", "alpha", ["period", "cusip"])
    return top.withColumn("alpha", F.round("alpha", 6))


DATES = "days AS (SELECT unnest(generate_series(DATE '1996-01-31', DATE '2000-12-31', INTERVAL 30 DAY))::DATE AS as_of)"
SIGNALS = f"""{BARS}, {DATES}, m AS (SELECT ticker, event, close / lag(close, 11) OVER (PARTITION BY ticker ORDER BY event) - 1 AS momentum FROM bars),
g AS (SELECT ticker, as_of FROM (SELECT DISTINCT ticker FROM bars), days), pn AS (SELECT g.as_of, g.ticker, m.momentum FROM g ASOF LEFT JOIN m ON g.ticker = m.ticker AND g.as_of >= m.event),
s AS (SELECT as_of, ticker, momentum, CASE WHEN row_number() OVER (PARTITION BY as_of ORDER BY momentum DESC, ticker) <= greatest(1, count(*) OVER (PARTITION BY as_of) // 10) THEN 'LONG'
  WHEN row_number() OVER (PARTITION BY as_of ORDER BY momentum, ticker) <= greatest(1, count(*) OVER (PARTITION BY as_of) // 10) THEN 'SHORT' ELSE 'FLAT' END AS signal FROM pn WHERE momentum IS NOT NULL)"""


def _dates(spark):
    return pit.calendar(spark, "1996-01-31", "2000-12-31", "30 DAY")


@query("e20_momentum", f"WITH {SIGNALS} SELECT as_of, ticker, round(momentum, 6) AS momentum, signal FROM s")
def e20(spark, sf):
    return T.momentum_signal(T.momentum_panel(bars(spark, sf), _dates(spark))).select("as_of", "ticker", F.round("momentum", 6).alias("momentum"), "signal")


FLIPS = f"""{SIGNALS}, st AS (SELECT as_of, lead(as_of) OVER (ORDER BY as_of) AS exit_date, row_number() OVER (ORDER BY as_of) AS step FROM days),
fl AS (SELECT ticker, signal AS direction, as_of AS entry_date, exit_date, CASE WHEN lag(step) OVER w = step - 1 THEN lag(signal) OVER w ELSE 'FLAT' END AS prior FROM s JOIN st USING (as_of) WINDOW w AS (PARTITION BY ticker ORDER BY step)),
tr AS (SELECT ticker, direction, entry_date, exit_date FROM fl WHERE direction <> 'FLAT' AND direction <> prior AND exit_date IS NOT NULL)"""


@query("e21_signal_flips", f"WITH {FLIPS} SELECT * FROM tr")
def e21(spark, sf):
    return T.signal_flips(T.momentum_signal(T.momentum_panel(bars(spark, sf), _dates(spark))), _dates(spark))


@query("f15_backtest", f"""WITH {FLIPS}, a AS (SELECT tr.*, b.close AS p0 FROM tr ASOF LEFT JOIN bars b ON tr.ticker = b.ticker AND tr.entry_date >= b.event), p AS (SELECT a.*, b.close AS p1 FROM a ASOF LEFT JOIN bars b ON a.ticker = b.ticker AND a.exit_date >= b.event),
o AS (SELECT CASE direction WHEN 'SHORT' THEN p0 - p1 ELSE p1 - p0 END * 100 / p0 AS pnl FROM p)
SELECT count(*) AS trades, round(avg((pnl > 0)::INT), 6) AS win_rate, round(sum(pnl), 3) AS total_pnl, round(avg(pnl), 5) AS avg_pnl, round(avg(pnl) FILTER (WHERE pnl > 0), 5) AS avg_gain, round(avg(pnl) FILTER (WHERE pnl <= 0), 5) AS avg_loss FROM o WHERE pnl IS NOT NULL""")
def f15(spark, sf):
    s = T.backtest_summary(T.backtest(stored(bars(spark, sf)), _dates(spark)))
    return s.select("trades", F.round("win_rate", 6).alias("win_rate"), F.round("total_pnl", 3).alias("total_pnl"), *[F.round(c, 5).alias(c) for c in ("avg_pnl", "avg_gain", "avg_loss")])
