"""Bars, windows over one key, and indicators."""

from pyspark.sql import functions as F

from knowntime.operators import bars as B
from knowntime.operators import indicators as I
from knowntime.operators import windows as W
from knowntime.plans.proxies import BARS, FIN, bars, financials, table
from knowntime.plans.registry import query

#: The nations of the tables.
NATIONS = list(range(25))


#: Of bars that windows over a ticker follow.
TICKER = ("ticker",)


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("d1_resample_week", f"""WITH {BARS}, w AS (SELECT *, date_trunc('week', event + 2)::DATE + 4 AS period FROM bars)
SELECT ticker, period, round(arg_min(open, event), 8) AS open, round(max(high), 8) AS high, round(min(low), 8) AS low, round(arg_max(close, event), 8) AS close, sum(volume) AS volume FROM w GROUP BY 1, 2""")
def d1(spark, sf):
    return rounded(B.resample(bars(spark, sf), "W"), "open", "high", "low", "close", digits=8)


@query("d2_monthly_bars", f"""WITH {BARS} SELECT ticker, date_trunc('month', event)::DATE AS period, round(arg_min(open, event), 8) AS open, round(max(high), 8) AS high, round(min(low), 8) AS low,
       round(arg_max(close, event), 8) AS close, sum(volume) AS volume, max(known) AS known FROM bars GROUP BY 1, 2""")
def d2(spark, sf):
    return rounded(B.resample(bars(spark, sf), "MS", known="known"), "open", "high", "low", "close", digits=8)


@query("d3_resample_prices", f"""WITH {BARS} SELECT ticker, date_trunc('quarter', event)::DATE AS period, round(arg_max(close, event), 8) AS close, round(arg_max(open, event), 8) AS open, sum(volume) AS volume FROM bars GROUP BY 1, 2""")
def d3(spark, sf):
    return rounded(B.resample_prices(bars(spark, sf), "QS", columns=("close", "open")), "close", "open", digits=8)


@query("d4_pivot_prices", f"""WITH {BARS} SELECT event, {', '.join(f'round(max(close) FILTER (WHERE s_nationkey = {t}), 8) AS "{t}"' for t in NATIONS)} FROM bars JOIN supplier ON s_suppkey = ticker GROUP BY 1""")
def d4(spark, sf):
    """All tickers, one column a nation."""
    home = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("ticker"), "s_nationkey")
    top = bars(spark, sf).join(home, "ticker").groupBy("event", "s_nationkey").agg(F.round(F.max("close"), 8).alias("close"))
    return B.pivot_long(top, "event", "s_nationkey", "close", NATIONS)


RETURNS = f"""{BARS}, rets AS (SELECT ticker, event, close / lag(close) OVER (PARTITION BY ticker ORDER BY event) - 1 AS ret FROM bars)"""


def _returns(spark, sf):
    return bars(spark, sf, TICKER).select("ticker", "event", W.pct_change(F.col("close"), "ticker", "event").alias("ret"))


@query("e11_pct_change", f"WITH {RETURNS} SELECT ticker, event, round(ret, 6) AS ret FROM rets")
def e11(spark, sf):
    return rounded(_returns(spark, sf), "ret")


@query("d16_correlation", f"""WITH {RETURNS}, r AS (SELECT * FROM rets WHERE ret IS NOT NULL)
SELECT a.ticker AS a, b.ticker AS b, round(corr(a.ret, b.ret), 5) AS corr, count(*) AS n FROM r a JOIN r b ON a.event = b.event AND a.ticker <= b.ticker GROUP BY 1, 2 HAVING count(*) > 2""")
def d16(spark, sf):
    """All pairs of tickers with over two dates in common."""
    return rounded(B.correlation_matrix(_returns(spark, sf)).where("n > 2"), "corr", digits=5)


@query("d17_window_return", f"""WITH {RETURNS} SELECT ticker, round(product(1 + ret) - 1, 5) AS ret FROM rets WHERE event BETWEEN DATE '1998-01-01' AND DATE '1998-03-31' AND ret IS NOT NULL GROUP BY 1 HAVING count(*) > 10""")
def d17(spark, sf):
    return rounded(W.window_return(_returns(spark, sf).where("event between date'1998-01-01' and date'1998-03-31'"), "ticker", "ret"), "ret", digits=5)


@query("d24_value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def d24(spark, sf):
    return B.value_counts(table(spark, sf, "events"), "event_type")


@query("e5_trailing_dividends", f"WITH {BARS} SELECT ticker, event, round(sum(dividends) OVER (PARTITION BY ticker ORDER BY event ROWS BETWEEN 251 PRECEDING AND CURRENT ROW), 6) AS ttm FROM bars")
def e5(spark, sf):
    return bars(spark, sf, TICKER).select("ticker", "event", F.round(W.trailing_sum(F.coalesce("dividends", F.lit(0.0)), "ticker", "event", 252), 6).alias("ttm"))


MONTHLY = """monthly AS (SELECT l_suppkey AS ticker, date_trunc('month', l_shipdate)::DATE AS month, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2)"""


def _monthly(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("ticker"), F.trunc("l_shipdate", "month").alias("month")).agg(F.sum("l_quantity").alias("v"))


@query("e9_yoy_change", f"WITH {MONTHLY} SELECT ticker, month, round((v - lag(v, 12) OVER w) / lag(v, 12) OVER w * 100, 4) AS yoy FROM monthly WINDOW w AS (PARTITION BY ticker ORDER BY month)")
def e9(spark, sf):
    return _monthly(spark, sf).select("ticker", "month", F.round(W.yoy_change(F.col("v"), "ticker", "month"), 4).alias("yoy"))


@query("e12_growth_streak", f"""WITH {MONTHLY}, u AS (SELECT *, coalesce(v > lag(v) OVER (PARTITION BY ticker ORDER BY month), false) AS up FROM monthly),
g AS (SELECT *, count(*) FILTER (WHERE NOT up) OVER (PARTITION BY ticker ORDER BY month) AS grp FROM u)
SELECT ticker, month, count(*) FILTER (WHERE up) OVER (PARTITION BY ticker, grp ORDER BY month) AS streak FROM g""")
def e12(spark, sf):
    return W.growth_streak(_monthly(spark, sf), "v", "ticker", "month").select("ticker", "month", F.col("streak").cast("long").alias("streak"))


@query("e16_max_drawdown", f"""WITH {MONTHLY}, r AS (SELECT ticker, month, v / lag(v) OVER (PARTITION BY ticker ORDER BY month) - 1 AS ret FROM monthly),
c AS (SELECT ticker, month, product(1 + ret) OVER (PARTITION BY ticker ORDER BY month) AS cum FROM r WHERE ret IS NOT NULL),
p AS (SELECT *, max(cum) OVER (PARTITION BY ticker ORDER BY month) AS peak FROM c) SELECT ticker, round(min((cum - peak) / peak), 6) AS max_drawdown FROM p GROUP BY 1""")
def e16(spark, sf):
    r = _monthly(spark, sf).withColumn("ret", W.pct_change(F.col("v"), "ticker", "month")).where("ret is not null")
    return rounded(W.max_drawdown(r, "ret", "ticker", "month"), "max_drawdown")


YEARLY = f"""{FIN}, k AS (SELECT *, gross_profit / revenue AS gm FROM fin WHERE form = '10-K')"""


@query("e10_e17_e18_e19_growth", f"""WITH {YEARLY}, x AS (SELECT *, CASE WHEN net_income > lag(net_income) OVER w THEN 1.0 WHEN lag(net_income) OVER w IS NULL THEN NULL ELSE 0.0 END AS rose FROM k WINDOW w AS (PARTITION BY ticker ORDER BY year))
SELECT ticker, year, round(CASE WHEN lag(revenue, 3) OVER w > 0 AND revenue > 0 THEN pow(revenue / lag(revenue, 3) OVER w, 1 / 3.0) - 1 END, 6) AS cagr3,
  round(avg(gm) OVER (PARTITION BY ticker ORDER BY year ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) AS margin_before, round((lag(shares) OVER w - shares) / lag(shares) OVER w, 6) AS buyback,
  round(avg(rose) OVER (PARTITION BY ticker ORDER BY year ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS consistency FROM x WINDOW w AS (PARTITION BY ticker ORDER BY year)""")
def growth(spark, sf):
    w = W.over("ticker", "year")
    k = financials(spark, sf).where("form = '10-K'").withColumn("gm", F.col("gross_profit") / F.col("revenue"))
    k = k.withColumn("rose", (F.col("net_income") > F.lag("net_income").over(w)).cast("double"))
    return k.select(
        "ticker", "year", F.round(W.cagr(F.col("revenue"), "ticker", "year", 3), 6).alias("cagr3"), F.round(W.prior_mean(F.col("gm"), "ticker", "year", 3), 6).alias("margin_before"),
        F.round((F.lag("shares").over(w) - F.col("shares")) / F.lag("shares").over(w), 6).alias("buyback"), F.round(F.avg("rose").over(w.rowsBetween(-4, 0)), 6).alias("consistency"))


WIN = "PARTITION BY ticker ORDER BY event"


@query("e30_e34_averages", f"""WITH {BARS} SELECT ticker, event, {', '.join(f'round(CASE WHEN count(*) OVER (w ROWS {n - 1} PRECEDING) = {n} THEN avg(close) OVER (w ROWS {n - 1} PRECEDING) END, 4) AS sma_{n}' for n in (20, 50, 200))},
  round(CASE WHEN count(*) OVER (w ROWS 19 PRECEDING) = 20 THEN avg(close) OVER (w ROWS 19 PRECEDING) - 2 * stddev_pop(close) OVER (w ROWS 19 PRECEDING) END, 4) AS bb_lower,
  round(CASE WHEN count(*) OVER (w ROWS 19 PRECEDING) = 20 THEN avg(close) OVER (w ROWS 19 PRECEDING) + 2 * stddev_pop(close) OVER (w ROWS 19 PRECEDING) END, 4) AS bb_upper FROM bars WINDOW w AS ({WIN})""")
def e30(spark, sf):
    b, c = bars(spark, sf, TICKER), F.col("close")
    band = I.bollinger(c, "ticker", "event")
    return b.select("ticker", "event", *[F.round(I.sma(c, "ticker", "event", n), 4).alias(f"sma_{n}") for n in (20, 50, 200)], F.round(band["bb_lower"], 4).alias("bb_lower"), F.round(band["bb_upper"], 4).alias("bb_upper"))


@query("e36_e37_e38_oscillators", f"""WITH {BARS}, o AS (SELECT *, coalesce(sign(close - lag(close) OVER w), 1) * volume AS step, CASE WHEN count(*) OVER (w ROWS 13 PRECEDING) = 14 THEN min(low) OVER (w ROWS 13 PRECEDING) END AS lo, CASE WHEN count(*) OVER (w ROWS 13 PRECEDING) = 14 THEN max(high) OVER (w ROWS 13 PRECEDING) END AS hi FROM bars WINDOW w AS ({WIN})),
r AS (SELECT *, CASE WHEN hi > lo THEN 100 * (close - lo) / (hi - lo) END AS raw FROM o), k AS (SELECT *, CASE WHEN count(raw) OVER (w ROWS 2 PRECEDING) = 3 THEN avg(raw) OVER (w ROWS 2 PRECEDING) END AS k FROM r WINDOW w AS ({WIN}))
SELECT ticker, event, round(sum(step) OVER w, 2) AS obv, round(k, 4) AS stoch_k, round(CASE WHEN count(k) OVER (w ROWS 2 PRECEDING) = 3 THEN avg(k) OVER (w ROWS 2 PRECEDING) END, 4) AS stoch_d, round(CASE WHEN hi > lo THEN 100 * (close - hi) / (hi - lo) END, 4) AS williams_r FROM k WINDOW w AS ({WIN})""")
def e36(spark, sf):
    b = I.williams_r(I.stochastic(I.with_obv(bars(spark, sf, TICKER), "ticker", "event"), "ticker", "event"), "ticker", "event")
    return b.select("ticker", "event", F.round("obv", 2).alias("obv"), *[F.round(c, 4).alias(c) for c in ("stoch_k", "stoch_d", "williams_r")])


@query("e39_volatility_vwap", f"""WITH {BARS}, s AS (SELECT *, ln(close / lag(close) OVER w) AS step FROM bars WINDOW w AS ({WIN}))
SELECT ticker, event, round(CASE WHEN count(step) OVER (w ROWS 20 PRECEDING) = 21 THEN stddev_samp(step) OVER (w ROWS 20 PRECEDING) * sqrt(252) END, 6) AS volatility,
  round(CASE WHEN count(*) OVER (w ROWS 19 PRECEDING) = 20 THEN sum(close * volume) OVER (w ROWS 19 PRECEDING) / sum(volume) OVER (w ROWS 19 PRECEDING) END + 1e-7, 4) AS vwap FROM s WINDOW w AS ({WIN})""")
def e39(spark, sf):
    v = I.with_volatility(bars(spark, sf, TICKER), "ticker", "event")
    return v.select("ticker", "event", F.round("volatility", 6).alias("volatility"), F.round(I.vwap("ticker", "event") + 1e-7, 4).alias("vwap"))


def seeded(name, value, n, alpha, seed):
    """One state of the recursion: nothing, the seed at row n, then the recurrence."""
    return f"CASE WHEN b.rn < {n} THEN NULL WHEN b.rn = {n} THEN {seed} ELSE r.{name} * (1 - {alpha}) + {value} * {alpha} END AS {name}"


@query("f6_indicators", f"""WITH RECURSIVE {BARS}, l AS (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY ticker) AS n, close - lag(close) OVER w AS step, greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) AS tr FROM bars WINDOW w AS ({WIN})),
b AS MATERIALIZED (SELECT ticker, event, rn, close, tr, CASE WHEN step IS NOT NULL THEN greatest(step, 0) END AS up, CASE WHEN step IS NOT NULL THEN greatest(-step, 0) END AS down,
  {', '.join(f'avg(close) OVER (w ROWS {k - 1} PRECEDING) AS m{k}' for k in (9, 12, 21, 26))}, avg(tr) OVER (w ROWS 13 PRECEDING) AS mtr,
  avg(CASE WHEN step IS NOT NULL THEN greatest(step, 0) END) OVER (w ROWS 13 PRECEDING) AS mup, avg(CASE WHEN step IS NOT NULL THEN greatest(-step, 0) END) OVER (w ROWS 13 PRECEDING) AS mdown FROM l WHERE n >= 30 WINDOW w AS ({WIN})),
r AS (SELECT ticker, event, rn, NULL::DOUBLE AS e9, NULL::DOUBLE AS e12, NULL::DOUBLE AS e21, NULL::DOUBLE AS e26, NULL::DOUBLE AS atr, NULL::DOUBLE AS au, NULL::DOUBLE AS ad FROM b WHERE rn = 1
  UNION ALL SELECT b.ticker, b.event, b.rn, {', '.join(seeded(f'e{k}', 'b.close', k, f'(2.0 / {k + 1})', f'b.m{k}') for k in (9, 12, 21, 26))}, {seeded('atr', 'b.tr', 14, '(1.0 / 14)', 'b.mtr')}, {seeded('au', 'b.up', 15, '(1.0 / 14)', 'b.mup')}, {seeded('ad', 'b.down', 15, '(1.0 / 14)', 'b.mdown')}
  FROM r JOIN b ON b.ticker = r.ticker AND b.rn = r.rn + 1),
m AS MATERIALIZED (SELECT ticker, rn, e12 - e26 AS macd, avg(e12 - e26) OVER (PARTITION BY ticker ORDER BY rn ROWS 8 PRECEDING) AS mm FROM r),
s AS (SELECT ticker, rn, NULL::DOUBLE AS sig FROM m WHERE rn = 33 UNION ALL SELECT m.ticker, m.rn, CASE WHEN m.rn = 34 THEN m.mm ELSE s.sig * 0.8 + m.macd * 0.2 END FROM s JOIN m ON m.ticker = s.ticker AND m.rn = s.rn + 1)
SELECT r.ticker, r.event, round(e9, 4) AS ema_9, round(e21, 4) AS ema_21, round(CASE WHEN au + ad <> 0 THEN 100 * au / (au + ad) END, 4) AS rsi, round(atr, 4) AS atr, round(macd, 4) AS macd, round(sig, 4) AS macd_signal, round(macd - sig, 4) AS macd_hist
FROM r JOIN m USING (ticker, rn) LEFT JOIN s USING (ticker, rn)""")
def f6(spark, sf):
    t = I.indicator_table(bars(spark, sf, TICKER))
    return t.select("ticker", "event", *[F.round(c, 4).alias(c) for c in ("ema_9", "ema_21", "rsi", "atr", "macd", "macd_signal", "macd_hist")])
