"""Technical indicators as windows; recurrences as block-wise sums that carry their state.

An exponential average is sum(d ** (t - i) * x_i), seeded with the mean of the first n
values. Each key is cut into blocks of BLOCK rows: a running sum inside the block, scaled
so that it stays in range, plus the decayed ends of the blocks before it, as many as
still matter at double precision. All of it is windows over one order of a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knowntime.functions.scalars import safe_div
from knowntime.operators.windows import over


def full(value: Column, by, order, n: int, agg) -> Column:
    """An aggregate over the last n rows; null before there are n."""
    w = over(by, order).rowsBetween(-(n - 1), 0)
    return F.when(F.count(value).over(w) == n, agg(value).over(w))


def sma(value: Column, by, order, n: int) -> Column:
    return full(value, by, order, n, F.avg)


BLOCK = 256


def exponentials(df: DataFrame, by, order, averages: dict[str, tuple[str, int, float]], alike: dict[str, str] | None = None) -> DataFrame:
    """Adds exponential averages, out -> (value, n, alpha), each seeded with the mean of its value's first n present values.

    All of them go through the same windows: one over a key for the seeds, one over the blocks for each value, and one over
    a key for each block back that still matters. ``alike`` names, for a value, another that is null in the same rows, whose blocks it shares.
    """
    w, keys = over(by, order), [by] if isinstance(by, str) else list(by)
    running, earlier = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    values = list(dict.fromkeys(v for v, _, _ in averages.values()))
    like = {v: (alike or {}).get(v, v) for v in values}
    df = df.withColumns({f"_rank_{v}": F.count(v).over(running) for v in set(like.values())} | {f"_mean_{v}": F.avg(v).over(running) for v in values})
    df = df.withColumns({f"_block_{v}": F.floor((F.col(f"_rank_{v}") - 1) / BLOCK) for v in set(like.values())})
    at = {v: (F.col(f"_rank_{like[v]}") - 1) % BLOCK for v in values}
    own = {}
    for out, (v, n, alpha) in averages.items():
        rank, decay = F.col(f"_rank_{like[v]}"), 1 - alpha
        term = F.when(F.col(v).isNotNull(), F.when(rank > n, F.col(v) * alpha).when(rank == n, F.col(f"_mean_{v}")))
        inside = over([*keys, f"_block_{like[v]}"], order).rowsBetween(Window.unboundedPreceding, 0)
        own[f"_own_{out}"] = F.coalesce(F.sum(term * F.pow(F.lit(1 / decay), at[v])).over(inside), F.lit(0.0)) * F.pow(F.lit(decay), at[v])
    df = df.withColumns(own)
    # The end of the block before, then of the one before that, until their weight is below rounding.
    carried, weight, k = {out: F.lit(0.0) for out in averages}, {out: 1.0 for out in averages}, 0
    made = [*[f"_rank_{v}" for v in set(like.values())], *[f"_mean_{v}" for v in values], *[f"_block_{v}" for v in set(like.values())], *own]
    while open_ := [out for out in averages if weight[out] > 1e-18]:
        ends = {}
        for out in open_:
            v = averages[out][0]
            last = F.col(f"_end{k - 1}_{out}" if k else f"_own_{out}")
            ends[f"_end{k}_{out}"] = F.coalesce(F.last(F.when(F.col(v).isNotNull() & (at[v] == BLOCK - 1), last), ignorenulls=True).over(earlier), F.lit(0.0))
            carried[out] = carried[out] + F.col(f"_end{k}_{out}") * weight[out]
            weight[out] *= (1 - averages[out][2]) ** BLOCK
        df, made, k = df.withColumns(ends), [*made, *ends], k + 1
    totals = {}
    for out, (v, n, alpha) in averages.items():
        total = F.col(f"_own_{out}") + carried[out] * F.pow(F.lit(1 - alpha), at[v] + 1)
        totals[out] = F.when((F.col(f"_rank_{like[v]}") >= n) & F.col(v).isNotNull(), total)
    return df.withColumns(totals).drop(*made)


def _ema(value: str, n: int) -> tuple[str, int, float]:
    return value, n, 2 / (n + 1)


def _wilder(value: str, n: int) -> tuple[str, int, float]:
    return value, n, 1 / n


def ema(df, value, by, order, n, out):
    return exponentials(df, by, order, {out: _ema(value, n)})


def wilder(df, value, by, order, n, out):
    return exponentials(df, by, order, {out: _wilder(value, n)})


def _moves(df: DataFrame, price: str, by, order) -> DataFrame:
    """``_up`` and ``_down``: the rise or fall against the row before, null in a key's first row."""
    step = F.col(price) - F.lag(price).over(over(by, order))
    return df.withColumn("_step", step).withColumns({"_up": F.when(F.col("_step").isNotNull(), F.greatest("_step", F.lit(0.0))), "_down": F.when(F.col("_step").isNotNull(), F.greatest(-F.col("_step"), F.lit(0.0)))}).drop("_step")


def _strength(up: str, down: str) -> Column:
    return 100 * safe_div(F.col(up), F.col(up) + F.col(down))


def rsi(df: DataFrame, price: str, by, order, n: int = 14, out: str = "rsi") -> DataFrame:
    df = exponentials(_moves(df, price, by, order), by, order, {"_au": _wilder("_up", n), "_ad": _wilder("_down", n)}, {"_down": "_up"})
    return df.withColumn(out, _strength("_au", "_ad")).drop("_up", "_down", "_au", "_ad")


def macd(df: DataFrame, price: str, by, order, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    df = exponentials(df, by, order, {"_fast": _ema(price, fast), "_slow": _ema(price, slow)})
    df = ema(df.withColumn("macd", F.col("_fast") - F.col("_slow")).drop("_fast", "_slow"), "macd", by, order, signal, "macd_signal")
    return df.withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))


def bollinger(price: Column, by, order, n: int = 20, k: float = 2.0, ddof: int = 0) -> dict[str, Column]:
    mid = sma(price, by, order, n)
    spread = full(price, by, order, n, F.stddev_samp if ddof else F.stddev_pop) * k
    return {"bb_lower": mid - spread, "bb_mid": mid, "bb_upper": mid + spread, "bb_width": safe_div(spread * 200, mid)}


def _true_range(by, order) -> Column:
    before = F.lag("close").over(over(by, order))
    return F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))


def atr(df: DataFrame, by, order, n: int = 14, out: str = "atr") -> DataFrame:
    return wilder(df.withColumn("_tr", _true_range(by, order)), "_tr", by, order, n, out).drop("_tr")


def obv(price: Column, volume: Column, by, order) -> Column:
    w = over(by, order)
    step = F.coalesce(F.signum(price - F.lag(price).over(w)), F.lit(1.0)) * volume
    return step


def with_obv(df: DataFrame, by, order, price: str = "close", volume: str = "volume", out: str = "obv") -> DataFrame:
    df = df.withColumn("_step", obv(F.col(price), F.col(volume), by, order))
    return df.withColumn(out, F.sum("_step").over(over(by, order).rowsBetween(Window.unboundedPreceding, 0))).drop("_step")


def stochastic(df: DataFrame, by, order, n: int = 14, smooth: int = 3, d: int = 3) -> DataFrame:
    low, high = full(F.col("low"), by, order, n, F.min), full(F.col("high"), by, order, n, F.max)
    df = df.withColumns({"_lo": low, "_hi": high}).withColumn("_raw", 100 * safe_div(F.col("close") - F.col("_lo"), F.col("_hi") - F.col("_lo")))
    df = df.withColumn("stoch_k", full(F.col("_raw"), by, order, smooth, F.avg))
    return df.withColumn("stoch_d", full(F.col("stoch_k"), by, order, d, F.avg)).drop("_lo", "_hi", "_raw")


def williams_r(df: DataFrame, by, order, n: int = 14) -> DataFrame:
    df = df.withColumns({"_lo": full(F.col("low"), by, order, n, F.min), "_hi": full(F.col("high"), by, order, n, F.max)})
    return df.withColumn("williams_r", 100 * safe_div(F.col("close") - F.col("_hi"), F.col("_hi") - F.col("_lo"))).drop("_lo", "_hi")


def with_volatility(df: DataFrame, by, order, n: int = 21, price: str = "close", out: str = "volatility") -> DataFrame:
    """Yearly deviation of log returns over n rows."""
    step = F.log(safe_div(F.col(price), F.lag(price).over(over(by, order))))
    df = df.withColumn("_step", step)
    return df.withColumn(out, full(F.col("_step"), by, order, n, F.stddev_samp) * F.sqrt(F.lit(252.0))).drop("_step")


def vwap(by, order, n: int = 20, price: str = "close", volume: str = "volume") -> Column:
    """Price by volume over the last n rows."""
    w = over(by, order).rowsBetween(-(n - 1), 0)
    return F.when(F.count(price).over(w) == n, safe_div(F.sum(F.col(price) * F.col(volume)).over(w), F.sum(volume).over(w)))


def indicator_table(bars: DataFrame, by="ticker", order="event", min_bars: int = 30) -> DataFrame:
    """All indicators of every bar of keys with enough bars."""
    n = F.count(F.lit(1)).over(over(by, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    df = bars.withColumn("_n", n).where(F.col("_n") >= min_bars).drop("_n")
    df = df.withColumns({f"sma_{k}": sma(F.col("close"), by, order, k) for k in (20, 50, 200)} | bollinger(F.col("close"), by, order))
    df = _moves(df.withColumn("_tr", _true_range(by, order)), "close", by, order)
    df = exponentials(df, by, order, {
        "ema_9": _ema("close", 9), "ema_21": _ema("close", 21), "_fast": _ema("close", 12), "_slow": _ema("close", 26), "_au": _wilder("_up", 14), "_ad": _wilder("_down", 14), "atr": _wilder("_tr", 14)}, {"_down": "_up"})
    df = df.withColumns({"rsi": _strength("_au", "_ad"), "macd": F.col("_fast") - F.col("_slow")}).drop("_tr", "_up", "_down", "_au", "_ad", "_fast", "_slow")
    df = ema(df, "macd", by, order, 9, "macd_signal").withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))
    return williams_r(stochastic(with_obv(df, by, order), by, order), by, order)
