"""Backtests as one plan: a panel of all as_of dates instead of a loop over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from knowntime.functions.scalars import safe_div
from knowntime.operators.asof import asof_join, bucket_days_for, evaluate_trades
from knowntime.operators.windows import over


def momentum_signal(panel: DataFrame, value: str = "momentum") -> DataFrame:
    """At each as_of the strongest tenth is LONG, the weakest SHORT, at least one of each, the rest FLAT."""
    rows = panel.where(F.col(value).isNotNull())
    w = Window.partitionBy("as_of")
    n = F.greatest(F.lit(1), F.floor(F.count(F.lit(1)).over(w) / 10))
    up = F.row_number().over(w.orderBy(F.col(value).desc(), "ticker"))
    down = F.row_number().over(w.orderBy(F.col(value), "ticker"))
    return rows.withColumns({"_n": n, "_up": up, "_down": down}).withColumn("signal", F.when(F.col("_up") <= F.col("_n"), "LONG").when(F.col("_down") <= F.col("_n"), "SHORT").otherwise("FLAT")).drop("_n", "_up", "_down")


def signal_flips(signals: DataFrame, dates: DataFrame) -> DataFrame:
    """Entries where a signal turns LONG or SHORT; the trade ends at the next as_of."""
    steps = dates.withColumn("exit_date", F.lead("as_of").over(Window.orderBy("as_of"))).withColumn("_step", F.row_number().over(Window.orderBy("as_of")))
    s = signals.select("as_of", "ticker", "signal").join(F.broadcast(steps), "as_of")
    w = over("ticker", "_step")
    prior = F.when(F.lag("_step").over(w) == F.col("_step") - 1, F.lag("signal").over(w)).otherwise("FLAT")
    flips = s.withColumn("_prior", prior).where("signal <> 'FLAT' and signal <> _prior and exit_date is not null")
    return flips.select("ticker", F.col("signal").alias("direction"), F.col("as_of").alias("entry_date"), "exit_date")


def momentum_panel(bars: DataFrame, dates: DataFrame, rows: int = 12) -> DataFrame:
    """(as_of, ticker, momentum) of the last bar known at each date; one metric a bar, then as-of."""
    metric = bars.select("ticker", F.col("event").alias("bar"), (safe_div(F.col("close"), F.lag("close", rows - 1).over(over("ticker", "event"))) - 1).alias("momentum"))
    # The calendar is one array of dates, exploded for each ticker.
    days = dates.agg(F.array_sort(F.collect_set("as_of")).alias("_days"))
    grid = bars.select("ticker", F.lit(1).alias("_one")).distinct().join(F.broadcast(days.withColumn("_one", F.lit(1))), "_one").select("ticker", F.explode("_days").alias("as_of"))
    return asof_join(grid, metric, ["ticker"], "as_of", "bar", ["momentum"], bucket_days=bucket_days_for(bars, "ticker", "event"))


def backtest_summary(trades: DataFrame) -> DataFrame:
    gain, pnl = F.col("outcome") == "GAIN", F.col("pnl_pct")
    done = trades.where("outcome <> 'ERROR'")
    return done.agg(
        F.count(F.lit(1)).alias("trades"), F.avg(gain.cast("double")).alias("win_rate"), F.sum("pnl_pct").alias("total_pnl"), F.avg("pnl_pct").alias("avg_pnl"),
        F.avg(F.when(gain, pnl)).alias("avg_gain"), F.avg(F.when(~gain, pnl)).alias("avg_loss"))


def backtest(bars: DataFrame, dates: DataFrame, strategy=momentum_signal) -> DataFrame:
    """Trades of a set-based strategy over all dates: panel, signals, flips, prices."""
    return evaluate_trades(signal_flips(strategy(momentum_panel(bars, dates)), dates), bars)
