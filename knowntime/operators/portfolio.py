"""Quarterly holdings of managers: weights, changes, runs and what they returned."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from knowntime.functions.scalars import safe_div
from knowntime.operators.asof import bucket_days_for, price_on, vs_benchmark
from knowntime.operators.windows import dealt, max_drawdown, over


#: Parts that the rows of a key are ranked in first.
PARTS_OF_A_KEY = 256


def map_identifier(df: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """Left join with an identifier dimension; the optimiser broadcasts it where it is small."""
    return df.join(mapping, key, "left")


def aggregate_holdings(rows: DataFrame, keys: list[str], share_type: str = "share_type") -> DataFrame:
    """Share positions added up by ``keys``; rows of another kind than shares are left out."""
    kind = F.coalesce(F.trim(F.upper(share_type)), F.lit(""))
    return rows.where(kind.isin("SH", "")).groupBy(*keys).agg(F.sum("shares").alias("shares"), F.sum("value").alias("value"))


def missing_prices(needed: DataFrame, priced: DataFrame, key: str) -> DataFrame:
    """Keys that are held but have no price."""
    return needed.select(key).distinct().join(priced.select(key), key, "left_anti")


def change_breakdown(history: DataFrame) -> DataFrame:
    """How many positions changed in which way in each manager's last quarter."""
    last = history.withColumn("_last", F.max("period").over(Window.partitionBy("manager"))).where("period = _last")
    return last.groupBy("manager", "change").agg(F.count(F.lit(1)).alias("n"))


def best_and_worst(df: DataFrame, by: str, value: str, ties: list[str], n: int = 5) -> DataFrame:
    """The n highest and the n lowest rows of each key, marked ``best`` or ``worst``."""
    rows = df.where(F.col(value).isNotNull())
    w = Window.partitionBy(by)

    def ranked(rows, w):
        ranks = {"_up": w.orderBy(F.col(value).desc(), *ties), "_down": w.orderBy(F.col(value), *ties)}
        return rows.withColumns({c: F.row_number().over(order) for c, order in ranks.items()})

    # The ends of each key are among those of its parts, so no task ranks all rows of a key.
    part = F.pmod(F.xxhash64(*ties), F.lit(PARTS_OF_A_KEY))
    ends = ranked(rows.withColumn("_part", part), Window.partitionBy(by, "_part")).where((F.col("_up") <= n) | (F.col("_down") <= n))
    ranked = ranked(ends.drop("_part", "_up", "_down"), w)
    side = F.explode(F.filter(F.array(F.when(F.col("_up") <= n, "best"), F.when(F.col("_down") <= n, "worst")), lambda x: x.isNotNull()))
    return ranked.withColumn("side", side).drop("_up", "_down")


def portfolio_history(holdings: DataFrame, up: float = 1.05, down: float = 0.95, rows: int | None = None) -> DataFrame:
    """Positions with weight, change on the manager's last quarter, closed rows and quarters held.

    A position is new unless the manager held it in the quarter stored before. A
    position that is gone gets a row with no shares, ``closed``, in the next
    stored quarter. ``rows`` is the number of holdings, if known.
    """
    # One row a manager and quarter: totals come from here, not from a window over all positions of a quarter.
    periods = holdings.groupBy("manager", "period").agg(F.sum("value").alias("_total"))
    wp = over("manager", "period")
    periods = periods.withColumns({"ordinal": F.row_number().over(wp), "next_period": F.lead("period").over(wp)})
    h = dealt(holdings.join(periods, ["manager", "period"]), ["manager", "cusip"], rows)
    total = F.col("_total")
    w = over(["manager", "cusip"], "ordinal")
    h = h.withColumns({"weight": F.when(total > 0, F.col("value") / total), "_prev": F.lag("shares").over(w), "_prev_ordinal": F.lag("ordinal").over(w), "_next_ordinal": F.lead("ordinal").over(w)})
    held = F.col("_prev_ordinal") == F.col("ordinal") - 1
    ratio = safe_div(F.col("shares"), F.col("_prev"))
    change = F.when(~F.coalesce(held, F.lit(False)), "new").when(ratio > up, "increased").when(ratio < down, "decreased").otherwise("held")
    island = F.col("ordinal") - F.row_number().over(w)
    h = h.withColumns({"change": change, "_island": island})
    h = h.withColumn("quarters_held", F.row_number().over(over(["manager", "cusip", "_island"], "ordinal")))
    gone = h.where(F.col("next_period").isNotNull() & (F.coalesce("_next_ordinal", F.lit(-1)) != F.col("ordinal") + 1))
    closed = gone.select("manager", F.col("next_period").alias("period"), "cusip", F.lit(0.0).alias("shares"), F.lit(0.0).alias("value"), F.lit(0.0).alias("weight"), F.lit("closed").alias("change"), F.lit(0).alias("quarters_held"), (F.col("ordinal") + 1).alias("ordinal"))
    columns = ["manager", "period", "cusip", "shares", "value", "weight", "change", "quarters_held", "ordinal"]
    return h.select(*columns).unionByName(closed.select(*columns))


def holding_runs(history: DataFrame, today: str) -> DataFrame:
    """Runs of consecutive quarters of a position; a closed row ends a run and is not part of it."""
    w = over(["manager", "cusip"], "ordinal")
    rows = history.withColumn("_run", F.sum(F.when(F.col("change") == "new", 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("_closed", F.when(F.col("change") == "closed", F.col("period")))
    runs = rows.groupBy("manager", "cusip", "_run").agg(
        F.min(F.when(F.col("change") != "closed", F.col("period"))).alias("start"), F.max(F.when(F.col("change") != "closed", F.col("period"))).alias("last"),
        F.max("_closed").alias("closed_on"), F.count_if(F.col("change") != "closed").alias("quarters"), F.max("weight").alias("peak_weight"))
    # The peak is over all quarters of the position, not only those of the run.
    runs = runs.withColumn("peak_weight", F.max("peak_weight").over(Window.partitionBy("manager", "cusip")))
    return runs.withColumns({"is_open": F.col("closed_on").isNull(), "exit": F.coalesce("closed_on", F.lit(today).cast("date"))}).drop("_run")


def priced_spans(df: DataFrame, prices: DataFrame, bench, first: str, last: str, rows: int | None = None) -> DataFrame:
    """Rows (cusip, two dates) with both prices, the return, the benchmark's and the excess over it; ``rows`` is the number of both tables' rows, if known."""
    p, days = df.withColumn("ticker", F.col("cusip")), bucket_days_for(prices, "ticker", "event")
    for when, out in ((first, "entry_price"), (last, "exit_price")):
        p = price_on(p, prices, "ticker", when, "event", "close", out, days, rows)
    # One row a pair of dates, however many positions share it.
    marks = df.select(first, last).distinct().withColumn("ticker", F.lit(bench))
    for when, out in ((first, "_b0"), (last, "_b1")):
        marks = price_on(marks, prices.where(F.col("ticker") == bench), "ticker", when, "event", "close", out, days)
    p = p.join(marks.drop("ticker"), [first, last])
    r, b = safe_div(F.col("exit_price"), F.col("entry_price")) - 1, safe_div(F.col("_b1"), F.col("_b0")) - 1
    return p.withColumns({"ret": r, "bench": b}).withColumn("alpha", vs_benchmark(F.col("ret"), F.col("bench"))).drop("_b0", "_b1", "ticker")


def holding_returns(runs: DataFrame, prices: DataFrame, bench, rows: int | None = None) -> DataFrame:
    """What each run of a position returned from its first quarter to its exit; runs without both prices are left out."""
    return priced_spans(runs, prices, bench, "start", "exit", rows).where("entry_price > 0 and exit_price is not null")


def coverage_stats(quarters: DataFrame, positions: DataFrame) -> DataFrame:
    """Per manager: quarters, clean ones, mean share of value priced, tickers held and tickers never priced."""
    a = quarters.groupBy("manager").agg(F.count(F.lit(1)).alias("n_quarters"), F.count_if(~F.col("confidential")).alias("n_clean_quarters"), F.avg("coverage").alias("avg_coverage"))
    b = positions.groupBy("manager", "cusip").agg(F.count("ret").alias("_priced"))
    b = b.groupBy("manager").agg(F.count(F.lit(1)).alias("tickers"), F.count_if(F.col("_priced") == 0).alias("tickers_missing"))
    return a.join(b, "manager")


def position_returns(history: DataFrame, prices: DataFrame, bench, today: str, copycat_days: int = 0, few: int = 10, rows: int | None = None) -> DataFrame:
    """Return of each position from its quarter's end (or filing) to the next quarter's, and its excess over a benchmark."""
    p = history.where("change <> 'closed'")
    spans = p.groupBy("manager", "period").agg(F.count(F.lit(1)).alias("_n")).withColumn("_next", F.lead("period").over(over("manager", "period")))
    spans = spans.select("manager", "period", (F.col("_n") < few).alias("confidential"), F.date_add("period", copycat_days).alias("entry_date"), F.coalesce(F.date_add("_next", copycat_days), F.lit(today).cast("date")).alias("exit_date"))
    p = p.join(spans, ["manager", "period"])
    return priced_spans(p, prices, bench, "entry_date", "exit_date", rows)


def quarterly_returns(positions: DataFrame) -> DataFrame:
    """Portfolio return on the priced positions, weights renormalised, with the share of value priced."""
    priced = F.col("ret").isNotNull()
    q = positions.groupBy("manager", "period").agg(
        safe_div(F.sum(F.when(priced, F.col("weight") * F.col("ret"))), F.sum(F.when(priced, F.col("weight")))).alias("ret"),
        safe_div(F.sum(F.when(priced, F.col("value"))), F.sum("value")).alias("coverage"),
        F.max("bench").alias("bench"), F.max("confidential").alias("confidential"), F.count(F.lit(1)).alias("positions"))
    return q.withColumn("alpha", vs_benchmark(F.col("ret"), F.col("bench")))


def performance_summary(quarters: DataFrame, positions: DataFrame) -> DataFrame:
    """One row a manager: annualised return and alpha, drawdown, information ratio, hit rates, concentration."""
    clean = quarters.where("not confidential and ret is not null")
    n = F.count(F.lit(1))
    out = clean.groupBy("manager").agg(
        n.alias("quarters"), (F.pow(F.product(1 + F.col("ret")), 4.0 / n) - 1).alias("annual_return"), (F.pow(F.product(1 + F.col("bench")), 4.0 / n) - 1).alias("annual_bench"),
        F.avg("ret").alias("mean_return"), F.avg("alpha").alias("mean_alpha"), F.avg((F.col("ret") > 0).cast("double")).alias("hit_rate"), F.avg((F.col("alpha") > 0).cast("double")).alias("alpha_hit_rate"),
        F.when(F.count("alpha") > 1, safe_div(F.avg("alpha"), F.stddev_samp("alpha")) * 2).alias("information_ratio"), F.avg("coverage").alias("avg_coverage"))
    out = out.withColumn("annual_alpha", F.col("annual_return") - F.col("annual_bench"))
    rank = F.row_number().over(Window.partitionBy("manager", "period").orderBy(F.col("weight").desc(), "cusip"))
    top = positions.withColumn("_r", rank).where("_r <= 5").groupBy("manager", "period").agg(F.sum("weight").alias("_top")).groupBy("manager").agg(F.avg("_top").alias("top5"))
    return out.join(max_drawdown(clean, "ret", "manager", "period"), "manager").join(top, "manager")
