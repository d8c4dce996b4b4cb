"""Report operators, correlation by blocks and buckets of as-of joins on small tables."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from knowntime.operators import asof, bars, reports

D = dt.date


def test_universe_falls_back(spark):
    df = lambda t: spark.createDataFrame([(x,) for x in t], "ticker string")
    old = spark.createDataFrame([("o", "sp"), ("p", "nd"), ("p", "sp")], "ticker string, index_name string")
    rows = lambda d: sorted(map(tuple, d.collect()))
    assert rows(reports.universe({"sp": df("ab"), "nd": df("bcc")}, old, ["z"])) == [("a", "sp"), ("b", "sp"), ("c", "nd")]
    assert rows(reports.universe({"sp": df(""), "nd": df("c")}, old, ["z"])) == [("c", "nd")]
    assert rows(reports.universe({"sp": df(""), "nd": df("")}, old, ["z"])) == [("o", "sp"), ("p", "nd")]
    assert rows(reports.universe({"sp": df("")}, old.limit(0), ["z", "y"])) == [("y", "bootstrap"), ("z", "bootstrap")]
    assert rows(reports.universe({"sp": df("")})) == []


def test_holdings_are_those_of_the_latest_filing(spark):
    rows = [("m", "x", D(2020, 3, 31), D(2020, 5, 1)), ("m", "y", D(2020, 3, 31), D(2020, 5, 1)), ("m", "y", D(2020, 6, 30), D(2020, 8, 1)), ("n", "x", D(2020, 3, 31), D(2020, 5, 2)), ("m", "z", D(2020, 9, 30), D(2020, 11, 1))]
    df = spark.createDataFrame(rows, "manager string, cusip string, period date, known date")
    got = lambda day: sorted((r.manager, r.cusip) for r in reports.institutional_holdings(df, day).collect())
    assert got("2020-08-15") == [("m", "y"), ("n", "x")] and got("2020-05-01") == [("m", "x"), ("m", "y")] and got("2019-01-01") == []


def test_short_interest_of_odd_profiles(spark):
    at = 86400 * 18262
    rows = [("a", 5, at, 1.5, 0.1, 100, 4, at - 86400), ("b", 0, at, 1.5, 0.1, 0, None, at), ("c", 7, None, None, None, None, 3, at), ("d", 9, at, 0.0, None, None, 1, None)]
    df = spark.createDataFrame(rows, "ticker string, sharesShort long, dateShortInterest long, shortRatio double, shortPercentOfFloat double, floatShares long, sharesShortPriorMonth long, sharesShortPreviousMonthDate long")
    got = sorted((r.ticker, r.source, r.settlement_date, r.shares_short, r.days_to_cover, r.float_shares) for r in reports.short_interest(df, F.lit("2020-02-01")).collect())
    day = D(2020, 1, 1)
    assert got == [("a", "current", day, 5, 1.5, 100), ("a", "prior", D(2019, 12, 31), 4, None, 100), ("c", "prior", day, 3, None, None), ("d", "current", day, 9, None, None)]


def test_series_without_vintages(spark):
    told = spark.createDataFrame([("a", D(2020, 1, 1), D(2020, 2, 1), 1.0, 0)], "code string, event date, known date, value double, revision int")
    last = spark.createDataFrame([("a", D(2020, 1, 1), 5.0), ("b", D(2020, 1, 1), 6.0), ("b", D(2020, 1, 2), None)], "code string, event date, value double")
    assert sorted(map(tuple, reports.with_unrevised(told, last).collect())) == [("a", D(2020, 1, 1), D(2020, 2, 1), 1.0, 0), ("b", D(2020, 1, 1), D(2020, 1, 1), 6.0, 0)]


@pytest.mark.parametrize("size", [1, 3, 100])
def test_correlation_by_blocks(spark, size):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(7, 60))
    x[3] = x[2] * -2
    # Some dates only some have, and spans that some have no row in.
    seen = rng.random((7, 60)) < 0.8
    seen[5, :40] = False
    rows = [(f"t{i * 5 % 7}", D(2020, 1, 1) + dt.timedelta(days=t), float(x[i, t])) for i in range(7) for t in range(60) if seen[i, t]]
    got = {(r.a, r.b): (r.corr, r.n) for r in bars.correlation_matrix(spark.createDataFrame(rows, "ticker string, event date, ret double"), block_size=size, span_days=20).collect()}
    for i in range(7):
        for j in range(7):
            a, b = f"t{i * 5 % 7}", f"t{j * 5 % 7}"
            both = seen[i] & seen[j]
            if a <= b:
                corr, n = got.pop((a, b))
                assert n == both.sum() and abs(corr - np.corrcoef(x[i, both], x[j, both])[0, 1]) < 1e-9
    assert not got


def test_a_hot_key_is_cut_into_buckets(spark):
    rng = random.Random(2)
    prices = [("hot" if i % 4 else "cold", D(2020, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(400)]
    df = spark.createDataFrame(prices, "ticker string, event date, close double").withColumn("known", F.col("event").cast("timestamp_ntz"))
    assert asof.bucket_days_for(df, "ticker", "event") is None and asof.bucket_days_for(df.limit(0), "ticker", "event") is None
    assert asof.bucket_days_for(df, "ticker", "event", 50) == 399 * 50 // 300
    trades = spark.createDataFrame([(rng.choice(["hot", "cold", "none"]), rng.choice(["LONG", "SHORT"]), D(2020, 1, 1) + dt.timedelta(days=rng.randint(-9, 300)), D(2020, 1, 1) + dt.timedelta(days=rng.randint(300, 500))) for _ in range(60)], "ticker string, direction string, entry_date date, exit_date date")
    for mode in ("asof", "strict"):
        one, many = (sorted(map(str, asof.evaluate_trades(trades, df, mode, most=most).select("ticker", "direction", "entry_date", "exit_date", "entry_price", "exit_price", "outcome").collect())) for most in (10**6, 20))
        assert one == many and len(one) == 60


def test_moments_of_pairs_are_not_shuffled(spark):
    rows = spark.range(40).selectExpr("cast(id % 4 as string) as ticker", "date_add(date'2020-01-01', cast(id div 4 as int)) as event", "rand(1) as ret")
    plan = bars.correlation_matrix(rows, block_size=2)._jdf.queryExecution().executedPlan().toString()
    # Nothing but the pairs' own task stands above the rows that were dealt to it.
    assert "MapInArrow" in plan and "Exchange" not in plan.split("MapInArrow")[0] and "FlatMapGroups" not in plan


def test_ends_of_a_key_come_from_its_parts(spark, monkeypatch):
    from knowntime.operators import portfolio

    rows = spark.createDataFrame([(m, i, float(i * 7 % 50 // 2)) for m in "ab" for i in range(100)], "m string, i int, v double")
    monkeypatch.setattr(portfolio, "PARTS_OF_A_KEY", 3)
    got = {(r.m, r.i, r.side) for r in portfolio.best_and_worst(rows, "m", "v", ["i"]).collect()}
    values = sorted((i * 7 % 50 // 2, i) for i in range(100))
    best = sorted(values, key=lambda x: (-x[0], x[1]))
    assert got == {(m, i, side) for m in "ab" for side, order in (("best", best), ("worst", values)) for _, i in order[:5]}


def test_totals_of_quarters_need_no_window(spark):
    from knowntime.operators import portfolio

    rows = spark.range(60).selectExpr("id % 2 as manager", "date_add(date'2020-03-31', cast(id % 3 * 91 as int)) as period", "id % 7 as cusip", "cast(id as double) as shares", "cast(id as double) as value")
    history = portfolio.portfolio_history(rows.groupBy("manager", "period", "cusip").agg(F.sum("shares").alias("shares"), F.sum("value").alias("value")))
    windows = [line for line in history._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in line and "sum(value" in line]
    assert not windows
    sums = history.where("change <> 'closed'").groupBy("manager", "period").agg(F.sum("weight").alias("w")).collect()
    assert len(sums) == 6 and all(abs(r.w - 1) < 1e-9 for r in sums)


def test_blocks_of_tickers_are_shuffled_once(spark, monkeypatch):
    """Before, a ticker's rows were written once for each block of tickers, so the shuffle grew with their square."""
    monkeypatch.setattr(bars, "BLOCK_BYTES", 1200, raising=False)
    rng = np.random.default_rng(2)
    x, seen = rng.normal(size=(12, 40)), rng.random((12, 40)) < 0.7
    seen[11, :] = False
    rows = [(100 - i, D(2020, 1, 1) + dt.timedelta(days=t), float(x[i, t]) if seen[i, t] else None) for i in range(12) for t in range(40)]
    df = spark.createDataFrame([*rows, (None, D(2020, 1, 1), 1.0), (7, None, 1.0)], "ticker long, event date, ret double")
    made = bars.correlation_matrix(df, block_size=2, span_days=16)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "CartesianProduct" in plan
    got = {(r.a, r.b): (r.corr, r.n) for r in made.collect()}
    for i in range(11):
        for j in range(i + 1):
            both = seen[i] & seen[j]
            corr, n = got.pop((100 - i, 100 - j))
            assert n == both.sum() and abs(corr - np.corrcoef(x[i, both], x[j, both])[0, 1]) < 1e-9
    assert not got and bars.correlation_matrix(df.limit(0)).count() == 0
