"""Snapshots of a whole calendar against a loop over its days."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from knowntime.operators import pit, snapshot

DAY = dt.date(2020, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def at(n):
    return dt.datetime(2020, 1, 1) + dt.timedelta(days=n)


def test_spans_and_dates(spark):
    dates = spark.createDataFrame([(day(n),) for n in (0, 7, 14, 100, 101)], "as_of date")
    spans = [("a", at(0), at(7)), ("b", at(0.5), None), ("c", at(-50), at(14.1)), ("d", at(200), None), ("e", at(7), at(7)), ("f", None, None), ("g", at(8), at(13)), ("h", at(-9), at(-1))]
    df = spark.createDataFrame(spans, "k string, start timestamp_ntz, end timestamp_ntz")
    want = {("a", 0), ("b", 7), ("b", 14), ("b", 100), ("b", 101), ("c", 0), ("c", 7), ("c", 14)}
    for size in (None, 1, 13, 1000):
        assert {(r.k, (r.as_of - DAY).days) for r in pit.as_ofs_within(df, dates, "start", "end", size).collect()} == want
    assert pit.as_ofs_within(df, dates.limit(0), "start", "end").count() == 0
    assert "NestedLoop" not in pit.as_ofs_within(df, dates, "start", "end")._jdf.queryExecution().executedPlan().toString()
    got = pit.members_panel(df.withColumn("known", F.lit(at(10))), dates, ["k"], "known")
    assert {(r.k, (r.as_of - DAY).days) for r in got.collect()} == {("b", 14), ("b", 100), ("b", 101), ("c", 14)}


@pytest.mark.parametrize("lookback", [None, 20])
def test_newest_known_fact(spark, lookback):
    rng = random.Random(1)
    facts = []
    for i in range(400):
        event = rng.randint(-30, 60)
        facts.append((rng.choice("abc"), at(event), at(event + rng.choice([0, 0.3, 1, 5, 40])), i))
    df = spark.createDataFrame(facts, "k string, event timestamp_ntz, known timestamp_ntz, n int")
    dates = spark.createDataFrame([(day(n),) for n in range(-40, 120, 3)], "as_of date")
    want = set()
    for n in range(-40, 120, 3):
        for k in "abc":
            known = [f for f in facts if f[0] == k and f[2] <= at(n) and f[1] <= at(n) and (lookback is None or f[1] >= at(n - lookback))]
            if known:
                want.add((n, k, max(known, key=lambda f: (f[1], f[3]))[3]))
    got = pit.panel_at(df, dates, ["k"], ["event", "n"], "known", "event", lookback)
    assert {((r.as_of - DAY).days, r.k, r.n) for r in got.collect()} == want
    with pytest.raises(ValueError):
        pit.valid_spans(df, ["k"], ["n"], "known", "event", 5)


def test_calendar_is_the_daily_loop(spark):
    rng = random.Random(2)
    tickers = list("abcdefg")
    bars = [(t, day(n), at(n + 0.7), float(rng.randint(1, 99)), float(rng.randint(1, 9))) for t in tickers for n in sorted(rng.sample(range(90), 40))]
    bars = spark.createDataFrame(bars, "ticker string, event date, known timestamp_ntz, close double, volume double")
    averages = bars.select("ticker", "event", "known", F.when(F.col("close") > 20, F.col("close") * 2).alias("x"))
    filings = spark.createDataFrame([(t, day(n - 30), at(n), float(rng.randint(1, 99))) for t in tickers for n in rng.sample(range(-20, 90), 5)], "ticker string, period_end date, known timestamp_ntz, revenue double")
    macro = spark.createDataFrame([(c, day(n), at(n + 3 * r), r, float(rng.randint(1, 99))) for c in "XY" for n in range(0, 90, 11) for r in range(rng.randint(1, 3))], "code string, event date, known timestamp_ntz, revision int, value double")
    events = {k: spark.createDataFrame([(rng.choice(tickers), at(rng.uniform(-10, 90))) for _ in range(60)], "ticker string, known timestamp_ntz") for k in ("insider", "congress")}
    members = spark.createDataFrame([(t, at(i * 6), None if i % 2 else at(i * 6 + 40)) for i, t in enumerate(tickers)], "ticker string, start timestamp_ntz, end timestamp_ntz")
    days = [10, 33, 60, 61, 95, 140]
    dates = spark.createDataFrame([(day(n),) for n in days], "as_of date")
    flat = snapshot.flat_calendar(dates, members, 25, bars, averages, filings, macro, events, ["revenue"], ["x"])
    want = []
    for n in days:
        own = pit.members_at(members, at(n)).select("ticker")
        parts = snapshot.snapshot(str(day(n)), 25, own, bars, averages, filings, macro, events)
        want += snapshot.flat_features(parts, str(day(n)), ["revenue"], ["x"]).collect()
    columns = ["as_of", "ticker", "prices", "indicators", "filing", "events", "macro"]
    rows = lambda found: sorted(str([(sorted(r[c].items()) if isinstance(r[c], dict) else r[c]) or None for c in columns]) for r in found)
    assert rows(flat.collect()) == rows(want) and len(want) > 15
    nested = snapshot.nested_calendar(flat, 3)
    again = nested.select("as_of", F.explode("tickers").alias("ticker", "f")).select("as_of", "ticker", "f.*")
    assert rows(again.collect()) == rows(want) and nested.select("block").distinct().count() > 1


def test_short_spans_meet_few_dates(spark):
    dates = pit.calendar(spark, "1993-01-15", "1999-01-15", "2 MONTH")
    own = spark.range(1000).selectExpr("id AS k", "TIMESTAMP_NTZ'1993-02-01' + make_dt_interval(cast(id * 2 AS int)) AS start")
    cut = own.withColumn("end", F.col("start") + F.expr("INTERVAL 2 DAYS"))
    met = pit.as_ofs_within(cut, dates, "start", "end")
    # The buckets of spans and of dates: what the conditions look at, without them.
    kept, where = [], type(met).where
    try:
        type(met).where = lambda self, *a: kept.append(self) or where(self, *a)
        pit.as_ofs_within(cut, dates, "start", "end")
    finally:
        type(met).where = where
    assert kept[-1].count() <= 2 * cut.count() and met.count() == 33


def test_bars_of_the_calendar_are_computed_once(spark):
    from knowntime.plans import pit_queries

    made = pit_queries._calendar(spark, "/root/testdata/sf0.001")
    assert "max_by" not in made._jdf.queryExecution().optimizedPlan().toString()


def test_bars_by_ticker_take_one_shuffle(spark):
    from knowntime.plans.proxies import bars

    b = bars(spark, "/root/testdata/sf0.001", ("ticker",)).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("ticker")))
    assert b._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
