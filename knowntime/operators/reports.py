"""Dimensions and reports: the universe, sectors, short interest, institutional holdings, a snapshot's summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knowntime.functions.scalars import cap_bucket
from knowntime.operators import pit
from knowntime.operators.windows import over


def universe(live: dict[str, DataFrame], stored: DataFrame | None = None, bootstrap: list = ()) -> DataFrame:
    """(ticker, index_name): members of the live indices, the first index of each ticker; where there are none at all
    the stored copy, and where that is empty the bootstrap list."""
    levels = [df.select("ticker", F.lit(name).alias("index_name"), F.lit(0).alias("_level"), F.lit(i).alias("_place")) for i, (name, df) in enumerate(live.items())]
    first = levels[0]
    if stored is not None:
        levels.append(stored.select("ticker", "index_name", F.lit(1).alias("_level"), F.lit(0).alias("_place")))
    if bootstrap:
        kind = first.schema["ticker"].dataType
        levels.append(first.sparkSession.createDataFrame([(t,) for t in bootstrap], "ticker string").select(F.col("ticker").cast(kind).alias("ticker"), F.lit("bootstrap").alias("index_name"), F.lit(2).alias("_level"), F.lit(0).alias("_place")))
    rows = reduce(DataFrame.unionByName, levels)
    # One row: the best level that has any.
    best = F.broadcast(rows.agg(F.min("_level").alias("_level")))
    return pit.dedup_latest(rows.join(best, "_level"), ["ticker"], [F.col("_place"), F.col("index_name")]).select("ticker", "index_name")


#: Names of a profile's fields, and the sector table's columns for them.
PROFILE = {"sector": "sector", "industry": "industry", "industryKey": "gics_sub_industry", "country": "country", "exchange": "exchange"}


def sectors(info: DataFrame, known: Column) -> DataFrame:
    """A row a ticker from its profile: missing fields are blank, a missing market cap is a small one."""
    have = {name: F.coalesce(F.col(field), F.lit("")) if field in info.columns else F.lit("") for field, name in PROFILE.items()}
    return info.select("ticker", *[c.alias(n) for n, c in have.items()], cap_bucket(F.coalesce(F.col("marketCap"), F.lit(0))).alias("market_cap_category"), known.alias("knowledge_timestamp"))


def short_interest(info: DataFrame, known: Column) -> DataFrame:
    """Up to two rows a ticker: this month's settlement with its ratios, and the month before with shares only.

    Both are known when they are fetched, not when they settle. A settlement without shares or date gives no row; ratios of 0 are none.
    """
    def some(field, kind):
        return F.when(F.col(field) != 0, F.col(field)).cast(kind)

    def row(shares, date, days, share, source):
        settled = F.to_date(F.timestamp_seconds(F.col(date)))
        return F.when((F.col(shares) != 0) & (F.col(date) != 0), F.struct(
            settled.alias("settlement_date"), some(shares, "long").alias("shares_short"), days.alias("days_to_cover"), share.alias("short_pct_float"), some("floatShares", "long").alias("float_shares"), F.lit(source).alias("source")))

    none = F.lit(None).cast("double")
    rows = F.array(row("sharesShort", "dateShortInterest", some("shortRatio", "double"), some("shortPercentOfFloat", "double"), "current"), row("sharesShortPriorMonth", "sharesShortPreviousMonthDate", none, none, "prior"))
    return info.select("ticker", known.alias("knowledge_timestamp"), F.inline(F.array_compact(rows)))


def institutional_holdings(holdings: DataFrame, as_of, by: str = "manager", period: str = "period", known: str = "known") -> DataFrame:
    """All positions of each manager's latest filing known at ``as_of``: what was sold since an earlier one is gone."""
    public = pit.known_at(holdings, as_of, known)
    latest = public.groupBy(by).agg(F.max(F.struct(F.col(period), F.col(known))).alias("_latest"))
    return public.join(latest, by).where(F.struct(F.col(period), F.col(known)) == F.col("_latest")).drop("_latest")


def snapshot_report(as_of: str, bars: DataFrame, indicators: DataFrame, macro: DataFrame, columns: list[str], days: int = 252, least: int = 10, sample: int = 3) -> DataFrame:
    """(part, name, field, value): the latest price and the return of the window for every ticker, the latest value of
    every series, and the latest filled cell of every indicator for the first ``sample`` tickers.

    Returns are in percent, for tickers of more than ``least`` bars.
    """
    k = pit.in_lookback(pit.known_at(bars, as_of), as_of, days).where("close is not null")
    own = k.groupBy("ticker").agg(F.max_by("close", "event").alias("last"), F.min_by("close", "event").alias("first"), F.count(F.lit(1)).alias("n"))
    change = F.when(F.col("n") > least, F.round((F.col("last") / F.col("first") - 1) * 100, 2))
    prices = own.select(F.col("ticker").cast("string").alias("name"), F.inline(F.array(
        F.struct(F.lit("price").alias("part"), F.lit("close").alias("field"), F.round("last", 2).alias("value")), F.struct(F.lit("return").alias("part"), F.lit("pct").alias("field"), change.alias("value"))))).where("value is not null")
    # Of one event the last to be known counts.
    told = pit.known_at(macro.where("value is not null"), as_of)
    series = told.groupBy(F.col("code").cast("string").alias("name")).agg(F.round(F.max_by("value", F.struct("event", "known")), 4).alias("value")).select(F.lit("macro").alias("part"), "name", F.lit("value").alias("field"), "value")
    seen = pit.known_at(indicators, as_of).where(F.col("event").cast("date") <= F.lit(as_of).cast("date"))
    few = seen.select("ticker").distinct().orderBy("ticker").limit(sample)
    cells = pit.latest_values(pit.for_tickers(seen, few), "ticker", columns, ["event"])
    cells = cells.select(F.lit("indicator").alias("part"), F.col("ticker").cast("string").alias("name"), F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.round(F.col(c).cast("double"), 4).alias("value")) for c in columns]))).where("value is not null")
    return prices.select("part", "name", "field", "value").unionByName(series).unionByName(cells)


def with_unrevised(vintages: DataFrame, latest: DataFrame, by: str = "code") -> DataFrame:
    """Revisions, and for series that have none their latest values as revision 0, known when they are observed."""
    rest = latest.where("value is not null").join(vintages.select(by).distinct(), by, "left_anti")
    return vintages.select(by, "event", "known", "value", "revision").unionByName(rest.select(by, "event", F.col("event").alias("known"), "value", F.lit(0).alias("revision")))


def newest_settlements(rows: DataFrame, n: int = 2) -> DataFrame:
    """The ``n`` latest settlements of each ticker, numbered from the newest."""
    nth = F.row_number().over(over("ticker", [F.col("settlement").desc()])).cast("long")
    return rows.withColumn("nth", nth).where(F.col("nth") <= n)
