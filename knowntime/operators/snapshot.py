"""What was known at one moment: the parts of a snapshot, and their flat form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from knowntime.operators import pit
from knowntime.operators.windows import yoy_change


def snapshot(
    as_of: str, days: int, members: DataFrame | None = None, bars: DataFrame | None = None, indicators: DataFrame | None = None, filings: DataFrame | None = None,
    macro: DataFrame | None = None, events: dict[str, DataFrame] | None = None, meetings: DataFrame | None = None, last_meetings: int = 8,
) -> dict[str, DataFrame]:
    """The parts that are asked for, each as a long table of what was public at ``as_of``.

    Prices and indicators lie in the ``days`` before; of category ``events`` the knowledge
    does. Filings are the newest of each ticker, macro the newest revision of
    each observation, meetings the last few.
    """
    out = {}
    for name, df in (("prices", bars), ("indicators", indicators)):
        if df is not None:
            out[name] = pit.in_lookback(pit.known_at(df, as_of), as_of, days)
    if filings is not None:
        out["filings"] = pit.latest_filing(filings, as_of)
    if macro is not None:
        out["macro"] = pit.latest_revision(macro, as_of, ["code", "event"])
    for name, df in (events or {}).items():
        out[name] = pit.in_lookback(df, as_of, days, "known")
    if meetings is not None:
        out["meetings"] = pit.known_at(meetings, as_of).orderBy(F.col("event").desc()).limit(last_meetings)
    if members is not None:
        out = {name: pit.for_tickers(df, members) if "ticker" in df.columns else df for name, df in out.items()}
        out["members"] = members
    return out


def flat_features(parts: dict[str, DataFrame], as_of: str, filing_columns: list[str], indicator_columns: list[str]) -> DataFrame:
    """One row a member with the parts as map columns, as a model reads them."""
    out = parts["members"].select("ticker").distinct().withColumn("as_of", F.lit(as_of).cast("date"))

    def as_map(columns):
        return F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*[F.col(c).cast("double") for c in columns]))

    if "prices" in parts:
        p = parts["prices"].groupBy("ticker").agg(F.max_by("close", "event").alias("price"), F.count(F.lit(1)).alias("bars"), F.sum("volume").alias("volume"))
        out = out.join(p.select("ticker", as_map(["price", "bars", "volume"]).alias("prices")), "ticker", "left")
    if "indicators" in parts:
        last = parts["indicators"].groupBy("ticker").agg(*[F.max_by(c, "event").alias(c) for c in indicator_columns])
        out = out.join(last.select("ticker", as_map(indicator_columns).alias("indicators")), "ticker", "left")
    if "filings" in parts:
        out = out.join(parts["filings"].select("ticker", as_map(filing_columns).alias("filing")), "ticker", "left")
    counts = [df.select("ticker", F.lit(name).alias("kind")) for name, df in parts.items() if name not in ("prices", "indicators", "filings", "macro", "meetings", "members")]
    if counts:
        every = counts[0]
        for c in counts[1:]:
            every = every.unionByName(c)
        n = every.groupBy("ticker", "kind").agg(F.count(F.lit(1)).alias("n")).groupBy("ticker").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", F.col("n").cast("double"))))).alias("events"))
        out = out.join(n, "ticker", "left")
    if "macro" in parts:
        # One row: the newest value of each code.
        newest = parts["macro"].where("value is not null").groupBy("code").agg(F.max_by("value", "event").alias("value"))
        one = newest.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("code", "value")))).alias("macro"), F.lit(as_of).cast("date").alias("as_of"))
        out = out.join(F.broadcast(one), "as_of", "left")
    return out


def _as_map(columns: dict):
    return F.map_from_arrays(F.array(*[F.lit(n) for n in columns]), F.array(*[c.cast("double") for c in columns.values()]))


def _in_window(rows: DataFrame, dates: DataFrame, by: list[str], time: str, known: str, days: int, sums: dict[str, str], last: list[str]) -> DataFrame:
    """(as_of, by, n, sums, last): number and sums of each key's rows in the ``days`` before every date, and columns of the last of them.

    Running totals, of which that of the date less that of the window's beginning counts: each row stands for one span of dates
    either way, so no row meets every date of its window. Rows are known in the order of ``time``, and within ``days`` of it.
    """
    w = Window.partitionBy(*by).orderBy(time, known)
    total = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = rows.where(F.col(time).isNotNull() & F.col(known).isNotNull()).select(*by, F.col(time).cast("timestamp_ntz").alias("_t"), F.col(known).cast("timestamp_ntz").alias("_k"), F.count(F.lit(1)).over(total).alias("n"), *[F.sum(c).over(total).alias(name) for name, c in sums.items()], *last, F.lead(time).over(w).cast("timestamp_ntz").alias("_t2"), F.lead(known).over(w).cast("timestamp_ntz").alias("_k2"))
    past = F.expr(f"INTERVAL {int(days)} DAYS 0.000001 SECONDS")
    names = ["n", *sums]
    now = F.struct(F.lit(1).alias("sign"), F.col("_k").alias("since"), F.col("_k2").alias("until"))
    then = F.struct(F.lit(-1).alias("sign"), (F.col("_t") + past).alias("since"), (F.col("_t2") + past).alias("until"))
    spans = run.select("*", F.inline(F.array(now, then))).where("until is null or until > since")
    met = pit.as_ofs_within(spans.select(*by, "sign", "since", "until", *names, *last), dates, "since", "until")
    end = F.col("sign") == 1
    both = met.groupBy("as_of", *by).agg(*[F.sum(F.col("sign") * F.col(c)).alias(c) for c in names], *[F.max(F.when(end, F.col(c))).alias(c) for c in last])
    return both.where("n > 0")


def flat_calendar(
    dates: DataFrame, members: DataFrame, days: int, bars: DataFrame | None = None, indicators: DataFrame | None = None, filings: DataFrame | None = None, macro: DataFrame | None = None,
    events: dict[str, DataFrame] | None = None, filing_columns: list[str] = (), indicator_columns: list[str] = (), known: str | None = None,
) -> DataFrame:
    """:func:`flat_features` of :func:`snapshot` for every ``as_of`` of ``dates`` in one plan: a row a date and member.

    ``members`` are intervals (ticker, start, end). Every part becomes spans of time in which a fact stands, so it
    gives at most a row a key and date. A macro revision without a value counts as none.
    """
    out = pit.members_panel(members, dates, ["ticker"], known)
    parts = []
    if bars is not None:
        p = _in_window(bars, dates, ["ticker"], "event", "known", days, {"volume": "volume"}, ["close"])
        parts.append(p.select("as_of", "ticker", _as_map({"price": F.col("close"), "bars": F.col("n"), "volume": F.col("volume")}).alias("prices")))
    if indicators is not None:
        p = pit.panel_at(indicators.select("ticker", "event", "known", *indicator_columns), dates, ["ticker"], ["event"], "known", "event", days)
        parts.append(p.select("as_of", "ticker", _as_map({c: F.col(c) for c in indicator_columns}).alias("indicators")))
    if filings is not None:
        p = pit.panel_at(filings.select("ticker", "period_end", "known", *filing_columns), dates, ["ticker"], ["known", "period_end"], "known")
        parts.append(p.select("as_of", "ticker", _as_map({c: F.col(c) for c in filing_columns}).alias("filing")))
    if events:
        told = reduce(DataFrame.unionByName, [df.select("ticker", F.lit(name).alias("kind"), "known") for name, df in events.items()])
        n = _in_window(told, dates, ["ticker", "kind"], "known", "known", days, {}, [])
        n = n.groupBy("as_of", "ticker").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", F.col("n").cast("double"))))).alias("events"))
        parts.append(n)
    for part in parts:
        out = out.join(part, ["as_of", "ticker"], "left")
    if macro is not None:
        p = pit.panel_at(macro.where("value is not null").select("code", "event", "revision", "known", "value"), dates, ["code"], ["event", "revision"], "known", "event")
        # A row a date, as wide as there are series.
        p = p.groupBy("as_of").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("code", "value")))).alias("macro"))
        out = out.join(p, "as_of", "left")
    return out


def nested_calendar(flat: DataFrame, per_row: int = 1000, tickers: int | None = None) -> DataFrame:
    """(as_of, block, tickers): a map from ticker to its features, in blocks of about ``per_row`` tickers, as a model's loader reads them.

    ``tickers`` is how many there are; without it all of ``flat`` is computed once more to count them.
    """
    tickers = tickers or flat.select("ticker").distinct().count()
    block = F.pmod(F.xxhash64("ticker"), F.lit(max(1, -(-tickers // per_row)))).alias("block")
    features = F.struct(*[c for c in flat.columns if c not in ("as_of", "ticker")])
    return flat.groupBy("as_of", block).agg(F.map_from_entries(F.collect_list(F.struct("ticker", features))).alias("tickers"))


def macro_table(releases: DataFrame, derived: dict[str, str], rows: int = 12) -> DataFrame:
    """Series with their revisions, and for each code in ``derived`` a series of the name it maps to: the change in percent on ``rows`` observations before.

    ``releases`` has (code, event, known, value); a change is known when the newest revision of its observation is.
    """
    numbered = pit.number_revisions(releases.where("value is not null"), ["code", "event"], ["known", "value"])
    named = F.create_map(*[F.lit(x) for pair in derived.items() for x in pair])
    newest = pit.dedup_latest(numbered.where(F.col("code").isin(*derived)), ["code", "event"], [F.col("revision").desc()])
    change = newest.withColumn("value", F.round(yoy_change(F.col("value"), "code", "event", rows), 4)).where("value is not null")
    return numbered.select("code", "event", "known", "value", "revision").unionByName(change.select(named[F.col("code")].alias("code"), "event", "known", "value", F.lit(0).alias("revision")))
