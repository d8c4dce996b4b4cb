"""What was known when: point-in-time filters, revisions, membership and panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def known_at(df: DataFrame, as_of, known: str = "known") -> DataFrame:
    """Rows that were public at ``as_of``: no other row may be read."""
    return df.where(F.col(known) <= F.lit(as_of))


def in_lookback(df: DataFrame, as_of, days: int, time: str = "event") -> DataFrame:
    """Rows whose ``time`` lies in the ``days`` before ``as_of``, both ends included."""
    end = F.lit(as_of).cast("timestamp_ntz")
    return df.where(F.col(time).between(end - F.expr(f"INTERVAL {int(days)} DAYS"), end))


def for_tickers(df: DataFrame, tickers, column: str = "ticker") -> DataFrame:
    """A short list as a predicate, a table as a semi join."""
    if isinstance(tickers, DataFrame):
        return df.join(tickers.select(column), column, "left_semi")
    return df.where(F.col(column).isin(*tickers))


def dedup_latest(df: DataFrame, keys: list[str], version: list[Column]) -> DataFrame:
    """One row a key, the first by ``version``; give it a total order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*version))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def number_revisions(df: DataFrame, keys: list[str], order: list[str], out: str = "revision") -> DataFrame:
    """0 for the first release of an observation, then 1, 2, ..."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def latest_revision(df: DataFrame, as_of, keys: list[str], revision: str = "revision", known: str = "known") -> DataFrame:
    """The highest revision of each observation that was known at ``as_of``."""
    return dedup_latest(known_at(df, as_of, known), keys, [F.col(revision).desc(), F.col(known).desc()])


def latest_filing(df: DataFrame, as_of, by: str = "ticker", known: str = "known", tiebreak: str = "period_end") -> DataFrame:
    return dedup_latest(known_at(df, as_of, known), [by], [F.col(known).desc(), F.col(tiebreak).desc()])


def latest_values(df: DataFrame, by: str, columns: list[str], order: list[str]) -> DataFrame:
    """Per key the last non-null value of each column on its own."""
    at = F.struct(*order)
    return df.groupBy(by).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns])


def membership_intervals(events: DataFrame, keys: list[str], action: str, at: str, added: str = "added", removed: str = "removed", order: list[str] | None = None) -> DataFrame:
    """Add and remove events as [start, end) intervals, open at the end while a member.

    A second add while a member and a remove while none change nothing.
    """
    w = Window.partitionBy(*keys).orderBy(at, *(order or []))
    steps = events.where(F.col(action).isin(added, removed)).withColumn("_prev", F.lag(action).over(w))
    steps = steps.where(((F.col(action) == added) & (F.coalesce("_prev", F.lit(removed)) == removed)) | ((F.col(action) == removed) & (F.col("_prev") == added)))
    spans = steps.withColumn("end", F.lead(at).over(w)).where(F.col(action) == added)
    return spans.select(*keys, F.col(at).alias("start"), "end")


def members_at(intervals: DataFrame, as_of, known: str | None = None) -> DataFrame:
    """Members on a day; with ``known`` only of the additions that were public by then."""
    day = F.lit(as_of)
    inside = intervals.where((F.col("start") <= day) & (F.col("end").isNull() | (F.col("end") > day)))
    return known_at(inside, as_of, known) if known else inside


def membership_counts(events: DataFrame, by: str = "index_name", action: str = "action") -> DataFrame:
    """Additions, removals and distinct tickers of each index."""
    return events.groupBy(by).agg(F.count_if(F.col(action) == "added").alias("added"), F.count_if(F.col(action) == "removed").alias("removed"), F.count_distinct("ticker").alias("tickers"))


def pending_backfill(removed: DataFrame, current: DataFrame, done: DataFrame, batch: int | None = None, key: str = "ticker") -> DataFrame:
    """Removed keys that are not members again and not done yet; ``batch`` takes the first of them in order."""
    left = removed.select(key).distinct().join(current.select(key), key, "left_anti").join(done.select(key), key, "left_anti")
    return left if batch is None else left.orderBy(key).limit(batch)


def calendar(spark, first: str, last: str, step: str, name: str = "as_of") -> DataFrame:
    return spark.sql(f"SELECT explode(sequence(DATE'{first}', DATE'{last}', INTERVAL {step})) AS {name}")


def pit_panel(facts: DataFrame, dates: DataFrame, by: str, event: str, known: str, lookback_days: int, bucket_days: int = 32) -> DataFrame:
    """Every as_of of ``dates`` with the facts known by then whose event is in the lookback.

    Both sides carry a bucket of the time axis, so the join is an equi-join with
    a residual condition and not a nested loop; a date meets only the buckets
    that its lookback touches.
    """
    day = F.datediff(F.col(event).cast("date"), F.lit("1970-01-01").cast("date"))
    left = facts.withColumn("_bucket", F.floor(day / bucket_days))
    number = F.datediff("as_of", F.lit("1970-01-01").cast("date"))
    span = F.sequence(F.floor((number - lookback_days) / bucket_days), F.floor(number / bucket_days))
    right = dates.withColumn("_bucket", F.explode(span))
    at = F.col("as_of").cast("timestamp_ntz")
    fits = (F.col(event) <= at) & (F.col(event) >= at - F.expr(f"INTERVAL {int(lookback_days)} DAYS")) & (F.col(known) <= at)
    return left.join(right, "_bucket").where(fits).drop("_bucket")


def panel_latest(panel: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The newest fact of each key at each as_of."""
    return dedup_latest(panel, ["as_of", *by], order)


def as_ofs_within(spans: DataFrame, dates: DataFrame, start: str, end: str, bucket_days: int | None = None) -> DataFrame:
    """Each span [start, end) with every ``as_of`` of ``dates`` in it; a null end is open, a null start no span.

    Both sides carry a bucket of the calendar, about one date wide, so the join is an equi-join, what a span is cut
    into grows with its dates, and a short span meets one date or two. Only the calendar's two ends are collected.
    """
    first, last, n = dates.agg(F.min("as_of"), F.max("as_of"), F.count(F.lit(1))).first()
    if not n:
        return spans.join(dates.limit(0), F.lit(False)).select(*spans.columns, "as_of")
    size = bucket_days or max(1, ((last - first).days + 1) // n)

    def bucket(c):
        return F.floor(F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")) / size)

    low = F.greatest(bucket(F.col(start)), bucket(F.lit(first)))
    high = F.least(F.coalesce(bucket(F.col(end)), bucket(F.lit(last))), bucket(F.lit(last)))
    left = spans.withColumn("_bucket", F.explode(F.when(low <= high, F.sequence(low, high))))
    at = F.col("as_of").cast("timestamp_ntz")
    fits = (F.col(start) <= at) & (F.col(end).isNull() | (F.col(end) > at))
    return left.join(dates.withColumn("_bucket", bucket(F.col("as_of"))), "_bucket").where(fits).select(*spans.columns, "as_of")


def valid_spans(facts: DataFrame, by: list[str], order: list[str], known: str, event: str | None = None, lookback_days: int | None = None) -> DataFrame:
    """Facts with (``since``, ``until``): the time in which each is the greatest by ``order`` of its key's known ones.

    One that is known after a greater one is never it and is left out. With a lookback, which ``order`` must then begin
    with the time of, a fact ends that many days after its event; those before it have ended by then.
    """
    if lookback_days is not None and order[0] != event:
        raise ValueError("with a lookback the newest event must count first")
    since = F.col(known) if event is None else F.greatest(F.col(known).cast("timestamp_ntz"), F.col(event).cast("timestamp_ntz"))
    w = Window.partitionBy(*by).orderBy("since", *order)
    at = F.struct(*order)
    # What has no knowledge time is never known.
    best = facts.where(F.col(known).isNotNull()).withColumn("since", since).withColumn("_before", F.max(at).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    best = best.where(F.col("_before").isNull() | (at >= F.col("_before"))).drop("_before")
    best = best.withColumn("until", F.lead("since").over(w))
    if lookback_days is not None:
        best = best.withColumn("until", F.least("until", F.col(event).cast("timestamp_ntz") + F.expr(f"INTERVAL {int(lookback_days)} DAYS 0.000001 SECONDS")))
    return best.where("until is null or until > since")


def panel_at(facts: DataFrame, dates: DataFrame, by: list[str], order: list[str], known: str, event: str | None = None, lookback_days: int | None = None) -> DataFrame:
    """Every key's newest known fact at every ``as_of``: at most a row a key and date, however many facts there are."""
    return as_ofs_within(valid_spans(facts, by, order, known, event, lookback_days), dates, "since", "until").drop("since", "until")


def members_panel(intervals: DataFrame, dates: DataFrame, keys: list[str], known: str | None = None) -> DataFrame:
    """(as_of, keys) of the members at every date; with ``known`` only of additions that were public by then."""
    public = F.greatest(F.col("start").cast("timestamp_ntz"), F.col(known).cast("timestamp_ntz")) if known else F.col("start")
    # ``greatest`` passes nulls over: what has no start, or is not known, is no member.
    spans = intervals.where(F.col("start").isNotNull() & (F.col(known).isNotNull() if known else F.lit(True))).withColumn("start", public)
    return as_ofs_within(spans.select(*keys, "start", "end"), dates, "start", "end").select("as_of", *keys).distinct()


def leaks(panel: DataFrame, known: str) -> DataFrame:
    """Rows of a panel that were not known at their as_of; there must be none."""
    return panel.where(F.col(known) > F.col("as_of").cast("timestamp_ntz"))
