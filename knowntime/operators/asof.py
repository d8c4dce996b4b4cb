"""As-of joins as one sort per key: no range join, no row blow-up."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from knowntime.functions.scalars import safe_div
from knowntime.operators.windows import dealt


@dataclass(frozen=True)
class Source:
    """A right side of an as-of join: its rows, their time, what to carry, and the order of rows at one time."""

    rows: DataFrame
    on: str
    columns: tuple[str, ...]
    tiebreak: tuple[str, ...] = ()


def asof_many(left: DataFrame, sources: list[Source], by: list[str], left_on: str, direction: str = "backward", tolerance_days: int | None = None, bucket_days: int | None = None, rows: int | None = None) -> DataFrame:
    """Each left row with the last row at or before it of every source (``forward``: the first at or after).

    All sides are put in one relation, and one window carries the last row of each
    source along as one struct, so that a null cell of the matched row stays null.
    With ``bucket_days`` a key is cut into buckets of time, and the rows that a bucket
    starts with are carried over from the buckets before it: a key with a third of
    all rows is then many groups. With ``rows``, those of all sides, these are dealt over as many tasks as they need.
    """
    back = direction == "backward"
    keep = [c for c in left.columns if c not in by]
    both = left.select(*by, F.col(left_on).alias("_t"), F.struct(*keep).alias("_left"), F.lit(1 if back else 0).alias("_side"))
    ties = []
    for i, s in enumerate(sources):
        row = F.struct(F.col(s.on).alias("_time"), *[F.col(c) for c in s.columns]).alias(f"_right{i}")
        tie = F.struct(*[F.col(c) for c in s.tiebreak]) if s.tiebreak else F.lit(0)
        both = both.unionByName(s.rows.select(*by, F.col(s.on).alias("_t"), F.lit(0 if back else 1).alias("_side"), row, tie.alias(f"_tie{i}")), allowMissingColumns=True)
        ties.append(F.col(f"_tie{i}").asc_nulls_first())
    group = list(by)
    if bucket_days:
        day = F.datediff(F.col("_t").cast("date"), F.lit("1970-01-01").cast("date"))
        both = both.withColumn("_bucket", F.floor(day / bucket_days))
        group.append("_bucket")
        edge = F.max_by if back else F.min_by
        ends = both.groupBy(*group).agg(*[edge(F.col(f"_right{i}"), F.when(F.col(f"_right{i}").isNotNull(), F.struct("_t", f"_tie{i}"))).alias(f"_end{i}") for i in range(len(sources))])
        w = Window.partitionBy(*by).orderBy("_bucket" if back else F.col("_bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
        carried = ends.select(*group, *[F.last(f"_end{i}", ignorenulls=True).over(w).alias(f"_carried{i}") for i in range(len(sources))])
        both = both.join(carried, group)
    both = dealt(both, group, rows)
    w = Window.partitionBy(*group)
    w = w.orderBy("_t", "_side", *ties) if back else w.orderBy(F.col("_t").desc(), F.col("_side").desc(), *ties)
    w = w.rowsBetween(Window.unboundedPreceding, 0)
    hits = {}
    for i in range(len(sources)):
        own = F.last(f"_right{i}", ignorenulls=True).over(w)
        hits[f"_hit{i}"] = F.coalesce(own, F.col(f"_carried{i}")) if bucket_days else own
    hit = both.withColumns(hits).where(F.col("_left").isNotNull())
    if tolerance_days is not None:
        hit = hit.withColumns({f"_hit{i}": F.when(F.abs(F.datediff(F.col("_t"), F.col(f"_hit{i}._time"))) <= tolerance_days, F.col(f"_hit{i}")) for i in range(len(sources))})
    return hit.select(*by, *[F.col(f"_left.{c}").alias(c) for c in keep], *[F.col(f"_hit{i}.{c}").alias(c) for i, s in enumerate(sources) for c in s.columns])


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str, columns: list[str], direction: str = "backward", tiebreak: list[str] | None = None, tolerance_days: int | None = None, bucket_days: int | None = None, rows: int | None = None) -> DataFrame:
    """:func:`asof_many` with one source; of right rows at the same time the last by ``tiebreak`` counts."""
    return asof_many(left, [Source(right, right_on, tuple(columns), tuple(tiebreak or ()))], by, left_on, direction, tolerance_days, bucket_days, rows)


#: Rows of one key that a task may sort by itself.
MOST_OF_A_KEY = 2_000_000


def bucket_days_for(rows: DataFrame, by: str, time: str, most: int = MOST_OF_A_KEY) -> int | None:
    """Days that a bucket of an as-of join should span so that none has far more than ``most`` rows; None if no key has as many.

    One aggregation of the key and time columns; a single row comes back.
    """
    own = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"), (F.datediff(F.max(time), F.min(time)) + 1).alias("days"))
    n, days = own.agg(F.max("n"), F.max_by("days", "n")).first()
    return max(1, days * most // n) if n and n > most else None


def price_on(requests: DataFrame, prices: DataFrame, by: str, request_date: str, price_date: str, price: str, out: str, bucket_days: int | None = None, rows: int | None = None) -> DataFrame:
    """All requested closes at once: the last one on or before each date."""
    named = prices.select(by, F.col(price_date).alias("_pd"), F.col(price).alias(out))
    return asof_join(requests, named, [by], request_date, "_pd", [out], bucket_days=bucket_days, rows=rows)


def evaluate_trades(trades: DataFrame, bars: DataFrame, mode: str = "asof", known: str = "known", most: int = MOST_OF_A_KEY, rows: int | None = None) -> DataFrame:
    """Profit of (ticker, direction, entry_date, exit_date) trades.

    ``asof``: the last close at or before each date. ``strict``: the first bar on
    or after the date that was known on that date. An unpriced trade keeps a row
    with the outcome ERROR.
    """
    days = bucket_days_for(bars, "ticker", "event", most)

    def priced(df, date, out):
        if mode == "asof":
            return price_on(df, bars, "ticker", date, "event", "close", out, days, rows)
        found = asof_join(df, bars.select("ticker", "event", F.col(known).alias("_known"), F.col("close").alias(out)), ["ticker"], date, "event", [out, "_known"], "forward", bucket_days=days, rows=rows)
        return found.withColumn(out, F.when(F.col("_known") <= F.col(date).cast("timestamp_ntz"), F.col(out))).drop("_known")

    both = priced(priced(trades, "entry_date", "entry_price"), "exit_date", "exit_price")
    gain = F.when(F.col("direction") == "SHORT", F.col("entry_price") - F.col("exit_price")).otherwise(F.col("exit_price") - F.col("entry_price"))
    return both.withColumns({
        "pnl_per_share": gain, "pnl_pct": safe_div(gain * 100, F.col("entry_price")), "holding_days": F.datediff("exit_date", "entry_date"),
        "outcome": F.when(gain.isNull(), "ERROR").when(gain > 0, "GAIN").otherwise("LOSS"),
    })


def vs_benchmark(r, b):
    """Geometric excess return over a benchmark."""
    return safe_div(1 + r, 1 + b) - 1
