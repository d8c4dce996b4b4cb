"""Sequences of one key: trailing sums, growth, streaks, islands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knowntime.functions.scalars import safe_div


def over(by, order) -> Window:
    by, order = ([x] if isinstance(x, str) else x for x in (by, order))
    return Window.partitionBy(*by).orderBy(*order)


#: Rows that a task of a window should have.
ROWS_OF_A_TASK = 250_000


def dealt(df: DataFrame, by, rows: int | None, most: int = ROWS_OF_A_TASK) -> DataFrame:
    """``df`` dealt by key over as many tasks as leave about ``most`` of its ``rows`` to each, where the session's shuffle partitions are fewer.

    So the memory of a task does not grow with the table. A key is one task's, however many rows it has.
    """
    tasks = -(-(rows or 0) // most)
    keys = [by] if isinstance(by, str) else list(by)
    return df.repartition(tasks, *keys) if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def trailing_sum(value: Column, by, order, rows: int, need: int = 1) -> Column:
    """Sum of the last ``rows`` values; null with fewer than ``need`` of them."""
    w = over(by, order).rowsBetween(-(rows - 1), 0)
    return F.when(F.count(value).over(w) >= need, F.sum(value).over(w))


def pct_change(value: Column, by, order) -> Column:
    """Change on the last present value before; gaps carry it forward."""
    w = over(by, order)
    seen = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    prior = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return safe_div(seen, prior) - 1


def yoy_change(value: Column, by, order, rows: int = 12) -> Column:
    """Percent change on the value ``rows`` rows earlier."""
    then = F.lag(value, rows).over(over(by, order))
    return safe_div(value - then, then) * 100


def cagr(value: Column, by, order, n: int, lo: float | None = None, hi: float | None = None, positive_now: bool = True) -> Column:
    """Yearly growth over ``n`` rows; needs a positive start, and a positive end unless told otherwise."""
    then = F.lag(value, n).over(over(by, order))
    now = value > 0 if positive_now else value >= 0
    g = F.when((then > 0) & now, F.pow(safe_div(value, then), F.lit(1.0 / n)) - 1)
    return g if lo is None else F.when(g.between(lo, hi), g)


def growth_streak(df, value: str, by, order, out: str = "streak"):
    """Consecutive rises that end at each row; gaps and islands, no loop."""
    w = over(by, order)
    up = F.coalesce(F.col(value) > F.lag(value).over(w), F.lit(False))
    marked = df.withColumn("_up", up).withColumn("_island", F.sum(F.when(F.col("_up"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    keys = [by] if isinstance(by, str) else list(by)
    return marked.withColumn(out, F.row_number().over(over([*keys, "_island"], order)) - 1).drop("_up", "_island")


def prior_mean(value: Column, by, order, rows: int) -> Column:
    """Mean of the present values among the ``rows`` rows before."""
    return F.avg(value).over(over(by, order).rowsBetween(-rows, -1))


def max_drawdown(df, value: str, by, order, out: str = "max_drawdown"):
    """Deepest fall from a running peak of the compounded returns, per key."""
    keys = [by] if isinstance(by, str) else list(by)
    w = over(by, order).rowsBetween(Window.unboundedPreceding, 0)
    grown = df.withColumn("_cum", F.product(1 + F.col(value)).over(w)).withColumn("_peak", F.max("_cum").over(w))
    return grown.groupBy(*keys).agg(F.min((F.col("_cum") - F.col("_peak")) / F.col("_peak")).alias(out))


def window_return(returns, by, value: str, need: int = 10, out: str = "ret"):
    """The compounded return of each key that has over ``need`` returns."""
    keys = [by] if isinstance(by, str) else list(by)
    grown = returns.where(F.col(value).isNotNull()).groupBy(*keys).agg((F.product(1 + F.col(value)) - 1).alias(out), F.count(F.lit(1)).alias("_n"))
    return grown.where(F.col("_n") > need).drop("_n")
