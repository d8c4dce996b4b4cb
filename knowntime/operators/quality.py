"""Data-quality rules: one scan a table, one row a rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knowntime.sources.store import broken_files


def rule(name: str, bad: Column, warn: bool = False) -> tuple[str, Column, bool]:
    """No row may satisfy ``bad``."""
    return name, F.count_if(F.coalesce(bad, F.lit(False))), warn


def share(name: str, good: Column, least: float) -> tuple[str, Column, bool]:
    """At least a share of the rows satisfies ``good``; counts 0 or 1."""
    return name, (F.coalesce(F.avg(good.cast("double")), F.lit(0.0)) < least).cast("long"), False


def at_least(name: str, value: Column, least) -> tuple[str, Column, bool]:
    return name, (F.coalesce(value, F.lit(0)) < least).cast("long"), False


def in_range(name: str, column: str, lo, hi) -> tuple[str, Column, bool]:
    return rule(name, ~F.col(column).between(lo, hi))


def check(df: DataFrame, rules: list[tuple[str, Column, bool]]) -> DataFrame:
    """(rule, status, bad) of all rules in one aggregation."""
    made = df.agg(*[c.cast("long").alias(f"r{i}") for i, (_, c, _) in enumerate(rules)])
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(w).alias("warn"), F.col(f"r{i}").alias("bad")) for i, (n, _, w) in enumerate(rules)])
    out = made.select(F.inline(rows))
    return out.select("rule", F.when(F.col("bad") == 0, "PASS").when(F.col("warn"), "WARN").otherwise("FAIL").alias("status"), "bad")


def unique_key(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    twice = df.groupBy(*keys).count().where("count > 1")
    return check(twice, [(name, F.count(F.lit(1)), False)])


def missing_keys(name: str, wanted: DataFrame, df: DataFrame, key: str) -> DataFrame:
    gone = wanted.select(key).distinct().join(df.select(key), key, "left_anti")
    return check(gone, [(name, F.count(F.lit(1)), False)])


def allowed_values(name: str, df: DataFrame, column: str, values: list) -> DataFrame:
    return check(df.select(column).distinct(), [rule(name, ~F.col(column).isin(*values) | F.col(column).isNull())])


def coverage(df: DataFrame, by: str, event: str, end: str, least: float = 0.9, need: int = 30) -> DataFrame:
    """Bars a key has against the trading days it could have had; short histories are left out."""
    own = df.groupBy(by).agg(F.count(F.lit(1)).alias("bars"), F.min(event).alias("first"), F.max(event).alias("last"))
    could = F.datediff(F.least(F.lit(end).cast("date"), F.col("last").cast("date")), F.col("first").cast("date")) * 252 / 365
    return own.withColumns({"possible": could, "thin": (could >= need) & (F.col("bars") < least * could)})


def stale(df: DataFrame, by: str, event: str, today: str, days: int = 10) -> DataFrame:
    return df.groupBy(by).agg(F.max(event).alias("last")).where(F.datediff(F.lit(today).cast("date"), F.col("last").cast("date")) > days)


def summary(results: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results).groupBy("status").agg(F.count(F.lit(1)).alias("rules"), F.sum("bad").alias("bad"))


def required_columns(name: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """How many of the columns a table must have are missing."""
    gone = len([c for c in columns if c not in df.columns])
    return check(df.limit(1), [(name, F.lit(gone), False)])


def distinct_keys(name: str, df: DataFrame, key: str, least: int) -> DataFrame:
    """At least so many distinct keys; fails with 1."""
    return check(df.select(key).distinct(), [at_least(name, F.count(F.lit(1)), least)])


def depth(name: str, df: DataFrame, event: str, first: str) -> DataFrame:
    """The history reaches back to ``first``; fails with 1."""
    return check(df.agg(F.min(event).alias("first")), [rule(name, F.col("first").isNull() | (F.col("first") > F.lit(first).cast("date")))])


def parseable_dates(name: str, df: DataFrame, column: str) -> DataFrame:
    """Values that are there and are no dates."""
    text = F.col(column).cast("string")
    return check(df, [rule(name, text.isNotNull() & F.try_to_timestamp(text).isNull())])


def spot_values(name: str, df: DataFrame, expected: DataFrame, keys: list[str], value: str, tolerance: float) -> DataFrame:
    """Rows of ``expected`` (keys, value) that are missing or off by more than a share of the value."""
    both = expected.withColumnRenamed(value, "_want").join(df.select(*keys, F.col(value).alias("_got")), keys, "left")
    off = F.col("_got").isNull() | (F.abs(F.col("_got") - F.col("_want")) > tolerance * F.abs("_want"))
    return check(both, [(name, F.count_if(off), False)])


def unreadable_files(name: str, files: DataFrame, rows: DataFrame) -> DataFrame:
    """Files (path) that gave no row of ``rows`` (_file) though they are no tables without rows, a warning each."""
    return check(broken_files(files, rows), [(name, F.count(F.lit(1)), True)])


def same_rows(name: str, before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows, with their number of copies, that are in one table only: 0 if a re-run changed nothing."""
    columns = before.columns
    a = before.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    b = after.select(*columns).groupBy(*columns).agg((-F.count(F.lit(1))).alias("_n"))
    return check(a.unionByName(b).groupBy(*columns).agg(F.sum("_n").alias("_n")), [(name, F.sum(F.abs("_n")), False)])


def quarantined(name: str, bad: DataFrame, like: str | None = None, warn: bool = False) -> DataFrame:
    """Rows of a quarantine (row, reason, n), of all reasons or of those that begin with ``like``."""
    rows = bad if like is None else bad.where(F.col("reason").startswith(like))
    return check(rows, [(name, F.coalesce(F.sum("n"), F.lit(0)), warn)])
