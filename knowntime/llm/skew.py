"""Joins and orders that no single key can pile up in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import stage

HOT_SHARE = 256


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``rows`` inner-joined with one row per ``key``; ``size`` is the key's row count.

    Keys that hold over 1/256 of ``total`` number at most 256: they are
    broadcast and their rows stay where they are. The rest is a shuffle join.
    """
    hot = F.broadcast(groups.where(F.col(size) * HOT_SHARE > total))
    cold = groups.where(F.col(size) * HOT_SHARE <= total)
    columns = list(dict.fromkeys([*rows.columns, *groups.columns]))
    in_hot = rows.join(hot, key).select(*columns)
    return in_hot.unionByName(rows.join(hot, key, "left_anti").join(cold, key).select(*columns))


def running_total(df: DataFrame, keys: list[str], amount: Column, name: str, label: str) -> DataFrame:
    """Adds ``name``: the sum of ``amount`` over all rows before this one in the order of ``keys``.

    A range-partitioned sort, a sum within each partition, and the partition
    sums added up: nothing but one row per partition meets in one task.
    ``keys`` must be unique together.
    """
    parts = df.withColumn("_n", amount.cast("long")).repartitionByRange(*keys).withColumn("_part", F.spark_partition_id())
    parts = stage(parts, label)
    sums = parts.groupBy("_part").agg(F.sum("_n").alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select("_part", before.alias("_before"))
    inside = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    summed = parts.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    return summed.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_inside")).drop("_part", "_n", "_before", "_inside")
