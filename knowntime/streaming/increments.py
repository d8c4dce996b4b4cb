"""Increments with Structured Streaming: deduplicated slices, bars kept up to date, upserts by batch.

Each query runs over what is there and stops (``availableNow``); its checkpoint is
the high-water mark and moves only after a batch is written. Batch jobs keep marks of their own by
job and key. Whatever is written twice after a crash is merged by key, so that it counts once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from knowntime.sources import store

MARKS = store.TableSpec("marks", ("job", "key"), (), version=("high_water",))
HEARTBEATS = store.TableSpec("heartbeats", ("job", "batch"), (), version=("rows",))


def stream(spark: SparkSession, path: str, time: str, glob: str | None = None) -> DataFrame:
    """A folder of Parquet files as a stream; the time column becomes a UTC timestamp."""
    source = f"{path}/{glob}" if glob else path
    schema = spark.read.parquet(source).schema
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path).withColumn(time, F.col(time).cast("timestamp"))


def deduplicated(df: DataFrame, time: str, key: list[str], overlap: str = "1 day") -> DataFrame:
    """Slices may overlap by ``overlap``; a key that was seen within it is dropped."""
    return df.withWatermark(time, overlap).dropDuplicatesWithinWatermark(key)


def weekly_bars(df: DataFrame, by: str, time: str, price: str, volume: str, ties: list[str] = (), late: str = "1 day") -> DataFrame:
    """Bars of Monday weeks that are emitted once the watermark has passed them; ``ties`` order rows of one time."""
    week, at = F.window(time, "1 week", startTime="4 days"), F.struct(time, *ties)
    out = df.withWatermark(time, late).groupBy(by, week.alias("w")).agg(
        F.min_by(price, at).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, at).alias("close"), F.sum(volume).alias("volume"))
    return out.select(by, F.col("w.start").cast("date").alias("period"), "open", "high", "low", "close", "volume")


def run_available(df: DataFrame, write: Callable[[DataFrame, int], object], checkpoint: str, mode: str = "append") -> None:
    """Hand every pending batch to ``write`` and stop; a second run has nothing to do."""
    query = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(lambda batch, n: write(batch, n) and None).trigger(availableNow=True).start()
    query.awaitTermination()


def with_heartbeat(write: Callable[[DataFrame, int], object], root: str, job: str, lag: Column) -> Callable[[DataFrame, int], None]:
    """``write``, after which the batch's rows and largest ``lag`` stand in the table ``heartbeats``.

    They are observed while ``write`` goes over the batch, which it has to do, so nothing is read twice; a batch that is
    handed over again has one heartbeat.
    """
    def run(batch, n):
        seen = Observation()
        write(batch.observe(seen, F.count(F.lit(1)).alias("rows"), F.max(lag).alias("largest_lag")), n)
        got = seen.get
        row = [(job, int(n), got["rows"], got["largest_lag"])]
        kind = batch.select(lag.alias("lag")).schema["lag"].dataType.simpleString()
        store.upsert(batch.sparkSession.createDataFrame(row, f"job string, batch long, rows long, largest_lag {kind}"), root, HEARTBEATS)

    return run


def marks(spark: SparkSession, root: str, job: str) -> DataFrame:
    """(key, high_water) of a job, as text and timestamp; none before its first run."""
    if not store.exists(spark, f"{root}/marks"):
        return spark.createDataFrame([], "key string, high_water timestamp_ntz")
    return store.read_table(spark, root, "marks").where(F.col("job") == job).select("key", "high_water")


def increment(rows: DataFrame, root: str, job: str, by: str, time: str, write: Callable[[DataFrame], object], start: str = "2009-12-31", overlap: str = "0 seconds") -> int:
    """Hand ``write`` the rows of each key past its mark (``start`` before the first run), then move the marks; how many rows that were.

    The rows are staged, so what is written and what moves the marks is the same, and a mark never goes back. A run
    that ends before the marks have moved hands the same rows over again: ``write`` merges by key. With an ``overlap`` rows that come
    late by as much are handed over too.
    """
    spark, staged = rows.sparkSession, f"{root}/_in-{uuid.uuid4().hex}"
    store.recover(spark, root, "marks")
    at = F.col(time).cast("timestamp_ntz")
    own = marks(spark, root, job).withColumnsRenamed({"key": "_key", "high_water": "_mark"})
    fresh = rows.join(own, F.col(by).cast("string").eqNullSafe(F.col("_key")), "left").withColumn("_mark", F.coalesce("_mark", F.lit(start).cast("timestamp_ntz")))
    fresh.where(at > F.col("_mark") - F.expr(f"INTERVAL {overlap}")).drop("_key").write.parquet(staged)
    fresh = spark.read.schema(fresh.drop("_key").schema).parquet(staged)
    n = fresh.count()
    if n:
        write(fresh.drop("_mark"))
        moved = fresh.groupBy(F.lit(job).alias("job"), F.col(by).cast("string").alias("key")).agg(F.greatest(F.max(at), F.max("_mark")).alias("high_water"))
        store.upsert(moved, root, MARKS)
    store.remove(spark, staged)
    return n


def refresh_buckets(batch: DataFrame, root: str, raw: store.TableSpec, derived: store.TableSpec, by: list[str], bucket: Column, compute: Callable[[DataFrame], DataFrame]) -> None:
    """Merge a batch into ``raw`` and compute anew the buckets of ``derived`` that any new, corrected or moved row lies in.

    ``bucket`` is what a row's ``period`` is; ``compute`` makes rows of (by, period, ...) of all raw rows, with their ``period``, of some
    buckets. A bucket that has no row any more goes. Which buckets are touched is written before the raw rows
    change and forgotten once ``derived`` has followed, so a run that ends anywhere in between is made good by the next.
    """
    spark, key = batch.sparkSession, list(raw.key)
    staged, pending = f"{root}/_in-{uuid.uuid4().hex}", f"{root}/{derived.name}_pending"
    batch.write.parquet(staged)
    batch = spark.read.schema(batch.schema).parquet(staged)
    touched = batch.select(*by, bucket.alias("period"))
    store.recover(spark, root, raw.name)
    if store.exists(spark, f"{root}/{raw.name}"):
        old = store.read_table(spark, root, raw.name, {c: batch.schema[c].dataType for c in raw.partitions if c in batch.columns})
        old = old.alias("o").join(batch.select(*key).alias("n"), store.same("o", "n", key), "left_semi")
        touched = touched.unionByName(old.select(*by, bucket.alias("period")))
    touched.distinct().write.mode("append").parquet(pending)
    store.upsert(batch, root, raw)
    touched = spark.read.schema(touched.schema).parquet(pending).distinct()
    rows = store.read_table(spark, root, raw.name).withColumn("period", bucket)
    rows = rows.alias("r").join(touched.alias("t"), store.same("r", "t", [*by, "period"]), "left_semi")
    fresh = compute(rows).withColumn("_gone", F.lit(False))
    gone = touched.alias("t").join(fresh.alias("f"), store.same("t", "f", [*by, "period"]), "left_anti").withColumn("_gone", F.lit(True))
    store.upsert(fresh.unionByName(gone, allowMissingColumns=True), root, derived, delete_col="_gone")
    store.remove(spark, pending)
    store.remove(spark, staged)


def with_history(batch: DataFrame, history: DataFrame, keys: list[str], time: str, warm_up_days: int, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Recompute windows over a batch and the history before it; return the batch's rows only."""
    since = batch.agg(F.min(time).alias("_since"))
    old = history.join(batch.select(*keys).distinct(), keys, "left_semi").join(F.broadcast(since), (F.col(time) < F.col("_since")) & (F.col(time) >= F.col("_since") - F.expr(f"INTERVAL {warm_up_days} DAYS"))).drop("_since")
    both = old.withColumn("_batch", F.lit(False)).unionByName(batch.withColumn("_batch", F.lit(True)), allowMissingColumns=True)
    return compute(both).where("_batch").drop("_batch")


def high_water(df: DataFrame, by: str, time: str, keys: DataFrame | None = None, job: str = "default", start: str = "2009-12-31") -> DataFrame:
    """(job, key, high_water): where the next slice of each key begins; keys without rows begin at ``start``."""
    own = df.groupBy(by).agg(F.max(time).alias("high_water"))
    if keys is not None:
        own = keys.select(by).distinct().join(own, by, "left").withColumn("high_water", F.coalesce("high_water", F.lit(start).cast(df.schema[time].dataType)))
    return own.select(F.lit(job).alias("job"), by, "high_water")


def heartbeat(df: DataFrame, time: str, rows: int = 7) -> DataFrame:
    """Rows that arrived each day, and the mean of the days before."""
    daily = df.groupBy(F.col(time).cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    # One row a day: a calendar fits one task.
    before = Window.partitionBy(F.lit(0)).orderBy("day").rowsBetween(-rows, -1)
    return daily.withColumn("usual", F.avg("n").over(before))
