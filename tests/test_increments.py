"""Increments that end at any point, and bars that follow corrections."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from knowntime.sources import store
from knowntime.streaming import increments


def at(n):
    return dt.datetime(2020, 1, 1) + dt.timedelta(days=n)


@pytest.mark.parametrize("broken", ["before", "after", None])
def test_marks_follow_what_is_written(spark, tmp_path, monkeypatch, broken):
    root, spec = f"file://{tmp_path}", store.TableSpec("t", ("id",), (), version=("ts",))
    rows = [(i, "ab"[i % 2] if i % 7 else None, at(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, k string, ts timestamp_ntz")
    given = []

    def write(batch):
        given.append(batch.count())
        if broken == "before" and len(given) == 2:
            raise InterruptedError
        store.upsert(batch, root, spec)
        if broken == "after" and len(given) == 2:
            raise InterruptedError

    for until in (8, 15, 15, 20, 20):
        try:
            increments.increment(df.where(F.col("id") < until), root, "job", "k", "ts", write)
        except InterruptedError:
            pass
    assert given == ([8, 7, 7, 5] if broken else [8, 7, 5])
    assert sorted(r.id for r in store.read_table(spark, root, "t").collect()) == list(range(20))
    assert {r.key: r.high_water for r in increments.marks(spark, root, "job").collect()} == {k: max(t for _, j, t in rows if j == k) for k in ("a", "b", None)}
    assert increments.marks(spark, root, "other").count() == 0
    # Rows as late as the overlap are handed over again; marks stay where they are.
    assert increments.increment(df, root, "job", "k", "ts", write, overlap="2 days") == 3


def bars_of(rows):
    return rows.groupBy("k", "period").agg(F.sum("v").alias("volume"), F.count(F.lit(1)).alias("n"))


@pytest.mark.parametrize("ends", [None, "t", "bars"])
def test_bars_follow_late_and_moved_rows(spark, tmp_path, monkeypatch, ends):
    root, rng = f"file://{tmp_path}", random.Random(3)
    raw, derived = store.TableSpec("t", ("id",), ("year",), "ts", ("ts",)), store.TableSpec("bars", ("k", "period"), (), version=("volume",))
    week = F.to_date(F.date_trunc("week", "ts"))
    state, upsert = {}, store.upsert
    for wave in range(3):
        batch = [(i, rng.choice("ab"), at(rng.randint(0, 60)), rng.randint(1, 9)) for i in rng.sample(range(40), 25)]
        state |= {r[0]: r for r in batch}
        df = spark.createDataFrame(batch, "id int, k string, ts timestamp_ntz, v int")
        if wave == 1 and ends:
            # The run ends before the table ``ends`` is merged; the same batch comes again.
            monkeypatch.setattr(store, "upsert", lambda rows, at, spec, *a, **b: (_ for _ in ()).throw(InterruptedError) if spec.name == ends else upsert(rows, at, spec, *a, **b))
            with pytest.raises(InterruptedError):
                increments.refresh_buckets(df, root, raw, derived, ["k"], week, bars_of)
            monkeypatch.undo()
        increments.refresh_buckets(df, root, raw, derived, ["k"], week, bars_of)
        want = {}
        for _, k, t, v in state.values():
            key = (k, (t - dt.timedelta(days=t.weekday())).date())
            want[key] = (want.get(key, (0, 0))[0] + v, want.get(key, (0, 0))[1] + 1)
        assert {(r.k, r.period): (r.volume, r.n) for r in store.read_table(spark, root, "bars").collect()} == want


def test_a_heartbeat_a_batch(spark, tmp_path):
    root = f"file://{tmp_path}"
    df = spark.createDataFrame([(1, 5), (2, 9), (3, None)], "id int, lag int")
    write = increments.with_heartbeat(lambda batch, n: batch.write.mode("append").parquet(f"{root}/out"), root, "job", F.col("lag"))
    for n in (0, 1, 1):
        write(df.where(F.col("id") > n), n)
    assert sorted(map(tuple, store.read_table(spark, root, "heartbeats").select("job", "batch", "rows", "largest_lag").collect())) == [("job", 0, 3, 9), ("job", 1, 2, 9)]
