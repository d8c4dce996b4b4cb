"""Market-data relations carried by the driver tables, as DataFrames and as SQL.

A supplier stands for a ticker and a ship date for a bar date; see the README.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knowntime.operators.windows import dealt

TODAY = "2001-12-31"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def shared(spark) -> str:
    """A new folder that driver and executors share; on one machine a temporary one where none is set."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = f"file:///tmp/spark-{uuid.uuid4().hex}"
        sc.setCheckpointDir(found)
    return f"{found.rstrip('/')}/store-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """A relation that operators read several times, as the table that it would be."""
    path = shared(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lines_by_order(spark, sf) -> DataFrame:
    """Lines dealt by order, for joins with the orders and windows over one."""
    rows = table(spark, sf, "lineitem")
    return dealt(rows.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"), "l_orderkey", rows.count())


def bars(spark, sf, by: tuple[str, ...] = ("ticker", "event")) -> DataFrame:
    """(ticker, event date, open, high, low, close, volume, dividends, known).

    Large tables are dealt out ``by``. With the ticker alone tables of any size are, and windows over a ticker need no further shuffle or sort.
    """
    at = F.struct("l_orderkey", "l_linenumber", "l_partkey")
    rows = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("ticker"), F.col("l_shipdate").cast("date").alias("event"), at.alias("at"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), "l_quantity", "l_tax")
    return dealt(rows if "event" in by else rows.repartition(*by), by, rows.count()).groupBy("ticker", "event").agg(
        F.min_by("price", "at").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "at").alias("close"),
        F.sum("l_quantity").alias("volume"), F.sum("l_tax").alias("dividends"),
    ).withColumn("known", F.col("event").cast("timestamp_ntz") + F.expr("INTERVAL 16 HOURS"))


BARS = """bars AS (
  SELECT l_suppkey AS ticker, l_shipdate::DATE AS event, arg_min(price, ord) AS open, max(price) AS high, min(price) AS low, arg_max(price, ord) AS close,
         sum(l_quantity) AS volume, sum(l_tax) AS dividends, l_shipdate::DATE + INTERVAL 16 HOUR AS known
  FROM (SELECT *, l_extendedprice / l_quantity AS price, (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey AS ord FROM lineitem)
  GROUP BY l_suppkey, l_shipdate::DATE)"""


def financials(spark, sf) -> DataFrame:
    """Quarterly and annual filings: 10-Q for the first three quarters, 10-K for the year."""
    x = F.col("l_extendedprice")
    rows = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("ticker"), F.year("l_shipdate").alias("year"), F.quarter("l_shipdate").alias("quarter"),
        (x * (1 - F.col("l_discount"))).alias("revenue"), (x * (1 - F.col("l_discount")) * (1 - F.col("l_tax"))).alias("gross_profit"),
        (x * (0.2 - F.col("l_discount"))).alias("net_income"), F.col("l_quantity").alias("shares"),
        (x * (0.25 - F.col("l_discount"))).alias("operating_income"), (x * F.col("l_tax")).alias("depreciation"), (x * (0.22 - F.col("l_discount"))).alias("operating_cf"),
        (x * -0.04).alias("capex"), (x * 0.5).alias("total_equity"), (x * 0.3).alias("lt_debt"), (F.col("l_quantity") * 120).alias("cash"))
    money = [F.sum(c).alias(c) for c in rows.columns[3:]]
    q = rows.where("quarter < 4").groupBy("ticker", "year", "quarter").agg(*money).withColumn("form", F.lit("10-Q"))
    k = rows.groupBy("ticker", "year").agg(*money).withColumns({"quarter": F.lit(4), "form": F.lit("10-K")})
    both = q.unionByName(k).withColumn("period_end", F.last_day(F.make_date("year", F.col("quarter") * 3, F.lit(1))))
    return both.withColumn("known", F.date_add("period_end", F.when(F.col("form") == "10-K", 90).otherwise(45))).withColumn("eps", F.col("net_income") / F.col("shares"))


FIN = """fin0 AS (
  SELECT l_suppkey AS ticker, year(l_shipdate) AS year, quarter(l_shipdate) AS quarter, l_extendedprice * (1 - l_discount) AS revenue,
         l_extendedprice * (1 - l_discount) * (1 - l_tax) AS gross_profit, l_extendedprice * (0.2 - l_discount) AS net_income, l_quantity AS shares,
         l_extendedprice * (0.25 - l_discount) AS operating_income, l_extendedprice * l_tax AS depreciation, l_extendedprice * (0.22 - l_discount) AS operating_cf,
         l_extendedprice * -0.04 AS capex, l_extendedprice * 0.5 AS total_equity, l_extendedprice * 0.3 AS lt_debt, l_quantity * 120 AS cash FROM lineitem),
fin1 AS (
  SELECT ticker, year, quarter, '10-Q' AS form, sum(COLUMNS(* EXCLUDE (ticker, year, quarter))) FROM fin0 WHERE quarter < 4 GROUP BY ticker, year, quarter
  UNION ALL SELECT ticker, year, 4, '10-K', sum(COLUMNS(* EXCLUDE (ticker, year, quarter))) FROM fin0 GROUP BY ticker, year),
fin AS (
  SELECT *, operating_cf - abs(capex) AS fcf, net_income / shares AS eps, last_day(make_date(year, quarter * 3, 1)) AS period_end,
         (last_day(make_date(year, quarter * 3, 1)) + CASE WHEN form = '10-K' THEN INTERVAL 90 DAY ELSE INTERVAL 45 DAY END)::DATE AS known FROM fin1)"""


def vintages(spark, sf) -> DataFrame:
    """(code, event, value, known, part): several releases of one observation."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("event"))
    return lines_by_order(spark, sf).join(orders, "l_orderkey").select(
        F.col("l_orderkey").alias("code"), F.col("l_linenumber").alias("line"), "event", F.col("l_extendedprice").alias("value"), F.col("l_shipdate").cast("date").alias("known"), F.col("l_partkey").alias("part"))


VINTAGES = """vintages AS (
  SELECT l_orderkey AS code, l_linenumber AS line, o_orderdate::DATE AS event, l_extendedprice AS value, l_shipdate::DATE AS known, l_partkey AS part
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

LAGS = {"view": 1, "click": 2, "signup": 35, "error": 45, "purchase": 90}


def facts(spark, sf) -> DataFrame:
    """Events that become known some days after they happen, by type."""
    lag = F.lit(0)
    for name, days in LAGS.items():
        lag = F.when(F.col("event_type") == name, days).otherwise(lag)
    e = table(spark, sf, "events")
    return e.select("event_id", "user_id", "event_type", "value", F.col("ts").alias("event"), (F.col("ts") + F.make_dt_interval(lag)).alias("known"))


FACTS = """facts AS (
  SELECT event_id, user_id, event_type, value, ts AS event,
         ts + to_days(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 35 WHEN 'error' THEN 45 WHEN 'purchase' THEN 90 ELSE 0 END) AS known FROM events)"""


def membership(spark, sf) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select((F.col("user_id") % 2).alias("index_name"), F.col("user_id").alias("ticker"), F.when(F.col("event_type").isin("signup", "view"), "added").otherwise("removed").alias("action"), F.col("ts").alias("day"), "event_id")


MEMBER = """member AS (
  SELECT user_id % 2 AS index_name, user_id AS ticker, CASE WHEN event_type IN ('signup', 'view') THEN 'added' ELSE 'removed' END AS action, ts AS day, event_id
  FROM events)"""


def holdings(spark, sf) -> DataFrame:
    """(manager, period, cusip, shares, value): positions at quarter ends."""
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.select(F.col("o_orderkey").alias("l_orderkey"), F.col("c_nationkey").alias("manager"), F.last_day(F.date_add(F.add_months(F.trunc("o_orderdate", "quarter"), 2), 0)).alias("period"))
    rows = lines_by_order(spark, sf).join(o, "l_orderkey")
    return rows.groupBy("manager", "period", F.col("l_suppkey").alias("cusip")).agg(F.sum("l_quantity").alias("shares"), F.sum("l_extendedprice").alias("value"))


HOLD = """hold AS (
  SELECT c_nationkey AS manager, last_day((date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH)::DATE) AS period, l_suppkey AS cusip, sum(l_quantity) AS shares, sum(l_extendedprice) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""
