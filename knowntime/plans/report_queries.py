"""Snapshots and dimensions for reports."""

from pyspark.sql import functions as F

from knowntime.operators import quality as Q
from knowntime.operators.bars import pivot_long
from knowntime.operators.reports import institutional_holdings, newest_settlements, sectors, short_interest, snapshot_report
from knowntime.plans.proxies import BARS, HOLD, bars, holdings, shared, stored, table
from knowntime.plans.registry import query
from knowntime.sources import store
from knowntime.streaming import increments

KINDS = ["view", "click", "signup", "error", "purchase"]


@query("d5_pivot_indicators", f"""SELECT user_id, {', '.join(f"arg_max(value, (ts, event_id)) FILTER (WHERE event_type = '{k}') AS {k}" for k in KINDS)} FROM events GROUP BY 1""")
def d5(spark, sf):
    e = table(spark, sf, "events").withColumn("order", F.struct("ts", "event_id"))
    return pivot_long(e, "user_id", "event_type", "value", KINDS, "order")


@query("f14_snapshot_report", f"""WITH {BARS}, k AS (SELECT * FROM bars WHERE event BETWEEN DATE '1998-06-30' - 252 AND DATE '1998-06-30' AND known <= TIMESTAMP '1998-06-30'),
o AS (SELECT ticker, arg_max(close, event) AS last, arg_min(close, event) AS first, count(*) AS n FROM k GROUP BY 1),
m AS (SELECT o_orderpriority AS name, arg_max(o_totalprice, (o_orderdate::DATE, o_orderdate::DATE + (o_orderkey % 5)::INT, o_totalprice)) AS value FROM orders WHERE o_orderdate::DATE + (o_orderkey % 5)::INT <= DATE '1998-06-30' GROUP BY 1),
i AS (SELECT ticker, event, CASE WHEN volume > 30 THEN high END AS top, low FROM bars WHERE event <= DATE '1998-06-30' AND known <= TIMESTAMP '1998-06-30' AND ticker IN (SELECT ticker FROM bars WHERE event <= DATE '1998-06-30' AND known <= TIMESTAMP '1998-06-30' GROUP BY 1 ORDER BY 1 LIMIT 3))
SELECT 'price' AS part, ticker::VARCHAR AS name, 'close' AS field, round(last, 2) AS value FROM o UNION ALL SELECT 'return', ticker::VARCHAR, 'pct', round((last / first - 1) * 100, 2) FROM o WHERE n > 10 UNION ALL SELECT 'macro', name, 'value', round(value, 4) FROM m
UNION ALL SELECT 'indicator', ticker::VARCHAR, 'top', round(arg_max(top, event) FILTER (WHERE top IS NOT NULL), 4) FROM i GROUP BY ticker HAVING count(top) > 0 UNION ALL SELECT 'indicator', ticker::VARCHAR, 'low', round(arg_max(low, event), 4) FROM i GROUP BY ticker""")
def f14(spark, sf):
    b, day = stored(bars(spark, sf)), F.col("o_orderdate").cast("date")
    # Of releases of one day the largest counts, on both sides.
    macro = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("code"), day.alias("event"), F.date_add(day, (F.col("o_orderkey") % 5).cast("int")).alias("known")).agg(F.max("o_totalprice").alias("value"))
    indicators = b.select("ticker", "event", "known", F.when(F.col("volume") > 30, F.col("high")).alias("top"), "low")
    return snapshot_report("1998-06-30", b, indicators, macro, ["top", "low"])


@query("f17_sectors", """SELECT s_suppkey AS ticker, n_name AS sector, '' AS industry, '' AS gics_sub_industry, r_name AS country, coalesce(CASE WHEN s_suppkey % 3 > 0 THEN s_name END, '') AS exchange,
CASE WHEN s_suppkey % 7 = 0 THEN 'small' WHEN s_acctbal * 5e7 > 200e9 THEN 'mega' WHEN s_acctbal * 5e7 > 10e9 THEN 'large' WHEN s_acctbal * 5e7 > 2e9 THEN 'mid' ELSE 'small' END AS market_cap_category, DATE '2024-01-01' AS knowledge_timestamp
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def f17(spark, sf):
    s, n, r = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    joined = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    profile = joined.select(F.col("s_suppkey").alias("ticker"), F.col("n_name").alias("sector"), F.col("r_name").alias("country"), F.when(F.col("s_suppkey") % 3 > 0, F.col("s_name")).alias("exchange"), F.when(F.col("s_suppkey") % 7 > 0, F.col("s_acctbal") * 5e7).alias("marketCap"))
    return sectors(profile, F.lit("2024-01-01").cast("date"))


@query("f18_short_interest", """WITH p AS (SELECT o_orderkey AS ticker, CASE WHEN o_orderkey % 5 > 0 THEN nullif(o_custkey, 0) END AS now, o_orderdate::DATE AS day, o_orderkey % 3 / 2.0 AS ratio, nullif(o_custkey * 10, 0) AS float_shares FROM orders)
SELECT ticker, day AS settlement_date, now AS shares_short, nullif(ratio, 0)::DOUBLE AS days_to_cover, nullif(ratio, 0)::DOUBLE / 8 AS short_pct_float, float_shares, 'current' AS source, DATE '2024-01-01' AS knowledge_timestamp FROM p WHERE now IS NOT NULL
UNION ALL SELECT ticker, day - 30, ticker, NULL, NULL, float_shares, 'prior', DATE '2024-01-01' FROM p WHERE ticker % 2 = 0 AND ticker > 0""")
def f18(spark, sf):
    o, at = table(spark, sf, "orders"), F.unix_date(F.col("o_orderdate").cast("date")).cast("long") * 86400
    ratio = F.col("o_orderkey") % 3 / 2
    profile = o.select(F.col("o_orderkey").alias("ticker"), F.when(F.col("o_orderkey") % 5 > 0, F.col("o_custkey")).alias("sharesShort"), at.alias("dateShortInterest"), ratio.alias("shortRatio"), (ratio / 8).alias("shortPercentOfFloat"), (F.col("o_custkey") * 10).alias("floatShares"),
                       F.col("o_orderkey").alias("sharesShortPriorMonth"), F.when(F.col("o_orderkey") % 2 == 0, at - 30 * 86400).alias("sharesShortPreviousMonthDate"))
    return short_interest(profile, F.lit("2024-01-01").cast("date"))


@query("f18_settlements", f"""WITH {BARS}, m AS (SELECT ticker, last_day(event) AS settlement, sum(volume) AS shares_short FROM bars GROUP BY 1, 2)
SELECT ticker, settlement, shares_short, row_number() OVER (PARTITION BY ticker ORDER BY settlement DESC) AS nth FROM m QUALIFY nth <= 2""")
def f18_settlements(spark, sf):
    return newest_settlements(bars(spark, sf).groupBy("ticker", F.last_day("event").alias("settlement")).agg(F.sum("volume").alias("shares_short")))


@query("f19_institutional_holdings", f"""WITH {HOLD}, k AS (SELECT * FROM hold WHERE period + 45 <= DATE '1999-06-30') SELECT manager, cusip, period, shares FROM k WHERE (manager, period) IN (SELECT (manager, max(period)) FROM k GROUP BY manager)""")
def f19(spark, sf):
    h = holdings(spark, sf).withColumn("known", F.date_add("period", 45))
    return institutional_holdings(h, "1999-06-30").select("manager", "cusip", "period", "shares")


@query("k17_summary", f"""WITH {BARS}, r AS (SELECT count(*) FILTER (WHERE high < low) AS bad, 'FAIL' AS level FROM bars UNION ALL SELECT count(*) FILTER (WHERE volume > 50), 'WARN' FROM bars UNION ALL SELECT count(*) FILTER (WHERE close > 5000), 'FAIL' FROM bars)
SELECT CASE WHEN bad = 0 THEN 'PASS' ELSE level END AS status, count(*) AS rules, sum(bad)::BIGINT AS bad FROM r GROUP BY 1""")
def k17(spark, sf):
    found = Q.check(bars(spark, sf), [Q.rule("a", F.col("high") < F.col("low")), Q.rule("b", F.col("volume") > 50, warn=True), Q.rule("c", F.col("close") > 5000)])
    return Q.summary([found])


@query("i2_stream_deduplicated", "SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def i2(spark, sf):
    """The same file twice as overlapping slices: every event counts once."""
    root = shared(spark)
    e = table(spark, sf, "events")
    for part in range(2):
        e.withColumn("slice", F.lit(part)).write.mode("append").parquet(f"{root}/in")
    seen = increments.deduplicated(increments.stream(spark, f"{root}/in", "ts"), "ts", ["event_id"], "40 days")
    increments.run_available(seen, lambda batch, n: batch.write.mode("append").parquet(f"{root}/out"), f"{root}/marks")
    return store.read_table(spark, root, "out").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
