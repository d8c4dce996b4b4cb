"""Point-in-time queries: what was known when."""

from pyspark.sql import functions as F

from knowntime.operators import asof, pit
from knowntime.operators.indicators import sma
from knowntime.operators.snapshot import flat_calendar, flat_features, macro_table, nested_calendar, snapshot
from knowntime.plans.proxies import BARS, FACTS, FIN, MEMBER, VINTAGES, bars, facts, financials, lines_by_order, membership, stored, table, vintages
from knowntime.plans.registry import query

AS_OF = "2024-01-20"


TRADES = """trades AS (SELECT DISTINCT o_orderkey AS order_id, l_suppkey AS ticker, CASE WHEN o_orderkey % 2 = 0 THEN 'LONG' ELSE 'SHORT' END AS direction, o_orderdate::DATE AS entry_date, o_orderdate::DATE + 30 AS exit_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


@query("b1_known_at", f"WITH {FACTS} SELECT event_id, event, known FROM facts WHERE known <= TIMESTAMP '{AS_OF}'")
def b1(spark, sf):
    return pit.known_at(facts(spark, sf), AS_OF).select("event_id", "event", "known")


@query("b2_in_lookback", f"""WITH {FACTS} SELECT event_id, event FROM facts WHERE known <= TIMESTAMP '{AS_OF}' AND event BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 5 DAY AND TIMESTAMP '{AS_OF}'""")
def b2(spark, sf):
    return pit.in_lookback(pit.known_at(facts(spark, sf), AS_OF), AS_OF, 5).select("event_id", "event")


@query("b3_for_tickers", "SELECT count(*) AS n, l_suppkey AS ticker FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY l_suppkey")
def b3(spark, sf):
    wanted = table(spark, sf, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("ticker"))
    rows = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("ticker"))
    return pit.for_tickers(rows, wanted).groupBy("ticker").agg(F.count(F.lit(1)).alias("n"))


@query("c1_asof_join", """
WITH t AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'purchase'), q AS (SELECT user_id, ts, value, event_id AS quote FROM events WHERE event_type = 'view')
SELECT t.user_id, t.ts, t.event_id, q.value, q.quote FROM t ASOF LEFT JOIN q ON t.user_id = q.user_id AND t.ts >= q.ts""")
def c1(spark, sf):
    e = table(spark, sf, "events")
    t = e.where("event_type = 'purchase'").select("user_id", "ts", "event_id")
    q = e.where("event_type = 'view'").select("user_id", F.col("ts").alias("at"), "value", F.col("event_id").alias("quote"))
    return asof.asof_join(t, q, ["user_id"], "ts", "at", ["value", "quote"], tiebreak=["quote"])


@query("c1_asof_buckets", """
WITH t AS (SELECT user_id % 2 AS side, ts, event_id FROM events WHERE event_type = 'purchase'), q AS (SELECT user_id % 2 AS side, ts, value, event_id AS quote FROM events WHERE event_type = 'view'), k AS (SELECT user_id % 2 AS side, ts, event_id AS click FROM events WHERE event_type = 'click'),
a AS (SELECT t.*, q.value, q.quote FROM t ASOF LEFT JOIN q ON t.side = q.side AND t.ts >= q.ts) SELECT a.*, k.click FROM a ASOF LEFT JOIN k ON a.side = k.side AND a.ts >= k.ts""")
def c1_buckets(spark, sf):
    """Two hot keys, cut into spans of three days, and two right sides in one pass."""
    e = table(spark, sf, "events").withColumn("side", F.col("user_id") % 2)
    t = e.where("event_type = 'purchase'").select("side", "ts", "event_id")
    q = e.where("event_type = 'view'").select("side", F.col("ts").alias("at"), "value", F.col("event_id").alias("quote"))
    k = e.where("event_type = 'click'").select("side", F.col("ts").alias("at"), F.col("event_id").alias("click"))
    return asof.asof_many(t, [asof.Source(q, "at", ("value", "quote"), ("quote",)), asof.Source(k, "at", ("click",), ("click",))], ["side"], "ts", bucket_days=3)


@query("c3_evaluate_strict", f"""WITH {BARS}, {TRADES}, a AS (SELECT t.*, CASE WHEN b.known <= t.entry_date::TIMESTAMP THEN b.close END AS p0 FROM trades t ASOF LEFT JOIN bars b ON t.ticker = b.ticker AND t.entry_date <= b.event),
p AS (SELECT a.*, CASE WHEN b.known <= a.exit_date::TIMESTAMP THEN b.close END AS p1 FROM a ASOF LEFT JOIN bars b ON a.ticker = b.ticker AND a.exit_date <= b.event), g AS (SELECT *, CASE direction WHEN 'SHORT' THEN p0 - p1 ELSE p1 - p0 END AS gain FROM p)
SELECT order_id, ticker, direction, CASE WHEN gain IS NULL THEN 'ERROR' WHEN gain > 0 THEN 'GAIN' ELSE 'LOSS' END AS outcome FROM g""".replace("b.known", "(b.known - INTERVAL 16 HOUR)"))
def c3_strict(spark, sf):
    """The first bar on or after the date, if it was known on that date; here bars are known at the start of their day."""
    early = stored(bars(spark, sf).select("ticker", "event", "close")).withColumn("known", F.col("event").cast("timestamp_ntz"))
    trades = stored(_trades(spark, sf))
    return asof.evaluate_trades(trades, early, "strict", rows=trades.count() + early.count()).select("order_id", "ticker", "direction", "outcome")


@query("c1_asof_forward", """
WITH t AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'purchase'), q AS (SELECT user_id, ts, value FROM events WHERE event_type = 'view')
SELECT t.user_id, t.ts, t.event_id, q.value FROM t ASOF LEFT JOIN q ON t.user_id = q.user_id AND t.ts <= q.ts""")
def c1_forward(spark, sf):
    e = table(spark, sf, "events")
    t = e.where("event_type = 'purchase'").select("user_id", "ts", "event_id")
    q = e.where("event_type = 'view'").select("user_id", F.col("ts").alias("at"), "value")
    return asof.asof_join(t, q, ["user_id"], "ts", "at", ["value"], "forward")


@query("c2_price_on", f"""WITH {BARS}, r AS (SELECT DISTINCT l_suppkey AS ticker, o_orderdate::DATE AS day FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT r.ticker, r.day, round(b.close, 8) AS price FROM r ASOF LEFT JOIN bars b ON r.ticker = b.ticker AND r.day >= b.event""")
def c2(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("day"))
    r = table(spark, sf, "lineitem").join(o, "l_orderkey").select(F.col("l_suppkey").alias("ticker"), "day").distinct()
    return asof.price_on(r, bars(spark, sf), "ticker", "day", "event", "close", "price").withColumn("price", F.round("price", 8))


def _trades(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("entry_date"), F.when(F.col("o_orderkey") % 2 == 0, "LONG").otherwise("SHORT").alias("direction"))
    return lines_by_order(spark, sf).join(o, "l_orderkey").select(F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("ticker"), "direction", "entry_date", F.date_add("entry_date", 30).alias("exit_date")).distinct()


@query("c3_evaluate_trades", f"""WITH {BARS}, {TRADES}, a AS (SELECT t.*, b.close AS p0 FROM trades t ASOF LEFT JOIN bars b ON t.ticker = b.ticker AND t.entry_date >= b.event),
p AS (SELECT a.*, b.close AS p1, CASE direction WHEN 'SHORT' THEN p0 - b.close ELSE b.close - p0 END AS gain FROM a ASOF LEFT JOIN bars b ON a.ticker = b.ticker AND a.exit_date >= b.event)
SELECT order_id, ticker, direction, round(gain, 8) AS pnl_per_share, round(gain * 100 / p0, 4) AS pnl_pct, CASE WHEN gain IS NULL THEN 'ERROR' WHEN gain > 0 THEN 'GAIN' ELSE 'LOSS' END AS outcome FROM p""")
def c3(spark, sf):
    trades, b = stored(_trades(spark, sf)), stored(bars(spark, sf).select("ticker", "event", "close"))
    done = asof.evaluate_trades(trades, b, rows=trades.count() + b.count())
    return done.select("order_id", "ticker", "direction", F.round("pnl_per_share", 8).alias("pnl_per_share"), F.round("pnl_pct", 4).alias("pnl_pct"), "outcome")


@query("c9_pit_panel", f"""WITH {FACTS}, days AS (SELECT unnest(generate_series(DATE '2024-01-05', DATE '2024-01-30', INTERVAL 5 DAY))::DATE AS as_of),
p AS (SELECT as_of, user_id, event_type, value, event, event_id FROM days JOIN facts ON event <= as_of AND event >= as_of - INTERVAL 12 DAY AND known <= as_of)
SELECT as_of, user_id, arg_max(value, (event, event_id)) AS value, count(*) AS n FROM p GROUP BY ALL""")
def c9(spark, sf):
    days = pit.calendar(spark, "2024-01-05", "2024-01-30", "5 DAY")
    panel = pit.pit_panel(facts(spark, sf), days, "user_id", "event", "known", 12)
    return panel.groupBy("as_of", "user_id").agg(F.max_by("value", F.struct("event", "event_id")).alias("value"), F.count(F.lit(1)).alias("n"))


@query("k11_no_leak", f"""WITH {FACTS}, days AS (SELECT unnest(generate_series(DATE '2024-01-05', DATE '2024-01-25', INTERVAL 5 DAY))::DATE AS as_of),
w AS (SELECT as_of, event_id, user_id, known > as_of AS hidden FROM days JOIN facts ON event <= as_of AND event >= as_of - INTERVAL 30 DAY)
SELECT as_of, count(*) AS happened, count(*) FILTER (WHERE hidden) AS held_back, count(DISTINCT user_id) FILTER (WHERE NOT hidden) AS visible, 0::BIGINT AS leaks FROM w GROUP BY 1""")
def k11(spark, sf):
    """At five dates: what had happened, what a panel holds back of it, the keys it shows, and rows it shows that were not known, by a join with all that had happened."""
    days = pit.calendar(spark, "2024-01-05", "2024-01-25", "5 DAY")
    f = facts(spark, sf)
    everything = pit.pit_panel(f.withColumn("told", F.col("known")).withColumn("known", F.col("event")), days, "user_id", "event", "known", 30).select("as_of", "event_id", "user_id", "told")
    shown = pit.pit_panel(f, days, "user_id", "event", "known", 30).select("as_of", "event_id", F.lit(True).alias("shown"))
    late = F.col("told") > F.col("as_of").cast("timestamp_ntz")
    both = everything.join(shown, ["as_of", "event_id"], "full")
    return both.groupBy("as_of").agg(
        F.count("told").alias("happened"), F.count_if(F.col("shown").isNull()).alias("held_back"), F.count_distinct(F.when(F.col("shown"), F.col("user_id"))).alias("visible"),
        F.count_if(F.col("shown").isNotNull() & (late | F.col("told").isNull())).alias("leaks"))


@query("k11_panel_leaks", f"""WITH {FACTS}, days AS (SELECT unnest(generate_series(DATE '2024-01-05', DATE '2024-01-25', INTERVAL 5 DAY))::DATE AS as_of)
SELECT 'newest' AS panel, count(DISTINCT (as_of, user_id)) AS n_rows, 0::BIGINT AS leaks FROM days JOIN facts ON event <= as_of AND event >= as_of - INTERVAL 12 DAY AND known <= as_of
UNION ALL SELECT 'by event', count(*), count(*) FILTER (WHERE known > as_of) FROM days JOIN facts ON event <= as_of AND event >= as_of - INTERVAL 12 DAY""")
def k11_panel(spark, sf):
    """The check for leaks on a panel of what was known, where it finds none, and on one that goes by the time of the event, where it does."""
    days, f = pit.calendar(spark, "2024-01-05", "2024-01-25", "5 DAY"), facts(spark, sf)
    newest = pit.panel_at(f, days, ["user_id"], ["event", "event_id"], "known", "event", 12).select("as_of", F.col("known").alias("told"))
    by_event = pit.pit_panel(f.withColumn("told", F.col("known")).withColumn("known", F.col("event")), days, "user_id", "event", "known", 12).select("as_of", "told")
    out = []
    for name, panel in (("newest", newest), ("by event", by_event)):
        n = panel.agg(F.lit(name).alias("panel"), F.count(F.lit(1)).alias("n_rows"))
        out.append(n.join(pit.leaks(panel, "told").agg(F.lit(name).alias("panel"), F.count(F.lit(1)).alias("leaks")), "panel"))
    return out[0].unionByName(out[1])


@query("e1_latest_filing", f"""WITH {FIN} SELECT ticker, form, period_end, known, round(revenue, 4) AS revenue FROM fin WHERE known <= DATE '1999-06-30'
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY known DESC, period_end DESC) = 1""")
def e1(spark, sf):
    return pit.latest_filing(financials(spark, sf), "1999-06-30").select("ticker", "form", "period_end", "known", F.round("revenue", 4).alias("revenue"))


@query("e2_latest_revision", f"""WITH {VINTAGES}, r AS (SELECT *, row_number() OVER (PARTITION BY code, line, event ORDER BY known, part, value) - 1 AS revision FROM vintages)
SELECT code, line, event, value, revision FROM r WHERE known <= DATE '2000-01-01' QUALIFY row_number() OVER (PARTITION BY code, line, event ORDER BY revision DESC) = 1""")
def e2(spark, sf):
    r = pit.number_revisions(vintages(spark, sf), ["code", "line", "event"], ["known", "part", "value"]).withColumn("revision", F.col("revision").cast("long"))
    return pit.latest_revision(r, "2000-01-01", ["code", "line", "event"]).select("code", "line", "event", "value", "revision")


@query("e3_number_revisions", f"""WITH {VINTAGES} SELECT code, line, event, known, part, value, row_number() OVER (PARTITION BY code, line, event ORDER BY known, part, value) - 1 AS revision FROM vintages""")
def e3(spark, sf):
    r = pit.number_revisions(vintages(spark, sf), ["code", "line", "event"], ["known", "part", "value"])
    return r.withColumn("revision", F.col("revision").cast("long"))


@query("e4_dedup_latest", f"""WITH {VINTAGES} SELECT code, line, known, part, value FROM vintages QUALIFY row_number() OVER (PARTITION BY code, line ORDER BY known DESC, part DESC, value DESC) = 1""")
def e4(spark, sf):
    return pit.dedup_latest(vintages(spark, sf), ["code", "line"], [F.col("known").desc(), F.col("part").desc(), F.col("value").desc()]).select("code", "line", "known", "part", "value")


INTERVALS = f"""{MEMBER}, s AS (SELECT *, lag(action) OVER (PARTITION BY index_name, ticker ORDER BY day, event_id) AS prev FROM member),
k AS (SELECT * FROM s WHERE (action = 'added' AND coalesce(prev, 'removed') = 'removed') OR (action = 'removed' AND prev = 'added')),
iv AS (SELECT * FROM (SELECT index_name, ticker, action, day AS start, lead(day) OVER (PARTITION BY index_name, ticker ORDER BY day, event_id) AS "end" FROM k) WHERE action = 'added')"""


def _intervals(spark, sf):
    return pit.membership_intervals(membership(spark, sf), ["index_name", "ticker"], "action", "day", order=["event_id"])


@query("e22_membership_intervals", f'WITH {INTERVALS} SELECT index_name, ticker, start, "end" FROM iv')
def e22(spark, sf):
    return _intervals(spark, sf)


@query("c6_members_at", f"""WITH {INTERVALS} SELECT index_name, ticker FROM iv WHERE start <= TIMESTAMP '2024-01-15' AND ("end" IS NULL OR "end" > TIMESTAMP '2024-01-15') AND start + INTERVAL 2 DAY <= TIMESTAMP '2024-01-15'""")
def c6(spark, sf):
    """Additions are public two days later."""
    known = _intervals(spark, sf).withColumn("known", F.col("start") + F.expr("INTERVAL 2 DAYS"))
    return pit.members_at(known, "2024-01-15", "known").select("index_name", "ticker")


@query("c6_members_panel", f"""WITH {INTERVALS}, days AS (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-02-10', INTERVAL 1 DAY))::DATE AS as_of)
SELECT DISTINCT as_of, index_name, ticker FROM days JOIN iv ON start <= as_of AND ("end" IS NULL OR "end" > as_of) AND start + INTERVAL 2 DAY <= as_of""")
def c6_panel(spark, sf):
    """Members at every day of a calendar, of additions that are public two days later."""
    known = _intervals(spark, sf).withColumn("known", F.col("start") + F.expr("INTERVAL 2 DAYS"))
    return pit.members_panel(known, pit.calendar(spark, "2024-01-01", "2024-02-10", "1 DAY"), ["index_name", "ticker"], "known")


@query("d23_membership_counts", f"WITH {MEMBER} SELECT index_name, count(*) FILTER (WHERE action = 'added') AS added, count(*) FILTER (WHERE action = 'removed') AS removed, count(DISTINCT ticker) AS tickers FROM member GROUP BY 1")
def d23(spark, sf):
    return pit.membership_counts(membership(spark, sf))


@query("d22_latest_per_ticker", f"""WITH {BARS}, g AS (SELECT ticker, event, CASE WHEN volume > 20 THEN close END AS a, CASE WHEN volume <= 20 THEN open END AS b FROM bars)
SELECT ticker, round(arg_max(a, event) FILTER (WHERE a IS NOT NULL), 8) AS a, round(arg_max(b, event) FILTER (WHERE b IS NOT NULL), 8) AS b FROM g GROUP BY 1""")
def d22(spark, sf):
    g = bars(spark, sf).select("ticker", "event", F.when(F.col("volume") > 20, F.round("close", 8)).alias("a"), F.when(F.col("volume") <= 20, F.round("open", 8)).alias("b"))
    return pit.latest_values(g, "ticker", ["a", "b"], ["event"])


@query("c11_pending_backfill", f"""WITH {INTERVALS} SELECT DISTINCT ticker FROM member WHERE action = 'removed' AND ticker NOT IN (SELECT ticker FROM iv WHERE "end" IS NULL) AND ticker NOT IN (SELECT user_id FROM events GROUP BY 1 HAVING count(*) % 3 = 1)""")
def c11(spark, sf):
    current = _intervals(spark, sf).where(F.col("end").isNull())
    done = table(spark, sf, "events").groupBy(F.col("user_id").alias("ticker")).agg(F.count(F.lit(1)).alias("n")).where("n % 3 = 1")
    return pit.pending_backfill(membership(spark, sf).where("action = 'removed'"), current, done)


@query("g2_g3_newest_first", "SELECT day, n FROM (SELECT o_orderdate::DATE AS day, count(*) AS n FROM orders WHERE o_orderdate <= TIMESTAMP '1997-06-30' GROUP BY 1 ORDER BY day DESC LIMIT 8)")
def g2(spark, sf):
    """The last eight days with a meeting, newest first."""
    o = table(spark, sf, "orders").where("o_orderdate <= timestamp_ntz'1997-06-30'")
    return o.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("day").desc()).limit(8)


@query("g6_set_operations", "SELECT 'both' AS kind, count(*) AS n FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') UNION ALL SELECT 'either', count(*) FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' UNION SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') UNION ALL SELECT 'first', count(*) FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def g6(spark, sf):
    o = table(spark, sf, "orders")
    a, b = (o.where(F.col("o_orderstatus") == s).select("o_custkey") for s in "FP")
    made = {"both": a.intersect(b), "either": a.union(b).distinct(), "first": a.subtract(b)}
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("kind"), "n") for k, df in made.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


MACRO = """rel AS (SELECT o_orderstatus AS code, last_day(o_orderdate::DATE) AS event, last_day(o_orderdate::DATE) + 20 * (o_orderkey % 2)::INT + 10 AS known, count(*)::DOUBLE AS value FROM orders GROUP BY 1, 2, 3)"""


def releases(spark, sf):
    """Monthly observations of a code an order status, released twice."""
    o = table(spark, sf, "orders")
    event = F.last_day("o_orderdate")
    return o.groupBy(F.col("o_orderstatus").alias("code"), event.alias("event"), F.date_add(event, (F.col("o_orderkey") % 2 * 20 + 10).cast("int")).alias("known")).agg(F.count(F.lit(1)).cast("double").alias("value"))


@query("f7_macro", f"""WITH {MACRO}, n AS (SELECT *, row_number() OVER (PARTITION BY code, event ORDER BY known, value) - 1 AS revision FROM rel), l AS (SELECT * FROM n WHERE code <> 'P' QUALIFY row_number() OVER (PARTITION BY code, event ORDER BY revision DESC) = 1),
y AS (SELECT code, event, known, round((value - lag(value, 12) OVER w) / lag(value, 12) OVER w * 100, 4) AS value FROM l WINDOW w AS (PARTITION BY code ORDER BY event))
SELECT code, event, known, value, revision FROM n UNION ALL SELECT 'YOY_' || code, event, known, value, 0 FROM y WHERE value IS NOT NULL""")
def f7(spark, sf):
    m = macro_table(releases(spark, sf), {"F": "YOY_F", "O": "YOY_O"})
    return m.withColumn("revision", F.col("revision").cast("long"))


@query("f13_snapshot", f"""WITH {BARS}, {FIN}, {MACRO}, p AS (SELECT ticker, arg_max(close, event) AS price, count(*) AS bars, sum(volume) AS volume FROM bars WHERE event BETWEEN DATE '1998-04-01' AND DATE '1998-06-30' AND known <= TIMESTAMP '1998-06-30' GROUP BY 1),
s AS (SELECT ticker, event, known, CASE WHEN count(*) OVER w = 20 THEN avg(close) OVER w END AS sma FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY event ROWS 19 PRECEDING)),
i AS (SELECT ticker, arg_max(sma, event) AS sma_20 FROM s WHERE event BETWEEN DATE '1998-04-01' AND DATE '1998-06-30' AND known <= TIMESTAMP '1998-06-30' GROUP BY 1),
l AS (SELECT * FROM fin WHERE known <= DATE '1998-06-30' QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY known DESC, period_end DESC) = 1),
e AS (SELECT l_suppkey AS ticker, count(*) FILTER (WHERE l_returnflag = 'R' AND l_shipdate::DATE + 2 BETWEEN DATE '1998-04-01' AND DATE '1998-06-30') AS insider, count(*) FILTER (WHERE l_returnflag = 'A' AND l_shipdate::DATE + 30 BETWEEN DATE '1998-04-01' AND DATE '1998-06-30') AS congress FROM lineitem GROUP BY 1),
n AS (SELECT *, row_number() OVER (PARTITION BY code, event ORDER BY known, value) - 1 AS revision FROM rel), m AS (SELECT * FROM n WHERE known <= DATE '1998-06-30' QUALIFY row_number() OVER (PARTITION BY code, event ORDER BY revision DESC) = 1)
SELECT s_suppkey AS ticker, round(p.price, 8) AS price, p.bars::DOUBLE AS bars, p.volume, round(i.sma_20, 4) AS sma_20, round(l.revenue, 4) AS revenue, nullif(e.insider, 0)::DOUBLE AS insider, nullif(e.congress, 0)::DOUBLE AS congress, (SELECT arg_max(value, event) FROM m WHERE code = 'O') AS macro_o
FROM supplier LEFT JOIN p ON p.ticker = s_suppkey LEFT JOIN i ON i.ticker = s_suppkey LEFT JOIN l ON l.ticker = s_suppkey LEFT JOIN e ON e.ticker = s_suppkey""")
def f13(spark, sf):
    """Everything that was public on one day, flat: one row a member with its parts as maps."""
    b, lines = bars(spark, sf), table(spark, sf, "lineitem")

    def told(flag, days):
        day = F.col("l_shipdate").cast("date")
        return lines.where(F.col("l_returnflag") == flag).select(F.col("l_suppkey").alias("ticker"), day.alias("event"), F.date_add(day, days).alias("known"))

    averages = b.select("ticker", "event", "known", sma(F.col("close"), "ticker", "event", 20).alias("sma_20"))
    numbered = pit.number_revisions(releases(spark, sf), ["code", "event"], ["known", "value"])
    meetings = table(spark, sf, "orders").where("o_totalprice > 400000").select(F.col("o_orderdate").cast("date").alias("event"), F.col("o_orderdate").cast("date").alias("known")).distinct()
    members = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("ticker"))
    parts = snapshot("1998-06-30", 90, members, b, averages, financials(spark, sf), numbered, {"insider": told("R", 2), "congress": told("A", 30)}, meetings)
    flat = flat_features(parts, "1998-06-30", ["revenue"], ["sma_20"])

    def of(column, name):
        return F.try_element_at(column, F.lit(name))

    return flat.select("ticker", F.round(of("prices", "price"), 8).alias("price"), of("prices", "bars").alias("bars"), of("prices", "volume").alias("volume"), F.round(of("indicators", "sma_20"), 4).alias("sma_20"),
                       F.round(of("filing", "revenue"), 4).alias("revenue"), of("events", "insider").alias("insider"), of("events", "congress").alias("congress"), of("macro", "O").alias("macro_o"))


CALENDAR_SQL = f"""WITH {BARS}, {FIN}, {MACRO}, days AS (SELECT unnest(generate_series(DATE '1993-01-15', DATE '1999-01-15', INTERVAL 2 MONTH))::DATE AS as_of),
own AS (SELECT s_suppkey AS ticker, DATE '1992-01-01' + (s_suppkey * 37 % 1500)::INT AS start, CASE WHEN s_suppkey % 3 = 0 THEN DATE '1992-01-01' + (s_suppkey * 37 % 1500)::INT + 900 END AS "end" FROM supplier),
p AS (SELECT as_of, ticker, arg_max(close, event) AS price, count(*) AS bars, sum(volume) AS volume FROM days JOIN bars ON event BETWEEN as_of - 90 AND as_of AND known <= as_of::TIMESTAMP GROUP BY ALL),
s AS (SELECT ticker, event, known, CASE WHEN count(*) OVER w = 20 THEN avg(close) OVER w END AS sma FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY event ROWS 19 PRECEDING)),
i AS (SELECT as_of, ticker, arg_max(sma, event) AS sma_20 FROM days JOIN s ON event BETWEEN as_of - 90 AND as_of AND known <= as_of::TIMESTAMP GROUP BY ALL),
l AS (SELECT as_of, fin.* FROM days JOIN fin ON known <= as_of QUALIFY row_number() OVER (PARTITION BY as_of, ticker ORDER BY known DESC, period_end DESC) = 1),
e AS (SELECT as_of, l_suppkey AS ticker, count(*) FILTER (WHERE l_returnflag = 'R' AND l_shipdate::DATE + 2 BETWEEN as_of - 90 AND as_of) AS insider, count(*) FILTER (WHERE l_returnflag = 'A' AND l_shipdate::DATE + 30 BETWEEN as_of - 90 AND as_of) AS congress
  FROM days JOIN lineitem ON l_shipdate::DATE BETWEEN as_of - 130 AND as_of GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY code, event ORDER BY known, value) - 1 AS revision FROM rel),
m AS (SELECT as_of, arg_max(value, (event, revision)) AS macro_o FROM days JOIN n ON known <= as_of AND event <= as_of WHERE code = 'O' GROUP BY 1)
SELECT as_of, own.ticker, round(p.price, 8) AS price, p.bars::DOUBLE AS bars, p.volume, round(i.sma_20, 4) AS sma_20, round(l.revenue, 4) AS revenue, nullif(e.insider, 0)::DOUBLE AS insider, nullif(e.congress, 0)::DOUBLE AS congress, m.macro_o
FROM days JOIN own ON start <= as_of AND ("end" IS NULL OR "end" > as_of) LEFT JOIN p USING (as_of, ticker) LEFT JOIN i USING (as_of, ticker) LEFT JOIN l USING (as_of, ticker) LEFT JOIN e USING (as_of, ticker) LEFT JOIN m USING (as_of)"""


def _calendar(spark, sf):
    # Prices and averages are read from one table of the bars.
    b = bars(spark, sf, ("ticker",)).select("ticker", "event", "known", "close", "volume", sma(F.col("close"), "ticker", "event", 20).alias("sma_20"))
    b, lines = stored(b), table(spark, sf, "lineitem")

    def told(flag, days):
        return lines.where(F.col("l_returnflag") == flag).select(F.col("l_suppkey").alias("ticker"), F.date_add(F.col("l_shipdate").cast("date"), days).alias("known"))

    begins = F.date_add(F.lit("1992-01-01").cast("date"), (F.col("s_suppkey") * 37 % 1500).cast("int"))
    members = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("ticker"), begins.alias("start"), F.when(F.col("s_suppkey") % 3 == 0, F.date_add(begins, 900)).alias("end"))
    numbered = pit.number_revisions(releases(spark, sf), ["code", "event"], ["known", "value"])
    dates = pit.calendar(spark, "1993-01-15", "1999-01-15", "2 MONTH")
    return flat_calendar(dates, members, 90, b.drop("sma_20"), b.select("ticker", "event", "known", "sma_20"), financials(spark, sf), numbered, {"insider": told("R", 2), "congress": told("A", 30)}, ["revenue"], ["sma_20"])


def _named(flat):
    def of(column, name):
        return F.try_element_at(column, F.lit(name))

    return flat.select("as_of", "ticker", F.round(of("prices", "price"), 8).alias("price"), of("prices", "bars").alias("bars"), of("prices", "volume").alias("volume"), F.round(of("indicators", "sma_20"), 4).alias("sma_20"),
                       F.round(of("filing", "revenue"), 4).alias("revenue"), of("events", "insider").alias("insider"), of("events", "congress").alias("congress"), of("macro", "O").alias("macro_o"))


@query("f13_calendar", CALENDAR_SQL)
def f13_calendar(spark, sf):
    """Every part of a snapshot for a whole calendar in one plan."""
    return _named(_calendar(spark, sf))


@query("jd_nested_export", CALENDAR_SQL)
def jd(spark, sf):
    """The export by date and block of tickers, taken apart again."""
    nested = nested_calendar(_calendar(spark, sf), 40, table(spark, sf, "supplier").count())
    return _named(nested.select("as_of", F.explode("tickers").alias("ticker", "f")).select("as_of", "ticker", "f.*"))


@query("f13_meetings", "SELECT DISTINCT o_orderdate::DATE AS event FROM orders WHERE o_totalprice > 300000 AND o_orderdate <= TIMESTAMP '1998-06-30' ORDER BY event DESC LIMIT 8")
def f13_meetings(spark, sf):
    day = F.col("o_orderdate").cast("date")
    meetings = table(spark, sf, "orders").where("o_totalprice > 300000").select(day.alias("event"), day.alias("known")).distinct()
    return snapshot("1998-06-30", 90, meetings=meetings)["meetings"].select("event")


@query("c9_panel_latest", f"""WITH {FACTS}, days AS (SELECT unnest(generate_series(DATE '2024-01-05', DATE '2024-01-30', INTERVAL 5 DAY))::DATE AS as_of),
p AS (SELECT as_of, user_id, value, event, event_id FROM days JOIN facts ON event <= as_of AND event >= as_of - INTERVAL 12 DAY AND known <= as_of)
SELECT as_of, user_id, event_id, value FROM p QUALIFY row_number() OVER (PARTITION BY as_of, user_id ORDER BY event DESC, event_id DESC) = 1""")
def c9_latest(spark, sf):
    days = pit.calendar(spark, "2024-01-05", "2024-01-30", "5 DAY")
    return pit.panel_at(facts(spark, sf), days, ["user_id"], ["event", "event_id"], "known", "event", 12).select("as_of", "user_id", "event_id", "value")
