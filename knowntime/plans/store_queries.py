"""Tables, sources, rules and increments over the driver tables."""

from pyspark.sql import functions as F

from knowntime.operators import quality as Q
from knowntime.operators.portfolio import missing_prices
from knowntime.operators.reports import universe, with_unrevised
from knowntime.operators.windows import over, yoy_change
from knowntime.plans.proxies import BARS, FACTS, VINTAGES, bars, facts, shared, table, vintages
from knowntime.plans.registry import query
from knowntime.sources import parsers, store
from knowntime.streaming import increments


def _ohlcv(spark, sf):
    return bars(spark, sf).select(
        F.col("event").cast("timestamp_ntz").alias("event_timestamp"), "ticker", F.lit("1D").alias("frequency"), "open", "high", "low", "close", F.col("close").alias("adj_close"), "volume",
        F.col("known").alias("knowledge_timestamp"), F.lit(0).alias("ingestion_timestamp"))


@query("a3_read_prices", f"WITH {BARS} SELECT ticker, event AS date, round(close, 8) AS close FROM bars WHERE close > 0 AND ticker IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")
def a3(spark, sf):
    wanted = table(spark, sf, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("ticker"))
    return store.read_prices(_ohlcv(spark, sf), wanted).withColumn("close", F.round("close", 8))


@query("a4_read_ohlcv_pit", f"WITH {BARS} SELECT ticker, event::TIMESTAMP AS event_timestamp, volume FROM bars WHERE ticker IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) AND event BETWEEN DATE '1997-01-01' AND DATE '1998-06-30' AND known <= TIMESTAMP '1998-06-30'")
def a4(spark, sf):
    wanted = table(spark, sf, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("ticker"))
    return store.read_ohlcv_pit(_ohlcv(spark, sf), wanted, "1998-06-30", "1997-01-01").select("ticker", "event_timestamp", "volume")


@query("a8_series_vintages", f"WITH {VINTAGES} SELECT code, line, event, known, part, value, row_number() OVER (PARTITION BY code, line, event ORDER BY known, part, value) - 1 AS revision FROM vintages WHERE part % 7 <> 0")
def a8(spark, sf):
    """A seventh of the releases has no value."""
    raw = vintages(spark, sf).withColumn("value", F.when(F.col("part") % 7 != 0, F.col("value")))
    out = parsers.load_series_vintages(raw, ["code", "line", "event"], ["known", "part", "value"])
    return out.withColumn("revision", F.col("revision").cast("long"))


@query("a14_discover_links", """SELECT page_id, len(regexp_extract_all(html, 'href="([^"]+)"', 1))::INT AS n_links, CASE WHEN page_id % 3 = 0 THEN '/a/data.XML' WHEN page_id % 3 = 1 THEN '/xsl/other.xml' END AS picked FROM pages""")
def a14(spark, sf):
    """Pages with a cover document, style sheets and data files among their links."""
    more = F.when(F.col("page_id") % 3 == 0, '<a href="primary_doc.xml"></a><a href="/xslF/x.xml"></a><a href="/a/data.XML">').when(F.col("page_id") % 3 == 1, '<a href="/x/primary_doc.xml"><a href="/xsl/other.xml">').otherwise('<a href="primary_doc.xml">')
    links, picked = parsers.discover_links(F.col("marked"))
    pages = table(spark, sf, "pages").select("page_id", "html", F.concat("html", more).alias("marked"))
    return pages.select("page_id", (F.size(links) - F.when(F.col("page_id") % 3 == 0, 3).when(F.col("page_id") % 3 == 1, 2).otherwise(1)).alias("n_links"), picked.alias("picked"))


@query("a20_upsert", """
WITH v AS (SELECT *, l_orderkey % 3 AS wave FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, year(l_shipdate) AS year FROM v
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, year(l_shipdate) ORDER BY wave DESC, l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""")
def a20(spark, sf):
    """Three batches merged into a table partitioned by year."""
    spec = store.TableSpec("lines", ("l_orderkey", "l_linenumber", "year"), ("year",), "l_shipdate", ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"))
    root = shared(spark)
    rows = store.with_partition_cols(table(spark, sf, "lineitem"), "l_shipdate")
    for wave in range(3):
        store.upsert(rows.where(F.col("l_orderkey") % 3 == wave), root, spec)
    return store.read_table(spark, root, "lines").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", F.col("year").cast("long").alias("year"))


@query("a20_upsert_moved", """
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate::DATE AS day, 0 AS wave FROM lineitem),
m AS (SELECT * FROM l UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice * 2, day + 400, 1 FROM l WHERE l_orderkey % 3 = 1)
SELECT l_orderkey, l_linenumber, l_extendedprice, year(day)::BIGINT AS year FROM m QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY wave DESC, day DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""")
def a20_moved(spark, sf):
    """A second batch corrects a third of the rows and moves them to another year's partition."""
    spec = store.TableSpec("lines", ("l_orderkey", "l_linenumber"), ("year",), "day", ("day", "l_partkey", "l_suppkey", "l_extendedprice"))
    root = shared(spark)
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.col("l_shipdate").cast("date").alias("day"))
    store.upsert(rows, root, spec)
    store.upsert(rows.where("l_orderkey % 3 = 1").withColumns({"l_extendedprice": F.col("l_extendedprice") * 2, "day": F.date_add("day", 400)}), root, spec)
    return store.read_table(spark, root, "lines").select("l_orderkey", "l_linenumber", "l_extendedprice", F.col("year").cast("long").alias("year"))


ODD_CODES = ["A/B", "^VIX", "007", "7", "50%", "x y", "{k}=[1]*", "É", "", None]


def _odd(key):
    """A text for every row that no folder's name can hold as it is."""
    return F.get(F.array(*[F.lit(c).cast("string") for c in ODD_CODES]), (key % len(ODD_CODES)).cast("int"))


@query("a20_upsert_text", """
WITH c AS (SELECT ['A/B', '^VIX', '007', '7', '50%', 'x y', '{k}=[1]*', 'É', NULL, NULL] AS codes),
m AS (SELECT o_orderkey, codes[1 + o_orderkey % 10] AS code, o_orderdate::DATE AS day, o_totalprice, 0 AS wave FROM orders, c
      UNION ALL SELECT o_orderkey, codes[1 + (o_orderkey + 3) % 10], o_orderdate::DATE + 40, o_totalprice * 2, 1 FROM orders, c WHERE o_orderkey % 3 = 1)
SELECT o_orderkey, code, strftime(day, '%Y-01-01') AS since, o_totalprice FROM m QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY wave DESC) = 1""")
def a20_text(spark, sf):
    """Partitions of texts that folders write in another way, of nulls and of dates; a second batch moves a third of the rows, a third one comes twice."""
    spec = store.TableSpec("coded", ("o_orderkey",), ("code", "since"), "day", ("day",))
    root, key = shared(spark), F.col("o_orderkey")
    rows = table(spark, sf, "orders").select("o_orderkey", _odd(key).alias("code"), F.col("o_orderdate").cast("date").alias("day"), "o_totalprice")
    moved = rows.where("o_orderkey % 3 = 1").withColumns({"code": _odd(key + 3), "day": F.date_add("day", 40), "o_totalprice": F.col("o_totalprice") * 2})
    for batch in (rows, moved, moved):
        store.upsert(batch.withColumn("since", F.trunc("day", "year")), root, spec)
    return store.read_table(spark, root, "coded").select("o_orderkey", "code", "since", "o_totalprice")


@query("a1_drifted_types", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL WHEN o_orderkey % 3 = 0 THEN o_custkey * 1.0 ELSE o_custkey + 0.5 END::DOUBLE AS amount, CASE WHEN o_orderkey % 3 = 1 THEN o_orderstatus END AS status, (o_orderkey % 3)::VARCHAR AS batch FROM orders""")
def a1_drift(spark, sf):
    """Files in which a number is whole, or not, or missing, and one that is no table, read in the tolerant mode."""
    root, o = shared(spark), table(spark, sf, "orders")
    batches = [
        o.select(F.col("o_orderkey").cast("int").alias("o_orderkey"), F.col("o_custkey").cast("int").alias("amount")), o.select("o_orderkey", (F.col("o_custkey") + 0.5).cast("double").alias("amount"), F.col("o_orderstatus").alias("status")), o.select("o_orderkey")]
    for i, batch in enumerate(batches):
        batch.where(F.col("o_orderkey") % 3 == i).write.parquet(f"{root}/drift/batch={i}")
    o.limit(1).select(F.lit("x").alias("value")).coalesce(1).write.text(f"{root}/drift/batch=3")
    return store.read_table(spark, root, "drift", tolerant=True).select("o_orderkey", "amount", "status", "batch")


@query("jc_landing", """
WITH e AS (SELECT *, CASE WHEN event_id % 11 = 0 THEN 'ts: no timestamp' WHEN event_id % 13 = 0 THEN 'value: no double; user_id: missing' WHEN event_id % 17 = 0 THEN 'no JSON object' END AS reason FROM events)
SELECT coalesce(reason, 'landed') AS reason, count(*) AS n, CASE WHEN reason IS NULL THEN round(sum(value), 3) END AS total FROM e GROUP BY reason
UNION ALL SELECT 'rule all_landed: FAIL', count(reason), NULL FROM e UNION ALL SELECT 'rule dates: WARN', count(*) FILTER (WHERE reason LIKE 'ts:%'), NULL FROM e""")
def jc(spark, sf):
    """Events as lines of JSON, some of which do not fit the table's schema; landed twice, counted once."""
    spec = store.TableSpec("events", ("event_id", "user_id"), (), "ts", ("ts",), schema="event_id long, user_id long, ts timestamp, event_type string, value double")
    i = F.col("event_id")
    date, bad = i % 11 == 0, (i % 13 == 0) & (i % 11 != 0)
    line = F.to_json(F.struct("event_id", F.when(~bad, F.col("user_id")).alias("user_id"), F.when(date, "soon").otherwise(F.col("ts").cast("string")).alias("ts"), "event_type", F.when(bad, "n/a").otherwise(F.col("value").cast("string")).alias("value"), F.lit(1).alias("more")))
    cut = (i % 17 == 0) & ~date & ~bad
    lines = table(spark, sf, "events").select(F.when(cut, F.concat(i.cast("string"), F.lit(" {"))).otherwise(line).alias("value"))
    root = shared(spark)
    for _ in range(2):
        store.land(lines, root, spec)
    kept, gone = store.read_table(spark, root, "events"), store.read_table(spark, root, "events_quarantine")
    out = kept.agg(F.lit("landed").alias("reason"), F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 3).alias("total"))
    out = out.unionByName(gone.groupBy("reason").agg(F.sum("n").alias("n"), F.lit(None).cast("double").alias("total")))
    for found in (Q.quarantined("all_landed", gone), Q.quarantined("dates", gone, "ts:", True)):
        out = out.unionByName(found.select(F.concat(F.lit("rule "), "rule", F.lit(": "), "status").alias("reason"), F.col("bad").alias("n"), F.lit(None).cast("double").alias("total")))
    return out


@query("i7_hot_and_cold", """SELECT o_orderkey, o_totalprice * CASE WHEN o_orderkey % 50 = 0 AND o_orderdate < TIMESTAMP '1996-01-01' THEN 2 ELSE 1 END AS o_totalprice,
CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' AND o_orderkey % 50 <> 0 THEN 'cold' ELSE 'hot' END AS lies FROM orders""")
def i7(spark, sf):
    """Orders archived twice; some corrections of archived rows come late and stand before them."""
    spec = store.TableSpec("orders", ("o_orderkey",), ("year", "month"), "o_orderdate", ("o_orderdate",))
    root = shared(spark)
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    store.upsert(rows, f"{root}/hot", spec)
    for _ in range(2):
        store.archive(spark, f"{root}/hot", f"{root}/cold", spec, "1996-01-01")
    store.upsert(rows.where("o_orderkey % 50 = 0 and o_orderdate < '1996-01-01'").withColumn("o_totalprice", F.col("o_totalprice") * 2), f"{root}/hot", spec)
    hot = store.read_table(spark, f"{root}/hot", "orders").select("o_orderkey", F.lit("hot").alias("lies"))
    both = store.read_hot_and_cold(spark, f"{root}/hot", f"{root}/cold", spec)
    return both.join(hot, "o_orderkey", "left").select("o_orderkey", "o_totalprice", F.coalesce("lies", F.lit("cold")).alias("lies"))


@query("a21_upsert_columns", """
WITH a AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0), b AS (SELECT o_orderkey, 'X' AS o_orderstatus, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderkey % 2 = 0)
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN b.o_orderstatus ELSE a.o_orderstatus END AS o_orderstatus, CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_totalprice ELSE a.o_totalprice END AS o_totalprice FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey""")
def a21(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = o.where("o_orderkey % 2 = 0").select("o_orderkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") * 2).alias("o_totalprice"))
    return store.upsert_columns(o.where("o_orderkey % 3 <> 0"), new, ["o_orderkey"], ["o_totalprice"])


@query("a22_partition_cols", "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 9999 ELSE year(o_orderdate) END::INT AS year, CASE WHEN o_orderkey % 10 = 0 THEN '01' ELSE strftime(o_orderdate, '%m') END AS month FROM orders")
def a22(spark, sf):
    day = F.when(F.col("o_orderkey") % 10 == 0, "no date").otherwise(F.col("o_orderdate").cast("string"))
    return store.with_partition_cols(table(spark, sf, "orders").select("o_orderkey", day.alias("d")), "d", True).drop("d")


@query("a23_normalise_types", "SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN o_orderdate END AS stamp, CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate::DATE END AS day FROM orders")
def a23(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderdate").cast("string")).otherwise("?").alias("stamp"), F.when(F.col("o_orderkey") % 5 > 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("n/a").alias("day"))
    return store.normalise_types(o, ["stamp"], ["day"])


@query("a25_archive", "SELECT year(o_orderdate)::INT AS year, strftime(o_orderdate, '%m') AS month, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' AND NOT (year(o_orderdate) = 1996) GROUP BY 1, 2")
def a25(spark, sf):
    o = table(spark, sf, "orders")
    before = store.with_partition_cols(o.where("year(o_orderdate) = 1996"), "o_orderdate", True)
    return store.archive_older_than(o, before, "o_orderdate", "1998-01-01").groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"))


@query("a29_row_counts", "SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events")
def a29(spark, sf):
    return store.row_counts({t: table(spark, sf, t) for t in ("orders", "lineitem", "events")})


@query("c12_missing_prices", "SELECT DISTINCT p_partkey AS part FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def c12(spark, sf):
    priced = table(spark, sf, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("part"))
    return missing_prices(table(spark, sf, "part").select(F.col("p_partkey").alias("part")), priced, "part")


@query("f16_universe", """SELECT ticker, idx AS index_name FROM (SELECT c_custkey AS ticker, 'A' AS idx, 0 AS p FROM customer WHERE c_acctbal > 0 UNION ALL SELECT o_custkey, 'B', 1 FROM orders WHERE o_totalprice > 100000)
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY p) = 1""")
def f16(spark, sf):
    a = table(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("ticker"))
    b = table(spark, sf, "orders").where("o_totalprice > 100000").select(F.col("o_custkey").alias("ticker"))
    return universe({"A": a, "B": b}, b.select("ticker", F.lit("old").alias("index_name")), ["1"])


@query("f16_stored_universe", "SELECT DISTINCT o_custkey AS ticker, 'old' AS index_name FROM orders WHERE (SELECT count(*) FROM customer WHERE c_acctbal > 1e9) = 0")
def f16_stored(spark, sf):
    """No index has a member: the stored copy counts."""
    none = table(spark, sf, "customer").where("c_acctbal > 1e9").select(F.col("c_custkey").alias("ticker"))
    kept = table(spark, sf, "orders").select(F.col("o_custkey").alias("ticker"), F.lit("old").alias("index_name"))
    return universe({"A": none, "B": none}, kept, ["1"])


@query("a8_without_vintages", f"""WITH {VINTAGES}, r AS (SELECT code, event, known, value, row_number() OVER (PARTITION BY code, event ORDER BY known, part, value) - 1 AS revision FROM vintages WHERE code % 3 <> 0)
SELECT code, event, known, value, revision::INT AS revision FROM r UNION ALL SELECT o_orderkey, o_orderdate::DATE, o_orderdate::DATE, o_totalprice, 0 FROM orders WHERE o_orderkey NOT IN (SELECT code FROM r)""")
def a8_latest(spark, sf):
    """Series without releases have their latest value, as revision 0."""
    told = parsers.load_series_vintages(vintages(spark, sf).where("code % 3 <> 0"), ["code", "event"], ["known", "part", "value"])
    day = F.col("o_orderdate").cast("date")
    return with_unrevised(told, table(spark, sf, "orders").select(F.col("o_orderkey").alias("code"), day.alias("event"), F.col("o_totalprice").alias("value")))


@query("k_rules", f"""WITH {BARS}, r AS (
  SELECT 'high_not_below_low' AS rule, count(*) FILTER (WHERE high < low) AS bad, 'FAIL' AS level FROM bars UNION ALL SELECT 'close_positive', count(*) FILTER (WHERE close <= 0), 'FAIL' FROM bars
  UNION ALL SELECT 'volume_in_range', count(*) FILTER (WHERE volume NOT BETWEEN 1 AND 50), 'WARN' FROM bars UNION ALL SELECT 'known_after_event', count(*) FILTER (WHERE known < event), 'FAIL' FROM bars
  UNION ALL SELECT 'enough_rows', (count(*) < 1000)::BIGINT, 'FAIL' FROM bars UNION ALL SELECT 'mostly_small', (avg((volume <= 50)::INT) < 0.9)::BIGINT, 'FAIL' FROM bars
  UNION ALL SELECT 'unique_bars', 0, 'FAIL' UNION ALL SELECT 'unique_lines', (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)), 'FAIL'
  UNION ALL SELECT 'all_suppliers_priced', (SELECT count(*) FROM supplier WHERE s_suppkey NOT IN (SELECT ticker FROM bars)), 'FAIL' UNION ALL SELECT 'known_status', (SELECT count(DISTINCT o_orderstatus) FROM orders WHERE o_orderstatus NOT IN ('O', 'F')), 'FAIL')
SELECT rule, CASE WHEN bad = 0 THEN 'PASS' ELSE level END AS status, bad FROM r""")
def k_rules(spark, sf):
    b = bars(spark, sf)
    found = Q.check(b, [
        Q.rule("high_not_below_low", F.col("high") < F.col("low")), Q.rule("close_positive", F.col("close") <= 0), Q.rule("volume_in_range", ~F.col("volume").between(1, 50), warn=True),
        Q.rule("known_after_event", F.col("known") < F.col("event").cast("timestamp_ntz")), Q.at_least("enough_rows", F.count(F.lit(1)), 1000), Q.share("mostly_small", F.col("volume") <= 50, 0.9)])
    wanted = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("ticker"))
    more = [Q.unique_key("unique_bars", b, ["ticker", "event"]), Q.unique_key("unique_lines", table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]), Q.missing_keys("all_suppliers_priced", wanted, b, "ticker"), Q.allowed_values("known_status", table(spark, sf, "orders"), "o_orderstatus", ["O", "F"])]
    for m in more:
        found = found.unionByName(m)
    return found


@query("k12_k16_rules", f"""WITH {BARS}, s AS (SELECT ticker, max(close) AS top FROM bars GROUP BY 1), r AS (
  SELECT 'columns' AS rule, 1::BIGINT AS bad UNION ALL SELECT 'enough_tickers', (count(DISTINCT ticker) < 50)::BIGINT FROM bars UNION ALL SELECT 'too_few_tickers', (count(DISTINCT ticker) < 1000000)::BIGINT FROM bars
  UNION ALL SELECT 'reaches_1993', (min(event) > DATE '1993-01-01')::BIGINT FROM bars UNION ALL SELECT 'dates', count(*) FILTER (WHERE o_orderkey % 10 = 0) FROM orders
  UNION ALL SELECT 'spot', count(*) FILTER (WHERE ticker % 4 = 0) FROM s UNION ALL SELECT 'rerun', 0)
SELECT rule, CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status, bad FROM r""")
def k12(spark, sf):
    b, o = bars(spark, sf), table(spark, sf, "orders")
    top = b.groupBy("ticker").agg(F.max("close").alias("top"))
    expected = top.select("ticker", F.when(F.col("ticker") % 4 == 0, F.col("top") * 1.2).otherwise(F.col("top") * 1.001).alias("top"))
    found = [
        Q.required_columns("columns", b, ["ticker", "event", "adj_close"]), Q.distinct_keys("enough_tickers", b, "ticker", 50), Q.distinct_keys("too_few_tickers", b, "ticker", 1_000_000), Q.depth("reaches_1993", b, "event", "1993-01-01"),
        Q.parseable_dates("dates", o.select(F.when(F.col("o_orderkey") % 10 == 0, "soon").otherwise(F.col("o_orderdate").cast("string")).alias("d")), "d"),
        Q.spot_values("spot", top, expected, ["ticker"], "top", 0.01)]
    # A second run over the same input leaves the table as it was.
    root, spec = shared(spark), store.TableSpec("orders", ("o_orderkey",), (), "o_orderdate", ("o_orderdate",))
    rows = o.select("o_orderkey", "o_orderdate", "o_totalprice")
    store.upsert(rows, root, spec)
    before = store.read_table(spark, root, "orders")
    before.write.parquet(f"{root}/before")
    store.upsert(rows, root, spec)
    found.append(Q.same_rows("rerun", spark.read.parquet(f"{root}/before"), store.read_table(spark, root, "orders")))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


@query("k13_file_integrity", "SELECT 'files' AS rule, 'WARN' AS status, 1::BIGINT AS bad FROM (SELECT count(*) FROM region)")
def k13(spark, sf):
    """One of the files is no table."""
    root = shared(spark)
    r = table(spark, sf, "customer").select("c_custkey")
    r.write.parquet(f"{root}/files")
    r.limit(1).select(F.lit("x").alias("value")).coalesce(1).write.mode("append").text(f"{root}/files")
    return Q.unreadable_files("files", store.files_of(spark, f"{root}/files"), store.read_tolerant(spark, f"{root}/files", r.schema))


@query("k3_coverage", f"""WITH {BARS}, o AS (SELECT ticker, count(*) AS n, min(event) AS f, max(event) AS l FROM bars GROUP BY 1)
SELECT ticker, n AS bars, round(date_diff('day', f, least(DATE '2001-12-31', l)) * 252 / 365.0, 4) AS possible, date_diff('day', f, least(DATE '2001-12-31', l)) * 252 / 365.0 >= 30 AND n < 0.9 * date_diff('day', f, least(DATE '2001-12-31', l)) * 252 / 365.0 AS thin FROM o""")
def k3(spark, sf):
    return Q.coverage(bars(spark, sf), "ticker", "event", "2001-12-31").select("ticker", "bars", F.round("possible", 4).alias("possible"), "thin")


@query("k4_stale", f"WITH {BARS} SELECT ticker, max(event) AS last FROM bars GROUP BY 1 HAVING date_diff('day', max(event), DATE '2001-12-31') > 10")
def k4(spark, sf):
    return Q.stale(bars(spark, sf), "ticker", "event", "2001-12-31")


@query("i1_high_water", "SELECT 'bars' AS job, c_custkey AS user_id, coalesce(h, TIMESTAMP '2009-12-31') AS high_water FROM customer LEFT JOIN (SELECT user_id, max(ts) AS h FROM events GROUP BY 1) ON user_id = c_custkey")
def i1(spark, sf):
    keys = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return increments.high_water(table(spark, sf, "events"), "user_id", "ts", keys, "bars")


@query("i1_marks", """SELECT o_custkey AS key, count(*) AS n, max(o_orderdate) AS high_water FROM orders GROUP BY 1""")
def i1_marks(spark, sf):
    """Orders in three increments, the second of which ends between its write and its marks; nothing is lost or counted twice."""
    root, spec = shared(spark), store.TableSpec("orders", ("o_orderkey",), ("year",), "o_orderdate", ("o_orderdate",))
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")

    def write(batch, ends=False):
        store.upsert(batch, root, spec)
        if ends:
            raise InterruptedError

    for until, ends in (("1994-06-01", False), ("1996-06-01", True), ("1996-06-01", False), ("9999-01-01", False), ("9999-01-01", False)):
        try:
            increments.increment(rows.where(F.col("o_orderdate") < until), root, "orders", "o_custkey", "o_orderdate", lambda batch, ends=ends: write(batch, ends), "1970-01-01")
        except InterruptedError:
            pass
    n = store.read_table(spark, root, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return n.join(increments.marks(spark, root, "orders").withColumn("key", F.col("key").cast("long")), "key")


@query("i3_i4_corrected_bars", """WITH e AS (SELECT event_id, user_id, ts, value FROM events), m AS (SELECT *, 0 AS wave FROM e WHERE event_id % 4 <> 1 UNION ALL SELECT *, 1 FROM e WHERE event_id % 4 = 1 UNION ALL SELECT event_id, user_id, ts - INTERVAL 9 DAY, value * 10, 2 FROM e WHERE event_id % 5 = 0),
l AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY wave DESC) = 1), w AS (SELECT *, date_trunc('week', ts)::DATE AS period FROM l)
SELECT user_id, period, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close, round(sum(value), 4) AS volume FROM w GROUP BY 1, 2""")
def i3_i4(spark, sf):
    """Weekly bars that follow rows which come late by any time and corrections that move to another week; three batches."""
    root, e = shared(spark), table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    raw, derived = store.TableSpec("raw", ("event_id",), ("year",), "ts", ("ts",)), store.TableSpec("bars", ("user_id", "period"), ("year",), "period", ("volume",))
    at = F.struct("ts", "event_id")

    def bars_of(rows):
        return rows.groupBy("user_id", "period").agg(F.min_by("value", at).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", at).alias("close"), F.sum("value").alias("volume"))

    def write(batch, n):
        increments.refresh_buckets(batch, root, raw, derived, ["user_id"], F.to_date(F.date_trunc("week", "ts")), bars_of)

    for batch in (e.where("event_id % 4 <> 1"), e.where("event_id % 4 = 1"), e.where("event_id % 5 = 0").withColumns({"ts": F.col("ts") - F.expr("INTERVAL 9 DAYS"), "value": F.col("value") * 10})):
        batch.write.mode("append").parquet(f"{root}/in")
        increments.run_available(increments.stream(spark, f"{root}/in", "ts"), write, f"{root}/marks")
    return store.read_table(spark, root, "bars").drop("year").withColumn("volume", F.round("volume", 4))


@query("i9_stream_heartbeat", f"""WITH {FACTS} SELECT event_id % 3 AS batch, count(*) AS rows, max(date_diff('day', event::DATE, known::DATE))::INT AS largest_lag FROM facts GROUP BY 1""")
def i9_stream(spark, sf):
    """Rows and largest lag of every batch of a stream, observed while it is written."""
    root, f = shared(spark), facts(spark, sf).select("event_id", "event", "known")
    write = increments.with_heartbeat(lambda batch, n: batch.write.mode("append").parquet(f"{root}/out"), root, "facts", F.datediff(F.col("known"), F.col("event")))
    for part in range(3):
        f.where(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{root}/in")
        increments.run_available(increments.stream(spark, f"{root}/in", "event"), write, f"{root}/marks")
    return store.read_table(spark, root, "heartbeats").select("batch", "rows", "largest_lag")


@query("i3_stream_upsert", """WITH a AS (SELECT user_id, event_type, value, ts, event_id FROM events UNION ALL SELECT user_id, event_type, value * 10, ts + INTERVAL 40 DAY, event_id FROM events WHERE event_id % 5 = 0)
SELECT user_id, event_type, value, strftime(ts, '%m') AS month FROM a QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def i3(spark, sf):
    """Events as a stream, merged batch by batch into one row a key; later files correct earlier rows, in other partitions too."""
    root = shared(spark)
    spec = store.TableSpec("latest", ("user_id", "event_type"), ("year", "month"), "ts", ("ts", "event_id"))
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    later = e.where("event_id % 5 = 0").withColumns({"value": F.col("value") * 10, "ts": F.col("ts") + F.expr("INTERVAL 40 DAYS")})
    for batch in (e, later):
        batch.write.mode("append").parquet(f"{root}/in")
        increments.run_available(increments.stream(spark, f"{root}/in", "ts"), lambda rows, n: store.upsert(rows, root, spec), f"{root}/marks")
    return store.read_table(spark, root, "latest").select("user_id", "event_type", "value", "month")


@query("i5_warm_up", f"""WITH {BARS} SELECT ticker, event, round(mean, 6) AS mean FROM (SELECT ticker, event, avg(close) OVER (PARTITION BY ticker ORDER BY event ROWS 4 PRECEDING) AS mean FROM bars) WHERE event >= DATE '1998-01-01'""")
def i5(spark, sf):
    """Windows over a batch and the history before it; only the batch's rows come back."""
    b = bars(spark, sf).select("ticker", "event", "close")
    batch, history = b.where("event >= date'1998-01-01'"), b.where("event < date'1998-01-01'")
    mean = F.avg("close").over(over("ticker", "event").rowsBetween(-4, 0))
    return increments.with_history(batch, history, ["ticker"], "event", 1500, lambda df: df.withColumn("mean", F.round(mean, 6))).select("ticker", "event", "mean")


@query("i6_recompute", """WITH m AS (SELECT o_orderstatus AS code, date_trunc('month', o_orderdate)::DATE AS month, count(*) AS v FROM orders GROUP BY 1, 2)
SELECT code, month, round((v - lag(v, 12) OVER w) / lag(v, 12) OVER w * 100, 4) AS yoy FROM m WINDOW w AS (PARTITION BY code ORDER BY month)""")
def i6(spark, sf):
    """A derived series computed anew as a whole; its partition is replaced, the others stay."""
    root = shared(spark)
    m = table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("code"), F.trunc("o_orderdate", "month").alias("month")).agg(F.count(F.lit(1)).alias("v"))
    yoy = m.select("month", F.round(yoy_change(F.col("v"), "code", "month"), 4).alias("yoy"), "code")
    store.replace_partition(yoy.withColumn("yoy", F.when(F.col("code") != "F", F.col("yoy"))), root, "yoy", ["code"])
    store.replace_partition(yoy.where("code = 'F'"), root, "yoy", ["code"])
    return store.read_table(spark, root, "yoy").select("code", "month", "yoy")


@query("i4_stream_weekly_bars", """WITH w AS (SELECT user_id, date_trunc('week', ts)::DATE AS period, ts, value, event_id FROM events)
SELECT user_id, period, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close, round(sum(value), 4) AS volume FROM w
WHERE period + 7 <= (SELECT max(ts) - INTERVAL 1 DAY FROM events) GROUP BY 1, 2""")
def i4(spark, sf):
    """Weeks that the watermark has passed, as a stream emits them."""
    root = shared(spark)
    source = increments.stream(spark, sf, "ts", "events.parquet")
    increments.run_available(increments.weekly_bars(source, "user_id", "ts", "value", "value", ["event_id"]), lambda batch, n: batch.write.mode("append").parquet(f"{root}/bars"), f"{root}/marks")
    return store.read_table(spark, root, "bars").withColumn("volume", F.round("volume", 4))
