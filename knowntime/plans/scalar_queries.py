"""Scalar rules over the driver tables."""

from pyspark.sql import functions as F

from knowntime.functions import scalars as S
from knowntime.plans.proxies import FIN, LAGS, financials, table
from knowntime.plans.registry import query


@query("b4_item_flags", """
WITH i AS (SELECT l_orderkey, string_agg(DISTINCT l_returnflag || '/' || l_linestatus, ', ' ORDER BY l_returnflag || '/' || l_linestatus) AS items FROM lineitem GROUP BY 1)
SELECT l_orderkey, items, (list_contains(list_transform(string_split(items, ','), lambda x: trim(x)), 'A/F'))::INT AS has_af,
       (list_contains(list_transform(string_split(items, ','), lambda x: trim(x)), 'N/O'))::INT AS has_no, (list_contains(list_transform(string_split(items, ','), lambda x: trim(x)), 'R/F'))::INT AS has_rf FROM i""")
def b4(spark, sf):
    code = F.concat_ws("/", "l_returnflag", "l_linestatus")
    items = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set(code)), ", ").alias("items"))
    return items.select("*", *S.item_flags(F.col("items"), {"has_af": "A/F", "has_no": "N/O", "has_rf": "R/F"}))


@query("b5_b6_period_rules", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '10-Q' WHEN o_orderstatus = 'F' THEN '10-K' END AS base_form,
       CASE WHEN o_orderstatus = 'P' THEN coalesce(o_orderkey % 200 BETWEEN 60 AND 105, false) WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderkey % 3 = 0 THEN true ELSE o_orderkey % 500 BETWEEN 330 AND 400 END ELSE false END AS proper
FROM orders""")
def b5(spark, sf):
    o = table(spark, sf, "orders")
    form = F.when(F.col("o_orderstatus") == "P", "10-Q/A").when(F.col("o_orderstatus") == "F", "10-K").otherwise("8-K")
    end = F.col("o_orderdate").cast("date")
    days = F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey") % 200).otherwise(F.col("o_orderkey") % 500).cast("int")
    start = F.when((F.col("o_orderstatus") == "P") | (F.col("o_orderkey") % 3 != 0), F.date_sub(end, days))
    base = S.base_form(form)
    return o.select("o_orderkey", base.alias("base_form"), F.coalesce(S.is_period_length(start, end, base), F.lit(False)).alias("proper"))


@query("b7_safe_div", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round(CASE WHEN l_tax = 0 THEN NULL WHEN l_discount / l_tax BETWEEN 0.5 AND 3 THEN l_discount / l_tax END, 6) AS ratio FROM lineitem""")
def b7(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(S.safe_div(F.col("l_discount"), F.col("l_tax"), 0.5, 3), 6).alias("ratio"))


@query("b8_parse_amount", """
SELECT o_orderkey, round(CASE o_orderkey % 4 WHEN 0 THEN o_totalprice WHEN 1 THEN round(o_totalprice) * 1000 WHEN 2 THEN round(o_totalprice) * 1000000 END, 2) AS amount FROM orders""")
def b8(spark, sf):
    v, k = F.col("o_totalprice"), F.col("o_orderkey") % 4
    whole = F.format_number(F.round(v), 0)
    text = F.when(k == 0, F.concat(F.lit("$"), F.format_number(v, 2))).when(k == 1, F.concat(F.lit("+"), whole, F.lit("K"))).when(k == 2, F.concat(F.lit("$ "), whole, F.lit("m"))).otherwise("n/a")
    return table(spark, sf, "orders").select("o_orderkey", F.round(S.parse_amount(text), 2).alias("amount"))


@query("b9_market_close", """
SELECT DISTINCT o_orderdate::DATE AS day, ((o_orderdate::DATE + INTERVAL 16 HOUR) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS close_utc FROM orders""")
def b9(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select(day.alias("day")).distinct().select("day", S.market_close_utc(F.col("day")).alias("close_utc"))


@query("b10_publication_lag", """
SELECT event_id, least(ts::DATE + CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 35 WHEN 'error' THEN 45 WHEN 'purchase' THEN 90 ELSE 35 END, DATE '2024-01-31') AS known FROM events""")
def b10(spark, sf):
    return S.add_publication_lag(table(spark, sf, "events"), "event_type", "ts", LAGS, 35, "2024-01-31").select("event_id", "known")


@query("b12_cap_bucket", """
SELECT l_suppkey, CASE WHEN cap > 200e9 THEN 'mega' WHEN cap > 10e9 THEN 'large' WHEN cap > 2e9 THEN 'mid' ELSE 'small' END AS bucket
FROM (SELECT l_suppkey, sum(l_extendedprice::DECIMAL(18, 2)) * 500 AS cap FROM lineitem GROUP BY 1)""")
def b12(spark, sf):
    cap = table(spark, sf, "lineitem").groupBy("l_suppkey").agg((F.sum(F.col("l_extendedprice").cast("decimal(18,2)")) * 500).alias("cap"))
    return cap.select("l_suppkey", S.cap_bucket(F.col("cap")).alias("bucket"))


@query("b13_stable_id", """
SELECT event_id, substr(sha256('{"event_id":"' || event_id || '","event_type":"' || event_type || '","user_id":"' || user_id || '"}'), 1, 32) AS source_id FROM events""")
def b13(spark, sf):
    return table(spark, sf, "events").select("event_id", S.stable_id("user_id", "event_type", "event_id").alias("source_id"))


@query("b15_payload_fields", "SELECT event_id, TRY_CAST(props::JSON ->> 'k' AS BIGINT) AS k FROM events")
def b15(spark, sf):
    return table(spark, sf, "events").select("event_id", *S.payload_fields(F.col("props"), {"k": "bigint"}))


@query("b16_b17_ratios", f"""WITH {FIN}, r AS (
  SELECT ticker, period_end, form, net_income - abs(gross_profit * 0.1) AS fcf, gross_profit / revenue AS gm, net_income / revenue AS nm, net_income / (shares * 100) AS roe, revenue / (shares * 100) AS de, (net_income - abs(gross_profit * 0.1)) / revenue AS fm FROM fin)
SELECT ticker, period_end, form, round(fcf, 2) AS fcf, round(CASE WHEN gm < 1 AND gm >= -1 THEN gm END, 6) AS gross_margin, round(CASE WHEN abs(nm) <= 5 THEN nm END, 6) AS net_margin,
       round(roe, 4) AS roe, round(de, 4) AS debt_to_equity, round(CASE WHEN abs(fm) <= 5 THEN fm END, 6) AS fcf_margin FROM r""")
def b16(spark, sf):
    f = financials(spark, sf).withColumns({"operating_cf": F.col("net_income"), "capex": F.col("gross_profit") * 0.1, "total_equity": F.col("shares") * 100, "lt_debt": F.col("revenue")})
    r = S.null_implausible(S.derive_ratios(f))
    return r.select("ticker", "period_end", "form", F.round("fcf", 2).alias("fcf"), F.round("gross_margin", 6).alias("gross_margin"), F.round("net_margin", 6).alias("net_margin"), F.round("roe", 4).alias("roe"), F.round("debt_to_equity", 4).alias("debt_to_equity"), F.round("fcf_margin", 6).alias("fcf_margin"))


@query("b19_headline", "SELECT event_id, printf('%s by user %d: %.2f', event_type, user_id, value) AS headline FROM events")
def b19(spark, sf):
    return table(spark, sf, "events").select("event_id", S.headline("%s by user %d: %.2f", F.col("event_type"), F.col("user_id"), F.col("value")).alias("headline"))


@query("b20_meeting_date", "SELECT o_orderkey, o_orderdate::DATE AS meeting FROM orders")
def b20(spark, sf):
    text = F.concat(F.date_format("o_orderdate", "MMMM"), F.lit(" 1-"), F.dayofmonth("o_orderdate").cast("string"))
    return table(spark, sf, "orders").select("o_orderkey", S.meeting_date(text, F.year("o_orderdate")).alias("meeting"))


@query("b20_meeting_time", "SELECT o_orderkey, ((o_orderdate::DATE + INTERVAL 14 HOUR) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS known FROM orders")
def b20_time(spark, sf):
    text = F.concat(F.date_format("o_orderdate", "MMMM"), F.lit(" 1-"), F.dayofmonth("o_orderdate").cast("string"))
    return table(spark, sf, "orders").select("o_orderkey", S.meeting_time(text, F.year("o_orderdate")).alias("known"))


@query("b4_default_flags", """WITH i AS (SELECT event_id, ['4.01', '1.03', '2.03', '3.01', '2.02', '5.02', '2.01', '1.01'][1 + event_id % 8] AS a, ['2.02', '9.01', '5.02'][1 + user_id % 3] AS b FROM events)
SELECT event_id, (a = '4.01')::INT AS has_auditor_change, (a = '1.03')::INT AS has_bankruptcy, (a = '2.03')::INT AS has_debt_obligation, (a = '3.01')::INT AS has_delisting, (a = '2.02' OR b = '2.02')::INT AS has_earnings,
  (a = '5.02' OR b = '5.02')::INT AS has_exec_change, (a = '2.01')::INT AS has_ma, (a = '1.01')::INT AS has_material_agreement FROM i""")
def b4_default(spark, sf):
    codes, more = ["4.01", "1.03", "2.03", "3.01", "2.02", "5.02", "2.01", "1.01"], ["2.02", "9.01", "5.02"]
    a, b = (F.get(F.array(*[F.lit(c) for c in cs]), (F.col(of) % len(cs)).cast("int")) for cs, of in ((codes, "event_id"), (more, "user_id")))
    return table(spark, sf, "events").select("event_id", *S.item_flags(F.concat(a, F.lit(" , "), b)))


@query("b22_statutory_tax", "SELECT o_orderkey, CASE WHEN year(o_orderdate) + 20 <= 2017 THEN 0.35 ELSE 0.21 END::DOUBLE AS rate FROM orders")
def b22(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", S.statutory_tax(F.year("o_orderdate") + 20).alias("rate"))
