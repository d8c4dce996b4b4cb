"""Landed files, sinks and the catalogue: each query writes what the driver tables hold in a source's format and reads it back."""

from pyspark.sql import functions as F

from knowntime.functions import scalars as S
from knowntime.operators import fundamentals as X
from knowntime.operators import pit
from knowntime.plans.proxies import BARS, FIN, bars, financials, table
from knowntime.plans.registry import query
from knowntime.plans.store_queries import shared
from knowntime.sources import parsers, store
from knowntime.streaming import increments


@query("a2_read_tolerant", """SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS keys, 1::BIGINT AS broken FROM orders""")
def a2(spark, sf):
    """Good files beside one that is no Parquet file."""
    root = shared(spark)
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    o.write.parquet(f"{root}/mixed")
    o.limit(1).select(F.lit("not a table").alias("value")).coalesce(1).write.mode("append").text(f"{root}/mixed")
    rows = store.read_tolerant(spark, f"{root}/mixed", o.schema)
    broken = store.broken_files(store.files_of(spark, f"{root}/mixed"), rows).agg(F.count(F.lit(1)).alias("broken"))
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_orderkey").alias("keys")).join(F.broadcast(broken), F.lit(True))


@query("a5_read_macro_pit", """
WITH v AS (SELECT l_orderkey AS indicator_code, o_orderdate::DATE::TIMESTAMP AS event_timestamp, l_shipdate::DATE::TIMESTAMP AS knowledge_timestamp, l_extendedprice AS value, l_linenumber AS line FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
r AS (SELECT *, row_number() OVER (PARTITION BY indicator_code, event_timestamp ORDER BY knowledge_timestamp, line, value) - 1 AS revision_number FROM v)
SELECT indicator_code, event_timestamp, value FROM r WHERE event_timestamp BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-01-01' AND knowledge_timestamp <= TIMESTAMP '1998-01-01'
QUALIFY row_number() OVER (PARTITION BY indicator_code, event_timestamp ORDER BY revision_number DESC) = 1""")
def a5(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").cast("timestamp_ntz").alias("event_timestamp"))
    v = table(spark, sf, "lineitem").join(o, "l_orderkey").select(
        F.col("l_orderkey").alias("indicator_code"), "event_timestamp", F.col("l_shipdate").cast("date").cast("timestamp_ntz").alias("knowledge_timestamp"), F.col("l_extendedprice").alias("value"), F.col("l_linenumber").alias("line"))
    r = pit.number_revisions(v, ["indicator_code", "event_timestamp"], ["knowledge_timestamp", "line", "value"], "revision_number")
    return store.read_macro_pit(r, "1998-01-01", "1996-01-01").select("indicator_code", "event_timestamp", "value")


@query("a6_load_series_csv", """
WITH d AS (SELECT o_orderdate::DATE AS event, max(o_orderkey) AS v FROM orders GROUP BY 1)
SELECT event, v::DOUBLE AS value, least(event + 35, DATE '1998-06-30') AS known FROM d WHERE v % 5 <> 0 AND event >= DATE '1993-01-01'""")
def a6(spark, sf):
    """Days and values with points and blanks for missing ones."""
    root = shared(spark)
    d = table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("DATE")).agg(F.max("o_orderkey").alias("v"))
    d.select("DATE", F.when(F.col("v") % 10 == 0, ".").when(F.col("v") % 5 == 0, "").otherwise(F.col("v").cast("string")).alias("SERIES")).write.option("header", True).csv(f"{root}/csv")
    return parsers.load_series_csv(spark, f"{root}/csv", "SERIES", {"OTHER": 3}, "1998-06-30", "1993-01-01").select("event", "value", "known")


@query("a7_load_series_json", "SELECT user_id, ts::DATE AS event, value, ts::DATE + 3 AS known, event_id FROM events WHERE event_id % 4 > 0")
def a7(spark, sf):
    """Observations by user and day, a quarter of them without a number."""
    e = table(spark, sf, "events")
    day = F.col("ts").cast("date")
    one = F.struct(day.cast("string").alias("date"), F.when(F.col("event_id") % 4 > 0, F.col("value").cast("string")).otherwise(".").alias("value"), F.date_add(day, 3).cast("string").alias("realtime_start"))
    raw = e.groupBy("user_id", "event_id").agg(F.to_json(F.struct(F.collect_list(one).alias("observations"))).alias("json"))
    return parsers.load_series_json(raw).select("user_id", "event", "value", "known", "event_id")


@query("a9_explode_submissions", """
WITH f AS (SELECT o_custkey AS cik, year(o_orderdate) AS year, CASE o_orderstatus WHEN 'F' THEN '10-K' WHEN 'O' THEN '10-Q' ELSE '8-K' END AS form, o_orderdate::DATE AS filing_date, 'A' || o_orderkey AS accession, CASE WHEN o_orderkey % 2 = 0 THEN '2.02, 9.01' ELSE '5.02' END AS items FROM orders)
SELECT cik, year, form, filing_date, accession, items FROM f WHERE form IN ('10-K', '10-Q') AND filing_date BETWEEN DATE '1994-01-01' AND DATE '1997-12-31'""")
def a9(spark, sf):
    """Parallel arrays by company and year, half of them as the recent page and half as an older one."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("cik"), F.year("o_orderdate").cast("long").alias("year"), F.struct(
        F.concat(F.lit("A"), "o_orderkey").alias("accessionNumber"), F.when(F.col("o_orderstatus") == "F", "10-K").when(F.col("o_orderstatus") == "O", "10-Q").otherwise("8-K").alias("form"),
        F.col("o_orderdate").cast("date").cast("string").alias("filingDate"), F.when(F.col("o_orderkey") % 2 == 0, "2.02, 9.01").otherwise("5.02").alias("items")).alias("f"))
    rows = o.groupBy("cik", "year").agg(F.array_sort(F.collect_list("f")).alias("f"))
    arrays = F.struct(*[F.col(f"f.{c}").alias(c) for c in ("accessionNumber", "form", "filingDate", "items")])
    recent = F.to_json(F.struct(F.struct(arrays.alias("recent")).alias("filings")))
    raw = rows.select("cik", "year", F.when(F.col("cik") % 2 == 0, recent).otherwise(F.to_json(arrays)).alias("json"))
    return parsers.explode_submissions(raw, ["10-K", "10-Q"], "1994-01-01", "1997-12-31").select("cik", "year", "form", "filing_date", F.col("accessionNumber").alias("accession"), "items")


#: Tags of filings by metric, the first one first.
TAGS = {
    "revenue": ["Revenues", "SalesRevenueNet"], "net_income": ["NetIncomeLoss"], "gross_profit": ["GrossProfit"], "operating_cf": ["NetCashProvidedByOperatingActivities"],
    "capex": ["PaymentsToAcquireProperty"], "total_equity": ["StockholdersEquity"], "lt_debt": ["LongTermDebt"],
}
EPS_TAGS = {"eps": ["EarningsPerShareDiluted", "EarningsPerShareBasic"]}
INSTANT = {"total_equity", "lt_debt"}


def company_facts(spark, sf):
    """(ticker, year, json): filings as nested facts, with amendments, second tags and periods of a wrong length among them."""
    f = financials(spark, sf)
    length = F.when(F.col("form") == "10-K", 364).otherwise(90)

    def fact(tag, value, form=None, late=0, days=length, where=F.lit(True)):
        form = F.col("form") if form is None else form
        return F.when(where & value.isNotNull(), F.struct(F.lit(tag).alias("tag"), F.struct(
            F.date_sub("period_end", days).cast("string").alias("start"), F.col("period_end").cast("string").alias("end"), form.alias("form"), F.date_add("known", late).cast("string").alias("filed"),
            value.cast("double").alias("val"), F.concat_ws("-", "ticker", "period_end", form, F.lit(str(late))).alias("accn")).alias("o")))

    revenue, first = F.col("revenue"), F.col("ticker") % 7 != 0
    made = [
        fact("Revenues", revenue, where=first), fact("Revenues", revenue * 1.01, F.lit("10-K/A"), 30, where=first & (F.col("form") == "10-K") & (F.col("ticker") % 5 == 0)),
        fact("Revenues", revenue * 9, late=90, days=180, where=first & (F.col("form") == "10-Q")), fact("SalesRevenueNet", revenue * 2, late=60, where=F.col("ticker") % 2 == 0),
        *[fact(TAGS[m][0], F.col(m)) for m in TAGS if m != "revenue"],
        fact("EarningsPerShareDiluted", F.col("eps"), where=F.col("ticker") % 3 != 0), fact("EarningsPerShareBasic", F.col("eps") * 1.1),
    ]
    rows = f.select("ticker", "year", F.explode(F.filter(F.array(*made), lambda x: x.isNotNull())).alias("f")).select("ticker", "year", "f.tag", "f.o")
    by_tag = rows.groupBy("ticker", "year", "tag").agg(F.array_sort(F.collect_list("o")).alias("o"))
    tags = by_tag.groupBy("ticker", "year").agg(F.map_from_entries(F.collect_list(F.struct("tag", F.struct(F.create_map(F.lit("USD"), "o").alias("units"))))).alias("tags"))
    return tags.select("ticker", "year", F.to_json(F.struct(F.create_map(F.lit("us-gaap"), "tags").alias("facts"))).alias("json"))


OBSERVED = f"""{FIN},
length AS (SELECT *, CASE form WHEN '10-K' THEN 364 ELSE 90 END AS days FROM fin),
obs AS (
  SELECT ticker, year, period_end, form AS base, form, 'revenue' AS metric, 0 AS priority, known AS filed, revenue AS val, days FROM length WHERE ticker % 7 <> 0
  UNION ALL SELECT ticker, year, period_end, form, '10-K/A', 'revenue', 0, known + 30, revenue * 1.01, days FROM length WHERE ticker % 7 <> 0 AND form = '10-K' AND ticker % 5 = 0
  UNION ALL SELECT ticker, year, period_end, form, form, 'revenue', 0, known + 90, revenue * 9, 180 FROM length WHERE ticker % 7 <> 0 AND form = '10-Q'
  UNION ALL SELECT ticker, year, period_end, form, form, 'revenue', 1, known + 60, revenue * 2, days FROM length WHERE ticker % 2 = 0
  UNION ALL SELECT ticker, year, period_end, form, form, unnest(['net_income', 'gross_profit', 'operating_cf', 'capex', 'total_equity', 'lt_debt']), 0, known, unnest([net_income, gross_profit, operating_cf, capex, total_equity, lt_debt]), days FROM length
  UNION ALL SELECT ticker, year, period_end, form, form, 'eps', 0, known, eps, days FROM length WHERE ticker % 3 <> 0
  UNION ALL SELECT ticker, year, period_end, form, form, 'eps', 1, known, eps * 1.1, days FROM length)"""


@query("a10_company_facts", f"WITH {OBSERVED} SELECT ticker, count(*) AS observations, count(*) FILTER (WHERE days = 180) AS half_years, max(filed) AS filed, round(sum(val), 2) AS total FROM obs GROUP BY 1")
def a10(spark, sf):
    o = parsers.explode_company_facts(company_facts(spark, sf))
    return o.groupBy("ticker").agg(F.count(F.lit(1)).alias("observations"), F.sum((F.datediff("end", "start") == 180).cast("long")).alias("half_years"), F.max("filed").alias("filed"), F.round(F.sum("val"), 2).alias("total"))


@query("a11_facts_by_accession", f"""WITH {OBSERVED}, a AS (SELECT ticker, period_end, form, metric, arg_max(val, (-priority, filed)) AS val FROM obs WHERE metric <> 'eps' AND days <> 180 GROUP BY ALL)
SELECT ticker, period_end::VARCHAR || '-' || form AS filing, count(*) AS n_metrics, round(max(val) FILTER (WHERE metric = 'net_income'), 6) AS net_income, round(max(val) FILTER (WHERE metric = 'gross_profit'), 6) AS gross_profit, round(max(val) FILTER (WHERE metric = 'revenue'), 6) AS revenue
FROM a GROUP BY 1, 2""")
def a11(spark, sf):
    """A filing's revenue under two tags: the first counts, whichever was filed last."""
    part = F.split("accn", "-")
    o = parsers.explode_company_facts(company_facts(spark, sf)).where("datediff(end, start) <> 180").withColumn("accn", F.concat_ws("-", F.slice(part, 2, F.size(part) - 2)))
    wide = parsers.facts_by_accession(o, TAGS, ["ticker"])
    return wide.select("ticker", F.col("accn").alias("filing"), F.size("metrics").cast("long").alias("n_metrics"), *[F.round(F.try_element_at("metrics", F.lit(m)), 6).alias(m) for m in ("net_income", "gross_profit", "revenue")])


@query("f4_financials", f"""WITH {OBSERVED}, p AS (SELECT * FROM obs WHERE metric <> 'eps' AND (metric IN ('total_equity', 'lt_debt') OR CASE base WHEN '10-Q' THEN days BETWEEN 60 AND 105 ELSE days BETWEEN 330 AND 400 END)),
b AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY ticker, period_end, base, metric ORDER BY priority, filed DESC, val DESC) = 1),
w AS (SELECT ticker, period_end, base AS form, greatest(max(filed), period_end) AS knowledge, max(val) FILTER (WHERE metric = 'revenue') AS revenue, max(val) FILTER (WHERE metric = 'net_income') AS net_income, max(val) FILTER (WHERE metric = 'gross_profit') AS gross_profit,
  max(val) FILTER (WHERE metric = 'operating_cf') - abs(max(val) FILTER (WHERE metric = 'capex')) AS fcf, max(val) FILTER (WHERE metric = 'total_equity') AS equity, max(val) FILTER (WHERE metric = 'lt_debt') AS debt FROM b GROUP BY ticker, period_end, base)
SELECT ticker, period_end, form, knowledge, round(revenue, 6) AS revenue, round(fcf, 4) AS fcf, round(CASE WHEN gross_profit / revenue < 1 AND gross_profit / revenue >= -1 THEN gross_profit / revenue END, 6) AS gross_margin,
  round(CASE WHEN abs(net_income / revenue) <= 5 THEN net_income / revenue END, 6) AS net_margin, round(net_income / equity, 6) AS roe, round(debt / equity, 6) AS debt_to_equity, round(CASE WHEN abs(fcf / revenue) <= 5 THEN fcf / revenue END, 6) AS fcf_margin FROM w""")
def f4(spark, sf):
    """From nested facts to ratios: tags by priority, amendments for originals, periods of a proper length."""
    facts = parsers.facts_of_metrics(parsers.explode_company_facts(company_facts(spark, sf)), TAGS, INSTANT)
    f = X.financial_table(facts, ["ticker", "period_end", "form"], list(TAGS))
    return f.select("ticker", "period_end", "form", "knowledge", F.round("revenue", 6).alias("revenue"), F.round("fcf", 4).alias("fcf"), *[F.round(c, 6).alias(c) for c in ("gross_margin", "net_margin", "roe", "debt_to_equity", "fcf_margin")])


@query("f5_earnings", f"""WITH {OBSERVED}, e0 AS (SELECT ticker, period_end, base AS form, filed AS known, val AS eps FROM obs WHERE metric = 'eps' QUALIFY priority = min(priority) OVER (PARTITION BY ticker)),
near AS (SELECT a.ticker, a.period_end, a.known, a.eps, q.eps AS q_eps, row_number() OVER (PARTITION BY a.ticker, a.period_end ORDER BY q.period_end DESC) AS r
  FROM e0 a JOIN e0 q ON a.ticker = q.ticker AND a.form = '10-K' AND q.form = '10-Q' AND q.period_end < a.period_end AND q.period_end > a.period_end - 280),
q4 AS (SELECT ticker, period_end, known, eps - sum(q_eps) AS eps FROM near WHERE r <= 3 GROUP BY ticker, period_end, known, eps HAVING count(q_eps) = 3 AND abs(eps - sum(q_eps)) <= 6 * avg(abs(q_eps))),
a AS (SELECT ticker, period_end, form, known, round(eps, 4) AS eps, false AS implied FROM e0 UNION ALL SELECT ticker, period_end, '10-Q', known, round(eps, 4), true FROM q4),
est AS (SELECT ticker, period_end, round(eps * 0.9, 4) AS estimate, round(eps * 0.1, 4) AS surprise FROM fin WHERE form = '10-Q' AND quarter < 3)
SELECT ticker, period_end, form, known, eps, implied, estimate, surprise FROM a FULL JOIN est USING (ticker, period_end)""")
def f5(spark, sf):
    facts = parsers.facts_of_metrics(parsers.explode_company_facts(company_facts(spark, sf)), EPS_TAGS)
    raw = financials(spark, sf).where("form = '10-Q' and quarter < 3").select("ticker", "period_end", F.lit(None).cast("date").alias("announced"), F.col("eps").alias("actual"), (F.col("eps") * 0.9).alias("estimate"))
    estimates = parsers.load_estimates(raw).select("ticker", "period_end", F.round("estimate", 4).alias("estimate"), F.round("surprise", 4).alias("surprise"))
    e = X.earnings_table(facts.select("ticker", "period_end", "form", "priority", "filed", "value"), estimates, ["estimate", "surprise"])
    return e.withColumn("eps", F.round("eps", 4))


#: A file of XML is read by one task, so filings land in files of so many rows, about 40 MB of XML, however large the table is. XML repeats
#: its tags in every row, so files land compressed.
ROWS_OF_A_FILING = 100_000


@query("a12_parse_infotable", "SELECT 'C' || l_suppkey AS cusip, sum(l_partkey)::BIGINT AS value_raw, sum(l_quantity)::BIGINT AS shares, count(*) FILTER (WHERE l_returnflag = 'R') AS voting FROM lineitem WHERE l_suppkey % 9 <> 0 GROUP BY 1")
def a12(spark, sf):
    """Information tables as XML, with separators in numbers and rows without a cusip."""
    root = shared(spark)
    rows = table(spark, sf, "lineitem").select(
        F.concat(F.lit("Issuer & Co "), "l_suppkey").alias("nameOfIssuer"), F.when(F.col("l_suppkey") % 9 == 0, " ").otherwise(F.concat(F.lit("C"), "l_suppkey")).alias("cusip"),
        F.format_number("l_partkey", 0).alias("value"), F.struct(F.col("l_quantity").cast("int").cast("string").alias("sshPrnamt"), F.lit("SH").alias("sshPrnamtType")).alias("shrsOrPrnAmt"),
        F.lit("SOLE").alias("investmentDiscretion"), F.struct(F.when(F.col("l_returnflag") == "R", "1").otherwise("0").alias("Sole"), F.lit("0").alias("Shared"), F.lit("0").alias("None")).alias("votingAuthority"))
    rows.write.format("xml").option("rowTag", "infoTable").option("rootTag", "informationTable").option("maxRecordsPerFile", ROWS_OF_A_FILING).option("compression", "gzip").save(f"{root}/xml")
    parsed = parsers.parse_infotable(spark, f"{root}/xml")
    return parsed.groupBy("cusip").agg(F.sum("value_raw").alias("value_raw"), F.sum("shares").alias("shares"), F.sum("voting_sole").alias("voting"))


def _page(spark, sf, header, cells):
    """One page a supplier: a table of another id, then the wanted one."""
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells], F.lit("</tr>"))
    head = "".join(f"<th>{h}</th>" for h in header)
    html = F.concat(F.lit('<html><table id="nav"><tr><td>x</td></tr></table><p>text</p><table id="main"><thead><tr>' + head + "</tr></thead>"), row, F.lit("</table></html>"))
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("page_id"), html.alias("html"))


@query("a13_parse_constituents", "SELECT s_suppkey AS page_id, 'S' || s_suppkey || '-B' AS ticker, s_name AS company, CASE WHEN s_nationkey % 5 > 0 THEN 'sector ' || s_nationkey END AS sector FROM supplier")
def a13(spark, sf):
    cells = [F.concat(F.lit("<a href='/x'>S"), "s_suppkey", F.lit(".B</a>")), F.col("s_name"), F.when(F.col("s_nationkey") % 5 > 0, F.concat(F.lit("sector "), "s_nationkey")).otherwise(F.lit("—"))]
    return parsers.parse_page(_page(spark, sf, ["Symbol", "Security", "GICS Sector"], cells), "constituents", "main").select("page_id", "ticker", "company", "sector")


@query("a13_parse_changes", "SELECT s_suppkey AS page_id, DATE '2001-01-01' + (s_suppkey % 300)::INT AS day, 'A' || s_suppkey AS added, 'R-' || s_suppkey AS removed FROM supplier")
def a13_changes(spark, sf):
    day = F.date_format(F.date_add(F.lit("2001-01-01").cast("date"), (F.col("s_suppkey") % 300).cast("int")), "yyyy-MM-dd")
    return parsers.parse_page(_page(spark, sf, ["Date", "Added", "Removed", "Reason"], [day, F.concat(F.lit("a"), "s_suppkey"), F.concat(F.lit("R."), "s_suppkey"), F.lit("N/A")]), "changes", "main").select("page_id", "day", "added", "removed")


@query("a13_parse_insider", "SELECT s_suppkey AS page_id, 'T' || s_suppkey AS ticker, s_suppkey * 1000.0 AS price, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey::DOUBLE END AS qty FROM supplier")
def a13_insider(spark, sf):
    qty = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("+"), F.format_number("s_suppkey", 0))).otherwise(F.lit("-"))
    cells = [F.lit("2020-01-02"), F.concat(F.lit("t"), "s_suppkey"), F.lit("A Person"), F.lit("P - Purchase"), F.concat(F.lit("$"), "s_suppkey", F.lit("K")), qty]
    return parsers.parse_page(_page(spark, sf, ["Trade Date", "Ticker", "Insider Name", "Trade Type", "Price", "Qty"], cells), "insider", "main").select("page_id", "ticker", "price", "qty")


@query("a13_parse_meetings", "SELECT s_suppkey AS page_id, ((make_date(2000 + (s_suppkey % 20)::INT, 3, 20) + INTERVAL 14 HOUR) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS known FROM supplier")
def a13_meetings(spark, sf):
    return parsers.parse_page(_page(spark, sf, ["Meeting", "Year"], [F.lit("March 19-20"), (F.col("s_suppkey") % 20 + 2000).cast("string")]), "meetings", "main").select("page_id", "known")


@query("a15_disclosed_trades", """SELECT event_id, 'U' || user_id AS ticker, event_type AS side, ts::DATE AS event, ts::DATE + (event_id % 50)::INT AS known, (event_id % 50)::INT AS delay_days FROM events
WHERE event_id % 6 <> 0 AND ts::DATE + (event_id % 50)::INT BETWEEN DATE '2024-01-10' AND DATE '2024-02-10'""")
def a15(spark, sf):
    """Two spellings of the fields; a sixth without a ticker."""
    e = table(spark, sf, "events")
    ticker = F.when(F.col("event_id") % 6 == 0, "--").otherwise(F.concat(F.lit(" u"), "user_id"))
    day, told = F.col("ts").cast("date").cast("string"), F.date_add(F.col("ts").cast("date"), (F.col("event_id") % 50).cast("int")).cast("string")
    a = F.to_json(F.struct(ticker.alias("ticker"), F.lit("A").alias("representative"), F.col("event_type").alias("type"), F.lit("1K").alias("amount"), day.alias("transaction_date"), told.alias("disclosure_date")))
    b = F.to_json(F.struct(ticker.alias("symbol"), F.lit("B").alias("senator"), F.col("event_type").alias("transaction_type"), F.lit("2K").alias("range"), day.alias("transactionDate"), told.alias("disclosureDate")))
    raw = e.select("event_id", F.when(F.col("event_id") % 2 == 0, a).otherwise(b).alias("json"))
    return parsers.load_disclosed_trades(raw, "2024-01-10", "2024-02-10", keys=["event_id"]).select("event_id", "ticker", "side", "event", "known", "delay_days")


@query("a16_statements_wide", f"""WITH {FIN} SELECT ticker, period_end, round(CASE WHEN ticker % 2 = 0 THEN revenue ELSE revenue * 3 END, 4) AS revenue, round(fcf, 4) AS fcf, round(net_income / CASE WHEN ticker % 2 = 0 THEN revenue ELSE revenue * 3 END, 6) AS net_margin FROM fin WHERE form = '10-Q'""")
def a16(spark, sf):
    """Label by date cells; the first alias that has a value counts."""
    f = financials(spark, sf).where("form = '10-Q'")
    wide = f.select("ticker", "period_end", F.when(F.col("ticker") % 2 == 0, F.col("revenue")).alias("Total Revenue"), (F.col("revenue") * 3).alias("Operating Revenue"), F.col("net_income").alias("Net Income"),
                    F.col("gross_profit").alias("Gross Profit"), F.col("operating_cf").alias("Operating Cash Flow"), F.col("capex").alias("Capital Expenditure"), F.col("total_equity").alias("Equity"), F.col("lt_debt").alias("Debt"))
    cells = wide.unpivot(["ticker", "period_end"], [c for c in wide.columns if c not in ("ticker", "period_end")], "label", "value")
    aliases = {"revenue": ["Total Revenue", "Operating Revenue"], "net_income": ["Net Income"], "gross_profit": ["Gross Profit"], "operating_cf": ["Operating Cash Flow"], "capex": ["Capital Expenditure"], "total_equity": ["Equity"], "lt_debt": ["Debt"]}
    s = parsers.load_statements_wide(cells, aliases, ["ticker", "period_end"])
    return s.select("ticker", "period_end", F.round("revenue", 4).alias("revenue"), F.round("fcf", 4).alias("fcf"), F.round("net_margin", 6).alias("net_margin"))


@query("a17_option_snapshot", """WITH o AS (SELECT l_suppkey AS ticker, date_trunc('month', l_shipdate)::DATE AS expiration_date, l_extendedprice AS strike, CASE WHEN l_linestatus = 'O' THEN 'C' ELSE 'P' END AS option_type FROM lineitem)
SELECT ticker, expiration_date, option_type, count(*) AS n, max(strike) AS strike FROM (SELECT *, dense_rank() OVER (PARTITION BY ticker ORDER BY expiration_date) AS r FROM o) WHERE r <= 8 GROUP BY 1, 2, 3""")
def a17(spark, sf):
    o = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("ticker"), F.trunc("l_shipdate", "month").alias("expiration_date"), F.col("l_extendedprice").alias("strike"), "l_linestatus")
    both = parsers.load_option_snapshot(o.where("l_linestatus = 'O'").drop("l_linestatus"), o.where("l_linestatus <> 'O'").drop("l_linestatus"))
    return both.groupBy("ticker", "expiration_date", "option_type").agg(F.count(F.lit(1)).alias("n"), F.max("strike").alias("strike"))


@query("a18_load_bars", f"""WITH {BARS} SELECT ticker, event::TIMESTAMP AS event_timestamp, '1D' AS frequency, close, close / 2 AS adj_close, volume, 'file' AS source,
((event + INTERVAL 16 HOUR) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS knowledge_timestamp FROM bars""")
def a18(spark, sf):
    b = bars(spark, sf)
    raw = b.select(F.col("ticker").alias("Ticker"), F.col("event").cast("string").alias("Date"), *[F.col(c).cast("string").alias(c.title()) for c in ("open", "high", "low", "close")], (F.col("close") / 2).cast("string").alias("Adj Close"), F.col("volume").cast("string").alias("Volume"))
    out = store.load_bars(raw, "ticker", "file")
    return out.select("ticker", "event_timestamp", "frequency", "close", "adj_close", "volume", "source", "knowledge_timestamp")


@query("a19_load_estimates", """SELECT o_orderkey AS id, o_totalprice - 1000 AS surprise, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate::DATE ELSE o_orderdate::DATE + 20 END AS known FROM orders""")
def a19(spark, sf):
    day = F.col("o_orderdate").cast("date")
    raw = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), day.alias("period_end"), F.when(F.col("o_orderkey") % 3 != 0, F.date_add(day, 20)).alias("announced"), F.col("o_totalprice").alias("actual"), F.lit(1000.0).alias("estimate"))
    return parsers.load_estimates(raw).select("id", "surprise", "known")


@query("a24_replace_partition", "SELECT year(o_orderdate)::BIGINT AS year, count(*) FILTER (WHERE year(o_orderdate) <> 1996 OR o_orderkey % 2 = 0) AS n, sum(CASE WHEN year(o_orderdate) = 1996 THEN 0 ELSE o_custkey END)::BIGINT AS total FROM orders GROUP BY 1")
def a24(spark, sf):
    """One year dropped and written anew, half as many rows."""
    root = shared(spark)
    o = store.with_partition_cols(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderdate")
    store.replace_partition(o, root, "orders", ["year"])
    store.replace_partition(o.where("year = 1996 and o_orderkey % 2 = 0").withColumn("o_custkey", F.lit(0).cast("long")), root, "orders", ["year"])
    return store.read_table(spark, root, "orders").groupBy(F.col("year").cast("long").alias("year")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("total"))


@query("a25_export_archive", "SELECT count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1997-01-01') AS first, count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01') AS second, 0::BIGINT AS third, count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1998-01-01') AS archived FROM orders")
def a25_export(spark, sf):
    """Two cutoffs and a re-run, which finds all its months archived."""
    root, o = shared(spark), table(spark, sf, "orders")
    n = [store.export_archive(o, root, "cold", "o_orderdate", cutoff) for cutoff in ("1997-01-01", "1998-01-01", "1998-01-01")]
    rows = store.read_table(spark, root, "cold").agg(F.count(F.lit(1)).alias("archived"))
    return rows.select(*[F.lit(k).cast("long").alias(name) for k, name in zip(n, ("first", "second", "third"))], "archived")


@query("a26_write_results", "SELECT 'csv' AS copy, count(*) AS n, sum(o_orderkey)::BIGINT AS total FROM orders UNION ALL SELECT 'parquet', count(*), sum(o_orderkey)::BIGINT FROM orders")
def a26(spark, sf):
    root = shared(spark)
    store.write_results(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), root)
    csv, parquet = spark.read.option("header", True).csv(f"{root}/csv"), spark.read.parquet(f"{root}/parquet")

    def total(df, name):
        return df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_orderkey").cast("long")).alias("total")).select(F.lit(name).alias("copy"), "n", "total")

    return total(csv, "csv").unionByName(total(parquet, "parquet"))


@query("a27_report_document", "SELECT 'orders' AS part, count(*) AS n FROM orders UNION ALL SELECT 'customers', count(*) FROM customer")
def a27(spark, sf):
    """The document's own counts of the parts that it names."""
    parts = {"orders": table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "customers": table(spark, sf, "customer").select("c_custkey")}
    doc = store.report_document({"title": "report", "as_of": "1998-06-30"}, parts, shared(spark), spark)
    listed = F.from_json("document", "parts array<struct<name:string,path:string,rows:bigint>>")
    return doc.select(F.inline(listed["parts"])).select(F.col("name").alias("part"), F.col("rows").alias("n"))


@query("a28_describe_tables", """SELECT table_name, ordinal_position::INT AS position, column_name, n AS n_rows, column_name IN ('o_orderkey', 'event_id') AS is_key, column_name IN ('o_orderdate', 'ts') AS is_time
FROM information_schema.columns JOIN (SELECT 'orders' AS t, count(*) AS n FROM orders UNION ALL SELECT 'events', count(*) FROM events) ON table_name = t""")
def a28(spark, sf):
    own = {"orders": store.TableSpec("orders", ("o_orderkey",), (), "o_orderdate"), "events": store.TableSpec("events", ("event_id",), (), "ts")}
    return store.describe_tables({t: table(spark, sf, t) for t in own}, own).select("table_name", "position", "column_name", "n_rows", "is_key", "is_time")


@query("a30_repartition_flat", "SELECT year(o_orderdate)::BIGINT AS year, strftime(o_orderdate, '%m') AS month, count(*) AS n FROM orders GROUP BY 1, 2")
def a30(spark, sf):
    root, spec = shared(spark), store.TableSpec("flat", ("order_key",), ("year", "month"), "day", ("day",))
    store.repartition_flat(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), root, spec, {"o_orderkey": "order_key", "o_orderdate": "day"})
    return store.read_table(spark, root, "flat").groupBy(F.col("year").cast("long").alias("year"), "month").agg(F.count(F.lit(1)).alias("n"))


@query("b11_b14_stamp", "SELECT o_orderkey, greatest(o_orderdate::DATE - 5 + (o_orderkey % 9)::INT, o_orderdate::DATE) AS known, CASE WHEN o_orderkey % 4 = 0 THEN DATE '1999-01-01' ELSE o_orderdate::DATE END AS knowledge_timestamp, DATE '1999-01-02' AS ingestion_timestamp FROM orders")
def b11(spark, sf):
    day = F.col("o_orderdate").cast("date")
    o = table(spark, sf, "orders").select("o_orderkey", day.alias("day"), F.when(F.col("o_orderkey") % 4 != 0, day).alias("knowledge_timestamp"), F.lit(None).cast("date").alias("ingestion_timestamp"))
    o = S.stamp(o, F.lit("1999-01-01").cast("date"), F.lit("1999-01-02").cast("date"))
    known = S.clamp_knowledge(F.date_add("day", (F.col("o_orderkey") % 9).cast("int") - 5), F.col("day"))
    return o.select("o_orderkey", known.alias("known"), "knowledge_timestamp", "ingestion_timestamp")


@query("b18_first_tag", """WITH f AS (SELECT l_suppkey AS ticker, CASE WHEN l_linenumber > 3 OR l_suppkey % 3 = 0 THEN 1 ELSE 0 END AS priority, l_extendedprice AS value FROM lineitem),
m AS (SELECT *, min(priority) OVER (PARTITION BY ticker) AS best FROM f) SELECT ticker, priority::BIGINT AS priority, count(*) AS n, max(value) AS value FROM m WHERE priority = best GROUP BY 1, 2""")
def b18(spark, sf):
    f = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("ticker"), F.lit("eps").alias("metric"), F.when((F.col("l_linenumber") > 3) | (F.col("l_suppkey") % 3 == 0), 1).otherwise(0).cast("long").alias("priority"), F.col("l_extendedprice").alias("value"))
    return X.first_tag(f, ["ticker"]).groupBy("ticker", "priority").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("value"))


@query("b15_b19_categories", """SELECT event_id, CASE event_type WHEN 'view' THEN printf('P%d: buy of %d shares at %.2f', user_id, event_id, value) WHEN 'click' THEN printf('M%d (house): sale 1K - 5K', user_id) WHEN 'signup' THEN printf('EPS %.2f against %.2f expected', value, value + 1) ELSE printf('regular meeting, rate %.2f', value) END AS headline,
CASE event_type WHEN 'view' THEN value WHEN 'signup' THEN value + 1 ELSE NULL END AS number FROM events""")
def b15_categories(spark, sf):
    """Payloads of the four categories, by the type of an event."""
    e = table(spark, sf, "events")
    v = F.col("value")
    insider = F.to_json(F.struct(F.concat(F.lit("P"), "user_id").alias("insider_name"), F.lit("CEO").alias("title"), F.lit("buy").alias("trade_type"), v.alias("price"), F.col("event_id").alias("qty"), v.alias("value")))
    congress = F.to_json(F.struct(F.concat(F.lit("M"), "user_id").alias("member"), F.lit("house").alias("chamber"), F.lit("sale").alias("side"), F.lit("1K - 5K").alias("amount")))
    earnings = F.to_json(F.struct(v.alias("actual"), (v + 1).alias("estimate")))
    meeting = F.to_json(F.struct(F.lit("regular").alias("kind"), v.alias("rate")))
    kind = F.when(F.col("event_type") == "view", "insider").when(F.col("event_type") == "click", "congress").when(F.col("event_type") == "signup", "earnings").otherwise("meeting")
    p = e.select("event_id", kind.alias("kind"), F.when(kind == "insider", insider).when(kind == "congress", congress).when(kind == "earnings", earnings).otherwise(meeting).alias("payload"))
    text = F.lit(None).cast("string")
    for name in S.PAYLOADS:
        text = F.when(F.col("kind") == name, S.category_headline(F.col("payload"), name)).otherwise(text)
    both = p.select("event_id", text.alias("headline"), "kind", F.struct(*S.category_fields(F.col("payload"), "insider")).alias("i"), F.struct(*S.category_fields(F.col("payload"), "earnings")).alias("e"))
    return both.select("event_id", "headline", F.when(F.col("kind") == "insider", F.col("i.price")).when(F.col("kind") == "earnings", F.col("e.estimate")).alias("number"))


@query("i8_idempotent", "SELECT count(*) AS first, 0::BIGINT AS second, count(*) AS n_rows FROM orders")
def i8(spark, sf):
    """The same batch twice adds nothing."""
    root, spec = shared(spark), store.TableSpec("orders", ("o_orderkey",), ("year",), "o_orderdate", ("o_orderdate",))
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    n = [store.upsert(o, root, spec) for _ in range(2)]
    rows = store.read_table(spark, root, "orders").agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.select(F.lit(n[0]).cast("long").alias("first"), F.lit(n[1]).cast("long").alias("second"), "n_rows")


@query("i9_heartbeat", "SELECT day, n, round(avg(n) OVER (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS usual FROM (SELECT ts::DATE AS day, count(*) AS n FROM events GROUP BY 1)")
def i9(spark, sf):
    return increments.heartbeat(table(spark, sf, "events"), "ts").withColumn("usual", F.round("usual", 6))


@query("i10_build_all", f"""WITH {BARS}, m AS (SELECT ticker, date_trunc('month', event)::DATE AS period, arg_max(close, event) AS close FROM bars GROUP BY 1, 2),
r AS (SELECT ticker, period, close / lag(close) OVER (PARTITION BY ticker ORDER BY period) - 1 AS ret FROM m)
SELECT ticker, count(*) AS n, round(avg(ret), 6) AS mean FROM r WHERE ret IS NOT NULL GROUP BY 1""")
def i10(spark, sf):
    """Bars, monthly bars of them, their returns and a summary, each written before what reads it."""
    from knowntime.operators.bars import resample
    from knowntime.operators.windows import pct_change

    root = shared(spark)
    store.build_all(spark, root, {
        "summary": (("returns",), lambda r: r.where("ret is not null").groupBy("ticker").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("ret"), 6).alias("mean"))),
        "returns": (("monthly",), lambda m: m.select("ticker", "period", pct_change(F.col("close"), "ticker", "period").alias("ret"))),
        "monthly": (("bars",), lambda b: resample(b, "MS")), "bars": ((), lambda: bars(spark, sf))})
    return store.read_table(spark, root, "summary")
