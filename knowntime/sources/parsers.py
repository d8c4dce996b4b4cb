"""Landed files and pages to rows. Fetching is not done here."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from knowntime.functions.scalars import add_publication_lag, base_form, derive_ratios, is_period_length, meeting_time, parse_amount
from knowntime.operators.pit import dedup_latest, number_revisions


def load_series_csv(spark: SparkSession, path: str, code: str, lags: dict[str, int], today: str, floor: str = "1990-01-01") -> DataFrame:
    """A two-column file of dates and values; ``.`` and blanks are missing and dropped."""
    raw = spark.read.option("header", True).csv(path)
    date = next((c for c in raw.columns if "date" in c.lower()), raw.columns[0])
    value = next(c for c in raw.columns if c != date)
    rows = raw.select(F.to_date(F.try_to_timestamp(date)).alias("event"), F.col(value).try_cast("double").alias("value"))
    rows = rows.where(F.col("event").isNotNull() & F.col("value").isNotNull() & ~F.isnan("value") & (F.col("event") >= floor)).withColumn("indicator_code", F.lit(code))
    return add_publication_lag(rows, "indicator_code", "event", lags, 35, today)


def load_series_json(raw: DataFrame, column: str = "json") -> DataFrame:
    """``observations[]`` of (date, value, realtime_start); values that are no numbers are skipped, other columns are kept."""
    schema = "observations array<struct<date:string,value:string,realtime_start:string>>"
    keys = [c for c in raw.columns if c != column]
    seen = raw.select(*keys, F.inline(F.from_json(column, schema).getField("observations")))
    rows = seen.select(*keys, F.col("date").try_cast("date").alias("event"), F.col("value").try_cast("double").alias("value"), F.col("realtime_start").try_cast("date").alias("known"))
    return rows.where("event is not null and value is not null")


def load_series_vintages(releases: DataFrame, keys: list[str], order: list[str], value: str = "value") -> DataFrame:
    """Every release of every observation with its revision number."""
    return number_revisions(releases.where(F.col(value).isNotNull()), keys, order)


def explode_submissions(raw: DataFrame, forms: list[str], first: str = "1900-01-01", last: str = "9999-12-31", column: str = "json") -> DataFrame:
    """Parallel arrays of filings as rows, recent and older pages alike; shorter arrays end a row's fields with null."""
    part = "struct<form:array<string>,filingDate:array<string>,accessionNumber:array<string>,items:array<string>,reportDate:array<string>,primaryDocument:array<string>>"
    parsed = F.from_json(column, f"filings struct<recent:{part}>,form array<string>,filingDate array<string>,accessionNumber array<string>,items array<string>,reportDate array<string>,primaryDocument array<string>")
    pages = raw.withColumn("_p", parsed)
    names = ["form", "filingDate", "accessionNumber", "items", "reportDate", "primaryDocument"]
    zipped = F.arrays_zip(*[F.coalesce(F.col(f"_p.filings.recent.{n}"), F.col(f"_p.{n}"), F.array().cast("array<string>")).alias(n) for n in names])
    rows = pages.select(*[c for c in raw.columns if c != column], F.inline(zipped))
    rows = rows.withColumn("filing_date", F.col("filingDate").try_cast("date")).where(F.col("form").isin(*forms) & F.col("filing_date").between(first, last))
    keys = [c for c in raw.columns if c != column]
    return dedup_latest(rows, [*keys, "accessionNumber"], [F.col("filing_date").desc(), F.col("form")])


def explode_company_facts(raw: DataFrame, column: str = "json") -> DataFrame:
    """facts -> taxonomy -> tag -> unit -> observations, one row an observation."""
    obs = "array<struct<start:string,end:string,form:string,filed:string,val:double,accn:string>>"
    schema = f"facts map<string,map<string,struct<units:map<string,{obs}>>>>"
    keys = [c for c in raw.columns if c != column]
    one = raw.select(*keys, F.explode(F.from_json(column, schema).getField("facts")).alias("taxonomy", "tags"))
    two = one.select(*keys, "taxonomy", F.explode("tags").alias("tag", "body"))
    three = two.select(*keys, "taxonomy", "tag", F.explode("body.units").alias("unit", "rows"))
    four = three.select(*keys, "taxonomy", "tag", "unit", F.inline("rows"))
    return four.withColumns({"start": F.col("start").try_cast("date"), "end": F.col("end").try_cast("date"), "filed": F.col("filed").try_cast("date")})


def facts_of_metrics(observations: DataFrame, tags: dict[str, list[str]], instant: set[str] = frozenset()) -> DataFrame:
    """Observations as (metric, priority) facts of proper periods, amendments as their originals."""
    pairs = [(metric, tag, i) for metric, names in tags.items() for i, tag in enumerate(names)]
    mapping = observations.sparkSession.createDataFrame(pairs, "metric string, tag string, priority int")
    rows = observations.join(F.broadcast(mapping), "tag").withColumn("form", base_form(F.col("form"))).where("form is not null")
    proper = F.col("metric").isin(*instant) | is_period_length(F.col("start"), F.col("end"), F.col("form"))
    return rows.where(proper).withColumnsRenamed({"end": "period_end", "val": "value"})


def facts_by_accession(observations: DataFrame, tags: dict[str, list[str]], by: list[str]) -> DataFrame:
    """One row a filing with all its metrics in a map; the last observation of a metric counts."""
    pairs = [(metric, tag, i) for metric, names in tags.items() for i, tag in enumerate(names)]
    mapping = observations.sparkSession.createDataFrame(pairs, "metric string, tag string, priority int")
    rows = observations.join(F.broadcast(mapping), "tag")
    best = rows.groupBy(*by, "accn", "metric").agg(F.max_by("val", F.struct(-F.col("priority"), "filed", "end")).alias("val"), F.max("filed").alias("filed"))
    return best.groupBy(*by, "accn").agg(F.map_from_entries(F.collect_list(F.struct("metric", "val"))).alias("metrics"), F.max("filed").alias("filed"))


def parse_infotable(spark: SparkSession, path: str) -> DataFrame:
    """Holdings of a 13-F information table, with or without a namespace; rows without cusip go."""
    shares = "struct<sshPrnamt:string,sshPrnamtType:string>"
    voting = "struct<Sole:string,Shared:string,None:string>"
    schema = f"nameOfIssuer string, cusip string, value string, shrsOrPrnAmt {shares}, investmentDiscretion string, votingAuthority {voting}"
    raw = spark.read.format("xml").option("rowTag", "infoTable").option("ignoreNamespace", True).schema(schema).load(path)

    def number(c):
        return F.regexp_replace(c, ",", "").try_cast("bigint")

    rows = raw.select(
        F.col("nameOfIssuer").alias("company_name"), F.trim("cusip").alias("cusip"), number("value").alias("value_raw"),
        number("shrsOrPrnAmt.sshPrnamt").alias("shares"), F.col("shrsOrPrnAmt.sshPrnamtType").alias("share_type"), F.col("investmentDiscretion").alias("discretion"),
        number("votingAuthority.Sole").alias("voting_sole"))
    return rows.where("cusip <> ''")


class _Table(HTMLParser):
    """Cells of one table of a page, by row."""

    def __init__(self, table_id: str | None):
        super().__init__()
        self.wanted, self.depth, self.rows, self.cell = table_id, 0, [], None

    def handle_starttag(self, tag, attrs):
        if tag == "table" and (self.depth or not self.rows and (self.wanted is None or dict(attrs).get("id") == self.wanted)):
            self.depth += 1
        elif self.depth == 1 and tag == "tr":
            self.rows.append([])
        elif self.depth == 1 and tag in ("td", "th") and self.rows:
            self.cell = []

    def handle_endtag(self, tag):
        if tag == "table" and self.depth:
            self.depth -= 1
        elif tag in ("td", "th") and self.cell is not None:
            self.rows[-1].append(" ".join("".join(self.cell).replace(" ", " ").split()))
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


def parse_html_table(pages: DataFrame, table_id: str | None = None, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, row, cells) of the table with an id, or of the first one, on every page."""
    def run(batches):
        for pdf in batches:
            out = []
            for k, text in zip(pdf["k"], pdf["h"]):
                parser = _Table(table_id)
                parser.feed(text or "")
                out += [(k, i, cells) for i, cells in enumerate(r for r in parser.rows if r)]
            yield pd.DataFrame(out, columns=["k", "row", "cells"])

    rows = pages.select(F.col(key).alias("k"), F.col(html).alias("h"))
    schema = f"k {rows.schema['k'].dataType.simpleString()}, row int, cells array<string>"
    return rows.mapInPandas(run, schema).withColumnRenamed("k", key)


def table_columns(rows: DataFrame, names: dict[str, list[str]], key: str = "page_id") -> DataFrame:
    """Cells by header: each output column takes the first header cell that holds one of its words."""
    header = rows.where("row = 0").select(key, F.col("cells").alias("_header"))
    body = rows.where("row > 0").join(header, key)

    def cell(words):
        lowered = F.transform("_header", lambda x: F.lower(x))
        at = F.array_position(F.transform(lowered, lambda x: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(x, w))), True)
        value = F.when(at > 0, F.get("cells", (at - 1).cast("int")))
        return F.when(~value.isin("", "-", "–", "—", "N/A"), value)

    return body.select(key, "row", *[cell(words).alias(name) for name, words in names.items()])


#: Words that name a column on each kind of page.
PAGES = {
    "constituents": {"ticker": ["symbol", "ticker"], "company": ["security", "company"], "sector": ["sector"]},
    "changes": {"day": ["date"], "added": ["added"], "removed": ["removed"], "reason": ["reason"]},
    "insider": {"trade_date": ["trade date"], "ticker": ["ticker"], "insider_name": ["insider"], "trade_type": ["trade type"], "price": ["price"], "qty": ["qty"]},
    "meetings": {"meeting": ["meeting", "dates"], "year": ["year"]},
}


def parse_page(pages: DataFrame, kind: str, table_id: str | None = None, key: str = "page_id", html: str = "html") -> DataFrame:
    """The rows of one kind of page under its column names; tickers have a dash for a dot, numbers are numbers."""
    out = table_columns(parse_html_table(pages, table_id, key, html), PAGES[kind], key)
    for c in ("ticker", "added", "removed"):
        if c in out.columns:
            out = out.withColumn(c, F.upper(F.regexp_replace(F.trim(c), r"\.", "-")))
    out = out.withColumns({c: parse_amount(F.col(c)) for c in ("price", "qty") if c in out.columns})
    if kind == "meetings":
        out = out.withColumn("known", meeting_time(F.col("meeting"), F.col("year").try_cast("int")))
    days = [c for c in ("day", "trade_date") if c in out.columns]
    return out.withColumns({c: F.to_date(F.try_to_timestamp(c)) for c in days})


def discover_links(html: Column) -> tuple[Column, Column]:
    """All ``href`` targets, and the first that is a data file: XML, no style sheet, no cover document."""
    links = F.regexp_extract_all(html, F.lit(r'href="([^"]+)"'), F.lit(1))
    xml = F.filter(links, lambda x: F.endswith(F.lower(x), F.lit(".xml")))
    plain = F.filter(xml, lambda x: ~F.contains(F.lower(x), F.lit("xsl")) & ~F.endswith(F.lower(x), F.lit("primary_doc.xml")))
    second = F.filter(xml, lambda x: ~F.contains(F.lower(x), F.lit("primary_doc")))
    return links, F.coalesce(F.get(plain, F.lit(0)), F.get(second, F.lit(0)))


def load_disclosed_trades(raw: DataFrame, first: str, last: str, column: str = "json", keys: list[str] = ()) -> DataFrame:
    """Disclosed trades under alternative field names; the ticker is required."""
    def pick(*names):
        return F.coalesce(*[F.get_json_object(column, f"$.{n}") for n in names])

    rows = raw.select(
        *keys, F.upper(F.trim(pick("ticker", "symbol"))).alias("ticker"), pick("representative", "senator", "name").alias("member"), pick("type", "transaction_type").alias("side"),
        pick("amount", "range").alias("amount"), pick("transaction_date", "transactionDate").try_cast("date").alias("event"), pick("disclosure_date", "disclosureDate").try_cast("date").alias("known"))
    rows = rows.where(F.col("ticker").isNotNull() & ~F.col("ticker").isin("", "--", "N/A") & F.col("known").between(first, last))
    return rows.withColumn("delay_days", F.datediff("known", "event"))


def load_statements_wide(cells: DataFrame, aliases: dict[str, list[str]], keys: list[str]) -> DataFrame:
    """(keys, label, value) cells as one row a key; per metric the first alias that has a value."""
    pairs = [(metric, label, i) for metric, names in aliases.items() for i, label in enumerate(names)]
    mapping = cells.sparkSession.createDataFrame(pairs, "metric string, label string, priority int")
    named = cells.join(F.broadcast(mapping), "label").where("value is not null and not isnan(value)")
    wide = named.groupBy(*keys).pivot("metric", list(aliases)).agg(F.min_by("value", "priority"))
    kept = wide.where("revenue is not null or net_income is not null")
    return derive_ratios(kept) if {"operating_cf", "capex", "gross_profit", "total_equity", "lt_debt"} <= set(kept.columns) else kept


def load_option_snapshot(calls: DataFrame, puts: DataFrame, expiries: int = 8) -> DataFrame:
    """Calls and puts of the nearest expiries of each ticker."""
    both = calls.withColumn("option_type", F.lit("C")).unionByName(puts.withColumn("option_type", F.lit("P")), allowMissingColumns=True)
    rank = F.dense_rank().over(Window.partitionBy("ticker").orderBy("expiration_date"))
    return both.withColumn("_r", rank).where(F.col("_r") <= expiries).drop("_r")


def load_estimates(raw: DataFrame) -> DataFrame:
    """Actual, estimate and surprise, known at the announcement, else at the period's end."""
    return raw.withColumns({"known": F.coalesce("announced", "period_end"), "surprise": F.col("actual") - F.col("estimate")})
