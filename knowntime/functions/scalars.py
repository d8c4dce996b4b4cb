"""Scalar rules as column expressions. Missing input gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ITEM_FLAGS = {
    # Flag names and the disclosure item code that sets each one.
    "has_auditor_change": "4.01",
    "has_bankruptcy": "1.03",
    "has_debt_obligation": "2.03",
    "has_delisting": "3.01",
    "has_earnings": "2.02",
    "has_exec_change": "5.02",
    "has_ma": "2.01",
    "has_material_agreement": "1.01",
}


def item_flags(items: Column, codes: dict[str, str] = ITEM_FLAGS) -> list[Column]:
    """0/1 columns: whether the comma-separated list holds each code."""
    held = F.transform(F.split(F.coalesce(items, F.lit("")), ","), lambda x: F.trim(x))
    return [F.array_contains(held, code).cast("int").alias(name) for name, code in codes.items()]


def base_form(form: Column) -> Column:
    """An amended form as its original; null unless annual or quarterly."""
    base = F.regexp_replace(form, "/A$", "")
    return F.when(base.isin("10-K", "10-Q"), base)


def is_period_length(start: Column, end: Column, form: Column) -> Column:
    """Quarters span 60 to 105 days and need a start; years span 330 to 400 if they have one."""
    days = F.datediff(end, start)
    return F.when(form == "10-Q", F.coalesce(days.between(60, 105), F.lit(False))).when(form == "10-K", F.coalesce(days.between(330, 400), F.lit(True))).otherwise(F.lit(False))


def safe_div(a: Column, b: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """a / b; null where either is missing, b is 0, or the ratio is outside [lo, hi]."""
    q = F.try_divide(a.cast("double"), b.cast("double"))
    fits = F.lit(True)
    if lo is not None:
        fits = fits & (q >= lo)
    if hi is not None:
        fits = fits & (q <= hi)
    return F.when(fits, q)


def parse_amount(text: Column) -> Column:
    """``$1,234``, ``+5``, ``1.5K`` or ``2M`` as a number."""
    bare = F.upper(F.trim(F.regexp_replace(text, r"[$,+\s]", "")))
    scale = F.when(F.endswith(bare, F.lit("K")), 1e3).when(F.endswith(bare, F.lit("M")), 1e6).otherwise(1.0)
    return F.regexp_replace(bare, "[KM]$", "").try_cast("double") * scale


def market_close_utc(day: Column, zone: str = "America/New_York", hour: int = 16) -> Column:
    """The closing time of the exchange on a date, in UTC without zone."""
    local = F.to_timestamp_ntz(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(f" {hour:02d}:00:00")))
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), local)


def add_publication_lag(df: DataFrame, code: str, event: str, lags: dict[str, int], default: int, today, out: str = "known") -> DataFrame:
    """``out`` = event date plus the lag of its code, at most ``today``; the lags are one map, however many codes there are."""
    lag = F.lit(default)
    if lags:
        table = F.create_map(*[F.lit(x) for pair in lags.items() for x in pair])
        lag = F.coalesce(F.try_element_at(table, F.col(code)), lag)
    return df.withColumn(out, F.least(F.date_add(F.col(event).cast("date"), lag), F.lit(today).cast("date")))


def clamp_knowledge(known: Column, event: Column) -> Column:
    """Knowledge never precedes the end of the period it is about."""
    return F.greatest(known, event)


def cap_bucket(cap: Column) -> Column:
    return F.when(cap > 200e9, "mega").when(cap > 10e9, "large").when(cap > 2e9, "mid").otherwise("small")


def stable_id(*columns: str) -> Column:
    """The first 32 hex digits of the SHA-256 of the columns as JSON, keys in order."""
    ordered = F.struct(*[F.col(c).cast("string").alias(c) for c in sorted(columns)])
    return F.substring(F.sha2(F.to_json(ordered, {"ignoreNullFields": "false"}), 256), 1, 32)


def derive_ratios(df: DataFrame) -> DataFrame:
    """Free cash flow and the margins that follow from one filing."""
    fcf = F.col("operating_cf") - F.abs("capex")
    return df.withColumn("fcf", fcf).withColumns({
        "gross_margin": safe_div(F.col("gross_profit"), F.col("revenue")), "net_margin": safe_div(F.col("net_income"), F.col("revenue")),
        "roe": safe_div(F.col("net_income"), F.col("total_equity")), "debt_to_equity": safe_div(F.col("lt_debt"), F.col("total_equity")),
        "fcf_margin": safe_div(F.col("fcf"), F.col("revenue")),
    })


def null_implausible(df: DataFrame) -> DataFrame:
    """Margins no company can have become null."""
    return df.withColumns({
        "gross_margin": F.when((F.col("gross_margin") < 1) & (F.col("gross_margin") >= -1), F.col("gross_margin")),
        "net_margin": F.when(F.abs("net_margin") <= 5, F.col("net_margin")), "fcf_margin": F.when(F.abs("fcf_margin") <= 5, F.col("fcf_margin")),
    })


def stamp(df: DataFrame, known, ingested) -> DataFrame:
    """Fill missing knowledge and ingestion times."""
    return df.withColumns({"knowledge_timestamp": F.coalesce("knowledge_timestamp", F.lit(known)), "ingestion_timestamp": F.coalesce("ingestion_timestamp", F.lit(ingested))})


#: Fields of the JSON payload of each category of events.
PAYLOADS = {
    "insider": {"insider_name": "string", "title": "string", "trade_type": "string", "price": "double", "qty": "bigint", "value": "double"},
    "congress": {"member": "string", "chamber": "string", "side": "string", "amount": "string", "asset": "string", "trade_date": "date", "delay_days": "int"},
    "earnings": {"actual": "double", "estimate": "double", "surprise": "double"},
    "meeting": {"meeting": "string", "kind": "string", "rate": "double"},
}

#: One-line summaries by category.
HEADLINES = {
    "insider": ("%s: %s of %d shares at %.2f", ("insider_name", "trade_type", "qty", "price")),
    "congress": ("%s (%s): %s %s", ("member", "chamber", "side", "amount")),
    "earnings": ("EPS %.2f against %.2f expected", ("actual", "estimate")),
    "meeting": ("%s meeting, rate %.2f", ("kind", "rate")),
}


def payload_fields(payload: Column, fields: dict[str, str]) -> list[Column]:
    """Typed columns out of a JSON payload; what does not parse is null."""
    return [F.get_json_object(payload, f"$.{name}").try_cast(kind).alias(name) for name, kind in fields.items()]


def category_fields(payload: Column, category: str) -> list[Column]:
    """The fields of a category's payload."""
    return payload_fields(payload, PAYLOADS[category])


def headline(pattern: str, *columns: Column) -> Column:
    return F.format_string(pattern, *columns)


def category_headline(payload: Column, category: str) -> Column:
    """The one-line summary of a category's payload."""
    pattern, names = HEADLINES[category]
    kinds = PAYLOADS[category]
    return headline(pattern, *[F.get_json_object(payload, f"$.{n}").try_cast(kinds[n]) for n in names])


def meeting_date(text: Column, year: Column) -> Column:
    """``January 30-31`` of a year: the last day named, as a date."""
    month = F.regexp_extract(text, r"([A-Z][a-z]{2})[a-z]*", 1)
    day = F.element_at(F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1)), -1)
    return F.to_date(F.try_to_timestamp(F.concat_ws(" ", year.cast("string"), month, day), F.lit("yyyy MMM d")))


def meeting_time(text: Column, year: Column) -> Column:
    """14:00 in New York on the last day of a meeting, in UTC without zone."""
    return market_close_utc(meeting_date(text, year), hour=14)


def clean_columns(df: DataFrame) -> DataFrame:
    """Column names in lower case, with underscores for spaces, hard ones too."""
    return df.toDF(*[c.replace("\u00a0", " ").strip().lower().replace(" ", "_") for c in df.columns])


def statutory_tax(year: Column) -> Column:
    """The federal rate: 35 % through 2017, then 21 %."""
    return F.when(year <= 2017, 0.35).otherwise(0.21)
