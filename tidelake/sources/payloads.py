"""Raw vendor payloads to typed rows. Each function maps a frame of payloads to a frame of rows.

Input frames carry one payload per row in ``raw``; documented key columns ride along.
Duplicated payloads (several keys answered by one document) can be dropped first with
``distinct_payloads``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidelake.functions import epoch_date, exchange_date, leading_number, period_type
from tidelake.operators.dedup import keep_latest
from tidelake.operators.joins import lookup

# Layouts of the payloads
CHART = """struct<chart: struct<result: array<struct<
    meta: struct<symbol: string>,
    timestamp: array<bigint>,
    indicators: struct<
        quote: array<struct<open: array<double>, high: array<double>, low: array<double>,
                            close: array<double>, volume: array<double>>>,
        adjclose: array<struct<adjclose: array<double>>>>>>>>"""
PAGE = "struct<page: int, pages: int, per_page: int, total: bigint, sourceid: string, lastupdated: string>"
POINTS = """array<struct<indicator: struct<id: string, value: string>, country: struct<id: string, value: string>,
    countryiso3code: string, date: string, value: double, unit: string, obs_status: string, `decimal`: string>>"""
INDICATORS = """array<struct<id: string, name: string, unit: string, source: struct<id: string, value: string>,
    sourceNote: string, sourceOrganization: string, topics: array<struct<id: string, value: string>>>>"""
SERIES = "struct<observations: array<struct<date: string, value: string>>>"
FILINGS = """struct<cik: string, name: string, tickers: array<string>, filings: struct<recent: struct<
    accessionNumber: array<string>, filingDate: array<string>, form: array<string>,
    primaryDocument: array<string>>>>"""
SPOT = "struct<data: struct<amount: string, base: string, currency: string>>"
QUOTE_LINE = r'(?:v_|hq_str_)([A-Za-z0-9_.]+)="([^"]*)"'
FILING_ARCHIVE = "https://www.sec.gov/Archives/edgar/data"


def distinct_payloads(payloads: DataFrame) -> DataFrame:
    """One of several equal payloads, whatever keys they were fetched for.

    Compared by a 256-bit digest, so that the shuffle key stays small for large documents.
    """
    digest = F.sha2(F.col("raw"), 256)
    return keep_latest(payloads.withColumn("_digest", digest), ["_digest"],
                       [F.col(c).asc_nulls_last() for c in payloads.columns if c != "raw"],
                       payload_tie_break=False).drop("_digest")


# --- price bars ---------------------------------------------------------------

def _chart(payloads: DataFrame) -> DataFrame:
    return payloads.withColumn("_result", F.from_json("raw", CHART)["chart"]["result"])


def chart_bars(payloads: DataFrame, missing_as_nan: bool = False) -> DataFrame:
    """``(symbol, raw)`` chart documents to daily bars.

    The arrays are zipped by position and dates are local to the exchange. A missing
    adjusted close falls back to the close, a missing volume to 0; a bar without open
    and close is dropped. Missing prices stay NULL unless ``missing_as_nan``.
    """
    result = F.get("_result", F.lit(0))
    quote = F.get(result["indicators"]["quote"], F.lit(0))
    series = F.arrays_zip(
        result["timestamp"].alias("epoch"), quote["open"].alias("open"), quote["high"].alias("high"),
        quote["low"].alias("low"), quote["close"].alias("close"), quote["volume"].alias("volume"),
        F.coalesce(F.get(result["indicators"]["adjclose"], F.lit(0))["adjclose"],
                   F.array().cast("array<double>")).alias("adj_close"))
    requested = F.col("symbol") if "symbol" in payloads.columns else result["meta"]["symbol"]
    bars = (_chart(payloads).select(requested.alias("symbol"), F.explode(series).alias("bar"))
            .where("bar.epoch IS NOT NULL AND (bar.open IS NOT NULL OR bar.close IS NOT NULL)"))
    missing = F.lit(float("nan") if missing_as_nan else None).cast("double")
    prices = {c: F.coalesce(F.col(f"bar.{c}"), missing).alias(c) for c in ("open", "high", "low", "close")}
    return bars.select(
        "symbol", exchange_date("bar.epoch").alias("date"), F.col("bar.epoch").alias("epoch"), *prices.values(),
        F.coalesce("bar.adj_close", "bar.close", missing).alias("adj_close"),
        F.coalesce(F.col("bar.volume").try_cast("bigint"), F.lit(0)).alias("volume"))


def chart_rejects(payloads: DataFrame) -> DataFrame:
    """Chart payloads without any result; a download of these counts as failed."""
    return _chart(payloads).where(F.coalesce(F.size("_result"), F.lit(0)) <= 0).drop("_result")


def kline_bars(payloads: DataFrame) -> DataFrame:
    """``(symbol, raw)`` kline arrays to crypto bars; numbers arrive as strings."""
    def number(position: int, kind: str = "double") -> Column:
        return F.get("k", F.lit(position)).try_cast(kind)

    lines = payloads.select("symbol", F.explode(F.from_json("raw", "array<array<string>>")).alias("k"))
    opened = number(0, "bigint")
    return lines.where(opened.isNotNull()).select(
        "symbol", epoch_date(opened / 1000).alias("date"), opened.alias("epoch"), number(1).alias("open"), number(2).alias("high"), number(3).alias("low"),
        number(4).alias("close"), number(5).alias("volume"), number(7).alias("quote_volume"),
        number(8, "bigint").alias("trades"))


# --- macro pages ----------------------------------------------------------------

def _page(raw: str = "raw") -> Column:
    """Description of a page, the first element of ``[page description, records]``; what follows it is not read."""
    return F.from_json(F.get_json_object(raw, "$[0]"), PAGE)


def _records(raw: str, schema: str) -> Column:
    """Records of a page, its second element, from one parse; NULL where the text is no such array."""
    return F.try_variant_get(F.try_parse_json(raw), "$[1]", schema)


def observation_points(payloads: DataFrame) -> DataFrame:
    """``(batch, raw)`` result pages to points carrying ``_lastupdated`` and ``_sourceid``.

    All points of a batch carry the stamp of its first page. A page without records
    gives no rows. Pages are parsed where they are read; only their records meet the stamps, of which there is one
    per batch. One batch may hold a large part of all pages, see ``lookup``.
    """
    stamps = keep_latest(
        payloads.select("batch", _page().alias("_page")).select(
            "batch", "_page.page", F.col("_page.lastupdated").alias("_lastupdated"), F.col("_page.sourceid").alias("_sourceid")),
        ["batch"], [F.col("page").asc_nulls_last()]).drop("page")
    parsed = payloads.select("batch", _records("raw", POINTS).alias("_records")).where(F.size("_records") > 0)
    stamped = lookup(parsed, stamps, "batch")
    return stamped.select("batch", F.explode("_records").alias("p"), "_lastupdated", "_sourceid").select(
        "batch", "p.*", "_lastupdated", "_sourceid")


def page_metadata(payloads: DataFrame) -> DataFrame:
    """Run bookkeeping per batch: ``(batch, pages, total, lastupdated)`` of the first page."""
    pages = payloads.select("batch", _page().alias("_page")).select("batch", "_page.*")
    return keep_latest(pages, ["batch"], [F.col("page").asc_nulls_last()]).select(
        "batch", "pages", "total", "lastupdated")


def observations(points: DataFrame, corrected_periods: bool = False) -> DataFrame:
    """Points, as stored line by line in bronze, to the 14 silver columns."""
    return points.select(
        F.col("indicator.id").alias("indicator_id"), F.col("indicator.value").alias("indicator_name"),
        F.col("country.id").alias("country_id"), F.col("country.value").alias("country_name"),
        F.col("countryiso3code").alias("country_iso3"), "date", leading_number("date").alias("year"),
        period_type("date", corrected_periods).alias("period_type"), "value", "unit", "obs_status",
        F.col("decimal").cast("string").alias("decimal"), F.col("_sourceid").alias("source_id"),
        F.col("_lastupdated").alias("lastupdated"))


def indicator_list(payloads: DataFrame) -> DataFrame:
    """``raw`` indicator pages to indicator descriptions."""
    records = payloads.select(F.explode(_records("raw", INDICATORS)).alias("i"))
    return records.where("i.id IS NOT NULL").select(
        F.col("i.id").alias("indicator_id"), F.col("i.name").alias("indicator_name"), F.col("i.unit").alias("unit"),
        F.col("i.source.id").alias("source_id"), F.col("i.source.value").alias("source_name"),
        F.col("i.sourceNote").alias("source_note"), F.col("i.sourceOrganization").alias("source_organization"),
        F.col("i.topics").alias("topics"))


def indicator_topics(indicators: DataFrame) -> DataFrame:
    """Bridge of indicators and topics; an indicator without topics keeps one row."""
    return indicators.select("indicator_id", F.explode_outer("topics").alias("t")).select(
        "indicator_id", F.col("t.id").alias("topic_id"), F.trim("t.value").alias("topic_name"))


# --- rates ------------------------------------------------------------------------

def yield_curve_rates(wide: DataFrame, date_column: str = "Date", formats: Sequence[str] = ("MM/dd/yyyy", "yyyy-MM-dd")) -> DataFrame:
    """Wide table, one column per maturity, to ``(indicator_id, date, value)``."""
    maturities = [c for c in wide.columns if c != date_column]
    kind = dict(wide.dtypes)[date_column]
    date = (F.col(date_column) if kind == "date"
            else F.coalesce(*[F.try_to_date(date_column, f) for f in formats]))
    numbers = wide.select(date.alias("date"), *[F.col(f"`{c}`").try_cast("double").alias(c) for c in maturities])
    return numbers.unpivot(["date"], maturities, "indicator_id", "value").where("value IS NOT NULL").select(
        "indicator_id", "date", "value")


def series_observations(payloads: DataFrame) -> DataFrame:
    """``(series, raw)`` observation documents to rates; the marker ``.`` means no value."""
    records = payloads.select("series", F.explode(F.from_json("raw", SERIES)["observations"]).alias("o"))
    return records.select(F.col("series").alias("indicator_id"), F.col("o.date").try_cast("date").alias("date"),
                          F.col("o.value").try_cast("double").alias("value"))


# --- filings, quotes ----------------------------------------------------------------

def filings(payloads: DataFrame) -> DataFrame:
    """``(symbol, raw)`` submission documents to one row per filing."""
    parsed = payloads.select("symbol", F.from_json("raw", FILINGS).alias("s"))
    recent = F.col("s.filings.recent")
    rows = parsed.select("symbol", F.col("s.name").alias("entity_name"), F.col("s.cik").alias("cik"), F.explode(
        F.arrays_zip(recent["accessionNumber"].alias("accession_number"), recent["filingDate"].alias("filing_date"),
                     recent["form"].alias("form_type"), recent["primaryDocument"].alias("document"))).alias("f"))
    folder = F.concat_ws("/", F.lit(FILING_ARCHIVE), F.regexp_replace("cik", "^0+", ""),
                         F.regexp_replace("f.accession_number", "-", ""))
    return rows.where("f.accession_number IS NOT NULL").select(
        "symbol", "f.accession_number", F.col("f.filing_date").try_cast("date").alias("filing_date"),
        "f.form_type", "entity_name", F.concat_ws("/", folder, F.col("f.document")).alias("url"))


def spot_quotes(payloads: DataFrame) -> DataFrame:
    """``raw`` spot documents to ``(base, currency, amount)``."""
    quote = F.from_json("raw", SPOT)["data"]
    return payloads.select(quote["base"].alias("base"), quote["currency"].alias("currency"),
                           quote["amount"].try_cast("decimal(38,18)").alias("amount")).where("base IS NOT NULL")


def quote_lines(payloads: DataFrame) -> DataFrame:
    """``raw`` quote statements ``v_x="a~b"`` or ``var hq_str_x="a,b"`` to ``(symbol, fields)``."""
    def parts(group: int) -> Column:
        return F.regexp_extract_all("raw", F.lit(QUOTE_LINE), F.lit(group))

    pairs = payloads.select(F.explode(F.arrays_zip(parts(1).alias("symbol"), parts(2).alias("body"))).alias("q"))
    body = F.col("q.body")
    separator = F.when(body.contains("~"), "~").otherwise(",")
    return pairs.select("q.symbol", F.split(body, separator).alias("fields"))


# --- accepted and rejected payloads ----------------------------------------------------

def record_count(kind: str) -> Column:
    """How many records a payload of a kind holds; NULL where its text is no such document."""
    def size(schema: str, part) -> Column:
        document = F.from_json("raw", schema, {"mode": "PERMISSIVE"})
        return F.when(part(document).isNotNull(), F.size(part(document)))

    readable = F.try_parse_json("raw").isNotNull()
    counts = {
        "chart": lambda: F.when(readable, F.coalesce(size(CHART, lambda d: F.get(d["chart"]["result"], F.lit(0))["timestamp"]), F.lit(0))),
        "klines": lambda: F.when(readable, F.coalesce(size("array<array<string>>", lambda d: d), F.lit(0))),
        "page": lambda: F.when(readable, F.coalesce(F.size(_records("raw", POINTS)), F.lit(0))),
        "indicators": lambda: F.when(readable, F.coalesce(F.size(_records("raw", INDICATORS)), F.lit(0))),
        "series": lambda: F.when(readable, F.coalesce(size(SERIES, lambda d: d["observations"]), F.lit(0))),
        "filings": lambda: F.when(readable, F.coalesce(size(FILINGS, lambda d: d["filings"]["recent"]["accessionNumber"]), F.lit(0))),
        "spot": lambda: F.when(readable, F.when(F.from_json("raw", SPOT)["data"]["base"].isNotNull(), 1).otherwise(0)),
        "quotes": lambda: F.size(F.regexp_extract_all("raw", F.lit(QUOTE_LINE), F.lit(1))),
    }
    return counts[kind]()


def rejects(payloads: DataFrame, kind: str, source: str, key: str = "source_key") -> DataFrame:
    """``(source, key, reason)`` of the payloads of a kind that give no rows: unreadable ones and those without records."""
    counted = payloads.select(F.col(key).cast("string").alias("key"), record_count(kind).alias("n")).where("coalesce(n, 0) <= 0")
    return counted.select(F.lit(source).alias("source"), "key",
                          F.when(F.col("n").isNull(), "unreadable").otherwise("no records").alias("reason"))
