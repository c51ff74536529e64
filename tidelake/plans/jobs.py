"""Composed jobs: bronze to silver, merges gated by fingerprints, gold outputs, warehouse, catalog."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F
from py4j.protocol import Py4JJavaError

from tidelake.operators import aggregates, dedup, series
from tidelake.operators.quality import has_columns
from tidelake.plans.views import Star
from tidelake.session import checkpointed
from tidelake.sources import catalog, files, payloads, writers

STATE = "unit string, max_mtime bigint, total_size bigint, file_count bigint, done_at bigint"


# --- fingerprints ------------------------------------------------------------------

def is_unchanged(spark: SparkSession, state_path: str, unit: str, current: DataFrame) -> bool:
    """Whether the newest remembered fingerprint of a unit equals the current one."""
    remembered = catalog.existing(lambda: spark.read.schema(STATE).json(state_path))
    if remembered is None:
        return False
    newest = (remembered.where(F.col("unit") == unit)
              .agg(F.max_by(F.struct("max_mtime", "total_size", "file_count"), "done_at").alias("f")).select("f.*"))
    return newest.join(current, ["max_mtime", "total_size", "file_count"], "left_semi").count() == 1


def remember(state_path: str, unit: str, current: DataFrame) -> None:
    current.select(F.lit(unit).alias("unit"), "*", F.unix_micros(F.current_timestamp()).alias("done_at")).write.mode(
        "append").json(state_path)


def gated(spark: SparkSession, state_path: str, unit: str, inputs: str, work: Callable[[], None]) -> bool:
    """Run ``work`` unless the input files are the ones of the last run; True if it ran."""
    # taken before the work: files that arrive meanwhile count as changed next time
    current = fixed_row(spark, files.fingerprint(spark, inputs))
    if is_unchanged(spark, state_path, unit, current):
        return False
    work()
    remember(state_path, unit, current)
    return True


def fixed_row(spark: SparkSession, one_row: DataFrame) -> DataFrame:
    row = one_row.first()
    return spark.range(1).select(*[F.lit(row[c]).cast("bigint").alias(c) for c in one_row.columns])


# --- bronze to silver -----------------------------------------------------------------

def market_rows(spark: SparkSession, bronze: str | list[str], source_format: str = "ndjson") -> DataFrame:
    """Bronze bars as typed rows, all versions of them. NDJSON bars may spell the adjusted close either way and need no audit columns."""
    if source_format == "csv":
        audited = files.read_csv(spark, bronze, catalog.BAR)
    else:
        rows = files.read_json_lines(spark, bronze, catalog.BRONZE_BAR, name_glob="*.ndjson")
        audited = rows.select("symbol", F.col("date").try_cast("date").alias("date"), "epoch", "open", "high", "low",
                              "close", F.coalesce("adj_close", "adjClose").alias("adj_close"), "volume", "_ingest_ts")
    return audited.where(F.col("symbol").isNotNull() & F.col("date").isNotNull())  # see bronze_rejects


def latest_market(rows: DataFrame) -> DataFrame:
    return dedup.latest_bars(rows).drop("_ingest_ts").withColumn("year", F.year("date"))


def silver_bars(spark: SparkSession, bronze: str, source_format: str = "ndjson") -> DataFrame:
    """Bronze bars to typed, de-duplicated bars with their year."""
    return latest_market(market_rows(spark, bronze, source_format))


def merge_market(spark: SparkSession, bronze: str, silver: str, state_path: str,
                 source_format: str = "ndjson") -> bool:
    """Market merge: newest bars into ``silver``, partitioned by year, clustered by symbol."""
    def work() -> None:
        writers.write_partitioned(silver_bars(spark, bronze, source_format), silver, ["year"], ["symbol", "date"])
    return gated(spark, state_path, "market/ohlcv", bronze, work)


def silver_observations(spark: SparkSession, bronze: str, corrected_periods: bool = False,
                        distinguish_aggregates: bool = False, source_format: str = "ndjson") -> DataFrame:
    """Bronze points of all batches, or observations as CSV, to the newest observation per key."""
    return dedup.latest_observations(macro_rows(spark, bronze, corrected_periods, source_format), distinguish_aggregates)


def macro_rows(spark: SparkSession, bronze: str | list[str], corrected_periods: bool = False, source_format: str = "ndjson") -> DataFrame:
    """Bronze points, or observations as CSV, as typed rows, all versions of them."""
    if source_format == "csv":
        return files.read_csv(spark, bronze, catalog.OBSERVATION)
    points = files.read_json_lines(spark, bronze, catalog.POINT, name_glob="*.ndjson")
    return payloads.observations(points.where(F.col("indicator").isNotNull()), corrected_periods)


def merge_macro(spark: SparkSession, bronze: str, silver: str, state_path: str,
                source_format: str = "ndjson") -> bool:
    """Macro merge into ``silver``, partitioned by year, clustered by indicator and country."""
    def work() -> None:
        writers.write_partitioned(silver_observations(spark, bronze, source_format=source_format), silver, ["year"],
                                  ["indicator_id", "country_iso3", "date"])
    return gated(spark, state_path, "macro/observations", bronze, work)


def publish_observations(spark: SparkSession, bronze: str, root: str) -> str:
    """Bronze points to a published silver version, sorted within its files."""
    rows = silver_observations(spark, bronze)
    order = ["indicator_id", "country_iso3", "date"]
    return writers.publish(rows.repartitionByRange(*order).sortWithinPartitions(*order), root)


def bars_to_csv(spark: SparkSession, bronze: str, path: str) -> None:
    """Bronze bars to the CSV form of silver, prices at four digits."""
    rows = writers.with_fixed_prices(silver_bars(spark, bronze).drop("year"))
    writers.write_csv(rows, path)


def convert_csv(spark: SparkSession, tables: Mapping[str, tuple[str, str, str]], state_path: str) -> dict[str, bool]:
    """``name -> (csv path, schema, parquet path)``: convert the changed ones; names and whether they ran."""
    return {name: gated(spark, state_path, name, source,
                        lambda s=source, k=schema, t=target: writers.write_parquet(files.read_csv(spark, s, k), t))
            for name, (source, schema, target) in tables.items()}


def inventory_to_csv(spark: SparkSession, bronze: str, path: str) -> None:
    """Generic bronze to silver: one row per raw file."""
    writers.write_csv(files.file_inventory(spark, bronze), path)


# --- raw payloads to silver ------------------------------------------------------------------

REJECT = "source string, key string, reason string"


@dataclass(frozen=True)
class Feed:
    """How the raw files of one source become a silver table.

    ``rows`` maps ``(key, raw)`` payloads to typed rows; of rows with equal ``keys`` the first by ``newest`` stays. The kind names
    the payload's layout, by which unusable payloads are told.
    """
    kind: str
    key: str
    table: str
    rows: Callable[[DataFrame], DataFrame]
    keys: Sequence[str]
    newest: Sequence[str] = ()
    year_of: str | None = None


FEEDS: Mapping[str, Feed] = {
    "yahoo": Feed("chart", "symbol", "silver.market_ohlcv", payloads.chart_bars, ("symbol", "date"), ("epoch",), "date"),
    "binance": Feed("klines", "symbol", "silver.crypto_ohlcv", payloads.kline_bars, ("symbol", "date"), ("epoch",), "date"),
    "fred": Feed("series", "series", "silver.rates", payloads.series_observations, ("indicator_id", "date")),
    "sec": Feed("filings", "symbol", "silver.filings", payloads.filings, ("symbol", "accession_number")),
    "coinbase": Feed("spot", "symbol", "silver.spot_quotes", payloads.spot_quotes, ("base", "currency")),
    "tencent": Feed("quotes", "symbol", "silver.quotes", payloads.quote_lines, ("symbol",)),
    # sources that send the layouts of others, each with a silver table of its own
    **{source: Feed("chart", "symbol", f"silver.{source}_ohlcv", payloads.chart_bars, ("symbol", "date"), ("epoch",), "date")
       for source in catalog.CHART_SOURCES},
    **{source: Feed("quotes", "symbol", f"silver.{source}_quotes", payloads.quote_lines, ("symbol",)) for source in catalog.QUOTE_SOURCES},
}


def load_feed(spark: SparkSession, source: str, bronze: str, root: str) -> DataFrame:
    """Raw files of one source to its silver table; returns ``(source, key, reason)`` of the payloads that gave nothing.

    Rejects are kept below ``rejects/`` as well, one directory per source, replaced by each run.
    """
    feed = FEEDS[source]
    raw_files = files.read_payloads(spark, bronze)
    rows = feed.rows(raw_files.select(F.col("source_key").alias(feed.key), "raw"))
    latest = dedup.keep_latest(rows, list(feed.keys), [F.col(c).desc_nulls_last() for c in feed.newest])
    target = f"{root}/{catalog.TABLES[feed.table].path}"
    if feed.year_of:
        writers.write_partitioned(latest.withColumn("year", F.year(feed.year_of)), target, ["year"], list(feed.keys))
    else:
        writers.write_parquet(latest.repartitionByRange(*feed.keys).sortWithinPartitions(*feed.keys), target)
    kept = f"{root}/rejects/{source}"
    writers.write_parquet(payloads.rejects(raw_files, feed.kind, source), kept)
    return files.read_parquet(spark, kept, REJECT)


#: Fields of a yield-curve line that are read; the vendor's widest header has 15.
CURVE_FIELDS = 64


def wide_lines(raw_files: DataFrame) -> DataFrame:
    """Lines of CSV payloads, each by the header of its own file: ``(source_key, fields)``, a map from column name to text.

    Files may have different headers in any order. Blank lines are skipped, fields beyond the header have no name, missing ones are null.
    """
    names = [f"f{k}" for k in range(CURVE_FIELDS)]

    def parsed(rows: DataFrame, line: str, to: str) -> DataFrame:
        """Fields of a line as an array; parsed in a step of its own, once."""
        row = F.from_csv(line, ", ".join(f"{n} string" for n in names), {
            "escape": '"', "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"})
        return rows.withColumn("_row", row).withColumn(to, F.array(*[f"_row.{n}" for n in names])).drop("_row", line)

    lines = F.filter(F.split(F.regexp_replace("raw", "^\ufeff", ""), r"\r\n|\r|\n"), lambda x: F.trim(x) != "")
    heads = parsed(raw_files.select("source_key", lines.alias("lines")).withColumn("head", F.get("lines", F.lit(0))), "head", "names")
    split = parsed(heads.select("source_key", "names", F.explode(F.slice("lines", 2, F.greatest(F.size("lines"), F.lit(1)))).alias("line")),
                   "line", "values")
    pairs = F.filter(F.arrays_zip("names", "values"), lambda p: p["names"].isNotNull())
    return split.select("source_key", F.map_from_entries(F.transform(pairs, lambda p: F.struct(F.trim(p["names"]), p["values"]))).alias("fields"))


def load_yield_curve(spark: SparkSession, bronze: str, root: str) -> DataFrame:
    """Wide yield-curve CSV files to the silver table in the same form; returns the rows whose date is unreadable as rejects.

    Files may have any name. Every file is read by its own header, and the table has the columns of all headers, by name.
    """
    lines = checkpointed(wide_lines(files.read_payloads(spark, bronze)).withColumn("Date", F.col("fields")["Date"]))
    date = F.coalesce(*[F.try_to_date("Date", f) for f in ("MM/dd/yyyy", "yyyy-MM-dd")])
    headers = lines.select(F.explode(F.map_keys("fields")).alias("c")).where("c <> 'Date'").distinct()
    maturities = sorted((r["c"] for r in headers.collect()), key=_maturity)  # at most CURVE_FIELDS to a header
    typed = lines.where(date.isNotNull()).select(date.alias("Date"), *[F.col("fields")[c].try_cast("double").alias(c) for c in maturities])
    writers.write_parquet(typed, f"{root}/silver/yield_curve")
    kept = f"{root}/rejects/treasury"
    writers.write_parquet(lines.where(date.isNull()).select(
        F.lit("treasury").alias("source"), F.col("Date").alias("key"), F.lit("no date").alias("reason")), kept)
    return files.read_parquet(spark, kept, REJECT)


def _maturity(name: str) -> tuple[float, str]:
    """Months of a maturity such as '1.5 Mo' or '30 Yr', others last."""
    number, _, unit = name.partition(" ")
    try:
        return float(number) * {"Mo": 1, "Month": 1, "Yr": 12, "Year": 12}[unit], name
    except (ValueError, KeyError):
        return float("inf"), name


def bronze_rejects(spark: SparkSession, bronze: str, schema: str, source: str, date: str | None = "date") -> DataFrame:
    """``(source, key, reason)`` of bronze lines that a merge leaves out: torn lines, and dates that are none or missing."""
    rows = files.read_json_lines(spark, bronze, schema, name_glob="*.ndjson", keep_corrupt=True)
    torn = F.col(files.CORRUPT).isNotNull()
    bad = F.col(date).try_cast("date").isNull() if date else F.lit(False)
    return rows.where(torn | bad).select(F.lit(source).alias("source"), files.directory_key().alias("key"),
                                         F.when(torn, "torn line").otherwise("no date").alias("reason"))


# --- gold ---------------------------------------------------------------------------------

@dataclass(frozen=True)
class Output:
    """One gold output: its candidate inputs in order of preference and how to build it."""

    name: str
    inputs: Sequence[Callable[[], DataFrame]]
    build: Callable[[DataFrame], DataFrame]
    required: Sequence[str] = ()


def build_gold(spark: SparkSession, outputs: Sequence[Output], path: str) -> DataFrame:
    """Write every output as CSV; report ``(output, status, reason)``.

    The first readable input that has the required columns is used. A failing output is
    reported and does not stop the others.
    """
    report = []
    for output in outputs:
        source = _first_usable(output)
        if source is None:
            report.append((output.name, "skipped", "no input has " + ", ".join(output.required or ["data"])))
            continue
        try:
            writers.write_csv(output.build(source), f"{path}/{output.name}")
            report.append((output.name, "written", None))
        except (PySparkException, Py4JJavaError) as error:
            report.append((output.name, "failed", str(error).splitlines()[0]))
    return spark.createDataFrame(report, "output string, status string, reason string")


def _first_usable(output: Output) -> DataFrame | None:
    for candidate in output.inputs:
        frame = catalog.existing(candidate)
        if frame is not None and has_columns(frame, *output.required):
            return frame
    return None


def standard_outputs(inputs: Mapping[str, Sequence[Callable[[], DataFrame]]], indicator: str) -> list[Output]:
    """The gold outputs; ``inputs`` gives the candidates of each by name."""
    def by_date(column: str) -> Callable[[DataFrame], DataFrame]:
        return lambda frame: frame.orderBy(F.col(column).asc_nulls_last(),
                                           *[F.col(f"`{c}`") for c in frame.columns if c != column])

    builders: dict[str, tuple[Callable[[DataFrame], DataFrame], Sequence[str]]] = {
        "yahoo_summary": (aggregates.market_summary, ("symbol", "close", "high", "low", "volume")),
        "worldbank_yoy": (lambda frame: series.indicator_yoy(frame, indicator), ("indicator_id", "country_iso3", "date", "value")),
        "treasury_yield_curve": (by_date("Date"), ("Date",)),
        "fred_real_rates": (by_date("date"), ("date",)),
        "eia_oil_prices": (by_date("date"), ("date",)),
        "sec_filings": (lambda frame: frame, ("filing_date",)),
    }
    return [Output(name, inputs.get(name, ()), build, required) for name, (build, required) in builders.items()]


def gold_inputs(spark: SparkSession, root: str) -> dict[str, list[Callable[[], DataFrame]]]:
    """The inputs of the gold outputs at their registered places."""
    def at(name: str) -> Callable[[], DataFrame]:
        return lambda: catalog.read_table(spark, root, name)

    return {"yahoo_summary": [at("silver.market_ohlcv")], "worldbank_yoy": [at("silver.macro_observations")],
            "treasury_yield_curve": [lambda: spark.read.parquet(f"{root}/silver/yield_curve")],
            "fred_real_rates": [at("silver.rates")], "sec_filings": [at("silver.filings")]}


def load_warehouse(spark: SparkSession, root: str) -> Star:
    """The star schema from whatever silver tables there are; bars and observations must be."""
    from tidelake.plans import warehouse

    def optional(name: str) -> DataFrame | None:
        return catalog.existing(lambda: catalog.read_table(spark, root, name))

    bars, observations = (catalog.read_table(spark, root, n) for n in ("silver.market_ohlcv", "silver.macro_observations"))
    master = optional("silver.equity_master")
    star = warehouse.load_star(spark, warehouse.Silver(
        bars, observations, master, optional("silver.crypto_ohlcv"), optional("silver.rates"), optional("silver.filings")))
    if master is None:
        master = spark.createDataFrame([], catalog.EQUITY_MASTER)
    return Star({**star.tables, "silver_bars": lambda: bars, "equity_master": lambda: master})


def summarise_sources(spark: SparkSession, root: str, runs: str) -> DataFrame:
    """``(source, bronze_keys, silver_rows)`` of all known sources: run records against silver tables.

    The silver tables that exist are scanned as one union of tagged rows, not one by one.
    """
    tagged = []
    for source in catalog.SOURCES:
        name = {"yahoo": "silver.market_ohlcv", "worldbank": "silver.macro_observations"}.get(source, f"silver.{source}")
        rows = catalog.existing(lambda n=name: catalog.read_table(spark, root, n))
        if rows is not None:
            tagged.append(rows.select(F.lit(source).alias("source")))
    sources = spark.createDataFrame([(s,) for s in catalog.SOURCES], "source string")
    silver = aggregates.union_all(tagged) if tagged else sources.limit(0)
    return aggregates.source_summary(sources, writers.read_run_records(spark, runs), silver)


# --- warehouse and catalog ------------------------------------------------------------------

FACT_LAYOUT = {
    "fact_market_ohlcv": (["year"], ["instrument_id", "date"]),
    "fact_crypto_ohlcv": (["year"], ["instrument_id", "date"]),
    "fact_macro_obs": ([], ["indicator_id", "country_iso3", "date"]),
    "fact_rates_daily": ([], ["indicator_id", "date"]),
    "fact_filings": ([], ["instrument_id", "filing_date"]),
}


def store_star(star: Star, root: str) -> None:
    """Write all tables of a star schema; facts are clustered by their keys."""
    for name in star.tables:
        frame = star[name]
        partition_by, sort_by = FACT_LAYOUT.get(name, ([], []))
        if partition_by:
            writers.write_partitioned(frame, f"{root}/{name}", partition_by, sort_by)
        elif sort_by:
            writers.write_parquet(frame.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by), f"{root}/{name}")
        else:
            writers.write_parquet(frame, f"{root}/{name}")


def stored_star(spark: SparkSession, root: str, schemas: Mapping[str, str]) -> Star:
    """A star schema read back with explicit schemas."""
    return Star({name: (lambda n=name, s=schema: files.read_parquet(spark, f"{root}/{n}", s))
                 for name, schema in schemas.items()})


def schemas_of(star: Star) -> dict[str, str]:
    return {name: star[name].schema.simpleString()[len("struct<"):-1] for name in star.tables}


def export_catalog(spark: SparkSession, databases: Mapping[str, Mapping[str, DataFrame]], root: str,
                   path: str) -> DataFrame:
    """Catalog as JSON: ``databases`` with their locations and ``tables`` with their columns.

    Reads schemas only. Returns the tables: ``(database, name, location, columns)``.
    """
    described = [(database, name, f"{root}/{database}/{name}", [(column, kind) for _, _, column, kind in rows])
                 for database, tables in databases.items() for name, frame in tables.items()
                 for rows in [aggregates.schema_rows({name: frame})]]
    listed = spark.createDataFrame(
        described, "database string, name string, location string, columns array<struct<name: string, type: string>>")
    located = spark.createDataFrame([(d, f"{root}/{d}") for d in databases], "name string, location string")
    located.write.mode("overwrite").json(f"{path}/databases")
    listed.write.mode("overwrite").json(f"{path}/tables")
    return listed
