"""Writers. None of them funnels a table through one task or replaces more than it must."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tidelake.sources import raw

RUN_RECORD = "source string, last_run string, symbols bigint, indicators bigint, pages bigint, total bigint, lastupdated string"


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str],
                      replace_touched: bool = True) -> None:
    """Hive-partitioned Parquet, clustered and sorted by ``sort_by``.

    Range partitioning on partition *and* sort columns lets a large partition (a hot
    year or symbol) spread over many tasks, and gives every file tight statistics.
    ``replace_touched`` overwrites exactly the partitions present in ``df``.
    """
    order = [*partition_by, *[c for c in sort_by if c not in partition_by]]
    writer = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .write.partitionBy(*partition_by).option("compression", "zstd"))
    if replace_touched:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, sort_by: Sequence[str], buckets: int) -> None:
    """Table bucketed by ``key``: later windows, joins and aggregates on it need no exchange.

    Meant for facts with a bounded number of rows per key, such as daily bars. Rows are
    hashed to their bucket's task first, so every bucket is one file.
    """
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key, *sort_by)
     .option("path", path).option("compression", "zstd").saveAsTable(table))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV that other readers take as well: doubled quotes, NULL as an empty field, the empty text in quotes."""
    (df.write.mode(mode).option("header", True).option("escape", '"').option("nullValue", "").option("emptyValue", '""')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def _spread_by(df: DataFrame, key: str) -> DataFrame:
    """Rows of a key side by side, a large key over several tasks: few files per key and task."""
    return df.repartitionByRange(F.col(key), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))


def write_raw(payloads: DataFrame, path: str, key: str, text: str = "value", page: str | None = None,
              keep_history: bool = False) -> DataFrame:
    """Raw payloads, one file each, below ``key=<value>/``; see ``raw.write_payloads``.

    A key's earlier payloads are replaced, unless ``keep_history`` adds a directory with the time of the write.
    """
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f") if keep_history else None
    return raw.write_payloads(payloads, path, key, text, page, stamp)


def write_lines(lines: DataFrame, path: str, key: str, suffix: str = ".txt") -> None:
    """Lines of text per key; replaces the keys present in ``lines``. See ``raw.write_lines``."""
    raw.write_lines(lines, path, key, suffix)


def write_json_by_key(df: DataFrame, path: str, key: str) -> None:
    """Line-delimited JSON per key; replaces the keys present in ``df``."""
    (_spread_by(df, key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(key).json(path))


# --- publishing ---------------------------------------------------------------

def publish(df: DataFrame, root: str) -> str:
    """Write a new version below ``root`` and make it current once it is complete.

    Readers resolve the newest pointer record, so they see the old version or the new
    one, never part of either. Returns the version's path.
    """
    version = f"{root}/versions/{uuid.uuid4().hex}"
    write_parquet(df, version, mode="errorifexists")
    pointer = df.sparkSession.range(1).select(F.lit(version).alias("version"),
                                              F.unix_micros(F.current_timestamp()).alias("published_at"))
    pointer.write.mode("append").json(f"{root}/pointer")
    return version


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """The current version of a published table."""
    pointers = spark.read.schema("version string, published_at bigint").json(f"{root}/pointer")
    newest = pointers.agg(F.max_by("version", F.struct("published_at", "version"))).first()[0]
    return spark.read.parquet(newest)


# --- run records ----------------------------------------------------------------

def append_run_record(spark: SparkSession, path: str, source: str, last_run: str, **counts: object) -> None:
    """Remember a run of one source: when, how many symbols or indicators, how many pages."""
    values = {"symbols": None, "indicators": None, "pages": None, "total": None, "lastupdated": None, **counts}
    row = spark.range(1).select(
        F.lit(source).alias("source"), F.lit(last_run).alias("last_run"),
        *[F.lit(values[c]).cast("bigint").alias(c) for c in ("symbols", "indicators", "pages", "total")],
        F.lit(values["lastupdated"]).cast("string").alias("lastupdated"))
    row.write.mode("append").json(path)


def read_run_records(spark: SparkSession, path: str) -> DataFrame:
    """All run records; the key count is whichever of symbols and indicators was recorded."""
    return run_keys(spark.read.schema(RUN_RECORD).json(path))


def run_keys(records: DataFrame) -> DataFrame:
    return records.withColumn("keys", F.coalesce("symbols", "indicators"))


def latest_run(records: DataFrame) -> DataFrame:
    """Newest record per source."""
    rest = [c for c in records.columns if c not in ("source", "last_run")]
    newest = F.max(F.struct("last_run", *rest)).alias("r")
    return records.groupBy("source").agg(newest).select("source", "r.*")


# --- verified writes --------------------------------------------------------------

def write_counted(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write Parquet and return how many rows went through, without a second scan."""
    seen = Observation()
    write_parquet(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, mode)
    return seen.get["rows"]


def with_fixed_prices(bars: DataFrame, columns: Sequence[str] = ("open", "high", "low", "close", "adj_close"),
                      digits: int = 4) -> DataFrame:
    """Prices rounded the way the silver table stores them."""
    present = [c for c in columns if c in bars.columns]
    return bars.withColumns({c: F.round(F.col(c), digits) for c in present})


def total_order(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Globally sorted export."""
    return df.orderBy(*[F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in columns])


def with_audit(rows: DataFrame, source: str, batch_id: str, is_valid: Column | None = None) -> DataFrame:
    """Audit columns of a silver table: source, load time, batch and validity."""
    return rows.withColumns({
        "_source": F.lit(source), "_ingest_ts": F.current_timestamp(), "_batch_id": F.lit(batch_id),
        "_is_valid": F.lit(True) if is_valid is None else F.coalesce(is_valid, F.lit(False))})
