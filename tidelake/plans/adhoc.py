"""Ad-hoc SQL over files, tables and the registered views. Results stay lazy."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidelake.plans import file_functions
from tidelake.plans.views import VIEW_NAMES, Star, Views
from tidelake.sources import files


def query(spark: SparkSession, text: str, **parameters: object) -> DataFrame:
    """Any Spark SQL text; ``:name`` markers take ``parameters``. Files are tables too, see ``file_functions``."""
    return file_functions.query(spark, text, parameters)


def query_csv(spark: SparkSession, path: str, schema: str, where: str | None = None) -> DataFrame:
    return files.read_csv(spark, path, schema, where)


def query_parquet(spark: SparkSession, path: str, where: str | None = None, schema: str | None = None) -> DataFrame:
    """Parquet files or a partitioned tree; conditions on partition columns prune directories."""
    return files.read_parquet(spark, path, schema, where=where)


def publish_database(spark: SparkSession, database: str, frames: Mapping[str, DataFrame], root: str) -> None:
    """Store frames as tables ``database.name``, so that two-part names work in SQL."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, frame in frames.items():
        (frame.write.mode("overwrite").option("path", f"{root}/{database}/{name}").option("compression", "zstd")
         .saveAsTable(f"`{database}`.`{name}`"))


def publish_views(spark: SparkSession, star: Star, root: str) -> None:
    """Materialise every named view under its layer: gold, silver, market, macro, ref, master."""
    views = Views(star)
    layers: dict[str, dict[str, DataFrame]] = {}
    for name, attribute in VIEW_NAMES.items():
        layer, _, short = name.partition("_")
        layers.setdefault(layer, {})[short] = getattr(views, attribute)
    for layer, frames in layers.items():
        publish_database(spark, layer, frames, root)
