"""Readers for raw and typed files. Every typed reader takes an explicit schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidelake.session import grouped_listing
from tidelake.sources import raw

CORRUPT = "_corrupt_record"
Schema = StructType | str


def _struct(schema: Schema) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


#: Quotes inside a field are doubled and fields may hold line ends. An empty field is NULL, ``""`` is the empty text: the
#: parser marks the former by a text that no file holds.
CSV_DIALECT = {"quote": '"', "escape": '"', "emptyValue": "", "nullValue": "\ue000null\ue000", "ignoreLeadingWhiteSpace": False,
               "ignoreTrailingWhiteSpace": False}


def read_csv(spark: SparkSession, path: str | list[str], schema: Schema, where: str | Column | None = None,
             multi_line: bool = True) -> DataFrame:
    """CSV with a header line; ``where`` filters while parsing.

    A file is read by one task, since a line end may stand inside quotes. Where no field holds one, ``multi_line=False`` lets
    Spark split large files.
    """
    rows = (spark.read.schema(_struct(schema)).options(**CSV_DIALECT).option("header", True).option("enforceSchema", False)
            .option("multiLine", multi_line).csv(path))
    return rows if where is None else rows.where(where)


def read_json_lines(spark: SparkSession, path: str | list[str], schema: Schema,
                    name_glob: str | None = None, keep_corrupt: bool = False) -> DataFrame:
    """Line-delimited JSON. Blank lines are skipped and unknown fields ignored.

    With ``name_glob`` the tree below ``path`` is searched for files of that name and
    directory names are not parsed as partitions (``indicator=...`` directories would
    collide with an ``indicator`` field). ``keep_corrupt`` adds ``_corrupt_record``.
    """
    struct = _struct(schema)
    if keep_corrupt:
        struct = StructType(struct.fields).add(CORRUPT, "string")
    reader = spark.read.schema(struct).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if name_glob:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", name_glob)
    with grouped_listing(spark):
        return reader.json(path)


def read_json_documents(spark: SparkSession, path: str | list[str], schema: Schema) -> DataFrame:
    """Files that each hold one JSON array (or object) of records."""
    return spark.read.schema(_struct(schema)).option("multiLine", True).json(path)


def read_parquet(spark: SparkSession, path: str | list[str], schema: Schema | None = None,
                 base_path: str | None = None, where: str | Column | None = None) -> DataFrame:
    """Parquet, partitioned or not.

    Give a ``schema`` for partitioned tables with numeric-looking keys: inference would
    turn a symbol such as ``600000`` into an int.
    """
    reader = spark.read if schema is None else spark.read.schema(_struct(schema))
    if base_path:
        reader = reader.option("basePath", base_path)
    rows = reader.parquet(*([path] if isinstance(path, str) else path))
    return rows if where is None else rows.where(where)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Untyped raw lines in the column ``value``."""
    return spark.read.text(path)


def read_payloads(spark: SparkSession, path: str | list[str], name_glob: str = "*") -> DataFrame:
    """One row per raw file, whatever its name and its lines: ``(source_key, bronze_path, raw)`` with the whole text."""
    return raw.read_payloads(spark, path, name_glob)


def directory_key(path: Column | str = "_metadata.file_path", name: str | None = None) -> Column:
    """Key from the directory a file lies in: the value of ``name=`` or of its last ``x=`` part."""
    column = F.col(path) if isinstance(path, str) else path
    pattern = rf"/{name}=([^/]+)/" if name else r"/[^/=]+=([^/]+)/[^/]*$"
    # the path is a URI and partition directories are escaped once more inside it
    return F.regexp_extract(F.url_decode(F.url_decode(column)), pattern, 1)


def file_inventory(spark: SparkSession, path: str | list[str], name_glob: str = "*") -> DataFrame:
    """``(source_key, raw_len, bronze_path)`` per raw file; file contents are not read.

    Every payload name counts, and any ``x=`` prefix is stripped from the directory.
    """
    files = raw.list_files(spark, path, name_glob)
    return inventory(files.select(raw.key_of("path").alias("source_key"), F.col("length").alias("raw_len"),
                                  F.col("path").alias("bronze_path")))


def inventory(files: DataFrame) -> DataFrame:
    """Inventory row format: commas in the path would break its CSV form."""
    return files.select("source_key", "raw_len", F.regexp_replace("bronze_path", ",", "_").alias("bronze_path"))


def fingerprint(spark: SparkSession, paths: str | list[str], name_glob: str = "*") -> DataFrame:
    """One row ``(max_mtime, total_size, file_count)`` over all input files, from metadata only."""
    files = raw.list_files(spark, paths, name_glob)
    return files.agg(F.coalesce(F.max("modified_ms"), F.lit(0)).alias("max_mtime"),
                     F.coalesce(F.sum("length"), F.lit(0)).alias("total_size"),
                     F.count(F.lit(1)).alias("file_count"))
