"""File table functions in SQL text: ``read_csv('…')``, ``read_parquet('…')``, ``read_json('…')``, a quoted path after FROM or JOIN, ``* EXCLUDE``.

Each call becomes a temporary view over a lazy file scan, so filters and columns reach the scan as in any other table; all else in the
text is left to Spark's own parser. Only the calls are found here, past strings, quoted names and comments.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from tidelake.session import grouped_listing

TOKEN = re.compile(r"""--[^\n]*|/\*.*?\*/|'(?:[^'\\]|\\.|'')*'|"(?:[^"]|"")*"|`[^`]*`|[A-Za-z_]\w*|\d+(?:\.\d+)?|:=|=>|\s+|.""", re.DOTALL)
# Names of types that Spark spells otherwise, and of format codes
TYPES = {"VARCHAR": "string", "TEXT": "string", "INTEGER": "int", "INT4": "int", "INT8": "bigint", "HUGEINT": "decimal(38,0)",
         "REAL": "float", "BOOL": "boolean", "TIMESTAMP": "timestamp_ntz", "TIMESTAMPTZ": "timestamp", "BLOB": "binary"}
CODES = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%f": "SSSSSS", "%b": "MMM", "%y": "yy", "%p": "a", "%I": "hh"}


def spaced(token: str) -> bool:
    return token.isspace() or token.startswith(("--", "/*"))


class Arguments:
    """Reader of one call's arguments from tokens; ``at`` is the position after the opening bracket."""

    def __init__(self, tokens: list[str], at: int):
        self.tokens, self.at = tokens, at

    def peek(self) -> str:
        while self.at < len(self.tokens) and spaced(self.tokens[self.at]):
            self.at += 1
        if self.at == len(self.tokens):
            raise ValueError("a file function's bracket is not closed")
        return self.tokens[self.at]

    def take(self) -> str:
        token = self.peek()
        self.at += 1
        return token

    def series(self, end: str, item: Callable[[], None]) -> None:
        while self.peek() != end:
            item()
            if self.peek() == ",":
                self.take()
            elif self.peek() != end:
                raise ValueError(f"unexpected {self.peek()!r} in a file function")
        self.take()

    def value(self) -> object:
        token = self.take()
        if token[0] in "'\"":
            return token[1:-1].replace(token[0] * 2, token[0])
        if token == "[":
            out: list = []
            self.series("]", lambda: out.append(self.value()))
            return out
        if token == "{":
            named: dict = {}

            def entry() -> None:
                key = self.take().strip("'\"")
                if self.take() != ":":
                    raise ValueError("a struct needs a colon after each name")
                named[key] = self.value()
            self.series("}", entry)
            return named
        if token == "-":
            return -self.value()
        if token[0].isdigit():
            return float(token) if "." in token else int(token)
        known = {"true": True, "false": False, "null": None}
        if token.lower() not in known:
            raise ValueError(f"a file function takes constants, not {token!r}")
        return known[token.lower()]

    def all(self) -> tuple[list[object], dict[str, object]]:
        plain, named = [], {}

        def one() -> None:
            name = self.peek()
            start = self.at
            if re.match(r"[A-Za-z_]", name):
                self.take()
                if self.peek() in ("=", ":=", "=>"):
                    self.take()
                    named[name.lower()] = self.value()
                    return
                self.at = start
            plain.append(self.value())
        self.series(")", one)
        return plain, named


def located(reader: DataFrameReader, path: str) -> tuple[DataFrameReader, str]:
    """``**`` descends any number of directories: the part before it is searched for names like the last one."""
    if "**" not in path:
        return reader, path
    top, _, rest = path.partition("**")
    return reader.option("recursiveFileLookup", True).option("pathGlobFilter", rest.rsplit("/", 1)[-1] or "*"), top


def ddl(columns: Mapping[str, str]) -> str:
    return ", ".join(f"`{name}` {TYPES.get(kind.upper(), kind)}" for name, kind in columns.items())


def pattern(codes: str) -> str:
    return re.sub("%.", lambda m: CODES[m[0]], codes)


def first_lines(spark: SparkSession, path: str, number: int) -> list[str]:
    reader, at = located(spark.read, path)
    return [r[0] for r in reader.text(at).where("trim(value) <> ''").limit(number).collect()]


def has_header(spark: SparkSession, path: str, sep: str) -> bool:
    """Whether the first line is one of names: filled fields, none of which is a number, date or truth value."""
    lines = first_lines(spark, path, 1)
    fields = [f.strip().strip('"') for f in lines[0].split(sep)] if lines else []
    plain = re.compile(r"[-+]?[\d.]+([eE][-+]?\d+)?|\d{4}-\d\d-\d\d.*|true|false|", re.IGNORECASE)
    return bool(fields) and not any(plain.fullmatch(f) for f in fields)


def scan_csv(spark: SparkSession, path: str, options: dict) -> DataFrame:
    """CSV with types found in all rows, or in ``sample_size`` lines; with ``columns`` or ``all_varchar`` nothing is read beforehand."""
    sep = options.pop("delim", options.pop("sep", ","))
    header = options.pop("header", None)
    columns, names = options.pop("columns", None), options.pop("names", options.pop("column_names", None))
    lines = options.pop("sample_size", -1)
    as_text = options.pop("all_varchar", False)
    settings = {"sep": sep, "quote": options.pop("quote", '"'), "escape": options.pop("escape", '"'), "multiLine": True,
                "mode": "DROPMALFORMED" if options.pop("ignore_errors", False) else "FAILFAST",
                "nullValue": options.pop("nullstr", ""), "emptyValue": "", "preferDate": True}
    for name, to in (("dateformat", "dateFormat"), ("timestampformat", "timestampFormat"), ("compression", "compression"), ("encoding", "encoding")):
        if name in options:
            settings[to] = pattern(options.pop(name)) if name.endswith("format") else options.pop(name)
    settings["header"] = has_header(spark, path, sep) if header is None else header
    reader, at = located(spark.read.options(**settings), path)
    if columns:
        return reader.schema(ddl(columns)).option("enforceSchema", True).csv(at)
    if not as_text and lines >= 0:
        sample = spark.createDataFrame([(x,) for x in first_lines(spark, path, lines)], "value string")
        found = spark.read.options(**settings).option("inferSchema", True).csv(sample.rdd.map(lambda r: r[0])).schema
        rows = reader.schema(found).csv(at)
    else:
        rows = reader.option("inferSchema", not as_text).csv(at)
    return rows.toDF(*names, *rows.columns[len(names):]) if names else rows


def inferred(reader: DataFrameReader, texts: DataFrame) -> StructType:
    """Schema of JSON documents, one to a row, found as in files of them.

    Spark's own search over whole files packs them by size alone, and what it does for each grows with the number of files in its
    task: thousands of small files, in one or two tasks, take time with the square of their number.
    """
    strings = getattr(texts._jdf, "as")(texts.sparkSession._jvm.org.apache.spark.sql.Encoders.STRING())
    return StructType.fromJson(json.loads(reader._jreader.json(strings).schema().json()))


def scan_json(spark: SparkSession, path: str, options: dict) -> DataFrame:
    """JSON objects, one to a line or as documents or arrays of whole files; without ``format`` the first line tells which."""
    layout, columns = options.pop("format", "auto"), options.pop("columns", None)
    if layout == "auto":
        head = first_lines(spark, path, 1)
        try:
            layout = "newline_delimited" if head and isinstance(json.loads(head[0]), dict) else "array"
        except ValueError:
            layout = "array"
    whole = layout not in ("newline_delimited", "nd")
    mode = "DROPMALFORMED" if options.pop("ignore_errors", False) else "FAILFAST"
    reader, at = located(spark.read.options(multiLine=whole, mode=mode), path)
    if columns:
        return reader.schema(ddl(columns)).json(at)
    if whole:
        texts = located(spark.read, path)[0].text(at, wholetext=True)
        found = inferred(spark.read.options(multiLine=True, mode=mode), texts.select("value"))
        places = {f.name.lower(): f.dataType for f in texts.schema.fields[1:]}  # directories' names give the types of their columns
        fields = [StructField(f.name, places.get(f.name.lower(), f.dataType)) for f in found.fields]
        reader = reader.schema(StructType(fields)) if fields else reader
    return reader.json(at)


def scan_parquet(spark: SparkSession, path: str, options: dict) -> DataFrame:
    reader, at = located(spark.read.option("mergeSchema", options.get("union_by_name", False)), path)
    return reader.parquet(at)


SCANS: Mapping[str, Callable[[SparkSession, str, dict], DataFrame]] = {
    "read_csv": scan_csv, "read_csv_auto": scan_csv, "read_parquet": scan_parquet, "parquet_scan": scan_parquet,
    "read_json": scan_json, "read_json_auto": scan_json,
    "read_ndjson": lambda spark, path, options: scan_json(spark, path, {**options, "format": "newline_delimited"})}
BY_SUFFIX = {"csv": "read_csv", "tsv": "read_csv", "parquet": "read_parquet", "json": "read_json", "ndjson": "read_ndjson", "jsonl": "read_ndjson"}


def scanned(spark: SparkSession, function: str, plain: list[object], named: dict[str, object]) -> DataFrame:
    """The rows of one call; several paths are united, by name where asked for or where types must be found in each."""
    if len(plain) != 1 or not isinstance(plain[0], (str, list)) or not plain[0]:
        raise ValueError(f"{function} takes a path or a list of paths, then options by name")
    paths = [plain[0]] if isinstance(plain[0], str) else plain[0]
    options, parts = dict(named), []
    with_name, by_name = options.pop("filename", False), options.pop("union_by_name", False)
    options.pop("hive_partitioning", None)  # directories named key=value always are columns
    options.pop("auto_detect", None)
    for path in paths:
        own = {**options, "union_by_name": by_name}
        with grouped_listing(spark):
            rows = SCANS[function](spark, path, own)
        own.pop("union_by_name", None)
        if own:
            raise ValueError(f"{function} does not know {', '.join(own)}")
        parts.append(rows.withColumn("filename", F.col("_metadata.file_path")) if with_name else rows)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True) if by_name else a.union(b), parts)


def expanded(spark: SparkSession, text: str) -> tuple[str, dict[str, DataFrame]]:
    """The text with every call replaced by the name of a view, and the views by name; text without calls stays as it is."""
    tokens = TOKEN.findall(text)
    out: list[str] = []
    views: dict[str, DataFrame] = {}
    seen: dict[str, str] = {}

    def view(function: str, plain: list, named: dict) -> str:
        call = repr((function, plain, sorted(named.items(), key=lambda x: x[0])))
        if call not in seen:
            seen[call] = f"file_{uuid.uuid4().hex}"
            views[seen[call]] = scanned(spark, function, plain, named)
        return seen[call]

    def following(at: int) -> int:
        while at < len(tokens) and spaced(tokens[at]):
            at += 1
        return at

    at, last = 0, ""
    while at < len(tokens):
        token = tokens[at]
        after = following(at + 1)
        follows = tokens[after] if after < len(tokens) else ""
        if token.lower() in SCANS and follows == "(" and last != ".":
            arguments = Arguments(tokens, after + 1)
            out.append(view(token.lower(), *arguments.all()))
            at = arguments.at
        elif token[0] == "'" and last.upper() in ("FROM", "JOIN") and token[1:-1].rsplit(".", 1)[-1].lower() in BY_SUFFIX:
            path = token[1:-1].replace("''", "'")
            out.append(view(BY_SUFFIX[path.rsplit(".", 1)[-1].lower()], [path], {}))
            at += 1
        elif token.upper() == "EXCLUDE" and last == "*":
            out.append("EXCEPT")
            at += 1
            if follows != "(":  # one name without brackets
                out.append(f" ({follows})")
                at = after + 1
        else:
            out.append(token)
            at += 1
        if not spaced(token):
            last = token
    return "".join(out), views


def query(spark: SparkSession, text: str, parameters: Mapping[str, object] | None = None) -> DataFrame:
    """Spark SQL with file functions. The views last until the text is analysed; the result holds the scans itself."""
    sql, views = expanded(spark, text)
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    try:
        return spark.sql(sql, args=dict(parameters) if parameters else None)
    finally:
        for name in views:
            spark.catalog.dropTempView(name)


def schema_of(spark: SparkSession, text: str) -> StructType:
    """What DESCRIBE tells of a statement: its columns, without running it."""
    return query(spark, text).schema
