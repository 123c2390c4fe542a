"""CSV scan of raw readings, header check, and first-N sample.

Every raw column is read as text (no inference): parsing is the transform's job, so the result
never depends on how a batch happened to be cut (a column that is all numbers in one chunk and
mixed in another is parsed the same way in both).

Header handling: the header of a file is read first and checked against ``REQUIRED_COLUMNS``
(order free, extra columns allowed). The read schema is then built in *that file's* order with
``enforceSchema=false``, so Spark checks each file's header by name; columns are selected by name
afterwards. Files of several orders are read by one scan for each order (``read_files``). A fixed schema with the default ``enforceSchema=true`` would bind columns by position
and silently swap two reordered columns, so it is never used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from envtrack import schema as S
from envtrack.sources.storage import first_line


class MissingColumnsError(ValueError):
    """The CSV header lacks required columns."""


def require_header(header: Sequence[str], path: str) -> list[str]:
    """The header's columns, in their order, if none of the nine is absent."""
    absent = set(S.REQUIRED_COLUMNS).difference(header)
    if absent:
        raise MissingColumnsError(f"{path}: the header lacks {', '.join(sorted(absent))}")
    return list(header)


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of one CSV file's header line; none for an empty file."""
    import csv as _csv

    line = first_line(spark, path)
    return [] if line is None else [name.strip() for name in next(_csv.reader([line]), [])]


def by_header(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """S2 for several files: the files of each column order; a header without a required column is refused.

    One line is read from each file; the caller bounds their number (the files of one batch).
    """
    found: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        header = header_of(spark, path)
        if header:  # an empty file has no rows either
            found.setdefault(tuple(require_header(header, path)), []).append(path)
    return found


def literal_path(path: str) -> str:
    """A path as Spark's readers take it when they must not look for patterns in it."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)


def read_files(spark: SparkSession, paths: Sequence[str], multi_line: bool = False) -> DataFrame | None:
    """Raw readings of files whatever the order of their columns: one scan for each order, united by name.

    ``_file`` has each row's file. None if all files are empty.
    """
    out = None
    for columns, same in by_header(spark, paths).items():
        scan = spark.read.options(**csv_options(multi_line)).schema(text_schema(columns)).csv([literal_path(p) for p in same])
        rows = scan.select(*S.REQUIRED_COLUMNS, F.col("_metadata.file_path").alias("_file"))
        out = rows if out is None else out.unionByName(rows)
    return out


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def csv_options(multi_line: bool = False) -> dict[str, str]:
    """Quoted cells, with the quote doubled inside them.

    With ``multi_line`` a quoted cell may hold line breaks, and a file is read by one task; without it
    files are split, and ``unclosed_quotes`` counts the lines that would need it.
    recursiveFileLookup: every reader sees the same files as the manifest listing, at any depth.
    """
    return {"header": "true", "enforceSchema": "false", "mode": "PERMISSIVE", "multiLine": str(multi_line).lower(),
            "quote": '"', "escape": '"', "recursiveFileLookup": "true"}


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Raw readings of one CSV file as nine string columns, with their place in the file."""
    columns = require_header(header_of(spark, path), path)
    return spark.read.options(**csv_options(multi_line)).schema(text_schema(columns)).csv(path)


def unclosed_quotes(spark: SparkSession, source: str, pattern: str = "*.csv") -> DataFrame:
    """(path, lines): files with lines of an odd number of quotes, which only ``multi_line`` reads right."""
    lines = (spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(source)
             .select("value", F.col("_metadata.file_path").alias("path")))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.where(quotes % 2 == 1).groupBy("path").agg(F.count("*").alias("lines"))


def sample_head(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in source order (``n >= 1``); plans as a top-k, not a full sort."""
    if n < 1:
        raise ValueError("sample size must be >= 1")
    return df.orderBy(*order).limit(n).select(*S.REQUIRED_COLUMNS)


def sample_csv(spark: SparkSession, path: str, n: int, dest: str) -> None:
    """The first ``n`` rows of a CSV file, in file order, as one CSV file with a header.

    A top-k on the place in the file: each task keeps at most ``n`` rows, and ``n`` rows are written.
    """
    rows = with_file_order(read_raw_csv(spark, path))
    head = sample_head(rows, n, ["_block", "_scan_seq"])
    head.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(dest)


def with_file_order(df: DataFrame) -> DataFrame:
    """Attach the provenance needed for file-order positions right at the scan."""
    return df.select("*", F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_scan_seq"))
