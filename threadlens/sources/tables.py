"""Readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


# Encodings the CSV reader takes without being asked to accept others.
NATIVE_ENCODINGS = ("iso-8859-1", "us-ascii", "utf-16", "utf-16be", "utf-16le", "utf-32", "utf-8")


def csv_header(spark: SparkSession, path: str, encoding: str = "utf-8") -> list[str]:
    """Column names of a CSV export, read from its first line."""
    return spark.read.option("header", True).option("escape", '"').option("encoding", encoding).csv(path).columns


def read_csv(
    spark: SparkSession, path: str, encoding: str = "utf-8", columns: list[str] | None = None, multi_line: bool = True
) -> DataFrame:
    """CSV export with every column as text; empty fields are null.

    Types are never inferred: that would read the data twice and guess.  With
    ``multi_line`` quoted fields may hold line breaks, and a file is one task;
    without it a large file is split, and a line break ends a row.
    """
    if encoding.lower() not in NATIVE_ENCODINGS and spark.conf.get("spark.sql.legacy.javaCharsets") != "true":
        raise ValueError(f"for {encoding} set spark.sql.legacy.javaCharsets to true in the session")
    names = columns or csv_header(spark, path, encoding)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("encoding", encoding)
        .csv(path)
    )


def read_table(spark: SparkSession, path: str, fmt: str, encoding: str = "utf-8") -> DataFrame:
    if fmt == "csv":
        return read_csv(spark, path, encoding)
    if fmt == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unknown input format: {fmt}")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", single_file: bool = False) -> None:
    """Overwrite a table.  ``single_file`` is for the published topic-grain tables only."""
    out = df.coalesce(1) if single_file else df
    if fmt == "parquet":
        out.write.mode("overwrite").parquet(path)
    elif fmt == "csv":
        out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    elif fmt == "json":
        out.write.mode("overwrite").json(path)
    else:
        raise ValueError(f"unknown output format: {fmt}")


def write_report(lines: DataFrame, path: str) -> None:
    """The ordered (section, rank, line) table as one UTF-8 text file."""
    ordered = lines.coalesce(1).sortWithinPartitions("section", "rank")
    ordered.select("line").write.mode("overwrite").text(path)
