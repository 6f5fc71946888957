"""Text exports read without guessing types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

CORRUPT = "_corrupt_record"


def read_csv_raw(
    spark: SparkSession, path: str, multiline: bool = False, **options: str
) -> DataFrame:
    """All columns as text, header row, quote doubled inside quotes, spaces kept.

    Files stay splittable. Quoted commas and CRLF line ends need no ``multiline``; only line
    breaks inside quoted values do, and they make each file one task.
    """
    settings = {
        "header": "true",
        "inferSchema": "false",
        "mode": "PERMISSIVE",
        "quote": '"',
        "escape": '"',
        "multiLine": str(multiline).lower(),
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        # Check the header of every file: by default the first one's order is put on all.
        "enforceSchema": "false",
        **options,
    }
    return spark.read.options(**settings).csv(path)


def read_json_raw(
    spark: SparkSession,
    path: str,
    multiline: bool = False,
    schema: str | StructType | None = None,
    **options: str,
) -> DataFrame:
    """JSON with every scalar as text.

    By default the input is JSON Lines and splittable. ``multiline`` reads one top-level array
    per file, which one task holds and parses. A given ``schema`` saves the inference pass, but
    hides a column that the feed has lost.
    """
    settings = {
        "multiLine": str(multiline).lower(),
        "mode": "PERMISSIVE",
        "primitivesAsString": "true",
        **options,
    }
    reader = spark.read.options(**settings)
    df = (reader.schema(schema) if schema is not None else reader).json(path)
    if df.columns == [CORRUPT]:
        # No line is JSON, as in an array over several lines: keep the lines, so that the feed
        # is found to have drifted and can be quarantined as it is.
        return spark.read.text(path).withColumnRenamed("value", CORRUPT)
    return df


def read_file(spark: SparkSession, path: str, file_format: str, **options) -> DataFrame:
    if file_format == "csv":
        return read_csv_raw(spark, path, **options)
    if file_format == "json":
        return read_json_raw(spark, path, **options)
    raise ValueError(f"unsupported format {file_format!r} for {path}")


def stringify_all(df: DataFrame) -> DataFrame:
    """Every column as text; structs, arrays and maps as JSON text."""
    nested = (StructType, ArrayType, MapType)
    columns = []
    for field in df.schema.fields:
        column = F.col("`" + field.name.replace("`", "``") + "`")
        text = F.to_json(column) if isinstance(field.dataType, nested) else column.cast("string")
        columns.append(text.alias(field.name))
    return df.select(*columns)


def describe_frame(df: DataFrame, limit: int = 5) -> dict:
    """Shape of a frame for a log line, from its schema alone: no job runs."""
    return {
        "columns": len(df.columns),
        "column_names": df.columns[:limit],
    }
