"""Plain readers: Parquet files, catalog tables and text logs.

All readers are lazy and hand Catalyst a scan it can prune and filter: no
schema inference over the data, no action.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shoplens.schemas import SEARCH_LOG, SOURCE_TABLES, conform


def read_parquet_table(
    spark: SparkSession, base_dir: str, name: str, schema: T.StructType | None = None
) -> DataFrame:
    """``<base_dir>/<name>.parquet`` (a file or a directory of parts).

    With ``schema`` (or a declared schema for a known table) nothing is read
    at planning time; otherwise Spark infers the schema from a footer.
    """
    schema = schema or SOURCE_TABLES.get(name)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


def read_catalog_table(
    spark: SparkSession, qualified_name: str, schema: T.StructType | None = None
) -> DataFrame:
    """A table known to the session catalog, e.g. ``shop.t_member``.

    With ``schema`` the table is narrowed to the declared columns and types.
    """
    df = spark.table(qualified_name)
    return conform(df, schema) if schema is not None else df


def read_text_log(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files as one string column ``value``.

    Splittable plain or compressed text; every line becomes one row, so the
    read parallelises over file splits like any other scan.
    """
    return conform(spark.read.text(path), SEARCH_LOG)
