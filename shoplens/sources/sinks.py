"""Report sinks.

Operators return DataFrames; these helpers render or store them without
bringing rows to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_json_lines(df: DataFrame) -> DataFrame:
    """One JSON object per row in a column ``value`` (NULL fields omitted)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def write_report(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> None:
    """Write a report to a shared location in any Spark-supported format.

    With ``partition_by``, overwriting replaces the partitions that ``df``
    holds and leaves the others as they are; without it, the whole folder.
    """
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.save(path)
