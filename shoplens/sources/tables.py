"""Catalog tables as sinks: partitioned and bucketed writes.

The same calls write tables of the session's own catalog and, in a session
with Hive support, of the metastore.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@contextmanager
def _overwriting(spark: SparkSession, mode: str):
    """The session's overwrite mode for the statements inside."""
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, mode)
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def write_table(
    df: DataFrame,
    table: str,
    partition_by: list[str] | None = None,
    keep_other_partitions: bool = False,
    bucket_by: str | None = None,
    buckets: int = 0,
    fmt: str = "parquet",
) -> None:
    """Write ``df`` as the catalog table ``table`` (``db.name``), created where it is missing.

    An existing table keeps its definition; its columns are filled by name.
    Its rows are replaced as a whole, or, with ``keep_other_partitions``, only
    the partitions that ``df`` has rows for.  ``partition_by``, ``bucket_by``
    and ``buckets`` are for a new table: with ``bucket_by`` every bucket is one
    sorted file (of each partition), so aggregates and joins on that column
    need no shuffle.
    """
    spark = df.sparkSession
    if bucket_by and buckets < 1:
        raise ValueError("a bucketed table needs a number of buckets")
    if spark.catalog.tableExists(table):
        columns = spark.table(table).columns
        missing = sorted(set(columns) - set(df.columns))
        if missing:
            raise ValueError(f"{table} has a column {missing[0]} that the rows lack")
        rows = df.select(*columns)
        layout = bucketing(spark, table)
        if layout:
            rows = rows.repartition(layout[1], layout[0])
        with _overwriting(spark, "dynamic" if keep_other_partitions else "static"):
            rows.write.insertInto(table, overwrite=True)
        return
    writer = (df.repartition(buckets, bucket_by) if bucket_by else df).write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(table)


def bucketing(spark: SparkSession, table: str) -> tuple[str, int] | None:
    """Bucket column and number of buckets of a catalog table (None: not bucketed by one column)."""
    keys = [c.name for c in spark.catalog.listColumns(table) if c.isBucket]
    if len(keys) != 1:
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(F.col("col_name") == "Num Buckets").first()
    return (keys[0], int(described["data_type"])) if described else None


def bucketed_alike(spark: SparkSession, key: str, *tables: str) -> bool:
    """Whether all tables are bucketed by ``key`` into the same number of buckets."""
    found = {bucketing(spark, t) for t in tables}
    return len(found) == 1 and None not in found and found.pop()[0] == key
