"""Helpers shared by the operators: stored intermediates and distributed order."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.session import checkpoint_dir

MAX_LONG = 2**63 - 1


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for one intermediate table in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage with files that every executor can read, so a lost
    executor never forces the work before this point to run again.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def splitters(df: DataFrame, key: str, rows_per_bucket: int, most: int) -> list[int]:
    """Ascending cut points that split ``key`` into ranges of about so many rows, at most ``most`` ranges.

    One pass over ``key`` alone; the driver gets one number per range, so
    ``most`` must not grow with the rows.
    """
    total = df.count()
    n = min(-(-total // rows_per_bucket), most)
    if n < 2:
        return []
    at = [i / n for i in range(1, n)]
    cuts = df.agg(F.percentile_approx(key, at, max(10_000, 20 * n)).alias("c")).first()["c"]
    return sorted(set(cuts or []))


def bucket_of(key: Column, cuts: Sequence[int]) -> Column:
    """Number of cut points at or below ``key``, by binary search in a constant array."""
    if not cuts:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    table = F.lit(list(cuts))
    return F.aggregate(
        F.lit(steps),
        F.lit(0),
        lambda low, step: F.when(F.get(table, low + step - 1) <= key, low + step).otherwise(low),
    )


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, whatever ``body`` does with it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once, so tasks can import it anywhere."""
    sc = spark.sparkContext
    if getattr(sc, "_shoplens_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="shoplens-")) / "shoplens.zip"
    with zipfile.ZipFile(target, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._shoplens_shipped = True
