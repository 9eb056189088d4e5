"""Exact sets of ids as bitmaps: counted without a shuffle of ids, merged by OR.

An id lies in a bucket of 32,768 ids and has one bit in that bucket's bitmap
of 4 KB.  Bitmaps of disjoint rows merge with OR, so sets kept by day answer
the distinct count of any span of days exactly.  Any long is an id, also
negative ones; a row without an id has a NULL bucket and counts nothing, so
SQL's two views of NULL stay apart: ``count(DISTINCT)`` leaves it out, a
DISTINCT list keeps one NULL.

A bitmap pays where ids are dense (member numbers).  For scattered ids nearly
every id has a bucket of its own; the empty bytes then compress, but a plain
distinct is better.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "bucket", "bits"
BUCKET_IDS = 32_768


def id_bitmaps(rows: DataFrame, id_col: str, *keys: Column | str) -> DataFrame:
    """One bitmap per key and bucket of the ids in ``id_col``."""
    return rows.groupBy(*keys, F.bitmap_bucket_number(id_col).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias(BITS)
    )


def merge_bitmaps(bitmaps: DataFrame, *keys: Column | str) -> DataFrame:
    """Union of the sets, per key."""
    return bitmaps.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def count_ids(bitmaps: DataFrame, out: str, *keys: Column | str) -> DataFrame:
    """Distinct ids per key, of sets that may overlap."""
    return merge_bitmaps(bitmaps, *keys).groupBy(*keys).agg(
        F.coalesce(F.sum(F.bitmap_count(BITS)), F.lit(0)).cast("bigint").alias(out)
    )


def list_ids(bitmaps: DataFrame, out: str) -> DataFrame:
    """The distinct ids of all sets, with one NULL where a row had none."""
    merged = merge_bitmaps(bitmaps)
    # bytes that hold a bit, then their bits; a NULL bucket has one byte too, without a number
    text = merged.select(BUCKET, F.hex(BITS).alias("hex"))
    byte = text.select(
        BUCKET, "hex", F.explode(F.sequence(F.lit(0), F.when(F.col(BUCKET).isNull(), 0).otherwise(BUCKET_IDS // 8 - 1))).alias("at")
    ).select(BUCKET, "at", F.expr("substring(hex, 2 * at + 1, 2)").alias("pair"))
    value = byte.filter((F.col("pair") != "00") | F.col(BUCKET).isNull()).select(
        BUCKET, "at", F.conv("pair", 16, 10).cast("int").alias("value")
    )
    bit = value.select(BUCKET, "at", "value", F.explode(F.expr(f"sequence(0, if({BUCKET} IS NULL, 0, 7))")).alias("bit"))
    bit = bit.filter(F.expr(f"(shiftright(value, bit) & 1) = 1 OR {BUCKET} IS NULL"))
    place = F.expr("CAST(8 * at + bit AS BIGINT)")
    # buckets from 1 on hold positive ids, the others zero and the negative ones
    number = F.when(F.col(BUCKET) > 0, (F.col(BUCKET) - 1) * BUCKET_IDS + place + 1).otherwise(F.col(BUCKET) * BUCKET_IDS - place)
    return bit.select(number.alias(out))
