"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Rows are dealt to blocks by a keyed hash of their id.  A matrix says how many
rows each block sends to each shard: drawn so that every assignment with the
exact shard sizes is equally likely (multivariate hypergeometric, block by
block).  Each block permutes its rows by keyed hash and sends consecutive runs
to the shards; each shard permutes what it received again, which gives the
slots.  Law: ``rows`` (shard sizes differ by one at most).

Defined results: NULL text has 0 bytes and the checksum of the empty text; a
NULL id is a row like any other; repeated rows are told apart by their rank
only; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ROW_BYTES = 16
NUMPY_POPULATION = 10**9  # numpy draws from populations below this


def communication_matrix(sizes: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows sent from each block to each shard, with exact shard totals."""
    total = sum(sizes)
    room = np.array([total // shards + (s < total % shards) for s in range(shards)], dtype=np.int64)
    rng = np.random.default_rng(seed)
    out = np.zeros((len(sizes), shards), dtype=np.int64)
    for b, n in enumerate(sizes):
        # one shard at a time, each a univariate draw
        left, population = n, int(room.sum())
        for s in range(shards):
            population -= int(room[s])
            got = _hypergeometric(rng, int(room[s]), population, left)
            out[b, s] = got
            left -= got
        room -= out[b]
    return out


def _hypergeometric(rng, good: int, bad: int, draws: int) -> int:
    """Good ones among ``draws`` of ``good + bad``, without a limit on the population."""
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    if good + bad < NUMPY_POPULATION:
        return int(rng.hypergeometric(good, bad, draws))
    # Inversion: weights relative to the mode follow from exact ratios of neighbours.  Twelve
    # standard deviations (and 60 more for the short tails of small means) leave out less than
    # a double's precision.
    population = good + bad
    mode = min(high, max(low, (draws + 1) * (good + 1) // (population + 2)))
    variance = draws * (good / population) * (bad / population) * ((population - draws) / (population - 1))
    reach = int(12 * variance**0.5) + 60
    up = np.arange(mode, min(high, mode + reach), dtype=np.float64)
    down = np.arange(mode, max(low, mode - reach), -1, dtype=np.float64)
    rise = (good - up) / (up + 1) * ((draws - up) / (bad - draws + up + 1))
    fall = down / (good - down + 1) * ((bad - draws + down) / (draws - down + 1))
    below = np.cumprod(fall)[::-1]
    weights = np.concatenate([below, [1.0], np.cumprod(rise)])
    ends = np.cumsum(weights)
    return mode - len(below) + int(np.searchsorted(ends, rng.random() * ends[-1], side="right").clip(0, len(ends) - 1))


def shard_documents(
    docs: DataFrame,
    shards: int = 40,
    seed: int = 7,
    rows_per_block: int = 50_000,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row.

    The driver holds one count per block and the matrix (blocks x shards).
    ``grown_shard`` is NULL: the law is ``rows``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    identity = [F.col("doc_id"), F.col("size"), F.col("text_crc32")]
    total = docs.count()
    blocks = max(1, -(-total // rows_per_block))
    # a second hash breaks ids that repeat; rows equal in all three are interchangeable
    rows = rows.withColumn("_block", F.pmod(F.xxhash64(F.lit(seed), *identity), F.lit(blocks)).cast("int"))
    counted = dict(
        (r["_block"], r["n"]) for r in rows.groupBy("_block").agg(F.count(F.lit(1)).alias("n")).collect()
    )
    matrix = communication_matrix([counted.get(b, 0) for b in range(blocks)], shards, seed)
    ends = np.cumsum(matrix, axis=1)

    first = Window.partitionBy("_block").orderBy(F.xxhash64(F.lit(seed + 1), *identity), *identity)
    table = docs.sparkSession.createDataFrame(
        [(b, [int(x) for x in ends[b]]) for b in range(blocks)], "_block int, ends array<long>"
    )
    sent = (
        rows.withColumn("_rank", F.row_number().over(first) - 1)
        .join(table, "_block")
        .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("_rank"))))
        .drop("ends")
    )
    # second permutation: order by a new key, cut into runs so that no task gets a whole shard
    parts = max(1, -(-total // (shards * rows_per_block)))
    sent = sent.withColumn("_key", F.xxhash64(F.lit(seed + 2), F.col("_rank"), F.col("_block"), *identity))
    sent = sent.withColumn(
        "_part", F.floor((F.col("_key") / 2.0**64 + 0.5) * parts).cast("int")
    ).withColumn("_part", F.least("_part", F.lit(parts - 1)))
    in_part = Window.partitionBy("shard", "_part").orderBy("_key", "_rank", "_block")
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    placed = sent.withColumn("_slot", F.row_number().over(in_part) - 1)
    if parts > 1:
        offsets = (
            sent.groupBy("shard", "_part")
            .agg(F.count(F.lit(1)).alias("n"))
            .select("shard", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
        )
        placed = placed.join(offsets, ["shard", "_part"]).withColumn("_slot", F.col("_slot") + F.col("_base"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("_slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
