"""Packing documents into sequences of a fixed number of tokens, few as can be.

Linear grouping: lengths above a share of the capacity are sorted, cut into
groups of equal count and rounded up to the largest of their group; with so
few sizes left the configurations of a sequence are optimised (column
generation on the configuration program); the real documents then take the
places of their group, and the short ones are put best-fit into what is left.

Token lengths are whole numbers up to the capacity, so the plan needs only
their histogram: the driver sees at most ``capacity`` counts, however many
documents there are.  Spark ranks the documents of each length (per hash
block, with running sums over blocks) and joins each rank with the plan.

Defined results: NULL text is the empty text (only the end id); a document of
more than ``capacity`` ids is cut into full pieces, the first piece being the
rest; repeated rows are packed once each, rows without an id like any other;
documents of one length take their places by hash block, id and content; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoplens.llm.common import ship_package, stored
from shoplens.llm.tokens import ID_BYTES, packed, word_cache

# ---------------------------------------------------------------- the plan


def group_sizes(counts: dict[int, int], groups: int) -> list[tuple[int, list[int]]]:
    """Cut lengths, longest first, into groups of about equal count: (largest, lengths)."""
    total = sum(counts.values())
    share, out, held = max(1, -(-total // groups)), [], 0
    for length in sorted(counts, reverse=True):
        if not out or held >= share:
            out.append((length, []))
            held = 0
        out[-1][1].append(length)
        held += counts[length]
    return out


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 400):
    """Configurations (copies of each size) and how often to use each, a relaxed optimum.

    Column generation: the restricted program is solved with dense simplex
    steps, the next configuration is the best knapsack under its prices.
    """
    n = len(sizes)
    basis = np.zeros((n, n))
    for i, s in enumerate(sizes):
        basis[i, i] = capacity // s
    inverse = np.linalg.inv(basis)
    use = inverse @ np.array(demand, dtype=float)
    for _ in range(rounds):
        prices = np.ones(n) @ inverse
        column, worth = _best_fill(sizes, prices, capacity)
        if worth <= 1 + 1e-9:
            break
        step = inverse @ column
        up = step > 1e-9
        ratio = np.where(up, use / np.where(up, step, 1), np.inf)
        out = int(np.argmin(ratio))
        basis[:, out] = column
        inverse = np.linalg.inv(basis)
        use = inverse @ np.array(demand, dtype=float)
    return [(basis[:, j].astype(int), max(0.0, use[j])) for j in range(n)]


def _best_fill(sizes: list[int], prices: np.ndarray, capacity: int):
    """The dearest multiset of sizes within the capacity (unbounded knapsack)."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = [i for i in range(len(sizes)) if prices[i] > 0]
    small = np.array([sizes[i] for i in order])
    value = np.array([prices[i] for i in order])
    for c in range(1, capacity + 1):
        best[c], choice[c] = best[c - 1], -1
        fit = small <= c
        if fit.any():
            got = np.where(fit, value + best[np.maximum(c - small, 0)], -1)
            k = int(np.argmax(got))
            if got[k] > best[c] + 1e-12:
                best[c], choice[c] = got[k], order[k]
    column, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            column[choice[c]] += 1
            c -= sizes[choice[c]]
    return column, best[capacity]


def plan_packing(
    histogram: dict[int, int], capacity: int, groups: int = 24, large_share: float = 0.125
) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (lengths, how many alike), from counts of lengths below the capacity.

    The work depends on ``capacity`` and ``groups`` alone: each step uses up a
    length or a class of equal sequences, whatever the counts are.
    """
    left = {k: n for k, n in histogram.items() if n > 0}
    large = {k: n for k, n in left.items() if k > large_share * capacity}
    open_bins: dict[tuple[int, ...], int] = defaultdict(int)
    if large:
        grouped = group_sizes(large, groups)
        sizes = [g[0] for g in grouped]
        demand = [sum(large[k] for k in g[1]) for g in grouped]
        members = [list(g[1]) for g in grouped]  # longest first
        for column, use in configurations(sizes, demand, capacity):
            _substitute(column, int(use + 1e-9), members, left, open_bins)
    # what rounding down left over, and the short lengths: best fit, longest first
    by_room: dict[int, dict[tuple[int, ...], int]] = defaultdict(lambda: defaultdict(int))
    for bins, n in open_bins.items():
        by_room[capacity - sum(bins)][bins] += n
    for length in sorted((k for k in left if left[k] > 0), reverse=True):
        while left[length] > 0:
            room = next((r for r in range(length, capacity + 1) if by_room.get(r)), None)
            if room is None:
                bins, n, room = (), -(-left[length] // (capacity // length)), capacity
            else:
                bins, n = next(iter(by_room[room].items()))
            # fill as many as fit in each; equal sequences are filled alike
            fit = room // length
            used = min(n, left[length] // fit) if left[length] >= fit else 0
            if used == 0:
                fit, used = left[length], 1
            if bins or by_room.get(room, {}).get(bins):
                by_room[room][bins] -= used
                if by_room[room][bins] == 0:
                    del by_room[room][bins]
            by_room[room - fit * length][bins + (length,) * fit] += used
            left[length] -= used * fit
    return [(bins, n) for room in by_room.values() for bins, n in room.items() if n]


# (groups, share of the capacity above which a length is large)
SETTINGS = ((24, 0.125), (24, 0.34), (48, 0.34), (24, 0.5))


def best_plan(histogram: dict[int, int], capacity: int, settings=SETTINGS) -> list[tuple[tuple[int, ...], int]]:
    """The plan of fewest sequences over a few group counts and bounds of "large"."""
    plans = [plan_packing(histogram, capacity, *s) for s in settings]
    return min(plans, key=lambda plan: sum(n for _, n in plan))


def _substitute(column, times: int, members, left, open_bins) -> None:
    """Use a configuration ``times`` times with real lengths, longest of each group first."""
    while times > 0:
        lengths, run = [], times
        draw: dict[int, int] = defaultdict(int)
        for g, copies in enumerate(column):
            for _ in range(copies):
                length = next((k for k in members[g] if left[k] > draw.get(k, 0)), None)
                if length is not None:
                    draw[length] += 1
                    lengths.append(length)
        if not lengths:
            return
        run = min([run] + [left[k] // d for k, d in draw.items()])
        for k, d in draw.items():
            left[k] -= d * run
        open_bins[tuple(sorted(lengths, reverse=True))] += run
        times -= run


def places(plan) -> tuple[dict[int, list[tuple[int, int, int, int, int]]], int]:
    """Per length the rank ranges (from, to, first sequence, copies, offset); sequences used.

    Rank r of a range is copy ``(r - from) % copies`` in sequence
    ``first + (r - from) // copies``; copies stand one after another.
    """
    taken: dict[int, int] = defaultdict(int)
    out: dict[int, list] = defaultdict(list)
    sequence = 0
    for lengths, n in plan:
        offset = 0
        for length in dict.fromkeys(lengths):
            copies = lengths.count(length)
            start = taken[length]
            out[length].append((start, start + n * copies, sequence, copies, offset))
            taken[length] += n * copies
            offset += copies * length
        sequence += n
    return out, sequence


# ---------------------------------------------------------------- on Spark


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int,
    spaced: bool = True,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """``doc_id, n_tokens, crcs``: each document's length and its pieces' checksums."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    end = packed([end_id])

    def encode(batches):
        cache = word_cache(tokenizer, spaced)
        for batch in batches:
            n, crcs = [], []
            for text in batch.column(1).to_pylist():
                ids = cache.encode(text) + end
                count = len(ids) // ID_BYTES
                first = ((count - 1) % capacity + 1) * ID_BYTES
                cuts = [0, *range(first, len(ids) + 1, capacity * ID_BYTES)]
                n.append(count)
                crcs.append([zlib.crc32(ids[a:b]) for a, b in zip(cuts, cuts[1:])])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(crcs, pa.list_(pa.int64()))],
                names=["doc_id", "n_tokens", "crcs"],
            )

    return rows.mapInArrow(encode, "doc_id long, n_tokens long, crcs array<long>")


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    capacity: int = 1024,
    spaced: bool = True,
    rows_per_block: int = 8_000,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` per piece."""
    ship_package(docs.sparkSession)
    rows = stored(token_pieces(docs, tokenizer, end_id, capacity, spaced), "pieces")
    return place_pieces(rows, capacity, rows_per_block)


def place_pieces(rows: DataFrame, capacity: int, rows_per_block: int = 8_000) -> DataFrame:
    """Pack ``doc_id, n_tokens, crcs`` rows (at least one token each)."""
    spark = rows.sparkSession
    rows = rows.withColumn("_first", F.pmod(F.col("n_tokens") - 1, F.lit(capacity)) + 1)
    histogram = rows.groupBy("_first").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {int(r["_first"]): int(r["n"]) for r in histogram}
    total = sum(counts.values())
    full = counts.pop(capacity, 0)
    ranges, used = places(best_plan(counts, capacity) + ([((capacity,), full)] if full else []))

    blocks = max(1, -(-total // rows_per_block))
    key = F.xxhash64("doc_id", "n_tokens", "crcs")
    rows = rows.withColumn("_block", F.pmod(key, F.lit(blocks)).cast("int")).withColumn(
        "_more", F.size("crcs") - 1
    )
    in_length = Window.partitionBy("_block", "_first").orderBy("doc_id", "crcs")
    in_block = Window.partitionBy("_block").orderBy("_first", "_rank").rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("_rank", F.row_number().over(in_length) - 1).withColumn(
        "_before", F.coalesce(F.sum("_more").over(in_block), F.lit(0))
    )
    # counts per block and length; running sums over blocks make the ranks global
    per = rows.groupBy("_block", "_first").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_more").alias("more")
    )
    over_blocks = Window.partitionBy("_first").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = per.select("_block", "_first", F.coalesce(F.sum("n").over(over_blocks), F.lit(0)).alias("_ahead"))
    all_blocks = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    fulls = (
        per.groupBy("_block")
        .agg(F.sum("more").alias("m"))
        .select("_block", F.coalesce(F.sum("m").over(all_blocks), F.lit(0)).alias("_fulls"))
    )
    # at most ``capacity`` rows, and a number of ranges that depends on it alone: safe to broadcast
    plan = spark.createDataFrame(
        [(k, v) for k, v in ranges.items()],
        "_first long, _ranges array<struct<lo:long,hi:long,seq:long,copies:long,off:long>>",
    )
    rank = F.col("_rank") + F.col("_ahead")
    placed = (
        ranked.join(ahead, ["_block", "_first"])
        .join(fulls, "_block")
        .join(F.broadcast(plan), "_first")
        .withColumn("_rank", rank)
        .withColumn(
            "_at", F.get(F.filter("_ranges", lambda r: (r["lo"] <= F.col("_rank")) & (F.col("_rank") < r["hi"])), F.lit(0))
        )
        .drop("_ranges")
    )
    nth = F.col("_rank") - F.col("_at.lo")
    is_first = F.col("piece") == 0
    return (
        placed.withColumn("_seq", F.col("_at.seq") + F.floor(nth / F.col("_at.copies")))
        .withColumn("_off", F.col("_at.off") + F.pmod(nth, F.col("_at.copies")) * F.col("_first"))
        .select("*", F.posexplode("crcs").alias("piece", "ids_crc32"))
        .select(
            "doc_id",
            F.col("piece").cast("int").alias("piece"),
            F.when(is_first, F.lit(0))
            .otherwise(F.col("_first") + (F.col("piece") - 1) * capacity)
            .cast("long")
            .alias("start"),
            F.when(is_first, F.col("_first")).otherwise(F.lit(capacity)).cast("long").alias("length"),
            "ids_crc32",
            # full later pieces are sequences of their own, numbered after the planned ones
            F.when(is_first, F.col("_seq"))
            .otherwise(F.lit(used) + F.col("_fulls") + F.col("_before") + F.col("piece") - 1)
            .cast("long")
            .alias("sequence_id"),
            F.when(is_first, F.col("_off")).otherwise(F.lit(0)).cast("long").alias("offset"),
        )
    )
