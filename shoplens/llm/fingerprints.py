"""Order MinHash fingerprints, sensitive to edit distance, in DataFrame expressions only.

The symbols of a text are its words (runs without white space, longer ones cut
every ``SYMBOL`` code points).  Every k-mer of symbols is numbered by its
occurrence in the text and hashed.  Each of the ``sketches`` orders the
numbered k-mers at random, takes the ``length`` smallest, puts them back into
text order and hashes the tuple.  Likeness of two fingerprints is the share of
equal tuples.

The orders are rotations of ``orders`` independent random orders: a sketch
starts at its own place of the hash range and goes round past its end.  By
symmetry each rotation is a uniformly random order, so every sketch of every
text is a tuple of ``length`` numbered k-mers (of all, if the text has fewer)
and likeness is unbiased; only ``orders`` sorts are needed.  Sketches of one
order share k-mers where a text has few, so likeness varies more than that of
independent sketches below about ``sketches / orders`` k-mers.

All steps are array expressions over one row, sorting only arrays of longs:
work is n log n in the symbols of a text and nothing is exploded or shuffled.

Defined results: NULL and empty texts have the fingerprint of the empty text,
equal to each other's; repeated rows and ties of the id are ordered by text; a
NULL id sorts last; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoplens.llm.common import MAX_LONG, bucket_of, let, shuffle_partitions, splitters

SYMBOL = 12
POS_BITS = 28  # a position and the upper 35 bits of a hash share one long
POS = (1 << POS_BITS) - 1
HASH_BITS = 63 - POS_BITS
BROADCAST_RANGES = 1_000_000
RANGES_PER_TASK = 8


def order_minhash(text: Column, k: int = 3, length: int = 2, sketches: int = 64, orders: int = 4) -> Column:
    """One 32-bit tuple hash per sketch (``sketches / orders`` a power of two)."""
    symbols = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\s]{1,%d}" % SYMBOL), F.lit(0))

    def hashed(w: Column) -> Column:
        # fewer than k symbols: the whole sequence is the only k-mer (NULLs do not count)
        return F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0))),
            lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]).bitwiseAND(F.lit(MAX_LONG)),
        )

    def numbered(kmers: Column) -> Column:
        grouped = F.sort_array(
            F.transform(kmers, lambda h, i: h.bitwiseAND(F.lit(MAX_LONG - POS)) + i.cast("long"))
        )
        powers = F.filter(F.lit([1 << b for b in reversed(range(POS_BITS))]), lambda s: s < F.size(kmers))
        return let(grouped, lambda g: let(powers, lambda p: sketched(_with_occurrence(kmers, g, p), p)))

    def sketched(codes: Column, powers: Column) -> Column:
        return let(
            codes,
            lambda c: F.flatten(
                F.transform(F.lit(list(range(orders))), lambda r: _sketches(c, powers, r, length, sketches // orders))
            ),
        )

    return let(symbols, lambda w: let(hashed(w), numbered))


def _with_occurrence(kmers, grouped, powers) -> Column:
    """Hash of each k-mer with its occurrence number above, its place in the text below."""

    def code(x: Column, j: Column) -> Column:
        place = x.bitwiseAND(F.lit(POS))
        own = F.coalesce(F.get(kmers, place.cast("int")), F.lit(0).cast("long"))
        head = F.shiftright(x, POS_BITS)
        # equal k-mers stand together, in text order: how many before this one
        before = F.aggregate(
            powers,
            F.lit(0),
            lambda t, s: F.when(F.shiftright(F.get(grouped, j - t - s), POS_BITS) == head, t + s).otherwise(t),
        )
        repeated = F.shiftright(F.get(grouped, j - 1), POS_BITS) == head
        mixed = F.xxhash64(own, F.when(repeated, before).otherwise(F.lit(0)))
        return mixed.bitwiseAND(F.lit(MAX_LONG - POS)) + place

    return F.transform(grouped, code)


def _sketches(codes, powers, order, length, rotations) -> Column:
    """Tuple hashes of one random order's rotations."""

    def placed_anew(c: Column) -> Column:
        mixed = F.xxhash64(F.shiftright(c, POS_BITS), order)
        return mixed.bitwiseAND(F.lit(MAX_LONG - POS)) + c.bitwiseAND(F.lit(POS))

    # 63 bits of hash range, cut evenly
    starts = F.lit([(1 << 63) // rotations * b for b in range(rotations)])
    return let(
        F.sort_array(F.transform(codes, placed_anew)),
        lambda q: F.transform(starts, lambda low: _tuple_hash(q, powers, low, length)),
    )


def _tuple_hash(order, powers, low, length) -> Column:
    first = F.aggregate(
        F.concat(powers, F.array(F.lit(1))),  # one more step: as many as all may lie below
        F.lit(0),
        lambda at, s: F.when(F.get(order, at + s - 1) < low, at + s).otherwise(at),
    )

    def fold(at: Column) -> Column:
        # the smallest from there on, past the end the first ones
        steps = F.sequence(F.lit(0), F.least(F.lit(length), F.size(order)) - 1)
        chosen = F.transform(steps, lambda j: F.get(order, (at + j) % F.size(order)))
        # back to text order: position above, hash below
        placed = F.sort_array(
            F.transform(chosen, lambda x: F.shiftleft(x.bitwiseAND(F.lit(POS)), HASH_BITS) + F.shiftright(x, POS_BITS))
        )
        return F.aggregate(
            placed, F.lit(0).cast("long"), lambda acc, x: F.xxhash64(acc, x.bitwiseAND(F.lit((1 << HASH_BITS) - 1)))
        ).bitwiseAND(F.lit(0xFFFFFFFF))

    return let(first, fold)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal tuples of two fingerprints (0 to 1)."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda v: v)) / F.size(a)


def as_text(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda x: F.lower(F.hex(x))), ".")


def with_next(docs: DataFrame, rows_per_bucket: int = 500) -> DataFrame:
    """``doc_id, text, print, next_text, next_print`` in id order, the last before the first.

    Ids are cut into ranges by quantiles, at most ``RANGES_PER_TASK`` for each
    task of a shuffle; a range's rows meet the first row of the range after
    it, so no task sees the order of more than its ranges.
    """
    key = F.coalesce("doc_id", F.lit(MAX_LONG))
    rows = docs.withColumn("_key", key)
    tasks = shuffle_partitions(docs.sparkSession)
    cuts = splitters(rows, "_key", rows_per_bucket, most=RANGES_PER_TASK * tasks)
    rows = rows.withColumn("_range", bucket_of(F.col("_key"), cuts))
    heads = rows.groupBy("_range").agg(F.min("_key").alias("_key"))
    if len(cuts) < BROADCAST_RANGES:  # two numbers a range; more of them meet the texts in a shuffle
        heads = F.broadcast(heads)
    first = rows.join(heads, ["_range", "_key"], "left_semi").groupBy("_range", "_key").agg(F.min("text").alias("text"))
    # one row per range: the only step in one task
    line = Window.orderBy("_range")
    last = rows.agg(F.max("_range")).first()[0] or 0
    guests = first.select(
        F.lit(None).cast("long").alias("doc_id"),
        "text",
        "_key",
        F.coalesce(F.lag("_range").over(line), F.lit(last)).alias("_range"),
        F.lit(1).alias("_guest"),
    )
    every = rows.withColumn("_guest", F.lit(0)).unionByName(guests)
    dealt = every.repartition(tasks, "_range")
    printed = dealt.withColumn("print", order_minhash(F.col("text")))
    after = Window.partitionBy("_range").orderBy("_guest", "_key", "text")
    return (
        printed.withColumn("next_text", F.lead("text").over(after))
        .withColumn("next_print", F.lead("print").over(after))
        .filter("_guest = 0")
    )


def fingerprint_documents(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Fingerprints of every text and of its edited text (its second half replaced by the next one's start)."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    both = with_next(rows).withColumn("edited", edited)
    both = both.withColumn("edited_print", order_minhash(F.col("edited")))
    return both.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("print")).alias("fingerprint"),
        as_text(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
