"""Token ids in ORC files, written in document order and read back by stripe.

File format: ORC with columns ``doc_id``, ``part`` (file number in ascending
``doc_id`` order), ``local_start`` (ids before the document in its file),
``n_ids`` and ``ids``.  Ids and ``doc_id`` use ORC's integer run-length encoding; every
stripe carries row indexes and a Bloom filter on ``doc_id``, so a lookup by
``doc_id`` reads only the stripes and row groups that can hold it.  Spark
splits a file at stripe boundaries, so stripes are read in parallel.

Defined results: NULL text is the empty text (only the end id); NULL
``doc_id`` sorts last; equal ``doc_id`` are ordered by text, so repeated rows
keep one row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoplens.llm.common import MAX_LONG, shared_path, ship_package, shuffle_partitions
from shoplens.llm.tokens import ID_BYTES, packed, word_cache

SCHEMA = "doc_id long, part int, local_start long, n_ids long, ids array<int>"
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("part", pa.int32()),
        ("local_start", pa.int64()),
        ("n_ids", pa.int64()),
        ("ids", pa.list_(pa.int32())),
    ]
)
SLICE = 256  # documents encoded at a time


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    spaced: bool = False,
    text_col: str = "text",
    id_col: str = "doc_id",
    partitions: int | None = None,
    stripe_bytes: int = 16 << 20,
    index_stride: int = 1_000,
    bloom_fpp: float = 0.01,
) -> None:
    """Encode every text and write the files described above under ``path``."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    order = [F.coalesce("doc_id", F.lit(MAX_LONG)), F.col("text")]
    ranged = rows.repartitionByRange(partitions or 2 * shuffle_partitions(spark), order[0])
    end = packed([end_id])

    def encode(batches):
        cache = word_cache(tokenizer, spaced)
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                piece = batch.slice(at, SLICE)
                ids = [cache.encode(t) + end for t in piece.column(1).to_pylist()]
                offsets, before = [0], []
                for x in ids:
                    before.append(start)
                    start += len(x) // ID_BYTES
                    offsets.append(offsets[-1] + len(x) // ID_BYTES)
                values = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(ids))])
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0),
                        pa.array([part] * len(ids), pa.int32()),
                        pa.array(before, pa.int64()),
                        pa.array([len(x) // ID_BYTES for x in ids], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values),
                    ],
                    schema=_ARROW,
                )

    (
        ranged.sortWithinPartitions(*order)
        .mapInArrow(encode, SCHEMA)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", str(bloom_fpp))
        .option("orc.row.index.stride", str(index_stride))
        .option("orc.stripe.size", str(stripe_bytes))
        .option("compression", "zstd")
        .orc(path)
    )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, part, local_start, n_ids, ids`` of the files; filters on ``doc_id`` prune stripes."""
    return spark.read.schema(SCHEMA).orc(path)


def document_starts(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document, from the files.

    A file's base is the number of ids in the files before it: a running sum
    over one row per file, the only step in one task.  It reads two columns of
    numbers; the ids are read once, for their checksums.
    """

    def digest(batches):
        for batch in batches:
            col = batch.column(4)
            offsets = col.offsets.to_numpy()
            raw = memoryview(col.values.to_numpy(zero_copy_only=True).astype("<u4", copy=False)).cast("B")
            crc = [zlib.crc32(raw[ID_BYTES * a : ID_BYTES * b]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    batch.column(3),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "part", "local_start", "n_tokens", "ids_crc32"],
            )

    rows = files.mapInArrow(digest, "doc_id long, part int, local_start long, n_tokens long, ids_crc32 long")
    ends = files.groupBy("part").agg(F.max(F.col("local_start") + F.col("n_ids")).alias("n_ids"))
    base = ends.select(
        "part",
        F.coalesce(
            F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("base"),
    )
    return rows.join(base, "part").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def orc_token_ids(docs: DataFrame, tokenizer: str, end_id: int, spaced: bool = False) -> DataFrame:
    """Write all documents' ids to ORC in the shared folder and digest what is read back."""
    ship_package(docs.sparkSession)
    path = shared_path(docs.sparkSession, "orc-ids")
    write_ids(docs, path, tokenizer, end_id, spaced)
    return document_starts(read_ids(docs.sparkSession, path))
