"""Streaming forms of the search-word counts and the daily series.

A search log grows by appended text files; shop tables grow by appended
Parquet files.  The operators below reuse the batch expressions unchanged:

* ``search_word_counts_stream`` keeps one running count per word in the state
  store (``update`` or ``complete`` output), ``search_hot_words_stream``
  ranks them (``complete`` output);
* ``daily_counts_stream`` counts rows per calendar day with an event-time
  watermark, so a day's count is emitted once, when the watermark passes the
  end of the day, and its state is then dropped (``append`` output).

:func:`follow_search_words` and :func:`follow_daily_counts` work off what has
appeared since their last run and stop, for a scheduler to start again (the
jobs ``follow_words`` and ``follow_daily``).  The running word counts live in
the checkpoint's state store, and :func:`followed_word_counts` reads them from
there as a table, so a ranking needs neither the log nor a new trigger.

Checkpoints go under the shared folder named by ``spark.checkpoint.dir``, so
a restarted query resumes exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shoplens.operators.search import search_word_counts
from shoplens.functions.timewin import DAY_FORMAT
from shoplens.session import checkpoint_dir


def search_word_counts_stream(
    spark: SparkSession, log_dir: str, *, max_files_per_trigger: int | None = None, **options
) -> DataFrame:
    """Running ``word, cnt`` over text files appearing in ``log_dir``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return search_word_counts(reader.load(log_dir), **options)


def search_hot_words_stream(spark: SparkSession, log_dir: str, *, k: int = 10, **options) -> DataFrame:
    """The ``k`` most frequent words so far (run with ``complete`` output:
    each trigger re-ranks the running counts held in the state store)."""
    counts = search_word_counts_stream(spark, log_dir, **options)
    return counts.orderBy(F.col("cnt").desc(), F.col("word").asc()).limit(k)


def daily_counts_stream(
    rows: DataFrame,
    *,
    count_col: str,
    out: str,
    time_col: str = "create_time",
    condition: Column | None = None,
    watermark: str = "1 day",
) -> DataFrame:
    """``day, <out>``: rows per calendar day of ``time_col``, finalised by an
    event-time watermark (late rows inside ``watermark`` still count)."""
    tz = rows.sparkSession.conf.get("spark.sql.session.timeZone")
    if tz not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        # one-day tumbling windows start at UTC midnight; only under a UTC
        # session do they coincide with the NTZ calendar days of the table
        raise ValueError(f"daily_counts_stream needs a UTC session time zone, not {tz}")
    if condition is not None:
        rows = rows.filter(condition)
    # watermarks need TIMESTAMP; under UTC the cast keeps the wall-clock time
    event = "__event_time"
    counted = (
        rows.withColumn(event, F.col(time_col).cast("timestamp"))
        .withWatermark(event, watermark)
        .groupBy(F.window(F.col(event), "1 day").alias("w"))
        .agg(F.count(count_col).alias(out))
    )
    return counted.select(
        F.date_format(F.col("w.start"), DAY_FORMAT).alias("day"), F.col(out)
    )


def parquet_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Appended Parquet files under ``path`` as a stream with a fixed schema."""
    return spark.readStream.schema(schema).parquet(path)


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """The folder that holds the progress and the state of the stream ``name``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}"


def start_stream(
    df: DataFrame,
    name: str,
    *,
    sink: str = "parquet",
    path: str | None = None,
    output_mode: str = "append",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a streaming report with a checkpoint under the shared folder.

    ``sink`` is any streaming sink format; ``memory`` (tests) keeps results in
    a session table called ``name``.
    """
    writer = (
        df.writeStream.queryName(name)
        .format(sink)
        .outputMode(output_mode)
        .option("checkpointLocation", stream_checkpoint(df.sparkSession, name))
    )
    if path is not None:
        writer = writer.option("path", path)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def _work_off(df: DataFrame, name: str, **options) -> None:
    """Run a stream over all input that is there now; its failure is raised."""
    start_stream(df, name, trigger={"availableNow": True}, **options).awaitTermination()


def follow_search_words(
    spark: SparkSession, log_dir: str, name: str, *, max_files_per_trigger: int | None = None, **options
) -> DataFrame:
    """Count the log files that appeared since the last run of ``name``; ``word, cnt`` of all so far.

    A file is counted once, also where a run is killed and started anew.
    """
    counts = search_word_counts_stream(spark, log_dir, max_files_per_trigger=max_files_per_trigger, **options)
    _work_off(counts, name, sink="noop", output_mode="update")
    return followed_word_counts(spark, name)


def followed_word_counts(spark: SparkSession, name: str) -> DataFrame:
    """``word, cnt`` as the stream ``name`` left them, read from its state store in one task per state partition."""
    state = spark.read.format("statestore").load(stream_checkpoint(spark, name))
    # groups without a usable word count 0, as in the batch form
    return state.select(F.col("key.word").alias("word"), F.col("value.count").alias("cnt")).filter("cnt > 0")


def follow_daily_counts(rows: DataFrame, name: str, path: str, **options) -> None:
    """Append to ``path`` the days of :func:`daily_counts_stream` that the rows since the last run have closed."""
    _work_off(daily_counts_stream(rows, **options), name, sink="parquet", path=path)
