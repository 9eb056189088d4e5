"""Search-log word counts and the hottest words.

A log line is tab-separated and its third field is the query word.  Lines
with fewer than three fields, and empty words, are skipped rather than
failing the job.  Counting is a grouped count (partial aggregation per task,
so one very frequent word is one row per task before the shuffle); the top-k
is a ``limit`` over an ``orderBy``, which Spark runs as TakeOrderedAndProject:
k rows per task, then a k-row merge, with no global sort.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD_FIELD = 2  # zero-based position of the query word in a log line


def _word(sep: str, field: int, keep_empty: bool):
    """(word expression, usable-word test on the projected ``word``)."""
    if keep_empty:
        # a plain split keeps an empty field; get() is NULL past the end
        word = F.get(F.split(F.col("value"), re.escape(sep)), field)
        return word, F.col("word").isNotNull()
    # split_part is a literal (non-regex) split, '' past the end
    word = F.split_part(F.col("value"), F.lit(sep), F.lit(field + 1))
    return word, F.col("word") != ""


def search_words(
    log: DataFrame, *, sep: str = "\t", field: int = WORD_FIELD, keep_empty: bool = False
) -> DataFrame:
    """One ``word`` per usable log line.

    A line with too few fields, or (unless ``keep_empty``) an empty word, is
    skipped rather than failing the job.
    """
    word, usable = _word(sep, field, keep_empty)
    return log.select(word.alias("word")).filter(usable)


def search_word_counts(
    log: DataFrame, *, sep: str = "\t", field: int = WORD_FIELD, keep_empty: bool = False
) -> DataFrame:
    """``word, cnt``: occurrences of each query word.

    The usable-word test is a conditional count and unusable groups are
    dropped after counting (they count 0).  Filtering first would let
    Catalyst push the test below the projection and extract the word twice
    per line; this way each line is split once.
    """
    word, usable = _word(sep, field, keep_empty)
    return (
        log.select(word.alias("word"))
        .groupBy("word")
        .agg(F.count(F.when(usable, True)).alias("cnt"))
        .filter(F.col("cnt") > 0)
    )


def search_hot_words(log: DataFrame, *, k: int = 10, **options) -> DataFrame:
    """The ``k`` most frequent words, ties broken by the word ascending."""
    return (
        search_word_counts(log, **options)
        .orderBy(F.col("cnt").desc(), F.col("word").asc())
        .limit(k)
    )
