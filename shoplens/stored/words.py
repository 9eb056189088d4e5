"""Search-word counts kept by day, and the hottest words of any days without counting all words.

A day's log gives two parts of a snapshot table: its counts, sorted by count
(``day-…``), and its most frequent words again (``top-…``).  The hottest words
of many days are found in three steps.  The days' top words, added up, give a
count that the k-th hottest word reaches at least.  A word with less than that
count divided by the number of days in each of them cannot reach it, so only
rows from that threshold on are read (sorted files: the row groups below are
skipped).  What is left between a word's count so far and what the unread rows
could add is settled by looking up the few words for which it matters.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.timewin import as_datetime
from shoplens.operators.search import search_word_counts
from shoplens.sources.snapshots import SnapshotTable, nullable

TOP = 100  # words kept again per day
LOOKUPS = 1_000  # words looked up by a pushed filter, more by a join


def _name(kind: str, day) -> str:
    return f"{kind}-{as_datetime(day).date().isoformat()}"


class DailyWords:
    """``word, cnt`` by day."""

    def __init__(self, spark: SparkSession, path: str, top: int = TOP):
        self.table, self.top = SnapshotTable(spark, path), top

    def replace_day(self, day, log: DataFrame, **options) -> int:
        """Count the log of one day (lines of text) and put it in place of the stored one."""
        base = self.table.manifest()
        counts = search_word_counts(log, **options)
        schema, order = nullable(counts.schema), [F.col("cnt").desc(), F.col("word")]
        staged = self.table.stage(counts, F.lit(_name("day", day)), order)
        top = self.table.read_staged(staged, schema).orderBy(*order).limit(self.top)
        staged |= self.table.stage(top, F.lit(_name("top", day)), order)
        return self.table.commit(staged, schema, [_name("day", day), _name("top", day)], base, {"top": self.top})

    def days(self) -> list[dt.date]:
        return [dt.date.fromisoformat(p[4:]) for p in self.table.parts() if p.startswith("day-")]

    def _days(self, first, last) -> list[dt.date]:
        low = as_datetime(first).date() if first is not None else dt.date.min
        high = as_datetime(last).date() if last is not None else dt.date.max
        return [d for d in self.days() if low <= d <= high]

    def _read(self, kind: str, days: Sequence[dt.date]) -> DataFrame:
        return self.table.read([_name(kind, d) for d in days])

    def counts(self, first=None, last=None) -> DataFrame:
        """:func:`~shoplens.operators.search.search_word_counts` of these days."""
        return self._read("day", self._days(first, last)).groupBy("word").agg(F.sum("cnt").alias("cnt"))

    def threshold(self, k: int, days: Sequence[dt.date]) -> int:
        """Every word among the ``k`` hottest has at least this count on some day; 1 where that is not known."""
        tops = self._read("top", days).groupBy("word").agg(F.sum("cnt").alias("cnt"))
        best = [r["cnt"] for r in tops.orderBy(F.col("cnt").desc()).limit(k).collect()]  # k numbers
        return max(1, -(-best[-1] // len(days))) if len(best) == k else 1

    def hot_words(self, k: int = 10, first=None, last=None) -> DataFrame:
        """:func:`~shoplens.operators.search.search_hot_words` of these days, ties by word."""
        days, order = self._days(first, last), [F.col("cnt").desc(), F.col("word")]
        if not days:
            return self.counts(first, last).orderBy(*order).limit(k)
        least = self.threshold(k, days)
        read = self._read("day", days)
        seen = read.filter(F.col("cnt") >= least).groupBy("word").agg(F.sum("cnt").alias("cnt"), F.count("cnt").alias("n"))
        if least == 1:  # all rows were read
            return seen.select("word", "cnt").orderBy(*order).limit(k)
        sure = [r["cnt"] for r in seen.orderBy(F.col("cnt").desc()).limit(k).collect()]
        # what a word can have at most: less than the threshold on each day it was not seen
        most = F.col("cnt") + (len(days) - F.col("n")) * (least - 1)
        hopeful = seen.filter(most >= sure[-1])
        names = [r["word"] for r in hopeful.select("word").limit(LOOKUPS + 1).collect()]
        if len(names) <= LOOKUPS:
            rest = read.filter((F.col("cnt") < least) & F.col("word").isin(names))
        else:
            rest = read.filter(F.col("cnt") < least).join(hopeful.select("word"), "word", "left_semi")
        whole = hopeful.select("word", "cnt").unionByName(rest).groupBy("word").agg(F.sum("cnt").alias("cnt"))
        return whole.orderBy(*order).limit(k)
