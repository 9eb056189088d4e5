"""The same reports over unbounded sources, with Structured Streaming."""

from shoplens.streaming.reports import (
    daily_counts_stream,
    follow_daily_counts,
    follow_search_words,
    followed_word_counts,
    search_hot_words_stream,
    search_word_counts_stream,
    start_stream,
)

__all__ = [
    "daily_counts_stream",
    "follow_daily_counts",
    "follow_search_words",
    "followed_word_counts",
    "search_hot_words_stream",
    "search_word_counts_stream",
    "start_stream",
]
