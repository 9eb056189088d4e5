"""Token counts by heap-and-linked-list pair merging, without producing identifiers.

A text is normalised as the merge-type SentencePiece model says (a space in
front, spaces as U+2581) and cut wherever no piece of the vocabulary holds the
two characters at the cut side by side: merges cannot cross such a place.  In
a cut every character is a symbol of a linked list and the pairs of neighbours
that form a piece lie in a heap by (rank, place).  The lowest pair is popped
and merged until the heap is empty.  The count is the number of initial
symbols minus the number of merges; a character without a piece is as many
initial symbols as it has bytes, since it is spelled in byte pieces and never
merges.  No ids and no piece strings are built.

Counts of short cuts are cached per worker (bounded, emptied when full).

Defined results: a NULL text is the empty text and has no bytes and no tokens;
a NULL id and repeated rows are counted like any other row; an empty table
gives no rows; other columns are ignored.  The work of a cut of n characters
is O(n log n), so very long texts without spaces are counted whole.
"""

from __future__ import annotations

import heapq
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import ship_package

SPACE = "▁"
CACHED = 48  # characters of the longest cut whose count is kept
LIMIT = 1_000_000  # counts kept by a worker


class MergeRanks:
    """What counting needs of a model: the rank of every piece, and which characters meet in one."""

    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=model)
        scores, spelled = {}, 0
        for i in range(sp.get_piece_size()):
            if sp.is_byte(i):
                spelled += 1
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                scores[sp.id_to_piece(i)] = sp.get_score(i)
        order = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {piece: order[s] for piece, s in scores.items()}
        if spelled != 256 or any(c not in self.rank for piece in self.rank for c in piece):
            raise ValueError("counting needs a merge model with byte pieces and a piece for every character it joins")
        self.meets = {piece[k : k + 2] for piece in self.rank for k in range(len(piece) - 1)}
        # where no piece goes on, a text can be cut by pattern before it is looked at
        spaces_lead = not any(b == SPACE and a != SPACE for a, b in self.meets)
        line_ends_alone = not any("\n" in pair for pair in self.meets)
        self.cut = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+") if spaces_lead and line_ends_alone else None

    def merges(self, cut: str) -> int:
        """How many pairs of ``cut`` merge."""
        n, rank = len(cut), self.rank.get
        end = list(range(1, n + 1))  # where the symbol that starts here ends: the next one's start
        before = list(range(-1, n - 1))
        pair = [-1] * n  # rank of the pair that starts here, -1 without one
        heap = []
        for k in range(n - 1):
            r = rank(cut[k : k + 2])
            if r is not None:
                pair[k] = r
                heap.append(r * n + k)
        heapq.heapify(heap)
        push, pop, done = heapq.heappush, heapq.heappop, 0
        while heap:
            r, left = divmod(pop(heap), n)
            if pair[left] != r:  # one of the two has merged with another since
                continue
            done += 1
            right = end[left]
            stop = end[left] = end[right]
            pair[right] = pair[left] = -1
            if stop < n:
                before[stop] = left
                r = rank(cut[left : end[stop]])
                if r is not None:
                    pair[left] = r
                    push(heap, r * n + left)
            front = before[left]
            if front >= 0:
                r = rank(cut[front:stop])
                pair[front] = -1 if r is None else r
                if r is not None:
                    push(heap, r * n + front)
        return done

    def symbols(self, cut: str) -> int:
        """Initial symbols: a character with a piece is one, any other one for each byte."""
        rank = self.rank
        return sum(1 if c in rank else len(c.encode("utf-8", "surrogatepass")) for c in cut)


class CountCache(dict):
    """Token counts by cut; what is not kept is counted again."""

    def __init__(self, model: str, limit: int = LIMIT):
        self.ranks, self.limit = MergeRanks(model), limit

    def __missing__(self, part: str) -> int:
        meets = self.ranks.meets
        at = [k for k in range(1, len(part)) if part[k - 1 : k + 1] not in meets]
        if at:
            count = sum(map(self.__getitem__, map(part.__getitem__, map(slice, [0, *at], [*at, len(part)]))))
        else:
            count = self.ranks.symbols(part) - self.ranks.merges(part)
        if len(part) <= CACHED:
            if len(self) >= self.limit:
                self.clear()
            self[part] = count
        return count

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = SPACE + text.replace(" ", SPACE)
        if self.ranks.cut is None:
            return self[text]
        return sum(map(self.__getitem__, self.ranks.cut.findall(text)))


_CACHES: dict[str, CountCache] = {}


def count_cache(model: str) -> CountCache:
    """This Python worker's counts for a model file, kept across tasks."""
    if model not in _CACHES:
        _CACHES[model] = CountCache(model)
    return _CACHES[model]


def count_tokens(
    docs: DataFrame, model: str, limit: int = 4096, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every whole text.

    ``model`` is a merge-type SentencePiece file; ``over_limit`` says that a
    text has more than ``limit`` tokens.
    """
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")
    )

    def count(batches):
        cache = count_cache(model)
        for batch in batches:
            counts = [cache.count(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
            )

    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit
    )
