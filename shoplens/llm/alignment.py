"""Alignment of two tokenizers by sparse products of token-byte incidence matrices.

Both tokenizations of a text cover the same bytes (a space and the text), so
each is an incidence matrix of tokens by bytes, built by hand in CSR form.
The row-by-row (Gustavson) product A·Bᵀ has an entry for every pair of tokens
whose byte ranges overlap: the overlap links, with the shared bytes as values.
Places where tokens of both end cut the tokens into groups; the product of the
token-group incidence matrices G_A·G_Bᵀ has an entry for every pair of tokens
of one group: the shared-group links.  Products are taken in blocks of bounded
bytes that end at group ends, so a very long text needs no more memory than
its own token ids.

An id pair's count is the number of overlap links of the whole corpus that
hold it.  Counts are summed from per-document pair counts (partial sums before
the shuffle); they meet the documents again by a broadcast while they are few,
else by a join in which every pair is spread over several keys.

Defined results: a text that is NULL, empty, or whose tokens do not spell a
space and the text in both vocabularies has no tokens: zeros and an empty
digest.  NULL ids and repeated rows are rows like any other (repeated texts
count again in the corpus counts); ties for the highest count of an id are all
best; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoplens.llm.common import ship_package, stored
from shoplens.llm.tokens import WordCache, byte_letters

SPACE = "▁"
SLICE_BYTES = 1 << 20  # bytes of text aligned at a time, and of a block of a longer text
SLICE_DOCS = 1_000
BROADCAST_PAIRS = 1_500_000  # a long, a long and a flag each
SALTS = 16


@dataclass(frozen=True)
class Csr:
    """Rows of column numbers; every stored entry is 1."""

    indptr: np.ndarray
    indices: np.ndarray
    columns: int

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1

    def transposed(self) -> Csr:
        counts = np.bincount(self.indices, minlength=self.columns)
        row_of = np.repeat(np.arange(self.rows), np.diff(self.indptr))
        return Csr(_starts(counts), row_of[np.argsort(self.indices, kind="stable")], self.rows)


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(counts, dtype=np.int64)])


def byte_incidence(lengths: np.ndarray) -> Csr:
    """Tokens of these byte lengths, one behind the other, by bytes."""
    indptr = _starts(lengths)
    return Csr(indptr, np.arange(indptr[-1]), int(indptr[-1]))


def group_incidence(group: np.ndarray, groups: int) -> Csr:
    """Tokens by groups."""
    return Csr(np.arange(len(group) + 1), group, groups)


def row_sizes(a: Csr, b: Csr) -> np.ndarray:
    """Terms of every row of ``a``·``b``: the product's symbolic pass."""
    before = _starts(np.diff(b.indptr)[a.indices])
    return before[a.indptr[1:]] - before[a.indptr[:-1]]


def row_product(a: Csr, b: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries (row, column, value) of ``a``·``b``, row by row, columns rising.

    Row i is the sum of the rows of ``b`` that row i of ``a`` names; all rows
    are expanded together, and runs of one (row, column) are added up.
    """
    counts = np.diff(b.indptr)[a.indices]
    before = _starts(counts)
    within = np.arange(before[-1]) - np.repeat(before[:-1], counts)
    column = b.indices[np.repeat(b.indptr[a.indices], counts) + within]
    row = np.repeat(np.repeat(np.arange(a.rows), np.diff(a.indptr)), counts)
    key = row * b.columns + column
    if len(key) > 1 and not (key[1:] >= key[:-1]).all():
        key.sort()
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))
    row, column = np.divmod(key[first], max(1, b.columns))
    return row, column, np.diff(np.append(first, len(key)))


class TokenPair:
    """Two vocabularies: ids of texts in both, and the bytes that every id spells."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor

        self.a = WordCache(a_path, spaced=True, special=False)
        self.b = SentencePieceProcessor(model_file=b_path)
        letters = {letter: byte for byte, letter in byte_letters().items()}
        vocabulary = self.a.tokenizer.get_vocab()
        self.a_size, self.b_size = max(vocabulary.values()) + 1, self.b.get_piece_size()
        a_bytes = [b""] * self.a_size
        for name, i in vocabulary.items():
            known = all(c in letters for c in name)
            a_bytes[i] = bytes(letters[c] for c in name) if known else name.encode()
        names = [self.b.id_to_piece(i) for i in range(self.b_size)]
        b_bytes = [
            bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace(SPACE, " ").encode()
            for i, name in enumerate(names)
        ]
        self.a_lengths, self.b_lengths = (np.array(list(map(len, x)), dtype=np.int64) for x in (a_bytes, b_bytes))
        self.a_spelling, self.b_spelling = (
            (np.frombuffer(b"".join(x), np.uint8), _starts(n)) for x, n in ((a_bytes, self.a_lengths), (b_bytes, self.b_lengths))
        )
        # the digest's text: an id and the sign behind it
        self.signs = [f"{i}{sign}" for sign in ",|" for i in range(self.a_size)]
        self.signs += [f"{i}{sign}" for sign in ",;" for i in range(self.b_size)]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of a space and each text in both vocabularies; none where one does not spell it."""
        out, none = [], np.zeros(0, np.int64)
        for text, b_ids in zip(texts, self.b.encode(texts, num_threads=1)):
            ids = np.frombuffer(self.a.encode_behind_space(text), "<u4").astype(np.int64), np.array(b_ids, dtype=np.int64)
            raw = np.frombuffer(b" " + text.encode(), np.uint8)
            good = text and spells(raw, ids[0], *self.a_spelling) and spells(raw, ids[1], *self.b_spelling)
            out.append(ids if good else (none, none))
        return out


def spells(raw: np.ndarray, ids: np.ndarray, flat: np.ndarray, offsets: np.ndarray, step: int = 1 << 18) -> bool:
    """Whether the tokens' bytes, joined, are ``raw``; ``flat`` and ``offsets`` hold the bytes of every id."""
    at = 0
    for k in range(0, len(ids), step):
        piece = ids[k : k + step]
        before = _starts(offsets[piece + 1] - offsets[piece])
        n = int(before[-1])
        joined = flat[np.arange(n) + np.repeat(offsets[piece] - before[:-1], np.diff(before))]
        if not np.array_equal(joined, raw[at : at + n]):
            return False
        at += n
    return at == len(raw)


class Alignment:
    """Groups and links of token sequences that cover the same bytes (several texts: one behind the other)."""

    def __init__(self, a_lengths: np.ndarray, b_lengths: np.ndarray):
        self.a_lengths, self.b_lengths = a_lengths, b_lengths
        self.a_ends, self.b_ends = np.cumsum(a_lengths), np.cumsum(b_lengths)
        total = int(self.a_ends[-1]) if len(a_lengths) else 0
        ends = np.zeros(total + 1, dtype=np.uint8)
        ends[self.a_ends] = 1
        ends[self.b_ends] |= 2
        self.a_last, self.b_last = ends[self.a_ends] == 3, ends[self.b_ends] == 3
        self.group_ends = self.a_ends[self.a_last]
        self.groups = len(self.group_ends)
        self.a_group = np.cumsum(self.a_last) - self.a_last
        self.b_group = np.cumsum(self.b_last) - self.b_last

    def blocks(self):
        """Token ranges (a from, a to, b from, b to) of about SLICE_BYTES bytes that end at group ends."""
        if not self.groups:
            return
        targets = np.arange(SLICE_BYTES, int(self.group_ends[-1]), SLICE_BYTES)
        at = np.unique(np.append(np.searchsorted(self.group_ends, targets), self.groups - 1))
        a = np.searchsorted(self.a_ends, self.group_ends[at], side="right").tolist()
        b = np.searchsorted(self.b_ends, self.group_ends[at], side="right").tolist()
        yield from zip([0, *a[:-1]], a, [0, *b[:-1]], b)

    def overlap_links(self):
        """Blocks of (a token, b token, shared bytes): A·Bᵀ."""
        for a0, a1, b0, b1 in self.blocks():
            b_of_byte = byte_incidence(self.b_lengths[b0:b1]).transposed()
            row, column, shared = row_product(byte_incidence(self.a_lengths[a0:a1]), b_of_byte)
            yield row + a0, column + b0, shared

    def _group_matrices(self, a0, a1, b0, b1) -> tuple[Csr, Csr]:
        first = int(self.a_group[a0])
        groups = int(self.a_group[a1 - 1]) + 1 - first
        return (
            group_incidence(self.a_group[a0:a1] - first, groups),
            group_incidence(self.b_group[b0:b1] - first, groups).transposed(),
        )

    def group_link_counts(self) -> np.ndarray:
        """Shared-group links of every A token: row sizes of G_A·G_Bᵀ."""
        sizes = [row_sizes(*self._group_matrices(*block)) for block in self.blocks()]
        return np.concatenate(sizes) if sizes else np.zeros(0, np.int64)

    def group_links(self, most: int = 1 << 20):
        """Blocks of (a token, b token): G_A·G_Bᵀ, in runs of rows of about ``most`` entries."""
        for a0, a1, b0, b1 in self.blocks():
            g_a, g_b = self._group_matrices(a0, a1, b0, b1)
            before = _starts(row_sizes(g_a, g_b))
            at = 0
            while at < g_a.rows:
                to = max(at + 1, int(np.searchsorted(before, before[at] + most, side="right")) - 1)
                row, column, _ = row_product(Csr(g_a.indptr[at : to + 1] - at, g_a.indices[at:to], g_a.columns), g_b)
                yield row + a0 + at, column + b0
                at = to

    def signs(self, a_ids: np.ndarray, b_ids: np.ndarray, a_size: int, b_size: int) -> np.ndarray:
        """The tokens in the order of the digest's text, as numbers of ``TokenPair.signs``."""
        a_before = _starts(np.bincount(self.a_group, minlength=self.groups))
        b_before = _starts(np.bincount(self.b_group, minlength=self.groups))
        out = np.empty(len(a_ids) + len(b_ids), dtype=np.int64)
        out[np.arange(len(a_ids)) + b_before[self.a_group]] = a_ids + a_size * self.a_last
        out[np.arange(len(b_ids)) + a_before[self.b_group + 1]] = b_ids + b_size * self.b_last + 2 * a_size
        return out


_PAIRS: dict[tuple[str, str], TokenPair] = {}


def token_pair(a_path: str, b_path: str) -> TokenPair:
    """This Python worker's vocabularies and cache, kept across tasks."""
    key = (a_path, b_path)
    if key not in _PAIRS:
        _PAIRS[key] = TokenPair(*key)
    return _PAIRS[key]


def _slices(texts: list[str]):
    """Ranges of texts of about SLICE_BYTES together."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and (size + len(text) > SLICE_BYTES or i - start >= SLICE_DOCS):
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def _sequences(pair: TokenPair, texts: list[str]):
    """Ids of the texts one behind the other, and every text's number of A and B tokens."""
    ids = pair.encode(texts)
    a_ids, b_ids = (np.concatenate([x[side] for x in ids]) for side in (0, 1))
    return a_ids, b_ids, *(np.array([len(x[side]) for x in ids], dtype=np.int64) for side in (0, 1))


def _digest(pair: TokenPair, signs: np.ndarray) -> str:
    if not len(signs):
        return ""
    sha, step = hashlib.sha256(), 1 << 16
    for at in range(0, len(signs), step):
        text = "".join(map(pair.signs.__getitem__, signs[at : at + step].tolist()))
        sha.update((text[:-1] if at + step >= len(signs) else text).encode())
    return sha.hexdigest()


def _summaries(pair: TokenPair, texts: list[str]) -> dict[str, list | np.ndarray]:
    """Per text the numbers of tokens, groups and links, the digest, and its id pairs with their links."""
    a_ids, b_ids, n_a, n_b = _sequences(pair, texts)
    aligned = Alignment(pair.a_lengths[a_ids], pair.b_lengths[b_ids])
    a_at, b_at = _starts(n_a), _starts(n_b)
    of_text = np.repeat(np.arange(len(texts)), n_a)
    span = pair.a_size * pair.b_size
    keys = [of_text[i] * span + a_ids[i] * pair.b_size + b_ids[j] for i, j, _ in aligned.overlap_links()]
    keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
    pairs, times = np.unique(keys, return_counts=True)
    pair_text, pairs = np.divmod(pairs, span)
    group_links = _starts(aligned.group_link_counts())
    last = _starts(aligned.a_last)
    signs = aligned.signs(a_ids, b_ids, pair.a_size, pair.b_size) if len(a_ids) else a_ids
    return {
        "n_a": n_a,
        "n_b": n_b,
        "n_groups": np.diff(last[a_at]),
        "n_links": np.bincount(pair_text, weights=times, minlength=len(texts)).astype(np.int64),
        "n_group_links": np.diff(group_links[a_at]),
        "groups_sha256": [
            _digest(pair, signs[a_at[k] + b_at[k] : a_at[k + 1] + b_at[k + 1]]) for k in range(len(texts))
        ],
        "offsets": np.searchsorted(pair_text, np.arange(len(texts) + 1)),
        "pairs": pairs,
        "times": times,
    }


SUMMARY = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_group_links long, groups_sha256 string"


def document_alignments(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per document the numbers of tokens, groups, overlap and shared-group links, the groups' digest, and
    ``pairs`` (A id times the size of B, plus B id) with ``times``, the overlap links that hold each."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def align(batches):
        pair = token_pair(a_path, b_path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, stop in _slices(texts):
                out = _summaries(pair, texts[start:stop])
                offsets = pa.array(out["offsets"], pa.int32())
                numbers = ("n_a", "n_b", "n_groups", "n_links", "n_group_links")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, stop - start),
                        *[pa.array(out[c], pa.int64()) for c in numbers],
                        pa.array(out["groups_sha256"], pa.string()),
                        pa.ListArray.from_arrays(offsets, pa.array(out["pairs"], pa.int64())),
                        pa.ListArray.from_arrays(offsets, pa.array(out["times"], pa.int32())),
                    ],
                    names=["doc_id", *numbers, "groups_sha256", "pairs", "times"],
                )

    return rows.mapInArrow(align, f"{SUMMARY}, pairs array<long>, times array<int>")


def link_rows(
    docs: DataFrame, a_path: str, b_path: str, shared_groups: bool = False, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """Every link as a row: ``doc_id, a, b`` (token numbers in the document), ``a_id, b_id, shared_bytes``
    (NULL for shared-group links)."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def links(batches):
        pair = token_pair(a_path, b_path)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a_ids, b_ids, *_ = _sequences(pair, [text])
                aligned = Alignment(pair.a_lengths[a_ids], pair.b_lengths[b_ids])
                found = aligned.group_links() if shared_groups else aligned.overlap_links()
                for a, b, *shared in found:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([doc_id] * len(a), pa.int64()),
                            *[pa.array(x, pa.int64()) for x in (a, b, a_ids[a], b_ids[b])],
                            pa.array(shared[0], pa.int64()) if shared else pa.nulls(len(a), pa.int64()),
                        ],
                        names=["doc_id", "a", "b", "a_id", "b_id", "shared_bytes"],
                    )

    return rows.mapInArrow(links, "doc_id long, a long, b long, a_id long, b_id long, shared_bytes long")


def pair_counts(alignments: DataFrame, b_size: int) -> DataFrame:
    """``pair, links, best``: corpus-wide links of every id pair, and whether no pair of its B id has more."""
    counts = (
        alignments.select(F.inline(F.arrays_zip("pairs", "times")))
        .groupBy(F.col("pairs").alias("pair"))
        .agg(F.sum("times").alias("links"))
    )
    of_b = Window.partitionBy(F.col("pair") % b_size)  # at most one row for each id of A
    return counts.withColumn("best", F.col("links") == F.max("links").over(of_b))


def align_documents(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    broadcast_pairs: int = BROADCAST_PAIRS,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """Per document ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_group_links``.

    ``n_best`` counts the links whose id pair has the highest corpus-wide
    count of its B id, ``count_sum`` adds the counts of all links.
    """
    from sentencepiece import SentencePieceProcessor

    b_size = SentencePieceProcessor(model_file=b_path).get_piece_size()
    found = document_alignments(docs, a_path, b_path, text_col, id_col)
    # row numbers are written once, so they name the rows from here on
    rows = stored(found.withColumn("row", F.monotonically_increasing_id()), "alignments")
    counts = stored(pair_counts(rows, b_size), "pair-counts")
    links = rows.select("row", F.inline(F.arrays_zip("pairs", "times"))).toDF("row", "pair", "times")
    if counts.count() <= broadcast_pairs:
        met = links.join(F.broadcast(counts), "pair")
    else:
        spread = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = links.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(spread, ["pair", "salt"])
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("links")).alias("count_sum"),
    )
    zero = F.lit(0).cast("long")
    return rows.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
        "n_group_links",
    )
