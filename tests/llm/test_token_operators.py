"""Token counts and tokenizer alignment against the libraries and brute force."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from shoplens.llm import alignment
from shoplens.llm.alignment import Alignment, Csr, TokenPair, align_documents, link_rows, row_product, row_sizes
from shoplens.llm.token_counts import CountCache, count_tokens
from shoplens.llm.tokens import byte_letters
from tests.llm.fixtures import documents, sentence, texts

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
AWKWARD = ["the", "ing", " ", "  ", "\n", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "▁", "é", "é", "中文", "123",
           "don't", "\t", ".", ",\n", "🙂🙂", "﷽", "ﬁ", "\x00", "　", " ", "\r\n", "İ", "aaaaaaaa"]


def awkward_texts(n: int) -> list[str]:
    rng = np.random.default_rng(3)
    return ["".join(AWKWARD[k] for k in rng.integers(0, len(AWKWARD), rng.integers(0, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def pieces():
    return SentencePieceProcessor(model_file=B)


# ---------------------------------------------------------------- counts


def test_counts_are_the_librarys(pieces):
    cache = CountCache(B, limit=200)
    for text in awkward_texts(4000) + [t or "" for _, t in texts()]:
        assert cache.count(text) == len(pieces.encode(text)), repr(text)


def test_counts_of_very_long_texts(pieces):
    cache = CountCache(B)
    for text in ("x" * 60_000, "的" * 40_000, " " * 30_000, "the" * 30_000, sentence(4, 30_000)):
        assert cache.count(text) == len(pieces.encode(text))


def test_counts_do_not_need_places_to_cut(pieces):
    cache = CountCache(B)
    cache.ranks.cut = None
    for text in awkward_texts(300):
        assert cache.count(text) == len(pieces.encode(text)), repr(text)


def test_count_is_symbols_minus_merges(pieces):
    ranks = CountCache(B).ranks
    for word in ("▁alignment", "🙂a🙂", "▁▁▁word", "aaaaaaaaaaa"):
        assert ranks.symbols(word) - ranks.merges(word) == CountCache(B)[word]


def test_token_counts_on_spark(spark, pieces):
    rows = texts() + [(70, "a " * 4096), (71, "a " * 4095 + "a")]
    found = count_tokens(documents(spark, rows), B).collect()
    n = Counter(len(pieces.encode(t or "")) for _, t in rows)
    assert Counter(r["n_tokens"] for r in found) == n
    expected = Counter(
        (i, len((t or "").encode()), len(pieces.encode(t or "")), len(pieces.encode(t or "")) > 4096) for i, t in rows
    )
    assert Counter(map(tuple, found)) == expected
    assert any(r["over_limit"] for r in found)
    empty = count_tokens(documents(spark, []), B)
    assert empty.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and empty.count() == 0


# ---------------------------------------------------------------- alignment


def plain_alignment(text):
    """Ids, groups and overlap links by their definitions; None without tokens."""
    tok, sp = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    letters = {x: b for b, x in byte_letters().items()}

    def run(text):
        if not text:
            return None
        raw = (" " + text).encode()
        a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        spelled = (
            [bytes(letters[c] for c in tok.id_to_token(i)) for i in a],
            [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b],
        )
        if any(b"".join(x) != raw for x in spelled):
            return None
        ends = [list(np.cumsum([len(y) for y in x])) for x in spelled]
        common = sorted(set(ends[0]) & set(ends[1]))
        groups, links, same = [], [], []
        for start, stop in zip([0, *common], common):
            inside = [[k for k, e in enumerate(side) if start < e <= stop] for side in ends]
            groups.append("|".join(",".join(str(ids[k]) for k in ks) for ids, ks in zip((a, b), inside)))
            same += [(i, j) for i in inside[0] for j in inside[1]]
            for i in inside[0]:
                for j in inside[1]:
                    low = max(ends[0][i] - len(spelled[0][i]), ends[1][j] - len(spelled[1][j]))
                    shared = min(ends[0][i], ends[1][j]) - low
                    if shared > 0:
                        links.append((i, j, a[i], b[j], int(shared)))
        return a, b, groups, links, same

    return run(text)


def expected_rows(rows):
    found = [(i, plain_alignment(t)) for i, t in rows]
    count = Counter((x[2], x[3]) for _, f in found if f for x in f[3])
    best: dict[int, int] = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = Counter()
    for i, f in found:
        if f is None:
            out[i, 0, 0, 0, 0, 0, 0, "", 0] += 1
            continue
        a, b, groups, links, same = f
        hits = [count[x[2], x[3]] for x in links]
        n_best = sum(n == best[x[3]] for n, x in zip(hits, links))
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out[i, len(a), len(b), len(groups), len(links), n_best, sum(hits), sha, len(same)] += 1
    return out


@pytest.mark.parametrize("broadcast_pairs", [1_000_000, 0])
def test_alignment_matches_its_definition(spark, broadcast_pairs):
    rows = [(i, t) for i, t in texts() if t is None or len(t) < 10_000] + list(enumerate(awkward_texts(60), 1000))
    found = align_documents(documents(spark, rows), A, B, broadcast_pairs=broadcast_pairs)
    assert Counter(map(tuple, found.collect())) == expected_rows(rows)


def test_alignment_of_empty_table(spark):
    found = align_documents(documents(spark, []), A, B)
    assert found.count() == 0
    assert found.columns[:8] == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_links_as_rows(spark):
    rows = list(enumerate(awkward_texts(25)))
    found = {i: plain_alignment(t) for i, t in rows}
    links = link_rows(documents(spark, rows), A, B).collect()
    assert sorted(map(tuple, links)) == sorted((i, *x) for i, f in found.items() if f for x in f[3])
    groups = link_rows(documents(spark, rows), A, B, shared_groups=True).collect()
    assert sorted((r["doc_id"], r["a"], r["b"]) for r in groups) == sorted((i, *x) for i, f in found.items() if f for x in f[4])


def test_blocks_do_not_change_the_result(monkeypatch):
    pair = TokenPair(A, B)
    batch = awkward_texts(200) + [sentence(3, 3000)]
    whole = alignment._summaries(pair, batch)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 16)
    small = alignment._summaries(pair, batch)
    for key, value in whole.items():
        assert list(value) == list(small[key]), key


def test_row_products_match_dense_products():
    rng = np.random.default_rng(5)
    for _ in range(50):
        n, k, m = rng.integers(1, 12, 3)
        x, y = rng.random((n, k)) < 0.4, rng.random((k, m)) < 0.4

        def csr(d):
            return Csr(np.concatenate([[0], np.cumsum(d.sum(axis=1))]), np.nonzero(d)[1], d.shape[1])

        row, column, value = row_product(csr(x), csr(y))
        dense = np.zeros((n, m), int)
        dense[row, column] = value
        assert (dense == x.astype(int) @ y.astype(int)).all() and (value > 0).all()
        assert (row_sizes(csr(x), csr(y)) == (x.astype(int) @ y.astype(int)).sum(axis=1)).all()
        assert (csr(x).transposed().indices == np.nonzero(x.T)[1]).all()


def test_one_long_group_is_emitted_in_bounded_blocks():
    aligned = Alignment(np.full(300, 2), np.array([1, *[2] * 299, 1]))
    assert aligned.groups == 1
    blocks = list(aligned.group_links(most=1000))
    assert len(blocks) > 50 and max(len(a) for a, _ in blocks) <= 1000
    assert sum(len(a) for a, _ in blocks) == 300 * 301 == aligned.group_link_counts().sum()
