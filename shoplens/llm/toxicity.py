"""Toxic spans with a linear-chain conditional random field, scored per document.

Document labels are turned into token labels: a word or word beginning that
is far likelier in toxic than in clean training texts marks its tokens in
toxic texts.  A two-state chain (hashed word, prefix and suffix features,
transitions) is fitted to these tokens by maximum likelihood; forward-backward
marginals of every token of a text give the offending spans; the largest one
and the noisy-or evidence of the offending tokens give the score through a
fitted logistic curve.

Training uses a bounded sample (``max_rows`` labelled rows of either class, in
keyed-hash order); scoring reads every whole text.  Labels, language, source
and ids are no inputs of a score.

Defined results: NULL and empty texts have no tokens and get the score of a
text without toxic tokens; labels that are NULL or whose document is missing
teach nothing; with no toxic or no clean training row every score is the
constant share of toxic rows; repeated rows are scored alike, rows
without an id too (they are in no held-out fold); texts of any length are
scored whole, by their tokens' marginals; an empty table gives no rows;
``with_toxicity`` keeps all other columns, ``score_documents`` reads none.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.common import ship_package

WORD = re.compile(r"\w+")
DIMS = 1 << 18
MAX_FEATURES = 9  # of a token
SEGMENT = 64  # tokens in one training sequence
CLIP = 12.0
CUT = 30.0  # of a word's emission
MARKING = frozenset(("w=", "p4", "p5", "p6", "p7", "p8"))  # features that may mark tokens


@dataclass
class ToxicityModel:
    weights: np.ndarray  # emission weight of state 1 by hashed feature
    transition: np.ndarray  # 2 x 2, log scale
    start: float  # log odds of state 1 at the first token
    curve: tuple[float, float, float]  # document logistic: bias, largest log odds, evidence
    constant: float | None = None  # score of all texts when one class is missing


def features(word: str) -> list[str]:
    """A token's features: itself, its beginnings and endings."""
    out = ["w=" + word]
    for n in range(3, 9):
        if len(word) > n:
            out.append(f"p{n}={word[:n]}")
    for n in (3, 4):
        if len(word) > n:
            out.append(f"s{n}={word[-n:]}")
    return out


def slots(word: str) -> list[int]:
    return [0, *(zlib.crc32(f.encode()) % (DIMS - 1) + 1 for f in features(word))]


# ---------------------------------------------------------------- training


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int, fold: int = 5) -> list[tuple[str, int]]:
    """At most ``max_rows`` labelled texts of either class, outside the held-out fold."""
    seen = labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("toxic").isin(0, 1) & ~held_out("doc_id", fold)
    )
    order = F.xxhash64(F.lit(11), F.col("doc_id"))
    picked = None
    for label in (0, 1):
        part = seen.filter(F.col("toxic") == label).dropDuplicates(["doc_id"]).orderBy(order, "doc_id").limit(max_rows)
        picked = part if picked is None else picked.unionByName(part)
    # at most 2 * max_rows ids: safe to broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "toxic").distinct().collect()
    return sorted((r["text"] or "", r["toxic"]) for r in rows)


def held_out(id_col: str, fold: int = 5):
    return F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % fold == 0


class Vocabulary:
    """The sample's words as numbers, with the hashed features of each word."""

    def __init__(self, texts: list[str]):
        numbers: dict[str, int] = {}
        self.documents = [
            np.fromiter((numbers.setdefault(w, len(numbers)) for w in WORD.findall(t.lower())), np.int32) for t in texts
        ]
        # column 0 is the bias; a code of 0 is no feature
        self.codes = np.zeros((len(numbers), 1 + MAX_FEATURES), np.uint32)
        self.marking = np.zeros(self.codes.shape, bool)
        for i, word in enumerate(numbers):
            for j, f in enumerate(features(word), 1):
                self.codes[i, j] = zlib.crc32(f.encode())
                self.marking[i, j] = f[:2] in MARKING
        self.slots = np.where(self.codes > 0, self.codes % np.uint32(DIMS - 1) + 1, 0).astype(np.int32)
        self.used = (self.codes > 0).astype(np.float32)
        self.used[:, 0] = 1

    def emission(self, weights: np.ndarray) -> np.ndarray:
        return (weights[self.slots] * self.used).sum(1)


def distinct_documents(words: Vocabulary, labels: list[int]) -> list[int]:
    """One of each group of near copies (equal minima of four word hashes): copies are no evidence."""
    seen, out = set(), []
    for k, ids in enumerate(words.documents):
        codes = words.codes[np.unique(ids), 1].astype(np.uint64)
        key = tuple(
            int(((codes * np.uint64(m) + np.uint64(1)) % np.uint64(4294967291)).min())
            for m in (3, 7919, 104729, 1299709)
        ) if len(codes) else ()
        if (key, labels[k]) not in seen:
            seen.add((key, labels[k]))
            out.append(k)
    return out


def marked_words(words: Vocabulary, labels: list[int], odds: float = 30.0) -> np.ndarray:
    """Which words mark toxic tokens: one of their features is far likelier in toxic texts.

    The log-likelihood ratio statistic of a feature's two counts must pass a
    bar that grows with the number of features, so that of very many rare ones
    hardly any passes by chance.
    """
    held: tuple[list, list] = ([np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)])
    for k in distinct_documents(words, labels):
        own = np.unique(words.documents[k])
        held[labels[k]].append(np.unique(words.codes[own][words.marking[own]]))
    n0, n1 = len(held[0]) - 1, len(held[1]) - 1
    clean, clean_counts = np.unique(np.concatenate(held[0]), return_counts=True)
    found, c1 = np.unique(np.concatenate(held[1]), return_counts=True)
    at = np.minimum(np.searchsorted(clean, found), max(0, len(clean) - 1))
    c0 = np.where(clean[at] == found, clean_counts[at], 0) if len(clean) else np.zeros(len(found), int)
    bar = 2 * math.log(max(2, len(np.union1d(clean, found)))) + 4

    def term(k, n, share):
        with np.errstate(divide="ignore", invalid="ignore"):
            yes = np.where(k > 0, k * np.log(share), 0.0)
            no = np.where(n - k > 0, (n - k) * np.log(1 - share), 0.0)
        return yes + no

    both = (c0 + c1) / max(1, n0 + n1)
    g = 2 * (
        term(c1, n1, c1 / max(1, n1)) + term(c0, n0, c0 / max(1, n0)) - term(c1, n1, both) - term(c0, n0, both)
    )
    marks = found[((c1 + 0.5) / (n1 + 1) >= odds * c0 / (n0 + 1)) & (g >= bar)]
    return (np.isin(words.codes, marks) & words.marking).any(1)


def train_toxicity(
    docs: DataFrame, labels: DataFrame, max_rows: int = 2000, max_segments: int = 6000
) -> ToxicityModel:
    """Fit the chain and the document curve on a bounded sample, on the driver.

    The sample is at most ``max_rows`` labelled texts of either class; the
    chain learns from at most ``max_segments`` segments of them, half of them
    with a marked word, evenly spread.  Both bound training only: every text
    is scored whole.
    """
    return fit(training_rows(docs, labels, max_rows), max_segments=max_segments)


def _spread(items: list, most: int) -> list:
    return items if len(items) <= most else [items[i * len(items) // most] for i in range(most)]


def fit(rows: list[tuple[str, int]], steps: int = 80, max_segments: int = 6000) -> ToxicityModel:
    """The model of labelled texts (at most a few thousand)."""
    labels = [y for _, y in rows]
    n1 = sum(labels)
    if n1 == 0 or n1 == len(rows):
        share = n1 / len(rows) if rows else 0.0
        return ToxicityModel(np.zeros(DIMS, np.float32), np.zeros((2, 2)), 0.0, (0.0, 0.0, 0.0), share)
    words = Vocabulary([t for t, _ in rows])
    is_marked = marked_words(words, labels)
    marked, plain = [], []  # (words of a segment, labels), with a marked word or without
    for ids, label in zip(words.documents, labels):
        for a in range(0, len(ids), SEGMENT):
            seq = ids[a : a + SEGMENT]
            hit = is_marked[seq]
            # clean uses of a marked word teach the most: they are kept like the toxic ones
            (marked if hit.any() else plain).append((seq, hit & bool(label)))
    # at most ``max_segments`` training sequences, evenly spread over the sample
    kept = _spread(marked, max_segments // 2)
    kept += _spread(plain, max_segments - len(kept))
    sequences, targets = [s for s, _ in kept], [t for _, t in kept]
    lengths = np.array([len(s) for s in sequences])
    x = np.zeros((len(sequences), SEGMENT), np.int32)
    y = np.zeros((len(sequences), SEGMENT), np.int8)
    for i, (s, t) in enumerate(zip(sequences, targets)):
        x[i, : len(s)] = s
        y[i, : len(s)] = t
    live = np.arange(SEGMENT)[None, :] < lengths[:, None]
    weights, trans, start = np.zeros(DIMS), np.zeros((2, 2)), 0.0
    g_w, g_t, g_s = np.full(DIMS, 1e-6), np.full((2, 2), 1e-6), 1e-6
    count_xy = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            count_xy[a, b] = ((y[:, :-1] == a) & (y[:, 1:] == b) & live[:, 1:]).sum()
    for _ in range(steps):
        emission = words.emission(weights)[x]
        marg, pair = _chain_expectations(emission, live, trans, start)
        word_grad = np.bincount(x[live], (marg - y)[live], minlength=len(words.slots))
        grad = np.bincount(words.slots.ravel(), (word_grad[:, None] * words.used).ravel(), minlength=DIMS) + 0.02 * weights
        g_w += grad**2
        weights -= 0.7 * grad / np.sqrt(g_w)
        grad_t = pair - count_xy + 0.02 * trans
        g_t += grad_t**2
        trans -= 0.3 * grad_t / np.sqrt(g_t)
        grad_s = float((marg[:, 0] - y[:, 0]).sum())
        g_s += grad_s**2
        start -= 0.3 * grad_s / math.sqrt(g_s)
    model = ToxicityModel(weights.astype(np.float32), trans, start, (0.0, 1.0, 0.0))
    scorer = Scorer(model)
    by_word = np.exp(np.clip(words.emission(model.weights), -CUT, CUT))
    summary = np.array([scorer.summary(by_word[ids].tolist())[:2] for ids in words.documents])
    model.curve = _logistic(summary, np.array(labels, float))
    return model


def _chain_expectations(emission, live, trans, start):
    """Token marginals of state 1 and expected transitions, for all sequences at once."""
    n, length = emission.shape
    t = np.exp(trans)
    forward = np.zeros((length, n, 2))
    cur = np.stack([np.zeros(n), emission[:, 0] + start], 1)
    for k in range(length):
        if k:
            top = forward[k - 1].max(1, keepdims=True)
            cur = top + np.log(np.exp(forward[k - 1] - top) @ t + 1e-300)
            cur[:, 1] += emission[:, k]
            cur = np.where(live[:, k : k + 1], cur, forward[k - 1])
        forward[k] = cur
    top = forward[-1].max(1, keepdims=True)
    log_z = (top[:, 0] + np.log(np.exp(forward[-1] - top).sum(1)))[:, None]
    marg, pair = np.zeros((n, length)), np.zeros((2, 2))
    back = np.zeros((n, 2))
    for k in range(length - 1, -1, -1):
        marg[:, k] = np.exp(forward[k][:, 1] + back[:, 1] - log_z[:, 0])
        if k:
            into = back.copy()
            into[:, 1] += emission[:, k]
            joint = np.exp(forward[k - 1][:, :, None] + trans[None] + into[:, None, :] - log_z[:, :, None])
            pair += (joint * live[:, k][:, None, None]).sum(0)
            top = into.max(1, keepdims=True)
            prev = top + np.log(np.exp(into - top) @ t.T + 1e-300)
            back = np.where(live[:, k : k + 1], prev, back)
    return marg * live, pair


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float, float]:
    """Ridge logistic fit by Newton steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    beta = np.zeros(x.shape[1])
    ridge = np.diag([1e-6, 0.1, 0.1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge
        beta -= np.linalg.solve(hessian, x.T @ (p - y) + ridge @ beta)
    return tuple(float(b) for b in beta)


# ---------------------------------------------------------------- scoring


class Scorer(dict):
    """Marginals and scores of one text at a time; exp(emission) cached by word."""

    def __init__(self, model: ToxicityModel, limit: int = 400_000):
        self.model, self.limit = model, limit
        t = np.exp(model.transition)
        self.t = tuple(float(v) for v in (t[0, 0], t[0, 1], t[1, 0], t[1, 1]))

    def __missing__(self, word: str) -> float:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = math.exp(min(CUT, max(-CUT, float(self.model.weights[slots(word)].sum()))))
        return value

    def odds(self, e: list[float]) -> list[float]:
        """Forward-backward in odds form: the odds of the toxic state at each token, from exp(emission)."""
        t00, t01, t10, t11 = self.t
        ahead, a = [], math.exp(self.model.start)
        for k, x in enumerate(e):
            a = x * ((t01 + t11 * a) / (t00 + t10 * a) if k else a)
            ahead.append(a)
        out, b = [0.0] * len(e), 1.0
        for k in range(len(e) - 1, -1, -1):
            out[k] = ahead[k] * b
            x = e[k] * b
            b = (t10 + t11 * x) / (t00 + t01 * x)
        return out

    def summary(self, e: list[float]):
        """Clipped log odds of the likeliest toxic token, evidence of all toxic tokens, odds.

        The evidence is the logarithm of the summed -log(1 - marginal) over
        offending tokens (noisy-or), so a sure token weighs more than a likely one.
        """
        odds = self.odds(e)
        top = max(odds, default=0.0)
        peak = min(CLIP, max(-CLIP, math.log(top))) if top > 0 else -CLIP
        return peak, math.log1p(sum(math.log1p(o) for o in odds if o >= 1)), odds

    def score(self, text: str) -> tuple[float, list[tuple[int, int]]]:
        """Score and offending spans (code points, end exclusive) of a text."""
        if self.model.constant is not None:
            return self.model.constant, []
        words = WORD.findall(text.lower())
        peak, some, odds = self.summary([self[w] for w in words])
        a, b, c = self.model.curve
        value = 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * peak + c * some))))
        spans: list[tuple[int, int]] = []
        if any(o >= 1 for o in odds):
            # U+0130 is two code points in lower case: offsets are those of the text itself
            place = [i for i, c in enumerate(text) for _ in c.lower()]
            last = -2
            for k, m in enumerate(WORD.finditer(text.lower())):
                if odds[k] >= 1:
                    start, end = place[m.start()], place[m.end() - 1] + 1
                    if last == k - 1:
                        spans[-1] = (spans[-1][0], end)
                    else:
                        spans.append((start, end))
                    last = k
        return value, spans


def with_toxicity(df: DataFrame, model: ToxicityModel, text_col: str = "text", prefix: str = "toxicity_") -> DataFrame:
    """``df`` with ``<prefix>score`` and ``<prefix>spans`` added; all its rows and columns stay."""
    ship_package(df.sparkSession)
    span = T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType())
    added = T.StructType(df.schema.fields[:])
    added.add(prefix + "score", T.DoubleType()).add(prefix + "spans", T.ArrayType(span))
    at = df.columns.index(text_col)
    shared = df.sparkSession.sparkContext.broadcast(model)  # fixed size: DIMS weights
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            got = [scorer.score(t or "") for t in batch.column(at).to_pylist()]
            spans = [[{"start": a, "end": b} for a, b in s] for _, s in got]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([v for v, _ in got], pa.float64()), pa.array(spans, spans_type)],
                names=added.names,
            )

    return df.mapInArrow(run, added)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, spans`` for every document."""
    rows = with_toxicity(docs.select("doc_id", "text"), train_toxicity(docs, labels))
    return rows.select(
        "doc_id",
        F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"),
        F.col("toxicity_score").alias("score"),
        F.when(F.col("toxicity_score") >= 0.5, 1).otherwise(0).alias("predicted"),
        F.array_join(F.transform("toxicity_spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("spans"),
    )
