"""Near duplicates: an exact Jaccard self-join of word-shingle sets by signature trees.

1. Shingle frequencies are counted over all documents.  Blocks of documents
   send their shingles as packed arrays to count partitions and get a
   frequency class per shingle back, so no row per shingle is ever shuffled.
2. Each set is ordered rarest class first.  Two sets of Jaccard t or more
   share a shingle among their first n - ceil(t * n) + 1; documents without a
   repeated shingle there link with nothing and are done.
3. Equal sets are one from here on.  The others form clusters (components of
   "share a prefix shingle"); a large cluster is cut by set size and id hash
   into blocks, and only block pairs of compatible sizes meet.
4. In a block pair, signature trees (nodes hold OR-combined token bitmaps and
   size ranges) are traversed together; node pairs whose largest possible
   overlap is too small, or whose documents are all connected already, are
   pruned.  What is left is verified on the sets.
5. Verified links are joined into components.

No cap applies anywhere; every pair of different sets of the threshold or
more ends in one component.

Defined results: NULL texts and texts without words have no shingles and link
with nothing; repeated rows get equal components; a NULL id takes its set's
component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import ship_package, shuffle_partitions, stored
from shoplens.llm.components import connected_components
from shoplens.llm.shingles import set_key, shingle_sets

BITS = 2048
LEAF = 8  # documents in a leaf, children of a node
MEMBER = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("n", pa.int64()),
        ("k1", pa.int64()),
        ("k2", pa.int64()),
        ("tokens", pa.binary()),
        ("prefix", pa.list_(pa.int64())),
    ]
)


def _packed_by_part(sets: list[np.ndarray], parts: int):
    """All tokens of a block by count partition: order, boundaries, 32-bit codes.

    Within a partition the order is by token, never by row: two reads of a
    block may see its rows in different orders.
    """
    tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    part = ((tokens >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((tokens, part))
    bounds = np.searchsorted(part[order], np.arange(parts + 1))
    return tokens, order, bounds, tokens.astype(np.uint32)[order]


def frequency_class(counts: np.ndarray) -> np.ndarray:
    """0 for one document, then about four classes for each doubling."""
    return np.where(counts == 1, 0, np.minimum(255, 1 + 4 * np.log2(np.maximum(counts, 1)))).astype(np.uint8)


def member_table(docs: DataFrame, threshold: float, words: int, docs_per_block: int = 512, docs_per_part: int = 8000) -> DataFrame:
    """``row, doc_id, text_hash, n, k1, k2`` per document; ``tokens, prefix`` where it may have a partner.

    ``row`` names the row (ids may repeat or be missing); rows of one id are
    told apart by ``text_hash``.
    """
    spark = docs.sparkSession
    total = docs.count()
    blocks = max(1, -(-total // docs_per_block))
    parts = max(shuffle_partitions(spark), -(-total // docs_per_part))
    rows = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
        .withColumn("block", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(blocks)).cast("int"))
        .repartition(max(shuffle_partitions(spark), 1), "block")
    )

    def send(key, table):
        sets = shingle_sets(table.column("text").to_pylist(), words)
        _, _, bounds, codes = _packed_by_part(sets, parts)
        used = [p for p in range(parts) if bounds[p] < bounds[p + 1]]
        return pa.table(
            {
                "block": pa.array([key[0].as_py()] * len(used), pa.int32()),
                "part": pa.array(used, pa.int32()),
                "codes": pa.array([codes[bounds[p] : bounds[p + 1]].tobytes() for p in used], pa.binary()),
            }
        )

    def count(table):
        pieces = [np.frombuffer(x, np.uint32) for x in table.column("codes").to_pylist()]
        _, inverse, counts = np.unique(np.concatenate(pieces), return_inverse=True, return_counts=True)
        classes = frequency_class(counts)[inverse]
        ends = np.cumsum([0] + [len(p) for p in pieces])
        return pa.table(
            {
                "block": table.column("block"),
                "part": table.column("part"),
                "classes": pa.array([classes[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
            }
        )

    def choose(left, right):
        names = zip(left.column("doc_id").to_pylist(), left.column("text_hash").to_pylist())
        sets = shingle_sets(left.column("text").to_pylist(), words)
        tokens, order, bounds, _ = _packed_by_part(sets, parts)
        classes = np.zeros(len(tokens), np.uint8)
        for p, blob in zip(right.column("part").to_pylist(), right.column("classes").to_pylist()):
            classes[order[bounds[p] : bounds[p + 1]]] = np.frombuffer(blob, np.uint8)
        out: list[list] = [[] for _ in MEMBER]
        at = 0
        for name, tokens in zip(names, sets):
            n = len(tokens)
            own = classes[at : at + n]
            at += n
            prefix = np.zeros(0, np.uint64)
            if n:
                length = n - int(np.ceil(threshold * n - 1e-9)) + 1
                if np.count_nonzero(own == 0) < length:
                    chosen = np.lexsort((tokens, own))[:length]
                    prefix = tokens[chosen[own[chosen] > 0]]
            key = set_key(tokens) if n else (None, None)
            has = len(prefix) > 0
            for column, value in zip(
                out, (*name, n, *key, tokens.tobytes() if has else None, prefix.view(np.int64).tolist() if has else None)
            ):
                column.append(value)
        return pa.table([pa.array(c, f.type) for c, f in zip(out, MEMBER)], schema=MEMBER)

    sent = rows.groupBy("block").applyInArrow(send, "block int, part int, codes binary")
    replies = sent.groupBy("part").applyInArrow(count, "block int, part int, classes binary")
    members = (
        rows.groupBy("block")
        .cogroup(replies.groupBy("block"))
        .applyInArrow(choose, "doc_id long, text_hash long, n long, k1 long, k2 long, tokens binary, prefix array<long>")
    )
    return stored(members.withColumn("row", F.monotonically_increasing_id()), "members")


# ---------------------------------------------------------------- signature trees


class SignatureTree:
    """Documents in leaves of similar signatures; nodes hold OR-ed bitmaps and size ranges."""

    def __init__(self, sets: list[np.ndarray], rows: np.ndarray):
        self.rows = rows
        n = len(rows)
        self.bits = np.zeros((n, BITS // 64), np.uint64)
        self.size = np.array([len(sets[r]) for r in rows], np.int64)
        for i, r in enumerate(rows):
            place = sets[r] & np.uint64(BITS - 1)
            np.bitwise_or.at(self.bits[i], (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
        self.extra = self.size - np.bitwise_count(self.bits).sum(1)
        # levels[0] are single documents; a node covers LEAF nodes of the level below
        self.levels = [(self.bits, self.size, self.size, self.extra)]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, extra = self.levels[-1]
            cut = np.arange(0, len(bits), LEAF)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bits, cut),
                    np.minimum.reduceat(low, cut),
                    np.maximum.reduceat(high, cut),
                    np.maximum.reduceat(extra, cut),
                )
            )

    def children(self, level: int, node: int) -> np.ndarray:
        return np.arange(node * LEAF, min((node + 1) * LEAF, len(self.levels[level - 1][0])))

    def members(self, level: int, node: int) -> tuple[int, int]:
        return node * LEAF**level, min((node + 1) * LEAF**level, len(self.rows))


def similar_order(sets: list[np.ndarray], rows: list[int]) -> np.ndarray:
    """Rows by smallest hash, then size: near copies become neighbours."""
    low = np.array([sets[r][0] for r in rows], np.uint64)
    size = np.array([len(sets[r]) for r in rows])
    return np.array(rows, np.int64)[np.lexsort((size, low))]


def may_overlap(a, i, b, j, num: int, den: int) -> np.ndarray:
    """Which node pairs can hold a pair of Jaccard num / den or more (vectorised)."""
    common = np.bitwise_count(a[0][i] & b[0][j]).sum(-1).astype(np.int64)
    most = common + np.minimum(a[3][i], b[3][j])
    least = (a[1][i] + b[1][j]) * num  # of overlap * (num + den)
    sizes = (a[2][i] * den >= b[1][j] * num) & (b[2][j] * den >= a[1][i] * num)
    return sizes & (most * (num + den) >= least)


def tree_links(sets: list[np.ndarray], left: list[int], right: list[int] | None, num: int, den: int):
    """A spanning forest of the links between ``left`` and ``right`` rows (or within ``left``)."""
    parent = list(range(len(sets)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    one = SignatureTree(sets, similar_order(sets, left))
    two = one if right is None else SignatureTree(sets, similar_order(sets, right))
    links = []
    top_a, top_b = len(one.levels) - 1, len(two.levels) - 1
    stack = [(top_a, 0, top_b, 0)]
    while stack:
        la, i, lb, j = stack.pop()
        a0, a1 = one.members(la, i)
        b0, b1 = two.members(lb, j)
        if la + lb > 2 and len({find(int(r)) for r in one.rows[a0:a1]} | {find(int(r)) for r in two.rows[b0:b1]}) == 1:
            continue  # all connected already
        if la == 0 and lb == 0:
            x, y = int(one.rows[i]), int(two.rows[j])
            if find(x) != find(y):
                both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if both * (num + den) >= num * (len(sets[x]) + len(sets[y])):
                    links.append((x, y))
                    parent[find(x)] = find(y)
            continue
        ca = one.children(la, i) if la and la >= lb else np.array([i])
        cb = two.children(lb, j) if lb and lb >= la else np.array([j])
        na, nb = (la - 1 if la and la >= lb else la), (lb - 1 if lb and lb >= la else lb)
        p, q = (m.ravel() for m in np.meshgrid(ca, cb, indexing="ij"))
        if two is one and na == nb:
            keep = p < q if na == 0 else p <= q
            p, q = p[keep], q[keep]
        good = may_overlap(one.levels[na], p, two.levels[nb], q, num, den)
        stack.extend((na, int(x), nb, int(y)) for x, y in zip(p[good][::-1], q[good][::-1]))
    return links


# ---------------------------------------------------------------- on Spark


def verified_links(members: DataFrame, threshold_percent: int, docs_per_node: int = 1024) -> DataFrame:
    """``u, v``: a spanning forest of the links between the different sets of ``members``."""
    num, den = threshold_percent, 100
    postings = members.select("doc_id", F.explode("prefix").alias("token"))
    shared = postings.groupBy("token").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    near = postings.join(shared.select("token", "first"), "token").select(F.col("doc_id").alias("u"), F.col("first").alias("v"))
    clusters = stored(connected_components(near.distinct()), "clusters")

    # cut large clusters by size class (two classes for each factor 100 / percent) and id hash
    placed = members.select("doc_id", "n").join(clusters.withColumnRenamed("node", "doc_id"), "doc_id")
    size_class = F.floor(F.log(F.col("n").cast("double")) / float(np.log(den / num) / 2)).cast("int")
    sizes = placed.groupBy("component").agg(F.count(F.lit(1)).alias("all"))
    placed = placed.join(sizes, "component").withColumn(
        "class", F.when(F.col("all") <= docs_per_node, 0).otherwise(size_class)
    )
    nodes = placed.groupBy("component", "class").agg(
        F.ceil(F.count(F.lit(1)) / docs_per_node).cast("int").alias("subs")
    )
    placed = stored(
        placed.join(nodes, ["component", "class"])
        .withColumn("sub", F.pmod(F.xxhash64("doc_id"), F.col("subs")).cast("int"))
        .select("doc_id", "component", "class", "sub"),
        "placed",
    )
    blocks = stored(placed.select("component", "class", "sub").distinct(), "blocks")
    other = blocks.select("component", F.col("class").alias("class2"), F.col("sub").alias("sub2"))
    ordered = (F.col("class") < F.col("class2")) | ((F.col("class") == F.col("class2")) & (F.col("sub") <= F.col("sub2")))
    pairs = blocks.join(other, "component").filter(ordered & (F.col("class2") - F.col("class") <= 2))
    group = F.xxhash64("component", "class", "sub", "class2", "sub2").alias("pair")
    same = (F.col("class") == F.col("class2")) & (F.col("sub") == F.col("sub2"))
    left = pairs.select("component", "class", "sub", group, F.lit(0).alias("side"))
    right = pairs.filter(~same).select(
        "component", F.col("class2").alias("class"), F.col("sub2").alias("sub"), group, F.lit(1).alias("side")
    )
    dealt = (
        placed.join(left.unionByName(right), ["component", "class", "sub"])
        .select("doc_id", "pair", "side")
        .join(members.select("doc_id", "tokens"), "doc_id")
    )

    def match(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id")
        ids = pdf["doc_id"].to_numpy()
        sets = [np.frombuffer(t, np.uint64) for t in pdf["tokens"]]
        side = pdf["side"].to_numpy()
        one, two = np.flatnonzero(side == 0).tolist(), np.flatnonzero(side == 1).tolist()
        links = tree_links(sets, one, two or None, num, den) if one else []
        return pd.DataFrame({"u": [ids[a] for a, _ in links], "v": [ids[b] for _, b in links]}, dtype="int64")

    return dealt.groupBy("pair").applyInPandas(match, "u long, v long")


def near_duplicates(
    docs: DataFrame, threshold_percent: int = 75, words: int = 5, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every document, and ``text_hash, component``.

    Different texts of one id are different documents: a set of shingles is
    named by a row that holds it, not by an id.  ``component`` tells groups
    apart whose smallest id is the same (NULL without shingles);
    ``component_id`` is NULL where no document of the group has an id.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    members = member_table(rows, threshold_percent / 100, words)
    sets = members.filter("n > 0").groupBy("k1", "k2").agg(F.min("row").alias("rep"), F.min("doc_id").alias("low"))
    sets = stored(sets, "sets")
    maybe = (
        members.filter(F.col("tokens").isNotNull())
        .select(F.col("row").alias("doc_id"), "n", "tokens", "prefix")
        .join(sets.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    )
    maybe = stored(maybe, "candidates")
    found = connected_components(verified_links(maybe, threshold_percent))
    named = sets.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "k1", "k2", "low", F.coalesce("component", "rep").alias("component")
    )
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.select("k1", "k2", "component").join(lowest, "component")
    return members.select("doc_id", "text_hash", "n", "k1", "k2").join(named, ["k1", "k2"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        "text_hash",
        "component",
    )
